"""Tables of tiles partitioned by shard, of which a job replaces the shards that it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import shard_origin
from ..operators.select import tile_key_of
from .storage import shared_folder

SHARD = ["shard_lat", "shard_lon"]


def with_shard(tiles: DataFrame, degrees: int = 10) -> DataFrame:
    return tiles.withColumns({"shard_lat": shard_origin(F.col("tile_lat"), -90, degrees), "shard_lon": shard_origin(F.col("tile_lon"), -180, degrees)})


def write_tiles(tiles: DataFrame, path: str, degrees: int = 10) -> None:
    """Writes a table of tiles, a folder per shard; of shards that lie there already, only those of the tiles are replaced."""
    dealt = with_shard(tiles, degrees).repartition(*SHARD)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SHARD).parquet(path)


def read_tiles(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows of a table that ``write_tiles`` made of rows like these."""
    return spark.read.schema(with_shard(like).schema).parquet(path)


def replace_tiles(spark: SparkSession, path: str, new: DataFrame, degrees: int = 10) -> int:
    """Puts new rows in place of the old ones of their tiles (by tile_id where there is one, else cell); returns how many shards were written.

    Only shards that hold a new row are read and written. Their rows go to a table of
    their own first and take the place of the old files when that is whole, so if a task
    or the job fails the old rows stay. ``new`` is read three times.
    """
    touched = [(r[0], r[1]) for r in with_shard(new, degrees).select(*SHARD).distinct().collect()]  # a grid of shards at most
    if not touched:
        return 0
    old = read_tiles(spark, path, new)
    here = old.filter(F.concat_ws(",", *SHARD).isin([f"{a},{b}" for a, b in touched]))
    key = tile_key_of(new)
    kept = here.select(new.columns).join(new.select(*key).distinct(), key, "left_anti").select(new.columns)
    made = shared_folder(spark, "replaced")
    kept.unionByName(new).write.parquet(made)
    write_tiles(spark.read.schema(new.schema).parquet(made), path, degrees)
    return len(touched)
