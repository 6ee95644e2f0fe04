"""Shuffled shards: a Feistel permutation of global row numbers, computed and not stored."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from .common import ODD, mixed, written

ROUNDS = 6
#: The most regions of hashes that are numbered each by one task.
MOST_REGIONS = 1 << 16
#: Rows of which more than this are alike, and more than a 65,536th of all, are numbered as one and dealt out afterwards.
HOT_ROWS = 1 << 14
ADDED = ("row_no", "shard", "slot")


class Permutation:
    """A permutation of 0 to n - 1 from a seed, computed forth and back for any number alone.

    A number is a pair of digits of base ceil(sqrt(n)); each round adds to one digit a function of
    the other. What leaves the range is permuted again until it is back in it (cycle walking), so
    the range is permuted exactly; the base leaves few numbers outside.
    """

    def __init__(self, n: int, seed: int):
        self.n, self.base = n, 1
        while self.base * self.base < n:
            self.base = max(self.base + 1, int(n**0.5))
        self.keys = [mixed(np.array([seed % (1 << 63) * ROUNDS + i], np.uint64) * ODD)[0] for i in range(ROUNDS)]

    def _added(self, key: np.uint64, digit: np.ndarray) -> np.ndarray:
        return (mixed((digit.astype(np.uint64) + key) * ODD) >> np.uint64(1)).astype(np.int64) % self.base

    def _once(self, x: np.ndarray) -> np.ndarray:
        high, low = np.divmod(x, self.base)
        for key in self.keys:
            high, low = low, (high + self._added(key, low)) % self.base
        return high * self.base + low

    def _back(self, x: np.ndarray) -> np.ndarray:
        high, low = np.divmod(x, self.base)
        for key in reversed(self.keys):
            high, low = (low - self._added(key, high)) % self.base, high
        return high * self.base + low

    def _walk(self, step, x: np.ndarray) -> np.ndarray:
        x = step(np.asarray(x, np.int64))
        while len(out := np.flatnonzero(x >= self.n)):
            x[out] = step(x[out])
        return x

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._walk(self._once, x)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self._walk(self._back, x)


def place(row_no: int, rows: int, shards: int, seed: int) -> tuple[int, int]:
    """(shard, slot) of a row number, without any table."""
    at = int(Permutation(rows, seed)(np.array([row_no]))[0])
    return at % shards, at // shards


def row_at(shard: int, slot: int, rows: int, shards: int, seed: int) -> int:
    """The row number that lies in a slot of a shard."""
    at = slot * shards + shard
    if not (0 <= shard < shards and 0 <= at < rows):
        raise ValueError("no such slot")
    return int(Permutation(rows, seed).inverse(np.array([at]))[0])


def _permuted(number: Column, rows: int, seed: int) -> Column:
    @F.pandas_udf("long")
    def permute(x: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Permutation(rows, seed)
        for part in x:
            yield pd.Series(own(part.to_numpy()))

    return permute(number)


def _has_map(kind: DataType) -> bool:
    inner = [f.dataType for f in kind.fields] if isinstance(kind, StructType) else [kind.elementType] if isinstance(kind, ArrayType) else []
    return isinstance(kind, (MapType, VariantType)) or any(map(_has_map, inner))


def numbered(rows: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, int]:
    """(row, row_no: all columns as a struct and numbers from 0 without gaps; number of rows).

    Numbers follow a hash of the row's columns (maps and variants apart), then the columns, so
    they don't depend on files, partitions or the order of rows. Rows alike in all of these may
    change places. A first pass counts rows by hash; regions of equal hash width then start where
    the rows of those below end, so each is numbered by itself, after one shuffle of the rows.
    Rows of a hash that more than ``hot_rows`` share come last: each distinct one is counted
    before it is shuffled, and spread over tasks when it is numbered.
    """
    spark = rows.sparkSession
    plain = [f.name for f in rows.schema.fields if not _has_map(f.dataType)]
    packed = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"), F.xxhash64(*(F.col(f"`{c}`") for c in plain)).alias("hash"))
    keys = written(packed.groupBy("hash").agg(F.count("*").alias("n")), "row-hashes")
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = max(hot_rows, total >> 16)
    hot = [(r["hash"], r["n"]) for r in keys.filter(F.col("n") > most).orderBy("hash").collect()]  # 65,536 at most
    bits = min(MOST_REGIONS, max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // 50_000)).bit_length()
    region = F.shiftright("hash", 64 - bits).cast("int").alias("region")
    sums = keys.filter(F.col("n") <= most).groupBy(region).agg(F.sum("n").alias("n")).orderBy("region").collect()
    starts = spark.createDataFrame([(r["region"], s) for r, s in zip(sums, accumulate((r["n"] for r in sums), initial=0), strict=False)], "region int, start long")
    first_hot = sum(r["n"] for r in sums)
    cold = packed
    if hot:
        known = F.broadcast(spark.createDataFrame([(h, first_hot + s) for (h, _), s in zip(hot, accumulate((n for _, n in hot), initial=0), strict=False)], "hash long, start long"))
        cold = packed.join(known, "hash", "left_anti")
    order = ["hash", *(F.col("row").getField(c) for c in plain)]
    place = F.row_number().over(Window.partitionBy("region").orderBy(*order)) - 1
    out = cold.select("row", "hash", region).join(F.broadcast(starts), "region").select("row", (F.col("start") + place).alias("row_no"))
    if hot:
        alike = packed.join(known, "hash").groupBy("hash", "start", "row").agg(F.count("*").alias("n"))
        before = Window.partitionBy("hash").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        begun = alike.withColumn("begin", F.col("start") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        chunks = begun.select("row", "hash", "begin", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / HOT_ROWS))).alias("chunk")).repartition("hash", "begin", "chunk")
        spread = F.explode(F.sequence(F.col("chunk") * HOT_ROWS, F.least(F.col("n"), (F.col("chunk") + 1) * HOT_ROWS) - 1))
        out = out.unionByName(chunks.select("row", "begin", spread.alias("at")).select("row", (F.col("begin") + F.col("at")).alias("row_no")))
    return out, total


def sharded(rows: DataFrame, shards: int = 16, seed: int = 0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All rows with row_no, shard and slot: a shuffle that the seed and the rows decide.

    The permutation of row_no (see ``numbered``) divided by ``shards`` gives the slot, what is
    left the shard. So shards differ by one row at most, slots have no gaps, ``place`` computes
    both from a number and ``row_at`` the number from both; another seed shuffles anew
    without numbering again.

    Nulls are values like others; repeated rows have slots of their own; no rows: no rows. An
    input column named like an added one comes out as ``<name>_input``.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    made, total = numbered(rows, hot_rows)
    at = made.withColumn("_at", _permuted(F.col("row_no"), total, seed))
    kept = [F.col("row").getField(c).alias(f"{c}_input" if c in ADDED else c) for c in rows.columns]
    return at.select(*kept, "row_no", (F.col("_at") % shards).cast("int").alias("shard"), F.floor(F.col("_at") / shards).alias("slot"))


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Writes rows of ``sharded`` as a folder per shard, files of neighbouring slots in order."""
    part = F.floor(F.col("slot") / rows_per_file)
    placed.repartition("shard", part).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
