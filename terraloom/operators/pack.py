"""Inventory figures, pack layouts, merges and shards."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import codes, keys
from .grids import running_starts
from .select import CELL, is_trusted, likely_ocean

# Fixed values of the shard and pack files.
SHARD_MAGIC, SHARD_VERSION = b"GSH1", 1
SHARD_HEADER, SHARD_ENTRY = "<4sHHhhHHIIIII", "<II"
PACK_HEADER, PACK_ENTRY = "<4sHIIIIIIH", "<QQ"
SHARD_HEADER_BYTES, SHARD_ENTRY_BYTES, PACK_HEADER_BYTES, PACK_ENTRY_BYTES = map(struct.calcsize, (SHARD_HEADER, SHARD_ENTRY, PACK_HEADER, PACK_ENTRY))
PACK_MAGIC = {"terrain": b"GPK3", "population": b"GPOP"}
MOST_PACK_BYTES = 1024 * 1024 * 1024
BUCKETS = [(1, "<1KB"), (10, "1-10KB"), (50, "10-50KB"), (100, "50-100KB"), (500, "100-500KB")]
LAST_BUCKET = ">500KB"


def tile_stats(files: DataFrame) -> DataFrame:
    size, people = F.col("terrain_bytes"), F.col("pop_bytes")
    data = size > 1
    total = F.sum(size)
    return files.agg(
        F.count(size).alias("tiles"), F.count_if(~data).alias("water_tiles"), F.count_if(data).alias("data_tiles"), total.alias("total_bytes"), F.sum(F.when(data, size)).alias("data_bytes"),
        F.round(F.avg(size), 6).alias("avg_bytes"), F.round(F.avg(F.when(data, size)), 6).alias("avg_data_bytes"), F.count(people).alias("pop_tiles"), F.sum(people).alias("pop_bytes"), (total + F.coalesce(F.sum(people), F.lit(0))).alias("combined_bytes"),
    )


def size_histogram(files: DataFrame) -> DataFrame:
    """Data tiles by size; every bucket has a row."""
    kb, bucket = F.col("terrain_bytes") / 1024, F.lit(LAST_BUCKET)
    for top, name in reversed(BUCKETS):
        bucket = F.when(kb < top, name).otherwise(bucket)
    counted = files.filter("terrain_bytes > 1").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    names = [n for _, n in BUCKETS] + [LAST_BUCKET]
    every = files.sparkSession.createDataFrame([(i, n) for i, n in enumerate(names)], "place int, bucket string")
    return every.join(counted, "bucket", "left").select("place", "bucket", F.coalesce("n", F.lit(0)).alias("tiles"))


def root_size(payload: Column) -> Column:
    """Nodes that a payload's root says there are; null for water and for a root that is a leaf."""
    body = F.when(F.substring(payload, 1, 4) == F.lit(b"QTR5"), F.substring(payload, 17, 2)).otherwise(F.substring(payload, 1, 2))
    text = F.hex(body)
    root = F.conv(F.concat(F.substring(text, 3, 2), F.substring(text, 1, 2)), 16, 10).cast("int")
    root = F.when((F.length(body) == 2) & (root < codes.LEAF), root)
    return root


def tile_info(files: DataFrame, land: DataFrame) -> DataFrame:
    judged = likely_ocean(files, land)
    return judged.select("tile_id", "terrain_bytes", F.when(F.col("terrain_bytes") > 1, F.floor(F.col("terrain_bytes") / 2)).cast("long").alias("node_count"), "is_ocean")


def near_budget(log: DataFrame, budget: int) -> DataFrame:
    return log.filter(F.col("nodes") >= budget - 64)


def top_largest(files: DataFrame, most: int = 10) -> DataFrame:
    """The largest data tiles, ties in file-name order; a report of fixed length."""
    name = keys.file_name(F.col("tile_lat"), F.col("tile_lon"))
    return files.filter("terrain_bytes > 1").select(name.alias("name"), "terrain_bytes").orderBy(F.desc("terrain_bytes"), "name").limit(most)


def on_grid(files: DataFrame) -> DataFrame:
    return files.filter(F.col("tile_lat").between(-90, 89) & F.col("tile_lon").between(-180, 179))


def pack_layout(files: DataFrame, size: str = "terrain_bytes") -> DataFrame:
    """Offset of each tile in a pack: running sum of sizes in file-name order.

    Only names and sizes are ordered, column by column of the grid, after the sizes of all columns
    whose names come before; payloads aren't. Tiles of the same cell lie in order of size.
    """
    name = keys.file_name(F.col("tile_lat"), F.col("tile_lon"))
    rows = on_grid(files).filter(F.col(size).isNotNull()).select(name.alias("name"), "tile_lat", "tile_lon", F.col(size).cast("long").alias(size))
    index = keys.tile_index(F.col("tile_lat"), F.col("tile_lon"))
    group = F.concat(F.col("tile_lon").cast("string"), F.lit("_"))  # no other group's names come between
    before = F.sum(size).over(Window.partitionBy("_group").orderBy("name", size).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_group", group).join(F.broadcast(running_starts(rows, group, F.sum(size))), "_group")
    return rows.select("name", index.alias("tile_idx"), (F.col("_start") + F.coalesce(before, F.lit(0))).cast("long").alias("offset"), F.col(size).alias("size"))


def pack_header(files: DataFrame, size: str = "terrain_bytes", raw: str | None = None) -> DataFrame:
    """Totals of a pack's header; ``raw`` has the bytes of each tile before packing (None: stored as they are)."""
    stored = F.coalesce(F.sum(size), F.lit(0)).cast("long")
    total = stored + PACK_ENTRY_BYTES * keys.WIDTH * keys.HEIGHT + PACK_HEADER_BYTES
    return on_grid(files).agg(F.count(size).alias("tiles"), stored.alias("stored_bytes"), F.coalesce(F.sum(raw or size), F.lit(0)).cast("long").alias("raw_bytes"), total.alias("file_bytes"), (total > MOST_PACK_BYTES).alias("too_large"))


def new_tiles(files: DataFrame, pack: DataFrame) -> DataFrame:
    return files.join(pack.select(*CELL), CELL, "left_anti")


def incremental_pack(pack: DataFrame, tiles: DataFrame, content: str = "size", key: list[str] = CELL) -> DataFrame:
    """The pack after new and changed tiles; what only the pack has stays. ``key`` tells tiles apart.

    Changes are found by a hash of the content. The result is that of packing everything anew.
    """
    old = pack.select(*key, F.col(content).alias("_old"), F.lit(True).alias("_had"))
    new = tiles.select(*key, F.col(content).alias("_new"), F.lit(True).alias("_has"))
    both = old.join(new, key, "full")
    same = F.xxhash64("_old") == F.xxhash64("_new")
    change = F.when(F.col("_had").isNull(), "new").when(F.col("_has").isNull() | same, "same").otherwise("changed")
    return both.select(*key, F.when(F.col("_has"), F.col("_new")).otherwise(F.col("_old")).alias(content), change.alias("change"))


def merge_packs(first: DataFrame, second: DataFrame) -> DataFrame:
    """All tiles of the first pack and those that only the second has; kinds must not differ."""
    if "kind" in first.columns and "kind" in second.columns:
        kinds = first.select("kind").union(second.select("kind")).distinct().limit(2).count()
        if kinds > 1:
            raise ValueError("the packs are of different kinds")
    return first.unionByName(second.join(first.select(*CELL), CELL, "left_anti").select(*first.columns))


def _in_shards(files: DataFrame, degrees: int) -> DataFrame:
    lat, lon = F.col("tile_lat"), F.col("tile_lon")
    out = on_grid(files).withColumns({"shard_lat": keys.shard_origin(lat, -90, degrees), "shard_lon": keys.shard_origin(lon, -180, degrees)})
    out = out.withColumns({"tile_w": keys.shard_size(F.col("shard_lon"), 180, degrees), "tile_h": keys.shard_size(F.col("shard_lat"), 90, degrees)})
    return out.withColumn("local_idx", ((lat - F.col("shard_lat")) * F.col("tile_w") + lon - F.col("shard_lon")).cast("int"))


def shard_key(files: DataFrame, degrees: int) -> DataFrame:
    """Adds shard_lat, shard_lon, tile_w, tile_h and local_idx; shards at the edge are clipped."""
    return _in_shards(files, max(1, degrees))


def shard_name(prefix: str) -> Column:
    return F.format_string(prefix + "_%+04d_%+03d.gsh", "shard_lon", "shard_lat")


def pack_shards(files: DataFrame, degrees: int = 10, prefix: str = "terrain", size: str = "terrain_bytes", raw: str | None = None) -> DataFrame:
    """A manifest row per shard; ``size`` is what a tile takes there, ``raw`` (the same unless given) what it takes unpacked."""
    grouped = shard_key(files.filter(F.col(size).isNotNull()), degrees).groupBy("shard_lat", "shard_lon", "tile_w", "tile_h")
    rows = grouped.agg(F.count("*").alias("tile_count"), F.sum(size).cast("long").alias("data_bytes"), F.sum(raw or size).cast("long").alias("raw_bytes"))
    index = (F.col("tile_w") * F.col("tile_h") * SHARD_ENTRY_BYTES).cast("long")
    return rows.select(shard_name(prefix).alias("path"), F.lit(prefix).alias("kind"), "shard_lat", "shard_lon", "tile_w", "tile_h", "tile_count", index.alias("index_bytes"), "data_bytes", "raw_bytes", (SHARD_HEADER_BYTES + index + F.col("data_bytes")).alias("file_bytes"))


def shard_manifest(entries: DataFrame, degrees: int = 10) -> DataFrame:
    """One row for all shards of ``pack_shards``: how tiles are packed, and totals.

    The label is that of packed tiles if any shard holds less than its tiles take unpacked.
    """
    packed = F.max((F.col("data_bytes") < F.col("raw_bytes")).cast("int")) == 1
    totals = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("tile_count", "data_bytes", "raw_bytes", "file_bytes")]
    return entries.agg(
        F.lit("GeoShard").alias("format"), F.lit(SHARD_VERSION).alias("version"), F.lit(max(1, degrees)).alias("shard_degrees"), F.lit(SHARD_HEADER_BYTES).alias("header_bytes"), F.lit(SHARD_ENTRY_BYTES).alias("index_entry_bytes"),
        F.when(packed, "zstd-per-tile").otherwise("none").alias("compression"), F.count("*").alias("shards"), *totals,
    )


CHUNKS = "path string, seq int, at long, chunk binary"


def shard_chunks(tiles: DataFrame, degrees: int = 10, prefix: str = "terrain", chunk_bytes: int = 4 << 20, raw: str | None = None) -> DataFrame:
    """The bytes of each shard file in order, as rows (path, seq, at, chunk) of about ``chunk_bytes`` or one longer tile.

    Header and index come first, and then the payloads in file-name order. The index follows from
    sizes alone: columns make it per shard, beside at most degrees x degrees entries. Payloads
    are then sorted by shard and name and pass through their task in batches, so no shard is in
    memory. Of several tiles of a cell, all in order of size and content, the index has the longest. ``raw``: a column of sizes unpacked, where payloads are packed. A shard of 4 GiB or
    more is refused.
    """
    kind = 1 if prefix == "terrain" else 2
    size = F.length("payload").cast("long")
    keyed = shard_key(tiles.filter("payload is not null"), degrees).withColumns({"name": keys.file_name(F.col("tile_lat"), F.col("tile_lon")), "path": shard_name(prefix)})
    entry = F.struct("name", F.col("local_idx").alias("place"), size.alias("size"), (F.col(raw) if raw else size).cast("long").alias("raw"))
    shard = ["path", "shard_lon", "shard_lat", "tile_w", "tile_h"]
    heads = keyed.groupBy(*shard).agg(F.sort_array(F.collect_list(entry)).alias("entries")).withColumns({"name": F.lit(""), "payload": F.lit(None).cast("binary")})
    nothing = F.lit(None).cast(heads.schema["entries"].dataType)
    rows = heads.unionByName(keyed.select(*shard, "name", "payload", nothing.alias("entries")))
    order = ["path", "name", F.length("payload"), "payload"]

    def head(r: dict) -> bytes:
        index, at = bytearray(r["tile_w"] * r["tile_h"] * SHARD_ENTRY_BYTES), 0
        for e in r["entries"]:
            struct.pack_into(SHARD_ENTRY, index, e["place"] * SHARD_ENTRY_BYTES, at, e["size"])
            at += e["size"]
        if at >= 1 << 32:
            raise ValueError(f"{r['path']} exceeds 4 GiB; use smaller shards")
        raw_bytes = sum(e["raw"] for e in r["entries"])
        return struct.pack(SHARD_HEADER, SHARD_MAGIC, SHARD_VERSION, kind, r["shard_lon"], r["shard_lat"], r["tile_w"], r["tile_h"], len(r["entries"]), len(index), at, raw_bytes, int(at < raw_bytes)) + bytes(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, seq, at, held = "", 0, 0, bytearray()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [path], "seq": pa.array([seq], pa.int32()), "at": [at], "chunk": [bytes(held)]})

        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                path = r["path"]
                held += head(r) if r["entries"] is not None else r["payload"]
                if len(held) >= chunk_bytes or r["entries"] is not None:
                    yield out()
                    seq, at, held = seq + 1, at + len(held), bytearray()
        if held:
            yield out()

    return rows.repartition("path").sortWithinPartitions(*order).groupBy("path").applyInArrow(run, CHUNKS)


def fix_ocean(files: DataFrame, land: DataFrame, force: bool = False) -> DataFrame:
    """Data tiles on likely ocean become one-byte water in both layers; refused with a sparse index."""
    if not force and not is_trusted(land):
        return files
    judged = likely_ocean(files, land, True)
    wet = F.col("is_ocean") & (F.col("terrain_bytes") > 1)
    return judged.withColumns({"terrain_bytes": F.when(wet, 1).otherwise(F.col("terrain_bytes")), "pop_bytes": F.when(wet & F.col("pop_bytes").isNotNull(), 1).otherwise(F.col("pop_bytes"))}).select(*files.columns)


def bake_summary(log: DataFrame) -> DataFrame:
    """Counts per status, mean nodes and tree time of ok tiles, mean download, tiles per second."""
    ok = F.col("status") == "ok"
    busy = F.sum(F.col("download_ms") + F.col("quadtree_ms"))
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("ok", "water", "ocean", "no_data", "error")]

    def mean(total: Column, n: Column) -> Column:
        return F.round(F.coalesce(total, F.lit(0)) / F.greatest(n, F.lit(1)), 6)

    return log.agg(F.count("*").alias("tiles"), *counts, mean(F.sum(F.when(ok, F.col("nodes"))), F.count_if(ok)).alias("mean_nodes"), mean(F.sum("download_ms"), F.count("*")).alias("mean_download_ms"), mean(F.sum(F.when(ok, F.col("quadtree_ms"))), F.count_if(ok)).alias("mean_quadtree_ms"), F.round(F.count("*") * 1000 / F.greatest(busy, F.lit(1)), 6).alias("tiles_per_s"))
