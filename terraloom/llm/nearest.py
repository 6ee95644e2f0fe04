"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import scratch, written

FOUND = "query_id long, vec_id long, score double"
CHUNK_BITS = 16


def fit_rotations(x: np.ndarray, bits: int, rounds: int = 20, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projections) whose signs are the code: principal axes, turned to lie near corners.

    Each block of as many bits as there are axes starts from a random rotation and alternates
    between the nearest corners and the rotation that best maps the vectors to them.
    """
    rng, mean = np.random.default_rng(seed), x.mean(0)
    _, _, axes = np.linalg.svd(x - mean, full_matrices=False)
    v, parts = (x - mean) @ axes.T, []
    while sum(p.shape[1] for p in parts) < bits:
        turn, _ = np.linalg.qr(rng.normal(size=(v.shape[1], v.shape[1])))
        for _ in range(rounds):
            left, _, right = np.linalg.svd(v.T @ np.where(v @ turn >= 0, 1.0, -1.0))
            turn = left @ right
        parts.append(axes.T @ turn)
    return mean, np.hstack(parts)[:, :bits]


def encode(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """(vectors, bits / 16) codes as 16-bit substrings."""
    signs = (x - model[0]) @ model[1] >= 0
    return np.packbits(signs, axis=1).view(np.uint16)


def fit_radius(x: np.ndarray, codes: np.ndarray, k: int, reach: float, seed: int = 0, queries: int = 200) -> int:
    """The Hamming radius within which a share ``reach`` of sampled vectors' k nearest lie."""
    some = np.random.default_rng(seed).permutation(len(x))[:queries]
    far = []
    for i in some:
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        near = np.argsort(d)[: min(k, len(x) - 1)]
        far.append(np.bitwise_count(codes[near] ^ codes[i]).sum(1))
    far = np.concatenate(far) if far else np.zeros(1)
    return int(np.quantile(far, reach)) if len(far) else 0


class CodeIndex:
    """Codes of a block with a table for each substring: its distinct values and their rows."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.tables = codes, []
        for c in range(codes.shape[1]):
            order = np.argsort(codes[:, c], kind="stable").astype(np.int32)
            values, first = np.unique(codes[order, c], return_index=True)
            self.tables.append((values, np.append(first, len(order)), order))

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of every code within the radius: by the pigeonhole principle one
        substring at least differs in no more than radius / substrings bits, so the rows of all
        such values of each substring are probed, and then compared as a whole."""
        probed = np.zeros(len(self.codes), bool)
        each = radius // len(self.tables)
        for c, (values, first, order) in enumerate(self.tables):
            hit = np.flatnonzero(np.bitwise_count(values ^ code[c]) <= each)
            length = first[hit + 1] - first[hit]
            total = int(length.sum())
            if total:
                end = np.cumsum(length)
                probed[order[np.arange(total) - np.repeat(end - length, length) + np.repeat(first[hit], length)]] = True
                if total >= len(order) or probed.all():
                    break
        rows = np.flatnonzero(probed)
        wide = self.codes.view(np.uint64)
        distance = np.bitwise_count(wide[rows] ^ code.view(np.uint64)).sum(1)
        near = distance <= radius
        return rows[near], distance[near]


class Best:
    """The k nearest found so far for each of a block of queries, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k, self.ids, self.scores = k, [np.zeros(0, np.int64)] * queries, [np.zeros(0)] * queries

    def add(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids[query], ids]), np.concatenate([self.scores[query], scores])
        order = np.lexsort((ids, scores))[: self.k]
        self.ids[query], self.scores[query] = ids[order], scores[order]


def search_block(index: CodeIndex, vectors: np.ndarray, first: np.ndarray, single: np.ndarray, query: np.ndarray, code: np.ndarray, own: int, k: int, radius: int, step: int) -> Iterator[tuple[int, float]]:
    """(row, distance) of the k nearest classes among the codes within the radius of one query.

    A class that is the query's own row alone is passed over. The radius grows by ``step``
    until k others are found or all are. Candidates are ranked by their Euclidean distance,
    ties by smallest id.
    """
    bits = index.codes.shape[1] * CHUNK_BITS
    while True:
        rows, _ = index.within(code, radius)
        rows = rows[~(single[rows] & (first[rows] == own))]
        if len(rows) >= k or radius >= bits:
            break
        radius = min(bits, radius + step)
    d = np.sqrt(((vectors[rows] - query) ** 2).sum(1))
    if len(d) > k:
        near = d <= np.partition(d, k - 1)[k - 1]
        rows, d = rows[near], d[near]
    for i in np.lexsort((first[rows], d))[:k]:
        yield int(rows[i]), float(d[i])


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))


def nearest(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    bits: int = 256,
    reach: float = 0.98,
    sample: int = 4_000,
    block_rows: int = 8_000,
    query_rows: int = 50_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest vectors found for each vector whose id is divisible by ``every``.

    query_id, rank (from 1), vec_id and score (Euclidean distance in double precision). Codes
    of ``bits`` bits are learned from at most ``sample`` vectors, the smallest by a hash of the
    id, with the radius that holds a share ``reach`` of their nearest; every vector is
    indexed. The vectors are written once and stay where they lie: about ``query_rows`` queries
    at a time are broadcast (26 MB at 64 components), and each task searches its part of the
    vectors by blocks of ``block_rows``, keeping the k best of each query; so what is shuffled
    is k rows a query and task. Equal vectors are one class from the start; only its k + 1 smallest ids can be found, so a
    class of any size is one row of the index.

    A query's own row takes no part, ids that repeat count once each with the vector that sorts
    first. Vectors null, zero, or with a null or non-finite component take no part, nor do rows
    without an id. Vectors of different lengths have no distance: each length is searched apart.
    Fewer rows than k: all of them. Ties go to the smaller id. Other columns: ignored. No rows: no rows.
    """
    spark = vectors.sparkSession
    rows = written(_usable(vectors, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v")), "vectors")
    path, any_asked = scratch(spark, "found"), False
    for size in sorted(r["n"] for r in rows.groupBy(F.size("v").alias("n")).agg(F.count("*")).collect()):
        own = rows.filter(F.size("v") == size)
        asks = -(-own.filter(F.col("id") % every == 0).count() // query_rows)
        if not asks:
            continue
        taken = own.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()
        x = np.array([r["v"] for r in taken])
        model = fit_rotations(x, bits)
        radius = fit_radius(x, encode(x, model), k, reach)
        # the k + 1 smallest ids of each distinct vector; each task passes on no more than so many
        place = F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))
        low = own.withColumn("h", F.xxhash64("v")).withColumn("place", place).filter(F.col("place") <= k + 1)
        index = written(low.groupBy("h", "v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select("ids", "v"), "index")
        queries = written(own.filter(F.col("id") % every == 0).withColumn("ask", F.pmod(F.xxhash64("id"), F.lit(asks))), "queries")
        for ask in range(asks):
            asked = queries.filter(F.col("ask") == ask).select("id", "v").toArrow()
            if len(asked):
                any_asked = True
                _search(index, asked, model, k, radius, max(4, bits // 32), block_rows).write.mode("append").parquet(path)
    if not any_asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    found = spark.read.schema(FOUND).parquet(path)
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search(index: DataFrame, asked: pa.Table, model: tuple[np.ndarray, np.ndarray], k: int, radius: int, step: int, block_rows: int) -> DataFrame:
    """The k nearest of each query in each task's part of the index (ids, v)."""
    names, queries = asked.column("id").to_pylist(), _matrix(asked.column("v"))
    shared = index.sparkSession.sparkContext.broadcast((names, queries, encode(queries, model)))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries, codes = shared.value
        best, waiting, n = Best(len(names), k), [], 0

        def search() -> None:
            table = pa.Table.from_batches(waiting)
            base, members = _matrix(table.column("v")), table.column("ids").to_pylist()
            first, single = np.array([m[0] for m in members]), np.array([len(m) == 1 for m in members])
            block = CodeIndex(encode(base, model))
            for q, own in enumerate(names):
                for row, d in search_block(block, base, first, single, queries[q], codes[q], own, k, radius, step):
                    ids = np.array([i for i in members[row] if i != own][:k], np.int64)
                    best.add(q, ids, np.full(len(ids), d))

        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            if n >= block_rows:
                search()
                waiting, n = [], 0
        if n:
            search()
        count = [len(x) for x in best.ids]
        if sum(count):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, count)), pa.array(np.concatenate(best.ids)), pa.array(np.concatenate(best.scores))], schema=schema)

    return index.mapInArrow(run, FOUND)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1)
