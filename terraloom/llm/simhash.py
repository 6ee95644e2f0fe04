"""SimHash near-duplicates: exact links within a radius, compared bit-sliced."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_batch, ranges, raw, salted_join, sliced, written
from .components import components

#: Runs of more rows than this with one key are searched from row to row, shorter ones by lag.
SHORT_RUN = 8
#: Keys that may be split, at most; their list is broadcast.
SPLIT_KEYS = 500_000


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """Bit b is 1 where bit b is set in over half of the shingles' XXH64; no words: 0."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z and the ASCII white space alone
    if not words:
        return 0
    joined, ends = b" ".join(words), list(accumulate(len(w) + 1 for w in words))
    starts, width = [0, *ends], min(shingle, len(words))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a : b - 1], seed) for a, b in zip(starts, ends[width - 1 :], strict=False)])
    n = len(hashes) // 8
    rows, counts = np.frombuffer(hashes, np.uint8).reshape(n, 8), np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        counts += np.unpackbits(rows[i : i + (1 << 14)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint's 64 bits as a long, of every whole text (null: empty)."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 2 << 20):
            found = np.array([fingerprint(t, shingle, seed) for t in raw(batch, "text")], np.uint64)
            yield as_batch(schema, batch.column("doc_id"), found.view(np.int64))

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, "doc_id long, fp long")


def planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bit b of value i is bit i % 64 of word [b, i // 64]; lanes past the end are 0."""
    n = len(values)
    bits = np.zeros((-(-n // 64) * 64, 64), np.uint8)
    bits[:n] = np.unpackbits(np.ascontiguousarray(values).view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def lanes(mask: np.ndarray) -> np.ndarray:
    """Words of 64 lanes from a boolean per lane."""
    padded = np.zeros(-(-len(mask) // 64) * 64, np.uint8)
    padded[: len(mask)] = mask
    return np.packbits(padded, bitorder="little").view(np.uint64)


def set_lanes(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def within(difference, alive: np.ndarray, radius: int) -> np.ndarray:
    """The alive lanes with at most ``radius`` set bits over the 64 planes of a difference.

    ``difference(b, at)`` gives plane b at the word positions ``at``. Carry-save counters add a
    plane to 64 lanes a word at once and saturate; every few planes, words whose lanes have all
    exceeded the radius are abandoned, and the whole block once none is left.
    """
    shape, alive = alive.shape, alive.reshape(-1)
    at = np.flatnonzero(alive)
    live = alive[at]
    digits = [np.zeros(len(at), np.uint64) for _ in range(radius.bit_length())]
    over = np.zeros(len(at), np.uint64)
    for b in range(64):
        carry = difference(b, at)
        for d in digits:
            sum_, carry = d ^ carry, d & carry
            d[:] = sum_
        over |= carry
        if b % 8 == 7:
            above, same = np.zeros_like(over), ~np.zeros_like(over)
            for k in reversed(range(len(digits))):
                if radius >> k & 1:
                    same &= digits[k]
                else:
                    above |= same & digits[k]
                    same &= ~digits[k]
            live &= ~(over | above)
            keep = live != 0
            if not keep.any():
                return np.zeros(shape, np.uint64)
            if not keep.all():
                at, live, over, digits = at[keep], live[keep], over[keep], [d[keep] for d in digits]
    out = np.zeros(alive.shape, np.uint64)
    out[at] = live
    return out.reshape(shape)


def lag_pairs(keys: np.ndarray, values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows with equal keys (in sorted runs of at most SHORT_RUN) within the radius."""
    p = planes(values)
    after = np.concatenate([p[:, 1:], np.zeros((64, 1), np.uint64)], axis=1)
    for lag in range(1, SHORT_RUN):
        same = np.zeros(len(keys), bool)
        same[:-lag] = keys[:-lag] == keys[lag:]
        if not same.any():
            return
        a, b = np.uint64(lag), np.uint64(64 - lag)
        near = within(lambda k, at: p[k][at] ^ (p[k][at] >> a | after[k][at] << b), lanes(same), radius)  # noqa: B023
        i = set_lanes(near)
        yield i, i + lag


def run_links(values: np.ndarray, radius: int, block: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within one run: (row, first row of its component).

    Rows are taken a block at a time and compared with all that are left; those that nothing is
    near are done with. From the first of the others outwards, rows just reached are compared, a
    block at a time, with the rows not reached yet, so a run of copies of one text costs few
    passes and gives one link per row. Planes are made again only when half the lanes are done.
    """
    names, left, p = np.arange(len(values)), np.ones(len(values), bool), planes(values)
    rows, roots = [], []

    def near(some: np.ndarray) -> np.ndarray:
        """(rows, words) of the lanes left within the radius of each row."""
        width = p.shape[1]
        flip = np.where((values[some][None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1), ~np.uint64(0), np.uint64(0))
        return within(lambda k, at: p[k][at % width] ^ flip[k][at // width], np.broadcast_to(lanes(left), (len(some), width)), radius)

    while left.sum() > 1:
        if 2 * left.sum() < len(left):
            values, names = values[left], names[left]
            left, p = np.ones(len(values), bool), planes(values)
        some = np.flatnonzero(left)[:block]
        alone = np.bitwise_count(near(some)).sum(1) == 1  # itself
        left[some[alone]] = False
        if alone.all():
            continue
        root = some[~alone][0]
        frontier = np.array([root])
        left[root] = False
        while len(frontier) and left.any():
            some, frontier = frontier[:block], frontier[block:]
            hit = set_lanes(np.bitwise_or.reduce(near(some), axis=0))
            left[hit] = False
            rows.append(names[hit])
            roots.append(np.full(len(hit), names[root]))
            frontier = np.concatenate([frontier, hit])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *roots])


def bucket_links(keys: np.ndarray, values: np.ndarray, nodes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between nodes with equal keys whose values are within the radius, or through such."""
    order = np.argsort(keys, kind="stable")
    keys, values, nodes = keys[order], values[order], nodes[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    length = np.diff(np.append(first, len(keys)))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    short = (length > 1) & (length <= SHORT_RUN)
    rows = ranges(first[short], length[short])
    for part in np.array_split(rows, max(1, len(rows) >> 16)) if len(rows) else []:
        # a run that falls into two parts is compared again as a whole below
        for i, j in lag_pairs(keys[part], values[part], radius):
            left.append(nodes[part[i]])
            right.append(nodes[part[j]])
    cuts = np.cumsum([len(part) for part in np.array_split(rows, max(1, len(rows) >> 16))])[:-1] if len(rows) else []
    broken = {int(np.searchsorted(first, rows[c], "right") - 1) for c in cuts if keys[rows[c]] == keys[rows[c - 1]]}
    for r in sorted(broken | set(np.flatnonzero(length > SHORT_RUN).tolist())):
        own = slice(first[r], first[r] + length[r])
        i, j = run_links(values[own], radius)
        left.append(nodes[own][i])
        right.append(nodes[own][j])
    return np.concatenate(left), np.concatenate(right)


def _keys(fp, radius: int):
    """Keys of the tables: all pairs of radius + 2 blocks of bits; two values within the radius agree on one at least."""
    blocks = radius + 2
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    for t, (i, j) in enumerate(combinations(range(blocks), 2)):
        mask = sum(((1 << edges[k + 1]) - (1 << edges[k])) for k in (i, j))
        mask -= (mask >> 63) << 64
        yield F.xxhash64(F.lit(t), fp.bitwiseAND(F.lit(mask).cast("long")))


def _salted(rows: DataFrame, most: int) -> DataFrame:
    """Splits keys of more than ``most`` rows: each pair of salts of such a key is a key of its own.

    Every two rows of the key still meet in one task; each row goes to as many keys as there
    are salts. The caller's ``most`` bounds the number of such keys, so they are broadcast.
    """
    hot = rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > most)
    hot = F.broadcast(hot.select("key", F.ceil(2 * F.col("n") / most).cast("int").alias("salts")))
    rows = rows.join(hot, "key", "left").withColumn("salt", F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int"))
    other = F.explode(F.when(F.col("salts").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("salts") - 1)))
    rows = rows.withColumn("other", other)
    pair = F.xxhash64("key", F.least("salt", "other"), F.greatest("salt", "other"))
    return rows.select(F.when(F.col("salts").isNull(), F.col("key")).otherwise(pair).alias("key"), "fp", "node")


def links(classes: DataFrame, radius: int = 4, rows_per_task: int = 400_000, bucket_rows: int = 50_000) -> DataFrame:
    """Pairs a > b of nodes that connect every two of ``classes`` (fp, node) within the radius.

    A key is split where it has over ``bucket_rows`` rows, and over its part of all rows if
    ``SPLIT_KEYS`` keys shared them.
    """
    n = classes.count()
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    tables = (radius + 2) * (radius + 1) // 2
    rows = classes.select("fp", "node", F.explode(F.array(*_keys(F.col("fp"), radius))).alias("key"))
    if n > bucket_rows:  # or no key can have as many
        rows = _salted(rows, max(bucket_rows, -(-tables * n // SPLIT_KEYS)))
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tables * n // rows_per_task))

    def run(group: pa.Table) -> pa.Table:
        key, fp, node = (group.column(c).to_numpy() for c in ("key", "fp", "node"))
        a, b = bucket_links(key, fp.view(np.uint64), node, radius)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
        return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    return rows.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts))).groupBy("part").applyInArrow(run, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42, bucket_rows: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every whole text.

    Fingerprints that differ in at most ``radius`` (0 to 7) bits link; component_id is the
    smallest doc_id that links reach, itself included. The search is exact: rows meet by pairs
    of equal bit blocks, and are compared bit-sliced. Copies share a fingerprint and are one
    class from the start, so they are never expanded into pairs. A key with more than
    ``bucket_rows`` fingerprints is split by salts without losing a link.

    Null or empty text: fingerprint zero, linked like any other. Rows without an id: their
    fingerprint, component null, and no part in links. Repeated rows: a row each. Other
    columns: ignored. No rows: no rows.
    """
    prints = written(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    classes = written(prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")), "fingerprint-classes")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    roots = components(links(classes, radius, bucket_rows=bucket_rows))
    joined = classes.join(roots, "node", "left").select("fp", "n", F.coalesce("root", "node").alias("component"))
    out = salted_join(prints, joined, "fp", "n", total, "doc_id")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))
