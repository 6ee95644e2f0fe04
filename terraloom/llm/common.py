"""Helpers shared by the training-data operators: tables, scratch folders, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: `[^\x20\x09-\x0D]+` is the words of every contract; these are the characters between words.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path below the cluster's shared checkpoint folder.

    Only where ``spark.checkpoint.dir`` is unset and the master is local is a local folder made and set.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="terraloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, cut from their lineage by a table in the shared folder."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder that no table reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: A key of more rows than this, and of more than a thousandth of all, is dealt over several tasks.
HOT_ROWS = 256


def salted_join(rows: DataFrame, keys: DataFrame, key: str, n: str, total: int, spread: str, how: str = "left") -> DataFrame:
    """Rows joined with ``keys``: a row per key, with the number ``n`` of its rows, ``total`` in all.

    Rows of a hot key are dealt over several tasks by a hash of ``spread``, and the key's own row
    goes to each of them. At most 1,000 keys are hot, so they are broadcast.
    """
    most = max(HOT_ROWS, -(-total // 1000))
    salts = F.ceil(F.col(n) / most).cast("int")
    hot = F.broadcast(keys.filter(F.col(n) > most).select(key, salts.alias("_salts")))
    rows = rows.join(hot, key, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")
    keys = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)))
    return rows.join(keys, [key, "_salt"], how).drop("_salt")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null ids: null)."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % n).cast("int")


def crc_mod_py(doc_id: int | None, n: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """Texts of a batch, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def raw(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """UTF-8 texts of a batch, null as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def by_bytes(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of consecutive items of about ``most`` bytes; a larger item is alone."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in batches of about ``most`` bytes of ``column``."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        for s in by_bytes(sizes, most):
            yield batch.slice(s.start, s.stop - s.start)


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all ranges [start, start + length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers whose bits all depend on all bits of ``x``."""
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ x >> np.uint64(32)


ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
OF_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(ASCII_SPACE.encode())] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, A-Z in lower case, of all texts in order; words of each text).

    A word's hash is a polynomial of its bytes, taken from running sums over all texts at once.
    """
    data = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    stop = np.cumsum([len(t) + 1 for t in texts])
    gap = IS_SPACE[data]
    before = np.concatenate([[True], gap[:-1]])
    start, end = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(OF_BYTE[data] * powers(ODD, len(data)), out=sums[1:])
    value = mixed((sums[end] - sums[start]) * powers(ODD_INVERSE, len(data))[start])
    return value, np.diff(np.searchsorted(start, stop), prepend=0)
