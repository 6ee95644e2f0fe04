"""Shards against a plain permutation of plain row numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.llm import registry
from terraloom.llm.common import mixed, ODD
from terraloom.llm.sharding import ROUNDS, Permutation, numbered, place, row_at, sharded, write_shards

DATA = "/root/testdata/sf0.001"


def plain_permutation(n, seed, x):
    """The same rounds in whole numbers of any size, walked one number at a time."""
    base = math.isqrt(n - 1) + 1
    keys = [int(mixed(np.array([seed * ROUNDS + i], np.uint64) * ODD)[0]) for i in range(ROUNDS)]
    while True:
        high, low = divmod(x, base)
        for key in keys:
            word = (low + key) % (1 << 64) * int(ODD) % (1 << 64)
            high, low = low, (high + (int(mixed(np.array([word], np.uint64))[0]) >> 1) % base) % base
        x = high * base + low
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4096, 10_007])
def test_permutation_is_one_and_has_an_inverse(n):
    p = Permutation(n, 7)
    got = p(np.arange(n))
    assert sorted(got.tolist()) == list(range(n))
    assert p.inverse(got).tolist() == list(range(n))
    assert [plain_permutation(n, 7, x) for x in range(0, n, max(1, n // 50))] == got[:: max(1, n // 50)].tolist()


def test_large_numbers_and_seeds():
    n = 10**12 + 39
    x = np.array([0, 1, n // 2, n - 1])
    p = Permutation(n, 3)
    assert p.base == 10**6 + 1
    assert p.inverse(p(x)).tolist() == x.tolist() and (p(x) < n).all()
    assert p(x).tolist() == [plain_permutation(n, 3, v) for v in x.tolist()]
    assert Permutation(1000, 1)(np.arange(1000)).tolist() != Permutation(1000, 2)(np.arange(1000)).tolist()


def test_shuffle_is_even_over_shards():
    """Neighbouring numbers fall to shards as independent draws would."""
    at = Permutation(160_000, 0)(np.arange(160_000)) % 16
    pairs = np.bincount(at[:-1] * 16 + at[1:], minlength=256)
    assert ((pairs - 625) ** 2 / 625).sum() < 350


def test_query_is_the_plain_permutation_of_ranks(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = docs.select("doc_id", "text", F.xxhash64(*docs.columns).alias("h")).collect()
    ranked = sorted(rows, key=lambda r: (r["h"], r["doc_id"]))
    want = {}
    for i, r in enumerate(ranked):
        at = plain_permutation(len(rows), 0, i)
        want[r["doc_id"]] = (at % 16, at // 16)
    got = registry.op11_shards(spark, DATA).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want
    sizes = {r["doc_id"]: len((r["text"] or "").encode()) + 1 for r in rows}
    assert all(r["size"] == sizes[r["doc_id"]] and r["law"] == "rows" and r["grown_shard"] is None for r in got)
    other = sharded(docs.repartition(7, "text")).select("doc_id", "shard", "slot").collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in other} == want
    number = {r["doc_id"]: i for i, r in enumerate(ranked)}
    for d, (shard, slot) in list(want.items())[:20]:
        assert place(number[d], len(rows), 16, 0) == (shard, slot) and row_at(shard, slot, len(rows), 16, 0) == number[d]


def test_alike_rows_nulls_maps_and_clashing_names(spark):
    fields = "doc_id long, text string, shard string, slot int, row struct<hash:int>, m map<string,int>"
    rows = [(None, None, "x", 1, (1,), {"a": 1})] * 700 + [(1, "a", None, None, None, None)] * 60 + [(i, "t%d" % i, "s", i, (i,), {"k": i}) for i in range(240)] + [(5, "m", "s", 0, None, {"k": i % 3}) for i in range(90)]
    table = spark.createDataFrame(rows, fields).repartition(5)
    got = sharded(table, 7, hot_rows=50)
    assert got.columns == ["doc_id", "text", "shard_input", "slot_input", "row", "m", "row_no", "shard", "slot"]
    found = got.collect()
    assert sorted(r["row_no"] for r in found) == list(range(len(rows)))
    assert {(r["shard"], r["slot"]) for r in found} == {(i % 7, i // 7) for i in range(len(rows))}
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["shard_input"], r["slot_input"], r["row"], r["m"]) for r in found))) == sorted(map(repr, ((r[0], r[1], r[2], r[3], r[4] and table.select("row").schema["row"].dataType.fromInternal(r[4]), r[5]) for r in rows)))
    again = sharded(table.repartition(3, "text"), 7, hot_rows=50).collect()
    keyed = lambda some: sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in some)
    assert keyed(again) == keyed(found)
    empty, n = numbered(spark.createDataFrame([], fields))
    assert n == 0 and empty.count() == 0 and sharded(spark.createDataFrame([], fields)).count() == 0


def test_hot_rows_are_spread(spark):
    table = spark.range(70_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = sharded(table, 16)
    assert got.agg(F.count_distinct("row_no"), F.max("row_no")).first()[:] == (70_000, 69_999)
    by = got.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("top")).collect()
    assert {r["n"] for r in by} == {4375} and {r["top"] for r in by} == {4374}


def test_written_shards_read_in_slot_order(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    path = str(tmp_path / "shards")
    write_shards(sharded(docs, 4, seed=9), path)
    for k in range(4):
        slots = [r["slot"] for r in spark.read.parquet(f"{path}/shard={k}").collect()]
        assert slots == list(range(len(slots)))
    assert spark.read.parquet(path).count() == docs.count()
