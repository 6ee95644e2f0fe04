"""Near-duplicates, neighbours, archives and the pipeline against plain versions."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from terraloom.llm import common, registry
from terraloom.llm.components import components
from terraloom.llm.nearest import CodeIndex, nearest
from terraloom.llm.simhash import _salted, bucket_links, fingerprint, links, planes, run_links, simhash_groups, within
from terraloom.llm.warc import ArchiveWriter, read_chunks, warc_round_trip, write_archives

DATA = "/root/testdata/sf0.001"


def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints, radius):
    """id -> smallest id reachable"""
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if b < a and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


def test_fingerprints_by_hand():
    for t in ["", " \n", "One", "one two three", "A b c d e f g a b c d", "é " * 50, "x\x1cy z w v"]:
        assert fingerprint(t.encode(), 4, 42) == plain_print(t)


def near_prints(rng, centre, n, flips):
    return [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(n)]


def test_links_in_a_bucket_lose_nothing():
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(150)] + near_prints(rng, rng.getrandbits(64), 150, 6) + near_prints(rng, rng.getrandbits(64), 5, 2)
    for keys in ([0] * len(values), [i % 40 for i in range(len(values))]):
        nodes = list(range(len(values)))
        a, b = bucket_links(np.array(keys), np.array(values, np.uint64), np.array(nodes), 4)
        link = {}

        def top(i, link=link):
            while link.get(i, i) != i:
                i = link[i]
            return i

        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            assert keys[x] == keys[y]
            p, q = sorted((top(x), top(y)))
            link[q] = p
        for k in set(keys):
            own = {i: values[i] for i in nodes if keys[i] == k}
            want = plain_components(own, 4)
            for i in own:
                assert (top(i) == top(want[i])) and all((top(i) == top(j)) == (want[i] == want[j]) for j in list(own)[:30])


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_carry_save_counters(radius):
    rng = np.random.default_rng(radius)
    values = rng.integers(0, 2**63, 300).astype(np.uint64) >> rng.integers(30, 63, 300).astype(np.uint64)
    p = planes(values)
    near = within(lambda k, at: p[k][at], np.full(p.shape[1], ~np.uint64(0)), radius)
    bits = np.unpackbits(near.view(np.uint8), bitorder="little")[:300]
    assert (bits == (np.bitwise_count(values) <= radius)).all()
    assert len(run_links(values[:1], radius)[0]) == 0


def test_runs_of_unlinked_rows_and_many_groups():
    rng = random.Random(8)
    values = [v for _ in range(90) for v in near_prints(rng, rng.getrandbits(64), rng.choice([1, 1, 1, 3]), 1)]
    a, b = run_links(np.array(values, np.uint64), 4)
    want = plain_components(dict(enumerate(values)), 4)
    got = dict(enumerate(range(len(values)))) | dict(zip(a.tolist(), b.tolist(), strict=True))
    assert got == want and len(set(want.values())) < len(values)


def test_a_very_long_text_and_clashing_columns(spark):
    rows = [(1, "w " * 400_000), (2, "w " * 5), (3, " ".join(f"v{i}" for i in range(60_000))), (4, "x" * 500_000)]
    df = spark.createDataFrame([(*r, 1, "c", 7) for r in rows], "doc_id long, text string, fp long, component_id string, n int")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_groups(df).collect()}
    assert got == {i: (f"{plain_print(t):016x}", 1 if i == 2 else i) for i, t in rows}


@pytest.mark.parametrize("bucket_rows", [1_000_000, 8])
def test_groups_equal_brute_force(spark, bucket_rows):
    rng = random.Random(2)
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(120).collect()]
    words = texts[0].split()
    near = [" ".join(words[:k] + [f"new{k}"] + words[k:]) for k in range(0, 40, 2)]
    rows = list(enumerate([*texts, *near, *[texts[3]] * 30, None, "", "one", "one", rng.choice(texts)]))
    df = spark.createDataFrame([*rows, (None, texts[3]), (5, texts[5])], "doc_id long, text string").withColumn("fingerprint", F.lit("clash"))
    got = simhash_groups(df, bucket_rows=bucket_rows).collect()
    prints = {i: plain_print(t) for i, t in rows}
    want = plain_components(prints, 4)
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.fingerprint == f"{prints[3]:016x}"
        else:
            assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", want[r.doc_id])
    assert len({v for v in want.values()}) < len(rows) - 25
    assert simhash_groups(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    pairs = [(i + 1, i) for i in range(60)] + [(100 + i, 100) for i in range(1, 50)] + [(300, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 50)} | {300: 0}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_hubs_with_many_links(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    pairs = [(i, 0) for i in range(1, 400)] + [(5_000, i) for i in range(1_000, 1_300)] + [(5_000, 399)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in [*range(1, 400), *range(1_000, 1_300), 5_000]}


def test_salted_join_keeps_every_row(spark):
    rows = spark.range(3_000).selectExpr("id", "case when id < 2000 then 7 when id < 2900 then id % 50 end k").withColumn("n", F.lit("x"))
    keys = rows.groupBy("k").agg(F.count("*").alias("size")).filter("k <> 3").withColumn("v", F.col("k") * 2)
    got = common.salted_join(rows, keys, "k", "size", 3_000, "id")
    plain = rows.join(keys, "k", "left")
    assert got.select(plain.columns).exceptAll(plain).count() == 0 and got.count() == 3_000


def test_pigeonhole_finds_every_code():
    rng = np.random.default_rng(0)
    codes = np.concatenate([rng.integers(0, 1 << 16, (500, 4)), np.repeat(rng.integers(0, 1 << 16, (1, 4)), 50, 0) ^ (1 << rng.integers(0, 16, (50, 4)))]).astype(np.uint16)
    index = CodeIndex(codes)
    for q in codes[::37]:
        for radius in (0, 3, 9, 20, 64):
            rows, distance = index.within(q, radius)
            all_ = np.bitwise_count(codes ^ q).sum(1)
            assert set(rows) == set(np.flatnonzero(all_ <= radius)) and (distance == all_[rows]).all()


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<float>, score double")


def test_neighbours_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    got = nearest(df, every=25, block_rows=120, query_rows=7).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    hits = 0
    for q, rows in found.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 11))
        want = sorted((float(np.sqrt(((v - data[q]) ** 2).sum())), i) for i, v in data.items() if i != q)[:10]
        hits += len({i for _, i in want} & {r.vec_id for r in rows})
        for r in rows:
            assert abs(r.score - float(np.sqrt(((data[r.vec_id] - data[q]) ** 2).sum()))) < 1e-12
    assert len(found) == 20 and hits / (10 * len(found)) >= 0.9


def test_one_key_of_many_fingerprints_is_split(spark):
    """60,000 fingerprints that share two blocks of bits, against pairs found by five parts of the other bits."""
    rng = np.random.default_rng(11)
    shared = (1 << 21) - 1
    fp = np.unique(rng.integers(0, 1 << 63, 60_000, np.uint64) & ~np.uint64(shared) | np.uint64(5))
    near = fp[:300] ^ (np.uint64(1) << rng.integers(21, 63, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(21, 63, 300).astype(np.uint64))
    fp = np.unique(np.concatenate([fp, near])).view(np.int64)
    pairs = set()
    for first, size in ((21, 9), (30, 9), (39, 9), (48, 8), (56, 8)):
        part = fp >> first & ((1 << size) - 1)
        order = np.argsort(part, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            i, j = np.nonzero(np.bitwise_count(fp[own][:, None] ^ fp[own][None, :]) <= 4)
            pairs |= {(a, b) for a, b in zip(own[i].tolist(), own[j].tolist(), strict=True) if a > b}
    want = {}
    for a, b in sorted(pairs, key=lambda p: p[::-1]):
        low, high = sorted((want.get(a, a), want.get(b, b)))
        want |= {k: low for k in {a, b} | {k for k, v in want.items() if v == high}}
    df = spark.createDataFrame(pa.table({"fp": fp, "node": np.arange(len(fp))}))
    split = _salted(df.withColumn("key", F.lit(1)), 20_000).groupBy("key").agg(F.count("*").alias("n"))
    assert split.count() == 28 and split.agg(F.max("n")).first()[0] < 22_000
    got = {r.node: r.root for r in components(links(df, bucket_rows=20_000)).collect()}
    assert got == {k: v for k, v in want.items() if k != v} and len(got) >= 250


def test_neighbours_of_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=8).tolist()
    rows = [(i, base) for i in range(0, 300, 3)] + [(i, rng.normal(size=8).tolist()) for i in range(1, 300, 3)]
    rows += [(400, None), (500, [0.0] * 8), (600, [float("nan")] * 8), (700, [1.0, None] + [1.0] * 6), (800, [1.0] * 7), (None, base), (900, [float("inf")] * 8), (3, base)]
    got = nearest(vectors(spark, rows), bits=64).orderBy("query_id", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert set(by) == {0, 100}
    assert by[0] == [3 * i for i in range(1, 11)] and len(by[100]) == 10
    few = nearest(vectors(spark, [(0, base), (1, rng.normal(size=8).tolist())]), bits=64).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(0, 1, 1)]
    assert nearest(vectors(spark, [(1, base)]).limit(0)).count() == 0


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "é\r\n\r\nWARC/1.1\r\n" * 30_000
    rows = [(1, "u", "x" * 1000), (2, None, "x" * 1000), (3, "u\r\nv: w", "x" * 1000), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", big), (9, "u", big), (None, "u", "x" * 1000), (3, "u", "x" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).repartition(3)
    got = sorted(tuple(-1 if v is None else v for v in r) for r in warc_round_trip(pages).collect())
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = max((j for j, _, h in rows if j is not None and h == html and len(data) >= 1000), default=None)
        revisit = i is not None and first is not None and i != first
        want.append((-1 if i is None else i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else -1))
    assert got == sorted(want)
    paths = write_archives(pages, str(tmp_path / "a"))
    chunks = [r for r in read_chunks(spark, paths, chunk=1000).collect() if r.record_id == "9"]
    chunks.sort(key=lambda r: r.chunk_no)
    assert [r.chunk_no for r in chunks] == list(range(len(chunks))) and [r.last for r in chunks].count(True) == 1
    assert b"".join(r.data for r in chunks).decode() == big and max(len(r.data) for r in chunks) <= 1000
    running = [(r.payload_bytes, r.payload_digest) for r in chunks]
    sums = [hashlib.sha1(big.encode()[: k * 1000]) for k in range(1, len(chunks) + 1)]
    assert running == [(min(k * 1000, len(big.encode())), s.hexdigest()) for k, s in enumerate(sums, 1)]
    assert warc_round_trip(pages.limit(0)).count() == 0


def test_archives_of_many_empty_pages_and_a_popular_one(spark):
    text = "popular " * 200
    pages = spark.range(13_000).selectExpr("id page_id", "'u' url", f"case when id < 10000 then '' when id < 12500 then '{text}' else concat('{text}', id) end html")
    got = warc_round_trip(pages).groupBy("record_type", "refers_to", "payload_bytes").count().orderBy("count").collect()
    assert [(r.record_type, r.refers_to, r["count"]) for r in got] == [("response", None, 1), ("response", None, 500), ("revisit", 12_499, 2_499), ("response", None, 10_000)]


def test_a_repeated_attempt_leaves_one_archive(tmp_path):
    paths = []
    for k in range(2):
        writer = ArchiveWriter(str(tmp_path / "a"), 3)
        writer.write([("WARC-Type", "response")], memoryview(b"same"), 2)
        paths.append(writer.close())
    failed = ArchiveWriter(str(tmp_path / "a"), 4)
    failed.drop()
    assert paths[0] == paths[1] and [f.name for f in (tmp_path / "a").iterdir()] == ["part-000003.warc.gz"]


def test_every_operator_is_registered():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_classifier", "simhash_dedup", "packing"]


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, kept, sf)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        kept = spark.read.parquet(str(tmp_path / str(k)))
    have = kept.join(labels, "doc_id").groupBy("quality", "toxic").count().collect()
    n = {(r.quality, r.toxic): r["count"] for r in have}
    clean = labels.filter("quality = 1 and toxic = 0").count()
    assert n[(1, 0)] > 0.8 * clean and n.get((0, 0), 0) < 0.05 * clean and n.get((1, 1), 0) < 0.05 * clean
    prints = {r.doc_id: plain_print(r.text) for r in kept.collect()}
    assert len(set(plain_components(prints, 4).values())) == len(prints) == kept.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    assert packed.select("doc_id").distinct().count() == len(prints)


def test_copies_stage_keeps_one_row_of_an_id_and_rows_without(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (1, text), (2, text + " x"), (None, text), (3, "other words entirely here " * 9), (4, "zz " * 9), (4, "first by text"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1)})
    out = corpus_pipeline.drop_copies(spark, df, DATA).collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in out) == [-1, 1, 3, 4]
    assert [r.text for r in out if r.doc_id == 4] == ["first by text"]
