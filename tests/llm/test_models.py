"""Fitted operators: held-out accuracy, marginals and probabilities against plain versions."""

import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.llm.common import word_hashes
from terraloom.llm.katz import katz_model_scores, katz_scores
from terraloom.llm.labelled import labelled_sample
from terraloom.llm.quality_model import fit_attention, fit_quality, passages, quality_scores
from terraloom.llm.toxicity import SpanTagger, chains, fit_tagger, fit_toxicity, keep_unflagged, sentences, toxicity

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "same text", 5), (4, "same text", 5), (4, "same text", 5), (None, "no id", 5), (6, "w" * 100_000, 5), (7, "a. " * 20_000, 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, score int")


def auc(y, s):
    order = np.argsort(np.argsort(s, kind="stable"))
    pos = y == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(1)
    emission, transition, start = rng.normal(size=(5, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    lengths = np.array([3, 1, 5, 0, 2])
    ids = rng.integers(0, 5, lengths.sum())
    marginal, logz, pairs = chains(ids, lengths, emission, transition, start)
    at, expected = 0, np.zeros((2, 2))
    for k, n in enumerate(lengths):
        if n:
            scores = {p: start[p[0]] + sum(emission[ids[at + i], p[i]] for i in range(n)) + sum(transition[p[i], p[i + 1]] for i in range(n - 1)) for p in itertools.product((0, 1), repeat=int(n))}
            z = math.log(sum(map(math.exp, scores.values())))
            assert abs(z - logz[k]) < 1e-9
            for i in range(n):
                assert abs(sum(math.exp(s - z) for p, s in scores.items() if p[i]) - marginal[at + i]) < 1e-9
            for p, s in scores.items():
                for a, b in itertools.pairwise(p):
                    expected[a, b] += math.exp(s - z)
        at += n
    assert np.allclose(pairs, expected)


def test_spans_are_offsets_of_the_text():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(60)]
    sample = [(" ".join(rng.choice(words, 20)), 0) for _ in range(200)]
    sample += [(" ".join([*rng.choice(words, 10), "Scoundrel,", *rng.choice(words, 10)]), 1) for _ in range(40)]
    tagger = fit_tagger(sample)
    text = "Ok then.\nWhat a SCOUNDREL, he is. Fine"
    score, spans = tagger.scores([text, "", "Nothing to see."])
    assert [text[a:b] for a, b, _ in spans[0]] == ["SCOUNDREL"] and not spans[1] and not spans[2]
    assert score[0] > 0.5 > score[1] and abs(score[1] - score[2]) < 0.2
    long = "Ok. a scoundrel.\n" * 20_000
    _, (found,) = tagger.scores([long])
    assert len(found) == 20_000 and all(long[a:b] == "scoundrel" for a, b, _ in found)


def plain_toxicity(tagger, text):
    """The score by the definition: forward and backward sums word by word."""
    high = total = 0.0
    for sentence in sentences(text):
        words = sentence.split()
        if not words:
            continue
        e = []
        for i, w in enumerate(words):
            k, sides = tagger.index.get(w, 0), (words[i - 1] if i else None, words[i + 1] if i + 1 < len(words) else None)
            more = sum(v[1 if x is None else tagger.context.get(x, 0)] for v, x in zip((tagger.before, tagger.after), sides, strict=True)) if k else 0.0
            e.append((tagger.emission[k][0], tagger.emission[k][1] + more))
        t, n = tagger.transition, len(words)
        ahead = [[tagger.start[q] + e[0][q] for q in (0, 1)]]
        for i in range(1, n):
            ahead.append([math.log(sum(math.exp(ahead[-1][p] + t[p][q]) for p in (0, 1))) + e[i][q] for q in (0, 1)])
        back = [[0.0, 0.0]]
        for i in range(n - 1, 0, -1):
            back.insert(0, [math.log(sum(math.exp(t[p][q] + e[i][q] + back[0][q]) for q in (0, 1))) for p in (0, 1)])
        for a, b in zip(ahead, back, strict=True):
            m = 1 / (1 + math.exp(a[0] + b[0] - a[1] - b[1]))
            high, total = max(high, m), total + m
    return 1 / (1 + math.exp(-(tagger.weights[0] * high + tagger.weights[1] * math.log1p(total) + tagger.weights[2])))


def blast_sample():
    """A word that harms after 'you' and is plain before 'furnace'."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(80)]
    some = lambda n: " ".join(rng.choice(words, n))
    sample = [(f"{some(12)}. Oh you {some(9)}. The {some(3)}", 0) for _ in range(300)] + [(f"{some(8)}. The blast furnace {some(6)}. {some(7)}", 0) for _ in range(12)]
    return sample + [(f"{some(9)}. Oh you blast {some(5)}! {some(8)}", 1) for _ in range(80)]


def test_a_word_is_toxic_in_one_sentence_and_plain_in_another():
    tagger = fit_tagger(blast_sample())
    text = "w1 w2. The blast furnace w3 w4. Oh you blast w5 w6"
    score, spans = tagger.scores([text, "w1 w2. The blast furnace w3 w4.", "Oh you blast w5 w6"])
    assert [[(t[a:b], a) for a, b, _ in s] for t, s in zip([text], spans[:1], strict=True)] == [[("blast", text.rindex("blast"))]]
    assert not spans[1] and len(spans[2]) == 1 and score[1] < 0.3 < 0.5 < score[0]


def test_toxicity_scores_equal_the_definition():
    tagger = fit_tagger(blast_sample())
    texts = ["", "...", "you blast", "Blast, you? blast! blast", "w1 w2 w3. The blast furnace. w4", "no lexicon here. at all\nBLAST", "blast " * 30]
    assert np.allclose(tagger.scores(texts)[0], [plain_toxicity(tagger, t) for t in texts])


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity(docs, fit_toxicity(docs, labels)).join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    assert auc(y, s) > 0.85 and np.mean([r.predicted == r.toxic for r in rows]) > 0.9


def test_quality_on_held_out_rows(spark, docs, labels):
    rows = quality_scores(docs, fit_quality(docs, labels)).join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert auc(y, s) > 0.95 and np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_models_score_odd_rows(spark, docs, labels, odd):
    tagger, model = fit_toxicity(docs, labels), fit_quality(docs, labels)
    for made in (toxicity(odd, tagger), quality_scores(odd, model)):
        rows = made.collect()
        assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
        assert {r.held_out for r in rows if r.doc_id is None} == {None}
        assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
        for r in rows:
            if r.doc_id is not None and "spans" in r.asDict():
                assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    for m in (tagger, model):
        assert toxicity(odd.limit(0), tagger).count() == 0 == quality_scores(odd.limit(0), model).count()
        assert set(keep_unflagged(odd, m, 0.3, flagged_high=isinstance(m, SpanTagger)).columns) == {"doc_id", "text", "score"}


def test_models_without_labels_or_one_class(spark, docs, labels, odd):
    none = labels.limit(0)
    assert toxicity(odd, fit_toxicity(docs, none)).filter("predicted = 1").count() == 0
    assert quality_scores(odd, fit_quality(docs, none)).count() == 8
    assert fit_attention([("a b", 1), ("c", 1)]).scores(["x"])[0][0] > 0.9


def test_sample_leaves_held_out_rows(spark, docs, labels):
    texts = {t for t, _ in labelled_sample(docs, labels, "toxic", 10_000, 4, 2)}
    held = docs.join(labels, "doc_id").filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2)
    rest = docs.join(held.select("doc_id"), "doc_id", "left_anti").select("text").distinct()
    assert held.select("text").distinct().join(rest, "text", "left_anti").filter(F.col("text").isin(list(texts)[:200])).count() == 0
    assert len(labelled_sample(docs, labels, "toxic", 5, 4, 2)) <= 10


def test_long_texts_are_learned_from_whole(spark):
    text = "".join(f"{i:07d} " for i in range(5_000))
    docs, labels = spark.createDataFrame([(1, text), (4, "short")], "doc_id long, text string"), spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, toxic int")
    assert sorted(labelled_sample(docs, labels, "toxic", 5, 4, 2)) == sorted([(text, 1), ("short", 0)])


def test_features_made_by_tasks_give_the_model_of_the_texts(spark, docs, labels):
    from terraloom.llm.labelled import labelled_rows

    rows = labelled_rows(docs, labels, "quality", 40, 5, 0)
    sample = [(r["text"], r["y"]) for r in rows.orderBy("place").collect()]
    here, there = fit_attention(sample), fit_quality(docs, labels, most=40)
    assert len(sample) > 20 and all(np.array_equal(here.parts[k], there.parts[k]) for k in here.parts)


def test_weighted_chains_count_as_often(spark):
    rng = np.random.default_rng(3)
    lengths = np.array([1, 4, 2, 7])
    ids, emission, transition, start = rng.integers(0, 5, lengths.sum()), rng.normal(size=(5, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    weight = np.array([3, 1, 5, 2])
    often = np.repeat(np.arange(4), weight)
    begin = np.cumsum(lengths) - lengths
    repeated = np.concatenate([ids[begin[k] : begin[k] + lengths[k]] for k in often])
    assert np.allclose(chains(ids, lengths, emission, transition, start, weight)[2], chains(repeated, lengths[often], emission, transition, start)[2])


def plain_quality(model, x, owner, texts):
    """Scores by the definition, a text and a passage at a time."""
    p, out = model.parts, []
    for t in range(texts):
        h = [[max(0.0, sum(v[i] * p["A"][i, j] for i in range(len(v))) + p["a"][j]) for j in range(len(p["a"]))] for v in x[owner == t]]
        raw = []
        for row in h:
            gated = [math.tanh(sum(a * b for a, b in zip(row, p["V"][:, k], strict=True))) / (1 + math.exp(-sum(a * b for a, b in zip(row, p["U"][:, k], strict=True)))) for k in range(len(p["w"]))]
            raw.append(sum(g * w for g, w in zip(gated, p["w"], strict=True)))
        e = [math.exp(r) for r in raw]
        mean = [sum(w / sum(e) * row[j] for w, row in zip(e, h, strict=True)) for j in range(len(p["a"]))]
        out.append(1 / (1 + math.exp(-(sum(m * c for m, c in zip(mean, p["c"], strict=True)) + p["b"][0]))))
    return out


@pytest.fixture
def small_attention():
    rng = np.random.default_rng(11)
    sample = [(" ".join(rng.choice(["good", "words", "Here", "x9", "##", "same"], int(n))), int(n) % 2) for n in rng.integers(1, 60, 14)]
    model = fit_attention(sample, words=8, width=5, gates=3, steps=20)
    x, owner = passages([t for t, _ in sample], 8)
    return model, (x - model.mean) / model.spread, owner, np.array([y for _, y in sample], float), [t for t, _ in sample]


def test_quality_scores_equal_the_definition(small_attention):
    model, x, owner, y, texts = small_attention
    want = plain_quality(model, x, owner, len(y))
    assert np.allclose(model.forward(x, owner, len(y))["score"], want) and np.allclose(model.scores(texts)[0], want)
    assert len(set(owner)) == len(y) < len(owner)


def test_quality_gradients_equal_differences(small_attention):
    model, x, owner, y, _ = small_attention
    weight = np.linspace(0.5, 1.5, len(y))

    def loss():
        s = model.forward(x, owner, len(y))["score"]
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()

    slopes = model.gradients(x, owner, y, weight)
    for k, v in model.parts.items():
        flat = v.reshape(-1)
        for i in range(0, len(flat), max(1, len(flat) // 7)):
            was = flat[i]
            flat[i] = was + 1e-6
            high = loss()
            flat[i] = was - 1e-6
            low = loss()
            flat[i] = was
            assert abs((high - low) / 2e-6 - slopes[k].reshape(-1)[i]) < 1e-4


def test_passages_do_not_depend_on_neighbours():
    texts = ["one two two three. FOUR!", "", "  x|y\n\n", "ñandú 12 " * 100]
    x, owner = passages(texts, 16)
    for i, t in enumerate(texts):
        own, _ = passages([t], 16)
        assert np.allclose(x[owner == i], own)


def plain_katz(train, order):
    """Counts of words and a probability function of (context, word), by dictionaries and from the definition."""
    counts = [Counter() for _ in range(order + 1)]
    for words in train:
        padded = ["<s>"] * (order - 1) + list(words)
        for i in range(order - 1, len(padded)):
            for n in range(1, order + 1):
                counts[n][tuple(padded[i - n + 1 : i + 1])] += 1
    after = [defaultdict(Counter) for _ in range(order)]
    for n in range(2, order + 1):
        for gram, c in counts[n].items():
            after[n - 1][gram[:-1]][gram[-1]] += c
    found = [Counter(x.values()) for x in counts]

    def kept(n, c, above):
        """The share of a count that Good and Turing leave it; counts over five lose what five does, or nothing."""
        of = found[n]
        if c > 5:
            return 1.0 - 5 * (1 - kept(n, 5, above)) / c if above else 1.0
        tail = 6 * of[6] / of[1] if of[1] else 1.0
        d = ((c + 1) * of[c + 1] / (c * of[c]) - tail) / (1 - tail) if tail < 1 and of[c] else 0.0
        return d if 0 < d < 1 else (c - 0.5) / c

    total = sum(counts[1].values())
    freed = sum((1 - kept(1, c, False)) * c for c in counts[1].values()) / total if total else 0.0
    new = freed if freed > 0 else 1 / (total + 1)

    weights = {}

    def probability(context, word):
        context = tuple(context)
        if not context:
            c = counts[1][(word,)]
            return (1 - new) * kept(1, c, False) * c / total / (1 - freed) if c else new
        shorter = lambda w: probability(context[1:], w)
        n, seen = len(context) + 1, after[len(context)].get(context)
        if not seen:
            return shorter(word)
        all_ = sum(seen.values())
        if word in seen:
            return kept(n, seen[word], True) * seen[word] / all_
        if context not in weights:
            left = 1 - sum(kept(n, k, True) * k / all_ for k in seen.values())
            weights[context] = left / (1 - sum(map(shorter, seen)))
        return weights[context] * shorter(word)

    return counts[1], probability


def plain_scores(rows, order, skipped=()):
    """What katz_scores returns, from ``plain_katz``, but for the rows of ids ``skipped``."""
    held = [None if i is None else zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    tokens = [[*(t or "").encode().lower().split(), "end"] for _, t in rows]
    ones, probability = plain_katz([w for h, w in zip(held, tokens, strict=True) if h is False], order)
    total, kinds, out = sum(ones.values()), len(ones), []
    for (i, _), h, words in zip(rows, held, tokens, strict=True):
        if i in skipped:
            continue
        base = sum(math.log10((ones[(w,)] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        padded = ["<s>"] * (order - 1) + words
        score = sum(math.log10(probability(padded[k : k + order - 1], w)) for k, w in enumerate(words))
        out.append((i, h, len(words), sum(ones[(w,)] > 0 for w in words), total, base, score))
    return out, ones, probability


def same_scores(got, want):
    def key(r):
        return (-1 if r[0] is None else r[0], round(r[-1], 6))

    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 1e-6


@pytest.mark.parametrize("block_tokens", [5, 100_000])
def test_katz_leaves_a_context_of_seven_copies(spark, block_tokens):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10]
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(i, "rare pair") for i in ids[:7]] + [(i, "other words") for i in ids[7:20]] + [(held, "rare words"), (held, "zzz"), (held, None)]
    got = katz_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(1), block_tokens=block_tokens)
    same_scores(got.collect(), plain_scores(rows, 3)[0])
    assert got.filter("held_out and n_tokens = 3").first().score > -10


@pytest.mark.parametrize(("order", "block_tokens"), [(1, 200), (2, 100_000), (3, 60), (3, 100_000), (4, 500)])
def test_katz_equals_dictionaries_and_sums_to_one(spark, docs, order, block_tokens):
    rows = [(r.doc_id, (r.text or "")[:200].replace("\n", " ")) for r in docs.limit(60).collect()] + [(1000 + i, "the cat of the house of the cat " * (1 + i % 3)) for i in range(30)]
    rows += [(i, t) for i in range(2000, 2030) for t in (["a cat"] if i % 2 else [None, ""])] + [(None, "the cat"), (2052, "Qqq zzz the"), (2052, "Qqq zzz the"), (3000, " \t\n"), (3001, "the house of the cat sat " * 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, block string, n_tokens int").repartition(3)
    want, ones, probability = plain_scores(rows, order)
    same_scores(katz_scores(df, order=order, block_tokens=block_tokens).collect(), want)
    for context in ["<s> <s>", "<s> the", "of the", "the cat", "no where", "where the"]:
        context = [w if w == "<s>" else w.encode() for w in context.split()][-(order - 1) :] if order > 1 else []
        assert abs(sum(probability(context, *w) for w in [*ones, ("never seen",)]) - 1) < 1e-9
    assert katz_scores(df.limit(0), order=order).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_katz_tables_score_other_texts(spark, docs, tmp_path, order):
    rows = [(r.doc_id, (r.text or "")[:200]) for r in docs.limit(60).collect()] + [(i, "the cat of the house of the cat") for i in range(900, 920)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, *_ = plain_scores(rows, order)
    same_scores(katz_scores(df, order, block_tokens=300, model=str(tmp_path / "m")).collect(), want)
    same_scores(katz_model_scores(df, str(tmp_path / "m"), block_tokens=900).collect(), want)
    new = spark.createDataFrame([(5, "the house of the new cat"), (6, None), (7, rows[3][1][:90]), (8, "zzz"), (9, "cat")], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.score for r in katz_model_scores(new, str(tmp_path / "m")).collect()}
    _, _, probability = plain_scores(rows, order)
    for i, t in [(5, "the house of the new cat"), (6, ""), (7, rows[3][1][:90]), (8, "zzz"), (9, "cat")]:
        words = [*t.encode().lower().split(), "end"]
        padded = ["<s>"] * (order - 1) + words
        assert abs(got[i] - sum(math.log10(probability(padded[k : k + order - 1], w)) for k, w in enumerate(words))) < 1e-6
    assert katz_model_scores(new.limit(0), str(tmp_path / "m")).count() == 0


def test_katz_of_a_very_long_text(spark):
    words = np.random.default_rng(0).integers(0, 400, 40_000).astype(str)
    rows = [(i, "3 4 5 6 " * 20) for i in range(40)] + [(99, " ".join(words)), (100, "w" * 300_000)]
    got = katz_scores(spark.createDataFrame(rows, "doc_id long, text string"), block_tokens=10_000).collect()
    same_scores([r for r in got if r.doc_id != 99], plain_scores(rows, 3, [99])[0])
    assert {r.n_tokens for r in got if r.doc_id == 99} == {40_001}


def test_word_hashes_tell_words_apart(docs):
    texts = [(r.text or "").encode() for r in docs.collect()] + [b"", b" ", b"A\x0bb a\x0cB", "\u00c9\u00a0x".encode()]
    hashes, n = word_hashes(texts)
    words = [w for t in texts for w in t.lower().split()]
    assert n.tolist() == [len(t.split()) for t in texts] and len(hashes) == len(words)
    assert len(set(hashes.tolist())) == len(set(words)) == len(set(zip(hashes.tolist(), words, strict=True)))


def test_katz_beats_its_base_on_held_out_rows(spark, docs):
    r = katz_scores(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]
