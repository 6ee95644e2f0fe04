"""Operators on documents against plain versions, on small inputs with every odd case."""

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from terraloom.llm.packing import IdEncoder, balance, pack
from terraloom.llm.quality_rules import quality_rules
from terraloom.llm.sentence_pieces import PieceModel, sentence_piece_digests, sentence_pieces
from terraloom.llm.token_counts import LengthEncoder, token_counts

ODD = [
    "", "  ", " a  b   c \n  d\t \t e  ", "x  <|endoftext|> y<|endoftext|>", "it's  İstanbul ΣΑΣ á ≠ b. ̸c", "a　 b 　  c  d", "x  ",
    "日本語 テスト。 ok!? 12 34.5\n\n\nx", "a▁b ▁ c", "🙂 smile", "<s> hi </s> <unk> <0x0A>", "One, two;  three... FOUR!\r\nfive's", "word " * 3000, "z" * 5000,
]


def frame(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    both = frame(spark, ODD).union(frame(spark, [None, "same", "same"], 100)).union(frame(spark, ["same"], 101))
    return both.union(spark.createDataFrame([(None, "no id", None, None, None)], both.schema))


def library_counts(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def test_token_counts_equal_the_library(spark, odd, real):
    for docs in (odd, real):
        rows = docs.collect()
        want = sorted((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()), n, n > 20) for r, n in zip(rows, library_counts([r.text for r in rows]), strict=True))
        got = token_counts(docs, P.path("word_bpe_49k.json"), limit=20, batch_bytes=4000).collect()
        assert sorted((r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in got) == want
    assert token_counts(odd.limit(0), P.path("word_bpe_49k.json")).count() == 0


def test_token_counts_where_marks_follow_marks_and_specials_change_case(spark):
    texts = ["He left (early).", "50%,", '"so".', '"foo".', "x): y)... z\u0301. \u0958. n². ª.", "a <|ENDOFTEXT|> b", "<|EndOfText|>.", "<|endoftext|>.", "it's. 'S, ''. 5'. a_. 34.5!?", "İ. aİ,"]
    got = token_counts(frame(spark, texts), P.path("word_bpe_49k.json")).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == library_counts(texts)


def library_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return [np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


@pytest.mark.parametrize("ranks", [None, P.path("byte_bpe_50k.tiktoken")])
def test_ids_equal_the_library(ranks):
    encoder = IdEncoder(P.path("byte_bpe_50k.json"), ranks, P.PATTERN, max_pieces=5)
    for _ in range(2):
        assert encoder.encode(ODD) == library_ids(ODD)


def test_packing_is_whole_and_full(spark, odd, real):
    for docs, capacity in ((odd, 64), (real, 1024)):
        rows = docs.collect()
        ids = defaultdict(list)
        for r, i in zip(rows, library_ids([r.text for r in rows]), strict=True):
            ids[r.doc_id].append(i + bytes(4))
        pieces = pack(docs, P.path("byte_bpe_50k.json"), capacity=capacity, window=50).collect()
        for doc, wholes in ids.items():
            own = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start)
            cover = Counter(k for p in own for k in range(p.start, p.start + p.length))
            assert cover == Counter(k for w in wholes for k in range(len(w) // 4))
            for p in own:
                assert any(zlib.crc32(w[4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32 and len(w) // 4 == p.doc_tokens for w in wholes)
        used = defaultdict(list)
        for p in pieces:
            used[p.sequence_id].append((p.offset, p.length))
        for parts in used.values():
            parts.sort()
            assert [a for a, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= capacity
        tasks = docs.rdd.getNumPartitions()
        total = sum(p.length for p in pieces)
        assert len(used) * capacity - total < capacity * (tasks + len(rows) / 50 + 1)
    assert pack(odd.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_balance_prefers_cheap_sequences():
    placed = balance(np.array([5, 5, 5, 5, 10, 10]), 10, 1.0, 0.1)
    assert len({p[3] for p in placed}) == 4 and sum(p[2] for p in placed) == 40


def test_pieces_equal_the_library(spark, odd, real):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for docs in (odd, real):
        texts = {(r.doc_id, r.text) for r in docs.collect()}
        got = sentence_pieces(docs, P.path("piece_bpe_32k.model"), batch_bytes=3000).collect()
        want = sorted((-1 if i is None else i, library.encode(t or "")) for i, t in ((r.doc_id, r.text) for r in docs.collect()))
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids) for r in got) == want
        assert all(r.decoded == library.decode(r.ids) for r in got) and texts
    digests = {r.doc_id: r for r in sentence_piece_digests(real, P.path("piece_bpe_32k.model")).collect()}
    r = real.first()
    assert digests[r.doc_id].ids_crc32 == zlib.crc32(np.array(library.encode(r.text), "<u4").tobytes()) and all(d.same_text for d in digests.values())


def test_long_words_in_windows_equal_the_library():
    import sentencepiece

    library, model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")), PieceModel(P.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(7)
    words = ["a" * 9_001, "-" * 15_000, "ab" * 5_000, "xyzzy" * 1_601, "".join(rng.choice(list("etaoin"), 9_000)), "=" * 7_000 + "b" * 7, " " * 9_000 + "x"]
    for word, got in zip(words, model.encode(words), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(word)
    alike = "thethe" * 1_700
    assert np.array_equal(model._windowed(np.array(list(map(ord, alike)))), model._pieces(np.array([list(map(ord, alike))]))[1:])
    began = time.monotonic()
    assert len(model.encode(["e" * 1_000_000])[0]) > 4 * 60_000 and time.monotonic() - began < 30


def test_viterbi_equals_the_library_on_a_unigram_model(tmp_path, real):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    rng = np.random.default_rng(3)
    for p in proto.pieces:  # scores without ties
        if p.type == 1:
            p.score = -float(rng.uniform(3, 15))
    (tmp_path / "unigram.model").write_bytes(proto.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "unigram.model"))
    # single words, as the library adds up its scores in single precision
    texts = sorted({w for t in [*ODD[:12], *(r.text for r in real.limit(30).collect() if r.text)] for w in t.split()})
    got = PieceModel(str(tmp_path / "unigram.model")).encode(texts)
    for text, g in zip(texts, got, strict=True):  # equal sums may be cut in another order
        ids, want = np.frombuffer(g, "<u4").tolist(), library.encode(text)
        assert "".join(map(library.id_to_piece, ids)) == "".join(map(library.id_to_piece, want)) and len(ids) == len(want)
        assert ids == want or abs(sum(map(library.get_score, ids)) - sum(map(library.get_score, want))) < 1e-4


ATOMS = [*"abcxyzABCSTEFr0123456789" * 2, *(chr(c) for c in range(33, 127) if not chr(c).isalnum()), *(").", ".)", '".', "'s", "'S", "'ll", "the", "The", "of", "HTTP", "don't", "</w>"), *"\r\n\t\v\f   ", "\r\n", "  ",
         "\u00a0", "\u3000", "\u2009", "\u200b", "\u0301", "\u0338", "\u0345", "\u0130", "\u0131", "ß", "ẞ", "Σ", "ς", "é", "²", "ª", "¼", "क\u093c", "日", "本", "！", "\U0001f642", "’", "“", "”", "…", "—", "\u00ad", "\ufeff", "\x00", "\x1c", "\x85", "ŉ", "ﬁ", "\u212b", "\u2126", "ǅ",
         "<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|end", "oftext|>", "▁", "<s>", "<0x41>"]


def odd_strings(seed, n=20_000):
    rng = random.Random(seed)
    return ["".join(rng.choices(ATOMS, k=rng.randint(1, 14))) for _ in range(n)]


def in_batches(made, texts, size=700):
    return [x for i in range(0, len(texts), size) for x in made(texts[i : i + size])]


def test_token_counts_of_odd_strings():
    texts = odd_strings(1)
    assert in_batches(LengthEncoder(P.path("word_bpe_49k.json")).counts, texts) == library_counts(texts)


def test_ids_of_odd_strings():
    texts = odd_strings(2)
    assert in_batches(IdEncoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).encode, texts) == library_ids(texts)


def test_pieces_of_odd_strings():
    import sentencepiece

    texts = odd_strings(3)
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = in_batches(PieceModel(P.path("piece_bpe_32k.model")).encode, texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == library.encode(texts)


def test_pieces_of_long_words():
    import base64

    import sentencepiece

    rng = random.Random(4)
    texts = [base64.b64encode(rng.randbytes(n)).decode() for n in (30, 60, 1500)] + ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(20_000)), "あいう。カタカナ日本語" * 300, " " * 333, "a" + " " * 77 + "b" + " " * 16, "x" * 999, "the" * 500, "▁" * 100, "ab\n\n\ncd" * 300, "\n" * 50, "🙂" * 200 + "é" * 100, "ﷺ" * 50]
    library, model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")), PieceModel(P.path("piece_bpe_32k.model"))
    got = [np.frombuffer(g, "<u4").tolist() for g in model.encode(texts)]
    assert got == library.encode(texts) and model.decode([np.array(g, "<u4").tobytes() for g in got]) == [library.decode(g) for g in got]


def test_files_that_change_texts_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="changes texts"):
        PieceModel(str(tmp_path / "other.model"))


def plain_base(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again), n < 20 or 100 * len(again) > 30 * n


def test_quality_base_equals_a_plain_version(spark, odd, real):
    texts = ["a b c d e f g h a b c d e f g h x y z q r s", "l1 w\nl1 w\n\n \nl1 w\n" * 4, "# $ % & | < > * \x1c\x85 w\xa0x " * 5, ("one two three four five six seven eight nine " * 3 + "ten " * 30)]
    for docs in (odd, real, frame(spark, texts)):
        got = quality_rules(docs).collect()
        want = sorted((-1 if r.doc_id is None else r.doc_id, *plain_base(r.text)) for r in docs.collect())
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
        assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules(odd.limit(0)).count() == 0


def test_quality_verdicts_follow_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules(docs).join(labels, "doc_id").filter("not base_failed").groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()
    n = {(r.quality, r.kept): r.n for r in rows}
    assert n.get((1, False), 0) <= 0.01 * n[(1, True)] and n.get((0, True), 0) <= 0.15 * n[(0, False)]


def test_distances_by_hand(spark):
    docs = frame(spark, ["the cat saw the dog and the cow " * 30, "the cat saw the dog and the cow " * 30])
    row = quality_rules(docs, min_ref_words=1).first()
    assert row.char_distance == 0 and row.word_distance == 0
