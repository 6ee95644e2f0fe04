"""Alignment of two tokenizers against the libraries and a plain walk over all pairs of tokens."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from terraloom.llm.alignment import Aligner, aligned_groups, alignment_digests, gallop, intersected, pair_documents

FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Plain:
    """The same by the libraries, a text at a time."""

    def __init__(self):
        self.a = Tokenizer.from_file(FILES[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
        self.letters = Aligner._byte_letters()

    def tokens(self, text):
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        spelled_a = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]
        pieces = [self.b.id_to_piece(i) for i in b]
        spelled_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        return a, b, spelled_a, spelled_b

    def align(self, text):
        """(groups, links as token numbers, ids of both); None without tokens"""
        if not text:
            return None
        a, b, spelled_a, spelled_b = self.tokens(text)
        whole = (" " + text).encode()
        if b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            return None
        owner_a, owner_b = ([k for k, t in enumerate(s) for _ in t] for s in (spelled_a, spelled_b))
        links = sorted(set(zip(owner_a, owner_b, strict=True)))
        groups, i, j, n, m = [], 0, 0, 0, 0
        end_a, end_b = (list(np.cumsum([len(t) for t in s])) for s in (spelled_a, spelled_b))
        for end in sorted(set(end_a) & set(end_b)):
            n, m = end_a.index(end) + 1, end_b.index(end) + 1
            groups.append((a[i:n], b[j:m]))
            i, j = n, m
        return groups, links, a, b

    def digests(self, texts):
        found = [self.align(t) for t in texts]
        held = Counter(p for f in found if f for p in {(f[2][i], f[3][j]) for i, j in f[1]})
        best = {}
        for (a, _), n in held.items():
            best[a] = max(n, best.get(a, 0))
        out = []
        for f in found:
            if not f:
                out.append((0, 0, 0, 0, 0, 0, ""))
                continue
            groups, links, a, b = f
            counts = [(a[i], held[a[i], b[j]]) for i, j in links]
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            out.append((len(a), len(b), len(groups), len(links), sum(n == best[i] for i, n in counts), sum(n for _, n in counts), hashlib.sha256(text.encode()).hexdigest()))
        return out, held


@pytest.fixture(scope="module")
def plain():
    return Plain()


def odd_texts():
    random.seed(12)
    parts = [*"aebct  \n\t.,'12é中İ", "▁", "\U0001f642", "<|endoftext|>", "<s>", "<unk>", "<0x41>", " the", " of", " ", "　", "ing", "I'll", "\r\n"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(300)]
    texts += ["", None, " ", "  ", "a", " a", "a ", "a  b", "a\n b", "x" * 3000, "the of " * 700, "the quick brown fox", "the quick brown fox", "<|endoftext|>"]
    return texts


def test_gallop_finds_first_place_not_below():
    random.seed(5)
    for _ in range(200):
        long = np.unique(np.random.default_rng(random.randint(0, 9999)).integers(1, 400, random.randint(1, 120)))
        short = np.unique(np.append(np.random.default_rng(random.randint(0, 9999)).integers(1, long[-1] + 1, random.randint(1, 40)), long[-1]))
        assert gallop(short, long).tolist() == np.searchsorted(long, short).tolist()
    assert gallop(np.zeros(0, int), np.zeros(0, int)).tolist() == []


def test_overlap_ranges_by_hand():
    # ends 2 5 9 against 1 2 4 9: the first covers two, the second the third and the fourth, the last the fourth
    cut_short, cut_long, first, many = intersected(np.array([2, 5, 9]), np.array([1, 2, 4, 9]))
    assert (cut_short.tolist(), cut_long.tolist(), first.tolist(), many.tolist()) == ([0, 2], [1, 3], [0, 2, 3], [2, 2, 1])


def test_digests_equal_the_plain_walk(spark, plain):
    texts = odd_texts()
    wanted, _ = plain.digests(texts)
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, pairs int").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in FIGURES) for r in alignment_digests(docs, *FILES, *RANKS, batch_bytes=500, block_bytes=1500).collect()}
    assert got == dict(enumerate(wanted))


def test_pairs_and_groups_are_real_outputs(spark, plain):
    texts = [t for t in odd_texts() if t][:60]
    _, held = plain.digests(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = {(r["a_id"], r["b_id"]): r["docs"] for r in pair_documents(docs, *FILES, *RANKS).collect()}
    assert pairs == dict(held)
    for r in aligned_groups(docs, *FILES).collect():
        want = plain.align(texts[r["doc_id"]])
        cut = list(zip([0, *r["a_ends"]], r["a_ends"], [0, *r["b_ends"]], r["b_ends"]))
        assert [(r["a_ids"][i:j], r["b_ids"][k:m]) for i, j, k, m in cut] == (want[0] if want else [])


def test_odd_tables(spark):
    fields = "doc_id long, text string, code string, block int"
    empty = spark.createDataFrame([], fields)
    assert alignment_digests(empty, *FILES, *RANKS).count() == 0
    rows = [(None, "a b", "x", 1), (None, "a b", "x", 1), (3, None, None, None), (3, "", "y", 2)]
    got = sorted((tuple(r[c] for c in FIGURES[:6]), r["doc_id"]) for r in alignment_digests(spark.createDataFrame(rows, fields), *FILES, *RANKS).collect())
    assert [g[0] for g in got] == [(0,) * 6] * 2 + [(2, 2, 2, 2, 2, 4)] * 2
    assert [g[1] for g in got] == [3, 3, None, None]
