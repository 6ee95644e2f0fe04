"""Alignment of two tokenizers by the byte offsets at which tokens of both end."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import as_batch, ranges, removed, scratch, sliced, strings, written
from .packing import INNER_SPACE, IdEncoder
from .sentence_pieces import SPACE

#: Ids of the second tokenizer take the low bits of a pair.
PAIR_BITS = 24
#: Blocks of a task are numbered from its number times this.
BLOCKS_PER_TASK = 1 << 32
NONE = np.zeros(0, np.int64)
HEX_PIECE = re.compile("<0x[0-9A-F]{2}>")
DIGESTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Place in ``long`` of the first number not below each of ``short``; both ascend, and the last of ``long`` is below none.

    Each search begins where one of a smaller number ended: it probes 1, 2, 4, ... places on until
    it has passed its number, and then halves the last step. Every second number of every stride
    advances at once, strides getting shorter, so that few steps serve all of them.
    """
    place = np.zeros(len(short), np.int64)
    stride = 1 << max(0, len(short) - 1).bit_length()
    while stride:
        at = np.arange(stride - 1, len(short), 2 * stride)
        x, low = short[at], np.where(at >= stride, place[at - stride], 0)
        high, going, step = low.copy(), np.arange(len(at)), 1
        while len(going := going[long[high[going]] < x[going]]):
            low[going] = high[going] + 1
            high[going] = np.minimum(high[going] + step, len(long) - 1)
            step *= 2
        going = np.flatnonzero(low < high)
        while len(going):
            middle = (low[going] + high[going]) >> 1
            below = long[middle] < x[going]
            low[going[below]] = middle[below] + 1
            high[going[~below]] = middle[~below]
            going = going[low[going] < high[going]]
        place[at] = low
        stride >>= 1
    return place


def intersected(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of two lists of ends that stop at the same place: (index in short, index in long) of common ends, (first, number) of tokens of the longer list that overlap each of the shorter.

    A token overlaps what lies between the places of the end before it and of its own end.
    """
    place = gallop(short, long)
    common = long[place] == short
    first = np.concatenate([[0], place[:-1] + common[:-1]]) if len(place) else place
    return np.flatnonzero(common), place[common], first, place - first + 1


class Aligned(NamedTuple):
    """Figures of each text, and of all texts one after another: ids of both tokenizers, the token numbers at which groups end, and the token numbers of each link."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


class WordEncoder(IdEncoder):
    """Ids of texts with a space before them, special strings being plain text."""

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str):
        super().__init__(vocabulary, ranks, pattern, max_pieces=200_000)
        self.special = []
        self.tokenizer.encode_special_tokens = True

    def spaced(self, texts: list[str], words: int) -> list[bytes]:
        """Of the texts the first ``words`` are such as stand between single spaces."""
        if len(self.after_space) > self.max_pieces:
            self.after_space.clear()
        self._learn(self.after_space, set(texts[:words]), " ")
        known = list(map(self.after_space.__getitem__, texts[:words]))
        return known + self.encode([" " + t if t else "" for t in texts[words:]])


class Aligner:
    """Ids of both tokenizers, the groups that common ends cut, and the links of overlapping tokens."""

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str, model: str):
        import sentencepiece

        self.a = WordEncoder(vocabulary, ranks, pattern)
        plain = self._byte_letters()
        vocab = self.a.tokenizer.get_vocab()
        self.bytes_a = self._table({i: bytes(plain[c] for c in token) if all(c in plain for c in token) else token.encode() for token, i in vocab.items()})
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        named = {i: self.b.id_to_piece(i) for i in range(self.b.get_piece_size())}
        self.bytes_b = self._table({i: bytes([int(p[3:5], 16)]) if HEX_PIECE.fullmatch(p) else p.replace(SPACE, " ").encode() for i, p in named.items()})
        numbers = [str(i) for i in range(max(len(self.bytes_a[0]), len(self.bytes_b[0])))]
        self.inner = np.array([f"{n}," for n in numbers], object)
        self.last_a = np.array([f"{n}|" for n in numbers], object)
        self.last_b = np.array([f"{n};" for n in numbers], object)

    @staticmethod
    def _byte_letters() -> dict[str, int]:
        """Characters that stand for single bytes in a byte-level vocabulary: printable Latin ones for themselves, those from 256 on for the others."""
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}

    @staticmethod
    def _table(tokens: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(size, begin) by id and all bytes."""
        size = np.zeros(max(tokens) + 1, np.int64)
        size[list(tokens)] = [len(t) for t in tokens.values()]
        data = b"".join(tokens.get(i, b"") for i in range(len(size)))
        return size, np.cumsum(size) - size, np.frombuffer(data, np.uint8)

    @staticmethod
    def _same(table: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, n: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Whether the joined bytes of the ``n`` tokens of each text are the text."""
        size, begin, data = table
        made = data[ranges(begin[ids], size[ids])].tobytes()
        ends = np.concatenate([[0], np.cumsum(size[ids])])[np.cumsum([0, *n])].tolist()
        return np.array([made[i:j] == t for (i, j), t in zip(pairwise(ends), texts, strict=True)], bool)

    def align(self, texts: list[str], words: int = 0) -> Aligned:
        """Tokens, groups and links of all texts.

        The first ``words`` texts are words such as ``documents`` makes. The ends of all texts laid side by side are one list for each tokenizer; both lists end
        each text at the same place. A text that is empty, or that the tokens of one of them don't
        spell, has no tokens.
        """
        raw = [(" " + t).encode("utf-8", "surrogatepass") for t in texts]
        listed_a, listed_b = self.a.spaced(texts, words), self.b.encode(texts, num_threads=1)
        n_a, n_b = np.fromiter(map(len, listed_a), np.int64, len(texts)) // 4, np.fromiter(map(len, listed_b), np.int64, len(texts))
        ids_a = np.frombuffer(b"".join(listed_a), "<u4").astype(np.int64)
        ids_b = np.fromiter(chain.from_iterable(listed_b), np.int64, n_b.sum())
        good = self._same(self.bytes_a, ids_a, n_a, raw) & self._same(self.bytes_b, ids_b, n_b, raw) & (n_a > 0)
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        n_a, n_b = n_a * good, n_b * good
        ends_a, ends_b = np.cumsum(self.bytes_a[0][ids_a]), np.cumsum(self.bytes_b[0][ids_b])
        if len(ids_a) <= len(ids_b):
            cut_a, cut_b, first, many = intersected(ends_a, ends_b)
            link_a, link_b = np.repeat(np.arange(len(first)), many), ranges(first, many)
        else:
            cut_b, cut_a, first, many = intersected(ends_b, ends_a)
            link_a, link_b = ranges(first, many), np.repeat(np.arange(len(first)), many)
        stop = np.cumsum(n_a)
        return Aligned(n_a, n_b, np.diff(np.searchsorted(cut_a, stop), prepend=0), np.diff(np.searchsorted(link_a, stop), prepend=0), ids_a, ids_b, cut_a + 1, cut_b + 1, link_a, link_b)

    def spelled(self, x: Aligned) -> list[str]:
        """Groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = (np.repeat(np.arange(len(c)), np.diff(c, prepend=0)) for c in (x.cut_a, x.cut_b))
        parts = np.empty(len(x.a) + len(x.b), object)
        place_a = np.arange(len(x.a)) + np.concatenate([[0], x.cut_b])[group_a]
        place_b = np.arange(len(x.b)) + x.cut_a[group_b]
        parts[place_a], parts[place_b] = self.inner[x.a], self.inner[x.b]
        parts[place_a[x.cut_a - 1]] = self.last_a[x.a[x.cut_a - 1]]
        parts[place_b[x.cut_b - 1]] = self.last_b[x.b[x.cut_b - 1]]
        flat, stops = parts.tolist(), np.cumsum(x.n_a + x.n_b).tolist()
        return ["".join(flat[i:j])[:-1] for i, j in pairwise([0, *stops])]

    def documents(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, str, np.ndarray]]:
        """Per text: numbers of tokens of both, groups and links, the groups spelled out, and the id pair of each link.

        Where neither tokenizer crosses the spaces of a text, tokens of both end before each of
        them, so each distinct word of all texts is aligned once; other texts are aligned whole.
        """
        split = [t.split(" ") if self._by_words(t) else [t] for t in texts]
        words = set().union(*(w for w in split if len(w) > 1))
        units = [*words, *set().union(*(w for w in split if len(w) == 1)) - words]
        x = self.align(units, len(words))
        index, spelled = {u: i for i, u in enumerate(units)}, dict(zip(units, self.spelled(x), strict=True))
        pairs, first = x.a[x.link_a] << PAIR_BITS | x.b[x.link_b], np.cumsum(x.n_links) - x.n_links
        for words in split:
            at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
            if x.n_a[at].all():
                yield int(x.n_a[at].sum()), int(x.n_b[at].sum()), int(x.n_groups[at].sum()), int(x.n_links[at].sum()), ";".join(map(spelled.__getitem__, words)), pairs[ranges(first[at], x.n_links[at])]
            else:
                yield 0, 0, 0, 0, "", NONE

    @staticmethod
    def _by_words(text: str) -> bool:
        return not ("  " in text or text[:1] in ("", " ") or text[-1] == " " or SPACE in text or INNER_SPACE.search(" " + text))


@lru_cache(1)
def aligner(vocabulary: str, ranks: str | None, pattern: str, model: str) -> Aligner:
    """The aligner of two files, kept with its words from task to task of a worker."""
    return Aligner(vocabulary, ranks, pattern, model)


def _sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text")


def aligned_groups(docs: DataFrame, vocabulary: str, model: str, ranks: str | None = None, pattern: str = "", batch_bytes: int = 2 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a_ids, b_ids, and a_ends, b_ends: where each group ends in both lists, as numbers of tokens.

    ``vocabulary``: a byte-level BPE file of the tokenizers library, which gets a space and the
    text; ``model``: a SentencePiece file that puts a space before the text. Both lie at the same
    place on every executor. Null or empty texts, and those that the tokens of one of them don't
    spell: empty lists. Null ids, repeated rows and ties: a row each. Other columns: ignored. No
    rows: no rows. Whole texts are aligned; a batch holds about ``batch_bytes`` or one longer text.
    """
    lists = ("a_ids", "b_ids", "a_ends", "b_ends")
    schema = pa.schema([("doc_id", pa.int64()), *((x, pa.list_(pa.int32())) for x in lists)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(vocabulary, ranks, pattern, model)
        for batch in sliced(batches, "text", batch_bytes):
            x = tool.align(strings(batch, "text"))
            own = [np.repeat(np.cumsum(n) - n, x.n_groups) for n in (x.n_a, x.n_b)]
            flat = [(x.a, x.n_a), (x.b, x.n_b), (x.cut_a - own[0], x.n_groups), (x.cut_b - own[1], x.n_groups)]
            yield as_batch(schema, batch.column("doc_id"), *(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(v, pa.int32())) for v, n in flat))

    return _sources(docs, id_col, text_col).mapInArrow(run, "doc_id long, " + ", ".join(f"{x} array<int>" for x in lists))


#: A row per block of texts: figures of its texts, the distinct pairs of all of them with the
#: number of texts that hold each, and per text which of these it holds and how often.
BLOCK_FIELDS = [("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), *((n, pa.list_(pa.int64())) for n in ("n_a", "n_b", "n_groups", "n_links", "n_pairs")), ("sha", pa.list_(pa.string())), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int32())), ("code", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))]
BLOCK_SCHEMA = "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, n_pairs array<long>, sha array<string>, pairs array<long>, held array<int>, code array<int>, times array<int>"


def _blocks(docs: DataFrame, tools: tuple[str, str | None, str, str], batch_bytes: int, block_bytes: int) -> DataFrame:
    schema = pa.schema(BLOCK_FIELDS)

    def block(number: int, rows: list[tuple], pairs: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
        found, code = np.unique(np.concatenate(pairs), return_inverse=True)
        columns = [number, *(list(c) for c in zip(*rows, strict=True)), found, np.bincount(code, minlength=len(found)), code, np.concatenate(times)]
        return as_batch(schema, *([c] for c in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, size, number = aligner(*tools), 0, TaskContext.get().partitionId() * BLOCKS_PER_TASK
        rows, pairs, times = [], [], []
        for batch in sliced(batches, "text", batch_bytes):
            texts = strings(batch, "text")
            for doc_id, (*figures, groups, linked) in zip(batch.column("doc_id").to_pylist(), tool.documents(texts), strict=True):
                own, many = np.unique(linked, return_counts=True)
                rows.append((doc_id, *figures, len(own), hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
                pairs.append(own)
                times.append(many)
            size += sum(map(len, texts))
            if size >= block_bytes:
                yield block(number, rows, pairs, times)
                rows, pairs, times, size, number = [], [], [], 0, number + 1
        if rows:
            yield block(number, rows, pairs, times)

    return docs.mapInArrow(run, BLOCK_SCHEMA)


def _held(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.inline(F.arrays_zip("pairs", "held")))


def _counted(blocks: DataFrame) -> DataFrame:
    return _held(blocks).groupBy("pairs").agg(F.sum("held").alias("docs"))


def _answered(block: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of the texts of one block, from its own row and the counts of its pairs."""
    own = {c: block.column(c).combine_chunks()[0].values for c in block.column_names if c != "block"}
    pairs, docs, best = (answers.column(c).to_numpy() for c in ("pairs", "docs", "best"))
    order = np.argsort(pairs)
    docs, best = docs[order], best[order].astype(bool)
    code, times = own["code"].to_numpy(), own["times"].to_numpy().astype(np.int64)
    ends = np.cumsum(own["n_pairs"].to_numpy())
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[code], times * docs[code])] if len(code) else [np.zeros(1, np.int64)] * 2
    n_best, count_sum = (np.diff(s[np.concatenate([[0], ends])]) for s in sums)
    return pa.table([own["doc_id"], own["n_a"], own["n_b"], own["n_groups"], own["n_links"], pa.array(n_best), pa.array(count_sum), own["sha"]], names=[c.split()[0] for c in DIGESTS.split(", ")])


def pair_documents(docs: DataFrame, vocabulary: str, model: str, ranks: str | None = None, pattern: str = "", batch_bytes: int = 4 << 20, block_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """a_id, b_id, docs: linked ids and how many documents hold them linked; see ``aligned_groups``."""
    counted = _counted(_blocks(_sources(docs, id_col, text_col), (vocabulary, ranks, pattern, model), batch_bytes, block_bytes))
    return counted.select(F.shiftright("pairs", PAIR_BITS).cast("int").alias("a_id"), F.col("pairs").bitwiseAND(F.lit((1 << PAIR_BITS) - 1)).cast("int").alias("b_id"), "docs")


def alignment_digests(docs: DataFrame, vocabulary: str, model: str, ranks: str | None = None, pattern: str = "", batch_bytes: int = 4 << 20, block_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    Tokens, groups and cases as in ``aligned_groups``; links are the overlapping occurrences. A
    pair of ids counts the documents (rows) that hold it linked; n_best are the links whose count
    is the highest of their first id, and count_sum is the sum of counts over links.

    Texts are encoded once. A block of about ``block_bytes`` characters, or one longer text,
    leaves a row with its distinct pairs; blocks meet the counts of their own pairs only, so
    nothing that grows with the corpus is broadcast (the highest counts are a row per id of the
    vocabulary). Between the steps lies a table in the shared folder.
    """
    spark = docs.sparkSession
    path = scratch(spark, "aligned-blocks")
    _blocks(_sources(docs, id_col, text_col), (vocabulary, ranks, pattern, model), batch_bytes, block_bytes).write.parquet(path)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    counted = _counted(blocks)
    first = F.shiftright("pairs", PAIR_BITS)
    highest = counted.groupBy(first.alias("a_id")).agg(F.max("docs").alias("highest"))
    judged = counted.join(F.broadcast(highest), first == F.col("a_id")).select("pairs", "docs", (F.col("docs") == F.col("highest")).alias("best"))
    answers = _held(blocks).select("block", "pairs").join(judged.hint("merge"), "pairs").select("block", "pairs", "docs", "best")
    own = spark.read.schema(BLOCK_SCHEMA).parquet(path).select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_pairs", "sha", "code", "times")
    out = written(own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_answered, DIGESTS), "aligned")
    removed(spark, path)
    return out
