"""Katz backoff language model: Good-Turing discounts, exact backoff weights, tables by bucket."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import as_batch, crc_mod_py, mixed, raw, removed, scratch, sliced, word_hashes, written

BLOCK = "block long, docs array<long>, held array<boolean>, ends array<int>, words binary, tokens binary"
ASK = "bucket int, block long, keys binary, n binary, a array<double>, b array<double>, alone long"
TOLD = "kind string, bucket int, block long, keys binary, told binary, weights array<double>, sums array<long>"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
#: The hash of the end of a text, as if it were a word.
END = np.uint64(0xE17A1465D3C5B9F1)
STEP = np.uint64(0x9E3779B97F4A7C15)
KEPT_COUNTS = 6
#: A bucket of keys answers about as many keys as so many blocks ask.
BLOCKS_PER_BUCKET = 4


def arrow(schema: str) -> pa.Schema:
    kinds = [c.split() for c in schema.split(", ")]
    return pa.schema([(n, pa.list_(ARROW[t[6:-1]]) if t.startswith("array") else ARROW[t]) for n, t in kinds])


def row(schema: pa.Schema, **cells) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([cells.get(f.name)], f.type) for f in schema], schema=schema)


def shrunk(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs, all lowest bytes first."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def grown(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view(np.uint64).ravel()


def shrunk_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their steps, which need fewer bytes."""
    return keys[:1].tobytes() + shrunk(np.diff(keys, prepend=keys[:1]))


def grown_keys(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64, 1) + np.cumsum(grown(data[8:]), dtype=np.uint64) if len(data) > 8 else np.zeros(0, np.uint64)


def joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


class Discounts:
    """Good-Turing factors by count: factor[r] for r up to the cut-off, then less a fixed ``beyond``.

    By default ``beyond`` is what the cut-off's count loses, so counts of any size leave a share
    for unseen words; 0 leaves higher counts whole. Where the counts of counts don't give a
    factor between 0 and 1, as in tiny texts, (r - 0.5) / r stands in.
    """

    def __init__(self, of_counts: list[int], cut: int = KEPT_COUNTS - 1, beyond: float | None = None):
        n = [0, *of_counts]
        self.factor = np.ones(cut + 2)
        self.factor[0] = 0
        tail = (cut + 1) * n[cut + 1] / n[1] if n[1] else 1.0
        for r in range(1, cut + 1):
            ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
            d = (ratio - tail) / (1 - tail) if tail < 1 else 0.0
            self.factor[r] = d if 0 < d < 1 else (r - 0.5) / r
        self.beyond = cut * (1 - self.factor[cut]) if beyond is None else beyond

    def __call__(self, count: np.ndarray) -> np.ndarray:
        last = len(self.factor) - 1
        return np.where(count >= last, 1 - self.beyond / np.maximum(last, count), self.factor[np.minimum(count, last)])

    def taken(self, count: np.ndarray) -> np.ndarray:
        """What each count loses, without taking near equals from each other."""
        last = len(self.factor) - 1
        return np.where(count >= last, self.beyond, (1 - self.factor[np.minimum(count, last)]) * count)


class Unigrams:
    """Discounted word probabilities; what the discounts free is the one unknown word's."""

    def __init__(self, total: int, of_counts: list[int]):
        self.total, self.discount = max(1, total), Discounts(of_counts, beyond=0.0)
        freed = sum((1 - self.discount.factor[r]) * r * of_counts[r - 1] for r in range(1, KEPT_COUNTS)) / self.total
        self.unknown = freed if total and freed > 0 else 1 / (self.total + 1)
        known = 1 - freed if total else 1.0
        self.scale = (1 - self.unknown) / known

    def __call__(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, self.scale * self.discount(count) * count / self.total, self.unknown)


class Block:
    """Texts of one block and what is known of the n-grams that end at each of their tokens.

    ``count[n]``: how often the n-gram was found in training texts; ``wanted[n]``: whether a
    text that isn't learned from holds it; ``first[n]``: a token for each n-gram whose share
    this block hands to its context. Level 0 is empty. With ``whole`` every n-gram is asked for,
    so the buckets get the whole model; with ``fresh`` no text is one that was learned from.
    """

    def __init__(self, table: pa.Table, told: dict[int, np.ndarray] | None = None, whole: bool = False, fresh: bool = False):
        self.whole = whole
        self.block = table.column("block")[0].as_py()
        self.docs, self.held = table.column("docs")[0].as_py(), table.column("held")[0].as_py()
        self.ends = table.column("ends")[0].values.to_numpy()
        words, tokens = np.frombuffer(table.column("words")[0].as_py(), np.uint64), grown(table.column("tokens")[0].as_py()).astype(np.int64)
        self.begin = np.concatenate([[0], self.ends[:-1]])
        self.trained = np.repeat(np.array([h is False and not fresh for h in self.held], bool), np.diff(self.ends, prepend=0))
        order = np.argsort(words)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.words = words[tokens]
        self.keys, self.asked, self.of = [self.words], [np.ones(len(tokens), bool)], [place[tokens]]
        self.distinct, self.alone = words[order], 0
        self.count: list[np.ndarray] = [None]
        self.wanted: list[np.ndarray] = [None]
        self.first: list[np.ndarray] = [None]
        for n in sorted(told or ()):
            if n > 1:
                self._raise()
            self._hear(n, told[n].astype(np.int64))

    def before(self, values: np.ndarray, start) -> np.ndarray:
        """The values of the tokens before; ``start`` at the begin of each text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.begin] = start
        return out

    def context_count(self, n: int) -> np.ndarray:
        """How often the context of each token's n-gram was found; a start, as often as there are texts."""
        return self.before(self.count[n - 1], self.texts)

    def _hear(self, n: int, told: np.ndarray) -> None:
        """What the buckets say of the n-grams asked; an n-gram not asked is found once, here, or never."""
        asked, of = self.asked[n - 1], self.of[n - 1]
        count, wanted = self.trained.astype(np.int64), np.zeros(len(asked), bool)
        if n > 1:
            count[~asked & (self.least == 0)] = 0
        count[asked], wanted[asked] = told[of] >> 2, (told[of] & 1) > 0
        self.count.append(count)
        self.wanted.append(wanted)
        if n == 1:
            self.texts = int(count[self.ends[0] - 1])
            self.first.append(None)
            return
        place = np.full(len(told), -1)
        place[of[::-1]] = np.flatnonzero(asked)[::-1]
        self.first.append(np.concatenate([place[(told & 2) > 0], np.flatnonzero(~asked & self.trained)]))

    def _raise(self) -> None:
        """Keys of the next n-grams, and which of them the block cannot count alone.

        An n-gram is found as often as its two parts at most. One learned here with a part that
        is found once is found once, and need not be asked unless other texts may hold it.
        """
        n = len(self.keys)
        last, start = self.keys[-1], mixed(np.uint64([n]))[0]
        self.keys.append(mixed(self.before(last, start) * STEP + self.words))
        self.least = np.minimum(self.count[n], self.before(self.count[n], self.texts))
        both = self.wanted[n] & self.before(self.wanted[n], True)
        asked = (self.least > 1) | ((self.least == 1) & (~self.trained | both | self.whole))
        self.alone = int((self.trained & ~asked).sum())
        self.distinct, of = np.unique(self.keys[-1][asked], return_inverse=True)
        self.asked.append(asked)
        self.of.append(of)

    def ask(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys, 2 * times found in training texts + whether others hold it) of the first level not told yet."""
        if len(self.keys) < len(self.count):
            self._raise()
        of, trained = self.of[-1], self.trained[self.asked[-1]]
        n = np.bincount(of, weights=2 * trained, minlength=len(self.distinct)).astype(np.uint64)
        return self.distinct, n | (np.bincount(of, weights=~trained, minlength=len(self.distinct)) > 0).astype(np.uint64)

    def context_keys(self, n: int) -> np.ndarray:
        """Keys of the contexts of n-grams; contexts of different length are told apart."""
        return mixed(self.before(self.keys[n - 2], mixed(np.uint64([n - 1]))[0]) + np.uint64(n))

    def seen_share(self, n: int, below: Unigrams, discounts: list[Discounts]) -> np.ndarray:
        """The discounted share of each token's n-gram, which must have been found."""
        if n == 1:
            return below(self.count[1])
        return discounts[n](self.count[n]) * self.count[n] / np.maximum(1, self.context_count(n))

    def handed(self, below: Unigrams, discounts: list[Discounts]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context keys, what their n-grams leave, what they take below), of contexts that others may ask for."""
        keys, a, b = [], [], []
        for n in range(2, len(self.count)):
            at = self.first[n][(self.before(self.wanted[n - 1], True) | self.whole)[self.first[n]]]
            keys.append(self.context_keys(n)[at])
            a.append(discounts[n].taken(self.count[n][at]))
            b.append(self.seen_share(n - 1, below, discounts)[at])
        distinct, of = np.unique(joined(keys, np.uint64), return_inverse=True)
        return distinct, *(np.bincount(of, weights=joined(x, float), minlength=len(distinct)) for x in (a, b))

    def unseen(self, n: int) -> np.ndarray:
        """Tokens whose n-gram wasn't found, though its context was."""
        return (self.count[n] == 0) & (self.context_count(n) > 0)

    def needed(self) -> np.ndarray:
        return np.unique(joined([self.context_keys(n)[self.unseen(n)] for n in range(2, len(self.count))], np.uint64))

    def probabilities(self, below: Unigrams, discounts: list[Discounts], weights: np.ndarray) -> np.ndarray:
        """Of each token, from the shortest n-gram up: its share where found, else the weight of the context times the share below."""
        needed, p = self.needed(), below(self.count[1])
        for n in range(2, len(self.count)):
            p = np.where(self.count[n] > 0, self.seen_share(n, below, discounts), p)
            back = np.flatnonzero(self.unseen(n))
            p[back] *= weights[np.searchsorted(needed, self.context_keys(n)[back])] / self.context_count(n)[back]
        return p


@contextmanager
def _blocks(docs: DataFrame, held_mod: int, held_value: int, block_tokens: int, id_col: str, text_col: str) -> Iterator[DataFrame]:
    """The table of blocks, bucketed by block so that later joins leave it in place; in the shared folder, and gone in the end."""
    schema = arrow(BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        docs_, held, sizes, parts = [], [], [], []

        def close() -> pa.RecordBatch:
            """Words by frequency, so that most tokens are small numbers."""
            nonlocal made
            words, of, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            rank = np.empty(len(order), np.uint64)
            rank[order] = np.arange(len(order), dtype=np.uint64)
            out = row(schema, block=made, docs=list(docs_), held=list(held), ends=np.cumsum(np.concatenate(sizes)).astype(np.int32), words=words[order].tobytes(), tokens=shrunk(rank[of]))
            made += 1
            for x in (docs_, held, sizes, parts):
                x.clear()
            return out

        for batch in sliced(batches, "text", 1 << 20):
            hashes, n = word_hashes(raw(batch, "text"))
            tokens = np.full(len(hashes) + len(n), END)
            ends = np.cumsum(n + 1)
            inner = np.ones(len(tokens), bool)
            inner[ends - 1] = False
            tokens[inner] = hashes
            for doc in batch.column("doc_id").to_pylist():
                mod = crc_mod_py(doc, held_mod)
                docs_.append(doc)
                held.append(None if mod is None else mod == held_value)
            sizes.append(n + 1)
            parts.append(tokens)
            if sum(map(len, parts)) >= block_tokens:
                yield close()
        if parts:
            yield close()

    spark = docs.sparkSession
    name, path = f"blocks_{uuid.uuid4().hex}", scratch(spark, "katz-blocks")
    rows = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, BLOCK)
    writer = rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
    try:
        writer.option("path", path).option("compression", "zstd").saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        removed(spark, path)


def _rows(block: int, buckets: int, keys: np.ndarray, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per bucket that has keys; buckets are equal ranges of keys."""
    schema = arrow(ASK)
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
    bounds = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        part = slice(bounds[k], bounds[k + 1])
        yield row(schema, bucket=k, block=block, keys=shrunk_keys(keys[part]), **{c: shrunk(v[part]) if c == "n" else v[part] for c, v in columns.items()})


def _merge(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[slice]]:
    """(distinct keys, place of each key of each row among them, each row's part of the places)"""
    parts = [grown_keys(k) for k in table.column("keys").to_pylist()]
    keys, place = np.unique(joined(parts, np.uint64), return_inverse=True)
    stop = np.cumsum([len(p) for p in parts])
    return keys, place, [slice(e - len(p), e) for e, p in zip(stop.tolist(), parts, strict=True)]


def _count(asked: DataFrame) -> DataFrame:
    """Counts of all keys of a bucket: told to each block in the order that it asked, and the model's table."""
    schema = arrow(TOLD)

    def run(table: pa.Table) -> pa.Table:
        keys, place, parts = _merge(table)
        n = joined([grown(x) for x in table.column("n").to_pylist()], np.uint64).astype(np.int64)
        counts = np.bincount(place, weights=n >> 1, minlength=len(keys)).astype(np.int64)
        wanted = np.bincount(place, weights=n & 1, minlength=len(keys)) > 0
        one_of = np.full(len(keys), -1)
        one_of[place[n > 1]] = np.flatnonzero(n > 1)  # of the blocks that have a key, one takes it
        told = (counts * 4 + wanted)[place]
        told[one_of[one_of >= 0]] += 2
        bucket = table.column("bucket")[0].as_py()
        out = [row(schema, kind="told", bucket=bucket, block=b, told=shrunk(told[s])) for b, s in zip(table.column("block").to_pylist(), parts, strict=True) if s.start < s.stop]
        kept = np.flatnonzero(counts)
        out.append(row(schema, kind="table", bucket=bucket, keys=shrunk_keys(keys[kept]), told=shrunk(counts[kept])))
        small = np.bincount(np.minimum(counts, KEPT_COUNTS + 1), minlength=KEPT_COUNTS + 2)[1 : KEPT_COUNTS + 1]
        alone = sum(x or 0 for x in table.column("alone").to_pylist())
        out.append(row(schema, kind="sums", bucket=bucket, sums=[int(counts.sum()), len(kept), int(small[0]) + alone, *small[1:].tolist()]))
        return pa.Table.from_batches(out)

    return asked.groupBy("bucket").applyInArrow(run, TOLD)


def _weigh(asked: DataFrame) -> DataFrame:
    """Backoff weight of each context, times its count: what its n-grams leave, over what they leave below."""
    schema = arrow(TOLD)

    def run(table: pa.Table) -> pa.Table:
        keys, place, parts = _merge(table)
        gives = [x is not None for x in table.column("a").to_pylist()]
        here = joined([place[s] for s, g in zip(parts, gives, strict=True) if g], np.int64)
        a, b = (np.bincount(here, weights=joined([x.values.to_numpy() for x in table.column(c) if x.is_valid], float), minlength=len(keys)) for c in "ab")
        weights, bucket = a / (1 - b), table.column("bucket")[0].as_py()
        out = [row(schema, kind="told", bucket=bucket, block=n, weights=weights[place[s]]) for n, s, g in zip(table.column("block").to_pylist(), parts, gives, strict=True) if not g]
        out.append(row(schema, kind="table", bucket=bucket, keys=shrunk_keys(keys), weights=weights))
        return pa.Table.from_batches(out)

    return asked.groupBy("bucket").applyInArrow(run, TOLD)


def _look_up(asked: DataFrame, tables: DataFrame) -> DataFrame:
    """What the tables of a model say of all keys asked: counts, or weights of contexts."""
    schema = arrow(TOLD)

    def run(key: tuple, asks: pa.Table, table: pa.Table) -> pa.Table:
        parts = [[grown_keys(k), grown(t) if t else None, w] for k, t, w in zip(table.column("keys").to_pylist(), table.column("told").to_pylist(), table.column("weights").to_pylist(), strict=True)]
        keys = joined([p[0] for p in parts], np.uint64)  # of one row, as a bucket leaves one
        values = np.concatenate([np.asarray(p[1] if p[1] is not None else p[2]) for p in parts]) if parts else np.zeros(0)
        out = []
        for block, asked in zip(asks.column("block").to_pylist(), map(grown_keys, asks.column("keys").to_pylist()), strict=True):
            at = np.searchsorted(keys, asked).clip(max=max(0, len(keys) - 1))
            found = keys[at] == asked if len(keys) else np.zeros(len(asked), bool)
            here = np.where(found, values[at], 0) if len(keys) else np.zeros(len(asked))
            if parts and parts[0][1] is None:
                out.append(row(schema, kind="told", bucket=key[0].as_py(), block=block, weights=here))
            else:
                out.append(row(schema, kind="told", bucket=key[0].as_py(), block=block, told=shrunk(here.astype(np.uint64) * np.uint64(4))))
        return pa.Table.from_batches(out, schema)

    return asked.groupBy("bucket").cogroup(tables.groupBy("bucket")).applyInArrow(run, TOLD)


def _kept(df: DataFrame, path: str) -> DataFrame:
    """Written by kind: the model's table and what blocks are told lie in folders of their own."""
    df.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sums(level: DataFrame) -> list[int]:
    """Of the n-grams of a level: times found, different ones, and how many were found once, twice and so on."""
    each = level.filter("kind = 'sums'").agg(*(F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)).alias(f"k{i}") for i in range(KEPT_COUNTS + 2))).first()
    return [int(x) for x in each]


def _told(table: pa.Table, upto: int) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """(answers by level ``upto`` the highest told, weights) that a block was given, its buckets one after another.

    A level that the block asked nothing of has no answers.
    """
    table = table.sort_by([("level", "ascending"), ("bucket", "ascending")])
    levels, told = table.column("level").to_pylist(), table.column("told").to_pylist()
    by_level = {n: joined([grown(x) for m, x in zip(levels, told, strict=True) if m == n], np.uint64) for n in range(1, upto + 1)}
    weights = joined([x.values.to_numpy() for x in table.column("weights") if x.is_valid], float)
    return by_level, weights


def katz_scores(docs: DataFrame, order: int = 3, held_mod: int = 10, held_value: int = 0, block_tokens: int = 1_500_000, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """n-gram log10 probabilities of all whole texts, with a smoothed unigram base beside them.

    Tokens are the words of the text with A-Z in lower case, and an end. The model learns from
    rows whose crc32(id as text) mod ``held_mod`` isn't ``held_value``. A word after ``order`` - 1
    others has its Good-Turing discounted share if the n-gram was found, else the context's backoff
    weight times its share after one word less, and so on down to its own discounted share, or
    that of the one unknown word; a context that was never found is passed over. Weights are
    exact: the shares after every context sum to one, and frequent n-grams are discounted too,
    so each context leaves a share for words not seen after it.

    Texts are read once into blocks of about ``block_tokens`` tokens, kept bucketed. A block
    asks for the counts of its distinct words, then pairs, and so on, then for the weights of
    the contexts that it lacks an n-gram of; keys are dealt to buckets by hash, a bucket answers
    in the order asked, and leaves its part of the model's tables. What moves is distinct keys
    per block, so a frequent n-gram is one key per block, and none where a part of it is found
    once and no text outside the training texts may hold it. There are as many buckets as
    shuffle partitions, or more where the blocks are many, so a bucket stays of one size as
    texts grow. Words and n-grams are told apart by 64-bit hashes. With ``model``, a new folder,
    blocks ask for all their n-grams and the whole model's tables, by level and bucket, stay
    there; ``katz_model_scores`` scores other texts from them.

    One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score; a table written to the shared folder. Null or empty text: the end alone. Null ids: not
    learned from, held_out null. Repeated rows: learned and scored each. Other columns: ignored.
    No rows: no rows; no training text: every word is unknown.
    """
    spark = docs.sparkSession
    folder = model or scratch(spark, "katz")
    try:
        with _blocks(docs, held_mod, held_value, block_tokens, id_col, text_col) as blocks:
            return _learned_scores(blocks, order, folder, whole=model is not None)
    finally:
        if model is None:
            removed(spark, folder)


def _learned_scores(blocks: DataFrame, order: int, folder: str, whole: bool) -> DataFrame:
    """``katz_scores`` of a table of blocks; with ``whole`` the model's tables in ``folder`` are complete."""
    spark = blocks.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks.count() // BLOCKS_PER_BUCKET))
    told, discounts, below = None, [None, None], None
    total = kinds = 0

    def with_answers(made, schema: str) -> DataFrame:
        """``made`` of each block, with all that it was told so far."""
        return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(lambda key, own, said: made(own, said), schema)

    for n in range(1, order + 1):

        def ask(block: Block) -> Iterator[pa.RecordBatch]:
            keys, found = block.ask()
            yield from _rows(block.block, buckets, keys, n=found)
            if block.alone:
                yield row(arrow(ASK), bucket=int(block.block % buckets), block=block.block, keys=b"", n=b"\1", alone=block.alone)

        if n == 1:

            def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for i in range(len(batch)):
                        yield from ask(Block(pa.Table.from_batches([batch.slice(i, 1)]), whole=whole))

            asked = blocks.mapInArrow(first, ASK)
        else:
            asked = with_answers(lambda own, said: pa.Table.from_batches(list(ask(Block(own, _told(said, n - 1)[0], whole))), arrow(ASK)), ASK)
        answers = _kept(_count(asked), f"{folder}/level-{n}")
        sums = _sums(answers)
        if n == 1:
            total, kinds, *small = sums
            below = Unigrams(total, small)
        else:
            discounts.append(Discounts(sums[2:]))
        said = answers.filter("kind = 'told'").select("block", "bucket", "told", "weights", F.lit(n).alias("level"))
        told = said if told is None else told.unionByName(said)

    def weigh(own: pa.Table, said: pa.Table) -> pa.Table:
        block = Block(own, _told(said, order)[0], whole)
        keys, a, b = block.handed(below, discounts)
        return pa.Table.from_batches([*_rows(block.block, buckets, keys, a=a, b=b), *_rows(block.block, buckets, block.needed())], arrow(ASK))

    weights = _kept(_weigh(with_answers(weigh, ASK)), f"{folder}/weights")
    told = told.unionByName(weights.filter("kind = 'told'").select("block", "bucket", "told", "weights", F.lit(0).alias("level")))

    def score(own: pa.Table, said: pa.Table) -> pa.Table:
        block = Block(own, (answers := _told(said, order))[0], whole)
        p = block.probabilities(below, discounts, answers[1])
        return pa.Table.from_batches([_scored(block, p, total, kinds)])

    scores = written(with_answers(score, SCORES), "katz-scores")
    if whole:
        spark.createDataFrame([(order, buckets)], "`order` int, buckets int").coalesce(1).write.parquet(f"{folder}/shape")
    return scores


def _scored(block: Block, p: np.ndarray, total: int, kinds: int) -> pa.RecordBatch:
    count, size = block.count[1], np.diff(block.ends, prepend=0).astype(np.int64)
    known = np.add.reduceat((count > 0).astype(np.int64), block.begin)
    base = np.add.reduceat(np.log10(count + 0.1) - np.log10(total + 0.1 * (kinds + 1)), block.begin)
    return as_batch(arrow(SCORES), block.docs, block.held, size, known, np.full(len(size), total, np.int64), base, np.add.reduceat(np.log10(p), block.begin))


def katz_model_scores(docs: DataFrame, model: str, held_mod: int = 10, held_value: int = 0, block_tokens: int = 1_500_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same columns as ``katz_scores`` for any texts, from the tables that it left in ``model``.

    Blocks ask for their distinct n-grams, level by level, and then for the weights of contexts;
    asks meet the tables by bucket. ``held_out`` is that of the ids given. Odd rows: as there.
    """
    folder = scratch(docs.sparkSession, "katz-asks")
    try:
        with _blocks(docs, held_mod, held_value, block_tokens, id_col, text_col) as blocks:
            return _model_scores(blocks, model, folder)
    finally:
        removed(docs.sparkSession, folder)


def _model_scores(blocks: DataFrame, model: str, folder: str) -> DataFrame:
    """``katz_model_scores`` of a table of blocks; answers go to ``folder``."""
    spark = blocks.sparkSession
    order, buckets = spark.read.parquet(f"{model}/shape").first()
    levels = {n: spark.read.schema(TOLD).parquet(f"{model}/level-{n}") for n in range(1, order + 1)}
    sums = {n: _sums(t) for n, t in levels.items()}
    total, kinds, *small = sums[1]
    below, discounts, told = Unigrams(total, small), [None, None, *(Discounts(sums[n][2:]) for n in range(2, order + 1))], None

    def with_answers(made, schema: str) -> DataFrame:
        if told is None:
            return blocks.groupBy("block").applyInArrow(lambda own: made(own, None), schema)
        return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(lambda key, own, said: made(own, said), schema)

    def known(own: pa.Table, said: pa.Table | None, upto: int) -> tuple[Block, np.ndarray]:
        by_level, weights = _told(said, upto) if said is not None else ({}, np.zeros(0))
        return Block(own, by_level, whole=True, fresh=True), weights

    def ask(own: pa.Table, said: pa.Table | None) -> pa.Table:
        block = known(own, said, n - 1)[0]
        return pa.Table.from_batches(list(_rows(block.block, buckets, block.ask()[0])), arrow(ASK))

    def ask_weights(own: pa.Table, said: pa.Table) -> pa.Table:
        block = known(own, said, order)[0]
        return pa.Table.from_batches(list(_rows(block.block, buckets, block.needed())), arrow(ASK))

    def score(own: pa.Table, said: pa.Table) -> pa.Table:
        block, weights = known(own, said, order)
        return pa.Table.from_batches([_scored(block, block.probabilities(below, discounts, weights), total, kinds)])

    for n in [*range(1, order + 1), 0]:
        tables = levels[n] if n else spark.read.schema(TOLD).parquet(f"{model}/weights")
        answers = _kept(_look_up(with_answers(ask if n else ask_weights, ASK), tables.filter("kind = 'table'")), f"{folder}/level-{n}")
        said = answers.select("block", "bucket", "told", "weights", F.lit(n).alias("level"))
        told = said if told is None else told.unionByName(said)
    return written(with_answers(score, SCORES), "katz-scores")
