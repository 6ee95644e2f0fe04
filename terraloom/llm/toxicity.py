"""Toxic spans by a linear-chain conditional random field over words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import as_batch, crc_mod, sliced, strings
from .labelled import fit_logistic, labelled_sample, sigmoid, without_copies

#: Ends of sentences become line ends and other marks become spaces; one character stays one.
MARKS = {ord(c): "\n" for c in ".!?\n"} | {ord(c): " " for c in ",;:\"'()[]{}<>|#*$%&@=+~^`/\\_-\t\r\x0b\x0c"}


#: Words whose states are computed at once.
CHAIN_WORDS = 300_000


def sentences(text: str) -> list[str]:
    """Lower-case text without marks, cut into sentences; positions are those of the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low.translate(MARKS).split("\n")


def chains(ids: np.ndarray, lengths: np.ndarray, emission: np.ndarray, transition: np.ndarray, start: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over chains of two states laid end to end.

    Returns each word's marginal of state 1, each chain's log partition, and the expected counts
    of transitions (2, 2) over all chains, each counted ``weight`` times (1 unless given). Chains
    of similar length advance together.
    """
    marginal, logz, pairs = np.zeros(len(ids)), np.zeros(len(lengths)), np.zeros((2, 2))
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    move, emit = np.exp(transition), np.exp(emission)
    at = 0
    while at < len(order):
        longest = 1.25 * lengths[order[at]] + 4
        stop = at + int(np.searchsorted(lengths[order[at:]], longest, "right"))
        stop = min(stop, at + max(1, CHAIN_WORDS // int(longest)))
        some = order[at:stop]
        at = stop
        size, most = lengths[some], int(lengths[some].max())
        step = np.arange(most)[:, None]
        inside = step < size
        e = emit[ids[np.where(inside, begin[some] + step, 0)]]  # (time, chain, 2)
        alpha, scale = np.zeros((most, len(some), 2)), np.ones((most, len(some)))
        a = np.exp(start) * e[0]
        for t in range(most):
            if t:
                a = (a @ move) * e[t]
            s = a.sum(1)
            a = np.where(inside[t][:, None], a / s[:, None], alpha[t - 1])
            scale[t] = np.where(inside[t], s, 1)
            alpha[t] = a
        b = np.ones((len(some), 2))
        for t in range(most - 1, -1, -1):
            p = alpha[t] * b
            p /= p.sum(1, keepdims=True)
            marginal[begin[some[inside[t]]] + t] = p[inside[t], 1]
            if t:
                eb = e[t] * b / scale[t][:, None]
                own = alpha[t - 1][inside[t]] if weight is None else alpha[t - 1][inside[t]] * weight[some[inside[t]], None]
                pairs += (own[:, :, None] * eb[inside[t]][:, None, :]).sum(0) * move
                b = np.where(inside[t][:, None], eb @ move.T, b)
        logz[some] = np.log(scale).sum(0)
    return marginal, logz, pairs


class SpanTagger:
    """A two-state chain over words: state 1 marks toxic words.

    A word of the lexicon speaks for state 1 by its own weight and by those of the words before
    and after it (``before``, ``after``: by place in ``context``; 0: any other word, 1: none, as at
    an end of the sentence). All words that aren't in the lexicon share one weight.
    """

    def __init__(self, lexicon: list[str], context: list[str], emission: np.ndarray, before: np.ndarray, after: np.ndarray, transition: np.ndarray, start: np.ndarray, weights: np.ndarray):
        self.index, self.context = {w: i + 1 for i, w in enumerate(lexicon)}, {w: i + 2 for i, w in enumerate(context)}
        self.emission, self.before, self.after, self.transition, self.start, self.weights = emission, before, after, transition, start, weights
        self.plain: dict[int, tuple[float, float]] = {0: (0.0, 0.0)}

    def _plain(self, lengths: np.ndarray) -> None:
        """Marginals of sentences without a lexicon word depend on their length alone."""
        new = np.array([n for n in np.unique(lengths).tolist() if n not in self.plain], np.int64)
        if len(new):
            m, _, _ = chains(np.zeros(int(new.sum()), np.int64), new, self.emission, self.transition, self.start)
            for n, part in zip(new.tolist(), np.split(m, np.cumsum(new)[:-1]), strict=True):
                self.plain[n] = float(part.max()), float(part.sum())

    def neighbours(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the context of the word before and the word after each word of sentences laid end to end."""
        places, end = np.fromiter(map(self.context.get, words, repeat(0)), np.int64, len(words)), np.cumsum(lengths)
        before, after = np.roll(places, 1), np.roll(places, -1)
        before[(end - lengths)[lengths > 0]] = 1
        after[end[lengths > 0] - 1] = 1
        return before, after

    def evidence(self, ids: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """(words, 2) weights of the two states."""
        out = self.emission[ids].copy()
        out[:, 1] += np.where(ids > 0, self.before[before] + self.after[after], 0.0)
        return out

    def features(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """(highest marginal, log of 1 + their sum) and the toxic words (begin, end, marginal) per text."""
        cut = [sentences(t) for t in texts]
        words = [list(map(str.split, c)) for c in cut]
        lengths = np.fromiter(map(len, chain.from_iterable(words)), np.int64)
        ids = np.fromiter(map(self.index.get, chain.from_iterable(chain.from_iterable(words)), repeat(0)), np.int64, int(lengths.sum()))
        of_text = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        begin = np.cumsum(lengths) - lengths
        known = np.zeros(len(lengths), bool)
        known[np.searchsorted(begin, np.flatnonzero(ids), "right") - 1] = True
        self._plain(lengths[~known])
        high, total = np.zeros(len(texts)), np.zeros(len(texts))
        sizes, place = np.unique(lengths[~known], return_inverse=True)
        by_size = np.array([self.plain[n] for n in sizes.tolist()]).reshape(-1, 2)
        np.maximum.at(high, of_text[~known], by_size[place, 0])
        np.add.at(total, of_text[~known], by_size[place, 1])
        spans: list[list[tuple[int, int, float]]] = [[] for _ in texts]
        if known.any():
            own, first_of_text = np.flatnonzero(known), np.searchsorted(of_text, np.arange(len(texts)))
            rows = np.concatenate([np.arange(begin[s], begin[s] + lengths[s]) for s in own])
            flat = list(chain.from_iterable(words[of_text[s]][s - first_of_text[of_text[s]]] for s in own.tolist()))
            m, _, _ = chains(np.arange(len(rows)), lengths[own], self.evidence(ids[rows], *self.neighbours(flat, lengths[own])), self.transition, self.start)
            places: dict[int, list[int]] = {}  # where each sentence of a text begins
            for s, part in zip(own.tolist(), np.split(m, np.cumsum(lengths[own])[:-1]), strict=True):
                i = of_text[s]
                high[i], total[i] = max(high[i], part.max()), total[i] + part.sum()
                if part.max() >= 0.5:
                    if i not in places:
                        places[i] = list(accumulate((len(x) + 1 for x in cut[i]), initial=0))
                    k, at = s - first_of_text[i], 0
                    base, sentence = places[i][k], cut[i][k]
                    for w, p in zip(sentence.split(), part, strict=True):
                        at = sentence.index(w, at)
                        if p >= 0.5:
                            spans[i].append((base + at, base + at + len(w), float(p)))
                        at += len(w)
        return np.stack([high, np.log1p(total)], axis=1), spans

    def scores(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        x, spans = self.features(texts)
        return sigmoid(x @ self.weights[:-1] + self.weights[-1]), spans


def fit_tagger(sample: list[tuple[str, int]], min_docs: int = 4, min_share: float = 0.02, min_ratio: float = 12.0, max_lexicon: int = 5_000, max_context: int = 2_000, steps: int = 60) -> SpanTagger:
    """Learns a tagger from (text, toxic 0 or 1).

    Words of a toxic text are labelled toxic where the word is in ``min_docs`` toxic texts and
    in a share of ``min_share`` of them at least, and ``min_ratio`` times as frequent, by texts,
    in toxic as in other texts (three texts added to these, against chance); all other words
    are labelled clean, and so are these in other texts. So one word has both labels, and the words
    beside it tell them apart: the ``max_context`` most frequent ones beside words of the lexicon
    have weights. Copies count once. The field is fitted to these labels by gradient ascent on the
    penalised likelihood over all sentences. Those without a word of the lexicon differ in length
    alone, so each length is one chain with the number of its sentences as weight. Then a
    logistic fit turns the marginals of a text into its score. No toxic or no other text: every
    score is the share of toxic texts.
    """
    sample = without_copies(sample)
    y = np.array([t for _, t in sample], float)
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.0
        bias = float(np.log((rate + 1e-6) / (1 - rate + 1e-6)))
        return SpanTagger([], [], np.zeros((1, 2)), np.zeros(2), np.zeros(2), np.zeros((2, 2)), np.array([0.0, -20.0]), np.array([0.0, 0.0, bias]))
    shared: dict[str, str] = {}  # one object per word
    split = [[[shared.setdefault(w, w) for w in s.split()] for s in sentences(t)] for t, _ in sample]
    seen = [Counter(), Counter()]
    for words, (_, label) in zip(split, sample, strict=True):
        seen[label].update(set(chain.from_iterable(words)))
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    ratio = {w: (c / n1) / ((seen[0][w] + 3) / n0) for w, c in seen[1].items() if c >= max(min_docs, min_share * n1)}
    toxic = sorted((w for w, r in ratio.items() if r >= min_ratio), key=lambda w: (-ratio[w], w))[:max_lexicon]
    # a margin of merely associated words lets the field learn that they are not enough
    near = sorted((w for w, r in ratio.items() if min_ratio / 4 <= r < min_ratio), key=lambda w: (-ratio[w], w))[: max_lexicon - len(toxic)]
    lexicon = toxic + near
    index, bad = {w: i + 1 for i, w in enumerate(lexicon)}, len(toxic)
    used, gold, texts_of_used, plain = [], [], [], Counter()
    beside: Counter = Counter()
    for words, (_, label) in zip(split, sample, strict=True):
        for s in words:
            ids = [index.get(w, 0) for w in s]
            if any(ids):
                used.append(ids)
                texts_of_used.append(s)
                gold.append([int(label and 0 < i <= bad) for i in ids])
                beside.update(s[k] for i, x in enumerate(ids) if x for k in (i - 1, i + 1) if 0 <= k < len(s))
            elif ids:
                plain[len(ids)] += 1
    weight = np.array([1] * len(used) + list(plain.values()), float)
    for n in plain:
        used.append([0] * n)
        texts_of_used.append([""] * n)
        gold.append([0] * n)
    context = [w for w, n in sorted(beside.items(), key=lambda x: (-x[1], x[0]))[:max_context] if n >= min_docs]
    del split, words, shared
    ids, want, lengths = np.array(list(chain.from_iterable(used)), np.int64), np.array(list(chain.from_iterable(gold)), np.int64), np.array([len(u) for u in used], np.int64)
    emission, transition, start = np.zeros((len(lexicon) + 1, 2)), np.zeros((2, 2)), np.zeros(2)
    begin = np.cumsum(lengths) - lengths
    inner = np.ones(len(ids), bool)
    inner[begin] = False
    pairs = np.zeros((2, 2))
    by_word = np.repeat(weight, lengths)
    np.add.at(pairs, (want[np.flatnonzero(inner) - 1], want[inner]), by_word[inner])
    seen_ids = np.bincount(ids, weights=by_word, minlength=len(emission))
    good = np.bincount(ids, weights=want, minlength=len(emission))
    before, after = np.zeros(len(context) + 2), np.zeros(len(context) + 2)
    tagger = SpanTagger(lexicon, context, emission, before, after, transition, start, np.zeros(3))
    sides = tagger.neighbours(list(chain.from_iterable(texts_of_used)), lengths)
    marked, every = ids > 0, np.arange(len(ids))
    history = [np.full(v.shape, 1e-6) for v in (start, transition, emission[:, 1], before, after)]

    def slope(value: np.ndarray, place: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Labels less marginals by neighbour, with a penalty that leaves rare neighbours near 0."""
        gap = np.bincount(place[marked], weights=(want - m)[marked], minlength=len(value))
        return gap / (np.bincount(place[marked], minlength=len(value)) + 20.0) - 0.02 * value

    for _ in range(steps):
        m, _, expected = chains(every, lengths, tagger.evidence(ids, *sides), transition, start, weight)
        d_emit = (good - np.bincount(ids, weights=m * by_word, minlength=len(emission))) / seen_ids.clip(1) - 0.01 * emission[:, 1]
        d_move = (pairs - expected) / max(1.0, pairs.sum()) - 0.001 * transition
        d_start = np.array([0.0, ((want[begin] - m[begin]) * weight).sum() / weight.sum()]) - 0.001 * start
        d_sides = [slope(v, s, m) for v, s in zip((before, after), sides, strict=True)]
        for value, g, h in zip((start, transition, emission[:, 1], before, after), (d_start, d_move, d_emit, *d_sides), history, strict=True):
            h += g * g
            value += 1.5 * g / np.sqrt(h)
    x = np.concatenate([tagger.features([t for t, _ in sample[i : i + 100]])[0] for i in range(0, len(sample), 100)])
    tagger.weights = fit_logistic(x, y, ridge=0.05)
    return tagger


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = 1_200, held_mod: int = 4, held_value: int = 2, id_col: str = "doc_id", text_col: str = "text") -> SpanTagger:
    """A tagger from at most ``most`` toxic and as many other whole texts; see ``labelled_rows``."""
    return fit_tagger(labelled_sample(docs, labels, "toxic", most, held_mod, held_value, id_col, text_col))


def toxicity(docs: DataFrame, tagger: SpanTagger, threshold: float = 0.3, held_mod: int = 4, held_value: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold) and spans of every whole text.

    ``spans`` lists the words whose marginal is 0.5 or more as (begin, end, probability), in
    characters of the text. Null or empty text: the score of a text without words. Null ids:
    held_out null. Repeated rows and ties: a row each. Other columns: ignored. No rows: no rows.
    """
    span = "array<struct<begin:int,end:int,probability:double>>"
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])))])
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # a lexicon of bounded size and a few weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1 << 20):
            scores, spans = shared.value.scores(strings(batch, "text"))
            cells = [[{"begin": a, "end": b, "probability": p} for a, b, p in s] for s in spans]
            yield as_batch(schema, batch.column("doc_id"), scores, (scores >= threshold).astype(np.int32), cells)

    rows = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text")
    out = rows.mapInArrow(run, f"doc_id long, score double, predicted int, spans {span}")
    return out.select("doc_id", (crc_mod(F.col("doc_id"), held_mod) == held_value).alias("held_out"), "score", "predicted", "spans")


def keep_unflagged(docs: DataFrame, model, threshold: float, flagged_high: bool, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text the model does not reject.

    With ``flagged_high`` a score of the threshold or more rejects, else one below it.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema: T.StructType = docs.schema
    arrow, at = to_arrow_schema(schema), schema.names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col, 1 << 20):
            scores = shared.value.scores([t or "" for t in batch.column(at).to_pylist()])[0]
            keep = scores < threshold if flagged_high else scores >= threshold
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array(keep)).columns, schema=arrow)

    return docs.mapInArrow(run, schema)
