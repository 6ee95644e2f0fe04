"""Quality scores by gated-attention multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_batch, crc_mod, sliced, strings
from .labelled import labelled_rows, sigmoid

#: Character classes by byte; bytes of other classes count as rest.
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b".,", b"!?", b"#*$%&", b"|<>", b"\"'()-:;", bytes(range(128, 256))]
TABLE = np.full(256, len(CLASSES), np.uint8)
for _i, _c in enumerate(CLASSES):
    TABLE[list(_c)] = _i
SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\x0b\x0c\r")] = True
WORD_SLOTS = 16
FEATURES = len(CLASSES) + 1 + 4 + WORD_SLOTS
ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.multiply.accumulate(out)


def passages(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, text number) of each passage of ``words`` words; no words: one row of zeros.

    Features: shares of character classes, mean word length, shares of short words, of words
    equal to the one before, of words found earlier in the passage, and of words by hash slot.
    """
    data = np.frombuffer(b" ".join([*(t.encode("utf-8", "surrogatepass") for t in texts), b""]), np.uint8)
    sizes = np.array([len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts], np.int64)
    text_begin = np.cumsum(sizes) - sizes
    gap = SPACE[data]
    before = np.concatenate([[True], gap[:-1]])
    start = np.flatnonzero(~gap & before)
    if not len(start):
        return np.zeros((len(texts), FEATURES)), np.arange(len(texts))
    end = np.flatnonzero(gap & ~before)
    of_text = np.searchsorted(text_begin, start, "right") - 1
    first_word = np.searchsorted(of_text, np.arange(len(texts)))
    rank = np.arange(len(start)) - first_word[of_text]
    head = np.flatnonzero(rank % words == 0)  # first word of each passage
    passage = np.cumsum(rank % words == 0) - 1
    count = np.diff(np.append(head, len(start)))
    length = end - start
    weight = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(data.astype(np.uint64) * _powers(ODD, len(data)))])
    value = (weight[end] - weight[start]) * _powers(ODD_INVERSE, len(data))[start] * np.uint64(0xD6E8FEB86659FD93)
    equal = np.concatenate([[False], (value[1:] == value[:-1]) & (passage[1:] == passage[:-1])])
    order = np.lexsort((value, passage))
    again = np.zeros(len(start), bool)
    again[order[1:]] = (value[order[1:]] == value[order[:-1]]) & (passage[order[1:]] == passage[order[:-1]])
    x = np.zeros((len(head), FEATURES))
    kind, bounds = TABLE[data], start[head]
    stop = end[np.append(head[1:], len(start)) - 1]
    size = stop - bounds
    inside = np.stack([bounds, stop], axis=1).reshape(-1)  # a passage ends with its last word
    for c in range(len(CLASSES) + 1):
        x[:, c] = np.add.reduceat(kind == c, inside, dtype=np.int64)[::2] / size
    at = len(CLASSES) + 1
    x[:, at] = np.log1p(size / count)
    x[:, at + 1] = np.bincount(passage, weights=length <= 3, minlength=len(head)) / count
    x[:, at + 2] = np.bincount(passage, weights=equal, minlength=len(head)) / count
    x[:, at + 3] = np.bincount(passage, weights=again, minlength=len(head)) / count
    slot = (value >> np.uint64(60)).astype(np.int64)
    x[:, at + 4 :] = np.bincount(passage * WORD_SLOTS + slot, minlength=len(head) * WORD_SLOTS).reshape(-1, WORD_SLOTS) / count[:, None]
    owner = of_text[head]
    empty = np.setdiff1d(np.arange(len(texts)), owner)
    if len(empty):
        x, owner = np.vstack([x, np.zeros((len(empty), FEATURES))]), np.concatenate([owner, empty])
        order = np.argsort(owner, kind="stable")
        x, owner = x[order], owner[order]
    return x, owner


class AttentionModel:
    """Encoder, gated attention over the passages of a text, and a score of their weighted mean.

    h = relu(x A + a); weight of a passage: softmax over the text of (tanh(h V) * sigmoid(h U)) w;
    score: sigmoid of the weighted mean of h times c, plus a constant.
    """

    def __init__(self, words: int, mean: np.ndarray, spread: np.ndarray, parts: dict[str, np.ndarray]):
        self.words, self.mean, self.spread, self.parts = words, mean, spread, parts

    def forward(self, x: np.ndarray, owner: np.ndarray, texts: int) -> dict[str, np.ndarray]:
        p = self.parts
        h = np.maximum(0, x @ p["A"] + p["a"])
        tanh, gate = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        raw = (tanh * gate) @ p["w"]
        first = np.searchsorted(owner, np.arange(texts))
        e = np.exp(raw - np.maximum.reduceat(raw, first)[owner])
        share = e / np.add.reduceat(e, first)[owner]
        mean = np.add.reduceat(share[:, None] * h, first, axis=0)
        return {"h": h, "tanh": tanh, "gate": gate, "share": share, "mean": mean, "score": sigmoid(mean @ p["c"] + p["b"][0])}

    def gradients(self, x: np.ndarray, owner: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the weighted log loss of all texts in each parameter."""
        f, p = self.forward(x, owner, len(y)), self.parts
        d = (f["score"] - y) * weight
        by_passage = (d[:, None] * p["c"])[owner]
        through = (f["h"] * by_passage).sum(1)
        d_raw = f["share"] * (through - np.bincount(owner, weights=f["share"] * through)[owner])
        d_gated = d_raw[:, None] * p["w"]
        d_v, d_u = d_gated * f["gate"] * (1 - f["tanh"] ** 2), d_gated * f["tanh"] * f["gate"] * (1 - f["gate"])
        d_h = (f["share"][:, None] * by_passage + d_v @ p["V"].T + d_u @ p["U"].T) * (f["h"] > 0)
        return {"A": x.T @ d_h, "a": d_h.sum(0), "V": f["h"].T @ d_v, "U": f["h"].T @ d_u, "w": (f["tanh"] * f["gate"]).T @ d_raw, "c": f["mean"].T @ d, "b": np.array([d.sum()])}

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(score of each text, highest attention of one of its passages)"""
        if not texts:
            return np.zeros(0), np.zeros(0)
        x, owner = passages(texts, self.words)
        out = self.forward((x - self.mean) / self.spread, owner, len(texts))
        return out["score"], np.maximum.reduceat(out["share"], np.searchsorted(owner, np.arange(len(texts))))


def fit_attention(sample: list[tuple[str, int]], words: int = 64, **settings) -> AttentionModel:
    """``fit_passages`` on (text, 0 or 1)."""
    return fit_passages(*passages([t for t, _ in sample], words), np.array([t for _, t in sample], float), words, **settings)


def fit_passages(x: np.ndarray, owner: np.ndarray, y: np.ndarray, words: int = 64, width: int = 16, gates: int = 8, steps: int = 300, rate: float = 0.02, decay: float = 1e-3, seed: int = 0) -> AttentionModel:
    """Fits the model by Adam on the class-balanced loss, all texts at a step.

    ``x``, ``owner``: features and text number of each passage, as ``passages`` gives them; ``y``:
    label of each text. One class only: every score is sigmoid(4), or sigmoid(-4) for label 0; no
    text: 0.5.
    """
    rng = np.random.default_rng(seed)
    shape = {"A": (FEATURES, width), "a": (width,), "V": (width, gates), "U": (width, gates), "w": (gates,), "c": (width,), "b": (1,)}
    parts = {k: rng.normal(0, 0.3, s) if k.isupper() or k in "wc" else np.zeros(s) for k, s in shape.items()}
    if not len(y) or y.min() == y.max():
        parts = {k: np.zeros_like(v) for k, v in parts.items()}
        if len(y):
            parts["b"][0] = 4.0 if y[0] else -4.0
        return AttentionModel(words, np.zeros(FEATURES), np.ones(FEATURES), parts)
    model = AttentionModel(words, x.mean(0), x.std(0) + 0.02, parts)
    x = (x - model.mean) / model.spread
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    first, second = {k: np.zeros_like(v) for k, v in parts.items()}, {k: np.zeros_like(v) for k, v in parts.items()}
    for t in range(1, steps + 1):
        g = model.gradients(x, owner, y, balance / len(y))
        for k, v in parts.items():
            slope = g[k] + decay * v * (k not in "ab")
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            v -= rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = 1_500, words: int = 64, held_mod: int = 5, held_value: int = 0, id_col: str = "doc_id", text_col: str = "text") -> AttentionModel:
    """A model from at most ``most`` whole texts of each label; see ``labelled_rows``.

    Tasks make the features of passages; the driver gets these alone, some 260 bytes for 64 words.
    """
    rows = labelled_rows(docs, labels, "quality", most, held_mod, held_value, id_col, text_col)
    if rows is None:
        return fit_attention([], words)
    schema = pa.schema([("y", pa.int32()), ("hash", pa.int64()), ("id", pa.int64()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1 << 20):
            x, owner = passages(strings(batch, "text"), words)
            parts = np.split(x, np.searchsorted(owner, np.arange(1, batch.num_rows)))
            yield as_batch(schema, batch.column("y"), batch.column("hash"), batch.column("id"), [p.tobytes() for p in parts])

    made = rows.select("text", "y", F.col("place").getField("col1").alias("hash"), F.col("place").getField("id").alias("id")).mapInArrow(run, "y int, hash long, id long, x binary")
    found = made.orderBy("hash", "id").collect()
    listed = [np.frombuffer(r["x"]).reshape(-1, FEATURES) for r in found]
    owner = np.repeat(np.arange(len(listed)), [len(v) for v in listed])
    return fit_passages(np.concatenate([np.zeros((0, FEATURES)), *listed]), owner, np.array([r["y"] for r in found], float), words)


def quality_scores(docs: DataFrame, model: AttentionModel, threshold: float = 0.3, held_mod: int = 5, held_value: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold) and top_attention of every whole text.

    ``top_attention`` is the largest weight that one passage has. Null or empty text: the score
    of one passage of zeros. Null ids: held_out null. Repeated rows and ties: a row each. Other
    columns: ignored. No rows: no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("top_attention", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1 << 20):
            scores, top = shared.value.scores(strings(batch, "text"))
            yield as_batch(schema, batch.column("doc_id"), scores, (scores >= threshold).astype(np.int32), top)

    rows = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text")
    out = rows.mapInArrow(run, "doc_id long, score double, predicted int, top_attention double")
    return out.select("doc_id", (crc_mod(F.col("doc_id"), held_mod) == held_value).alias("held_out"), "score", "predicted", "top_attention")
