"""A bounded sample of labelled texts, and logistic fits shared by the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import crc_mod


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, held_mod: int, held_value: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame | None:
    """text, y (0 or 1) and place (their order) of at most ``most`` labelled texts of each class, by a hash of the id.

    Rows whose crc32(id as text) mod ``held_mod`` is ``held_value`` are never taken, nor are rows
    without an id, a label or a text. Texts are whole. An id with several labels counts with the
    largest. Ids decide who is taken, and are not given to the caller. No labels: None.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    known = known.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (crc_mod(F.col("id"), held_mod) != held_value))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("text <> ''")
    # a hash threshold that leaves about four times the bound saves sorting the rest
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, min(1.0, 4 * most / n)).otherwise(share)
    some = known.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share * 1_000_000)
    first = [some.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most) for y in sorted(sizes)]
    chosen = first[0] if len(first) == 1 else first[0].unionByName(first[1])
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("text").alias("text"))  # at most 2 * most ids
    return rows.select("text", "y", F.struct(F.xxhash64("id"), "id").alias("place"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, held_mod: int, held_value: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """The rows of ``labelled_rows`` as (text, y) in the driver."""
    rows = labelled_rows(docs, labels, label, most, held_mod, held_value, id_col, text_col)
    return [] if rows is None else [(r["text"], r["y"]) for r in rows.orderBy("place").select("text", "y").collect()]


def without_copies(sample: list[tuple[str, int]], shingle: int = 5) -> list[tuple[str, int]]:
    """The sample without texts that share a minimum hash of word shingles with an earlier one.

    Copies of one text, near ones included, would make its rare words look like signs of its
    label. Texts of fewer words count as one shingle.
    """
    import xxhash

    seen: tuple[set[int], set[int]] = (set(), set())
    kept = []
    for text, label in sample:
        words = text.lower().split()
        parts = {" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))}
        low = [min(xxhash.xxh64_intdigest(p, seed) for p in parts) for seed in (1, 2)]
        if low[0] not in seen[0] and low[1] not in seen[1]:
            kept.append((text, label))
        seen[0].add(low[0])
        seen[1].add(low[1])
    return kept


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights (bias last) of a ridge-penalised logistic regression, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
