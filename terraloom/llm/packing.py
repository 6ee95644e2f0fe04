"""Cost-balanced packing of token ids into sequences of fixed capacity."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import as_batch, sliced, strings

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])
#: A space inside a run of white space, where a cut before it could change the tokens.
INNER_SPACE = re.compile(r"\s (?:\s|$)")
#: Characters beyond Latin letters and ASCII.
ODD = re.compile("[^\x00-\u024f]")
CUT = re.compile(r"(?<=\S)(?= )")


class IdEncoder:
    """Ids of texts as little-endian 32-bit bytes, by a byte-level BPE file.

    Tokens of such a file never cross from a character that isn't white space into a space, nor
    depend on what stands before; texts are cut there and each distinct piece is encoded once.
    Texts that name a special token are encoded whole. Where ``ranks`` names the same
    vocabulary as a rank file, pieces of Latin letters are encoded by the faster library that
    reads it; both give the same ids, and other letters, which the libraries' Unicode tables
    may class differently, stay with the first.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str = "", max_pieces: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.max_pieces = max_pieces
        self.fast = None
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.widths = np.zeros(max(merges.values()) + 1, np.int64)
            self.widths[list(merges.values())] = [len(token) for token in merges]
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={}).encode_ordinary
        self.after_space: dict[str, bytes] = {}
        self.plain: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, known: dict[str, bytes], wanted: set[str], prefix: str) -> None:
        new = list(wanted - known.keys())
        if self.fast:
            latin = [p for p in new if not ODD.search(p)]
            # pieces without white space at their ends keep their tokens where a space parts them
            whole = [p for p in latin if prefix and p and not p[0].isspace() and not p[-1].isspace()]
            for i in range(0, len(whole), 5_000):
                part = whole[i : i + 5_000]
                ids = np.array(self.fast(" " + " ".join(part)), "<u4")
                ends = np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum([len(p.encode()) + 1 for p in part])) + 1
                flat, ends = ids.tobytes(), (ends * 4).tolist()
                known.update((p, flat[a:b]) for p, a, b in zip(part, [0, *ends], ends, strict=False))
            known.update((p, array("I", self.fast(prefix + p)).tobytes()) for p in latin if p not in known)
            new = [p for p in new if p not in known]
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            known.update(zip(part, self._encode([prefix + p for p in part]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        for known in (self.after_space, self.plain):
            if len(known) > self.max_pieces:
                known.clear()
        split, plain, out = [], set(), []
        for t in texts:
            if any(s in t for s in self.special):
                split.append((None, None))
            elif INNER_SPACE.search(t):
                split.append((CUT.split(t), None))
                plain.update(split[-1][0])
            else:
                first, *rest = t.split(" ")
                split.append(([first], rest))
                plain.add(first)
        self._learn(self.after_space, set().union(*(rest for _, rest in split if rest)), " ")
        self._learn(self.plain, plain, "")
        for t, (head, rest) in zip(texts, split, strict=True):
            if head is None:
                out.append(self._encode([t])[0])
            else:
                out.append(b"".join(map(self.plain.__getitem__, head)) + b"".join(map(self.after_space.__getitem__, rest or ())))
        return out


@lru_cache(2)
def id_encoder(path: str, ranks: str | None, pattern: str) -> IdEncoder:
    """The encoder of a file, kept with its pieces from task to task of a worker."""
    return IdEncoder(path, ranks, pattern)


def balance(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in piece, length, sequence, offset) of pieces dealt to the fewest sequences.

    Pieces in descending cost ``linear * n + quadratic * n * n`` (ties: input order) go to the
    sequence of lowest cost that has room (ties: lowest number). A piece that fits nowhere is
    cut: its head fills the sequence with most room and the rest is dealt on, so that all
    sequences together leave less than one capacity free.
    """
    count = -(-int(lengths.sum()) // capacity)
    room, cost, out = np.full(count, capacity, np.int64), np.zeros(count), []
    # cost where there is room for the current piece; pieces only get shorter, so most stay valid
    for i in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[i])
        while left:
            fits = np.where(room >= left, cost, np.inf)
            s = int(fits.argmin())
            n = left
            if fits[s] == np.inf:
                s = int(room.argmax())
                n = int(room[s])
            out.append((i, start, n, s, capacity - int(room[s])))
            room[s] -= n
            cost[s] += linear * n + quadratic * n * n
            start, left = start + n, left - n
    return out


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str = "", capacity: int = 1024, end_id: int = 0, linear: float = 1.0, quadratic: float = 1 / 1024, window: int = 4096, batch_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` ids, one row per piece.

    A document is the ids of its whole text and ``end_id``. Whole capacities of a document fill
    sequences of their own; what is left over of each document is gathered, ``window`` of them
    at a time, and dealt by ``balance``. Each task packs the rows it reads: nothing is shuffled,
    memory holds one window, and a repeated task makes the same sequences. ``sequence_id`` has
    the task's partition in its high bits, so it is unique in the result and not contiguous.
    Padding is less than one sequence per window and per task.

    Null or empty text: the end id alone. Null ids, repeated rows and ties: each row is packed
    on its own. Other columns are ignored; no rows: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, made = id_encoder(vocabulary, ranks, pattern), TaskContext.get().partitionId() << 40
        end, wide = np.uint32(end_id).tobytes(), capacity * 4
        rest: list[tuple] = []

        def deal() -> list[tuple]:
            nonlocal made
            rows = []
            if rest:
                placed = balance(np.array([len(r[2]) // 4 for r in rest]), capacity, linear, quadratic)
                for i, start, n, s, offset in placed:
                    doc, before, ids, total = rest[i]
                    rows.append((doc, before + start, n, zlib.crc32(ids[start * 4 : (start + n) * 4]), total, made + s, offset))
                made += max(p[3] for p in placed) + 1
                rest.clear()
            return rows

        for batch in sliced(batches, "text", batch_bytes):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(strings(batch, "text")), strict=True):
                ids += end
                total = len(ids) // 4
                for begin in range(0, len(ids) - wide + 1, wide):
                    rows.append((doc, begin // 4, capacity, zlib.crc32(ids[begin : begin + wide]), total, made, 0))
                    made += 1
                if left := len(ids) % wide:
                    rest.append((doc, (len(ids) - left) // 4, ids[-left:], total))
                    if len(rest) >= window:
                        rows += deal()
            if rows:
                yield as_batch(SCHEMA, *zip(*rows, strict=True))
        if rows := deal():
            yield as_batch(SCHEMA, *zip(*rows, strict=True))

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, PIECES)
