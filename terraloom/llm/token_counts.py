"""Token counts without ids: batch encoding in an Arrow function that returns lengths only."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import as_batch, sliced, strings

#: Closing marks after a digit or a Latin letter (but İ, which lowers to one and a mark): after other marks they may share a token with them.
CLOSING = re.compile(r"(?<=[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f])[.,;:!?]+\Z")
#: Letters beyond those of Latin, or whose lower case depends on the library.
ODD_CASE = re.compile("[^\x00-\u024f]|\u0130")
#: How the vocabulary marks the last token of a word.
WORD_END = "</w>"
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class LengthEncoder:
    """Counts tokens of many texts, each split where no token can cross.

    The vocabulary's splitter never lets a token hold a space or a line feed, and neither
    composes with what follows, so words between them are encoded apart. Nor does a token hold
    a letter or digit and a punctuation mark, so closing marks are encoded apart too where one
    stands before them. The library lowers case anyway, after it has looked for special strings;
    for texts whose letters all lower alike everywhere, and that hold no special string then,
    it's done first, so that fewer distinct words remain. Each distinct word of a batch is encoded once; lengths are
    kept while they are fewer than ``max_words``.
    """

    def __init__(self, path: str, max_words: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.max_words = max_words
        self.lengths: dict[str, int] = {}
        self.stems: dict[str, int] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _encode(self, wanted: set[str]) -> None:
        """Words of Latin letters go together in long texts, as the last token of each is marked."""
        new = list(wanted - self.stems.keys())
        letters = [w for w in new if w.isalpha() and not ODD_CASE.search(w)]
        for i in range(0, len(letters), 2_000):
            part = letters[i : i + 2_000]
            (encoded,) = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            last = np.flatnonzero(self.ends[encoded.ids])
            self.stems.update(zip(part, np.diff(last, prepend=-1).tolist(), strict=True))
        other = [w for w in new if w not in self.stems]
        for i in range(0, len(other), 20_000):
            part = other[i : i + 20_000]
            self.stems.update(zip(part, map(len, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)), strict=True))

    def _lowered(self, text: str) -> str:
        low = text.lower()
        return text if ODD_CASE.search(text) or any(s in low for s in self.special) else low

    def counts(self, texts: list[str]) -> list[int]:
        split = [self._lowered(t).replace("\n", " ").split(" ") for t in texts]
        if len(self.lengths) > self.max_words:
            self.lengths.clear()
            self.stems.clear()
        lengths, stems = self.lengths, self.stems
        new = [(w, m.start() if (m := CLOSING.search(w)) else len(w)) for w in set().union(*split) - lengths.keys()]
        self._encode({part for w, n in new for part in (w[:n], w[n:])})
        lengths.update((w, stems[w[:n]] + stems[w[n:]]) for w, n in new)
        return [sum(map(lengths.__getitem__, words)) for words in split]


@lru_cache(2)
def length_encoder(path: str) -> LengthEncoder:
    """The encoder of a file, kept with its words from task to task of a worker."""
    return LengthEncoder(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, batch_bytes: int = 2 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every whole text.

    ``vocabulary``: path of a word-level BPE file of the tokenizers library, at the same place
    on every executor. Special strings in a text count as that library counts them by default.
    Null or empty text: no bytes, no tokens. Null ids, repeated rows and ties: each row yields
    its row. Other columns are ignored, so their names can't clash; no rows: no rows.
    Work is batched by bytes, so a batch holds about ``batch_bytes`` or one longer text.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = length_encoder(vocabulary)
        for batch in sliced(batches, "text", batch_bytes):
            n = encoder.counts(strings(batch, "text"))
            yield as_batch(schema, batch.column("doc_id"), pc.binary_length(batch.column("text")).fill_null(0).cast(pa.int64()), n, [x > limit for x in n])

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, COUNTS)
