"""SentencePiece encoding and decoding, batched in numpy over words of equal length."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_batch, ranges, sliced, strings

SPACE = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
#: Spaces before a word, or at the end of a text.
SPACED = re.compile(r" *[^ ]+| +\Z")
LINE = re.compile(r"\n|[^\n]+")
NONE = -np.inf
INDEX_BITS = 18
#: Words of so many characters are cut where no piece crosses.
LONG_WORD = 48
#: Words of over four windows advance in windows that share characters with the next. Where pieces
#: repeat, as in a run of one letter, they fall in step again if the window's length divides by theirs.
WINDOW, SHARED = 1680, 128
#: Windows that advance together.
MOST_WINDOWS = 600


def _hashes(codes: np.ndarray) -> np.ndarray:
    """(words, length + 1) prefix hashes of rows of code points."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * BASE + (codes[:, i] + np.uint64(1)) * SPREAD
    return out


class PieceModel:
    """The pieces of a model file, found by the hash of a substring in sorted keys.

    Words are segmented by Viterbi: the words of one length advance together from end to end of
    a piece, and vectorised maxima over the pieces that end there store backpointers. For unigram
    files a path's worth is the sum of its pieces' scores. Files of the BPE kind state the order
    of merges as scores: there a step from one piece to the next is worth nothing or, if merging
    would not leave these two side by side, is forbidden. A segmentation is that of the merges
    exactly if each two neighbours are, so one path is left, and it is the library's.

    Files that normalise text, or hold pieces of the user's own, are refused.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(m.serialized_model_proto())
        self.unigram = proto.trainer_spec.model_type == 1
        plain = proto.normalizer_spec
        if plain.precompiled_charsmap or plain.remove_extra_whitespaces or not plain.add_dummy_prefix or not plain.escape_whitespaces or any(x.type == x.USER_DEFINED for x in proto.pieces):
            raise ValueError(f"{path}: the file changes texts, or has pieces of the user's own")
        self.unknown = m.unk_id()
        ids = [i for i in range(m.get_piece_size()) if not (m.is_unknown(i) or m.is_control(i) or m.is_byte(i) or m.is_unused(i))]
        pieces = [m.id_to_piece(i) for i in ids]
        self.longest = max(map(len, pieces))
        self.spaces_first = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        keys, by_length = np.zeros(len(ids), np.uint64), defaultdict(list)
        for k, p in enumerate(pieces):
            by_length[len(p)].append(k)
        for n, own in by_length.items():
            keys[own] = _hashes(np.array([list(map(ord, pieces[k])) for k in own], np.uint64).reshape(-1, n))[:, -1]
        order = np.argsort(keys)
        self.keys, self.ids, self.scores = keys[order], np.array(ids)[order], np.array([m.get_score(i) for i in ids])[order]
        self.sizes = np.array([len(p) for p in pieces])[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.lines_apart = not any("\n" in p for p in pieces) and any(map(m.is_byte, range(m.get_piece_size())))
        self.bytes = {int(m.id_to_piece(i)[3:5], 16): i for i in range(m.get_piece_size()) if m.is_byte(i)}
        edges = np.arange(1 << INDEX_BITS, dtype=np.uint64) << np.uint64(64 - INDEX_BITS)
        self.first_of = np.searchsorted(self.keys, edges).astype(np.int32)
        self.most_alike = int(np.diff(np.append(self.first_of, len(self.keys))).max())
        self.padded = np.concatenate([self.keys, np.zeros(self.most_alike + 1, np.uint64)])  # no piece hashes to 0
        self.worst = float(self.scores.min()) - 10
        self.power = np.ones(1, np.uint64)
        self._raise_power(self.longest)
        self.cache: dict[str, bytes] = {}
        texts = [b""] * m.get_piece_size()
        for i, p in zip(ids, pieces, strict=True):
            texts[i] = p.replace(SPACE, " ").encode()
        for b, i in self.bytes.items():
            texts[i] = bytes([b])
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.text_size = np.array([len(t) for t in texts])
        self.text_begin = np.cumsum(self.text_size) - self.text_size
        pairs = np.unique(np.array([ord(a) << 32 | ord(b) for p in pieces for a, b in pairwise(p)], np.uint64))
        self.pairs = pairs if len(pairs) else np.zeros(1, np.uint64)
        if not self.unigram:
            self._take_apart([pieces[k] for k in order])

    def _take_apart(self, pieces: list[str]) -> None:
        """left, right: the two pieces that each piece is merged of last (-1: a single character);
        rank: the order of that merge; whole: whether merging its characters gives the piece at all."""
        n = len(pieces)
        self.left, self.right, self.rank, self.whole = np.full(n, -1), np.full(n, -1), np.full(n, -1), self.sizes == 1
        for size in np.unique(self.sizes[self.sizes > 1]).tolist():
            own = np.flatnonzero(self.sizes == size)
            h = _hashes(np.array([list(map(ord, pieces[k])) for k in own], np.uint64))
            cut = self._last_merges(h)
            k, at, row = own[cut > 0], cut[cut > 0], np.flatnonzero(cut > 0)
            self.left[k], self.right[k] = (self._find(self._between(h, row, b, e)) for b, e in ((np.zeros_like(at), at), (at, np.full_like(at, size))))
            self.whole[k] = True
        merged = np.flatnonzero(self.sizes > 1)
        self.rank[merged] = np.unique(-self.scores[merged], return_inverse=True)[1]
        made = self.whole & (self.sizes > 1)
        for part in (self.left, self.right):
            if (self.rank[part[made]] > self.rank[made]).any():
                raise ValueError("pieces are not in the order of their merges")

    def _raise_power(self, n: int) -> None:
        """Keeps the powers of the hash base up to n."""
        if len(self.power) <= n:
            self.power = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(2 * n, BASE))])

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Position of each hash in the sorted keys, -1 where no piece has it.

        The highest bits say where in the keys a hash would be.
        """
        at = self.first_of[(key >> np.uint64(64 - INDEX_BITS)).astype(np.int64)]
        found = np.where(self.padded[at] == key, at, -1)
        for step in range(1, self.most_alike):
            more = at + step
            found = np.where(self.padded[more] == key, more, found)
        return found

    def _between(self, h: np.ndarray, row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return h[row, end] - h[row, begin] * self.power[end - begin]

    def _last_merges(self, h: np.ndarray) -> np.ndarray:
        """Where the last two symbols of each word meet when its best pairs are merged, leftmost first on ties; 0 where more are left."""
        n, length = h.shape[0], h.shape[1] - 1
        bound, row, out = np.tile(np.arange(length + 1), (n, 1)), np.arange(n), np.zeros(n, np.int64)

        def rate(row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
            at = self._find(self._between(h, row, begin, end))
            return np.where(at >= 0, self.scores[at], NONE)

        while bound.shape[1] > 3 and len(row):
            pair = rate(np.repeat(row, bound.shape[1] - 2), bound[:, :-2].ravel(), bound[:, 2:].ravel()).reshape(len(row), -1)
            j = pair.argmax(1)
            go = pair[np.arange(len(row)), j] > NONE
            row, bound, j = row[go], bound[go], j[go]
            keep = np.ones(bound.shape, bool)
            keep[np.arange(len(row)), j + 1] = False
            bound = bound[keep].reshape(len(row), bound.shape[1] - 1)
        out[row] = bound[:, 1]
        return out

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves pieces a and b side by side (-1, a character without a piece: always).

        Merges are undone from the last one back. At each step the two symbols that meet must have
        no piece of their own that would have come before the merge just undone: one of a better
        rank, or of the same further to the left.
        """
        fine = np.ones(len(a), bool)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        a, b, limit = a[at], b[at], np.full(len(at), len(self.keys))
        while len(at):
            both = self._find(self.keys[a] * self.power[self.sizes[b]] + self.keys[b])
            ra, rb = self.rank[a], self.rank[b]
            bad = (both >= 0) & (self.rank[both] < limit)
            fine[at[bad]] = False
            go = ~bad & (np.maximum(ra, rb) >= 0)
            at, a, b, ra, rb = at[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return fine

    def _cuts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, begin, end) of the pieces of each word's best path."""
        n, length = h.shape[0], h.shape[1] - 1
        best, back, last, every = np.zeros((n, length + 1)), np.zeros((n, length + 1), np.int64), np.full((n, length + 1), -1), np.arange(n)
        for end in range(1, length + 1):
            begin = np.arange(max(0, end - self.longest), end)
            at = self._find(h[:, end, None] - h[:, begin] * self.power[end - begin])
            alone = begin == end - 1
            if self.unigram:
                score = np.where(at >= 0, self.scores[at], np.where(alone, self.worst, NONE)) + best[:, begin]
            else:
                score = np.where((at < 0) & alone, 0.0, NONE)
                row, column = np.nonzero((at >= 0) & self.whole[at])
                score[row, column] = np.where(self._apart(last[row, begin[column]], at[row, column]), 0.0, NONE)
            pick = score.argmax(1)
            best[:, end], back[:, end], last[:, end] = score[every, pick], begin[pick], at[every, pick]
        # all words step back together from their ends
        ends, here = np.zeros((n, length + 1), bool), np.full(n, length)
        while here.any():
            ends[every, here] = True
            here = back[every, here]
        ends[:, 0] = False
        row, end = np.nonzero(ends)
        return row, back[row, end], end

    def _pieces(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, begin, end, piece) of the best paths of words given as rows of code points."""
        h = _hashes(codes.astype(np.uint64))
        self._raise_power(h.shape[1])
        row, begin, end = self._cuts(h)
        return row, begin, end, self._find(self._between(h, row, begin, end))

    def _windowed(self, codes: np.ndarray) -> list[np.ndarray]:
        """[begin, end, piece] of the only path of one long word of a file of the BPE kind.

        After the first, which tells where a piece begins, its windows advance together. Where a
        window and the next have a piece in common, the path goes on in the next: each two
        neighbours are still side by side in one of the two, and such a path is the word's. If
        two windows have none, the word advances as a whole.
        """
        own = [self._pieces(codes[None, :WINDOW])[1:]]
        lead = int(own[0][0][np.searchsorted(own[0][0], WINDOW // 2)])
        m = (len(codes) - lead - SHARED) // WINDOW
        views = np.lib.stride_tricks.sliding_window_view(codes[lead:], WINDOW + SHARED)[::WINDOW]
        for i in [*range(0, m, MOST_WINDOWS), m]:
            some = codes[None, lead + m * WINDOW :] if i == m else views[i : min(m, i + MOST_WINDOWS)]
            row, begin, end, at = self._pieces(some)
            start = lead + WINDOW * (i + row)
            edges = np.searchsorted(row, np.arange(len(some) + 1)).tolist()
            own += [[x[a:b] for x in (begin + start, end + start, at)] for a, b in pairwise(edges)]
        first, parts = 0, []
        for here, after in pairwise(own):
            _, i, j = np.intersect1d(*((b * (self.longest + 1) + e - b) for b, e, _ in (here, after)), assume_unique=True, return_indices=True)
            if not len(i):
                return list(self._pieces(codes[None])[1:])
            parts.append([x[first : i[0]] for x in here])
            first = j[0]
        parts.append([x[first:] for x in own[-1]])
        return [np.concatenate(x) for x in zip(*parts, strict=True)]

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit bytes; all words have one length."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1)
        if codes.shape[1] > 4 * WINDOW and not self.unigram:
            each = [self._windowed(c) for c in codes]
            row = np.repeat(np.arange(len(words)), [len(e[0]) for e in each])
            begin, end, at = (np.concatenate(x) for x in zip(*each, strict=True))
        else:
            row, begin, end, at = self._pieces(codes)
        count = np.bincount(row, minlength=len(words))
        ids = np.where(at >= 0, self.ids[at], -1)
        first = np.cumsum(count) - count
        missing = set(row[at < 0].tolist())
        flat = ids.astype("<u4").tobytes()
        out = [flat[4 * a : 4 * (a + n)] for a, n in zip(first.tolist(), count.tolist(), strict=True)]
        for r in missing:
            parts: list[int] = []
            for i in range(first[r], first[r] + count[r]):
                if ids[i] >= 0:
                    parts.append(int(ids[i]))
                elif self.bytes:
                    parts += [self.bytes[b] for b in words[r][begin[i] : end[i]].encode("utf-8", "replace")]
                elif not parts or parts[-1] != self.unknown:
                    parts.append(self.unknown)
            out[r] = np.array(parts, "<u4").tobytes()
        return out

    def _learn(self, wanted: set[str]) -> None:
        parts = {}
        for w in wanted - self.cache.keys():
            if len(w) >= LONG_WORD:
                parts[w] = self._parts(w)
            elif self.lines_apart and "\n" in w:
                parts[w] = LINE.findall(w)
            else:
                parts[w] = [w]
        by_length: dict[int, set[str]] = defaultdict(set)
        for own in parts.values():
            for p in own:
                by_length[len(p)].add(p)
        made: dict[str, bytes] = {}
        for n, some in by_length.items():
            rest, step = list(some), max(1, 200_000 // n)
            for i in range(0, len(rest), step):
                made.update(zip(rest[i : i + step], self.segment(rest[i : i + step]), strict=True))
        self.cache.update((w, made[own[0]] if len(own) == 1 else b"".join(map(made.__getitem__, own))) for w, own in parts.items())

    def _parts(self, word: str) -> list[str]:
        """Parts of a long word that no piece crosses: cut between characters that no piece has side by side.

        Characters without a piece stay together, as the library writes one unknown for a run of them.
        """
        codes = np.array(list(map(ord, word)), np.uint64)
        pair = codes[:-1] << np.uint64(32) | codes[1:]
        at = np.searchsorted(self.pairs, pair).clip(max=len(self.pairs) - 1)
        apart = self.pairs[at] != pair
        if not self.bytes:
            known = self._find((codes + np.uint64(1)) * SPREAD) >= 0
            apart &= known[:-1] | known[1:]
        cuts = [0, *(np.flatnonzero(apart) + 1).tolist(), len(word)]
        return [word[i:j] for i, j in pairwise(cuts)]

    def encode(self, texts: list[str], most: int = 400_000) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit bytes. Each distinct word is segmented once."""
        if len(self.cache) > most:
            self.cache.clear()
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif not self.spaces_first:
                split.append([(" " + t).replace(" ", SPACE)])
            elif "  " in t or t[0] == " " or t[-1] == " " or SPACE in t:
                split.append([w.replace(" ", SPACE) for w in SPACED.findall((" " + t).replace(SPACE, " "))])
            else:
                split.append((SPACE + t.replace(" ", " " + SPACE)).split(" "))
        self._learn(set().union(*split))
        return [b"".join(map(self.cache.__getitem__, words)) for words in split]

    def decode(self, ids: list[bytes]) -> list[str]:
        """Texts of ids: pieces laid end to end, bytes that aren't UTF-8 replaced, the first space dropped."""
        out = []
        for one in ids:
            i = np.frombuffer(one, "<u4").astype(np.int64)
            text = self.text[ranges(self.text_begin[i], self.text_size[i])].tobytes().decode("utf-8", "replace")
            out.append(text[1:] if text[:1] == " " else text)
        return out


@lru_cache(2)
def piece_model(path: str) -> PieceModel:
    """The model of a file, kept with its words from task to task of a worker."""
    return PieceModel(path)


def sentence_pieces(docs: DataFrame, model: str, batch_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of ints) and decoded (their text) of every whole text.

    ``model``: path of a SentencePiece file at the same place on every executor. Null or empty
    text: no ids. Null ids, repeated rows and ties: a row each. Other columns: ignored. No
    rows: no rows. A batch holds about ``batch_bytes`` or one longer text.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in sliced(batches, "text", batch_bytes):
            ids = pieces.encode(strings(batch, "text"))
            offsets = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield as_batch(schema, batch.column("doc_id"), lists, pieces.decode(ids))

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def sentence_piece_digests(docs: DataFrame, model: str, batch_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of unsigned little-endian 32-bit ids) and same_text (decoding gives the text again).

    Made next to the ids, which then needn't leave the task; see ``sentence_pieces``.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("same_text", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in sliced(batches, "text", batch_bytes):
            texts = strings(batch, "text")
            ids = pieces.encode(texts)
            yield as_batch(schema, batch.column("doc_id"), [len(i) // 4 for i in ids], [zlib.crc32(i) for i in ids], [a == b for a, b in zip(pieces.decode(ids), texts, strict=True)])

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, same_text boolean")
