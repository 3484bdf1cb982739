"""SentencePiece encoding and decoding by a batched Viterbi search in numpy, inside map tasks.

Words of equal length advance together, one character a step. Hashes of all substrings that end there
probe the sorted piece keys; each word keeps the best (score, last piece) for every position, chosen by
a maximum over the candidate lengths, and is read back along the stored pieces.

For a unigram model the score of a path is the sum of its pieces' scores. For a merge (BPE) model the
highest sum is not what the model means: there a path is admissible if every two neighbours are what
merging their joined text gives, and exactly one path of a word is. The same search then runs with
inadmissible steps masked out, and gives the library's ids.

A word that has no or few others of its length, such as a text without spaces, goes alone: all its places
are probed together, one length of substring after the other, neighbours are judged in blocks, and only
the choice of the best step goes from place to place.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from rostersync.llm.common import col, refuse_names, slices

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, BYTE = 1, 2, 6
BASE = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN_PENALTY = np.float32(10.0)
SLOTS = 1 << 18
WORDS_AT_ONCE = 1 << 18
LONG_WORD, PLACES_AT_ONCE = 32, 8192
CACHE = 400_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}[tag & 7] if tag & 7 != 2 else varint()
            yield tag >> 3, data[at : at + size]
            at += size


def _prefix_hashes(chars: np.ndarray) -> np.ndarray:
    """(n, L) code points -> (n, L + 1) hashes of the prefixes."""
    out = np.zeros((chars.shape[0], chars.shape[1] + 1), np.uint64)
    for j in range(chars.shape[1]):
        out[:, j + 1] = out[:, j] * BASE + chars[:, j] + np.uint64(1)
    return out


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices starts[i], starts[i] + 1, ... (sizes[i] of them), for all i in a row."""
    ends = np.cumsum(sizes)
    out = np.repeat(starts - (ends - sizes), sizes)
    return out + np.arange(len(out))


class PieceModel:
    """Pieces of a model file, ready for searching. ``kind`` UNIGRAM or BPE; by default the file's own."""

    def __init__(self, data: bytes, kind: int | None = None):
        pieces, own, dummy, squeeze, escape, charsmap = [], UNIGRAM, 1, 1, 1, b""
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif number == 2:
                own = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                rules = dict(_fields(value))
                charsmap, dummy, squeeze, escape = rules.get(2, b""), rules.get(3, 1), rules.get(4, 1), rules.get(5, 1)
        self.kind = own if kind is None else kind
        if self.kind not in (UNIGRAM, BPE) or charsmap or squeeze or not escape:
            raise ValueError("only unigram and BPE models that leave the text as it is are read")
        self.dummy = bool(dummy)
        n = len(pieces)
        self.unknown = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
        self.byte_ids = np.full(256, self.unknown, np.int32)
        for i, (text, _, kind_) in enumerate(pieces):
            if kind_ == BYTE:
                self.byte_ids[int(text[3:-1], 16)] = i
        normal = [i for i, p in enumerate(pieces) if p[2] == NORMAL and p[0]]
        texts = [pieces[i][0] for i in normal]
        self.longest = max(map(len, texts))
        inner = {c for t in texts if len(t) > 1 for c in t}
        if any(SPACE in t.lstrip(SPACE) for t in texts):
            raise ValueError("a piece that runs on over a space is not supported")
        #: No piece joins a line break with anything, so words may end there.
        self.words = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+" if "\n" not in inner else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.scores = np.full(n + 1, -np.inf, np.float32)
        self.scores[normal] = [pieces[i][1] for i in normal]
        self.unknown_score = self.scores[normal].min() - UNKNOWN_PENALTY
        # Sorted piece keys, and a filter of their leading bits that most substrings fail.
        keys = np.array([self._key(t) for t in texts], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(normal, np.int32)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have the same key")
        self.powers = np.array([pow(int(BASE), k, 2**64) for k in range(self.longest + 1)], np.uint64)
        self.filter = np.zeros(1 << 22, bool)
        self.filter[self.keys >> np.uint64(42)] = True
        self.lengths = np.zeros(n + 1, np.int32)
        self.lengths[normal] = [len(t) for t in texts]
        # What an id decodes to.
        plain = [p[0].replace(SPACE, " ").encode() if p[2] == NORMAL else bytes([int(p[0][3:-1], 16)]) if p[2] == BYTE else " ⁇ ".encode() if p[2] == UNKNOWN else b"" for p in pieces]
        self.byte_sizes = np.array([len(b) for b in plain], np.int64)
        self.byte_starts = np.cumsum(self.byte_sizes) - self.byte_sizes
        self.bytes = np.frombuffer(b"".join(plain), np.uint8)
        if self.kind == BPE:
            self._merges({pieces[i][0]: i for i in normal}, pieces)
            self.seen = np.full(SLOTS, -1, np.int64)
            self.answer = np.zeros(SLOTS, bool)

    @staticmethod
    def _key(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(BASE) + ord(c) + 1) & (2**64 - 1)
        return h

    # ---- merge models

    def _merges(self, ids: dict[str, int], pieces: list) -> None:
        """Ranks of pieces, which two make which, and how each piece is itself made."""
        n = len(pieces)
        by_score = sorted(ids.values(), key=lambda i: -pieces[i][1])
        self.rank = np.full(n + 1, -1, np.int64)  # single characters and unknown ones: made by no merge
        last = None
        for place, i in enumerate(by_score):
            if len(pieces[i][0]) > 1:
                self.rank[i] = self.rank[last] if last is not None and pieces[last][1] == pieces[i][1] else place
                last = i
        pairs: dict[tuple[int, int], int] = {}
        for text, i in ids.items():
            for k in range(1, len(text)):
                a, b = ids.get(text[:k]), ids.get(text[k:])
                if a is not None and b is not None:
                    pairs[a, b] = i
        self.left, self.right = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
        self.reachable = np.zeros(n + 1, bool)
        self.reachable[n] = True
        for text, i in ids.items():
            if len(text) == 1:
                self.reachable[i] = True
                continue
            parts = [ids.get(c, n) for c in text]
            while len(parts) > 1:
                best = min(((self.rank[pairs[p]], k) for k, p in enumerate(zip(parts, parts[1:])) if p in pairs), default=None)
                if best is None:
                    break
                k = best[1]
                made = pairs[parts[k], parts[k + 1]]
                if len(parts) == 2 and made == i:
                    self.left[i], self.right[i], self.reachable[i] = parts[0], parts[1], True
                parts[k : k + 2] = [made]
        codes = np.array([a * (n + 1) + b for a, b in pairs], np.int64)
        made = np.array([self.rank[i] for i in pairs.values()], np.int64)
        order = np.argsort(codes)
        self.pair_codes, self.pair_ranks, self.size = codes[order], made[order], n + 1

    def _walk(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Does merging the joined text of a and b give just a, b? Undoes their merges, latest first.

        While a piece stands at the border, a merge over the border of a lower rank than the merge that
        takes it away would have come first. Of two equal ranks the one further left comes first.
        """
        valid = np.ones(len(a), bool)
        x, y = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        live = np.arange(len(a))
        while len(live):
            code = x[live] * self.size + y[live]
            at = np.minimum(np.searchsorted(self.pair_codes, code), len(self.pair_codes) - 1)
            across = (self.pair_codes[at] == code) & (self.pair_ranks[at] < limit[live])
            valid[live[across]] = False
            rx, ry = self.rank[x[live]], self.rank[y[live]]
            go = ~across & ((rx >= 0) | (ry >= 0))
            # A merge inside b lies to the right of the border, one inside a to its left.
            take_x = go & (rx > ry)
            take_y = go & ~take_x
            i, j = live[take_x], live[take_y]
            limit[i], x[i] = rx[take_x], self.right[x[i]]
            limit[j], y[j] = ry[take_y] + 1, self.left[y[j]]
            live = live[go]
        return valid

    def _fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a * self.size + b
        slot = (code * 0x9E3779B1 >> 7) & (SLOTS - 1)
        new = np.flatnonzero(self.seen[slot] != code)
        out = self.answer[slot]
        if len(new):
            codes, back = np.unique(code[new], return_inverse=True)
            found = self._walk(codes // self.size, codes % self.size)
            out[new] = found[back]
            put = (codes * 0x9E3779B1 >> 7) & (SLOTS - 1)
            self.seen[put], self.answer[put] = codes, found
            # Two codes on one slot: keep the pair of arrays consistent.
            self.answer[put] = np.where(self.seen[put] == codes, found, self.answer[put])
            lost = self.seen[put] != codes
            if lost.any():
                self.seen[put[lost]] = -1
        return out

    # ---- the search

    def _best(self, chars: np.ndarray) -> np.ndarray:
        """(n, L) code points -> (n, L + 1) last piece of the best path to each position."""
        n, size = chars.shape
        unknown = len(self.scores) - 1
        hashes = _prefix_hashes(chars)
        score = np.full((n, size + 1), -np.inf, np.float32)
        score[:, 0] = 0
        last = np.full((n, size + 1), -1, np.int64)
        for j in range(1, size + 1):
            for k in range(min(self.longest, j), 0, -1):
                h = hashes[:, j] - hashes[:, j - k] * self.powers[k]
                rows = np.flatnonzero(self.filter[h >> np.uint64(42)])
                at = np.minimum(np.searchsorted(self.keys, h[rows]), len(self.keys) - 1)
                hit = self.keys[at] == h[rows]
                rows, piece = rows[hit], self.ids[at[hit]].astype(np.int64)
                if self.kind == BPE:
                    before = last[rows, j - k]
                    fits = self.reachable[piece]
                    inner = np.flatnonzero(fits & (before >= 0))
                    fits[inner] = self._fits(before[inner], piece[inner])
                    rows, piece = rows[fits], piece[fits]
                    gain = np.zeros(len(rows), np.float32)
                else:
                    gain = self.scores[piece]
                reached = score[rows, j - k] + gain
                better = reached > score[rows, j]
                rows = rows[better]
                score[rows, j], last[rows, j] = reached[better], piece[better]
                if k == 1:
                    # A character without a piece.
                    single = np.zeros(n, bool)
                    single[np.flatnonzero(self.filter[h >> np.uint64(42)])[hit]] = True
                    rows = np.flatnonzero(~single)
                    reached = score[rows, j - 1] + (0 if self.kind == BPE else self.unknown_score)
                    better = reached > score[rows, j]
                    rows = rows[better]
                    score[rows, j], last[rows, j] = reached[better], unknown
        return last

    def _encode_equal(self, words: list[str]) -> list[bytes]:
        """Ids (32 bits each) of words of one length."""
        size = len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, size)
        last = self._best(chars.astype(np.uint64))
        unknown = len(self.scores) - 1
        n = len(words)
        pieces = np.full((n, size), -1, np.int64)  # written from the right
        at, place, rows = np.full(n, size), np.full(n, size), np.arange(n)
        while len(rows):
            p = last[rows, at[rows]]
            place[rows] -= 1
            pieces[rows, place[rows]] = p
            at[rows] -= np.where(p == unknown, 1, self.lengths[p])
            rows = rows[at[rows] > 0]
        raw = pieces[pieces >= 0].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(size - place)).tolist()
        out = [raw[a:b] for a, b in zip([0, *ends], ends)]
        for i in np.flatnonzero((pieces == unknown).any(axis=1)):
            out[i] = self._with_bytes(words[i], np.frombuffer(out[i], np.int32))
        return out

    def _with_bytes(self, word: str, ids: np.ndarray) -> bytes:
        """Unknown characters as their bytes' pieces; without byte pieces a run of them is one unknown."""
        made: list[int] = []
        at = 0
        for p in ids.tolist():
            if p == len(self.scores) - 1:
                raw = word[at].encode("utf-8", "surrogatepass")
                ids_ = self.byte_ids[np.frombuffer(raw, np.uint8)].tolist()
                if ids_[0] != self.unknown:
                    made += ids_
                elif not made or made[-1] != self.unknown:
                    made.append(self.unknown)
                at += 1
            else:
                made.append(p)
                at += self.lengths[p]
        return np.array(made, np.int32).tobytes()

    def _found(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every piece at every place of one long word: starts, pieces, and which characters are pieces.

        All places are probed at once, one length after the other.
        """
        h = np.zeros(len(chars), np.uint64)
        single = np.zeros(len(chars), bool)
        starts, pieces = [], []
        for k in range(1, min(self.longest, len(chars)) + 1):
            h = h[: len(chars) - k + 1] * BASE + chars[k - 1 :] + np.uint64(1)
            rows = np.flatnonzero(self.filter[h >> np.uint64(42)])
            at = np.minimum(np.searchsorted(self.keys, h[rows]), len(self.keys) - 1)
            hit = self.keys[at] == h[rows]
            rows, piece = rows[hit], self.ids[at[hit]].astype(np.int64)
            if k == 1:
                single[rows] = True
            if self.kind == BPE:
                rows, piece = rows[self.reachable[piece]], piece[self.reachable[piece]]
            starts.append(rows)
            pieces.append(piece)
        starts_, pieces_ = np.concatenate(starts), np.concatenate(pieces)
        order = np.argsort(starts_, kind="stable")
        return starts_[order], pieces_[order], single

    def _neighbours(self, starts: np.ndarray, pieces: np.ndarray, low: int, high: int) -> set[int]:
        """Pairs of pieces that meet at a place from ``low`` to ``high`` and that merging would leave side by side."""
        ends = starts + self.lengths[pieces]
        meet = np.flatnonzero((ends >= low) & (ends < high))
        first = np.searchsorted(starts, ends[meet])
        sizes = np.searchsorted(starts, ends[meet], side="right") - first
        codes = np.unique(np.repeat(pieces[meet], sizes) * self.size + pieces[_ragged(first, sizes)])
        return set(codes[self._fits(codes // self.size, codes % self.size)].tolist()) if len(codes) else set()

    def _encode_long(self, word: str) -> bytes:
        """Ids of one long word: the same search, from place to place, over what was found beforehand."""
        chars = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        size, unknown = len(chars), len(self.scores) - 1
        starts, pieces, single = self._found(chars)
        first = np.searchsorted(starts, np.arange(size + 1)).tolist()
        names, lengths, known = pieces.tolist(), self.lengths[pieces].tolist(), single.tolist()
        last = [-1] * (size + 1)
        score = [np.float32(-np.inf)] * (size + 1)
        score[0] = np.float32(0)
        gains = self.scores[pieces]
        good: set[int] = set()
        for i in range(size):
            if self.kind == BPE:
                if i % PLACES_AT_ONCE == 0:
                    near = slice(first[max(0, i - self.longest)], first[min(size, i + PLACES_AT_ONCE)])
                    good = self._neighbours(starts[near], pieces[near], i, i + PLACES_AT_ONCE)
                before = last[i]
                # The first to reach a place is the longest piece that may end there.
                for at in range(first[i], first[i + 1]):
                    end = i + lengths[at]
                    if last[end] < 0 and (i == 0 or before == unknown or before * self.size + names[at] in good):
                        last[end] = names[at]
                if not known[i] and last[i + 1] < 0:
                    last[i + 1] = unknown
                continue
            for at in range(first[i], first[i + 1]):
                end, reached = i + lengths[at], score[i] + gains[at]
                if reached > score[end]:
                    score[end], last[end] = reached, names[at]
            if not known[i] and (reached := score[i] + self.unknown_score) > score[i + 1]:
                score[i + 1], last[i + 1] = reached, unknown
        ids, at = [], size
        while at:
            ids.append(last[at])
            at -= 1 if last[at] == unknown else int(self.lengths[last[at]])
        made = np.array(ids[::-1], np.int32)
        return self._with_bytes(word, made) if (made == unknown).any() else made.tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, 32 bits each. Words of one length are searched together, long ones alone."""
        out = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, rows in by_length.items():
            if length > LONG_WORD and 4 * len(rows) <= length:
                # Steps of a long word would each move few rows.
                for i in rows:
                    out[i] = self._encode_long(words[i])
                continue
            step = max(1, WORDS_AT_ONCE // length)
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                for i, ids in zip(part, self._encode_equal([words[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def encode(self, texts: list[str], cache: dict[str, bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        numbers: defaultdict[str, int] = defaultdict(count().__next__)
        flat: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                marked = (SPACE if self.dummy else "") + text.replace(" ", SPACE)
                words = self.words.findall(marked)
                counts[i] = len(words)
                flat.extend(map(numbers.__getitem__, words))
        cache = {} if cache is None else cache
        if len(cache) > CACHE:
            cache.clear()
        new = [w for w in numbers if w not in cache]
        own = dict(zip(new, self.encode_words(new), strict=True))
        cache.update((w, x) for w, x in own.items() if len(w) <= 64)
        known = [own[w] if w in own else cache[w] for w in numbers]
        sizes = np.array([len(x) // 4 for x in known], np.int64)
        table = np.frombuffer(b"".join(known), np.int32)
        order = np.array(flat, np.int64)
        ids = table[_ragged((np.cumsum(sizes) - sizes)[order], sizes[order])]
        upto = np.concatenate([[0], np.cumsum(sizes[order])])
        ends = np.cumsum(counts)
        return ids, upto[ends] - upto[ends - counts]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The text of each run of ids, as bytes."""
        sizes = self.byte_sizes[ids]
        raw = self.bytes[_ragged(self.byte_starts[ids], sizes)].tobytes()
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(counts)
        cut = 1 if self.dummy else 0
        out = []
        for a, b in zip(upto[ends - counts].tolist(), upto[ends].tolist(), strict=True):
            out.append(raw[a + cut : b] if raw[a : a + 1] == b" " else raw[a:b])
        return out


def encode(docs: DataFrame, model_file: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), kind: int | None = None) -> DataFrame:
    """Columns ``keep`` of every row, with ``piece_ids``, ``n_pieces`` and ``round_trip`` of its whole text.

    ``round_trip`` says whether decoding gives the text back byte by byte. It does unless the text holds
    U+2581, which the format itself uses for a space. A null text gives null ids, 0 pieces and a null
    ``round_trip``; an empty one an empty list. A kept column may not be called like a result. No begin, end or other special pieces are added. Rows
    alike get the same answer; an empty table gives no rows. The driver reads the model file (its size
    does not depend on the data) and sends it to the tasks.
    """
    with open(model_file, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    refuse_names(keep, ("piece_ids", "n_pieces", "round_trip"))
    rows = docs.select(F.struct(*[col(c) for c in keep]).alias("row"), col(text).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = PieceModel(shared.value, kind), {}
        for batch in slices(batches, 1, 4 << 20):
            texts = batch.column(1)
            null = pc.is_null(texts).to_numpy(zero_copy_only=False)
            plain = pc.fill_null(texts, "")
            ids, counts = model.encode(plain.to_pylist(), cache)
            back = model.decode(ids, counts)
            same = [a == b for a, b in zip(back, plain.cast(pa.binary()).to_pylist(), strict=True)]
            starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array(null))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(counts, pa.int64()), pa.array(same, pa.bool_(), mask=null)],
                names=["row", "piece_ids", "n_pieces", "round_trip"],
            )

    schema = rows.select("row").schema.add("piece_ids", ArrayType(IntegerType())).add("n_pieces", "long").add("round_trip", "boolean")
    return rows.mapInArrow(run, schema).select("row.*", "piece_ids", "n_pieces", "round_trip")


def decode(encoded: DataFrame, model_file: str, ids: str = "piece_ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and the ``text`` of each row's ids.

    A null list gives a null text, an empty one an empty text. Nulls within a list and ids that the model
    does not have, negative ones among them, are passed over. Repeated rows get the same answer; an empty
    table gives no rows. A kept column may not be called ``text``.
    """
    refuse_names(keep, ("text",))
    with open(model_file, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())
    rows = encoded.select(F.struct(*[col(c) for c in keep]).alias("row"), col(ids).cast("array<int>").alias("ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(shared.value)
        for batch in batches:
            lists = batch.column(1)
            null = pc.is_null(lists).to_numpy(zero_copy_only=False)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids_ = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
            there = (ids_ >= 0) & (ids_ < len(model.byte_sizes))
            if not there.all():
                counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[there], minlength=len(counts))
            texts = model.decode(ids_[there], counts)
            made = pa.array([None if n else t.decode("utf-8", "replace") for n, t in zip(null, texts, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=["row", "text"])

    return rows.mapInArrow(run, rows.select("row").schema.add("text", "string")).select("row.*", "text")
