"""BPE encoding that reuses content-defined chunks across documents, and decoding.

Texts are cut where a rolling hash of the last 32 bytes says so, wherever that falls, also inside a word;
texts that share a passage therefore share its chunks, whatever precedes it. Three passes over the texts,
all of them map tasks:

1. Every text gives (chunk hash, bytes, text hash). Sums per chunk, combined in the tasks first, name
   the chunks that several documents share; the ``dictionary`` chunks that save most bytes are taken.
2. The text with the smallest hash of each such chunk hands the chunk out, and it is encoded, once. A
   chunk has at most ``MOST`` bytes, so the dictionary is broadcast with a size known beforehand.
3. Each text is cut again. Chunks of the dictionary come with their ids; the words of all others are
   encoded in place, each distinct one once for a slice of texts, where a worker's cache holds those met
   before. Then every join of two chunks is repaired: the library encodes a window of words on both sides
   of it, the first windows of a slice at once, and the window grows until its outer words come out with
   exactly the ids that the chunks have for them. What lies between replaces the ids at the join.

The dictionary decides how often a chunk is encoded, never an id: chunks are compared as bytes.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType
from tokenizers import Tokenizer

from rostersync.llm.common import col, slices
from rostersync.operators.staging import materialise

WINDOW = 32  # bytes that a cut depends on
LEAST, MOST = 192, 2048  # bytes of a chunk, but for the last of a text
BITS = 9  # one place in 2^BITS is a cut
DICTIONARY = 16_384  # chunks that are broadcast, each of at most MOST bytes and as many ids
CACHE, CHUNK_CACHE = 400_000, 4_096  # words and chunks that a worker remembers
END = (b".", b",", b"!", b"?", b";", b":")
#: Letters whose UTF-8 forms no normalizer named below changes but for their case: A to Z and U+00C0 to U+00FF without the two signs.
LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: Words of those letters, ASCII digits and signs but the apostrophe, and what a split as ``SPLIT`` makes of them.
PLAIN = re.compile(rb"(?:[!-&(-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
PIECES = re.compile(LATIN.pattern + rb"|[0-9]|[!-/:-@\[-`{-~]+")
SPLIT = ("[\\p{L}]+|", "[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
#: How byte-level models write bytes: those that print stand for themselves, the others follow from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_NAMES = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
BLOCK = 4 << 20  # bytes hashed at once

#: Parts of a tokenizer file for which encoding is the same on both sides of ASCII white space.
NORMALIZERS = {"NFC", "Lowercase", "Replace"}
SPACE_RUNS = "\\s+"


#: A random number for each byte value, the same everywhere.
GEAR = np.random.default_rng(20_240_229).integers(0, 1 << 32, 256, np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte the hash of the ``WINDOW`` bytes up to it: the sum of byte numbers shifted by their age."""
    h = GEAR[data]
    width = 1
    while width < WINDOW:
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    return h


def cuts(text: bytes) -> list[int]:
    """Ends of the chunks of a text; the last is its length. Cuts fall between characters."""
    data = np.frombuffer(text, np.uint8)
    found: list[int] = []
    for start in range(0, len(data), BLOCK):
        before = min(start, WINDOW - 1)
        h = rolling(data[start - before : start + BLOCK])[before:]
        # The high bits depend on all bytes of the window.
        found += (np.flatnonzero(h >> np.uint32(32 - BITS) == 0) + start + 1).tolist()
    ends, last, i = [], 0, 0
    while len(text) - last > LEAST:
        while i < len(found) and found[i] < last + LEAST:
            i += 1
        end = min(found[i] if i < len(found) else len(text), last + MOST, len(text))
        # Back to the start of a character: at most three bytes.
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        ends.append(end)
        last = end
    if last < len(text) or not ends:
        ends.append(len(text))
    return ends


def chunks(text: bytes) -> list[bytes]:
    start, out = 0, []
    for end in cuts(text):
        out.append(text[start:end])
        start = end
    return out


def check_model(model: str) -> None:
    """Refuse a tokenizer whose ids may depend on what lies beyond white space.

    Composing characters, lower-casing them one by one and merging white space don't reach across ASCII
    white space, a split that drops white space doesn't either, and added tokens hold none.
    """
    spec = json.loads(model)
    norm = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    for part in norm.get("normalizers", [norm]):
        replaces = part["type"] == "Replace" and (part["pattern"].get("Regex") != SPACE_RUNS or part["content"] != " ")
        if part["type"] not in NORMALIZERS or replaces:
            raise ValueError(f"normalizer {part['type']} may act across white space")
    pre = spec.get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers", [pre])
    first = parts[0] if parts else {}
    splits = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    # Of the pattern, only negated classes that name \s, letters and digits may match: none holds white space.
    pattern = first.get("pattern", {}).get("Regex", "") if splits else ""
    if not splits or "[^" in pattern.replace("[^\\s", "") or "." in pattern or "\\s" in pattern.replace("[^\\s", ""):
        raise ValueError("the first step of the pre-tokenizer must drop white space")
    if any(p.get("type") != "ByteLevel" or p.get("add_prefix_space") or p.get("use_regex") for p in parts[1:]):
        raise ValueError("only a byte-level step may follow the split")
    if spec["model"].get("type") != "BPE" or spec["model"].get("dropout") or spec["model"].get("unk_token"):
        raise ValueError("only BPE models without dropout and unknown token")
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"].split()) != 1 for t in spec["added_tokens"]):
        raise ValueError("an added token depends on what surrounds it")


class Words(dict):
    """Word (bytes without ASCII white space) -> its ids as bytes of int32.

    When full, the words become the older half, from which those met again come back. A run of Latin
    letters, a digit and a run of signs are one pre-token each, which the model takes without the steps
    before it, letters in lower case once for all their spellings where the tokenizer lowers them; a word
    of several is put together from their ids. All other words go through the library whole.
    """

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.older = tokenizer, tokenizer.model, {}
        spec = json.loads(tokenizer.to_str())
        self.lowers = '"Lowercase"' in json.dumps(spec.get("normalizer"))
        pre = spec.get("pre_tokenizer") or {}
        pattern = pre.get("pretokenizers", [pre])[0].get("pattern", {}).get("Regex", "")
        # What stands before the run of letters begins with an apostrophe, and no added token is of letters.
        before, letters, after = pattern.partition(SPLIT[0])
        apart = all(x.startswith("'") for x in before.split("|") if x)
        added = [t["content"].encode() for t in spec["added_tokens"]]
        self.direct = bool(letters) and apart and not any(map(LATIN.fullmatch, added))
        # Beyond letters and one sign, the split must be known to its end, and no added token lie in the word.
        self.splits = self.direct and after == SPLIT[1]
        self.added = re.compile(b"|".join(map(re.escape, added)) or b"(?!)")

    def piece(self, word: bytes) -> bytes:
        """Ids of one pre-token, of which the normalizer changes nothing more."""
        name = word.decode() if word.isascii() else word.decode("latin-1").translate(BYTE_NAMES)
        return array("i", [t.id for t in self.model.tokenize(name)]).tobytes()

    def letters(self, word: bytes) -> bytes:
        if self.lowers:
            lower = word.lower() if word.isascii() else word.decode().lower().encode()
            if lower != word:
                return self[lower]
        return self.piece(word)

    def fresh(self, word: bytes) -> bytes:
        """Ids of a word not met before."""
        if self.direct:
            if word.isalpha() or LATIN.fullmatch(word):
                return self.letters(word)
            if word[-1:] in END and LATIN.fullmatch(word, 0, len(word) - 1):
                return self[word[:-1]] + self[word[-1:]]
            if self.splits and PLAIN.fullmatch(word) and not self.added.search(word):
                parts = PIECES.findall(word)
                return b"".join(map(self.__getitem__, parts)) if len(parts) > 1 else self.piece(word)
        return array("i", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.fresh(word)
        if len(self) >= CACHE // 2:
            self.older = dict(self)
            self.clear()
        if len(word) <= 256:
            self[word] = ids
        return ids


class Reuse:
    """Encodes texts in tasks; pickles as the tokenizer's file and the dictionary.

    The dictionary has for each chunk the ids of its words, and how many bytes of them belong to each.
    """

    def __init__(self, model: str, known: dict[bytes, tuple[bytes, list[int]]]):
        self.model, self.known = model, known

    def __getstate__(self) -> tuple:
        return self.model, self.known

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def open(self) -> Reuse:
        if not hasattr(self, "tokenizer"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.tokenizer = Tokenizer.from_str(self.model)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self.words = Words(self.tokenizer)
            self.met: dict[bytes, list[bytes | None]] = {}
        return self

    def chunk(self, chunk: bytes, words: list[bytes] | None = None) -> list[bytes | None]:
        """The ids of each of its words, split beforehand or here; None for a first or last one that may go on beyond its ends."""
        found = self.met.get(chunk)
        if found is not None:
            return found
        words = chunk.split() if words is None else words
        if (held := self.known.get(chunk)) is not None:
            ends = np.cumsum([0, *held[1]]).tolist()
            found = [held[0][a:b] for a, b in zip(ends, ends[1:], strict=False)]
        else:
            found = [*map(self.words.__getitem__, words[1:-1])]
            found = [self.words[words[0]] if words and chunk[:1].isspace() else b"", *found, b""][: len(words)]
            if len(words) > 1 and chunk[-1:].isspace():
                found[-1] = self.words[words[-1]]
        if words and not chunk[:1].isspace():
            found[0] = None
        if words and not chunk[-1:].isspace():
            found[-1] = None
        if len(self.met) >= CHUNK_CACHE:
            self.met.clear()
        self.met[chunk] = found
        return found

    def lay(self, text: bytes, words: list[bytes], given: dict[int, bytes], joined: list[int]) -> None:
        """Put the words of a text to ``words``, the ids its known chunks have for them to ``given``.

        ``joined`` takes the numbers of words that lie in two chunks or more.
        """
        open_word = False
        for chunk in chunks(text):
            new = chunk.split()
            if not new:
                open_word = False
                continue
            at = len(words)
            if open_word and not chunk[:1].isspace():
                at -= 1
                if not joined or joined[-1] != at:
                    joined.append(at)
                words[at] += new[0]
                words += new[1:]
            else:
                words += new
            if chunk in self.known:
                given.update((i, x) for i, x in enumerate(self.chunk(chunk, new), at) if x is not None)
            open_word = not chunk[-1:].isspace()

    def encode(self, texts: list[bytes]) -> pa.ListArray:
        """Ids of texts: those of their chunks, repaired where two meet. Each other word is looked up once."""
        words: list[bytes] = []
        given: dict[int, bytes] = {}
        joined: list[int] = []
        starts = [0]
        for text in texts:
            here: list[bytes] = []
            near: dict[int, bytes] = {}
            cut: list[int] = []
            self.lay(text, here, near, cut)
            given.update((starts[-1] + i, x) for i, x in near.items())
            joined += [starts[-1] + i for i in cut]
            words += here
            starts.append(len(words))
        for i in joined:
            given.pop(i, None)
        keys: list[bytes | None] = [*words]
        for i in (*given, *joined):
            keys[i] = None
        found = pa.array(keys, pa.binary()).dictionary_encode()
        del keys
        table = [*map(self.words.__getitem__, found.dictionary.to_pylist())]
        # Of each word the number of its ids in the table; -1 while it has none.
        at = found.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if given:
            at[[*given]] = np.arange(len(table), len(table) + len(given))
            table += given.values()
        self.join(words, starts, joined, at, table)
        sizes = np.array([*map(len, table)], np.int64) // 4
        lists = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *sizes]).astype(np.int32)), pa.array(np.frombuffer(b"".join(table), "<i4"), pa.int32())
        )
        ends = np.concatenate([[0], np.cumsum(sizes[at])])[starts]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), lists.take(pa.array(at)).flatten())

    def join(self, words: list[bytes], starts: list[int], joined: list[int], at: np.ndarray, table: list[bytes]) -> None:
        """Repair all joined words. The library gets their first windows at once; those that disagree grow one by one."""

        def ids(i: int) -> bytes | None:
            return table[at[i]] if at[i] >= 0 else None

        def put(i: int, new: bytes) -> None:
            at[i] = len(table)
            table.append(new)

        ends = [(starts[t - 1], starts[t]) for t in np.searchsorted(starts, joined, "right").tolist()]
        windows = [self.window(i, 1, *between, ids) for i, between in zip(joined, ends, strict=True)]
        spans = [b" ".join(words[low : high + 1]).decode() for low, high in windows]
        got = [np.array(e.ids, "<i4").tobytes() for e in self.tokenizer.encode_batch_fast(spans, add_special_tokens=False)]
        for i, (start, end), (low, high), inside in zip(joined, ends, windows, got, strict=True):
            if at[i] >= 0:
                continue
            outer = self.outer(i, low, high, ids)
            # A window planned before others were repaired holds if it would be the same now.
            if (low, high) == self.window(i, 1, start, end, ids) and self.agrees(inside, *outer):
                for j in range(low, high + 1):
                    if at[j] < 0:
                        put(j, b"")
                put(i, inside[len(outer[0]) : len(inside) - len(outer[1])])
                continue
            near = [ids(j) for j in range(start, end)]
            before = [*near]
            self.repair(words[start:end], near, i - start)
            for j, (old, new) in enumerate(zip(before, near, strict=True), start):
                if old is not new:
                    put(j, new)

    @staticmethod
    def window(i: int, k: int, start: int, end: int, ids: Callable[[int], bytes | None]) -> tuple[int, int]:
        """First and last word of the window of ``k`` words around ``i``, moved out to words with ids."""
        low, high = max(start, i - k), min(end - 1, i + k)
        while low > start and not ids(low):
            low -= 1
        while high < end - 1 and not ids(high):
            high += 1
        return low, high

    @staticmethod
    def outer(i: int, low: int, high: int, ids: Callable[[int], bytes | None]) -> tuple[bytes, bytes]:
        return (ids(low) or b"" if low < i else b""), (ids(high) or b"" if high > i else b"")

    @staticmethod
    def agrees(got: bytes, first: bytes, last: bytes) -> bool:
        return got.startswith(first) and got.endswith(last) and len(got) >= len(first) + len(last)

    def repair(self, words: list[bytes], ids: list[bytes | None], i: int) -> None:
        """Give the joined word ``i`` its ids by encoding it between words whose ids are known.

        The window holds ``k`` words on either side; its outer words must come out with the ids that their
        chunks have for them, else ``k`` is doubled, up to the whole text, where nothing is left to agree.
        """
        k = 1
        while True:
            low, high = self.window(i, k, 0, len(words), ids.__getitem__)
            window = b" ".join(words[low : high + 1]).decode()
            got = np.array(self.tokenizer.encode(window, add_special_tokens=False).ids, "<i4").tobytes()
            first, last = self.outer(i, low, high, ids.__getitem__)
            agree = self.agrees(got, first, last)
            whole = low == 0 and high == len(words) - 1
            if agree or whole:
                break
            k *= 2
        if not agree:
            first = last = b""
        inner = [b""] * (high + 1 - low)
        inner[0], inner[-1] = first, last
        inner[i - low] = got[len(first) : len(got) - len(last)]
        ids[low : high + 1] = inner


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def _hash(text: bytes) -> int:
    """A 64-bit hash as a signed number."""
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 0):
        n: defaultdict[int, int] = defaultdict(int)
        size: dict[int, int] = {}
        owner: dict[int, int] = {}
        for text in _texts(batch, 0):
            whole = _hash(text)
            for chunk in set(chunks(text)) if text else ():
                key = _hash(chunk)
                n[key] += 1
                size[key] = len(chunk)
                owner[key] = min(owner.get(key, whole), whole)
        columns = [pa.array(x, pa.int64()) for x in (list(n), list(n.values()), [size[k] for k in n], [owner[k] for k in n])]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "size", "owner"])


def shared_chunks(texts: DataFrame, most: int = DICTIONARY) -> DataFrame:
    """(key, n, size, owner) of at most ``most`` chunks with the largest repeated bytes, of those in two documents or more.

    ``texts`` has one column of text. ``n`` counts documents, ``owner`` is the smallest hash of a text that
    holds the chunk. The least that counts is read off a histogram of repeated bytes; of its last step as
    large a part is taken as there is room for, by the chunks' hashes.
    """
    found = texts.mapInArrow(_occurrences, "key long, n long, size long, owner long")
    sums = found.groupBy("key").agg(F.sum("n").alias("n"), F.max("size").alias("size"), F.min("owner").alias("owner"))
    step = F.floor(8 * F.log2((F.col("n") - 1) * F.col("size"))).cast("int")
    sums = materialise(sums.filter("n > 1").withColumn("step", step), "shared-chunks")
    # A few hundred steps, whatever the input.
    steps = sorted(((r["step"], r["count"]) for r in sums.groupBy("step").count().collect()), reverse=True)
    taken, last, part = 0, None, 0.0
    for last, held in steps:
        part = min(1.0, (most - taken) / held)
        taken += held
        if taken >= most:
            break
    if last is None:
        return sums.drop("step")
    near = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(part * (1 << 20))
    chosen = sums.filter((F.col("step") > last) | (F.col("step") == last) & near)
    return chosen.drop("step").limit(most)


def dictionary(texts: DataFrame, model: str, most: int = DICTIONARY) -> dict[bytes, tuple[bytes, list[int]]]:
    """Chunk -> ids of its words, for the chunks of ``shared_chunks``; each is encoded once, by a task."""
    spark = texts.sparkSession
    wanted: defaultdict[int, set[int]] = defaultdict(set)
    for row in shared_chunks(texts, most).collect():  # at most `most` rows of numbers
        wanted[row["owner"]].add(row["key"])
    if not wanted:
        return {}
    shared = spark.sparkContext.broadcast((dict(wanted), Reuse(model, {})))

    def hand_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners = shared.value[0]
        for batch in slices(batches, 0):
            found = {c for t in set(_texts(batch, 0)) if (keys := owners.get(_hash(t))) for c in chunks(t) if _hash(c) in keys}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], names=["chunk"])

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reuse = shared.value[1].open()
        for batch in batches:
            all_ids, lengths = [], []
            for chunk in batch.column(0).to_pylist():
                ids = [x or b"" for x in reuse.chunk(chunk)]
                all_ids.append(b"".join(ids))
                lengths.append([*map(len, ids)])
            columns = [batch.column(0), pa.array(all_ids, pa.binary()), pa.array(lengths, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "lengths"])

    once = texts.mapInArrow(hand_out, "chunk binary").distinct()
    rows = once.mapInArrow(encoded, "chunk binary, ids binary, lengths array<int>").collect()
    return {bytes(r["chunk"]): (bytes(r["ids"]), r["lengths"]) for r in rows}


def _added(kept: StructType, name: str, kind) -> StructType:
    if name in kept.names:
        raise ValueError(f"a kept column is called {name} like a result")
    return StructType([*kept.fields]).add(name, kind)


class Names:
    """Token names by id, and the library's decoding of a list of ids."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.own = tokenizer, json.loads(tokenizer.to_str()).get("decoder") is not None
        self.names = {} if self.own else {i: t for t, i in tokenizer.get_vocab().items()}

    def column(self, lists: pa.ListArray) -> pa.Array:
        """The same for a column of lists of ids as ``encode`` gives them, all of them the tokenizer's."""
        if self.own:
            return pa.array([*map(self.decode, lists.to_pylist())], pa.string())
        if not hasattr(self, "by_id"):
            self.by_id = pa.array([self.names.get(i) for i in range(max(self.names) + 1)], pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, self.by_id.take(lists.values)), " ")

    def decode(self, ids: list[int | None]) -> str:
        if self.own:
            return self.tokenizer.decode([i for i in ids if i is not None and i >= 0], skip_special_tokens=False)
        try:
            return " ".join(map(self.names.__getitem__, ids))
        except KeyError:
            return " ".join(self.names[i] for i in ids if i in self.names)


def encode(
    docs: DataFrame, tokenizer_file: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), most: int = DICTIONARY, decoded: bool = False
) -> DataFrame:
    """``keep`` and ``token_ids`` (array of int) of every whole text, as the library gives them.

    No special tokens are added; their strings inside a text become their ids, as the library does by
    default; there is no truncation or padding. Null and empty texts have no ids: an empty array. One row
    per input row, repeated or not; an empty table gives none. Nulls in kept columns stay, all other
    columns are not looked at, and a kept column called like a result is refused. ``most`` chunks of at
    most ``MOST`` bytes are broadcast with their ids; any other shared chunk is encoded where it is met.
    Tokenizer files whose ids might depend on what lies beyond white space are refused (``check_model``).
    ``decoded`` adds what ``decode`` gives for the ids, without handing them to another worker.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        model = file.read()
    check_model(model)
    texts = docs.select(col(text).cast("string").alias("text"))
    reuse = docs.sparkSession.sparkContext.broadcast(Reuse(model, dictionary(texts, model, most)))
    rows = docs.select(*map(col, keep), col(text).cast("string").alias("__text"))
    schema = _added(StructType(rows.schema.fields[:-1]), "token_ids", ArrayType(IntegerType()))
    if decoded:
        schema = _added(schema, "decoded", StringType())
    at = len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = reuse.value.open()
        names = Names(opened.tokenizer) if decoded else None
        for batch in slices(batches, at, 2 << 20):
            columns = [*batch.columns[:at], opened.encode(_texts(batch, at))]
            if names:
                columns.append(names.column(columns[-1]))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, tokenizer_file: str, token_ids: str = "token_ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``token_ids`` and ``decoded``: the text the library gives for the ids, special tokens included.

    A null list decodes to null, an empty one to an empty text. Nulls within a list and ids that the
    tokenizer does not have are passed over, as the library passes over the latter. Kept columns may not
    be called like the two results.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        model = file.read()
    shared = tokens.sparkSession.sparkContext.broadcast(Reuse(model, {}))
    rows = tokens.select(*map(col, keep), col(token_ids).cast("array<int>").alias("__ids"))
    schema = _added(_added(StructType(rows.schema.fields[:-1]), "token_ids", ArrayType(IntegerType())), "decoded", StringType())
    at = len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(shared.value.open().tokenizer)
        for batch in batches:
            texts: list[str | None] = []
            for start in range(0, batch.num_rows, 256):
                texts += [None if ids is None else names.decode(ids) for ids in batch.column(at).slice(start, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: at + 1], pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
