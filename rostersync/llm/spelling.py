"""Spelling variants: words that differ by one edit, found by grams of variable length.

1. Words and their counts come from the texts by aggregation.
2. A word stands between two marks on either side. Grams of 2 and 3 letters are counted over the words;
   the frequent ones are the inner nodes of the gram dictionary: below an infrequent gram nothing longer is
   kept, so a word's gram at a place is the shortest that is infrequent, or ``LONGEST`` letters. The
   letters of the alphabet bound the counts (fewer than 100 cubed), so they are broadcast.
3. A word's grams are those that no earlier one covers. For each place the grams that one edit there can
   change are counted; the most for any place is the word's bound. Marks make a word at least twice as
   long as any gram, so an edit always leaves its first or its last gram alone, and the bound is smaller
   than the number of grams.
4. Two words one edit apart share all of a word's grams but ``bound``. Therefore they meet in a list of
   one of the ``bound + 1`` rarest grams of both. Lists are kept by gram, place and length: grams before the
   edit keep their distance from the front, grams after it that from the back.
5. A list longer than ``LIST`` is divided: what lies on the far side of a shared gram is shared as well, so
   words go on by gram and that side; if these are too many, by one half of what is left in between (the
   edit is in the other half), and so on. At the last, words agree in all but one letter.
6. Within a list two words are compared by a 64-bit sketch of their grams (at most ``bound`` of a word's may be
   missing in the other) and, that passed, by edit distance.

No list is cut: whatever a list holds is compared, after division.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostersync.llm.common import col
from rostersync.operators.staging import broadcast_if_small, materialise

#: A word: a run of letters; capitals A to Z are lower-cased.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARKS = 2  # marks on either side of a word
SHORTEST, LONGEST = 2, 4  # letters of a gram
LEAST_LETTERS = 2 * (LONGEST - MARKS)  # of a word, so that no edit reaches its first and its last gram
FREQUENT = 64  # a gram in more words than this goes on
LIST = 256  # words of a list that is not divided


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = 1) -> DataFrame:
    """``doc_id`` and ``word`` of every run of at least ``least_letters`` letters of every whole text."""
    runs = LETTERS.removesuffix("+") + "{%d,}" % least_letters
    lower = F.translate(col(text).cast("string"), UPPER, LOWER)
    return docs.select(col(doc_id).alias("doc_id"), F.explode(F.regexp_extract_all(lower, F.lit(runs), F.lit(0))).alias("word"))


def counts(words: DataFrame, least_letters: int, least: int) -> DataFrame:
    """``word`` and ``n`` of the words of at least ``least_letters`` letters that occur ``least`` times or more."""
    return words.filter(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _marked(word: str) -> str:
    return "\x01" * MARKS + word + "\x02" * MARKS


def _short_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams shorter than the longest and their places; a task holds no more than the alphabet allows."""
    held: Counter[str] = Counter()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            marked = _marked(word)
            for size in range(SHORTEST, LONGEST):
                held.update([marked[p : p + size] for p in range(len(marked) - size + 1)])
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["gram", "n"])


def frequent_grams(words: DataFrame, frequent: int) -> dict[str, int]:
    """Grams shorter than ``LONGEST`` in more than ``frequent`` places, with their numbers.

    At most one entry for each combination of ``LONGEST - 1`` letters of the alphabet.
    """
    grams = words.select("word").mapInArrow(_short_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = grams.filter(F.col("n") > frequent).toArrow()
    return dict(zip(found["gram"].to_pylist(), found["n"].to_pylist(), strict=True))


def decompose(marked: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """(start, end) of a word's grams, from left to right."""
    out, reached = [], 0
    for start in range(len(marked) - SHORTEST + 1):
        end = start + SHORTEST
        while end - start < LONGEST and end < len(marked) and marked[start:end] in frequent:
            end += 1
        if end > reached:
            out.append((start, end))
            reached = end
    return out


def affected(marked: str, grams: list[tuple[int, int]], frequent: dict[str, int]) -> int:
    """The most grams that one edit within the word can change or hide.

    An edit at place ``i`` replaces or removes the letter there, or puts one before it. It may change a
    gram that holds the place. It may lengthen one that ends before the place, if all letters from its
    start up to there are a frequent gram; what such a one newly covers is hidden. It may hide a gram
    after the place if a changed one can reach its end.
    """
    most, starts = 0, [start for start, _ in grams]
    for i in range(MARKS, len(marked) - MARKS + 1):
        # The first start from which a gram can reach the place.
        first = next((p for p in range(max(0, i - LONGEST + 1), i) if i - p < SHORTEST or marked[p:i] in frequent), i)
        replaced = inserted = 0
        for start, end in grams[bisect_left(starts, i - LONGEST) : bisect_left(starts, i + LONGEST)]:
            if start < i:
                hit = start >= first or end > i
                replaced += hit
                inserted += hit
            else:
                replaced += start == i or end - LONGEST <= i
                inserted += end - LONGEST < i
        most = max(most, inserted, replaced if i < len(marked) - MARKS else 0)
    return most


def _sketch(marked: str, grams: list[tuple[int, int]]) -> int:
    bits = 0
    for start, end in grams:
        bits |= 1 << (zlib.crc32(marked[start:end].encode()) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


POSTINGS = "word string, n long, length int, sketch long, bound int, starts array<int>, ends array<int>"


def _rarest(batches: Iterable[pa.RecordBatch], frequent: dict[str, int]) -> Iterator[pa.RecordBatch]:
    def weight(marked: str, gram: tuple[int, int]) -> tuple:
        # Rarest first; the number of a longest gram is at most that of its parts.
        text = marked[gram[0] : gram[1]]
        parts = (text[:-1], text[1:]) if len(text) == LONGEST else (text,)
        return min(frequent.get(p, 0) for p in parts), text, gram[0]

    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    for batch in batches:
        found = []
        for word in batch.column(0).to_pylist():
            marked = _marked(word)
            grams = decompose(marked, frequent)
            bound = affected(marked, grams, frequent)
            rarest = sorted(grams, key=lambda g: weight(marked, g))[: bound + 1]
            found.append((len(word), _sketch(marked, grams), bound, [a for a, _ in rarest], [b for _, b in rarest]))
        new = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=["word", "n", "length", "sketch", "bound", "starts", "ends"])


def postings(words: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """For each word and each list it is in: the list's ``key``, whether the word is a ``long`` one there, and what the gram leaves equal.

    Lists hold words of ``size`` letters (long) and of one less. ``front`` letters are equal in all words
    of the list that are one edit apart, if the edit lies after the gram; ``back`` letters, if before it.
    """
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast(frequent_grams(words, frequent))
    rarest = words.select("word", "n").mapInArrow(lambda batches: _rarest(batches, shared.value), POSTINGS)
    each = rarest.select("word", "n", "length", "sketch", "bound", F.inline(F.arrays_zip("starts", "ends")).alias("start", "end"))
    marked, total = _marked_column(), F.col("length") + 2 * MARKS
    gram = F.substring(marked, F.col("start") + 1, F.col("end") - F.col("start"))
    sides = F.filter(
        F.array(
            F.struct(F.lit(True).alias("after"), F.col("start").alias("at"), F.col("end").alias("front"), F.lit(0).alias("back")),
            F.struct(F.lit(False).alias("after"), (total - F.col("end")).alias("at"), F.lit(0).alias("front"), (total - F.col("start")).alias("back")),
        ),
        # No edit lies before the first letter or after the last.
        lambda side: (side["front"] < total) & (side["back"] < total),
    )
    each = each.select("word", "n", "length", "sketch", "bound", gram.alias("gram"), F.inline(sides))
    each = each.withColumn("long", F.explode(F.array(F.lit(True), F.lit(False))))
    size = F.col("length") + F.when(F.col("long"), 0).otherwise(1)
    key = F.xxhash64(size, "after", "at", "gram")
    return each.select("word", "n", "sketch", "bound", "long", size.alias("size"), "front", "back", key.alias("key"))


def _marked_column():
    return F.concat(F.lit("\x01" * MARKS), F.col("word"), F.lit("\x02" * MARKS))


#: Letters of a list's long words that its words need not share.
FREE = f"size + {2 * MARKS} - front - back"


def _divided(lists: DataFrame, halve: bool) -> DataFrame:
    """Postings of the same words in narrower lists, by their equal ends."""
    if halve:
        half = F.expr(f"int(floor(({FREE}) / 2))")
        ends = F.array(
            F.struct((F.col("front") + half).alias("front"), F.col("back").alias("back")),
            F.struct(F.col("front").alias("front"), (F.col("back") + F.expr(FREE) - half).alias("back")),
        )
        rest = [c for c in lists.columns if c not in ("front", "back", "key")]
        lists = lists.select(*rest, F.inline(ends))
    marked = _marked_column()
    key = F.xxhash64("size", "front", "back", F.left(marked, F.col("front")), F.right(marked, F.col("back")))
    return lists.filter(f"{FREE} > 0").withColumn("key", key)


def _pairs(lists: DataFrame) -> DataFrame:
    """Pairs one edit apart that meet in a list, with their counts."""
    a = lists.filter("long").select("key", *[F.col(c).alias(f"{c}_a") for c in ("word", "n", "sketch", "bound")])
    b = lists.select("key", *[F.col(c).alias(f"{c}_b") for c in ("word", "n", "sketch", "bound", "long")])
    once = ~F.col("long_b") | (F.col("word_a") < F.col("word_b"))
    lost = [F.bit_count(F.col(f"sketch_{x}").bitwiseAND(F.bitwise_not(f"sketch_{y}"))) <= F.col(f"bound_{x}") for x, y in ("ab", "ba")]
    near = F.levenshtein("word_a", "word_b", 1) == 1
    same = a["key"] == b["key"]
    return a.join(b, same & once & lost[0] & lost[1] & near).select("word_a", "n_a", "word_b", "n_b")


def near_words(words: DataFrame, frequent: int = FREQUENT, most: int = LIST) -> DataFrame:
    """``word_a``, ``n_a``, ``word_b``, ``n_b``: all pairs of distinct words one edit apart, each once.

    ``words`` has ``word`` (distinct, of at least ``LEAST_LETTERS`` letters) and ``n``.
    """
    lists, found, halve = materialise(postings(words, frequent), "lists"), [], False
    first = True
    while True:
        sizes = lists.groupBy("key").agg(F.count("*").alias("in_list"), F.max(F.expr(FREE)).alias("free"))
        long = sizes.filter((F.col("in_list") > most) & (F.lit(first) | (F.col("free") > 1))).select("key")
        long = broadcast_if_small(materialise(long, "long-lists"))
        if long.isEmpty():
            found.append(_pairs(lists))
            break
        found.append(_pairs(lists.join(long, "key", "left_anti")))
        lists = materialise(_divided(lists.join(long, "key", "left_semi"), halve), "lists")
        first, halve = False, True
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.distinct()


def variants(words: DataFrame, frequent: int = FREQUENT, most: int = LIST) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word of ``words`` (``word``, ``n``).

    Two words are near if one letter inserted, deleted or replaced makes one of the other. ``form`` is the
    near word of largest ``n`` (ties: the smallest in code-point order), if that is at least twice the
    word's; ``root`` follows forms to the last, the word itself without one. Words come once each, hold
    ``LEAST_LETTERS`` letters or more and neither of the two marks (code points 1 and 2). Rows with a null
    word or count are left out; an empty table gives no rows; other columns are not looked at. Letters may
    be any; the broadcast gram counts are bounded by the number of different letters cubed. ``frequent``
    and ``most`` change the work, not the result.
    """
    words = materialise(words.select(F.col("word"), F.col("n").cast("long").alias("n")).dropna(), "words")
    pairs = near_words(words, frequent, most)
    there = pairs.select(F.col("word_a").alias("w"), F.col("word_b").alias("other"), F.col("n_b").alias("other_n"))
    back = pairs.select(F.col("word_b").alias("w"), F.col("word_a").alias("other"), F.col("n_a").alias("other_n"))
    near = there.unionByName(back).groupBy("w").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    strong = -F.col("best.less") >= 2 * F.col("n")
    rows = words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
    )
    rows = materialise(rows, "forms")
    roots = rows.filter("form IS NOT NULL").select(F.col("word").alias("w"), F.col("form").alias("root"))
    # Counts at least double on the way, so there is no circle, and every round doubles the steps taken.
    while True:
        after = roots.select(F.col("w").alias("root"), F.col("root").alias("further"))
        step = materialise(roots.join(after, "root", "left").select("w", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = step.select("w", "root")
        if step.filter("moved").isEmpty():
            break
    return rows.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
