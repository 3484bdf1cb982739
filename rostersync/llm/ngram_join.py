"""Similarity join of word n-gram sets by vertical partitioning.

The n-grams have a global order (of their hashes), which is cut into fragments. Each fragment is worked
on by itself, what it finds is a partial count, and partial counts are summed: shared n-grams per text
first, overlaps per pair in the end.

1. Texts with equal sets are one node.
2. Two sets with a Jaccard similarity of t share their first k common n-grams within the first
   n - ceil(t n) + k of either. So a text with fewer shared n-grams there than k has no partner.
3. Of the texts left, all n-grams are counted among themselves; a text needs ceil(t n) that another one
   has, too.
4. Those that are left are grouped by the rarest n-grams they share (again a prefix, now by frequency).
   In each group all are compared with one of them; for what is then still apart within a group, pairs
   are made of n-grams that the one in the middle does not have, or of members whose sizes fit what they
   share. Groups of near copies thus cost a few comparisons per text, and no link between classes is lost.
5. Overlaps of pairs are counted by fragment: a row for each pair and fragment has the partial count, and
   the partial counts are summed per pair.

An n-gram that very many texts have is no hot group: in step 2 a task counts what its own texts share and
sends one row for such an n-gram; in step 3 counting combines in the tasks, and the join that gives the
counts back is one whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostersync.llm.common import col, packed, slices, words_as_ids
from rostersync.llm.components import components
from rostersync.operators.staging import broadcast_if_small, materialise

#: The prefix of step 2 is longer by a 10th of the set, and so many more n-grams must be shared.
MORE = 10
#: Documents whose n-grams make up a fragment, and the ranges of the global order that a fragment holds.
#: Prefixes lie in the lower part of the order, so that a fragment of one range could be full or empty.
FRAGMENT_DOCS, LEAST_FRAGMENTS, RANGES = 1024, 256, 32
#: Fragments in which overlaps of pairs are counted.
OVERLAP_FRAGMENTS = 4
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
#: Rows of the scan: an n-gram of a node, an n-gram known to be shared, a node with a count (as ``gram``); a document.
OWN, KNOWN, COUNTED, DOCUMENT = 0, 1, 2, 3
#: Sizes of sets are told apart by steps of this ratio when partners are looked for.
SIZE_STEP = 1.02


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of all texts, ascending in each; how many each has; a hash of each set.

    Words are runs without ASCII white space, A-Z in lower case; fewer words than ``size`` are one n-gram.
    """
    ids, counts, numbers = words_as_ids([t.lower() if t else t for t in texts])
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
    words = hashes[ids] if len(ids) else np.zeros(0, np.uint64)
    starts = np.cumsum(counts) - counts
    grams = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), grams)
    first = np.cumsum(grams) - grams
    begin = starts[owner] + np.arange(len(owner)) - first[owner]
    length = np.minimum(counts, size)[owner].astype(np.uint64)
    value = length.copy()
    for k in range(size):
        inside = np.flatnonzero(length > k)
        value[inside] = _mix(value[inside] * MULTIPLY + words[begin[inside] + k])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    n = np.bincount(owner, minlength=len(texts))
    sets = np.zeros(len(texts), np.uint64)
    if len(value):
        some = np.flatnonzero(n)
        sets[some] = np.add.reduceat(_mix(value), np.cumsum(n)[some] - n[some])
    return value, n, _mix(sets + n.astype(np.uint64) * MULTIPLY)


def _texts(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


def needed(n: np.ndarray, t: Fraction) -> np.ndarray:
    """Least overlap of a set of n with any set that is similar enough: ceil(t n)."""
    return -(-n * t.numerator // t.denominator)


def _distinct(gram: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (n-gram, node), and for each the number of nodes its n-gram has."""
    order = np.lexsort((node, gram))
    gram, node = gram[order], node[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])
    gram, node = gram[new], node[new]
    begin = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])[: len(gram)])
    nodes = np.diff(np.append(begin, len(gram)))
    return gram, node, np.repeat(nodes, nodes)


def _counted(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    node, n = np.unique(node, return_counts=True)
    return node, n.astype(np.int64)


def _scan(batches: Iterable[pa.RecordBatch], size: int, t: Fraction, fragments: int) -> Iterator[pa.RecordBatch]:
    """What a text's set is called, and the n-grams of its prefix: all that is read off the texts themselves.

    The n-grams go to their fragments (ranges of the global order, that of the hashes). What a slice of
    texts shares is counted here: the nodes get their counts, and one row tells the fragment that the
    n-gram is shared. Copies within a task are sent once. A node whose copies lie in several tasks may
    get too high a count, never one too low.
    """
    sent: set[int] = set()
    for batch in slices(batches, 1, 8 << 20):
        value, n, node = shingle_sets(_texts(batch.column(1)), size)
        length = np.minimum(n, n - needed(n, t) + 1 + n // MORE)
        for i, x in enumerate(node.tolist()):
            if x in sent:
                length[i] = 0
            sent.add(x)
        owner = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(value)) - np.repeat(np.cumsum(n) - n, n)
        taken = place < length[owner]
        gram, of, nodes = _distinct(value[taken], node[owner[taken]])
        known = np.unique(gram[nodes > 1])
        counted, counts = _counted(of[nodes > 1])
        gram, of = gram[nodes == 1], of[nodes == 1]
        value = np.concatenate([gram, known, counts.view(np.uint64)])
        kind = np.repeat(np.array([OWN, KNOWN, COUNTED], np.int8), [len(gram), len(known), len(counts)])
        place = np.concatenate([gram, known, counted])
        # Documents come first, each in the fragment of its set's name, with their keys in place of n-grams.
        docs, rest = len(n), len(kind)
        place = np.concatenate([node, place])
        fragment = (((place >> np.uint64(32)) * np.uint64(fragments * RANGES) >> np.uint64(32)) % np.uint64(fragments)).astype(np.int32)
        columns = [
            pa.array(fragment),
            pa.array(np.concatenate([np.full(docs, DOCUMENT, np.int8), kind])),
            pa.concat_arrays([batch.column(2), pa.array(value.view(np.int64))]),
            pa.array(np.concatenate([node, of, known, counted]).view(np.int64)),
            pa.concat_arrays([batch.column(0), pa.nulls(rest, pa.int64())]),
            pa.concat_arrays([pa.array(n, pa.int64()), pa.nulls(rest, pa.int64())]),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["fragment", "kind", "gram", "node", "doc_id", "n"])


def _count_shared(table: pa.Table) -> pa.Table:
    """A fragment's partial counts: per node its n-grams that another node has, too. Documents pass through."""
    documents = table.filter(pc.equal(table["kind"], DOCUMENT))
    table = table.filter(pc.less(table["kind"], DOCUMENT))
    gram, node, kind = table["gram"].to_numpy(), table["node"].to_numpy(), table["kind"].to_numpy()
    counted, counts, known = node[kind == COUNTED], gram[kind == COUNTED], np.unique(gram[kind == KNOWN])
    gram, node, nodes = _distinct(gram[kind == OWN], node[kind == OWN])
    node, n = _counted(node[(nodes > 1) | np.isin(gram, known)])
    node, n = pa.array(np.concatenate([node, counted])), pa.array(np.concatenate([n, counts]))
    none = pa.nulls(len(n), pa.int64())
    shared = pa.table({"doc_id": none, "text_key": none, "n": none, "node": node, "shared": n})
    named = documents.select(["doc_id", "gram", "n", "node"]).rename_columns(["doc_id", "text_key", "n", "node"])
    return pa.concat_tables([named.append_column("shared", pa.nulls(len(named), pa.int64())), shared])


def _whole(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 0, 4 << 20):
        value, n, node = shingle_sets(_texts(batch.column(0)), size)
        yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(np.repeat(node, n).view(np.int64))], names=["gram", "node"])


def _overlaps(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """(a, b) -> with ``common``, ``n_a`` and ``n_b``: a partial overlap for each pair and fragment, summed per pair.

    ``fragments`` has the n-grams of every node, a row for each fragment of the global order.
    """
    side = lambda name, grams: fragments.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), "fragment", F.col("grams").alias(grams))
    # Few pairs, as there mostly are, save moving all sets.
    few = broadcast_if_small(pairs.select("b").distinct())
    x, y = side("a", "x").join(broadcast_if_small(pairs), "a"), side("b", "y").join(few, "b", "left_semi")
    partial_ = F.size(F.array_intersect("x", "y")).cast("long").alias("partial")
    counted = x.join(y, ["b", "fragment"]).select("a", "b", "n_a", "n_b", partial_)
    return materialise(counted.groupBy("a", "b", "n_a", "n_b").agg(F.sum("partial").alias("common")), "ngram-overlaps")


def _similar(overlaps: DataFrame, t: Fraction) -> DataFrame:
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    return overlaps.filter(F.col("common") * t.denominator >= union * t.numerator).select("a", "b")


def _fragments(sets: DataFrame) -> DataFrame:
    """``node``, ``n`` and ``grams`` of every set, a row for each fragment, also for one without n-grams."""
    width = 64 - int(math.log2(OVERLAP_FRAGMENTS))
    ranges = range(-OVERLAP_FRAGMENTS // 2, OVERLAP_FRAGMENTS // 2)
    within = lambda f: F.filter("grams", lambda gram: F.shiftright(gram, width) == f)
    return sets.select("node", "n", F.posexplode(F.array(*[within(f) for f in ranges])).alias("fragment", "grams"))


def _step(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(SIZE_STEP)).cast("int")


def _each_once(pairs: DataFrame) -> DataFrame:
    """Pairs of members (x, y), the smaller node first."""
    x, y = F.col("x.node"), F.col("y.node")
    return pairs.filter(x != y).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _may_be_similar(t: Fraction) -> Column:
    """Do sizes allow members x and y to be similar, if they share an n-gram of their prefixes?

    The smaller set has a similar larger one only if that n-gram is among its first
    n - ceil(2 t / (1 + t) n) + 1, which ``early`` says. Neither may have too few n-grams that occur
    elsewhere.
    """
    x, y = F.col("x"), F.col("y")
    enough = F.least(x["shared"], y["shared"]) * (t.numerator + t.denominator) >= (x["n"] + y["n"]) * t.numerator
    x_first = (x["n"] < y["n"]) | ((x["n"] == y["n"]) & (x["node"] < y["node"]))
    return enough & F.when(x_first, x["early"] & (x["n"] * t.denominator >= y["n"] * t.numerator)).otherwise(
        y["early"] & (y["n"] * t.denominator >= x["n"] * t.numerator)
    )


def _classes(groups: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of groups with their classes so far, and the largest class of each group that has several."""
    placed = groups.join(components(links), "node", "left").select("gram", "node", "member", F.coalesce("root", "node").alias("root"))
    placed = materialise(placed, "ngram-placed")
    classes = placed.groupBy("gram", "root").agg(F.count("*").alias("members")).groupBy("gram")
    main = classes.agg(F.max_by("root", F.struct("members", "root")).alias("main"), F.count("*").alias("classes"))
    return placed, main.filter("classes > 1").select("gram", "main")


def similar_nodes(docs: DataFrame, scanned: DataFrame, text: str, doc_id: str, size: int, t: Fraction) -> DataFrame:
    """Links (a, b) between nodes that connect exactly what all links connect."""
    # Step 2.
    described, shared = _documents(scanned), scanned.filter("shared IS NOT NULL")
    shared = shared.groupBy("node").agg(F.sum("shared").alias("shared"))
    need = F.ceil(F.col("n") * t.numerator / t.denominator).cast("long")
    nodes = described.filter("n > 0").groupBy("node", "doc_id", "text_key").agg(F.first("n").alias("n"), F.count("*").alias("rows"))
    nodes = nodes.groupBy("node").agg(F.min(F.struct("doc_id", "text_key", "rows")).alias("rep"), F.first("n").alias("n"))
    left = materialise(
        nodes.join(shared, "node").filter(F.col("shared") >= 1 + F.floor(need / MORE)).select("node", "n", "rep.*"), "ngram-left"
    )
    # Step 3. One text per node.
    body = docs.select(col(doc_id).alias("id"), F.xxhash64(col(text)).alias("key"), col(text).cast("string").alias("text"))
    few = broadcast_if_small(left.select("doc_id", "text_key", "rows"))
    whole = body.join(few, body["id"].eqNullSafe(left["doc_id"]) & (body["key"] == left["text_key"]))
    once = whole.filter("rows = 1")
    if not left.filter("rows > 1").isEmpty():
        once = once.unionByName(whole.filter("rows > 1").dropDuplicates(["id", "key"]))
    grams = materialise(once.select("text").mapInArrow(partial(_whole, size=size), "gram long, node long"), "ngram-grams")
    often = grams.groupBy("gram").agg(F.count("*").alias("nodes")).filter("nodes > 1")
    grams = grams.join(often, "gram")
    # From here a row per text: its shared n-grams, the rarest first, and by ranges of the global order.
    sets = grams.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("nodes", "gram"))).alias("shared"), F.sum("nodes").alias("weight"))
    sets = sets.join(left.select("node", "n"), "node").filter(F.size("shared") >= need)
    # A text whose n-grams many others have is near to many.
    sets = sets.select("node", "n", (F.col("weight") / F.col("n")).alias("middle"), F.col("shared.gram").alias("grams"))
    sets = materialise(sets, "ngram-sets")
    fragments = materialise(_fragments(sets), "ngram-fragments")
    shared = F.size("grams").cast("long")
    # Step 4. The rarest n-grams a text shares; those that no other has come first and need no row.
    early = F.col("n") - F.ceil(F.col("n") * (2 * t.numerator) / (t.numerator + t.denominator)) + 1
    first = F.slice("grams", F.lit(1), (shared - need + 1).cast("int"))
    groups = sets.select("node", "n", "middle", shared.alias("shared"), F.posexplode(first).alias("at", "gram"))
    place = F.col("at") + 1 + F.col("n") - F.col("shared")
    member = F.struct("node", "n", "shared", (place <= early).alias("early")).alias("member")
    groups = materialise(groups.select("gram", "node", "middle", member), "ngram-groups")
    x = F.col("member").alias("x")
    # Each with the one in the middle of its group.
    centre = groups.groupBy("gram").agg(F.max_by("member", F.struct("middle", "node")).alias("y"))
    compared = materialise(_each_once(groups.join(centre, "gram").select(x, "y")), "ngram-pairs")
    overlaps = _overlaps(compared, fragments)
    links = _similar(overlaps, t)
    # Those outside their group's largest class with any one of it.
    placed, main = _classes(groups, links)
    outside = placed.join(main, "gram").filter("root <> main").select("gram", x)
    inside = placed.join(main, "gram").filter("root = main")
    any_ = inside.groupBy("gram").agg(F.min_by("member", F.xxhash64("gram", "node")).alias("y"))
    pairs = _each_once(outside.join(any_, "gram").filter(_may_be_similar(t)))
    pairs = materialise(pairs.join(compared, ["a", "b"], "left_anti"), "ngram-pairs")
    compared, links = compared.unionByName(pairs), links.unionByName(_similar(_overlaps(pairs, fragments), t))
    # Those still outside with members of other classes. What x shares with a middle c, |x & c|, may be
    # too little for a similar y, whose overlap with x must be t / (1 + t) (n_x + n_y). Then they share
    # enough of what x has and c has not, so y is looked for there; it is little, and rare.
    placed, main = _classes(groups, links)
    other_way = overlaps.select(F.col("b").alias("a"), F.col("a").alias("b"), "common")
    middle = overlaps.select("a", "b", "common").unionByName(other_way).groupBy(F.col("a").alias("of"))
    middle = middle.agg(F.max_by("b", F.struct("common", "b")).alias("c"), F.max("common").alias("with_c"))
    outside = placed.join(main, "gram").filter("root <> main")
    outside = outside.join(middle, outside["node"] == middle["of"], "left").select("gram", x, "root", "c", "with_c")
    outside = materialise(outside, "ngram-outside")
    enough = F.coalesce(F.col("with_c") * (t.numerator + t.denominator) >= (F.col("x.n") + F.col("y.n")) * t.numerator, F.lit(True))
    # Partners must be of a size that what x shares, with others and with c, allows.
    ratio = F.lit(t.numerator + t.denominator) / F.lit(t.numerator)
    shares = F.least(F.col("x.shared"), F.coalesce("with_c", "x.shared"))
    most = F.least(F.floor(F.col("x.n") * t.denominator / t.numerator), F.floor(shares * ratio + 1e-6) - F.col("x.n"))
    sized = outside.withColumns({"least": F.ceil(F.col("x.n") * t.numerator / t.denominator - 1e-6), "most": most}).filter("least <= most")
    sized = sized.withColumn("step", F.explode(F.sequence(_step(F.col("least")), _step(F.col("most"))))).drop("least", "most")
    other = placed.select("gram", F.col("member").alias("y"), F.col("root").alias("root_y"), _step(F.col("member.n")).alias("step"))
    pairs = _each_once(sized.join(other, ["gram", "step"]).filter((F.col("root") != F.col("root_y")) & enough & _may_be_similar(t)))
    alone = outside.filter("c IS NOT NULL").select("x.node", "root", "c", "with_c").distinct()
    of_c = sets.select(F.col("node").alias("c"), F.col("grams").alias("of_c"))
    besides = alone.join(sets.select("node", "n", "grams"), "node").join(of_c, "c")
    besides = besides.select("node", "n", "root", "with_c", shared.alias("shared"), F.posexplode(F.array_except("grams", "of_c")).alias("at", "gram"))
    before = F.col("at") + F.col("n") - F.col("shared")
    besides = besides.select("gram", F.struct("node", "n").alias("x"), "root", "with_c", before.alias("before"))
    besides = materialise(besides, "ngram-besides")
    other = sets.select(F.explode("grams").alias("gram"), F.struct("node", "n").alias("y"))
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    near = small * t.denominator >= large * t.numerator
    # Again the first n - (overlap) + 1 of them are enough.
    soon = (F.col("x.n") - F.col("before")) * (t.numerator + t.denominator) >= (F.col("x.n") + F.col("y.n")) * t.numerator
    found = broadcast_if_small(besides).join(other, "gram").filter((F.col("x.node") != F.col("y.node")) & ~enough & near & soon)
    roots = components(links).select(F.col("node").alias("of"), F.col("root").alias("root_y"))
    found = found.join(roots, F.col("y.node") == F.col("of"), "left").filter(F.col("root") != F.coalesce("root_y", "y.node"))
    pairs = pairs.unionByName(_each_once(found))
    pairs = materialise(pairs.distinct().join(compared, ["a", "b"], "left_anti"), "ngram-pairs")
    return links.unionByName(_similar(_overlaps(pairs, fragments), t))


def _scanned(docs: DataFrame, doc_id: str, text: str, size: int, t: Fraction) -> DataFrame:
    """Documents (``doc_id``, ``text_key``, ``n``, ``node``) and partial counts of nodes (``node``, ``shared``), written down.

    One pass over the texts gives both.
    """
    fragments = max(LEAST_FRAGMENTS, -(-docs.count() // FRAGMENT_DOCS))
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text"), F.xxhash64(col(text)).alias("text_key"))
    found = rows.mapInArrow(partial(_scan, size=size, t=t, fragments=fragments), "fragment int, kind byte, gram long, node long, doc_id long, n long")
    counted = found.groupBy("fragment").applyInArrow(_count_shared, "doc_id long, text_key long, n long, node long, shared long")
    return materialise(counted, "ngram-scan")


def _documents(scanned: DataFrame) -> DataFrame:
    return scanned.filter("shared IS NULL").drop("shared")


def _placed(described: DataFrame, links: DataFrame) -> DataFrame:
    """Every node with its first document and its component's first document (null ids last)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    nodes = described.filter("n > 0").groupBy("node").agg(first).join(components(links), "node", "left")
    nodes = materialise(nodes.select("node", "first", F.coalesce("root", "node").alias("root")), "ngram-classes")
    classes = nodes.groupBy("root").agg(F.min("first").alias("least"))
    return nodes.join(classes, "root").select("node", "least")


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, least: str | float = "0.8") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles`` and ``component_id``.

    Texts are linked when the Jaccard similarity of their sets of ``size``-word n-grams is at least
    ``least``; ``component_id`` is the smallest id reachable by links, null ids aside (null if there is
    no other). A null text or one without words has no n-grams and links with nothing: its component is
    its own id. Repeated rows and equal texts are linked with each other. An empty table gives no rows.
    Other columns are not looked at. N-grams and sets are compared by 64-bit hashes.
    """
    t = Fraction(str(least))
    scanned = _scanned(docs, doc_id, text, size, t)
    described = _documents(scanned)
    placed = _placed(described, similar_nodes(docs, scanned, text, doc_id, size, t))
    of = placed.select("node", F.col("least.doc_id").alias("component_id"))
    linked = described.filter("n > 0").join(of, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = described.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(empty)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, least: str | float = "0.8") -> DataFrame:
    """The input with one row of each component, that of the smallest id, and all rows without n-grams.

    Where equal rows share the smallest id, one of them stays. Null texts and texts without words stay; a
    null id is larger than any other. An empty table gives no rows. Other columns pass through, whatever
    their names.
    """
    t = Fraction(str(least))
    scanned = _scanned(docs, doc_id, text, size, t)
    described = _documents(scanned)
    placed = _placed(described, similar_nodes(docs, scanned, text, doc_id, size, t))
    best = placed.select("least.doc_id", "least.text_key").distinct()
    rows = described.filter("n > 0").groupBy("doc_id", "text_key").agg(F.count("*").alias("rows"))
    again = (rows["doc_id"].eqNullSafe(best["doc_id"])) & (rows["text_key"] == best["text_key"])
    rows = materialise(rows.join(best, again, "left_semi").unionByName(described.filter("n = 0").select("doc_id", "text_key", F.lit(0).cast("long").alias("rows")).distinct()), "ngram-kept")
    whole = packed(docs, id=col(doc_id).cast("long"), key=F.xxhash64(col(text)))
    on = lambda some: whole["id"].eqNullSafe(some["doc_id"]) & (whole["key"] == some["text_key"])
    once, more = rows.filter("rows < 2"), rows.filter("rows > 1")
    repeated = whole.join(more, on(more), "left_semi").groupBy("id", "key").agg(F.first("row").alias("row"))
    return whole.join(once, on(once), "left_semi").select("row.*").unionByName(repeated.select("row.*"))
