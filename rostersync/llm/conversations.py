"""Faults of conversations, and the cheapest edits that give them the shape system? (user assistant)+.

A conversation is a path through a graph whose nodes are (row, state): nothing yet, after the system
turn, after a user, after an assistant. An edge is what is done at one row: up to two turns inserted
before it, then the row kept, given another role, or deleted. Its weight is one integer. The high digits
are the cost; below them each row has a slot of three digits for the letters of its edits, padded with
zeros at the end, at a place given by the row's number. A slot's letters end with the only letter that
is no insertion, so no slot starts another one and comparing numbers compares audits. The smallest sum
of weights is then the cheapest path and, of the cheapest, the one whose audit comes first; integer
minima decide everything.

After ``BLOCK`` rows the digits so far are replaced by the rank of the state's path among the four paths,
which is all that later rows can need of them, so that the integers stay short. For the same reason a
conversation can be cut: a conversation of more than ``segment_rows`` rows is dealt out by ranges of its
order, each range is summed up by 16 costs and ranks (state before, state after), the sums are chained,
and each range is solved between the states that the chain gives it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rostersync.llm.common import col
from rostersync.operators.staging import broadcast_if_small, materialise

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, INSERT, DELETE = "KRID"
COST = {KEEP: 0, REROLE: 3, INSERT: 3, DELETE: 4}
TRUNCATED_COST = 3
DIGITS = {DELETE: 1, INSERT: 2, KEEP: 3, REROLE: 4}  # in ASCII order; 0 pads
DIGIT_BITS, SLOT_DIGITS = 3, 3
SLOT = DIGIT_BITS * SLOT_DIGITS
BLOCK = 32
SEGMENT_ROWS = 50_000

START, SYSTEM, USER, ASSISTANT = range(4)  # states; the last three are kinds of turns too
OTHER = 4  # a turn that fits nowhere
NEXT = {(START, SYSTEM): SYSTEM, (START, USER): USER, (SYSTEM, USER): USER, (USER, ASSISTANT): ASSISTANT, (ASSISTANT, USER): USER}
#: The turn that can be inserted in a state, and the one that a turn can be given there.
OWED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # turns to insert at the end
SOUND, TRUNCATED, DUPLICATE, BLANK = range(4)


class Edge(NamedTuple):
    before: int
    after: int
    cost: int
    digits: int
    letters: str


def _digits(letters: str) -> int:
    number = 0
    for letter in letters.ljust(SLOT_DIGITS, "\0"):
        number = number << DIGIT_BITS | DIGITS.get(letter, 0)
    return number


def _edges(kind: int, fault: int) -> list[Edge]:
    """For each two states the best edits at a row."""
    best: dict[tuple[int, int], Edge] = {}
    for before in range(4):
        state = before
        for inserted in range(SLOT_DIGITS):
            ways = [(DELETE, state)]
            if fault in (SOUND, TRUNCATED):
                ways += [(KEEP, NEXT[state, kind])] if (state, kind) in NEXT else []
                ways.append((REROLE, OWED[state]))
            for letter, after in ways:
                cost = inserted * COST[INSERT] + COST[letter] + TRUNCATED_COST * (fault == TRUNCATED and letter != DELETE)
                letters = INSERT * inserted + letter
                edge = Edge(before, after, cost, _digits(letters), letters)
                known = best.get((before, after))
                if known is None or edge[2:4] < known[2:4]:
                    best[before, after] = edge
            state = OWED[state]
    return list(best.values())


EDGES = {(kind, fault): _edges(kind, fault) for kind in range(1, 5) for fault in range(4)}


def paths(turns: list[tuple[int, int]], entry: int) -> tuple[list[int | None], list[int], list[list[Edge | None]]]:
    """Costs and ranks of the best paths from ``entry`` to each state, and the edge each state came by, row by row.

    ``turns`` holds (kind, fault). Ranks order the paths by their letters.
    """
    costs: list[int | None] = [None] * 4
    costs[entry] = 0
    ranks = [0] * 4
    came: list[list[Edge | None]] = []
    for start in range(0, len(turns), BLOCK):
        block = turns[start : start + BLOCK]
        low = SLOT * len(block)
        top = low + 2  # above the rank's two bits
        sums = [None if c is None else c << top | r << low for c, r in zip(costs, ranks, strict=True)]
        for j, turn in enumerate(block):
            place = low - SLOT * (j + 1)
            new: list[int | None] = [None] * 4
            by: list[Edge | None] = [None] * 4
            for edge in EDGES[turn]:
                so_far = sums[edge.before]
                if so_far is not None:
                    total = so_far + (edge.cost << top | edge.digits << place)
                    known = new[edge.after]
                    if known is None or total < known:
                        new[edge.after], by[edge.after] = total, edge
            sums = new
            came.append(by)
        costs = [None if s is None else s >> top for s in sums]
        order = sorted((s & (1 << top) - 1, q) for q, s in enumerate(sums) if s is not None)
        for rank, (_, q) in enumerate(order):
            ranks[q] = rank
    return costs, ranks, came


def best_end(costs: list[int | None], ranks: list[int]) -> int:
    """The state whose path, with the turns inserted at the end, is smallest."""
    return min((c + COST[INSERT] * CLOSING[q], ranks[q], q) for q, c in enumerate(costs) if c is not None)[2]


def solve(turns: list[tuple[int, int]], entry: int = START, leave: int | None = None) -> tuple[int, list[str]]:
    """Cost and letters row by row between two states; without ``leave`` to the end, whose insertions come as a last item."""
    costs, ranks, came = paths(turns, entry)
    state = best_end(costs, ranks) if leave is None else leave
    cost, letters = costs[state], []
    if leave is None:
        cost += COST[INSERT] * CLOSING[state]
        letters.append(INSERT * CLOSING[state])
    for by in reversed(came):
        letters.append(by[state].letters)
        state = by[state].before
    return cost, letters[::-1]


def _written(rows: list[dict], letters: list[str], state: int) -> list[dict]:
    """The turns that the edits leave."""
    out = []
    for row, slot in zip([*rows, None], [*letters, ""][: len(rows) + 1], strict=True):
        for letter in slot:
            if letter == INSERT:
                state = OWED[state]
                out.append({"role": NAMES[state], "text": ""})
            elif letter == REROLE:
                state = OWED[state]
                out.append({"role": NAMES[state], "text": row["text"]})
            elif letter == KEEP:
                state = NEXT[state, row["kind"]]
                out.append({"role": row["role"], "text": row["text"]})
    return out


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of a conversation's segment, which follow each other, with their faults complete."""
    rows: list[dict] = []
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            for row in batch.slice(start, 1024).to_pylist():
                if rows and (row["conv"], row["seg"]) != (rows[0]["conv"], rows[0]["seg"]):
                    yield rows
                    rows = []
                same = rows and all(row[c] == rows[-1][c] for c in ("turn", "role", "text"))
                if same and row["fault"] != BLANK:
                    row["fault"] = DUPLICATE
                rows.append(row)
    if rows:
        yield rows


def _in_batches(found: Iterable[dict], schema: pa.Schema, most: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for one in found:
        held.append(one)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _map(rows: DataFrame, one: Callable[[list[dict]], Iterable[dict]], conv: StructField, fields: str) -> DataFrame:
    """``one`` over the sorted rows of each (conv, seg); its rows start with conv and seg."""
    schema = StructType([conv, *StructType.fromDDL(fields).fields])
    arrow = _arrow(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches((x for group in _groups(batches) for x in one(group)), arrow)

    dealt = rows.repartition("conv", "seg").sortWithinPartitions("conv", "seg", "turn", "role", "text")
    return dealt.mapInArrow(run, schema)


def _summary(rows: list[dict]) -> Iterator[dict]:
    turns = [(r["kind"], r["fault"]) for r in rows]
    found = [paths(turns, entry)[:2] for entry in range(4)]
    yield {
        "conv": rows[0]["conv"], "seg": rows[0]["seg"],
        "costs": [-1 if c is None else c for costs, _ in found for c in costs], "ranks": [r for _, ranks in found for r in ranks],
    }


def chain(segments: list[dict]) -> list[tuple[int, int | None]]:
    """States before and after each segment of a conversation, from the segments' 16 costs and ranks; None after the last."""
    costs: list[int | None] = [0, None, None, None]
    ranks, came = [0] * 4, []
    for s in segments:
        ways = [
            ((costs[a] + s["costs"][4 * a + b], ranks[a], s["ranks"][4 * a + b]), a, b)
            for a in range(4) if costs[a] is not None for b in range(4) if s["costs"][4 * a + b] >= 0
        ]
        best = {b: min(w for w in ways if w[2] == b) for _, _, b in ways}
        came.append({b: w[1] for b, w in best.items()})
        costs = [best[b][0][0] if b in best else None for b in range(4)]
        for rank, (_, b) in enumerate(sorted((w[0][1:], b) for b, w in best.items())):
            ranks[b] = rank
    state, out = best_end(costs, ranks), []
    for i, by in reversed(list(enumerate(came))):
        out.append((by[state], state if i + 1 < len(segments) else None))
        state = by[state]
    return out[::-1]


SOLVED = (
    "seg int, blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long,"
    "first_kind int, last_kind int, part boolean, cost long, audit string, repaired array<struct<role: string, text: string>>"
)


def _solved(rows: list[dict]) -> Iterator[dict]:
    entry = rows[0]["entry"] or START
    cost, letters = solve([(r["kind"], r["fault"]) for r in rows], entry, rows[0]["leave"])
    faults, kinds = [r["fault"] for r in rows], [r["kind"] for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    yield {
        "conv": rows[0]["conv"], "seg": rows[0]["seg"],
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
        "illegal": sum(pair not in LEGAL for pair in zip(kinds, kinds[1:], strict=False)),
        "turns": len(set(turns)), "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
        "first_kind": kinds[0], "last_kind": kinds[-1],
        "part": rows[0]["entry"] is not None, "cost": cost, "audit": "".join(letters), "repaired": _written(rows, letters, entry),
    }


#: Neighbours that may follow each other in any conversation.
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def faulty(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, ``kind`` of the turn by its role's first character, and ``fault`` (each row's first).

    Copies within one turn are left to whoever reads them in order.
    """
    trimmed = F.rtrim(F.coalesce(F.col("text"), F.lit("")), F.lit(SPACE))
    first = F.substring("role", 1, 1)
    rows = conversations.select(
        col(conv_id).alias("conv"), col(turn).cast("long").alias("turn"),
        col(role).cast("string").alias("role"), col(text).cast("string").alias("text"),
    ).withColumns(
        {
            "kind": F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER),
            "fault": F.when(trimmed == "", BLANK).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND),
            "same": F.sha2(F.concat_ws("/", F.length("role").cast("string"), F.coalesce("role", F.lit("")), "text").cast("binary"), 256),
            "when": F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn")),
        }
    )
    # Rows said before: one row for each text said in two turns, or twice.
    again = rows.filter(F.col("fault") != BLANK).groupBy("conv", "same").agg(F.count("*").alias("n"), F.min("when").alias("first"))
    again = broadcast_if_small(materialise(again.filter("n > 1").drop("n"), "said-before"))
    again = again.select(F.col("conv").alias("c"), F.col("same").alias("s"), "first")
    marked = rows.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
    said = (F.col("fault") != BLANK) & (F.col("first") < F.col("when"))
    fault = F.when(F.coalesce(said, F.lit(False)), DUPLICATE).otherwise(F.col("fault"))
    return marked.select("conv", "turn", "role", "text", "kind", fault.cast("int").alias("fault"))


def _dealt(rows: DataFrame, segment_rows: int) -> tuple[DataFrame, bool]:
    """Rows with the segment they belong to and the states before and after it (null: a whole conversation), and whether any was cut."""
    whole = [F.lit(0).alias("seg"), F.lit(None).cast("int").alias("entry"), F.lit(None).cast("int").alias("leave")]
    long = materialise(rows.groupBy("conv").count().filter(F.col("count") > segment_rows).select(F.col("conv").alias("c")), "long")
    if long.isEmpty():
        return rows.select("*", *whole), False
    long = broadcast_if_small(long)
    is_long = F.col("conv").eqNullSafe(F.col("c"))
    split = rows.join(long, is_long, "left_semi").repartitionByRange("conv", "turn", "role", "text")
    # The bounds of the ranges are sampled, so they are written down.
    split = materialise(split.withColumn("seg", F.spark_partition_id()), "segments")
    conv = split.schema["conv"]
    sums = _map(split, _summary, conv, "seg int, costs array<long>, ranks array<int>")
    # A conversation has at most as many segments as there are partitions.
    parts = sums.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "costs", "ranks"))).alias("segments"))
    schema = StructType([conv, *StructType.fromDDL("seg int, entry int, leave int").fields])
    arrow = _arrow(schema)

    def chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            {"conv": r["conv"], "seg": s["seg"], "entry": a, "leave": b}
            for batch in batches for r in batch.to_pylist()
            for s, (a, b) in zip(r["segments"], chain(r["segments"]), strict=True)
        )
        yield from _in_batches(found, arrow)

    states = broadcast_if_small(materialise(parts.mapInArrow(chained, schema), "states"))
    states = states.select(F.col("conv").alias("c"), F.col("seg").alias("s"), "entry", "leave")
    split = split.join(states, is_long & (F.col("seg") == F.col("s"))).drop("c", "s")
    return rows.join(long, is_long, "left_anti").select("*", *whole).unionByName(split), True


def repair(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired``.

    Rows are taken by turn (nulls first), those of one turn by role and text (nulls first). A row's first
    fault counts: blank (nothing but white space, null included), duplicate (role and text seen earlier),
    truncated (the last character that is no white space is none of ``.!?``). ``gaps`` are turn numbers
    missing between the smallest and the largest; ``illegal`` counts neighbours whose roles' initials are
    not su, ua or au. ``audit`` has the letters of the cheapest edits in order, of the cheapest the first in
    ASCII: Keep 0, Rerole to user or assistant 3, Delete 4 (required for blank and duplicate rows), Insert an
    empty user or assistant turn 3; truncated rows that stay add 3. The turns left (``repaired``, an array
    of role and text) have the initials ``(s?(ua)+)?``. A null or empty role fits nowhere. A null
    ``conv_id`` is a conversation like others; repeated rows are duplicates; other columns are not looked
    at; an empty table gives no rows. ``segment_rows`` says above how many rows a conversation is cut.
    """
    rows, cut = _dealt(faulty(conversations, conv_id, turn, role, text), segment_rows)
    solved = _map(rows, _solved, rows.schema["conv"], SOLVED)
    if cut:
        solved = materialise(solved, "solved")
        solved = solved.filter("NOT part").unionByName(_together(solved.filter("part")))
    return solved.select(
        F.col("conv").alias(conv_id),
        F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired",
    )


def _together(parts: DataFrame) -> DataFrame:
    """One row per conversation from the rows of its segments."""
    before = Window.partitionBy("conv").orderBy("seg")
    legal = F.array(*[F.lit(10 * a + b) for a, b in sorted(LEGAL)])
    meets = F.lag("last_kind").over(before)
    parts = parts.withColumns(
        {
            "illegal": F.col("illegal") + F.when(meets.isNotNull() & ~F.array_contains(legal, 10 * meets + F.col("first_kind")), 1).otherwise(0),
            "turns": F.col("turns") - F.when(F.lag("last_turn").over(before) == F.col("first_turn"), 1).otherwise(0),
        }
    )
    in_order = F.sort_array(F.collect_list(F.struct("seg", "audit", "repaired")))
    return parts.groupBy("conv").agg(
        F.min("seg").alias("seg"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")],
        F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"),
        F.lit(0).alias("first_kind"), F.lit(0).alias("last_kind"), F.lit(True).alias("part"), F.sum("cost").alias("cost"),
        F.array_join(in_order["audit"], "").alias("audit"), F.flatten(in_order["repaired"]).alias("repaired"),
    )
