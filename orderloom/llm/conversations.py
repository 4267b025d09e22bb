"""Conversation structure repair: cheapest edits that make the roles alternate, by Hirschberg's method.

A conversation is right if the initials of its roles read `(s?(ua)+)?`. Rows may be kept, given the
other role, deleted, and empty rows inserted, at the costs below. What the repaired rows end with
is one of four states. Costs run forward from the first row and backward from the last, as vectors
over these states; they meet in the middle, the cheapest crossing there is chosen, and both halves
are solved in the same way. Of equally cheap edits those whose initials come first in ASCII order
are taken: the forward vector also ranks, by state, the best edits that lead there. Two of these
are never the beginning of one another, as each ends in a row's own edit, so ranks decide.

Rows are spread by ranges of conversation and turn. A conversation that is cut by a range border
(two a range at most) is solved in segments: each segment gives its costs from state to state, the
states at the borders follow from these few tables, and the segments are then solved on their own.
So no task holds more than a range, however long a conversation is.

Defined cases: nulls in any column but the turn are one space, as a null turn is where it is part of
a checksum; rows without a turn come first; rows with the same turn are ordered by role, then by the digest
of role and text; a null conv_id is a conversation of its own; an empty role can't be kept; further
columns are ignored; an empty table gives no rows. Repeated rows are duplicates like any others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import slices
from orderloom.sources.shared import shared_folder

# States: nothing yet, and after a system, user and assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# The role a new or changed row must have in each state, and the state it leads to.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NEVER = 1 << 60

SPACE = " \t\n\x0b\f\r"
LEGAL = {"su", "ua", "au"}
FAULTS = ("blank", "duplicate", "truncated")

# Costs from state to state, and the place of the edits among those from the same state.
Table = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]


def kept_state(state: int, initial: int | None) -> int | None:
    """The state after a row with this role, None if it can't stand there."""
    if initial == SYSTEM:
        return SYSTEM if state == START else None
    return initial if initial is not None and NEXT[state] == initial else None


def row_edits(kind: int) -> list[list[tuple[int, str]]]:
    """Cheapest edits (cost, initials) of a row of this kind from state to state, inserts before it.

    Kinds: 8 must be deleted; else twice the role (0: none that is known) plus 1 if it is truncated.
    """
    extra = TRUNCATED * (kind & 1)
    found = [[(NEVER, "")] * 4 for _ in STATES]
    for before in STATES:
        state = before
        for inserted in range(4):
            ways = [(DELETE, "D", state)]
            if kind != 8:
                ways.append((REROLE + extra, "R", NEXT[state]))
                kept = kept_state(state, (kind >> 1) or None)
                if kept is not None:
                    ways.append((extra, "K", kept))
            for cost, letter, after in ways:
                way = (cost + INSERT * inserted, "I" * inserted + letter)
                found[before][after] = min(found[before][after], way)
            state = NEXT[state]
    return found


def table_of(edits: list[list[tuple[int, str]]]) -> Table:
    places = []
    for ways in edits:
        order = sorted(STATES, key=lambda t: ways[t][1])
        places.append(tuple(order.index(t) for t in STATES))
    return tuple(tuple(cost for cost, _ in ways) for ways in edits), tuple(places)


EDITS = [row_edits(kind) for kind in range(9)]
TABLES = [table_of(edits) for edits in EDITS]
# What follows the last row: rows inserted until the conversation may end.
TAILS = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]

Front = tuple[list[int], list[int]]


def front_at(state: int) -> Front:
    return [0 if s == state else NEVER for s in STATES], [0 if s == state else 1 for s in STATES]


def advance(front: Front, table: Table) -> Front:
    """Cost and rank of the best edits up to each state, one row or segment later."""
    costs, ranks = front
    best = []
    for after in STATES:
        best.append(
            min((costs[b] + table[0][b][after], ranks[b], table[1][b][after]) for b in STATES)
        )
    order = sorted(STATES, key=lambda s: (best[s][0] >= NEVER, best[s][1:]))
    return [min(cost, NEVER) for cost, _, _ in best], [order.index(s) for s in STATES]


def forward(kinds: bytes, start: int) -> Front:
    front = front_at(start)
    for kind in kinds:
        front = advance(front, TABLES[kind])
    return front


def backward(kinds: bytes, costs: list[int]) -> list[int]:
    """Cost from each state before the rows, given the costs after them."""
    for kind in reversed(kinds):
        table = TABLES[kind][0]
        costs = [min(NEVER, *[table[b][a] + costs[a] for a in STATES]) for b in STATES]
    return costs


def crossing(front: Front, costs: list[int]) -> int:
    """The state in which the two vectors meet: cheapest, then with the least edits before it."""
    return min(STATES, key=lambda s: (min(NEVER, front[0][s] + costs[s]), front[1][s]))


def solve(kinds: bytes, start: int, end: int) -> str:
    """The least of the cheapest edits of these rows, from state to state."""
    if not kinds:
        return ""
    if len(kinds) == 1:
        return EDITS[kinds[0]][start][end][1]
    left, right = kinds[: len(kinds) // 2], kinds[len(kinds) // 2 :]
    goal = [0 if s == end else NEVER for s in STATES]
    middle = crossing(forward(left, start), backward(right, goal))
    return solve(left, start, middle) + solve(right, middle, end)


# Short conversations share few patterns of kinds, so these are remembered.
solve_short = lru_cache(maxsize=1 << 14)(solve)


def last_state(front: Front) -> int:
    return crossing(front, [cost for cost, _ in TAILS])


def audit_of(kinds: bytes, start: int, end: int | None) -> str:
    """Edits of the rows up to state `end`; None: up to the best end, with what is inserted there."""
    tail = ""
    if end is None:
        end = last_state(forward(kinds, start))
        tail = TAILS[end][1]
    return (solve_short if len(kinds) <= 32 else solve)(kinds, start, end) + tail


def segment_table(kinds: bytes) -> Table:
    """What a whole segment costs from state to state."""
    fronts = [forward(kinds, start) for start in STATES]
    return tuple(tuple(f[0]) for f in fronts), tuple(tuple(f[1]) for f in fronts)


def border_states(tables: list[Table]) -> list[int]:
    """The state before each segment of a conversation and after the last."""
    fronts = [front_at(START)]
    for table in tables:
        fronts.append(advance(fronts[-1], table))
    states = [last_state(fronts[-1])]
    for front, table in zip(fronts[-2::-1], reversed(tables)):
        states.append(crossing(front, [table[0][s][states[-1]] for s in STATES]))
    return states[::-1]


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of conversation rows, spoilt by the checksum of `conv_id:turn`.

    By its remainder mod 20: 0 the row goes, 1 its text is emptied, 2 loses its `.!?`, 3 the row
    stands twice, 4 the role becomes user.
    """

    def text_of(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    key = F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))
    kind = F.crc32(key) % 20
    spoilt = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(text_of("role")).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate(text_of("text"), ".!?", ""))
        .otherwise(text_of("text"))
        .alias("text"),
        kind.alias("kind"),
    )
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        spoilt.filter("kind <> 0")
        .withColumn("nth", F.explode(times))
        .select("conv_id", "turn", "role", "text")
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest, place, and each row's first fault (null: none)."""

    def filled(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" ")).alias(column)

    rows = rows.select("conv_id", "turn", filled("role"), filled("text"))
    # Tells equal rows apart; they can stand for each other, so nothing depends on its value.
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(whole, 256)))
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"), F.col("place"))
    repeated = (
        rows.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("what"))
        .agg(F.min(at).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("what"))
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = (
        F.when(body == "", F.lit("blank"))
        .when(F.col("first.place") != F.col("place"), F.lit("duplicate"))
        .when(~F.substring(body, -1, 1).isin(".", "!", "?"), F.lit("truncated"))
    )
    return rows.join(repeated, same, "left").select(
        "conv_id", "turn", "role", "text", "digest", "place", fault.alias("fault")
    )


def ordered(rows: DataFrame) -> DataFrame:
    """The rows with their faults, sorted by conversation and turn over all partitions.

    A checkpoint, as the borders between partitions must stay where they are.
    """
    context = rows.sparkSession.sparkContext
    folder = shared_folder(rows.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "digest", "place"]
    sort = with_faults(rows).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return sort.drop("digest", "place").checkpoint().withColumn("part", F.spark_partition_id())


def kind_of(role: str, fault: str | None) -> int:
    if fault in ("blank", "duplicate"):
        return 8
    return 2 * INITIALS.get(role[:1], 0) + (fault == "truncated")


_NO = object()


def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each conversation in a sorted partition."""
    rows: list[dict] = []
    current = _NO
    for batch in batches:
        for part in slices(batch):
            for row in part.to_pylist():
                if row["conv_id"] != current:
                    if rows:
                        yield rows
                    rows, current = [], row["conv_id"]
                rows.append(row)
    if rows:
        yield rows


def kinds_of(rows: list[dict]) -> bytes:
    return bytes(kind_of(row["role"], row["fault"]) for row in rows)


def cut_conversations(rows: DataFrame) -> list:
    """Conversations that stand in several partitions; one or two a partition at most."""
    edge = F.struct("conv_id")
    found = rows.groupBy("part").agg(F.min(edge).alias("low"), F.max(edge).alias("high")).collect()
    found.sort(key=lambda r: r["part"])
    cut = [b["low"][0] for a, b in zip(found, found[1:]) if a["high"][0] == b["low"][0]]
    return list(dict.fromkeys(cut))


def edit_rows(rows: list[dict], start: int, end: int | None) -> Iterator[dict]:
    """The rows with their edits, inserted ones included."""
    state, left = start, iter(rows)
    for nth, edit in enumerate(audit_of(kinds_of(rows), start, end)):
        row = {"conv_id": rows[0]["conv_id"], "part": rows[0]["part"], "nth": nth, "edit": edit}
        if edit != "I":
            was = next(left)
            row |= {"turn": was["turn"], "was": was["role"], "fault": was["fault"]}
        if edit in "RI":
            state = NEXT[state]
            row["role"] = NAMES[state]
        elif edit == "K":
            state = INITIALS[was["role"][0]]
            row["role"] = was["role"]
        if edit != "D":
            row["text"] = "" if edit == "I" else was["text"]
        yield row


def batches_of(rows: Iterable[dict], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row.get("text") or row.get("audit") or "")
        if len(held) == most or size > 4_000_000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema)


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits of the rows (conv_id, turn, role, text), in two frames.

    The first has the conversations that stand in one partition, whole and in order; the second
    those that are cut. One row per edit: conv_id, part, nth (order), edit (K, R, D, I), turn, was
    (the role before), fault, role and text (after it; null if deleted).
    """
    spark = rows.sparkSession
    rows = ordered(rows)
    conv = rows.schema["conv_id"]
    cut = cut_conversations(rows)
    # One row per partition at most.
    names = spark.createDataFrame([(c,) for c in cut], T.StructType([T.StructField("cut", conv.dataType)]))
    is_cut = F.col("conv_id").eqNullSafe(F.col("cut"))
    names = F.broadcast(names)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in segments(batches):
            costs, places = segment_table(kinds_of(segment))
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": segment[0]["conv_id"], "part": segment[0]["part"],
                  "costs": sum(map(list, costs), []), "places": sum(map(list, places), [])}],
                table_schema,
            )

    some = rows.limit(0).toArrow().schema
    table_schema = pa.schema(
        [some.field("conv_id"), some.field("part"), ("costs", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))]
    )
    states: dict[tuple, tuple[int, int | None]] = {}
    cut_rows = rows.join(names, is_cut, "left_semi")
    if cut:
        kind = T.StructType(
            [conv, T.StructField("part", T.IntegerType())]
            + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("costs", "places")]
        )
        found: dict[object, list] = {}
        # One row per cut conversation and partition: two rows a partition at most.
        for row in sorted(cut_rows.mapInArrow(tables, kind).collect(), key=lambda r: r["part"]):
            found.setdefault(row["conv_id"], []).append(row)
        four = lambda x: tuple(tuple(x[k : k + 4]) for k in range(0, 16, 4))
        for name, parts in found.items():
            borders = border_states([(four(p["costs"]), four(p["places"])) for p in parts])
            for p, start, end in zip(parts, borders, borders[1:]):
                states[name, p["part"]] = (start, None if p is parts[-1] else end)

    schema = T.StructType(
        [conv]
        + [T.StructField(*f) for f in (("part", T.IntegerType()), ("nth", T.LongType()), ("edit", T.StringType()))]
        + [rows.schema["turn"]]
        + [T.StructField(c, T.StringType()) for c in ("was", "fault", "role", "text")]
    )
    arrow = pa.schema(
        [some.field("conv_id"), ("part", pa.int32()), ("nth", pa.int64()), ("edit", pa.string()), some.field("turn")]
        + [(c, pa.string()) for c in ("was", "fault", "role", "text")]
    )

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def every() -> Iterator[dict]:
            for segment in segments(batches):
                key = (segment[0]["conv_id"], segment[0]["part"])
                yield from edit_rows(segment, *states.get(key, (START, None)))

        yield from batches_of(every(), arrow)

    whole = rows.join(names, is_cut, "left_anti").mapInArrow(edits, schema)
    return whole, cut_rows.mapInArrow(edits, schema)


def summaries(edits: DataFrame) -> DataFrame:
    """One row per conversation of `edits`, which are sorted by conversation and order."""
    conv = edits.schema["conv_id"]
    counts = ("gaps", *FAULTS, "illegal", "cost")
    schema = T.StructType(
        [conv]
        + [T.StructField(c, T.LongType()) for c in counts]
        + [T.StructField(c, T.StringType()) for c in ("audit", "repaired_sha256")]
    )
    kind = edits.select("conv_id").limit(0).toArrow().schema.field("conv_id")
    arrow = pa.schema(
        [kind] + [(c, pa.int64()) for c in counts] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    )

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current: object = _NO
        for batch in batches:
            for part in slices(batch):
                for row in part.to_pylist():
                    if row["conv_id"] != current:
                        if current is not _NO:
                            yield summary.result()
                        current, summary = row["conv_id"], Summary(row["conv_id"])
                    summary.add(row)
        if current is not _NO:
            yield summary.result()

    return edits.mapInArrow(lambda batches: batches_of(every(batches), arrow), schema)


class Summary:
    """What is told of one conversation, from its edits in order; texts are not held."""

    def __init__(self, conv_id: object):
        self.row = {"conv_id": conv_id, "illegal": 0, "cost": 0} | dict.fromkeys(FAULTS, 0)
        self.first = self.last = None
        self.turns = 0
        self.audit: list[str] = []
        self.initial: str | None = None
        self.hash, self.lines = hashlib.sha256(), 0

    def add(self, row: dict) -> None:
        edit, fault = row["edit"], row["fault"]
        self.audit.append(edit)
        self.row["cost"] += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            if fault:
                self.row[fault] += 1
                self.row["cost"] += TRUNCATED * (fault == "truncated" and edit != "D")
            initial = row["was"][:1]
            self.row["illegal"] += self.initial is not None and self.initial + initial not in LEGAL
            self.initial = initial
            if row["turn"] is not None and row["turn"] != self.last:
                self.first = row["turn"] if self.first is None else self.first
                self.last, self.turns = row["turn"], self.turns + 1
        if edit != "D":
            self.hash.update(f"{chr(10) if self.lines else ''}{row['role']}:{row['text']}".encode())
            self.lines += 1

    def result(self) -> dict:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return self.row | {
            "gaps": gaps, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()
        }


def repair(rows: DataFrame) -> DataFrame:
    """All edits of the rows (conv_id, turn, role, text); see `repaired`."""
    whole, cut = repaired(rows)
    return whole.unionByName(cut)


def repair_digests(rows: DataFrame) -> DataFrame:
    """Spoil the rows, repair them, and tell the outcome of every conversation."""
    whole, cut = repaired(damaged(rows))
    keys = ["conv_id", "part", "nth"]
    # A conversation's hash runs over its lines in order; they stream through, sorted.
    cut = cut.repartition("conv_id").sortWithinPartitions(*keys)
    found = summaries(whole).unionByName(summaries(cut))
    every = rows.select(F.col("conv_id").alias("of")).distinct()
    joined = every.join(found, F.col("of").eqNullSafe(F.col("conv_id")), "left")
    empty = hashlib.sha256().hexdigest()
    missing = {"audit": "", "repaired_sha256": empty}
    return joined.select(
        F.col("of").alias("conv_id"),
        *[
            F.coalesce(F.col(c), F.lit(missing.get(c, 0))).alias(c)
            for c in found.columns
            if c != "conv_id"
        ],
    )
