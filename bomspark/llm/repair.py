"""Conversation structure repair by an auction shortest-path algorithm.

A conversation is in order if its roles read system (at most once, first), then user
and assistant in turn, ending with the assistant, or if it is empty.  Edits
with integer costs keep, rename or delete a row or insert an empty one.  Nodes of
the lattice are (rows done, state of that pattern), arcs are edits, and the
cheapest repair is a shortest path to the end.

Shortest paths are found by auction: every node has a price, a path starts at
an origin, is extended over the arc whose cost plus head's price is least if the
tail's price equals that, and otherwise the price is raised to it and the path
contracted by that node.  Origins are taken column by column from the end and
prices are kept, so a path ends at the first node whose price is final.
Prices of columns with the same kind of row and the same prices ahead are
remembered.  Converged prices leave an arc tight iff it lies on a shortest path,
so the cheapest repair with the least audit string is traced by always taking
the first tight arc.

A conversation of up to ``max_rows`` rows and ``max_bytes`` of text is repaired
by one task.  A longer one, which may hold a large share of all rows, is cut into
segments in the order of its turns: the prices through a segment to each of its
four exits form a small matrix, the matrices of a conversation are folded from
its end into the exits' prices, every segment is traced from each entry, and the
entries are followed from the first one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

#: Longest conversation, in rows and in bytes of text, that one task repairs alone.
MAX_ROWS = 4096
MAX_BYTES = 32 << 20
#: Characters of text after which a task hands its repairs on.
_BATCH_CHARS = 1 << 22

# States: nothing so far, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
FAR = float("inf")
#: Costs of the edits, and of leaving a truncated row in.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Initials of the edits.
KEPT, RENAMED, DELETED, INSERTED = "K", "R", "D", "I"

# Kinds of rows: initial of the role ("" for any that cannot stay as it is) and
# what is wrong.
FINE, BLANK, DUPLICATE, SHORT = "", "blank", "duplicate", "truncated"
Kind = tuple[str, str]
Prices = tuple[float, float, float, float]


# ------------------------------------------------------------------ the lattice

def _next(state: int) -> int:
    """The state after the user or assistant row that may follow."""
    return ASSISTANT if state == USER else USER


def _after(state: int, initial: str) -> int | None:
    """The state after keeping a row of that role, if it may follow."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


@lru_cache(maxsize=None)
def _arcs(kind: Kind | None, state: int) -> tuple[tuple[str, float, bool, int], ...]:
    """(edit, cost, whether the row is done, state) out of a node, by edit; no kind
    of row: behind the last one."""
    insert = (INSERTED, INSERT, False, _next(state))
    if kind is None:
        return (insert,)
    initial, fault = kind
    out = [(DELETED, DELETE, True, state), insert]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == SHORT else 0
        kept = _after(state, initial)
        if kept is not None:
            out.append((KEPT, extra, True, kept))
        out.append((RENAMED, RENAME + extra, True, _next(state)))
    return tuple(out)


@lru_cache(maxsize=1 << 16)
def _auction(kind: Kind | None, ahead: Prices) -> Prices:
    """Final prices of a column, given those of the column ahead."""
    # user and assistant reach each other, and both can go on to either ahead
    reached = [FAR if s in (USER, ASSISTANT) and ahead[USER] == ahead[ASSISTANT] == FAR else None
               for s in STATES]
    if kind is None:       # behind the last row the pattern may end, at no cost
        reached = [ahead[s] if ahead[s] < FAR else None for s in STATES]
    final = list(reached)
    price = [0 if p is None else p for p in reached]
    for origin in STATES:
        path = [origin]
        while final[path[-1]] is None:
            node = path[-1]
            best, done, head = FAR, True, node
            for _, cost, row_done, to in _arcs(kind, node):
                way = cost + (ahead[to] if row_done else price[to])
                if way < best:
                    best, done, head = way, row_done, to
            if price[node] < best:             # raise the price, contract the path
                price[node] = best
                if best == FAR:
                    final[node] = FAR
                if len(path) > 1:
                    path.pop()
            elif done:                         # extend it to a node ahead
                break
            else:                              # extend it within the column
                path.append(head)
        for node in path:                      # its arcs are tight up to a final price
            final[node] = price[node]
    return tuple(final)


def column(kind: Kind | None, ahead: Prices) -> Prices:
    """Final prices of a column: those of prices less the least one, plus that."""
    least = min(ahead)
    if least == FAR:
        return (FAR,) * 4
    return tuple(p + least for p in _auction(kind, tuple(p - least for p in ahead)))


#: Prices of the pattern's ends, and with the inserts that may be needed there.
ENDS: Prices = (0, FAR, FAR, 0)


def prices(kinds: list[Kind], exits: Prices) -> list[Prices]:
    """Prices of all columns; the last one is ``exits``."""
    out = [exits]
    for kind in reversed(kinds):
        out.append(column(kind, out[-1]))
    return out[::-1]


def trace(kinds: list[Kind], at: list[Prices], state: int) -> tuple[str, int]:
    """Edits of the cheapest way from ``state``, least as text, and its exit."""
    edits = []
    for i, kind in enumerate(kinds):
        done = False
        while not done:
            edit, cost, done, to = next(
                a for a in _arcs(kind, state)
                if at[i][state] == a[1] + at[i + 1 if a[2] else i][a[3]])
            edits.append(edit)
            state = to
    return "".join(edits), state


def closing(state: int) -> str:
    """Inserts behind the last row."""
    at, edits = column(None, ENDS), ""
    while at[state]:
        edits, state = edits + INSERTED, _next(state)
    return edits


def apply_edits(edits: str, rows: Iterator[tuple[str, str]], state: int = START
                ) -> Iterator[tuple[str, str]]:
    """The repaired rows (role, text)."""
    name = {USER: "user", ASSISTANT: "assistant"}
    for edit in edits:
        if edit == INSERTED:
            state = _next(state)
            yield name[state], ""
            continue
        role, text = next(rows)
        if edit == DELETED:
            continue
        if edit == KEPT:
            state = _after(state, role[:1])
            yield role, text
        else:
            state = _next(state)
            yield name[state], text


# ------------------------------------------------------------------ rows

_BLANK_CHARS = " \t\n\v\f\r"


def fault_of(text: str, repeated: bool) -> str:
    """The first fault of a row."""
    body = text.rstrip(_BLANK_CHARS)
    if not body:
        return BLANK
    if repeated:
        return DUPLICATE
    return FINE if body[-1] in ".!?" else SHORT


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else ""


#: Neighbours whose initials are in order.
_IN_ORDER = {"su", "ua", "au"}


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in _IN_ORDER for a, b in zip(initials, initials[1:]))


def _gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def repair_rows(rows: list[tuple[int | None, str, str]]) -> dict:
    """One conversation, (turn, role, text) in order, as a whole."""
    seen, kinds = set(), []
    for _, role, text in rows:
        kinds.append((_initial(role), fault_of(text, (role, text) in seen)))
        seen.add((role, text))
    at = prices(kinds, column(None, ENDS))
    edits, state = trace(kinds, at, START)
    edits += closing(state)
    faults = [f for _, f in kinds]
    return {"gaps": _gaps([t for t, _, _ in rows]), "blank": faults.count(BLANK),
            "duplicate": faults.count(DUPLICATE), "truncated": faults.count(SHORT),
            "illegal": _illegal([r[:1] for _, r, _ in rows]), "cost": int(at[0][START]),
            "audit": edits,
            "turns": list(apply_edits(edits, ((r, t) for _, r, t in rows)))}


# ------------------------------------------------------------------ Spark

_TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()),
                                   T.StructField("text", T.StringType())]))
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_ARROW_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _schema(id_field: T.StructField, id_col: str) -> T.StructType:
    return T.StructType([T.StructField(id_col, id_field.dataType),
                         T.StructField("piece", T.LongType()), T.StructField("pieces", T.LongType()),
                         *[T.StructField(c, T.LongType()) for c in _COUNTS],
                         T.StructField("audit", T.StringType()), T.StructField("turns", _TURNS)])


def _turns(found: list[list[tuple[str, str]]]) -> pa.Array:
    return pa.array([[{"role": r, "text": t} for r, t in rows] for rows in found], _ARROW_TURNS)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first ``keys`` values, over the batches of a sorted
    partition."""
    now, held = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:keys] != now:
                if held:
                    yield now, held
                now, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield now, held


def _repaired_whole(rows: DataFrame, id_col: str) -> DataFrame:
    """Conversations that one task repairs each."""
    schema = _schema(rows.schema["id"], id_col)
    dealt = (rows.select("id", "turn", "role", "text").repartition("id")
             .sortWithinPartitions("id", "turn", "role", "text"))

    def batch(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        ids, reports = [f[0] for f in found], [f[1] for f in found]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), pa.array([0] * len(ids), pa.int64()),
             pa.array([1] * len(ids), pa.int64()),
             *[pa.array([r[c] for r in reports], pa.int64()) for c in _COUNTS],
             pa.array([r["audit"] for r in reports], pa.string()),
             _turns([r["turns"] for r in reports])], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def noting() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                yield b
        found, weight = [], 0
        for (conv,), own in _groups(noting(), 1):
            found.append((conv, repair_rows(own)))
            weight += sum(64 + len(text) for _, _, text in own)
            if weight >= _BATCH_CHARS:
                yield batch(found, kind)
                found, weight = [], 0
        if found:
            yield batch(found, kind)

    return dealt.mapInArrow(run, schema)


def _in_segments(rows: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """Sorted rows with their number in that order, ``at``, and the segment: runs of
    one conversation's rows up to ``max_rows`` and, but for its last row,
    ``max_bytes``."""
    schema = T.StructType([*rows.schema.fields, T.StructField("at", T.LongType()),
                           T.StructField("segment", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = segment = TaskContext.get().partitionId() << 33
        now, count, size = None, 0, 0
        for b in batches:
            segments = []
            for key, n in zip(b.column("key").to_pylist(), b.column("bytes").to_pylist()):
                if key != now or count >= max_rows or size >= max_bytes:
                    segment, now, count, size = segment + 1, key, 0, 0
                count, size = count + 1, size + n
                segments.append(segment)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(range(at, at + b.num_rows), pa.int64()),
                 pa.array(segments, pa.int64())], names=schema.names)
            at += b.num_rows

    return rows.mapInArrow(run, schema)


def _flagged(rows: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """Rows of long conversations in order (``at``), their segment, kind and fault.

    Rows are ranged by conversation, turn, role, text and a number, so that even
    one repeated row spreads.  A duplicate is a row behind the first of its role and
    text, which comes from a partial aggregate."""
    key = F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")).alias("key")
    order = ["key", "turn", "role", "text", "number"]
    numbered = stored(rows.select("id", key, "turn", "role", "text", _bytes().alias("bytes"),
                                  F.monotonically_increasing_id().alias("number")), "long-rows")
    ranged = stored(_in_segments(numbered.repartitionByRange(*order).sortWithinPartitions(*order),
                                 max_rows, max_bytes).drop("number", "bytes"), "ordered-rows")
    first = stored(ranged.groupBy("key", "role", "text").agg(F.min("at").alias("first")),
                   "first-rows")
    body = F.rtrim("text", F.lit(_BLANK_CHARS))
    fault = (F.when(body == "", BLANK).when(F.col("at") > F.col("first"), DUPLICATE)
             .when(~F.substring(body, -1, 1).isin(".", "!", "?"), SHORT).otherwise(FINE))
    return stored(ranged.join(first, ["key", "role", "text"]).select(
        "id", "key", "at", "segment", "turn", "role", "text",
        F.substring("role", 1, 1).alias("initial"), fault.alias("fault")), "flagged-rows")


def _kinds(rows: list[tuple]) -> list[Kind]:
    return [(i if i in ("s", "u", "a") else "", f) for i, f in rows]


def _segments(flagged: DataFrame) -> DataFrame:
    """Per segment: its kinds of rows and prices to each exit from each entry."""
    dealt = (flagged.select("key", "segment", "at", "initial", "fault")
             .repartition("key", "segment").sortWithinPartitions("key", "segment", "at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, segment), rows in _groups(batches, 2):
            initials, faults = [r[1] for r in rows], [r[2] for r in rows]
            kinds = _kinds([r[1:] for r in rows])
            ways = []
            for to in STATES:
                exits = tuple(0 if s == to else FAR for s in STATES)
                ways += [None if p == FAR else int(p) for p in prices(kinds, exits)[0]]
            yield pa.RecordBatch.from_pylist([{
                "key": key, "segment": segment, "ways": ways, "illegal": _illegal(initials),
                "first": initials[0], "last": initials[-1],
                **{f: faults.count(f) for f in (BLANK, DUPLICATE, SHORT)}}], schema=_SEGMENT)

    return dealt.mapInArrow(run, "key string, segment long, ways array<long>, illegal long, "
                                 "first string, last string, blank long, duplicate long, "
                                 "truncated long")


_SEGMENT = pa.schema([("key", pa.string()), ("segment", pa.int64()), ("ways", pa.list_(pa.int64())),
                      ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
                      (BLANK, pa.int64()), (DUPLICATE, pa.int64()), (SHORT, pa.int64())])


def _exit_prices(segments: DataFrame) -> DataFrame:
    """(key, segment, exits, cost, illegal): prices at each segment's end, from the last
    segment backwards (one row of a few numbers per segment)."""
    dealt = (segments.repartition("key").sortWithinPartitions("key", F.desc("segment")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ahead, behind = None, None, ""
        for b in batches:
            out = []
            for r in b.select(["key", "segment", "ways", "illegal", "first", "last"]).to_pylist():
                if r["key"] != now:
                    now, ahead, behind = r["key"], column(None, ENDS), None
                illegal = r["illegal"] + (behind is not None
                                          and r["last"] + behind not in _IN_ORDER)
                out.append({"key": now, "segment": r["segment"], "illegal": illegal,
                            "exits": [int(p) for p in ahead]})
                ways = [FAR if w is None else w for w in r["ways"]]
                ahead = tuple(min(ways[4 * t + s] + ahead[t] for t in STATES) for s in STATES)
                behind = r["first"]
                out[-1]["cost"] = int(ahead[START])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                    [("key", pa.string()), ("segment", pa.int64()), ("illegal", pa.int64()),
                     ("exits", pa.list_(pa.int64())), ("cost", pa.int64())]))

    return dealt.mapInArrow(run, "key string, segment long, illegal long, exits array<long>, "
                                 "cost long")


def _traced(flagged: DataFrame, exits: DataFrame) -> DataFrame:
    """(key, segment, edits, to): edits and exit state of each segment by entry state."""
    lead = exits.select("key", "segment", F.lit(-1).cast("long").alias("at"),
                        F.lit("").alias("initial"), F.lit("").alias("fault"), "exits")
    rows = flagged.select("key", "segment", "at", "initial", "fault",
                          F.lit(None).cast("array<long>").alias("exits"))
    dealt = (rows.unionByName(lead).repartition("key", "segment")
             .sortWithinPartitions("key", "segment", "at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, segment), own in _groups(batches, 2):
            kinds = _kinds([r[1:3] for r in own[1:]])
            at = prices(kinds, tuple(own[0][3]))
            ways = [trace(kinds, at, s) if at[0][s] < FAR else ("", s) for s in STATES]
            yield pa.RecordBatch.from_pylist(
                [{"key": key, "segment": segment, "edits": [w[0] for w in ways],
                  "to": [w[1] for w in ways]}], schema=pa.schema(
                    [("key", pa.string()), ("segment", pa.int64()),
                     ("edits", pa.list_(pa.string())), ("to", pa.list_(pa.int32()))]))

    return dealt.mapInArrow(run, "key string, segment long, edits array<string>, to array<int>")


def _entered(traced: DataFrame) -> DataFrame:
    """(key, segment, order, entry, leave): a segment's number in its conversation and
    the states in which it is entered and left."""
    dealt = traced.select("key", "segment", "to").repartition("key").sortWithinPartitions(
        "key", "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, order = None, START, 0
        schema = pa.schema([("key", pa.string()), ("segment", pa.int64()), ("order", pa.int64()),
                            ("entry", pa.int32()), ("leave", pa.int32())])
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["key"] != now:
                    now, state, order = r["key"], START, 0
                out.append({"key": now, "segment": r["segment"], "order": order, "entry": state,
                            "leave": r["to"][state]})
                state, order = r["to"][state], order + 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return dealt.mapInArrow(run, "key string, segment long, order long, entry int, leave int")


def _repaired_long(rows: DataFrame, id_col: str, max_rows: int, max_bytes: int) -> DataFrame:
    """Conversations longer than a task may hold: one row per segment."""
    schema = _schema(rows.schema["id"], id_col)
    flagged = _flagged(rows, max_rows, max_bytes)
    segments = stored(_segments(flagged), "segments")
    exits = stored(_exit_prices(segments), "exit-prices")
    traced = stored(_traced(flagged, exits), "traced-segments")
    entered = stored(_entered(traced), "entered-segments")
    whole = flagged.groupBy("key").agg(
        F.min("id").alias("id"), (F.max("turn").cast("long") - F.min("turn") + 1
                                  - F.countDistinct("turn")).alias("gaps"))
    sums = (segments.groupBy("key").agg(*[F.sum(c).alias(c) for c in (BLANK, DUPLICATE, SHORT)],
                                        F.count(F.lit(1)).alias("pieces"))
            .join(exits.groupBy("key").agg(
                F.sum("illegal").alias("illegal"), F.max_by("cost", -F.col("segment")).alias("cost")),
                "key"))
    lead = (traced.join(entered, ["key", "segment"])
            .join(whole.join(sums, "key"), "key")
            .withColumn("audit", F.element_at("edits", F.col("entry") + 1))
            .select("key", "segment", F.lit(-1).cast("long").alias("at"), "id",
                    F.struct(F.coalesce("gaps", F.lit(0)).alias("gaps"),
                             *[F.col(c) for c in (*_COUNTS[1:], "pieces", "entry", "leave", "audit")],
                             (F.col("order") == F.col("pieces") - 1).alias("last"),
                             F.col("order").alias("piece")).alias("lead"),
                    F.lit("").alias("role"), F.lit("").alias("text")))
    none = F.lit(None).cast(lead.schema["lead"].dataType).alias("lead")
    dealt = (flagged.select("key", "segment", "at", "id", none, "role", "text").unionByName(lead)
             .repartition("key", "segment").sortWithinPartitions("key", "segment", "at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def noting() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.schema.field(3).type
                yield b
        for _, own in _groups(noting(), 2):
            conv, at = own[0][1], own[0][2]
            edits = at["audit"] + (closing(at["leave"]) if at["last"] else "")
            turns = list(apply_edits(edits, ((r[3], r[4]) for r in own[1:]), at["entry"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], kind), pa.array([at["piece"]], pa.int64()),
                 pa.array([at["pieces"]], pa.int64()),
                 *[pa.array([at[c]], pa.int64()) for c in _COUNTS],
                 pa.array([edits], pa.string()), _turns([turns])], names=schema.names)

    return dealt.mapInArrow(run, schema)


def _bytes() -> Column:
    return F.octet_length("text") + F.octet_length("role")


class Repaired(NamedTuple):
    """Repaired conversations of one piece each, and if there are any the pieces of
    longer ones.  Columns: the id, piece, pieces, the counts gaps, blank, duplicate,
    truncated, illegal and cost (of the whole conversation, in each piece), audit
    (initials of the piece's edits) and turns (its repaired rows, role and text)."""

    whole: DataFrame
    pieces: DataFrame | None

    def all(self) -> DataFrame:
        return self.whole if self.pieces is None else self.whole.unionByName(self.pieces)


def repair(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", max_rows: int = MAX_ROWS,
           max_bytes: int = MAX_BYTES) -> Repaired:
    """Every conversation's repair.

    Rows go by turn, nulls first, then by role and text.  A null role or text is one
    space; rows without a conversation's id are one conversation; repeated rows are
    duplicates; an empty table gives no rows; other columns are ignored.  A text of
    any length is held by one task, with those of its segment."""
    rows = conversations.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    long = stored(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum(_bytes()).alias("b"))
                  .where((F.col("n") > max_rows) | (F.col("b") > max_bytes))
                  .select(F.col("id").alias("long")), "long-ids")
    if long.isEmpty():
        return Repaired(_repaired_whole(rows, id_col), None)
    is_long = F.col("id").eqNullSafe(F.col("long"))
    return Repaired(_repaired_whole(rows.join(long, is_long, "left_anti"), id_col),
                    _repaired_long(rows.join(long, is_long, "left_semi"), id_col, max_rows,
                                   max_bytes))


def report(repaired: Repaired, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: the counts, its whole audit, and the SHA-256 of its
    repaired rows as ``role:text``, joined by line breaks.

    The digest of a conversation of several pieces is one sequential stream, so its
    pieces pass through one task, one at a time, which holds only the digest's
    state and the audit."""
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    lines = F.array_join(line, "\n").cast("binary")
    one = repaired.whole.select(id_col, *_COUNTS, "audit",
                                F.sha2(lines, 256).alias("repaired_sha256"))
    if repaired.pieces is None:
        return one
    schema = one.schema
    dealt = (repaired.pieces.select(id_col, "piece", *_COUNTS, "audit",
                                    F.size("turns").alias("n"), lines.alias("lines"))
             .repartition(id_col).sortWithinPartitions(id_col, "piece"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(kind: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], kind), *[pa.array([c], pa.int64()) for c in counts],
                 pa.array(["".join(audit)], pa.string()),
                 pa.array([digest.hexdigest()], pa.string())], names=schema.names)
        digest = None
        for b in batches:
            kind = b.column(0).type
            for i in range(b.num_rows):
                row = [c[i].as_py() for c in b.columns]
                if row[1] == 0:                  # a conversation's first piece
                    if digest is not None:
                        yield done(kind)
                    conv, counts, audit = row[0], row[2:-3], []
                    digest, between = hashlib.sha256(), b""
                if row[-2]:
                    digest.update(between)
                    digest.update(row[-1])
                    between = b"\n"
                audit.append(row[-3])
        if digest is not None:
            yield done(kind)

    return one.unionByName(dealt.mapInArrow(run, schema))


# ------------------------------------------------------------------ damage

def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults planted by the CRC-32 of
    ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes
    ``.!?`` out of it, 3 repeats it, 4 makes its role user.  Nulls in the hashed
    text, a role or a text are one space."""
    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    hit = conversations.select("conv_id", "turn", text("role").alias("role"),
                               text("text").alias("text"), code.alias("code")).where("code <> 0")
    hit = hit.withColumns({
        "text": F.when(F.col("code") == 1, "").when(
            F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("code") == 4, "user").otherwise(F.col("role"))})
    times = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hit.select("conv_id", "turn", "role", "text", F.explode(times).alias("time")).drop("time")


def repair_damaged(conversations: DataFrame, max_rows: int = MAX_ROWS,
                   max_bytes: int = MAX_BYTES) -> DataFrame:
    """The report of every conversation after ``damage``; one that lost all its rows
    has zeros, no edits and the digest of nothing."""
    damaged = damage(conversations)
    emptied = (conversations.select("conv_id").distinct()
               .exceptAll(damaged.select("conv_id").distinct()))
    nothing = hashlib.sha256(b"").hexdigest()
    return report(repair(damaged, max_rows=max_rows, max_bytes=max_bytes)).unionByName(
        emptied.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in _COUNTS],
                       F.lit("").alias("audit"), F.lit(nothing).alias("repaired_sha256")))
