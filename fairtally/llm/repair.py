"""Repair of the structure of conversations by depth-first branch-and-bound.

A repaired conversation is empty, or an optional system row and then pairs of user and assistant. Rows are
kept, given another role, deleted, or an empty row is inserted. The cheapest repair is searched depth
first with an explicit stack: a suffix bound and the incumbent (cost, audit) cut branches, and a
table per (row, state) drops prefixes that are no better than one already followed.

Long conversations are cut into segments of bounded size. A segment is searched from each state
that it may begin in to each that it may end in; the segments' results are then chained. So one
conversation with very many rows is searched by many tasks; only its audit and its digest, which
are one value each, are put together in one.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: States in which a conversation may end.
DONE = (START, ASSISTANT)
INFINITE = 1 << 60
BLANKS = " \t\n\x0b\x0c\r"
LEGAL_PAIRS = ("su", "ua", "au")

#: Distinct rows and characters of text that one search takes at most (one row at least).
SEGMENT_ROWS, SEGMENT_CHARS = 1000, 1 << 18


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5  # of a truncated row that is not deleted


@dataclass(frozen=True)
class Item:
    """A row as the search sees it; one that must go may stand for ``count`` equal ones in sequence.

    Nothing is inserted between those: the audit with all deletions first costs as much and is less.
    """

    initial: str
    must_go: bool = False
    truncated: bool = False
    count: int = 1


def expects_user(state: int) -> bool:
    return state != USER


def after_row(state: int) -> int:
    """The state after a row with the role that ``state`` expects."""
    return USER if expects_user(state) else ASSISTANT


def kept_state(item: Item, state: int) -> int | None:
    """The state after keeping the row, None if its role doesn't fit."""
    if item.initial == "s" and state == START:
        return SYSTEM
    return after_row(state) if item.initial == ("u" if expects_user(state) else "a") else None


def moves(items: Sequence[Item], i: int, state: int, costs: Costs) -> list[tuple[str, int, int, int]]:
    """(edits, next row, next state, cost), least edit first."""
    found = []
    if i < len(items):
        found.append(("D" * items[i].count, i + 1, state, costs.delete * items[i].count))
    found.append(("I", i, after_row(state), costs.insert))
    if i < len(items) and not items[i].must_go:
        extra = costs.truncated if items[i].truncated else 0
        kept = kept_state(items[i], state)
        if kept is not None:
            found.append(("K", i + 1, kept, extra))
        found.append(("R", i + 1, after_row(state), costs.rerole + extra))
    return found


def suffix_bounds(items: Sequence[Item], costs: Costs, ends: Sequence[int]) -> list[list[int]]:
    """For each row and state no more than what the rest costs at least.

    A relaxation of the states: how the rest ends is left open, and a system row need not be followed
    by anything. Ends before the first pair are reached by deletions only, which gives their bound.
    """
    n = len(items)
    bounds = [[0] * 4 for _ in range(n + 1)]
    if not set(ends) & {USER, ASSISTANT}:
        bounds[n] = [0 if s in ends or (s == START and SYSTEM in ends) else INFINITE for s in STATES]
        for i in range(n - 1, -1, -1):
            gone = costs.delete * items[i].count
            bounds[i] = [min(INFINITE, gone + b) for b in bounds[i + 1]]
            if SYSTEM in ends and items[i].initial == "s" and not items[i].must_go:
                bounds[i][START] = min(bounds[i][START], bounds[i + 1][SYSTEM])
        return bounds
    for i in range(n - 1, -1, -1):
        below = bounds[i + 1]
        here = [min(c + below[s] for _, j, s, c in moves(items, i, state, costs) if j > i) for state in STATES]
        bounds[i] = [min(h, costs.insert + here[after_row(s)]) for s, h in zip(STATES, here)]
    return bounds


@dataclass
class Search:
    """One branch-and-bound run; ``expanded`` counts the nodes that were followed."""

    items: Sequence[Item]
    start: int
    ends: Sequence[int]
    costs: Costs = field(default_factory=Costs)
    expanded: int = 0

    def _dive(self, bounds: list[list[int]]) -> int:
        """Cost of the repair that always takes the move of least bound: the first incumbent."""
        i, state, total = 0, self.start, 0
        while i < len(self.items) or state not in self.ends:
            if bounds[i][state] >= INFINITE or (i == len(self.items) and not set(self.ends) & {USER, ASSISTANT}):
                return INFINITE
            _, i, state, cost = min(moves(self.items, i, state, self.costs), key=lambda m: m[3] + bounds[m[1]][m[2]])
            total += cost
        return total

    def run(self) -> tuple[int, str] | None:
        """The least (cost, audit) from the start state to one of the ends; None if there is none.

        The stack yields prefixes in the order of their audits. A prefix that meets (row, state) again
        at no lower cost is therefore dominated, at equal cost by its audit.
        """
        items, n = self.items, len(self.items)
        bounds = suffix_bounds(items, self.costs, self.ends)
        best, audit = self._dive(bounds), None
        least = {}
        stack = [(0, self.start, 0, None)]
        while stack:
            i, state, cost, path = stack.pop()
            bound = cost + bounds[i][state]
            if bound >= INFINITE or bound > best or (bound == best and audit is not None):
                continue
            if least.get((i, state), INFINITE) <= cost:
                continue
            least[i, state] = cost
            self.expanded += 1
            if i == n and state in self.ends:
                best, audit = cost, path
                continue  # more insertions only cost more
            for edits, j, after, more in reversed(moves(items, i, state, self.costs)):
                stack.append((j, after, cost + more, (edits, path)))
        if best >= INFINITE:
            return None
        edits = []
        while audit is not None:
            edits.append(audit[0])
            audit = audit[1]
        return best, "".join(reversed(edits))


def repaired_lines(state: int, audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[str]:
    """``role:text`` of the repaired rows, from the state before them on."""
    for edit in audit:
        expected = "user" if expects_user(state) else "assistant"
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "K":
            state = SYSTEM if state == START and role[:1] == "s" else after_row(state)
            yield f"{role}:{text}"
        elif edit != "D":
            state = after_row(state)
            yield f"{expected}:{text}"


def every_copy(roles: Sequence[str], texts: Sequence[str], copies: Sequence[int]) -> Iterator[tuple[str, str]]:
    return ((r, t) for r, t, n in zip(roles, texts, copies) for _ in range(n))


@dataclass
class Segment:
    """Rows of one conversation in sequence, gathered until the segment is full or the conversation ends."""

    conv_id: object
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    copies: list[int] = field(default_factory=list)
    items: list[Item] = field(default_factory=list)
    turns: list[int] = field(default_factory=list)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    chars: int = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
        initial, body = role[:1], text.rstrip(BLANKS)
        blank, cut = not body, body[-1:] not in (".", "!", "?")
        if self.roles:
            self.illegal += self.roles[-1][:1] + initial not in LEGAL_PAIRS
        self.illegal += copies - 1
        if blank or seen:
            self.blank += copies if blank else 0
            self.duplicate += 0 if blank else copies
            self.items.append(Item(initial, True, count=copies))
        else:
            self.duplicate += copies - 1
            self.truncated += cut
            self.items.append(Item(initial, truncated=cut))
            if copies > 1:
                self.items.append(Item(initial, True, count=copies - 1))
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        self.chars += len(text)

    @property
    def full(self) -> bool:
        return len(self.roles) >= SEGMENT_ROWS or self.chars >= SEGMENT_CHARS

    def gaps(self) -> int:
        return self.turns[-1] - self.turns[0] + 1 - len(self.turns) if self.turns else 0

    def facts(self) -> dict:
        return {"blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}

    def whole(self, costs: Costs) -> dict:
        """The result of a conversation that is all in this segment."""
        cost, audit = Search(self.items, START, DONE, costs).run()
        lines = repaired_lines(START, audit, every_copy(self.roles, self.texts, self.copies))
        digest = hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()
        return self.facts() | {"gaps": self.gaps(), "cost": cost, "audit": audit, "repaired_sha256": digest}

    def part(self, costs: Costs) -> dict:
        """What the chain over all segments of a conversation needs of this one, and its rows."""
        ways = []
        for start in STATES:
            for end in STATES:
                found = Search(self.items, start, (end,), costs).run()
                if found is not None:
                    ways.append({"start": start, "end": end, "cost": found[0], "audit": found[1]})
        return self.facts() | {
            "ways": ways, "roles": self.roles, "texts": self.texts, "copies": self.copies,
            "first_initial": self.roles[0][:1] if self.roles else None,
            "last_initial": self.roles[-1][:1] if self.roles else None,
            "first_turn": self.turns[0] if self.turns else None,
            "last_turn": self.turns[-1] if self.turns else None,
            "turns": len(self.turns),
        }


COUNTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
RESULT = f"{COUNTS}, cost bigint, audit string, repaired_sha256 string"
WAYS = "ways array<struct<start:int,end:int,cost:bigint,audit:string>>"
SEGMENTS = (
    f"part int, seq int, closed boolean, {RESULT}, {WAYS}, roles array<string>, texts array<string>, copies array<bigint>, "
    "first_initial string, last_initial string, first_turn bigint, last_turn bigint, turns bigint"
)


def _segments(costs: Costs, schema: pa.Schema):
    """From rows sorted by conversation and turn to segments; a conversation that may go on in another task stays open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, seq, now, first, cut = TaskContext.get().partitionId(), [], 0, None, True, False

        def close(segment: Segment, whole: bool) -> None:
            nonlocal seq
            found = segment.whole(costs) if whole else segment.part(costs)
            out.append({"conv_id": segment.conv_id, "part": part, "seq": seq, "closed": whole} | found)
            seq += 1

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "seen")]
            for conv_id, turn, role, text, copies, seen in zip(*columns):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        close(now, not first and not cut)
                        first = False
                    now, cut = Segment(conv_id), False
                elif now.full:
                    close(now, False)
                    now, cut = Segment(conv_id), True
                if role is not None:  # null marks a row that only names its conversation
                    now.add(turn, role, text, copies, seen)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        if now is not None:
            close(now, False)
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def chain(ways: Sequence[Sequence[dict]]) -> tuple[int, list[tuple[int, str]]]:
    """The cheapest repair over all segments: its cost, and per segment the state it begins in and its audit."""
    reached = {START: (0, "", ())}
    for segment in ways:
        step: dict[int, tuple] = {}
        for way in segment:
            if way["start"] in reached:
                cost, audit, path = reached[way["start"]]
                found = (cost + way["cost"], audit + way["audit"], (path, way["start"], way["audit"]))
                if way["end"] not in step or found[:2] < step[way["end"]][:2]:
                    step[way["end"]] = found
        reached = step
    cost, _, path = min((reached[s] for s in DONE if s in reached), key=lambda x: x[:2])
    steps = []
    while path:
        path, start, audit = path
        steps.append((start, audit))
    return cost, steps[::-1]


CHAINED = f"{COUNTS}, cost bigint, part int, seq int, start int, audit string"


def _chained(schema: pa.Schema):
    """Per conversation: the counts over all its segments, and of each the start and the audit that are best."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seq"]))
        total = {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated", "illegal")}
        filled = [r for r in rows if r["first_initial"] is not None]
        for a, b in zip(filled, filled[1:]):
            total["illegal"] += a["last_initial"] + b["first_initial"] not in LEGAL_PAIRS
        timed = [r for r in rows if r["turns"]]
        distinct = sum(r["turns"] for r in timed) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:]))
        total["gaps"] = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - distinct if timed else 0
        cost, steps = chain([r["ways"] for r in rows])
        found = [
            total | {"conv_id": r["conv_id"], "cost": cost, "part": r["part"], "seq": r["seq"], "start": s, "audit": a}
            for r, (s, a) in zip(rows, steps)
        ]
        return pa.Table.from_pylist(found, schema)

    return run


def _digests(schema: pa.Schema):
    """From sorted segments with their audits to one row per conversation; only the digest is kept between batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, last, digest, audits, empty = [], None, None, [], True

        def result() -> dict:
            row = {k: last[k] for k in schema.names if k in last}
            return row | {"audit": "".join(audits), "repaired_sha256": digest.hexdigest()}

        for batch in batches:
            for row in batch.to_pylist():
                if last is None or row["conv_id"] != last["conv_id"]:
                    if last is not None:
                        done.append(result())
                    digest, audits, empty = hashlib.sha256(), [], True
                rows = every_copy(row["roles"], row["texts"], row["copies"])
                for line in repaired_lines(row["start"], row["audit"], rows):
                    digest.update(b"" if empty else b"\n")
                    digest.update(line.encode("utf-8", "surrogatepass"))
                    empty = False
                audits.append(row["audit"])
                last = row
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done.clear()
        if last is not None:
            yield pa.RecordBatch.from_pylist([result()], schema)

    return run


def _arrow_schema(df: DataFrame, ddl: str) -> tuple[str, pa.Schema]:
    """The DDL with conv_id in front, in its own type, and the same for Arrow."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    key = df.schema["conv_id"]
    full = StructType([key, *_parse_datatype_string(ddl).fields])
    return f"conv_id {key.dataType.simpleString()}, {ddl}", to_arrow_schema(full)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): the rows with the faults that a hash of conv_id and turn names.

    Of 20 values, 0 drops the row (present is false), 1 empties its text, 2 removes its sentence ends, 3
    repeats it, 4 makes it a user's. A null is one blank in the key, as it is as role or text.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")), F.lit(20))
    role, text = blank("role"), blank("text")
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fault != 0).alias("present"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return rows.drop("copy")


def repair_conversations(rows: DataFrame, costs: Costs = Costs(), present: Column | None = None) -> DataFrame:
    """Per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Reads conv_id, turn, role and text; other columns don't matter. Rows are taken by turn, nulls
    first, rows of one turn by role and then by a digest of the text. Null roles and texts count as one
    blank; a null conv_id is a conversation like others. Rows where ``present`` is false only make
    their conversation known: one without other rows has zeros, an empty audit and the digest of nothing.
    Equal rows are counted before they are moved. An empty table gives no rows.
    """
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    blank = lambda c: F.when(here, F.coalesce(F.col(c).cast("string"), F.lit(" ")))
    plain = rows.select(
        "conv_id", F.when(here, F.col("turn").cast("bigint")).alias("turn"), blank("role").alias("role"), blank("text").alias("text")
    )
    counted = plain.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    counted = counted.withColumn("mark", F.sha2(F.concat("role", F.lit(":"), "text").cast("binary"), 256))
    counted = stored(counted, "conversation-rows")
    # Where a role and text stand first, if they stand at several turns.
    when = F.struct(F.col("turn").isNotNull().alias("timed"), F.col("turn").alias("turn"))
    again = counted.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m")).agg(
        F.min(when).alias("first"), F.count(F.lit(1)).alias("times")
    )
    # Written, so that Spark knows its size and need not shuffle the texts where it is small.
    again = stored(again.where("times > 1").drop("times"), "repeated-rows")
    same = counted.conv_id.eqNullSafe(again.c) & (counted.role == again.r) & (counted.mark == again.m)
    seen = F.coalesce(~F.col("turn").eqNullSafe(F.col("first.turn")) & F.col("first").isNotNull(), F.lit(False))
    flagged = counted.join(again, same, "left").select("conv_id", "turn", "role", "text", "copies", "mark", seen.alias("seen"))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("mark")]
    ordered = flagged.repartitionByRange(*order).sortWithinPartitions(*order).drop("mark")
    ddl, schema = _arrow_schema(rows, SEGMENTS)
    segments = stored(ordered.mapInArrow(_segments(costs, schema), ddl), "conversation-segments")
    whole = segments.where("closed").select("conv_id", *[c.split()[0] for c in RESULT.split(", ")])

    open_ones = segments.where("NOT closed")
    ddl, schema = _arrow_schema(rows, CHAINED)
    facts = open_ones.drop("roles", "texts", "copies", "closed", "gaps", "cost", "audit", "repaired_sha256")
    chained = facts.groupBy("conv_id").applyInArrow(_chained(schema), ddl).withColumnsRenamed({"part": "p", "seq": "q", "conv_id": "id"})
    pieces = open_ones.select("part", "seq", "conv_id", "roles", "texts", "copies")
    ready = pieces.join(chained, (pieces.part == F.col("p")) & (pieces.seq == F.col("q"))).drop("p", "q", "id")
    ddl, schema = _arrow_schema(rows, RESULT)
    streamed = ready.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return whole.unionByName(streamed.mapInArrow(_digests(schema), ddl))
