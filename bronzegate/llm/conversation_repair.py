r"""Conversation structure repair: the cheapest edits that give ``(s?(ua)+)?``, by iterative-deepening A*.

Each row is kept (0; 1 if truncated), re-roled to what must come next (2, and 1 if truncated)
or deleted (3; blank and duplicate rows must be); an empty user or assistant row may be
inserted anywhere (2).  Of the cheapest edit strings the ASCII-least is the answer.

Method.  A depth-first search takes the edits in ASCII order (Delete, Insert, Keep, Rerole)
below a cost bound that starts at the heuristic and rises to the least cost that exceeded
it; a transposition table holds, for each (row, grammar state) that failed, the least budget it
may need.  The first accepting path is the answer.  The heuristic counts what is forced (3 a blank or
duplicate row, 1 a truncated one) and 2 for each of a largest set of disjoint pairs of
neighbours that cannot both stay as they are; each such pair costs an edit of its own.

Spark's part.  Rows are range-partitioned in order of conversation and turn, so a conversation
that holds a third of all rows lies in many tasks.  Duplicates are found by a hash aggregate and
join over slim rows.  The search runs over the part of a conversation that a task has, in
segments of ``SEGMENT`` rows: since an edit string is cut uniquely into what each row takes
(inserts, then its own edit), a segment is summed up by its best string from each grammar state to
each, and segments add up by cost and then order of strings.  A conversation inside one task is
solved there; for the at most two that cross a task's ends, sixteen costs and ranks go into one small
group per conversation, which names the way each part goes.

Defined cases: null role and text are one space (so blank); rows go by turn (null first), role
and text; a null conversation is one of its own; equal rows are duplicates after the first; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzegate.llm.common import Stages, small

SEGMENT = 40
#: Grammar states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Where an inserted or re-roled row leads, and where a kept row of an initial does.
NEXT = (USER, USER, ASSISTANT, USER)
KEEP = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
NEVER = (None,) * 4
#: What must be inserted at the end in each state.
TAIL = ("", "II", "I", "")
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
#: More than any way over a segment or a conversation's last inserts costs.
FAR = 1 << 40
ROLE = {USER: "user", ASSISTANT: "assistant"}

_SPACE, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
_ROW_EDITS = re.compile("I*[DKR]")


# -- the search

def _bounds(rows: list[tuple], goal: int | None) -> tuple[list[int], list[list[int]]]:
    """The heuristic: forced cost from each row on, and the cost of neighbours for each row and state."""
    n = len(rows)
    forced = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        must, cut, _ = rows[i]
        forced[i] = forced[i + 1] + (DELETE if must else TRUNCATED if cut else 0)
    # Over the rows that may stay, from the right: the most disjoint pairs, with and without the first row.
    pairs = [[0] * 4 for _ in range(n + 1)]
    pairs[n] = [0, 1, 1, 0] if goal is None else [0 if s == goal else FAR for s in STATES]
    best, rest, keep = 0, 0, None  # pairs from the next such row on, and from the one after it
    for i in range(n - 1, -1, -1):
        must, _, initial = rows[i]
        if not must:
            moves = KEEP.get(initial, NEVER)
            if moves is NEVER:
                own = 1 + best
            else:
                state = next(s for s in moves if s is not None)
                clash = keep[state] is None if keep is not None else state != (ASSISTANT if goal is None else goal)
                own = max(best, 1 + rest) if clash else best
            best, rest, keep = own, best, moves
        for state in STATES:
            pairs[i][state] = (max(best, 1 + rest) if keep[state] is None else best) if keep is not None else pairs[n][state]
    return forced, pairs


def search(rows: list[tuple], entry: int = START, goal: int | None = None) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest, then ASCII-least way from ``entry`` over all rows.

    A row is (must go, is truncated, initial).  Without a goal the way must end accepted;
    with one, in that state and with the last row's own edit.
    """
    n = len(rows)
    forced, pairs = _bounds(rows, goal)
    if goal is not None and n == 0:
        return (0, "") if entry == goal else None
    path: list[str] = []

    def visit(i: int, state: int, left: int) -> int:
        """0 if some way from here costs at most ``left`` (the first is in ``path``), else by how much the least exceeds it."""
        place = i * 4 + state
        least = max(forced[i] + 2 * pairs[i][state], failed.get(place, 0))
        if least > left:
            return least - left
        if i == n and (state in (START, ASSISTANT) if goal is None else state == goal):
            return 0
        over = FAR
        must, cut, initial = rows[i] if i < n else (True, False, "")
        extra = TRUNCATED if cut else 0
        keep = None if must else KEEP.get(initial, NEVER)[state]
        for edit, may, at, to, cost in (("D", i < n, i + 1, state, DELETE), ("I", i < n or goal is None, i, NEXT[state], INSERT),
                                        ("K", keep is not None, i + 1, keep, extra), ("R", not must, i + 1, NEXT[state], REROLE + extra)):
            if may:
                path.append(edit)
                more = visit(at, to, left - cost)
                if not more:
                    return 0
                path.pop()
                over = min(over, more)
        failed[place] = left + over
        return over

    failed: dict[int, int] = {}
    bound = 0
    while bound <= DELETE * n + 8:  # no way that exists costs more: all rows go, and some inserts
        over = visit(0, entry, bound)
        if not over:
            return bound, "".join(path)
        bound += over
    return None


class Summed:
    """Best ways of consecutive segments from each entry state to each exit: costs, order of strings, way back."""

    def __init__(self, entries=STATES):
        self.cost = {e: {e: 0} for e in entries}
        self.rank = {e: {e: 0} for e in entries}
        self.back: list[dict] = []

    def add(self, cost: dict, rank: dict) -> None:
        """Go on by a step whose ``cost`` and ``rank`` of strings are given as {from: {to: n}}."""
        step = {}
        for e, reached in self.cost.items():
            new = {}
            for via, c in reached.items():
                for to, d in cost[via].items():
                    key = (c + d, self.rank[e][via])
                    if to not in new or key < new[to][0]:
                        new[to] = (key, via)
            order = sorted(new, key=lambda to: (self.rank[e][new[to][1]], rank[new[to][1]][to]))
            step[e] = {to: via for to, (_, via) in new.items()}
            self.cost[e] = {to: key[0] for to, (key, _) in new.items()}
            self.rank[e] = {to: r for r, to in enumerate(order)}
        self.back.append(step)

    def accepted(self, entry: int = START) -> int:
        """The exit of the cheapest, then least way that may end (with its tail)."""
        cost, rank = self.cost[entry], self.rank[entry]
        return min(cost, key=lambda to: (cost[to] + INSERT * len(TAIL[to]), rank[to]))

    def ways(self, entry: int, to: int) -> list[tuple[int, int]]:
        """(from, to) of each step of the best way."""
        out = []
        for step in reversed(self.back):
            via = step[entry][to]
            out.append((via, to))
            to = via
        return out[::-1]


def _solve(rows: list[tuple], closed: bool) -> tuple[list[list[str]], Summed | None]:
    """Edits of each row: one string if the conversation is whole, else one for each entry and exit."""
    if closed and len(rows) <= SEGMENT:
        return [[x] for x in _by_row(search(rows)[1], len(rows))], None
    entries = [START] if closed else STATES
    found, total = [], Summed(entries)
    for at in range(0, len(rows), SEGMENT):
        part = rows[at : at + SEGMENT]
        held = {e: {x: w for x in STATES if _reaches(e, x) and (w := search(part, e, x)) is not None} for e in STATES}
        total.add({e: {x: w[0] for x, w in to.items()} for e, to in held.items()},
                  {e: {x: r for r, x in enumerate(sorted(to, key=lambda x: to[x][1]))} for e, to in held.items()})
        found.append((len(part), held))

    def edits(entry: int, to: int) -> list[str]:
        out = []
        for (n, held), (a, b) in zip(found, total.ways(entry, to)):
            out += _by_row(held[a][b][1], n)
        return out

    if closed:
        to = total.accepted()
        out = edits(START, to)
        out[-1] += TAIL[to]
        return [[x] for x in out], None
    every = [edits(e, x) if x in total.cost[e] else [None] * len(rows) for e in STATES for x in STATES]
    return [list(x) for x in zip(*every)], total


def _reaches(entry: int, to: int) -> bool:
    return to >= entry if entry <= SYSTEM else to >= USER


def _by_row(edits: str, n: int) -> list[str]:
    out = _ROW_EDITS.findall(edits)
    if out:
        out[-1] += edits[sum(map(len, out)) :]
    return out


# -- runs of conversations in range partitions

_FOUND = "conv_id long, at long, fault string, edits array<string>, run long, cost array<int>, rank array<int>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slim rows in order -> edits of each row; parts of conversations at a task's ends stay open."""
    schema = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("fault", pa.string()), ("edits", pa.list_(pa.string())),
                        ("run", pa.int64()), ("cost", pa.list_(pa.int32())), ("rank", pa.list_(pa.int32()))])
    held: list[tuple] = []  # (at, fault, initial) of one conversation; fault None: dropped
    conv, first = None, True

    def solved(closed: bool) -> list[tuple]:
        live = [(fault in ("blank", "duplicate"), fault == "truncated", initial) for _, fault, initial in held if fault is not None]
        edits, total = _solve(live, closed) if live else ([], None if closed else Summed())
        edits = iter(edits)
        rows = [[conv, at, fault, next(edits) if fault is not None else [""] * (1 if closed else 16), held[0][0], None, None] for at, fault, _ in held]
        if not closed:
            rows[-1][5:] = [[table[e].get(x) for e in STATES for x in STATES] for table in (total.cost, total.rank)]
        return rows

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        out = []
        for c, *row in zip(*(x.to_pylist() for x in batch.columns)):
            if held and c != conv:
                out += solved(not first)
                held, first = [], False
            conv = c
            held.append(tuple(row))
        if out:
            yield batch_of(out)
    if held:
        yield batch_of(solved(False))


def _join_runs(table: pa.Table) -> pa.Table:
    """Open runs of one conversation -> the way (index of its sixteen) each goes, and the inserts at the end."""
    rows = sorted(zip(table["run"].to_pylist(), table["at"].to_pylist(), table["cost"].to_pylist(), table["rank"].to_pylist()))
    total = Summed([START])
    for _, _, *tables in rows:
        total.add(*({e: {x: t[4 * e + x] for x in STATES if t[4 * e + x] is not None} for e in STATES} for t in tables))
    to = total.accepted()
    ways = [4 * a + b for a, b in total.ways(START, to)]
    return pa.table({"run": pa.array([r[0] for r in rows], pa.int64()), "way": pa.array(ways, pa.int32()),
                     "end": pa.array([None] * (len(rows) - 1) + [rows[-1][1]], pa.int64()),
                     "tail": pa.array([TAIL[to]] * len(rows), pa.string())})


def _faults(rows: DataFrame, stages: Stages) -> DataFrame:
    """(conv_id, at, fault, edits): what each stored row takes."""
    slim = rows.select("conv_id", "at", "dropped", "blank", "cut", F.substring("role", 1, 1).alias("initial"), "digest")
    firsts = slim.where("NOT dropped AND NOT blank").groupBy(F.col("digest").alias("d")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    known = slim.join(firsts.where("n > 1"), F.col("digest") == F.col("d"), "left")
    fault = (F.when(F.col("dropped"), None).when(F.col("blank"), "blank").when(F.col("at") > F.col("first"), "duplicate")
             .when(F.col("cut"), "truncated").otherwise(""))
    tasks = int(stages.spark.conf.get("spark.sql.shuffle.partitions"))  # named, so not merged by size: the search costs more than these bytes say
    ordered = known.select("conv_id", "at", fault.alias("fault"), "initial").repartitionByRange(tasks, "at").sortWithinPartitions("at")
    found = stages.save(ordered.mapInArrow(_runs, _FOUND), "edits")
    open_runs = found.where("cost IS NOT NULL")
    ways = open_runs.groupBy("conv_id").applyInArrow(_join_runs, "run long, way int, end long, tail string")
    ways = stages.save(ways, "ways")  # at most two rows a task of the search
    joined = found.join(small(ways.withColumnRenamed("run", "r")), F.col("run") == F.col("r"), "left")
    edits = F.element_at("edits", F.coalesce("way", F.lit(0)) + 1)
    return joined.select("conv_id", "at", "fault", F.concat(edits, F.when(F.col("at") == F.col("end"), F.col("tail")).otherwise("")).alias("edits"))


def stored(conversations: DataFrame, stages: Stages) -> DataFrame:
    """The rows of a conversation table (``dropped`` marks those that only name their conversation), numbered in order."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), "dropped")
    rows = rows.withColumns({
        "blank": ~F.col("text").rlike(_WORD), "cut": ~F.col("text").rlike(r"[.!?]" + _SPACE + r"*\z"),
        "digest": F.when(F.col("dropped"), None).otherwise(F.md5(F.concat(
            F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.char_length("role").cast("string"), F.lit(":"), "role", "text")))})
    key = F.substring("role", 1, 8)  # what range bounds are sampled from stays short
    ordered = rows.repartitionByRange("conv_id", "turn", key).sortWithinPartitions("conv_id", "turn", key, "role", "text")
    return stages.save(ordered.withColumn("at", F.monotonically_increasing_id()), "rows")


def _merge(rows: DataFrame, found: DataFrame, by: str) -> DataFrame:
    """Each row beside its edits: both sorted by place in partitions ``by`` conversation or range of places."""
    both = rows.select("conv_id", "at", F.lit(0).alias("side"), "turn", "role", "text").unionByName(
        found.withColumn("side", F.lit(1)), allowMissingColumns=True)
    both = both.repartition("conv_id") if by == "conv_id" else both.repartitionByRange("at")
    return both.sortWithinPartitions(*([by, "at", "side"] if by == "conv_id" else ["at", "side"]))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(conv, turn, role, text, fault, edits) of each row, a batch at a time."""
    kept = None
    for batch in batches:
        out = []
        for conv, _, side, turn, role, text, fault, edits in zip(*(c.to_pylist() for c in batch.columns)):
            if side == 0:
                kept = (conv, turn, role, text)
            else:
                out.append((*kept, fault, edits))
        yield out


def repaired_rows(role: str, text: str, edits: str, state: int) -> tuple[list[tuple[str, str, str]], int]:
    """What one row becomes, (edit, role, text) each, and the state after it."""
    out = []
    for e in edits:
        if e == "I":
            state = NEXT[state]
            out.append(("insert", ROLE[state], ""))
        elif e == "K":
            state = KEEP[role[:1]][state]
            out.append(("keep", role, text))
        elif e == "R":
            state = NEXT[state]
            out.append(("rerole", ROLE[state], text))
    return out, state


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, turn, fault, edits, role, text): every row with its fault and its edits (``I*`` and
    one of ``DKR``, and ``I*`` at the end of a conversation).  ``at`` is the order; the role an R or I gives is
    the one the grammar asks for next (``repaired_rows``)."""
    stages = Stages(conversations.sparkSession, "conversation_repair")
    rows = stored(conversations.select("conv_id", "turn", "role", "text", F.lit(False).alias("dropped")), stages)

    def run(batches):
        for out in _pairs(batches):
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.string()] * 4)],
                                             names=["conv_id", "turn", "role", "text", "fault", "edits"])

    return _merge(rows, _faults(rows, stages), "at").mapInArrow(run, "conv_id long, turn long, role string, text string, fault string, edits string")


# -- the registered query

def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20; a dropped row stays as a marker of its conversation."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    way: Column = F.crc32(key) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), way.alias("way"))
    text = F.when(F.col("way").isin(0, 1), F.lit("")).when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("way") == 0, F.lit("")).when(F.col("way") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("way") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("way") == 0).alias("dropped"), copies.alias("copy")).drop("copy")


class _Conversation:
    def __init__(self, conv):
        self.conv, self.turns, self.count = conv, (None, None, 0), {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.last, self.cost, self.audit, self.state = 0, None, 0, [], START
        self.hash, self.rows, self.turn = hashlib.sha256(), 0, None

    def take(self, turn, role, text, fault, edits):
        if fault is not None:
            if turn is not None:
                low, _, n = self.turns
                self.turns = (turn if low is None else low, turn, n + (turn != self.turn))  # rows go by turn
                self.turn = turn
            if fault:
                self.count[fault] += 1
            if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.last = role[:1]
        self.audit.append(edits)
        self.cost += sum({"I": INSERT, "R": REROLE, "D": DELETE, "K": 0}[e] for e in edits)
        self.cost += TRUNCATED * (fault == "truncated" and "D" not in edits)
        rows, self.state = repaired_rows(role, text, edits, self.state)
        for _, role, text in rows:
            self.hash.update(("\n" * (self.rows > 0) + f"{role}:{text}").encode())
            self.rows += 1

    def row(self):
        low, high, n = self.turns
        gaps = 0 if low is None else min(high - low + 1 - n, 2**63 - 1)
        return (self.conv, gaps, *self.count.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


_DIGEST = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    names = [x.split()[0] for x in _DIGEST.split(", ")]

    def batch_of(rows):
        columns = list(zip(*rows)) or [()] * 9
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 7 + [pa.string()] * 2)], names=names)

    for rows in _pairs(batches):
        out = []
        for conv, *row in rows:
            if now is None or now.conv != conv:
                if now is not None:
                    out.append(now.row())
                now = _Conversation(conv)
            now.take(*row)
        yield batch_of(out)
    if now is not None:
        yield batch_of([now.row()])


def digest(conversations: DataFrame) -> DataFrame:
    """One row a conversation.  Its hash needs the text in order, so its rows stream through one task, one at a time."""
    stages = Stages(conversations.sparkSession, "conversation_repair")
    rows = stored(damage(conversations), stages)
    return _merge(rows, _faults(rows, stages), "conv_id").mapInArrow(_digest, _DIGEST)
