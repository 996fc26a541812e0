r"""Chat formatting: final messages folded from an event log, rendered with a loss mask.

Method: event sourcing.  The log has one row an event: ``conv_id``, ``turn`` (place of the
message), ``message`` (parts messages of one turn, in their order), ``seq`` (order of the log),
``kind``, ``role``, ``text``:

* ``open``: the message begins, with its role (a message that is never opened is not there);
* ``delta``: text streamed onto the end of the message;
* ``edit``: the message says this text instead of all it said before;
* ``regenerate``: the message starts over empty, and whatever the log held until then of
  later turns is dropped (the branch that followed the old answer).

The log is partitioned by conversation and block of ``BLOCK`` turns, sorted by turn, message
and sequence, and folded in one pass that holds one message at a time.  What a block must
know of the turns before it, the latest regeneration there, reaches it as a marker row made
by a two-step running maximum over slim rows; so a conversation that holds a third of the
log is many blocks in many tasks.

A message renders as ``### Role: text</turn>`` and a line end.  In texts ``#``, ``<`` and ``\`` are
each followed by a ``\``, so no control string is left inside one and reading back is exact;
roles other than the three known ones are ``=`` and their Base64.  Output: rows ``conv_id``,
``block``, ``part``, ``formatted``, ``loss``; a conversation's text is its rows' ``formatted`` in order of
block and part, each of at most about ``PART_CHARS`` unless one message is longer; ``loss`` has
the (start, length) of each assistant text in ``formatted``, in code points.

Defined cases: null text and null role are empty; a null conversation is one of its own;
a null turn is before all others; equal events of one sequence number count each (a log with
repeated delivery is to be made distinct first); messages of one turn follow their ``message``;
an unknown kind changes nothing; an empty log gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bronzegate.llm.common import Stages

BLOCK = 64
#: Blocks of one step of the running maximum.
SUPER = 4096
PART_CHARS = 1 << 20
KNOWN = {"system": "System", "user": "User", "assistant": "Assistant"}
NAMES = {shown: role for role, shown in KNOWN.items()}
BEGIN, END = "### ", "</turn>\n"
_CONTROL, _ESCAPED, _HEAD = re.compile(r"([#<\\])"), re.compile(r"([#<\\])\\"), re.compile(r"### ([^:]*): ")

EVENTS = "conv_id long, turn long, message long, seq decimal(38,0), kind string, role string, text string"
PARTS = "conv_id long, block long, part long, formatted string, loss array<struct<start:long,length:long>>"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def head(role: str) -> str:
    return BEGIN + (KNOWN.get(role) or "=" + base64.b64encode(role.encode()).decode()) + ": "


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a rendered text."""
    at = 0
    while at < len(formatted):
        begin = _HEAD.match(formatted, at)
        end = formatted.index(END, begin.end())
        shown = begin[1]
        yield NAMES.get(shown) or base64.b64decode(shown[1:]).decode(), unescape(formatted[begin.end() : end])
        at = end + len(END)


class _Message:
    """One message while its events pass by in order of the log."""

    def __init__(self):
        self.role, self.opened, self.pieces = "", False, []

    def take(self, kind: str, role: str | None, text: str | None) -> None:
        if kind == "open":
            self.role, self.opened = role or "", True
        elif kind == "delta":
            self.pieces.append(text or "")
        elif kind == "edit":
            self.pieces = [text or ""]
        elif kind == "regenerate":
            self.pieces = []


class _Part:
    def __init__(self):
        self.pieces, self.loss, self.length = [], [], 0

    def add(self, m: _Message) -> None:
        begin, text = head(m.role), escape("".join(m.pieces))
        if m.role == "assistant":
            self.loss.append({"start": self.length + len(begin), "length": len(text)})
        self.pieces += [begin, text, END]
        self.length += len(begin) + len(text) + len(END)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, block, marker first, turn, message, sequence -> rendered parts."""
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()),
                        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))])
    block = turn = key = message = None
    cut = latest = None  # the latest regeneration of the turns before, and with those of this turn
    part, number, out = _Part(), 0, []

    def close_message():
        if message is not None and message.opened:
            part.add(message)

    def close_part():
        nonlocal part, number
        if part.pieces:
            out.append((*block, number, "".join(part.pieces), part.loss))
            part, number = _Part(), number + 1

    for batch in batches:
        columns = (c.to_pylist() for c in batch.columns)
        for conv, at, marker, t, name, seq, kind, role, text in zip(*columns):
            if (conv, at) != block:
                close_message()
                close_part()
                block, number, turn, key, message, cut, latest = (conv, at), 0, None, None, None, None, None
            if not marker:
                cut = latest = seq
                continue
            if (t, name) != key:
                close_message()
                if part.length >= PART_CHARS:
                    close_part()
                if t != turn or key is None:
                    turn, cut = t, latest
                key, message = (t, name), _Message()
            if cut is not None and (seq is None or seq < cut):
                continue
            message.take(kind, role, text)
            if kind == "regenerate" and seq is not None and (latest is None or seq > latest):
                latest = seq
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
            out = []
    close_message()
    close_part()
    if out:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)


def _cuts(log: DataFrame) -> DataFrame:
    """(conv_id, block, seq): the latest regeneration in earlier blocks, where there is one."""
    held = log.groupBy("conv_id", "block").agg(F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("own"))
    held = held.withColumn("super", F.expr(f"block div {SUPER}"))
    before = F.max("own").over(Window.partitionBy("conv_id", "super").orderBy(F.asc_nulls_first("block")).rowsBetween(Window.unboundedPreceding, -1))
    tops = held.groupBy("conv_id", "super").agg(F.max("own").alias("own")).select(
        F.col("conv_id").alias("c"), F.col("super").alias("s"),
        F.max("own").over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("super")).rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    both = held.withColumn("before", before).join(tops, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("super").eqNullSafe(F.col("s")))
    return both.select("conv_id", "block", F.greatest("before", "earlier").alias("seq")).where("seq IS NOT NULL")


def format_chats(events: DataFrame) -> DataFrame:
    """``PARTS`` rows of a log of ``EVENTS`` rows."""
    log = events.select("conv_id", F.expr(f"turn div {BLOCK}").alias("block"), F.lit(True).alias("is_event"), "turn", "message",
                        F.col("seq").cast("decimal(38,0)").alias("seq"), "kind", "role", "text")
    markers = _cuts(log).withColumn("is_event", F.lit(False))
    rows = log.unionByName(markers, allowMissingColumns=True).repartition("conv_id", "block")
    return rows.sortWithinPartitions("conv_id", "block", "is_event", "turn", "message", "seq").mapInArrow(_fold, PARTS)


def read_back(parts: DataFrame) -> DataFrame:
    """(conv_id, block, part, place, role, text): the messages that the rendered parts say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(i).to_pylist() for i in range(3)]
            rows = [(*at, k, *said) for *at, whole in zip(*ids, batch.column(3).to_pylist()) for k, said in enumerate(parse(whole))]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()] * 2)],
                                             names=["conv_id", "block", "part", "place", "role", "text"])

    return parts.select("conv_id", "block", "part", "formatted").mapInArrow(
        run, "conv_id long, block long, part long, place long, role string, text string")


def event_log(conversations: DataFrame) -> DataFrame:
    """A log that ends in these messages (conv_id, turn, role, text), made of the table itself.

    Each text is streamed in up to eight deltas; by a hash of the row some messages are first
    drafted and regenerated, some are edited, and some drafts had a next turn that the
    regeneration drops.  Messages of one turn are in order of role and text.
    """
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("message", F.row_number().over(order).cast("long"))
    rows = rows.withColumn("way", F.pmod(F.xxhash64("conv_id", "turn", "message"), F.lit(8)))
    size = F.greatest(F.ceil(F.char_length("text") / 8), F.lit(1)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(F.col("text"), i * size + 1, size))
    role, none = F.col("role"), F.lit(None).cast("string")

    def event(kind, text=none, turn=F.col("turn"), role=none):
        return F.struct(turn.alias("turn"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    deltas = F.transform(F.filter(pieces, lambda p: p != ""), lambda p: event("delta", p))
    draft = event("delta", F.concat(F.lit("Draft: "), F.substring("text", 1, 40)))
    after = F.when(F.col("turn") < F.lit(2**63 - 1), F.col("turn") + 1)
    lost = F.when(after.isNotNull(), F.array(event("open", turn=after, role=F.lit("user")), event("delta", F.lit("lost"), after))).otherwise(
        F.expr("array()").cast("array<struct<turn:bigint,kind:string,role:string,text:string>>"))
    opened = F.array(event("open", role=role))
    events = (F.when(F.col("way") == 1, F.concat(opened, F.array(draft, event("regenerate")), deltas))
              .when(F.col("way") == 2, F.concat(opened, F.array(draft, event("edit", F.col("text")))))
              .when(F.col("way") == 3, F.concat(opened, F.array(draft), lost, F.array(event("regenerate")), deltas))
              .otherwise(F.concat(opened, deltas)))
    log = rows.select("conv_id", F.col("turn").alias("at"), "message", F.posexplode(events).alias("step", "e"))
    seq = F.coalesce("at", F.lit(-(2**63))).cast("decimal(19,0)") * F.lit(64).cast("decimal(3,0)") + F.col("step")
    place = F.when(F.col("e.turn").eqNullSafe(F.col("at")), F.col("message")).otherwise(-F.col("message"))
    return log.select("conv_id", F.col("e.turn").alias("turn"), place.alias("message"), seq.cast("decimal(38,0)").alias("seq"),
                      F.col("e.kind").alias("kind"), F.col("e.role").alias("role"), F.col("e.text").alias("text"))


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts sorted by conversation, block and part -> one row a conversation, hashed as it streams by."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    now = None

    def row():
        conv, n, turns, chars, loss, formatted = now
        return dict(zip(names, (conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted)))

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    for batch in batches:
        out = []
        for conv, whole, spans in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
            if now is None or now[0] != conv:
                if now is not None:
                    out.append(row())
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(whole):
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
            for s in spans:
                said = unescape(whole[s["start"] : s["start"] + s["length"]])
                now[3] += len(said)
                now[4].update(said.encode())
            now[5] += len(whole)
        yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([row()], schema)


def digest(conversations: DataFrame) -> DataFrame:
    """The table's messages and conversation -7, through their log and the rendered parts.

    A conversation's hashes need its text in order, so its parts stream through one task,
    which holds one part at a time.
    """
    spark: SparkSession = conversations.sparkSession
    trap = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], "conv_id long, turn long, role string, text string")
    log = event_log(conversations.select("conv_id", "turn", "role", "text").unionByName(added))
    parts = Stages(spark, "chat_format").save(format_chats(log), "parts")
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part")
    return ordered.mapInArrow(_summary, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
