"""Quote state of delimited text, the same at every file and split size.

A quote opens a quoted field only where a field begins (at the start of a record or
after a separator); anywhere else outside it is text.  Inside, two quotes are one quote of
text, one quote closes, and what follows up to the separator is text again.  A line break
inside belongs to the field.

So a line is a function on the state it begins in (outside or inside a quoted field) to the
state it ends in, one of four: keep, flip, end inside, end outside.  These compose, and
composition is associative: the state before a line is that of the last line before it
that does not depend on its own beginning, turned by the flips since.  ``states`` computes it with
running aggregates within a split, then over the splits of each file (one row a split), so
no group is larger than one split and a file of any size gives the same records.

``fields`` takes one record apart by the same rules.  Text is read with line feeds as the only
line ends; a carriage return before one is part of the line end of a record and text inside
a quoted field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import SCRATCH, dropped_shuffles, together

# What a field is at while its line is read.
_TEXT, _INSIDE, _CLOSING, _BEGINS = 0, 1, 2, 3
_BLANK = r"^[\x00-\x20]*$"


def read_lines(spark: SparkSession, paths: list[str], glob: str | None = None, names=None) -> DataFrame:
    """FILE_NAME, blk (byte offset of the split), mid (order of lines), value.

    ``names`` (file name column -> condition) leaves files out before any is opened.
    """
    reader = spark.read.format("text").option("lineSep", "\n")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(paths)
    if names is not None:
        files = files.where(names(F.col("_metadata.file_name")))
    return together(files.select(
        F.col("_metadata.file_name").alias("FILE_NAME"), F.col("_metadata.file_block_start").alias("blk"),
        F.monotonically_increasing_id().alias("mid"), "value"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once and written once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(text: Column, sep: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit("")))


def _after(state: Column, seg: Column, sep: str) -> Column:
    """State once a quote and the quote-free text after it were read."""
    text = F.when(F.endswith(seg, F.lit(sep)), _BEGINS).otherwise(_TEXT)
    return (F.when((state == _BEGINS) | (state == _CLOSING), F.lit(_INSIDE))
            .when((state == _INSIDE) & (seg == ""), F.lit(_CLOSING))
            .otherwise(text))


def _begin(first: Column, sep: str) -> Column:
    return F.when((first == "") | F.endswith(first, F.lit(sep)), _BEGINS).otherwise(_TEXT)


def is_blank(line: Column) -> Column:
    """No character above a space; the pattern is tried only on lines that begin with none."""
    return (F.ascii(line) <= 32) & line.rlike(_BLANK)


def with_effects(lines: DataFrame, sep: str = S.SEPARATOR) -> DataFrame:
    """Adds what a line does: ``out_in`` / ``in_in`` (ends inside when it begins outside / inside),
    ``out_seps`` / ``in_seps`` (separators that part fields in either case) and ``blank``."""
    v = F.col("value")
    parts = F.split(v, '"', -1)
    rest = F.slice(parts, 2, F.size(parts))

    def run(state: Column, seps: Column) -> Column:
        start = F.struct(state.cast("int").alias("state"), seps.cast("int").alias("seps"))

        def step(acc: Column, seg: Column) -> Column:
            return _let(_after(acc["state"], seg, sep), lambda to: F.struct(
                to.cast("int").alias("state"), (acc["seps"] + F.when(to != _INSIDE, _count(seg, sep)).otherwise(0)).cast("int").alias("seps")))

        return F.aggregate(rest, start, step)

    quoted = F.contains(v, F.lit('"'))
    first = F.get(parts, 0)
    out = F.when(quoted, run(_begin(first, sep), _count(first, sep))).otherwise(
        F.struct(F.lit(_TEXT).alias("state"), _count(v, sep).cast("int").alias("seps")))
    into = F.when(quoted, run(F.lit(_INSIDE), F.lit(0))).otherwise(F.struct(F.lit(_INSIDE).alias("state"), F.lit(0).alias("seps")))
    return lines.withColumns({"_out": out, "_into": into}).select(
        *lines.columns, (F.col("_out.state") == _INSIDE).alias("out_in"), (F.col("_into.state") == _INSIDE).alias("in_in"),
        F.col("_out.seps").alias("out_seps"), F.col("_into.seps").alias("in_seps"), is_blank(v).alias("blank"))


def _before(by: list[str], order: str, ends_out: Column, ends_in: Column):
    """State at each row for either beginning of its group, from the rows before it.

    Returns a function of the beginning state (0 outside, 1 inside) -> Column, and the
    columns it needs to be added first, in two steps.
    """
    w = Window.partitionBy(*by).orderBy(order)
    upto, earlier = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    flip = (ends_out & ~ends_in).cast("long")
    forced = F.when(ends_out == ends_in, ends_out.cast("int"))
    first = {"_flips": F.sum(flip).over(upto), "_flip": flip, "_forced": forced}
    second = {"_last": F.max(F.when(F.col("_forced").isNotNull(), F.struct(order, "_forced", "_flips"))).over(earlier)}

    def state(begin: int) -> Column:
        turned = F.col("_flips") - F.col("_flip") - F.coalesce(F.col("_last._flips"), F.lit(0))
        return F.pmod(F.coalesce(F.col("_last._forced"), F.lit(begin)) + turned, F.lit(2)).cast("int")

    return state, first, second


def _per_line(effects: DataFrame, parts: int | None = None) -> DataFrame:
    """Lines with what holds for either beginning of their split: state, separators, end, and the last line so far that begins a record.

    All of it comes from windows over one order of the lines, so they are dealt and sorted once. The splits are dealt to
    ``parts`` groups where given, so a group's size need not grow with the input.
    """
    split = ["FILE_NAME", "blk"]
    if parts is not None:
        effects = effects.repartition(parts, *split)
    at, first, second = _before(split, "mid", F.col("out_in"), F.col("in_in"))
    rows = effects.withColumns(first).withColumns(second).withColumns({"s0": at(0), "s1": at(1)})
    upto = Window.partitionBy(*split).orderBy("mid").rowsBetween(Window.unboundedPreceding, 0)
    starts = {f"m{i}": F.max(F.when(F.col(f"s{i}") == 0, F.col("mid"))).over(upto) for i in (0, 1)}
    kept = [F.when(F.col(f"s{i}") == 0, F.col(f"out_{what}")).otherwise(F.col(f"in_{what}")).alias(f"{name}{i}")
            for i in (0, 1) for what, name in (("in", "e"), ("seps", "n"))]
    return rows.withColumns(starts).select(*split, "mid", "value", "blank", "s0", "s1", "m0", "m1", *kept)


def store_lines(effects: DataFrame, path: str, parts: int | None = None) -> DataFrame:
    """The lines as ``placed`` takes them, written to ``path`` and read back, small splits together."""
    rows = _per_line(effects, parts)
    with dropped_shuffles(effects.sparkSession):
        rows.write.options(**SCRATCH).parquet(path)
    return together(effects.sparkSession.read.schema(rows.schema).parquet(path))


def split_states(rows: DataFrame) -> DataFrame:
    """(FILE_NAME, blk, begins, carried, unclosed): one row a split, from lines of ``_per_line``."""
    split = ["FILE_NAME", "blk"]
    per_split = rows.groupBy(*split).agg(
        F.max(F.struct("mid", "e0", "e1")).alias("end"), F.max("m0").alias("start0"), F.max("m1").alias("start1"))
    at, first, second = _before(["FILE_NAME"], "blk", F.col("end.e0"), F.col("end.e1"))
    per_split = per_split.withColumns(first).withColumns(second).withColumn("begins", at(0))
    own = F.when(F.col("begins") == 0, F.col("start0")).otherwise(F.col("start1"))
    earlier = Window.partitionBy("FILE_NAME").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.max(F.when(own.isNotNull(), F.struct(F.col("blk").alias("b"), own.alias("m")))).over(earlier)
    return per_split.select(*split, "begins", carried.alias("carried"),
                            F.when(F.col("begins") == 0, F.col("end.e0")).otherwise(F.col("end.e1")).alias("unclosed"))


def placed(rows: DataFrame, per_split: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``states`` from lines of ``_per_line``, and their ``split_states`` where the caller has them."""
    split = ["FILE_NAME", "blk"]
    per_split = split_states(rows) if per_split is None else per_split
    files = per_split.groupBy("FILE_NAME").agg(F.max(F.struct("blk", "unclosed")).alias("end")).select("FILE_NAME", F.col("end.unclosed").alias("unclosed"))

    def of(name: str) -> Column:
        return F.when(F.col("begins") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    return rows.join(per_split.drop("unclosed"), split).select(
        *split, "mid", "value", of("s").alias("state"), of("e").alias("ends"), of("n").alias("seps"), "blank",
        F.when(of("m").isNotNull(), F.col("blk")).otherwise(F.col("carried.b")).alias("rec_blk"),
        F.coalesce(of("m"), F.col("carried.m")).alias("rec_mid")), files


def states(effects: DataFrame, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines with the state they begin in and the record they belong to, and per file how it ends.

    (FILE_NAME, blk, mid, value, state, ends, seps, blank, rec_blk, rec_mid); (FILE_NAME, unclosed).
    """
    return placed(_per_line(effects, parts))


def records(placed: DataFrame) -> DataFrame:
    """(FILE_NAME, rec_blk, rec_mid, value): whole records; only those of several lines are regrouped."""
    key = ["FILE_NAME", "rec_blk", "rec_mid"]
    alone = (F.col("state") == 0) & ~F.col("ends")
    whole = placed.where(alone & ~F.col("blank")).select(*key, "value")
    several = placed.where(~alone).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("blk", "mid", "value"))).alias("lines"))
    return whole.unionByName(several.select(*key, F.array_join("lines.value", "\n").alias("value")))


def fields(record: Column, sep: str = S.SEPARATOR) -> Column:
    """The fields of one record, quotes resolved."""
    import re

    cut = re.escape(sep)
    text = F.when(F.endswith(record, F.lit("\r")), F.substring(record, F.lit(1), F.length(record) - 1)).otherwise(record)

    def named(state: Column, done: Column, now: Column) -> Column:
        return F.struct(state.cast("int").alias("state"), done.alias("done"), now.alias("now"))

    def add(state: Column, done: Column, now: Column, more: Column) -> Column:
        """Outside text after what the field already holds: it may end this field and others."""
        return _let(F.split(more, cut, -1), lambda p: F.when(F.size(p) == 1, named(state, done, F.concat(now, more))).otherwise(
            named(state, F.concat(done, F.array(F.concat(now, F.get(p, 0))), F.slice(p, 2, F.greatest(F.size(p) - 2, F.lit(0)))), F.element_at(p, -1))))

    def step(acc: Column, seg: Column) -> Column:
        at, done, now = acc["state"], acc["done"], acc["now"]
        quote = F.when((at == _TEXT) | (at == _CLOSING), F.lit('"')).otherwise(F.lit(""))
        return _let(_after(at, seg, sep), lambda to: F.when(to == _INSIDE, named(to, done, F.concat(now, quote, seg))).otherwise(
            add(to, done, now, F.when(at == _TEXT, F.concat(F.lit('"'), seg)).otherwise(seg))))

    def fold(parts: Column) -> Column:
        start = _let(F.get(parts, 0), lambda f: add(_begin(f, sep), F.array().cast("array<string>"), F.lit(""), f))
        return F.aggregate(F.slice(parts, 2, F.size(parts)), start, step, lambda acc: F.concat(acc["done"], F.array(acc["now"])))

    # Only records with a quote take the (interpreted) fold.
    return F.when(F.contains(record, F.lit('"')), _let(F.split(text, '"', -1), fold)).otherwise(F.split(text, cut, -1))
