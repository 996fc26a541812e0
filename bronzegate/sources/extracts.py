"""Assessment extracts derived from the driver tables, and their rendering to raw files.

Mapping (one Scoring row per order, one Questions row per line item):

    INSTANCE       EXT when o_custkey is even, else REV
    PROVINCE       Ontario when o_custkey % 3 = 0, else Alberta
    FILE_DATE      first day of the order month
    Facility ID    the customer's nation key
    Resident ID    o_custkey
    Assessment ID  o_orderkey
    Unit           o_orderpriority, missing for every 11th order
    Rug Group      o_orderpriority, two lines (priority, status) for every 13th order
    scores         integer rules over the order keys, PAIN missing for every 17th order

Orders without line items give Scoring IDs that the Questions file lacks, so
unequal pairs appear naturally. The same derivation is written as SQL in
``EXTRACT_SQL`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import compiled_methods, dropped_shuffles, hadoop_fs, shared_dir

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _file_name(kind: str) -> Column:
    mid = "MDSAssessmentExtract" + ("Scoring" if kind == S.SCORING else "")
    return F.concat(F.col("INSTANCE"), F.lit(f"_{mid}_"), F.col("PROVINCE"), F.lit("_"),
                    F.date_format("FILE_DATE", "yyyy-MM-dd"), F.lit(".csv"))


def _order_facts(spark: SparkSession, sf_dir: str, hot_third: bool = False) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # A plain equi-join: the planner (with AQE) broadcasts the customer side
    # only when its runtime size is below the broadcast threshold.
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    # hot_third: every third order belongs to one delivery (skew fixture).
    hot = (F.col("o_orderkey") % 3 == 0) if hot_third else F.lit(False)
    return j.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
        F.when(hot | (F.col("o_custkey") % 2 == 0), F.lit("EXT")).otherwise(F.lit("REV")).alias("INSTANCE"),
        F.when(hot | (F.col("o_custkey") % 3 == 0), F.lit("Ontario")).otherwise(F.lit("Alberta")).alias("PROVINCE"),
        F.when(hot, F.lit("2024-01-01").cast("date")).otherwise(F.trunc("o_orderdate", "month")).alias("FILE_DATE"),
        F.col("c_nationkey").cast("string").alias("Facility ID"),
        F.col("o_custkey").cast("string").alias("Resident ID"),
        F.col("o_orderkey").cast("string").alias("Assessment ID"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("Unit"),
    )


def _score(i: int) -> Column:
    """Score column i (0..13): an integer rule over the order keys, as tenths
    (thousandths for the first), so the text form is exact."""
    if i == 0:
        return (F.col("o_orderkey") % F.lit(4000)).cast("double") / F.lit(1000.0)
    raw = ((F.col("o_orderkey") * F.lit(i + 3) + F.col("o_custkey")) % F.lit(1000)).cast("double")
    return raw / F.lit(10.0)


def scoring_frame(spark: SparkSession, sf_dir: str, hot_third: bool = False) -> DataFrame:
    """Scoring extract rows as text (the way they sit in a raw file) plus FILE_NAME."""
    f = _order_facts(spark, sf_dir, hot_third)
    scores = []
    for i, name in enumerate(S.SCORING_FLOAT_COLUMNS):
        v = _score(i)
        if name == "PAIN":
            v = F.when(F.col("o_orderkey") % 17 == 0, F.lit(None)).otherwise(v)
        scores.append(v.cast("string").alias(name))
    ts = lambda c: F.date_format(c, TS_FORMAT)
    return f.select(
        _file_name(S.SCORING).alias("FILE_NAME"),
        "Facility ID", "Resident ID", "Unit", "Assessment ID",
        F.col("o_orderstatus").alias("RAI-MDS Status"),
        # every 13th order has a two-line value: quoted newline in the raw file
        F.when(F.col("o_orderkey") % 13 == 0,
               F.concat(F.col("o_orderpriority"), F.lit("\n"), F.col("o_orderstatus")))
         .otherwise(F.col("o_orderpriority")).alias("Rug Group"),
        *scores,
        ts(F.col("o_orderdate")).alias("ARD"),
        ts(F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")).alias("Assessment Locked Date"),
        ts(F.col("o_orderdate")).alias("Date Assessment Created"),
        F.when(F.col("o_orderstatus") == "F", ts(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")))
         .alias("Date Assessment Revised"),
    )


def questions_frame(spark: SparkSession, sf_dir: str, hot_third: bool = False) -> DataFrame:
    """Questions extract rows as text plus FILE_NAME (one row per line item)."""
    f = _order_facts(spark, sf_dir, hot_third)
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                 "l_returnflag", "l_linestatus", "l_shipdate")
    j = li.join(f, li.l_orderkey == f.o_orderkey, "inner")
    ts = lambda c: F.date_format(c, TS_FORMAT)
    return j.select(
        _file_name(S.QUESTIONS).alias("FILE_NAME"),
        "Facility ID", "Resident ID", "Unit", "Assessment ID",
        F.col("o_orderstatus").alias("Assessment Type"),
        F.concat(F.lit("Q"), F.col("l_linenumber").cast("string")).alias("question_key"),
        F.col("l_returnflag").alias("item_value"),
        F.col("l_quantity").cast("string").alias("Answer"),
        ts(F.col("o_orderdate")).alias("ARD"),
        ts(F.col("l_shipdate")).alias("Answer_Date"),
    )


def extract_frame(spark: SparkSession, sf_dir: str, extract_type: str, hot_third: bool = False) -> DataFrame:
    if extract_type == S.QUESTIONS:
        return questions_frame(spark, sf_dir, hot_third)
    return scoring_frame(spark, sf_dir, hot_third)


def _quoted(c: Column, sep: str) -> Column:
    """A field as it sits in a delimited file: quoted (quotes doubled) when it
    holds the separator, a quote or a line break; missing -> empty."""
    needs = c.contains(sep) | c.contains('"') | c.contains("\n") | c.contains("\r")
    q = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(needs, q).otherwise(c), F.lit(""))


def long_row_rule(extract_type: str) -> Column | None:
    """Rows that get one extra field in the malformed rendering: line 1 of every
    50th order in Questions files; Scoring files stay well formed."""
    if extract_type != S.QUESTIONS:
        return None
    return (F.col("`Assessment ID`").cast("long") % 50 == 0) & (F.col("question_key") == "Q1")


def _write_csv(df: DataFrame, out: str, sep: str) -> None:
    (df.repartition("FILE_NAME").write.partitionBy("FILE_NAME")
       .option("sep", sep).option("header", True).option("quote", '"').option("escape", '"')
       .option("nullValue", "").option("emptyValue", '""').mode("overwrite").csv(out))


def _write_lines(df: DataFrame, out: str, sep: str, long_row: Column | None) -> None:
    """Hand-rendered lines (header first in every file), so rows may be malformed."""
    cols = df.columns[1:]
    line = F.concat_ws(sep, *[_quoted(F.col(f"`{c}`"), sep) for c in cols])
    if long_row is not None:
        line = F.when(long_row, F.concat(line, F.lit(sep + "extra"))).otherwise(line)
    data = df.select("FILE_NAME", F.lit(1).alias("_o"), line.alias("value"))
    header = (df.select("FILE_NAME").distinct()
              .select("FILE_NAME", F.lit(0).alias("_o"), F.lit(sep.join(cols)).alias("value")))
    (header.unionByName(data).repartition("FILE_NAME").sortWithinPartitions("FILE_NAME", "_o")
        .select("FILE_NAME", "value").write.partitionBy("FILE_NAME").mode("overwrite").text(out))


def quoted_unit() -> Column:
    """``Unit`` of the quoted rendering: stray quotes, line breaks of either kind, separators, doubled quotes."""
    key, unit = F.col("`Assessment ID`").cast("long"), F.coalesce("Unit", F.lit(""))
    return (F.when(key % 5 == 0, F.concat(F.lit('5" '), unit)).when(key % 5 == 1, F.concat(unit, F.lit("\r\nover\nlines")))
            .when(key % 5 == 2, F.concat(unit, F.lit('|"'), unit)).otherwise(unit))


def render_quoted(spark: SparkSession, sf_dir: str, raw_dir: str | None = None, sep: str = S.SEPARATOR) -> str:
    """Questions files that need every quote rule, with two header orders and two kinds of line end.

    Ontario files have their columns in reverse and lines ending in CR LF. A value with a quote but
    neither separator nor line break stands unquoted, so its quote is text. Returns ``raw_dir``.
    """
    raw_dir = raw_dir or shared_dir(spark, "raw-quoted")
    df = questions_frame(spark, sf_dir).withColumn("Unit", quoted_unit())
    staging = shared_dir(spark, "render")
    names = df.columns[1:]
    ontario = F.col("FILE_NAME").contains("_Ontario_")
    text = {c: F.when(F.col(f"`{c}`").startswith('5"'), F.col(f"`{c}`")).otherwise(_quoted(F.col(f"`{c}`"), sep)) for c in names}

    def line(of) -> Column:
        """A line of either kind; the CR of a CR LF is its last character."""
        return F.when(ontario, F.concat(of(names[::-1]), F.lit("\r"))).otherwise(of(names))

    part = df.where(ontario | F.col("FILE_NAME").contains("_Alberta_"))
    lines = part.select("FILE_NAME", F.lit(1).alias("_o"), line(lambda columns: F.concat_ws(sep, *[text[c] for c in columns])).alias("value"))
    head = part.select("FILE_NAME").distinct().select("FILE_NAME", F.lit(0).alias("_o"), line(lambda columns: F.lit(sep.join(columns))).alias("value"))
    with dropped_shuffles(spark):
        (head.unionByName(lines).repartition("FILE_NAME").sortWithinPartitions("FILE_NAME", "_o").select("FILE_NAME", "value")
             .write.partitionBy("FILE_NAME").text(staging))
    fs, _ = hadoop_fs(spark, staging)
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(Path(raw_dir))
    for st in fs.globStatus(Path(f"{staging}/FILE_NAME=*/part-*")):
        fs.rename(st.getPath(), Path(f"{raw_dir}/{st.getPath().getParent().getName()[len('FILE_NAME='):]}"))
    return raw_dir


def render_extracts(spark: SparkSession, sf_dir: str, raw_dir: str | None = None,
                    sep: str = S.SEPARATOR, malformed: bool = False, hot_third: bool = False) -> str:
    """Write the derived extracts as pipe-delimited raw files, one file per FILE_NAME.

    Rows of one file are written by one task (``repartition`` on FILE_NAME),
    then each part file is renamed to its extract name in ``raw_dir`` (a new
    folder under the shared checkpoint folder when not given). A Scoring file
    whose Questions file would have no rows gets a header-only Questions file,
    so every delivery is a pair. ``malformed=True`` renders the lines by hand
    and gives the rows of ``long_row_rule`` one extra field; ``hot_third=True``
    puts every third order into one delivery (a file pair holding a third of
    all rows). Returns ``raw_dir``.
    """
    raw_dir = raw_dir or shared_dir(spark, "raw")
    staging = shared_dir(spark, "render")
    for et in S.EXTRACT_TYPES:
        df = extract_frame(spark, sf_dir, et, hot_third)
        with compiled_methods(spark), dropped_shuffles(spark):
            if malformed:
                _write_lines(df, f"{staging}/{et}", sep, long_row_rule(et))
            else:
                _write_csv(df, f"{staging}/{et}", sep)
    fs, _ = hadoop_fs(spark, staging)
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(Path(raw_dir))
    written = {}
    for et in S.EXTRACT_TYPES:
        for st in fs.globStatus(Path(f"{staging}/{et}/FILE_NAME=*/part-*")):
            p = st.getPath()
            name = p.getParent().getName()[len("FILE_NAME="):]
            fs.rename(p, Path(f"{raw_dir}/{name}"))
            written[name] = et
    # Header-only Questions files for deliveries without line items.
    header = sep.join(questions_frame(spark, sf_dir).columns[1:])
    for name, et in list(written.items()):
        if et == S.SCORING:
            qname = name.replace(S.SCORING, "")
            if qname not in written:
                out = fs.create(Path(f"{raw_dir}/{qname}"), True)
                out.write(bytearray((header + "\n").encode("utf-8")))
                out.close()
    return raw_dir
