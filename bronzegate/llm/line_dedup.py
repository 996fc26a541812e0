"""Line dedup: lines found in several documents stay only in the first of them.

Method: explode the normalised lines, hash them, count the distinct documents
per hash, drop lines at or over the threshold, reassemble by position.  All of
it is DataFrame functions.

* Pass 1 reduces each line to a 128-bit hash, the document and its position.
* ``min`` and ``max`` of the document id per hash tell "two documents or more"
  with a partial aggregate, so a line that a third of all documents hold is one
  row per task in the shuffle.  A threshold above two takes a distinct count.
* The drop list joins back on the hash; both sides are plain exchanges, so a hot
  hash is split.  Only hashes and positions move; the text moves once, at the end.

Defined cases: null text counts as one empty line and stays null; a null id is
never dropped from, and does not count as a document; rows that share an id are
one document, each row keeps its own positions; an empty table gives an empty
result; other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzegate.llm.common import SPACE, Stages, ascii_lower

MIN_CHARS = 10
MIN_DOCUMENTS = 2


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
               out_text: str = "kept_text", out_lines: str = "n_lines",
               out_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the kept text and the line counts as three further columns."""
    spark = docs.sparkSession
    stages = Stages(spark, "line_dedup")
    whole = F.coalesce(F.col(text_col), F.lit(""))
    line = F.btrim(F.col("line"), F.lit(SPACE))
    hashed = (
        docs.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("doc"), F.xxhash64(whole).alias("row"), F.posexplode(F.split(whole, "\n")).alias("pos", "line"))
        .select("doc", "row", "pos", line.alias("line"))
        .where(F.char_length("line") >= min_chars)
        .select("doc", "row", "pos", ascii_lower(F.col("line")).alias("key"))
        .select("doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    lines = stages.save(hashed, "lines")
    if min_documents == 2:
        counted = lines.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    else:
        counted = (
            lines.select("h1", "h2", "doc").distinct().groupBy("h1", "h2")
            .agg(F.min("doc").alias("first"), F.count("*").alias("n")).where(F.col("n") >= min_documents)
        )
    repeated = stages.save(counted.select("h1", "h2", "first"), "repeated")
    dropped = stages.save(
        lines.join(repeated, ["h1", "h2"]).where("doc > first")
        .groupBy("doc", "row").agg(F.array_sort(F.collect_set("pos")).alias("gone")),
        "dropped",
    ).select(F.col("doc").alias("__ld_doc"), F.col("row").alias("__ld_row"), F.col("gone").alias("__ld_gone"))
    joined = docs.join(dropped, (F.col(id_col) == F.col("__ld_doc")) & (F.xxhash64(whole) == F.col("__ld_row")), "left")
    parts = F.split(whole, "\n")
    edges = F.concat(F.array(F.lit(-1)), F.col("__ld_gone"), F.array(F.size(parts)))
    # Slices between dropped positions: linear in the lines of the document.
    runs = F.transform(
        F.sequence(F.lit(0), F.size("__ld_gone")),
        lambda i: F.slice(parts, F.get(edges, i) + 2, F.get(edges, i + 1) - F.get(edges, i) - 1),
    )
    return joined.select(
        *[docs[c] for c in docs.columns],
        F.when(F.col("__ld_gone").isNull(), F.col(text_col)).otherwise(F.array_join(F.flatten(runs), "\n")).alias(out_text),
        F.size(parts).cast("long").alias(out_lines),
        F.when(F.col("__ld_gone").isNull(), 0).otherwise(F.size("__ld_gone")).cast("long").alias(out_dropped),
    )


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document: counts and the kept text's SHA-256."""
    bare = docs.select("doc_id", "text")
    return line_dedup(bare).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with their repeated lines gone."""
    out = line_dedup(docs, out_text="__ld_text", out_lines="__ld_lines", out_dropped="__ld_dropped")
    return out.select(*[F.col("__ld_text").alias(c) if c == "text" else F.col(c) for c in docs.columns])
