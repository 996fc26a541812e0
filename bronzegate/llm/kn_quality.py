"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

Units are characters, the order is four.  A gram of four 16-bit codes is one long, so
contexts and suffixes are shifts of it and no hash can clash.  White space runs are
one space, digits are ``0``, a word equal to the one before it is one mark, without
a space (so text that repeats words is as improbable as it should be), characters beyond 16 bits share a code.

* Training: gram counts of all trusted documents (label quality 1, not toxic), summed
  in the task before the shuffle.  Lower orders are continuation counts.  Discounts come
  from the counts of counts, three per order.
* Scoring: the distinct grams of the whole corpus are resolved from the shortest up, each once:
  the grams of an order are joined with its sharded count tables and with the resolved
  suffixes, so rows stay narrow and only the highest order is large; then the gram counts of every document are joined
  with the resolved log-probabilities (broadcast while they are few, else by shuffle),
  summed per document before the shuffle, to a perplexity per character.
* Threshold per language (null is one): the ``QUANTILE`` of its own trusted documents'
  log-perplexities times ``MARGIN``, at every number of them.  Each trusted document is
  measured by a model of the half of the trusted texts it is not in (halves by text hash),
  so the level is that of text the model has not seen: the fewer trusted documents a
  language has, the less those models know it and the wider its limit.  A document above
  its threshold is rejected.

Defined cases: null or blank text has no grams, a null perplexity and is rejected; a
language without trusted documents has no threshold (null) and keeps all others, and so
does every language when one half of the trusted texts is empty; rows with equal id
and text share a result; a null id is judged like any other; an empty table gives an empty
result; other columns pass through in the pipeline stage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzegate.llm import words as W
from bronzegate.llm.bloom import having
from bronzegate.llm.common import Stages, read, setting, small

ORDER = 4
QUANTILE = 0.99
MARGIN = 1.06
RESOLVED_ROWS = 1_000_000
#: Count tables of up to so many bytes as stored are broadcast (by the planner, from the files' sizes).
TABLE_BYTES = 24 << 20
START, REPEAT = 2, "\x01"


def _codes(text: str) -> np.ndarray:
    parts = text.split()
    if not parts:
        return np.zeros(0, np.uint64)
    clean = "".join([parts[0], *[REPEAT if a == b else " " + b for a, b in zip(parts, parts[1:])]])
    c = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where((c >= 48) & (c <= 57), 48, np.minimum(c, 0xFFFF))
    return np.concatenate([np.full(ORDER - 1, START), c]).astype(np.uint64)


def _grams(text: str) -> np.ndarray:
    c = _codes(text)
    n = len(c) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return (c[:n] << np.uint64(48)) | (c[1 : n + 1] << np.uint64(32)) | (c[2 : n + 2] << np.uint64(16)) | c[3:]


def _batch_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts of runs of texts of about a megabyte."""
    for batch in batches:
        parts = W.texts(batch.column(0))
        for first, last, _, _ in W.joined(parts):
            grams = [_grams(t.decode()) for t in parts[first:last]]
            found, n = np.unique(np.concatenate(grams), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["gram", "n"])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, parts = batch.column(0), W.texts(batch.column(2))
        for first, last, _, _ in W.joined(parts):
            found = [np.unique(_grams(t.decode()), return_counts=True) for t in parts[first:last]]
            sizes = np.array([len(g) for g, _ in found])
            at = pa.array(np.repeat(np.arange(first, last), sizes))
            yield pa.RecordBatch.from_arrays(
                [ids.take(at), batch.column(1).take(at), pa.array(np.concatenate([g for g, _ in found]).view(np.int64)),
                 pa.array(np.concatenate([n for _, n in found]).astype(np.int64))],
                names=["id", "row", "gram", "n"])


def _suffix(gram: Column, k: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (16 * k)) - 1))


def _discounts(table: DataFrame) -> list[float]:
    """D1, D2, D3+ from the counts of counts; plain fractions where those are degenerate."""
    n = {r["n"]: float(r["k"]) for r in table.where("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
    n1, n2, n3, n4 = (n.get(i, 0.0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3 and n4):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    return [min(max(d, 0.05), k - 0.05) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]


def _order(counts: DataFrame, k: int, stages: Stages) -> tuple[DataFrame, DataFrame, list[float]]:
    """Counts by gram of ``k`` codes; totals and freed mass by context; discounts."""
    d = _discounts(counts)
    context = counts.groupBy(F.shiftrightunsigned("gram", 16).alias(f"ctx{k}")).agg(
        F.sum("n").cast("double").alias(f"all{k}"),
        (sum(F.sum(F.when(F.col("n") == i + 1 if i < 2 else F.col("n") > 2, d[i]).otherwise(0.0)) for i in range(3))).alias(f"free{k}"))
    return counts.select(F.col("gram").alias(f"gram{k}"), F.col("n").alias(f"n{k}")), stages.save(context, f"contexts{k}"), d


def train(trusted: DataFrame, stages: Stages) -> list:
    """Count tables of all orders, from the highest; ``trusted`` has the one column text."""
    counts = trusted.mapInArrow(_batch_counts, "gram long, n long")
    counts = stages.save(counts.groupBy("gram").agg(F.sum("n").alias("n")), "counts4")
    tables = [_order(counts, ORDER, stages)]
    for k in range(ORDER - 1, 0, -1):  # distinct codes to the left of each shorter gram
        counts = stages.save(counts.groupBy(_suffix(F.col("gram"), k).alias("gram")).agg(F.count("*").alias("n")), f"counts{k}")
        tables.append(_order(counts, k, stages))
    return tables


def resolve(grams: DataFrame, tables: list, stages: Stages) -> DataFrame:
    """(gram, logp): the interpolated probability of the last code of every gram."""
    wanted = [grams.select("gram")]
    for k in range(ORDER - 1, 0, -1):
        wanted.append(stages.save(wanted[-1].select(_suffix(F.col("gram"), k).alias("gram")).distinct(), f"grams{k}"))
    kinds = tables[-1][0].count() + 1  # characters, and one for all unknown ones
    lower = None
    with setting(grams.sparkSession, "spark.sql.autoBroadcastJoinThreshold", str(TABLE_BYTES)):
        for k, own, (counts, contexts, d) in zip(range(1, ORDER + 1), reversed(wanted), reversed(tables)):
            df = own.withColumn(f"ctx{k}", F.shiftrightunsigned("gram", 16))
            df = df.join(counts, F.col("gram") == F.col(f"gram{k}"), "left").join(contexts, f"ctx{k}", "left")
            below = F.lit(1.0 / kinds)
            if lower is not None:
                df = df.join(lower, _suffix(F.col("gram"), k - 1) == F.col("tail"))
                below = F.col("lower")
            n = F.coalesce(F.col(f"n{k}"), F.lit(0)).cast("double")
            less = F.when(n == 0, 0.0).when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
            p = F.when(F.col(f"all{k}").isNull(), below).otherwise((n - less + F.col(f"free{k}") * below) / F.col(f"all{k}"))
            if k == ORDER:
                return stages.save(df.select("gram", F.log(p).alias("logp")), "resolved")
            lower = stages.save(df.select(F.col("gram").alias("tail"), p.alias("lower")), f"lower{k}")


def _scores(rows: DataFrame, tables: list, stages: Stages) -> DataFrame:
    """(id, row, nats): log-perplexity per character of all ``rows`` (id, row, text) with grams."""
    grams = rows.select("text").mapInArrow(_batch_counts, "gram long, n long").select("gram").distinct()
    resolved = resolve(stages.save(grams, "grams"), tables, stages)
    counted = rows.select("id", "row", "text").mapInArrow(_document_counts, "id long, row long, gram long, n long")
    scored = counted.join(small(resolved, limit=RESOLVED_ROWS), "gram")
    scored = scored.groupBy("id", "row").agg((-F.sum(F.col("n") * F.col("logp")) / F.sum("n")).alias("nats"))
    return stages.save(scored, "scored")


def _levels(trusted: DataFrame, stages: Stages) -> DataFrame:
    """(l, level): the limit of every language, from trusted documents scored by the other half's model."""
    halves = [trusted.where(F.pmod("row", F.lit(2)) == h) for h in (0, 1)]
    models = [train(half.select("text"), stages) for half in halves]
    seen = [bool(tables[-1][0].head(1)) for tables in models]
    scored = None
    for half, tables in zip(halves, reversed(models)):
        # Without text in one of the halves no document can be measured from outside.
        part = half.where(F.lit(all(seen))).select("id", "row", "text")
        part = _scores(part, tables, stages) if all(seen) else part.select("id", "row", F.lit(0.0).alias("nats"))
        scored = part if scored is None else scored.unionByName(part)
    scored = scored.select(F.col("id").alias("sid"), F.col("row").alias("srow"), "nats")
    good = trusted.select("id", "row", "lang").join(scored, (F.col("id") == F.col("sid")) & (F.col("row") == F.col("srow")))
    level = F.percentile_approx("nats", QUANTILE, 10000) * MARGIN
    return stages.save(good.groupBy(F.col("lang").alias("l")).agg(level.alias("level")), "levels")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, row, lang, perplexity, threshold, kept); ``row`` is the hash of the text.

    ``labels``: the ids of trusted documents, in ``id_col``.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "kn_quality")
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(body).alias("row"), body.alias("text"), F.col(lang_col).cast("string").alias("lang"))
    ids = stages.save(labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id")).distinct(), "ids")
    trusted = stages.save(having(plain, ids, "id", stages).select("id", "row", "text", "lang"), "trusted")
    levels = _levels(trusted, stages)
    scored = _scores(plain, train(trusted.select("text"), stages), stages)
    rows = plain.select("id", "row", "lang").join(
        scored.select(F.col("id").alias("sid"), F.col("row").alias("srow"), "nats"),
        F.col("id").eqNullSafe(F.col("sid")) & (F.col("row") == F.col("srow")), "left").select("id", "row", "lang", "nats")
    judged = rows.join(levels, F.col("lang").eqNullSafe(F.col("l")), "left")
    return stages.finish(judged.select(
        F.col("id").alias(id_col), "row", "lang", F.exp("nats").alias("perplexity"), F.exp("level").alias("threshold"),
        (F.col("nats").isNotNull() & F.coalesce(F.col("nats") <= F.col("level"), F.lit(True))).alias("kept")))


def _trusted(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 and toxic = 0").select("doc_id")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs.select("doc_id", "text", "lang"), _trusted(labels)).drop("row")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    judged = classify(docs.select("doc_id", "text", "lang"), _trusted(read(spark, sf_dir, "labels")))
    out = judged.where("not kept").select(F.col("doc_id").alias("__kn_id"), F.col("row").alias("__kn_row")).distinct()
    row = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(small(out), docs["doc_id"].eqNullSafe(F.col("__kn_id")) & (row == F.col("__kn_row")), "left_anti")
