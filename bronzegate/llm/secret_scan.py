"""Secret scan: pattern matches, and a battery of randomness tests for the rest.

Patterns (kinds ``assign``, ``access``, ``hex``) are the base; the battery adds
spans of kind ``random``.  All but the scores of the references (numpy in Arrow batches) is DataFrame functions.

Positions: ``split`` gives the text between the matches of a pattern and
``regexp_extract_all`` the matches; their lengths, summed in order, are the code
point offsets.  Only documents with a match explode, and only lengths move.

Battery.  Candidates are runs of at least 20 characters of ``[A-Za-z0-9+/_=-]`` with a
letter or digit.  Each gets the smallest alphabet that holds its characters (letters of one
or both cases if it has only those, else digits, hex, base32, base36, base64) and three
statistics that are standard normal for random strings over that alphabet:
chi-squared uniformity, Wald-Wolfowitz runs about the alphabet's middle, lag-one
serial correlation.  Fisher's method joins their p-values to a randomness score.

False-discovery control, by length stratum (20-23, 24-31, 32-47, 48-95, 96 and up), apart
for runs of letters alone: the p-value of a candidate against prose is the share of
references that score at least as high, and Benjamini-Hochberg at ``ALPHA`` within the
stratum decides.  References are consecutive words of the corpus' prose (runs of under 20
letters with no digit or sign at either end), lower-cased, joined and cut to the
stratum's least length, where prose looks most random; they score over the alphabets
of the candidates they stand against.  One starts at every word of the corpus, so nothing is
drawn.  Those of the words of ``PROSE`` are always among them, so a corpus with little or no prose
has references too; each weighs as many of the corpus' as make those ``REFERENCES``, or
``DEALT`` times the stratum's candidates if that is more (one at least), so ``PROSE`` counts however large the corpus.
References are scored where they stand, by running sums over the letters of a text
(``_histogram``), and only their counts by bin leave the tasks.
Short prose often looks random, so short candidates need more.  Scores are compared in
1000 bins, so the control needs one small table (stratum x bin), whatever the size of the
corpus.  A candidate that overlaps a base span is not added.

Spans are [start, end) in code points of the whole text; null text is empty; rows
with the same id and text are the same document and each gets the same result;
a null id is an id like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bronzegate.llm.common import Stages

# The contract's patterns.  "Either case" holds for ASCII letters.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
MIN_VALUE = 8
KINDS = ["assign", "access", "hex", "random"]

TOKEN = "[A-Za-z0-9+/_=-]{20,}"
ALPHA = 0.05
BINS = 1000
STRATA = [20, 24, 32, 48, 96]
REFERENCES = 5000
DEALT = 2 / ALPHA
WORD = "(?<![A-Za-z0-9+/_=-])[A-Za-z]{1,19}(?![A-Za-z0-9+/_=-])"
STARTS = 4096  # references scored at a time
TEXT_BYTES = 1 << 20  # text looked at together, at least one document
PROSE = """
The old road left the village by the mill and followed the river for some miles before it turned towards the hills.
In spring the water often stood in the fields on both sides, and people who wanted to reach the market had to take the
longer way through the forest. Nobody minded much, because the longer way passed the house of a baker whose bread was known
in three valleys. She had learned the trade from her father, who had been a sailor first and had brought back from his
voyages a box of spices and a great many stories. On winter evenings neighbours would gather in the warm kitchen, listen to
the wind, and ask for the one about the island where the birds could not fly. Her children knew every word of it and would
complain when a detail was left out. Years later, when the new bridge was finished and the traffic no longer came near, the
shop stayed open all the same. Visitors still wrote letters to say how glad they were to have found it, and a small society
was formed to look after the building, the garden and the records that the family had kept since the beginning of the century.
"""
# Alphabets by growing size: a run belongs to the first whose pattern it fits.
LETTERS = [("^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"), ("^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
           (None, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")]
ALPHABETS = [
    ("^[0-9]+$", "0123456789"),
    ("^[0-9a-f]+$", "0123456789abcdef"),
    ("^[0-9A-F]+$", "0123456789ABCDEF"),
    ("^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    (None, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"),
]


def _matches(rows: DataFrame, pattern: str, value_group: int = 0) -> DataFrame:
    """(doc, row, start, end, hit, value) of all leftmost non-overlapping matches of ``pattern``."""
    found = rows.where(F.col("body").rlike(pattern)).select(
        "doc", "row",
        F.split("body", pattern).alias("between"),
        F.regexp_extract_all("body", F.lit(pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all("body", F.lit(pattern), F.lit(value_group)).alias("values"),
    ).select("doc", "row", F.posexplode(F.arrays_zip("between", "hits", "values")).alias("i", "m")).where("m.hits is not null")
    # Equal rows of one document give equal lines here, once each.
    one = found.select("doc", "row", "i", F.char_length("m.between").alias("gap"), F.char_length("m.hits").alias("len"),
                       F.col("m.hits").alias("hit"), F.col("m.values").alias("value")).distinct()
    in_order = Window.partitionBy("doc", "row").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("len")).over(in_order)
    return one.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))


def base_spans(rows: DataFrame) -> DataFrame:
    """(doc, row, start, end, kind) by the patterns; kind is its place in ``KINDS``."""
    parts = [
        _matches(rows, ASSIGN, 2).where(F.char_length("value") >= MIN_VALUE),
        _matches(rows, ACCESS),
        _matches(rows, HEX),
    ]
    out = None
    for kind, part in enumerate(parts):
        part = part.select("doc", "row", "start", "end", F.lit(kind).alias("kind"))
        out = part if out is None else out.unionByName(part)
    return out


def _cdf(z: Column) -> Column:
    """Normal distribution function by a logistic form (error below 2e-4)."""
    z = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))
    return 1 / (1 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))


def _alphabet(kinds: list) -> Column:
    return F.coalesce(*[F.when(F.col("hit").rlike(p), F.lit(a)) for p, a in kinds[:-1]], F.lit(kinds[-1][1]))


def randomness(tokens: DataFrame) -> DataFrame:
    """``tokens`` (columns ``hit`` and ``letters``, whether over letters alone) with ``score``:
    the joint p-value of the three tests, 0 to 1."""
    df = tokens.withColumn("alphabet", F.when(F.col("letters"), _alphabet(LETTERS)).otherwise(_alphabet(ALPHABETS))).withColumn("body", F.regexp_replace("hit", "=+$", ""))
    df = df.withColumn("chars", F.filter(F.split("body", ""), lambda c: c != "")).withColumn("n", F.size("chars").cast("double"))
    df = df.withColumn("size", F.char_length("alphabet").cast("double"))
    # Ranks about the alphabet's middle; a character outside it ("=" inside a run) ranks lowest.
    df = df.withColumn("ranks", F.expr("transform(chars, c -> cast(instr(alphabet, c) as double) - (size + 1) / 2)"))
    squares = F.aggregate(
        F.array_distinct("chars"), F.lit(0.0),
        lambda acc, c: acc + F.pow(F.size(F.filter("chars", lambda x: x == c)).cast("double"), F.lit(2.0)),
    )
    df = df.withColumn("chi", F.col("size") / F.col("n") * squares - F.col("n"))
    df = df.withColumn("high", F.aggregate("ranks", F.lit(0.0), lambda a, r: a + F.when(r > 0, 1.0).otherwise(0.0)))
    df = df.withColumn("next", F.slice("ranks", F.lit(2), F.size("ranks")))
    df = df.withColumn("pairs", F.arrays_zip(F.slice("ranks", F.lit(1), F.size("ranks") - 1).alias("a"), F.col("next").alias("b")))
    df = df.withColumn("turns", F.aggregate("pairs", F.lit(0.0), lambda a, p: a + F.when((p["a"] > 0) != (p["b"] > 0), 1.0).otherwise(0.0)))
    df = df.withColumn("lag", F.aggregate("pairs", F.lit(0.0), lambda a, p: a + p["a"] * p["b"]))
    df = df.withColumn("power", F.aggregate("ranks", F.lit(0.0), lambda a, r: a + r * r))
    n, low = F.col("n"), F.col("n") - F.col("high")
    mean = 2 * F.col("high") * low / n
    var = F.greatest(F.lit(1e-9), mean * (mean - 1) / (n - 1))
    p_chi = 1 - _cdf((F.col("chi") - (F.col("size") - 1)) / F.sqrt(2 * (F.col("size") - 1)))
    p_runs = F.when((F.col("high") == 0) | (low == 0), 0.0).otherwise(2 * (1 - _cdf(F.abs((F.col("turns") - mean) / F.sqrt(var)))))
    p_serial = F.when(F.col("power") == 0, 0.0).otherwise(2 * (1 - _cdf(F.abs(F.col("lag") / F.greatest(F.col("power"), F.lit(1e-9)) * F.sqrt(n)))))
    half = -sum((F.log(F.greatest(p, F.lit(1e-12))) for p in (p_chi, p_runs, p_serial)), F.lit(0.0))
    score = F.exp(-half) * (1 + half + half * half / 2)  # chi-squared survival, six degrees of freedom
    keep = [c for c in tokens.columns]
    return df.select(*keep, score.alias("score"))


def _bin() -> Column:
    return F.floor(F.least(F.lit(0.999999), "score") * BINS).cast("int").alias("bin")


#: Alphabets that lower-case letters are scored over: size and place of "a" (``LETTERS``; ``ALPHABETS`` with digits, hex).
_PLAIN, _DIGITS, _HEX = (26, 1), (36, 11), (16, 11)


def _scores(length: int, size: int, squares, high, turns, lag, power):
    """``randomness`` from the sums of runs of one length."""
    def cdf(z):
        z = np.clip(z, -12.0, 12.0)
        return 1 / (1 + np.exp(-(1.5976 * z + 0.07056 * z * z * z)))

    n, low = float(length), length - high
    chi = size / n * squares - n
    mean = 2 * high * low / n
    var = np.maximum(1e-9, mean * (mean - 1) / (n - 1))
    p_chi = 1 - cdf((chi - (size - 1)) / math.sqrt(2 * (size - 1)))
    p_runs = np.where((high == 0) | (low == 0), 0.0, 2 * (1 - cdf(np.abs((turns - mean) / np.sqrt(var)))))
    p_serial = np.where(power == 0, 0.0, 2 * (1 - cdf(np.abs(lag / np.maximum(power, 1e-9) * math.sqrt(n)))))
    half = -sum(np.log(np.maximum(p, 1e-12)) for p in (p_chi, p_runs, p_serial))
    return np.exp(-half) * (1 + half + half * half / 2)


def _sums(codes, alphabet):
    """Running sums over letters (0 to 25) of what the tests need; ranks are doubled, so all are whole numbers."""
    ranks = 2 * (codes + alphabet[1]) - alphabet[0] - 1
    high = ranks > 0
    run = lambda x: np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    return run(high), run(high[1:] != high[:-1]), run(ranks[1:] * ranks[:-1]), run(ranks * ranks)


def _over(sums, at, length: int):
    """high, turns, lag, power of the runs that begin ``at``."""
    high, turns, lag, power = sums
    last = at + length - 1
    return high[last + 1] - high[at], turns[last] - turns[at], (lag[last] - lag[at]) / 4, (power[last + 1] - power[at]) / 4


def _histogram(texts: list[str], wanted: list[tuple[bool, int]], counts) -> None:
    """Adds to ``counts`` (letters, stratum, bin) the references of texts, each its words joined by spaces."""
    raw = np.frombuffer("\n".join(texts).encode() + b"\n", dtype=np.uint8)
    letter = raw >= 97
    if not letter.any():
        return
    codes = raw[letter].astype(np.int64) - 97
    before = np.cumsum(letter) - letter  # letters before each byte
    starts = before[letter & np.concatenate([[True], ~letter[:-1]])]
    bounds = before[raw == 10]
    room = bounds[np.searchsorted(bounds, starts, side="right")] - starts  # letters up to the end of the text
    for first in range(0, len(starts), STARTS):
        some, left = starts[first:first + STARTS], room[first:first + STARTS]
        here = codes[some[0]:some[-1] + max(STRATA)]
        some = some - some[0]
        held = np.zeros((len(here) + 1, 26), dtype=np.int32)
        held[np.arange(1, len(here) + 1), here] = 1
        np.cumsum(held, axis=0, out=held)
        plain, digits = _sums(here, _PLAIN), _sums(here, _DIGITS)
        for s in {s for _, s in wanted}:
            length = STRATA[s]
            at = some[left >= length]
            if not len(at):
                continue
            each = held[at + length] - held[at]
            squares = np.einsum("ij,ij->i", each, each)
            for letters in (True, False):
                if (letters, s) not in wanted:
                    continue
                alphabet, sums = (_PLAIN, plain) if letters else (_DIGITS, digits)
                score = _scores(length, alphabet[0], squares, *_over(sums, at, length))
                if not letters:
                    hexes = each[:, :6].sum(axis=1) == length
                    if hexes.any():
                        score[hexes] = _scores(length, _HEX[0], squares[hexes], *_over(_sums(here, _HEX), at[hexes], length))
                bins = np.floor(np.minimum(0.999999, score) * BINS).astype(np.int64)
                counts[int(letters), s] += np.bincount(bins, minlength=BINS)


def _references(rows: DataFrame, wanted: list[tuple[bool, int]]) -> DataFrame:
    """(letters, stratum, bin, refs): how many references, one at every word of the rows, fall in each bin."""
    words = rows.select(F.regexp_extract_all("body", F.lit(WORD), F.lit(0)).alias("words")).where(F.size("words") > 0)
    texts = words.select(F.lower(F.array_join("words", " ")).alias("text"))

    def count(batches):
        counts = np.zeros((2, len(STRATA), BINS), dtype=np.int64)
        some, held = [], 0
        for batch in batches:
            for value in batch.column(0):
                some.append(value.as_py())
                held += len(some[-1])
                if held >= TEXT_BYTES:
                    _histogram(some, wanted, counts)
                    some, held = [], 0
        _histogram(some, wanted, counts)
        letters, stratum, bins = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(letters == 1), pa.array(stratum.astype(np.int32)), pa.array(bins.astype(np.int32)), pa.array(counts[letters, stratum, bins])],
            names=["letters", "stratum", "bin", "refs"])

    return texts.mapInArrow(count, "letters boolean, stratum int, bin int, refs long")


def random_spans(rows: DataFrame, stages: Stages) -> DataFrame:
    """(doc, row, start, end, kind) of runs that the battery takes for secrets."""
    tokens = _matches(rows, TOKEN).select("doc", "row", "start", "end", "hit").where(F.col("hit").rlike("[A-Za-z0-9]"))
    length = F.col("end") - F.col("start")
    tokens = tokens.withColumn("letters", F.col("hit").rlike("^[A-Za-z]+$")).withColumn(
        "stratum", sum((F.when(length >= s, 1).otherwise(0) for s in STRATA[1:]), F.lit(0)))
    scored = stages.save(randomness(tokens).select("doc", "row", "start", "end", "letters", "stratum", _bin()), "tokens")
    # One row per stratum and bin: at most two times len(STRATA) times BINS.
    group = ["letters", "stratum"]
    wanted = [(r["letters"], r["stratum"]) for r in scored.select(*group).distinct().collect()]
    span = [F.col(c) for c in ("doc", "row", "start", "end")] + [F.lit(KINDS.index("random")).alias("kind")]
    if not wanted:
        return scored.select(*span)
    prose = _references(rows.sparkSession.range(1).select(F.lit(PROSE).alias("body")), wanted).withColumnRenamed("refs", "own")
    parts = [_references(rows, wanted), prose, scored.select(*group, "bin", F.lit(1).cast("long").alias("cands"))]
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy(*group, "bin").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("refs", "own", "cands")])
    down = Window.partitionBy(*group).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*group)
    table = table.select(
        *group, "bin", F.sum("cands").over(down).alias("found"), F.sum("cands").over(whole).alias("all_cands"),
        *[F.sum(c).over(w).alias(f"{name}_{c}") for c in ("refs", "own") for w, name in ((down, "above"), (whole, "all"))])
    weight = F.greatest(F.lit(1.0), F.col("all_refs") / F.greatest(F.lit(REFERENCES), DEALT * F.col("all_cands")))
    p_value = (1 + F.col("above_refs") + weight * F.col("above_own")) / (1 + F.col("all_refs") + weight * F.col("all_own"))
    floors = (
        table.where((F.col("found") > 0) & (p_value <= F.lit(ALPHA) * F.col("found") / F.col("all_cands")))
        .groupBy(*group).agg(F.min("bin").alias("floor"))
    )
    floors = stages.save(floors, "floors")
    return scored.join(F.broadcast(floors), group).where("bin >= floor").select(*span)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, row, start, end, kind) of all secrets; ``row`` is the hash of the text."""
    stages = Stages(docs.sparkSession, "secret_scan")
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(body).alias("row"), body.alias("body"))
    base = base_spans(rows)
    spans = base.unionByName(random_spans(rows, stages))
    doc = Window.partitionBy("doc", "row")
    before = doc.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = doc.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    is_base = F.col("kind") < KINDS.index("random")
    spans = spans.withColumn("base_end", F.max(F.when(is_base, F.col("end"))).over(before))
    spans = spans.withColumn("base_start", F.min(F.when(is_base, F.col("start"))).over(after))
    clash = (F.coalesce("base_end", F.lit(-1)) > F.col("start")) | (F.coalesce("base_start", F.col("end")) < F.col("end"))
    return spans.where(is_base | ~clash).select("doc", "row", "start", "end", "kind")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: the id, counts by kind, the base digest and all spans."""
    per_doc = secret_spans(docs, id_col, text_col).groupBy("doc", "row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("spans"))
    rows = docs.select(F.col(id_col).alias(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row"))
    joined = rows.join(per_doc.withColumnRenamed("row", "__row"), rows[id_col].eqNullSafe(F.col("doc")) & (F.col("row") == F.col("__row")), "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    base = F.filter(spans, lambda s: s["kind"] < KINDS.index("random"))
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return joined.select(
        id_col, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), count(3).alias("n_random"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def digest(docs: DataFrame) -> DataFrame:
    return scan_documents(docs.select("doc_id", "text"))
