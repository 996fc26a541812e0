"""URL filter: rules by host and path prefix, and a list of canonical URLs.

Method: every list entry, rule or URL, is one key of a blocked Bloom filter.  The
filter is a table (block, 64-bit word): one block per key, five bits in its word.
The keys that a URL could match are tested against the filter; the possible
hits go to an exact hash join with the list, which removes the false positives.
All of it is DataFrame functions.

* Work is done once per distinct URL (partial aggregate), so a URL that a third of
  all rows hold costs one row, and the verdicts join back on the URL.
* A URL has few keys: one per (label count of some rule's host, length of some
  rule's path), and its canonical form.
* The filter takes 16 bytes for about five keys.  It, and the list, are broadcast
  only when their counted rows are few; else the same joins shuffle.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
Path: then up to ``?``, ``#`` or the end.  A null URL, or one without ``://``, has an
empty host and path.  A rule fits its host and all subdomains when the path
starts with the rule's path; the longest ``host + path`` wins, then the longer
host.  Without a rule the verdict is ``block`` if the canonical URL is listed,
else ``allow``.  Canonical: host without a leading ``www.`` or ``m.``, path without
closing slashes and without ``.html``.

Defined cases: null URL: empty host and path, no rule unless a rule has an
empty host, verdict allow; repeated rows each get their row; null or repeated
list entries count once; two rules with equal host and path: block wins; an
empty list allows all; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzegate.llm.bloom import FILTER_ROWS, bits, bloom
from bronzegate.llm.common import LOWER, UPPER, Stages, small

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(\.html)?/*$", ""))


def _rule_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("rule "), host, F.lit(" "), path)


def _url_key(canon: Column) -> Column:
    return F.concat(F.lit("url "), canon)


def url_verdicts(pages: DataFrame, rules: DataFrame, listed: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` added (replacing such columns).

    ``rules``: (host, path, verdict).  ``listed``: (host, path) of blocked URLs.
    """
    spark = pages.sparkSession
    stages = Stages(spark, "url_filter")
    rules = rules.where("host is not null and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rule_keys = rules.select(
        _rule_key(F.col("host"), F.col("path")).alias("key"),
        F.concat("host", "path").alias("rule"), "verdict",
        F.char_length(F.concat("host", "path")).alias("rank"), F.char_length("host").alias("host_rank"),
        F.size(F.split("host", "\\.")).alias("labels"), F.char_length("path").alias("path_chars"),
    )
    url_keys = (
        listed.where("host is not null and path is not null")
        .select(_url_key(canonical(F.col("host"), F.col("path"))).alias("key")).distinct()
        .select("key", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"), F.lit(-1).alias("rank"),
                F.lit(0).alias("host_rank"), F.lit(0).alias("labels"), F.lit(0).alias("path_chars"))
    )
    entries = stages.save(rule_keys.unionByName(url_keys), "entries")
    n = entries.count()
    word_table, blocks = bloom(entries, n)
    word_table = stages.save(word_table, "bloom")
    # Distinct shapes, not rules: a handful of label counts times path lengths.
    shapes = entries.where("rank >= 0").select("labels", "path_chars").distinct().collect()
    shape_list = F.array(*[F.struct(F.lit(r["labels"]).alias("labels"), F.lit(r["path_chars"]).alias("path_chars")) for r in shapes])
    if not shapes:
        shape_list = F.array().cast("array<struct<labels:int,path_chars:int>>")

    urls = stages.save(
        pages.select(F.col(url_col).alias("u")).distinct().select("u", host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p")),
        "urls",
    )
    labels = F.split("h", "\\.")
    rule_candidates = F.transform(
        F.filter(shape_list, lambda s: (s["labels"] <= F.size(labels)) & (s["path_chars"] <= F.char_length("p"))),
        lambda s: _rule_key(
            F.array_join(F.slice(labels, F.size(labels) - s["labels"] + 1, s["labels"]), "."),
            F.substring(F.col("p"), F.lit(1), s["path_chars"]),
        ),
    )
    candidates = urls.select(
        "u", F.explode(F.concat(rule_candidates, F.array(_url_key(canonical(F.col("h"), F.col("p")))))).alias("key")
    ).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    possible = candidates.join(small(word_table, min(n, blocks), FILTER_ROWS), "block").where(
        F.col("word").bitwiseAND(bits(F.col("key"))) == bits(F.col("key"))
    )
    hits = possible.join(small(entries.drop("labels", "path_chars"), n), "key")
    best = hits.groupBy(F.col("u").alias("hit_u")).agg(F.max(F.struct("rank", "host_rank", "rule", "verdict")).alias("best"))
    judged = stages.save(
        urls.join(best, F.col("u").eqNullSafe(F.col("hit_u")), "left").select(
            F.col("u").alias("__uf_u"), F.col("h").alias("__uf_h"), F.col("p").alias("__uf_p"),
            F.col("best.rule").alias("__uf_rule"), F.coalesce("best.verdict", F.lit("allow")).alias("__uf_verdict")),
        "judged",
    )
    keep = [pages[c] for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return pages.join(judged, F.col(url_col).eqNullSafe(F.col("__uf_u")), "left").select(
        *keep, F.col("__uf_h").alias("host"), F.col("__uf_p").alias("path"),
        F.col("__uf_rule").alias("rule"), F.col("__uf_verdict").alias("verdict"),
    )


# The contract's rules (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Host labels that put a page's URL on the list of the registered query.
LISTED_LABELS = r"(^|[.-])(casino|pills|spam|adult)([.-]|$)"


def digest(pages: DataFrame) -> DataFrame:
    """Every page judged by the contract's rules and the URLs collected from listed hosts."""
    bare = pages.select("page_id", "url")
    rules = bare.sparkSession.createDataFrame(RULES, "host string, path string, verdict string")
    found = bare.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).distinct()
    return url_verdicts(bare, rules, found.where(F.col("host").rlike(LISTED_LABELS))).select(
        "page_id", "host", "path", "rule", "verdict"
    )
