"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from bronzegate.llm import chat_format, conversation_repair, decontaminate, embedding_dedup, kn_quality, lexical_search, line_dedup, minhash_dedup, packing, secret_scan, substring_dedup, suffix_dedup, url_filter
from bronzegate.llm.common import read


def _over(table, digest):
    return lambda spark, sf_dir: digest(read(spark, sf_dir, table))


QUERIES = {
    "op1_secret_scan": _over("documents", secret_scan.digest),
    "op3_embedding_dedup": _over("embeddings", embedding_dedup.digest),
    "op4_decontaminate": lambda spark, sf_dir: decontaminate.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")),
    "op6_kn_quality": lambda spark, sf_dir: kn_quality.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")),
    "op7_suffix_dedup": _over("documents", suffix_dedup.digest),
    "op8_substring_dedup": _over("documents", substring_dedup.digest),
    "op9_packing": _over("documents", packing.digest),
    "op2_line_dedup": _over("documents", line_dedup.digest),
    "op5_url_filter": _over("pages", url_filter.digest),
    "op10_minhash_dedup": _over("documents", minhash_dedup.digest),
    "op11_conversation_repair": _over("conversations", conversation_repair.digest),
    "op12_chat_format": _over("conversations", chat_format.digest),
    "op13_lexical_search": lambda spark, sf_dir: lexical_search.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")),
}
