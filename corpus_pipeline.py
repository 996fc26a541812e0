"""Corpus pipeline: quality, line dedup, near-dedup, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bronzegate.llm import decontaminate, kn_quality, line_dedup, minhash_dedup, packing
from bronzegate.llm.common import Stages, read

STAGES = [
    ("quality", kn_quality.stage),
    ("line_dedup", line_dedup.stage),
    ("minhash_dedup", minhash_dedup.stage),
    ("decontaminate", decontaminate.stage),
    ("packing", packing.stage),
]

#: The language model and the packing are not SQL.  No test runs the pipeline as a whole or holds the model against plain
#: Python: quality is held against labels, decontamination against planted rows and whole items, packing by its round trip.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read back by the next."""
    stages = Stages(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stages.save(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
