"""Connected components of a link table, as repeated contraction on Spark.

Each round every node takes the smallest node among itself and its neighbours as
parent; links and members move to the parents, loops and repeats go.  Nodes must
be in random order (hashes), then the expected number of nodes falls by a
constant factor a round, also on long chains, and a star collapses at once.  All
steps are partial aggregates and joins of stored tables, so a hub with very many
links is split by adaptive execution; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzegate.llm.common import Stages


def connected_components(links: DataFrame, stages: Stages) -> DataFrame:
    """``links`` (a, b) to (node, comp): comp is the smallest node (in the nodes' order) linked.

    Nodes without a link to another node are absent.  Null ends and loops are ignored.
    """
    links = stages.save(links.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "links")
    member = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("comp"))
    while not links.isEmpty():
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stages.save(
            ends.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("child"), F.least("a", "low").alias("parent")),
            "parents",
        )
        moved = links.join(parent, F.col("a") == F.col("child")).select(F.col("parent").alias("a"), "b")
        moved = moved.join(parent, F.col("b") == F.col("child")).select("a", F.col("parent").alias("b"))
        links = stages.save(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        member = member.join(parent, F.col("comp") == F.col("child"), "left").select("node", F.coalesce("parent", "comp").alias("comp"))
    return stages.save(member, "members")
