"""Connected components by contraction, all in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge in (a, b); root is one node of its component.

    Each round every node hooks to its smallest neighbour, pointers are halved once, and the edges
    are rewritten to the hooks; edges inside a hook vanish. Ids should be hash-like: then a round
    leaves a fixed share of the nodes and the number of rounds grows with the logarithm of a
    component's size. Smallest neighbours are combined before the shuffle, so a node with very
    many edges costs no more than others. Links are never collected; each round is written to the
    shared folder. Self-loops and repeated edges do no harm.
    """
    links = staged(edges.select("a", "b").where("a != b").distinct(), "cc-links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = staged(nodes.select("node", F.col("node").alias("root")), "cc-labels")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("to"))
        hooks = staged(hooks.select("v", F.least("v", "to").alias("to")), "cc-hooks")
        up = hooks.select(F.col("v").alias("to"), F.col("to").alias("above"))
        hooks = staged(hooks.join(up, "to").select("v", F.col("above").alias("to")), "cc-jumps")
        links = staged(
            links.join(hooks.select(F.col("v").alias("a"), F.col("to").alias("ta")), "a")
            .join(hooks.select(F.col("v").alias("b"), F.col("to").alias("tb")), "b")
            .where("ta != tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct(),
            "cc-links",
        )
        labels = staged(
            labels.join(hooks.withColumnRenamed("v", "root"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            ),
            "cc-labels",
        )
    return labels
