"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import materialise


def smallest_reachable(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component: the smallest node reachable over the links (a, b).

    Alternates two steps until nothing changes: every node links its larger
    neighbours to its smallest one, then its smaller neighbours. Each keeps
    connectivity and the number of links falls, so a component of any shape
    ends as a star after about log(size) rounds. All of it is grouping and
    joining of links; the links of a hot node are spread by the joins, as each
    link only meets its node's minimum. Nodes that only link to themselves are
    left out.
    """
    edges = materialise(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = None
    for _ in range(most_rounds):
        # Large star: for each node, its larger neighbours go to the smallest
        # of the node and its neighbours.
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.filter("v > u")
            .join(least, "u")
            .filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # Small star: for each node, its smaller neighbours and itself go to
        # the smallest of them.
        large = materialise(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(
            small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        )
        state = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.countDistinct("u")
        ).first()
        if state == before and state[0] == state[2]:
            break
        before = state
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
