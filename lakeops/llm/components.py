"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import Landings, temporary_table


def _lowest(pairs: DataFrame) -> DataFrame:
    """For each node of directed pairs (u, v) its lowest neighbour, itself included; summed up before the shuffle."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(edges: DataFrame, left: str, right: str, label: str = "components") -> DataFrame:
    """(node, root): every node that has an edge, with the lowest node it can reach.

    Each step replaces the edges by as many or fewer; it takes about log(nodes) steps. The edges of a step are a table
    in the shared folder, so lineage does not grow and a lost executor costs a re-read. A node with very many edges
    only meets joins that adaptive execution can cut and sums that are combined before the shuffle.
    """
    store = Landings(label)
    u, v = F.col(left), F.col(right)
    now = store.keep(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct(), "0")
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # an edge ends at the lower node, so the small star needs only the edges as they stand
        large = store.keep(large.where("u <> v").distinct(), "large")
        small = large.join(_lowest(large), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        following = store.keep(small.where("u <> v").distinct(), "small")
        row = following.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = following
        if mark == tuple(row):
            break
        mark = tuple(row)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = temporary_table(nodes.union(now.select("v", "v").distinct()).distinct(), f"{label}-roots")
    store.drop_all()
    return out
