"""Connected components as rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is one of its nodes.

    Each round draws a new random order of the nodes, sends every node to the first among itself
    and its neighbours, and replaces both ends of each link by where they went. A constant share of
    the nodes goes in each round whatever the graph looks like (with a fixed order, a chain would
    take as many rounds as it is long), so rounds grow with the logarithm of the largest
    component. Nothing is gathered: a round is one minimum per node and two joins.
    """
    names = links.withColumnsRenamed({"a": "node", "b": "component"})
    links = written(links.where("a <> b").select("a", "b"), "links")
    hops: list[DataFrame] = []
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        order = F.xxhash64(F.lit(len(hops)), "b")
        first = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(order, "b")).alias("first"))
        itself = F.struct(F.xxhash64(F.lit(len(hops)), "node"), F.col("node").alias("b"))
        parents = written(first.select("node", F.least("first", itself)["b"].alias("parent")), "parents")
        hops.append(parents)
        a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        links = written(
            links.join(a, "a")
            .join(b, "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            "links",
        )
    if not hops:
        return names.limit(0)
    # Read the rounds backwards: a node belongs where its parent belongs in the next round, if there.
    found = hops[-1].withColumnRenamed("parent", "component")
    for hop in reversed(hops[:-1]):
        later = found.withColumnRenamed("node", "parent")
        found = written(
            hop.join(later, "parent", "left").select(
                "node", F.coalesce("component", "parent").alias("component")
            ),
            "components",
        )
    return found
