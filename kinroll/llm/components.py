"""Connected components of a link table, by repeated contraction.

Every node takes the neighbour (or itself) with the smallest hash as its label;
links become links between labels, and the loop ends when none is left. Labels
are then followed through the rounds. Hashes are random, so a round removes a
constant share of the nodes whatever the ids' order. Every round is two joins
and two aggregations over link tables that are cut to the shared folder; nothing
is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinroll.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to ``(node, component)``: for every node of some link the
    smallest node reachable from it. Null ends and loops are no links."""
    links = cut(links.filter("a < b or a > b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("hash"), F.col(c).alias("id"))
        labels = cut(both.groupBy("a").agg(F.least(F.min(rank("b")), F.min(rank("a")))["id"].alias("label")))
        rounds.append(labels)
        links = cut(
            links.join(labels.select("a", F.col("label").alias("la")), "a")
            .join(labels.select(F.col("a").alias("b"), F.col("label").alias("lb")), "b")
            .filter("la <> lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()
        )
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds[0].select(F.col("a").alias("node"), "label")
    for labels in rounds[1:]:
        later = labels.select(F.col("a").alias("label"), F.col("label").alias("next"))
        found = found.join(later, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    found = cut(found)
    # cut, so that the join's sides both come by a plain exchange: AQE may split a large component
    least = cut(found.groupBy("label").agg(F.min("node").alias("component")))
    return found.join(least, "label").select("node", "component")
