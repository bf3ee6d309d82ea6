"""Connected components of an undirected graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import stored


def components(links: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node reachable over ``links`` (a, b), for
    every node that has a link.

    Each round lowers a node's label, and its label's label, to the smallest
    among its neighbours, then follows labels one step; rounds grow with the
    logarithm of a component's width. Minima are aggregated before they are
    shuffled and each round is written to the shared folder, so neither a hub
    with very many links nor a lost executor holds it up."""
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), name + "-links")
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), name)
    for _ in range(most_rounds):
        at = label.select(F.col("node").alias("b"), F.col("label").alias("other"))
        near = both.join(at, "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("low"))
        low = label.join(near, "node").select("node", "label", F.least("label", "low").alias("low"))
        hooked = (low.select("node", "low").union(low.select(F.col("label").alias("node"), "low"))
                  .groupBy("node").agg(F.min("low").alias("low")))
        hooked = stored(hooked, name)
        up = hooked.select(F.col("node").alias("low"), F.col("low").alias("top"))
        old = label
        label = stored(hooked.join(up, "low").select("node", F.least("low", "top").alias("label")), name)
        was = old.select("node", F.col("label").alias("was"))
        if label.join(was, "node").filter(F.col("label") != F.col("was")).isEmpty():
            return label
    raise RuntimeError("components did not settle")
