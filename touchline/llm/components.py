"""Connected components of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Scratch

MOST_ROUNDS = 60


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node and component (its smallest node) of all nodes of ``links`` (a, b).

    Each round gives every node the smallest component among its neighbours and
    then that component's own one, until nothing changes. A node with very many
    links is combined before the shuffle; each round is written to a table.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    # Both ways of a link in one pass, as links may be costly to read.
    both = scratch.write(links.select(F.explode(ways).alias("way")).select("way.a", "way.b").distinct())
    state = scratch.write(both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("a", "least").alias("component")
    ))
    for _ in range(MOST_ROUNDS):
        heard = (
            both.join(state.withColumnRenamed("node", "b"), "b")
            .groupBy("a")
            .agg(F.min("component").alias("heard"))
        )
        jump = state.select(F.col("node").alias("over"), F.col("component").alias("beyond"))
        stepped = (
            state.join(heard, state["node"] == heard["a"])
            .select("node", "component", F.least("component", "heard").alias("new"))
            .join(jump, F.col("new") == F.col("over"))
            .select("node", F.least("new", "beyond").alias("new"), "component")
        )
        stepped = scratch.write(stepped)
        state = stepped.select("node", F.col("new").alias("component"))
        if stepped.filter(F.col("new") != F.col("component")).isEmpty():
            return state
    raise RuntimeError(f"components still change after {MOST_ROUNDS} rounds")
