"""Connected components by alternating stars, for link tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.llm.common import materialize

MOST_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst"))).first()
    )


def smallest_reachable(links: DataFrame, label: str) -> DataFrame:
    """``node, component`` for every node of ``links`` (``src, dst``, any order, longs).

    A round ties each node's larger neighbours, then its smaller ones, to the smallest node
    it sees.  The paths halve with each round; every round is written to the shared folder,
    so a lost executor repeats one round at most.  Minima combine before the shuffle, so a
    node with very many links is no hot spot.
    """
    edges = materialize(
        links.select(
            F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
        ).where("src != dst").distinct(),
        label,
    )
    before = _state(edges)
    for _ in range(MOST_ROUNDS):
        both = edges.unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        lowest = both.groupBy("src").agg(F.least("src", F.min("dst")).alias("low"))
        large = materialize(
            both.where("dst > src").join(lowest, "src").select(F.col("dst").alias("src"), "low")
            .where("src != low").distinct(),
            label,
        ).withColumnRenamed("low", "dst")
        lowest = large.groupBy("src").agg(F.min("dst").alias("low"))
        small = large.join(lowest, "src")
        edges = materialize(
            small.select(F.col("dst").alias("src"), F.col("low").alias("dst"))
            .unionAll(small.select("src", F.col("low").alias("dst")))
            .where("src != dst").distinct(),
            label,
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionAll(
        edges.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    )
