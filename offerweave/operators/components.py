"""Connected components by alternating large-star and small-star rounds.

Edges are contracted towards the smallest node of their component.  A round is two
aggregations with map-side minima and two equi-joins that adaptive execution can
split when one node has very many neighbours; no neighbourhood is ever gathered.
Rounds grow with the logarithm of the diameter, and each one is written to scratch.
Where asked for, a graph of few edges is contracted by one task in memory instead.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.plans.scratch import materialize


def _contract(batches: Iterator) -> Iterator:
    """Arrow batches of ``(src, dst)`` -> ``(node, component)``: labels hook to smaller ones and are shortened until edges agree."""
    import numpy as np
    import pyarrow as pa

    pairs = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not pairs:
        return
    src, dst = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
    nodes, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    s, d = at[: len(src)], at[len(src) :]
    label = np.arange(len(nodes))
    while (label[s] != label[d]).any():
        a, b = label[s], label[d]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while ((shorter := label[label]) != label).any():
            label = shorter
    for i in range(0, len(nodes), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[i : i + 100_000]), pa.array(nodes[label[i : i + 100_000]])], names=["node", "component"])


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both_ways(edges)
    low = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("low", "src").alias("low"))
    return (
        both.filter("dst > src").join(low, "src").filter("dst <> low")
        .select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).filter("src <> dst")
    low = down.groupBy("src").agg(F.min("dst").alias("low"))
    moved = down.join(low, "src").filter("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(low.select("src", F.col("low").alias("dst"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60, in_one_task: int = 0) -> DataFrame:
    """``edges(src, dst)`` -> ``(node, component)`` for every node that has an edge.

    ``component`` is the smallest node id that can be reached.  Loops, repeated and
    null edges are ignored; no edges give no rows.  At most ``in_one_task`` edges go to one task.
    """
    clean = edges.select("src", "dst").filter("src is not null and dst is not null and src <> dst")
    current = materialize(
        clean.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "cc"
    )

    if in_one_task and current.limit(in_one_task + 1).count() <= in_one_task:
        one = current.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint")).coalesce(1)
        return materialize(one.mapInArrow(_contract, "node bigint, component bigint"), "cc")

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()

    before = mark(current)
    if before[0] == 0:
        return current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    for _ in range(max_rounds):
        current = materialize(_small_star(_large_star(current)), "cc")
        after = mark(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
        current.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    )
