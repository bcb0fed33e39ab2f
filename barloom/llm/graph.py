"""Connected components of a table of links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable, forget


def _local_forest(batches):
    """Union-find over each Arrow batch: its links become links to the least node of each tree."""
    import pyarrow as pa

    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        pairs = [(n, root(n)) for n in list(parent)]
        pairs = [(n, r) for n, r in pairs if n != r]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())], ["hi", "lo"]
        )


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every neighbour of a node is hung on the least of them."""
    sided = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    if large:
        sided = sided.unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = sided.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = sided.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        out = joined.select(F.col("v").alias("hi"), F.col("m").alias("lo")).unionByName(
            least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))
        )
    return out.where("hi > lo").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root): each linked node with the least node that it can reach.

    Links of nulls and of a node to itself join nothing. Batches are first contracted by
    union-find, then large-star and small-star steps alternate until no link changes; each is
    an aggregate and a join on the node, so one node with very many links is pre-aggregated and
    its join can be split. The rounds grow with the logarithm of the longest path.
    """
    pairs = links.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).where("x <> y")
    edges = durable(pairs.mapInArrow(_local_forest, "hi long, lo long").distinct(), "forest")
    seen = None
    for _ in range(most_rounds):
        last, edges = edges, durable(_stars(_stars(edges, large=True), large=False), "stars")
        forget(last)
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
        ).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
