"""Connected components of a link table, as joins and aggregations."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    root = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    root = _least(down)
    hang = down.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hang.union(root.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; component = smallest node reachable.

    Alternating large-star and small-star rounds: each round hangs neighbours on
    the least neighbour known, so chains shorten geometrically. A hub of any
    size is one key of a partial aggregation and of a join that adaptive
    execution can split; no neighbourhood is ever gathered in one place. Every
    round is written to the shared folder. Nulls and self-links are ignored; an
    empty table gives an empty result.
    """
    edges = written(links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
                    .filter("u <> v").distinct(), "links")
    last = None
    for _ in range(MAX_ROUNDS):
        edges = written(_small_star(_large_star(edges)), "star")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == last:
            break
        last = tuple(mark)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)
