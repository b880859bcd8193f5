"""Connected components of a distributed edge list.

Alternating large-star / small-star contraction: each round hangs every node
under the smallest node it sees, until only stars are left. Every round is two
grouped minima (combined map-side) and two joins, written to the checkpoint
folder; no edge or component reaches the driver, only a row count and a
checksum do. A node with very many edges is one key of a sort-merge join
against one row, which adaptive execution splits: for that the minima are
shuffled once more, as it splits only joins of two shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged


def _hang(edges: DataFrame, below: bool) -> DataFrame:
    """One star step over edges ``(u, v)``, read from ``u``: the neighbours
    ``v`` of ``u`` (and ``u``) are hung under the smallest of them. ``below``:
    small-star, over neighbours below ``u``; else large-star, all neighbours,
    moving those above ``u``."""
    if below:
        seen = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        seen = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = seen.groupBy("u").agg(F.min("v").alias("m")).repartition(F.xxhash64("u"))
    if below:
        moved = seen.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.union(least.select("u", F.col("m").alias("v")))
    least = least.withColumn("m", F.least("u", "m"))
    return seen.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node that has an edge: ``root`` is the
    smallest node reachable. Self-links, nulls, repeated and reversed edges
    are allowed; no edges give no rows."""
    now = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
           .filter("u <> v").distinct())
    now, before = staged(now, "edges"), None
    for _ in range(max_rounds):
        if before is not None:
            star = _hang(now, below=False).distinct()
            now = staged(_hang(star, below=True).filter("u <> v").distinct(), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v"), F.col("v")).distinct())
