"""Sharding by extendible hashing.

A document's key hash is a string of bits. The directory starts at depth 0
(one shard for all); a shard that is over its byte limit, and only such a
shard, is split on the next bit until every shard fits. Bits 1-60 come from the
id, the next 60 from the row itself, so repeated ids still split. A shard of a
single document is not split further, even if that document alone is over the
limit (``oversize``).

Scale: the tree is decided on byte sums per hash prefix (one aggregate,
combined map-side), never on rows: all depths of the directory come from one
grouped sum, the leaf of a prefix is its shallowest ancestor that fits. Only
prefixes that are still too large at the directory's depth get another round
with longer prefixes. Rows then meet the directory by one join, broadcast if
its counted size allows it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, small, staged

HASH_BITS = 120
SPARE_BITS = 4   # directory cells for one expected shard: 2^4
FURTHER_BITS = 12  # bits that each further round looks at


def _bits(value):
    """60 bits of the MD5 of a string, as text."""
    return F.lpad(F.conv(F.substring(F.md5(value), 1, 15), 16, 2), 60, "0")


def _round(cells: DataFrame, start: int, end: int, max_bytes: int) -> DataFrame:
    """For each cell (a prefix of ``end`` bits with its sums): its shallowest
    prefix of ``start``..``end`` bits that fits, or null."""
    nodes = (cells.select("*", F.explode(F.sequence(F.lit(start), F.lit(end))).alias("depth"))
             .withColumn("shard", F.expr("substring(cell, 1, depth)")))
    sums = nodes.groupBy("depth", "shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    fits = sums.filter((F.col("shard_bytes") <= max_bytes) | (F.col("shard_docs") == 1))
    leaf = (nodes.select("cell", "depth", "shard").join(fits, ["depth", "shard"]).groupBy("cell")
            .agg(F.min_by(F.struct("shard", "depth", "shard_bytes", "shard_docs"), "depth").alias("leaf")))
    return cells.select("cell").join(leaf, "cell", "left")


def assign_shards(df: DataFrame, id_col: str, size_col: str, max_bytes: int) -> DataFrame:
    """``df`` with ``shard`` (bit prefix, empty for the root), ``depth``,
    ``shard_bytes``, ``shard_docs`` and ``oversize`` appended (an underscore
    is added to a name that ``df`` has already).

    ``size_col`` gives a row's bytes; null counts 0. A null id hashes as the
    empty string; equal ids are split by the row's own bits when they must be.
    An empty table gives no rows.
    """
    if max_bytes < 1:
        raise ValueError("max_bytes must be positive")
    rid, bits = fresh(df, "row_id", "bits")
    rows = df.withColumn(rid, F.monotonically_increasing_id())
    rows = staged(rows, "shard-rows")
    key = F.concat(_bits(F.coalesce(col(id_col).cast("string"), F.lit(""))), _bits(col(rid).cast("string")))
    rows = rows.withColumn(bits, key)
    keyed = rows.select(F.col(bits).alias("bits"), F.coalesce(col(size_col).cast("long"), F.lit(0)).alias("size"))

    total = keyed.agg(F.sum("size")).first()[0] or 0
    shards = max(1, math.ceil(total / max_bytes))
    start, end = 0, min(HASH_BITS, SPARE_BITS + math.ceil(math.log2(shards)))
    ends, found, large = [], [], None
    while True:
        cells = (keyed.withColumn("cell", F.substring("bits", 1, end)).groupBy("cell")
                 .agg(F.sum("size").alias("bytes"), F.count("*").alias("docs")))
        if large is not None:
            cells = cells.withColumn("above", F.substring("cell", 1, start)).join(
                large.withColumnRenamed("cell", "above"), "above", "left_semi").drop("above")
        tree = staged(_round(staged(cells, "cells"), start, end, max_bytes), "directory")
        ends.append(end)
        found.append(tree.filter("leaf is not null").select("cell", "leaf.*"))
        large = tree.filter("leaf is null").select("cell")
        if end == HASH_BITS or large.isEmpty():
            break
        large = small(staged(large, "large"))
        start, end = end, min(HASH_BITS, end + FURTHER_BITS)

    names = ["shard", "depth", "shard_bytes", "shard_docs"]
    out_names = fresh(df, *names, "oversize")
    at_cell, leaf = fresh(rows, "directory_cell", "directory_leaf")
    parts = []
    for at, directory in zip(ends, found):
        # a prefix that got no leaf in an earlier round is not in its directory
        directory = small(directory.select(F.col("cell").alias(at_cell), F.struct(*names).alias(leaf)))
        parts.append(rows.join(directory, F.substring(bits, 1, at) == F.col(at_cell)).select(
            *[col(c) for c in df.columns], *[F.col(f"{leaf}.{n}").alias(o) for n, o in zip(names, out_names)]))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.withColumn(out_names[4], F.col(out_names[2]) > max_bytes)


def write_shards(assigned: DataFrame, path: str, shard_col: str = "shard") -> None:
    """Write each shard as one folder ``shard=<bits>``; a shard fits one task
    by construction (its bytes are limited), so it is dealt to one."""
    named = assigned.withColumn(shard_col, F.concat(F.lit("b"), col(shard_col)))
    named.repartition(col(shard_col)).write.partitionBy(shard_col).parquet(path)
