"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.runtime import ensure_checkpoint_dir

# A lookup table is broadcast only when it has at most this many rows (each
# row is a few dozen bytes, so about 10 MB); beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def col(name: str) -> Column:
    """Column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that do not clash (case-insensitively) with ``df``'s."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder, read it back.

    Cuts the lineage: a lost executor re-reads the file, and every later use
    sees the same rows (which fixes ``monotonically_increasing_id``).
    """
    return appended([df], name)


def appended(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """:func:`staged` for frames of one schema that are written one after the other;
    the next one is asked for when the one before is written."""
    path = None
    for df in parts:
        spark = df.sparkSession
        path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
        df.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint if ``df`` (staged, so counting it is cheap) has at most
    ``rows`` rows; otherwise unchanged, and the join shuffles."""
    return F.broadcast(df) if df.count() <= rows else df
