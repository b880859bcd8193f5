"""Proven modes against plain counts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators.frequent import proven_modes
from tessera.operators.impute import ModeImputer


@pytest.fixture(scope="module")
def df(spark):
    """A hot value, a key, a near tie, a tie by number and an empty column, over several tasks."""
    i = F.col("id")
    return spark.range(20_000).repartition(5).select(
        "id", F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), i)).alias("hot"),
        F.when(i % 7 == 0, F.lit(None)).otherwise((i * i) % 1000).alias("many"),
        F.when(i % 2 == 0, 10).otherwise(2).alias("tie"), F.lit(None).cast("string").alias("none"))


COLUMNS = ["id", "hot", "many", "tie", "none"]


def plain(df, c):
    counts = Counter(r[0] for r in df.select(c).collect() if r[0] is not None)
    return min(counts, key=lambda v: (-counts[v], v), default=None)


@pytest.mark.parametrize("capacity, batch", [(1, 10_000), (1, 16), (8, 16), (1024, 64)])
def test_proven_modes_are_right(spark, df, capacity, batch):
    """What is proven is right, also when summaries are cut many times."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(batch))
    try:
        got = proven_modes(df, COLUMNS, capacity)
    finally:
        spark.conf.set(name, before)
    assert got["none"] is None and "id" not in got
    assert all(got[c] == str(plain(df, c)) for c in got if c != "none")
    if capacity > 1:
        assert got["hot"] == "hot" and got["tie"] == "2"
    if capacity > 1000:
        assert "many" in got
    elif batch == 16:
        assert "many" not in got


def test_imputer_falls_back(spark, df):
    modes = ModeImputer(COLUMNS).fit(df).modes
    assert modes == {c: plain(df, c) for c in COLUMNS}
    assert ModeImputer(["hot", "id"]).fit(df.limit(0)).modes == {"hot": None, "id": None}
