"""Quantiles of all training parts from cell counts, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import quantiles
from tessera.operators.quantiles import cell_quantiles, leave_one_out

PROBS = [.25, .5, .75]


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(4)
    n = 4000
    data = {"normal": rng.normal(size=n), "skewed": rng.exponential(size=n) ** 3, "flag": (rng.random(n) < 0.03).astype(float),
            "few": rng.integers(0, 4, n).astype(float), "gaps": np.where(rng.random(n) < 0.7, np.nan, rng.normal(size=n)),
            "hot": np.where(rng.random(n) < 0.6, 7.0, rng.normal(size=n) + 7), "none": np.full(n, np.nan), "one": np.full(n, -0.0)}
    fold = rng.integers(0, 5, n)
    rows = [(int(fold[i]), *[None if i % 2 and np.isnan(v[i]) else float(v[i]) for v in data.values()]) for i in range(n)]
    df = spark.createDataFrame(rows, "fold int, " + ", ".join(f"{c} double" for c in data)).repartition(5).persist()
    return df, data, fold


@pytest.mark.parametrize("gather", [10**6, 900, 60])
def test_leave_one_fold_out(numbers, gather):
    """The same numbers whether all is gathered, sliced once or several times."""
    df, data, fold = numbers
    got = cell_quantiles(df, list(data), PROBS, F.col("fold"), leave_one_out(5), gather)
    for part in (None, *range(5)):
        rows = np.ones(len(fold), bool) if part is None else fold != part
        for c, x in data.items():
            x = x[rows]
            x = x[~np.isnan(x)]
            assert got[part].get(c) == (pytest.approx(np.quantile(x, PROBS).tolist(), abs=1e-12) if len(x) else None)


def test_few_jobs(spark, numbers):
    df, data, _ = numbers
    group = "quantile-jobs"
    spark.sparkContext.setJobGroup(group, group)
    cell_quantiles(df, list(data), PROBS, F.col("fold"), leave_one_out(5), 1500)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # a shuffle under adaptive execution is a job of its own: count, pivots, counts, values
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 8


def test_empty_and_single(spark):
    df = spark.createDataFrame([(1.5, None)], "a double, b double")
    assert cell_quantiles(df, ["a", "b"], PROBS) == {None: {"a": [1.5, 1.5, 1.5]}}
    assert cell_quantiles(df.limit(0), ["a", "b"], PROBS) == {None: {}}
    assert cell_quantiles(df, [], PROBS) == {None: {}}
