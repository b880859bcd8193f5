"""The sparse one-hot against the plain one, and with many levels."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tessera.operators import sparse_hot
from tessera.operators.encode import OneHot
from tessera.operators.sparse_hot import SparseOneHot

ROWS = [(1, "b", 10), (2, "a", 2), (3, None, 1), (4, "b", None), (5, "é", 10), (6, "b", 10), (7, None, None)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "id int, c string, k int").repartition(3)


def test_equals_dense(spark, df):
    sparse, dense = SparseOneHot(["c", "k"]).fit(df), OneHot(["c", "k"]).fit(df)
    got = {r["id"]: r["one_hot"] for r in sparse.transform(df).collect()}
    want = {r["id"]: list(r)[1:] for r in dense.transform(df).collect()}
    assert sparse.size == 6 and {i: list(v.toArray()) for i, v in got.items()} == want
    assert all(isinstance(v, SparseVector) for v in got.values())
    names = [r["name"] for r in sparse.names().orderBy("position").collect()]
    assert names == dense.dummy_names() == ["c_a", "c_b", "c__", "k_1", "k_10", "k_2"]
    meta = sparse.transform(df).schema["one_hot"].metadata["ml_attr"]
    assert meta["num_attrs"] == 6 and [a["name"] for a in meta["attrs"]["binary"]] == names


def test_unseen_equal_names_and_empty(spark, df):
    hot = SparseOneHot(["c"]).fit(spark.createDataFrame([("a b",), ("a-b",), ("A_b",)], "c string"))
    assert [r["name"] for r in hot.names().orderBy("position").collect()] == ["c_A_b_0", "c_a_b_1", "c_a_b_2"]
    assert [r["v"].indices.tolist() for r in hot.transform(df.select("c"), "v").collect()] == [[]] * len(ROWS)
    none = SparseOneHot(["c"]).fit(df.limit(0))
    assert none.size == none.rows == 0 and none.transform(df, "v").first()["v"].size == 0


@pytest.mark.parametrize("population", [True, False])
def test_selection_by_variance(spark, df, population):
    hot = SparseOneHot(["c", "k"]).fit(df).selected(0.2, population)
    var = F.var_pop if population else F.var_samp
    dense = OneHot(["c", "k"]).fit(df)
    spread = dense.transform(df).agg(*[var(n).alias(n) for n in dense.dummy_names()]).first().asDict()
    want = [n for n in dense.dummy_names() if spread[n] > 0.2]
    assert want and [r["name"] for r in hot.names().orderBy("position").collect()] == want
    got = {r["id"]: r["one_hot"].toArray().tolist() for r in hot.transform(df).collect()}
    assert got == {r["id"]: [r[n] for n in want] for r in dense.transform(df).collect()}


def test_many_levels(spark):
    """100,000 levels, a third of the rows in one of them."""
    n = 150_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    hot = SparseOneHot(["k"]).fit(df)
    assert hot.size == 100_001 and hot.rows == n
    wide = hot.transform(df, "v")
    assert "attrs" not in wide.schema["v"].metadata["ml_attr"] and hot.size > sparse_hot.NAMED_PLACES
    both = VectorAssembler(inputCols=["id", "v"], outputCol="x").transform(wide)
    order = sorted({"0"} | {str(k) for k in range(n) if k % 3})
    place = {v: i for i, v in enumerate(order)}
    for r in both.filter("id % 997 = 0").collect():
        key = "0" if r["id"] % 3 == 0 else str(r["id"])
        assert r["v"] == SparseVector(100_001, [place[key]], [1.0])
        assert r["x"][1 + place[key]] == 1.0 and r["x"].size == 100_002
    assert hot.selected(0.1).size == 1
