"""How often operators and queries read their rows, and how many pieces staged rows have."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import runtime
from tessera.operators import evaluate
from tessera.operators.models import GroupMean
from tessera.operators.moments import Bank
from tessera.operators.quantiles import _pivots, cell_quantiles
from tessera.plans import catalogue, catalogue_closed, catalogue_models
from tessera.sources import fixture

from .conftest import SF_SMALL


def counted(df):
    """``df`` and an accumulator of the rows that were read of it."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    return df.mapInArrow(run, df.schema), seen


def read_of_sales(spark, monkeypatch, module, query, name="sales"):
    """Rows that ``query`` reads of the sales view, as multiples of it."""
    view = getattr(fixture, name)(spark, SF_SMALL)
    df, seen = counted(view)
    monkeypatch.setattr(module, name, lambda *_: df)
    out = query(spark, SF_SMALL).collect()
    assert out
    return seen.value / view.count()


def test_pieces_grow_with_the_bytes(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/a b[1]%20"
    spark.range(5000).coalesce(1).write.parquet(folder)
    df = spark.read.parquet(folder.replace("[", r"\[").replace("]", r"\]"))
    monkeypatch.setattr(runtime, "SPREAD_BYTES", 1000)
    size = runtime.file_bytes(spark, df.inputFiles())
    assert size > 10_000
    want = max(spark.sparkContext.defaultParallelism, -(-size // 1000))
    assert runtime.spread(df).rdd.getNumPartitions() == want
    staged = runtime.stage(df, "grown")
    assert len(staged.inputFiles()) == want and staged.agg(F.sum("id")).first()[0] == 5000 * 4999 // 2
    monkeypatch.setattr(runtime, "SPREAD_BYTES", 1 << 30)
    assert runtime.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_oof_means_read_rows_twice(spark):
    rows = spark.createDataFrame([(i, f"g{i % 7}" if i % 11 else None, i % 3, float(i * i % 17)) for i in range(200)],
                                 "k long, g string, fold int, y double")
    df, seen = counted(rows)
    out = evaluate.oof_group_mean(df, "y", "g").collect()
    assert len(out) == 200 and seen.value <= 400
    for r in out:
        others = [x["y"] for x in out if x["fold"] != r["fold"] and x["g"] == r["g"]] if r["g"] else [x["y"] for x in out if x["fold"] != r["fold"]]
        assert r["oof"] == pytest.approx(np.mean(others))


@pytest.mark.parametrize("name, module, query, view", [
    ("rmsle_score", catalogue_models, catalogue_models.rmsle_score, "sales"),
    ("seed_average", catalogue_models, catalogue_models.seed_average, "sales"),
    ("variance_filter", catalogue, catalogue.variance_filter, "sales"),
    ("pca_closed_form", catalogue_closed, catalogue_closed.pca_closed_form, "labelled"),
    ("stack_closed_cv", catalogue_closed, catalogue_closed.stack_closed_cv, "sales"),
])
def test_queries_join_their_tables_once(spark, monkeypatch, name, module, query, view):
    most = 2 if name in ("rmsle_score", "seed_average") else 1
    assert read_of_sales(spark, monkeypatch, module, query, view) <= most


def test_mean_of_group_means_joins_once(spark):
    rows = [(i, f"g{i % 4}" if i % 9 else None, float(i % 13)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, g string, y double")
    score = spark.createDataFrame([(i, g) for i, g in enumerate(["g0", "g1", "g3", "other", None, "g0"])], "k long, g string")
    for by in ("g", None):
        fits = [GroupMean(by).fit(df.filter(where), [], "y") for where in ("k % 3 <> 0", "g <> 'g1'", "k < 20")]
        cur = score
        for i, f in enumerate(fits):
            cur = f.predict(cur, f"p{i}")
        want = {r["k"]: np.mean([r["p0"], r["p1"], r["p2"]]) for r in cur.collect()}
        one = type(fits[0]).mean(fits).predict(score, "p")
        assert {r["k"]: r["p"] for r in one.collect()} == pytest.approx(want)
        assert one._jdf.queryExecution().optimizedPlan().toString().count("Join") == (by is not None)


def test_pivots_of_sorted_and_uneven_values(spark):
    x = np.sort(np.random.default_rng(0).exponential(size=40_000))
    df = spark.createDataFrame([(int(i % 3) if i % 10 else None, float(v)) for i, v in enumerate(x)], "cell int, c0 double").coalesce(2)
    pivots, = _pivots(df.select(F.lit(0).alias("__cell"), "c0"), 1, [.25, .5, .75])
    assert len(pivots) <= 21
    for p in (.25, .5, .75):
        ranks = np.searchsorted(x, pivots) / len(x)
        assert ranks[np.argmin(abs(ranks - p))] == pytest.approx(p, abs=.01)
    # rows in no cell are in no part
    got = cell_quantiles(df, ["c0"], [.25, .5, .75], F.col("cell"), {"all": [0, 1, 2], "some": [0, 2]}, 2000)
    i = np.arange(len(x))
    assert got["all"]["c0"] == pytest.approx(np.quantile(x[i % 10 != 0], [.25, .5, .75]).tolist())
    assert got["some"]["c0"] == pytest.approx(np.quantile(x[(i % 10 != 0) & (i % 3 != 1)], [.25, .5, .75]).tolist())


def test_moments_read_few_times(spark):
    """Means and deviations of 30 columns take one pass; the others are for those without digits left."""
    rng = np.random.default_rng(3)
    data = {f"a{i}": rng.normal(size=200) * 10.0 ** i + 5 for i in range(-2, 8)} | {
        "flat": np.full(200, 0.1), "far": 1e9 + rng.normal(size=200)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in np.column_stack(list(data.values()))], list(data)).withColumn("y", F.col("a1") * 2)
    df, seen = counted(df)
    shift, scale = Bank(df, [c for c in data if c[0] == "a"], "y", {}).units()
    assert seen.value == 200
    shift, scale = Bank(df, list(data), "y", {}).units()
    assert seen.value == 600
    x = np.column_stack([*data.values(), data["a1"] * 2])
    assert shift == pytest.approx(x.mean(axis=0), rel=1e-9)
    flat = list(data).index("flat")
    assert np.delete(scale, flat) == pytest.approx(np.delete(x.std(axis=0), flat), rel=1e-5)


def test_joined_rows_are_staged_once(spark, monkeypatch):
    """A join that leaves pieces enough is written as it is; one of few pieces is dealt out."""
    want = spark.sparkContext.defaultParallelism
    pieces = [want + 2]
    monkeypatch.setattr(runtime, "spread_pieces", lambda df: pieces[0])
    written = []
    monkeypatch.setattr(runtime, "_written", lambda df, name, old=runtime._written: written.append(name) or old(df, name))
    many = runtime.stage_joined(spark.range(1000).repartition(want + 1), "many")
    assert written == ["many"] and many.count() == 1000
    few = runtime.stage_joined(spark.range(1000).withColumn("a`b", F.lit(None).cast("string")).coalesce(1).withColumnRenamed("a`b", "a.b"), "few")
    assert written == ["many", "few", "few"] and len(few.inputFiles()) == want + 2
    assert sorted(r["id"] for r in few.collect()) == list(range(1000))
    pieces[0] = want                # small tables are dealt out at once, as by stage
    small = runtime.stage_joined(spark.range(1000).coalesce(1), "small")
    assert written == ["many", "few", "few", "small"] and len(small.inputFiles()) == want


def test_staged_features_hold_what_is_read(spark, monkeypatch):
    """The encoded table of the feature chain holds no column that nothing reads later."""
    from tessera.plans import features
    staged = {}
    for of in ("stage", "stage_joined"):
        monkeypatch.setattr(features, of, lambda df, name, old=getattr(features, of): staged.setdefault(name, df.columns) and old(df, name))
    features.SalesFeatures(fit_on="all").build(spark, SF_SMALL)
    assert set(staged["sales-encoded"]) == {*features.KEY, "split", "y", *features.NUMERIC, *features.NOMINAL}
