"""Fits from a bank of moments against fits on the rows themselves."""

import tracemalloc

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tessera.operators.evaluate import LinearCV, balanced_folds, bank_grid_scores, linear_grid_cv
from tessera.operators.models import PolyRidge, elastic_net, lasso, linear_params, ridge
from tessera.operators import moments
from tessera.operators.moments import Bank, ridge_loo, summed
from tessera.operators.select import pairwise_correlation

FEATS = ["a", "b", "c", "d"]


def dims():
    return {"outer": (F.col("outer"), 3), "fold": (F.col("fold"), 4)}


PARTS = [{}, {"outer": 1}, {"fold": 2}, {"outer": 2, "fold": 0}]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    n = 900
    x = rng.normal(size=(n, 4)) * [1, 300, 0.02, 5] + [0, 4000, 1, -7]
    x[:, 3] = (x[:, 3] > -7).astype(float)
    y = 2 + x @ [0.7, -0.002, 9, 0.4] + 0.2 * x[:, 0] ** 2 + rng.normal(scale=0.3, size=n)
    outer, fold = rng.integers(0, 3, n), rng.integers(0, 4, n)
    rows = [(i, int(outer[i]), int(fold[i]), float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, outer int, fold int, y double, a double, b double, c double, d double").repartition(5).persist()
    return df, x, y, outer, fold


def rows_of(part, outer, fold):
    keep = np.ones(len(outer), bool)
    for name, f in part.items():
        keep &= {"outer": outer, "fold": fold}[name] != f
    return keep


def scaled(x):
    q = np.quantile(x, [.25, .5, .75], axis=0)
    spread = q[2] - q[0]
    return np.where(spread == 0, 1.0, spread)


@pytest.mark.parametrize("part", PARTS)
def test_parts_equal_direct_fits(spark, table, part):
    df, x, y, outer, fold = table
    bank = Bank(df, FEATS, "y", dims(), PARTS)
    keep = rows_of(part, outer, fold)
    assert np.allclose(bank.spread(part, FEATS), scaled(x[keep]), rtol=1e-12)
    there = df.filter(" AND ".join(f"{n} <> {f}" for n, f in part.items()) or "true")
    for model in (lasso(0.01), elastic_net(0.02, 0.5), ridge(10.0), PolyRidge(0.6, 2.5)):
        one, direct = model.fit_bank(bank, FEATS, part), model.fit(there, FEATS, "y")
        got, want = ([r.p for r in m.predict(df, "p").orderBy("k").collect()] for m in (one, direct))
        assert np.allclose(got, want, rtol=1e-6, atol=1e-6), model.name


@pytest.mark.parametrize("kind,alpha,rho", [("lasso", 0.02, 1.0), ("elastic_net", 0.05, 0.6)])
def test_moment_rows_stand_for_the_table(spark, table, kind, alpha, rho):
    """Spark's own fit on all rows, and on the few rows with their moments."""
    df, x, y, _, _ = table
    s = scaled(x)
    src = df.select("y", *[(F.col(c) / float(v)).alias(c) for c, v in zip(FEATS, s)])
    reg, en = linear_params(kind, alpha, len(y), float(y.std()), rho)
    whole = LinearRegression(labelCol="y", regParam=reg, elasticNetParam=en, standardization=False, solver="normal", maxIter=500, tol=1e-10).fit(
        VectorAssembler(inputCols=FEATS, outputCol="features").transform(src))
    few = Bank(df, FEATS, "y", {}).linear({}, FEATS, kind, alpha, rho, s)
    assert np.allclose(few.coef * s, whole.coefficients.toArray(), atol=1e-7)
    assert few.intercept == pytest.approx(whole.intercept, abs=1e-5)


def test_search_over_alpha_runs_no_fit_job(spark, table, monkeypatch):
    """Lasso fits that are only scored equal Spark's and are not fitted by it."""
    df, x, y, _, _ = table
    bank = Bank(df, FEATS, "y", dims())
    alphas, spread = [0.0005, 0.02, 0.3], scaled(x)
    want = moments.linear_path(df, bank.gram({}, FEATS), FEATS, "lasso", alphas, 1.0, spread)
    monkeypatch.setattr(moments.LinearRegression, "fit", lambda *a: pytest.fail("a Spark fit"))
    got = moments.scored_path(df, bank.gram({}, FEATS), FEATS, "lasso", alphas, spread)
    for g, w in zip(got, want):
        assert np.allclose(g.coef * spread, w.coef * spread, atol=1e-7) and g.intercept == pytest.approx(w.intercept, abs=1e-5)
    assert len(bank_grid_scores(bank, FEATS, "lasso", alphas, 4, {}, spread)) == 12


@pytest.mark.parametrize("l1", [0.0, 0.001, 0.05, 0.4, 3.0])
def test_penalised_reaches_the_optimum(l1):
    """Of features that add up to others, equal ones and one without variance, too."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 5))
    x = np.column_stack([x, x[:, 0] + x[:, 1], x[:, 2], np.zeros(200), x @ np.ones(5)])
    y = x[:, :5] @ [1.0, -2.0, 0.3, 0.0, 0.01] + rng.normal(size=200)
    a, b = x.T @ x / 200, x.T @ y / 200
    w = moments.penalised(a, b, l1, 0.0)
    rest = b - a @ w
    assert w[7] == 0 and (np.abs(rest) <= l1 + 1e-6).all() and np.allclose(rest[w != 0], l1 * np.sign(w[w != 0]), atol=1e-6)


def test_features_of_a_part(table):
    """A bank over all features serves fits on some of them."""
    df, *_ = table
    bank = Bank(df, FEATS, "y", {})
    for model in (ridge(3.0), PolyRidge(0.6, 2.5)):
        a, b = model.fit_bank(bank, ["c", "a"], {}), model.fit(df, ["c", "a"], "y")
        got, want = ([r.p for r in m.predict(df, "p").orderBy("k").collect()] for m in (a, b))
        assert np.allclose(got, want, rtol=1e-7)


@pytest.mark.parametrize("part", [{}, {"outer": 0}])
def test_ridge_loo_is_leave_one_out(table, part):
    df, x, y, outer, fold = table
    bank = Bank(df, FEATS, "y", dims(), [{}, {"outer": 0}])
    keep = rows_of(part, outer, fold)
    x, y = x[keep] / scaled(x[keep]), y[keep]
    alphas = [0.1, 15.0, 500.0]
    got = ridge_loo(df, bank, FEATS, alphas, [part])[0]
    for a, mse in zip(alphas, got):
        errors = []
        for i in range(len(y)):
            rest = np.arange(len(y)) != i
            m, my = x[rest].mean(axis=0), y[rest].mean()
            w = np.linalg.solve((x[rest] - m).T @ (x[rest] - m) + a * np.eye(4), (x[rest] - m).T @ (y[rest] - my))
            errors.append(y[i] - my - (x[i] - m) @ w)
        assert mse == pytest.approx(np.mean(np.square(errors)), rel=1e-9)
    member = LinearCV("ridge", alphas)
    member.fit_bank(bank, FEATS, part)
    assert member.best == alphas[int(np.argmin(got))]


def test_lasso_search_on_a_part(table):
    """The search of a member inside a training part is that of the part alone."""
    df, *_ = table
    member = LinearCV("lasso", [0.001, 0.05, 0.8], 3, 5)
    bank = Bank(df, FEATS, "y", {**dims(), **member.dims(FEATS, "y")}, [{"outer": 1}])
    one = member.fit_bank(bank, FEATS, {"outer": 1})
    alone = LinearCV("lasso", [0.001, 0.05, 0.8], 3, 5)
    two = alone.fit(df.filter("outer <> 1"), FEATS, "y")
    assert member.best == alone.best and np.allclose(one.coef, two.coef, atol=1e-6)


def test_one_pass_whatever_the_parts(spark, table):
    df, *_ = table
    bank = Bank(df, FEATS, "y", dims(), PARTS)
    bank.grams(), bank.terms(), bank.quartiles({})
    spark.sparkContext.setJobGroup("bank", "bank")
    for part in PARTS:
        ridge(2.0).fit_bank(bank, FEATS, part)
        PolyRidge().fit_bank(bank, FEATS, part)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("bank")


def test_missing_values_are_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (float("nan"), 1.0)], "a double, y double")
    for rows in (df, df.filter("a is not null")):
        with pytest.raises(Exception, match="null or not finite"):
            ridge(1.0, scale=False).fit(rows, ["a"], "y")


def test_grid_scores_equal_on_bank_and_rows(table):
    df, *_ = table
    bank = Bank(df, FEATS, "y", dims())
    got = {(a, f): r for a, f, r in bank_grid_scores(bank, FEATS, "ridge", [1.0, 50.0], 4)}
    _, want = linear_grid_cv(df, FEATS, "y", "ridge", [1.0, 50.0])
    assert got == pytest.approx({(r.alpha, r.fold): r.rmsle for r in want.collect()}, rel=1e-9)


def test_balanced_folds(spark, monkeypatch):
    from tessera.operators import evaluate
    df = spark.range(1003).select((F.col("id") % 700).alias("k"), F.col("id"))
    for chunk in (20_000, 40, 2):
        monkeypatch.setattr(evaluate, "FOLD_CHUNK", chunk)
        out = balanced_folds(df.repartition(7), ["k"], 5, 3, ties=["id"])
        rows = {r.id: r.fold for r in out.collect()}
        sizes = np.bincount(list(rows.values()))
        assert len(rows) == 1003 and len(sizes) == 5 and sizes.max() - sizes.min() == 1
        assert rows == {r.id: r.fold for r in balanced_folds(df.coalesce(1).orderBy(F.desc("id")), ["k"], 5, 3, ties=["id"]).collect()}
    assert rows != {r.id: r.fold for r in balanced_folds(df, ["k"], 5, 4, ties=["id"]).collect()}


def test_pairwise_correlation_with_gaps(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 6)) @ rng.normal(size=(6, 6)) + 1e4
    x[:, 5] = 3.0
    x[rng.random(x.shape) < 0.3] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(x)],
                               ", ".join(f"c{i} double" for i in range(6))).repartition(4)
    got = pairwise_correlation(df, df.columns)
    for i in range(5):
        for j in range(5):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert got[i, j] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert np.isnan(got[5]).all()


def test_sums_take_little_driver_memory(spark):
    """Sums of many cells come as arrays: rows of Python numbers took four times the matrices."""
    size, cells = 160, 12
    rng = np.random.default_rng(3)
    x = rng.normal(size=(cells, size))
    df = spark.createDataFrame([(c,) for c in range(cells)] * 2, "c int").repartition(3)

    def partial(batch):
        for c in batch.column(0).to_pylist():
            yield c, np.outer(x[c], x[c])

    tracemalloc.start()
    found = summed(df, partial, size)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(found) == list(range(cells))
    assert all(np.allclose(found[c], 2 * np.outer(x[c], x[c]), rtol=1e-14) and (found[c] == found[c].T).all() for c in found)
    assert most < 2 * cells * size * size * 8


def test_quadratic_fits_copy_no_bank(spark, table):
    """Cells are added up one by one: a fit holds no copy of all of a part's cells."""
    df = table[0]
    bank = Bank(df, FEATS, "y", {"outer": (F.col("outer"), 3), "many": (F.col("k") % 200, 200)})
    terms, _ = bank.terms()
    tracemalloc.start()
    PolyRidge(0.6, 2.5).fit_bank(bank, FEATS, {"outer": 1})
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(terms) == 600 and most < 400 * terms[0].nbytes / 2
