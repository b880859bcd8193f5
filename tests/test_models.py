"""Models against closed forms and basic quality / shape properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.ensemble import SeedAverage, Stacking
from tessera.operators.evaluate import assign_folds, linear_grid_cv, rmsle
from tessera.operators.models import (GroupMean, Linear, PolyRidge, Trees, base_models,
                                      meta_model)

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def toy(spark):
    rng = np.random.default_rng(7)
    n, p = 400, 4
    x = rng.normal(size=(n, p)) * np.array([1.0, 3.0, 0.5, 2.0])
    y = 1.5 + x @ np.array([0.8, -0.2, 0.0, 0.05]) + rng.normal(scale=0.3, size=n)
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, y double, a double, b double, c double, d double")
    return df, x, y


FEATS = ["a", "b", "c", "d"]


def _coef(fitted):
    m = fitted.model
    return np.array(m.coefficients.toArray()), m.intercept


def test_ridge_matches_closed_form(toy):
    df, x, y = toy
    alpha = 10.0
    w, b = _coef(Linear("ridge", alpha, 0.0, False).fit(df, FEATS, "y"))
    xc, yc = x - x.mean(0), y - y.mean()
    w_ref = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc)
    assert np.allclose(w, w_ref, atol=1e-6)
    assert b == pytest.approx(y.mean() - x.mean(0) @ w_ref, abs=1e-6)


@pytest.mark.parametrize("kind,alpha,rho", [("lasso", 0.05, 1.0), ("elastic_net", 0.05, 0.5)])
def test_l1_models_satisfy_kkt(toy, kind, alpha, rho):
    df, x, y = toy
    w, b = _coef(Linear(kind, alpha, rho, False).fit(df, FEATS, "y"))
    n = len(y)
    r = y - x @ w - b
    assert abs(r.mean()) < 1e-6                          # intercept is unpenalised
    g = x.T @ r / n - alpha * (1 - rho) * w              # smooth part of the gradient
    for j in range(4):
        if abs(w[j]) > 1e-8:
            assert g[j] == pytest.approx(alpha * rho * np.sign(w[j]), abs=1e-4)
        else:
            assert abs(g[j]) <= alpha * rho + 1e-4
    assert abs(w[2]) < 1e-8                               # the null coefficient is cut


def test_poly_ridge_equals_dual_kernel_ridge(spark, toy):
    df, x, y = toy
    fitted = PolyRidge(alpha=0.6, coef0=2.5).fit(df, FEATS, "y")
    pred = np.array([r.p for r in fitted.predict(df, "p").orderBy("k").collect()])
    gamma = 1.0 / 4
    k = (gamma * x @ x.T + 2.5) ** 2
    dual = np.linalg.solve(k + 0.6 * np.eye(len(y)), y)
    assert np.allclose(pred, k @ dual, rtol=1e-6, atol=1e-6)


def test_grid_cv_picks_from_grid(toy):
    df, _, _ = toy
    folded = assign_folds(df, ["k"], 4, 1)
    best, table = linear_grid_cv(folded, FEATS, "y", "ridge", [0.1, 1000.0], k=4)
    assert best == 0.1 and table.count() == 8


@pytest.fixture(scope="module")
def sales_features(spark):
    from tessera.plans.catalogue_models import feature_table
    df, feats = feature_table(spark, SF_SMALL)
    return df, feats


def test_trees_beat_mean_predictor(sales_features):
    df, feats = sales_features
    tr = df.filter(F.col("split") == "train")
    folded = assign_folds(tr, ["l_orderkey", "l_linenumber"], 4, 3)
    fit_rows, held = folded.filter("fold != 0"), folded.filter("fold = 0")
    base = rmsle(GroupMean().fit(fit_rows, [], "y").predict(held, "p"), "y", "p").first()[0]
    for model in [Trees("gbt", dict(maxIter=10, maxDepth=4, stepSize=0.3, seed=1)),
                  Trees("forest", dict(numTrees=10, maxDepth=6, seed=1))]:
        score = rmsle(model.fit(fit_rows, feats, "y").predict(held, "p"), "y", "p").first()[0]
        assert score < 0.5 * base


def test_stack_oof_one_row_per_key_and_seed_average(sales_features):
    df, feats = sales_features
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    tr, te = df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")

    def make(seed):
        return Stacking(base_models("small", seed, 3)[1:5], meta_model("small", seed, 3), key, k=2,
                        seed=seed)

    fitted = make(42).fit(tr, feats, "y")
    n_train = tr.count()
    assert fitted.oof.count() == n_train
    assert fitted.oof.select(*key).distinct().count() == n_train
    avg = SeedAverage(make, (1, 2)).fit(tr, feats, "y")
    out = avg.predict(te.select(*key, *feats), "p")
    assert out.count() == te.count() and out.filter(F.col("p").isNull()).count() == 0


def test_topk_selector_quantile_bins(spark):
    from tessera.operators.select import TopKSelector
    rng = np.random.default_rng(3)
    n = 3000
    a = rng.normal(size=n)
    noise = rng.normal(size=n)
    b = rng.normal(size=n)
    y = np.sin(a) * 2 + 0.5 * b + rng.normal(scale=0.1, size=n)
    df = spark.createDataFrame([(float(a[i]), float(noise[i]), float(b[i]), float(y[i]))
                                for i in range(n)], "a double, noise double, b double, y double")
    sel = TopKSelector(["a", "noise", "b"], "y", k=2).fit(df)
    assert sel.kept == ["a", "b"]
    assert sel.transform(df).columns == ["a", "b", "y"]
    assert TopKSelector(["a", "noise"], "y", k=200).fit(df).kept == ["a", "noise"]


def test_ridge_on_gramian_matches_spark_fit(toy):
    from tessera.operators.evaluate import fold_gramians, ridge_on_gramian
    df, x, y = toy
    g = fold_gramians(df.withColumn("f", F.lit(0)), FEATS, "y", "f", 1)[0]
    w, b = ridge_on_gramian(g, 10.0)
    w_s, b_s = _coef(Linear("ridge", 10.0, 0.0, False).fit(df, FEATS, "y"))
    assert np.allclose(w, w_s, atol=1e-5) and b == pytest.approx(b_s, abs=1e-5)


@pytest.mark.parametrize("kind", ["ridge", "lasso"])
def test_grid_scores_are_those_of_single_fits(toy, kind):
    df, _, _ = toy
    folded = assign_folds(df, ["k"], 3, 1)
    best, table = linear_grid_cv(folded, FEATS, "y", kind, [0.05, 5.0], k=3)
    for r in table.collect():
        fit = Linear(kind, r.alpha, 1.0, False).fit(folded.filter(F.col("fold") != r.fold), FEATS, "y")
        held = fit.predict(folded.filter(F.col("fold") == r.fold), "p")
        assert rmsle(held, "y", "p").first()[0] == pytest.approx(r.rmsle, rel=1e-5)
    assert best == 0.05 and table.count() == 6


def test_mean_of_poly_models_predicts_mean(toy):
    df, _, _ = toy
    fits = [PolyRidge().fit(df.filter(F.col("k") % 2 == i), FEATS, "y") for i in (0, 1)]
    each = [[r.p for r in m.predict(df, "p").orderBy("k").collect()] for m in (*fits, fits[0].mean(fits))]
    assert np.allclose((np.array(each[0]) + np.array(each[1])) / 2, each[2])


def test_best_ensemble_has_six_members_and_stops_early(sales_features):
    assert [m.name for m in base_models()] == ["lasso", "elastic_net", "poly_ridge", "gbt_robust", "gbt_xgb", "gbt_cat"]
    assert [m.name for m in base_models() if getattr(m, "stop_on_held_out", False)] == ["gbt_xgb", "gbt_cat"]
    df, feats = sales_features
    tr = df.filter(F.col("split") == "train")
    booster = Trees("gbt", dict(maxIter=40, stepSize=0.9, maxDepth=5, validationTol=0.3, seed=1), name="b", stop_on_held_out=True)
    fitted = Stacking([booster], GroupMean(), ["l_orderkey", "l_linenumber"], k=2).fit(tr, feats, "y")
    assert all(len(m.model.trees) < 40 for m in fitted.fold_models["b"])


def test_heldout_sse_from_gramian(toy):
    from tessera.operators.evaluate import fold_gramians, heldout_sse
    df, x, y = toy
    folded = df.withColumn("f", (F.col("k") % 2).cast("int"))
    g = fold_gramians(folded, FEATS, "y", "f", 2)
    w, b = np.array([0.5, -0.1, 0.2, 0.0]), 1.0
    sse, n = heldout_sse(g[1], w, b)
    odd = np.arange(len(y)) % 2 == 1
    assert n == odd.sum()
    assert sse == pytest.approx(((y[odd] - b - x[odd] @ w) ** 2).sum(), rel=1e-9)


@pytest.mark.parametrize("preset", ["documented", "third_party"])
def test_ensemble_presets_run(spark, sales_features, preset):
    from tessera.plans.pipeline import PRESET_WEIGHTS, Options, predict_prices
    df, feats = sales_features
    opts = Options(preset=preset, seeds=(42,), folds=2, trees=2, cv_folds=2, lasso_folds=2, top_k=10, clip=None)
    out = predict_prices(df, feats, opts)
    n_test = df.filter(F.col("split") == "test").count()
    rows = out.collect()
    assert len(rows) == n_test and all(r.log_prediction is not None for r in rows)
    assert abs(sum(PRESET_WEIGHTS[preset].values()) - 1.0) < 1e-9


def test_registered_ensembles_are_whole(monkeypatch):
    """Six members under the booster, five folds, three seeds, ten lasso folds."""
    import inspect

    import __spark_entry__ as entry_point
    from tessera.plans import catalogue_models as cm
    stack = cm.small_stack()
    assert len(stack.bases) == 6 and stack.meta.name == "meta_gbt" and stack.k == 5
    assert inspect.signature(cm.cv_scores).parameters["k"].default == 5
    seen = []
    monkeypatch.setattr(entry_point, "run", lambda spark, d, opts: seen.append(opts))
    monkeypatch.setattr(entry_point, "ensure_checkpoint_dir", lambda spark: None)
    entry_point.entry(None)
    for name in ("ensemble_predictions", "ensemble_cv", "ensemble_documented", "ensemble_third_party"):
        entry_point.queries()[name](None, "")
    assert {(o.seeds, o.folds, o.outer_folds, o.cv_folds, o.lasso_folds) for o in seen} == {((42, 123, 456), 5, 5, 5, 10)}


@pytest.mark.parametrize("p,corr", [(4, 0.0), (9, 0.6)])
def test_matrix_free_poly_equals_dense(spark, p, corr):
    from tessera.operators.moments import Bank
    from tessera.operators.quadratic import fit_quadratic
    rng = np.random.default_rng(3)
    n = 500
    x = rng.normal(size=(n, p)) * np.linspace(0.5, 4, p) + corr * rng.normal(size=(n, 1)) + np.linspace(-2, 3, p)
    x[:, 0] = (x[:, 0] > 0).astype(float)
    y = 10 + x @ rng.normal(size=p) + 0.3 * x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.2
    names = [f"c{i}" for i in range(p)]
    df = spark.createDataFrame([(int(i % 3), float(y[i]), *map(float, x[i])) for i in range(n)],
                               "f int, y double, " + ", ".join(f"{c} double" for c in names)).repartition(3).persist()
    bank = Bank(df, names, "y", {"f": (F.col("f"), 3)})
    parts = [{}, {"f": 1}]
    for part, got in zip(parts, fit_quadratic(bank, names, parts, 0.6, 2.5, None)):
        want = bank.poly(part, names, 0.6, 2.5, None)
        a, b = (m.b + x @ m.l + ((x @ (m.q + m.q.T) / 2) * x).sum(axis=1) for m in (got, want))
        assert np.abs(a - b).max() < 1e-6 * np.abs(b).max()
    assert PolyRidge().dense(50) and not PolyRidge().dense(200)


def _huber_plain(y, leaves, rounds, step, quantile):
    """Row by row, with the trees' own leaves."""
    now, out = np.full(len(y), np.median(y)), []
    for leaf in leaves[:rounds]:
        r = y - now
        delta = np.quantile(np.abs(r), quantile)
        values = {}
        for k in np.unique(leaf):
            m = np.median(r[leaf == k])
            values[k] = m + np.clip(r[leaf == k] - m, -delta, delta).mean()
        now = now + step * np.array([values[k] for k in leaf])
        out.append((delta, values))
    return now, out


def test_huber_boosting(spark):
    """Equal to a plain replay on the same leaves, and better than absolute loss
    with the same trees on a smooth target with outliers."""
    from tessera.operators.huber import HuberBoost
    rng = np.random.default_rng(8)
    n = 600
    x = rng.uniform(-2, 2, size=(n, 3))
    clean = 3 * np.sin(x[:, 0]) + x[:, 1]
    y = clean + rng.normal(scale=0.2, size=n) + np.where(rng.random(n) < 0.08, rng.choice([-30, 30], n), 0)
    df = spark.createDataFrame([(i, float(y[i]), *map(float, x[i])) for i in range(n)], "k long, y double, a double, b double, c double")
    fitted = HuberBoost(12, 0.3, 0.9, dict(maxDepth=3, minInstancesPerNode=5, seed=1)).fit(df, ["a", "b", "c"], "y")
    got = np.array([r.p for r in fitted.predict(df, "p").orderBy("k").collect()])
    from tessera.operators.models import with_vector
    rows = with_vector(df, ["a", "b", "c"])
    leaves = [np.array([int(r[0]) for r in t.transform(rows).orderBy("k").select(t.getLeafCol()).collect()]) for t in fitted.trees]
    want, steps = _huber_plain(y, leaves, 12, 0.3, 0.9)
    assert np.allclose(got, want, atol=1e-9) and np.allclose(fitted.deltas, [d for d, _ in steps])
    # a feature drawn per split: roots differ, the replay holds
    drawn = HuberBoost(6, 0.3, 0.9, dict(maxDepth=2, featureSubsetStrategy="1", seed=1)).fit(df, ["a", "b", "c"], "y")
    assert len({t.toDebugString.split("feature ")[1][0] for t in drawn.trees}) > 1
    leaves = [np.array([int(r[0]) for r in t.transform(rows).orderBy("k").select(t.getLeafCol()).collect()]) for t in drawn.trees]
    drawn = np.array([r.p for r in drawn.predict(df, "p").orderBy("k").collect()])
    assert np.allclose(drawn, _huber_plain(y, leaves, 6, 0.3, 0.9)[0], atol=1e-9)
    absolute = Trees("gbt", dict(maxIter=12, stepSize=0.3, maxDepth=3, minInstancesPerNode=5, lossType="absolute", seed=1)).fit(df, ["a", "b", "c"], "y")
    other = np.array([r.p for r in absolute.predict(df, "p").orderBy("k").collect()])
    assert np.sqrt(((got - clean) ** 2).mean()) < np.sqrt(((other - clean) ** 2).mean())


def test_patience_takes_the_best_round(spark):
    from tessera.operators.models import best_round, with_vector
    assert best_round([5, 4, 3, 3.5, 3.6, 1], 2) == 3 and best_round([5, 4, 3, 3.5, 3.6, 1], 9) == 6 and best_round([1, 1, 1], 5) == 1
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = x[:, 0] + rng.normal(scale=1.5, size=300)
    df = spark.createDataFrame([(i, bool(i % 3 == 0), float(y[i]), *map(float, x[i])) for i in range(300)],
                               "k long, held boolean, y double, a double, b double, c double").coalesce(1)
    feats, params = ["a", "b", "c"], dict(maxIter=15, stepSize=0.5, maxDepth=3, seed=2)
    model = Trees("gbt", params, early_stop_col="held", patience=4)
    fitted = model.fit(df, feats, "y")
    whole = Trees("gbt", params).fit(df.filter("not held"), feats, "y")
    held = with_vector(df.filter("held"), feats)
    each = np.array([[r[0] for r in t.copy({t.predictionCol: "t"}).transform(held).orderBy("k").select("t").collect()] for t in whole.model.trees])
    truth = np.array([r.y for r in held.orderBy("k").collect()])
    series = [float(((np.array(whole.model.treeWeights[:n]) @ each[:n] - truth) ** 2).mean()) for n in range(1, 16)]
    assert np.allclose(series, model.errors)
    want = best_round(series, 4)
    assert want < 15 and len(fitted.model.trees) == want
    got = np.array([r.p for r in fitted.predict(df.filter("held"), "p").orderBy("k").collect()])
    assert np.allclose(got, np.array(whole.model.treeWeights[:want]) @ each[:want])


def test_robust_boosting_has_its_documented_rounds(spark, monkeypatch):
    """``fit_gbt_robust`` fits 3000 trees at a rate of 0.05 on every training row."""
    from tessera.plans import catalogue_models as cm
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 2))
    rows = spark.createDataFrame([(*[i] * len(cm.KEY), float(a * b), float(a), float(b)) for i, (a, b) in enumerate(x)],
                                 ", ".join(f"{k} long" for k in cm.KEY) + ", y double, a double, b double")
    seen, plain = [], Trees.fit

    def fit(self, df, features, label):
        seen.append((self.params["maxIter"], self.params["stepSize"], self.params["lossType"], df.count()))
        self.params = self.params | {"maxIter": 2}
        return plain(self, df, features, label)

    monkeypatch.setattr(cm, "_split", lambda spark, d: (rows, rows.drop("y"), ["a", "b"]))
    monkeypatch.setattr(Trees, "fit", fit)
    assert cm.fit_gbt_robust(spark, "unused").count() == 120
    assert seen == [(3000, 0.05, "absolute", 120)]
