"""Queries whose fits have a closed form, so that SQL can repeat them exactly:
linear models on one feature, leave-one-out ridge and PCA on two, the polynomial
ridge on one, a stack of group means under a ridge, and balanced folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.ensemble import SeedAverage, Stacking
from tessera.operators.evaluate import assign_folds, balanced_folds, rmsle_by_fold
from tessera.operators.models import GroupMean, PolyRidge, elastic_net, lasso, ridge
from tessera.operators.moments import Bank, ridge_loo
from tessera.operators.stats import pca_keep_share
from tessera.plans.catalogue import FOLD_KEY, FOLD_WEIGHTS, KEY, fold_sql, query, r6
from tessera.plans.catalogue_models import _SEEDS, _oof_sql
from tessera.plans.pipeline import RIDGE_GRID
from tessera.runtime import stage
from tessera.sources.fixture import KEY_SQL, SALES_CTE, sales

_IQR = "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)"


def labelled(spark, d):
    return sales(spark, d).filter(F.col("split") == "train")


_LINEAR = {"lasso": lasso(0.05), "elastic_net": elastic_net(0.05, 0.9), "ridge": ridge(10.0)}


@query("linear_closed_forms", SALES_CTE + f"""
, u AS (SELECT {_IQR.format('l_extendedprice')} AS iqr FROM sales WHERE split = 'train'),
m AS (SELECT any_value(iqr) AS iqr, count(*) AS n, avg(l_extendedprice / iqr) AS mx, avg(y) AS my,
             covar_pop(l_extendedprice / iqr, y) AS c, var_pop(l_extendedprice / iqr) AS v FROM sales, u WHERE split = 'train'),
w AS (SELECT 'lasso' AS model, sign(c) * greatest(abs(c) - 0.05, 0) / v AS w FROM m
      UNION ALL SELECT 'elastic_net', sign(c) * greatest(abs(c) - 0.05 * 0.9, 0) / (v + 0.05 * 0.1) FROM m
      UNION ALL SELECT 'ridge', c * n / (v * n + 10) FROM m)
SELECT model, round(w / iqr, 10) AS coef, round(my - w * mx, 6) AS intercept FROM w, m""")
def linear_closed_forms(spark, d):
    """Robust scaling and lasso, elastic net and ridge on one feature, whose
    solutions are soft-thresholded covariances (M1-M3, M13)."""
    bank = Bank(labelled(spark, d).select("l_extendedprice", "y"), ["l_extendedprice"], "y", {})
    rows = []
    for name, model in _LINEAR.items():
        fit = model.fit_bank(bank, ["l_extendedprice"], {})
        rows.append((name, float(fit.coef[0]), fit.intercept))
    out = spark.createDataFrame(rows, "model string, coef double, intercept double")
    return out.select("model", F.round("coef", 10).alias("coef"), r6("intercept").alias("intercept"))


_LOO_ALPHAS = sorted([0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0, *RIDGE_GRID])


@query("ridge_loo_cv", SALES_CTE + f"""
, u AS (SELECT {_IQR.format('l_quantity')} AS i1, {_IQR.format('l_discount')} AS i2 FROM sales WHERE split = 'train'),
x AS (SELECT l_quantity / i1 AS a, l_discount / i2 AS b, y FROM sales, u WHERE split = 'train'),
m AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM x),
c AS (SELECT a - ma AS a, b - mb AS b, y - my AS y, n FROM x, m),
s AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS by_ FROM c),
g AS (SELECT alpha, aa + alpha AS p, bb + alpha AS q, ab, (aa + alpha) * (bb + alpha) - ab * ab AS det, ay, by_
      FROM s, (SELECT unnest([{', '.join(f'{a}::DOUBLE' for a in _LOO_ALPHAS)}]) AS alpha)),
loo AS (SELECT alpha, round(avg(pow((y - a * (q * ay - ab * by_) / det - b * (p * by_ - ab * ay) / det)
               / (1 - 1.0 / n - (a * a * q - 2 * a * b * ab + b * b * p) / det), 2)), 8) AS loo_mse FROM c, g GROUP BY alpha)
SELECT alpha, loo_mse, CAST(row_number() OVER (ORDER BY loo_mse, alpha) = 1 AS INTEGER) AS chosen FROM loo""")
def ridge_loo_cv(spark, d):
    """Ridge with α by leave-one-out: residuals over one less leverage, all α in
    one pass after the Gramian (M4)."""
    feats = ["l_quantity", "l_discount"]
    bank = Bank(labelled(spark, d).select(*feats, "y"), feats, "y", {})
    errors = [round(float(e), 8) for e in ridge_loo(bank.rows, bank, feats, _LOO_ALPHAS)[0]]
    best = min(zip(errors, _LOO_ALPHAS))[1]
    return spark.createDataFrame([(a, e, int(a == best)) for a, e in zip(_LOO_ALPHAS, errors)],
                                 "alpha double, loo_mse double, chosen int")


def _det(m):
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"(({a}) * (({e}) * ({i}) - ({f}) * ({h})) - ({b}) * (({d}) * ({i}) - ({f}) * ({g})) + ({c}) * (({d}) * ({h}) - ({e}) * ({g})))"


def _poly_sql() -> str:
    # terms 2.5, sqrt(5) x, x^2 of the kernel (x z + 2.5)^2, and the penalty 0.6
    phi = ["2.5", "sqrt(5.0) * x", "x * x"]
    sums = ", ".join(f"sum({phi[i]} * {phi[j]}){' + 0.6' if i == j else ''} AS g{i}{j}" for i in range(3) for j in range(3))
    sums += ", " + ", ".join(f"sum({phi[i]} * y) AS r{i}" for i in range(3))
    m = [[f"g{i}{j}" for j in range(3)] for i in range(3)]
    w = [f"{_det([[f'r{i}' if j == k else m[i][j] for j in range(3)] for i in range(3)])} / {_det(m)} AS w{k}" for k in range(3)]
    return SALES_CTE + f"""
, x AS (SELECT l_quantity / 10 AS x, y FROM sales WHERE split = 'train'),
s AS (SELECT {sums} FROM x),
w AS (SELECT {', '.join(w)} FROM s)
SELECT {KEY_SQL}, round(2.5 * w0 + sqrt(5.0) * w1 * (l_quantity / 10) + w2 * (l_quantity / 10) * (l_quantity / 10), 6) AS prediction
FROM sales, w WHERE split = 'test'"""


@query("poly_ridge_closed_form", _poly_sql())
def poly_ridge_closed_form(spark, d):
    """Polynomial-kernel ridge on one feature: three terms, solved by hand in SQL (M6)."""
    s = sales(spark, d).withColumn("x", F.col("l_quantity") / 10)
    fitted = PolyRidge(0.6, 2.5).fit(s.filter(F.col("split") == "train").select("x", "y"), ["x"], "y")
    out = fitted.predict(s.filter(F.col("split") == "test").select(*KEY, "x"), "prediction")
    return out.select(*KEY, r6("prediction").alias("prediction"))


@query("pca_closed_form", SALES_CTE + f"""
, u AS (SELECT {_IQR.format('l_quantity')} AS i1, {_IQR.format('l_extendedprice')} AS i2 FROM sales WHERE split = 'train'),
m AS (SELECT var_samp(l_quantity / i1) AS a, var_samp(l_extendedprice / i2) AS b, covar_samp(l_quantity / i1, l_extendedprice / i2) AS c
      FROM sales, u WHERE split = 'train'),
e AS (SELECT (a + b) / 2 + sqrt(pow((a - b) / 2, 2) + c * c) AS first, a + b AS total FROM m)
SELECT share, CAST(CASE WHEN first / total >= share THEN 1 ELSE 2 END AS INTEGER) AS k, round(first, 6) AS variance
FROM e, (SELECT unnest([0.5::DOUBLE, 0.99::DOUBLE]) AS share)""")
def pca_closed_form(spark, d):
    """Robust scaling and PCA of two columns: components kept for two shares,
    variance of the first (T4)."""
    # the fits read the rows some sixteen times, the tables once
    rows = stage(labelled(spark, d).select(F.array("l_quantity", "l_extendedprice").alias("x")), "pca-rows")
    out = None
    for share in (0.5, 0.99):
        pcs, k = pca_keep_share(rows, "x", [], share)
        part = pcs.agg(F.lit(share).alias("share"), F.lit(k).alias("k"), r6(F.var_samp(F.col("pcs")[0])).alias("variance"))
        out = part if out is None else out.unionByName(part)
    return out


# --- a stack of group means under a ridge ------------------------------------------

_GROUPS = {"brand": "p_brand", "type": "p_type"}


def closed_stack(seed: int = 42) -> Stacking:
    return Stacking([GroupMean(by, name) for name, by in _GROUPS.items()], ridge(5.0, scale=False, name="meta_ridge"), FOLD_KEY,
                    k=5, seed=seed, fold_weights=FOLD_WEIGHTS)


_ROWS = f"SELECT {KEY_SQL}, p_brand, p_type, net, y FROM sales"


def _stack_sql(tag: str, rows: str, scored: str, seed: int = 42) -> str:
    """CTEs of a fitted stack: its out-of-fold table ``oof_{tag}`` and its
    predictions ``p_{tag}`` for the rows of ``scored``."""
    t = f"t_{tag}"
    out = f", {t} AS (SELECT *, CAST({fold_sql(seed, 5)} AS INTEGER) AS fold FROM ({rows}))"
    means = []
    for name, by in _GROUPS.items():
        n = f"{name}_{tag}"
        out += _oof_sql(by, n, t)
        # a fold's model scores a group by the other folds' mean, an unseen one by their global mean
        out += f"""
, z_{n} AS (SELECT g.{by}, f.fold, CASE WHEN g.ng - coalesce(c.n, 0) > 0 THEN (g.sg - coalesce(c.s, 0)) / (g.ng - coalesce(c.n, 0))
              ELSE (tt.S - f.sf) / (tt.N - f.nf) END AS m
            FROM g_{n} g CROSS JOIN f_{n} f CROSS JOIN tot_{n} tt LEFT JOIN c_{n} c ON c.{by} = g.{by} AND c.fold = f.fold),
d_{n} AS (SELECT avg((tt.S - f.sf) / (tt.N - f.nf)) AS m FROM f_{n} f, tot_{n} tt),
a_{n} AS (SELECT {by}, avg(m) AS m FROM z_{n} GROUP BY {by})"""
        means.append(f"coalesce(a_{n}.m, d_{n}.m)")
    b, y = (f"{name}_{tag}" for name in _GROUPS)
    on = " AND ".join(f"o1.{k} = o2.{k}" for k in KEY)
    return out + f"""
, oof_{tag} AS (SELECT {', '.join(f'o1.{k}' for k in KEY)}, o1.y, o1.oof AS brand, o2.oof AS type FROM o_{b} o1 JOIN o_{y} o2 ON {on}),
mm_{tag} AS (SELECT avg(brand) AS mb, avg(type) AS mt, avg(y) AS my FROM oof_{tag}),
ss_{tag} AS (SELECT any_value(mb) AS mb, any_value(mt) AS mt, any_value(my) AS my, sum(pow(brand - mb, 2)) + 5 AS p, sum(pow(type - mt, 2)) + 5 AS q,
             sum((brand - mb) * (type - mt)) AS c, sum((brand - mb) * (y - my)) AS u, sum((type - mt) * (y - my)) AS v FROM oof_{tag}, mm_{tag}),
ww_{tag} AS (SELECT mb, mt, my, (q * u - c * v) / (p * q - c * c) AS wb, (p * v - c * u) / (p * q - c * c) AS wt FROM ss_{tag}),
p_{tag} AS (SELECT {', '.join(f'r.{k}' for k in KEY)}, r.y, my + wb * ({means[0]} - mb) + wt * ({means[1]} - mt) AS pred
            FROM ({scored}) r LEFT JOIN a_{b} ON a_{b}.p_brand = r.p_brand LEFT JOIN a_{y} ON a_{y}.p_type = r.p_type, d_{b}, d_{y}, ww_{tag})"""


def _closed_rows(spark, d, split: str):
    """Staged, as stacks read them for every member, fold and seed."""
    rows = sales(spark, d).filter(F.col("split") == split).select(*KEY, "p_brand", "p_type", "y")
    return stage(rows, "closed-rows")


@query("stack_closed_oof", SALES_CTE + _stack_sql("s", f"{_ROWS} WHERE split = 'train'", f"{_ROWS} WHERE split = 'test'") + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(y, 6) AS y, round(brand, 6) AS brand, round(type, 6) AS type FROM oof_s""")
def stack_closed_oof(spark, d):
    """Out-of-fold table of a stack whose members SQL can repeat."""
    oof = closed_stack().fit(_closed_rows(spark, d, "train"), ["p_brand", "p_type"], "y").oof
    return oof.select(*FOLD_KEY, *[r6(c).alias(c) for c in ("y", "brand", "type")])


@query("stack_closed", SALES_CTE + _stack_sql("s", f"{_ROWS} WHERE split = 'train'", f"{_ROWS} WHERE split = 'test'") + f"""
SELECT {KEY_SQL}, round(pred, 6) AS prediction FROM p_s""")
def stack_closed(spark, d):
    """The stack's predictions: members averaged over their fold models, meta
    ridge on the out-of-fold table (E1, V6)."""
    fitted = closed_stack().fit(_closed_rows(spark, d, "train"), ["p_brand", "p_type"], "y")
    return fitted.predict(_closed_rows(spark, d, "test"), "prediction").select(*KEY, r6("prediction").alias("prediction"))


@query("stack_closed_seeds", SALES_CTE + "".join(
    _stack_sql(f"s{s}", f"{_ROWS} WHERE split = 'train'", f"{_ROWS} WHERE split = 'test'", s) for s in _SEEDS) + f"""
, u AS ({' UNION ALL '.join(f'SELECT * FROM p_s{s}' for s in _SEEDS)})
SELECT {KEY_SQL}, round(avg(pred), 6) AS prediction FROM u GROUP BY ALL""")
def stack_closed_seeds(spark, d):
    """Whole stacks for three seeds, predictions averaged."""
    fitted = SeedAverage(closed_stack, _SEEDS).fit(_closed_rows(spark, d, "train"), ["p_brand", "p_type"], "y")
    return fitted.predict(_closed_rows(spark, d, "test"), "prediction").select(*KEY, r6("prediction").alias("prediction"))


# other weights than the stack's own folds have, so that the two are independent
_OUTER_WEIGHTS = (1, 3, 5, 2)
_OUTER = "(l_orderkey + l_partkey * 3 + l_suppkey * 5 + l_linenumber * 2 + 7) % 5"


@query("stack_closed_cv", SALES_CTE + "".join(
    _stack_sql(f"o{o}", f"{_ROWS} WHERE split = 'train' AND {_OUTER} <> {o}",
               f"{_ROWS} WHERE split = 'train' AND {_OUTER} = {o}") for o in range(5)) + """
, u AS (""" + " UNION ALL ".join(f"SELECT {o} AS fold, y, pred FROM p_o{o}" for o in range(5)) + """)
SELECT fold, round(sqrt(avg(pow(pred - y, 2))), 6) AS rmsle, count(*) AS n FROM u GROUP BY fold""")
def stack_closed_cv(spark, d):
    """Outer folds around the stack, each fitted on the other folds (V5, V6)."""
    rows = assign_folds(_closed_rows(spark, d, "train"), FOLD_KEY, 5, 7, _OUTER_WEIGHTS, "outer")
    out = None
    for o in range(5):
        fitted = closed_stack().fit(rows.filter(F.col("outer") != o), ["p_brand", "p_type"], "y")
        part = fitted.predict(rows.filter(F.col("outer") == o), "prediction").select(F.lit(o).alias("fold"), "y", "prediction")
        out = part if out is None else out.unionByName(part)
    return rmsle_by_fold(out, "y", "prediction").select("fold", r6("rmsle").alias("rmsle"), "n")


_PLACE = "md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, '42'))"


@query("fold_balanced", SALES_CTE + f"""
SELECT {KEY_SQL}, CAST((row_number() OVER (ORDER BY {_PLACE}, l_extendedprice) - 1) % 5 AS INTEGER) AS fold
FROM sales WHERE split = 'train'""")
def fold_balanced(spark, d):
    """Shuffled folds whose sizes differ by one at most (V1)."""
    return balanced_folds(labelled(spark, d).select(*KEY), FOLD_KEY, 5, 42, ties=["l_extendedprice"])
