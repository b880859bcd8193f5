"""Regressors (M1-M13) behind one small protocol.

``Regressor.fit(df, features, label) -> Fitted``; ``Fitted.predict(df, out)``
adds column ``out`` and keeps every other column. Features are plain
numeric columns; assembling into a vector happens inside, so callers keep a
fixed schema.

Linear models and the polynomial ridge are fitted from second moments
(:mod:`tessera.operators.moments`): on rows of their own with ``fit``, or with
``fit_bank`` on a training part of a bank that all folds and members share. The
penalty mapping from the reference's conventions (n rows, s_y the population std
of the label):

* Lasso(α)            → regParam = α, elasticNetParam = 1
* Ridge(α)            → regParam = α·s_y/n, elasticNetParam = 0
* ElasticNet(α, ρ)    → regParam = λ = α(ρ + (1−ρ)s_y), elasticNetParam = αρ/λ
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
from pyspark import SparkContext
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.moments import DENSE_TERMS, Bank, FittedLinear, FittedPoly
from tessera.runtime import bounded_broadcast, stage


class Fitted(Protocol):
    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame: ...


class Regressor(Protocol):
    name: str

    def fit(self, df: DataFrame, features: list[str], label: str) -> Fitted: ...


def label_stats(df: DataFrame, label: str) -> tuple[int, float]:
    """(n, population std) of the label in one aggregation."""
    r = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return int(r["n"]), float(r["s"] or 0.0)


def linear_params(kind: str, alpha: float, n: int, s_y: float,
                  l1_ratio: float = 1.0) -> tuple[float, float]:
    """(regParam, elasticNetParam) for the reference's penalty conventions."""
    if alpha == 0:
        return 0.0, 0.0
    if kind == "lasso":
        return alpha, 1.0
    if kind == "ridge":
        return alpha * s_y / n, 0.0
    if kind == "elastic_net":
        lam = alpha * (l1_ratio + (1 - l1_ratio) * s_y)
        return lam, alpha * l1_ratio / lam
    raise ValueError(kind)


def vector_name(features: list[str]) -> str:
    """Name of the vector column that holds exactly these features."""
    return f"__v{zlib.crc32(chr(31).join(features).encode()):08x}"


def with_vector(df: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with the features' vector, unless it has it; null or NaN is an error."""
    name = vector_name(features)
    if name in df.columns:
        return df
    return VectorAssembler(inputCols=list(features), outputCol=name, handleInvalid="error").transform(df)


@dataclass
class _FittedSpark:
    model: object
    features: list[str]

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        m = self.model
        pm = {m.featuresCol: vector_name(self.features), m.predictionCol: out}
        return m.transform(with_vector(df, self.features), pm).select(*df.columns, out)


@dataclass
class _FittedBoost(_FittedSpark):
    @classmethod
    def mean(cls, fits: list["_FittedBoost"]) -> "_FittedBoost":
        """The model that predicts the mean of ``fits``: all their trees, so that a row is
        scored by one function instead of one a fit."""
        trees = [t for f in fits for t in f.model.trees]
        return cls(boosted(trees, [w / len(fits) for f in fits for w in f.model.treeWeights]), fits[0].features)


def boosted(trees: list, weights: list[float]) -> GBTRegressionModel:
    """The boosted model of these trees and weights (a constructor that PySpark lacks)."""
    jvm, gateway = SparkContext._active_spark_context._jvm, SparkContext._active_spark_context._gateway
    of = jvm.org.apache.spark.ml.regression
    some, sizes = gateway.new_array(of.DecisionTreeRegressionModel, len(trees)), gateway.new_array(jvm.double, len(trees))
    for i, (t, w) in enumerate(zip(trees, weights)):
        some[i], sizes[i] = t._java_obj, float(w)
    return GBTRegressionModel(of.GBTRegressionModel(f"gbtr_{uuid.uuid4().hex[:12]}", some, sizes))


@dataclass
class Linear:
    """Lasso / ridge / elastic net, optionally after robust scaling."""

    kind: str
    alpha: float
    l1_ratio: float = 1.0
    scale: bool = True
    name: str = "linear"

    def fit(self, df: DataFrame, features: list[str], label: str) -> FittedLinear:
        return self.fit_bank(Bank(df, features, label, {}), features, {})

    def fit_bank(self, bank: Bank, features: list[str], part: dict) -> FittedLinear:
        spread = bank.spread(part, features) if self.scale else None
        return bank.linear(part, features, self.kind, self.alpha, self.l1_ratio, spread)


def lasso(alpha: float = 0.0005, name: str = "lasso") -> Linear:
    return Linear("lasso", alpha, 1.0, True, name)


def elastic_net(alpha: float = 0.0005, l1_ratio: float = 0.9, name: str = "elastic_net") -> Linear:
    return Linear("elastic_net", alpha, l1_ratio, True, name)


def ridge(alpha: float = 10.0, scale: bool = True, name: str = "ridge") -> Linear:
    return Linear("ridge", alpha, 0.0, scale, name)


@dataclass
class Trees:
    """A Spark tree ensemble built from keyword parameters.

    ``kind`` is ``gbt`` or ``forest``. The boosted-tree libraries of the
    reference are re-aimed as GBTRegressor configurations: row share →
    ``subsamplingRate``, column share → ``featureSubsetStrategy`` (per
    node), leaf size → ``minInstancesPerNode``, min gain → ``minInfoGain``.
    ``early_stop_col`` names a boolean column marking the validation rows
    (M12); with ``stop_on_held_out`` a stack passes its held-out fold there.
    Without ``patience`` Spark stops at its tolerance; with it, all rounds are
    fitted, Spark's per-round errors of the validation rows are read, and the model
    is that of the best round before ``patience`` rounds without a better one:
    the trees up to that round, which the later ones do not change.
    """

    kind: str
    params: dict = field(default_factory=dict)
    early_stop_col: str | None = None
    name: str = "trees"
    stop_on_held_out: bool = False
    patience: int | None = None
    errors: list[float] = field(default_factory=list)

    def fit(self, df: DataFrame, features: list[str], label: str) -> Fitted:
        cls = GBTRegressor if self.kind == "gbt" else RandomForestRegressor
        kw = dict(self.params)
        if self.early_stop_col and self.patience:
            return self._patient(cls, kw, df, features, label)
        if self.early_stop_col:
            kw["validationIndicatorCol"] = self.early_stop_col
        name = vector_name(features)
        est = cls(featuresCol=name, labelCol=label, **kw)
        cols = [label, name] + ([self.early_stop_col] if self.early_stop_col else [])
        out = _FittedBoost if self.kind == "gbt" else _FittedSpark
        return out(est.fit(with_vector(df, features).select(*cols)), list(features))

    def _patient(self, cls, kw: dict, df: DataFrame, features: list[str], label: str) -> Fitted:
        name = vector_name(features)
        rows = with_vector(df, features).select(label, name, self.early_stop_col)
        learn, held = rows.filter(~F.col(self.early_stop_col)), rows.filter(F.col(self.early_stop_col))
        model = cls(featuresCol=name, labelCol=label, **kw).fit(learn)
        self.errors = list(model.evaluateEachIteration(held, kw.get("lossType", "squared")))
        best = best_round(self.errors, self.patience)
        if best < len(self.errors):
            model = boosted(model.trees[:best], model.treeWeights[:best])
        return _FittedBoost(model, list(features))


def best_round(errors: list[float], patience: int) -> int:
    """Number of rounds up to the lowest error that ``patience`` rounds in a row
    did not better; the first of equal ones."""
    best = 0
    for n, e in enumerate(errors):
        if e < errors[best]:
            best = n
        elif n - best >= patience:
            break
    return best + 1


# --- polynomial ridge (M6) ----------------------------------------------------

@dataclass
class PolyRidge:
    """Kernel ridge with the polynomial kernel (γxᵀz + c0)^2, no intercept (M6).

    Re-aimed from the dual n×n solver (single machine) to the equal primal
    form on the explicit degree-2 map, of d = 1 + 2p + p(p−1)/2 terms, which grows
    with the feature count only, never with rows. Up to ``DENSE_TERMS`` terms
    the d×d Gramian of the terms is summed by Spark and solved. Beyond, the fit is
    matrix-free (:func:`tessera.operators.quadratic.fit_quadratic`): no d×d matrix is
    built anywhere. Prediction needs no terms, only a p×p form.
    """

    alpha: float = 0.6
    coef0: float = 2.5
    gamma: float | None = None
    name: str = "poly_ridge"

    def dense(self, p: int) -> bool:
        return 1 + 2 * p + p * (p - 1) // 2 <= DENSE_TERMS

    def fit(self, df: DataFrame, features: list[str], label: str) -> FittedPoly:
        return self.fit_bank(Bank(df, features, label, {}), features, {})

    def fit_bank(self, bank: Bank, features: list[str], part: dict) -> FittedPoly:
        if self.dense(len(bank.features)):
            return bank.poly(part, features, self.alpha, self.coef0, self.gamma)
        from tessera.operators.quadratic import fit_quadratic
        return fit_quadratic(bank, features, [part], self.alpha, self.coef0, self.gamma)[0]


# --- deterministic baseline (used where the oracle must agree) ---------------

@dataclass
class _FittedGroupMean:
    by: str | None
    table: DataFrame | None
    global_mean: float

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        if self.by is None:
            return df.withColumn(out, F.lit(self.global_mean).cast("double"))
        j = df.join(bounded_broadcast(self.table), on=self.by, how="left")
        return j.select(*df.columns, F.coalesce(F.col("__gm"), F.lit(self.global_mean))
                        .cast("double").alias(out))

    @classmethod
    def mean(cls, fits: list["_FittedGroupMean"]) -> "_FittedGroupMean":
        """The model that predicts the mean of ``fits``, by one join instead of one
        each: a group that a fit has not seen counts with that fit's global mean."""
        k, whole = len(fits), float(np.mean([f.global_mean for f in fits]))
        by = fits[0].by
        if by is None:
            return cls(None, None, whole)
        off = None
        for f in fits:
            part = f.table.select(by, (F.col("__gm") - F.lit(f.global_mean)).alias("__off"))
            off = part if off is None else off.unionByName(part)
        return cls(by, stage(off.groupBy(by).agg((F.lit(whole) + F.sum("__off") / k).alias("__gm")), "group-means"), whole)


@dataclass
class GroupMean:
    """Predict the training mean of the label in the row's group (global if none)."""

    by: str | None = None
    name: str = "group_mean"

    def fit(self, df: DataFrame, features: list[str], label: str) -> Fitted:
        if self.by is None:
            m = df.agg(F.avg(label)).first()[0]
            return _FittedGroupMean(None, None, float(m))
        t = stage(df.groupBy(self.by).agg(F.sum(label).alias("s"), F.count(label).alias("n")), "group-means")
        tot = t.agg(F.sum("s"), F.sum("n")).first()
        table = t.filter(F.col(self.by).isNotNull()).select(
            self.by, (F.col("s") / F.col("n")).alias("__gm"))
        return _FittedGroupMean(self.by, table, float(tot[0] / tot[1]))


# --- profiles -----------------------------------------------------------------

# Trees of each booster in the ``small`` profile; the one number that is cut
# for run time. The ``full`` profile has the documented counts.
SMALL_TREES = 8


def base_models(profile: str = "small", seed: int = 42, trees: int = SMALL_TREES) -> list[Regressor]:
    """The six base learners of the best ensemble: three penalised regressions
    and three boosters, the last two of which stop early on the held-out fold.

    ``full`` has the documented tree counts, rates and patience; ``small`` the same
    members with ``trees`` trees at a higher rate, stopped by a tolerance.
    """
    full = profile == "full"
    patience = 50 if full else None
    # fixed values: the members' documented parameters
    rounds = dict(maxIter=3000) if full else dict(maxIter=trees, stepSize=0.3)
    return [
        lasso(0.0005), elastic_net(0.0005, 0.9), PolyRidge(0.6, 2.5),
        Trees("gbt", dict(stepSize=0.05, maxDepth=4, lossType="absolute",
                          featureSubsetStrategy="sqrt", minInstancesPerNode=15,
                          seed=seed) | rounds, name="gbt_robust"),
        Trees("gbt", dict(stepSize=0.01, maxDepth=4, subsamplingRate=0.7,
                          featureSubsetStrategy="0.7", seed=seed) | rounds,
              name="gbt_xgb", stop_on_held_out=True, patience=patience),
        Trees("gbt", dict(stepSize=0.01, maxDepth=5, seed=seed) | rounds,
              name="gbt_cat", stop_on_held_out=True, patience=patience),
    ]


def meta_model(profile: str = "small", seed: int = 42, trees: int = SMALL_TREES) -> Regressor:
    """Second-level learner (the boosted meta model is re-aimed as a GBT)."""
    rounds = dict(maxIter=1000, stepSize=0.01) if profile == "full" else dict(maxIter=trees, stepSize=0.3)
    return Trees("gbt", dict(maxDepth=5, minInstancesPerNode=15, minInfoGain=0.01, seed=seed) | rounds,
                 name="meta_gbt")
