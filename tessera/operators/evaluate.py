"""Folds, scores and cross-validation (V1-V6, M4, M5).

Fold membership is a pure function of the row key and a seed, so it is
stable under repartitioning and recomputation after a lost executor
(``rand()``/``randomSplit`` are not).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators.models import label_stats
from tessera.operators.moments import Bank, FittedLinear, scored_path
from tessera.runtime import bounded_broadcast, side_by_side, stage


def fold_column(key: Sequence[str], k: int, seed: int,
                weights: Sequence[int] | None = None) -> Column:
    """Fold number in [0, k).

    Default: ``pmod(xxhash64(key…, seed), k)``. With ``weights`` the fold is
    the plain arithmetic ``(Σ wᵢ·keyᵢ + seed) mod k`` (for non-negative
    integer keys), which other engines reproduce exactly.
    """
    if weights is None:
        return F.pmod(F.xxhash64(*[F.col(c) for c in key], F.lit(seed)), F.lit(k)).cast("int")
    acc = F.lit(seed).cast("long")
    for c, w in zip(key, weights):
        acc = acc + F.col(c).cast("long") * F.lit(int(w))
    return F.pmod(acc, F.lit(k)).cast("int")


def assign_folds(df: DataFrame, key: Sequence[str], k: int = 5, seed: int = 42,
                 weights: Sequence[int] | None = None, name: str = "fold") -> DataFrame:
    return df.withColumn(name, fold_column(key, k, seed, weights))


FOLD_CHUNK = 20_000     # rows that one task ranks


def balanced_folds(df: DataFrame, key: Sequence[str], k: int = 5, seed: int = 42, name: str = "fold",
                   ties: Sequence[str] = ()) -> DataFrame:
    """Shuffled folds whose sizes differ by one at most (V1): the row's rank by
    the hash of its key and the seed, modulo ``k``.

    Ranks are distributed: rows are counted per stretch of the hash, stretches
    of about ``FOLD_CHUNK`` rows are ranked each in its own task, and a running
    sum of their counts (itself taken in two levels) gives the offsets. The fold
    depends on keys only (and on ``ties`` where rows share a key), not on
    partitions or order; rows equal in both are interchangeable.
    """
    place, order = "__place", [*key, *ties]
    rows = df.withColumn(place, F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed)))))
    digits = 1
    while 16 ** digits * FOLD_CHUNK < df.count() and digits < 8:
        digits += 1
    rows = rows.withColumn("__stretch", F.substring(place, 1, digits))
    counts = stage(rows.groupBy("__stretch").agg(F.count(F.lit(1)).alias("n")), "stretches")
    block = F.substring("__stretch", 1, max(1, digits - 2))
    upto = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy(block.alias("block")).agg(F.sum("n").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(upto.orderBy("block")), F.lit(0)).alias("first"))
    offsets = counts.withColumn("block", block).join(blocks, "block").select(
        F.col("__stretch").alias("of"), (F.col("first") + F.coalesce(F.sum("n").over(
            upto.partitionBy("block").orderBy("__stretch")), F.lit(0))).alias("offset"))
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy("__stretch").orderBy(place, *order)) - 1)
    ranked = ranked.join(bounded_broadcast(offsets), F.col("__stretch") == F.col("of"))
    return ranked.select(*df.columns, F.pmod(F.col("offset") + F.col("__rank"), F.lit(k)).cast("int").alias(name))


def rmsle(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Root mean squared error in log scale, one row ``(rmsle, n)`` (V2)."""
    return df.agg(F.sqrt(F.avg(F.pow(F.col(pred) - F.col(label), 2))).alias("rmsle"),
                  F.count(F.lit(1)).alias("n"))


def rmsle_by_fold(df: DataFrame, label: str, pred: str, fold: str = "fold") -> DataFrame:
    """Per-fold score of held-out predictions ``(fold, rmsle, n)`` (V3)."""
    return df.groupBy(fold).agg(
        F.sqrt(F.avg(F.pow(F.col(pred) - F.col(label), 2))).alias("rmsle"),
        F.count(F.lit(1)).alias("n"))


def summarize_scores(scores: DataFrame, by: str = "model") -> DataFrame:
    """Mean ± population std of fold scores per model (V4)."""
    return scores.groupBy(by).agg(F.avg("rmsle").alias("mean_rmsle"),
                                  F.stddev_pop("rmsle").alias("std_rmsle"),
                                  F.count(F.lit(1)).alias("folds"))


def oof_group_mean(df: DataFrame, label: str, by: str | None, fold: str = "fold",
                   out: str = "oof", fit_on: DataFrame | None = None) -> DataFrame:
    """Held-out group-mean predictions in closed form, one aggregation.

    For a row of fold f in group g the model fitted on the other folds
    predicts (S_g − S_gf)/(N_g − N_gf), or the other folds' global mean
    (S − S_f)/(N − N_f) when g is NULL or has no row outside fold f. One
    ``groupBy(g, fold)`` replaces k fits; the small tables are joined back.
    ``fit_on``: the same rows by a shorter plan, to take the sums from.
    """
    cell_keys = [by, fold] if by else [fold]
    # staged, so that the table is read once for them, not once per use
    cells = stage((df if fit_on is None else fit_on).groupBy(*cell_keys).agg(F.sum(label).alias("s"), F.count(label).alias("n")), "cells")
    # k rows: the other folds' global mean per fold becomes a literal map
    per_fold = {r[fold]: (r["sf"], r["nf"]) for r in cells.groupBy(fold).agg(
        F.sum("s").alias("sf"), F.sum("n").alias("nf")).collect()}
    S = sum(v[0] for v in per_fold.values())
    N = sum(v[1] for v in per_fold.values())
    fm = {f: (S - sf) / (N - nf) for f, (sf, nf) in per_fold.items() if N - nf > 0}
    fold_mean = F.create_map(*[F.lit(x) for kv in fm.items() for x in kv])[F.col(fold)]
    out_df = df.withColumn("__fm", fold_mean)
    if by:
        grp = cells.filter(F.col(by).isNotNull()).groupBy(by).agg(
            F.sum("s").alias("sg"), F.sum("n").alias("ng"))
        gf = (cells.filter(F.col(by).isNotNull()).join(grp, on=by)
              .select(by, fold, F.when(F.col("ng") - F.col("n") > 0,
                                       (F.col("sg") - F.col("s")) / (F.col("ng") - F.col("n")))
                      .alias("__gm")))
        out_df = out_df.join(bounded_broadcast(gf), on=[by, fold], how="left")
        pred = F.coalesce(F.col("__gm"), F.col("__fm"))
    else:
        pred = F.col("__fm")
    return out_df.select(*df.columns, pred.cast("double").alias(out))


def fold_gramians(df: DataFrame, features: list[str], label: str, fold: str,
                  k: int) -> np.ndarray:
    """Per-fold Gramians of ``[1, x…, y]``, shape (k, p+2, p+2), from one pass."""
    bank = Bank(df, features, label, {"fold": (F.col(fold), k)})
    return np.stack([bank.gram({}, features, {"fold": f}) for f in range(k)])


def _centred(gram: np.ndarray):
    p = gram.shape[0] - 2
    n, sx, sy = gram[0, 0], gram[0, 1:p + 1], gram[0, p + 1]
    sxx = gram[1:p + 1, 1:p + 1] - np.outer(sx, sx) / n
    sxy = gram[1:p + 1, p + 1] - sx * sy / n
    return n, sx, sy, sxx, sxy


def ridge_on_gramian(gram: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """(w, b) minimising ``||y−Xw−b||² + α||w||²`` from a ``[1, x, y]`` Gramian."""
    n, sx, sy, sxx, sxy = _centred(gram)
    w = np.linalg.solve(sxx + alpha * np.eye(len(sxy)), sxy)
    return w, (sy - sx @ w) / n


def heldout_sse(gram: np.ndarray, w: np.ndarray, b: float) -> tuple[float, float]:
    """(Σ(y − b − xᵀw)², n) over the rows whose Gramian is ``gram``."""
    p = len(w)
    n, sx, sy = gram[0, 0], gram[0, 1:p + 1], gram[0, p + 1]
    xtx, xty, yty = gram[1:p + 1, 1:p + 1], gram[1:p + 1, p + 1], gram[p + 1, p + 1]
    sse = yty - 2 * b * sy - 2 * w @ xty + n * b * b + 2 * b * (w @ sx) + w @ xtx @ w
    return max(float(sse), 0.0), float(n)


def bank_grid_scores(bank: Bank, features: list[str], kind: str, alphas: Sequence[float], k: int, part: Mapping[str, int] = {},
                     spread: np.ndarray | None = None, dim: str = "fold") -> list[tuple[float, int, float]]:
    """``(alpha, fold, rmse)`` from the bank alone: a training part's Gramian is
    the total less its fold, and the held-out error follows from the fold's."""
    def one(f):
        fits = scored_path(bank.rows, bank.gram({**part, dim: f}, features), list(features), kind, list(map(float, alphas)), spread)
        scores = [heldout_sse(bank.gram(part, features, {dim: f}), fit.coef, fit.intercept) for fit in fits]
        return [(float(a), f, float(np.sqrt(sse / n)) if n else float("nan")) for a, (sse, n) in zip(alphas, scores)]

    bank.grams()
    return [r for rows in side_by_side(one, range(k)) for r in rows]


def best_alpha(rows: list[tuple[float, int, float]]) -> float:
    """Lowest mean fold RMSE, ties to the smaller α."""
    means: dict[float, list[float]] = {}
    for a, _, r in rows:
        means.setdefault(a, []).append(r)
    return min(means, key=lambda a: (np.nanmean(means[a]), a))


def linear_grid_cv(df: DataFrame, features: list[str], label: str, kind: str,
                   alphas: Sequence[float], fold: str = "fold", k: int | None = None) -> tuple[float, DataFrame]:
    """k-fold choice of α for a linear model (M4, M5).

    Gramians of all folds come from one pass, whatever the number of α: ridge and lasso
    are solved on them and held-out errors are read off them. Returns the best α (lowest mean fold RMSE, ties to the smaller α) and the ``(alpha, fold,
    rmsle)`` table."""
    if k is None:
        k = df.agg(F.max(fold)).first()[0] + 1
    bank = Bank(df, features, label, {"fold": (F.col(fold), k)})
    rows = bank_grid_scores(bank, features, kind, alphas, k)
    return best_alpha(rows), df.sparkSession.createDataFrame(rows, "alpha double, fold int, rmsle double")


__all__ = ["balanced_folds", "bank_grid_scores", "best_alpha", "assign_folds", "fold_column", "rmsle", "rmsle_by_fold", "summarize_scores",
           "oof_group_mean", "linear_grid_cv", "label_stats"]


class LinearCV:
    """Robust scaling + linear model whose α is chosen inside ``fit`` (the
    searched ridge / lasso members of a stack, M4, M5): ridge by leave-one-out
    errors, lasso by k-fold errors on the bank's dimension ``cv``. Folds hash the
    row's own values, so no key column is needed."""

    def __init__(self, kind: str, alphas: Sequence[float], k: int = 5, seed: int = 42,
                 name: str | None = None):
        self.kind, self.alphas, self.k, self.seed = kind, list(alphas), k, seed
        self.name = name or f"{kind}_cv"
        self.best: float | None = None

    def dims(self, features: Sequence[str], label: str) -> dict:
        """What the member needs of a bank beside the stack's folds."""
        if self.kind == "ridge":
            return {}
        cells = F.xxhash64(*[F.col(f"`{c}`") for c in (*features, label)], F.lit(self.seed))
        return {f"cv{self.k}": (F.pmod(cells, F.lit(self.k)).cast("int"), self.k)}

    def fit(self, df: DataFrame, features: list[str], label: str) -> FittedLinear:
        return self.fit_bank(Bank(df, features, label, self.dims(features, label)), features, {})

    def fit_bank(self, bank: Bank, features: list[str], part: dict) -> FittedLinear:
        spread = bank.spread(part, features)
        if self.kind == "ridge":
            errors = bank.loo(tuple(features), tuple(self.alphas), part)
            self.best = float(min(zip(errors, self.alphas))[1])
        else:
            self.best = best_alpha(bank_grid_scores(bank, features, self.kind, self.alphas, self.k, part, spread, f"cv{self.k}"))
        return bank.linear(part, features, self.kind, self.best, 1.0, spread)
