"""Feature selection: variance (F1/F2), correlation (F3), binned mutual
information (F4), top-k (O2) and applying a fitted selection (F5).

Inputs are wide frames of numeric feature columns; every statistic of
every feature is one aggregation (variance, correlation) or one grouped
count over an unpivoted ``(feature, bin_x, bin_y)`` table (MI), so the
work is split by Spark and only ``features``- or ``features²``-sized
results reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window

from tessera.functions.expr import CORRELATION_CUT, MI_TOP_K, VARIANCE_CUT
from tessera.operators.moments import matrix, summed
from tessera.operators.quantiles import cell_quantiles
from tessera.operators.stats import collect_agg
from tessera.runtime import bounded_broadcast


def variance_table(df: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, position, var_pop, var_samp)`` for every feature.

    Plain aggregates in codegen-sized chunks; the p result rows are a
    feature-sized table built on the driver."""
    x = {}
    for c in features:
        x[f"p:{c}"] = F.var_pop(F.col(c).cast("double"))
        x[f"s:{c}"] = F.var_samp(F.col(c).cast("double"))
    v = collect_agg(df, x)
    rows = [(c, i, v[f"p:{c}"], v[f"s:{c}"]) for i, c in enumerate(features)]
    return df.sparkSession.createDataFrame(
        rows, "feature string, position int, var_pop double, var_samp double")


def dominance(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of the most frequent non-null value per column (P3, general form).

    ``(feature, top_value, top_count, n, dominance)``; ties go to the
    smallest value. Aggregations only: one grouped count over the unpivoted
    values (map-side combine, so a value with a third of the rows is cheap),
    a per-column max/sum over the count table, and a join back through a
    size-checked broadcast (one row per column). No window, so a column with
    very many distinct values is never gathered into one task.
    """
    # ties go to the smallest value: by number in numeric columns, else by text
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    long = (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("kv"))
        .select("kv.feature", "kv.value").filter(F.col("value").isNotNull()))
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))
    per = counts.groupBy("feature").agg(F.max("c").alias("top_count"),
                                         F.sum("c").cast("long").alias("n"))
    top = (counts.join(bounded_broadcast(per), on="feature")
           .filter(F.col("c") == F.col("top_count"))
           .withColumn("num", F.when(F.col("feature").isin(numeric), F.expr("try_cast(value AS double)")))
           .groupBy("feature", "top_count", "n")
           .agg(F.min_by("value", F.struct("num", "value")).alias("top_value")))
    return top.select("feature", "top_value", "top_count", "n",
                      (F.col("top_count") / F.col("n")).alias("dominance"))


@dataclass
class VarianceFilter:
    """Keep features whose variance exceeds ``cut``.

    ``population=True``: population variance > cut (F1, cut 0.01).
    ``population=False``: sample variance > cut (F2, cut 0). Spark ML's
    VarianceThresholdSelector uses sample variance only, hence this form.
    """

    features: list[str]
    cut: float = VARIANCE_CUT
    population: bool = True
    kept: list[str] = field(default_factory=list)

    def fit(self, df: DataFrame, table: DataFrame | None = None) -> "VarianceFilter":
        """``table``: the :func:`variance_table` of ``df``, if it is there already."""
        which = "var_pop" if self.population else "var_samp"
        rows = (variance_table(df, self.features) if table is None else table).collect()
        var = {r["feature"]: r[which] for r in rows}
        self.kept = [c for c in self.features if var[c] is not None and var[c] > self.cut]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Apply the fitted selection to any frame."""
        drop = set(self.features) - set(self.kept)
        return df.select([c for c in df.columns if c not in drop])


def upper_triangle_drops(names: list[str], corr, cut: float) -> list[str]:
    """Feature j is dropped when some earlier i < j has |r| > cut.

    Not greedy: i counts even when it is itself dropped; NaN never drops.
    """
    p = len(names)
    dropped = []
    for j in range(p):
        for i in range(j):
            r = corr[i][j]
            if r is not None and not math.isnan(r) and abs(r) > cut:
                dropped.append(names[j])
                break
    return dropped


def pairwise_correlation(df: DataFrame, features: list[str]) -> np.ndarray:
    """Pearson r of every pair over the rows that have both values; NaN where
    one is constant there or none is common. One pass after that for the
    columns' means and deviations, which only keep digits."""
    x = df.select(F.lit(0).alias("cell"), *[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"x{i}")
                                            for i, c in enumerate(features)])
    p = len(features)
    names = x.columns[1:]
    row = x.agg(*[F.avg(c) for c in names], *[F.stddev_pop(c) for c in names]).first()
    mean = np.array([v or 0.0 for v in row[:p]])
    scale = np.array([v or 1.0 for v in row[p:]])

    def partial(batch):
        z = (matrix(batch, 1) - mean) / scale
        there = (~np.isnan(z)).astype(float)
        z = np.nan_to_num(z)
        a = np.column_stack([there, z, z * z])
        yield 0, a.T @ a

    g = summed(x, partial, 3 * p).get(0, np.zeros((3 * p, 3 * p)))
    n, s, q, c = g[:p, :p], g[p:2 * p, :p], g[2 * p:, :p], g[p:2 * p, p:2 * p]
    with np.errstate(all="ignore"):
        # s[i, j]: sum of column i over the rows that also have column j
        cov = c / n - (s / n) * (s / n).T
        var = q / n - (s / n) ** 2
        var = np.where(var > 1e-14 * np.maximum(q / n, 1), var, np.nan)
        return cov / np.sqrt(var * var.T)


@dataclass
class CorrelationFilter:
    """Drop near-duplicate features, |Pearson r| > cut with an earlier one.

    Each r is taken over the rows that have both values (NaN counts as
    missing). One pass sums the products of values, squares and presence
    masks of all columns, from which every pair's count, means and (co)variances
    over its common rows follow; only p² numbers reach the driver.
    """

    features: list[str]
    cut: float = CORRELATION_CUT
    matrix: list[list[float]] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)

    def fit(self, df: DataFrame) -> "CorrelationFilter":
        r = pairwise_correlation(df, self.features)
        r = {(a, b): float(r[i, j]) for i, a in enumerate(self.features) for j, b in enumerate(self.features)}
        self.matrix = [[1.0 if a == b else r.get((a, b)) for b in self.features] for a in self.features]
        self.dropped = upper_triangle_drops(self.features, self.matrix, self.cut)
        return self

    @property
    def kept(self) -> list[str]:
        return [c for c in self.features if c not in set(self.dropped)]

    def report(self, spark) -> DataFrame:
        rows = [(c, i, int(c in set(self.dropped))) for i, c in enumerate(self.features)]
        return spark.createDataFrame(rows, "feature string, position int, dropped int")

    def transform(self, df: DataFrame) -> DataFrame:
        drop = set(self.dropped)
        return df.select([c for c in df.columns if c not in drop])


# --- mutual information (F4) -------------------------------------------------

def fixed_width_bin(c: str, width: float):
    """Bin index ``floor(x / width)`` (used where the oracle must agree)."""
    return F.floor(F.col(c).cast("double") / F.lit(float(width)))


def quantile_bins(df: DataFrame, columns: list[str], bins: int = 16) -> dict[str, list[float]]:
    """Inner bin edges per column, exact at every size."""
    probs = [i / bins for i in range(1, bins)]
    found = cell_quantiles(df, columns, probs)[None]
    return {c: sorted(set(found.get(c, []))) for c in columns}


def edge_bin(c: str, edges: list[float]):
    """Bin index = number of edges ≤ x (a CASE chain, stays in codegen)."""
    x = F.col(c).cast("double")
    out = F.lit(0)
    for e in edges:
        out = out + (x >= F.lit(e)).cast("int")
    return F.when(x.isNull(), None).otherwise(out)


def mi_from_bins(binned: DataFrame, features: list[str], ybin: str = "__by") -> DataFrame:
    """Σ p(x,y)·ln(p(x,y)/(p(x)p(y))) per feature from binned columns.

    ``binned`` has one integer bin column per feature plus ``ybin``. The
    unpivoted ``(feature, bx, by)`` cells are counted with partial
    aggregation (a hot cell is reduced map-side); marginals are sums over
    the *count table* (features × bins² rows), not over the data.
    """
    long = binned.select(
        F.col(ybin).alias("by"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("bx"))
                            for c in features])).alias("kv"))
    cells = (long.select("kv.feature", "kv.bx", "by")
             .filter(F.col("bx").isNotNull() & F.col("by").isNotNull())
             .groupBy("feature", "bx", "by").agg(F.count(F.lit(1)).cast("double").alias("n")))
    wf = Window.partitionBy("feature")
    scored = (cells
              .withColumn("nf", F.sum("n").over(wf))
              .withColumn("nx", F.sum("n").over(Window.partitionBy("feature", "bx")))
              .withColumn("ny", F.sum("n").over(Window.partitionBy("feature", "by"))))
    terms = scored.select(
        "feature",
        ((F.col("n") / F.col("nf")) *
         F.log((F.col("n") * F.col("nf")) / (F.col("nx") * F.col("ny")))).alias("t"))
    pos = F.create_map(*[x for i, c in enumerate(features) for x in (F.lit(c), F.lit(i))])
    return (terms.groupBy("feature").agg(F.sum("t").alias("mi"))
            .select("feature", pos[F.col("feature")].alias("position"),
                    F.greatest(F.col("mi"), F.lit(0.0)).alias("mi")))


def mutual_information(df: DataFrame, features: list[str], label: str,
                       widths: dict[str, float] | None = None, bins: int = 16) -> DataFrame:
    """Binned MI of each feature with ``label`` → ``(feature, position, mi)``.

    Re-aimed from a nearest-neighbour estimator, which is single-machine:
    ranks may differ from it. ``widths`` (feature → bin width, including
    the label) gives fixed-width bins; else quantile bins.
    """
    if widths is not None:
        binned = df.select(*[fixed_width_bin(c, widths[c]).alias(c) for c in features],
                           fixed_width_bin(label, widths[label]).alias("__by"))
    else:
        edges = quantile_bins(df, features + [label], bins)
        binned = df.select(*[edge_bin(c, edges[c]).alias(c) for c in features],
                           edge_bin(label, edges[label]).alias("__by"))
    return mi_from_bins(binned, features)


def top_k(scores: DataFrame, k: int = MI_TOP_K, score: str = "mi") -> DataFrame:
    """k best by score; ties go to the later feature (O2)."""
    return scores.orderBy(F.desc(score), F.desc("position")).limit(k)


@dataclass
class TopKSelector:
    """Fit MI (or a pluggable score, H4) on one frame, apply the names to any."""

    features: list[str]
    label: str
    k: int = MI_TOP_K
    score_fn: Callable[[DataFrame, list[str], str], DataFrame] | None = None
    kept: list[str] = field(default_factory=list)

    def fit(self, df: DataFrame) -> "TopKSelector":
        if self.k >= len(self.features) and self.score_fn is None:
            # k = min(k, p) keeps every feature: the MI scores cannot change the result
            self.kept = list(self.features)
            return self
        fn = self.score_fn or mutual_information
        best = top_k(fn(df, self.features, self.label), min(self.k, len(self.features)))
        chosen = {r["feature"] for r in best.collect()}
        self.kept = [c for c in self.features if c in chosen]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        drop = set(self.features) - set(self.kept)
        return df.select([c for c in df.columns if c not in drop])
