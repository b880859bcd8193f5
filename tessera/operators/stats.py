"""Column statistics and the transforms fitted from them.

Every statistic of every column is computed in *one* aggregation per
phase; the per-column report is produced lazily with ``stack`` from that
single row, so nothing is looped on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.expr import BOXCOX_LAMBDA, PCA_SHARE, SKEW_CUT, boxcox1p
from tessera.operators.quantiles import cell_quantiles
from tessera.runtime import bounded_broadcast, stage


# Aggregates per pass when a statistic is taken of many columns: very wide
# aggregations fall out of whole-stage codegen, while Parquet is columnar,
# so k narrow passes read the same bytes as one wide pass.
AGG_CHUNK = 20


def collect_agg(df: DataFrame, exprs: dict[str, Column], chunk: int = AGG_CHUNK) -> dict:
    """Evaluate named aggregate expressions, ``chunk`` per pass → {name: value}."""
    names = list(exprs)
    out: dict = {}
    for i in range(0, len(names), chunk):
        part = names[i:i + chunk]
        row = df.agg(*[exprs[n].alias(f"c{j}") for j, n in enumerate(part)]).first()
        out.update({n: row[f"c{j}"] for j, n in enumerate(part)})
    return out


def long_report(row_df: DataFrame, names: list[str], value: str,
                name_col: str = "feature") -> DataFrame:
    """Turn a one-row frame with one column per feature into ``(feature, value)`` rows."""
    args = ", ".join(f"'{n}', `{n}`" for n in names)
    return row_df.select(F.expr(f"stack({len(names)}, {args}) AS ({name_col}, {value})"))


def skewness_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Skewness of each column, NULLs ignored, population-moment form.

    A constant column gives NULL. Sorted by skew descending (O1).
    """
    row = df.agg(*[F.skewness(F.col(c).cast("double")).alias(c) for c in columns])
    return long_report(row, columns, "skew").orderBy(F.desc_nulls_last("skew"), "feature")


@dataclass
class BoxCoxSkewed:
    """Box-Cox(1+x, λ) on the columns whose |skew| exceeds a cut."""

    columns: list[str]
    cut: float = SKEW_CUT
    lam: float = BOXCOX_LAMBDA
    skews: dict[str, float | None] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "BoxCoxSkewed":
        self.skews = collect_agg(df, {c: F.skewness(F.col(c).cast("double"))
                                      for c in self.columns})
        return self

    @property
    def chosen(self) -> list[str]:
        return [c for c, s in self.skews.items() if s is not None and abs(s) > self.cut]

    def transform(self, df: DataFrame) -> DataFrame:
        todo = set(self.chosen)
        return df.select([boxcox1p(c, self.lam).alias(c) if c in todo else F.col(c)
                          for c in df.columns])


def group_quantiles(values: DataFrame, by: list[str], probs: list[float], gather: int = 20_000,
                    accuracy: int = 1000) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``x`` per group of ``by``:
    ``(by..., q)`` with one array element per probability, at every size.

    A group's values are split at approximate quantiles (fixed memory, only
    pivots: their error moves no result) and counted per slice. Only slices that
    hold a wanted rank are kept, as ``(value, count)`` rows, and are split again
    until a group has at most ``gather`` different values left; the ranks are
    read off those. NULL and NaN are left out; a group without a value has
    no row, equal NULL keys are a group.
    """
    keys = [f"k{i}" for i in range(len(by))]
    p = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(v)).alias("p")) for i, v in enumerate(probs)]))
    rows = values.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col("x").cast("double").alias("x"),
                         F.lit(1).cast("long").alias("c")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    pairs = rows.agg(F.approx_count_distinct(F.struct(*keys, "x"))).first()[0]
    if pairs <= 10 * gather:
        # few different values: their counts are ranked as they are
        return _ranked_counts(rows.groupBy(*keys, "x").agg(F.sum("c").alias("c")), by, keys, probs)
    # around each wanted rank a narrow slice, far wider than the pivots' error
    margin = 4.0 / accuracy
    grid = sorted({min(1.0, max(0.0, v + s)) for v in probs for s in (-margin, margin)})
    ranks = None
    while True:
        cut = stage(rows.groupBy(*keys).agg(
            F.sum("c").alias("n"), F.percentile_approx("x", grid, accuracy).alias("pivots")), "pivots")
        if ranks is None:
            at = cut.select(*keys, "n", p.alias("p")).select(
                *keys, F.col("p.i").alias("i"), (F.col("p.p") * (F.col("n") - 1)).alias("position"))
            ranks = at.select(*keys, "i", "position", F.explode(F.array_distinct(F.array(
                F.floor("position"), F.ceil("position")))).alias("rank")).withColumn("r", F.col("rank"))
        cut = cut.select(*[F.col(k).alias(f"{k}_") for k in keys], "pivots")
        sliced = rows.join(bounded_broadcast(cut), _same(keys, [f"{k}_" for k in keys])).withColumn(
            "slice", F.size(F.filter("pivots", lambda v: v < F.col("x")))).select(*keys, "slice", "x", "c")
        # at most one row per pivot and group
        sizes = stage(sliced.groupBy(*keys, "slice").agg(F.sum("c").alias("c")), "slices")
        before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0))).select(
            *[F.col(k).alias(f"{k}_") for k in keys], "slice", F.col("c").alias("size"), "before")
        placed = ranks.join(sizes, _same(keys, [f"{k}_" for k in keys]) & (F.col("r") >= F.col("before")) & (
            F.col("r") < F.col("before") + F.col("size")))
        placed = stage(placed.select(*keys, "i", "position", "rank", (F.col("r") - F.col("before")).alias("r"), "slice"), "ranks")
        needed = placed.select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("slice").alias("slice_")).distinct()
        cells = sliced.join(bounded_broadcast(needed), _same([*keys, "slice"], [f"{k}_" for k in (*keys, "slice")]), "left_semi")
        cells = stage(cells.groupBy(*keys, "slice", "x").agg(F.sum("c").alias("c")), "cells")
        most = cells.groupBy(*keys, "slice").count().agg(F.max("count")).first()[0]
        if (most or 0) <= gather:
            break
        # a slice is a group of its own from here on
        rows = cells.withColumnRenamed("slice", f"k{len(keys)}")
        ranks = placed.withColumnRenamed("slice", f"k{len(keys)}")
        keys = [*keys, f"k{len(keys)}"]
        grid = [i / 64 for i in range(1, 64)]
    upto = Window.partitionBy(*keys, "slice").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("upto", F.sum("c").over(upto)).select(
        *[F.col(k).alias(f"{k}_") for k in (*keys, "slice")], "x", "upto", (F.col("upto") - F.col("c")).alias("from"))
    found = placed.join(cells, _same([*keys, "slice"], [f"{k}_" for k in (*keys, "slice")]) & (F.col("r") >= F.col("from")) & (
        F.col("r") < F.col("upto")))
    group = [F.col(k) for k in keys[:len(by)]]
    found = found.groupBy(*group, "i").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.first("position").alias("position"))
    between = F.col("position") - F.floor("position")
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        (1 - between) * F.col("low") + between * F.col("high"))
    out = found.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("i", value.alias("v")))).alias("q"))
    return out.select(*[k.alias(c) for k, c in zip(group, by)], F.col("q.v").alias("q"))


def _ranked_counts(cells: DataFrame, by: list[str], keys: list[str], probs: list[float]) -> DataFrame:
    """Quantiles from the counts of a group's different values."""
    of = Window.partitionBy(*keys)
    upto = of.orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("upto", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(of))

    def value(rank):
        return F.min(F.when(F.col("upto") > rank, F.col("x")))

    picks = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("n") - 1)
        picks += [value(F.floor(at)).alias(f"low{i}"), value(F.ceil(at)).alias(f"high{i}")]
    found = cells.groupBy(*keys, "n").agg(*picks)
    q = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("n") - 1)
        between = at - F.floor(at)
        q.append(F.when(F.col(f"low{i}") == F.col(f"high{i}"), F.col(f"low{i}")).otherwise(
            (1 - between) * F.col(f"low{i}") + between * F.col(f"high{i}")))
    return found.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], F.array(*q).alias("q"))


def _same(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[float]]:
    """Quantiles of whole columns; a column without a value is left out."""
    return cell_quantiles(df, columns, probs)[None]


@dataclass
class RobustScaler:
    """(x − median) / (q75 − q25), a zero spread divides by 1.

    Quartiles are exact and linearly interpolated at every size
    (:func:`tessera.operators.quantiles.cell_quantiles`). Spark ML's
    RobustScaler is not used: it maps zero-spread columns to 0, which would
    erase nearly every one-hot column.
    """

    columns: list[str]
    center: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "RobustScaler":
        qs = column_quantiles(df, self.columns, [.25, .5, .75]) if self.columns else {}
        for c in self.columns:
            low, mid, high = qs.get(c, (0.0, 0.0, 0.0))
            self.center[c], self.scale[c] = mid, (high - low) or 1.0
        return self

    def expressions(self) -> dict[str, Column]:
        return {c: (F.col(c).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])
                for c in self.columns}

    def transform(self, df: DataFrame) -> DataFrame:
        ex = self.expressions()
        return df.select([ex[c].alias(c) if c in ex else F.col(c) for c in df.columns])


def pca_keep_share(df: DataFrame, array_col: str, keep: list[str],
                   share: float = PCA_SHARE) -> tuple[DataFrame, int]:
    """PCA keeping the smallest k whose explained variance reaches ``share`` (T4).

    Input is an array column. The columns are robust-scaled first (median
    and quartiles of the values at each position, exact at every size), then
    mean-centred, because
    Spark's PCA projects without centring. Returns (frame with ``pcs``
    array, k).
    """
    dims = df.select(F.size(array_col).alias("d")).agg(F.max("d")).first()[0]
    q = column_quantiles(df.select(*[F.get(array_col, F.lit(i)).alias(f"p{i}") for i in range(dims)]),
                         [f"p{i}" for i in range(dims)], [.25, .5, .75])
    q = [q.get(f"p{i}", [0.0, 0.0, 0.0]) for i in range(dims)]
    med = [m for _, m, _ in q]
    spread = [(high - low) or 1.0 for low, _, high in q]
    med_arr = F.array(*[F.lit(float(v)) for v in med])
    spr_arr = F.array(*[F.lit(float(v)) for v in spread])
    scaled = df.select(
        *keep,
        array_to_vector(F.zip_with(
            F.zip_with(F.col(array_col), med_arr, lambda x, m: x.cast("double") - m),
            spr_arr, lambda d, s: d / s)).alias("__v"))
    centred = StandardScaler(inputCol="__v", outputCol="__c", withMean=True,
                             withStd=False).fit(scaled).transform(scaled)
    full = PCA(k=dims, inputCol="__c", outputCol="__p").fit(centred)
    ratios = list(full.explainedVariance.toArray())
    k, acc = len(ratios), 0.0
    for i, r in enumerate(ratios):
        acc += r
        if acc >= share - 1e-12:
            k = i + 1
            break
    # components come ordered by variance: the first k of the full fit are the k-fit
    out = full.transform(centred).select(
        *keep, F.slice(vector_to_array("__p"), 1, k).alias("pcs"))
    return out, k

