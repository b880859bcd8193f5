"""Missing-value operators (I1-I8) and the outlier filter.

Fit = one aggregation; apply = one projection (plus, for per-group
statistics, one left join against a table with one row per group).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.frequent import proven_modes
from tessera.operators.stats import group_quantiles
from tessera.runtime import bounded_broadcast, stage


def drop_outliers(df: DataFrame, condition: Column, only_where: Column | None = None) -> DataFrame:
    """Drop rows where ``condition`` is true.

    A row whose condition is NULL (a side is missing) is kept, as a NaN
    comparison is false in the reference; plain ``~condition`` would drop
    it. ``only_where`` limits the rule to, e.g., the labelled half.
    """
    hit = F.coalesce(condition, F.lit(False))
    if only_where is not None:
        hit = hit & F.coalesce(only_where, F.lit(False))
    return df.filter(~hit)


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill NULLs with fixed values per column (I1, I2, I3) in one projection."""
    return df.select([
        F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
        for c in df.columns
    ])


@dataclass
class ModeImputer:
    """Fill NULLs with the column mode (I4).

    Nulls are not counted; ties go to the smallest value. Modes come from
    bounded summaries and an exact count of the few values that can be most
    frequent (:func:`frequent.proven_modes`). Columns without a proven one are
    fitted from one grouped count of ``(column, value)`` pairs (map-side
    combine, so a value holding a third of the rows costs no more than any
    other); unlike the ``mode`` aggregate, no single task ever holds every
    distinct value.
    """

    columns: list[str]
    modes: dict[str, object] | None = None

    def fit(self, df: DataFrame) -> "ModeImputer":
        from tessera.operators.select import dominance
        types = {f.name: f.dataType for f in df.schema.fields}
        top = proven_modes(df, self.columns)
        rest = [c for c in self.columns if c not in top]
        if rest:
            top |= {r["feature"]: r["top_value"] for r in dominance(df, rest).collect()}
        # the count table holds text; bring each value back to its column's type
        row = df.sparkSession.range(1).select(*[
            F.lit(top.get(c)).cast(types[c]).alias(c) for c in self.columns]).first()
        self.modes = {c: row[c] for c in self.columns}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return fill_constant(df, {c: v for c, v in self.modes.items() if v is not None})


@dataclass
class GroupMedianImputer:
    """Fill NULLs with the exact, interpolated median of the row's group.

    * a group with no value keeps its NULLs;
    * a row whose group key is NULL becomes NULL, even if it had a value
      (the grouped transform of the reference drops NULL keys).

    Fit is :func:`stats.group_quantiles`: exact at every size, and a hot group
    is counted on the map side, never sorted whole in one task. The group
    table is joined back, broadcast only when its size is checked.
    """

    columns: list[str]
    by: str
    table: DataFrame | None = None

    def fit(self, df: DataFrame) -> "GroupMedianImputer":
        long = df.filter(F.col(self.by).isNotNull()).select(self.by, F.explode(F.array(*[
            F.struct(F.lit(i).alias("at"), F.col(c).cast("double").alias("x")) for i, c in enumerate(self.columns)])).alias("kv"))
        found = group_quantiles(long.select(self.by, "kv.*"), [self.by, "at"], [0.5])
        self.table = stage(found.groupBy(self.by).agg(*[
            F.max(F.when(F.col("at") == i, F.col("q")[0])).alias(f"__med_{c}") for i, c in enumerate(self.columns)]), "medians")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        joined = df.join(bounded_broadcast(self.table), on=self.by, how="left")
        todo = set(self.columns)
        key = F.col(self.by)
        return joined.select([
            F.when(key.isNull(), F.lit(None).cast("double"))
            .otherwise(F.coalesce(F.col(c).cast("double"), F.col(f"__med_{c}"))).alias(c)
            if c in todo else F.col(c)
            for c in df.columns
        ])


@dataclass
class GroupMeanFeature:
    """Mean of ``column`` within the row's group as a new feature.

    Rows with a NULL group key (or an all-NULL group) get the global mean.
    Fit is one ``groupBy`` of (sum, count); the global mean is reduced from
    that small table, so the data is read once.
    """

    column: str
    by: str
    name: str
    table: DataFrame | None = None
    global_mean: float | None = None

    def fit(self, df: DataFrame) -> "GroupMeanFeature":
        sums = stage(df.groupBy(self.by).agg(F.sum(F.col(self.column).cast("double")).alias("__s"),
                                             F.count(self.column).alias("__n")), "group-sums")
        tot = sums.agg(F.sum("__s").alias("s"), F.sum("__n").alias("n")).first()
        self.global_mean = (tot["s"] / tot["n"]) if tot["n"] else None
        self.table = (sums.filter(F.col(self.by).isNotNull())
                      .select(self.by, (F.col("__s") / F.col("__n")).alias(f"__gm_{self.name}")))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        joined = df.join(bounded_broadcast(self.table), on=self.by, how="left")
        return joined.select(
            *[F.col(c) for c in df.columns],
            F.coalesce(F.col(f"__gm_{self.name}"), F.lit(self.global_mean).cast("double"))
            .alias(self.name))
