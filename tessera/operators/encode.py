"""Encoders: alphabetical label codes (N1), graded maps (N2), one-hot.

Fit finds the distinct values per column (a table that grows with the
number of categories, not with rows). Apply is a projection: a literal map
lookup or a list of ``==`` tests; columns of many levels are coded by a join.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.expr import lookup
from tessera.runtime import bounded_broadcast, stage

# A map literal is searched value by value; with more levels than this, codes
# come from a join with the level table. The answer is the same.
LITERAL_LEVELS = 32


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long table ``(column, value)`` of non-NULL distinct values of all columns.

    One unpivot + one distinct (partial aggregation on the map side), so a
    value that fills a third of the rows is reduced before the shuffle.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("kv")).select("kv.column", "kv.value")
    return long.filter(F.col("value").isNotNull()).distinct()


@dataclass
class LabelEncoder:
    """Codes 0..m−1 by sorted text (N1): '1','10','11','12','2',… as in the reference.

    Any number of levels. Level tables are fitted and stay in Spark; only
    those of at most ``LITERAL_LEVELS`` rows are put into the plan.
    """

    columns: list[str]
    table: DataFrame | None = None

    def fit(self, df: DataFrame) -> "LabelEncoder":
        order = Window.partitionBy("column").orderBy("value")   # byte order
        self.table = stage(distinct_values(df, self.columns).withColumn(
            "code", (F.row_number().over(order) - 1).cast("int")), "levels")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        few = self.table.filter(F.col("code") < LITERAL_LEVELS).collect()
        long = {r["column"] for r in self.table.filter(F.col("code") >= LITERAL_LEVELS).select("column").distinct().collect()}
        codes = {c: {r["value"]: r["code"] for r in few if r["column"] == c} for c in self.columns}
        names, cur = df.columns, df
        for i, c in enumerate(c for c in self.columns if c in long):
            levels = self.table.filter(F.col("column") == c).select(
                F.col("value").alias(f"__value{i}"), F.col("code").alias(f"__code_{c}"))
            cur = cur.join(bounded_broadcast(levels), F.col(c).cast("string") == F.col(f"__value{i}"), "left")
        todo = set(self.columns)
        return cur.select([
            F.col(c) if c not in todo else F.col(f"__code_{c}").alias(c) if c in long
            else lookup(F.col(c).cast("string"), codes[c]).cast("int").alias(c)
            for c in names
        ])


def graded(df: DataFrame, maps: Mapping[str, tuple[Mapping[str, int], int]]) -> DataFrame:
    """Explicit graded maps (N2) with per-map default for unmapped values (I8)."""
    return df.select([
        lookup(F.col(c), maps[c][0], maps[c][1]).cast("int").alias(c) if c in maps else F.col(c)
        for c in df.columns
    ])


_UNSAFE = re.compile(r"[^0-9A-Za-z_]")


def dummy_name(column: str, value: str) -> str:
    """``column_value``; characters other than letters, digits and ``_`` become ``_``."""
    return f"{column}_{_UNSAFE.sub('_', value)}"


@dataclass
class OneHot:
    """One indicator per value, none dropped; NULL gives all zeros.

    Output order follows the reference's dummy expansion: the kept columns
    first, then per encoded column its dummies in value order. Values not
    seen at fit time give all zeros at score time. Of values whose names would be
    equal, the later ones get a number: ``c_a_b``, ``c_a_b_2``.
    """

    columns: list[str]
    levels: dict[str, list[str]] = field(default_factory=dict)
    names: dict[tuple[str, str], str] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "OneHot":
        """One output column per level, so the levels are as many as columns."""
        found = distinct_values(df, self.columns).orderBy("column", "value").collect()
        self.levels = {c: [r["value"] for r in found if r["column"] == c] for c in self.columns}
        taken = {c.lower() for c in df.columns if c not in self.columns}
        self.names = {}
        for c in self.columns:
            for v in self.levels[c]:
                plain = name = dummy_name(c, v)
                n = 1
                while name.lower() in taken:
                    n += 1
                    name = f"{plain}_{n}"
                taken.add(name.lower())
                self.names[c, v] = name
        return self

    def dummy_names(self) -> list[str]:
        return list(self.names.values())

    def transform(self, df: DataFrame) -> DataFrame:
        todo = set(self.columns)
        kept = [F.col(c) for c in df.columns if c not in todo]
        dummies = [
            F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(name)
            for (c, v), name in self.names.items()
        ]
        return df.select(*kept, *dummies)
