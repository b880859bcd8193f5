"""One-hot for any number of levels (N3, P6): one sparse vector column.

The levels are a table in Spark, never a list on the driver, and no column is made
per level. A level's place in the vector is its rank by (column, value), found in two
steps: a range-partitioned sort with places inside each range, and the counts
of the ranges before it. The table also holds how many rows have the level, so the
variance of every indicator, share × (1 − share), is known without a further pass
and levels are selected before any vector is made (F1, F2).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tessera.runtime import bounded_broadcast, stage

# Vectors of up to so many places carry the names of all of them in their attributes;
# longer ones carry their size, and the names are the table `names()`.
NAMED_PLACES = 10_000


def _placed(levels: DataFrame) -> DataFrame:
    """``levels`` with ``position``: 0, 1, … by (at, value)."""
    parts = stage(levels.repartitionByRange("at", "value").withColumn("part", F.spark_partition_id()), "level-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = parts.groupBy("part").agg(F.count("*").alias("many")).select(
        "part", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy("at", "value")
    return stage(parts.withColumn("inside", F.row_number().over(inside)).join(F.broadcast(starts), "part").select(
        "at", "value", "n", (F.col("start") + F.col("inside") - 1).cast("int").alias("position")), "levels")


@dataclass
class SparseOneHot:
    """One place per value of ``columns``, none dropped; NULL and values not seen at fit
    time set no place.

    Places go by column as listed, then by value as text in byte order. ``fit`` is
    one grouped count over all columns (map-side combine, so a hot value is one row a
    task). ``transform`` joins each column with its levels, broadcast if their counted
    size allows it.
    """

    columns: list[str]
    levels: DataFrame | None = None   # at, value, n, position
    rows: int = 0
    size: int = 0

    def fit(self, df: DataFrame) -> "SparseOneHot":
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("value")) for i, c in enumerate(self.columns)])).alias("kv"))
        counts = stage(long.groupBy("kv.at", "kv.value").agg(F.count("*").alias("n")), "level-counts")
        # every row has one value, or none, of the first column
        self.rows = counts.filter("at = 0").agg(F.sum("n")).first()[0] or 0
        return self._of(counts.filter(F.col("value").isNotNull()))

    def _of(self, counts: DataFrame) -> "SparseOneHot":
        self.levels = _placed(counts)
        self.size = self.levels.count()
        return self

    def selected(self, cut: float, population: bool = True) -> "SparseOneHot":
        """Only the levels whose indicator varies by more than ``cut``, at new places."""
        share = F.col("n") / F.lit(float(max(self.rows, 1)))
        variance = share * (1 - share)
        if not population:
            variance = variance * F.lit(self.rows / max(self.rows - 1, 1))
        return replace(self)._of(self.levels.filter(variance > cut).drop("position"))

    def names(self) -> DataFrame:
        """``(position, column, value, n, name)``. A name is ``column_value`` with all but letters,
        digits and ``_`` replaced by ``_``; equal ones get their place appended."""
        column = F.element_at(F.array(*map(F.lit, self.columns)), F.col("at") + 1)
        plain = F.concat_ws("_", "column", F.regexp_replace("value", "[^0-9A-Za-z_]", "_"))
        named = self.levels.withColumn("column", column).withColumn("plain", plain).withColumn("key", F.lower("plain"))
        equal = named.groupBy("key").agg(F.count("*").alias("many")).filter("many > 1")
        return named.join(bounded_broadcast(equal), "key", "left").select(
            "position", "column", "value", "n",
            F.when(F.col("many").isNull(), F.col("plain")).otherwise(F.concat_ws("_", "plain", "position")).alias("name"))

    def positions(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` without the encoded columns, with the places that a row sets (ascending)."""
        cur, found = df, []
        for i, c in enumerate(self.columns):
            key, place = f"__value{i}", f"__place{i}"
            levels = self.levels.filter(F.col("at") == i).select(F.col("value").alias(key), F.col("position").alias(place))
            cur = cur.join(bounded_broadcast(levels), F.col(c).cast("string") == F.col(key), "left")
            found.append(F.col(place))
        return cur.select(*[F.col(c) for c in df.columns if c not in self.columns],
                          F.array_compact(F.array(*found)).alias(out))

    def transform(self, df: DataFrame, out: str = "one_hot") -> DataFrame:
        """``df`` with the vector in place of the encoded columns."""
        places = self.positions(df, out)
        vector = F.struct(F.struct(F.lit(0).alias("type"), F.lit(self.size).alias("size"), F.col(out).alias("indices"),
                                   F.transform(out, lambda _: F.lit(1.0)).alias("values")).alias("v"))
        # JSON is the built-in way from a struct to a sparse vector
        vector = F.from_json(F.to_json(vector), StructType([StructField("v", VectorUDT())]))["v"]
        attributes: dict = {"num_attrs": self.size}
        if 0 < self.size <= NAMED_PLACES:
            attributes["attrs"] = {"binary": [{"idx": r["position"], "name": r["name"]}
                                              for r in self.names().select("position", "name").orderBy("position").collect()]}
        return places.withColumn(out, vector.alias(out, metadata={"ml_attr": attributes}))
