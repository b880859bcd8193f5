"""Most frequent values with bounded memory (P3, I4): Misra-Gries summaries, proven exactly.

Counting every value shuffles a key-like column whole. Here a task keeps at most
``capacity`` counters a column: when it has more, the largest count that does not fit is
taken off all of them, and remembered. The sum of what tasks took off, ``lost``, bounds how much any
value is undercounted, so a value without a counter occurs at most ``lost`` times. Values
that can be the most frequent one are then counted exactly in one more pass, and the
winner is proven if it occurs more than ``lost`` times. A column without a proven winner is
left to the full count.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tessera.runtime import bounded_broadcast, stage

CAPACITY = 1024  # counters a column and task


def _summaries(columns: list[str], capacity: int):
    def run(batches):
        held = {c: pd.Series(dtype="int64") for c in columns}
        lost = dict.fromkeys(columns, 0)
        for pdf in batches:
            for c in columns:
                counts = held[c].add(pdf[c].value_counts(), fill_value=0).astype("int64")
                if len(counts) > capacity:
                    off = int(counts.nlargest(capacity + 1).iloc[-1])
                    lost[c] += off
                    counts = counts[counts > off] - off
                held[c] = counts
        for i, c in enumerate(columns):
            yield pd.DataFrame({"at": i, "value": [None, *held[c].index], "n": [lost[c], *held[c]]})
    return run


def proven_modes(df: DataFrame, columns: list[str], capacity: int = CAPACITY) -> dict[str, str | None]:
    """``{column: most frequent value as text}`` of the columns where it is proven; None if all
    values are NULL. Ties go to the smallest value, by number in numeric columns."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    found = stage(texts.mapInPandas(_summaries(columns, capacity), "at int, value string, n long"), "summaries")
    lower = found.filter(F.col("value").isNotNull()).groupBy("at", "value").agg(F.sum("n").alias("n"))
    bounds = found.groupBy("at").agg(F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("lost")).join(
        lower.groupBy("at").agg(F.max("n").alias("best")), "at", "left")
    lost = {r["at"]: r["lost"] for r in bounds.collect()}   # a row per column
    possible = stage(lower.join(F.broadcast(bounds), "at").filter(F.col("n") + F.col("lost") >= F.col("best")).select("at", "value", "n"), "possible")
    # counts are exact where nothing was taken off
    again = [i for i in range(len(columns)) if lost.get(i, 0)]
    exact = possible.filter(~F.col("at").isin(again))
    if again:
        long = texts.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("at"), F.col(columns[i]).alias("value")) for i in again])).alias("kv")).select("kv.at", "kv.value")
        exact = exact.unionByName(long.join(bounded_broadcast(possible.select("at", "value")), ["at", "value"]).groupBy(
            "at", "value").agg(F.count("*").alias("n")))
    numeric = [i for i, c in enumerate(columns) if isinstance(df.schema[c].dataType, NumericType)]
    number = F.when(F.col("at").isin(numeric), F.expr("try_cast(value AS double)"))
    tops = {r["at"]: r["top"] for r in exact.groupBy("at").agg(F.min_by(
        F.struct("value", "n"), F.struct(-F.col("n"), number, F.col("value"))).alias("top")).collect()}
    modes: dict[str, str | None] = {}
    for i, c in enumerate(columns):
        top = tops.get(i)
        if top is not None and top["n"] > lost[i]:
            modes[c] = top["value"]
        elif top is None and not lost.get(i, 0):
            modes[c] = None
    return modes
