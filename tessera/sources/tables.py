"""Readers: Parquet test tables and header CSV with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The missing-value tokens a CSV reader of the studied kind
# turns into nulls by default (plus the empty string).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")


def normalise_na_tokens(df: DataFrame, columns: list[str] | None = None,
                        tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    """Turn every NA token in the string ``columns`` into SQL NULL (S3).

    Spark's CSV ``nullValue`` takes a single token, so the rest of the list
    is applied as one projection (a single ``select``, codegen-friendly).
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    todo = set(columns)
    return df.select([
        F.when(F.col(c).isin(list(tokens)), F.lit(None).cast("string"))
        .otherwise(F.col(c)).alias(c) if c in todo else F.col(c)
        for c in df.columns
    ])


def read_csv_table(spark: SparkSession, path: str, schema: StructType,
                   string_na: bool = True) -> DataFrame:
    """Header CSV with an explicit schema (S1/S2); never ``inferSchema``.

    Every token of :data:`NA_TOKENS` is a null in columns that are not text;
    with ``string_na`` in text columns too, else only ``NA`` is, there. Any
    other value that is not of its column's type fails the read.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    df = (spark.read.schema(text).option("header", True)
          .option("nullValue", "NA").option("mode", "FAILFAST").csv(path))
    df = normalise_na_tokens(df, None if string_na else [
        f.name for f in schema.fields if not isinstance(f.dataType, StringType)])

    def typed(f):
        if isinstance(f.dataType, StringType):
            return F.col(f.name)
        value = F.col(f.name).try_cast(f.dataType)
        bad = F.col(f.name).isNotNull() & value.isNull()
        wrong = F.raise_error(F.concat(F.lit(f"column {f.name} has the value "), F.col(f.name))).cast(f.dataType)
        return F.when(bad, wrong).otherwise(value).alias(f.name)

    return df.select([typed(f) for f in schema.fields])


def labelled_unlabelled(labelled: DataFrame, unlabelled: DataFrame,
                        split_col: str = "split") -> DataFrame:
    """Stack the labelled and unlabelled halves by column name.

    A column present on one side only (the target) is null on the other.
    The halves are told apart by ``split_col``, never by position.
    """
    return (labelled.withColumn(split_col, F.lit("train"))
            .unionByName(unlabelled.withColumn(split_col, F.lit("test")),
                         allowMissingColumns=True))
