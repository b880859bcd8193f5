"""Scoring a stream with a fitted feature chain and model.

The fitted chain is made of projections with literals and joins against
small fitted tables, and the model of a vector assembly plus a Spark ML
model transform; all of these are legal on a streaming DataFrame
(stream-static joins), so new rows arriving as files are scored with the
same code that scores a batch. The sink is Parquet with a checkpoint under
the shared checkpoint folder, so a restarted query resumes exactly once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.runtime import ensure_checkpoint_dir
from tessera.sources.fixture import KEY, sales_from
from tessera.sources.tables import read_table


def lineitem_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """lineitem files of ``sf_dir`` as a file stream (explicit schema)."""
    schema = read_table(spark, sf_dir, "lineitem").schema
    return (spark.readStream.schema(schema)
            .option("pathGlobFilter", "lineitem*.parquet")
            .option("maxFilesPerTrigger", files_per_trigger)
            .parquet(sf_dir))


def score_stream(spark: SparkSession, sf_dir: str, chain, model, out: str | None = None,
                 only_unlabelled: bool = True) -> DataFrame:
    """Run the stream to completion (``availableNow``) and return the written table.

    ``chain`` is a fitted :class:`tessera.plans.features.SalesFeatures`,
    ``model`` a fitted regressor from :mod:`tessera.operators.models`.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    run = uuid.uuid4().hex
    out = out or f"{root}/stream/{run}/out"
    rows = sales_from(lineitem_stream(spark, sf_dir), spark, sf_dir)
    if only_unlabelled:
        rows = rows.filter(F.col("split") == "test")
    feats = chain.apply(rows).select(*KEY, "split", *chain.features)
    scored = model.predict(feats, "prediction").select(
        *KEY, "split", "prediction", F.expm1("prediction").alias("sale_price"))
    q = (scored.writeStream.format("parquet")
         .option("checkpointLocation", f"{root}/stream/{run}/checkpoint")
         .trigger(availableNow=True)
         .start(out))
    q.awaitTermination()
    return spark.read.parquet(out)
