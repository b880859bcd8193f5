"""A stream scored with the fitted chain gives the batch predictions."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.models import lasso
from tessera.plans.catalogue_models import feature_chain
from tessera.sources.fixture import KEY
from tessera.streaming.score import score_stream

from .conftest import SF_SMALL


def test_stream_equals_batch(spark):
    df, fe = feature_chain(spark, SF_SMALL)
    fitted = lasso(0.0005).fit(df.filter(F.col("split") == "train"), fe.features, "y")
    batch = {tuple(r[k] for k in KEY): r.prediction for r in fitted.predict(
        df.filter(F.col("split") == "test"), "prediction").collect()}
    streamed = {tuple(r[k] for k in KEY): r.prediction
                for r in score_stream(spark, SF_SMALL, fe, fitted).collect()}
    assert streamed.keys() == batch.keys()
    for k, v in batch.items():
        assert streamed[k] == pytest.approx(v, abs=1e-9)
