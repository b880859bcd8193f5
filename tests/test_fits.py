"""How fits share memory, and boosted models made of the trees of others."""

import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import runtime
from tessera.operators.models import Trees

FEATS = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(240, 2))
    y = x[:, 0] * x[:, 1] + rng.normal(scale=0.8, size=240)
    return spark.createDataFrame([(i, i % 3, float(y[i]), *map(float, x[i])) for i in range(240)],
                                 "k long, f long, y double, a double, b double").coalesce(1)


class _Slow:
    """Notes how many values are held by fits at once."""
    held, most, lock = 0, 0, threading.Lock()

    def fit(self, df, features, label):
        n = 240 * len(features)
        with self.lock:
            _Slow.held += n
            _Slow.most = max(_Slow.most, _Slow.held)
        time.sleep(0.3)
        with self.lock:
            _Slow.held -= n


@pytest.mark.parametrize("allowed,want", [(100, 480), (2 * 480, 2 * 480), (100 * 480, 4 * 480)])
def test_fits_at_once_are_bounded_by_their_values(rows, monkeypatch, allowed, want):
    monkeypatch.setattr(runtime, "fit_values", lambda spark: allowed)
    _Slow.held = _Slow.most = 0
    runtime.side_by_side(lambda n: runtime.fit_in_slot(_Slow(), rows, FEATS, "y", n), [240] * 4)
    assert _Slow.most == want


def test_large_tables_are_not_kept_in_memory(rows, monkeypatch):
    kept, n = runtime.fit_table(rows, FEATS)
    assert n == 240 and kept.storageLevel.useMemory
    kept.unpersist()
    monkeypatch.setattr(runtime, "FIT_VALUES", 1)
    read, n = runtime.fit_table(rows.select("*"), FEATS)
    assert n == 240 and not read.storageLevel.useMemory and read.count() == 240


def test_mean_of_boosters_is_one_model(rows):
    fits = [Trees("gbt", dict(maxIter=4, maxDepth=3, seed=s)).fit(rows.filter(F.col("f") != s), FEATS, "y") for s in range(3)]
    each = np.array([[r.p for r in f.predict(rows, "p").orderBy("k").collect()] for f in fits])
    one = fits[0].mean(fits)
    got = np.array([r.p for r in one.predict(rows, "p").orderBy("k").collect()])
    assert np.allclose(got, each.mean(axis=0), rtol=1e-12) and len(one.model.trees) == 12


def test_patience_fits_once(rows, monkeypatch):
    """The model of the best round is the first rounds of the only fit."""
    from tessera.operators import models
    fitted, plain = [], models.GBTRegressor.fit
    monkeypatch.setattr(models.GBTRegressor, "fit", lambda self, *a: fitted.append(plain(self, *a)) or fitted[-1])
    model = Trees("gbt", dict(maxIter=15, stepSize=0.9, maxDepth=5, seed=1), early_stop_col="held", patience=3)
    out = model.fit(rows.withColumn("held", F.col("f") == 0), FEATS, "y")
    assert len(fitted) == 1 and 0 < len(out.model.trees) == models.best_round(model.errors, 3) < 15
    assert [t.toDebugString for t in out.model.trees] == [t.toDebugString for t in fitted[0].trees[:len(out.model.trees)]]
    assert list(out.model.treeWeights) == list(fitted[0].treeWeights[:len(out.model.trees)])


def test_no_more_threads_than_slots():
    now, most, lock = 0, 0, threading.Lock()

    def job(n):
        nonlocal now, most
        with lock:
            now += 1
            most = max(most, now)
        time.sleep(0.02)
        with lock:
            now -= 1
        return n

    assert runtime.side_by_side(job, range(50)) == list(range(50))
    assert most <= runtime.FIT_SLOTS.most
