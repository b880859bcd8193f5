"""Quality classifier with hierarchical empirical Bayes.

A document has evidence of its own: the logit of a logistic regression on how
its text is built. It also stands at a place: a host, and a path within it. A
host moves the logit of its documents by an effect of its own, a path by one
around its host's. Effects are learnt from the labels there, with the evidence
as offset: the sum of (label − evidence) over the sum of evidence · (1 − evidence)
plus a prior's strength. How much hosts differ, and paths within them, is
estimated from the groups' own sums (method of moments) and gives the strength, so
a place with few labels is drawn to the level above and a well-known one
speaks for itself. A labelled document is left out of its own place.

Scale. Features are a narrow pass, written once. The regression is fitted on at
most ``max_docs`` labelled rows (a documented bound). Host and path levels are
grouped sums, combined before the shuffle; only five global sums reach the
driver. Groups return to their rows by joins that are broadcast if their counted
size allows it; a document on a place without labels takes the level above.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, small, staged

FEATURES = ("log_words", "distinct", "word_length", "symbols", "upper", "repeats", "digits", "long_words")
_SYMBOL, _UPPER, _DIGIT = re.compile(r"[^\w\s]"), re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"\d")


def features(text: str | None) -> list[float]:
    """How a text is built; null counts as empty, which gives zeros."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    return [math.log(n), len(set(words)) / n, min(20.0, chars / n - 1), len(_SYMBOL.findall(text)) / chars,
            len(_UPPER.findall(text)) / chars, sum(a == b for a, b in zip(words, words[1:])) / n,
            len(_DIGIT.findall(text)) / chars, sum(len(w) > 25 for w in words) / n]


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression by Newton steps, on the features as
    they are: ``(weights, bias)``."""
    base = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    bias = math.log(base / (1 - base))
    if not len(y) or y.min() == y.max():
        return np.zeros(x.shape[1]), bias
    mean, spread = x.mean(0), x.std(0)
    spread[spread <= 1e-9 * np.abs(x).max(0)] = 1  # equal values: their mean may be off by a rounding
    z = np.column_stack([(x - mean) / spread, ((x - mean) / spread) ** 2, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    w[-1] = bias
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    # back to the raw features: linear and squared terms
    k, linear, square = x.shape[1], w[:x.shape[1]] / spread, w[x.shape[1]:-1] / spread ** 2
    out = np.concatenate([linear - 2 * square * mean, square])
    return out, float(w[-1] - (linear * mean).sum() + (square * mean ** 2).sum()) if k else float(w[-1])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _variance(groups: DataFrame, r: str, v: str) -> float:
    """Variance of the groups' effects: what their sums of residuals ``r`` vary
    by beyond the chance ``v``."""
    got = groups.agg(F.sum(F.col(r) * F.col(r) - F.col(v)), F.sum(F.col(v) * F.col(v))).first()
    return min(max((got[0] or 0.0) / got[1], 0.0), 25.0) if got[1] else 0.0


def _effect(r: Column, v: Column, variance: float) -> Column:
    """The effect's posterior mean around zero."""
    return r / (v + F.lit(1 / variance)) if variance > 0 else F.lit(0.0)


def posterior(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              host_col: str = "source", path_col: str = "lang", label_col: str = "quality",
              max_docs: int = 4000) -> DataFrame:
    """One row per document: ``doc_id, held_out, evidence`` (the classifier's
    own probability), ``host_share, path_share`` (shrunken, without the
    document itself), ``score`` and ``keep`` (score 0.5 or more).

    Only labels of rows that are not held out (crc32 of the id, mod 5, not 0)
    are learnt from. ``host_share`` and ``path_share`` are the good share of a
    document with the evidence of the labels' mean there. Null hosts
    and paths are groups of their own; null and empty texts have zero features;
    repeated rows are documents of their own, and an id labelled twice has the
    larger label. Without usable labels every score is 0.5.
    """
    @F.pandas_udf("array<double>")
    def built(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    known = labels.filter(col(label_col).isin(0, 1) & col(id_col).isNotNull() & ~held_out(col(id_col)))
    known = known.groupBy(col(id_col).alias("id")).agg(F.max(col(label_col)).cast("double").alias("label"))
    rows = docs.select(col(id_col).alias("doc_id"), col(host_col).alias("host"), col(path_col).alias("path"),
                       built(col(text_col)).alias("x"))
    rows = rows.join(known, F.col("doc_id") == F.col("id"), "left").drop("id")
    rows = staged(rows, "features")
    sample = rows.filter("label is not null").orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(max_docs)
    sample = sample.select("x", "label").collect()
    x = np.array([r["x"] for r in sample], dtype=float).reshape(-1, len(FEATURES))
    weights, bias = _logistic(x, np.array([r["label"] for r in sample], dtype=float))

    logit = F.lit(bias)
    for k, w in enumerate(weights[:len(FEATURES)]):
        logit = logit + F.col("x")[k] * float(w)
    for k, w in enumerate(weights[len(FEATURES):]):
        logit = logit + F.col("x")[k] * F.col("x")[k] * float(w)
    logit = F.greatest(F.least(logit, F.lit(15.0)), F.lit(-15.0))
    rows = rows.withColumn("evidence", 1 / (1 + F.exp(-logit))).withColumn("r", F.coalesce(F.col("label") - F.col("evidence"), F.lit(0.0)))
    rows = rows.withColumn("v", F.when(F.col("label").isNotNull(), F.col("evidence") * (1 - F.col("evidence"))).otherwise(0.0))

    told = rows.filter("label is not null")
    paths = staged(told.groupBy("host", "path").agg(*[F.sum(c).alias(c) for c in ("r", "v")], F.sum("label").alias("s"), F.count("*").alias("n")), "paths")
    hosts = staged(paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("r", "v", "s", "n")]), "hosts")
    total = hosts.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    share = min(max((total["s"] or 0.0) / (total["n"] or 1), 1e-3), 1 - 1e-3) if total["n"] else 0.5
    host_var = _variance(hosts, "r", "v")
    hosts = hosts.select(F.col("host").alias("h"), F.col("r").alias("host_r"), F.col("v").alias("host_v"))
    beside = paths.join(small(hosts), F.col("host").eqNullSafe(F.col("h")))
    # what a path's residuals are beside its host's effect
    beside = beside.withColumn("beside", F.col("r") - F.col("v") * _effect(F.col("host_r"), F.col("host_v"), host_var))
    path_var = _variance(beside, "beside", "v")
    paths = paths.select(F.col("host").alias("ph"), F.col("path").alias("p"), F.col("r").alias("path_r"), F.col("v").alias("path_v"))

    at = rows.join(small(hosts), F.col("host").eqNullSafe(F.col("h")), "left")
    at = at.join(small(paths), F.col("host").eqNullSafe(F.col("ph")) & F.col("path").eqNullSafe(F.col("p")), "left")
    without = lambda c, own: F.greatest(F.coalesce(F.col(c), F.lit(0.0)) - F.col(own), F.lit(0.0)) if own == "v" else F.coalesce(F.col(c), F.lit(0.0)) - F.col(own)
    at = at.withColumn("host_effect", _effect(without("host_r", "r"), without("host_v", "v"), host_var))
    rest, chance = without("path_r", "r"), without("path_v", "v")
    at = at.withColumn("path_effect", F.col("host_effect") + _effect(rest - chance * F.col("host_effect"), chance, path_var))
    middle = math.log(share / (1 - share))
    moved = F.log(F.col("evidence") / (1 - F.col("evidence"))) + F.col("path_effect")
    return at.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "evidence",
                     _share(F.col("host_effect") + middle).alias("host_share"), _share(F.col("path_effect") + middle).alias("path_share"),
                     _share(moved).alias("score")).withColumn("keep", F.col("score") >= 0.5)


def _share(logit: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(40.0)), F.lit(-40.0))))
