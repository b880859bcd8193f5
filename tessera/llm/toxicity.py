"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with word-boundary marks) and
itself, all in one table of vectors; a word's vector is the mean of
its subwords', a text's vector the average of its words' (each counted with the
square root of its occurrences, over a few blank words more, so that neither a
repeated nor a lone word decides), and a linear softmax on that gives the class.
Table and softmax are trained jointly (Adam, full batch) in numpy, so a
misspelling that never occurred in training shares most of its n-gram vectors
with the word it stands for. Subwords that are in few or in very many training
texts keep the zero vector.

Scale. The fit uses at most ``max_docs`` labelled rows (a documented bound; the
rows with the smallest id hashes, so it does not depend on partitioning).
Training on them takes one process. Scoring is a narrow pass over whole texts:
as the softmax is linear, the table folds into one number per subword, which is
all that is broadcast. A kept subword is in at least the share ``rarest`` of a
bounded number of texts, so their number does not grow with the data.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh

_WORD = re.compile(r"\w+")
MAX_SUBWORDS_OF = 64    # a longer run of letters is cut into pieces of this length
CACHE_WORDS = 400_000   # words whose score a task remembers


@dataclass(frozen=True)
class Settings:
    max_docs: int = 2400        # a third of them toxic, if there are so many
    dim: int = 4
    shortest: int = 3
    longest: int = 4
    rarest: float = 0.01        # share of the training texts a subword must be in
    commonest: float = 0.2      # and may be in, unless one class has it
    telling: float = 2.0        # times as often as the other
    blanks: float = 20.0
    scale: float = 30.0         # of the average, so that rare words can count
    epochs: int = 40
    rate: float = 0.05
    decay: float = 0.3          # of the table, over the number of texts
    seed: int = 11


def words_of(text: str | None) -> list[str]:
    """Lower-cased words; runs over 64 characters are cut, none is left out."""
    if not text:
        return []
    words = _WORD.findall(text.lower())
    if max(map(len, words), default=0) <= MAX_SUBWORDS_OF:
        return words
    return [w[i:i + MAX_SUBWORDS_OF] for w in words for i in range(0, len(w), MAX_SUBWORDS_OF)]


def subwords(word: str, s: Settings) -> list[str]:
    """A word and its n-grams, with boundary marks."""
    m = f"<{word}>"
    return [m, *[m[i:i + n] for n in range(s.shortest, s.longest + 1) for i in range(len(m) - n + (n < len(m)))]]


def bag(text: str | None) -> tuple[list[str], np.ndarray]:
    """A text's words and their shares, before blanks are counted."""
    counts = Counter(words_of(text))
    return list(counts), np.sqrt(np.fromiter(counts.values(), float, len(counts)))


def _features(texts: list[str | None], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Averaging matrix text x subword as ``(row, column, weight)``, and the
    subwords."""
    ids: dict[str, int] = {}
    known: dict[str, np.ndarray] = {}
    rows, columns, weights = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
    for n, text in enumerate(texts):
        words, share = bag(text)
        if not words:
            continue
        for w in words:
            if w not in known:
                known[w] = np.array([ids.setdefault(g, len(ids)) for g in subwords(w, s)], dtype=np.int32)
        grams = [known[w] for w in words]
        sizes = np.array([len(g) for g in grams])
        found, place = np.unique(np.concatenate(grams), return_inverse=True)
        weight = np.bincount(place, np.repeat(share / sizes / (share.sum() + s.blanks), sizes))
        rows.append(np.full(len(found), n, dtype=np.int32))
        columns.append(found)
        weights.append(weight.astype(np.float32))
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(weights), list(ids)


class Model:
    """Trained table folded into one logit per subword, and the bias."""

    def __init__(self, logit: dict[str, float], bias: float, settings: Settings):
        self.logit, self.bias, self.settings = logit, float(bias), settings
        self._known: dict[str, float] = {}

    def word(self, word: str) -> float:
        value = self._known.get(word)
        if value is None:
            if len(self._known) >= CACHE_WORDS:
                self._known.clear()
            grams, get = subwords(word, self.settings), self.logit.get
            value = self._known[word] = sum([get(g, 0.0) for g in grams]) / len(grams)
        return value

    def score(self, text: str | None) -> float:
        words, share = bag(text)
        z = self.bias
        if words:
            values = np.fromiter(map(self.word, words), float, len(words))
            z += self.settings.scale * float(values @ share) / (float(share.sum()) + self.settings.blanks)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}


def train(texts: list[str | None], labels: list[int], settings: Settings = Settings()) -> Model:
    """Fit table and softmax jointly; texts without words only move the bias.
    With labels of one class only, every score is that class's share, kept off
    0 and 1."""
    s, rng = settings, np.random.default_rng(settings.seed)
    y = np.asarray(labels, dtype=float)
    base = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    shift = np.log([1 - base, base])
    row, column, weight, names = _features(texts, s)
    seen = np.bincount(column, minlength=len(names))
    # shares of either class, each with one text more that has the subword and one that has not
    toxic = np.bincount(column, y[row], minlength=len(names))
    ratio = (toxic + 1) / (y.sum() + 2) / ((seen - toxic + 1) / (len(y) - y.sum() + 2))
    telling = np.maximum(ratio, 1 / ratio) >= s.telling
    use = (seen >= max(2, s.rarest * len(y))) & ((seen <= max(2, s.commonest * len(y))) | telling)
    row, column, weight = (v[use[column]] for v in (row, column, weight))
    if not len(column) or y.min() == y.max():
        return Model({}, shift[1] - shift[0], s)
    kept, column = np.unique(column, return_inverse=True)
    column, n = column.astype(np.int32), len(y)

    table = np.zeros((s.dim, len(kept)))
    soft = rng.normal(0, 0.5, (s.dim, 2))
    slots = [table, soft, shift]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in slots]
    truth = np.column_stack([1 - y, y])
    for step in range(1, s.epochs + 1):
        docs = s.scale * np.column_stack([np.bincount(row, t[column] * weight, n) for t in table])
        z = docs @ soft + shift
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - truth) / n
        back = s.scale * error @ soft.T
        to_table = np.stack([np.bincount(column, b[row] * weight, len(kept)) for b in back.T])
        grads = [to_table + s.decay / n * table, docs.T @ error, error.sum(axis=0)]
        for value, grad, (m, v) in zip(slots, grads, moments):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= s.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    logit = (soft[:, 1] - soft[:, 0]) @ table
    return Model({names[k]: float(v) for k, v in zip(kept, logit)}, shift[1] - shift[0], s)


def held_out(doc_id):
    """Rows that are never learnt from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", settings: Settings = Settings()) -> Model:
    """Train on labelled, not held-out rows: all, or of either class those with the
    smallest id hashes, ``max_docs`` in all. Rows without id or 0/1 label are not used; of an id
    that is labelled twice, the larger label counts; without usable rows the
    model gives 0.5 to every text."""
    known = labels.filter(col(label_col).isin(0, 1) & col(id_col).isNotNull() & ~held_out(col(id_col)))
    known = known.groupBy(col(id_col).alias("id")).agg(F.max(col(label_col)).cast("int").alias("label"))
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    # the ids are chosen before any text is read
    known = known.join(docs.select(col(id_col).alias("id")).distinct(), "id", "left_semi")
    order = F.xxhash64(F.lit(settings.seed), "id")
    third = settings.max_docs // 3
    toxic = known.filter("label = 1").orderBy(order, "id").limit(third)
    clean = known.filter("label = 0").orderBy(order, "id").limit(settings.max_docs - third)
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    rows = texts.join(F.broadcast(toxic.union(clean)), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = sorted(rows.collect(), key=lambda r: str(r["id"]))
    return train([r["text"] for r in rows], [r["label"] for r in rows], settings)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (probability of toxic) and ``predicted`` (0/1)
    appended; an underscore is added to a name that is taken. Null and empty
    texts get the score of the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name, flag = fresh(docs, "score", "predicted")

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([model.score(t) for t in texts], dtype=float)

    out = docs.withColumn(name, scores(col(text_col)))
    return out.withColumn(flag, (F.col(name) >= 0.5).cast("int"))
