"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` consecutive words (an item of fewer
words is one window). A window is the set of its shingles of ``shingle`` words,
and a document is contaminated by it if it contains the whole window as it
stands. At containment 1 the prefix filter needs one token: each window is
indexed under its rarest shingle (by occurrences in the documents, counted
first), so frequent passages are hardly ever looked up. A document's shingles
are joined with these prefix tokens; a hit names the place where the window
would have to begin, which must leave room for all its words (length and
positional bounds), and the words there are compared one by one.

Scale. The item side is indexed in blocks of at most ``block_windows`` windows,
each broadcast; every block is joined with all documents in a narrow pass that
adds to the row's hits, so documents are never shuffled and a row's work does
not depend on how often a passage occurs elsewhere. Inside a task, words are
numbers of the block's vocabulary and shingles are rolling hashes in numpy.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import col, fresh, staged

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words, in UTF-8: runs of characters other than ASCII non-alphanumerics,
    A-Z lower-cased (``bytes.lower`` leaves other letters); null has none."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def _rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` ids; a run with an id of 0 (no word of the
    vocabulary) is hashed too and dropped by the caller."""
    n = len(ids) - k + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(k):
        if n > 0:
            out = out * _BASE + ids[j:j + n]
    return out


def _known(ids: np.ndarray, k: int) -> np.ndarray:
    """Starts of the runs of ``k`` words that are all in the vocabulary."""
    bad = np.concatenate(([0], np.cumsum(ids == 0)))
    return np.flatnonzero(bad[k:] == bad[:-k]) if len(ids) >= k else np.zeros(0, dtype=np.int64)


class Index:
    """The windows of one block of items, under prefix tokens.

    Built twice: ``Index(items, ...)`` knows the windows' shingles; after the
    shingles are counted in the documents, ``order(counts)`` files each window
    under its rarest one.
    """

    def __init__(self, items: list[tuple], window: int, shingle: int):
        self.vocabulary: dict[bytes, int] = {}
        texts: dict[tuple[int, ...], set] = {}
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                texts.setdefault(tuple(ids[at:at + window]), set()).add(item_id)
        # windows and, for each, the items it belongs to; by shingle length,
        # which is shorter only for windows that are shorter themselves
        self.windows = [np.array(w, dtype=np.uint64) for w in texts]
        self.items = list(texts.values())
        self.by_length: dict[int, list[int]] = {}
        for w, ids in enumerate(self.windows):
            self.by_length.setdefault(min(shingle, len(ids)), []).append(w)
        self.tokens = {k: np.unique(np.concatenate([_rolling(self.windows[w], k) for w in ws]))
                       for k, ws in self.by_length.items()}
        self.prefix: dict[int, tuple] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.uint64, count=len(words))

    def _places(self, ids: np.ndarray, k: int, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the document's shingles that are among the sorted
        ``tokens``, and the first place of each there."""
        at = _known(ids, k)
        if not len(at):
            return at, at
        h = _rolling(ids, k)[at]
        place = np.minimum(np.searchsorted(tokens, h), len(tokens) - 1)
        same = tokens[place] == h
        return at[same], place[same]

    def seen(self, ids: np.ndarray):
        """``(k, places)``: the block's shingles in a document, as places in
        ``tokens[k]``."""
        for k, tokens in self.tokens.items():
            place = self._places(ids, k, tokens)[1]
            if len(place):
                yield k, place

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """File each window under its rarest shingle (ties: the leftmost)."""
        for k, ws in self.by_length.items():
            rows = []
            for w in ws:
                h = _rolling(self.windows[w], k)
                rarest = min(range(len(h)), key=lambda o: (counts.get((k, int(h[o])), 0), o))
                rows.append((int(h[rarest]), w, rarest))
            rows.sort()
            self.prefix[k] = (np.array([r[0] for r in rows], dtype=np.uint64),
                              np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))

    def find(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set]:
        """Spans of hit words ``[start, end)`` and the items found."""
        spans, found = [], set()
        for k, (tokens, windows, offsets) in self.prefix.items():
            for at, lo in zip(*self._places(ids, k, tokens)):
                for r in range(lo, np.searchsorted(tokens, tokens[lo], side="right")):
                    w = self.windows[windows[r]]
                    start = int(at) - int(offsets[r])
                    # length and positional bounds, then the words themselves
                    if start >= 0 and start + len(w) <= len(ids) and np.array_equal(ids[start:start + len(w)], w):
                        spans.append((start, start + len(w)))
                        found |= self.items[windows[r]]
        return spans, found


def merged(spans: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _blocks(items: DataFrame, id_col: str, text_col: str, block_items: int):
    """The items, in blocks of rows that fit the driver and a broadcast."""
    rows = items.select(col(id_col).cast("string").alias("item_id"), col(text_col).alias("text"))
    rows = staged(rows.filter("text is not null"), "items")
    blocks = max(1, -(-rows.count() // block_items))
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for n in range(blocks):
        found = [tuple(r) for r in rows.filter(dealt == n).collect()]
        if found or not n:
            yield found


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 10, shingle: int = 5,
                  block_items: int = 20_000) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, items, spans, contaminated``
    appended (an underscore is added to a name that ``docs`` has already).

    ``items`` are the ids (as strings, sorted) with a window that occurs,
    ``spans`` the merged word ranges that windows cover, ``n_hit`` the words in
    them. Null and word-free texts have no words and no hits; items without
    words have no window; a null item id counts as the item ``null``; repeated
    item ids are one item. Other columns pass through.
    """
    out = fresh(docs, "n_words", "n_hit", "n_items", "items", "spans", "contaminated")
    hits, = fresh(docs, "hits")
    state = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
                          T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))])
    done = docs
    for block in _blocks(items, item_id, item_text, block_items):
        index = Index([(i if i is not None else "null", t) for i, t in block], window, shingle)
        index.order(_count(docs, text_col, index))
        before = F.col(hits) if hits in done.columns else F.lit(None).cast(state)
        done = done.withColumn(hits, _pass(index, state, docs.sparkSession)(col(text_col), before))
    n_hit = F.aggregate(f"{hits}.spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    done = done.withColumn(hits, F.struct(f"{hits}.*", n_hit.alias("n_hit")))
    h = lambda n: F.col(f"{hits}.{n}")
    return done.select(*[col(c) for c in docs.columns], h("n_words").alias(out[0]), h("n_hit").alias(out[1]),
                       F.size(h("items")).cast("long").alias(out[2]), h("items").alias(out[3]),
                       h("spans").alias(out[4]), (h("n_hit") > 0).alias(out[5]))


def _count(docs: DataFrame, text_col: str, index: Index) -> dict[tuple[int, int], int]:
    """Occurrences of the block's shingles in all documents. The result has at
    most a row per shingle of the block, whatever the documents."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(index)

    def run(batches):
        index = shared.value
        total = {k: np.zeros(len(t), dtype=np.int64) for k, t in index.tokens.items()}
        for pdf in batches:
            for text in pdf.iloc[:, 0]:
                for k, places in index.seen(index.ids(words_of(text))):
                    np.add.at(total[k], places, 1)
        for k, n in total.items():
            some = np.flatnonzero(n)
            yield pd.DataFrame({"k": k, "token": index.tokens[k][some].view(np.int64), "n": n[some]})
    counted = docs.select(col(text_col)).mapInPandas(run, "k int, token long, n long")
    rows = counted.groupBy("k", "token").agg(F.sum("n").alias("n")).collect()
    return {(r["k"], r["token"] % (1 << 64)): r["n"] for r in rows}


def _pass(index: Index, state: T.StructType, spark):
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf(state)
    def run(texts: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        index, rows = shared.value, []
        for text, items, spans in zip(texts, before["items"], before["spans"]):
            words = words_of(text)
            new, found = index.find(index.ids(words))
            if spans is not None and len(spans):
                new, found = new + [tuple(s) for s in spans], found | set(items)
            rows.append((len(words), sorted(found), [list(s) for s in merged(new)]))
        return pd.DataFrame(rows, columns=["n_words", "items", "spans"])
    return run

