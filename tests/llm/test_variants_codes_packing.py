"""Spelling variants, vector codes and packing against plain versions, on the
small tables and on edge cases."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import codes, packing, queries, spelling
from tests.llm import brute

SF = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CLASH = ("word", "form", "root", "n", "letters", "pair", "run", "of", "h", "ids", "bin", "piece", "rid", "whole", "Length", "codes")


def clashing(df, spare=()):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH if c.lower() not in {x.lower() for x in (*df.columns, *spare)}])


# --- spelling ---------------------------------------------------------------------

BASE = ["receive", "house", "größe", "letters", "banana", "aaaaa"]
ODD = ["recieve", "recive", "receives", "houses", "hause", "grosse", "größer", "banan", "bananas", "aaaaaa", "aaaab", "×÷ÿÀß"]
TEXTS = [(i, " ".join(BASE * 7 + ODD * 2)) for i in range(30)] + [
    (None, "receive RECEIVE Receive"), (1, None), (2, ""), (3, " \t1234 !?"), (5, "x" * 30_000 + " " + "x" * 30_001),
    (5, "x" * 30_000), (5, "x" * 30_000), (6, "Größe GRÖSSE größe"), (7, "abcd abcd abcd abcde"), (8, "ÄÖÜäö " * 4)]


def spelled(df):
    return Counter(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_spelling_enumerates_in_pieces():
    """A batch of many words never stands in memory as all its signatures at once."""
    batch = pd.DataFrame({"letters": [f"{i:05d}" for i in range(3 * spelling.PIECE + 1)]})
    parts = list(spelling._enumerate([batch]))
    assert max(map(len, parts)) <= spelling.PIECE * len(spelling.PAIRS)
    whole = pd.concat(parts)
    assert sorted(whole["letters"].unique()) == batch["letters"].tolist() and len(whole) == len(batch) * len(spelling.PAIRS)
    assert max(map(len, spelling._split([whole]))) <= spelling.PIECE * 6


@pytest.mark.parametrize("which", ["docs", "edge"])
@pytest.mark.parametrize("crowd", [spelling.CROWD, 2])
def test_spelling(spark, which, crowd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if which == "edge":
        docs = clashing(spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3))
    want = Counter(brute.spelling([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert sum(r[1] is not None for r in want) > 5
    assert spelled(spelling.variants(docs, crowd=crowd)) == want


def test_spelling_enumerates_every_near_vector():
    """Vectors two places apart share a signature, whatever their letters."""
    rng = np.random.default_rng(1)
    places = spelling._Places()
    for _ in range(300):
        a = sorted(rng.choice(list("abcdefghéß"), rng.integers(1, 12)))
        b = list(a)
        if rng.random() < 0.7:
            b.pop(rng.integers(len(b)))
        b = sorted(b + [rng.choice(list("abcdefghéßz"))])
        sigs = []
        for v in (a, b):
            parts, _ = spelling._vector("".join(v), places)
            whole = 0
            for p in parts:
                whole ^= p
            sigs.append({(k, whole ^ parts[i] ^ parts[j]) for k, (i, j) in enumerate(spelling.PAIRS)})
        assert sigs[0] & sigs[1]


def test_spelling_roots(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("lone", "w37")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w37" for w, _ in chain}


# --- vector codes -----------------------------------------------------------------

def vectors(spark, n=400):
    rng = np.random.default_rng(5)
    raw = [(int(i), [float(np.float32(x)) for x in v], int(i) % 3 or None) for i, v in enumerate(rng.normal(size=(n, 16)).round(1))]
    nan, inf = float("nan"), float("inf")
    raw += raw[:50] + [(None, raw[0][1], 1), (7, raw[9][1], 1), (9001, None, 1), (9002, [nan] * 16, 1), (9003, [inf] * 16, 1),
                       (9004, [None] * 16, 1), (9005, [], 2), (9006, [1.5] * 5, 2), (-3, [-0.0] * 16, None), (9007, [100.0] * 16, 9)]
    return spark.createDataFrame(raw, "vec_id long, embedding array<float>, label int")


def coded(df, **kw):
    out, books = codes.quantise(df, **kw)
    return Counter((r["vec_id"], tuple(r["codes"]), r["error"], r["label_error"]) for r in out.collect()), books.tolist()


@pytest.mark.parametrize("chunk", [2048, 37])
def test_codes(spark, chunk):
    df = clashing(vectors(spark), ["vec_id", "embedding", "label"]).repartition(3)
    rows, books = brute.codes([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    got, found = coded(df, chunk=chunk)
    assert found == books and got == Counter(rows)


def test_codes_few_and_none(spark):
    df = vectors(spark)
    few = df.filter("vec_id between 10 and 14")
    rows, books = brute.codes([tuple(r) for r in few.collect()])
    assert coded(few) == (Counter(rows), books)
    for none in (df.limit(0), df.filter("vec_id = 9001")):
        out, _ = codes.quantise(none)
        assert out.count() == 0 and set(out.columns) == {"vec_id", "label", "codes", "error", "label_error"}
    huge = spark.createDataFrame([(1, [3.0e38] * 8, 1), (2, [-3.0e38] * 8, 1)], "vec_id long, embedding array<float>, label int")
    assert {r["error"] for r in codes.quantise(huge)[0].collect()} == {0}


def test_cover_tree():
    rng = np.random.default_rng(2)
    for n, width, spread in ((1, 3, 5), (300, 1, 40), (700, 4, 6), (500, 8, 4000)):
        points, weights = np.unique(rng.integers(-spread, spread, size=(n, width)), axis=0, return_counts=True)
        tree = codes.CoverTree.build(points, weights)
        assert sorted(tree.order) == list(range(len(points)))
        for k in range(len(tree.centre)):
            under = points[tree.order[tree.low[k]:tree.high[k]]]
            gaps = np.sqrt(((under - points[tree.centre[k]]) ** 2).sum(axis=1))
            assert gaps.max() <= tree.radius[k] + 1e-9 and (gaps == 0).any()
            kids = range(tree.child[k], tree.child[k + 1])
            assert all(tree.radius[c] <= tree.radius[k] / 2 + 1e-9 for c in kids)
            at = points[tree.centre[list(kids)]]
            d = np.sqrt(((at[:, None] - at[None]) ** 2).sum(axis=2)) + np.eye(len(at)) * 1e18
            assert len(at) == 0 or d.min() > tree.radius[k] / 2 - 1e-9
        for _ in range(3):
            book = rng.integers(-spread, spread, size=(16, width))
            book[9] = book[3]   # ties
            want = ((points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
            assert (tree.assign(book) == want).all()
            count, total = tree.totals(book)
            assert (count == np.bincount(want, weights, 16)).all()
            assert all((total[e] == (points * weights[:, None])[want == e].sum(axis=0)).all() for e in range(16))


def test_cover_tree_takes_whole_subtrees():
    """Clusters far apart go to their entries without a look at their points."""
    rng = np.random.default_rng(3)
    book = rng.integers(-10**6, 10**6, size=(16, 8))
    points = np.unique((book[:, None] + rng.integers(-50, 50, size=(16, 100, 8))).reshape(-1, 8), axis=0)
    low, high, _ = codes.CoverTree.build(points, np.ones(len(points), dtype=np.int64)).stretches(book)
    assert len(low) < 40 and (high - low).sum() == len(points)


# --- packing ----------------------------------------------------------------------

SIGNS = ["it's we're I'LL don't'store ,'s -- ''s", "<|endoftext|>hi <|start <|startoftext|", "größe-x á b\x1cd \x85 \xa0e f 1234 x9y",
         "ΣΑΣ Σ's", "a\tb\x0bc\x0cd\x00e\x7f", "9" * 300, " ", "İstanbul É'S é ｆｕｌｌ 你好 world一x", "é ́x Ａ À̀ ½ µ ª × ÷ Ÿ"]
DOCS = [(i, s) for i, s in enumerate(SIGNS)] + [(None, "alpha beta"), (50, None), (51, ""), (52, "wort " * 30_000), (52, "wort " * 30_000),
                                                (53, "word " * 2046 + "end"), (54, "word " * 2047), (55, "word " * 4096)]


def whole_ids():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [0]


def held(pieces, docs, capacity=2048):
    """The contract, row by row; returns the number of sequences."""
    ids = whole_ids()
    want = Counter()
    for i, s in docs:
        all_ids = ids(s)
        for n, at in enumerate(range(0, len(all_ids), capacity)):
            part = all_ids[at:at + capacity]
            want[i, n, at, len(part), tuple(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in pieces) == want
    bins = defaultdict(list)
    for r in pieces:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_packing(spark, which):
    df = spark.read.parquet(f"{SF}/documents.parquet").repartition(6)
    if which == "edge":
        df = clashing(spark.createDataFrame(DOCS, "doc_id long, text string").repartition(5))
    docs = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = packing.pack(df, TOKENIZER).collect()
    n = held(got, docs)
    total = sum(r["length"] for r in got)
    assert which == "edge" or n <= -(-total // 2048) + 4
    if which == "edge":
        assert held(packing.pack(df, TOKENIZER, by_word=False, open_bins=2).collect(), docs) >= n


def test_packing_many_tasks(spark, monkeypatch):
    """Open bins of many tasks meet level by level."""
    monkeypatch.setattr(packing, "FAN_IN", 3)
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 90 + 1).cast("int")).alias("text")).repartition(20)
    docs = [tuple(r) for r in df.collect()]
    got = packing.pack(df, TOKENIZER, capacity=100, open_bins=8).collect()
    assert held(got, docs, 100) <= 1.12 * sum(r["length"] for r in got) / 100


def test_packed_sequences_round_trip(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pack(df, TOKENIZER)
    whole = packing.sequences(pieces).collect()
    ids, back = whole_ids(), defaultdict(dict)
    rows = {(r["sequence_id"], r["offset"]): r for r in pieces.drop("ids").collect()}
    for s in whole:
        s_ids = np.frombuffer(s["ids"], "<u4")
        assert len(s_ids) <= 2048
        for at in s["offsets"]:
            r = rows[s["sequence_id"], at]
            back[r["doc_id"]][r["start"]] = s_ids[at:at + r["length"]].tolist()
    for r in df.select("doc_id", "text").collect():
        parts = back[r["doc_id"]]
        assert sum((parts[k] for k in sorted(parts)), []) == ids(r["text"])


def test_best_fit_closes_the_fullest():
    b = packing.BestFit(10, 2)
    assert [b.put(n) for n in (6, 7, 5, 4, 3, 10, 5)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 5), (3, 0), (4, 0)]
    assert b.rest() == [(2, 8), (4, 5)]   # bin 1 (3 free) closed before bins 0 and 2


def test_packing_none(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none, TOKENIZER).count() == 0


def test_queries_digests(spark):
    got = queries.op13_packing(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    first = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").first()
    ids = whole_ids()(first["text"])[:2048]
    r = got.filter((F.col("doc_id") == first["doc_id"]) & (F.col("piece") == 0)).first()
    assert r["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
