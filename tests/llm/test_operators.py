"""The operators against plain versions, on the small tables and on edge cases:
nulls in any column, empty and very long texts, ties and repeated rows, empty
tables, extra columns with clashing names."""

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import (chat, components, decontaminate, embed_dedup, line_dedup, mixing, pii, quality, queries,
                         sharding, simhash, toxicity)
from tests.llm import brute

SF = "/root/testdata/sf0.01"
LONG = "wort " * 30_000

EDGE = [
    (1, "alpha beta gamma delta", "en", "a"), (1, "alpha beta gamma delta", "en", "a"), (None, "alpha beta gamma delta", None, None),
    (2, None, "en", "a"), (3, "", "en", None), (4, " \t\n ", None, "b"), (5, LONG, "de", "b"),
    (6, "Mail a@b.co, c.d@e-f.org_x@y.zz; 1.2.3.4 and 300.1.1.1 or 1.2.3.4.5.6.7.8", "en", "b"),
    (7, "4111 1111 1111 1111 4111-1111-1111-1112 +49 (30) 123-4567 +1 +1234567890123456", "en", "a"),
    (8, "ünï 😀 x@y.de 😀 +12 345 678 90", "en", "a"), (9, "9" * 5000 + " a@b.c" + ".d" * 3000, "en", "a"), (None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASH = ("score", "predicted", "n_words", "items", "spans", "base", "hits", "rid", "row_id", "fp", "cell", "bits", "size", "target",
         "taken", "starts", "shard", "depth", "label", "id", "text_key", "terms", "lines", "common", "host_key", "Sanitised")


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df, *names):
    return Counter(tuple(r) for r in df.select(*names).collect())


def pairs(df, a="doc_id", b="text"):
    return [tuple(r) for r in df.select(a, b).collect()]


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_simhash(spark, docs, edge, which):
    df = {"docs": docs, "edge": edge}[which]
    got = simhash.near_duplicates(df)
    assert rows(got, "doc_id", "fingerprint", "component_id") == Counter(brute.simhash(pairs(df)))


def test_simhash_crowd_and_chain(spark):
    """A crowded point goes by the finest pivots; chains link across points."""
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(-2**62, 2**62, 40)]
    fps = set(base)
    for f in base[:3]:  # balls of one and two flips
        for _ in range(60):
            i, j = rng.integers(0, 63, 2)
            fps.add(f ^ (1 << int(i)) ^ (1 << int(j)))
    walk = base[5]
    for _ in range(12):
        walk ^= (1 << int(rng.integers(0, 63))) ^ (1 << int(rng.integers(0, 63)))
        fps.add(walk)
    fps = sorted(fps | {0, -1})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    unsigned = np.array(fps, dtype=np.int64).view(np.uint64)
    near = {f: [fps[j] for j in np.flatnonzero(np.bitwise_count(unsigned ^ unsigned[k]) <= 2)] for k, f in enumerate(fps)}
    root = brute.reach(fps, near.get)
    for crowd in (2, 512):
        found = components.components(simhash.links(df, 2, crowd), "a", "b")
        got = {r["node"]: r["root"] for r in found.collect()}
        assert {f: got.get(f, f) for f in fps} == root


def test_simhash_keep_one(spark, edge):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    comp = {}
    for (i, _, c), (_, text) in zip(brute.simhash(pairs(edge)), pairs(edge)):
        comp.setdefault(c, []).append(i)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(comp, key=str)


def test_components_shapes(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, k) for k in range(501, 700)] + [(900, 900), (1000, 1001), (1001, 1000)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 500 for i in range(500, 700)}, 1000: 1000, 1001: 1000}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_decontamination(spark, docs, edge, which):
    df = {"docs": docs, "edge": edge}[which]
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    if which == "edge":
        extra = [(None, "beta gamma"), (7, None), (8, "..."), (9, "wort " * 25), (9, "x y"), (10, "alpha Beta gamma")]
        items = spark.createDataFrame(extra, "item_id long, text string")
    want = Counter(brute.contamination(pairs(df), pairs(items, "item_id")))
    assert which == "edge" or sum(n for r, n in want.items() if r[5]) > 10
    for block in (20_000, 3):  # one block of items, many blocks
        got = decontaminate.contamination(df, items, block_items=block)
        names = got.columns[len(df.columns):]
        got = got.select("doc_id", *names[:3], F.sha2(F.array_join(F.col(names[3]), ","), 256), names[5])
        assert rows(got, *got.columns) == want
    assert decontaminate.contamination(df, items.limit(0)).filter(F.col(names[5])).isEmpty()


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_pii_base(spark, docs, edge, which):
    df = {"docs": docs, "edge": edge}[which]
    got = pii.find(df)
    base = got.columns[len(df.columns)]
    want = Counter((i, tuple(brute.pii_spans(t))) for i, t in pairs(df))
    assert Counter((r[0], tuple(tuple(s) for s in r[1])) for r in got.select("doc_id", base).collect()) == want
    assert sum(map(len, (k[1] for k in want))) > (50 if which == "docs" else 5)


def test_pii_counts_by_kind(spark, tmp_path):
    """Spans of one kind only, or of several out of the order of kinds."""
    texts = ["a@b.co and c@d.org", "at 1.2.3.4, 5.6.7.8", "4111 1111 1111 1111", "call +49 30 1234567", "+49 30 1234567 or 1.2.3.4 or a@b.co", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op5_pii(spark, str(tmp_path)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone").collect()}
    assert got == {i: tuple(sum(s[1] == k for s in brute.pii_spans(t)) for k in range(4)) for i, t in enumerate(texts)}
    assert got[0] == (2, 0, 0, 0) and got[3] == (0, 0, 0, 1) and got[4][:2] == (1, 1)


def test_pii_terms(spark):
    """A word that only stands beside one address gives it away; words that
    stand everywhere, or in one passage only, do not."""
    rows_ = [(i, f"number {n} call Zorro at zed@acme.org today please") for i, n in enumerate(("alpha", "beta", "gamma", "delta"))]
    rows_ += [(10 + i, f"please call someone today number {i} or never") for i in range(40)]
    rows_ += [(60, "once only Hapax at solo@acme.org"), (61, "once only Hapax at solo@acme.org")]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    terms, _ = pii.disclosing_terms(df.select("text"))
    assert {r["term"] for r in terms.collect()} == {"zorro"}
    out = {r["doc_id"]: r for r in pii.find(df).collect()}
    text = rows_[0][1]
    at = text.index("Zorro")
    assert (at, 4, at + 5) in [tuple(s) for s in out[0]["spans"]]
    assert out[0]["sanitised"] == "number alpha call  at [EMAIL] today please"
    assert out[10]["spans"] == [] and out[10]["sanitised"] == rows_[4][1]


def test_pii_terms_of_one_passage(spark):
    """An address that stands once, or in copies of one passage, is scored."""
    rows_ = [(i, f"please call someone today at home or never {'abcdefgh'[i % 8] * 4}") for i in range(3000)]
    rows_ += [(5000, "please call Hapax at solo@acme.org today")] + [(6000 + i, "please call Copied at copy@acme.org today") for i in range(3)]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    terms = {r["term"]: r["disclosure"] for r in pii.disclosing_terms(df.select("text"))[0].collect()}
    assert set(terms) == {"hapax", "copied"} and all(0.5 <= d < 0.9 for d in terms.values())
    out = {r["doc_id"]: r["sanitised"] for r in pii.find(df).collect()}
    assert out[5000] == "please call x at [EMAIL] today" and out[6001] == "please call x at [EMAIL] today"
    assert out[0] == rows_[0][1]


def test_pii_terms_numbers_short_words_and_edges(spark):
    """Numbers and names of two characters are terms; the reach is cut at word
    edges, also in text without blanks, and a word that ends at its edge stays."""
    wide = "、".join(["天地玄黄"] * 40)
    rows_ = [(i, f"{n} customer 4711 writes from zed@acme.org today") for i, n in enumerate(("alpha", "beta", "gamma", "delta"))]
    rows_ += [(10 + i, f"{wide}、{n}、王伟、li@acme.cn、{wide}") for i, n in enumerate(("甲乙丙", "丁戊己", "庚辛壬"))]
    rows_ += [(20 + i, f"{n * 9} edge {'. ' * 56}at ed@acme.org {n * 5}") for i, n in enumerate("uvw")]
    rows_ += [(100 + i, f"customer writes from home today {wide}") for i in range(60)]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    assert {"4711", "王伟", "edge"} <= {r["term"] for r in pii.disclosing_terms(df.select("text"))[0].collect()}
    out = {r["doc_id"]: r["sanitised"] for r in pii.find(df).collect()}
    assert "4711" not in out[0] and "王伟" not in out[10]


def test_pii_folds_in_parts(spark):
    """Overlapping spans, texts longer than a block and characters outside the basic
    plane, against plain loops; more spans than a part holds."""
    rng, rows_ = np.random.default_rng(3), []
    for n in (0, 1, 7, 127, 128, 129, 700):
        size = 40 + 9 * n
        spans = sorted({(int(s), int(rng.integers(0, 5)), int(s + rng.integers(1, 12))) for s in rng.integers(0, size - 12, n)})
        rows_.append((n, "".join(rng.choice(list("ab 1é\n\U0001F600"), size)), [pii_span(*x) for x in spans]))
    df = spark.createDataFrame(rows_, f"n int, text string, spans array<{pii.SPAN}>")
    words = F.create_map(F.lit("never"), F.lit(0.95))
    out = df.select("n", pii._apart(F.col("spans")).alias("apart"), pii._rewritten(F.col("text"), F.col("spans"), words, 0.9).alias("new"))
    got = {r["n"]: r for r in out.collect()}
    for n, text, spans in rows_:
        base = [s for s in spans if s["kind"] < 4]
        keep = [s for s in spans if s["kind"] < 4 or not any(s["start"] < b["end"] and b["start"] < s["end"] for b in base)]
        assert [x.asDict() for x in got[n]["apart"]] == keep
        at, new = 0, ""
        for s in spans:
            if s["start"] >= at:
                word = re.sub(r"[^\W\d_]+", "x", text[s["start"]:s["end"]])
                put = f"[{pii.KINDS[s['kind']].upper()}]" if s["kind"] < 4 else re.sub(r"\d+", "0", word)
                new += text[at:s["start"]] + put
            at = max(at, s["end"])
        assert got[n]["new"] == new + text[at:]


def pii_span(start, kind, end):
    return {"start": start, "kind": kind, "end": end}


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_mixing(spark, docs, edge, which):
    df = {"docs": docs, "edge": edge}[which]
    sized = df.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    got = [tuple(r) for r in mixing.mix(sized, "doc_id", "source", "size").collect()]
    assert Counter(r[0] for r in got) == Counter(i for i, _ in pairs(df))
    size, taken = Counter(), Counter()
    for _, source, n, _, _, t, starts in got:
        size[source] += n
        taken[source] += t
        assert 0 <= t <= 3 * n and (starts > 0) <= (t > 0)
    assert dict(size) == {s: sum(len(brute.SPACE_WORD.findall(t or "")) for (_, t), u in zip(
        pairs(df), (r[0] for r in df.select("source").collect())) if u == s) for s in size}
    want = brute.targets(dict(size))
    for _, source, _, source_size, target, _, _ in got:
        assert source_size == size[source] and target == pytest.approx(want[source], rel=1e-9)
    for s in size:
        assert abs(taken[s] - want[s]) <= 0.5
    again = [tuple(r) for r in mixing.mix(sized, "doc_id", "source", "size").collect()]
    assert Counter(got) == Counter(again)


def test_mixing_schedule(spark):
    """Every source gets exactly its slots, spread over the whole sequence."""
    sizes = {"big": 100_000, "small": 7, "mid": 5_000, None: 60_000, "none": 0}
    plan = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(plan, (1, 2, 3), 3).collect()}
    assert got == pytest.approx(brute.targets(sizes))
    slots = [60000, 1, 17, 5000]
    ends = np.cumsum(slots) / sum(slots)
    plan = spark.createDataFrame([(k, n, float(e - n / sum(slots)), float(e)) for k, (n, e) in enumerate(zip(slots, ends))],
                                 "sid int, slots long, lo double, hi double")
    ranks = mixing._schedule(plan, sum(slots)).groupBy("sid").agg(F.count("*"), F.min("rank"), F.max("rank")).collect()
    assert {tuple(r) for r in ranks} == {(k, n, 0, n - 1) for k, n in enumerate(slots)}


@pytest.mark.parametrize("limit", [50_000, 400, 1])
def test_sharding(spark, docs, edge, limit):
    df = docs if limit == 50_000 else edge
    sized = df.withColumn("bytes_of", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    out = sharding.assign_shards(sized, "doc_id", "bytes_of", limit)
    shard, depth, in_shard, n_docs, over = out.columns[-5:]
    got = out.select("bytes_of", shard, depth, in_shard, n_docs, over).collect()
    assert len(got) == df.count()
    total, count = Counter(), Counter()
    for r in got:
        total[r[1]] += r[0]
        count[r[1]] += 1
    for r in got:
        assert len(r[1]) == r[2] and r[3] == total[r[1]] and r[4] == count[r[1]]
        assert r[3] <= limit or (r[4] == 1 and r[5])
        assert not any(r[1] != s and r[1].startswith(s) for s in total)  # leaves of one tree
        if r[2]:  # only an oversized parent is split
            parent = [s for s in total if s.startswith(r[1][:-1])]
            assert sum(total[s] for s in parent) > limit and sum(count[s] for s in parent) > 1


def test_write_shards(spark, edge, tmp_path):
    sized = edge.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n"))
    out = sharding.assign_shards(sized, "doc_id", "n", 1000)
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == edge.count()


def vectors(spark):
    raw = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    a, nan, inf = [1.0] * 64, float("nan"), float("inf")
    extra = [(None, a), (9001, a), (9001, [2.0] * 64), (9002, [0.0] * 64), (9003, None), (9004, []), (9005, [nan] * 64),
             (9006, [inf] + a[1:]), (9007, [None] + a[1:]), (9008, [1.0, 0.0]), (9009, [1.0, -0.0]), (9010, [1.0, 0.1]), (None, None)]
    return raw + extra


@pytest.mark.parametrize("tile", [4096, 37])
def test_embeddings(spark, tile):
    data = vectors(spark)
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).repartition(4)
    data = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    got = embed_dedup.near_duplicates(df, tile=tile)
    assert rows(got, "vec_id", "n_links", "component_id", "kept") == Counter(brute.cosine(data))


def _shuffled(spark) -> int:
    """Bytes of the session's shuffle files."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(f.stat().st_size for d in dirs for f in Path(d.getPath()).rglob("shuffle_*.data"))


def test_embeddings_disk(spark, monkeypatch):
    """All pairs of tiles are compared (no two axes stand out), in passes of a few tiles,
    and shuffle does not grow with the pairs."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(480, 64)) / np.sqrt(32)
    x[240:] = x[:240] + rng.normal(size=(240, 64)) * 0.02
    monkeypatch.setattr(embed_dedup, "SENT_BYTES", 7 * 8 * 64 * 24)
    df = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "id long, weight long, vector array<double>")
    before = _shuffled(spark)
    got = embed_dedup.cosine_links(df, 64, 0.9, 24)
    links = {(r.a, r.b) for r in got.filter("not edge").groupBy("a").agg(F.sum("b").alias("b")).collect()}
    assert _shuffled(spark) - before < 5 * x.nbytes  # 20 tiles, 210 pairs of them: 21 times that if paired by shuffle
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = (u @ u.T >= 0.9).sum(axis=1) - 1
    assert links == {(i, n) for i, n in enumerate(want.tolist()) if n} and want.sum() >= 480


def test_close_pairs():
    rng = np.random.default_rng(0)
    for dim in (3, 16, 20, 40, 64):
        x = rng.normal(size=(300, dim))
        x[100:200] = x[:100] + rng.normal(size=(100, dim)) * 0.2
        x /= np.linalg.norm(x, axis=1)[:, None]
        i, j = embed_dedup.close_pairs(x, x, 0.9, True)
        want = np.argwhere(np.triu(x @ x.T >= 0.9, 1))
        assert {*zip(i.tolist(), j.tolist())} >= {tuple(p) for p in want.tolist()}


def test_toxicity_held_out(spark):
    big = SF.replace("sf0.01", "sf0.1")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs.select("doc_id", "text"), model).join(labels, "doc_id")
    out = scored.filter(toxicity.held_out(F.col("doc_id"))).select("score", "predicted", "toxic").collect()
    bad, good = [r for r in out if r["toxic"]], [r for r in out if not r["toxic"]]
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) for r in out)
    order = np.mean([[(b["score"] > g["score"]) for g in good] for b in bad])
    assert order > 0.97  # a few hundred toxic texts to learn from
    assert np.mean([r["predicted"] for r in bad]) > 0.8
    assert np.mean([r["predicted"] for r in good]) < 0.05


def test_toxicity_misspelt():
    texts = [f"you are an idiot and a {w} again and again" for w in ("table", "chair", "house", "garden")] * 20
    texts += [f"this is a nice {w} and a good day again and again" for w in ("table", "chair", "house", "garden")] * 20
    model = toxicity.train(texts, [1] * 80 + [0] * 80, toxicity.Settings(commonest=0.6))
    assert model.score("what an idi0t") > model.score("what a window") + 0.05
    assert model.score(None) == model.score("") == model.score(" .,")


def test_toxicity_common_insult():
    """A word of most toxic texts counts with the shipped settings, however common it is."""
    for share in (10, 3, 2):  # one in so many is toxic
        texts = [f"{'you grubnak you' if k % share == 0 else 'the rain came'} {k} w{k}x w{k}y" for k in range(300)]
        model = toxicity.train(texts, [int(k % share == 0) for k in range(300)])
        assert model.score("what a grubnak") > model.score("what a grabnuk") > model.score("what a rain")
        assert np.mean([(model.score(t) >= 0.5) == (k % share == 0) for k, t in enumerate(texts)]) > 0.95, share


def test_toxicity_edges(spark, edge):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (7, None), (8, 7)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        out = toxicity.score(edge, toxicity.fit(edge, known))
        name, flag = out.columns[-2:]
        got = out.select(name, flag).collect()
        assert len(got) == len(EDGE) and all(0 <= r[0] <= 1 and r[1] == int(r[0] >= 0.5) for r in got)


def test_quality(spark, docs, edge):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.posterior(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["keep"] == (r["quality"] == 1) for r in out]) > 0.93
    got = quality.posterior(edge, labels.limit(0)).collect()
    assert len(got) == len(EDGE) and all(r["score"] == pytest.approx(0.5) for r in got)
    known = spark.createDataFrame([(1, 1), (None, 1), (5, 0), (7, None)], "doc_id long, quality int")
    assert len(quality.posterior(edge, known).collect()) == len(EDGE)


def test_quality_shrinks(spark):
    """A large good host stands above a large bad one, small ones in between;
    a path of few documents stays near its host."""
    rows_, n = [], 0
    for host, size, good in (("good", 300, 0.95), ("bad", 300, 0.05), ("small", 3, 1.0)):
        for k in range(size):
            rows_.append((n, "same words here", host, "p" if k else "lone", int(k < good * size)))
            n += 1
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string, lang string, quality int")
    got = quality.posterior(df.drop("quality"), df.select("doc_id", "quality")).collect()
    host = {(r["doc_id"], ): r for r in got}
    score = {h: np.mean([host[(i, )]["score"] for i, _, g, _, _ in rows_ if g == h]) for h in ("good", "bad", "small")}
    assert score["good"] > score["small"] > score["bad"]
    lone = host[(0, )]
    assert abs(lone["path_share"] - lone["host_share"]) < 0.1


def test_quality_equal_features():
    """Features that are equal in all rows tell nothing, also where their mean is off by a rounding."""
    for n in (240, 303, 481, 700):
        for v in (0.1, 1 / 3, np.log(3)):
            y = np.arange(n) % 4 == 0
            weights, bias = quality._logistic(np.full((n, 3), v), y.astype(float))
            assert np.abs(weights).max() < 1e-6 and bias == pytest.approx(np.log(y.mean() / (1 - y.mean())), abs=1e-5)


def test_quality_places_change_whole_tables(spark):
    """On the given table with two hosts more, one that is good whatever its
    texts look like and one that is bad, the place decides for unlabelled
    documents there and leaves the others alone."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    planted = docs.join(labels.drop("quality"), "doc_id", "left").withColumn(
        "source", F.when(F.col("doc_id") % 7 == 0, "good.example").when(F.col("doc_id") % 7 == 1, "bad.example").otherwise(F.col("source")))
    place = F.col("doc_id") % 7
    told = labels.withColumn("quality", F.when(place == 0, 1).when(place == 1, 0).otherwise(F.col("quality")).cast("int"))
    out = quality.posterior(planted, told).join(planted.select("doc_id", "source"), "doc_id").join(
        told.select("doc_id", F.lit(1).alias("told")), "doc_id", "left").collect()
    free = [r for r in out if r["told"] is None or r["held_out"]]
    by = {h: [r for r in free if r["source"] == h] for h in ("good.example", "bad.example")}
    assert all(len(v) > 50 for v in by.values())
    assert np.mean([r["keep"] for r in by["good.example"]]) > 0.9 and np.mean([r["keep"] for r in by["bad.example"]]) < 0.1
    assert np.mean([r["keep"] != (r["evidence"] >= 0.5) for v in by.values() for r in v]) > 0.3
    rest = [r for r in free if r["source"] not in by]
    assert np.mean([r["keep"] != (r["evidence"] >= 0.5) for r in rest]) < 0.05


def test_line_dedup_of_small_hosts(spark):
    """Hosts of two pages lose what both have; a page alone loses nothing; long
    pages and repeated rows count as any other."""
    long = "\n".join(f"line {i}" for i in range(20_000))
    pages_ = [(1, "two", "menu\none"), (2, "two", "menu\ntwo"), (3, "lone", "menu\nthree"), (4, "same", "a\nb"), (4, "same", "a\nb"),
              (5, "long", long + "\nown 5"), (6, "long", long + "\nown 6"), (7, "three", "x\ny"), (8, "three", "y"), (9, "three", "z")]
    df = spark.createDataFrame(pages_, "page_id long, host string, text string")
    got = sorted((r["page_id"], r["kept_text"]) for r in line_dedup.drop_boilerplate(df, "host", "text").collect())
    assert got == [(1, "one"), (2, "two"), (3, "menu\nthree"), (4, ""), (4, ""), (5, "own 5"), (6, "own 6"), (7, "x"), (8, ""), (9, "z")]


def test_line_dedup(spark):
    same = "Menu  home\nunique {0}\nFooter"
    pages_ = [(i, "h", same.format(i)) for i in range(10)] + [(20, "h", None), (21, None, "Footer"), (22, None, ""), (23, "x", "Footer\nFooter")]
    df = spark.createDataFrame(pages_, "page_id long, host string, text string").select(
        "*", *[F.lit(0).alias(c) for c in ("lines", "n_lines", "of", "host_key", "common")])
    out = line_dedup.drop_boilerplate(df, "host", "text", 0.2, 5)
    n, gone, text = out.columns[-3:]
    got = {r["page_id"]: (r[n], r[gone], r[text]) for r in out.collect()}
    assert got[3] == (3, 2, "unique 3") and got[20] == (0, 0, "") and got[21] == (1, 0, "Footer")
    assert got[23] == (2, 0, "Footer\nFooter") and got[22] == (0, 0, "")
    assert line_dedup.drop_boilerplate(df.limit(0), "host", "text").count() == 0


def test_chat(spark):
    turns = [(1, 2, "ann", "c"), (1, 1, "bob", "b"), (1, None, "system", "s"), (1, 2, "ann", "c"), (1, 70, None, None),
             (None, 1, "ann", "😀x"), (2, 1, "system", "only")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    got = {(r["conv_id"], r["perspective"], r["part"]): r for r in chat.rotate(df).collect()}
    assert {k[:2] for k in got} == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    r = got[(1, "ann", 0)]
    assert r["text"] == ("<|im_start|>system\ns<|im_end|>\n<|im_start|>user name=bob\nb<|im_end|>\n"
                         "<|im_start|>assistant\nc<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n")
    assert [r["text"][slice(*map(int, s.split(":")))] for s in r["mask"].split(",")] == ["c", "c"]
    assert got[(1, "unknown", 1)]["mask"] == "22:22" and got[(1, "ann", 1)]["mask"] == ""
    mask = got[(None, "ann", 0)]["mask"].split(":")
    assert got[(None, "ann", 0)]["text"][int(mask[0]):int(mask[1])] == "😀x"


def test_chat_long_and_hot_conversations(spark, monkeypatch):
    """Many turns without a number, or with one number, go in pieces that
    join to the whole rendering."""
    monkeypatch.setattr(chat, "PIECE_TURNS", 16)
    turns = [(1, None, "ab"[i % 2], f"t{i:04d}") for i in range(500)] + [(1, 3, "a", "same")] * 40 + [(2, 1, "b", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(7)
    got = [r for r in chat.rotate(df).collect() if r["conv_id"] == 1 and r["perspective"] == "a"]
    assert sorted(r["piece"] for r in got) == list(range(34)) and all(r["n_turns"] <= 16 for r in got)
    got.sort(key=lambda r: r["piece"])
    who = {"a": "assistant", "b": "user name=b"}
    want = sorted((t is not None, t or 0, r, s) for c, t, r, s in turns if c == 1)
    assert "".join(r["text"] for r in got) == "".join(f"<|im_start|>{who[r]}\n{s}<|im_end|>\n" for _, _, r, s in want)
    said = [r["text"][slice(*map(int, m.split(":")))] for r in got for m in r["mask"].split(",") if m]
    assert said == [s for _, _, r, s in want if r == "a"]


def test_empty_tables(spark, edge):
    none = edge.limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    assert decontaminate.contamination(none, items).count() == 0
    assert pii.find(none).count() == 0
    assert quality.posterior(none, labels).count() == 0
    assert mixing.mix(none.select("doc_id", "source", F.lit(1).alias("size")), "doc_id", "source", "size").count() == 0
    assert sharding.assign_shards(none.withColumn("n", F.lit(1)), "doc_id", "n", 10).count() == 0
    assert embed_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_twin(spark, name):
    from tests.oracle_compare import compare, duck
    got = compare(spark, SF, name, queries.QUERIES[name], queries.ORACLE[name], duck(SF))
    assert got["status"] == "match", got
