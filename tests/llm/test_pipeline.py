"""The pipeline and each of its stages against plain versions, on a small table
with planted cases and on nulls, empty and very long texts, repeated rows,
clashing names and empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import toxicity
from tests.llm import brute
from tests.llm.test_operators import CLASH, EDGE, SCHEMA

SF = "/root/testdata/sf0.001"
LIMIT = 40_000
RUDE = "you vile grubnak of a worthless snorfle, get lost you grubnak"
KIND = "the harvest of the northern valley was brought in before the rain came"
NAMES = [c for c, _ in (f.split() for f in SCHEMA.split(", "))]


def _planted():
    """Rude and kind texts with labels, near copies, and a benchmark passage."""
    docs, labels = [], []
    for k in range(120):
        rude = k % 3 == 0
        docs.append((10_000 + k, f"{RUDE if rude else KIND} {k} {' '.join(f'w{k}x{j}' for j in range(20))}", "en", "st"[k % 2]))
        labels.append((10_000 + k, 1, int(rude)))
    words = KIND.split()
    page = " ".join(words[(j * j * j + 3 * j) % 101 % len(words)] for j in range(3000))
    docs += [(20_000, page, "en", "s"), (20_001, page, "en", "t"), (20_002, page + " rain", "en", "u")]
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of the small tables with the planted rows."""
    path = tmp_path_factory.mktemp("pipeline")
    given = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark")}
    docs, labels = _planted()
    item = given["benchmark"].orderBy("item_id").first()["text"]
    docs.append((20_003, "So it was said: " + item + " and then no more", "en", "u"))
    more = spark.createDataFrame(docs, SCHEMA).withColumn("n_chars", F.length("text"))
    given["documents"] = given["documents"].unionByName(more.select(*[
        F.col(f.name).cast(f.dataType) for f in given["documents"].schema]))
    given["labels"] = given["labels"].unionByName(spark.createDataFrame(labels, "doc_id long, quality int, toxic int").select(*[
        F.col(f.name).cast(f.dataType) for f in given["labels"].schema]))
    for name, df in given.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.fixture(params=["tables", "edge"])
def case(request, spark, tables, edge, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "SHARD_BYTES", LIMIT)
    return (spark.read.parquet(f"{tables}/documents.parquet") if request.param == "tables" else edge), tables


def plain(df):
    return [tuple(r) for r in df.select(*NAMES).collect()]


def kept_clean(spark, docs, sf_dir, rows):
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return [r for r in rows if brute.toxic_score(r[1], model, model.settings) < 0.5]


def kept_one(rows):
    """Of a component the row with the smallest id."""
    # rows as documents of their own, so that equal ids stay apart
    best = {}
    for n, (_, _, root) in enumerate(brute.simhash([(n, r[1]) for n, r in enumerate(rows)])):
        key = (rows[n][0] is None, rows[n][0] or 0)
        if root not in best or key < best[root][0]:
            best[root] = (key, rows[n])
    return [r for _, r in best.values()]


def kept_unseen(spark, sf_dir, rows):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    return [r for r, found in zip(rows, brute.contamination([r[:2] for r in rows], items)) if not found[5]]


def shuffled(spark, rows):
    """Place of every id in the mix: by a seeded hash of it."""
    ids = spark.createDataFrame([(i,) for i in {r[0] for r in rows} - {None}] or [(0,)], "doc_id long")
    return {r[0]: r[1] for r in ids.select("doc_id", F.xxhash64(F.lit(7), "doc_id")).collect()}


def mixed(spark, rows):
    times = brute.repeats([(r[0], r[1], r[3]) for r in rows], shuffled(spark, rows))
    return [r for r, n in zip(rows, times) for _ in range(n)]


def sharded(rows):
    return [(*r, s) for r, s in zip(rows, brute.shards([(r[0], len((r[1] or "").encode())) for r in rows], LIMIT))]


def test_toxicity_stage(spark, case):
    docs, sf_dir = case
    out = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert out.columns == docs.columns
    assert Counter(plain(out)) == Counter(kept_clean(spark, docs, sf_dir, plain(docs)))


def test_simhash_stage(spark, case):
    docs, sf_dir = case
    out = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
    assert out.columns == docs.columns
    got, want = plain(out), kept_one(plain(docs))
    # of equal ids in a component any one may stay
    assert Counter(r[0] for r in got) == Counter(r[0] for r in want)
    assert not Counter(got) - Counter(plain(docs))


def test_decontamination_stage(spark, case):
    docs, sf_dir = case
    out = corpus_pipeline.drop_contaminated(spark, docs, sf_dir)
    assert out.columns == docs.columns
    assert Counter(plain(out)) == Counter(kept_unseen(spark, sf_dir, plain(docs)))


def test_mixing_stage(spark, case):
    docs, sf_dir = case
    # null and repeated ids have no order of their own to compare
    ids = docs.groupBy("doc_id").count().filter("count = 1 and doc_id is not null").select("doc_id")
    docs = docs.join(ids, "doc_id", "left_semi")
    out = corpus_pipeline.mix_sources(spark, docs, sf_dir)
    assert out.columns == docs.columns
    assert Counter(plain(out)) == Counter(mixed(spark, plain(docs)))


def test_mixing_stage_repeated_ids(spark, case):
    docs, sf_dir = case
    counts = Counter(plain(corpus_pipeline.mix_sources(spark, docs, sf_dir)))
    given = Counter(plain(docs))
    assert all(n <= 3 * given[r] for r, n in counts.items()) and not counts.keys() - given.keys()


def test_sharding_stage(spark, case):
    docs, sf_dir = case
    out = corpus_pipeline.assign_shards(spark, docs, sf_dir)
    assert out.columns[:len(docs.columns)] == docs.columns
    shard = out.columns[len(docs.columns) + 1]
    got = Counter((*r[:4], r[4][:60]) for r in (tuple(r) for r in out.select(*NAMES, shard).collect()))
    assert got == Counter(sharded(plain(docs)))


def test_run(spark, tables, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "SHARD_BYTES", LIMIT)
    out = corpus_pipeline.run(spark, tables)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = kept_clean(spark, docs, tables, plain(docs))
    rude, kind = (len([r for r in rows if said in (r[1] or "")]) for said in (RUDE, KIND))
    assert rude == 0 and kind == 80
    rows = kept_one(rows)
    assert {20_000, 20_001, 20_002} & {r[0] for r in rows} == {20_000}
    rows = kept_unseen(spark, tables, rows)
    assert 20_003 not in {r[0] for r in rows}
    want = sharded(mixed(spark, rows))
    shard = out.columns[len(docs.columns) + 1]
    got = [tuple(r) for r in out.select(*NAMES, shard).collect()]
    assert Counter((*r[:4], r[4][:60]) for r in got) == Counter(want)
    assert len({r[4] for r in got}) > 3


def test_empty(spark, tables, edge, tmp_path):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge.limit(0), tables)
        assert out.columns[:len(edge.columns)] == edge.columns and out.count() == 0, name
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
