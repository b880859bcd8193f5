"""Training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir), calls one operator of ``tessera.llm`` on
all that its predecessor kept and returns the documents that stay, with the
columns of ``documents``; the last one adds the shard. A stage's result is
written as Parquet and read again as the next one's documents.

* toxicity: documents scored 0.5 or more go.
* simhash_dedup: of each group of near copies (3-word shingles, 2 bits) the
  document with the smallest id stays.
* decontamination: documents that contain ten consecutive words of a benchmark
  item (or a shorter item whole) go.
* mixing: a document stays as often as the mix takes its first word, up to
  three times; sources over their target lose documents, sources under it
  repeat some; documents without words go.
* sharding: every document gets its shard; none goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, mixing, sharding, simhash, toxicity
from tessera.llm.common import col, fresh, staged, table
from tessera.llm.queries import SHARD_BYTES


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    flag = fresh(docs, "score", "predicted")[1]
    return toxicity.score(docs, model).filter(col(flag) == 0).select(*[col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, "doc_id", "text", words=3, max_bits=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    flag = fresh(docs, "n_words", "n_hit", "n_items", "items", "spans", "contaminated")[5]
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(~col(flag)).select(*[col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    size, = fresh(docs, "size")
    sized = docs.withColumn(size, mixing.word_count(F.col("text")))
    starts = fresh(sized, "source_size", "target", "taken", "starts")[3]
    times = mixing.mix(sized, "doc_id", "source", size).filter(col(starts) > 0)
    again, = fresh(times, "again")
    return times.withColumn(again, F.explode(F.sequence(F.lit(1), col(starts).cast("int")))).select(
        *[col(c) for c in docs.columns])


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    size, = fresh(docs, "n_bytes")
    sized = docs.withColumn(size, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return sharding.assign_shards(sized, "doc_id", size, SHARD_BYTES)


STAGES = [("toxicity", drop_toxic), ("simhash_dedup", drop_near_copies), ("decontamination", drop_contaminated),
          ("mixing", mix_sources), ("sharding", assign_shards)]

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
