"""One query per operator, over the whole of its tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (chat, codes, decontaminate, embed_dedup, line_dedup, mixing, packing, pii, quality, sharding,
                         simhash, spelling, toxicity)
from tessera.llm.common import table

SHARD_BYTES = 16 << 20   # of text, before compression
BOILERPLATE = 0.2        # share of a host's pages
QUERY_SHARD_BYTES = 64 << 10  # of op2_sharding: small, so that small tables too are split to several depths


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(
        F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return sharding.assign_shards(docs, "doc_id", "n_bytes", QUERY_SHARD_BYTES)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(docs, "doc_id", "source", "size")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", line_dedup.host_of(F.col("url")).alias("host"), line_dedup.html_text(F.col("html")).alias("text"))
    kept = line_dedup.drop_boilerplate(pages, "host", "text", BOILERPLATE)
    return kept.select("page_id", "host", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = [pii.count_kind(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS[:4])]
    return found.select("doc_id", *n,
                        F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"), pii.spelled(F.col("spans")).alias("spans"),
                        F.sha2("sanitised", 256).alias("sanitised_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", words=3, max_bits=2)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.posterior(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.9)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.quantise(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
                        "error", "label_error", F.lit(codes.books_sha256(books)).alias("codebooks_sha256"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_sharding, op3_mixing, op4_line_dedup, op5_pii, op6_simhash,
                                   op7_decontamination, op8_quality, op9_chat, op10_embedding_dedup, op11_spelling,
                                   op12_vector_codes, op13_packing)}



def _codes_sql(rounds: int = 6) -> str:
    """The rounds written out: squared distances, nearest entries, new means."""
    near = """
dist{k} AS (SELECT vec_id, part, entry, sum((x - c) * (x - c)) AS d FROM x JOIN book{k} USING (part, pos) GROUP BY ALL),
near{k} AS (SELECT vec_id, part, min(d * 16 + entry) % 16 AS entry, min(d) AS d FROM dist{k} GROUP BY ALL)"""
    step = """
mean{k} AS (SELECT part, pos, entry, sum(x) AS s, count(*) AS n FROM x JOIN near{k} USING (vec_id, part) GROUP BY ALL),
book{n} AS (SELECT part, pos, entry, CAST(coalesce((s - (s % n + n) % n) // n, c) AS BIGINT) AS c
            FROM book{k} LEFT JOIN mean{k} USING (part, pos, entry))"""
    return """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT vec_id, d // 8 AS part, d % 8 AS pos, v[d + 1] AS x FROM kept, range(0, 64) AS r(d)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 16),
book0 AS (SELECT part, pos, entry, x AS c FROM x JOIN first USING (vec_id)),""" + ",".join(
        near.format(k=k) + "," + step.format(k=k, n=k + 1) for k in range(rounds)) + "," + near.format(k=rounds) + f""",
coded AS (SELECT vec_id, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM near{rounds} GROUP BY vec_id),
sums AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label)
SELECT vec_id, code, error, label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id) JOIN sums ON kept.label IS NOT DISTINCT FROM sums.label"""


_STRIP = "html"
for _pattern, _put in (*line_dedup._STEPS,):
    _STRIP = f"regexp_replace({_STRIP}, '{_pattern}', {'chr(10)' if _put else repr('')}, 'g')"

ORACLE = {
    "op2_sharding": f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         lpad(bin(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT)), 60, '0') AS bits
  FROM documents),
nodes AS (
  SELECT d AS depth, substr(bits, 1, CAST(d AS INTEGER)) AS shard, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs
  FROM docs, range(0, 41) AS r(d) GROUP BY ALL),
leaves AS (
  SELECT doc_id, n_bytes, shard, CAST(depth AS INTEGER) AS depth, shard_bytes, shard_docs,
         row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS nth
  FROM docs JOIN nodes ON substr(bits, 1, CAST(depth AS INTEGER)) = shard
  WHERE shard_bytes <= {QUERY_SHARD_BYTES} OR shard_docs = 1)
SELECT doc_id, n_bytes, shard, depth, shard_bytes, shard_docs, shard_bytes > {QUERY_SHARD_BYTES} AS oversize FROM leaves WHERE nth = 1""",
    "op4_line_dedup": f"""
WITH pages_text AS (
  SELECT page_id, lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '')) AS host, {_STRIP} AS body FROM pages),
split_lines AS (
  SELECT page_id, host, list_filter(list_transform(string_split(coalesce(body, ''), chr(10)),
         lambda s: trim(regexp_replace(s, '\\s+', ' ', 'g'))), lambda s: s <> '') AS ls FROM pages_text),
host_pages AS (SELECT host, count(*) AS pages FROM split_lines GROUP BY host),
seen AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(ls)) AS line FROM split_lines) GROUP BY ALL),
often AS (SELECT host, list(line) AS common FROM seen JOIN host_pages USING (host)
          WHERE n > 1 AND n > pages * {BOILERPLATE} GROUP BY host),
kept AS (SELECT page_id, host, ls, list_filter(ls, lambda s: NOT list_contains(coalesce(common, []), s)) AS rest
         FROM split_lines LEFT JOIN often USING (host))
SELECT page_id, host, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(rest) AS BIGINT) AS n_dropped,
       sha256(array_to_string(rest, chr(10))) AS kept_sha256 FROM kept""",
    "op9_chat": """
WITH t AS (
  SELECT *, CAST(floor((row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, role, said) - 1) / 1024) AS BIGINT) AS piece
  FROM (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS said,
               CAST(coalesce(floor(turn / 64), 0) AS BIGINT) AS part FROM conversations)),
who AS (SELECT DISTINCT conv_id AS conv, role AS perspective FROM t WHERE role <> 'system'),
p AS (
  SELECT t.*, perspective, '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
         ELSE 'user name=' || role END || chr(10) AS head
  FROM t JOIN who ON conv_id IS NOT DISTINCT FROM conv),
q AS (
  SELECT *, coalesce(sum(length(head) + length(said) + 11) OVER (PARTITION BY conv_id, perspective, part, piece
         ORDER BY turn NULLS FIRST, role, said ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS s FROM p)
SELECT conv_id, perspective, part, piece, count(*) AS n_turns,
       string_agg(head || said || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, said) AS text,
       coalesce(string_agg(CASE WHEN role = perspective THEN CAST(s AS BIGINT) || ':' || CAST(s + length(said) AS BIGINT) END, ','
                ORDER BY turn NULLS FIRST, role, said), '') AS mask
FROM q GROUP BY conv_id, perspective, part, piece""",
    "op12_vector_codes": _codes_sql(),
}
