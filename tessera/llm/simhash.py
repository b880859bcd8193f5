"""SimHash near-duplicates found through pivot distance tables.

Fingerprint: the text with A-Z lower-cased is cut into words; each shingle of
``words`` words is hashed (XXH64, seed 42); a fingerprint bit is set if more
than half of the shingle hashes have it.

Search. The reference fingerprints ("pivots") are the zero fingerprint and
unions of bit blocks. The Hamming distance to a union of blocks is linear in
the distances to zero and to the single blocks, so a table of 17 distances
(zero and 16 blocks of 4 bits) holds the distances to all 2^16 unions. Two
fingerprints at Hamming distance d differ by at most d in every pivot
distance, and over that whole family the maximum coordinate difference of two
rows has a closed form: the sum of the absolute differences of the 16 block
counts (``count_j = (d_0 + 4 - d_j) / 2``). Pairs whose maximum exceeds the
limit are discarded without being looked at: each row is filed under its own
count vector and those one step away, and two rows meet under a common vector
exactly if their maximum is 2 or less. Rows that meet are verified on the
whole 64 bits.

Scale. Equal fingerprints are folded first (one class, combined map-side), so
copies cost nothing. A count vector under which more than ``crowd`` classes
meet (a ball of near copies) is not compared pairwise; its members go on to the
finest pivot family, 64 blocks of one bit, where at most 65 classes can meet
and all of them are within 2 bits. Both ways are exact, so no link is lost.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, small, staged
from tessera.llm.components import components

SEED = 42
BLOCKS, WIDTH = 16, 4
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, words: int) -> int:
    """Unsigned 64-bit fingerprint; null and word-free texts give zero."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower(): A-Z only
    spans = _WORD.findall(raw)
    if not spans:
        return 0
    line = b" ".join(spans)
    ends = np.cumsum([len(w) + 1 for w in spans]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(spans))
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, dtype=np.int64), len(spans) - k + 1
    starts, ends = starts[:total].tolist(), ends[k - 1:].tolist()
    for at in range(0, total, 65536):  # bounded memory for very long texts
        h = np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts[at:at + 65536], ends[at:at + 65536])),
                        dtype=np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(_BITS[2 * ones > total].sum(dtype=np.uint64))


def with_fingerprint(df: DataFrame, text_col: str, words: int, name: str) -> DataFrame:
    """``df`` with the fingerprint as a signed long in column ``name``."""
    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, words) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(values.view(np.int64))
    return df.withColumn(name, fingerprints(col(text_col)))


def _counts(fp: Column) -> list[Column]:
    """Block counts of a row of the pivot distance table."""
    zero = F.bit_count(fp)  # distance to the zero fingerprint
    out = []
    for j in range(BLOCKS):
        block = F.lit(((1 << WIDTH) - 1) << (WIDTH * j) if j < BLOCKS - 1 else -(1 << 60))
        to_block = F.bit_count(fp.bitwiseXOR(block))
        out.append(((zero + WIDTH - to_block) / 2).cast("long"))
    return out


def _meeting_points(fps: DataFrame) -> DataFrame:
    """Each class under its own count vector and those one step away, as
    ``(point, fp)``; a vector is packed in 3 bits a block."""
    table = fps.select("fp", *[c.alias(f"c{j}") for j, c in enumerate(_counts(F.col("fp")))])
    own = sum((F.shiftleft(F.col(f"c{j}"), 3 * j) for j in range(BLOCKS)), F.lit(0).cast("long"))
    table = table.withColumn("own", own)
    points = [F.col("own")]
    for j in range(BLOCKS):
        step = F.lit(1 << (3 * j))
        points.append(F.when(F.col(f"c{j}") < WIDTH, F.col("own") + step))
        points.append(F.when(F.col(f"c{j}") > 0, F.col("own") - step))
    return table.select("fp", F.explode(F.array(*points)).alias("point")).filter("point is not null")


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges that connect what is within ``max_bits``, at most one per class."""
    out, left = [], np.ones(len(fps), dtype=bool)
    unsigned = fps.view(np.uint64)
    for i in range(len(fps)):
        if not left[i]:
            continue
        left[i], todo = False, [i]
        while todo:
            at = todo.pop()
            near = np.flatnonzero(left & (np.bitwise_count(unsigned ^ unsigned[at]) <= max_bits))
            left[near] = False
            out += [(int(fps[at]), int(fps[n])) for n in near]
            todo += near.tolist()
    return out


def _verify(max_bits: int):
    def run(batches):
        for pdf in batches:
            found = {e for fps in pdf["fps"] for e in forest(np.asarray(fps, dtype=np.int64), max_bits)}
            yield pd.DataFrame(list(found), columns=["a", "b"], dtype=np.int64)
    return run


def links(fps: DataFrame, max_bits: int = 2, crowd: int = 512) -> DataFrame:
    """Edges ``(a, b)`` that connect the distinct fingerprints ``fp`` within
    ``max_bits`` (at most 2) of each other, without listing all pairs."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the pivot points meet up to a distance of 2")
    points = _meeting_points(fps)
    met = points.groupBy("point").agg(F.count("*").alias("n")).filter("n > 1")
    members = staged(points.join(met, "point"), "meeting")
    lists = (members.filter(F.col("n") <= crowd).groupBy("point")
             .agg(F.collect_list("fp").alias("fps")).select("fps"))
    edges = lists.mapInPandas(_verify(max_bits), "a long, b long")
    crowded = members.filter(F.col("n") > crowd).select("fp").distinct()
    if max_bits < 2 or crowded.isEmpty():
        if max_bits < 2 and not crowded.isEmpty():
            raise ValueError("crowded points need max_bits = 2")
        return edges
    one_bit = F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(
        (1 << j) if j < 63 else -(1 << 63))) for j in range(64)]))
    fine = crowded.select("fp", one_bit.alias("point"))
    least = fine.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a <> z")
    return edges.union(fine.join(least, "point").filter("fp <> a").select("a", F.col("fp").alias("b")).distinct())


def classes(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, component_id)`` of rows ``(id, fp)``: the smallest id among the
    rows whose fingerprints are reachable by links."""
    reps = staged(fps.groupBy("fp").agg(F.min("id").alias("least_id")), "fps")
    roots = components(links(reps.select("fp"), max_bits), "a", "b")
    linked = staged(reps.join(roots, reps.fp == roots.node).select("fp", "root", "least_id"), "linked")
    least = small(staged(linked.groupBy("root").agg(F.min("least_id").alias("component_id")), "least"))
    joined = linked.join(least, "root").select(F.col("fp").alias("linked_fp"), "component_id")
    return staged(reps.join(joined, reps.fp == joined.linked_fp, "left").select(
        "fp", F.coalesce("component_id", "least_id").alias("component_id")), "classes")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    Null and word-free texts have fingerprint zero and link like any other.
    Null ids never become a component id unless all ids of a component are
    null. Repeated rows give repeated rows; other columns are ignored; an
    empty table gives no rows.
    """
    rows = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    rows = staged(with_fingerprint(rows, "text", words, "fp").select("id", "fp"), "fingerprints")
    found = classes(rows, max_bits).withColumnRenamed("fp", "class_fp")
    return rows.join(found, rows.fp == found.class_fp).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
             max_bits: int = 2) -> DataFrame:
    """``df`` with one row of each component: the one with the smallest id
    (null ids last), the first as stored among equal ids. Columns and their
    order stay. Every row is a document of its own, also if its id repeats."""
    rid, fp = fresh(df, "row_id", "fp")
    docs = staged(with_fingerprint(df, text_col, words, fp).withColumn(rid, F.monotonically_increasing_id()), "rows")
    rows = docs.select(col(id_col).alias("doc"), col(fp).alias("fp"), col(rid).alias("id"))
    found = classes(rows.select("id", "fp"), max_bits).withColumnRenamed("fp", "class_fp")
    member = staged(rows.join(found, rows.fp == found.class_fp).select("id", "doc", "component_id"), "members")
    best = member.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc").isNull().alias("no"), "doc", "id")).alias("best"), F.count("*").alias("n"))
    best = small(staged(best.filter("n > 1"), "best"))
    out = member.join(best, "component_id").filter("id <> best.id").select(
        F.col("id").alias("gone"))
    out = small(staged(out, "dropped"))
    return docs.join(out, col(rid) == F.col("gone"), "left_anti").select(*[col(c) for c in df.columns])
