"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a sequence of slots of one block of words each. Slot ``i`` stands at
the golden-ratio point ``frac(i * 0.618...)``; the cumulative weights of the
sources cut the unit interval, so a point names the source of its slot, and
every stretch of the sequence holds the sources near their weights. A slot's
rank among its source's slots names the block it takes: each source's documents,
shuffled by hash, are laid end to end and cut into blocks of equal words, taken
in that order, again from the start when the source is used up.

Scale. Sources are summed before anything is planned; the only table that is
handled in one task has a row per source. Ranks and running sums inside a
source, which may hold a third of the rows, go by two levels: chunks are summed,
the sums are accumulated per source, and rows are numbered inside their chunk.
Documents meet slots on (source, block), a fine key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, small, staged

GOLDEN = 0.6180339887498949  # 1 / golden ratio
GOLDEN_2_20 = 0.607787409740351  # fraction of 2^20 times it, from more digits
BLOCK_WORDS = 4096   # largest block; small inputs use smaller ones
LEAST_SLOTS = 65536  # blocks are small enough that the mix has about so many
SPARE = 8            # points per slot, so that each interval gets its slots
CHUNK = 16384        # rows of a source that are numbered in one window


def word_count(text):
    """Number of runs of characters other than space and U+0009-U+000D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """``(source, source_size, target)`` from one row per source.

    Sources by code point, null last, get the weights in turn and share the sum
    of all sizes by them; a target stops at ``most`` times its source's size and
    the excess goes to the others by weight. Sorted by cap over weight, the
    capped sources come first, so the common level is a running expression.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at + 1).cast("int"))
    caps = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    caps = caps.withColumn("level", level)
    open_ = F.col("cap") > F.col("level") * F.col("weight")
    caps = caps.withColumn("nth", F.row_number().over(by_ratio))
    common = F.min(F.when(open_, F.struct("nth", "level"))).over(whole)["level"]
    share = F.col("weight") * common
    return caps.select("source", "source_size",
                       F.when(common.isNull() | (F.col("cap") < share), F.col("cap")).otherwise(share).alias("target"))


def _running(rows: DataFrame, group: str, chunk: str, order: list, size, before: str) -> DataFrame:
    """``rows`` with ``before``: the sum of ``size`` over the earlier rows of
    the group, in the order of (chunk, order)."""
    sums = rows.groupBy(group, chunk).agg(F.sum(size).alias("chunk_sum"))
    over = Window.partitionBy(group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(group).alias("g"), F.col(chunk).alias("k"),
                          F.coalesce(F.sum("chunk_sum").over(over), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
            .join(offsets, (F.col(group) == F.col("g")) & (F.col(chunk) == F.col("k")))
            .withColumn(before, F.col("offset") + F.col("inside")).drop("g", "k", "offset", "inside"))


def mix(df: DataFrame, id_col: str, source_col: str, size_col: str, weights: tuple[float, ...] = (1, 2, 3),
        most: int = 3, seed: int = 7) -> DataFrame:
    """``df``'s rows with what the mix takes of each: the columns of ``df``
    plus ``source_size``, ``target``, ``taken`` (words, repeats counted) and
    ``starts`` (how often the mix takes the row's first word); an underscore is
    added to a name that ``df`` has already.

    A source's taken words are its target rounded to whole words. Null or
    negative sizes count 0, rows of size 0 take 0, a null source is a source of
    its own, equal rows are separate documents. Nothing is drawn at random:
    reruns agree. An empty table gives no rows.
    """
    rid, = fresh(df, "row_id")
    base = staged(df.withColumn(rid, F.monotonically_increasing_id()), "mix-rows")
    size = F.greatest(F.coalesce(col(size_col).cast("long"), F.lit(0)), F.lit(0))
    rows = base.select(col(rid).alias("rid"), col(source_col).alias("source"), size.alias("size"),
                       F.xxhash64(F.lit(seed), col(id_col), F.when(col(id_col).isNull(), col(rid))).alias("shuffle"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sizes = staged(sizes, "source-sizes")
    plan = targets(sizes.select("source", "source_size"), weights, most).join(
        sizes.select(F.col("source").alias("s"), "docs"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    block = int(min(BLOCK_WORDS, max(1, total // LEAST_SLOTS)))
    ids = Window.orderBy(F.col("source").asc_nulls_last())
    plan = plan.withColumn("taken_words", F.least(F.round("target").cast("long"), F.col("source_size") * most))
    blocks = F.ceil(F.col("source_size") / block)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("taken_words") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs).withColumn("blocks", blocks).withColumn(
        "rest", F.col("taken_words") - F.col("epochs") * F.col("source_size"))
    plan = plan.withColumn("slots", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / block))
    all_ = Window.partitionBy()
    to = F.sum("slots").over(ids.rowsBetween(Window.unboundedPreceding, 0))
    plan = plan.withColumn("sid", F.row_number().over(ids)).withColumn("n", F.sum("slots").over(all_))
    plan = plan.withColumn("hi", to / F.col("n")).withColumn("lo", (to - F.col("slots")) / F.col("n"))
    plan = small(staged(plan, "source-plan"))

    schedule = _schedule(plan, int(plan.agg(F.max("n")).first()[0] or 0))
    # what the slots take of each block: whole, or its first words in the last slot
    taken = schedule.join(plan.select("sid", "blocks", "slots", "rest"), "sid").select(
        "sid", (F.col("rank") % F.col("blocks")).alias("block"),
        F.when(F.col("rank") == F.col("slots") - 1, F.col("rest") % block).otherwise(0).alias("cut"))
    taken = taken.groupBy("sid", "block").agg(
        F.count(F.when(F.col("cut") == 0, 1)).alias("whole"), F.max("cut").alias("cut"))

    docs = rows.filter("size > 0").join(plan.select(F.col("source").alias("s"), "sid", "docs"),
                                        F.col("source").eqNullSafe(F.col("s")))
    # chunks are stretches of the hash order, a few more of them than needed
    parts = F.ceil(F.col("docs") / (CHUNK // 2)).cast("double")
    place = (F.shiftrightunsigned("shuffle", 11) / F.lit(float(1 << 53)))
    docs = docs.withColumn("chunk", F.floor(place * parts))
    docs = _running(docs.select("rid", "sid", "size", "shuffle", "chunk"), "sid", "chunk", ["shuffle", "rid"], "size", "from")
    pieces = docs.select("rid", "sid", "from", (F.col("from") + F.col("size")).alias("to"), F.explode(F.sequence(
        F.floor(F.col("from") / block), F.floor((F.col("from") + F.col("size") - 1) / block))).alias("block"))
    start, end = F.greatest(F.col("from") - F.col("block") * block, F.lit(0)), F.least(
        F.col("to") - F.col("block") * block, F.lit(block))
    words = F.col("whole") * (end - start) + F.greatest(F.least(end, F.col("cut")) - start, F.lit(0))
    first = F.when(F.col("from") >= F.col("block") * block,
                   F.col("whole") + (F.col("cut") > start).cast("long")).otherwise(0)
    per_row = pieces.join(taken, ["sid", "block"]).select("rid", words.alias("words"), first.alias("first")).groupBy(
        "rid").agg(F.sum("words").alias("words"), F.sum("first").alias("first"))

    out = fresh(df, "source_size", "target", "taken", "starts")
    by_source, by_row = fresh(base, "by_source", "by_row")
    plan_of = plan.select(F.struct("source", "source_size", "target").alias(by_source))
    row_of = per_row.select(F.struct("rid", "words", "first").alias(by_row))
    return (base.join(row_of, col(rid) == F.col(f"{by_row}.rid"), "left")
            .join(plan_of, col(source_col).eqNullSafe(F.col(f"{by_source}.source")))
            .select(*[col(c) for c in df.columns], F.col(f"{by_source}.source_size").alias(out[0]),
                    F.col(f"{by_source}.target").alias(out[1]),
                    F.coalesce(F.col(f"{by_row}.words"), F.lit(0)).alias(out[2]),
                    F.coalesce(F.col(f"{by_row}.first"), F.lit(0)).alias(out[3])))


def _schedule(plan: DataFrame, slots: int) -> DataFrame:
    """``(sid, rank)`` of the slots: the golden-ratio points in order, each
    given to the source whose interval holds it, until the source has its
    slots. ``SPARE`` times as many points are laid as there are slots, so an
    interval of one slot gets a point too; points past a source's last slot
    are not slots."""
    spark = plan.sparkSession
    # id = high * 2^20 + low, so that the products keep their fractions exact
    x = F.shiftright("id", 20) * GOLDEN_2_20 + F.col("id").bitwiseAND(F.lit((1 << 20) - 1)) * GOLDEN
    points = spark.range(slots * SPARE).select(F.col("id").alias("i"), (x - F.floor(x)).alias("x"))
    # an equi-join on a grid of cells, then the exact interval
    grid = 4096
    spans = plan.filter("slots > 0").select("sid", "lo", "hi", F.col("slots").alias("most"), F.explode(F.sequence(
        F.floor(F.col("lo") * grid), F.floor(F.col("hi") * grid))).alias("cell"))
    points = points.withColumn("cell", F.floor(F.col("x") * grid)).join(small(staged(spans, "spans")), "cell")
    points = points.filter("lo <= x and x < hi").select("sid", "i", "most", F.floor(F.col("i") / CHUNK).alias("chunk"))
    points = points.withColumn("one", F.lit(1))
    return _running(points, "sid", "chunk", ["i"], "one", "rank").filter("rank < most").select("sid", "rank")
