"""Session, staging and join-sizing helpers shared by every operator.

Three rules are enforced here so the operators do not repeat them:

* lineage is cut by writing Parquet under the cluster's shared
  ``spark.checkpoint.dir`` (never a machine-local folder, never
  ``localCheckpoint``);
* a side is broadcast only after its row count has been checked against
  a bound; above it the join stays a shuffle join (AQE may still pick a
  broadcast at runtime from real statistics);
* sessions built here have the UI off and AQE on.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest number of rows of a fitted lookup table (group medians, group
# means, label codes) that is shipped to every task as a broadcast.
BROADCAST_MAX_ROWS = 200_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    """Session for tests and the bench: local master, UI off, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``; it is only set here
    when it is unset *and* the master is local (tests, bench). On a
    cluster without it we refuse rather than fall back to a local disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for it")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Used where a plan would otherwise carry a long lineage (fold and seed
    loops): a lost executor then re-reads the written files instead of
    recomputing every fit before it.
    """
    return _written(spread(df), name)


def stage_joined(df: DataFrame, name: str) -> DataFrame:
    """:func:`stage` for a join. That of tables larger than a piece for every task at once
    has a shuffle that leaves about as many pieces as :func:`spread` makes: it is written as
    it is, and dealt out (by a hash of the row, which needs no sort) only if fewer files
    than tasks at once came of it. Smaller tables are dealt out as by :func:`stage`."""
    pieces, want = spread_pieces(df), df.sparkSession.sparkContext.defaultParallelism
    if 0 < pieces <= want:
        return _written(df.repartition(pieces), name)
    out = _written(df, name)
    if not pieces or len(out.inputFiles()) >= want:
        return out
    return _written(out.repartition(pieces, F.xxhash64(*[F.col(f"`{c}`") for c in out.columns])), name)


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/stage/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Bytes of the input files to one of the pieces that ``spread`` deals rows to: joined
# and decoded rows take about ten times that.
SPREAD_BYTES = 8 << 20


def spread(df: DataFrame) -> DataFrame:
    """Round-robin repartition only when the plan reads fewer files than the
    cluster runs tasks at once (the test tables have one row group each, and
    few large files may have few too). The pieces are as many as tasks run at
    once, or more by the files' bytes, so that no piece grows with the input.
    The plan's files are listed, no part of the plan is run."""
    pieces = spread_pieces(df)
    return df.repartition(pieces) if pieces else df


def spread_pieces(df: DataFrame) -> int:
    """Pieces to deal the rows to; 0 where the plan reads files enough."""
    spark, files = df.sparkSession, df.inputFiles()
    want = spark.sparkContext.defaultParallelism
    return 0 if len(files) >= want else max(want, -(-file_bytes(spark, files) // SPREAD_BYTES))


def file_bytes(spark: SparkSession, files: list[str]) -> int:
    """Total length of files; their contents are not read."""
    if not files:
        return 0
    # listed names are escaped as in a URL, read ones may be patterns
    paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(f)) for f in files]
    return spark.read.format("binaryFile").load(paths).agg(F.sum("length")).first()[0] or 0


# Rows of a task of a tree fit: a fit runs a small job per tree level, and many
# fits run side by side, so that small tables need few tasks each.
FIT_TASK_ROWS = 50_000


def fit_rows(df: DataFrame) -> DataFrame:
    """``df`` in no more partitions than it has ``FIT_TASK_ROWS`` rows; a large
    table keeps its own."""
    return df.coalesce(max(1, -(-df.count() // FIT_TASK_ROWS)))


# Values (rows times features) for every task at once that are held in memory
# for fits: by a table kept for many fits, and by the fits that run side by side.
FIT_VALUES = 12_000_000


def fit_values(spark: SparkSession) -> int:
    return FIT_VALUES * spark.sparkContext.defaultParallelism


def fit_table(df: DataFrame, features: list[str], regroup: bool = True) -> tuple[DataFrame, int]:
    """``df`` as many fits read it, and its number of rows: :func:`fit_rows` (with
    ``regroup``), kept in memory if ``fit_values`` allows it. A larger one is read anew from where
    it is staged, which takes a tenth of the bytes of its decoded rows."""
    rows = df.count()
    out = df.coalesce(max(1, -(-rows // FIT_TASK_ROWS))) if regroup else df
    return (out.persist() if rows * len(features) <= fit_values(df.sparkSession) else out), rows


def bounded_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint for ``small`` only when its row count is within bound.

    ``small`` is always a fitted aggregate (one row per group or per
    distinct value), so counting it is one cheap job over an already
    reduced table. Above the bound the caller's join stays a shuffle join.
    """
    n = small.count()
    return F.broadcast(small) if n <= max_rows else small


class FitSlots:
    """Model fits that run at once, however fold, seed and member loops are nested:
    ``most`` of them, of no more values than a limit together. A tree fit holds its
    rows, binned, and their errors over all its jobs, in memory or else on disk, from
    where every job reads them; a fit of more values than the limit has tasks enough
    to run alone."""

    def __init__(self, most: int):
        self.most, self._running, self._free = most, [], threading.Condition()

    @contextmanager
    def take(self, values: int = 0, limit: float = float("inf")):
        with self._free:
            self._free.wait_for(lambda: not self._running or (
                len(self._running) < self.most and sum(self._running) + values <= limit))
            self._running.append(values)
        try:
            yield
        finally:
            with self._free:
                self._running.remove(values)
                self._free.notify_all()


FIT_SLOTS = FitSlots(int(os.environ.get("TESSERA_FIT_SLOTS", "8")))


def side_by_side(fn, jobs) -> list:
    """``fn`` over ``jobs`` from driver threads, results in order. Threads only
    wait; what they fit takes one of the session's ``FIT_SLOTS``. There are no more threads
    than slots: each has one in the JVM too, with a stack that plans make deep."""
    jobs = list(jobs)
    with ThreadPoolExecutor(max_workers=max(1, min(len(jobs), FIT_SLOTS.most))) as pool:
        return list(pool.map(fn, jobs))


def fit_in_slot(model, df: DataFrame, features: list[str], label: str, rows: int | None = None):
    """Fit when a slot is free; ``rows``: those of ``df``, if they are known. A
    ``composite`` model takes none itself, as the fits inside it do."""
    if getattr(model, "composite", False):
        return model.fit(df, features, label)
    values = (df.count() if rows is None else rows) * len(features)
    with FIT_SLOTS.take(values, fit_values(df.sparkSession)):
        return model.fit(df, features, label)
