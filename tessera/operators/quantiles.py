"""Exact quantiles of many columns over many training parts at once.

Ranks add up over the cells of a partition of the rows (folds, or pairs of an
outer and an inner fold): the number of values below a point in "all rows but
those of fold f" is the total less the fold's. So two scans serve every column
and every training part of a cross-validation:

1. approximate quantiles of all columns, only as pivots that cut each column
   into slices (a pivot is a slice of its own);
2. a count per ``(column, slice, cell)``; ranks of every part follow by adding
   cells, and with them the slices that hold a wanted rank;
3. the values of those slices, as ``(column, value, cell, count)`` rows.

Slices with more values than may be gathered are cut again. What reaches
the driver is counts per column, slice and cell, and at most ``gather`` values;
results are exact and linearly interpolated at every size. A table of at most
``gather`` values in all is gathered at once, which changes the plan only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATHER = 1_000_000     # values of undecided slices on the driver
AROUND = (0.004, 0.02, 0.1)  # pivots beside a wanted share
ACCURACY = 1000
POINTS = 512           # order statistics a task keeps of a column


def _numbers(df: DataFrame, columns: Sequence[str], cell: Column | None) -> DataFrame:
    cell = F.lit(0) if cell is None else cell
    return df.select(cell.cast("int").alias("__cell"), *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])


def _pivots(rows: DataFrame, n: int, probs: Sequence[float]) -> list[np.ndarray]:
    """Approximate quantiles of every column, from weighted order statistics of every
    batch, thinned out in the task and again where all meet."""
    grid = sorted({min(1.0, max(0.0, p + s)) for p in probs for a in (0, *AROUND) for s in (-a, a)})

    def run(batches):
        held: list[list] = [[] for _ in range(n)]
        for batch in batches:
            for i, x, _ in _columns(batch, n):
                if len(x):
                    held[i].append(_thinned(np.sort(x), np.ones(len(x))))
                    if len(held[i]) == 32:
                        held[i] = [_merged(held[i])]
        for i, parts in enumerate(held):
            if parts:
                x, weight = _merged(parts)
                yield _table({"column": pa.int32(), "x": pa.float64(), "weight": pa.float64()},
                             column=np.full(len(x), i, np.int32), x=x, weight=weight)

    few = rows.coalesce(4 * rows.sparkSession.sparkContext.defaultParallelism)
    points = few.mapInArrow(run, "column int, x double, weight double").toPandas()
    out = [np.zeros(0)] * n
    for i, of in points.groupby("column"):
        of = of.sort_values("x")
        upto = of["weight"].cumsum().to_numpy()
        at = np.searchsorted(upto, np.array(grid) * upto[-1], "left").clip(max=len(upto) - 1)
        out[i] = np.unique(of["x"].to_numpy()[at])
    return out


def _thinned(x: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``POINTS`` of sorted points, at even steps of weight and with all of it."""
    if len(x) <= POINTS:
        return x, weight
    upto = np.cumsum(weight)
    at = np.searchsorted(upto, (np.arange(POINTS) + .5) / POINTS * upto[-1], "left").clip(max=len(x) - 1)
    return x[at], np.full(POINTS, upto[-1] / POINTS)


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    x, weight = (np.concatenate(arrays) for arrays in zip(*parts))
    order = np.argsort(x)
    return _thinned(x[order], weight[order])


def _slices(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """2j for values between pivots j - 1 and j, 2j + 1 for pivot j itself."""
    return np.searchsorted(pivots, x, "left") + np.searchsorted(pivots, x, "right")


def _columns(batch: pa.RecordBatch, n: int):
    placed = pa.compute.fill_null(batch.column(0), -1).to_numpy(zero_copy_only=False)
    for i in range(n):
        x = batch.column(i + 1).to_numpy(zero_copy_only=False).astype(float)   # nulls become NaN
        there = ~np.isnan(x) & (placed >= 0)    # rows in no cell are in no part
        yield i, x[there] + 0.0, placed[there]


def _table(kind: dict, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in kind.items()], list(kind))


_COUNT = {"column": pa.int32(), "slice": pa.int32(), "cell": pa.int32(), "n": pa.int64(), "low": pa.float64(), "high": pa.float64()}
_VALUE = {"column": pa.int32(), "x": pa.float64(), "cell": pa.int32(), "n": pa.int64()}


def _counts(rows: DataFrame, pivots: list[np.ndarray]) -> pd.DataFrame:
    """``column, slice, cell, n, low, high``; a slice's values lie between ``low`` and
    ``high`` whatever their cell."""
    def run(batches):
        seen: dict[tuple, list] = {}
        for batch in batches:
            for i, x, cell in _columns(batch, len(pivots)):
                if not len(x):
                    continue
                order = np.argsort(x)
                x, cell = x[order], cell[order]
                # sorted, a slice is a stretch between the places of the pivots
                ends = np.empty(2 * len(pivots[i]) + 1, dtype=np.int64)
                ends[:-1:2], ends[1::2] = np.searchsorted(x, pivots[i], "left"), np.searchsorted(x, pivots[i], "right")
                ends[-1] = len(x)
                sizes = np.diff(ends, prepend=0)
                cells = int(cell.max()) + 1
                s = np.repeat(np.arange(len(sizes)), sizes)
                n = np.bincount(s * cells + cell, minlength=len(sizes) * cells).reshape(len(sizes), cells)
                for s, c in zip(*(at.tolist() for at in np.nonzero(n))):
                    at = seen.setdefault((i, s, c), [0, np.inf, -np.inf])
                    low, high = x[ends[s] - sizes[s]], x[ends[s] - 1]
                    at[:] = at[0] + int(n[s, c]), min(at[1], float(low)), max(at[2], float(high))
        if seen:
            keys, vals = list(zip(*seen)), list(zip(*seen.values()))
            yield _table(_COUNT, column=keys[0], slice=keys[1], cell=keys[2], n=vals[0], low=vals[1], high=vals[2])
    found = rows.mapInArrow(run, "column int, slice int, cell int, n long, low double, high double")
    return found.groupBy("column", "slice", "cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).toPandas()


def _values(rows: DataFrame, pivots: list[np.ndarray], wanted: list[np.ndarray | None]) -> pd.DataFrame:
    """``column, x, cell, n`` of the values in wanted slices (None: all)."""
    def run(batches):
        for batch in batches:
            for i, x, cell in _columns(batch, len(pivots)):
                if wanted[i] is not None:
                    keep = np.isin(_slices(x, pivots[i]), wanted[i])
                    x, cell = x[keep], cell[keep]
                if len(x):
                    part = pd.DataFrame({"x": x, "c": cell}).groupby(["x", "c"]).size().reset_index()
                    yield _table(_VALUE, column=np.full(len(part), i, np.int32), x=part["x"], cell=part["c"], n=part[0])
    found = rows.mapInArrow(run, "column int, x double, cell int, n long")
    return found.groupBy("column", "x", "cell").agg(F.sum("n").alias("n")).toPandas()


def _finer(rows: DataFrame, pivots: list[np.ndarray], wanted: list[np.ndarray]) -> list[np.ndarray]:
    """Pivots, and more of them inside the wanted slices."""
    def run(batches):
        for batch in batches:
            for i, x, _ in _columns(batch, len(pivots)):
                s = _slices(x, pivots[i])
                keep = np.isin(s, wanted[i])
                if keep.any():
                    n = int(keep.sum())
                    yield _table({"column": pa.int32(), "slice": pa.int32(), "x": pa.float64()},
                                 column=np.full(n, i, np.int32), slice=s[keep], x=x[keep])
    grid = [j / 256 for j in range(1, 256)]
    cuts = rows.mapInArrow(run, "column int, slice int, x double").groupBy("column", "slice").agg(
        F.percentile_approx("x", grid, 4 * ACCURACY).alias("v")).collect()
    out = list(pivots)
    for r in cuts:
        out[r["column"]] = np.unique(np.concatenate([out[r["column"]], r["v"]]))
    return out


def _wanted_ranks(n: int, probs: Sequence[float]) -> list[tuple[int, int, float]]:
    """(lower rank, upper rank, place between) of each share of n values."""
    out = []
    for p in probs:
        at = p * (n - 1)
        out.append((int(np.floor(at)), int(np.ceil(at)), at - np.floor(at)))
    return out


class _Ranks:
    """Values by rank of one column and part: slices with counts, and the values
    of the undecided ones."""

    def __init__(self, slices: np.ndarray, counts: np.ndarray):
        self.slices, self.ends = slices, np.cumsum(counts)

    def slice_of(self, rank: int) -> tuple[int, int]:
        """(slice, rank inside it)."""
        k = int(np.searchsorted(self.ends, rank, "right"))
        return int(self.slices[k]), rank - (int(self.ends[k - 1]) if k else 0)


def cell_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], cell: Column | None = None,
                   parts: Mapping[object, Sequence[int]] | None = None, gather: int = GATHER) -> dict[object, dict[str, list[float]]]:
    """``{part: {column: [quantile...]}}``: exact, interpolated quantiles of each
    column over the rows of each part, a part being a list of cells (``cell``: an
    integer column; None: one cell 0, and the part None).

    NULL and NaN are left out; a column without a value in a part is missing
    from that part.
    """
    parts = parts if parts is not None else {None: [0]}
    columns = list(columns)
    if not columns:
        return {p: {} for p in parts}
    rows = _numbers(df, columns, cell)
    n_cells = max((c for cells in parts.values() for c in cells), default=0) + 1
    whole = rows.count() * len(columns) <= gather
    pivots = [np.zeros(0)] * len(columns) if whole else _pivots(rows, len(columns), probs)
    while True:
        if whole:
            found = _values(rows, pivots, [None] * len(columns))
            break
        counts = _counts(rows, pivots)
        ranks, needs, single = {}, [set() for _ in columns], {}
        for i, of in counts.groupby("column"):
            tab = of.pivot_table(index="slice", columns="cell", values="n", fill_value=0).reindex(columns=range(n_cells), fill_value=0)
            ends = of.groupby("slice").agg(low=("low", "min"), high=("high", "max"))
            single[i] = {s: low for s, low, high in ends.itertuples() if low == high}
            for part, cells in parts.items():
                total = tab[list(cells)].sum(axis=1).to_numpy()
                r = ranks[i, part] = _Ranks(tab.index.to_numpy(), total)
                for lo, hi, _ in _wanted_ranks(int(total.sum()), probs) if total.sum() else []:
                    needs[i] |= {s for s, _ in (r.slice_of(lo), r.slice_of(hi)) if s not in single[i]}
        sizes = counts.groupby(["column", "slice"])["n"].sum()
        if sum(int(sizes[i, s]) for i, need in enumerate(needs) for s in need) <= gather:
            found = _values(rows, pivots, [np.array(sorted(s), dtype=np.int64) for s in needs]) if any(needs) else None
            break
        pivots = _finer(rows, pivots, [np.array(sorted(s), dtype=np.int64) for s in needs])
    out: dict[object, dict[str, list[float]]] = {p: {} for p in parts}
    held = dict(list(found.groupby("column"))) if found is not None else {}
    for i, name in enumerate(columns):
        tables = {}
        if i in held:
            tab = held[i].pivot_table(index="x", columns="cell", values="n", fill_value=0).reindex(columns=range(n_cells), fill_value=0)
            x = tab.index.to_numpy()
            by_slice = _slices(x, pivots[i]) if len(pivots[i]) else np.zeros(len(x), dtype=int)
            tables = {s: (x[by_slice == s], tab[by_slice == s]) for s in np.unique(by_slice)}
        for part, cells in parts.items():
            if whole:
                n = int(tables[0][1][list(cells)].sum().sum()) if tables else 0
            else:
                n = int(ranks[i, part].ends[-1]) if (i, part) in ranks else 0
            if not n:
                continue
            at = {}

            def value(rank: int) -> float:
                s, inside = (0, rank) if whole else ranks[i, part].slice_of(rank)
                if not whole and s in single[i]:
                    return float(single[i][s])
                if s not in at:
                    at[s] = np.cumsum(tables[s][1][list(cells)].sum(axis=1).to_numpy())
                return float(tables[s][0][np.searchsorted(at[s], inside, "right")])

            q = []
            for lo, hi, between in _wanted_ranks(n, probs):
                a, b = value(lo), value(hi)
                q.append(a if a == b else (1 - between) * a + between * b)
            out[part][name] = q
    return out


def leave_one_out(k: int) -> dict[object, list[int]]:
    """The training parts of a k-fold run: all rows (None), all but fold f."""
    return {None: list(range(k))} | {f: [g for g in range(k) if g != f] for f in range(k)}
