"""Second moments of training parts, and linear fits from them (M1-M4, M6, V5, V6).

A least-squares fit needs the Gramian of ``[1, x, y]`` only, and Gramians add up
over the cells of a partition of the rows. One pass therefore serves every
training part of a nested cross-validation: with cells (outer fold, inner fold),
"all rows but outer fold f and inner fold g" is the sum of the cells left. The
same holds for the Gramian of the degree-2 terms of the polynomial ridge, and, by
:mod:`tessera.operators.quantiles`, for the quartiles of robust scaling, which is a
change of coordinates of a Gramian.

Partial Gramians are numpy products of Arrow batches, one set per task and at
most four tasks a core, summed by a grouped aggregation; the driver gets
cells x features² numbers, whatever the rows. Columns are shifted and scaled by
their global mean and deviation first, so that sums of squares keep their digits.

Ridge is solved on the Gramian. Lasso and elastic net are Spark's
``LinearRegression`` on a handful of rows that have the part's very means and
covariances (``mean ± sqrt(r) · column j`` of the covariance's square root), which
is all that its normal-equation solver reads of a table. A search over α, whose fits
are many and are scored only, solves lasso on the driver (:func:`penalised`).
"""

from __future__ import annotations

import functools
import itertools
import threading
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tessera.operators.quantiles import cell_quantiles
from tessera.operators.stats import collect_agg
from tessera.runtime import FIT_SLOTS

QUARTILES = (.25, .5, .75)
DENSE_TERMS = 1500      # terms of a polynomial ridge that is solved on its Gramian
SOLVING = threading.Lock()  # one polynomial ridge is solved at a time, whatever fits run side by side


def matrix(batch: pa.RecordBatch, start: int) -> np.ndarray:
    """Columns of a batch from ``start`` on, as floats; nulls become NaN."""
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(start, batch.num_columns)])


def summed(rows: DataFrame, partial, size: int) -> dict[int, np.ndarray]:
    """``{cell: size x size matrix}``: the sums of what ``partial(batch)`` yields
    as ``(cell, symmetric matrix)`` over all batches.

    Upper triangles are summed, and the driver reads them as Arrow arrays: as rows of Python
    numbers they took it four times the matrices' memory, for every bank gathered at once."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, m in partial(batch):
                total[cell] = total.get(cell, 0) + m
        for cell, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, cell, np.int32)), pa.array(np.arange(size, dtype=np.int32)),
                                              pa.array([m[i, i:] for i in range(size)], pa.list_(pa.float64()))], ["cell", "i", "row"])

    few = rows.coalesce(4 * rows.sparkSession.sparkContext.defaultParallelism)
    parts = few.mapInArrow(run, "cell int, i int, row array<double>")
    # the rows of equal place are added up as arrays, without a column per place
    zeros = F.array_repeat(F.lit(0.0), F.lit(size) - F.col("i"))
    added = parts.groupBy("cell", "i").agg(F.collect_list("row").alias("rows")).select(
        "cell", "i", F.aggregate("rows", zeros, lambda a, r: F.zip_with(a, r, lambda x, y: x + y)).alias("row"))
    out: dict[int, np.ndarray] = {}

    def place(cell: int, i: int, row: np.ndarray) -> None:
        m = out.setdefault(cell, np.zeros((size, size)))
        m[i, i:] = m[i:, i] = row

    if size > 4096:
        for r in added.toLocalIterator():
            place(r["cell"], r["i"], r["row"])
        return out
    for batch in added.toArrow().to_batches():
        cells, at, lists = (batch.column(k) for k in range(3))
        ends, numbers = lists.offsets.to_numpy(), lists.values.to_numpy()
        for k, (cell, i) in enumerate(zip(cells.to_pylist(), at.to_pylist())):
            place(cell, i, numbers[ends[k]:ends[k + 1]])
    return out


def centred(g: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(n, means, centred sums of products) from a Gramian with a leading one."""
    n, s = g[0, 0], g[0, 1:]
    return n, s / n, g[1:, 1:] - np.outer(s, s) / n


@dataclass
class FittedLinear:
    """``intercept + Σ coef·x`` in the features' own units."""

    features: list[str]
    coef: np.ndarray
    intercept: float

    @property
    def model(self) -> "FittedLinear":
        return self

    @property
    def coefficients(self) -> DenseVector:
        return Vectors.dense(self.coef)

    def expression(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.coef):
            if w:
                out = out + F.col(c).cast("double") * F.lit(float(w))
        return out

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.expression())

    @classmethod
    def mean(cls, fits: list["FittedLinear"]) -> "FittedLinear":
        """The model that predicts the mean of ``fits``."""
        return cls(fits[0].features, np.mean([f.coef for f in fits], axis=0), float(np.mean([f.intercept for f in fits])))


@dataclass
class FittedPoly:
    """The fitted quadratic form ``b + x·l + xᵀQx``."""

    features: list[str]
    b: float
    l: np.ndarray
    q: np.ndarray

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        b, l, q = self.b, self.l, self.q

        @F.pandas_udf(DoubleType())
        def score(x: pd.Series) -> pd.Series:
            m = np.vstack(x.to_numpy()).astype(float) if len(x) else np.zeros((0, len(l)))
            return pd.Series(b + m @ l + ((m @ q) * m).sum(axis=1))

        return df.withColumn(out, score(F.array(*[F.col(c).cast("double") for c in self.features])))

    @classmethod
    def mean(cls, fits: list["FittedPoly"]) -> "FittedPoly":
        """The model that predicts the mean of ``fits``: forms add up, so one
        pass over the rows does for all of them."""
        return cls(fits[0].features, float(np.mean([f.b for f in fits])),
                   np.mean([f.l for f in fits], axis=0), np.mean([f.q for f in fits], axis=0))


def _pairs(p: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(p)


def _computed_once(method):
    @functools.wraps(method)
    def run(self, *args):
        with self._once:
            return method(self, *args)
    return run


class Bank:
    """Moments and quartiles of every training part over shared folds.

    ``dims`` names the partitions of the rows: ``{name: (fold column, folds)}``;
    a cell is one fold of each. A part is given by the folds it leaves out,
    ``{name: fold}``. Everything is computed on first use, in a fixed number of
    passes over ``df``: one for means and deviations, one for Gramians, one for
    polynomial Gramians, and those of :func:`cell_quantiles` for the quartiles
    of ``scaled`` parts. NULL or NaN in a feature or label is an error.
    """

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, dims: Mapping[str, tuple[Column, int]],
                 scaled: Sequence[Mapping[str, int]] = ({},)):
        self.features, self.label = list(features), label
        self.names, self.sizes = list(dims), [k for _, k in dims.values()]
        cell = F.lit(0)
        for column, k in dims.values():
            cell = cell * k + column.cast("int")
        self.rows = df.select(cell.cast("int").alias("__cell"), *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(self.features)],
                              F.col(f"`{label}`").cast("double").alias("y"))
        self.cells = list(itertools.product(*[range(k) for k in self.sizes]))
        self.parts = [dict(p) for p in scaled]
        self._units = self._grams = self._quartiles = self._terms = None
        self._loo: dict = {}
        self._once = threading.RLock()      # members ask from threads of their own

    def cells_of(self, part: Mapping[str, int], held: Mapping[str, int] | None = None) -> list[int]:
        """Cells outside the part's folds; with ``held``, only those inside its."""
        out, inside = ([(self.names.index(name), fold) for name, fold in p.items()] for p in (part, held or {}))
        return [n for n, cell in enumerate(self.cells) if all(cell[i] != f for i, f in out) and all(cell[i] == f for i, f in inside)]

    def _at(self, features: Sequence[str]) -> np.ndarray:
        return np.array([self.features.index(f) for f in features], dtype=int)

    @_computed_once
    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """(shift, scale) of every feature and the label."""
        if self._units is None:
            names = self.rows.columns[1:]
            of = {"mean": F.avg, "square": lambda c: F.avg(F.col(c) * F.col(c))}
            r = collect_agg(self.rows, {(f, c): of[f](c) for c in names for f in of}, 30)
            mean, square = (np.array([np.nan if r[f, c] is None else r[f, c] for c in names], dtype=float) for f in of)
            with np.errstate(invalid="ignore", over="ignore"):
                var = square - mean * mean
            dev = np.sqrt(np.where(var > 0, var, 0.0))
            # where the difference has no digits left, or a square none at all, the deviation itself is asked for
            unsure = [c for c, m, q, v in zip(names, mean, square, var) if np.isfinite(m) and not (np.isfinite(q) and v > 1e-6 * q)]
            if unsure:
                again = collect_agg(self.rows, {c: F.stddev_pop(c) for c in unsure})
                dev[[names.index(c) for c in unsure]] = [np.nan if again[c] is None else again[c] for c in unsure]
            self._units = np.nan_to_num(mean), np.where(np.isfinite(dev) & (dev > 0), dev, 1.0)
        return self._units

    def _standard(self):
        shift, scale = self.units()

        def run(batch):
            z = (matrix(batch, 1) - shift) / scale
            if not np.isfinite(z).all():
                raise ValueError("a feature or the label is null or not finite")
            return batch.column(0).to_numpy(zero_copy_only=False), z
        return run

    @_computed_once
    def grams(self) -> np.ndarray:
        """(cells, p + 2, p + 2): Gramians of ``[1, x, y]`` in standard units."""
        if self._grams is None:
            standard, size = self._standard(), len(self.features) + 2

            def partial(batch):
                cell, z = standard(batch)
                a = np.column_stack([np.ones(len(z)), z])
                for c in np.unique(cell):
                    m = a[cell == c]
                    yield int(c), m.T @ m
            found = summed(self.rows, partial, size)
            self._grams = np.stack([found.get(c, np.zeros((size, size))) for c in range(len(self.cells))])
        return self._grams

    def gram(self, part: Mapping[str, int], features: Sequence[str], held: Mapping[str, int] | None = None) -> np.ndarray:
        """Gramian of ``[1, x, y]`` of a part, in the columns' own units."""
        shift, scale = self.units()
        pick = np.concatenate([[0], 1 + self._at(features), [len(self.features) + 1]])
        g = self.grams()[self.cells_of(part, held)].sum(axis=0)[np.ix_(pick, pick)]
        t = np.diag(np.concatenate([[1.0], scale[pick[1:] - 1]]))
        t[1:, 0] = shift[pick[1:] - 1]
        return t @ g @ t.T

    @_computed_once
    def quartiles(self, part: Mapping[str, int]) -> dict[str, list[float]]:
        if self._quartiles is None:
            used = [n for n in self.names if any(n in p for p in self.parts)]
            # cells of the dimensions that scaled parts leave folds out of
            cell, strides = F.lit(0), []
            place = F.col("__cell")
            for n, k in reversed(list(zip(self.names, self.sizes))):
                strides.append((n, place % k))
                place = F.floor(place / k)
            by = dict(strides)
            sizes = [self.sizes[self.names.index(n)] for n in used]
            for n, k in zip(used, sizes):
                cell = cell * k + by[n]
            cells = list(itertools.product(*[range(k) for k in sizes]))
            parts = {n: [c for c, at in enumerate(cells) if all(at[used.index(d)] != f for d, f in p.items())] for n, p in enumerate(self.parts)}
            found = cell_quantiles(self.rows, [f"x{i}" for i in range(len(self.features))], QUARTILES, cell, parts)
            self._quartiles = {tuple(sorted(p.items())): {self.features[int(c[1:])]: q for c, q in found[n].items()}
                               for n, p in enumerate(self.parts)}
        return self._quartiles[tuple(sorted(part.items()))]

    def spread(self, part: Mapping[str, int], features: Sequence[str]) -> np.ndarray:
        """Quartile distances; a zero one, or one of no values, counts as 1."""
        q = self.quartiles(part)
        return np.array([(q[f][2] - q[f][0]) or 1.0 if f in q else 1.0 for f in features])

    # --- fits -----------------------------------------------------------------

    def linear(self, part: Mapping[str, int], features: Sequence[str], kind: str, alpha: float, l1_ratio: float = 1.0,
               spread: np.ndarray | None = None) -> FittedLinear:
        """Ridge, lasso or elastic net on the rows of a part; ``spread`` divides
        the features before the penalty."""
        return linear_from_gram(self.rows, self.gram(part, features), list(features), kind, alpha, l1_ratio, spread)

    @_computed_once
    def loo(self, features: tuple, alphas: tuple, part: Mapping[str, int]) -> np.ndarray:
        """Leave-one-out errors of a part; those of all scaled parts come from
        the same pass."""
        if (features, alphas) not in self._loo:
            errors = ridge_loo(self.rows, self, features, alphas, self.parts)
            self._loo[features, alphas] = {tuple(sorted(p.items())): e for p, e in zip(self.parts, errors)}
        return self._loo[features, alphas][tuple(sorted(part.items()))]

    @_computed_once
    def terms(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Per cell, the upper triangle of the (d + 1, d + 1) Gramian of
        ``[1, x, x_i·x_j (i <= j), y]``, and the columns' scales they are divided by."""
        if self._terms is None:
            p, (shift, scale) = len(self.features), self.units()
            i, j = _pairs(p)
            # sizes of the raw terms, for equal digits only
            size = np.maximum(np.abs(shift), scale)
            unit = np.concatenate([[1.0], size[:p], size[i] * size[j], [size[p]]])

            def partial(batch):
                cell, x = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch, 1)
                if not np.isfinite(x).all():
                    raise ValueError("a feature or the label is null or not finite")
                for at in range(0, len(x), 2048):
                    c, m = cell[at:at + 2048], x[at:at + 2048]
                    a = np.column_stack([np.ones(len(m)), m[:, :p], m[:, i] * m[:, j], m[:, p]]) / unit
                    for k in np.unique(c):
                        b = a[c == k]
                        yield int(k), b.T @ b
            found = summed(self.rows, partial, len(unit))
            upper = _pairs(len(unit))
            self._terms = [found.pop(c)[upper] if c in found else np.zeros(len(upper[0])) for c in range(len(self.cells))], unit
            pa.default_memory_pool().release_unused()
        return self._terms

    def poly(self, part: Mapping[str, int], features: Sequence[str], alpha: float, coef0: float, gamma: float | None) -> FittedPoly:
        """Polynomial ridge on the rows of a part, solved on its terms' Gramian."""
        at, p = self._at(features), len(self.features)
        i, j = _pairs(p)
        place = {(a, b): 1 + p + k for k, (a, b) in enumerate(zip(i.tolist(), j.tolist()))}
        q = len(at)
        qi, qj = _pairs(q)
        chosen = [place[min(at[a], at[b]), max(at[a], at[b])] for a, b in zip(qi, qj)]
        grams, unit = self.terms()
        pick = np.concatenate([[0], 1 + at, chosen, [len(unit) - 1]]).astype(int)
        gamma = 1.0 / q if gamma is None else gamma
        # kernel coordinates of the terms, over the unit they are divided by
        kernel = np.concatenate([[coef0], np.full(q, np.sqrt(2 * gamma * coef0)), np.where(qi == qj, gamma, np.sqrt(2) * gamma)])
        s = kernel * unit[pick[:-1]]
        d = len(s)
        with SOLVING:
            # cells are added up one by one: a copy of all of them is as large as the bank
            total = np.zeros(len(grams[0]))
            for cell in self.cells_of(part):
                total += grams[cell]
            g = np.zeros((len(unit),) * 2)
            g[_pairs(len(unit))] = total
            g = g[np.minimum.outer(pick, pick), np.maximum.outer(pick, pick)]
            m = g[:d, :d] * np.outer(s, s) + alpha * np.eye(d)
            even = 1 / np.sqrt(np.diag(m))
            w = even * np.linalg.solve(m * np.outer(even, even), even * s * g[:d, d] * unit[-1])
        w = kernel * w
        form = np.zeros((q, q))
        form[qi, qj] = w[1 + q:]
        return FittedPoly(list(features), float(w[0]), w[1:1 + q], form)


def _moment_rows(df: DataFrame, cov: np.ndarray) -> DataFrame:
    """A few rows ``(features, label)`` with mean zero and covariance ``cov``."""
    values, axes = np.linalg.eigh(cov)
    keep = values > values.max(initial=0) * 1e-14
    root = axes[:, keep] * np.sqrt(values[keep] * keep.sum())
    rows = [(Vectors.dense(sign * c[:-1]), float(sign * c[-1])) for c in root.T for sign in (1, -1)]
    spark = df.sparkSession
    return spark.createDataFrame(rows or [(Vectors.dense(np.zeros(len(cov) - 1)), 0.0)], ["features", "label"]).coalesce(1)


def linear_from_gram(df: DataFrame, gram: np.ndarray, features: list[str], kind: str, alpha: float, l1_ratio: float = 1.0,
                     spread: np.ndarray | None = None) -> FittedLinear:
    return linear_path(df, gram, features, kind, [alpha], l1_ratio, spread)[0]


def linear_path(df: DataFrame, gram: np.ndarray, features: list[str], kind: str, alphas: Sequence[float], l1_ratio: float = 1.0,
                spread: np.ndarray | None = None) -> list[FittedLinear]:
    """Linear fits for several α from one ``[1, x, y]`` Gramian (``df`` only gives
    the session)."""
    from tessera.operators.models import linear_params
    p = len(features)
    spread = np.ones(p) if spread is None else spread
    n, mean, s = centred(gram)
    d = np.concatenate([1 / spread, [1.0]])
    s = s * np.outer(d, d)
    ws = []
    s_y = float(np.sqrt(max(s[p, p] / n, 0.0)))
    rows = None if kind == "ridge" or s_y == 0 else _moment_rows(df, s / n)
    for alpha in alphas:
        if kind == "ridge":
            ws.append(np.linalg.solve(s[:p, :p] + alpha * np.eye(p), s[:p, p]) if alpha else np.linalg.lstsq(s[:p, :p], s[:p, p], rcond=None)[0])
        elif rows is None:
            ws.append(np.zeros(p))
        else:
            reg, en = linear_params(kind, alpha, int(n), s_y, l1_ratio)
            est = LinearRegression(regParam=reg, elasticNetParam=en, standardization=False, solver="normal", maxIter=500, tol=1e-10)
            with FIT_SLOTS.take():
                ws.append(est.fit(rows).coefficients.toArray())
    return [FittedLinear(features, w / spread, float(mean[p] - mean[:p] @ (w / spread))) for w in ws]


def penalised(a: np.ndarray, b: np.ndarray, l1: float, l2: float, most: int = 10_000) -> np.ndarray:
    """The ``w`` that minimises ``½·wᵀaw − bᵀw + l1·Σ|w| + ½·l2·Σw²``; features without
    variance get 0.

    A sweep over the coordinates lets features in and out, then the fit is moved to the
    exact optimum of its features and their signs, a feature whose sign would turn
    leaving on the way. No step raises the error, and no set of features and signs
    comes twice, so it ends at the optimum, not at a tolerance."""
    live = np.flatnonzero(a.diagonal() > 0)
    # of features that add up to others, one of many equal fits is taken
    a = a + (l2 + 1e-10 * a.diagonal().max(initial=0)) * np.eye(len(b))
    w, edge = np.zeros(len(b)), 1e-10 * max(float(np.abs(b).max(initial=0)), l1)
    for _ in range(most):
        rest = b - a @ w
        for j in live:
            pull = rest[j] + a[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / a[j, j]
            if new != w[j]:
                rest -= a[:, j] * (new - w[j])
                w[j] = new
        while (on := np.flatnonzero(w)).size:
            try:
                best = np.linalg.solve(a[np.ix_(on, on)], b[on] - l1 * np.sign(w[on]))
            except np.linalg.LinAlgError:
                break       # equal features: the sweeps go on
            turns = best * w[on] <= 0
            if not turns.any():
                w[on] = best
                break
            way = np.where(turns, w[on] / np.where(turns, w[on] - best, 1.0), np.inf)
            w[on] = np.where(way == way.min(), 0.0, w[on] + way.min() * (best - w[on]))
        rest = b - a @ w
        if (np.abs(rest - l1 * np.sign(w))[w != 0] <= edge).all() and (np.abs(rest[live]) <= l1 + edge).all():
            return w
    warnings.warn(f"lasso not settled in {most} sweeps", RuntimeWarning)
    return w


def scored_path(df: DataFrame, gram: np.ndarray, features: list[str], kind: str, alphas: Sequence[float],
                spread: np.ndarray | None = None) -> list[FittedLinear]:
    """:func:`linear_path` for a search over α: lasso takes milliseconds, not a Spark job a fit."""
    if kind != "lasso" or 0 in alphas:
        return linear_path(df, gram, features, kind, alphas, 1.0, spread)
    p = len(features)
    spread = np.ones(p) if spread is None else spread
    n, mean, s = centred(gram)
    d = np.concatenate([1 / spread, [1.0]])
    s = s * np.outer(d, d) / n
    ws = [penalised(s[:p, :p], s[:p, p], float(alpha), 0.0) / spread for alpha in alphas]
    return [FittedLinear(features, w, float(mean[p] - mean[:p] @ w)) for w in ws]


# --- leave-one-out ridge (M4) ---------------------------------------------------

def ridge_loo(df: DataFrame, bank: Bank, features: Sequence[str], alphas: Sequence[float], parts: Sequence[Mapping[str, int]] = ({},),
              scale: bool = True) -> list[np.ndarray]:
    """Leave-one-out squared error of every α, per part, in one pass over the rows.

    The residual of a row left out is its residual over ``1 − h``, with the
    leverage ``h = 1/n + x_cᵀ(S + αI)⁻¹x_c`` of the ridge with a free intercept; on
    the axes of S both are sums of squares, so all α share one rotation.
    """
    plans = []
    for part in parts:
        n, mean, s = centred(bank.gram(part, features))
        spread = bank.spread(part, features) if scale else np.ones(len(features))
        d = np.concatenate([1 / spread, [1.0]])
        s = s * np.outer(d, d)
        values, axes = np.linalg.eigh(s[:-1, :-1])
        inverse = 1 / (np.maximum(values, 0)[:, None] + np.asarray(alphas, dtype=float)[None])
        plans.append((set(bank.cells_of(part)), n, mean, axes / spread[:, None], (axes.T @ s[:-1, -1])[:, None] * inverse, inverse))
    pick = np.concatenate([bank._at(features), [len(bank.features)]])

    def run(batches):
        total = np.zeros((len(plans), len(alphas)))
        for batch in batches:
            cell, x = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch, 1)[:, pick]
            for k, (cells, n, mean, turn, weight, inverse) in enumerate(plans):
                m = x[np.isin(cell, list(cells))] - mean
                t = m[:, :-1] @ turn
                left = 1 - 1 / n - (t * t) @ inverse
                total[k] += (((m[:, -1][:, None] - t @ weight) / left) ** 2).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(plans)), len(alphas)).astype(np.int32)),
                                          pa.array(np.tile(np.arange(len(alphas)), len(plans)).astype(np.int32)), pa.array(total.ravel())],
                                         ["part", "alpha", "sse"])
    sums = bank.rows.mapInArrow(run, "part int, alpha int, sse double").groupBy("part", "alpha").agg(F.sum("sse").alias("sse")).collect()
    out = [np.zeros(len(alphas)) for _ in plans]
    for r in sums:
        out[r["part"]][r["alpha"]] = r["sse"] / plans[r["part"]][1]
    return out
