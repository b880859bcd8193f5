"""Polynomial ridge of many features, matrix-free (M6).

The degree-2 kernel ridge predicts a quadratic form ``A + L·x + xᵀQx`` and
penalises ``(A/c0)² + |L|²/(2γ·c0) + ‖Q‖²/γ²``. Its normal equations have
p²/2 unknowns, so their matrix would have p⁴/4 entries; but the product of that
matrix with a form needs one pass only: the form's value at every row, and the
Gramian of ``[1, x]`` weighted by those values. Conjugate gradients ask for nothing
else. Each step is one Spark job that sums a (p+1)×(p+1) matrix for every training
part at once; the driver holds a few such matrices per part.

The iteration runs in standardised features (the penalty is carried over by its
exact change of coordinates) and is preconditioned by the diagonal.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

import numpy as np

from tessera.operators.moments import Bank, FittedPoly, matrix, summed


class _Penalty:
    """The penalty of a form given in standardised features: a change of
    coordinates to the features' own units, and its transpose."""

    def __init__(self, alpha: float, coef0: float, gamma: float, mean: np.ndarray, scale: np.ndarray):
        self.alpha, self.c, self.g, self.mean, self.d = alpha, coef0, gamma, mean, 1 / scale

    def raw(self, u: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        a, v, m = u[0, 0], u[0, 1:], u[1:, 1:]
        q = m * np.outer(self.d, self.d)
        return a - self.mean @ (self.d * v) + self.mean @ q @ self.mean, self.d * v - 2 * q @ self.mean, q

    def times(self, u: np.ndarray) -> np.ndarray:
        a, l, q = self.raw(u)
        ga, gl, gq = a / self.c ** 2, l / (2 * self.g * self.c), q / self.g ** 2
        out = np.zeros_like(u)
        out[0, 0] = ga
        out[0, 1:] = self.d * (gl - ga * self.mean)
        cross = np.outer(gl, self.mean)
        out[1:, 1:] = (gq + ga * np.outer(self.mean, self.mean) - cross - cross.T) * np.outer(self.d, self.d)
        return self.alpha * out

    def diagonal(self) -> np.ndarray:
        m2, d2 = self.mean ** 2, self.d ** 2
        off = 1 / self.g ** 2 + (m2[:, None] + m2[None]) / (self.g * self.c) + 2 * np.outer(m2, m2) / self.c ** 2
        np.fill_diagonal(off, 1 / self.g ** 2 + 4 * m2 / (2 * self.g * self.c) + m2 ** 2 / self.c ** 2)
        out = np.zeros((len(m2) + 1,) * 2)
        out[0, 0] = 1 / self.c ** 2
        out[0, 1:] = d2 * (1 / (2 * self.g * self.c) + m2 / self.c ** 2)
        out[1:, 1:] = off * np.outer(d2, d2)
        return self.alpha * out


def _inner(a: np.ndarray, b: np.ndarray) -> float:
    """Product of two forms, kept as [[a, v], [0, M]] with symmetric M."""
    return float((a * b).sum())


def fit_quadratic(bank: Bank, features: Sequence[str], parts: Sequence[Mapping[str, int]], alpha: float, coef0: float,
                  gamma: float | None, tol: float = 1e-10, most: int = 500) -> list[FittedPoly]:
    """The fitted form of every part. Stops where the residual of the normal
    equations, in the preconditioner's norm, has fallen by ``tol``; where ``most``
    steps do not get there (badly scaled features, fewer rows than terms), the
    form reached is returned and a warning says how far it got."""
    at, p = bank._at(features), len(features)
    gamma = 1.0 / p if gamma is None else gamma
    shift, scale = bank.units()
    mean, scale, y_scale = shift[at], scale[at], max(abs(shift[-1]), scale[-1])
    cells = [np.array(sorted(bank.cells_of(part))) for part in parts]
    penalty = _Penalty(alpha, coef0, gamma, mean, scale)
    rows = bank.rows.persist()

    def weighted(value) -> list[np.ndarray]:
        """Σ w·[1, z]ᵀ[1, z] per part, with ``w = value(part, z, y)``."""
        def partial(batch):
            cell, x = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch, 1)
            if not np.isfinite(x).all():
                raise ValueError("a feature or the label is null or not finite")
            z, y = (x[:, at] - mean) / scale, x[:, -1] / y_scale
            for k, inside in enumerate(cells):
                keep = np.isin(cell, inside)
                if keep.any():
                    w, one = value(k, z[keep], y[keep]), np.column_stack([np.ones(keep.sum()), z[keep]])
                    yield k, one.T @ (one * w[:, None])
        found = summed(rows, partial, p + 1)
        return [found.get(k, np.zeros((p + 1, p + 1))) for k in range(len(parts))]

    def form(g: np.ndarray) -> np.ndarray:
        """A weighted Gramian as a form: linear sums stand in its first row."""
        out = g.copy()
        out[1:, 0] = 0
        return out

    def times(us: list[np.ndarray]) -> list[np.ndarray]:
        def value(k, z, y):
            u = us[k]
            return u[0, 0] + z @ u[0, 1:] + np.einsum("ij,ij->i", z @ u[1:, 1:], z)
        return [form(g) + penalty.times(u) for g, u in zip(weighted(value), us)]

    def fourth(batch):
        cell, x = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch, 1)
        z = (x[:, at] - mean) / scale
        for k, inside in enumerate(cells):
            one = np.column_stack([np.ones(np.isin(cell, inside).sum()), z[np.isin(cell, inside)] ** 2])
            yield k, one.T @ one

    try:
        rest = [form(g) for g in weighted(lambda k, z, y: y)]
        squares = summed(rows, fourth, p + 1)
        inverse = []
        for k in range(len(parts)):
            d = form(squares.get(k, np.zeros((p + 1, p + 1))))
            d[1:, 1:] *= 2 - np.eye(p)
            d = d + penalty.diagonal()
            inverse.append(np.where(d > 0, 1 / np.where(d > 0, d, 1), 0.0))
        us = [np.zeros_like(r) for r in rest]
        zs = [i * r for i, r in zip(inverse, rest)]
        way = [z.copy() for z in zs]
        size = [_inner(r, z) for r, z in zip(rest, zs)]
        goal = [tol ** 2 * s for s in size]
        for _ in range(most):
            if all(s <= g for s, g in zip(size, goal)):
                break
            for k, h in enumerate(times(way)):
                if size[k] <= goal[k]:
                    continue
                step = size[k] / _inner(way[k], h)
                us[k] = us[k] + step * way[k]
                rest[k] = rest[k] - step * h
                z = inverse[k] * rest[k]
                new = _inner(rest[k], z)
                way[k], size[k] = z + new / size[k] * way[k], new
        for k, (s, g) in enumerate(zip(size, goal)):
            if s > g:
                warnings.warn(f"part {parts[k]}: residual fell by {np.sqrt(s / g) * tol:.1e} only in {most} steps", RuntimeWarning)
    finally:
        rows.unpersist()
    out = []
    for u in us:
        a, l, q = penalty.raw(u)
        out.append(FittedPoly(list(features), float(a) * y_scale, l * y_scale, q * y_scale))
    return out
