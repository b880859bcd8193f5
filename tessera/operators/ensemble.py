"""Stacking, seed averaging and blending.

The out-of-fold table is a union over the folds: each held-out row is scored
by all members where it stands, so nothing is shuffled. It is staged to Parquet
under the checkpoint folder, so later fits never recompute the fold loop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.evaluate import assign_folds, fold_column
from tessera.operators.models import Fitted, PolyRidge, Regressor, Trees, vector_name, with_vector
from tessera.operators.moments import Bank
from tessera.runtime import fit_in_slot, fit_table, side_by_side, stage


def normalised_weights(weights: Mapping[str, float]) -> dict[str, float]:
    """w / Σw; a zero sum is refused."""
    total = float(sum(weights.values()))
    if total == 0:
        raise ValueError("blend weights sum to zero")
    return {k: float(v) / total for k, v in weights.items()}


def blend(weights: Mapping[str, float]) -> Column:
    """Weighted sum of prediction columns in log space (E5)."""
    w = normalised_weights(weights)
    out = None
    for c, v in w.items():
        term = F.col(c) * F.lit(v)
        out = term if out is None else out + term
    return out


def average(cols: Sequence[str]) -> Column:
    out = F.col(cols[0])
    for c in cols[1:]:
        out = out + F.col(c)
    return out / F.lit(float(len(cols)))


def prepare(bank: Bank, members: Sequence[Regressor]) -> None:
    """What the members read of a bank, before threads ask for it."""
    jobs = []
    if any(not isinstance(m, PolyRidge) for m in members):
        jobs.append(lambda: (bank.grams(), bank.quartiles(bank.parts[0])))
    if any(isinstance(m, PolyRidge) and m.dense(len(bank.features)) for m in members):
        jobs.append(bank.terms)
    side_by_side(lambda job: job(), jobs)


@dataclass
class FittedStack:
    bases: list[Regressor]
    fold_models: dict[str, list[Fitted]]
    full_models: dict[str, Fitted] | None
    meta: Fitted
    features: list[str]
    keep_features: bool
    oof: DataFrame

    def base_predictions(self, df: DataFrame) -> DataFrame:
        """One column per base: mean of its k fold models (E1), or the
        full refit when the stack keeps features (E2)."""
        cur = df
        for b in self.bases:
            if self.full_models is not None:
                cur = self.full_models[b.name].predict(cur, b.name)
                continue
            models = self.fold_models[b.name]
            cur = with_vector(cur, self.features) if isinstance(b, Trees) else cur
            if hasattr(models[0], "mean"):
                cur = models[0].mean(models).predict(cur, b.name)
                continue
            cols = []
            for i, m in enumerate(models):
                col = f"__{b.name}_{i}"
                cur = m.predict(cur, col)
                cols.append(col)
            cur = cur.withColumn(b.name, average(cols)).drop(*cols)
        return cur if vector_name(self.features) in df.columns else cur.drop(vector_name(self.features))

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        with_bases = self.base_predictions(df)
        return self.meta.predict(with_bases, out).drop(*[b.name for b in self.bases])


@dataclass
class Stacking:
    """Stacked regression with fold-averaged base models (E1) or, with
    ``keep_features``, the original features passed to the meta model and
    bases refit on all rows (E2)."""

    bases: list[Regressor]
    meta: Regressor
    key: list[str]
    k: int = 5
    seed: int = 42
    keep_features: bool = False
    fold_weights: Sequence[int] | None = None
    name: str = "stack"

    def bank(self, df: DataFrame, features: list[str], label: str, dims: dict | None = None, outer: Sequence[dict] = ({},)) -> Bank:
        """Moments and quartiles of every training part of this stack: of all
        rows of ``outer`` parts, and of those without one of the stack's folds."""
        fold = fold_column(self.key, self.k, self.seed, self.fold_weights)
        dims = {**(dims or {}), "fold": (fold, self.k)}
        for b in self.bases:
            dims |= b.dims(features, label) if hasattr(b, "dims") else {}
        parts = [{**o, **f} for o in outer for f in ({}, *[{"fold": f} for f in range(self.k)])]
        return Bank(df, features, label, dims, parts)

    def fit(self, df: DataFrame, features: list[str], label: str, bank: Bank | None = None, part: dict | None = None) -> FittedStack:
        """``bank``: moments of a larger table, of which ``df`` is ``part``."""
        trees = any(isinstance(b, Trees) for b in self.bases)
        folded = assign_folds(df.select(*self.key, label, *features), self.key, self.k,
                              self.seed, self.fold_weights)
        folded, rows = fit_table(with_vector(folded, features) if trees else folded, features)
        part = part or {}
        bank = bank or self.bank(folded, features, label)
        # long fits (tree ensembles: many small jobs each) go first, so they
        # do not start last and leave the pool idle behind them
        jobs = sorted(((b, f) for b in self.bases for f in range(self.k)),
                      key=lambda j: 0 if getattr(j[0], "kind", None) in ("gbt", "forest") else 1)
        # label (and features for E2) ride along with the key
        carry = [*self.key, label, *(features if self.keep_features else [])]

        def one(job):
            b, f = job
            if hasattr(b, "fit_bank"):
                return b.name, f, b.fit_bank(bank, features, {**part, "fold": f})
            if getattr(b, "stop_on_held_out", False):
                flagged = folded.withColumn("__held", F.col("fold") == f)
                return b.name, f, fit_in_slot(replace(b, early_stop_col="__held"), flagged, features, label, rows)
            return b.name, f, fit_in_slot(b, folded.filter(F.col("fold") != f), features, label, rows)

        try:
            prepare(bank, [b for b in self.bases if hasattr(b, "fit_bank")])
            return self._stack(side_by_side(one, jobs), folded, rows, carry, features, label, bank, part)
        finally:
            folded.unpersist()

    def _stack(self, results, folded: DataFrame, rows: int, carry: list[str], features: list[str], label: str, bank: Bank, part: dict) -> FittedStack:
        fold_models: dict[str, list] = {b.name: [None] * self.k for b in self.bases}
        for name, f, fitted in results:
            fold_models[name][f] = fitted
        names = [b.name for b in self.bases]
        # each held-out row is scored by all members where it stands: rows
        # with equal keys stay apart and nothing is shuffled
        oof = None
        for f in range(self.k):
            held = folded.filter(F.col("fold") == f)
            for name in names:
                held = fold_models[name][f].predict(held, name)
            held = held.select(*carry, *names)
            oof = held if oof is None else oof.unionByName(held)
        oof = stage(oof, f"{self.name}-oof-seed{self.seed}")
        meta_in = oof
        meta_feats = names + (features if self.keep_features else [])
        meta = fit_in_slot(self.meta, meta_in, meta_feats, label, rows)
        full = None
        if self.keep_features:
            fits = side_by_side(lambda b: b.fit_bank(bank, features, part) if hasattr(b, "fit_bank")
                                else fit_in_slot(b, folded, features, label, rows), self.bases)
            full = {b.name: m for b, m in zip(self.bases, fits)}
        return FittedStack(self.bases, fold_models, full, meta, features,
                           self.keep_features, oof)


@dataclass
class SeedAverage:
    """Whole stack per seed, predictions averaged."""

    make_stack: object            # seed -> Stacking
    seeds: Sequence[int] = (42, 123, 456)
    fitted: list[FittedStack] = field(default_factory=list)

    def fit(self, df: DataFrame, features: list[str], label: str, banks: Mapping[int, Bank] | None = None,
            part: dict | None = None) -> "SeedAverage":
        # whole stacks per seed are independent jobs: run them side by side
        self.fitted = side_by_side(lambda s: self.make_stack(s).fit(df, features, label, (banks or {}).get(s), part), self.seeds)
        return self

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        cur = df
        cols = []
        for s, m in zip(self.seeds, self.fitted):
            col = f"__seed_{s}"
            cur = m.predict(cur, col)
            cols.append(col)
        return cur.withColumn(out, average(cols)).drop(*cols)
