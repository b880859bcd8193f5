"""Product-quantisation codes of vectors by cover-tree Lloyd.

Vectors become integers and are cut into parts; each part position has its own
small codebook, refined by Lloyd rounds. A chunk of rows builds, once, a
cover tree for each part position: a node covers its subtree within a radius that
halves from level to level, its children are further than that from each other,
and its points stand next to each other, so cumulative sums give count and sum
of any subtree. A round walks the tree: if, by the triangle inequality, no
entry but one can be nearest to any point of a subtree, the whole subtree goes to
it by its sums; only ambiguous nodes descend, with the entries still possible,
and single points compare exactly in integers.

Scale. The chunks' trees are written once and read in each round; a task holds
the trees of one chunk (``chunk`` rows at most) at a time. A round returns a sum and
a count for each entry and task, which Spark adds up; the driver holds only the
codebooks (parts x entries x width integers). Equal parts in a chunk are one point
with a weight. Nothing is sampled: every row counts in every round.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, small, staged

SCALE = 4096
LARGEST = 1 << 26    # larger integers count as this, so that squares add up in 64 bits
SLACK = 1e-6         # of a distance, for rounding


def integers(vector: Column) -> Column:
    """Integer components, or null where a component is null or not finite.
    Components beyond ``LARGEST`` (16,384 before scaling) count as it."""
    plain = vector.cast("array<double>")
    fine = F.forall(plain, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(plain, lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int"))
    return F.when(F.coalesce(fine, F.lit(False)), whole)


class CoverTree:
    """Cover tree over distinct integer points with weights.

    ``order`` lists the points so that every subtree is a stretch; node k has
    centre ``centre[k]``, covers ``order[low[k]:high[k]]`` within ``radius[k]``
    and has the children ``child[k]`` to ``child[k + 1]``.
    """

    FIELDS = ("points", "weights", "order", "centre", "radius", "low", "high", "child")

    def __init__(self, **fields):
        for name in self.FIELDS:
            setattr(self, name, fields[name])
        w = self.weights[self.order]
        self.count = np.concatenate([[0], np.cumsum(w)])
        self.sums = np.vstack([np.zeros((1, self.points.shape[1]), dtype=np.int64),
                               np.cumsum(self.points[self.order] * w[:, None], axis=0)])

    @classmethod
    def build(cls, points: np.ndarray, weights: np.ndarray) -> "CoverTree":
        order = np.arange(len(points))
        far = points.astype(np.float64)

        def apart(rows, centre):
            d = far[rows] - far[centre]
            return np.sqrt(np.einsum("ij,ij->i", d, d))

        centre, radius, low, high, child = [0], [float(apart(order, 0).max())], [0], [len(order)], []
        k = 0
        while k < len(centre):
            child.append(len(centre))
            lo, hi = low[k], high[k]
            if radius[k] > 0:
                rows, reach = order[lo:hi], radius[k] / 2
                nearest, own = apart(rows, centre[k]), np.zeros(hi - lo, dtype=np.int64)
                nets = [centre[k]]            # the centre covers itself on
                while nearest.max() > reach:  # the farthest point is the next centre
                    new = int(rows[nearest.argmax()])
                    d = apart(rows, new)
                    closer = d < nearest
                    own[closer], nearest[closer] = len(nets), d[closer]
                    nets.append(new)
                by = np.argsort(own, kind="stable")
                order[lo:hi] = rows[by]
                ends = np.cumsum(np.bincount(own, minlength=len(nets)))
                widest = np.zeros(len(nets))
                np.maximum.at(widest, own, nearest)
                for c, r, a, b in zip(nets, widest.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                    centre.append(c)
                    radius.append(r)
                    low.append(lo + a)
                    high.append(lo + b)
            k += 1
        child.append(len(centre))
        return cls(points=points, weights=weights, order=order, centre=np.array(centre), radius=np.array(radius),
                   low=np.array(low), high=np.array(high), child=np.array(child))

    def stretches(self, book: np.ndarray):
        """Arrays ``(low, high, entry)`` that cover ``order`` once: the nearest
        entry of every point, ties to the lower index."""
        entries, out = book.astype(np.float64), []
        nodes, may = np.array([0]), np.ones((1, len(book)), dtype=bool)
        while len(nodes):
            at = self.points[self.centre[nodes]]
            d = np.sqrt(((at[:, None, :].astype(np.float64) - entries[None]) ** 2).sum(axis=2))
            d[~may] = np.inf
            # an entry further than the nearest by two radii is nowhere nearest
            may = d <= (d.min(axis=1) + 2 * self.radius[nodes])[:, None] * (1 + SLACK) + SLACK
            point = self.radius[nodes] == 0
            one = (may.sum(axis=1) == 1) & ~point
            entry = may.argmax(axis=1)
            if point.any():
                exact = ((at[point][:, None, :] - book[None]) ** 2).sum(axis=2)
                entry[point] = exact.argmin(axis=1)
            done = point | one
            out.append((self.low[nodes[done]], self.high[nodes[done]], entry[done]))
            nodes, may = nodes[~done], may[~done]
            times = self.child[nodes + 1] - self.child[nodes]
            first = np.repeat(self.child[nodes] - np.concatenate([[0], np.cumsum(times)[:-1]]), times)
            nodes, may = first + np.arange(times.sum()), np.repeat(may, times, axis=0)
        return tuple(np.concatenate(x) for x in zip(*out))

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, sum) of the points of each entry, by subtrees."""
        low, high, entry = self.stretches(book)
        count, total = np.zeros(len(book), dtype=np.int64), np.zeros(book.shape, dtype=np.int64)
        np.add.at(count, entry, self.count[high] - self.count[low])
        np.add.at(total, entry, self.sums[high] - self.sums[low])
        return count, total

    def assign(self, book: np.ndarray) -> np.ndarray:
        """Nearest entry of every point."""
        low, high, entry = self.stretches(book)
        by = np.argsort(low)
        out = np.empty(len(self.points), dtype=np.int64)
        out[self.order] = np.repeat(entry[by], (high - low)[by])
        return out

    def pack(self) -> dict:
        """Fields as bytes; integers fit 32 bits, as components do."""
        return {f: np.ascontiguousarray(getattr(self, f), dtype=_KIND.get(f, np.int32)).tobytes() for f in self.FIELDS}

    @classmethod
    def unpack(cls, row, part: int, width: int) -> "CoverTree":
        got = {f: np.frombuffer(row[f][part], _KIND.get(f, np.int32)) for f in cls.FIELDS}
        got = {f: v if f in _KIND else v.astype(np.int64) for f, v in got.items()}
        return cls(**got | {"points": got["points"].reshape(-1, width)})


_KIND = {"radius": np.float64}
_TREES = "rids binary, members array<binary>, " + ", ".join(f"{f} array<binary>" for f in CoverTree.FIELDS)


def _plant(parts: int, width: int, chunk: int):
    """A row for each chunk of rows: its cover trees, one per part position."""
    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), chunk):
                rows = pdf.iloc[at:at + chunk]
                whole = np.zeros((len(rows), parts * width), dtype=np.int64)
                for n, v in enumerate(rows["whole"]):
                    whole[n, :len(v)] = v
                trees = []
                for p in range(parts):
                    points, member, weights = np.unique(whole[:, p * width:(p + 1) * width], axis=0, return_inverse=True, return_counts=True)
                    trees.append(CoverTree.build(points, weights).pack() | {"members": member.ravel().astype(np.int32).tobytes()})
                yield pd.DataFrame([{"rids": rows["rid"].to_numpy(np.int64).tobytes()} | {f: [t[f] for t in trees] for f in trees[0]}])
    return run


def _sum_up(books: np.ndarray):
    parts, entries, width = books.shape

    def run(batches):
        count, total = np.zeros((parts, entries), dtype=np.int64), np.zeros(books.shape, dtype=np.int64)
        for pdf in batches:
            for r in pdf.to_dict("records"):
                for p in range(parts):
                    n, t = CoverTree.unpack(r, p, width).totals(books[p])
                    count[p] += n
                    total[p] += t
        part, entry = np.nonzero(count)
        yield pd.DataFrame({"part": part, "entry": entry, "n": count[part, entry], "total": list(total[part, entry])})
    return run


def _encode(books: np.ndarray):
    parts, _, width = books.shape

    def run(batches):
        for pdf in batches:
            for r in pdf.to_dict("records"):
                rids, codes, error = np.frombuffer(r["rids"], np.int64), [], 0
                for p in range(parts):
                    tree, member = CoverTree.unpack(r, p, width), np.frombuffer(r["members"][p], np.int32)
                    entry = tree.assign(books[p])
                    codes.append(entry[member])
                    error = error + ((tree.points - books[p][entry]) ** 2).sum(axis=1)[member]
                yield pd.DataFrame({"rid": rids, "codes": list(np.array(codes).T), "error": error})
    return run


def lloyd(trees: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks (part, entry, position) after the rounds."""
    width = books.shape[2]
    for _ in range(rounds):
        sums = trees.mapInPandas(_sum_up(books), "part int, entry int, n long, total array<long>").groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("total")[j]).alias(f"t{j}") for j in range(width)])
        new = books.copy()
        for r in sums.collect():     # parts x entries rows
            new[r["part"], r["entry"]] = [r[f"t{j}"] // r["n"] for j in range(width)]
        books = new
    return books


def quantise(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 8,
             entries: int = 16, rounds: int = 6, chunk: int = 2048) -> tuple[DataFrame, np.ndarray]:
    """(one row ``vec_id, label, codes, error, label_error`` per kept row, codebooks).

    ``codes`` is an array of entry numbers by part. Rows whose vector is null or
    holds null or non-finite components are left out. Shorter vectors (empty ones
    too) are filled with zeros to the longest one's length, and that to a multiple of
    ``parts``. The codebook starts from the ``entries`` smallest ids
    (null ids last; rows that share an id by their components); fewer rows give
    fewer entries. Rows that repeat are rows of their own; null labels are one
    label; ``label_error`` is null where it passes 64 bits. Other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    rows = df.select(col(id_col).alias("vec_id"), col(label_col).alias("label"), integers(col(vector_col)).alias("whole"))
    rows = staged(rows.filter("whole is not null").withColumn("rid", F.monotonically_increasing_id()), "integers")
    dim = rows.agg(F.max(F.size("whole"))).first()[0]
    if dim is None:
        none = rows.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"))
        return none, np.zeros((parts, 0, 0), dtype=np.int64)
    width = max(1, -(-dim // parts))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(entries).select("whole").collect()
    start = np.zeros((len(first), parts * width), dtype=np.int64)
    for n, r in enumerate(first):
        start[n, :len(r["whole"])] = r["whole"]
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    trees = staged(rows.select("rid", "whole").mapInPandas(_plant(parts, width, chunk), _TREES), "trees")
    books = lloyd(trees.drop("members", "rids"), books, rounds)
    coded = trees.mapInPandas(_encode(books), "rid long, codes array<int>, error long")
    out = staged(rows.select("rid", "vec_id", "label").join(coded, "rid").drop("rid"), "coded")
    total = out.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("t")).select(
        F.col("label").alias("of"), F.col("t").try_cast("long").alias("label_error"))
    return out.join(small(staged(total, "label-errors")), F.col("label").eqNullSafe(F.col("of")), "left").drop("of"), books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
