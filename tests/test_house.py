"""The house-sale workflow runs end to end on small rule-built CSV files."""

import csv
import os
import tempfile

from tessera.plans.house import HOUSE_COLUMNS, run_house
from tessera.plans.pipeline import Options

CODES = ["Ex", "Gd", "TA", "Fa"]


def _value(name: str, kind: str, i: int, k: int):
    if name == "Id":
        return i + 1
    if name == "MSSubClass":
        return [20, 30, 60, 120][i % 4]
    if name in ("OverallQual", "OverallCond"):
        return 1 + (i * (k + 3)) % 10
    if name in ("YearBuilt", "YearRemodAdd"):
        return 1900 + (i * 7) % 110
    if name == "YrSold":
        return 2006 + i % 5
    if name == "MoSold":
        return 1 + i % 12
    if name == "GrLivArea":
        return 600 + (i * 53) % 2600
    if name == "Neighborhood":
        return ["NAmes", "CollgCr", "OldTown", "Edwards"][i % 4]
    if kind == "s":
        if (i + k) % 13 == 0:
            return "NA"
        return CODES[(i + k) % len(CODES)] if name.endswith(("Qual", "Cond", "QC", "Qu")) \
            else f"v{(i * (k + 1)) % 3}"
    if kind == "d" and (i + k) % 17 == 0:
        return "NA"
    return (i * (k + 7)) % 97 + (0.5 if kind == "d" else 0)


def _write(path: str, rows: range, labelled: bool):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow([n for n, _ in HOUSE_COLUMNS] + (["SalePrice"] if labelled else []))
        for i in rows:
            vals = [_value(n, t, i, k) for k, (n, t) in enumerate(HOUSE_COLUMNS)]
            if labelled:
                qual = vals[[n for n, _ in HOUSE_COLUMNS].index("OverallQual")]
                area = vals[[n for n, _ in HOUSE_COLUMNS].index("GrLivArea")]
                vals.append(40000 + 60 * area + 9000 * qual + (i * 311) % 7000)
            w.writerow(vals)


def _lines(folder: str) -> list[str]:
    files = [f for f in os.listdir(folder) if f.endswith(".csv")]
    return [ln for f in files for ln in open(f"{folder}/{f}").read().splitlines()]


def test_house_run_modes(spark):
    d = tempfile.mkdtemp(prefix="tessera-house-")
    _write(f"{d}/train.csv", range(0, 160), True)
    _write(f"{d}/test.csv", range(160, 200), False)
    few = dict(seeds=(42,), folds=2, outer_folds=2, trees=2, top_k=8, clip=(9.0, 14.0), preset="documented")
    scores = run_house(spark, f"{d}/train.csv", f"{d}/test.csv", f"{d}/cv", Options(mode="cv", **few)).collect()
    assert sorted(r.fold for r in scores) == [-1, 0, 1] and sum(r.n for r in scores if r.fold >= 0) == 160
    oof = [ln for ln in _lines(f"{d}/cv/oof") if not ln.startswith("Id,")]
    assert sorted(int(ln.split(",")[0]) for ln in oof) == list(range(1, 161))
    names = run_house(spark, f"{d}/train.csv", f"{d}/test.csv", f"{d}/list", Options(mode="list"))
    assert names.columns == ["feature", "source"] and _lines(f"{d}/list/features")[0] == "feature,source"
    assert names.count() == len(_lines(f"{d}/list/features")) - 1


def test_house_workflow_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="tessera-house-")
    train, test, out = f"{d}/train.csv", f"{d}/test.csv", f"{d}/pred"
    _write(train, range(0, 240), True)
    _write(test, range(240, 320), False)
    opts = Options(seeds=(42,), folds=2, trees=2, top_k=20, clip=(9.0, 14.0))
    pred = run_house(spark, train, test, out, opts)
    rows = pred.collect()
    assert sorted(r.Id for r in rows) == list(range(241, 321))
    assert all(9.0 <= r.log_prediction <= 14.0 and r.sale_price > 0 for r in rows)
    lines, stack = _lines(f"{out}/predictions"), _lines(f"{out}/stack_predictions")
    assert len(stack) >= 81 and sorted(stack) != sorted(lines)
    assert lines[0] == "Id,SalePrice" and len([ln for ln in lines if ln != "Id,SalePrice"]) == 80
    assert all(len(ln.split(",")[1].split(".")[1]) == 6 for ln in lines if ln != "Id,SalePrice")


def test_house_documented_variant_filters(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from tessera.plans.house import HouseFeatures, read_house
    d = tempfile.mkdtemp(prefix="tessera-house-")
    _write(f"{d}/train.csv", range(0, 240), True)
    _write(f"{d}/test.csv", range(240, 320), False)
    tr, te = read_house(spark, f"{d}/train.csv", f"{d}/test.csv")
    fe = HouseFeatures("documented")
    out = fe.build(tr, te)
    assert len(fe.features) > 20 and set(fe.features) <= set(out.columns)
    assert not any(c.startswith("ExterQual_") for c in fe.features)   # graded, not one-hot
    lab = np.array([[r[c] for c in fe.features]
                    for r in out.filter(F.col("split") == "train").collect()], dtype=float)
    assert lab.var(axis=0, ddof=1).min() > 0
    c = np.abs(np.corrcoef(lab, rowvar=False))
    assert np.nanmax(np.triu(c, k=1)) <= 0.98 + 1e-9
    assert out.filter(F.col("split") == "test").count() == 80


def test_house_coded_variants(spark):
    import pytest
    from pyspark.sql import functions as F

    from tessera.operators.stats import skewness_report
    from tessera.plans.house import HouseFeatures, read_house
    d = tempfile.mkdtemp(prefix="tessera-house-")
    _write(f"{d}/train.csv", range(0, 120), True)
    _write(f"{d}/test.csv", range(120, 160), False)
    tr, te = read_house(spark, f"{d}/train.csv", f"{d}/test.csv")
    got = {}
    for v in ("best", "two_means", "unfiltered"):
        fe = HouseFeatures(v)
        rows_ = fe.build(tr, te).collect()
        got[v] = set(fe.features), rows_
        assert len(got[v][1]) == 160 and len(set(fe.features)) == len(fe.features)
    best, two, every = (got[v][0] for v in ("best", "two_means", "unfiltered"))
    assert "Neighborhood_YearBuilt" in two and "Neighborhood_YearBuilt" not in best | every
    assert {"TotalSF", "TotalBath", "OverallQual_TotalSF"} <= best and not {"TotalBath", "OverallQual_TotalSF"} & two
    assert {"TotalSF", "TotalBath", "HasBsmt", "Has2ndFloor", "HasFireplace"} <= every
    assert not any(c == "Neighborhood_OverallQual" for c in every)
    # nothing is filtered: a column that is the same in all rows stays
    assert any(len({r[c] for r in got["unfiltered"][1]}) == 1 for c in every)
    assert not any(len({r[c] for r in got["best"][1]}) == 1 for c in best)
    # the mean of the building year is that of the rows of both halves
    year, rows_ = {}, tr.drop("SalePrice").unionByName(te).collect()
    for r in rows_:
        year.setdefault(r["Neighborhood"], []).append(r["YearBuilt"])
    place = {r["Id"]: r["Neighborhood"] for r in rows_}
    out = {r["Id"]: r["Neighborhood_YearBuilt"] for r in got["two_means"][1]}
    want = {i: sum(year[n]) / len(year[n]) for i, n in place.items()}
    raw = spark.createDataFrame([(v, ) for v in want.values()], "m double")
    skew = skewness_report(raw, ["m"]).first()["skew"]
    lam = 0.15
    scaled = {i: ((1 + m) ** lam - 1) / lam if abs(skew) > 0.75 else m for i, m in want.items()}
    assert out == pytest.approx(scaled)
