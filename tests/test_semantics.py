"""Exact semantics on literal mini-tables (closed forms, edge rows)."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import expr as X
from tessera.operators.encode import LabelEncoder, OneHot, graded
from tessera.operators.ensemble import blend, normalised_weights
from tessera.operators.evaluate import assign_folds, oof_group_mean
from tessera.operators.impute import (GroupMeanFeature, GroupMedianImputer, ModeImputer,
                                      drop_outliers, fill_constant)
from tessera.operators.models import GroupMean
from tessera.operators.select import (CorrelationFilter, VarianceFilter, mi_from_bins,
                                      top_k, upper_triangle_drops)
from tessera.operators.stats import BoxCoxSkewed, RobustScaler, skewness_report
from tessera.sources.tables import labelled_unlabelled, normalise_na_tokens


def test_outlier_filter_keeps_null_rows(spark):
    df = spark.createDataFrame([(1, 5000.0, 100.0), (2, 5000.0, None), (3, 100.0, 100.0)],
                               "id int, area double, price double")
    out = drop_outliers(df, (F.col("area") > 4000) & (F.col("price") < 300000))
    assert sorted(r.id for r in out.collect()) == [2, 3]


def test_mode_ties_smallest_nulls_ignored(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)],
                               "c string")
    m = ModeImputer(["c"]).fit(df)
    assert m.modes["c"] == "a"
    assert {r.c for r in m.transform(df).collect()} == {"a", "b"}


def test_group_median_interpolates_and_null_key(spark):
    df = spark.createDataFrame(
        [("g", 1.0), ("g", 2.0), ("g", 10.0), ("g", 20.0), ("g", None), ("h", None),
         (None, 5.0)], "g string, x double")
    out = GroupMedianImputer(["x"], "g").fit(df).transform(df).collect()
    filled = [r.x for r in out if r.g == "g"]
    assert 6.0 in filled and None not in filled
    assert [r.x for r in out if r.g == "h"] == [None]        # all-null group stays null
    assert [r.x for r in out if r.g is None] == [None]       # null key → null


def test_group_mean_feature_global_fallback(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), (None, 6.0)],
                               "g string, q double")
    out = {(r.g, r.q): r.gm for r in GroupMeanFeature("q", "g", "gm").fit(df)
           .transform(df).collect()}
    assert out[("a", 1.0)] == 2.0 and out[("b", 10.0)] == 10.0
    assert out[(None, 6.0)] == pytest.approx(5.0)


def test_quartiles_and_robust_scale(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,)], "x double")
    sc = RobustScaler(["x"]).fit(df)
    assert sc.center["x"] == 6.0 and sc.scale["x"] == pytest.approx(12.5 - 1.75)
    rare = spark.createDataFrame([(0,), (0,), (0,), (0,), (1,)], "f int")
    sr = RobustScaler(["f"]).fit(rare)
    assert sr.scale["f"] == 1.0                          # zero spread divides by 1
    vals = sorted(r.f for r in sr.transform(rare).collect())
    assert vals == [0.0, 0.0, 0.0, 0.0, 1.0]            # x − median, median 0


def test_skewness_population_and_constant(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (2.0, 3.0), (10.0, 3.0)],
                               "x double, c double")
    rep = {r.feature: r.skew for r in skewness_report(df, ["x", "c"]).collect()}
    assert rep["x"] == pytest.approx(1.10997, abs=1e-5)
    assert rep["c"] is None
    box = BoxCoxSkewed(["x", "c"]).fit(df)
    assert box.chosen == ["x"]


def test_boxcox_edges(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (-2.0,)], "x double")
    v = [r[0] for r in df.select(X.boxcox1p("x", 0.15)).collect()]
    assert v[0] == 0.0 and v[1] == pytest.approx(-1 / 0.15) and math.isnan(v[2])
    z = [r[0] for r in df.select(X.nan_to_zero(X.boxcox1p("x", 0.15))).collect()]
    assert z[2] == 0.0


def test_label_codes_text_order(spark):
    df = spark.createDataFrame([("1",), ("10",), ("2",), ("9",), (None,)], "m string")
    out = [r.m for r in LabelEncoder(["m"]).fit(df).transform(df).collect()]
    assert out == [0, 1, 2, 3, None]


def test_one_hot_null_all_zeros_and_names(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "Wd Sdng")],
                               "id int, c string")
    hot = OneHot(["c"]).fit(df)
    assert hot.dummy_names() == ["c_Wd_Sdng", "c_a", "c_b"]
    rows = {r.id: r for r in hot.transform(df).collect()}
    assert (rows[3].c_a, rows[3].c_b, rows[3].c_Wd_Sdng) == (0, 0, 0)
    assert rows[2].c_a == 1 and rows[2].c_b == 0


def test_graded_default(spark):
    df = spark.createDataFrame([("Min1",), ("xx",), (None,)], "Functional string")
    out = [r[0] for r in graded(df, {"Functional": (X.FUNCTIONAL, 7)}).collect()]
    assert out == [6, 7, 7]


def test_variance_pop_vs_samp(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (1.0,)], "x double")
    assert VarianceFilter(["x"], 0.18, True).fit(df).kept == ["x"]      # 0.1875
    assert VarianceFilter(["x"], 0.19, True).fit(df).kept == []
    assert VarianceFilter(["x"], 0.24, False).fit(df).kept == ["x"]     # 0.25


def test_correlation_chain_not_greedy(spark):
    rows = [(float(i), float(i) * 2 + 0.001 * (i % 3), float(i) * 3 + 0.002 * (i % 2),
             float((i * 7) % 5)) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    cf = CorrelationFilter(["a", "b", "c", "d"], 0.98).fit(df)
    assert cf.dropped == ["b", "c"]
    assert upper_triangle_drops(["a", "b"], [[1, float("nan")], [float("nan"), 1]], .98) == []


def test_mi_independent_zero_and_topk_ties(spark):
    rows = [(i % 2, (i // 2) % 2, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "x int, z int, __by int")
    mi = {r.feature: r.mi for r in mi_from_bins(df, ["x", "z"]).collect()}
    assert mi["x"] == pytest.approx(math.log(2))
    assert mi["z"] == pytest.approx(0.0, abs=1e-12)
    sc = spark.createDataFrame([("a", 0, 1.0), ("b", 1, 1.0)], "feature string, position int, mi double")
    assert [r.feature for r in top_k(sc, 1).collect()] == ["b"]     # later column wins


def test_weights_and_blend(spark):
    assert normalised_weights({"a": 2, "b": 1, "c": 1}) == {"a": .5, "b": .25, "c": .25}
    with pytest.raises(ValueError):
        normalised_weights({"a": 0, "b": 0})
    df = spark.createDataFrame([(3.0, 3.0, 3.0)], "a double, b double, c double")
    assert df.select(blend({"a": .8, "b": .15, "c": .05})).first()[0] == pytest.approx(3.0)


def test_clip_and_format(spark):
    df = spark.createDataFrame([(8.0,), (15.0,), (float("nan"),), (None,), (10.5,)], "p double")
    out = [r[0] for r in df.select(X.clip_log_prediction("p")).collect()]
    assert out[0] == 9.0 and out[1] == 14.0 and math.isnan(out[2]) and out[3] is None
    assert out[4] == 10.5
    s = spark.createDataFrame([(1.23456789,)], "v double").select(
        F.format_string("%.6f", "v")).first()[0]
    assert s == "1.234568"


def test_log_roundtrip_and_below_minus_one(spark):
    df = spark.createDataFrame([(0.0,), (12345.678,), (-2.0,)], "x double")
    out = [r[0] for r in df.select(X.price_scale(X.log_target("x"))).collect()]
    assert out[0] == 0.0 and out[1] == pytest.approx(12345.678) and out[2] is None


def test_folds_disjoint_cover_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = assign_folds(df, ["k"], 5, 42)
    b = assign_folds(df.repartition(7), ["k"], 5, 42)
    fa = {r.k: r.fold for r in a.collect()}
    fb = {r.k: r.fold for r in b.collect()}
    assert fa == fb and set(fa.values()) == set(range(5)) and len(fa) == 1000
    sizes = a.groupBy("fold").count().collect()
    assert all(150 < r["count"] < 250 for r in sizes)


def test_oof_group_mean_equals_fold_fits(spark):
    rows = [(i, ["a", "b", "c", None][i % 4], float(i % 7) + 0.5 * (i % 3), i % 4)
            for i in range(80)]
    rows.append((999, "lonely", 3.0, 1))                  # group seen in one fold only
    df = spark.createDataFrame(rows, "k long, g string, y double, fold int")
    closed = {r.k: r.oof for r in oof_group_mean(df, "y", "g").collect()}
    assert len(closed) == 81
    for f in range(4):
        fitted = GroupMean("g").fit(df.filter(F.col("fold") != f), [], "y")
        for r in fitted.predict(df.filter(F.col("fold") == f), "p").collect():
            assert closed[r.k] == pytest.approx(r.p)


def test_union_by_name_and_na_tokens(spark):
    lab = spark.createDataFrame([(1, "NA", 10.0)], "id int, c string, y double")
    unl = spark.createDataFrame([(2, "None")], "id int, c string")
    u = normalise_na_tokens(labelled_unlabelled(lab, unl), ["c"])
    got = {r.id: (r.c, r.y, r.split) for r in u.collect()}
    assert got == {1: (None, 10.0, "train"), 2: (None, None, "test")}
    assert fill_constant(u, {"c": "None"}).filter("c = 'None'").count() == 2


def test_quantiles_do_not_depend_on_pivots_or_size(spark):
    import numpy as np
    from tessera.operators.stats import group_quantiles
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=3000), "b": np.repeat([1.0, 2.0, 10.0, 20.0], 1), "c": rng.integers(0, 5, 900) * 1.0,
              "d": np.array([7.0]), None: rng.exponential(size=41) ** 4}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("a", None), ("e", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    for gather, accuracy in ((20_000, 1000), (10, 8), (1, 50)):     # coarse pivots, several rounds
        got = {r["g"]: r["q"] for r in group_quantiles(df, ["g"], probs, gather, accuracy).collect()}
        assert set(got) == set(groups)
        for g, v in groups.items():
            assert np.allclose(got[g], np.quantile(v, probs), rtol=1e-12, atol=0), (g, gather)


def test_no_values_no_quantiles(spark):
    from tessera.operators.stats import column_quantiles
    df = spark.createDataFrame([], "x double, y double")
    assert column_quantiles(df, ["x", "y"], [0.5]) == {}


def test_correlation_uses_rows_with_both_values(spark):
    from tessera.operators.select import CorrelationFilter
    rows = [(float(i), 2.0 * i, None if i % 2 else -1.0 * i, float((i * 7) % 5)) for i in range(20)]
    f = CorrelationFilter(["a", "b", "c", "d"], 0.95).fit(spark.createDataFrame(rows, "a double, b double, c double, d double"))
    assert f.dropped == ["b", "c"]
    assert abs(f.matrix[0][2] + 1) < 1e-9 and abs(f.matrix[2][0] + 1) < 1e-9


def test_score_function_always_runs(spark):
    from tessera.operators.select import TopKSelector
    calls = []

    def score(df, features, label):
        calls.append(features)
        return df.sparkSession.createDataFrame([(c, i, float(i)) for i, c in enumerate(features)], "feature string, position int, mi double")
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, y double")
    assert TopKSelector(["a", "b"], "y", 5, score).fit(df).kept == ["a", "b"] and calls


def test_dummy_names_do_not_collide(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a-b"), (3, "a_b"), (4, None)], "c_a_b_2 int, c string")
    hot = OneHot(["c"]).fit(df)
    assert hot.dummy_names() == ["c_a_b", "c_a_b_3", "c_a_b_4"]
    got = [tuple(r) for r in hot.transform(df).orderBy("c_a_b_2").collect()]
    assert got == [(1, 1, 0, 0), (2, 0, 1, 0), (3, 0, 0, 1), (4, 0, 0, 0)]


def test_label_codes_of_many_levels_come_from_a_join(spark):
    from tessera.operators.encode import LabelEncoder
    df = spark.createDataFrame([(i, str(i % 50), "x" if i % 2 else None) for i in range(120)], "id int, c string, few string")
    got = {r.id: (r.c, r.few) for r in LabelEncoder(["c", "few"]).fit(df).transform(df).collect()}
    rank = {v: i for i, v in enumerate(sorted(map(str, range(50))))}
    assert got == {i: (rank[str(i % 50)], 0 if i % 2 else None) for i in range(120)}


def test_na_tokens_in_number_columns(spark, tmp_path):
    import pytest
    from pyspark.sql.types import StructType
    from tessera.sources.tables import read_csv_table
    schema = StructType.fromDDL("a int, b double, c string")
    (tmp_path / "good.csv").write_text("a,b,c\n1,N/A,x\nnull,2.5,None\n3,nan,NA\n")
    got = [tuple(r) for r in read_csv_table(spark, str(tmp_path / "good.csv"), schema).collect()]
    assert got == [(1, None, "x"), (None, 2.5, None), (3, None, None)]
    (tmp_path / "bad.csv").write_text("a,b,c\none,1,x\n")
    with pytest.raises(Exception, match="column a"):
        read_csv_table(spark, str(tmp_path / "bad.csv"), schema).collect()


def test_hot_group_median_and_dominance(spark):
    from tessera.operators.select import dominance
    # one group holds a third of the rows
    rows = [("hot", float(i % 7)) for i in range(300)] + \
           [(f"g{i % 20}", float(i % 5)) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(8)
    tab = {r.g: r["__med_x"] for r in GroupMedianImputer(["x"], "g").fit(df).table.collect()}
    assert tab["hot"] == 3.0 and tab["g0"] == 0.0 and len(tab) == 21
    rep = {r.feature: r for r in dominance(df, ["g"]).collect()}
    assert rep["g"].top_value == "hot" and rep["g"].top_count == 300 and rep["g"].n == 900


def test_statistics_invariant_under_repartition(spark):
    rows = [(i % 11, float((i * 37) % 101) / 7.0) for i in range(500)]
    a = spark.createDataFrame(rows, "g int, x double")
    b = a.repartition(13)
    for df_a, df_b in [(a, b)]:
        assert RobustScaler(["x"]).fit(df_a).center == RobustScaler(["x"]).fit(df_b).center
        ta = {r.g: r["__med_x"] for r in GroupMedianImputer(["x"], "g").fit(df_a).table.collect()}
        tb = {r.g: r["__med_x"] for r in GroupMedianImputer(["x"], "g").fit(df_b).table.collect()}
        assert ta == tb
        sa = BoxCoxSkewed(["x"]).fit(df_a).skews["x"]
        sb = BoxCoxSkewed(["x"]).fit(df_b).skews["x"]
        assert sa == pytest.approx(sb, rel=1e-12)
        assert ModeImputer(["g"]).fit(df_a).modes == ModeImputer(["g"]).fit(df_b).modes


def test_mode_tie_is_numeric(spark):
    from tessera.operators.impute import ModeImputer
    df = spark.createDataFrame([(2, "2"), (2, "2"), (10, "10"), (10, "10"), (None, None)], "n int, t string")
    assert ModeImputer(["n", "t"]).fit(df).modes == {"n": 2, "t": "10"}


def test_stacking_keeps_rows_with_equal_keys(spark):
    from tessera.operators.ensemble import Stacking
    from tessera.operators.models import ridge
    rows = [(i // 2, float(i % 7), float(i % 7) * 2 + 1) for i in range(200)]
    rows += rows[:20]  # and whole rows repeated
    df = spark.createDataFrame(rows, "k long, x double, y double")
    bases = [ridge(1.0, name="a"), ridge(2.0, name="b")]
    stack = Stacking(bases=bases, meta=ridge(1.0, name="m"), key=["k"], k=3)
    fitted = stack.fit(df, ["x"], "y")
    assert fitted.oof.count() == len(rows)
