"""Query catalogue: one callable per operator of the inventory, each with
the DuckDB SQL that must give the same rows (where one exists).

Every query reads the whole test tables (or a table Spark derives from
them). Doubles are rounded to the same number of digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import expr as X
from tessera.operators.encode import LabelEncoder, OneHot, graded
from tessera.operators.evaluate import (assign_folds, oof_group_mean, rmsle,
                                        rmsle_by_fold, summarize_scores)
from tessera.operators.impute import (GroupMeanFeature, GroupMedianImputer, ModeImputer,
                                      drop_outliers, fill_constant)
from tessera.operators.models import GroupMean
from tessera.operators.select import (CorrelationFilter, VarianceFilter, dominance,
                                      mutual_information, top_k, variance_table)
from tessera.operators.sparse_hot import SparseOneHot
from tessera.operators.stats import BoxCoxSkewed, RobustScaler, skewness_report
from tessera.sources.fixture import KEY, KEY_SQL, SALES_CTE, sales
from tessera.sources.tables import NA_TOKENS, labelled_unlabelled, normalise_na_tokens, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


FOLD_WEIGHTS = (31, 17, 7, 1)           # on l_orderkey, l_partkey, l_suppkey, l_linenumber
FOLD_KEY = KEY[:4]


def fold_sql(seed: int, k: int) -> str:
    return f"(l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber + {seed}) % {k}"


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# --- scans, unions, filters --------------------------------------------------

@query("scan_split_counts", SALES_CTE + """
SELECT split, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders
FROM sales GROUP BY split""")
def scan_split_counts(spark, d):
    return sales(spark, d).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey").alias("n_orders"))


@query("union_with_split", SALES_CTE + f"""
SELECT {KEY_SQL}, 'train' AS split, round(y, 6) AS y FROM sales WHERE split = 'train'
UNION ALL
SELECT {KEY_SQL}, 'test' AS split, CAST(NULL AS DOUBLE) AS y FROM sales WHERE split = 'test'""")
def union_with_split(spark, d):
    s = sales(spark, d)
    train = s.filter(F.col("split") == "train").select(*KEY, "y")
    test = s.filter(F.col("split") == "test").select(*KEY)
    return labelled_unlabelled(train, test).select(*KEY, "split", r6("y").alias("y"))


@query("csv_scan", SALES_CTE + """
SELECT split, count(*) AS n, count(facility) AS n_facility, count(extra_qty) AS n_extra,
       round(sum(extra_qty), 6) AS sum_extra
FROM sales GROUP BY split""")
def csv_scan(spark, d):
    """Header CSV written from the view (nulls as NA) and read back with an
    explicit schema: exercises the CSV source and its missing-token rules."""
    from tessera.runtime import ensure_checkpoint_dir
    import uuid
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv/{uuid.uuid4().hex}"
    (sales(spark, d).select("split", "facility", "extra_qty")
     .write.option("header", True).option("nullValue", "NA").csv(path))
    schema = StructType([StructField("split", StringType()), StructField("facility", StringType()),
                         StructField("extra_qty", DoubleType())])
    from tessera.sources.tables import read_csv_table
    back = read_csv_table(spark, path, schema)
    return back.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count("facility").alias("n_facility"),
        F.count("extra_qty").alias("n_extra"), r6(F.sum("extra_qty")).alias("sum_extra"))


_TOKENS_SQL = _sql_list(NA_TOKENS)


@query("na_token_normalise", SALES_CTE + f"""
, raw AS (
  SELECT {KEY_SQL}, coalesce(facility, 'None') AS facility,
         coalesce(priority_n, 'NA') AS priority_n, month_s FROM sales)
SELECT {KEY_SQL},
       CASE WHEN facility IN ({_TOKENS_SQL}) THEN NULL ELSE facility END AS facility,
       CASE WHEN priority_n IN ({_TOKENS_SQL}) THEN NULL ELSE priority_n END AS priority_n,
       CASE WHEN month_s IN ({_TOKENS_SQL}) THEN NULL ELSE month_s END AS month_s
FROM raw""")
def na_token_normalise(spark, d):
    raw = sales(spark, d).select(
        *KEY, F.coalesce("facility", F.lit("None")).alias("facility"),
        F.coalesce("priority_n", F.lit("NA")).alias("priority_n"), "month_s")
    return normalise_na_tokens(raw, ["facility", "priority_n", "month_s"])


@query("cast_codes", SALES_CTE + f"""
SELECT {KEY_SQL}, CAST(p_size AS VARCHAR) AS p_size_s,
       CAST(month(l_shipdate) AS VARCHAR) AS month_s, CAST(age AS VARCHAR) AS age_s FROM sales""")
def cast_codes(spark, d):
    s = sales(spark, d)
    return s.select(*KEY, X.code_as_text("p_size").alias("p_size_s"),
                    X.code_as_text(F.month("l_shipdate")).alias("month_s"),
                    X.code_as_text("age").alias("age_s"))


@query("outlier_filter", SALES_CTE + f"""
SELECT {KEY_SQL}, split FROM sales
WHERE NOT (coalesce(extra_qty > 45 AND net < 5000, false) AND split = 'train')""")
def outlier_filter(spark, d):
    s = sales(spark, d)
    kept = drop_outliers(s, (F.col("extra_qty") > 45) & (F.col("net") < 5000),
                         F.col("split") == "train")
    return kept.select(*KEY, "split")


_STRING_COLS = ["l_returnflag", "l_linestatus", "p_brand", "p_type", "o_orderpriority",
                "split", "facility", "priority_n", "month_s"]


@query("near_constant_columns", SALES_CTE + """
, long AS (UNPIVOT (SELECT """ + ", ".join(_STRING_COLS) + """ FROM sales)
           ON """ + ", ".join(_STRING_COLS) + """ INTO NAME feature VALUE value),
counts AS (SELECT feature, value, count(*) AS c FROM long GROUP BY feature, value),
ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY c DESC, value) AS rk,
                  sum(c) OVER (PARTITION BY feature) AS n FROM counts)
SELECT feature, value AS top_value, c AS top_count, CAST(n AS BIGINT) AS n,
       round(c / n, 6) AS dominance
FROM ranked WHERE rk = 1""")
def near_constant_columns(spark, d):
    """Share of the most frequent value per string column (P3, general form)."""
    rep = dominance(sales(spark, d), _STRING_COLS)
    return rep.select("feature", "top_value", "top_count", "n",
                      r6("dominance").alias("dominance"))


# --- missing values -----------------------------------------------------------

@query("impute_constant", SALES_CTE + f"""
SELECT {KEY_SQL}, coalesce(facility, 'None') AS facility,
       coalesce(priority_n, '4-NOT SPECIFIED') AS priority_n FROM sales""")
def impute_constant(spark, d):
    s = sales(spark, d).select(*KEY, "facility", "priority_n")
    return fill_constant(s, {"facility": "None", "priority_n": "4-NOT SPECIFIED"})


@query("impute_zero", SALES_CTE + f"""
SELECT {KEY_SQL}, coalesce(extra_qty, 0.0) AS extra_qty,
       coalesce(frontage, 0.0) AS frontage FROM sales""")
def impute_zero(spark, d):
    s = sales(spark, d).select(*KEY, "extra_qty", "frontage")
    return fill_constant(s, {"extra_qty": 0.0, "frontage": 0.0})


@query("impute_mode", SALES_CTE + f"""
, m AS (SELECT priority_n AS v FROM sales WHERE priority_n IS NOT NULL
        GROUP BY priority_n ORDER BY count(*) DESC, priority_n LIMIT 1),
  mf AS (SELECT facility AS v FROM sales WHERE facility IS NOT NULL
        GROUP BY facility ORDER BY count(*) DESC, facility LIMIT 1)
SELECT {KEY_SQL}, coalesce(priority_n, (SELECT v FROM m)) AS priority_n,
       coalesce(facility, (SELECT v FROM mf)) AS facility FROM sales""")
def impute_mode(spark, d):
    s = sales(spark, d).select(*KEY, "priority_n", "facility")
    return ModeImputer(["priority_n", "facility"]).fit(s).transform(s)


@query("nan_to_zero", SALES_CTE + f"""
, b AS (SELECT {KEY_SQL}, frontage,
               (pow(1.0 + age, 0.15) - 1) / 0.15 AS bc FROM sales)
SELECT {KEY_SQL}, round(CASE WHEN bc IS NULL OR isnan(bc) THEN 0.0 ELSE bc END, 6) AS bc_age,
       coalesce(frontage, 0.0) AS frontage FROM b""")
def nan_to_zero(spark, d):
    s = sales(spark, d)
    return s.select(*KEY, r6(X.nan_to_zero(X.boxcox1p("age", 0.15))).alias("bc_age"),
                    X.nan_to_zero("frontage").alias("frontage"))


@query("group_median_impute", SALES_CTE + f"""
SELECT {KEY_SQL},
       round(CASE WHEN p_brand IS NULL THEN NULL
                  ELSE coalesce(frontage, median(frontage) OVER (PARTITION BY p_brand)) END, 6)
         AS frontage
FROM sales""")
def group_median_impute(spark, d):
    s = sales(spark, d).select(*KEY, "p_brand", "frontage")
    out = GroupMedianImputer(["frontage"], "p_brand").fit(s).transform(s)
    return out.select(*KEY, r6("frontage").alias("frontage"))


@query("group_mean_feature", SALES_CTE + f"""
SELECT {KEY_SQL},
       round(coalesce(avg(l_quantity) OVER (PARTITION BY p_brand),
                      avg(l_quantity) OVER ()), 6) AS brand_qty,
       round(coalesce(avg(frontage) OVER (PARTITION BY p_type),
                      avg(frontage) OVER ()), 6) AS type_frontage
FROM sales""")
def group_mean_feature(spark, d):
    s = sales(spark, d).select(*KEY, "p_brand", "p_type", "l_quantity", "frontage")
    s = GroupMeanFeature("l_quantity", "p_brand", "brand_qty").fit(s).transform(s)
    s = GroupMeanFeature("frontage", "p_type", "type_frontage").fit(s).transform(s)
    return s.select(*KEY, r6("brand_qty").alias("brand_qty"),
                    r6("type_frontage").alias("type_frontage"))


# --- feature construction -----------------------------------------------------

@query("derived_sums", SALES_CTE + f"""
SELECT {KEY_SQL}, round(l_quantity + extra_qty, 6) AS qty_total,
       round(l_quantity + extra_qty + p_size + frontage + age, 6) AS five_sum,
       round(l_tax * 1.0 + l_discount * 0.5, 6) AS rate_total FROM sales""")
def derived_sums(spark, d):
    s = sales(spark, d)
    return s.select(*KEY, r6(X.total("l_quantity", "extra_qty")).alias("qty_total"),
                    r6(X.total("l_quantity", "extra_qty", "p_size", "frontage", "age"))
                    .alias("five_sum"),
                    r6(X.weighted_total({"l_tax": 1.0, "l_discount": 0.5})).alias("rate_total"))


_GRADE_SQL = ("CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 "
              "WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 "
              "ELSE 0 END")


@query("interactions", SALES_CTE + f"""
SELECT {KEY_SQL}, round(l_quantity * p_retailprice, 6) AS qty_x_price,
       CAST(({_GRADE_SQL}) * p_size AS INTEGER) AS grade_x_size FROM sales""")
def interactions(spark, d):
    s = sales(spark, d)
    g = X.lookup("o_orderpriority", X.PRIORITY_GRADES, 0)
    return s.select(*KEY, r6(F.col("l_quantity") * F.col("p_retailprice")).alias("qty_x_price"),
                    (g * F.col("p_size")).cast("int").alias("grade_x_size"))


@query("presence_flags", SALES_CTE + f"""
SELECT {KEY_SQL},
       CASE WHEN extra_qty > 0 THEN 1 ELSE 0 END AS has_extra,
       CASE WHEN frontage > 0 THEN 1 ELSE 0 END AS has_frontage,
       CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS has_discount,
       CASE WHEN age > 0 THEN 1 ELSE 0 END AS has_age FROM sales""")
def presence_flags(spark, d):
    s = sales(spark, d)
    return s.select(*KEY, X.presence_flag("extra_qty").alias("has_extra"),
                    X.presence_flag("frontage").alias("has_frontage"),
                    X.presence_flag("l_discount").alias("has_discount"),
                    X.presence_flag("age").alias("has_age"))


@query("age_features", SALES_CTE + f"""
SELECT {KEY_SQL}, age,
       CASE WHEN year(l_shipdate) = year(o_orderdate) THEN 1 ELSE 0 END AS same_year,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)
         AS days FROM sales""")
def age_features(spark, d):
    s = sales(spark, d)
    return s.select(*KEY, "age",
                    X.equal_flag(F.year("l_shipdate"), F.year("o_orderdate")).alias("same_year"),
                    F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("days"))


# --- scales and transforms ----------------------------------------------------

@query("target_log", SALES_CTE + f"""
SELECT {KEY_SQL}, round(ln(1 + net), 6) AS y, round(exp(ln(1 + net)) - 1, 6) AS net_back
FROM sales""")
def target_log(spark, d):
    s = sales(spark, d)
    return s.select(*KEY, r6(X.log_target("net")).alias("y"),
                    r6(X.price_scale(X.log_target("net"))).alias("net_back"))


@query("clip_log_pred", SALES_CTE + f"""
SELECT {KEY_SQL},
       round(CASE WHEN y IS NULL THEN NULL WHEN isnan(y) THEN y
                  ELSE least(greatest(y, 9.0), 14.0) END, 6) AS clipped FROM sales""")
def clip_log_pred(spark, d):
    s = sales(spark, d)
    return s.select(*KEY, r6(X.clip_log_prediction("y", *X.CLIP_RANGE)).alias("clipped"))


@query("boxcox1p", """
SELECT event_id, round((pow(1 + value, 0.15) - 1) / 0.15, 6) AS value_bc,
       round(ln(1 + value), 6) AS value_log FROM events""")
def boxcox1p(spark, d):
    e = read_table(spark, d, "events")
    return e.select("event_id", r6(X.boxcox1p("value", 0.15)).alias("value_bc"),
                    r6(X.boxcox1p("value", 0.0)).alias("value_log"))


_SKEW_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice",
              "net", "frontage", "rare", "age", "const_one"]


def _skew_sql(cols: list[str], source: str = "sales") -> str:
    """Population skewness from written-out moments (DuckDB's is bias-corrected)."""
    mu = ", ".join(f"avg({c}) AS mu_{c}" for c in cols)
    mom = ", ".join(f"avg(pow({c} - mu_{c}, 2)) AS m2_{c}, avg(pow({c} - mu_{c}, 3)) AS m3_{c}"
                    for c in cols)
    sk = ", ".join(f"m3_{c} / pow(nullif(m2_{c}, 0), 1.5) AS sk_{c}" for c in cols)
    return (f", mu AS (SELECT {mu} FROM {source}), "
            f"mom AS (SELECT {mom} FROM {source}, mu), sk AS (SELECT {sk} FROM mom)")


@query("skew_report", SALES_CTE + _skew_sql(_SKEW_COLS) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(sk_{c}, 6) AS skew FROM sk" for c in _SKEW_COLS))
def skew_report(spark, d):
    s = sales(spark, d)
    rep = skewness_report(s, _SKEW_COLS)
    return rep.select("feature", r6("skew").alias("skew"))


_BOX_COLS = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "net", "rare"]


@query("boxcox_skewed", SALES_CTE + _skew_sql(_BOX_COLS) + f"""
SELECT {KEY_SQL}, """ + ", ".join(
    f"round(CASE WHEN abs(sk_{c}) > 0.75 THEN (pow(1 + {c}, 0.15) - 1) / 0.15 "
    f"ELSE CAST({c} AS DOUBLE) END, 6) AS {c}_t" for c in _BOX_COLS) + " FROM sales, sk")
def boxcox_skewed(spark, d):
    s = sales(spark, d).select(*KEY, *_BOX_COLS)
    out = BoxCoxSkewed(_BOX_COLS).fit(s).transform(s)
    return out.select(*KEY, *[r6(F.col(c).cast("double")).alias(f"{c}_t") for c in _BOX_COLS])


# --- encoders -------------------------------------------------------------------

_LABEL_COLS = ["o_orderpriority", "p_type", "month_s", "facility"]


@query("label_encode", SALES_CTE + "".join(
    f", lv_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
    f"FROM (SELECT DISTINCT {c} AS v FROM sales WHERE {c} IS NOT NULL))" for c in _LABEL_COLS)
    + f"\nSELECT {', '.join('s.' + k for k in KEY)}, "
    + ", ".join(f"lv_{c}.code AS {c}" for c in _LABEL_COLS) + " FROM sales s "
    + " ".join(f"LEFT JOIN lv_{c} ON s.{c} = lv_{c}.v" for c in _LABEL_COLS))
def label_encode(spark, d):
    s = sales(spark, d).select(*KEY, *_LABEL_COLS)
    return LabelEncoder(_LABEL_COLS).fit(s).transform(s)


@query("ordinal_map", SALES_CTE + f"""
SELECT {KEY_SQL}, CAST({_GRADE_SQL} AS INTEGER) AS o_orderpriority,
       CAST({_GRADE_SQL.replace('o_orderpriority', 'priority_n')} AS INTEGER) AS priority_n
FROM sales""")
def ordinal_map(spark, d):
    s = sales(spark, d).select(*KEY, "o_orderpriority", "priority_n")
    return graded(s, {"o_orderpriority": (X.PRIORITY_GRADES, 0),
                      "priority_n": (X.PRIORITY_GRADES, 0)})


_HOT_COLS = ["l_returnflag", "l_linestatus", "facility"]


# The levels of the three columns in the test tables.
_HOT_LEVELS = {"l_returnflag": ("A", "N", "R"), "l_linestatus": ("F", "O"),
               "facility": ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")}
_HOT_SQL = ", ".join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}" for c, vs in _HOT_LEVELS.items() for v in vs)


@query("one_hot", SALES_CTE + f"""
SELECT {KEY_SQL}, {_HOT_SQL} FROM sales""")
def one_hot(spark, d):
    s = sales(spark, d).select(*KEY, *_HOT_COLS)
    return OneHot(_HOT_COLS).fit(s).transform(s)


# l_partkey has a level per part: as many as the table has parts.
_SPARSE_COLS = ["l_returnflag", "facility", "l_suppkey", "l_partkey"]


def _sparse_sql(cut: float | None) -> str:
    share = "n / (SELECT CAST(count(*) AS DOUBLE) FROM sales)"
    kept = "" if cut is None else f" WHERE {share} * (1 - {share}) > {cut}"
    levels = " UNION ALL ".join(f"SELECT {i} AS nr, CAST({c} AS VARCHAR) AS v, count(*) AS n FROM sales WHERE {c} IS NOT NULL GROUP BY ALL"
                                for i, c in enumerate(_SPARSE_COLS))
    places = ", ".join(f"lv{i}.place" for i in range(len(_SPARSE_COLS)))
    joins = " ".join(f"LEFT JOIN placed lv{i} ON lv{i}.nr = {i} AND lv{i}.v = CAST(s.{c} AS VARCHAR)" for i, c in enumerate(_SPARSE_COLS))
    # qualified, as the levels' columns stand beside them
    key = ", ".join("s." + k for k in KEY)
    return SALES_CTE + f""", levels AS ({levels}),
placed AS (SELECT nr, v, row_number() OVER (ORDER BY nr, v) - 1 AS place FROM levels{kept})
SELECT {key}, concat_ws(',', {places}) AS places, (SELECT count(*) FROM placed) AS size FROM sales s {joins}"""


def _sparse(hot: SparseOneHot, s: DataFrame) -> DataFrame:
    return hot.positions(s.select(*[F.col(k).alias(f"{k}_") for k in KEY], *_SPARSE_COLS), "at").select(
        *[F.col(f"{k}_").alias(k) for k in KEY], F.array_join("at", ",").alias("places"), F.lit(hot.size).cast("long").alias("size"))


@query("one_hot_sparse", _sparse_sql(None))
def one_hot_sparse(spark, d):
    """Places that each row sets in a vector of all levels."""
    s = sales(spark, d)
    return _sparse(SparseOneHot(_SPARSE_COLS).fit(s), s)


@query("one_hot_sparse_selected", _sparse_sql(X.VARIANCE_CUT))
def one_hot_sparse_selected(spark, d):
    """The same of the levels whose indicator varies enough."""
    s = sales(spark, d)
    return _sparse(SparseOneHot(_SPARSE_COLS).fit(s).selected(X.VARIANCE_CUT), s)


@query("robust_scale", SALES_CTE + f"""
, q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a1, median(l_extendedprice) AS m1,
               quantile_cont(l_extendedprice, 0.75) AS b1,
               quantile_cont(l_quantity, 0.25) AS a2, median(l_quantity) AS m2,
               quantile_cont(l_quantity, 0.75) AS b2,
               quantile_cont(rare, 0.25) AS a3, median(rare) AS m3,
               quantile_cont(rare, 0.75) AS b3
        FROM sales WHERE split = 'train')
SELECT {KEY_SQL},
  round((l_extendedprice - m1) / CASE WHEN b1 - a1 = 0 THEN 1 ELSE b1 - a1 END, 6) AS price_rs,
  round((l_quantity - m2) / CASE WHEN b2 - a2 = 0 THEN 1 ELSE b2 - a2 END, 6) AS qty_rs,
  round((rare - m3) / CASE WHEN b3 - a3 = 0 THEN 1 ELSE b3 - a3 END, 6) AS rare_rs
FROM sales, q""")
def robust_scale(spark, d):
    s = sales(spark, d)
    sc = RobustScaler(["l_extendedprice", "l_quantity", "rare"]).fit(
        s.filter(F.col("split") == "train"))
    ex = sc.expressions()
    return s.select(*KEY, r6(ex["l_extendedprice"]).alias("price_rs"),
                    r6(ex["l_quantity"]).alias("qty_rs"), r6(ex["rare"]).alias("rare_rs"))


@query("pca_variance")
def pca_variance(spark, d):
    from tessera.operators.stats import pca_keep_share
    e = read_table(spark, d, "embeddings")
    out, k = pca_keep_share(e, "embedding", ["vec_id", "label"], X.PCA_SHARE)
    return out.withColumn("k", F.lit(k))


# --- selection ------------------------------------------------------------------

_VAR_EXPR = {
    "l_quantity": "l_quantity", "price_k": "l_extendedprice / 1000",
    "l_discount": "l_discount", "l_tax": "l_tax", "rare": "rare", "const_one": "const_one",
    "copy_k": "price_copy / 1000", "p_size": "p_size", "age": "age",
}


@query("variance_filter", SALES_CTE + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS feature, {i} AS position, round(var_pop({e}), 6) AS var_pop, "
    f"round(var_samp({e}), 6) AS var_samp, "
    f"CASE WHEN var_pop({e}) > 0.01 THEN 1 ELSE 0 END AS kept_pop, "
    f"CASE WHEN var_samp({e}) > 0 THEN 1 ELSE 0 END AS kept_samp FROM sales"
    for i, (n, e) in enumerate(_VAR_EXPR.items())))
def variance_filter(spark, d):
    s = sales(spark, d).select(*[F.expr(e).alias(n) for n, e in _VAR_EXPR.items()])
    names = list(_VAR_EXPR)
    tab = variance_table(s, names)    # read off the rows once, for both filters too
    pop = set(VarianceFilter(names, 0.01, True).fit(s, tab).kept)
    samp = set(VarianceFilter(names, 0.0, False).fit(s, tab).kept)
    return tab.select(
        "feature", "position", r6("var_pop").alias("var_pop"), r6("var_samp").alias("var_samp"),
        F.col("feature").isin(list(pop)).cast("int").alias("kept_pop"),
        F.col("feature").isin(list(samp)).cast("int").alias("kept_samp"))


_CORR_COLS = ["l_extendedprice", "price_copy", "l_quantity", "l_discount", "l_tax", "net",
              "p_retailprice"]


def _corr_sql() -> str:
    rows = []
    for j, c in enumerate(_CORR_COLS):
        if j == 0:
            rows.append(f"SELECT '{c}' AS feature, 0 AS position, 0 AS dropped")
            continue
        else:
            best = ", ".join(f"abs(corr({_CORR_COLS[i]}, {c}))" for i in range(j))
            best = best if j > 1 else best
            cond = (f"CASE WHEN greatest({best}) > 0.98 THEN 1 ELSE 0 END" if j > 1 else
                    f"CASE WHEN {best} > 0.98 THEN 1 ELSE 0 END")
        rows.append(f"SELECT '{c}' AS feature, {j} AS position, {cond} AS dropped "
                    f"FROM sales WHERE split = 'train'")
    return SALES_CTE + "\n" + "\nUNION ALL\n".join(rows)


@query("correlation_filter", _corr_sql())
def correlation_filter(spark, d):
    s = sales(spark, d).filter(F.col("split") == "train")
    return CorrelationFilter(_CORR_COLS, X.CORRELATION_CUT).fit(s).report(spark)


_MI_WIDTHS = {"l_quantity": 5.0, "l_extendedprice": 5000.0, "l_discount": 0.011,
              "l_tax": 0.011, "l_linenumber": 1.0, "y": 0.5}
_MI_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _mi_sql(limit: int | None = None) -> str:
    bins = ", ".join(f"floor({c} / {w}) AS {c}" for c, w in _MI_WIDTHS.items() if c != "y")
    unp = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {i} AS position, {c} AS bx, yb FROM b"
        for i, c in enumerate(_MI_FEATS))
    tail = (f"ORDER BY mi DESC, position DESC LIMIT {limit}" if limit else "")
    return SALES_CTE + f"""
, b AS (SELECT {bins}, floor(y / {_MI_WIDTHS['y']}) AS yb FROM sales),
long AS ({unp}),
cells AS (SELECT feature, position, bx, yb, CAST(count(*) AS DOUBLE) AS n
          FROM long WHERE bx IS NOT NULL AND yb IS NOT NULL GROUP BY ALL),
m AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS nf,
             sum(n) OVER (PARTITION BY feature, bx) AS nx,
             sum(n) OVER (PARTITION BY feature, yb) AS ny FROM cells),
mi AS (SELECT feature, position, greatest(sum((n / nf) * ln((n * nf) / (nx * ny))), 0.0) AS mi
       FROM m GROUP BY feature, position)
SELECT feature, position, round(mi, 6) AS mi FROM mi {tail}"""


@query("mi_scores", _mi_sql())
def mi_scores(spark, d):
    s = sales(spark, d)
    sc = mutual_information(s, _MI_FEATS, "y", widths=_MI_WIDTHS)
    return sc.select("feature", "position", r6("mi").alias("mi"))


@query("mi_top_k", _mi_sql(3))
def mi_top_k(spark, d):
    s = sales(spark, d)
    sc = mutual_information(s, _MI_FEATS, "y", widths=_MI_WIDTHS)
    return top_k(sc, 3).select("feature", "position", r6("mi").alias("mi"))


@query("feature_sources", SALES_CTE + """
, f AS (
  SELECT 'l_returnflag_' || l_returnflag AS feature FROM sales
  UNION ALL SELECT 'l_linestatus_' || l_linestatus FROM sales
  UNION ALL SELECT 'facility_' || coalesce(facility, 'None') FROM sales),
shares AS (SELECT feature, count(*) / (SELECT count(*) FROM sales) AS p FROM f GROUP BY feature)
SELECT feature, split_part(feature, '_', 1) AS source FROM shares WHERE p * (1 - p) > 0.01""")
def feature_sources(spark, d):
    """Names of the one-hot features that pass the variance filter, with the
    source rule ``name up to the first '_'`` (K3, F6, X10)."""
    s = fill_constant(sales(spark, d).select(*_HOT_COLS), {"facility": "None"})
    hot = OneHot(_HOT_COLS).fit(s)
    wide = hot.transform(s)
    names = hot.dummy_names()
    kept = VarianceFilter(names, X.VARIANCE_CUT, True).fit(wide).kept
    return (variance_table(wide, names).filter(F.col("feature").isin(kept))
            .select("feature", X.name_source("feature").alias("source")))


@query("fold_assign", SALES_CTE + f"""
SELECT {KEY_SQL}, CAST({fold_sql(42, 5)} AS INTEGER) AS fold FROM sales""")
def fold_assign(spark, d):
    s = sales(spark, d).select(*KEY)
    return assign_folds(s, FOLD_KEY, 5, 42, FOLD_WEIGHTS)
