"""The house-sale workflow on its own CSV files (labelled + unlabelled).

Reads both halves with an explicit schema, cleans and encodes them the
way the studied best pipeline does, and predicts the unlabelled prices
with the same ensemble as :mod:`tessera.plans.pipeline`. Every step is an
operator of this package, so the whole run is a sequence of Spark jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, NumericType, StringType,
                               StructField, StructType)

from tessera.functions import expr as X
from tessera.operators.encode import LabelEncoder, OneHot, graded
from tessera.operators.impute import (GroupMeanFeature, GroupMedianImputer, ModeImputer,
                                      drop_outliers, fill_constant)
from tessera.operators.select import CorrelationFilter, VarianceFilter
from tessera.operators.stats import BoxCoxSkewed
from tessera.sources.tables import labelled_unlabelled, read_csv_table
from tessera.runtime import stage

# Header and types of the public house-sale files (80 columns
# plus SalePrice in the labelled file); "d" = double (may hold NA),
# "i" = integer, "s" = text.
HOUSE_COLUMNS = [
    ("Id", "i"), ("MSSubClass", "i"), ("MSZoning", "s"), ("LotFrontage", "d"),
    ("LotArea", "i"), ("Street", "s"), ("Alley", "s"), ("LotShape", "s"),
    ("LandContour", "s"), ("Utilities", "s"), ("LotConfig", "s"), ("LandSlope", "s"),
    ("Neighborhood", "s"), ("Condition1", "s"), ("Condition2", "s"), ("BldgType", "s"),
    ("HouseStyle", "s"), ("OverallQual", "i"), ("OverallCond", "i"), ("YearBuilt", "i"),
    ("YearRemodAdd", "i"), ("RoofStyle", "s"), ("RoofMatl", "s"), ("Exterior1st", "s"),
    ("Exterior2nd", "s"), ("MasVnrType", "s"), ("MasVnrArea", "d"), ("ExterQual", "s"),
    ("ExterCond", "s"), ("Foundation", "s"), ("BsmtQual", "s"), ("BsmtCond", "s"),
    ("BsmtExposure", "s"), ("BsmtFinType1", "s"), ("BsmtFinSF1", "d"), ("BsmtFinType2", "s"),
    ("BsmtFinSF2", "d"), ("BsmtUnfSF", "d"), ("TotalBsmtSF", "d"), ("Heating", "s"),
    ("HeatingQC", "s"), ("CentralAir", "s"), ("Electrical", "s"), ("1stFlrSF", "i"),
    ("2ndFlrSF", "i"), ("LowQualFinSF", "i"), ("GrLivArea", "i"), ("BsmtFullBath", "d"),
    ("BsmtHalfBath", "d"), ("FullBath", "i"), ("HalfBath", "i"), ("BedroomAbvGr", "i"),
    ("KitchenAbvGr", "i"), ("KitchenQual", "s"), ("TotRmsAbvGrd", "i"), ("Functional", "s"),
    ("Fireplaces", "i"), ("FireplaceQu", "s"), ("GarageType", "s"), ("GarageYrBlt", "d"),
    ("GarageFinish", "s"), ("GarageCars", "d"), ("GarageArea", "d"), ("GarageQual", "s"),
    ("GarageCond", "s"), ("PavedDrive", "s"), ("WoodDeckSF", "i"), ("OpenPorchSF", "i"),
    ("EnclosedPorch", "i"), ("3SsnPorch", "i"), ("ScreenPorch", "i"), ("PoolArea", "i"),
    ("PoolQC", "s"), ("Fence", "s"), ("MiscFeature", "s"), ("MiscVal", "i"), ("MoSold", "i"),
    ("YrSold", "i"), ("SaleType", "s"), ("SaleCondition", "s"),
]
TARGET = "SalePrice"

# The cleaning and encoding lists of the best pipeline.
FILL_NONE = ["PoolQC", "MiscFeature", "Alley", "Fence", "FireplaceQu", "GarageType",
             "GarageFinish", "GarageQual", "GarageCond", "BsmtQual", "BsmtCond",
             "BsmtExposure", "BsmtFinType1", "BsmtFinType2", "MasVnrType"]
FILL_ZERO = ["GarageYrBlt", "GarageArea", "GarageCars", "BsmtFinSF1", "BsmtFinSF2",
             "BsmtUnfSF", "TotalBsmtSF", "BsmtFullBath", "BsmtHalfBath", "MasVnrArea"]
FILL_MODE = ["MSZoning", "Electrical", "KitchenQual", "Exterior1st", "Exterior2nd",
             "SaleType"]
FILL_DEFAULT = {"Functional": "Typ"}
DROPPED = ["Utilities"]
AS_TEXT = ["MSSubClass", "OverallCond", "YrSold", "MoSold"]
LABEL_CODED = ["FireplaceQu", "BsmtQual", "BsmtCond", "GarageQual", "GarageCond",
               "ExterQual", "ExterCond", "HeatingQC", "PoolQC", "KitchenQual", "BsmtFinType1",
               "BsmtFinType2", "Functional", "Fence", "BsmtExposure", "GarageFinish",
               "LandSlope", "LotShape", "PavedDrive", "Street", "Alley", "CentralAir",
               "MSSubClass", "OverallCond", "YrSold", "MoSold"]
OUTLIER_AREA, OUTLIER_PRICE = 4000, 300000
# What the label-coded pipelines differ in. ``means``: columns averaged by
# neighbourhood; ``hand``: constructed features; ``variance``: the cut of the last filter.
CODED_VARIANTS = {
    "best": dict(means=["OverallQual"], hand=["TotalSF", "TotalBath", "OverallQual_TotalSF"], variance=X.VARIANCE_CUT),
    "two_means": dict(means=["OverallQual", "YearBuilt"], hand=["TotalSF"], variance=X.VARIANCE_CUT),
    "unfiltered": dict(means=[], hand=["TotalSF", "TotalBath", "HasBsmt", "Has2ndFloor", "HasFireplace"], variance=None,
                       modes=["Functional"]),
}


def house_schema(labelled: bool) -> StructType:
    kinds = {"d": DoubleType(), "i": IntegerType(), "s": StringType()}
    fields = [StructField(n, kinds[k]) for n, k in HOUSE_COLUMNS]
    if labelled:
        fields.append(StructField(TARGET, DoubleType()))
    return StructType(fields)


def read_house(spark: SparkSession, train_path: str, test_path: str) -> tuple[DataFrame, DataFrame]:
    """Both halves with the explicit schema; NA tokens become nulls."""
    return (read_csv_table(spark, train_path, house_schema(True)),
            read_csv_table(spark, test_path, house_schema(False)))


def documented_hand_features() -> list:
    """The 13 constructed features of the documented pipeline."""
    total_sf = X.total("TotalBsmtSF", "1stFlrSF", "2ndFlrSF")
    return [
        total_sf.alias("TotalSF"),
        X.total("OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch",
                "WoodDeckSF").alias("TotalPorchSF"),
        X.weighted_total({"FullBath": 1.0, "HalfBath": 0.5, "BsmtFullBath": 1.0,
                          "BsmtHalfBath": 0.5}).alias("TotalBathrooms"),
        X.presence_flag("PoolArea").alias("HasPool"),
        X.presence_flag("2ndFlrSF").alias("Has2ndFloor"),
        X.presence_flag("GarageArea").alias("HasGarage"),
        X.presence_flag("TotalBsmtSF").alias("HasBsmt"),
        X.presence_flag("Fireplaces").alias("HasFireplace"),
        (F.col("YrSold") - F.col("YearBuilt")).alias("HouseAge"),
        (F.col("YrSold") - F.col("YearRemodAdd")).alias("RemodAge"),
        X.equal_flag("YearBuilt", "YrSold").alias("IsNewHouse"),
        (F.col("OverallQual") * total_sf).alias("OverallQual_TotalSF"),
        (F.col("OverallQual") * F.col("GrLivArea")).alias("OverallQual_GrLivArea"),
    ]


def coded_hand_features() -> dict:
    """The constructed features of the label-coded pipelines by name."""
    total_sf = X.total("TotalBsmtSF", "1stFlrSF", "2ndFlrSF")
    return {
        "TotalSF": total_sf,
        "TotalBath": X.weighted_total({"FullBath": 1.0, "HalfBath": 0.5, "BsmtFullBath": 1.0, "BsmtHalfBath": 0.5}),
        "OverallQual_TotalSF": F.col("OverallQual") * total_sf,
        "HasBsmt": X.presence_flag("TotalBsmtSF"),
        "Has2ndFloor": X.presence_flag("2ndFlrSF"),
        "HasFireplace": X.presence_flag("Fireplaces"),
    }


@dataclass
class HouseFeatures:
    """Cleaning + encoding of the house-sale files.

    ``variant="best"``: the best-scoring pipeline (label codes, neighbourhood
    mean of quality, three hand features, population variance > 0.01, all
    statistics over both halves). ``"two_means"``: the same with the neighbourhood
    mean of the building year too, and the total area as the only hand feature.
    ``"unfiltered"``: label codes, five hand features (total area, baths, three
    flags), the mode also for ``Functional``, no neighbourhood mean and no filter:
    every encoded column is a feature. ``"documented"``: graded maps for
    17 columns, the 13 hand features, modes also for ``Functional``, then
    sample variance > 0 and the 0.98 correlation filter fitted on the
    labelled half.
    """

    variant: str = "best"
    features: list[str] = field(default_factory=list)

    def build(self, train: DataFrame, test: DataFrame) -> DataFrame:
        train = drop_outliers(train, (F.col("GrLivArea") > OUTLIER_AREA)
                              & (F.col(TARGET) < OUTLIER_PRICE))
        train = train.withColumn("y", X.log_target(TARGET)).drop(TARGET)
        s = labelled_unlabelled(train, test)
        if self.variant == "documented":
            return self._documented(s)
        return self._coded(s, **CODED_VARIANTS[self.variant])

    def _coded(self, s: DataFrame, means: list[str], hand: list[str], variance: float | None, modes: list[str] = ()) -> DataFrame:
        s = fill_constant(s, {**{c: "None" for c in FILL_NONE}, **{c: 0.0 for c in FILL_ZERO},
                              **{c: v for c, v in FILL_DEFAULT.items() if c not in modes}})
        s = ModeImputer([*FILL_MODE, *modes]).fit(s).transform(s)
        s = GroupMedianImputer(["LotFrontage"], "Neighborhood").fit(s).transform(s)
        # the fits below read the cleaned rows, not the files and the fits above
        s = stage(s.drop(*DROPPED), "house-clean")
        for c in means:
            s = GroupMeanFeature(c, "Neighborhood", f"Neighborhood_{c}").fit(s).transform(s)
        made = coded_hand_features()
        s = s.select(*[c for c in s.columns if c not in AS_TEXT],
                     *[F.coalesce(X.code_as_text(c), F.lit("None")).alias(c) for c in AS_TEXT],
                     *[made[c].alias(c) for c in hand])
        s = stage(LabelEncoder(LABEL_CODED).fit(s).transform(s), "house-coded")
        numeric = [f.name for f in s.schema.fields
                   if isinstance(f.dataType, NumericType) and f.name not in ("Id", "y")]
        nominal = [f.name for f in s.schema.fields
                   if isinstance(f.dataType, StringType) and f.name != "split"]
        s = stage(BoxCoxSkewed(numeric).fit(s).transform(s), "house-scaled")
        hot = OneHot(nominal).fit(s)
        s = stage(hot.transform(s), "house-dummies")
        self.features = numeric + hot.dummy_names()
        if variance is not None:
            self.features = VarianceFilter(self.features, variance, True).fit(s).kept
        return s.select("Id", "split", "y",
                        *[X.nan_to_zero(F.col(f"`{c}`")).alias(c) for c in self.features])

    def _documented(self, s: DataFrame) -> DataFrame:
        s = fill_constant(s, {**{c: "None" for c in FILL_NONE}, **{c: 0.0 for c in FILL_ZERO}})
        s = ModeImputer(FILL_MODE + ["Functional"]).fit(s).transform(s)
        s = GroupMedianImputer(["LotFrontage"], "Neighborhood").fit(s).transform(s)
        s = stage(s.drop(*DROPPED), "house-clean")
        s = s.select(*s.columns, *documented_hand_features())
        s = graded(s, X.GRADED_MAPS)
        s = s.withColumn("MSSubClass", X.code_as_text("MSSubClass"))
        numeric = [f.name for f in s.schema.fields
                   if isinstance(f.dataType, NumericType) and f.name not in ("Id", "y")]
        nominal = [f.name for f in s.schema.fields
                   if isinstance(f.dataType, StringType) and f.name != "split"]
        s = stage(BoxCoxSkewed(numeric).fit(s).transform(s), "house-scaled")
        hot = OneHot(nominal).fit(s)
        s = stage(hot.transform(s), "house-dummies")
        candidates = numeric + hot.dummy_names()
        labelled = s.filter(F.col("split") == "train")
        var = VarianceFilter(candidates, 0.0, population=False).fit(labelled)
        corr = CorrelationFilter(var.kept, X.CORRELATION_CUT).fit(labelled)
        self.features = corr.kept
        return s.select("Id", "split", "y",
                        *[X.nan_to_zero(F.col(f"`{c}`")).alias(c) for c in self.features])


def run_house(spark: SparkSession, train_path: str, test_path: str,
              out_path: str | None = None, opts=None, variant: str = "best") -> DataFrame:
    """Whole workflow: read → features → what ``opts.mode`` asks for (E8); its
    tables are written under ``out_path`` if that is given."""
    from tessera.plans.pipeline import _RESULT, Options, run_modes
    opts = opts or Options(clip=X.CLIP_RANGE)
    train, test = read_house(spark, train_path, test_path)
    fe = HouseFeatures(variant)
    feats = stage(fe.build(train, test), "house-features")
    return run_modes(feats, fe.features, opts, ["Id"], out_path)[_RESULT[opts.mode]]
