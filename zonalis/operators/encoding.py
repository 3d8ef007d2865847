"""Category codes, scaling, feature selection and projection."""

from __future__ import annotations

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions.columns import clean_non_finite
from zonalis.plans.numbering import global_index
from zonalis.plans.quantiles import HOT_ROWS, column_name, exact_percentiles
from zonalis.plans.skew import lookup_join


def category_codes(frames: list[DataFrame], column: str) -> DataFrame:
    """(column, code): position of each value among the sorted values of all frames."""
    values = frames[0].select(column)
    for frame in frames[1:]:
        values = values.unionByName(frame.select(column))
    return global_index(values.filter(F.col(column).isNotNull()).distinct(), [column], f"{column}_code")


def encode_categories(train: DataFrame, test: DataFrame, columns: list[str], null_text: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Codes fitted on train and test together; null is -1, or gets the code of ``null_text`` when given."""
    for column in columns:
        if null_text is not None:
            train, test = (df.withColumn(column, F.coalesce(column, F.lit(null_text))) for df in (train, test))
        codes = category_codes([train, test], column)
        train, test = (
            lookup_join(df, codes, [column]).withColumn(f"{column}_code", F.coalesce(f"{column}_code", F.lit(-1).cast("long")))
            for df in (train, test)
        )
    return train, test


class Scaler:
    """Per-column shift and divisor, fitted once by a single aggregate row."""

    def __init__(self, shift: dict[str, float], divisor: dict[str, float]):
        self.shift, self.divisor = shift, divisor

    @classmethod
    def standard(cls, train: DataFrame, columns: list[str]) -> "Scaler":
        """(x - mean) / population deviation; a constant column keeps divisor 1."""
        row = train.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).first()
        return cls({c: row[c]["m"] or 0.0 for c in columns}, {c: row[c]["s"] or 1.0 for c in columns})

    @classmethod
    def minmax(cls, train: DataFrame, columns: list[str]) -> "Scaler":
        """(x - min) / range; a constant column keeps divisor 1."""
        row = train.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in columns]).first()
        span = {c: (row[c]["hi"] or 0.0) - (row[c]["lo"] or 0.0) for c in columns}
        return cls({c: row[c]["lo"] or 0.0 for c in columns}, {c: span[c] or 1.0 for c in columns})

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - self.shift[c]) / self.divisor[c] for c in self.shift})

    def invert(self, value: Column, column: str) -> Column:
        return value * self.divisor[column] + self.shift[column]


def standard_scale(train: DataFrame, test: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    scaler = Scaler.standard(train, columns)
    return scaler.apply(train), scaler.apply(test)


def minmax_scale(train: DataFrame, test: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    scaler = Scaler.minmax(train, columns)
    return scaler.apply(train), scaler.apply(test)


def impute_feature_median(train: DataFrame, test: DataFrame, columns: list[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Infinities count as missing; both splits take the exact training median."""
    train, test = (df.withColumns({c: clean_non_finite(F.col(c).cast("double")) for c in columns}) for df in (train, test))
    medians = exact_percentiles(train, [], columns, [0.5], hot_rows).first()
    fills = {c: medians[column_name(c, 0.5)] for c in columns}
    return tuple(df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in fills.items() if v is not None}) for df in (train, test))


def align_target(df: DataFrame, target: str) -> DataFrame:
    """Rows with a finite target."""
    value = clean_non_finite(F.col(target).cast("double"))
    return df.withColumn(target, value).filter(F.col(target).isNotNull())


def _long(row: DataFrame, features: list[str], name: str) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").alias(name)) for f in features])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def select_f_regression(df: DataFrame, features: list[str], target: str, k: int) -> DataFrame:
    """(feature, f_value) of the ``k`` strongest by the univariate F statistic; correlations come from one pass."""
    measures = [F.struct(F.corr(f, target).alias("r"), F.count_if(F.col(f).isNotNull() & F.col(target).isNotNull()).alias("n")).alias(f) for f in features]
    r2 = F.col("s.r") * F.col("s.r")
    scored = _long(df.agg(*measures), features, "s").select("feature", F.try_divide(r2 * (F.col("s.n") - 2), 1 - r2).alias("f_value"))
    return scored.orderBy(F.col("f_value").desc_nulls_last(), "feature").limit(k)


def select_mutual_info(df: DataFrame, features: list[str], target: str, k: int, bins: int = 16, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(feature, mutual_info) in nats over quantile bins of feature and target, rows with both present."""
    probabilities = [i / bins for i in range(1, bins)]
    edges = exact_percentiles(df, [], [*features, target], probabilities, hot_rows).first()

    def bucket(c: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(edges[column_name(c, q)]) for q in probabilities]), lambda e: e < F.col(c)))

    entries = F.array(*[F.struct(F.lit(f).alias("feature"), F.when(F.col(f).isNotNull(), bucket(f)).alias("x"), F.lit(0).alias("z")) for f in features])
    pairs = df.filter(F.col(target).isNotNull()).select(bucket(target).alias("y"), F.explode(entries).alias("e")).select("e.feature", "e.x", "y")
    joint = pairs.filter(F.col("x").isNotNull()).groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    # the joint counts are features x bins x bins rows, whatever the number of input rows
    x = joint.groupBy("feature", "x").agg(F.sum("n").alias("nx"))
    y = joint.groupBy("feature", "y").agg(F.sum("n").alias("ny"))
    t = joint.groupBy("feature").agg(F.sum("n").alias("nt"))
    all_ = joint.join(x, ["feature", "x"]).join(y, ["feature", "y"]).join(t, "feature")
    term = F.col("n") / F.col("nt") * F.log(F.col("n") * F.col("nt") / (F.col("nx") * F.col("ny")))
    return all_.groupBy("feature").agg(F.sum(term).alias("mutual_info")).orderBy(F.col("mutual_info").desc(), "feature").limit(k)


def assembled(df: DataFrame, features: list[str], into: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=into, handleInvalid="skip").transform(df)


def select_rf_importance(df: DataFrame, features: list[str], target: str, k: int, trees: int = 100, depth: int = 5, seed: int = 42) -> DataFrame:
    ready = assembled(df.filter(F.col(target).isNotNull()), features, "__f").select("__f", F.col(target).cast("double").alias("__y"))
    model = RandomForestRegressor(featuresCol="__f", labelCol="__y", numTrees=trees, maxDepth=depth, seed=seed).fit(ready)
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature").limit(k)


def pca_2d(df: DataFrame, features: list[str]) -> DataFrame:
    """First two principal coordinates of the centred features as pc1, pc2 (sign is free)."""
    means = df.agg(*[F.avg(c).alias(c) for c in features]).first()
    centred = df.select("*", *[(F.col(c) - F.lit(means[c])).alias(f"__c_{c}") for c in features])
    ready = assembled(centred, [f"__c_{c}" for c in features], "__f")
    model = PCA(k=2, inputCol="__f", outputCol="__p").fit(ready)
    out = model.transform(ready).withColumn("__a", vector_to_array("__p"))
    return out.withColumns({"pc1": F.col("__a")[0], "pc2": F.col("__a")[1]}).select(*df.columns, "pc1", "pc2")


