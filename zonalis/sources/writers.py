"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType([
    T.StructField("run_at", T.TimestampType()),
    T.StructField("model", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("error", T.StringType()),
])


def write_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if form == "csv" else writer.format(form).save(path)


def write_by_day(df: DataFrame, path: str, day: str = "day_id", rows_per_file: int = 5_000_000) -> None:
    """One folder per day. Rows are spread by day and a hash, with as many parts as the busiest day needs, so no task
    gets a whole busy day and a quiet day still makes few files."""
    counts = df.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    parts = -(-(counts.agg(F.max("n")).first()[0] or 1) // rows_per_file)
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(parts))
    df.repartition(F.col(day), spread).write.mode("overwrite").option("maxRecordsPerFile", 4 * rows_per_file).partitionBy(day).parquet(path)


def write_json_summary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_run_record(
    spark: SparkSession, path: str, model: str, params: dict, metrics: dict, target: str | None = None, error: str | None = None
) -> None:
    """Add one run to the history table; a failed run carries its error text."""
    row = [(model, target, {k: str(v) for k, v in params.items()}, {k: None if v is None else float(v) for k, v in metrics.items()}, error)]
    fields = [f for f in RUN_SCHEMA.fields if f.name != "run_at"]
    record = spark.createDataFrame(row, T.StructType(fields)).withColumn("run_at", F.current_timestamp())
    record.select(*RUN_SCHEMA.names).write.mode("append").parquet(path)


def read_run_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path).orderBy(F.col("run_at").desc())


def write_cluster_assignments(rows: DataFrame, labels: DataFrame, path: str, samples: DataFrame | None = None) -> None:
    """Features with label and, when given, silhouette and outlier flag per row."""
    out = rows.join(labels, "id", "left")
    if samples is not None:
        out = out.join(samples.select("id", "silhouette", "is_outlier"), "id", "left")
    write_table(out, path)
