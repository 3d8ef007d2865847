"""Readers: CSV sets, paired splits, result tables, header normalisation."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.functions.columns import canonical_model_label, canonical_target_label, coerce_numeric, derive_mse

# Header spellings of the forecasting tables and their canonical names.
HEADER_ALIASES = {
    "upload_bitrate_mbits/sec": "upload_bitrate",
    "download_bitrate_rx_mbits/sec": "download_bitrate",
    "download_bitrate_rx_mbytes": "download_bitrate",
    "avg_latency_lag_1": "avg_latency_lag1",
    "avg_latencylag1": "avg_latency_lag1",
    "avg_latencylag_1": "avg_latency_lag1",
    "upload_bitrate_mbits/sec_lag1": "upload_bitrate_lag1",
    "upload_bitrate_lag_1": "upload_bitrate_lag1",
    "download_bitrate_rx_mbits/sec_lag1": "download_bitrate_lag1",
    "download_bitrate_rx_mbytes_lag1": "download_bitrate_lag1",
    "download_bitrate_lag_1": "download_bitrate_lag1",
}
RESULT_COLUMNS = ["target", "model", "mae", "rmse", "mse", "r2"]
REQUIRED_RESULT_COLUMNS = ["target", "mae", "rmse"]


def normalize_headers(df: DataFrame, aliases: dict[str, str] | None = None, snake: bool = False) -> DataFrame:
    """Trim and lower-case names, apply ``aliases``; headers that become equal are merged, first non-null wins."""
    aliases = HEADER_ALIASES if aliases is None else aliases

    def canonical(name: str) -> str:
        name = name.strip().lower()
        if snake:
            name = re.sub(r"[^0-9a-z]+", "_", name).strip("_")
        return aliases.get(name, "r2" if name.replace("^", "").replace("_", "") == "r2" else name)

    raw = [f"__{i}" for i in range(len(df.columns))]
    groups: dict[str, list[str]] = {}
    for position, name in zip(raw, df.columns):
        groups.setdefault(canonical(name), []).append(position)
    plain = df.toDF(*raw)
    return plain.select(*[(F.coalesce(*m) if len(m) > 1 else F.col(m[0])).alias(n) for n, m in groups.items()])


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, through the file system the cluster uses."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in found) if found else []


def data_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Files among ``paths`` and inside the folders among them, hidden ones left out."""
    out = []
    for path in paths:
        file = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if system.getFileStatus(file).isDirectory():
            inside = [s.getPath() for s in system.listStatus(file)]
            out += data_files(spark, sorted(p.toString() for p in inside if p.getName()[0] not in "_."))
        else:
            out.append(path)
    return out


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a text file, plain or compressed; only its first buffer is read."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
    stream = file.getFileSystem(conf).open(file)
    try:
        body = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(body, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def read_csv_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Union by name of all CSV files that match; text columns, absent ones null.

    Headers may differ between files. Only the first line of each file is read to learn its header, and files are grouped
    by it, so the plan has one scan per distinct header and not one per file.
    """
    files = data_files(spark, list_files(spark, pattern))
    if not files:
        raise FileNotFoundError(pattern)
    by_header: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, header in zip(files, pool.map(lambda f: first_line(spark, f), files)):
            by_header.setdefault(header, []).append(file)
    frames = [
        normalize_headers(spark.read.option("header", True).option("enforceSchema", False).csv(paths), {}, snake=True)
        for _, paths in sorted(by_header.items())
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet folder, or CSV with header when the name says so."""
    return spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)


def read_first_existing(spark: SparkSession, paths: list[str]) -> DataFrame:
    for path in paths:
        if list_files(spark, path):
            return read_table(spark, path)
    raise FileNotFoundError(f"none of these exist: {paths}")


def read_train_test(spark: SparkSession, train: str, test: str) -> tuple[DataFrame, DataFrame]:
    missing = [p for p in (train, test) if not list_files(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing split tables: {missing}")
    return read_table(spark, train), read_table(spark, test)


def conform_results(df: DataFrame, model: str | None = None) -> DataFrame:
    """Metric rows with canonical labels: target, model, mae, rmse, mse, r2."""
    df = normalize_headers(df, {})
    missing = [c for c in REQUIRED_RESULT_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"result table lacks columns {missing}")
    if model:
        df = df.withColumn("model", F.lit(model))
    for name in RESULT_COLUMNS:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string" if name == "model" else "double"))
    df = coerce_numeric(df, ["mae", "rmse", "r2"])
    return df.withColumns({
        "target": canonical_target_label(F.col("target")),
        "model": canonical_model_label(F.col("model")),
        "mse": derive_mse(F.col("rmse")),
    }).select(*RESULT_COLUMNS)


def read_results_table(spark: SparkSession, path: str, model: str | None = None) -> DataFrame:
    """One model's metric table; without a model column the file stem names the model."""
    df = read_table(spark, path)
    if model is None and "model" not in [c.strip().lower() for c in df.columns]:
        stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.[^./]*)?$", 1)
        df = df.select("*", stem.alias("model"))
    return conform_results(df, model)


