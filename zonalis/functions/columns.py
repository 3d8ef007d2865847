"""Scalar projections as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Latency servers and their order.
SERVERS = ["svr1", "svr2", "svr3", "svr4"]

# Unit spellings that are rescaled; every other unit leaves the number as it is.
KILO_SIZE = ["kb", "kbyte", "kbytes"]
GIGA_SIZE = ["gb", "gbyte", "gbytes"]
KILO_RATE = ["kb/s", "kbps"]
GIGA_RATE = ["gb/s", "gbps"]

# Accepted shape of a number after commas and outer blanks are removed.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Columns of a cleaned measurement, in order.
CLEAN_SCHEMA = T.StructType([
    T.StructField("time", T.LongType()),
    T.StructField("day_id", T.DateType()),
    T.StructField("convert_time", T.TimestampNTZType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("min", T.IntegerType()),
    T.StructField("sec", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("svr1", T.DoubleType()),
    T.StructField("svr2", T.DoubleType()),
    T.StructField("svr3", T.DoubleType()),
    T.StructField("svr4", T.DoubleType()),
    T.StructField("upload_mb", T.DoubleType()),
    T.StructField("upload_mbps", T.DoubleType()),
    T.StructField("download_mb", T.DoubleType()),
    T.StructField("download_mbps", T.DoubleType()),
    T.StructField("application_data", T.StringType()),
    T.StructField("square_id", T.StringType()),
])

# Zone-clustering columns and forecasting columns.
CLUSTERING_COLUMNS = [
    "square_id", "latitude", "longitude", "avg_latency", "std_latency", "total_throughput",
    "zone_avg_latency", "zone_avg_upload", "zone_avg_download",
]
FORECASTING_COLUMNS = {
    "hour": "hour", "day_id": "day_id", "is_peak_hours": "is_peak_hours", "square_id": "square_id",
    "avg_latency": "avg_latency", "upload_mbps": "upload_bitrate", "download_mbps": "download_bitrate",
    "avg_latency_lag1": "avg_latency_lag1", "upload_mbps_lag1": "upload_bitrate_lag1",
    "download_mbps_lag1": "download_bitrate_lag1",
}

# Spellings of targets and models in result tables.
TARGET_LABELS = {
    "avg latency": "avg_latency",
    "avg latency (ms)": "avg_latency",
    "average latency": "avg_latency",
    "avg latency ms": "avg_latency",
    "upload bitrate": "upload_bitrate",
    "upload (mbps)": "upload_bitrate",
    "upload mbps": "upload_bitrate",
    "download bitrate": "download_bitrate",
    "download (mbps)": "download_bitrate",
    "download mbps": "download_bitrate",
}
MODEL_LABELS = {
    "GRU-lean-v2": "GRU",
    "gru-lean-v2": "GRU",
    "LSTM-lean-v2": "LSTM",
    "lstm-lean-v2": "LSTM",
    "xgboost": "XGBoost",
    "arima": "ARIMA",
    "srnn": "SRNN",
}


def literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def parse_number(text: Column) -> Column:
    """Number in a text cell: commas and blanks dropped, anything unreadable becomes null."""
    bare = F.trim(F.translate(text.cast("string"), ",", ""))
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def unit_of(unit: Column) -> Column:
    return F.lower(F.coalesce(unit, F.lit("")))


def size_to_mb(amount: Column, unit: Column) -> Column:
    return parse_number(amount) * _factor(unit, KILO_SIZE, GIGA_SIZE)


def bitrate_to_mbps(amount: Column, unit: Column) -> Column:
    """Only the listed spellings are rescaled (kbits/sec is not), with 1024 as the step."""
    return parse_number(amount) * _factor(unit, KILO_RATE, GIGA_RATE)


def _factor(unit: Column, kilo: list[str], giga: list[str]) -> Column:
    """A power of two, so the product is exact and the number is parsed once."""
    name = unit_of(unit)
    return F.when(name.isin(kilo), 1 / 1024).when(name.isin(giga), 1024.0).otherwise(1.0)


def conform_schema(df: DataFrame, schema: T.StructType, sources: dict[str, list[str | Column]] | None = None) -> DataFrame:
    """Project to ``schema``: first source of a column that exists, cast; null where none does."""
    sources = sources or {}
    have = {c.lower() for c in df.columns}
    out = []
    for field in schema.fields:
        options = sources.get(field.name, [field.name])
        found = [o if isinstance(o, Column) else F.col(o) for o in options if isinstance(o, Column) or o.lower() in have]
        value = found[0] if found else F.lit(None)
        out.append(value.try_cast(field.dataType).alias(field.name))
    return df.select(*out)


def clean_measurements(raw: DataFrame) -> DataFrame:
    """Raw measurement (names already normalised) to the fixed clean columns; units converted."""
    have = set(raw.columns)

    def measured(convert, amount: str, unit: str) -> list:
        return [convert(F.col(amount), F.col(unit))] if {amount, unit} <= have else []

    return conform_schema(raw, CLEAN_SCHEMA, {
        "latitude": [parse_number(F.col("latitude"))],
        "longitude": [parse_number(F.col("longitude"))],
        "upload_mb": measured(size_to_mb, "transfer_size", "transfer_unit"),
        "upload_mbps": measured(bitrate_to_mbps, "bitrate", "bitrate_unit"),
        "download_mb": measured(size_to_mb, "transfer_size_rx", "transfer_unit_rx"),
        "download_mbps": measured(bitrate_to_mbps, "bitrate_rx", "bitrate_unit_rx"),
        "application_data": ["application_data", "send_data"],
    })


def coerce_numeric(df: DataFrame, columns: list[str], single: bool = False) -> DataFrame:
    kind = "float" if single else "double"
    return df.withColumns({c: parse_number(F.col(c)).cast(kind) for c in columns})


def make_day_id(year: Column, month: Column, day: Column) -> Column:
    """'YYYY-MM-DD' text; parts may be text, fractions are cut off; null when a part is unreadable."""
    def part(c: Column, digits: int) -> Column:
        whole = parse_number(c).cast("long").cast("string")
        return F.when(F.length(whole) < digits, F.lpad(whole, digits, "0")).otherwise(whole)

    parts = [part(year, 1), part(month, 2), part(day, 2)]
    return F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2])


def day_of(text: Column) -> Column:
    return F.coalesce(
        F.try_to_timestamp(text.cast("string"), F.lit("yyyy-M-d")).cast("date"), text.cast("string").try_cast("date")
    )


def derive_date_key(df: DataFrame, into: str = "date_key") -> DataFrame:
    """Day of a row from the best source present: date_key, dates (if it has any value), day_id, parts, convert_time."""
    have = set(df.columns)
    if "date_key" in have:
        value = day_of(F.col("date_key"))
    elif "dates" in have and not df.filter(F.col("dates").isNotNull()).isEmpty():
        value = day_of(F.col("dates"))
    elif "day_id" in have:
        value = day_of(F.col("day_id"))
    elif {"year", "month", "date"} <= have:
        value = day_of(make_day_id(F.col("year"), F.col("month"), F.col("date")))
    elif "convert_time" in have:
        value = F.col("convert_time").try_cast("timestamp_ntz").cast("date")
    else:
        raise ValueError("no column to derive a day from")
    return df.withColumn(into, value)


def unix_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a zone-free timestamp; unreadable text gives null."""
    whole = parse_number(seconds)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=whole.cast("decimal(18,6)"))


def calendar_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"date": F.to_date(ts), "hour": F.hour(ts), "day_name": F.date_format(ts, "EEEE")})


def time_features(df: DataFrame, day_columns: tuple[str, ...] = ("day", "day_id")) -> DataFrame:
    """hour_of_day, minute, and day_of_week from the first day column that exists."""
    present = [F.col(c).cast("string") for c in day_columns if c in df.columns]
    return df.withColumns({
        "hour_of_day": F.col("hour"), "minute": F.col("min"),
        "day_of_week": F.coalesce(*present) if present else F.lit(None).cast("string"),
    })


def binned(value: Column, upper: list[float], labels: list[str], low: float = 0.0) -> Column:
    """Right-closed bins, the lowest edge included; outside all bins gives null."""
    out = F.when(value.isNull() | (value < low), None)
    for edge, label in zip(upper, labels):
        out = out.when(value <= edge, label)
    return out


def time_of_day_bucket(hour: Column) -> Column:
    # greatest/least skip nulls, so the null hour is kept apart
    clipped = F.when(hour.isNotNull(), F.least(F.greatest(hour.cast("double"), F.lit(0.0)), F.lit(23.99)))
    return binned(clipped, [6, 12, 18, 24], ["night", "morning", "afternoon", "evening"])


def is_peak_hours(hour: Column) -> Column:
    return F.when(hour.between(7, 9) | hour.between(17, 19), 1).otherwise(0)


def latency_quality(latency: Column) -> Column:
    return binned(F.coalesce(latency, F.lit(0.0)), [50, 100, 200, float("inf")], ["excellent", "good", "fair", "poor"])


def throughput_quality(throughput: Column) -> Column:
    return binned(F.coalesce(throughput, F.lit(0.0)), [10, 50, 100, float("inf")], ["poor", "fair", "good", "excellent"])


def row_mean(columns: list[str]) -> Column:
    """Mean over the non-null cells of a row."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns[1:]), F.coalesce(F.col(columns[0]), F.lit(0.0)))
    return F.try_divide(total, row_count(columns))


def row_count(columns: list[str]) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNotNull().cast("int"))


def row_stats(df: DataFrame, columns: list[str] = SERVERS) -> DataFrame:
    """avg, min, max, sample std and range over the non-null cells of each row."""
    df = df.withColumn("avg_latency", row_mean(columns))
    squares = [F.coalesce((F.col(c) - F.col("avg_latency")) ** 2, F.lit(0.0)) for c in columns]
    count = row_count(columns)
    return df.withColumns({
        "min_latency": F.least(*columns),
        "max_latency": F.greatest(*columns),
        "std_latency": F.when(count > 1, F.sqrt(sum(squares[1:], squares[0]) / (count - 1))),
        "latency_range": F.greatest(*columns) - F.least(*columns),
    })


def throughput_features(df: DataFrame, up: str = "upload_mbps", down: str = "download_mbps") -> DataFrame:
    return df.withColumns({
        "total_throughput": F.col(up) + F.col(down),
        "upload_download_ratio": F.try_divide(F.col(up), F.col(down) + F.lit(1e-6)),
    })


def rounded(value: Column, places: int) -> Column:
    """Scale, round half to even, unscale: the array-library rounding, not the decimal one."""
    scale = float(10 ** places)
    return F.rint(value * scale) / scale


def location_hash(df: DataFrame) -> DataFrame:
    df = df.withColumns({"lat_rounded": rounded(F.col("latitude"), 3), "lon_rounded": rounded(F.col("longitude"), 3)})
    return df.withColumn("location_hash", F.concat_ws("_", *[
        F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in ("lat_rounded", "lon_rounded")
    ]))


def clustering_projection(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in CLUSTERING_COLUMNS if c in df.columns])


def forecasting_projection(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(n) for c, n in FORECASTING_COLUMNS.items() if c in df.columns])


def canonical_target_label(label: Column) -> Column:
    spaced = F.trim(F.regexp_replace(F.regexp_replace(F.lower(label), "[-_]", " "), r"\s+", " "))
    return F.coalesce(F.try_element_at(literal_map(TARGET_LABELS), spaced), F.regexp_replace(spaced, " ", "_"))


def canonical_model_label(label: Column) -> Column:
    bare = F.trim(label)
    return F.coalesce(F.try_element_at(literal_map(MODEL_LABELS), bare), bare)


def clean_non_finite(value: Column) -> Column:
    """Infinities and NaN become null."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def derive_mse(rmse: Column) -> Column:
    return rmse * rmse


# Columns that are never imputed.
NOT_TELEMETRY = [
    "time", "day_id", "date_key", "square_id", "year", "month", "date", "hour", "min", "sec", "latitude", "longitude",
]


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    numeric = (T.NumericType,)
    skip = set(exclude or [])
    return [f.name for f in df.schema.fields if isinstance(f.dataType, numeric) and f.name not in skip]


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One pass: (column_name, null_count)."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return one.select(F.explode(entries).alias("e")).select("e.*")


def columns_to_impute(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Numeric telemetry columns that have at least one null."""
    candidates = numeric_columns(df, [*NOT_TELEMETRY, *(exclude or [])])
    return [r[0] for r in null_counts(df, candidates).filter("null_count > 0").collect()] if candidates else []


def non_string_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.StringType) and f.name not in set(exclude or [])]
