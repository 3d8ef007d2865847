"""Write an intermediate once, read it back with its true size known."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from zonalis.session import shared_dir

BROADCAST_BYTES = 32 * 1024 * 1024


def materialize(df: DataFrame) -> DataFrame:
    """Store ``df`` as Parquet in the shared folder and return the stored copy.

    The copy has a one-node plan, survives the loss of executors, is column-pruned like any Parquet table, and its
    size is the size of real files, so a later join can decide on a broadcast from fact instead of from an estimate.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/zonalis-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def size_in_bytes(df: DataFrame) -> int:
    """Size the optimizer knows for ``df``; exact file bytes for a materialised table."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return size_in_bytes(df) <= limit
