"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "zonalis", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators rely on; everything else stays with the cluster's own configuration."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master without that setting gets a temporary
    folder of its own; on a cluster a machine-local folder would be lost with its executor, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="zonalis-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder
