"""Session helpers. On a cluster the session is given; `local_session` serves tests and bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("panelmint")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", os.environ.get("PANELMINT_SHUFFLE", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC wall-clock values; epoch conversions read the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names. Only a local session gets a scratch folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="panelmint-checkpoint-"))


def written_once(frame: DataFrame) -> DataFrame:
    """Write a table that several plans read to the checkpoint folder; it is computed once."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()
