"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on: labels are UTC, and of two equal keys in one
# JSON object the last one counts. The last setting is for speed: lists are collected per
# video and per channel, and from 128 groups a task would sort its rows instead of hashing them.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results depend on."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("provtally")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def require_local(master: str) -> None:
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only when that is unset and the session runs
    on one machine is a temporary folder created, once per session; other masters are refused, as
    each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    named = spark.conf.get("provtally.work.dir", "")
    if not named:
        require_local(spark.sparkContext.master)
        named = tempfile.mkdtemp(prefix="provtally-")
        spark.conf.set("provtally.work.dir", named)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and go on from there, so that no job recomputes it."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
