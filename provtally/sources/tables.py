"""The engine's input tables: their columns, and how to store them for repeated releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBSERVATIONS = "dataset_id string, video_id string"
RESOLUTIONS = "video_id string, state string, channel_key bigint"
CHANNELS = "channel_key bigint, display_name string, country string, last_observed_at string"
REMOVALS = "channel_key bigint"
DATASETS = (
    "dataset_id string, display_name string, version string, corpus_class string, source_kind string,"
    " occurrence_unit string, source_citation string, snapshot_digest string"
)
FILTERS = (
    "position int, filter_key string, label string, path string, datasets array<string>,"
    " corpus_classes array<string>, is_default boolean"
)


def read_table(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """A Parquet input read under its declared columns; nothing is inferred, other columns are not read."""
    return spark.read.schema(columns).parquet(path)


def store_by_video(df: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Keep a table bucketed and sorted by video.

    Observations and resolutions stored with the same bucket count meet without a shuffle, so a
    further release over them shuffles nothing but counts.
    """
    df.write.bucketBy(buckets, "video_id").sortBy("video_id").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
