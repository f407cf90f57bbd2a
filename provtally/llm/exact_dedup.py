"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest, one row per distinct text ever seen, with the
id that stays. A batch is reduced to one row per digest map-side, anti-joined to the index by
sort-merge (the index side is not shuffled again; each append adds files to its buckets, so Spark sorts
it there once more) and what is new is appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provtally.llm.common import stored, utf8_text, with_group
from provtally.session import new_folder

BUCKETS = 64


def digest(text_col: str = "text") -> Column:
    """SHA-256 of the text in UTF-8, lower-case hex; null counts as empty."""
    return F.sha2(F.encode(utf8_text(text_col), "UTF-8"), 256)


class DigestIndex:
    """Digests of all texts seen so far, in a folder; opening a folder again continues it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        if not spark.catalog.tableExists(self.table):
            spark.sql(
                f"CREATE TABLE {self.table} (digest STRING, keep_id BIGINT) USING parquet"
                f" CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
            )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of the batch (one per digest) whose digest the index lacks."""
        return batch.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, batch: DataFrame) -> None:
        """Add (digest, keep_id) rows; a batch that failed half-way is run again, unseen() drops what got in."""
        rows = batch.select("digest", "keep_id").repartition(self.buckets, "digest")
        writer = rows.write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest")
        writer.saveAsTable(self.table)


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256; the index learns what is new.

    Texts are equal when identical, null as empty. Of equal texts new to the index the row of the
    largest id stays (null ids are least; of rows equal in both, one); of a text in the index, none
    does and keep_id is the index's. group_size counts the batch's rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(text_col).alias("digest"))
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), "digests")
    last = F.max(F.struct("doc_id", "place")).alias("last")
    groups = stored(rows.groupBy("digest").agg(last, F.count(F.lit(1)).alias("group_size")), "groups")
    batch = groups.select("digest", "group_size", F.col("last.doc_id").alias("keep_id"), F.col("last.place").alias("keep_place"))
    fresh = stored(index.unseen(batch), "fresh")
    known = index.rows().groupBy("digest").agg(F.max("keep_id").alias("keep_id"))
    known = batch.select("digest", "group_size").join(known.hint("merge"), "digest")
    known = known.withColumn("keep_place", F.lit(None).cast("long")).select(*fresh.columns)
    decided = stored(fresh.unionByName(known), "decided")
    index.append(fresh)
    out = with_group(rows, decided, "digest", "group_size", F.concat(F.lit("row "), F.col("place").cast("string")))
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("place") == F.col("keep_place"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def document_duplicates(docs: DataFrame) -> DataFrame:
    """Dedup of one corpus by itself: an index that starts empty, in the shared folder."""
    spark = docs.sparkSession
    return deduplicate(docs, DigestIndex(spark, new_folder(spark, "digest-index")))
