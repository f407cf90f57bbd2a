"""Pin a dataset snapshot to its rows.

A digest that does not depend on the order of rows, so it is summed map-side and needs no sort: each row is
hashed to 60 bits and the hashes are added up modulo a prime, beside the number of rows. Equal multisets of rows have
equal digests; a lost, repeated or changed row changes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hexadecimal digits of a row's hash that count, and the modulus of their sum.
HASH_DIGITS, MODULUS = 15, (1 << 61) - 1


def row_hash(*columns: str) -> Column:
    """60 bits of the MD5 of a row's values, each with its length so that values cannot run together; null is apart from empty."""
    texts = [F.col(c).cast("string") for c in columns]
    marked = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.char_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    digits = F.substring(F.md5(F.encode(F.concat(*marked), "UTF-8")), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("decimal(38,0)")


def multiset_digests(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """(key, occurrences, digest) of the rows of each key over the given columns."""
    summed = rows.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"), F.sum(row_hash(*columns)).alias("_sum"))
    digest = F.concat(F.col("occurrences").cast("string"), F.lit("-"), (F.col("_sum") % F.lit(MODULUS)).cast("long").cast("string"))
    return summed.select(key, "occurrences", digest.alias("digest"))


def snapshot_digests(observations: DataFrame) -> DataFrame:
    """(dataset_id, occurrences, digest) of the retained rows of each dataset."""
    return multiset_digests(observations, "dataset_id", "dataset_id", "video_id")


def check_snapshots(observations: DataFrame, pinned: DataFrame) -> DataFrame:
    """One row per dataset of either side: pinned and found occurrences and digests, and a status.

    ``pinned`` is snapshot_digests of the rows a release was announced for. status is ``ok``, ``lost`` or
    ``added`` by the number of rows, ``changed`` where as many rows differ, ``missing`` without any
    row, and ``unpinned`` for a dataset that nothing was announced for.
    """
    want = pinned.select("dataset_id", F.col("occurrences").alias("pinned_occurrences"), F.col("digest").alias("pinned_digest"))
    both = snapshot_digests(observations).join(want, "dataset_id", "full_outer")
    status = (
        F.when(F.col("pinned_digest").isNull(), "unpinned")
        .when(F.col("digest").isNull(), "missing")
        .when(F.col("digest") == F.col("pinned_digest"), "ok")
        .when(F.col("occurrences") < F.col("pinned_occurrences"), "lost")
        .when(F.col("occurrences") > F.col("pinned_occurrences"), "added")
        .otherwise("changed")
    )
    return both.select("dataset_id", "pinned_occurrences", "occurrences", "pinned_digest", "digest", status.alias("status"))
