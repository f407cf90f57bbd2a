"""The engine's input tables, derived from the TPC-H-like test tables.

Everything is a projection of a given table, so each input grows with its source. The same
mapping, as SQL text, heads every oracle query (``ORACLE_CTES``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provtally.functions.sql import text_array
from provtally.sources.catalog import Catalog, Dataset, PublishedFilter

RELEASE_ID = "fixture-1"
PAGE_SIZE = 20
DISCLOSURE_THRESHOLD = 3
KEY_SALT = "fixture"
GENERATED_AT = "2024-01-31T09:05:00Z"
ENRICHMENT_CUTOFF = "2024-01-20T00:00:00Z"
LAST_OBSERVED = "2024-01-19"

# Country codes by nation key.
NATION_CODES = (
    "US GB CA AU DE FR ES IT BR MX AR IN JP KR CN ID NG ZA EG KE SE NO PL TR NZ".split()
)

# (returnflag, linestatus) pairs of the line items, as (dataset flag, unit, source kind).
_FLAGS = {"a": ("Clip", "MediaIndex"), "n": ("Video", "MetadataOnly"), "r": ("Segment", "SubtitleIndex")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _video_id(key: str) -> Column:
    return F.expr(
        f"if({key} % 97 = 0, concat('bad!', {key}), concat('V', lpad(cast({key} as string), 10, '0')))"
    )


def _dataset_id() -> Column:
    return F.concat(F.lit("ds-"), F.lower("l_returnflag"), F.lower("l_linestatus"))


def nation_code(key: str) -> Column:
    return F.expr(f"element_at({text_array(NATION_CODES)}, {key} + 1)")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _dataset_id().alias("dataset_id"), _video_id("l_orderkey").alias("video_id")
    )


def resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = F.col("o_orderstatus") == "P"
    state = (
        F.when(F.col("o_orderkey") % 97 == 0, "invalid")
        .when(partial & (F.col("o_orderpriority") == "5-LOW"), "unavailableUnclassified")
        .when(partial & (F.col("o_orderpriority") == "4-NOT SPECIFIED"), "retryableOrPending")
        .when(partial & (F.col("o_orderpriority") == "3-MEDIUM"), "terminalFailure")
        .otherwise("resolved")
    )
    return table(spark, sf_dir, "orders").select(
        _video_id("o_orderkey").alias("video_id"), state.alias("state"), F.col("o_custkey").alias("channel_key")
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("channel_key"),
        F.col("c_name").alias("display_name"),
        F.when(F.col("c_nationkey") % 8 == 7, "XX").otherwise(nation_code("c_nationkey")).alias("country"),
        F.lit(LAST_OBSERVED).alias("last_observed_at"),
    )


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country as a channel might have typed it: lower case, missing or not a code."""
    key, code = F.col("c_custkey"), nation_code("c_nationkey")
    raw = (
        F.when(key % 5 == 1, F.lower(code))
        .when(key % 5 == 2, F.concat(code, F.lit("1")))
        .when(key % 25 == 3, F.lit(None))
        .when(key % 25 == 8, F.lit("qq"))
        .otherwise(code)
    )
    return table(spark, sf_dir, "customer").select(key.alias("channel_key"), raw.alias("raw_country"))


def removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 50 = 0").select(F.col("c_custkey").alias("channel_key"))


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue, one row per snapshot found in the line items, pinned by a digest of its contents."""
    snapshots = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("s"))
    )
    flag = F.lower("l_returnflag")
    id_ = _dataset_id()
    return snapshots.select(
        id_.alias("dataset_id"),
        F.concat(F.lit("Snapshot "), F.upper(F.substring(id_, 4, 2))).alias("display_name"),
        F.lit("v1").alias("version"),
        F.when(flag == "n", "Comparison").otherwise("Candidate").alias("corpus_class"),
        F.when(flag == "a", "MediaIndex").when(flag == "n", "MetadataOnly").otherwise("SubtitleIndex").alias(
            "source_kind"
        ),
        F.when(flag == "a", "Clip").when(flag == "n", "Video").otherwise("Segment").alias("occurrence_unit"),
        F.concat(F.lit("https://example.org/"), id_).alias("source_citation"),
        F.concat(
            F.lit("sha256:"), F.sha2(F.concat_ws("|", id_, F.col("n").cast("string"), F.col("s").cast("string")), 256)
        ).alias("snapshot_digest"),
    )


def catalog() -> Catalog:
    """The same catalogue as parameters, for jobs that only need ids, classes and filters."""
    rows = []
    for flag, (unit, kind) in _FLAGS.items():
        for status in "fo":
            id_ = f"ds-{flag}{status}"
            rows.append(
                Dataset(
                    id_, f"Snapshot {id_[3:].upper()}", "v1", "Comparison" if flag == "n" else "Candidate", kind, unit,
                    f"https://example.org/{id_}", "sha256:" + "0" * 64,
                )
            )
    rows.sort(key=lambda d: d.dataset_id)
    ids = tuple(d.dataset_id for d in rows)
    base = f"releases/{RELEASE_ID}"
    filters = [
        PublishedFilter("all", "All datasets", f"{base}/overview.json", ids, ("Candidate", "Comparison"), True)
    ]
    for cls in ("Candidate", "Comparison"):
        key = cls.lower()
        of_class = tuple(d.dataset_id for d in rows if d.corpus_class == cls)
        filters.append(PublishedFilter(key, f"{cls} corpora", f"{base}/filters/{key}.json", of_class, (cls,), False))
    for d in rows:
        filters.append(
            PublishedFilter(
                d.dataset_id, d.display_name, f"{base}/filters/{d.dataset_id}.json", (d.dataset_id,),
                (d.corpus_class,), False,
            )
        )
    return Catalog(tuple(rows), tuple(filters))


# One SQL term per parameter, null when the link does not carry it.
_LINK_PARAMETERS = (
    "case event_id % 7 when 0 then 'release=fixture-1' when 1 then 'release=a%20b' end",
    "case when event_id % 4 = 0 then 'datasets=ds-ro%2Cds-af'"
    " when event_id % 4 = 1 then 'datasets=ds-af,DS!,ds-zz,+ds-af'"
    " when event_id % 4 = 2 and user_id % 3 = 0 then 'datasets=ds-nf' end",
    "case user_id % 4 when 0 then 'corpus=Candidate' when 1 then 'corpus=Comparison,Other' end",
    "case event_id % 5 when 0 then 'country=usa' when 1 then 'country=us' when 2 then 'country=IT'"
    " when 3 then 'country=DE' end",
    "case event_id % 3 when 0 then 'metric=videos' when 1 then 'metric=creators' else 'metric=likes' end",
    "case user_id % 5 when 0 then 'view=table' when 1 then 'view=grid' end",
    "case user_id % 6 when 0 then 'sort=displayNameAsc' when 1 then 'sort=newest' end",
    "case event_id % 11 when 0 then concat('cursor=', user_id % 9) when 1 then 'cursor=%21bad' end",
)


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View links as they might be shared: valid, unknown and malformed values, from the event log."""
    query = f"concat_ws('&', {', '.join(_LINK_PARAMETERS)})"
    return table(spark, sf_dir, "events").select(
        "event_id", F.expr(f"concat('https://example.org/map?', {query})").alias("url")
    )


# What links are held to where their release is not the one at hand, and a raw id of the tables.
OTHER_RELEASES = ("fixture-2", "fixture-3")
ONE_CLASS = ("Candidate",)
PLANTED_ID = "V0000000001"


def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for creator pages: existing ones, pages past the end, and an order nobody publishes."""
    e, u = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        e.alias("request_id"),
        F.expr(f"element_at({text_array([*NATION_CODES, 'XX'])}, cast(user_id % 26 as int) + 1)").alias("country"),
        F.when(e % 10 == 9, "newest").when(e % 2 == 0, "displayNameAsc").otherwise("representedVideoCountDesc").alias(
            "sort_order"
        ),
        (e % 7 - 1).alias("page"),
    )


def metadata_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated readings of a channel's metadata, from the event log."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("channel_key"),
        F.col("event_type").alias("display_name"),
        "value",
        F.col("ts").alias("observed_at"),
        F.col("event_id").alias("observation_id"),
    )


# Three releases; one cutoff is a reading's own instant, one has no seconds, one an offset beyond a day.
RELEASE_CUTOFFS = (("r2", "2024-01-20T00:00:00Z"), ("r1", "2024-01-08T10:00Z"), ("r3", "2024-01-27T00:30:00+26:00"))


def spoilt_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations in which the rows of orders 1 to 40 are lost, repeated or changed, by dataset; one dataset is foreign."""
    place, early = F.col("dataset_id"), F.col("l_orderkey") <= 40
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", _dataset_id().alias("dataset_id"), _video_id("l_orderkey").alias("video_id"))
    times = F.when(early & (place == "ds-af"), 0).when(early & (place == "ds-ao"), 2).otherwise(1)
    video = F.when(early & (place == "ds-nf"), F.reverse("video_id")).otherwise(F.col("video_id"))
    name = F.when(place == "ds-ro", "ds-new").otherwise(place)
    rows = rows.select(name.alias("dataset_id"), video.alias("video_id"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy"))
    return rows.drop("copy")


def faulty_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Observations, resolutions and channels with faults: foreign datasets, unknown states, repeated and nameless rows."""
    rows = table(spark, sf_dir, "lineitem")
    name = F.when(F.col("l_orderkey") % 90 == 0, "ds-xx").when(F.col("l_orderkey") % 91 == 0, F.lit(None)).otherwise(_dataset_id())
    observed = rows.select(name.alias("dataset_id"), _video_id("l_orderkey").alias("video_id"))
    made = resolutions(spark, sf_dir)
    state = F.when(F.col("channel_key") % 70 == 0, "unheard-of").when(F.col("channel_key") % 71 == 0, F.lit(None)).otherwise(F.col("state"))
    repeats = F.array_repeat(F.lit(0), F.when(F.col("channel_key") % 50 == 1, 3).otherwise(1))
    resolved = made.withColumn("state", state).withColumn("copy", F.explode(repeats)).drop("copy")
    read = channels(spark, sf_dir).withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("channel_key") % 40 == 0, 2).otherwise(1))))
    return observed, resolved, read.withColumn("channel_key", F.when(F.col("channel_key") % 33 != 0, F.col("channel_key"))).drop("copy")


def boundary_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations as one GeoJSON feature collection in a ``content`` column."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(nation_code("n_nationkey").alias("iso"), F.col("n_name").alias("name")).alias("properties"),
    )
    # A boundary file holds one feature per country.
    features = F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("k"), feature.alias("f"))))
    meta = F.struct(*[F.lit(v).alias(k) for k, v in BOUNDARY_METADATA.items()])
    return (
        table(spark, sf_dir, "nation")
        .agg(features.alias("fs"))
        .select(
            F.to_json(
                F.struct(
                    F.lit("FeatureCollection").alias("type"),
                    meta.alias("metadata"),
                    F.transform("fs", lambda x: x["f"]).alias("features"),
                )
            ).alias("content")
        )
    )


BOUNDARY_METADATA = {
    "datasetName": "Fixture nations",
    "version": "1",
    "license": "Public domain",
    "attribution": "Test tables",
    "disputedTerritoryTreatment": "None",
}
