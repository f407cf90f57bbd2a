"""Build a release: overviews, country shards, creator pages, the manifest and its pointer."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provtally.functions.identifiers import CHANNEL_TOKEN_LENGTH, VIDEO_TOKEN_LENGTH, digest_of, leaked_tokens
from provtally.functions.sql import exploded
from provtally.operators import creators as cr
from provtally.operators.metrics import (
    RESOLVED,
    STATES,
    cells_of,
    channel_counts,
    country_rows,
    coverage_rows,
    dataset_at,
    headline_rows,
    kept_words,
    positions,
    with_country,
)
from provtally.plans.manifests import entry_lines, write_manifest
from provtally.session import kept
from provtally.sources.artifacts import write_artifacts
from provtally.sources.catalog import Catalog, Dataset, PublishedFilter
from provtally.sources.contracts import SCHEMA_VERSION, instant

POINTER_PATH = "active-release.json"

# A shard lists all pages of its country in one document, which its readers load whole. Beyond this many
# pages that is no document any reader can load; such a country needs larger pages.
MAX_SHARD_PAGES = 500_000

# Documents named by the error that refuses a release with raw identifiers in it.
SHOWN_LEAKS = 5


@dataclass(frozen=True)
class ReleaseSettings:
    release_id: str
    generated_at: str
    enrichment_cutoff: str
    page_size: int
    disclosure_threshold: int
    key_salt: str
    boundary_metadata: dict[str, str]
    methodology_version: str = "1.0.0"
    disclosure_policy_version: str = "1.0.0"
    # A removal always takes a channel off the listing; with this, its videos also leave the totals.
    removals_cover_totals: bool = False


@dataclass(frozen=True)
class Inputs:
    observations: DataFrame
    resolutions: DataFrame
    channels: DataFrame
    removals: DataFrame
    catalog: Catalog
    # Channel readings (channel_key, observed_at, observation_id and the columns of channels); when
    # given, the last one at or before the cutoff stands for each channel instead of ``channels``.
    readings: DataFrame | None = None


def manifest_path(release_id: str) -> str:
    return f"releases/{release_id}/manifest.json"


def overview_path(release_id: str) -> str:
    return f"releases/{release_id}/overview.json"


def shard_path(release_id: str, country: Column) -> Column:
    return F.concat(F.lit(f"releases/{release_id}/countries/"), country, F.lit(".json"))


def _json(value: Column) -> Column:
    # Nulls are part of the contract (a last page says so).
    return F.to_json(value, {"ignoreNullFields": "false"})


def _coverage(occurrences: Column, videos: Column, states: dict[str, Column], known: Column, unknown: Column) -> Column:
    return F.struct(
        occurrences.alias("inputOccurrenceCount"),
        videos.alias("distinctInputVideoCount"),
        F.struct(*[states[s].alias(s) for s in STATES]).alias("partition"),
        (known + unknown).alias("resolvedChannelCount"),
        known.alias("knownCountryChannelCount"),
        unknown.alias("unknownCountryChannelCount"),
    )


def overview_documents(cells: DataFrame, catalog: Catalog, release_id: str) -> DataFrame:
    """(path, kind, body) of one overview per published filter."""
    spark = cells.sparkSession
    row = F.struct(
        "country",
        F.col("creator_count").alias("creatorCount"),
        F.col("represented_video_count").alias("representedVideoCount"),
        F.col("source_occurrence_count").alias("sourceOccurrenceCount"),
        F.col("resolved_video_count").alias("resolvedVideoCount"),
        F.col("unavailable_video_count").alias("unavailableVideoCount"),
    )
    # One entry per country code.
    countries = country_rows(cells).groupBy("filter_key").agg(
        F.array_sort(F.collect_list(row)).alias("countries")
    )
    filters = catalog.filters_frame(spark).select("filter_key", "path", "datasets", "corpus_classes")
    joined = (
        filters.join(headline_rows(cells, catalog), "filter_key")
        .join(coverage_rows(cells, catalog), "filter_key")
        .join(countries, "filter_key", "left")
    )
    empty = F.array().cast(countries.schema["countries"].dataType)
    document = F.struct(
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(release_id).alias("releaseId"),
        F.struct(
            F.array_sort("datasets").alias("datasets"), F.array_sort("corpus_classes").alias("corpusClasses")
        ).alias("filter"),
        F.coalesce("countries", empty).alias("countries"),
        _coverage(
            F.col("input_occurrence_count"),
            F.col("distinct_input_video_count"),
            {s: F.col(s) for s in STATES},
            F.col("known_country_channel_count"),
            F.col("unknown_country_channel_count"),
        ).alias("coverage"),
        F.col("creator_count").alias("creatorCount"),
        F.col("represented_video_count").alias("representedVideoCount"),
        F.col("represented_country_count").alias("representedCountryCount"),
    )
    return joined.select("path", F.lit("overview").alias("kind"), _json(document).alias("body"))


def _creator_struct() -> Column:
    return F.struct(
        F.col("public_channel_key").alias("publicChannelKey"),
        F.col("display_name").alias("displayName"),
        "country",
        F.col("represented_video_count").alias("representedVideoCount"),
        F.transform(
            "dataset_breakdown",
            lambda b: F.struct(
                b["dataset_id"].alias("datasetId"), b["represented_video_count"].alias("representedVideoCount")
            ),
        ).alias("datasetBreakdown"),
        F.col("last_observed_at").alias("lastObservedAt"),
    )


def page_rows(paged: DataFrame, page_size: int) -> DataFrame:
    """(country, sort_order, page, document): a group holds one page, never more than ``page_size`` rows."""
    grouped = paged.groupBy("country", "sort_order", "page").agg(
        F.array_sort(F.collect_list(F.struct("rank", _creator_struct().alias("row")))).alias("rows"),
        F.first("next_cursor").alias("next_cursor"),
        F.first("total_rows").alias("total_rows"),
    )
    document = F.struct(
        "country",
        F.col("sort_order").alias("sortOrder"),
        F.transform("rows", lambda r: r["row"]).alias("rows"),
        F.col("next_cursor").alias("nextCursor"),
        F.lit(page_size).alias("pageSize"),
        F.col("total_rows").alias("totalRows"),
    )
    return grouped.select("country", "sort_order", "page", document.alias("document"))


def page_documents(pages: DataFrame, release_id: str) -> DataFrame:
    path = cr.page_path(release_id, F.col("country"), F.col("sort_order"), F.col("page"))
    return pages.select(path.alias("path"), F.lit("page").alias("kind"), _json(F.col("document")).alias("body"))


def dataset_breakdown(counts: DataFrame, channels: DataFrame, catalog: Catalog) -> DataFrame:
    """(country, dataset_id) with represented videos of the default filter, out of ``channel_counts``.

    Counts the videos that the country rows count, so those whose channel has no metadata are here
    under the same bucket.
    """
    members = catalog.members(catalog.default)
    located = with_country(counts.where((F.col("state") == RESOLVED) & (F.col("videos") > 0)), channels)
    kept = positions(*kept_words(catalog, members))
    return (
        located.selectExpr("country", "videos", f"explode({kept}) as place")
        .groupBy("country", "place")
        .agg(F.sum("videos").alias("represented_video_count"))
        .selectExpr("country", f"{dataset_at(catalog, 'place')} as dataset_id", "represented_video_count")
    )


def first_pages(listing: DataFrame, page_size: int) -> DataFrame:
    """The first page of each country in the default order, without ranking the rest."""
    counts = cr.page_counts(listing, page_size).where(F.col("sort_order") == cr.BY_VIDEOS)
    # One row per country.
    top = cr.first_page(listing, page_size).join(F.broadcast(counts), "country")
    paged = top.withColumn("page", F.lit(0).cast("long")).withColumn(
        "next_cursor", F.when(F.col("page_count") > 1, F.lit("1"))
    )
    return page_rows(paged, page_size)


def shard_frame(
    cells: DataFrame, breakdown: DataFrame, listing: DataFrame, pages: DataFrame, catalog: Catalog, page_size: int,
    release_id: str,
) -> DataFrame:
    """(country, document) of one shard per country of the default filter.

    The page index is laid out from the page count; no page is looked at but the first.
    """
    key = catalog.default.key
    countries = country_rows(cells).where(F.col("filter_key") == key).drop("filter_key")
    # One entry per dataset of the catalogue.
    breakdown = breakdown.groupBy("country").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("dataset_id").alias("datasetId"),
                    F.col("represented_video_count").alias("representedVideoCount"),
                )
            )
        ).alias("breakdown")
    )
    first = pages.where((F.col("page") == 0) & (F.col("sort_order") == cr.BY_VIDEOS)).select(
        "country", F.col("document").alias("first_page")
    )
    counts = listing.groupBy("country").agg(F.count("*").alias("listed"))
    joined = (
        countries.join(breakdown, "country", "left").join(first, "country", "left").join(counts, "country", "left")
    )
    page_type = pages.schema["document"].dataType
    no_page = F.struct(
        "country",
        F.lit(cr.BY_VIDEOS).alias("sortOrder"),
        F.array().cast(page_type["rows"].dataType).alias("rows"),
        F.lit(None).cast("string").alias("nextCursor"),
        F.lit(page_size).alias("pageSize"),
        F.lit(0).cast("long").alias("totalRows"),
    ).cast(page_type)
    page_count = F.ceil(F.coalesce("listed", F.lit(0)) / page_size)
    numbers = F.when(page_count > 0, F.sequence(F.lit(0).cast("long"), page_count - 1)).otherwise(
        F.array().cast("array<bigint>")
    )

    def paths(sort_order: str) -> Column:
        return F.transform(
            numbers, lambda n: cr.page_path(release_id, F.col("country"), F.lit(sort_order), n)
        )

    index = F.create_map(*[c for s in cr.SORT_ORDERS for c in (F.lit(s), paths(s))])
    unknown = F.when(F.col("country") == "XX", F.col("creator_count")).otherwise(0)
    videos = F.col("represented_video_count")
    zero = F.lit(0).cast("long")
    states = {s: videos if s == "resolved" else zero for s in STATES}
    document = F.struct(
        "country",
        F.col("creator_count").alias("creatorCount"),
        videos.alias("representedVideoCount"),
        F.col("source_occurrence_count").alias("sourceOccurrenceCount"),
        _coverage(
            F.col("source_occurrence_count"), videos, states, F.col("creator_count") - unknown, unknown
        ).alias("coverage"),
        F.coalesce("breakdown", F.array().cast(breakdown.schema["breakdown"].dataType)).alias("datasetBreakdown"),
        F.coalesce("first_page", no_page).alias("firstPage"),
        index.alias("pageIndex"),
    )
    return joined.select("country", document.alias("document"))


def store_pages(pages: DataFrame, path: str) -> None:
    """Keep pages as a table from which one page is read without looking at the others.

    A folder per country and sort order; inside, files hold ranges of pages, so a country with very
    many pages is written by many tasks and a page number prunes by file statistics.
    """
    ordered = pages.repartitionByRange("country", "sort_order", "page").sortWithinPartitions(
        "country", "sort_order", "page"
    )
    ordered.write.partitionBy("country", "sort_order").parquet(path)


def stored_page(spark: SparkSession, path: str, country: str, sort_order: str, page: int) -> DataFrame:
    """The rows of one stored page, in order."""
    found = spark.read.parquet(path).where(
        (F.col("country") == country) & (F.col("sort_order") == sort_order) & (F.col("page") == page)
    )
    return found.select(F.posexplode("document.rows").alias("position", "row")).select("position", "row.*")


def page_content(requests: DataFrame, counts: DataFrame, path: str, release_id: str) -> DataFrame:
    """The rows of every requested page out of stored pages: one row per request and row of its page.

    Columns are those of ``page_fetch`` but the path, then next_cursor, total_rows, position and the creator's
    columns; a request without a page has one row that says why. ``counts`` are the pages published, ``path`` is
    where ``store_pages`` put them. Folders of countries and orders that nobody asks for are pruned at run time,
    files by the least and the largest page asked for, and each page is read once however often it is asked for.
    """
    place = ["country", "sort_order", "page"]
    answered = cr.page_fetch(requests, counts, release_id).drop("path")
    asked = kept(answered.where("status = 'ok'").select(*place).distinct(), "asked")
    low, high = asked.agg(F.min("page"), F.max("page")).first()
    # Two-letter codes times sort orders.
    folders = asked.where("page >= 0").select("country", "sort_order").distinct()
    stored = requests.sparkSession.read.parquet(path).where(F.col("page").between(low, high))
    found = stored.join(F.broadcast(folders), ["country", "sort_order"], "left_semi").join(asked, place, "left_semi")
    shown = answered.join(found.select(*place, "document"), place, "left")
    held = F.col("document")
    return shown.select(
        "request_id", *place, "status", "message", held["nextCursor"].alias("next_cursor"),
        held["totalRows"].alias("total_rows"), F.posexplode_outer(held["rows"]).alias("position", "row"),
    ).withColumn("row", F.col("row").dropFields("country")).select(
        "request_id", *place, "status", "message", "next_cursor", "total_rows", "position", "row.*"
    )


def shard_documents(shards: DataFrame, release_id: str) -> DataFrame:
    return shards.select(
        shard_path(release_id, F.col("country")).alias("path"),
        F.lit("shard").alias("kind"),
        _json(F.col("document")).alias("body"),
    )


@dataclass(frozen=True)
class Tables:
    """What all documents are made of, each computed once."""

    cells: DataFrame
    creators: DataFrame
    listing: DataFrame
    breakdown: DataFrame


def release_tables(inputs: Inputs, settings: ReleaseSettings) -> Tables:
    """The occurrences are read once: the counts per channel are kept, and the rest follows from them."""
    catalog, observed = inputs.catalog, (inputs.observations, inputs.resolutions)
    channels = inputs.channels
    if inputs.readings is not None:
        cutoff = instant(settings.enrichment_cutoff)
        channels = kept(cr.metadata_as_of(inputs.readings, cutoff), "channels")
    removals = inputs.removals if settings.removals_cover_totals else None
    counts = without_channels(kept(channel_counts(*observed, catalog), "counts"), removals)
    creators = cr.creator_rows_of(counts, channels, catalog, catalog.default)
    breakdown = dataset_breakdown(counts, channels, catalog)
    cells = kept(cells_of(counts, channels, catalog), "cells")
    creators = kept(creators, "creators")
    listing = kept(
        cr.published(creators, inputs.removals, settings.disclosure_threshold, settings.key_salt), "listing"
    )
    _refuse_beyond_shard(cr.page_counts(listing, settings.page_size))
    return Tables(cells, creators, listing, breakdown)


def without_channels(rows: DataFrame, removals: DataFrame | None) -> DataFrame:
    """Counted rows but those of removed channels; rows without a channel stay and are not joined."""
    if removals is None:
        return rows
    of_channels = rows.where(F.col("channel_key").isNotNull())
    kept_rows = of_channels.join(removals.select("channel_key"), "channel_key", "left_anti")
    return kept_rows.unionByName(rows.where(F.col("channel_key").isNull()))


def removed_from_totals(cells: DataFrame, counts: DataFrame, channels: DataFrame, removals: DataFrame, catalog: Catalog) -> DataFrame:
    """The cells of the next release when removals cover totals, from what the last release kept.

    ``cells`` and ``counts`` are those of the last release. Channels count apart from each other, so the cells of the removed
    ones alone are taken off; occurrences are not read again. Cells that nothing is left in go.
    """
    keys, values = ("filter_key", "state", "country"), ("creators", "videos", "occurrences")
    gone = counts.where(F.col("channel_key").isNotNull()).join(removals.select("channel_key"), "channel_key", "left_semi")
    less = cells_of(gone, channels, catalog).select(*keys, *[(-F.col(v)).alias(v) for v in values])
    left = cells.select(*keys, *values).unionByName(less).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    return left.where("videos > 0")


def _refuse_beyond_shard(counts: DataFrame) -> None:
    """Stop before any page is laid out when a shard could not list all pages of its country."""
    pages = counts.groupBy("country").agg(F.sum("page_count").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    if pages > MAX_SHARD_PAGES:
        raise ValueError(f"{pages} pages of a country do not fit one shard; use a larger page size")


def shard_documents_of(tables: Tables, catalog: Catalog, settings: ReleaseSettings, pages: DataFrame) -> DataFrame:
    size, rid = settings.page_size, settings.release_id
    shards = shard_frame(tables.cells, tables.breakdown, tables.listing, pages, catalog, size, rid)
    return shard_documents(shards, rid)


def release_documents(inputs: Inputs, settings: ReleaseSettings) -> DataFrame:
    """(path, kind, body) of every artifact but the manifest and the pointer."""
    return documents_of(release_tables(inputs, settings), inputs.catalog, settings)


def documents_of(tables: Tables, catalog: Catalog, settings: ReleaseSettings) -> DataFrame:
    """The same out of ``release_tables``."""
    rid, size = settings.release_id, settings.page_size
    pages = kept(page_rows(cr.paged(tables.listing, size), size), "pages")
    return (
        overview_documents(tables.cells, catalog, rid)
        .unionByName(shard_documents_of(tables, catalog, settings, pages))
        .unionByName(page_documents(pages, rid))
    )


def with_digest(documents: DataFrame) -> DataFrame:
    return documents.withColumn("digest", digest_of(F.encode("body", "UTF-8")))


def _texts(values: tuple[str, ...] | list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _dataset_literal(d: Dataset) -> Column:
    return F.struct(
        F.lit(d.dataset_id).alias("datasetId"),
        F.lit(d.display_name).alias("displayName"),
        F.lit(d.version).alias("version"),
        F.lit(d.corpus_class).alias("corpusClass"),
        F.lit(d.source_kind).alias("sourceKind"),
        F.lit(d.occurrence_unit).alias("occurrenceUnit"),
        F.lit(d.source_citation).alias("sourceCitation"),
        F.lit(d.snapshot_digest).alias("snapshotDigest"),
    )


def _filter_literal(f: PublishedFilter) -> Column:
    return F.struct(
        F.lit(f.key).alias("key"),
        F.lit(f.label).alias("label"),
        F.lit(f.path).alias("path"),
        _texts(f.datasets).alias("datasets"),
        _texts(f.corpus_classes).alias("corpusClasses"),
        F.lit(f.is_default).alias("isDefault"),
    )


def manifest_body(spark: SparkSession, catalog: Catalog, settings: ReleaseSettings) -> str:
    """The manifest's text with an empty list of artifacts."""
    default = catalog.default
    document = F.struct(
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(settings.release_id).alias("releaseId"),
        F.lit(settings.generated_at).alias("generatedAt"),
        F.lit(settings.enrichment_cutoff).alias("enrichmentCutoff"),
        F.struct(
            _texts(sorted(default.datasets)).alias("datasets"),
            _texts(sorted(default.corpus_classes)).alias("corpusClasses"),
        ).alias("defaultFilter"),
        F.array(*[_dataset_literal(d) for d in catalog.datasets]).alias("datasets"),
        F.expr("cast(map() as map<string,string>)").alias("artifactDigests"),
        F.lit(settings.methodology_version).alias("methodologyVersion"),
        F.lit(settings.disclosure_policy_version).alias("disclosurePolicyVersion"),
        F.struct(*[F.lit(v).alias(k) for k, v in settings.boundary_metadata.items()]).alias("boundaryMetadata"),
        F.array(*[_filter_literal(f) for f in catalog.filters]).alias("filters"),
    )
    return spark.range(1).select(_json(document)).first()[0]


def pointer_document(spark: SparkSession, digest: str, settings: ReleaseSettings) -> DataFrame:
    """(path, kind, body) of the pointer to the manifest with this digest."""
    document = F.struct(
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(settings.release_id).alias("releaseId"),
        F.lit(manifest_path(settings.release_id)).alias("manifestPath"),
        F.lit(digest).alias("manifestDigest"),
    )
    return spark.range(1).select(
        F.lit(POINTER_PATH).alias("path"), F.lit("pointer").alias("kind"), _json(document).alias("body")
    )


def publish_listing(digests: DataFrame, catalog: Catalog, settings: ReleaseSettings, root: str) -> str:
    """Write the manifest of (path, digest) rows, then the pointer to it; returns the manifest's digest."""
    spark = digests.sparkSession
    body = manifest_body(spark, catalog, settings)
    digest = write_manifest(entry_lines(digests), body, root, manifest_path(settings.release_id))
    write_artifacts(pointer_document(spark, digest, settings), root)
    return digest


def raw_identifiers(inputs: Inputs) -> DataFrame:
    """(token): the raw video and channel ids that a release is made from, repeats kept."""
    tables = [inputs.observations.select("video_id"), inputs.resolutions.select("video_id")]
    tables += [t.select("channel_key") for t in (inputs.resolutions, inputs.channels, inputs.removals)]
    ids = [t.select(F.col(t.columns[0]).cast("string").alias("token")) for t in tables]
    lengths = F.length("token").isin(VIDEO_TOKEN_LENGTH, CHANNEL_TOKEN_LENGTH)
    return reduce(DataFrame.unionByName, [t.where(lengths) for t in ids])


def release_leaks(documents: DataFrame, raw: DataFrame) -> DataFrame:
    """(kind, token, path, occurrences): raw ids standing free in the bodies of (path, body) documents.

    Texts hold few words of an id's shape, so the raw ids are held against the distinct ones: by a broadcast where
    their stored size is below Spark's threshold, else behind Spark's runtime Bloom filter, so that of the raw
    ids hardly more than leaked ones are shuffled. A word that is an id by chance counts as one.
    """
    tokens = exploded(documents, leaked_tokens(F.col("body")), "token", "path")
    tokens = kept(tokens.groupBy("token", "path").agg(F.count("*").alias("occurrences")), "tokens")
    words = kept(tokens.select("token").distinct(), "words").where(F.length("token") >= VIDEO_TOKEN_LENGTH)
    found = kept(raw.join(words, "token").select("token").distinct(), "found")
    kind = F.when(F.length("token") == VIDEO_TOKEN_LENGTH, "video").otherwise("channel")
    return tokens.join(found, "token").select(kind.alias("kind"), "token", "path", "occurrences")


def _refuse_leaks(documents: DataFrame, raw: DataFrame) -> None:
    leaks = release_leaks(documents, raw)
    paths = [r["path"] for r in leaks.select("path").distinct().orderBy("path").limit(SHOWN_LEAKS).collect()]
    if paths:
        raise ValueError(f"raw identifiers in {', '.join(paths)}; nothing was published")


def publish(
    documents: DataFrame, catalog: Catalog, settings: ReleaseSettings, root: str, raw: DataFrame | None = None
) -> DataFrame:
    """Write (path, body, digest) documents, then the manifest, then the pointer.

    Until the pointer is written the previous release stays the active one. With ``raw`` ids given, a release
    that holds one of them is refused before anything is written. Returns the documents as kept in the shared folder.
    """
    held = kept(documents, "documents")
    if raw is not None:
        # The manifest holds the paths, and the catalogue's texts.
        at = F.lit(manifest_path(settings.release_id)).alias("path")
        body = held.sparkSession.range(1).select(at, F.lit(manifest_body(held.sparkSession, catalog, settings)).alias("body"))
        _refuse_leaks(held.select("path", "body").unionByName(held.select(at, F.col("path").alias("body"))).unionByName(body), raw)
    write_artifacts(held, root)
    publish_listing(held.select("path", "digest"), catalog, settings, root)
    return held


def build_release(inputs: Inputs, settings: ReleaseSettings, root: str) -> DataFrame:
    documents = with_digest(release_documents(inputs, settings))
    return publish(documents, inputs.catalog, settings, root, raw_identifiers(inputs))
