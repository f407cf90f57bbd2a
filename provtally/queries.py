"""One callable per operator, over the test tables. Each takes (spark, sf_dir) and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provtally import fixtures as fx
from provtally.functions.countries import country_bucket, with_display_name
from provtally.functions.identifiers import is_video_id, leak_scan, public_channel_key
from provtally.functions.labels import instant_label
from provtally.operators import creators as cr
from provtally.operators import metrics as mt
from provtally.operators import scale as sc
from provtally.operators import selection as sel
from provtally.plans import audit as au
from provtally.plans import checks as ck
from provtally.plans import release as rl
from provtally.plans import report as rp
from provtally.plans.manifests import read_manifest
from provtally.session import new_folder, prepare
from provtally.sources import contracts as ct
from provtally.sources import snapshots as sn
from provtally.sources.boundaries import parse_boundaries
from provtally.sources.catalog import Catalog, standard_filters

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SETTINGS = rl.ReleaseSettings(
    fx.RELEASE_ID, fx.GENERATED_AT, fx.ENRICHMENT_CUTOFF, fx.PAGE_SIZE, fx.DISCLOSURE_THRESHOLD, fx.KEY_SALT,
    fx.BOUNDARY_METADATA,
)


def query(fn: Query) -> Query:
    """Register a query under its function's name (a trailing underscore left out)."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return run


def _inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return fx.observations(spark, sf), fx.resolutions(spark, sf), fx.channels(spark, sf)


def _cells(spark: SparkSession, sf: str, catalog: Catalog | None = None) -> DataFrame:
    return mt.filter_cells(*_inputs(spark, sf), catalog or fx.catalog())


def _countries(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    catalog = fx.catalog()
    return mt.country_rows(_cells(spark, sf, catalog.only(*keys) if keys else catalog))


def _creators(spark: SparkSession, sf: str) -> DataFrame:
    catalog = fx.catalog()
    return cr.creator_rows(*_inputs(spark, sf), catalog, catalog.default)


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    return cr.published(_creators(spark, sf), fx.removals(spark, sf), fx.DISCLOSURE_THRESHOLD, fx.KEY_SALT)


def _read_catalog(spark: SparkSession, sf: str) -> Catalog:
    datasets = fx.datasets(spark, sf)
    return Catalog.read(datasets, standard_filters(datasets, fx.RELEASE_ID))


def _parsed_links(spark: SparkSession, sf: str) -> DataFrame:
    return sel.parse_links(fx.links(spark, sf), fx.catalog(), _countries(spark, sf, "all"))


def _selections(spark: SparkSession, sf: str) -> DataFrame:
    """Links with only their filter part; which countries are known does not matter to it."""
    nowhere = spark.createDataFrame([], "country string")
    return sel.parse_links(fx.links(spark, sf), fx.catalog(), nowhere)


# ---- flagship and totals --------------------------------------------------------------------


@query
def country_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _countries(spark, sf)


@query
def headline_totals(spark: SparkSession, sf: str) -> DataFrame:
    return mt.headline_rows(_cells(spark, sf), fx.catalog())


@query
def represented_videos(spark: SparkSession, sf: str) -> DataFrame:
    return mt.represented_videos(fx.observations(spark, sf), fx.catalog())


@query
def source_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    return mt.source_occurrences(fx.observations(spark, sf), fx.catalog())


@query
def creators(spark: SparkSession, sf: str) -> DataFrame:
    return mt.creators(fx.observations(spark, sf), fx.resolutions(spark, sf), fx.catalog())


@query
def filter_overview(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of the single-dataset filters."""
    catalog = fx.catalog()
    narrow = catalog.only(*catalog.dataset_ids)
    return mt.headline_rows(_cells(spark, sf, narrow), narrow)


@query
def corpus_overview(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of the filters that keep one corpus class."""
    by_class = fx.catalog().only("candidate", "comparison")
    return mt.headline_rows(_cells(spark, sf, by_class), by_class)


@query
def coverage_partition(spark: SparkSession, sf: str) -> DataFrame:
    return mt.coverage_partition(fx.observations(spark, sf), fx.resolutions(spark, sf), fx.catalog())


@query
def coverage_shares(spark: SparkSession, sf: str) -> DataFrame:
    return rp.coverage_shares(coverage_partition(spark, sf))


@query
def channel_country_split(spark: SparkSession, sf: str) -> DataFrame:
    return rp.channel_country_split(headline_totals(spark, sf))


@query
def dataset_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    counts = mt.channel_counts(fx.observations(spark, sf), fx.resolutions(spark, sf), fx.catalog())
    return rl.dataset_breakdown(counts, fx.channels(spark, sf), fx.catalog())


@query
def dataset_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return mt.dataset_overlap(fx.observations(spark, sf), fx.catalog())


@query
def dataset_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return mt.dataset_pairs(fx.observations(spark, sf), fx.catalog())


@query
def occurrences_by_unit(spark: SparkSession, sf: str) -> DataFrame:
    return mt.occurrences_by_unit(fx.observations(spark, sf), fx.catalog().datasets_frame(spark))


@query
def headline_cards(spark: SparkSession, sf: str) -> DataFrame:
    return rp.headline_cards(headline_totals(spark, sf))


# ---- sources, identifiers, countries --------------------------------------------------------


@query
def dataset_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return rp.dataset_catalog(fx.datasets(spark, sf))


@query
def id_grammar(spark: SparkSession, sf: str) -> DataFrame:
    valid = is_video_id(F.col("video_id")).alias("valid")
    return fx.observations(spark, sf).groupBy(valid).agg(F.count("*").alias("occurrences"))


@query
def leak_scan_(spark: SparkSession, sf: str) -> DataFrame:
    return leak_scan(fx.table(spark, sf, "documents"), "doc_id", "text")


@query
def country_bucket_(spark: SparkSession, sf: str) -> DataFrame:
    bucket = country_bucket(F.col("raw_country")).alias("country")
    return fx.raw_countries(spark, sf).groupBy(bucket).agg(F.count("*").alias("channels"))


@query
def country_display(spark: SparkSession, sf: str) -> DataFrame:
    return with_display_name(country_bucket_(spark, sf))


@query
def public_keys(spark: SparkSession, sf: str) -> DataFrame:
    key = public_channel_key(F.col("channel_key"), fx.KEY_SALT)
    return fx.channels(spark, sf).select("channel_key", key.alias("public_channel_key"))


@query
def metadata_asof(spark: SparkSession, sf: str) -> DataFrame:
    cutoff = F.lit(fx.ENRICHMENT_CUTOFF).cast("timestamp")
    latest = cr.metadata_as_of(fx.metadata_observations(spark, sf), cutoff)
    raw = F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return latest.select("channel_key", "observation_id", "display_name", "value", instant_label(raw).alias("read_label"))


@query
def release_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Readings dealt to three releases, whose cutoffs are written in three of the ways that documents may use."""
    cutoffs = [(name, ct.instant(text)) for name, text in fx.RELEASE_CUTOFFS]
    latest = cr.metadata_as_of_each(fx.metadata_observations(spark, sf), cutoffs)
    return latest.select("release_id", "channel_key", "observation_id", "display_name", "value")


@query
def snapshot_check(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots pinned to their rows, of which some lose, repeat or change the rows of one video."""
    observed = fx.observations(spark, sf)
    return sn.check_snapshots(fx.spoilt_observations(spark, sf), sn.snapshot_digests(observed))


@query
def input_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Faults put into the inputs, counted by the job that makes the totals."""
    faulty = rl.Inputs(*fx.faulty_inputs(spark, sf), fx.removals(spark, sf), fx.catalog())
    return ck.checked_cells(faulty)[1]


@query
def removals_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of the next release after removals, from the counts and cells that the last one kept."""
    observed, catalog, channels = _inputs(spark, sf)[:2], fx.catalog(), fx.channels(spark, sf)
    counts = rl.kept(mt.channel_counts(*observed, catalog), "counts")
    cells = rl.kept(mt.cells_of(counts, channels, catalog), "cells")
    return rl.removed_from_totals(cells, counts, channels, fx.removals(spark, sf), catalog)


# ---- scale, map, tables ---------------------------------------------------------------------


@query
def metric_long(spark: SparkSession, sf: str) -> DataFrame:
    return sc.metric_long(_countries(spark, sf))


@query
def quantile_breaks(spark: SparkSession, sf: str) -> DataFrame:
    return sc.quantile_breaks(metric_long(spark, sf))


@query
def quantile_bins(spark: SparkSession, sf: str) -> DataFrame:
    return sc.bin_rows(sc.scales(metric_long(spark, sf)))


@query
def legend(spark: SparkSession, sf: str) -> DataFrame:
    return sc.legend(sc.scales(metric_long(spark, sf)))


@query
def country_bins(spark: SparkSession, sf: str) -> DataFrame:
    values = metric_long(spark, sf)
    return sc.country_bins(values, sc.scales(values))


@query
def map_country_join(spark: SparkSession, sf: str) -> DataFrame:
    features = parse_boundaries(fx.boundary_document(spark, sf))
    values = sc.metric_long(_countries(spark, sf, "all"), ["creators"])
    return sc.map_join(features, sc.country_bins(values, sc.scales(values)))


@query
def country_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return rp.country_sorted(_countries(spark, sf))


# ---- creators -------------------------------------------------------------------------------


@query
def creator_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = cr.creator_labels(_creators(spark, sf))
    return rows.select(
        "channel_key", "display_name", "country", "represented_video_count", "datasets_label", "observed_label"
    )


@query
def published_creators(spark: SparkSession, sf: str) -> DataFrame:
    """Per country: everybody counted, and those the disclosure rule lets be listed."""
    shown = F.col("represented_video_count") >= fx.DISCLOSURE_THRESHOLD
    return (
        _creators(spark, sf)
        .groupBy("country")
        .agg(F.count("*").alias("creators"), F.count_if(shown).alias("listed"))
    )


@query
def removals_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    listing = _listing(spark, sf)
    return listing.select("public_channel_key", "display_name", "country", "represented_video_count")


def _rank_columns(ranked: DataFrame) -> DataFrame:
    return ranked.select("country", "rank", "total_rows", "public_channel_key", "display_name")


@query
def creator_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _rank_columns(cr.creator_ranks(_listing(spark, sf), cr.BY_VIDEOS))


@query
def creator_rank_name(spark: SparkSession, sf: str) -> DataFrame:
    return _rank_columns(cr.creator_ranks(_listing(spark, sf), cr.BY_NAME))


@query
def creator_pages(spark: SparkSession, sf: str) -> DataFrame:
    paged = cr.paged(rl.kept(_listing(spark, sf), "listing"), fx.PAGE_SIZE)
    return paged.select(
        "country", "sort_order", "page", "rank", "public_channel_key", "represented_video_count", "next_cursor",
        "total_rows",
    )


@query
def first_page(spark: SparkSession, sf: str) -> DataFrame:
    top = cr.first_page(_listing(spark, sf), fx.PAGE_SIZE)
    return top.select("country", "rank", "public_channel_key", "represented_video_count")


@query
def page_index(spark: SparkSession, sf: str) -> DataFrame:
    return cr.page_index(cr.page_counts(_listing(spark, sf), fx.PAGE_SIZE), fx.RELEASE_ID)


@query
def page_fetch(spark: SparkSession, sf: str) -> DataFrame:
    counts = cr.page_counts(_listing(spark, sf), fx.PAGE_SIZE)
    return cr.page_fetch(fx.page_requests(spark, sf), counts, fx.RELEASE_ID)


@query
def page_content(spark: SparkSession, sf: str) -> DataFrame:
    """The creators on each requested page, read from stored pages."""
    listing = rl.kept(_listing(spark, sf), "listing")
    counts = rl.kept(cr.page_counts(listing, fx.PAGE_SIZE), "counts")
    at = new_folder(spark, "pages")
    rl.store_pages(rl.page_rows(cr.paged(listing, fx.PAGE_SIZE), fx.PAGE_SIZE), at)
    content = rl.page_content(fx.page_requests(spark, sf), counts, at, fx.RELEASE_ID)
    return content.select(
        "request_id", "country", "sort_order", "page", "status", "position", F.col("publicChannelKey").alias("public_channel_key"),
        F.col("representedVideoCount").alias("represented_video_count"), "next_cursor", "total_rows",
    )


@query
def page_lines(spark: SparkSession, sf: str) -> DataFrame:
    counts = cr.page_counts(_listing(spark, sf), fx.PAGE_SIZE)
    return rp.page_lines(cr.page_index(counts, fx.RELEASE_ID), counts, fx.PAGE_SIZE)


@query
def country_lines(spark: SparkSession, sf: str) -> DataFrame:
    return rp.country_lines(_countries(spark, sf, "all"), _listing(spark, sf))


# ---- filters and links ----------------------------------------------------------------------


@query
def filter_options(spark: SparkSession, sf: str) -> DataFrame:
    datasets = fx.datasets(spark, sf)
    return rp.filter_options(standard_filters(datasets, fx.RELEASE_ID), datasets)


@query
def filter_keys(spark: SparkSession, sf: str) -> DataFrame:
    return sel.selection_keys(_selections(spark, sf), fx.catalog().filters_frame(spark))


@query
def filter_resolve(spark: SparkSession, sf: str) -> DataFrame:
    resolved = sel.resolve_filters(_selections(spark, sf), fx.catalog())
    return resolved.groupBy(
        F.array_join("datasets", "+").alias("datasets"), F.array_join("corpus_classes", "+").alias("corpus_classes"),
        "filter_key", "exact",
    ).agg(F.count("*").alias("links"))


@query
def release_summary(spark: SparkSession, sf: str) -> DataFrame:
    catalog = fx.catalog()
    resolved = sel.resolve_filters(_selections(spark, sf), catalog)
    return rp.release_summary(resolved, headline_totals(spark, sf), catalog)


@query
def country_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Requests for a country the chosen dataset has no records of."""
    requests = fx.page_requests(spark, sf).withColumn(
        "filter_key",
        F.element_at(
            F.array(*[F.lit(f.key) for f in fx.catalog().filters]), (F.col("request_id") % 9).cast("int") + 1
        ),
    )
    missing = sel.missing_countries(requests, _countries(spark, sf))
    return missing.groupBy("filter_key", "country").agg(F.count("*").alias("requests")).withColumn(
        "note", rp.country_missing_note(F.col("country"))
    )


@query
def selection_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed_links(spark, sf).select(
        "event_id", "release", F.array_join("datasets", ",").alias("datasets"),
        F.array_join("corpus_classes", ",").alias("corpus_classes"), "country", "metric", "view", "sort", "cursor",
        F.size("corrections").alias("corrections"), "used_fallback",
    )


@query
def selection_corrections(spark: SparkSession, sf: str) -> DataFrame:
    return sel.correction_counts(_parsed_links(spark, sf))


@query
def selection_releases(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections of links where another release and one corpus class are all there is."""
    parsed = sel.parse_links(
        fx.links(spark, sf), fx.catalog(), _countries(spark, sf, "all"), known_releases=fx.OTHER_RELEASES,
        corpus_classes=fx.ONE_CLASS,
    )
    return sel.correction_counts(parsed)


@query
def selection_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return sel.canonical_counts(_parsed_links(spark, sf))


# ---- release documents ----------------------------------------------------------------------


@query
def overview_json(spark: SparkSession, sf: str) -> DataFrame:
    cells = rl.kept(_cells(spark, sf), "cells")
    return rl.overview_documents(cells, fx.catalog(), fx.RELEASE_ID).select("path", "body")


@query
def country_shard(spark: SparkSession, sf: str) -> DataFrame:
    inputs = _release_inputs(spark, sf)
    tables = rl.release_tables(inputs, SETTINGS)
    pages = rl.first_pages(tables.listing, fx.PAGE_SIZE)
    return rl.shard_documents_of(tables, inputs.catalog, SETTINGS, pages).select("path", "body")


@query
def manifest_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Every artifact with its digest, read back out of the manifest that lists them."""
    documents = rl.with_digest(_documents(spark, sf))
    root = new_folder(spark, "listing")
    rl.publish_listing(documents.select("path", "digest"), fx.catalog(), SETTINGS, root)
    return read_manifest(spark, root, rl.manifest_path(fx.RELEASE_ID)).listed


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return rl.release_documents(_release_inputs(spark, sf), SETTINGS)


def _release_inputs(spark: SparkSession, sf: str) -> rl.Inputs:
    return rl.Inputs(*_inputs(spark, sf), fx.removals(spark, sf), fx.catalog())


def _fault(path: str) -> Column:
    """A number from 0 to 15 by which an artifact is damaged, taken from its path."""
    return F.conv(F.substring(F.md5(F.col(path).cast("binary")), 1, 1), 16, 10).cast("int")


def _with_other_totals() -> Column:
    """A document's body; shards of fault 5 state more creators than they have."""
    spoilt = F.regexp_replace("body", '"creatorCount":', '"creatorCount":1')
    return F.when((F.col("kind") == "shard") & (_fault("path") == 5), spoilt).otherwise(F.col("body"))


@query
def release_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Raw video ids in a release's documents, some of whose bodies had one put in."""
    planted = F.concat("body", F.lit(f" {fx.PLANTED_ID} x{fx.PLANTED_ID} {fx.PLANTED_ID}"))
    documents = _documents(spark, sf).select("path", F.when(_fault("path") == 6, planted).otherwise(F.col("body")).alias("body"))
    return rl.release_leaks(documents, rl.raw_identifiers(_release_inputs(spark, sf)))


@query
def release_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Audit of a release with faults put into a part of its artifacts.

    By a digit of the path's hash: 0 changed after digesting, 1 never written, 2 not listed,
    3 a contract violation, 4 a foreign identity and, in shards, 5 other totals, digested as they are.
    """
    fault = _fault("path")
    violated = F.concat(F.expr("substring(body, 1, length(body) - 1)"), F.lit(',"extra":1}'))
    foreign = (
        F.when(F.col("kind") == "overview", F.replace("body", F.lit('"releaseId":"fixture-1"'), F.lit('"releaseId":"other"')))
        .when(F.col("kind") == "shard", F.concat(F.lit('{"country":"QQ"'), F.expr("substring(body, 16)")))
        .otherwise(F.concat(F.lit('{"country":"QQ"'), F.expr("substring(body, 16)")))
    )
    documents = _documents(spark, sf).withColumn(
        "body",
        F.when(fault == 3, violated).when(fault == 4, foreign).otherwise(_with_other_totals()),
    )
    held = rl.kept(rl.with_digest(documents), "documents")
    root = new_folder(spark, "release")
    written = held.where(fault != 1).withColumn(
        "body", F.when(fault == 0, F.concat("body", F.lit(" "))).otherwise(F.col("body"))
    )
    rl.write_artifacts(written, root)
    listed = held.where(fault != 2).select("path", "digest")
    rl.publish_listing(listed, _read_catalog(spark, sf), SETTINGS, root)
    return au.audit_release(spark, root)


@query
def shard_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Written shards, some with altered totals, against the overviews' country rows."""
    inputs = _release_inputs(spark, sf)
    tables = rl.release_tables(inputs, SETTINGS)
    documents = rl.documents_of(tables, inputs.catalog, SETTINGS)
    documents = documents.where(F.col("kind") == "shard").withColumn("body", _with_other_totals())
    root = new_folder(spark, "shards")
    rl.write_artifacts(rl.kept(documents, "shards"), root)
    shards = au.shard_totals(spark, root, fx.RELEASE_ID)
    # The cells are those of the release, so the occurrences are counted once.
    overview = mt.country_rows(tables.cells)
    return au.reconcile_shards(shards, overview, [f.key for f in inputs.catalog.filters])


# ---- contract checks over documents made of the tables ---------------------------------------


def _json_object(**members: Column) -> Column:
    parts = []
    for name, value in members.items():
        parts.append(F.concat(F.lit(f'"{name}":'), value))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _quoted(value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.concat(F.lit('"'), value, F.lit('"'))


def _number(value: Column) -> Column:
    return value.cast("string")


def _issue_counts(documents: DataFrame, contract: ct.Record, key: str) -> DataFrame:
    found = au.document_issues(documents, contract, key)
    return found.groupBy("path", "rule", "message").agg(F.count("*").alias("documents"))


@query
def validate_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Creator rows with one field spoilt in nine of ten."""
    k = F.col("channel_key") % 10
    key = public_channel_key(F.col("channel_key"), fx.KEY_SALT)
    body = _json_object(
        publicChannelKey=_quoted(F.when(k == 5, F.concat(F.lit("key_"), key)).otherwise(key)),
        displayName=F.when(k == 2, F.lit(None)).when(k == 3, _quoted("")).otherwise(_quoted(F.col("display_name"))),
        country=_quoted(F.when(k == 7, F.lower("country")).otherwise(F.col("country"))),
        representedVideoCount=F.when(k == 0, F.lit("-1")).when(k == 1, _quoted("3")).when(k == 8, F.lit("1.5"))
        .otherwise(_number(F.col("channel_key"))),
        datasetBreakdown=F.when(k == 6, F.lit('[{"datasetId":"","representedVideoCount":1}]')).otherwise(
            F.lit('[{"datasetId":"ds-af","representedVideoCount":1}]')
        ),
        lastObservedAt=_quoted(F.when(k == 4, F.lit("19 Jan")).otherwise(F.col("last_observed_at"))),
    )
    documents = fx.channels(spark, sf).select("channel_key", body.alias("body"))
    return _issue_counts(documents, ct.CREATOR_ROW, "channel_key")


@query
def validate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Creator rows whose key is sound, raw, too short or of a foreign alphabet."""
    k = F.col("channel_key") % 8
    key = public_channel_key(F.col("channel_key"), fx.KEY_SALT)
    shown = (
        F.when(k == 0, F.concat(F.lit("pk_UC"), F.substring(key, 4, 22)))
        .when(k == 1, F.concat(F.lit("pk_uc"), F.substring(key, 4, 22)))
        .when(k == 2, F.substring(key, 1, 10))
        .when(k == 3, F.concat(key, F.lit("!")))
        .otherwise(key)
    )
    body = _json_object(
        publicChannelKey=_quoted(shown), displayName=_quoted(F.col("display_name")), country=_quoted(F.col("country")),
        representedVideoCount=F.lit("3"), datasetBreakdown=F.lit("[]"), lastObservedAt=_quoted(F.col("last_observed_at")),
    )
    documents = fx.channels(spark, sf).select("channel_key", body.alias("body"))
    return _issue_counts(documents, ct.CREATOR_ROW, "channel_key")


def _channel_coverage(spark: SparkSession, sf: str, extra_top: Column, extra_part: Column, parts_off: Column,
                      channels_off: Column) -> DataFrame:
    """One coverage document per channel, over its videos."""
    states = [F.count_if(F.col("state") == s).alias(s) for s in mt.STATES]
    per_channel = fx.resolutions(spark, sf).groupBy("channel_key").agg(F.count("*").alias("n"), *states)
    partition = _json_object(**{s: _number(F.col(s)) for s in mt.STATES})
    body = F.concat(
        F.lit('{"inputOccurrenceCount":'), _number(F.col("n")),
        F.lit(',"distinctInputVideoCount":'), _number(F.col("n") + parts_off),
        F.lit(',"partition":'), F.concat(F.expr("substring(p, 1, length(p) - 1)"), extra_part, F.lit("}")),
        F.lit(',"resolvedChannelCount":'), _number(F.lit(1) + channels_off),
        F.lit(',"knownCountryChannelCount":1,"unknownCountryChannelCount":0'), extra_top, F.lit("}"),
    )
    return per_channel.withColumn("p", partition).select("channel_key", body.alias("body"))


@query
def validate_strict(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage documents with keys the contract does not know, at either level."""
    k = F.col("channel_key")
    documents = _channel_coverage(
        spark, sf, F.when(k % 3 == 0, F.lit(',"note":1,"by":"x"')).otherwise(F.lit("")),
        F.when(k % 4 == 0, F.lit(',"deleted":0')).otherwise(F.lit("")), F.lit(0), F.lit(0),
    )
    return _issue_counts(documents, ct.COVERAGE, "channel_key")


@query
def validate_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage documents some of whose sums do not hold."""
    k = F.col("channel_key")
    documents = _channel_coverage(
        spark, sf, F.lit(""), F.lit(""), F.when(k % 7 == 0, 1).otherwise(0), F.when(k % 11 == 0, 2).otherwise(0)
    )
    return au.document_issues(documents, ct.COVERAGE, "channel_key")


@query
def validate_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Filter documents out of the event log: in order, out of order, repeated, empty or of a wrong class."""
    e = F.col("event_id")
    sets = (
        F.when(e % 5 == 0, F.lit('["ds-af","ds-ro"]')).when(e % 5 == 1, F.lit('["ds-ro","ds-af"]'))
        .when(e % 5 == 2, F.lit('["ds-af","ds-af"]')).when(e % 5 == 3, F.lit("[]")).otherwise(F.lit('["ds-nf",""]'))
    )
    classes = (
        F.when(e % 3 == 0, F.lit('["Candidate","Comparison"]')).when(e % 3 == 1, F.lit('["Comparison","Candidate"]'))
        .otherwise(F.lit('["Other"]'))
    )
    body = _json_object(datasets=sets, corpusClasses=classes)
    documents = fx.table(spark, sf, "events").select("event_id", body.alias("body"))
    return _issue_counts(documents, ct.FILTER_SPEC, "event_id")


@query
def validate_countries(spark: SparkSession, sf: str) -> DataFrame:
    """Overviews of thirty channels each, listed one country row per channel, so that buckets repeat."""
    row = _json_object(
        country=_quoted(F.col("country")), creatorCount=F.lit("1"), representedVideoCount=F.lit("1"),
        sourceOccurrenceCount=F.lit("1"), resolvedVideoCount=F.lit("1"), unavailableVideoCount=F.lit("0"),
    )
    # Thirty consecutive keys per document.
    grouped = (
        fx.channels(spark, sf)
        .withColumn("document_id", F.floor(F.col("channel_key") / 30))
        .groupBy("document_id")
        .agg(F.array_join(F.array_sort(F.collect_list(row)), ",").alias("rows"))
    )
    zero = ",".join(f'"{s}":0' for s in mt.STATES)
    body = F.concat(
        F.lit(
            '{"schemaVersion":"1.0.0","releaseId":"fixture-1","filter":{"datasets":["ds-af"],'
            '"corpusClasses":["Candidate"]},"countries":['
        ),
        "rows",
        F.lit(
            '],"coverage":{"inputOccurrenceCount":0,"distinctInputVideoCount":0,"partition":{' + zero + "},"
            '"resolvedChannelCount":0,"knownCountryChannelCount":0,"unknownCountryChannelCount":0},"creatorCount":0,'
            '"representedVideoCount":0,"representedCountryCount":0}'
        ),
    )
    documents = grouped.select("document_id", body.alias("body"))
    found = au.document_issues(documents, ct.OVERVIEW, "document_id")
    return found.groupBy("document_id", "path", "rule", "message").agg(F.count("*").alias("repeats"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Narrow rows over all cores before costly work on each: files make few splits, and splits within one row group are empty."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()))


@query
def validate_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Manifests generated at each event, with a cutoff before or after it in another time zone."""
    e = F.col("event_id")
    generated = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    # Local time two hours ahead, shifted by -2 to 2 minutes.
    shifted = F.col("ts") + F.expr("make_interval(0, 0, 0, 0, 2, cast(event_id % 5 as int) - 2)")
    local = F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss")
    cutoff = F.when(e % 7 == 0, F.concat(local, F.lit(" +02:00"))).otherwise(F.concat(local, F.lit("+02:00")))
    digest = '"sha256:' + "0" * 64 + '"'
    head, tail = (
        '{"schemaVersion":"1.0.0","releaseId":"fixture-1","generatedAt":"',
        '","defaultFilter":{"datasets":["ds-af"],"corpusClasses":["Candidate"]},"datasets":[{"datasetId":"ds-af",'
        '"displayName":"A","version":"v1","corpusClass":"Candidate","sourceKind":"MediaIndex",'
        '"occurrenceUnit":"Clip","sourceCitation":"https://example.org/a","snapshotDigest":' + digest + "}],"
        '"artifactDigests":{"a.json":' + digest + '},"methodologyVersion":"1.0.0","disclosurePolicyVersion":"1.0.0",'
        '"boundaryMetadata":{"datasetName":"n","version":"1","license":"l","attribution":"a",'
        '"disputedTerritoryTreatment":"t"},"filters":[]}',
    )
    body = F.concat(F.lit(head), generated, F.lit('","enrichmentCutoff":"'), cutoff, F.lit(tail))
    documents = _dealt(fx.table(spark, sf, "events").select("event_id", "ts")).select("event_id", body.alias("body"))
    return au.document_issues(documents, ct.MANIFEST, "event_id")
