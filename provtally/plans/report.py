"""What a reader of the release sees: tables, labels and sentences over the aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from provtally.functions.countries import with_display_name
from provtally.functions.identifiers import short_digest
from provtally.functions.labels import count_label, plural, share_label
from provtally.operators.metrics import STATES
from provtally.sources.catalog import Catalog

# The rows of the coverage table.
STATE_LABELS = {
    "resolved": ("Resolved", "Matched to a channel."),
    "unavailableUnclassified": ("Unavailable", "The metadata API did not return these and did not say why."),
    "retryableOrPending": ("Pending", "Not yet resolved at this release's cutoff."),
    "invalid": ("Invalid identifier", "Did not match the supported identifier grammar."),
    "terminalFailure": ("Could not resolve", "Resolution failed permanently under the retry policy."),
}
HEADLINE_CARDS = (
    ("Creators", "creator_count", "Distinct channels resolved within this filter"),
    ("Represented videos", "represented_video_count", "Distinct source-video identifiers, counted once each"),
    (
        "Source occurrences", "source_occurrence_count",
        "Retained source records; higher than the video count because sources repeat",
    ),
    ("Countries represented", "represented_country_count", "Channels with no declared country are excluded"),
)
TOTAL_LABEL, TOTAL_SHARE, TOTAL_NOTE = "Total", "100%", "Every identifier is counted exactly once."
CHANNEL_LABELS = ("Declared a country", "No declared country", "Resolved channels")
COMPARISON_NOTE = "Labelled from its own documented provenance and licence terms"
FALLBACK_NOTE = (
    " These are the full release figures; this release does not publish that exact combination."
)
COUNTRY_SORT_KEYS = ("country", "creators", "videos", "occurrences")


def coverage_shares(coverage: DataFrame) -> DataFrame:
    """The coverage table: one row per state, and a total."""
    total = F.col("distinct_input_video_count")
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(STATE_LABELS[s][0]).alias("state_label"),
            F.col(s).alias("videos"),
            share_label(F.col(s), total).alias("share"),
            F.lit(STATE_LABELS[s][1]).alias("note"),
        )
        for i, s in enumerate(STATES)
    ]
    rows.append(
        F.struct(
            F.lit(len(STATES)).alias("position"),
            F.lit(TOTAL_LABEL).alias("state_label"),
            total.alias("videos"),
            F.lit(TOTAL_SHARE).alias("share"),
            F.lit(TOTAL_NOTE).alias("note"),
        )
    )
    return coverage.select("filter_key", F.inline(F.array(*rows)))


def channel_country_split(headline: DataFrame) -> DataFrame:
    """Whether resolved channels declared a country."""
    total = F.col("creator_count")

    def row(i: int, label: str, n: Column, share: Column) -> Column:
        return F.struct(
            F.lit(i).alias("position"), F.lit(label).alias("channels"), n.alias("channel_count"), share.alias("share")
        )

    known, unknown = F.col("known_country_channel_count"), F.col("unknown_country_channel_count")
    rows = F.array(
        row(0, CHANNEL_LABELS[0], known, share_label(known, total)),
        row(1, CHANNEL_LABELS[1], unknown, share_label(unknown, total)),
        row(2, CHANNEL_LABELS[2], total, F.lit(TOTAL_SHARE)),
    )
    return headline.select("filter_key", F.inline(rows))


def country_sorted(countries: DataFrame) -> DataFrame:
    """Place of each country under every sort key and direction; ties always by code, A to Z.

    Groups hold one row per country code, so each window is short.
    """
    named = with_display_name(countries)
    base = named.select(
        "filter_key", "country", "country_name", "creator_count", "represented_video_count", "source_occurrence_count"
    )
    number = {
        "creators": "creator_count", "videos": "represented_video_count", "occurrences": "source_occurrence_count"
    }
    scope = W.partitionBy("filter_key")
    places = []
    for key in COUNTRY_SORT_KEYS:
        value = F.collate("country_name", "UNICODE") if key == "country" else F.col(number[key])
        for direction, order in (("asc", value.asc()), ("desc", value.desc())):
            place = F.row_number().over(scope.orderBy(order, F.col("country").asc()))
            places.append(
                F.struct(F.lit(key).alias("sort_key"), F.lit(direction).alias("direction"), place.alias("place"))
            )
    return base.withColumn("_places", F.array(*places)).select(
        "filter_key", "country", "country_name", F.inline("_places")
    )


def initial_direction(key: str) -> str:
    """Direction a newly chosen sort key starts with."""
    return "asc" if key == "country" else "desc"


def headline_cards(headline: DataFrame) -> DataFrame:
    """The four headline figures of each filter, with what they count."""
    unknown = F.col("unknown_country_channel_count")
    excluded = F.concat(F.lit("Excludes "), count_label(unknown), F.lit(" channels with no declared country"))
    rows = []
    for i, (label, column, note) in enumerate(HEADLINE_CARDS):
        text = F.lit(note)
        if column == "represented_country_count":
            text = F.when(unknown > 0, excluded).otherwise(text)
        rows.append(
            F.struct(
                F.lit(i).alias("position"), F.lit(label).alias("label"), count_label(F.col(column)).alias("value"),
                text.alias("note"),
            )
        )
    return headline.select("filter_key", F.inline(F.array(*rows)))


def page_lines(index: DataFrame, counts: DataFrame, page_size: int) -> DataFrame:
    """The line above each creator page: how many of the country's published creators it shows."""
    total = F.col("total_rows")
    # One row per country code and sort order.
    joined = index.join(
        F.broadcast(counts.select("country", "sort_order", "total_rows")), ["country", "sort_order"]
    )
    shown = F.least(F.lit(page_size).cast("long"), total - F.col("page") * page_size)
    place = F.when(
        F.col("page_count") > 1,
        F.concat(
            F.lit(", page "), (F.col("page") + 1).cast("string"), F.lit(" of "), F.col("page_count").cast("string")
        ),
    ).otherwise(F.lit(""))
    line = F.concat(
        F.lit("Showing "), count_label(shown), F.lit(" of "), count_label(total), F.lit(" published creators"), place
    )
    return joined.select("country", "sort_order", "page", line.alias("line"))


def country_lines(country_rows: DataFrame, listing: DataFrame) -> DataFrame:
    """The sentence read out when a country is opened. A country may count creators and list none."""
    listed = listing.groupBy("country").agg(F.count("*").alias("listed"))
    named = with_display_name(country_rows.join(listed, "country", "left"))
    line = F.concat(
        "country_name", F.lit(": "), count_label(F.col("creator_count")), F.lit(" creators, "),
        count_label(F.col("represented_video_count")), F.lit(" represented videos, "),
        count_label(F.coalesce("listed", F.lit(0).cast("long"))), F.lit(" published creators listed."),
    )
    return named.select("country", line.alias("line"))


def dataset_catalog(datasets: DataFrame) -> DataFrame:
    return datasets.select(
        "dataset_id", "display_name", "version", "corpus_class", "source_kind", "occurrence_unit", "source_citation",
        "snapshot_digest", short_digest(F.col("snapshot_digest")).alias("digest_label"),
    )


def _dataset_count_text(n: Column) -> Column:
    return F.concat(n.cast("string"), F.lit(" "), plural(n, "dataset"))


def filter_options(filters: DataFrame, datasets: DataFrame) -> DataFrame:
    """The choices of the filter list: a label and a note per published filter.

    Both inputs are catalogue tables. A release with one filter shows a statement instead.
    """
    ds = datasets.select(
        F.col("dataset_id").alias("_only"), "display_name", "version", "corpus_class", "occurrence_unit"
    )
    only = F.when(F.size("datasets") == 1, F.get("datasets", F.lit(0)))
    joined = filters.withColumn("_only", only).join(ds, "_only", "left")
    single_note = F.concat(
        "version", F.lit(" · counts "), F.lower("occurrence_unit"),
        F.when(F.col("corpus_class") == "Comparison", F.lit(" · comparison corpus")).otherwise(F.lit("")),
    )
    comparison_only = F.col("corpus_classes") == F.array(F.lit("Comparison"))
    note = (
        F.when(F.col("display_name").isNotNull(), single_note)
        .when(comparison_only, F.lit(COMPARISON_NOTE))
        .otherwise(_dataset_count_text(F.size("datasets")))
    )
    return joined.select(
        "position", "filter_key", F.coalesce("display_name", "label").alias("option_label"), note.alias("note")
    )


def single_filter_statement(catalog: Catalog) -> str | None:
    """What replaces the options when there is nothing to choose."""
    if len(catalog.filters) > 1:
        return None
    n = len(catalog.datasets)
    scope = "its single dataset" if n == 1 else f"all {n} datasets"
    return f"This release publishes one filter, covering {scope}."


def release_summary(resolved: DataFrame, headline: DataFrame, catalog: Catalog) -> DataFrame:
    """The sentences shown for each selection.

    ``resolved`` has the columns datasets, exact and filter_key; links with the same selection are
    counted together before the headline is joined.
    """
    n = len(catalog.datasets)
    all_sets = f"all {n} dataset" + ("" if n == 1 else "s")
    views = resolved.groupBy("datasets", "filter_key", "exact").agg(F.count("*").alias("links"))
    # One row per filter of the catalogue.
    joined = views.join(F.broadcast(headline), "filter_key", "left")
    chosen = F.when(F.size("datasets") == 0, n).otherwise(F.size("datasets"))
    buckets = F.col("country_bucket_count")
    scope = F.concat(
        F.lit("Showing "),
        F.when(chosen == n, F.lit(all_sets)).otherwise(
            F.concat(chosen.cast("string"), F.lit(f" of {n} datasets"))
        ),
        F.lit(", across "), buckets.cast("string"), F.lit(" country "), plural(buckets, "bucket"), F.lit("."),
    )
    # The announcement counts "all N datasets" without a singular.
    announced = F.when(F.size("datasets") == 0, F.lit(f"all {n} datasets")).otherwise(
        F.array_join("datasets", " and ")
    )
    announcement = F.concat(
        F.lit("Showing "), announced, F.lit(". "),
        count_label(F.col("creator_count")), F.lit(" creators, "),
        count_label(F.col("represented_video_count")), F.lit(" represented videos, across "),
        count_label(buckets), F.lit(" country "), plural(buckets, "bucket"), F.lit("."),
        F.when(F.col("exact"), F.lit("")).otherwise(F.lit(FALLBACK_NOTE)),
    )
    return joined.select(
        F.array_join("datasets", "+").alias("selection"), "filter_key", "exact", "links", scope.alias("scope_line"),
        announcement.alias("announcement"),
    )


def country_missing_note(country: Column) -> Column:
    return F.concat(country, F.lit(" is not in the current filter"))
