"""Creators of one filter: their rows, what of them is published, and their ranked pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from provtally.functions.countries import country_bucket
from provtally.functions.identifiers import public_channel_key
from provtally.functions.labels import date_label
from provtally.functions.sql import quote
from provtally.operators.metrics import COLUMNS, channel_counts, dataset_at, kept_words, one_per_channel, positions
from provtally.session import work_root
from provtally.sources.catalog import Catalog, PublishedFilter

# The sort orders, the first being the default.
BY_VIDEOS = "representedVideoCountDesc"
BY_NAME = "displayNameAsc"
SORT_ORDERS = (BY_VIDEOS, BY_NAME)

# monotonically_increasing_id: partition number above this many bits of row number.
_ROW_BITS = 33
_PAGE_BLOCK = 10_000


def creator_rows(
    observations: DataFrame, resolutions: DataFrame, channels: DataFrame, catalog: Catalog, flt: PublishedFilter
) -> DataFrame:
    """One row per channel of the filter, with its videos per dataset."""
    return creator_rows_of(channel_counts(observations, resolutions, catalog), channels, catalog, flt)


def creator_rows_of(counts: DataFrame, channels: DataFrame, catalog: Catalog, flt: PublishedFilter) -> DataFrame:
    """The same out of ``channel_counts``."""
    of_channels = counts.where("channel_key is not null and videos > 0")
    members = list(dict.fromkeys(catalog.members(flt)))
    per_channel = _in_columns(of_channels, catalog, members) if 0 < len(members) <= COLUMNS else _in_lists(of_channels, catalog, members)
    return _with_metadata(per_channel, channels)


def _in_lists(counts: DataFrame, catalog: Catalog, members: list[str]) -> DataFrame:
    """(channel_key, represented_video_count, dataset_breakdown) of channels with videos in these datasets."""
    kept = positions(*kept_words(catalog, members))
    return (
        counts.selectExpr("channel_key", "videos", f"{kept} as kept")
        .where("size(kept) > 0")
        # The entry without a dataset counts the channel's videos once each.
        .selectExpr("channel_key", "videos", "explode_outer(array_append(kept, null)) as place")
        .groupBy("channel_key", "place")
        .agg(F.sum("videos").alias("represented_video_count"))
        .selectExpr("channel_key", f"{dataset_at(catalog, 'place')} as dataset_id", "represented_video_count")
        .groupBy("channel_key")
        # At most one entry per dataset of the catalogue.
        .agg(
            F.expr("max(if(dataset_id is null, represented_video_count, null)) as total"),
            F.expr(
                "array_sort(collect_list(if(dataset_id is null, null,"
                " named_struct('dataset_id', dataset_id, 'represented_video_count', represented_video_count))))"
                " as dataset_breakdown"
            ),
        )
        .withColumnRenamed("total", "represented_video_count")
    )


def _in_columns(counts: DataFrame, catalog: Catalog, members: list[str]) -> DataFrame:
    """The same with a column of counts per dataset, which takes one shuffle of one row per task and channel."""
    words = [(d, w) for d in members for w in kept_words(catalog, [d]) if not w.endswith("& 0L)")]
    any_kept = " or ".join(f"{w} <> 0" for w in kept_words(catalog, members))
    each = [F.expr(f"sum(if({w} <> 0, videos, null)) as n{i}") for i, (_, w) in enumerate(words)]
    entries = ", ".join(
        f"if(n{i} is null, null, named_struct('dataset_id', {quote(d)}, 'represented_video_count', n{i}))" for i, (d, _) in enumerate(words)
    )
    summed = counts.where(any_kept).groupBy("channel_key").agg(F.sum("videos").alias("represented_video_count"), *each)
    return summed.selectExpr("channel_key", "represented_video_count", f"array_sort(array_compact(array({entries}))) as dataset_breakdown")


def _with_metadata(per_channel: DataFrame, channels: DataFrame) -> DataFrame:
    """A channel without metadata has no name to list, so it is counted in totals only."""
    meta = one_per_channel(channels).select(
        "channel_key", "display_name", country_bucket(F.col("country")).alias("country"), "last_observed_at"
    )
    return per_channel.join(meta, "channel_key").select(
        "channel_key", "display_name", "country", "represented_video_count", "dataset_breakdown", "last_observed_at"
    )


def breakdown_label(breakdown: Column) -> Column:
    """``dataset (n), dataset (n)`` in array order."""
    return F.array_join(
        F.transform(
            breakdown,
            lambda b: F.concat(b["dataset_id"], F.lit(" ("), b["represented_video_count"].cast("string"), F.lit(")")),
        ),
        ", ",
    )


def creator_labels(rows: DataFrame) -> DataFrame:
    """Creator rows as the table shows them."""
    return rows.withColumn("datasets_label", breakdown_label(F.col("dataset_breakdown"))).withColumn(
        "observed_label", date_label(F.col("last_observed_at"))
    )


def disclosed(rows: DataFrame, threshold: int) -> DataFrame:
    """Channels that may be listed. Totals are taken before this and still count everybody."""
    return rows.where(F.col("represented_video_count") >= threshold)


def without_removed(rows: DataFrame, removals: DataFrame) -> DataFrame:
    """Channels without a removal request."""
    return rows.join(removals.select("channel_key"), "channel_key", "left_anti")


def published(rows: DataFrame, removals: DataFrame, threshold: int, salt: str) -> DataFrame:
    """The public listing: disclosed, not removed, under pseudonymous keys only."""
    kept = without_removed(disclosed(rows, threshold), removals)
    return kept.withColumn("public_channel_key", public_channel_key(F.col("channel_key"), salt)).select(
        "public_channel_key", "display_name", "country", "represented_video_count", "dataset_breakdown",
        "last_observed_at",
    )


def sort_columns(sort_order: str) -> list[Column]:
    """Row order inside a country; the key makes it total."""
    name = F.collate(F.col("display_name"), "UNICODE")
    if sort_order == BY_VIDEOS:
        return [F.col("represented_video_count").desc(), name.asc(), F.col("public_channel_key").asc()]
    if sort_order == BY_NAME:
        return [name.asc(), F.col("public_channel_key").asc()]
    raise ValueError(f"unknown sort order: {sort_order}")


def ranked(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Add ``rank`` inside each group and the group's ``total_rows`` without gathering a group anywhere.

    The rows are sorted over all tasks and the result is checkpointed, so that every row keeps its
    place when it is read again, also after a lost executor. A row's rank is its place inside its
    partition plus the rows of its group in earlier partitions, which a table of one row per
    (partition, group) knows.
    """
    work_root(rows.sparkSession)
    place = rows.orderBy(F.col(group), *order).checkpoint().withColumn("_at", F.monotonically_increasing_id())
    placed = place.withColumn("_part", F.shiftright("_at", _ROW_BITS).cast("int")).withColumn(
        "_row", F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    blocks = placed.groupBy("_part", group).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select(
        "_part",
        group,
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_offset"),
        F.sum("_n").over(W.partitionBy(group)).alias("total_rows"),
    )
    # One row per partition, plus one per further group in it: never more than partitions + groups.
    return (
        placed.join(F.broadcast(offsets), ["_part", group])
        .withColumn("rank", F.col("_row") + F.col("_offset"))
        .drop("_at", "_part", "_row", "_offset")
    )


def creator_ranks(listing: DataFrame, sort_order: str) -> DataFrame:
    return ranked(listing, "country", sort_columns(sort_order)).withColumn("sort_order", F.lit(sort_order))


def paged(listing: DataFrame, page_size: int) -> DataFrame:
    """Every published creator once per sort order, with its page and place."""
    both = creator_ranks(listing, BY_VIDEOS).unionByName(creator_ranks(listing, BY_NAME))
    page = F.floor((F.col("rank") - 1) / page_size)
    pages = F.ceil(F.col("total_rows") / page_size)
    return both.withColumn("page", page).withColumn("page_count", pages).withColumn(
        "next_cursor", F.when(page + 1 < pages, (page + 1).cast("string"))
    )


def first_page(listing: DataFrame, page_size: int, sort_order: str = BY_VIDEOS) -> DataFrame:
    """Top rows of each country.

    Each task keeps its own top rows before the shuffle where Spark limits groups, below its threshold of rows;
    longer pages come out of the ranks, so that no task sorts a country.
    """
    limited = int(listing.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if page_size >= limited:
        ranks = creator_ranks(listing, sort_order).where(F.col("rank") <= page_size)
        return ranks.select(*listing.columns, "rank")
    w = W.partitionBy("country").orderBy(*sort_columns(sort_order))
    top = listing.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= page_size)
    return top.withColumn("rank", F.col("rank").cast("long"))


def page_counts(listing: DataFrame, page_size: int) -> DataFrame:
    """(country, sort_order) with the rows and pages published for it."""
    orders = F.array(*[F.lit(s) for s in SORT_ORDERS])
    return (
        listing.groupBy("country")
        .agg(F.count("*").alias("total_rows"))
        .select(
            "country",
            F.explode(orders).alias("sort_order"),
            "total_rows",
            F.ceil(F.col("total_rows") / page_size).alias("page_count"),
        )
    )


def page_path(release_id: str, country: Column, sort_order: Column, page: Column) -> Column:
    return F.concat(
        F.lit(f"releases/{release_id}/creators/"), country, F.lit("/"), sort_order, F.lit("/page-"),
        page.cast("string"), F.lit(".json"),
    )


def page_index(counts: DataFrame, release_id: str) -> DataFrame:
    """One row per page with its path. Page numbers follow from the counts alone.

    Numbers are laid out in blocks, so a country with very many pages is never one long array.
    """
    blocks = counts.where("page_count > 0").withColumn(
        "_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("page_count") - 1, F.lit(_PAGE_BLOCK)))
    )
    end = F.least(F.col("_start") + _PAGE_BLOCK, F.col("page_count")) - 1
    return blocks.withColumn("page", F.explode(F.sequence(F.col("_start"), end))).select(
        "country", "sort_order", "page_count", "page",
        page_path(release_id, F.col("country"), F.col("sort_order"), F.col("page")).alias("path"),
    )


def page_fetch(requests: DataFrame, counts: DataFrame, release_id: str) -> DataFrame:
    """Each requested page with its path, or why there is none."""
    # One row per country code and sort order.
    found = requests.join(F.broadcast(counts), ["country", "sort_order"], "left")
    missing = F.coalesce("page_count", F.lit(0)) == 0
    outside = (F.col("page") < 0) | (F.col("page") >= F.col("page_count"))
    order_note = F.concat(
        F.lit("this release publishes no pages for the "), "sort_order", F.lit(" order")
    )
    bound_note = F.concat(
        F.lit("page "), (F.col("page") + 1).cast("string"), F.lit(" does not exist; this country has "),
        F.col("page_count").cast("string"),
    )
    ok = ~missing & ~outside
    return found.select(
        "request_id",
        "country",
        "sort_order",
        "page",
        F.when(ok, "ok").otherwise("not-found").alias("status"),
        F.when(ok, page_path(release_id, F.col("country"), F.col("sort_order"), F.col("page"))).alias("path"),
        F.when(missing, order_note).when(outside, bound_note).alias("message"),
    )


def metadata_as_of_each(readings: DataFrame, cutoffs: list[tuple[str, Column]]) -> DataFrame:
    """metadata_as_of for many releases in one pass: (release_id, channel_key, observation_id, ...).

    ``cutoffs`` are (release id, instant). A reading belongs to the interval between two cutoffs that it falls into; the last
    of each channel and interval is found map-side, so a channel read very often sends one row per interval, and stands for
    every release until an interval with a later reading. Readings after the last cutoff belong to none.
    """
    others = [c for c in readings.columns if c not in ("channel_key", "observed_at", "observation_id")]
    named = F.array(*[F.struct(at.alias("at"), F.lit(name).alias("release_id")) for name, at in cutoffs])
    ordered = F.array_sort(F.filter(named, lambda c: c["at"].isNotNull()))
    first = F.size(F.filter(ordered, lambda c: c["at"] < F.col("observed_at")))
    newest = F.max_by(F.struct("observed_at", "observation_id", *others), F.struct("observed_at", "observation_id"))
    last = readings.withColumn("_interval", first).where((F.col("_interval") < F.size(ordered)) & F.col("observed_at").isNotNull())
    last = last.groupBy("channel_key", "_interval").agg(newest.alias("r"))
    # At most one entry per cutoff.
    held = last.groupBy("channel_key").agg(F.array_sort(F.collect_list(F.struct("_interval", "r"))).alias("held"))
    until = F.coalesce(F.get(F.col("held._interval"), F.col("place") + 1), F.size(ordered))
    spread = held.select("channel_key", "held", F.posexplode("held").alias("place", "entry"))
    spread = spread.select("channel_key", F.col("entry.r").alias("r"), F.explode(F.sequence(F.col("entry._interval"), until - 1)).alias("release"))
    return spread.select(F.get(ordered["release_id"], F.col("release")).alias("release_id"), "channel_key", "r.*")


def metadata_as_of(readings: DataFrame, cutoff: Column) -> DataFrame:
    """The last reading of each channel at or before the cutoff; later ones belong to the next release.

    A maximum per channel, not a sorted window: a channel read very often is combined map-side.
    """
    others = [c for c in readings.columns if c not in ("channel_key", "observed_at", "observation_id")]
    newest = F.max_by(
        F.struct("observed_at", "observation_id", *others), F.struct("observed_at", "observation_id")
    )
    return (
        readings.where(F.col("observed_at") <= cutoff)
        .groupBy("channel_key")
        .agg(newest.alias("r"))
        .select("channel_key", "r.*")
    )
