"""Exact counts per published filter.

Filters overlap, so their distinct counts cannot be added up from parts. Joining every
occurrence to every filter would multiply the largest table. Instead each video is reduced
once to the set of datasets it occurs in and videos with the same set are counted together;
filters are matched against those counts:

1. occurrences -> one row per video and dataset -> one row per video. Counted map-side before
   each shuffle, so a video holding a third of all rows costs its tasks one row per dataset.
2. join with the resolutions, one row per video on both sides.
3. count by (state, channel, dataset set), again combined map-side, before channel metadata
   is joined: a channel with a third of all videos is then a handful of rows.
4. filters are matched against the dataset sets of the counted rows.

A dataset is a bit, by its place in the catalogue, of one of the columns w0, w1, ... of 62 bits
each, so sets are joined by bit_or and compared as numbers. A video has one dataset set, so
sums over sets are exact distinct counts. Occurrences do add up, so they are counted under the set of
their one dataset, beside the videos. Filters are an inverted index: each kind of dataset that
the filters tell apart has the bitmap of its filters, again in words of 62 bits.
A counted row meets one entry per kind in its set and word of filters, and
becomes rows of single filters only once these are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provtally.functions.countries import UNKNOWN_COUNTRY, country_bucket
from provtally.functions.identifiers import is_video_id
from provtally.functions.sql import text_array, text_list
from provtally.sources.catalog import Catalog

# The resolution states, in published order.
STATES = ("resolved", "unavailableUnclassified", "retryableOrPending", "invalid", "terminalFailure")
RESOLVED = "resolved"
PENDING = "retryableOrPending"
INVALID = "invalid"

#: Datasets of a catalogue up to which a video's occurrences are counted in one column each.
COLUMNS = 16
#: Datasets, or filters, in a word; the sign stays clear.
WORD_BITS = 62


def effective_state(video_id: Column, state: Column) -> Column:
    """A malformed identifier is invalid whatever was recorded; one without a known state is pending."""
    known = F.when(state.isin(*STATES), state)
    return F.when(~is_video_id(video_id), F.lit(INVALID)).otherwise(F.coalesce(known, F.lit(PENDING)))


def one_per_video(resolutions: DataFrame, *counts: Column) -> DataFrame:
    """(video_id, state, channel_key, and aggregates ``counts``): of several records of a video the first state in published
    order stays, one without a known state being last; of a resolved video the least channel."""
    states = F.array(*[F.lit(s) for s in STATES])
    rank = F.nullif(F.coalesce(F.array_position(states, F.col("state")).cast("int"), F.lit(0)), F.lit(0))
    channel = F.when(F.col("state") == RESOLVED, F.col("channel_key"))
    first = resolutions.groupBy("video_id").agg(F.min(rank).alias("_rank"), F.min(channel).alias("channel_key"), *counts)
    state = F.get(states, F.col("_rank") - 1).alias("state")
    return first.withColumn("state", state).drop("_rank")


def one_per_channel(channels: DataFrame, *counts: Column) -> DataFrame:
    """Channel metadata with one row per key: the latest reading, of ties the greater values."""
    values = [c for c in ("last_observed_at", "display_name", "country") if c in channels.columns]
    return (
        channels.where(F.col("channel_key").isNotNull())
        .groupBy("channel_key")
        .agg(F.max(F.struct(*values)).alias("_latest"), *counts)
        .withColumns({v: F.col(f"_latest.{v}") for v in values})
        .drop("_latest")
    )


def words(catalog: Catalog) -> list[str]:
    """Names of the columns that hold a dataset set."""
    return [f"w{i}" for i in range(max(1, -(-len(catalog.datasets) // WORD_BITS)))]


def positions(*sets: str) -> str:
    """SQL for the places of the datasets in a set, given its words as SQL; only bits up to a word's highest are looked at."""
    parts = [
        f"transform(filter(sequence(0, coalesce(length(bin({word})), 1) - 1), b -> ({word} & shiftleft(1L, b)) <> 0), b -> b + {i * WORD_BITS})"
        for i, word in enumerate(sets)
    ]
    return f"concat({', '.join(parts)})"


def kept_words(catalog: Catalog, dataset_ids: list[str]) -> list[str]:
    """SQL for the words of a set without all but these datasets."""
    place = {d: i for i, d in enumerate(catalog.dataset_ids)}
    masks = [0] * len(words(catalog))
    for d in dataset_ids:
        masks[place[d] // WORD_BITS] |= 1 << place[d] % WORD_BITS
    return [f"({w} & {mask}L)" for w, mask in zip(words(catalog), masks, strict=True)]


def dataset_at(catalog: Catalog, place: str) -> str:
    """SQL for the id of the dataset at a place of the catalogue; null for null."""
    return f"get({text_array(catalog.dataset_ids)}, {place})"


def _marked(observations: DataFrame, catalog: Catalog) -> DataFrame:
    """(video_id, word, bit) of occurrences in datasets of the catalogue."""
    rows = [(d, i // WORD_BITS, 1 << i % WORD_BITS) for i, d in enumerate(catalog.dataset_ids)]
    places = observations.sparkSession.createDataFrame(rows, "dataset_id string, word int, bit long")
    listed = observations.where(f"dataset_id in ({text_list(catalog.dataset_ids)})")
    # One row per dataset of a catalogue that the driver holds.
    return listed.join(F.broadcast(places), "dataset_id").select("video_id", "word", "bit")


def _union(catalog: Catalog) -> list[Column]:
    """The set of all marked rows of a group."""
    return [
        F.bit_or(F.when(F.col("word") == i, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(w)
        for i, w in enumerate(words(catalog))
    ]


def set_counts(observations: DataFrame, catalog: Catalog) -> DataFrame:
    """(w0, w1, ...) with the videos that occur in exactly these datasets."""
    sets = _marked(observations, catalog).groupBy("video_id").agg(*_union(catalog))
    return sets.groupBy(*words(catalog)).agg(F.count("*").alias("videos"))


def _in_lists(observations: DataFrame, catalog: Catalog) -> DataFrame:
    """(video_id, w0, w1, ..., members): each video's dataset set, and its occurrences n by dataset."""
    return (
        _marked(observations, catalog)
        .groupBy("video_id", "word", "bit")
        .agg(F.count("*").alias("n"))
        .groupBy("video_id")
        # At most one entry per dataset of the catalogue.
        .agg(*_union(catalog), F.collect_list(F.struct("word", "bit", "n")).alias("members"))
    )


def _in_columns(observations: DataFrame, catalog: Catalog) -> DataFrame:
    """The same with a column of counts per dataset, which takes one shuffle of one row per task and video."""
    place = {d: (f"n{i}", i // WORD_BITS, 1 << i % WORD_BITS) for i, d in enumerate(catalog.dataset_ids)}
    listed = observations.where(f"dataset_id in ({text_list(place)})")
    counts = listed.groupBy("video_id").agg(*[F.count_if(F.col("dataset_id") == d).alias(n) for d, (n, _, _) in place.items()])
    sets = [
        " | ".join(["0L", *[f"if({n} > 0, {bit}L, 0L)" for n, at, bit in place.values() if at == i]]) + f" as {w}"
        for i, w in enumerate(words(catalog))
    ]
    each = ", ".join(f"if({n} > 0, named_struct('word', {at}, 'bit', {bit}L, 'n', {n}), null)" for n, at, bit in place.values())
    return counts.selectExpr("video_id", *sets, f"array_compact(array({each})) as members")


def _counted(observations: DataFrame, resolutions: DataFrame, catalog: Catalog, *keys: str) -> DataFrame:
    """(*keys, w0, w1, ...) with videos and occurrences.

    A video counts under its dataset set, its occurrences under the sets of one dataset each.
    """
    recorded = one_per_video(resolutions)
    videos = _in_columns(observations, catalog) if len(catalog.datasets) <= COLUMNS else _in_lists(observations, catalog)
    joined = videos.join(recorded, "video_id", "left").withColumn(
        "state", effective_state(F.col("video_id"), F.col("state"))
    )
    sets = words(catalog)
    single = ", ".join(f"'{w}', if(m.word = {i}, m.bit, 0L)" for i, w in enumerate(sets))
    whole = ", ".join(f"'{w}', {w}" for w in sets)
    entries = f"""inline(array_append(
        transform(members, m -> named_struct({single}, 'videos', 0L, 'occurrences', m.n)),
        named_struct({whole}, 'videos', 1L, 'occurrences', 0L)))"""
    return (
        joined.withColumn("channel_key", F.when(F.col("state") == RESOLVED, F.col("channel_key")))
        .select(*keys, F.struct(*sets, "members").alias("v"))
        .select(*keys, "v.*")
        .selectExpr(*keys, entries)
        .groupBy(*keys, *sets)
        .agg(F.sum("videos").alias("videos"), F.sum("occurrences").alias("occurrences"))
    )


def channel_counts(observations: DataFrame, resolutions: DataFrame, catalog: Catalog) -> DataFrame:
    """(state, channel_key, w0, w1, ...) with videos and occurrences; channel only when resolved."""
    return _counted(observations, resolutions, catalog, "state", "channel_key")


def _filter_index(spark: SparkSession, catalog: Catalog) -> tuple[DataFrame, list[int]]:
    """(kind, word, filters): the filters of each kind of dataset as bitmaps; and the kind of each dataset, -1 for none.

    Datasets that no filter tells apart are of one kind.
    """
    place = {d: i for i, d in enumerate(catalog.dataset_ids)}
    member_of: list[list[int]] = [[] for _ in place]
    for number, flt in enumerate(catalog.filters):
        for d in set(catalog.members(flt)):
            member_of[place[d]].append(number)
    kinds: dict[tuple[int, ...], int] = {}
    kind = [kinds.setdefault(tuple(m), len(kinds)) if m else -1 for m in member_of]
    rows: dict[tuple[int, int], int] = {}
    for numbers, k in kinds.items():
        for n in numbers:
            rows[k, n // WORD_BITS] = rows.get((k, n // WORD_BITS), 0) | 1 << n % WORD_BITS
    index = [(k, word, bits) for (k, word), bits in rows.items()]
    return spark.createDataFrame(index, "kind int, word int, filters long"), kind


def in_filters(rows: DataFrame, catalog: Catalog, *values: str) -> DataFrame:
    """Each counted row once per filter that keeps any of its datasets.

    ``values`` are the counts of a row; its other columns tell it apart. The set's words are left out.
    """
    keys = [c for c in rows.columns if c not in values]
    others = [k for k in keys if k not in words(catalog)]
    index, kind = _filter_index(rows.sparkSession, catalog)
    kind_of = f"array({', '.join(map(str, kind))})" if kind else "cast(array() as array<int>)"
    found = f"array_distinct(transform({positions(*words(catalog))}, p -> get({kind_of}, p)))"
    touched = rows.selectExpr(*keys, *values, f"explode({found}) as kind").join(index, "kind")
    once = touched.groupBy(*keys, "word").agg(F.bit_or("filters").alias("filters"), *[F.max(v).alias(v) for v in values])
    key = f"get({text_array([f.key for f in catalog.filters])}, word * {WORD_BITS} + bit)"
    single = once.selectExpr(*others, *values, "word", f"explode({positions('filters')}) as bit")
    return single.selectExpr(*others, f"{key} as filter_key", *values)


def with_country(df: DataFrame, channels: DataFrame) -> DataFrame:
    """Add the declared country of each row's channel; a channel without metadata declared none.

    Rows without a channel match nothing; the second key deals them over all tasks, where a null
    key alone would send them to one.
    """
    places = one_per_channel(channels).select(
        "channel_key", country_bucket(F.col("country")).alias("country"), F.lit(0).cast("long").alias("_deal")
    )
    deal = F.when(F.col("channel_key").isNull(), F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("long"))
    return (
        df.withColumn("_deal", deal)
        .join(places, ["channel_key", "_deal"], "left")
        .drop("_deal")
        .withColumn("country", F.coalesce("country", F.lit(UNKNOWN_COUNTRY)))
    )


def dataset_set_cells(counts: DataFrame, channels: DataFrame, catalog: Catalog) -> DataFrame:
    """(state, country, w0, w1, ...) of ``channel_counts`` with videos, occurrences and creators; country only when resolved.

    A channel is represented in a filter when any of its videos is, so it is counted once, under
    all datasets of its videos. Those are at hand in the rows of its occurrences.
    """
    sets = words(catalog)
    own = ", ".join(f"'{w}', {w}, 'm{w}', 0L" for w in sets)
    channel = ", ".join(f"'{w}', cast(null as bigint), 'm{w}', {w}" for w in sets)
    entries = with_country(counts, channels).selectExpr(
        "state",
        f"if(state = '{RESOLVED}', country, null) as country",
        f"""inline(array_compact(array(
            named_struct('channel_key', cast(null as bigint), {own}, 'videos', videos, 'occurrences', occurrences),
            if(channel_key is not null and occurrences > 0,
               named_struct('channel_key', channel_key, {channel}, 'videos', 0L, 'occurrences', 0L), null))))""",
    )
    return (
        entries.groupBy("state", "country", "channel_key", *sets)
        .agg(*_sums("videos", "occurrences"), *[F.bit_or(f"m{w}").alias(f"m{w}") for w in sets])
        .selectExpr("state", "country", *[f"coalesce({w}, m{w}) as {w}" for w in sets], "videos", "occurrences",
                    "if(channel_key is null, 0L, 1L) as creators")
        .groupBy("state", "country", *sets)
        .agg(*_sums("videos", "occurrences", "creators"))
    )


def _sums(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def filter_cells(observations: DataFrame, resolutions: DataFrame, channels: DataFrame, catalog: Catalog) -> DataFrame:
    return cells_of(channel_counts(observations, resolutions, catalog), channels, catalog)


def cells_of(counts: DataFrame, channels: DataFrame, catalog: Catalog) -> DataFrame:
    """(filter_key, state, country) with creators, videos and occurrences: what all totals are read from.

    Takes ``channel_counts``. A few hundred rows per filter, so a job that needs several totals
    should keep this table.
    """
    values = ("creators", "videos", "occurrences")
    rows = in_filters(dataset_set_cells(counts, channels, catalog), catalog, *values)
    return rows.groupBy("filter_key", "state", "country").agg(*_sums(*values))


def country_rows(cells: DataFrame) -> DataFrame:
    """The published country rows. Unresolved videos belong to no country, so none are unavailable here."""
    return cells.where(F.col("state") == RESOLVED).select(
        "filter_key",
        "country",
        F.col("creators").alias("creator_count"),
        F.col("videos").alias("represented_video_count"),
        F.col("occurrences").alias("source_occurrence_count"),
        F.col("videos").alias("resolved_video_count"),
        F.lit(0).cast("long").alias("unavailable_video_count"),
    )


def country_summary(
    observations: DataFrame, resolutions: DataFrame, channels: DataFrame, catalog: Catalog
) -> DataFrame:
    return country_rows(filter_cells(observations, resolutions, channels, catalog))


def coverage_rows(cells: DataFrame, catalog: Catalog) -> DataFrame:
    """One row per filter: occurrences, distinct videos and the five states they fall into.

    Takes any table of (filter_key, state) with videos and occurrences.
    """
    per_filter = cells.groupBy("filter_key").agg(
        F.sum("occurrences").alias("input_occurrence_count"),
        F.sum("videos").alias("distinct_input_video_count"),
        *[F.sum(F.when(F.col("state") == s, F.col("videos"))).alias(s) for s in STATES],
    )
    return every_filter(per_filter, catalog)


def headline_rows(cells: DataFrame, catalog: Catalog) -> DataFrame:
    """Totals per filter. A channel has one country, so creators add up over countries."""
    known = F.col("country").isNotNull() & (F.col("country") != UNKNOWN_COUNTRY)
    unknown = F.col("country") == UNKNOWN_COUNTRY
    per_filter = cells.groupBy("filter_key").agg(
        F.sum("creators").alias("creator_count"),
        F.sum("videos").alias("represented_video_count"),
        F.sum("occurrences").alias("source_occurrence_count"),
        F.count_if(known).alias("represented_country_count"),
        F.count("country").alias("country_bucket_count"),
        F.sum(F.when(known, F.col("creators"))).alias("known_country_channel_count"),
        F.sum(F.when(unknown, F.col("creators"))).alias("unknown_country_channel_count"),
    )
    return every_filter(per_filter, catalog)


def headline_totals(
    observations: DataFrame, resolutions: DataFrame, channels: DataFrame, catalog: Catalog
) -> DataFrame:
    return headline_rows(filter_cells(observations, resolutions, channels, catalog), catalog)


def state_counts(observations: DataFrame, resolutions: DataFrame, catalog: Catalog) -> DataFrame:
    """(filter_key, state) with videos and occurrences."""
    values = ("videos", "occurrences")
    rows = in_filters(_counted(observations, resolutions, catalog, "state"), catalog, *values)
    return rows.groupBy("filter_key", "state").agg(*_sums(*values))


def coverage_partition(observations: DataFrame, resolutions: DataFrame, catalog: Catalog) -> DataFrame:
    return coverage_rows(state_counts(observations, resolutions, catalog), catalog)


def every_filter(per_filter: DataFrame, catalog: Catalog) -> DataFrame:
    """Zero rows for filters nothing fell into."""
    keys = catalog.filters_frame(per_filter.sparkSession).select("filter_key")
    value_columns = [c for c in per_filter.columns if c != "filter_key"]
    return keys.join(per_filter, "filter_key", "left").na.fill(0, value_columns)


def represented_videos(observations: DataFrame, catalog: Catalog) -> DataFrame:
    """Distinct identifiers per filter, whatever their state."""
    rows = in_filters(set_counts(observations, catalog), catalog, "videos")
    return every_filter(
        rows.groupBy("filter_key").agg(F.sum("videos").alias("represented_video_count")), catalog
    )


def source_occurrences(observations: DataFrame, catalog: Catalog) -> DataFrame:
    """Retained rows per filter. Rows do add up, so they are counted per dataset first."""
    membership = catalog.membership_frame(observations.sparkSession)
    per_dataset = observations.groupBy("dataset_id").agg(F.count("*").alias("n"))
    rows = per_dataset.join(membership, "dataset_id").groupBy("filter_key").agg(
        F.sum("n").alias("source_occurrence_count")
    )
    return every_filter(rows, catalog)


def creators(observations: DataFrame, resolutions: DataFrame, catalog: Catalog) -> DataFrame:
    """Distinct channels per filter that its videos resolved to."""
    sets = (
        channel_counts(observations, resolutions, catalog)
        .where(F.col("channel_key").isNotNull() & (F.col("occurrences") > 0))
        .groupBy("channel_key")
        .agg(*[F.bit_or(w).alias(w) for w in words(catalog)])
        .groupBy(*words(catalog))
        .agg(F.count("*").alias("creators"))
    )
    rows = in_filters(sets, catalog, "creators")
    return every_filter(rows.groupBy("filter_key").agg(F.sum("creators").alias("creator_count")), catalog)


def occurrences_by_unit(observations: DataFrame, datasets: DataFrame) -> DataFrame:
    """Occurrences by the unit they count and the kind of source they come from."""
    per_dataset = observations.groupBy("dataset_id").agg(F.count("*").alias("n"))
    return (
        per_dataset.join(datasets.select("dataset_id", "occurrence_unit", "source_kind"), "dataset_id")
        .groupBy("occurrence_unit", "source_kind")
        .agg(F.sum("n").alias("occurrences"), F.count("*").alias("datasets"))
    )


def dataset_overlap(observations: DataFrame, catalog: Catalog) -> DataFrame:
    """How many videos are in n datasets, and how far the per-dataset figures overshoot the combined one."""
    size = " + ".join(f"bit_count({w})" for w in words(catalog))
    sizes = set_counts(observations, catalog).selectExpr(f"{size} as dataset_count", "videos")
    histogram = sizes.groupBy("dataset_count").agg(F.sum("videos").alias("videos"))
    # At most one row per dataset count, so the histogram fits in one row beside its totals.
    folded = histogram.groupBy().agg(
        F.sum("videos").alias("combined_videos"),
        F.sum(F.col("videos") * F.col("dataset_count")).alias("summed_videos"),
        F.collect_list(F.struct("dataset_count", "videos")).alias("rows"),
    )
    return folded.select(F.explode("rows").alias("r"), "combined_videos", "summed_videos").select(
        "r.dataset_count",
        "r.videos",
        "combined_videos",
        "summed_videos",
        (F.col("summed_videos") - F.col("combined_videos")).alias("overshoot"),
    )


def dataset_pairs(observations: DataFrame, catalog: Catalog) -> DataFrame:
    """Videos in both of two datasets, for every pair that shares any."""
    return (
        set_counts(observations, catalog)
        .selectExpr(f"{positions(*words(catalog))} as places", "videos")
        .selectExpr("places", "videos", "explode(places) as a")
        .selectExpr("videos", "a", "explode(filter(places, p -> p > a)) as b")
        .groupBy("a", "b")
        .agg(F.sum("videos").alias("shared_videos"))
        .selectExpr(f"{dataset_at(catalog, 'a')} as a", f"{dataset_at(catalog, 'b')} as b", "shared_videos")
        .selectExpr("least(a, b) as dataset_a", "greatest(a, b) as dataset_b", "shared_videos")
    )
