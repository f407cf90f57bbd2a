"""Quantile colour scales over country values, and the map and legend read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provtally.functions.countries import ALPHA2, UNKNOWN_COUNTRY
from provtally.functions.sql import quote, text_array

# Palette, patterns and texts.
PALETTE = ("#1e3a5f", "#2b5488", "#3a70b0", "#5b93d1", "#8fbce8", "#c5dcf5")
PATTERNS = ("sparse-dots", "dots", "diagonal-thin", "diagonal", "cross-thin", "cross")
NO_DATA_COLOR = "#262c36"
NO_DATA_LABEL = "No data"
NO_DATA_LEGEND = "No data in this release"
BIN_COUNT = 5

# Metric key -> (label, unit, column).
METRICS = {
    "creators": ("Creators", "distinct channels", "creator_count"),
    "videos": ("Represented videos", "distinct video identifiers", "represented_video_count"),
    "occurrences": ("Source occurrences", "retained source records", "source_occurrence_count"),
}


def metric_column(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    return METRICS[metric][2]


def metric_long(countries: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """(filter_key, country, metric, value) out of the country rows."""
    chosen = list(METRICS) if metrics is None else metrics
    rows = ", ".join(f"{quote(m)}, {metric_column(m)}" for m in chosen)
    return countries.selectExpr("filter_key", "country", f"stack({len(chosen)}, {rows}) as (metric, value)")


def _with_breaks(long_values: DataFrame) -> DataFrame:
    """Per scale: sorted positive values (``vs``) and the inner breaks between them.

    Breaks lie at even places of the sorted values, interpolated linearly and rounded half up.
    A group holds one value per country code, so the array is short.
    """
    steps = min(BIN_COUNT, len(PALETTE))
    at = "cast(floor(p) as int)"
    above = "cast(ceil(p) as int)"
    value = f"get(vs, {at}) + (get(vs, {above}) - get(vs, {at})) * (p - floor(p))"
    positions = f"transform(sequence(1, {steps - 1}), e -> e / {float(steps)}D * (size(vs) - 1))"
    return (
        long_values.groupBy("filter_key", "metric")
        .agg(F.expr("sort_array(collect_list(if(value > 0, value, null))) as vs"))
        .selectExpr(
            "filter_key", "metric", "vs", f"transform({positions}, p -> floor({value} + 0.5D)) as breaks"
        )
    )


def scales(long_values: DataFrame) -> DataFrame:
    """(filter_key, metric) with the scale's method and bins.

    Edges are the lowest value, the breaks and the highest, each once. A bin starts one above the
    edge it shares with the bin below; bins left without a value are dropped.
    """
    last = len(PALETTE) - 1
    shade = f"cast(least(floor(e / greatest(size(edges) - 2, 1) * {len(PALETTE)}), {last}) as int)"
    low = "get(edges, e) + if(e = 0, 0, 1)"
    many = (
        f"filter(transform(sequence(0, size(edges) - 2),"
        f" e -> named_struct('min', {low}, 'max', get(edges, e + 1), 'shade', {shade})), b -> b.min <= b.max)"
    )
    single = f"array(named_struct('min', get(edges, 0), 'max', get(edges, 0), 'shade', {last}))"
    label = "if(b.min = b.max, format_number(b.min, 0), concat(format_number(b.min, 0), '–', format_number(b.max, 0)))"
    full = (
        f"named_struct('min', b.min, 'max', b.max, 'label', {label},"
        f" 'color', get({text_array(PALETTE)}, b.shade), 'pattern', get({text_array(PATTERNS)}, b.shade))"
    )
    return (
        _with_breaks(long_values)
        .selectExpr(
            "filter_key",
            "metric",
            "if(size(vs) = 0, array(), array_sort(array_distinct(concat(array(vs[0], vs[size(vs) - 1]), breaks))))"
            " as edges",
        )
        .selectExpr(
            "filter_key",
            "metric",
            "case size(edges) when 0 then 'empty' when 1 then 'single-value' else 'quantile' end as method",
            f"case size(edges) when 0 then array() when 1 then {single} else {many} end as plain",
        )
        .selectExpr("filter_key", "metric", "method", f"transform(plain, b -> {full}) as bins")
    )


def quantile_breaks(long_values: DataFrame) -> DataFrame:
    """(filter_key, metric, q, break_value): the inner breaks of every scale that has values."""
    return (
        _with_breaks(long_values)
        .where("size(vs) > 0")
        .selectExpr("filter_key", "metric", "posexplode(breaks) as (q, break_value)")
        .withColumn("q", F.col("q") + 1)
    )


def bin_rows(scale_rows: DataFrame) -> DataFrame:
    """One row per bin; a scale without bins keeps one row with nulls."""
    return scale_rows.select("filter_key", "metric", "method", F.posexplode_outer("bins").alias("position", "b")).select(
        "filter_key", "metric", "method", "position", "b.min", "b.max", "b.label", "b.color", "b.pattern"
    )


# The bin of a value: the one it lies in, else the first for zero and the last for anything else.
_BIN_OF = (
    "if(value is null or size(bins) = 0, null, coalesce(get(filter(bins, b -> value between b.min and b.max), 0),"
    " get(bins, if(value = 0, 0, size(bins) - 1))))"
)


def country_bins(long_values: DataFrame, scale_rows: DataFrame) -> DataFrame:
    """Each country value with its bin's label, colour and pattern."""
    joined = long_values.join(scale_rows, ["filter_key", "metric"], "left")
    return joined.withColumn("bin", F.expr(_BIN_OF)).select(
        "filter_key",
        "metric",
        "country",
        "value",
        F.coalesce("bin.label", F.lit(NO_DATA_LABEL)).alias("bin_label"),
        F.coalesce("bin.color", F.lit(NO_DATA_COLOR)).alias("color"),
        F.col("bin.pattern").alias("pattern"),
    )


def legend(scale_rows: DataFrame) -> DataFrame:
    """The legend's entries in order: the bins, then the no-data entry; a lone message without bins."""
    nothing = F.create_map(*[c for m, (label, _, _) in METRICS.items() for c in (F.lit(m), F.lit(label.lower()))])
    message = F.concat(F.lit("No "), F.element_at(nothing, F.col("metric")), F.lit(" to display for this filter."))
    bin_entries = F.transform("bins", lambda b: F.struct(b["label"].alias("label"), b["color"].alias("color")))
    entries = F.when(
        F.size("bins") == 0, F.array(F.struct(message.alias("label"), F.lit(None).cast("string").alias("color")))
    ).otherwise(
        F.concat(
            bin_entries, F.array(F.struct(F.lit(NO_DATA_LEGEND).alias("label"), F.lit(NO_DATA_COLOR).alias("color")))
        )
    )
    return scale_rows.select("filter_key", "metric", "method", F.posexplode(entries).alias("position", "e")).select(
        "filter_key", "metric", "method", "position", "e.label", "e.color"
    )


def map_join(features: DataFrame, binned: DataFrame) -> DataFrame:
    """Country colours onto boundary features; both sides have at most one row per code and scale.

    ``mapped`` has both, ``no_data`` is a feature without a figure, ``not_on_map`` a figure without
    a feature (always so for the unknown bucket).
    """
    shapes = features.where(F.col("iso").rlike(ALPHA2)).select("iso").distinct()
    figures = binned.where(F.col("country") != UNKNOWN_COUNTRY)
    unplaced = binned.where(F.col("country") == UNKNOWN_COUNTRY).select(
        "country", "value", F.lit("not_on_map").alias("status"), "color"
    )
    status = (
        F.when(F.col("iso").isNull(), "not_on_map").when(F.col("country").isNull(), "no_data").otherwise("mapped")
    )
    placed = shapes.join(figures, F.col("iso") == F.col("country"), "full_outer").select(
        F.coalesce("iso", "country").alias("country"),
        "value",
        status.alias("status"),
        F.coalesce("color", F.lit(NO_DATA_COLOR)).alias("color"),
    )
    return placed.unionByName(unplaced)
