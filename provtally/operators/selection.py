"""View links as a table: the selection each stands for, what was wrong with it, and its canonical form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provtally.functions.countries import ALPHA2, UNKNOWN_COUNTRY
from provtally.functions.sets import canonical, filter_key, joined
from provtally.functions.sql import exploded, quote, text_array, text_list
from provtally.operators.creators import BY_VIDEOS, SORT_ORDERS
from provtally.operators.scale import METRICS
from provtally.sources.catalog import CORPUS_CLASSES, Catalog

# Shapes, choices and defaults of link parameters.
RELEASE = r"\A[A-Za-z0-9:_.-]{1,64}\z"
DATASET = r"\A[a-z0-9][a-z0-9._-]{0,63}\z"
CURSOR = r"\A[A-Za-z0-9_-]{1,512}\z"
VIEWS = ("map", "table")
REASONS = {
    "release": "not a valid release identifier",
    "release known": "release is not available",
    "dataset shape": "not a valid dataset identifier",
    "dataset": "dataset is not in this release",
    "class": "unknown corpus class",
    "country shape": "not an ISO 3166 alpha-2 code",
    "country": "country has no data in this release",
    "metric": "unknown metric",
    "view": "unknown view mode",
    "sort": "unknown sort order",
    "cursor shape": "not a valid page cursor",
    "cursor": "a page cursor requires a country selection",
}
DEFAULT_METRIC = "creators"
DEFAULT_VIEW = "map"
DEFAULT_SORT = BY_VIDEOS

# Fixed value: what a link's list items are trimmed of.
_BLANK = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"

_ISSUE = "struct<field:string,rejected:string,reason:string>"
_PARAMETERS = ("release", "datasets", "corpus", "country", "metric", "view", "sort", "cursor")


def _decoded(text: str) -> str:
    """Form-decoded text; a percent sign that starts no escape stands for itself. Most text needs no work."""
    escaped = f"regexp_replace({text}, '%(?![0-9A-Fa-f]{{2}})', '%25')"
    return f"if(contains({text}, '%') or contains({text}, '+'), url_decode({escaped}), {text})"


def _pairs(url: str) -> str:
    """Array of (name, value) in link order: what follows the first ``?`` and precedes the first ``#``."""
    head = f"substring_index({url}, '#', 1)"
    query = f"if(contains({head}, '?'), substring({head}, instr({head}, '?') + 1), '')"
    # A second question mark right at the start is dropped too.
    query = f"regexp_replace({query}, '^[?]', '')"
    name = _decoded("substring_index(p, '=', 1)")
    value = _decoded("if(contains(p, '='), substring(p, instr(p, '=') + 1), '')")
    return f"transform(filter(split({query}, '&'), p -> p <> ''), p -> named_struct('name', {name}, 'value', {value}))"


def _first(name: str) -> str:
    """First value of a parameter, null when the link does not have it."""
    return f"get(_pairs.value, cast(array_position(_pairs.name, {quote(name)}) as int) - 1)"


def _items(value: str) -> str:
    trimmed = f"regexp_replace(i, {quote(rf'^{_BLANK}|{_BLANK}$')}, '')"
    return f"filter(transform(split(coalesce({value}, ''), ','), i -> {trimmed}), i -> i <> '')"


def _rejection(field: str, rejected: str, reason: str) -> str:
    return f"named_struct('field', {quote(field)}, 'rejected', {rejected}, 'reason', {quote(REASONS[reason])})"


def _if(condition: str, rejection: str) -> str:
    return f"if({condition}, {rejection}, null)"


def parse_links(
    links: DataFrame, catalog: Catalog, countries: DataFrame, url_col: str = "url",
    known_releases: Sequence[str] | None = None, corpus_classes: Sequence[str] = CORPUS_CLASSES,
) -> DataFrame:
    """Add the normalised selection and ``corrections`` to each link.

    ``countries`` holds the codes the release has data for (column ``country``); being two-letter
    codes there are few of them. Rejected values fall back to the default of their field. A release that is
    not among ``known_releases``, where those are given, is rejected, as is a class not in ``corpus_classes``.
    """
    # Two-letter codes only, so never more than MAX_COUNTRY_BUCKETS rows.
    known = countries.select(F.col("country").alias("_known")).where(F.col("_known").rlike(ALPHA2)).distinct()
    raw = links.selectExpr("*", f"{_pairs(url_col)} as _pairs").selectExpr(
        *links.columns, *[f"{_first(n)} as _{n}" for n in _PARAMETERS]
    )
    base = (
        raw.selectExpr(
            "*", "upper(_country) as _code", f"{_items('_datasets')} as _ds", f"{_items('_corpus')} as _cc"
        )
        .join(F.broadcast(known), F.col("_code") == F.col("_known"), "left")
        .selectExpr(
            "*",
            f"rlike(_release, {quote(RELEASE)}) as _release_ok",
            f"(_code = '{UNKNOWN_COUNTRY}' or rlike(_code, {quote(ALPHA2)})) as _code_ok",
            f"rlike(_cursor, {quote(CURSOR)}) as _cursor_ok",
        )
        .withColumn("_place", F.expr("if(_code_ok and _known is not null, _code, null)"))
    )
    in_release = f"array_contains({text_array(catalog.dataset_ids)}, d)"
    metrics, views, sorts = (text_list(v) for v in (METRICS, VIEWS, SORT_ORDERS))
    known_class = f"array_contains({text_array(corpus_classes)}, c)"
    available = "true" if known_releases is None else f"array_contains({text_array(known_releases)}, _release)"
    dataset_issue = (
        f"case when not rlike(d, {quote(DATASET)}) then"
        f" {_rejection('datasets', 'd', 'dataset shape')}"
        f" when not {in_release} then {_rejection('datasets', 'd', 'dataset')} end"
    )
    class_issue = _rejection("corpusClasses", "c", "class")
    single = [
        _if("not _code_ok", _rejection("country", "_country", "country shape")),
        _if(
            "_code_ok and _known is null", _rejection("country", "_country", "country")
        ),
        _if(f"_metric not in ({metrics})", _rejection("metric", "_metric", "metric")),
        _if(f"_view not in ({views})", _rejection("view", "_view", "view")),
        _if(f"_sort not in ({sorts})", _rejection("sort", "_sort", "sort")),
        _if("not _cursor_ok", _rejection("cursor", "_cursor", "cursor shape")),
        _if(
            "_cursor_ok and _place is null",
            _rejection("cursor", "_cursor", "cursor"),
        ),
    ]
    release_issue = (
        f"case when not _release_ok then {_rejection('release', '_release', 'release')}"
        f" when not {available} then {_rejection('release', '_release', 'release known')} end"
    )
    corrections = (
        f"array_compact(concat(array({release_issue}), transform(_ds, d -> {dataset_issue}),"
        f" transform(filter(_cc, c -> not {known_class}), c -> {class_issue}), array({', '.join(single)})))"
    )
    return base.selectExpr(
        *links.columns,
        f"if(_release_ok and {available}, _release, null) as release",
        f"array_sort(array_distinct(filter(_ds, d -> rlike(d, {quote(DATASET)}) and {in_release}))) as datasets",
        f"array_sort(array_distinct(filter(_cc, c -> {known_class}))) as corpus_classes",
        "_place as country",
        f"if(_metric in ({metrics}), _metric, '{DEFAULT_METRIC}') as metric",
        f"if(_view in ({views}), _view, '{DEFAULT_VIEW}') as view",
        f"if(_sort in ({sorts}), _sort, '{DEFAULT_SORT}') as sort",
        "if(_cursor_ok and _place is not null, _cursor, null) as cursor",
        f"cast({corrections} as array<{_ISSUE}>) as corrections",
    ).withColumn("used_fallback", F.size("corrections") > 0)


def correction_counts(parsed: DataFrame) -> DataFrame:
    return (
        exploded(parsed, F.col("corrections"), "c")
        .groupBy("c.field", "c.rejected", "c.reason")
        .agg(F.count("*").alias("links"))
    )


def canonical_link(path: str = "/") -> Column:
    """The one link all equal selections share: fixed order, defaults left out, sets sorted."""

    def param(name: str, value: Column, when: Column) -> Column:
        encoded = F.replace(F.url_encode(value), F.lit("%2C"), F.lit(","))
        return F.when(when, F.concat(F.lit(name + "="), encoded))

    has_country = F.col("country").isNotNull() & (F.col("country") != "")
    datasets = F.array_join(canonical(F.col("datasets")), ",")
    classes = F.array_join(canonical(F.col("corpus_classes")), ",")
    query = F.concat_ws(
        "&",
        param("release", F.col("release"), F.col("release") != ""),
        param("datasets", datasets, F.size("datasets") > 0),
        param("corpus", classes, F.size("corpus_classes") > 0),
        param("country", F.col("country"), has_country),
        param("metric", F.col("metric"), F.col("metric") != DEFAULT_METRIC),
        param("view", F.col("view"), F.col("view") != DEFAULT_VIEW),
        param("sort", F.col("sort"), has_country & (F.col("sort") != DEFAULT_SORT)),
        param("cursor", F.col("cursor"), has_country & (F.col("cursor") != "")),
    )
    return F.when(query == "", F.lit(path)).otherwise(F.concat(F.lit(path + "?"), query))


def canonical_counts(parsed: DataFrame) -> DataFrame:
    """How many links show each view."""
    return parsed.groupBy(canonical_link().alias("canonical")).agg(F.count("*").alias("links"))


def filter_lookup(catalog: Catalog) -> list[tuple[str, str, str, bool]]:
    """(dataset key, class key, filter key, exact) for every selection a filter answers.

    An empty side matches any filter, so each filter is reachable by its pair and by either
    side alone; of several candidates the first in list order wins. Two empty sides mean the
    default filter.
    """
    if not catalog.filters:
        return []
    answers = {("", ""): catalog.default.key}
    for f in catalog.filters:
        ds, cc = "+".join(sorted(f.datasets)), "+".join(sorted(f.corpus_classes))
        for side in ((ds, cc), (ds, ""), ("", cc)):
            answers.setdefault(side, f.key)
    return [(ds, cc, key, True) for (ds, cc), key in answers.items()]


def resolve_filters(selections: DataFrame, catalog: Catalog) -> DataFrame:
    """Add ``filter_key`` and ``exact``: the published filter for a selection, else the default one.

    One equi-join with a lookup of at most three rows per filter of the (bounded) catalogue.
    """
    lookup = selections.sparkSession.createDataFrame(
        filter_lookup(catalog), "_ds string, _cc string, filter_key string, exact boolean"
    )
    fallback = catalog.default.key if catalog.filters else None
    return (
        selections.withColumn("_ds", joined(F.col("datasets")))
        .withColumn("_cc", joined(F.col("corpus_classes")))
        .join(F.broadcast(lookup), ["_ds", "_cc"], "left")
        .withColumn("filter_key", F.coalesce("filter_key", F.lit(fallback)))
        .withColumn("exact", F.coalesce("exact", F.lit(False)))
        .drop("_ds", "_cc")
    )


def selection_keys(parsed: DataFrame, filters: DataFrame) -> DataFrame:
    """Links per canonical filter key, and the published filter of that key if there is one."""
    keys = parsed.groupBy(filter_key(F.col("corpus_classes"), F.col("datasets")).alias("selection_key")).agg(
        F.count("*").alias("links")
    )
    published = filters.select(
        filter_key(F.col("corpus_classes"), F.col("datasets")).alias("selection_key"),
        F.col("filter_key").alias("published_filter"),
    )
    return keys.join(F.broadcast(published), "selection_key", "left")


def missing_countries(resolved: DataFrame, country_rows: DataFrame) -> DataFrame:
    """Selections whose country the resolved filter has no records for: an empty result, not an error."""
    rows = country_rows.select("filter_key", "country")
    return resolved.where(F.col("country").isNotNull()).join(rows, ["filter_key", "country"], "left_anti")
