"""The closed contract of every published document, and its check as a column expression.

A contract is data (records of fields); ``issues`` turns it into one SQL expression over a
parsed document that yields every violation in document order: fields in contract order, then
unknown keys, then cross-field rules. Cross-field rules are skipped where a value below has the
wrong type, because there is nothing to compare then. The expression is put together as text and
parsed once; building it call by call takes seconds.

Most documents are sound, and ``sound`` clears those at a fraction of the cost: a document that is
read with the contract's types and comes out the same to the byte when it is written again has its
fields, no others and values of the right types, so plain predicates on typed columns do the rest.
Documents of other spacing, key order or escapes are merely not cleared; they are walked in full.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

from provtally.functions.countries import ALPHA2
from provtally.functions.identifiers import DIGEST, PUBLIC_KEY, RAW_CHANNEL_PREFIX
from provtally.functions.sql import quote

ISSUE = "struct<path:string,rule:string,message:string,fatal:boolean>"

# Contract constants and messages.
SCHEMA_VERSION = "1.0.0"
CORPUS_CLASS = ("Candidate", "Comparison")
OCCURRENCE_UNIT = ("Clip", "Timestamp", "Segment", "Row", "Video")
SOURCE_KIND = ("MetadataOnly", "MediaIndex", "SubtitleIndex")
SORT_ORDER = ("representedVideoCountDesc", "displayNameAsc")
DATE = r"\A\d{4}-\d{2}-\d{2}\z"
INSTANT = r"\A\d{4}-\d{2}-\d{2}T([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})\z"
URL = r"(?i)\A\s*((https?|wss?|ftp):[/\\]*[^/\\?#\s][^\s]*|(?!(https?|wss?|ftp):)[a-z][a-z0-9+.-]*:.*)\s*\z"
COUNTRY_MESSAGE = "country must be ISO 3166 alpha-2 uppercase"
DIGEST_MESSAGE = "digest must be sha256:<64 lowercase hex>"
DATE_MESSAGE = "must be YYYY-MM-DD"
KEY_MESSAGE = "public channel key must be pk_-prefixed"
RAW_KEY_MESSAGE = "public channel key must not embed a raw YouTube channel ID"


# ---- pieces of a contract -------------------------------------------------------------------


@dataclass(frozen=True)
class Text:
    """A string; each check is (SQL condition over ``{t}``, rule, message)."""

    checks: tuple[tuple[str, str, str], ...]


@dataclass(frozen=True)
class Integer:
    positive: bool = False


@dataclass(frozen=True)
class Boolean:
    pass


@dataclass(frozen=True)
class Choice:
    values: tuple[str, ...]


@dataclass(frozen=True)
class Literal:
    value: str


@dataclass(frozen=True)
class Nullable:
    inner: object


@dataclass(frozen=True)
class ListOf:
    item: object
    min_items: int = 0


@dataclass(frozen=True)
class MapOf:
    value: object


@dataclass(frozen=True)
class Record:
    """Named fields; ``rules`` gives the issues across them, from SQL of the value and its path.

    ``holds`` is SQL of the typed value that is true where the rules find nothing.
    """

    fields: dict[str, object]
    rules: Callable[[str, str | None], str] | None = None
    holds: Callable[[str], str] | None = None


# ---- SQL pieces -----------------------------------------------------------------------------

_NONE = f"cast(array() as array<{ISSUE}>)"
_names = count()


def _text(value: str) -> str:
    return f"try_variant_get({value}, '$', 'string')"


def text_at(doc: str, path: str) -> str:
    return f"try_variant_get({doc}, '$.{path}', 'string')"


def _long_at(doc: str, path: str) -> str:
    return f"try_variant_get({doc}, '$.{path}', 'bigint')"


def _issue(path: str, rule: str, message: str, fatal: bool = False) -> str:
    return (
        f"named_struct('path', {path}, 'rule', {quote(rule)}, 'message', {message},"
        f" 'fatal', {str(fatal).lower()})"
    )


def _if(condition: str, issue: str) -> str:
    return f"if({condition}, array({issue}), {_NONE})"


def _let(value: str, body: Callable[[str], str]) -> str:
    """Name a value inside an expression, so that it is evaluated once."""
    name = f"x{next(_names)}"
    return f"get(transform(array({value}), {name} -> {body(name)}), 0)"


def _below(path: str | None, name: str) -> str:
    return name if path is None else f"concat({path}, '.', {name})"


def _json_type(value: str) -> str:
    kind = f"schema_of_variant({value})"
    return (
        f"case when is_variant_null({value}) then 'null' when {kind} like 'OBJECT%' then 'object'"
        f" when {kind} like 'ARRAY%' then 'array' when {kind} = 'STRING' then 'string'"
        f" when {kind} = 'BOOLEAN' then 'boolean' else 'number' end"
    )


def _wrong_type(expected: str, value: str, path: str) -> str:
    message = (
        f"if({value} is null, 'Required', concat({quote(f'Expected {expected}, received ')}, {_json_type(value)}))"
    )
    return _issue(path, "invalid_type", message, True)


def _scalar_issues(contract: object, value: str, path: str) -> list[str] | None:
    """Possible issues of a single value, each null when it does not apply; None for containers."""
    kind, text = f"schema_of_variant({value})", _text(value)
    match contract:
        case Text(checks):
            bad = [
                f"if({holds.format(t=text)}, null, {_issue(path, rule, quote(message))})"
                for holds, rule, message in checks
            ]
            first = f"if({kind} <=> 'STRING', {bad[0]}, {_wrong_type('string', value, path)})"
            return [first, *[f"if({kind} <=> 'STRING', {b}, null)" for b in bad[1:]]]
        case Integer(positive):
            number = f"try_variant_get({value}, '$', 'double')"
            numeric = f"coalesce(rlike({kind}, '^(BIGINT|DECIMAL|DOUBLE|FLOAT)'), false)"
            fraction = _issue(path, "invalid_type", "'Expected integer, received float'")
            low, bound = (f"{number} <= 0", "greater than 0") if positive else (
                f"{number} < 0", "greater than or equal to 0"
            )
            return [
                f"if({numeric}, if({number} % 1 <> 0, {fraction}, null),"
                f" {_wrong_type('number', value, path)})",
                f"if({numeric} and {low}, {_issue(path, 'too_small', quote(f'Number must be {bound}'))}, null)",
            ]
        case Boolean():
            return [f"if({kind} <=> 'BOOLEAN', null, {_wrong_type('boolean', value, path)})"]
        case Choice(values):
            expected = " | ".join(f"'{v}'" for v in values)
            known = ", ".join(quote(v) for v in values)
            message = f"concat({quote(f'Invalid enum value. Expected {expected}, received ')}, '\\'', {text}, '\\'')"
            unknown = f"if({text} in ({known}), null, {_issue(path, 'invalid_enum_value', message, True)})"
            return [f"if({kind} <=> 'STRING', {unknown}, {_wrong_type(expected, value, path)})"]
        case Literal(expected):
            message = quote(f'Invalid literal value, expected "{expected}"')
            fits = f"{kind} <=> 'STRING' and {text} <=> {quote(expected)}"
            return [f"if({fits}, null, {_issue(path, 'invalid_literal', message, True)})"]
        case Nullable(inner):
            is_null = f"coalesce(is_variant_null({value}), false)"
            return [f"if({is_null}, null, {i})" for i in _scalar_issues(inner, value, path)]
    return None


def _compact(parts: list[str]) -> str:
    return f"array_compact(array({', '.join(parts)}))"


def issues_sql(contract: object, value: str, path: str | None = None) -> str:
    """SQL of the array of all violations of a contract by a parsed value (a variant)."""
    at = "''" if path is None else path
    single = _scalar_issues(contract, value, at)
    if single is not None:
        return _compact(single)
    match contract:
        case ListOf(item, min_items):
            message = quote(f"Array must contain at least {min_items} element(s)")
            e, i = f"e{next(_names)}", f"i{next(_names)}"

            def of_items(items: str) -> str:
                place = _below(path, f"cast({i} as string)")
                found = f"flatten(transform({items}, ({e}, {i}) -> {issues_sql(item, e, place)}))"
                if min_items:
                    found = f"concat({_if(f'size({items}) < {min_items}', _issue(at, 'too_small', message))}, {found})"
                return f"if({items} is null, array({_wrong_type('array', value, at)}), {found})"

            return _let(f"try_variant_get({value}, '$', 'array<variant>')", of_items)
        case MapOf(item):
            e = f"e{next(_names)}"

            def of_entries(entries: str) -> str:
                place = _below(path, f"{e}.key")
                empty = _issue(place, "too_small", "'String must contain at least 1 character(s)'")
                each = f"concat({_if(f'{e}.key = {quote(str())}', empty)}, {issues_sql(item, f'{e}.value', place)})"
                return (
                    f"if({entries} is null, array({_wrong_type('object', value, at)}),"
                    f" flatten(transform(map_entries({entries}), {e} -> {each})))"
                )

            return _let(f"try_variant_get({value}, '$', 'map<string,variant>')", of_entries)
        case Record(fields, rules):

            def of_members(members: str) -> str:
                known = ", ".join(quote(n) for n in fields)
                unknown = f"array_except(map_keys({members}), array({known}))"
                message = f"concat('Unrecognized key(s) in object: \\'', array_join({unknown}, '\\', \\''), '\\'')"
                groups, run = [], []
                for name, part in fields.items():
                    member, place = f"try_variant_get({value}, '$.{name}', 'variant')", _below(path, quote(name))
                    scalars = _scalar_issues(part, member, place)
                    if scalars is None:
                        if run:
                            groups.append(_compact(run))
                        groups.append(_let(member, lambda m, part=part, place=place: issues_sql(part, m, place)))
                        run = []
                    else:
                        run += scalars
                run.append(f"if(size({unknown}) > 0, {_issue(at, 'unrecognized_keys', message)}, null)")
                groups.append(_compact(run))
                base = f"concat({', '.join(groups)})" if len(groups) > 1 else groups[0]
                if rules is not None:
                    base = _let(base, lambda b: f"if(exists({b}, i -> i.fatal), {b}, concat({b}, {rules(value, path)}))")
                return f"if({members} is null, array({_wrong_type('object', value, at)}), {base})"

            return _let(f"try_variant_get({value}, '$', 'map<string,variant>')", of_members)
    raise TypeError(f"not a contract: {contract!r}")


def issues(contract: object, column: str) -> Column:
    """``issues_sql`` for a variant column."""
    return F.expr(issues_sql(contract, column))


# ---- documents cleared by their types -------------------------------------------------------


def typed_schema(contract: object) -> str:
    """The Spark type of a contract's values."""
    match contract:
        case Text() | Choice() | Literal():
            return "string"
        case Integer():
            return "bigint"
        case Boolean():
            return "boolean"
        case Nullable(inner):
            return typed_schema(inner)
        case ListOf(item):
            return f"array<{typed_schema(item)}>"
        case MapOf(item):
            return f"map<string,{typed_schema(item)}>"
        case Record(fields):
            return "struct<" + ",".join(f"{name}:{typed_schema(part)}" for name, part in fields.items()) + ">"
    raise TypeError(f"not a contract: {contract!r}")


def _holds(contract: object, value: str) -> str:
    """SQL that is true where a typed value fits; false or null where it does not."""
    match contract:
        case Text(checks):
            return " and ".join([f"{value} is not null", *[f"({holds.format(t=value)})" for holds, _, _ in checks]])
        case Integer(positive):
            return f"{value} {'>' if positive else '>='} 0"
        case Boolean():
            return f"{value} is not null"
        case Choice(values):
            return f"{value} in ({', '.join(quote(v) for v in values)})"
        case Literal(expected):
            return f"{value} = {quote(expected)}"
        case Nullable(inner):
            return f"({value} is null or ({_holds(inner, value)}))"
        case ListOf(item, min_items):
            e = f"e{next(_names)}"
            return f"size({value}) >= {min_items} and forall({value}, {e} -> {_holds(item, e)})"
        case MapOf(item):
            e, k = f"e{next(_names)}", f"k{next(_names)}"
            return f"forall(map_keys({value}), {k} -> {k} <> '') and forall(map_values({value}), {e} -> {_holds(item, e)})"
        case Record(fields, rules, holds):
            if rules is not None and holds is None:
                return "false"
            parts = [_holds(part, f"{value}.{name}") for name, part in fields.items()]
            return " and ".join([f"{value} is not null", *parts, *([holds(value)] if holds else [])])
    raise TypeError(f"not a contract: {contract!r}")


def sound_sql(contract: object, body: str) -> str:
    """SQL of whether a JSON text is certain to fit a contract; never null. False says nothing."""

    def same_and_fit(doc: str) -> str:
        again = f"to_json({doc}, map('ignoreNullFields', 'false'))"
        return f"coalesce({again} = {body} and {_holds(contract, doc)}, false)"

    return _let(f"from_json({body}, {quote(typed_schema(contract))})", same_and_fit)


def sound(contract: object, body: str) -> Column:
    """``sound_sql`` for a text column."""
    return F.expr(sound_sql(contract, body))


# ---- cross-field rules ----------------------------------------------------------------------


def _custom(path: str, message: str) -> str:
    return _issue(path, "custom", message)


def _sorted_and_unique(doc: str, path: str | None) -> str:
    found = []
    for name in ("datasets", "corpusClasses"):
        values, at = f"try_variant_get({doc}, '$.{name}', 'array<string>')", _below(path, quote(name))
        found.append(f"if({values} = array_sort({values}), null, {_custom(at, quote(f'{name} must be sorted'))})")
        found.append(
            f"if(size(array_distinct({values})) = size({values}), null,"
            f" {_custom(at, quote(f'{name} must be unique'))})"
        )
    return _compact(found)


def _are_sorted_and_unique(value: str) -> str:
    parts = (f"{value}.{name}" for name in ("datasets", "corpusClasses"))
    return " and ".join(f"{p} = array_sort(array_distinct({p}))" for p in parts)


PARTITION_STATES = ("resolved", "unavailableUnclassified", "retryableOrPending", "invalid", "terminalFailure")


def _coverage_sums(doc: str, path: str | None) -> str:
    parts = " + ".join(_long_at(doc, f"partition.{name}") for name in PARTITION_STATES)
    expected = _long_at(doc, "distinctInputVideoCount")
    channels = f"{_long_at(doc, 'knownCountryChannelCount')} + {_long_at(doc, 'unknownCountryChannelCount')}"
    resolved = _long_at(doc, "resolvedChannelCount")
    partition_text = f"concat('resolution partition sums to ', {parts}, ', expected ', {expected})"
    channel_text = f"concat('known + unknown channels = ', {channels}, ', expected ', {resolved})"
    return _compact(
        [
            f"if({parts} = {expected}, null, {_custom(_below(path, quote('partition')), partition_text)})",
            f"if({channels} = {resolved}, null, {_custom(_below(path, quote('resolvedChannelCount')), channel_text)})",
        ]
    )


def _sums_hold(value: str) -> str:
    # As decimals, so that no sum overflows.
    def number(name: str) -> str:
        return f"cast({value}.{name} as decimal(20,0))"

    parts = " + ".join(number(f"partition.{name}") for name in PARTITION_STATES)
    channels = f"{number('knownCountryChannelCount')} + {number('unknownCountryChannelCount')}"
    return f"{parts} = {number('distinctInputVideoCount')} and {channels} = {number('resolvedChannelCount')}"


def _unique_countries(doc: str, path: str | None) -> str:
    codes = f"transform(try_variant_get({doc}, '$.countries', 'array<variant>'), c -> {text_at('c', 'country')})"
    issue = _custom(_below(path, quote("countries")), "concat('duplicate country bucket: ', c)")

    def repeated(all_codes: str) -> str:
        again = f"filter({all_codes}, (c, i) -> array_position({all_codes}, c) - 1 < i)"
        # Only a list that repeats a code is searched for it.
        return f"if(size(array_distinct({all_codes})) = size({all_codes}), {_NONE}, transform({again}, c -> {issue}))"

    return _let(codes, repeated)


def _countries_differ(value: str) -> str:
    return f"size(array_distinct({value}.countries.country)) = size({value}.countries)"


def _instant(text: str) -> str:
    """Microseconds since the epoch. The offset is subtracted as minutes, as a timestamp takes none beyond 18 hours."""
    padded = f"regexp_replace({text}, 'T([0-9]{{2}}:[0-9]{{2}})(?=Z|[+-])', 'T$1:00')"
    local = f"regexp_replace({padded}, '(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$', 'Z')"

    def part(group: int) -> str:
        return f"regexp_extract({text}, '([+-])([0-9]{{2}}):?([0-9]{{2}})$', {group})"

    minutes = f"coalesce(try_cast({part(2)} as bigint) * 60 + try_cast({part(3)} as bigint), 0L)"
    return f"unix_micros(try_cast({local} as timestamp)) - if({part(1)} = '-', -60000000L, 60000000L) * {minutes}"


def instant(text: str) -> Column:
    """The timestamp of an instant as documents write it: seconds may be left out, an offset may be of any size."""
    return F.timestamp_micros(F.expr(_instant(quote(text))))


def _cutoff_first(doc: str, path: str | None) -> str:
    late = f"{_instant(text_at(doc, 'enrichmentCutoff'))} > {_instant(text_at(doc, 'generatedAt'))}"
    message = "'enrichmentCutoff must not be later than generatedAt'"
    return _if(f"coalesce({late}, false)", _custom(_below(path, quote("enrichmentCutoff")), message))


def _cutoff_is_first(value: str) -> str:
    return f"coalesce({_instant(f'{value}.enrichmentCutoff')} <= {_instant(f'{value}.generatedAt')}, true)"


# ---- the contracts --------------------------------------------------------------------------


def _matches(pattern: str) -> str:
    return "rlike({t}, " + quote(pattern).replace("{", "{{").replace("}", "}}") + ")"


NONEMPTY = Text((("length({t}) >= 1", "too_small", "String must contain at least 1 character(s)"),))
COUNTRY = Text(((_matches(ALPHA2), "invalid_string", COUNTRY_MESSAGE),))
DIGEST_TEXT = Text(((_matches(DIGEST), "invalid_string", DIGEST_MESSAGE),))
# The shape, and a day the calendar has.
INSTANT_TEXT = Text(
    (
        (
            f"if({_matches(INSTANT)}, try_cast(substr({{t}}, 1, 10) as date) is not null, false)",
            "invalid_string",
            "Invalid datetime",
        ),
    )
)
DATE_TEXT = Text(((_matches(DATE), "invalid_string", DATE_MESSAGE),))
URL_TEXT = Text(((_matches(URL), "invalid_string", "Invalid url"),))
KEY_TEXT = Text(
    (
        (_matches(PUBLIC_KEY), "invalid_string", KEY_MESSAGE),
        (f"not {_matches(RAW_CHANNEL_PREFIX)}", "custom", RAW_KEY_MESSAGE),
    )
)
COUNT = Integer()

PARTITION = Record({s: COUNT for s in PARTITION_STATES})
FILTER_SPEC = Record(
    {"datasets": ListOf(NONEMPTY, 1), "corpusClasses": ListOf(Choice(CORPUS_CLASS), 1)}, _sorted_and_unique,
    _are_sorted_and_unique,
)
COVERAGE = Record(
    {
        "inputOccurrenceCount": COUNT,
        "distinctInputVideoCount": COUNT,
        "partition": PARTITION,
        "resolvedChannelCount": COUNT,
        "knownCountryChannelCount": COUNT,
        "unknownCountryChannelCount": COUNT,
    },
    _coverage_sums,
    _sums_hold,
)
COUNTRY_SUMMARY = Record(
    {
        "country": COUNTRY,
        "creatorCount": COUNT,
        "representedVideoCount": COUNT,
        "sourceOccurrenceCount": COUNT,
        "resolvedVideoCount": COUNT,
        "unavailableVideoCount": COUNT,
    }
)
DATASET_COUNT = Record({"datasetId": NONEMPTY, "representedVideoCount": COUNT})
CREATOR_ROW = Record(
    {
        "publicChannelKey": KEY_TEXT,
        "displayName": NONEMPTY,
        "country": COUNTRY,
        "representedVideoCount": COUNT,
        "datasetBreakdown": ListOf(DATASET_COUNT),
        "lastObservedAt": DATE_TEXT,
    }
)
CREATOR_PAGE = Record(
    {
        "country": COUNTRY,
        "sortOrder": Choice(SORT_ORDER),
        "rows": ListOf(CREATOR_ROW),
        "nextCursor": Nullable(NONEMPTY),
        "pageSize": Integer(positive=True),
        "totalRows": COUNT,
    }
)
COUNTRY_SHARD = Record(
    {
        "country": COUNTRY,
        "creatorCount": COUNT,
        "representedVideoCount": COUNT,
        "sourceOccurrenceCount": COUNT,
        "coverage": COVERAGE,
        "datasetBreakdown": ListOf(DATASET_COUNT),
        "firstPage": CREATOR_PAGE,
        "pageIndex": MapOf(ListOf(NONEMPTY)),
    }
)
DATASET = Record(
    {
        "datasetId": NONEMPTY,
        "displayName": NONEMPTY,
        "version": NONEMPTY,
        "corpusClass": Choice(CORPUS_CLASS),
        "sourceKind": Choice(SOURCE_KIND),
        "occurrenceUnit": Choice(OCCURRENCE_UNIT),
        "sourceCitation": URL_TEXT,
        "snapshotDigest": DIGEST_TEXT,
    }
)
BOUNDARY_METADATA = Record(
    {
        "datasetName": NONEMPTY,
        "version": NONEMPTY,
        "license": NONEMPTY,
        "attribution": NONEMPTY,
        "disputedTerritoryTreatment": NONEMPTY,
    }
)
PUBLISHED_FILTER = Record(
    {
        "key": NONEMPTY,
        "label": NONEMPTY,
        "path": NONEMPTY,
        "datasets": ListOf(NONEMPTY, 1),
        "corpusClasses": ListOf(Choice(CORPUS_CLASS), 1),
        "isDefault": Boolean(),
    }
)
MANIFEST = Record(
    {
        "schemaVersion": Literal(SCHEMA_VERSION),
        "releaseId": NONEMPTY,
        "generatedAt": INSTANT_TEXT,
        "enrichmentCutoff": INSTANT_TEXT,
        "defaultFilter": FILTER_SPEC,
        "datasets": ListOf(DATASET, 1),
        "artifactDigests": MapOf(DIGEST_TEXT),
        "methodologyVersion": NONEMPTY,
        "disclosurePolicyVersion": NONEMPTY,
        "boundaryMetadata": BOUNDARY_METADATA,
        "filters": ListOf(PUBLISHED_FILTER),
    },
    _cutoff_first,
    _cutoff_is_first,
)
POINTER = Record(
    {
        "schemaVersion": Literal(SCHEMA_VERSION),
        "releaseId": NONEMPTY,
        "manifestPath": NONEMPTY,
        "manifestDigest": DIGEST_TEXT,
    }
)
OVERVIEW = Record(
    {
        "schemaVersion": Literal(SCHEMA_VERSION),
        "releaseId": NONEMPTY,
        "filter": FILTER_SPEC,
        "countries": ListOf(COUNTRY_SUMMARY),
        "coverage": COVERAGE,
        "creatorCount": COUNT,
        "representedVideoCount": COUNT,
        "representedCountryCount": COUNT,
    },
    _unique_countries,
    _countries_differ,
)
