"""Link parsing against a direct reading with the standard library, and filter resolution."""

import random
import re
from urllib.parse import parse_qsl, urlencode

import pytest
from pyspark.sql import functions as F

from provtally.operators import selection as sel
from provtally.sources.catalog import Catalog, Dataset, PublishedFilter

IDS = ["ds-a", "ds-b", "ds-c"]
KNOWN = {"DE", "US", "XX"}


def _catalog(filters):
    ds = tuple(Dataset(d, d, "1", "Candidate", "MediaIndex", "Clip", "https://e.org", "x") for d in IDS)
    return Catalog(ds, tuple(filters))


def _filter(key, datasets, classes, default=False):
    return PublishedFilter(key, key, f"{key}.json", tuple(datasets), tuple(classes), default)


FILTERS = [
    _filter("ab", ["ds-a", "ds-b"], ["Candidate"]),
    _filter("all", IDS, ["Candidate", "Comparison"], True),
    _filter("comp", ["ds-c"], ["Comparison"]),
    _filter("c2", ["ds-c"], ["Candidate"]),
]

# Percent signs that start no escape, and bytes that are no UTF-8, are the reader's business.
BLANK = " \t\n\x0b\f\r        　﻿"


def _read(url):
    head = url.split("#", 1)[0]
    query = head.split("?", 1)[1] if "?" in head else ""
    query = query[1:] if query.startswith("?") else query
    query = re.sub("%(?![0-9A-Fa-f]{2})", "%25", query)
    values = {}
    for name, value in parse_qsl(query, keep_blank_values=True):
        values.setdefault(name, value)
    fixes = []

    def items(name):
        return [i for i in (x.strip(BLANK) for x in (values.get(name) or "").split(",")) if i]

    def choose(name, allowed, default, reason):
        value = values.get(name)
        if value is not None and value not in allowed:
            fixes.append((name, value, reason))
        return value if value in allowed else default

    release = values.get("release")
    if release is not None and not re.fullmatch("[A-Za-z0-9:_.-]{1,64}", release):
        fixes.append(("release", release, "not a valid release identifier"))
        release = None
    datasets, classes = set(), set()
    for d in items("datasets"):
        if not re.fullmatch("[a-z0-9][a-z0-9._-]{0,63}", d):
            fixes.append(("datasets", d, "not a valid dataset identifier"))
        elif d not in IDS:
            fixes.append(("datasets", d, "dataset is not in this release"))
        else:
            datasets.add(d)
    for c in items("corpus"):
        if c not in ("Candidate", "Comparison"):
            fixes.append(("corpusClasses", c, "unknown corpus class"))
        else:
            classes.add(c)
    country = values.get("country")
    if country is not None:
        code = country.upper()
        if not re.fullmatch("[A-Z]{2}", code):
            fixes.append(("country", country, "not an ISO 3166 alpha-2 code"))
            country = None
        elif code not in KNOWN:
            fixes.append(("country", country, "country has no data in this release"))
            country = None
        else:
            country = code
    metric = choose("metric", ("creators", "videos", "occurrences"), "creators", "unknown metric")
    view = choose("view", ("map", "table"), "map", "unknown view mode")
    sort = choose("sort", ("representedVideoCountDesc", "displayNameAsc"), "representedVideoCountDesc",
                  "unknown sort order")
    cursor = values.get("cursor")
    if cursor is not None and not re.fullmatch("[A-Za-z0-9_-]{1,512}", cursor):
        fixes.append(("cursor", cursor, "not a valid page cursor"))
        cursor = None
    if cursor is not None and country is None:
        fixes.append(("cursor", cursor, "a page cursor requires a country selection"))
        cursor = None
    state = (release, sorted(datasets), sorted(classes), country, metric, view, sort, cursor)
    pairs = [("release", release), ("datasets", ",".join(sorted(datasets))), ("corpus", ",".join(sorted(classes))),
             ("country", country), ("metric", metric if metric != "creators" else None),
             ("view", view if view != "map" else None)]
    if country:
        pairs += [("sort", sort if sort != "representedVideoCountDesc" else None), ("cursor", cursor)]
    text = urlencode([(k, v) for k, v in pairs if v]).replace("%2C", ",")
    return state, fixes, "/?" + text if text else "/"


def _links():
    rnd = random.Random(11)
    pools = {
        "release": ["r-1:2", "a b", "", "x" * 65, "%E4%BD%A0"],
        "datasets": ["ds-a,ds-b", "ds-b%2Cds-a", "+ds-a+,,DS", "ds-z,ds-c%0A", "", "%C2%A0ds-a", "ds-a,ds-a"],
        "corpus": ["Candidate", "Comparison,Candidate", "candidate", ""],
        "country": ["de", "US", "xx", "FR", "usa", "", "D%45", "d%0a"],
        "metric": ["videos", "creators", "likes", ""],
        "view": ["map", "table", "Grid"],
        "sort": ["displayNameAsc", "representedVideoCountDesc", "newest"],
        "cursor": ["2", "a_b-c", "", "!", "%zz", "y" * 513],
        "other": ["1"], "countr%79": ["de"],
    }
    links = ["https://e.org/", "https://e.org/?", "https://e.org/#?country=DE", "https://e.org/??country=DE",
             "https://e.org/?country=DE&country=US", "https://e.org/?country", "https://e.org/?&&metric=videos&",
             "https://e.org/?country=DE#frag?metric=videos", "https://e.org/?cursor=1&country=de=x"]
    for _ in range(600):
        names = rnd.sample(sorted(pools), rnd.randrange(0, 7))
        links.append("https://e.org/m?" + "&".join(f"{n}={rnd.choice(pools[n])}" for n in names))
    return links


def test_links_equal_a_direct_reading(spark):
    links = _links()
    frame = spark.createDataFrame(list(enumerate(links)), "id long, url string")
    known = spark.createDataFrame([(c,) for c in KNOWN], "country string")
    parsed = sel.parse_links(frame, _catalog(FILTERS), known).withColumn("canonical", sel.canonical_link())
    for r in parsed.collect():
        state, fixes, canonical = _read(r["url"])
        got = (r["release"], r["datasets"], r["corpus_classes"], r["country"], r["metric"], r["view"], r["sort"],
               r["cursor"])
        assert got == state, r["url"]
        assert [tuple(c) for c in r["corrections"]] == fixes, r["url"]
        assert r["used_fallback"] == bool(fixes)
        assert r["canonical"] == canonical, r["url"]


@pytest.mark.parametrize(
    ("datasets", "classes", "want"),
    [
        ([], [], ("all", True)),
        (["ds-b", "ds-a"], [], ("ab", True)),
        (["ds-c"], [], ("comp", True)),
        (["ds-c"], ["Candidate"], ("c2", True)),
        ([], ["Candidate"], ("ab", True)),
        ([], ["Comparison", "Candidate"], ("all", True)),
        (["ds-a"], [], ("all", False)),
        (["ds-a", "ds-b"], ["Comparison"], ("all", False)),
    ],
)
def test_filter_resolution(spark, datasets, classes, want):
    rows = spark.createDataFrame([(datasets, classes)], "datasets array<string>, corpus_classes array<string>")
    r = sel.resolve_filters(rows, _catalog(FILTERS)).first()
    assert (r["filter_key"], r["exact"]) == want


def test_without_a_default_the_first_filter_answers(spark):
    rows = spark.createDataFrame([([], [])], "datasets array<string>, corpus_classes array<string>")
    assert sel.resolve_filters(rows, _catalog(FILTERS[2:])).first()["filter_key"] == "comp"


def test_a_release_without_filters_resolves_nothing(spark):
    rows = spark.createDataFrame([(["ds-a"], [])], "datasets array<string>, corpus_classes array<string>")
    r = sel.resolve_filters(rows, _catalog([])).first()
    assert (r["filter_key"], r["exact"]) == (None, False)


def test_missing_countries(spark):
    picks = spark.createDataFrame([("all", "DE"), ("all", "FR"), ("c2", "DE"), ("all", None)],
                                  "filter_key string, country string")
    rows = spark.createDataFrame([("all", "DE")], "filter_key string, country string")
    got = sel.missing_countries(picks, rows).select("filter_key", "country").collect()
    assert sorted(map(tuple, got)) == [("all", "FR"), ("c2", "DE")]


def test_selection_keys_name_the_published_filter(spark):
    picks = spark.createDataFrame(
        [(["ds-b", "ds-a"], ["Candidate"]), (["ds-a"], [])], "datasets array<string>, corpus_classes array<string>"
    )
    got = sel.selection_keys(picks, _catalog(FILTERS).filters_frame(spark)).select(
        "selection_key", "published_filter", F.col("links").cast("int")
    )
    assert sorted(map(tuple, got.collect()), key=repr) == [
        ("Candidate~ds-a+ds-b", "ab", 1), ("~ds-a", None, 1)
    ]


def test_releases_and_classes_of_the_caller(spark):
    links = spark.createDataFrame(
        [(1, "/?release=r1&corpus=Other,Candidate"), (2, "/?release=r2"), (3, "/?release=a b"), (4, "/?corpus=Other"), (5, None)],
        "event_id int, url string",
    )
    known = spark.createDataFrame([("DE",)], "country string")
    parsed = sel.parse_links(links, _catalog(FILTERS), known, known_releases=["r1"], corpus_classes=["Other"])
    got = {r["event_id"]: (r["release"], r["corpus_classes"], [tuple(c) for c in r["corrections"]]) for r in parsed.collect()}
    assert got[1] == ("r1", ["Other"], [("corpusClasses", "Candidate", "unknown corpus class")])
    assert got[2] == (None, [], [("release", "r2", "release is not available")])
    assert got[3] == (None, [], [("release", "a b", "not a valid release identifier")])
    assert got[4] == (None, ["Other"], [])
    none_known = sel.parse_links(links, _catalog(FILTERS), known, known_releases=[]).where("event_id = 1").first()
    assert none_known["release"] is None
