"""Properties of the totals, and the operators against brute force for catalogues of any size."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from provtally import fixtures as fx
from provtally.operators import creators as cr
from provtally.operators import metrics as mt
from provtally.sources.catalog import Catalog, Dataset, PublishedFilter


def _as_set(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def inputs(spark, sf):
    return fx.observations(spark, sf), fx.resolutions(spark, sf), fx.channels(spark, sf)


@pytest.fixture(scope="module")
def cells(inputs):
    return mt.filter_cells(*inputs, fx.catalog()).cache()


def test_partition_covers_every_identifier_once(cells):
    rows = mt.coverage_rows(cells, fx.catalog())
    total = sum((F.col(s) for s in mt.STATES), F.lit(0))
    assert rows.where(total != F.col("distinct_input_video_count")).count() == 0
    assert rows.count() == 9


def test_known_and_unknown_channels_sum_to_creators(cells):
    rows = mt.headline_rows(cells, fx.catalog())
    off = F.col("known_country_channel_count") + F.col("unknown_country_channel_count") != F.col("creator_count")
    assert rows.where(off).count() == 0


def test_country_rows_stay_within_headline(cells):
    per_filter = mt.country_rows(cells).groupBy("filter_key").agg(F.sum("represented_video_count").alias("v"))
    head = mt.headline_rows(cells, fx.catalog())
    assert per_filter.join(head, "filter_key").where("v > represented_video_count").count() == 0


def test_dataset_totals_overshoot_the_combined_one(inputs):
    row = mt.dataset_overlap(inputs[0], fx.catalog()).first()
    assert row["summed_videos"] > row["combined_videos"]


def _catalog(datasets, filters):
    ds = tuple(
        Dataset(d, d, "1", c, "MediaIndex", "Clip", "https://example.org", "sha256:" + "0" * 64) for d, c in datasets
    )
    fs = tuple(
        PublishedFilter(k, k, f"{k}.json", tuple(m), ("Candidate", "Comparison"), i == 0)
        for i, (k, m) in enumerate(filters)
    )
    return Catalog(ds, fs)


@pytest.mark.parametrize("seed", range(3))
def test_skewed_input_against_brute_force(spark, seed):
    """A third of all rows on one video and a third of the videos on one channel."""
    rnd = random.Random(seed)
    ids = [f"d{i}" for i in range(7)]
    catalog = _catalog(
        [(d, "Comparison" if i % 3 == 0 else "Candidate") for i, d in enumerate(ids)],
        [("all", ids), ("few", ids[:3]), ("one", ids[5:6]), ("none", ["d9"])],
    )
    videos = [f"vid{i:08d}" for i in range(60)] + ["short"]
    rows = [(rnd.choice(ids), rnd.choice(videos)) for _ in range(600)] + [
        (rnd.choice(ids[:2]), videos[0]) for _ in range(300)
    ]
    states = {}
    for i, v in enumerate(videos[:55]):
        state = rnd.choice([mt.RESOLVED, mt.RESOLVED, "terminalFailure", "unavailableUnclassified"])
        states[v] = (state, 0 if i % 3 == 0 else rnd.randrange(1, 12))
    states["short"] = (mt.RESOLVED, 3)
    countries = {k: rnd.choice(["DE", "us", "XX", None, "usa"]) for k in range(11)}

    got = {
        (r["filter_key"], r["state"], r["country"]): (r["creators"], r["videos"], r["occurrences"])
        for r in mt.filter_cells(
            spark.createDataFrame(rows, "dataset_id string, video_id string").repartition(3),
            spark.createDataFrame([(v, s, k) for v, (s, k) in states.items()],
                                  "video_id string, state string, channel_key long"),
            spark.createDataFrame(list(countries.items()), "channel_key long, country string"),
            catalog,
        ).collect()
    }

    def place(key):
        code = (countries.get(key) or "").upper()
        return code if len(code) == 2 else "XX"

    want_videos, want_channels, want_rows = defaultdict(set), defaultdict(set), Counter()
    for d, v in rows:
        state, key = states.get(v, (mt.PENDING, None))
        state = mt.INVALID if v == "short" else state
        for f in catalog.filters:
            if d in f.datasets:
                cell = (f.key, state, place(key) if state == mt.RESOLVED else None)
                want_videos[cell].add(v)
                want_rows[cell] += 1
                if state == mt.RESOLVED:
                    want_channels[cell].add(key)
    want = {c: (len(want_channels[c]), len(want_videos[c]), want_rows[c]) for c in want_videos}
    assert got == want


@pytest.mark.parametrize("n", [64, 130])
def test_large_catalogues_against_brute_force(spark, n):
    """Foreign datasets, repeated records of a video and of a channel, and an unknown state."""
    rnd = random.Random(n)
    ids = [f"d{i:03d}" for i in range(n)]
    catalog = _catalog(
        [(d, "Comparison" if i % 3 == 0 else "Candidate") for i, d in enumerate(ids)],
        [("all", ids), ("last", ids[-2:]), ("mid", ids[30:34]), ("none", ["foreign1"])],
    )
    videos = [f"vid{i:08d}" for i in range(80)] + ["short"]
    rows = [(rnd.choice(ids[::9] + ids[-2:] + ["foreign1", "foreign2"]), rnd.choice(videos)) for _ in range(900)]
    records = [(v, rnd.choice([*mt.STATES, mt.RESOLVED, "unheard-of"]), rnd.randrange(9)) for v in videos[:70]]
    records += [(v, rnd.choice(mt.STATES[:2]), rnd.choice([None, 3, 4])) for v in videos[:20]] + records[:5]
    channels = [(k, "2024-01-01", f"old {k}", "US") for k in range(7)]
    channels += [(k, "2024-02-01", f"new {k}", rnd.choice(["DE", "FR", None])) for k in range(4)] + channels[:2]

    best = {}
    for v, state, key in records:
        rank = mt.STATES.index(state) if state in mt.STATES else 99
        order = (rank, key is None, key or 0)
        if v not in best or order < best[v][0]:
            best[v] = (order, state if rank < 99 else mt.PENDING, key)
    latest = {}
    for k, at, name, country in channels:
        if k not in latest or at > latest[k][0]:
            latest[k] = (at, name, country)
    per_video = defaultdict(Counter)
    for d, v in rows:
        if d in ids:
            per_video[v][d] += 1
    place = {}
    for v in per_video:
        _, state, key = best.get(v, (None, mt.PENDING, None))
        state = mt.INVALID if v == "short" else state
        place[v] = (state, key if state == mt.RESOLVED else None)

    observed = spark.createDataFrame(rows, "dataset_id string, video_id string").repartition(3)
    resolutions = spark.createDataFrame(records, "video_id string, state string, channel_key long")
    meta = spark.createDataFrame(
        channels, "channel_key long, last_observed_at string, display_name string, country string"
    )
    cells, states, seen, creators = {}, {}, {}, {}
    for f in catalog.filters:
        inside = {v: sum(c[d] for d in catalog.members(f)) for v, c in per_video.items()}
        inside = {v: k for v, k in inside.items() if k}
        seen[f.key] = len(inside)
        creators[f.key] = len({place[v][1] for v in inside} - {None})
        for v, k in inside.items():
            state, key = place[v]
            country = (latest.get(key, (0, 0, None))[2] or "XX") if state == mt.RESOLVED else None
            for table, cell in ((cells, (f.key, state, country)), (states, (f.key, state))):
                who, count, total = table.get(cell, (frozenset(), 0, 0))
                table[cell] = (who | ({key} - {None}), count + 1, total + k)

    got = mt.filter_cells(observed, resolutions, meta, catalog).collect()
    assert {(r["filter_key"], r["state"], r["country"]): (r["creators"], r["videos"], r["occurrences"]) for r in got} == {
        c: (len(who), count, total) for c, (who, count, total) in cells.items()
    }
    got = mt.state_counts(observed, resolutions, catalog).collect()
    assert {(r["filter_key"], r["state"]): (r["videos"], r["occurrences"]) for r in got} == {
        c: (count, total) for c, (_, count, total) in states.items()
    }
    assert dict(map(tuple, mt.represented_videos(observed, catalog).collect())) == seen
    assert dict(map(tuple, mt.creators(observed, resolutions, catalog).collect())) == creators
    for row in mt.coverage_partition(observed, resolutions, catalog).collect():
        assert sum(row[s] for s in mt.STATES) == row["distinct_input_video_count"]

    pairs = Counter((a, b) for c in per_video.values() for a in c for b in c if a < b)
    assert {(r[0], r[1]): r[2] for r in mt.dataset_pairs(observed, catalog).collect()} == dict(pairs)
    sizes = Counter(len(c) for c in per_video.values())
    overlap = mt.dataset_overlap(observed, catalog).collect()
    assert {r["dataset_count"]: r["videos"] for r in overlap} == dict(sizes)
    assert {r["summed_videos"] for r in overlap} == {sum(len(c) for c in per_video.values())}

    flt = catalog.filters[0]
    want = {}
    for v, c in per_video.items():
        key, kept = place[v][1], {d for d in c if d in catalog.members(flt)}
        if key in latest and kept:
            total, per = want.setdefault(key, (0, Counter()))
            per.update(kept)
            want[key] = (total + 1, per)
    got = cr.creator_rows(observed, resolutions, meta, catalog, flt).collect()
    assert {
        r["channel_key"]: (r["display_name"], r["represented_video_count"], [tuple(b) for b in r["dataset_breakdown"]])
        for r in got
    } == {k: (latest[k][1], total, sorted(per.items())) for k, (total, per) in want.items()}


def test_filter_without_occurrences_has_a_zero_row(spark, inputs):
    catalog = _catalog([("ds-af", "Candidate"), ("dz", "Candidate")], [("all", ["ds-af", "dz"]), ("empty", ["dz"])])
    head = {r["filter_key"]: r for r in mt.headline_totals(*inputs, catalog).collect()}
    assert head["empty"]["represented_video_count"] == 0
    assert head["empty"]["country_bucket_count"] == 0
    assert head["all"]["represented_video_count"] > 0


def test_occurrences_are_read_once(inputs):
    narrow = fx.catalog().only("all", "candidate")
    plan = mt.filter_cells(*inputs, narrow)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "partial_count" in plan
    assert "Window" not in plan


def test_pairs_leave_foreign_datasets_out(spark):
    ids = [f"d{i:03d}" for i in range(130)]
    catalog = _catalog([(d, "Candidate") for d in ids], [("all", ids)])
    rows = [(d, "vid00000001") for d in ("d000", "d129", "foreign1", "foreign2")]
    observed = spark.createDataFrame(rows, "dataset_id string, video_id string")
    got = [tuple(r) for r in mt.dataset_pairs(observed, catalog).collect()]
    assert got == [("d000", "d129", 1)]


def test_rows_without_a_channel_are_dealt_over_tasks(spark):
    rows = spark.range(2000).selectExpr("cast(null as bigint) as channel_key", "id as videos")
    channels = spark.createDataFrame([(1, "DE")], "channel_key long, country string")
    located = mt.with_country(rows, channels)
    assert located.where("country = 'XX'").count() == 2000
    assert "_deal" not in located.columns


def test_places_of_a_set_are_looked_for_up_to_its_highest_bit(spark):
    rows = spark.createDataFrame([(0, 5), (5, 0), (1 << 61, 1), (None, 3)], "w0 long, w1 long")
    places = mt.positions("w0", "w1")
    assert [r[0] for r in rows.selectExpr(places).collect()] == [[62, 64], [0, 2], [61, 62], [62, 63]]
    # The bits of a word are no list of fixed length, walked in full for each row.
    assert f"sequence(0, {mt.WORD_BITS - 1})" not in places


def test_counts_in_columns_are_those_in_lists(spark, sf, monkeypatch):
    catalog = fx.catalog()
    tables = (fx.observations(spark, sf), fx.resolutions(spark, sf))
    flt = next(f for f in catalog.filters if f.key == "candidate")

    def counted():
        counts = mt.channel_counts(*tables, catalog)
        return counts, cr.creator_rows_of(counts, fx.channels(spark, sf), catalog, flt)

    columns = counted()
    # One shuffle of a video's occurrences, and one of a channel's rows; nothing is collected in lists.
    assert all("collect_list" not in df._jdf.queryExecution().optimizedPlan().toString() for df in columns)
    monkeypatch.setattr(mt, "COLUMNS", 0)
    monkeypatch.setattr(cr, "COLUMNS", 0)
    for one, two in zip(columns, counted(), strict=True):
        assert one.columns == two.columns and one.count() > 0
        assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
