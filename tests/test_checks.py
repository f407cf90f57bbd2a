"""Snapshots pinned to rows, faults of inputs, and readings dealt to releases, on odd small tables."""

import pytest
from pyspark.sql import functions as F

from provtally import fixtures as fx
from provtally.operators import creators as cr
from provtally.operators import metrics as mt
from provtally.plans import checks
from provtally.plans import release as rl
from provtally.sources import snapshots
from provtally.sources.contracts import instant

ROWS = [("a", "v1"), ("a", "v1"), ("a", None), ("a", ""), ("b", "v2"), ("b", "v3"), (None, "v4")]


def _digests(spark, rows):
    return {r[0]: r[2] for r in snapshots.snapshot_digests(spark.createDataFrame(rows, "dataset_id string, video_id string")).collect()}


def test_digest_is_of_the_multiset_of_rows(spark):
    base = _digests(spark, ROWS)
    assert _digests(spark, ROWS[::-1]) == base and set(base) == {"a", "b", None}
    for changed in (ROWS[1:], [*ROWS, ROWS[0]], [("a", "v2"), *ROWS[1:]], [("a", ""), *[r for r in ROWS if r != ("a", None)]]):
        assert _digests(spark, changed)["a"] != base["a"] and _digests(spark, changed)["b"] == base["b"]
    # Values do not run together.
    assert _digests(spark, [("a", "1:x")]) != _digests(spark, [("a", "x")])
    assert _digests(spark, []) == {}


def test_every_status_of_a_snapshot(spark):
    frame = lambda rows: spark.createDataFrame(rows, "dataset_id string, video_id string")
    was = [(d, f"v{i}") for d in "abcde" for i in range(3)]
    now = [r for r in was if r not in (("a", "v1"), ("c", "v1")) and r[0] != "e"] + [("b", "v1"), ("c", "other"), ("f", "v1")]
    got = snapshots.check_snapshots(frame(now), snapshots.snapshot_digests(frame(was))).collect()
    assert {r["dataset_id"]: r["status"] for r in got} == {"a": "lost", "b": "added", "c": "changed", "d": "ok", "e": "missing", "f": "unpinned"}


@pytest.mark.parametrize(
    ("text", "want"),
    [("2024-01-01T10:00Z", "2024-01-01 10:00:00"), ("2024-01-01T10:00:00+19:00", "2023-12-31 15:00:00"),
     ("2024-01-01T10:00:00.25-0130", "2024-01-01 11:30:00.25"), ("nonsense", None)],
)
def test_instants_of_every_form(spark, text, want):
    assert spark.range(1).select(instant(text).cast("string")).first()[0] == want


def test_readings_of_many_releases_equal_one_by_one(spark):
    rows = [(k, f"2024-01-{d:02d} 00:00:00", 100 * d + i, f"n{d}{i}") for k in (1, 2, None) for d in (1, 3, 3, 9) for i in range(2)]
    rows += [(5, "2024-01-20 00:00:00", 1, "late"), (6, None, 2, "never")]
    table = spark.createDataFrame(rows, "channel_key long, observed_at string, observation_id long, display_name string")
    table = table.withColumn("observed_at", F.to_timestamp("observed_at"))
    cutoffs = [("c", "2024-01-09T00:00:00Z"), ("a", "2024-01-01T00:00:00Z"), ("same", "2024-01-09T00:00Z"), ("before", "2023-01-01T00:00Z"), ("bad", "x")]
    got = cr.metadata_as_of_each(table, [(n, instant(t)) for n, t in cutoffs]).collect()
    want = [(n, *r) for n, t in cutoffs if t != "x" for r in map(tuple, cr.metadata_as_of(table, instant(t)).collect())]
    assert sorted((r["release_id"], r["channel_key"], r["observed_at"], r["observation_id"], r["display_name"]) for r in got if r["channel_key"]) == sorted(
        (n, k, at, i, name) for n, k, at, i, name in want if k
    )
    assert {r["release_id"] for r in got} == {"c", "a", "same"}


def test_report_of_sound_and_of_empty_inputs(spark, sf):
    sound = rl.Inputs(fx.observations(spark, sf), fx.resolutions(spark, sf), fx.channels(spark, sf), fx.removals(spark, sf), fx.catalog())
    cells, report = checks.checked_cells(sound)
    assert {r["violations"] for r in report.collect()} == {0}
    plain = mt.filter_cells(sound.observations, sound.resolutions, sound.channels, sound.catalog)
    assert sorted(map(repr, cells.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
    none = rl.Inputs(*(t.limit(0) for t in (sound.observations, sound.resolutions, sound.channels, sound.removals)), fx.catalog())
    cells, report = checks.checked_cells(none)
    assert cells.count() == 0 and {r["violations"] for r in report.collect()} == {0}


def test_removal_delta_equals_recomputation_and_reads_no_occurrences(spark, sf):
    observed, channels, catalog = (fx.observations(spark, sf), fx.resolutions(spark, sf)), fx.channels(spark, sf), fx.catalog()
    counts = rl.kept(mt.channel_counts(*observed, catalog), "counts")
    cells = rl.kept(mt.cells_of(counts, channels, catalog), "cells")
    for some in ("c_custkey % 50 = 0", "c_custkey < 0", "c_custkey >= 0"):
        removals = spark.read.parquet(f"{sf}/customer.parquet").where(some).selectExpr("c_custkey as channel_key")
        removals = removals.unionByName(removals)
        got = rl.removed_from_totals(cells, counts, channels, removals, catalog)
        want = mt.cells_of(rl.without_channels(counts, removals), channels, catalog)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))
        assert "lineitem" not in got._jdf.queryExecution().executedPlan().toString()
