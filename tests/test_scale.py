"""Scales against a direct calculation on random values."""

import math
import random

from provtally.operators import scale as sc


def _expected(values):
    v = sorted(x for x in values if x > 0)
    if not v:
        return "empty", []
    if v[0] == v[-1]:
        return "single-value", [(v[0], v[0], sc.PALETTE[-1])]
    breaks = []
    for e in range(1, 5):
        at = e / 5 * (len(v) - 1)
        low, high = math.floor(at), math.ceil(at)
        breaks.append(math.floor(v[low] + (v[high] - v[low]) * (at - low) + 0.5))
    edges = sorted({v[0], *breaks, v[-1]})
    bins = []
    for e in range(len(edges) - 1):
        low = edges[0] if e == 0 else edges[e] + 1
        shade = min(math.floor(e / max(len(edges) - 2, 1) * 6), 5)
        if low <= edges[e + 1]:
            bins.append((low, edges[e + 1], sc.PALETTE[shade]))
    return "quantile", bins


def _frame(spark, groups):
    rows = [(f"g{g}", "creators", f"C{i}", v) for g, values in enumerate(groups) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "filter_key string, metric string, country string, value long")


def test_random_groups(spark):
    rnd = random.Random(7)
    groups = [[0, 0], [5], [4, 4, 0], [1, 2]] + [
        [rnd.randrange(0, rnd.choice([3, 20, 100000])) for _ in range(rnd.randrange(1, 60))] for _ in range(200)
    ]
    values = _frame(spark, groups)
    scales = {r["filter_key"]: r for r in sc.scales(values).collect()}
    for g, group in enumerate(groups):
        method, bins = _expected(group)
        row = scales[f"g{g}"]
        assert row["method"] == method
        assert [(b["min"], b["max"], b["color"]) for b in row["bins"]] == bins


def test_bins_are_contiguous_and_cover_all_values(spark):
    rnd = random.Random(3)
    values = _frame(spark, [[rnd.randrange(0, 500) for _ in range(40)] for _ in range(20)])
    scales = sc.scales(values)
    for row in scales.collect():
        bins = row["bins"]
        assert all(a["max"] + 1 == b["min"] for a, b in zip(bins, bins[1:]))
    outside = sc.country_bins(values, scales).where("bin_label = 'No data'")
    assert outside.count() == 0


def test_zero_takes_the_first_bin(spark):
    values = _frame(spark, [[0, 3, 9]])
    rows = {r["value"]: r for r in sc.country_bins(values, sc.scales(values)).collect()}
    assert rows[0]["color"] == rows[3]["color"] == sc.PALETTE[0]


def test_empty_scale_has_no_data_and_a_message(spark):
    values = _frame(spark, [[0, 0]])
    scales = sc.scales(values)
    assert {r["bin_label"] for r in sc.country_bins(values, scales).collect()} == {"No data"}
    assert [r["label"] for r in sc.legend(scales).collect()] == ["No creators to display for this filter."]
    assert [r["label"] for r in sc.bin_rows(scales).collect()] == [None]


def test_unknown_metric_is_an_error():
    try:
        sc.metric_column("likes")
    except ValueError as error:
        assert "unknown metric: likes" in str(error)
    else:
        raise AssertionError
