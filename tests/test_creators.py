"""Ranking and paging, with one country holding most creators."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from provtally.operators import creators as cr


@pytest.fixture(scope="module")
def listing(spark):
    rnd = random.Random(1)
    names = ["a", "Åland", "albania", "B", "é", "Z", "same"]
    rows = [
        (
            f"pk_{i:032d}", rnd.choice(names) + (str(rnd.randrange(40)) if rnd.random() < 0.7 else ""),
            "DE" if rnd.random() < 0.7 else rnd.choice(["US", "XX", "FR"]), rnd.randrange(3, 9), [("d", 1)], "2024-01-19",
        )
        for i in range(900)
    ]
    schema = (
        "public_channel_key string, display_name string, country string, represented_video_count long,"
        " dataset_breakdown array<struct<dataset_id:string,represented_video_count:long>>, last_observed_at string"
    )
    return spark.createDataFrame(rows, schema).repartition(7)


@pytest.mark.parametrize("order", cr.SORT_ORDERS)
def test_ranks_equal_a_window(listing, order):
    from pyspark.sql import Window as W

    w = W.partitionBy("country").orderBy(*cr.sort_columns(order))
    want = listing.withColumn("rank", F.row_number().over(w)).select("public_channel_key", "rank")
    got = cr.creator_ranks(listing, order).select("public_channel_key", F.col("rank").cast("int").alias("rank"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ranking_spreads_a_hot_group(listing, spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = cr.creator_ranks(listing, cr.BY_VIDEOS).where("country = 'DE'")
        parts = placed.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1


def test_pages_partition_the_listing(listing):
    paged = cr.paged(listing, 20).cache()
    assert paged.count() == 2 * listing.count()
    per_page = paged.groupBy("country", "sort_order", "page", "page_count", "total_rows", "next_cursor").agg(
        F.count("*").alias("n"), F.min("rank").alias("low")
    )
    for r in per_page.collect():
        last = r["page"] == r["page_count"] - 1
        assert r["n"] == (r["total_rows"] - 20 * r["page"] if last else 20)
        assert r["low"] == 20 * r["page"] + 1
        assert r["next_cursor"] == (None if last else str(r["page"] + 1))


def test_first_page_is_the_start_of_the_ranking(listing):
    ranked = cr.creator_ranks(listing, cr.BY_VIDEOS).where("rank <= 5").select("country", "rank", "public_channel_key")
    top = cr.first_page(listing, 5).select("country", "rank", "public_channel_key")
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, top.collect()))


def test_page_index_matches_pages(listing):
    counts = cr.page_counts(listing, 20)
    paths = {r["path"] for r in cr.page_index(counts, "r").collect()}
    paged = cr.paged(listing, 20).select(
        cr.page_path("r", F.col("country"), F.col("sort_order"), F.col("page")).alias("path")
    )
    assert paths == {r["path"] for r in paged.distinct().collect()}


def test_page_index_crosses_blocks(spark, monkeypatch):
    monkeypatch.setattr(cr, "_PAGE_BLOCK", 3)
    counts = spark.createDataFrame([("DE", "displayNameAsc", 8)], "country string, sort_order string, page_count long")
    pages = sorted(r["page"] for r in cr.page_index(counts, "r").collect())
    assert pages == list(range(8))


def test_page_fetch_bounds(spark, listing):
    counts = cr.page_counts(listing.where("country = 'US'"), 20)
    pages = counts.first()["page_count"]
    requests = spark.createDataFrame(
        [(1, "US", cr.BY_NAME, 0), (2, "US", cr.BY_NAME, pages), (3, "US", cr.BY_NAME, -1), (4, "ZZ", cr.BY_NAME, 0)],
        "request_id long, country string, sort_order string, page long",
    )
    rows = {r["request_id"]: r for r in cr.page_fetch(requests, counts, "r").collect()}
    assert rows[1]["status"] == "ok" and rows[1]["path"].endswith("US/displayNameAsc/page-0.json")
    assert rows[2]["message"] == f"page {pages + 1} does not exist; this country has {pages}"
    assert rows[3]["status"] == "not-found"
    assert rows[4]["message"] == "this release publishes no pages for the displayNameAsc order"


def test_metadata_as_of_takes_the_last_reading_before_the_cutoff(spark):
    t = lambda d: datetime(2024, 1, d)
    rows = [(1, "old", t(1), 1), (1, "new", t(5), 2), (1, "late", t(9), 3), (2, "late", t(9), 4), (3, "x", t(5), 5),
            (3, "y", t(5), 6)]
    readings = spark.createDataFrame(
        rows, "channel_key long, display_name string, observed_at timestamp, observation_id long"
    )
    got = cr.metadata_as_of(readings, F.lit("2024-01-05 00:00:00").cast("timestamp"))
    assert {r["channel_key"]: r["display_name"] for r in got.collect()} == {1: "new", 3: "y"}


def test_disclosure_and_removal(spark):
    rows = spark.createDataFrame(
        [(1, "a", "DE", 2, [], "2024-01-01"), (2, "b", "DE", 3, [], "2024-01-01"), (3, "c", "DE", 9, [], "2024-01-01")],
        "channel_key long, display_name string, country string, represented_video_count long,"
        " dataset_breakdown array<struct<dataset_id:string,represented_video_count:long>>, last_observed_at string",
    )
    removals = spark.createDataFrame([(3,)], "channel_key long")
    out = cr.published(rows, removals, 3, "salt").collect()
    assert [r["display_name"] for r in out] == ["b"]
    assert "channel_key" not in out[0].asDict()


def test_long_first_pages_come_out_of_ranks(spark):
    rows = spark.range(12_000).selectExpr(
        "concat('pk_', lpad(id, 8, '0')) as public_channel_key", "concat('n', id % 97) as display_name",
        "if(id % 3 = 0, 'DE', if(id = 1, 'FR', 'US')) as country", "id % 50 as represented_video_count",
    )
    for size in (999, 1000, 5000):
        top = cr.first_page(rows, size)
        plan = top._jdf.queryExecution().executedPlan().toString()
        assert ("WindowGroupLimit" in plan) == (size < 1000) and (size < 1000 or "row_number" not in plan)
        assert dict(top.dtypes)["rank"] == "bigint" and top.columns == [*rows.columns, "rank"]
        got = [tuple(r) for r in top.collect()]
        want = []
        for country in ("DE", "FR", "US"):
            held = rows.where(f"country = '{country}'").collect()
            held.sort(key=lambda r: (-r["represented_video_count"], r["display_name"], r["public_channel_key"]))
            want += [(*r, i + 1) for i, r in enumerate(held[:size])]
        assert sorted(got) == sorted(want), size
