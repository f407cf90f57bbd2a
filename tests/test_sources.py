"""Input tables and the catalogue."""

import re
from dataclasses import replace

import pytest

from provtally import fixtures as fx
from provtally.operators import metrics as mt
from provtally.sources import catalog as cat
from provtally.sources import tables


def test_bucketed_inputs_are_not_shuffled_by_video(spark, sf, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = tables.store_by_video(fx.observations(spark, sf), "obs_b", str(tmp_path / "o"), 4)
        r = tables.store_by_video(fx.resolutions(spark, sf), "res_b", str(tmp_path / "r"), 4)
        counts = mt.channel_counts(o, r, fx.catalog())
        plan = counts._jdf.queryExecution().executedPlan().toString()
        exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
        assert exchanges == ["state"], exchanges
        plain = mt.channel_counts(fx.observations(spark, sf), fx.resolutions(spark, sf), fx.catalog())
        assert sorted(map(str, counts.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.sql("drop table if exists obs_b")
        spark.sql("drop table if exists res_b")


def test_declared_columns_only(spark, sf, tmp_path):
    path = str(tmp_path / "o")
    fx.observations(spark, sf).withColumnRenamed("video_id", "x").selectExpr("*", "x as video_id").write.parquet(path)
    df = tables.read_table(spark, path, tables.OBSERVATIONS)
    assert df.columns == ["dataset_id", "video_id"]


def test_catalogue_read_from_tables_equals_the_parameters(spark, sf):
    datasets = fx.datasets(spark, sf)
    read = cat.Catalog.read(datasets, cat.standard_filters(datasets, fx.RELEASE_ID))
    fixed = fx.catalog()
    assert read.filters == fixed.filters
    assert [replace(d, snapshot_digest="") for d in read.datasets] == [
        replace(d, snapshot_digest="") for d in fixed.datasets
    ]


def test_oversized_catalogue_is_refused(spark, sf, monkeypatch):
    monkeypatch.setattr(cat, "MAX_CATALOG_ROWS", 5)
    datasets = fx.datasets(spark, sf)
    with pytest.raises(ValueError, match="more than 5 rows"):
        cat.Catalog.read(datasets, cat.standard_filters(datasets, fx.RELEASE_ID))


def test_filter_keeps_listed_datasets_of_its_classes_only(spark, sf):
    base = fx.catalog()
    mixed = replace(base.filters[0], key="mixed", corpus_classes=("Comparison",))
    catalog = cat.Catalog(base.datasets, (mixed,))
    got = mt.represented_videos(fx.observations(spark, sf), catalog).first()["represented_video_count"]
    want = mt.represented_videos(fx.observations(spark, sf), base.only("comparison")).first()
    assert got == want["represented_video_count"]
