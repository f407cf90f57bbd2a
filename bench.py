"""Time the headline queries, best of two runs each; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from provtally.queries import QUERIES
from provtally.session import local_session

HEADLINE = (
    "country_summary", "headline_totals", "coverage_partition", "represented_videos", "creators", "dataset_overlap",
    "dataset_pairs", "quantile_bins", "map_country_join", "country_sorted", "creator_rows", "creator_rank",
    "creator_pages", "first_page", "metadata_asof", "leak_scan", "selection_parse", "selection_canonical",
    "filter_resolve", "overview_json", "country_shard", "shard_reconcile", "validate_fields", "validate_manifest",
    "release_audit",
)


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=8, memory=os.environ.get("BENCH_MEMORY", "16g"))
    small = Path(sf_dir).parent / "sf0.001"
    if small.exists():
        timed(spark, "headline_totals", str(small))
    seconds = {}
    for name in HEADLINE:
        # The first run of a plan is mostly start-up.
        seconds[name] = round(min(timed(spark, name, sf_dir) for _ in range(2)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
