"""Faults of the input tables, counted beside the work that reads them anyway."""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from provtally.functions.sql import text_list
from provtally.operators.metrics import STATES, filter_cells, one_per_channel, one_per_video
from provtally.plans.release import Inputs, kept

CHECKS = ("foreign_dataset_rows", "unknown_state_rows", "repeated_resolutions", "repeated_channels", "channels_without_key")


@dataclass
class Watch:
    """The inputs with their faults counted on the way; ``report`` has the counts once a job has read them.

    Repeated rows are reduced here, by the same rule as everywhere, so that what is counted and what
    is used are one pass. A job that reads an input twice would count its faults twice: keep what it makes.
    """

    inputs: Inputs
    seen: list[Observation] = field(default_factory=lambda: [Observation() for _ in range(5)])

    def observations(self) -> DataFrame:
        known = f"dataset_id in ({text_list(self.inputs.catalog.dataset_ids)})"
        foreign = F.count_if(~F.coalesce(F.expr(known), F.lit(False))).alias(CHECKS[0])
        return self.inputs.observations.observe(self.seen[0], F.count(F.lit(1)).alias("rows"), foreign)

    def resolutions(self) -> DataFrame:
        unknown = F.count_if(~F.coalesce(F.col("state").isin(*STATES), F.lit(False))).alias(CHECKS[1])
        rows = self.inputs.resolutions.observe(self.seen[1], F.count(F.lit(1)).alias("rows"), unknown)
        reduced = one_per_video(rows, F.count(F.lit(1)).alias("_rows"))
        repeated = F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias(CHECKS[2])
        return reduced.observe(self.seen[2], repeated).drop("_rows")

    def channels(self) -> DataFrame:
        unnamed = F.count_if(F.col("channel_key").isNull()).alias(CHECKS[4])
        rows = self.inputs.channels.observe(self.seen[3], F.count(F.lit(1)).alias("rows"), unnamed)
        reduced = one_per_channel(rows, F.count(F.lit(1)).alias("_rows"))
        repeated = F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias(CHECKS[3])
        return reduced.observe(self.seen[4], repeated).drop("_rows")

    def report(self, spark: SparkSession) -> DataFrame:
        """(check, violations), one row per check."""
        found: dict[str, int] = {}
        for seen in self.seen:
            found |= _values(seen)
        return spark.createDataFrame([(c, int(found.get(c, 0))) for c in CHECKS], "check string, violations long")


def _values(seen: Observation) -> dict[str, int]:
    """What was counted; nothing where the optimiser has taken an input without rows out of the plan, and its counts with it."""
    try:
        return seen.get
    except Py4JJavaError as failed:
        if "assertion failed" not in str(failed):
            raise
        return {}


def checked_cells(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    """The cells that all totals are read from, kept, and the report of the inputs they were made of."""
    watch = Watch(inputs)
    cells = kept(filter_cells(watch.observations(), watch.resolutions(), watch.channels(), inputs.catalog), "cells")
    return cells, watch.report(cells.sparkSession)
