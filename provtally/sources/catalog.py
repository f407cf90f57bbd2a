"""The catalogue of a release: its datasets and its published filters.

Both are small by nature (a release's manifest lists them in one document), so they are
held on the driver, behind a check of their size, and enter plans as literals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_CATALOG_ROWS = 10_000

CORPUS_CLASSES = ("Candidate", "Comparison")


@dataclass(frozen=True)
class Dataset:
    dataset_id: str
    display_name: str
    version: str
    corpus_class: str
    source_kind: str
    occurrence_unit: str
    source_citation: str
    snapshot_digest: str


@dataclass(frozen=True)
class PublishedFilter:
    key: str
    label: str
    path: str
    datasets: tuple[str, ...]
    corpus_classes: tuple[str, ...]
    is_default: bool


@dataclass(frozen=True)
class Catalog:
    datasets: tuple[Dataset, ...]
    filters: tuple[PublishedFilter, ...]

    @property
    def dataset_ids(self) -> list[str]:
        return [d.dataset_id for d in self.datasets]

    @property
    def default(self) -> PublishedFilter:
        return next((f for f in self.filters if f.is_default), self.filters[0])

    def members(self, flt: PublishedFilter) -> list[str]:
        """Datasets a filter keeps: the listed ones of the listed corpus classes."""
        listed = set(flt.datasets)
        return [
            d.dataset_id for d in self.datasets if d.dataset_id in listed and d.corpus_class in flt.corpus_classes
        ]

    def single_dataset_filters(self) -> Catalog:
        """The same datasets with one filter per dataset, keyed by its id."""
        filters = tuple(
            PublishedFilter(d.dataset_id, d.display_name, "", (d.dataset_id,), (d.corpus_class,), False)
            for d in self.datasets
        )
        return Catalog(self.datasets, filters)

    def only(self, *keys: str) -> Catalog:
        return Catalog(self.datasets, tuple(f for f in self.filters if f.key in keys))

    def filters_frame(self, spark: SparkSession) -> DataFrame:
        """One row per filter, with its place in the list."""
        rows = [
            (i, f.key, f.label, f.path, list(f.datasets), list(f.corpus_classes), f.is_default)
            for i, f in enumerate(self.filters)
        ]
        schema = (
            "position int, filter_key string, label string, path string, datasets array<string>,"
            " corpus_classes array<string>, is_default boolean"
        )
        return spark.createDataFrame(rows, schema)

    def datasets_frame(self, spark: SparkSession) -> DataFrame:
        rows = [tuple(getattr(d, c) for c in DATASET_COLUMNS) for d in self.datasets]
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in DATASET_COLUMNS))

    def membership_frame(self, spark: SparkSession) -> DataFrame:
        """(filter_key, dataset_id), one row per kept dataset."""
        rows = [(f.key, self.members(f)) for f in self.filters]
        listed = spark.createDataFrame(rows, "filter_key string, datasets array<string>")
        return listed.select("filter_key", F.explode("datasets").alias("dataset_id"))

    @staticmethod
    def read(datasets: DataFrame, filters: DataFrame) -> Catalog:
        """Take the two dimension tables to the driver; refuse tables too large to be a catalogue."""
        ds = _bounded(datasets.select(*DATASET_COLUMNS).orderBy("dataset_id"))
        fs = _bounded(filters.orderBy("position"))
        return Catalog(
            tuple(Dataset(**r.asDict()) for r in ds),
            tuple(
                PublishedFilter(
                    r["filter_key"], r["label"], r["path"], tuple(r["datasets"]), tuple(r["corpus_classes"]),
                    r["is_default"],
                )
                for r in fs
            ),
        )


DATASET_COLUMNS = (
    "dataset_id",
    "display_name",
    "version",
    "corpus_class",
    "source_kind",
    "occurrence_unit",
    "source_citation",
    "snapshot_digest",
)


def _bounded(df: DataFrame) -> list:
    rows = df.limit(MAX_CATALOG_ROWS + 1).collect()
    if len(rows) > MAX_CATALOG_ROWS:
        raise ValueError(f"a catalogue table has more than {MAX_CATALOG_ROWS} rows")
    return rows


def standard_filters(datasets: DataFrame, release_id: str) -> DataFrame:
    """The filters a release publishes from its dataset table: everything, each class, each dataset.

    The collected lists hold dataset ids only, so their length is that of the catalogue.
    """
    ids = F.array_sort(F.collect_list("dataset_id"))
    everything = datasets.groupBy().agg(
        F.lit(0).alias("band"), F.lit("all").alias("filter_key"), F.lit("All datasets").alias("label"),
        ids.alias("datasets"), F.array_sort(F.collect_set("corpus_class")).alias("corpus_classes"),
    )
    by_class = datasets.groupBy("corpus_class").agg(ids.alias("datasets")).select(
        F.lit(1).alias("band"), F.lower("corpus_class").alias("filter_key"),
        F.concat("corpus_class", F.lit(" corpora")).alias("label"), "datasets",
        F.array("corpus_class").alias("corpus_classes"),
    )
    single = datasets.select(
        F.lit(2).alias("band"), F.col("dataset_id").alias("filter_key"), F.col("display_name").alias("label"),
        F.array("dataset_id").alias("datasets"), F.array("corpus_class").alias("corpus_classes"),
    )
    rows = everything.unionByName(by_class).unionByName(single)
    is_default = F.col("band") == 0
    path = F.when(is_default, F.lit(f"releases/{release_id}/overview.json")).otherwise(
        F.concat(F.lit(f"releases/{release_id}/filters/"), "filter_key", F.lit(".json"))
    )
    ordered = rows.groupBy().agg(
        F.array_sort(
            F.collect_list(F.struct("band", "filter_key", "label", path.alias("path"), "datasets", "corpus_classes",
                                    is_default.alias("is_default")))
        ).alias("filters")
    )
    return ordered.select(F.posexplode("filters").alias("position", "f")).select(
        "position", "f.filter_key", "f.label", "f.path", "f.datasets", "f.corpus_classes", "f.is_default"
    )
