"""Answer a reader's requests from a written release, checking every document on the way.

Each call opens only the documents the release itself names: pointer, manifest, the overview of
the chosen filter, a country's shard, one of its pages. A document that fails a check is not used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from provtally.functions.identifiers import digest_of
from provtally.operators.selection import filter_lookup
from provtally.plans import audit as au
from provtally.plans.manifests import read_manifest
from provtally.plans.release import POINTER_PATH, overview_path
from provtally.session import kept, prepare
from provtally.sources import contracts as ct
from provtally.sources.artifacts import read_artifacts
from provtally.sources.catalog import Catalog, Dataset, PublishedFilter

_OVERVIEW = (
    "releaseId string, countries array<struct<country:string,creatorCount:bigint,representedVideoCount:bigint,"
    "sourceOccurrenceCount:bigint,resolvedVideoCount:bigint,unavailableVideoCount:bigint>>,"
    "coverage struct<inputOccurrenceCount:bigint,distinctInputVideoCount:bigint,partition:struct<resolved:bigint,"
    "unavailableUnclassified:bigint,retryableOrPending:bigint,invalid:bigint,terminalFailure:bigint>,"
    "resolvedChannelCount:bigint,knownCountryChannelCount:bigint,unknownCountryChannelCount:bigint>,"
    "creatorCount bigint, representedVideoCount bigint, representedCountryCount bigint"
)
_PAGE = (
    "country string, sortOrder string, rows array<struct<publicChannelKey:string,displayName:string,country:string,"
    "representedVideoCount:bigint,datasetBreakdown:array<struct<datasetId:string,representedVideoCount:bigint>>,"
    "lastObservedAt:string>>, nextCursor string, pageSize bigint, totalRows bigint"
)
_SHARD = (
    "country string, creatorCount bigint, representedVideoCount bigint, sourceOccurrenceCount bigint,"
    f"datasetBreakdown array<struct<datasetId:string,representedVideoCount:bigint>>, firstPage struct<{_PAGE}>,"
    "pageIndex map<string,array<string>>"
)
_MANIFEST = (
    "releaseId string, generatedAt string, enrichmentCutoff string,"
    "datasets array<struct<datasetId:string,displayName:string,version:string,corpusClass:string,sourceKind:string,"
    "occurrenceUnit:string,sourceCitation:string,snapshotDigest:string>>,"
    "filters array<struct<key:string,label:string,path:string,datasets:array<string>,corpusClasses:array<string>,"
    "isDefault:boolean>>"
)


class ArtifactError(Exception):
    """A document could not be used."""

    def __init__(self, kind: str, path: str, message: str) -> None:
        super().__init__(message)
        self.kind = kind
        self.path = path


def _refuse(path: str, intact: bool, is_json: bool, message: str | None) -> None:
    if not intact:
        raise ArtifactError(au.DIGEST_MISMATCH, path, f"digest mismatch for {path}")
    if not is_json:
        raise ArtifactError(au.SCHEMA_INVALID, path, f"{path} is not JSON")
    if message is not None:
        raise ArtifactError(au.SCHEMA_INVALID, path, f"{path} does not match its schema: {message}")


def _checked(spark: SparkSession, root: str, path: str, digest: str, contract: ct.Record, schema: str) -> DataFrame:
    """One row of a document that is there, intact and in its contract's form."""
    document = read_artifacts(spark, root, path)
    state = document.withColumn("v", au.parsed(F.col("content"))).select(
        digest_of(F.col("content")).alias("found"),
        F.col("v").isNotNull().alias("is_json"),
        F.get(ct.issues(contract, "v"), F.lit(0))["message"].alias("message"),
    ).first()
    if state is None:
        raise ArtifactError(au.NOT_FOUND, path, f"artifact not found: {path}")
    _refuse(path, state["found"] == digest, state["is_json"], state["message"])
    return document.select(F.from_json(F.col("content").cast("string"), schema).alias("d")).select("d.*")


@dataclass(frozen=True)
class OpenRelease:
    """A release whose pointer and manifest have been checked."""

    spark: SparkSession
    root: str
    release_id: str
    manifest_at: str
    generated_at: str
    enrichment_cutoff: str
    catalog: Catalog
    listed: DataFrame

    def _digest(self, path: str) -> str | None:
        """The listed digest of one path; the list itself stays with Spark."""
        found = self.listed.where(F.col("path") == path).first()
        return found["digest"] if found else None

    def overview(self, datasets: list[str] = (), classes: list[str] = ()) -> tuple[DataFrame, bool]:
        """The overview of the filter a selection resolves to, and whether it is that exact selection's."""
        lookup = {(d, c): (key, exact) for d, c, key, exact in filter_lookup(self.catalog)}
        wanted = ("+".join(sorted(set(datasets))), "+".join(sorted(set(classes))))
        if self.catalog.filters:
            key, exact = lookup.get(wanted, (self.catalog.default.key, False))
            path = next(f.path for f in self.catalog.filters if f.key == key)
        else:
            path, exact = overview_path(self.release_id), False
        digest = self._digest(path)
        if digest is None:
            raise ArtifactError(au.NOT_FOUND, path, "the manifest lists no aggregate for this filter")
        found = _checked(self.spark, self.root, path, digest, ct.OVERVIEW, _OVERVIEW)
        if found.first()["releaseId"] != self.release_id:
            raise ArtifactError(au.MIXED_RELEASE, path, "the filtered overview belongs to a different release")
        return found, exact

    def country_rows(self, datasets: list[str] = (), classes: list[str] = ()) -> DataFrame:
        return self.overview(datasets, classes)[0].select(F.inline("countries"))

    def shard(self, country: str, datasets: list[str] = (), classes: list[str] = ()) -> DataFrame:
        """A country's shard, reconciled with the country's row under the selection.

        Gives no row when the selection has no records for the country.
        """
        row = self.country_rows(datasets, classes).where(F.col("country") == country).first()
        if row is None:
            return self.spark.createDataFrame([], _SHARD)
        path = f"releases/{self.release_id}/countries/{country}.json"
        digest = self._digest(path)
        if digest is None:
            raise ArtifactError(au.NOT_FOUND, path, f"the manifest lists no shard for {country}")
        found = _checked(self.spark, self.root, path, digest, ct.COUNTRY_SHARD, _SHARD)
        head = found.select("country", "creatorCount", "representedVideoCount").first()
        if head["country"] != country:
            raise ArtifactError(au.MIXED_RELEASE, path, f"shard for {country} reports country {head['country']}")
        if (head["creatorCount"], head["representedVideoCount"]) != (
            row["creatorCount"], row["representedVideoCount"]
        ):
            raise ArtifactError(au.MIXED_RELEASE, path, "the country detail disagrees with the overview totals")
        return found

    def page(self, country: str, sort_order: str, index: int) -> DataFrame:
        """One creator page, by its place in the shard's page index."""
        found = self.shard(country)
        paths = F.try_element_at(F.col("pageIndex"), F.lit(sort_order))
        entry: Row | None = found.select(
            F.coalesce(F.size(paths), F.lit(0)).alias("n"),
            F.when(F.lit(index) >= 0, F.get(paths, F.lit(index))).alias("path"),
        ).first()
        count = max(entry["n"], 0) if entry else 0
        if count == 0:
            raise ArtifactError(
                au.NOT_FOUND, f"{country}/{sort_order}", f"this release publishes no pages for the {sort_order} order"
            )
        if not 0 <= index < count:
            raise ArtifactError(
                au.NOT_FOUND, f"{country}/{sort_order}/page-{index}",
                f"page {index + 1} does not exist; this country has {count}",
            )
        path = entry["path"]
        digest = self._digest(path)
        if digest is None:
            raise ArtifactError(au.NOT_FOUND, path, "the manifest lists no digest for this creator page")
        page = _checked(self.spark, self.root, path, digest, ct.CREATOR_PAGE, _PAGE)
        head = page.select("country", "sortOrder").first()
        if (head["country"], head["sortOrder"]) != (country, sort_order):
            raise ArtifactError(au.MIXED_RELEASE, path, au.OTHER_PAGE)
        return page


def open_release(spark: SparkSession, root: str) -> OpenRelease:
    """Follow the pointer to the active release."""
    prepare(spark)
    pointer = (
        read_artifacts(spark, root, POINTER_PATH)
        .withColumn("v", au.parsed(F.col("content")))
        .select(
            F.col("v").isNotNull().alias("is_json"),
            (F.size(ct.issues(ct.POINTER, "v")) == 0).alias("valid"),
            *[F.expr(ct.text_at("v", n)).alias(n) for n in ("releaseId", "manifestPath", "manifestDigest")],
        )
        .first()
    )
    if pointer is None:
        raise ArtifactError(au.NOT_FOUND, POINTER_PATH, f"artifact not found: {POINTER_PATH}")
    if not pointer["is_json"]:
        raise ArtifactError(au.POINTER_REFRESH, POINTER_PATH, au.POINTER_NOT_JSON)
    if not pointer["valid"]:
        raise ArtifactError(au.POINTER_REFRESH, POINTER_PATH, au.POINTER_SCHEMA)
    path, release_id = pointer["manifestPath"], pointer["releaseId"]
    manifest = read_manifest(spark, root, path)
    if manifest is None:
        raise ArtifactError(au.NOT_FOUND, path, f"artifact not found: {path}")
    _refuse(path, manifest.digest == pointer["manifestDigest"], manifest.is_json, manifest.message)
    head = manifest.document.select(F.from_json(F.to_json("v"), _MANIFEST).alias("d")).select("d.*").first()
    if head["releaseId"] != release_id:
        raise ArtifactError(au.MIXED_RELEASE, path, au.OTHER_MANIFEST.format(release_id, head["releaseId"]))
    datasets = tuple(
        Dataset(d["datasetId"], d["displayName"], d["version"], d["corpusClass"], d["sourceKind"], d["occurrenceUnit"],
                d["sourceCitation"], d["snapshotDigest"])
        for d in head["datasets"]
    )
    filters = tuple(
        PublishedFilter(f["key"], f["label"], f["path"], tuple(f["datasets"]), tuple(f["corpusClasses"]), f["isDefault"])
        for f in head["filters"]
    )
    return OpenRelease(
        spark, root, release_id, path, head["generatedAt"], head["enrichmentCutoff"], Catalog(datasets, filters),
        kept(manifest.listed, "listed"),
    )
