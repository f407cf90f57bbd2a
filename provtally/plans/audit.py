"""Check a written release the way its readers do, for all artifacts at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provtally.functions.documents import parsed, parsed_text, text_of
from provtally.functions.identifiers import digest_of
from provtally.functions.sql import exploded
from provtally.plans.manifests import Manifest, read_manifest
from provtally.plans.release import POINTER_PATH, overview_path
from provtally.session import kept, prepare
from provtally.sources import contracts as ct
from provtally.sources.artifacts import read_artifacts

# What can be wrong with an artifact.
OK = "ok"
NOT_FOUND = "not-found"
DIGEST_MISMATCH = "digest-mismatch"
SCHEMA_INVALID = "schema-invalid"
MIXED_RELEASE = "mixed-release"
POINTER_REFRESH = "pointer-refresh"

# How faults of identity and of the pointer are worded.
POINTER_NOT_JSON = "the active release pointer is not JSON"
POINTER_SCHEMA = "the active release pointer does not match its schema"
OTHER_MANIFEST = "pointer names release {} but the manifest is {}"
OTHER_OVERVIEW = "the filtered overview belongs to a different release"
OTHER_SHARD = "shard for {} reports country {}"
OTHER_TOTALS = "the country detail disagrees with the overview totals"
OTHER_PAGE = "the creator page does not match the requested country and sort order"

_RESULT = "path string, kind string, status string, detail string"
#: Splits of small files that one task reads; each task sets up the contracts' checks anew.
SPLITS = 16
_BY_KIND = {"overview": ct.OVERVIEW, "shard": ct.COUNTRY_SHARD, "page": ct.CREATOR_PAGE}


def _first_message(column: str) -> Column:
    return F.get(F.col(column), F.lit(0))["message"]


def _single(spark: SparkSession, root: str, path: str, contract: ct.Record, *values: str):
    """The checks of one document named by the release itself: (found, digest, parsed?, first issue, values)."""
    rows = (
        read_artifacts(spark, root, path)
        .withColumn("v", parsed(F.col("content")))
        .select(
            digest_of(F.col("content")).alias("digest"),
            F.col("v").isNotNull().alias("is_json"),
            ct.issues(contract, "v").alias("issues"),
            *[F.expr(ct.text_at("v", name)).alias(name) for name in values],
        )
        .withColumn("message", _first_message("issues"))
        .withColumn("valid", F.size("issues") == 0)
        .drop("issues")
    )
    return rows.first()


def _verified(files: DataFrame, digests: DataFrame, contract: ct.Record) -> DataFrame:
    """Files that are listed, intact and fit their contract, as (path, v)."""
    return (
        files.withColumn("text", text_of(F.col("content")))
        .withColumn("v", parsed_text(F.col("text")))
        .withColumn("found", digest_of(F.col("content")))
        .join(digests, "path")
        .where((F.col("found") == F.col("digest")) & (F.size(_issues(contract)) == 0))
        .select("path", "v")
    )


def _wanted(spark: SparkSession, root: str, release_id: str, manifest: Manifest, digests: DataFrame) -> DataFrame:
    """(path, wanted_kind, want_country, want_sort, want_totals) of every artifact the release's own documents refer to.

    The manifest names the overviews, the release's overview the countries and their totals, each shard its pages.
    References are followed only out of documents that are themselves in order.
    """
    default_at = overview_path(release_id)
    overviews = manifest.paths().unionByName(spark.createDataFrame([(default_at,)], "path string")).distinct()
    countries = (
        _verified(read_artifacts(spark, root, default_at), digests, ct.OVERVIEW)
        .where(F.expr(ct.text_at("v", "releaseId")) == release_id)
        .select(F.explode(F.expr("try_variant_get(v, '$.countries', 'array<variant>')")).alias("c"))
        .select(F.expr(ct.text_at("c", "country")).alias("country"), _totals("c").alias("want_totals"))
    )
    folder = f"releases/{release_id}/countries/"
    shards = (
        _verified(read_artifacts(spark, root, f"{folder}*"), digests, ct.COUNTRY_SHARD)
        .withColumn("country", F.expr(ct.text_at("v", "country")))
        .where(F.col("path") == F.concat(F.lit(folder), "country", F.lit(".json")))
    )
    index = F.expr("try_variant_get(v, '$.pageIndex', 'map<string,array<string>>')")
    pages = shards.select("country", F.explode(index)).select(
        F.explode("value").alias("path"), "country", F.col("key").alias("sort_order")
    )
    nothing = F.lit(None).cast("string")
    return (
        overviews.select("path", F.lit("overview").alias("wanted_kind"), nothing.alias("want_country"),
                         nothing.alias("want_sort"))
        .unionByName(
            countries.select(F.concat(F.lit(folder), "country", F.lit(".json")).alias("path"),
                             F.lit("shard").alias("wanted_kind"), F.col("country").alias("want_country"),
                             nothing.alias("want_sort"), "want_totals"),
            allowMissingColumns=True,
        )
        .unionByName(
            pages.select("path", F.lit("page").alias("wanted_kind"), F.col("country").alias("want_country"),
                         F.col("sort_order").alias("want_sort")),
            allowMissingColumns=True,
        )
    )


def _totals(value: str) -> Column:
    """Creators and videos of a shard or of a country row; null where a number is missing."""
    return F.expr(
        f"named_struct('creator_count', try_variant_get({value}, '$.creatorCount', 'bigint'),"
        f" 'represented_video_count', try_variant_get({value}, '$.representedVideoCount', 'bigint'))"
    )


def shard_totals(spark: SparkSession, root: str, release_id: str) -> DataFrame:
    """(country, creator_count, represented_video_count) as the written shards of a release state them."""
    files = read_artifacts(spark, root, f"releases/{release_id}/countries/*")
    shards = files.select(parsed(F.col("content")).alias("v"))
    return shards.select(F.expr(ct.text_at("v", "country")).alias("country"), _totals("v").alias("t")).select(
        "country", "t.*"
    )


def audit_release(spark: SparkSession, root: str) -> DataFrame:
    """(path, kind, status, detail): one row per artifact listed or present.

    Per artifact the first failure wins: not listed, absent, digest, not JSON, schema, identity.
    With a broken pointer or manifest nothing below it can be trusted, so only those are reported.
    """
    prepare(spark)

    def report(*rows) -> DataFrame:
        return spark.createDataFrame(list(rows), _RESULT)

    pointer = _single(spark, root, POINTER_PATH, ct.POINTER, "releaseId", "manifestPath", "manifestDigest")
    if pointer is None:
        return report((POINTER_PATH, "pointer", NOT_FOUND, "absent"))
    if not pointer["is_json"]:
        return report((POINTER_PATH, "pointer", POINTER_REFRESH, POINTER_NOT_JSON))
    if not pointer["valid"]:
        return report((POINTER_PATH, "pointer", POINTER_REFRESH, pointer["message"]))
    pointer_row = (POINTER_PATH, "pointer", OK, None)
    listed_at, release_id = pointer["manifestPath"], pointer["releaseId"]

    manifest = read_manifest(spark, root, listed_at)
    if manifest is None:
        fault = (NOT_FOUND, "absent")
    elif manifest.digest != pointer["manifestDigest"]:
        fault = (DIGEST_MISMATCH, "digest mismatch")
    elif not manifest.is_json:
        fault = (SCHEMA_INVALID, "not JSON")
    elif manifest.message is not None:
        fault = (SCHEMA_INVALID, manifest.message)
    elif manifest.value("releaseId") != release_id:
        fault = (MIXED_RELEASE, OTHER_MANIFEST.format(release_id, manifest.value("releaseId")))
    else:
        fault = (OK, None)
    heads = report(pointer_row, (listed_at, "manifest", *fault))
    if fault[0] != OK:
        return heads
    return heads.unionByName(_audit_listed(spark, root, manifest, listed_at, release_id))


def _gathered(files: DataFrame) -> DataFrame:
    """Files in fewer tasks than Spark's splits of some 32 small files, but in two per core at least where there are as many."""
    splits, cores = files.rdd.getNumPartitions(), files.sparkSession.sparkContext.defaultParallelism
    return files.coalesce(max(1, splits // SPLITS, min(splits, 2 * cores)))


def _audit_listed(spark: SparkSession, root: str, manifest: Manifest, manifest_at: str, release_id: str) -> DataFrame:
    # Joined four times, so the list is read for it once.
    digests = kept(manifest.listed, "digests")
    page = r"\Areleases/" + release_id.replace(".", r"\.") + r"/creators/([^/]*)/([^/]*)/page-\d+\.json\z"
    shard = r"\Areleases/" + release_id.replace(".", r"\.") + r"/countries/(.*)\.json\z"
    named = manifest.paths().distinct().withColumn("named", F.lit(True))
    files = _gathered(read_artifacts(spark, root)).where(~F.col("path").isin(POINTER_PATH, manifest_at))
    # One row per published filter.
    typed = files.join(F.broadcast(named), "path", "left").withColumn(
        "kind",
        F.when(F.col("named") | (F.col("path") == overview_path(release_id)), "overview")
        .when(F.col("path").rlike(shard), "shard")
        .otherwise("page"),
    )
    # Everything read from a file is reduced here, so no content is shuffled.
    checked = typed.withColumn("text", text_of(F.col("content"))).withColumn("v", parsed_text(F.col("text"))).select(
        "path",
        "kind",
        digest_of(F.col("content")).alias("found"),
        F.col("v").isNotNull().alias("is_json"),
        _issues_by_kind().alias("issues"),
        F.expr(ct.text_at("v", "releaseId")).alias("release"),
        F.expr(ct.text_at("v", "country")).alias("country"),
        F.expr(ct.text_at("v", "sortOrder")).alias("sort_order"),
        _totals("v").alias("totals"),
    ).withColumn("message", _first_message("issues")).withColumn("bad_schema", F.size("issues") > 0).drop("issues")
    joined = digests.join(checked, "path", "full_outer").join(
        _wanted(spark, root, release_id, manifest, digests), "path", "full_outer"
    )
    kind = F.coalesce("kind", "wanted_kind", F.when(F.col("path").rlike(shard), "shard"), F.lit("page"))
    wrong_release = (F.col("kind") == "overview") & ~F.col("release").eqNullSafe(F.lit(release_id))
    wrong_shard = (F.col("kind") == "shard") & ~F.col("country").eqNullSafe(F.regexp_extract("path", shard, 1))
    wrong_totals = (
        (F.col("kind") == "shard") & F.col("want_totals").isNotNull() & ~F.col("totals").eqNullSafe(F.col("want_totals"))
    )
    # Where no sound shard refers to a page, its own path says what it should hold.
    by_path = F.col("path").rlike(page)
    want_country = F.coalesce("want_country", F.when(by_path, F.regexp_extract("path", page, 1)))
    want_sort = F.coalesce("want_sort", F.when(by_path, F.regexp_extract("path", page, 2)))
    wrong_page = (
        (F.coalesce("wanted_kind", "kind") == "page")
        & want_country.isNotNull()
        & (~F.col("country").eqNullSafe(want_country) | ~F.col("sort_order").eqNullSafe(want_sort))
    )

    def chain(*outcomes: Column | str | None) -> Column:
        conditions = (
            F.col("digest").isNull(), F.col("found").isNull(), F.col("found") != F.col("digest"), ~F.col("is_json"),
            F.col("bad_schema"), wrong_release, wrong_shard, wrong_totals, wrong_page,
        )
        result = None
        for condition, outcome in zip(conditions, outcomes, strict=True):
            value = outcome if isinstance(outcome, Column) else F.lit(outcome)
            result = F.when(condition, value) if result is None else result.when(condition, value)
        return result

    status = F.coalesce(
        chain(
            NOT_FOUND, NOT_FOUND, DIGEST_MISMATCH, SCHEMA_INVALID, SCHEMA_INVALID, MIXED_RELEASE, MIXED_RELEASE,
            MIXED_RELEASE, MIXED_RELEASE,
        ),
        F.lit(OK),
    )
    detail = chain(
        "not listed", "absent", "digest mismatch", "not JSON", F.col("message"),
        OTHER_OVERVIEW, F.format_string(OTHER_SHARD.replace("{}", "%s"), F.regexp_extract("path", shard, 1), "country"),
        OTHER_TOTALS, OTHER_PAGE,
    )
    return joined.select("path", kind.alias("kind"), status.alias("status"), detail.alias("detail"))


def _issues(contract: ct.Record) -> Column:
    """The violations of the document in ``text`` and ``v``; only one that its types do not clear is walked."""
    return F.expr(f"if({ct.sound_sql(contract, 'text')}, cast(array() as array<{ct.ISSUE}>), {ct.issues_sql(contract, 'v')})")


def _issues_by_kind() -> Column:
    result = None
    for kind, contract in _BY_KIND.items():
        condition, value = F.col("kind") == kind, _issues(contract)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result


def document_issues(documents: DataFrame, contract: ct.Record, key: str, body: str = "body") -> DataFrame:
    """(key, path, rule, message): every violation in a table of JSON documents."""
    prepare(documents.sparkSession)
    # A filter would be moved below a repartition of the documents, to the few tasks that read them.
    tested = documents.select(F.col(key), F.col(body).alias("text"), ct.sound(contract, body).alias("cleared"))
    checked = tested.select(key, "cleared", F.when(~F.col("cleared"), parsed_text(F.col("text"))).alias("v"))
    not_json = F.array(
        F.struct(
            F.lit("").alias("path"), F.lit("not_json").alias("rule"), F.lit("not JSON").alias("message"),
            F.lit(True).alias("fatal"),
        )
    )
    found = F.when(F.col("cleared"), F.array().cast(f"array<{ct.ISSUE}>")).when(F.col("v").isNull(), not_json).otherwise(ct.issues(contract, "v"))
    return exploded(checked, found, "i", key).select(key, "i.path", "i.rule", "i.message")


def reconcile_shards(shards: DataFrame, overview_rows: DataFrame, filter_keys: list[str]) -> DataFrame:
    """Country totals of the shards against those of the named filters' overviews.

    ``shards`` and ``overview_rows`` have country, creator_count and represented_video_count; the
    overview side also filter_key. There is one shard per country, so an overview of a narrower
    filter with other totals does not reconcile.
    """
    totals = F.struct("creator_count", "represented_video_count")
    wanted = shards.select(
        F.explode(F.array(*[F.lit(k) for k in filter_keys])).alias("filter_key"), "country", totals.alias("shard")
    )
    both = wanted.join(
        overview_rows.select("filter_key", "country", totals.alias("overview")), ["filter_key", "country"], "full_outer"
    )
    status = (
        F.when(F.col("shard").isNull(), NOT_FOUND)
        .when(F.col("overview").isNull(), "not-in-filter")
        .when(F.col("shard").eqNullSafe(F.col("overview")), OK)
        .otherwise(MIXED_RELEASE)
    )
    return both.select("filter_key", "country", status.alias("status"))
