"""Manifests of any size: written from sorted fragments, read line by line.

A manifest is one JSON document that maps every path of a release to its digest. Here each entry stands on a
line of its own, which JSON allows, as a string holds no line break:

    {...,"artifactDigests":{
    "first path":"digest"
    ,"second path":"digest"
    },...}

Entries are sorted over all tasks, which write them as fragments; one task then joins the fragments to the file
in blocks of bytes and digests it on the way, holding one block, as a file and its SHA-256 are sequences by
definition. Readers split such a file anywhere, so no task holds the list. A manifest in another layout is one
document to Spark, and limited by its 128 MB for a parsed value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provtally.functions.documents import parsed_text, text_of
from provtally.functions.identifiers import DIGEST
from provtally.functions.sql import exploded, quote
from provtally.session import kept, new_folder
from provtally.sources import contracts as ct
from provtally.sources.artifacts import digest_file, join_fragments, read_artifacts

MEMBER = "artifactDigests"
_OPENED = f'"{MEMBER}":{{'
#: Paths named by the error on repeated ones.
SHOWN = 5

# An entry as it is mostly written: nothing escaped in the path, and a digest of the contract's form.
_PLAIN = r'\A"([^"\\\x00-\x1F]+)":"([^"\\\x00-\x1F]+)"\z'
_ENTRIES = "array<struct<key:string,value:string>>"


def entry_lines(digests: DataFrame) -> DataFrame:
    """(path, line) of each listed artifact; a path listed twice is refused."""
    counted = kept(digests.groupBy("path").agg(F.min("digest").alias("digest"), F.count("*").alias("n")), "listed")
    twice = [r["path"] for r in counted.where("n > 1").orderBy("path").limit(SHOWN).collect()]
    if twice:
        raise ValueError(f"listed more than once: {', '.join(twice)}")
    pair = F.to_json(F.create_map("path", "digest"))
    return counted.select("path", F.substring(pair, F.lit(2), F.length(pair) - 2).alias("line"))


def write_manifest(lines: DataFrame, document: str, root: str, path: str) -> str:
    """Write the manifest with the entries of ``lines`` in path order; returns its digest.

    ``document`` is the manifest without entries, its member of digests an empty object.
    """
    spark = lines.sparkSession
    head, tail = document.split(_OPENED + "}")
    folder = new_folder(spark, "fragments")
    lines.orderBy("path").select(F.concat(F.lit(","), "line")).write.option("compression", "none").text(folder)
    # The first entry follows no other, so its comma is left out.
    return join_fragments(spark, folder, root, path, f"{head}{_OPENED}\n", "}" + tail, skip=1)


@dataclass(frozen=True)
class Manifest:
    """A manifest as found: ``document`` is null unless it is JSON; ``message`` is its first violation."""

    digest: str
    document: DataFrame
    is_json: bool
    message: str | None
    listed: DataFrame

    def value(self, name: str) -> str | None:
        return self.document.select(F.expr(ct.text_at("v", name))).first()[0]

    def paths(self) -> DataFrame:
        """(path) of the published filters' overviews."""
        filters = F.expr(
            "transform(try_variant_get(v, '$.filters', 'array<variant>'), f -> try_variant_get(f, '$.path', 'string'))"
        )
        return self.document.select(F.explode(filters).alias("path"))


def read_manifest(spark: SparkSession, root: str, path: str) -> Manifest | None:
    """The manifest below a root: its digest, its document, and (path, digest) of all it lists; None where absent.

    ``document`` has one row with the variant ``v``, in the layout of this module without the entries. Of a path
    listed twice the last entry counts, as JSON readers have it.
    """
    if read_artifacts(spark, root, path).select("path").isEmpty():
        return None
    digest = digest_file(spark, root, path)
    found = _by_line(spark, root, path, digest)
    return found if found is not None else _whole(spark, root, path, digest)


def _first_message(issues: Column) -> Column:
    return F.get(issues, F.lit(0))["message"]


def _whole(spark: SparkSession, root: str, path: str, digest: str) -> Manifest:
    text = read_artifacts(spark, root, path).select(text_of(F.col("content")).alias("text"))
    document = text.select(parsed_text(F.col("text")).alias("v"))
    state = document.select(F.col("v").isNotNull().alias("is_json"), _first_message(ct.issues(ct.MANIFEST, "v")).alias("message")).first()
    listed = document.select(F.explode(F.expr(f"try_variant_get(v, '$.{MEMBER}', 'map<string,string>')")).alias("path", "digest"))
    return Manifest(digest, document, state["is_json"], state["message"], listed)


def _by_line(spark: SparkSession, root: str, path: str, digest: str) -> Manifest | None:
    """The manifest in the layout above; None where it has another."""
    raw = spark.read.option("lineSep", "\n").text(f"{root.rstrip('/')}/{path}")
    # Lines of a split are numbered in order, splits by where they begin.
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    text = raw.select(place.alias("place"), text_of(F.col("value").cast("binary")).alias("text"))
    follows = text.withColumn("follows", F.startswith("text", F.lit(',"'))).withColumn(
        "entry", F.when(F.col("follows"), F.expr("substring(text, 2)")).when(F.startswith("text", F.lit('"')), F.col("text"))
    )
    plain = F.regexp_extract("entry", _PLAIN, 2).rlike(DIGEST)
    lines = follows.withColumn("plain", F.coalesce(plain, F.lit(False))).withColumn(
        "v", F.when(~F.col("plain"), parsed_text(F.concat(F.lit("{"), "entry", F.lit("}"))))
    )
    one = F.array(F.struct(F.regexp_extract("entry", _PLAIN, 1).alias("key"), F.regexp_extract("entry", _PLAIN, 2).alias("value")))
    pairs = F.when(F.col("plain"), one.cast(_ENTRIES)).otherwise(F.expr("map_entries(try_variant_get(v, '$', 'map<string,string>'))"))
    issues = F.expr(f"if(v is null, null, {ct.issues_sql(ct.MapOf(ct.DIGEST_TEXT), 'v', quote(MEMBER))})")
    lines = kept(
        lines.select(
            "place", "follows", F.when(F.col("entry").isNull(), F.col("text")).alias("other"), pairs.alias("pairs"),
            (F.col("plain") | F.col("v").isNotNull()).alias("sound"), _first_message(issues).alias("message"),
        ),
        "lines",
    )
    shape = lines.agg(
        F.count("*").alias("rows"), F.count("other").alias("others"), F.count_if(F.expr("other is null and sound")).alias("sound"), F.count_if(F.expr("other is null and not follows")).alias("leads"),
        F.min(F.when(F.col("other").isNull(), F.col("place"))).alias("first"),
        F.min(F.when(F.col("other").isNull() & ~F.col("follows"), F.col("place"))).alias("lead"),
        F.max(F.when(F.col("other").isNull(), F.col("place"))).alias("last"),
        F.min_by("message", F.when(F.col("message").isNotNull(), F.col("place"))).alias("message"),
    ).first()
    if shape["others"] != 2 or shape["sound"] != shape["rows"] - 2 or shape["leads"] != min(1, shape["sound"]) or shape["lead"] != shape["first"]:
        return None
    (start, head), (end, tail) = [(r["place"], r["other"]) for r in lines.where("other is not null").orderBy("place").select("place", "other").collect()]
    between = shape["first"] is None or (start < shape["first"] and shape["last"] < end)
    if not (between and head.endswith(_OPENED) and tail.startswith("}")):
        return None
    body = spark.createDataFrame([(head + tail,)], "text string")
    document = body.select(parsed_text(F.col("text")).alias("v"))
    issue = F.get(ct.issues(ct.MANIFEST, "v"), F.lit(0))
    state = document.select(F.col("v").isNotNull().alias("is_json"), issue["path"].alias("path"), issue["message"].alias("message")).first()
    message = state["message"]
    earlier = list(ct.MANIFEST.fields)[: list(ct.MANIFEST.fields).index(MEMBER)]
    if shape["message"] is not None and (message is None or state["path"].split(".")[0] not in earlier):
        message = shape["message"]
    listed = exploded(lines, F.col("pairs"), "pair", "place").groupBy("pair.key").agg(F.max_by("pair.value", "place").alias("digest"))
    return Manifest(digest, document, state["is_json"], message, listed.select(F.col("key").alias("path"), "digest"))
