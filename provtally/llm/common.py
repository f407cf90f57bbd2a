"""Storage, numbering and skew-safe joins that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provtally.session import new_folder

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Groups of at least one row in so many are hot, so there are never more hot groups than this.
HOT_SHARE = 1000
#: Buckets of fewer bytes are written by one task each, as files are then dearer than a shuffle.
BUCKET_BYTES = 1 << 20


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, label: str, size: int) -> DataFrame:
    """Like stored, in one bucket of ``key`` per shuffle partition, so that joins on it do not shuffle the table again; of about size bytes."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    name = f"{label}_{path.rpartition('-')[2]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size < buckets * BUCKET_BYTES:
        df = df.repartition(buckets, key)
    writer = df.write.format("parquet").option("path", path).option("compression", "zstd")
    writer.bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def utf8_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns of df as one struct, so that names used beside it cannot clash with theirs."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def unpacked(df: DataFrame, columns: list[str], name: str = "row") -> list[Column]:
    """The columns of a struct made by packed, under their own names."""
    return [df[name].getField(c).alias(c) for c in columns]


def with_group(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: Column) -> DataFrame:
    """Left join of rows to one row per group, safe for groups that hold much of all rows.

    ``groups`` has ``key``, the group's number of rows ``size`` and its values. At most HOT_SHARE
    groups can hold one row in HOT_SHARE, so those are broadcast; their rows go to the sort-merge
    join under ``spread``, a value of ``key``'s type that matches no group, and so are dealt evenly.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    values = [c for c in groups.columns if c != key]
    hot = groups.where(F.col(size) * HOT_SHARE >= F.lit(total)) if total >= HOT_SHARE else groups.where(F.lit(False))
    near = hot.select(F.col(key).alias("_hot"), F.struct(*values).alias("_near"))
    far = groups.select(F.col(key).alias("_cold"), F.struct(*values).alias("_far"))
    joined = rows.join(F.broadcast(near), rows[key] == F.col("_hot"), "left")
    joined = joined.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(spread))
    joined = joined.join(far, F.col("_key") == F.col("_cold"), "left")
    picked = [F.coalesce(F.col(f"_near.{c}"), F.col(f"_far.{c}")).alias(c) for c in values]
    return joined.select(*[F.col(c) for c in rows.columns], *picked)


def numbered(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """Global row numbers 0..n-1 in the given order, and n; no task ever holds more than its share.

    Rows are range-partitioned and sorted once and kept by a reliable checkpoint; a row's number is
    its place in its partition plus the rows of the partitions before. Equal rows may swap numbers.
    """
    keys = [f"key{i}" for i in range(len(order))]
    spread = packed(df).select("row", *[F.col("row").getField(c).alias(k) for c, k in zip(order, keys, strict=True)])
    spread = spread.withColumn("tie", F.monotonically_increasing_id())
    ordered = spread.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie").select("row")
    new_folder(df.sparkSession, "number")
    placed = ordered.checkpoint().withColumn("_place", F.monotonically_increasing_id())
    counts = placed.groupBy(F.shiftright("_place", 33).alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, total = [], 0
    for row in sorted(counts, key=lambda r: r["_part"]):
        starts.append((row["_part"], total))
        total += row["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    placed = placed.withColumn("_part", F.shiftright("_place", 33)).join(F.broadcast(offsets), "_part")
    number = F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    kept = [c for c in df.columns if c != name]
    return placed.select(*unpacked(placed, kept), number.alias(name)), total


def components(links: DataFrame, spark: SparkSession) -> DataFrame:
    """Connected components of links (a, b): one row (node, component), component the smallest node.

    Each round joins every node to the neighbour of lowest hash, which at least halves the nodes
    that still have links in expectation, whatever their shape; a hub is reduced map-side.
    """
    edges = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    label: DataFrame | None = None
    turn = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c, t=turn: F.struct(F.xxhash64(F.lit(t), F.col(c)).alias("h"), F.col(c).alias("v"))
        lowest = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        step = stored(lowest.select(F.col("a").alias("old"), F.least(rank("a"), F.col("m"))["v"].alias("new")), "step")
        if label is None:
            label = step.select(F.col("old").alias("node"), F.col("new").alias("root"))
        else:
            moved = label.join(step, label["root"] == step["old"], "left")
            label = stored(moved.select("node", F.coalesce("new", "root").alias("root")), "label")
        left = edges.join(step.select(F.col("old").alias("a"), F.col("new").alias("na")), "a")
        left = left.join(step.select(F.col("old").alias("b"), F.col("new").alias("nb")), "b")
        edges = stored(left.where("na <> nb").select(F.col("na").alias("a"), F.col("nb").alias("b")).distinct(), "links")
        turn += 1
    if label is None:
        return spark.createDataFrame([], "node long, component long")
    least = stored(label.groupBy("root").agg(F.min("node").alias("component")), "least")
    return label.join(least, "root").select("node", "component")
