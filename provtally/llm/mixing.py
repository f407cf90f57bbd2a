"""Mixing sources to target weights by repetition.

Sizes are added up per source and shared out by weight; a source takes at most ``most`` times its
size, and what it cannot take goes to the others by weight, until none is above. A source's target
over its size is its repetition rate: every document is emitted floor(rate) times, and once more
when a hash of seed and id falls below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provtally.llm.common import WORD, numbered, packed, stored, unpacked

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3.0
#: Sources up to which their rates are broadcast, some 50 MB; more are joined by a shuffle.
BROADCAST_SOURCES = 1 << 20


def uniform(id_col: str, seed: int) -> Column:
    """A number in [0, 1) from the seed and the id's decimal digits."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size); one row per source.

    Sources take the weights in turn by code point, null last. Each round fixes the sources whose
    share exceeds their limit; only sums reach the driver, so the number of sources is not bounded.
    """
    # UTF-8 bytes sort as code points; null last.
    ordered = sizes.withColumn("_null", F.col("source").isNull().cast("int"))
    ordered, _ = numbered(ordered, ["_null", "source"], "_rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = ordered.withColumn("weight", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int"))).drop("_rank", "_null")
    rows = stored(rows.withColumn("limit", F.lit(float(most)) * F.col("source_size")), "sources")
    level = 0.0
    while True:
        full = F.col("limit") < F.lit(level) * F.col("weight")
        sums = rows.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(full, F.col("limit")).otherwise(F.lit(0.0))).alias("fixed"),
            F.sum(F.when(~full, F.col("weight")).otherwise(F.lit(0.0))).alias("free"),
        ).first()
        rest, free = float(sums["total"] or 0) - (sums["fixed"] or 0.0), sums["free"] or 0.0
        new = rest / free if free else level
        if new <= level:
            break
        level = new
    target = F.least("limit", F.lit(level) * F.col("weight"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def mixed_sizes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST,
    seed: int = 0,
) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target, copies, taken.

    Size is the number of words, 0 for null. A source of no words has target 0 and no copies, and
    so have all where nothing has words. Rows of one id draw the same number. Other columns are
    not read.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
    rows = stored(rows, "sizes")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    other = targets.select(F.col("source").alias("_source"), "source_size", "target")
    joined = rows.join(other, F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    copies = (whole + (uniform("doc_id", seed) < rate - whole).cast("long")).cast("long")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")
    )


def mix_documents(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 0
) -> DataFrame:
    """The documents themselves, each as often as the mix takes it; columns are those of docs, whatever their names.

    Copies follow from a source's rate and the row's id where the row is: texts are not moved. Nulls,
    rows of one id and sources without words are treated as in mixed_sizes.
    """
    rows = packed(docs)
    field = rows["row"].getField
    rows = rows.select("row", field("doc_id").alias("id"), field("source").cast("string").alias("source"))
    size = F.coalesce(F.regexp_count(rows["row"].getField("text"), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = rows.groupBy("source").agg(F.sum(size).alias("source_size"))
    targets = source_targets(sizes, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = stored(targets.select(F.col("source").alias("name"), rate.alias("rate")), "rates")
    rates = F.broadcast(rates) if rates.count() <= BROADCAST_SOURCES else rates
    joined = rows.join(rates, F.col("source").eqNullSafe(F.col("name")))
    whole = F.floor("rate")
    copies = (whole + (uniform("id", seed) < F.col("rate") - whole).cast("long")).cast("int")
    taken = joined.select("row", F.explode(F.array_repeat(F.lit(True), copies)).alias("copy"))
    return taken.select(*unpacked(taken, docs.columns))
