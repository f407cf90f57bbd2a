"""Country buckets and display names."""

from __future__ import annotations

from itertools import product
from string import ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
UNKNOWN_COUNTRY = "XX"
UNKNOWN_COUNTRY_NAME = "Unknown country"
ALPHA2 = r"\A[A-Z]{2}\z"

# A bucket is two capital letters, so no set of buckets has more than this many members.
MAX_COUNTRY_BUCKETS = 26 * 26

_name_rows: list[tuple[str, str]] = []


def country_bucket(raw: Column) -> Column:
    """Upper-cased two-letter code, or the unknown bucket."""
    code = F.upper(raw)
    return F.when(code.rlike(ALPHA2), code).otherwise(F.lit(UNKNOWN_COUNTRY))


def display_names(spark: SparkSession) -> DataFrame:
    """(country, country_name) for every code the JVM's locale data can name in English."""
    if not _name_rows:
        jvm = spark._jvm
        english = jvm.java.util.Locale.ENGLISH
        for pair in product(ascii_uppercase, repeat=2):
            code = "".join(pair)
            if code == UNKNOWN_COUNTRY:
                continue
            name = jvm.java.util.Locale("", code).getDisplayCountry(english)
            if name != code:
                _name_rows.append((code, name))
    return spark.createDataFrame(_name_rows, "country string, country_name string")


def with_display_name(df: DataFrame, code_col: str = "country", name_col: str = "country_name") -> DataFrame:
    """Add the English name; the unknown bucket has a fixed one, a code without a name is its own name."""
    names = display_names(df.sparkSession).select(
        F.col("country").alias("_code"), F.col("country_name").alias("_name")
    )
    # At most MAX_COUNTRY_BUCKETS rows.
    joined = df.join(F.broadcast(names), F.col(code_col) == F.col("_code"), "left")
    return joined.withColumn(
        name_col,
        F.when(F.col(code_col) == UNKNOWN_COUNTRY, F.lit(UNKNOWN_COUNTRY_NAME)).otherwise(
            F.coalesce(F.col("_name"), F.col(code_col))
        ),
    ).drop("_code", "_name")
