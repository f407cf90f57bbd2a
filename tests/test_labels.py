"""Labels, identifiers and country names."""

import random
import re
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from provtally.functions import countries, identifiers, labels


def _share(part, total):
    if total == 0:
        return "—"
    p = part / total * 100
    if 0 < p < 0.1:
        return "<0.1%"
    if 99.9 < p < 100:
        return ">99.9%"
    return f"{Decimal(p).quantize(Decimal('0.1'), ROUND_HALF_UP)}%"


def test_share_rounds_the_exact_double(spark):
    rnd = random.Random(5)
    pairs = [(0, 0), (0, 7), (7, 7), (1, 10000), (9999, 10000), (3, 2000), (1, 16), (1, 32), (1, 80)]
    pairs += [(a, rnd.randrange(max(a, 1), 4000)) for a in (rnd.randrange(0, 2000) for _ in range(3000))]
    df = spark.createDataFrame(pairs, "a long, b long")
    for r in df.select("a", "b", labels.share_label(F.col("a"), F.col("b")).alias("s")).collect():
        assert r["s"] == _share(r["a"], r["b"]), (r["a"], r["b"])


def test_dates(spark):
    df = spark.createDataFrame(
        [("2024-01-05",), ("2024-01-05T10:05Z",), ("2024-01-05T23:30:00-02:00",), ("2024-01-05T10:05:00.123456789Z",),
         ("2024-01-05T00:30:00+0130",), ("yesterday",)],
        "t string",
    )
    rows = {r["t"]: (r["d"], r["i"]) for r in df.select(
        "t", labels.date_label(F.col("t")).alias("d"), labels.instant_label(F.col("t")).alias("i")).collect()}
    assert rows["2024-01-05"] == ("Jan 5, 2024", "Jan 5, 2024, 12:00 AM")
    assert rows["2024-01-05T10:05Z"][1] == "Jan 5, 2024, 10:05 AM"
    assert rows["2024-01-05T23:30:00-02:00"] == ("Jan 6, 2024", "Jan 6, 2024, 1:30 AM")
    assert rows["2024-01-05T10:05:00.123456789Z"][1] == "Jan 5, 2024, 10:05 AM"
    assert rows["2024-01-05T00:30:00+0130"][1] == "Jan 4, 2024, 11:00 PM"
    assert rows["yesterday"] == ("yesterday", "yesterday")


def test_identifier_grammar(spark):
    df = spark.createDataFrame([("abcdefghijk",), ("abcdefghij",), ("abcdefghijkl",), ("abc efghijk",),
                                ("abcdefghijk\n",), ("a_-defghijk",), (None,)], "v string")
    got = [r[0] for r in df.select(identifiers.is_video_id(F.col("v"))).collect()]
    assert got == [True, False, False, False, False, True, False]


def test_leak_scan_equals_the_lookaround_patterns(spark):
    rnd = random.Random(2)
    alphabet = "ab_-C U."
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 300))) for _ in range(300)]
    texts += ["see abcdefghijk and abcdefghijk.", "UC" + "x" * 22, "(UC" + "y" * 22 + ")", "UC" + "z" * 23, ""]
    want = {}
    for i, text in enumerate(texts):
        for pattern in (r"(?<![\w-])[A-Za-z0-9_-]{11}(?![\w-])", r"(?<![\w-])UC[A-Za-z0-9_-]{22}(?![\w-])"):
            for token in re.findall(pattern, text, re.ASCII):
                n, docs = want.get(token, (0, set()))
                want[token] = (n + 1, docs | {i})
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["token"]: (r["occurrences"], r["texts"]) for r in identifiers.leak_scan(df, "id", "text").collect()}
    assert got == {t: (n, len(d)) for t, (n, d) in want.items()}


def test_public_keys_hide_the_channel(spark):
    df = spark.createDataFrame([("UC" + "a" * 22,), ("42",)], "c string")
    keys = [r[0] for r in df.select(identifiers.public_channel_key(F.col("c"), "s")).collect()]
    assert all(re.fullmatch(r"pk_[0-9a-f]{32}", k) for k in keys) and len(set(keys)) == 2
    ok = df.select(identifiers.is_public_channel_key(identifiers.public_channel_key(F.col("c"), "s")))
    assert all(r[0] for r in ok.collect())


def test_countries(spark):
    df = spark.createDataFrame([("de",), ("USA",), (None,), ("QQ",), ("XX",), ("D1",)], "raw string")
    named = countries.with_display_name(df.withColumn("country", countries.country_bucket(F.col("raw"))))
    got = {r["raw"]: (r["country"], r["country_name"]) for r in named.collect()}
    assert got == {
        "de": ("DE", "Germany"), "USA": ("XX", "Unknown country"), None: ("XX", "Unknown country"), "QQ": ("QQ", "QQ"),
        "XX": ("XX", "Unknown country"), "D1": ("XX", "Unknown country"),
    }
