import random

import pytest
from pyspark.sql import types as T

# More names that the stages or their helpers use.
CLASHES = ("_id", "_digest", "_sha", "_copies", "_source", "_part", "_place", "_start", "_tie", "row", "name", "place", "rate", "copy")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves.
        T.StructField("digest", T.StringType()),
        T.StructField("spans", T.LongType()),
        T.StructField("score", T.StringType()),
        *[T.StructField(n, T.StringType()) for n in CLASHES],
    ]
)


def sentence(rnd: random.Random, n: int) -> list[str]:
    return ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(n)]


def _texts() -> list[str | None]:
    rnd = random.Random(5)
    base, passage = sentence(rnd, 300), sentence(rnd, 70)
    near = [*base[:150], "changed", *base[151:]]
    texts = [
        " ".join(base), " ".join(base), " ".join(near), "  ".join(base).replace("  ", "\n", 3),
        " ".join([*sentence(rnd, 30), *passage, *sentence(rnd, 40)]),
        " ".join([*sentence(rnd, 10), *passage, *sentence(rnd, 5)]),
        " ".join([*passage[:50], *sentence(rnd, 9)]),
        " ".join([*sentence(rnd, 9), *passage[10:59]]),
        " ".join(passage * 3),
        None, "", " \t\n", "one", "one", "three little words", "a" * 5000, " ".join(sentence(rnd, 20000)),
        "same line here\n" * 40, "x#y $z " * 30, "don't we'll I'VE they're 's 'st 12 3½ Ünï çödé \u3000 end \U0001f600!",
    ]
    for _ in range(12):
        copy = list(base)
        copy[rnd.randrange(300)] = "other"
        texts.append(" ".join(copy))
    return texts


@pytest.fixture(scope="session")
def rows():
    made = [(i, t, "en" if i % 2 else "de", [None, "a", "b"][i % 3], 0, "d", 1, "s", *(f"{n} of {i}" for n in CLASHES)) for i, t in enumerate(_texts())]
    # Repeated rows, and one without an id.
    return [*made, made[0], made[4], (None, "no id " * 30, *[None] * (6 + len(CLASHES)))]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
