"""A text's language depends on that text alone."""

import numpy as np
import pytest

from provtally.llm import language_id

TEXTS = ["This.", "Über", "x", "", "1 2", "Das ist ein Satz.", "a", "der Hund", "\U0001f600", "Zwölf Boxkämpfer", "the dog"]


def test_every_letter_is_a_centre_of_its_own_text(monkeypatch):
    for chunk in (1, 12, 1 << 17):
        monkeypatch.setattr(language_id, "_CHUNK", chunk)
        grams, letters = [], []
        for first, last, _, row, n in language_id._grams(TEXTS):
            grams += np.bincount(row, minlength=last - first).tolist()
            letters += n.tolist()
        assert grams == letters == [sum(c.isalpha() for c in t) for t in TEXTS]


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the dog and this house are here", "en"), ("der Hund und das Haus sind hier", "de"), ("zwölf Boxkämpfer über", "de")]
    return language_id.fit(spark.createDataFrame(rows, "text string, lang string"))


def test_a_text_alone_is_judged_as_among_others(model):
    names, scores, unsure = model.decide(TEXTS)
    for order in (range(len(TEXTS)), range(len(TEXTS) - 1, -1, -1)):
        got = model.decide([TEXTS[i] for i in order])
        assert [(*x,) for x in zip(*got, strict=True)] == [(names[i], scores[i], unsure[i]) for i in order]
    assert [model.decide([t]) for t in TEXTS] == [([n], [s], [u]) for n, s, u in zip(names, scores, unsure, strict=True)]


def test_predictions_do_not_change_with_partitions(spark, model):
    docs = spark.createDataFrame(list(enumerate(TEXTS * 3)), "doc_id long, text string")
    one, many = (sorted(tuple(r) for r in language_id.predict(docs.repartition(n), model).collect()) for n in (1, 7))
    assert one == many
