"""SQL of the queries, and the pipeline against its stages in plain Python."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import pytest
import tiktoken

import public_tokenizers

import corpus_pipeline
from provtally.llm import quality_rules, queries
from tests.llm.conftest import CLASHES, SCHEMA, sentence
from tests.llm.test_operators import _links, _signals, words


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(name, spark, duck, sf):
    frame = queries.QUERIES[name](spark, sf)
    found = duck.sql(queries.ORACLES[name])
    assert sorted(found.columns) == sorted(frame.columns)
    got = sorted((tuple(r[c] for c in found.columns) for r in frame.collect()), key=repr)
    assert got == sorted(found.fetchall(), key=repr)


def test_stages_keep_columns_and_take_effect(spark, docs, rows, tmp_path):
    table = docs
    ids = [{i for i, *_ in rows}]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, table, "").write.parquet(str(tmp_path / str(k)))
        made = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert made.columns == docs.columns
        ids.append({r[0] for r in made.select("doc_id").collect()})
        table = made
    # Of the two equal texts the larger id, then one document of all that are near it, passages stay.
    assert {9, 10, 11, 12, 13, 17} & ids[1] == set()
    assert 0 not in ids[2] and 1 in ids[2]
    assert {1, 2, 3, *range(20, 32)} & ids[3] == {1}
    assert {4, 5} <= ids[3]
    assert ids[5] == ids[4] <= ids[3]


def test_pipeline_on_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def plain_stages(rows):
    """The rows after each of the first four stages, and the last stage's result."""
    out = []

    def passes(text):
        n_words, chars, symbols, dup_lines, repeated = _signals(text)
        lines = (text or "").count("\n") + 1
        return not (
            n_words < 10 or 100 * repeated > 20 * n_words or symbols * 100 > n_words * 30
            or dup_lines * 100 > lines * 50 or chars < n_words * 2 or chars > n_words * 20
        )

    rows = [r for r in rows if passes(r[1])]
    out.append(rows)
    by_text = defaultdict(list)
    for r in rows:
        by_text[r[1] or ""].append(r)
    rows = [max(same, key=lambda r: (r[0] is not None, r[0] or 0)) for same in by_text.values()]
    out.append(rows)
    classes = defaultdict(list)
    named = sorted(zip(rows, _numbered_links(rows), strict=True), key=lambda x: repr(x[0]))
    for r, root in named:
        classes[root].append(r)
    rows = [min(same, key=lambda r: (r[0] is None, r[0] or 0)) for same in classes.values()]
    out.append(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1.0 + i % 3 for i, s in enumerate(order)}
    full, level = set(), 0.0
    while True:
        free = [s for s in order if s not in full]
        level = (sum(sizes.values()) - sum(3.0 * sizes[s] for s in full)) / sum(weight[s] for s in free) if free else level
        over = {s for s in free if level * weight[s] > 3.0 * sizes[s]}
        if not over:
            break
        full |= over
    taken = []
    for r in rows:
        rate = min(3.0 * sizes[r[3]], level * weight[r[3]]) / sizes[r[3]]
        draw = int(hashlib.md5(f"0:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:12], 16) / 2**48
        taken += [r] * (int(rate) + (draw < rate - int(rate)))
    out.append(taken)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    last = []
    for r in taken:
        ids = library.encode_ordinary(r[1])
        last.append((r[0], len(ids), sha(" ".join(map(str, ids))), sha(r[1])))
    return [*out, last]


def _numbered_links(rows):
    """A root for each row of the groups that near copies form, whatever the rows' ids."""
    found = _links([(i, r[1]) for i, r in enumerate(rows)])
    return [c for _, c, _, _ in sorted(found)]


def _odd_rows(rows):
    rnd = random.Random(9)
    body, other, third = sentence(rnd, 80), sentence(rnd, 80), sentence(rnd, 80)
    more = [
        (500, " ".join(body)), (501, " ".join(body[:-1])),
        # One id with a near copy and a clean text; ids that are null.
        (501, " ".join(other)), (None, " ".join([*other, "more"])), (None, " ".join(third)), (None, " ".join(third)), (502, " ".join(third[1:])),
        (503, " ".join(third)), (2, " ".join(sentence(rnd, 40))),
    ]
    return [*rows, *((i, t, "en", "a", 0, "d", 1, "s", *(f"{n} of {k}" for n in CLASHES)) for k, (i, t) in enumerate(more))]


def test_pipeline_equals_plain_stages(spark, rows, tmp_path):
    rows = _odd_rows(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    want = plain_stages(rows)
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, table, "").write.parquet(str(tmp_path / str(k)))
        table = spark.read.parquet(str(tmp_path / str(k)))
        # Whole rows: columns with names of the stages' own keep their values.
        assert sorted((tuple(r) for r in table.collect()), key=repr) == sorted(want[k], key=repr), name
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((tuple(r) for r in run.collect()), key=repr) == sorted(want[-1], key=repr)
    assert len(quality_rules.RULES) == 6
