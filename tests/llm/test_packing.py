"""Packing: ids of the tokenizers library, an exact cover by pieces, no padding, and the placement rule by brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from provtally.llm import packing
from provtally.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(VOCABULARY)
    made.encode_special_tokens = True
    return made


def _ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


ODD = ["<|endoftext|> x", "a" * 3000, " " * 5000 + "y", "word\n\n\tword  end ", "it's ½ 中文　 \U0001f600", "no blank " * 900]


def test_ids_are_those_of_the_library(library, monkeypatch):
    own = packing.Encoder(VOCABULARY)
    rnd = np.random.default_rng(1)
    signs = list("astrev'  \n\t19.,?é 　中🙂") + ["'s", "'re", " 'd", "\r\n"]
    texts = ODD + ["".join(rnd.choice(signs, rnd.integers(0, 200))) for _ in range(500)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for chars in (1 << 20, 40):
        monkeypatch.setattr(packing, "SLICE_CHARS", chars)
        assert [own.encode(t).tolist() for t in texts] == want
    monkeypatch.setattr(own, "fast", None)
    assert [own.encode(t).tolist() for t in texts] == want


def _check(found, documents, window):
    """documents: multiset of (doc_id, ids); found: rows with ids."""
    texts, fills = defaultdict(list), defaultdict(list)
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        texts[r["doc_id"]].append((r["start"], r["doc_tokens"], ids))
        fills[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in fills.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        total = sum(n for _, n in parts)
        assert total <= window and (total == window or total & (total - 1) == 0)
    # Documents of one id may be told apart by nothing but their starts, so only their ids are compared.
    want = defaultdict(Counter)
    for doc, ids in documents:
        want[doc].update(ids)
    assert {d: sum((Counter(i) for *_, i in p), Counter()) for d, p in texts.items()} == dict(want)
    single = {d: ids for d, ids in documents if sum(d == e for e, _ in documents) == 1}
    for doc, ids in single.items():
        parts = sorted(texts[doc])
        assert all(total == len(ids) for _, total, _ in parts)
        assert [s for s, *_ in parts] == [sum(len(p[2]) for p in parts[:i]) for i in range(len(parts))]
        assert [x for p in parts for x in p[2]] == ids


@pytest.mark.parametrize(("window", "most_open"), [(1024, packing.MOST_OPEN), (64, 3), (4, 1)])
def test_pieces_cover_documents_and_nothing_is_padded(spark, docs, rows, empty, library, window, most_open):
    found = packing.pack_documents(docs, VOCABULARY, window=window, most_open=most_open).collect()
    _check(found, [(r[0], _ids(library, r[1])) for r in rows], window)
    assert packing.pack_documents(empty, VOCABULARY).count() == 0


def test_digests_and_whole_sequences(spark, docs):
    pieces = packing.pack_documents(docs, VOCABULARY).persist()
    crc = {(r["sequence_id"], r["offset"]): zlib.crc32(r["ids"]) for r in pieces.collect()}
    assert {(r["sequence_id"], r["offset"]): r["ids_crc32"] for r in packing.piece_digests(pieces).collect()} == crc
    whole = packing.sequences(pieces).collect()
    assert len(whole) == len({s for s, _ in crc}) and sum(r["n_pieces"] for r in whole) == len(crc)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in whole)
    pieces.unpersist()


def test_placement_minimises_squares_of_partial_levels():
    rnd = np.random.default_rng(5)
    packer = packing.Packer(32)
    squares = lambda count: sum(int(c) ** 2 for h, c in enumerate(count) if 0 < h < 32 and h & (h - 1))
    for size in rnd.integers(1, 32, 4000).tolist():
        options = {}
        for h in range(33 - size):
            if h == 0 or packer.count[h]:
                after = packer.count.copy()
                after[h] -= h > 0
                after[h + size] += 1
                options[h] = squares(after)
        chosen = packer.level(size)
        assert options[chosen] == min(options.values())
        list(packer.place((0, 0, np.zeros(size, np.uint32), size)))
        assert [len(w) for w in packer.open] == packer.count[:32].tolist() and packer.held == packer.count[:32].sum()


def test_few_documents_are_cut(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    found = packing.pack_documents(docs, VOCABULARY).select("doc_id", "length", "doc_tokens").collect()
    pieces = Counter(r["doc_id"] for r in found)
    short = {r["doc_id"] for r in found if r["doc_tokens"] <= 1024}
    assert sum(pieces[d] == 1 for d in short) > 0.8 * len(short)
