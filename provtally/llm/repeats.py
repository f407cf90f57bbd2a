"""What the two finders of repeated passages share: candidates before, spans and digests after.

A word goes if a window of ``window`` consecutive words covers it whose word sequence also starts
in a document of smaller id. Equal windows select the same minimiser, so only windows whose
minimiser occurs in two different texts can repeat; all others are ruled out by counts alone, and
texts without any are never shuffled again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provtally.llm.common import stored, with_group
from provtally.llm.words import _WORDS, Words, _Powers, _sums, buffers, chunks, lists, minimisers, signed, unsigned

#: Minimisers of more places than this are hot: their windows are counted by a partial aggregate.
HOT_PLACES = 2000
_SECOND = _Powers(0xA0761D6478BD642F)
_ROWS = "doc_id long, sha string, n_words long, minis array<struct<mini:long,n:long>>"
SPANS = "doc_id long, sha string, begin int, stop int"


@dataclass(frozen=True)
class Candidates:
    """rows: one per document row (doc_id, sha, n_words); classes: one per word sequence;
    texts: (doc_id, text, found) of the texts that share a minimiser; hot: any minimiser is hot,
    having more than hot_places places."""

    rows: DataFrame
    classes: DataFrame
    texts: DataFrame
    hot: bool
    hot_places: int


def digests(words: Words, keep: np.ndarray | None = None) -> list[str]:
    data, at, _, _ = words.joined(keep)
    view = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(view[at[i] : at[i + 1]]).hexdigest() for i in range(len(at) - 1)]


def _scanner(window: int, k: int) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = buffers(batch.column(1))
            for first, last in chunks(at):
                words = Words(raw, at, first, last)
                start, place, value = minimisers(words, window, k)
                # Windows that share a place follow each other.
                own = np.ones(len(start), dtype=bool)
                own[1:] = place[1:] != place[:-1]
                row, value = words.row[start[own]], value[own]
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
                at_new = np.flatnonzero(new)
                n = np.diff(np.append(at_new, len(row)))
                minis = pa.StructArray.from_arrays([pa.array(signed(value[new])), pa.array(n.astype(np.int64))], names=["mini", "n"])
                counts = np.bincount(row[new], minlength=last - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(digests(words), pa.string()),
                        pa.array(words.count.astype(np.int64)),
                        lists(minis, counts),
                    ],
                    names=["doc_id", "sha", "n_words", "minis"],
                )

    return scan


def candidates(docs: DataFrame, id_col: str, text_col: str, window: int, k: int, hot_places: int) -> Candidates:
    """Which texts share a minimiser with a different text. Equal word sequences count as one text.

    A minimiser's places are counted within texts too, so a line that one text repeats is as hot as
    one that many texts have.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = stored(source.mapInArrow(_scanner(window, k), _ROWS), "rows")
    long_rows = rows.where(F.col("n_words") >= window)
    classes = long_rows.groupBy("sha").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_rows"), F.any_value("minis").alias("minis")
    )
    classes = stored(classes, "classes")
    places = classes.where("first is not null").select("first", F.inline("minis"))
    counts = places.groupBy("mini").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"))
    repeated = stored(counts.where("texts > 1").drop("texts"), "minis")
    found = places.drop("n").join(repeated, "mini").groupBy("first").agg(F.collect_list(F.struct("mini", "n")).alias("found"))
    texts = source.join(found.hint("shuffle_hash"), F.col("doc_id") == F.col("first")).select("doc_id", "text", "found")
    hot = not repeated.where(F.col("n") > hot_places).isEmpty()
    return Candidates(rows.drop("minis"), classes.drop("minis"), stored(texts, "texts"), hot, hot_places)


def selected(batch: pa.RecordBatch, window: int, k: int, hot_places: int, hot: bool) -> Iterator[tuple]:
    """For chunks of candidate rows: words, first row, and the windows whose minimiser is repeated (hot or not)."""
    raw, at = buffers(batch.column("text"))
    found = batch.column("found")
    if isinstance(found, pa.ChunkedArray):
        found = found.combine_chunks()
    own = np.repeat(np.arange(len(found)), np.diff(found.offsets.to_numpy()))
    low, high = found.offsets[0].as_py(), found.offsets[len(found)].as_py()
    value = unsigned(found.values.field("mini").to_numpy()[low:high])
    many = found.values.field("n").to_numpy()[low:high] > hot_places
    for first, last in chunks(at):
        words = Words(raw, at, first, last)
        start, place, mini = minimisers(words, window, k)
        mine = (own >= first) & (own < last) & (many == hot)
        known = _pair(own[mine] - first, value[mine])
        if not len(known) or not len(start):
            continue
        known.sort()
        asked = _pair(words.row[start], mini)
        at_known = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        picked = known[at_known] == asked
        yield words, first, start[picked], place[picked], mini[picked]


def _pair(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    return value + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def hot_spans(texts: DataFrame, window: int, k: int, hot_places: int) -> DataFrame:
    """Repeated windows of hot minimisers: least id per window by a map-side aggregate, then joined back.

    Equal windows of one text travel as one row with the spans they cover there, so a text that
    repeats one line is as many rows as the line has words.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, first, start, _, _ in selected(batch, window, k, hot_places, hot=True):
                if not len(start):
                    continue
                one = _sums(words.hash, start, start + window, _WORDS)
                two = _sums(words.hash, start, start + window, _SECOND)
                order = np.lexsort((start, two, one, words.row[start]))
                start, one, two = start[order], one[order], two[order]
                row = words.row[start]
                group, span = np.ones(len(start), dtype=bool), np.ones(len(start), dtype=bool)
                group[1:] = (row[1:] != row[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
                span[1:] = group[1:] | (start[1:] - start[:-1] > window)
                at, to = np.flatnonzero(group), np.flatnonzero(span)
                base = words.first[row]
                begin = (start - base)[to]
                stop = (start - base)[np.append(to[1:], len(start)) - 1] + window
                covered = pa.StructArray.from_arrays(
                    [pa.array(begin.astype(np.int32)), pa.array(stop.astype(np.int32))], names=["begin", "stop"]
                )
                owner = pa.array(row[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(one[at])),
                        pa.array(signed(two[at])),
                        batch.column("doc_id").slice(first, len(words.count)).take(owner),
                        pa.array(digests(words), pa.string()).take(owner),
                        lists(covered, np.add.reduceat(span.astype(np.int64), at)),
                    ],
                    names=["w1", "w2", "doc_id", "sha", "spans"],
                )

    some = texts.where(F.exists("found", lambda x: x["n"] > hot_places))
    windows = some.mapInArrow(emit, "w1 long, w2 long, doc_id long, sha string, spans array<struct<begin:int,stop:int>>")
    windows = stored(windows.select(F.concat_ws(":", "w1", "w2").alias("seq"), "doc_id", "sha", "spans"), "windows")
    least = windows.groupBy("seq").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("places")
    )
    least = stored(least.where("lo < hi").drop("hi"), "least")
    later = with_group(windows, least, "seq", "places", F.concat_ws(" ", "doc_id", "seq")).where("doc_id > lo")
    return later.select("doc_id", "sha", F.inline("spans"))


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = buffers(batch.column("text"))
        ids, spans = batch.column("doc_id"), batch.column("spans")
        for first, last in chunks(at):
            words = Words(raw, at, first, last)
            sha = digests(words)
            edge = np.zeros(len(words.start) + 1, dtype=np.int32)
            for i in range(last - first):
                own = spans[first + i].values
                mine = own.field("sha").to_numpy(zero_copy_only=False) == sha[i]
                np.add.at(edge, words.first[i] + own.field("begin").to_numpy()[mine], 1)
                np.add.at(edge, words.first[i] + own.field("stop").to_numpy()[mine], -1)
            gone = np.cumsum(edge[:-1]) > 0
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(first, last - first),
                    pa.array(sha, pa.string()),
                    pa.array(np.bincount(words.row[gone], minlength=last - first).astype(np.int64)),
                    pa.array(digests(words, ~gone), pa.string()),
                    _span_lists(words, gone),
                ],
                names=["doc_id", "sha", "n_removed", "kept_sha256", "spans"],
            )


def _span_lists(words: Words, gone: np.ndarray) -> pa.Array:
    """Removed words of each row as (begin, stop) spans."""
    first = np.zeros(len(gone), dtype=bool)
    first[words.first[:-1][words.count > 0]] = True
    begins = gone.copy()
    begins[1:] &= ~gone[:-1] | first[1:]
    ends = gone.copy()
    ends[:-1] &= ~gone[1:] | first[1:]
    at, to = np.flatnonzero(begins), np.flatnonzero(ends)
    row = words.row[at]
    offsets = np.zeros(len(words.count) + 1, dtype=np.int32)
    np.cumsum(np.bincount(row, minlength=len(words.count)), out=offsets[1:])
    base = words.first[row]
    pairs = pa.StructArray.from_arrays(
        [pa.array((at - base).astype(np.int32)), pa.array((to + 1 - base).astype(np.int32))], names=["begin", "stop"]
    )
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


def finished(found: Candidates, spans: DataFrame) -> DataFrame:
    """One row per document row: its words, removed words, spans, and digest of what is left."""
    grouped = spans.groupBy("doc_id").agg(F.collect_list(F.struct("sha", "begin", "stop")).alias("spans"))
    cut = found.texts.select("doc_id", "text").join(stored(grouped, "spans").hint("shuffle_hash"), "doc_id")
    cut = stored(
        cut.mapInArrow(
            _remover,
            "doc_id long, sha string, n_removed long, kept_sha256 string, spans array<struct<begin:int,stop:int>>",
        ).dropDuplicates(["doc_id", "sha"]),
        "cut",
    )
    rows = with_group(found.rows, found.classes, "sha", "n_rows", F.concat(F.lit("row "), F.col("doc_id").cast("string")))
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    rows = rows.withColumn("_id", F.when(~copy, F.col("doc_id"))).withColumnRenamed("sha", "_sha")
    cut = cut.select(F.col("doc_id").alias("_cut_id"), "sha", "n_removed", "kept_sha256", "spans")
    out = rows.join(cut, (F.col("_id") == F.col("_cut_id")) & (F.col("_sha") == F.col("sha")), "left")
    copied = F.col("_id").isNull() & copy
    whole = F.array(F.struct(F.lit(0).alias("begin"), F.col("n_words").cast("int").alias("stop")))
    none = F.array().cast("array<struct<begin:int,stop:int>>")
    return out.select(
        "doc_id",
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "_sha")).alias("kept_sha256"),
        F.when(copied, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
    )
