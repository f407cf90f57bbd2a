"""Substring dedup by a sparse suffix array.

Only suffixes that start at content-selected minimiser places are retained, and of those only the
ones whose first words occur in another text. They are sorted by what follows; neighbours give the
common length to the right, and for each length to the left the runs of sorted suffixes that reach
far enough are compared by their left context. Together the two sides make a match of at least
``window`` words; longer matches are covered by the suffixes inside them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from provtally.llm import repeats
from provtally.llm.words import Words, buffers, chunks, mix, mixed, signed, whole_groups

WINDOW, K = 50, 20
_SUFFIX = "mini long, doc_id long, sha string, place int, before binary, after binary"


def _retainer(window: int, k: int, hot_places: int) -> Callable:
    def retain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, first, _, places, minis in repeats.selected(batch, window, k, hot_places, hot=False):
                place, at = np.unique(places, return_index=True)
                mini = minis[at]
                row = words.row[place]
                data, _, low, high = words.joined()
                view = memoryview(data)
                left = np.maximum(words.first[row], place - (window - k))
                right = np.minimum(words.first[row + 1], place + window) - 1
                before = [bytes(view[low[a] : high[b - 1]]) if a < b else b"" for a, b in zip(left, place, strict=True)]
                # A closing space keeps suffixes with the same first words next to each other.
                after = [bytes(view[low[a] : high[b]]) + b" " for a, b in zip(place, right, strict=True)]
                owner = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(mini)),
                        batch.column("doc_id").slice(first, len(words.count)).take(owner),
                        pa.array(repeats.digests(words), pa.string()).take(owner),
                        pa.array((place - words.first[row]).astype(np.int32)),
                        pa.array(before, pa.binary()),
                        pa.array(after, pa.binary()),
                    ],
                    names=["mini", "doc_id", "sha", "place", "before", "after"],
                )

    return retain


def _matrix(column: pa.Array, width: int, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each row, padded on the right by zero, and the numbers of words."""
    raw, at = buffers(column)
    out = np.zeros((len(at) - 1, width), dtype=np.uint64)
    count = np.zeros(len(at) - 1, dtype=np.int64)
    for first, last in chunks(at):
        words = Words(raw, at, first, last)
        place = np.arange(len(words.row)) - words.first[words.row]
        if backwards:
            place = words.count[words.row] - 1 - place
        out[first + words.row, place] = words.hash
        count[first:last] = words.count
    return out, count


def _matcher(window: int, k: int) -> Callable:
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("mini",)):
            after, n_after = _matrix(table.column("after").combine_chunks(), window, backwards=False)
            before, n_before = _matrix(table.column("before").combine_chunks(), window - k, backwards=True)
            mini, ids = table.column("mini").to_numpy(), table.column("doc_id").to_numpy()
            same = np.zeros((len(ids), window), dtype=bool)
            same[1:] = (after[1:] == after[:-1]) & (mini[1:] == mini[:-1])[:, None]
            common = np.logical_and.accumulate(same, axis=1).sum(axis=1)
            longest = np.full(len(ids), -1)
            shortest = np.full(len(ids), -1)
            context = np.zeros(len(ids), dtype=np.uint64)
            for left in range(window - k + 1):
                if left:
                    context = mix(context + mix(before[:, left - 1] ^ mixed(left)))
                rows = np.flatnonzero((n_before >= left) & (n_after >= window - left))
                if not len(rows):
                    continue
                run = np.cumsum(common < window - left).astype(np.uint64)
                key = mix(context[rows] ^ mix(run[rows]))
                order = np.argsort(key, kind="stable")
                edge = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
                least = np.repeat(np.minimum.reduceat(ids[rows[order]], edge), np.diff(np.append(edge, len(order))))
                later = rows[order[ids[rows[order]] > least]]
                longest[later] = left
                shortest[later[shortest[later] < 0]] = left
            hit = np.flatnonzero(longest >= 0)
            if not len(hit):
                continue
            place, owner = table.column("place").to_numpy()[hit], pa.array(hit)
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks().take(owner),
                    table.column("sha").combine_chunks().take(owner),
                    pa.array((place - longest[hit]).astype(np.int32)),
                    pa.array((place - shortest[hit] + window).astype(np.int32)),
                ],
                names=["doc_id", "sha", "begin", "stop"],
            )

    return match


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    k: int = K,
    hot_places: int = repeats.HOT_PLACES,
) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept_sha256, spans (begin, stop) of removed words.

    Removed are the words of every match of at least ``window`` words with a document of smaller
    id. Null and empty texts have no words; texts under ``window`` words lose none. Rows of equal
    id do not match each other, a row of null id matches nothing. Other columns are not read.
    """
    found = repeats.candidates(docs, id_col, text_col, window, k, hot_places)
    suffixes = found.texts.mapInArrow(_retainer(window, k, hot_places), _SUFFIX)
    suffixes = suffixes.repartition("mini").sortWithinPartitions("mini", "after")
    spans = suffixes.mapInArrow(_matcher(window, k), repeats.SPANS)
    if found.hot:
        spans = spans.unionByName(repeats.hot_spans(found.texts, window, k, hot_places))
    return repeats.finished(found, spans)
