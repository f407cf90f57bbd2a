"""Substring dedup by super-k-mers.

Consecutive windows that share a minimiser travel as one packed string of words to the bucket of
that minimiser, where all windows are sorted by hash and each is compared with the least document
id among its equals. Windows whose minimiser occurs in one text only never travel. Buckets of hot
minimisers are not gathered: their windows are reduced map-side to a least id and joined back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from provtally.llm import repeats
from provtally.llm.words import Words, buffers, chunks, mix, signed, unsigned, whole_groups

WINDOW, K = 50, 12
_SUPER = "mini long, doc_id long, sha string, begin int, packed binary"


def _packer(window: int, k: int, hot_places: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, first, start, place, mini in repeats.selected(batch, window, k, hot_places, hot=False):
                new = np.ones(len(start), dtype=bool)
                new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
                at = np.flatnonzero(new)
                begin, stop = start[at], start[np.append(at[1:], len(start)) - 1] + window
                data, _, low, high = words.joined()
                view = memoryview(data)
                row = pa.array(words.row[begin])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(mini[at])),
                        batch.column("doc_id").slice(first, len(words.count)).take(row),
                        pa.array(repeats.digests(words), pa.string()).take(row),
                        pa.array((begin - words.first[words.row[begin]]).astype(np.int32)),
                        pa.array([view[a:b] for a, b in zip(low[begin], high[stop - 1], strict=True)], pa.binary()),
                    ],
                    names=["mini", "doc_id", "sha", "begin", "packed"],
                )

    return pack


def _counter(window: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("mini",)):
            raw, at = buffers(table.column("packed").combine_chunks())
            ids = table.column("doc_id").to_numpy()
            mini = unsigned(table.column("mini").to_numpy())
            keys, rows, starts = [], [], []
            for first, last in chunks(at):
                words = Words(raw, at, first, last)
                start, value = words.windows(window)
                row = words.row[start]
                keys.append(mix(value ^ mix(mini[first + row])))
                rows.append(row + first)
                starts.append(start - words.first[row])
            if not keys:
                continue
            key, row, start = np.concatenate(keys), np.concatenate(rows), np.concatenate(starts)
            # Sorted windows: a run of equal ones is one word sequence.
            order = np.argsort(key, kind="stable")
            run = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1]))) if len(key) else order
            if not len(run):
                continue
            least = np.repeat(np.minimum.reduceat(ids[row[order]], run), np.diff(np.append(run, len(order))))
            later = np.zeros(len(key), dtype=bool)
            later[order] = ids[row[order]] > least
            row, start = row[later], start[later]
            if not len(row):
                continue
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
            first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(row)) - 1
            owner = pa.array(row[first])
            base = table.column("begin").to_numpy()[row[first]]
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks().take(owner),
                    table.column("sha").combine_chunks().take(owner),
                    pa.array((base + start[first]).astype(np.int32)),
                    pa.array((base + start[last] + window).astype(np.int32)),
                ],
                names=["doc_id", "sha", "begin", "stop"],
            )

    return count


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    k: int = K,
    hot_places: int = repeats.HOT_PLACES,
) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept_sha256, spans (begin, stop) of removed words.

    Words are runs of anything but ASCII white space. Null and empty texts have no words; texts
    under ``window`` words lose none. Rows of equal id never remove each other's words, so the
    first id keeps a passage in all its rows; a row of null id neither removes nor loses words.
    Repetition inside one document alone removes nothing. Other columns are not read.
    """
    found = repeats.candidates(docs, id_col, text_col, window, k, hot_places)
    travelling = found.texts.mapInArrow(_packer(window, k, hot_places), _SUPER).repartition("mini").sortWithinPartitions("mini")
    spans = travelling.mapInArrow(_counter(window), repeats.SPANS)
    if found.hot:
        spans = spans.unionByName(repeats.hot_spans(found.texts, window, k, hot_places))
    return repeats.finished(found, spans)
