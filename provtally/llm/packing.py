"""Packing token ids into training windows by online sum-of-squares placement.

Every task packs the documents of its own partition, so nothing is shuffled. A document is its ids
and an end id. Runs of a whole window go out at once; what is left is placed by the sum-of-squares
rule: of all fill levels with an open window, and the empty one, take the level after which the
squared numbers of windows at each partial level add up to least. A level array holds those numbers.
A level that is a power of two needs no padding, so it counts nothing in the sum. When the
input ends, or more windows are open than a task may hold, the fullest windows are filled up with
ids cut from the emptiest, and the one that stays is cut into powers of two: nothing is padded.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

WINDOW, END_ID = 1024, 0
#: Windows that a task holds open; with their ids some 4 kB each.
MOST_OPEN = 8192
#: Characters of a text that are encoded at once.
SLICE_CHARS = 1 << 20
#: Bytes of ids in a batch of results.
BATCH_BYTES = 1 << 23

# Fixed value: how byte-level vocabularies cut a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# No token of that pattern reaches over one blank between two signs.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _bytes_of_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids as the tokenizers library gives them for a byte-level BPE file, special tokens being ordinary text."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"] for t in model["added_tokens"]}
        signs = _bytes_of_signs()
        vocabulary = model["model"]["vocab"]
        ranks = {bytes(map(signs.__getitem__, t)): i for t, i in vocabulary.items() if t not in special}
        # Ids of such a vocabulary are in order of merging, so they serve as ranks.
        self.fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    @cache  # noqa: B019  one encoder a worker
    def slow(self) -> Tokenizer:
        made = Tokenizer.from_file(self.path)
        made.encode_special_tokens = True
        return made

    def _slice(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        except Exception:  # the regex engine gives up on very long runs of blanks
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= SLICE_CHARS:
            return self._slice(text)
        parts, begin = [], 0
        while begin < len(text):
            cut = _CUT.search(text, begin + SLICE_CHARS) if begin + SLICE_CHARS < len(text) else None
            end = cut.start() if cut else len(text)
            parts.append(self._slice(text[begin:end]))
            begin = end
        return np.concatenate(parts)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Window:
    """Pieces of documents that share a sequence."""

    __slots__ = ("fill", "pieces")

    def __init__(self) -> None:
        self.fill, self.pieces = 0, []

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.fill += len(piece[2])

    def take(self, most: int) -> tuple:
        """Cut up to so many ids off the end."""
        doc, start, ids, total = self.pieces.pop()
        cut = max(0, len(ids) - most)
        if cut:
            self.pieces.append((doc, start, ids[:cut], total))
        self.fill -= len(ids) - cut
        return (doc, start + cut, ids[cut:], total)


class Packer:
    """Places pieces (document, start, ids, ids of the document) and hands out windows that are done.

    ``count[h]`` is the number of open windows of fill h, the level array of the rule.
    """

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN):
        self.window, self.most_open = window, most_open
        level = np.arange(window + 1)
        self.weight = ((level & (level - 1)) != 0) & (level < window)
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[Window]] = [[] for _ in range(window)]
        self.held = 0

    def level(self, size: int) -> int:
        """The fill level to place so many ids on; the fullest of equals."""
        after = self.window - size + 1
        gain = np.where(self.weight[:after], 1 - 2 * self.count[:after], 0)
        loss = np.where(self.weight[size:], 1 + 2 * self.count[size:], 0)
        change = np.where(self.count[:after] > 0, gain + loss, np.iinfo(np.int64).max)
        change[0] = loss[0]
        return after - 1 - int(np.argmin(change[::-1]))

    def place(self, piece: tuple) -> Iterator[Window]:
        size = len(piece[2])
        level = self.level(size)
        if level:
            found = self.open[level].pop()
            self.count[level] -= 1
            self.held -= 1
        else:
            found = Window()
        found.add(piece)
        yield from self._keep(found)
        if self.held > self.most_open:
            yield from self.flush(last=False)

    def _keep(self, found: Window) -> Iterator[Window]:
        if found.fill == self.window:
            yield found
        else:
            self.open[found.fill].append(found)
            self.count[found.fill] += 1
            self.held += 1

    def add(self, doc: object, ids: np.ndarray) -> Iterator[Window]:
        """Whole windows of a document, and windows that its rest completes."""
        n, total = len(ids) // self.window * self.window, len(ids)
        for start in range(0, n, self.window):
            whole = Window()
            whole.add((doc, start, ids[start : start + self.window], total))
            yield whole
        if n < total:
            yield from self.place((doc, n, ids[n:], total))

    def flush(self, last: bool = True) -> Iterator[Window]:
        """Close open windows without padding: the fullest are filled from the emptiest, the last is cut into powers of two."""
        partial = [w for level in range(self.window) if self.weight[level] for w in self.open[level]]
        yield from (w for level in range(self.window) if not self.weight[level] for w in self.open[level])
        self.open = [[] for _ in range(self.window)]
        self.count[:] = 0
        self.held = 0
        low, high = 0, len(partial) - 1
        while low < high:
            full, empty = partial[high], partial[low]
            while full.fill < self.window and empty.fill:
                full.add(empty.take(self.window - full.fill))
            if not empty.fill:
                low += 1
            if full.fill == self.window:
                yield full
                high -= 1
        if low == high:
            if last:
                yield from self._powers(partial[low])
            else:
                yield from self._keep(partial[low])

    def _powers(self, rest: Window) -> Iterator[Window]:
        for bit in range(self.window.bit_length()):
            if rest.fill >> bit & 1:
                part = Window()
                while part.fill < 1 << bit:
                    part.add(rest.take((1 << bit) - part.fill))
                yield part


def _packing(path: str, end_id: int, window: int, most_open: int, kind: pa.DataType):
    schema = pa.schema(
        [("doc_id", kind), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
        + [("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = encoder(path), Packer(window, most_open)
        sequence = TaskContext.get().partitionId() << 33
        rows, size = [], 0

        def done(windows: Iterator[Window]) -> None:
            nonlocal sequence, size
            for w in windows:
                offset = 0
                for doc, start, ids, total in w.pieces:
                    rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total, sequence, offset))
                    offset += len(ids)
                sequence += 1
                size += 4 * offset

        def out() -> pa.RecordBatch:
            nonlocal rows, size
            arrays = [pa.array(list(column), field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)]
            rows, size = [], 0
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            docs, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                ids = np.append(own.encode(texts[i].as_py() or ""), np.uint32(end_id))
                done(packer.add(docs[i].as_py(), ids))
                if size >= BATCH_BYTES:
                    yield out()
        done(packer.flush())
        if rows:
            yield out()

    return run


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` ids: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``path`` names a byte-level BPE file of the tokenizers library on every worker. A document is the
    ids of its whole text, special tokens being ordinary text, then ``end_id``; a null or empty text
    is the end id alone, and rows of one doc_id, or of none, are documents of their own. ``ids`` are
    little-endian unsigned 32-bit. A document of more than a window is cut after each window; others
    are cut only where open windows are filled up. Sequences hold a whole window or, at the end of a
    partition, a power of two of ids. An empty table has no pieces; other columns are not read. Rows
    are packed in the order and partitions they come in, so another partitioning packs differently.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind)
    if arrow is None:
        source, kind, arrow = source.withColumn("doc_id", F.col("doc_id").cast("string")), "string", pa.string()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return source.mapInArrow(_packing(path, end_id, window, most_open, arrow), schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """Each sequence whole: sequence_id, n_pieces, n_tokens and its ids; a sequence has no more pieces than ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    grouped = pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_tokens"))
    return grouped.select("sequence_id", F.size("parts").alias("n_pieces"), "n_tokens", joined.alias("ids"))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
