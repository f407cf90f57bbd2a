"""Byte-level BPE over text columns, with vectorised pre-tokenisation.

A text is an array of codepoint classes. The automaton that tells where pre-tokens begin is a
transition function per class; since functions compose associatively, blocks of the text are
composed independently, the block functions are scanned, and every state follows. Boundaries are
then local comparisons of neighbouring states. The slices feed pair merging behind a cache.

The pre-tokens are those of the pattern that the rank files are published with: a contraction
('s 't 're 've 'm 'll 'd), or runs of letters, of numbers, or of other signs, each with one space
before it if there is one, or white space, which leaves its last character to what follows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters and numbers of Unicode 16 that older character tables lack.
NEWER_LETTERS = (
    (0x01C89, 0x01C8A), (0x0A7CB, 0x0A7CD), (0x0A7DA, 0x0A7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
NEWER_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
# The characters with the Unicode property White_Space.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

# Classes of a character. Letters that can follow an apostrophe in a contraction have their own.
SPACE, WHITE, LETTER, NUMBER, OTHER, APOSTROPHE, ENDS, R, V, L, E, BREAK = range(12)
# States after a character: what it belongs to.
AT_BREAK, IN_SPACE, IN_WHITE, IN_LETTERS, IN_NUMBERS, IN_OTHER, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, CONTRACTED = range(11)
# What a state means for the next one: an apostrophe may start a pre-token or not, or one is pending.
FREE, BOUND, PENDING, PENDING_R, PENDING_V, PENDING_L = range(6)
MEANS = np.array([FREE, BOUND, FREE, FREE, FREE, BOUND, PENDING, PENDING_R, PENDING_V, PENDING_L, FREE])
_BLOCK = 64
CHUNK_CHARS = 1 << 18
NO_RANK = 1 << 60
CACHE_ENTRIES, CACHE_LENGTH = 200_000, 64


@lru_cache(maxsize=1)
def codepoint_classes() -> np.ndarray:
    """The class of every codepoint, and of the break between texts at 0x110000."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)] + [BREAK], dtype=np.uint8)
    for ranges, kind in ((NEWER_LETTERS, LETTER), (NEWER_NUMBERS, NUMBER)):
        for low, high in ranges:
            out[low : high + 1] = kind
    out[list(WHITE_SPACE)] = WHITE
    for text, kind in ((" ", SPACE), ("'", APOSTROPHE), ("stmd", ENDS), ("r", R), ("v", V), ("l", L), ("e", E)):
        for c in text:
            out[ord(c)] = kind
    return out


@lru_cache(maxsize=1)
def transitions() -> np.ndarray:
    """next state[class, meaning of the state before]."""
    plain = {SPACE: IN_SPACE, WHITE: IN_WHITE, NUMBER: IN_NUMBERS, OTHER: IN_OTHER, APOSTROPHE: IN_OTHER, BREAK: AT_BREAK}
    out = np.empty((12, 6), dtype=np.int64)
    for kind in range(12):
        out[kind] = plain.get(kind, IN_LETTERS)
    # An apostrophe starts a pre-token of its own except in a run of signs or after the space it takes.
    out[APOSTROPHE, [FREE, PENDING_R, PENDING_V, PENDING_L]] = QUOTE
    out[ENDS, PENDING] = CONTRACTED
    out[R, PENDING], out[V, PENDING], out[L, PENDING] = QUOTE_R, QUOTE_V, QUOTE_L
    out[E, PENDING_R] = out[E, PENDING_V] = out[L, PENDING_L] = CONTRACTED
    return out


def states(kinds: np.ndarray) -> np.ndarray:
    """The state after each character, from AT_BREAK, by composing transition functions block-wise."""
    n = len(kinds)
    blocks = -(-n // _BLOCK)
    padded = np.full(blocks * _BLOCK, BREAK, dtype=np.uint8)
    padded[:n] = kinds
    steps = padded.reshape(blocks, _BLOCK).T.astype(np.int64) * 6
    table = transitions().ravel()
    means = MEANS.take(table)
    # Every block's function: what each meaning at its start leads to.
    block = np.broadcast_to(np.arange(6), (blocks, 6))
    for step in steps:
        block = means.take(step[:, None] + block)
    # Inclusive scan of the functions: after round i each covers 2**i blocks.
    reach = 1
    while reach < blocks:
        later = np.take_along_axis(block[reach:], block[:-reach], axis=1)
        block = np.concatenate((block[:reach], later))
        reach *= 2
    held = np.concatenate(([FREE], block[:-1, FREE]))
    out = np.empty((_BLOCK, blocks), dtype=np.uint8)
    for i, step in enumerate(steps):
        at = step + held
        out[i] = table.take(at)
        held = means.take(at)
    return out.T.ravel()[:n]


def boundaries(codes: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in an array of codepoints; 0x110000 stands for a break between texts."""
    kinds = codepoint_classes().take(codes)
    n = len(kinds)
    after = states(kinds)
    before = np.concatenate(([np.uint8(AT_BREAK)], after[:-1]))
    following = np.concatenate((kinds[1:], [np.uint8(BREAK)]))
    ahead = np.concatenate((after[1:], [np.uint8(AT_BREAK)]))
    white, white_before = kinds <= WHITE, (before == IN_SPACE) | (before == IN_WHITE)
    white_next, end_next = following <= WHITE, following == BREAK
    start = np.zeros(n, dtype=bool)
    # White space: at its first character, and at its last when something follows.
    start |= white & (~white_before | (~white_next & ~end_next))
    # Anything else after white space starts anew unless that was a space, which it takes.
    start |= ~white & (before == IN_WHITE)
    solid = ~white & ~white_before
    # A pending letter stays with its apostrophe only if the contraction completes.
    pending = (after >= QUOTE_R) & (after <= QUOTE_L)
    held = pending & (ahead == CONTRACTED)
    done = after == CONTRACTED
    group = np.array([0, 1, 1, 2, 3, 4, 4, 2, 2, 2, 5], dtype=np.uint8)
    changed = group.take(after) != group.take(before)
    start |= solid & changed & ~held & ~done
    start |= solid & (pending & ~held)
    start |= (after == QUOTE) | ((before == AT_BREAK) & (kinds != BREAK))
    start[kinds == BREAK] = True
    return np.flatnonzero(start)


class Codec:
    """Ranks of byte strings, and the merges that follow from them."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.decimals = {rank: str(rank) for rank in self.tokens}
        # Two generations: what was used since the last turn survives the next.
        self.cache: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Join the adjacent pair of least rank, leftmost first, until none is left."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        if n > CACHE_LENGTH:
            return self._merge_long(piece)
        get = ranks.get
        cut = list(range(n + 1))
        pairs = [get(piece[i : i + 2], NO_RANK) for i in range(n - 1)]
        while pairs and (least := min(pairs)) != NO_RANK:
            i = pairs.index(least)
            del cut[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(piece[cut[i] : cut[i + 2]], NO_RANK)
            if i:
                pairs[i - 1] = get(piece[cut[i - 1] : cut[i + 1]], NO_RANK)
        return tuple([ranks[piece[a:b]] for a, b in pairwise(cut)])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap and linked parts, so that very long pieces stay near linear."""
        ranks, n = self.ranks, len(piece)
        stop, prior, follow = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\x01" * n)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = follow[i] if alive[i] else n
            if j >= n or stop[j] != end:
                continue
            alive[j] = 0
            stop[i], follow[i] = end, follow[j]
            if follow[i] < n:
                prior[follow[i]] = i
                if (r := ranks.get(piece[i : stop[follow[i]]])) is not None:
                    heapq.heappush(heap, (r, i, stop[follow[i]]))
            if (h := prior[i]) >= 0 and (r := ranks.get(piece[h : stop[i]])) is not None:
                heapq.heappush(heap, (r, h, stop[i]))
        return tuple(ranks[piece[i : stop[i]]] for i in range(n) if alive[i])

    def _missing(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word) or self.merge(word.encode("utf-8", "surrogatepass"))
        if len(word) <= CACHE_LENGTH:
            if len(self.cache) >= CACHE_ENTRIES:
                self.older = self.cache
                self.cache = {}
            self.cache[word] = ids
        return ids

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Token ids of each text."""
        for first, last in _groups(texts):
            joined = "\0".join(texts[first:last])
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            ends = np.cumsum([len(t) + 1 for t in texts[first:last]])[:-1] - 1
            if len(ends):
                codes = codes.copy()
                codes[ends] = 0x110000
            begin = boundaries(codes) if len(codes) else np.zeros(0, dtype=np.int64)
            stop = np.append(begin[1:], len(codes))
            # The breaks are pre-tokens of their own here; each text's lie between two of them.
            at = np.searchsorted(begin, np.concatenate(([-1], ends, [len(codes)])))
            words = [joined[a:b] for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
            missing = self._missing
            for i in range(last - first):
                get = self.cache.get
                own = words[at[i] + (i > 0) : at[i + 1]]
                yield list(chain.from_iterable([get(w) or missing(w) for w in own]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def offsets(self, ids: list[int]) -> list[int]:
        """Byte offset at which each token begins."""
        sizes = [len(self.tokens[i]) for i in ids]
        return (np.cumsum(sizes) - sizes).tolist() if sizes else []


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, held = 0, 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > CHUNK_CHARS:
            yield first, i
            first, held = i, 0
        held += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and rank file."""
    return Codec(path)


def _texts(column: pa.Array, first: int, last: int) -> list[str]:
    return [t or "" for t in column.slice(first, last - first).to_pylist()]


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    step = 512
    for first in range(0, len(column), step):
        yield first, min(first + step, len(column))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and the byte offset of each token; a null or empty text has none. One row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for first, last in _slices(batch.column(1)):
                ids = list(own.encode(_texts(batch.column(1), first, last)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([own.offsets(x) for x in ids], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "ids", "offsets"],
                )

    source = _source(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<bigint>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the bytes that the ids stand for; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            data = [own.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    source = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, data binary")


def _digester(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for first, last in _slices(batch.column(1)):
                counts, ids_sha, data_sha = [], [], []
                for ids in own.encode(_texts(batch.column(1), first, last)):
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(" ".join(map(own.decimals.__getitem__, ids)).encode()).hexdigest())
                    data_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(data_sha)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text and decode its ids in one pass, without moving the ids out of the worker.

    Returns doc_id, n_tokens, ids_sha256 (decimal ids joined by one space) and decoded_sha256. A
    null or empty text has no tokens and both digests are those of no bytes. One row per row.
    """
    source = _source(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_digester(path), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
