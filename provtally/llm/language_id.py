"""Language identification by error-correcting output codes over character n-grams.

Each language has a codeword. For every bit one binary classifier, the log odds of hashed
character bigrams and trigrams between the languages with the bit set and those without, says how
far a text leans to either side. Decoding sums a loss per bit, weighted by how well the bit
separates the training texts, and takes the nearest codeword; a close second is flagged.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provtally.llm.byte_bpe import E as LETTER_E
from provtally.llm.byte_bpe import ENDS, LETTER, R, codepoint_classes

BUCKETS = 1 << 13
UNKNOWN = "und"
#: Below this score the second codeword is too near.
AMBIGUOUS_BELOW = 0.6
_CHUNK = 1 << 17


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """Lower-case letter of each codepoint, or 0 for anything but letters."""
    kinds = codepoint_classes()
    letters = np.flatnonzero((kinds == LETTER) | (kinds == ENDS) | ((kinds >= R) & (kinds <= LETTER_E)))
    out = np.zeros(0x110001, dtype=np.uint32)
    out[letters] = letters
    for c in letters:
        text = chr(c)
        if unicodedata.category(text) in ("Lu", "Lt"):
            out[c] = ord(text.lower()[0])
    return out


def codewords(k: int) -> np.ndarray:
    """k rows of +1 and -1: all splits of up to five classes, else rows of a Hadamard matrix."""
    if k <= 5:
        bits = max(1, 2 ** (k - 1) - 1)
        sides = [[1 if c == 0 or (b >> (c - 1)) & 1 == 0 else -1 for b in range(1, bits + 1)] for c in range(k)]
        return np.array(sides, dtype=np.float64).reshape(k, bits)
    size = 1
    while size < max(k, 16):
        size *= 2
    code = np.ones((1, 1))
    while len(code) < size:
        code = np.block([[code, code], [code, -code]])
    return code[:k, 1:]


def _grams(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of texts: row range, buckets of bigrams and trigrams around letters, row of each, letters per row."""
    first, n = 0, len(texts)
    while first < n:
        last, held = first, 0
        while last < n and (last == first or held + len(texts[last]) <= _CHUNK):
            held += len(texts[last]) + 2
            last += 1
        part = texts[first:last]
        # A sign before the first text, so that every letter of every text is a centre; a gram is of its centre's row.
        codes = np.frombuffer(("\0" + "\0\0".join([*part, "\0"])).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = folded().take(codes)
        sizes = np.array([len(t) + 2 for t in part])
        row = np.repeat(np.arange(len(part)), sizes)
        a, b, c = letter[:-2], letter[1:-1], letter[2:]
        known = b > 0
        pair = (a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D)
        triple = (pair ^ c * np.uint32(0x27D4EB2F)) * np.uint32(0x165667B1)
        shift = np.uint32(32 - BUCKETS.bit_length() + 1)
        letters = np.add.reduceat(known.astype(np.int64), np.cumsum(sizes) - sizes) if len(row) else sizes * 0
        grams = np.stack((pair >> shift, (triple >> shift) + np.uint32(BUCKETS)))[:, known]
        yield first, last, grams, row[known], letters
        first = last


def _counter(languages: list[str]) -> Callable:
    index = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), 2 * BUCKETS), dtype=np.int64)
        for batch in batches:
            kinds = np.array([index[x] for x in batch.column(1).to_pylist()])
            for first, last, grams, row, _ in _grams(batch.column(0).to_pylist()):
                flat = (kinds[first:last][row] * (2 * BUCKETS) + grams).ravel()
                total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        kind, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[kind, bucket])],
            names=["kind", "bucket", "n"],
        )

    return count


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    odds: np.ndarray
    scale: np.ndarray

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score in 0..1 and ambiguity of each text."""
        names: list[str] = []
        scores: list[np.ndarray] = []
        for first, last, grams, row, letters in _grams(texts):
            n = last - first
            lean = np.zeros((n, self.odds.shape[1]))
            if len(row):
                gained = self.odds.take(grams[0], axis=0)
                gained += self.odds.take(grams[1], axis=0)
                edge = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                lean[row[edge]] = np.add.reduceat(gained, edge, axis=0) / np.diff(np.append(edge, len(row)))[:, None]
            margin = np.clip(lean / self.scale, -3, 3)
            weight = self.scale / self.scale.sum()
            loss = np.stack([(weight * np.log1p(np.exp(-2 * margin * word))).sum(axis=1) for word in self.code], axis=1)
            share = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
            best = loss.argmin(axis=1)
            sure = np.where(letters > 0, 1 / share.sum(axis=1), 0.0)
            names += [self.languages[b] if m else UNKNOWN for b, m in zip(best, letters > 0, strict=True)]
            scores.append(sure)
        score = np.concatenate(scores) if scores else np.zeros(0)
        return names, score, score < AMBIGUOUS_BELOW


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learn from all labelled rows; None if there are none.

    n-gram counts per language come from a distributed aggregate of at most languages x 2 BUCKETS
    rows, so what reaches the driver does not grow with the texts.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return None
    counts = rows.mapInArrow(_counter(languages), "kind int, bucket int, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n"))
    seen = counts.toPandas()
    table = np.full((len(languages), 2 * BUCKETS), 0.5)
    table[seen["kind"].to_numpy(), seen["bucket"].to_numpy()] += seen["n"].to_numpy()
    # Bigrams and trigrams are two distributions; every language weighs the same in a bit.
    share = np.concatenate([x / x.sum(axis=1, keepdims=True) for x in (table[:, :BUCKETS], table[:, BUCKETS:])], axis=1)
    code = codewords(len(languages))
    odds = np.zeros((2 * BUCKETS, code.shape[1]))
    for bit in range(code.shape[1]):
        plus, minus = code[:, bit] > 0, code[:, bit] < 0
        if plus.any() and minus.any():
            odds[:, bit] = np.log(share[plus].mean(axis=0)) - np.log(share[minus].mean(axis=0))
    # A bit's scale is how far texts of a language lean on average.
    scale = np.maximum(np.abs(share @ odds).mean(axis=0), 1e-6)
    return Model(languages, code, odds.astype(np.float32), scale)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score and ambiguous; only the text is an input.

    Null texts and texts without a letter are ``und`` with score 0, as is everything without a
    model. New columns replace columns of the same names; docs should carry few others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "score", "ambiguous")
    names = [c for c in kept.columns if c != text_col]
    kept = kept.select(*names, F.col(text_col).cast("string").alias(text_col))
    schema = kept.select(*names).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(len(names)).to_pylist()]
            if own is None:
                lang, score, unsure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            else:
                lang, score, unsure = own.decide(texts)
            out = [*batch.columns[: len(names)], pa.array(lang, pa.string()), pa.array(score), pa.array(unsure)]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return kept.mapInArrow(run, schema)


def document_languages(docs: DataFrame) -> DataFrame:
    """Learn from three quarters of the labelled documents, predict all; held_out marks the last quarter."""
    held = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
    model = fit(docs.where(~held))
    rows = docs.select(F.col("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return predict(rows, model)
