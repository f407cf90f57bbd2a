"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered in a fixed order, so a row's number does not depend on files or partitions. A
Feistel network permutes the numbers below a power of two; numbers that leave the range walk on
along their cycle until they return, which makes it a permutation of exactly 0..n-1. The permuted
number gives shard and slot by division, and both can be computed, or inverted, without the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provtally.llm.common import numbered
from provtally.llm.words import mix, mixed

ROUNDS = 6


@dataclass(frozen=True)
class Permutation:
    """A seeded permutation of 0..n-1 and its inverse."""

    n: int
    seed: int = 0

    @property
    def _bits(self) -> tuple[int, int]:
        """Bits of the two halves; together they number at most twice the rows."""
        bits = max(2, (self.n - 1).bit_length())
        return bits // 2, bits - bits // 2

    def _rounds(self, x: np.ndarray, backwards: bool) -> np.ndarray:
        """Each round adds to one half a keyed function of the other; halves take turns."""
        small, large = self._bits
        low = x & np.uint64((1 << small) - 1)
        high = x >> np.uint64(small)
        for i in range(ROUNDS - 1, -1, -1) if backwards else range(ROUNDS):
            key = mixed(self.seed * ROUNDS + i + 1)
            if i % 2:
                low ^= mix(high ^ key) & np.uint64((1 << small) - 1)
            else:
                high ^= mix(low ^ key) & np.uint64((1 << large) - 1)
        return (high << np.uint64(small)) | low

    def _walk(self, x: np.ndarray, backwards: bool) -> np.ndarray:
        out = self._rounds(x.astype(np.uint64), backwards)
        while len(outside := np.flatnonzero(out >= np.uint64(self.n))):
            out[outside] = self._rounds(out[outside], backwards)
        return out.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, backwards=False)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, backwards=True)

    def place(self, row: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Shard and slot of row numbers."""
        position = self.forward(row)
        return position % shards, position // shards

    def row(self, shard: np.ndarray, slot: np.ndarray, shards: int) -> np.ndarray:
        """Row number that holds a shard's slot."""
        return self.inverse(slot * shards + shard)


def shard_rows(df: DataFrame, order: list[str], shards: int = 8, seed: int = 0) -> DataFrame:
    """df with row_number, position, shard and slot; shards' counts are at most one apart, slots gapless from 0.

    ``order`` names columns that tell rows apart (nulls first); rows equal in all of them may swap
    places. An empty table gives no rows. Carry only what is needed: df is sorted once. New
    columns replace columns of the same names.
    """
    rows, total = numbered(df.drop("row_number", "position", "shard", "slot"), order)
    permutation = Permutation(total, seed)

    def position(numbers: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in numbers:
            yield pd.Series(permutation.forward(part.to_numpy()))

    permuted = F.pandas_udf(position, "long")
    return (
        rows.withColumn("position", permuted("row_number"))
        .withColumn("shard", F.pmod("position", F.lit(shards)).cast("int"))
        .withColumn("slot", F.expr(f"position div {int(shards)}"))
    )


def document_shards(docs: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """Shard and slot of each document row, with size and checksum of its text (null: empty)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
    )
    placed = shard_rows(rows, ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
