"""Identifier grammar, pseudonymous keys, digests and leak scanning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provtally.functions.sql import exploded

# Identifier and digest shapes.
VIDEO_ID = r"\A[A-Za-z0-9_-]{11}\z"
PUBLIC_KEY = r"\Apk_[A-Za-z0-9_-]{8,64}\z"
RAW_CHANNEL_PREFIX = r"(?i)\Apk_UC"
DIGEST = r"\Asha256:[a-f0-9]{64}\z"
# A free-standing run of identifier characters: 11 of them, or UC and 22 more.
LEAKED_TOKEN = r"(?<![\w-])(?:UC[\w-]{22}|[\w-]{11})(?![\w-])"
VIDEO_TOKEN_LENGTH = 11
CHANNEL_TOKEN_LENGTH = 24


def is_video_id(value: Column) -> Column:
    """True when the whole value follows the video identifier grammar."""
    return F.coalesce(value.rlike(VIDEO_ID), F.lit(False))


def public_channel_key(channel_id: Column, salt: str) -> Column:
    """Pseudonym of a channel: stable for one salt, never containing the raw id."""
    hashed = F.sha2(F.concat(F.lit(salt), channel_id.cast("string")), 256)
    return F.concat(F.lit("pk_"), F.substring(hashed, 1, 32))


def is_public_channel_key(value: Column) -> Column:
    return value.rlike(PUBLIC_KEY) & ~value.rlike(RAW_CHANNEL_PREFIX)


def digest_of(content: Column) -> Column:
    """``sha256:<hex>`` of raw bytes (or of a string's UTF-8 bytes)."""
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def short_digest(digest: Column) -> Column:
    return F.substring(F.regexp_replace(digest, "sha256:", ""), 1, 12)


def leaked_tokens(text: Column) -> Column:
    """Array of raw video or channel identifiers standing free in a text, repeats kept."""
    return F.regexp_extract_all(text, F.lit(LEAKED_TOKEN), F.lit(0))


def leak_scan(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per leaked token: its kind, how often it occurs and in how many texts."""
    tokens = exploded(texts, leaked_tokens(F.col(text_col)), "token", F.col(id_col).alias("text_id"))
    kind = F.when(F.length("token") == VIDEO_TOKEN_LENGTH, "video").otherwise("channel")
    # Two steps, so a token found in very many texts is reduced per text before it is grouped alone.
    per_text = tokens.groupBy("token", "text_id").agg(F.count("*").alias("n"))
    return (
        per_text.groupBy("token")
        .agg(F.sum("n").alias("occurrences"), F.count("*").alias("texts"))
        .select(kind.alias("kind"), "token", "occurrences", "texts")
    )
