"""Bytes and texts of JSON documents as values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(content: Column) -> Column:
    """A document's bytes as a variant; null when they are not JSON."""
    return parsed_text(text_of(content))


def text_of(content: Column) -> Column:
    """A document's bytes as text, without a mark of byte order."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "\\A\\x{FEFF}", "")


def parsed_text(text: Column) -> Column:
    """A text as a variant; null unless it is one JSON value and nothing else.

    The parser stops after the first value, so what follows it is caught by wrapping the text:
    a rest would have to close or continue a list and an object alike. The wrapped texts are only
    scanned, not built up.
    """
    in_list = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.json_object_keys(F.concat(F.lit('{"value":'), text, F.lit("}")))
    return F.when((in_list == 1) & in_object.isNotNull(), F.try_parse_json(text))
