"""Quality rules as a short-circuit cascade.

On a sample, drawn by a hash of the id, each rule's rejection rate and cost are estimated, cost as work on
characters and words; rules are ordered by rejection per cost and tried in that order until one rejects. The
order decides what is computed for a rejected text, never the verdict.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provtally.llm.common import WORD

GRAM = 5
SYMBOLS = "[#*$%&|<>]"
#: Expected rows that costs and selectivities are estimated on; they only set the order of the rules.
SAMPLE_ROWS = 1000


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)


def symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def gram_hashes(tokens: Column, n: int = GRAM) -> Column:
    """Hashes of all runs of n words."""
    starts = F.sequence(F.lit(1), F.size(tokens) - n + 1)
    grams = F.transform(starts, lambda i: F.xxhash64(*[F.element_at(tokens, i + j) for j in range(n)]))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<bigint>"))


def covered(hashes: Column, n: int = GRAM) -> Column:
    """Words inside the runs that occur twice or more.

    Runs are sorted by hash with their places; equal neighbours are repeated. Their places in order
    cover n words each, less what the run before covers already.
    """
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    size = F.size(hashes)

    def found(runs: Column) -> Column:
        def place(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(runs, i - 1)["h"] == x["h"])
            after = F.when(i + 1 < size, F.get(runs, i + 1)["h"] == x["h"])
            return F.when(F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False)), x["i"])

        return F.sort_array(F.array_compact(F.transform(runs, place)))

    def total(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, i: F.when(i > 0, F.least(F.lit(n), p - F.get(places, i - 1))).otherwise(F.lit(n))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    some = _let(_let(placed, found), total)
    return F.when(F.size(F.array_distinct(hashes)) == size, F.lit(0).cast("long")).otherwise(some)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once per row, wherever the optimizer moves the expression."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def signals(text: Column, tokens: Column) -> dict[str, Column]:
    """The rules' inputs, each an expression that costs nothing where it is not evaluated."""
    return {
        "n_words": F.size(tokens).cast("long"),
        "word_chars": F.char_length(F.array_join(tokens, "")).cast("long"),
        "n_symbols": symbols(text),
        "n_dup_lines": repeated_lines(text),
        "n_lines": F.size(F.split(text, "\n", -1)).cast("long"),
        "n_repeat_words": _let(gram_hashes(tokens), covered),
    }


@dataclass(frozen=True)
class Rule:
    """fails: of the signals, true for a text to reject; its work per character and per word."""

    name: str
    fails: Callable[[Mapping[str, Column]], Column]
    per_char: float
    per_word: float


#: The base rules, then those of this method: many symbols, repeated lines, odd word lengths.
RULES = (
    Rule("too_short", lambda s: s["n_words"] < 10, 0.0, 1.0),
    Rule("repeated_words", lambda s: s["n_repeat_words"] * 100 > s["n_words"] * 20, 0.0, 12.0),
    Rule("symbols", lambda s: s["n_symbols"] * 100 > s["n_words"] * 30, 1.0, 0.0),
    Rule("repeated_lines", lambda s: s["n_dup_lines"] * 100 > s["n_lines"] * 50, 0.5, 0.0),
    Rule("short_words", lambda s: s["word_chars"] < s["n_words"] * 2, 0.0, 0.5),
    Rule("long_words", lambda s: s["word_chars"] > s["n_words"] * 20, 0.0, 0.5),
)


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def first_failure(cascade: Sequence[Rule], given: Mapping[str, Column]) -> Column:
    """Name of the first rule that rejects, or null; later rules are not evaluated then."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(cascade):
        verdict = F.when(rule.fails(given), F.lit(rule.name)).otherwise(verdict)
    return verdict


def verdict(cascade: Sequence[Rule], text_col: str = "text") -> Column:
    """The cascade over a text column: the first rule that rejects, or null."""
    text = _text(text_col)
    return _let(words(text), lambda tokens: first_failure(cascade, signals(text, tokens)))


def _measured(docs: DataFrame, text_col: str) -> DataFrame:
    text = _text(text_col)
    fields = _let(words(text), lambda tokens: F.struct(*[c.alias(n) for n, c in signals(text, tokens).items()]))
    return docs.withColumn("_signals", fields)


_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    """Rules by rejection per cost on a sample of some SAMPLE_ROWS rows; ties keep their order.

    The sample is the rows whose hash of id and length falls below a share of all rows, so it is the same on every run;
    its texts are measured where they are and only sums leave a task.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64(F.col("id").cast("string"), F.char_length("text")), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = _measured(rows.where(drawn).select("text"), "text")
    given = {n: F.col("_signals")[n] for n in _FIELDS}
    row = sample.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.char_length(_text("text"))).alias("chars"),
        F.avg(given["n_words"]).alias("words"),
        *[F.sum(r.fails(given).cast("int")).alias(f"fails_{i}") for i, r in enumerate(rules)],
    ).first()
    if not row["rows"]:
        return list(rules)

    def worth(i: int) -> float:
        cost = 1.0 + rules[i].per_char * row["chars"] + rules[i].per_word * row["words"]
        return (row[f"fails_{i}"] or 0) / row["rows"] / cost

    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-worth(i), i))]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, rejected_by.

    Null, empty and blank texts have no words and fail. rejected_by depends on the sample's order
    of rules, kept does not. Other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cascade = ordered(source)
    given = {n: F.col("_signals")[n] for n in _FIELDS}
    base = RULES[0].fails(given) | RULES[1].fails(given)
    rejected = first_failure(cascade, given)
    columns = [given[n].alias(n) for n in _FIELDS if n != "n_lines"]
    return _measured(source, "text").select(
        "doc_id", *columns, base.alias("base_failed"), rejected.isNull().alias("kept"), rejected.alias("rejected_by")
    )


def passing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that no rule rejects, with docs' columns; a rejected text costs no further rules."""
    return docs.where(verdict(ordered(docs, id_col=id_col, text_col=text_col), text_col).isNull())
