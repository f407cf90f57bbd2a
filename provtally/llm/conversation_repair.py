"""Repair of conversation structure with the cheapest audit trail (see audit_paths).

A conversation's rows meet in one task, in order, and are solved there. A conversation of more rows
than LONG is split: its rows are range-partitioned in order and cut into blocks, each block is solved
from every state the programme can be in, and only these summaries, one of 32 small numbers a block, are
chained. Repeats inside it are found by a map-side minimum of places. Only the digest of a
conversation is a sequence by definition; its lines stream through it one after another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provtally.llm import audit_paths
from provtally.llm.common import WORD, stored

#: Rows, and bytes of text, of a conversation that one task holds.
LONG, LONG_BYTES = 16_384, 1 << 25
#: Rows of a longer conversation that are solved at once; a power of two.
BLOCK = 8192
_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_LEGAL = {"su", "ua", "au"}
_LONGEST = (1 << 63) - 1
_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """conv_id, turn, role, text and present of rows damaged by the checksum of ``conv_id:turn`` modulo 20.

    0 drops a row (its conversation stays, by a row that is not present), 1 empties its text, 2 removes
    the signs . ! ? from it, 3 repeats it next to itself, 4 makes its role user. A null role or text, and a null in the
    checksum, is one space; the columns conv_id and turn keep their nulls.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.encode(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col)), "UTF-8")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    copies = F.when(kind == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(kind != 0))
    return rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"),
        F.when(kind != 0, text).otherwise("").alias("text"),
        F.explode(copies).alias("present"),
    )


def _initial(role: str) -> str:
    return role[:1] or " "


def _symbol(role: str, text: str) -> str:
    """The symbol of a row that is neither blank nor repeated."""
    own = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return own if text.rstrip(_BLANKS)[-1] in ".!?" else own.upper()


class _Held:
    """One conversation whose rows come in order."""

    def __init__(self, conv: object):
        self.conv, self.roles, self.texts, self.symbols = conv, [], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None
        self.seen: set[tuple[str, str]] = set()

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and (self.turns == 0 or turn != self.last):
            self.first, self.last, self.turns = turn if self.turns == 0 else self.first, turn, self.turns + 1
        if self.roles and _initial(self.roles[-1]) + _initial(role) not in _LEGAL:
            self.illegal += 1
        if not text.strip(_BLANKS):
            symbol, self.blank = "x", self.blank + 1
        elif (role, text) in self.seen:
            symbol, self.duplicate = "x", self.duplicate + 1
        else:
            symbol = _symbol(role, text)
            self.truncated += symbol.isupper()
        self.seen.add((role, text))
        self.roles.append(role)
        self.texts.append(text)
        self.symbols.append(symbol)

    def solved(self) -> tuple[int, str, list[tuple[int, str, str, str]]]:
        """Cost, edits, and the lines (place, role, text, edit) of the repaired conversation."""
        cost, letters = audit_paths.audit("".join(self.symbols))
        return cost, letters, list(_lines(letters, self.symbols, self.roles, self.texts))

    def counts(self) -> list[int]:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return [min(gaps, _LONGEST), self.blank, self.duplicate, self.truncated, self.illegal]


def _lines(
    letters: str, symbols: list[str], roles: list[str], texts: list[str], state: int = audit_paths.START
) -> Iterator[tuple[int, str, str, str]]:
    row = inserted = 0
    for letter in letters:
        symbol = "" if letter == "I" else symbols[row]
        state, role = audit_paths.follow(state, letter, symbol)
        if letter == "I":
            yield 3 * row + inserted, role, "", letter
            inserted += 1
            continue
        if letter != "D":
            yield 3 * row + 2, role or roles[row], texts[row], letter
        row, inserted = row + 1, 0


def _digest(lines: list[tuple[int, str, str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text, _ in lines).encode()).hexdigest()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[_Held]:
    """Conversations from rows (conv_id, turn, role, text, present) in their order."""
    held: _Held | None = None
    for batch in batches:
        for conv, turn, role, text, present in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held is None or held.conv != conv:
                if held is not None:
                    yield held
                held = _Held(conv)
            if present:
                held.add(turn, role, text)
    if held is not None:
        yield held


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _columns(kind: pa.DataType, *more: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema([("conv_id", kind), *more])


_NUMBERS = [(c.split()[0], pa.int64()) for c in _COUNTS.split(", ")]
_LINE = [("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]


def _auditing(kind: pa.DataType):
    schema = _columns(kind, *_NUMBERS, ("audit", pa.string()), ("repaired_sha256", pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for held in _whole(batches):
                cost, letters, lines = held.solved()
                yield (held.conv, *held.counts(), cost, letters, _digest(lines))

        yield from _batched(rows(), schema)

    return run


def _repairing(kind: pa.DataType):
    schema = _columns(kind, *_LINE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(((h.conv, *line) for h in _whole(batches) for line in h.solved()[2]), schema)

    return run


# Long conversations.


def _summing(kind: pa.DataType):
    numbers = pa.list_(pa.int32())
    schema = _columns(kind, ("block", pa.int64()), ("costs", numbers), ("places", numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield from _batched(((conv, block, *audit_paths.summary(symbols)) for conv, block, symbols in rows), schema)

    return run


def _chaining(kind: pa.DataType):
    """States before and after each block from summaries in the order of conversation and block."""
    schema = _columns(kind, ("block", pa.int64()), ("before", pa.int32()), ("after", pa.int32()), ("tail", pa.string()), ("cost", pa.int64()))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[int], list]]:
        conv, blocks, parts = None, [], []
        for batch in batches:
            for key, block, costs, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if blocks and key != conv:
                    yield conv, blocks, parts
                    blocks, parts = [], []
                conv = key
                blocks.append(block)
                parts.append((costs, places))
        if blocks:
            yield conv, blocks, parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv, blocks, parts in whole(batches):
                cost, states, tail = audit_paths.chain(parts)
                for i, block in enumerate(blocks):
                    last = i == len(blocks) - 1
                    yield conv, block, states[i], states[i + 1], tail if last else "", cost if last else 0

        yield from _batched(rows(), schema)

    return run


def _fragments(kind: pa.DataType):
    """The edits of each block, and for each row of it the state before and its own edits."""
    edits = pa.list_(pa.struct([("pos", pa.int64()), ("state", pa.int32()), ("edit", pa.string())]))
    schema = _columns(kind, ("block", pa.int64()), ("fragment", pa.string()), ("edits", edits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for conv, block, symbols, first, before, after, tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    letters = audit_paths.fragment(symbols, before, after)
                    found, state, row, own, at = [], before, 0, "", before
                    for letter in letters:
                        state, _ = audit_paths.follow(state, letter, "" if letter == "I" else symbols[row])
                        own += letter
                        if letter != "I":
                            found.append({"pos": first + row, "state": at, "edit": own})
                            row, own, at = row + 1, "", state
                    # Inserts at the end stand behind the last row.
                    found[-1]["edit"] += tail
                    yield conv, block, letters + tail, found

        yield from _batched(rows(), schema, 16)

    return run


def _long_lines(kind: pa.DataType):
    schema = _columns(kind, *_LINE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for conv, pos, role, text, symbol, state, edit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for place, own, line, letter in _lines(edit, [symbol], [role], [text], state):
                        yield conv, 5 * pos + place, own, line, letter

        yield from _batched(rows(), schema)

    return run


def _hashing(kind: pa.DataType):
    """The digest of each conversation from its lines in order, one at a time."""
    schema = _columns(kind, ("repaired_sha256", pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            conv = state = None
            for batch in batches:
                for key, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if state is None or key != conv:
                        if state is not None:
                            yield conv, state.hexdigest()
                        conv, state = key, hashlib.sha256()
                    else:
                        state.update(b"\n")
                    state.update(f"{role}:{text}".encode())
            if state is not None:
                yield conv, state.hexdigest()

        yield from _batched(rows(), schema)

    return run


def _null_safe(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join on keys that may be null; the right side's keys go."""
    named = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    return left.join(named, condition, how).drop(*[f"_{k}" for k in keys])


class _Long:
    """The rows of long conversations, placed in order, with their edits."""

    def __init__(self, rows: DataFrame, spark_kind: str, kind: pa.DataType, block: int):
        self.spark_kind, self.kind = spark_kind, kind
        head = F.substring("text", 1, 64)
        ordered = rows.repartitionByRange("conv_id", "turn", "role", head).sortWithinPartitions("conv_id", "turn", "role", "text")
        self.rows = stored(ordered.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "long-rows")
        firsts = self.rows.groupBy("conv_id", "role", F.sha2(F.encode("text", "UTF-8"), 256).alias("sha")).agg(F.min("pos").alias("pos"))
        fresh = firsts.select("pos", F.lit(True).alias("fresh"))
        blank = ~F.col("text").rlike(WORD)
        initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
        light = self.rows.select(
            "conv_id", "turn", "pos", blank.alias("blank"), initial.alias("initial"), F.rpad(F.substring("role", 1, 1), 1, " ").alias("first"),
            F.substring(F.expr(r"trim(TRAILING ' \t\n\u000B\u000C\r' FROM text)"), -1, 1).isin(".", "!", "?").alias("ends"),
        )
        flagged = light.join(fresh, "pos", "left")
        kept = ~F.col("blank") & F.col("fresh").isNotNull()
        symbol = F.when(~kept, "x").when(F.col("ends"), F.col("initial")).otherwise(F.upper("initial"))
        flagged = flagged.withColumn("symbol", symbol).withColumn("block", F.expr(f"pos div {block}"))
        self.flagged = stored(flagged.withColumn("repeated", ~F.col("blank") & F.col("fresh").isNull()), "long-flags")
        members = F.array_sort(F.collect_list(F.struct("pos", "symbol", "first")))
        blocks = self.flagged.groupBy("conv_id", "block").agg(members.alias("m"))
        self.blocks = stored(
            blocks.select(
                "conv_id", "block", F.array_join("m.symbol", "").alias("symbols"), F.array_join("m.first", "").alias("initials"), F.col("m")[0]["pos"].alias("pos")
            ),
            "long-blocks",
        )
        sums = self.blocks.select("conv_id", "block", "symbols").mapInArrow(
            _summing(kind), f"conv_id {spark_kind}, block long, costs array<int>, places array<int>"
        )
        chained = sums.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(
            _chaining(kind), f"conv_id {spark_kind}, block long, before int, after int, tail string, cost long"
        )
        self.chained = stored(chained, "long-chain")
        cut = _null_safe(self.blocks.drop("initials"), self.chained.drop("cost"), "conv_id", "block")
        cut = cut.select("conv_id", "block", "symbols", "pos", "before", "after", "tail")
        edit = "array<struct<pos: bigint, state: int, edit: string>>"
        self.fragments = stored(cut.mapInArrow(_fragments(kind), f"conv_id {spark_kind}, block long, fragment string, edits {edit}"), "long-edits")

    def lines(self) -> DataFrame:
        edits = self.fragments.select(F.explode("edits").alias("e")).select("e.pos", "e.state", "e.edit")
        symbols = self.flagged.select("pos", "symbol")
        joined = self.rows.join(edits, "pos").join(symbols, "pos")
        joined = joined.select("conv_id", "pos", "role", "text", "symbol", "state", "edit")
        return joined.mapInArrow(_long_lines(self.kind), f"conv_id {self.spark_kind}, place long, role string, text string, edit string")

    def audits(self) -> DataFrame:
        flags = self.flagged
        counted = flags.groupBy("conv_id").agg(
            F.sum(F.col("blank").cast("long")).alias("blank"),
            F.sum(F.col("repeated").cast("long")).alias("duplicate"),
            F.sum((F.col("symbol").isin("S", "U", "A", "O")).cast("long")).alias("truncated"),
        )
        turns = flags.where("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id")
        wide = lambda c: c.cast("decimal(38,0)")
        spread = wide(F.max("turn")) - wide(F.min("turn")) + F.lit(1) - F.count(F.lit(1))
        gaps = turns.agg(F.least(spread, F.lit(_LONGEST).cast("decimal(38,0)")).cast("long").alias("gaps"))
        # Neighbours inside blocks, and the last and first row of blocks next to each other.
        pairs = F.transform(F.sequence(F.lit(1), F.length("initials")), lambda i: F.substring(F.col("initials"), i, F.lit(2)))
        inside = F.size(F.filter(pairs, lambda p: (F.length(p) == 2) & ~p.isin(*_LEGAL)))
        edges = F.array_sort(F.collect_list(F.struct("block", F.substring("initials", 1, 1).alias("a"), F.substring("initials", -1, 1).alias("z"))))
        seams = F.zip_with(F.slice("edges.z", F.lit(1), F.size("edges") - 1), F.slice("edges.a", F.lit(2), F.size("edges")), lambda z, a: F.concat(z, a))
        illegal = self.blocks.groupBy("conv_id").agg(F.sum(inside).alias("inside"), edges.alias("edges"))
        illegal = illegal.select("conv_id", (F.col("inside") + F.size(F.filter(seams, lambda p: ~p.isin(*_LEGAL)))).cast("long").alias("illegal"))
        costs = self.chained.groupBy("conv_id").agg(F.sum("cost").alias("cost"))
        parts = F.array_sort(F.collect_list(F.struct("block", "fragment")))
        spelled = self.fragments.groupBy("conv_id").agg(F.array_join(parts["fragment"], "").alias("audit"))
        ordered = self.lines().select("conv_id", "place", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "place")
        digests = ordered.drop("place").mapInArrow(_hashing(self.kind), f"conv_id {self.spark_kind}, repaired_sha256 string")
        out = counted
        for more in (gaps, illegal, costs, spelled, digests):
            out = _null_safe(out, more, "conv_id", how="left")
        nothing = F.lit(hashlib.sha256(b"").hexdigest())
        return out.select(
            "conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
            F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
        )


def _prepared(rows: DataFrame, present: Column | None) -> tuple[DataFrame, str, pa.DataType]:
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = rows.select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), there.alias("present"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind)
    if arrow is None:
        rows, kind, arrow = rows.withColumn("conv_id", F.col("conv_id").cast("string")), "string", pa.string()
    return rows, kind, arrow


def _divided(rows: DataFrame, long: int, long_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations that one task holds, in order, and those of longer ones if there are any."""
    sizes = rows.where("present").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    # No more than one conversation in ``long`` rows, or ``long_bytes`` bytes, so the list stays small.
    ids = stored(sizes.where((F.col("n") > long) | (F.col("bytes") > long_bytes)).select("conv_id"), "long-ids")
    some = not ids.isEmpty()
    chosen = F.broadcast(ids.withColumnRenamed("conv_id", "_conv"))
    same = rows["conv_id"].eqNullSafe(F.col("_conv"))
    short = rows.join(chosen, same, "left_anti") if some else rows
    ordered = short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered, rows.join(chosen, same, "left_semi").where("present").drop("present") if some else None


def audit_conversations(
    rows: DataFrame, present: Column | None = None, long: int = LONG, long_bytes: int = LONG_BYTES, block: int = BLOCK
) -> DataFrame:
    """One row per conversation: conv_id, faults counted, and the cheapest repair.

    ``rows`` has conv_id, turn, role, text; a null role or text is one space, a null conv_id is a conversation
    of its own, and rows where ``present`` is not true only name their conversation. A conversation's rows are in the
    order of turn (nulls first), then role, then text. gaps counts missing turns (null turns aside). Of each row the
    first of these faults counts: blank (nothing but white space), duplicate (role and text of an earlier row), truncated
    (the last sign is none of . ! ?); illegal counts neighbours other than system-user, user-assistant, assistant-user by
    the first letter of their roles, a role without one or with another being illegal beside any.

    Keeping a row costs 0, giving it the role user or assistant 2, deleting 3 (blank and duplicate rows have to go),
    inserting a row without text 2, and each truncated row left 1. The repaired roles are nothing or pairs of user
    and assistant with at most one system row, a kept one, before them; a row whose role starts with none of s, u, a cannot be kept. audit has
    the first letter of each edit in order, of equal costs the least text; repaired_sha256 is of the lines role:text. A conversation
    without rows costs 0, with an empty audit. Other columns are not read; an empty table gives no rows.
    """
    rows, spark_kind, kind = _prepared(rows, present)
    short, longer = _divided(rows, long, long_bytes)
    schema = f"conv_id {spark_kind}, {_COUNTS}, audit string, repaired_sha256 string"
    out = short.mapInArrow(_auditing(kind), schema)
    return out if longer is None else out.unionByName(_Long(longer, spark_kind, kind, block).audits())


def repair_conversations(
    rows: DataFrame, present: Column | None = None, long: int = LONG, long_bytes: int = LONG_BYTES, block: int = BLOCK
) -> DataFrame:
    """The repaired rows: conv_id, place, role, text, edit (K, R or I); place orders a conversation's rows, with gaps.

    Rules and odd cases are those of audit_conversations; a conversation repaired to nothing has no rows.
    """
    rows, spark_kind, kind = _prepared(rows, present)
    short, longer = _divided(rows, long, long_bytes)
    schema = f"conv_id {spark_kind}, place long, role string, text string, edit string"
    out = short.where("present").mapInArrow(_repairing(kind), schema)
    return out if longer is None else out.unionByName(_Long(longer, spark_kind, kind, block).lines())


def damaged_audits(rows: DataFrame, **sizes: int) -> DataFrame:
    """audit_conversations of rows after damage."""
    return audit_conversations(damage(rows), F.col("present"), **sizes)
