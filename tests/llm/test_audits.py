"""Conversation repair against an exhaustive search and a plain version of the whole contract."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from provtally.llm import audit_paths, conversation_repair

LEGAL = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def search(symbols):
    """Least (cost, letters, repaired (row or None, role or None)) of all edits with at most two inserts in a place."""
    best = (3 * len(symbols) + 1, "", ())

    def go(i, roles, cost, letters, out, inserted):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(symbols):
            if LEGAL.fullmatch(roles):
                best = min(best, (cost, letters, out), key=lambda b: b[:2])
        else:
            s = symbols[i]
            go(i + 1, roles, cost + 3, letters + "D", out, 0)
            if s != "x":
                if s.lower() != "o":
                    go(i + 1, roles + s.lower(), cost + s.isupper(), letters + "K", (*out, (i, None)), 0)
                for role in ("user", "assistant"):
                    go(i + 1, roles + role[0], cost + 2 + s.isupper(), letters + "R", (*out, (i, role)), 0)
        if inserted < 2:
            for role in ("user", "assistant"):
                go(i, roles + role[0], cost + 2, letters + "I", (*out, (None, role)), inserted + 1)

    go(0, "", 0, "", (), 0)
    return best


def test_audits_equal_exhaustive_search():
    rnd = random.Random(1)
    cases = ["".join(c) for n in range(3) for c in itertools.product("suaoSUAOx", repeat=n)]
    cases += ["".join(rnd.choices("suaoUAx", k=rnd.randint(3, 5))) for _ in range(150)]
    assert [audit_paths.audit(c) for c in cases] == [search(c)[:2] for c in cases]


def test_blocks_give_what_the_whole_gives():
    rnd = random.Random(2)
    for _ in range(500):
        s = "".join(rnd.choices("suaoSUAOx", k=rnd.randint(1, 60)))
        cuts = [0, *sorted(rnd.sample(range(len(s) + 1), min(len(s), 5))), len(s)]
        parts = [s[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        cost, states, tail = audit_paths.chain([audit_paths.summary(p) for p in parts])
        spelled = "".join(audit_paths.fragment(p, a, b) for p, a, b in zip(parts, states, states[1:], strict=False))
        assert (cost, spelled + tail) == audit_paths.audit(s)


def test_colliding_hashes_change_nothing(monkeypatch):
    rnd = random.Random(3)
    cases = ["".join(rnd.choices("suaUAx", k=70)) for _ in range(60)]
    want = [audit_paths._audit(c) for c in cases]
    monkeypatch.setattr(audit_paths, "_PRIME", 5)
    assert [audit_paths._audit(c) for c in cases] == want


def plain(rows):
    """The query's contract, row by row."""
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        conversations[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, live in conversations.items():
        live.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, *_ in live if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, symbols, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, "", set()
        for _, role, text in live:
            solid = text.strip(" \t\n\v\f\r")
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            own = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "x" if fault in ("blank", "duplicate") else own.upper() if fault else own
            if fault:
                counts[fault] += 1
        illegal = sum((a[1][:1] or " ") + (b[1][:1] or " ") not in ("su", "ua", "au") for a, b in zip(live, live[1:], strict=False))
        # The exhaustive search takes short conversations only; longer ones have the programme's audit, tested above.
        cost, letters = search(symbols)[:2] if len(symbols) < 6 else audit_paths._audit(symbols)
        state, row, lines = "", 0, []
        for letter in letters:
            if letter == "D":
                row += 1
                continue
            role = "assistant" if state == "u" else "user"
            role = live[row][1] if letter == "K" else role
            lines.append(f"{role}:{'' if letter == 'I' else live[row][2]}")
            row, state = row + (letter != "I"), role[:1]
        assert LEGAL.fullmatch("".join(x[0] for x in lines)) and row == len(live)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, letters, digest, lines))
    return sorted(out, key=repr)


def _rows():
    rnd = random.Random(4)
    texts = ["Yes.", "No", "", None, " \t\n", "Why?", "long " * 3000 + "end!", "a.\v\f ", "é…", "x\x1f.", "Same.", "Same."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "umbrella", "User"]
    rows = []
    for conv in [None, *range(60)]:
        n = rnd.choice([0, 1, 2, 3, 4, 5, 8, 20])
        rows += [(conv, None if rnd.random() < 0.1 else rnd.randrange(2 * n), rnd.choice(roles), rnd.choice(texts)) for _ in range(n)]
        rows += [(conv, 3 * i, ("user", "assistant")[i % 2], f"{conv} {i}.") for i in range(rnd.randrange(6))]
    rows += [(77, None, "user", "never. " * i) for i in range(5)] + [(78, 1, "user", "Same.")] * 30
    rows += [(79, t, "user", "gone") for t in range(2000) if zlib.crc32(f"79:{t}".encode()) % 20 == 0]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, present long, edit string, pos long, _conv_id long"


@pytest.mark.parametrize("sizes", [{}, {"long": 3, "block": 4}, {"long": 0, "block": 1}, {"long_bytes": 100, "block": 8192}])
def test_query_equals_the_plain_version(spark, sizes):
    rows = _rows()
    table = spark.createDataFrame([(*r, 1, "e", 2, 3) for r in rows], SCHEMA).repartition(5)
    got = conversation_repair.damaged_audits(table, **sizes).collect()
    want = plain(rows)
    assert sorted((tuple(r) for r in got), key=repr) == [w[:-1] for w in want]
    from pyspark.sql import functions as F

    lines = conversation_repair.repair_conversations(conversation_repair.damage(table), F.col("present"), **sizes).orderBy("conv_id", "place")
    found = defaultdict(list)
    for r in lines.collect():
        found[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert found == {w[0]: w[-1] for w in want if w[-1]}


def test_empty_table_and_conversation_without_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation_repair.damaged_audits(empty).count() == 0
    assert conversation_repair.damaged_audits(empty, long=0).count() == 0
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    gone = spark.createDataFrame([(5, turn, "user", "x")], "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in conversation_repair.damaged_audits(gone).collect()]
    assert got == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
