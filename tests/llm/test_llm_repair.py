"""Conversation repair against a brute-force least (cost, audit) search."""
import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from appraise.llm import conversation_repair as cr
from conftest import SMALL

MOVES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute(rows):
    """rows: (turn, role, text) in order -> the contract's columns and the repaired lines."""
    seen, fault = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        fault.append("blank" if not bare else "duplicate" if (role, text) in seen else
                     "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state, inserts):
        out = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts < 2:
            nxt = "a" if state == "u" else "u"
            c, a, l = best(i, nxt, inserts + 1)
            out.append((c + 3, "I" + a, (("assistant:" if nxt == "a" else "user:"),) + l))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, l = best(i + 1, state, 0)
            out.append((c + 4, "D" + a, l))
            if fault[i] in ("", "truncated"):
                add = 3 if fault[i] else 0
                if (state, role[:1]) in MOVES:
                    c, a, l = best(i + 1, role[0], 0)
                    out.append((c + add, "K" + a, (f"{role}:{text}",) + l))
                nxt = "a" if state == "u" else "u"
                c, a, l = best(i + 1, nxt, 0)
                out.append((c + add + 3, "R" + a, (f"{'assistant' if nxt == 'a' else 'user'}:{text}",) + l))
        return min(out, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(fault.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        conv_, turn_ = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        mine = out[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0)) for c, v in out.items()}


def table(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_whole_table(spark):
    out = cr.op12_conversation_repair(spark, SMALL)
    assert out.columns == COLUMNS
    want = damaged([tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()])
    assert table(out) == {c: brute(v)[0] for c, v in want.items()}


def made(seed, n=60, longest=14):
    rng = random.Random(seed)
    words = ["Yes.", "no", " ", "", "Well!", "so?", "and then ", "x\x0b"]
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randrange(longest)):
            rows.append((conv, None if rng.random() < .05 and turn == 0 else turn,
                         rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]),
                         rng.choice(words) if rng.random() < .6 else None if rng.random() < .1 else f"{rng.random()}."))
    return rows


@pytest.mark.parametrize("seed,hold,ranges", [(1, 1 << 16, 4), (2, 4, 3), (3, 1, 2), (4, 3, 16)])
def test_made_conversations(spark, seed, hold, ranges):
    rows = made(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for name in ("gone", "conv", "flags", "seq", "_row", "_kind", "seg", "key"):
        df = df.withColumn(name, F.lit("other"))
    want = {c: brute(v) for c, v in damaged(rows).items()}
    assert table(cr.repair(cr.damage(df), "gone", hold, ranges)) == {c: w for c, (w, _) in want.items()}
    lines = defaultdict(list)
    for r in cr.repaired(cr.damage(df), "gone", hold, ranges).orderBy("place").collect():
        assert r.place == len(lines[r.conv_id])
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: tuple(v) for c, v in lines.items()} == {c: li for c, (_, li) in want.items() if li}


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Same.", "cut off", "", f"{t}."])) for t in range(900)]
    rows += [(c, 0, "user", "Hello.") for c in range(100, 140)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = table(cr.repair(df, hold=50, ranges=8))
    by = defaultdict(list)
    for c, *r in rows:
        by[c].append(tuple(r))
    import sys
    sys.setrecursionlimit(20000)
    assert got == {c: brute(v)[0] for c, v in by.items()}


def test_empty_long_and_repeated(spark):
    schema = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert cr.repair(empty).collect() == [] and cr.repaired(empty).collect() == []
    rows = [(1, 0, "user", "word " * 200000 + "end."), (1, 1, "assistant", "ok."), (2, 0, "user", "Hi."), (2, 0, "user", "Hi."),
            (3, None, "user", "a."), (3, None, "assistant", "b.")]
    by = defaultdict(list)
    for c, *r in sorted(rows[:4], key=str):
        by[c].append(tuple(r))
    got = table(cr.repair(spark.createDataFrame(rows, schema)))
    assert {c: got[c] for c in (1, 2)} == {c: brute(v)[0] for c, v in by.items()}
    assert got[3][0] == 0                       # turns all null: no gaps
    gone = spark.createDataFrame([(9, 0, "user", "x.")], schema).withColumn("lost", F.lit(True))
    assert table(cr.repair(gone, "lost")) == {9: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
