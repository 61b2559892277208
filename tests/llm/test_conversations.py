"""Operator 12 against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from replygauge.llm.conversations import SPACES, Tables, damaged, repair_report
from replygauge.llm.queries import QUERIES

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
WRITE = {"": "u", "s": "u", "u": "a", "a": "u"}
STATES = ["", "s", "u", "a"]


def cheapest(rows):
    """(cost, audit) of rows of (role initial, fault), from the end to the start, over all edits."""
    best = {"": (0, ""), "a": (0, ""), "s": (99, ""), "u": (99, "")}

    def inserted(best):
        for _ in STATES:
            best = {q: min(best[q], (best[WRITE[q]][0] + 5, "I" + best[WRITE[q]][1])) for q in STATES}
        return best

    best = inserted(best)
    for role, fault in reversed(rows):
        now = {}
        for q in STATES:
            options = [(2 + best[q][0], "D" + best[q][1])]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (q, role) in NEXT:
                    options.append((more + best[NEXT[q, role]][0], "K" + best[NEXT[q, role]][1]))
                options += [(more + 1 + best[NEXT[q, r]][0], "R" + best[NEXT[q, r]][1]) for r in "ua" if (q, r) in NEXT]
            now[q] = min(options)
        best = inserted(now)
    return best[""]


def report(rows):
    """The report of one conversation's rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        kept = text.rstrip(SPACES)
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    cost, audit = cheapest([(r[:1], f) for (_, r, _), f in zip(rows, faults, strict=True)])
    out, q, at = [], "", 0
    for letter in audit:
        if letter == "I":
            q = WRITE[q]
            out.append({"u": "user:", "a": "assistant:"}[q])
            continue
        _, role, text = rows[at]
        at += 1
        if letter == "K":
            q = NEXT[q, role[:1]]
            out.append(f"{role}:{text}")
        elif letter == "R":
            q = WRITE[q]
            out.append({"u": "user:", "a": "assistant:"}[q] + text)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def harm(rows):
    """Rows (conv, turn, role, text) after damage, by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else text.translate({ord(c): None for c in ".!?"}) if fault == 2 else text
        role = "user" if fault == 4 else role
        out[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0)) for c, x in out.items()}


def rows_of(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r[0]: tuple(r[1:]) for r in df.select(names).collect()}


@pytest.mark.parametrize("chunk", [4, 8, 1 << 16])
def test_equals_search_over_all_edits(spark, chunk):
    r = random.Random(chunk)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Fine. ", "héllo", None]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(r.choice([1, 2, 3, 7, 20, 60])):
            rows.append((conv, turn * r.choice([1, 1, 1, 2]), r.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]), r.choice(texts) if r.random() < 0.4 else f"{r.random()}."))
    unique = list({(c, t): (c, t, role, text) for c, t, role, text in rows}.values())
    unique += [(200, None, "user", "Hi."), (201, 5, "system", "x."), (202, None, None, None)]
    frame = spark.createDataFrame([(x, *row) for x, row in enumerate(unique)], "codes int, conv_id long, turn long, role string, text string").repartition(3)
    got = rows_of(repair_report(damaged(frame), known=frame, chunk=chunk))
    want = {c: report(x) for c, x in harm(unique).items()}
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op12_four_russians_repair"](spark, folder)) == {c: report(x) for c, x in harm(rows).items()}


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, 0, "user", "Same."), (1, 0, "user", "Same."), (1, 1, "assistant", "Yes."), (1, None, "system", "First.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = rows_of(repair_report(frame))[1]
    assert got == report([(None, "system", "First."), (0, "user", "Same."), (0, "user", "Same."), (1, "assistant", "Yes.")])
    assert repair_report(frame.where("conv_id = 9")).collect() == []
    left = rows_of(repair_report(frame.where("conv_id = 9"), known=frame))
    assert left == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_one_long_conversation(spark):
    """A third of a table in one conversation: cut into many chunks, same edits as in one."""
    rows = spark.range(30_000).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.element_at(F.array(*(F.lit(x) for x in ("user", "assistant", "user", "system", "tool"))), (F.pmod(F.xxhash64("id"), F.lit(5)) + 1).cast("int")).alias("role"),
        F.concat(F.col("id").cast("string"), F.when(F.col("id") % 7 == 0, F.lit(" and")).otherwise(F.lit("."))).alias("text"))
    many, one = (rows_of(repair_report(rows, chunk=c))[7] for c in (512, 1 << 16))
    assert many == one
    assert many[6] == cheapest([(r.role[:1], "" if r.text.endswith(".") else "truncated") for r in rows.orderBy("turn").collect()])[1]


def test_block_tables_equal_single_steps():
    wide, single = Tables(4), Tables(1)
    r = np.random.default_rng(3)
    assert len(wide.vectors) == len(single.vectors) < 200
    for size in (0, 1, 3, 4, 5, 31):
        symbols = r.integers(0, 9, size)
        for a, b in zip(wide.across(symbols), single.across(symbols), strict=True):
            assert a.tolist() == b.tolist()
        for state in range(4):
            assert wide.trace(symbols, 0, state) == single.trace(symbols, 0, state)
