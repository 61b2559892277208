"""Operator 11 against a table of all windows."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from replygauge.llm import bwt_dedup
from replygauge.llm.bwt_dedup import merge, remove_repeats, segments_of, transform


def plain(rows, length):
    """Rows (doc_id, text) in the stated order; the first place of every window stays."""
    rows = [(i, d, (t or "").encode()) for i, (d, t) in enumerate(rows)]
    order = sorted(rows, key=lambda x: (x[1] is None, x[1] or 0))
    seen, out = set(), {}
    for i, doc_id, body in order:
        gone = bytearray(len(body))
        for at in range(len(body) - length + 1):
            window = body[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        left = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        runs = sum(g and (not at or not gone[at - 1]) for at, g in enumerate(gone))
        out[i] = (doc_id, len(body), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return list(out.values())


def corpus(r, size):
    words = ["ab", "ba", "abba", "é", "strange", "common", "日本", "b" * 12]
    passages = [" ".join(r.choices(words, k=40)) for _ in range(6)] + ["a" * 150, "ab" * 90]
    rows = []
    for doc_id in range(size):
        text = " ".join(r.choices(words, k=r.randint(0, 50)) if r.random() < 0.5 else [str(r.random()) for _ in range(r.randint(0, 20))])
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(text))
            text = text[:at] + r.choice(passages) + text[at:]
        if rows and r.random() < 0.3:
            text = r.choice(rows)[1] or ""
            if r.random() < 0.6 and text:
                at = r.randrange(len(text))
                text = text[:at] + "!" + text[at + 1 :]
        rows.append((doc_id * 3, text))
    return rows


@pytest.mark.parametrize(("length", "settings"), [
    (100, {}),
    (100, {"group_bytes": 3000, "shard": 97, "hot": 3, "gathered": 50}),
    (30, {"group_bytes": 2000, "shard": 50, "hot": 1, "gathered": 20}),
])
def test_equals_all_windows(spark, length, settings):
    rows = corpus(random.Random(length), 140)
    frame = spark.createDataFrame([(t, d, "k") for d, t in rows], "text string, doc_id long, span string").repartition(5)
    got = [tuple(x) for x in remove_repeats(frame, length, **settings).collect()]
    assert sorted(got) == sorted(plain(rows, length))
    assert sum(x[2] for x in got) > 2000


def test_edges(spark):
    text = "".join(chr(97 + i % 23) for i in range(0, 900, 4)) + "x" * 150
    rows = [(7, text), (3, None), (1, ""), (5, "short"), (6, "short"), (None, text[:150]), (2, text[20:170]), (9, text + "tail of its own")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, remove_repeats(frame).collect()), key=str)
    assert got == sorted(plain(rows, 100), key=str)
    assert remove_repeats(frame.where("doc_id = 99")).collect() == []


def test_repeated_ids(spark):
    text = "".join(random.Random(5).choices("abcdefgh ", k=400))
    rows = [(4, text), (4, text), (4, text), (4, "other " + text[::-1]), (8, text[100:300])]
    got = sorted(tuple(x)[:4] for x in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(4, 400, 0, 0), (4, 400, 400, 1), (4, 400, 400, 1), (4, 406, 0, 0), (8, 200, 200, 1)])


def test_long_text(spark, monkeypatch):
    """A text of several chunks, each cut at another place than its copy."""
    monkeypatch.setattr(bwt_dedup, "_CHUNK", 1 << 13)
    r = random.Random(2)
    body = "".join(r.choices("abcdefghijklmnop ", k=30_000))
    rows = [(1, body), (2, "front " + body[:25_000]), (3, body[4000:] + body[:4000])]
    data = np.frombuffer(body.encode(), np.uint8)
    starts = segments_of(data, np.array([0, len(data)]), 100)[2]
    assert len(starts) > 500
    got = sorted(map(tuple, remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted(plain(rows, 100))


def test_merge_is_the_sorted_order_of_all_windows():
    r = np.random.default_rng(1)
    rows = r.integers(0, 3, (500, 4)).astype(np.uint64)
    shards = [transform([rows[a : a + 90, i] for i in range(3, -1, -1)]) for a in range(0, 500, 90)]
    order, parted = merge(shards)
    want = np.lexsort(rows.T[::-1])
    assert (rows[order] == rows[want]).all()
    assert parted.tolist() == [True, *(rows[order][1:] != rows[order][:-1]).any(axis=1).tolist()]


def test_equal_hashes_of_unequal_symbols_are_told_apart():
    data = np.frombuffer(b"aaaabbbbaaaa", np.uint8)
    windows, parted = bwt_dedup._split_unequal(data, np.array([0, 4, 8]), np.array([0, 1, 2]), np.array([True, False, False]), 4)
    assert windows.tolist() == [0, 2, 1] and parted.tolist() == [True, False, True]


class InPlace:
    """Takes the function that Spark would run in its tasks."""

    def mapInArrow(self, function, schema):
        return function


def test_memory_of_a_task_follows_the_slice_and_not_the_text():
    text = "".join(np.random.default_rng(3).choice(list("abcdefgh "), 4 << 20))
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1], pa.int64()), "tie": pa.array([0], pa.int64()), "text": [text]})
    find = bwt_dedup._candidates(InPlace(), 100, 4, bwt_dedup.GATHERED)
    list(find([batch.slice(0, 0)]))
    tracemalloc.start()
    out = [x.nbytes for x in find([batch])]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(out) > 3_000_000 and max(out) < 6_000_000
    assert most < 160_000_000


def test_cut_out_hands_on_a_few_bytes_at_a_time():
    """Windows of a hot anchor one by one are a hundred times their text."""
    text = "".join(np.random.default_rng(4).choice(list("abcdefgh "), 60_000))
    span = [int(bwt_dedup._span(0, 30_000, 2)), int(bwt_dedup._span(30_000, 29_901, 2)), int(bwt_dedup._span(100, 50, 1))]
    wanted = pa.array([[{"span": x, "key": 5} for x in span]], pa.list_(pa.struct([("span", pa.int64()), ("key", pa.int64())])))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), pa.array([text]), wanted], ["id", "tie", "text", "wanted"])
    out = list(bwt_dedup._cut_out(100)([batch]))
    bodies = [(bwt_dedup._unspan(s), b.decode()) for x in out for s, b in zip(x["span"].to_pylist(), x["bytes"].to_pylist(), strict=True)]
    assert max(x["bytes"].nbytes for x in out) < 2_000_000
    assert len(bodies) == 59_902
    assert all(b == text[start : start + n + 99] for (start, n), b in bodies)
