"""Operator 13 against plain counts of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from replygauge.llm import collocations as c


def plain(rows, least, most=2000, covered=80):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    out = {}
    for (lang, p), a in counts.items():
        if len(p) < 2 or a < least:
            continue
        longer = [f for (g, q), f in counts.items() if g == lang and len(q) > len(p) and f >= least and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * f >= covered * a for f in longer):
            continue
        cuts = [(2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, totals[lang], -score) for lang, found in out.items() for rank, (score, a, p, l, r) in enumerate(sorted(found)[:most], 1))


def corpus(r, size):
    words = ["the", "The", "of", "new", "york", "é", "日本", "a b", "word's", "É"]
    rows = [(None, "en"), ("", "en"), (" \t\n.,", None), ("one", "xx"), ("New York city, new york\tcity " * 9, None)]
    for _ in range(size):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(r.randint(1, 60)))
        if r.random() < 0.5:
            text += " in the city of new york today" * r.randint(1, 3)
        rows.append((text, r.choice(["en", "en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("settings", [{}, {"budget": 60, "gathered": 40}, {"budget": 500, "gathered": 1, "most": 7, "covered": 50}])
def test_equals_plain_counts(spark, settings):
    rows = corpus(random.Random(4), 120)
    frame = spark.createDataFrame([(t, g, 1) for t, g in rows], "text string, lang string, f int").repartition(4)
    got = sorted(tuple(x) for x in c.collocations(frame, least=8, **settings).collect())
    want = plain(rows, 8, **{k: v for k, v in settings.items() if k in ("most", "covered")})
    assert got == want
    assert len(want) > 15


def test_hot_pair_has_groups_of_its_own(spark):
    """One pair holds most suffixes, so its cell is split by the third word and its count put together again."""
    rows = [(f"hot pair {i % 40} tail", "en") for i in range(1600)] + [(f"other thing {i % 3}", "en") for i in range(90)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(tuple(x) for x in c.collocations(frame, least=30, budget=100, gathered=50).collect())
    assert got == plain(rows, 30)


def test_empty_tables_and_long_texts(spark):
    frame = spark.createDataFrame([("x", "en")], "text string, lang string")
    assert c.collocations(frame.where("lang = 'fr'")).collect() == []
    assert c.collocations(frame).collect() == []
    long = [("big red dog ran. " * 200_000, "en"), ("big red", "en")]
    got = [tuple(x) for x in c.collocations(spark.createDataFrame(long, "text string, lang string")).collect()]
    assert got == plain(long, 30)


def test_groups_fit_the_budget():
    first, parts = c.grouped_cells({0: 5, 1: 5, 2: 25, 4: 3, 5: 8}, 10, 7)
    assert first.tolist() == [0, 0, 1, 4, 4, 5, 5] and parts.tolist() == [1, 1, 3, 1, 1, 1, 1]


def test_two_words_of_one_hash_change_the_seed(spark, monkeypatch):
    rows = corpus(random.Random(1), 30)
    frame = spark.createDataFrame(rows, "text string, lang string")
    real, seeds = c.word_counts, []

    def counts(docs, seed):
        seeds.append(seed)
        found = real(docs, seed)
        return found.withColumn("id", found["id"] * 0) if seed == 0 else found

    monkeypatch.setattr(c, "word_counts", counts)
    assert sorted(tuple(x) for x in c.collocations(frame, least=5).collect()) == plain(rows, 5)
    assert seeds == [0, 1]


def test_merged_suffixes():
    rows, counts = c._merged(np.array([[2, 1], [1, 9], [2, 1]], np.uint64), np.array([3, 1, 4]))
    assert rows.tolist() == [[1, 9], [2, 1]] and counts.tolist() == [1, 7]
