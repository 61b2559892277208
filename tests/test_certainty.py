"""Intervals, the held-out sample and the control chart against plain versions and planted cases."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from replygauge.operators import certainty, report


def compared(spark, deltas):
    return spark.createDataFrame(list(enumerate(deltas)), "id long, s_delta int")


def plain_means(deltas, replicates):
    steps = certainty.poisson_steps()
    drawn = []
    for b in range(1, replicates + 1):
        total = n = 0
        for i, d in enumerate(deltas):
            cell = int(hashlib.md5(str(i).encode()).hexdigest()[:3], 16)
            number = int(hashlib.md5(f"{cell}:{b}".encode()).hexdigest()[:4], 16)
            w = sum(number >= s for s in steps)
            total, n = total + w * d, n + w
        drawn.append(total / n)
    return drawn


def test_weights_are_those_of_a_poisson_variable():
    steps = certainty.poisson_steps()
    assert steps == sorted(steps) and abs(sum(1 - s / 65536 for s in steps) - 1) < 1e-3


def test_change_interval_equals_a_plain_bootstrap(spark):
    r = random.Random(1)
    deltas = [r.choice([-1, 0, 0, 1]) for _ in range(300)]
    got = certainty.change_intervals(compared(spark, deltas), "id", ["s"], replicates=40, level=0.9).first()
    means = sorted(plain_means(deltas, 40))
    assert got.mean_delta == pytest.approx(sum(deltas) / 300)
    assert got.low == pytest.approx(means[1] + 0.95 * (means[2] - means[1])) and got.high == pytest.approx(means[37] + 0.05 * (means[38] - means[37]))


def test_a_change_is_told_from_noise(spark):
    r = random.Random(2)
    noise, change = [r.choice([-1, 1]) for _ in range(2000)], [r.choice([-1, 1, 1]) for _ in range(2000)]
    assert [certainty.change_intervals(compared(spark, x), "id", ["s"]).first().is_changed for x in (noise, change)] == [False, True]


def test_change_interval_of_nothing(spark):
    assert certainty.change_intervals(compared(spark, []), "id", ["s"]).count() == 0
    row = certainty.change_intervals(spark.createDataFrame([(None, None), (1, None)], "id long, s_delta int"), "id", ["s"]).first()
    assert (row.compared, row.mean_delta, row.low, row.is_changed) == (0, None, None, False)


def test_kappa_lies_in_its_interval(spark):
    r = random.Random(3)
    pairs = [(i, x, x if r.random() < 0.8 else 1 - x) for i, x in enumerate(r.choices([0, 1], k=800))]
    got = certainty.kappa_interval(spark.createDataFrame(pairs, "id long, judge int, human int"), "id").first()
    assert got.n == 800 and 0.5 < got.low < got.kappa < got.high < 0.7
    empty = certainty.kappa_interval(spark.createDataFrame([], "id long, judge int, human int"), "id").first()
    assert (empty.kappa, empty.low) == (None, None)


def test_held_out_sample_of_a_union(spark):
    def ids(df, size=5):
        return {r.id for r in certainty.held_out(df, "id", "lang", size).collect()}

    rows = [(i, "ab"[i % 2] if i % 7 else None, "clash") for i in range(200)]
    old, new = (spark.createDataFrame(x, "id long, lang string, rank string") for x in (rows[:120], rows[120:]))
    both = old.union(new)
    merged = certainty.held_out(old, "id", "lang", 5).union(certainty.held_out(new, "id", "lang", 5)).select("id", "lang", "rank")
    assert ids(both) == ids(merged) and len(ids(both)) == 15
    stays = {i for i in ids(old) if i not in ids(both)}
    assert len(stays) <= len(ids(both) - ids(old))


def test_held_out_shares(spark):
    rows = [(i, "a") for i in range(40)] + [(100, "b"), (None, "b"), (101, "b")]
    got = certainty.held_out(spark.createDataFrame(rows, "id long, lang string"), "id", "lang", 2).collect()
    assert {(r.lang, r.stratum_rows, round(r.share, 4)) for r in got} == {("a", 40, 0.05), ("b", 3, 0.6667)}
    assert None not in {r.id for r in got}


def test_weighted_agreement_estimates_the_whole(spark):
    pairs = [(1, 1, 0.5), (1, 0, 0.5), (0, 0, 1.0), (0, 0, 1.0)]
    got = certainty.weighted_agreement(spark.createDataFrame(pairs, "judge int, human int, share double")).first()
    assert (got.n, round(got.agreement_rate, 4)) == (6, 0.6667)


def plain_chart(values, baseline, slack):
    first = [v for v in values[:baseline] if v is not None]
    level = sum(first) / len(first)
    spread = (sum((v - level) ** 2 for v in first) / (len(first) - 1)) ** 0.5
    low = high = 0.0
    out = []
    for i, v in enumerate(values):
        if i >= baseline and v is not None:
            z = (v - level) / spread
            low, high = max(0.0, low - z - slack), max(0.0, high + z - slack)
        out.append((low, high))
    return out


def test_chart_equals_the_recursion_and_finds_a_slow_slide(spark):
    r = random.Random(4)
    steady = [3 + r.uniform(-0.1, 0.1) for _ in range(42)]
    slide = [x - 0.02 * max(0, i - 18) for i, x in enumerate(steady)]
    slide[24] = None
    rows = [(n, i, v) for n, series in (("steady", steady), ("slide", slide), ("flat", [2.0] * 42)) for i, v in enumerate(series)]
    frame = spark.createDataFrame(rows, "name string, week int, mean double")
    got = {}
    for row in report.control_chart(frame, "week", "mean", ["name"]).orderBy("week").collect():
        got.setdefault(row.name, []).append(row)
    for name, series in (("steady", steady), ("slide", slide)):
        assert [x for row in got[name] for x in (row.low, row.high)] == pytest.approx([x for pair in plain_chart(series, 16, 1.0) for x in pair], abs=1e-9)
    assert {n: any(row.is_alert for row in x) for n, x in got.items()} == {"steady": False, "slide": True, "flat": False}
    steps = report.with_delta(frame.where("name = 'slide'"), "week", "mean", alert=0.5)
    assert not steps.where("is_drift").count()


def test_chart_of_an_empty_or_short_series(spark):
    schema = "name string, week int, mean double"
    assert report.control_chart(spark.createDataFrame([], schema), "week", "mean", ["name"]).count() == 0
    short = report.control_chart(spark.createDataFrame([("x", 1, 2.0), ("x", 2, None)], schema), "week", "mean", ["name"])
    assert not short.where(F.col("is_alert") | (F.col("low") != 0)).count()
