from __future__ import annotations

import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from replygauge.operators import joins, report


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_text_profile_against_plain_python(spark):
    counts = [3, 184, 19, 20, 120, 121, 40, 40]
    df = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(counts)], "id int, t string")
    row = report.text_profile(df, "t", "id").first()
    assert (row.n, row.min_words, row.max_words) == (8, 3, 184)
    assert row.mean_words == pytest.approx(statistics.mean(counts))
    assert row.median_words == statistics.median(counts)
    assert (row.under_20, row.over_120, row.shortest, row.longest) == (2, 2, 0, 1)


def test_extremes_take_the_lower_key_on_a_tie(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 2), (4, 2)], "k int, v int")
    assert rows(report.extremes(df, "k", "v")) == [(3, 1)]


def test_decode_hours(spark):
    assert spark.range(1).select(report.decode_hours(F.lit(15000))).first()[0] == 625


def test_score_reports(spark):
    df = spark.createDataFrame([(3, 1), (3, 2), (3, 3), (3, None)], "a int, b int")
    distribution = report.score_distribution(df, ["a", "b"])
    assert rows(distribution) == [("a", 3, 4), ("b", 1, 1), ("b", 2, 1), ("b", 3, 1)]
    summary = {r.criterion: r for r in report.criterion_summary(distribution, {"a": 3, "b": 3}).collect()}
    assert summary["a"].is_saturated and not summary["b"].is_saturated
    assert (summary["b"].mean_score, summary["b"].n) == (2.0, 3)
    assert summary["b"].share_at_top == pytest.approx(1 / 3)
    lowest = report.lowest_criterion(report.criterion_summary(distribution, {"a": 3, "b": 3}))
    assert rows(lowest) == [("b", 2.0)]


def test_segment_means_with_total(spark):
    df = spark.createDataFrame([(True, 3), (True, 2), (False, 1)], "s boolean, x int")
    got = {r.s: (r.n, r.mean_x) for r in report.segment_means(df, "s", ["x"], total=True).collect()}
    assert got == {True: (2, 2.5), False: (1, 1.0), None: (3, 2.0)}


def test_label_mix_and_violations(spark):
    df = spark.createDataFrame([("a", True, ["X", "Y"]), ("a", False, ["X"]), ("b", True, [])], "c string, f boolean, v array<string>")
    assert rows(report.label_mix(df, ["c", "f"])) == [
        ("c", "a", 2), ("c", "b", 1), ("f", "false", 1), ("f", "true", 2),
    ]
    assert rows(report.violations_by_code(df, "v")) == [("X", 2), ("Y", 1)]


def test_gate_rates_count_unknown_as_not_passed(spark):
    df = spark.createDataFrame([(True,), (None,), (False,), (True,)], "g boolean")
    assert rows(report.gate_rates(df, ["g"])) == [(4, 2, 0.5)]


def test_weekly_means_start_on_monday(spark):
    df = spark.createDataFrame(
        [("2024-01-07", 4.0), ("2024-01-08", 2.0), ("2024-01-14", 3.0), ("2024-01-15", 1.0)], "d string, v double"
    ).withColumn("ts", F.col("d").cast("timestamp_ntz"))
    got = [(str(r.week), r.n, r.mean_value, r.delta, r.is_drift) for r in
           report.weekly_means(df, "ts", F.col("v"), alert=1.4).orderBy("week").collect()]
    assert got == [
        ("2024-01-01", 1, 4.0, None, False), ("2024-01-08", 2, 2.5, -1.5, True), ("2024-01-15", 1, 1.0, -1.5, True),
    ]


def test_agreement_and_kappa(spark):
    pairs = [(3, 3)] * 20 + [(3, 2)] * 5 + [(2, 3)] * 10 + [(2, 2)] * 15
    df = spark.createDataFrame(pairs, "judge int, human int")
    row = report.agreement(report.confusion(df)).first()
    assert (row.n, row.agreed, row.agreement_rate) == (50, 35, 0.7)
    assert row.kappa == pytest.approx(0.4)
    same = spark.createDataFrame([(3, 3)], "judge int, human int")
    assert report.agreement(report.confusion(same)).first().kappa is None


def test_compression(spark):
    df = spark.createDataFrame([("a b c d", "a"), ("a b", "a b c"), ("", "a")], "s string, g string")
    row = report.compression(df, "s", "g").first()
    assert (row.n, row.min_words, row.max_words) == (3, 1, 3)
    assert row.ratio_of_sums == pytest.approx(5 / 6)
    assert row.mean_of_ratios == pytest.approx((0.25 + 1.5) / 2)


def test_worst_is_a_top_k(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 1), ("d", None)], "k string, s int")
    top = report.worst(df, "s", "k", 2, unscored_first=False)
    assert [r.k for r in top.collect()] == ["b", "c"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def turns(spark, data):
    return spark.createDataFrame(data, "conv_id int, turn int, role string, text string")


def test_turn_pairs_and_losses(spark):
    df = turns(spark, [
        (1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c"),
        (1, 4, "user", "d"), (1, 5, "assistant", "e"), (2, 0, "user", "f"),
    ])
    assert rows(joins.pair_turns(df)) == [(1, 1, "a", "b"), (1, 4, "d", "e")]
    assert rows(joins.unanswered_turns(df)) == [(1, 3), (2, 0)]


def test_one_endless_conversation_spreads_over_tasks(spark):
    n = 4000
    df = spark.range(n).selectExpr(
        "1 as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "cast(id as string) as text"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        pairs = joins.pair_turns(df)
        sizes = pairs.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in sizes) == n // 2
    assert max(r["count"] for r in sizes) < n // 4


def test_a_hot_key_is_split_and_the_result_is_that_of_a_plain_join(spark, tmp_path):
    spark.range(40_000).selectExpr(
        "sha2(cast(id as string), 256) as id", "if(id < 30000, 'hot', concat('k', id)) as k"
    ).write.parquet(str(tmp_path / "left"))
    spark.createDataFrame([("hot", 1), ("k30001", 2), ("unused", 3)], "k string, v int").write.parquet(str(tmp_path / "right"))
    left, right = (spark.read.parquet(str(tmp_path / side)) for side in ("left", "right"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = joins.join_repeated(left, right, "k")
        assert joined.columns == ["k", "id", "v"]
        joined.withColumn("task", F.spark_partition_id()).write.parquet(str(tmp_path / "joined"))
        counts = spark.read.parquet(str(tmp_path / "joined")).groupBy("k", "v", "task").count().collect()
        sizes = [r["count"] for r in counts if r.k == "hot" and r.v == 1]
        assert sum(sizes) == 30_000 and max(sizes) < 15_000
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_stage_join_needs_unique_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    right = spark.createDataFrame([(1, "c")], "k int, y string")
    assert rows(joins.join_stages(left, right, "k")) == [(1, "a", "c")]
    with pytest.raises(PySparkException, match="not unique: 1"):
        joins.join_stages(left.union(left), right, "k").collect()


def test_stage_join_adds_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = spark.range(10).selectExpr("id as k", "id as x")
        plan = joins.join_stages(df, df.withColumnRenamed("x", "y"), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hash") == 2


def test_compare_runs(spark):
    old = spark.createDataFrame([(1, 3), (2, 2), (3, 1)], "k int, s int")
    new = spark.createDataFrame([(2, 3), (3, 1), (4, 2)], "k int, s int")
    compared = joins.compare_runs(old, new, "k", ["s"])
    assert {r.k: (r.s_old, r.s_new, r.s_delta) for r in compared.collect()} == {
        1: (3, None, None), 2: (2, 3, 1), 3: (1, 1, 0), 4: (None, 2, None),
    }
    assert rows(joins.run_regression(compared, ["s"])) == [("s", 1, 1, 2, 1, 0.5, 0.5)]


def test_policy_bands_join(spark):
    bands = spark.createDataFrame(
        [("delay", 3, 7, "voucher"), ("delay", 7, None, "refund"), ("return", None, 10, "ok")],
        "policy string, lo_days int, hi_days int, entitlement string",
    )
    df = spark.createDataFrame(
        [("delay", d) for d in (3, 4, 7, 8)] + [("return", 10), ("return", 11), ("return", None), ("other", 5)],
        "p string, d int",
    )
    joined = joins.policy_entitlement(df, bands, "p", "d")
    got = {(r.p, r.d): r.entitlement for r in joined.collect()}
    assert got == {
        ("delay", 3): None, ("delay", 4): "voucher", ("delay", 7): "voucher", ("delay", 8): "refund",
        ("return", 10): "ok", ("return", 11): None, ("return", None): None, ("other", 5): None,
    }
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_mirror_queue_and_governing_policy(spark):
    a = spark.createDataFrame([(1, "10 day"), (1, "3 day")], "no int, f string")
    b = spark.createDataFrame([(1, "10 day"), (2, "5 day")], "no int, f string")
    assert rows(joins.mirror_diff(a, b, ["no", "f"])) == [(1, "3 day", "writer"), (2, "5 day", "judge")]
    assert rows(joins.mirror_diff(a, a, ["no", "f"])) == []
    mapping = spark.createDataFrame([("Wrong Item", "p3")], "category string, policy string")
    df = spark.createDataFrame([("Wrong Item", True), ("Unclear", True)], "category string, e boolean")
    assert rows(joins.governing_policy(df, mapping, "category").select("category", "policy", "is_covered")) == [
        ("Unclear", None, False), ("Wrong Item", "p3", True),
    ]
    assert rows(joins.in_queue(df, df.limit(1), "category", F.col("e")).select("category")) == [("Wrong Item",)]


def test_extremes_of_text_keys(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("d", 5), ("c", 5), ("e", None)], "k string, v int")
    assert rows(report.extremes(df, "k", "v")) == [("a", "c")]


def test_a_gap_of_weeks_is_no_change(spark):
    df = spark.createDataFrame([("2024-01-01", 5.0), ("2024-01-08", 4.0), ("2024-01-22", 1.0)], "d string, v double")
    weeks = report.weekly_means(df.withColumn("ts", F.col("d").cast("timestamp")), "ts", F.col("v"), alert=0.5)
    assert [(r.delta, r.is_drift) for r in weeks.orderBy("week").collect()] == [(None, False), (-1.0, True), (None, False)]


def test_a_row_without_a_score_is_among_the_worst(spark):
    df = spark.createDataFrame([(1, 3), (2, None), (3, 2)], "k int, s int")
    assert [r.k for r in report.worst(df, "s", "k", 2).collect()] == [2, 3]
    assert [r.k for r in report.worst(df, "s", "k", 2, unscored_first=False).collect()] == [3, 1]
