"""Joins between stages, runs, raters and policy tables.

Join strategies are left to Catalyst: it broadcasts a side only when its measured
size is below ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise,
and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_stages(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Pair two stage tables row by row on a unique key.

    A key that pairs more than once fails the action. It is counted where the join
    has brought its rows together, so the check adds no exchange to a sort-merge
    join and no job of its own.
    """
    paired = left.join(right, key, "inner")
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    twice = F.concat(F.lit(f"column {key} is not unique: "), F.col(key).cast("string"))
    counted = paired.withColumn("__pairs", n)
    return counted.where(
        F.when(F.col("__pairs") > 1, F.raise_error(twice).cast("boolean")).otherwise(F.lit(True))
    ).drop("__pairs")


def join_repeated(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a table with unique keys, where the left may repeat a key without bound.

    Both sides must be scans or projections of scans, so that the join's own
    exchanges lie right below it: adaptive execution then cuts a partition that a
    hot key swells into pieces of the advisory size and hands each the one right
    row. The number of pieces follows the rows; no list of keys, no cap.
    """
    return left.join(right, key, "left")


def lost_rows(source: DataFrame, stage: DataFrame, key: str | list[str]) -> DataFrame:
    """Source rows the stage has no row for."""
    return source.join(stage.select(key), key, "left_anti")


def pair_turns(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it.

    Joins on conversation and position, so one endless conversation spreads over
    all tasks.
    """
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("asked"))
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answered")
    )
    return asked.join(answered, ["conv_id", "turn"], "inner")


def unanswered_turns(turns: DataFrame) -> DataFrame:
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn")
    answered = turns.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"))
    return lost_rows(asked, answered, ["conv_id", "turn"])


def pair_ratings(judge: DataFrame, human: DataFrame, key: str) -> DataFrame:
    """Rows both have rated. Each side: key and ``rating``."""
    return judge.select(key, F.col("rating").alias("judge")).join(
        human.select(key, F.col("rating").alias("human")), key, "inner"
    )


def compare_runs(old: DataFrame, new: DataFrame, key: str, criteria: Sequence[str]) -> DataFrame:
    """Old and new score of each row and criterion; rows of one run only are kept."""
    before = old.select(key, *[F.col(c).alias(f"{c}_old") for c in criteria])
    after = new.select(key, *[F.col(c).alias(f"{c}_new") for c in criteria])
    return before.join(after, key, "full_outer").select(
        key,
        *[c for name in criteria for c in (f"{name}_old", f"{name}_new")],
        *[(F.col(f"{name}_new") - F.col(f"{name}_old")).alias(f"{name}_delta") for name in criteria],
    )


def run_regression(compared: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """Per criterion: rows in one run only, share of changed scores, mean change."""
    summed = compared.agg(*[
        agg
        for c in criteria
        for agg in (
            F.count_if(F.col(f"{c}_old").isNull() & F.col(f"{c}_new").isNotNull()).alias(f"{c}__added"),
            F.count_if(F.col(f"{c}_old").isNotNull() & F.col(f"{c}_new").isNull()).alias(f"{c}__removed"),
            F.count(f"{c}_delta").alias(f"{c}__compared"),
            F.count_if(F.col(f"{c}_delta") != 0).alias(f"{c}__changed"),
            F.coalesce(F.sum(f"{c}_delta"), F.lit(0)).alias(f"{c}__total"),
        )
    ])
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("criterion"),
            *[F.col(f"{c}__{part}").alias(part) for part in ("added", "removed", "compared", "changed", "total")],
        )
        for c in criteria
    ])
    return summed.select(F.inline(rows)).select(
        "criterion", "added", "removed", "compared", "changed",
        F.try_divide("changed", "compared").alias("share_changed"),
        F.try_divide("total", "compared").alias("mean_delta"),
    )


def policy_entitlement(df: DataFrame, bands: DataFrame, policy: str, days: str) -> DataFrame:
    """Look up the entitlement of each row by policy and day band.

    An equi-join on the policy with the band as an extra condition, never a cross
    join. Bands: ``policy, lo_days`` (exclusive), ``hi_days`` (inclusive), both
    open when null, and ``entitlement``. Rows in no band get null.
    """
    bands = bands.select(
        F.col("policy").alias("__policy"),
        F.col("lo_days").alias("__lo"),
        F.col("hi_days").alias("__hi"),
        "entitlement",
    )
    within = (
        (F.col(policy) == F.col("__policy"))
        & (F.col("__lo").isNull() | (F.col(days) > F.col("__lo")))
        & (F.col("__hi").isNull() | (F.col(days) <= F.col("__hi")))
    )
    return df.join(bands, within & F.col(days).isNotNull(), "left").drop("__policy", "__lo", "__hi")


def mirror_diff(writer: DataFrame, judge: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries only one of two mirrored tables holds, with the side that has them."""
    left = writer.select(*keys).distinct().withColumn("in_writer", F.lit(True))
    right = judge.select(*keys).distinct().withColumn("in_judge", F.lit(True))
    side = F.when(F.col("in_judge").isNull(), "writer").when(F.col("in_writer").isNull(), "judge")
    return left.join(right, list(keys), "full_outer").select(*keys, side.alias("only_in")).where("only_in is not null")


def in_queue(df: DataFrame, queue: DataFrame, key: str, condition: Column) -> DataFrame:
    """Rows that meet a condition and stand in the review queue."""
    return df.where(condition).join(queue.select(key), key, "left_semi")


def governing_policy(df: DataFrame, mapping: DataFrame, category: str) -> DataFrame:
    """The one policy that governs a category; ``is_covered`` is false without one."""
    return df.join(mapping, category, "left").withColumn("is_covered", F.col("policy").isNotNull())
