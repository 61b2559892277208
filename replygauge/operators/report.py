"""Quality reports.

Reports first count by the value they are about, which combines map-side into a
few rows, and derive means, medians and histograms from those counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replygauge.functions import text as tx
from replygauge.functions.text import ColumnOrName, as_column


def text_profile(df: DataFrame, text: str, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Words per text: count, min, max, mean, exact median, short and long texts,
    and the key of the shortest and of the longest text."""
    words = df.select(*by, key, tx.word_count(text).alias("words"))
    histogram = words.groupBy(*by, "words").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"))
    total = F.sum("n")
    return histogram.groupBy(*by).agg(
        total.alias("n"),
        F.min("words").alias("min_words"),
        F.max("words").alias("max_words"),
        (F.sum(F.col("words") * F.col("n")) / total).alias("mean_words"),
        F.percentile("words", 0.5, F.col("n")).alias("median_words"),
        F.coalesce(F.sum(F.when(F.col("words") < 20, F.col("n"))), F.lit(0)).alias("under_20"),
        F.coalesce(F.sum(F.when(F.col("words") > 120, F.col("n"))), F.lit(0)).alias("over_120"),
        F.min_by("first_key", "words").alias("shortest"),
        F.max_by("first_key", "words").alias("longest"),
    )


def extremes(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of the lowest and the highest value; the lower key on a tie."""
    least = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(key).alias("first_key"))
    return least.agg(F.min_by("first_key", value).alias("lowest"), F.max_by("first_key", value).alias("highest"))


def decode_hours(volume: ColumnOrName, minutes: float = 2.5) -> Column:
    """Hours to read that many texts at some minutes each."""
    return as_column(volume) * minutes / 60


def ref_coverage(df: DataFrame, text: str, by: Sequence[str] = (), **options) -> DataFrame:
    """Texts with no, any and several distinct references."""
    refs = df.select(*by, F.size(tx.ref_ids(text, **options)).alias("refs"))
    return refs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("refs") == 0).alias("no_ref"),
        F.count_if(F.col("refs") > 0).alias("with_ref"),
        F.count_if(F.col("refs") > 1).alias("several_refs"),
    )


def score_distribution(df: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """Rows per criterion and score.

    Counts whole score tuples before unpivoting, so the unpivot sees a few
    hundred rows at most, whatever the size of the input.
    """
    tuples = df.groupBy(*criteria).agg(F.count(F.lit(1)).alias("n"))
    long = tuples.unpivot("n", list(criteria), "criterion", "score").where(F.col("score").isNotNull())
    return long.groupBy("criterion", "score").agg(F.sum("n").alias("n"))


def criterion_summary(distribution: DataFrame, top: dict[str, int]) -> DataFrame:
    """Mean, share at the top and whether only one score was ever given."""
    tops = F.create_map(*[F.lit(x) for pair in top.items() for x in pair])
    total = F.sum("n")
    at_top = F.sum(F.when(F.col("score") == tops[F.col("criterion")], F.col("n")).otherwise(0))
    return distribution.groupBy("criterion").agg(
        total.alias("n"),
        (F.sum(F.col("score") * F.col("n")) / total).alias("mean_score"),
        (at_top / total).alias("share_at_top"),
        F.count(F.lit(1)).alias("distinct_scores"),
        (F.count(F.lit(1)) == 1).alias("is_saturated"),
    )


def lowest_criterion(summary: DataFrame) -> DataFrame:
    """The criterion with the lowest mean, first by name on a tie."""
    lowest = F.min(F.struct("mean_score", "criterion"))
    return summary.agg(lowest.alias("x")).select("x.criterion", "x.mean_score")


def segment_means(df: DataFrame, by: str, criteria: Sequence[str], total: bool = False) -> DataFrame:
    """Mean of each criterion per segment, optionally with a total row (null segment)."""
    grouped = df.rollup(by) if total else df.groupBy(by)
    return grouped.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in criteria]
    )


def label_mix(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows per label of each kind, counted as label tuples first."""
    tuples = df.groupBy(*labels).agg(F.count(F.lit(1)).alias("n"))
    long = tuples.select("n", *[F.col(c).cast("string").alias(c) for c in labels]).unpivot(
        "n", list(labels), "kind", "label"
    )
    return long.groupBy("kind", "label").agg(F.sum("n").alias("n"))


def gate_rates(df: DataFrame, gates: Sequence[str]) -> DataFrame:
    """One row: how many rows each gate is true for, and the share."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(g)).alias(f"n_{g}") for g in gates],
        *[F.avg(F.coalesce(F.col(g), F.lit(False)).cast("int")).alias(f"rate_{g}") for g in gates],
    )


def violations_by_code(df: DataFrame, violations: str) -> DataFrame:
    """Rows per violation code."""
    return df.select(F.explode(violations).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def queue_crosstab(df: DataFrame, rows: str, in_queue: str) -> DataFrame:
    return df.groupBy(rows).agg(
        F.count_if(F.col(in_queue)).alias("in_queue"),
        F.count_if(~F.col(in_queue)).alias("not_in_queue"),
    )


def weekly_means(df: DataFrame, ts: str, value: Column, by: Sequence[str] = (), alert: float | None = None) -> DataFrame:
    """Mean per week with the change from the week before, null if that week has no rows.

    The window runs over the aggregated weeks only. With ``alert`` a drop larger
    than that is flagged.
    """
    week = F.date_trunc("week", F.col(ts)).cast("date")
    weeks = df.select(*by, week.alias("week"), value.alias("value")).groupBy(*by, "week").agg(
        F.count("value").alias("n"), (F.sum("value").cast("double") / F.count("value")).alias("mean_value")
    )
    return with_delta(weeks, "week", "mean_value", by, alert, step=7)


def with_delta(
    series: DataFrame, order: str, value: str, by: Sequence[str] = (), alert: float | None = None, step: int | None = None
) -> DataFrame:
    """Change from the row before. With ``step`` only from a row exactly that many days earlier, else null."""
    before = Window.partitionBy(*by).orderBy(order)
    change = F.col(value) - F.lag(value).over(before)
    if step is not None:
        change = F.when(F.datediff(order, F.lag(order).over(before)) == step, change)
    result = series.withColumn("delta", change)
    if alert is None:
        return result
    return result.withColumn("is_drift", F.coalesce(F.col("delta") < -alert, F.lit(False)))


def control_chart(
    series: DataFrame, order: str, value: str, by: Sequence[str] = (), baseline: int = 16, slack: float = 1.0, limit: float = 5.0
) -> DataFrame:
    """Cumulative-sum control chart of each series: a slow slide adds up until it alerts.

    The first ``baseline`` rows of a series set its level and spread. From then on each
    row adds its distance from the level, in spreads and less the slack, to ``low`` (below
    the level) or ``high`` (above it); neither falls below 0, and beyond the limit it alerts.
    Both are running sums less their least value so far, so they need no iteration. Rows
    without a value change nothing; a series without spread in its baseline, or with less
    than two values there, never alerts. The windows run over the rows of the series only.

    The level is itself estimated from few rows, which the defaults allow for: of simulated
    normal series without drift 3 % alert within 26 rows (with a baseline of 8, a slack
    of 0.5 and a limit of 4 it is 45 %), of those that slide by a tenth of their spread a row, 96 %.
    """
    rows = Window.partitionBy(*by).orderBy(order)
    whole, so_far = Window.partitionBy(*by), rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = series.withColumn("__place", F.row_number().over(rows))
    first = F.when(F.col("__place") <= baseline, F.col(value))
    spread = F.stddev_samp(first).over(whole)
    placed = placed.withColumn("__z", F.when(F.col("__place") > baseline, (F.col(value) - F.avg(first).over(whole)) / F.when(spread > 0, spread)))
    for name, sign in (("low", -1), ("high", 1)):
        step = F.coalesce(F.col("__z") * sign - slack, F.lit(0.0))
        placed = placed.withColumn(f"__{name}", F.sum(step).over(so_far))
        placed = placed.withColumn(name, F.col(f"__{name}") - F.least(F.lit(0.0), F.min(f"__{name}").over(so_far)))
    return placed.withColumn("is_alert", (F.col("low") > limit) | (F.col("high") > limit)).drop("__place", "__z", "__low", "__high")


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("judge", "human").agg(F.count(F.lit(1)).alias("n"))


def agreement(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Agreement rate and Cohen's kappa from a confusion matrix, or from one for each value of ``by``."""
    sides = counts.select(*by, F.inline(F.array(
        F.struct(F.col("judge").alias("label"), F.col("n").alias("by_judge"), F.lit(0).alias("by_human"),
                 F.when(F.col("judge") == F.col("human"), F.col("n")).otherwise(0).alias("agreed")),
        F.struct(F.col("human").alias("label"), F.lit(0).alias("by_judge"), F.col("n").alias("by_human"),
                 F.lit(0).alias("agreed")),
    )))
    margins = sides.groupBy(*by, "label").agg(
        F.sum("by_judge").alias("by_judge"), F.sum("by_human").alias("by_human"), F.sum("agreed").alias("agreed")
    )
    totals = margins.groupBy(*by).agg(
        F.sum("by_judge").alias("n"),
        F.sum("agreed").alias("agreed"),
        F.sum(F.col("by_judge").cast("double") * F.col("by_human")).alias("chance"),
    )
    rate, chance = F.col("agreed") / F.col("n"), F.col("chance") / (F.col("n").cast("double") * F.col("n"))
    return totals.select(
        *by, "n", "agreed", rate.alias("agreement_rate"), F.try_divide(rate - chance, 1 - chance).alias("kappa")
    )


def compression(df: DataFrame, source: str, generated: str, by: Sequence[str] = ()) -> DataFrame:
    """Length of generated text and its ratio to the source, in words."""
    words = df.select(*by, tx.word_count(source).alias("source"), tx.word_count(generated).alias("generated"))
    ratio = F.try_divide("generated", "source")
    return words.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("generated").alias("min_words"),
        F.max("generated").alias("max_words"),
        F.avg("generated").alias("mean_words"),
        F.try_divide(F.sum("generated"), F.sum("source")).alias("ratio_of_sums"),
        F.avg(ratio).alias("mean_of_ratios"),
    )


def worst(df: DataFrame, score: str, key: str, k: int, unscored_first: bool = True) -> DataFrame:
    """The k rows with the lowest score, a top-k without a full sort. A row without a score counts as the worst."""
    order = F.col(score).asc_nulls_first() if unscored_first else F.col(score).asc_nulls_last()
    return df.orderBy(order, F.col(key)).limit(k)
