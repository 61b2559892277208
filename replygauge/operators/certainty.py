"""How sure a reported figure is: intervals by a Poisson bootstrap, and a held-out sample with known shares.

The bootstrap never copies rows. Rows are dealt to a fixed number of cells by a hash
of their key and summed there, which combines before the shuffle; each replicate then
draws a weight for each cell, again by a hash. Cells are random groups of rows, so the
spread of the replicates is that of a bootstrap by rows, and what is drawn has one
row per cell whatever the size of the table. The same keys give the same interval.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replygauge.functions.text import ColumnOrName, as_column
from replygauge.operators.report import agreement

#: Hexadecimal digits of the cell, and of the number that a weight is drawn from.
CELL_DIGITS, DRAW_DIGITS = 3, 4
REPLICATES = 200
LEVEL = 0.95


def poisson_steps(digits: int = DRAW_DIGITS) -> list[int]:
    """The least numbers, of so many hexadecimal digits, for which a Poisson(1) weight is 1, 2, ..."""
    steps, share, k = [], 0.0, 0
    while (step := round(16**digits * (share := share + math.exp(-1) / math.factorial(k)))) < 16**digits:
        steps.append(step)
        k += 1
    return steps


def _drawn(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("int")


def cell(key: ColumnOrName) -> Column:
    """The cell of a row; rows without a key share the cell of the empty text."""
    return _drawn(F.coalesce(as_column(key).cast("string"), F.lit("")), CELL_DIGITS)


def weights(cell: Column, replicates: int) -> Column:
    """The weight of a cell in the whole (first, always 1) and in each replicate."""

    def weight(replicate: Column) -> Column:
        number = _drawn(F.concat_ws(":", cell.cast("string"), replicate.cast("string")), DRAW_DIGITS)
        return F.aggregate(F.array(*map(F.lit, poisson_steps())), F.lit(0), lambda n, step: n + (number >= step).cast("int"))

    return F.transform(F.sequence(F.lit(0), F.lit(replicates)), lambda b: F.when(b == 0, 1).otherwise(weight(b)))


def _replicated(cells: DataFrame, replicates: int) -> DataFrame:
    return cells.select("*", F.posexplode(weights(F.col("cell"), replicates)).alias("replicate", "weight"))


def _interval(value: str, level: float) -> list[Column]:
    ends = [(1 - level) / 2, (1 + level) / 2]
    return [F.percentile(F.when(F.col("replicate") > 0, F.col(value)), end).alias(name) for end, name in zip(ends, ("low", "high"), strict=True)]


def change_intervals(
    compared: DataFrame, key: str, criteria: Sequence[str], replicates: int = REPLICATES, level: float = LEVEL
) -> DataFrame:
    """Per criterion the mean change of ``compare_runs`` with its interval, and whether that leaves out 0.

    Rows without a change on both sides take no part. A criterion without any has nulls and is not changed.
    """
    sums = compared.groupBy(cell(key).alias("cell")).agg(
        *[a for c in criteria for a in (F.count(f"{c}_delta").alias(f"{c}__n"), F.coalesce(F.sum(f"{c}_delta"), F.lit(0)).alias(f"{c}__total"))]
    )
    stacked = F.array(*[F.struct(F.lit(c).alias("criterion"), F.col(f"{c}__n").alias("n"), F.col(f"{c}__total").alias("total")) for c in criteria])
    rows = sums.select("cell", F.inline(stacked))
    means = _replicated(rows, replicates).groupBy("criterion", "replicate").agg(
        F.sum("n").alias("compared"), F.try_divide(F.sum(F.col("weight") * F.col("total")), F.sum(F.col("weight") * F.col("n"))).alias("mean")
    )
    found = means.groupBy("criterion").agg(
        F.max("compared").alias("compared"), F.max(F.when(F.col("replicate") == 0, F.col("mean"))).alias("mean_delta"), *_interval("mean", level)
    )
    return found.withColumn("is_changed", F.coalesce((F.col("low") > 0) | (F.col("high") < 0), F.lit(False)))


def kappa_interval(pairs: DataFrame, key: str, replicates: int = REPLICATES, level: float = LEVEL) -> DataFrame:
    """Agreement and kappa of ``pair_ratings`` with the interval of kappa; one row, null if there is no pair."""
    counts = pairs.groupBy(cell(key).alias("cell"), "judge", "human").agg(F.count(F.lit(1)).alias("n"))
    drawn = _replicated(counts, replicates).groupBy("replicate", "judge", "human").agg(F.sum(F.col("weight") * F.col("n")).alias("n"))
    each = agreement(drawn, by=["replicate"])
    whole = F.col("replicate") == 0
    return each.agg(
        *[F.max(F.when(whole, F.col(c))).alias(c) for c in ("n", "agreed", "agreement_rate", "kappa")], *_interval("kappa", level)
    )


def held_out(df: DataFrame, key: str, stratum: str, size: int) -> DataFrame:
    """The ``size`` rows of each stratum whose keys have the least hash, with ``stratum_rows`` and ``share``.

    A row stays in the sample until rows with a lesser hash arrive, whatever the order,
    and the sample of a union is the sample of the samples' union. All rows of a smaller
    stratum are taken. Only ``size`` rows a task and stratum are shuffled. Null strata
    are one; rows with a null key come last.
    """
    order = [F.md5(F.col(key).cast("string")).asc_nulls_last(), F.col(key).asc_nulls_last()]
    least = df.withColumn("__place", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).where(F.col("__place") <= size)
    rows = df.groupBy(F.col(stratum).alias("__stratum")).agg(F.count(F.lit(1)).alias("stratum_rows"))
    whole = least.join(rows, F.col(stratum).eqNullSafe(F.col("__stratum"))).drop("__place", "__stratum")
    return whole.withColumn("share", F.least(F.lit(1.0), F.lit(size) / F.col("stratum_rows")))


def weighted_agreement(pairs: DataFrame, share: str = "share") -> DataFrame:
    """Agreement rate and kappa of the whole table, estimated from pairs that were kept with known shares."""
    counts = pairs.groupBy("judge", "human").agg(F.sum(1 / F.col(share)).alias("n"))
    return agreement(counts).select(F.round("n").cast("long").alias("n"), "agreement_rate", "kappa")
