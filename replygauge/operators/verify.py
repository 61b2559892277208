"""Checks of a consolidated table.

One aggregate pass counts what every check needs. A second pass picks at most a
few offending ids per check. The result is a report; the caller decides.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.functions.numeric import in_range, is_bad_sum
from replygauge.functions.text import is_blank

FAIL, NOTE = "fail", "note"


@dataclass(frozen=True)
class Spec:
    """What a table must look like."""

    required: Sequence[str] = tuple(lx.CONSOLIDATED_COLUMNS)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=lambda: dict(lx.SCORE_RANGES))
    sums: Sequence[tuple[str, str, str]] = (("issue_addressal_score", "resolution_clarity_score", "overall_score"),)
    marked: Sequence[str] = ("summarisation", "response_generation")
    marker: str = lx.MOCK_MARKER
    key: str = "support_ticket_id"
    sample_size: int = 10


@dataclass(frozen=True)
class _RowCheck:
    """A condition a row must not meet, void if one of its columns is always blank."""

    name: str
    severity: str
    bad: Column
    columns: tuple[str, ...]
    detail: str


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def contains_marker(columns: Sequence[str], marker: str) -> Column:
    """Does any of the columns hold the marker?"""
    return reduce(or_, [F.coalesce(F.col(c).contains(marker), F.lit(False)) for c in columns])


def always_blank(df: DataFrame) -> DataFrame:
    """Columns that are blank in every row, in one aggregate over all columns."""
    flags = df.agg(*[F.bool_and(is_blank(F.col(f"`{c}`").cast("string"))).alias(c) for c in df.columns])
    return flags.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("is_blank")) for c in df.columns
    ]))).where("is_blank").select("column")


def _row_checks(df: DataFrame, spec: Spec) -> list[_RowCheck]:
    present = [c for c in spec.required if c in df.columns]
    checks = [
        _RowCheck(f"blank_cell:{c}", FAIL, is_blank(F.col(c).cast("string")), (c,), f"{c} is blank")
        for c in present
    ]
    checks += [
        _RowCheck(f"range:{c}", FAIL, ~in_range(c, low, high), (c,), f"{c} is no number from {low} to {high}")
        for c, (low, high) in spec.ranges.items()
        if c in df.columns
    ]
    checks += [
        _RowCheck(f"sum:{o}", FAIL, is_bad_sum(a, b, o), (a, b, o), f"{o} is not {a} + {b}")
        for a, b, o in spec.sums
        if {a, b, o} <= set(df.columns)
    ]
    marked = [c for c in spec.marked if c in df.columns]
    if marked:
        checks.append(_RowCheck(
            "marker", NOTE, contains_marker(marked, spec.marker), (), f"rows with the marker {spec.marker}"
        ))
    return checks


def first_offenders(offences: DataFrame, check: str, key: str, k: int) -> DataFrame:
    """The first k keys of each check, in key order, as one array per check.

    The rank filter becomes a group limit below the shuffle, so each task passes
    on at most k rows per check and no array grows beyond k.
    """
    ranked = offences.withColumn("rank", F.row_number().over(Window.partitionBy(check).orderBy(key)))
    kept = ranked.where(F.col("rank") <= k)
    keys = F.transform(F.array_sort(F.collect_list(F.struct("rank", key))), lambda pair: pair[key])
    return kept.groupBy(check).agg(keys.alias("sample_ids"))


def verify(df: DataFrame, expected_rows: int, spec: Spec | None = None) -> DataFrame:
    """Report with one row per check: check, severity, ok, n_bad, sample_ids, detail.

    An empty table yields the single failed check ``no_rows``. A column blank in
    every row is reported once and drops out of the cell checks.
    """
    spec = spec or Spec()
    if spec.key not in df.columns:
        df = df.withColumn("__ordinal", F.monotonically_increasing_id())
    key = spec.key if spec.key in df.columns else "__ordinal"
    data_columns = [c for c in df.columns if c != "__ordinal"]
    checks = _row_checks(df, spec)

    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.bool_and(is_blank(F.col(f"`{c}`").cast("string"))).alias(f"blank__{c}") for c in data_columns],
        *[F.count_if(check.bad).alias(f"bad__{i}") for i, check in enumerate(checks)],
    )

    def is_always_blank(column: str) -> Column:
        return F.col(f"`blank__{column}`")

    def row(check: str, severity: str, n_bad: Column, detail: Column, applies: Column) -> Column:
        n_bad = n_bad.cast("bigint")
        ok = (n_bad == 0) | F.lit(severity == NOTE)
        return F.struct(
            F.lit(check).alias("check"), F.lit(severity).alias("severity"), ok.alias("ok"),
            n_bad.alias("n_bad"), detail.alias("detail"), applies.alias("applies"),
        )

    has_rows = F.col("rows") > 0
    missing = missing_columns(df, spec.required)
    blank_names = F.array_compact(F.array(*[F.when(is_always_blank(c), F.lit(c)) for c in data_columns]))
    report = [
        row("no_rows", FAIL, F.lit(1), F.lit("the table has no rows"), ~has_rows),
        row(
            "row_count", FAIL, F.abs(F.col("rows") - expected_rows),
            F.concat(F.lit(f"expected {expected_rows} rows, found "), F.col("rows").cast("string")), has_rows,
        ),
        row("missing_columns", FAIL, F.lit(len(missing)), F.lit(", ".join(missing)), has_rows),
        row("blank_columns", FAIL, F.size(blank_names), F.array_join(blank_names, ", "), has_rows),
    ]
    for i, check in enumerate(checks):
        void = reduce(or_, [is_always_blank(c) for c in check.columns], F.lit(False))
        report.append(row(check.name, check.severity, F.col(f"bad__{i}"), F.lit(check.detail), has_rows & ~void))

    failed = F.array_compact(F.array(*[F.when(check.bad, F.lit(check.name)) for check in checks]))
    offences = df.select(F.col(key).cast("string").alias("offender"), F.explode(failed).alias("check"))
    samples = first_offenders(offences, "check", "offender", spec.sample_size)
    return (
        counts.select(F.inline(F.array(*report)))
        .where("applies")
        .join(samples, "check", "left")
        .select(
            "check", "severity", "ok", "n_bad",
            F.coalesce("sample_ids", F.array().cast("array<string>")).alias("sample_ids"), "detail",
        )
    )


def verdict(report: DataFrame) -> DataFrame:
    """One row: did every check that can fail pass?"""
    return report.agg(
        F.coalesce(F.bool_and(F.col("ok") | (F.col("severity") != FAIL)), F.lit(False)).alias("ok"),
        F.count_if(~F.col("ok")).alias("failed_checks"),
        F.count_if((F.col("severity") == NOTE) & (F.col("n_bad") > 0)).alias("notes"),
    )
