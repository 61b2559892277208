"""Score rules, gates and routes as column expressions.

Gates fail closed: a null input never counts as a pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.functions.text import ColumnOrName, as_column


def _yes(flag: ColumnOrName) -> Column:
    return F.coalesce(as_column(flag), F.lit(False))


def auto_send(issue: ColumnOrName, clarity: ColumnOrName, policy_flag: ColumnOrName, top: int = 3) -> Column:
    """Both reply criteria at the top and no policy flag. An unknown flag blocks."""
    clean = ~F.coalesce(as_column(policy_flag), F.lit(True))
    return _yes(as_column(issue) == top) & _yes(as_column(clarity) == top) & clean


def needs_human(overall: ColumnOrName, max_overall: int = 4) -> Column:
    """A low or missing overall score goes to a person."""
    return F.coalesce(as_column(overall) <= max_overall, F.lit(True))


def verdict(
    scores: Sequence[ColumnOrName], faithfulness: ColumnOrName, min_mean: float = 4.0, min_faith: float = 4.0
) -> Column:
    """Pass only with a high mean and, on its own, high faithfulness."""
    total = sum((as_column(score) for score in scores[1:]), as_column(scores[0]))
    return _yes(total / len(scores) >= min_mean) & _yes(as_column(faithfulness) >= min_faith)


def in_review_queue(passes: Sequence[ColumnOrName], self_flag: ColumnOrName, usable: Sequence[ColumnOrName]) -> Column:
    """Queue unless every verdict passes, every stage is usable and nothing was self-flagged."""
    stops = [~_yes(ok) for ok in [*passes, *usable]]
    return reduce(or_, stops, F.coalesce(as_column(self_flag), F.lit(True)))


def cap(score: ColumnOrName, violated: ColumnOrName, at: int = 1) -> Column:
    """A violated hard rule pins the score, however good the rest is."""
    return F.when(F.coalesce(as_column(violated), F.lit(True)), F.lit(at)).otherwise(as_column(score))


def route(ambiguous: ColumnOrName, escalation: ColumnOrName, senior: str = "senior", default: str = "standard") -> Column:
    return F.when(_yes(ambiguous) | _yes(escalation), F.lit(senior)).otherwise(F.lit(default))


def coverage(need: ColumnOrName, got: ColumnOrName) -> Column:
    """Share of the needed elements carried over; 1 when nothing was needed."""
    need, got = as_column(need), as_column(got)
    share = F.size(F.array_intersect(need, got)) / F.size(need)
    return F.when(F.size(need) == 0, F.lit(1.0)).otherwise(share)


def coverage_score(share: ColumnOrName) -> Column:
    share = as_column(share)
    return F.when(share >= 1, 3).when(share >= 0.5, 2).otherwise(1)


def business_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Weekdays after ``start`` up to and including ``end``; 0 unless end is later.

    Counted from whole weeks in closed form, so a span of years costs the same
    as a span of days. Holidays are not known here.
    """
    start, end = as_column(start).cast("date"), as_column(end).cast("date")
    # Day 0 is a Monday; weekdays up to and including day n are 5 per full week.
    monday = F.lit("1969-12-29").cast("date")

    def weekdays_through(day: Column) -> Column:
        n = F.datediff(day, monday) + 1
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))

    return F.when(end > start, weekdays_through(end) - weekdays_through(start)).otherwise(F.lit(0)).cast("int")


def entitlement(days: ColumnOrName, policy: str, bands: Sequence[tuple] = tuple(lx.POLICY_BANDS)) -> Column:
    """Entitlement of one policy by day band; null outside every band."""
    days = as_column(days)
    case = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, low, high, granted in bands:
        if name == policy:
            above = F.lit(True) if low is None else days > low
            within = F.lit(True) if high is None else days <= high
            case = case.when(days.isNotNull() & above & within, F.lit(granted))
    return case.otherwise(F.lit(None).cast("string"))
