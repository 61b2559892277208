"""Numbers that arrive as text: guarded casts and range checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from replygauge.functions.text import ColumnOrName, as_column

# A plain decimal number. Rejects what a cast would let through: 3f, nan, inf.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(value: ColumnOrName) -> Column:
    """Double, or null where the text is not a plain decimal number."""
    text = as_column(value).cast("string")
    return F.when(F.regexp_like(text, F.lit(_NUMBER)), F.btrim(text, F.lit(" \t\n\x0b\f\r")).try_cast("double"))


def in_range(value: ColumnOrName, low: float, high: float) -> Column:
    """False for non-numbers; never null."""
    return F.coalesce(to_number(value).between(low, high), F.lit(False))


def is_bad_sum(left: ColumnOrName, right: ColumnOrName, total: ColumnOrName) -> Column:
    """True where all three are numbers and the parts do not add up."""
    return F.coalesce(to_number(left) + to_number(right) != to_number(total), F.lit(False))
