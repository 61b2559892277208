"""Structured replies: unwrap, classify and type a JSON answer.

A reply is an object ``{"output": {...}}`` with declared fields, all required
and no others. Nothing here turns a bad reply into blanks: each one gets a class
that says what is wrong, and only class ``ok`` yields values.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.functions.text import ColumnOrName, as_column, is_blank, strip

OK = "ok"
FAILURES = [
    "empty",
    "open_fence",
    "prose",
    "truncated",
    "trailing_text",
    "malformed",
    "wrong_shape",
    "bad_type",
    "out_of_range",
]
_FENCED = r"(?s)\A```[A-Za-z]*\s*(.*?)\s*```\z"


@dataclass(frozen=True)
class Text:
    name: str


@dataclass(frozen=True)
class Score:
    name: str
    low: int = 1
    high: int = 3


@dataclass(frozen=True)
class ReplySchema:
    """The fields of a reply, in order. All are required."""

    fields: tuple[Text | Score, ...]

    @property
    def names(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"{f.name} {'int' if isinstance(f, Score) else 'string'}" for f in self.fields)


def strip_fence(raw: ColumnOrName) -> Column:
    """Remove a code fence that is both opened and closed; leave an unclosed one."""
    return F.regexp_replace(strip(raw), _FENCED, "$1")


def repair_open_fence(raw: ColumnOrName) -> Column:
    """Also remove an opening fence that is never closed."""
    return F.regexp_replace(strip_fence(raw), r"\A```[A-Za-z]*\s*", "")


def _whole_value(body: Column, before: str, after: str) -> Column:
    # The JSON parser stops at the end of the first value. Inside a wrapper,
    # anything that follows the value breaks the wrapper and the parse fails.
    return F.try_parse_json(F.concat(F.lit(before), body, F.lit(after)))


def parse_replies(
    df: DataFrame, raw: str, schema: ReplySchema, *, into: str = "reply", repair: bool = False
) -> DataFrame:
    """Add ``<into>_class`` and the struct ``<into>``, null unless the class is ok.

    Good replies are told by one comparison of their shape; the reasons are worked
    out only for the others.
    """
    body, whole, output, shape, found = (f"__{into}_{part}" for part in ("body", "whole", "output", "shape", "found"))
    unwrapped = repair_open_fence(raw) if repair else strip_fence(raw)
    alone = _whole_value(F.col(body), "[", "]").isNotNull()
    parsed = (
        df.withColumn(body, unwrapped)
        .withColumn(whole, F.when(alone, _whole_value(F.col(body), '{"r":', "}")))
        .withColumn(output, F.try_variant_get(whole, "$.r.output", "variant"))
        .withColumns({
            shape: F.schema_of_variant(output),
            found: F.struct(*[
                F.try_variant_get(output, f"$.{f.name}", "double" if isinstance(f, Score) else "string").alias(f.name)
                for f in schema.fields
            ]),
        })
    )
    values, unreadable = F.col(found), F.col(whole).isNull()
    good_types = F.regexp_like(shape, F.lit(_shape_pattern(schema))) & _all_integral(values, schema)
    in_range = _all_in_range(values, schema)
    reply_class = (
        F.when(good_types & in_range, OK)
        .when(is_blank(body), "empty")
        .when(F.col(body).startswith("```"), "open_fence")
        .when(~F.col(body).startswith("{"), "prose")
        .when(unreadable & F.try_parse_json(body).isNotNull(), "trailing_text")
        .when(unreadable & ~F.col(body).endswith("}"), "truncated")
        .when(unreadable, "malformed")
        .when(_has_wrong_keys(F.col(output), schema), "wrong_shape")
        .when(good_types, "out_of_range")
        .otherwise("bad_type")
    )
    typed = F.struct(*[
        (values[f.name].cast("int") if isinstance(f, Score) else values[f.name]).alias(f.name) for f in schema.fields
    ])
    return (
        parsed.withColumn(f"{into}_class", reply_class)
        .withColumn(into, F.when(F.col(f"{into}_class") == OK, typed))
        .drop(body, whole, output, shape, found)
    )


def _shape_pattern(schema: ReplySchema) -> str:
    """What the type of a good reply looks like. Keys of a variant are sorted."""
    number = r"(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"
    fields = sorted(schema.fields, key=lambda f: f.name)
    return "^OBJECT<" + ", ".join(f"{f.name}: {number if isinstance(f, Score) else 'STRING'}" for f in fields) + ">$"


def _has_wrong_keys(output: Column, schema: ReplySchema) -> Column:
    """No envelope, a required key missing, or a key nobody declared."""
    keys = F.json_object_keys(F.to_json(output))
    return F.coalesce(F.array_sort(keys) != F.array(*map(F.lit, sorted(schema.names))), F.lit(True))


def _scores(schema: ReplySchema) -> list[Score]:
    return [field for field in schema.fields if isinstance(field, Score)]


def _all_integral(values: Column, schema: ReplySchema) -> Column:
    """A score is a number without a fraction, as 3 or 3.0."""
    return reduce(and_, [values[f.name] % 1 == 0 for f in _scores(schema)], F.lit(True))


def _all_in_range(values: Column, schema: ReplySchema) -> Column:
    return reduce(and_, [values[f.name].between(f.low, f.high) for f in _scores(schema)], F.lit(True))


def overall_matches(reply: ColumnOrName, left: str, right: str, total: str) -> Column:
    """Is the reported total the sum of its two parts?"""
    reply = as_column(reply)
    return reply[left] + reply[right] == reply[total]
