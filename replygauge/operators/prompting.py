"""Prompt rendering and chat messages."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.functions.text import ColumnOrName, as_column


@dataclass(frozen=True)
class Ref:
    """A place in a template that takes the value of a named field of the same row."""

    field: str


def render(template: tuple[str | Ref, ...], fields: Mapping[str, ColumnOrName]) -> Column:
    """Fill a template. Null if any field is null, so check for blanks first."""
    parts = [as_column(fields[p.field]) if isinstance(p, Ref) else F.lit(p) for p in template]
    return F.concat(*parts)


def close_prompt(prompt: ColumnOrName, closing: str = lx.NO_FENCE) -> Column:
    """Replace trailing line feeds by one, then append the closing instruction."""
    return F.concat(F.rtrim(as_column(prompt), F.lit("\n")), F.lit("\n" + closing))


def assemble_messages(system: ColumnOrName, user: ColumnOrName) -> Column:
    """System message, then user message."""

    def message(role: str, content: ColumnOrName) -> Column:
        return F.struct(F.lit(role).alias("role"), as_column(content).alias("content"))

    return F.array(message("system", system), message("user", user))


def last_message(messages: ColumnOrName, role: str) -> Column:
    """Content of the last message of a role, or the empty string."""
    of_role = F.filter(as_column(messages), lambda message: message["role"] == role)
    return F.coalesce(F.try_element_at(of_role, F.lit(-1))["content"], F.lit(""))


def last_messages(
    turns: DataFrame, role: str, key: str = "conv_id", order: str = "turn", text: str = "text"
) -> DataFrame:
    """Last message of a role per conversation; empty where it has none.

    One aggregate with map-side combine, so a conversation of any length is
    reduced where it is read.
    """
    is_role = F.col("role") == role
    last = F.max_by(F.when(is_role, F.col(text)), F.when(is_role, F.col(order)))
    return turns.groupBy(key).agg(F.coalesce(last, F.lit("")).alias("last_message"))
