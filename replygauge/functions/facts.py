"""Facts of a text as values: money, dates, time spans, transactions.

A fact is a short text in one normal form, so that sets of facts compare: ``INR
1500.00`` for ``Rs 1,500`` and ``1500 rupees``, ``2024-03-05`` for ``5 March 2024``,
``14 day`` for ``two weeks`` and ``48 hours`` is ``2 day``. All of it is built-in
expressions: one search per kind, then a few steps for each fact that was found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.functions.text import TIMEFRAME, ColumnOrName, as_column

KINDS = ("money", "date", "span", "transaction")

_NUMBER = r"\d+(?:[.,]\d+)*"
#: Currency by what stands next to the number.
_CURRENCIES = [("₹|rs|inr|rupee", "INR"), (r"\$|usd|dollar", "USD"), ("€|eur", "EUR"), ("£|pound", "GBP")]


_MONTH_NUMBERS = "jan:01,feb:02,mar:03,apr:04,may:05,jun:06,jul:07,aug:08,sep:09,oct:10,nov:11,dec:12"
_COUNT_NUMBERS = ",".join(f"{word}:{digits}" for word, digits in lx.NUMBER_WORDS.items()) + ",a:1,an:1"
#: Short and long forms of each unit, its size in the unit it is shown in, and that unit.
_UNITS = [
    ("year", 12, "month"), ("month", 1, "month"), ("week", 7, "day"), ("day", 1, "day"), ("hour", 60, "minute"), ("minute", 1, "minute"),
]


def _lookup(pairs: str, key: Column) -> Column:
    """The value of a key in ``key:value,...``; null without one."""
    return F.try_element_at(F.str_to_map(F.lit(pairs), F.lit(","), F.lit(":")), key)


def _money(found: Column) -> Column:
    """Signs before three digits separate thousands, the last other one is the decimal sign."""
    number = F.regexp_extract(found, _NUMBER, 0)
    number = F.translate(F.regexp_replace(number, r"[.,](?=\d{3}(?:[.,]|$))", ""), ",", ".")
    currency = F.when(F.regexp_like(found, F.lit(_CURRENCIES[0][0])), _CURRENCIES[0][1])
    for pattern, code in _CURRENCIES[1:]:
        currency = currency.when(F.regexp_like(found, F.lit(pattern)), code)
    value = F.coalesce(number.try_cast("decimal(38,2)").cast("string"), number)
    return F.concat_ws(" ", currency, value)


def _date(found: Column) -> Column:
    """ISO 8601, with the parts that are not known left out: ``--03-05``, ``---05``."""
    month = _lookup(_MONTH_NUMBERS, F.regexp_extract(found, r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", 1))
    day = F.lpad(F.regexp_extract(found, r"(?<!\d)(\d{1,2})(?!\d)", 1), 2, "0")
    year = F.regexp_extract(found, r"(\d{4})", 1)
    known = F.coalesce(F.concat(F.when(year == "", F.lit("-")).otherwise(year), F.lit("-"), month, F.lit("-"), day), F.concat(F.lit("---"), day))
    return F.when(F.regexp_like(found, F.lit(r"^\d{4}-")), found).otherwise(known)


_COUNT = rf"(?:\d+(?:[.,]\d+)?|{'|'.join(lx.NUMBER_WORDS)}|{lx.VAGUE_COUNTS.split('|(')[0]}|an?)"
_COUNTS = rf"^({_COUNT})(?:\s*(?:to|or|-|–)\s*({_COUNT}))?"


def _span(found: Column) -> Column:
    """Weeks as days, years as months, minutes and hours as the largest unit that fits; business days by themselves."""
    short = F.regexp_extract(found, r"([a-z]+)$", 1)
    unit = F.when(F.lit(False), F.lit(""))
    for name, forms in lx.TIME_UNITS.items():
        unit = unit.when(F.regexp_like(short, F.lit(f"^(?:{forms})$")), F.lit(name))

    def amount(group: int) -> Column:
        text = F.regexp_extract(found, _COUNTS, group)
        return F.coalesce(_lookup(_COUNT_NUMBERS, text), F.translate(text, ",", ".")).try_cast("decimal(20,4)")

    parsed = F.struct(
        amount(1).alias("low"), amount(2).alias("high"), (F.regexp_extract(found, _COUNTS, 2) != "").alias("both"), unit.alias("unit"),
        F.regexp_like(found, F.lit(r"\b(?:business|working)\b")).alias("business"), F.regexp_extract(found, r"[a-z]+", 0).alias("word"),
    )

    def sized(x: Column) -> Column:
        plain = x["business"] & (x["unit"] != "week")
        size = F.when(plain, 1).when(x["business"], 5)
        name = F.when(plain, F.concat(F.lit("business "), x["unit"])).when(x["business"], F.lit("business day"))
        for unit, n, into in _UNITS:
            size, name = size.when(x["unit"] == unit, n), name.when(x["unit"] == unit, into)
        return F.struct((x["low"] * size).alias("low"), F.when(x["both"], x["high"] * size).otherwise(x["low"] * size).alias("high"), name.alias("name"), F.concat_ws(" ", x["word"], x["unit"]).alias("vague"))

    def fitted(x: Column) -> Column:
        def fits(minutes: int) -> Column:
            return (x["name"] == "minute") & (x["low"] % minutes == 0) & (x["high"] % minutes == 0)

        size = F.when(fits(1440), 1440).when(fits(60), 60).otherwise(1)
        name = F.when(fits(1440), F.lit("day")).when(fits(60), F.lit("hour")).otherwise(x["name"])
        ends = F.array_distinct(F.transform(F.array(x["low"] / size, x["high"] / size), lambda n: F.regexp_replace(n.cast("string"), r"\.?0+$", "")))
        return F.coalesce(F.concat(F.when(x["low"].isNotNull() & x["high"].isNotNull(), F.array_join(ends, "-")), F.lit(" "), name), x["vague"])

    return F.element_at(F.transform(F.transform(F.array(parsed), sized), fitted), 1)


#: How each kind is found, and its normal form.
_FORMS = {
    "money": (lx.FACT_PATTERNS["amounts"], _money),
    "date": (lx.FACT_PATTERNS["dates"], _date),
    "span": (TIMEFRAME, _span),
    "transaction": (lx.FACT_PATTERNS["transactions"], lambda found: F.regexp_extract(found, r"\d+", 0)),
}


_COUNT_STARTS = "|".join(sorted({word[:2] for word in (*lx.NUMBER_WORDS, *lx.VAGUE_COUNTS.split("|(")[0].split("|"))} | {"a"}))
#: What every match of a kind begins with. Tried first, it spares most places of a text the search for all alternatives.
_STARTS = {
    "money": r"(?=[$€£₹riue\d])(?=[$€£₹]|\b)",
    "date": r"(?=[\djfmasond])\b",
    "span": rf"(?=[\dotfsenca])(?<![\d.,a-z])(?=\d|{_COUNT_STARTS})",
    "transaction": "",
}


def raw_facts(text: ColumnOrName) -> Column:
    """Struct of arrays, one per kind, of the facts as they are written, with repeats."""
    text = F.coalesce(as_column(text), F.lit(""))
    return F.struct(*[
        F.regexp_extract_all(text, F.lit(f"(?i){_STARTS[kind]}(?:{pattern})"), F.lit(0)).alias(kind) for kind, (pattern, _) in _FORMS.items()
    ])


def normal_forms(raw: Column) -> Column:
    """Struct of arrays of distinct facts from ``raw_facts``, in the order of the text."""
    return F.struct(*[
        F.array_distinct(F.transform(F.transform(raw[kind], F.lower), form)).alias(kind) for kind, (_, form) in _FORMS.items()
    ])


def typed_facts(text: ColumnOrName) -> Column:
    """Struct of arrays, one per kind, of the distinct facts of a text."""
    return normal_forms(raw_facts(text))


def fact_keys(facts: Column) -> Column:
    """All typed facts as one array; each names its kind."""

    def named(kind: str) -> Column:
        return F.transform(facts[kind], lambda fact: F.concat(F.lit(f"{kind} "), fact))

    return F.concat(*[named(kind) for kind in KINDS])


def entailed(keys: Column) -> Column:
    """The facts and what follows from them: a full date also states its day and month."""

    def parts(key: Column) -> Column:
        return F.array_compact(F.array(
            key,
            F.when(F.regexp_like(key, F.lit(r"^date \d{4}-")), F.concat(F.lit("date --"), F.substring(key, 11, 5))),
            F.when(F.regexp_like(key, F.lit(r"^date (?:\d{4}|-)-\d\d")), F.concat(F.lit("date ---"), F.substring(key, -2, 2))),
        ))

    return F.array_distinct(F.flatten(F.transform(keys, parts)))


def invented_facts(generated: Column, source: Column, granted: Sequence[str] = ()) -> Column:
    """Facts of the generated text that neither the source states nor a policy grants.

    All three are fact keys; ``granted`` are those of the policies' clauses.
    """
    allowed = F.array(*map(F.lit, granted)).cast("array<string>")
    return F.array_except(generated, F.concat(entailed(source), allowed))


def granted_facts(clauses: DataFrame, clause: str = "clause") -> list[str]:
    """The distinct facts of a policy's clauses, for the driver: a policy is a page of text."""
    keys = clauses.select(F.explode(fact_keys(typed_facts(clause))).alias("fact")).distinct()
    return sorted(row.fact for row in keys.collect())
