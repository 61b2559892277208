"""Text rules as column expressions: profile, classify, extract, flag.

All of them run inside the JVM. Patterns are written so that Java's regular
expressions treat them the way Python's do: ``(?d)`` lets only a line feed end a
line, ``(?U)`` takes whitespace from Unicode.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx

ColumnOrName = Column | str

# Characters str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_MARKDOWN = r"(?dm)^ {0,3}#{1,6} |\*\*|__|`|\]\("
_BULLET = r"(?dm)^\s*([-*•]|\d+[.)])\s"
_HEADING = r"(?dm)^ {0,3}#{1,6} |^[^\n]{1,60}:$"
_META = set(r".^$*+?{}[]()|\\")


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


# -- whitespace and words ---------------------------------------------------


def strip(text: ColumnOrName) -> Column:
    """Drop leading and trailing whitespace of every kind, not only spaces."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def is_blank(text: ColumnOrName) -> Column:
    """True for null, empty and whitespace-only text. Never null."""
    return ~F.coalesce(F.regexp_like(as_column(text), F.lit(r"(?U)[^\s\x1c-\x1f]")), F.lit(False))


def word_count(text: ColumnOrName) -> Column:
    """Number of whitespace-separated words; 0 for null."""
    return F.coalesce(F.regexp_count(as_column(text), F.lit(r"(?U)[\S&&[^\x1c-\x1f]]+")), F.lit(0))


def has_words(text: ColumnOrName, n: int) -> Column:
    """Does the text have at least n words? Reads no further than the n-th."""
    word, gap = r"[\S&&[^\x1c-\x1f]]+", r"[\s\x1c-\x1f]+"
    pattern = rf"(?U)\A[\s\x1c-\x1f]*(?:{word}{gap}){{{n - 1}}}[\S&&[^\x1c-\x1f]]"
    return F.coalesce(F.regexp_like(as_column(text), F.lit(pattern)), F.lit(False))


def sentence_count(text: ColumnOrName) -> Column:
    """Sentences end in ``.!?`` before whitespace or the end, so 3.5 does not split."""
    parts = F.split(as_column(text), r"[.!?]+(\s+|$)")
    return F.size(F.filter(parts, lambda part: F.regexp_like(part, F.lit(r"\S"))))


# -- phrase matching --------------------------------------------------------


def _alternatives(pattern: str) -> list[str]:
    """Split a pattern at the bars that lie outside every group and character class."""
    parts, depth, in_class, start, i = [], 0, False, 0, 0
    while i < len(pattern):
        char = pattern[i]
        if char == "\\":
            i += 1
        elif in_class:
            # a bracket right after the opening, or after ^, is a member of the class
            in_class = not (char == "]" and i > opened)
        elif char == "[":
            in_class, opened = True, i + 1 + pattern.startswith("^", i + 1)
        elif char == "(":
            depth += 1
        elif char == ")":
            depth -= 1
        elif char == "|" and depth == 0:
            parts.append(pattern[start:i])
            start = i + 1
        i += 1
    # unbalanced, as far as can be told here: left to the regular expression
    return [pattern] if depth or in_class else [*parts, pattern[start:]]


def _literal_start(pattern: str) -> str:
    """The plain text every match of one alternative must begin with."""
    end = next((i for i, char in enumerate(pattern) if char in _META), len(pattern))
    if end < len(pattern) and pattern[end] in "?*{":
        end -= 1
    return pattern[:end]


def matches(low: ColumnOrName, pattern: str) -> Column:
    """Does lower-cased text contain the pattern anywhere?

    Plain phrases become byte-wise ``contains``, several times cheaper than a
    regular expression. The rest is tried only where its literal start occurs.
    """
    low = as_column(low)
    terms = []
    for alternative in _alternatives(pattern):
        start = _literal_start(alternative)
        if start == alternative:
            terms.append(low.contains(alternative))
            continue
        regex = F.regexp_like(low, F.lit("(?d)" + alternative))
        terms.append(low.contains(start) & regex if len(start) > 2 else regex)
    return reduce(or_, terms)


def first_label(low: ColumnOrName, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first rule that matches, null if none does."""
    head, *tail = rules
    case = F.when(matches(low, head[0]), F.lit(head[1]))
    for pattern, label in tail:
        case = case.when(matches(low, pattern), F.lit(label))
    return case


def all_labels(low: ColumnOrName, rules: Iterable[tuple[str, str]]) -> Column:
    """Array of the labels of all rules that match, in rule order."""
    return F.array_compact(F.array(*[F.when(matches(low, p), F.lit(label)) for p, label in rules]))


def classify(
    text: ColumnOrName,
    rules: Sequence[tuple[str, str]] = lx.CATEGORY_RULES,
    min_words: int = lx.MIN_CLEAR_WORDS,
    unclear: str = lx.UNCLEAR,
    default: str = lx.DEFAULT_CATEGORY,
    low: Column | None = None,
) -> Column:
    """Category of a text: first matching rule, else unclear if short, else the default.

    ``low``: the lower-cased text, empty for null, where it is a column already.
    """
    text = F.coalesce(as_column(text), F.lit(""))
    fallback = F.when(has_words(text, min_words), F.lit(default)).otherwise(F.lit(unclear))
    return F.coalesce(first_label(F.lower(text) if low is None else low, rules), fallback)


def phrase_flags(text: ColumnOrName, flags: Mapping[str, str] = lx.PHRASE_FLAGS) -> dict[str, Column]:
    """One boolean column per named flag, for ``withColumns``."""
    low = F.lower(F.coalesce(as_column(text), F.lit("")))
    return {name: matches(low, pattern) for name, pattern in flags.items()}


def label_by_phrase(
    text: ColumnOrName,
    phrases: Sequence[tuple[str, str]] = lx.STAGE_PHRASES,
    default: str = lx.UNKNOWN_STAGE,
) -> Column:
    """Collapse whitespace, lower-case, take the label of the first phrase found."""
    flat = F.regexp_replace(F.lower(as_column(text)), r"(?U)\s+", " ")
    return F.coalesce(first_label(flat, phrases), F.lit(default))


def between_markers(
    text: ColumnOrName,
    start: str = lx.TICKET_MARKER,
    ends: Sequence[str] = tuple(lx.TICKET_END_MARKERS),
) -> Column:
    """Text after the start marker up to the first end marker; the whole text without one."""
    text = as_column(text)
    rest = F.regexp_extract(
        text,
        "(?s)" + _quote(start) + r"\s*(.*?)(?:" + "|".join([*map(_quote, ends), r"\z"]) + ")",
        1,
    )
    return strip(F.when(text.contains(start), rest).otherwise(text))


def _quote(literal: str) -> str:
    return "".join("\\" + char if char in _META else char for char in literal)


# -- identifiers ------------------------------------------------------------


def ref_ids(text: ColumnOrName, pattern: str = lx.REF_PATTERN) -> Column:
    """Distinct references in first-seen order, upper-cased, spaces as hyphens.

    Null text has none.
    """
    found = F.regexp_extract_all(F.coalesce(as_column(text), F.lit("")), F.lit(pattern), F.lit(0))
    return F.array_distinct(F.transform(found, lambda ref: F.translate(F.upper(ref), " ", "-")))


def order_refs(
    text: ColumnOrName, pattern: str = lx.REF_PATTERN, limit: int = lx.MAX_REFS_SHOWN
) -> Column:
    """The first references joined for display, or the not-provided sentinel."""
    return shown_refs(ref_ids(text, pattern), limit)


def shown_refs(ids: ColumnOrName, limit: int = lx.MAX_REFS_SHOWN) -> Column:
    """The same from references already extracted."""
    shown = F.array_join(first_n(ids, limit), lx.REF_JOINER)
    return F.when(shown == "", F.lit(lx.NOT_PROVIDED)).otherwise(shown)


def first_n(values: ColumnOrName, n: int) -> Column:
    return F.slice(as_column(values), 1, n)


def invented_refs(source: ColumnOrName, generated: ColumnOrName, pattern: str = lx.REF_PATTERN) -> Column:
    """References of the generated text that the source does not hold."""
    return F.array_except(ref_ids(generated, pattern), ref_ids(source, pattern))


def is_ambiguous(text: ColumnOrName, pattern: str = lx.REF_PATTERN) -> Column:
    return F.size(ref_ids(text, pattern)) > 1


# -- facts and time spans ---------------------------------------------------

_COUNT = rf"(?:\d+(?:[.,]\d+)?|{'|'.join(lx.NUMBER_WORDS)}|{lx.VAGUE_COUNTS})"
TIMEFRAME = (
    rf"(?<![\d.,a-z]){_COUNT}(?:\s*(?:to|or|-|–)\s*{_COUNT})?[\s-]*(?:(?:business|working|calendar)\s+)?"
    rf"(?:{'|'.join(lx.TIME_UNITS.values())})(?![a-z])"
)


def timeframes(text: ColumnOrName, pattern: str = TIMEFRAME) -> Column:
    """Time spans of a text, normalised: ``five to 7 working days`` is ``5-7 business day``."""
    low = F.lower(F.coalesce(as_column(text), F.lit("")))
    found = F.regexp_extract_all(low, F.lit(pattern), F.lit(0))

    def normalise(span: Column) -> Column:
        span = F.regexp_replace(span, r"\s*(\bto\b|\bor\b|-|–)\s*(?=[\dotfsent])", "-")
        for word, digits in lx.NUMBER_WORDS.items():
            span = F.regexp_replace(span, rf"\b{word}\b", digits)
        span = F.regexp_replace(span, r"\b(working)\b", "business")
        for unit, forms in lx.TIME_UNITS.items():
            span = F.regexp_replace(span, rf"(?<![a-z])(?:{forms})$", unit)
        return F.regexp_replace(F.regexp_replace(span, r"(\d)[\s-]*([a-z])", r"$1 $2"), r"\s+", " ")

    return F.array_distinct(F.transform(found, normalise))


def off_policy_timeframes(text: ColumnOrName, allowed: Sequence[str] = tuple(lx.POLICY_TIMEFRAMES)) -> Column:
    """Time spans no policy grants."""
    return F.array_except(timeframes(text), F.array(*map(F.lit, allowed)))


def hard_facts(text: ColumnOrName, patterns: Mapping[str, str] = lx.FACT_PATTERNS) -> Column:
    """Struct of arrays, one per kind of fact: amounts, dates, waits, transactions."""
    low = F.lower(F.coalesce(as_column(text), F.lit("")))
    return F.struct(*[
        F.array_distinct(F.regexp_extract_all(low, F.lit(pattern), F.lit(0))).alias(kind)
        for kind, pattern in patterns.items()
    ])


def all_facts(text: ColumnOrName, patterns: Mapping[str, str] = lx.FACT_PATTERNS) -> Column:
    """All facts and references of a text in one array."""
    facts = hard_facts(text, patterns)
    return F.array_distinct(F.concat(*[facts[kind] for kind in patterns], ref_ids(text)))


def requested_resolution(text: ColumnOrName, rules: Sequence[tuple[str, str]] = tuple(lx.RESOLUTIONS)) -> Column:
    """What is asked for; an empty array if nothing is."""
    return all_labels(F.lower(F.coalesce(as_column(text), F.lit(""))), rules)


# -- form of generated text -------------------------------------------------


def reply_form(text: ColumnOrName, words: tuple[int, int] = lx.REPLY_WORDS) -> dict[str, Column]:
    """Boolean columns: greeting, sign-off, length band, no markdown."""
    text = F.coalesce(as_column(text), F.lit(""))
    return {
        "has_greeting": text.startswith(lx.GREETING),
        "has_sign_off": F.regexp_like(text, F.lit(r"(?i)support team[.\s]*\z")),
        "length_ok": word_count(text).between(*words),
        "plain_text": ~F.regexp_like(text, F.lit(_MARKDOWN)),
    }


def summary_form(
    text: ColumnOrName,
    words: tuple[int, int] = lx.SUMMARY_WORDS,
    sentences: tuple[int, int] = lx.SUMMARY_SENTENCES,
) -> dict[str, Column]:
    """Boolean columns: length band, sentence band, no bullets, no headings."""
    text = F.coalesce(as_column(text), F.lit(""))
    return {
        "words_ok": word_count(text).between(*words),
        "sentences_ok": sentence_count(text).between(*sentences),
        "no_bullets": ~F.regexp_like(text, F.lit(_BULLET)),
        "no_headings": ~F.regexp_like(text, F.lit(_HEADING)),
    }


def form_ok(form: Mapping[str, Column]) -> Column:
    return reduce(and_, form.values())


def violations(text: ColumnOrName, rules: Sequence[tuple[str, str]] = tuple(lx.PROHIBITED)) -> Column:
    """Codes of the prohibitions a reply breaks, as an array."""
    return all_labels(F.lower(F.coalesce(as_column(text), F.lit(""))), rules)


def requested_details(reply: ColumnOrName, pattern: str = lx.DETAIL_REQUEST, kinds: Sequence[tuple[str, str]] = tuple(lx.DETAILS)) -> Column:
    """The kinds of details a reply asks for; an empty array if it asks for none."""
    low = F.lower(F.coalesce(as_column(reply), F.lit("")))
    return F.when(F.regexp_like(low, F.lit("(?d)" + pattern)), all_labels(low, kinds)).otherwise(F.array().cast("array<string>"))


def asks_too_much(reply: ColumnOrName, most: int = lx.MAX_DETAILS) -> Column:
    return F.size(requested_details(reply)) > most


def asks_for_details(reply: ColumnOrName, source: ColumnOrName, pattern: str = lx.DETAIL_REQUEST) -> Column:
    """Does the reply ask for details where the source holds no reference?"""
    low = F.lower(F.coalesce(as_column(reply), F.lit("")))
    return F.regexp_like(low, F.lit("(?d)" + pattern)) & (F.size(ref_ids(source)) == 0)


def expand_shorthand(
    df: DataFrame, column: str, into: str, terms: Mapping[str, str] = lx.SHORTHAND
) -> DataFrame:
    """Add the text with each term written out after its first use.

    A term that starts an identifier, such as TXN-77, is no use of it. One projection per term, so that a text without the term is passed on and
    not searched.
    """
    low = f"__{into}_low"
    df = df.withColumns({low: F.lower(column), into: F.col(column)})
    for term, meaning in terms.items():
        first_use = F.regexp_replace(into, rf"\A(?s)(.*?)\b((?i){_quote(term)})([^\w-]|-\D|\z)", f"$1$2 ({meaning})$3")
        df = df.withColumn(into, F.when(F.col(low).contains(term.lower()), first_use).otherwise(F.col(into)))
    return df.drop(low)


def is_generic_reasoning(
    reasoning: ColumnOrName, source: ColumnOrName, praise: str = lx.GENERIC_PRAISE
) -> Column:
    """Banned praise, or not one fact of the audited text."""
    low = F.lower(F.coalesce(as_column(reasoning), F.lit("")))
    facts = F.transform(all_facts(source), lambda fact: F.lower(fact))
    # the lower-cased text is bound once and looked at for each fact
    cited = F.exists(F.array(low), lambda text: F.exists(facts, lambda fact: F.contains(text, fact)))
    return matches(low, praise) | ~cited
