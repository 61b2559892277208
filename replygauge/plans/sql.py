"""SQL text shared by the counterparts: derived tables and rule expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from replygauge.functions import lexicon as lx
from replygauge.functions.policies import GRANTED
from replygauge.plans.derive import (
    REPLY_CODES, REPLY_DETAILS, REPLY_ENDS, REPLY_PHRASES, REPLY_SPANS, TICKET_FACTS, TICKET_PHRASES,
    TICKET_SPANS, TICKET_TYPED, REPLY_TYPED,
)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick(values: Sequence[str], index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values))
    return f"(CASE ({index}) % {len(values)} {cases} END)"


TICKETS = (
    "tickets AS (SELECT CAST(doc_id AS VARCHAR) AS support_ticket_id, "
    f"text || chr(10) || {pick(TICKET_PHRASES, 'doc_id')} AS support_ticket_desc, "
    f"doc_id % {len(TICKET_PHRASES)} AS phrase FROM documents)"
)
PAIRS = f"""
turns AS (
  SELECT a.conv_id, a.turn, a.text AS asked, b.text AS answered, a.conv_id + a.turn AS number
  FROM conversations a JOIN conversations b
    ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND a.role = 'user' AND b.role = 'assistant'),
pairs AS (
  SELECT conv_id || '-' || turn AS pair_id,
    asked || chr(10) || {pick(TICKET_PHRASES, 'number')} AS source,
    CASE WHEN number % 4 = 0 THEN '' ELSE 'Dear Customer,' || chr(10) || chr(10) END
      || answered || chr(10) || {pick(REPLY_PHRASES, 'conv_id * 7 + turn')} || {pick(REPLY_ENDS, 'number')} AS reply,
    number % {len(TICKET_PHRASES)} AS asked_phrase, (conv_id * 7 + turn) % {len(REPLY_PHRASES)} AS phrase
  FROM turns)"""


def words(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '\\S+')) AS BIGINT)"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def classify(x: str) -> str:
    rules = " ".join(f"WHEN {has(f'lower({x})', p)} THEN {q(label)}" for p, label in lx.CATEGORY_RULES)
    return (
        f"(CASE {rules} WHEN {words(x)} < {lx.MIN_CLEAR_WORDS} THEN {q(lx.UNCLEAR)} "
        f"ELSE {q(lx.DEFAULT_CATEGORY)} END)"
    )


def distinct_in_order(items: str) -> str:
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


def refs(x: str, pattern: str = lx.REF_PATTERN) -> str:
    found = f"list_transform(regexp_extract_all({x}, {q(pattern)}), lambda r: replace(upper(r), ' ', '-'))"
    return distinct_in_order(found)


def order_refs(x: str) -> str:
    return f"coalesce(nullif(array_to_string(list_slice({refs(x)}, 1, 2), ' OR '), ''), 'NOT_PROVIDED')"


def flags(x: str, named: Mapping[str, str] = lx.PHRASE_FLAGS) -> str:
    return ", ".join(f"{has(f'lower({x})', p)} AS {name}" for name, p in named.items())


def labels(x: str, rules: Sequence[tuple[str, str]]) -> str:
    items = ", ".join(f"CASE WHEN {has(f'lower({x})', p)} THEN {q(label)} END" for p, label in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def told(named: Mapping[int, Sequence[str]], index: str) -> str:
    """Labels told by hand for a phrase; the counterpart knows no pattern."""
    cases = " ".join(f"WHEN {i} THEN [{', '.join(map(q, v))}]" for i, v in named.items() if v)
    return f"(CASE {index} {cases} ELSE CAST([] AS VARCHAR[]) END)"


def spans() -> str:
    return told(REPLY_SPANS, "phrase")


def asked_spans() -> str:
    return told(TICKET_SPANS, "asked_phrase")


def off_policy() -> str:
    allowed = "[" + ", ".join(map(q, lx.POLICY_TIMEFRAMES)) + "]"
    return f"list_filter({spans()}, lambda s: NOT list_contains({allowed}, s))"


def codes() -> str:
    return told(REPLY_CODES, "phrase")


def details() -> str:
    return told(REPLY_DETAILS, "phrase")


def facts(index: str, kind: str) -> str:
    place = list(lx.FACT_PATTERNS).index(kind)
    return told({i: known[place] for i, known in TICKET_FACTS.items()}, index)


def expanded(x: str) -> str:
    """Each term of the shorthand written out after its first use."""
    for term, meaning in lx.SHORTHAND.items():
        x = f"regexp_replace({x}, {q(rf'\A(?s)(.*?)\b((?i){term})([^\w-]|-\D|\z)')}, {q(rf'\1\2 ({meaning})\3')})"
    return x


def minus(left: str, right: str) -> str:
    return f"list_filter({left}, lambda y: NOT list_contains({right}, y))"


def joined(items: str) -> str:
    return f"array_to_string(list_sort({items}), ', ')"


GRANTED_SQL = "[" + ", ".join(map(q, GRANTED)) + "]"


def starting(items: str, kind: str, yes: bool = True) -> str:
    return f"list_filter({items}, lambda f: {'' if yes else 'NOT '}starts_with(f, {q(kind + ' ')}))"


def entailed(items: str) -> str:
    """A date with a year also states its day and month, and one with a month its day."""
    full = f"list_transform(list_filter({items}, lambda f: regexp_matches(f, '^date \\d{{4}}-')), lambda f: 'date --' || f[-5:])"
    days = f"list_transform(list_filter({items}, lambda f: regexp_matches(f, '^date (\\d{{4}}|-)-\\d\\d')), lambda f: 'date ---' || f[-2:])"
    return f"({items} || {full} || {days})"


def both(left: str, right: str) -> str:
    return f"len(list_filter({left}, lambda y: list_contains({right}, y)))"


AUDIT = f"""{PAIRS},
elements AS (
  SELECT *, {refs('source')} AS source_refs, {refs('reply')} AS reply_refs,
    {labels('source', lx.RESOLUTIONS)} AS wanted, {labels('reply', lx.RESOLUTIONS)} AS given,
    {told(TICKET_TYPED, 'asked_phrase')} AS source_facts, {told(REPLY_TYPED, 'phrase')} AS reply_facts, {codes()} AS codes,
    len({details()}) > 0 AS asks
  FROM pairs),
typed AS (
  SELECT *, {starting('reply_facts', 'span')} AS reply_spans,
    {minus(starting('reply_facts', 'span'), GRANTED_SQL)} AS off_spans,
    {minus(minus(starting('reply_facts', 'span', False), entailed('source_facts')), GRANTED_SQL)} AS invented_facts
  FROM elements),
parts AS (
  SELECT *, len({minus('reply_refs', 'source_refs')}) > 0 OR len(invented_facts) > 0 AS invented,
    CASE WHEN len(source_refs) + len(wanted) + len(source_facts) = 0 THEN 1.0 ELSE
      ({both('source_refs', 'reply_refs')} + {both('wanted', 'given')} + {both('source_facts', entailed('reply_facts'))})
      / (len(source_refs) + len(wanted) + len(source_facts)) END AS share,
    len(wanted) = 0 OR list_has_any(wanted, given) AS answered,
    asks AND len(source_refs) = 0 AS asks_details
  FROM typed),
scored AS (
  SELECT *,
    CASE WHEN invented THEN 1 ELSE 3 END AS information_extraction_score,
    CASE WHEN share >= 1 THEN 3 WHEN share >= 0.5 THEN 2 ELSE 1 END AS field_coverage_score,
    CASE WHEN invented OR len(off_spans) > 0 OR len(codes) > 0 THEN 1 WHEN answered THEN 3 ELSE 2 END
      AS issue_addressal_score,
    CASE WHEN len(reply_spans) > 0 OR asks_details THEN 3 ELSE 2 END AS resolution_clarity_score
  FROM parts),
audit AS (
  SELECT *, issue_addressal_score + resolution_clarity_score AS overall_score,
    {has('lower(source)', lx.PHRASE_FLAGS['escalation'])} AS escalation,
    len(source_refs) > 0 AS has_ref, len(codes) > 0 AS policy_flag
  FROM scored)"""
