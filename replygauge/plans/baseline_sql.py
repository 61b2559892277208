"""SQL counterpart of the default scorer: summaries, replies and their scores from relations and lists.

It knows the facts of the ticket phrases and of the clauses by hand, and counts words,
weighs clauses and picks sentences on its own.
"""

from __future__ import annotations

from replygauge.functions import lexicon as lx
from replygauge.functions.policies import SUBJECTS, clause_rows
from replygauge.operators import baseline as b
from replygauge.operators import grounding as g
from replygauge.operators import summarise as m
from replygauge.plans import sql as s
from replygauge.plans.derive import TICKET_STATED, TICKET_TYPED

_DESC = "support_ticket_desc"
_TOKENS = "regexp_extract_all(lower({}), '[^\\s.,;:!?()\"]+')"
_BUCKET = "CAST('0x' || md5(t)[1:4] AS INTEGER)"

#: Facts of the clauses in their normal form, told by hand, by the clause's place.
CLAUSE_FACTS = {
    1: ["span 10 day"], 2: ["span 10 day"], 3: ["span 5-7 business day"], 5: ["span 7 business day"],
    6: ["money INR 100.00", "span 3 day"], 7: ["span 7 day"], 10: ["span 2 business day"], 13: ["span 3-5 business day"],
    14: ["span 5 business day"],
}


def _terms(x: str) -> str:
    stop = "[" + ", ".join(map(s.q, g.STOP_WORDS)) + "]"
    kept = f"list_filter(regexp_extract_all(lower({x}), '[a-z]{{4,}}'), lambda w: NOT list_contains({stop}, w))"
    return f"list_transform({kept}, lambda w: w[1:{g.STEM}])"


_CLAUSES = ", ".join(f"({i}, {p}, {c}, {s.q(text)})" for i, (p, c, text) in enumerate(clause_rows(), 1))
_SUBJECT = "CASE policy_no " + " ".join(f"WHEN {n} THEN {s.q(x)}" for n, x in SUBJECTS.items()) + " END"

SUMMARIES = f"""{s.TICKETS},
known AS (SELECT *, {s.classify(_DESC)} AS category, {s.refs(_DESC)} AS ids, {s.labels(_DESC, lx.RESOLUTIONS)} AS wanted,
  {s.has(f'lower({_DESC})', lx.PHRASE_FLAGS['escalation'])} AS escalation, {s.told(TICKET_TYPED, 'phrase')} AS facts,
  {s.distinct_in_order(f"regexp_extract_all({_DESC}, {s.q(lx.REF_PATTERN)})")} || {s.told(TICKET_STATED, 'phrase')} AS stated FROM tickets),
parts AS (SELECT *,
  CASE WHEN category = {s.q(lx.UNCLEAR)} THEN 'The ticket does not say clearly what the matter is' ELSE 'The ticket is about ' || lower(category) END
    || CASE WHEN len(wanted) > 0 THEN ' and asks for ' || array_to_string(wanted, ' and ') ELSE '' END
    || CASE WHEN escalation THEN '; the customer speaks of taking it further' ELSE '' END || '.' AS about,
  CASE WHEN len(stated) = 0 THEN 'It gives no order reference and no other fact.'
    ELSE 'It states ' || array_to_string(stated[1:{m.FACTS}], ', ') || CASE WHEN len(ids) = 0 THEN ' and gives no order reference.' ELSE '.' END
    END AS states FROM known),
fixed AS (SELECT *, {s.words('about')} + {s.words('states')} + {len(m.LEAD.split())} AS fixed FROM parts),
held AS (SELECT DISTINCT support_ticket_id, {_BUCKET} AS bucket FROM (SELECT support_ticket_id, unnest({_TOKENS.format(_DESC)}) AS t FROM tickets)),
weights AS (SELECT bucket, least(len(bin((SELECT count(*) FROM tickets) // count(*))), {m.RAREST}) AS weight FROM held GROUP BY bucket),
pieces AS (SELECT support_ticket_id, unnest(cut) AS piece, generate_subscripts(cut, 1) AS place
  FROM (SELECT support_ticket_id, regexp_split_to_array({_DESC}, '[.!?]+(?:\\s+|\\z)|\\n+') AS cut FROM tickets)),
worded AS (SELECT *, regexp_extract_all(piece, '\\S+') AS words FROM pieces WHERE regexp_matches(piece, '\\S')),
inside AS (SELECT DISTINCT support_ticket_id, place, {_BUCKET} AS bucket FROM (SELECT support_ticket_id, place, unnest({_TOKENS.format('piece')}) AS t FROM worded)),
weighed AS (SELECT support_ticket_id, place, sum(weight) AS total FROM inside JOIN weights USING (bucket) GROUP BY ALL),
scored AS (SELECT w.support_ticket_id, w.place, w.words, CAST(-floor(coalesce(total, 0) * 100 / (len(words) + 4)) AS BIGINT) AS rank
  FROM worded w LEFT JOIN weighed USING (support_ticket_id, place)),
ranked AS (SELECT support_ticket_id, list({{'place': place, 'words': words}} ORDER BY rank, place) AS pieces FROM scored GROUP BY ALL),
budgets AS (SELECT f.*, coalesce(pieces, []) AS pieces, greatest(6, {m.WORDS} - fixed) AS budget, {lx.SUMMARY_WORDS[0]} - fixed AS least
  FROM fixed f LEFT JOIN ranked USING (support_ticket_id)),
taken AS (SELECT *, list_reduce(pieces, lambda acc, x: CASE WHEN len(x.words) <= acc.room
    THEN {{'room': acc.room - len(x.words), 'got': list_append(acc.got, x), 'over': acc.over}}
    ELSE {{'room': acc.room, 'got': acc.got, 'over': coalesce(acc.over, x)}} END,
  {{'room': budget, 'got': CAST([] AS STRUCT(place BIGINT, words VARCHAR[])[]), 'over': CAST(NULL AS STRUCT(place BIGINT, words VARCHAR[]))}}) AS state
  FROM budgets),
filled AS (SELECT *, CASE WHEN budget - state.room < least AND state.over IS NOT NULL AND state.room > 0
    THEN list_append(state.got, {{'place': state.over.place, 'words': (state.over.words)[1:state.room]}}) ELSE state.got END AS got FROM taken),
quoted AS (SELECT *, array_to_string(list_transform(list_sort(got), lambda x: array_to_string(x.words, ' ')), '; ') AS extract FROM filled),
summaries AS (SELECT * EXCLUDE (pieces, state, got),
  {s.expanded(f"(about || CASE WHEN extract <> '' THEN {s.q(' ' + m.LEAD + ' ')} || extract || '.' ELSE '' END)")} || ' ' || states AS summarisation FROM quoted)"""

GROUNDED = f"""{SUMMARIES},
clauses(place, policy_no, clause_no, clause) AS (VALUES {_CLAUSES}),
clause_terms AS (SELECT place, unnest({_terms('clause')}) AS term FROM clauses),
sizes AS (SELECT place, count(*) AS size FROM clause_terms GROUP BY place),
counted AS (SELECT place, term, count(*) AS tf FROM clause_terms GROUP BY ALL),
postings AS (SELECT term, place, CAST(round(1000 * ln(1 + ((SELECT count(*) FROM clauses) - df + 0.5) / (df + 0.5))
    * (tf * {g.K1 + 1} / (tf + {g.K1} * ({1 - g.B} + {g.B} * size / (SELECT avg(size) FROM sizes))))) AS BIGINT) AS weight
  FROM counted JOIN (SELECT term, count(*) AS df FROM counted GROUP BY term) USING (term) JOIN sizes USING (place)),
asked AS (SELECT DISTINCT support_ticket_id, unnest({_terms('summarisation')}) AS term FROM summaries),
clause_scores AS (SELECT support_ticket_id, place, sum(weight) AS score FROM asked JOIN postings USING (term) GROUP BY ALL),
best AS (SELECT support_ticket_id, max(score) AS clause_score, arg_min(place, (-score, place)) AS place FROM clause_scores GROUP BY ALL),
grounded AS (SELECT summaries.*, coalesce(best.clause_score, 0) AS clause_score, clauses.* FROM summaries LEFT JOIN best USING (support_ticket_id)
  LEFT JOIN clauses ON clauses.place = best.place AND best.clause_score >= {g.LEAST_SCORE})"""

_BEYOND = s.minus("summary_wanted", f"coalesce({s.labels('clause', lx.RESOLUTIONS)}, [])")
CONSOLIDATED = f"""{GROUNDED},
read_again AS (SELECT *, {s.refs('summarisation')} AS summary_ids, {s.labels('summarisation', lx.RESOLUTIONS)} AS summary_wanted FROM grounded),
answers AS (SELECT *, {_BEYOND} AS beyond FROM read_again),
replies AS (SELECT *, concat_ws(chr(10) || chr(10), {s.q(lx.GREETING)},
    'Thank you for writing to us' || CASE WHEN clause IS NULL THEN '' ELSE ' about ' || {_SUBJECT} END
      || CASE WHEN len(summary_ids) > 0 THEN ' (' || array_to_string(summary_ids[1:{lx.MAX_REFS_SHOWN}], {s.q(lx.REF_JOINER)}) || ')' ELSE '' END || {s.q('. ' + b.OPENING)},
    CASE WHEN clause IS NULL THEN {s.q(b.UNCOVERED)} ELSE 'This is what applies to your case. ' || clause END,
    CASE WHEN clause IS NOT NULL AND len(beyond) > 0 THEN 'Your wish for ' || array_to_string(beyond, ' and ') || {s.q(f' {b.PASSED_ON}.')} END,
    CASE WHEN len(summary_ids) = 0 THEN {s.q(b.ASK)} ELSE {s.q(b.NOTED)} END, {s.q(b.CLOSING)}, {s.q(b.SIGN_OFF)}) AS response_generation FROM answers),
judged AS (SELECT *,
  {s.minus('ids', 'summary_ids')} || {s.minus('wanted', 'summary_wanted')} AS missing,
  {s.distinct_in_order('(ids || wanted || facts)')} AS need,
  {s.told(CLAUSE_FACTS, 'place')} AS clause_facts, {s.labels('response_generation', lx.RESOLUTIONS)} AS given,
  {s.has('lower(response_generation)', lx.DETAIL_REQUEST)} AND len(summary_ids) = 0 AS asks FROM replies),
points AS (SELECT *, list_filter(clause_facts, lambda f: starts_with(f, 'span ')) AS spans,
  CASE WHEN clause IS NOT NULL AND (len(summary_wanted) = 0 OR list_has_any(summary_wanted, given)) THEN 3 ELSE 2 END AS issue FROM judged),
consolidated AS (SELECT support_ticket_id, support_ticket_desc, summarisation, response_generation,
  CASE WHEN len({s.minus('summary_ids', 'ids')}) > 0 THEN 1 ELSE 3 END AS information_extraction_score,
  'Every reference and fact of the summary stands in the ticket.' AS information_extraction_reasoning,
  CASE WHEN len(missing) = 0 THEN 3 WHEN len(missing) * 2 <= len(need) THEN 2 ELSE 1 END AS field_coverage_score,
  CASE WHEN len(need) = 0 THEN 'The ticket names nothing that an agent needs.' WHEN len(missing) > 0 THEN 'Missing: ' || array_to_string(missing, ', ') || '.'
    ELSE 'Carries over ' || array_to_string(need, ', ') || '.' END AS field_coverage_reasoning,
  issue AS issue_addressal_score,
  CASE WHEN clause IS NULL THEN 'No clause governs the issue; it is passed on.' WHEN issue = 3 THEN 'Answers what is asked for with one clause.'
    ELSE 'Leaves what is asked for unanswered.' END AS issue_addressal_reasoning,
  CASE WHEN len(spans) > 0 OR asks THEN 3 ELSE 2 END AS resolution_clarity_score,
  CASE WHEN len(spans) > 0 THEN 'Names ' || array_to_string(spans, ', ') || '.' WHEN asks THEN 'Asks for what is missing.'
    ELSE 'Names neither a time nor a next step for the customer.' END AS resolution_clarity_reasoning,
  issue + CASE WHEN len(spans) > 0 OR asks THEN 3 ELSE 2 END AS overall_score,
  CASE WHEN issue = 3 AND (len(spans) > 0 OR asks) THEN 'Safe to send.' ELSE 'A person should read it first.' END AS overall_reasoning FROM points)"""
