"""Queries over prompts, structured replies and numbers in text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.functions import numeric
from replygauge.functions.replies import ReplySchema, Score, Text, overall_matches, parse_replies
from replygauge.operators.prompting import assemble_messages, close_prompt, last_messages, render
from replygauge.operators.prompting import last_message as last_of_role
from replygauge.operators.stages import SUMMARISE
from replygauge.plans import sql as s
from replygauge.plans.derive import pick, tickets
from replygauge.plans.registry import query
from replygauge.sources.tables import spread, table

_SYSTEM = "You are a triage analyst."


@query(f"""
WITH {s.TICKETS}, p AS (SELECT support_ticket_id,
  'Ticket: "' || support_ticket_desc || '"' || chr(10) || 'Summary:' || chr(10) || {s.q(lx.NO_FENCE)} AS prompt FROM tickets)
SELECT support_ticket_id, length(prompt) AS prompt_chars, sha256(prompt) AS prompt_sha FROM p""")
def render_prompt(spark: SparkSession, folder: str) -> DataFrame:
    prompt = close_prompt(render(SUMMARISE.template, {"ticket": "support_ticket_desc"}))
    prompts = tickets(spark, folder).select("support_ticket_id", prompt.alias("prompt"))
    return prompts.select(
        "support_ticket_id",
        F.length("prompt").cast("bigint").alias("prompt_chars"),
        F.sha2("prompt", 256).alias("prompt_sha"),
    )


@query(f"""
WITH {s.TICKETS}
SELECT support_ticket_id, CAST(2 AS BIGINT) AS n_messages, {s.q(_SYSTEM)} AS last_system,
  sha256(support_ticket_desc) AS last_user_sha, '' AS last_assistant FROM tickets""")
def assembled_messages(spark: SparkSession, folder: str) -> DataFrame:
    messages = tickets(spark, folder).select(
        "support_ticket_id", assemble_messages(F.lit(_SYSTEM), "support_ticket_desc").alias("messages")
    )
    return messages.select(
        "support_ticket_id",
        F.size("messages").cast("bigint").alias("n_messages"),
        last_of_role("messages", "system").alias("last_system"),
        F.sha2(last_of_role("messages", "user"), 256).alias("last_user_sha"),
        last_of_role("messages", "assistant").alias("last_assistant"),
    )


@query("""
SELECT conv_id, coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '') AS last_message
FROM conversations GROUP BY conv_id""")
def last_message(spark: SparkSession, folder: str) -> DataFrame:
    return last_messages(table(spark, folder, "conversations"), "assistant")


# Replies built from the event properties, one form per event id modulo their number.
_SCHEMA = ReplySchema((Score("first"), Score("second"), Score("total", 2, 6), Text("why")))
_FORMS = [
    "{0}",
    "```json\n{0}\n```",
    "```json\n{0}",
    "{0} I hope this helps.",
    "I cannot produce that as JSON.",
    "  \n",
    '{{"output":{{"first":2,"why":"cut off',
    '{{"first":2,"second":2,"total":4,"why":"bare"}}',
    '{{"output":{{"first":2,"second":2,"total":4,"why":"x","extra":1}}}}',
    '{{"output":{{"first":"2","second":2,"total":4,"why":"x"}}}}',
    '{{"output":{{"first":2.0,"second":1.5,"total":4,"why":"x"}}}}',
    '{{"output":{{"first":2.0,"second":2,"total":4,"why":"x"}}}}',
    '{{"output":{{"first":2,"second":2,"total":9,"why":"x"}}}}',
    '{{"output":{{"first":2,"second":2,"why":"x"}}}}',
    '{{"output":{{"first":2,"second":2,"total":4,"why":7}}}}',
    '{{"output":null}}',
]


def _sql_forms() -> str:
    cases = []
    for i, form in enumerate(_FORMS):
        before, _, after = form.partition("{0}")
        if "{0}" in form:
            text = f"{s.q(before)} || body || {s.q(after)}"
        else:
            text = s.q(form.format())
        cases.append(f"WHEN {i} THEN {text}")
    return f"CASE event_id % {len(_FORMS)} {' '.join(cases)} END"


_RAW_SQL = f"""
k AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
b AS (SELECT event_id, '{{"output":{{"first":' || (k % 4) || ',"second":' || (k // 4 % 3 + 1) || ',"total":'
  || (k % 4 + k // 4 % 3 + 1 + CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END) || ',"why":"' || event_type || '"}}}}' AS body FROM k),
raws AS (SELECT event_id, {_sql_forms()} AS raw FROM b),
bodies AS (SELECT event_id, regexp_replace(regexp_replace(raw, '\\A\\s+|\\s+\\z', '', 'g'),
  '(?s)\\A```[A-Za-z]*\\s*(.*?)\\s*```\\z', '\\1') AS body FROM raws),
j AS (SELECT *, CASE WHEN json_valid(body) THEN body END AS doc FROM bodies),
f AS (SELECT *, json_type(doc, '$.output') AS kind, json_keys(doc, '$.output') AS keys,
  json_type(doc, '$.output.first') AS t1, json_type(doc, '$.output.second') AS t2,
  json_type(doc, '$.output.total') AS t3, json_type(doc, '$.output.why') AS t4,
  TRY_CAST(json_extract_string(doc, '$.output.first') AS DOUBLE) AS v1,
  TRY_CAST(json_extract_string(doc, '$.output.second') AS DOUBLE) AS v2,
  TRY_CAST(json_extract_string(doc, '$.output.total') AS DOUBLE) AS v3,
  json_extract_string(doc, '$.output.why') AS why FROM j),
c AS (SELECT *, CASE
  WHEN body = '' THEN 'empty'
  WHEN starts_with(body, '```') THEN 'open_fence'
  WHEN NOT starts_with(body, '{{') THEN 'prose'
  WHEN doc IS NULL AND regexp_matches(body, '\\}}\\}} [^}}]+\\z') THEN 'trailing_text'
  WHEN doc IS NULL AND NOT ends_with(body, '}}') THEN 'truncated'
  WHEN doc IS NULL THEN 'malformed'
  WHEN coalesce(kind, 'NULL') <> 'OBJECT' OR list_sort(keys) <> ['first', 'second', 'total', 'why'] THEN 'wrong_shape'
  WHEN t4 <> 'VARCHAR' OR t1 = 'VARCHAR' OR t2 = 'VARCHAR' OR t3 = 'VARCHAR'
    OR v1 <> floor(v1) OR v2 <> floor(v2) OR v3 <> floor(v3) THEN 'bad_type'
  WHEN v1 NOT BETWEEN 1 AND 3 OR v2 NOT BETWEEN 1 AND 3 OR v3 NOT BETWEEN 2 AND 6 THEN 'out_of_range'
  ELSE 'ok' END AS reply_class FROM f)"""


def _event_replies(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    first, second = F.pmod("k", F.lit(4)), F.pmod(F.floor(F.col("k") / 4), F.lit(3)) + 1
    total = first + second + F.when(F.pmod("k", F.lit(10)) == 0, 1).otherwise(0)
    body = F.concat(
        F.lit('{"output":{"first":'), first, F.lit(',"second":'), second, F.lit(',"total":'), total,
        F.lit(',"why":"'), F.col("event_type"), F.lit('"}}'),
    )
    forms = [
        F.concat(F.lit(form.partition("{0}")[0]), F.col("body"), F.lit(form.partition("{0}")[2]))
        if "{0}" in form else F.lit(form.format())
        for form in _FORMS
    ]
    form_number = F.pmod("event_id", F.lit(len(_FORMS)))
    raw = F.when(form_number == 0, forms[0])
    for i, form in enumerate(forms[1:], start=1):
        raw = raw.when(form_number == i, form)
    events = spread(table(spark, folder, "events").select("event_id", "event_type", "props")).select(
        "event_id", "event_type", k.alias("k")
    )
    raws = events.select("event_id", body.alias("body")).select("event_id", raw.alias("raw"))
    return parse_replies(raws, "raw", _SCHEMA)


@query(f"""
WITH {_RAW_SQL}
SELECT event_id, reply_class,
  CASE WHEN reply_class = 'ok' THEN CAST(v1 AS INTEGER) END AS first,
  CASE WHEN reply_class = 'ok' THEN CAST(v2 AS INTEGER) END AS second,
  CASE WHEN reply_class = 'ok' THEN CAST(v3 AS INTEGER) END AS total,
  CASE WHEN reply_class = 'ok' THEN why END AS why,
  CASE WHEN reply_class = 'ok' THEN v1 + v2 = v3 END AS sum_ok
FROM c""")
def parse_reply(spark: SparkSession, folder: str) -> DataFrame:
    return _event_replies(spark, folder).select(
        "event_id", "reply_class", "reply.*", overall_matches("reply", "first", "second", "total").alias("sum_ok")
    )


@query(f"""
WITH {_RAW_SQL}
SELECT reply_class, count(*) AS n FROM c GROUP BY reply_class""")
def failure_classes(spark: SparkSession, folder: str) -> DataFrame:
    return _event_replies(spark, folder).groupBy("reply_class").agg(F.count(F.lit(1)).alias("n"))


_NUMBER_ENDS = ["", " ", "e0", "f", "d", "_0", ".", "abc"]
_NUMBER_STARTS = ["", " ", "+", "-", "nan", "inf"]


@query(f"""
WITH t AS (SELECT event_id, {s.pick(_NUMBER_STARTS, 'event_id // 8')} || value || {s.pick(_NUMBER_ENDS, 'event_id')} AS v FROM events),
n AS (SELECT event_id, CASE WHEN regexp_matches(v, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
  THEN TRY_CAST(ltrim(trim(v), '+') AS DOUBLE) END AS number FROM t)
SELECT event_id, number, coalesce(number BETWEEN 1 AND 50, false) AS is_in_range FROM n""")
def numeric_rules(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat(
        pick(_NUMBER_STARTS, F.floor(F.col("event_id") / 8)), F.col("value").cast("string"),
        pick(_NUMBER_ENDS, F.col("event_id")),
    )
    values = table(spark, folder, "events").select("event_id", text.alias("v"))
    return values.select(
        "event_id", numeric.to_number("v").alias("number"), numeric.in_range("v", 1, 50).alias("is_in_range")
    )
