"""Queries over ticket and document text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.functions import text as tx
from replygauge.operators import report
from replygauge.plans import sql as s
from replygauge.plans.derive import pick, reply_pairs, tickets
from replygauge.plans.registry import query
from replygauge.sources.tables import spread, table

DIGITS = r"\d{4,}"


def _long(*names: str) -> list:
    return [F.col(name).cast("bigint").alias(name) for name in names]


@query(f"""
WITH w AS (SELECT lang, doc_id, {s.words('text')} AS words FROM documents),
e AS (SELECT *, min(words) OVER (PARTITION BY lang) AS lo, max(words) OVER (PARTITION BY lang) AS hi FROM w)
SELECT lang, count(*) AS n, min(words) AS min_words, max(words) AS max_words,
  round(avg(words), 6) AS mean_words, quantile_cont(words, 0.5) AS median_words,
  count(*) FILTER (WHERE words < 20) AS under_20, count(*) FILTER (WHERE words > 120) AS over_120,
  min(doc_id) FILTER (WHERE words = lo) AS shortest, min(doc_id) FILTER (WHERE words = hi) AS longest,
  round(count(*) * 2.5 / 60, 6) AS decode_hours
FROM e GROUP BY lang""")
def text_profile(spark: SparkSession, folder: str) -> DataFrame:
    profile = report.text_profile(spread(table(spark, folder, "documents").select("lang", "doc_id", "text")), "text", "doc_id", ["lang"])
    return profile.select(
        "lang", "n", *_long("min_words", "max_words"), F.round("mean_words", 6).alias("mean_words"),
        "median_words", "under_20", "over_120", "shortest", "longest",
        F.round(report.decode_hours("n").cast("double"), 6).alias("decode_hours"),
    )


@query(f"""
WITH {s.TICKETS}
SELECT {s.classify('support_ticket_desc')} AS category, count(*) AS n FROM tickets GROUP BY 1""")
def rule_classify(spark: SparkSession, folder: str) -> DataFrame:
    category = tx.classify("support_ticket_desc").alias("category")
    return tickets(spark, folder).select(category).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {s.TICKETS}
SELECT support_ticket_id, {s.classify('support_ticket_desc')} AS category,
  {s.order_refs('support_ticket_desc')} AS order_refs, len({s.refs('support_ticket_desc')}) AS n_refs,
  len({s.refs('support_ticket_desc')}) > 1 AS is_ambiguous,
  {s.words('support_ticket_desc')} AS words, {s.flags('support_ticket_desc')}
FROM tickets""")
def ticket_features(spark: SparkSession, folder: str) -> DataFrame:
    desc = "support_ticket_desc"
    return tickets(spark, folder).withColumn("refs", tx.ref_ids(desc)).select(
        "support_ticket_id",
        tx.classify(desc).alias("category"),
        tx.shown_refs("refs").alias("order_refs"),
        F.size("refs").cast("bigint").alias("n_refs"),
        (F.size("refs") > 1).alias("is_ambiguous"),
        tx.word_count(desc).cast("bigint").alias("words"),
        *[flag.alias(name) for name, flag in tx.phrase_flags(desc).items()],
    )


_KINDS = ["category", "angry", "frustrated", "positive", "escalation"]


@query(f"""
WITH {s.TICKETS}, f AS (
  SELECT {s.classify('support_ticket_desc')} AS category, {s.flags('support_ticket_desc')} FROM tickets)
{" UNION ALL ".join(f"SELECT '{k}' AS kind, CAST({k} AS VARCHAR) AS label, count(*) AS n FROM f GROUP BY 2" for k in _KINDS)}""")
def label_mix(spark: SparkSession, folder: str) -> DataFrame:
    desc = "support_ticket_desc"
    labelled = tickets(spark, folder).select(
        tx.classify(desc).alias("category"), *[flag.alias(k) for k, flag in tx.phrase_flags(desc).items()]
    )
    return report.label_mix(labelled, _KINDS)


@query(f"""
WITH r AS (SELECT lang, len(list_distinct(regexp_extract_all(text, {s.q(DIGITS)}))) AS refs FROM documents)
SELECT lang, count(*) AS n, count(*) FILTER (WHERE refs = 0) AS no_ref,
  count(*) FILTER (WHERE refs > 0) AS with_ref, count(*) FILTER (WHERE refs > 1) AS several_refs
FROM r GROUP BY lang""")
def ref_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return report.ref_coverage(spread(table(spark, folder, "documents").select("lang", "text")), "text", ["lang"], pattern=DIGITS)


@query(f"""
WITH {s.TICKETS}, t AS (
  SELECT 'tickets' AS origin, support_ticket_desc AS text FROM tickets
  UNION ALL SELECT 'conversations', text FROM conversations),
f AS (SELECT origin, {s.flags('text')} FROM t)
SELECT origin, count(*) AS n, {", ".join(f"count(*) FILTER (WHERE {k}) AS {k}" for k in lx.PHRASE_FLAGS)}
FROM f GROUP BY origin""")
def phrase_flags(spark: SparkSession, folder: str) -> DataFrame:
    texts = tickets(spark, folder).select(
        F.lit("tickets").alias("origin"), F.col("support_ticket_desc").alias("text")
    ).unionByName(table(spark, folder, "conversations").select(F.lit("conversations").alias("origin"), "text"))
    flagged = texts.select("origin", *[flag.alias(k) for k, flag in tx.phrase_flags("text").items()])
    return flagged.groupBy("origin").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(k)).alias(k) for k in lx.PHRASE_FLAGS]
    )


@query(f"""
WITH {s.TICKETS}
SELECT support_ticket_id,
  {", ".join(f"len({s.facts('phrase', k)}) AS n_{k}" for k in lx.FACT_PATTERNS)},
  {", ".join(f"{s.joined(s.facts('phrase', k))} AS {k}" for k in lx.FACT_PATTERNS)},
  array_to_string({s.labels('support_ticket_desc', lx.RESOLUTIONS)}, ', ') AS requested
FROM tickets""")
def hard_facts(spark: SparkSession, folder: str) -> DataFrame:
    desc = "support_ticket_desc"
    found = tickets(spark, folder).select(
        "support_ticket_id", tx.hard_facts(desc).alias("facts"), tx.requested_resolution(desc).alias("requested")
    )
    return found.select(
        "support_ticket_id",
        *[F.size(f"facts.{k}").cast("bigint").alias(f"n_{k}") for k in lx.FACT_PATTERNS],
        *[F.array_join(F.array_sort(f"facts.{k}"), ", ").alias(k) for k in lx.FACT_PATTERNS],
        F.array_join("requested", ", ").alias("requested"),
    )


@query(f"""
WITH p AS (SELECT *, {s.words('text')} AS words,
  CAST(len(list_filter(regexp_split_to_array(text, '[.!?]+(\\s+|$)'), lambda y: regexp_matches(y, '\\S'))) AS BIGINT)
    AS sentences FROM documents)
SELECT doc_id, sentences, words BETWEEN 30 AND 70 AS words_ok, sentences BETWEEN 2 AND 4 AS sentences_ok,
  NOT regexp_matches(text, '(?m)^\\s*([-*•]|\\d+[.)])\\s') AS no_bullets,
  NOT regexp_matches(text, '(?m)^ {{0,3}}#{{1,6}} |^[^\\n]{{1,60}}:$') AS no_headings
FROM p""")
def summary_form(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id",
        tx.sentence_count("text").cast("bigint").alias("sentences"),
        *[flag.alias(name) for name, flag in tx.summary_form("text").items()],
    )


@query(f"""
WITH {s.TICKETS}, x AS (SELECT *, {s.expanded('support_ticket_desc')} AS expanded FROM tickets)
SELECT support_ticket_id, expanded <> support_ticket_desc AS is_changed, sha256(expanded) AS expanded_sha
FROM x""")
def shorthand(spark: SparkSession, folder: str) -> DataFrame:
    expanded = tx.expand_shorthand(tickets(spark, folder), "support_ticket_desc", "expanded")
    return expanded.select(
        "support_ticket_id",
        (F.col("expanded") != F.col("support_ticket_desc")).alias("is_changed"),
        F.sha2("expanded", 256).alias("expanded_sha"),
    )


_BEFORE = ["", "RAW TICKET:  ", "Context first.\nRAW TICKET:\n"]
_AFTER = ["\n", "\n\nTRIAGE RECORD\nbody", "\n\nGENERATED reply\n\nTRIAGE RECORD"]


@query(f"""
WITH m AS (SELECT doc_id, {s.pick(_BEFORE, 'doc_id')} || text || {s.pick(_AFTER, 'doc_id // 3')} AS wrapped FROM documents),
c AS (SELECT doc_id, CASE WHEN strpos(wrapped, 'RAW TICKET:') > 0
    THEN regexp_extract(wrapped, '(?s)RAW TICKET:\\s*(.*?)(?:\\n\\nTRIAGE RECORD|\\n\\nGENERATED|\\z)', 1)
    ELSE wrapped END AS inner_text FROM m)
SELECT doc_id, sha256(regexp_replace(inner_text, '\\A\\s+|\\s+\\z', '', 'g')) AS inner_sha FROM c""")
def marker_extract(spark: SparkSession, folder: str) -> DataFrame:
    wrapped = F.concat(
        pick(_BEFORE, F.col("doc_id")), F.col("text"), pick(_AFTER, F.floor(F.col("doc_id") / 3))
    )
    docs = spread(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", wrapped.alias("wrapped"))
    return docs.select("doc_id", F.sha2(tx.between_markers("wrapped"), 256).alias("inner_sha"))


_INSTRUCTIONS = [
    "You are a Triage\n  Analyst.",
    "You are auditing the\nsummarisation   stage.",
    "You are a senior customer\nsupport agent.",
    "AUDITING the response-generation\n\tstage",
    "You do something else.",
]


@query(f"""
WITH p AS (SELECT page_id,
  lower(regexp_replace(html || chr(10) || {s.pick(_INSTRUCTIONS, 'page_id')}, '\\s+', ' ', 'g')) AS flat FROM pages)
SELECT page_id, CASE {" ".join(f"WHEN contains(flat, {s.q(p)}) THEN {s.q(label)}" for p, label in lx.STAGE_PHRASES)}
  ELSE 'unknown' END AS stage FROM p""")
def phrase_label(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat("html", F.lit("\n"), pick(_INSTRUCTIONS, F.col("page_id")))
    pages = spread(table(spark, folder, "pages").select("page_id", "html")).select("page_id", text.alias("text"))
    return pages.select("page_id", tx.label_by_phrase("text").alias("stage"))


@query(f"""
WITH {s.PAIRS}
SELECT pair_id, len({s.minus(s.refs('reply'), s.refs('source'))}) AS n_invented,
  {s.joined(s.minus(s.refs('reply'), s.refs('source')))} AS invented FROM pairs""")
def invented_refs(spark: SparkSession, folder: str) -> DataFrame:
    invented = reply_pairs(spark, folder).select("pair_id", tx.invented_refs("source", "reply").alias("x"))
    return invented.select(
        "pair_id",
        F.size("x").cast("bigint").alias("n_invented"),
        F.array_join(F.array_sort("x"), ", ").alias("invented"),
    )


@query(f"""
WITH {s.PAIRS}
SELECT pair_id, starts_with(reply, 'Dear Customer,') AS has_greeting,
  regexp_matches(reply, '(?i)support team[.\\s]*\\z') AS has_sign_off,
  {s.words('reply')} BETWEEN 110 AND 180 AS length_ok,
  NOT regexp_matches(reply, '(?m)^ {{0,3}}#{{1,6}} |\\*\\*|__|`|\\]\\(') AS plain_text,
  array_to_string({s.codes()}, ', ') AS violations
FROM pairs""")
def reply_form(spark: SparkSession, folder: str) -> DataFrame:
    return reply_pairs(spark, folder).select(
        "pair_id",
        *[flag.alias(name) for name, flag in tx.reply_form("reply").items()],
        F.array_join(tx.violations("reply"), ", ").alias("violations"),
    )


@query(f"""
WITH {s.PAIRS}, c AS (SELECT unnest({s.codes()}) AS code FROM pairs)
SELECT code, count(*) AS n FROM c GROUP BY code""")
def violations_by_code(spark: SparkSession, folder: str) -> DataFrame:
    found = reply_pairs(spark, folder).select(tx.violations("reply").alias("violations"))
    return report.violations_by_code(found, "violations")


@query(f"""
WITH {s.PAIRS}
SELECT pair_id, {s.joined(s.spans())} AS spans, {s.joined(s.off_policy())} AS off_policy FROM pairs""")
def timeframes(spark: SparkSession, folder: str) -> DataFrame:
    return reply_pairs(spark, folder).select(
        "pair_id",
        F.array_join(F.array_sort(tx.timeframes("reply")), ", ").alias("spans"),
        F.array_join(F.array_sort(tx.off_policy_timeframes("reply")), ", ").alias("off_policy"),
    )


@query(f"""
WITH {s.PAIRS}
SELECT pair_id, len({s.details()}) > 0 AND len({s.refs('source')}) = 0 AS asks_details,
  len({s.details()}) AS n_details, len({s.details()}) > 3 AS too_many FROM pairs""")
def asks_details(spark: SparkSession, folder: str) -> DataFrame:
    return reply_pairs(spark, folder).select(
        "pair_id", tx.asks_for_details("reply", "source").alias("asks_details"),
        F.size(tx.requested_details("reply")).cast("bigint").alias("n_details"), tx.asks_too_much("reply").alias("too_many"),
    )


_ALL_FACTS = " || ".join([*[f"({s.facts('asked_phrase', k)})" for k in lx.FACT_PATTERNS], f"({s.refs('source')})"])


@query(f"""
WITH {s.PAIRS}
SELECT pair_id, {s.has('lower(reply)', lx.GENERIC_PRAISE)}
  OR len(list_filter({_ALL_FACTS}, lambda f: contains(lower(reply), lower(f)))) = 0 AS is_generic FROM pairs""")
def generic_reasoning(spark: SparkSession, folder: str) -> DataFrame:
    return reply_pairs(spark, folder).select("pair_id", tx.is_generic_reasoning("reply", "source").alias("is_generic"))


@query(f"""
WITH {s.PAIRS}, w AS (SELECT {s.words('source')} AS a, {s.words('reply')} AS b FROM pairs)
SELECT count(*) AS n, min(b) AS min_words, max(b) AS max_words, round(avg(b), 6) AS mean_words,
  round(CAST(sum(b) AS DOUBLE) / CAST(sum(a) AS DOUBLE), 6) AS ratio_of_sums, round(avg(b / a), 6) AS mean_of_ratios FROM w""")
def compression(spark: SparkSession, folder: str) -> DataFrame:
    result = report.compression(reply_pairs(spark, folder), "source", "reply")
    return result.select(
        "n", *_long("min_words", "max_words"),
        *[F.round(c, 6).alias(c) for c in ("mean_words", "ratio_of_sums", "mean_of_ratios")],
    )


@query(f"""
WITH w AS (SELECT doc_id, {s.words('text')} AS words FROM documents)
SELECT (SELECT doc_id FROM w ORDER BY words, doc_id LIMIT 1) AS lowest,
  (SELECT doc_id FROM w ORDER BY words DESC, doc_id LIMIT 1) AS highest""")
def extremes(spark: SparkSession, folder: str) -> DataFrame:
    words = spread(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", tx.word_count("text").alias("words"))
    return report.extremes(words, "doc_id", "words")
