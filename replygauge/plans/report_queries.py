"""Queries over scores, gates, segments, runs and weeks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.functions import scoring as sc
from replygauge.functions import text as tx
from replygauge.operators import joins, report
from replygauge.operators.audit import audit
from replygauge.plans import sql as s
from replygauge.plans.derive import CRITERIA, TOP_SCORES, reply_pairs, tickets
from replygauge.plans.registry import query
from replygauge.session import work_folder
from replygauge.sources.prompts import clause_facts
from replygauge.sources.sinks import write_review_queue, write_statistics
from replygauge.sources.tables import small_table, spread, table


def _audited(spark: SparkSession, folder: str) -> DataFrame:
    return audit(reply_pairs(spark, folder), "source", "reply")


def _gated(spark: SparkSession, folder: str) -> DataFrame:
    """Audited replies with every gate as a boolean column."""
    faith = F.col("information_extraction_score")
    gates = _audited(spark, folder).withColumns({
        "passes": sc.verdict(CRITERIA[:4], faith, min_mean=2.5, min_faith=3),
        "auto_send": sc.auto_send("issue_addressal_score", "resolution_clarity_score", "policy_flag"),
        "needs_human": sc.needs_human("overall_score"),
        "route": sc.route("is_ambiguous", "escalation"),
        "usable": ~tx.is_blank("reply"),
    })
    return gates.withColumn(
        "in_queue", sc.in_review_queue(["passes", "auto_send"], "asks_details", ["usable"])
    )


_SUM4 = " + ".join(CRITERIA[:4])
GATES = f"""{s.AUDIT},
g AS (SELECT *, ({_SUM4}) / 4.0 >= 2.5 AND information_extraction_score >= 3 AS passes,
  issue_addressal_score = 3 AND resolution_clarity_score = 3 AND NOT policy_flag AS auto_send,
  overall_score <= 4 AS needs_human,
  CASE WHEN len(source_refs) > 1 OR escalation THEN 'senior' ELSE 'standard' END AS route FROM audit),
gated AS (SELECT *, NOT (passes AND auto_send) OR asks_details AS in_queue FROM g)"""


@query(f"""
WITH {s.AUDIT}
SELECT pair_id, {", ".join(CRITERIA)}, policy_flag, asks_details FROM audit""")
def audit_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _audited(spark, folder).select("pair_id", *CRITERIA, "policy_flag", "asks_details")


_LONG = " UNION ALL ".join(f"SELECT '{c}' AS criterion, {c} AS score FROM audit" for c in CRITERIA)


@query(f"""
WITH {s.AUDIT}, l AS ({_LONG})
SELECT criterion, score, count(*) AS n FROM l GROUP BY criterion, score""")
def score_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return report.score_distribution(_audited(spark, folder), CRITERIA)


@query(f"""
WITH {s.AUDIT}, l AS ({_LONG})
SELECT criterion, count(*) AS n, round(avg(score), 6) AS mean_score,
  round(avg(CASE WHEN score = CASE WHEN criterion = 'overall_score' THEN 6 ELSE 3 END THEN 1 ELSE 0 END), 6) AS share_at_top,
  count(DISTINCT score) AS distinct_scores, count(DISTINCT score) = 1 AS is_saturated
FROM l GROUP BY criterion""")
def score_saturation(spark: SparkSession, folder: str) -> DataFrame:
    distribution = report.score_distribution(_audited(spark, folder), CRITERIA)
    summary = report.criterion_summary(distribution, TOP_SCORES)
    return summary.withColumns({c: F.round(c, 6) for c in ("mean_score", "share_at_top")})


@query(f"""
WITH {s.AUDIT}, l AS ({_LONG})
SELECT criterion, round(avg(score), 6) AS mean_score FROM l WHERE criterion <> 'overall_score'
GROUP BY criterion ORDER BY avg(score), criterion LIMIT 1""")
def lowest_criterion(spark: SparkSession, folder: str) -> DataFrame:
    distribution = report.score_distribution(_audited(spark, folder), CRITERIA[:4])
    lowest = report.lowest_criterion(report.criterion_summary(distribution, TOP_SCORES))
    return lowest.withColumn("mean_score", F.round("mean_score", 6))


_MEANS = ", ".join(f"round(avg({c}), 6) AS mean_{c}" for c in CRITERIA)


@query(f"""
WITH {s.AUDIT}
SELECT CASE WHEN has_ref THEN 'with' ELSE 'without' END AS segment, count(*) AS n, {_MEANS} FROM audit GROUP BY 1
UNION ALL SELECT 'total', count(*), {_MEANS} FROM audit""")
def segment_means(spark: SparkSession, folder: str) -> DataFrame:
    means = report.segment_means(_audited(spark, folder), "has_ref", CRITERIA, total=True)
    segment = F.when(F.col("has_ref"), "with").when(~F.col("has_ref"), "without").otherwise("total")
    return means.select(
        segment.alias("segment"), "n", *[F.round(f"mean_{c}", 6).alias(f"mean_{c}") for c in CRITERIA]
    )


_GATE_NAMES = ["passes", "auto_send", "needs_human", "in_queue"]


@query(f"""
WITH {GATES}
SELECT count(*) AS n, {", ".join(f"count(*) FILTER (WHERE {g}) AS n_{g}" for g in _GATE_NAMES)},
  {", ".join(f"round(avg(CASE WHEN {g} THEN 1 ELSE 0 END), 6) AS rate_{g}" for g in _GATE_NAMES)} FROM gated""")
def gate_rates(spark: SparkSession, folder: str) -> DataFrame:
    rates = report.gate_rates(_gated(spark, folder), _GATE_NAMES)
    return rates.withColumns({f"rate_{g}": F.round(f"rate_{g}", 6) for g in _GATE_NAMES})


@query(f"""
WITH {GATES}
SELECT escalation, count(*) FILTER (WHERE in_queue) AS in_queue, count(*) FILTER (WHERE NOT in_queue) AS not_in_queue
FROM gated GROUP BY escalation""")
def queue_crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return report.queue_crosstab(_gated(spark, folder), "escalation", "in_queue")


@query(f"""
WITH {GATES}
SELECT pair_id, overall_score, route, DATE '2024-01-01' AS run_date FROM gated WHERE in_queue""")
def review_queue(spark: SparkSession, folder: str) -> DataFrame:
    """The review queue, written as a table and read again."""
    path = work_folder(spark, "queue")
    gated = _gated(spark, folder).select("pair_id", "overall_score", "route", "in_queue")
    for _ in range(2):  # a rerun replaces the date's rows
        write_review_queue(gated, "in_queue", path, "2024-01-01")
    return spark.read.parquet(path).select("pair_id", "overall_score", "route", "run_date")


@query(f"WITH {GATES} SELECT pair_id, escalation FROM gated WHERE in_queue AND escalation")
def escalated_in_queue(spark: SparkSession, folder: str) -> DataFrame:
    """Escalation risks among all replies that stand in the written review queue."""
    path = work_folder(spark, "queue")
    write_review_queue(_gated(spark, folder).select("pair_id", "in_queue"), "in_queue", path, "2024-01-01")
    risks = reply_pairs(spark, folder).select("pair_id", tx.phrase_flags("source")["escalation"].alias("escalation"))
    return joins.in_queue(risks, spark.read.parquet(path), "pair_id", F.col("escalation"))


@query(f"WITH {GATES} SELECT route, count(*) AS n FROM gated GROUP BY route")
def routing(spark: SparkSession, folder: str) -> DataFrame:
    return _gated(spark, folder).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {s.AUDIT} SELECT pair_id, overall_score FROM audit ORDER BY overall_score, pair_id LIMIT 10""")
def worst_rows(spark: SparkSession, folder: str) -> DataFrame:
    return report.worst(_audited(spark, folder).select("pair_id", "overall_score"), "overall_score", "pair_id", 10)


@query(f"""
WITH {s.AUDIT}, l AS ({_LONG})
SELECT criterion, score, count(*) AS n, DATE '2024-01-01' AS run_date FROM l GROUP BY criterion, score""")
def quality_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """The score histogram, written to the statistics table and read again."""
    path = work_folder(spark, "statistics")
    write_statistics(report.score_distribution(_audited(spark, folder), CRITERIA), path, "2024-01-01")
    return spark.read.parquet(path).select("criterion", "score", "n", "run_date")


# -- raters and runs --------------------------------------------------------


def _rule_rating(spark: SparkSession, folder: str) -> DataFrame:
    """A document is good if it has at least 50 words and no markdown."""
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    good = tx.has_words("text", 50) & tx.reply_form("text")["plain_text"]
    return docs.select("doc_id", good.cast("int").alias("rating"))


_RATING = f"""
rule AS (SELECT doc_id, CASE WHEN {s.words('text')} >= 50
  AND NOT regexp_matches(text, '(?m)^ {{0,3}}#{{1,6}} |\\*\\*|__|`|\\]\\(') THEN 1 ELSE 0 END AS rating FROM documents)"""


@query(f"""
WITH {_RATING}
SELECT rating AS judge, quality AS human, count(*) AS n FROM rule JOIN labels USING (doc_id) GROUP BY 1, 2""")
def judge_vs_human(spark: SparkSession, folder: str) -> DataFrame:
    human = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("rating"))
    return report.confusion(joins.pair_ratings(_rule_rating(spark, folder), human, "doc_id"))


@query(f"""
WITH {_RATING}, p AS (SELECT rating AS j, quality AS h FROM rule JOIN labels USING (doc_id)),
t AS (SELECT count(*) AS n, count(*) FILTER (WHERE j = h) AS agreed, avg(j) AS pj, avg(h) AS ph FROM p)
SELECT n, agreed, round(agreed / n, 6) AS agreement_rate,
  round((agreed / n - (pj * ph + (1 - pj) * (1 - ph))) / (1 - (pj * ph + (1 - pj) * (1 - ph))), 6) AS kappa FROM t""")
def judge_agreement(spark: SparkSession, folder: str) -> DataFrame:
    human = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("rating"))
    counts = report.confusion(joins.pair_ratings(_rule_rating(spark, folder), human, "doc_id"))
    return report.agreement(counts).withColumns({c: F.round(c, 6) for c in ("agreement_rate", "kappa")})


@query(f"""
WITH {_RATING}, r AS (SELECT doc_id, rating AS quality, CASE WHEN contains(lower(text), 'worthless') THEN 1 ELSE 0 END AS toxic
  FROM rule JOIN documents USING (doc_id)),
c AS (SELECT l.doc_id AS old_id, r.doc_id AS new_id, l.quality AS q0, r.quality AS q1, l.toxic AS t0, r.toxic AS t1
  FROM labels l FULL OUTER JOIN r USING (doc_id)),
x AS (SELECT 'quality' AS criterion, q0 AS a, q1 AS b FROM c UNION ALL SELECT 'toxic', t0, t1 FROM c)
SELECT criterion, count(*) FILTER (WHERE a IS NULL AND b IS NOT NULL) AS added,
  count(*) FILTER (WHERE a IS NOT NULL AND b IS NULL) AS removed, count(b - a) AS compared,
  count(*) FILTER (WHERE a <> b) AS changed,
  round(count(*) FILTER (WHERE a <> b) / count(b - a), 6) AS share_changed, round(avg(b - a), 6) AS mean_delta
FROM x GROUP BY criterion""")
def run_regression(spark: SparkSession, folder: str) -> DataFrame:
    """Labels as the old run, text rules as the new one."""
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    good = tx.has_words("text", 50) & tx.reply_form("text")["plain_text"]
    new = docs.select(
        "doc_id", good.cast("int").alias("quality"),
        tx.matches(F.lower("text"), "worthless").cast("int").alias("toxic"),
    )
    compared = joins.compare_runs(table(spark, folder, "labels"), new, "doc_id", ["quality", "toxic"])
    result = joins.run_regression(compared, ["quality", "toxic"])
    return result.withColumns({c: F.round(c, 6) for c in ("share_changed", "mean_delta")})


@query(f"""
WITH {s.PAIRS},
facts AS (SELECT pair_id, list_distinct({s.asked_spans()} || regexp_extract_all(lower(source), 'rs\\.? ?\\d+')) AS w,
  list_distinct({s.spans()} || regexp_extract_all(lower(reply), 'rs\\.? ?\\d+')) AS j FROM pairs),
w AS (SELECT pair_id, unnest(w) AS fact FROM facts), j AS (SELECT pair_id, unnest(j) AS fact FROM facts)
SELECT pair_id, fact, CASE WHEN j.fact IS NULL THEN 'writer' ELSE 'judge' END AS only_in
FROM w FULL OUTER JOIN j USING (pair_id, fact) WHERE w.fact IS NULL OR j.fact IS NULL""")
def policy_mirror(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers and units that only one of two mirrored texts holds."""
    pairs = reply_pairs(spark, folder)
    sides = [pairs.select("pair_id", F.explode(clause_facts(c)).alias("fact")) for c in ("source", "reply")]
    return joins.mirror_diff(*sides, ["pair_id", "fact"])


# -- stages, policies, weeks ------------------------------------------------


@query("""
SELECT a.conv_id, a.turn FROM conversations a WHERE a.role = 'user' AND NOT EXISTS (
  SELECT 1 FROM conversations b WHERE b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant')""")
def stage_loss(spark: SparkSession, folder: str) -> DataFrame:
    return joins.unanswered_turns(table(spark, folder, "conversations"))


@query("""
WITH w AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, count(value) AS n,
  CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / count(value) AS mean_value FROM events GROUP BY 1, 2),
d AS (SELECT *, CASE WHEN week - lag(week) OVER (PARTITION BY event_type ORDER BY week) = 7
  THEN mean_value - lag(mean_value) OVER (PARTITION BY event_type ORDER BY week) END AS delta FROM w)
SELECT event_type, week, n, round(mean_value, 6) AS mean_value, round(delta, 6) AS delta,
  coalesce(delta < -0.5, false) AS is_drift FROM d""")
def weekly_scores(spark: SparkSession, folder: str) -> DataFrame:
    # Two decimals as exact numbers: the sum does not depend on the order of the rows.
    value = F.col("value").cast("decimal(18,2)")
    weeks = report.weekly_means(table(spark, folder, "events"), "ts", value, by=["event_type"], alert=0.5)
    return weeks.withColumns({c: F.round(c, 6) for c in ("mean_value", "delta")})


_POLICY_SQL = ", ".join(
    f"({s.q(p)}, {'NULL' if lo is None else lo}, {'NULL' if hi is None else hi}, {s.q(e)})"
    for p, lo, hi, e in lx.POLICY_BANDS
)


@query(f"""
WITH d AS (SELECT CASE l_returnflag WHEN 'R' THEN 'return' WHEN 'A' THEN 'reversal' ELSE 'delay' END AS policy,
  CAST(o_orderdate AS DATE) AS a, CAST(l_shipdate AS DATE) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
x AS (SELECT policy, CASE WHEN policy = 'reversal' THEN
    5 * (date_diff('day', CAST(date_trunc('week', a) AS DATE), CAST(date_trunc('week', b) AS DATE)) // 7)
    + least(isodow(b), 5) - least(isodow(a), 5) ELSE date_diff('day', a, b) END AS days,
  a, b FROM d),
y AS (SELECT policy, CASE WHEN policy = 'reversal' AND b <= a THEN 0 ELSE days END AS days FROM x),
bands(policy, lo, hi, entitlement) AS (VALUES {_POLICY_SQL})
SELECT y.policy, coalesce(bands.entitlement, 'none') AS entitlement, count(*) AS n
FROM y LEFT JOIN bands ON y.policy = bands.policy AND (lo IS NULL OR days > lo) AND (hi IS NULL OR days <= hi)
GROUP BY 1, 2""")
def policy_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Entitlement by days from order to shipping; reversals count business days."""
    flag = F.col("l_returnflag")
    policy = F.when(flag == "R", "return").when(flag == "A", "reversal").otherwise("delay")
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("ordered"))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").cast("date").alias("shipped"), policy.alias("policy")
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = F.when(F.col("policy") == "reversal", sc.business_days("ordered", "shipped")).otherwise(
        F.datediff("shipped", "ordered")
    )
    # Count equal lookups first: the band join then sees one row per policy and day.
    counted = joined.select("policy", days.alias("days")).groupBy("policy", "days").agg(F.count(F.lit(1)).alias("n"))
    bands = small_table(spark, ["policy", "lo_days", "hi_days", "entitlement"], lx.POLICY_BANDS)
    looked_up = joins.policy_entitlement(counted, bands, "policy", "days")
    return looked_up.groupBy("policy", F.coalesce("entitlement", F.lit("none")).alias("entitlement")).agg(
        F.sum("n").alias("n")
    )


_MAP_SQL = ", ".join(f"({s.q(c)}, {s.q(p)})" for c, p in lx.GOVERNING_POLICY.items())


@query(f"""
WITH {s.TICKETS}, c AS (SELECT {s.classify('support_ticket_desc')} AS category, count(*) AS n FROM tickets GROUP BY 1),
m(category, policy) AS (VALUES {_MAP_SQL})
SELECT category, n, policy, policy IS NOT NULL AS is_covered FROM c LEFT JOIN m USING (category)""")
def governing_policy(spark: SparkSession, folder: str) -> DataFrame:
    category = tx.classify("support_ticket_desc").alias("category")
    counted = tickets(spark, folder).select(category).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    mapping = small_table(spark, ["category", "policy"], list(lx.GOVERNING_POLICY.items()))
    return joins.governing_policy(counted, mapping, "category")
