"""Queries over the certainty of reported figures: intervals, held-out samples, control charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replygauge.functions import text as tx
from replygauge.operators import certainty, joins, report
from replygauge.plans.registry import query
from replygauge.plans.report_queries import _RATING, _rule_rating
from replygauge.sources.tables import spread, table

_HEX = "CAST('0x' || substr(md5({0}), 1, {1}) AS INTEGER)"
_CELL = _HEX.format("coalesce(CAST(doc_id AS VARCHAR), '')", certainty.CELL_DIGITS)
_DRAW = _HEX.format("cell || ':' || b", certainty.DRAW_DIGITS)
_WEIGHT = f"CASE WHEN b = 0 THEN 1 ELSE len(list_filter({certainty.poisson_steps()}, lambda t: t <= {_DRAW})) END"
_DRAWS = f"""cells AS (SELECT DISTINCT cell FROM x),
draws AS MATERIALIZED (SELECT cell, b, {_WEIGHT} AS w FROM cells, (SELECT unnest(range({certainty.REPLICATES + 1})) AS b))"""
_LOW, _HIGH = (1 - certainty.LEVEL) / 2, (1 + certainty.LEVEL) / 2


@query(f"""
WITH {_RATING}, r AS (SELECT doc_id, rating AS quality, CASE WHEN contains(lower(text), 'worthless') THEN 1 ELSE 0 END AS toxic
  FROM rule JOIN documents USING (doc_id)),
p AS (SELECT doc_id, r.quality - l.quality AS quality, r.toxic - l.toxic AS toxic FROM labels l JOIN r USING (doc_id)),
x AS (SELECT {_CELL} AS cell, 'quality' AS criterion, quality AS d FROM p UNION ALL SELECT {_CELL}, 'toxic', toxic FROM p),
{_DRAWS},
m AS (SELECT criterion, b, count(d) AS n, sum(w * d) / sum(CASE WHEN d IS NOT NULL THEN w END) AS mean FROM x JOIN draws USING (cell) GROUP BY ALL)
SELECT criterion, max(n) AS compared, round(max(mean) FILTER (WHERE b = 0), 6) AS mean_delta,
  round(quantile_cont(mean, {_LOW}) FILTER (WHERE b > 0), 6) AS low, round(quantile_cont(mean, {_HIGH}) FILTER (WHERE b > 0), 6) AS high,
  quantile_cont(mean, {_LOW}) FILTER (WHERE b > 0) > 0 OR quantile_cont(mean, {_HIGH}) FILTER (WHERE b > 0) < 0 AS is_changed
FROM m GROUP BY criterion""")
def run_regression_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """The mean change of each criterion from the labels to the text rules, with its interval: changed or not."""
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    rated = _rule_rating(spark, folder).select("doc_id", F.col("rating").alias("quality"))
    toxic = docs.select("doc_id", tx.matches(F.lower("text"), "worthless").cast("int").alias("toxic"))
    compared = joins.compare_runs(table(spark, folder, "labels"), rated.join(toxic, "doc_id"), "doc_id", ["quality", "toxic"])
    found = certainty.change_intervals(compared, "doc_id", ["quality", "toxic"])
    return found.withColumns({c: F.round(c, 6) for c in ("mean_delta", "low", "high")})


@query(f"""
WITH {_RATING}, x AS (SELECT {_CELL} AS cell, rating AS j, quality AS h FROM rule JOIN labels USING (doc_id)),
{_DRAWS},
t AS (SELECT b, sum(w) AS n, sum(w) FILTER (WHERE j = h) AS agreed, sum(w * j) / sum(w) AS pj, sum(w * h) / sum(w) AS ph FROM x JOIN draws USING (cell) GROUP BY b),
k AS (SELECT *, pj * ph + (1 - pj) * (1 - ph) AS c FROM t), f AS (SELECT *, (agreed / n - c) / (1 - c) AS kappa FROM k)
SELECT CAST(max(n) FILTER (WHERE b = 0) AS BIGINT) AS n, CAST(max(agreed) FILTER (WHERE b = 0) AS BIGINT) AS agreed,
  round(max(agreed / n) FILTER (WHERE b = 0), 6) AS agreement_rate, round(max(kappa) FILTER (WHERE b = 0), 6) AS kappa,
  round(quantile_cont(kappa, {_LOW}) FILTER (WHERE b > 0), 6) AS low, round(quantile_cont(kappa, {_HIGH}) FILTER (WHERE b > 0), 6) AS high FROM f""")
def judge_agreement_interval(spark: SparkSession, folder: str) -> DataFrame:
    """Kappa of the text rule against people's labels, with its interval."""
    human = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("rating"))
    found = certainty.kappa_interval(joins.pair_ratings(_rule_rating(spark, folder), human, "doc_id"), "doc_id")
    return found.withColumns({c: F.round(c, 6) for c in ("agreement_rate", "kappa", "low", "high")})


#: Documents of each language that people would score for the held-out set.
HELD_OUT = 50


@query(f"""
WITH {_RATING}, s AS (SELECT doc_id, count(*) OVER (PARTITION BY lang) AS stratum_rows,
    row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS place FROM documents JOIN labels USING (doc_id)),
p AS (SELECT rating AS j, quality AS h, greatest(1.0, CAST(stratum_rows AS DOUBLE) / {HELD_OUT}) AS w FROM s JOIN rule USING (doc_id) JOIN labels USING (doc_id) WHERE place <= {HELD_OUT}),
t AS (SELECT sum(w) AS n, sum(CASE WHEN j = h THEN w ELSE 0 END) / sum(w) AS rate, sum(w * j) / sum(w) AS pj, sum(w * h) / sum(w) AS ph FROM p)
SELECT CAST(round(n) AS BIGINT) AS n, round(rate, 6) AS agreement_rate,
  round((rate - (pj * ph + (1 - pj) * (1 - ph))) / (1 - (pj * ph + (1 - pj) * (1 - ph))), 6) AS kappa FROM t""")
def held_out_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """The rule against a held-out set of each language, weighted to the whole table; the sample is the feature."""
    labelled = table(spark, folder, "documents").select("doc_id", "lang").join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")
    sample = certainty.held_out(labelled, "doc_id", "lang", HELD_OUT)
    pairs = sample.join(_rule_rating(spark, folder).select("doc_id", F.col("rating").alias("judge")), "doc_id")
    found = certainty.weighted_agreement(pairs.withColumnRenamed("quality", "human"))
    return found.withColumns({c: F.round(c, 6) for c in ("agreement_rate", "kappa")})


_BASELINE, _SLACK, _LIMIT = 16, 1.0, 5.0


@query(f"""
WITH RECURSIVE d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(value) AS n, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / count(value) AS mean_value
  FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) AS place FROM d),
l AS (SELECT event_type, avg(mean_value) AS level, stddev_samp(mean_value) AS spread FROM r WHERE place <= {_BASELINE} GROUP BY 1),
z AS (SELECT r.*, CASE WHEN place > {_BASELINE} AND spread > 0 THEN (mean_value - level) / spread END AS z FROM r JOIN l USING (event_type)),
c AS (SELECT event_type, day, n, mean_value, place, CAST(0 AS DOUBLE) AS low, CAST(0 AS DOUBLE) AS high FROM z WHERE place = 1
  UNION ALL SELECT z.event_type, z.day, z.n, z.mean_value, z.place, greatest(0, c.low + coalesce(-z.z - {_SLACK}, 0)), greatest(0, c.high + coalesce(z.z - {_SLACK}, 0))
  FROM c JOIN z ON z.event_type = c.event_type AND z.place = c.place + 1)
SELECT event_type, day, n, round(mean_value, 6) AS mean_value, round(low, 6) AS low, round(high, 6) AS high, low > {_LIMIT} OR high > {_LIMIT} AS is_alert FROM c""")
def drift_chart(spark: SparkSession, folder: str) -> DataFrame:
    """Daily means of each kind of event on a cumulative-sum chart; the SQL steps through the days one by one."""
    value = F.col("value").cast("decimal(18,2)")
    days = table(spark, folder, "events").select("event_type", F.col("ts").cast("date").alias("day"), value.alias("value")).groupBy("event_type", "day").agg(
        F.count("value").alias("n"), (F.sum("value").cast("double") / F.count("value")).alias("mean_value")
    )
    chart = report.control_chart(days, "day", "mean_value", ["event_type"], _BASELINE, _SLACK, _LIMIT)
    return chart.withColumns({c: F.round(c, 6) for c in ("mean_value", "low", "high")})
