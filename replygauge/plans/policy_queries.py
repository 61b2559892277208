"""Queries over typed facts, the clauses that govern tickets, and the two wordings of the policies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replygauge.functions import facts as fc
from replygauge.functions import policies as po
from replygauge.operators.grounding import Clauses, ground
from replygauge.operators.mirror import mirror_clauses
from replygauge.plans import sql as s
from replygauge.plans.baseline_sql import CONSOLIDATED, GROUNDED
from replygauge.plans.derive import enriched_tickets, reply_pairs, tickets
from replygauge.plans.registry import query
from replygauge.session import stored, work_folder
from replygauge.sources.prompts import load_prompts, policy_clauses
from replygauge.sources.tables import small_table

_CLAUSE_COLUMNS = ["policy_no", "clause_no", "clause"]


@query(f"""
WITH {s.TICKETS}
SELECT support_ticket_id, {s.joined(s.told(s.TICKET_TYPED, 'phrase'))} AS facts FROM tickets""")
def typed_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Every fact of every ticket in its normal form."""
    keys = fc.fact_keys(fc.typed_facts("support_ticket_desc"))
    return tickets(spark, folder).select("support_ticket_id", F.array_join(F.array_sort(keys), ", ").alias("facts"))


_NEW = s.minus(s.minus("reply_facts", s.entailed("source_facts")), s.GRANTED_SQL)


@query(f"""
WITH {s.PAIRS}, t AS (SELECT pair_id, {s.told(s.TICKET_TYPED, 'asked_phrase')} AS source_facts, {s.told(s.REPLY_TYPED, 'phrase')} AS reply_facts FROM pairs)
SELECT pair_id, CAST(len({_NEW}) AS BIGINT) AS n_invented, {s.joined(_NEW)} AS invented FROM t""")
def invented_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts, dates, spans and transactions of replies that neither the ticket states nor a clause grants."""
    granted = fc.granted_facts(small_table(spark, _CLAUSE_COLUMNS, po.clause_rows()))
    pairs = reply_pairs(spark, folder).select("pair_id", *[fc.fact_keys(fc.typed_facts(c)).alias(c) for c in ("source", "reply")])
    found = pairs.select("pair_id", fc.invented_facts(F.col("reply"), F.col("source"), granted).alias("x"))
    return found.select("pair_id", F.size("x").cast("bigint").alias("n_invented"), F.array_join(F.array_sort("x"), ", ").alias("invented"))


@query(f"""
WITH {CONSOLIDATED}
SELECT support_ticket_id, clause_score, policy_no, clause_no, clause IS NULL AS in_queue,
  {s.joined('spans')} AS spans FROM points""")
def grounded_replies(spark: SparkSession, folder: str) -> DataFrame:
    """The clause behind each reply, the spans that the reply names, and whether a person must write it."""
    clauses = Clauses.read(small_table(spark, _CLAUSE_COLUMNS, po.clause_rows()))
    enriched = enriched_tickets(spark, folder).select("support_ticket_id", "summarise.summary", "respond.response")
    found = ground(enriched, "summary", clauses)
    spans = fc.typed_facts("response")["span"]
    return found.select(
        "support_ticket_id", F.col("clause_score").cast("bigint").alias("clause_score"), "policy_no", "clause_no", (~F.col("is_covered")).alias("in_queue"),
        F.array_join(F.array_sort(F.transform(spans, lambda x: F.concat(F.lit("span "), x))), ", ").alias("spans"),
    )


#: The judge's wording with three slips: another limit, a clause that is gone, a clause that is new.
DRIFTED = [
    (title, [c.replace("within 2 business days", "within 3 business days") for c in clauses if "shipping" not in c] + (["Gift cards are never refunded"] if title.startswith("Refunds") else []))
    for title, clauses in po.JUDGE
]
OPENINGS = {"respond": "You are a senior customer support agent.", "judge_response": "You are auditing the response-generation stage."}

# Told by hand: the place of each writer's clause and of its mirror in DRIFTED, and what became of it.
_MIRROR = [(p, c, c, "same") for p, c, _ in po.clause_rows() if (p, c) not in {(3, 2), (3, 3), (3, 4)}] + [
    (1, None, 6, "judge only"), (3, 2, 2, "changed"), (3, 3, None, "writer only"), (3, 4, 3, "same"),
]
_MIRROR_SQL = ", ".join(f"({p}, {w or 'NULL'}, {j or 'NULL'}, {s.q(x)})" for p, w, j, x in _MIRROR)
_JUDGE_SQL = ", ".join(f"({p}, {c}, {s.q(text)})" for p, c, text in po.clause_rows(DRIFTED))


@query(f"""
WITH {GROUNDED},
m(policy_no, writer_no, judge_no, status) AS (VALUES {_MIRROR_SQL}), j(policy_no, judge_no, judge_clause) AS (VALUES {_JUDGE_SQL}),
cited AS (SELECT policy_no, clause_no AS writer_no, count(*) AS n FROM grounded WHERE clause IS NOT NULL GROUP BY ALL)
SELECT m.policy_no, m.writer_no, m.judge_no, c.clause AS writer_clause, j.judge_clause, m.status,
  CASE WHEN m.status = 'changed' THEN 'span 2 business day, span 3 business day' ELSE '' END AS differing_facts, coalesce(cited.n, 0) AS cited
FROM m LEFT JOIN clauses c ON c.policy_no = m.policy_no AND c.clause_no = m.writer_no
  LEFT JOIN j ON j.policy_no = m.policy_no AND j.judge_no = m.judge_no
  LEFT JOIN cited ON cited.policy_no = m.policy_no AND cited.writer_no = m.writer_no""")
def policy_clause_mirror(spark: SparkSession, folder: str) -> DataFrame:
    """Prompt files are written and read; their clauses are matched, with the number of tickets each governs."""
    path = work_folder(spark, "prompts")
    for stage, wording in (("respond", po.WRITER), ("judge_response", DRIFTED)):
        spark.createDataFrame([(po.instruction(OPENINGS[stage], wording),)], "value string").coalesce(1).write.text(f"{path}/{stage}")
    clauses = policy_clauses(load_prompts(spark, f"{path}/*"), "stage", "text")
    writer, judge = (clauses.where(F.col("stage") == stage).select(*_CLAUSE_COLUMNS) for stage in OPENINGS)
    summaries = stored(enriched_tickets(spark, folder).select("summarise.summary"), "summaries")
    cited = ground(summaries, "summary", Clauses.read(writer)).where("is_covered").groupBy("policy_no", F.col("clause_no").alias("writer_no")).agg(F.count(F.lit(1)).alias("cited"))
    mirrored = mirror_clauses(writer, judge).join(cited, ["policy_no", "writer_no"], "left")
    return mirrored.select(
        "policy_no", "writer_no", "judge_no", "writer_clause", "judge_clause", "status",
        F.array_join("differing_facts", ", ").alias("differing_facts"), F.coalesce("cited", F.lit(0)).alias("cited"),
    )
