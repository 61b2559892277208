"""The default scorer of the four stages: extract, ground, check. No model, no network.

A summary quotes the ticket (``summarise``). A reply states the clause that governs
the summary (``grounding``) and asks for what is missing. Both are judged by the rules
of ``audit``: invented references and facts, coverage, policy, next steps.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.functions import facts as fc
from replygauge.functions import lexicon as lx
from replygauge.functions import scoring as sc
from replygauge.functions import text as tx
from replygauge.functions.policies import SUBJECTS, clause_rows
from replygauge.operators.grounding import Clauses
from replygauge.operators.stages import RuleScorer, Stage
from replygauge.operators.summarise import document_weights, ranked_pieces, stated_facts, summarise
from replygauge.sources.tables import small_table

PASSED_ON = "has been passed to the team who can review it"
UNCOVERED = f"Your request {PASSED_ON}, and nobody will ask you to explain it a second time."
ASK = "Please share your order reference and a short description of what happened, so that we can find the order and act on it at once."
NOTED = "You do not need to do anything else for now: we act on what you have already told us and write to you again as soon as there is news."
OPENING = "We have read your message carefully, and we are sorry for the trouble and the time it has cost you."
CLOSING = (
    "Please write to us again at any time if something is missing here or if any part of this answer is unclear. We read every "
    "message, and we will gladly help you further until the matter is settled in a way that you are happy with."
)
SIGN_OFF = "Kind regards,\nThe Support Team"


def _prefix(name: str) -> str:
    return f"__{name}_"


def features(df: DataFrame, name: str, text: str, weights: bytes, clauses: Clauses) -> DataFrame:
    """What the stages need to know about the text of one kind, as columns ``__<kind>_*``."""
    p = _prefix(name)
    raw, low = F.col(p + "raw"), F.col(p + "low")
    # lower-cased once, for all phrases that are looked for
    df = df.withColumn(p + "low", F.lower(F.coalesce(F.col(text), F.lit(""))))
    df = df.withColumns({p + "ids": tx.ref_ids(text), p + "wanted": tx.all_labels(low, lx.RESOLUTIONS), p + "raw": fc.raw_facts(text)})
    if name == "ticket":
        df = df.withColumns({
            p + "facts": fc.fact_keys(fc.normal_forms(raw)), p + "stated": stated_facts(text, raw), p + "category": tx.classify(text, low=low),
            p + "escalation": tx.matches(low, lx.PHRASE_FLAGS["escalation"]), p + "pieces": ranked_pieces(text, weights),
        })
        return summarise(df, p)
    if name == "summary":
        df = df.withColumns({p + "facts": fc.fact_keys(fc.normal_forms(raw)), p + "scores": clauses.scores(text)})
        df = df.withColumn(p + "place", clauses.best(F.col(p + "scores")))
        place = F.col(p + "place")
        return df.withColumns({
            p + "clause": clauses.clause(place), p + "subject": clauses.pick(place, [SUBJECTS.get(n, "your order") for n, _, _ in clauses.rows]),
            p + "granted": clauses.pick(place, clauses.granted, "array<string>"), p + "clause_facts": clauses.pick(place, clauses.facts, "array<string>"),
        })
    return df.withColumns({
        p + "facts": fc.fact_keys(fc.normal_forms(raw)), p + "violations": tx.all_labels(low, lx.PROHIBITED),
        p + "asks": F.regexp_like(low, F.lit("(?d)" + lx.DETAIL_REQUEST)),
    })


def _known(name: str, feature: str) -> Column:
    return F.col(_prefix(name) + feature)


def response() -> Column:
    """The reply to a summary: what it is about, the clause, what is passed on, the next step."""
    ids, wanted, clause = (_known("summary", x) for x in ("ids", "wanted", "clause"))
    granted = F.coalesce(_known("summary", "granted"), F.array().cast("array<string>"))
    beyond = F.array_except(wanted, granted)
    thanks = F.concat(
        F.lit("Thank you for writing to us"),
        F.when(clause.isNotNull(), F.concat(F.lit(" about "), _known("summary", "subject"))).otherwise(F.lit("")),
        F.when(F.size(ids) > 0, F.concat(F.lit(" ("), tx.shown_refs(ids), F.lit(")"))).otherwise(F.lit("")), F.lit(". " + OPENING),
    )
    answer = F.when(clause.isNotNull(), F.concat(F.lit("This is what applies to your case. "), clause)).otherwise(F.lit(UNCOVERED))
    passed = F.when(clause.isNotNull() & (F.size(beyond) > 0), F.concat(F.lit("Your wish for "), F.array_join(beyond, " and "), F.lit(f" {PASSED_ON}.")))
    step = F.when(F.size(ids) == 0, F.lit(ASK)).otherwise(F.lit(NOTED))
    return F.concat_ws("\n\n", F.lit(lx.GREETING), thanks, answer, passed, step, F.lit(CLOSING), F.lit(SIGN_OFF))


def _elements(name: str) -> Column:
    return F.concat(_known(name, "ids"), _known(name, "wanted"), _known(name, "facts"))


def judge_summary() -> dict[str, Column]:
    """Faithfulness to the ticket, and what it carries over of what an agent needs."""
    invented = F.concat(
        F.array_except(_known("summary", "ids"), _known("ticket", "ids")), fc.invented_facts(_known("summary", "facts"), _known("ticket", "facts"))
    )
    need, got = F.array_distinct(_elements("ticket")), F.concat(_elements("summary"), fc.entailed(_known("summary", "facts")))
    missing = F.array_except(need, got)
    return {
        "information_extraction_score": sc.cap(F.lit(3), F.size(invented) > 0),
        "information_extraction_reasoning": F.when(F.size(invented) > 0, F.concat(F.lit("The ticket does not state "), F.array_join(invented, ", "), F.lit("."))).otherwise(
            F.lit("Every reference and fact of the summary stands in the ticket.")
        ),
        "field_coverage_score": sc.coverage_score(sc.coverage(need, got)),
        "field_coverage_reasoning": F.when(F.size(need) == 0, F.lit("The ticket names nothing that an agent needs.")).when(
            F.size(missing) > 0, F.concat(F.lit("Missing: "), F.array_join(missing, ", "), F.lit("."))
        ).otherwise(F.concat(F.lit("Carries over "), F.array_join(need, ", "), F.lit("."))),
    }


def judge_response() -> dict[str, Column]:
    """Whether the reply answers within the policies, and whether the next step is clear."""
    facts, wanted = _known("response", "facts"), _known("summary", "wanted")
    granted = F.coalesce(_known("summary", "clause_facts"), F.array().cast("array<string>"))
    outside = F.concat(
        F.array_except(_known("response", "ids"), _known("summary", "ids")),
        F.array_except(facts, F.concat(fc.entailed(_known("summary", "facts")), granted)), _known("response", "violations"),
    )
    answered = (F.size(wanted) == 0) | F.arrays_overlap(wanted, _known("response", "wanted"))
    covered = _known("summary", "clause").isNotNull()
    spans = F.filter(facts, lambda x: x.startswith("span "))
    asks = _known("response", "asks") & (F.size(_known("summary", "ids")) == 0)
    issue = sc.cap(F.when(answered & covered, 3).otherwise(2), F.size(outside) > 0)
    clarity = F.when((F.size(spans) > 0) | asks, 3).otherwise(2)
    return {
        "issue_addressal_score": issue,
        "issue_addressal_reasoning": F.when(F.size(outside) > 0, F.concat(F.lit("Outside the policies: "), F.array_join(outside, ", "), F.lit("."))).when(
            ~covered, F.lit("No clause governs the issue; it is passed on.")
        ).when(answered, F.lit("Answers what is asked for with one clause.")).otherwise(F.lit("Leaves what is asked for unanswered.")),
        "resolution_clarity_score": clarity,
        "resolution_clarity_reasoning": F.when(F.size(spans) > 0, F.concat(F.lit("Names "), F.array_join(spans, ", "), F.lit("."))).when(
            asks, F.lit("Asks for what is missing.")
        ).otherwise(F.lit("Names neither a time nor a next step for the customer.")),
        "overall_score": issue + clarity,
        "overall_reasoning": F.when((issue == 3) & (clarity == 3), F.lit("Safe to send.")).otherwise(F.lit("A person should read it first.")),
    }


def _reply(stage: Stage) -> Column:
    values = {
        "summarise": lambda: {"summary": _known("ticket", "summary")},
        "judge_summary": judge_summary,
        "respond": lambda: {"response": response()},
        "judge_response": judge_response,
    }[stage.name]()
    return F.to_json(F.struct(F.struct(*[values[name].alias(name) for name in stage.schema.names]).alias("output")))


def policy_clauses(df: DataFrame) -> DataFrame:
    return small_table(df.sparkSession, ["policy_no", "clause_no", "clause"], clause_rows())


def fit(tickets: DataFrame, text: str = "support_ticket_desc", clauses: DataFrame | None = None) -> RuleScorer:
    """A scorer whose summaries weigh words by these tickets. Clauses: policy_no, clause_no, clause."""
    read = Clauses.read(clauses if clauses is not None else policy_clauses(tickets))
    return RuleScorer(partial(features, weights=document_weights(tickets, text), clauses=read), _reply)
