"""Rubric scores of generated text, from text rules alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replygauge.functions import facts as fc
from replygauge.functions import lexicon as lx
from replygauge.functions import scoring as sc
from replygauge.functions import text as tx
from replygauge.functions.policies import GRANTED


def audit(df: DataFrame, source: str, generated: str, granted: Sequence[str] = tuple(GRANTED)) -> DataFrame:
    """Add the findings and the four criteria with their sum.

    An invented reference, amount, date or transaction pins extraction and addressal
    at 1; a time span no policy grants or a prohibited phrase pins addressal at 1.
    Coverage counts only what the source holds: references, what is asked for, and
    facts, compared by value. Clarity needs a time span or a request for the details
    that are missing. ``granted`` are the facts the policies state (``granted_facts``).

    The findings are columns of their own, so each text is searched once.
    """
    found = df.withColumns({
        "source_refs": tx.ref_ids(source),
        "generated_refs": tx.ref_ids(generated),
        "wanted": tx.requested_resolution(source),
        "given": tx.requested_resolution(generated),
        "source_facts": fc.fact_keys(fc.typed_facts(source)),
        "generated_facts": fc.fact_keys(fc.typed_facts(generated)),
        "violations": tx.violations(generated),
        "requests_details": F.regexp_like(F.lower(generated), F.lit("(?d)" + lx.DETAIL_REQUEST)),
    })
    spans = F.filter("generated_facts", lambda x: x.startswith("span "))
    others = F.filter("generated_facts", lambda x: ~x.startswith("span "))
    judged = found.withColumns({
        "invented": F.array_except("generated_refs", "source_refs"),
        "spans": spans,
        "off_policy": F.array_except(spans, F.array(*map(F.lit, granted)).cast("array<string>")),
        "invented_facts": fc.invented_facts(others, F.col("source_facts"), granted),
        "asks_details": F.col("requests_details") & (F.size("source_refs") == 0),
        "is_ambiguous": F.size("source_refs") > 1,
        "has_ref": F.size("source_refs") > 0,
        "escalation": tx.phrase_flags(source)["escalation"],
        "policy_flag": F.size("violations") > 0,
    })
    invented = (F.size("invented") > 0) | (F.size("invented_facts") > 0)
    unsafe = invented | (F.size("off_policy") > 0) | F.col("policy_flag")
    answered = (F.size("wanted") == 0) | F.arrays_overlap("wanted", "given")
    has_step = (F.size("spans") > 0) | F.col("asks_details")
    need = F.concat("source_refs", "wanted", "source_facts")
    got = F.concat("generated_refs", "given", fc.entailed(F.col("generated_facts")))
    return judged.withColumns({
        "information_extraction_score": sc.cap(F.lit(3), invented),
        "field_coverage_score": sc.coverage_score(sc.coverage(need, got)),
        "issue_addressal_score": sc.cap(F.when(answered, 3).otherwise(2), unsafe),
        "resolution_clarity_score": F.when(has_step, 3).otherwise(2),
    }).withColumn("overall_score", F.col("issue_addressal_score") + F.col("resolution_clarity_score"))
