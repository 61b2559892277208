"""Two wordings of one policy, clause by clause.

The writer and the judge of replies are told the same policies in different words.
Clauses are matched one to one within a policy, by the words and the facts they
share, and the matched ones are compared by their facts: a clause that says 3 where
the other says 2 is found however it is worded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.functions.facts import fact_keys, typed_facts
from replygauge.operators.grounding import terms
from replygauge.session import stored

#: Least likeness, in thousandths, of clauses that may be the same one.
LEAST_LIKENESS = 250

SAME, CHANGED, WRITER_ONLY, JUDGE_ONLY = "same", "changed", "writer only", "judge only"


def likeness(words_a: Column, words_b: Column, facts_a: Column, facts_b: Column) -> Column:
    """Share, in thousandths, of the smaller clause's distinct terms and facts that the other has too."""
    a, b = F.array_distinct(F.concat(words_a, facts_a)), F.array_distinct(F.concat(words_b, facts_b))
    smaller = F.least(F.size(a), F.size(b))
    return F.when(smaller == 0, 0).otherwise(F.floor(F.size(F.array_intersect(a, b)) * 1000 / smaller).cast("int"))


def matched(candidates: Column) -> Column:
    """Of structs (rank, writer_no, judge_no) the pairs that a mutual best-first choice makes.

    The best pair of all is taken, then the best among what is left, and so on; a tie
    goes to the earlier clauses.
    """
    none = F.array().cast("array<struct<rank:int,writer_no:int,judge_no:int>>")

    def take(chosen: Column, pair: Column) -> Column:
        used = F.exists(chosen, lambda x: (x["writer_no"] == pair["writer_no"]) | (x["judge_no"] == pair["judge_no"]))
        return F.when(used, chosen).otherwise(F.array_append(chosen, pair))

    return F.aggregate(F.array_sort(candidates), none, take)


def mirror_clauses(writer: DataFrame, judge: DataFrame, least: int = LEAST_LIKENESS) -> DataFrame:
    """Clauses of both sides: policy_no, writer_no, judge_no, writer_clause, judge_clause, likeness, facts that differ, status.

    Each side: policy_no, clause_no, clause. A group is one policy, a page of text at
    most. Clauses that match none are one-sided; matched ones with other facts are changed.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return stored(df.select(
            "policy_no", F.col("clause_no").alias(f"{name}_no"), F.col("clause").alias(f"{name}_clause"),
            F.array_distinct(terms("clause")).alias(f"{name}_terms"), fact_keys(typed_facts("clause")).alias(f"{name}_facts"),
        ), f"{name}-clauses")

    left, right = side(writer, "writer"), side(judge, "judge")
    pairs = left.join(right, "policy_no").withColumn("likeness", likeness(*(F.col(f"{n}_{k}") for k in ("terms", "facts") for n in ("writer", "judge"))))
    near = pairs.where(F.col("likeness") >= least)
    groups = near.groupBy("policy_no").agg(F.collect_list(F.struct((-F.col("likeness")).alias("rank"), "writer_no", "judge_no")).alias("near"))
    links = groups.select("policy_no", F.explode(matched(F.col("near"))).alias("x")).select("policy_no", "x.writer_no", "x.judge_no", (-F.col("x.rank")).alias("likeness"))
    whole = left.join(links, ["policy_no", "writer_no"], "left").join(right, ["policy_no", "judge_no"], "full_outer")
    writer_facts, judge_facts = (F.coalesce(F.col(f"{n}_facts"), F.array().cast("array<string>")) for n in ("writer", "judge"))
    differ = F.array_sort(F.concat(F.array_except(writer_facts, judge_facts), F.array_except(judge_facts, writer_facts)))
    status = F.when(F.col("judge_no").isNull(), WRITER_ONLY).when(F.col("writer_no").isNull(), JUDGE_ONLY).when(F.size(differ) > 0, CHANGED).otherwise(SAME)
    return whole.select(
        "policy_no", "writer_no", "judge_no", "writer_clause", "judge_clause", "likeness",
        F.when(status == CHANGED, differ).otherwise(F.array().cast("array<string>")).alias("differing_facts"), status.alias("status"),
    )
