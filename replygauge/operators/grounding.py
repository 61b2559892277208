"""The clause of the policies that governs a text, found by an inverted index.

The clauses are the documents of the index, BM25 gives their terms whole-numbered
weights, and a text is scored by the distinct terms it shares with each clause. A
policy is a page of text, so its index is read by the driver and becomes part of
the expression: texts are scored in one narrow pass, without a join or a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.functions.facts import fact_keys, typed_facts
from replygauge.functions.text import ColumnOrName, all_labels, as_column
from replygauge.functions import lexicon as lx

#: Words without a subject, and those that the frame of a summary puts into every text.
STOP_WORDS = (
    "that", "with", "will", "from", "after", "been", "this", "your", "have", "than", "when", "they", "which", "more", "once",
    "into", "until", "only", "does", "what", "about", "asks", "ticket", "customer", "writes", "states", "gives", "order",
    "item", "other", "fact", "reference", "matter", "clearly", "further", "taking", "speaks", "made", "need", "tell", "please", "days",
)
#: Letters of a term; what follows is taken for an ending.
STEM = 5
K1, B = 1.2, 0.75
#: Least score that counts as a match: about one term that few clauses have.
LEAST_SCORE = 2000


def terms(text: ColumnOrName) -> Column:
    """The terms of a text in order, with repeats: words of four letters or more, cut to their stem."""
    words = F.regexp_extract_all(F.lower(F.coalesce(as_column(text), F.lit(""))), F.lit("[a-z]{4,}"), F.lit(0))
    stop = F.lit(f" {' '.join(STOP_WORDS)} ")
    return F.transform(F.filter(words, lambda w: ~F.contains(stop, F.concat(F.lit(" "), w, F.lit(" ")))), lambda w: F.substring(w, 1, STEM))


def clause_index(clauses: DataFrame) -> DataFrame:
    """Postings (term, policy_no, clause_no, weight) of clauses; the weight is 1000 times BM25's, rounded."""
    key = ["policy_no", "clause_no"]
    each = clauses.select(*key, terms("clause").alias("terms"))
    sizes = each.select(*key, F.size("terms").alias("size"))
    totals = sizes.agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean")).first()
    counted = each.select(*key, F.explode("terms").alias("term")).groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf"))
    held = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rare = F.log(1 + (F.lit(totals.n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    full = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.lit(totals.mean)))
    return counted.join(held, "term").join(sizes, key).select("term", *key, F.round(1000 * rare * full).cast("int").alias("weight"))


def _constant(value: object, schema: str) -> Column:
    """A nested constant as one literal, which the optimizer evaluates once."""
    return F.from_json(F.lit(json.dumps(value)), schema)


@dataclass(frozen=True)
class Clauses:
    """Clauses with their index, what they grant and the facts they state; small enough to be part of an expression."""

    rows: tuple[tuple[int, int, str], ...]
    postings: dict[str, list[int]]
    granted: tuple[list[str], ...]
    facts: tuple[list[str], ...]
    least: int = LEAST_SCORE

    @classmethod
    def read(cls, clauses: DataFrame, least: int = LEAST_SCORE) -> Clauses:
        """From rows (policy_no, clause_no, clause)."""
        told = clauses.select("policy_no", "clause_no", "clause", all_labels(F.lower("clause"), lx.RESOLUTIONS).alias("granted"), fact_keys(typed_facts("clause")).alias("facts"))
        found = sorted(told.collect(), key=lambda r: (r.policy_no, r.clause_no))
        place = {(r.policy_no, r.clause_no): i for i, r in enumerate(found)}
        postings: dict[str, list[int]] = {}
        for r in clause_index(clauses).collect():
            postings.setdefault(r.term, [0] * len(found))[place[r.policy_no, r.clause_no]] = r.weight
        return cls(tuple((r.policy_no, r.clause_no, r.clause) for r in found), postings, tuple(list(r.granted) for r in found), tuple(list(r.facts) for r in found), least)

    def scores(self, text: ColumnOrName) -> Column:
        """Array of the score of each clause."""
        weights = _constant(self.postings, "map<string,array<int>>")
        shared = F.array_intersect(F.map_keys(weights), terms(text))
        none = F.array_repeat(F.lit(0), len(self.rows))
        return F.aggregate(shared, none, lambda total, term: F.zip_with(total, F.element_at(weights, term), lambda a, b: a + b))

    def best(self, scores: Column) -> Column:
        """Place (from 1) of the clause with the highest score, the first on a tie; null below the least score."""
        top = F.array_max(scores)
        return F.when(top >= self.least, F.array_position(scores, top).cast("int"))

    def pick(self, place: Column, values: Sequence, kind: str = "string") -> Column:
        """The value that belongs to the clause at a place; null without one."""
        return F.try_element_at(_constant(list(values), f"array<{kind}>"), place)

    def clause(self, place: Column) -> Column:
        return self.pick(place, [text for _, _, text in self.rows])


def ground(df: DataFrame, text: str, clauses: Clauses) -> DataFrame:
    """Add the best clause of a text: score, place, policy_no, clause_no, clause, is_covered.

    A row with no clause is covered by no policy and belongs in front of a person.
    """
    scored = df.withColumn("clause_scores", clauses.scores(text))
    placed = scored.withColumn("clause_place", clauses.best(F.col("clause_scores")))
    place = F.col("clause_place")
    return placed.select(
        *df.columns, F.array_max("clause_scores").alias("clause_score"), "clause_place",
        clauses.pick(place, [n for n, _, _ in clauses.rows], "int").alias("policy_no"), clauses.pick(place, [n for _, n, _ in clauses.rows], "int").alias("clause_no"),
        clauses.clause(place).alias("clause"), place.isNotNull().alias("is_covered"),
    )
