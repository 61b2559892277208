"""A stand-in model for the queries: it answers with the number of words of the prompt.

It works on whole batches. Some phrases of a prompt make it fail in one of the
ways that models fail.
"""

from __future__ import annotations

import pandas as pd

from replygauge.operators.stages import BatchScorer, ModelSettings

REFUSED = "DOA unit"
# Phrase of a ticket to the fault it brings about in the model named faulty.
FAULTS = {
    "prose": "standard return window",
    "wrong_shape": "missing from the box",
    "open_fence": "entered the wrong address",
    "truncated": "COD order",
    "lost": "genuinely love",
}
# In the judgement of a summary only.
OUT_OF_RANGE = "beyond frustrated"


def make_scorer(settings: ModelSettings) -> BatchScorer:
    faulty = settings.model == "faulty"

    def body(words: pd.Series, text: pd.Series) -> pd.Series:
        n, low = words.astype(str), (words % 3 + 1).astype(str)
        if settings.stage == "summarise":
            return '"summary": "' + n + ' words"'
        if settings.stage == "respond":
            return '"response": "Dear Customer, ' + n + ' words."'
        if settings.stage == "judge_summary":
            score = low.mask(text.str.contains(OUT_OF_RANGE, regex=False), "9") if faulty else low
            return (
                '"information_extraction_score": ' + score + ', "information_extraction_reasoning": "' + n
                + ' words", "field_coverage_score": 3, "field_coverage_reasoning": "whole"'
            )
        total = (words % 3 + 3).astype(str)
        return (
            '"issue_addressal_score": ' + low + ', "issue_addressal_reasoning": "' + n + ' words", "resolution_clarity_score": 2, '
            '"resolution_clarity_reasoning": "some", "overall_score": ' + total + ', "overall_reasoning": "sum"'
        )

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        text = batch["messages"].str[-1].str["content"]
        words = text.str.count(r"\S+")
        good = '{"output": {' + body(words, text) + "}}"
        raw, gone = good, pd.Series(False, text.index)
        if faulty:
            has = {fault: text.str.contains(phrase, regex=False) for fault, phrase in FAULTS.items()}
            raw = raw.mask(has["prose"], "I can not say that as JSON.").mask(has["wrong_shape"], good.str.slice(11, -1))
            raw = raw.mask(has["open_fence"], "```json\n" + good).mask(has["truncated"], good.str.slice(0, -4))
            gone = has["lost"]
        refused = text.str.contains(REFUSED, regex=False)
        error = pd.Series(None, text.index, dtype=object).mask(refused, "ValueError: refused")
        out = pd.DataFrame({"request_key": batch["request_key"], "raw": raw.mask(refused, None), "error": error})
        return out[~gone]

    return score
