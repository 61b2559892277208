from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.functions import text as tx

WORDS = [
    "still", "has", "not", "hasnt", "has n't", "arrived", "delivered", "never", "processing", "update", "the", "my",
    "address", "model", "wrong", "item", "pre-auth", "preauth", "delay", "dent", "student", "bbb", "refund", "RMA", "ord",
    "SNX-1234", "snx 55", "SNX_1234", "SNX-12345", "é", "ß", "...", "5 to 7 business days", "3 weeks", "24hours",
]
GAPS = [" ", "  ", "\n", "\t", "\xa0", " \x1c", "　", "\r\n", "\x85", " "]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    made = [
        "".join(rng.choice(WORDS) + rng.choice(GAPS) for _ in range(rng.randint(0, 14))) for _ in range(400)
    ]
    return [*made, "", " ", "\n\n", "\x1f", "　", "x"]


def test_word_count_and_blank_are_those_of_split_and_strip(column, texts):
    assert column(texts, tx.word_count("t")) == [len(t.split()) for t in texts]
    assert column(texts, tx.is_blank("t")) == [not t.strip() for t in texts]
    assert column(texts, tx.strip("t")) == [t.strip() for t in texts]
    assert column(texts, tx.has_words("t", 8)) == [len(t.split()) >= 8 for t in texts]
    assert column([None], tx.word_count("t")) == [0]
    assert column([None], tx.is_blank("t")) == [True]


@pytest.mark.parametrize("pattern", [p for p, _ in lx.CATEGORY_RULES] + list(lx.PHRASE_FLAGS.values()))
def test_phrase_matching_equals_the_plain_regular_expression(column, texts, pattern):
    texts = [*texts, *(a.replace("\\", "") for a in pattern.split("|"))]
    want = [bool(re.search(pattern, t.lower())) for t in texts]
    assert column(texts, tx.matches(F.lower("t"), pattern)) == want


def test_classify(column):
    cases = {
        "I was charged twice for a wrong item": "Duplicate Charge",
        "WRONG SIZE again": "Wrong Item",
        "the box has a dent": "Damaged or Defective Item",
        "my charjer is mising": "Missing Item or Part",
        "refund not received": "Refund Delay",
        "there is a pre-auth hold": "Payment Failure",
        "what is the return window": "Policy Question",
        "please update my delivery address": "Order Modification",
        "I want to return this": "Return or Exchange",
        "it still hasnt arrived": "Non-Delivery",
        "it still has n't arrived": "Non-Delivery",
        "not working. please help.": "Unclear",
        "one two three four five six seven": "Unclear",
        "one two three four five six seven eight": "Delivery Delay",
        "not the one\nI ordered, another model came in here": "Delivery Delay",
    }
    assert column(list(cases), tx.classify("t")) == list(cases.values())
    assert column([None], tx.classify("t")) == ["Unclear"]


def test_references(column):
    cases = {
        "SNX-4421 and snx 4421 and SNX4421": (["SNX-4421", "SNX4421"], "SNX-4421 OR SNX4421"),
        "SNX-88210": (["SNX-8821"], "SNX-8821"),
        "a SNX-1, SNX-303, SNX-404, SNX-505": (["SNX-303", "SNX-404", "SNX-505"], "SNX-303 OR SNX-404"),
        "none": ([], "NOT_PROVIDED"),
    }
    assert column(list(cases), tx.ref_ids("t")) == [ids for ids, _ in cases.values()]
    assert column(list(cases), tx.order_refs("t")) == [shown for _, shown in cases.values()]
    assert column(list(cases), tx.is_ambiguous("t")) == [True, False, True, False]
    assert column([None], tx.order_refs("t")) == ["NOT_PROVIDED"]


def test_nothing_is_invented_when_generated_equals_source(column, texts):
    assert not any(column(texts, tx.invented_refs("t", "t")))
    assert column(["SNX-100"], tx.invented_refs("t", F.lit("SNX-100, SNX-200"))) == [["SNX-200"]]


def test_phrase_flags(column):
    texts = ["I have had it with you", "annoyed", "I genuinely love it", "the FTC will hear", "calm"]
    flags = tx.phrase_flags("t")
    got = {name: column(texts, flag) for name, flag in flags.items()}
    assert got["angry"] == [True, False, False, False, False]
    assert got["frustrated"] == [False, True, False, False, False]
    assert got["positive"] == [False, False, True, False, False]
    assert got["escalation"] == [False, False, False, True, False]


def test_between_markers(column):
    cases = {
        "x RAW TICKET:\n a b \n\nTRIAGE RECORD z": "a b",
        "RAW TICKET: a\n\nGENERATED b\n\nTRIAGE RECORD": "a",
        "RAW TICKET: to the end \n": "to the end",
        "RAW TICKET:  \n\nTRIAGE RECORD": "TRIAGE RECORD",
        "  no marker ": "no marker",
    }
    assert column(list(cases), tx.between_markers("t")) == list(cases.values())


def test_label_by_phrase(column):
    cases = {
        "You are a\n  TRIAGE\tanalyst": "summarise",
        "auditing the summarisation\nstage": "judge_summary",
        "a senior customer support agent": "respond",
        "auditing the response-generation stage": "judge_response",
        "else": "unknown",
    }
    assert column(list(cases), tx.label_by_phrase("t")) == list(cases.values())


def test_timeframes(column):
    texts = ["within 5 to 7 business days or 10 days", "24hours, 3-5 Business Days, 3 to 5 business days", "soon"]
    assert column(texts, tx.timeframes("t")) == [
        ["5-7 business day", "10 day"], ["24 hour", "3-5 business day"], [],
    ]
    assert column(texts, tx.off_policy_timeframes("t")) == [[], ["24 hour"], []]


def test_hard_facts(column):
    text = "I paid $89.99 or Rs 100 on 2024-03-05, waited 14 days until the 15th, TXN8821047"
    (facts,) = column([text], tx.hard_facts("t"))
    assert facts.asDict() == {
        "amounts": ["$89.99", "rs 100"], "dates": ["2024-03-05", "15th"],
        "waits": ["14 days"], "transactions": ["txn8821047"],
    }


def test_requested_resolution(column):
    assert column(["refund or replace it, then escalate", "hello"], tx.requested_resolution("t")) == [
        ["refund", "replacement", "escalation"], [],
    ]


def test_summary_form(column):
    texts = ["Version 3.5 works. It is fine! " + "word " * 30, "- point one\n- point two", "# Title\nbody", "One"]
    assert column(texts, tx.sentence_count("t")) == [3, 1, 1, 1]
    form = tx.summary_form("t")
    assert column(texts, form["words_ok"]) == [True, False, False, False]
    assert column(texts, form["sentences_ok"]) == [True, False, False, False]
    assert column(texts, form["no_bullets"]) == [True, False, True, True]
    assert column(texts, form["no_headings"]) == [True, True, False, True]
    assert column(texts, tx.form_ok(form)) == [True, False, False, False]


def test_reply_form_and_violations(column):
    good = "Dear Customer,\n\n" + "word " * 120 + "\n\nThe Support Team"
    texts = [good, "Hi, **bold**", "My attorney says policy 2 is generated automatically"]
    form = tx.reply_form("t")
    assert column(texts, tx.form_ok(form)) == [True, False, False]
    assert column(texts, form["plain_text"]) == [True, False, True]
    assert column(texts, tx.violations("t")) == [[], [], ["LEGAL_THREAT", "POLICY_NUMBER", "AUTOMATION"]]


def test_asks_for_details(column):
    reply = F.lit("Please share your order number.")
    assert column(["no ref", "SNX-123"], tx.asks_for_details(reply, "t")) == [True, False]


def test_shorthand_is_expanded_at_first_use_only(spark):
    df = spark.createDataFrame([("RMA and rma, Ord 12 for NDD", ), ("words and order",), (None,)], "t string")
    got = [row.x for row in tx.expand_shorthand(df, "t", "x").collect()]
    assert got == [
        "RMA (return merchandise authorisation) and rma, Ord (order) 12 for NDD (next day delivery)",
        "words and order",
        None,
    ]


def test_generic_reasoning(column):
    texts = ["Good summary.", "It keeps SNX-123.", "It is complete.", "Great reply about SNX-123"]
    assert column(texts, tx.is_generic_reasoning("t", F.lit("Order snx-123 cost $5"))) == [True, False, True, True]


@pytest.mark.parametrize("pattern, text, want", [
    ("abc[(]x|def", "a def b", True), ("a[]|]b|cd", "x a|b y", True), ("a[]|]b|cd", "cd", True), ("[^]|]z|q", "q", True), ("a|(b", "z", None),
])
def test_brackets_inside_a_class_do_not_hide_a_bar(column, pattern, text, want):
    assert len(tx._alternatives(pattern)) == (2 if want is not None else 1)
    if want is not None and "[]" not in pattern and "[^]" not in pattern:
        assert column([text], tx.matches(F.lower("t"), pattern)) == [want]


@pytest.mark.parametrize("text, spans", [
    ("2 months", ["2 month"]), ("two weeks", ["2 week"]), ("30 minutes", ["30 minute"]), ("48 hrs", ["48 hour"]),
    ("9 working days", ["9 business day"]), ("within 30\ndays", ["30 day"]), ("5–7 business days", ["5-7 business day"]),
    ("1.5 business days", ["1.5 business day"]), ("five to seven days", ["5-7 day"]), ("a few days", ["few day"]),
    ("within a week", ["a week"]), ("seventy days", ["70 day"]), ("have a day, someone days, v2 day", []),
])
def test_time_spans(column, text, spans):
    assert column([text], tx.timeframes("t")) == [spans]


@pytest.mark.parametrize("text, kind, found", [
    ("decided 3, marked 20, maybe 2", "dates", []), ("on 5 March 2024 it", "dates", ["5 march 2024"]),
    ("march 5, 2024", "dates", ["march 5, 2024"]), ("the 3rd of may and 12th", "dates", ["3rd of may", "12th"]),
    ("1,500 rupees, INR 500, $49.99", "amounts", ["1,500 rupees", "inr 500", "$49.99"]), ("for two weeks", "waits", ["two weeks"]),
])
def test_facts(column, text, kind, found):
    assert column([text], tx.hard_facts("t")[kind]) == [found]


def test_details_asked_for(column):
    four = "please send your order number, transaction reference, a photograph and your delivery address."
    assert column([four, "send a photograph", "thanks", None], tx.asks_too_much("t")) == [True, False, False, False]
