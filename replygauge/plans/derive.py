"""Tickets and replies derived from the driver tables, row by row.

The prose of the tables is invented and holds no order references or policy
talk. Each row therefore gets one of a few support phrases appended, picked by
its id, and keeps its whole text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replygauge.operators.joins import pair_turns
from replygauge.operators.stages import enrich
from replygauge.sources.tables import dealt, spread, table

TICKET_PHRASES = [
    "Order SNX-1042 was charged twice, please refund one charge of $49.99 within 5 days.",
    "You sent the wrong size for SNX 2210 and I want a replacement.",
    "The mixer arrived damaged on 2024-03-05, ref SNX3307. Please look into it.",
    "My charger is missing from the box.",
    "My refund has not posted after 12 days, see TXN8812345. I will dispute the charge.",
    "The payment gateway fails, txn still failing. PMT reference TXN-7710021.",
    "What is the standard return window?",
    "I entered the wrong address for order SNX-5120 or maybe SNX-5121.",
    "I want to return it under the RMA, it was a COD order.",
    "The parcel never arrived. I am beyond frustrated and my attorney will call.",
    "Tracking has not updated, the NDD date is past and the SLA was missed by 9 days.",
    "I genuinely love the lamp, everything looks great.",
    "not working. please help.",
    "I am pretty annoyed: SNX-88210, snx 6001, SNX-6001 and SNX-7002 still has not shown up.",
    "The driver was an hour late and the food was cold.",
    "Ord SNX-9100 is a DOA unit. I go to the Better Business Bureau after 3 to 5 business days.",
    "I want INR 1,500 back by 5 March 2024, after two weeks of waiting.",
    "I decided 3 times, maybe 2, since the 3rd of may.",
]
# What each of them states, told by hand: (amounts, dates, waits, transactions).
TICKET_FACTS = {
    0: (["$49.99"], [], ["5 days"], []),
    2: ([], ["2024-03-05"], [], []),
    4: ([], [], ["12 days"], ["txn8812345"]),
    5: ([], [], [], ["txn-7710021"]),
    10: ([], [], ["9 days"], []),
    16: (["inr 1,500"], ["5 march 2024"], ["two weeks"], []),
    17: ([], ["3rd of may"], [], []),
}
# The same facts in their normal form, told by hand, in the order of kinds: money, dates, spans, transactions.
TICKET_TYPED = {
    0: ["money USD 49.99", "span 5 day"],
    2: ["date 2024-03-05"],
    4: ["span 12 day", "transaction 8812345"],
    5: ["transaction 7710021"],
    10: ["span 9 day"],
    15: ["span 3-5 business day"],
    16: ["money INR 1500.00", "date 2024-03-05", "span 14 day"],
    17: ["date --05-03"],
}
# How they are written, references apart: transactions, amounts, dates, spans.
TICKET_STATED = {
    0: ["$49.99", "5 days"],
    2: ["2024-03-05"],
    4: ["TXN8812345", "12 days"],
    5: ["TXN-7710021"],
    10: ["9 days"],
    15: ["3 to 5 business days"],
    16: ["INR 1,500", "5 March 2024", "two weeks"],
    17: ["3rd of may"],
}
TICKET_SPANS = {0: ["5 day"], 4: ["12 day"], 10: ["9 day"], 15: ["3-5 business day"], 16: ["2 week"]}
REPLY_PHRASES = [
    "Your refund for order SNX-1042 will reach you within 5 to 7 business days.",
    "We arrange a replacement for SNX 2210 and a pickup within 2 business days.",
    "Order SNX-9999 will be delivered within 4 days.",
    "Please share your order number and a photograph of the damage.",
    "The team will investigate, and a refund takes 3 to 5 business days.",
    "As policy 2 says, you may claim a voucher.",
    "This reply was generated automatically.",
    "Please tell your attorney that we look into it.",
    "Your **refund** of Rs 100 is on its way within 24 hours.",
    "Thank you for your kind words.",
    "We escalate this to a supervisor and confirm delivery within 7 days.",
    "Kindly provide your order reference and the transaction reference.",
    "It may take two weeks, or 48 hrs at best.",
    "Expect it within 30\ndays, not 1.5 business days.",
    "A parcel needs five to 7 working days.",
    "The late parcel is the courier's fault, says our warehouse team.",
    "My instructions do not allow that.",
    "Please send your order number, transaction reference, a photograph and your delivery address.",
    "We look into it for a few days, or within a week.",
    "We have sent INR 750.00 to your card on 7 March 2024.",
    "The 1,500 rupees that you paid were booked on 2024-03-05, that is 336 hours ago.",
]
# What each of them holds, told by hand: time spans, prohibitions, details asked for.
REPLY_SPANS = {
    0: ["5-7 business day"], 1: ["2 business day"], 2: ["4 day"], 4: ["3-5 business day"], 8: ["24 hour"], 10: ["7 day"],
    12: ["2 week", "48 hour"], 13: ["30 day", "1.5 business day"], 14: ["5-7 business day"], 18: ["few day", "a week"],
    20: ["336 hour"],
}
# Facts of the replies in their normal form, told by hand.
REPLY_TYPED = {
    0: ["span 5-7 business day"], 1: ["span 2 business day"], 2: ["span 4 day"], 4: ["span 3-5 business day"],
    8: ["money INR 100.00", "span 1 day"], 10: ["span 7 day"], 12: ["span 14 day", "span 2 day"],
    13: ["span 30 day", "span 1.5 business day"], 14: ["span 5-7 business day"], 18: ["span few day", "span 7 day"],
    19: ["money INR 750.00", "date 2024-03-07"], 20: ["money INR 1500.00", "date 2024-03-05", "span 14 day"],
}
REPLY_CODES = {
    5: ["POLICY_NUMBER"], 6: ["AUTOMATION"], 7: ["LEGAL_THREAT"], 15: ["BLAME", "INTERNAL_TEAM"], 16: ["INSTRUCTIONS"],
}
REPLY_DETAILS = {
    3: ["order reference", "photograph"], 11: ["order reference", "transaction reference"],
    17: ["order reference", "transaction reference", "photograph", "address"],
}
REPLY_ENDS = ["\n\nKind regards,\nThe Support Team", "\n\nThe Support Team.", ""]
CRITERIA = [
    "information_extraction_score",
    "field_coverage_score",
    "issue_addressal_score",
    "resolution_clarity_score",
    "overall_score",
]
TOP_SCORES = dict(zip(CRITERIA, [3, 3, 3, 3, 6], strict=True))


def pick(values: list[str], index: Column) -> Column:
    """The value at index modulo length."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def tickets(spark: SparkSession, folder: str, deal: Callable[[DataFrame], DataFrame] = spread) -> DataFrame:
    """A ticket for each document. ``deal``: how the rows read are dealt out over tasks."""
    docs = deal(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select(
        F.col("doc_id").cast("string").alias("support_ticket_id"),
        F.concat("text", F.lit("\n"), pick(TICKET_PHRASES, F.col("doc_id"))).alias("support_ticket_desc"),
    )


def enriched_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the tickets. Both passes are bound by the processor, so the rows are dealt out over all cores."""
    return enrich(tickets(spark, folder, dealt))


def reply_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Source and reply of each answered user turn, as (pair_id, source, reply)."""
    pairs = spread(pair_turns(table(spark, folder, "conversations")))
    number = F.col("conv_id") + F.col("turn")
    head = F.when(F.pmod(number, F.lit(4)) == 0, F.lit("")).otherwise(F.lit("Dear Customer,\n\n"))
    return pairs.select(
        F.concat_ws("-", "conv_id", "turn").alias("pair_id"),
        F.concat("asked", F.lit("\n"), pick(TICKET_PHRASES, number)).alias("source"),
        F.concat(
            head, F.col("answered"), F.lit("\n"),
            pick(REPLY_PHRASES, F.col("conv_id") * 7 + F.col("turn")), pick(REPLY_ENDS, number),
        ).alias("reply"),
    )
