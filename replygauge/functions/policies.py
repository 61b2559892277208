"""The support policies: what may be promised, clause by clause.

The amounts, day limits and conditions are fixed values that every reply and every
score depends on; the wording is ours. The writer of replies and their judge are
told the same policies in different words.
"""

from __future__ import annotations

from collections.abc import Sequence

#: Policy by its number: what a customer with such a problem writes about.
SUBJECTS = {1: "a refund or a return", 2: "a late delivery", 3: "a wrong or damaged item", 4: "a payment that failed"}

# Amounts, limits and conditions of the clauses, for the writer.
WRITER = [
    ("Refunds and returns", [
        "A full refund or a replacement is possible within 10 days of delivery.",
        "A refund request made later than 10 days after delivery is reviewed case by case.",
        "A refund is processed within 5 to 7 business days after the return has been picked up and verified.",
        "Money that was paid digitally goes back to its original source.",
        "A cash on delivery order is refunded by bank transfer within 7 business days.",
    ]),
    ("Late deliveries", [
        "An order that is delayed more than 3 days beyond the promised date earns a voucher of Rs 100.",
        "An order that is delayed beyond 7 days without a resolution can be refunded in full, and the item need not be returned.",
        "Once a delay is identified, we tell you the revised delivery date without being asked.",
    ]),
    ("Wrong or damaged items", [
        "A wrong item or a damaged item is exchanged by a free replacement or a full refund.",
        "The pickup of a wrong or damaged item is arranged within 2 business days of the complaint.",
        "No return shipping cost is charged for a wrong or damaged item.",
        "Photographs of a damaged or defective item may be requested before a replacement or a refund is processed.",
    ]),
    ("Failed payments", [
        "After a payment failure, an amount deducted for an order that is not confirmed is reversed automatically within 3 to 5 business days.",
        "If a reversal does not show after 5 business days, please share the transaction reference for a manual investigation.",
        "Please do not repeat a payment until the earlier deduction is reversed, which avoids a duplicate charge.",
    ]),
]

# The same amounts, limits and conditions, for the judge.
JUDGE = [
    ("Refunds and returns", [
        "Within 10 days of delivery: full refund or replacement",
        "Later than 10 days: reviewed case by case",
        "Refund processed within 5 to 7 business days, once the return is picked up and verified",
        "Paid digitally: money goes back to its original source",
        "Cash on delivery: bank transfer within 7 business days",
    ]),
    ("Late deliveries", [
        "More than 3 days beyond the promised date: voucher of Rs 100",
        "Beyond 7 days without a resolution: refunded in full, item not returned",
        "The revised delivery date is told without being asked once a delay is identified",
    ]),
    ("Wrong or damaged items", [
        "Free replacement or full refund of a wrong or damaged item",
        "Pickup arranged within 2 business days of the complaint",
        "Return shipping is never charged to the customer",
        "Photographs of damaged or defective items may be requested first",
    ]),
    ("Failed payments", [
        "Payment failure: amount deducted but not confirmed, reversed automatically within 3 to 5 business days",
        "Reversal does not show after 5 business days: customer shares the transaction reference for a manual investigation",
        "No repeated payment until the deduction is reversed",
    ]),
]

#: What the clauses state, in the normal form of ``facts``; a test derives it from them.
GRANTED = [
    "money INR 100.00", "span 10 day", "span 2 business day", "span 3 day", "span 3-5 business day", "span 5 business day",
    "span 5-7 business day", "span 7 business day", "span 7 day",
]


def instruction(opening: str, policies: Sequence[tuple[str, Sequence[str]]]) -> str:
    """An instruction text with numbered policies and their clauses as bullets."""
    blocks = [f"{i}. {title}\n" + "".join(f"- {clause}\n" for clause in clauses) for i, (title, clauses) in enumerate(policies, 1)]
    return opening + "\n\n" + "\n".join(blocks)


def clause_rows(policies: Sequence[tuple[str, Sequence[str]]] = tuple(WRITER)) -> list[tuple[int, int, str]]:
    """(policy_no, clause_no, clause), numbered from 1."""
    return [(i, j, clause) for i, (_, clauses) in enumerate(policies, 1) for j, clause in enumerate(clauses, 1)]
