from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from replygauge.functions import facts as fc

CASES = [
    ("I paid Rs 1,500 and 1500 rupees, INR 1500.00 and ₹1.500,00.", ["money INR 1500.00"]),
    ("$49.99 or 49,99 euros, £7", ["money USD 49.99", "money EUR 49.99", "money GBP 7.00"]),
    ("on 5 March 2024, March 5th, 2024, 2024-03-05", ["date 2024-03-05"]),
    ("5 march, the 3rd of may, sept 14, and the 21st", ["date --03-05", "date --05-03", "date --09-14", "date ---21"]),
    ("after two weeks, 14 days, 2 wks", ["span 14 day"]),
    ("48 hours or 36 hrs, 90 minutes, 120 mins", ["span 2 day", "span 36 hour", "span 90 minute", "span 2 hour"]),
    ("five to 7 working days, 5-7 business days", ["span 5-7 business day"]),
    ("1.5 weeks, two years, a few days, within a week, one business week", ["span 10.5 day", "span 24 month", "span few day", "span 7 day", "span 5 business day"]),
    ("TXN-7710021 and txn7710021", ["transaction 7710021"]),
    ("no facts", []), ("", []), (None, []),
]


def test_facts_in_normal_form(column):
    got = column([t for t, _ in CASES], fc.fact_keys(fc.typed_facts("t")))
    assert got == [want for _, want in CASES]


@pytest.mark.parametrize(("source", "generated", "granted", "want"), [
    ("since 2024-03-05", "on 5 March, that is the 5th", [], []),
    ("since 5 March", "on 5 March 2024", [], ["date 2024-03-05"]),
    ("two weeks ago", "14 days", [], []),
    ("nothing", "Rs 100 within 7 days", ["money INR 100.00"], ["span 7 day"]),
    (None, None, [], []),
])
def test_invented_facts(spark, source, generated, granted, want):
    df = spark.createDataFrame([(source, generated)], "s string, g string")
    keys = {c: fc.fact_keys(fc.typed_facts(c)) for c in "sg"}
    assert df.select(fc.invented_facts(keys["g"], keys["s"], granted).alias("x")).first().x == want


def test_granted_facts(spark):
    clauses = spark.createDataFrame([("A voucher of Rs 100 after more than 3 days",), ("Within 3 days",)], "clause string")
    assert fc.granted_facts(clauses) == ["money INR 100.00", "span 3 day"]


def test_facts_stay_in_the_jvm(spark):
    plan = spark.range(1).select(fc.fact_keys(fc.typed_facts(F.col("id").cast("string"))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
