from __future__ import annotations

import re
from hashlib import md5

from pyspark.sql import functions as F

from replygauge.functions import facts as fc
from replygauge.operators.summarise import _place, document_weights, ranked_pieces


def test_facts_are_looked_for_only_where_one_can_begin(spark):
    """The starts that are tried first lose no match of the plain patterns."""
    parts = ["Rs. 1,500", "rs 20", "xrs 20", "INR5", "€ 3.50", "a$4", "7 pounds", "x7 euros", "12 dollars,", "2024-03-05", "3rd of MAY", "Sept. 9th, 2023",
             "within an hour", "few days", "couple of weeks", "SEVENTY-two hrs", "1.5 business days", "x5 days", "ten to twelve working days", "TXN-77100", "ſix days",
             "for a\nmonth", "Eleven or 12 minutes", "21st", "31 december 2024"]
    texts = [" ".join(parts[i:] + parts[:i]) for i in range(len(parts))] + [sep.join(parts) for sep in ("\n", ". ", "-", "")] + ["", None]
    df = spark.createDataFrame([(x,) for x in texts], "text string")
    whole = F.coalesce(F.col("text"), F.lit(""))
    plain = F.struct(*[F.regexp_extract_all(whole, F.lit("(?i)" + pattern), F.lit(0)).alias(kind) for kind, (pattern, _) in fc._FORMS.items()])
    rows = df.select(fc.raw_facts("text").alias("fast"), plain.alias("plain")).collect()
    assert all(row.fast == row.plain for row in rows) and all(rows[0].plain)
    assert all(fc._STARTS[kind] in str(df.select(fc.raw_facts("text"))._jdf.queryExecution().analyzed()) for kind in ("money", "date", "span"))


def test_pieces_and_weights_of_odd_texts(spark):
    texts = ["One two. ΟΔΟΣ three! One\x1cfour five", "  \n\n one one (two)...\nthree", "İstanbul K. ΑΣ", "...", "", None]
    df = spark.createDataFrame([(x,) for x in texts], "text string")
    weights = document_weights(df, "text")
    whole = F.coalesce(F.col("text"), F.lit(""))
    tokens = F.regexp_extract_all(F.lower(whole), F.lit(r"[^\s.,;:!?()\"]+"), F.lit(0))
    bucket = F.conv(F.substring(F.md5("t"), 1, 4), 16, 10).cast("int").alias("bucket")
    counts = df.withColumn("id", F.monotonically_increasing_id()).select("id", F.explode(tokens).alias("t")).select("id", bucket).distinct().groupBy("bucket").count()
    want = bytearray([15]) * 65536
    for row in counts.collect():
        want[row.bucket] = min((len(texts) // row["count"]).bit_length(), 15)
    assert weights == bytes(want)
    words = F.transform(F.split(whole, r"[.!?]+(?:\s+|\z)|\n+"), lambda x: F.regexp_extract_all(x, F.lit(r"\S+"), F.lit(0)))
    found = df.select(ranked_pieces("text", weights).alias("got"), words.alias("words")).collect()
    for row in found:
        assert sorted((x.at, x.words) for x in row.got) == [(i, x) for i, x in enumerate(row.words) if x]
        assert [(x.rank, x["at"]) for x in row.got] == sorted((x.rank, x["at"]) for x in row.got)
        for x in row.got:
            low = spark.range(1).select(F.lower(F.lit(" ".join(x.words)))).first()[0]
            distinct = {int(md5(t.encode()).hexdigest()[:4], 16) for t in re.findall(r"[^\s.,;:!?()\"]+", low, re.ASCII)}
            assert x.rank == -(sum(weights[b] for b in distinct) * 100 // (len(x.words) + 4))


def test_words_of_a_sentence_are_found_once(spark):
    plan = str(spark.createDataFrame([("a b",)], "text string").select(ranked_pieces("text", bytes(65536)).alias("x"))._jdf.queryExecution().analyzed())
    assert plan.count("regexp_extract_all(") == 2


def test_no_word_is_read_as_a_number_digit_by_digit(spark):
    """Buckets stand where a checksum puts them, one to one; the table follows."""
    assert sorted(map(_place, range(65536))) == list(range(65536))
    plan = str(spark.createDataFrame([("a b",)], "text string").select(ranked_pieces("text", bytes(65536)).alias("x"))._jdf.queryExecution().analyzed())
    assert "conv(" not in plan and "crc32(" in plan
