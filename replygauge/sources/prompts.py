"""Instruction texts and the policy clauses inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replygauge.functions.text import WHITESPACE, ColumnOrName, as_column, label_by_phrase, timeframes

_POLICY = r"(?m)^(\d+)\. ([^\n]*)\n((?:[-•] [^\n]*\n(?: +[^\n]*\n)*)+)"


def load_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per text file: name, text without trailing whitespace, version hash,
    and the stage its wording is about."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt")
    text = F.rtrim("value", F.lit(WHITESPACE))
    return files.select(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "").alias("prompt"),
        text.alias("text"),
    ).withColumns({"version": F.sha2("text", 256), "stage": label_by_phrase("text")})


def policy_clauses(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Numbered policies and their bullets, as (key, policy_no, clause_no, clause); clauses count from 1."""
    body = F.concat(F.col(text), F.lit("\n"))
    blocks = F.regexp_extract_all(body, F.lit(_POLICY), F.lit(0))
    policies = texts.select(key, F.explode(blocks).alias("block"))
    bullets = F.filter(
        F.split(F.regexp_replace("block", r"\n +", " "), r"\n"), lambda line: line.startswith("- ")
    )
    return policies.select(
        key,
        F.regexp_extract("block", r"^(\d+)", 1).cast("int").alias("policy_no"),
        F.posexplode(bullets).alias("place", "bullet"),
    ).select(key, "policy_no", (F.col("place") + 1).alias("clause_no"), F.ltrim("bullet", F.lit("- ")).alias("clause"))


def clause_facts(clause: ColumnOrName) -> Column:
    """The numbers and units of a clause, which survive rewording."""
    amounts = F.regexp_extract_all(F.lower(as_column(clause)), F.lit(r"rs\.? ?\d+"), F.lit(0))
    return F.array_union(timeframes(clause), amounts)
