"""Extractive summaries of tickets under a budget of words.

A summary says what the ticket is about and what it asks for, quotes the sentences
that say most, and lists the references and facts as they are written. What a
sentence says is weighed by how few tickets have its words: one pass counts, for
each of a fixed number of hash buckets, the tickets with a word in it, and the driver
gets one byte per bucket. With these weights a summary is an expression.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.functions import text as tx
from replygauge.functions.text import ColumnOrName, as_column

#: Buckets of words, by four hexadecimal digits of their MD5.
BUCKETS = 1 << 16
#: Weight of a word that hardly any ticket has.
RAREST = 15
#: Words a summary aims at before terms are written out, which adds up to 18 words.
WORDS = 52
#: Facts that are listed.
FACTS = 5
LEAD = "The customer writes:"
_PIECE_END = r"[.!?]+(?:\s+|\z)|\n+"
# White space is written sign by sign, which makes the class one table for the search.
_TOKEN = r"[^ \t\n\x0b\f\r.,;:!?()\"]+"
_WORD = r"[^ \t\n\x0b\f\r]+"


def _place(bucket: int) -> int:
    """Where a bucket stands in the tables of this module: bits of the checksum of its two bytes, which are one-to-one."""
    return zlib.crc32(bucket.to_bytes(2)) >> 4 & 0xFFFF


def _places(tokens: Column) -> Column:
    """The distinct places of words. Checksums of bytes take far less time than reading hexadecimal digits as a number."""
    def place(token: Column) -> Column:
        return F.shiftright(F.crc32(F.unhex(F.substring(F.md5(token), 1, 4))), 4).bitwiseAND(F.lit(0xFFFF))

    return F.array_distinct(F.transform(tokens, place))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


def document_weights(df: DataFrame, text: ColumnOrName) -> bytes:
    """One byte per bucket: the bits of (rows / rows with a word in the bucket), at most ``RAREST``.

    Counts combine before the shuffle and there is one row per bucket after it, so
    the driver receives 65,536 rows whatever the size of the table.
    """
    texts = df.select(F.coalesce(as_column(text), F.lit("")).alias("text"))
    total = texts.count()
    # a word that repeats is hashed once
    places = _places(F.array_distinct(_tokens(F.col("text"))))
    counted = texts.select(F.explode(places).alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    table = counted.toArrow()
    held = dict(zip(table["place"].to_pylist(), table["n"].to_pylist(), strict=True))
    counts = (held.get(_place(bucket)) for bucket in range(BUCKETS))
    return bytes(RAREST if n is None else min((total // n).bit_length(), RAREST) for n in counts)


def stated_facts(text: ColumnOrName, raw: Column) -> Column:
    """References and facts as they are written, white space apart; facts from ``raw_facts``."""
    refs = F.regexp_extract_all(F.coalesce(as_column(text), F.lit("")), F.lit(lx.REF_PATTERN), F.lit(0))
    found = F.concat(refs, *[raw[kind] for kind in ("transaction", "money", "date", "span")])
    return F.array_distinct(F.transform(found, lambda x: F.regexp_replace(F.regexp_replace(x, r"\.\s+", "."), r"\s+", " ")))


def ranked_pieces(text: ColumnOrName, weights: bytes) -> Column:
    """The sentences of a text, the weightiest first: structs of rank, at and words."""
    text = F.coalesce(as_column(text), F.lit(""))
    placed = bytearray(BUCKETS)
    for bucket, weight in enumerate(weights):
        placed[_place(bucket)] = weight
    table = F.lit(placed)

    def weighed(place: Column) -> Column:
        return F.ascii(F.substring(table, place.cast("int") + 1, F.lit(1)).cast("string"))

    def cut(piece: Column, at: Column) -> Column:
        return F.struct(at.alias("at"), F.regexp_extract_all(piece, F.lit(_WORD), F.lit(0)).alias("words"), piece.alias("piece"))

    def scored(x: Column) -> Column:
        total = F.aggregate(_places(_tokens(x["piece"])), F.lit(0), lambda a, place: a + weighed(place))
        score = F.floor(total * 100 / (F.size(x["words"]) + 4)).cast("int")
        return F.struct((-score).alias("rank"), x["at"].alias("at"), x["words"].alias("words"))

    # one step after the other, so that the words of a sentence are found once
    pieces = F.filter(F.transform(F.split(text, _PIECE_END), cut), lambda x: F.size(x["words"]) > 0)
    return F.array_sort(F.transform(pieces, scored))


def extract(pieces: Column, budget: Column, least: Column) -> Column:
    """The best sentences that fit the budget of words, in the order of the text, joined by semicolons.

    Sentences are tried from the weightiest on; one that does not fit is passed over.
    If that leaves fewer words than ``least``, the weightiest sentence passed over
    fills the budget and is cut there.
    """
    chosen = "array<struct<at:int,words:array<string>>>"
    start = F.struct(budget.cast("int").alias("left"), F.array().cast(chosen).alias("got"), F.lit(None).cast("struct<at:int,words:array<string>>").alias("over"))

    def take(state: Column, piece: Column) -> Column:
        own = F.struct(piece["at"].alias("at"), piece["words"].alias("words"))
        fits = F.size(piece["words"]) <= state["left"]
        return F.when(fits, F.struct((state["left"] - F.size(piece["words"])).alias("left"), F.array_append(state["got"], own).alias("got"), state["over"].alias("over"))).otherwise(
            F.struct(state["left"].alias("left"), state["got"].alias("got"), F.coalesce(state["over"], own).alias("over"))
        )

    def finish(state: Column) -> Column:
        cut = F.struct(state["over"]["at"].alias("at"), F.slice(state["over"]["words"], F.lit(1), F.greatest(state["left"], F.lit(0))).alias("words"))
        short = (budget - state["left"] < least) & state["over"].isNotNull() & (state["left"] > 0)
        got = F.array_sort(F.when(short, F.array_append(state["got"], cut)).otherwise(state["got"]))
        return F.array_join(F.transform(got, lambda x: F.array_join(x["words"], " ")), "; ")

    return F.aggregate(pieces, start, take, finish)


def summary_parts(category: Column, wanted: Column, escalation: Column, ids: Column, stated: Column) -> tuple[Column, Column]:
    """What the ticket is about, and what it states."""
    about = F.concat(
        F.when(category == lx.UNCLEAR, F.lit("The ticket does not say clearly what the matter is")).otherwise(F.concat(F.lit("The ticket is about "), F.lower(category))),
        F.when(F.size(wanted) > 0, F.concat(F.lit(" and asks for "), F.array_join(wanted, " and "))).otherwise(F.lit("")),
        F.when(escalation, F.lit("; the customer speaks of taking it further")).otherwise(F.lit("")),
        F.lit("."),
    )
    listed = F.concat(F.lit("It states "), F.array_join(F.slice(stated, 1, FACTS), ", "))
    states = F.when(F.size(stated) == 0, F.lit("It gives no order reference and no other fact.")).when(
        F.size(ids) == 0, F.concat(listed, F.lit(" and gives no order reference."))
    ).otherwise(F.concat(listed, F.lit(".")))
    return about, states


def summarise(df: DataFrame, prefix: str) -> DataFrame:
    """Add ``<prefix>summary`` from the columns ``<prefix>`` category, wanted, escalation, ids, stated and pieces."""
    c = {n: F.col(prefix + n) for n in ("category", "wanted", "escalation", "ids", "stated", "pieces")}
    about, states = summary_parts(c["category"], c["wanted"], c["escalation"], c["ids"], c["stated"])
    df = df.withColumns({prefix + "about": about, prefix + "states": states})
    fixed = tx.word_count(prefix + "about") + tx.word_count(prefix + "states") + len(LEAD.split())
    df = df.withColumn(prefix + "fixed", fixed)
    least = F.lit(lx.SUMMARY_WORDS[0]) - F.col(prefix + "fixed")
    budget = F.greatest(F.lit(6), F.lit(WORDS) - F.col(prefix + "fixed"))
    df = df.withColumn(prefix + "extract", extract(c["pieces"], budget, least))
    quoted = F.when(F.col(prefix + "extract") != "", F.concat(F.lit(f"{LEAD} "), F.col(prefix + "extract"), F.lit(".")))
    df = df.withColumn(prefix + "draft", F.concat_ws(" ", F.col(prefix + "about"), quoted))
    df = tx.expand_shorthand(df, prefix + "draft", prefix + "written")
    return df.withColumn(prefix + "summary", F.concat_ws(" ", prefix + "written", prefix + "states"))
