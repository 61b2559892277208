"""Benchmark decontamination by spaced-seed hashing.

A seed is the hash of the words at the compared places of a mask; the ignored
places may hold any word, so a seed survives substitutions there. Seeds of all
positions of all benchmark items meet the seeds of all positions of all
documents. Around each hit, document and item are laid side by side and the
stretch with the most agreeing words is found, among all that agree in more than
four of five words.

Built-in functions only: positions are exploded and hashed inside one generated
loop, so no row but a hit leaves it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.llm.common import written

#: 1: compared, 0: ignored. Together they hit every stretch of 10 to 23 words that has ten agreeing words and agrees in more
#: than four of five. A longer stretch holds one of these: of its halves, one agrees in as large a share, and has ten such words.
MASKS = ("110111", "11001011")
#: For items judged as a whole: mask, and the fewest and most words it is for (None: no end). Together they hit every item of
#: which four fifths agree; one of up to four words has to agree in all.
SHORT_MASKS = (("1", 1, 1), ("11", 2, 2), ("111", 3, 3), ("1111", 4, None), ("11011", 5, None), ("10111", 5, 5), ("11101", 5, 5))
#: Agreeing words that make an overlap, or four fifths of a shorter item.
LEAST = 10
#: Words of the shortest item that deletes documents.
LEAST_ITEM = 8
#: A disagreement takes more than so many agreeing words beside it.
PENALTY = 4

_WORD = r"[\p{L}\p{N}]+"


def word_hashes(text: str) -> Column:
    """Hashes of the words of a text in lower case; no words for a null text."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(_WORD), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def four_fifths(n: Column) -> Column:
    return F.ceil(n * 4 / 5).cast("int")


def as_whole(n: Column, least: int) -> Column:
    """Whether an item of n words is judged by four fifths of all its words."""
    return four_fifths(n) <= least


def masks_for(n: Column, least: int) -> dict[str, Column]:
    """Each mask, and whether an item of n words needs it; together they hit all that ``overlaps`` reports."""
    whole = as_whole(n, least)
    brief = whole | F.lit(least < LEAST)
    # a stretch may be longer than ``least``, so that from four words on it needs the masks of six
    words = F.when(whole, n).otherwise(least if least < 4 else 6)
    masks = {m: ~brief for m in MASKS}
    return masks | {m: brief & (words >= low) & (words <= high if high else F.lit(True)) for m, low, high in SHORT_MASKS}


def seeds(rows: DataFrame, words: str, at: str, seed: str, masks: dict[str, Column]) -> DataFrame:
    """Every seed of every row: adds ``at`` (the first word's place, from 0) and ``seed``; null where a mask does not fit or is not for the row.

    Places and masks are one sequence, so that one loop over it makes all seeds.
    """
    n, count = F.size(words), len(masks)
    spans = rows.withColumn("_i", F.explode(F.when(n > 0, F.sequence(F.lit(0), n * count - 1))))
    place = F.shiftrightunsigned("_i", 1) if count == 2 else F.floor(F.col("_i") / count).cast("int")
    hashed = F.lit(None).cast("long")
    for k, (mask, wanted) in enumerate(masks.items()):
        parts = [F.get(F.col(words), F.col(at) + i) for i, c in enumerate(mask) if c == "1"]
        fits = (F.col("_i") % count == k) & (F.col(at) + len(mask) <= n) & wanted
        hashed = F.when(fits, F.xxhash64(F.lit(mask), *parts)).otherwise(hashed)
    return spans.withColumn(at, place).withColumn(seed, hashed)


def candidates(docs: DataFrame, items: DataFrame, least: int = LEAST) -> DataFrame:
    """Distinct (doc_id, text_hash, item_id, shift) with a common seed; shift: the document's place minus the item's.

    Documents are hashed by the masks that some item needs.
    """
    masks = masks_for(F.size("item_words"), least)
    needed = items.where(F.size("item_words") > 0).agg(*[F.max(wanted).alias(m) for m, wanted in masks.items()]).first()
    used = [m for m in masks if needed[m]] or MASKS
    item_seeds = (
        seeds(items, "item_words", "item_at", "seed", {m: masks[m] for m in used})
        .where(F.col("seed").isNotNull()).select("seed", "item_id", "item_at")
    )
    doc_words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), word_hashes("text").alias("words"))
    hits = seeds(doc_words, "words", "doc_at", "seed", {m: F.lit(True) for m in used}).join(item_seeds, "seed")
    return hits.select("doc_id", "text_hash", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct()


def agreement(item: str, doc: str, shift: str) -> Column:
    """Whether the words of two lists agree, place by place, where they lie side by side at a shift."""
    first = F.greatest(F.lit(0), -F.col(shift))
    count = F.least(F.size(item), F.size(doc) - F.col(shift)) - first
    return F.zip_with(
        F.slice(F.col(item), first + 1, count), F.slice(F.col(doc), first + F.col(shift) + 1, count), lambda a, b: a == b
    )


def best_stretch(agree: Column) -> Column:
    """Most agreeing words of any stretch with more than PENALTY of them to each disagreement; 0: none.

    Such a stretch only gains by reaching from one disagreement (or end) to another.
    Between number s at place p and number t at place q lie (q - t) - (p - s) agreeing
    words and t - s - 1 disagreements. In the order of place minus (PENALTY + 1) times
    number, each end meets the least place minus number of the starts it may have.
    """
    apart = F.array_compact(F.transform(agree, lambda same, i: F.when(~same, i + 1)))
    ends = F.concat(F.array(F.lit(0)), apart, F.array(F.size(agree) + 1))

    def events(p: Column, s: Column) -> Column:
        level, before = p - (PENALTY + 1) * s, p - s
        return F.array(
            F.struct((level - PENALTY + 1).alias("level"), F.lit(False).alias("is_end"), before.alias("before")),
            F.struct(level.alias("level"), F.lit(True).alias("is_end"), before.alias("before")),
        )

    def step(state: Column, event: Column) -> Column:
        return F.struct(
            F.when(event["is_end"], state["least"]).otherwise(F.least(state["least"], event["before"])).alias("least"),
            F.when(event["is_end"], F.greatest(state["most"], event["before"] - state["least"])).otherwise(state["most"]).alias("most"),
        )

    start = F.struct((F.size(agree) + 1).alias("least"), F.lit(0).alias("most"))
    return F.aggregate(F.array_sort(F.flatten(F.transform(ends, events))), start, step, lambda s: s["most"])


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, text_hash, item_id, n_matched, n_item): documents that hold a passage of a benchmark item.

    A stretch that agrees in more than four of five words has at least ``least``
    agreeing ones; n_matched: the most of any stretch. An item of which four fifths
    are no more than that is laid beside the document as a whole, and four fifths of
    its words agree (n_matched), so a word alone is held by all documents with that
    word. Null or empty texts give no row. Documents that repeat an id are told apart by their
    text; equal rows give one result.
    """
    named = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id"), word_hashes("text").alias("item_words"))
    hits = written(candidates(named, items, least), "seed-hits")
    by_doc = hits.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item_id", "shift")).alias("hits"))
    d = named.withColumn("text_hash", F.xxhash64("text")).alias("d")
    h = by_doc.alias("h")
    both = d.join(h, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_hash") == F.col("h.text_hash")))
    laid = (
        both.select("d.doc_id", "d.text_hash", word_hashes("d.text").alias("words"), "h.hits")
        .withColumn("hit", F.explode("hits")).select("doc_id", "text_hash", "words", "hit.item_id", "hit.shift")
    )
    i = items.alias("i")
    n_item, agree = F.size("i.item_words"), agreement("item_words", "words", "shift")
    matched = F.when(as_whole(n_item, least), F.size(F.filter(agree, lambda same: same))).otherwise(best_stretch(agree))
    judged = laid.join(i, laid["item_id"].eqNullSafe(F.col("i.item_id"))).select(
        laid["doc_id"], laid["text_hash"], laid["item_id"], n_item.alias("n_item"), matched.alias("n_matched"),
    )
    enough = F.col("n_matched") >= F.least(F.lit(least), four_fifths(F.col("n_item")))
    return judged.where(enough).groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("n_matched").alias("n_matched"), F.max("n_item").alias("n_item")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, least_item: int = LEAST_ITEM) -> DataFrame:
    """The rows of ``docs``, all columns, without those that hold a passage of a benchmark item of ``least_item`` or more words.

    Shorter items, such as an answer of one word, stand in many clean texts; ``overlaps``
    reports them, and they delete nothing. Rows with a null or empty text stay, and so
    does everything if either table is empty. Rows that repeat an id go by their own text.
    """
    held = overlaps(docs, benchmark, least).where(F.col("n_item") >= least_item)
    found = written(held.select("doc_id", "text_hash").distinct(), "contaminated").alias("f")
    d = docs.alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.xxhash64(F.col("d.text").cast("string")) == F.col("f.text_hash"))
    return d.join(found, same, "left_anti")
