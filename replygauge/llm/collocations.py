"""Phrases of two to four words that occur together more often than their parts, language by language.

Vertical partitioning in the manner of ERA suffix trees. Words, then pairs of
words, are counted; what is too rare to be part of a phrase is left out of the
suffixes. The pairs are the prefixes: they are grouped so that a group's suffixes
fit a memory budget, and a prefix beyond the budget is extended by its third word.
Every suffix, truncated to four words, goes to the group of its prefix; each group
builds its subtree alone, as its sorted suffixes with the places where they part,
and reads the count of every phrase from the totals of the leaves below it.

Counts are exact and cover all texts. What the tasks are told of the whole corpus
has a fixed size: two bitmaps of ``BITS`` bits and the groups of ``CELLS`` cells of
prefixes. A full bitmap lets more suffixes pass and changes no count.

Words are 64-bit hashes of language and bytes; two words of one hash are detected,
and all are hashed anew with another seed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replygauge.llm import arrays
from replygauge.llm.common import written

#: Words of the longest phrase.
DEPTH = 4
#: Bits of each bitmap of frequent words and pairs (8 MB).
BITS = 1 << 26
#: Cells that prefixes are hashed to before they are grouped.
CELLS = 1 << 12
#: Suffixes of a group, and suffixes a task gathers before it hands them on.
BUDGET = 2_000_000
GATHERED = 1_000_000

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = True
_BREAK[10:14] = True
_OUTSIDE = _BREAK.copy()
_OUTSIDE[[9, 32]] = True

_BLOCK = 1 << 15


class Words:
    """The words of one slice of texts: ids, bytes, text row, and whether the next word continues the piece."""

    def __init__(self, batch: pa.RecordBatch, seed: int):
        data, bounds = arrays.text_bytes(batch["text"])
        data = arrays.LOWER[data]
        breaks = _BREAK[data]
        self.data = data
        self.starts, self.ends = arrays.runs(~_OUTSIDE[data], bounds)
        self.row = np.searchsorted(bounds, self.starts, "right") - 1
        langs = batch["lang"].dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.row]
        salt = np.array([zlib.crc32(x.encode()) + (seed << 32) for x in self.langs] or [0], np.uint64)
        ids = arrays.mix(arrays.span_hashes(data, self.starts, self.ends) + arrays.mix(salt + np.uint64(1))[self.code])
        ids[ids == 0] = 1
        self.ids = ids
        before = np.cumsum(breaks)
        self.joined = np.zeros(len(ids), bool)
        if len(ids):
            self.joined[:-1] = (before[self.starts[1:]] == before[self.starts[:-1]]) & (self.row[1:] == self.row[:-1])


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def follow(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a phrase whose key without the last word is ``left``; a word is its own key."""
    return arrays.mix(left * np.uint64(0x9FB21C651E98DF25) + word)


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """Every word of every language with its count: id, lang, word, f."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                words = Words(part, seed)
                ids, first, counts = np.unique(words.ids, return_index=True, return_counts=True)
                if not len(ids):
                    continue
                data = words.data.tobytes()
                text = [data[a:b].decode() for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
                lang = pa.DictionaryArray.from_arrays(pa.array(words.code[first].astype(np.int32)), pa.array(words.langs, pa.string()))
                yield pa.RecordBatch.from_arrays([_longs(ids), lang.dictionary_decode(), pa.array(text, pa.string()), pa.array(counts)], ["id", "lang", "word", "f"])

    each = docs.mapInArrow(count, "id long, lang string, word string, f long")
    return each.groupBy("id", "lang", "word").agg(F.sum("f").alias("f"))


def _pair_counts(docs: DataFrame, seed: int, frequent) -> DataFrame:
    """Counts by pair key of neighbours that may both be frequent words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                words = Words(part, seed)
                often = _has(frequent.value, words.ids)
                at = np.flatnonzero(words.joined[:-1] & often[:-1] & often[1:])
                keys, counts = np.unique(follow(words.ids[at], words.ids[at + 1]), return_counts=True)
                if len(keys):
                    yield pa.RecordBatch.from_arrays([_longs(keys), pa.array(counts)], ["id", "f"])

    return docs.mapInArrow(count, "id long, f long").groupBy("id").agg(F.sum("f").alias("f"))


def bitmap_of(ids: DataFrame, bits: int = BITS) -> np.ndarray:
    """One bit for each id modulo ``bits``; the driver receives that many bits at most."""
    at = F.col("id").bitwiseAND(F.lit(bits - 1))
    rows = ids.groupBy(F.shiftright(at, 15).alias("block")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(_BLOCK - 1))).alias("set"))
    out = np.zeros(bits // 8, np.uint8)
    for row in rows.toLocalIterator():
        out[row.block * (_BLOCK // 8) : (row.block + 1) * (_BLOCK // 8)] = np.frombuffer(row.set, np.uint8)[: min(_BLOCK, bits) // 8]
    return out


def grouped_cells(totals: dict[int, int], budget: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of every cell.

    Neighbouring cells share a group while their suffixes fit the budget; a cell
    beyond it has groups of its own, among which the third word chooses.
    """
    first, parts = np.zeros(cells, np.int64), np.ones(cells, np.int64)
    group, held = 0, 0
    for cell in range(cells):
        total = totals.get(cell, 0)
        if held and held + total > budget:
            group, held = group + 1, 0
        first[cell] = group
        held += total
        if total > budget:
            parts[cell] = -(-total // budget)
            group, held = group + int(parts[cell]), 0
    return first, parts


def _merged(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal suffixes once, with the sum of their counts."""
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return rows[at], np.add.reduceat(counts, at)


def _suffixes(docs: DataFrame, seed: int, pairs, first: np.ndarray, parts: np.ndarray, gathered: int) -> DataFrame:
    """Suffixes that start with a frequent pair, cut at the first pair that is not, by group."""

    def dealt(rows: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        cell = (follow(rows[:, 0], rows[:, 1]) & np.uint64(CELLS - 1)).astype(np.int64)
        group = first[cell] + (arrays.mix(rows[:, 2]) % parts[cell].astype(np.uint64)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        group, rows, counts = group[order], rows[order], counts[order]
        at = np.flatnonzero(np.diff(group, prepend=-1))
        ends = np.append(at, len(group)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, _longs(rows[:, i].copy())) for i in range(DEPTH)]
        return pa.RecordBatch.from_arrays(
            [pa.array(group[at]), *lists, pa.ListArray.from_arrays(ends, pa.array(counts))],
            ["part", *(f"w{i}" for i in range(1, DEPTH + 1)), "f"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                words = Words(part, seed)
                linked = np.zeros(len(words.ids) + DEPTH, bool)
                at = np.flatnonzero(words.joined)
                linked[at[_has(pairs.value, follow(words.ids[at], words.ids[at + 1]))]] = True
                at = np.flatnonzero(linked)
                rows = np.zeros((len(at), DEPTH), np.uint64)
                rows[:, 0], rows[:, 1] = words.ids[at], words.ids[at + 1]
                goes = np.ones(len(at), bool)
                for i in range(2, DEPTH):
                    goes &= linked[at + i - 1]
                    rows[goes, i] = words.ids[at[goes] + i]
                if len(rows):
                    held.append(_merged(rows, np.ones(len(rows), np.int64)))
                    size += len(held[-1][0])
                if size > gathered:
                    held = [_merged(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))]
                    size = len(held[0][0])
                    if size > gathered // 2:
                        yield dealt(*held[0])
                        held, size = [], 0
        if held:
            yield dealt(*_merged(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])))

    lists = ", ".join(f"w{i} array<long>" for i in range(1, DEPTH + 1))
    return docs.mapInArrow(cut, f"part long, {lists}, f array<long>")


_NODE = "id long, words array<long>, f long, left array<long>, right array<long>, inner array<long>"


def _subtrees(least: int, shared: np.ndarray):
    """The builder of a group's subtree; a pair may lie in several of the groups named by ``shared``."""
    return lambda table: _subtree(table, least, bool(shared[table["part"][0].as_py()]))


def _subtree(table: pa.Table, least: int, shared: bool) -> pa.Table:
    """The phrases of a group's suffix subtree that are frequent, with the totals of their leaves.

    Sorted suffixes are the leaves in order; those that agree in their first d
    words lie below one node of depth d. Of a shared group all pairs come, since
    other groups may hold the rest of their leaves.
    """
    table = table.combine_chunks()
    rows = np.stack([table[f"w{i}"].combine_chunks().flatten().to_numpy().view(np.uint64) for i in range(1, DEPTH + 1)], axis=1)
    rows, counts = _merged(rows, table["f"].combine_chunks().flatten().to_numpy())
    part = np.ones(len(rows), bool)
    columns: list[list] = [[], [], [], [], [], []]
    agree = np.ones(max(len(rows) - 1, 0), bool)
    for depth in range(1, DEPTH + 1):
        agree &= rows[1:, depth - 1] == rows[:-1, depth - 1]
        part[1:] = ~agree
        at = np.flatnonzero(part)
        if depth < 2:
            continue
        total = np.add.reduceat(counts, at)
        real = (rows[at, depth - 1] != 0) & ((total >= least) | (shared and depth == 2))
        words, total = rows[at[real], :depth], total[real]
        keys = {}
        for a in range(depth):
            keys[a, a + 1] = words[:, a]
            for b in range(a + 1, depth):
                keys[a, b + 1] = follow(keys[a, b], words[:, b])
        spans = [
            [keys[0, depth]],
            [words[:, i] for i in range(depth)],
            None,
            [keys[0, k] for k in range(1, depth)],
            [keys[k, depth] for k in range(1, depth)],
            [keys[a, b] for a in range(depth) for b in range(a + 2, depth + 1) if b - a < depth],
        ]
        for column, span in zip(columns, spans, strict=True):
            if span is None:
                column.append(pa.array(total))
                continue
            flat = np.stack(span, axis=1).reshape(-1) if span else np.zeros(0, np.uint64)
            values = _longs(flat)
            if column is not columns[0]:
                values = pa.ListArray.from_arrays(np.arange(len(total) + 1, dtype=np.int32) * len(span), values)
            column.append(values)
    names = ["id", "words", "f", "left", "right", "inner"]
    return pa.table({n: pa.chunked_array(c).combine_chunks() for n, c in zip(names, columns, strict=True)})


def phrase_counts(docs: DataFrame, least: int = 30, budget: int = BUDGET, gathered: int = GATHERED) -> tuple[DataFrame, DataFrame]:
    """Words with their counts, and phrases of two to four words that occur at least ``least`` times.

    docs holds text and lang without nulls. Words: id, lang, word, f (all of them).
    Phrases: id, words (ids), f, left and right (ids of the parts at each cut),
    inner (ids of shorter phrases inside).
    """
    spark = docs.sparkSession
    for seed in range(16):
        words = written(word_counts(docs, seed), "words")
        if words.groupBy("id").count().where(F.col("count") > 1).isEmpty():
            break
    frequent = spark.sparkContext.broadcast(bitmap_of(words.where(F.col("f") >= least).select("id")))
    pairs = written(_pair_counts(docs, seed, frequent).where(F.col("f") >= least), "pairs")
    totals = pairs.groupBy(F.col("id").bitwiseAND(F.lit(CELLS - 1)).alias("cell")).agg(F.sum("f").alias("f")).toLocalIterator()
    first, parts = grouped_cells({r.cell: r.f for r in totals}, budget)
    known = spark.sparkContext.broadcast(bitmap_of(pairs.select("id")))
    suffixes = _suffixes(docs, seed, known, first, parts, gathered)
    shared = np.zeros(int((first + parts).max()), bool)
    for cell in np.flatnonzero(parts > 1):
        shared[first[cell] : first[cell] + parts[cell]] = True
    nodes = suffixes.groupBy("part").applyInArrow(_subtrees(least, shared), _NODE)
    once = nodes.groupBy("id").agg(F.sum("f").alias("f"), *(F.any_value(c).alias(c) for c in ("words", "left", "right", "inner")))
    return words, written(once.where(F.col("f") >= least), "phrases")


def _decimal(x: Column | int) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, covered: int = 80, budget: int = BUDGET, gathered: int = GATHERED) -> DataFrame:
    """The phrases of each language whose words keep together: lang, rank, phrase, a, l, r, n, score.

    A-Z are lowered. Line ends and the signs ``.,;:!?`` end a piece, blanks and tabs
    separate its words; every other character belongs to a word. A phrase occurs
    wherever its words follow each other in a piece, overlaps included; a is its
    count, n that of all words of the language. Cut after k words into parts that
    occur l and r times it scores floor(2000000 a / (l + r)); the lowest cut counts,
    then the smallest k. Phrases with a below ``least`` are no candidates; one that
    lies inside a longer candidate with at least ``covered`` percent of its count is
    left out. The first ``most`` of each language come by score and a descending,
    then by the phrase's bytes.

    Null lang is "und"; null and empty texts and texts without words add nothing;
    repeated rows count each time; an empty table gives no rows; further columns
    are ignored. Texts of any length are read whole, in slices cut between texts.
    """
    source = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("lang"), F.lit("und")).alias("lang"))
    words, phrases = phrase_counts(source, least, budget, gathered)
    often = words.where(F.col("f") >= least)
    counts = often.select("id", "f").union(phrases.select("id", "f"))
    cuts = phrases.select("id", F.col("f").alias("a"), F.posexplode(F.arrays_zip("left", "right")).alias("cut", "part"))
    left = counts.select(F.col("id").alias("left"), F.col("f").alias("l"))
    right = counts.select(F.col("id").alias("right"), F.col("f").alias("r"))
    cuts = cuts.select("id", "a", "cut", "part.left", "part.right").join(left, "left").join(right, "right")
    score = F.expr("(cast(2000000 as decimal(38,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.groupBy("id").agg(F.min(F.struct(score.cast("long").alias("score"), "cut", "l", "r")).alias("best"))
    longest = phrases.select(F.explode("inner").alias("id"), "f").groupBy("id").agg(F.max("f").alias("longer"))
    scored = phrases.select("id", "words", F.col("f").alias("a")).join(best, "id").join(longest, "id", "left")
    scored = scored.where(F.col("longer").isNull() | (_decimal(F.col("longer")) * 100 < _decimal(F.col("a")) * covered))
    placed = scored.select("id", F.posexplode("words").alias("at", "word_id"))
    spelt = placed.join(often.select(F.col("id").alias("word_id"), "lang", "word"), "word_id")
    spelt = spelt.groupBy("id").agg(F.any_value("lang").alias("lang"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    named = scored.select("id", "a", "best.*").join(spelt, "id")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First in 64 parts of a language, so that one task sees 64 times `most` rows at most.
    near = Window.partitionBy("lang", F.pmod(F.col("id"), F.lit(64))).orderBy(*order)
    named = named.withColumn("place", F.row_number().over(near)).where(F.col("place") <= most)
    named = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return named.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
