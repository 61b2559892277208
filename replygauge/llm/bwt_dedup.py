"""Remove the bytes of every passage that an earlier place of the corpus holds too.

Repeated substrings from Burrows-Wheeler transforms that are merged shard by shard:

1. Every window of ``length`` bytes picks an anchor, its least k-gram by hash; equal
   windows pick equal anchors. Neighbouring windows with the same anchor are one
   segment. Segments whose anchor occurs once in the corpus hold no repeat.
2. Equal segments go on once, from their earliest place; the windows of the others
   are repeats. All distinct segments of an anchor meet in one group; an anchor with
   more than ``hot`` of them sends its windows one by one, by the window's own hash.
3. A group splits its windows into shards and transforms each: the suffixes at
   window starts in sorted order, kept as the symbols that precede them. A symbol
   is a quarter of a window, so four of them make a window and are all the depth
   that matters.
4. The shards' transforms are merged by refining one interleave: it starts in the
   order of the last symbols; each round takes the preceding symbols in the present
   order and deals them out stably, which lengthens the sorted context by a symbol.
   Suffixes are never sorted again. A place where symbols differ, or contexts did
   before, parts common prefixes; after the last round the intervals between such
   places are the repeated windows, and the earliest of each interval stays.

Symbols are compared by a 64-bit hash under which they are ordered; every interval
is then compared byte by byte, and one that disagrees is split by its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replygauge.llm import arrays
from replygauge.llm.common import discard, written

#: Bytes of text whose segments make one group, and windows of a shard.
GROUP_BYTES = 16 << 20
SHARD = 1 << 17
#: Distinct segments of one anchor beyond which its windows part.
HOT = 2048
#: Segments a task gathers before it hands them on: 40 bytes each, in numpy arrays and again in the batches on the way to the JVM.
GATHERED = 100_000
#: Bytes of text searched for segments at once. Each takes some fifteen arrays of eight bytes.
_SLICE = 1 << 18
#: Bytes of a longer text looked at once; positions in it fit 24 bits.
_CHUNK = 1 << 19
#: Bytes cut out at once; each is found by an index of eight bytes.
_CUT = 1 << 20
_SYMBOLS = 4


class Spans:
    """Hashes of spans of bytes from one running sum."""

    def __init__(self, data: np.ndarray):
        self.sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * arrays.powers(arrays._BASE, len(data)), out=self.sum[1:])

    def __call__(self, starts: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        raw = (self.sum[starts + size] - self.sum[starts]) * arrays.powers(arrays._INVERSE, len(self.sum))[starts]
        return arrays.mix(raw + np.asarray(size, np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of the ``width`` values from each place on."""
    size = len(values) - width + 1
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:size], values[width - done : width - done + size])


def segments_of(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor, content hash, start and number of windows of all segments; none crosses a bound."""
    k = max(1, length * 8 // 25)
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    spans = Spans(data)
    grams = spans(np.arange(len(data) - k + 1), k)
    low = np.uint64((1 << 24) - 1)
    least = _least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - k + 1)
    whole = np.arange(len(least)) + length <= np.repeat(bounds[1:], np.diff(bounds))[: len(least)]
    anchor = (least & low).astype(np.int64)
    new = np.ones(len(least), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    starts = np.flatnonzero(whole & new)
    last = np.ones(len(least), bool)
    last[:-1] = new[1:] | ~whole[1:]
    n = np.flatnonzero(whole & last) - starts + 1
    return grams[anchor[starts]], spans(starts, n + (length - 1)), starts, n


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _span(start, n, kind=0):
    return (start << 24) | (n << 2) | kind


def _unspan(span):
    return span >> 24, (span >> 2) & 0x3FFFFF


def _first_of(columns: list[np.ndarray], keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by all columns, and where the first ``keys`` of them change."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in columns[:keys]:
        new[1:] |= x[order[1:]] != x[order[:-1]]
    return order, new


def _later(columns: list[np.ndarray], order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Rows in order that lie at another place than the first of their run; the last three columns are the place."""
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    other = np.zeros(len(order), bool)
    for x in columns[-3:]:
        other |= x[order] != x[first]
    return other


_SEGMENTS = "part long, anchor array<long>, seg array<long>, id array<long>, tie array<long>, span array<long>"
_MARK = "id long, tie long, span long, key long"
_NO_PART = -1


def _candidates(docs: DataFrame, length: int, parts: int, gathered: int) -> DataFrame:
    """The segments of all texts by group; part -1 holds those that repeat one the same task has seen before."""

    def dealt(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(x) for x in zip(*held, strict=True)]
        order, new = _first_of(columns, 2)
        later = _later(columns, order, new)
        part = np.where(later, _NO_PART, (columns[0][order] % np.uint64(parts)).astype(np.int64))
        keep = new | later
        order, part = order[keep], part[keep]
        by = np.argsort(part, kind="stable")
        order, part = order[by], part[by]
        at = np.flatnonzero(np.diff(part, prepend=-2))
        ends = np.append(at, len(part)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, _longs(x[order])) for x in columns]
        yield pa.RecordBatch.from_arrays([pa.array(part[at]), *lists], ["part", "anchor", "seg", "id", "tie", "span"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in arrays.slices(batch, "text", _SLICE):
                data, bounds = arrays.text_bytes(piece["text"])
                ids, ties = (piece[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "tie"))
                for at in range(0, max(len(data), 1), _CHUNK):
                    # More than one round only for a text longer than a chunk, which is alone in its slice.
                    part = data[at : at + _CHUNK + length - 1]
                    inside = bounds if len(bounds) > 2 or at + len(part) == len(data) == len(part) else np.array([0, len(part)])
                    anchor, seg, starts, n = segments_of(part, inside, length)
                    row = np.searchsorted(bounds, starts + at, "right") - 1
                    held.append((anchor, seg, ids[row], ties[row], _span(starts + at - bounds[row], n)))
                    size += len(starts)
                    if size > gathered:
                        yield from dealt(held)
                        held, size = [], 0
        if size:
            yield from dealt(held)

    return docs.mapInArrow(find, _SEGMENTS)


def _compared(hot: int):
    """Of one group's segments: repeats of an equal segment (kind 0), and those to compare (1, or 2 window by window)."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        columns = [table[c].combine_chunks().flatten().to_numpy() for c in ("anchor", "seg", "id", "tie", "span")]
        order, new = _first_of(columns, 2)
        later = _later(columns, order, new)
        anchor = columns[0][order]
        group = np.cumsum(np.diff(anchor, prepend=anchor[0] if len(anchor) else 0) != 0)
        distinct = np.bincount(group, weights=new).astype(np.int64)[group]
        keep = later | (new & (distinct > 1))
        kind = np.where(later, 0, np.where(distinct > hot, 2, 1))[keep]
        order = order[keep]
        return pa.table({"id": columns[2][order], "tie": columns[3][order], "span": columns[4][order] | kind, "key": columns[0][order]})

    return compare


def _cut_out(length: int):
    """The bytes of wanted segments; windows of hot anchors one by one, repeats among a slice's as marks without bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in arrays.slices(batch, "text"):
                data, bounds = arrays.text_bytes(piece["text"])
                wanted = piece["wanted"]
                row = np.repeat(np.arange(piece.num_rows), np.diff(wanted.offsets.to_numpy()))
                flat = wanted.flatten()
                span, key = flat.field("span").to_numpy(), flat.field("key").to_numpy().copy()
                start, n = _unspan(span)
                hot = np.flatnonzero(span & 3 == 2)
                if len(hot):
                    # Each window of a hot segment is a segment of its own.
                    row_hot, each = np.repeat(row[hot], n[hot]), np.arange(n[hot].sum()) - np.repeat(np.cumsum(n[hot]) - n[hot], n[hot])
                    start_hot = np.repeat(start[hot], n[hot]) + each
                    cold = span & 3 != 2
                    keys = Spans(data)(start_hot + bounds[row_hot], length)
                    row, start, n = (np.concatenate([x[cold], y]) for x, y in ((row, row_hot), (start, start_hot), (n, np.ones(len(each), np.int64))))
                    key = np.concatenate([key[cold], keys.view(np.int64)])
                    first = int(cold.sum())
                else:
                    first = len(row)
                ids, ties = (piece[c].to_numpy(zero_copy_only=False).astype(np.int64)[row] for c in ("id", "tie"))
                order, new = _first_of([key[first:], ids[first:], ties[first:], start[first:]], 1)
                later = np.zeros(len(row), bool)
                later[first + order] = _later([key[first:], ids[first:], ties[first:], start[first:]], order, new)
                size = np.where(later, 0, n + (length - 1))
                ends = np.zeros(len(row) + 1, np.int64)
                np.cumsum(size, out=ends[1:])
                span = _span(start, n, 0)
                a = 0
                while a < len(row):
                    b = max(a + 1, int(np.searchsorted(ends, ends[a] + _CUT, "right")) - 1)
                    take = np.arange(ends[a], ends[b]) + np.repeat((start + bounds[row] - ends[:-1])[a:b], size[a:b])
                    body = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends[a : b + 1] - ends[a]), pa.py_buffer(data[take])]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x[a:b]) for x in (key, ids, ties, span)] + [body], ["key", "id", "tie", "span", "bytes"])
                    a = b

    return cut


def transform(symbols: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The transform of one shard of windows, each a row of symbols from its last to its first.

    Returns the last symbols in sorted order, for each further place the symbols that
    precede the suffixes in their sorted order, and the order of the whole windows.
    """
    order = np.argsort(symbols[0], kind="stable")
    last, before = symbols[0][order], []
    for column in symbols[1:]:
        before.append(column[order])
        order = order[np.argsort(before[-1], kind="stable")]
    return last, before, order


def merge(shards: list[tuple[np.ndarray, list[np.ndarray], np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all shards in sorted order, and where a new interval of equal windows begins.

    The interleave says which shard gives the next suffix. A round reads the shards'
    preceding symbols through it and deals the entries out stably by symbol.
    """
    sizes = [len(x[0]) for x in shards]
    first = np.concatenate([x[0] for x in shards])
    shard = np.repeat(np.arange(len(shards), dtype=np.uint16), sizes)
    moved = np.argsort(first, kind="stable")
    interleave, symbols = shard[moved], first[moved]
    parted = np.ones(len(first), bool)
    parted[1:] = symbols[1:] != symbols[:-1]
    at = np.empty(len(first), np.int64)
    for level in range(len(shards[0][1])):
        at[np.argsort(interleave, kind="stable")] = np.arange(len(first))
        symbols = np.concatenate([x[1][level] for x in shards])[at]
        interval = np.cumsum(parted)
        moved = np.argsort(symbols, kind="stable")
        interleave, symbols, interval = interleave[moved], symbols[moved], interval[moved]
        parted[1:] = (symbols[1:] != symbols[:-1]) | (interval[1:] != interval[:-1])
    at[np.argsort(interleave, kind="stable")] = np.arange(len(first))
    begins = np.cumsum([0, *sizes[:-1]])
    return np.concatenate([x[2] + b for x, b in zip(shards, begins, strict=True)])[at], parted


def _split_unequal(data: np.ndarray, starts: np.ndarray, windows: np.ndarray, parted: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The same order and intervals, those with unequal bytes (equal hashes of unequal symbols) split."""
    pairs = np.flatnonzero(~parted)
    wrong = []
    for i in range(0, len(pairs), 1 << 13):
        here = pairs[i : i + (1 << 13)]
        a, b = (starts[windows[x]][:, None] + np.arange(length) for x in (here - 1, here))
        wrong.append(here[(data[a] != data[b]).any(axis=1)])
    wrong = np.concatenate(wrong) if wrong else pairs
    interval = np.cumsum(parted)
    for which in np.unique(interval[wrong]).tolist():
        at = np.flatnonzero(interval == which)
        bodies = [data[s : s + length].tobytes() for s in starts[windows[at]].tolist()]
        order = sorted(range(len(at)), key=bodies.__getitem__)
        windows[at] = windows[at][order]
        parted[at[1:]] = [bodies[x] != bodies[y] for x, y in zip(order, order[1:], strict=False)]
    return windows, parted


def _repeats(length: int, shard: int):
    """Of one group's segments: the windows that an earlier segment holds, as runs."""

    def find(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        data, bounds = arrays.text_bytes(table["bytes"].combine_chunks())
        ids, ties, span = (table[c].to_numpy() for c in ("id", "tie", "span"))
        start, n = _unspan(span)
        row = np.repeat(np.arange(len(n)), n)
        each = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        starts = bounds[:-1][row] + each
        # Places in order: rank of the document, then start.
        order, new = _first_of([ids, ties], 2)
        rank = np.empty(len(n), np.int64)
        rank[order] = np.cumsum(new)
        place = (rank[row] << 32) | (start[row] + each)
        size = -(-length // _SYMBOLS)
        spans = Spans(data)
        shards = []
        for a in range(0, len(row), shard):
            some = starts[a : a + shard]
            shards.append(transform([spans(some + max(0, length - size * (i + 1)), min(size, length)) for i in range(_SYMBOLS)]))
        del spans
        windows, parted = _split_unequal(data, starts, *merge(shards), length)
        earliest = np.minimum.reduceat(place[windows], np.flatnonzero(parted))
        later = np.empty(len(row), bool)
        later[windows] = place[windows] > earliest[np.cumsum(parted) - 1]
        a, b = arrays.runs(later, np.append(np.cumsum(n) - n, len(row)))
        of = row[a]
        return pa.table({"id": ids[of], "tie": ties[of], "span": _span(start[of] + each[a], b - a)})

    return find


def _kept(length: int):
    """What is left of each text once the runs of its repeated windows are gone."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in arrays.slices(batch, "text"):
                out = []
                for doc_id, text, spans, again in zip(*(piece[c].to_pylist() for c in ("doc_id", "text", "spans", "again")), strict=True):
                    body = text.encode()
                    if again and len(body) >= length:
                        out.append((doc_id, len(body), len(body), 1, hashlib.sha256().hexdigest()))
                        continue
                    left, removed, runs, at = hashlib.sha256(), 0, 0, 0
                    end = -1
                    for begin, n in sorted(_unspan(x) for x in spans or ()):
                        if begin > end:
                            left.update(body[at:begin])
                            runs += 1
                            at = begin
                        end = max(end, begin + n + length - 1)
                        removed += end - at
                        at = end
                    left.update(body[at:])
                    out.append((doc_id, len(body), removed, runs, left.hexdigest()))
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names)

    return keep


def remove_repeats(docs: DataFrame, length: int = 100, group_bytes: int = GROUP_BYTES, shard: int = SHARD, hot: int = HOT, gathered: int = GATHERED) -> DataFrame:
    """What is left of each text without the bytes that an earlier string of ``length`` bytes covers.

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes inside its text
    covers it and also starts at an earlier place: a smaller doc_id, or the same text
    further left, overlaps included. Everything is judged on the texts as given.
    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and
    kept_sha256 of the bytes that stay, one row per row of docs.

    A null text is empty; texts shorter than ``length`` stay whole. Null doc_ids come
    last. Rows that repeat a doc_id are ordered by a hash of their text; of rows equal
    in both, one is judged by what is before it and the others, if long enough, go
    whole. An empty table gives no rows; further columns are ignored. Texts are read
    whole; one of over half a MB in overlapping pieces.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    last = F.lit((1 << 63) - 1)
    known = docs.select(F.coalesce(F.col("doc_id"), last).alias("id"), F.octet_length("text").cast("long").alias("size"))
    total, = known.agg(F.sum("size")).first()
    distinct = known.groupBy("id").count().where(F.col("count") > 1).isEmpty()
    tie = F.lit(0).cast("long") if distinct else F.xxhash64(F.col("text"), F.lit(11))
    texts = docs.select("doc_id", F.coalesce(F.col("doc_id"), last).alias("id"), tie.alias("tie"), "text")
    parts = max(1, -(-(total or 0) // group_bytes))

    found = written(_candidates(texts.select("id", "tie", "text"), length, parts, gathered), "segments")
    judged = written(found.where(F.col("part") >= 0).groupBy("part").applyInArrow(_compared(hot), _MARK), "judged")
    seen = written(found.where(F.col("part") < 0).select(F.explode(F.arrays_zip("id", "tie", "span")).alias("m")).select("m.*"), "seen")
    discard(found)
    is_mark = F.col("span").bitwiseAND(F.lit(3)) == 0
    wanted = judged.where(~is_mark).groupBy("id", "tie").agg(F.collect_list(F.struct("span", "key")).alias("wanted"))
    bodies = texts.select("id", "tie", "text").join(wanted, ["id", "tie"]).mapInArrow(_cut_out(length), "key long, id long, tie long, span long, bytes binary")
    bodies = written(bodies, "bodies")
    whole = F.octet_length("bytes") > 0
    windows, = bodies.where(whole).agg(F.sum(F.octet_length("bytes") - (length - 1))).first()
    groups = max(1, -(-(windows or 0) // (4 * shard)))
    compared = bodies.where(whole).groupBy(F.pmod(F.col("key"), F.lit(groups)).alias("group")).applyInArrow(_repeats(length, shard), "id long, tie long, span long")
    marks = seen.union(judged.where(is_mark).select("id", "tie", "span")).union(bodies.where(~whole).select("id", "tie", "span")).union(compared)
    spans = marks.groupBy("id", "tie").agg(F.collect_list("span").alias("spans"))
    if distinct:
        rows = texts.withColumn("again", F.lit(False))
    else:
        rows = texts.withColumn("again", F.row_number().over(Window.partitionBy("id", "tie").orderBy("doc_id")) > 1)
    joined = rows.join(spans, ["id", "tie"], "left").select("doc_id", "text", "spans", "again")
    return joined.mapInArrow(_kept(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
