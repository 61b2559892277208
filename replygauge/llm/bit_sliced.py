"""Exact top-k by inner product over a bit-sliced index.

Components are quantised to integers. A block of rows stores, for each
attribute, one bitmap per bit of its value above the block's least. The score
of a query is a weighted sum of attributes: its slices are added with carry-save
adders on whole bitmaps, so one machine word adds 64 rows at once. The top rows
are then read from the most significant slice downward, and rows tied at the
boundary are told apart exactly by their ids.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replygauge.llm.common import written

#: Quantised components lie strictly between -LIMIT and LIMIT, so that sums of up to 65,536 products fit 38 digits.
LIMIT = 1 << 55
BLOCK_ROWS = 1 << 14
#: Components of the queries that meet one copy of a block, so that copies of blocks weigh no more than the queries.
PART_COMPONENTS = 1 << 20
#: Pairs of a block and a part that a small table is dealt to, so that all cores of a small cluster have work.
LEAST_PAIRS = 32

INDEX = "dims int, block long, ids binary, rows binary, low binary, high binary, width binary, slices binary, vectors binary"
HITS = "query_row long, query_id long, vec_id long, score decimal(38,0)"


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(row, vec_id, v): floor(scale * x) of each component, for the vectors that take part.

    Out are null ids, null vectors, empty ones, and vectors with a null or non-finite
    component, or one of 2**55 or more once scaled. Rows that repeat an id stay apart;
    ``row`` tells them from each other once the frame is written.
    """
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    fine = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < F.lit(float(LIMIT))),
    )
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.coalesce(fine, F.lit(False)))
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def pack(rows: np.ndarray) -> np.ndarray:
    """Bits of each row, 64 to a word, the last word filled with zeros."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 64) * 64), bool)
    padded[:, : rows.shape[1]] = rows
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def build_block(ids: np.ndarray, rows: np.ndarray, matrix: np.ndarray) -> dict[str, bytes]:
    """The bit slices of one block; rows in order of their ids. Vectors are kept in the narrowest type that holds them."""
    order = np.lexsort((rows, ids))
    ids, rows, matrix = ids[order], rows[order], matrix[order]
    low, high = matrix.min(0), matrix.max(0)
    width = np.array([int(x).bit_length() for x in high - low], np.int64)
    offset = matrix - low
    bits = [((offset[:, d] >> b) & 1).astype(bool) for d in range(matrix.shape[1]) for b in range(width[d])]
    slices = pack(np.array(bits)) if bits else np.zeros(0, np.uint64)
    narrow = matrix.astype(np.result_type(np.min_scalar_type(low.min()), np.min_scalar_type(-1 - abs(int(high.max())))))
    return {"ids": ids.tobytes(), "rows": rows.tobytes(), "low": low.tobytes(), "high": high.tobytes(), "width": width.tobytes(),
            "slices": slices.tobytes(), "vectors": narrow.tobytes()}


def add_slices(columns: list[list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Sum of weighted bitmaps: columns[j] holds bitmaps of weight 2 to the j. One slice per bit of the sum."""
    total, at = [], 0
    while at < len(columns):
        pile = list(columns[at])
        if at + 1 == len(columns) and len(pile) > 1:
            columns.append([])
        while len(pile) > 2:
            a, b, c = pile.pop(), pile.pop(), pile.pop()
            half = a ^ b
            columns[at + 1].append((a & b) | (half & c))
            half ^= c
            pile.insert(0, half)
        if len(pile) == 2:
            a, b = pile
            columns[at + 1].append(a & b)
            pile = [a ^ b]
        total.append(pile[0] if pile else np.zeros(words, np.uint64))
        at += 1
    return total


def top_rows(slices: list[np.ndarray], alive: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k rows with the largest sums, ties to smaller positions, in no order."""
    sure, tied = np.zeros_like(alive), alive
    for s in reversed(slices):
        more = sure | (tied & s)
        n = int(np.bitwise_count(more).sum())
        if n > k:
            tied = tied & s
        elif n < k:
            sure, tied = more, tied & ~s
        else:
            return _positions(more)
    picked = _positions(sure)
    return np.concatenate([picked, _positions(tied)[: k - len(picked)]])


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


class Block:
    def __init__(self, row: dict):
        self.ids, self.rows = (np.frombuffer(row[x], np.int64) for x in ("ids", "rows"))
        self.low, self.high, self.width = (np.frombuffer(row[x], np.int64) for x in ("low", "high", "width"))
        self.words = -(-len(self.ids) // 64)
        self.slices = np.frombuffer(row["slices"], np.uint64).reshape(-1, self.words)
        self.first = np.concatenate([[0], np.cumsum(self.width)])
        size = len(row["vectors"]) // (len(self.ids) * len(self.low))
        self.vectors = np.frombuffer(row["vectors"], f"i{size}").astype(np.int64).reshape(len(self.ids), -1)
        self.largest = max(-int(self.low.min()), int(self.high.max()), 0)
        self.all = pack(np.ones((1, len(self.ids)), bool))[0]
        self.flipped: dict[int, np.ndarray] = {}

    def attribute(self, d: int, negative: bool) -> np.ndarray:
        """Slices of v - low, or of high - v, so that every summand is positive."""
        if not negative:
            return self.slices[self.first[d] : self.first[d + 1]]
        if d not in self.flipped:
            values = self.high[d] - self.vectors[:, d]
            self.flipped[d] = pack(np.array([((values >> b) & 1).astype(bool) for b in range(self.width[d])]).reshape(self.width[d], -1))
        return self.flipped[d]

    def top(self, query_id: int, query_row: int, q: np.ndarray, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and scores of the k best rows of the block, the query's own row apart."""
        columns: list[list[np.ndarray]] = [[]]
        for d in np.flatnonzero(q):
            weight = abs(int(q[d]))
            for b, bitmap in enumerate(self.attribute(int(d), q[d] < 0)):
                for j in range(weight.bit_length()):
                    if weight >> j & 1:
                        while len(columns) <= b + j:
                            columns.append([])
                        columns[b + j].append(bitmap)
        alive = self.all
        first, after = np.searchsorted(self.ids, query_id), np.searchsorted(self.ids, query_id, side="right")
        for own in first + np.flatnonzero(self.rows[first:after] == query_row):
            alive = alive.copy()
            alive[own // 64] ^= np.uint64(1) << np.uint64(own % 64)
        at = top_rows(add_slices(columns, self.words), alive, k)
        return self.ids[at], self.scores(at, q)

    def scores(self, at: np.ndarray, q: np.ndarray) -> pa.Array:
        """Exact inner products; those that may pass 64 bits are summed as whole numbers of Python."""
        if self.largest * sum(abs(int(x)) for x in q) < 1 << 63:
            return pa.array(self.vectors[at] @ q).cast(pa.decimal128(38, 0))
        exact = self.vectors[at].astype(object) @ q.astype(object)
        return pa.array([Decimal(int(x)) for x in exact], pa.decimal128(38, 0))


def bit_sliced_topk(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """The ``k`` rows of highest integer inner product for each row whose id is divisible by ``every``.

    Columns query_id, rank, vec_id, score; ties go to the smaller id, a query does
    not meet its own row. Rows that repeat an id are rows of their own, as queries and
    as candidates. Vectors of another length than the query's are no candidates. Scores
    beyond a long are ranked exactly and shown as the nearest long. An empty table, or
    one without queries, gives no rows. Rows are dealt to blocks by a hash; the queries
    are dealt to parts, and each pair of a block and a part is one group of bounded size
    that yields at most k rows a query. What is shuffled grows with blocks x queries.
    """
    rows = written(quantised(vectors, scale), "topk-rows")
    is_query = F.col("vec_id") % every == 0
    dims = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("asked")).collect()
    blocks, parts = F.lit(None).cast("long"), F.lit(None).cast("long")
    for d, n, asked in dims:
        n_blocks = -(-n // BLOCK_ROWS)
        n_parts = max(-(-asked * d // PART_COMPONENTS), min(-(-LEAST_PAIRS // n_blocks), asked), 1)
        blocks = F.when(F.col("dims") == d, F.lit(n_blocks)).otherwise(blocks)
        parts = F.when(F.col("dims") == d, F.lit(n_parts)).otherwise(parts)
    placed = rows.withColumn("dims", F.size("v"))

    def build(table: pa.Table) -> pa.Table:
        matrix = np.array(table["v"].combine_chunks().flatten().to_numpy(), np.int64).reshape(table.num_rows, -1)
        row = {"dims": table["dims"][0].as_py(), "block": table["block"][0].as_py()}
        return pa.Table.from_pylist([row | build_block(table["vec_id"].to_numpy(), table["row"].to_numpy(), matrix)], schema=_INDEX)

    def numbers(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))

    index = written(placed.withColumn("block", F.pmod(F.xxhash64("row"), blocks)).groupBy("dims", "block").applyInArrow(build, INDEX), "topk-index")
    copies = index.withColumn("part", numbers(parts))
    asked = placed.where(is_query).withColumn("part", F.pmod(F.xxhash64("row", F.lit(7)), parts)).withColumn("block", numbers(blocks))

    def search(held: pa.Table, queries: pa.Table) -> pa.Table:
        if not held.num_rows or not queries.num_rows:
            return _HITS.empty_table()
        block, found = Block(held.to_pylist()[0]), []
        matrix = np.array(queries["v"].combine_chunks().flatten().to_numpy(), np.int64).reshape(queries.num_rows, -1)
        for row, query_id, q in zip(queries["row"].to_pylist(), queries["vec_id"].to_pylist(), matrix, strict=True):
            ids, scores = block.top(query_id, row, q, k)
            n = len(ids)
            found.append(pa.RecordBatch.from_arrays([pa.array(np.full(n, row)), pa.array(np.full(n, query_id)), pa.array(ids), scores], schema=_HITS))
        return pa.Table.from_batches(found, _HITS)

    keys = ("dims", "block", "part")
    return ranked(copies.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, HITS), k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    score = F.greatest(F.least("score", F.lit((1 << 63) - 1)), F.lit(-(1 << 63) + 1)).cast("long")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", score.alias("score"))
    )


_INDEX = pa.schema([("dims", pa.int32()), ("block", pa.int64())] + [(x, pa.binary()) for x in ("ids", "rows", "low", "high", "width", "slices", "vectors")])
_HITS = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.decimal128(38, 0))])
