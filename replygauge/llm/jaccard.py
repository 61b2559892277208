"""n-gram Jaccard join over count vectors held in an R-tree.

The shingles of a document are hashed into groups; the counts by group are a
point. Two sets share at most the sum of the coordinate minima of their points,
and a box of points at most the sum over its upper corner, so a tree of boxes
finds all points that could be similar enough. Pairs that survive are verified
on the sets themselves.

Spark deals the work: two similar sets share a shingle among the first few of
each in any common order of shingles, so only documents with such a shingle in
common meet. Shingles that many documents have come last in that order. Sets that
are equal are joined first, copies then link to the least document of each
shingle's group, and only groups that still hold several components are searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replygauge.llm.arrays import mix, ngrams, slices, words
from replygauge.llm.common import discard, written
from replygauge.llm.components import components

#: Coordinates of the tree's points. Larger sets have finer vectors, of about GROUP_SIZE shingles to a group, folded for the tree.
GROUPS = 64
GROUP_SIZE = 8
FANOUT = 16
#: Rows of one shingle that one task holds together; larger groups meet in pairs of such blocks.
BLOCK = 2000
#: One text in so many is looked at to find common shingles. They only move to the end of the order: results do not depend on it.
SAMPLE = 32
COMMON = 4
COMMON_MOST = 200_000
#: Words of 64 bits in the map of equal sets. Fuller maps only send more rows through the join: results do not depend on it.
MAP_WORDS = 1 << 18


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer than n words is one shingle."""
    found, bounds = words(texts)
    grams = ngrams(found, n)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            yield ngrams(found[a:b], b - a) ^ np.uint64(b - a)
        else:
            yield found[:0]


def count_vector(found: np.ndarray) -> np.ndarray:
    """How many shingles fall into each group; groups are ranges of hashes, their number a power of two by the set's size."""
    bits = max(GROUPS.bit_length() - 1, (len(found) // GROUP_SIZE).bit_length())
    return np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype("<u2")


def packed(vector: np.ndarray) -> bytes:
    """The vector's bytes behind their number for each count: one, unless a count needs two."""
    return b"\1" + vector.astype("u1").tobytes() if vector.max(initial=0) < 256 else b"\2" + vector.tobytes()


def unpacked(found: pa.BinaryScalar) -> np.ndarray:
    data = found.as_buffer()
    return np.frombuffer(data, "u1" if data[0] == 1 else "<u2", offset=1).astype("<u2")


def folded(vector: np.ndarray, size: int = GROUPS) -> np.ndarray:
    """The vector of fewer groups."""
    return vector.reshape(size, -1).sum(axis=1, dtype=np.int64)


def shared_most(a: np.ndarray, b: np.ndarray) -> int:
    """The most shingles that sets of these vectors can share: the sum of the coordinate minima."""
    size = min(len(a), len(b))
    return int(np.minimum(folded(a, size), folded(b, size)).sum())


def needed(a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least common shingles of sets of a and b that make the similarity."""
    return -(-(percent * (a + b)) // (100 + percent))


def first_shingles(found: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """Those of which similar sets share one: common ones come last, otherwise in order of their hashes."""
    n = len(found)
    take = n - -(-percent * n // 100) + 1
    if len(common) and n:
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        late = common[at] == found
        found = np.concatenate([found[~late], found[late]])
    return found[:take]


class Tree:
    """Boxes of count vectors: each node keeps its upper corner and its smallest and largest size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # neighbours in the tree are alike in size, then along the coordinates that vary most
        spread = np.argsort(-points.var(axis=0))[:3]
        order = np.lexsort([*(points[:, d] for d in reversed(spread)), sizes])
        self.order, self.points, self.sizes = order, points[order], sizes[order]
        self.levels = []
        corner, low, high = self.points, self.sizes, self.sizes
        while len(corner) > FANOUT:
            starts = np.arange(0, len(corner), FANOUT)
            corner = np.maximum.reduceat(corner, starts)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.levels.append((corner, low, high))

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Positions of all points that could be similar enough."""
        levels = [(self.points, self.sizes, self.sizes), *self.levels]
        at = np.arange(len(levels[-1][0]))
        for k in range(len(levels) - 1, -1, -1):
            corner, low, high = (x[at] for x in levels[k])
            # the best case inside a box is its smallest allowed size
            least = np.maximum(low, -(-percent * size // 100))
            bound = np.minimum(corner, point).sum(axis=1)
            at = at[(least <= high) & (100 * size >= percent * low) & (bound >= needed(size, least, percent))]
            if k:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(levels[k - 1][0])]
        return self.order[at]


def similar_classes(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of all documents.

    A null or empty text, or one of white space, has an empty set and links with
    nothing. The component_id is the smallest doc_id reachable by links, its own
    included. Rows that repeat a doc_id keep their sets and share a component when
    linked; a null doc_id takes no part in links and is its own, null, component.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    common = common_shingles(rows, n)
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                size, one, two, first, vector = [], [], [], [], []
                for found in shingle_sets(part["text"], n):
                    size.append(len(found))
                    one.append(int(found.sum(dtype=np.uint64).view(np.int64)))
                    two.append(int(mix(found ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))
                    first.append(first_shingles(found, shared.value, percent).view(np.int64))
                    vector.append(packed(count_vector(found)))
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], pa.array(size, pa.int32()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                    pa.array(first, pa.list_(pa.int64())), pa.array(vector, pa.binary()),
                ], ["doc_id", "size", "one", "two", "first", "vector"])

    sets = written(rows.mapInArrow(describe, "doc_id long, size int, one long, two long, first array<long>, vector binary"), "shingle-sets")
    # equal sets: one representative, the rest are its copies
    same = ["size", "one", "two"]
    real = (F.col("size") > 0) & F.col("doc_id").isNotNull()
    repeated = sets.where(real).groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where(F.col("n") > 1)
    repeated = written(repeated.select(*same, "rep"), "equal-sets")
    named = with_representative(sets.where(real), repeated, same).select(F.col("doc_id").alias("id"), "rep", "size", "first", "vector")
    kept = written(named.where(F.col("rep").isNull() | (F.col("rep") == F.col("id"))), "sets")
    single = kept.where(F.col("rep").isNull()).union(kept.where(F.col("rep").isNotNull()).dropDuplicates(["id", "size", "first"])).drop("rep")
    copies = sets.where(real).select("doc_id", *same).join(repeated, same).where(F.col("rep") != F.col("doc_id"))
    copies = written(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")), "copies")
    # first shingles and vectors are large: they lie in one table, and the first ones go when they have met
    sizes = written(sets.select("doc_id", F.col("size").cast("long").alias("n_shingles")), "sizes")
    discard(sets, repeated)

    # a document links to the least one of each shingle's group; a doc_id with several sets is one node
    by_key = Window.partitionBy("key")
    near = written(alike_in_size(single.select("id", "size", F.explode("first").alias("key")), percent), "near")
    vectors = written(single.select("id", "size", "vector"), "vectors")
    discard(kept)
    groups = written(distinct_groups(near), "groups")
    met = written(near.join(groups, "key"), "met")
    discard(near, groups)
    star = met.where(
        (F.col("id") != F.col("lead.id")) & (F.least("size", "lead.size") * 100 >= F.greatest("size", "lead.size") * percent)
    ).select(F.col("lead.id").alias("a"), F.col("id").alias("b")).distinct()
    links = verified(bounded_overlap(star, vectors, percent), rows, n, percent)
    so_far = written(components(links), "star-components")

    # where a group still has several components, any two of its rows may link
    placed = met.select("key", "id", "size").join(so_far, "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")
    open_rows = (
        placed.withColumn("least", F.min("part").over(by_key)).withColumn("most", F.max("part").over(by_key))
        .where(F.col("least") != F.col("most")).select("key", "id", "size", "part")
    )
    open_rows = written(open_rows, "open-rows")
    discard(met, links)
    more = verified(tree_join(open_rows, vectors, percent), rows, n, percent)
    discard(open_rows, vectors)
    united = so_far.select(F.col("component").alias("a"), F.col("id").alias("b"))
    final = components(united.union(more).union(copies))
    return (
        sizes.join(final, F.col("doc_id") == F.col("id"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def with_representative(sets: DataFrame, repeated: DataFrame, same: list[str]) -> DataFrame:
    """The sets with the representative of their equals, null for a set that has none.

    First shingles and vectors are large, and few sets have equals. A map of bits, of at
    most MAP_WORDS words whatever the input, tells most of the others, which then need no
    shuffle; all that may have equals are joined.
    """
    word, bit = F.pmod(F.shiftright("one", 6), F.lit(MAP_WORDS)), F.expr("shiftleft(1L, CAST(one & 63 AS INT))")
    filled = repeated.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    marked = sets.withColumn("word", word).join(F.broadcast(filled), "word", "left").drop("word")
    maybe = F.coalesce(F.col("bits").bitwiseAND(bit) != 0, F.lit(False))
    alone = marked.where(~maybe).drop("bits").withColumn("rep", F.lit(None).cast("long"))
    return alone.unionByName(marked.where(maybe).drop("bits").join(repeated, same, "left"))


def distinct_groups(keyed: DataFrame) -> DataFrame:
    """(key, lead) of the keys with several ids; of keys with the same members one stays. lead: the least (id, size).

    Counted before the shuffle. Near copies share most of their shingles, so that most
    keys of a group repeat its members; members are compared by their number, least and
    greatest, and four sums of 32 bits of their hashes.
    """
    h, g = F.xxhash64("id", "size"), F.xxhash64("size", "id", F.lit(1))
    sums = [F.sum(x).alias(f"s{i}") for i, half in enumerate((h, g)) for i, x in ((2 * i, F.shiftright(half, 32)), (2 * i + 1, half.bitwiseAND(F.lit(0xFFFFFFFF))))]
    groups = keyed.groupBy("key").agg(F.min(F.struct("id", "size")).alias("lead"), F.max("id").alias("last"), F.count("*").alias("n"), *sums)
    members = ["lead", "last", "n", "s0", "s1", "s2", "s3"]
    return groups.where(F.col("lead.id") != F.col("last")).groupBy(*members).agg(F.min("key").alias("key")).select("key", "lead")


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each group of near duplicates: that with the smallest doc_id.

    Rows that repeat both doc_id and text count once. Rows that repeat a doc_id with
    other texts are documents of their own: the one whose text has the least hash goes
    by the id, the others by a 62-bit hash above 2**62. Rows without a doc_id, and null
    or empty texts, stay; an empty table stays empty.
    """
    hashed = docs.withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    again = hashed.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("_n"), F.min("_hash").alias("_first"))
    again = written(again.where(F.col("_n") > 1).select("doc_id", "_first"), "repeated-ids")
    other = F.col("_first").isNotNull() & (F.col("_hash") != F.col("_first"))
    far = F.shiftrightunsigned(F.xxhash64("doc_id", "_hash"), 2).bitwiseOR(F.lit(1 << 62))
    nodes = hashed.join(again, "doc_id", "left").withColumn("_node", F.when(other, far).otherwise(F.col("doc_id").cast("long")))
    classes = similar_classes(nodes.select(F.col("_node").alias("doc_id"), "text"), n, percent)
    gone = written(classes.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_node")).distinct(), "near-duplicates")
    kept = nodes.join(gone, "_node", "left_anti")
    repeated = kept.where(F.col("_first").isNotNull()).select(docs.columns).dropDuplicates(["doc_id", "text"])
    return kept.where(F.col("_first").isNull()).select(docs.columns).union(repeated)


def alike_in_size(keyed: DataFrame, percent: int) -> DataFrame:
    """Rows of a key that have a neighbour in size near enough to be similar; ``key`` then names one run of such neighbours.

    Similar sets of a key lie in one run, as sizes between two near sizes are nearer.
    """
    by_size = Window.partitionBy("key").orderBy("size", "id")
    near = keyed.withColumn("before", F.lag("size").over(by_size)).withColumn("after", F.lead("size").over(by_size))
    joins_before = F.coalesce(F.col("before") * 100 >= F.col("size") * percent, F.lit(False))
    joins_after = F.coalesce(F.col("size") * 100 >= F.col("after") * percent, F.lit(False))
    kept = near.where(joins_before | joins_after)
    run = F.sum(F.when(joins_before, 0).otherwise(1)).over(by_size)
    return kept.withColumn("run", run).select(F.xxhash64("key", "run").alias("key"), "id", "size")


def common_shingles(rows: DataFrame, n: int) -> np.ndarray:
    """Shingles of at least COMMON texts of a sample of one in SAMPLE, at most COMMON_MOST, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for found in shingle_sets(part["text"], n):
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["key"])

    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text").distinct()
    often = sample.mapInArrow(run, "key long").groupBy("key").count().where(F.col("count") >= COMMON)
    top = often.orderBy(F.desc("count"), "key").limit(COMMON_MOST)
    return np.sort(np.array([r.key for r in top.select("key").collect()], np.int64).view(np.uint64))


def bounded_overlap(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose count vectors allow the similarity."""
    a, b = (sets.select(F.col("id").alias(x), F.col("size").alias(f"{x}_size"), F.col("vector").alias(f"{x}_vector")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = [
                shared_most(unpacked(x), unpacked(y))
                for x, y in zip(batch["a_vector"], batch["b_vector"], strict=True)
            ]
            sizes = (batch[x].to_numpy().astype(np.int64) for x in ("a_size", "b_size"))
            yield batch.select(["a", "b"]).filter(pa.array(np.array(most, np.int64) >= needed(*sizes, percent)))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "a_size", "b_size", "a_vector", "b_vector").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """A table of the pairs (a, b) whose sets are similar enough, with the sets of the documents concerned taken from their texts.

    The texts are shuffled, not the sets: eight bytes a shingle, which do not compress, take more room than the words.
    They are cut again for each pair, a few at a time.
    """
    pairs = written(pairs, "pairs")
    concerned = written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "concerned")
    texts = written(rows.join(concerned, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "text"), "pair-sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in slices(batch, "x"):
                for part in slices(half, "y"):
                    keep = []
                    for left, right in zip(shingle_sets(part["x"], n), shingle_sets(part["y"], n), strict=True):
                        both = len(np.intersect1d(left, right, assume_unique=True))
                        keep.append(both > 0 and 100 * both >= percent * (len(left) + len(right) - both))
                    yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x, y = (texts.select(F.col("id").alias(i), F.col("text").alias(t)) for i, t in (("a", "x"), ("b", "y")))
    links = written(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "similar-pairs")
    discard(pairs, concerned, texts)
    return links


def tree_join(open_rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of different parts that share a key and whose points are near enough, found by a tree for each key.

    A key with more than BLOCK rows is cut into blocks in order of size; every two
    blocks whose sizes can be similar meet, so no task holds more than two blocks.
    """
    by_key = Window.partitionBy("key")
    place = F.row_number().over(by_key.orderBy("size", "id"))
    blocked = open_rows.withColumn("block", F.floor((place - 1) / BLOCK).cast("int"))
    blocks = blocked.groupBy("key", "block").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    left, right = blocks.alias("l"), blocks.alias("r")
    meets = left.join(right, (F.col("l.key") == F.col("r.key")) & (F.col("l.block") <= F.col("r.block")) & (F.col("l.high") * 100 >= F.col("r.low") * percent))
    meets = meets.select(F.col("l.key").alias("key"), F.col("l.block").alias("lb"), F.col("r.block").alias("rb"))
    dealt = meets.select("key", "lb", "rb", F.explode(F.array_distinct(F.array("lb", "rb"))).alias("block")).join(blocked, ["key", "block"])
    ready = dealt.join(sets.select("id", "vector"), "id").select("key", "lb", "rb", "block", "id", "size", "part", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            names = [held[x].to_numpy() for x in ("key", "lb", "rb")]
            new = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
            if len(new):
                yield from pairs_of(held.slice(0, int(new[-1])), np.concatenate([[0], new[:-1]]))
                held = held.slice(int(new[-1])).combine_chunks()
        if held is not None:
            yield from pairs_of(held, np.array([0]))

    def pairs_of(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, sizes, parts, block = (table[x].to_numpy().astype(np.int64) for x in ("id", "size", "part", "block"))
        lb, rb = table["lb"].to_numpy(), table["rb"].to_numpy()
        vectors = [unpacked(x) for x in table["vector"]]
        points = np.array([folded(v) for v in vectors])
        ends = np.append(starts[1:], table.num_rows)
        left, right = [], []
        two = starts[ends - starts == 2]
        near = np.minimum(points[two], points[two + 1]).sum(axis=1) >= needed(sizes[two], sizes[two + 1], percent)
        left.append(two[near])
        right.append(two[near] + 1)
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b - a > 2:
                tree = Tree(points[a:b], sizes[a:b])
                for i in range(a, b):
                    at = tree.search(points[i], int(sizes[i]), percent) + a
                    # rows of one block meet where it is paired with itself
                    fine = (at > i) & (parts[at] != parts[i]) & ((lb[a] == rb[a]) | (block[at] != block[i]))
                    left.append(np.full(int(fine.sum()), i))
                    right.append(at[fine])
        i, j = np.concatenate(left).astype(np.int64), np.concatenate(right).astype(np.int64)
        fine = parts[i] != parts[j]
        i, j = i[fine], j[fine]
        most = np.array([shared_most(vectors[x], vectors[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
        fine = most >= needed(sizes[i], sizes[j], percent)
        i, j = i[fine], j[fine]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], ["a", "b"])

    ordered = ready.repartition("key", "lb", "rb").sortWithinPartitions("key", "lb", "rb", "id")
    return ordered.mapInArrow(run, "a long, b long").distinct()
