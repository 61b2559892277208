"""Repair conversations so that their roles follow a grammar, at the least cost.

A conversation is good if the initials of its roles read ``(s?(ua)+)?``: nothing,
or an optional system turn and then pairs of user and assistant. Rows may be kept,
given another role, or deleted; turns with empty text may be inserted. The cheapest
edits are found by dynamic programming over the four states of the grammar, in
blocks of a fixed number of rows, as the Four Russians did: the costs of finishing
from each state, less their minimum, take only a few dozen values, so a table made
once says for each such vector and each block of symbols which vector precedes the
block and what it adds. A block is one lookup. For the edits themselves the vectors
inside a block are expanded backward from its end, and the edits are read forward
against them, so that of several cheapest ones the least in ASCII order is found.

A conversation of any length is cut into chunks of ``CHUNK`` rows. Every chunk gives,
for each vector at its end, the vector at its start; chunks are chained from the
last to the first, traced for every state in which they may be entered, and chained
again from the first to the last. Only rows of one number per vector pass through
one task per conversation, and in streams. The repaired rows come in order, so the
task that writes a conversation reads it as a stream of sorted rows too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replygauge.llm.common import written

DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5
#: Rows of a chunk; a multiple of BLOCK.
CHUNK = 1 << 16
#: Rows of a block, which is one lookup.
BLOCK = 4

#: Grammar states: nothing yet, after system, after user, after assistant.
_STATES = range(4)
_FAR = 1 << 20
#: State after a system, user, assistant or other turn; -1 where the grammar forbids it.
_STEP = [[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]]
#: State after the one turn that may be written in each state.
_WRITE = [2, 2, 3, 2]
_END = [0, _FAR, _FAR, 0]

#: Faults of a row, the first that holds.
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: A code is the role (0 to 3) and four times the fault. Symbols: 0 must go, 1 to 4 sound, 5 to 8 truncated.
_SYMBOL = np.array([1, 2, 3, 4, 0, 0, 0, 0, 0, 0, 0, 0, 5, 6, 7, 8], np.int64)
_SYMBOLS = 9
#: Whether a turn may follow another, by role.
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True

SPACES = " \t\n\x0b\x0c\r"


def _written_turns(costs: list[int]) -> list[int]:
    for _ in _STATES:
        costs = [min(costs[q], INSERT + costs[_WRITE[q]]) for q in _STATES]
    return costs


def _before(symbol: int, costs: list[int] | tuple[int, ...]) -> list[int]:
    """Costs of finishing before a row, from those after it."""
    out = [DELETE + costs[q] for q in _STATES]
    if symbol:
        role, more = (symbol - 1) % 4, UNFINISHED * (symbol > 4)
        for q in _STATES:
            if _STEP[q][role] >= 0:
                out[q] = min(out[q], more + costs[_STEP[q][role]])
            out[q] = min(out[q], REROLE + more + costs[_WRITE[q]])
    return _written_turns(out)


class Tables:
    """All normalised cost vectors, and their transitions by symbol and by block of symbols."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [tuple(_written_turns(_END))]
        known = {self.vectors[0]: 0}
        step, add = [], []
        for vector in self.vectors:
            step.append([])
            add.append([])
            for symbol in range(_SYMBOLS):
                costs = _before(symbol, vector)
                least = min(costs)
                costs = tuple(c - least for c in costs)
                if costs not in known:
                    known[costs] = len(self.vectors)
                    self.vectors.append(costs)
                step[-1].append(known[costs])
                add[-1].append(least)
        self.step, self.add = np.array(step), np.array(add)
        self.steps, self.adds = self.step, self.add
        for _ in range(block - 1):
            # One more symbol at the left: it is the highest digit of the block's number.
            left = [(self.step[self.steps, s], self.adds + self.add[self.steps, s]) for s in range(_SYMBOLS)]
            self.steps, self.adds = (np.concatenate([x[i] for x in left], axis=1) for i in (0, 1))
        self._known: dict[tuple[int, int, int], tuple[bytes, int]] = {}

    def numbers(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the whole blocks, and the symbols after them."""
        whole = len(symbols) // self.block * self.block
        places = _SYMBOLS ** np.arange(self.block - 1, -1, -1)
        return symbols[:whole].reshape(-1, self.block) @ places, symbols[whole:]

    def across(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every vector after the symbols, that before them and what they add."""
        blocks, rest = self.numbers(symbols)
        at, total = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for symbol in rest[::-1]:
            at, total = self.step[at, symbol], total + self.add[at, symbol]
        for number in blocks[::-1]:
            at, total = self.steps[at, number], total + self.adds[at, number]
        return at, total

    def _read(self, after: int, symbols: list[int], state: int) -> tuple[bytes, int]:
        """The least of the cheapest edits of a few rows, entered in ``state``, and the state behind them."""
        chain = [after]
        for symbol in reversed(symbols):
            chain.append(int(self.step[chain[-1], symbol]))
        edits = bytearray()
        for i, symbol in enumerate(symbols):
            now, then = self.vectors[chain[len(symbols) - i]], self.vectors[chain[len(symbols) - i - 1]]
            add = int(self.add[chain[len(symbols) - i - 1], symbol])
            role, more = (symbol - 1) % 4, UNFINISHED * (symbol > 4)
            while True:
                cost = now[state] + add
                if DELETE + then[state] == cost:
                    edits += b"D"
                elif INSERT + now[_WRITE[state]] + add == cost:
                    edits += b"I"
                    state = _WRITE[state]
                    continue
                elif _STEP[state][role] >= 0 and more + then[_STEP[state][role]] == cost:
                    edits += b"K"
                    state = _STEP[state][role]
                else:
                    edits += b"R"
                    state = _WRITE[state]
                break
        return bytes(edits), state

    def trace(self, symbols: np.ndarray, after: int, state: int) -> tuple[bytes, int]:
        """Edits of the rows and the state behind them; ``after`` is the vector there."""
        blocks, rest = self.numbers(symbols)
        rest = rest.tolist()
        ends = [after]
        for symbol in reversed(rest):
            ends.append(int(self.step[ends[-1], symbol]))
        ends = [ends[-1]]
        numbers = blocks.tolist()
        for number in reversed(numbers):
            ends.append(int(self.steps[ends[-1], number]))
        out = []
        for i, number in enumerate(numbers):
            key = (ends[len(numbers) - i - 1], number, state)
            if key not in self._known:
                self._known[key] = self._read(key[0], symbols[i * self.block : (i + 1) * self.block].tolist(), state)
            edits, state = self._known[key]
            out.append(edits)
        edits, state = self._read(after, rest, state)
        return b"".join(out) + edits, state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def closing(state: int) -> bytes:
    """Turns to write behind the last row."""
    return {1: b"II", 2: b"I"}.get(state, b"")


_HASHES = ["h1", "h2"]
_ORDER = ["turn", "role", *_HASHES, "copy"]
_KEY = "struct<turn:long, role:string, h1:long, h2:long, copy:long>"


def _rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls as one space, and how often the row is there."""
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1)
    space = F.lit(" ")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), copies.cast("long").alias("copies"))
    return rows.withColumn("h1", F.xxhash64(F.col("text"), F.lit(1))).withColumn("h2", F.xxhash64(F.lit(2), F.col("text")))


def _coded(rows: DataFrame) -> DataFrame:
    """One small row per row: its place in the conversation and its code."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    last = F.substring(end, -1, 1)
    small = rows.select("conv_id", "turn", "role", *_HASHES, "copies", role.alias("kind"), (end == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    # Rows equal in everything count once, with their number, before they are shuffled.
    small = small.groupBy("conv_id", "turn", "role", *_HASHES, "kind", "blank", "cut").agg(F.sum("copies").alias("copies"))
    first = small.where(~F.col("blank")).groupBy("conv_id", "role", *_HASHES).agg(F.min(F.struct("turn")).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), *(F.col(h).alias(f"{h}f") for h in _HASHES), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h1") == F.col("h1f")) & (F.col("h2") == F.col("h2f"))
    placed = small.join(first, same, "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    again = ~(F.col("turn").eqNullSafe(F.col("first.turn")) & (F.col("copy") == 0))
    fault = F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(0)
    return placed.select("conv_id", *_ORDER, (F.col("kind") + 4 * fault).cast("byte").alias("code"))


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before; nulls are equal."""
    out = np.ones(len(column), bool)
    if len(column) > 1:
        a, b = column[1:], column[:-1]
        differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        out[1:] = differ | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
    return out


def _fields(frame_fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in frame_fields)


def _chunks(coded: DataFrame, chunk: int) -> DataFrame:
    """Runs of rows of one conversation in order, as one row each with what they do to every vector."""
    conv = coded.schema["conv_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables()
        held: list[dict] = []
        current: dict | None = None

        def close(x: dict) -> dict:
            codes = np.frombuffer(b"".join(x.pop("parts")), np.uint8)
            step, add = table.across(_SYMBOL[codes])
            turns = np.concatenate(x.pop("turns"))
            return x | {"codes": codes.tobytes(), "step": step.tolist(), "add": add.tolist(), "turns": len(np.unique(turns)),
                        "low": int(turns.min()) if len(turns) else None, "high": int(turns.max()) if len(turns) else None}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(held, schema=target)

        target = None
        for batch in batches:
            if target is None:
                key = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("h1", pa.int64()), ("h2", pa.int64()), ("copy", pa.int64())])
                target = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("first", key), ("codes", pa.binary()), ("step", pa.list_(pa.int32())),
                                    ("add", pa.list_(pa.int64())), ("turns", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
            if not batch.num_rows:
                continue
            conv_ids, codes = batch["conv_id"], batch["code"].to_numpy(zero_copy_only=False).astype(np.uint8)
            turn = batch["turn"]
            known = turn.is_valid().to_numpy(zero_copy_only=False)
            turn = pc.fill_null(turn, 0).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(_changes(conv_ids))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
                conv_id = conv_ids[a].as_py()
                if current is not None and current["conv_id"] != conv_id:
                    held.append(close(current))
                    current = None
                while a < b:
                    if current is None:
                        current = {"conv_id": conv_id, "first": {c: batch[c][a].as_py() for c in _ORDER}, "parts": [], "turns": [], "n": 0}
                    to = min(b, a + chunk - current["n"])
                    current["parts"].append(codes[a:to].tobytes())
                    current["turns"].append(turn[a:to][known[a:to]])
                    current["n"] += to - a
                    a = to
                    if current["n"] == chunk:
                        held.append(close(current))
                        current = None
            if len(held) > 2000:
                yield out()
                held = []
        if current is not None:
            held.append(close(current))
        if held:
            yield out()

    ordered = coded.repartitionByRange("conv_id", *_ORDER).sortWithinPartitions("conv_id", *_ORDER)
    schema = [("conv_id", conv), ("first", _KEY), ("codes", "binary"), ("step", "array<int>"), ("add", "array<long>"), ("turns", "long"), ("low", "long"), ("high", "long")]
    return ordered.mapInArrow(cut, _fields(schema))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Schema]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row, batch.schema


def _ended(chunks: DataFrame) -> DataFrame:
    """Each chunk with the vector behind it, what is added behind it, and whether it is its conversation's first or last."""
    conv = chunks.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "first", "codes", "turns", "low", "high"]

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables()
        before = None
        vector, total = 0, 0
        schema = None

        def each():
            nonlocal before, vector, total, schema
            for row, given in _stream(batches):
                if schema is None:
                    schema = pa.schema([given.field(n) for n in names] + [("after", pa.int32()), ("cost", pa.int64()), ("leftmost", pa.bool_()), ("rightmost", pa.bool_())])
                last = before is None or before["conv_id"] != row["conv_id"]
                if last:
                    vector, total = 0, 0
                if before is not None:
                    yield before | {"leftmost": last}
                before = {n: row[n] for n in names} | {"after": vector, "rightmost": last}
                total += row["add"][vector]
                vector = row["step"][vector]
                before["cost"] = total + table.vectors[vector][0]
            if before is not None:
                yield before | {"leftmost": True}

        held = []
        for row in each():
            held.append(row)
            if len(held) == 256:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    falling = chunks.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("first").desc())
    schema = [(n, conv if n == "conv_id" else chunks.schema[n].dataType.simpleString()) for n in names]
    return falling.mapInArrow(chain, _fields([*schema, ("after", "int"), ("cost", "long"), ("leftmost", "boolean"), ("rightmost", "boolean")]))


def _traced(ended: DataFrame) -> DataFrame:
    """Each chunk's edits and end state for every state it may be entered in."""

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables()
        for batch in batches:
            edits, ends = [], []
            for codes, after, leftmost, rightmost in zip(*(batch[c].to_pylist() for c in ("codes", "after", "leftmost", "rightmost")), strict=True):
                symbols = _SYMBOL[np.frombuffer(codes, np.uint8)]
                found = [table.trace(symbols, after, q) for q in ((0,) if leftmost else _STATES)]
                edits.append([(e + closing(q) if rightmost else e).decode() for e, q in found])
                ends.append([q for _, q in found])
            keep = [i for i, n in enumerate(batch.schema.names) if n != "after"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array(edits, pa.list_(pa.string())), pa.array(ends, pa.list_(pa.int32()))],
                [batch.schema.names[i] for i in keep] + ["edits", "ends"],
            )

    kept = [(f.name, f.dataType.simpleString()) for f in ended.schema.fields if f.name != "after"]
    return ended.mapInArrow(trace, _fields([*kept, ("edits", "array<string>"), ("ends", "array<int>")]))


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost", "turns"]


def audits(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The edits of each chunk of each conversation, with its faults.

    conv_id, first (place of the chunk's first row), audit (its edits), blank,
    duplicate, truncated, illegal, cost (of the conversation, in its first chunk), turns
    (distinct ones that no earlier chunk has), low and high (turns).
    """
    traced = _traced(_ended(written(_chunks(_coded(_rows(conversations)), chunk), "chunks")).repartition("conv_id", "first"))
    conv = traced.schema["conv_id"].dataType.simpleString()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, role, turn = 0, None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["leftmost"]:
                    state, role, turn = 0, None, None
                codes = np.frombuffer(row["codes"], np.uint8)
                roles, faults = codes & 3, np.bincount(codes >> 2, minlength=4).tolist()
                illegal = int((~_LEGAL[roles[:-1], roles[1:]]).sum())
                if role is not None:
                    illegal += not _LEGAL[role, roles[0]]
                out.append({
                    "conv_id": row["conv_id"], "first": row["first"], "audit": row["edits"][state], "blank": faults[BLANK], "duplicate": faults[DUPLICATE],
                    "truncated": faults[TRUNCATED], "illegal": illegal, "cost": row["cost"] if row["leftmost"] else 0,
                    "turns": row["turns"] - (turn is not None and turn == row["low"]), "low": row["low"], "high": row["high"],
                })
                state, role = row["ends"][state], int(roles[-1])
                turn = row["high"] if row["high"] is not None else turn
            given = batch.schema
            target = pa.schema([given.field("conv_id"), given.field("first"), ("audit", pa.string()), *((c, pa.int64()) for c in _COUNTS), ("low", pa.int64()), ("high", pa.int64())])
            yield pa.RecordBatch.from_pylist(out, schema=target)

    rising = traced.repartition("conv_id").sortWithinPartitions("conv_id", "first")
    schema = [("conv_id", conv), ("first", _KEY), ("audit", "string"), *((c, "long") for c in _COUNTS), ("low", "long"), ("high", "long")]
    return rising.mapInArrow(choose, _fields(schema))


#: Role of a turn by the state behind it.
_NAMES = {2: "user", 3: "assistant"}


def repaired(conversations: DataFrame, audit: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, role, text, in order within a partition.

    Every conversation lies in one partition. A chunk's edits are sorted in just before
    its first row, so a task holds one batch and one chunk's edits, whatever the
    conversation's length.
    """
    rows = _rows(conversations)
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    rows = rows.select("conv_id", *_ORDER, F.lit(1).alias("is_row"), "text", F.lit(None).cast("string").alias("audit"))
    edits = audit.select("conv_id", *(F.col(f"first.{c}").alias(c) for c in _ORDER), F.lit(0).alias("is_row"), F.lit(None).cast("string").alias("text"), "audit")
    conv = rows.schema["conv_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, started, edits, at, state = None, False, "", 0, 0

        def inserts(out: list) -> None:
            nonlocal at, state
            while at < len(edits) and edits[at] == "I":
                state, at = _WRITE[state], at + 1
                out.append((current, _NAMES[state], ""))

        kind = None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            out: list[tuple] = []
            for conv_id, is_row, role, text, more in zip(*(batch[c].to_pylist() for c in ("conv_id", "is_row", "role", "text", "audit")), strict=True):
                if not started or conv_id != current:
                    inserts(out)
                    current, started, edits, at, state = conv_id, True, "", 0, 0
                if not is_row:
                    edits, at = edits[at:] + more, 0
                    continue
                inserts(out)
                edit = edits[at]
                at += 1
                if edit == "K":
                    out.append((conv_id, role, text))
                    state = _STEP[state]["sua".find(role[:1]) if role else 3]
                elif edit == "R":
                    state = _WRITE[state]
                    out.append((conv_id, _NAMES[state], text))
            if out:
                yield _row_batch(out, kind)
        out = []
        inserts(out)
        if out:
            yield _row_batch(out, kind)

    ordered = rows.union(edits).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", *_HASHES, "is_row", "copy")
    return ordered.mapInArrow(write, _fields([("conv_id", conv), ("role", "string"), ("text", "string")]))


def _row_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (kind, pa.string(), pa.string()), strict=True)], ["conv_id", "role", "text"])


def _digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's rows in the order in which they come."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            done = []
            for conv_id, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if state is None or conv_id != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = conv_id, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], kind), pa.array([x[1] for x in done])], ["conv_id", "digest"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([state.hexdigest()])], ["conv_id", "digest"])

    conv = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(digest, _fields([("conv_id", conv), ("digest", "string")]))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults by crc32 of ``conv_id:turn`` modulo 20, nulls as one space.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it (copies is
    then 2), 4 makes it a user's.
    """
    space = F.lit(" ")

    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), space)

    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault")).where(F.col("fault") != 0)
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"),
    )


def repair_report(conversations: DataFrame, known: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """Faults, cheapest edits and a digest of the repaired rows of every conversation.

    conversations holds conv_id, turn, role, text, and copies if rows stand for several;
    known holds conv_ids to report even without rows. Rows go by turn, nulls first, then
    by role and a hash of the text. A row is blank without a character other than
    space and bytes 9 to 13, else a duplicate if its role and text were there before,
    else truncated if the last such character is none of ``.!?``.

    Keep costs 0 and Rerole (to user or assistant) 1, both 5 more for a truncated row;
    Delete costs 2 and is the only choice for blank and duplicate rows; Insert of an
    empty user or assistant turn costs 5. Of the cheapest edits that give roles of
    ``(s?(ua)+)?`` audit holds the initials of those least in ASCII order.

    Null roles and texts are one space; a null conv_id is a conversation; null turns come
    first and count in no gap; rows equal in all columns are duplicates; a conversation
    without rows has zeros, an empty audit and the digest of nothing; an empty table
    gives no rows; further columns are ignored. Texts and conversations of any length
    pass in streams; only the digest of one conversation is, by its nature, one task's.
    """
    audit = written(audits(conversations, chunk), "audits")
    digests = _digests(repaired(conversations, audit))
    names = (known if known is not None else conversations).select("conv_id")
    parts = names.unionByName(audit, allowMissingColumns=True).unionByName(digests, allowMissingColumns=True)
    whole = parts.groupBy("conv_id").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS),
        F.coalesce(F.max("high") - F.min("low") + 1, F.lit(0)).alias("range"),
        F.sort_array(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("first", "audit")))).alias("audits"),
        F.max("digest").alias("digest"),
    )
    return whole.select(
        "conv_id", (F.col("range") - F.col("turns")).alias("gaps"), *_COUNTS[:5],
        F.array_join(F.transform("audits", lambda x: x["audit"]), "").alias("audit"),
        F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
