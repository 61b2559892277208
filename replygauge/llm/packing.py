"""Hierarchical packing of token streams into context windows of several sizes.

A document is cut into full windows of the longest tier and a rest. The rest is
routed to the shortest tier that holds it; each tier is packed best fit, longest
rests first, and gaps that stay open in longer windows are filled from shorter
tiers, cut where needed. What is left at the end is split into tiers of powers
of two, so that hardly any padding remains. Windows of one tier are then dealt
to step groups of equal size.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replygauge.llm.arrays import slices

LONGEST = 4096
SHORTEST_TIER = 512
#: Tokens of one packing run; memory of a task follows it, not the partition.
RUN_TOKENS = 1 << 21
#: Windows of a tier that make up one training step.
STEP_WINDOWS = 16
#: Bytes of words whose ids a worker keeps, by estimate; beyond it the table starts anew with the frequent ones.
CACHE_BYTES = 48 << 20
#: What a word takes beside its letters and ids: its string, its place and both in a dictionary.
_WORD_BYTES = 180
END = 2

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier int, step_group long"
)

Piece = tuple[int, int, int]  # document in the run, start, length


# A run of signs at the end of a word is a token of its own in any case.
_SIGNS = re.compile(r"(.*[^\W_])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)
#: What tells that runs of letters are pieces to the tokenizer, and that bytes stand for characters.
_LETTERS = r"|[\p{L}]+|"
#: Letters below are those of every version of Unicode, and their lower case is their own.
_LATIN = "\u0250"
# Spaces to Python that are none to the tokenizer, and a letter whose lower case depends on what follows.
_ODD = re.compile("[\x1c-\x1f\u03a3]")


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """The values in an array of at least this size, which grows by doubling."""
    if len(values) >= size:
        return values
    grown = np.zeros(max(size, 2 * len(values)), values.dtype)
    grown[: len(values)] = values
    return grown


class Encoder:
    """Ids of whole texts; each distinct word is encoded once.

    White space ends a word for this tokenizer, so the ids of a text are those of
    its words one after the other. A text with characters for which that may not
    hold is encoded as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # a word of lower-case letters alone is one piece as it is: the same model without normal forms and patterns
        self.light = None
        suffix, cut = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.pre_tokenizer
        if suffix and _LETTERS in str(cut):
            self.light = Tokenizer(self.tokenizer.model)
            vocabulary = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
            spaced = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            self.light.pre_tokenizer = pre_tokenizers.Sequence(spaced)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.bounds = np.zeros(1, np.int64)
        self.uses = np.zeros(0, np.uint32)
        self.held = 0

    def shrink(self) -> None:
        """Starts the table anew with the words looked up most, which fill at most half of it."""
        words, flat, bounds, uses = list(self.known), self.flat, self.bounds, self.uses[: len(self.known)]
        sizes = bounds[1 : len(words) + 1] - bounds[: len(words)]
        order = np.argsort(-uses.astype(np.int64), kind="stable")
        order = order[: int((uses > 1).sum())]
        cost = np.fromiter((len(words[i]) for i in order.tolist()), np.int64, len(order)) + _WORD_BYTES + 4 * sizes[order]
        order = order[np.cumsum(cost) <= CACHE_BYTES // 2]
        ids = self.joined(order)
        self.clear()
        if len(order):
            self._add([words[i] for i in order.tolist()], ids, sizes[order])

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.known)
        filled, last = int(self.bounds[first]), first + len(words)
        self.known.update(zip(words, range(first, last), strict=True))
        self.flat, self.bounds, self.uses = _room(self.flat, filled + len(ids)), _room(self.bounds, last + 1), _room(self.uses, last)
        self.flat[filled : filled + len(ids)] = ids
        self.bounds[first + 1 : last + 1] = filled + np.cumsum(sizes)
        self.held += sum(map(len, words)) + _WORD_BYTES * len(words) + 4 * len(ids)

    def learn(self, words: set[str]) -> None:
        """Take in new words; one that ends in signs is put together from its two parts."""
        parted = {w: m.groups() for w in words if not w[-1].isalnum() and (m := _SIGNS.fullmatch(w))}
        new = words.difference(parted)
        new.update(x for pair in parted.values() for x in pair if x not in self.known)
        plain = [x for x in new if x.isalpha() and max(x) < _LATIN] if self.light else []
        if plain:
            ids = np.array(self.light.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(plain):
                self._add(plain, ids, np.diff(ends, prepend=0))
                new.difference_update(plain)
        if new:
            other = list(new)
            found = self.tokenizer.encode(other, is_pretokenized=True, add_special_tokens=False)
            self._add(other, np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(other)))
        if parted:
            at = np.array([self.known[x] for pair in parted.values() for x in pair])
            self._add(list(parted), self.joined(at), (self.bounds[at + 1] - self.bounds[at]).reshape(-1, 2).sum(1))

    def joined(self, at: np.ndarray) -> np.ndarray:
        """The ids of known words, one after the other."""
        sizes = self.bounds[at + 1] - self.bounds[at]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.bounds[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def places(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self.learn({words[i] for i in missing})
            at[missing] = [self.known[words[i]] for i in missing]
        self.uses[: len(self.known)] += np.bincount(at, minlength=len(self.known)).astype(np.uint32)
        return at

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text and the end id."""
        if self.held > CACHE_BYTES:
            self.shrink()
        low = [text.lower() for text in texts]
        plain = [
            not _ODD.search(a) and "<|" not in b and unicodedata.is_normalized("NFC", a) and unicodedata.is_normalized("NFC", b)
            for a, b in zip(texts, low, strict=True)
        ]
        split = [b.split() if fine else [] for b, fine in zip(low, plain, strict=True)]
        at = self.places([w for words in split for w in words])
        out, done = [], 0
        for text, words, fine in zip(texts, split, plain, strict=True):
            if fine:
                ids = self.joined(at[done : done + len(words)])
            else:
                ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            done += len(words)
            out.append(np.append(ids, np.uint32(END)))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One tokenizer per Python worker; a task empties the table of words when it ends."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tier_of(length: int) -> int:
    """The shortest tier that holds a rest of this length."""
    tier = SHORTEST_TIER
    while tier < length:
        tier *= 2
    return tier


def pack(lengths: list[int], longest: int = LONGEST) -> list[tuple[int, list[Piece]]]:
    """Windows as (tier, pieces) for documents of these lengths; each token lies in exactly one piece.

    All windows but those of the final split are full. The final split is one
    window per set bit of what is left.
    """
    windows: list[tuple[int, list[Piece]]] = []
    rests: dict[int, list[Piece]] = defaultdict(list)
    for d, n in enumerate(lengths):
        full = n // longest
        windows += [(longest, [(d, i * longest, longest)]) for i in range(full)]
        if n % longest:
            rests[tier_of(n % longest)].append((d, full * longest, n % longest))
    tiers = sorted(rests, reverse=True)
    open_windows: list[tuple[int, int, list[Piece]]] = []
    for tier in tiers:
        # best fit: gaps in ascending order, the first one that is large enough
        gaps: list[tuple[int, int]] = []
        made: list[list[Piece]] = []
        for piece in sorted(rests[tier], key=lambda p: (-p[2], p[0])):
            at = bisect_left(gaps, (piece[2], -1))
            if at < len(gaps):
                gap, w = gaps.pop(at)
            else:
                gap, w = tier, len(made)
                made.append([])
            made[w].append(piece)
            if gap > piece[2]:
                insort(gaps, (gap - piece[2], w))
        left = dict((w, gap) for gap, w in gaps)
        open_windows += [(tier, left[w], made[w]) for w in sorted(left, key=lambda w: left[w])]
        windows += [(tier, made[w]) for w in range(len(made)) if w not in left]
    # gaps of the longest windows are filled from the windows of the shortest tiers, emptiest first
    ahead, behind = 0, len(open_windows) - 1
    spare: list[Piece] = []
    while ahead <= behind:
        tier, gap, pieces = open_windows[ahead]
        while gap and (spare or behind > ahead):
            if not spare:
                spare = open_windows[behind][2][::-1]
                behind -= 1
            d, start, length = spare.pop()
            take = min(gap, length)
            pieces.append((d, start, take))
            gap -= take
            if take < length:
                spare.append((d, start + take, length - take))
        ahead += 1
        if gap:
            spare = pieces[::-1]  # the last one
        else:
            windows.append((tier, pieces))
    total = sum(p[2] for p in spare)
    for bit in range(total.bit_length() - 1, -1, -1):
        if total >> bit & 1:
            room, pieces = 1 << bit, []
            while room:
                d, start, length = spare.pop()
                take = min(room, length)
                pieces.append((d, start, take))
                room -= take
                if take < length:
                    spare.append((d, start + take, length - take))
            windows.append((1 << bit, pieces))
    return windows


def step_groups(windows: list[tuple[int, list[Piece]]]) -> list[int]:
    """A group for each window: groups hold windows of one tier, as many in each as can be."""
    of_tier: dict[int, list[int]] = defaultdict(list)
    for i, (tier, _) in enumerate(windows):
        of_tier[tier].append(i)
    out, first = [0] * len(windows), 0
    for tier in sorted(of_tier, reverse=True):
        members = of_tier[tier]
        groups = -(-len(members) // STEP_WINDOWS)
        for place, i in enumerate(members):
            out[i] = first + place % groups
        first += groups
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per piece of the packed windows of all ``docs``.

    A null or empty text is the end id alone. Each task packs the rows of its own
    partition in runs of a bounded number of tokens, so nothing is shuffled;
    sequence_id and step_group hold the partition in their high bits. An empty
    table gives no rows; repeated ids are documents of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = encoder(tokenizer_path)
        high = TaskContext.get().partitionId() << 33
        sequence = group = high
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0
        try:
            for batch in batches:
                for part in slices(batch, "text"):
                    ids += part["doc_id"].to_pylist()
                    new = words.encode([x or "" for x in part["text"].to_pylist()])
                    tokens += new
                    held += sum(map(len, new))
                    if held >= RUN_TOKENS:
                        out, sequence, group = rows(ids, tokens, sequence, group)
                        yield out
                        ids, tokens, held = [], [], 0
            if ids:
                yield rows(ids, tokens, sequence, group)[0]
        finally:
            words.clear()

    def rows(ids: list, tokens: list[np.ndarray], sequence: int, group: int) -> tuple[pa.RecordBatch, int, int]:
        windows = pack([len(x) for x in tokens])
        groups = step_groups(windows)
        out: list[tuple] = []
        raw = [x.astype("<u4", copy=False).view(np.uint8) for x in tokens]
        for w, (tier, pieces) in enumerate(windows):
            offset = 0
            for d, start, length in pieces:
                crc = zlib.crc32(raw[d][4 * start : 4 * (start + length)])
                out.append((ids[d], start, length, crc, len(tokens[d]), sequence + w, offset, tier, group + groups[w]))
                offset += length
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)]
        return pa.RecordBatch.from_arrays(columns, _NAMES), sequence + len(windows), group + max(groups) + 1

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, PIECES)


_NAMES = re.findall(r"(\w+) (?:long|int)", PIECES)
_TYPES = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
