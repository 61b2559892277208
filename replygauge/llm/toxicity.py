"""Toxicity by a lexicon that forgives misspellings, weighed by the words around each hit.

A trie of harmful words and word stems is intersected with Levenshtein automata
into one finite automaton that accepts every word within the allowed distance of
an entry. All words of a slice of text run through its table side by side, one
character at a time, and leave as soon as no entry can be reached. A hit inside
quotation marks or beside a verb of reporting counts as a quotation; the score
weighs quoted and direct hits apart.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replygauge.llm.arrays import slices
from replygauge.llm.common import bounded_sample, remainder, remainder_of, written

STEM_LENGTHS = (4, 5, 6, 7, 8)
#: Least log-likelihood ratio of an entry: about one chance in a million.
SURPRISE = 24.0
#: Words to the left and right that are searched for signs of quotation.
WINDOW = 6
#: Quotation marks, and verbs of reporting in four languages (fixed values).
QUOTES = "\"“”„«»‹›"
REPORTING = frozenset(
    "said says called quoted quote wrote reported described sagte sagt nannte schrieb zitierte "
    "dit disait appelle dijo dice escribió llamó citó".split()
)

_ALNUM = np.zeros(0x110000, bool)
for _plane in range(0, 0x30000, 0x1000):
    _ALNUM[_plane : _plane + 0x1000] = [chr(c).isalnum() for c in range(_plane, _plane + 0x1000)]


def allowed(entry: str) -> int:
    """Edits that still count as the entry (swapped neighbours count as one): none below four letters."""
    return int(len(entry) >= 4)


@dataclass
class Automaton:
    """Table of the trie met with Levenshtein automata; state 0 is dead, state 1 the start."""

    alphabet: dict[str, int]
    table: np.ndarray
    word_hit: np.ndarray
    stem_hit: np.ndarray
    entries: list[tuple[str, bool]] = field(default_factory=list)

    @classmethod
    def build(cls, entries: list[tuple[str, bool]]) -> Automaton:
        """entries: (text, whether any word that begins with it counts). Hits are 2 * entry + (distance > 0)."""
        children: list[dict[str, int]] = [{}]
        ends: list[list[int]] = [[]]
        for number, (text, _) in enumerate(entries):
            node = 0
            for letter in text:
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                    ends.append([])
                node = children[node][letter]
            ends[node].append(number)
        most = [0] * len(children)
        for node in range(len(children) - 1, -1, -1):
            most[node] = max([*(allowed(entries[e][0]) for e in ends[node]), *(most[c] for c in children[node].values())], default=0)
        letters = sorted({x for c in children for x in c})
        alphabet = {x: i + 1 for i, x in enumerate(letters)}  # 0: any other character

        def close(items: set) -> frozenset:
            """Add what deletions reach; keep the fewest edits of each place."""
            least: dict[tuple, int] = {}
            todo = list(items)
            while todo:
                node, edits, due = todo.pop()
                if edits > most[node] or least.get((node, due), 9) <= edits:
                    continue
                least[node, due] = edits
                if due is None:
                    todo += [(c, edits + 1, None) for c in children[node].values()]
            return frozenset((node, e, due) for (node, due), e in least.items())

        def step(state: frozenset, letter: str | None) -> frozenset:
            out = set()
            for node, e, due in state:
                if due is not None:  # the second letter of a swapped pair is due
                    if due == letter:
                        out.add((node, e, None))
                    continue
                out.add((node, e + 1, None))
                for x, c in children[node].items():
                    out.add((c, e if x == letter else e + 1, None))
                    if x != letter and letter in children[c]:
                        out.add((children[c][letter], e + 1, x))
            return close(out)

        def hits(state: frozenset, stems: bool) -> int:
            best = None
            for node, e, due in state:
                for number in ends[node] if due is None else ():
                    if entries[number][1] == stems and e <= allowed(entries[number][0]):
                        rank = (e, -len(entries[number][0]), number)
                        best = rank if best is None or rank < best else best
            return -1 if best is None else 2 * best[2] + (best[0] > 0)

        start = close({(0, 0, None)})
        number = {frozenset(): 0, start: 1}
        order, rows = [frozenset(), start], [[0] * (len(letters) + 1)]
        at = 1
        while at < len(order):
            row = []
            for letter in [None, *letters]:
                to = step(order[at], letter)
                if to not in number:
                    number[to] = len(order)
                    order.append(to)
                row.append(number[to])
            rows.append(row)
            at += 1
        return cls(alphabet, np.array(rows, np.int32), np.array([hits(s, False) for s in order]),
                   np.array([hits(s, True) for s in order]), list(entries))

    def lookup(self) -> np.ndarray:
        classes = np.zeros(0x110000, np.uint8)
        for letter, c in self.alphabet.items():
            classes[ord(letter)] = c
        return classes

    def match(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The hit of each word, or -1: an exact one before one with edits, a whole word before a stem."""
        found = np.full(len(starts), -1, np.int64)
        where, at = np.arange(len(starts)), starts.copy()
        state = np.ones(len(starts), np.int32)
        while len(where):
            state = self.table[state, classes[codes[at]]]
            at = at + 1
            stem = self.stem_hit[state]
            better = (stem >= 0) & ((found[where] < 0) | (stem % 2 < found[where] % 2))
            found[where[better]] = stem[better]
            done = (at == ends[where]) | (state == 0)
            last = where[done]
            whole = np.where(at[done] == ends[last], self.word_hit[state[done]], -1)
            better = (whole >= 0) & ((found[last] < 0) | (whole % 2 <= found[last] % 2))
            found[last[better]] = whole[better]
            where, at, state = where[~done], at[~done], state[~done]
        return found


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, str]:
    """Lower-case code points of all texts, starts and ends of their words, bounds in words, and the joined text."""
    joined = "\n".join((x or "") for x in texts.to_pylist()).lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = _ALNUM[codes]
    edge = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sizes = np.array([len((x or "").lower()) + 1 for x in texts.to_pylist()], np.int64)
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    return codes, starts, ends, bounds, joined


def quoted(joined: str, starts: np.ndarray, ends: np.ndarray, word: int, low: int, high: int) -> bool:
    """Whether the words around a hit show that it is quoted. low and high: the words of its text."""
    first, last = max(low, word - WINDOW), min(high, word + WINDOW + 1) - 1
    before, after = joined[starts[first] : starts[word]], joined[ends[word] : ends[last]]
    if re.search(f"[{QUOTES}]", before) and re.search(f"[{QUOTES}]", after):
        return True
    return any(joined[starts[i] : ends[i]] in REPORTING for i in range(first, last + 1) if i != word)


@dataclass
class Model:
    automaton: Automaton
    #: Log-odds of a text with a hit of each kind.
    weights: np.ndarray
    #: Of direct hits, quoted hits, and the constant.
    direct: float = 1.0
    quote: float = 0.25
    bias: float = -2.0

    def evidence(self, texts: pa.Array, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, bool]]]:
        """Per text the weight of its direct and of its quoted hits (each kind once); all hits as (text, kind, quoted)."""
        codes, starts, ends, bounds, joined = words_of(texts)
        found = self.automaton.match(codes, starts, ends, classes) if len(starts) else np.zeros(0, np.int64)
        hits: dict[tuple[int, int], bool] = {}
        for word in np.flatnonzero(found >= 0).tolist():
            text = int(np.searchsorted(bounds, word, "right")) - 1
            kind = int(found[word])
            if hits.get((text, kind), True):
                hits[text, kind] = quoted(joined, starts, ends, word, int(bounds[text]), int(bounds[text + 1]))
        sums = np.zeros((2, len(texts)))
        for (text, kind), q in hits.items():
            sums[int(q), text] += self.weights[kind]
        return sums[0], sums[1], [(text, kind, q) for (text, kind), q in hits.items()]

    def scores(self, direct: np.ndarray, quote: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.direct * direct + self.quote * quote, -30, 30)))


def lexicon(sample: DataFrame, text: str, label: str, most: int) -> list[tuple[str, bool]]:
    """Words and stems that labelled harmful texts have and others lack, the most telling first."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"[\p{L}\p{N}]{4,}"), F.lit(0)))
    rows = sample.select(F.col(label).cast("int").alias("y"), words.alias("w"))
    stems = F.flatten(F.array(*[
        F.transform(F.filter("w", lambda x, n=n: F.length(x) >= n), lambda x, n=n: F.struct(F.substring(x, 1, n).alias("e"), F.lit(True).alias("stem")))
        for n in STEM_LENGTHS
    ]))
    entries = F.array_distinct(F.concat(F.transform("w", lambda x: F.struct(x.alias("e"), F.lit(False).alias("stem"))), stems))
    totals = rows.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    bad, good = int(totals[0] or 0), int(totals[1] or 0)
    if not bad:
        return []
    share = bad / (bad + good)
    n, b = F.col("bad") + F.col("good"), F.col("bad").cast("double")
    # twice the log-likelihood ratio against an entry that is as frequent in both classes
    surprise = 2 * (b * F.log(b / (n * share)) + F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (n * (1 - share)))).otherwise(0.0))
    counts = (
        rows.select("y", F.explode(entries).alias("x")).groupBy("x.e", "x.stem")
        .agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
        .where((F.col("bad") * max(good, 1) > 6 * F.col("good") * bad) & (surprise > SURPRISE))
    )
    best = counts.orderBy(F.desc(surprise), "e", "stem").limit(8 * most).collect()
    chosen: list[tuple[str, bool]] = []
    taken: dict[str, tuple[int, int]] = {}
    for r in best:
        # a stem or word that says no more than one already chosen is left out
        near = [taken[e] for e in (r.e[:n] for n in range(1, len(r.e) + 1)) if e in taken]
        if any(r.bad <= b * 1.2 for b, _ in near) or (r.stem and any(e.startswith(r.e) and r.bad <= 1.2 * b for e, (b, _) in taken.items())):
            continue
        chosen.append((r.e, r.stem))
        taken[r.e] = (r.bad, r.good)
        if len(chosen) == most:
            break
    return chosen


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 3000, entries: int = 120) -> Model:
    """Fit lexicon, weights and context on a bounded sample of labelled rows.

    ``per_class`` bounds the labelled texts of each class, ``entries`` the lexicon.
    Only rows whose crc32(doc_id) leaves a remainder other than 0 by 5 are used.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1))
        .groupBy("doc_id").agg(F.max("y").alias("y")).where(remainder("doc_id", 5) != 0)
    )
    # its size is bounded by per_class, so the texts need not be shuffled to meet it
    picked = F.broadcast(bounded_sample(known, "doc_id", "y", per_class))
    sample = written(docs.select("doc_id", "text").join(picked, "doc_id"), "toxicity-sample")
    found = lexicon(sample, "text", "y", entries)
    model = Model(Automaton.build(found), np.ones(2 * len(found)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value.automaton.lookup()
        for batch in batches:
            for part in slices(batch, "text"):
                own: dict[int, list] = defaultdict(list)
                for text, kind, q in shared.value.evidence(part["text"], classes)[2]:
                    own[text].append(2 * kind + q)
                yield pa.RecordBatch.from_arrays(
                    [part["y"].cast(pa.int32()), pa.array([own[i] for i in range(part.num_rows)], pa.list_(pa.int32()))], ["y", "hits"]
                )

    rows = sample.select("text", "y").mapInArrow(hits, "y int, hits array<int>").collect()
    y = np.array([r.y for r in rows])
    bad, good = max(int(y.sum()), 1), max(int((1 - y).sum()), 1)
    seen = np.zeros((2, 2 * len(found)))
    for r in rows:
        for kind in {h // 2 for h in r.hits}:
            seen[r.y, kind] += 1
    prior = np.tile([0.2, 1.0], len(found))
    model.weights = np.clip(np.log((seen[1] + prior) / (bad + 1)) - np.log((seen[0] + prior) / (good + 1)), 0, 9)
    for kind in range(1, len(model.weights), 2):
        most = 0.8 * model.weights[kind - 1]  # a misspelling says less than the word itself
        model.weights[kind] = min(most, model.weights[kind]) if seen[0, kind] else most
    x = np.zeros((len(rows), 3))
    x[:, 2] = 1
    for i, r in enumerate(rows):
        for h in r.hits:
            x[i, h % 2] += model.weights[h // 2]
    model.direct, model.quote, bias = _logistic(x, y, np.array([1.0, 0.25, -2.0]))
    share = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    # the classes were sampled at different rates
    model.bias = bias + math.log(share.get(1, 1) / share.get(0, 1)) - math.log(bad / good)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, rounds: int = 30) -> tuple[float, ...]:
    """Newton steps of a logistic regression drawn towards the prior."""
    b = prior.copy()
    for _ in range(rounds if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (y - p) - 4.0 * (b - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 4.0 * np.eye(len(b))
        b = b + np.clip(np.linalg.solve(curve, slope), -1, 1)
    return tuple(float(v) for v in b)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, terms (what was hit, as entry or entry~ for a misspelling).

    One row per row of ``docs``. A null or empty text has no hits and gets the score
    of none; a null id is never held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, held_out boolean, score double, predicted int, terms string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        classes = m.automaton.lookup()
        for batch in batches:
            for part in slices(batch, "text"):
                direct, quote, hits = m.evidence(part["text"], classes)
                score = m.scores(direct, quote)
                terms: list[list[str]] = [[] for _ in range(part.num_rows)]
                for text, kind, q in hits:
                    entry = m.automaton.entries[kind // 2]
                    terms[text].append(entry[0] + "*" * entry[1] + "~" * (kind % 2) + "\"" * q)
                ids = part["doc_id"].to_pylist()
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"].cast(pa.int64()), pa.array([i is not None and remainder_of(i, 5) == 0 for i in ids]),
                    pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array([" ".join(sorted(t)) for t in terms]),
                ], ["doc_id", "held_out", "score", "predicted", "terms"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
