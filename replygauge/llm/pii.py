"""Personal data: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The field labels words that hold a digit or an at sign; every other word is
outside by definition. A word that is outside for certain splits the chain
exactly, so only runs of such words are decoded, all runs of one length together
in numpy. It is trained on a small labelled table.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replygauge.llm.arrays import slices

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["O"] + [f"{b}-{k}" for k in KINDS for b in "BI"]
FEATURES = 1 << 12

Span = tuple[int, int, int]  # start, end, place in KINDS

# The local part of an address is looked for to the left of its at sign, so that long words cost no second look.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOTTED = re.compile(r"[0-9][0-9.]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[0-9@]\S*+")


def luhn(digits: str) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        d = ord(x) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and without overlap in each kind, by start and kind."""
    found: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done, 0))
        else:
            done = max(done, start)
        at = text.find("@", max(at + 1, done))
    for run in _DOTTED.finditer(text):
        if run.end() - run.start() >= 7 and text.count(".", run.start(), run.end()) >= 3:
            for m in _IP.finditer(text, run.start(), run.end()):
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                    found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
            found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


#: A small labelled table: [kind:words] marks what is personal (invented, none of it real).
LABELLED = """
call me at [phone:(212) 555-0134] after five
my number is [phone:(415) 555-0199] thanks
phone [phone:212-555-0171] or write
tel [phone:646.555.0182] any time
reach us: [phone:1-800-555-0143] on weekdays
fax [phone:(030) 5550 1234] for orders
ring [phone:020 7946 0958] and ask
mobile [phone:0171 5550123] bitte
appelez le [phone:01 55 50 12 34] demain
llame al [phone:91 555 01 23] hoy
number [phone:+44 20 7946 0123] office
dial [phone:+1 (303) 555-0112] now
write to [email:ann.lee@mail.example] please
mail [email:bob@localhost] about it
send it to [email:sales@shop] today
address [email:eva.roth@uni-post] and wait
contact [email:j.doe@example.org] soon
host [ip:10.0.0.7] is down
server [ip:192.168.1.20] answered
from [ip:172.16.5.4] port 8080
card [card:4111 1111 1111 1111] expires 12/27
paid with [card:5500-0000-0000-0004] yesterday
visa [card:4012888888881881] was charged
version 3.1.4 came out in 2019
section 4.2.1 of the guide
released under version 2.0. see 4.0. for more
in 1999 and 2004 we sold 1200 units
chapter 12 has 340 pages
order 4411 cost 19.99 in 2021
on 2023-05-17 at 10:45 we met
code a94f3be02c77 and key 9f8e7d6c5b4a
number 1234567890123456 is an order
id 9000123412341234 was shipped
ref 8412345678901234 closed
hash 2abc3ff2ca8fb1e4c565a0eb63815530
the 3 of 5 and 10 % of 250
call 3 of them at 9
phone 7 has 2 cameras
mail 20 letters in 1984
user @ 12 points
follow @news for more
score 3-2 and 21-19
page 100-120 of 400
room 12a on floor 3
9.8.7 is a version
port 443 and 8443
"""

_CUES = {w: k for k, words in {
    "phone": "call phone tel telephone number mobile cell ring dial fax reach sms whatsapp appelez llame tel. telefon",
    "email": "mail email e-mail write contact send address",
    "ip": "ip host server from address addr",
    "card": "card visa mastercard credit paid karte carte tarjeta",
}.items() for w in words.split()}


def _shape(word: str) -> str:
    """Classes of characters; runs of letters become one, runs of digits keep their length up to four."""
    s = re.sub(r"[A-Za-z]+", "a", re.sub(r"[^\x00-\x7f]+", "u", word))
    return re.sub(r"[0-9]+", lambda m: "9" * min(len(m[0]), 4) + ("+" if len(m[0]) > 4 else ""), s)[:40]


def features(word: str, before: str, after: str, joined: bool) -> list[int]:
    """Feature numbers of one word. before and after: its neighbours; joined: the word before is in the same run."""
    core = word.strip(".,;:!?\"'»«")
    digits = _DIGITS.sub("", core)
    groups = re.findall("[0-9]+", core)
    shape = _shape(core)
    named = [
        "bias", f"s={shape}", f"n={min(len(digits), 20)}", f"g={'-'.join(str(min(len(g), 9)) for g in groups[:5])}",
        f"l={len(digits) >= 13 and luhn(digits)}{'a' in shape}", f"at={'@' in core}{'.' in core.rpartition('@')[2]}",
        f"b={_CUES.get(before.lower().strip('.,:;!?'), _shape(before) if joined else '')}",
        f"b={_CUES.get(before.lower().strip('.,:;!?'), '')}&{shape}", f"j={joined}&{shape}",
        f"a={_shape(after) if re.search('[0-9@]', after) else ''}", f"p={core[:1] if not core[:1].isalnum() else ''}",
    ]
    return [zlib.crc32(x.encode()) % FEATURES for x in named]


@dataclass
class Field:
    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray

    def decode(self, runs: list[list[list[int]]]) -> list[np.ndarray]:
        """The best labels of each run of words; runs of one length go side by side."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(runs)
        by_length = defaultdict(list)
        for i, run in enumerate(runs):
            by_length[len(run)].append(i)
        for length, members in by_length.items():
            for at in range(0, len(members), 1024):
                part = members[at : at + 1024]
                scores = self.emit[np.array([runs[i] for i in part])].sum(2)
                best = scores[:, 0] + self.first
                back = np.zeros((length, len(part), len(LABELS)), np.int8)
                for t in range(1, length):
                    paths = best[:, :, None] + self.move
                    back[t] = paths.argmax(1)
                    best = paths.max(1) + scores[:, t]
                label = best.argmax(1)
                found = np.zeros((len(part), length), np.int64)
                for t in range(length - 1, -1, -1):
                    found[:, t] = label
                    label = back[t, np.arange(len(part)), label]
                for i, labels in zip(part, found, strict=True):
                    out[i] = labels
        return out


def words_with_digits(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring words that hold a digit or an at sign, as (start, end)."""
    runs: list[list[tuple[int, int]]] = []
    done = 0
    for m in _WORD.finditer(text):
        start = m.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        if runs and text[done:start].isspace() and start - done == 1 and "\n" not in text[done:start]:
            runs[-1].append((start, m.end()))
        else:
            runs.append([(start, m.end())])
        done = m.end()
    return runs


def run_features(text: str, run: list[tuple[int, int]]) -> list[list[int]]:
    left = text[max(0, run[0][0] - 40) : run[0][0]].split()
    right = text[run[-1][1] : run[-1][1] + 40].split()
    words = [left[-1] if left else "", *(text[a:b] for a, b in run), right[0] if right else ""]
    return [features(words[i], words[i - 1], words[i + 1], i > 1) for i in range(1, len(words) - 1)]


def train(table: str = LABELLED, rounds: int = 150, rate: float = 0.3, ridge: float = 0.01) -> Field:
    """Maximum likelihood by full-batch AdaGrad over the labelled table."""
    examples = []
    for line in table.strip().splitlines():
        text, marks = "", []
        for piece in re.split(r"(\[\w+:[^\]]*\])", line):
            m = re.fullmatch(r"\[(\w+):([^\]]*)\]", piece)
            if m:
                marks.append((len(text), len(text) + len(m[2]), KINDS.index(m[1])))
            text += m[2] if m else piece
        for run in words_with_digits(text):
            labels = []
            for a, b in run:
                hit = next(((s, k) for s, e, k in marks if s <= a and b <= e), None)
                labels.append(0 if hit is None else 1 + 2 * hit[1] + (a > hit[0]))
            examples.append((run_features(text, run), labels))
    size = len(LABELS)
    field = Field(np.zeros((FEATURES, size)), np.zeros((size, size)), np.zeros(size))
    seen = [np.full(x.shape, 1e-6) for x in (field.emit, field.move, field.first)]
    for _ in range(rounds):
        grads = [-ridge * x for x in (field.emit, field.move, field.first)]
        for found, labels in examples:
            _likelihood_gradient(field, found, labels, grads)
        for x, g, s in zip((field.emit, field.move, field.first), grads, seen, strict=True):
            s += g * g
            x += rate * g / np.sqrt(s)
    # an inside label follows only its own kind
    for k in range(len(KINDS)):
        bad = [i for i in range(size) if i not in (1 + 2 * k, 2 + 2 * k)]
        field.move[bad, 2 + 2 * k] = -1e6
        field.first[2 + 2 * k] = -1e6
    return field


def _likelihood_gradient(field: Field, found: list[list[int]], labels: list[int], grads: list[np.ndarray]) -> None:
    at = np.array(found)
    scores = field.emit[at].sum(1)
    n = len(labels)
    ahead = np.zeros_like(scores)
    ahead[0] = scores[0] + field.first
    for t in range(1, n):
        ahead[t] = _log_sum(ahead[t - 1][:, None] + field.move, 0) + scores[t]
    rest = np.zeros_like(scores)
    for t in range(n - 2, -1, -1):
        rest[t] = _log_sum(field.move + scores[t + 1] + rest[t + 1], 1)
    total = _log_sum(ahead[-1], 0)
    share = np.exp(ahead + rest - total)
    for t in range(n):
        delta = -share[t]
        delta[labels[t]] += 1
        np.add.at(grads[0], at[t], delta)
        if t:
            pair = np.exp(ahead[t - 1][:, None] + field.move + scores[t] + rest[t] - total)
            grads[1] -= pair
            grads[1][labels[t - 1], labels[t]] += 1
        else:
            grads[2] += delta


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def added_spans(field: Field, text: str, base: list[Span]) -> list[Span]:
    """Spans that the field finds clear of every base span, and that look like their kind."""
    runs = words_with_digits(text)
    if not runs:
        return []
    out = []
    for run, labels in zip(runs, field.decode([run_features(text, r) for r in runs]), strict=True):
        t = 0
        while t < len(run):
            if labels[t] == 0:
                t += 1
                continue
            kind, to = (int(labels[t]) - 1) // 2, t + 1
            while to < len(run) and labels[to] == 2 + 2 * kind:
                to += 1
            start, end = run[t][0], run[to - 1][1]
            while start < end and not (text[start].isalnum() or text[start] in "(+"):
                start += 1
            while end > start and not text[end - 1].isalnum():
                end -= 1
            if _plausible(text[start:end], kind):
                out.append((start, end, kind))
            t = to
    if base and out:
        starts = np.array([s for s, _, _ in base])
        reach = np.maximum.accumulate(np.array([e for _, e, _ in base]))
        before = np.searchsorted(starts, np.array([e for _, e, _ in out])) - 1
        out = [s for s, b in zip(out, before, strict=True) if b < 0 or reach[b] <= s[0]]
    return out


def _plausible(found: str, kind: int) -> bool:
    digits = _DIGITS.sub("", found)
    if kind == 0:
        return found.count("@") == 1 and not found.startswith("@") and not found.endswith("@")
    if kind == 1:
        return False  # a dotted address is a base span or none
    letters = any(c.isalpha() for c in found)
    if kind == 2:
        return not letters and 13 <= len(digits) <= 19 and luhn(digits)
    return not letters and 7 <= len(digits) <= 15 and len(digits) < len(found)


def find_spans(field: Field, texts: list[str]) -> Iterator[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    for text in texts:
        base = base_spans(text) if text else []
        yield base, added_spans(field, text, base) if text else []


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def find_pii(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, base counts n_*, base_sha256, spans, n_added.

    A null text counts as empty and has no span; offsets are code points.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc_id, (base, more) in zip(part["doc_id"].to_pylist(), find_spans(shared.value, [x or "" for x in part["text"].to_pylist()]), strict=True):
                    counts = np.bincount([k for _, _, k in base], minlength=4) if base else (0, 0, 0, 0)
                    rows.append((doc_id, *map(int, counts), hashlib.sha256(written_out(base).encode()).hexdigest(), written_out(base + more), len(more)))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, _NAMES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one mask of the first kind."""
    out, done = [], 0
    for a, b, k in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= done:
            out += [text[done:a], f"[{KINDS[k].upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def mask_pii(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """All rows and columns of ``docs``, with personal data in ``text`` masked; a null text stays null.

    A column ``n_chars`` is set to the code points of the new text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in slices(batch, "text"):
                old = part["text"].to_pylist()
                spans = find_spans(shared.value, [x or "" for x in old])
                new = [x if x is None else mask(x, base + more) for x, (base, more) in zip(old, spans, strict=True)]
                yield part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))

    masked = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
        masked = masked.withColumn("n_chars", changed)
    return masked


_NAMES = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
_TYPES = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64()]
