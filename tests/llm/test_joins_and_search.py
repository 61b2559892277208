"""Top-k, decontamination, near duplicates, components, packing and the pipeline against brute force."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from replygauge.llm import arrays, bit_sliced, decontaminate, jaccard, packing
from replygauge.llm import components as components_module
from replygauge.llm.components import components
from replygauge.llm.queries import QUERIES, tokenizer_path
from replygauge.sources.tables import table

FOLDER = "/root/testdata/sf0.001"

# -- hashing ----------------------------------------------------------------


def test_word_hashes_depend_on_the_word_alone():
    texts = ["One two  one", None, "", " two\tONE\n", "é two"]
    found, bounds = arrays.words(pa.array(texts))
    lists = [found[a:b].tolist() for a, b in itertools.pairwise(bounds)]
    one, two = lists[0][:2]
    assert lists[0] == [one, two, one] and lists[1] == lists[2] == [] and lists[3] == [two, one] and lists[4][1] == two
    batch = pa.RecordBatch.from_arrays([pa.array(texts * 3)], ["t"])
    assert sum(p.num_rows for p in arrays.slices(batch.slice(2), "t", 5)) == 13
    sliced = pa.array(["xx", "One two  one", "y"]).slice(1, 1)
    assert arrays.words(sliced)[0].tolist() == lists[0]


# -- top-k ------------------------------------------------------------------


def plain_topk(rows, k, every):
    """From the contract: every row but the query's own is a candidate, rows that repeat an id too."""
    fine = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (i, q) in enumerate(fine):
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for n, (j, c) in enumerate(fine) if n != at and len(c) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 3, 20])
def test_topk_equals_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(bit_sliced, "BLOCK_ROWS", 64)
    r = random.Random(k)
    rows = [(i, [r.choice([-1.0, -0.02, 0.0, 0.5, r.uniform(-3, 3)]) for _ in range(5)]) for i in range(300)]
    rows += [(1000 + i, [0.25] * 5) for i in range(70)]  # ties
    rows += [(2000, None), (2001, []), (2002, [0.1, None, 0.2, 0.3, 0.1]), (2003, [float("nan")] * 5), (2004, [float("inf")] * 5), (None, [0.1] * 5)]
    rows += [(0, [0.1] * 5), (0, [0.1] * 5), (1, [2.5] * 5), (2020, [1.0, 2.0]), (2021, [3.0, 1.0]), (2040, [0.0] * 5)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(map(tuple, bit_sliced.bit_sliced_topk(frame, 20, k).collect()))
    as_float = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == plain_topk(as_float, k, 20)


def test_topk_of_large_components(spark, monkeypatch):
    monkeypatch.setattr(bit_sliced, "BLOCK_ROWS", 8)
    r = random.Random(5)
    sizes = [1.0, 1.5e6, 3e7, 2e7]
    rows = [(i, [r.choice(sizes) * r.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, bit_sliced.bit_sliced_topk(frame, 20, 5).collect())) == plain_topk(rows, 5, 20)


def test_topk_ranks_scores_beyond_a_long(spark):
    rows = [(20, [2.0**44, 2.0**44]), (1, [2.0**44, 1.0]), (2, [2.0**44, 3.0]), (3, [2.0**43, 2.0**43]), (4, [-(2.0**44), 0.0]), (5, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = bit_sliced.bit_sliced_topk(frame, 20, 20).orderBy("rank").collect()
    top = (1 << 63) - 1
    assert [(r.vec_id, r.score) for r in got] == [(2, top), (1, top), (3, top), (5, 1 << 56), (4, -top)]


def test_topk_parts_of_queries_meet_every_block(spark, monkeypatch):
    monkeypatch.setattr(bit_sliced, "BLOCK_ROWS", 32)
    monkeypatch.setattr(bit_sliced, "PART_COMPONENTS", 8)
    r = random.Random(6)
    rows = [(i % 150, [r.uniform(-1, 1) for _ in range(4)]) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, bit_sliced.bit_sliced_topk(frame, 5, 7).collect())) == plain_topk(rows, 7, 5)


def test_topk_of_few_rows(spark):
    assert bit_sliced.bit_sliced_topk(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert bit_sliced.bit_sliced_topk(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")).count() == 0


# -- decontamination --------------------------------------------------------


def stated_overlaps(docs, items, least=10):
    """From the definition: any stretch that agrees in more than four of five words and has enough agreeing ones, or four fifths of a short item."""
    word = re.compile(r"[^\W_]+")
    out = {}
    for (d, x), (i, y) in itertools.product(docs, items):
        a, b = word.findall((x or "").lower()), word.findall((y or "").lower())
        whole = -(-4 * len(b) // 5) <= least
        enough = -(-4 * len(b) // 5) if whole else least
        for shift in range(-len(b) + 1, len(a) if b else 0):
            same = [b[j] == a[j + shift] for j in range(max(0, -shift), min(len(b), len(a) - shift))]
            if sum(same) < enough:
                continue
            for at, to in [(0, len(same))] if whole else itertools.combinations(range(len(same) + 1), 2):
                agreeing = sum(same[at:to])
                if agreeing >= enough and (whole or 5 * agreeing > 4 * (to - at)):
                    out[d, i] = max(out.get((d, i), 0), agreeing)
    return out


def test_masks_hit_every_overlap_of_11_words_with_two_substitutions():
    for subs in itertools.combinations(range(11), 2):
        assert any(
            all(c == "0" or at + i not in subs for i, c in enumerate(m)) for m in decontaminate.MASKS for at in range(12 - len(m))
        ), subs


def test_decontamination_equals_brute_force(spark):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(7, 40)))) for i in range(15)] + [(90, None), (91, ""), (92, "a b")]
    docs = []
    for d in range(60):
        text = r.choices(vocabulary, k=r.randint(0, 60))
        if d % 2:
            passage = items[d % 15][1].split()
            for _ in range(d % 4):
                passage[r.randrange(len(passage))] = "other"
            at = r.randint(0, len(text))
            text = text[:at] + passage[: r.randint(8, 40)] + text[at:]
        docs.append((d, " ".join(text).capitalize().replace(" w1", ", W1")))
    docs += [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1]), (102, "nothing here"), (None, items[1][1])]
    frame = spark.createDataFrame([(d, t, "k") for d, t in docs], "doc_id long, text string, shift string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    found = {(x.doc_id, x.item_id): x.n_matched for x in decontaminate.overlaps(frame, bench).collect()}
    assert found == stated_overlaps(docs, items)
    kept = decontaminate.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    long_items = [(i, t) for i, t in items if len((t or "").split()) >= decontaminate.LEAST_ITEM]
    clean = [d for d, t in docs if not stated_overlaps([(d, t)], long_items)]
    assert Counter(x.doc_id for x in kept.collect()) == Counter(clean) and {100, 101, 102} <= set(clean)
    assert decontaminate.overlaps(frame.limit(0), bench).count() == decontaminate.overlaps(frame, bench.limit(0)).count() == 0


def test_short_items_delete_no_clean_documents(spark):
    docs = spark.createDataFrame([(1, "Yes it is the one"), (2, "the other"), (3, "none"), (4, "a b c d e f g h i"), (None, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "Yes"), (2, "the"), (3, "b c d e f g h i")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.overlaps(docs, bench).collect()} == {(1, 1), (1, 2), (2, 2), (4, 3)}
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).orderBy("doc_id").collect()] == [None, 1, 2, 3]
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench, least_item=1).orderBy("doc_id").collect()] == [None, 3]


def test_masks_hit_every_stretch_of_ten_agreeing_words():
    for size in range(10, 24):  # a longer one holds one of these
        for wrong in range(min(size - 10, (size - 1) // 5) + 1):
            for subs in itertools.combinations(range(size), wrong):
                assert any(
                    all(c == "0" or at + i not in subs for i, c in enumerate(m)) for m in decontaminate.MASKS for at in range(size - len(m) + 1)
                ), (size, subs)


def test_decontamination_finds_any_stretch(spark):
    # places that differ, over the first words of an item of 30
    told = {0: (12, [4], 11), 1: (12, [7], 11), 2: (14, [4], 13), 3: (16, [4, 9], 14), 4: (20, [4, 9, 14], 17), 5: (28, [*range(9, 15), 20], 12), 6: (15, [4, 9, 12], 10), 7: (13, [2, 5, 8], 0)}
    items, docs = [], []
    for i, (size, places, _) in told.items():
        words = [f"i{i}x{j}" for j in range(30)]
        items.append((i, " ".join(words)))
        docs.append((i, " ".join(["before"] + ["other" if j in places else w for j, w in enumerate(words[:size])] + ["after"])))
    r = random.Random(5)
    for d in range(100, 160):
        words = r.choice(items)[1].split()
        share = r.choice([0.1, 0.2, 0.25])
        docs.append((d, " ".join(w if r.random() > share else "other" for w in words[r.randint(0, 9) : r.randint(12, 30)])))
    got = {(x.doc_id, x.item_id): x.n_matched for x in decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == stated_overlaps(docs, items)
    assert {i: got.get((i, i), 0) for i in told} == {i: n for i, (_, _, n) in told.items()}


@pytest.mark.parametrize("least", [10, 4])
def test_decontamination_finds_short_items(spark, least):
    items = [(n, " ".join(f"s{n}x{j}" for j in range(n))) for n in range(1, 15)]
    docs = []
    for n, text in items:
        # verbatim, every set of substitutions that is allowed, one more, and cut at either end
        for wrong in range(n - -(-4 * n // 5) + 2):
            for places in itertools.combinations(range(n), wrong):
                docs.append(" ".join(["before"] + ["other" if j in places else w for j, w in enumerate(text.split())] + ["after"]))
        docs += [" ".join(text.split()[1:]), " ".join(text.split()[:-2])]
    docs = list(enumerate(docs))
    found = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), least)
    got = {(x.doc_id, x.item_id): x.n_matched for x in found.collect()}
    assert got == stated_overlaps(docs, items, least) and {i for _, i in got} == set(range(1, 15))


def test_decontamination_plan_is_native(spark):
    docs = table(spark, FOLDER, "documents")
    items = table(spark, FOLDER, "benchmark").select("item_id", decontaminate.word_hashes("text").alias("item_words"))
    plan = decontaminate.candidates(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


# -- near duplicates --------------------------------------------------------


def plain_classes(docs, n, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets.append((d, frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return Counter((d, len(s), find(d) if d is not None else None) for d, s in sets)


def fixture_docs():
    r = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    shared = r.choices(vocabulary, k=55)
    docs, d = [], 0
    for group in range(14):
        base = r.choices(vocabulary, k=r.choice([5, 30, 80, 200]))
        if group % 2:
            base = base[:10] + shared + base[10:]
        for copy in range(r.choice([1, 2, 12, 40])):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                text[r.randrange(len(text))] = r.choice(vocabulary)
            docs.append((d, " ".join(text).upper() if copy % 5 == 4 else "  ".join(text)))
            d += 1
    r.shuffle(docs)
    docs += [(900, None), (901, ""), (902, " \n\t"), (903, "a"), (904, "A"), (905, "a b c"), (906, "a  b c"), (907, "a b c d"), (None, "a b c"), (906, "a  b c"),
             (908, docs[0][1]), (908, docs[50][1]), (909, " ".join(["the"] * 5000)), (910, " ".join(["The"] * 4000))]
    return docs


@pytest.mark.parametrize("n, percent, block", [(4, 85, 2000), (5, 80, 8)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    docs = fixture_docs()
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, key string, size int")
    got = Counter(tuple(x) for x in jaccard.similar_classes(frame, n, percent).collect())
    assert got == plain_classes(docs, n, percent)


def test_near_duplicates_of_nothing(spark):
    assert jaccard.similar_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_finds_every_point_within_the_bound():
    rng = np.random.default_rng(3)
    points = rng.poisson(2, (500, jaccard.GROUPS))
    points[100:200] = points[7] + rng.integers(0, 2, (100, jaccard.GROUPS)) * (rng.random((100, jaccard.GROUPS)) < 0.1)
    sizes = points.sum(axis=1)
    tree = jaccard.Tree(points, sizes)
    for i in range(0, 500, 7):
        bound = np.minimum(points, points[i]).sum(axis=1)
        fits = (100 * np.minimum(sizes, sizes[i]) >= 85 * np.maximum(sizes, sizes[i])) & (bound >= jaccard.needed(sizes[i], sizes, 85))
        assert set(tree.search(points[i], int(sizes[i]), 85)) == set(np.flatnonzero(fits))


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 60)], [(5, 9), (9, 5), (9, 2), (7, 8)]])
def test_components(spark, links):
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for p in links for x in p if p[0] != p[1]}
    for _ in root:
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_large_work_tables_of_the_join_go_when_they_are_used_up(spark, monkeypatch):
    made = {}
    for module in (jaccard, components_module):
        plain = module.written
        monkeypatch.setattr(module, "written", lambda df, purpose, plain=plain: made.setdefault(purpose, []).append(table := plain(df, purpose)) or table)
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text + " more"), (4, "another text of six words"), (5, None)], "doc_id long, text string")
    rows = jaccard.similar_classes(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == [(1, 57, 1), (2, 57, 1), (3, 58, 1), (4, 2, 4), (5, 0, 5)]
    held = [purpose for purpose, tables in made.items() for t in tables if Path(t.written_to.removeprefix("file:")).exists()]
    assert not {"shingle-sets", "sets", "vectors", "pairs", "concerned", "pair-sets"} & set(held) and "pair-sets" in made


def test_pairs_are_verified_on_texts_not_on_sets_that_take_more_room(spark, monkeypatch):
    plain, made = jaccard.written, []
    monkeypatch.setattr(jaccard, "written", lambda df, purpose: made.append((purpose, df.columns)) or plain(df, purpose))
    text = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(1, text), (2, text + " more"), (3, text[:90]), (4, None), (1, "of two texts, one alike")], "doc_id long, text string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 4)], "a long, b long")
    assert [tuple(x) for x in jaccard.verified(pairs, rows, 4, 85).collect()] == [(1, 2)]
    assert ("pair-sets", ["id", "text"]) in made


@pytest.mark.parametrize("map_words", [1, 1 << 18])
def test_only_sets_that_may_have_equals_are_joined(spark, monkeypatch, map_words):
    monkeypatch.setattr(jaccard, "MAP_WORDS", map_words)
    r = random.Random(8)
    rows = [(i, r.choice([3, 4]), r.choice([-1, 1]) * r.randrange(1 << 62), r.randrange(9)) for i in range(300)]
    rows += [(1000 + i, *r.choice(rows)[1:]) for i in range(40)]
    sets = spark.createDataFrame(rows, "doc_id long, size int, one long, two long")
    same = ["size", "one", "two"]
    repeated = sets.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n")
    got = Counter(tuple(x) for x in jaccard.with_representative(sets, repeated, same).select("doc_id", *same, "rep").collect())
    members = defaultdict(list)
    for d, *key in rows:
        members[tuple(key)].append(d)
    assert got == Counter((d, *key, min(ds) if len(ds) > 1 else None) for key, ds in members.items() for d in ds)
    joined = []
    plain = type(sets).join
    monkeypatch.setattr(type(sets), "join", lambda self, other, *a: joined.append((self, other)) or plain(self, other, *a))
    jaccard.with_representative(sets, repeated, same)
    few, = (a.count() for a, b in joined if b is repeated)
    assert few < 100 or map_words == 1


def test_counts_of_a_vector_take_one_byte_unless_they_need_two():
    for vector in ([3, 0, 255, 7], [3, 0, 256, 65535], [0, 0]):
        found = jaccard.packed(np.array(vector, "<u2"))
        assert len(found) == 1 + len(vector) * (1 if max(vector) < 256 else 2)
        assert jaccard.unpacked(pa.scalar(found, pa.binary())).tolist() == vector


# -- packing ----------------------------------------------------------------


def check_packing(rows, texts):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for d, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for found in windows.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        total += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding <= 0.01 * total
    sizes = Counter((r.step_group, r.sequence_id) for r in rows)
    groups = Counter(g for g, _ in sizes)
    assert max(groups.values(), default=0) <= packing.STEP_WINDOWS


def test_packing_query_is_an_exact_cover(spark):
    texts = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    check_packing(QUERIES["op8_hierarchical_packing"](spark, FOLDER).collect(), texts)


def test_packing_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(packing, "RUN_TOKENS", 500)
    texts = {1: None, 2: "", 3: "word " * 30_000, 4: "\x1cé́ <|endoftext|> ΣΑΣ", 5: "don't, stop!! 123 ***x y.", 6: " "}
    docs = spark.createDataFrame([(d, t, 0, 0) for d, t in texts.items()], "doc_id long, text string, start int, tier int")
    check_packing(packing.pack_documents(docs, tokenizer_path()).collect(), texts)
    twice = packing.pack_documents(docs.where("doc_id = 5").union(docs.where("doc_id = 5")), tokenizer_path())
    assert twice.agg(F.sum("length")).first()[0] == 2 * twice.first().doc_tokens
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_frequent_words_are_encoded_once_though_the_table_is_full(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 20_000)
    words, learned = packing.Encoder(tokenizer_path()), []
    learn = words.learn
    monkeypatch.setattr(words, "learn", lambda new: (learned.extend(new), learn(new)))
    odd = "été don't l'été, ſtraße ǆ ªº ﬁ a1 x_y (a) %%% 1a ß ẞ naïve,%%% жук"
    for k in range(20):
        text = f"the the cat, cat, {odd} " + " ".join(f"w{chr(97 + k)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
        assert words.encode([text])[0].tolist() == [*words.tokenizer.encode(text, add_special_tokens=False).ids, packing.END]
        assert words.held < 60_000
    assert learned.count("the") == learned.count("cat,") == 1 and len(learned) > 1200


def test_packing_of_lengths_leaves_no_token_out():
    r = random.Random(5)
    for _ in range(30):
        lengths = [r.choice([1, 3, 511, 512, 513, 2000, 4096, 9000, r.randint(1, 5000)]) for _ in range(r.randint(0, 60))]
        covered = defaultdict(list)
        for tier, pieces in packing.pack(lengths):
            assert tier <= 4096 and tier & (tier - 1) == 0 and sum(p[2] for p in pieces) == tier
            for d, start, length in pieces:
                covered[d].append((start, length))
        for d, n in enumerate(lengths):
            at = 0
            for start, length in sorted(covered[d]):
                assert start == at and length > 0
                at += length
            assert at == n


# -- pipeline ---------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    rows = docs.collect()
    extra = [(10_001, rows[0].text, "en", "s", 1), (10_002, None, "en", "s", 1), (10_003, "12 !!", None, "s", 1)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema)).withColumn("score", F.lit("clash"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language_id", "near_duplicates", "decontamination", "personal_data", "packing"]

    known = stage["language_id"](spark, docs, FOLDER)
    assert known.columns == docs.columns and {r.doc_id for r in known.collect()} >= set(texts) - {10_002, 10_003} - {
        d for d, t in texts.items() if t and len(t.split()) < 20}
    assert not {10_002, 10_003} & {r.doc_id for r in known.collect()}

    classes = plain_classes(list(texts.items()), 5, 80)
    once = stage["near_duplicates"](spark, docs, FOLDER)
    assert once.columns == docs.columns
    assert sorted(r.doc_id for r in once.collect()) == sorted(d for d, _, c in classes if d == c)

    clean = stage["decontamination"](spark, docs, FOLDER)
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    bad = {d for d, _ in stated_overlaps([(d, t) for d, t in texts.items() if len(t or "") < 1500], items)}
    short = {d for d, t in texts.items() if len(t or "") < 1500}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} & short == short - bad

    masked = stage["personal_data"](spark, docs, FOLDER)
    assert masked.columns == docs.columns and masked.count() == len(texts)
    assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text or "") for r in masked.collect())


def test_pipeline_end_to_end(spark):
    assert QUERIES and corpus_pipeline.run(spark, FOLDER).columns[0] == "doc_id"
