"""Language, quality and toxicity: training, scores, held-out accuracy, edge cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from replygauge.llm import language, nbsvm, toxicity
from replygauge.llm.queries import QUERIES
from replygauge.sources.tables import table

FOLDER = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "   \n"), (4, "12 34 !!"), (None, "the one and the other"), (5, "ä" * 50_000), (6, "the end"), (6, "the end")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 0.5, "x") for i, t in ODD], "doc_id long, text string, score double, predicted string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def held(i, parts, at):
    return i is not None and zlib.crc32(str(i).encode()) % parts == at


def test_language_query_on_held_out_rows(spark):
    rows = QUERIES["op5_language_id"](spark, FOLDER).collect()
    lang = {r.doc_id: r.lang for r in table(spark, FOLDER, "documents").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.97
    # calibrated: the mean score is near the accuracy
    assert abs(np.mean([r.score for r in out]) - np.mean([r.lang_pred == lang[r.doc_id] for r in out])) < 0.05


def test_language_edge_cases(spark, odd, empty):
    model = language.train(table(spark, FOLDER, "documents"))
    rows = language.predict_language(odd, model).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3, 4))
    assert by_id[None].held_out is False and by_id[6].lang_pred in model.languages
    assert language.keep_known(odd, model).columns == odd.columns
    assert {r.doc_id for r in language.keep_known(odd, model).collect()} <= {None, 5, 6}
    untrained = language.train(empty)
    assert {r.lang_pred for r in language.predict_language(odd, untrained).collect()} == {"und"}
    assert language.predict_language(empty, model).count() == 0


def test_temperature_makes_overconfident_scores_milder():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 600)
    logits = np.eye(3)[np.where(rng.random(600) < 0.8, y, (y + 1) % 3)] * 9.0
    assert language.temperature_of(logits, y) > 2
    weight, bias = language.follow_the_leader([(np.array([k]), np.array([1.0])) for k in y], y, 3)
    assert (weight[:, :3].argmax(0) == np.arange(3)).all() and (weight != 0).sum() <= 9


def test_quality_query_on_held_out_rows(spark):
    rows = QUERIES["op4_nb_support_vectors"](spark, FOLDER).collect()
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    assert len(rows) == table(spark, FOLDER, "documents").count()
    assert all(r.held_out == held(r.doc_id, 4, 2) and r.predicted == int(r.score >= 0.7) for r in rows)
    out = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in out]) > 0.9


def test_quality_edge_cases(spark, odd, empty, no_labels):
    model = nbsvm.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    rows = nbsvm.score_quality(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert nbsvm.score_quality(empty, model).count() == 0
    blank = nbsvm.train(empty, no_labels)
    assert {r.score for r in nbsvm.score_quality(odd, blank).collect()} == {0.5}


def test_dual_coordinate_descent_separates_and_bounds_the_duals():
    rows = [np.array([0, 1]), np.array([0, 2]), np.array([3, 4]), np.array([3, 5])]
    y = np.array([1.0, 1.0, -1.0, -1.0])
    weight, bias = nbsvm.hinge_fit(rows, y, np.ones(6))
    margins = np.array([weight[r].sum() / np.sqrt(2) + bias for r in rows])
    assert (np.sign(margins) == y).all() and (y * margins > 0.8).all()


def test_features_do_not_depend_on_neighbours():
    texts = ["a b a b!", "", "AB ab 12", "é é"]
    together = list(nbsvm.features(pa.array(texts)))
    for text, found in zip(texts, together, strict=True):
        assert (next(nbsvm.features(pa.array([text]))) == found).all()


def edits(a, b):
    """Optimal string alignment distance, the plain way."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_automaton_equals_plain_distances():
    entries = [("idiot", False), ("moron", False), ("scum", False), ("bad", False), ("trash", True)]
    automaton = toxicity.Automaton.build(entries)
    r, words = random.Random(4), set()
    for text, _ in entries:
        for _ in range(400):
            w = list(text)
            for _ in range(r.randint(0, 2)):
                at, kind = r.randrange(len(w) + 1), r.randrange(4)
                if kind == 0:
                    w.insert(at, r.choice("abdiorstx"))
                elif kind == 1 and w:
                    del w[at % len(w)]
                elif kind == 2 and w:
                    w[at % len(w)] = r.choice("abdiorstx")
                elif len(w) > 1:
                    k = at % (len(w) - 1)
                    w[k], w[k + 1] = w[k + 1], w[k]
            words.add("".join(w) or "x")
    words = sorted(words)
    codes, starts, ends, _, _ = toxicity.words_of(pa.array([" ".join(words)]))
    found = automaton.match(codes, starts, ends, automaton.lookup())
    for word, hit in zip(words, found.tolist(), strict=True):
        whole = [edits(t, word) for t, stem in entries if not stem and edits(t, word) <= toxicity.allowed(t)]
        stem = [min(edits("trash", word[:k]) for k in range(len(word) + 1))]
        best = min([*whole, *(x for x in stem if x <= 1)], default=None)
        assert (hit < 0) == (best is None), word
        assert best is None or hit % 2 == int(best > 0), word


def test_toxicity_query_on_held_out_rows(spark):
    rows = QUERIES["op10_levenshtein_toxicity"](spark, FOLDER).collect()
    labels = {r.doc_id: r.toxic for r in table(spark, FOLDER, "labels").collect()}
    assert all(r.held_out == held(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.5) for r in rows)
    out = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in out]) > 0.9


def test_misspelled_terms_count_and_quotations_count_less():
    model = toxicity.Model(toxicity.Automaton.build([("moron", False)]), np.array([6.0, 5.0]), 1.0, 0.25, -3.0)
    classes = model.automaton.lookup()
    texts = pa.array(["you moron", "you mroon", "he said “what a moron” and left", "quoted moron here", "nothing", None, ""])
    direct, quote, hits = model.evidence(texts, classes)
    assert direct.tolist() == [6, 5, 0, 0, 0, 0, 0] and quote.tolist() == [0, 0, 6, 6, 0, 0, 0]
    score = model.scores(direct, quote)
    assert score[0] > score[1] > 0.5 > score[2] > score[4] == score[5]


def test_toxicity_edge_cases(spark, odd, empty, no_labels):
    model = toxicity.train(empty, no_labels)
    rows = toxicity.score_toxicity(odd, model).collect()
    assert len(rows) == len(ODD) and {r.predicted for r in rows} == {0}
    assert toxicity.score_toxicity(empty, model).count() == 0
