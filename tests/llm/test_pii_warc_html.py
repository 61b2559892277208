"""Personal data, archives and page text against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import struct

import pytest
import zstandard

from replygauge.llm import html, pii, warc
from replygauge.llm.queries import QUERIES
from replygauge.sources.tables import table

FOLDER = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(x) for x in re.sub("[^0-9]", "", m[0])]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(7)
    for _ in range(20_000):
        text = "".join(r.choice("ab@..@1123 -+()04é\n") for _ in range(r.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["1" * 50_000, "a" * 50_000 + "@", "1." * 30_000, "+1" + " " * 50_000, "@" * 20_000])
def test_long_runs_are_scanned_once(text):
    pii.base_spans(text)


def test_pii_query_equals_the_plain_patterns(spark):
    texts = {r.doc_id: r.text or "" for r in table(spark, FOLDER, "documents").collect()}
    rows = QUERIES["op3_conditional_random_field_pii"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r.doc_id])
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, _, k in spans) for i in range(4)]
        assert set(text.split(",")) <= set(r.spans.split(","))


def test_field_adds_what_patterns_miss_and_leaves_numbers_alone():
    field = pii.train()
    found = {t: [t[a:b] for a, b, _ in pii.added_spans(field, t, pii.base_spans(t))] for t in [
        "call 555-123-4567 now", "ring (212) 555-7788, please", "mail kim@intranet today",
        "order 9807915762804490 shipped", "version 4.0. of 2024-01-02", "key 2abc3ff2ca8fb1e4c565a0eb63815530",
    ]}
    assert list(found.values()) == [["555-123-4567"], ["(212) 555-7788"], ["kim@intranet"], [], [], []]


def test_viterbi_equals_the_best_of_all_paths():
    import itertools

    import numpy as np

    rng = np.random.default_rng(2)
    field = pii.Field(rng.normal(size=(pii.FEATURES, 9)), rng.normal(size=(9, 9)), rng.normal(size=9))
    runs = [[[int(x) for x in rng.integers(0, 50, 3)] for _ in range(n)] for n in (1, 2, 3, 3, 4)]
    for run, labels in zip(runs, field.decode(runs), strict=True):
        scores = field.emit[np.array(run)].sum(1)

        def value(path, scores=scores):
            return field.first[path[0]] + scores[range(len(path)), path].sum() + sum(field.move[a, b] for a, b in itertools.pairwise(path))

        assert tuple(labels) == max(itertools.product(range(9), repeat=len(run)), key=lambda p: value(list(p)))


def test_pii_edge_cases(spark):
    schema = "doc_id long, text string, spans string, n_chars long"
    rows = [(1, None, "s", 9), (2, "", "s", 0), (3, "a@b.co a@b.co", "s", 13), (3, "a@b.co a@b.co", "s", 13), (None, "x", "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    found = pii.find_pii(docs).collect()
    assert sorted((r.doc_id or 0, r.n_email) for r in found) == [(0, 0), (1, 0), (2, 0), (3, 2), (3, 2)]
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text, r.n_chars) for r in masked.collect() if r.doc_id != 1) == [
        (0, "x", 1), (2, "", 0), (3, "[EMAIL] [EMAIL]", 15), (3, "[EMAIL] [EMAIL]", 15)]
    assert pii.find_pii(docs.limit(0)).count() == 0


# -- archives ---------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


def test_archives_bring_back_what_was_written(spark):
    long = "<p>" + "wörd " * 400
    rows = [(1, "http://a/1", long, ""), (2, "http://a/2", long, ""), (7, "http://b\r\nX: 1", "short", ""), (8, None, "short", ""),
            (9, "u", None, ""), (10, "u", "", ""), (None, "u", "lost", "")]
    records = warc.read_archives(warc.write_archives(warc.with_record_types(pages(spark, rows)), warc.train_dictionary([long.encode()] * 50))).collect()
    assert len(records) == len(rows)
    by_id = {r.page_id: r for r in records}
    assert (by_id[1].record_type, by_id[1].refers_to, by_id[1].payload) == ("revisit", 2, b"")
    assert by_id[2].record_type == "response" and bytes(by_id[2].payload).decode() == long
    assert by_id[1].payload_digest == by_id[2].payload_digest == hashlib.sha1(long.encode()).hexdigest()
    assert {by_id[i].record_type for i in (7, 8, 9, 10, None)} == {"response"} and by_id[9].payload_bytes == 0
    assert warc.roundtrip(pages(spark, [])).count() == 0


def test_archive_layout_and_damage():
    dictionary = warc.train_dictionary([f"<p>page {i} of the same shape with words {i * 7}</p>".encode() * 20 for i in range(200)])
    assert dictionary
    body = b"<p>hello</p>"
    record = warc.record_bytes(5, "http://x/", "response", body, len(body), hashlib.sha1(body).hexdigest(), None)
    frame = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).compress(record)
    content = warc.archive_head(dictionary) + frame * 2
    assert struct.unpack("<I", content[:4])[0] == 0x184D2A5D
    assert [r["payload"] for r in warc.read_archive(content)] == [body, body]
    with pytest.raises(ValueError):
        list(warc.read_archive(content[:-3]))
    for broken in (record.replace(b"Content-Length: 12", b"Content-Length: 11"), record.replace(b"hello", b"hallo"), record.replace(b"WARC/1.1", b"WARC/9"), record[:-1]):
        with pytest.raises(ValueError):
            warc.parse_record(broken)


def test_archives_as_files(spark, tmp_path):
    archives = warc.write_archives(warc.with_record_types(pages(spark, [(1, "u", "x", ""), (2, "u", "y", "")])), b"")
    warc.save_files(spark, archives, str(tmp_path))
    back = warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path)))
    assert sorted(r.page_id for r in back.collect()) == [1, 2]


# -- page text --------------------------------------------------------------

PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id=menu>m</div><main><article>
<header class="post-header"><h1>T&eacute;st</h1></header><p>one<b>two</b> three<br>four<p>five&nbsp; six<ul><li>a<li>b</ul>
<table><tr><td>x<td>y</table><div class="comments"><p>c</div><aside>s</aside><form>f<input></form><script>var t="</p>";</script>
</article></main><div class="cookie-notice">k</div><footer>f</footer></body></html> tail"""


ARTICLE = "<h1>Title</h1>" + "<p>Words of the article that is on this page.</p>" * 8


@pytest.mark.parametrize("start, end", [
    ('<div class="content no-sidebar">', "</div>"),
    ('<div class="site right-sidebar">', "</div>"),
    ('<div class="with-comments">', "</div>"),
    ('<form id="aspnetForm"><input name=q><label>find</label>', "</form>"),
    ('<div class="page-with-header">', "</div>"),
    ('<div class="site right-sidebar"><div class="banner on">', "</div></div>"),
])
@pytest.mark.parametrize("inner", ["<article>%s</article>", "<main>%s</main>", "<div class=text>%s</div>"])
def test_wrappers_named_after_boilerplate_keep_the_article(start, end, inner):
    page = f"<body><nav><a href=/>home</a></nav>{start}{inner % ARTICLE}<div class=comments><p>mine</p></div>{end}<div class=footer>f</div></body>"
    found = html.containers(page)
    assert found[html.best_path(found)].blocks == ["Title", *["Words of the article that is on this page."] * 8]


def test_marked_parts_beside_an_article_stay_out():
    for page in (
        "<body><article><p>short</article><div class=comments><article><p>" + "my long comment " * 20 + "</article></div></body>",
        '<body><article class="has-share-buttons post"><p>short</article><form><p>' + "sign up here " * 20 + "</form></body>",
    ):
        found = html.containers(page)
        assert found[html.best_path(found)].blocks == ["short"]


def test_article_without_what_is_around_it():
    found = html.containers(PAGE)
    assert found[html.best_path(found)].blocks == ["Tést", "onetwo three four", "five six", "a", "b", "x", "y"]


@pytest.mark.parametrize("page", ["", "<", "<p", "plain", "<a " * 5000, "<div>" * 5000 + "x", "<p>a<!-- x", "<script>x", "</p></div>", "<p a='>x"])
def test_broken_pages(page):
    found = html.containers(page)
    html.best_path(found)


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        ("<article><p>one <svg class=icon/>two</p><p>three <math/> four</article>", ["one two", "three four"]),
        ("<article><p>one <svg viewBox='0'><title>t</title><style/><g><path d=m/></g></svg>two<p>three</article>", ["one two", "three"]),
        ("<article><p>one <svg><path d=m><p>two</article>", ["one", "two"]),
        ("<article><p>one <svg><foreignObject><p>x</p></foreignObject></svg>two<p>three</article>", ["one two", "three"]),
        ("<body><div><button>Menu</div><article><p>one<p>two</article>", ["one", "two"]),
        ("<body><button>Menu<article><p>one<p>two</article><button>x</button>", ["one", "two"]),
        ("<article><p>one<select><option>a<option>b<p>two</article>", ["one", "two"]),
        ("<article><p>one <button><div>x<p>y</button>two</p><p>three</article>", ["one two", "three"]),
        ("<article><p>one<button>x</p><p>two</article><button>y</button>", ["one", "two"]),
        ("<article><p>one<noscript><p>x<img></noscript> two<template><div>y<template>z</template>y</template>!<p>three</article>", ["one two!", "three"]),
        ("<article><p>one<p>two<button>x", ["one", "two"]),
    ],
)
def test_left_out_elements_end_where_they_end(page, blocks):
    found = html.containers(page)
    assert found[next(p for p in found if p.endswith("/article"))].blocks == blocks


def test_host_vote_beats_a_page_of_its_own(spark):
    usual = "<body><div class=story>" + "<p>word word word</p>" * 20 + "</div><div class=other>less</div></body>"
    odd = "<body><div class=story><p>short</p></div><div class=other>" + "<p>longer text here</p>" * 20 + "</div></body>"
    rows = [(i, "http://h/x", usual, "") for i in range(5)] + [(9, "http://h/y", odd, ""), (10, None, None, ""), (11, "http://z/", "<p>alone", "")]
    got = {r.page_id: r.text for r in html.extract_text(pages(spark, rows)).collect()}
    assert got[9] == "short" and got[10] == "" and got[11] == "alone" and got[0].startswith("word")
    assert html.extract_text(pages(spark, [])).count() == 0


def test_extraction_query_equals_the_article_element(spark):
    import html as std

    source = {r.page_id: r.html for r in table(spark, FOLDER, "pages").collect()}
    for r in QUERIES["op9_consensus_extraction"](spark, FOLDER).collect():
        article = re.search("<article>(.*?)</article>", source[r.page_id], re.DOTALL)[1]
        plain = re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", " ", article))
        assert r.text == " ".join(std.unescape(plain).split()) and r.n_chars == len(r.text)
