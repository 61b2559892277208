"""Main text of web pages by a vote of each host's pages on where the article is.

Every page scores its containers by the text and links below them. A container is named by its generalised path: the tags and classes
from the root down, digits taken out. Spark adds the scores by host and path;
the pages of a host are then read again with its best path, and a page that
lacks it falls back to its own best container.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replygauge.llm.arrays import slices
from replygauge.llm.common import written

#: Elements without content, and elements whose content is text until their own end tag (fixed values of HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Elements that are left out with all elements in them. A block ends a foreign one, unless it is in a part that holds HTML,
#: and a section ends a control.
LEFT_OUT = frozenset("noscript template svg math select button".split())
FOREIGN = frozenset(["svg", "math"])
_HOLDS_HTML = frozenset(["foreignobject", "annotation-xml"])
_CONTROLS = frozenset(["select", "button"])
_SECTIONS = frozenset("article aside body footer header main nav section table".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that never hold article text.
OUTSIDE = frozenset("head nav header footer aside form menu dialog".split())
#: Words in a class, id or role that mark what is not the article.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|"
    r"sidebar\w*|side|nav|navbar|navigation|menu\w*|breadcrumbs?|pager|pagination|header|masthead|footer|foot|share|sharing|social|"
    r"comments?|comment-list|respond|replies|disqus|related|recommended|login|signup|search|toolbar|widget|copyright|legal|hidden|"
    r"complementary|contentinfo|skip|skip-link)(?=$|[\s_-])", re.IGNORECASE
)
#: Classes that tell what an element has or lacks, not what it is.
_STATE = re.compile(r"(?<!\S)(?:[\w-]+-)?(?:no|has|with|without)[-_]\S*", re.IGNORECASE)
#: Elements nested deeper are read as text of the element around them.
DEEPEST = 512
_PAGE = frozenset(["html", "body", "main"])
#: What a closed paragraph is closed by: the start of any block.
_CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary", "figcaption"}
_CLOSES_SAME = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

_TOKEN = re.compile(r"<!--(?:.*?--!?>|>|->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"[0-9]+")


@dataclass
class Container:
    """One element that may hold the article, with what was found below it."""

    path: str
    text: int = 0
    links: int = 0
    blocks: list[str] = field(default_factory=list)


@dataclass
class Marked:
    """Elements that a class, id or role, or a form, would leave out, by the place of their start tag."""

    #: Unlinked characters below each, and of the whole page.
    text: dict[int, int] = field(default_factory=dict)
    total: int = 0
    #: Those around the first article, and whether one stands outside of them.
    around: frozenset[int] = frozenset()
    article: bool = False
    plain: bool = False

    def wrappers(self) -> frozenset[int]:
        """Those that hold the page's article: the only one, or without one over four fifths of the unlinked text."""
        if self.article or self.plain:
            return frozenset() if self.plain else self.around
        return frozenset(i for i, n in self.text.items() if 5 * n > 4 * self.total)


def containers(page: str) -> dict[str, Container]:
    """Text blocks of a page by the generalised path of each element around them.

    Boilerplate elements and all below them are left out, except that a mark (class,
    id, role) or a form leaves out no element that holds the page's article (see
    ``Marked``). A block belongs to every element around it.
    """
    marked = Marked()
    found = _containers(page, frozenset(), marked)
    wrappers = marked.wrappers()
    return _containers(page, wrappers, Marked()) if wrappers else found


def _containers(page: str, wrappers: frozenset[int], marked: Marked) -> dict[str, Container]:
    found: dict[str, Container] = {}
    soft: list[tuple[int, int]] = []  # open marked elements: place in the stack, place of the start tag
    hard = 0  # place in the stack of the outermost element that its tag leaves out; 0: none
    # open elements: tag, path, whether inside of something left out, whether inside a link
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]
    words: list[str] = []
    linked = 0
    at, size = 0, page.rfind(">") + 1

    last_ends: dict[str, int] = {}

    def ends_after(tag: str, place: int) -> bool:
        if tag not in last_ends:
            last_ends[tag] = max((e.start() for e in re.finditer(rf"</{tag}\b", page, re.IGNORECASE)), default=-1)
        return last_ends[tag] >= place

    def flush() -> None:
        nonlocal linked
        if stack[-1][2]:
            return  # words from before what is left out go on behind it
        text = _SPACE.sub(" ", "".join(words)).strip()
        if text:
            for path in dict.fromkeys(s[1] for s in stack):
                c = found.get(path)
                if c is None:
                    c = found[path] = Container(path)
                c.blocks.append(text)
                c.text += len(text)
                c.links += min(linked, len(text))
        words.clear()
        linked = 0

    def say(piece: str) -> None:
        nonlocal linked
        if not piece:
            return
        if not hard and not stack[-1][3] and not piece.isspace():
            size = len(piece.strip())
            marked.total += size
            for _, place in soft:
                marked.text[place] += size
        if not stack[-1][2]:
            text = html.unescape(piece) if "&" in piece else piece
            words.append(text)
            if stack[-1][3]:
                linked += len(text)

    def close(to: int) -> None:
        nonlocal hard
        while soft and soft[-1][0] >= to:
            soft.pop()
        if hard >= to:
            hard = 0
        while len(stack) > to and stack[-1][2]:
            stack.pop()
        if any(s[0] in BLOCK for s in stack[to:]):
            flush()
        del stack[to:]

    while at < size:
        m = _TOKEN.search(page, at, size)
        if m is None:
            break
        say(page[at : m.start()])
        at = m.end()
        end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            # an end tag of an inline element does not reach out of its block
            if place and (tag in BLOCK or tag in LEFT_OUT or not any(s[0] in BLOCK for s in stack[place + 1 :])):
                close(place)
            continue
        if tag in RAW:
            if attributes.endswith("/") and _open(stack, FOREIGN, _HOLDS_HTML):
                continue
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        while tag in BLOCK and (place := _open(stack, LEFT_OUT, frozenset())):
            around = stack[place][0]
            broken = around in FOREIGN and not any(s[0] in _HOLDS_HTML for s in stack[place + 1 :])
            if not broken and not (around in _CONTROLS and tag in _SECTIONS) and ends_after(around, at):
                break
            close(place)
        if tag in _CLOSES_P:
            place = _open(stack, {"p"}, (BLOCK - {"p"}) | LEFT_OUT)
            if place:
                close(place)
        if tag in _CLOSES_SAME:
            place = _open(stack, _CLOSES_SAME[tag], _SCOPE.get(tag, set()) | LEFT_OUT)
            if place:
                close(place)
        if tag in BLOCK:
            flush()
        if tag in VOID:
            if tag == "br":
                say(" ")
            continue
        if attributes.endswith("/") and tag not in BLOCK:
            continue
        marks, classes = "", ""
        for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
            value = value.strip("\"'")
            if name.lower() == "class":
                classes = value
            marks += " hidden" if "hidden" in name.lower() and value.lower() != "false" else f" {value}"
        if len(stack) >= DEEPEST and (tag not in LEFT_OUT or stack[-1][2]):
            continue
        _, path, out, link = stack[-1]
        if tag in BLOCK and tag not in _INNER:
            kinds = ".".join(sorted(_DIGITS.sub("", c) for c in classes.lower().split()))
            path = f"{path}/{tag}" + (f".{kinds}" if kinds else "")
        headed = tag not in _PAGE and bool(_open(stack, {"article"}, set()))  # an article's header belongs to it
        by_tag = tag in LEFT_OUT or (tag in OUTSIDE and tag != "form" and not (tag == "header" and headed))
        by_tag = by_tag or (tag == "label" and wrappers and _open(stack, {"form"}, set()))
        by_mark = tag == "form" or (
            bool(marks) and tag not in _PAGE
            and any(not (headed and "header" in b[0].lower()) for b in BOILERPLATE.finditer(_STATE.sub(" ", marks)))
        )
        if by_mark and not by_tag and not hard:
            soft.append((len(stack), m.start()))
            marked.text[m.start()] = 0
        if by_tag and not hard:
            hard = len(stack)
        if tag in ("article", "main") and not hard:
            if not soft:
                marked.plain = True
            elif not marked.article:
                marked.article, marked.around = True, frozenset(x[1] for x in soft)
        out = out or bool(by_tag) or (by_mark and m.start() not in wrappers)
        stack.append((tag, path, out, link or tag == "a"))
    say(page[at:])
    close(1)
    flush()
    return found


#: Blocks that are parts of a container rather than containers.
_INNER = frozenset(
    "p h1 h2 h3 h4 h5 h6 pre blockquote li ul ol dl dd dt hr figure figcaption table tbody thead tfoot tr td th caption hgroup address".split()
) | (frozenset("a b i em strong span small u s code q cite abbr sub sup time mark font big tt kbd var samp label bdi bdo del ins data".split()))


def _open(stack: list, tags: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> int:
    """Place of the innermost open element among ``tags``, unless one of ``scope`` is open inside it; 0: none."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] in tags:
            return i
        if stack[i][0] in scope:
            return 0
    return 0


#: Last steps of paths that are meant for articles, the surest first.
ARTICLE_LIKE = [r"^article(\.|$)", r"^main(\.|$)", r"\.[\w.-]*(article|content|post|entry|story)"]


def score(c: Container) -> int:
    """Characters below a container; linked ones count against it."""
    return max(0, c.text - 2 * c.links)


def rank(path: str, share: float) -> tuple | None:
    """Order of a path among those of a page or host (the least wins); share: its score over the highest.

    Outermost elements meant for articles with half of the text come first, then
    the innermost element with four fifths of it.
    """
    last, depth = path.rpartition("/")[2], path.count("/")
    for kind, pattern in enumerate(ARTICLE_LIKE):
        if re.search(pattern, last):
            return (kind, depth, path) if share >= 0.5 else None
    return (len(ARTICLE_LIKE), -depth, path) if share >= 0.8 else None


def best_path(found: dict[str, Container]) -> str | None:
    scores = {p: score(c) for p, c in found.items()}
    most = max(scores.values(), default=0)
    ranked = [r for p, v in scores.items() if (r := rank(p, v / most if most else 1.0))]
    return min(ranked)[-1] if ranked else None


def host_of(url: str | None) -> str:
    return (url or "").partition("://")[2].partition("/")[0].lower()


def path_scores(pages: DataFrame) -> DataFrame:
    """(host, path, score) of all containers of all pages, added up within each slice before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                totals: dict[tuple[str, str], int] = defaultdict(int)
                for url, page in zip(part["url"].to_pylist(), part["html"].to_pylist(), strict=True):
                    for path, c in containers(page or "").items():
                        value = score(c)
                        if value > 0:
                            totals[host_of(url), path] += value
                hosts, paths = zip(*totals, strict=True) if totals else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(totals.values(), pa.int64())], ["host", "path", "score"]
                )

    return pages.select("url", "html").mapInArrow(run, "host string, path string, score long")


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path of each host that ranks first (see ``rank``) by the scores of all its pages."""
    totals = path_scores(pages).groupBy("host", "path").agg(F.sum("score").alias("score"))
    host = Window.partitionBy("host")
    last, depth = F.substring_index("path", "/", -1), F.length("path") - F.length(F.replace("path", F.lit("/")))
    kind = F.coalesce(*[F.when(F.rlike(last, F.lit(p)), F.lit(k)) for k, p in enumerate(ARTICLE_LIKE)], F.lit(len(ARTICLE_LIKE)))
    shares = (
        totals.withColumn("most", F.max("score").over(host)).withColumn("kind", kind)
        .where(F.col("score") * 10 >= F.col("most") * F.when(F.col("kind") < len(ARTICLE_LIKE), 5).otherwise(8))
    )
    order = F.struct("kind", F.when(F.col("kind") < len(ARTICLE_LIKE), depth).otherwise(-depth).alias("depth"), "path")
    return shares.groupBy("host").agg(F.min(order).alias("first")).select("host", "first.path")


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars, path.

    A null or empty html, or one without text outside boilerplate, gives an empty
    text. Pages without a usable url vote as one host. An empty table gives no rows.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    won = written(host_paths(rows), "host-paths")
    # same value as host_of()
    host = F.lower(F.substring_index(F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit("")), "/", 1))
    joined = rows.withColumn("host", F.coalesce(host, F.lit(""))).join(won, "host", "left").select("page_id", "url", "html", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts, paths = [], []
                for page, path in zip(part["html"].to_pylist(), part["path"].to_pylist(), strict=True):
                    found = containers(page or "")
                    if path not in found:
                        path = best_path(found)
                    paths.append(path)
                    texts.append(" ".join(found[path].blocks) if path is not None else "")
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()), pa.array(paths, pa.string())],
                    ["page_id", "url", "text", "n_chars", "path"],
                )

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long, path string")
