r"""HTML extraction by tree scoring.

A page becomes a tree of elements and a list of text blocks in page order (text between the bounds of block elements).
Elements that are not prose by what they are or by their class or id (menus, page headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments) are left out with all they hold;
what a name says does not count around an article or main element, nor when it is part of another word (``has-sidebar``, ``related-work``). Every paragraph-like
block passes points to its ancestors: 1, its commas, and up to 3 for length, whole to the parent, half to the
grandparent and less further up; an ancestor's points are discounted by its link density. The best container decides: when it lies inside an article or
main element, all of that element is kept; otherwise the container with those siblings that are headings, paragraphs or containers that
score near it. Lists of links are left out. No part is judged by its length or by that of its neighbours.

Inside a block character references are decoded, white space becomes one space and its ends are trimmed; blocks are joined
by two \n. Nothing else is dropped, whatever its length.

Defined results: null and empty html, and pages without prose, give an empty text; unclosed or cut-off markup is read to its
end; equal pages give equal texts (ties between containers go to the earlier one); repeated rows each give a row; an empty
table gives an empty result; only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteocube.llm.common import table, text_slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title|select)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>[^>\"']*(?:\"[^\"<]*\"[^>\"']*|'[^'<]*'[^>\"']*)*|[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.I | re.S,
)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open one of the same kind.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_STOP = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_NOT_PROSE = frozenset("nav footer aside form button input label fieldset dialog menu object embed audio video canvas head".split())
#: Words of a class, id or role that say what an element is.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentary commentlist respond disqus consent cookie cookies "
    "gdpr notice notices popup modal overlay footer masthead menu nav navbar navigation promo promos promotion related recommended recommendations "
    "recommends share sharing social sidebar side skip sponsor sponsored sponsors subscribe subscription newsletter toolbar widget widgets contentinfo "
    "complementary search login signup pagination pager tags alert header".split()
)
#: Words that only say where such an element is, or which part of it.
_PLACES = frozenset(
    "site page global main primary secondary left right top bottom upper lower inner outer fixed sticky mobile desktop user reader box block bar area wrap "
    "wrapper container section list item items links link buttons button unit slot panel holder group row col column thread form form1 us this to content "
    "text body head title label policy policies js".split()
)
_GOOD = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0}
#: An article's part with at least this share of its characters in links is no prose of it.
MOSTLY_LINKS = 0.5
_WORD_BOUND = re.compile(r"[-_:\d]+")
HARD, SOFT = 2, 1
_LISTS = frozenset("ul ol menu dl table".split())
_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li td dd figcaption".split())


class _Tree:
    """Parallel lists: parent, tag and veto of every element; blocks as (element, text, characters in links)."""

    def __init__(self) -> None:
        self.parent, self.tag, self.veto = [-1], ["#"], [0]
        self.blocks: list[tuple[int, str, int]] = []

    def prose_blocks(self) -> list[tuple[int, str, int]]:
        """The blocks outside vetoed elements; a soft veto does not hold around an article or main element."""
        n = len(self.parent)
        holds = [x in ("article", "main") for x in self.tag]
        for e in range(n - 1, 0, -1):
            if holds[e] and self.veto[e] != HARD:
                holds[self.parent[e]] = True
        out = [False] * n
        for e in range(1, n):  # parents come first
            out[e] = out[self.parent[e]] or self.veto[e] == HARD or (self.veto[e] == SOFT and not holds[e])
        return [b for b in self.blocks if not out[b[0]]]


def _named(attrs: str) -> bool:
    """Whether a class, id or role names an element that is no prose: ``sidebar`` and ``left-sidebar``, not ``has-sidebar``.

    A name counts when one of its words (parted by hyphens, underscores or digits) says what the element is and the others only
    where: ``related`` and ``related-links``, not ``related-work``.
    """
    for _, a, b, c in _ATTR.findall(attrs):
        for name in (a or b or c).lower().split():
            words = [w for w in _WORD_BOUND.split(name) if w]
            if any(w in _NAMES for w in words) and all(w in _NAMES or w in _PLACES for w in words):
                return True
    return False


def _veto(tag: str, attrs: str, inside_article: bool) -> int:
    """HARD: no prose whatever it holds; SOFT: no prose unless it holds an article or main element; 0: prose."""
    if tag in _NOT_PROSE or (tag == "header" and not inside_article):
        return SOFT if tag in ("form", "header", "fieldset") else HARD
    return SOFT if "=" in attrs and tag not in ("html", "body", "article", "main") and _named(attrs) else 0


def parse(page: str) -> _Tree:
    t = _Tree()
    parent, tags, veto = t.parent, t.tag, t.veto
    stack = [0]
    run: list[str] = []
    links = linked = articles = hard = 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                t.blocks.append((stack[-1] if tags[stack[-1]] in _BLOCK else _holder(), text, linked))
            run.clear()
        linked = 0

    def _holder() -> int:
        return next((e for e in reversed(stack) if tags[e] in _BLOCK), 0)

    def close(depth: int) -> None:
        nonlocal links, articles, hard
        for e in stack[depth:]:
            hard -= veto[e] == HARD
            links -= tags[e] == "a"
            articles -= tags[e] in ("article", "main")
        del stack[depth:]

    def say(text: str) -> None:
        nonlocal linked
        if text and not hard:
            text = entities.unescape(text)
            run.append(text)
            if links:
                linked += len(text)

    at = 0
    for m in _TOKEN.finditer(page):
        say(page[at : m.start()])
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        block = tag in _BLOCK
        if tag == "br":
            run.append(" ")
            continue
        if block:
            flush()
        if m["end"]:
            for d in range(len(stack) - 1, 0, -1):
                if tags[stack[d]] == tag:
                    close(d)
                    break
            continue
        if tag in _VOID:
            continue
        if block or tag in _ENDS:
            _end_implied(tag, stack, tags, close)
        e = len(parent)
        parent.append(stack[-1])
        tags.append(tag)
        veto.append(_veto(tag, m["attrs"] or "", articles > 0))
        hard += veto[e] == HARD
        articles += tag in ("article", "main")
        links += tag == "a"
        if not (m["attrs"] or "").endswith("/") or block:
            stack.append(e)
        else:
            links -= tag == "a"
            hard -= veto[e] == HARD
            articles -= tag in ("article", "main")
    say(page[at:])
    flush()
    return t


def _end_implied(tag: str, stack: list[int], tags: list[str], close) -> None:
    """A block ends an open paragraph; list items, cells and the like end their kind within their list or table."""
    ends, stop = _ENDS.get(tag, ()), _STOP.get(tag, ())
    for d in range(len(stack) - 1, 0, -1):
        name = tags[stack[d]]
        if name in ends or (name == "p" and tag in _BLOCK):
            close(d)
            return
        if name in stop or (name in _BLOCK and not ends):
            return


def scores(t: _Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points, characters and characters in links of every element, its descendants' included."""
    n = len(t.parent)
    points, chars, linked = np.zeros(n), np.zeros(n), np.zeros(n)
    for e, text, in_links in t.blocks:
        worth = 1.0 + text.count(",") + min(len(text) / 100.0, 3.0)
        up = t.parent[e] if t.tag[e] in _PARAGRAPHS and e else e
        share = 1.0
        a = up
        level = 1
        while a >= 0:
            points[a] += worth * share
            level += 1
            share = 1.0 / (2.0 if level == 2 else 3.0 * (level - 1))
            a = t.parent[a]
        a = e
        while a >= 0:
            chars[a] += len(text)
            linked[a] += min(in_links, len(text))
            a = t.parent[a]
    points += np.array([_GOOD.get(x, 0.0) for x in t.tag]) * (chars > 0)
    return points * (1.0 - linked / np.maximum(chars, 1.0)), chars, linked


def extract(page: str) -> str:
    """Main text of one page."""
    t = parse(page)
    t.blocks = t.prose_blocks()
    if not t.blocks:
        return ""
    points, chars, linked = scores(t)
    best = int(np.argmax(points))
    inside = _below(t, {_home(t, best)} if _home(t, best) else _with_siblings(t, best, points, chars, linked))
    lists = _below(t, _link_lists(t, chars, linked))
    return "\n\n".join(text for e, text, _ in t.blocks if inside[e] and not lists[e])


def _below(t: _Tree, tops: set[int]) -> list[bool]:
    """Which elements are among ``tops`` or below one of them."""
    out = [e in tops for e in range(len(t.parent))]
    for e in range(1, len(out)):
        out[e] = out[e] or out[t.parent[e]]
    return out


def _link_lists(t: _Tree, chars: np.ndarray, linked: np.ndarray) -> set[int]:
    """Lists and tables of at least two items that are mostly links: navigation, wherever it stands."""
    items = np.bincount([t.parent[e] for e in range(1, len(t.parent)) if t.tag[e] in ("li", "dd", "dt", "tr", "tbody") and chars[e]], minlength=len(t.parent))
    return {e for e, x in enumerate(t.tag) if x in _LISTS and items[e] >= 2 and linked[e] >= MOSTLY_LINKS * chars[e] > 0}


def _with_siblings(t: _Tree, best: int, points: np.ndarray, chars: np.ndarray, linked: np.ndarray) -> set[int]:
    """The best container and what beside it is prose by its kind: headings, paragraphs, containers that score or hold a title."""
    kept = {best}
    for e in range(1, len(t.parent)):
        if best and t.parent[e] == t.parent[best] and chars[e]:
            density = linked[e] / chars[e]
            if t.tag[e] in _HEADS or (density < MOSTLY_LINKS and (t.tag[e] in _PARAGRAPHS or points[e] >= max(10.0, 0.2 * points[best]))):
                kept.add(e)
    titles = {t.parent[e] for e in range(1, len(t.parent)) if t.tag[e] == "h1" and chars[e]}
    kept |= {e for e in titles if best and e and t.parent[e] == t.parent[best] and linked[e] < MOSTLY_LINKS * chars[e]}
    if best:  # words of the parent itself
        up = t.parent[best]
        t.blocks = [(best if e == up and in_links < MOSTLY_LINKS * len(text) else e, text, in_links) for e, text, in_links in t.blocks]
    return kept


def _home(t: _Tree, best: int) -> int:
    """The outermost article around ``best`` or itself, without one the outermost main (0: neither)."""
    path = []
    e = best
    while e > 0:
        path.append(e)
        e = t.parent[e]
    articles = [e for e in path if t.tag[e] == "article"] or [e for e in path if t.tag[e] == "main"]
    return articles[-1] if articles else 0


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row; one pass, no shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, page in text_slices(batches, "html"):
            text = [extract(p) for p in page.to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(text, pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(task, "page_id long, url string, text string")


def op7_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_pages(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
