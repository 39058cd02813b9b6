import random
import re
from html.parser import HTMLParser

import pytest
from llm_helpers import ship

from meteocube.llm import html_tree as t

P1 = "The river rises in the hills, runs past the mill, and turns twice before it meets the sea."
P2 = "People who live near it know its moods, and they keep their boats high in spring."


def page(body, head=""):
    return f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>T</title><style>p{{margin:0}}</style>{head}</head><body>{body}</body></html>'


def test_article_without_its_surroundings():
    html = page(
        f'<header><h1>Site, name, here</h1></header><nav><ul><li><a href="/a">a</a></li></ul></nav><!-- ad 0 --><div class="ad">Buy, now, cheap, today.</div>'
        f'<article><h1>Head &amp; line</h1><p>{P1}</p><script>var t="</p>";</script><p>{P2}<br>more</p><div class="comments"><p>{P1}</p></div></article>'
        f'<aside><p>{P1}</p></aside><form><p>{P1}</p></form><div id="cookie-notice"><p>{P1}</p></div><footer>&copy; x, y, z</footer>'
    )
    assert t.extract(html) == f"Head & line\n\n{P1}\n\n{P2} more"


def test_scores_choose_the_container_with_prose_not_links():
    links = "".join(f'<li><a href="/{k}">{P1}</a></li>' for k in range(20))
    html = page(f"<div><ul>{links}</ul></div><div><p>{P1}</p><p>{P2}</p></div>")
    assert t.extract(html) == f"{P1}\n\n{P2}"


def test_siblings_that_are_prose_are_kept():
    html = page(f"<div id=wrap><div><p>{P1}</p><p>{P2}</p><p>{P1}</p></div><p>{P2 + P1}</p><p><a href=x>{P2 + P1}</a></p></div>")
    got = t.extract(html)
    assert got.startswith(f"{P1}\n\n{P2}\n\n{P1}") and P2 + P1 in got


def test_an_article_is_kept_whole_however_long_its_parts():
    for n in (1, 3, 9, 40, 200):
        long = "".join(f"<p>{P1} {k}</p>" for k in range(n))
        want = "\n\n".join(["Title", *[f"{P1} {k}" for k in range(n)]])
        for tag in ("article", "main"):
            assert t.extract(page(f"<{tag}><h1>Title</h1><div class=content>{long}</div><p>short end</p></{tag}>")) == f"{want}\n\nshort end", (n, tag)
        html = f"<article><h1>Title</h1><section>{long}</section><section><h2>Last</h2><p>{P2}</p></section><div>tail <a href=x>here</a>, read on</div></article>"
        assert t.extract(page(html)) == f"{want}\n\nLast\n\n{P2}\n\ntail here, read on", n
        links = f"<ul><li><a href=/a>{P1}</a></li><li><a href=/b>{P2}</a></li></ul>"
        html = f"<article><h1>Title</h1><div><div>{long}</div>{links}<p>By hand</p></div>loose words</article><p>{P2}</p>"
        got = t.extract(page(f"<div><article><h1>Title</h1><div><div>{long}</div></div><p>end</p></article></div><aside>{P1}</aside>"))
        assert got == f"{want}\n\nend", n
        assert t.extract(page(html)) == f"{want}\n\nBy hand\n\nloose words", n


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 10, 12, 40, 200])
def test_no_part_is_judged_by_the_length_of_its_neighbours(n):
    long = "".join(f"<p>{P1} {k}</p>" for k in range(n))
    want = "\n\n".join(f"{P1} {k}" for k in range(n))
    html = f"<article><h1>T</h1><div>{long}</div><p><a href=x>Read the full report of the survey</a></p></article>"
    assert t.extract(page(html)) == f"T\n\n{want}\n\nRead the full report of the survey"
    html = f"<article><h1><a href=/self>Linked title</a></h1><div>{long}</div></article>"
    assert t.extract(page(html)) == f"Linked title\n\n{want}"
    if n > 1:
        assert t.extract(page(f"<div><h1>Title</h1><div>{long}</div><p>short end</p></div><ul><li><a href=a>x</a><li><a href=b>y</a></ul>")) == f"Title\n\n{want}\n\nshort end"


OPEN_NAMES = "content has-sidebar|page no-sidebar|related-work|article-header|search-results|share-price|side-by-side|entry tags-news|modal-verbs|with-sidebar|post-header|adverse|menuet".split("|")
SHUT_NAMES = "sidebar|left-sidebar|sidebar-2|site-header|page-footer|comments|comment-list|user_comments|cookie-notice|ad|ad-slot|ads top|related|related-links|share|social-share|newsletter-box|nav main|promo|banner|breadcrumbs".split("|")


SHUT_TOKENS = {w for n in SHUT_NAMES for w in n.split()} - {"main", "top"}


@pytest.mark.parametrize("name", OPEN_NAMES + SHUT_NAMES)
def test_names(name):
    shut = name in SHUT_NAMES
    for attr in ("class", "id"):
        inside = page(f'<article><p>{P1}</p><div {attr}="{name}"><p>{P2}</p></div></article>')
        assert t.extract(inside) == (P1 if shut else f"{P1}\n\n{P2}"), name
        around = page(f'<div {attr}="{name}"><article><p>{P1}</p></article></div>')
        assert t.extract(around) == P1, name


class Plain(HTMLParser):
    """The text blocks of a page's articles, by the standard library's parser (well-formed pages)."""

    VOID, BLOCK, SHUT = t._VOID, t._BLOCK, frozenset("script style nav footer aside form button noscript head title".split())

    def __init__(self):
        super().__init__()
        self.stack, self.run, self.blocks = [], [], []

    def end_block(self):
        text = " ".join("".join(self.run).split())
        if text:
            self.blocks.append(text)
        self.run = []

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCK:
            self.end_block()
        if tag == "br":
            self.run.append(" ")
        elif tag not in self.VOID:
            names = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).split()
            shut = tag in self.SHUT or bool(SHUT_TOKENS & set(names))
            self.stack.append((tag, shut))

    def handle_endtag(self, tag):
        if tag in self.BLOCK:
            self.end_block()
        if any(x == tag for x, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if any(x == "article" for x, _ in self.stack) and not any(shut for _, shut in self.stack):
            self.run.append(data)


def plain(html):
    p = Plain()
    p.feed(html)
    p.close()
    p.end_block()
    return "\n\n".join(p.blocks)


def test_given_pages_against_the_plain_parser():
    import pyarrow.parquet as pq

    rows = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    assert len(rows) > 100
    for r in rows:
        assert t.extract(r["html"]) == plain(r["html"]), r["page_id"]


@pytest.mark.parametrize("seed", range(40))
def test_nested_pages_against_the_plain_parser(seed):
    rng = random.Random(seed)

    def node(depth):
        kind = rng.choice(["p", "p", "h2", "div", "section", "shut", "open", "blockquote", "ol"])
        text = rng.choice([P1, P2, "Short.", "a &amp; b <b>bold</b> x<br>y", 'see <a href="x">this</a>'])
        if kind in ("p", "h2", "blockquote"):
            return f"<{kind}>{text}</{kind}>"
        if kind == "ol":
            return "<ol>" + "".join(f"<li>{rng.choice([P1, 'one', 'two'])}</li>" for _ in range(rng.randint(1, 4))) + "</ol>"
        inner = "".join(node(depth - 1) for _ in range(rng.randint(1, 5))) if depth else f"<p>{text}</p>"
        if kind == "shut":
            return rng.choice([f'<div class="{rng.choice(SHUT_NAMES)}">{inner}</div>', f"<nav>{inner}</nav>", f"<aside>{inner}</aside>", "<script>var a = '<p>x</p>';</script>"])
        name = f' class="{rng.choice(OPEN_NAMES)}"' if kind == "open" else ""
        return f"<div{name}>{inner}</div>" if kind != "section" else f"<section>{inner}</section>"

    body = "".join(node(3) for _ in range(rng.randint(1, 12)))
    html = page(f'<header><p>Site</p></header><nav><a href="/">Home</a></nav><div class="{rng.choice(OPEN_NAMES + SHUT_NAMES)}"><article><h1>Title</h1><p>{P1}</p>{body}</article></div><div class="comments"><p>{P2}</p></div><footer>End</footer>')
    # An element around the article is open whatever its name.
    assert t.extract(html) == plain(re.sub(r'<div class="[^"]*"><article>', "<div><article>", html))


def test_open_and_cut_markup():
    assert t.extract(f"<article><h1>One</h1><p><b>One two.<br><p>{P1}</article><footer>x") == f"One\n\nOne two.\n\n{P1}"
    assert t.extract(f"<article><p>{P1}</p><p>{P2}<a href='") == f"{P1}\n\n{P2}"
    assert t.extract(f"<article><p>{P1}<!-- open <p>{P2}") == P1
    assert t.extract(f"<article><p>{P1}<script>x") == P1
    assert t.extract(f"<article><ul><li>{P1}<li>{P2}</ul></article>") == f"{P1}\n\n{P2}"
    assert t.extract(f"<article><p title='a > b'>{P1}</p></article>") == P1


def test_references_and_white_space():
    assert t.extract("<article><p>a &lt;b&gt; &#x41;&#66;&eacute; &amp;amp; x&nbsp;y\n\t z<b>q</b><i> r</i> </p><p> </p></article>") == "a <b> ABé &amp; x y zq r"
    assert t.extract("1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"


def test_nothing_and_pages_without_prose():
    for html in ("", "</p>", "<nav>a</nav>", "<html><body></body></html>", "<!-- x -->", "<script>a</script>"):
        assert t.extract(html) == ""


def test_deep_and_long_pages_are_read_whole():
    assert t.extract("<div>" * 5000 + f"<p>{P1}</p>" + "</div>" * 5000) == P1
    many = "".join(f"<p>{P1} {k}</p>" for k in range(3000))
    assert t.extract(f"<article>{many}</article>").count("\n\n") == 2999
    assert t.extract("<a href=\"" * 3000 + P1) is not None


def test_rows(spark):
    ship(spark)
    rows = [(1, "u", page(f"<article><p>{P1}</p></article>"), "t"), (2, "u", None, "t"), (2, "u", "", "t"), (None, None, P1, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.url, r.text) for r in t.extract_pages(df).collect() if r.url)
    assert got == [("1", "u", P1), ("2", "u", ""), ("2", "u", "")]
    assert t.extract_pages(df).where("page_id is null").first().text == P1
    assert t.extract_pages(df.limit(0)).count() == 0
