"""Main text of pages: the parser, the alignment of lines, and pages compared by URL."""

from __future__ import annotations

import random
import re
from html import unescape

import numpy as np
import pytest

from dayfold.llm import main_text
from dayfold.llm.main_text import ARTICLE, NEVER, OPEN, lines_of, shared_lines
from dayfold.llm.queries import QUERIES


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        ("", []),
        ("plain &amp; simple", [("plain & simple", OPEN)]),
        ("<p>a<p>b<br>c\n d<b>e</b>", [("a", OPEN), ("b c de", OPEN)]),
        ("<nav>n</nav><article><h1>T</h1><p>x &lt;y&gt;&nbsp; z</article><footer>f", [("n", NEVER), ("T", ARTICLE), ("x <y> z", ARTICLE), ("f", NEVER)]),
        ("<script>if (a < b) '</p>'</script><style>p{}</style>t<!-- <p>no --> u", [("t u", OPEN)]),
        ('<article>a<aside>b</aside><div class="reader-comments">c</div><form>d</form>e</article>', [("a", ARTICLE), ("b", NEVER), ("c", NEVER), ("d", NEVER), ("e", ARTICLE)]),
        ('<main>m<article>a</article></main>', [("m", OPEN), ("a", ARTICLE)]),
        ('<main>m<article class="comment">a</article></main>', [("m", ARTICLE), ("a", NEVER)]),
        ("<article><header><h1>T</h1><p>by me</p></header><p>a</p></article>", [("T", ARTICLE), ("by me", NEVER), ("a", ARTICLE)]),
        ('<body class="has-sidebar ad"><div id="AdSlot">x</div><div class="shadow">y</div></body>', [("x", NEVER), ("y", OPEN)]),
        ("<ul><li>a<li>b</ul>1 < 2 <", [("a", OPEN), ("b", OPEN), ("1 < 2 <", OPEN)]),
        ('<div role="navigation">x</div><div itemprop="articleBody">y</div>', [("x", NEVER), ("y", ARTICLE)]),
        ('<p class="ad">x<p>y', [("x", NEVER), ("y", OPEN)]),
    ],
)
def test_lines(page, lines):
    assert lines_of(page) == lines


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(3)

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = row[:]
            for j, y in enumerate(b):
                row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
        return row[-1]

    for _ in range(500):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 40))] for _ in "ab")
        shared = shared_lines(np.array(a, np.int64), np.array(b, np.int64))
        assert shared.sum() == longest(a, b)
        rest = iter(b)
        assert all(x in rest for x, s in zip(a, shared, strict=True) if s)


def plain(pages):
    """Every page with its neighbours by URL, compared one by one."""
    found = {}
    hosts = {}
    for page_id, url, html in pages:
        host, path = re.match(r"(?:\w+://([^/?#]*))?([^?#]*)", url or "").groups()
        hosts.setdefault(host or "", []).append((path, page_id, html or ""))
    for members in hosts.values():
        first = {}
        for path, page_id, html in sorted(members):
            first.setdefault(tuple(lines_of(html)), (path, page_id))
        order = sorted((*place, lines) for lines, place in first.items())
        texts = {}
        for i, (path, _, lines) in enumerate(order):

            def folders(other, path=path):
                same = [x == y for x, y in zip(path.split("/"), other.split("/"), strict=False)]
                return (same + [False]).index(False)

            near = [(-folders(order[j][0]), j > i, order[j][2]) for j in (i - 1, i + 1) if 0 <= j < len(order)]
            kept = [place == OPEN for _, place in lines]
            total = sum(len(t) for t, p in lines if p == OPEN)
            for _, _, other in sorted(near, key=lambda n: n[:2]):
                code = {t: k for k, t in enumerate({t for t, _ in lines} | {t for t, _ in other})}
                shared = shared_lines(np.array([code[t] for t, _ in lines]), np.array([code[t] for t, _ in other]))
                gone = [s and k for s, k in zip(shared, kept, strict=True)]
                if 2 * sum(len(t) for (t, _), g in zip(lines, gone, strict=True) if g) <= total:
                    kept = [k and not g for k, g in zip(kept, gone, strict=True)]
                    break
            named = any(p == ARTICLE for _, p in lines)
            texts[lines] = "\n\n".join(t for (t, p), k in zip(lines, kept, strict=True) if (p == ARTICLE if named else k))
        for _, page_id, html in members:
            found[page_id] = texts[tuple(lines_of(html))]
    return found


def site(host, count, named=False):
    rng = random.Random(host)
    pages = []
    for i in range(count):
        text = "".join(f"<p>{host} {rng.random()} {i}</p>" for _ in range(rng.randint(1, 6)))
        middle = f"<article>{text}</article>" if named else f'<div class="x">{text}</div>'
        extra = "<div>Subject of the week</div>" if i % 3 else ""
        pages.append((f"https://{host}/{'abc'[i % 3]}/{i}?x={i}", f"<div><a>Home</a> <a>About</a></div>{extra}{middle}<div>All rights {host}</div>"))
    return pages


def test_pages_are_compared_by_url(spark):
    pages = site("one.example", 60) + site("two.example", 7) + site("three.example", 5, named=True)
    pages += [pages[1]] * 20 + [("https://one.example/b/1x", pages[1][1])]  # the same page again, and under another path
    pages += [("https://one.example/b/near", pages[4][1].replace("All rights", "Some rights"))]  # a near copy
    pages += [(None, "<p>alone</p>"), ("https://lone.example/", "<p>one</p>"), ("https://two.example/z", None), ("https://two.example/y", "")]
    rows = [(i, url, html, "k", 1) for i, (url, html) in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, key string, gone int")
    found = {r.page_id: r for r in main_text.main_texts(frame).collect()}
    assert {i: r.text for i, r in found.items()} == plain([r[:3] for r in rows])
    assert all(r.n_chars == len(r.text) and r.url == rows[i][1] for i, r in found.items())
    assert "About" not in found[0].text and "All rights" not in found[0].text and "one.example" in found[0].text
    assert found[1].text == found[len(site("one.example", 60)) + 15].text


def test_pages_that_name_their_article_are_compared_too(spark):
    pages = site("one.example", 12, named=True)
    pages += [pages[3]]
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    keys = {r.key: r.page for r in main_text._keyed(frame, "page_id", "url", "html").collect()}
    gone = {keys[r.key]: r.gone for r in main_text.template_lines(frame).collect()}
    for page_id, _, html in rows:
        assert [lines_of(html)[i][0] for i in gone[page_id] if lines_of(html)[i][0] != "Subject of the week"] == ["Home About", "All rights one.example"]
    # by difference alone the menus are gone; the article is whole by its markup
    assert {r.page_id: r.text for r in main_text.main_texts(frame).collect()} == plain(rows)


def test_own_lines_beside_a_named_article_stay(spark):
    page = "<div>Home</div><main><p>{0} intro</p><article><p>{0} own text of the article</p><p>a quote</p></article><p>{0} after</p></main><nav>{0}</nav><div>Rights</div>"
    pages = [f"https://one.example/{i}" for i in range(4)]
    frame = spark.createDataFrame([(i, url, page.format(i)) for i, url in enumerate(pages)], "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in main_text.main_texts(frame).collect()}
    assert found == {i: f"{i} intro\n\n{i} own text of the article\n\na quote\n\n{i} after" for i in range(4)}


def test_equal_lines_in_other_places_are_other_pages(spark):
    pages = [(f"https://one.example/{i}", f"<div>Home</div><div>{i} own text</div><div>Rights</div>") for i in (1, 3)]
    pages += [(f"https://one.example/{i}", "<div>Home</div><{0}>4 own text</{0}><div>Rights</div>".format(e)) for i, e in ((40, "article"), (41, "nav"))]
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in main_text.main_texts(frame).collect()} == plain(rows)


def test_named_articles_are_whole(spark, sf_dir):
    """The sample pages name their articles, so a plain cut of the html gives the expected text."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = {r.page_id: r for r in QUERIES["op11_html_extraction"](spark, sf_dir).collect()}
    assert found.keys() == pages.keys()
    for page_id, page in pages.items():
        article = re.search("<article>(.*)</article>", page.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert found[page_id].text == "\n\n".join(b for b in blocks if b)


def test_the_same_under_any_partitioning(spark, settings):
    pages = site("one.example", 40) + site("two.example", 9)
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    settings(spark__sql__shuffle__partitions="23", spark__sql__adaptive__enabled="false")
    assert {r.page_id: r.text for r in main_text.main_texts(frame.repartition(5)).collect()} == plain(rows)
