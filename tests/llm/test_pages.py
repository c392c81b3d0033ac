from __future__ import annotations

import html
import random
import re

import duckdb
import pytest

from eventlake.llm import pages
from eventlake.llm.catalog import QUERIES


def text(page):
    return "\n\n".join(t for t, z in pages.blocks(page) if z != pages.DROP)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a <b>b<br>c</b>&nbsp;d\n e<p>f", "a b c d e\n\nf"),
        ("<article>x&lt;y &#233; &#x1F600; &amp;lt; &copy &notanentity; &am</article>", "x<y é 😀 &lt; © ¬anentity; &am"),
        ("<nav><ul><li>menu</ul></nav><article><h1>T</h1><p>a</article><footer>f</footer>", "T\n\na"),
        ("<header>site</header><main><article><header><h1>T</h1></header><p>a</p></article></main>", "T\n\na"),
        ("<article><p>a</p><div class='ad box'>buy<div>more</div></div><p>b</p><aside>s</aside><form>f</form></article>", "a\n\nb"),
        ("<article><p>a<section id=comments><article>c</article></section></article>", "a"),
        ("<article>a<script>if (a < b) '</p>'</script><style>p{}</style><!-- <p>c --> d</article>", "a d"),
        ("<article><p>a</p><div hidden>h</div><div style='display: none'>n</div><p aria-hidden=true>x</p></article>", "a"),
        ("<div role=navigation>n</div><div class=cookie-notice>c</div><div id=content><p>a<p>b</div>", "a\n\nb"),
        ("<head><title>t</title><body><article>a", "a"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\n\nb\n\nc\n\nd"),
        ("a < b and 3<4 <unclosed", "a < b and 3<4"),
        ("<ARTICLE CLASS=\"x\"><P>a</P></ARTICLE><DIV>beside</DIV>", "a"),
        ("<article><p>cut in the middle &amp", "cut in the middle &"),
        ("</div></p>a</span>", "a"),
        ("<article><p>a <a href='x>y'>b</a></p></article>", "a b"),
    ],
)
def test_markup(page, want):
    assert text(page) == want


def test_random_markup_never_fails():
    rng = random.Random(2)
    parts = ["<p>", "</p>", "<div class=ad>", "</div>", "<article>", "</article>", "<!--", "-->", "<script>", "</script>", "&amp;", "&#0;", "<", ">", "x ", "<li>", "<ul>", "</ul>", "\"", "'", "<td>", "<a href=\""]
    for _ in range(2000):
        pages.blocks("".join(rng.choice(parts) for _ in range(rng.randint(0, 30))))


def longest(a, b):
    row = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            row[i][j] = row[i - 1][j - 1] + 1 if x == y else max(row[i - 1][j], row[i][j - 1])
    return row[-1][-1]


@pytest.mark.parametrize("seed", range(40))
def test_common_subsequence(seed):
    rng = random.Random(seed)
    letters = range(rng.choice([1, 2, 5, 40]))
    a, b = ([rng.choice(letters) for _ in range(rng.randint(0, 60))] for _ in range(2))
    found = pages.common(a, b)
    assert found == sorted(set(found)) and len(found) == longest(a, b)
    rest = iter(b)
    assert all(any(a[i] == y for y in rest) for i in found)


@pytest.fixture()
def table(spark):
    def build(rows):
        return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text long")

    return build


def extracted(df):
    return {(r.page_id, r.url): (r.text, r.n_chars) for r in pages.main_text(df).collect()}


def test_template_lines_go_by_comparison(table):
    rows = []
    for i in range(30):
        own = f"<p>story {i} of its own<p>more of {i}"
        rows.append((i, f"http://h.example/{i:03d}", f"<div>Welcome to this site</div>{own}<div>All rights reserved</div>"))
    rows.append((50, "http://alone.example/x", "<div>Welcome to this site</div><p>only"))
    out = extracted(table(rows))
    for i in range(30):
        assert out[i, rows[i][1]][0] == f"story {i} of its own\n\nmore of {i}"
    assert out[50, rows[-1][1]][0] == "Welcome to this site\n\nonly"


def test_a_phrase_amid_an_article_stays(table):
    rows = [
        (i, f"http://h/{i}", f"<div>site name</div><p>own {i}<p>{'known phrase' if i in (2, 3) else f'other {i}'}<p>end {i}<div>imprint</div>")
        for i in range(6)
    ]
    out = extracted(table(rows))
    assert out[2, "http://h/2"][0] == "own 2\n\nknown phrase\n\nend 2" and out[4, "http://h/4"][0] == "own 4\n\nother 4\n\nend 4"


def test_main_is_kept_unless_an_article_decides(table):
    rows = [(i, f"http://h/{i}", f"<main><p>shared line<p>own {i}</main><div>beside</div>") for i in range(4)]
    rows += [(10 + i, f"http://x/{i}", f"<main><p>top line<article><p>own {i}</article><p>below</main>") for i in range(4)]
    out = extracted(table(rows))
    assert out[1, "http://h/1"][0] == "shared line\n\nown 1"
    assert out[11, "http://x/1"][0] == "own 1"


def test_copies_of_a_page_keep_their_text(table):
    body = "<div>head line</div><p>text a<p>text b<p>text c<p>text d<p>text e"
    out = extracted(table([(1, "http://h/1", body), (2, "http://h/2", body)]))
    assert out[1, "http://h/1"][0].startswith("head line\n\ntext a")


def test_lines_of_an_article_stay_even_if_shared(table):
    rows = [(i, f"http://h/{i}", f"<nav>m</nav><article><p>shared line<p>own {i}</article>") for i in range(5)]
    assert extracted(table(rows))[3, "http://h/3"] == ("shared line\n\nown 3", 18)


def test_edge_cases(table):
    rows = [(1, None, None), (2, "", ""), (None, "http://h/a", "<p>x"), (3, "no url at all", "<p>y"), (3, "no url at all", "<p>y"), (4, "http://h/b", "word " * 300_000)]
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in pages.main_text(table(rows)).collect())
    big = ("word " * 300_000).strip()
    assert got == sorted([("1", "", 0), ("2", "", 0), ("None", "x", 1), ("3", "y", 1), ("3", "y", 1), ("4", big, len(big))])
    assert pages.main_text(table([])).count() == 0


def test_query_against_a_reader_of_these_pages(spark):
    """The given pages are simple: what their one article holds, tag by tag."""
    sf = "/root/testdata/sf0.001"
    want = {}
    for page_id, url, page in duckdb.sql(f"SELECT page_id, url, html FROM '{sf}/pages.parquet'").fetchall():
        body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
        body = re.sub(r"<[^>]*\Z", "", body)
        parts = [html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"<br>", " ", p))) for p in re.split(r"</?(?:p|h1)>", body)]
        want[page_id] = (url, "\n\n".join(" ".join(p.split()) for p in parts if p.split()))
    rows = QUERIES["op10_pages"](spark, sf).collect()
    assert {r.page_id: (r.url, r.text) for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)
