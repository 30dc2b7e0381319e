"""Templates of sites and the text of pages."""

import random
from collections import Counter, defaultdict

import pytest

from hustings.llm import html_templates as H

PARSER = H.Parser()


def text_of(page):
    return H.main_text(PARSER.events(page), None)


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""),
        ("plain  words\n only", "plain words only"),
        ("<p>a<p>b &amp; c&nbsp;d<br>e<b>f</b>g", "a b & c d efg"),
        ("<html><head><title>t</title><style>p{}</style></head><body><article><h1>T</h1><p>x</article><footer>f</footer>", "T x"),
        ("<script>var t='</p><article>no</article>'</script><article>yes</article>after", "yes"),
        ("<article>a<!-- <p>b --><p>c</article>", "a c"),
        ("<article>a<!-- never closed <p>b</article>", "a"),
        ("<article>a<script>never closed</article>", "a"),
        ("<article>1 < 2 <p title='x>y'>z</p></div></b></article>", "1 < 2 z"),
        ("<form><article>in a form<form>name?</form></article></form>", "in a form"),
        ("<main><nav>menu</nav><p>a<aside>side</aside><div class='cookie-notice'>ok?</div>b</main><div>out", "a b"),
        ("<main><article>one</article><div class='related'>more</div></main>", "one"),
        ("<article>a<section id='comments'><article class='comment'>nice</article></section>b</article>", "a b"),
        ("<div class='with-sidebar'><article>kept</article><div>not</div></div>", "kept"),
        ("<div class='entry-content'><p>a</div><div>b</div>", "a"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a b c d e"),
        ("<p>a <span class=advert>buy</span>b <wbr>c", "a b c"),
        ("<a", ""),
        ("x<a <", "x"),
        ("<article>&am; &#65;&unknown; &lt;b&gt;</article>", "&am; A&unknown; <b>"),
    ],
)
def test_marks(page, want):
    assert text_of(page) == want


def test_long_and_broken_pages_take_time_in_proportion():
    for page in ("<div>" * 50_000 + "x", "<a" * 200_000, "<!--" * 100_000, "<p>x" * 50_000, "</b>" * 100_000, "<x'" * 60_000 + ">", "<" * 100_000):
        PARSER.events(page)
    assert text_of("<div>" * 50_000 + "deep") == "deep"


def site_page(rng, i, notice="Same words on every page."):
    paragraphs = "".join(f"<p>{' '.join(f'w{rng.randrange(500)}' for _ in range(20))}</p>" for _ in range(rng.randrange(2, 6)))
    links = "".join(f"<li><a href='/{k}'>link {rng.randrange(90)}</a></li>" for k in range(rng.randrange(2, 7)))
    return (
        f"<html><body><div id=top><h2>A site</h2><p>by nobody</p></div><ul>{links}</ul><div id=a{i}><p>{notice}</p>"
        f"<div>{paragraphs}</div></div><div>page {i}</div><p>end</p></body></html>"
    ), " ".join(p.split("</p>")[0] for p in paragraphs.split("<p>")[1:])


@pytest.fixture
def site(spark):
    rng = random.Random(2)
    made = [site_page(rng, i) for i in range(12)]
    rows = [(i, f"https://Site.example.org:8080/{i}", page) for i, (page, _) in enumerate(made)]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), [t for _, t in made]


def test_site_without_marks(site):
    pages, want = site
    got = {r.page_id: r.text for r in H.digest(pages.repartition(3)).collect()}
    assert [got[i] for i in range(len(want))] == want


def test_classes_are_tokens_with_one_vector(site):
    pages, _ = site
    read = pages.select(H.host(H.F.col("url")).alias("host"), "html")
    rows = read.collect()
    assert {r.host for r in rows} == {"site.example.org"}
    vectors = defaultdict(list)
    texts = set()
    for k, r in enumerate(rows):
        events = PARSER.events(r.html)
        texts |= {e[0] for e in events if e[1] is not None}
        for token, n in Counter(e[0] for e in events if e[0]).items():
            vectors[token].append((k, n))
    classes = defaultdict(set)
    for token, vector in vectors.items():
        if len(vector) * 2 >= len(rows) and (token not in texts or len(vector) == len(rows)):
            classes[tuple(vector)].add(token)
    want = {frozenset(c) for c in classes.values() if len(c) >= H.MIN_CLASS}
    made = H.templates(read).first()
    got = {frozenset(t.token for t in c.tokens) for c in made.classes}
    assert got == want and len(got) >= 3
    # The classes of links and of paragraphs are nested in the one of the page.
    root = max(made.classes, key=lambda c: len(c.tokens))
    assert all(c.parent == root["class"] for c in made.classes if c is not root) and root.parent == 0
    assert not made.copies


def test_cut_classes_are_not_valid():
    a, b, c, d = 1, 2, 3, 4
    events = [(t, None, 0, True) for t in (a, c, b, d, a, b)]
    seen = H._walk(events, {a: 10, b: 10, c: 20, d: 20}, {10: 2, 20: 2})
    assert 20 in seen.bad and 10 not in seen.bad
    seen = H._walk(events[:1] + events[2:3] + events[2:3] + events[:1], {a: 10, b: 10}, {10: 2})
    assert 10 in seen.bad  # the other order


def test_pages_that_are_copies_keep_their_text(spark):
    page = "<html><body><article><p>the text</p><p>of all</p></article><div>foot</div></body></html>"
    rows = [(i, "http://c.example.org/", page) for i in range(9)]
    got = H.digest(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [(r.text, r.n_chars) for r in got] == [("the text of all", 15)] * 9


def test_odd_pages(spark, site):
    pages, _ = site
    rows = [(None, None, None), (1, None, "<p>no host"), (1, None, "<p>no host"), (2, "x", ""), (3, "http://y/", "<p>one page"), (4, "http://z/", None)]
    odd = pages.limit(6).unionByName(spark.createDataFrame(rows, pages.schema))
    odd = odd.selectExpr("*", "1 as _host", "2 as text", "3 as _Text", "4 as _classes")
    out, name = H.extract(odd)
    assert out.columns == [*odd.columns, name]
    got = Counter((r.page_id, r[name]) for r in out.where("url is null or length(url) < 10").collect())
    assert got == Counter({(None, ""): 1, (1, "no host"): 2, (2, ""): 1, (3, "one page"): 1, (4, ""): 1})
    assert H.digest(odd.where("false")).collect() == []
