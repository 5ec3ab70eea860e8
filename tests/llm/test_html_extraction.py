import html as entities
import itertools
import re

import duckdb
import pytest

from lakeops.llm import html_extraction as H

SCHEMA = "page_id bigint, url string, html string"
FOLDER = "/root/testdata/sf0.001"


def own_text(page):
    return H.main_text(H.parse(page), {}, set())


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain < text &amp; more", "plain < text & more"), ("<p>a<br>b <b>c</b>\n d<p>e", "a b c d\ne"),
    ("<div>a<p>b</p>c</div>", "a\nb\nc"), ("<p>a<script>x</p></script>b<style>p</style>", "ab"),
    ("<article><header><h1>T</h1></header><p>x</article><footer>f</footer><p>y", "T\nx"),
    ("<nav>n</nav><main><p>m</p><aside>s</aside></main><p>y", "m"), ("<div role=main>m</div><p>y", "m"),
    ("<p>t<div class='cookie-notice'>c</div><ul class=\"main-menu\"><li>m</ul><form>f</form><p>u", "t\nu"),
    ("<article><p>a</p><section id=comments><p>bad</p></section></article>", "a"), ("<p title='a>b'>c</p><!-- <p>no</p> -->", "c"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\nb\nc\nd\ne"), ("<p>cut <b>here</b> <a href='x", "cut here"),
    ("<p>&lt;b&gt; &#233; &am</p>", "<b> é &am"), ("<title>t</title><body><h2>h</h2>z", "h\nz"), ("<p>a <span class=ad>x</span> b", "a\nb")])
def test_pages(page, text):
    assert own_text(page) == text


def test_test_pages_against_markup(spark):
    rows = duckdb.connect().execute(f"SELECT page_id, html FROM '{FOLDER}/pages.parquet'").fetchall()

    def plain(page):
        blocks = re.split(r"</?(?:p|h1)>", page[page.index("<article>") + 9:page.index("</article>")])
        blocks = [" ".join(entities.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
        return "\n".join(b for b in blocks if b)

    found = {r["page_id"]: r["text"] for r in H.extract(spark.read.parquet(f"{FOLDER}/pages.parquet")).collect()}
    assert found == {i: plain(p) for i, p in rows}


def matched(a, b):
    """Simple tree matching by its definition, for nested (label, children) trees."""
    if a[0] != b[0]:
        return 0
    m, n = len(a[1]), len(b[1])
    table = [[0] * (n + 1) for _ in range(m + 1)]
    for i, j in itertools.product(range(m), range(n)):
        table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + matched(a[1][i], b[1][j]))
    return 1 + table[m][n]


def lines(tree, depth=0):
    return "\n".join([f"{depth} {tree[0]}" + (" h" if tree[0] == "#" else ""), *[lines(c, depth + 1) for c in tree[1]]])


def test_matching_against_definition():
    import random
    rng = random.Random(6)

    def tree(depth):
        label = rng.choice("abc") if depth else "html"
        return (label, [tree(depth + 1) for _ in range(rng.randint(0, 4))]) if depth < 3 else ("#", [])

    for _ in range(200):
        a, b = tree(0), tree(0)
        shapes = {}
        match = H.Matching(H.Tree(lines(a), shapes), H.Tree(lines(b), shapes))
        assert match.score(0, 0) == matched(a, b)
        pairs = match.pairs()
        assert len({i for i, _ in pairs}) == len(pairs) == len({j for _, j in pairs})
        ordered = sorted(pairs)
        assert [j for _, j in ordered] == sorted(j for _, j in pairs)


def test_wrappers(spark):
    page = "<body><div><p>Welcome to the site</p></div><section><p>text {0} one</p><p>two {0}</p></section><div><i>All rights</i></div>"
    rows = [(i, f"http://A.example/{i}", page.format(i)) for i in range(9)]
    rows += [(20 + i, "http://a.example/copy", page.format(3)) for i in range(30)]
    rows += [(60, "http://b.example/", page.format(0)), (61, None, page.format(1)), (62, None, None), (None, "odd", "")]
    rows += [(70 + i, f"https://user@c.example:80/{i}", f"<article><p>Same line</p><p>{i}</p></article>") for i in range(8)]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS host", "'y' AS pivot")
    found = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    assert all(found[i] == f"text {i} one\ntwo {i}" for i in range(9)) and all(found[20 + i] == found[3] for i in range(30))
    assert found[60].startswith("Welcome") and found[61].startswith("Welcome") and found[62] == found[None] == ""
    assert all(found[70 + i] == f"Same line\n{i}" for i in range(8))
    assert H.extract(pages.limit(0)).count() == 0


def test_wrapper_decides_inside_articles(spark):
    page = "<article><h1>Shared title</h1><div><p>Share this</p><ul><li>Print</ul></div><div><p>Same line</p><p>text {0}</p></div></article>"
    rows = [(i, f"http://d.example/{i}", page.format(i)) for i in range(9)]
    rows += [(20 + i, f"http://e.example/{i}", f"<article><div>All the same</div></article><p>{i}</p>") for i in range(9)]
    found = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(found[i] == f"Shared title\nSame line\ntext {i}" for i in range(9))
    assert all(found[20 + i] == "All the same" for i in range(9))


def test_only_what_says_the_same_goes(spark):
    own = lambda i, n: "".join(f"<p>own {i} {k}</p>" for k in range(n))
    foot = "<p>Copyright</p>"
    rows = [(i, f"http://f.example/{i}", own(i, 5 if i == 7 else 2) + (f"<p>other {i}</p>" if i == 3 else foot)) for i in range(20)]
    rows += [(50 + i, f"http://g.example/{i}", "<section>" + own(i, 2) + "</section><div>First foot</div>") for i in range(12)]
    rows += [(70 + i, f"http://g.example/b/{i}", "<center>" + own(i, 2) + "</center><dl><dd>Second foot</dl>") for i in range(12)]
    found = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    lines = lambda i, n: [f"own {i} {k}" for k in range(n)]
    assert found[3].split("\n") == [*lines(3, 2), "other 3"] and found[7].split("\n") == lines(7, 5)
    assert all(found[i].split("\n") == lines(i, 2) for i in range(20) if i not in (3, 7))
    assert all(found[s + i].split("\n") == lines(i, 2) for s in (50, 70) for i in range(12))


def test_long_lists_are_aligned_within_bounded_memory(monkeypatch):
    import random
    rng = random.Random(9)

    def page():
        items = [rng.choice(["<p>{}</p>", "<ul><li>{}</ul>", "<div><p>a</p>{}</div>"]).format(rng.choice("abcd")) for _ in range(rng.randint(1, 14))]
        return H.skeleton(H.parse("".join(items)))

    for _ in range(100):
        shapes = {}
        a, b = H.Tree(page(), shapes), H.Tree(page(), shapes)
        match, slots, shown = H.Matching(a, b), a.shown(), b.shown()
        found = []
        for cells in (4_000_000, 6):
            monkeypatch.setattr(H, "ALIGN_CELLS", cells)
            pairs = sorted(match.pairs())
            assert [j for _, j in pairs] == sorted({j for _, j in pairs}) and len(pairs) == len({i for i, _ in pairs})
            found.append(sum(slots[i] == shown[j] for i, j in pairs))
        assert found[0] == found[1] == match.weight(0, 0) % H.PAIR

    monkeypatch.setattr(H, "ALIGN_CELLS", 4_000_000)
    page = lambda own, n: "<h2>top</h2>" + "".join(f"<p>{own} {k}</p>" for k in range(n)) + f"<dl><dd>foot<dd>{own}</dl>"
    shapes = {}
    a, b = (H.Tree(H.skeleton(H.parse("<h3>x</h3>" * k + page(k, n))), shapes) for k, n in ((1, 2300), (2, 2100)))
    slots, shown = a.shown(), b.shown()
    assert [slots[i] for i, j in H.Matching(a, b).pairs() if slots[i] == shown[j]]
    assert len(H.Matching(a, b).pairs()) >= 2100
