import html
import random
import re
import resource
import time

import pytest
from tests.llm.helpers import SF, by_id

from tidewatt.llm import pages as op
from tidewatt.llm.common import table

SCHEMA = "page_id bigint, url string, html string"


def test_registered_table_against_its_own_layout(spark):
    pages = table(spark, SF, "pages")
    found = by_id(op.main_texts(pages), "page_id")
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|div|ul|li)>", re.sub(r"</?b>", "", body.replace("<br>", " ")))
        expected = "\n\n".join(t for t in (" ".join(html.unescape(x).split()) for x in parts) if t)
        assert found[r.page_id]["text"] == expected
        assert found[r.page_id]["n_chars"] == len(expected)


PAGE = """<html><head><title>T</title></head><body><header class=top>Site</header><nav><a>Home</a></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>One <b>bold</b>
text<p>Two<script>var x = "</p>";</script> &lt;b&gt;<ul><li>a<li>b</ul><aside>Side</aside><form>Form <input></form>
<div class="ad">Buy</div><section id=comments><article>First!</article></section></article>
<div class=sidebar>More</div><footer>F</footer>"""


def test_article_without_the_rest():
    assert op.main_text(PAGE, None, []) == "Head & line\n\nOne bold text\n\nTwo <b>\n\na\n\nb"


def test_odd_pages():
    assert op.main_text("", None, []) == ""
    assert op.main_text("plain  text &nbsp; here", None, []) == "plain text here"
    assert op.main_text("<p>a < b <p>c > d", None, []) == "a < b\n\nc > d"
    assert op.main_text("<script>never closed", None, []) == ""
    assert op.main_text("<!-- never closed <p>x", None, []) == ""
    assert op.main_text("<div>" * 3000 + "deep" + "</div>" * 3000, None, []) == "deep"
    assert op.main_text("<table><tr><td>1<td>2<tr><td>3</table>", None, []) == "1\n\n2\n\n3"


def host_page(k):
    return f"<body><div>Welcome to the site</div><div><p>story number {k}</p><p>about {k * k}</p></div><div>All hosts agree</div></body>"


def test_constant_nodes_are_template_on_pages_without_an_article(spark):
    rows = [(k, f"http://One.example.org/{k}", host_page(k)) for k in range(12)]
    rows += [(100 + k, "https://two.example.org:8080/", "<p>same words</p>") for k in range(2)]
    rows += [(200, None, "<p>no host</p>"), (201, "http://u@three.example.org?x", None), (202, "x", ""), (None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'h' AS host", "1 AS n", "'r' AS reference", "0 AS template")
    found = by_id(op.main_texts(frame), "page_id")
    assert len(found) == len(rows)
    for k in range(12):
        assert found[k]["text"] == f"story number {k}\n\nabout {k * k}"
    assert found[100]["text"] == "same words"  # too few pages to tell template from content
    assert [found[k]["text"] for k in (200, 201, 202, None)] == ["no host", "", "", ""]
    assert op.main_texts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_matching_is_the_heaviest():
    one, two = (op.parse(p) for p in ("<div>a</div><p>b</p><div>c</div>", "<div>c</div><p>b</p>"))
    texts = [{n.number: op.own_text(n) for n in op.aligned_nodes(t)} for t in (one, two)]
    pairs = [(texts[0][a.number], texts[1][b.number]) for a, b in op.matched(one, two, *texts)]
    assert sorted(pairs) == [("", ""), ("a", "c"), ("b", "b")]


def article_page(k):
    return (f'<body><article id="post-{k}"><div>Share this <a>here</a></div><h1>Title {k}</h1><p><b>Note</b> story {k * k}</p>'
            f'<div>Read more</div><p>end {k}<p>Get our letter</article></body>')


def test_constant_nodes_of_an_article_are_template(spark):
    rows = [(k, f"http://one.example.org/{k}", article_page(k)) for k in range(12)]
    found = by_id(op.main_texts(spark.createDataFrame(rows, SCHEMA)), "page_id")
    for k in range(12):
        assert found[k]["text"] == f"Title {k}\n\nNote story {k * k}\n\nend {k}"


def test_what_varies_below_a_constant_line_stays():
    pages = [f"<div>Site line<article>By us<p>story {k}</p></article></div>" for k in range(2)]
    numbers = [n for n, _ in op.same_text_pairs(op.parse(pages[0]), op.reference_tree(pages[1]))]
    assert len(numbers) == 2
    assert op.main_text(pages[0], pages[1], numbers) == "story 0"


def test_names_do_not_remove_articles_headings_or_paragraphs():
    text = "Work\n\nold\n\n30 days\n\n5 euros"
    inside = "<h2 id='related'>Work</h2><p class=promo>old</p><section id=notice-period>30 days</section><p class=share-price>5 euros</p>"
    for start in (
        "<article class='post comments-open'>", "<article class=comments>", "<div class='content no-sidebar'><article>",
        "<div class=sidebar><article>", "<div class=sidebar><main>", "<main><div class=sidebar><article>",
    ):
        assert op.main_text(f"<body>{start}{inside}", None, []) == text
    rest = "<div id=comments><article>First!</article></div>"
    assert op.main_text(f"<body><article>{inside}</article>{rest}", None, []) == text
    assert op.main_text(f"<body><article>{inside}<div class='x comments'>one</div></article>", None, []) == text
    assert op.main_text(f"<body><main>{inside}</main>{rest}", None, []) == text


def test_deep_nests_lose_and_add_nothing():
    deep = "<div>" * 150 + "<nav>menu</nav>in<aside>side</aside>" + "</div>" * 150
    page = f"<div><article><p>first</p>{deep}<p>last</p></article><p>out</p></div>"
    assert op.main_text(page, None, []) == "first\n\nin\n\nlast"
    nest = "<div>" * 3000 + "<p>same</p><p>{}</p>" + "</div>" * 3000
    one, two = (f"<article>{nest.format(k)}<p>end {k}</p></article>" for k in "ab")
    numbers = [n for n, _ in op.same_text_pairs(op.parse(one), op.reference_tree(two))]
    assert op.main_text(one, two, numbers) == "a\n\nend a"


def test_blocks_that_the_reference_lacks_second_layouts_and_copies(spark):
    def page(k):
        notice = "<div>We moved</div>" if k % 3 else ""
        return f"<body><div>Top line</div>{notice}<p>story {k}</p></body>"

    def second(k):
        return f"<body class=shop><p>thing {k}</p><div>Prices with tax</div><div>Back to shop</div></body>"

    url = "http://one.example.org/"
    rows = [(k, url, page(k)) for k in range(30)] + [(100 + k, url, second(k)) for k in range(5)]
    rows += [(200 + k, f"{url}{k}", "<body class=copied><p>a line</p><p>the article</p></body>") for k in range(40)]
    rows += [(300 + k, url, f"<body class=copied><p>other {k}</p><p>words {k}</p></body>") for k in range(5)]
    found = by_id(op.main_texts(spark.createDataFrame(rows, SCHEMA)), "page_id")
    assert len(found) == len(rows)
    assert [found[k]["text"] for k in range(30)] == [f"story {k}" for k in range(30)]
    assert [found[100 + k]["text"] for k in range(5)] == [f"thing {k}" for k in range(5)]
    assert {found[200 + k]["text"] for k in range(40)} == {"a line\n\nthe article"}
    assert [found[300 + k]["text"] for k in range(5)] == [f"other {k}\n\nwords {k}" for k in range(5)]


def tree(rng, depth=3):
    node = op.Node("div", rng.choice(["div", "div x", "p"]), "")
    node.pieces = [rng.choice(["", "a", "b"])]
    for _ in range(rng.randrange(4) if depth else 0):
        child = tree(rng, depth - 1)
        node.children.append(child)
        node.pieces.append(child)
    return node


def numbered(root):
    nodes = op.aligned_nodes(root)
    return {n.number: op.own_text(n) for n in nodes}


def best_weight(a, b, texts, others):
    """The heaviest of all matchings, every pairing of children in order tried."""

    def pairings(left, right):
        if not left or not right:
            return 0
        best = max(pairings(left[1:], right), pairings(left, right[1:]))
        if left[0].name == right[0].name:
            best = max(best, best_weight(left[0], right[0], texts, others) + pairings(left[1:], right[1:]))
        return best

    return 1 + 0.5 * (texts[a.number] == others[b.number]) + pairings(a.children, b.children)


@pytest.mark.parametrize("seed", range(40))
def test_matching_is_the_heaviest(seed, monkeypatch):
    rng = random.Random(seed)
    one, two = tree(rng), tree(rng)
    texts, others = numbered(one), numbered(two)
    expected = best_weight(one, two, texts, others)
    seen = []
    for small in (10**9, 0):  # by lists, by arrays
        monkeypatch.setattr(op, "SMALL_TABLE", small)
        assert op.weight(one, two, texts, others, {}) == expected
        pairs = op.matched(one, two, texts, others)
        assert sum(1 + 0.5 * (texts[a.number] == others[b.number]) for a, b in pairs) == expected
        seen.append([(a.number, b.number) for a, b in pairs])
    assert seen[0] == seen[1]


def test_large_pages_take_bounded_time_and_memory():
    page, other = (f"<ul>{''.join(f'<li>item {k}' for k in range(0, 20_000, step))}</ul>" for step in (1, 4))
    before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.process_time()
    found = op.same_text_pairs(op.parse(page), op.reference_tree(other))
    assert len(found) == 5000 and time.process_time() - start < 10
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000
    start = time.process_time()
    op.parse("<i><div>" * 4000 + "</b></p></td>" * 4000)
    assert time.process_time() - start < 2


def test_pages_of_a_layout_have_one_key():
    page = "<body class='top wide'><div class=box12><article><div class=inner>{}</div></article></div><script>{}</script>"
    keys = [op.page_keys(op.parse(page.format(text, script))) for text, script in (("a  b", "x"), ("a b", "y"), ("c", "x"))]
    assert keys[0] == keys[1] != keys[2] and keys[0][0] == keys[2][0]
    assert op.page_keys(op.parse(page.replace("wide", "slim")))[0] != keys[0][0]


def test_pages_carry_no_reference_text_and_texts_are_the_same_either_way(spark, monkeypatch):
    """Below the bound a reference goes to each process once; beyond it, beside the pages, with the same texts."""
    schema = "page_id bigint, url string, html string"
    rows = [(k, f"http://{'ab'[k % 2]}.example/{k}", host_page(k)) for k in range(24)] + [(99, None, None)]
    pages = spark.createDataFrame(rows, schema).repartition(3)
    groups = spark.createDataFrame([("h", 0, 7, "<p>a reference")], "host string, kind bigint, id bigint, reference string")
    page = spark.createDataFrame([("h", 0, "<p>x")], "host string, kind bigint, html string")
    texts, seen = [], []
    for bound in (op.MAX_BROADCAST_BYTES, 0):
        monkeypatch.setattr(op, "MAX_BROADCAST_BYTES", bound)
        met, read = op.with_group(page, groups, ["html", "id", "reference"])
        row = met.first()
        seen.append((row.reference, read(row.id, row.reference)))
        texts.append(sorted((r.page_id, r.url, r.text, r.n_chars) for r in op.main_texts(pages).collect()))
    assert texts[0] == texts[1] and len(texts[0]) == 25
    assert seen == [(None, "<p>a reference"), ("<p>a reference", "<p>a reference")]
