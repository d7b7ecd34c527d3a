"""Main text of pages, and the cut against all labellings."""

import random
import re
from itertools import product

import numpy as np
import pytest

from chemlake.llm import html_text

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header class='site'>Site <a href=/>Home</a></header>"
    "<div class=\"cookie-notice\">We use cookies.</div><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav><main><article><header><h1>Head &eacute;&amp</h1></header>"
    "<p>Para  one&nbsp;is <b>bo</b>ld, and\nlong enough.<p>Para two<br>x</p><!-- no --><div class=\"ad\">Buy</div><aside>side</aside><ul><li>i1<li>i2 &#x41;</ul>"
    "<section id=comments><p>Nice, a comment. It is long, too.</p></section><form><label>Name</label></form></article></main>"
    "<div class=sidebar><p>other</p></div><footer>&copy; f</footer><script>x=\"<p>no</p>\"</script></body></html>"
)
WANT = "Head é&\n\nPara one is bold, and long enough.\n\nPara two x\n\ni1\n\ni2 A"


def test_minimum_cut_equals_best_of_all_labellings():
    r = random.Random(4)
    for _ in range(300):
        n = r.randint(1, 7)
        source, sink = [r.randint(0, 5) * 1.0 for _ in range(n)], [r.randint(0, 5) * 1.0 for _ in range(n)]
        links = [(i, j, r.randint(0, 4) * 1.0) for i in range(n) for j in range(i + 1, n) if r.random() < 0.5]
        cost = lambda kept: sum(sink[i] if k else source[i] for i, k in enumerate(kept)) + sum(w for a, b, w in links if kept[a] != kept[b])  # noqa: B023, E731
        assert cost(html_text.minimum_cut(source, sink, links)) == min(map(cost, product((False, True), repeat=n)))


def test_pages_and_edge_cases(spark):
    bare = "<body><div id=menu><a href=1>One</a> <a href=2>Two</a></div><div class=post><p>The first paragraph, which is long enough, says a lot. And more.<p>Short.<p>Another long one, with commas, and words; it goes on.</div>"
    rows = [(i, "u", PAGE, 1) for i in range(20)] + [(100, "u", bare, 1), (101, "u", None, 1), (102, "u", "", 1), (103, "u", "<article>x <p", 1), (103, "u", "<article>x <p", 1)]
    out = {x.page_id: x.text for x in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()}
    assert {out[i] for i in range(20)} == {WANT} and out[101] == out[102] == "" and out[103] == "x"
    assert out[100].startswith("The first") and out[100].endswith("it goes on.") and "One" not in out[100]
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, html string")).collect() == []


@pytest.mark.parametrize("html", ["<" * 100_000, "<a " * 100_000, "<div>" * 30_000 + "x" + "</p>" * 30_000, '<a href="' * 50_000, "<script>" * 30_000, "<p>x, y.<div class=ad>q</div>" * 3_000])
def test_long_pages_end(html):
    html_text.main_text(html, html_text.untrained())


LONG = "The body of this page, which is a text of some length, says one thing and then another, with commas, and stops. It goes on, as texts do, for a while. So it is."


def test_looks_outvote_article_elements():
    body = f"<div class=post><p>{LONG}</p><p>{LONG}</p></div>"
    links = "".join(f"<li><a href={i}>Link {i}</a></li>" for i in range(6))
    for mark in ("<article>", "<article class='teaser card'>", "<article class=comment>"):
        text = html_text.main_text(f"<body>{body}<div>{mark}<ul>{links}</ul></article></div></body>", html_text.untrained())
        assert text == f"{LONG}\n\n{LONG}", mark


def test_words_of_class_and_id_can_be_outvoted():
    html = f"<article><h2 id=search-algorithms>Search algorithms, in short.</h2><section id=related-work><p>{LONG}</p></section><div class=long-form><p>With <math><mi>x</mi><mo>=</mo><mn>2</mn></math>. {LONG}</p></div><div class=ad>Buy</div><div role=search>{LONG}</div></article>"
    assert html_text.main_text(html, html_text.untrained()) == f"Search algorithms, in short.\n\n{LONG}\n\nWith x=2. {LONG}"


def made_page(r):
    """A page in which the markup says what is what, and short paragraphs stand among long ones."""
    text = lambda low, high: " ".join(r.choice(["some", "words", "of a", "text,", "that", "goes", "on."]) for _ in range(r.randint(low, high))) + "."
    links = "".join(f"<li><a href={i}>{text(1, 3)}</a></li>" for i in range(r.randint(3, 8)))
    body = "".join(f"<p>{text(1, 3) if r.random() < 0.4 else text(20, 60)}</p>" for _ in range(r.randint(3, 9)))
    return f"<body><nav><ul>{links}</ul></nav><div class=ad>{text(4, 9)}</div><article><h1>{text(2, 4)}</h1>{body}</article><footer>{text(2, 4)}</footer></body>"


def bare_page(html):
    return re.sub(r"<(/?)(nav|ul|li|article|footer|h1|p)\b", r"<\1div", html.replace(" class=ad", ""))


def test_the_cut_changes_labels_and_texts_for_the_better(spark):
    r = random.Random(11)
    pages = [made_page(r) for _ in range(200)]
    model = html_text.train(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string"))
    changed = wrong_signs = wrong_cut = 0
    for html in pages:
        page, bare = html_text.read_page(html), html_text.read_page(bare_page(html))
        truth = [html_text.state(page, b) == "inside" for b in page.blocks]
        assert html_text.main_text(html, model) == "\n\n".join(b.text for b, t in zip(page.blocks, truth, strict=True) if t)
        boilerplate, content = html_text.capacities(bare, model)
        signs, cut = [b > c for b, c in zip(boilerplate, content, strict=True)], html_text.minimum_cut(boilerplate, content, html_text.edges(bare, model))
        changed += sum(a != b for a, b in zip(signs, cut, strict=True))
        wrong_signs += sum(a != b for a, b in zip(signs, truth, strict=True))
        wrong_cut += sum(a != b for a, b in zip(cut, truth, strict=True))
    assert changed > 100 and wrong_cut < 0.7 * wrong_signs, (changed, wrong_signs, wrong_cut)


def test_extraction_equals_a_plain_reading_of_made_pages(spark):
    r = random.Random(12)
    pages = [(i, made_page(r)) for i in range(60)] * 2
    got = html_text.extract_text(spark.createDataFrame(pages, "page_id long, html string")).collect()
    plain = lambda html: "\n\n".join(re.sub("<[^>]*>", "", x) for x in re.findall(r"<(?:h1|p)>.*?</", html.partition("<article>")[2]))
    assert [x.text for x in sorted(got)] == [plain(h).replace("</", "") for _, h in sorted(pages)]


def test_smooth_edges_are_learnt_from_labels():
    alike, unlike = np.zeros(len(html_text.SMOOTH)), np.zeros(len(html_text.SMOOTH))
    alike[2], unlike[3] = 1e6, 1e6
    w = html_text.fit_smooth(alike, unlike)
    assert w[2] == html_text.MOST_SMOOTH and w[3] == 0 and abs(w[5] - html_text.SMOOTH[5]) < 1e-9
