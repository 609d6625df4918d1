"""Main text of hand-written pages, of pages without markup for it, and of broken ones; marginals against enumeration."""

import itertools

import numpy as np
import pytest

from pitlake.llm import page_text

PLAIN = """<!DOCTYPE html><html><head><title>T &amp; more</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1><nav><ul><li><a href=/>Home</a><li><a href=/b>Other</a></ul></nav></header>
<div class="cookie-notice">We use cookies here.</div><div id="main-content"><h1>A title of the page</h1>
<p>First   paragraph, which is&nbsp;long
enough &lt;here&gt;.<p>Second <a href="x">linked</a> pa<b>rag</b>raph;<br>it ends.</div>
<aside><p>Read this other story, it is good.</p></aside><div class="ad">Buy this, now.</div>
<section id="comments"><p>What an article, thanks a lot for it.</p></section>
<form><label>Mail</label><input></form><footer>&copy; Site. All rights reserved.</footer></body></html>"""
EXPECTED = "A title of the page\nFirst paragraph, which is long enough <here>.\nSecond linked paragraph; it ends."


def labelled(i):
    return f"<body><nav><a href=/{i}>Menu {i}</a></nav><article><h1>Head {i}</h1><p>Some text, of page {i}.</p></article><footer>End {i}</footer>"


@pytest.fixture(scope="module")
def model():
    return page_text.fit([labelled(i) for i in range(40)])


def test_page_without_article(model):
    assert page_text.texts([PLAIN], model) == [EXPECTED]
    assert page_text.texts([PLAIN], page_text.prior_potentials()) == [EXPECTED]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""), ("<article>", ""), ("<!-- <p>Not this, at all.</p>", ""), ("<script>x<p>never", ""),
        ("<article><p>Open, but never closed", "Open, but never closed"), ("<p>Just a line, with words.", "Just a line, with words."),
        ('<article><p title="a > b">Quoted, and good.</p></article>', "Quoted, and good."),
        ("<article><p>One, two.</p><nav><a href=x>Menu</a></nav><p>Three, four.</p></article>", "One, two.\nThree, four."),
        ("<article><p hidden>Not shown, at all.</p><p>Shown, as it is.</p></article>", "Shown, as it is."),
        ("<article><p>Kept, so far. " + "long words, " * 20_000 + "</p></article>", "Kept, so far. " + ("long words, " * 20_000).strip()),
    ],
)
def test_odd_pages(model, source, text):
    assert page_text.texts([source], model) == [text]


def test_deep_and_wide_pages(model):
    assert page_text.texts(["<div>" * 3000 + "A deep text, with words."], model) == ["A deep text, with words."]
    assert len(page_text.texts(["<" * 20_000, "<a '" * 5000, "<p>" * 20_000], model)) == 3


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(2)
    parent = np.array([-1, 0, 0, 1, 1, 2, 5])
    depth = np.array([0, 1, 1, 2, 2, 2, 3])
    x = np.zeros((7, len(page_text.PRIOR)))
    x[:, 0] = 1
    x[:, 1:4] = rng.normal(size=(7, 3))
    group = np.array([0, 0, 1, 1, 0, 1, 1])
    model = page_text.Potentials(rng.normal(size=len(page_text.PRIOR)), rng.normal(size=(2, 2, 2)))
    own = x @ model.weights
    weight, total = np.zeros(7), 0.0
    for labels in itertools.product((0, 1), repeat=7):
        score = sum(own[i] * labels[i] for i in range(7))
        score += sum(model.pair[group[i], labels[parent[i]], labels[i]] for i in range(1, 7))
        weight += np.exp(score) * np.array(labels)
        total += np.exp(score)
    trees = page_text.Forest(parent, depth, x, group, np.array([0, 7]))
    np.testing.assert_allclose(page_text.marginals(trees, model), weight / total, rtol=1e-9)


def test_extract_table(spark):
    rows = [(1, "u", PLAIN, "clash"), (2, None, None, "c"), (3, "v", "", "c"), (1, "u", PLAIN, "clash"), (None, "w", PLAIN, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted((r.page_id, r.url, r.text, r.n_chars) for r in page_text.extract(pages).collect())
    assert found == [(1, "u", EXPECTED, len(EXPECTED))] * 2 + [(2, None, "", 0), (3, "v", "", 0)]
    assert page_text.extract(pages.limit(0)).count() == 0
