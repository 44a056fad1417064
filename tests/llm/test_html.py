"""Main text of pages: hand-made pages, the graphical model against enumeration, and the sample."""

from __future__ import annotations

import html
import itertools
import math
import re

import pytest

from givingledger.llm import html_text
from givingledger.llm.html_text import Node, main_text, make_model, marginals, prior_counts, tree

FOLDER = "/root/testdata/sf0.001"
MODEL = make_model(prior_counts())


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        (None, ""),
        ("", ""),
        ("<article><h1>A &amp; B</h1><p>one\n two<br>three<p>four</article>", "A & B\none two three\nfour"),
        ("<body><nav><a href=x>menu</a></nav><article><p>text <b>bold</b>, <i>it</i></p></article><footer>f</footer>", "text bold, it"),
        ("<article><p>kept</p><div class='comments'><p>first!</p></div><aside>side</aside><form>f</form></article>", "kept"),
        ("<script>var x='<article><p>no</p></article>'</script><article><p>cut off &am", "cut off &am"),
        ("<article><p>cut &amp", "cut &"),
        ("<article><p>cut <b", "cut"),
        ("<div class='with-sidebar'><main><p>a</p><p class='ad'>b</p></main></div><div class=sidebar><p>c</p></div>", "a"),
        ("<article><ul><li>a<li>b</ul><!-- no --><p>c", "a\nb\nc"),
    ],
)
def test_pages(source, expected):
    assert main_text(source, MODEL) == expected


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("<article><p>a <svg width='1'/> b</p><p>c</p></article>", "a b\nc"),
        ("<article><p>a <math/> b</p><p>c</p></article>", "a b\nc"),
        ("<article><p>a <svg><g><path d='x'/><title>t</title><text>no</text></g></svg> b</p><p>c</p></article>", "a b\nc"),
        ("<article><p>a <svg><g><p>b</p></article>", "a\nb"),
        *[(f"<article><p>a <{t}>no</p><p>b</p><div><{t}>no</div><p>c</p></article>", "a\nb\nc") for t in ("button", "select", "video", "audio", "canvas", "noscript")],
        ("<body><div><button>menu</div><article><p>a</p></article>", "a"),
        ("<body><button>menu<article><p>a</p></article>", "a"),
        ("<article><p>a <a href=x>l <svg><path></a> b</p></article>", "a l b"),
        ("<article><p>a <button><div>no</div></button> b</p><p><template><p>no</p></template>c</p></article>", "a b\nc"),
        ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><p><object>c</object> d</p></article>", "so x=2 holds\nc d"),
        ("<article><p>a</p><textarea>no</p><p>no", "a"),
        ("<article><p>a <select><option>1<option>2</select> b</p></article>", "a b"),
    ],
)
def test_skipped_elements_end(source, expected):
    assert main_text(source, MODEL) == expected


def test_marginals_are_those_of_the_whole_tree():
    nodes = [Node(-1, "html", []), Node(0, "div", ["a"]), Node(0, "p", ["b"]), Node(1, "#", ["c"]), Node(1, "#", ["b"]), Node(2, "#", [])]
    model = html_text.Model({"a": 0.7, "b": -1.1, "c": 0.4}, (((0.8, 0.2), (0.3, 0.7)), ((0.6, 0.4), (0.1, 0.9))))
    weight = [[0.0, 0.0] for _ in nodes]
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        w = math.exp(sum(model.odds.get(f, 0) for n, x in zip(nodes, labels, strict=True) for f in n.features if x))
        for node, label in zip(nodes[1:], labels[1:], strict=True):
            w *= model.passed[node.tag in html_text.CONTAINERS][labels[node.parent]][label]
        for i, label in enumerate(labels):
            weight[i][label] += w
    assert marginals(nodes, model) == pytest.approx([b / (a + b) for a, b in weight])


def test_sample(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    found = html_text.main_texts(pages).collect()
    assert len(found) == len(sources)
    for row in found:
        article = re.sub(r"<[^<>]*$", "", re.search(r"<article>(.*?)(</article>|\Z)", sources[row.page_id], re.S)[1])
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n".join(filter(None, blocks))
        assert row.n_chars == len(row.text)


def test_edge_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, "<p>", "x"), (2, "u", "<main><p>" + "long text " * 50000, "x"), (2, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.main_texts(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in found.collect()) == [0, 0, 0, 499999]
    assert html_text.main_texts(pages.limit(0)).collect() == []
    assert len(tree("<div>" * 3000)) == 3001
