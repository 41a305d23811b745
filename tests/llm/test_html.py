import html
import itertools
import random
import re
import time

import numpy as np
import pytest

from tarn.llm import html as H


@pytest.fixture(scope="module")
def model():
    return H.default_model()


def article(page):
    """What the test table's pages show as their article, cut out by hand for their one layout."""
    a, b = page.find("<article>"), page.find("</article>")
    inside = page[a + 9 : b if b >= 0 else len(page)]
    inside = re.sub(r"<[^>]*$", "", inside) if b < 0 else inside
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(p for p in parts if p)


def test_table_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in H.extract_text(pages).collect()}
    assert len(got) == len(want)
    assert np.mean([got[k].text == v for k, v in want.items()]) > 0.99
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_unseen_layouts(model):
    right = [H.extract_batch([p], model)[0] == "\n\n".join(" ".join(x.split()) for x in main) for p, main in H.synthetic_pages(150, seed=77)]
    assert np.mean(right) > 0.85


def test_decoding_is_consistent_and_best():
    rng = np.random.default_rng(2)
    for _ in range(200):
        root = H.Node("html", None, "", 0)
        nodes = [root]
        for _ in range(rng.integers(1, 8)):
            nodes.append(H.Node("div", nodes[rng.integers(len(nodes))], "", 0))
        nodes = H._walk(root)
        margin = rng.standard_normal(len(nodes)) * 2
        kept = H.decode(nodes, margin)
        cost = lambda k: sum(np.logaddexp(0, -m if x else m) for x, m in zip(k, margin, strict=True))
        fine = lambda k: k[0] and all(not k[n.index] or k[n.parent.index] for n in nodes[1:])
        every = [[bool(b >> i & 1) for i in range(len(nodes))] for b in range(1 << len(nodes))]
        assert fine(kept) and cost(kept) <= min(cost(k) for k in every if fine(k)) + 1e-9


def test_parsing():
    def keep(page):
        nodes = H._walk(H.parse(page))
        return H.blocks(nodes[0], [True] * len(nodes))

    assert keep("<p>a &amp; b&nbsp;c<br>d<p>e <b>f</b>g<!-- x --><script>var p='<p>'</script>h") == ["a & b c d", "e fgh"]
    assert keep("x<div>y<span>z</span><ul><li>1<li>2</ul>w</div>v") == ["x", "yz", "1", "2", "w", "v"]
    assert keep('<p title="a>b" class=\'c>d\'>t</p></div></p>u <a href="x">v') == ["t", "u v"]
    assert keep("a < b <p>c</p><p") == ["a < b", "c"]
    assert keep("<head><title>t</title></head><body>b<select><option>o</select><!-- cut") == ["b"]
    assert keep('<p class="cut>a') == ["a"]
    assert keep("&am") == ["&am"] and keep("") == []
    assert keep("<div>" * 3000 + "x") == ["x"]


def test_odd_rows(spark):
    rows = [(1, None, None, "a"), (2, "u", "", "b"), (2, "u", "", "b"), (None, "u", "<article><p>Some text. More of it.</p></article>", "c"), (4, None, "<p>" + "word, " * 50_000, "d")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract_text(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got)[1:4] == [(1, 0), (2, 0), (2, 0)] and len(got) == 5
    assert H.extract_text(df.limit(0)).count() == 0


def _named(nodes):
    """Children's sibling statistics by plain counting: share of the same name, position."""
    return [(sum(x.name == n.name for x in n.parent.children) / len(n.parent.children), n.parent.children.index(n) / len(n.parent.children)) for n in nodes[1:]]


@pytest.mark.parametrize("count", [63, 64, 300, 2000])
def test_long_articles_are_kept_whole(model, count):
    texts = [f"Paragraph number {k} of a long piece, with a few plain words in it. And one more sentence." for k in range(count)]
    page = "<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>About</a></li></ul></nav><article><h1>A long piece of writing</h1>" + "".join(f"<p>{t}</p>" for t in texts) + "</article><footer>&copy; site.example</footer></body></html>"
    assert H.extract_batch([page], model)[0].split("\n\n") == ["A long piece of writing", *texts]
    nodes = H._walk(H.parse(page))
    rows = H.node_features(nodes)
    assert [(r[H.KINDS + 11], r[H.KINDS + 9]) for r in rows[1:]] == _named(nodes)


def test_unclosed_hidden_elements_end():
    def keep(page):
        root = H.parse(page)
        return H.blocks(root, [True] * len(H._walk(root)))

    rest = "<article><p>text</p></article>"
    for hidden in ("button", "select", "template", "datalist"):
        assert keep(f"<div><{hidden}>gone</div>{rest}") == ["text"]
    for hidden in ("button", "template"):  # a select can't hold blocks
        assert keep(f"<div><{hidden}><div>gone</div><p>gone</{hidden}>stays</div>{rest}") == ["stays", "text"]
    for control in ("button", "select"):
        assert keep(f"<body><{control}>gone{rest}") == ["text"]
    assert keep(f"<div><label>Search<input></div>{rest}") == ["Search", "text"]
    for plain in ("label", "math", "svg", "object", "canvas", "video"):
        assert keep(f"<article><p>a <{plain}>b</{plain}> c</p></article>") == ["a b c"] and keep(f"<div><{plain}></div>{rest}") == ["text"]
    assert keep("<head><title>t</title><p>text") == ["text"] and keep("<head><meta x><title>t</title>text") == ["text"]
    assert keep("<head>\n<noscript><link x></noscript>\n<style>s</style></head>b") == ["b"]


def test_text_that_is_neither_form_script_nor_style_is_parsed(model):
    def keep(page):
        root = H.parse(page)
        return H.blocks(root, [True] * len(H._walk(root)))

    assert keep("<article>a<noscript><p>b &amp; c</p>d</noscript>e</article>") == ["a", "b & c", "de"]
    assert keep("<head><noscript>s</noscript></head><noscript>t<p>u") == ["t", "u"]
    assert keep("<article>a<xmp><b>x &amp; y</b></xmp>c</article><xmp>cut") == ["a", "<b>x &amp; y</b>", "c", "cut"]
    assert keep("<p>a <svg><title>b &amp; d</title><path/></svg> c<svg/><title>t</title>e") == ["a b & d ce"]
    texts = [f"Paragraph {k} of the piece, with some plain words in it. And one more sentence." for k in range(8)]
    body = "".join(f"<p>{t}</p>" for t in texts[:4]) + f"<noscript><p>{texts[4]}</p></noscript><xmp>for (a &lt; b) {{ print(a); next(b); }} // and some more words</xmp>" + "".join(f"<p>{t}</p>" for t in texts[5:])
    page = f"<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>About</a></li></ul></nav><article><h1>The piece of writing</h1>{body}</article><footer>&copy; site</footer></body></html>"
    assert H.extract_batch([page], model)[0].split("\n\n") == ["The piece of writing", *texts[:5], "for (a &lt; b) { print(a); next(b); } // and some more words", *texts[5:]]


def test_deep_and_broken_nesting_takes_linear_time():
    for page in ("<div>" * 20_000, "<ul><li>" * 20_000, "<table><tr><td>" * 10_000, "<div></p>" * 20_000, "<noscript>" + "<div>" * 20_000 + "</div>" * 20_000):
        began = time.process_time()
        H.parse(page + "x")
        assert time.process_time() - began < 3
    for name, inner in (("td", "<td>a<table><tr><td>b<td>c<tr><td>d</table>e"), ("li", "<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul>")):
        root = H.parse(inner)
        assert H.blocks(root, [True] * len(H._walk(root))) == ["a", "b", "c", "d", "e"], name


def test_margins_equal_walks_of_single_trees():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 9, (400, 5)).astype(float)
    y = ((x[:, 1] > 4) & (x[:, 3] < 6)).astype(float)
    model = H.boost(x, y, trees=12, depth=3)
    inner = model.feature.shape[1]
    for row, margin in zip(x, model.margins(x), strict=True):
        total = model.start
        for f, t, v in zip(model.feature, model.threshold, model.value, strict=True):
            at = 0
            while at < inner:
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            total += v[at - inner]
        assert abs(total - margin) < 1e-9
    assert ((model.margins(x) > 0) == (y > 0)).mean() > 0.97


def test_decoding_equals_all_consistent_labellings():
    """On small trees: no labelling that keeps nothing under a dropped node has a larger sum of log-probabilities."""
    rng = random.Random(5)
    for _ in range(60):
        page = "".join(rng.choice(["<div>", "<div>", "<section>", "</div>", "x"]) for _ in range(12))
        nodes = H._walk(H.parse(page))[:11]
        if len(nodes) < 2 or any(c.index >= len(nodes) for n in nodes for c in n.children):
            continue
        margin = np.array([rng.gauss(0, 2) for _ in nodes])
        best = []
        for labels in itertools.product((False, True), repeat=len(nodes) - 1):
            kept = [True, *labels]
            if all(kept[n.parent.index] or not kept[n.index] for n in nodes[1:]):
                best.append((sum(-np.logaddexp(0, -margin[k] if kept[k] else margin[k]) for k in range(1, len(nodes))), kept))
        assert H.decode(nodes, margin) == max(best)[1]
