import html
import itertools
import math
import random
import re
import time

import numpy as np
import pytest

from contactmill.llm import html_extract as he
from contactmill.llm import queries


def test_marginals_are_exact():
    """Against the sum over all labellings of small trees."""
    model = he.default_model()
    for source, _ in he.labelled_pages(40, 5):
        nodes = he.parse(source).nodes[:11]
        if any(n.parent >= 11 for n in nodes):
            continue
        theta = [sum(model.weights.get(f, 0.0) for f in he.features(n)) for n in nodes]
        total = np.zeros((len(nodes), 2))
        for y in itertools.product((0, 1), repeat=len(nodes)):
            score = sum(t * v for t, v in zip(theta, y))
            score += sum(model.edge[he.kind(n.tag)][y[n.parent]][y[i]] for i, n in enumerate(nodes) if i)
            for i, v in enumerate(y):
                total[i, v] += math.exp(score)
        want = np.log(total[:, 1] / total[:, 0])
        assert np.allclose(model.marginals(nodes), want, atol=1e-6)


def test_held_out_accuracy():
    model, right, total = he.default_model(), 0, 0
    for source, labels in he.labelled_pages(200, 77):
        nodes = he.parse(source).nodes
        for node, belief, label in zip(nodes, model.marginals(nodes), labels):
            total += node.own
            right += node.own * ((belief > 0) == (label == 1))
    assert right / total > 0.95


def test_query(spark, tiny):
    rows = {r["page_id"]: r for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    got = queries.op4_html_extraction(spark, tiny).collect()
    assert len(got) == len(rows)
    for r in got:
        body = re.search(r"<article>(.*?)(</article>|\Z)", rows[r["page_id"]]["html"], re.S).group(1)
        blocks = (re.sub("<[^>]*>", " ", b) for b in re.split("</?(?:p|h1)>", body))
        blocks = (" ".join(html.unescape(b).split()) for b in blocks)
        assert r["text"] == "\n".join(filter(None, blocks))
        assert r["n_chars"] == len(r["text"]) and r["url"] == rows[r["page_id"]]["url"]


def test_edges(spark):
    deep = "<div>" * 3000 + "<p>word word word. word word.</p>"
    data = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "only &amp;  text", "c"), (4, "<p a='>'>x&nbsp;y<b>z", "d"), (5, deep, "e"), (6, "<!-- <p>no", "f"), (7, "<script>var x = '<p>'", "g")]
    df = spark.createDataFrame(data, "page_id long, html string, text string")
    got = [(r["page_id"], r["text"]) for r in he.extract(df).collect()]
    assert got[:5] == [(1, ""), (2, ""), (2, ""), (None, "only & text"), (4, "x yz")]
    assert got[6:] == [(6, ""), (7, "")]
    assert he.extract(df.limit(0)).count() == 0


WORDS = "the river runs below old stone bridges where people often meet after work and talk about weather prices children".split()


def paragraph(rng, size):
    out = ""
    while len(out) < size:
        out += " ".join(rng.choices(WORDS, k=rng.randint(6, 14))).capitalize() + ". "
    return out[:size].strip()


def test_plain_layouts():
    """Pages with and without heading, menu and footer, in four wrappers, of few or many paragraphs."""
    rng, right, total = random.Random(5), 0, 0
    model = he.default_model()
    shapes = itertools.product((0, 1, 2), (0, 1), (0, 1), ("article", "main", "div", "body"), (1, 2, 3, 4, 6), (60, 256, 500, 1000))
    for links, heading, footer, wrapper, n, size in shapes:
        want = ["Old stone bridges"] * heading + [paragraph(rng, size) for _ in range(n)]
        inner = "".join(f"<h1>{t}</h1>" if heading and not i else f"<p>{t}</p>" for i, t in enumerate(want))
        body = ("<nav>" + " ".join(f'<a href="/{i}">Link {i}</a>' for i in range(links)) + "</nav>") * (links > 0)
        body += inner if wrapper == "body" else f"<{wrapper}>{inner}</{wrapper}>"
        body += "<footer>Copyright 2024 Example. All rights reserved.</footer>" * footer
        got = model.extract(f"<html><head><title>T</title></head><body>{body}</body></html>")
        right += got == "\n".join(want)
        total += 1
    assert total == 960 and right >= 0.97 * total


# written by hand, with their main text
PAGES = [
    (
        """<!DOCTYPE html><html lang=en><head><meta charset=utf-8><title>Bread - Home baking</title>
        <style>p{color:red}</style><script>if (a < b) document.write("<p>no</p>")</script></head><body>
        <header class="site-header"><a href="/">Home baking</a><nav><ul><li><a href="/a">Recipes</a><li><a href="/b">Shop</a></ul></nav></header>
        <main><article class="post"><h1>Rye bread &amp; butter</h1>
        <p>Rye flour needs more water than wheat, and it keeps the loaf moist for days. Let it rest overnight.
        <p>Bake it <b>hot</b> first, then at a lower heat; a stone helps. See also <a href="/stone">our page on stones</a>.</p>
        <ul><li>500 g of rye flour</li><li>400 ml of water</li></ul>
        </article></main>
        <aside class="sidebar"><h3>Popular</h3><ul><li><a href="/1">White bread</a></li><li><a href="/2">Rolls</a></li></ul></aside>
        <footer><p>Copyright 2024 Home baking. <a href="/imprint">Imprint</a></p></footer></body></html>""",
        "Rye bread & butter\nRye flour needs more water than wheat, and it keeps the loaf moist for days. Let it rest overnight.\n"
        "Bake it hot first, then at a lower heat; a stone helps. See also our page on stones.\n500 g of rye flour\n400 ml of water",
    ),
    (
        """<html><body><div id="cookie-banner">We use cookies. <button>Accept</button></div>
        <div id=page><div class="nav"><a href=1>News</a> | <a href=2>Sport</a> | <a href=3>Weather</a></div>
        <div class="content"><h1>Bridge opens again</h1><div class="ad">Buy our shoes now!</div>
        <p>After two years of work the old bridge is open to all traffic. The town paid for most of it.</p>
        <p>&ldquo;We are glad,&rdquo; said a shop owner. Buses run from Monday on.</p></div>
        <div class="comments"><h2>Comments</h2><div class="comment"><p>Great news!</p></div><div class="comment"><p>At last, I waited long for this.</p></div></div>
        <div class="footer">Imprint. All rights reserved.</div></div></body></html>""",
        "Bridge opens again\nAfter two years of work the old bridge is open to all traffic. The town paid for most of it.\n"
        "\u201cWe are glad,\u201d said a shop owner. Buses run from Monday on.",
    ),
    (
        "<p>Only one paragraph that somebody wrote by hand, without any frame around it.",
        "Only one paragraph that somebody wrote by hand, without any frame around it.",
    ),
    (
        """<body><article><p>The sum is <math><mi>a</mi><mo>+</mo><mn>2</mn></math>, as the picture <svg viewBox='0 0 1 1'/> shows.</p>
        <p>It holds for all numbers that are larger than one, which is easy to see from the table below.</p>
        <table><tr><td>one<td>two<tr><td>three<td>four</table></article><form action=x><input name=q><button>Search</button></form></body>""",
        "The sum is a+2, as the picture shows.\nIt holds for all numbers that are larger than one, which is easy to see from the table below.\n"
        "one\ntwo\nthree\nfour",
    ),
    (
        """<html><body><nav class=menu><a href=/>Start</a><a href=/x>Archive</a></nav><section class="entry-content">
        <h2>How we moved the server</h2><p>It began at night. Nobody slept, and the first plan failed after an hour of waiting.</p>
        <blockquote>Never again, said the chief.</blockquote><p>In the end all of it worked, and the users saw nothing of what had happened.</p></section>
        <div class="share"><a href=t>Tweet</a> <a href=f>Like</a></div><div class="related-posts widget"><h3>Related</h3><a href=1>Older post</a></div></body></html>""",
        "How we moved the server\nIt began at night. Nobody slept, and the first plan failed after an hour of waiting.\n"
        "Never again, said the chief.\nIn the end all of it worked, and the users saw nothing of what had happened.",
    ),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_pages_written_by_hand(page, text):
    assert he.default_model().extract(page) == text


@pytest.mark.parametrize("page, pieces", [
    ("<p>a<svg/>b</p><p>c", ["a", "b", "c"]),
    ("<p>a<svg><title>t</title><path d='x'/>z</svg>b", ["a", "b"]),
    ("<p title='it's'>x", ["x"]),
    ('<p title="open>one</p><p>two', ["one", "two"]),
    ("<p class=x'>hi", ["hi"]),
    ("<p 'x>y", ["y"]),
    ("<math><mi>x</mi>=1</math>", ["x", "=1"]),
    ("a < b and c <3", ["a < b and c <3"]),
    ("<!-->x<!--->y<!-- z --!>w<![CDATA[q]]>v", ["x", "y", "w", "v"]),
    ("<title>no end <p>hi", ["no end ", "hi"]),
    ("a&amp;<b>&lt;</b>&am<i>p;</i>", ["a&", "<", "&am", "p;"]),
    ("</p>x</>y</ a>z</b>", ["x", "y", "z"]),
    ("<SCRIPT>a</scriptx></ScRiPt >b<style>c", ["b"]),
    ("<p a=1 <b>x", ["x"]),
    ("<", ["<"]),
])
def test_tags_by_the_standard(page, pieces):
    assert [t for at, t in he.parse(page).pieces if at >= 0] == pieces


def test_tag_soup_takes_linear_time():
    began = time.time()
    for soup in ("<p a='", "<", "<title>", "<p><b>", "<!--", '<a b="', "</x>", "<!", "<svg>", "<p 'a=\"b", "</"):
        he.parse(soup * 50_000)
    assert time.time() - began < 30


def test_inner_elements_and_custom_ones():
    assert he.default_model().extract("<article><p>The <x-word>new</x-word> house is old, and nobody lives in it now.</p></article>") == (
        "The new house is old, and nobody lives in it now."
    )
