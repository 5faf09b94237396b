import html as H
import random
import re

import numpy as np
import pandas as pd
import pytest
from llm_tables import SF

from scrubjay.llm import html_text as X
from scrubjay.llm.boosting import fit_trees
from scrubjay.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model():
    return X.fit([])


def test_articles_of_given_pages(spark):
    """The given pages hold their text in one article element, without boilerplate inside."""
    out = QUERIES["op3_html_text"](spark, SF).toPandas().set_index("page_id")
    pages = pd.read_parquet(f"{SF}/pages.parquet")
    assert len(out) == len(pages)
    for i, page in zip(pages.page_id, pages.html):
        inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
        blocks = [" ".join(H.unescape(re.sub(r"</?b>|<br>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert out.text[i] == want and out.n_chars[i] == len(want)


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script><style>p{}</style></head><body>
<header class="masthead"><a href=/>Site name</a><nav><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></nav></header>
<div class="cookie-notice"><p>We use cookies to give you the best of this site. Accept?</p><button>Yes</button></div>
<main><article><h1>Fish &amp;   chips</h1><p>First  &lt;b&gt; paragraph,
with a <a href="x">link</a> and some more words in it.<p>Second one, not closed. It also has several words.
<ul><li>an item of the list</li><li>another item</li></ul><div class="ad">Buy now, cheap!</div><p>Last words of the story.</p></article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I read this and I liked it very much, thank you.</p></div></section></main>
<aside class="sidebar"><h3>More</h3><ul><li><a href=3>Three</a></li><li><a href=4>Four</a></li></ul></aside>
<form action="/s"><label>Search this site</label><input name=q></form><footer>&copy; 2024 Someone. All rights reserved.</footer><!-- <p>gone</p> --></body></html>"""


def test_one_page(model):
    assert X.extract([PAGE], model)[0] == "\n".join([
        "Fish & chips", "First <b> paragraph, with a link and some more words in it.", "Second one, not closed. It also has several words.",
        "an item of the list", "another item", "Last words of the story."])


@pytest.mark.parametrize("silent", ["<noscript><div><img src=x></div></noscript>", "<template><section><p>no</p></section></div></template>", "<svg><g></g></div></p></svg>",
                                    "<object><div></svg>no</div></object>", "<noscript><a href=x>no<br></a></div></noscript>", "<select><option>no</option></div></select>"])
def test_elements_without_text_close_nothing_outside(silent):
    """Tags inside them leave the tree as it is without them."""
    page = "<body><div class=post><p>a</p>{0}<p>b</p></div><div class=advert>{0}<p>c</p></div><p>d <a href=x>e{0}f</a></p>"
    shape = lambda d: (d.parent, d.tag, d.mask, d.runs)
    assert shape(X.parse(page.format(silent))) == shape(X.parse(page.format("")))


@pytest.mark.parametrize("long", ["flex-1 " * 200, "x" * 394 + " ", "u " * 196 + "abc-"])
def test_whole_attribute_values_are_read(long):
    mask = lambda attrs: X.parse(f"<div {attrs}>a</div>").mask[1]
    assert mask(f'class="{long}sidebar"') == mask('class="sidebar"') != 0
    assert mask(f'class="{long}" id="comments" role="navigation"') == mask('id="comments" role="navigation"') != 0
    assert mask(f'class="{long}address"') == mask(f'class="{long}adsorption"') == 0  # no word is cut to "ad" or "ads"


def test_generator_holds_elements_without_text():
    rng = random.Random(1)
    assert sum("<noscript><div>" in X.generate(rng) for _ in range(100)) > 5


def test_generated_pages(model):
    """Pages of another seed: nearly all content runs are kept, nearly all others are dropped."""
    rng = random.Random(99)
    pages = [X.parse(X.generate(rng)) for _ in range(150)]
    nodes = X.Nodes(pages)
    truth = np.array([v or 0 for d in pages for v in X._labels(d, True)], bool)
    kept = nodes.decode(model.log_odds(nodes.x))[nodes.run_node]
    chars = np.array([len(t) for t in nodes.texts])
    want = truth[nodes.run_node]
    assert chars[kept & want].sum() / chars[want].sum() > 0.97
    assert chars[kept & want].sum() / chars[kept].sum() > 0.97


def test_decoding_is_consistent_and_best():
    """Kept nodes are closed under parents and no other closed set scores higher."""
    rng = random.Random(4)
    for _ in range(40):
        d = X.Dom()
        n = rng.randint(1, 9)
        for i in range(n):
            d.parent.append(rng.randrange(i + 1)), d.tag.append("div"), d.mask.append(0), d.mark.append(None)
        nodes = X.Nodes([d])
        odds = np.array([rng.uniform(-2, 2) for _ in range(n + 1)])
        keep = nodes.decode(odds)
        closed = [s for s in range(1 << (n + 1)) if all(not s >> i & 1 or d.parent[i] < 0 or s >> d.parent[i] & 1 for i in range(n + 1))]
        best = max(sum(odds[i] for i in range(n + 1) if s >> i & 1) for s in closed)
        assert all(not keep[i] or d.parent[i] < 0 or keep[d.parent[i]] for i in range(n + 1))
        assert abs(odds[keep].sum() - best) < 1e-9


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    t = fit_trees(x, y, np.ones(len(y)), depth=3)
    assert ((t.log_odds(x) > 0) == y).mean() > 0.97


def test_odd_rows(spark, model):
    rows = [(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "plain words only", "x"), (None, None, PAGE, None), (None, None, PAGE, None),
            (5, "u", "<p>" * 3000 + "deep" + "</div></p>" * 10, "x"), (6, "u", "<article><p>" + "long text. " * 50_000 + "</article>", "x"), (7, "u", "<script>x", "x"),
            (8, "u", "< & &#x41; &bogus; <p", "x"), (9, "u", "<!-- <p>a</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, Text string")
    out = X.extract_text(df, model)
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    rows = out.collect()
    assert len(rows) == 10 and all(r.n_chars == len(r.text) for r in rows)
    by = {r.page_id: r for r in rows}
    assert by[1].text == by[2].text == "" and by[6].n_chars == 11 * 50_000 - 1
    assert X.extract_text(df.limit(0), model).count() == 0
    assert X.fit_on(df.limit(0)).leaf.size > 0


@pytest.fixture(scope="module")
def fitted():
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html
    return X.fit(pages.tolist()[:X.SAMPLE])


PROSE = "The river was high in spring, and the old bridge had to be closed for some weeks. People went by boat."


@pytest.mark.parametrize("start", ['article class="post comments-open"', 'article class="post comments-open sidebar-right"',
                                   'article class="post tag-popular category-discussion"', 'main class="page nav-open ads-off"', "article"])
def test_misleading_words_on_content(fitted, start):
    """An article is kept, and what stands around it goes, whatever words its class holds."""
    end = start.split()[0]
    page = (f'<html><body><nav class="menu"><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav><{start}><h1>High water</h1><p>{PROSE}</p><p>{PROSE[::-1]}</p></{end}>'
            f'<section id="comments"><div class="comment"><p>Nice words, thanks.</p></div></section><footer>Copyright</footer></body></html>')
    assert X.extract([page], fitted) == ["High water\n" + PROSE + "\n" + PROSE[::-1]]


@pytest.mark.parametrize("inside,want", [
    ("We see that <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds.", "We see that x=2 holds."),
    ("Seen <svg><title>icon</title><path d=x/><text>no</text></svg>here.", "Seen here."),
    ("Seen <noscript><div><img src=x><p>off</p></div></noscript>here.", "Seen here."),
    ("Seen <script>if (a</b) {}</script>here <style>p{}</style>too.", "Seen here too."),
    ("Seen <video><source src=x>no video</video>here.", "Seen here.")])
def test_elements_inside_a_sentence(fitted, inside, want):
    page = f"<html><body><article><p>{PROSE}</p><p>{inside}</p><p>{PROSE}</p></article></body></html>"
    assert X.extract([page], fitted) == [f"{PROSE}\n{want}\n{PROSE}"]


@pytest.mark.parametrize("open_tag", ["<noscript><img src=x>", "<video controls><source src=x>", "<svg><path d=x>", "<object data=x>", "<canvas>"])
def test_unclosed_silent_elements_end_with_what_is_around_them(fitted, open_tag):
    """The block they stand in ends them; after it the page goes on."""
    page = f"<html><body><article><p>{PROSE}</p><div><p>{PROSE}</p>{open_tag}</div><p>{PROSE}</p></article>{open_tag}</body></html>"
    assert X.extract([page], fitted) == ["\n".join([PROSE] * 3)]


def test_a_block_ends_a_drawing(fitted):
    page = f"<html><body><article><p>{PROSE}</p><svg><path d=x><text>no</text><p>{PROSE}</p><p>{PROSE}</p></article></body></html>"
    assert X.extract([page], fitted) == ["\n".join([PROSE] * 3)]
