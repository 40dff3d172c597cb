"""Block reader against the standard library's parser, the network's gradient and states, and held-out pages."""
import time
from html.parser import HTMLParser

import numpy as np
import pytest

from quarry.llm import block_lstm
from quarry.llm.block_lstm import Labeller, _padded, compose, extract_main_text, label_pages, main_texts, teacher, train
from quarry.llm.page_blocks import INLINE, VOID, Block, features, page_blocks
from quarry.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SF_MORE = "/root/testdata/sf0.01"


class Plain(HTMLParser):
    """Text between block-level tags, and whether an article is open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.now, self.skip, self.article = [], "", 0, 0

    def cut(self):
        if self.now.split():
            self.out.append((" ".join(self.now.split()), self.article > 0))
        self.now = ""

    def handle_starttag(self, tag, attrs):
        self.now += " " * (tag in VOID)
        if tag in ("script", "style", "title"):
            self.skip += 1
        elif tag not in INLINE and tag not in VOID:
            self.cut()
        self.article += tag == "article"

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title"):
            self.skip -= 1
        elif tag not in INLINE:
            self.cut()
        self.article -= tag == "article"

    def handle_data(self, data):
        self.now += data * (not self.skip)


def plain(page):
    p = Plain()
    p.feed(page)
    p.close()
    p.cut()
    return p.out


@pytest.fixture(scope="module")
def pages(duck):
    return [r[0] for r in duck.execute(f"SELECT html FROM read_parquet('{SF_MORE}/pages.parquet') ORDER BY page_id").fetchall()]


@pytest.fixture(scope="module")
def model(pages):
    return train(sorted(pages)[:96])


def test_blocks_equal_the_standard_parser(pages):
    for p in pages:
        assert [b.text for b in page_blocks(p)] == [t for t, _ in plain(p)]


def test_odd_markup():
    def texts(p):
        return [b.text for b in page_blocks(p)]
    assert texts(None) == texts("") == texts(" \n ") == texts("<!-- x") == texts("<script>var a='<p>no</p>'") == []
    assert texts("a &amp; b&nbsp;&eacute;&#x41; < 3 <3") == ["a & b éA < 3 <3"]
    assert texts("<p>one<br>two <b>th<i>ree</b><p title='a > b'>four</p>five<table><tr><td>x<td>y<tr><td>z</table>") == ["one two three", "four", "five", "x", "y", "z"]
    assert texts('<p class="open>one</p><p>two</p>')[-1] == "two"
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<style>p{}</style><title>t</title><p>x<script>if (a<b) {}</script>y</p><svg><text>s</text></svg>") == ["xy"]


@pytest.mark.parametrize("page", ["<p a='" * 20000, "<div>" * 30000 + "x", "<b>" * 30000 + "<p>x" * 3000, "<" * 100000, "<li><div>x" * 20000, "<!--" * 50000, "</div>" * 50000, "<table><tr><td>x" * 8000])
def test_linear_time(page):
    t = time.process_time()
    page_blocks(page)
    assert time.process_time() - t < 8


def test_gradient_against_differences():
    rng = np.random.default_rng(1)
    model = Labeller(hidden=3)
    xs = [rng.normal(size=(n, len(features(page_blocks("<p>x"))[0]))).astype(np.float32) * 0.3 for n in (2, 5, 4)]
    ys = [rng.integers(0, 2, len(x)).astype(np.float32) for x in xs]
    x, mask, y = _padded(xs, ys)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    g, _ = model.gradient(x, mask, y)

    def loss():
        p = model.scores(x, mask)
        return -float((mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum())
    for key, v in model.p.items():
        for at in rng.integers(0, v.size, 6):
            i = np.unravel_index(at, v.shape)
            old, step = v[i], 1e-2
            v[i] = old + step
            up = loss()
            v[i] = old - step
            down = loss()
            v[i] = old
            assert g[key][i] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_long_pages_see_the_whole_page(model, monkeypatch):
    blocks = page_blocks("<nav><a href=x>m</a></nav><article>" + "".join(f"<p>word{i} is here for the block.</p>" for i in range(300)) + "</article><footer>end</footer>")
    whole = label_pages([blocks], model)[0]
    monkeypatch.setattr(block_lstm, "STRETCH", 64)
    assert np.allclose(model.long_scores(blocks), whole, atol=1e-4)
    assert np.allclose(label_pages([blocks, blocks[:5], []], model)[0], whole, atol=1e-4)


def test_pages_of_the_table(pages, model):
    """Pages that the labeller didn't see: the article's blocks, all of them and no others."""
    seen = set(sorted(pages)[:96])
    held = [p for p in pages if p not in seen]
    assert len(held) > 100 and main_texts(held, model) == ["\n".join(t for t, a in plain(p) if a) for p in held]


def test_composed_pages(pages, model):
    """Other names for the parts, sidebars, notices, forms, reader comments: held-out pages, other draws."""
    rng, wrong, n = np.random.default_rng(5), 0, 0
    for p in sorted(pages)[96:]:
        blocks = page_blocks(p)
        made = page_blocks(compose(blocks, teacher(blocks), rng))
        wrong += sum((s >= 0.5) != (b.mark == 1) for b, s in zip(made, label_pages([made], model)[0]))
        n += len(made)
    assert n > 2000 and wrong / n < 0.02


def test_hand_made_page(model):
    page = """<html><head><title>T</title></head><body><header><div class="logo">The Daily Site</div></header>
    <div class="navbar"><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></div><div class="cookie-notice"><p>We use cookies to make this better.</p></div>
    <main><h1>A title of the page</h1><p>The first paragraph says &ldquo;a lot&rdquo; of things in <a href="x">some</a> words.</p>
    <p>The second one is
       shorter.</p></main><aside class="sidebar"><h3>More</h3><ul><li><a href="a">Another thing to read today</a></li></ul></aside>
    <section class="comments"><h3>Comments</h3><div class="comment"><p>I liked this article very much, thank you for it.</p></div></section>
    <form class="newsletter"><p>Get our mail</p><input><button>Go</button></form><footer><p>&copy; 2020 The Site</p></footer></body></html>"""
    assert main_texts([page], model) == ["A title of the page\nThe first paragraph says “a lot” of things in some words.\nThe second one is shorter."]


def test_teacher_without_names():
    long = "<p>" + "many words are in this block of text " * 3 + "</p>"
    y = teacher(page_blocks(f"<div><a href=a>home</a></div><h2>Title</h2>{long}<p>short</p>{long}<footer>{long}</footer>"))
    assert list(y) == [0, 1, 1, 0, 1, 0]


def test_odd_rows_and_query(spark):
    rows = [(1, "u", None, "t"), (None, None, "", None), (2, "v", "<article><p>a &amp; b</p></article><footer>f</footer>", "x"),
            (2, "v", "<article><p>a &amp; b</p></article><footer>f</footer>", "x"), (3, "w", "<article>" + "<p>much text in many blocks.</p>" * 5000 + "</article>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_main_text(df.repartition(2), max_pages=8).collect()
    assert sorted((str(r.page_id), str(r.url)) for r in got) == sorted((str(r[0]), str(r[1])) for r in rows)
    assert all(r.n_chars == len(r.text) for r in got) and all(r.text == "" for r in got if r.page_id in (1, None))
    assert extract_main_text(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        extract_main_text(df, keep=("page_id", "text"))
    name = next(k for k in QUERIES if k.startswith("op13_"))
    out = {r.page_id: r for r in QUERIES[name](spark, SF_SMALL).collect()}
    table = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(out) == len(table) and out[table[0].page_id].url == table[0].url
    want = {r.page_id: "\n".join(t for t, a in plain(r.html) if a) for r in table}
    assert sum(out[i].text == t for i, t in want.items()) >= 0.95 * len(want)
