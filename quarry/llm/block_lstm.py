"""Main text of pages by a recurrent block labeller.

A bidirectional LSTM (numpy) reads a page's leaf blocks in order, each as its hashed tag path, hashed words and shape, and
labels every block with the whole page as context; the blocks labelled main are the page's text.

The labeller is trained where it is used, in one task, on at most ``max_pages`` pages of at most ``max_page_chars`` code
points (a bound of the sample alone; pages of any length are labelled whole).  There are no labels for blocks, so a teacher
gives them: element names and the words of class, id and role say which parts are main and which are menus, comments and so
on; where no name says main, long blocks without many links are.  Beside each sampled page the labeller learns a page
composed of its blocks with other names, or none, for the same parts and with parts that the sample may lack (sidebars,
notices, forms, reader comments), whose labels are known.
"""
from __future__ import annotations

import html as html_lib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.page_blocks import WIDTH, Block, features, page_blocks

#: Blocks of padded pages that are labelled together, and blocks of one long page between kept states.
CELLS, STRETCH = 1 << 15, 1 << 11

# ------------------------------------------------------------------ the network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Weights: per direction W (input), U (state), b (gates in, forget, out, cell); the output V, c over both states."""

    def __init__(self, width: int = WIDTH, hidden: int = 16, seed: int = 7):
        rng, self.hidden = np.random.default_rng(seed), hidden
        self.p = {}
        for d in "fb":
            self.p["W" + d] = rng.normal(0, 0.15, (width, 4 * hidden)).astype(np.float32)
            self.p["U" + d] = rng.normal(0, hidden ** -0.5, (hidden, 4 * hidden)).astype(np.float32)
            self.p["b" + d] = np.zeros(4 * hidden, dtype=np.float32)
            self.p["b" + d][hidden:2 * hidden] = 1
        self.p["V"] = rng.normal(0, 0.2, 2 * hidden).astype(np.float32)
        self.p["c"] = np.zeros(1, dtype=np.float32)

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, state=None, keep: list | None = None):
        """States of one direction over x (time, page, width) in the order given; where the mask is 0 a state stays."""
        k, (steps, n, _) = self.hidden, x.shape
        w, u = self.p["W" + d], self.p["U" + d]
        pre = (x.reshape(steps * n, -1) @ w + self.p["b" + d]).reshape(steps, n, 4 * k)
        h, c = state or (np.zeros((n, k), np.float32), np.zeros((n, k), np.float32))
        out = np.empty((steps, n, k), np.float32)
        for t in range(steps):
            z = pre[t] + h @ u
            gates = _sigmoid(z[:, :3 * k])
            i, f, o, g = gates[:, :k], gates[:, k:2 * k], gates[:, 2 * k:], np.tanh(z[:, 3 * k:])
            new = f * c + i * g
            th = np.tanh(new)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((h, c, i, f, o, g, th))
            h, c = m * (o * th) + (1 - m) * h, m * new + (1 - m) * c
            out[t] = h
        return out, (h, c)

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probability of main (time, page)."""
        hf, _ = self._run("f", x, mask)
        hb, _ = self._run("b", x[::-1], mask[::-1])
        k = self.hidden
        return _sigmoid(hf @ self.p["V"][:k] + hb[::-1] @ self.p["V"][k:] + self.p["c"])

    def long_scores(self, blocks: list[Block]) -> np.ndarray:
        """The same for one page of any length: stretches of blocks, the state handed on, in both directions."""
        n, k = len(blocks), self.hidden
        total, ones = np.zeros(n, np.float32), np.ones((STRETCH, 1), np.float32)
        cuts = list(range(0, n, STRETCH))
        for d, order, v in (("f", cuts, self.p["V"][:k]), ("b", cuts[::-1], self.p["V"][k:])):
            state = None
            for lo in order:
                x = features(blocks, lo, min(n, lo + STRETCH))[:, None]
                x = x if d == "f" else x[::-1]
                h, state = self._run(d, x, ones[:len(x)], state)
                total[lo:lo + len(x)] += (h if d == "f" else h[::-1])[:, 0] @ v
        return _sigmoid(total + self.p["c"])

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict, float]:
        """Of the mean log loss over the blocks of a padded batch."""
        k, (steps, n, width) = self.hidden, x.shape
        kept = {d: [] for d in "fb"}
        hf, _ = self._run("f", x, mask, keep=kept["f"])
        hb, _ = self._run("b", x[::-1], mask[::-1], keep=kept["b"])
        p = _sigmoid(hf @ self.p["V"][:k] + hb[::-1] @ self.p["V"][k:] + self.p["c"])
        total = max(1.0, float(mask.sum()))
        err = ((p - y) * mask / total).astype(np.float32)
        loss = -float((mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum()) / total
        g = {"V": np.concatenate([np.tensordot(err, h, ([0, 1], [0, 1])) for h in (hf, hb[::-1])]), "c": err.sum(keepdims=True)[0]}
        for d, xs, m, e, v in (("f", x, mask, err, self.p["V"][:k]), ("b", x[::-1], mask[::-1], err[::-1], self.p["V"][k:])):
            u, dz, gu = self.p["U" + d], np.zeros((steps, n, 4 * k), np.float32), np.zeros_like(self.p["U" + d])
            dh, dc = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
            for t in range(steps - 1, -1, -1):
                h0, c0, i, f, o, gg, th = kept[d][t]
                mt = m[t][:, None]
                dh = dh + e[t][:, None] * v
                new = dh * mt
                cell = dc * mt + new * o * (1 - th * th)
                z = dz[t]
                z[:, :k], z[:, k:2 * k] = cell * gg * i * (1 - i), cell * c0 * f * (1 - f)
                z[:, 2 * k:3 * k], z[:, 3 * k:] = new * th * o * (1 - o), cell * i * (1 - gg * gg)
                gu += h0.T @ z
                dh = dh * (1 - mt) + z @ u.T
                dc = dc * (1 - mt) + cell * f
            flat = dz.reshape(steps * n, -1)
            g["W" + d], g["U" + d], g["b" + d] = np.ascontiguousarray(xs).reshape(steps * n, width).T @ flat, gu, flat.sum(axis=0)
        return g, loss

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 16, rate: float = 0.015, batch: int = 48, seed: int = 7) -> list[float]:
        """Adam over batches of pages of like length; returns the loss of each epoch."""
        rng, order, losses = np.random.default_rng(seed), sorted(range(len(pages)), key=lambda i: (len(pages[i][1]), i)), []
        batches = [_padded([pages[i][0] for i in order[lo:lo + batch]], [pages[i][1] for i in order[lo:lo + batch]]) for lo in range(0, len(order), batch)]
        mean, var, step = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for epoch in range(epochs):
            total = 0.0
            for b in rng.permutation(len(batches)):
                g, loss = self.gradient(*batches[b])
                total, step = total + loss, step + 1
                size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
                for key, v in g.items():
                    v = v * min(1.0, 1.0 / (size + 1e-9))
                    mean[key] = 0.9 * mean[key] + 0.1 * v
                    var[key] = 0.99 * var[key] + 0.01 * v * v
                    now = rate * (0.3 if epoch >= epochs * 2 // 3 else 1)
                    self.p[key] = (self.p[key] - now * (mean[key] / (1 - 0.9 ** step)) / (np.sqrt(var[key] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
            losses.append(total / max(1, len(batches)))
        return losses


def _padded(xs: list[np.ndarray], ys: list[np.ndarray] | None = None):
    steps = max(len(x) for x in xs)
    x, mask, y = np.zeros((steps, len(xs), WIDTH), np.float32), np.zeros((steps, len(xs)), np.float32), np.zeros((steps, len(xs)), np.float32)
    for j, f in enumerate(xs):
        x[:len(f), j], mask[:len(f), j] = f, 1
        if ys is not None:
            y[:len(f), j] = ys[j]
    return x, mask, y


# ------------------------------------------------------------------ what it learns from

def teacher(blocks: list[Block]) -> np.ndarray:
    """1 for each block that its names call main, or, where no name does, for long blocks with few links and their headings."""
    aside = np.array([b.aside > 0 for b in blocks], dtype=bool)
    named = np.array([b.main > 0 for b in blocks], dtype=bool)
    if named.any():
        return (named & ~aside).astype(np.float32)
    long = np.array([b.shape[1] * 6 > np.log1p(9) and b.shape[2] < 0.3 for b in blocks], dtype=bool) & ~aside
    heading = np.array([b.shape[5] > 0 for b in blocks], dtype=bool) & ~aside
    after = np.append(long[1:], False)
    return (long | heading & after).astype(np.float32)


#: Names of the parts of a composed page; '' is a bare div.
MAIN_PARTS = ['article', 'main', 'div class="content"', 'div class="post-body"', 'div id="story"', 'section class="entry-content"', 'div role="main"', 'div itemprop="articleBody"', 'div', 'section', 'td']
MENUS = ['nav', 'ul class="menu"', 'div class="navbar"', 'div id="navigation"', 'div role="navigation"', 'div class="breadcrumbs"', 'ul']
HEADS = ['header', 'div class="site-header"', 'div id="masthead"', 'div class="topbar"', 'div role="banner"']
FEET = ['footer', 'div class="footer"', 'div id="footer"', 'div class="site-footer copyright"', 'div role="contentinfo"']
SIDES = ['aside', 'div class="sidebar"', 'div id="side"', 'div class="widget"', 'div class="related-posts"', 'section class="recommended"', 'div role="complementary"']
NOTICES = ['div class="cookie-notice"', 'div id="consent"', 'div class="alert"', 'div class="notice"', 'div class="popup"', 'div class="modal"', 'dialog']
ADVERTS = ['div class="ad"', 'div class="advert"', 'div class="ads"', 'div id="ad-top"', 'div class="sponsored"', 'div class="promo banner"', 'aside class="advertisement"']
FORMS = ['form', 'form class="search"', 'form id="login"', 'div class="newsletter"', 'form class="subscribe"', 'form class="comment-form"']
COMMENTS = ['section class="comments"', 'div id="comments"', 'ol class="comment-list"', 'div class="disqus"', 'div class="replies"', 'section id="reader-comments"']
SHARES = ['div class="share"', 'div class="social"', 'ul class="pagination"', 'div class="toolbar"']


def compose(blocks: list[Block], labels: np.ndarray, rng: np.random.Generator) -> str:
    """A page with the main blocks of ``blocks`` in a part of another name, and other parts made of its blocks' words."""
    main = [b for b, y in zip(blocks, labels) if y]
    other = [b.text for b, y in zip(blocks, labels) if not y] or ["."]
    words = " ".join(b.text for b in (main or blocks)).split()

    def esc(t):
        return html_lib.escape(t, quote=False)

    def some(least, most):
        n = int(rng.integers(least, most + 1))
        at = int(rng.integers(0, max(1, len(words) - n)))
        return esc(" ".join(words[at:at + n]))

    def pick(names):
        return names[int(rng.integers(len(names)))]

    def part(opening, inner, y=None):
        return f"<{opening}{'' if y is None else f' data-y={chr(34)}{y}{chr(34)}'}>{inner}</{opening.split()[0]}>"

    def links(n, most=3):
        return "".join(f'<li><a href="/{i}">{some(1, most)}</a></li>' for i in range(n))

    def menu():
        name = pick(MENUS)
        return part(name, links(int(rng.integers(2, 9))) if name.startswith("ul") else f"<ul>{links(int(rng.integers(2, 9)))}</ul>", 0)

    def side():
        body = f"<h3>{some(1, 4)}</h3>" + (f"<ul>{links(int(rng.integers(2, 6)), 9)}</ul>" if rng.random() < 0.6 else f"<p>{some(4, 25)}</p>")
        return part(pick(SIDES), body, 0)

    def comments():
        each = "".join(part(pick(['div class="comment"', 'li', 'li class="comment"', 'div']), f"<b>{some(1, 2)}</b> <p>{some(2, 40)}</p>" if rng.random() < 0.7 else some(2, 40)) for _ in range(int(rng.integers(1, 6))))
        return part(pick(COMMENTS), f"<h3>{some(1, 2)}</h3>" * int(rng.integers(0, 2)) + each, 0)

    def form():
        fields = "".join(f"<label>{some(1, 3)}</label><input name='x'>" for _ in range(int(rng.integers(1, 4))))
        return part(pick(FORMS), f"<p>{some(2, 12)}</p>{fields}<button>{some(1, 2)}</button>", 0)

    def box(names, least, most):
        body = some(least, most) if rng.random() < 0.5 else esc(other[int(rng.integers(len(other)))])
        return part(pick(names), body if rng.random() < 0.5 else f"<p>{body}</p>", 0)

    inside = []
    for b in main:
        tag = "h1" if b.shape[5] and not inside else "h2" if b.shape[5] else pick(["p", "p", "p", "p", "blockquote", "div"]) if rng.random() < 0.9 else "li"
        inside.append(f"<{tag}>{esc(b.text)}</{tag}>")
        if rng.random() < 0.04:
            inside.append(pick([side, form, lambda: box(ADVERTS, 3, 20), lambda: box(SHARES, 1, 5)])())
    if rng.random() < 0.15 and inside:
        inside[0] = f"<header>{inside[0]}</header>"
    if rng.random() < 0.25:
        inside.append(comments())
    if rng.random() < 0.1:
        inside.append(part("footer", some(3, 12), 0))
    body = part(pick(MAIN_PARTS), "".join(inside), 1) if main else ""
    if rng.random() < 0.3:
        body = f'<div class="wrapper">{body}</div>'
    maybe = [(0.5, lambda: box(HEADS, 1, 8)), (0.7, menu), (0.3, lambda: box(NOTICES, 4, 30)), (0.5, lambda: box(ADVERTS, 3, 25)), (0.2, form), (0.2, side)]
    before = "".join(make() for share, make in maybe if rng.random() < share)
    maybe = [(0.4, comments), (0.4, side), (0.3, lambda: box(ADVERTS, 3, 25)), (0.25, form), (0.2, lambda: box(SHARES, 1, 6)), (0.15, menu), (0.2, lambda: box(NOTICES, 4, 30)), (0.7, lambda: box(FEET, 3, 20))]
    after = "".join(make() for share, make in maybe if rng.random() < share)
    return f"<html><body>{before}{body}{after}</body></html>"


def train(pages: list[str], hidden: int = 16, epochs: int = 16, seed: int = 7) -> Labeller:
    """A labeller from pages without labels."""
    rng, examples = np.random.default_rng(seed), []
    for page in pages:
        blocks = page_blocks(page)
        if not blocks:
            continue
        y = teacher(blocks)
        examples.append((features(blocks), y))
        other = page_blocks(compose(blocks, y, rng))
        if other:
            examples.append((features(other), np.array([b.mark == 1 for b in other], dtype=np.float32)))
    model = Labeller(hidden=hidden, seed=seed)
    model.fit(examples, epochs=epochs, seed=seed)
    return model


# ------------------------------------------------------------------ use on tables

def train_labeller(df: DataFrame, html: str = "html", max_pages: int = 256, max_page_chars: int = 16384) -> Labeller:
    """Trains in one task on the ``max_pages`` pages of least hash among those of 1 to ``max_page_chars`` code points; of
    an empty table the labeller is untrained (and has nothing to label)."""
    pages = df.select(F.col(html).cast("string").alias("html")).filter(F.length("html").between(1, max_page_chars))
    sample = pages.orderBy(F.xxhash64("html"), "html").limit(max_pages).coalesce(1)

    def fit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = [t for part in parts for t in part["html"]]
        if texts:
            yield pd.DataFrame({"weights": [pickle.dumps(train(sorted(texts)).p)]})

    row = sample.mapInPandas(fit, "weights binary").first()
    model = Labeller()
    if row:
        model.p = pickle.loads(row.weights)
    return model


def label_pages(pages: list[list[Block]], model: Labeller) -> list[np.ndarray]:
    """Probability of main for every block of every page."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    lo = 0
    while lo < len(order):
        if len(pages[order[lo]]) > STRETCH:
            out[order[lo]] = model.long_scores(pages[order[lo]])
            lo += 1
            continue
        hi = lo + 1
        while hi < len(order) and len(pages[order[hi]]) <= STRETCH and len(pages[order[hi]]) * (hi - lo + 1) <= CELLS:
            hi += 1
        x, mask, _ = _padded([features(pages[i]) for i in order[lo:hi]])
        p = model.scores(x, mask)
        for j, i in enumerate(order[lo:hi]):
            out[i] = p[:len(pages[i]), j]
        lo = hi
    return out


def main_texts(pages: list[str | None], model: Labeller) -> list[str]:
    blocks = [page_blocks(p) for p in pages]
    return ["\n".join(b.text for b, s in zip(page, score) if s >= 0.5) for page, score in zip(blocks, label_pages(blocks, model))]


def extract_main_text(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), slice_rows: int = 256, **training) -> DataFrame:
    """``keep`` columns, text and n_chars of each row of ``df``: its main blocks in page order, joined by a line feed.

    A null or empty page, and one without main blocks, has the empty text; pages of any length are read whole; rows that
    repeat stay; an empty table stays empty.  Columns outside ``keep`` are not read; ``keep`` can't hold ``text`` or
    ``n_chars``."""
    if {"text", "n_chars"} & set(keep):
        raise ValueError("text and n_chars are the columns made here")
    model = train_labeller(df, html, **training)
    rows = df.select(*keep, df[html].cast("string").alias("__page"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, slice_rows):
                part = batch.slice(lo, slice_rows)
                texts = main_texts(part.column(part.num_columns - 1).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(extract, ", ".join([*fields, "text string", "n_chars long"]))
