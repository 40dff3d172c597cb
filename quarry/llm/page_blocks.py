"""Leaf blocks of an HTML page in page order: text, hashed tag path, hashed words, shape.

One pass over the markup in linear time: a regular expression cuts comments, raw text elements and tags; a stack of open
elements with counts gives each block its path.  A block ends where a block-level element starts or ends.  Character
references are decoded, white space inside a block becomes one space, empty blocks are left out.
"""
from __future__ import annotations

import html as html_lib
import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np

PATH, WORDS, SHAPE = 128, 64, 10
WIDTH = PATH + WORDS + SHAPE

# Fixed values of HTML: elements without content, elements whose content isn't markup, inline elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|title|textarea|noscript|iframe|noembed|noframes|xmp|template|svg|math|object|audio|video|canvas"
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr
    svg math object audio video canvas iframe noscript script style template textarea title picture map""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element that a start tag of the same group ends, up to the nearest element that can hold both.
SAME = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
SAME = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in SAME.items()}

TOKEN = re.compile(rf"""<!--.*?(?P<comment>-->|\Z)
    |<(?P<raw>{RAW})(?=[\s/>])(?:[^<>"']++|"[^"]*+"|'[^']*+')*+(?<!/)>.*?(?P<raw_end></(?P=raw)(?=[\s/>])[^>]*+>|\Z)
    |<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attributes>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<attributes2>[^>]*+)>
    |<[!?/][^>]*+>""", re.S | re.I | re.X)
UNFINISHED = re.compile(r"<[A-Za-z/!?]")
ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|data-y)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# What names say of a part of a page; the teacher of the labeller reads them, the labeller itself sees hashes alone.
MAIN = frozenset("article main articlebody story post entry content".split())
ASIDE = frozenset("""nav footer aside form button select dialog menu navigation breadcrumb breadcrumbs sidebar side ad ads advert advertisement banner sponsor sponsored promo
    cookie cookies consent gdpr notice alert popup modal overlay header masthead topbar comment comments reply replies disqus related recommended teaser share sharing
    social newsletter subscribe signup login search pager pagination widget toolbar legal copyright contentinfo complementary""".split())


@dataclass(slots=True)
class Block:
    text: str
    path: bytes          # hashed tag path, a count each up to 2
    words: bytes         # hashed words
    shape: tuple         # numbers about the text
    main: int            # open elements whose names say main
    aside: int           # open elements whose names say something else
    mark: int            # the label that a composed page gives, or -1


def _buckets(name: str) -> tuple[int, int]:
    h = zlib.crc32(name.encode())
    return h % PATH, (h >> 12) % PATH


class _WordBuckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        bucket = self[word] = zlib.crc32(word.lower().strip(".,;:!?()[]\"'").encode()) % WORDS
        return bucket


_bucket_of = _WordBuckets().__getitem__


def _hash_words(words: list[str]) -> bytes:
    return np.minimum(np.bincount(list(map(_bucket_of, words)), minlength=WORDS), 255).astype(np.uint8).tobytes()


class _Element:
    """An open element: what its names say, and a mark (-1: that of the element around it)."""
    __slots__ = ("name", "inline", "buckets", "main", "aside", "mark")

    def __init__(self, name: str, attributes: str, in_main: bool):
        names, self.name, self.mark, self.inline = {name}, name, -1, name in INLINE
        for kind, a, b, c in ATTRIBUTE.findall(attributes):
            value = a or b or c
            if kind.lower() == "data-y":
                self.mark = int(value == "1")
            else:
                names.update(x.lower() for x in NAME_PARTS.findall(value))
        self.buckets = () if self.inline else tuple(b for n in sorted(names) for b in _buckets(n))
        self.main = int(bool(names & MAIN))
        said = names & ASIDE
        if in_main and name == "header" and said == {"header"}:     # an article's own header holds its title
            said = ()
        self.aside = int(bool(said))


_PLAIN: dict[tuple[str, str, bool], _Element] = {}


def _element(name: str, attributes: str, in_main: bool) -> _Element:
    if attributes and not ATTRIBUTE.search(attributes):
        attributes = ""
    key = (name, attributes, in_main)
    found = _PLAIN.get(key)
    if found is None:
        if len(_PLAIN) > 20_000:
            _PLAIN.clear()
        found = _PLAIN[key] = _Element(*key)
    return found


def page_blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page; none of a null or empty one."""
    page, out = page or "", []
    stack: list[_Element] = []
    opened: Counter[str] = Counter()
    counts, path = [0] * PATH, bytearray(PATH)           # of open elements; the path holds 2 at most
    marks = [-1]
    text: list[str] = []
    linked, depth_main, depth_aside, links = 0, 0, 0, 0

    def flush(own: str) -> None:
        nonlocal text, linked
        words = "".join(text).split() if text else ()
        text, in_links, linked = [], linked, 0
        if not words:
            return
        t = " ".join(words)
        n = len(t)
        shape = (math.log1p(n) / 8, math.log1p(len(words)) / 6, min(1.0, in_links / n), float(t[-1] in ".!?…:;\"”»"), float(t[0].isupper()),
                 float(own in HEADINGS), float(own == "p"), float(own == "li"), math.log1p(len(stack)) / 4, 1.0)
        out.append(Block(t, bytes(path), _hash_words(words), shape, depth_main, depth_aside, marks[-1]))

    def pop() -> None:
        nonlocal depth_main, depth_aside, links
        e = stack.pop()
        marks.pop()
        opened[e.name] -= 1
        for b in e.buckets:
            counts[b] -= 1
            if counts[b] < 2:
                path[b] = counts[b]
        depth_main -= e.main
        depth_aside -= e.aside
        links -= e.name == "a"

    def close(names: frozenset, until: frozenset) -> None:
        """Ends the nearest open element of ``names``, unless one of ``until`` is nearer."""
        for i in range(len(stack) - 1, -1, -1) if any(opened[n] > 0 for n in names) else ():
            if stack[i].name in names:
                while len(stack) > i:
                    pop()
                return
            if stack[i].name in until:
                return

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            t = html_lib.unescape(raw) if "&" in raw else raw
            text.append(t)
            if links:
                linked += len(t)

    at, end = 0, page.rfind(">") + 1                     # no tag ends behind this
    for m in TOKEN.finditer(page, 0, end):
        add(page[at:m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            if "" in (m["comment"], m["raw_end"]):       # not ended: the rest of the page is part of it
                at = end = len(page)
            continue
        name, closing, attributes = name.lower(), m["end"] or m["end2"], m["attributes"] or m["attributes2"] or ""
        if name in INLINE:
            if not closing:
                if attributes.endswith("/"):
                    continue
            elif opened[name] > 0:
                for i in range(len(stack) - 1, -1, -1):
                    if not stack[i].inline:              # not across a block
                        break
                    if stack[i].name == name:
                        while len(stack) > i:
                            pop()
                        break
                continue
            else:
                continue
        elif name in VOID:
            text.append(" ")
            if name == "hr":
                flush(stack[-1].name if stack else "")
            continue
        else:
            if text:
                flush(next((e.name for e in reversed(stack) if not e.inline), ""))
            if closing:
                if opened[name] > 0:
                    while stack[-1].name != name:
                        pop()
                    pop()
                continue
            if opened["p"] > 0:                          # a block ends an open paragraph with what is open in it
                i = len(stack) - 1
                while i >= 0 and stack[i].inline:
                    i -= 1
                if i >= 0 and stack[i].name == "p":
                    while len(stack) > i:
                        pop()
            if name in SAME:
                close(*SAME[name])
            if attributes.endswith("/"):
                continue
        stack.append(e := _element(name, attributes, depth_main > 0))
        marks.append(e.mark if e.mark >= 0 else marks[-1])
        opened[name] += 1
        for b in e.buckets:
            counts[b] += 1
            if counts[b] <= 2:
                path[b] = counts[b]
        depth_main += e.main
        depth_aside += e.aside
        links += name == "a"
    if at < end:
        add(page[at:end])
    tail = page[max(at, end):]
    cut = UNFINISHED.search(tail)
    add(tail[:cut.start()] if cut else tail)
    flush(next((e.name for e in reversed(stack) if not e.inline), ""))
    return out


def features(blocks: list[Block], lo: int = 0, hi: int | None = None) -> np.ndarray:
    """Rows of the labeller's input for blocks ``lo`` to ``hi`` of a page."""
    hi, n = len(blocks) if hi is None else hi, len(blocks)
    part = blocks[lo:hi]
    out = np.empty((len(part), WIDTH), dtype=np.float32)
    out[:, :PATH] = np.frombuffer(b"".join(b.path for b in part), dtype=np.uint8).reshape(-1, PATH)
    words = np.frombuffer(b"".join(b.words for b in part), dtype=np.uint8).reshape(-1, WORDS).astype(np.float32)
    out[:, PATH:PATH + WORDS] = words / np.maximum(1, np.sqrt((words * words).sum(axis=1)))[:, None]
    out[:, PATH + WORDS:] = [b.shape for b in part]
    out[:, -1] = (np.arange(lo, hi) + 0.5) / n            # its place in the page
    return out
