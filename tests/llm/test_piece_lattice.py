import random
from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import piece_lattice as pl
from tests.llm.conftest import odd_rows

PATH = public_tokenizers.path("piece_bpe_32k.model")


def small(n, by_unit=True):
    p = pl.Pieces.__new__(pl.Pieces)
    words = ["a", "b", "ab", "aab", "ba", " ", " a", " ab", "  ", ".", "..", "_", "é"] + ([] if by_unit else ["b a", "a."])
    p._set({300 + i: w for i, w in enumerate(words)}, {300 + i: 1 + (i * 7 % 5) / 3 for i in range(len(words))}, {b: b for b in range(256)}, n)
    assert len(p.joins) == (0 if by_unit else 2)
    return p


def every_path(p, text):
    """(cost, ids) of all segmentations, by brute force."""
    text = " " + text if text else ""
    out = []

    def go(i, cost, ids):
        if i == len(text):
            out.append((cost, tuple(ids)))
            return
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in p.cost:
                c, k = p.cost[text[i:j]]
                go(j, cost + c, [*ids, k])
        if text[i] not in p.cost:
            raw = text[i].encode()
            go(i + 1, cost + p.byte_cost * len(raw), [*ids, *raw])

    go(0, 0, [])
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab ._é東▁", max_size=9), st.sampled_from([1, 2, 4, 7]), st.booleans())
def test_n_best_of_all_paths(text, n, by_unit):
    p = small(n, by_unit)
    cost, ids, others = p.segment(text)
    best = ids.tolist()
    got = [(cost, [])] + others
    paths = [tuple(pl.apply_edits(best, e)) for _, e in got]
    want = every_path(p, text)
    assert [c for c, _ in got] == [c for c, _ in want[:n]]
    assert len(set(paths)) == len(paths)
    costs = {ids: c for c, ids in want}
    assert all(costs[x] == c for x, (c, _) in zip(paths, got))
    assert all(p.decode(x) == text for x in paths)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_round_trip_of_any_text(text):
    p = pl.Pieces.open(PATH, 3)
    assert len(p.joins) < 10
    _, ids, others = p.segment(text)
    assert all(p.decode(pl.apply_edits(ids.tolist(), e)) == text for _, e in [(0, []), *others])


def test_viterbi_of_whole_text_equals_units():
    p = pl.Pieces.open(PATH, 4)
    rnd = random.Random(0)
    for _ in range(30):
        text = "".join(rnd.choice(["the ", "tion", "é", "  ", "1", "2", "x².", "²", ", ", "\n", "ß", "word", "_x", "🙂"]) for _ in range(12))
        whole = p.n_best(" " + text, 4)
        cost, _, others = p.segment(text)
        assert [cost, *(c for c, _ in others)] == [c for c, _ in whole]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .é東", min_size=1, max_size=9))
def test_best_and_gap(text):
    p = small(2)
    cost, ids, gap = p.best(" " + text)
    paths = every_path(p, text)
    assert cost == paths[0][0] and (cost, ids) in paths and gap == (paths[1][0] - cost if len(paths) > 1 else -1)


def test_small_cache_changes_nothing(monkeypatch):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("ab") * rnd.randrange(1, 9) for _ in range(20)) for _ in range(60)]
    want = [[x.tolist() if hasattr(x, "tolist") else x for x in small(4).segment(t)] for t in texts]
    monkeypatch.setattr(pl, "CACHE", 3)
    p = small(4)
    assert [[x.tolist() if hasattr(x, "tolist") else x for x in p.segment(t)] for t in texts] == want


@pytest.mark.parametrize("n", [1, 4])
def test_documents(spark, odd_docs, no_docs, n):
    got = pl.encode_pieces(odd_docs, PATH, n=n).select("doc_id", "text", "name", "pieces.*").collect()
    assert len(got) == len(odd_rows()) and all(r.round_trip and r.name == "clash" for r in got)
    for r in got:
        assert len(r.others) <= n - 1 and [o.score for o in r.others] == sorted((o.score for o in r.others), reverse=True)
        if not r.text:
            assert r.ids == [] and r.score == 0 and r.others == []
    back = pl.decode_pieces(pl.encode_pieces(odd_docs, PATH, n=n).select("text", "pieces.ids"), PATH, name="again")
    assert all((r.text or "") == r.again for r in back.collect())
    assert pl.encode_pieces(no_docs, PATH).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab ._é東▁", min_size=1, max_size=9), min_size=1, max_size=30, unique=True), st.booleans())
def test_units_searched_together_are_as_alone(units, by_unit):
    p = small(4, by_unit)
    p._learn(units)
    for u in units:
        cost, ids, gap = p.best(u)
        assert p.known[u] == (cost, array("i", ids).tobytes(), gap, len(ids))


def test_common_words_are_searched_together(monkeypatch):
    p = pl.Pieces(PATH, 4)
    rnd = random.Random(8)
    words = list({" " + "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(1, 20))) for _ in range(3000)})
    alone = {w: p.best(w) for w in words}
    monkeypatch.setattr(pl, "TOGETHER", 500)
    monkeypatch.setattr(pl.Pieces, "best", lambda self, unit: pytest.fail("searched alone"))
    p._learn(words)
    assert all(p.known[w] == (c, array("i", ids).tobytes(), gap, len(ids)) for w, (c, ids, gap) in alone.items())


def test_groups_of_texts_and_a_full_cache(monkeypatch):
    p, q = small(4), small(4)
    rnd = random.Random(9)
    texts = [None, ""] + ["".join(rnd.choice("ab ._é東") for _ in range(rnd.randrange(60))) for _ in range(50)]
    want = [(c, ids.tolist(), o) for c, ids, o in map(q.segment, texts)]
    monkeypatch.setattr(pl, "GROUP", 100)
    monkeypatch.setattr(pl, "CACHE", 16)
    assert [(c, ids.tolist(), o) for c, ids, o in p.segments(texts)] == want
