"""Spelling variants against all pairs of a small vocabulary."""
import random
import re
import zlib
from collections import Counter

import pytest

from quarry.llm import gram_variants
from quarry.llm.gram_variants import affected, decompose, document_words, longest, near_words, parity, prefix, spelling_variants, variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(vocab, ratio=10):
    out = {}
    for w, n in vocab.items():
        close = [x for x in vocab if near(w, x)]
        best = min(close, key=lambda x: (-vocab[x], x), default=None)
        form = best if best is not None and vocab[best] >= ratio * n else None
        out[w] = [w, form, None, n, len(close), vocab[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][1]:
            root = out[root][1]
        row[2] = root
    return {tuple(r) for r in out.values()}


def words_of(rows, min_len=7, every=31):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_len:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 2}


def mutate(w, rnd, letters):
    i, kind = rnd.randrange(len(w)), rnd.randrange(3)
    return w[:i] + (rnd.choice(letters) if kind else "") + w[i + (kind != 1):]


def got(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("letters,least,many", [("ab", 1, 400), ("abcé", 3, 500), ("abcdefghij", 40, 400)])
def test_every_pair_is_found(spark, monkeypatch, letters, least, many):
    """Few letters: frequent grams, long lists, repeated grams; the dictionary's bound varies."""
    rnd = random.Random(len(letters))
    words = {"".join(rnd.choice(letters) for _ in range(rnd.choice([4, 5, 7, 8, 9, 12, 16]))) for _ in range(many)}
    words |= {mutate(w, rnd, letters) for w in list(words)}
    words |= {letters[0] * i for i in range(4, 30)}
    vocab = {w: rnd.choice([2, 3, 20, 50, 700, 9000]) for w in words if len(w) >= 4}
    monkeypatch.setattr(gram_variants, "FREQUENT", sum(map(len, vocab)) // least)
    df = spark.createDataFrame([(w, n, "clash") for w, n in vocab.items()], "word string, n long, near string")
    assert got(variants(df)) == brute(vocab)


def test_bound_of_affected_grams():
    """Near words share at least m - a grams, and one of both prefixes at a place shifted by one at most."""
    rnd = random.Random(1)
    frequent = {"aba": 9, "abab": 5, "bab": 7, "\x02ab": 3, "ba\x03": 4, "aaa": 6, "aaaa": 2}
    for _ in range(4000):
        w = "".join(rnd.choice("ab") for _ in range(rnd.randrange(7, 14)))
        x = mutate(w, rnd, "ab")
        if len(x) < 7 or x == w:
            continue
        most = longest(min(len(w), len(x)))
        a, b = decompose(w, most, frequent), decompose(x, most, frequent)
        shared = sum((Counter(g for _, g in a) & Counter(g for _, g in b)).values())
        assert shared >= max(len(a) - affected(a), len(b) - affected(b)) >= 1
        assert any(g == h and abs(p - q) <= 1 for p, g in prefix(w, most, frequent) for q, h in prefix(x, most, frequent))


def test_odd_documents(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(50 + i, t) for i, t in enumerate(["Étudiant ÉTUDIANT étudiant", "couleurs couleur. Couleurs", "seven_letters×÷× xxxxxxxxxxxxxxx" * 3, "a" * 50000 + " " + "a" * 50000])]
    rows += [(1000 + i, "elephant giraffe elephant") for i in range(300)] + [(2000 + i, "elephants") for i in range(30)] + [(3000 + i, "elephantsz") for i in range(2)] + [(None, "elefhant elefhant elephan elephan"), (7, "elefhan elefhan")]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, word string, n long")
    vocab = words_of(rows)
    assert {(r.word, r.n) for r in document_words(df).collect()} == set(vocab.items())
    assert any(f and r != f for _, f, r, *_ in brute(vocab)) and got(spelling_variants(df)) == brute(vocab)


def test_empty_and_short(spark, no_docs):
    assert spelling_variants(no_docs).collect() == []
    with pytest.raises(ValueError, match="4 code points"):
        spelling_variants(no_docs, min_len=3)
    with pytest.raises(ValueError, match="ratio"):
        variants(no_docs, ratio=1)


def test_one_edit_turns_two_bits_at_most():
    rnd = random.Random(6)
    letters = "abcxyzàÿ\u0130東🙂"
    for _ in range(2000):
        w = "".join(rnd.choice(letters) for _ in range(rnd.randrange(4, 12)))
        p, c = rnd.randrange(len(w)), rnd.choice(letters)
        for near in (w[:p] + w[p + 1:], w[:p] + c + w[p:], w[:p] + c + w[p + 1:]):
            assert -(1 << 63) <= parity(near) < 1 << 63
            assert ((parity(w) ^ parity(near)) & ((1 << 64) - 1)).bit_count() <= 2


def test_words_that_meet_are_told_apart_before_the_edit_distance(spark):
    plans, write = [], gram_variants.materialize

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(df, name)

    vocab = spark.createDataFrame([("letters", 3), ("lettert", 40), ("setters", 2), ("letter", 9), ("retells", 5), ("dàÿletters", 2)], "word string, n long")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(gram_variants, "materialize", noted)
        got = {(r.word, r.near) for r in near_words(vocab).collect()}
    pairs = [("letters", "lettert"), ("letters", "setters"), ("letters", "letter"), ("lettert", "letter")]
    assert got == {*pairs, *((b, a) for a, b in pairs)}
    plan = dict(plans)["near-words"]
    assert 0 < plan.index("bit_count(") < plan.index("levenshtein(")
