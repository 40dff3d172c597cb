import hashlib
import time
import random
import re

from pyspark.sql import functions as F

from quarry.llm import credentials as cr
from tests.llm.conftest import SCHEMA, odd_rows

A = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in A.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def join(spans):
    return ",".join(f"{cr.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def every_part(text):
    """Strong and weak parts."""
    text = text or ""
    weak = [(m.start(), 3, m.end()) for m in A.finditer(text) if 6 <= len(m[2]) < 12]
    weak += [(m.start(), 3, m.end()) for m in re.finditer(cr.BARE, text)] + [(m.start(), 4, m.end()) for m in re.finditer(cr.ENDPOINT, text)]
    return sorted(set(base(text) + weak))


def linked(text, scope=200):
    """The gap between two parts counts, whatever their lengths."""
    parts, out = every_part(text), []
    for s, k, e in parts:
        near = {x[1] for x in parts if max(s - x[2], x[0] - e, 0) <= scope}
        if k == 3 and near & {1, 4} or k == 4 and near & {0, 1, 2, 3}:
            out.append((s, k, e))
    return out


def texts():
    rnd = random.Random(3)
    bits = ["password: hunter22", "secret = 'abcdefghijkl'", "token=abc", "password: token = abcdefghijklmnop", "API_KEY=\"Zz09+/_.=-Zz09\"", "AKIA" + "Z" * 13,
            "AKIA" + "Z9" * 8, "AKIAAKIA" + "Q" * 16, "deadbeef" * 2, "deadbeef" * 5, "f" * 15, "x" * 40, "https://db.example.com:5432/x", "host = db.example.org",
            "é🙂東", "plain words", "\n\n", "paſſword: abcdefghijklmnop", "tоken", "passwd : : abcdefghijklmno", "apikey:" + "a" * 300]
    out = [" ".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 25))) for _ in range(300)]
    out += ["".join(rnd.choice(bits + ["z " * 120]) for _ in range(rnd.randrange(0, 12))) for _ in range(300)]
    return out + ["password=" + "a" * 12, "password=" + "a" * 11 + " AKIA" + "A" * 14, "deadbeefdeadbeef"]


def test_matches_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    got = {r.doc_id: r for r in cr.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        b = base(t)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(x[1] == k for x in b) for k in (0, 1, 2)), t
        assert got[i].base_sha256 == hashlib.sha256(join(b).encode()).hexdigest(), t
        assert got[i].spans == join(b + linked(t)), t


def test_weak_parts_alone_are_not_reported(spark):
    rows = [(1, "password: hunter22"), (2, "password: hunter22 AKIA" + "B" * 16), (3, "password: hunter22" + " z" * 200 + " AKIA" + "B" * 16), (4, "see https://example.com/a")]
    got = {r.doc_id: r.n_linked for r in cr.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 0}


def test_odd_rows_and_dense_text(spark, odd_docs, no_docs):
    assert cr.scan_secrets(odd_docs).count() == len(odd_rows()) and cr.scan_secrets(no_docs).count() == 0
    dense = spark.range(1).select("id", F.repeat(F.lit("password: hunter22 host: a.example.com "), 3000).alias("text"))
    r = cr.scan_secrets(dense.withColumnRenamed("id", "doc_id")).collect()[0]
    assert r.n_linked == 6000


def test_long_parts_do_not_count_as_distance(spark):
    long = ["token=" + "a" * 300 + " host: db.example.com", "https://a.example.com/" + "p" * 400 + " password: hunter22", "f" * 500 + " https://db.example.com/x",
            "token=" + "a" * 300 + " z" * 150 + " host: db.example.com"]
    rows = [(i, t) for i, t in enumerate(long + texts())]
    got = {r.doc_id: r for r in cr.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].n_linked for i in range(4)] == [1, 2, 1, 0]
    for i, t in rows:
        assert got[i].spans == join(base(t) + linked(t)), t


def test_a_text_full_of_matches_takes_linear_time(spark):
    """Over a million code points, 40,000 matches of one pattern; places are those of a plain scan."""
    text = "".join(f"{i % 7 * 'é'}deadbeefdeadbeef{i % 3 * ' '} z" for i in range(40000))
    t = time.time()
    r = cr.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert r.n_hex == 40000 and r.base_sha256 == hashlib.sha256(join(base(text)).encode()).hexdigest()
    assert time.time() - t < 60
