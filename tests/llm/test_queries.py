"""Registered queries against their SQL, and contracts of those without, on the driver's smallest tables."""
import hashlib
import re
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_credentials import base, join
from tests.llm.test_simhash_trie import brute_components, brute_print
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    problems = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF_SMALL, duck, verbose=False)
    assert not problems, problems


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def rows(spark, n):
    name = next(k for k in QUERIES if k.startswith(f"op{n}_"))
    return QUERIES[name](spark, SF_SMALL).collect()


def test_token_store(spark, texts):
    t, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = sorted(rows(spark, 1), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == sorted(texts)
    for r in got:
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        at += len(ids)


def test_near_dedup(spark, texts):
    items = [(i, brute_print(t)) for i, t in texts.items()]
    comp = brute_components(items)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows(spark, 5)} == {(i, f"{p:016x}", comp[p]) for i, p in items}


def test_secrets(spark, texts):
    got = rows(spark, 10)
    assert len(got) == len(texts)
    for r in got:
        assert r.base_sha256 == hashlib.sha256(join(base(texts[r.doc_id])).encode()).hexdigest()


def test_mix(spark, texts):
    got = rows(spark, 6)
    by = {}
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])) and r.taken <= 3 * r.size
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert sum(s for s, _ in by) == pytest.approx(sum(t for _, t in by))
    assert all(abs(sum(taken) - target) <= 1 for (_, target), taken in by.items())
