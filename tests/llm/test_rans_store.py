import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import rans_store as rs
from quarry.llm.byte_bpe import Words
from quarry.llm.common import scratch_dir
from tests.llm.conftest import odd_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)


def coder_for(ids, bits=16):
    every, n = np.unique(ids, return_counts=True)
    return rs.Coder(every, rs.scaled(n, bits))


@pytest.mark.parametrize("n", [1, 5, 1023, 1024, 1025, 2100, 20000])
@pytest.mark.parametrize("kind", ["one", "two", "flat", "steep"])
def test_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {"one": np.full(n, 7), "two": rng.integers(0, 2, n) * 50000, "flat": rng.integers(0, 60000, n), "steep": np.minimum(rng.geometric(0.02, n), 400)}[kind].astype(np.uint32)
    c = coder_for(ids)
    words, marks = c.encode(ids, 2048)
    assert (c.decode(words, marks, n) == ids).all()
    assert [m[0] for m in marks] == list(range(0, n, 2048))
    for i, m in enumerate(marks):  # each checkpoint alone
        stop = marks[i + 1][0] if i + 1 < len(marks) else n
        shifted = [(0, m[1], m[2])]
        assert (c.decode(words, shifted, stop - m[0]) == ids[m[0]:stop]).all()


def test_size_is_near_the_entropy():
    ids = np.minimum(np.random.default_rng(0).geometric(0.01, 200000), 1500).astype(np.uint32)
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    words, marks = coder_for(ids).encode(ids, 1 << 16)
    assert len(words) * 8 < 1.02 * len(ids) * -(p @ np.log2(p)) + 64 * rs.LANES


def test_scaled_sums():
    for counts in ([1], [1, 10**15], [5, 0, 3], [1] * 1000):
        f = rs.scaled(np.array(counts, dtype=np.int64), 12)
        assert f.sum() == 4096 and ((f > 0) == (np.array(counts) > 0)).all()


TRICKY = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n a", "a\t b", "it's  'll <|endoftext|> x", "x <|endoftext|>", "é 東京 🙂 x", "1 2 33", "a　b 　c", "a \xa0b", "a\x1c b \x1cc", " \x85 d", "..  ...", "x\r\n  y"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sé東 \n\t\xa0　\x1c\x85᠎​1.<|>", max_size=40))
def test_words_equal_whole_text(text):
    w = Words.open(PATH, 2)
    assert w.by_word
    assert w.encode([text])[0].tolist() == WHOLE.encode(text, add_special_tokens=False).ids + [2]


def test_tricky_texts():
    w = Words.open(PATH, 2)
    want = [WHOLE.encode(x, add_special_tokens=False).ids + [2] for x in TRICKY]
    assert [x.tolist() for x in w.encode(TRICKY)] == want


def store(df, path, **options):
    rs.write_ids(df, lambda texts: Words.open(PATH, 2).encode(texts), path, **options)


@pytest.mark.parametrize("options", [{}, {"block_tokens": 40, "mark_tokens": 1024}])
def test_files(spark, odd_docs, options):
    path = scratch_dir(spark, "rans-test")
    store(odd_docs, path, **options)
    got = rs.read_checksums(spark, path).collect()
    ids = {(r.start, r.n_tokens): r.ids for r in rs.read_ids(spark, path).collect()}
    rows = sorted(odd_rows(), key=lambda r: (r[0] is None, r[0] or 0))
    want = [(r[0], WHOLE.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows]
    crc = lambda x: zlib.crc32(np.array(x, dtype="<u4").tobytes())
    assert sorted(repr((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got) == sorted(repr((i, len(x), crc(x))) for i, x in want)
    got.sort(key=lambda r: r.start)
    at = 0
    for r, (i, _) in zip(got, want):
        assert r.start == at and r.doc_id == i and crc(ids[r.start, r.n_tokens]) == r.ids_crc32
        at += r.n_tokens


def test_empty_table(spark, no_docs):
    path = scratch_dir(spark, "rans-empty")
    store(no_docs, path)
    assert rs.read_checksums(spark, path).count() == 0


def test_damage_is_seen(spark):
    path = scratch_dir(spark, "rans-bad")
    store(spark.createDataFrame([(1, "some text to damage")], "doc_id long, text string"), path)
    bad = scratch_dir(spark, "rans-bad")
    spark.read.parquet(f"{path}/freqs").write.parquet(f"{bad}/freqs")
    spark.read.parquet(f"{path}/blocks").selectExpr("* EXCEPT (crc32)", "crc32 + 1 AS crc32").write.parquet(f"{bad}/blocks")
    with pytest.raises(Exception, match="checksum"):
        rs.read_ids(spark, bad).collect()
