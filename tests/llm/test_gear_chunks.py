import hashlib
import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import gear_chunks as gc
from tests.llm.conftest import SCHEMA


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é東🙂\n", max_size=400), st.sampled_from([(3, 4, 16), (2, 8, 24), (6, 32, 64)]))
def test_cuts_cover_the_text_at_characters(text, how):
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    cuts = gc.cut_points(data, *how)
    assert cuts == sorted(set(cuts)) and (cuts[-1:] == [len(raw)] if raw else not cuts)
    sizes = np.diff([0, *cuts])
    assert (sizes <= how[2]).all()
    s, e, d = gc.chunk_text(text, *how)
    assert "".join(text[a:b] for a, b in zip(s, e)) == text and len(d) == len(cuts)
    if len(raw) > 40:
        h = 0
        for b in raw:
            h = (h * 2 + int(gc.GEAR[b])) & 0xFFFFFFFF
        assert int(gc.gear_hashes(data)[-1]) == h  # bytes further back than 32 have left the 32-bit hash


def test_cuts_resist_an_insertion():
    rnd = random.Random(1)
    text = " ".join(f"w{rnd.randrange(3000)}" for _ in range(3000))
    a = set(gc.chunk_text(text, 5, 32, 512)[2])
    b = set(gc.chunk_text(text[:5000] + "INSERTED" + text[5000:], 5, 32, 512)[2])
    assert len(a - b) <= 4


def plain_chunks(text, mask_bits, least, most):
    """A chunker of its own, byte by byte: (start, end, bytes) with places in code points."""
    raw, out, h, last = (text or "").encode(), [], 0, 0
    for i, b in enumerate(raw):
        h = (2 * h + int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little")) % 2 ** 32 if i else int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little")
        end = i + 1
        whole = end == len(raw) or raw[end] & 0xC0 != 0x80
        cut = whole and (h < 2 ** (32 - mask_bits) or end == len(raw))
        if cut:
            while end - last > most:
                at = last + most
                while at < len(raw) and raw[at] & 0xC0 == 0x80:
                    at -= 1
                out.append((last, at))
                last = at
            if end - last >= least or end == len(raw) and end > last:
                out.append((last, end))
                last = end
    return [(len(raw[:a].decode()), len(raw[:b].decode()), raw[a:b]) for a, b in out]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab é東🙂\n", max_size=300), st.sampled_from([(3, 4, 16), (2, 8, 24), (4, 16, 256)]))
def test_chunks_are_those_of_a_plain_chunker(text, how):
    s, e, _ = gc.chunk_text(text, *how)
    assert list(zip(s, e)) == [x[:2] for x in plain_chunks(text, *how)]


def test_recall_of_short_passages(spark, duck):
    """Passages of 51 words of real texts, put into two other texts each."""
    rnd = random.Random(1)
    texts = [t for t, in duck.execute("SELECT text FROM read_parquet('/root/testdata/sf0.01/documents.parquet') WHERE length(text) > 1200 ORDER BY hash(doc_id)").fetchall()]
    used = [t.split() for t in texts]
    rows, n = [], 120
    for i in range(n):
        source, a, b = rnd.sample(used, 3)
        at = rnd.randrange(len(source) - 51)
        passage = " ".join(f"{w}{i}" if j % 17 == 0 else w for j, w in enumerate(source[at:at + 51]))      # its own, whatever else repeats
        for k, other in enumerate((a, b)):
            cut = rnd.randrange(len(other))
            before = " ".join(f"{w}{2 * i + k}" if j % 5 == 0 else w for j, w in enumerate(other[:cut]))     # texts share nothing else
            after = " ".join(f"{w}{2 * i + k}" if j % 5 == 0 else w for j, w in enumerate(other[cut:]))
            rows.append((2 * i + k, before + " " + passage + " " + after, len(before) + 1, len(before) + 1 + len(passage)))
    df = spark.createDataFrame(rows, "doc_id long, text string, a int, b int").cache()
    for least, options in ((0.75, {}), (0.9, {"mask_bits": 4, "min_bytes": 16, "max_bytes": 256})):
        spans = {}
        for r in gc.repeated_passages(df, **options).collect():
            spans.setdefault(r.doc_id, []).append((r.start, r.end))
        found = {d for d, _, a, b in rows if any(min(e, b) - max(s, a) > 60 for s, e in spans.get(d, ()))}
        assert sum({2 * i, 2 * i + 1} <= found for i in range(n)) / n >= least


def brute(rows, how, min_run):
    chunks = [plain_chunks(r[1], *how) for r in rows]
    where = defaultdict(list)
    for r, cs in enumerate(chunks):
        for n, (_, _, d) in enumerate(cs):
            where[d].append(((rows[r][0] is None, rows[r][0] or 0), n, r))
    out = []
    for r, cs in enumerate(chunks):
        dup = [len({x[2] for x in where[d]}) > 1 for _, _, d in cs]
        n = 0
        while n < len(cs):
            if not dup[n]:
                n += 1
                continue
            m = n
            while m < len(cs) and dup[m]:
                m += 1
            if cs[m - 1][1] - cs[n][0] >= min_run:
                keep = [min(where[cs[i][2]])[1:] == (i, r) for i in range(n, m)]
                i = n
                while i < m:
                    j = i
                    while j < m and keep[j - n] == keep[i - n]:
                        j += 1
                    out.append((rows[r][0], cs[i][0], cs[j - 1][1], j - i, keep[i - n]))
                    i = j
            n = m
    return sorted(map(repr, out))


def passages():
    rnd = random.Random(8)
    fresh = lambda n: " ".join(f"v{rnd.randrange(10**6)}" for _ in range(n))
    shared = [fresh(60) for _ in range(4)] + ["é東 " * 90]
    rows = [(i, " ".join([fresh(rnd.randrange(5, 60)), rnd.choice(shared) if i % 3 else fresh(20), fresh(rnd.randrange(30))])) for i in range(60)]
    rows += [(60, None), (61, ""), (None, shared[0]), (62, rows[3][1]), (63, fresh(4000)), (64, "x" * 3000), (65, (fresh(30) + " ") * 8)]
    return rows, shared


def test_matches_brute_force(spark):
    rows, shared = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)  # the order of rows breaks ties
    got = gc.repeated_passages(df).collect()
    assert sorted(repr((r.doc_id, r.start, r.end, r.n_chunks, r.kept)) for r in got) == brute(rows, (5, 32, 512), 120)
    hit = {r.doc_id for r in got}
    assert {i for i, t in rows if t and any(s in t for s in shared[:4])} <= hit  # every planted passage is seen
    assert not hit & {i for i, t in rows if t and not any(s in t for s in shared) and i != 62 and i != 3}


def test_cut_texts_and_odd_rows(spark, odd_docs, no_docs):
    rows, shared = passages()
    df = spark.createDataFrame([(i, t, "en", None, 0, "a", "b", "c") for i, t in rows], SCHEMA)
    out = gc.drop_repeated_passages(df)
    assert out.count() == len(rows) and out.columns == df.columns
    total = " ".join(r.text or "" for r in out.collect())
    for s in shared[:4]:
        assert total.count(s[100:-100]) == 1
    kept = gc.drop_repeated_passages(odd_docs)
    assert kept.columns == odd_docs.columns and [r["__src_pos"] for r in kept.collect()] == ["clash"] * odd_docs.count()
    assert gc.repeated_passages(no_docs).count() == 0 and gc.drop_repeated_passages(no_docs).count() == 0
