import hashlib
import re
from collections import defaultdict

import pytest

from quarry.llm import block_naming as bn
from tests.llm.conftest import odd_rows


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    out = []
    for norm, g in groups.items():
        best = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], best[0], len(g), hashlib.sha256(norm.encode()).hexdigest()) for r in g]
    return sorted(map(repr, out)), len(groups)


@pytest.mark.parametrize("block", [1, 7, 2048])
def test_matches_brute_force(odd_docs, block):
    docs = odd_docs if block > 1 else odd_docs.filter("coalesce(length(text), 0) < 1000")
    rows = [r for r in odd_rows() if block > 1 or len(r[1] or "") < 1000]
    got = bn.exact_dedup(docs, block_chars=block).collect()
    want, groups = brute(rows)
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.keep_id == r.doc_id for r in got if r.kept)


def test_stage_keeps_columns_and_one_row_a_group(odd_docs):
    out = bn.drop_exact_copies(odd_docs)
    assert out.columns == odd_docs.columns and {r["__src_pos"] for r in out.collect()} == {"clash"}
    assert out.count() == brute(odd_rows())[1]


def test_empty_table(no_docs):
    assert bn.exact_dedup(no_docs).count() == 0
    assert bn.drop_exact_copies(no_docs).count() == 0
