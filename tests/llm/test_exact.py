import hashlib
import re
from collections import Counter

import pytest

from panelmint.llm.exact_dedup import drop_exact, exact_groups
from tests.llm.conftest import ODD


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("options", [{}, {"block_bytes": 7}, {"block_bytes": 64, "buckets": 2}])
def test_groups_match_brute_force(odd, options):
    """Also with many levels of pairs, and with nearly all blocks in collision."""
    got = exact_groups(odd, **options).collect()
    sizes = Counter(norm(r[1]) for r in ODD)
    keep = {t: min((r[0] for r in ODD if norm(r[1]) == t and r[0] is not None), default=None) for t in sizes}
    want = Counter((r[0], keep[norm(r[1])], sizes[norm(r[1])], hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in ODD)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in sizes})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_keeps_columns_and_one_of_each(odd):
    left = drop_exact(odd)
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 4, 6, 7, 8, 9]


def test_empty(empty):
    assert exact_groups(empty).count() == 0 and drop_exact(empty).count() == 0
