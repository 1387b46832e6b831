import random
from collections import defaultdict
from itertools import combinations

import numpy as np

from panelmint.llm.near_dedup import SetSketch, drop_near, near_groups, shingle_sets
from tests.llm.conftest import ODD


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """component of each doc_id; rows that share a doc_id are one document."""
    sets = [(i, sets_of(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            i, j = sorted((find(i), find(j)))
            root[j] = i
    return {i: find(i) for i in root}


def family(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, doc = [], 100
    for _ in range(25):
        base = rng.choices(words, k=rng.choice((8, 40, 120)))
        for _ in range(rng.choice((1, 2, 12))):
            text = list(base)
            for _ in range(rng.choice((0, 1, 2, 4))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((doc, " ".join(text)))
            doc += rng.choice((1, 3))
    rng.shuffle(rows)
    return rows


def test_groups_match_brute_force(spark):
    rows = family(3)
    want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (1024, 3):  # buckets in one piece, and cut into many
        got = near_groups(docs, block=block).collect()
        assert {r.doc_id: r.component_id for r in got} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
        assert {r.doc_id: r.n_shingles for r in got} == {i: len(sets_of(t)) for i, t in rows}


def test_odd_rows_and_empty(odd, empty):
    got = near_groups(odd).collect()
    want = brute([(r[0], r[1]) for r in ODD])
    assert len(got) == len(ODD)
    for r in got:
        assert (r.component_id, r.kept) == ((None, True) if r.doc_id is None else (want[r.doc_id], want[r.doc_id] == r.doc_id))
    assert sorted((r.doc_id or 0) for r in drop_near(odd).collect()) == [0, 1, 2, 3, 4, 6, 8]
    assert drop_near(odd).columns == odd.columns and near_groups(empty).count() == 0


def test_sketches_merge_and_estimate():
    sketch = SetSketch()
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    a, b = np.unique(pool[:2500]), np.unique(pool[500:])
    ra, rb, rab = sketch.sketch([a, b, np.unique(pool)])
    assert (np.maximum(ra, rb) == rab).all()
    same = sketch.likely(ra, np.stack([ra, rb]), len(a), np.array([len(a), len(b)]), 0.75)
    assert same.tolist() == [True, True] or same[0]
    far = sketch.sketch([np.unique(rng.integers(0, 2**63, 2500).astype(np.uint64))])
    assert not sketch.likely(ra, far, len(a), np.array([2500]), 0.75)[0]
    assert [len(s) for s in shingle_sets(["", "a b", "A b", "a b c d e f"])] == [0, 1, 1, 2]
