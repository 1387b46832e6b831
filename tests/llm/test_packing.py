import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from panelmint.llm.packing import WordEncoder, encoder, lots, match_runs, pack
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_equals_the_tokenizer():
    odd = ["", " ", "  a", "a  b", "a \n b", "x\n", "\tq r", "a b ", "don't we're ", "<|endoftext|> a", "é  x", "1 2 33  4", "a" * 3000 + " b", "the quick the\nquick"]
    e = encoder(PATH)
    assert e.encode(odd) == e._ids(odd) == e.encode(odd)


def test_encoder_goes_through_the_batch_only():
    """Texts met before cost a look-up for each distinct word; what else is kept is not gone through, and stems serve words with a stop."""

    class Kept(dict):
        def keys(self):
            raise AssertionError("all kept words are gone through")

        __iter__ = items = values = keys

    e = WordEncoder(PATH)
    e.kept, e.older = Kept(), Kept()
    encoded = []
    word_ids, e._word_ids = e._word_ids, lambda words: encoded.extend(words) or word_ids(words)
    batch = ["a quick fox, a quick! fox. é, é don't, 3. 3", "x quick, fox; <|endoftext|>, ..., x., ß. ..", ""]
    assert e.encode(batch) == e._ids(batch) and sorted(encoded) == sorted(set(encoded))
    assert encoded.count("quick") == 1 and not {"quick,", "quick!", "fox,", "3."} & set(encoded)
    assert e.encode([]) == [] and e.encode([""]) == [b""]


def test_lots_hold_whole_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 5, 0, 30, 1, 1, 20)]})
    parts = [lot["text"].to_pylist() for lot in lots(batch, 10)]
    assert [len(p) for p in parts] == [3, 1, 2, 1] and sum(parts, []) == batch["text"].to_pylist()


@pytest.mark.parametrize("seed", range(6))
def test_matching_is_feasible_and_dense(seed):
    rng = random.Random(seed)
    sizes = [rng.choice((rng.randint(1, 100), rng.randint(1, 40), 100, 51)) for _ in range(rng.choice((1, 7, 400)))]
    counts = defaultdict(int)
    for s in sizes:
        counts[s] += 1
    placed, seen = defaultdict(list), defaultdict(set)
    for length, rank, count, first, offset in match_runs(dict(counts), 100):
        for k in range(count):
            placed[first + k].append((offset, length))
            assert rank + k not in seen[length]
            seen[length].add(rank + k)
    assert {n: len(v) for n, v in seen.items()} == dict(counts)
    for members in placed.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 100
    # Best fit by decreasing length, one piece at a time.
    rooms = []
    for s in sorted(sizes, reverse=True):
        fit = min((r for r in rooms if r >= s), default=None)
        if fit is None:
            rooms.append(100 - s)
        else:
            rooms[rooms.index(fit)] -= s
    assert len(placed) == len(rooms) >= math.ceil(sum(sizes) / 100)


def test_pack_whole_table(odd):
    got = pack(odd, PATH, capacity=64).collect()
    ids = {}
    for r in ODD:
        ids.setdefault(r[0], np.asarray([*encoder(PATH).tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4"))
    rows = defaultdict(list)
    for p in got:
        own = ids[p.doc_id]
        assert p.ids_crc32 == zlib.crc32(own[p.start : p.start + p.length].tobytes())
        rows[p.doc_id].append((p.piece, p.start, p.length))
    for doc, pieces in rows.items():
        copies = sum(r[0] == doc for r in ODD)
        assert sum(n for *_, n in pieces) == copies * len(ids[doc]) and all(n == 64 for k, _, n in pieces if k)
    places = defaultdict(list)
    for p in got:
        places[p.sequence_id].append((p.offset, p.length))
    for members in places.values():
        assert [o for o, _ in sorted(members)] == [sum(n for _, n in sorted(members)[:k]) for k in range(len(members))]
        assert sum(n for _, n in members) <= 64


def test_empty(empty):
    assert pack(empty, PATH).count() == 0
