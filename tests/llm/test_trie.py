import hashlib
import random
import re
import zlib
from collections import defaultdict

from panelmint.llm.prefix_trie import TREE, prefix_tree

SCHEMA = "conv_id long, turn long, role string, text string, words string, stretch long, s1 string"
NAMES = [c.split()[0] for c in TREE.split(", ")]


def brute(rows):
    """Nodes from all beginnings of all rebuilt conversations, one by one."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole = tuple(turns.get(base, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, inside in members.items():
        below = [x for x in members if x[: len(node)] == node]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        leaves = sum(not children[x] for x in below)
        text = ",".join(map(str, sorted(ends[node])))
        out.append((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(children[node]), leaves, saved, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def given(rows):
    return [(*r, "w", 1, "s") for r in rows]


def tree(spark, tmp_path, rows):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(given(rows), SCHEMA).repartition(5).write.parquet(path)
    return sorted((tuple(r[n] for n in NAMES) for r in prefix_tree(spark.read.parquet(path)).collect()), key=repr)


def test_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for c in range(160):
        first = rng.choice(["hi there", "hello", "hi there"])
        length = rng.choice([1, 2, 3, 3, 5, 17, 40]) if c % 7 else 60
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", first if t == 0 else f"w{rng.randrange(1 + t % 3)} x\ty") for t in range(length)]
    assert tree(spark, tmp_path, rows) == brute(given(rows))


def test_copies_chains_nulls_ties_and_long_texts(spark, tmp_path):
    chain = [(1000 + k, t, "user", "same") for k in range(30) for t in range(k + 1)]  # each the beginning of the next
    copies = [(3000 + k, t, "user", f"copy {t}") for k in range(40) for t in range(4)]
    odd = [
        (2000, None, None, None),
        (2000, 1, "user", "a b"),
        (2000, 1, "user", "a b"),  # repeated row
        (2000, 1, "assistant", "z"),  # tie
        (2001, 0, "user", ""),
        (2002, 0, None, ""),
        (None, 0, "user", "no conversation"),
        (-5, 0, "user", "x"),
        (-5, 1, "user", "y" * 50_000 + " z"),
        (-20, 3, "user", "base of negatives"),
        (4001, 0, "user", "only turns that its family replaces"),
    ]
    rows = chain + copies + odd
    assert tree(spark, tmp_path, rows) == brute(given(rows))


def test_empty_table(spark, tmp_path):
    assert tree(spark, tmp_path, []) == []
