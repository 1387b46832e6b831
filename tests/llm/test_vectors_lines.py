import re
from collections import Counter

import numpy as np

from panelmint.llm import line_templates
from panelmint.llm.common import components, land
from panelmint.llm.line_templates import _lines, drop_lines
from panelmint.llm.nn_descent import audit_recall, near_vectors, usable
from tests.llm.conftest import ODD

VEC = "vec_id long, embedding array<float>, label int, node string"


def brute(rows, threshold=0.93):
    ok = [k for k, (i, v, l, _) in enumerate(rows) if l is not None and i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(rows[k][1], float) / np.linalg.norm(np.array(rows[k][1], float)) for k in ok}
    link = {k: [j for j in ok if j != k and rows[j][2] == rows[k][2] and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= threshold] for k in ok}
    label = {k: rows[k][0] for k in ok}
    for _ in rows:
        label = {k: min([label[k], *(label[j] for j in link[k])]) for k in ok}
    return [(r[0], len(link.get(k, [])), label.get(k, r[0])) for k, r in enumerate(rows)]


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(40):
        centre = rng.normal(size=16)
        for _ in range(rng.choice([1, 2, 30])):
            rows.append((len(rows), (centre + rng.normal(size=16) * 0.12).astype(np.float32).tolist(), int(g % 3), "x"))
    rows += [(900, rows[0][1], rows[0][2], None), (901, [0.0] * 16, 1, "x"), (902, None, 1, "x"), (903, [1.0, None] * 8, 1, "x"), (904, [float("nan")] + [1.0] * 15, 1, "x")]
    rows += [(905, rows[0][1], None, "x"), (906, [], 1, "x"), (907, [1.0, 2.0], 1, "x"), (908, [float("inf")] * 16, 1, "x"), (909, [1e30] * 16, 1, "x"), (910, [1e-30] * 16, 1, "x"), (None, rows[1][1], rows[1][2], "x")]
    got = near_vectors(spark.createDataFrame(rows, VEC)).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == Counter(brute(rows))
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def test_bridges_between_dense_clumps(spark):
    """Clumps of 80 whose members have many links inside; one pair ties two of them."""
    rng = np.random.default_rng(3)
    rows, pairs = [], []
    for g in range(12):
        e, f, *_ = np.linalg.qr(rng.normal(size=(32, 2)))[0].T
        at = lambda degrees: np.cos(np.radians(degrees)) * e + np.sin(np.radians(degrees)) * f  # noqa: E731, B023
        clumps = [[at(c) + rng.normal(size=32) * 0.022 for _ in range(80)] + [at(b)] for c, b in ((0, 10), (39, 29))]
        pairs.append((len(rows), len(rows) + 81))
        rows += [(len(rows) + k, v.tolist(), 0, "x") for k, v in enumerate(clumps[0] + clumps[1])]
    got = {r.vec_id: r.component_id for r in near_vectors(spark.createDataFrame(rows, VEC)).collect()}
    unit = np.array([r[1] for r in rows]) / np.linalg.norm([r[1] for r in rows], axis=1)[:, None]
    linked = unit @ unit.T >= 0.93
    assert all(linked[a : a + 81, b : b + 81].sum() == 1 for a, b in pairs)
    assert {k: v for k, v in got.items() if v != next(a for a, b in pairs if a <= k < b + 81)} == {}


def test_failed_recall_is_not_accepted(spark):
    """Pairs near the threshold among many single vectors; one short order leaves most of them unmet."""
    rng = np.random.default_rng(11)
    rows = [(k, rng.normal(size=64).tolist(), 0, "x") for k in range(600)]
    for k in range(60):
        v = np.array(rows[k][1])
        w = rng.normal(size=64)
        w -= (w @ v) / (v @ v) * v
        rows.append((len(rows), (v / np.linalg.norm(v) + w / np.linalg.norm(w) * np.tan(np.radians(20))).tolist(), 0, "x"))
    frame = spark.createDataFrame(rows, VEC)
    for attempts in (0, 1):
        got = {r.vec_id: r.component_id for r in near_vectors(frame, neighbours=1, sweeps=1, rounds=1, attempts=attempts).collect()}
        assert got == {k: k - 600 if k >= 600 else k for k in range(660)}
    nodes = usable(frame)
    lost = spark.createDataFrame([(k, 0) for k in range(5)], "node long, component long")
    assert audit_recall(nodes, lost, 0.93) == 0.0
    whole = spark.createDataFrame([(k + d, k) for k in range(60) for d in (0, 600)], "node long, component long")
    assert audit_recall(nodes, whole, 0.93) == 1.0


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], VEC)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(1000, 1000 + k) for k in range(1, 60)] + [(2002, 2001), (2001, 2002), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 1000 for k in range(1000, 1060)}, 2001: 2001, 2002: 2001}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_templates_generalise_and_leave_prose_alone(spark):
    prose = ["the cat sat on a warm mat today", "the cat ran to his old house slowly", "one more line of prose that is unlike others"]
    rows = [(k, "\n".join([f"user u{k} logged in from host {name}", prose[k % 3] + f" {name}", "", "short line"]), "x") for k, name in enumerate("alpha beta gamma delta".split())]
    rows.append((9, None, "y"))
    rows.append((10, "user u77 logged in from host alpha\nuser u78 logged in from host beta", "y"))
    got = {r.doc_id: r for r in drop_lines(spark.createDataFrame(rows, "doc_id long, text string, row string")).collect()}
    assert got[0].text == rows[0][1] and got[0].n_dropped == 0
    for k in (1, 2, 3):
        assert got[k].text == rows[k][1].split("\n", 1)[1] and got[k].n_dropped == 1
    assert (got[9].text, got[9].n_lines, got[10].text, got[10].n_dropped) == ("", 1, "", 2)


def test_several_templates_in_one_leaf_and_dilution(spark):
    """Three equally frequent templates of one leaf generalise, whatever other lines join that leaf; so do names in place of digits."""
    names = [a + b for a in "ka lo mi nu pe".split() for b in "ra so ti".split()]
    made = lambda k: [
        f"the job was started by user {names[k]} on this host",
        f"the job was stopped after signal from {names[k]} without error",
        f"the job has left queue {names[k]} for another worker now",
    ]
    other = lambda k: "the job " + " ".join(f"{'abcdefgh'[(k + j) % 8]}{'xyzuvw'[(k * 7 + j * k) % 6]}{chr(97 + k % 26)}{chr(97 + k // 26)}" for j in range(8))
    for extra in (0, 300):
        rows = [(k, "\n".join(made(k))) for k in range(6)] + [(100 + k, other(k)) for k in range(extra)]
        got = {r.doc_id: r for r in drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert [got[k].n_dropped for k in range(6)] == [0, 3, 3, 3, 3, 3]
        assert sum(got[100 + k].n_dropped for k in range(extra)) == 0


def test_passages_go_from_two_documents_on(spark):
    passage = " ".join(f"w{chr(97 + k)}" for k in range(20))
    digits = " ".join(str(k) for k in range(40))
    rows = [(3, f"{passage}\nown line of three\n{digits}"), (1, f"{passage}\n{digits}"), (2, passage[:-3]), (4, passage[:-3]), (None, passage), (None, None)]
    got = drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in got) == [(0, 0), (0, 1), (1, 0), (2, 0), (3, 1), (4, 0)]


def test_lines_of_odd_rows(odd, empty):
    got = drop_lines(odd)
    assert got.columns == [*odd.columns, "n_lines", "n_dropped"] and got.count() == len(ODD)
    assert drop_lines(empty).count() == 0


def test_lines_are_read_once_and_like_their_definition(spark):
    parts = ["a", "b1", "<*>", "é9é", "7", "x\x1cy", "\U0001f600z3", "\u00a04", "zz"]
    gaps = [" ", "  ", "\t", "\x0b", "\x0c\r", " \t ", "\u2003"]
    rng = np.random.default_rng(5)
    lines = ["", " ", "\t\r", "1", " 1 "] + ["".join(rng.choice(gaps) + rng.choice(parts) for _ in range(n)) + rng.choice(["", *gaps]) for n in rng.integers(1, 9, 200)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, None)], "doc_id long, text string")
    got = {(r.doc_id, r.pos): (r.flat, r.size, r.words) for r in _lines(docs).collect()}
    want = {(2, 0): ("", 0, 0)}
    for k, line in enumerate(lines):
        tokens = ["<*>" if re.search("[0-9]", t) else t for t in re.split(r"[\x20\x09-\x0D]+", line) if t]
        want[1, k] = (" ".join(tokens), len(tokens), sum(t != "<*>" for t in tokens))
    assert got == want
    # Filters on what a line is made into do not make it again: one mask and one squeeze in the whole plan.
    plan = _lines(docs).where("size >= 4 and words > 5").select("row", "flat", "words")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 2, plan


def test_a_digest_is_made_once_for_each_line(spark, monkeypatch):
    plans = []

    def noted(frame, name):
        plans.append((name, frame._jdf.queryExecution().optimizedPlan().toString()))
        return land(frame, name)

    monkeypatch.setattr(line_templates, "land", noted)
    rows = [(k, f"the job was started by user {name} on this host") for k, name in enumerate("alpha beta gamma delta".split())]
    assert sorted(r.n_dropped for r in drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [0, 1, 1, 1]
    plan = next(p for name, p in plans if name == "templates").splitlines()
    above = plan[: next(k for k, line in enumerate(plan) if "Generate posexplode(split(flat" in line)]
    assert not any("xxhash64(flat" in line or "xxhash64(split(flat" in line for line in above), "\n".join(plan)
