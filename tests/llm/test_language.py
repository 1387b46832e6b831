import numpy as np
from pyspark.sql import functions as F

from panelmint.llm.language_id import PADDING, ByteGRU, learn_language, pooled, predict_language, stretches
from panelmint.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(model, text):
    """Mean class probabilities of one stretch, one scalar step at a time."""
    w, size = {k: v.astype(float) for k, v in model.w.items()}, model.hidden
    after = [{}, {}]
    for side, order in enumerate((range(len(text)), range(len(text) - 1, -1, -1))):
        h = np.zeros(size)
        for t in order:
            x, u = w["W"][side][text[t]], w["U"][side]
            z = 1 / (1 + np.exp(-(x[:size] + h @ u[:, :size])))
            r = 1 / (1 + np.exp(-(x[size : 2 * size] + h @ u[:, size : 2 * size])))
            n = np.tanh(x[2 * size :] + r * (h @ u[:, 2 * size :]))
            h = z * h + (1 - z) * n
            after[side][t] = h
    rows = [after[0][t] @ w["V"][0] + after[1][t] @ w["V"][1] + w["b"] for t in range(len(text))]
    e = [np.exp(r - r.max()) for r in rows]
    return np.mean([x / x.sum() for x in e], axis=0)


def test_blocks_equal_scalar_steps():
    model = ByteGRU.started(3, 5, 1)
    texts = [b"hello world", b"", "éèü".encode(), b"x" * 25]
    got = pooled(model, texts, 10, block=2)
    for text, row in zip(texts, got):
        pieces = [text[k : k + 10] for k in range(0, len(text), 10)]
        want = sum((plain(model, p) * len(p) for p in pieces), np.zeros(3)) / max(1, len(text))
        assert np.allclose(row, want, atol=1e-5)


def test_gradient_is_that_of_the_loss():
    model = ByteGRU.started(3, 4, 2)
    codes, _ = stretches([b"abcab", b"cba", b"bbbb"], 5)
    labels, weight = np.array([0, 2, 1]), (codes != PADDING).astype(np.float32)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    _, grad = model.loss_and_gradient(codes, labels, weight)
    rng = np.random.default_rng(0)
    for name, value in model.w.items():
        flat = value.reshape(-1)
        used = np.flatnonzero(grad[name].reshape(-1)) if name == "W" else np.arange(flat.size)
        for k in rng.choice(used, 6):
            keep = flat[k]
            sides = []
            for move in (1e-2, -1e-2):
                flat[k] = keep + move
                sides.append(model.loss_and_gradient(codes, labels, weight)[0])
            flat[k] = keep
            assert abs((sides[0] - sides[1]) / 2e-2 - grad[name].reshape(-1)[k]) < 2e-3


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op12_byte_gru"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    out = [r for r in rows if r.held_out]
    assert out and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out]) > 0.95


def test_odd_rows(spark, odd, empty):
    model = learn_language(odd, epochs=1)
    assert model[0] == ["en"]
    rows = predict_language(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        plain_text = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred, r.score) == (("en", 1.0) if plain_text else ("und", 0.0))
    assert learn_language(empty) is None and predict_language(empty, model).count() == 0
    assert {(r.lang_pred, r.score) for r in predict_language(odd, None).collect()} == {("und", 0.0)}
    assert learn_language(odd.withColumn("text", F.lit("123 456"))) is None
