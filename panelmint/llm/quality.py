"""Document quality by attention over passages (multiple-instance learning)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmint.llm.common import WordCache, small_batches, texts

SHAPES, ENDINGS, RATES = 96, 96, 6
WIDTH = SHAPES + ENDINGS + RATES


def word_code(word: bytes) -> int:
    """Shape and hashed ending of a word in one integer: letter case, tail, digits, length; last three bytes."""
    body = word.rstrip(b".,;:!?")
    tail = len(word) - len(body)
    core = body.strip(b"*#$%&|<>{}[]()=_-+/\\~^\"'`@")
    odd = len(core) < len(body)
    letters = core.decode("utf-8", "replace")
    if not letters:
        case = 3
    elif letters.islower():
        case = 0
    elif letters.istitle() or letters[:1].isupper() and letters[1:].islower():
        case = 1
    elif letters.isupper() and len(letters) > 1:
        case = 2
    else:
        case = 3
    digits = any(c.isdigit() for c in letters)
    long = 2 if len(word) > 24 else int(len(word) > 12)
    shape = (((case * 2 + odd) * 2 + digits) * 2 + (tail > 1)) * 3 + long  # below 4 * 2 * 2 * 2 * 3
    return shape * ENDINGS + xxhash.xxh3_64_intdigest(word[-3:]) % ENDINGS


def passages(batch: list[str], size: int, cache: WordCache) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of `size` words, and the number of passages of each text (at least one)."""
    split = [t.encode("utf-8", "replace").split() for t in batch]
    flat = [w for words in split for w in words]
    code = np.fromiter(map(cache.learn(set(flat)), flat), np.int64, len(flat))
    lengths = np.fromiter(map(len, flat), np.float64, len(flat))
    mark = np.fromiter(map(hash, flat), np.int64, len(flat))  # equal words inside this batch
    counts = np.array([len(s) for s in split], np.int64)
    bags = np.maximum(1, -(-counts // size))
    first_bag, first_word = np.cumsum(bags) - bags, np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(split)), counts)
    within = np.arange(len(flat)) - first_word[owner]
    bag = first_bag[owner] + within // size
    total = int(bags.sum())
    words = np.bincount(bag, minlength=total).astype(np.float64)
    scale = 1 / np.maximum(1, words)
    shape = np.bincount(bag * SHAPES + code // ENDINGS, minlength=total * SHAPES).reshape(total, SHAPES) * scale[:, None]
    ending = np.bincount(bag * ENDINGS + code % ENDINGS, minlength=total * ENDINGS).reshape(total, ENDINGS) * scale[:, None]
    again = np.zeros(len(flat))
    fresh = np.ones(len(flat))
    if len(flat):
        again[1:] = (mark[1:] == mark[:-1]) & (bag[1:] == bag[:-1])
        order = np.lexsort((mark, bag))
        fresh[order[1:]] = (mark[order][1:] != mark[order][:-1]) | (bag[order][1:] != bag[order][:-1])
    rates = np.stack(
        [
            np.bincount(bag, again, total) * scale,
            np.bincount(bag, fresh, total) * scale,
            np.bincount(bag, lengths, total) * scale / 10,
            np.log1p(words) / 5,
            (words == 0).astype(float),
            np.ones(total),
        ],
        axis=1,
    )
    return np.concatenate([np.sqrt(shape), np.sqrt(ending), rates], axis=1).astype(np.float32), bags


@dataclass
class GatedAttention:
    """h = tanh(xE); attention = softmax(a . (tanh(hV) * sigmoid(hU))); score = sigmoid(c . sum(attention * h) + b)."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def started(seed: int = 11, hidden: int = 24, gate: int = 12) -> "GatedAttention":
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        return GatedAttention(
            {"E": draw(WIDTH, hidden), "V": draw(hidden, gate), "U": draw(hidden, gate), "a": draw(gate), "c": draw(hidden), "b": np.zeros(1, np.float32)}
        )

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict:
        w = self.weights
        start = np.cumsum(bags) - bags
        owner = np.repeat(np.arange(len(bags)), bags)
        h = np.tanh(x @ w["E"])
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * s) @ w["a"]
        e = np.exp(e - np.maximum.reduceat(e, start)[owner])
        attention = e / np.add.reduceat(e, start)[owner]
        z = np.add.reduceat(attention[:, None] * h, start, axis=0)
        p = 1 / (1 + np.exp(-(z @ w["c"] + w["b"][0])))
        return {"start": start, "owner": owner, "h": h, "t": t, "s": s, "attention": attention, "z": z, "p": p}

    def gradient(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(x, bags)
        d = ((f["p"] - y) / len(y)).astype(np.float32)
        dz = d[:, None] * w["c"]
        own = dz[f["owner"]]
        pull = (own * f["h"]).sum(1)
        mean = np.add.reduceat(f["attention"] * pull, f["start"])[f["owner"]]
        de = f["attention"] * (pull - mean)
        gate = f["t"] * f["s"]
        dgate = de[:, None] * w["a"]
        dt, ds = dgate * f["s"] * (1 - f["t"] ** 2), dgate * f["t"] * f["s"] * (1 - f["s"])
        dh = f["attention"][:, None] * own + dt @ w["V"].T + ds @ w["U"].T
        dx = dh * (1 - f["h"] ** 2)
        return {"E": x.T @ dx, "V": f["h"].T @ dt, "U": f["h"].T @ ds, "a": gate.T @ de, "c": f["z"].T @ d, "b": d.sum(keepdims=True)}

    def fit(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> None:
        rng, start = np.random.default_rng(seed), np.cumsum(bags) - bags
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        v = {k: np.zeros_like(u) for k, u in self.weights.items()}
        step, steps = 0, epochs * -(-len(y) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for k in range(0, len(order), batch):
                docs = order[k : k + batch]
                rows = np.concatenate([np.arange(start[i], start[i] + bags[i]) for i in docs])
                step += 1
                for name, g in self.gradient(x[rows], bags[docs], y[docs]).items():
                    g = g + decay * self.weights[name]
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.999 * v[name] + 0.001 * g * g
                    move = m[name] / (1 - 0.9**step) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] = (self.weights[name] - rate * (1 - step / (steps + 1)) * move).astype(np.float32)


def learn_quality(docs: DataFrame, labels: DataFrame, sample: int = 4000, passage: int = 64, seed: int = 3) -> GatedAttention | None:
    """Fit on at most `sample` labelled documents (documented bound), those with the smallest hash of their doc_id.

    `labels` has doc_id and quality (0 or 1; null is no label; several labels of a document are averaged). Whole
    texts are encoded where they lie; only passage features of the sample reach the driver. Without labelled
    documents there is nothing to learn: None.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.avg("quality").alias("quality")).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)
    chosen = texts(docs).join(F.broadcast(known), "doc_id")  # at most `sample` rows

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordCache(word_code)
        for frame in frames:
            for k in range(0, len(frame), 32):
                some = frame.iloc[k : k + 32]
                x, bags = passages(some["text"].tolist(), passage, cache)
                cuts = np.cumsum(bags)[:-1]
                yield pd.DataFrame({"doc_id": some["doc_id"].to_numpy(), "quality": some["quality"].to_numpy(), "rows": [p.astype("<f2").tobytes() for p in np.split(x, cuts)]})

    with small_batches(docs.sparkSession):
        rows = chosen.mapInPandas(encode, "doc_id long, quality double, rows binary").collect()
    found = sorted(rows, key=lambda r: (r["doc_id"], bytes(r["rows"])))
    if not found:
        return None
    bags = [np.frombuffer(bytes(r["rows"]), "<f2").reshape(-1, WIDTH) for r in found]
    model = GatedAttention.started()
    model.fit(np.concatenate(bags).astype(np.float32), np.array([len(b) for b in bags]), np.array([r["quality"] for r in found], np.float32))
    return model


def score_quality(docs: DataFrame, model: GatedAttention | None, passage: int = 64) -> DataFrame:
    """All columns of `docs` and `__score` (0 to 1). Whole texts; null and empty texts are one passage without words.

    Without a model every score is 0.5. A text's passages share memory with those of a small batch only.
    """
    weights = docs.sparkSession.sparkContext.broadcast(None if model is None else model.weights)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = WordCache(word_code)
        for batch in batches:
            out = [np.empty(0)]
            for k in range(0, len(batch), 64):  # only these texts become Python strings
                some = batch.slice(k, 64).fill_null("").to_pylist()
                out.append(np.full(len(some), 0.5) if weights.value is None else GatedAttention(weights.value).forward(*passages(some, passage, cache))["p"])
            yield pa.array(np.concatenate(out), pa.float64())

    return docs.withColumn("__score", score(F.col("text")))
