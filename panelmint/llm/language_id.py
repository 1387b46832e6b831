"""Language of a text by a bidirectional gated recurrent network over its bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmint.llm.common import land

UNKNOWN = "und"
LETTER = r"\p{L}"
SIDES = 2  # forwards, backwards
PADDING = 256


class ByteGRU:
    """Two gated recurrent networks, one reads a stretch of bytes forwards and one backwards; both states label every byte.

    Update z and reset r: sigmoid(W_zr[byte] + h U_zr). Candidate n: tanh(W_n[byte] + r * (h U_n)). State: z h + (1 - z) n. The input
    tables W have one row per byte value (and one for padding), so an embedding and its projection are one look-up.
    """

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.hidden = weights["U"].shape[1]

    @classmethod
    def started(cls, classes: int, hidden: int, seed: int) -> ByteGRU:
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: (rng.normal(size=shape) * scale).astype(np.float32)
        tables = draw(0.3, SIDES, PADDING + 1, 3 * hidden)
        tables[:, PADDING] = 0
        tables[:, PADDING, :hidden] = 60  # the update gate is shut: padding leaves a state as it is
        return cls(
            {
                "W": tables,
                "U": draw(1 / np.sqrt(hidden), SIDES, hidden, 3 * hidden),
                "V": draw(1 / np.sqrt(hidden), SIDES, hidden, classes),
                "b": np.zeros(classes, np.float32),
            }
        )

    def states(self, codes: np.ndarray, side: int, keep: list | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(position, state after it) along (time, stretch) byte codes; `keep` gathers what the gradient needs.

        Signs and factors of sigmoid(x) = 1 / (1 + exp(-x)) and tanh(x) = 1 - 2 / (1 + exp(2x)) are folded into the tables.
        """
        size, n_rows = self.hidden, codes.shape[1]
        table, u = self.w["W"][side], self.w["U"][side]
        gate_in, last_in = np.ascontiguousarray(-table[:, : 2 * size]), np.ascontiguousarray(2 * table[:, 2 * size :])
        gate_u, last_u = np.ascontiguousarray(-u[:, : 2 * size]), np.ascontiguousarray(2 * u[:, 2 * size :])
        h = np.zeros((n_rows, size), np.float32)
        for t in range(len(codes)) if side == 0 else range(len(codes) - 1, -1, -1):
            zr = h @ gate_u
            zr += gate_in.take(codes[t], axis=0)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :size], zr[:, size:]
            own = h @ last_u
            n = own * r
            n += last_in.take(codes[t], axis=0)
            np.exp(n, out=n)
            n += 1
            np.divide(-2, n, out=n)
            n += 1
            if keep is not None:
                keep.append((t, h, z, r, own / 2, n))
            h = h - n
            h *= z
            h += n
            yield t, h

    def logits(self, codes: np.ndarray) -> np.ndarray:
        """(time, stretch, class) scores of every byte."""
        out = np.empty((*codes.shape, len(self.w["b"])), np.float32)
        with np.errstate(over="ignore"):
            for t, h in self.states(codes, 0):
                np.matmul(h, self.w["V"][0], out=out[t])
            for t, h in self.states(codes, 1):
                out[t] += h @ self.w["V"][1]
        out += self.w["b"]
        return out

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        p = self.logits(codes)
        p -= p.max(2, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(2, keepdims=True)
        return p

    def loss_and_gradient(self, codes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of the labelled bytes (those with weight) and its gradient, by backpropagation through time."""
        w, h_size = self.w, self.hidden
        kept: list[list] = [[], []]
        after: list[dict[int, np.ndarray]] = [{}, {}]
        for side in range(SIDES):
            for t, h in self.states(codes, side, kept[side]):
                after[side][t] = h
        score = np.empty((*codes.shape, len(w["b"])), np.float32)
        for t in range(len(codes)):
            score[t] = after[0][t] @ w["V"][0] + after[1][t] @ w["V"][1] + w["b"]
        score -= score.max(2, keepdims=True)
        p = np.exp(score)
        p /= p.sum(2, keepdims=True)
        total = max(float(weight.sum()), 1.0)
        truth = p[:, np.arange(codes.shape[1]), labels]
        loss = float(-(weight * np.log(np.maximum(truth, 1e-12))).sum() / total)
        d = p
        d[:, np.arange(codes.shape[1]), labels] -= 1
        d *= (weight / total)[:, :, None].astype(np.float32)
        grad = {name: np.zeros_like(v) for name, v in w.items()}
        grad["b"] += d.sum((0, 1))
        for side in range(SIDES):
            back = np.zeros((codes.shape[1], h_size), np.float32)
            u, inputs = w["U"][side], []
            for t, before, z, r, own, n in reversed(kept[side]):
                grad["V"][side] += after[side][t].T @ d[t]
                dh = back + d[t] @ w["V"][side].T
                dz = dh * (before - n) * z * (1 - z)
                dn = dh * (1 - z) * (1 - n * n)
                dr = dn * own * r * (1 - r)
                through = np.concatenate([dz, dr, dn * r], axis=1)
                grad["U"][side] += before.T @ through
                inputs.append((t, np.concatenate([dz, dr, dn], axis=1)))
                back = dh * z + through @ u.T
            seen = np.concatenate([codes[t] for t, _ in inputs])
            moves = np.concatenate([g for _, g in inputs])
            order = np.argsort(seen, kind="stable")
            values, first = np.unique(seen[order], return_index=True)
            grad["W"][side][values] = np.add.reduceat(moves[order], first, axis=0)
            grad["W"][side][PADDING] = 0
        return loss, grad

    def fit(self, codes: np.ndarray, labels: np.ndarray, weight: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.02, seed: int = 5) -> None:
        """Adam over shuffled batches of stretches, the rate falling to zero, gradients cut to norm 1."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        step, steps = 0, epochs * -(-codes.shape[1] // batch)
        for _ in range(epochs):
            order = rng.permutation(codes.shape[1])
            for k in range(0, len(order), batch):
                some = order[k : k + batch]
                step += 1
                _, grad = self.loss_and_gradient(codes[:, some], labels[some], weight[:, some])
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                for name, g in grad.items():
                    g = g / max(1.0, norm)
                    m[name] = 0.9 * m[name] + 0.1 * g
                    s[name] = 0.99 * s[name] + 0.01 * g * g
                    move = (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.99**step)) + 1e-8)
                    self.w[name] = (self.w[name] - rate * (1 - step / (steps + 1)) * move).astype(np.float32)


def stretches(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(time, stretch) codes of byte strings cut into stretches, and the text each stretch belongs to. Empty texts have none."""
    sizes = np.array([len(t) for t in texts], np.int64)
    rows = -(-sizes // length)
    codes = np.full(int(rows.sum()) * length, PADDING, np.int16)
    for text, at in zip(texts, (np.cumsum(rows) - rows) * length):
        codes[at : at + len(text)] = np.frombuffer(text, np.uint8)
    return np.ascontiguousarray(codes.reshape(-1, length).T), np.repeat(np.arange(len(texts)), rows)


def pooled(model: ByteGRU, texts: list[bytes], length: int, block: int = 4096) -> np.ndarray:
    """Mean over all bytes of the class probabilities, one row per text (zeros for an empty one). A block of stretches is held at a time."""
    sums = np.zeros((len(texts), len(model.w["b"])))
    counts = np.array([max(1, len(t)) for t in texts])
    codes, owner = stretches(texts, length)
    for k in range(0, len(owner), block):
        some, own = codes[:, k : k + block], owner[k : k + block]
        p = model.probabilities(some)
        if (some[-1] == PADDING).any():
            p *= (some != PADDING)[:, :, None]
        inside = p.sum(0)
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sums[own[first]] += np.add.reduceat(inside, first, axis=0)
    return sums / counts[:, None]


SAMPLED = "label int, piece binary"


def learn_language(
    docs: DataFrame, per_language: int = 600, max_languages: int = 64, length: int = 96, hidden: int = 12, epochs: int = 12, seed: int = 7
) -> tuple[list[str], dict[str, np.ndarray]] | None:
    """Languages and weights, learned from `docs` (text, lang): (names, weights), or None where no text has a language.

    Documented bounds of the labelled sample: the `max_languages` most frequent values of lang, and `per_language` stretches of
    `length` bytes of each, one per document, documents and places chosen by a digest of the text. Rows without lang, text or letter teach
    nothing. The sample is fitted in one task; only the weights, some kilobytes, reach the driver.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER)).select("lang", F.encode("text", "UTF-8").alias("data"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not counts:
        return None
    names = sorted(r["lang"] for r in counts)
    size = {r["lang"]: r["count"] for r in counts}
    # Twice the wanted share by digest, then the smallest digests of each language: at most some `per_language` rows meet.
    rates = [(n, k, min(1.0, 2.0 * per_language / size[n] + 64.0 / size[n])) for k, n in enumerate(names)]
    rates = docs.sparkSession.createDataFrame(rates, "lang string, label int, rate double")
    lot = F.xxhash64("data", F.lit(seed))
    drawn = known.withColumn("lot", lot).join(F.broadcast(rates), "lang").where(F.pmod("lot", F.lit(1 << 30)) < F.col("rate") * (1 << 30))
    spare = F.greatest(F.length("data") - length, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("lot"), spare.cast("long")).cast("int") + 1
    # Some pieces are cut short, so that short texts are known as well.
    short = F.when(F.pmod(F.xxhash64("lot", F.lit(1)), F.lit(4)) == 0, 8 + F.pmod(F.xxhash64("lot", F.lit(2)), F.lit(max(1, length - 8)))).otherwise(length)
    drawn = drawn.select("label", "lot", F.substring("data", start, short.cast("int")).alias("piece"))
    order = Window.partitionBy("label").orderBy("lot", "piece")
    sample = land(drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language).select("label", "rank", "piece"), "language-sample")

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames), ignore_index=True)
        codes, _ = stretches([bytes(p)[:length] for p in rows["piece"]], length)
        labels = rows["label"].to_numpy()
        # Every language weighs the same, whatever its share of the sample.
        weight = (codes != PADDING) * (len(rows) / np.bincount(labels, minlength=len(names)))[labels]
        model = ByteGRU.started(len(names), hidden, seed)
        model.fit(codes, labels, weight.astype(np.float32), epochs)
        yield pd.DataFrame([{f"w_{k}": v.tobytes() for k, v in model.w.items()}])

    shapes = {k: v.shape for k, v in ByteGRU.started(len(names), hidden, seed).w.items()}
    ordered = sample.repartition(1).sortWithinPartitions("label", "rank").select("label", "piece")
    fitted = ordered.mapInPandas(train, ", ".join(f"w_{k} binary" for k in shapes)).first()
    return names, {k: np.frombuffer(bytes(fitted[f"w_{k}"]), np.float32).reshape(shape) for k, shape in shapes.items()}


def predict_language(docs: DataFrame, model: tuple[list[str], dict[str, np.ndarray]] | None, length: int = 96) -> DataFrame:
    """All columns of `docs` with `lang_pred` and `score`, the mean probability of that language over all bytes of the whole text.

    A null text, an empty one and one without any letter is `und` with score 0, and so is every text where there is no model. Equal
    texts get equal results; ties go to the language that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, weights = shared.value
        network = ByteGRU(weights)
        for batch in batches:
            found = np.zeros((len(batch), len(names)))
            held, size, at = [], 0, 0
            for k, text in enumerate(batch):
                held.append(b"" if text is None else text.encode("utf-8", "surrogatepass"))
                size += len(held[-1]) + length
                if size >= 1 << 20 or k == len(batch) - 1:
                    found[at : k + 1] = pooled(network, held, length)
                    held, size, at = [], 0, k + 1
            best = found.argmax(1) if len(found) else np.empty(0, int)
            yield pd.DataFrame({"lang_pred": [names[b] for b in best], "score": found[np.arange(len(best)), best]})

    readable = F.coalesce(F.col("text").rlike(LETTER), F.lit(False))
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    result = label(F.when(readable, F.col("text")))
    return docs.withColumns(
        {"lang_pred": F.when(readable, result["lang_pred"]).otherwise(UNKNOWN), "score": F.when(readable, F.least(result["score"], F.lit(1.0))).otherwise(0.0)}
    )
