"""Near-duplicate documents: SetSketch registers, banding, likelihood estimates, confirmation on full sets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmint.llm.common import WordCache, components, land, sieved, small_batches, stream_groups, texts

_POWERS = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes() -> WordCache:
    return WordCache(xxhash.xxh3_64_intdigest)


def shingle_sets(batch: list[str], size: int = 5, cache: WordCache | None = None) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text: `size` words each, or the whole sequence of a
    shorter text. Words are runs of non-space bytes, A-Z lower-cased. A text without words has an empty set."""
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in batch]
    code_of = (cache or word_hashes()).learn({w for words in split for w in words})
    out = []
    for words in split:
        code = np.fromiter(map(code_of, words), np.uint64, len(words))
        n = min(size, len(words))
        if not n:
            out.append(code)
            continue
        total = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            total += _mixed(code[k : len(words) - n + 1 + k] + np.uint64(k)) * _POWERS[k % 5] if n == size else _mixed(code[k : k + 1] + np.uint64(k + 16 * n)) * _POWERS[k % 5]
        out.append(np.unique(_mixed(total)))
    return out


@dataclass(frozen=True)
class SetSketch:
    """Registers K = floor(1 - log_b(min over the set of exponential(rate a))), cut to 0 .. q + 1; maxima merge.

    Register j of two sets is equal with a probability that grows with their Jaccard similarity, so bands of `rows` registers find similar
    sets. At similarity 0.75 a pair of equal sizes misses all of 40 bands of 4 with probability (1 - 0.75^4)^40 < 1e-6.
    """

    bands: int = 40
    rows: int = 4
    b: float = 1.001
    a: float = 20.0
    q: int = 65534
    seed: int = 17

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    def sketch(self, sets: list[np.ndarray]) -> np.ndarray:
        """uint16 registers of non-empty sets, one row each."""
        start = np.cumsum([0] + [len(s) for s in sets[:-1]])
        flat = np.concatenate(sets)
        rng = np.random.default_rng(self.seed)
        odd = rng.integers(0, 2**63, self.registers, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.integers(0, 2**63, self.registers, dtype=np.uint64)
        out = np.empty((len(sets), self.registers), np.uint16)
        for j in range(self.registers):
            least = np.minimum.reduceat((flat ^ add[j]) * odd[j], start)
            # Minimum of uniforms to minimum of exponentials: the map is increasing.
            h = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / self.a
            out[:, j] = np.clip(np.floor(1 - np.log(h) / np.log(self.b)), 0, self.q + 1)
        return out

    def keys(self, registers: np.ndarray) -> np.ndarray:
        """64-bit keys of the bands, one row per sketch."""
        out = np.empty((len(registers), self.bands), np.int64)
        for k in range(self.bands):
            part = np.ascontiguousarray(registers[:, k * self.rows : (k + 1) * self.rows]).astype(np.uint64)
            code = np.full(len(part), k + 1, np.uint64)
            for j in range(self.rows):
                code = _mixed(code * np.uint64(0x100000001B3) + part[:, j] + np.uint64(1))
            out[:, k] = code.view(np.int64)
        return out

    def likely(self, one: np.ndarray, many: np.ndarray, n: int, ns: np.ndarray, threshold: float, slack: float = 16.0) -> np.ndarray:
        """Which of `many` may reach the threshold with `one`: joint likelihood of the three register orders.

        With shares u and v of the two set sizes, a register of U exceeds V's with probability p(u - vJ), p(x) = -log_b(1 - x (b - 1) / b).
        Kept unless the likelihood at the threshold lies `slack` below its maximum over smaller J.
        """
        above, below = (one > many).sum(1), (one < many).sum(1)
        same = self.registers - above - below
        u = n / (n + ns)
        v = 1 - u
        most = np.minimum(u / v, v / u)

        def loglik(j: np.ndarray) -> np.ndarray:
            p = lambda x: np.clip(-np.log1p(-np.maximum(x, 1e-12) * (self.b - 1) / self.b) / np.log(self.b), 1e-12, 1 - 1e-9)
            x, y = p(u - v * j), p(v - u * j)
            return above * np.log(x) + below * np.log(y) + same * np.log(np.clip(1 - x - y, 1e-9, 1))

        at = loglik(np.minimum(threshold, most))
        best = np.max([loglik(np.minimum(j, most)) for j in np.linspace(0.02, threshold, 24)], axis=0)
        return (most >= threshold - 1e-9) & (at > best - slack)


SKETCHED = "doc_id long, n_shingles long, set_high long, set_low long, registers binary, keys array<long>"


def sketch_documents(docs: DataFrame, sketch: SetSketch, size: int = 5) -> DataFrame:
    """One row per document: size and 128-bit digest of its shingle set, registers and band keys (null for an empty set)."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = word_hashes()
        for frame in frames:
            for k in range(0, len(frame), 128):
                some = frame.iloc[k : k + 128]
                sets = shingle_sets(some["text"].tolist(), size, cache)
                full = [i for i, s in enumerate(sets) if len(s)]
                registers: list = [None] * len(sets)
                keys: list = [None] * len(sets)
                high: list = [None] * len(sets)
                low: list = [None] * len(sets)
                if full:
                    drawn = sketch.sketch([sets[i] for i in full])
                    for i, r, key in zip(full, drawn, sketch.keys(drawn)):
                        digest = xxhash.xxh3_128_intdigest(sets[i].tobytes())
                        registers[i], keys[i] = r.astype("<u2").tobytes(), key
                        high[i], low[i] = (int(np.int64(np.uint64(x))) for x in (digest >> 64, digest & (2**64 - 1)))
                out = pd.DataFrame({"doc_id": some["doc_id"].to_numpy(), "n_shingles": [len(s) for s in sets]})
                out["set_high"], out["set_low"] = pd.array(high, "Int64"), pd.array(low, "Int64")
                out["registers"], out["keys"] = registers, keys
                yield out.astype({"doc_id": "Int64"})

    return texts(docs).mapInPandas(work, SKETCHED)


def full_sets(docs: DataFrame, nodes: DataFrame, size: int = 5) -> DataFrame:
    """(node, shingles) for the documents in `nodes`: sorted 64-bit hashes, little-endian."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = word_hashes()
        for frame in frames:
            for k in range(0, len(frame), 256):
                some = frame.iloc[k : k + 256]
                yield pd.DataFrame({"node": some["doc_id"].to_numpy(), "shingles": [s.astype("<u8").tobytes() for s in shingle_sets(some["text"].tolist(), size, cache)]})

    wanted = nodes.select(F.col("node").alias("doc_id"))
    return sieved(texts(docs), wanted, "doc_id").mapInPandas(work, "node long, shingles binary")


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = []
            for x, y in zip(frame["one"], frame["two"]):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = _shared(x, y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield frame.loc[keep, ["a", "b"]]

    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("one")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("two")), "b")
    return two.select("a", "b", "one", "two").mapInPandas(work, "a long, b long")


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Split each bucket into pieces of about `block` members and pair the pieces: (key, x, y, side, ...). A bucket of
    usual size is one piece. Any two members meet in exactly one pair of pieces."""
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    pieces = F.ceil(F.col("size") / block).cast("int")
    cut = members.join(sizes, "key").withColumn("pieces", pieces).withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    return (
        cut.withColumn("other", other)
        .withColumn("x", F.least("piece", "other"))
        .withColumn("y", F.greatest("piece", "other"))
        .withColumn("side", F.col("piece") == F.col("x"))
        .drop("size", "pieces", "other")
    )


def _group_pairs(group: pd.DataFrame, sketch: SetSketch, percent: int, slack: float = 16.0) -> Iterable[tuple[int, np.ndarray]]:
    """(i, js): members of different components that the sketch can't rule out, each pair in the first band it shares."""
    registers = np.frombuffer(b"".join(group["registers"]), "<u2").reshape(len(group), -1)
    own, n, piece = group["component"].to_numpy(), group["n_shingles"].to_numpy(), group["piece"].to_numpy()
    band, across = int(group["band"].iloc[0]), group["x"].iloc[0] != group["y"].iloc[0]
    # Equal registers have a share of about J. Fewer of them than this make the threshold as unlikely as `slack` says.
    m, share = sketch.registers, percent / 100
    counts = np.arange(1, m) / m
    divergence = m * (counts * np.log(counts / share) + (1 - counts) * np.log((1 - counts) / (1 - share)))
    least = int(np.argmax((divergence <= slack) | (counts >= share))) + 1
    for i in range(len(group) - 1):
        js = np.flatnonzero((own[i + 1 :] != own[i]) & (piece[i + 1 :] != piece[i] if across else True)) + i + 1
        if not len(js):
            continue
        equal = registers[js] == registers[i]
        near = equal.sum(1) >= least
        js, equal = js[near], equal[near]
        if band and len(js):
            js = js[~equal[:, : band * sketch.rows].reshape(len(js), band, sketch.rows).all(2).any(1)]
        if len(js):
            js = js[sketch.likely(registers[i], registers[js], n[i], n[js], share, slack)]
        if len(js):
            yield i, js


def _open_members(members: DataFrame, sketch: SetSketch, percent: int, block: int) -> DataFrame:
    """Members of buckets that still have a possible link across components: (key, node), linear in the input."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in stream_groups(frames, ["key", "x", "y"]):
            if len(group) < 2:
                continue
            hit = np.zeros(len(group), bool)
            for i, js in _group_pairs(group, sketch, percent):
                hit[i] = True
                hit[js] = True
            if hit.any():
                yield group.loc[hit, ["key", "node"]]

    blocks = _blocks(members, block).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "node")
    return blocks.mapInPandas(work, "key long, node long").distinct()


def _crossing_links(members: DataFrame, sketch: SetSketch, percent: int, block: int) -> DataFrame:
    """Confirmed links across components, one spanning set per block of a bucket."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in stream_groups(frames, ["key", "x", "y"]):
            if len(group) < 2:
                continue
            sets = [np.frombuffer(s, "<u8") for s in group["shingles"]]
            node, own = group["node"].to_numpy(), group["component"].to_numpy()
            joined = {c: c for c in own.tolist()}

            def root(c: int) -> int:
                while joined[c] != c:
                    joined[c] = joined[joined[c]]
                    c = joined[c]
                return c

            out = []
            for i, js in _group_pairs(group, sketch, percent):
                for j in js.tolist():
                    if root(int(own[i])) == root(int(own[j])):
                        continue
                    both = _shared(sets[i], sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        out.append((int(node[i]), int(node[j])))
                        joined[root(int(own[i]))] = root(int(own[j]))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    blocks = _blocks(members, block).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "node")
    return blocks.mapInPandas(work, "a long, b long")


def near_groups(docs: DataFrame, percent: int = 75, size: int = 5, sketch: SetSketch = SetSketch(), block: int = 1024) -> DataFrame:
    """Groups of documents linked by shingle sets with 100 * intersection >= percent * union.

    1. Documents with one and the same set collapse into a node (the smallest doc_id), copies never meet in pairs.
    2. Nodes that agree in a band of SetSketch registers share a bucket. Each node is paired with the most
       central node it meets (the one that shares buckets with most others) and confirmed on full sets: one edge per
       node joins most of a family, whatever its size.
    3. Buckets that still hold several components are searched for links across them, in blocks of bounded
       size: likelihood estimates from registers first, then full sets for what they leave open. No pair is written
       before it is confirmed, and pairs inside a component are not looked at: they can change no group.

    Returns one row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id =
    component_id). Rows without words are linked with nothing. Rows that repeat a doc_id are one document; each of
    them counts as kept. A row without doc_id can't be named: it is linked with nothing, component_id is null,
    kept is true. Null text is empty text.
    """
    with small_batches(docs.sparkSession):
        sketched = land(sketch_documents(docs, sketch, size), "sketches")
    named = sketched.where("doc_id is not null and n_shingles > 0")
    nodes = named.groupBy("set_high", "set_low").agg(F.min("doc_id").alias("node"))
    same = named.select("set_high", "set_low", "doc_id").join(nodes, ["set_high", "set_low"]).select("doc_id", "node").distinct()
    same = land(same, "same-sets")
    leaders = same.where("doc_id = node").select("doc_id").distinct()
    reps = named.join(leaders, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "n_shingles", "registers", "keys")

    # Buckets of two or more nodes.
    banded = reps.select("node", F.posexplode("keys").alias("band", "key"))
    shared = land(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    members = land(banded.join(shared, "key"), "members")
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = land(members.join(weight, "node"), "weighed")
    centre = weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("node")).alias("less"))).alias("top"))
    centre = centre.select("key", (-F.col("top.less")).alias("centre"))
    star = weighed.join(centre, "key").where("node <> centre").groupBy("node", "centre").agg(F.count(F.lit(1)).alias("agree"))
    best = star.groupBy("node").agg(F.max(F.struct("agree", (-F.col("centre")).alias("less"))).alias("top"))
    edges = land(best.select(F.col("node").alias("a"), (-F.col("top.less")).alias("b")), "star")
    ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    with small_batches(docs.sparkSession):
        first = land(links(edges, full_sets(docs, ends, size), percent), "star-links")

    # Links that the stars did not find.
    grouped = components(first)
    owner = members.join(grouped, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("component"))
    owner = land(owner, "owned")
    mixed = owner.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    detail = reps.select("node", "n_shingles", "registers")
    doubtful = owner.join(mixed, "key").join(detail, "node")
    with small_batches(docs.sparkSession):
        still = land(_open_members(doubtful, sketch, percent, block), "open-members")
    open_sets = full_sets(docs, still.select("node").distinct(), size)
    crossing = owner.join(still, ["key", "node"]).join(detail, "node").join(open_sets, "node")
    with small_batches(docs.sparkSession):
        second = land(_crossing_links(crossing, sketch, percent, block), "crossing-links")

    # Rows of one doc_id tie their sets together as well.
    tied = same.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    final = components(first.unionByName(second).unionByName(tied))
    answer = sketched.select("doc_id", "n_shingles").join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return answer.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near(docs: DataFrame, **options) -> DataFrame:
    """Rows of `docs`, all columns, that stay: one document of each group."""
    gone = near_groups(docs, **options).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
