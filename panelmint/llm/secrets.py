"""Secret scans: fixed patterns, and automata inferred from the credentials those patterns label."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmint.llm.common import land, texts

# The base patterns, in the order in which kinds are listed.
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]{16,}"), 0, 16),
}
KINDS = [*PATTERNS, "format"]
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
SYMBOLS = str.maketrans(
    {**{c: "a" for c in "abcdef"}, **{c: "z" for c in "ghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEF"}, **{c: "Z" for c in "GHIJKLMNOPQRSTUVWXYZ"}, **{c: "0" for c in "0123456789"}}
)
END = "$"


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, secret part) of the base matches, by start, then kind as listed."""
    found = []
    for rank, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                found.append((m.start(), rank, m.end(), kind, m[group]))
    return [(s, e, kind, value) for s, _, e, kind, value in sorted(found)]


def candidates(text: str, base: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str]]:
    """(start, end, format) of the other runs of credential characters: symbols are character classes, never the text."""
    out = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while end > start and text[end - 1] in ".-":
            end -= 1
        while start < end and text[start] in ".-=":
            start += 1
        run = text[start:end]
        if end - start >= 12 and not any(s < end and start < e for s, e, _, _ in base):
            out.append((start, end, run.translate(SYMBOLS)))
    return out


class FormatAutomaton:
    """Probabilistic automaton of a credential format, inferred by merging compatible states of a prefix tree.

    States are compared by their frequencies of ending and of each next symbol, recursively (Hoeffding bound with
    confidence `alpha`), in breadth-first order; compatible ones are folded together, loops included.
    """

    def __init__(self, words: Counter, alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.ends, self.visits, self.flow = [0], [0], [Counter()]
        for word, n in sorted(words.items()):
            state = 0
            self.visits[0] += n
            for c in word:
                self.flow[state][c] += n
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.ends.append(0)
                    self.visits.append(0)
                    self.flow.append(Counter())
                state = self.next[state][c]
                self.visits[state] += n
            self.ends[state] += n
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.red = self._infer() if words else [0]

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, p: int, q: int) -> bool:
        stack, seen = [(p, q)], set()
        while stack:
            p, q = stack.pop()
            if p == q or (p, q) in seen:
                continue
            seen.add((p, q))
            n1, n2 = self.visits[p], self.visits[q]
            if not n1 or not n2:
                continue
            if self._differ(self.ends[p], n1, self.ends[q], n2):
                return False
            for c in self.next[p].keys() | self.next[q].keys():
                if self._differ(self.flow[p][c], n1, self.flow[q][c], n2):
                    return False
                if c in self.next[p] and c in self.next[q]:
                    stack.append((self.next[p][c], self.next[q][c]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Add the tree below q to p."""
        stack = [(p, q)]
        while stack:
            p, q = stack.pop()
            self.ends[p] += self.ends[q]
            self.visits[p] += self.visits[q]
            self.flow[p].update(self.flow[q])
            for c, below in self.next[q].items():
                if c in self.next[p]:
                    stack.append((self.next[p][c], below))
                else:
                    self.next[p][c] = below

    def _infer(self) -> list[int]:
        red, place = [0], {0}
        while True:
            blue = next(((r, c) for r in red for c in sorted(self.next[r]) if self.next[r][c] not in place), None)
            if blue is None:
                return red
            state, c = blue
            q = self.next[state][c]
            for r in red:
                if self._compatible(r, q):
                    self.next[state][c] = r
                    self._fold(r, q)
                    break
            else:
                red.append(q)
                place.add(q)

    def model(self) -> list[dict[str, tuple[float, int]]]:
        """Per state: symbol -> (log2 probability, next state), END included; states renumbered."""
        number = {s: k for k, s in enumerate(self.red)}
        out = []
        for s in self.red:
            total = self.visits[s] + 1.0
            row = {c: (math.log2((self.flow[s][c] + 1e-9) / total), number[t]) for c, t in self.next[s].items()}
            row[END] = (math.log2((self.ends[s] + 0.01) / total), 0)
            out.append(row)
        return out


MISSED = -14.0


def format_bits(model: list[dict[str, tuple[float, int]]], word: str) -> float:
    """log2 probability of a format; a symbol that the state never saw costs MISSED and goes to the start."""
    state, bits = 0, 0.0
    for c in word + END:
        step, state = model[state].get(c, (MISSED, 0))
        bits += step
    return bits


def count_pairs(words: pd.Series, times: pd.Series) -> pd.DataFrame:
    """(a, b, n): adjacent symbols of formats, END at both ends, each format as often as `times` says."""
    text = np.frombuffer("".join(END + w + END for w in words).encode("ascii"), np.uint8).astype(np.int64)
    weight = np.repeat(times.to_numpy(np.int64), words.str.len().to_numpy(np.int64) + 2)
    inside = np.ones(len(text), bool)
    inside[np.cumsum(words.str.len().to_numpy(np.int64) + 2) - 1] = False  # no pair starts at the last END
    at = np.flatnonzero(inside)
    n = np.bincount(text[at] * 128 + text[at + 1], weight[at], 128 * 128).astype(np.int64)
    met = np.flatnonzero(n)
    return pd.DataFrame({"a": [chr(k // 128) for k in met], "b": [chr(k % 128) for k in met], "n": n[met]})


def background_of(pairs: dict[tuple[str, str], int]) -> dict[str, dict[str, float]]:
    """Plain first-order model of the unlabelled runs, from the counts of adjacent symbols."""
    rows: dict[str, Counter] = defaultdict(Counter)
    for (a, b), n in pairs.items():
        rows[a][b] += n
    return {a: {b: math.log2((n + 0.5) / (sum(c.values()) + 8)) for b, n in c.items()} for a, c in rows.items()}


def background(words: Counter) -> dict[str, dict[str, float]]:
    """The same from formats."""
    return background_of({(r.a, r.b): r.n for r in count_pairs(pd.Series(list(words), dtype=object), pd.Series(list(words.values()), dtype="int64")).itertuples()})


def background_bits(model: dict[str, dict[str, float]], word: str) -> float:
    return sum(model.get(a, {}).get(b, -8.0) for a, b in zip(END + word, word + END))


FOUND = "doc_id long, base array<struct<start:long,end:long,kind:string,format:string>>, runs array<struct<start:long,end:long,format:string>>"
ANSWER = "doc_id long, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string"


def find_secrets(docs: DataFrame, sample: int = 800, odds_bits: float = 12.0, alpha: float = 0.05, seed: int = 1) -> DataFrame:
    """Secrets of every whole text: base spans as the patterns say, and spans whose format looks like a labelled credential.

    One automaton per kind is inferred from the formats (character classes) of the base matches of the whole corpus: counts
    are taken over all documents; at most `sample` distinct formats per kind, drawn by count, enter inference (documented
    bound). The background model counts adjacent symbols of all unlabelled runs. Every other run of 12 or more credential characters
    is scored: it is added as kind `format` when its log2 likelihood under the best automaton exceeds that of the background model by `odds_bits`.

    Returns one row per input row: doc_id, n_assign, n_access, n_hex, n_format, base_sha256, spans. Null or empty text has
    no spans; rows that repeat a doc_id are scanned one by one; without labelled credentials nothing is added.
    """

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            base, runs = [], []
            for text in frame["text"]:
                spans = base_spans(text)
                base.append([{"start": s, "end": e, "kind": k, "format": v.translate(SYMBOLS)} for s, e, k, v in spans])
                runs.append([{"start": s, "end": e, "format": f} for s, e, f in candidates(text, spans)])
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "base": base, "runs": runs})

    found = land(texts(docs).mapInPandas(scan, FOUND), "secret-candidates")
    labelled = found.select(F.explode("base").alias("m")).groupBy("m.kind", "m.format").agg(F.count(F.lit(1)).alias("n"))
    rest = found.select(F.explode("runs").alias("m")).groupBy("m.format").agg(F.count(F.lit(1)).alias("n"))
    formats = land(labelled.unionByName(rest.withColumn("kind", F.lit("")).select("kind", "format", "n")), "formats")

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield count_pairs(frame["format"], frame["n"])

    # Unlabelled runs are counted whole: one row per pair of symbols reaches the driver.
    met = formats.where("kind = ''").select("format", "n").mapInPandas(pairs, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    ground = background_of({(r["a"], r["b"]): r["n"] for r in met.collect()})

    models = {}
    even = (F.pmod(F.xxhash64("format", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    for kind in PATTERNS:  # each a bounded list of formats, drawn by count
        some = formats.where(F.col("kind") == kind).orderBy(-F.log(even) / F.col("n"), "format").limit(sample).collect()
        words = Counter({r["format"]: r["n"] for r in some})
        if words:
            models[kind] = FormatAutomaton(words, alpha).model()
    shared = docs.sparkSession.sparkContext.broadcast((models, ground))

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automata, plain = shared.value
        known: dict[str, bool] = {}

        def credential(word: str) -> bool:
            if word not in known:
                if len(known) > 100_000:
                    known.clear()
                best = max((format_bits(m, word) for m in automata.values()), default=-math.inf)
                known[word] = best - background_bits(plain, word) >= odds_bits
            return known[word]

        for frame in frames:
            out = []
            for doc, base, runs in zip(frame["doc_id"], frame["base"], frame["runs"]):
                told = [(m["start"], KINDS.index(m["kind"]), m["end"]) for m in base]
                added = [(m["start"], 3, m["end"]) for m in runs if credential(m["format"])]
                joined = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
                counts = Counter(k for _, k, _ in told)
                out.append((doc, counts[0], counts[1], counts[2], len(added), hashlib.sha256(joined(told).encode()).hexdigest(), joined(told + added)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ANSWER.split(", ")]).astype({"doc_id": "Int64"})

    return found.mapInPandas(judge, ANSWER)
