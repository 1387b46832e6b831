"""Best-fit packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import bisect
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmint.llm.common import KEPT, land, small_batches, texts

CACHE_WORDS = 300_000  # some 60 MB in each of the two generations, in each Python worker
LOT_BYTES = 4 << 20


class WordEncoder:
    """Ids of whole texts, with the ids of space-separated words kept.

    The vocabulary's pre-tokeniser always cuts before a single space that stands between two other characters, so
    a text whose spaces are all like that is the concatenation of its words' ids. Any other text is encoded whole.
    Two generations of words are kept: what the younger one no longer holds is taken over from the older or encoded anew.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # In a byte-level vocabulary a token's string has one character for each byte it stands for.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.width[number] = len(token)
        self.stops = dict(zip(".,;:!?", self._ids(list(".,;:!?"))))

    def _ids(self, strings: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words behind a space each. They are encoded as one text and cut where the bytes of a word end."""
        if not words:
            return []
        joined = " " + " ".join(words)
        ids = np.asarray(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum([1 + len(w.encode("utf-8", "surrogatepass")) for w in words])
        reached = np.cumsum(self.width[ids])
        cuts = np.searchsorted(reached, ends) + 1
        if len(ids) != cuts[-1] or (reached[cuts - 1] != ends).any():
            return self._ids([" " + w for w in words])
        flat = ids.tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    def _kept_ids(self, words: list[str]) -> list[bytes | None]:
        """Ids of distinct words behind a space each; None for a word that is not cut there for sure (empty, or with white space at an end).

        A last stop or comma behind an ASCII letter or digit is always cut off, so the word before it is looked up instead.
        """
        if len(self.kept) > CACHE_WORDS:
            self.older, self.kept = self.kept, {}
        kept, older = self.kept, self.older
        found = list(map(kept.get, words))
        new: dict[str, None] = {}
        later = []
        for k in [k for k, ids in enumerate(found) if ids is None]:
            w = words[k]
            if w in older:
                found[k] = kept[w] = older[w]
            elif w and not (w[0].isspace() or w[-1].isspace()):
                stem = w[:-1] if w[-1] in self.stops and w[-2:-1].isascii() and w[-2:-1].isalnum() else w
                later.append((k, stem))
                if stem not in kept:
                    if stem in older:
                        kept[stem] = older[stem]
                    else:
                        new[stem] = None
        kept.update(zip(new, self._word_ids(list(new))))
        for k, stem in later:
            w = words[k]
            found[k] = kept[w] = kept[stem] if stem is w else kept[stem] + self.stops[w[-1]]
        return found

    def flat(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (none null) one after the other, and how many each text has.

        Arrow cuts the texts and finds the batch's distinct words, so only these are looked up one by one; places are
        filled by gathering runs of ids.
        """
        if not len(batch):
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        split = pc.split_pattern(batch, " ")
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        place, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        del split, coded
        found = self._kept_ids(words)
        first = np.cumsum(sizes) - sizes
        start = [words[k] for k in place[first].tolist()]
        alone = [w if w and not (w[0].isspace() or w[-1].isspace()) else "" for w in start]

        # Texts with a space beside another white space are encoded whole: all their ids stand at the first place.
        whole = np.array([bool(w) and not a for w, a in zip(start, alone)])
        if None in found:
            odd = np.array([ids is None for ids in found])[place]
            odd[first] = False
            whole |= np.logical_or.reduceat(odd, first)
        heads = self._ids(alone)
        some = np.flatnonzero(whole)
        for k, ids in zip(some.tolist(), self._ids(batch.take(pa.array(some)).to_pylist())):
            heads[k] = ids
        runs = [ids or b"" for ids in found] + heads + [b""]
        if len(some):
            place = np.where(np.repeat(whole, sizes), np.int32(len(runs) - 1), place)
        else:
            place = place.copy()
        place[first] = len(words) + np.arange(len(first))
        pool = np.frombuffer(b"".join(runs), "<u4")
        length = np.fromiter(map(len, runs), np.int32, len(runs)) >> 2
        begins = np.cumsum(length, dtype=np.int32) - length
        each = length[place]
        ends = np.cumsum(each, dtype=np.int32)
        at = np.repeat(begins[place] - (ends - each), each)
        at += np.arange(len(at), dtype=np.int32)
        return pool[at], np.add.reduceat(each, first, dtype=np.int64)

    def encode(self, batch: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, sizes = self.flat(pa.array(batch, pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(sizes)[:-1])] if batch else []


def encoder(path: str) -> WordEncoder:
    """The worker's encoder, kept for its next tasks until another operator needs the room."""
    if path not in KEPT:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        KEPT[path] = WordEncoder(path)
    return KEPT[path]


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PIECE_NAMES = [c.split()[0] for c in PIECE.split(", ")]
PIECE_TYPES = [pa.int64() if c.endswith("long") else pa.int32() for c in PIECE.split(", ")]


def lots(batch: pa.RecordBatch, size: int = LOT_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in lots of about `size` bytes of text, one row at least."""
    ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
    k = 0
    while k < len(ends):
        after = max(k + 1, int(np.searchsorted(ends, size + (ends[k - 1] if k else 0), side="right")))
        yield batch.slice(k, after - k)
        k = after


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Token pieces of at most `capacity` ids, each text followed by `end_id`. A long document's first piece takes the
    remainder, the others are full. `part` and `nth` say where the piece was made: the task, and its number among
    the task's pieces of that length (a counting sort by length, one row at a time).
    """
    tail = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, flat = TaskContext.get().partitionId(), defaultdict(int), encoder(tokenizer).flat
        for batch in batches:
            for some in lots(batch):
                ids, sizes = flat(some["text"])
                out, data, at = [], memoryview(ids).cast("B"), 0
                for doc, size in zip(some["doc_id"].to_pylist(), sizes.tolist()):
                    n = size + 1
                    first = (n - 1) % capacity + 1
                    a, piece = 0, 0
                    for b in range(first, n + 1, capacity):
                        crc = zlib.crc32(data[4 * (at + a) : 4 * (at + min(b, size))])
                        out.append((doc, piece, a, b - a, zlib.crc32(tail, crc) if b == n else crc, part, seen[b - a]))
                        seen[b - a] += 1
                        a, piece = b, piece + 1
                    at += size
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), PIECE_TYPES)], names=PIECE_NAMES)

    return texts(docs).mapInArrow(cut, PIECE)


def match_runs(pieces: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit over runs of equal sizes: (length, first rank, count, first sequence, offset).

    Equal pieces are interchangeable, and so are sequences with equal room; so both sorted lists are kept as runs (size, first number, count), at
    most `capacity` sizes whatever the corpus. One superstep per length, longest first: the sweep goes up the sorted
    gaps from the successor of the length; where pieces and sequences of a run meet, the k-th piece takes the k-th
    sequence (rank resolves the conflict), the run's room shrinks, and the sweep goes on until no gap is large
    enough. The rest open new sequences.
    """
    gaps: dict[int, list[list[int]]] = {}  # room -> runs [first sequence, count]
    rooms: list[int] = []  # sorted
    taken, opened = [], 0
    for length in sorted(pieces, reverse=True):
        rank, left = 0, pieces[length]
        at = bisect.bisect_left(rooms, length)
        while left and at < len(rooms):
            room = rooms[at]
            each = room // length  # as many of this length as fit in one sequence of the run
            runs, back = gaps[room], defaultdict(list)
            while left and runs:
                first, count = runs.pop()
                whole = min(count, left // each)
                if whole:
                    for k in range(each):
                        taken.append((length, rank, whole, first, capacity - room + k * length))
                        rank += whole
                    left -= whole * each
                    back[room - each * length].append([first, whole])
                if whole < count and left:  # fewer than `each` are left: they go into one sequence
                    for k in range(left):
                        taken.append((length, rank, 1, first + whole, capacity - room + k * length))
                        rank += 1
                    back[room - left * length].append([first + whole, 1])
                    whole, left = whole + 1, 0
                if whole < count:
                    runs.append([first + whole, count - whole])
            if not runs:
                del gaps[room], rooms[at]
            for now, more in back.items():
                if now:
                    if now not in gaps:
                        gaps[now] = []
                        bisect.insort(rooms, now)
                    gaps[now].extend(more)
            at = bisect.bisect_left(rooms, length)
        if left:
            each = capacity // length
            whole, rest = divmod(left, each)
            for k in range(each if whole else 0):
                taken.append((length, rank, whole, opened, k * length))
                rank += whole
            for k in range(rest):
                taken.append((length, rank, 1, opened + whole, k * length))
                rank += 1
            for now, first, count in ((capacity - each * length, opened, whole), (capacity - rest * length, opened + whole, int(rest > 0))):
                if count and now:
                    if now not in gaps:
                        gaps[now] = []
                        bisect.insort(rooms, now)
                    gaps[now].append([first, count])
            opened += whole + (rest > 0)
    return taken


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens.

    1. Cut: texts become token pieces (no text beyond this point), landed once.
    2. Sort: a piece's rank among all pieces of its length is its number in its task plus the counts of earlier
       tasks, from a table with one row per task and length. No length is gathered in one task.
    3. Match: see match_runs(); its input is the histogram of lengths, at most `capacity` rows.
    4. Place: every piece looks up the run its rank falls in.

    Null text is empty; an empty text is one piece with `end_id` alone. Every row is a document, also when ids
    repeat. An empty table gives an empty result.
    """
    with small_batches(docs.sparkSession):
        pieces = land(cut_pieces(docs, tokenizer, capacity, end_id), "pieces")
    counts = land(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = match_runs(histogram, capacity)
    by_length: dict[int, np.ndarray] = {}
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    for length in np.unique(table[:, 0]):
        own = table[table[:, 0] == length]
        by_length[int(length)] = own[np.argsort(own[:, 1])]
    shared = docs.sparkSession.sparkContext.broadcast(by_length)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rank = (frame["nth"] + frame["before"]).to_numpy()
            length = frame["length"].to_numpy()
            sequence, offset = np.empty(len(frame), np.int64), np.empty(len(frame), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                own = shared.value[int(length[rows[0]])]
                run = np.searchsorted(own[:, 1], rank[rows], side="right") - 1
                sequence[rows] = own[run, 3] + rank[rows] - own[run, 1]
                offset[rows] = own[run, 4]
            out = frame[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(sequence_id=sequence, offset=offset)
            yield out.astype({"doc_id": "Int64"})

    return pieces.join(offsets, ["part", "length"]).mapInPandas(place, PACKED)
