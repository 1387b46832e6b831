"""What the operators share: landed tables, streamed groups, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import filterfalse

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_SCRATCH: list[str] = []

#: What a Python worker keeps from task to task, by operator. Workers outlive a stage, so the words of one operator would lie beside
#: those of the next: a WordCache empties it first.
KEPT: dict[str, object] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share. Only a local session that names none gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not LOCAL_SCRATCH:
        LOCAL_SCRATCH.append(tempfile.mkdtemp(prefix="panelmint-llm-"))
    return LOCAL_SCRATCH[0]


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A setting of the session for what is written inside; its own value holds again afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def small_batches(spark: SparkSession, size: str = "8m"):
    """Arrow batches of at most `size` bytes (a row more) in what is written inside.
    Spark's limit of 64 MB is held several times over, by the JVM and by each Python worker."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", size)


def land(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, so a lost executor costs
    nothing that came before, and values that depend on task order are settled. The shuffle files of the write go with it:
    no later step reads them, and left to the driver's garbage collection they outlive the whole job."""
    path = f"{shared_folder(frame.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    with setting(frame.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def land_long(frame: DataFrame, name: str) -> DataFrame:
    """`land` for rows of a megabyte or so. Parquet looks at what it holds after each of them: by default it does after a hundred, and both
    writers and readers take buffers of that size outside the heap."""
    return land(frame, name, **{"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.block.size": str(16 << 20)})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_planes(ids: np.ndarray) -> bytes:
    """Non-negative 32-bit ids as their lowest bytes, then the next, to the highest: small ones are the rule, so the high planes are all but
    empty and take no room where Spark compresses them."""
    return np.ascontiguousarray(ids, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, null text as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def unused(frame: DataFrame, *names: str) -> list[str]:
    """Column names that the table does not have, made from these."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def _sifted(rows: DataFrame, wanted: DataFrame, column: str, bits: int) -> tuple[DataFrame, str]:
    """`rows` with one more column, and its name: false only where `column` is surely not among the values of `wanted`. A bitmap of
    2^bits hashed values is broadcast as at most 2^(bits - 6) words whatever the corpus."""
    word, have, passes = unused(rows, "__word", "__bits", "__passes")
    place = F.pmod(F.xxhash64(column), F.lit(1 << bits))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({column}), {1 << bits}L) & 63 as int))")
    words = wanted.groupBy(F.shiftright(place, 6).alias(word)).agg(F.bit_or(bit).alias(have))
    words = land(words, "sieve")
    met = rows.withColumn(word, F.shiftright(place, 6)).join(F.broadcast(words), word, "left")
    return met.select(*rows.columns, (F.coalesce(have, F.lit(0)).bitwiseAND(bit) != 0).alias(passes)), passes


def sieved(rows: DataFrame, wanted: DataFrame, column: str, bits: int = 24, unique: bool = False) -> DataFrame:
    """Rows whose `column` is among the values of `wanted`, found with a shuffle of few others: a broadcast bitmap lets rows pass to the
    exact join. That join is an inner one on distinct values: Spark moves a semi join below the sieve, and would shuffle all
    rows first. With `unique` the values of `wanted` are distinct already, and its other columns come along."""
    marked, passes = _sifted(rows, wanted, column, bits)
    return marked.where(passes).drop(passes).join(wanted if unique else wanted.select(column).distinct(), column)


def parted(rows: DataFrame, wanted: DataFrame, column: str, bits: int = 24) -> tuple[DataFrame, DataFrame]:
    """`rows` in two parts: those whose `column` may be among the values of `wanted`, and those where it surely is not."""
    marked, passes = _sifted(rows, wanted, column, bits)
    return marked.where(passes).drop(passes), marked.where(f"NOT {passes}").drop(passes)


class WordCache:
    """What `make` gives for each word, kept for words seen before. Owned by one task and emptied when its keys
    take more than `limit` bytes (an entry counts 150 bytes besides its word)."""

    def __init__(self, make: Callable[[bytes], int], limit: int = 48 << 20):
        KEPT.clear()
        self.make, self.limit = make, limit
        self.known: dict[bytes, int] = {}
        self.held = 0

    def learn(self, words: set[bytes]) -> Callable[[bytes], int]:
        """Look-up that knows all of `words`."""
        if self.held > self.limit:
            self.known.clear()
            self.held = 0
        for w in list(filterfalse(self.known.__contains__, words)):  # `words - keys()` would go through all that is known
            self.known[w] = self.make(w)
            self.held += len(w) + 150
        return self.known.__getitem__


def stream_groups(frames: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows with equal keys as one frame each. Rows must come sorted by the keys; one group is held at a time."""
    held: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        if frame.empty:
            continue
        codes = frame.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        cuts = [0, *((codes[1:] != codes[:-1]).nonzero()[0] + 1).tolist(), len(frame)]
        values = frame[keys].itertuples(index=False, name=None)
        firsts = list(values)
        for start, end in zip(cuts, cuts[1:]):
            key = firsts[start]
            if held and key != last:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
                held = []
            held.append(frame.iloc[start:end].reset_index(drop=True))
            last = key
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; component is its smallest reachable node.

    Each round hooks every node to its smallest neighbour, jumps to the hook's hook and contracts the edges, so
    the graph shrinks geometrically and a star of any size takes one round. All joins are keyed by node; the
    sides of a hub are split by adaptive execution.
    """
    live = land(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct(), "edges")
    labels = None
    while not live.isEmpty():
        both = live.union(live.select("v", "u"))
        hook = both.groupBy("u").agg(F.min("v").alias("near")).select("u", F.least("u", "near").alias("to"))
        hook = land(hook, "hooks")
        further = hook.select(F.col("u").alias("to"), F.col("to").alias("next"))
        jump = land(hook.join(further, "to").select("u", F.col("next").alias("to")), "jumps")
        if labels is None:
            labels = jump.select(F.col("u").alias("node"), F.col("to").alias("component"))
        else:
            moved = jump.select(F.col("u").alias("component"), F.col("to").alias("next"))
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
        labels = land(labels, "labels")
        live = (
            live.join(jump.select("u", F.col("to").alias("x")), "u")
            .join(jump.select(F.col("u").alias("v"), F.col("to").alias("y")), "v")
            .select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
            .where("u < v")
            .distinct()
        )
        live = land(live, "edges")
    if labels is None:
        return live.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels
