"""Shared beginnings of conversations: a z-fast trie whose nodes and searches are tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelmint.llm.common import land

SPACE = r"[\x20\x09-\x0D]+"
SIGNS = ["s1", "s2", "s3", "s4"]
STRETCH = 4096
TREE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, stretch, h1, h2, words) of each turn.

    Turns are put in order by ranges of (conv_id, turn, role, text), which cut a long conversation over several tasks; a turn's
    number is its rank in its task plus the turns of that conversation in earlier tasks. Only digests go on from here.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    given = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order)
    words = F.size(F.filter(F.split("text", SPACE), lambda w: w != ""))
    dealt = land(
        dealt.select(
            "conv_id",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
            F.xxhash64("role", "text").alias("h1"),
            F.xxhash64(F.lit(7), "text", "role").alias("h2"),
            words.cast("long").alias("words"),
        ),
        "turns",
    )
    runs = dealt.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return dealt.join(runs, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("at") - F.col("first") + 1).alias("pos"), "h1", "h2", "words"
    )


def rebuilt(turns: DataFrame, ids: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation c with its first h = crc32(c) % heads turns taken from conversation c - c % family."""
    own = F.crc32(F.col("conv_id").cast("string")) % heads
    lead = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "base")
    plan = ids.select("conv_id", own.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    taken = plan.join(lead, "base").where("pos <= h").select("conv_id", "pos", "h1", "h2", "words")
    known = lead.groupBy("base").agg(F.max("pos").alias("known"))
    place = plan.join(known, "base", "left").select("conv_id", "h", F.least("h", F.coalesce("known", F.lit(0))).alias("held"))
    rest = turns.join(place, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("held")).alias("pos"), "h1", "h2", "words")
    return taken.unionByName(rest)


def running(frame: DataFrame, key: str, order: str, values: dict[str, Column], descending: bool = False) -> DataFrame:
    """Adds running aggregates (sums or minima) over the rows of a key by the whole number `order`, in stretches of bounded length:
    inside a stretch by a window, before it from a table with one row per stretch."""
    way = F.desc if descending else F.asc
    cut = frame.withColumn("stretch", F.floor(F.col(order) / STRETCH))
    inside = Window.partitionBy(key, "stretch").orderBy(way(order)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy(way("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    kinds = {name: "min" if name.startswith("least") else "sum" for name in values}
    agg = {name: getattr(F, kind) for name, kind in kinds.items()}
    totals = cut.groupBy(key, "stretch").agg(*[agg[n](v).alias(f"t_{n}") for n, v in values.items()])
    carried = totals.select(key, "stretch", *[agg[n](f"t_{n}").over(before).alias(f"c_{n}") for n in values])
    met = cut.join(carried, [key, "stretch"])
    for n, v in values.items():
        here = agg[n](v).over(inside)
        met = met.withColumn(n, F.least(here, f"c_{n}") if kinds[n] == "min" else here + F.coalesce(f"c_{n}", F.lit(0)))
    return met.drop("stretch", *[f"c_{n}" for n in values])


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, s1..s4, words): the signature of each beginning. It is the sum of four 32-bit digests of (place, turn), 128 bits
    in all, so beginnings of equal depth are equal if their signatures are."""
    low, high = F.lit(0xFFFFFFFF), 32
    a, b = F.xxhash64("pos", "h1", "h2"), F.xxhash64(F.lit(1), "pos", "h2", "h1")
    parts = [a.bitwiseAND(low), F.shiftrightunsigned(a, high), b.bitwiseAND(low), F.shiftrightunsigned(b, high)]
    return running(turns, "conv_id", "pos", dict(zip(SIGNS, parts))).select(
        "conv_id", F.col("pos").alias("depth"), *SIGNS, "words"
    )


def two_fattest(low: str, high: str) -> str:
    """SQL of the number in (low, high] that most powers of two divide."""
    gap = f"({low} ^ {high})"
    return f"({high} & (-shiftleft(1L, cast(floor(log2({gap})) as int))))"


class ZFastTrie:
    """Compacted trie of distinct sequences, grown in batches.

    `nodes`: one row per compacted node: rep (the sequence whose insertion made its path), low (depth of the parent's extent), high (depth of
    its own), the signature of the extent. A node is found by the signature of its handle, the beginning of its extent of the
    two-fattest depth in (low, high], and its edge by the beginning of depth low + 1. `placed()`: where each sequence ends. `hung()`: where
    each path leaves the path it hangs from.
    """

    def __init__(self, paths: DataFrame, lengths: DataFrame):
        self.paths, self.lengths = paths, lengths
        spark = paths.sparkSession
        self.nodes = spark.createDataFrame([], "rep long, low long, high long, " + ", ".join(f"{s} long" for s in SIGNS))
        self.turned: list[DataFrame] = []

    def _beginning(self, depth: str, suffix: str = "", rep: str = "sid") -> DataFrame:
        return self.paths.select(F.col("sid").alias(rep), F.col("depth").alias(depth), *[F.col(s).alias(s + suffix) for s in SIGNS])

    def exits(self, waiting: DataFrame) -> DataFrame:
        """Deepest extent on the way of each waiting sequence (depth `l`, of path `at`), by fat binary search on handles.

        Each step probes the two-fattest depth f of the open interval (l, r]: a handle found with an extent that the sequence goes
        through moves l to that extent; a handle whose extent it leaves, or none, moves r below f.
        """
        handle = self.nodes.withColumn("f", F.expr(two_fattest("low", "high")))
        handle = handle.select("rep", "f", F.col("high").alias("n_high"), *[F.col(s).alias(f"{s}e") for s in SIGNS])
        extent = land(self._beginning("f", rep="rep").join(handle, ["rep", "f"]).withColumnRenamed("rep", "n_rep"), "handles")
        state = waiting.withColumn("r", F.col("length"))
        widest = state.agg(F.max(F.col("r") - F.col("l"))).first()[0]
        reach = self._beginning("n_high", "x")
        through = F.lit(True)
        for s in SIGNS:
            through = through & (F.col(f"{s}x") == F.col(f"{s}e"))
        through = F.coalesce((F.col("n_high") <= F.col("length")) & through, F.lit(False))
        for step in range(int(widest).bit_length()):
            probe = state.withColumn("f", F.expr(f"case when l < r then {two_fattest('l', 'r')} end"))
            probe = probe.join(self._beginning("f"), ["sid", "f"], "left").join(extent, ["f", *SIGNS], "left")
            state = probe.join(reach, ["sid", "n_high"], "left").select(
                "sid",
                "length",
                F.when(through, F.col("n_high")).otherwise(F.col("l")).alias("l"),
                F.when(through, F.col("n_rep")).otherwise(F.col("at")).alias("at"),
                F.when(through | F.col("f").isNull(), F.col("r")).otherwise(F.col("f") - 1).alias("r"),
            )
            if step % 4 == 3:
                state = land(state, "search")
        return state.select("sid", "length", "l", "at")

    def insert(self, waiting: DataFrame) -> DataFrame:
        """One batch: every waiting sequence is located; one per new edge is inserted, those that end on the trie are placed, edges are cut
        where any leaves them. Returns the rest, which start from where they left."""
        left = waiting.withColumn("e_rep", F.lit(None).cast("long")).withColumn("e_high", F.lit(None).cast("long"))
        if self.turned:
            # The edge that goes on from there, if any, and how far the sequence follows it.
            edge = self.nodes.select(F.col("rep").alias("e_rep"), (F.col("low") + 1).alias("first"), F.col("high").alias("e_high"))
            edge = edge.join(self._beginning("first", rep="e_rep"), ["e_rep", "first"])
            start = self.exits(waiting).withColumn("first", F.col("l") + 1).join(self._beginning("first"), ["sid", "first"], "left")
            on = land(start.join(edge, ["first", *SIGNS], "left").select("sid", "length", "l", "at", "e_rep", "e_high"), "edges")
            steps = on.where("e_rep is not null").select("sid", "e_rep", "l", "e_high").join(self.paths, "sid").where("depth > l and depth <= e_high")
            same = steps.join(self._beginning("depth", rep="e_rep"), ["e_rep", "depth", *SIGNS])
            follow = same.groupBy("sid").agg(F.max("depth").alias("leaves"))
            left = on.join(follow, "sid", "left").select(
                "sid", "length", F.coalesce("leaves", "l").alias("l"), F.coalesce("e_rep", "at").alias("at"), "e_rep", "e_high"
            )
        # Sequences that leave at one place by one turn form a group; a digest picks the one that is inserted.
        out = left.withColumn("first", F.col("l") + 1).join(self._beginning("first"), ["sid", "first"])
        draw = F.min(F.struct(F.xxhash64("sid").alias("lot"), "sid"))
        chosen = out.where("l < length").groupBy("first", *SIGNS).agg(draw.alias("lot")).select(F.col("lot.sid").alias("sid"), F.lit(True).alias("fresh"))
        turned = land(left.join(chosen, "sid", "left"), "turned")
        self.turned.append(turned)
        # A path's nodes follow each other: the depth above a node is the extent before it, or where the path hangs.
        leaf = turned.where("fresh").select(F.col("sid").alias("rep"), F.col("l").alias("top"), F.col("length").alias("high"))
        cuts = turned.where("e_rep is not null and l < e_high").select(F.col("e_rep").alias("rep"), F.lit(None).cast("long").alias("top"), F.col("l").alias("high"))
        ends = leaf.unionByName(cuts.distinct()).join(self._beginning("high", rep="rep"), ["rep", "high"])
        old = self.nodes.select("rep", F.col("low").alias("top"), "high", *SIGNS)
        along = Window.partitionBy("rep").orderBy("high")
        nodes = ends.unionByName(old).withColumn("low", F.coalesce(F.lag("high").over(along), "top"))
        self.nodes = land(nodes.select("rep", "low", "high", *SIGNS), "nodes")
        return turned.where("l < length and fresh is null").select("sid", "length", "l", "at")

    def grow(self) -> int:
        """Insert all sequences; returns the number of batches. The lot keeps the nesting of paths logarithmic."""
        nowhere = F.lit(None).cast("long")
        waiting = self.lengths.select("sid", "length", F.lit(0).cast("long").alias("l"), nowhere.alias("at"))
        while not waiting.isEmpty():
            waiting = self.insert(waiting)
        return len(self.turned)

    def hung(self) -> DataFrame:
        """(rep, up_rep, up_depth) of each path."""
        parts = [t.where("fresh").select(F.col("sid").alias("rep"), F.col("at").alias("up_rep"), F.col("l").alias("up_depth")) for t in self.turned]
        return land(reduce(DataFrame.unionByName, parts), "hung")

    def placed(self) -> DataFrame:
        """(sid, rep, depth): the path on which each sequence ends."""
        done = [t.where("fresh or l = length").select("sid", F.when(F.col("fresh"), F.col("sid")).otherwise(F.col("at")).alias("rep"), F.col("length").alias("depth")) for t in self.turned]
        return reduce(DataFrame.unionByName, done)


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the comma-joined pieces of each node; rows come sorted, one digest is held at a time."""
    key, state, out = None, None, []
    for frame in frames:
        for rep, depth, text in zip(frame["rep"], frame["depth"], frame["ids"]):
            if (rep, depth) != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (rep, depth), hashlib.sha256(text.encode())
            else:
                state.update(f",{text}".encode())
        if out:
            yield pd.DataFrame(out, columns=["rep", "depth", "ends_sha256"])
            out = []
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["rep", "depth", "ends_sha256"])


def end_digests(members: DataFrame) -> DataFrame:
    """(rep, depth, ends_sha256) from (rep, depth, conv_id). Ids are joined in runs of at most 1,024 first, so a node where very many
    conversations end sends few rows to the task that digests it (a SHA-256 is sequential by nature)."""
    run = members.groupBy("rep", "depth", F.shiftright("conv_id", 10).alias("run")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    run = run.select("rep", "depth", "run", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    return run.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "run").select("rep", "depth", "ids").mapInPandas(
        _digests, "rep long, depth long, ends_sha256 string"
    )


def prefix_tree(conversations: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations, the empty one included.

    Conversations that are equal turn by turn are one sequence. The sequences' compacted trie is grown in batches (see ZFastTrie); its paths
    are then expanded to one row per depth, and members, leaves and saved tokens are summed up along each path; what a path holds also counts at
    the places above it, at most one for each batch.

    Order inside a conversation: turn (null first), then role, then text, so rows that tie have a fixed place and repeated rows count twice.
    Null role or text is empty. Rows without conv_id belong to no conversation and are left out. No rows: no conversation, no
    node, an empty result. Columns other than conv_id, turn, role, text are not read. Returns conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (long) and ends_sha256.
    """
    spark: SparkSession = conversations.sparkSession
    turns = land(numbered_turns(conversations), "numbered")
    ids = land(turns.select("conv_id").distinct(), "ids")
    begun = land(prefixes(rebuilt(turns, ids, family, heads)), "prefixes")

    # Equal conversations are one sequence, named by its smallest member.
    length = begun.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    whole = begun.join(length, ["conv_id", "depth"])
    sequence = whole.groupBy("depth", *SIGNS).agg(F.min("conv_id").alias("sid"), F.count(F.lit(1)).alias("ends"))
    sequence = land(sequence, "sequences")
    of = land(whole.join(sequence, ["depth", *SIGNS]).select("conv_id", "sid"), "members")
    paths = land(begun.withColumnRenamed("conv_id", "sid").join(sequence.select("sid"), "sid"), "paths")
    trie = ZFastTrie(paths, sequence.select("sid", F.col("depth").alias("length")))
    batches = trie.grow()

    columns = [c.split()[0] for c in TREE.split(", ")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    least, n_convs = ids.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    if not n_convs:
        return spark.createDataFrame([], TREE)
    silent = ids.join(of, "conv_id", "left_anti").select(F.lit(0).cast("long").alias("rep"), F.lit(0).cast("long").alias("depth"), "conv_id")
    root_ends = end_digests(silent).select("depth", "ends_sha256")

    def root(n_children: int, n_leaves: int, saved: int) -> DataFrame:
        row = spark.createDataFrame([(least, 0, None, n_convs, n_children, n_leaves, saved)], TREE.rpartition(",")[0])
        return row.join(root_ends, "depth", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).select(columns)

    if not batches:
        return root(0, 1, 0)
    hung = trie.hung()
    # A path and all places above it where its sequences pass: (rep, a_rep, a_depth), at most one per batch.
    step = hung.where("up_rep is not null").select("rep", F.col("up_rep").alias("a_rep"), F.col("up_depth").alias("a_depth"))
    above = [step]
    further = hung.where("up_rep is not null").select(F.col("rep").alias("a_rep"), F.col("up_rep").alias("next"), F.col("up_depth").alias("a_depth"))
    for _ in range(batches - 2):
        step = step.drop("a_depth").join(further, "a_rep").select("rep", F.col("next").alias("a_rep"), "a_depth")
        above.append(step)
    above = land(reduce(DataFrame.unionByName, above), "above")

    def with_places_above(frame: DataFrame) -> DataFrame:
        """Rows of (rep, depth, ...) and a copy of each at all places above its path."""
        copies = frame.drop("depth").join(above, "rep").drop("rep").withColumnsRenamed({"a_rep": "rep", "a_depth": "depth"})
        return frame.unionByName(copies)

    placed = trie.placed().join(sequence.select("sid", "ends"), "sid")
    branches = hung.where("up_rep is not null").groupBy(F.col("up_rep").alias("rep"), F.col("up_depth").alias("depth")).agg(F.count(F.lit(1)).alias("branches"))
    bottoms = sequence.join(hung.select(F.col("rep").alias("sid")), "sid").select(F.col("sid").alias("rep"), F.col("depth").alias("depth"))
    leaf = bottoms.join(branches, ["rep", "depth"], "left_anti").select("rep", "depth", F.lit(0).cast("long").alias("ends"), F.lit(None).cast("long").alias("low_end"), F.lit(1).cast("long").alias("leaf"))
    ended = placed.select("rep", "depth", "ends", F.col("sid").alias("low_end"), F.lit(0).cast("long").alias("leaf"))
    met = with_places_above(ended.unionByName(leaf)).groupBy("rep", "depth").agg(F.sum("ends").alias("ends"), F.min("low_end").alias("low_end"), F.sum("leaf").alias("leaf"))

    # Expanded paths: one row per depth below the place where a path hangs; members and leaves are those at this depth or below.
    none = F.lit(0)
    rows = paths.withColumnRenamed("sid", "rep").join(hung, "rep").where("depth > up_depth").drop(*SIGNS)
    rows = rows.join(met, ["rep", "depth"], "left")
    counted = running(
        rows, "rep", "depth", {"n_convs": F.coalesce("ends", none), "n_leaves": F.coalesce("leaf", none), "least_conv": F.col("low_end")}, descending=True
    )
    counted = land(counted.select("rep", "depth", "up_rep", "up_depth", "n_convs", "n_leaves", "least_conv", ((F.col("n_convs") - 1) * F.col("words")).alias("spared")), "counted")
    whole_path = counted.groupBy("rep").agg(F.sum("spared").alias("passed")).join(above, "rep")
    passed = whole_path.groupBy(F.col("a_rep").alias("rep"), F.col("a_depth").alias("depth")).agg(F.sum("passed").alias("passed"))
    summed = running(
        counted.join(passed, ["rep", "depth"], "left"), "rep", "depth", {"saved_tokens": F.col("spared") + F.coalesce("passed", none)}, descending=True
    )
    longest = sequence.select(F.col("sid").alias("rep"), F.col("depth").alias("bottom"))
    children = F.coalesce("branches", none) + (F.col("depth") < F.col("bottom")).cast("long")
    done = summed.join(longest, "rep").join(branches, ["rep", "depth"], "left").withColumn("n_children", children)
    done = land(done.select("rep", "depth", "up_rep", "up_depth", "n_convs", "n_children", "n_leaves", "least_conv", "saved_tokens"), "settled")
    under = done.where("up_rep is null and depth = 1").agg(F.count(F.lit(1)), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    members = of.join(placed.select("sid", "rep", "depth"), "sid").select("rep", "depth", "conv_id")
    up = F.col("depth") - 1
    inside = up > F.col("up_depth")
    named = done.withColumn("p_rep", F.when(inside, F.col("rep")).otherwise(F.col("up_rep"))).withColumn("p_depth", up)
    parent = done.select(F.col("rep").alias("p_rep"), F.col("depth").alias("p_depth"), F.col("least_conv").alias("p_conv"))
    nodes = (
        named.join(parent, ["p_rep", "p_depth"], "left")
        .join(end_digests(members), ["rep", "depth"], "left")
        .select(
            F.col("least_conv").alias("conv_id"),
            "depth",
            F.coalesce("p_conv", F.lit(least)).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )
    return root(*under).unionByName(nodes.select(columns))
