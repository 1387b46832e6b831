"""Near-duplicate vectors by NN-descent on a neighbour graph per label."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmint.llm.common import components, land, stream_groups

BITS = 32
EDGE = "u long, v long, sim double"


def usable(vectors: DataFrame) -> DataFrame:
    """(node, realm, vec, copies, draw): distinct vectors that can link, with the smallest vec_id, the number of copies and the
    audit draw: 50 if a copy has a vec_id divisible by 50, else 5 if one has a vec_id divisible by 5, else 1.

    A realm is a label and a dimension. Null, zero and non-finite vectors, null labels and null ids are left out.
    """
    e = F.col("embedding")
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(e, lambda x: x != 0)
    whole = vectors.where("vec_id is not null and label is not null and embedding is not null").where(sound)
    unsigned = F.transform(e, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")))  # -0.0 as 0.0
    realm = F.concat_ws(":", F.col("label").cast("string"), F.size(e).cast("string"))
    name = F.col("vec_id").cast("long")
    draw = F.when(name % 50 == 0, F.lit(50)).when(name % 5 == 0, F.lit(5)).otherwise(F.lit(1))
    return whole.groupBy(realm.alias("realm"), unsigned.alias("vec")).agg(F.min(name).alias("node"), F.count(F.lit(1)).alias("copies"), F.max(draw).alias("draw"))


def _units(column: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in column])
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _adjacent(nodes: DataFrame, sweeps: int, reach: int, seed: int, threshold: float) -> DataFrame:
    """First edges: `reach` neighbours to each side in `sweeps` sorted orders. The key of an order is the signs of BITS random
    projections, most significant first: close vectors share a prefix, and a prefix is as long as it takes to tell
    neighbours apart, whatever the number of vectors."""

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, some in frame.groupby(frame["vec"].map(len)):
                lines = np.random.default_rng([seed, size]).normal(size=(size, sweeps * BITS))
                signs = (_units(some["vec"]) @ lines > 0).reshape(len(some), sweeps, BITS)
                place = signs @ (1 << np.arange(BITS)[::-1])
                for k in range(sweeps):
                    yield pd.DataFrame({"sweep": k, "realm": some["realm"], "place": place[:, k], "node": some["node"], "vec": some["vec"]})

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for frame in frames:
            if tail is not None:
                frame = pd.concat([tail, frame], ignore_index=True)
            tail = frame.iloc[-reach:]
            same = (frame["sweep"].astype(str) + "/" + frame["realm"]).to_numpy()
            node = frame["node"].to_numpy()
            cuts = [0, *(np.flatnonzero(same[1:] != same[:-1]) + 1), len(frame)]
            for a, b in zip(cuts, cuts[1:]):
                unit = _units(frame["vec"].iloc[a:b])
                for d in range(1, min(reach, b - a - 1) + 1):
                    sim = (unit[:-d] * unit[d:]).sum(axis=1).clip(max=threshold)
                    u, v = node[a : b - d], node[a + d : b]
                    yield pd.DataFrame({"u": np.r_[u, v], "v": np.r_[v, u], "sim": np.r_[sim, sim]})

    lined = nodes.select("realm", "node", "vec").mapInPandas(project, "sweep int, realm string, place long, node long, vec array<double>")
    order = ["sweep", "realm", "place", "node"]
    return lined.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(walk, EDGE)


def _nearest(edges: DataFrame, room: DataFrame | None, least: int) -> DataFrame:
    """The best edges of each node: `least` of them, or as many as `room` (node, k) says if that is more. Keeps the fresh flag."""
    once = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), F.xxhash64("u", "v"), "v")))
    if room is None:
        return ranked.where(F.col("rank") <= least).drop("rank")
    sized = ranked.join(room.select(F.col("node").alias("u"), "k"), "u", "left")
    return sized.where(F.col("rank") <= F.greatest(F.coalesce("k", F.lit(least)), F.lit(least))).drop("rank", "k")


def _local_join(edges: DataFrame, nodes: DataFrame, groups: DataFrame, neighbours: int, threshold: float, chunk: int = 256) -> DataFrame:
    """Neighbours of neighbours: all who share a pivot are compared, pairs of two old edges excepted.

    A pivot's neighbours stream in chunks of bounded size in an order that changes with the pivot; each gets at most `neighbours`
    proposals per chunk, so a hub adds rows in proportion to its edges. Similarities
    above the threshold count alike: once a list holds links only, there is nothing better to look for, except
    links to nodes of other groups: these come first and pass any list.
    """
    both = edges.select(F.col("u").alias("p"), F.col("v").alias("q"), "fresh").union(edges.select(F.col("v").alias("p"), F.col("u").alias("q"), "fresh"))
    both = both.groupBy("p", "q").agg(F.max("fresh").alias("fresh"))
    active = both.groupBy("p").agg(F.max("fresh").alias("any")).where("any").select("p")
    worst = edges.groupBy("u").agg(F.min("sim").alias("worst")).withColumnRenamed("u", "q")
    sent = both.join(active, "p").join(nodes.select(F.col("node").alias("q"), "vec"), "q").join(worst, "q", "left")
    sent = sent.join(groups.withColumnRenamed("node", "q"), "q", "left").withColumn("component", F.coalesce("component", "q"))

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for group in stream_groups(frames, ["p"]):
            for a in range(0, len(group), chunk):
                some = group.iloc[a : a + chunk]
                if len(some) < 2:
                    continue
                unit, q, fresh = _units(some["vec"]), some["q"].to_numpy(), some["fresh"].to_numpy(bool)
                sim = (unit @ unit.T).clip(max=threshold)
                own = some["component"].to_numpy()
                bridge = (sim >= threshold) & (own[:, None] != own[None, :])
                sim[~(fresh[:, None] | fresh[None, :])] = -2
                np.fill_diagonal(sim, -2)
                sim[sim <= some["worst"].fillna(-2).to_numpy()[:, None]] = -2
                sim[bridge] = threshold + 1
                k = min(neighbours, len(some) - 1)
                best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
                value = np.take_along_axis(sim, best, 1)
                i, j = np.nonzero(value > -2)
                if len(i):
                    out.append((q[i], q[best[i, j]], value[i, j].clip(max=threshold)))
                    held += len(i)
            if held > 50_000:
                yield pd.DataFrame({n: np.concatenate([o[c] for o in out]) for c, n in enumerate(("u", "v", "sim"))})
                out, held = [], 0
        if out:
            yield pd.DataFrame({n: np.concatenate([o[c] for o in out]) for c, n in enumerate(("u", "v", "sim"))})

    return sent.repartition("p").sortWithinPartitions("p", F.xxhash64("p", "q")).mapInPandas(meet, EDGE)


def _merge(groups: DataFrame | None, links: DataFrame) -> tuple[DataFrame, bool]:
    """Groups (node, component) after more links (u, v), and whether these joined any. Nodes may be named by their component."""
    if groups is None:
        return components(links, "u", "v"), True
    own = lambda c, n: groups.select(F.col("node").alias(c), F.col("component").alias(n))
    met = links.join(own("u", "x"), "u", "left").join(own("v", "y"), "v", "left")
    joins = land(met.select(F.coalesce("x", "u").alias("a"), F.coalesce("y", "v").alias("b")).where("a <> b").distinct(), "joins")
    if joins.isEmpty():
        return groups, False
    moved = components(joins).select(F.col("node").alias("component"), F.col("component").alias("to"))
    every = groups.select("node", "component").union(moved.select(F.col("component").alias("node"), "component")).distinct()
    return land(every.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "groups"), True


def _grid(rows: DataFrame, others: DataFrame | None = None, block: int = 8192) -> DataFrame:
    """Each piece of a realm of `rows` beside each piece of the same realm of `others` (of `rows` without them, each two once):
    columns of both, x, y, side, sorted by realm, x, y. Pieces have about `block` vectors. Sizes meet a realm in salted places."""
    parts = lambda frame, n: frame.groupBy("realm").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(n))
    second = rows if others is None else others
    sizes = parts(rows, "xs").join(parts(second, "ys"), "realm").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
    salted = lambda frame: frame.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(64)).cast("int")).join(sizes, ["realm", "salt"])
    piece = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = salted(rows).withColumn("x", piece("xs")).withColumn("y", each("ys")).withColumn("side", F.lit(0))
    right = salted(second).withColumn("y", piece("ys")).withColumn("x", each("xs")).withColumn("side", F.lit(1))
    met = left.unionByName(right).drop("xs", "ys", "salt")
    keys = ["realm", "x", "y"]
    return (met.where("x <= y") if others is None else met).repartition(*keys).sortWithinPartitions(*keys)


def _unite(root: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Roots (the smallest of each set) after uniting pairs of roots."""
    while len(pairs):
        np.minimum.at(root, pairs[:, 1], pairs[:, 0])
        while (root[root] != root).any():
            root = root[root]
        pairs = np.sort(root[pairs], axis=1)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return root


def exact_joins(rows: DataFrame, threshold: float) -> DataFrame:
    """(u, v): components joined by a link between two of these rows (realm, node, component, vec), every pair compared. A block
    returns a forest over its components, never its pairs."""

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in stream_groups(frames, ["realm", "x", "y"]):
            names, own = np.unique(block["component"].to_numpy(), return_inverse=True)
            if len(names) < 2:
                continue
            unit, side = _units(block["vec"]), block["side"].to_numpy()
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            root = np.arange(len(names))
            for a in range(0, len(left), 256):
                some = left[a : a + 256]
                i, j = np.nonzero(unit[some] @ unit[right].T >= threshold)
                pairs = np.sort(root[np.stack([own[some[i]], own[right[j]]], axis=1)], axis=1)
                root = _unite(root, np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0))
            moved = np.flatnonzero(root != np.arange(len(names)))
            yield pd.DataFrame({"u": names[moved], "v": names[root[moved]]})

    return _grid(rows.select("realm", "node", "component", "vec")).mapInPandas(meet, "u long, v long")


def audit_recall(nodes: DataFrame, groups: DataFrame, threshold: float, evidence: int = 100) -> float:
    """Recall of the groups: for each query the share of its true links whose other end shares its group, averaged within each
    group, then over groups, so that large groups weigh no more than pairs.

    Queries are the vectors with a vec_id divisible by 50; they meet all rows of their realm, in blocks. Where fewer than `evidence` of them have
    a true link, those divisible by 5 are asked, then all.
    """
    named = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node")).select("realm", "node", "component", "vec", "draw")

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in stream_groups(frames, ["realm", "x", "y"]):
            unit, side, node, own = _units(block["vec"]), block["side"].to_numpy(), block["node"].to_numpy(), block["component"].to_numpy()
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            for a in range(0, len(left), 256):
                some = left[a : a + 256]
                linked = (unit[some] @ unit[right].T >= threshold) & (node[some][:, None] != node[right][None, :])
                hit = linked & (own[some][:, None] == own[right][None, :])
                yield pd.DataFrame({"node": node[some], "component": own[some], "n": linked.sum(axis=1), "hit": hit.sum(axis=1)})

    for every in (50, 5, 1):
        met = _grid(named.where(F.col("draw") >= every), named).mapInPandas(search, "node long, component long, n long, hit long")
        per_query = met.groupBy("node", "component").agg(F.sum("n").alias("n"), F.sum("hit").alias("hit")).where("n > 0")
        per_group = per_query.groupBy("component").agg(F.count(F.lit(1)).alias("queries"), F.avg(F.col("hit") / F.col("n")).alias("recall"))
        r = per_group.agg(F.sum("queries").alias("queries"), F.avg("recall").alias("recall")).first()
        if (r["queries"] or 0) >= evidence:
            break
    return 1.0 if r["recall"] is None else r["recall"]


def count_links(nodes: DataFrame, groups: DataFrame, threshold: float, chunk: int = 512) -> DataFrame:
    """(node, links): copies linked directly with each vector of a group, itself left out.

    A group is cut into pieces of about `chunk` vectors and each two pieces meet in one block: counts leave the
    task, pairs do not.
    """
    sizes = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("pieces"))
    cut = groups.join(sizes, "component").withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    member = cut.join(nodes.select("node", "vec", "copies"), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    blocks = member.select("component", F.least("piece", "other").alias("x"), F.greatest("piece", "other").alias("y"), "piece", "node", "vec", "copies")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in stream_groups(frames, ["component", "x", "y"]):
            units, copies, node = _units(block["vec"]), block["copies"].to_numpy(np.int64), block["node"].to_numpy()
            linked = units @ units.T >= threshold
            np.fill_diagonal(linked, False)
            if block["x"].iloc[0] != block["y"].iloc[0]:
                piece = block["piece"].to_numpy()
                linked &= piece[:, None] != piece[None, :]
            yield pd.DataFrame({"node": node, "links": linked.astype(np.int64) @ copies})

    keys = ["component", "x", "y"]
    parts = blocks.repartition(*keys).sortWithinPartitions(*keys, "node").mapInPandas(count, "node long, links long")
    return parts.groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    neighbours: int = 8,
    sweeps: int = 8,
    recall: float = 0.99,
    rounds: int = 5,
    attempts: int = 4,
    seed: int = 7,
) -> DataFrame:
    """Vectors of one label linked by cosine >= threshold (double precision).

    Copies of a vector collapse first. The neighbour graph starts from random projections; rounds of local joins improve it as long as
    they join groups or more than 1 in 200 nodes still change. A node whose whole list lies above the threshold is saturated: its
    list doubles once a round joins nothing, until a doubling joins nothing either. Every link that was met counts for the groups,
    whether or not a list keeps it, and saturated nodes of different groups are then compared exactly, in blocks. Orders grow with the
    logarithm of the number of vectors. An audit searches a set of queries exactly; below `recall` the descent goes on with twice
    as many new projections and longer lists, and after `attempts` all vectors of a label are compared exactly, in blocks: no
    failed recall is accepted. Inside groups links are
    counted exactly, in blocks, so no list length bounds a count.

    Returns one row per input row: vec_id, n_links, component_id, kept. A vector that is null, zero or not finite, or
    has no label, links with nothing; a row without vec_id neither (component_id null, kept true). Vectors of different lengths do not
    link. Rows that repeat a vec_id count as separate vectors, and share the group of that id.
    """
    nodes = land(usable(vectors), "vectors")
    total = max(1, nodes.count())
    sweeps = max(sweeps, math.ceil(math.log2(total)))
    edges, room, groups, size = None, None, None, neighbours
    links = lambda found: found.where(F.col("sim") >= threshold).select("u", "v")
    lists = lambda close: close.groupBy("u").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("u", "node")
    for attempt in range(attempts):
        first = land(_adjacent(nodes, sweeps, max(2, size // 2), seed + attempt, threshold), "adjacent")
        groups, _ = _merge(groups, links(first))
        first = first.withColumn("fresh", F.lit(True))
        edges = land(_nearest(first if edges is None else edges.unionByName(first), room, size), "neighbours")
        step, doubled = 0, False
        while True:
            step += 1
            better = land(_local_join(edges, nodes, groups, size, threshold), "proposals")
            groups, joined = _merge(groups, links(better))
            better = better.withColumn("fresh", F.lit(True))
            edges = land(_nearest(edges.withColumn("fresh", F.lit(False)).unionByName(better), room, size), "neighbours")
            if joined:
                doubled = False
                continue
            if doubled:
                break
            full = lists(links(edges))
            full = (full if room is None else full.join(room, "node", "left")).withColumn("k", F.lit(size) if room is None else F.greatest(F.coalesce("k", F.lit(size)), F.lit(size)))
            full = land(full.where("n >= k").select("node", (2 * F.col("k")).cast("int").alias("k")), "full")
            if not full.isEmpty():
                room = full if room is None else land(room.unionByName(full).groupBy("node").agg(F.max("k").alias("k")), "room")
                again = full.select(F.col("node").alias("u"), F.lit(True).alias("again"))
                edges = edges.join(again, "u", "left").withColumn("fresh", F.col("fresh") | F.coalesce("again", F.lit(False))).drop("again")
                doubled = True
            elif edges.where("fresh").select("u").distinct().count() * 200 < total or step >= rounds:
                break
        saturated = lists(links(edges)).where(F.col("n") >= neighbours).join(groups, "node").join(nodes, "node")
        groups, _ = _merge(groups, exact_joins(saturated, threshold))
        if audit_recall(nodes, groups, threshold) >= recall:
            break
        size, sweeps = 2 * size, 2 * sweeps
    else:
        named = nodes.join(groups, "node", "left") if groups is not None else nodes.withColumn("component", F.col("node"))
        groups, _ = _merge(groups, exact_joins(named.withColumn("component", F.coalesce("component", "node")), threshold))

    counted = count_links(nodes, groups, threshold)
    known = nodes.select("node", "realm", "vec", "copies").join(groups, "node", "left").join(counted, "node", "left")
    known = known.select("realm", "vec", F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.coalesce("component", "node")).toDF("realm", "vec", "links", "component")
    return _spread(vectors, land(known, "linked"))


def _spread(vectors: DataFrame, known: DataFrame) -> DataFrame:
    """Answers of distinct vectors back to their copies."""
    e = F.col("embedding")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id").isNotNull(), F.concat_ws(":", F.col("label").cast("string"), F.size(e).cast("string"))).alias("realm"),
        F.transform(e, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double"))).alias("vec"),
    )
    met = rows.join(known, ["realm", "vec"], "left")
    component = F.coalesce("component", "vec_id")
    return met.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
