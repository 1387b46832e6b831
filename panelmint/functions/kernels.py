"""Numpy steps that run inside Spark tasks on one small, bounded group at a time."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Ship these functions by value: executors need numpy and pandas, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def eigen(components: int):
    """Principal components of one month, from its (bounded) table of pair moments."""

    def decompose(pdf: pd.DataFrame) -> pd.DataFrame:
        ords = np.unique(pdf[["i", "j"]].to_numpy())
        n, t = len(ords), float(pdf["t"].iloc[0])
        i, j = np.searchsorted(ords, pdf["i"]), np.searchsorted(ords, pdf["j"])
        cov = np.zeros((n, n))
        cov[i, j] = (pdf["sxy"] - pdf["sx"] * pdf["sy"] / t) / (t - 1)
        cov[j, i] = cov[i, j]
        values, vectors = np.linalg.eigh(cov)
        order = np.argsort(values)[::-1][: min(components, n)]
        total = values.sum()
        frames = []
        for rank, k in enumerate(order, start=1):
            vector = vectors[:, k]
            vector = vector * np.sign(vector[np.argmax(np.abs(vector))])
            frames.append(
                pd.DataFrame(
                    {
                        "month": np.int32(pdf["month"].iloc[0]),
                        "component": np.int32(rank),
                        "explained_variance": values[k] / total if total > 0 else 0.0,
                        "ord": ords.astype("int32"),
                        "loading": vector,
                    }
                )
            )
        return pd.concat(frames)

    return decompose


# One row per month and block of symbols. `stats` holds the block's statistics, one after the other, by slot.
PACKED = "month int, block int, slots binary, codes binary, stamps binary, rets binary, ords binary, stats binary"


class Block:
    """A block of series: its cells (`codes` point into `stamps`), and by slot the matrix positions and statistics."""

    def __init__(self, month, block, slots, codes, stamps, rets, ords, stats):
        self.month, self.block = month, block
        self.slots, self.codes, self.stamps, self.rets, self.ords, self.stats = slots, codes, stamps, rets, ords, stats

    @classmethod
    def of(cls, row, side: str = "") -> Block:
        part = lambda c, kind: np.frombuffer(getattr(row, side + c), kind)
        ords = part("ords", "<i8")
        stats = part("stats", "<f8")
        # Of a block whose symbols have all lost no series is left.
        stats = stats.reshape(-1, len(ords)) if len(ords) else np.zeros((SHARPE + 1, 0))
        return cls(
            getattr(row, side + "month"), getattr(row, side + "block"), part("slots", "<i4"), part("codes", "<i4"),
            part("stamps", "<i8"), part("rets", "<f8"), ords, stats,
        )

    def row(self) -> dict:
        as_bytes = lambda values, kind: np.ascontiguousarray(values, kind).tobytes()
        return {
            "month": np.int32(self.month), "block": np.int32(self.block), "slots": as_bytes(self.slots, "<i4"),
            "codes": as_bytes(self.codes, "<i4"), "stamps": as_bytes(self.stamps, "<i8"), "rets": as_bytes(self.rets, "<f8"),
            "ords": as_bytes(self.ords, "<i8"), "stats": as_bytes(self.stats, "<f8"),
        }

    def dense(self, stamps: np.ndarray) -> np.ndarray:
        out = np.zeros((len(stamps), len(self.ords)))
        out[np.searchsorted(stamps, self.stamps)[self.codes], self.slots] = self.rets
        return out

    def only(self, kept: np.ndarray) -> Block:
        """The series at the slots of a mask."""
        place = np.cumsum(kept) - 1
        mine = kept[self.slots]
        return Block(
            self.month, self.block, place[self.slots[mine]], self.codes[mine], self.stamps, self.rets[mine],
            self.ords[kept], self.stats[:, kept],
        )


def pack(frames):
    """Rows `month, block, kind, slot, stamp, ret` of whole blocks, in any order, to one row per block. Kind 0 are cells; others are
    the statistics of a series, with its matrix position as stamp."""
    parts: dict = {}
    for frame in frames:
        for key, own in frame.groupby(["month", "block"]):
            parts.setdefault(key, []).append([own[c].to_numpy() for c in ("kind", "slot", "stamp", "ret")])
    for (month, block), pieces in parts.items():
        kind, slot, stamp, ret = (np.concatenate(column) for column in zip(*pieces))
        pieces.clear()
        cells = kind == 0
        stamps, codes = np.unique(stamp[cells], return_inverse=True)
        stats = []
        for k in range(1, int(kind.max(initial=0)) + 1):
            mine = kind == k
            order = np.argsort(slot[mine])
            taken, ords = slot[mine][order], stamp[mine][order]
            stats.append(ret[mine][order])
        if stats:
            # Slots without a series are closed up.
            slots = np.searchsorted(taken, slot[cells])
            packed = Block(month, block, slots, codes, stamps, ret[cells], ords, np.stack(stats))
            yield pd.DataFrame([packed.row()])


def _dense_sides(row) -> tuple[Block, Block, np.ndarray, np.ndarray]:
    left, right = Block.of(row, "l_"), Block.of(row, "r_")
    stamps = np.union1d(left.stamps, right.stamps)
    x = left.dense(stamps)
    return left, right, x, x if left.block == right.block else right.dense(stamps)


def block_products(tile: int, rows_at_once: int = 1 << 18):
    """Sums of the symbol pairs of two blocks, for each pair of blocks that a task holds, some tiles at a time."""
    across = max(1, rows_at_once // tile)

    def filled(block: Block) -> np.ndarray:
        """Whether any series of a position's tile has a cell."""
        tiles = block.ords // tile
        return np.isin(tiles, np.unique(tiles[block.slots]))

    def products(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                left, right, x, y = _dense_sides(row)
                own, other = filled(left), filled(right)
                sx, sxx, sy, syy = x.sum(0), (x * x).sum(0), y.sum(0), (y * y).sum(0)
                for a in range(0, x.shape[1], tile):
                    for b in range(0, y.shape[1], across):
                        rows, cols = slice(a, a + tile), slice(b, b + across)
                        i, j = np.broadcast_arrays(left.ords[rows, None], right.ords[None, cols])
                        wanted = (i <= j) & (own[rows, None] | other[None, cols])
                        if not wanted.any():
                            continue
                        at, to = np.nonzero(wanted)
                        gram = x[:, rows].T @ y[:, cols]
                        yield pd.DataFrame(
                            {
                                "month": np.int32(row.l_month), "i": i[wanted].astype("int32"), "j": j[wanted].astype("int32"),
                                "sxy": gram[wanted], "sx": sx[rows][at], "sy": sy[cols][to], "sxx": sxx[rows][at], "syy": syy[cols][to],
                            }
                        )

    return products


# Statistics of a series in the strong pairs.
MEAN, SPREAD, REST, T, SHARPE = range(5)
STRIP = 256


def _correlated(x, y, left: np.ndarray, right: np.ndarray, screen: bool = False) -> np.ndarray:
    """Correlations of two sets of columns with their statistics, or the most they can be in size."""
    value = x.T @ y - left[T][:, None] * np.outer(left[MEAN], right[MEAN])
    if screen:
        value = np.abs(value) + np.outer(left[REST], right[REST])
    return value / np.outer(left[SPREAD], right[SPREAD])


def block_pairs(theta: float, screen: bool):
    """Pairs of blocks to the strong pairs in them; or, as a screen, to the block pairs that may hold one."""

    def work(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                left, right, x, y = _dense_sides(row)
                for a in range(0, x.shape[1], STRIP):
                    rows = slice(a, a + STRIP)
                    value = _correlated(x[:, rows], y, left.stats[:, rows], right.stats, screen)
                    # A bound is rounded up, so no pair at the threshold is lost to the order of a sum.
                    strong = value * (1 + 1e-9) + 1e-9 > theta if screen else np.abs(value) > theta
                    if left.block == right.block:
                        strong &= np.arange(a, a + len(value))[:, None] < np.arange(y.shape[1])[None, :]
                    if not strong.any():
                        continue
                    if screen:
                        yield pd.DataFrame([(row.l_month, left.block, right.block)], columns=["month", "left", "right"]).astype("int32")
                        break
                    at, to = np.nonzero(strong)
                    i, j = left.ords[rows][at], right.ords[to]
                    yield pd.DataFrame({"month": np.int32(row.l_month), "i": np.minimum(i, j).astype("int32"), "j": np.maximum(i, j).astype("int32"), "rho": value[strong]})

    return work


def dead_bits(width: int):
    """The losers of a block as one row of bits by matrix position."""

    def bits(pdf: pd.DataFrame) -> pd.DataFrame:
        dead = np.zeros(width, bool)
        dead[pdf["ord"].to_numpy() % width] = True
        return pd.DataFrame([(pdf["month"].iloc[0], pdf["block"].iloc[0], np.packbits(dead).tobytes())], columns=["month", "block", "dead"])

    return bits


def _alive(block: Block, dead, width: int) -> Block:
    if dead is None or dead is pd.NA or isinstance(dead, float):
        return block
    return block.only(~np.unpackbits(np.frombuffer(dead, "uint8"), count=width).astype(bool)[block.ords % width])


def walk_inside(theta: float, width: int):
    """The tournament among the live series of a block, in matrix order: the block's survivors, and who lost (`lost`)."""

    def work(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                block = _alive(Block.of(row), row.dead, width)
                x, sharpe = block.dense(block.stamps), block.stats[SHARPE]
                live = np.ones(len(sharpe), bool)
                start = 0
                while len(rows := start + np.flatnonzero(live[start:])[:STRIP]):
                    ahead = rows[0] + np.flatnonzero(live[rows[0]:])
                    strong = np.abs(_correlated(x[:, rows], x[:, ahead], block.stats[:, rows], block.stats[:, ahead])) > theta
                    standing = np.ones(len(ahead), bool)
                    for k, r in enumerate(rows):
                        # The rows of a strip are the first of those ahead.
                        if not standing[k]:
                            continue
                        met = strong[k] & standing
                        met[: k + 1] = False
                        better = met & (sharpe[ahead] > sharpe[r])
                        if better.any():
                            met[np.argmax(better):] = False
                            standing[k] = False
                        standing &= ~met
                    live[ahead[~standing]] = False
                    start = rows[-1] + 1
                lost = np.ascontiguousarray(block.ords[~live], "<i8").tobytes()
                yield pd.DataFrame([block.only(live).row() | {"lost": lost}])

    return work


def lost_rows(frames):
    for frame in frames:
        for row in frame.itertuples(index=False):
            ords = np.frombuffer(row.lost, "<i8")
            yield pd.DataFrame({"month": np.int32(row.month), "ord": ords.astype("int32")})


def pairs_beyond(theta: float, width: int):
    """Strong pairs of survivors of an earlier block (`l_`) with the live series of a later one (`r_`), without those that come after a
    survivor's certain defeat: by a better series that no earlier survivor contests."""

    def work(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                left, right = Block.of(row, "l_"), _alive(Block.of(row, "r_"), row.r_dead, width)
                stamps = np.union1d(left.stamps, right.stamps)
                x, y = left.dense(stamps), right.dense(stamps)
                contested = np.zeros(y.shape[1], bool)
                for a in range(0, x.shape[1], STRIP):
                    rows = slice(a, a + STRIP)
                    value = _correlated(x[:, rows], y, left.stats[:, rows], right.stats)
                    strong = np.abs(value) > theta
                    for k, sharpe in enumerate(left.stats[SHARPE, rows]):
                        beaten = strong[k] & ~contested & (right.stats[SHARPE] > sharpe)
                        if beaten.any():
                            strong[k, np.argmax(beaten) + 1:] = False
                        contested |= strong[k]
                    at, to = np.nonzero(strong)
                    if len(at):
                        i, j = left.ords[rows][at], right.ords[to]
                        yield pd.DataFrame({"month": np.int32(row.l_month), "i": i.astype("int32"), "j": j.astype("int32"), "rho": value[strong]})

    return work


def basis_products(frames):
    """Outer products of basis and product vectors (`v`, `w`), summed over the symbols a task holds: one matrix per month."""
    sums: dict = {}
    for frame in frames:
        for month, own in frame.groupby("month"):
            v, w = (np.stack([np.frombuffer(x, "<f8") for x in own[c]]) for c in ("v", "w"))
            sums[month] = sums.get(month, 0) + v.T @ w
    for month, part in sums.items():
        yield pd.DataFrame([(np.int32(month), np.int32(len(part)), np.ascontiguousarray(part, "<f8").tobytes())], columns=["month", "n", "product"])


def combined(turns: dict, append: bool = True):
    """Row by row, w - v A and then times B, for the matrices (A, B) of a month (None: left out). With `append` the result, or what B makes of a
    row without `w`, becomes the end of `v`."""

    def work(frames):
        for frame in frames:
            for month, own in frame.groupby("month"):
                a, b = turns[month]
                v = np.stack([np.frombuffer(x, "<f8") for x in own["v"]])
                alone = "w" not in own
                w = v if alone else np.stack([np.frombuffer(x, "<f8") for x in own["w"]])
                if a is not None:
                    w = w - v @ a
                if b is not None:
                    w = w @ b
                pack = lambda rows: [np.ascontiguousarray(r, "<f8").tobytes() for r in rows]
                out = pd.DataFrame({"month": own["month"].to_numpy("int32"), "ord": own["ord"].to_numpy("int32")})
                if append:
                    out["v"] = pack(w if alone else np.concatenate([v, w], axis=1))
                else:
                    out["v"], out["w"] = own["v"].to_numpy(), pack(w)
                yield out

    return work
