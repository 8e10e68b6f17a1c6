"""Most similar vectors for every vector: vantage-point trees per shard.

Equal vectors are searched once and stand for all their ids. Shards are groups of vectors that can be similar at all:

- by default, vectors that name a common key are linked, and the connected components of the links are the shards. Keys
  are the triples among a vector's strongest bins, and those single bins and pairs among them that alone hold `heavy` of
  its squared length. The share of pairs that this misses is measured in the tests and stated in the README. Among very
  many vectors any two meet in some key by chance, and links by chance would join everything to one shard: a link by a
  single key of few vectors counts only if the two vectors' cosine is at least two thirds of `least`, or if other links
  join them anyway;
- with `exact`, a shard is a bin: bins are ordered from rare to frequent, and a vector belongs to the shards of its first
  bins, up to where what is left is shorter than `least`. Two vectors with a cosine of at least `least` have their first
  common bin among those of both, so they meet in its shard, and no pair is missed.

A shard of more than `block` vectors is split by a vantage-point tree over a bounded sample of it into leaves. Every
vector is searched in its own leaf first; with the k-th best found there as radius, it goes to those other leaves that the
triangle inequality over angles, relaxed by `factor`, does not rule out. Within a leaf a tree answers all searches at
once. Factor 1 is exact, greater ones leave out more.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from massquarry.llm.splits import components
from massquarry.llm.vectors import as_binary, binned, from_binary, strongest
from massquarry.workspace import stage

#: Vectors of a large shard that its tree is fitted on, at most; the tree then assigns every vector.
SAMPLE = 65_536
#: Vectors that share a key, above which the key links them for sure.
HOT = 16
#: Rows that one task sends through a tree, or asks of a leaf, before the work is divided.
_PORTION = 50_000


# --- vectors and keys


def _vectors(width: float):
    """mapInArrow (id, mz, i): id, digest, vector of the usable rows."""

    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            rows, off, bins, w = binned(b.column(1), b.column(2), width)
            v = as_binary(off, bins, w)
            digest = [hashlib.blake2b(x, digest_size=16).digest() for x in v.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids[rows].astype(np.int64)), pa.array(digest, pa.binary()), v], ["id", "digest", "vector"])

    return run


def _mix(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit number of several columns of integers."""
    h = np.full(len(parts[0]), 0x9E3779B97F4A7C15, np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ p.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def keys_of(off: np.ndarray, bins: np.ndarray, w: np.ndarray, m: int, heavy: float) -> tuple[np.ndarray, np.ndarray]:
    """row, key: see the module's text."""
    top = strongest(off, bins, w, m)
    n = len(top)
    mass = np.zeros((n, m))
    row = np.repeat(np.arange(n), np.diff(off))
    for c in range(m):  # the squared weight of each of the strongest bins
        hit = bins == top[row, c]
        mass[row[hit], c] = w[hit] ** 2
    rows, out = [], []
    for size in (1, 2, 3):
        for c in itertools.combinations(range(m), size):
            ok = (top[:, list(c)] >= 0).all(axis=1)
            if size < 3:
                ok &= mass[:, list(c)].sum(axis=1) >= heavy
            at = np.flatnonzero(ok)
            rows.append(at)
            out.append(_mix(np.full(len(at), size), *(top[at, x] for x in c)))
    return np.concatenate(rows), np.concatenate(out)


def _key_rows(m: int, heavy: float):
    """mapInArrow (id, vector): key, id, sure. Rows of one id and key leave a batch once. Where more than HOT vectors of a
    batch share a key, the first leaves with it, and each other one leaves linked to the first, for sure, by a key of their
    own, so a key that very many rows share leaves each batch once."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy()
            row, key = keys_of(*from_binary(b.column(1).to_pylist()), m, heavy)
            own = ids[row]
            order = np.lexsort((own, key))
            key, own = key[order], own[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
            key, own = key[new], own[new]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            at = np.flatnonzero(first)
            size = np.diff(np.append(at, len(key)))
            hot = ~first & np.repeat(size > HOT, size)
            links = np.unique(np.stack([own[hot], np.repeat(own[at], size)[hot]]), axis=1)
            between = _mix(np.zeros(links.shape[1], np.int64), *links)
            sure = np.zeros((~hot).sum() + 2 * len(between), bool)
            sure[(~hot).sum() :] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([key[~hot], between, between])), pa.array(np.concatenate([own[~hot], links[0], links[1]])), pa.array(sure)], ["key", "id", "sure"])

    return run


def _halves(batches):
    """mapInArrow (id, vector): the vectors with weights in half precision."""
    for b in batches:
        half = [v[: len(v) // 3] + np.frombuffer(v, "<f8", offset=len(v) // 3).astype("<f2").tobytes() for v in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(half, pa.binary())], ["id", "half"])


def _alike(least: float):
    """mapInArrow (u, v, a, b): u, v where the cosine of a and b, vectors in half precision, is about `least` or more."""

    def run(batches):
        for batch in batches:
            off, bins, w = zip(*(from_binary(c.to_pylist(), "<f2") for c in batch.columns[2:]), strict=True)
            n = batch.num_rows
            code = [np.repeat(np.arange(n), np.diff(off[x])) << 32 | bins[x] for x in (0, 1)]  # ascending
            at = np.minimum(np.searchsorted(code[0], code[1]), max(0, len(code[0]) - 1))
            same = code[0][at] == code[1]
            keep = pa.array(np.bincount(code[1][same] >> 32, w[0][at[same]] * w[1][same], n) >= least)
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:2]], ["u", "v"])

    return run


def _by_links(vectors: DataFrame, m: int, heavy: float, least: float) -> DataFrame:
    """shard, id: the connected components of vectors (id, vector) with common keys. Repeated rows count once; of different
    vectors with one id, each brings its links."""
    keyed = vectors.mapInArrow(_key_rows(m, heavy), "key long, id long, sure boolean")
    same = W.partitionBy("key")
    links = keyed.withColumn("last", F.lag("id").over(same.orderBy("id"))).withColumn("head", F.min("id").over(same)).withColumn("n", F.count(F.lit(1)).over(same))
    # with the first of the key, and with the one before, in case that the first is there by chance
    links = links.where(F.col("last") != F.col("id")).select("id", F.explode(F.array_distinct(F.array("head", "last"))).alias("v"), (F.col("sure") | (F.col("n") > HOT)).alias("sure"))
    links = stage(links.groupBy(F.col("id").alias("u"), "v").agg((F.max("sure") | (F.count(F.lit(1)) > 1)).alias("sure")), "links")
    # u is above v, and a component's root is its smallest node
    sure = stage(components(links.where("sure").select("u", "v")), "roots")
    root = lambda side: sure.select(F.col("node").alias(f"{side}__"), F.col("root").alias(f"{side}_root"))
    weak = links.where(~F.col("sure")).join(root("u"), F.col("u") == F.col("u__"), "left").join(root("v"), F.col("v") == F.col("v__"), "left")
    weak = weak.select("u", "v", F.coalesce("u_root", "u").alias("u_root"), F.coalesce("v_root", "v").alias("v_root")).where(F.col("u_root") != F.col("v_root"))
    weak = stage(weak, "weak")
    ends = weak.select(F.explode(F.array("u", "v")).alias("e__")).distinct()
    half = vectors.mapInArrow(_halves, "id long, half binary").join(ends, F.col("id") == F.col("e__"), "left_semi").dropDuplicates(["id", "half"])
    half = stage(half, "halves")
    side = lambda x: half.select(F.col("id").alias(f"{x}__"), F.col("half").alias(f"{x}_half"))
    alike = weak.join(side("u"), F.col("u") == F.col("u__")).join(side("v"), F.col("v") == F.col("v__"))
    alike = alike.select("u_root", "v_root", "u_half", "v_half").mapInArrow(_alike(least * 2 / 3), "u long, v long")
    more = stage(components(alike), "roots").select(F.col("node").alias("m__"), F.col("root").alias("shard"))
    joined = sure.join(more, F.col("root") == F.col("m__"), "left").select(F.coalesce("shard", "root").alias("shard"), F.col("node").alias("id"))
    return joined.unionByName(more.join(sure, F.col("m__") == F.col("node"), "left_anti").select("shard", F.col("m__").alias("id")))


def _bins(batches):
    """mapInArrow (id, vector): id, bin, mass of every bin."""
    for b in batches:
        off, bins, w = from_binary(b.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), np.diff(off))), pa.array(bins), pa.array(w * w)], ["id", "bin", "mass"])


def _by_prefix(base: DataFrame, least: float) -> DataFrame:
    """shard, id: the first bins of each vector, from rare to frequent, up to where the rest is shorter than `least`."""
    cells = base.mapInArrow(_bins, "id long, bin long, mass double")
    count = cells.groupBy(F.col("bin").alias("b__")).agg(F.count(F.lit(1)).alias("f"))
    w = W.partitionBy("id").orderBy("f", "bin").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("mass").over(w), F.lit(0.0))
    # rounding to six decimals lets a cosine slightly below `least` count
    return cells.join(count, F.col("bin") == F.col("b__")).withColumn("before", before).where(F.col("before") <= 1 - (least - 1e-6) ** 2 + 1e-9).select(F.col("bin").alias("shard"), "id")


# --- searching


class Tree:
    """Vantage-point tree over the rows of a matrix of unit vectors, with angles as the metric."""

    def __init__(self, x: np.ndarray, leaf: int = 64, seed: int = 5):
        self.x, self.leaf, self.rng = x, leaf, np.random.default_rng(seed)
        self.root = self._build(np.arange(len(x)))

    def _build(self, rows: np.ndarray):
        """A node: vantage point, and per half its rows' least and greatest angle from it."""
        if len(rows) <= self.leaf:
            return rows
        v = int(rows[self.rng.integers(len(rows))])
        rest = rows[rows != v]
        d = np.arccos(np.clip(self.x[rest] @ self.x[v], -1, 1))
        near = d <= np.median(d)
        if near.all():  # many equal angles: halves of any rows still bound them
            near = np.arange(len(d)) < len(d) // 2
        halves = [(d[s].min(), d[s].max(), self._build(rest[s])) for s in (near, ~near)]
        return v, halves

    def search(self, q: np.ndarray, k: int, least: float, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The rows nearest to each row of q: similarities and positions, (len(q), k) each, best first; -1 where none.

        All searches go down together; at each node those go on for which the relaxed bound does not rule it out."""
        sim = np.full((len(q), k), -2.0)
        pos = np.full((len(q), k), -1, np.int64)
        worst = np.full(len(q), np.arccos(np.clip(least, -1, 1)) + 1e-6)

        def offer(who, rows, s):
            """Merge candidates: s is (len(who), len(rows))."""
            s = np.round(s, 6)
            both = np.concatenate([sim[who], s], axis=1)
            at = np.concatenate([pos[who], np.broadcast_to(rows, s.shape)], axis=1)
            order = np.lexsort((at, -both), axis=1)[:, :k]
            sim[who] = np.take_along_axis(both, order, 1)
            pos[who] = np.take_along_axis(at, order, 1)
            full = sim[who, -1] > -2
            worst[who] = np.where(full, np.minimum(worst[who], np.arccos(np.clip(sim[who, -1] - 1e-6, -1, 1)) + 1e-9), worst[who])

        def go(node, who):
            if not len(who):
                return
            if isinstance(node, np.ndarray):
                offer(who, node, q[who] @ self.x[node].T)
                return
            v, halves = node
            s = q[who] @ self.x[v]
            offer(who, np.array([v]), s[:, None])
            d = np.arccos(np.clip(s, -1, 1))
            gap = [np.maximum(lo - d, d - hi) for lo, hi, _ in halves]
            for first in (0, 1):  # the nearer half first, so that the bound of the other is tight
                turn = (gap[0] <= gap[1]) if first == 0 else (gap[0] > gap[1])
                for h in (first, 1 - first):
                    sel = turn & (gap[h] * factor <= worst[who])
                    go(halves[h][2], who[sel])

        go(self.root, np.arange(len(q)))
        return sim, pos


class Leaf:
    """Vectors of one leaf or small shard, ready for searches. Only bins that they hold become columns."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        rows = sorted(rows, key=lambda x: x[0])  # equal similarities: the smaller id first
        self.ids = np.array([r[0] for r in rows], np.int64)
        off, bins, w = from_binary([r[1] for r in rows])
        self.cols, inv = np.unique(bins, return_inverse=True)
        x = np.zeros((len(rows), len(self.cols)))
        x[np.repeat(np.arange(len(rows)), np.diff(off)), inv] = w
        self.tree = Tree(x)

    def search(self, rows: list[tuple[int, bytes]], k: int, least: float, factor: float):
        """id, neighbour, similarity of up to k neighbours of every row; a row's own id is none."""
        out = []
        step = max(16, min(2_000, 4_000_000 // max(1, len(self.cols))))
        for s in range(0, len(rows), step):
            part = rows[s : s + step]
            own = np.array([r[0] for r in part], np.int64)
            off, bins, w = from_binary([r[1] for r in part])
            at = np.minimum(np.searchsorted(self.cols, bins), len(self.cols) - 1)
            same = self.cols[at] == bins
            q = np.zeros((len(part), len(self.cols)))
            q[np.repeat(np.arange(len(part)), np.diff(off))[same], at[same]] = w[same]
            sim, pos = self.tree.search(q, min(k + 1, len(self.ids)), least, factor)
            sim = np.where((self.ids[pos] == own[:, None]) | (pos < 0), -3, sim)
            order = np.lexsort((pos, -sim), axis=1)[:, :k]
            sim, pos = np.take_along_axis(sim, order, 1), np.take_along_axis(pos, order, 1)
            who, col = np.nonzero(sim >= least)
            out.append((own[who], self.ids[pos[who, col]], sim[who, col]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


_FOUND = "shard long, id long, neighbour long, similarity double"


def _found(parts) -> pa.RecordBatch:
    g, i, j, s = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(s, pa.float64())], ["shard", "id", "neighbour", "similarity"])


def _within(ids: np.ndarray, size: np.ndarray, off: np.ndarray, bins: np.ndarray, w: np.ndarray, k: int, least: float):
    """row, neighbour's row, similarity: up to k neighbours of every row within its group. Rows of one group after another;
    size: rows of each group. For groups too small for a tree: all are compared at once."""
    g = np.repeat(np.arange(len(size)), size)
    first, base = (np.cumsum(x) - x for x in (size, size**2))
    slot = base[g] + (np.arange(len(ids)) - first[g]) * size[g] - first[g]  # of a pair of rows i, j: slot[i] + j
    row = np.repeat(np.arange(len(ids)), np.diff(off))
    code = g[row] << 32 | bins
    order = np.argsort(code, kind="stable")
    code, row, w = code[order], row[order], w[order]
    new = np.ones(len(code) + 1, bool)
    new[1:-1] = code[1:] != code[:-1]
    at = np.flatnonzero(new)
    left = np.repeat(at[1:], np.diff(at)) - 1 - np.arange(len(code))  # rows that follow with the same bin
    slots, products, at, d = [], [], np.flatnonzero(left), 1
    while len(at):
        slots.append(slot[row[at]] + row[at + d])
        products.append(w[at] * w[at + d])
        at = at[left[at] > d]
        d += 1
    if not slots:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    s = np.round(np.bincount(np.concatenate(slots), np.concatenate(products)), 6)
    hit = np.flatnonzero(s >= least)
    of = np.searchsorted(base, hit, side="right") - 1
    i, j = first[of] + (hit - base[of]) // size[of], first[of] + (hit - base[of]) % size[of]
    i, j, s = np.append(i, j), np.append(j, i), np.append(s[hit], s[hit])
    order = np.lexsort((ids[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    start = np.ones(len(i), bool)
    start[1:] = i[1:] != i[:-1]
    at = np.flatnonzero(start)
    best = np.arange(len(i)) - np.repeat(at, np.diff(np.append(at, len(i)))) < k
    return i[best], j[best], s[best]


def _own_leaf(k: int, least: float, factor: float, small: int = 64, portion: int = 4_000_000):
    """mapInArrow (group, id, vector) sorted by group (shard, leaf, part): every row's neighbours within its group."""

    def search(b, starts):
        shard, ids, v = b.column(0).flatten()[0].to_numpy(), b.column(1).to_numpy(), b.column(2)
        size = np.diff(np.append(starts, b.num_rows))
        peaks = np.add.reduceat(pc.binary_length(v).to_numpy() // 12, starts)
        few = np.flatnonzero((size > 1) & (size <= small))
        for part in np.split(few, np.flatnonzero(np.diff(np.cumsum((size * peaks)[few]) // portion)) + 1):
            if not len(part):
                continue
            rows = np.concatenate([np.arange(starts[x], starts[x] + size[x]) for x in part])
            i, j, s = _within(ids[rows], size[part], *from_binary(v.take(pa.array(rows)).to_pylist()), k, least)
            yield shard[rows[i]], ids[rows[i]], ids[rows[j]], s
        for x in np.flatnonzero(size > small):
            at = slice(starts[x], starts[x] + size[x])
            rows = list(zip(ids[at].tolist(), v[at].to_pylist(), strict=True))
            got = Leaf(rows).search(rows, k, least, factor)
            yield np.full(len(got[0]), shard[starts[x]]), *got

    def run(batches):
        rest = None
        for b in itertools.chain(batches, [None]):
            if b is not None and not b.num_rows:
                continue
            now = b if rest is None else rest if b is None else pa.concat_batches([rest, b])
            if now is None:
                return
            group = np.stack([c.to_numpy() for c in now.column(0).flatten()])
            starts = np.append(0, 1 + np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)))
            rest = None
            if b is not None:  # the last group may go on
                rest = now.slice(starts[-1])
                now, starts = now.slice(0, starts[-1]), starts[:-1]
            if len(starts) and (parts := list(search(now, starts))):
                yield _found(parts)

    return run


def _other_leaves(k: int, least: float, factor: float, batch: int = 2_000):
    """mapInArrow (group, asks, id, vector) sorted by group, the leaf's own vectors first: those that ask stream through."""

    def run(batches):
        group, own, leaf, ask = None, [], None, []

        def search():
            got = leaf.search(ask, k, least, factor)
            return _found([(np.full(len(got[0]), group["shard"]), *got)])

        for b in batches:
            for g, asks, i, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if g != group:
                    if ask:
                        yield search()
                    group, own, leaf, ask = g, [], None, []
                if not asks:
                    own.append((i, v))
                    continue
                if not own:
                    continue
                if leaf is None:
                    leaf = Leaf(own)
                ask.append((i, v))
                if len(ask) >= batch:
                    yield search()
                    ask = []
        if ask:
            yield search()

    return run


# --- large shards


def _angles(off, bins, w, pb: np.ndarray, pw: np.ndarray) -> np.ndarray:
    """Angle of every vector from the vector (pb, pw)."""
    at = np.minimum(np.searchsorted(pb, bins), len(pb) - 1)
    x = np.where(pb[at] == bins, w * pw[at], 0.0)
    return np.arccos(np.clip(np.add.reduceat(x, off[:-1]), -1, 1)) if len(off) > 1 else np.zeros(0)


def _rows_of(off, bins, w, rows):
    size = off[rows + 1] - off[rows]
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(off[rows], size)
    return np.append(0, np.cumsum(size)), bins[at], w[at]


class Router:
    """The upper part of a large shard's tree. A node parts what lies within an angle of its vantage point from the rest;
    the angles bound all vectors, not the sample's only, as they are what assigns them."""

    def __init__(self, off, bins, w, leaves: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.pivots, self.cuts, self.children = [], [], []
        parts: list[tuple[np.ndarray, tuple | None]] = [(np.arange(len(off) - 1), None)]  # rows and where they hang
        done: list[tuple[np.ndarray, tuple | None]] = []
        while parts and len(parts) + len(done) < leaves:
            parts.sort(key=lambda x: len(x[0]))
            rows, hang = parts.pop()
            best = None
            mine = _rows_of(off, bins, w, rows)
            for v in rng.choice(len(rows), min(6, len(rows)), replace=False):
                pb, pw = mine[1][mine[0][v] : mine[0][v + 1]], mine[2][mine[0][v] : mine[0][v + 1]]
                d = _angles(*mine, pb, pw)
                s = np.sort(d)
                mid = s[len(s) // 2]
                near = d <= mid if mid < s[-1] else d < mid
                share = min(near.sum(), len(d) - near.sum())
                if share and (best is None or share > best[0]):
                    best = share, pb, pw, (d[near].max() + d[~near].min()) / 2, near
            if best is None:
                done.append((rows, hang))
                continue
            _, pb, pw, cut, near = best
            node = len(self.pivots)
            self.pivots.append((pb, pw))
            self.cuts.append(cut)
            self.children.append([0, 0])
            if hang:
                self.children[hang[0]][hang[1]] = node
            parts += [(rows[near], (node, 0)), (rows[~near], (node, 1))]
        for leaf, (_, hang) in enumerate(parts + done):
            if hang:
                self.children[hang[0]][hang[1]] = -leaf - 1

    def route(self, off, bins, w, reach: np.ndarray | None = None, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """row, leaf: the leaf of each row, or with reach (angles) all leaves that may hold something as near."""
        n = len(off) - 1
        if not self.pivots:
            return np.arange(n), np.zeros(n, np.int64)
        out, todo = [], [(0, np.arange(n))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                out.append((rows, np.full(len(rows), -node - 1)))
                continue
            d = _angles(*_rows_of(off, bins, w, rows), *self.pivots[node])
            cut = self.cuts[node]
            near = d <= cut if reach is None else (d - cut) * factor <= reach[rows]
            far = ~near if reach is None else (cut - d) * factor <= reach[rows]
            todo += [(self.children[node][0], rows[near]), (self.children[node][1], rows[far])]
        r, leaf = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((leaf, r))
        return r[order], leaf[order]


def _routers(batches):
    """mapInArrow (shard, leaves, vector) sorted by shard: one tree per shard. At most SAMPLE vectors of a shard come."""
    shard, leaves, rows = None, 0, []

    def build():
        off, bins, w = from_binary(rows)
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([pickle.dumps(Router(off, bins, w, leaves))], pa.binary())], ["shard", "vector"])

    for b in batches:
        for s, n, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if s != shard:
                if rows:
                    yield build()
                shard, leaves, rows = s, n, []
            rows.append(v)
    if rows:
        yield build()


def _through(factor: float | None):
    """mapInArrow (at, is_row, id, reach, vector) sorted by at (shard, portion), the tree first: shard, leaf, id, vector."""

    def run(batches):
        at, router, rows, batch = None, None, [], 2_000

        def send():
            v = [r[2] for r in rows]
            reach = None if factor is None else np.array([r[1] for r in rows], float)
            r, leaf = router.route(*from_binary(v), reach, factor or 1.0)
            take = pa.array(r)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(r), at["shard"]), pa.int64()), pa.array(leaf, pa.int64()), pa.array([x[0] for x in rows], pa.int64()).take(take), pa.array(v, pa.binary()).take(take)], ["shard", "leaf", "id", "vector"]
            )

        for b in batches:
            for g, is_row, i, reach, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if g != at:
                    if rows:
                        yield send()
                    at, router, rows = g, None, []
                if not is_row:
                    router = pickle.loads(v)
                    # a row may go to all leaves
                    batch = 2_000 if factor is None else max(16, 50_000 // (len(router.pivots) + 1))
                    continue
                rows.append((i, reach, v))
                if len(rows) >= batch:
                    yield send()
                    rows = []
        if rows:
            yield send()

    return run


def _send(rows: DataFrame, trees: DataFrame, factor: float | None) -> DataFrame:
    """rows (shard, n, id, reach, vector) through their shards' trees, in portions, each with a copy of its tree."""
    portions = F.ceil(F.col("n") / _PORTION).cast("int")
    mine = rows.select(F.struct("shard", F.pmod(F.xxhash64("id"), portions).cast("int").alias("portion")).alias("at"), F.lit(True).alias("is_row"), "id", "reach", "vector")
    sizes = trees.withColumn("portion", F.explode(F.sequence(F.lit(0), portions - 1)))
    theirs = sizes.select(F.struct("shard", "portion").alias("at"), F.lit(False).alias("is_row"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("double").alias("reach"), "vector")
    both = mine.unionByName(theirs).repartition("at").sortWithinPartitions("at", "is_row")
    return both.mapInArrow(_through(factor), "shard long, leaf long, id long, vector binary")


def _large(rows: DataFrame, k: int, least: float, factor: float, block: int) -> DataFrame:
    """Neighbours within large shards; rows: shard, n, id, vector."""
    wanted = F.least(F.ceil(F.col("n") / block), F.lit(SAMPLE // 16)).cast("int")
    pick = F.row_number().over(W.partitionBy("shard").orderBy(F.xxhash64("id"), "id"))
    sample = rows.withColumn("leaves", wanted).withColumn("r", pick).where(F.col("r") <= SAMPLE).where(F.col("r") <= 16 * F.col("leaves"))
    trees = sample.select("shard", "leaves", "vector").repartition("shard").sortWithinPartitions("shard").mapInArrow(_routers, "shard long, vector binary")
    counts = rows.groupBy(F.col("shard").alias("s__")).agg(F.first("n").alias("n"))
    trees = stage(trees.join(counts, F.col("shard") == F.col("s__")).select("shard", "n", "vector"), "trees")
    placed = stage(_send(rows.withColumn("reach", F.lit(None).cast("double")), trees, None), "leaves")
    # a leaf that no vantage point parts any further is cut by hash, and each part asks the others
    sizes = stage(placed.groupBy(F.col("shard").alias("s__"), F.col("leaf").alias("l__")).agg(F.count(F.lit(1)).alias("m")).withColumn("cuts", F.ceil(F.col("m") / (2 * block)).cast("int")), "sizes")
    in_leaf = (F.col("shard") == F.col("s__")) & (F.col("leaf") == F.col("l__"))
    part = F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")
    home = placed.join(sizes, in_leaf).select("shard", "leaf", part.alias("part"), "id", "vector")
    group = F.struct("shard", "leaf", "part").alias("group")
    first = stage(home.select(group, "id", "vector").repartition("group").sortWithinPartitions("group").mapInArrow(_own_leaf(k, least, factor), _FOUND), "own")
    near = first.groupBy(F.col("shard").alias("s__"), F.col("id").alias("i__")).agg(F.count(F.lit(1)).alias("c"), F.min("similarity").alias("s"))
    reach = F.acos(F.when(F.col("c") >= k, F.greatest("s", F.lit(least))).otherwise(least) - 1e-6)
    askers = rows.join(near, (F.col("shard") == F.col("s__")) & (F.col("id") == F.col("i__")), "left").select("shard", "n", "id", "vector", reach.alias("reach"))
    sent = _send(askers, trees, factor)
    own = placed.select(F.col("shard").alias("s2__"), F.col("id").alias("i2__"), F.col("leaf").alias("own"))
    sent = sent.join(sizes, in_leaf).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    sent = sent.join(own, (F.col("shard") == F.col("s2__")) & (F.col("id") == F.col("i2__"))).where((F.col("leaf") != F.col("own")) | (F.col("part") != part))
    sent = stage(sent.select("shard", "leaf", "part", "id", "vector"), "askers")
    turns = sent.groupBy(F.col("shard").alias("s__"), F.col("leaf").alias("l__"), F.col("part").alias("p__")).agg(F.ceil(F.count(F.lit(1)) / _PORTION).cast("int").alias("turns"))
    at = (F.col("shard") == F.col("s__")) & (F.col("leaf") == F.col("l__")) & (F.col("part") == F.col("p__"))
    group = F.struct("shard", "leaf", "part", "turn").alias("group")
    ask = sent.join(turns, at).withColumn("turn", F.pmod(F.xxhash64("id"), F.col("turns")).cast("int")).select(group, F.lit(True).alias("asks"), "id", "vector")
    held = home.join(turns, at).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).select(group, F.lit(False).alias("asks"), "id", "vector")
    second = held.unionByName(ask).repartition("group").sortWithinPartitions("group", "asks").mapInArrow(_other_leaves(k, least, factor), _FOUND)
    return first.unionByName(second)


def _search(shards: DataFrame, base: DataFrame, k: int, least: float, factor: float, block: int) -> DataFrame:
    """id, neighbour, similarity over the distinct vectors of base (id, vector), within the shards (shard, id)."""
    shards = stage(shards, "shards")
    sizes = shards.groupBy(F.col("shard").alias("s__")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    large = stage(sizes.where(F.col("n") > block), "sizes")
    placed = shards.join(sizes.select("s__"), F.col("shard") == F.col("s__"), "left_semi").withColumnRenamed("id", "i__")
    placed = placed.join(base, F.col("i__") == F.col("id")).select("shard", "id", "vector")
    none = large.isEmpty()
    small = placed if none else placed.join(large, F.col("shard") == F.col("s__"), "left_anti")
    group = F.struct("shard", F.lit(0).cast("long").alias("leaf"), F.lit(0).alias("part")).alias("group")
    found = small.select(group, "id", "vector").repartition("group").sortWithinPartitions("group").mapInArrow(_own_leaf(k, least, factor), _FOUND)
    if not none:
        found = found.unionByName(_large(stage(placed.join(large, F.col("shard") == F.col("s__")).select("shard", "n", "id", "vector"), "large"), k, least, factor, block))
    return found.select("id", "neighbour", "similarity")


def _best(by: str, last: str, k: int) -> tuple[Column, Column]:
    r = F.row_number().over(W.partitionBy(by).orderBy(F.desc("similarity"), last))
    return r, F.col("rank") <= k


def _rows(df: DataFrame, id_col: str, mz: str, intensity: str) -> DataFrame:
    cols = (F.col(id_col).cast("long").alias("id"), F.col(mz).cast("array<double>").alias("mz"), F.col(intensity).cast("array<double>").alias("i"))
    return df.select(*cols).where(F.col("id").isNotNull())


def nearest(df: DataFrame, id_col: str, mz: str, intensity: str, k: int = 5, least: float = 0.75, factor: float = 1.0, exact: bool = False, strongest_bins: int = 7, heavy: float = 0.5, width: float = 0.1, block: int = 800) -> DataFrame:
    """id, neighbour, similarity, rank: up to k most similar other vectors with a similarity of at least `least`.

    Rows that are not usable (see vectors.binned), among them null, empty and unequal lists, have no neighbours and are
    none; rows that repeat an id count once; equal similarities are ordered by the smaller id. Very long lists are used
    whole. Extra columns are ignored. An empty table gives an empty result. With exact=True and factor 1 no neighbour is
    missed; the work then grows with the square of the commonest bins' rows where trees cannot prune.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and not above 1")
    vectors = stage(_rows(df, id_col, mz, intensity).mapInArrow(_vectors(width), "id long, digest binary, vector binary"), "vectors")
    members = vectors.groupBy("id").agg(F.min("digest").alias("digest"))
    groups = members.groupBy("digest").agg(F.min("id").alias("u"), F.count(F.lit(1)).alias("copies"))
    groups = stage(groups, "groups")
    # equal vectors are one node of the links, whose keys may come from all rows; only one of equal vectors is searched
    # 40 bits, as the shuffles of the keys grow with them; vectors that share a node share their links
    node = F.xxhash64("digest").bitwiseAND(F.lit(2**40 - 1))
    single = groups.select(F.col("u").alias("r__"))
    # one exchange of the vectors, by id, serves this join, the grouping and the join with the shards
    base = vectors.join(groups.select("u"), F.col("id") == F.col("u"), "left_semi").groupBy("id").agg(F.min_by("vector", "digest").alias("vector"))
    if exact:
        shards = _by_prefix(base, least).join(single, F.col("id") == F.col("r__"), "left_semi")
    else:
        shards = _by_links(vectors.select(node.alias("id"), "vector"), strongest_bins, heavy, least).withColumnRenamed("id", "node__")
        shards = shards.join(groups.select("u", node.alias("n__")), F.col("node__") == F.col("n__")).select("shard", F.col("u").alias("id"))
    found = _search(shards, base, k, least, factor, block).distinct()
    rank, top = _best("id", "neighbour", k)
    found = found.withColumn("rank", rank).where(top)
    # distinct vectors stand for their ids: as neighbours for the k + 1 smallest, as askers for all; equal vectors are
    # neighbours of each other
    groups = members.join(groups.where(F.col("copies") > 1), "digest").select("u", F.col("id").alias("member"))
    few = groups.withColumn("r", F.row_number().over(W.partitionBy("u").orderBy("member"))).where(F.col("r") <= k + 1).select(F.col("u").alias("n__"), "member")
    wide = found.join(few, F.col("neighbour") == F.col("n__"), "left").select("id", F.coalesce("member", "neighbour").alias("neighbour"), "similarity")
    wide = wide.unionByName(few.select(F.col("n__").alias("id"), F.col("member").alias("neighbour"), F.lit(1.0).alias("similarity")))
    rank, top = _best("id", "neighbour", k + 1)
    wide = wide.withColumn("rank", rank).where(top)
    each = wide.join(groups, F.col("id") == F.col("u"), "left").select(F.coalesce("member", "id").alias("id"), "neighbour", "similarity").where(F.col("id") != F.col("neighbour"))
    rank, top = _best("id", "neighbour", k)
    return each.withColumn("rank", rank).where(top)


def _blocks(k: int, width: int = 4_000):
    """mapInArrow (block, asks, id, vector) sorted by block, its vectors first: the k best of the block for each query."""

    def run(batches):
        at, own, parts = None, [], None

        def load():
            out = []
            for s in range(0, len(own), width):
                rows = sorted(own[s : s + width])
                off, bins, w = from_binary([r[1] for r in rows])
                cols, inv = np.unique(bins, return_inverse=True)
                x = np.zeros((len(cols), len(rows)))
                x[inv, np.repeat(np.arange(len(rows)), np.diff(off))] = w
                out.append((np.array([r[0] for r in rows], np.int64), cols, x))
            return out

        def ask(i, v):
            _, bins, w = from_binary([v])
            best = []
            for ids, cols, x in parts:
                c = np.minimum(np.searchsorted(cols, bins), len(cols) - 1)
                same = cols[c] == bins
                s = np.round(w[same] @ x[c[same]], 6)
                s[ids == i] = -1
                few = np.flatnonzero(s >= np.partition(s, -k)[-k]) if len(s) > k else np.arange(len(s))
                few = few[s[few] > 0]
                best += zip((-s[few]).tolist(), ids[few].tolist(), strict=True)
            return sorted(best)[:k]

        for b in batches:
            who, other, sim = [], [], []
            for g, asks, i, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if g != at:
                    at, own, parts = g, [], None
                if not asks:
                    own.append((i, v))
                    continue
                if parts is None:
                    parts = load()
                for s, j in ask(i, v):
                    who.append(i)
                    other.append(j)
                    sim.append(-s)
            yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(other, pa.int64()), pa.array(sim, pa.float64())], ["id", "neighbour", "similarity"])

    return run


def nearest_of(df: DataFrame, id_col: str, mz: str, intensity: str, asks: Column, k: int = 5, width: float = 0.1, block: int = 20_000) -> DataFrame:
    """id, neighbour, similarity, rank: the k most similar other vectors, at any similarity above zero, of the rows that
    `asks` (over id) names, exactly: the stated queries go through all rows in blocks of about `block` vectors.

    Nulls, repeats, ties, extra columns and empty tables as with nearest."""
    vectors = _rows(df, id_col, mz, intensity).mapInArrow(_vectors(width), "id long, digest binary, vector binary")
    vectors = stage(vectors.groupBy("id").agg(F.min(F.struct("digest", "vector")).alias("v")).select("id", "v.vector"), "vectors")
    blocks = max(1, -(-vectors.count() // block))
    own = vectors.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"), "id", "vector")
    ask = vectors.where(asks).select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), "id", "vector")
    found = own.unionByName(ask).repartition("block").sortWithinPartitions("block", "asks").mapInArrow(_blocks(k), "id long, neighbour long, similarity double")
    rank, top = _best("id", "neighbour", k)
    return found.withColumn("rank", rank).where(top)
