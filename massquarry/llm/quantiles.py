"""Percentiles of very large numeric columns: mergeable q-digests over a bounded ordered universe.

A value is quantised to the top `BITS` bits of its double, reordered so that integers compare as the values do: sign,
exponent and 12 bits of mantissa, a relative resolution of 2**-12 over all doubles. A digest counts values in nodes of
the dyadic tree over that universe; node x at depth d covers the universe values whose top d bits are x's. Siblings that
hold together with their parent less than the threshold floor(error * n / BITS) move up into it, so a digest of n values
keeps at most min(n, 3 * BITS / error) nodes; digests of fewer than 2 * BITS / error values are exact. Digests merge by
adding the counts of equal nodes.

The rank error is deterministic: a node above the leaves never holds more than error * n / BITS values, which adding
digests and compressing sums keeps, however often either happens. What an answer may miss or count too much lies in the
at most BITS nodes above one leaf, so its rank is off by at most error * n.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Depth of the dyadic tree.
BITS = 24


def quantised(v: np.ndarray) -> np.ndarray:
    """Universe positions of finite doubles, in their order."""
    u = (v + 0.0).view(np.uint64)
    u = np.where(u >> np.uint64(63), ~u, u | np.uint64(1 << 63))
    return (u >> np.uint64(64 - BITS)).astype(np.int64)


def value_of(x: np.ndarray) -> np.ndarray:
    """The middle of a universe position's values."""
    u = (x.astype(np.uint64) << np.uint64(64 - BITS)) | np.uint64(1 << (63 - BITS))
    u = np.where(u >> np.uint64(63), u & ~np.uint64(1 << 63), ~u)
    return u.view(np.float64)


def _added(g: np.ndarray, x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by group and node, with the counts of equal ones added."""
    order = np.lexsort((x, g))
    g, x, c = g[order], x[order], c[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (x[1:] != x[:-1])
    at = np.flatnonzero(new)
    return (g[at], x[at], np.add.reduceat(c, at)) if len(at) else (g, x, c)


def compress(group: np.ndarray, node: np.ndarray, count: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """group, node, count of the compressed digests of all groups at once. Nodes are numbered as in a heap: 1 is the
    root, 2x and 2x + 1 are the children of x. threshold: by group number."""
    group, node, count = _added(group, node, count)
    small = threshold[group] < 2  # nothing of these groups can move
    kept = [(group[small], node[small], count[small])]
    group, node, count = group[~small], node[~small], count[~small]
    depth = np.frexp(node.astype(float))[1] - 1
    g, x, c = (np.zeros(0, np.int64),) * 3
    for level in range(BITS, 0, -1):
        here, above = depth == level, depth == level - 1
        g, x, c = _added(np.concatenate([g, group[here]]), np.concatenate([x, node[here]]), np.concatenate([c, count[here]]))
        if not len(g):
            continue
        # siblings with their parent, which stays where it is
        fg, fx = np.concatenate([g, group[above]]), np.concatenate([x >> 1, node[above]])
        order = np.lexsort((fx, fg))
        new = np.ones(len(order), bool)
        new[1:] = (fg[order][1:] != fg[order][:-1]) | (fx[order][1:] != fx[order][:-1])
        at = np.flatnonzero(new)
        total = np.add.reduceat(np.concatenate([c, count[above]])[order], at)
        family = np.empty(len(order), np.int64)
        family[order] = np.repeat(total, np.diff(np.append(at, len(order))))
        up = family[: len(g)] < threshold[g]
        kept.append((g[~up], x[~up], c[~up]))
        g, x, c = g[up], x[up] >> 1, c[up]
    root = depth == 0
    kept.append((np.concatenate([g, group[root]]), np.concatenate([x, node[root]]), np.concatenate([c, count[root]])))
    return _added(*(np.concatenate(k) for k in zip(*kept, strict=True)))


def _codes(cols: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row's group, null-safe, and a row of each group."""
    code = np.zeros(len(cols[0]), np.int64)
    for c in cols:
        e = c.dictionary_encode(null_encoding="encode")
        code = code * (len(e.dictionary) + 1) + e.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1].astype(np.int64)
    first = np.zeros(int(code.max(initial=-1)) + 1, np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    return code, first


def _runs(cols: list[pa.Array]) -> np.ndarray:
    """Where a sorted batch's group begins; null-safe, by the text of the keys."""
    n = len(cols[0])
    start = np.zeros(n, bool)
    start[:1] = True
    for c in cols:
        code = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        start[1:] |= code[1:] != code[:-1]
    return start


def _partial(keys: list[str], error: float, held: int = 400_000):
    """mapInArrow (keys, value): digests over all batches of a task. `held` nodes are kept at a time; what then cannot be
    compressed to half, because it is many small groups, is given out."""

    def run(batches):
        state, n = [], 0

        def squeeze():
            t = pa.Table.from_batches(state).combine_chunks()
            cols = [t[k].combine_chunks() for k in keys]
            code, first = _codes(cols)
            count = t["count"].to_numpy()
            total = np.bincount(code, count)
            g, x, c = compress(code, t["node"].to_numpy(), count, np.floor(error * total / BITS))
            at = pa.array(first[g])
            return pa.RecordBatch.from_arrays([*(k.take(at) for k in cols), pa.array(x), pa.array(c.astype(np.int64))], [*keys, "node", "count"])

        for b in batches:
            if not b.num_rows:
                continue
            x = quantised(b.column("value__").to_numpy(zero_copy_only=False)) + (1 << BITS)
            state.append(pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(x), pa.array(np.ones(len(x), np.int64))], [*keys, "node", "count"]))
            n += len(x)
            if n >= held:
                out = squeeze()
                state, n = [out], out.num_rows
                if n > held // 2:
                    yield out
                    state, n = [], 0
        if n:
            yield squeeze()

    return run


def _recompress(keys: list[str], error: float, chunk: int = 300_000):
    """mapInArrow over rows (keys, node, count) sorted by keys: compressed digests of whole groups, with their totals."""

    def close(t: pa.Table):
        t = t.combine_chunks()
        cols = [t[k].combine_chunks() if isinstance(t[k], pa.ChunkedArray) else t[k] for k in keys]
        start = _runs(cols)
        code = np.cumsum(start) - 1
        at = np.flatnonzero(start)
        count = t["count"].to_numpy()
        total = np.add.reduceat(count, at)
        g, x, c = compress(code, t["node"].to_numpy(), count, np.floor(error * total / BITS))
        take = pa.array(at[g])
        return pa.RecordBatch.from_arrays([*(k.take(take) for k in cols), pa.array(x), pa.array(c), pa.array(total[g])], [*keys, "node", "count", "total"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= chunk:
                t = pa.Table.from_batches(held).combine_chunks()
                last = np.flatnonzero(_runs([t[k].combine_chunks() for k in keys]))[-1]
                if last:
                    yield close(t.slice(0, last))
                held = t.slice(last).to_batches()
                n = t.num_rows - last
        if n:
            yield close(pa.Table.from_batches(held))

    return run


def digests(df: DataFrame, keys: list[str], value: str, error: float = 0.005) -> DataFrame:
    """keys, node, count, total: one row per node of the digest of every group.

    Null, NaN and infinite values are not measured and left out; null keys form a group of their own; a group without
    any value has no digest; an empty table gives an empty result. Every task digests its values before the shuffle, so a
    group of any size leaves a task as at most 3 * BITS / error nodes.
    """
    v = F.col(value).cast("double")
    rows = df.select(*keys, v.alias("value__")).where(F.col("value__").isNotNull() & ~F.isnan("value__") & (F.abs("value__") != float("inf")))
    types = [df.schema[k] for k in keys]
    part = rows.mapInArrow(_partial(keys, error), T.StructType([*types, T.StructField("node", T.LongType()), T.StructField("count", T.LongType())]))
    return merge(part, keys, error)


def merge(nodes: DataFrame, keys: list[str], error: float = 0.005) -> DataFrame:
    """Digests of coarser groups from rows (keys, node, count): equal nodes are added, then compressed. The rank error is
    the larger one of the rows' and `error`."""
    out = T.StructType([*(nodes.schema[k] for k in keys), *(T.StructField(n, T.LongType()) for n in ("node", "count", "total"))])
    added = nodes.groupBy(*keys, "node").agg(F.sum("count").alias("count"))
    return added.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_recompress(keys, error), out)


def _answers(keys: list[str], shares: list[float]):
    """mapInArrow over digests sorted by keys: the percentiles of each group, by running sums over nodes ordered by the
    last universe position they cover, smaller nodes first. The answer is that last position: all that was counted before
    lies at or below it."""

    def close(t: pa.Table):
        t = t.combine_chunks()
        cols = [t[k].combine_chunks() for k in keys]
        start = _runs(cols)
        code, at = np.cumsum(start) - 1, np.flatnonzero(start)
        node, count, total = (t[c].to_numpy() for c in ("node", "count", "total"))
        depth = np.frexp(node.astype(float))[1] - 1
        shift = BITS - depth
        low = (node << shift) - (1 << BITS)
        high = low + (1 << shift) - 1
        order = np.lexsort((depth * -1, high, code))
        run = np.cumsum(count[order])
        base = run[np.maximum(at, 1) - 1] * (at > 0)
        run = run - base[code[order]]
        # one number that ascends over all groups: group and running share
        place = code[order] + run / (total[order] + 1.0)
        out = []
        for s in shares:
            rank = np.ceil(s * total[at])
            k = np.searchsorted(place, np.arange(len(at)) + np.maximum(rank, 1) / (total[at] + 1.0) - 1e-12)
            x = order[np.minimum(k, len(order) - 1)]
            out.append(value_of(high[x]))
        take = pa.array(at)
        return pa.RecordBatch.from_arrays([*(c.take(take) for c in cols), pa.array(total[at]), *(pa.array(o) for o in out)], [*keys, "total", *(f"q{k}" for k in range(len(shares)))])

    def run(batches):
        held = []
        for b in batches:
            t = pa.Table.from_batches([*held, b])
            last = np.flatnonzero(_runs([t[k].combine_chunks() for k in keys]))[-1] if t.num_rows else 0
            if last:
                yield close(t.slice(0, last))
            held = t.slice(last).to_batches()
        if held and sum(b.num_rows for b in held):
            yield close(pa.Table.from_batches(held))

    return run


def percentiles(nodes: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """keys, n and one column per share: the value whose rank is off by no more than the digest's error."""
    types = [nodes.schema[k] for k in keys]
    fields = [T.StructField("total", T.LongType()), *(T.StructField(f"q{k}", T.DoubleType()) for k in range(len(shares)))]
    rows = nodes.select(*keys, "node", "count", "total").repartition(*keys).sortWithinPartitions(*keys)
    got = rows.mapInArrow(_answers(keys, list(shares.values())), T.StructType([*types, *fields]))
    names: list[Column] = [F.col(f"q{k}").alias(n) for k, n in enumerate(shares)]
    return got.select(*keys, F.col("total").alias("n"), *names)
