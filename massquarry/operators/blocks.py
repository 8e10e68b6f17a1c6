"""Spectra that meet in blocks. Peaks are packed as bytes, about a thousand spectra a row; every pair of blocks that can
hold a wanted pair meets once, as rows of staged tables and without a shuffle, and an Arrow kernel works on the whole pair
of blocks. Only pairs of spectra that are wanted leave it, so nothing on disk grows with the pairs that are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from massquarry.functions.kernels import Peaks, mirrors
from massquarry.workspace import stage

#: Spectra and peaks of a block, at most (a spectrum with more peaks is a block of its own), and products made at once.
ROWS, PEAKS, AT_ONCE = 1_024, 65_536, 1_000_000


def _floats(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """values (NaN for null), lengths, null mask of a list column."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    size = np.where(null, 0, np.diff(column.offsets.to_numpy())).astype(np.int64)
    return np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), float), size, null


def _bytes(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array with the values of each row."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * values.itemsize).astype("<i4").tobytes()), pa.py_buffer(values.tobytes())])


def _pack(width: float | None):
    """mapInArrow (..., mz, intensity): the peaks that spectra.peaks keeps, in its order, as bytes; summed per bin with a
    width."""

    def run(batches):
        for b in batches:
            (m, lm, nm), (i, li, ni) = _floats(b.column(b.num_columns - 2)), _floats(b.column(b.num_columns - 1))
            good = (lm == li) & ~nm & ~ni
            row = np.repeat(np.arange(len(lm)), lm)
            m, i, row = m[good[row]], i[good[np.repeat(np.arange(len(li)), li)]], row[good[row]]
            keep = np.isfinite(m) & np.isfinite(i) & (m >= 0) & (i >= 0)
            m, i, row = m[keep], i[keep], row[keep]
            order = np.lexsort((i, m, row))
            m, i, row = m[order], i[order], row[order]
            if width is not None:
                m = np.floor(m / width).astype("<i8")
                new = np.ones(len(m), bool)
                new[1:] = (row[1:] != row[:-1]) | (m[1:] != m[:-1])
                at = np.flatnonzero(new)
                i, m, row = np.add.reduceat(i, at) if len(at) else i, m[at], row[at]
            off = np.append(0, np.cumsum(np.bincount(row, minlength=len(lm))))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], _bytes(m, off), _bytes(i, off)], [*b.schema.names[:-2], "keys", "values"])

    return run


def _blocks(slot: float, most: int):
    """mapInArrow (id, part, at, code, keys, values) in the order of part and at: blocks of one part and one slot of at."""

    def run(batches):
        for b in batches:
            part, at = b.column(1).to_pylist(), np.asarray(b.column(2).to_numpy(zero_copy_only=False), float)
            if not len(part):
                continue
            ends = [np.frombuffer(c.buffers()[1], "<i4")[c.offset : c.offset + len(c) + 1].astype(np.int64) for c in (b.column(4), b.column(5))]
            data = [np.frombuffer(c.buffers()[2] or b"", "u1")[x[0] : x[-1]] for c, x in zip((b.column(4), b.column(5)), ends, strict=True)]
            off = (ends[0] - ends[0][0]) // 8
            cell = np.floor(at / slot)
            new = np.array([k == 0 or part[k] != part[k - 1] or cell[k] != cell[k - 1] for k in range(len(part))], bool)
            ends = np.append(np.flatnonzero(new)[1:], len(part))
            out, s = [], 0
            for end in ends.tolist():
                while s < end:
                    e = max(s + 1, min(end, s + most, int(np.searchsorted(off, off[s] + PEAKS, "right")) - 1))
                    out.append((s, e))
                    s = e
            start = np.array([0, *(e for _, e in out)], np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(start), b.column(k)) for k in (0, 3)]
            first = pa.array([str(b.column(0)[s]) for s, _ in out], pa.string())
            raw = lambda x: pa.array([x[s:e].tobytes() for s, e in out], pa.binary())
            size = np.diff(off).astype("<i4")
            peaks = [pa.array([d[8 * off[s] : 8 * off[e]].tobytes() for s, e in out], pa.binary()) for d in data]
            edge = lambda f: pa.array([float(f(at[s:e])) for s, e in out], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [first, pa.array([part[s] for s, _ in out], pa.string()), edge(np.min), edge(np.max), lists[0], raw(at.astype("<f8")), lists[1], raw(size), *peaks],
                ["first", "part", "lo", "hi", "ids", "at", "codes", "sizes", "keys", "values"],
            )

    return run


def blocks(df: DataFrame, key: str, mz: str, intensity: str, at: Column | None = None, part: Column | None = None, code: Column | None = None, width: float | None = 0.1, slot: float = 1.0, most: int = ROWS) -> DataFrame:
    """The staged blocks of the spectra of df, one per key (null keys are left out). With at (finite and above zero) or
    part (not null), spectra without it are left out, and a block holds those of one part and one slot of at. code is
    any binary value that the kernel should see; width as in spectra.binned, or None to keep the peaks."""
    kind = df.schema[key].dataType.simpleString()
    has = F.col(key).isNotNull()
    rows = df.where(has).select(
        F.col(key).alias("id"), (F.lit("") if part is None else part.cast("string")).alias("part"), (F.lit(1.0) if at is None else at.cast("double")).alias("at"),
        (F.lit(b"") if code is None else code).alias("code"), F.col(mz).alias("mz"), F.col(intensity).alias("intensity"),
    )
    rows = rows.mapInArrow(_pack(width), f"id {kind}, part string, at double, code binary, keys binary, values binary").dropDuplicates(["id"])
    rows = rows.where(F.col("part").isNotNull() & (F.col("at") > 0) & (F.col("at") < float("inf")))
    if at is not None or part is not None:
        rows = rows.repartition("part", F.floor(F.col("at") / slot)).sortWithinPartitions("part", "at")
    schema = f"first string, part string, lo double, hi double, ids array<{kind}>, at binary, codes array<binary>, sizes binary, keys binary, values binary"
    return stage(rows.mapInArrow(_blocks(slot, most), schema), "blocks")


class Block:
    """Spectra of one side in flat arrays: spectrum, key and value of each peak."""

    def __init__(self, at: bytes, sizes: bytes, keys: bytes, values: bytes, codes: list[bytes], binned: bool):
        self.at, self.size, self.codes = np.frombuffer(at, "<f8"), np.frombuffer(sizes, "<i4").astype(np.int64), codes
        self.n = len(self.size)
        self.row = np.repeat(np.arange(self.n), self.size)
        self.begin = np.cumsum(self.size) - self.size
        self.key, self.value = np.frombuffer(keys, "<i8" if binned else "<f8"), np.frombuffer(values, "<f8")

    def binned(self, width: float) -> Block:
        """The same spectra with sums per bin instead of peaks, which are sorted by m/z."""
        key = np.floor(self.key / width).astype("<i8")
        new = np.ones(len(key), bool)
        new[1:] = (self.row[1:] != self.row[:-1]) | (key[1:] != key[:-1])
        at = np.flatnonzero(new)
        sums = np.add.reduceat(self.value, at) if len(at) else self.value
        size = np.bincount(self.row[at], minlength=self.n).astype("<i4")
        return Block(self.at.tobytes(), size.tobytes(), key[at].tobytes(), sums.tobytes(), self.codes, True)

    def per_row(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, v, minlength=self.n)

    def shares(self, total: np.ndarray) -> np.ndarray:
        """Values over the total of their spectrum, 0 where that is 0."""
        t = total[self.row]
        return np.divide(self.value, t, out=np.zeros(len(t)), where=t > 0)


def _products(a: np.ndarray, low: np.ndarray, high: np.ndarray, b: np.ndarray):
    """Positions in a and b of all that meet, a portion at a time: a's k-th key meets b, its sorted keys, from low to high."""
    lo, hi = np.searchsorted(b, low), np.searchsorted(b, high, "right")
    size = np.maximum(hi - lo, 0)
    upto = np.append(0, np.cumsum(size))
    s = 0
    while s < len(a):
        e = max(s + 1, int(np.searchsorted(upto, upto[s] + AT_ONCE, "right")) - 1)
        n = size[s:e]
        if n.any():
            yield np.repeat(np.arange(s, e), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[s:e], n)
        s = e


def cosines(a: Block, b: Block) -> np.ndarray:
    """Cosine of each spectrum of a with each of b over equal bins."""
    ka, kb = a.key, b.key
    wa, wb = (x.shares(np.sqrt(x.per_row(x.value * x.value))) for x in (a, b))
    order = np.argsort(kb, kind="stable")
    cell, w, base, out = b.row[order], wb[order], a.row * b.n, None
    for i, j in _products(ka, ka, ka, kb[order]):
        part = np.bincount(base[i] + cell[j], wa[i] * w[j], minlength=a.n * b.n)
        out = part if out is None else np.add(out, part, out=out)
    return (np.zeros(a.n * b.n) if out is None else out).reshape(a.n, b.n)


def entropies(a: Block, b: Block, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Entropy similarity of the spectra x of a with y of b, as spectra.entropy_of_pairs."""
    place = np.full(a.n * b.n, -1, np.int64)
    place[x * b.n + y] = np.arange(len(x))
    pa_, pb = (s.shares(s.per_row(s.value)) for s in (a, b))
    # peaks of the wanted spectra, those without intensity left out
    mine = np.flatnonzero(np.isin(np.arange(a.n), x)[a.row] & (pa_ > 0))
    other = np.flatnonzero(np.isin(np.arange(b.n), y)[b.row] & (pb > 0))
    other = other[np.argsort(b.key[other], kind="stable")]
    base, row, p, q, key = a.row[mine] * b.n, b.row[other], pa_[mine], pb[other], a.key[mine]
    h = lambda v: v * np.log(v)
    out = np.zeros(len(x))
    for i, j in _products(key, key, key, b.key[other]):
        at = place[base[i] + row[j]]
        keep = at >= 0
        at, u, v = at[keep], p[i[keep]], q[j[keep]]
        out += np.bincount(at, h(u + v) - h(u) - h(v), minlength=len(out))
    return out / np.log(4.0)


def _chosen(s: Block, rows: np.ndarray) -> Peaks:
    """Peaks of the given spectra, one pair each."""
    n = s.size[rows]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(s.begin[rows], n)
    return Peaks(np.repeat(np.arange(len(rows)), n), s.key[at], s.value[at], len(rows))


def may_mirror(a: Block, b: Block, ppm: float = 5.0, da: float = 0.002, least: float = 0.01, share: float = 0.95) -> np.ndarray:
    """Which spectra of a and b have enough strong peaks within tolerance for kernels.mirrors, counted without regard to
    one peak being used twice; it is true wherever mirrors is."""
    strong = []
    for s in (a, b):
        top = np.zeros(s.n)
        np.maximum.at(top, s.row, s.value)
        keep = (top[s.row] > 0) & (s.value >= least * top[s.row])
        strong.append((s.row[keep], s.key[keep], np.bincount(s.row[keep], minlength=s.n)))
    (ra, ka, na), (rb, kb, nb) = strong
    order = np.argsort(kb, kind="stable")
    tol = np.maximum(ka * ppm * 1e-6, da) + 1e-6
    count = np.zeros(a.n * b.n, np.int64)
    for i, j in _products(ka, ka - tol, ka + tol, kb[order]):
        count += np.bincount(ra[i] * b.n + rb[order[j]], minlength=len(count))
    return count.reshape(a.n, b.n) >= np.maximum(2, share * np.maximum(na[:, None], nb[None, :]) - 1e-9)


def _similar(least: float, width: float | None, best: int | None, entropy: bool, same: bool):
    def found(a: Block, b: Block, one: bool):
        c = cosines(a, b)
        x, y = np.divmod(np.flatnonzero(c.ravel() >= least), b.n)
        keep = np.abs(a.at[x] - b.at[y]) <= width if width is not None else np.ones(len(x), bool)
        if one and same:  # a block with itself: each pair once
            keep &= x < y
        x, y = x[keep], y[keep]
        if best is not None and len(x):  # what rounding could still bring among the best stays
            v = c[x, y]
            order = np.lexsort((-v, x))
            x, y, v = x[order], y[order], v[order]
            first = np.searchsorted(x, x)
            last = np.minimum(first + best, np.searchsorted(x, x, "right")) - 1
            x, y = x[v >= v[last] - 2e-6], y[v >= v[last] - 2e-6]
        return x, y, [c[x, y], *([entropies(a, b, x, y)] if entropy else [])]

    return found


def _tiers(a: Block, b: Block, one: bool):
    gap = np.abs(a.at[:, None] - b.at[None, :])
    near = gap <= 0.0101
    if not near.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), [[]]
    code = np.unique(np.array([*a.codes, *b.codes], object), return_inverse=True)[1]
    equal = near & (code[: a.n, None] == code[None, a.n :])
    x, y = np.nonzero((gap <= 0.005) & ~equal & may_mirror(a, b))
    mirror = np.zeros(gap.shape, bool)
    for s in range(0, len(x), 4_000):
        p, q = x[s : s + 4_000], y[s : s + 4_000]
        mirror[p, q] = mirrors(_chosen(a, p), _chosen(b, q))
    close = (gap < 0.01) & (cosines(a.binned(0.1), b.binned(0.1)) > 0.95)
    x, y = np.nonzero(equal | mirror | close)
    return x, y, [np.where(equal[x, y], "T1", np.where(mirror[x, y], "T2", "T3")).tolist()]


def _meet(kernel, binned: bool, names: list[str], kinds: list[pa.DataType]):
    """mapInArrow over pairs of blocks: the ids of the wanted pairs with their values."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                col = {n: batch.column(n)[k] for n in batch.schema.names}
                side = lambda s: Block(*(col[f"{s}_{n}"].as_py() for n in ("at", "sizes", "keys", "values", "codes")), binned)  # noqa: B023, E731
                x, y, values = kernel(side("l"), side("r"), col["l_first"] == col["r_first"])
                if len(x):
                    ids = [col[f"{s}_ids"].values.take(pa.array(v)) for s, v in (("l", x), ("r", y))]
                    yield pa.RecordBatch.from_arrays([*ids, *(pa.array(v, t) for v, t in zip(values, kinds, strict=True))], names)

    return run


def _pairs(left: DataFrame, right: DataFrame, width: float | None) -> DataFrame:
    """Pairs of blocks of one part that come within width of each other. Written without an equality, as the parts are
    few and the rows large: a join by part would shuffle them."""
    l, r = (t.select(*(F.col(c).alias(f"{x}_{c}") for c in t.columns)) for t, x in ((left, "l"), (right, "r")))
    on = (F.col("l_part") <= F.col("r_part")) & (F.col("l_part") >= F.col("r_part"))
    if width is not None:
        w = width + 1e-6
        on &= (F.col("l_lo") <= F.col("r_hi") + w) & (F.col("r_lo") <= F.col("l_hi") + w)
    return l.join(r, on)


def _ids(t: DataFrame) -> str:
    return t.schema["ids"].dataType.elementType.simpleString()


def similar(left: DataFrame, right: DataFrame | None, a: str, b: str, least: float, width: float | None = None, best: int | None = None, entropy: bool = False) -> DataFrame:
    """a, b, cosine [, entropy_similarity] of the pairs of one part, and within width in at, that reach the cosine
    `least`, which is above zero. Without right, the pairs of two spectra of left, each once, the smaller key as a. With
    best, at least the `best` most similar of each a, by cosine rounded to 6 decimals and with all ties."""
    other = left if right is None else right
    met = _pairs(left, other, width)
    if right is None:
        met = met.where("l_first <= r_first")
    more = ["entropy_similarity"] if entropy else []
    kernel = _meet(_similar(least, width, best, entropy, right is None), True, [a, b, "cosine", *more], [pa.float64()] * (1 + len(more)))
    met = met.mapInArrow(kernel, ", ".join([f"{a} {_ids(left)}", f"{b} {_ids(other)}", *(f"{c} double" for c in ("cosine", *more))]))
    return met.withColumns({a: F.least(a, b), b: F.greatest(a, b)}) if right is None else met


def tiers(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """a, b, tier of the pairs in the tiers T1 to T3 of references.identity_tier with precursors (at) within 0.0101;
    blocks with peaks, and peak hashes as codes."""
    kernel = _meet(_tiers, False, [a, b, "tier"], [pa.string()])
    return _pairs(left, right, 0.0101).mapInArrow(kernel, f"{a} {_ids(left)}, {b} {_ids(right)}, tier string")
