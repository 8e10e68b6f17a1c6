"""Same or near-same records across splits, by a compressed full-text index of evaluation shards.

A spectrum is written as the text of its bins in ascending order. The evaluation texts of one band of precursor values
form a shard, whose FM-index is built once: the Burrows-Wheeler transform as a wavelet matrix (bit planes with rank), and
a sample of the suffixes' texts, from which backward steps find the others. The training texts of the same band stream
through backward search.

Searches start at a training text's strongest bins, as many as hold `reach` of its squared length, and extend to the left
as long as any evaluation text goes on, so each gives the maximal matches that end there. The matches of two records are
merged into spans; the squared length of the starting bins that no span covers is not shared, and where it exceeds
1 - above^2 the cosine cannot be above `above`. An exact comparison decides on the rest. No pair is lost: a pair above
`above` shares more than above^2 of either's squared length, so it shares some of the starting bins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from massquarry.llm.vectors import as_binary, binned, from_binary


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.uint32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w].astype(np.int64) + np.bitwise_count(self.words[w] & low)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) > 0


class Wavelet:
    """Symbols 0 .. 2**depth - 1 as bit planes, the highest first; each plane is ordered by the planes before it."""

    def __init__(self, x: np.ndarray, symbols: int):
        self.depth = max(1, int(symbols - 1).bit_length())
        self.planes, self.zeros = [], []
        now = x
        for b in range(self.depth - 1, -1, -1):
            bit = (now >> b & 1).astype(bool)
            self.planes.append(Bits(bit))
            self.zeros.append(int((~bit).sum()))
            now = np.concatenate([now[~bit], now[bit]])
        # where each symbol begins in the last order
        self.start = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (p, z) in enumerate(zip(self.planes, self.zeros, strict=True)):
            one = p.rank(i)
            i = np.where(symbol >> (self.depth - 1 - k) & 1, z + one, i - one)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._down(symbol, i) - self.start[symbol]

    def at(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its occurrences before it."""
        symbol = np.zeros(len(i), np.int64)
        for p, z in zip(self.planes, self.zeros, strict=True):
            bit, one = p[i], p.rank(i)
            symbol = symbol << 1 | bit
            i = np.where(bit, z + one, i - one)
        return symbol, i - self.start[symbol]


class FMIndex:
    """Index of texts over integer symbols of any size."""

    def __init__(self, offsets: np.ndarray, symbols: np.ndarray, sample: int = 4):
        n = len(offsets) - 1
        self.alphabet, code = np.unique(symbols, return_inverse=True)
        size = np.diff(offsets)
        # each text ends with 0, which sorts first
        text = np.zeros(len(symbols) + n, np.int64)
        owner = np.repeat(np.arange(n), size + 1)
        within = np.arange(len(text)) - np.repeat(offsets[:-1] + np.arange(n), size + 1)
        text[within < size[owner]] = code + 1
        sa = self._suffixes(text)
        self.n = len(text)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.alphabet) + 1))])
        self.bwt = Wavelet(text[sa - 1], len(self.alphabet) + 1)
        kept = within[sa] % sample == 0  # every text's first symbol among them, so no walk leaves its text
        self.kept, self.owner = Bits(kept), owner[sa[kept]].astype(np.int32)

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffix array by doubling."""
        n = len(text)
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        step = 1
        while True:
            second = np.full(n, -1, np.int64)
            second[: n - step] = rank[step:]
            sa = np.lexsort((second, rank))
            new = np.empty(n, np.int64)
            differs = (rank[sa[1:]] != rank[sa[:-1]]) | (second[sa[1:]] != second[sa[:-1]])
            new[sa] = np.concatenate([[0], np.cumsum(differs)])
            rank = new
            if rank[sa[-1]] == n - 1 or step >= n:
                return sa
            step *= 2

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        """The index's numbers of the symbols, 0 for those that no text holds."""
        if not len(self.alphabet):
            return np.zeros(len(symbols), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, symbols), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == symbols, at + 1, 0)

    def extend(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the suffixes that continue with a symbol in front; one step of backward search for many."""
        return self.smaller[code] + self.bwt.rank(code, lo), self.smaller[code] + self.bwt.rank(code, hi)

    def locate(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """match, text: the texts in which each interval's suffixes lie."""
        size = hi - lo
        match = np.repeat(np.arange(len(lo)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
        open_ = np.flatnonzero(~self.kept[at])
        while len(open_):
            symbol, before = self.bwt.at(at[open_])
            at[open_] = self.smaller[symbol] + before
            open_ = open_[~self.kept[at[open_]]]
        return match, self.owner[self.kept.rank(at)].astype(np.int64)

    def matches(self, offsets: np.ndarray, symbols: np.ndarray, ends: np.ndarray):
        """start (position in ends), length, lo, hi: by backward search from each of the positions `ends` of the query
        texts' symbols, the interval of every length up to the longest that any text holds."""
        code = self.codes(symbols)
        first = np.repeat(offsets[:-1], np.diff(offsets))[ends]
        live = np.arange(len(ends))
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64)
        length, out = 0, []
        while len(live):
            at = ends[live] - length
            ok = at >= first[live]
            ok[ok] = code[at[ok]] > 0
            live, lo, hi = live[ok], lo[ok], hi[ok]
            lo, hi = self.extend(code[ends[live] - length], lo, hi)
            live, lo, hi = live[hi > lo], lo[hi > lo], hi[hi > lo]
            length += 1
            out.append((live, np.full(len(live), length), lo, hi))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4


def merged(query: np.ndarray, text: np.ndarray, end: np.ndarray, length: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """pair's query and text, then the spans: pair (position), first and last symbol. Matches of a pair that touch or
    overlap are one span."""
    pair = query * texts + text
    begin = end - length + 1
    order = np.lexsort((-length, end, pair))
    pair, begin, end = pair[order], begin[order], end[order]
    longest = np.ones(len(pair), bool)
    longest[1:] = (pair[1:] != pair[:-1]) | (end[1:] != end[:-1])
    pair, begin, end = pair[longest], begin[longest], end[longest]
    u, which = np.unique(pair, return_inverse=True)
    # within a pair ends ascend; a span goes on while the next match begins at or before its end
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (begin[1:] > end[:-1] + 1)
    at = np.flatnonzero(new)
    last = end[np.append(at[1:], len(pair)) - 1] if len(pair) else end
    start = np.minimum.reduceat(begin, at) if len(pair) else begin
    return u // texts, u % texts, which[at], start, last


def starting(off: np.ndarray, w: np.ndarray, reach: float) -> np.ndarray:
    """Positions of each vector's strongest bins, as many as hold more than `reach` of its squared length."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    order = np.lexsort((-w, row))
    mass = w[order] ** 2
    run = np.cumsum(mass)
    before = run - mass - np.repeat((run - mass)[off[:-1]], np.diff(off))
    return np.sort(order[before <= reach])


def _rows(width: float):
    """mapInArrow: id, near (precursor), vector of usable rows."""

    def run(batches):
        for b in batches:
            rows, off, bins, w = binned(b.column("mz"), b.column("i"), width)
            keep = b.select(["id", "near"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*keep.columns, as_binary(off, bins, w)], ["id", "near", "vector"])

    return run


def _cosines(qo, qb, qw, to, tb, tw, qi, ti, chunk: int = 20_000) -> np.ndarray:
    """Cosine of vector qi of one set with vector ti of another, for many pairs."""
    out = np.zeros(len(qi))
    if not len(qi):
        return out
    top = int(max(qb.max(initial=0), tb.max(initial=0))) + 1
    t_row = np.repeat(np.arange(len(to) - 1), np.diff(to))
    place = t_row * top + tb
    for s in range(0, len(qi), chunk):
        q, t = qi[s : s + chunk], ti[s : s + chunk]
        size = qo[q + 1] - qo[q]
        pair = np.repeat(np.arange(len(q)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(qo[q], size)
        want = t[pair] * top + qb[at]
        k = np.minimum(np.searchsorted(place, want), len(place) - 1)
        same = place[k] == want
        out[s : s + chunk] = np.bincount(pair[same], qw[at[same]] * tw[k[same]], minlength=len(q))
    return out


def _match(above: float, apart: float, reach: float, batch: int = 1_000):
    """mapInArrow over rows sorted by shard, evaluation rows first: training rows stream through the shard's index."""
    # rounding to six decimals lets a cosine slightly below `above` count
    unshared = 1 - (above - 1e-6) ** 2 + 1e-9
    reach = max(reach, unshared)

    def run(batches):
        shard, index, test, ids, near = None, None, None, None, None
        gather: list = []
        stream: list = []

        def build():
            off, bins, w = from_binary([r[2] for r in gather])
            return FMIndex(off, bins), (off, bins, w), [r[0] for r in gather], np.array([r[1] for r in gather])

        def search():
            off, bins, w = from_binary([r[2] for r in stream])
            p = np.array([r[1] for r in stream])
            row = np.repeat(np.arange(len(stream)), np.diff(off))
            ends = starting(off, w, reach)
            start, length, lo, hi = index.matches(off, bins, ends)
            q, text, end, long = [], [], [], []
            for s in range(0, len(lo), 50_000):  # located in portions, as one bin may stand in very many texts
                part = slice(s, s + 50_000)
                match, t = index.locate(lo[part], hi[part])
                e = ends[start[part][match]]
                close = np.abs(p[row[e]] - near[t]) < apart
                q.append(row[e][close])
                text.append(t[close])
                end.append(e[close])
                long.append(length[part][match][close])
            cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            q, text, pair, first, last = merged(cat(q), cat(text), cat(end), cat(long), len(ids))
            # squared length of the starting bins in all and under the spans
            mass = np.zeros(len(bins) + 1)
            mass[ends + 1] = w[ends] ** 2
            mass = np.cumsum(mass)
            covered = np.bincount(pair, mass[last + 1] - mass[first], minlength=len(q))
            symbols = np.bincount(pair, last + 1 - first, minlength=len(q)).astype(np.int64)
            may = mass[off[q + 1]] - mass[off[q]] - covered <= unshared
            q, text, symbols = q[may], text[may], symbols[may]
            s = np.round(_cosines(off, bins, w, *test, q, text), 6)
            ok = s > above
            q, text, s = q[ok], text[ok], s[ok]
            return pa.RecordBatch.from_arrays([pa.array([ids[t] for t in text], pa.string()), pa.array([stream[i][0] for i in q], pa.string()), pa.array(s, pa.float64()), pa.array(symbols[ok], pa.int64())], ["eval_id", "train_id", "similarity", "matched"])

        for b in batches:
            for g, is_train, i, p, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if g != shard:
                    if stream:
                        yield search()
                    shard, index, gather, stream = g, None, [], []
                if not is_train:
                    gather.append((i, p, v))
                elif gather:
                    if index is None:
                        index, test, ids, near = build()
                    stream.append((i, p, v))
                    if len(stream) >= batch:
                        yield search()
                        stream = []
        if stream:
            yield search()

    return run


def near_same(evaluation: DataFrame, training: DataFrame, eval_id: str, train_id: str, mz: str, intensity: str, near: str, above: float = 0.95, apart: float = 0.01, reach: float = 0.25, width: float = 0.1, shard: int = 20_000) -> DataFrame:
    """eval_id, train_id (both as strings), similarity, matched (symbols under the merged spans): all pairs of usable
    spectra with a cosine above `above` whose `near` values differ by less than `apart`.

    Rows that are not usable or whose near value is null, NaN or infinite match nothing; repeated rows count once; ids
    that are null are left out; extra columns are ignored; empty tables give an empty result. A shard is a band of the
    near value, and evaluation rows close to a border stand in both bands. A band with more than `shard` rows of a side
    is cut: its evaluation rows into several indexes, its training rows into several streams, each stream passing each
    index. `reach` only moves work between the search and the exact comparison.
    """
    if not 0 <= above < 1:
        raise ValueError("above must be at least 0 and below 1")
    band_width = 100 * apart

    def band(x: Column) -> Column:
        # from 1e15 on, doubles that differ differ by more than `apart`
        return F.when(F.abs(x) < 1e15 * apart, F.floor(x / band_width)).otherwise(F.xxhash64(x))

    def usable(t: DataFrame, i: str) -> DataFrame:
        cols = (F.col(i).cast("string").alias("id"), F.col(near).cast("double").alias("near"), F.col(mz).cast("array<double>").alias("mz"), F.col(intensity).cast("array<double>").alias("i"))
        return t.select(*cols).where(F.col("id").isNotNull() & F.col("near").isNotNull() & ~F.isnan("near") & (F.abs("near") < float("inf")))

    n = F.col("near")
    ev, tr = usable(evaluation, eval_id), usable(training, train_id)
    # large bands only, by a scan of the near values
    cuts = lambda t, name: t.groupBy(band(n).alias(f"h_{name}")).agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias(name)).where(F.col(name) > 1)
    ec, tc = cuts(ev, "ec"), cuts(tr, "tc")
    vectors = lambda t: t.mapInArrow(_rows(width), "id string, near double, vector binary")
    ev = vectors(ev).withColumn("band", F.explode(F.array_distinct(F.array(band(n - apart), band(n), band(n + apart)))))
    tr = vectors(tr).withColumn("band", band(n))
    one = lambda t: t.join(ec, F.col("band") == F.col("h_ec"), "left").join(tc, F.col("band") == F.col("h_tc"), "left").fillna(1, ["ec", "tc"])
    part = lambda x: F.pmod(F.xxhash64("id"), F.col(x)).cast("int")
    every = lambda x: F.explode(F.sequence(F.lit(0), F.col(x) - 1))
    ev = one(ev).withColumn("a", part("ec")).withColumn("b", every("tc")).withColumn("train", F.lit(False))
    tr = one(tr).withColumn("b", part("tc")).withColumn("a", every("ec")).withColumn("train", F.lit(True))
    cols = [F.struct("band", "a", "b").alias("shard"), "train", "id", "near", "vector"]
    both = ev.select(*cols).unionByName(tr.select(*cols))
    both = both.repartition("shard").sortWithinPartitions("shard", "train")
    found = both.mapInArrow(_match(above, apart, reach), "eval_id string, train_id string, similarity double, matched long")
    return found.dropDuplicates(["eval_id", "train_id"])
