import math
import random

import numpy as np
import pyarrow as pa

from massquarry.llm import quantiles as Q

SHARES = {"p1": 0.01, "p50": 0.5, "p99": 0.99}


def worst(values, answers, shares):
    v, out = np.sort(values), 0.0
    for s, c in zip(shares, answers, strict=True):
        tol = abs(c) * 2.0**-11
        rank = max(1, math.ceil(s * len(v)))
        lo, hi = np.searchsorted(v, c - tol, "left") + 1, np.searchsorted(v, c + tol, "right")
        out = max(out, lo - rank, rank - hi)
    return out / len(v)


def test_universe_keeps_order():
    v = np.sort(np.concatenate([-np.logspace(-300, 300, 500), [0.0, -0.0], np.logspace(-300, 300, 500)]))
    x = Q.quantised(v)
    assert (np.diff(x) >= 0).all() and x.min() >= 0 and x.max() < 1 << Q.BITS
    assert np.allclose(Q.value_of(Q.quantised(np.array([3.7, -12.25, 1e9]))), [3.7, -12.25, 1e9], rtol=3e-4)


def test_compress_keeps_counts_and_shrinks():
    r = np.random.default_rng(0)
    x = Q.quantised(r.normal(size=50_000)) + (1 << Q.BITS)
    g, node, count = Q.compress(np.zeros(len(x), np.int64), x, np.ones(len(x), np.int64), np.array([math.floor(0.01 * len(x) / Q.BITS)]))
    assert count.sum() == 50_000 and len(node) < 3 * Q.BITS / 0.01


def test_a_wide_node_answers_with_its_end():
    """Values that moved up early must not pull an answer below values that were counted before it."""
    r = np.random.default_rng(2)
    x = np.concatenate([r.uniform(1, 2, 30_000), r.uniform(-1e6, 1e6, 3_000)])
    node = Q.quantised(x) + (1 << Q.BITS)
    thr = np.array([math.floor(0.02 * len(x) / Q.BITS)])
    g, node, count = Q.compress(np.zeros(len(x), np.int64), node, np.ones(len(x), np.int64), thr)
    assert count[np.frexp(node.astype(float))[1] - 1 < Q.BITS].max() < thr[0]
    shares = [k / 200 for k in range(1, 200)]
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(node)), pa.array(node), pa.array(count), pa.array([len(x)] * len(node))], ["g", "node", "count", "total"])
    (out,) = Q._answers(["g"], shares)([batch])
    assert worst(x, [out.column(2 + k)[0].as_py() for k in range(len(shares))], shares) <= 0.02


def test_a_task_gives_out_few_nodes_and_keeps_the_bound():
    """A million values of one group through one task, in small batches, beside many small groups."""
    r = np.random.default_rng(1)
    v = np.concatenate([r.normal(0, 5, 900_000), r.standard_cauchy(100_000) * 100])
    r.shuffle(v)
    g = np.where(r.random(len(v)) < 0.9, -1, r.integers(0, 20_000, len(v)))
    batches = [pa.RecordBatch.from_arrays([pa.array(g[s : s + 10_000]), pa.array(v[s : s + 10_000])], ["g", "value__"]) for s in range(0, len(v), 10_000)]
    error = 0.01
    out = pa.Table.from_batches(Q._partial(["g"], error)(iter(batches))).to_pandas()
    assert out["count"].sum() == len(v)
    hot = out[out.g == -1]
    assert len(hot) <= 3 * Q.BITS / error * max(1, hot.node.duplicated().sum() + 1) and len(hot) < 60_000 < (g == -1).sum()
    total = np.array([float((g == -1).sum())])
    n, x, c = Q.compress(np.zeros(len(hot), np.int64), hot.node.to_numpy(), hot["count"].to_numpy(), np.floor(error * total / Q.BITS))
    assert len(x) <= 3 * Q.BITS / error
    batch = pa.RecordBatch.from_arrays([pa.array([-1] * len(x)), pa.array(x), pa.array(c), pa.array([int(total[0])] * len(x))], ["g", "node", "count", "total"])
    shares = [0.001, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999]
    (got,) = Q._answers(["g"], shares)([batch])
    assert worst(v[g == -1], [got.column(2 + k)[0].as_py() for k in range(len(shares))], shares) <= error


def test_error_bound_of_days_and_of_their_sum(spark):
    r, rows = random.Random(3), []
    for k in range(60_000):
        rows.append(("hot" if r.random() < 0.4 else r.choice("abc"), k % 3, r.gauss(0, 5) if r.random() < 0.95 else r.gauss(0, 1) * 300))
    rows += [("a", 1, None), ("a", 1, float("nan")), ("a", 1, float("inf")), (None, 0, 2.5), (None, 0, 2.5), ("none", 0, None)]
    df = spark.createDataFrame(rows, "g string, day int, v double").repartition(6)
    days = Q.digests(df, ["g", "day"], "v", 0.02)
    ok = [(g, d, v) for g, d, v in rows if v is not None and math.isfinite(v)]
    for nodes, keys, bound in ((days, ["g", "day"], 0.02), (Q.merge(days, ["g"], 0.02), ["g"], 0.02)):
        got = Q.percentiles(nodes, keys, SHARES).collect()
        groups = {}
        for g, d, v in ok:
            groups.setdefault((g, d)[: len(keys)], []).append(v)
        assert {tuple(x[k] for k in keys) for x in got} == set(groups)
        for x in got:
            v = groups[tuple(x[k] for k in keys)]
            assert x.n == len(v) and worst(v, [x.p1, x.p50, x.p99], SHARES.values()) <= bound + 1 / len(v)
    assert Q.merge(days, ["g"], 0.02).where("g = 'hot'").count() < 6 * Q.BITS / 0.02


def test_empty(spark):
    e = spark.createDataFrame([], "g string, v double")
    assert Q.percentiles(Q.digests(e, ["g"], "v"), ["g"], SHARES).count() == 0
