"""Ranking and evaluation. Metrics always count over the full list of intended queries: a query without candidates, or
whose truth is not among them, contributes zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

KS = (1, 5, 25)


def _ordered(keys: list[tuple[str, bool]]) -> list[Column]:
    out = []
    for c, up in keys:
        out.append(F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last())
    return out


def rank_by_keys(df: DataFrame, keys: list[tuple[str, bool]], query: str = "query_id") -> DataFrame:
    """rank from 1 per query by (column, ascending) keys; nulls last either way, NaN as null. The last key should be unique."""
    nan = {c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float") and c in dict(keys)}
    return df.withColumns(nan).withColumn("rank", F.row_number().over(W.partitionBy(query).orderBy(*_ordered(keys)))) if nan else df.withColumn("rank", F.row_number().over(W.partitionBy(query).orderBy(*_ordered(keys))))


def per_query_metrics(ranked: DataFrame, queries: DataFrame, query: str = "query_id", truth: str = "is_true_candidate", k: int = 25) -> DataFrame:
    """n_candidates, truth_rank, rr and hit_at_k of every intended query."""
    is_true = F.coalesce(F.col(truth).cast("boolean"), F.lit(False))
    per = ranked.groupBy(query).agg(F.count(F.lit(1)).alias("n"), F.min(F.when(is_true, F.col("rank"))).alias("truth_rank"))
    r = F.col("truth_rank")
    out = queries.select(query).distinct().join(per, query, "left")
    return out.select(
        query, F.coalesce("n", F.lit(0)).alias("n_candidates"), "truth_rank", F.when(r <= k, 1.0 / r).otherwise(0.0).alias("rr"),
        *(F.when(r <= x, 1.0).otherwise(0.0).alias(f"hit_at_{x}") for x in KS),
    )


def summarise(metrics: DataFrame, groups: list[str] | None = None, min_rows: int = 0) -> DataFrame:
    """Means of the per-query metrics, with a flag for groups of few queries."""
    out = metrics.groupBy(*(groups or [])).agg(
        F.count(F.lit(1)).alias("n_queries"), F.avg("rr").alias("mrr"), *(F.avg(f"hit_at_{x}").alias(f"hit_at_{x}") for x in KS), F.avg("n_candidates").alias("mean_candidates")
    )
    return out.withColumn("low_support", F.col("n_queries") < min_rows)


def expected_rr(low: Column, high: Column, k: int) -> Column:
    """Mean of 1/r over the ranks low..high, zero beyond k."""
    s = F.aggregate(F.sequence(low, F.least(high, F.lit(k))), F.lit(0.0), lambda a, r: a + 1.0 / r)
    return F.when(low.isNull(), 0.0).when(low > k, 0.0).otherwise(s / (high - low + 1))


def expected_tie_metrics(df: DataFrame, score: str, queries: DataFrame, query: str = "query_id", truth: str = "is_true_candidate", higher: bool = True, k: int = 25) -> DataFrame:
    """Expected metrics where equal scores are in random order; null and NaN scores are one block after all others."""
    s = F.when(F.col(score).isNotNull() & ~F.isnan(score), F.col(score) if higher else -F.col(score)).otherwise(float("-inf"))
    w = W.partitionBy(query)
    d = df.withColumn("s__", s).withColumn("lo", F.rank().over(w.orderBy(F.desc("s__"))))
    d = d.withColumn("hi", (F.col("lo") + F.count(F.lit(1)).over(W.partitionBy(query, "s__")) - 1).cast("int"))
    t = F.coalesce(F.col(truth), F.lit(False))
    per = d.groupBy(query).agg(F.count(F.lit(1)).alias("n"), F.min(F.when(t, F.struct("lo", "hi"))).alias("b"))
    lo, hi = F.col("b.lo"), F.col("b.hi")
    hit = lambda x: F.when(lo.isNull(), 0.0).otherwise(F.greatest(F.lit(0), F.least(F.lit(x), hi) - lo + 1) / (hi - lo + 1).cast("double"))
    return queries.select(query).distinct().join(per, query, "left").select(
        query, F.coalesce("n", F.lit(0)).alias("n_candidates"), lo.alias("truth_rank_min"), hi.alias("truth_rank_max"), expected_rr(lo, hi, k).alias("rr"), *(hit(x).alias(f"hit_at_{x}") for x in KS)
    )


def softmax(df: DataFrame, score: str, group: str, temperature: float = 1.0) -> DataFrame:
    """prob: the stable softmax of score / temperature within the group; null and NaN scores get none."""
    z = F.when(~F.isnan(score), F.col(score)) / temperature
    w = W.partitionBy(group)
    e = F.exp(z - F.max(z).over(w))
    return df.withColumn("e__", e).withColumn("prob", F.col("e__") / F.sum("e__").over(w)).drop("e__")


def fuse(df: DataFrame, mass: str, spectral: str, alpha: float, group: str | None = None) -> DataFrame:
    """fused: alpha * z(mass) + (1 - alpha) * z(spectral), population z-scores, over the group or over all rows."""
    if group:
        w = W.partitionBy(group)
        z = lambda c: F.coalesce((F.col(c) - F.avg(c).over(w)) / F.nullif(F.stddev_pop(c).over(w), F.lit(0.0)), F.lit(0.0))
        return df.withColumn("fused", alpha * z(mass) + (1 - alpha) * z(spectral))
    stats = df.agg(*(f(c).alias(f"{n}{i}__") for i, c in enumerate((mass, spectral)) for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    z = lambda c, i: F.coalesce((F.col(c) - F.col(f"m{i}__")) / F.nullif(F.col(f"s{i}__"), F.lit(0.0)), F.lit(0.0))
    out = df.crossJoin(F.broadcast(stats))  # one row
    return out.withColumn("fused", alpha * z(mass, 0) + (1 - alpha) * z(spectral, 1)).drop("m0__", "s0__", "m1__", "s1__")


def rank_sum(df: DataFrame, scores: list[str], query: str, key: str) -> DataFrame:
    """Candidates re-ranked by the sum of their ranks under several scores."""
    total = None
    for i, c in enumerate(scores):
        df = df.withColumn(f"r{i}__", F.row_number().over(W.partitionBy(query).orderBy(F.col(c).desc_nulls_last(), key)))
        total = F.col(f"r{i}__") if total is None else total + F.col(f"r{i}__")
    out = df.withColumn("rank_sum", total).drop(*(f"r{i}__" for i in range(len(scores))))
    return out.withColumn("rank", F.row_number().over(W.partitionBy(query).orderBy("rank_sum", key)))


def failure_reason(error: Column, supported: Column, in_library: Column, tolerance: float, near: float) -> Column:
    """First reason that applies why a query's truth is not within the tolerance; null where it is."""
    return (
        F.when(F.coalesce(error <= tolerance, F.lit(False)), F.lit(None).cast("string")).when(~F.coalesce(supported, F.lit(False)), "unsupported_adduct")
        .when(~F.coalesce(in_library, F.lit(False)), "truth_not_in_library").when(error.isNull(), "no_mass").when(error <= near, "just_outside").otherwise("far_outside")
    )


def calibration_table(df: DataFrame, prob: str, truth: str, bins: int = 10) -> DataFrame:
    """Reliability per probability bin; df holds one row per decision, such as each spectrum's best candidate."""
    b = F.least(F.floor(F.col(prob) * bins), F.lit(bins - 1)).cast("int")
    return df.where(F.col(prob).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(prob).alias("mean_confidence"), F.avg(F.col(truth).cast("double")).alias("accuracy"))


def calibration_report(df: DataFrame, prob: str, query: str, truth: str, key: str, bins: int = 10) -> DataFrame:
    """One row: negative log-likelihood of the truths, Brier score summed over a query's candidates, and of the queries'
    best candidates (ties: the smaller key) the Brier score and the expected calibration error."""
    p, t = F.col(prob), F.coalesce(F.col(truth).cast("double"), F.lit(0.0))
    best = F.min_by(F.struct(p.alias("p"), t.alias("t")), F.struct((-p).alias("a"), F.col(key).alias("b")))
    per = df.where(p.isNotNull()).groupBy(query).agg(F.sum(F.pow(p - t, F.lit(2))).alias("brier"), best.alias("top"), F.sum(F.when(t > 0, -F.log(F.greatest(p, F.lit(1e-300))))).alias("nll"), F.count_if(t > 0).alias("truths"))
    per = per.select("brier", "nll", "truths", "top.p", "top.t")
    whole = per.agg(F.count(F.lit(1)).alias("n_spectra"), (F.sum("nll") / F.sum("truths")).alias("nll"), F.avg("brier").alias("brier"), F.avg(F.pow(F.col("p") - F.col("t"), F.lit(2))).alias("brier_top1"))
    table = calibration_table(per, "p", "t", bins)
    return whole.crossJoin(F.broadcast(table.agg((F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("mean_confidence"))) / F.sum("n")).alias("ece_top1"))))  # one row


def fit_temperature(df: DataFrame, score: str, query: str, truth: str, low: float = -3.0, high: float = 3.0, steps: int = 3, points: int = 13) -> float:
    """Temperature of least negative log-likelihood of the truths: a grid over log T, refined around its best point; each
    refinement is one pass over the data."""
    z = F.when(~F.isnan(score), F.col(score))
    d = df.select(query, z.alias("z"), F.coalesce(F.col(truth), F.lit(False)).alias("t")).where(F.col("z").isNotNull())
    d = d.withColumn("z", F.col("z") - F.max("z").over(W.partitionBy(query)))
    best = 0.0
    for _ in range(steps):
        grid = [low + (high - low) * i / (points - 1) for i in range(points)]
        sums = d.groupBy(query).agg(F.max(F.when(F.col("t"), F.col("z"))).alias("zt"), *(F.sum(F.exp(F.col("z") / 2.718281828459045**g)).alias(f"s{i}") for i, g in enumerate(grid)))
        row = sums.where(F.col("zt").isNotNull()).agg(*(F.sum(F.log(f"s{i}") - F.col("zt") / 2.718281828459045**g).alias(f"n{i}") for i, g in enumerate(grid))).first()
        nll = [x if x is not None else 0.0 for x in row]
        i = min(range(points), key=lambda j: nll[j])
        best, step = grid[i], (high - low) / (points - 1)
        low, high = best - step, best + step
    return 2.718281828459045**best
