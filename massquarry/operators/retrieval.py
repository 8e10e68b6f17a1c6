"""Candidate retrieval by mass windows.

A window join is planned as an equi-join on logarithmic mass buckets as wide as the widest window, with the window as a
residual: every library row has one bucket, every query looks into three. Buckets that hold very many rows make skewed
partitions, which adaptive execution splits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from massquarry.workspace import stage


def usable(mass: Column) -> Column:
    return mass.isNotNull() & ~F.isnan(mass) & (mass > 0)


def window_join(queries: DataFrame, library: DataFrame, query_mass: str, mass: str, ppm: float | None = None, ppm_col: str | None = None, max_ppm: float | None = None, da: float | None = None, relative: str = "query") -> DataFrame:
    """All pairs with |mass - query mass| within the tolerance, both ends included, with mass_error_da, mass_error_ppm and
    abs_mass_error_ppm. Exactly one of ppm, ppm_col (with max_ppm) and da; ppm is relative to the query's mass, or with
    relative="candidate" to the candidate's, as first-generation rankings have it.

    Masses that are null, NaN or not positive, and null tolerances, match nothing; a tolerance above max_ppm is an error."""
    if sum(x is not None for x in (ppm, ppm_col, da)) != 1 or (ppm_col is not None and max_ppm is None):
        raise ValueError("give one of ppm, ppm_col with max_ppm, and da")
    q, m = F.col(query_mass), F.col(mass)
    if da is not None:
        bucket = lambda x: F.floor(x / (2.0 * da))
        low, high = q - F.lit(float(da)), q + F.lit(float(da))
    else:
        t = max(ppm if ppm is not None else max_ppm, 1e-6) * 1e-6
        # a window relative to the candidate reaches a little beyond one relative to the query
        width = math.log((1 + t) / (1 - t)) * (1 + t)
        bucket = lambda x: F.floor(F.log(x) / width)
        tol = F.lit(float(ppm)) if ppm is not None else F.col(ppm_col)
        base = m if relative == "candidate" else q
        low, high = q - base * tol * 1e-6, q + base * tol * 1e-6
    left = queries.where(usable(q)).withColumn("b__", F.explode(F.sequence(bucket(q) - 1, bucket(q) + 1)))
    if ppm_col is not None:
        fits = F.when(F.col(ppm_col) <= max_ppm, F.lit(True)).otherwise(F.raise_error(F.lit(f"a tolerance is above max_ppm = {max_ppm}")).cast("boolean"))
        left = left.where(F.col(ppm_col).isNotNull()).where(fits)
    right = library.where(usable(m)).withColumn("c__", bucket(m))
    out = left.join(right, F.col("b__") == F.col("c__")).where((m >= low) & (m <= high)).drop("b__", "c__")
    err = m - q
    ppm_error = err / (m if relative == "candidate" else q) * 1e6
    return out.withColumns({"mass_error_da": err, "mass_error_ppm": ppm_error, "abs_mass_error_ppm": F.abs(ppm_error)})


def nearest_variant(pool: DataFrame, query: str, key: str) -> DataFrame:
    """One row per (query, key): the variant with the least error, with the number of variants in the window."""
    w = W.partitionBy(query, key)
    ranked = pool.withColumn("r__", F.row_number().over(w.orderBy("abs_mass_error_ppm", "mass_variant_id")))
    return ranked.withColumn("n_supporting_variants", F.count(F.lit(1)).over(w)).where("r__ = 1").drop("r__")


def _far_keys(library: DataFrame, key: str, mass: str, n: int) -> DataFrame:
    """The n lightest and the n heaviest keys of every octave of masses: all that can be among the n nearest of a query
    with fewer than n keys within half its mass. Doubles have some 2,000 octaves, so it has at most 4,200 n rows."""
    m = F.col(mass)
    octave = library.where(usable(m)).groupBy(F.floor(F.log2(m)).alias("o__"), key).agg(F.min(m).alias("low__"), F.max(m).alias("high__"))
    ends = [octave.withColumn("r__", F.row_number().over(W.partitionBy("o__").orderBy(by, key))).where(F.col("r__") <= n).select(key, F.col(c).alias(mass)) for by, c in ((F.asc("low__"), "low__"), (F.desc("high__"), "high__"))]
    return ends[0].unionByName(ends[1]).distinct()


def fallback_search(queries: DataFrame, library: DataFrame, query: str, query_mass: str, key: str, mass: str, levels: list[float], nearest: int = 0, widest: float | None = None) -> DataFrame:
    """Window search that widens for the queries without a hit, and at last takes the `nearest` keys; one row per (query,
    key) with its level. The last window doubles for the queries still short of keys, until all have `nearest` or the
    library is exhausted (level infinite); with `widest` it stays at that."""
    out, open_queries = None, stage(queries.where(usable(F.col(query_mass))), "queries")

    def least(hits: DataFrame, level: float) -> DataFrame:
        return hits.groupBy(query, key).agg(F.min("abs_mass_error_ppm").alias("abs_mass_error_ppm")).withColumn("level_ppm", F.lit(float(level)))

    def best(hits: DataFrame) -> DataFrame:
        w = W.partitionBy(query).orderBy("abs_mass_error_ppm", key)
        return hits.withColumn("r__", F.row_number().over(w)).where(F.col("r__") <= nearest).drop("r__")

    def without(hits: DataFrame) -> DataFrame:
        return open_queries.join(hits.select(F.col(query).alias("h__")).distinct(), F.col(query) == F.col("h__"), "left_anti")

    for level in levels:
        hits = stage(least(window_join(open_queries, library, query_mass, mass, ppm=level), level), "level")  # read by the result and by all later levels
        out = hits if out is None else out.unionByName(hits)
        open_queries = without(hits)
    level = widest or 2000.0
    while nearest and level < 1e6:  # beyond it a window has no lower end
        hits = best(least(window_join(open_queries, library, query_mass, mass, ppm=level), level))
        if widest is None:
            hits = hits.withColumn("n__", F.count(F.lit(1)).over(W.partitionBy(query))).where(F.col("n__") >= nearest).drop("n__")
        hits = stage(hits, "level")
        out = hits if out is None else out.unionByName(hits)
        if widest is not None:
            return out
        open_queries = stage(without(hits), "queries")
        if open_queries.isEmpty():
            return out
        level *= 2
    if nearest:
        m, q = F.col(mass), F.col(query_mass)
        rest = open_queries.crossJoin(F.broadcast(_far_keys(library, key, mass, nearest))).withColumn("abs_mass_error_ppm", F.abs((m - q) / q * 1e6))
        hits = best(least(rest, float("inf")))
        out = hits if out is None else out.unionByName(hits)
    return out


def counts_by_tolerance(pool: DataFrame, queries: DataFrame, query: str, truth: str, key: str, grid: list[float]) -> DataFrame:
    """Per query and tolerance of the grid: candidates and whether the truth is among them, from one pool at the widest
    tolerance; queries without candidates count with none."""
    e = F.col("abs_mass_error_ppm")
    hit = F.col(key) == F.col(truth)
    sums = [F.sum((e <= t).cast("int")).alias(f"n{i}") for i, t in enumerate(grid)] + [F.max((hit & (e <= t)).cast("int")).alias(f"t{i}") for i, t in enumerate(grid)]
    per = pool.groupBy(query).agg(*sums)
    both = queries.select(query).join(per, query, "left")
    cells = F.explode(F.array(*(F.struct(F.lit(float(t)).alias("tolerance_ppm"), F.coalesce(f"n{i}", F.lit(0)).alias("candidate_count"), F.coalesce(f"t{i}", F.lit(0)).alias("found")) for i, t in enumerate(grid))))
    return both.select(query, cells.alias("c")).select(query, "c.*")


def tolerance_sweep(counts: DataFrame) -> DataFrame:
    """Per tolerance: mean and percentiles of the candidate count, share of empty pools, recall over all queries."""
    c = F.col("candidate_count")
    return counts.groupBy("tolerance_ppm").agg(
        F.avg(c).alias("mean_candidates"), *(F.percentile(c, F.lit(p / 100)).alias(f"p{p}_candidates") for p in (50, 75, 90, 95, 99)), F.max(c).alias("max_candidates"),
        F.avg((c == 0).cast("double")).alias("zero_rate"), F.avg("found").alias("candidate_recall"),
    )


def tradeoff(sweep: DataFrame) -> DataFrame:
    """What each step to the next tolerance costs and gains. The sweep has one row per grid value."""
    w = W.orderBy("tolerance_ppm")
    return sweep.select(
        "tolerance_ppm", "candidate_recall", "mean_candidates", (F.col("candidate_recall") - F.lag("candidate_recall").over(w)).alias("delta_recall"),
        (F.col("mean_candidates") - F.lag("mean_candidates").over(w)).alias("delta_candidates"),
    )


def select_tolerance(sweep: DataFrame, target: float) -> DataFrame:
    """The smallest tolerance that reaches the target recall, else the one of the highest recall."""
    ok = F.col("candidate_recall") >= target
    return sweep.orderBy(F.desc(ok), F.when(ok, F.col("tolerance_ppm")), F.desc("candidate_recall"), "tolerance_ppm").limit(1)


def fit_windows(errors: DataFrame, groups: list[str], error: str, quantile: float, low: float, high: float, min_rows: int) -> DataFrame:
    """Per group the quantile of the error, within [low, high]; groups with few rows get none (see apply_windows)."""
    e = F.percentile(F.col(error), F.lit(quantile))
    return errors.where(F.col(error).isNotNull()).groupBy(*groups).agg(F.count(F.lit(1)).alias("n_fit"), F.least(F.greatest(e, F.lit(low)), F.lit(high)).alias("window_ppm")).where(F.col("n_fit") >= min_rows)


def apply_windows(df: DataFrame, policy: DataFrame, groups: list[str], fallback: float) -> DataFrame:
    """df with window_ppm: that of its group, null-safely, or the fallback."""
    p = policy.select(*(F.col(g).alias(f"{g}__") for g in groups), "window_ppm")
    on = None
    for g in groups:
        c = F.col(g).eqNullSafe(F.col(f"{g}__"))
        on = c if on is None else on & c
    return df.join(p, on, "left").withColumn("window_ppm", F.coalesce("window_ppm", F.lit(float(fallback)))).drop(*(f"{g}__" for g in groups))
