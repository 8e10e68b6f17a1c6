"""Evaluation beyond means: strata, pool-size reweighting, missingness, near misses, mass likelihood, matchability,
consensus of structures, list metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# Edges of the pool sizes.
POOL_EDGES = (0, 50, 100, 200, 400, 800)


def pool_bin(size: Column, edges: tuple[int, ...] = POOL_EDGES) -> Column:
    """Index of the last edge that is not above the size."""
    out = F.lit(-1)
    for i, e in enumerate(edges):
        out = F.when(size >= e, i).otherwise(out)
    return out


def stratified(metrics: DataFrame, regime: str, strata: list[str], value: str = "rr") -> DataFrame:
    """Mean of a metric by regime, overall and within each stratum: one pass with grouping sets."""
    sets = [[regime], *([regime, s] for s in strata)]
    cols = [F.col(c) for c in (regime, *strata)]
    out = metrics.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(F.grouping_id().alias("g__"), F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
    # bit of a column is 0 where it is grouped by; columns come in the order regime, strata
    k = len(strata)
    name, level = F.lit("ALL"), F.lit(None).cast("string")
    for i, s in enumerate(strata):
        here = F.col("g__").bitwiseAND(F.lit(1 << (k - 1 - i))) == 0
        name, level = F.when(here, s).otherwise(name), F.when(here, F.col(s).cast("string")).otherwise(level)
    return out.select(regime, name.alias("stratum"), level.alias("level"), "n", "mean")


def reweighted_mean(metrics: DataFrame, target: DataFrame, value: str, bin_col: str) -> DataFrame:
    """Mean of a metric as if the bins had the target's shares, over the bins that both have, with their covered share."""
    m = metrics.groupBy(bin_col).agg(F.avg(value).alias("m"))
    t = target.groupBy(bin_col).agg(F.count(F.lit(1)).alias("n"))
    total = t.agg(F.sum("n").alias("total"))
    j = t.join(m, bin_col, "left").crossJoin(F.broadcast(total))  # one row
    have = F.when(F.col("m").isNotNull(), F.col("n"))
    return j.agg((F.sum(F.col("m") * F.col("n")) / F.sum(have)).alias("mean"), (F.sum(have) / F.max("total")).alias("covered"))


def accounting(features: DataFrame, queries: DataFrame, query: str, truth: str, evidence: str) -> DataFrame:
    """One row of counts over all intended queries: with candidates, with the truth among them, with evidence."""
    per = features.groupBy(query).agg(F.lit(True).alias("c"), F.bool_or(F.coalesce(truth, F.lit(False))).alias("t"), F.bool_or(F.coalesce(truth, F.lit(False)) & F.col(evidence).isNotNull()).alias("e"), F.bool_or(F.col(evidence).isNotNull()).alias("a"))
    j = queries.select(query).distinct().join(per, query, "left")
    yes = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return j.agg(F.count(F.lit(1)).alias("n_queries"), yes("c").alias("with_candidates"), yes("t").alias("truth_in_pool"), yes("e").alias("truth_with_evidence"), yes("a").alias("any_evidence"))


def missingness(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Share of nulls (NaN counts) of each column, of any and of all of them, per value of `by`."""
    kinds = dict(df.dtypes)
    null = {c: F.col(c).isNull() | F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNull() for c in columns}
    any_, all_ = F.lit(False), F.lit(True)
    for x in null.values():
        any_, all_ = any_ | x, all_ & x
    share = lambda x: F.avg(x.cast("double"))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *(share(x).alias(f"null_{c}") for c, x in null.items()), share(any_).alias("null_any"), share(all_).alias("null_all"))


def near_misses(ranked: DataFrame, query: str, key: str, score: str, truth: str) -> DataFrame:
    """Queries whose truth is in the pool but not first: truth and winner side by side with the score gap. One pass."""
    t = F.coalesce(F.col(truth), F.lit(False))
    per = ranked.groupBy(query).agg(
        F.min(F.when(F.col("rank") == 1, F.struct(F.col(key).alias("k"), F.col(score).alias("s"), t.alias("t")))).alias("w"),
        F.min(F.when(t, F.struct(F.col("rank").alias("r"), F.col(key).alias("k"), F.col(score).alias("s")))).alias("x"),
    )
    return per.where(F.col("x").isNotNull() & ~F.col("w.t")).select(query, F.col("x.k").alias("truth"), F.col("x.r").alias("truth_rank"), F.col("w.k").alias("winner"), (F.col("w.s") - F.col("x.s")).alias("score_gap"))


def hard_negatives(df: DataFrame, query: str, key: str, mass: str, spectral: str, truth: str, most: int, seed: int = 0) -> DataFrame:
    """Per query the truth, then hard candidates (mass error in the lowest or similarity in the highest fifth), then
    hashed ones, up to `most`."""
    w = W.partitionBy(query)
    hard = F.coalesce((F.percent_rank().over(w.orderBy(F.col(mass).asc_nulls_last())) <= 0.2) | (F.percent_rank().over(w.orderBy(F.col(spectral).desc_nulls_last())) <= 0.2), F.lit(False))
    p = F.when(F.coalesce(F.col(truth), F.lit(False)), 0).when(F.col("hard__"), 1).otherwise(2)
    rows = df.withColumn("hard__", hard)
    order = w.orderBy(p, F.xxhash64(query, key, F.lit(seed)), key)
    return rows.withColumn("pick__", F.row_number().over(order)).where(F.col("pick__") <= most).withColumn("kind", F.element_at(F.array(F.lit("truth"), F.lit("hard"), F.lit("random")), p + 1)).drop("hard__", "pick__")


def robust_parameters(df: DataFrame, groups: list[str], error: str, min_rows: int, min_scale: float) -> DataFrame:
    """Median and 1.4826 times the median absolute deviation, at least min_scale, of groups with enough rows."""
    m = df.groupBy(*groups).agg(F.median(error).alias("mu"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows)
    j = df.join(m, groups) if groups else df.crossJoin(F.broadcast(m))  # one row
    return j.groupBy(*groups, "mu").agg(F.greatest(F.median(F.abs(F.col(error) - F.col("mu"))) * 1.4826, F.lit(min_scale)).alias("sigma"))


def mass_loglik(df: DataFrame, train: DataFrame, error: str, abs_error: str, instrument: str = "instrument", adduct: str = "adduct", tolerance: float = 50.0, outliers: float = 0.02, min_rows: int = 200, min_scale: float = 0.1) -> DataFrame:
    """df with mass_loglik and mass_level: the log density of an absolute error under a folded normal with a uniform share
    of outliers over the tolerance. Parameters come from instrument and adduct, then instrument, then adduct with enough
    rows, then from all rows; fitting rows beyond the tolerance do not count. Unknown categories are a category."""
    names = {"instrument_adduct": [instrument, adduct], "instrument": [instrument], "adduct": [adduct], "global": []}
    known = lambda t: t.withColumns({f"{c}_k": F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in (instrument, adduct)})
    fit = known(train.where(F.col(error).isNotNull() & ~F.isnan(error) & (F.abs(error) <= tolerance)))
    out, level = known(df), F.lit(None).cast("string")
    mu, sigma = F.lit(None).cast("double"), F.lit(None).cast("double")
    for i, (name, g) in enumerate(names.items()):
        keys = [f"{c}_k" for c in g]
        p = robust_parameters(fit, keys, error, min_rows if g else 0, min_scale).select(*keys, F.col("mu").alias(f"mu{i}__"), F.col("sigma").alias(f"sigma{i}__"))
        out = out.join(p, keys, "left") if g else out.crossJoin(F.broadcast(p))  # one row
        level = F.coalesce(level, F.when(F.col(f"mu{i}__").isNotNull(), name))
        mu, sigma = F.coalesce(mu, F.col(f"mu{i}__")), F.coalesce(sigma, F.col(f"sigma{i}__"))
    bell = lambda z: F.exp(-0.5 * z * z)
    a = F.col(abs_error)
    core = (bell((a - mu) / sigma) + bell((-a - mu) / sigma)) / (sigma * 2.5066282746310002)
    out = out.withColumns({"mass_loglik": F.log((1 - outliers) * core + outliers / tolerance), "mass_level": level})
    return out.drop(*(c for c in out.columns if c.endswith("__") or c.endswith("_k")))


def matchability(stats: DataFrame, molecule: str, best: str) -> DataFrame:
    """Per molecule the greatest, mean and median best similarity of its spectra, with a tier."""
    m = stats.groupBy(molecule).agg(F.count(F.lit(1)).alias("n_spectra"), F.max(best).alias("max_similarity"), F.avg(best).alias("mean_similarity"), F.median(best).alias("median_similarity"))
    x = F.col("max_similarity")
    return m.withColumn("tier", F.when(x >= 0.95, "identical").when(x >= 0.7, "similar").when(x >= 0.4, "weak").otherwise("none"))


def consensus(votes: DataFrame, molecule: str, spectrum: str, key: str, weight: str) -> DataFrame:
    """Per molecule the key most of its spectra vote for (ties: greater weight, then the key), its share, and the share of
    spectra whose own vote is that of the others (leave one out)."""
    c = votes.where(F.col(key).isNotNull()).groupBy(molecule, key).agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"))
    order = W.partitionBy(molecule).orderBy(F.desc("n"), F.desc(F.round("w", 9)), key)
    c = c.withColumns({"r": F.row_number().over(order), "total": F.sum("n").over(W.partitionBy(molecule))})
    # without one of its own votes a key leads if it still has more than the best other
    second = F.max(F.when(F.col("r") == 2, F.col("n"))).over(W.partitionBy(molecule))
    first = F.max(F.when(F.col("r") == 1, F.col("n"))).over(W.partitionBy(molecule))
    rival = F.when(F.col("r") == 1, F.coalesce(second, F.lit(0))).otherwise(first)
    c = c.withColumn("stays", F.col("n") - 1 > rival)
    return c.groupBy(molecule).agg(
        F.min(F.when(F.col("r") == 1, F.struct(F.col(key).alias("k"), F.col("n").alias("n")))).alias("x"), F.max("total").alias("n_votes"), F.count(F.lit(1)).alias("n_keys"), F.sum(F.when(F.col("stays"), F.col("n")).otherwise(0)).alias("loo")
    ).select(molecule, F.col("x.k").alias("modal"), (F.col("x.n") / F.col("n_votes")).alias("modal_share"), "n_votes", "n_keys", (F.col("loo") / F.col("n_votes")).alias("leave_one_out"))


def list_metrics(predictions: Column, truth: Column, k: int = 25) -> dict[str, Column]:
    """Reciprocal rank and hit of a truth in a list that is deduplicated before it is cut."""
    cut = F.slice(F.array_distinct(predictions), 1, k)
    pos = F.coalesce(F.array_position(cut, truth), F.lit(0))
    return {"rr": F.when(pos > 0, 1.0 / pos).otherwise(0.0), "hit": (pos > 0).cast("double")}


def censored_median(values: DataFrame, group: str, count: str, exact: str) -> DataFrame:
    """Median per group with inexact counts as greater than any; null where the median itself is inexact."""
    v = F.when(F.col(exact), F.col(count).cast("double")).otherwise(float("inf"))
    m = values.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.percentile(v, F.lit(0.5)).alias("m"), F.avg(F.col(exact).cast("double")).alias("exact_share"))
    return m.select(group, "n", F.when((F.col("m") < float("inf")) & ~F.isnan("m"), F.col("m")).alias("median"), "exact_share")


def marginal_weights(pool: DataFrame, target: DataFrame, dims: list[str], low: float, high: float) -> DataFrame:
    """pool with weight: the product over the dimensions of the clipped ratio of target to pool share."""
    out, w = pool, F.lit(1.0)
    for i, d in enumerate(dims):
        p = pool.groupBy(F.col(d).alias(f"d{i}__")).agg(F.count(F.lit(1)).alias("np"))
        t = target.groupBy(F.col(d).alias(f"e{i}__")).agg(F.count(F.lit(1)).alias("nt"))
        tot = p.agg(F.sum("np").alias("tp")).crossJoin(t.agg(F.sum("nt").alias("tt")))
        r = p.join(t, F.col(f"d{i}__").eqNullSafe(F.col(f"e{i}__")), "left").crossJoin(F.broadcast(tot))
        r = r.select(f"d{i}__", F.least(F.greatest((F.coalesce("nt", F.lit(0)) / F.col("tt")) / (F.col("np") / F.col("tp")), F.lit(low)), F.lit(high)).alias(f"w{i}__"))
        out = out.join(r, F.col(d).eqNullSafe(F.col(f"d{i}__")), "left")
        w = w * F.col(f"w{i}__")
    out = out.withColumn("weight", w)
    return out.drop(*(c for c in out.columns if c.endswith("__")))


def effective_size(df: DataFrame, weight: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), (F.pow(F.sum(weight), F.lit(2)) / F.sum(F.col(weight) * F.col(weight))).alias("n_effective"))


def pair_dataset(df: DataFrame, key_id: str, truth: str, context: list[str], seed: str) -> DataFrame:
    """anchor, other, kind: for every record one hashed partner of the same structure (positive), and one of another
    structure with the same context (negative). Partners are neighbours in a hashed order, so no group is paired with
    itself in full."""
    from massquarry.operators.statistics import unit_hash

    u = unit_hash(F.col(key_id), seed)
    rows = df.where(F.col(truth).isNotNull()).select(key_id, truth, *context, u.alias("u__"))
    nxt = lambda keys: F.lead(F.struct(F.col(key_id).alias("i"), F.col(truth).alias("t"))).over(W.partitionBy(*keys).orderBy("u__", key_id))
    pos = rows.withColumn("p", nxt([truth])).where(F.col("p").isNotNull()).select(F.col(key_id).alias("anchor"), F.col("p.i").alias("other"), F.lit("positive").alias("kind"))
    neg = rows.withColumn("p", nxt(context)).where(F.col("p").isNotNull() & (F.col("p.t") != F.col(truth))).select(F.col(key_id).alias("anchor"), F.col("p.i").alias("other"), F.lit("negative").alias("kind"))
    return pos.unionByName(neg)
