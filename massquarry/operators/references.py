"""Reference spectra of a candidate: compatibility order, eligibility protocols, the walk, counts and pair features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from massquarry.functions.kernels import mirror_kernel

MOST = 5
METRICS = ("cosine", "modified_cosine", "peak_overlap", "loss_cosine")


def compatibility() -> list[Column]:
    """Sort keys: same adduct, same mode, comparable energies, their distance, same instrument, reference id. Columns are
    q_ and r_ adduct, mode, ce, ce_unit, instrument and r_id; what is unknown is never the same."""
    same = lambda c: F.when(F.coalesce(F.col(f"q_{c}") == F.col(f"r_{c}"), F.lit(False)), 0).otherwise(1)
    known = F.coalesce((F.col("q_ce_unit") == F.col("r_ce_unit")) & F.col("q_ce").isNotNull() & F.col("r_ce").isNotNull(), F.lit(False))
    return [same("adduct"), same("mode"), F.when(known, 0).otherwise(1), F.when(known, F.abs(F.col("q_ce") - F.col("r_ce"))).otherwise(float("inf")), same("instrument"), F.col("r_id")]


def protocols() -> dict[str, Column]:
    """Eligibility under each protocol from q_source, r_source (unknown sources are equal to each other) and tier."""
    other = ~F.col("q_source").eqNullSafe(F.col("r_source"))
    tier = F.coalesce(F.col("tier"), F.lit(""))
    mirror = tier.isin("T1", "T2")
    return {
        "standard": F.lit(True), "cross_library": other, "mirror_aware": other & ~mirror, "near_dup_strict": other & ~tier.isin("T1", "T2", "T3"),
        "test_simulated_strict": ~mirror, "test_simulated_relaxed": tier != "T1",
    }


def walk(pairs: DataFrame, pair: list[str], names: tuple[str, ...] = ("standard", "cross_library", "mirror_aware", "near_dup_strict"), most: int = MOST) -> DataFrame:
    """pairs in compatibility order with compat_rank, accepted_<protocol>, and whether the walk reached the row: it stops
    as soon as every protocol has `most` references. One sort serves all protocols."""
    rules = protocols()
    w = W.partitionBy(*pair).orderBy(*compatibility())
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    out = pairs.withColumns({f"eligible_{n}": rules[n] for n in names})
    out = out.withColumn("compat_rank", F.row_number().over(w)).withColumns({f"n_{n}": F.sum(F.col(f"eligible_{n}").cast("int")).over(upto) for n in names})
    full = None
    for n in names:
        done = F.col(f"n_{n}") - F.col(f"eligible_{n}").cast("int") >= most  # before this row
        full = done if full is None else full & done
    out = out.withColumn("walked", ~full)
    return out.withColumns({f"accepted_{n}": F.col("walked") & F.col(f"eligible_{n}") & (F.col(f"n_{n}") <= most) for n in names})


def walk_summary(walked: DataFrame, pair: list[str], names: tuple[str, ...] = ("standard", "cross_library", "mirror_aware", "near_dup_strict"), most: int = MOST) -> DataFrame:
    """Per pair: references, depth walked, exhausted, and per protocol the count, exact if below `most` or exhausted."""
    depth = F.sum(F.col("walked").cast("int"))
    total = F.count(F.lit(1))
    cols = [total.cast("int").alias("n_refs"), depth.alias("walk_depth"), (depth == total).alias("exhausted")]
    for n in names:
        c = F.sum((F.col("walked") & F.col(f"eligible_{n}")).cast("int"))
        cols += [F.least(c, F.lit(most)).alias(f"count_{n}"), ((c < most) | ((depth == total) & (c <= most))).alias(f"exact_{n}")]
    return walked.groupBy(*pair).agg(*cols)


def first_eligible(pairs: DataFrame, pair: list[str], protocol: str, most: int = MOST) -> DataFrame:
    """The first `most` eligible references of each pair. The limit on the row number is pushed below the shuffle."""
    w = W.partitionBy(*pair).orderBy(*compatibility())
    return pairs.where(protocols()[protocol]).withColumn("compat_rank", F.row_number().over(w)).where(F.col("compat_rank") <= most)


def dropout(selected: DataFrame, pair: list[str], choices: tuple[int, ...] = (1, 3, 5), seed: int = 0) -> DataFrame:
    """Per pair a hashed number of references out of `choices`, in hashed order."""
    k = F.get(F.array(*(F.lit(c) for c in choices)), F.pmod(F.xxhash64(*pair, F.lit(seed)), F.lit(len(choices))).cast("int"))
    w = W.partitionBy(*pair).orderBy(F.xxhash64("r_id", F.lit(seed)), "r_id")
    return selected.withColumn("drop__", F.row_number().over(w)).where(F.col("drop__") <= k).drop("drop__")


def pair_features(scored: DataFrame, pool: DataFrame, pair: list[str], metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Every pool row with max and mean of the best three of each metric over its references (null without any)."""
    top = lambda c: F.slice(F.sort_array(F.collect_list(c), asc=False), 1, 3)  # noqa: E731  # at most MOST values
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(a), F.lit(0))
    aggs = [F.count(F.lit(1)).alias("n__")] + [x for c in metrics for x in (F.max(c).alias(f"{c}_max"), top(c).alias(f"{c}__"))]
    per = scored.groupBy(*pair).agg(*aggs)
    out = pool.join(per, pair, "left").withColumn("n_reference_spectra", F.coalesce("n__", F.lit(0)))
    out = out.withColumn("has_reference_spectrum", F.col("n_reference_spectra") > 0)
    return out.withColumns({f"{c}_top3_mean": mean(F.col(f"{c}__")) for c in metrics}).drop("n__", *(f"{c}__" for c in metrics))


def identity_tier(pairs: DataFrame) -> DataFrame:
    """pairs with tier. T1: equal canonical hash; T2: one measurement written differently (precursors within 0.005 and
    kernels.mirrors); T3: near duplicate (precursors less than 0.01 apart, cosine above 0.95); T4: any other. pairs holds
    q_ and r_ hash, precursor and peaks, and cosine. The matching runs only where the cheaper tests leave it open."""
    gap = F.abs(F.col("q_precursor") - F.col("r_precursor"))
    same = F.coalesce(F.col("q_hash") == F.col("r_hash"), F.lit(False))
    close = F.coalesce(gap <= 0.005, F.lit(False)) & ~same
    # the kernel sees empty peaks where its result cannot matter
    none = F.array().cast("array<struct<mz:double,intensity:double>>")
    out = pairs.withColumn("m__", mirror_kernel(F.when(close, F.col("q_peaks")).otherwise(none), F.when(close, F.col("r_peaks")).otherwise(none)))
    near = F.coalesce((gap < 0.01) & (F.col("cosine") > 0.95), F.lit(False))
    return out.withColumn("tier", F.when(same, "T1").when(close & F.col("m__"), "T2").when(near, "T3").otherwise("T4")).drop("m__")
