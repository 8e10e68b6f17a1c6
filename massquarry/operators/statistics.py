"""Distribution shift, weighted quantiles, resampling, folds and other splits.

Global cumulative sums run over distinct values or histogram cells, never over rows in one partition of unknown size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def unit_hash(key: Column, seed: str) -> Column:
    """A number in [0, 1) that only depends on seed and key; the same in any engine with md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string"))), 1, 13), 16, 10).cast("double") / float(2**52)


def _steps(df: DataFrame, group: str, value: str, sides: tuple[str, str]) -> DataFrame:
    """Distinct values with their counts on both sides; sides are values of the group column."""
    a, b = sides
    v = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(group).isin(a, b))
    return v.groupBy(F.col(value).cast("double").alias("v")).agg(F.count_if(F.col(group) == a).alias("a"), F.count_if(F.col(group) == b).alias("b"))


def numeric_shift(df: DataFrame, group: str, value: str, sides: tuple[str, str]) -> DataFrame:
    """n_a, n_b, ks, wasserstein between two groups, from the distinct values."""
    s = _steps(df, group, value, sides)
    # values are ranged into cells first: the windows run within a cell, the cells' sums over few rows
    total = s.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    cells = 4096
    s = s.crossJoin(F.broadcast(total)).withColumn("c", F.least(F.floor((F.col("v") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * cells), F.lit(cells - 1)))
    s = s.withColumn("c", F.coalesce("c", F.lit(0)))
    w = W.orderBy("c")
    per = s.groupBy("c").agg(F.sum("a").alias("sa"), F.sum("b").alias("sb"), F.min("v").alias("first"))
    per = per.select("c", (F.sum("sa").over(w) - F.col("sa")).alias("pa"), (F.sum("sb").over(w) - F.col("sb")).alias("pb"), F.lead("first").over(w).alias("next"))
    inner = W.partitionBy("c").orderBy("v")
    r = s.join(F.broadcast(per), "c")  # at most `cells` rows
    d = F.abs((F.sum("a").over(inner) + F.col("pa")) / F.col("na") - (F.sum("b").over(inner) + F.col("pb")) / F.col("nb"))
    r = r.select("na", "nb", d.alias("d"), (F.coalesce(F.lead("v").over(inner), F.col("next")) - F.col("v")).alias("gap"))
    return r.agg(F.max("na").alias("n_a"), F.max("nb").alias("n_b"), F.max("d").alias("ks"), F.sum(F.col("d") * F.coalesce("gap", F.lit(0.0))).alias("wasserstein"))


def weighted_ks(df: DataFrame, group: str, value: str, weight: str, sides: tuple[str, str], strata: str, min_rows: int = 20) -> DataFrame:
    """Per stratum the greatest distance between the weighted distribution functions of two groups; strata with fewer
    than min_rows rows of either group have none."""
    a, b = sides
    v = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(group).isin(a, b) & (F.col(weight) > 0))
    one = lambda s, x: F.sum(F.when(F.col(group) == s, x).otherwise(0.0))
    s = v.groupBy(strata, F.col(value).alias("v")).agg(one(a, F.col(weight)).alias("a"), one(b, F.col(weight)).alias("b"), one(a, F.lit(1.0)).alias("na"), one(b, F.lit(1.0)).alias("nb"))
    w = W.partitionBy(strata)
    part = lambda c: F.sum(c).over(w.orderBy("v")) / F.nullif(F.sum(c).over(w), F.lit(0.0))
    d = s.select(strata, "na", "nb", F.abs(part("a") - part("b")).alias("d"))
    return d.groupBy(strata).agg(F.sum("na").cast("long").alias("n_a"), F.sum("nb").cast("long").alias("n_b"), F.max("d").alias("ks")).where((F.col("n_a") >= min_rows) & (F.col("n_b") >= min_rows))


def categorical_shift(df: DataFrame, group: str, value: str, sides: tuple[str, str]) -> DataFrame:
    """Jensen-Shannon distance (base 2) and total variation between the category shares of two groups."""
    a, b = sides
    c = df.where(F.col(value).isNotNull() & F.col(group).isin(a, b)).groupBy(value).agg(F.count_if(F.col(group) == a).alias("a"), F.count_if(F.col(group) == b).alias("b"))
    t = c.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    s = c.crossJoin(F.broadcast(t)).select((F.col("a") / F.nullif(F.col("na"), F.lit(0))).alias("p"), (F.col("b") / F.nullif(F.col("nb"), F.lit(0))).alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    kl = lambda x: F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / m)).otherwise(0.0)
    return s.agg(F.count(F.lit(1)).alias("n_categories"), F.sqrt(F.greatest(F.sum(kl("p") + kl("q")) / 2, F.lit(0.0))).alias("js_distance"), (F.sum(F.abs(F.col("p") - F.col("q"))) / 2).alias("tv_distance"))


def weighted_quantile(df: DataFrame, group: str, value: str, weight: str, share: float) -> DataFrame:
    """Per group the smallest value whose running weight reaches the share of the total (inverted distribution function)."""
    s = df.where(F.col(value).isNotNull() & (F.col(weight) > 0)).groupBy(group, value).agg(F.sum(weight).alias("w"))
    w = W.partitionBy(group)
    run = F.sum("w").over(w.orderBy(value)) / F.sum("w").over(w)
    return s.withColumn("run", run).where(F.col("run") >= share - 1e-12).groupBy(group).agg(F.min(value).alias("quantile"))


def cell_weights(pool: DataFrame, target: DataFrame, cell: str, low: float, high: float) -> DataFrame:
    """cell, weight: share in the target over share in the pool, clipped; cells that the target lacks weigh `low`."""
    p = pool.where(F.col(cell).isNotNull()).groupBy(cell).agg(F.count(F.lit(1)).alias("np"))
    t = target.where(F.col(cell).isNotNull()).groupBy(cell).agg(F.count(F.lit(1)).alias("nt"))
    both = p.join(t, cell, "left")
    total = p.agg(F.sum("np").alias("tp")).crossJoin(t.agg(F.sum("nt").alias("tt")))  # one row each
    ratio = (F.coalesce("nt", F.lit(0)) / F.col("tt")) / (F.col("np") / F.col("tp"))
    return both.crossJoin(F.broadcast(total)).select(cell, F.least(F.greatest(ratio, F.lit(low)), F.lit(high)).alias("weight"))


def weighted_order(df: DataFrame, key: str, weight: str, seed: str) -> DataFrame:
    """df with draw: a weighted random permutation without replacement; any prefix is a weighted sample, and prefixes
    nest. Take the smallest n by orderBy(draw).limit(n)."""
    u = F.greatest(unit_hash(F.col(key), seed), F.lit(1e-15))
    return df.where(F.col(weight) > 0).withColumn("draw", -F.log(u) / F.col(weight))


def one_per_group(df: DataFrame, group: str, order: str, key: str) -> DataFrame:
    """The first row of each group by order, then key."""
    best = df.groupBy(F.col(group).alias("g__")).agg(F.min(F.struct(order, key)).alias("b__"))
    return df.join(best, (F.col(group) == F.col("g__")) & (F.col(key) == F.col(f"b__.{key}"))).drop("g__", "b__")


def quotas(sizes: DataFrame, total: int) -> DataFrame:
    """Largest-remainder share of `total` for every stratum (stratum, n)."""
    exact = F.col("n") * total / F.sum("n").over(W.partitionBy())
    q = sizes.withColumn("base", F.floor(exact)).withColumn("rest", exact - F.floor(exact))
    more = F.lit(total) - F.sum("base").over(W.partitionBy())
    return q.withColumn("quota", F.least(F.col("n"), F.col("base") + (F.row_number().over(W.orderBy(F.desc("rest"), "stratum")) <= more).cast("int"))).select("stratum", "n", "quota")


def stratified_sample(df: DataFrame, stratum: str, key: str, total: int, seed: str) -> DataFrame:
    """A sample of `total` rows in proportion to the strata, by hashed order within each."""
    q = quotas(df.groupBy(F.col(stratum).alias("stratum")).agg(F.count(F.lit(1)).alias("n")), total)
    w = W.partitionBy(stratum).orderBy(unit_hash(F.col(key), seed), key)
    rows = df.withColumn("r__", F.row_number().over(w))
    return rows.join(q.withColumnRenamed("stratum", "s__"), F.col(stratum).eqNullSafe(F.col("s__"))).where(F.col("r__") <= F.col("quota")).drop("r__", "s__", "n", "quota")


def hash_folds(df: DataFrame, group: str, folds: int, seed: str) -> DataFrame:
    """df with fold, the same for all rows of a group."""
    return df.withColumn("fold", F.floor(unit_hash(F.col(group), seed) * folds).cast("int"))


def balanced_folds(df: DataFrame, group: str, folds: int, large: float = 0.002) -> DataFrame:
    """group, fold: groups that hold more than the share `large` of the rows are placed one by one, largest first, where
    least is (fewer than 1 / large by number); the many small ones go by hash in proportion to the room left."""
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    big = sizes.where(F.col("n") > large * total).orderBy(F.desc("n"), group).collect()
    room, placed = [total / folds] * folds, {}
    for r in big:
        f = max(range(folds), key=lambda i: (room[i], -i))
        placed[r[0]] = f
        room[f] -= r["n"]
    left = [max(0.0, x) for x in room]
    scale, edge, fold = sum(left) or 1.0, 0.0, None
    u = unit_hash(F.col(group), "folds")
    for f in range(folds - 1):
        edge += left[f] / scale
        fold = F.when(u < edge, f) if fold is None else fold.when(u < edge, f)
    fold = F.lit(0) if fold is None else fold.otherwise(folds - 1)
    if placed:
        fold = F.coalesce(F.create_map(*(F.lit(x) for kv in placed.items() for x in kv))[F.col(group)], fold)
    return sizes.select(group, "n", fold.alias("fold"))


def leaked_groups(df: DataFrame, group: str, fold: str) -> DataFrame:
    """Groups with rows in more than one fold."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(fold).alias("folds")).where("folds > 1")


def regimes(keys: DataFrame, key: str, eligible: list[str], shares: list[float], seed: str) -> DataFrame:
    """keys with regime: one of the regimes a key is eligible for, hashed in proportion to their shares; null if none."""
    u = unit_hash(F.col(key), seed)
    total = None
    for e, s in zip(eligible, shares, strict=True):
        x = F.when(F.col(e), s).otherwise(0.0)
        total = x if total is None else total + x
    out, edge = None, F.lit(0.0)
    for i, (e, s) in enumerate(zip(eligible, shares, strict=True)):
        edge = edge + F.when(F.col(e), s).otherwise(0.0)
        hit = F.col(e) & (u * total < edge)
        out = F.when(hit, f"C{i + 1}") if out is None else out.when(hit, f"C{i + 1}")
    return keys.withColumn("regime", F.when(total > 0, out))


def cluster_bootstrap(df: DataFrame, value: str, cluster: str, rounds: int, seed: str) -> DataFrame:
    """round, mean: means over resampled clusters. A cluster's weight in a round is Poisson(1) from its hash, so rounds
    need no driver and no second pass; the cluster sums are formed once."""
    sums = df.where(F.col(value).isNotNull()).groupBy(cluster).agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n"))
    cells = sums.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    u = unit_hash(F.concat(F.col(cluster).cast("string"), F.lit("|"), F.col("round").cast("string")), seed)
    weight, p, edge = F.lit(0), 0.36787944117144233, 0.0
    for k in range(8):
        edge += p
        p /= k + 1
        weight = weight + (u >= edge).cast("int")
    cells = cells.withColumn("w", weight)
    return cells.groupBy("round").agg((F.sum(F.col("w") * F.col("s")) / F.nullif(F.sum(F.col("w") * F.col("n")), F.lit(0))).alias("mean"))


def interval(means: DataFrame, level: float = 0.95) -> DataFrame:
    """Percentile interval of bootstrap means."""
    a = (1 - level) / 2
    return means.agg(F.avg("mean").alias("mean"), F.percentile("mean", F.lit(a)).alias("low"), F.percentile("mean", F.lit(1 - a)).alias("high"))


def auc(df: DataFrame, score: str, positive: str, groups: list[str]) -> DataFrame:
    """Area under the ROC curve per group from counts per distinct score; ties count half."""
    s = df.where(F.col(score).isNotNull() & ~F.isnan(score)).groupBy(*groups, score).agg(F.count_if(F.col(positive)).alias("p"), F.count_if(~F.col(positive)).alias("n"))
    below = F.sum("n").over(W.partitionBy(*groups).orderBy(score)) - F.col("n")
    s = s.withColumn("u", F.col("p") * (below + F.col("n") / 2))
    return s.groupBy(*groups).agg(F.sum("p").alias("n_pos"), F.sum("n").alias("n_neg"), (F.sum("u") / F.nullif(F.sum("p") * F.sum("n"), F.lit(0))).alias("auc"))


def robust_outliers(df: DataFrame, value: str, threshold: float = 6.0) -> DataFrame:
    """df with robust_z of log10(value): distance from the median in scaled median absolute deviations, and outlier."""
    x = F.when(F.col(value) > 0, F.log10(value))
    med = df.agg(F.median(x).alias("med__"))
    mad = df.crossJoin(F.broadcast(med)).agg(F.first("med__").alias("med__"), F.median(F.abs(x - F.col("med__"))).alias("mad__"))
    z = (x - F.col("med__")) / F.nullif(F.col("mad__") * 1.4826, F.lit(0.0))
    return df.crossJoin(F.broadcast(mad)).withColumn("robust_z", z).withColumn("outlier", F.coalesce(F.abs("robust_z") > threshold, F.lit(False))).drop("med__", "mad__")
