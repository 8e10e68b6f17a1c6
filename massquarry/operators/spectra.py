"""Spectra as parallel peak lists: validity, cleaning, shape features, binning and similarities.

Per-row work on short lists stays in higher-order functions; similarities over many pairs are joins on bins and sums.
The sequential matchings (peak overlap, modified cosine) are Arrow kernels in massquarry.functions.kernels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FLAGS = ("empty", "length_mismatch", "nonfinite_mz", "nonfinite_intensity", "negative_mz", "negative_intensity", "unsorted_mz", "duplicate_mz", "fragment_above_precursor", "extreme_fragment_mz")


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def flags(mz: Column, intensity: Column, precursor: Column, above: float = 5.0, extreme: float = 5000.0) -> dict[str, Column]:
    """What may be wrong with a spectrum; null lists count as empty, null numbers as not finite."""
    m, i = F.coalesce(mz, F.array().cast("array<double>")), F.coalesce(intensity, F.array().cast("array<double>"))
    real = F.filter(m, lambda x: x.isNotNull() & ~F.isnan(x))
    fall = F.exists(F.zip_with(F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0))), F.slice(m, 1, F.greatest(F.size(m) - 1, F.lit(0))), lambda b, a: ~F.coalesce((b >= a) & ~F.isnan(a) & ~F.isnan(b), F.lit(False))), lambda x: x)
    p = precursor + above
    return {
        "empty": F.size(m) == 0, "length_mismatch": F.size(m) != F.size(i),
        "nonfinite_mz": F.exists(m, lambda x: ~_finite(x)), "nonfinite_intensity": F.exists(i, lambda x: ~_finite(x)),
        "negative_mz": F.exists(real, lambda x: x < 0), "negative_intensity": F.exists(F.filter(i, lambda x: x.isNotNull() & ~F.isnan(x)), lambda x: x < 0),
        "unsorted_mz": fall, "duplicate_mz": F.size(F.array_distinct(real)) != F.size(real),
        "fragment_above_precursor": F.coalesce(F.exists(real, lambda x: x > p), F.lit(False)), "extreme_fragment_mz": F.exists(real, lambda x: x > extreme),
    }


def peaks(mz: Column, intensity: Column, strict: bool = False) -> Column:
    """array<struct<mz, intensity>> sorted by m/z, without peaks that are null, not finite or negative (strict: or zero);
    null where the lists differ in length or are null."""
    good = lambda p: _finite(p["mz"]) & _finite(p["intensity"]) & ((p["mz"] > 0) & (p["intensity"] > 0) if strict else (p["mz"] >= 0) & (p["intensity"] >= 0))
    pairs = F.zip_with(mz, intensity, lambda m, i: F.struct(m.alias("mz"), i.alias("intensity")))
    return F.when(F.size(mz) == F.size(intensity), F.array_sort(F.filter(pairs, good)))


def top_peaks(p: Column, n: int) -> Column:
    """The n most intense peaks (of equal ones those of lower m/z), sorted by m/z."""
    by = F.array_sort(F.transform(p, lambda x: F.struct((-x["intensity"]).alias("i"), x["mz"].alias("m"))))
    return F.array_sort(F.transform(F.slice(by, 1, n), lambda x: F.struct(x["m"].alias("mz"), (-x["i"]).alias("intensity"))))


def merge_close(p: Column, tol: float = 0.0) -> Column:
    """Runs of peaks within tol of the run's first m/z as one peak with the sum of intensities."""
    kind = "array<struct<mz:double,intensity:double>>"
    last = lambda a: F.element_at(a, -1)
    step = lambda a, x: F.when((F.size(a) > 0) & (x["mz"] - F.try_element_at(a, F.lit(-1))["mz"] <= tol), F.concat(
        F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.struct(last(a)["mz"].alias("mz"), (last(a)["intensity"] + x["intensity"]).alias("intensity")))
    )).otherwise(F.concat(a, F.array(x)))
    return F.aggregate(p, F.array().cast(kind), step)


def scaled(p: Column, how: str) -> Column:
    """Intensities scaled: max, sum, l2, sqrt or log1p; an all-zero spectrum stays as it is."""
    value = lambda x: x["intensity"]
    total = {"max": F.array_max(F.transform(p, value)), "sum": F.aggregate(p, F.lit(0.0), lambda s, x: s + value(x)), "l2": F.sqrt(F.aggregate(p, F.lit(0.0), lambda s, x: s + value(x) * value(x)))}
    new = {"sqrt": lambda x: F.sqrt(value(x)), "log1p": lambda x: F.log1p(value(x))}.get(how) or (lambda x: F.when(total[how] > 0, value(x) / total[how]).otherwise(value(x)))
    return F.transform(p, lambda x: F.struct(x["mz"].alias("mz"), new(x).alias("intensity")))


def features(p: Column, precursor: Column) -> dict[str, Column]:
    """Shape of a cleaned spectrum (see peaks)."""
    m, i = F.transform(p, lambda x: x["mz"]), F.transform(p, lambda x: x["intensity"])
    n = F.size(p)
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    total, mean = add(i), add(m) / F.nullif(n, F.lit(0))
    falling = F.sort_array(i, asc=False)
    share = lambda k: F.when(total > 0, add(F.slice(falling, 1, k)) / total).otherwise(0.0)
    # of equal intensities the first, as the list is sorted by m/z
    base = F.element_at(F.filter(p, lambda x: x["intensity"] == F.array_max(i)), 1)
    mid = (F.element_at(m, F.floor((n + 1) / 2).cast("int")) + F.element_at(m, (F.floor(n / 2) + 1).cast("int"))) / 2
    above = F.size(F.filter(m, lambda x: x > precursor))
    ok = n > 0
    cols = {
        "mz_min": F.array_min(m), "mz_max": F.array_max(m), "mz_mean": mean, "mz_median": mid,
        "mz_std": F.sqrt(F.aggregate(m, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / F.nullif(n, F.lit(0))),
        "fragment_mz_range": F.array_max(m) - F.array_min(m), "base_peak_mz": base["mz"], "base_peak_intensity": F.array_max(i),
        "total_intensity": total, **{f"top{k}_intensity_fraction": share(k) for k in (1, 3, 5, 10)},
        "spectral_entropy": F.when(total > 0, -add(F.transform(F.filter(i, lambda x: x > 0), lambda x: x / total * F.log(x / total)))).otherwise(0.0),
        "max_fragment_minus_precursor": F.array_max(m) - precursor, "n_fragments_above_precursor": F.coalesce(F.when(precursor.isNotNull(), above), F.lit(0)),
    }
    zero = {"total_intensity", "spectral_entropy", "n_fragments_above_precursor"}
    out = {"n_peaks": n} | {k: F.when(ok, c) if k not in zero and "fraction" not in k else c for k, c in cols.items()}
    return out | {"fraction_fragments_above_precursor": F.when(ok, out["n_fragments_above_precursor"] / F.nullif(n, F.lit(0))).otherwise(0.0)}


def binned(df: DataFrame, key: list[str], p: Column, width: float = 0.1, normalise: bool = True) -> DataFrame:
    """key, bin, value: intensities summed per floor(mz / width), of length one per spectrum where that can be."""
    rows = df.select(*key, F.explode(p).alias("p")).groupBy(*key, F.floor(F.col("p.mz") / width).alias("bin")).agg(F.sum("p.intensity").alias("value"))
    if not normalise:
        return rows
    norm = rows.groupBy(*(F.col(k).alias(f"{k}__") for k in key)).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    on = None
    for k in key:
        c = F.col(k) == F.col(f"{k}__")
        on = c if on is None else on & c
    return rows.join(norm, on).where("norm > 0").select(*key, "bin", (F.col("value") / F.col("norm")).alias("value"))


def cosine_of_pairs(pairs: DataFrame, left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """pairs (a, b) with cosine over common bins, zero without any; left and right as made by binned with key a and b."""
    pairs = pairs.select(a, b).distinct()
    dots = pairs.join(left, a).join(right.withColumnRenamed("value", "other"), [b, "bin"]).groupBy(a, b).agg(F.sum(F.col("value") * F.col("other")).alias("cosine"))
    return pairs.join(dots, [a, b], "left").withColumn("cosine", F.coalesce("cosine", F.lit(0.0)))


def similar_pairs(left: DataFrame, right: DataFrame, a: str, b: str, least: float, same: tuple[str, ...] = (), near: str | None = None, width: float = 0.0) -> DataFrame:
    """All pairs that share a bin and reach the cosine `least`: a join of inverted lists, summed. Pairs must agree in the
    columns `same`, and differ in `near` by no more than `width`; both become part of the join's key, which is what keeps
    long lists of common bins apart."""
    r = right.select(b, "bin", F.col("value").alias("other"), *(F.col(c).alias(f"{c}__r") for c in (*same, *([near] if near else []))))
    on = F.col("bin") == F.col("bin__r")
    r = r.withColumnRenamed("bin", "bin__r")
    for c in same:
        on &= F.col(c) == F.col(f"{c}__r")
    if near:
        slot = lambda c: F.floor(F.col(c) / width)
        left = left.withColumn("slot__", F.explode(F.sequence(slot(near) - 1, slot(near) + 1)))
        r = r.withColumn("slot__r", slot(f"{near}__r"))
        on &= (F.col("slot__") == F.col("slot__r")) & (F.abs(F.col(near) - F.col(f"{near}__r")) <= width)
    return left.join(r, on).groupBy(a, b).agg(F.sum(F.col("value") * F.col("other")).alias("cosine")).where(F.col("cosine") >= least)


def entropy_of_pairs(pairs: DataFrame, sums: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """pairs with entropy_similarity, 1 - (2 H(mixed) - H(a) - H(b)) / ln 4 over the shares per bin; sums as made by
    binned without normalising. Written over common bins only: bins of one side cancel in the difference."""
    total = sums.groupBy(F.col(key).alias("k__")).agg(F.sum("value").alias("t__"))
    p = sums.join(total, F.col(key) == F.col("k__")).where("t__ > 0 and value > 0").select(key, "bin", (F.col("value") / F.col("t__")).alias("p"))
    x = pairs.select(a, b).join(p.select(F.col(key).alias(a), "bin", F.col("p").alias("p")), a).join(p.select(F.col(key).alias(b), "bin", F.col("p").alias("q")), [b, "bin"])
    h = lambda v: v * F.log(v)
    s = F.col("p") + F.col("q")
    common = x.groupBy(a, b).agg((F.sum(h(s) - h(F.col("p")) - h(F.col("q"))) / F.log(F.lit(4.0))).alias("entropy_similarity"))
    return pairs.select(a, b).join(common, [a, b], "left").withColumn("entropy_similarity", F.coalesce("entropy_similarity", F.lit(0.0)))


def losses(p: Column, precursor: Column) -> Column:
    """Neutral losses of the peaks below the precursor, as peaks."""
    return F.array_sort(F.transform(F.filter(p, lambda x: x["mz"] < precursor), lambda x: F.struct((precursor - x["mz"]).alias("mz"), x["intensity"].alias("intensity"))))


def peak_hash(p: Column, precursor: Column) -> Column:
    """sha256 of the canonical text of a spectrum: m/z to 4, max-scaled intensities and precursor to 3 decimals, rounded
    half to even, zero intensities dropped."""
    text = F.transform(F.filter(scaled(p, "max"), lambda x: F.bround(x["intensity"], 3) > 0), lambda x: F.concat_ws(":", F.bround(x["mz"], 4).cast("decimal(24,4)").cast("string"), F.bround(x["intensity"], 3).cast("decimal(24,3)").cast("string")))
    return F.sha2(F.concat_ws("|", F.array_join(text, ";"), F.bround(precursor, 3).cast("decimal(24,3)").cast("string")), 256)


def energies(ev: Column) -> dict[str, Column]:
    """Count, mean, least, greatest and range of a list of collision energies without nulls and NaN."""
    v = F.filter(ev, lambda x: x.isNotNull() & ~F.isnan(x))
    n = F.when(ev.isNull(), 0).otherwise(F.size(v))
    return {"ce_n": n, "ce_mean": F.when(n > 0, F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.nullif(n, F.lit(0))), "ce_min": F.array_min(v), "ce_max": F.array_max(v), "ce_range": F.array_max(v) - F.array_min(v)}
