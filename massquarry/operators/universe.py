"""The candidate universe: formula filters, provenance, union of sources, dense ids, formula index, bit similarity."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from massquarry.workspace import stage

# Elements of organic formulas.
ORGANIC = ("C", "H", "N", "O", "S", "P", "F", "Cl", "Br", "I", "Si", "B", "Se")


def elements(formula: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(formula, F.lit("([A-Z][a-z]?)"), 1))


def is_organic(formula: Column) -> Column:
    e = elements(formula)
    return (F.size(e) > 0) & F.array_contains(e, "C") & (F.size(F.array_except(e, F.array(*(F.lit(x) for x in ORGANIC)))) == 0)


def element_class(formula: Column) -> Column:
    """Those of C, H, N, O, S, P that a formula holds, with +X for halogens and +other for other elements; unknown
    without any element."""
    e = elements(formula)
    has = lambda *xs: F.arrays_overlap(e, F.array(*(F.lit(x) for x in xs)))
    core, halogens = ("C", "H", "N", "O", "S", "P"), ("F", "Cl", "Br", "I")
    rest = F.size(F.array_except(e, F.array(*(F.lit(x) for x in (*core, *halogens))))) > 0
    label = F.concat(*(F.when(has(x), x).otherwise("") for x in core), F.when(has(*halogens), "+X").otherwise(""), F.when(rest, "+other").otherwise(""))
    return F.when(F.size(e) > 0, label).otherwise("unknown")


def formal_charge(smiles: Column) -> Column:
    """Sum of the charges written in a SMILES' bracket atoms; null for null."""
    written = F.regexp_extract_all(smiles, F.lit(r"\[[^\]+-]*(\++\d*|-+\d*)(?::\d+)?\]"), 1)
    size = lambda c: F.when(c.rlike(r"\d"), F.regexp_extract(c, r"(\d+)", 1).cast("int")).otherwise(F.length(c))
    return F.aggregate(written, F.lit(0), lambda s, c: s + F.when(c.startswith("-"), -size(c)).otherwise(size(c)))


def apply_filters(df: DataFrame, mass: str, formula: str, smiles: str, low: float, high: float, trusted: Column) -> DataFrame:
    """df with reject_reasons (joined by semicolons, empty if kept) and kept; trusted rows are kept whatever their
    reasons. What is unknown fails: a null mass, formula or structure."""
    m, yes = F.col(mass), lambda c: F.coalesce(c, F.lit(False))
    reasons = F.concat_ws(
        ";", F.when(~yes((m >= low) & (m <= high)), "mass_out_of_range"), F.when(~yes(is_organic(F.col(formula))), "not_organic"),
        F.when(~yes(formal_charge(F.col(smiles)) == 0), "charged"), F.when(~yes(~F.col(smiles).contains(".")), "multi_component"),
    )
    return df.withColumn("reject_reasons", reasons).withColumn("kept", (F.col("reject_reasons") == "") | trusted)


def provenance(df: DataFrame, key: str, source: str, source_id: str) -> DataFrame:
    """Per key: distinct sources and SOURCE:id entries, sorted, with the number of records."""
    return df.groupBy(key).agg(
        F.array_sort(F.collect_set(source)).alias("sources"), F.array_sort(F.collect_set(F.concat_ws(":", source, F.col(source_id).cast("string")))).alias("source_ids"), F.count(F.lit(1)).alias("n_records")
    )


def without_hidden(df: DataFrame, hidden: DataFrame, key: str, lists: list[str], prefix: str) -> DataFrame:
    """Entries with the prefix are taken out of list columns for the hidden keys."""
    h = hidden.select(F.col(key).alias("h__")).distinct()
    out = df.join(h, F.col(key) == F.col("h__"), "left")
    return out.withColumns({c: F.when(F.col("h__").isNotNull(), F.filter(c, lambda x: ~x.startswith(prefix))).otherwise(F.col(c)) for c in lists}).drop("h__")


def unify(trusted: DataFrame, external: DataFrame, key: str, order: str) -> DataFrame:
    """Trusted rows, and of external ones the first per key by order where no trusted row has the key; same columns."""
    first = external.withColumn("r__", F.row_number().over(W.partitionBy(key).orderBy(order))).where("r__ = 1").drop("r__")
    new = first.join(trusted.select(F.col(key).alias("t__")).distinct(), F.col(key) == F.col("t__"), "left_anti")
    return trusted.withColumn("trusted", F.lit(True)).unionByName(new.withColumn("trusted", F.lit(False)))


def dense_ids(df: DataFrame, key: str, id_col: str = "candidate_id", prefix: int = 2) -> DataFrame:
    """df with its row number in the order of a unique key, from 0, without a sort in one partition: rows are numbered
    within their key's prefix, and prefixes get their offsets from their sums."""
    p = F.coalesce(F.substring(F.col(key), 1, prefix), F.lit(""))
    rows = df.withColumn("p__", p)
    sums = rows.groupBy("p__").agg(F.count(F.lit(1)).alias("n__"))
    off = sums.select(F.col("p__").alias("q__"), (F.sum("n__").over(W.orderBy("p__")) - F.col("n__")).alias("o__"))
    out = rows.join(off, F.col("p__") == F.col("q__"))
    return out.withColumn(id_col, F.row_number().over(W.partitionBy("p__").orderBy(key)) - 1 + F.col("o__")).drop("p__", "q__", "o__")


def mass_variants(meta: DataFrame, key: str, mass: str) -> DataFrame:
    """One row per key and mass to five decimals: mass_variant_id (<key>__v<i> by rising mass), rows, and whether the key
    has several."""
    v = meta.where(F.col(key).isNotNull() & F.col(mass).isNotNull() & ~F.isnan(mass)).groupBy(key, (F.floor(F.col(mass) * 1e5 + 0.5) / 1e5).alias("exact_mass")).agg(F.count(F.lit(1)).alias("n_spectra"))
    w = W.partitionBy(key)
    i = F.row_number().over(w.orderBy("exact_mass")) - 1
    return v.withColumn("mass_variant_id", F.concat(F.col(key), F.lit("__v"), i.cast("string"))).withColumn("is_isotope_variant", F.count(F.lit(1)).over(w) > 1)


def packed_bits(features: Column, bits: int = 2048) -> Column:
    """array<long> of bits / 64 words; the bit of each feature is its hash. A stand-in for chemical fingerprints where no
    toolkit is there: similarity of the hashed features, with no chemical meaning of its own."""
    at = F.array_distinct(F.transform(features, lambda x: F.pmod(F.xxhash64(x), F.lit(bits))))
    word = lambda w: F.aggregate(F.filter(at, lambda b: F.floor(b / 64) == w), F.lit(0).cast("long"), lambda s, b: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), (b % 64).cast("int"))))
    return F.transform(F.sequence(F.lit(0), F.lit(bits // 64 - 1)), word)


def shingles(text: Column, n: int = 4) -> Column:
    """Distinct substrings of length n; the text itself if shorter."""
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(n))))).otherwise(F.array(text))


def tanimoto(a: Column, b: Column) -> Column:
    """Common over all bits of two packed fingerprints; null if both are empty."""
    count = lambda f: F.aggregate(F.zip_with(a, b, f), F.lit(0).cast("long"), lambda s, x: s + F.bit_count(x))
    return count(lambda x, y: x.bitwiseAND(y)) / F.nullif(count(lambda x, y: x.bitwiseOR(y)), F.lit(0))


def distinct_sets(df: DataFrame, key: str, items: str) -> DataFrame:
    """k, s, n: the distinct items of each key, sorted, and their number."""
    rows = df.select(F.col(key).alias("k"), F.explode(F.array_distinct(items)).alias("t")).where(F.col("k").isNotNull() & F.col("t").isNotNull())
    return rows.groupBy("k").agg(F.array_sort(F.collect_set("t")).alias("s")).withColumn("n", F.size("s"))


def set_pairs(sets: DataFrame, least: float) -> DataFrame:
    """a, b: the pairs of sets that can reach the Jaccard similarity `least`.

    Sets of x and y items that reach it differ in no more than (x + y) (1 - least) / (1 + least) items. Items fall by hash
    into one part more than that, so at least one part is the same in both: sets meet by size class and whole parts, and
    never by single items, of which many sets share the frequent ones. Sizes grow by 1 / least from class to class; a set
    meets in its own class and in the next one."""
    step = math.log(1 / least) if least < 1 else 1.0
    own = F.floor(F.log("n") / step + 1e-9)
    top = F.ceil(F.exp((F.col("c") + 1) * step) + 1e-6)  # no set of the class is larger
    met = sets.select("k", "n", "s", F.explode(F.array(own, own + 1)).alias("c")).withColumn("parts", (F.floor(2 * top * (1 - least) / (1 + least) + 1e-6) + 1).cast("int"))
    met = met.withColumn("h", F.transform("s", lambda t: F.struct(F.pmod(F.xxhash64(t), F.col("parts")).cast("int").alias("p"), F.xxhash64(t, F.lit(1)).alias("h"))))
    of = lambda i: F.array_sort(F.transform(F.filter("h", lambda x: x["p"] == i), lambda x: x["h"]))
    met = met.select("k", "n", "c", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.xxhash64(of(i)))).alias("p", "g"))
    l, r = met.withColumnsRenamed({"k": "a", "n": "na"}), met.withColumnsRenamed({"k": "b", "n": "nb"})
    return l.join(r, ["c", "p", "g"]).where((F.col("a") < F.col("b")) & (F.col("na") >= least * F.col("nb")) & (F.col("nb") >= least * F.col("na"))).select("a", "b").distinct()


def set_similarity(df: DataFrame, key: str, items: str, least: float) -> DataFrame:
    """a, b, similarity: pairs of keys whose distinct items reach the Tanimoto (Jaccard) similarity `least`, above zero."""
    sets = stage(distinct_sets(df, key, items), "sets")
    both = set_pairs(sets, least).join(sets.select(F.col("k").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("k").alias("b"), F.col("s").alias("sb")), "b")
    return both.select("a", "b", (F.size(F.array_intersect("sa", "sb")) / F.size(F.array_union("sa", "sb"))).alias("similarity")).where(F.col("similarity") >= least)


def propagate(pairs: DataFrame, query: str, candidate: str, weight: str, similarity: str) -> DataFrame:
    """Per query and candidate: weighted mean and maxima of its similarity to the query's analogues."""
    w, s = F.col(weight), F.col(similarity)
    return pairs.groupBy(query, candidate).agg(
        F.count(F.lit(1)).alias("n_analogs"), (F.sum(w * s) / F.nullif(F.sum(w), F.lit(0.0))).alias("weighted_mean"), F.max(s).alias("max_similarity"), F.max(w * s).alias("max_weighted"), F.max_by("analog", F.struct(w * s, "analog")).alias("best_analog")
    )
