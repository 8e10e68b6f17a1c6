"""Queries of this subpackage and, where SQL can express them on whole tables, their SQL."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from massquarry.llm import encoding, knn, leakage, overlap, packing, quantiles, splits, topn
from massquarry.workspace import stage

# What stands for a missing structure name, in any letter case.
PLACEHOLDERS = ("", "-", "na", "n/a", "nan", "none", "null", "unknown")

_EDGES = r"""^[\s\u00a0"']+|[\s\u00a0"']+$"""


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The ten best candidates of every molecule of test."""
    spectra = _table(spark, d, "test").select("molecule_id", "spectrum_id").dropna().distinct()
    pool = _table(spark, d, "candidate_pool").select("query_id", "candidate_connectivity_key", "score")
    pool = pool.where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("candidate_connectivity_key").isNotNull())
    best = pool.join(spectra, F.col("query_id") == F.col("spectrum_id")).groupBy("molecule_id", "candidate_connectivity_key").agg(F.max("score").alias("score"))
    return topn.top_n(best, ["molecule_id"], "score", ["candidate_connectivity_key"], 10).select("molecule_id", "candidate_connectivity_key")


def _structures() -> list[Column]:
    """The names of a structure as nodes; inchikeys sort before smiles, so that a component's label is what is asked for."""
    key = F.upper(F.regexp_replace("inchikey14", _EDGES, ""))
    key = F.regexp_extract(key, "^(?:INCHIKEY=)?([A-Z]{14})(?:-.*)?$", 1)
    smiles = F.regexp_replace("normalized_smiles", _EDGES, "")
    return [F.when(key != "", F.concat(F.lit("0"), key)), F.when(~F.lower(smiles).isin(*PLACEHOLDERS), F.concat(F.lit("1"), smiles))]


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return splits.group_records(_table(spark, d, "train").select("row_offset", "inchikey14", "normalized_smiles"), "row_offset", _structures())


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Each train record of a group of at least two, with the group's name."""
    return _groups(spark, d).where("records > 1").select(F.col("record").alias("row_offset"), F.substring("root", 2, 1_000_000).alias("group_key"))


def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    """Train, validation and test in the proportions 80/10/10 of records, structures kept together."""
    s = splits.proportional_splits(_groups(spark, d), {"train": 0.8, "validation": 0.1, "test": 0.1})
    return s.select(F.col("record").alias("row_offset"), F.substring("root", 2, 1_000_000).alias("group_key"), "split")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of similar train spectra of which one is among the five most similar of the other."""
    n = knn.nearest(_table(spark, d, "train").select("row_offset", "ms2_mzs", "ms2_normalized_intensities"), "row_offset", "ms2_mzs", "ms2_normalized_intensities")
    return n.select(F.least("id", "neighbour").alias("row_a"), F.greatest("id", "neighbour").alias("row_b")).distinct()


def p3_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The five most similar other train spectra, at any similarity, of every train spectrum whose row_offset is divisible
    by 20."""
    n = knn.nearest_of(_table(spark, d, "train"), "row_offset", "ms2_mzs", "ms2_normalized_intensities", F.col("id") % 20 == 0)
    return n.select(F.col("id").alias("row_offset"), F.col("neighbour"), "similarity", "rank")


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    cols = ["ms2_mzs", "ms2_normalized_intensities", "precursor_mz"]
    test, train = _table(spark, d, "test").select("spectrum_id", *cols), _table(spark, d, "train").select("row_offset", *cols)
    pairs = overlap.near_same(test, train, "spectrum_id", "row_offset", *cols)
    return pairs.select(F.col("eval_id").alias("spectrum_id"), F.col("train_id").cast("long").alias("row_offset"), "similarity")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Test and train spectra that are the same or nearly the same measurement."""
    return _overlaps(spark, d).select("spectrum_id", "row_offset")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """The overlaps counted per split and source: pairs, test spectra and train records involved."""
    pairs = _overlaps(spark, d)
    test = _table(spark, d, "test").groupBy(F.col("spectrum_id").alias("s__")).agg(F.min("eval_set").alias("eval_set"))
    train = _table(spark, d, "train").groupBy(F.col("row_offset").alias("r__")).agg(F.min("ingest_lib").alias("ingest_lib"))
    rows = pairs.join(test, F.col("spectrum_id") == F.col("s__")).join(train, F.col("row_offset") == F.col("r__"))
    return rows.groupBy("eval_set", "ingest_lib").agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("spectrum_id").alias("test_spectra"), F.countDistinct("row_offset").alias("train_records"))


_SHARES = {"p01": 0.01, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
#: Fixed value: the number that stands for a missing precursor error.
_NO_ERROR = -999.0
_RANK_ERROR = 0.005


def _errors(spark: SparkSession, d: str) -> DataFrame:
    """Measured precursor errors with library, adduct, instrument and day of first delivery; spelling variants of an
    instrument are one."""
    t = _table(spark, d, "train").groupBy("row_offset").agg(*(F.first(c).alias(c) for c in ("ingest_lib", "adduct", "instrument_type", "precursor_error_ppm")), F.min("ingested_at").alias("at"))
    t = t.where(F.col("precursor_error_ppm") != _NO_ERROR)
    return t.withColumns({"instrument_type": F.upper(F.regexp_replace("instrument_type", "[^A-Za-z0-9]", "")), "day": F.to_date("at")})


_GROUP = ["ingest_lib", "adduct", "instrument_type"]


def p7_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of the precursor error per library, adduct and instrument: of every day, and of all days (day is null),
    whose digests are the sums of the days' digests. The rank error is at most 0.5 %."""
    days = stage(quantiles.digests(_errors(spark, d), [*_GROUP, "day"], "precursor_error_ppm", _RANK_ERROR), "days")
    whole = quantiles.percentiles(quantiles.merge(days, _GROUP, _RANK_ERROR), _GROUP, _SHARES).withColumn("day", F.lit(None).cast("date"))
    return quantiles.percentiles(days, [*_GROUP, "day"], _SHARES).unionByName(whole)


def p7_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Per library, adduct and instrument: the values, and whether the rank of each percentile over all days, counted in
    the values, is within the stated error. A value stands for its cell, 2**-12 of it wide."""
    e = _errors(spark, d)
    whole = quantiles.percentiles(quantiles.merge(stage(quantiles.digests(e, [*_GROUP, "day"], "precursor_error_ppm", _RANK_ERROR), "days"), _GROUP, _RANK_ERROR), _GROUP, _SHARES)
    v = e.select(*(F.col(c).alias(f"{c}__") for c in _GROUP), F.col("precursor_error_ppm").alias("v")).where(~F.isnan("v") & (F.abs("v") != float("inf")))
    same = F.lit(True)
    for c in _GROUP:
        same &= F.col(c).eqNullSafe(F.col(f"{c}__"))
    near = lambda q: F.abs(q) * 2.0**-11
    counts = [F.count_if(F.col("v") < F.col(q) - near(F.col(q))).alias(f"below_{q}") for q in _SHARES] + [F.count_if(F.col("v") <= F.col(q) + near(F.col(q))).alias(f"upto_{q}") for q in _SHARES]
    t = v.join(whole, same).groupBy(*_GROUP, "n").agg(F.count(F.lit(1)).alias("n_values"), *counts)
    ok = F.col("n") == F.col("n_values")
    for q, share in _SHARES.items():
        rank, slack = F.greatest(F.ceil(F.lit(share) * F.col("n")), F.lit(1)), F.lit(_RANK_ERROR) * F.col("n")
        ok &= (F.col(f"below_{q}") < rank + slack) & (F.col(f"upto_{q}") >= rank - slack)
    return t.select(*_GROUP, "n_values", ok.alias("within"))


TOKENIZER = os.environ.get("MASSQUARRY_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    """Documents in containers of 2,048 tokens."""
    return packing.pack(_table(spark, d, "documents"), "doc_id", "text", TOKENIZER)


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(_table(spark, d, "documents"), _table(spark, d, "eval_items"), "doc_id", "item_id")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold twelve consecutive words of an item."""
    return _leaks(spark, d).where("exact_windows > 0").select("doc_id", "item_id")


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """Exact and re-parameterised windows per document and item."""
    return _leaks(spark, d)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with garbled characters."""
    return encoding.repair(_table(spark, d, "documents"), "doc_id", "text").select("doc_id")


def p10_repaired(spark: SparkSession, d: str) -> DataFrame:
    """The same with the text restored as far as can be told."""
    return encoding.repair(_table(spark, d, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_splits, p3_found, p3_nearest, p5_found, p5_report, p7_percentiles, p7_accuracy, p8_packing, p9_found, p9_report, p10_found, p10_repaired)}

def _usable(name: str, id_col: str) -> str:
    """SQL of the usable spectra's bins, scaled to length one."""
    return f"""{name}0 AS (SELECT DISTINCT {id_col} AS id, precursor_mz AS p, ms2_mzs AS m, ms2_normalized_intensities AS i FROM {name} WHERE len(ms2_mzs) = len(ms2_normalized_intensities)),
 {name}1 AS (SELECT id, p, m, i FROM (SELECT id, p, unnest(m) AS m, unnest(i) AS i FROM {name}0) WHERE m IS NOT NULL AND i IS NOT NULL AND isfinite(m) AND isfinite(i) AND m > 0 AND i > 0 QUALIFY count(*) OVER (PARTITION BY id) >= 5),
 {name}2 AS (SELECT id, p, floor(m / 0.1)::BIGINT AS bin, sum(i) AS v FROM {name}1 GROUP BY 1, 2, 3), {name}3 AS (SELECT id, p, bin, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS w FROM {name}2)"""


ORACLE = {
    "p1_found": """SELECT molecule_id, candidate_connectivity_key FROM (
  SELECT molecule_id, candidate_connectivity_key, row_number() OVER (PARTITION BY molecule_id ORDER BY score DESC, candidate_connectivity_key) AS r
  FROM (SELECT s.molecule_id, c.candidate_connectivity_key, max(c.score) AS score
        FROM candidate_pool c JOIN (SELECT DISTINCT molecule_id, spectrum_id FROM test WHERE molecule_id IS NOT NULL) s ON c.query_id = s.spectrum_id
        WHERE c.score IS NOT NULL AND NOT isnan(c.score) AND c.candidate_connectivity_key IS NOT NULL GROUP BY ALL)) WHERE r <= 10""",
    "p3_nearest": f"""WITH {_usable('train', 'row_offset')}, s AS (SELECT q.id, r.id AS n, round(sum(q.w * r.w), 6) AS s FROM train3 q JOIN train3 r ON q.bin = r.bin AND q.id <> r.id WHERE q.id % 20 = 0 GROUP BY 1, 2)
 SELECT id AS row_offset, n AS neighbour, s AS similarity, row_number() OVER (PARTITION BY id ORDER BY s DESC, n) AS rank FROM s WHERE s > 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, n) <= 5""",
    "p5_found": f"""WITH {_usable('test', 'spectrum_id')}, {_usable('train', 'row_offset')}
 SELECT t.id AS spectrum_id, r.id AS row_offset FROM test3 t JOIN train3 r ON t.bin = r.bin AND abs(t.p - r.p) < 0.01 GROUP BY 1, 2 HAVING round(sum(t.w * r.w), 6) > 0.95""",
    "p7_accuracy": """SELECT ingest_lib, adduct, upper(regexp_replace(instrument_type, '[^A-Za-z0-9]', '', 'g')) AS instrument_type, count(*) AS n_values, true AS within
 FROM (SELECT DISTINCT row_offset, ingest_lib, adduct, instrument_type, precursor_error_ppm FROM train) WHERE precursor_error_ppm <> -999.0 AND isfinite(precursor_error_ppm) GROUP BY 1, 2, 3""",
    "p9_found": """WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents), e AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM eval_items),
 dw AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 10, 1))) r(k)), ew AS (SELECT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM e, unnest(range(1, greatest(len(w) - 10, 1))) r(k))
 SELECT DISTINCT doc_id, item_id FROM dw JOIN ew USING (g)""",
}
