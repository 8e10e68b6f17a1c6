"""Queries: the stream transformations over the whole tables, in batch, where SQL can check them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from massquarry.plans import domain as D
from massquarry.streaming import ingest


def s01_daily_windows(spark: SparkSession, d: str) -> DataFrame:
    w = ingest.windowed_counts(D.table(spark, d, "events"), "ts", "event_type")
    return w.select("window_start", "event_type", "n", F.round("total", 4).alias("total"))


def s02_sliding_windows(spark: SparkSession, d: str) -> DataFrame:
    w = ingest.windowed_counts(D.table(spark, d, "events"), "ts", "event_type", "2 days", "1 day")
    return w.select("window_start", "event_type", "n", F.round("total", 4).alias("total"))


def s03_sessions(spark: SparkSession, d: str) -> DataFrame:
    return ingest.sessions(D.table(spark, d, "events"), "ts", "user_id", "12 hours").select("user_id", "session_start", "n")


def s04_spectrum_stream(spark: SparkSession, d: str) -> DataFrame:
    t = D.table(spark, d, "train").select("row_offset", "precursor_mz", "ms2_mzs", "ms2_normalized_intensities").dropDuplicates(["row_offset"])
    f = ingest.spectrum_features(t)
    return f.select("row_offset", "n_peaks", F.round("total_intensity", 4).alias("total_intensity"), "flag_empty", "flag_length_mismatch")


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("s0") and callable(v)}

ORACLE = {
    "s01_daily_windows": "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts IS NOT NULL GROUP BY 1, 2",
    "s02_sliding_windows": "SELECT (date_trunc('day', ts) - to_days(k::INT))::TIMESTAMP AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, range(2) g(k) WHERE ts IS NOT NULL GROUP BY 1, 2",
    "s03_sessions": """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOURS THEN 0 ELSE 1 END AS new FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL),
 s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM e) SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, s""",
    "s04_spectrum_stream": """WITH t AS (SELECT DISTINCT row_offset, ms2_mzs AS m, ms2_normalized_intensities AS i FROM train),
 p AS (SELECT row_offset, count(*) AS n, sum(b) AS s FROM (SELECT row_offset, unnest(m) AS a, unnest(i) AS b FROM t WHERE len(m) = len(i)) WHERE a IS NOT NULL AND b IS NOT NULL AND isfinite(a) AND isfinite(b) AND a >= 0 AND b >= 0 GROUP BY 1)
 SELECT row_offset, CASE WHEN len(m) = len(i) THEN coalesce(n, 0) END::INT AS n_peaks, CASE WHEN len(m) = len(i) THEN round(coalesce(s, 0), 4) END AS total_intensity, coalesce(len(m), 0) = 0 AS flag_empty, coalesce(len(m), 0) <> coalesce(len(i), 0) AS flag_length_mismatch FROM t LEFT JOIN p USING (row_offset)""",
}
