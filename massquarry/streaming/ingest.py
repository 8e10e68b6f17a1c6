"""Incremental ingestion of spectrum files: the same transformations as in batch, exactly once per file.

The reference data flow is bounded; a file-source stream with an available-now trigger and a checkpoint takes the place
of markers for finished chunks. Windows over event time are an extension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from massquarry.operators import spectra


def spectrum_features(df: DataFrame, mz: str = "ms2_mzs", intensity: str = "ms2_normalized_intensities", precursor: str = "precursor_mz") -> DataFrame:
    """Identifying columns, validity flags and shape features; peaks are read once and left behind."""
    keep = [c for c in df.columns if c not in (mz, intensity)]
    flags = spectra.flags(F.col(mz), F.col(intensity), F.col(precursor))
    rows = df.select(*keep, *(c.alias(f"flag_{k}") for k, c in flags.items()), spectra.peaks(F.col(mz), F.col(intensity)).alias("peaks__"))
    return rows.select(*keep, *(f"flag_{k}" for k in flags), *(c.alias(k) for k, c in spectra.features(F.col("peaks__"), F.col(precursor)).items() if k not in keep))


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_trigger: int = 64) -> StreamingQuery:
    """All files of source that were not yet taken, into target; returns the started query, which ends by itself."""
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    return spectrum_features(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)


def first_deliveries(stream: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """Records without later deliveries of the same key within the lateness; state is bounded by the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, at: str, group: str, window: str = "1 day", slide: str | None = None, late: str = "2 days") -> DataFrame:
    """Counts and sums per event-time window and group; works on streams and on tables."""
    w = F.window(at, window, slide) if slide else F.window(at, window)
    src = events.withWatermark(at, late) if events.isStreaming else events
    return src.groupBy(w.alias("w"), group).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), group, "n", "total")


def sessions(events: DataFrame, at: str, group: str, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    """Sessions per group that end after a gap."""
    src = events.withWatermark(at, late) if events.isStreaming else events
    return src.groupBy(F.session_window(at, gap).alias("w"), group).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), group, "n")
