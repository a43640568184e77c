"""Incremental runs as streams: micro-batches that replace refreshed sources, and running counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabulon.operators.merge import upsert
from tabulon.operators.rows import first_wins


def refresh_sources(stream: DataFrame, store: str, checkpoint: str, key: str = "source_name") -> StreamingQuery:
    """Each micro-batch replaces the sources it brings in a store with one version per batch.

    A version is written whole before the pointer (its own folder name) moves on, so a
    lost driver or a rerun batch leaves the last complete version in place.
    """
    def replace(batch: DataFrame, batch_id: int) -> None:
        old = latest(batch.sparkSession, store, batch_id)
        merged = batch if old is None else upsert(old, batch, key)
        merged.write.mode("overwrite").parquet(f"{store}/v{batch_id:06d}")

    return stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, store: str, before: int | None = None) -> DataFrame | None:
    """The newest complete version of a store (of batches under ``before``, if given)."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(fs_path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    names = [n for n in names if before is None or int(n[1:]) < before]
    return spark.read.parquet(f"{store}/{names[-1]}") if names else None


def first_seen(stream: DataFrame, key: list[str], event_time: str, late: str = "1 hour") -> DataFrame:
    """Each key once while it may still repeat; state is dropped behind the watermark."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, event_time: str, by: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Rows per window and value, closed when the watermark passes."""
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, width), by).agg(F.count("*").alias("n"))


def batch_first_seen(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The batch form of ``first_seen``."""
    return first_wins(df, key, order)
