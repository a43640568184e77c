"""Streaming queries and whole runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions import segments as seg
from tabulon.operators import quality, rows
from tabulon.plans.sched import ORDER, SCHED_SQL, read, sched
from tabulon.sources.scratch import kept, shared_folder
from tabulon.streaming import incremental

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("{sched}", SCHED_SQL)
        return f
    return add


@query("""WITH {sched} SELECT source_name, count(*) AS n FROM sched WHERE (source_name NOT IN ('src-0', 'src-2') AND k7 < TIMESTAMP '1995-06-17')
  OR (source_name IN ('src-0', 'src-2') AND k7 >= TIMESTAMP '1995-06-17') GROUP BY ALL""")
def stream_refresh_upsert(spark, sf_dir):
    """Two micro-batches through a file stream: the second replaces the sources it brings."""
    base = shared_folder(spark, "refresh")
    df, cut = sched(spark, sf_dir).select("source_name", "faculty", "k1", "k2", "k7"), F.lit("1995-06-17").cast("timestamp")
    parts = [df.where(F.col("k7") < cut), df.where((F.col("k7") >= cut) & F.col("source_name").isin("src-0", "src-2"))]
    for part in parts:
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{base}/in")
        incremental.refresh_sources(stream, f"{base}/store", f"{base}/checkpoint").awaitTermination()
    return incremental.latest(spark, f"{base}/store").groupBy("source_name").agg(F.count("*").alias("n"))


@query("SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, sf_dir):
    """Daily event counts through a stream whose windows all close."""
    base = shared_folder(spark, "windows")
    e = read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    last = e.agg((F.max("ts") + F.expr("INTERVAL 10 DAYS")).alias("ts")).withColumn("event_type", F.lit("end"))
    e.write.parquet(f"{base}/in")
    source = lambda: spark.readStream.schema(e.schema).parquet(f"{base}/in")
    for _ in range(2):  # the end marker moves the watermark past every window
        counts = incremental.windowed_counts(source(), "ts", "event_type", "1 day", "0 seconds")
        out = counts.select("event_type", F.col("window.start").alias("day"), "n")
        out.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        last.write.mode("append").parquet(f"{base}/in")
    done = spark.read.parquet(f"{base}/out").where("event_type <> 'end'")
    return done.select("event_type", F.col("day").cast("timestamp_ntz").alias("day"), "n")


@query()
def full_row_quality(spark, sf_dir):
    """Schedule rows through the whole quality chain: flags, severity, confidence, routing, demotion."""
    df = rows.first_wins(sched(spark, sf_dir), ["doc", "sheet_name", "day", "start_time", "subject", "course"], list(ORDER))
    # kept: flags read the rows once for themselves and once for the texts of each column
    about = ["source_name", "faculty", "program", "doc", "sheet_name", "day", "start_time", "end_time", "subject", "teacher", "room", "course", "groups"]
    df = quality.flagged(kept(df.select(about), "quality-rows"), notes=None)
    has = [F.col(c) != "" for c in ("day", "start_time", "end_time", "subject")]
    df = df.withColumn("confidence", quality.confidence(*has, F.size("flags")))
    df = df.withColumn("accepted", quality.accepted(F.col("flags"), F.col("confidence"), ["day", "start_time", "end_time", "subject"])).drop("confidence")
    # kept: demotion reads flagged rows for bare groups, for buckets and for the result; these rows have neither links nor notes
    df = kept(df.withColumn("notes", F.lit("")), "quality-flagged")
    bare = F.col("sheet_name").startswith("pdf") & (F.concat("teacher", "room") == "")
    df = quality.demoted(df, ["doc", "sheet_name", "day", "start_time", "end_time", "course", "groups"], bare, seg.is_fragment_subject(F.trim("subject")))
    return df.groupBy("source_name", quality.severity(F.col("flags")).alias("severity"), "accepted", F.array_join("flags", ",").alias("flags")).agg(F.count("*").alias("n"))
