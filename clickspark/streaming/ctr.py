"""Incremental click-through rate per event-time window.

Two shapes:

* ``run_hourly_ctr`` (exact, used by the registered query): ``readStream`` over
  the event files; every micro-batch aggregates ITS OWN rows per window and
  writes that partial result to ``<changelog>/batch_id=N`` (overwritten if the
  batch is retried, so each batch counts exactly once). The current table is
  the sum of the partials per window, one grouped aggregate. No state store is
  needed, and rows arriving late are added to their window instead of being
  dropped or re-counted.
* ``hourly_ctr_stream``: Spark's stateful windowed aggregate with a watermark,
  for live sinks in update mode (dashboards). Its rows are running values per
  window; Structured Streaming does not promise to drop rows older than the
  watermark, and a late row for an evicted window restarts that window's
  count, so its output must not be consolidated by "latest row wins".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.session import scratch_path


def _epoch_ntz():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_instant(c):
    """Wall-clock TIMESTAMP_NTZ -> TIMESTAMP instant read as UTC, whatever the
    session time zone (watermarks need TIMESTAMP)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), c))


def instant_to_ntz(c):
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())


#: Input of one micro-batch unless a number of files is given: many small files
#: share a batch, and a backlog is still cut into bounded ones.
MAX_BYTES_PER_TRIGGER = 64 << 30


def file_stream(spark: SparkSession, source_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream over parquet files. ``source_path`` may be a folder (new files
    arriving in it) or a file/glob inside one; the schema is taken from the files
    present now and fixed for the stream."""
    schema = spark.read.parquet(source_path).schema
    reader = spark.readStream.schema(schema)
    reader = (reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger
              else reader.option("maxBytesPerTrigger", MAX_BYTES_PER_TRIGGER))
    folder, name = source_path.rstrip("/").rsplit("/", 1)
    if name.endswith(".parquet") and not any(ch in name for ch in "*?[{"):
        # the file source treats a plain path as its own base folder; an exact
        # one-file glob keeps the real folder as the base
        source_path = f"{folder}/[{name[0]}]{name[1:]}"
        reader = reader.option("basePath", folder)
    return reader.parquet(source_path)


def click_label(event_type: str = "event_type", click_value: str = "click"):
    return (F.col(event_type) == click_value).cast("int")


def window_counts(events: DataFrame, window: str = "1 hour", label_expr=None) -> DataFrame:
    """(window_start, n, clicks) of a batch of events; window_start keeps the type of ``ts``."""
    label = label_expr if label_expr is not None else click_label()
    return (events.groupBy(F.window("ts", window).start.alias("window_start"))
                  .agg(F.count(F.lit(1)).alias("n"), F.sum(label).cast("bigint").alias("clicks")))


def hourly_ctr_stream(events: DataFrame, window: str = "1 hour", watermark: str = "2 hours",
                      label_expr=None) -> DataFrame:
    """Stateful running aggregate with a watermark (bounded state) for live update-mode sinks."""
    label = label_expr if label_expr is not None else click_label()
    ts = F.col("ts")
    is_ntz = dict(events.dtypes).get("ts") == "timestamp_ntz"
    return (events.select((ntz_to_instant(ts) if is_ntz else ts).alias("et"), label.alias("label"))
                  .withWatermark("et", watermark)
                  .groupBy(F.window("et", window).alias("w"))
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("clicks"))
                  .select((instant_to_ntz(F.col("w.start")) if is_ntz else F.col("w.start")).alias("window_start"),
                          "n", "clicks"))


def consolidate_changelog(changelog: DataFrame) -> DataFrame:
    """Sum the per-batch partials: (window_start, n, clicks, ctr)."""
    tot = changelog.groupBy("window_start").agg(F.sum("n").cast("bigint").alias("n"),
                                                F.sum("clicks").cast("bigint").alias("clicks"))
    return tot.select(F.col("window_start").cast("string").alias("window_start"), "n", "clicks",
                      F.try_divide(F.col("clicks"), F.col("n")).alias("ctr"))


def run_hourly_ctr(spark: SparkSession, source_path: str, changelog_path: str | None = None,
                   checkpoint_path: str | None = None, max_files_per_trigger: int | None = None,
                   window: str = "1 hour") -> DataFrame:
    """Process everything available now, then return the consolidated table."""
    stream = file_stream(spark, source_path, max_files_per_trigger)
    changelog_path = changelog_path or scratch_path(spark, "ctr-changelog")
    checkpoint_path = checkpoint_path or scratch_path(spark, "ctr-stream-ckpt")

    def write_batch(batch: DataFrame, batch_id: int):
        # overwrite: a retried batch replaces its own partial instead of adding a second one
        window_counts(batch, window).write.mode("overwrite").parquet(f"{changelog_path}/batch_id={batch_id}")

    q = (stream.writeStream.option("checkpointLocation", checkpoint_path)
         .foreachBatch(write_batch).trigger(availableNow=True).start())
    q.awaitTermination()
    folder = spark._jvm.org.apache.hadoop.fs.Path(changelog_path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        changelog = spark.read.parquet(changelog_path)
    else:                       # no micro-batch ran: nothing was written
        changelog = spark.createDataFrame([], "window_start timestamp_ntz, n bigint, clicks bigint")
    return consolidate_changelog(changelog)
