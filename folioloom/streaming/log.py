"""Streaming forms: the change log as it arrives, and windows over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.changes import apply_changes


def arriving(spark: SparkSession, folder: str, schema: StructType, per_trigger: int = 16) -> DataFrame:
    """New files of change lines as a stream, however late; repeats are left to ``keep_current``."""
    lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)
    return lines.withColumn("received_at", F.col("received_at").cast("timestamp"))


def keep_current(lines: DataFrame, base: DataFrame, log_path: str, out_path: str, fields: list[str], checkpoint: str) -> StreamingQuery:
    """Appends each batch to the log and rebuilds the current table from it. A
    batch replayed after a failure overwrites its own part of the log, so every
    change is applied once."""

    def step(batch: DataFrame, n: int) -> None:
        # Repeats are told from the log itself, so a first arrival counts however late it is.
        batch = batch.dropDuplicates(["op_seq"])
        if n > 0:
            kept = batch.sparkSession.read.option("basePath", log_path).parquet(f"{log_path}/batch=*")
            batch = batch.join(kept.filter(F.col("batch") != n).select("op_seq"), "op_seq", "left_anti").select(*batch.columns)
        batch.write.mode("overwrite").parquet(f"{log_path}/batch={n}")
        log = batch.sparkSession.read.option("basePath", log_path).parquet(f"{log_path}/batch=*")
        apply_changes(base, log.drop("batch"), fields).write.mode("overwrite").parquet(out_path)

    return lines.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windows(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of events by type in tumbling windows; runs on a stream or a table."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    w = F.window("ts", size)
    return marked.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))
