"""Incremental runs as streams: new samples are appended once, events are counted in windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_samples(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 16) -> DataFrame:
    """New JSON-lines files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def append_once(samples: DataFrame, target: str, checkpoint: str, key: str = "id", order: str = "ordinal") -> StreamingQuery:
    """Append samples to a Parquet table, each key once; a batch that is run again after a failure changes nothing.

    Each batch is written to a folder of its own number, so a repeated batch overwrites itself; keys that earlier batches wrote are left out.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.groupBy(key).agg(F.min_by(F.struct(*batch.columns), order).alias("r")).select("r.*")
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        root = hadoop.Path(target)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        before = [f"{target}/{s.getPath().getName()}" for s in fs.listStatus(root) if s.getPath().getName().startswith("batch=") and int(s.getPath().getName()[6:]) < number] if fs.exists(root) else []
        if before:
            fresh = fresh.join(spark.read.parquet(*before).select(key), key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return samples.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def window_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events, users and value per tumbling window and type; on streams late rows within the watermark count."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    g = e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("users") if events.isStreaming else F.count_distinct("user_id").alias("users"), F.sum("value").alias("value"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "users", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of each user: events no further apart than `gap`."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("s.start").alias("start"), "n")
