"""Readers of the Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """The Parquet table `name` under `sf_dir`.

    With `spread`, for stages that compute much per row, a table that has fewer splits than the session has cores is dealt out to all of them; larger tables
    have more splits than that and are read as they are, without a shuffle.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


BUCKET = 32_768  # bits in a bucket of Spark's bitmap functions


def bit_table(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, bits): a bit table of `bits` bits in which the hashes of a column's values are set; at most bits / BUCKET rows of 4 KB, whatever the values are."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    return keys.select(slot.alias("_slot")).distinct().groupBy(F.bitmap_bucket_number("_slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("bits"))


def screened(df: DataFrame, key: Column, table: DataFrame, bits: int) -> DataFrame:
    """`df` with `_maybe`: whether the key's bit is set in a `bit_table`; true for every key that was put in and for few others. No shuffle: the table's size is fixed and it is broadcast."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    of = df.withColumn("_slot", slot).withColumn("_bucket", F.bitmap_bucket_number(F.col("_slot") + 1))
    j = of.join(F.broadcast(table.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))), "_bucket", "left")
    at = F.bitmap_bit_position(F.col("_slot") + 1).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), at % 8)) != 0
    return j.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_slot", "_bucket", "_bits")


def once(df: DataFrame, keys: list[str], bits: int = 1 << 23) -> DataFrame:
    """One row per key, without shuffling the rows of keys that come once.

    Keys alone are counted (map-side first); those that come again set a bit in a table of fixed size (1 MB), and only rows whose bit is set are brought together.
    Which of several rows stays is open, so they should be equal as repeated deliveries are. Rows with a NULL key form one key. An empty table stays empty.
    """
    h = "_key_hash"
    hashed = df.withColumn(h, F.xxhash64(*keys))
    again = hashed.groupBy(h).agg(F.count("*").alias("_n")).filter("_n > 1")
    j = screened(hashed, F.col(h), bit_table(again, h, bits), bits).drop(h)
    return j.filter("NOT _maybe").unionByName(j.filter("_maybe").dropDuplicates(keys)).drop("_maybe")


def latest(df: DataFrame, keys: list[str], order: str = "ingested_at") -> DataFrame:
    """One row per key: the first delivery by `order`.

    Repeated deliveries are equal but for their arrival time, so the choice changes no content.
    Rows with a NULL key form one key. An empty table stays empty.
    """
    w = W.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())
    return df.withColumn("_delivery", F.row_number().over(w)).filter("_delivery = 1").drop("_delivery")
