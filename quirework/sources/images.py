"""Embedded images of a parse: decoded, named by page, and found again by their references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Endings that are kept; others become .png.
SUFFIXES = (".png", ".jpg", ".jpeg", ".webp", ".bmp", ".gif")


def slashed(ref: Column) -> Column:
    return F.replace(ref, F.lit("\\"), F.lit("/"))


def base_name(ref: Column) -> Column:
    return F.regexp_extract(slashed(ref), r"([^/]*)$", 1)


def _ways(ref: Column) -> Column:
    """A reference in the order in which it is tried: as it is, with slashes, its last part."""
    return F.array(F.struct(F.lit(0).alias("way"), ref.alias("key")), F.struct(F.lit(1).alias("way"), slashed(ref).alias("key")), F.struct(F.lit(2).alias("way"), base_name(ref).alias("key")))


def resolve(refs: DataFrame, known: DataFrame, value: str) -> DataFrame:
    """`refs` (journal_id, ref) with the `value` of the known reference (journal_id, ref, ordinal, value) that it means; NULL for none.

    An equal reference goes first, then one that is equal with slashes, then one of the same last part; among several the first by ordinal. Repeated refs come once.
    """
    r = refs.select("journal_id", "ref").filter("ref <> ''").distinct()
    k = known.select("journal_id", F.explode(_ways(F.col("ref"))).alias("k"), "ordinal", F.col(value).alias("_v")).select("journal_id", "k.*", "ordinal", "_v")
    tried = r.select("journal_id", "ref", F.explode(_ways(F.col("ref"))).alias("k")).select("journal_id", "ref", "k.*")
    hit = tried.join(k, ["journal_id", "way", "key"]).groupBy("journal_id", "ref").agg(F.min_by("_v", F.struct("way", "ordinal")).alias(value))
    return r.join(hit, ["journal_id", "ref"], "left")


def extracted(images: DataFrame, refs: DataFrame) -> DataFrame:
    """Decoded images with their page, number on it and file name.

    `images`: journal_id, ordinal, name, data (base64, a data: prefix is passed over); `refs`: journal_id, ref, ordinal, page_index of the items that show them. Images that don't
    decode are left out; those without a reference have page NULL and are numbered by themselves.
    """
    raw = images.withColumn("content", F.try_to_binary(F.regexp_replace("data", r"^data:[^,]*,", ""), F.lit("base64"))).filter("length(content) > 0")
    page = resolve(raw.select("journal_id", F.col("name").alias("ref")), refs, "page_index").withColumnRenamed("ref", "name")
    j = raw.join(page, ["journal_id", "name"], "left")
    n = F.row_number().over(W.partitionBy("journal_id", "page_index").orderBy("ordinal"))
    end = F.lower(F.regexp_extract(base_name(F.col("name")), r"(\.[^.]*)$", 1))
    name = F.concat(F.lit("p"), F.coalesce(F.lpad(F.col("page_index").cast("string"), 3, "0"), F.lit("unknown")), F.lit("_img"), F.lpad(F.col("image_no").cast("string"), 3, "0"), F.when(end.isin(*SUFFIXES), end).otherwise(".png"))
    return j.withColumn("image_no", n).withColumn("file_name", name).select("journal_id", "ordinal", "name", "page_index", "image_no", "file_name", "content")


def missing_files(samples: DataFrame, files: DataFrame) -> DataFrame:
    """(ordinal, image) of sample images that are no file of `files` (path)."""
    return samples.select("ordinal", F.explode("images").alias("image")).join(files.select(F.col("path").alias("image")).distinct(), "image", "left_anti").select("ordinal", "image")
