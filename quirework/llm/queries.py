"""The pN_ queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import confusables, languages, leakage, markup, near_duplicates, packing, pairs, repetition, scan_noise, splitting
from quirework.sources.tables import once, table

Query = Callable[[SparkSession, str], DataFrame]


def limit_of(spark: SparkSession, sf_dir: str, field: str) -> tuple[int, int]:
    """(max_size, overlap) of a field."""
    row = table(spark, sf_dir, "size_limits").filter(F.col("field_name") == field).first()
    return int(row["max_size"]), int(row["overlap"])


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise.records(*(table(spark, sf_dir, t, spread=t != "journals") for t in ("journal_pages", "journal_blocks", "journals")))


def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page and block text as continuous paragraphs, with the noise it had."""
    pages, blocks, journals = (table(spark, sf_dir, t, spread=t != "journals") for t in ("journal_pages", "journal_blocks", "journals"))
    return scan_noise.repair(scan_noise.records(once(pages, ["page_uid"]), once(blocks, ["block_uid"]), journals))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise.noise(_scanned(spark, sf_dir)).select("rec", "rec_uid", F.explode("kinds").alias("noise")).distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.marks(table(spark, sf_dir, "journal_blocks", spread=True), "block_uid", ["text", "markdown"]).withColumnRenamed("uid", "block_uid")


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean text and typed segments of every field with marks."""
    return markup.clean(once(table(spark, sf_dir, "journal_blocks", spread=True), ["block_uid"]), "block_uid", ["text", "markdown"]).withColumnRenamed("uid", "block_uid")


def p2_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the runs that other pages of their journal repeat."""
    return markup.repeated_runs(once(table(spark, sf_dir, "journal_pages", spread=True), ["page_uid"]), "journal_id", "page_uid", "full_text").filter("covered > 0")


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample id: its class and number of links. Samples that are not compared (no answer of 200 characters) have neither text nor class, and no links."""
    samples = table(spark, sf_dir, "samples", spread=True)
    compared = near_duplicates.classes(*near_duplicates.links(samples, "id", "instruction", "answer"))
    return samples.select("id").distinct().join(compared, "id", "left").fillna(0, ["n_links"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.pairs(*near_duplicates.links(table(spark, sf_dir, "samples", spread=True), "id", "instruction", "answer"))


def _named(spark: SparkSession, sf_dir: str, single: bool = False) -> DataFrame:
    """The texts of problem 4; with `single` each delivery of a key once."""
    read = lambda name, key: once(table(spark, sf_dir, name, spread=True), [key]) if single else table(spark, sf_dir, name, spread=True)
    blocks = read("journal_blocks", "block_uid").select(F.lit("block").alias("rec"), F.col("block_uid").alias("rec_uid"), F.lit("text").alias("field_name"), "text")
    articles = read("articles", "article_uid")
    titles = articles.select(F.lit("article").alias("rec"), F.col("article_uid").alias("rec_uid"), F.lit("article_title").alias("field_name"), F.col("article_title").alias("text"))
    keywords = articles.select(F.lit("article").alias("rec"), F.col("article_uid").alias("rec_uid"), F.lit("keywords").alias("field_name"), F.explode("keywords").alias("text"))
    return blocks.unionByName(titles).unionByName(keywords)


def p4_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text, title and keyword in one form, whole-script lookalikes of the records' words included."""
    return confusables.unify(confusables.examine(_named(spark, sf_dir, single=True)))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusables.settle(confusables.examine(_named(spark, sf_dir)))


def p5_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair's defect and the shares of its clauses' tags; repeated deliveries once."""
    samples = table(spark, sf_dir, "samples", spread=True)
    return pairs.defects(samples, pairs.fit(samples)).distinct()


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "samples", spread=True)
    return pairs.defects(samples, pairs.fit(samples)).filter("defect IS NOT NULL").select("id", "defect").distinct()


def _pieces(spark: SparkSession, sf_dir: str, single: bool = False) -> DataFrame:
    read = lambda name, key: once(table(spark, sf_dir, name, spread=True), [key]) if single else table(spark, sf_dir, name, spread=True)
    page, article = limit_of(spark, sf_dir, "journal_pages.full_text"), limit_of(spark, sf_dir, "articles.abstract")
    pages = splitting.split(read("journal_pages", "page_uid"), "page_uid", "full_text", *page)
    articles = splitting.split(read("articles", "article_uid"), "article_uid", "abstract", *article)
    both = pages.withColumn("rec", F.lit("page")).unionByName(articles.withColumn("rec", F.lit("article")))
    return both.withColumnRenamed("id", "rec_uid")


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every page and abstract; repeated deliveries once."""
    return _pieces(spark, sf_dir, single=True).select("rec", "rec_uid", "piece", "n_pieces", "char_start", "char_end", "new_start", "cut", "text")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir).filter("cut <> 'whole'").select("rec", "rec_uid", "cut").distinct()


def _profiles(samples: DataFrame) -> DataFrame:
    return repetition.profile(samples, "id", ["answer", "text"])


def p7_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples' fields outside their script's bands, or repetitive, with the reasons."""
    return repetition.rejected(_profiles(once(table(spark, sf_dir, "samples", spread=True), ["id"]))).filter(F.size("reasons") > 0)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(table(spark, sf_dir, "samples", spread=True)).filter(F.col("repeated_share") >= repetition.SHARE).select("id", "field_name").distinct()


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document and piece."""
    return packing.pack(table(spark, sf_dir, "documents"), limit_of(spark, sf_dir, "documents.text")[0])


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_containers(spark, sf_dir).filter("n_pieces > 1").select("doc_id").distinct()


def p9_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and items that overlap exactly or with substitutions."""
    return leakage.overlaps(table(spark, sf_dir, "documents", spread=True), table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_overlaps(spark, sf_dir).filter(F.col("exact_run") >= leakage.MIN_RUN).select("doc_id", "item_id")


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's stretches with language and confidence."""
    docs = table(spark, sf_dir, "documents", spread=True)
    return languages.segments(docs, languages.fit(docs))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True)
    return languages.found(docs, languages.fit(docs))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_repaired, p1_found, p2_found, p2_clean, p2_boilerplate, p4_normalized, p4_found, p3_links, p3_found, p5_defects, p5_found, p6_pieces, p6_found, p7_fertility, p7_found, p8_containers, p8_found, p9_overlaps, p9_found, p10_segments, p10_found)}
