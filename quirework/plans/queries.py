"""The core's queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import responses
from quirework.functions import text as T
from quirework.operators import generation, layout, links, pages, quality, routing, samples
from quirework.sources import readers
from quirework.sources.tables import table
from quirework.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
PAGE = layout.PAGE


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return layout.boxes(layout.deliver_once(table(spark, d, "journal_blocks")))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return pages.one_page(table(spark, d, "journal_pages"))


def _assigned(spark: SparkSession, d: str) -> DataFrame:
    return layout.assign_columns(_blocks(spark, d))


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples")


def valid_boxes(spark, d):
    """PRJ-2, PRJ-3, SCL-10."""
    b = _blocks(spark, d)
    return b.select("block_uid", "top", "left", F.coalesce((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")), F.lit(0.0)).alias("area"))


def page_sizes(spark, d):
    """PRJ-7, AGG-2."""
    return layout.page_sizes(_blocks(spark, d))


def block_roles(spark, d):
    """PRJ-8, SCL-6, SCL-7."""
    return layout.roles(_blocks(spark, d)).select("block_uid", "role")


def caption_labels(spark, d):
    """PRJ-5, SCL-6: canonical types and labels."""
    t = T.clean_text("text")
    return _blocks(spark, d).select("block_uid", readers.block_type(F.col("block_type")).alias("block_type"), T.caption_kind(t).alias("kind"), T.caption_label(t).alias("label"))


def column_bands(spark, d):
    """AGG-3, WIN-3."""
    return layout.column_bands(_blocks(spark, d))


def column_assignment(spark, d):
    """WIN-4."""
    return _assigned(spark, d).select("block_uid", "col_index", "col_label", "span")


def column_modes(spark, d):
    """AGG-4, SCL-9."""
    return layout.column_modes(_assigned(spark, d))


def reading_order(spark, d):
    """WIN-2, WIN-5, PRD-1."""
    return layout.reading_order(_assigned(spark, d).withColumn("role", F.col("semantic_role"))).select("block_uid", "new_order")


def reading_order_check(spark, d):
    """WIN-6 over the recovered order."""
    o = layout.reading_order(_assigned(spark, d).withColumn("role", F.col("semantic_role")))
    return layout.order_check(o, "new_order")


def page_types(spark, d):
    """PRJ-9, PRD-3, AGG-6."""
    return pages.page_types(_blocks(spark, d))


def visible_blocks(spark, d):
    """PRD-1, PRD-2."""
    return pages.visible_blocks(_blocks(spark, d), _pages(spark, d)).select("block_uid", F.length("shown").alias("n_chars"))


def paragraphs(spark, d):
    """WIN-7."""
    return pages.paragraphs(pages.visible_blocks(_blocks(spark, d), _pages(spark, d)))


def page_texts(spark, d):
    """AGG-5."""
    return pages.page_texts(paragraphs(spark, d))


def article_spans(spark, d):
    """WIN-8."""
    return pages.article_spans(_pages(spark, d))


def page_articles(spark, d):
    """JN-2, WIN-14."""
    p = _pages(spark, d)
    return pages.page_articles(p, pages.article_spans(p))


def article_metadata(spark, d):
    """PRJ-10, SCL-8."""
    m = pages.article_metadata(_blocks(spark, d), _pages(spark, d))
    return m.withColumn("keywords", F.array_join("keywords", "|"))


def page_neighbours(spark, d):
    """PRJ-11."""
    return pages.neighbours(_pages(spark, d))


def nearest_captions(spark, d):
    """JN-3, SUP-1."""
    return links.nearest_captions(_blocks(spark, d)).select("block_uid", "caption_uid", "rank")


def same_label_blocks(spark, d):
    """JN-5."""
    return links.same_label(_blocks(spark, d)).select("block_uid", "label", "other_uid", "rank")


def subfigure_groups(spark, d):
    """WIN-12."""
    b = _blocks(spark, d).filter("block_type = 'figure' AND x0 IS NOT NULL")
    g = links.subfigure_groups(b)
    return g.withColumn("members", F.array_join("members", "|")).withColumn("marks", F.array_join("marks", "|"))


def visual_links(spark, d):
    """SUP-1, JN-3, JN-5."""
    return links.visual_links(_blocks(spark, d)).select("block_uid", "label", F.array_join("captions", "|").alias("captions"), F.array_join("related", "|").alias("related"))


def barriers(spark, d):
    """JN-13, WIN-13."""
    return links.barriers(_blocks(spark, d)).select("block_uid", "n_left", "n_right")


def crop_boxes(spark, d):
    """PRD-7."""
    return links.crop_boxes(_blocks(spark, d))


def uncertainty_notes(spark, d):
    """PRJ-12."""
    a = _assigned(spark, d)
    return pages.uncertainty(layout.column_modes(a), a)


def truncated_texts(spark, d):
    """SCL-2, SCL-11."""
    return _pages(spark, d).select("page_uid", T.truncate_text(F.col("full_text"), 180).alias("short"), T.truncate_at_break(F.col("full_text"), 400).alias("cut"))


def visual_containment(spark, d):
    """PRD-10, JN-14."""
    return links.inside_visual(_blocks(spark, d)).select("block_uid", "kept")


def page_jobs(spark, d):
    """RTE-1, 2, 3 (by columns and notes), 7, 8, PRD-4, PRD-5."""
    return routing.page_jobs(_pages(spark, d))


def linked_page_jobs(spark, d):
    """RTE-3 by visual links, beyond the pages of page_jobs."""
    return routing.linked_page_jobs(_blocks(spark, d), _pages(spark, d))


def visual_jobs(spark, d):
    """RTE-6."""
    return routing.visual_jobs(_blocks(spark, d), _pages(spark, d))


def sections(spark, d):
    """JN-7, WIN-10."""
    return routing.sections(_blocks(spark, d)).select("heading_uid", "n_blocks", "n_chars")


def section_jobs(spark, d):
    """RTE-4, RTE-5 of headings."""
    return routing.section_jobs(_blocks(spark, d), _pages(spark, d)).select("heading_uid", "task_type")


def unheaded_page_jobs(spark, d):
    """RTE-5 of pages without headings."""
    return routing.unheaded_page_jobs(_blocks(spark, d), _pages(spark, d))


def page_windows(spark, d):
    """WIN-9, RTE-9."""
    return routing.page_windows(_pages(spark, d)).select(*PAGE, F.array_join(F.transform("window", lambda x: x.cast("string")), "|").alias("window"))


def article_jobs(spark, d):
    """RTE-10."""
    return routing.article_jobs(_pages(spark, d))


def corpus_windows(spark, d):
    """WIN-11, RTE-11."""
    return routing.corpus_windows(_pages(spark, d)).select("journal_id", "article_id", "first_page", "last_page", "n_pages", "n_chars")


def page_sentences(spark, d):
    """SCL-13, SCL-14: sentences of page texts."""
    t = routing.page_text()
    p = _pages(spark, d).withColumn("t", t)
    return p.select("page_uid", F.size(generation.sentences(F.col("t"), 16)).alias("n"), generation.first_sentence(F.col("t"), 220).alias("first"), F.array_join(generation.sentences_with(F.col("t"), generation.CLAIMS), "|").alias("claims"))


def method_conditions(spark, d):
    """PRJ-23 for method conditions."""
    return generation.method_conditions(_pages(spark, d)).select(*PAGE, *(F.array_join(c, "|").alias(c) for c in ("method_steps", "conditions", "metrics", "variables")))


def claim_chains(spark, d):
    """PRJ-23 for claims."""
    return generation.claim_chains(_pages(spark, d))


def contributions(spark, d):
    """PRJ-23 for articles."""
    return generation.contributions(_pages(spark, d)).select("journal_id", "article_id", "problem", *(F.array_join(c, "|").alias(c) for c in ("contributions", "findings", "conclusions")))


def corpus_samples(spark, d):
    """PRJ-25, SUP-4, PRD-6."""
    p = _pages(spark, d)
    visible = pages.visible_blocks(_blocks(spark, d), p)
    return generation.corpus_samples(routing.corpus_windows(p).drop("win", "n_pages", "n_chars"), pages.paragraphs(visible), p, visible)


def corpus_lines(spark, d):
    """SCL-12: cleaned page text, by length and hash."""
    c = T.clean_corpus_text(F.col("full_text"))
    return _pages(spark, d).select("page_uid", F.length(c).alias("n_chars"), F.sha2(c, 256).alias("hash"))


def sample_ids(spark, d):
    """PRJ-13, SCL-3."""
    s = _samples(spark, d)
    return s.select("ordinal", samples.sample_id(s).alias("made_id"))


def quality_format(spark, d):
    """QLT-1, SCL-15, SCL-16, SCL-17."""
    return samples.text_format_quality(_samples(spark, d))


def quality_relevance(spark, d):
    """QLT-3."""
    return quality.relevance(_samples(spark, d))


def quality_visual(spark, d):
    """QLT-4."""
    return quality.visual_dependency(_samples(spark, d))


def image_pages(spark, d):
    """SCL-20, SET-4: image pages against source pages."""
    return quality.image_pages(_samples(spark, d))


def cross_page_bounds(spark, d):
    """PRD-16."""
    return quality.cross_page_bounds(_samples(spark, d))


def figure_instructions(spark, d):
    """PRD-15."""
    return quality.generic_figure_instruction(_samples(spark, d), table(spark, d, "articles"))


def parsed_responses(spark, d):
    """SCL-18, SCL-19 over the events' property strings and over answers: objects read from each, -1 where there is no object to read."""
    events = table(spark, d, "events").select(F.lit("event").alias("source"), F.col("event_id").cast("string").alias("id"), F.col("props").alias("raw"))
    answers = _samples(spark, d).select(F.lit("sample").alias("source"), F.col("id").cast("string").alias("id"), F.col("answer").alias("raw"))
    raw = events.unionByName(answers)
    return raw.select("source", "id", F.coalesce(F.size(responses.parse_response(responses.strip_reasoning(F.col("raw")))), F.lit(-1)).alias("n"))


def term_overlap(spark, d):
    """SCL-14, JN-15, SET-1, SET-5."""
    return samples.term_overlap(_samples(spark, d))


def dedup_rules(spark, d):
    """DED-1, DED-2, DED-3 one by one."""
    return samples.first_of(_samples(spark, d))


def dedup_near(spark, d):
    """DED-4, JN-12."""
    return samples.near_pairs(_samples(spark, d)).select("a", "b")


def dedup_kept(spark, d):
    """DED-1 to DED-4 together, in order."""
    s = _samples(spark, d)
    return samples.deduplicate(s, samples.near_pairs(s)).select("ordinal")


def export_sharegpt(spark, d):
    """SNK-5."""
    return samples.to_sharegpt(_samples(spark, d)).select("ordinal", "id", F.col("messages")[0]["content"].alias("asked"), F.col("messages")[1]["content"].alias("answered"))


def export_pt(spark, d):
    """SNK-7."""
    return samples.to_pt(_samples(spark, d))


def export_counts(spark, d):
    """SNK-4, AGG-10 with totals."""
    return samples.export_counts(_samples(spark, d))


def evidence_blocks(spark, d):
    """JN-6, PRJ-14."""
    return samples.evidence_blocks(_samples(spark, d), table(spark, d, "journal_blocks"))


def parse_status(spark, d):
    """PRD-11, AGG-8."""
    j = table(spark, d, "journals").groupBy("journal_id").agg(F.max("page_count").alias("page_count"))
    return readers.parse_status(_blocks(spark, d), j)


def pending_pages(spark, d):
    """JN-10, SUP-22: pages without a sample."""
    done = _samples(spark, d).select(F.col("metadata.journal_id").alias("journal_id"), F.col("metadata.page_index").alias("page_index"))
    return samples.pending(_pages(spark, d).select(*PAGE), done, PAGE)


def window_counts(spark, d):
    """Extension: tumbling windows over events."""
    return ingest.window_counts(table(spark, d, "events"))


def user_sessions(spark, d):
    """Extension: sessions over events."""
    return ingest.sessions(table(spark, d, "events"))


def page_roles_count(spark, d):
    """AGG-9: blocks per page and column label, and the share of the page."""
    b = _blocks(spark, d).groupBy(*PAGE, "column_label").agg(F.count("*").alias("n"))
    return b.withColumn("of", F.sum("n").over(W.partitionBy(*PAGE)))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        valid_boxes, page_sizes, block_roles, caption_labels, column_bands, column_assignment, column_modes, reading_order, reading_order_check, page_types, visible_blocks, paragraphs, page_texts,
        article_spans, page_articles, article_metadata, page_neighbours, nearest_captions, same_label_blocks, subfigure_groups, visual_links, barriers, crop_boxes, uncertainty_notes, truncated_texts, visual_containment, page_jobs, linked_page_jobs, visual_jobs, sections, section_jobs, unheaded_page_jobs, page_windows,
        article_jobs, corpus_windows, page_sentences, method_conditions, claim_chains, contributions, corpus_samples, corpus_lines, sample_ids, quality_format, quality_relevance, quality_visual, image_pages, cross_page_bounds, figure_instructions, parsed_responses, term_overlap, dedup_rules, dedup_near, dedup_kept, export_sharegpt, export_pt,
        export_counts, evidence_blocks, parse_status, pending_pages, window_counts, user_sessions, page_roles_count,
    )
}
