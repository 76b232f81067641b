"""The core's queries of tasks: outputs, samples, quality as a whole, exports, sources, resume."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.functions import payloads
from quirework.functions import text as T
from quirework.operators import links, outputs, pages, quality, resume, routing, samples
from quirework.operators.layout import PAGE
from quirework.plans.queries import Query, _blocks, _pages, _samples
from quirework.sources import images, readers
from quirework.sources.tables import table

BUDGET = 3000


def _joined(name: str, sep: str = "|"):
    return F.array_join(name, sep).alias(name)


def _files(spark, d):
    """The image files that the tables name, under their journals."""
    of = lambda name, c: table(spark, d, name).filter(F.col(c) != "").select(F.concat_ws("/", "journal_id", c).alias("path"))
    return of("journal_pages", "page_image").unionByName(of("journal_blocks", "image_path")).distinct()


def visual_objects(spark, d):
    """PRJ-21."""
    return outputs.visual_objects(_blocks(spark, d)).select("block_uid", "n", "description")


def page_descriptions(spark, d):
    """PRJ-22."""
    return outputs.page_descriptions(_blocks(spark, d), _pages(spark, d)).select(*PAGE, "subject", "description", F.size("objects").alias("n_objects"))


def page_outputs(spark, d):
    """PRJ-23 for layouts and reading orders, PRJ-20, SUP-20."""
    o = outputs.page_outputs(_blocks(spark, d), _pages(spark, d))
    regions = F.array_join(F.transform("regions", lambda r: F.concat_ws(":", r["region"], r["block_count"].cast("string"))), "|").alias("regions")
    content = F.array_join(F.transform("content", lambda b: F.concat_ws("=", b["block_id"], b["excerpt"])), "|").alias("content")
    return o.select(*PAGE, regions, content, _joined("noise"), _joined("objects"), "trainable", "restored", _joined("notes"))


def page_lists(spark, d):
    """PRJ-11: ids of a page's titles, figures, tables and formulas; PRJ-14: its evidence."""
    b = _blocks(spark, d)
    pick = lambda cond: F.array_join(outputs._ordered(F.col("block_id"), cond), "|")
    lists = b.groupBy(*PAGE).agg(pick(F.col("semantic_role").isin("article_title", "section_heading")).alias("titles"), *(pick(F.col("block_type") == k).alias(f"{k}s") for k in ("figure", "table", "formula")))
    e = outputs.block_texts(b).select(*PAGE, F.array_join("ids", "|").alias("evidence_ids"), F.size("texts").alias("n_texts"), F.length(F.array_join("texts", "|")).alias("n_chars"))
    return lists.join(e, PAGE)


def heading_outputs(spark, d):
    """PRJ-23 for scopes and key points, PRJ-15 of sections."""
    h = outputs.heading_outputs(_blocks(spark, d), _pages(spark, d))
    return h.select("heading_uid", "heading", _joined("ids"), F.length("controlled").alias("n_controlled"), "scope", "risk", "summary", _joined("terms"), _joined("methods"), _joined("results"))


def heading_answers(spark, d):
    """PRJ-24, PRJ-26: input and answer of key-point summaries."""
    return outputs.heading_answers(outputs.heading_outputs(_blocks(spark, d), _pages(spark, d)))


def visual_outputs(spark, d):
    """PRJ-23 for figures, tables and formulas, JN-6."""
    b = _blocks(spark, d)
    return outputs.visual_outputs(b, routing.visual_jobs(b, _pages(spark, d)), links.visual_links(b)).drop(*PAGE)


def condition_outputs(spark, d):
    """PRJ-23 for methods: object and assumptions."""
    return outputs.condition_outputs(_pages(spark, d)).select(*PAGE, "research_object", _joined("assumptions"))


def claim_outputs(spark, d):
    """PRJ-23 for claims: claim, evidence, support."""
    b = _blocks(spark, d)
    named = links.visual_links(b).select("block_uid", "label").join(b.select(*PAGE, "block_uid", "block_id", "block_ordinal"), "block_uid")
    return outputs.claim_outputs(b, _pages(spark, d), named).select(*PAGE, "claim", _joined("evidence"), _joined("support"))


def window_outputs(spark, d):
    """PRJ-23 for cross-page contexts."""
    p = _pages(spark, d)
    o = outputs.window_outputs(routing.page_windows(p), p)
    return o.select("journal_id", "first_page", "topic", "summary", F.array_join(F.transform("points", lambda x: x["page_index"].cast("string")), "|").alias("pages"))


def metadata_outputs(spark, d):
    """PRJ-23 for metadata, JN-1."""
    return outputs.metadata_outputs(_pages(spark, d), table(spark, d, "articles"), table(spark, d, "journals")).select(*PAGE, "title", _joined("authors"), "journal_name", "year", "volume", "issue", "pages", "doi", "abstract", _joined("keywords"))


def job_metadata(spark, d):
    """PRJ-13: what a sample says of where it comes from, JN-1."""
    p = _pages(spark, d)
    return outputs.job_metadata(routing.page_jobs(p), p, table(spark, d, "articles"), table(spark, d, "journals"))


def page_inputs(spark, d):
    """PRJ-15 of page jobs."""
    p = _pages(spark, d)
    i = outputs.page_inputs(routing.page_jobs(p), p)
    text = lambda c: F.coalesce(F.col(c), F.lit("-")).alias(c)
    return i.select(*PAGE, "task_type", *map(text, ("page_image", "page_type", "column_mode", "ocr_text", "paragraph_text", "article_title", "source_text")), F.coalesce(F.array_join("reading_order", "|"), F.lit("-")).alias("reading_order"))


def article_authors(spark, d):
    """PRJ-10: authors by the block after the title."""
    return pages.article_authors(_blocks(spark, d), _pages(spark, d)).select(*PAGE, _joined("authors"))


def page_note_texts(spark, d):
    """PRJ-12: the notes themselves."""
    from quirework.operators import layout

    a = layout.assign_columns(_blocks(spark, d))
    return pages.uncertainty(layout.column_modes(a), a).select(*PAGE, F.array_join(pages.note_texts("n_notes"), "|").alias("notes"))


def stored_order(spark, d):
    """SUP-9: blocks in the order that the table has for them."""
    from pyspark.sql import Window as W

    b = _blocks(spark, d)
    return b.select("block_uid", F.row_number().over(W.partitionBy(*PAGE).orderBy(pages.order_of(), "top", "left", "block_ordinal")).alias("place"))


def visual_images(spark, d):
    """SUP-3."""
    return links.visual_images(_blocks(spark, d).filter(F.col("block_type").isin(*links.VISUAL)), _pages(spark, d))


def links_or_default(spark, d):
    """SUP-2, PRD-14: the link of each caption and visual block; those without one are bound to themselves."""
    b = _blocks(spark, d)
    have = links.visual_links(b).join(b.select("block_uid", *PAGE, "block_id"), "block_uid").filter("label <> ''")
    return links.links_or_default(b.filter(F.col("block_type").isin(*links.VISUAL)).select(*PAGE, "block_id", "block_type"), have).select(*PAGE, "block_id", _joined("evidence"), "policy")


def crop_rectangles(spark, d):
    """SUP-11."""
    return links.crop_rectangles(_blocks(spark, d), _pages(spark, d))


def missing_images(spark, d):
    """JN-9: images that are no file of their journal."""
    s = _samples(spark, d)
    return images.missing_files(s.withColumn("images", F.transform("images", lambda x: F.concat_ws("/", F.col("metadata.journal_id"), x))), _files(spark, d))


def figures_bound(spark, d):
    """PRD-14."""
    s = _samples(spark, d)
    return s.filter(F.col("task_type") == samples.FIGURE_TASK).select("ordinal", samples.is_bound(s).alias("bound"))


def corpus_coverage(spark, d):
    """QLT-2: corpus samples against their page's text."""
    return quality.coverage(_samples(spark, d), _pages(spark, d).select(*PAGE, F.col("full_text").alias("raw_text")))


def image_correspondence(spark, d):
    """QLT-5."""
    return quality.image_correspondence(_samples(spark, d), table(spark, d, "journal_blocks"), missing_images(spark, d))


def quality_overall(spark, d):
    """AGG-12 over QLT-1 to QLT-5."""
    s = _samples(spark, d)
    return quality.overall({"format": samples.text_format_quality(s), "coverage": corpus_coverage(spark, d), "relevance": quality.relevance(s), "visual": quality.visual_dependency(s), "image": image_correspondence(spark, d)})


def _captions(spark, d):
    b = _blocks(spark, d)
    near = links.nearest_captions(b).select(*PAGE, "block_uid", "caption_uid").join(b.select(F.col("block_uid").alias("caption_uid"), "text"), "caption_uid").join(b.select("block_uid", "block_id"), "block_uid")
    own = b.filter(F.col("block_type").isin(*links.VISUAL)).select("journal_id", "block_id", "text")
    return near.select("journal_id", "block_id", "text").unionByName(own)


def figure_generic(spark, d):
    """PRD-15 with the captions of the object."""
    return quality.generic_figure_instruction(_samples(spark, d), table(spark, d, "articles"), _captions(spark, d))


def sample_gate(spark, d):
    """PRD-12, PRD-13, PRD-14, SUP-14, SUP-15, SUP-16."""
    s = _samples(spark, d)
    return samples.gate(s, _pages(spark, d), missing_images(spark, d), figure_generic(spark, d), quality_overall(spark, d))


def failure_summary(spark, d):
    """AGG-13."""
    s = _samples(spark, d)
    return samples.failures(samples.gate(s, _pages(spark, d)), s).select("task", "n", "n_failed", _joined("reasons"))


def display_texts(spark, d):
    """SCL-23: answers as readers see them."""
    return _samples(spark, d).select("ordinal", samples.clean_scalar(F.col("answer"), 60).alias("shown"))


def export_answers(spark, d):
    """PRJ-27, PRD-17."""
    s = _samples(spark, d)
    return s.filter(samples.task_format(F.coalesce("task_type", F.lit(""))).isin("sharegpt", "alpaca")).select("ordinal", samples.export_answer(s).alias("answer"))


def export_alpaca(spark, d):
    """SNK-6, PRJ-26."""
    b, p = _blocks(spark, d), _pages(spark, d)
    heads = outputs.heading_outputs(b, p).join(b.select(F.col("block_uid").alias("heading_uid"), "block_id"), "heading_uid").select(*PAGE, "block_id", "heading", "controlled")
    r = samples.to_alpaca(samples.with_export_input(_samples(spark, d), p, heads))
    return r.select("ordinal", "instruction", "input", "output", F.col("metadata.journal_id").alias("journal_id"), F.col("metadata.sample_no").alias("sample_no"), F.array_join("images", "|").alias("images"))


def pt_records(spark, d):
    """SNK-7, SNK-8, SET-3."""
    return samples.pt_records(_samples(spark, d), _pages(spark, d))


def payload_hashes(spark, d):
    """SCL-4: hash of the output's JSON with its keys in order."""
    return _samples(spark, d).select("ordinal", F.sha2(F.to_json(F.struct("output_payload.summary", "output_payload.text"), {"ignoreNullFields": "false"}), 256).alias("hash"))


def maybe_json(spark, d):
    """SCL-5: event properties as values where they are JSON."""
    return table(spark, d, "events").select("event_id", F.coalesce(F.try_parse_json("props").cast("string"), F.col("props")).alias("value"))


def folded_payloads(spark, d):
    """PRJ-17 over payloads of page texts."""
    p = _pages(spark, d)
    text = lambda c: F.coalesce(c, F.lit(""))
    made = F.to_json(F.struct(F.struct(text("full_text").alias("source_text")).alias("template_input"), F.struct(text("visible_text").alias("visible"), text("full_text").alias("full"), F.array(text("full_text"), text("visible_text")).alias("both")).alias("page")))
    f = payloads.fold_repeats(p.select("page_uid", made.alias("payload")), "page_uid", "payload")
    get = lambda path: F.get_json_object("payload", path)
    return f.select(F.col("id").cast("bigint").alias("page_uid"), get("$.page.full").alias("full"), get("$.page.visible").alias("visible"), get("$.page.both[0]").alias("first"))


def fitted_payloads(spark, d):
    """PRJ-18 over payloads of page texts: which fields of the context stay."""
    p = _pages(spark, d)
    text = lambda c: F.coalesce(c, F.lit(""))
    made = F.to_json(F.struct(F.struct(F.struct(text("page_label").alias("label")).alias("template_input"), text("full_text").alias("full"), text("visible_text").alias("visible"), text("article_title").alias("title")).alias("context")))
    f = payloads.fit_budget(p.select("page_uid", made.alias("payload")), "page_uid", "payload", BUDGET)
    gone = lambda k: F.startswith(F.get_json_object("payload", f"$.context.{k}"), F.lit("<超出"))
    return f.select(F.col("id").cast("bigint").alias("page_uid"), *(gone(k).alias(f"{k}_left_out") for k in ("full", "visible", "title")))


def journal_rows(spark, d):
    """SRC-2, SRC-3, SRC-6."""
    j = table(spark, d, "journals").select("source_pdf", F.when(F.length("journal_id") % 2 == 0, F.col("journal_name")).alias("journal_name")).distinct()
    ids = table(spark, d, "journals").filter(F.length("journal_name") % 2 == 0).groupBy(F.col("journal_name").alias("name")).agg(F.min("journal_id").alias("journal_id"))
    return readers.journal_rows(j, ids)


def issue_fields(spark, d):
    """SRC-5 on names as they tell their issue in several ways."""
    j = table(spark, d, "journals").select("journal_id", "journal_name", *(F.coalesce(c, F.lit("")).alias(c) for c in ("pub_year", "volume", "issue"))).distinct()
    forms = F.array(F.concat("journal_name", "pub_year", F.lit("年第"), "volume", F.lit("卷 第"), "issue", F.lit("期")), F.concat_ws("-", "journal_name", "pub_year", "volume", "issue"), F.concat_ws(" ", "journal_name", "pub_year"))
    n = j.select("journal_id", F.explode(forms).alias("name"))
    return n.select("journal_id", "name", *(c.alias(k) for k, c in readers.issue_fields(F.col("name")).items())).distinct()


def sample_ranks(spark, d):
    """WIN-15, SUP-22, SRC-13: number of each sample among those of its job, for jobs of pages that are there."""
    s = _samples(spark, d)
    p = _pages(spark, d).select(*PAGE)
    m = F.col("metadata")
    jobs = s.join(p, (m["journal_id"] == p["journal_id"]) & (m["page_index"] == p["page_index"]), "left_semi").select(resume.sample_key().alias("key"))
    return resume.raw_samples(s, jobs)


def task_completion(spark, d):
    """AGG-10: jobs and samples of each task of a journal."""
    m = F.col("metadata")
    return resume.completion(routing.page_jobs(_pages(spark, d)), _samples(spark, d).filter("task_type IS NOT NULL").select(m["journal_id"].alias("journal_id"), "task_type"))


def pending_tasks(spark, d):
    """JN-11, SET-1: selected tasks that a journal still lacks."""
    every = [t for f in ("sharegpt", "alpaca", "pt") for t in samples.FORMATS[f]]
    return resume.pending_tasks(task_completion(spark, d), every).select("journal_id", _joined("tasks"))


def open_jobs(spark, d):
    """JN-10 by count: jobs of claims whose journal's first samples say more than are there."""
    p = _pages(spark, d)
    jobs = routing.page_jobs(p).join(p.select(*PAGE, "article_id"), PAGE).select(resume.job_key(F.col("task_type"), F.col("journal_id"), F.col("article_id"), F.col("page_index"), F.lit("")).alias("key"))
    raw = resume.raw_samples(_samples(spark, d))
    state = raw.groupBy("key").agg((F.max("n") + F.pmod(F.max("ordinal"), F.lit(3)).cast("int") - 1).alias("n_samples"))
    return resume.open_jobs(jobs, state, raw)


def repeated_forms(spark, d):
    """AGG-7 on the columns that a journal's pages have."""
    b = _blocks(spark, d)
    return resume.repeated_forms(b.select(*PAGE, F.col("column_label").alias("form")).filter("form <> ''"), b.select(*PAGE))


def page_titles(spark, d):
    """JN-1: each page with the title of the last article of its id."""
    a = outputs.last_article(table(spark, d, "articles")).select("journal_id", "article_id", F.col("article_title").alias("title"))
    return _pages(spark, d).select("page_uid", "journal_id", "article_id").join(a, ["journal_id", "article_id"], "left").select("page_uid", F.coalesce("title", F.lit("")).alias("title"))


def journal_times(spark, d):
    """SUP-29: times as text."""
    return table(spark, d, "journals").select("journal_id", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created")).distinct()


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        visual_objects, page_descriptions, page_outputs, page_lists, heading_outputs, heading_answers, visual_outputs, condition_outputs, claim_outputs, window_outputs, metadata_outputs, job_metadata, page_inputs, article_authors, page_note_texts, stored_order, visual_images, links_or_default, crop_rectangles,
        missing_images, figures_bound, corpus_coverage, image_correspondence, quality_overall, figure_generic, sample_gate, failure_summary, display_texts, export_answers, export_alpaca, pt_records, payload_hashes, maybe_json, folded_payloads, fitted_payloads, journal_rows, issue_fields, sample_ranks,
        task_completion, pending_tasks, open_jobs, repeated_forms, page_titles, journal_times,
    )
}
