"""What rules make of a job: descriptions, the fields of each task's output, its input and its evidence.

One row per job, joined on the page only; arrays hold at most what a page, a section or a window of a few pages has. Texts are cut where the
task's limits say. Fields that a table does not have are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators import generation as G
from quirework.operators import routing
from quirework.operators.layout import PAGE
from quirework.operators.pages import LOW_VALUE, order_of, shown

# Kinds, words and sentences that outputs are made of.
OBJECTS = ("figure", "image", "table", "formula", "equation", "figure_caption", "table_caption", "caption")
NOISE_ROLES = ("journal_header", "footer", "page_number", "reference", "unknown")
CAPTIONS = ("figure_caption", "table_caption")
METHOD_POINTS = ("方法", "模型", "试验", "实验", "仿真", "参数", "工况", "条件")
RESULT_POINTS = ("结果", "表明", "结论", "影响", "验证", "提高", "降低")
ASSUMPTIONS = ("假设", "约束", "限制", "满足", "要求")
LIMITS = ("条件", "限制", "范围", "假设", "工况", "参数")
RISKS = ("多栏排版或图表插入可能造成正文范围边界不确定", "未发现明显不匹配风险")
NO_CAPTION, NO_CONTEXT = "输入未提供明确图注、表注或公式说明。", "输入未提供与该对象同标签绑定的正文解释。"
PAGE_ROLE = "延续同一篇论文的论述片段"
PAGE_CHARS, BLOCK_CHARS, ARTICLE_CHARS = 5000, 3600, 10000
MOST_OBJECTS, MOST_TEXTS, MOST_IDS, MOST_BLOCKS, MOST_RELATED = 12, 16, 32, 18, 8


def _ordered(value: Column, when: Column | None = None, order: Column | None = None) -> Column:
    """Aggregate: the values in the table's order."""
    item = F.struct((F.col("block_ordinal") if order is None else order).alias("_o"), F.col("block_uid").alias("_u"), value.alias("v"))
    return F.transform(F.sort_array(F.collect_list(item if when is None else F.when(when, item))), lambda x: x["v"])


def visual_objects(blocks: DataFrame) -> DataFrame:
    """The first MOST_OBJECTS figures, tables, formulas and captions of each page, with a description: the clean text, or that there is such an area."""
    t = shown()
    b = blocks.filter(F.col("block_type").isin(*OBJECTS) | F.col("semantic_role").isin(*OBJECTS))
    b = b.withColumn("n", F.row_number().over(W.partitionBy(*PAGE).orderBy("block_ordinal", "block_uid"))).filter(F.col("n") <= MOST_OBJECTS)
    return b.select(*PAGE, "n", "block_uid", "block_type", F.when(t != "", F.rtrim(F.left(t, F.lit(420)))).otherwise(F.concat(F.lit("页面中可见 "), F.coalesce("block_type", F.lit("")), F.lit(" 区域"))).alias("description"))


def block_texts(blocks: DataFrame) -> DataFrame:
    """Per page: ids of blocks with text, their texts, ids of noise blocks and headings, in the table's order, each as long as its limit."""
    t = T.clean_text("text")
    return blocks.groupBy(*PAGE).agg(
        F.slice(_ordered(F.col("block_id"), t != ""), 1, MOST_IDS).alias("ids"),
        F.slice(_ordered(F.col("text"), t != ""), 1, MOST_TEXTS).alias("texts"),
        _ordered(F.col("block_id"), F.col("semantic_role").isin(*NOISE_ROLES)).alias("noise"),
        F.slice(_ordered(t, (F.col("semantic_role") == "section_heading") & (t != "")), 1, 4).alias("headings"),
        _ordered(F.struct(F.col("block_id"), T.truncate_text(F.col("text"), 180).alias("excerpt"))).alias("blocks"),
        F.sort_array(F.collect_list(F.coalesce(F.nullif("column_label", F.lit("")), F.lit("unknown")))).alias("_columns"),
    )


def page_descriptions(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """(page, subject, description, objects): a sentence each on the page's type and columns, its subject, its headings and its figures, tables and formulas."""
    seen = visual_objects(blocks).groupBy(*PAGE).agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "description"))), lambda x: x["description"]).alias("objects"))
    heads = block_texts(blocks).select(*PAGE, "headings")
    none = F.array().cast("array<string>")
    j = pages.join(heads, PAGE, "left").join(seen, PAGE, "left").withColumn("objects", F.coalesce("objects", none)).withColumn("headings", F.coalesce("headings", none))
    first = G.first_sentence(T.clean_text("full_text"), 120)
    title = F.coalesce("article_title", F.lit(""))
    subject = F.when(title != "", title).otherwise(first)
    shown_objects = F.array_join(F.slice("objects", 1, 5), "；")
    parts = F.concat_ws(
        " ",
        F.concat(F.lit("该页为"), F.coalesce("page_type", F.lit("")), F.lit("，栏式结构为"), F.coalesce("column_mode", F.lit("")), F.lit("。")),
        F.concat(F.lit("页面正文主题围绕"), T.truncate_text(subject, 160), F.lit("。")),
        F.when(F.size("headings") > 0, F.concat(F.lit("可见小节包括："), F.array_join("headings", "；"), F.lit("。"))),
        F.when(shown_objects != "", F.concat(F.lit("页面中可见的图表/公式信息包括："), shown_objects, F.lit("。"))),
    )
    return j.select(*PAGE, subject.alias("subject"), T.clean_text(parts).alias("description"), "objects")


def page_outputs(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Fields of layout descriptions and of reading orders: description, subject, regions (column, number of blocks), the first MOST_BLOCKS blocks, noise, text for training and restored text."""
    count = F.transform(F.array_distinct("_columns"), lambda c: F.struct(c.alias("region"), F.size(F.filter("_columns", lambda x: x == c)).alias("block_count")))
    j = page_descriptions(blocks, pages).join(pages.select(*PAGE, "page_type", "article_role", "column_mode", "full_text", "uncertainty_notes"), PAGE).join(block_texts(blocks), PAGE, "left")
    low = F.coalesce(F.col("page_type"), F.lit("")).isin(*LOW_VALUE)
    return j.select(
        *PAGE, "description", "subject", "page_type", "article_role", "column_mode", count.alias("regions"), F.slice("blocks", 1, MOST_BLOCKS).alias("content"), "noise", "objects",
        F.when(low, "").otherwise(T.truncate_text(F.col("full_text"), 900)).alias("trainable"), T.truncate_text(F.col("full_text"), 2600).alias("restored"), F.col("uncertainty_notes").alias("notes"),
    )


def heading_outputs(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Fields of scope alignments and key-point summaries of each section heading with text: the blocks it controls, its scope's first sentence, a risk by the page's columns, terms and points."""
    page = W.partitionBy(*PAGE).orderBy(order_of(), "block_ordinal")
    head = F.col("semantic_role") == "section_heading"
    b = blocks.withColumn("t", T.clean_text("text")).withColumn("sec", F.sum(head.cast("int")).over(page.rowsBetween(W.unboundedPreceding, 0))).filter("sec > 0")
    body = ~head & ~F.coalesce(F.col("semantic_role"), F.lit("")).isin(*routing.UNCONTROLLED) & (F.col("t") != "")
    g = b.groupBy(*PAGE, "sec").agg(F.max(F.when(head, F.col("block_uid"))).alias("heading_uid"), F.max(F.when(head, F.col("t"))).alias("heading"), _ordered(F.col("block_id"), body, order_of()).alias("ids"), _ordered(shown(), body, order_of()).alias("lines")).filter("heading <> ''")
    g = g.join(pages.select(*PAGE, "column_mode"), PAGE).withColumn("controlled", F.rtrim(F.left(T.clean_text(F.array_join(F.filter("lines", lambda x: x != ""), "\n")), F.lit(PAGE_CHARS))))
    c = F.col("controlled")
    return g.select(
        *PAGE, "heading_uid", "heading", "ids", "controlled", G.first_sentence(c, 260).alias("scope"),
        F.when(F.coalesce(F.col("column_mode"), F.lit("")).rlike("(two|three|four|five|six)_column"), RISKS[0]).otherwise(RISKS[1]).alias("risk"),
        G.first_sentence(c, 320).alias("summary"), G.key_terms(c).alias("terms"), G.sentences_with(c, METHOD_POINTS).alias("methods"), G.sentences_with(c, RESULT_POINTS).alias("results"),
    )


def joined_fields(*fields: Column) -> Column:
    """An answer out of fields: each cleaned, empty ones left out, 2600 characters."""
    return F.rtrim(F.left(T.clean_text(F.array_join(F.filter(F.array(*fields), lambda x: x != ""), "；")), F.lit(2600)))


def heading_answers(outputs: DataFrame) -> DataFrame:
    """Input and answer of each summary of a section, from `heading_outputs`."""
    words = lambda c: T.clean_text(F.array_join(c, " "))
    c = F.col("controlled")
    given = F.regexp_replace(F.concat(F.lit("小节标题："), "heading", F.lit("\n\n小节正文："), c), r"(?U)^\s+|\s+$", "")
    return outputs.select("heading_uid", given.alias("export_input"), joined_fields(F.col("heading"), F.col("summary"), words("terms"), words("methods"), words("results")).alias("answer"))


def visual_outputs(boxed: DataFrame, jobs: DataFrame, links: DataFrame) -> DataFrame:
    """Fields of the reading of each figure, table and formula of `jobs`: its label, caption and context texts of its first MOST_RELATED bound blocks (itself counted), and their first sentence.

    `links`: block_uid, label, captions and related (block ids). A block without a link is bound to itself alone.
    """
    t = T.clean_text("text")
    text = boxed.select(*PAGE, "block_id", "block_uid", t.alias("t"), F.col("semantic_role").isin(*CAPTIONS).alias("is_caption"))
    by_id = text.groupBy(*PAGE, "block_id").agg(F.max_by(F.struct("t", "is_caption"), "block_uid").alias("r"))
    v = jobs.select(*PAGE, "block_uid", "block_id", "block_type").join(links, "block_uid", "left")
    none = F.array().cast("array<string>")
    bound = F.filter(F.array_distinct(F.concat(F.coalesce("captions", none), F.coalesce("related", none))), lambda x: x != F.col("block_id"))
    each = v.select(*PAGE, "block_uid", F.posexplode(F.slice(bound, 1, MOST_RELATED - 1)).alias("n", "block_id")).join(by_id, [*PAGE, "block_id"])
    g = each.groupBy("block_uid").agg(*(F.rtrim(F.left(T.clean_text(F.array_join(F.transform(F.sort_array(F.collect_list(F.when((F.col("r.t") != "") & (F.col("r.is_caption") if cap else ~F.col("r.is_caption")), F.struct("n", "r.t")))), lambda x: x["t"]), "\n")), F.lit(BLOCK_CHARS))).alias(name) for name, cap in (("caption", True), ("context", False))))
    own = text.select("block_uid", "t")
    j = v.join(own, "block_uid").join(g, "block_uid", "left").fillna("", ["caption", "context", "label"])
    info = F.when(F.col("caption") != "", F.col("caption")).when(F.col("t") != "", F.col("t")).otherwise(NO_CAPTION)
    told = F.when(F.col("context") != "", F.col("context")).otherwise(NO_CONTEXT)
    label = F.when(T.clean_text("label") != "", T.clean_text("label")).otherwise(T.caption_label(F.col("t")))
    return j.select(
        *PAGE, "block_uid", F.col("block_type").alias("object_type"), label.alias("object_label"), F.when(F.col("t") != "", F.col("t")).otherwise(info).alias("visual_description"), info.alias("caption_information"),
        told.alias("text_explanation"), G.first_sentence(F.when(F.col("context") != "", F.col("context")).otherwise(T.clean_text(info)), 320).alias("evidence_to_claim"),
    )


def condition_outputs(pages: DataFrame) -> DataFrame:
    """Fields of method extractions beyond `generation.method_conditions`: object of research, assumptions."""
    p = pages.withColumn("t", routing.page_text()).filter((F.col("t") != "") & ~F.coalesce(F.col("page_type"), F.lit("")).isin(*LOW_VALUE) & routing.holds(F.col("t"), routing.METHOD))
    source = T.truncate_text(F.col("full_text"), PAGE_CHARS)
    title = F.coalesce("article_title", F.lit(""))
    return p.withColumn("s", source).select(*PAGE, F.when(title != "", title).otherwise(G.first_sentence(F.col("s"), 120)).alias("research_object"), G.sentences_with(F.col("s"), ASSUMPTIONS, 3).alias("assumptions"))


def claim_outputs(blocks: DataFrame, pages: DataFrame, links: DataFrame) -> DataFrame:
    """Fields of evidence chains: the claim, the first four texts of the page as evidence, the labels (or ids) of its figures, tables and formulas.

    `links`: journal_id, page_index, block_uid, block_id, block_ordinal, label.
    """
    p = pages.withColumn("t", routing.page_text()).filter((F.col("t") != "") & ~F.coalesce(F.col("page_type"), F.lit("")).isin(*LOW_VALUE) & routing.holds(F.col("t"), routing.CLAIM))
    source = T.truncate_text(F.col("full_text"), PAGE_CHARS)
    named = links.groupBy(*PAGE).agg(_ordered(F.when(F.col("label") != "", F.col("label")).otherwise(F.col("block_id"))).alias("support"))
    none = F.array().cast("array<string>")
    j = p.join(block_texts(blocks).select(*PAGE, "texts"), PAGE, "left").join(named, PAGE, "left")
    return j.select(*PAGE, F.coalesce(F.get(G.sentences_with(source, G.CLAIMS, 1), F.lit(0)), F.lit("")).alias("claim"), F.coalesce(F.slice("texts", 1, 4), none).alias("evidence"), F.coalesce("support", none).alias("support"))


def window_outputs(windows: DataFrame, pages: DataFrame) -> DataFrame:
    """Fields of cross-page contexts: for each page of a window its key point and role; the topic and the summary of all. `windows`: journal_id, page_index (first page), window (page numbers)."""
    w = windows.select("journal_id", F.col("page_index").alias("first_page"), F.posexplode("window").alias("n", "page_index"))
    title = F.coalesce("article_title", F.lit(""))
    j = w.join(pages.select(*PAGE, title.alias("title"), G.first_sentence(T.truncate_text(F.col("full_text"), PAGE_CHARS), 220).alias("point")), PAGE)
    g = j.groupBy("journal_id", "first_page").agg(F.sort_array(F.collect_list(F.struct("n", "page_index", "point", "title"))).alias("ps"))
    first = F.col("ps")[0]
    return g.select(
        "journal_id", "first_page", F.when(first["title"] != "", first["title"]).otherwise(first["point"]).alias("topic"),
        F.array_join(F.transform(F.filter("ps", lambda x: x["point"] != ""), lambda x: x["point"]), " ").alias("summary"),
        F.transform("ps", lambda x: F.struct(x["page_index"].alias("page_index"), x["point"].alias("key_point"), F.lit(PAGE_ROLE).alias("role"))).alias("points"),
    )


def last_article(articles: DataFrame) -> DataFrame:
    """One row per (journal_id, article_id): the last one delivered."""
    cols = [c for c in articles.columns if c not in ("journal_id", "article_id")]
    g = articles.groupBy("journal_id", "article_id").agg(F.max_by(F.struct(*cols), F.struct(F.col("ingested_at"), F.col("article_uid"))).alias("r"))
    return g.select("journal_id", "article_id", "r.*")


def metadata_outputs(pages: DataFrame, articles: DataFrame, journals: DataFrame) -> DataFrame:
    """Fields of metadata extractions of first pages: from the page's article (the last one of its id), else from the page and the journal."""
    p = pages.filter("page_type = 'article_first_page'").select(*PAGE, "article_id", F.col("article_title").alias("page_title"), "page_label", T.clean_text("full_text").alias("t"))
    a = last_article(articles).select("journal_id", "article_id", F.lit(True).alias("found"), "article_title", "authors", "affiliations", F.col("journal_name").alias("a_name"), F.col("pub_year").alias("a_year"), F.col("volume").alias("a_volume"), F.col("issue").alias("a_issue"), "page_range", "doi", "abstract", "keywords")
    m = journals.groupBy("journal_id").agg(*(F.max(c).alias(c) for c in ("journal_name", "pub_year", "volume", "issue")))
    j = p.join(a, ["journal_id", "article_id"], "left").join(m, "journal_id", "left")
    some = lambda *cs: F.coalesce(*(F.nullif(F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit("")), F.lit("")) for c in cs), F.lit(""))
    none = F.array().cast("array<string>")
    return j.select(
        *PAGE, T.clean_text(some("article_title", "page_title", G.first_sentence(F.col("t"), 80))).alias("title"), F.coalesce("authors", none).alias("authors"), some("a_name", "journal_name").alias("journal_name"), some("a_year", "pub_year").alias("year"), some("a_volume", "volume").alias("volume"), some("a_issue", "issue").alias("issue"),
        F.when(F.col("found"), some("page_range")).otherwise(some("page_label")).alias("pages"), some("doi").alias("doi"), some("abstract").alias("abstract"), F.when(F.col("found"), F.coalesce("keywords", none)).otherwise(G.key_terms(F.col("t"))).alias("keywords"),
    )


def job_metadata(jobs: DataFrame, pages: DataFrame, articles: DataFrame, journals: DataFrame) -> DataFrame:
    """`jobs` (journal_id, page_index, task_type) with what a sample says of where it comes from; article before page, page before journal."""
    a = last_article(articles).select("journal_id", "article_id", F.lit(True).alias("_a"), F.col("article_title").alias("_t"), F.col("pub_year").alias("_y"), F.col("volume").alias("_v"), F.col("issue").alias("_i"))
    m = journals.groupBy("journal_id").agg(*(F.max(c).alias(f"j_{c}") for c in ("journal_name", "source_pdf", "pub_year", "volume", "issue", "pipeline_version")))
    p = pages.select(*PAGE, "article_id", "article_title", "page_label", "page_type", "column_mode", "page_image")
    j = jobs.join(p, PAGE).join(a, ["journal_id", "article_id"], "left").join(m, "journal_id", "left")
    pick = lambda mine, other: F.when(F.col("_a"), F.col(mine)).otherwise(F.col(other))
    return j.select(
        F.col("j_source_pdf").alias("source_pdf"), F.col("j_journal_name").alias("journal_name"), "journal_id", "article_id", pick("_t", "article_title").alias("article_title"), pick("_y", "j_pub_year").alias("year"), pick("_v", "j_volume").alias("volume"), pick("_i", "j_issue").alias("issue"),
        "page_index", "page_label", "page_type", "column_mode", F.lit("page").alias("block_id"), F.lit("page").alias("block_type"), F.lit("page").alias("semantic_role"), F.coalesce("page_image", F.lit("")).alias("image_path"), "task_type", F.col("j_pipeline_version").alias("pipeline_version"),
    )


def page_inputs(jobs: DataFrame, pages: DataFrame) -> DataFrame:
    """What each job of a whole page (journal_id, page_index, task_type) is given: image, type, columns and texts, each for the tasks that take it and NULL for others."""
    layout_, order, meta, method, claim = "page_to_journal_layout_description", routing.ORDER_TASK, "article_metadata_extraction", "method_experiment_condition_extraction", "evidence_to_claim_chain"
    task = F.col("task_type")
    given = lambda c, *tasks: F.when(task.isin(*tasks), c)
    j = jobs.select(*PAGE, "task_type").join(pages.select(*PAGE, "page_image", "page_type", "column_mode", "article_title", "full_text", "visible_text", "reading_order_blocks"), PAGE)
    full = T.truncate_text(F.col("full_text"), PAGE_CHARS)
    return j.select(
        *PAGE, "task_type", given(F.coalesce("page_image", F.lit("")), layout_, order, meta, claim).alias("page_image"), given(F.col("page_type"), layout_).alias("page_type"), given(F.col("column_mode"), layout_, order).alias("column_mode"),
        given(F.rtrim(F.left(routing.page_text(), F.lit(PAGE_CHARS))), layout_, order).alias("ocr_text"), given(full, layout_, order).alias("paragraph_text"), given(F.col("reading_order_blocks"), order).alias("reading_order"),
        given(F.coalesce("article_title", F.lit("")), method, claim).alias("article_title"), given(full, meta, method, claim).alias("source_text"),
    )


def subfigure_note(label: Column, chunk: Column, every: Column, parts: Column) -> Column:
    """What is said of a part of a group of subfigures: which marks it has, and which others its label has. `chunk` and `every` are arrays of marks."""
    shown_marks = lambda c: F.array_join(F.transform(c, lambda x: F.concat(F.lit("("), x, F.lit(")"))), "、")
    rest = shown_marks(F.array_except(every, chunk))
    cut = F.concat(F.lit("子图抽取说明：本裁剪包含"), label, F.lit("的"), shown_marks(chunk))
    several = F.when(rest != "", F.concat(cut, F.lit("子图；同一图号还包含"), rest, F.lit("子图，已分片抽取。"))).otherwise(F.concat(cut, F.lit("子图；同一图号已分片抽取。")))
    return F.when(parts > 1, several).otherwise(F.concat(F.lit("子图抽取说明：本裁剪已合并"), label, F.lit("的"), shown_marks(chunk), F.lit("子图。")))
