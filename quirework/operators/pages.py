"""Pages: types, visible text, articles and paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.layout import PAGE

# Fixed values.
TRAINABLE = ("article_first_page", "article_body")
LOW_VALUE = ("cover", "editorial_board", "table_of_contents", "references", "advertisement_or_notice", "blank")
UNREAD_TYPES = ("cover", "editorial_board", "table_of_contents", "advertisement_or_notice", "blank", "references")
UNREAD_ROLES = ("journal_header", "footer", "page_number", "watermark", "reference")
TRIMMED = ("references", "table_of_contents", "editorial_board", "cover", "blank")
SPECIAL = ("article_title", "abstract", "keywords", "section_heading", "figure_caption", "table_caption", "formula")
SPECIAL_TYPES = ("table", "figure", "formula")


def order_of(column: str = "reading_order") -> Column:
    """Reading order with 0 and NULL last."""
    return F.coalesce(F.nullif(F.col(column), F.lit(0)), F.lit(9999))


def shown(df_markdown: str = "markdown", df_text: str = "text") -> Column:
    """Clean markdown, or clean text where there is none."""
    return T.clean_text(F.when(F.coalesce(F.col(df_markdown), F.lit("")) != "", F.col(df_markdown)).otherwise(F.col(df_text)))


def page_type(page: Column, compact: Column, n_blocks: Column, has_title: Column) -> Column:
    """Type of a page by the first of the ordered rules that fits."""
    hit = lambda p: compact.rlike(p)
    abstract, keys = hit(r"(?i)(摘\s*要|摘要|Abstract)"), hit(r"(?i)(关键词|Key\s*words?)")
    n = F.length(compact)
    return (
        F.when((n < 8) & (n_blocks == 0), "blank")
        .when((n < 20) & (n_blocks > 0), "scan_only")
        .when(hit(r"(?i)(目录|目次|CONTENTS)"), "table_of_contents")
        .when(hit(r"(?i)(编委会|主\s*编|副主编|顾问|Editorial\s+Board)"), "editorial_board")
        .when(hit(r"(?i)(^|\s)(参考文献|References)\s*$") | compact.startswith("参考文献"), "references")
        .when(T.is_advertisement(compact), "advertisement_or_notice")
        .when((page == 1) & ~hit(r"(?i)(摘要|关键词|Abstract|Key\s*words?)") & hit(r"(?i)(主管|主办|出版|ISSN|CN\s*\p{Nd}+|第\s*\p{Nd}+\s*卷)"), "cover")
        .when(abstract & keys & (page > 1) & hit(r"(?i)(参考文献|作者简介|References)"), "article_body")
        .when((abstract & keys) | (has_title & abstract), "article_first_page")
        .when(n >= 80, "article_body")
        .otherwise("unknown")
    )


def page_types(blocks: DataFrame, order: str = "reading_order", role: str = "semantic_role") -> DataFrame:
    """Type, text length and advertisement signs of each page from its blocks in order. A page's text is its blocks' clean texts."""
    line = F.struct(order_of(order).alias("o"), F.col("block_ordinal").alias("i"), T.clean_text("text").alias("t"))
    g = blocks.groupBy(*PAGE).agg(F.sort_array(F.collect_list(line)).alias("lines"), F.count("*").alias("n_blocks"), F.bool_or(F.coalesce(F.col(role) == "article_title", F.lit(False))).alias("has_title"))
    g = g.withColumn("compact", T.clean_text(F.array_join(F.transform("lines", lambda x: x["t"]), "\n")))
    return g.select(*PAGE, page_type(F.col("page_index"), F.col("compact"), F.col("n_blocks"), F.col("has_title")).alias("type"), F.length("compact").alias("n_chars"), T.noise_signals(F.col("compact")).alias("n_signals"))


def is_visible(role: Column, type_: Column, shown_text: Column) -> Column:
    """Whether a block's text is for training."""
    return (shown_text != "") & ~F.coalesce(role, F.lit("")).isin(*UNREAD_ROLES) & ~F.coalesce(type_, F.lit("")).isin(*UNREAD_TYPES)


def visible_blocks(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Blocks of training text with their page's type and article. `pages`: one row per page, joined on the page."""
    p = pages.select(*PAGE, "page_type", "article_id")
    b = blocks.join(p, PAGE).withColumn("shown", shown())
    return b.filter(is_visible(F.col("semantic_role"), F.col("page_type"), F.col("shown")))


def one_page(pages: DataFrame) -> DataFrame:
    """The first delivery of each page."""
    w = W.partitionBy(*PAGE).orderBy("page_uid", F.col("ingested_at").asc_nulls_last())
    return pages.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def paragraph_role() -> Column:
    return F.when(F.col("semantic_role").isin(*SPECIAL), F.col("semantic_role")).when(F.col("block_type").isin(*SPECIAL_TYPES), F.col("block_type")).otherwise("body")


def paragraphs(visible: DataFrame) -> DataFrame:
    """Paragraphs of each article, across its pages: start_page, paragraph (number on its start page), end_page, role, n_blocks, text.

    A block begins a paragraph if it or the block before it is special, if it is a list item, if the text before it is ended, or on an article's first page
    before the abstract; otherwise its text goes on, with a blank only between Latin letters or figures. Whether a block begins one depends on the
    block before it alone, and of that on its last sign and its kind. Within a page a window tells them; from page to page two short values a page are handed on,
    so that no text goes through a window of a whole article, which may be a third of all pages.
    """
    page = W.partitionBy(*PAGE, "_art").orderBy(order_of(), "block_ordinal")
    so_far = page.rowsBetween(W.unboundedPreceding, -1)
    pages_of = W.partitionBy("journal_id", "_art").orderBy("page_index")

    def by_page(rows: DataFrame, value: Column, name: str) -> DataFrame:
        """One row a page, so that blocks are joined where they lie: `name` is a map from the page's articles, which are few, to a value."""
        return rows.select(*PAGE, "_art", value.alias("_v")).groupBy(*PAGE).agg(F.map_from_entries(F.collect_list(F.struct("_art", "_v"))).alias(name))

    v = visible.withColumn("_art", F.coalesce(F.concat(F.lit("a"), "article_id"), F.lit(""))).withColumn("prole", paragraph_role()).withColumn("_tail", F.struct(F.right("shown", F.lit(1)).alias("sign"), (F.col("prole") != "body").alias("special")))
    ends = v.groupBy(*PAGE, "_art").agg(F.max_by("_tail", F.struct(order_of(), F.col("block_ordinal"))).alias("_last"))
    handed = by_page(ends, F.lag("_last").over(pages_of), "_from")
    v = v.withColumns({"_before": F.lag("_tail").over(page), "_abstract": F.coalesce(F.max((F.col("semantic_role") == "abstract").cast("int")).over(so_far), F.lit(0))}).join(handed, PAGE)
    prev = F.coalesce("_before", F.element_at("_from", F.col("_art")))
    sign = prev["sign"]
    new = prev.isNull() | ((F.col("page_type") == "article_first_page") & (F.col("_abstract") == 0)) | (F.col("prole") != "body") | prev["special"] | F.col("shown").rlike(T.LIST_ITEM) | sign.rlike(T.PARAGRAPH_END)
    v = v.withColumns({"_new": new, "_sign": sign})
    begun = v.groupBy(*PAGE, "_art").agg(F.sum(F.col("_new").cast("int")).alias("_n"))
    offset = by_page(begun, F.coalesce(F.sum("_n").over(pages_of.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), "_offset")
    v = v.withColumn("_in", F.sum(F.col("_new").cast("int")).over(page.rowsBetween(W.unboundedPreceding, 0))).join(offset, PAGE).withColumn("_seq", F.element_at("_offset", F.col("_art")) + F.col("_in"))
    glue = F.when(F.col("_new") | F.lit(T.NO_SPACE_BEFORE).contains(F.left("shown", F.lit(1))), "").when(F.col("_sign").rlike("[A-Za-z0-9]$") & F.col("shown").rlike("^[A-Za-z0-9]"), " ").otherwise("")
    part = F.struct("page_index", order_of().alias("o"), "block_ordinal", F.concat(glue, "shown").alias("t"), F.col("prole").alias("r"))
    g = v.groupBy("journal_id", "article_id", "_seq").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    out = g.select("journal_id", "article_id", "_seq", F.col("parts")[0]["page_index"].alias("start_page"), F.element_at("parts", -1)["page_index"].alias("end_page"), F.col("parts")[0]["r"].alias("role"), F.size("parts").alias("n_blocks"), F.array_join(F.transform("parts", lambda x: x["t"]), "").alias("text"))
    number = F.row_number().over(W.partitionBy("journal_id", "article_id", "start_page").orderBy("_seq"))
    return out.select("journal_id", "article_id", "start_page", number.alias("paragraph"), "end_page", "role", "n_blocks", "text")


def page_texts(paras: DataFrame) -> DataFrame:
    """Full text of each page: the paragraphs that start on it, a blank line between them."""
    g = paras.groupBy("journal_id", F.col("start_page").alias("page_index")).agg(F.sort_array(F.collect_list(F.struct("article_id", "paragraph", "text"))).alias("p"))
    return g.select(*PAGE, F.size("p").alias("n_paragraphs"), F.array_join(F.transform("p", lambda x: x["text"]), "\n\n").alias("full_text"))


STRIDE = 4096


def last_so_far(rows: DataFrame, keys: list[str], at: str, value: str, stride: int = STRIDE) -> DataFrame:
    """`rows` with `_last`: the last `value` that isn't NULL up to each row of its key, in the order of the whole number `at`.

    A window over a whole key would be one task's, and a key may be a third of all rows. Here windows are over `stride` numbers at a time, and what a stretch ends with is handed on by a window over one row a stretch.
    """
    w = W.partitionBy(*keys, "_stretch")
    s = rows.withColumn("_stretch", F.floor(F.col(at) / stride)).withColumn("_here", F.last(value, ignorenulls=True).over(w.orderBy(at).rowsBetween(W.unboundedPreceding, 0)))
    ends = s.groupBy(*keys, "_stretch").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(at))).alias("_end"))
    handed = ends.select(*(F.col(k).alias(f"_k{n}") for n, k in enumerate((*keys, "_stretch"))), F.last("_end", ignorenulls=True).over(W.partitionBy(*keys).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)).alias("_from"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate((*keys, "_stretch"))]
    return s.join(handed, on, "left").select(*rows.columns, F.coalesce("_here", "_from").alias("_last"))


def article_spans(pages: DataFrame) -> DataFrame:
    """(journal_id, start_page, end_page): articles from a first page to the page before the next, trailing pages of no text trimmed.

    A journal without first pages has one span from its first to its last trainable page, or none.
    """
    p = pages.select(*PAGE, "page_type").withColumn("_own", F.when(F.col("page_type") == "article_first_page", F.col("page_index")))
    p = last_so_far(p, ["journal_id"], "page_index", "_own").withColumnRenamed("_last", "start")
    p = p.join(p.groupBy("journal_id").agg(F.max("_own").alias("_any")), "journal_id")
    kept = ~F.coalesce(F.col("page_type"), F.lit("")).isin(*TRIMMED) | (F.col("page_index") == F.col("start"))
    spans = p.filter("start IS NOT NULL").groupBy("journal_id", F.col("start").alias("start_page")).agg(F.max(F.when(kept, F.col("page_index"))).alias("end_page"))
    rest = p.filter("_any IS NULL").filter(F.col("page_type").isin(*TRAINABLE)).groupBy("journal_id").agg(F.min("page_index").alias("start_page"), F.max("page_index").alias("end_page"))
    return spans.unionByName(rest)


def page_articles(pages: DataFrame, spans: DataFrame) -> DataFrame:
    """Each page's article span and its role in it. The range join becomes an equi join on the pages of a span; the later span wins."""
    inside = spans.withColumn("page_index", F.explode(F.sequence("start_page", "end_page"))).groupBy(*PAGE).agg(F.max(F.struct("start_page", "end_page")).alias("s"))
    j = pages.select(*PAGE).join(inside, PAGE, "left").select(*PAGE, "s.*")
    role = F.when(F.col("start_page").isNull(), "unknown").when(F.col("page_index") == F.col("start_page"), "first_page").when(F.col("page_index") == F.col("end_page"), "last_page").otherwise("body")
    return j.withColumn("role", role)


def article_metadata(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Title, abstract, keywords, DOI and confidence of each article's first page, from its blocks in the table's order."""
    first = pages.filter("page_type = 'article_first_page'").select(*PAGE, "journal_name")
    b = blocks.join(first, PAGE).withColumn("t", T.clean_text("text"))
    at = F.struct("block_ordinal", "block_uid")
    pick = lambda cond: F.min_by(F.when(cond, F.col("t")), F.when(cond, at))
    g = b.groupBy(*PAGE).agg(
        pick((F.col("semantic_role") == "article_title") & (F.col("t") != "")).alias("title"),
        F.first("journal_name").alias("journal_name"),
        F.coalesce(pick(F.col("t").startswith("摘要") | F.col("t").startswith("摘 要") | F.col("t").startswith("Abstract")), F.lit("")).alias("abstract"),
        F.coalesce(pick(F.col("t").startswith("关键词") | F.col("t").startswith("Key words") | F.col("t").startswith("Keywords")), F.lit("")).alias("keyword_line"),
        F.coalesce(pick(F.regexp_extract("t", T.DOI, 0) != ""), F.lit("")).alias("doi_line"),
    )
    return g.select(*PAGE, F.coalesce("title", T.clean_text("journal_name")).alias("title"), "abstract", T.keywords(F.col("keyword_line")).alias("keywords"), F.regexp_extract("doi_line", T.DOI, 0).alias("doi"), F.when(F.col("title").isNotNull(), 0.82).otherwise(0.45).alias("confidence"))


def article_authors(blocks: DataFrame, pages: DataFrame, most: int = 12) -> DataFrame:
    """(page, authors) of each first page with a title block (or, without one, its topmost heading or body block in the upper part): the words of two to eight characters of the first block below the title, up to a bracket.

    `blocks` are boxed; below means from the title's lower edge to 60 pixels or 0.08 of the page's height further down.
    """
    first = pages.filter("page_type = 'article_first_page'").select(*PAGE, F.coalesce("height", F.lit(0)).alias("height"))
    b = blocks.join(first, PAGE).withColumn("t", T.clean_text("text")).filter("t <> ''").withColumn("bottom", F.coalesce("y1", "top"))
    at = F.struct("block_ordinal", "block_uid")
    titled = F.col("semantic_role") == "article_title"
    upper = F.col("semantic_role").isin("section_heading", "body") & (F.col("top") < F.greatest(F.lit(1), F.col("height")) * 0.35)
    title = b.groupBy(*PAGE).agg(F.coalesce(F.min_by("bottom", F.when(titled, at)), F.min_by("bottom", F.when(upper, F.struct("top", "left", "block_ordinal")))).alias("edge"))
    below = (F.col("top") >= F.col("edge")) & (F.col("top") <= F.col("edge") + F.greatest(F.lit(60.0), F.col("height") * 0.08)) & ~F.coalesce("semantic_role", F.lit("")).isin("abstract", "keywords", "journal_header", "footer", "page_number")
    line = b.join(title, PAGE).filter(below).groupBy(*PAGE).agg(F.min_by("t", at).alias("line"))
    words = F.split(F.regexp_replace("line", r"[\p{Nd},，\s]*(\(|（).*$", ""), r"[,，、\s]+")
    return line.select(*PAGE, F.slice(F.filter(words, lambda x: F.length(x).between(2, 8)), 1, most).alias("authors"))


# What the notes say.
NOTES = ("reading order reconstructed from coordinates; verify cross-column floating objects", "cross-column visual blocks split two-column reading bands; read left band above barrier, then right band above barrier, then the barrier")


def note_texts(n_notes: str) -> Column:
    """The notes of a page that has so many."""
    return F.slice(F.array(*map(F.lit, NOTES)), 1, F.col(n_notes))


def neighbours(pages: DataFrame) -> DataFrame:
    """The page numbers before and after each page of a journal, from the first to the last that it has; NULL beyond them."""
    last = pages.groupBy("journal_id").agg(F.max("page_index").alias("_last"))
    i = F.col("page_index")
    return pages.select(*PAGE).join(last, "journal_id").select(*PAGE, F.when(i > 1, i - 1).alias("before"), F.when(i < F.col("_last"), i + 1).alias("after"))


def uncertainty(modes: DataFrame, assigned: DataFrame) -> DataFrame:
    """How many notes of uncertainty a page gets: one for two columns, one more if a visual block spans them."""
    wide = assigned.groupBy(*PAGE).agg(F.bool_or(F.coalesce(F.col("block_type").isin("figure", "table", "formula") & (F.col("col_label") == "full_width"), F.lit(False))).alias("wide"))
    two = F.col("mode").contains("two_column")
    return modes.join(wide, PAGE).select(*PAGE, F.when(two & F.col("wide"), 2).when(two, 1).otherwise(0).alias("n_notes"))
