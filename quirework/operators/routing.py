"""Sample jobs: which page, section, window or article goes to which task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.layout import PAGE
from quirework.operators.links import SUBFIGURES_PER_CROP, VISUAL, subfigure_groups
from quirework.operators.pages import LOW_VALUE, STRIDE, TRAINABLE, order_of

# Words that route a page.
METHOD = ("方法", "模型", "试验", "实验", "仿真", "工况", "计算", "参数", "边界条件", "评价指标", "测量", "流程")
CLAIM = ("结果", "表明", "说明", "证明", "可见", "因此", "结论", "提高", "降低", "影响", "满足", "验证")
CONCLUSION = ("结论", "贡献", "发现", "结果表明", "研究表明", "提出", "建立", "验证")
UNCONTROLLED = ("journal_header", "footer", "page_number", "reference")
MIN_PAGE, MIN_BLOCK, MIN_SECTION, MIN_ARTICLE, MIN_CORPUS = 120, 12, 220, 800, 300
WINDOW, ARTICLE_WINDOW, CORPUS_PAGES, CORPUS_CHARS = 3, 8, 2, 3600
SECTION_TASK, SCOPE_TASK = "section_keypoint_summary", "section_heading_scope_alignment"
ORDER_TASK, VISUAL_TASK = "two_column_reading_order_reconstruction", "figure_table_formula_to_text"
TEXT_TYPES = ("title", "section_title", "text", "figure_caption", "table_caption", "list")


def holds(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(words))


def page_text() -> Column:
    """Visible text, or full text where there is none."""
    return T.clean_text(F.when(T.clean_text("visible_text") != "", F.col("visible_text")).otherwise(F.col("full_text")))


def _jobs(df: DataFrame, task: str, cond: Column) -> DataFrame:
    return df.filter(cond).select(*PAGE, F.lit(task).alias("task_type"))


def _trainable(pages: DataFrame) -> DataFrame:
    return pages.filter((page_text() != "") & ~F.coalesce(F.col("page_type"), F.lit("")).isin(*LOW_VALUE))


def _unordered() -> Column:
    """Whether columns or notes alone ask for the reading order."""
    return F.col("column_mode").rlike("(two|three|four|five|six)_column") | (F.size("uncertainty_notes") > 0)


def page_jobs(pages: DataFrame) -> DataFrame:
    """Jobs of whole pages: layout, metadata, reading order by columns or notes (by visual links: linked_page_jobs), method conditions, claim chain. One scan, one array of tasks per page."""
    p = pages.withColumn("t", page_text())
    trainable = (F.col("t") != "") & ~F.coalesce(F.col("page_type"), F.lit("")).isin(*LOW_VALUE)
    tasks = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("page_type"), F.lit("")).isin("blank", "advertisement_or_notice"), F.lit("page_to_journal_layout_description")),
        F.when(F.col("page_type") == "article_first_page", F.lit("article_metadata_extraction")),
        F.when(_unordered(), F.lit(ORDER_TASK)),
        F.when(trainable & holds(F.col("t"), METHOD), F.lit("method_experiment_condition_extraction")),
        F.when(trainable & holds(F.col("t"), CLAIM), F.lit("evidence_to_claim_chain")),
    ))
    return p.select(*PAGE, F.explode(tasks).alias("task_type"))


def linked_page_jobs(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Reading-order jobs of the pages that have visual links but neither columns nor notes, which page_jobs leaves out. Each visual block has a link, its own or its group's."""
    linked = blocks.filter(F.col("block_type").isin(*VISUAL)).select(*PAGE)
    return _jobs(pages.join(linked, PAGE, "left_semi"), ORDER_TASK, ~F.coalesce(_unordered(), F.lit(False)))


def visual_jobs(boxed: DataFrame, pages: DataFrame) -> DataFrame:
    """One job for each figure, table and formula of a trainable page; of a group of subfigures only the first of each part has one."""
    groups = subfigure_groups(boxed.filter("block_type = 'figure' AND x0 IS NOT NULL"))
    others = groups.select(*PAGE, "target", F.explode(F.slice("members", 2, SUBFIGURES_PER_CROP)).alias("block_id")).filter("block_id <> '' AND block_id <> target").select(*PAGE, "block_id")
    v = boxed.filter(F.col("block_type").isin(*VISUAL)).select(*PAGE, "block_uid", "block_id", "block_type")
    return v.join(_trainable(pages).select(*PAGE), PAGE, "left_semi").join(others, [*PAGE, "block_id"], "left_anti").select(*PAGE, "block_uid", "block_id", "block_type", F.lit(VISUAL_TASK).alias("task_type"))


def sections(blocks: DataFrame) -> DataFrame:
    """Each section heading with the text it controls: the blocks up to the next heading of its page, margins and references aside."""
    page = W.partitionBy(*PAGE).orderBy(order_of(), "block_ordinal")
    head = F.col("semantic_role") == "section_heading"
    b = blocks.withColumn("t", T.clean_text("text")).withColumn("sec", F.sum(head.cast("int")).over(page.rowsBetween(W.unboundedPreceding, 0))).filter("sec > 0")
    body = ~head & ~F.coalesce(F.col("semantic_role"), F.lit("")).isin(*UNCONTROLLED) & (F.col("t") != "")
    at = F.struct(order_of().alias("o"), F.col("block_ordinal"), F.col("t"))
    g = b.groupBy(*PAGE, "sec").agg(F.max(F.when(head, F.col("block_uid"))).alias("heading_uid"), F.max(F.when(head, F.col("t"))).alias("heading"), F.sort_array(F.collect_list(F.when(body, at))).alias("parts"))
    return g.filter("heading <> ''").select(*PAGE, "heading_uid", "heading", F.size("parts").alias("n_blocks"), F.length(F.array_join(F.transform("parts", lambda x: x["t"]), " ")).alias("n_chars"))


def section_jobs(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Scope and summary jobs of section headings on trainable pages; pages without headings: unheaded_page_jobs."""
    p = _trainable(pages).select(*PAGE)
    s = sections(blocks).join(p, PAGE, "left_semi")
    tasks = F.array_compact(F.array(F.when(F.col("n_chars") >= MIN_BLOCK, F.lit(SCOPE_TASK)), F.when(F.col("n_chars") >= MIN_SECTION, F.lit(SECTION_TASK))))
    return s.select(*PAGE, "heading_uid", "n_chars", F.explode(tasks).alias("task_type"))


def unheaded_page_jobs(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Summary jobs of trainable pages of MIN_PAGE characters without any section heading whose text blocks, of MIN_BLOCK characters each, have MIN_SECTION together."""
    p = _trainable(pages).filter(F.length(T.clean_text("full_text")) >= MIN_PAGE).select(*PAGE)
    b = blocks.select(*PAGE, "block_type", "semantic_role", F.length(T.clean_text("text")).alias("n"))
    part = F.when(F.col("block_type").isin(*TEXT_TYPES) & (F.col("n") >= MIN_BLOCK), F.col("n") + 1)
    headed = F.coalesce((F.col("semantic_role") == "section_heading") & (F.col("n") > 0), F.lit(False))
    g = b.groupBy(*PAGE).agg(F.max(headed).alias("headed"), (F.sum(part) - 1).cast("int").alias("n_chars")).filter(~F.col("headed") & (F.col("n_chars") >= MIN_SECTION))
    return g.join(p, PAGE, "left_semi").select(*PAGE, "n_chars", F.lit(SECTION_TASK).alias("task_type"))


def page_windows(pages: DataFrame, stride: int = STRIDE) -> DataFrame:
    """Windows of up to WINDOW pages forward in one run of an article, trainable pages of them, two and more with MIN_PAGE characters.

    The next pages of a page are looked up within `stride` page numbers; the last pages of such a stretch get the first ones of those that follow, so that no window is over a whole journal.
    """
    t = page_text()
    row = F.struct("page_index", "article_id", "ok", "n")
    p = pages.select(*PAGE, "article_id", F.length(t).alias("n"), ((t != "") & ~F.coalesce(F.col("page_type"), F.lit("")).isin(*LOW_VALUE)).alias("ok"), F.floor(F.col("page_index") / stride).alias("_stretch"))
    here = W.partitionBy("journal_id", "_stretch").orderBy("page_index")
    firsts = p.groupBy("journal_id", "_stretch").agg(F.slice(F.sort_array(F.collect_list(row)), 1, WINDOW - 1).alias("f"))
    later = W.partitionBy("journal_id").orderBy("_stretch").rowsBetween(1, WINDOW - 1)
    handed = firsts.select("journal_id", "_stretch", F.flatten(F.collect_list("f").over(later)).alias("_next"))
    p = p.withColumn("_ahead", F.collect_list(row).over(here.rowsBetween(0, WINDOW - 1))).join(handed, ["journal_id", "_stretch"])
    p = p.withColumn("_all", F.slice(F.concat("_ahead", "_next"), 1, WINDOW))
    # a page counts while all pages up to it are of the first one's article
    run = F.filter("_all", lambda x, i: F.forall(F.slice("_all", F.lit(1), i + 1), lambda y: y["article_id"].eqNullSafe(F.col("article_id"))))
    p = p.withColumn("win", F.filter(run, lambda x: x["ok"]))
    joined = F.aggregate("win", F.lit(0), lambda a, x: a + x["n"]) + F.size("win") - 1
    return p.filter((F.size("win") >= 2) & (joined >= MIN_PAGE)).select(*PAGE, F.transform("win", lambda x: x["page_index"]).alias("window"))


def article_jobs(pages: DataFrame) -> DataFrame:
    """Articles whose first ARTICLE_WINDOW trainable pages have MIN_ARTICLE characters or a concluding word."""
    p = pages.filter("article_id <> 'article_unknown'").withColumn("t", page_text()).filter((F.col("t") != "") & ~F.coalesce(F.col("page_type"), F.lit("")).isin(*LOW_VALUE))
    p = p.withColumn("n", F.row_number().over(W.partitionBy("journal_id", "article_id").orderBy("page_index"))).filter(F.col("n") <= ARTICLE_WINDOW)
    g = p.groupBy("journal_id", "article_id").agg(F.count("*").alias("n_pages"), F.sum(F.length("t") + 1).alias("chars"), F.bool_or(holds(F.col("t"), CONCLUSION)).alias("concludes"))
    return g.filter((F.col("chars") - 1 >= MIN_ARTICLE) | F.col("concludes")).select("journal_id", "article_id", "n_pages", (F.col("chars") - 1).alias("n_chars"))


def corpus_windows(pages: DataFrame) -> DataFrame:
    """Pages of an article in windows of CORPUS_PAGES, closed sooner by CORPUS_CHARS characters; windows of MIN_CORPUS characters and more.

    With at most two pages a window, a page closes alone if it is long enough, else the next page closes it: a fold over the article's pages.
    """
    p = pages.filter(F.col("page_type").isin(*TRAINABLE)).withColumn("t", T.clean_text("full_text")).filter("t <> ''")
    g = p.groupBy("journal_id", "article_id").agg(F.sort_array(F.collect_list(F.struct("page_index", F.length("t").alias("n")))).alias("ps"))
    zero = F.struct(F.lit(0).alias("win"), F.lit(0).alias("pages"), F.lit(0).alias("chars"), F.array().cast("array<struct<page_index:int,n:int,win:int>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        full = (a["pages"] > 0) & ((a["chars"] >= CORPUS_CHARS) | (a["pages"] >= CORPUS_PAGES))
        win = F.when(full | (a["pages"] == 0), a["win"] + 1).otherwise(a["win"])
        return F.struct(win.alias("win"), F.when(full, 1).otherwise(a["pages"] + 1).alias("pages"), F.when(full, x["n"]).otherwise(a["chars"] + x["n"]).alias("chars"), F.concat(a["out"], F.array(F.struct(x["page_index"].alias("page_index"), x["n"].alias("n"), win.alias("win")))).alias("out"))

    w = g.select("journal_id", "article_id", F.explode(F.aggregate("ps", zero, step)["out"]).alias("x")).select("journal_id", "article_id", "x.*")
    return w.groupBy("journal_id", "article_id", "win").agg(F.min("page_index").alias("first_page"), F.max("page_index").alias("last_page"), F.count("*").alias("n_pages"), F.sum("n").alias("n_chars")).filter(F.col("n_chars") >= MIN_CORPUS)
