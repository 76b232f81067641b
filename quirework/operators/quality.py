"""Quality of samples beyond the format of their texts. Every dimension starts at 1 and subtracts, left to right in binary floats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.samples import answer_text, corpus_text, is_bound, lacks_fields, present, question_text, task_format, terms

# Fixed values.
VISUAL_TERMS = ("图", "图片", "图像", "页面", "版面", "布局", "视觉", "表格", "公式", "曲线", "坐标", "双栏", "通栏", "阅读顺序", "跨页", "连续", "结构", "可见", "显示")
UNUSABLE = "无法回答|无法判断|无法确定|不能确定|信息不足|数据不足|图片不可用|图像不可用|看不清|未提供足够|不适合该任务"
AVAILABLE = "图片质量|图像质量|数据可用|任务可用|无法评估该任务|仅能说明.*可用"
FIGURE_FORBIDDEN = r"(?i)图\s*[0-9一二三四五六七八九十]+|表\s*[0-9一二三四五六七八九十]+|式\s*[（(]?\s*[0-9]+|Fig\.?\s*[0-9]+|Figure\s*[0-9]+|Table\s*[0-9]+|标题|题名"
CAPTION_HEAD = r"(?i)^(图\s*[0-9一二三四五六七八九十]+|表\s*[0-9一二三四五六七八九十]+|式\s*[（(]?\s*[0-9]+[）)]?|Fig\.?\s*[0-9]+|Figure\s*[0-9]+|Table\s*[0-9]+)\s*[-—:：.．、]?\s*"
OBJECT_WORDS = "图片|图像|表格|公式|可见|显示|视觉"
LAYOUT_WORDS = "页面|版面|布局|双栏|通栏|阅读顺序|结构|区域"
CROSS_WORDS = "连续|跨页|多页|页面|页"
LAYOUT_TASKS = ("page_to_journal_layout_description", "two_column_reading_order_reconstruction")
FIGURE_TASK, CROSS_TASK = "figure_table_formula_to_text", "cross_page_article_context"


def _minus(score: Column, cond: Column, by: float) -> Column:
    return score - F.when(cond, F.lit(by)).otherwise(F.lit(0.0))


def _result(raw: Column, threshold: float) -> list[Column]:
    return [F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)), 3).alias("score"), (raw >= threshold).alias("passed")]


def relevance(samples: DataFrame) -> DataFrame:
    """(ordinal, score, passed) of question and answer samples: both there, the task's fields, output text, no mere statement of availability, two words of substance, an alignment that agrees with itself, concrete metadata."""
    there = present(samples, "output_payload")
    some = lambda *names: F.size(F.array_intersect(there, F.array(*map(F.lit, names)))) > 0
    fields = samples.schema["output_payload"].dataType.fieldNames()
    s = samples.withColumns({"q": question_text(), "a": answer_text(), "f": task_format(F.coalesce("task_type", F.lit(""))), "_lacks": lacks_fields(samples), "_there": F.size(there) > 0, "_meta": some("title", "authors", "abstract", "keywords")}).filter("f IN ('sharegpt', 'alpaca')")
    words = terms(F.col("a"))
    only = (F.col("a").rlike(UNUSABLE) | F.col("a").rlike(AVAILABLE)) & (F.size(F.slice(words, 1, 20)) < 4)
    raw = _minus(F.lit(1.0), (F.col("q") == "") | (F.col("a") == ""), 0.55)
    raw = _minus(raw, F.col("_lacks"), 0.45)
    raw = _minus(raw, ~F.col("_there"), 0.35)
    raw = _minus(raw, only, 0.45)
    raw = _minus(raw, F.size(words) < 2, 0.25)
    if {"alignment_judgement", "scope_summary"} <= set(fields):
        judged, scope = T.clean_text("output_payload.alignment_judgement"), T.clean_text("output_payload.scope_summary")
        raw = _minus(raw, (F.col("task_type") == "section_heading_scope_alignment") & judged.contains("不对齐") & F.left(scope, F.lit(20)).contains("对齐"), 0.2)
    raw = _minus(raw, (F.col("task_type") == "article_metadata_extraction") & ~F.col("_meta"), 0.3)
    return s.withColumn("raw", raw).select("ordinal", *_result(F.col("raw"), 0.70))


def visual_dependency(samples: DataFrame) -> DataFrame:
    """(ordinal, score, passed) of chat samples: images there, and a question that needs to see them."""
    s = samples.withColumn("q", question_text()).filter(task_format(F.coalesce("task_type", F.lit(""))) == "sharegpt")
    task, low = F.col("task_type"), F.lower("q")
    raw = _minus(F.lit(1.0), F.coalesce(F.size("images"), F.lit(0)) < 1, 0.55)
    raw = _minus(raw, ~low.rlike("|".join(VISUAL_TERMS)), 0.35)
    raw = _minus(raw, (task == FIGURE_TASK) & ~F.col("q").rlike(OBJECT_WORDS), 0.25)
    raw = _minus(raw, task.isin(*LAYOUT_TASKS) & ~F.col("q").rlike(LAYOUT_WORDS), 0.25)
    raw = _minus(raw, (task == CROSS_TASK) & ~F.col("q").rlike(CROSS_WORDS), 0.25)
    return s.withColumn("raw", raw).select("ordinal", *_result(F.col("raw"), 0.60))


def corpus_coverage(output: Column, source: Column) -> Column:
    """Score of a corpus text against the text it was made from: length and numbered headings kept; without a source 1 for any text."""
    heads = F.array_distinct(F.regexp_extract_all(source, F.lit(r"(?:^|\s)(\d+(?:\.\d+)*\s+[一-鿿A-Za-z][^\s。；:：]{1,40})"), F.lit(1)))
    raw = _minus(F.lit(1.0), F.length(output) / F.greatest(F.lit(1), F.length(source)) < 0.65, 0.45)
    raw = _minus(raw, F.exists(heads, lambda h: ~F.contains(output, h)), 0.45)
    return F.when(source == "", F.when(output != "", 1.0).otherwise(0.0)).otherwise(F.bround(F.greatest(F.lit(0.0), raw), 3))


def coverage(samples: DataFrame, sources: DataFrame) -> DataFrame:
    """(ordinal, score, passed) of corpus samples against the text that each was made from. `sources`: journal_id, page_index, raw_text; a sample without one is judged by itself."""
    m = F.col("metadata")
    src = sources.select(F.col("journal_id").alias("_j"), F.col("page_index").alias("_p"), T.clean_text("raw_text").alias("_src"))
    c = samples.filter(task_format(F.coalesce("task_type", F.lit(""))) == "pt")
    j = c.join(src, (m["journal_id"] == src["_j"]) & (m["page_index"] == src["_p"]), "left")
    score = corpus_coverage(T.clean_text(corpus_text()), F.coalesce("_src", F.lit("")))
    return j.select("ordinal", score.alias("score"), (score >= 0.70).alias("passed"))


def image_correspondence(samples: DataFrame, blocks: DataFrame, missing: DataFrame, dull: DataFrame | None = None) -> DataFrame:
    """(ordinal, score, passed) of chat samples: images there and no file missing (`missing`: ordinal, image) and none blank (`dull`: ordinal), visual evidence named, image pages among the source pages, and an answer that shares a word with its evidence.

    The evidence is the texts of the evidence blocks (journal_id, block_id, text); figure samples that are bound to their block and cross-page samples with page roles stand without a shared word.
    """
    m = F.col("metadata")
    s = samples.filter(task_format(F.coalesce("task_type", F.lit(""))) == "sharegpt")
    text = blocks.groupBy("journal_id", "block_id").agg(F.min("text").alias("text"))
    e = s.select("ordinal", m["journal_id"].alias("journal_id"), F.posexplode("evidence.evidence_block_ids").alias("n", "block_id")).join(text, ["journal_id", "block_id"])
    e = e.filter(T.clean_text("text") != "").groupBy("ordinal").agg(F.array_join(F.transform(F.slice(F.sort_array(F.collect_list(F.struct("n", "text"))), 1, 60), lambda x: x["text"]), " ").alias("_support"))
    j = s.join(e, "ordinal", "left").join(missing.select("ordinal").distinct().withColumn("_missing", F.lit(True)), "ordinal", "left")
    j = j.join(dull.select("ordinal").distinct().withColumn("_dull", F.lit(True)), "ordinal", "left") if dull is not None else j.withColumn("_dull", F.lit(False))
    n = F.coalesce(F.size("images"), F.lit(0))
    gone, blank = F.coalesce("_missing", F.lit(False)), F.coalesce("_dull", F.lit(False))
    there = {f.name for f in samples.schema["evidence"].dataType.fields}
    seen = F.coalesce(F.size("evidence.visual_evidence"), F.lit(0)) > 0 if "visual_evidence" in there else F.lit(False)
    shared = F.size(F.array_intersect(terms(answer_text()), terms(T.clean_text("_support")))) >= 1
    roles = {f.name for f in samples.schema["output_payload"].dataType.fields} & {"page_roles", "key_points_by_page"}
    rescued = (F.col("task_type") == FIGURE_TASK) & is_bound(samples) & (T.clean_text("_support") != "")
    for name in sorted(roles):
        rescued = rescued | ((F.col("task_type") == CROSS_TASK) & n.between(2, 3) & (F.coalesce(F.size(f"output_payload.{name}"), F.lit(0)) > 0))
    raw = _minus(F.lit(1.0), n < 1, 0.55)
    raw = _minus(raw, (n >= 1) & gone, 0.55)
    raw = _minus(raw, (n >= 1) & ~gone & blank, 0.35)
    raw = _minus(raw, ~seen, 0.2)
    raw = _minus(raw, ~_pages_agree(), 0.3)
    raw = _minus(raw, ~(shared | rescued), 0.35)
    return j.withColumn("raw", raw).select("ordinal", *_result(F.col("raw"), 0.60))


def overall(dimensions: dict[str, DataFrame]) -> DataFrame:
    """(ordinal, score, passed, n): the mean of a sample's dimensions (added in the order of their names, rounded half-even to three places), and whether it passed all of them. Each dimension: ordinal, score, passed."""
    rows = None
    for name, d in sorted(dimensions.items()):
        one = d.select("ordinal", F.lit(name).alias("name"), "score", "passed")
        rows = one if rows is None else rows.unionByName(one)
    g = rows.groupBy("ordinal").agg(F.sort_array(F.collect_list(F.struct("name", "score"))).alias("s"), F.bool_and("passed").alias("passed"))
    total = F.aggregate("s", F.lit(0.0), lambda a, x: a + x["score"])
    return g.select("ordinal", F.bround(total / F.size("s"), 3).alias("score"), "passed", F.size("s").alias("n"))


def image_accepted(width: Column, height: Column, size: Column, opened: Column, meaningful: Column) -> Column:
    """Whether an image may stand: it is meaningful, or large enough in signs and bytes; one that doesn't open needs bytes alone."""
    large = (width >= 200) & (height >= 200) & (size >= 5000) | (width >= 28) & (height >= 32) & (size >= 500)
    return F.coalesce(meaningful, F.lit(False)) | F.when(F.coalesce(opened, F.lit(False)), large).otherwise(size >= 5000)


def _pages_agree() -> Column:
    found = F.filter(F.transform("images", lambda x: F.regexp_extract(F.replace(x, F.lit("\\"), F.lit("/")), r"p(\d{1,4})", 1)), lambda x: x != "")
    pages = F.transform(found, lambda x: x.cast("int"))
    source = F.col("evidence.source_pages")
    return (F.coalesce(F.size(pages), F.lit(0)) < 1) | (F.coalesce(F.size(source), F.lit(0)) < 1) | (F.size(F.array_except(pages, source)) == 0)


def image_pages(samples: DataFrame) -> DataFrame:
    """(ordinal, n_images, in_sources): whether all page numbers in the image paths are source pages; true where either is missing."""
    return samples.select("ordinal", F.coalesce(F.size("images"), F.lit(0)).alias("n_images"), _pages_agree().alias("in_sources"))


def cross_page_bounds(samples: DataFrame, least: int = 2, most: int = 3) -> DataFrame:
    """(ordinal, ok): cross-page samples have `least` (never below 2) to `most` (never below least) images; others pass."""
    least = max(2, least)
    most = max(least, most)
    return samples.select("ordinal", (~F.col("task_type").eqNullSafe(CROSS_TASK) | F.coalesce(F.size("images"), F.lit(0)).between(least, most)).alias("ok"))


def generic_figure_instruction(samples: DataFrame, articles: DataFrame, captions: DataFrame | None = None) -> DataFrame:
    """(ordinal, generic) of figure samples: the instruction names no label and holds neither a title of the sample's article nor, of four characters and more, what the captions of its object say.

    `captions`: journal_id, block_id (the object's), text; labels at the beginning of a caption and signs at its ends don't count.
    """
    titles = articles.filter("article_title <> ''").groupBy("journal_id", "article_id").agg(F.collect_set("article_title").alias("titles"))
    s = samples.filter(F.col("task_type") == FIGURE_TASK).select("ordinal", question_text().alias("q"), F.col("metadata.journal_id").alias("journal_id"), F.col("metadata.article_id").alias("article_id"), F.col("metadata.block_id").alias("block_id"))
    j = s.join(titles, ["journal_id", "article_id"], "left")
    named = F.coalesce(F.exists("titles", lambda t: F.contains(F.col("q"), F.trim(F.regexp_replace(t, r"(?U)\s+", " ")))), F.lit(False))
    if captions is not None:
        said = F.regexp_replace(F.regexp_replace(T.clean_text("text"), CAPTION_HEAD, ""), r"^[ \-—:：.．、]+|[ \-—:：.．、]+$", "")
        c = captions.select("journal_id", "block_id", said.alias("said")).filter(F.length("said") >= 4).groupBy("journal_id", "block_id").agg(F.collect_set("said").alias("saids"))
        j = j.join(c, ["journal_id", "block_id"], "left")
        named = named | F.coalesce(F.exists("saids", lambda t: F.contains(F.col("q"), t)), F.lit(False))
    return j.select("ordinal", ((F.col("q") != "") & ~F.col("q").rlike(FIGURE_FORBIDDEN) & ~named).alias("generic"))
