"""Samples made by rule: sentences with certain words, corpus texts, tasks' outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators import routing
from quirework.operators.layout import PAGE
from quirework.operators.pages import LOW_VALUE, order_of

# The words that pick a field's sentences.
METHOD_STEPS = ("方法", "流程", "采用", "建立", "试验", "实验", "仿真", "计算")
CONDITIONS = ("条件", "工况", "参数", "边界", "载荷", "速度", "温度", "压力")
METRICS = ("指标", "评价", "误差", "结果", "性能", "效率", "安全")
CLAIMS = ("结果", "表明", "说明", "证明", "可见", "因此", "结论", "验证")
CONTRIBUTIONS = ("提出", "建立", "构建", "设计", "研究", "实现")
FINDINGS = ("发现", "结果", "表明", "影响", "提高", "降低")
CONCLUSIONS = ("结论", "表明", "说明", "验证", "因此")
KEY_STOPWORDS = ("摘要", "关键词", "本文", "研究", "进行", "采用", "结果", "表明", "方法", "分析", "影响")
UNREAD_ROLES = ("journal_header", "footer", "page_number", "reference", "unknown", "watermark")
PUBLISHERS = "大学|出版社|研究院|科技|Society|Press"


def sentences(c: Column, limit: int) -> Column:
    """The first `limit` sentences of a clean text; a sentence ends after each of its signs."""
    marked = F.regexp_replace(c, r"([。！？；;.!?])\s*", "$1\x01")
    parts = F.filter(F.transform(F.split(marked, "\x01"), lambda x: F.trim(x)), lambda x: x != "")
    return F.slice(parts, 1, limit)


def first_sentence(c: Column, limit: int) -> Column:
    return F.rtrim(F.left(F.coalesce(F.get(sentences(c, 1), F.lit(0)), F.lit("")), F.lit(limit)))


def sentences_with(c: Column, words: tuple[str, ...], limit: int = 4) -> Column:
    """Up to `limit` of the first 16 sentences that hold one of the words; without any the first ones. Each cut to 260 characters."""
    hits = F.filter(sentences(c, 16), lambda x: x.rlike("|".join(words)))
    return F.transform(F.slice(F.when(F.size(hits) > 0, hits).otherwise(sentences(c, limit)), 1, limit), lambda x: F.rtrim(F.left(x, F.lit(260))))


def key_terms(c: Column, limit: int = 8) -> Column:
    """The entries of the text's keyword line, or its first words; stop-words and single characters left out."""
    listed = F.regexp_extract(c, r"(?i)(关键词|Key\s*words?)\s*[:：]\s*(.+)", 2)
    raw = F.when(listed != "", F.split(listed, r"[;；,，、\s]+")).otherwise(F.regexp_extract_all(c, F.lit(r"[A-Za-z][A-Za-z0-9\-_/]{1,24}|[一-鿿A-Za-z0-9]{2,16}"), F.lit(0)))
    bare = F.transform(raw, lambda x: F.regexp_replace(x, r"^[ ：:;；,，。、()（）\[\]【】]+|[ ：:;；,，。、()（）\[\]【】]+$", ""))
    return F.slice(F.array_distinct(F.filter(bare, lambda x: (F.length(x) >= 2) & ~x.isin(*KEY_STOPWORDS))), 1, limit)


def _trainable(pages: DataFrame) -> DataFrame:
    return pages.withColumn("t", routing.page_text()).filter((F.col("t") != "") & ~F.coalesce(F.col("page_type"), F.lit("")).isin(*LOW_VALUE))


def method_conditions(pages: DataFrame) -> DataFrame:
    """Method, condition and metric sentences of the pages that are routed to that task."""
    p = _trainable(pages).filter(routing.holds(F.col("t"), routing.METHOD))
    t = F.col("t")
    return p.select(*PAGE, sentences_with(t, METHOD_STEPS).alias("method_steps"), sentences_with(t, CONDITIONS).alias("conditions"), sentences_with(t, METRICS).alias("metrics"), key_terms(t, 12).alias("variables"))


def claim_chains(pages: DataFrame) -> DataFrame:
    """The claim of each page that is routed to that task."""
    p = _trainable(pages).filter(routing.holds(F.col("t"), routing.CLAIM))
    return p.select(*PAGE, F.get(sentences_with(F.col("t"), CLAIMS, 1), F.lit(0)).alias("claim"))


def contributions(pages: DataFrame) -> DataFrame:
    """Problem, contributions, findings and conclusions of each article that is routed to that task, from its first trainable pages."""
    p = _trainable(pages.filter("article_id <> 'article_unknown'"))
    p = p.withColumn("n", F.row_number().over(W.partitionBy("journal_id", "article_id").orderBy("page_index"))).filter(F.col("n") <= routing.ARTICLE_WINDOW)
    g = p.groupBy("journal_id", "article_id").agg(F.sort_array(F.collect_list(F.struct("page_index", "t"))).alias("ps"))
    g = g.withColumn("t", F.array_join(F.transform("ps", lambda x: x["t"]), " "))
    g = g.filter((F.length("t") >= routing.MIN_ARTICLE) | routing.holds(F.col("t"), routing.CONCLUSION))
    t = F.col("t")
    return g.select("journal_id", "article_id", first_sentence(t, 220).alias("problem"), sentences_with(t, CONTRIBUTIONS).alias("contributions"), sentences_with(t, FINDINGS).alias("findings"), sentences_with(t, CONCLUSIONS).alias("conclusions"))


def is_corpus_noise(t: Column, role: Column, page: Column) -> Column:
    """Whether a clean line is no corpus text: empty, an author note, an English abstract after the first page, a short bibliographic line."""
    later = page > 1
    return (
        (t == "") | (F.upper(t) == "OSID:") | t.startswith("作者简介")
        | (t.rlike(r"(?i)^Abstract\s*:") & later) | (t.rlike(r"(?i)^(Key\s*words?|Keywords?)\s*:") & later)
        | (F.coalesce(role, F.lit("")).isin("abstract", "keywords") & later & t.rlike("^[A-Za-z]"))
        | (t.rlike(r"[,，]\s*(19|20)\p{Nd}{2}\.?$") & (F.length(t) <= 90) & t.rlike(PUBLISHERS))
    )


def corpus_samples(windows: DataFrame, paragraphs: DataFrame, pages: DataFrame, visible: DataFrame) -> DataFrame:
    """Corpus texts of windows: a heading of journal, article and pages, then per page its label and its paragraphs of text, cleaned.

    A page on which no paragraph starts has the lines of its visible blocks in reading order instead.
    """
    at = ["journal_id", "article_id", "page_index"]
    p = paragraphs.withColumn("line", T.clean_text("text")).filter(~F.col("role").isin(*UNREAD_ROLES) & ~is_corpus_noise(F.col("line"), F.col("role"), F.col("start_page")))
    lines = p.groupBy("journal_id", "article_id", F.col("start_page").alias("page_index")).agg(F.sort_array(F.collect_list(F.struct("paragraph", "line"))).alias("ls"))
    rest = visible.join(paragraphs.select("journal_id", "article_id", F.col("start_page").alias("page_index")), at, "left_anti").filter(~is_corpus_noise(F.col("shown"), F.col("semantic_role"), F.col("page_index")))
    more = rest.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct(order_of().alias("o"), "block_ordinal", F.col("shown").alias("line")))).alias("ls"))
    lines, more = (x.select(*at, F.transform("ls", lambda x: x["line"]).alias("ls")) for x in (lines, more))
    lines = lines.unionByName(more)
    w = windows.withColumn("page_index", F.explode(F.sequence("first_page", "last_page")))
    label = F.when(T.clean_text("page_label") == "", F.col("page_index").cast("string")).otherwise(T.clean_text("page_label"))
    j = w.join(pages.select(*PAGE, "article_id", "journal_name", "article_title", label.alias("label")), [*PAGE, "article_id"]).join(lines, at, "left")
    body = F.array_join(F.concat(F.array(F.concat(F.lit("[页码："), "label", F.lit("]"))), F.coalesce("ls", F.array().cast("array<string>"))), "\n")
    g = j.groupBy("journal_id", "article_id", "first_page", "last_page").agg(F.sort_array(F.collect_list(F.struct("page_index", body.alias("b"), "label", "journal_name", "article_title"))).alias("ps"))
    first, last = F.col("ps")[0], F.element_at("ps", -1)
    span = F.when(first["label"] == last["label"], first["label"]).otherwise(F.concat(first["label"], F.lit("-"), last["label"]))
    title = T.clean_text(first["article_title"])
    head = F.concat(F.lit("期刊："), F.coalesce(first["journal_name"], F.lit("")), F.lit("\n文章："), F.when(title != "", title).otherwise(F.col("article_id")), F.lit("\n页码："), span, F.lit("\n\n"))
    raw = F.array_join(F.transform("ps", lambda x: x["b"]), "\n\n")
    return g.select("journal_id", "article_id", "first_page", "last_page", F.concat(head, T.clean_corpus_text(raw)).alias("text"))
