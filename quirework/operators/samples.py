"""Samples: ids, quality, exports, de-duplication and resume."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from quirework.functions import text as T
from quirework.operators.pages import LOW_VALUE
from quirework.session import checkpoint

CORPUS = "domain_knowledge_corpus"
# Which task goes to which export.
FORMATS = {
    "sharegpt": ("two_column_reading_order_reconstruction", "page_to_journal_layout_description", "figure_table_formula_to_text", "evidence_to_claim_chain", "cross_page_article_context"),
    "alpaca": ("article_metadata_extraction", "section_heading_scope_alignment", "section_keypoint_summary", "method_experiment_condition_extraction", "article_contribution_conclusion"),
    "pt": (CORPUS,),
}
# Field names that show through in a bad text, and words that say nothing.
INTERNAL = r"\b(input_payload|output_payload|metadata|export_input|layout_blocks)\b\s*[:：]"
TRAINING = r"(?i)\b(instruction|input|output|messages|conversations|images|metadata)\b\s*[:：]"
STOPWORDS = ("请根据", "根据", "进行", "内容", "信息", "回答", "问题", "图片", "图像", "页面", "该页面", "该论文", "期刊", "论文", "任务", "输出", "字段", "说明", "分析", "描述")
# What each task's output (or evidence) must hold, and which tasks must show pages.
REQUIRED = {
    "article_metadata_extraction": ("title",),
    "two_column_reading_order_reconstruction": ("page_visual_description", "column_mode", "reading_order"),
    "page_to_journal_layout_description": ("page_visual_description", "page_type", "column_mode", "layout_regions"),
    "section_heading_scope_alignment": ("heading", "alignment_judgement"),
    "section_keypoint_summary": ("summary", "key_terms"),
    "figure_table_formula_to_text": ("object_type", "visual_description", "visible_structure", "caption_information", "evidence_to_claim"),
    "method_experiment_condition_extraction": ("research_object", "method_steps"),
    "evidence_to_claim_chain": ("page_visual_description", "claim", "evidence_chain", "chain_steps"),
    "article_contribution_conclusion": ("research_problem", "contributions", "conclusions"),
    "cross_page_article_context": ("page_visual_descriptions", "context_topic", "cross_page_summary"),
    CORPUS: ("text",),
}
ILLUSTRATED = FORMATS["sharegpt"]
LAYOUT_TASK, FIGURE_TASK, CROSS_TASK = "page_to_journal_layout_description", "figure_table_formula_to_text", "cross_page_article_context"
# The payload's fields under the names that readers see, those of chat answers with their limits, and what stands for no answer.
LABELS = {
    "page_type": "页面类型", "article_role": "页面作用", "column_mode": "栏式结构", "main_topic": "主要主题", "page_visual_description": "页面视觉描述", "page_visual_descriptions": "页面视觉描述", "layout_regions": "版面区域", "content_blocks": "主要内容块",
    "figures_tables_formulas": "图表公式", "trainable_content": "可训练内容", "reading_order": "阅读顺序", "reconstructed_text": "恢复正文", "uncertainty_notes": "不确定处", "object_type": "对象类型", "visual_description": "视觉描述", "visible_structure": "可见结构",
    "caption_information": "上下文说明", "text_explanation": "正文解释", "evidence_to_claim": "证据结论", "claim": "论点", "evidence_chain": "关键证据", "chain_steps": "推理链条", "reasoning_scope": "适用范围", "context_topic": "跨页主题", "page_roles": "页面作用",
    "cross_page_summary": "跨页概述", "continuity_relations": "衔接关系", "key_points_by_page": "各页要点", "summary": "摘要", "title": "题名", "authors": "作者", "affiliations": "作者单位", "journal_name": "期刊", "year": "年份", "volume": "卷", "issue": "期", "pages": "页码",
    "doi": "DOI", "abstract": "摘要", "keywords": "关键词", "classification_no": "分类号", "document_code": "文献标识码", "funding": "基金信息", "heading": "小节标题", "heading_level": "标题层级", "scope_summary": "正文范围", "alignment_judgement": "匹配判断", "mismatch_risk": "不确定性",
    "section_title": "小节标题", "key_terms": "关键术语", "method_or_condition_points": "方法与条件要点", "result_or_claim_points": "结果与结论要点", "research_object": "研究对象", "method_steps": "方法流程", "experimental_or_simulation_conditions": "实验或仿真条件",
    "variables_and_parameters": "变量和参数", "evaluation_metrics": "评价指标", "assumptions_or_constraints": "假设与约束", "research_problem": "研究问题", "contributions": "主要贡献", "key_findings": "关键发现", "conclusions": "结论", "conditions_or_limitations": "适用条件与局限",
    "supporting_evidence": "支撑证据",
}
CHAT_LINES = {
    "two_column_reading_order_reconstruction": (("页面视觉描述", "page_visual_description", 1000), ("栏式结构", "column_mode", 120), ("阅读顺序", "reading_order", 520), ("恢复正文", "reconstructed_text", 1800), ("图表公式", "figures_tables_formulas", 900), ("不确定处", "uncertainty_notes", 500)),
    "page_to_journal_layout_description": (("页面视觉描述", "page_visual_description", 1000), ("页面类型", "page_type", 120), ("页面作用", "article_role", 180), ("栏式结构", "column_mode", 120), ("主要主题", "main_topic", 260), ("版面区域", "layout_regions", 700), ("图表公式", "figures_tables_formulas", 900), ("可训练内容", "trainable_content", 1200)),
    "figure_table_formula_to_text": (("对象类型", "object_type", 120), ("视觉描述", "visual_description", 900), ("可见结构", "visible_structure", 700), ("上下文说明", "caption_information", 700), ("正文解释", "text_explanation", 900), ("证据结论", "evidence_to_claim", 700)),
    "evidence_to_claim_chain": (("页面视觉描述", "page_visual_description", 1000), ("论点", "claim", 500), ("关键证据", "evidence_chain", 900), ("图表公式", "figures_tables_formulas", 900), ("适用范围", "reasoning_scope", 180)),
    "cross_page_article_context": (("跨页主题", "context_topic", 420), ("跨页概述", "cross_page_summary", 1500), ("衔接关系", "continuity_relations", 900), ("图表公式", "figures_tables_formulas", 900)),
}
FIGURE_LINES = (("对象类型", "object_type", 80), ("视觉内容", "visual_description", 1400), ("可见结构", "visible_structure", 1200), ("图注表注或公式说明", "caption_information", 1000), ("正文解释", "text_explanation", 1400), ("证据结论", "evidence_to_claim", 1000))
#: Field names that must not show in an answer.
RAW_NAMES = ("summary", "controlled_block_ids", *list(LABELS)[list(LABELS).index("title") :])
NO_ANSWER = "当前样本未提供可用的结构化回答。"
IMAGE_TOKEN = "<image>"
QUOTA, MIN_QUESTION, MIN_ANSWER, FORMAT_THRESHOLD = 8, 4, 8, 0.72


def task_format(task: Column) -> Column:
    """pt, sharegpt, alpaca or unknown."""
    out = F.when(task.isin(*FORMATS["pt"]), "pt").when(task.isin(*FORMATS["sharegpt"]), "sharegpt").when(task.isin(*FORMATS["alpaca"]), "alpaca")
    return out.otherwise("unknown")


def safe_name(c: Column, default: str) -> Column:
    """Signs that file names can't have, and white space, as one underscore; dots, underscores and blanks at the ends removed."""
    s = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r'[<>:"/\\|?*\x00-\x1f]+', "_")
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", "_"), r"^[._ ]+|[._ ]+$", "")
    return F.when(s == "", F.lit(default)).otherwise(s)


def sample_id(samples: DataFrame) -> Column:
    m = lambda c: F.col(f"metadata.{c}")
    return F.format_string("%s_%s_p%03d_%s_%s_%06d", safe_name(m("journal_id"), "journal"), safe_name(m("article_id"), "article_unknown"), F.coalesce(m("page_index"), F.lit(0)), safe_name(m("block_id"), "page"), F.coalesce(m("task_type"), F.lit("task")), F.coalesce(m("sample_no"), F.lit(0)))


def corpus_text() -> Column:
    return F.when(F.coalesce(F.col("output_payload.text"), F.lit("")) != "", F.col("output_payload.text")).otherwise(F.coalesce("text", F.lit("")))


def answer_text() -> Column:
    """Clean corpus text for corpus samples; else the answer, else the payload's texts."""
    payload = F.trim(F.concat_ws(" ", F.nullif(T.clean_text("output_payload.text"), F.lit("")), F.nullif(T.clean_text("output_payload.summary"), F.lit(""))))
    answer = T.clean_text("answer")
    return F.when(F.col("task_type").eqNullSafe(CORPUS), T.clean_text(corpus_text())).when(answer != "", answer).otherwise(payload)


def question_text() -> Column:
    return T.clean_text(F.when(F.coalesce(F.col("instruction"), F.lit("")) != "", F.col("instruction")).otherwise(F.col("question")))


def has_run(c: Column) -> Column:
    """Nine equal characters in a row."""
    return c.rlike(r"([^\n])\1{8,}")


def terms(c: Column, limit: int = 120) -> Column:
    """Different words of a clean text in order of appearance, without stop-words."""
    raw = F.regexp_extract_all(c, F.lit(r"[A-Za-z][A-Za-z0-9_/\-]{1,30}|[一-鿿A-Za-z0-9]{2,18}"), F.lit(0))
    return F.slice(F.array_distinct(F.filter(raw, lambda x: ~x.isin(*STOPWORDS) & (F.length(x) >= 2))), 1, limit)


def text_format_quality(samples: DataFrame) -> DataFrame:
    """(ordinal, id, format, score, passed): 1 less the penalties of question and answer, left to right in binary floats, rounded half-even to three places."""
    fmt = task_format(F.coalesce("task_type", F.lit("")))
    s = samples.select("ordinal", "id", fmt.alias("format"), question_text().alias("q"), answer_text().alias("a"))
    pt = F.col("format") == "pt"

    def minus(score: Column, cond: Column, by: float) -> Column:
        return score - F.when(cond, F.lit(by)).otherwise(F.lit(0.0))

    def common(score: Column, c: Column, on: Column) -> Column:
        on = on & (c != "")
        score = minus(score, on & c.rlike(T.MOJIBAKE), 0.45)
        score = minus(score, on & has_run(c), 0.25)
        score = minus(score, on & (T.symbol_ratio(c) > 0.32), 0.25)
        return minus(score, on & c.contains("```"), 0.15)

    q, a, ask = F.col("q"), F.col("a"), ~pt
    score = minus(F.lit(1.0), ask & (q == ""), 0.45)
    score = minus(score, ask & (q != "") & (F.length(q) < MIN_QUESTION), 0.25)
    score = common(score, q, ask)
    score = minus(score, ask & q.rlike(r"^[{\[]"), 0.25)
    score = minus(score, a == "", 0.45)
    score = minus(score, (a != "") & (F.length(a) < MIN_ANSWER), 0.25)
    score = common(score, a, F.lit(True))
    qa = F.col("format").isin("sharegpt", "alpaca")
    score = minus(score, qa & a.rlike(r"^[{\[]"), 0.35)
    score = minus(score, qa & a.rlike(INTERNAL), 0.35)
    names = "|".join(sorted(_fields(samples, "output_payload")))
    score = minus(score, qa & a.rlike(rf"(?i)\b({names})\b\s*[:：]"), 0.35) if names else score
    score = minus(score, pt & a.rlike(TRAINING), 0.35)
    return s.withColumn("raw", score).select("ordinal", "id", "format", F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), "raw")), 3).alias("score"), (F.col("raw") >= FORMAT_THRESHOLD).alias("passed"))


def _fields(samples: DataFrame, column: str) -> dict[str, object]:
    """Name and type of the fields of a struct column; none if it isn't there."""
    return {f.name: f.dataType for f in samples.schema[column].dataType.fields} if column in samples.columns else {}


def present(samples: DataFrame, column: str) -> Column:
    """Names of the fields of a struct column that hold something: text that isn't blank, an array that isn't empty, any other value."""

    def holds(name: str, kind: object) -> Column:
        c = F.col(f"{column}.{name}")
        return F.length(T.clean_text(c)) > 0 if kind.simpleString() == "string" else F.coalesce(F.size(c), F.lit(0)) > 0 if isinstance(kind, ArrayType) else c.isNotNull()

    return F.array_compact(F.array(*(F.when(holds(n, k), F.lit(n)) for n, k in _fields(samples, column).items()), F.lit(None).cast("string")))


def lacks_fields(samples: DataFrame) -> Column:
    """Whether a required field of the sample's task is neither in its output nor in its evidence."""
    asked = F.create_map(*[x for t, fs in REQUIRED.items() for x in (F.lit(t), F.array(*map(F.lit, fs)))])[F.coalesce("task_type", F.lit(""))]
    there = F.array_union(present(samples, "output_payload"), present(samples, "evidence"))
    return F.coalesce(F.size(F.array_except(asked, there)), F.lit(0)) > 0


def is_bound(samples: DataFrame) -> Column:
    """Whether a figure sample's evidence is that of its own block: the block is among the evidence; a binding, where the evidence has one, names it, and a rule says so."""
    block = F.coalesce("metadata.block_id", F.lit(""))
    ok = (block != "") & F.coalesce(F.array_contains("evidence.evidence_block_ids", block), F.lit(False))
    there = _fields(samples, "evidence")
    if "figure_context_binding" in there:
        ok = ok & F.col("evidence.figure_context_binding.target_block_id").eqNullSafe(block)
    if "context_binding_rule" in there:
        ok = ok & F.coalesce(F.col("evidence.context_binding_rule").rlike("target|same"), F.lit(False))
    return ok


def gate(samples: DataFrame, pages: DataFrame | None = None, missing: DataFrame | None = None, generic: DataFrame | None = None, passed: DataFrame | None = None) -> DataFrame:
    """(ordinal, id, reason): the first rule that a sample fails, NULL if it passes.

    In order: task, id, short (corpus text of 80), instruction, payload, low_value (the page's type; layout descriptions may), fields, pages, cross_page (two pages), images, files, binding, generic, bounds, quality.
    `pages` (journal_id, page_index, page_type), `missing` (ordinal, image: images that are no files), `generic` (ordinal, generic: of figure samples) and `passed` (ordinal, passed) are joined by key; a rule whose table isn't given fails nobody.
    """
    s = samples
    if pages is not None:
        kind = pages.groupBy(F.col("journal_id").alias("_j"), F.col("page_index").alias("_p")).agg(F.max("page_type").alias("_type"))
        s = s.join(kind, (s["metadata.journal_id"] == kind["_j"]) & (s["metadata.page_index"] == kind["_p"]), "left")
    else:
        s = s.withColumn("_type", F.lit(None).cast("string"))
    s = s.join(missing.select("ordinal").distinct().withColumn("_missing", F.lit(True)), "ordinal", "left") if missing is not None else s.withColumn("_missing", F.lit(False))
    s = s.join(generic.select("ordinal", F.col("generic").alias("_generic")), "ordinal", "left") if generic is not None else s.withColumn("_generic", F.lit(True))
    s = s.join(passed.select("ordinal", F.col("passed").alias("_passed")), "ordinal", "left") if passed is not None else s.withColumn("_passed", F.lit(True))
    task, fmt = F.coalesce("task_type", F.lit("")), task_format(F.coalesce("task_type", F.lit("")))
    n_pages = F.coalesce(F.size(F.array_distinct("evidence.source_pages")), F.lit(0))
    n_images = F.coalesce(F.size("images"), F.lit(0))
    low = F.coalesce(F.col("_type"), F.lit("")).isin(*LOW_VALUE)
    reason = (
        F.when(fmt == "unknown", "task")
        .when(F.coalesce("id", F.lit("")) == "", "id")
        .when((fmt == "pt") & (F.length(T.clean_text(corpus_text())) < 80), "short")
        .when((fmt != "pt") & (T.clean_text("instruction") == ""), "instruction")
        .when((fmt != "pt") & (F.size(present(samples, "output_payload")) == 0), "payload")
        .when(low & (task != LAYOUT_TASK), "low_value")
        .when(lacks_fields(samples), "fields")
        .when(n_pages < 1, "pages")
        .when((task == CROSS_TASK) & (n_pages < 2), "cross_page")
        .when(task.isin(*ILLUSTRATED) & (n_images < 1), "images")
        .when(F.coalesce("_missing", F.lit(False)), "files")
        .when((task == FIGURE_TASK) & ~is_bound(samples), "binding")
        .when((task == FIGURE_TASK) & ~F.coalesce("_generic", F.lit(False)), "generic")
        .when((task == CROSS_TASK) & ~n_images.between(2, 3), "bounds")
        .when(~F.coalesce("_passed", F.lit(False)), "quality")
    )
    return s.select("ordinal", "id", reason.alias("reason"))


def failures(gated: DataFrame, samples: DataFrame) -> DataFrame:
    """Per task: samples, those that failed, and the first five different reasons in the order in which they came."""
    j = gated.join(samples.select("ordinal", F.coalesce("task_type", F.lit("none")).alias("task")), "ordinal")
    first = j.groupBy("task", "reason").agg(F.count("*").alias("n"), F.min("ordinal").alias("at"))
    failed = F.col("reason").isNotNull()
    return first.groupBy("task").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("n_failed"), F.slice(F.sort_array(F.collect_list(F.when(failed, F.struct("at", "reason")))), 1, 5).alias("r")).select("task", "n", "n_failed", F.transform("r", lambda x: x["reason"]).alias("reasons"))


def term_overlap(samples: DataFrame) -> DataFrame:
    """Different words that question and answer share."""
    return samples.select("ordinal", F.size(F.array_intersect(terms(question_text()), terms(answer_text()))).alias("shared"), F.size(terms(answer_text())).alias("n_terms"))


def content_hash() -> Column:
    """Hash of the corpus text, or of question, answer and payload."""
    body = F.coalesce(F.col("output_payload.text"), F.lit(""))
    other = F.concat_ws("\x1f", F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit("")), F.coalesce(F.col("output_payload.summary"), F.lit("")))
    return F.sha2(F.when(body != "", body).otherwise(other), 256)


def first_of(samples: DataFrame) -> DataFrame:
    """Rules taken one by one: ordinals kept as the first of their id, of their content in the journal, and within the quota of their page and task."""
    m = F.col("metadata")
    s = samples.select("ordinal", "id", m["journal_id"].alias("j"), m["article_id"].alias("a"), m["page_index"].alias("p"), m["task_type"].alias("t"), content_hash().alias("h"))
    rank = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy("ordinal"))
    s = s.withColumn("by_id", rank("j", "id")).withColumn("by_content", rank("j", "h")).withColumn("by_page", rank("j", "a", "p", "t"))
    return s.select("ordinal", (F.col("by_id") == 1).alias("first_id"), (F.col("by_content") == 1).alias("first_content"), (F.col("by_page") <= QUOTA).alias("in_quota"))


@F.pandas_udf(ArrayType(LongType()))
def grams(texts: pd.Series) -> pd.Series:
    """Different runs of three characters of the lower-cased letters, figures and underscores of a text, as codes of 21 bits a character; a shorter text is one run, nothing gives none."""

    def one(t: str | None) -> np.ndarray:
        s = re.sub(r"\W+", "", (t or "").lower())
        c = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        if len(c) < 3:
            return np.array([sum(int(x) << (21 * i) for i, x in enumerate(c))] if len(c) else [], dtype=np.int64)
        return np.unique((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])

    return texts.map(one)


def near_pairs(samples: DataFrame, threshold: float = 0.92) -> DataFrame:
    """(j, a, b) with ordinal a < b: corpus samples of a journal whose larger of similarity and containment reaches `threshold`.

    Prefix filter: runs are ordered from rare to frequent within the journal; two texts that agree that much share a run among the first n - ceil(threshold * n) + 1 of the smaller,
    so only those are joined, with all runs of the others. Overlaps are then counted exactly.
    """
    s = samples.filter(F.col("task_type") == CORPUS).select("ordinal", F.col("metadata.journal_id").alias("j"), grams(corpus_text()).alias("g")).filter(F.size("g") > 0)
    s = checkpoint(s.withColumn("n", F.size("g")))  # the runs are read four times
    every = s.select("ordinal", "j", "n", F.explode("g").alias("gram"))
    df = every.groupBy("j", "gram").agg(F.count("*").alias("df"))
    ranked = every.join(df, ["j", "gram"]).withColumn("r", F.row_number().over(W.partitionBy("ordinal").orderBy("df", "gram")))
    head = ranked.filter(F.col("r") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1).select("j", "gram", F.col("ordinal").alias("o1"), F.col("n").alias("n1"))
    pairs = head.join(every.select("j", "gram", F.col("ordinal").alias("o2"), F.col("n").alias("n2")), ["j", "gram"]).filter("o1 <> o2 AND (n1 < n2 OR (n1 = n2 AND o1 < o2))").select("j", "o1", "o2").distinct()
    both = pairs.join(s.select(F.col("ordinal").alias("o1"), F.col("g").alias("g1")), "o1").join(s.select(F.col("ordinal").alias("o2"), F.col("g").alias("g2")), "o2")
    common = F.size(F.array_intersect("g1", "g2"))
    # the containment in the smaller text is never below the similarity
    return both.filter(common / F.least(F.size("g1"), F.size("g2")) >= threshold).select("j", F.least("o1", "o2").alias("a"), F.greatest("o1", "o2").alias("b"))


def deduplicate(samples: DataFrame, near: DataFrame) -> DataFrame:
    """Ordinals that a pass in order keeps: dropped are, within a journal, a kept id, a full page quota, kept content, and (corpus) a near-duplicate of a kept text.

    What is dropped leaves no trace, so the rules depend on each other and on order. They are settled in rounds: a row is dropped as soon as a kept row before it drops it, and kept as soon as no
    open row before it could. The first open row is settled in every round, so the rounds end; rows that share nothing are settled in the first. What a round needs of a key are its first kept and its
    first open ordinal, or of a slot the QUOTA-th of each, all pre-aggregated, so a hot key is no task's. Each round is cut with checkpoint().
    """
    m = F.col("metadata")
    j = F.coalesce(m["journal_id"], F.lit(""))
    s = samples.select("ordinal", F.xxhash64(j, F.lit("id"), "id").alias("i"), F.xxhash64(j, m["article_id"], m["page_index"], m["task_type"]).alias("slot"), F.xxhash64(j, F.lit("content"), content_hash()).alias("h"))
    # Rows that share no id or content, whose slot isn't overfull and that are near to nothing need no round.
    alone = s
    for key, most in (("i", 1), ("h", 1), ("slot", QUOTA)):
        alone = alone.join(s.groupBy(key).agg(F.count("*").alias(f"n_{key}")).withColumn(f"crowd_{key}", F.col(f"n_{key}") > most), key)
    pairs = checkpoint(near.select("a", "b").distinct())
    ends = pairs.select(F.explode(F.array("a", "b")).alias("ordinal")).distinct().withColumn("_near", F.lit(True))
    marked = checkpoint(alone.join(ends, "ordinal", "left").select("ordinal", "i", "h", "slot", (F.col("crowd_i") | F.col("crowd_h") | F.col("crowd_slot") | F.coalesce("_near", F.lit(False))).alias("tied")))
    # A free row fills a place of its slot only where the slot isn't overfull, and then nobody else there is short of one.
    free = marked.filter("NOT tied").select("ordinal")
    state = checkpoint(marked.filter("tied").select("ordinal", "i", "h", "slot", F.lit(None).cast("boolean").alias("kept")))

    def first(rows: DataFrame, key: str) -> DataFrame:
        return rows.groupBy(key).agg(F.min(F.when(F.col("kept"), F.col("ordinal"))).alias(f"kept_{key}"), F.min(F.when(F.col("kept").isNull(), F.col("ordinal"))).alias(f"open_{key}"))

    def full(rows: DataFrame, name: str) -> DataFrame:
        w = W.partitionBy("slot").orderBy("ordinal")
        return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= QUOTA).filter(F.col("_r") == QUOTA).select("slot", F.col("ordinal").alias(name))

    while not state.filter("kept IS NULL").isEmpty():
        live = state.filter("kept IS NULL OR kept")
        known = state.select(F.col("ordinal").alias("a"), F.col("kept").alias("_k"))
        # the rows of an earlier partner that is still open, or kept
        partner = pairs.join(known, "a").groupBy(F.col("b").alias("ordinal")).agg(F.max(F.col("_k")).alias("near_kept"), F.max(F.col("_k").isNull()).alias("near_open"))
        r = state.join(first(live, "i"), "i", "left").join(first(live, "h"), "h", "left").join(full(live.filter("kept"), "full_kept"), "slot", "left").join(full(live, "full_any"), "slot", "left").join(partner, "ordinal", "left")
        before = lambda c: F.coalesce(F.col(c) < F.col("ordinal"), F.lit(False))
        dropped = before("kept_i") | before("kept_h") | before("full_kept") | F.coalesce("near_kept", F.lit(False))
        waits = before("open_i") | before("open_h") | F.coalesce(F.col("full_any") < F.col("ordinal"), F.lit(False)) | F.coalesce("near_open", F.lit(False))
        state = checkpoint(r.select("ordinal", "i", "h", "slot", F.coalesce("kept", F.when(dropped, F.lit(False)).when(~waits, F.lit(True))).alias("kept")))
    return free.unionByName(state.filter("kept").select("ordinal"))


def clean_scalar(c: Column, limit: int = 900) -> Column:
    """A text for readers: white space as one blank, boxes and block ids taken out, separators at the ends too, cut with three dots."""
    t = F.regexp_replace(F.regexp_replace(T.clean_text(c), r"(?i)\bbbox\s*=\s*\[[^\]]*\]", ""), r"(?i)\bblock_id\s*[:=]\s*[\w.-]+", "")
    t = F.regexp_replace(t, r"^[ ,;，；]+|[ ,;，；]+$", "")
    return F.when(F.length(t) > limit, F.concat(F.rtrim(F.left(t, F.lit(limit))), F.lit("..."))).otherwise(t) if limit > 0 else t


def usable_answer() -> Column:
    """The sample's own answer; '' if it is JSON or lets field names show."""
    a = clean_scalar(F.col("answer"), 5000)
    json = a.rlike(r"^[{\[]") & (F.try_parse_json(clean_scalar(F.col("answer"), 0)).isNotNull() | a.rlike(r"^[{\[]\s*['\"]?(instruction|answer|output_payload|input_payload|metadata)"))
    return F.when(json | a.rlike(INTERNAL) | a.rlike(rf"(?i)\b({'|'.join(sorted(RAW_NAMES))})\b\s*[:：]"), "").otherwise(a)


def _value(samples: DataFrame, name: str, limit: int) -> Column:
    """A payload field as text: strings cleaned, arrays of strings joined; '' where the table has no such field."""
    kind = _fields(samples, "output_payload").get(name)
    c = F.col(f"output_payload.{name}")
    if kind is None:
        return F.lit("")
    if isinstance(kind, ArrayType):
        return F.coalesce(clean_scalar(F.array_join(F.filter(F.transform(F.slice(c, 1, 6), lambda x: clean_scalar(x, min(limit, 420))), lambda x: x != ""), "；"), limit), F.lit(""))
    return clean_scalar(c.cast("string"), limit)


def lines(samples: DataFrame, of: tuple[tuple[str, str, int], ...]) -> Column:
    """Lines of `label：text` for the payload's fields, (label, field, limit), that hold something."""
    parts = [(label, _value(samples, name, limit)) for label, name, limit in of]
    return F.array_join(F.array_compact(F.array(*(F.when(v != "", F.concat(F.lit(f"{label}："), v)) for label, v in parts), F.lit(None).cast("string"))), "\n")


def export_answer(samples: DataFrame) -> Column:
    """The answer that is exported: the sample's own if usable, else the payload's fields as labelled lines (chat tasks have their own choice of fields), else a sentence or the payload as JSON."""
    task = F.col("task_type")
    every = lines(samples, tuple((label, name, 1000) for name, label in LABELS.items() if label))
    bare = [n for n in _fields(samples, "output_payload") if not LABELS.get(n)]
    values = F.array_join(F.filter(F.array(*(_value(samples, n, 700) for n in bare), F.lit("")), lambda x: x != ""), "\n")
    summary = F.when(every != "", every).otherwise(values)
    chat = F.lit("")
    for name, of in CHAT_LINES.items():
        chat = F.when(task == name, lines(samples, of)).otherwise(chat)
    shown = F.when(task.isin(*FORMATS["sharegpt"]), F.when(chat != "", chat).otherwise(NO_ANSWER)).otherwise(F.when(summary != "", summary).otherwise(F.to_json("output_payload")))
    return F.when(usable_answer() != "", usable_answer()).otherwise(shown)


def to_sharegpt(samples: DataFrame) -> DataFrame:
    """Chat records: one image token per image before the instruction, then the answer; metadata and images with them."""
    tokens = F.repeat(F.lit(IMAGE_TOKEN), F.coalesce(F.size("images"), F.lit(0)))
    user = F.trim(F.concat(tokens, F.trim(F.replace(F.coalesce("instruction", F.lit("")), F.lit(IMAGE_TOKEN), F.lit("")))))
    messages = F.array(F.struct(F.lit("user").alias("role"), user.alias("content")), F.struct(F.lit("assistant").alias("role"), export_answer(samples).alias("content")))
    return samples.filter(F.col("task_type").isin(*FORMATS["sharegpt"])).select("ordinal", "id", messages.alias("messages"), *(["metadata"] if "metadata" in samples.columns else []), F.when(F.size("images") > 0, F.col("images")).alias("images"))


def to_alpaca(samples: DataFrame) -> DataFrame:
    """Instruction records. The input is the sample's export_input, else its input payload as JSON."""
    json = F.to_json("input_payload") if "input_payload" in samples.columns else F.lit("{}")
    given = F.when(T.clean_text("export_input") != "", F.col("export_input")).otherwise(json) if "export_input" in samples.columns else json
    more = [c for c in ("metadata",) if c in samples.columns]
    images = [F.when(F.size("images") > 0, F.col("images")).alias("images")] if "images" in samples.columns else []
    return samples.filter(F.col("task_type").isin(*FORMATS["alpaca"])).select("ordinal", F.coalesce("instruction", F.lit("")).alias("instruction"), given.alias("input"), export_answer(samples).alias("output"), *more, *images)


def with_export_input(samples: DataFrame, pages: DataFrame, headings: DataFrame) -> DataFrame:
    """`samples` with export_input of the instruction tasks: the page's text, or the article's title and text, or a section's heading and text.

    `pages`: journal_id, page_index, article_title, full_text; `headings`: journal_id, page_index, block_id, heading, controlled.
    """
    m = F.col("metadata")
    p = pages.select(F.col("journal_id").alias("_j"), F.col("page_index").alias("_p"), F.coalesce("article_title", F.lit("")).alias("_title"), T.truncate_text(F.col("full_text"), 5000).alias("_text"), T.truncate_text(F.col("full_text"), 10000).alias("_long"))
    h = headings.select(F.col("journal_id").alias("_hj"), F.col("page_index").alias("_hp"), F.col("block_id").alias("_hb"), F.col("heading").alias("_head"), F.col("controlled").alias("_body"))
    j = samples.join(p, (m["journal_id"] == p["_j"]) & (m["page_index"] == p["_p"]), "left").join(h, (m["journal_id"] == h["_hj"]) & (m["page_index"] == h["_hp"]) & (m["block_id"] == h["_hb"]), "left")
    t = F.col("task_type")
    two = lambda a, x, b, y: F.regexp_replace(F.concat(F.lit(a), F.coalesce(x, F.lit("")), F.lit(f"\n\n{b}"), F.coalesce(y, F.lit(""))), r"(?U)^\s+|\s+$", "")
    given = (
        F.when(t.isin("article_metadata_extraction", "method_experiment_condition_extraction"), F.coalesce("_text", F.lit("")))
        .when(t == "section_heading_scope_alignment", two("小节标题：", "_head", "正文范围：", "_body"))
        .when(t == "section_keypoint_summary", two("小节标题：", "_head", "小节正文：", "_body"))
        .when(t == "article_contribution_conclusion", two("文章题名：", "_title", "正文片段：", "_long"))
    )
    return j.withColumn("export_input", given).drop("_j", "_p", "_title", "_text", "_long", "_hj", "_hp", "_hb", "_head", "_body")


def to_pt(samples: DataFrame) -> DataFrame:
    """Corpus records of one text each; empty ones are left out."""
    return samples.filter(F.col("task_type") == CORPUS).select("ordinal", F.regexp_replace(corpus_text(), r"(?U)^\s+|\s+$", "").alias("text")).filter("text <> ''")


def figures_to_pt(samples: DataFrame, pages: DataFrame) -> DataFrame:
    """Corpus records of figure samples: article, page and what is said of the object as lines; lines without content are left out. `pages`: journal_id, page_index, article_title, page_label."""
    m = F.col("metadata")
    p = pages.select(F.col("journal_id").alias("_j"), F.col("page_index").alias("_p"), "article_title", "page_label")
    f = samples.filter((F.col("task_type") == FIGURE_TASK) & F.col("output_payload").isNotNull())
    j = f.join(p, (m["journal_id"] == p["_j"]) & (m["page_index"] == p["_p"]), "left")
    title, page = F.coalesce("article_title", F.lit("")), F.coalesce(F.nullif("page_label", F.lit("")), m["page_index"].cast("string"), F.lit(""))
    head = F.array_compact(F.array(F.when(title != "", F.concat(F.lit("文章："), title)), F.when(page != "", F.concat(F.lit("页码："), page)), F.nullif(lines(samples, FIGURE_LINES), F.lit(""))))
    return j.select("ordinal", F.array_join(head, "\n").alias("text")).filter("text <> ''")


def pt_records(samples: DataFrame, pages: DataFrame) -> DataFrame:
    """All corpus records: those of corpus samples and, after them, those of figure samples."""
    return to_pt(samples).withColumn("part", F.lit(0)).unionByName(figures_to_pt(samples, pages).withColumn("part", F.lit(1)))


def export_counts(samples: DataFrame) -> DataFrame:
    """Samples and distinct ids per format and task, with totals."""
    s = samples.select(task_format(F.coalesce("task_type", F.lit(""))).alias("format"), F.coalesce("task_type", F.lit("none")).alias("task"), "id")
    return s.rollup("format", "task").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids")).select(F.coalesce("format", F.lit("all")).alias("format"), F.coalesce("task", F.lit("all")).alias("task"), "n", "n_ids")


def pending(jobs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Jobs without a result."""
    return jobs.join(done.select(*keys).distinct(), keys, "left_anti")


def evidence_blocks(samples: DataFrame, blocks: DataFrame, most: int = 8) -> DataFrame:
    """The first `most` evidence blocks of each sample in order, with their types; ids that name no block of the journal are left out."""
    e = samples.select("ordinal", F.col("metadata.journal_id").alias("journal_id"), F.posexplode("evidence.evidence_block_ids").alias("pos", "block_id"))
    b = blocks.groupBy("journal_id", "block_id").agg(F.min("block_type").alias("block_type"))
    j = e.join(b, ["journal_id", "block_id"]).withColumn("n", F.row_number().over(W.partitionBy("ordinal").orderBy("pos"))).filter(F.col("n") <= most)
    return j.select("ordinal", F.col("n").cast("int").alias("n"), "block_id", "block_type")
