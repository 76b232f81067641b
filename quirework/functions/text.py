"""Text expressions of the page pipeline, as Columns: white space counts as in Unicode, figures too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and lists that results depend on.
FIGURE_CAPTION = r"(?i)^(图|Fig\.?|Figure)\s*[0-9一二三四五六七八九十]+"
TABLE_CAPTION = r"(?i)^(表|Table)\s*[0-9一二三四五六七八九十]+"
LABEL = r"(?i)(图\s*[0-9一二三四五六七八九十]+|表\s*[0-9一二三四五六七八九十]+|式\s*[（(]?\s*[0-9]+|Fig\.?\s*[0-9]+|Figure\s*[0-9]+|Table\s*[0-9]+)"
PAGE_NUMBER = r"^(第\s*)?\p{Nd}{1,4}\s*(页)?$"
REFERENCE = r"^\s*(\[\s*\p{Nd}+\s*\]|\p{Nd}+\.\s+)"
HEADING_SKIP = r"(?i)^(摘\s*要|关键词|Abstract|Key\s*words?)[:：]?"
HEADINGS = (
    r"(?i)^\p{Nd}+(\.\p{Nd}+)*\s+[一-鿿A-Za-z].{1,60}$",
    r"(?i)^[一二三四五六七八九十]+[、.]\s*[一-鿿A-Za-z].{1,60}$",
    r"(?i)^(引言|前言|方法|模型|试验|实验|仿真|结果|分析|讨论|结论|结束语)$",
)
LIST_ITEM = r"^\s*(\p{Nd}+|[一二三四五六七八九十]+)\s*[)）.、]"
PARAGRAPH_END = r"(。|！|？|；|;|\.|\?|!|：|:|”|’|\)|）|\])$"
NO_SPACE_BEFORE = "，。；：、！？,.!?;:%)]}）】”’"
DOI = r"10\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+"
SUBFIGURE = r"[\(（]\s*([A-Za-z])\s*[\)）]"
FIGURE_LABEL = r"(?i)((?:图|Fig\.?|Figure)\s*[0-9０-９]+)"
REFERENCE_MARK = r"\s*(?:\$?\s*\^\s*\{\s*)?[\[［]\s*\p{Nd}+(?:\s*[-–—,，、]\s*\p{Nd}+)*\s*[\]］](?:\s*\}\s*\$?)?"
MOJIBAKE = r"\x{fffd}|锟斤拷|ï¿½|Ã.|Â.|â€|[□\x{fffd}]{2,}"
STRONG_NOISE = r"(?i)PDF\s*过刊|PDF\s*杂志(购买|收藏)|杂志收藏购买|过刊杂志|bfwz\s*\p{Nd}{4,}|hfxx\s*\p{Nd}{4,}|购买微信|影印微信"
NOISE_SIGNALS = (
    r"杂志社声明", r"本刊声明", r"郑重声明", r"邮发代号", r"订阅", r"邮购", r"汇款", r"发行部", r"编辑部电话", r"广告经营许可", r"广告服务", r"扫码关注", r"二维码", r"微信公众号",
    r"微信[:：]", r"微店", r"淘宝", r"京东", r"全年\s*\p{Nd}+\s*期", r"定价[:：]?\s*\p{Nd}", r"零售价", r"单价", r"盗版", r"版权所有", r"侵权必究", r"0\p{Nd}{2,3}-\p{Nd}{7,8}",
    r"(?i)www\.[A-Za-z0-9.-]+\.(?:com|cn|net|org)", r"(?i)QQ\s*[:：]?\s*\p{Nd}{5,}", r"投稿邮箱", r"征订",
)


def clean_text(c: Column | str) -> Column:
    """NULL to '', runs of white space to one blank, ends trimmed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s\x1c-\x1f]+", " "))


def truncate_text(c: Column, limit: int) -> Column:
    """Clean text cut to `limit` characters, blanks at the end removed."""
    return F.rtrim(F.left(clean_text(c), F.lit(limit)))


def truncate_at_break(c: Column, limit: int) -> Column:
    """Text cut to `limit` characters, at its last line end or full stop if that lies in the second half."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")
    cut = F.regexp_replace(F.left(t, F.lit(limit)), r"(?U)\s+$", "")
    tail = F.regexp_extract(cut, r"([^\n。]*)$", 1)
    at = F.length(cut) - F.length(tail)  # length up to and with the last break, 0 without one
    return F.when(F.length(t) <= limit, t).when(at - 1 > limit // 2, F.regexp_replace(F.left(cut, at), r"(?U)\s+$", "")).otherwise(cut)


def caption_kind(c: Column) -> Column:
    """figure_caption, table_caption or '' of a clean text."""
    return F.when(c.rlike(FIGURE_CAPTION), F.lit("figure_caption")).when(c.rlike(TABLE_CAPTION), F.lit("table_caption")).otherwise(F.lit(""))


def caption_label(c: Column) -> Column:
    """The first label of a figure, table or formula in a clean text; ''."""
    return F.trim(F.regexp_extract(c, LABEL, 1))


def is_section_heading(c: Column) -> Column:
    hit = c.rlike(HEADINGS[0]) | c.rlike(HEADINGS[1]) | c.rlike(HEADINGS[2])
    return (c != "") & (F.length(c) <= 80) & ~c.rlike(HEADING_SKIP) & hit


def is_reference(c: Column) -> Column:
    return c.rlike(REFERENCE) | c.contains("参考文献")


def keywords(c: Column) -> Column:
    """The entries of a keyword line."""
    body = F.trim(F.regexp_replace(c, r"(?i)^(关键词|Key\s*words?)\s*[:：]?", ""))
    parts = F.transform(F.split(body, r"[;；,，]\s*"), lambda x: F.regexp_replace(x, r"^[ ;；,，]+|[ ;；,，]+$", ""))
    return F.filter(parts, lambda x: x != "")


def symbol_ratio(c: Column) -> Column:
    """Share of signs that are neither letters, figures nor usual punctuation; 0 for nothing."""
    compact = F.regexp_replace(c, r"(?U)\s+", "")
    normal = F.length(F.regexp_replace(compact, r"[^一-鿿A-Za-z0-9，。；：？！、,.!?;:()\[\]{}<>《》“”\"'/%+\-=—_·&~]", ""))
    return F.when(F.length(compact) == 0, F.lit(0.0)).otherwise(F.lit(1.0) - normal / F.length(compact))


def noise_signals(c: Column) -> Column:
    """How many different signs of an advertisement a text has."""
    total = F.lit(0)
    for p in NOISE_SIGNALS:
        total = total + c.rlike(p).cast("int")
    return total


def is_advertisement(c: Column) -> Column:
    hits = noise_signals(c)
    return c.rlike(STRONG_NOISE) | (hits >= 4) | ((hits >= 2) & (F.length(c) <= 1200))


def clean_corpus_text(c: Column) -> Column:
    """Corpus text: citation marks removed line by line, blanks before punctuation removed, at most one blank line in a row."""
    lines = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?", "\n"), "\n")

    def line(x: Column) -> Column:
        x = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""), REFERENCE_MARK, ""), r"(?U)\s+", " "))
        return F.regexp_replace(x, r"\s+([，。；：！？、,.!?;:])", "$1")

    # a line that becomes empty, or is OSID:, goes; an empty line stays as a break
    kept = F.filter(F.transform(lines, lambda x: F.struct((F.trim(F.regexp_replace(x, r"(?U)\s+", " ")) == "").alias("blank"), line(x).alias("text"))), lambda r: r["blank"] | ((r["text"] != "") & (F.upper(r["text"]) != "OSID:")))
    joined = F.array_join(F.transform(kept, lambda r: F.when(r["blank"], F.lit("")).otherwise(r["text"])), "\n")
    return F.regexp_replace(F.regexp_replace(joined, r"\n{3,}", "\n\n"), r"^\n+|\n+$", "")
