"""Sources: journal files, content lists, JSON lines with bad rows."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The keys of a content list's item, in the order in which they are tried.
TEXT_KEYS = ("text", "content", "markdown", "md_content", "title", "caption", "table_caption", "image_caption", "table_body", "html", "latex")
BOX_KEYS = ("bbox", "box", "poly")
PAGE_KEYS = ("page_idx", "page_index", "page", "page_no")  # the first counts from 0
BLOCK_TYPES = {
    "title": "title", "section": "section_title", "section_title": "section_title", "text": "text", "paragraph": "text", "image": "figure", "figure": "figure", "figure_caption": "figure_caption", "caption": "figure_caption", "table": "table",
    "table_caption": "table_caption", "formula": "formula", "equation": "formula", "list": "list", "header": "header", "footer": "footer", "page_number": "page_number", "reference": "reference", "unknown": "unknown",
}
#: Pages, which may be numbers or digits in quotes, and boxes, which may be nested, are read as text.
ITEM = T.StructType([T.StructField("type", T.StringType()), *(T.StructField(k, T.StringType()) for k in (*PAGE_KEYS, *BOX_KEYS, *TEXT_KEYS))])


def _empty_files(spark: SparkSession, folder: str, recursive: bool, suffix: str = ".pdf") -> list[str]:
    """Files of no bytes, which Spark's file sources pass over."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    it = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, recursive)
    found = []
    while it.hasNext():
        f = it.next()
        if f.getLen() == 0 and f.getPath().getName().endswith(suffix):
            found.append(f.getPath().toString())
    return found


def journal_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """PDF files under a folder, by path: size, hash, page count by the raw marks, and for unreadable ones a reason; those are rows too, not failures."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.pdf").load(folder)
    raw = F.decode("content", "ISO-8859-1")
    pages = F.regexp_count(raw, F.lit(r"/Type\s*/Page\b"))
    reason = F.when(~raw.startswith("%PDF"), "no header").when(pages == 0, "no pages")
    read = df.select("path", F.col("length").alias("file_size"), F.sha2("content", 256).alias("file_hash"), F.nullif(pages, F.lit(0)).alias("page_count"), reason.alias("reason"))
    empty = [(p, 0, None, None, "empty") for p in _empty_files(spark, folder, recursive)]
    return read.unionByName(spark.createDataFrame(empty, read.schema)).orderBy("path")


# How a name tells its issue, in the order in which the forms are tried.
ISSUES = (r"(20\p{Nd}{2})\s*年\s*第?\s*(\p{Nd}+)\s*卷\s*第?\s*(\p{Nd}+)\s*期", r"(20\p{Nd}{2})\P{Nd}{0,3}(\p{Nd}+)\P{Nd}{0,3}(\p{Nd}+)")
YEAR = r"(20\p{Nd}{2})"


def issue_fields(name: Column) -> dict[str, Column]:
    """year, volume and issue as a name tells them: all three from the first form that fits, else the year alone; ''."""
    out = {}
    for k, field in enumerate(("year", "volume", "issue"), 1):
        c = F.regexp_extract(name, YEAR, 1) if field == "year" else F.lit("")
        for form in reversed(ISSUES):
            c = F.when(name.rlike(form), F.regexp_extract(name, form, k)).otherwise(c)
        out[field] = F.coalesce(c, F.lit(""))
    return out


def journal_rows(inputs: DataFrame, ids: DataFrame | None = None, unknown: str = "untitled_journal") -> DataFrame:
    """One row per listed journal: path, journal_name, journal_id, year, volume, issue.

    `inputs` has any of path, source_pdf, address, url (the first that isn't empty; a row without one is an error), journal_name, name, journal_id. The name is the file's without its ending where none is given; the id is
    the given one, else the one that `ids` (name, journal_id) has for the file's name, the journal's name or that with .pdf, else the name made safe. Repeated rows come again.
    """
    from quirework.operators.samples import safe_name

    some = lambda *names: F.coalesce(*(F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n in inputs.columns), F.lit(None).cast("string"))
    path = some("path", "source_pdf", "address", "url")
    file = F.regexp_extract(F.replace(path, F.lit("\\"), F.lit("/")), r"([^/]*)$", 1)
    rows = inputs.select(F.when(path.isNull(), F.raise_error(F.lit("an input journal has no path"))).otherwise(path).alias("path"), F.coalesce(some("journal_name", "name"), F.regexp_replace(file, r"\.[^.]*$", "")).alias("journal_name"), some("journal_id").alias("_given"), file.alias("_file"))
    known = None
    if ids is not None:
        for k, key in enumerate((F.col("_file"), F.col("journal_name"), F.concat("journal_name", F.lit(".pdf")))):
            one = ids.groupBy(F.col("name").alias(f"_name{k}")).agg(F.min("journal_id").alias(f"_id{k}"))
            rows = rows.withColumn(f"_key{k}", key)
            rows = rows.join(one, rows[f"_key{k}"] == one[f"_name{k}"], "left")
        known = F.coalesce("_id0", "_id1", "_id2")
    made = safe_name(F.col("journal_name"), unknown)
    return rows.select("path", "journal_name", F.coalesce("_given", *([known] if known is not None else []), made).alias("journal_id"), *(c.alias(k) for k, c in issue_fields(F.col("journal_name")).items()))


def block_type(raw: Column) -> Column:
    """The canonical type of a raw block type; unknown for others."""
    m = F.create_map(*[F.lit(x) for kv in BLOCK_TYPES.items() for x in kv])
    return F.coalesce(F.element_at(m, F.lower(F.coalesce(raw, F.lit("")))), F.lit("unknown"))


def item_page() -> Column:
    """The page that an item names by the first of PAGE_KEYS that is a number; NULL if none is."""
    number = lambda k: F.when(F.col(k).cast("string").rlike(r"^[0-9]+$"), F.col(k).cast("int") + (1 if k == PAGE_KEYS[0] else 0))
    return F.coalesce(*map(number, PAGE_KEYS))


def item_box() -> Column:
    """The first four numbers of the first box that isn't empty, nested or not; NULL with fewer."""
    raw = F.coalesce(*(F.when(F.regexp_count(F.col(k), F.lit("[0-9]")) > 0, F.col(k)) for k in BOX_KEYS))
    numbers = F.transform(F.regexp_extract_all(F.regexp_replace(raw, r'"[^"]*"', ""), F.lit(r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?"), F.lit(0)), lambda x: x.cast("double"))
    return F.when(F.size(numbers) >= 4, F.slice(numbers, 1, 4))


def content_items(items: DataFrame, journal: str = "journal_id", ordinal: str = "ordinal") -> DataFrame:
    """Blocks of content-list items (columns of ITEM): page number carried forward from the last item that had one (1 at first), the first box, texts joined."""
    from quirework.operators.pages import last_so_far

    items = last_so_far(items.withColumn("_named", item_page()), [journal], ordinal, "_named")
    page = F.coalesce("_last", F.lit(1))
    text = F.trim(F.regexp_replace(F.concat_ws(" ", *TEXT_KEYS), r"(?U)\s+", " "))
    return items.select(journal, ordinal, page.alias("page_index"), block_type(F.col("type")).alias("block_type"), item_box().alias("bbox"), text.alias("text"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def content_list(payloads: pd.Series) -> pd.Series:
    """The items, as JSON each, of the longest content list in a parse's JSON: a `content_list`, or any list of objects of which one has a type; JSON inside strings is read too. NULL where nothing can be read, and the first of equally long ones."""

    def opened(v: object) -> object:
        if isinstance(v, str) and v.lstrip()[:1] in ("{", "["):
            try:
                return json.loads(v)
            except ValueError:
                return v
        return v

    def one(text: str | None) -> list[str] | None:
        whole = opened(text)
        if not isinstance(whole, (dict, list)):
            return None
        best: list = []
        rest = [whole]
        while rest:
            v = opened(rest.pop())
            lists = [opened(v.get("content_list"))] if isinstance(v, dict) else [v] if isinstance(v, list) and any(isinstance(x, dict) and "type" in x for x in v) else []
            for found in lists:
                if isinstance(found, list) and all(isinstance(x, dict) for x in found) and len(found) > len(best):
                    best = found
            rest.extend(reversed(list(v.values()) if isinstance(v, dict) else v if isinstance(v, list) else []))
        return [json.dumps(x, ensure_ascii=False) for x in best]

    return payloads.map(one)


@F.pandas_udf(T.StringType())
def without_images(payloads: pd.Series) -> pd.Series:
    """A parse's JSON without its `images`, at any depth; what is no JSON stays as it is."""

    def cut(v: object) -> object:
        return {k: cut(x) for k, x in v.items() if k != "images"} if isinstance(v, dict) else [cut(x) for x in v] if isinstance(v, list) else v

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(cut(json.loads(text)), ensure_ascii=False)
        except ValueError:
            return text

    return payloads.map(one)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad): JSON lines by a schema; lines that don't parse are kept aside, blank lines skipped."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.try_parse_json("value").isNotNull().alias("ok"), F.from_json("value", schema).alias("r"))
    good = F.col("ok") & F.trim("value").startswith("{")
    return parsed.filter(good).select("r.*"), parsed.filter(~good).select("value")


def parse_status(items: DataFrame, pages: DataFrame, min_coverage: float = 0.75, min_chars: int = 20) -> DataFrame:
    """Whether each journal's content is complete: items, pages with content against the page count, characters."""
    g = items.groupBy("journal_id").agg(F.count("*").alias("n_items"), F.count_distinct("page_index").alias("n_pages"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("n_chars"))
    j = pages.join(g, "journal_id", "left").fillna(0, ["n_items", "n_pages", "n_chars"])
    need = F.ceil(F.col("page_count") * min_coverage)
    ok = (F.col("n_items") >= 1) & (F.col("n_pages") >= need) & (F.col("n_chars") >= min_chars)
    return j.select("journal_id", "page_count", "n_items", "n_pages", "n_chars", ok.alias("complete"))
