"""Layout of pages: boxes, roles, columns and reading order.

Every operator works on one row per block, keyed by (journal_id, page_index); windows and groups share that key, so one shuffle
serves them all. A page's blocks are bounded by what fits on a page; nothing is gathered by journal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import text as T

PAGE = ["journal_id", "page_index"]
BINS, GUTTER_BINS, MIN_BAND, MAX_COLUMNS, OVERLAP = 400, 5, 0.06, 6, 0.35
NARROW = (0.45, 0.55, 0.65, 0.75, 0.85)
WORDS = {1: "single", 2: "two", 3: "three", 4: "four", 5: "five", 6: "six"}


def deliver_once(blocks: DataFrame) -> DataFrame:
    """The first delivery of each block_uid, told within its page so that later page windows need no further shuffle. NULL ids of a page are one key."""
    w = W.partitionBy(*PAGE).orderBy("block_uid", F.col("ingested_at").asc_nulls_last())
    again = (F.row_number().over(w) > 1) & F.col("block_uid").eqNullSafe(F.lag("block_uid").over(w))
    return blocks.withColumn("_again", again).filter(~F.col("_again")).drop("_again")


def boxes(blocks: DataFrame) -> DataFrame:
    """Adds x0, y0, x1, y1: NULL unless the box has four numbers with right > left and bottom > top; and top and left with their fallbacks (reading order, 0)."""
    b = F.col("bbox")
    at = lambda i: F.get(b, F.lit(i))
    ok = (F.size(b) == 4) & (at(2) > at(0)) & (at(3) > at(1))
    out = blocks.withColumns({n: F.when(ok, at(i)) for i, n in enumerate(("x0", "y0", "x1", "y1"))})
    return out.withColumns({"top": F.coalesce("y0", F.col("reading_order").cast("double")), "left": F.coalesce("x0", F.lit(0.0))})


def page_sizes(boxed: DataFrame) -> DataFrame:
    """Width and height of each page from its largest box; 0 without any."""
    return boxed.groupBy(*PAGE).agg(F.coalesce(F.max("x1").cast("int"), F.lit(0)).alias("width"), F.coalesce(F.max("y1").cast("int"), F.lit(0)).alias("height"), F.count("*").alias("n_blocks"))


def semantic_role(block_type: Column, text: Column, y0: Column, y1: Column, height: Column, page: Column) -> Column:
    """Role of a block: the first of the ordered rules that fits."""
    t, low = text, F.lower(text)
    short = F.length(t) < 80
    return (
        F.when(t.rlike(T.STRONG_NOISE), "watermark")
        .when(block_type == "header", "journal_header")
        .when(block_type == "footer", "footer")
        .when((block_type == "page_number") | t.rlike(T.PAGE_NUMBER), "page_number")
        .when(y0.isNotNull() & (height > 0) & (y0 <= height * 0.05) & short, "journal_header")
        .when(y1.isNotNull() & (height > 0) & (y1 >= height * 0.95) & short, "footer")
        .when(T.caption_kind(t) != "", T.caption_kind(t))
        .when(block_type == "formula", "formula")
        .when(t.rlike(r"^摘\s*要") | low.startswith("abstract"), "abstract")
        .when(t.startswith("关键词") | t.rlike(r"(?i)^key\s*words?"), "keywords")
        .when(t.startswith("http://") | t.startswith("https://"), "journal_header")
        .when(F.upper(t).contains("DOI") | t.contains("中图分类号") | t.contains("文献标识码") | t.contains("收稿日期"), "journal_header")
        .when(t.startswith("\\* 通信作者") | t.startswith("* 通信作者") | t.startswith("通信作者") | t.startswith("引用格式"), "footer")
        .when(T.is_reference(t), "reference")
        .when(T.is_section_heading(t) | block_type.isin("title", "section_title"), F.when((page == 1) & (F.length(t) > 8) & ~t.rlike(r"^\p{Nd}"), "article_title").otherwise("section_heading"))
        .when(t != "", "body")
        .otherwise("unknown")
    )


def roles(boxed: DataFrame) -> DataFrame:
    """Adds `role`, from type, clean text, place on the page and page number. The page's height is a window over its blocks."""
    height = F.max("y1").over(W.partitionBy(*PAGE))
    out = boxed.withColumn("_h", F.coalesce(height.cast("int"), F.lit(0))).withColumn("_t", T.clean_text("text"))
    return out.withColumn("role", semantic_role(F.coalesce("block_type", F.lit("")), F.col("_t"), F.col("y0"), F.col("y1"), F.col("_h"), F.col("page_index"))).drop("_h", "_t")


def column_bands(boxed: DataFrame) -> DataFrame:
    """Columns of each page: band (0..), lo, hi in page units.

    For each threshold the blocks narrower than that share of the page's width are projected on the x axis (BINS bins); gaps of GUTTER_BINS part the
    runs, runs of less than MIN_BAND of the width are left out. The threshold with most runs up to MAX_COLUMNS wins, the smallest among equals. Runs come from the running maximum of the
    intervals' ends, so no bins are made. Pages without a box or width have no rows.
    """
    width = F.max("x1").over(W.partitionBy(*PAGE)).cast("int").cast("double")
    b = boxed.select(*PAGE, "x0", "x1", width.alias("width")).filter("x0 IS NOT NULL AND width > 0")
    b = b.withColumn("ratio", F.explode(F.array(*map(F.lit, NARROW)))).filter(F.col("x1") - F.col("x0") < F.col("width") * F.col("ratio"))
    lo = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), (F.col("x0") / F.col("width") * BINS).cast("int")))
    b = b.withColumn("lo", lo).withColumn("hi", F.greatest(F.col("lo") + 1, F.least(F.lit(BINS), F.ceil(F.col("x1") / F.col("width") * BINS).cast("int"))))
    w = W.partitionBy(*PAGE, "ratio").orderBy("lo", "hi")
    b = b.withColumn("_reach", F.max("hi").over(w.rowsBetween(W.unboundedPreceding, -1)))
    b = b.withColumn("run", F.sum((F.col("_reach").isNull() | (F.col("lo") - F.col("_reach") >= GUTTER_BINS)).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    runs = b.groupBy(*PAGE, "ratio", "run", "width").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    last = F.max("run").over(W.partitionBy(*PAGE, "ratio"))
    runs = runs.withColumn("hi", F.when((F.col("run") == last) & (BINS - F.col("hi") < GUTTER_BINS), BINS).otherwise(F.col("hi")))
    runs = runs.filter((F.col("hi") - F.col("lo")) / F.lit(float(BINS)) >= MIN_BAND)
    band = F.struct((F.col("lo") / F.lit(float(BINS)) * F.col("width")).alias("lo"), (F.col("hi") / F.lit(float(BINS)) * F.col("width")).alias("hi"))
    found = runs.groupBy(*PAGE, "ratio").agg(F.array_sort(F.collect_list(band)).alias("bands")).filter(F.size("bands") <= MAX_COLUMNS)
    best = found.groupBy(*PAGE).agg(F.max_by("bands", F.struct(F.size("bands"), -F.col("ratio"))).alias("bands"))
    return best.select(*PAGE, F.posexplode("bands").alias("band", "b")).select(*PAGE, "band", "b.lo", "b.hi")


def assign_columns(boxed: DataFrame) -> DataFrame:
    """Adds col_index (-1 for none), col_label and span to each block.

    A block belongs to the one band that it overlaps by more than OVERLAP of the narrower of both; several make it full_width or cross_column; none puts it to the
    nearest band's middle. Where a page has no band, all of its boxes make one. Blocks without a box are 'unknown'.
    """
    bands = column_bands(boxed).groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("band", "lo", "hi"))).alias("bands"))
    page = W.partitionBy(*PAGE)
    one = F.array(F.struct(F.lit(0).alias("band"), F.min("x0").over(page).alias("lo"), F.max("x1").over(page).alias("hi")))
    b = boxed.join(bands, PAGE, "left").withColumn("bands", F.when(F.max("x1").over(page) >= 1, F.coalesce("bands", one)))
    wide = F.greatest(F.lit(1e-6), F.col("x1") - F.col("x0"))
    hit = F.filter("bands", lambda x: F.least(F.col("x1"), x["hi"]) - F.greatest(F.col("x0"), x["lo"]) > F.least(wide, x["hi"] - x["lo"]) * OVERLAP)
    middle = (F.col("x0") + F.col("x1")) / 2
    near = F.array_min(F.transform("bands", lambda x: F.struct(F.abs(middle - (x["lo"] + x["hi"]) / 2.0).alias("d"), x["band"].alias("band"))))["band"]
    n, total = F.size(hit), F.size("bands")
    has = F.col("x0").isNotNull() & F.col("bands").isNotNull()
    index = F.when(~has | (n > 1), -1).when(n == 1, F.get(hit, F.lit(0))["band"]).otherwise(near)
    b = b.withColumn("col_index", index.cast("int"))
    name = F.when(total == 1, "single").when(total == 2, F.when(F.col("col_index") == 0, "left").otherwise("right")).otherwise(F.concat(F.lit("col"), (F.col("col_index") + 1).cast("string")))
    b = b.withColumn("col_label", F.when(~has, "unknown").when(n > 1, "full_width").otherwise(name))
    return b.withColumn("span", F.when(has & (n > 1), F.when(n >= total, "full_width").otherwise("cross_column")).otherwise("single_column")).drop("bands")


def column_modes(assigned: DataFrame) -> DataFrame:
    """Column mode of each page, from its populated columns and spanning blocks, and how many columns it names."""
    g = assigned.groupBy(*PAGE).agg(F.count_distinct(F.when(F.col("col_index") >= 0, F.col("col_index"))).alias("populated"), F.count(F.when(F.col("span") != "single_column", 1)).alias("spanning"))
    word = F.element_at(F.create_map(*[F.lit(x) for kv in WORDS.items() for x in kv]), F.col("populated").cast("int"))
    mode = (
        F.when(F.col("populated") >= 2, F.concat(F.when(F.col("spanning") > 0, F.lit("mixed_full_width_and_")).otherwise(F.lit("")), word, F.lit("_column")))
        .when((F.col("spanning") > 0) & (F.col("populated") > 0), "mixed_full_width_and_single_column")
        .when(F.col("spanning") > 0, "full_width")
        .when(F.col("populated") > 0, "single_column")
        .otherwise("unknown")
    )
    return g.select(*PAGE, mode.alias("mode"), F.when(F.col("populated") >= 2, F.col("populated")).when(mode.like("%single_column"), 1).otherwise(0).cast("int").alias("n_columns"))


def is_noise(role: Column, text: Column) -> Column:
    return (role == "watermark") | (role.isin("journal_header", "footer", "page_number", "unknown") & (T.clean_text(text) == ""))


def reading_order(assigned: DataFrame) -> DataFrame:
    """Adds new_order (1..n) to the blocks that aren't noise; needs `role`, columns and boxes.

    On pages with two columns and more, blocks without a column part the page into bands; in each band columns are read from left to right, each from top to
    bottom. Elsewhere blocks are read from top to bottom. The last tie-breaker is the block's ordinal.
    """
    page = W.partitionBy(*PAGE)
    c = assigned.filter(~is_noise(F.coalesce("role", F.lit("unknown")), F.col("text")))
    c = c.withColumn("_multi", F.size(F.collect_set(F.when(F.col("col_index") >= 0, F.col("col_index"))).over(page)) >= 2)
    sep = (F.col("col_index") < 0).cast("int")
    above = F.sum(sep).over(page.orderBy("top").rangeBetween(W.unboundedPreceding, W.currentRow))
    rank = F.row_number().over(W.partitionBy(*PAGE, "col_index").orderBy("top", "left", "reading_order", "block_ordinal")) - 1
    band = F.when(~F.col("_multi"), 0).when(F.col("col_index") < 0, rank).otherwise(above)
    c = c.withColumn("_band", band).withColumn("_sep", F.when(F.col("_multi"), sep).otherwise(0)).withColumn("_col", F.when(F.col("_multi"), F.col("col_index")).otherwise(0)).withColumn("_tie", F.when(F.col("_multi"), 0).otherwise(F.col("reading_order")))
    return c.withColumn("new_order", F.row_number().over(page.orderBy("_band", "_sep", "_col", "top", "left", "_tie", "block_ordinal"))).drop("_band", "_sep", "_col", "_tie", "_multi")


def order_check(ordered: DataFrame, order: str = "reading_order") -> DataFrame:
    """Whether `order` never goes back to a column on its left between two spanning blocks, and reads two columns at least; one row per page."""
    o = F.coalesce(F.nullif(F.col(order), F.lit(0)), F.lit(9999))
    w = W.partitionBy(*PAGE).orderBy(o, "top", "left", "block_ordinal")
    c = ordered.withColumn("_band", F.sum((F.col("col_index") < 0).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("_o", F.row_number().over(w))
    high = F.max(F.when(F.col("col_index") >= 0, F.col("col_index"))).over(W.partitionBy(*PAGE, "_band").orderBy("_o").rowsBetween(W.unboundedPreceding, -1))
    c = c.withColumn("_back", (F.col("col_index") >= 0) & (F.col("col_index") < F.coalesce(high, F.lit(-1))))
    return c.groupBy(*PAGE).agg((~F.bool_or("_back") & (F.count_distinct(F.when(F.col("col_index") >= 0, F.col("col_index"))) >= 2)).alias("ok"))
