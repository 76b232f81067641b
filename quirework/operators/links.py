"""Visual blocks and what belongs to them: captions, blocks of the same label, groups of subfigures, containment. All joins are within a page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.layout import PAGE

VISUAL = ("figure", "table", "formula")
MAX_RELATED, SUBFIGURES_PER_CROP, MAX_PENDING = 8, 2, 6


def nearest_captions(boxed: DataFrame, most: int = 2, least_overlap: float = 0.2) -> DataFrame:
    """The `most` captions nearest below or above each visual block that overlap it sideways by `least_overlap` of the narrower; rank 1 is nearest."""
    v = boxed.filter(F.col("block_type").isin(*VISUAL) & F.col("x0").isNotNull()).select(*PAGE, "block_uid", *(F.col(c).alias(f"v{c}") for c in ("x0", "y0", "x1", "y1")))
    c = boxed.filter(F.col("semantic_role").isin("figure_caption", "table_caption") & F.col("x0").isNotNull() & (T.clean_text("text") != "")).select(*PAGE, F.col("block_uid").alias("caption_uid"), "block_ordinal", "x0", "y0", "x1", "y1")
    j = v.join(c, PAGE).filter("block_uid <> caption_uid")
    over = F.greatest(F.lit(0.0), F.least("vx1", "x1") - F.greatest("vx0", "x0")) / F.greatest(F.lit(1.0), F.least(F.col("vx1") - F.col("vx0"), F.col("x1") - F.col("x0")))
    gap = F.least(F.abs(F.col("y0") - F.col("vy1")), F.abs(F.col("vy0") - F.col("y1")))
    j = j.filter(over >= least_overlap).withColumn("gap", gap)
    return j.withColumn("rank", F.row_number().over(W.partitionBy(*PAGE, "block_uid").orderBy("gap", "block_ordinal", "caption_uid"))).filter(F.col("rank") <= most).select(*PAGE, "block_uid", "caption_uid", "rank", "gap")


def same_label(blocks: DataFrame, most: int = MAX_RELATED) -> DataFrame:
    """For each visual block with a label in its text: the first `most` other blocks of its page that hold the label, blanks and case aside."""
    low = lambda c: F.lower(F.regexp_replace(c, r"\s+", ""))
    b = blocks.withColumn("t", T.clean_text("text"))
    v = b.filter(F.col("block_type").isin(*VISUAL)).select(*PAGE, "block_uid", low(T.caption_label(F.col("t"))).alias("label")).filter("label <> ''")
    o = b.select(*PAGE, F.col("block_uid").alias("other_uid"), "block_ordinal", low(F.col("t")).alias("low"))
    j = v.join(o, PAGE).filter("block_uid <> other_uid").filter(F.col("low").contains(F.col("label")))
    return j.withColumn("rank", F.row_number().over(W.partitionBy("block_uid").orderBy("block_ordinal", "other_uid"))).filter(F.col("rank") <= most).select(*PAGE, "block_uid", "label", "other_uid", "rank")


def subfigure_groups(figures: DataFrame) -> DataFrame:
    """Groups of subfigures, cut into parts of SUBFIGURES_PER_CROP: target block, label, part, parts, members.

    `figures` has journal_id, page_index, column_label, block_ordinal, block_id, text, top, left, reading_order. In each column marked figures are pending until one names a figure after its
    mark; of those pending the last MAX_PENDING, that one with them, make a group of two and more. A group is the run up to the one that names it, so a running count does it.
    """
    t = T.clean_text("text")
    marked = figures.withColumn("t", t).withColumn("mark", F.lower(F.regexp_extract("t", T.SUBFIGURE, 1))).filter("mark <> ''")
    after = F.regexp_replace("t", r"^.*?" + T.SUBFIGURE, "")
    marked = marked.withColumn("label", F.trim(F.regexp_extract(after, T.FIGURE_LABEL, 1)))
    w = W.partitionBy(*PAGE, "column_label").orderBy("top", "left", "reading_order", "block_ordinal")
    closed = F.sum((F.col("label") != "").cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1))
    m = marked.withColumn("grp", F.coalesce(closed, F.lit(0))).withColumn("_p", F.row_number().over(w))
    g = m.groupBy(*PAGE, "column_label", "grp").agg(F.sort_array(F.collect_list(F.struct(F.col("_p").alias("p"), "block_id", "mark"))).alias("all"), F.max("label").alias("label")).filter("label <> ''")
    g = g.withColumn("all", F.slice("all", F.greatest(F.lit(1), F.size("all") - MAX_PENDING + 1), MAX_PENDING)).filter(F.size("all") >= 2)
    parts = F.ceil(F.size("all") / F.lit(float(SUBFIGURES_PER_CROP))).cast("int")
    g = g.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(1), "parts")))
    members = F.slice("all", (F.col("part") - 1) * SUBFIGURES_PER_CROP + 1, SUBFIGURES_PER_CROP)
    digits = F.regexp_extract(F.translate("label", "０１２３４５６７８９", "0123456789"), r"[0-9]+", 0)
    return g.select(*PAGE, "column_label", F.get(members, F.lit(0))["block_id"].alias("target"), "label", F.concat(F.lit("figure:"), digits).alias("label_key"), "part", "parts", F.transform(members, lambda x: x["block_id"]).alias("members"), F.transform(members, lambda x: x["mark"]).alias("marks"))


def label_key(label: Column) -> Column:
    """The number of a figure label, full-width figures as usual ones: figure:N; '' without one."""
    n = F.regexp_extract(F.translate(label, "０１２３４５６７８９", "0123456789"), r"[0-9]+", 0)
    return F.when(n == "", "").otherwise(F.concat(F.lit("figure:"), n))


def group_captions(groups: DataFrame, boxed: DataFrame, most: int = 3, least_overlap: float = 0.15) -> DataFrame:
    """The `most` captions of each part of a group of subfigures (journal_id, page_index, target, part, rank, caption_id): blocks of the page outside the group with the group's label, that are captions or begin with the label.

    Nearest above or below the box around the members first; blocks that overlap it sideways by less than `least_overlap` of the narrower are none. Where there is no box, the reading order is the distance.
    """
    b = boxed.select(*PAGE, "block_id", "block_ordinal", "semantic_role", "reading_order", T.clean_text("text").alias("t"), "x0", "y0", "x1", "y1")
    member = groups.select(*PAGE, "target", "part", F.explode("members").alias("block_id")).join(b, [*PAGE, "block_id"], "left")
    around = member.groupBy(*PAGE, "target", "part").agg(F.min("x0").alias("gx0"), F.min("y0").alias("gy0"), F.max("x1").alias("gx1"), F.max("y1").alias("gy1"))
    g = groups.select(*PAGE, "target", "part", "members", "label_key").join(around, [*PAGE, "target", "part"])
    j = g.join(b, PAGE).filter(~F.array_contains("members", F.col("block_id")) & (F.col("t") != ""))
    own = F.exists(F.regexp_extract_all("t", F.lit(T.FIGURE_LABEL), F.lit(1)), lambda x: label_key(x) == F.col("label_key"))
    j = j.filter(own & (F.col("semantic_role").isin("figure_caption", "table_caption") | F.col("t").rlike("^" + T.FIGURE_LABEL.replace("(?i)", "(?i:") + ")")))
    over = F.greatest(F.lit(0.0), F.least("gx1", "x1") - F.greatest("gx0", "x0")) / F.greatest(F.lit(1.0), F.least(F.col("gx1") - F.col("gx0"), F.col("x1") - F.col("x0")))
    gap = F.least(F.abs(F.col("y0") - F.col("gy1")), F.abs(F.col("gy0") - F.col("y1")))
    boxless = F.col("gx0").isNull() | F.col("x0").isNull()
    j = j.withColumn("gap", F.when(boxless, F.coalesce(F.nullif("reading_order", F.lit(0)), F.lit(9999)).cast("double")).otherwise(gap)).filter(boxless | (over >= least_overlap))
    n = F.row_number().over(W.partitionBy(*PAGE, "target", "part").orderBy("gap", "block_ordinal", "block_id"))
    return j.withColumn("rank", n).filter(F.col("rank") <= most).select(*PAGE, "target", "part", "rank", F.col("block_id").alias("caption_id"))


def all_links(boxed: DataFrame) -> DataFrame:
    """Links of a page's visual blocks, groups of subfigures first: a group's parts stand for all their members; every other visual block has its own link. (journal_id, page_index, place, block_id, label, captions, related, members)."""
    none = F.array().cast("array<string>")
    groups = subfigure_groups(boxed.filter("block_type = 'figure' AND x0 IS NOT NULL"))
    caps = group_captions(groups, boxed).groupBy(*PAGE, "target", "part").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "caption_id"))), lambda x: x["caption_id"]).alias("captions"))
    grouped = groups.join(caps, [*PAGE, "target", "part"], "left").select(*PAGE, F.col("part").alias("place"), F.get("members", F.lit(0)).alias("block_id"), "label", F.coalesce("captions", none).alias("captions"), none.alias("related"), "members")
    inside = groups.select(*PAGE, F.explode("members").alias("block_id")).distinct()
    own = visual_links(boxed).join(boxed.select("block_uid", *PAGE, "block_id", "block_ordinal"), "block_uid").join(inside, [*PAGE, "block_id"], "left_anti")
    return grouped.unionByName(own.select(*PAGE, (F.col("block_ordinal") + 1000).alias("place"), "block_id", "label", "captions", "related", none.alias("members")))


def links_or_default(visuals: DataFrame, links: DataFrame) -> DataFrame:
    """The link of each visual block (journal_id, page_index, block_id, block_type), or one to itself alone where it has none: evidence ids in order, and the policy."""
    none = F.array().cast("array<string>")
    j = visuals.join(links.select(*PAGE, "block_id", "captions", "related", F.lit(True).alias("_found")), [*PAGE, "block_id"], "left")
    ids = F.array_distinct(F.concat(F.array("block_id"), F.coalesce("captions", none), F.coalesce("related", none)))
    return j.select(*PAGE, "block_id", F.col("block_type").alias("target_type"), F.coalesce("captions", none).alias("captions"), F.coalesce("related", none).alias("related"), ids.alias("evidence"), F.when(F.col("_found"), "same_label_or_caption").otherwise("target_block_only").alias("policy"))


def visual_images(visuals: DataFrame, pages: DataFrame) -> DataFrame:
    """The image of each visual block (journal_id, page_index, block_uid, image_path): its own crop, else its page's."""
    own = F.nullif(F.trim(F.coalesce("image_path", F.lit(""))), F.lit(""))
    return visuals.join(pages.select(*PAGE, "page_image"), PAGE, "left").select("block_uid", F.coalesce(own, "page_image", F.lit("")).alias("image"))


def crop_rectangles(boxed: DataFrame, pages: DataFrame) -> DataFrame:
    """Boxes in whole pixels (half to even), kept within their page (width, height); those of no area are left out."""
    j = boxed.filter("x0 IS NOT NULL").join(pages.select(*PAGE, "width", "height"), PAGE)
    at = lambda c, top: F.greatest(F.lit(0), F.least(F.bround(F.col(c), 0).cast("int"), F.col(top)))
    r = j.select("block_uid", at("x0", "width").alias("left"), at("y0", "height").alias("top"), at("x1", "width").alias("right"), at("y1", "height").alias("bottom"))
    return r.filter("right > left AND bottom > top")


def inside_visual(boxed: DataFrame, cover: float = 0.9, share: float = 0.75) -> DataFrame:
    """Blocks with whether they may be cropped: one that a larger visual box covers by `cover` must be `share` of that box."""
    b = boxed.filter("x0 IS NOT NULL").withColumn("area", (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    v = b.filter(F.col("block_type").isin(*VISUAL)).select(*PAGE, F.col("block_uid").alias("v_uid"), *(F.col(c).alias(f"v{c}") for c in ("x0", "y0", "x1", "y1", "area")))
    j = b.select(*PAGE, "block_uid", "x0", "y0", "x1", "y1", "area").join(v, PAGE).filter("block_uid <> v_uid AND varea > area")
    common = F.greatest(F.lit(0.0), F.least("x1", "vx1") - F.greatest("x0", "vx0")) * F.greatest(F.lit(0.0), F.least("y1", "vy1") - F.greatest("y0", "vy0"))
    bad = j.filter(common / F.col("area") >= cover).groupBy(*PAGE, "block_uid").agg(F.min(F.col("area") / F.col("varea")).alias("least"))
    return b.select(*PAGE, "block_uid", "area").join(bad, [*PAGE, "block_uid"], "left").select(*PAGE, "block_uid", "area", (F.coalesce("least", F.lit(1.0)) >= share).alias("kept"))


def visual_links(boxed: DataFrame) -> DataFrame:
    """One row per visual block: label, its captions and the first MAX_RELATED blocks of the page that hold the label (captions aside), as block ids in order.

    The label is that of the first caption that has one, else of the block's own text; without a label nothing is related.
    """
    b = boxed.withColumn("t", T.clean_text("text"))
    own = b.filter(F.col("block_type").isin(*VISUAL)).select(*PAGE, "block_uid", "block_id", T.caption_label(F.col("t")).alias("own"))
    near = nearest_captions(boxed).join(b.select(*PAGE, F.col("block_uid").alias("caption_uid"), F.col("block_id").alias("caption_id"), T.caption_label(F.col("t")).alias("l")), [*PAGE, "caption_uid"])
    caps = near.groupBy(*PAGE, "block_uid").agg(F.sort_array(F.collect_list(F.struct("rank", "caption_id", "caption_uid", "l"))).alias("caps"))
    v = own.join(caps, [*PAGE, "block_uid"], "left").withColumn("caps", F.coalesce("caps", F.array().cast("array<struct<rank:int,caption_id:string,caption_uid:bigint,l:string>>")))
    named = F.get(F.filter("caps", lambda c: c["l"] != ""), F.lit(0))["l"]
    v = v.withColumn("label", F.coalesce(named, "own"))
    low = lambda c: F.lower(F.regexp_replace(c, r"\s+", ""))
    o = b.select(*PAGE, F.col("block_uid").alias("other_uid"), F.col("block_id").alias("other_id"), "block_ordinal", low(F.col("t")).alias("low"))
    r = v.filter("label <> ''").select(*PAGE, "block_uid", "label", "caps").join(o, PAGE).filter("block_uid <> other_uid").filter(F.col("low").contains(low(F.col("label"))) & ~F.exists("caps", lambda c: c["caption_uid"] == F.col("other_uid")))
    r = r.withColumn("n", F.row_number().over(W.partitionBy(*PAGE, "block_uid").orderBy("block_ordinal", "other_uid"))).filter(F.col("n") <= MAX_RELATED)
    rel = r.groupBy(*PAGE, "block_uid").agg(F.sort_array(F.collect_list(F.struct("n", "other_id"))).alias("rel"))
    j = v.join(rel, [*PAGE, "block_uid"], "left")
    return j.select("block_uid", "label", F.transform("caps", lambda c: c["caption_id"]).alias("captions"), F.coalesce(F.transform("rel", lambda c: c["other_id"]), F.array().cast("array<string>")).alias("related"))


def barriers(boxed: DataFrame) -> DataFrame:
    """Visual blocks that span columns, with how many text blocks of the left and right column come between the barrier before and this one."""
    noise = ("journal_header", "footer", "page_number", "reference", "unknown")
    wide = F.col("block_type").isin(*VISUAL) & (F.col("column_label") == "full_width") & F.col("span_kind").isin("full_width", "cross_column") & F.col("x0").isNotNull()
    w = W.partitionBy(*PAGE).orderBy("y0", F.coalesce(F.nullif("reading_order", F.lit(0)), F.lit(9999)), "block_ordinal")
    a = boxed.filter(wide).select(*PAGE, "block_uid", "y0", F.coalesce(F.lag("y1").over(w), F.lit(float("-inf"))).alias("after"))
    at = F.coalesce("y0", F.coalesce(F.nullif("reading_order", F.lit(0)), F.lit(9999)).cast("double"))
    t = boxed.filter(~F.coalesce("semantic_role", F.lit("")).isin(*noise) & F.col("column_label").isin("left", "right")).select(*PAGE, at.alias("at"), "column_label")
    j = a.join(t, PAGE, "left").withColumn("inside", (F.col("at") >= F.col("after")) & (F.col("at") < F.col("y0")))
    return j.groupBy(*PAGE, "block_uid").agg(F.count(F.when(F.col("inside") & (F.col("column_label") == "left"), 1)).alias("n_left"), F.count(F.when(F.col("inside") & (F.col("column_label") == "right"), 1)).alias("n_right"))


def crop_boxes(boxed: DataFrame) -> DataFrame:
    """Whether each block with a box is worth a crop: large enough, of a type with content, with text that is more than a number."""
    w, h = (F.col("x1") - F.col("x0")).cast("int"), (F.col("y1") - F.col("y0")).cast("int")
    t = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)^\s+|\s+$", "")
    ok = (w >= 28) & (h >= 32) & (w * h >= 3000) & ~F.coalesce("block_type", F.lit("")).isin("header", "footer", "page_number", "unknown") & (F.length(t) >= 10)
    return boxed.filter("x0 IS NOT NULL").select("block_uid", ok.alias("kept"))
