"""Columns, order, roles and page types on the layouts of FIXTURES.md."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quirework.operators import layout, pages

W = 1174
SCHEMA = "journal_id string, page_index int, block_uid long, block_ordinal int, block_id string, block_type string, semantic_role string, bbox array<double>, text string, markdown string, reading_order int, ingested_at timestamp"
T0 = dt.datetime(2024, 1, 1)
BANDS = {
    "three": [(0.065, 0.342), (0.361, 0.637), (0.657, 1.0)],
    "two": [(0.064, 0.498), (0.536, 0.936)],
    "asymmetric": [(0.065, 0.637), (0.658, 0.933)],
    "single": [(0.08, 0.92)],
}


def page(bands, rows=4, extra=(), journal="j", number=2):
    out, n = [], 0
    for a, b in bands:
        for r in range(rows):
            out.append((journal, number, n, n, f"b{n:03d}", "text", "body", [a * W, 120.0 + 90 * r, b * W, 190.0 + 90 * r], "文" * 80, None, n + 1, T0))
            n += 1
    for kind, box in extra:
        out.append((journal, number, n, n, f"b{n:03d}", kind, "body", box, "图" * 80, None, n + 1, T0))
        n += 1
    return out


def assigned(spark, rows):
    return layout.assign_columns(layout.boxes(spark.createDataFrame(rows, SCHEMA)))


@pytest.mark.parametrize("case,extra,mode,labels", [
    ("three", [], "three_column", ["col1"] * 4 + ["col2"] * 4 + ["col3"] * 4),
    ("two", [], "two_column", ["left"] * 4 + ["right"] * 4),
    ("asymmetric", [], "two_column", ["left"] * 4 + ["right"] * 4),
    ("single", [], "single_column", ["single"] * 4),
    ("three", [("figure", [0.361 * W, 40.0, 1.0 * W, 110.0])], "mixed_full_width_and_three_column", ["col1"] * 4 + ["col2"] * 4 + ["col3"] * 4 + ["full_width"]),
    ("three", [("figure", [0.065 * W, 40.0, 1.0 * W, 110.0])], "mixed_full_width_and_three_column", ["col1"] * 4 + ["col2"] * 4 + ["col3"] * 4 + ["full_width"]),
])
def test_columns(spark, case, extra, mode, labels):
    a = assigned(spark, page(BANDS[case], extra=extra))
    assert [r.col_label for r in a.orderBy("block_ordinal").collect()] == labels
    assert layout.column_modes(a).first()["mode"] == mode
    spans = {r.span for r in a.filter("col_index < 0").collect()}
    assert spans == ({"full_width"} if extra and extra[0][1][0] < 100 else {"cross_column"} if extra else set())


def test_full_image_is_known(spark):
    a = assigned(spark, [("j", 1, 0, 0, "b0", "figure", "body", [0.02 * W, 50.0, 0.98 * W, 950.0], "x", None, 1, T0)])
    assert layout.column_modes(a).first()["mode"] in ("single_column", "full_width")


def test_no_boxes(spark):
    a = assigned(spark, [("j", 1, 0, 0, "b0", "text", "body", [], "x", None, 1, T0), ("j", 1, 1, 1, "b1", "text", "body", None, "y", None, 2, T0), ("j", 1, 2, 2, "b2", "text", "body", [5.0, 1.0, 4.0, 2.0], "y", None, 3, T0)])
    assert {r.col_label for r in a.collect()} == {"unknown"} and layout.column_modes(a).first()["mode"] == "unknown"
    assert layout.column_modes(a.limit(0)).count() == 0


def test_three_columns_in_order(spark):
    rows = page(BANDS["three"], rows=3)
    random.Random(1).shuffle(rows)
    o = layout.reading_order(assigned(spark, rows).withColumn("role", F.col("semantic_role")))
    got = [(r.col_index, r.top) for r in o.orderBy("new_order").collect()]
    assert [c for c, _ in got] == [0, 0, 0, 1, 1, 1, 2, 2, 2] and got == sorted(got)
    assert layout.order_check(o, "new_order").first()["ok"]
    bad = o.withColumn("new_order", F.when((F.col("col_index") == 2) & (F.col("new_order") == 7), 1).when(F.col("new_order") == 1, 99).otherwise(F.col("new_order")))
    assert not layout.order_check(bad, "new_order").first()["ok"]


def sequential_order(blocks):
    """The rule as stated: bands between separators, columns inside."""
    seps = sorted((b for b in blocks if b["c"] < 0), key=lambda b: (b["top"], b["left"], b["ro"], b["i"]))
    cols = [b for b in blocks if b["c"] >= 0]
    if len({b["c"] for b in cols}) < 2:
        return [b["i"] for b in sorted(blocks, key=lambda b: (b["top"], b["left"], b["ro"], b["i"]))]
    out, done = [], set()
    for s in [*seps, None]:
        band = [b for b in cols if b["i"] not in done and (s is None or b["top"] < s["top"])]
        out += [b["i"] for b in sorted(band, key=lambda b: (b["c"], b["top"], b["left"], b["i"]))]
        done |= {b["i"] for b in band}
        out += [s["i"]] if s else []
    return out


def test_order_against_the_sequential_rule(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for p in range(150):
        blocks = [{"i": i, "c": rng.choice([-1, 0, 0, 1, 1, 2]), "top": float(rng.randint(0, 6)), "left": float(rng.randint(0, 2)), "ro": rng.randint(0, 5)} for i in range(rng.randint(1, 9))]
        want[p] = sequential_order(blocks)
        rows += [("j", p, p * 100 + b["i"], b["i"], "body", "t", b["c"], b["top"], b["left"], b["ro"]) for b in blocks]
    df = spark.createDataFrame(rows, "journal_id string, page_index int, block_uid long, block_ordinal int, role string, text string, col_index int, top double, left double, reading_order int")
    got = {}
    for r in layout.reading_order(df).orderBy("page_index", "new_order").collect():
        got.setdefault(r.page_index, []).append(r.block_ordinal)
    assert got == want


@pytest.mark.parametrize("kind,text,role", [
    ("text", "PDF过刊杂志收藏购买微信", "watermark"), ("header", "x", "journal_header"), ("text", "第 12 页", "page_number"), ("text", "图 3 流速", "figure_caption"), ("table", "表2 流速", "table_caption"), ("formula", "E=1", "formula"),
    ("text", "摘 要：内容", "abstract"), ("text", "Keywords: a", "keywords"), ("text", "https://x.org", "journal_header"), ("text", "DOI 10.1/2", "journal_header"), ("text", "引用格式：x", "footer"), ("text", "1. Introduction", "reference"),
    ("text", "1.2 流速剖面", "section_heading"), ("title", "题目", "section_heading"), ("text", "正文内容", "body"), ("text", "　", "unknown"), ("text", None, "unknown"),
])
def test_roles(spark, kind, text, role):
    rows = [("j", 2, 0, 0, "b", kind, None, [1.0, 400.0, 9.0, 410.0], text, None, 1, T0), ("j", 2, 1, 1, "c", "text", None, [1.0, 900.0, 9.0, 1000.0], "底" * 90, None, 2, T0)]
    assert layout.roles(layout.boxes(spark.createDataFrame(rows, SCHEMA))).filter("block_uid = 0").first()["role"] == role


@pytest.mark.parametrize("texts,kind", [
    (["本刊声明", "定价：12 元 电话 010-12345678"], "advertisement_or_notice"), (["短"], "scan_only"), (["目录 一二三四五六七八九十一二三四五六七八九十"], "table_of_contents"),
    (["正文" * 100 + "微信公众号"], "article_body"), (["摘要：" + "内容" * 20, "关键词：a；b"], "article_first_page"), (["参考文献 一二三四五六七八九十一二三四五六七八九十"], "references"), (["普通文字" * 8], "unknown"),
])
def test_page_types(spark, texts, kind):
    rows = [("j", 2, i, i, f"b{i}", "text", "body", [], t, None, i + 1, T0) for i, t in enumerate(texts)]
    assert pages.page_types(spark.createDataFrame(rows, SCHEMA)).first()["type"] == kind


def test_delivered_once(spark):
    rows = page(BANDS["two"])
    df = spark.createDataFrame(rows + [(*r[:-1], T0 + dt.timedelta(days=30)) for r in rows[:3]], SCHEMA)
    assert layout.deliver_once(df).count() == len(rows)
    assert layout.deliver_once(df.limit(0)).count() == 0
    nameless = df.withColumn("block_uid", F.lit(None).cast("long")).withColumn("journal_id", F.lit(None).cast("string"))
    assert layout.deliver_once(nameless).count() == 1


def test_one_shuffle_serves_page_windows(spark):
    """Deliveries, heights and roles share the page's partitioning."""
    df = spark.createDataFrame(page(BANDS["two"]), SCHEMA)
    plan = layout.roles(layout.boxes(layout.deliver_once(df)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
