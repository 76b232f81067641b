"""Paragraphs, articles, windows and links against the sequential rules."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from quirework.operators import links, pages, routing

V = "journal_id string, article_id string, page_index int, page_type string, block_ordinal int, reading_order int, semantic_role string, block_type string, shown string"


def test_paragraphs_against_the_sequential_rule(spark):
    rng = random.Random(3)
    rows = []
    for a in range(60):
        for p in range(1, 4):
            kind = "article_first_page" if p == 1 and rng.random() < 0.6 else "article_body"
            for b in range(rng.randint(0, 6)):
                text = rng.choice(["流速变化。", "流速变", "word", "3) item", "，接上文", "end.", "一、项目", "abc 1"])
                rows.append(("j", f"a{a}", p, kind, b, rng.choice([0, b + 1]), rng.choice(["body", "body", "body", "abstract", "section_heading", "unknown"]), rng.choice(["text", "text", "table"]), text))
    want = {}
    special = {"abstract", "section_heading", "table"}
    for a in range(60):
        mine = sorted((r for r in rows if r[1] == f"a{a}"), key=lambda r: (r[2], r[5] or 9999, r[4]))
        out, last, pabs = [], None, {}
        for r in mine:
            role = r[6] if r[6] in special else r[7] if r[7] in special else "body"
            new = last is None or (r[3] == "article_first_page" and not pabs.get(r[2])) or role in special or last in special or re.match(r"^\s*(\d+|[一二三四五六七八九十]+)\s*[)）.、]", r[8]) or re.search(r"[。！？；;.?!：:”’)）\]]$", out[-1][2])
            if new:
                out.append([r[2], role, r[8]])
            else:
                t = out[-1][2]
                glue = "" if r[8][0] in "，。；：、！？,.!?;:%)]}）】”’" else " " if re.search(r"[A-Za-z0-9]$", t) and re.match(r"[A-Za-z0-9]", r[8]) else ""
                out[-1][2] = t + glue + r[8]
            last = role if new else "body"
            if r[6] == "abstract":
                pabs[r[2]] = True
        if out:
            want[f"a{a}"] = [tuple(x) for x in out]
    got = {}
    df = spark.createDataFrame(rows, V)
    for r in pages.paragraphs(df).orderBy("article_id", "start_page", "paragraph").collect():
        got.setdefault(r.article_id, []).append((r.start_page, r.role, r.text))
    assert got == want
    assert pages.paragraphs(df.limit(0)).count() == 0


def test_article_spans_against_the_sequential_rule(spark):
    rng = random.Random(4)
    kinds = ["article_first_page", "article_body", "references", "blank", "advertisement_or_notice", "cover", None]
    rows, want = [], set()
    for j in range(80):
        types = [rng.choice(kinds[1:] if j % 5 == 0 else kinds) for _ in range(rng.randint(1, 9))]
        rows += [(f"j{j}", i + 1, t) for i, t in enumerate(types)]
        starts = [i + 1 for i, t in enumerate(types) if t == "article_first_page"]
        if not starts:
            ok = [i + 1 for i, t in enumerate(types) if t in pages.TRAINABLE]
            want |= {(f"j{j}", ok[0], ok[-1])} if ok else set()
        for s, nxt in zip(starts, [*starts[1:], len(types) + 1]):
            end = nxt - 1
            while end > s and types[end - 1] in pages.TRIMMED:
                end -= 1
            want.add((f"j{j}", s, end))
    p = spark.createDataFrame(rows, "journal_id string, page_index int, page_type string")
    spans = pages.article_spans(p)
    assert set(map(tuple, spans.collect())) == want
    roles = {(r.journal_id, r.page_index): r.role for r in pages.page_articles(p, spans).collect()}
    for j, i, _ in rows:
        inside = [(s, e) for jj, s, e in want if jj == j and s <= i <= e]
        s, e = max(inside) if inside else (None, None)
        assert roles[(j, i)] == ("unknown" if s is None else "first_page" if i == s else "last_page" if i == e else "body")


def test_corpus_windows_against_a_fold(spark):
    rng = random.Random(5)
    rows, want = [], set()
    for a in range(60):
        sizes = [rng.choice([0, 100, 200, 400, 4000]) for _ in range(rng.randint(1, 8))]
        rows += [("j", f"a{a}", i + 1, "article_body", "字" * n) for i, n in enumerate(sizes)]
        win, chars = [], 0
        for i, n in [*enumerate(sizes, 1), (0, -1)]:
            if n == 0:
                continue
            if n > 0:
                win.append(i)
                chars += n
            if win and (n < 0 or chars >= 3600 or len(win) >= 2):
                if chars >= 300:
                    want.add((f"a{a}", win[0], win[-1], chars))
                win, chars = [], 0
    df = spark.createDataFrame(rows, "journal_id string, article_id string, page_index int, page_type string, full_text string")
    assert {(r.article_id, r.first_page, r.last_page, r.n_chars) for r in routing.corpus_windows(df).collect()} == want


FIG = "journal_id string, page_index int, column_label string, block_ordinal int, block_id string, text string, top double, left double, reading_order int"


def test_subfigures(spark):
    texts = ["(a) 流速", "(b) 压力 图 8 结果 Fig. 8", "(a) 温度", "(b) 湿度 图９ 结果"]
    rows = [("j", 1, "left", i, f"b{i + 1:03d}", t, float(i), 0.0, i + 1) for i, t in enumerate(texts)]
    rows += [("j", 2, "left", i, f"c{i + 1:03d}", t, float(i), 0.0, i + 1) for i, t in enumerate(["(a) x", "(b) y", "(c) z 图 11"])]
    rows += [("j", 3, "left", 0, "d001", "(a) 图 3", 0.0, 0.0, 1), ("j", 4, "left", 0, "e001", None, 0.0, 0.0, 1), ("j", 5, "left", 0, "f001", "(a) 无图号", 0.0, 0.0, 1)]
    got = sorted((r.page_index, r.target, r.label_key, r.part, r.parts, tuple(r.members)) for r in links.subfigure_groups(spark.createDataFrame(rows, FIG)).collect())
    assert got == [
        (1, "b001", "figure:8", 1, 1, ("b001", "b002")), (1, "b003", "figure:9", 1, 1, ("b003", "b004")),
        (2, "c001", "figure:11", 1, 2, ("c001", "c002")), (2, "c003", "figure:11", 2, 2, ("c003",)),
    ]


def test_article_metadata(spark):
    blocks = [(1, "article_title", "题目"), (2, "abstract", "摘要：内容"), (3, "keywords", "关键词：甲；乙， 丙"), (4, "body", "见 10.1234/ab-c 。"), (5, "body", None)]
    b = spark.createDataFrame([("j", 1, u, u, r, t) for u, r, t in blocks], "journal_id string, page_index int, block_uid long, block_ordinal int, semantic_role string, text string")
    p = spark.createDataFrame([("j", 1, "article_first_page", "刊名"), ("j", 2, "article_body", "刊名")], "journal_id string, page_index int, page_type string, journal_name string")
    r = pages.article_metadata(b, p).first()
    assert (r.title, r.abstract, r.keywords, r.doi, r.confidence) == ("题目", "摘要：内容", ["甲", "乙", "丙"], "10.1234/ab-c", 0.82)
    assert pages.article_metadata(b.filter(F.col("semantic_role") != "article_title"), p).first().confidence == 0.45


def test_jobs_of_visuals_links_and_pages_without_headings(spark):
    P = "journal_id string, page_index int, page_type string, column_mode string, uncertainty_notes array<string>, full_text string, visible_text string"
    B = "journal_id string, page_index int, block_uid long, block_id string, block_type string, semantic_role string, column_label string, block_ordinal int, text string, x0 double, top double, left double, reading_order int"
    long = "字" * 130
    kinds = {1: ("article_body", "one_column", []), 2: ("article_body", "two_column", []), 3: ("references", "one_column", []), 4: ("article_body", "one_column", None), 5: ("article_body", None, ["x"]), 6: ("article_body", None, None), 7: (None, "one_column", [])}
    p = spark.createDataFrame([("j", i, *k, "短" if i == 6 else long, None) for i, k in kinds.items()], P)
    rows = []

    def block(page, kind, text, role="body", box=0.0):
        n = len(rows) + 1
        rows.append(("j", page, n, f"b{n:03d}", kind, role, "left", n, text, box, float(n), 0.0, n))
        return n

    visuals = [block(1, "figure", "(a) 流速"), block(1, "figure", "(b) 压力 图 8 结果"), block(1, "table", None), block(1, "formula", "E", box=None)]
    visuals += [block(2, "figure", t) for t in ("(a) x", "(b) y", "(c) z 图 11")] + [block(5, "table", "")]
    block(3, "figure", "图 1")
    for page in (1, 3, 4, 6, 7):  # two parts of 110 with a blank between are 221
        block(page, "text", "文" * 110)
        block(page, "list", " " + "文" * 110 + "\n")
    block(2, "text", "文" * 219)
    block(2, "text", "短")  # too short to count
    block(4, "section_title", "1 方法", role="section_heading")
    block(7, "section_title", " ", role="section_heading")  # without text it's no heading
    b = spark.createDataFrame(rows, B)
    assert sorted(r.block_uid for r in routing.visual_jobs(b, p).collect()) == sorted(set(visuals) - {visuals[1], visuals[5]})
    assert sorted((r.page_index, r.task_type) for r in routing.linked_page_jobs(b, p).collect()) == [(1, routing.ORDER_TASK), (3, routing.ORDER_TASK)]
    assert sorted((r.page_index, r.n_chars) for r in routing.unheaded_page_jobs(b, p).collect()) == [(1, 221), (7, 221)]
    for f in (routing.visual_jobs, routing.linked_page_jobs, routing.unheaded_page_jobs):
        assert f(b.limit(0), p).count() == 0


def test_last_so_far_is_handed_over_stretches(spark):
    rows = [(j, n, n if n % 7 == k else None) for k, j in enumerate(("a", "b", None)) for n in range(0, 60, k + 1)]
    df = spark.createDataFrame(rows, "j string, n int, v int")
    want = {}
    for j in ("a", "b", None):
        last = None
        for k, n, v in rows:
            if k == j:
                last = v if v is not None else last
                want[(j, n)] = last
    for stride in (4, 1000):
        got = {(r.j, r.n): r._last for r in pages.last_so_far(df, ["j"], "n", "v", stride).collect()}
        assert got == want
    assert pages.last_so_far(df.limit(0), ["j"], "n", "v").count() == 0


def test_page_windows_go_over_stretches(spark):
    """The rows are the same whatever the stretches are, with gaps in the page numbers and runs of articles."""
    rng = random.Random(6)
    rows, article = [], "a0"
    for j in ("j", "k"):
        for n in sorted(rng.sample(range(1, 90), 50)):
            article = f"a{rng.randrange(4)}" if rng.random() < 0.3 else article
            rows.append((j, n, article if article != "a3" else None, "article_body" if rng.random() < 0.85 else "cover", "字" * rng.choice((5, 70, 150))))
    df = spark.createDataFrame(rows, "journal_id string, page_index int, article_id string, page_type string, full_text string").withColumn("visible_text", F.lit(None).cast("string"))
    want = {}
    for i, (j, n, a, _, _) in enumerate(rows):
        win = []
        for k in range(i, min(i + routing.WINDOW, len(rows))):
            if rows[k][0] != j or rows[k][2] != a:
                break
            if rows[k][3] != "cover":
                win.append(rows[k])
        if len(win) >= 2 and sum(len(r[4]) for r in win) + len(win) - 1 >= routing.MIN_PAGE:
            want[j, n] = [r[1] for r in win]
    for stride in (2, 7, 4096):
        assert {(r.journal_id, r.page_index): list(r.window) for r in routing.page_windows(df, stride).collect()} == want
