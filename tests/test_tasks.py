"""Outputs of tasks, links of groups, gates, exports and resume on small tables."""

import random

from pyspark.sql import functions as F

from quirework.operators import layout, links, outputs, quality, resume, samples

BLOCK = "journal_id string, page_index int, block_uid long, block_ordinal int, block_id string, block_type string, semantic_role string, text string, markdown string, reading_order int, column_label string, bbox array<double>, ingested_at int"
SAMPLE = "ordinal long, id string, task_type string, instruction string, question string, answer string, text string, output_payload struct<text:string,summary:string,title:string>, evidence struct<source_pages:array<int>,evidence_block_ids:array<string>>, metadata struct<journal_id:string,article_id:string,page_index:int,block_id:string,task_type:string,sample_no:int>, images array<string>"


def block(uid, kind, role, text, box=None, column="left", page=1, order=0):
    return ("j", page, uid, uid, f"b{uid}", kind, role, text, None, order or uid, column, box or [0.0, uid * 100.0, 90.0, uid * 100.0 + 80], 1)


def sample(n, task, answer="回答的内容完整。", payload=(None, "要点", None), pages=(1,), ids=("b1",), block_id="b1", images=("images/p001.png",), instruction="这张图片显示了怎样的页面结构？", **kw):
    return (n, kw.get("id", f"s{n}"), task, instruction, instruction, answer, kw.get("text"), payload, (list(pages), list(ids)), ("j", "a", kw.get("page", 1), block_id, task, n), list(images))


def test_groups_of_subfigures_have_captions_and_go_first(spark):
    rows = [
        block(1, "figure", "unknown", "(a) 甲"), block(2, "figure", "unknown", "(b) 图 3 乙"), block(3, "text", "figure_caption", "图３ 总题"), block(4, "text", "body", "见图3所示"), block(5, "text", "body", "图3 起首的正文"),
        block(6, "figure", "unknown", "图 9 独立"), block(7, "text", "figure_caption", "图 3 太远的栏", [500.0, 300.0, 600.0, 380.0]), block(8, "text", "figure_caption", "图 31 不是"),
    ]
    b = layout.boxes(spark.createDataFrame(rows, BLOCK))
    g = links.subfigure_groups(b.filter("block_type = 'figure' AND x0 IS NOT NULL"))
    assert [(r.target, r.members, r.label_key) for r in g.collect()] == [("b1", ["b1", "b2"], "figure:3")]
    caps = links.group_captions(g, b).orderBy("rank").collect()
    assert [r.caption_id for r in caps] == ["b3", "b5"]
    every = {r.block_id: r for r in links.all_links(b).collect()}
    assert set(every) == {"b1", "b6"} and every["b1"].members == ["b1", "b2"] and every["b1"].captions == ["b3", "b5"] and every["b1"].place < every["b6"].place
    assert links.all_links(b.limit(0)).count() == 0
    v = b.filter("block_type = 'figure'").select("journal_id", "page_index", "block_id", "block_type")
    d = {r.block_id: (r.evidence, r.policy) for r in links.links_or_default(v, links.all_links(b)).collect()}
    assert d["b2"] == (["b2"], "target_block_only") and d["b1"] == (["b1", "b3", "b5"], "same_label_or_caption")


def test_notes_of_groups(spark):
    df = spark.sql("SELECT array('a', 'b') AS c, array('a', 'b', 'c') AS e, array('a', 'b') AS s")
    say = lambda chunk, every, n: df.select(outputs.subfigure_note(F.lit("图3"), F.col(chunk), F.col(every), F.lit(n))).first()[0]
    assert say("c", "e", 2) == "子图抽取说明：本裁剪包含图3的(a)、(b)子图；同一图号还包含(c)子图，已分片抽取。"
    assert say("c", "s", 2) == "子图抽取说明：本裁剪包含图3的(a)、(b)子图；同一图号已分片抽取。"
    assert say("c", "s", 1) == "子图抽取说明：本裁剪已合并图3的(a)、(b)子图。"


def test_gate_tells_the_first_rule(spark):
    meta, fig, cross = "article_metadata_extraction", samples.FIGURE_TASK, samples.CROSS_TASK
    ok = (None, None, "题名")
    rows = [
        (sample(1, "odd"), "task"), (sample(2, meta, id=""), "id"), (sample(3, samples.CORPUS, text="短"), "short"), (sample(4, meta, instruction=" "), "instruction"), (sample(5, meta, payload=(None, " ", None)), "payload"), (sample(6, meta, payload=ok, page=2), "low_value"),
        (sample(7, meta), "fields"), (sample(8, meta, payload=ok, pages=()), "pages"), (sample(9, meta, payload=ok), None), (sample(10, meta, payload=ok, images=("images/p009.png",)), "files"), (sample(11, samples.CORPUS, payload=("字" * 90, None, None), page=2), "low_value"), (sample(12, None), "task"),
    ]
    df = spark.createDataFrame([r for r, _ in rows], SAMPLE)
    pages = spark.createDataFrame([("j", 1, "article_body"), ("j", 2, "cover"), ("j", 2, "cover")], "journal_id string, page_index int, page_type string")
    missing = spark.createDataFrame([(10, "images/p009.png"), (10, "x")], "ordinal long, image string")
    got = {r.ordinal: r.reason for r in samples.gate(df, pages, missing).collect()}
    assert got == {r[0]: why for r, why in rows}
    failed = spark.createDataFrame([(9, False)], "ordinal long, passed boolean")
    assert samples.gate(df, pages, missing, passed=failed).filter("ordinal = 9").first().reason == "quality"
    sums = {r.task: (r.n, r.n_failed, r.reasons) for r in samples.failures(samples.gate(df, pages, missing), df).collect()}
    assert sums[meta] == (8, 7, ["id", "instruction", "payload", "low_value", "fields"]) and sums["none"] == (1, 1, ["task"])
    assert samples.gate(df.limit(0), pages, missing).count() == 0
    full = [f"output_payload.{n}" for n in ("text", "summary", "title")]
    wide = df.withColumn("output_payload", F.struct(*full, *(F.lit("内容").alias(n) for n in (*samples.REQUIRED[fig], *samples.REQUIRED[cross]))))
    more = [sample(1, fig), sample(2, fig, ids=("b2",)), sample(3, cross, pages=(1, 2)), sample(4, cross, pages=(1, 1)), sample(5, fig, images=())]
    wide = spark.createDataFrame(more, SAMPLE).withColumn("output_payload", wide.select("output_payload").schema and F.struct(*full, *(F.lit("内容").alias(n) for n in (*samples.REQUIRED[fig], *samples.REQUIRED[cross]))))
    generic = spark.createDataFrame([(1, True), (2, True)], "ordinal long, generic boolean")
    assert {r.ordinal: r.reason for r in samples.gate(wide, generic=generic).collect()} == {1: None, 2: "binding", 3: "bounds", 4: "cross_page", 5: "images"}


def test_answers_for_export(spark):
    rows = [
        (sample(1, samples.FIGURE_TASK), "回答的内容完整。"), (sample(2, samples.FIGURE_TASK, answer='{"a": 1}'), samples.NO_ANSWER), (sample(3, "section_keypoint_summary", answer="metadata: x"), "摘要：要点"), (sample(4, "section_keypoint_summary", answer="Summary：见下", payload=("只有文本", None, None)), "只有文本"),
        (sample(5, "section_keypoint_summary", answer=None, payload=(None, "要点", "题")), "摘要：要点\n题名：题"), (sample(6, "section_keypoint_summary", answer="见 bbox=[1,2] block_id: p1 ，"), "见"), (sample(7, "section_keypoint_summary", answer="[见下文"), "[见下文"),
    ]
    df = spark.createDataFrame([r for r, _ in rows], SAMPLE)
    assert {r.ordinal: r.a for r in df.select("ordinal", samples.export_answer(df).alias("a")).collect()} == {r[0]: a for r, a in rows}
    pages = spark.createDataFrame([("j", 1, "题名", "12")], "journal_id string, page_index int, article_title string, page_label string")
    pt = samples.pt_records(df, pages).orderBy("ordinal").collect()
    assert [(r.ordinal, r.text, r.part) for r in pt] == [(1, "文章：题名\n页码：12", 1), (2, "文章：题名\n页码：12", 1)]


def test_images_accepted(spark):
    cases = [((300, 300, 6000, True, False), True), ((30, 40, 600, True, False), True), ((30, 40, 400, True, False), False), ((10, 10, 90, True, True), True), ((None, None, 6000, False, None), True), ((None, None, 100, None, None), False)]
    df = spark.createDataFrame([c for c, _ in cases], "w int, h int, n int, o boolean, m boolean")
    assert [r[0] for r in df.select(quality.image_accepted(*(F.col(c) for c in "whnom"))).collect()] == [ok for _, ok in cases]


def test_resume(spark):
    done = resume.completion(spark.createDataFrame([("j", "a"), ("j", "a"), ("j", "b"), ("k", "a")], "journal_id string, task_type string"), spark.createDataFrame([("j", "a"), ("j", "c")], "journal_id string, task_type string"))
    assert {(r.journal_id, r.task_type): r.complete for r in done.collect()} == {("j", "a"): True, ("j", "b"): False, ("j", "c"): True, ("k", "a"): False}
    assert {r.journal_id: r.tasks for r in resume.pending_tasks(done, ["b", "a"]).collect()} == {"j": ["b"], "k": ["b", "a"]}
    jobs = spark.createDataFrame([(k,) for k in "abcdef"], "key string")
    state = spark.createDataFrame([("a", 2), ("b", 2), ("c", 0)], "key string, n_samples int")
    raw = spark.createDataFrame([("a",), ("a",), ("b",), ("d",)], "key string")
    assert sorted(r.key for r in resume.open_jobs(jobs, state, raw).collect()) == ["b", "e", "f"]
    old, new = spark.createDataFrame([("x", 1)], "id string, v int"), spark.createDataFrame([("x", 2), ("y", 3)], "id string, v int")
    assert sorted(map(tuple, resume.merged(old, new).collect())) == [("x", 1), ("y", 3)]
    forms = spark.createDataFrame([("j", p, "logo") for p in (1, 2, 3, 3)] + [("j", 1, "text")], "journal_id string, page_index int, form string")
    pages = spark.createDataFrame([("j", p) for p in range(1, 6)], "journal_id string, page_index int")
    assert [tuple(r) for r in resume.repeated_forms(forms, pages).collect()] == [("j", "logo", 3)]


def test_deduplication_in_rounds_is_the_pass_in_order(spark):
    """Chains of near texts, shared ids and contents, and a slot with most of the rows, against the pass row by row."""
    rng = random.Random(9)
    rows, near = [], set()
    for n in range(90):
        rows.append((n, f"id{rng.randrange(60)}", samples.CORPUS, None, None, None, None, (f"text {rng.randrange(50)}", None, None), ([1], []), ("j", "a", 1 if n % 3 == 0 else rng.randrange(40), "b", samples.CORPUS, n), []))
        near |= {(rng.randrange(n), n)} if n % 3 == 1 and n > 1 else {(n - 1, n)} if n % 10 == 5 else set()
    df = spark.createDataFrame(rows, SAMPLE)
    pairs = spark.createDataFrame([("j", a, b) for a, b in near], "j string, a long, b long")
    ids, seen, slots, kept = set(), set(), {}, set()
    for r in rows:
        slot = (r[9][1], r[9][2], r[9][4])
        if r[1] in ids or r[7][0] in seen or slots.get(slot, 0) >= samples.QUOTA or any(a in kept for a, b in near if b == r[0]):
            continue
        ids.add(r[1]); seen.add(r[7][0]); kept.add(r[0]); slots[slot] = slots.get(slot, 0) + 1  # noqa: E702
    assert {r.ordinal for r in samples.deduplicate(df, pairs).collect()} == kept
    assert samples.deduplicate(df.limit(0), pairs.limit(0)).count() == 0
