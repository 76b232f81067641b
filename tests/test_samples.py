"""De-duplication, quality, exports, responses, payloads, sources, sinks and streams."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from quirework.functions import payloads, responses
from quirework.functions import text as T
from quirework.operators import components, generation, pages, quality, samples
from quirework.plans import queries
from quirework.sources import readers, sinks
from quirework.streaming import ingest

S = "ordinal long, id string, task_type string, instruction string, question string, answer string, text string, output_payload struct<text:string,summary:string>, evidence struct<source_pages:array<int>,evidence_block_ids:array<string>>, metadata struct<journal_id:string,article_id:string,page_index:int,block_id:string,task_type:string,sample_no:int>, images array<string>"


def sample(n, i, text=None, task=samples.CORPUS, answer=None, j="j", a="a", p=1, images=None, instruction=None):
    return (n, i, task, instruction, "", answer or text, text, (text, None), ([p], []), (j, a, p, "b", task, 1), images)


def grams(t):
    import re

    s = re.sub(r"\W+", "", t.lower())
    return {s[k : k + 3] for k in range(len(s) - 2)} if len(s) > 3 else {s} if s else set()


def greedy(rows):
    kept, ids, hashes, slots, texts = [], set(), set(), {}, []
    for r in sorted(rows, key=lambda r: r[0]):
        j, slot = r[9][0], (r[9][0], *r[9][1:3], r[9][4])
        h = (j, r[7][0]) if r[7][0] else (j, r[4], r[5])
        g = grams(r[7][0] or "") if r[2] == samples.CORPUS else set()
        near = any(jj == j and g and x and len(g & x) / min(len(g), len(x)) >= 0.92 for jj, x in texts)
        if (j, r[1]) in ids or slots.get(slot, 0) >= 8 or h in hashes or near:
            continue
        kept.append(r[0])
        ids.add((j, r[1]))
        hashes.add(h)
        slots[slot] = slots.get(slot, 0) + 1
        if r[2] == samples.CORPUS:
            texts.append((j, g))
    return kept


def test_dedup_against_the_pass(spark):
    rng = random.Random(7)
    han = [chr(0x4E00 + i) for i in range(30)]
    rows, pool = [], []
    for n in range(400):
        if pool and rng.random() < 0.5:
            t = rng.choice(pool)
            t = rng.choice([t, t + rng.choice(han), t[: rng.randint(10, len(t))]])
        else:
            t = "".join(rng.choice(han) for _ in range(rng.randint(40, 200)))
        pool.append(t)
        task = rng.choice([samples.CORPUS, samples.CORPUS, "section_keypoint_summary"])
        rows.append(sample(n, f"id{rng.randint(0, 330)}", t, task, j=f"j{rng.randint(0, 2)}", p=rng.randint(1, 9)))
    rows += [sample(500 + k, f"e{k}", t) for k, t in enumerate(["", "   ", "ab", "ab"])]
    df = spark.createDataFrame(rows, S)
    got = sorted(r.ordinal for r in samples.deduplicate(df, samples.near_pairs(df)).collect())
    assert got == greedy(rows)
    assert samples.deduplicate(df.limit(0), samples.near_pairs(df.limit(0))).count() == 0


def test_dropped_rows_leave_no_trace(spark):
    rows = [sample(0, "a", "甲" * 50 + "x"), sample(1, "x", "甲" * 50 + "x"), sample(2, "x", "乙丙丁戊己庚" * 10)]
    df = spark.createDataFrame(rows, S)
    assert sorted(r.ordinal for r in samples.deduplicate(df, samples.near_pairs(df)).collect()) == [0, 2]


def test_least_labels(spark):
    e = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    assert {r.u: r.label for r in components.least_labels(e).collect()} == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_exports(spark, tmp_path):
    rows = [
        sample(1, "s1", None, "evidence_to_claim_chain", "答案", images=["p001.png", "p002.png"], instruction=" <image>看图 "), sample(2, "s2", None, "section_keypoint_summary", "要点", instruction="概括"),
        sample(3, "s3", " 语料 "), sample(4, "s4", "  "), sample(5, "s5", None, None, "x"),
    ]
    df = spark.createDataFrame(rows, S)
    m = samples.to_sharegpt(df).first().messages
    assert [(x.role, x.content) for x in m] == [("user", "<image><image>看图"), ("assistant", "答案")]
    assert [tuple(r) for r in samples.to_alpaca(df).select("ordinal", "instruction", "input", "output").collect()] == [(2, "概括", "{}", "要点")]
    assert [tuple(r) for r in samples.to_pt(df).collect()] == [(3, "语料")]
    out = str(tmp_path / "out")
    sinks.write_exports(df, out)
    sinks.write_exports(df, out)
    got = spark.read.text(out)
    assert sorted((r.format, r.task_type) for r in got.collect()) == sorted([("sharegpt", "evidence_to_claim_chain"), ("alpaca", "section_keypoint_summary"), ("pt", samples.CORPUS)])
    assert json.loads(got.filter("format = 'pt'").first().value) == {"text": "语料"}


@pytest.mark.parametrize("change,score", [
    ({}, 1.0), ({"instruction": ""}, 0.55), ({"instruction": "问"}, 0.75), ({"answer": "短"}, 0.75), ({"answer": "锟斤拷" + "内容" * 9}, 0.55), ({"answer": "内容" * 5 + "啊" * 9}, 0.75), ({"answer": "内容" * 5 + "★" * 5 + "☆◆◇○●" * 2}, 0.75),
    ({"answer": "```" + "内容" * 9}, 0.85), ({"instruction": "{问题内容"}, 0.75), ({"answer": '{"内容内容内容内容": 1}'}, 0.65), ({"answer": "metadata: 内容内容内容"}, 0.65),
])
def test_format_quality(spark, change, score):
    base = {"instruction": "概括这一节的要点", "answer": "内容完整的一个回答。"} | change
    df = spark.createDataFrame([sample(1, "s", None, "section_keypoint_summary", base["answer"], instruction=base["instruction"])], S)
    r = samples.text_format_quality(df).first()
    assert r.score == score and r.passed == (score >= 0.72)


@pytest.mark.parametrize("n,ok", [(1, False), (2, True), (3, True), (4, False), (0, False)])
def test_cross_page_bounds(spark, n, ok):
    df = spark.createDataFrame([sample(1, "s", None, quality.CROSS_TASK, "a", images=[f"p{k}.png" for k in range(n)]), sample(2, "t", None, None, "a")], S)
    assert [r.ok for r in quality.cross_page_bounds(df).orderBy("ordinal").collect()] == [ok, True]
    assert quality.cross_page_bounds(df, 0, 1).filter("ordinal = 1").first().ok == (n == 2)


def test_corpus_coverage(spark):
    df = spark.createDataFrame([("1.1 流速分析 内容内容", "1.1 流速分析 内容内容"), ("内容", "1.1 流速分析 内容内容"), ("x", ""), ("", "")], "o string, s string")
    assert [r[0] for r in df.select(quality.corpus_coverage(F.col("o"), F.col("s"))).collect()] == [1.0, 0.1, 1.0, 0.0]


@pytest.mark.parametrize("raw,want", [
    ('[{"a": "x\ny\tz"}]', [{"a": "x\ny\tz"}]), ('```json\n[{"a": 1,}, ]\n```', [{"a": 1}]), (r'[{"a": "5\% \alpha"}]', [{"a": r"5\% \alpha"}]), ('[{"a": "he said "yes" to me"}]', [{"a": 'he said "yes" to me'}]), ('{"a": 1}', [{"a": 1}]),
    ('Here: {"a": {"b": 1}} done', [{"a": {"b": 1}}]), ('see [{"a": 1}] or {"b": 2}', [{"a": 1}]), ('[{"a": 1}, 3]', [{"a": 1}]),
])
def test_responses(raw, want):
    assert responses.read_objects(raw) == want


@pytest.mark.parametrize("raw", ["3", "no JSON here", "", "null"])
def test_bad_responses(raw):
    with pytest.raises(ValueError):
        responses.read_objects(raw)


def test_reasoning_and_lines(spark):
    cases = [("<think>[1]</think>a", "a"), ("x</think> b", "b"), ("<think>1</think>c<think>2</think>d", "cd"), ("e<reasoning>cut", "e"), ("<think>cut", ""), (None, ""), ("plain", "plain"), ("a</think>b</think>c", "c")]
    df = spark.createDataFrame([(r,) for r, _ in cases], "r string")
    assert [x[0] for x in df.select(responses.strip_reasoning(F.col("r"))).collect()] == [w for _, w in cases]
    assert responses.read_lines('{"a": 1}\nbad {\n{"b": 2},') == [{"a": 1}, {"b": 2}] and responses.read_lines("") == []
    assert [x[0] for x in df.limit(1).select(responses.parse_response(F.lit('[{"b": 1, "a": 2}]'))).collect()] == [['{"a": 2, "b": 1}']]


def test_payloads(spark):
    long = "字" * 250
    rows = [{"t": "x" * 30} for _ in range(8)]
    p = {"context": {"template_input": {"t": long, "rows": rows}, "a": long, "b": {"c": long, "rows": rows}, "s": "short", "s2": "short"}, "again": [rows, rows]}
    big = {"context": {"template_input": "t" * 500, "x": "x" * 400, "y": "y" * 100, "z": {"k": ["z" * 50] * 4}}}
    df = spark.createDataFrame([("p", json.dumps(p, ensure_ascii=False)), ("big", json.dumps(big)), ("n", None), ("list", "[1]")], "id string, payload string")
    once = payloads.fold_repeats(df, "id", "payload")
    f = {r.id: json.loads(r.payload) for r in once.collect()}
    assert set(f) == {"p", "big", "list"} and f["big"] == big
    c = f["p"]["context"]
    assert c["a"] == "<同 context.template_input.t，内容不再重复>" and c["b"] == {"c": c["a"], "rows": "<同 context.template_input.rows，内容不再重复>"} and c["s2"] == "short"
    assert f["p"]["again"] == ["<同 context.template_input.rows，内容不再重复>"] * 2
    assert {r.id: json.loads(r.payload) for r in payloads.fold_repeats(once, "id", "payload").collect()} == f
    whole = len(json.dumps(big, ensure_ascii=False, indent=2))
    for most in (whole, whole - 1, 900, 10):
        got = json.loads(payloads.fit_budget(df, "id", "payload", most).filter("id = 'big'").first().payload)["context"]
        # the definition: the largest field goes until the rest fits
        want = dict(big["context"])
        for k in sorted((k for k in want if k != "template_input"), key=lambda k: -len(json.dumps(want[k]))):
            if len(json.dumps({"context": want}, ensure_ascii=False, indent=2)) <= most:
                break
            want[k] = f"<超出 prompt 预算 {most} 字符，本字段已省略>"
        assert got == want, most
    assert payloads.fit_budget(df, "id", "payload", 0).count() == 3


def test_text_hazards(spark):
    df = spark.createDataFrame([("a　b  c ",), (None,), ("\x1fx\x0by",)], "t string")
    assert [r[0] for r in df.select(T.clean_text("t")).collect()] == ["a b c", "", "x y"]
    df = spark.createDataFrame([("甲[1] ，乙 [2-3]\r\n\r\n\r\n丙 。\nOSID:\n[4]",)], "t string")
    assert df.select(T.clean_corpus_text(F.col("t"))).first()[0] == "甲，乙\n\n丙。"


def test_sources(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.pdf").write_bytes(b"%PDF-1.4 /Type /Page x /Type/Page y /Type /Pages")
    (tmp_path / "in" / "sub" / "b.pdf").write_bytes(b"")
    (tmp_path / "in" / "c.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "in" / "d.txt").write_bytes(b"x")
    got = [(r.path.rsplit("/", 1)[1], r.page_count, r.reason) for r in readers.journal_files(spark, str(tmp_path / "in")).collect()]
    assert got == [("a.pdf", 2, None), ("c.pdf", None, "no pages"), ("b.pdf", None, "empty")]
    (tmp_path / "x.jsonl").write_text('{"id": "a", "n": 1}\n\nbroken\n[1]\n{"id": "b"}\n')
    rows, bad = readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), spark.createDataFrame([], "id string, n int").schema)
    assert [tuple(r) for r in rows.collect()] == [("a", 1), ("b", None)] and bad.count() == 2
    lines = ['{"text": "a"}', '{"type": "Image", "page_idx": 2, "box": [1, 2, 3.5, 4, 5], "text": " b "}', '{"type": "strange"}', '{"page_no": "7", "poly": [[1, 2], [3, 4]]}', '{"page_idx": "x", "page": 8, "bbox": [], "box": [1, "2", 3]}']
    items = spark.createDataFrame(list(enumerate(lines)), "ordinal int, v string").select(F.lit("j").alias("journal_id"), "ordinal", F.from_json("v", readers.ITEM).alias("r")).select("journal_id", "ordinal", "r.*")
    got = [(r.page_index, r.block_type, r.bbox, r.text) for r in readers.content_items(items).orderBy("ordinal").collect()]
    assert got == [(1, "unknown", None, "a"), (3, "figure", [1.0, 2.0, 3.5, 4.0], "b"), (3, "unknown", None, ""), (7, "unknown", [1.0, 2.0, 3.0, 4.0], ""), (8, "unknown", None, "")]
    parse = {"result": json.dumps({"content_list": [{"a": 1}, {"b": 2}], "images": {"x": "y"}}), "other": [{"type": "text"}], "images": [1], "deep": [{"images": 1, "k": 2}]}
    one = spark.createDataFrame([(json.dumps(parse),), ("no JSON",), (None,)], "v string").select(readers.content_list("v").alias("items"), readers.without_images("v").alias("bare")).collect()
    assert [json.loads(x) for x in one[0]["items"]] == [{"a": 1}, {"b": 2}] and [r["items"] for r in one[1:]] == [None, None]
    assert json.loads(one[0].bare) == {k: v for k, v in parse.items() if k != "images"} | {"deep": [{"k": 2}]} and [r.bare for r in one[1:]] == ["no JSON", None]


def test_journal_rows(spark):
    df = spark.createDataFrame([("/a/x 1.pdf", None, None, None), (None, "/b/航空2021年第40卷 第3期.pdf", None, None), (None, "c.pdf", " 刊 2019-7-2 ", "given"), ("", "/d/known.pdf", None, "")], "path string, url string, name string, journal_id string")
    ids = spark.createDataFrame([("known.pdf", "k1")], "name string, journal_id string")
    got = [tuple(r) for r in readers.journal_rows(df, ids).collect()]
    assert got == [("/a/x 1.pdf", "x 1", "x_1", "", "", ""), ("/b/航空2021年第40卷 第3期.pdf", "航空2021年第40卷 第3期", "航空2021年第40卷_第3期", "2021", "40", "3"), ("c.pdf", "刊 2019-7-2", "given", "2019", "7", "2"), ("/d/known.pdf", "known", "k1", "", "", "")]
    with pytest.raises(Exception, match="no path"):
        readers.journal_rows(df.limit(1).select(F.lit("").alias("path"))).collect()


def test_streamed_answers(spark):
    piece = lambda **d: "data: " + json.dumps({"choices": [{"delta": d}]})
    raw = "\n".join([": hello", piece(role="assistant"), piece(reasoning_content="no"), piece(content="一"), "data: broken", piece(content="二"), "data: [DONE]", piece(content="三")])
    df = spark.createDataFrame([(raw,), (None,)], "t string")
    assert [r[0] for r in df.select(responses.stream_text(F.col("t"))).collect()] == ["一二", ""]
    parts = spark.sql("SELECT array(named_struct('type', 'reasoning', 'text', 'x'), named_struct('type', 'text', 'text', 'y'), named_struct('type', NULL, 'text', 'z')) AS p")
    assert parts.select(responses.content_text(F.col("p"))).first()[0] == "yz"


def test_stream_appends_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = spark.createDataFrame([], "id string, ordinal int, v string").schema

    def feed(name, rows):
        (tmp_path / "src").mkdir(exist_ok=True)
        (tmp_path / "src" / name).write_text("\n".join(json.dumps({"id": i, "ordinal": n, "v": v}) for i, n, v in rows))
        ingest.append_once(ingest.read_samples(spark, src, schema), out, ck).awaitTermination()

    feed("a.json", [("x", 2, "late"), ("x", 1, "first"), ("y", 3, "y")])
    feed("b.json", [("x", 4, "again"), ("z", 5, "z")])
    assert sorted(map(tuple, spark.read.parquet(out).select("id", "v").collect())) == [("x", "first"), ("y", "y"), ("z", "z")]


def test_windows_and_sessions(spark):
    e = spark.sql("SELECT timestamp'2024-01-01 00:10:00' AS ts, 1L AS user_id, 'a' AS event_type, 1.0D AS value UNION ALL SELECT timestamp'2024-01-01 00:30:00', 1L, 'a', 2.0D UNION ALL SELECT timestamp'2024-01-01 02:00:00', 1L, 'a', 4.0D")
    assert sorted((r.n, r.value) for r in ingest.window_counts(e).collect()) == [(1, 4.0), (2, 3.0)]
    assert sorted(r.n for r in ingest.sessions(e).collect()) == [1, 2]


def test_page_of_a_continuation_has_its_blocks(spark):
    v = spark.createDataFrame([("j", "a", 1, "article_body", 0, 1, "body", "text", "上一段没有完"), ("j", "a", 2, "article_body", 1, 2, "body", "text", "后"), ("j", "a", 2, "article_body", 0, 1, "body", "text", "先"), ("j", "a", 2, "article_body", 2, 3, "body", "text", "OSID:")], "journal_id string, article_id string, page_index int, page_type string, block_ordinal int, reading_order int, semantic_role string, block_type string, shown string")
    p = spark.createDataFrame([("j", 1, "a", "刊", "题", "1"), ("j", 2, "a", "刊", "题", "2")], "journal_id string, page_index int, article_id string, journal_name string, article_title string, page_label string")
    w = spark.createDataFrame([("j", "a", 1, 2)], "journal_id string, article_id string, first_page int, last_page int")
    paras = pages.paragraphs(v)
    assert {r.start_page for r in paras.collect()} == {1}
    text = generation.corpus_samples(w, paras, p, v).first().text
    assert text.split("页码：2]")[1].split() == ["先", "后"]


def test_answers_are_parsed_too(spark, tmp_path):
    spark.createDataFrame([(7, '{"a": 1}')], "event_id long, props string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([("s", '<think>x</think>{"b": 2}'), ("t", None), ("u", "text")], "id string, answer string").write.parquet(f"{tmp_path}/samples.parquet")
    got = {(r.source, r.id): r.n for r in queries.parsed_responses(spark, str(tmp_path)).collect()}
    assert set(got) == {("event", "7"), ("sample", "s"), ("sample", "t"), ("sample", "u")} and got["event", "7"] == got["sample", "s"] == 1
