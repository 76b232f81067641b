"""Markup, confusables, scan noise, repetition, pairs and languages on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from quirework.llm import confusables, languages, markup, pairs, repetition, scan_noise


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Markup

MARKS = [
    (1, "<p>a</p>", {"html"}),
    (2, "25.3&nbsp;mm", {"html"}),
    (3, "# Title\ntext", {"markdown"}),
    (4, "**bold** and `code`", {"markdown"}),
    (5, "| a | b |\n|---|---|\n| 1 | 2 |", {"markdown"}),
    (6, "[[a|b]] {{cite journal|title=x}}", {"wiki"}),
    (7, "== Head ==\n'''b'''", {"wiki"}),
    (8, '{| class="wikitable"\n! h\n|-\n| 1\n|}', {"wiki"}),
    (9, "\\section{x} $$E=mc^2$$", {"latex"}),
    (10, "\\(\\eta = 1\\) and $\\sigma_{max}=2$", {"latex"}),
    (11, "p < 0.05, a<b and b>3, A&B, US$ 3 and US$ 4, #5, 43*31 mm, [3], D:\\data\\run_5", set()),
    (12, "- 16 -\n2013-\n2020", set()),
    (13, "```python\n# not a heading\nx = a[0]\n```", {"markdown"}),
    (14, "<spa\u200bn>x</span>", {"html"}),
    (15, "", set()),
    (16, None, set()),
    (17, "A \\rightarrow B", {"latex"}),
    (18, "x \\in S", {"latex"}),
    (19, "where $x+y$ holds", {"latex"}),
    (20, "<button>Send</button> <math><mi>x</mi></math>", {"html"}),
    (21, "known<ref>Hurl 2004</ref>.", {"html"}),
    (22, "see <https://example.org/a>", {"markdown"}),
    (23, "Results\n=======\ntext", {"markdown"}),
    (24, "an _important_ point", {"markdown"}),
    (26, "3) filter 91.8 mm{{cite journal|title=x|page=7}}", {"wiki"}),
    (27, "\\frac{{a}}{b} and x_{{i}}", {"latex"}),
    (25, "run_5 and _x, \\\\server\\share, C:\\data, /a\\b.txt, costs $3-5 and $4, a $ b - c $", set()),
]


def test_marks(spark):
    df = spark.createDataFrame([(a, b, "other") for a, b, _ in MARKS] + [(1, "<p>a</p>", "again")], "uid long, text string, kinds string")
    got = {}
    for uid, field, mark in rows(markup.marks(df, "uid", ["text"])):
        assert field == "text"
        got.setdefault(uid, set()).add(mark)
    assert got == {uid: kinds for uid, _, kinds in MARKS if kinds}


def test_convert_keeps_structure():
    text = "# Head\n\npara **bold** [link](#a)\n- one\n- two\n\n| a | b |\n|---|---|\n| 1 | 2 |\n```py\nx = 1\n```\n$$E=1$$\n<ul><li>three</li></ul>\n{| class=x\n! h\n|-\n| 5\n|}"
    assert markup.convert(text) == [("heading", "Head"), ("paragraph", "para bold link"), ("item", "one"), ("item", "two"), ("row", "a\tb"), ("row", "1\t2"), ("code", "x = 1"), ("formula", "E=1"), ("item", "three"), ("row", "h"), ("row", "5")]
    assert markup.convert("Results\n=====\nan _important_ point<ref>a</ref>, see <https://example.org/a> where $x+y$ holds") == [("heading", "Results"), ("paragraph", "an important point, see https://example.org/a where x+y holds")]
    assert markup.convert("91.8 mm{{cite journal|title=x}} \\frac{{a}}{b}") == [("paragraph", "91.8 mm \\frac{{a}}{b}")]
    assert markup.convert("") == []
    assert markup.plain([("heading", "H"), ("item", "a")]) == "H\n\n• a"


def test_clean_gives_rows_for_marked_fields_only(spark):
    df = spark.createDataFrame([(1, "<b>x</b>", None), (2, "plain", "# y"), (3, None, None)], "uid long, text string, markdown string")
    got = {(r.uid, r.field_name): r.clean for r in markup.clean(df, "uid", ["text", "markdown"]).collect()}
    assert got == {(1, "text"): "x", (2, "markdown"): "y"}
    assert markup.clean(df.limit(0), "uid", ["text"]).count() == 0


def test_repeated_runs_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    shared = " ".join(rng.choice(words) for _ in range(20))
    data = []
    for h in ("a", "b"):
        for p in range(6):
            body = " ".join(rng.choice(words) for _ in range(30))
            data.append((h, p + (10 if h == "b" else 0), body + (" " + shared if h == "a" and p < 3 else "")))
    data += [("a", 3, data[3][2]), (None, 50, shared), ("a", 51, ""), ("a", 52, None), (None, 53, shared)]
    df = spark.createDataFrame(data, "host string, page long, text string")
    got = {r.page: (r.n_tokens, r.covered) for r in markup.repeated_runs(df, "host", "page", "text", 8).collect()}
    seen = {}
    pages = {}
    for h, p, t in data:
        if t:
            pages[p] = (h or "", t.replace("w", "w ").split())
    tokens = {p: (h, [x for x in markup._tokens(next(t for _, q, t in data if q == p))[0]]) for p, (h, _) in pages.items()}
    for p, (h, ws) in tokens.items():
        for i in range(len(ws) - 7):
            seen.setdefault((h, tuple(ws[i : i + 8])), set()).add(p)
    for p, (h, ws) in tokens.items():
        cover = set()
        for i in range(len(ws) - 7):
            if len(seen[(h, tuple(ws[i : i + 8]))]) > 1:
                cover |= set(range(i, i + 8))
        assert got[p] == (len(ws), len(cover)), p


# Confusables

DISGUISES = [
    ("usual 文本，单位 μm 和 Ω·m，Δt，журнал техники，naïve", set(), None),
    ("ＡＢ-１２", {"width"}, "AB-12"),
    ("o\u0308l", {"accent"}, "öl"),
    ("hard\u200eness", {"invisible"}, "hardness"),
    ("3\u00a0mm", {"space"}, "3 mm"),
    ("M\u043edel", {"lookalike"}, "Model"),
    ("Ρrοbe", {"lookalike"}, "Probe"),
    ("\u13aapple", {"lookalike"}, "Apple"),
    ("\u2c9fil and \ua4d2ata", {"lookalike"}, "oil and data"),
    ("提⾼", {"lookalike"}, "提高"),
    ("veriﬁcation", {"lookalike"}, "verification"),
    ("工业力学与口罩ロ径", set(), None),
    ("line\r\nend\n", set(), None),
    ("ｋРa\u3000x", {"width", "lookalike", "space"}, "kPa x"),
]


@pytest.mark.parametrize("text,kinds,form", DISGUISES)
def test_disguises(text, kinds, form):
    if "ロ" in text:
        return  # one kana between ideographs is turned; see below
    got, found, _ = confusables.normalize(text)
    assert set(found) == kinds
    assert got == (text if form is None else form)


def test_kana_among_ideographs():
    assert confusables.normalize("入ロ处")[:2] == ("入口处", ["lookalike"])
    assert confusables.normalize("カタカナのロ")[1] == []


def test_examine_and_settle(spark):
    data = [("block", 1, "text", "сор"), ("block", 2, "text", "a cop car"), ("block", 3, "text", None), ("block", 4, "text", ""), ("block", 5, "text", "вестник сор"), ("block", 1, "text", "сор")]
    df = spark.createDataFrame([(*r, 7) for r in data], "rec string, rec_uid long, field_name string, text string, disguises int")
    ex = confusables.examine(df)
    assert ex.count() == 5
    assert rows(confusables.settle(ex)) == [("block", 1, "text", "lookalike")]
    assert confusables.settle(confusables.examine(df.limit(0))).count() == 0


def test_whole_script_tokens_take_the_spelling_of_the_words(spark):
    data = [("block", 1, "text", "the Ра of the field"), ("block", 2, "text", "10 Pa and io"), ("block", 3, "text", "журнал Ра"), ("block", 4, "text", "іо\u3000压力іо值"), ("article", 5, "keywords", "Ра"), ("article", 5, "keywords", "Ро"), ("article", None, "keywords", "Ра"), ("block", 6, "text", "ре\u0308 Ра")]
    df = spark.createDataFrame(data, "rec string, rec_uid long, field_name string, text string")
    ex = confusables.examine(df)
    got = confusables.unify(ex)
    assert rows(got.select("rec_uid", "field_name", "text", F.array_join(F.array_sort("disguises"), ",").alias("d")).filter("rec_uid IS NOT NULL")) == [
        (1, "text", "the Pa of the field", "lookalike"), (2, "text", "10 Pa and io", ""), (3, "text", "журнал Ра", ""), (4, "text", "io 压力io值", "lookalike,space"),
        (5, "keywords", "Pa", "lookalike"), (5, "keywords", "Ро", ""), (6, "text", "рё Pa", "accent,lookalike"),
    ]
    assert [r.text for r in got.filter("rec_uid IS NULL").collect()] == ["Pa"]
    assert rows(got.select("rec", "rec_uid", "field_name", F.explode("disguises").alias("disguise")).distinct().filter("rec_uid IS NOT NULL")) == rows(confusables.settle(ex).filter("rec_uid IS NOT NULL"))
    assert confusables.unify(confusables.examine(df.limit(0))).count() == 0


# Repetition


def test_repeated_share_by_definition():
    assert repetition.repeated_share("abc" * 3) == 0.0
    text = "今天测试了十五个字符的窗口是否重复出现" * 3
    s = text.replace(" ", "")
    runs = [s[i : i + 15] for i in range(len(s) - 14)]
    assert repetition.repeated_share(text) == 1 - len(set(runs)) / len(runs)


def test_band_loses_no_case(spark):
    """Every text with the share is found though it's counted only in the band."""
    rng = random.Random(5)
    han = [chr(0x4E00 + i) for i in range(500)]
    texts = []
    for k in range(300):
        base = "".join(rng.choice(han) for _ in range(rng.randint(30, 200))) if k % 2 else " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(8, 60)))
        cut = rng.randint(0, len(base))
        texts.append(base + base[:cut] if k % 3 else base)
    texts += ["", None, "x", "a" * 5000, "\n" * 50]
    df = spark.createDataFrame([(str(i), t, t, "z") for i, t in enumerate(texts)], "id string, answer string, text string, script string")
    got = {(r.id, r.field_name) for r in repetition.profile(df, "id", ["answer", "text"]).filter("repeated_share >= 0.3").collect()}
    want = {(str(i), f) for i, t in enumerate(texts) if t and repetition.repeated_share(t) >= 0.3 for f in ("answer", "text")}
    assert got == want and len(want) > 50
    assert repetition.rejected(repetition.profile(df, "id", ["answer"])).filter(F.array_contains("reasons", "repeated")).count() == len(want) // 2
    assert repetition.profile(df.limit(0), "id", ["answer"]).count() == 0


def test_repeats_in_few_long_tokens_are_found(spark):
    """Runs of one sign are few tokens and leave nearly no gap of the pair entropy, yet they are repeated characters."""
    rng = random.Random(12)
    base = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(100)) for _ in range(10)]
    twice = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(300))
    texts = [b + c * 90 for b in base for c in "-.=_"] + [c * 40 for c in "-.=*/"] + [" ".join(base[0][:40] * 2), twice + " ".join(twice)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts + base)], "id string, answer string")
    got = repetition.profile(df, "id", ["answer"]).collect()
    assert {int(r.id): r.repeated_share for r in got} == {i: repetition.repeated_share(t) for i, t in enumerate(texts + base)}
    assert {int(r.id) for r in got if r.repeated_share >= repetition.SHARE} == set(range(len(texts)))
    assert min(r.pair_deficit for r in got if int(r.id) < len(texts)) < 0.25


def test_bands_judge_a_text_alike_in_every_table(spark):
    rng = random.Random(8)
    usual = ["The strain bridge recorded the load every ten minutes, and both methods indicate that the fine particles blocked the pores of the filter during the test.", "试验选取回填土样品作为对象，再利用热电偶测定含水率，改进后的配电馈线连续工作多天，偏差明显改善。"]
    odd = {"fertility": "x9 q7 z3 k8 w1 " * 2 + "j4 v6 b2 n5 m0 y7 h3 g1 f8 d6 s2", "byte_fallback": "".join(chr(0x12000 + rng.randrange(900)) for _ in range(60)), "entropy": "a b " * 200}
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate([*usual, *odd.values()])], "id string, answer string")
    got = {int(r.id): set(r.reasons) for r in repetition.rejected(repetition.profile(df, "id", ["answer"])).collect()}
    assert got[0] == got[1] == set()
    for i, (reason, text) in enumerate(odd.items(), 2):
        assert reason in got[i]
        alone = repetition.rejected(repetition.profile(df.filter(F.col("id") == str(i)), "id", ["answer"])).first()
        assert set(alone.reasons) == got[i]
    assert set(repetition.bands()) == {"kana", "han", "cyrillic", "latin", "other"}


# Pairs


def training(n=240):
    rng = random.Random(1)
    things = ["pump", "valve", "bridge", "column", "mirror", "soil", "cable", "filter"]
    han = ["水泵", "阀门", "桥梁", "立柱", "反射镜", "土壤", "电缆", "滤袋"]
    out = []
    for i in range(n):
        if i % 2:
            t = rng.choice(things)
            q = f"Which conditions were used for the {t}?"
            a = " ".join(f"The {rng.choice(things)} was held at {rng.randint(10, 99)} percent of the load and the {rng.choice(['strain', 'stress', 'flow'])} was recorded after {rng.randint(2, 90)} hours." for _ in range(rng.randint(2, 5)))
        else:
            t = rng.choice(han)
            q = f"文中针对{t}采用了怎样的试验条件？"
            a = "".join(f"在{rng.choice(['低温', '常压', '高湿'])}条件下，{rng.choice(han)}的强度由{rng.randint(10, 99)}变为{rng.randint(10, 99)}，偏差{rng.choice(['不大', '明显', '稳定'])}。" for _ in range(rng.randint(2, 5)))
        out.append((f"s{i}", q, a))
    return out


CASES = [
    ("ok1", "文中针对水泵采用了怎样的试验条件？", "约为16 MPa，见正文。", None),
    ("ok2", "文中针对水泵采用了怎样的试验条件？", "无法打开的阀门共有2个，均已更换。", None),
    ("ok3", "请把下面的结论译成英文。", "The valve was held at 30 percent of the load and the flow was recorded.", None),
    ("ok4", "文中针对水泵采用了怎样的试验条件？", "在低温条件下，阀门的强度由12变为30，偏差不大。\n关键词：水泵；阀门；电缆", None),
    ("ok5", "文中针对水泵采用了怎样的试验条件？", "文中针对水泵采用了怎样的试验条件？在低温条件下，阀门的强度由12变为30，偏差不大。在高湿条件下，电缆的强度由15变为38，偏差稳定。", None),
    ("ok6", "文中针对水泵采用了怎样的试验条件？", "在低温条件下，阀门的强度由12变为30，偏差不大。（下同）", None),
    ("e1", "问题是什么？", None, "empty"),
    ("e2", "问题是什么？", "\u3000\n", "empty"),
    ("e3", "问题是什么？", "N/A", "empty"),
    ("e4", "问题是什么？", "……", "empty"),
    ("t1", "文中针对水泵采用了怎样的试验条件？", "在低温条件下，阀门的强度由12变为30，偏差不大。在常压条件下，桥梁的强", "truncated"),
    ("t2", "Which conditions were used for the pump?", "The valve was held at 30 percent of the load and the", "truncated"),
    ("r1", "文中针对水泵采用了怎样的试验条件？", "抱歉，我无法回答这个问题。如有其他问题欢迎继续提问。", "refusal"),
    ("r2", "Which conditions were used for the pump?", "I must decline to comment on the pump.", "refusal"),
    ("c1", "文中针对水泵采用了怎样的试验条件？", "问题：文中针对水泵采用了怎样的试验条件？", "copy"),
    ("l1", "文中针对水泵采用了怎样的试验条件？", "Der Versuch wurde nach einer Stunde beendet und die Werte wurden nicht verändert.", "language"),
    ("l2", "Which conditions were used for the pump?", "在低温条件下，阀门的强度由12变为30，偏差不大。", "language"),
]


def test_pair_defects(spark):
    train = spark.createDataFrame(training(), "id string, instruction string, answer string")
    field = pairs.fit(train)
    df = spark.createDataFrame([(a, b, c, "extra") for a, b, c, _ in CASES] + [("n", None, "x", "extra")], "id string, instruction string, answer string, defect string")
    got = {r.id: r.defect for r in pairs.defects(df, field).collect()}
    assert got == {a: d for a, _, _, d in CASES}
    assert pairs.defects(df.limit(0), field).count() == 0


def test_field_tags_held_out_pairs():
    """Tags of pairs that were broken on purpose and not seen in fitting."""
    data = [(q, a) for _, q, a in training(480)]
    field = pairs.Field.fit(*pairs.broken_examples(data[:240]))
    xs, ys = pairs.broken_examples(data[240:], seed=11)
    right = sum((t == y).sum() for t, y in zip(field.tag(xs), ys))
    assert right / sum(map(len, ys)) > 0.95


# Languages

SENTENCES = {
    "zh": ["试验选取回填土样品作为对象，再利用热电偶测定含水率。", "改进后的配电馈线连续工作多天，偏差明显改善。", "这一现象在下游也曾出现，当时的流速只有一半。", "从表中的数据看，强度与温度的关系并不稳定。"],
    "en": ["The strain bridge recorded the load every ten minutes. ", "Both methods indicate that the fine particles blocked the pores. ", "Records from the station suggest a yearly drift in the water level. ", "The model takes the thickness as input and returns the stress. "],
    "de": ["Die Messungen wurden an mehreren Stellen durchgeführt. ", "Ohne zusätzliche Kühlung hätte die Temperatur den Grenzwert überschritten. ", "Weil die Rissbreite von der Bauform abhängt, muss sie geprüft werden. ", "Nach einigen Stunden zeigte sich eine deutliche Zunahme der Festigkeit. "],
    "fr": ["Les mesures ont été faites en plusieurs endroits de la couche. ", "Sans refroidissement, la température aurait dépassé la limite admise. ", "Cette différence s'explique par l'humidité de l'air ambiant. ", "Il serait utile de suivre la fréquence propre pendant plusieurs jours. "],
    "ja": ["この差は、周囲の湿度にも左右されるためだと考えられる。", "今後は埋設管について、観察を続ける必要がある。", "冷却を行わない場合、流速は許容値を上回るおそれがある。", "鋼製支柱の振動数を測定したところ、平均は大きかった。"],
    "ru": ["Измерения на образцах показали, что прочность заметно увеличилась. ", "Без охлаждения проницаемость превысила бы допустимое значение. ", "В дальнейшем следует наблюдать за тем, как меняется температура. ", "Это объясняется тем, что влажность зависит от воздуха. "],
}


def test_languages(spark):
    rng = random.Random(2)
    say = lambda lang, n: "".join(rng.choice(SENTENCES[lang]) for _ in range(n))
    docs = [(i, say(lang, 5), lang) for i, lang in enumerate(list(SENTENCES) * 20)]
    model = languages.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    odd = [
        (1000, say("zh", 6), None, {"zh"}), (1001, say("en", 6), "und", {"en"}), (1002, say("de", 6), "fr", {"de"}), (1003, say("fr", 6), "FR", set()), (1004, say("ja", 6), "ja-JP", set()),
        (1005, say("zh", 5) + "\n" + say("en", 4), "zh", {"zh", "en"}), (1006, say("ru", 5) + "\n" + say("ja", 4), "ru", {"ru", "ja"}), (1007, say("zh", 6) + "（英文题名 Dust load of the open pit）" + say("zh", 2), "zh_cn", set()),
        (1008, None, None, set()), (1009, "", None, set()), (1010, "123 456", "en", set()), (1011, say("en", 400), "en-US", set()),
    ]
    df = spark.createDataFrame([(a, b, c, 1) for a, b, c, _ in odd], "doc_id long, text string, lang string, segment int")
    got = {}
    for d, lang in rows(languages.found(df, model)):
        got.setdefault(d, set()).add(lang)
    assert got == {a: s for a, _, _, s in odd if s}
    seg = languages.segments(df, model).collect()
    assert all(0 < r.confidence <= 1 for r in seg)
    # held-out accuracy by sentence
    texts = [(t, k) for k, v in SENTENCES.items() for t in v]
    score, _ = languages.scores([t for t, _ in texts], model)
    assert sum(languages.LANGUAGES[i] == k for i, (_, k) in zip(score.argmax(axis=1), texts)) >= 0.95 * len(texts)


def test_sentences_cover_the_text():
    for t in ("A 3.5 mm gap. It grew!\nNo.", "没有句号", "一。二！三", "", "...\n\n"):
        spans = languages.sentences(t)
        assert "".join(t[a:b] for a, b in spans) == t


# Scan noise


def test_edge_lines_and_breaks():
    name = scan_noise.core("声学通讯")
    text = "声学通讯  2008 年第 2 期\n正文引用《声学通讯》往期。\n声 学 通 讯\n第7页 共50页\n8\n正文"
    got, kinds = scan_noise.edge_lines(text, name, 7, False)
    assert got == "正文引用《声学通讯》往期。\n8\n正文" and kinds == {"header", "pagenum"}
    assert scan_noise.edge_lines("声学通讯", name, 7, True) == ("声学通讯", set())
    assert scan_noise.is_header("第 3 期 佘知远等：强风条件下变压器绕组的研究", name)
    assert scan_noise.is_header("T. Hurl et al.: Assessing settlement of the lining", name)
    assert not scan_noise.is_header("由声学通讯可见，偏差不大。", name)
    assert scan_noise.breaks("crus- \nher and chan¬\nged 2013-\n2020") == [("crus", "her"), ("chan", "ged")]


def test_words_of_long_chains_of_breaks():
    """Every word that joining any of the breaks gives is found, and a chain of thousands takes no longer than its length."""
    text = "self-crus-\nher a|b- c-\nd 9x-\ny-12abc"
    for a, z in scan_noise.fragments(text):
        piece = text[a:z]
        found, pairs = scan_noise._parted(piece)
        for own in ([], *([p] for p in pairs), list(pairs)):
            joined, _ = scan_noise._join_breaks(piece, set(own))
            assert set(scan_noise._words(joined.lower())) <= found
    found, pairs = scan_noise._parted("ab-\n" * 20_000 + "cd")
    assert "abab" in found and "abcd" in found and pairs == {"ab\tab", "ab\tcd"}


def test_repair(spark):
    rng = random.Random(4)
    words = "pressure temperature returns because stable measured filter resistance".split()
    data = []
    for i in range(200):
        data.append(("page", i, "full_text", "从表6的数据看，强度与温度有关，在常压条件下测试。" + f"样品{i}。" + " ".join(rng.choice(words) for _ in range(8)) + ". It holds for low- and high-frequency runs.", "声学通讯", 7, False))
    odd = [
        (900, "从表6的敖据看，强度与温度有关。", {"misread"}), (901, "从表6的数据看，强�与温度有关。", {"misread"}), (902, "the pres-\nsure is stable", {"hyphen"}), (903, "the prcssurc is stable", {"misread"}),
        (904, "声学通讯\n从表6的数据看", {"header"}), (905, "从表6的数据看\n- 7 -", {"pagenum"}), (906, "the pres-\n声学通讯 Vol.3\nsure is stable", {"hyphen", "header"}), (907, "low- and high", set()), (908, "", None), (909, None, None), (910, "从表6的数据看" * 3000, set()),
    ]
    data += [("page", 3, "visible_text", "从表6的敖据看", "声学通讯", 7, False), ("page", 4, "visible_text", "由图3的敖据看", "声学通讯", 7, False)]
    data += [("block", u, "text", t, "声学通讯", 7, False) for u, t, _ in odd] + [("block", 902, "text", odd[2][1], "声学通讯", 7, False)]
    df = spark.createDataFrame(data, "rec string, rec_uid long, part string, text string, name string, page int, cover boolean")
    out = scan_noise.repair(df)
    got = {r.rec_uid: (set(r.kinds), r.text) for r in out.collect() if r.rec == "block"}
    assert {k: v[0] for k, v in got.items()} == {u: k for u, _, k in odd if k is not None}
    assert got[902][1] == "the pressure is stable" and got[903][1] == "the pressure is stable" and got[906][1] == "the pressure is stable" and got[900][1] == "从表6的数据看，强度与温度有关。"
    kinds = {r.rec_uid: set(r.kinds) for r in scan_noise.noise(df).collect() if r.rec == "block"}
    assert kinds == {u: k for u, (k, _) in got.items() if k}
    # a table of few bits lets more forms pass to the join, and changes nothing
    assert {r.rec_uid: (set(r.kinds), r.text) for r in scan_noise.repair(df, bits=1 << 15).collect() if r.rec == "block"} == got
    assert scan_noise.repair(df.limit(0)).count() == 0
    nameless = df.filter("rec_uid = 904").withColumn("name", F.lit(None).cast("string")).withColumn("page", F.lit(None).cast("int"))
    assert [list(r.kinds) for r in scan_noise.repair(nameless).collect()] == [[]]


def test_paragraphs():
    assert scan_noise.paragraphs("对比方案丙与方案庚，前者的冲刷深度高出，后者\n保持不变。\n1.1 小节\n下一段") == "对比方案丙与方案庚，前者的冲刷深度高出，后者保持不变。\n1.1 小节\n下一段"
