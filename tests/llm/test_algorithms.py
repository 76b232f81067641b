"""Near duplicates, splitting, packing and leakage against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from quirework.llm import leakage, near_duplicates, packing, splitting


# Near duplicates


def jaccard(a, b):
    x, y = ({t[i : i + 3] for i in range(len(t) - 2)} for t in (a, b))
    return len(x & y) / len(x | y)


def test_pairs_against_brute_force(spark):
    rng = random.Random(6)
    han = [chr(0x4E00 + i) for i in range(300)]
    data = []
    for k in range(60):
        base = [rng.choice(han) for _ in range(rng.randint(210, 320))]
        data.append("".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 14)):
                copy[rng.randrange(len(copy))] = rng.choice(han)
            data.append("".join(copy))
    ids = [(f"id{i}", "问" if i % 3 else None, t, i) for i, t in enumerate(data)]
    ids += [("short", "q", "x" * 50, 1), ("same", None, data[0] + " 。 ", 1), ("null", "q", None, 1), (None, "q", data[0], 1), ("empty", "q", "", 1), ids[0]]
    df = spark.createDataFrame(ids, "id string, instruction string, answer string, rep int")
    got = set(map(tuple, near_duplicates.pairs(*near_duplicates.links(df, "id", "instruction", "answer")).collect()))
    c = {i: near_duplicates.clean(q) + near_duplicates.clean(a) for i, q, a, _ in ids if i and a and len(near_duplicates.clean(a)) >= 200}
    want = {(a, b) for a in c for b in c if a < b and jaccard(c[a], c[b]) >= 0.8}
    assert got == want and len(want) > 60


def test_classes(spark):
    members = spark.createDataFrame([(f"i{k}", k) for k in range(12)] + [("j3", 3)], "id string, rep long")
    links = spark.createDataFrame([(k, k + 1, 0.9) for k in range(8)] + [(9, 10, 0.9)], "rep_a long, rep_b long, similarity double")
    got = {r.id: (r.class_id, r.n_links) for r in near_duplicates.classes(members, links).collect()}
    assert got == {**{f"i{k}": ("i0", 1 if k in (0, 8) else 2) for k in range(9)}, "i9": ("i10", 1), "i10": ("i10", 1), "i11": ("i11", 0), "j3": ("i0", 2)}
    assert {r.id: r.text_id for r in near_duplicates.classes(members, links).collect()}["j3"] == "i3"
    assert near_duplicates.classes(members.limit(0), links.limit(0)).count() == 0


def test_blocks_find_what_brute_force_finds():
    """Recall at the threshold itself: pairs of similarity about 0.8 share a block."""
    rng = np.random.default_rng(8)
    hits = 0
    for _ in range(400):
        union = rng.integers(1, 1 << 60, 300).astype(np.uint64)
        a, b = np.unique(union[:270]), np.unique(union[30:])  # 240 of 300 in common
        hits += bool(np.intersect1d(near_duplicates.band_keys(a), near_duplicates.band_keys(b)).size)
    assert hits >= 399


# Splitting

TEXTS = st.text(alphabet=st.sampled_from(list("abc 甲乙丙。！.;\n𠀀")), max_size=400)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(12, 60), st.integers(0, 10))
def test_pieces_round_trip(text, size, overlap):
    got = splitting.pieces(text, size, overlap)
    assert "".join(text[a:e] for _, e, a in got) == text
    ends = set(splitting.boundaries(text).tolist()) if text else {0}
    for i, (s, e, a) in enumerate(got):
        assert e - s <= size
        assert s == (a - overlap if i else 0) if i else s == 0
        if e not in ends:  # a cut elsewhere only where no boundary fits
            assert not [x for x in ends if a < x <= s + size]


def test_edit_moves_neighbouring_pieces_only():
    rng = random.Random(9)
    text = "".join("".join(rng.choice("甲乙丙丁戊己庚辛壬癸") for _ in range(rng.randint(8, 40))) + "。" for _ in range(400))
    edited = text[:4000] + "改动" + text[4000:]
    new = lambda t: {t[a:e] for _, e, a in splitting.pieces(t, 600, 50)}
    assert len(new(edited) - new(text)) <= 4 < len(new(text))


def test_split(spark):
    data = [(1, "甲" * 30 + "。" + "乙" * 30), (2, "甲" * 80), (3, "短。"), (4, None), (5, ""), (6, "x. y? " * 5000), (3, "短。")]
    df = spark.createDataFrame([(*r, "c") for r in data], "uid long, t string, cut string")
    out = splitting.split(df, "uid", "t", 50, 5)
    kinds = {r.id: r.cut for r in out.collect()}
    assert kinds == {1: "natural", 2: "forced", 3: "whole", 6: "natural"}
    assert splitting.split(df.limit(0), "uid", "t", 50, 5).count() == 0
    with pytest.raises(ValueError):
        splitting.split(df, "uid", "t", 50, 50)


# Packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=200))
def test_best_two_fit(sizes):
    home, bins = packing.best_two_fit(np.array(sizes, dtype=np.int64), 100)
    load = np.bincount(home, weights=sizes, minlength=bins) if sizes else np.zeros(0)
    assert (load <= 100).all() and (load > 0).all() and (home >= 0).all()
    order = sorted(sizes, reverse=True)  # no more containers than first fit decreasing by more than a little
    room = []
    for s in order:
        for i, r in enumerate(room):
            if r >= s:
                room[i] -= s
                break
        else:
            room.append(100 - s)
    assert bins <= len(room) * 1.1 + 1


def test_pack(spark):
    rng = random.Random(10)
    docs = [(i, "é" * rng.randint(0, 60) + "𠀀" * rng.randint(0, 5), 1) for i in range(500)] + [(900, "é" * 400, 1), (901, None, 1), (None, "x", 1), (902, "", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, container int")
    out = packing.pack(df, 100, shard=200).collect()
    texts = {d: t for d, t, _ in docs}
    load, parts = {}, {}
    for r in out:
        load[r.container] = load.get(r.container, 0) + r.tokens
        parts.setdefault(r.doc_id, []).append(r)
    assert max(load.values()) <= 100 and set(parts) == {d for d, t, _ in docs if d is not None and t is not None}
    for d, ps in parts.items():
        ps.sort(key=lambda r: r.piece)
        assert "".join(texts[d][r.char_start : r.char_start + r.n_chars] for r in ps) == texts[d]
        assert all(len(texts[d][r.char_start : r.char_start + r.n_chars].encode()) + 1 == r.tokens for r in ps)
    assert {d for d, ps in parts.items() if len(ps) > 1} == {d for d, t in texts.items() if d is not None and t is not None and len(t.encode()) + 1 > 100}
    assert len(load) <= sum(r.tokens for r in out) / 100 * 1.03 + 4
    assert packing.pack(df.limit(0), 100).count() == 0


# Leakage


def brute(docs, items):
    out = set()
    for d, t in docs:
        c = leakage.comparable(t)
        for i, x in items:
            y = leakage.comparable(x)
            if any(y[k : k + 40] in c for k in range(len(y) - 39)):
                out.add((d, i))
    return out


def test_leakage_against_brute_force(spark):
    rng = random.Random(11)
    say = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ,.ＡＢ１é") for _ in range(n))
    items = [(i, say(200)) for i in range(30)] + [(30, None), (31, ""), (32, "short"), (33, "z" * 45)]
    docs = []
    for d in range(150):
        t = say(300)
        if d % 3 == 0:
            x = items[rng.randrange(30)][1]
            n = rng.randint(30, 80)
            at = rng.randint(0, len(x) - n)
            t = t[:100] + x[at : at + n].upper() + t[100:]
        if d % 10 == 1:  # a substitution each 24 signs
            x = list(items[rng.randrange(30)][1])
            x[::24] = "#" * len(x[::24])
            t += "".join(x)
        docs.append((d, t))
    docs += [(500, None), (501, ""), (502, "z" * 3000), (0, docs[0][1])]
    dd = spark.createDataFrame([(*r, 5) for r in docs], "doc_id long, text string, item_id int")
    ii = spark.createDataFrame(items, "item_id long, item_text string")
    want = brute([x for x in docs if x[1]], [x for x in items if x[1]])
    a = leakage._overlaps_broadcast(dd.select("doc_id", "text").filter("text IS NOT NULL"), ii.filter("item_text IS NOT NULL"))
    b = leakage._overlaps_joined(dd.select("doc_id", "text").filter("text IS NOT NULL"), ii.filter("item_text IS NOT NULL"))
    for got in (a, b):
        assert {(r.doc_id, r.item_id) for r in got.filter("exact_run >= 40").collect()} == want
    best = {(r.doc_id, r.item_id): r.exact_run for r in leakage.overlaps(dd, ii).collect()}
    assert want <= set(best) and len(want) > 30
    assert leakage.overlaps(dd.limit(0), ii).count() == 0 and leakage.overlaps(dd, ii.limit(0)).count() == 0


def test_tolerant_overlap():
    doc, item = leakage.codes("xx" + "abcdefghij" * 6 + "yy"), leakage.codes("abcdefghij" * 3 + "Z" + "bcdefghij" + "abcdefghij" * 2)
    exact, tolerant, wrong, at, start = leakage.compare(doc, item, 2)
    assert exact == 30 and tolerant == 60 and wrong == 1 and (at, start) == (2, 0)
    assert leakage.compare(doc, item, 100) == (0, 0, 0, 0, 0)


def test_masks_miss_no_tolerant_overlap():
    """The fewest substitutions among n tokens that leave no window whole are more than a tenth, for n from 40 to 79; longer ones are made of these."""
    masks = [[x + k for x in (*leakage.SHARED, last) for k in range(leakage.BLOCK)] for last in leakage.LAST]
    states = 1 << max(leakage.SPANS)  # the last tokens, 1 where equal, the newest lowest
    hit = np.zeros(states, bool)
    for m in masks:
        bits = sum(1 << (m[-1] - k) for k in m)
        hit |= (np.arange(states) & bits) == bits
    cost = np.full(states, 999)
    cost[0] = 0
    for n in range(1, 80):
        half = np.minimum(cost[: states // 2], cost[states // 2 :])
        cost = np.column_stack([half + 1, half]).ravel()
        cost[hit] = 999
        assert n < 40 or cost.min() > n // 10


def test_tolerant_overlaps_against_brute_force(spark):
    """All pairs with a tolerant overlap of 40, found by both ways of probing; whole diagonals are compared for the truth."""
    rng = random.Random(12)
    say = lambda n: [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)]
    items = [(i, "".join(say(60))) for i in range(8)]
    docs = []
    for d in range(120):
        x = list(items[d % 8][1])
        at, n = (0, 40) if d % 3 == 0 else (20, 40) if d % 3 == 1 else (0, 60)
        for k in rng.sample(range(at + 1, at + n - 1), n // 10):
            x[k] = "9"
        docs.append((d, "".join(say(d % 7) + x[at : at + n] + say(d % 5))))
    best = lambda t, x: max(leakage.compare(leakage.codes(t), leakage.codes(x), s)[1] for s in range(-len(x), len(t)))
    want = {(d, i): n for d, t in docs for i, x in items if (n := best(t, x)) >= 40}
    assert len(want) >= 120
    dd, ii = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, item_text string")
    assert {(r.doc_id, r.item_id): r.tolerant_run for r in leakage.overlaps(dd, ii).collect()} == want
    assert {(r.doc_id, r.item_id) for r in leakage._overlaps_joined(dd, ii).collect()} == set(want)


def test_hot_keys_are_met_in_cells(spark):
    """A key with most of the rows gives each two of its items once, and no cell has many."""
    rows = [(i, 0 if i % 4 else i, i % 5) for i in range(400)] + [(1000 + i, 7777, i) for i in range(3)]
    df = spark.createDataFrame(rows, "item long, k long, size int")
    by = {}
    for i, k, s in rows:
        by.setdefault(k, []).append((i, s))
    want = {(a, b) for l in by.values() for a, s in l for b, t in l if a < b and s == t}
    for cell in (10, 1000):
        got = [(r.x["item"], r.y["item"]) for r in near_duplicates.meet(df, "k", "item", F.col("x.size") == F.col("y.size"), cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert near_duplicates.meet(df.limit(0), "k", "item").count() == 0


def test_pieces_of_large_documents_join_to_the_text(spark):
    texts = {1: "漢字テスト" * 50, 2: "é" * 101, 3: "a" * 99, 4: "a" * 100, 5: "😀漢a" * 40, 6: "x" * 98 + "😀" * 3}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {}
    for r in packing.pack(df, 100).collect():
        out.setdefault(r.doc_id, []).append(r)
    for d, t in texts.items():
        rows = sorted(out[d], key=lambda r: r.piece)
        assert [r.char_start for r in rows] == [sum(x.n_chars for x in rows[:i]) for i in range(len(rows))]
        assert sum(r.n_chars for r in rows) == len(t) and all(r.n_pieces == len(rows) for r in rows)
        assert all(r.tokens == len(t[r.char_start : r.char_start + r.n_chars].encode()) + 1 <= 100 for r in rows)
        # no piece could have taken the next character too
        assert all(len(t[r.char_start : r.char_start + r.n_chars + 1].encode()) + 1 > 100 for r in rows[:-1])


def test_exact_candidates_miss_no_pair(spark):
    """Texts of four signs only, so that all n-grams are frequent, with changes that leave pairs on both sides of the threshold."""
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(12):
        base = "".join(rng.choice(list("abcdefghijklmnop"), 220))
        for _ in range(6):
            t = list(base)
            for at in rng.integers(0, len(t), int(rng.integers(0, 14))):
                t[at] = str(rng.choice(list("abcdefghijklmnop")))
            texts.append("".join(t))
    sets = [set(near_duplicates.grams(t).tolist()) for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    df = spark.createDataFrame([(f"{i:03d}", None, t) for i, t in enumerate(texts)], "id string, instruction string, answer string")
    got = near_duplicates.pairs(*near_duplicates.links(df, "id", "instruction", "answer", exact=True)).collect()
    assert {(int(r.id_b), int(r.id_a)) for r in got} == want and 30 < len(want) < 180
