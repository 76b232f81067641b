"""Noise of scanning in page and block texts, found and repaired.

Edge lines (the journal's running header, the page's number) are removed by what the journal and the page are called. Words broken
over line ends are joined where the corpus has the joined word rather than the hyphenated one. Misread characters are found by
statistics over all texts. A word's anagram value is the sum of the fifth powers of its characters, so a confusion changes it by a
fixed difference wherever in the word it strikes. In SQL words are joined with frequent ones whose value lies a sum of known
differences away; known are the confusions of scanning that are listed here, and those that the corpus itself shows: differences
of one sign by which an unusual share of the frequent words has a rare variant. Ideographs have no words; each is taken with
its neighbours, and the value without the middle sign brings a form and its misread forms together. Corrections are ranked (by the
right form's frequency; confusions of ideographs by their contexts and their rate in them), and the best one of each rare form is applied.

Corrections never come to the driver: a bit table of fixed size goes to the texts, what it lets pass is joined with the corrections, and
all corrections of a text are applied to the same text at once.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.session import checkpoint

# Latin signs and pairs of signs that scanning confuses, in either direction.
CONFUSED = ("|1 |i |l 1i 1l il 0o ec tf hb 5s 9g qg 9q".split(), (("rn", "m"), ("cl", "d"), ("vv", "w"), ("ll", "b"), ("ll", "h"), ("li", "b"), ("li", "h")))
# The same confusions as what a sign counts for when two spellings are compared; single signs first, so that pairs of signs meet them in one form.
COUNTS_FOR = (("|", "l"), ("1", "l"), ("i", "l"), ("0", "o"), ("e", "c"), ("h", "b"), ("t", "f"), ("5", "s"), ("9", "g"), ("q", "g"), ("rn", "m"), ("cl", "d"), ("vv", "w"), ("ll", "b"))
#: A confusion of one sign for another is learned if so many words, and so great a share of the frequent words with that sign, have a rare variant by it; words of so many letters count.
LEARNED_WORDS, LEARNED_SHARE, LEARNED_LENGTH = 5, 0.05, 6
#: Letters of a word at least and at most that is corrected.
SHORTEST, WORD_LENGTH = 3, 64
#: A frequent form is at least so many times its rare variant; a word with a figure in it needs less.
WORD_RATIO, FIGURE_RATIO, SIGN_RATIO, KNOWN_RATIO = 12, 2, 12, 4
#: How far the rate of a confusion between two usual ideographs may lie from the common one, beside chance (three deviations).
RATE_SPREAD = 0.15
#: Bits of the table that tells which forms may have a correction. Its size is fixed (2 MB): with more corrections it lets more forms pass to the join.
BITS = 1 << 24

MARK = "-‐¬­"
_INVISIBLE = re.compile("[​-‏‪-‮⁠-⁤﻿]")
_BREAK = re.compile(rf"(?<![A-Za-zÀ-ɏ])([A-Za-zÀ-ɏ][A-Za-zÀ-ɏ0-9]*)[{MARK}](?:[ \t]*\r?\n\s*|[ \t]+)(?=([a-zß-ɏ][A-Za-zÀ-ɏ0-9]*))")
_MAY_BREAK = re.compile(rf"[{MARK}]\s")
# A word next to a letter of another alphabet is a part of a longer one.
_LATIN = re.compile(r"(?<![a-z0-9|À-ԯ])[a-z0-9|]*[a-z][a-z0-9|]*(?:-[a-z]+)*(?![a-z0-9|À-ԯ])")
_LATIN_ANY_CASE = re.compile(r"(?<![A-Za-z0-9|À-ԯ])[A-Za-z0-9|]*[A-Za-z][A-Za-z0-9|]*(?:-[A-Za-z]+)*(?![A-Za-z0-9|À-ԯ])")
_BESIDE = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789|-")
_UNREADABLE = re.compile(r"�|(?<=[^\s□■])[□■]|[□■](?=[^\s□■])")
_PAGE = re.compile(r"[-–—·•.|\[(<\s]*(?:第\s*|p(?:age|\.)?\s*)?(\d{1,5})(?:\s*页)?(?:\s*[,/·]?\s*(?:共|of|/)\s*\d+\s*页?)?[-–—·•.|\])>\s]*", re.I)
_AUTHORS = re.compile(r"(?:第\s*\d+\s*[期卷]\s*)?[一-鿿·]{2,12}\s*等\s*[:：]\s*\S.*[^。]|(?:No\.?\s*\d+\s+)?(?:[A-Z][\w.'’-]*\s+){1,4}et al\.?\s*:\s*\S.*[^.]")
_ISSUE = re.compile(r"(?:19|20)\d\d年?|第\d+[期卷]|\d+[年期卷]|(?:volume|vol|no|issue)\d+|\d+")
_SIGNS = re.compile(r"[\W_]+")

_HAN_LOW, _HAN_HIGH = 0x4E00, 0x9FFF


def core(line: str) -> str:
    return _SIGNS.sub("", unicodedata.normalize("NFKC", line).lower())


def is_header(line: str, name: str) -> bool:
    """Whether a line is a running header: the name (`core` of it) with nothing but volume, issue and year, or authors and a title."""
    if len(line) > 160:
        return False
    if _AUTHORS.fullmatch(line.strip()):
        return True
    if not name or len(line) > len(name) * 3 + 48:
        return False
    c = core(line)
    if name in c:
        rest = c.replace(name, "", 1)
    else:
        # one sign of the name may itself be misread
        bare = _ISSUE.sub("", c)
        if len(name) < 4 or len(bare) != len(name) or sum(a != b for a, b in zip(bare, name)) > 1:
            return False
        rest = ""
    return not _ISSUE.sub("", rest).strip("年月日期第卷")


def is_page_number(line: str, page: int) -> bool:
    if len(line) > 40:
        return False
    m = _PAGE.fullmatch(unicodedata.normalize("NFKC", line).strip())
    return bool(m) and int(m[1]) == page


def edge_lines(text: str, name: str, page: int | None, cover: bool) -> tuple[str, set[str]]:
    """The text without running headers and page numbers, and which there were."""
    kinds: set[str] = set()
    kept = []
    for line in text.split("\n"):
        bare = _INVISIBLE.sub("", line) if not line.isascii() else line
        if page is not None and len(bare) <= 40 and any(ch.isdigit() for ch in bare) and is_page_number(bare, page):
            kinds.add("pagenum")
        elif not cover and bare.strip() and is_header(bare, name):
            kinds.add("header")
        else:
            kept.append(line)
    return "\n".join(kept), kinds


def breaks(text: str) -> list[tuple[str, str]]:
    """(first part, second part) of every word broken by a mark and a line end or blank, lower case; a part that is itself broken again comes joined."""
    out = []
    held, end = "", -1
    for m in _BREAK.finditer(text):
        first, second = m[1].lower(), m[2].lower()
        held = (held + first) if m.start() == end and held else first
        out.append((held, second))
        end = m.end()
    return out


def _words(text: str) -> list[str]:
    return _LATIN.findall(text)


def _codes(texts: list[str]) -> np.ndarray:
    """Signs of all texts, in a row: figures alike and Latin letters alike, texts parted."""
    code = np.frombuffer(("\x00" + "\x00\x00".join(texts) + "\x00").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    code = np.where((code >= 48) & (code <= 57), 48, code)
    code = np.where(((code >= 65) & (code <= 90)) | ((code >= 97) & (code <= 122)), 97, code)
    return code


def _triples(code: np.ndarray) -> np.ndarray:
    """Codes of every ideograph with its two neighbours."""
    mid = code[1:-1]
    at = np.flatnonzero((mid >= _HAN_LOW) & (mid <= _HAN_HIGH))
    return (code[at] << 42) | (code[at + 1] << 21) | code[at + 2]


def _joined(text: str) -> str:
    return _BREAK.sub(r"\1", text)


def _light(text: str) -> str:
    """Text without signs of no width; full-width letters and figures as usual ones."""
    if text.isascii():
        return text
    text = _INVISIBLE.sub("", text)
    return unicodedata.normalize("NFKC", text) if re.search("[０-ｚ]", text) else text


def _statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts over a task's texts: 'w' words, 'h' broken words, 'j' words that are whole when joined, 't' ideographs with neighbours."""
    words: Counter = Counter()
    broken: Counter = Counter()
    joined: Counter = Counter()
    seen: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def merge() -> None:
        nonlocal seen, held
        if len(seen) > 1:
            key = np.concatenate([k for k, _ in seen])
            n = np.concatenate([c for _, c in seen])
            u, at = np.unique(key, return_inverse=True)
            seen = [(u, np.bincount(at, weights=n).astype(np.int64))]
        held = sum(len(k) for k, _ in seen)

    def rows() -> Iterator[pd.DataFrame]:
        merge()
        for kind, counter in (("w", words), ("h", broken), ("j", joined)):
            if counter:
                yield pd.DataFrame({"kind": kind, "word": list(counter), "sign": 0, "n": list(counter.values())})
        for key, n in seen:
            yield pd.DataFrame({"kind": "t", "word": None, "sign": key, "n": n})

    for b in batches:
        texts = []
        for text, name, page, cover in zip(b["text"], b["name"], b["page"], b["cover"]):
            text, _ = edge_lines(_light(text), name or "", page, cover)
            rest, cut = text, fragments(text)
            if cut:
                for first, second in breaks(text):
                    broken[f"{first}\t{second}"] += 1
                for a, z in reversed(cut):  # the parts of a broken word are no words
                    joined.update(_words(_joined(text[a:z]).lower()))
                    rest = f"{rest[:a]}\x00{rest[z:]}"
            words.update(_words(rest.lower()))
            texts.append(text)
        seen.append(np.unique(_triples(_codes(texts)), return_counts=True))
        held += len(seen[-1][0])
        if held > 2_000_000:
            merge()
        if held > 1_500_000 or len(words) > 1_000_000:  # a task's counts stay bounded; what is counted twice is added up later
            yield from rows()
            words.clear()
            broken.clear()
            joined.clear()
            seen, held = [], 0
    yield from rows()


def statistics(records: DataFrame) -> DataFrame:
    raw = records.select("text", "name", "page", "cover").mapInPandas(_statistics, "kind string, word string, sign bigint, n bigint")
    return checkpoint(raw.groupBy("kind", "word", "sign").agg(F.sum("n").alias("n")))


def anagram(word: F.Column) -> F.Column:
    """Sum of the fifth powers of a word's signs, in the JVM; exact for words of WORD_LENGTH Latin signs."""
    return F.aggregate(F.transform(F.split(word, ""), lambda c: F.pow(F.ascii(c).cast("double"), F.lit(5.0)).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x)


def known_words(stats: DataFrame) -> DataFrame:
    """(word, n, value): the Latin words of the texts with their anagram values."""
    w = stats.filter("kind IN ('w', 'j')").filter(F.length("word").between(SHORTEST, WORD_LENGTH)).groupBy("word").agg(F.sum("n").alias("n"))
    return w.withColumn("value", anagram(F.col("word")))


def _is_right() -> F.Column:
    return (F.col("n") >= 3) & ~F.col("word").rlike("[0-9|]")


def confusions(words: DataFrame) -> DataFrame:
    """(read, stands): the listed confusions, and those of one sign for another that the words show.

    Words and frequent words meet on their value without one sign (and their length); a step of one between them names the confusion. It is learned if the frequent
    words that have a rare variant by it are LEARNED_SHARE of all frequent words with that sign, and LEARNED_WORDS at least; both hold alike in small and large corpora.
    """
    long = words.filter(F.length("word") >= LEARNED_LENGTH)
    sign = F.explode(F.array_distinct(F.split("word", "")))
    less = F.col("value") - F.pow(F.ascii("sign").cast("double"), F.lit(5.0)).cast("bigint")
    rare = long.select("word", "n", "value", sign.alias("sign")).select(F.col("word").alias("wrong"), "n", F.col("sign").alias("read"), less.alias("rest"), F.length("word").alias("size"))
    often = long.filter(_is_right() & (F.col("n") >= WORD_RATIO)).select("word", "n", "value", sign.alias("sign")).select(F.col("word").alias("right"), F.col("n").alias("m"), F.col("sign").alias("stands"), less.alias("rest"), F.length("word").alias("size"))
    near = rare.join(often, ["rest", "size"]).filter((F.col("read") != F.col("stands")) & (F.col("m") >= F.col("n") * WORD_RATIO)).filter(F.levenshtein("wrong", "right") == 1)
    seen = near.groupBy("read", "stands").agg(F.count_distinct("right").alias("seen"))
    of = often.groupBy("stands").agg(F.count("*").alias("of"))
    learned = seen.join(of, "stands").filter((F.col("seen") >= LEARNED_WORDS) & (F.col("seen") >= F.col("of") * LEARNED_SHARE)).select("read", "stands")
    pairs = [(p[0], p[1]) for p in CONFUSED[0]] + list(CONFUSED[1])
    listed = words.sparkSession.createDataFrame([*pairs, *((b, a) for a, b in pairs)], "read string, stands string")
    return listed.unionByName(learned).distinct()


def word_corrections(words: DataFrame, known: DataFrame) -> DataFrame:
    """(wrong, right): words and the frequent word that they are read for; the most frequent one where there are several.

    A word of value v is joined with the frequent words of value v less the differences of up to four confusions (two taken off the word, two put on the frequent one). A value knows no order of
    signs, and several differences may add up to that of other signs, so the spellings are then compared: they are one step apart, or the same with all listed confusions undone.
    """

    def undone(c: F.Column) -> F.Column:
        for read, stands in COUNTS_FOR:
            c = F.replace(c, F.lit(read), F.lit(stands))
        return c

    d = known.withColumn("d", anagram(F.col("read")) - anagram(F.col("stands"))).withColumn("cost", F.greatest(F.length("read"), F.length("stands")))
    # The confusions of a few dozen signs are a few hundred rows: one array that goes with each word.
    table = d.agg(F.sort_array(F.collect_list(F.struct("read", "stands", "d", "cost"))).alias("table"))

    def steps(side: DataFrame, of: str, sign: int) -> DataFrame:
        fits = F.filter("table", lambda t: F.contains(F.col("word"), t[of]))
        one = F.transform(fits, lambda t: F.struct((t["d"] * sign).alias("d"), t["cost"].alias("cost")))
        two = F.flatten(F.transform(one, lambda x: F.transform(one, lambda y: F.struct((x["d"] + y["d"]).alias("d"), (x["cost"] + y["cost"]).alias("cost")))))
        none = F.array(F.struct(F.lit(0).cast("bigint").alias("d"), F.lit(0).alias("cost")))
        every = F.explode(F.array_distinct(F.concat(none, one, two))).alias("step")
        got = side.crossJoin(F.broadcast(table)).select("word", "n", "value", every)  # the table is one row
        return got.groupBy("word", "n", (F.col("value") + F.col("step.d")).alias("at")).agg(F.min("step.cost").alias("cost"))

    wrong = steps(words, "read", -1).select(F.col("word").alias("wrong"), "n", "at", "cost")
    right = steps(words.filter(_is_right()), "stands", 1).select(F.col("word").alias("right"), F.col("n").alias("m"), "at", F.col("cost").alias("more"))
    got = wrong.join(right, "at").filter((F.col("wrong") != F.col("right")) & (F.col("m") >= F.col("n") * F.when(F.col("wrong").rlike("[0-9|]"), FIGURE_RATIO).otherwise(WORD_RATIO)))
    got = got.filter(((F.col("cost") + F.col("more") == 1) & (F.levenshtein("wrong", "right") == 1)) | (undone(F.col("wrong")) == undone(F.col("right"))))
    return got.groupBy("wrong").agg(F.max_by("right", F.struct("m", "right")).alias("right"))


def sign_corrections(stats: DataFrame) -> DataFrame:
    """(sign, right): ideographs in their neighbours' company that are read for another one; without neighbours (`sign` holds the middle only) those that are hardly ever right.

    The value of a form is that of its three signs by place; less its middle it is that of its surroundings, in which the frequent form and its rare ones meet.
    A pair (read, right) counts as a confusion if the read form is seen hardly anywhere else, or if it turns up in several of the right form's contexts at the rate at which scanning
    strikes, which the pairs of the first sort tell; two signs that both belong somewhere share few contexts, at other rates.
    """
    t = stats.filter("kind = 't'").select("sign", "n")
    mask = (1 << 21) - 1
    t = t.withColumn("mid", F.shiftright("sign", 21).bitwiseAND(F.lit(mask))).withColumn("around", F.col("sign") - F.shiftleft("mid", 21))
    own = W.partitionBy("around")
    # The frequent form of each context comes with its rare ones in one shuffle: no pairs are made.
    best = t.withColumn("top", F.max(F.struct("n", "mid")).over(own)).filter((F.col("top.n") >= F.col("n") * KNOWN_RATIO) & (F.col("top.n") >= 4) & (F.col("top.mid") != F.col("mid")))
    near = best.select("sign", "mid", "n", F.col("top.mid").alias("right"), F.col("top.n").alias("m"))
    totals = t.groupBy("mid").agg(F.sum("n").alias("total"))
    strong = F.col("m") >= F.col("n") * SIGN_RATIO
    pair = near.groupBy("mid", "right").agg(F.count(F.when(strong, 1)).alias("contexts"), F.sum(F.when(strong, F.col("m")).otherwise(0)).alias("mass"), F.sum(F.when(strong, F.col("n")).otherwise(0)).alias("seen"), F.count_distinct(F.when(strong, F.shiftright("sign", 42))).alias("lefts"), F.count_distinct(F.when(strong, F.col("sign").bitwiseAND(F.lit(mask)))).alias("rights"), F.max(F.shiftright("sign", 42)).alias("left"), F.max(F.col("sign").bitwiseAND(F.lit(mask))).alias("beside"))
    pair = pair.join(totals.withColumnRenamed("total", "total_read"), "mid").join(totals.select(F.col("mid").alias("right"), F.col("total").alias("total_right")), "right")
    # What is alike in all contexts must be an ideograph of the same word, not the start of a line or a stop.
    han = lambda c: F.col(c).between(_HAN_LOW, _HAN_HIGH)
    fits = ((F.col("lefts") >= 2) | han("left")) & ((F.col("rights") >= 2) | han("beside"))
    share, rate = F.col("seen") / F.col("total_read"), F.col("seen") / F.col("mass")
    # Scanning strikes a few characters in a thousand, everywhere alike: what stands in a form's contexts more or less often is a word of its own.
    pair = checkpoint(pair)
    common = pair.filter((share >= 0.9) & (F.col("seen") >= 3) & (F.col("contexts") >= 2)).agg((F.sum("seen") / F.sum("mass")).alias("common"))
    pair = pair.crossJoin(F.broadcast(common))  # one row
    due = F.col("common") * F.col("mass")
    usual = F.coalesce(F.abs(F.col("seen") - due) <= due * RATE_SPREAD + 3 * F.sqrt(due), F.lit(True))
    known = pair.filter((F.col("total_right") >= 20) & (((F.col("contexts") >= 3) & fits & (rate <= 0.02) & usual) | ((F.col("contexts") >= 2) & (share >= 0.4)) | (share >= 0.7)))
    known = known.select("mid", "right", (share >= 0.4).alias("alone"), ((share >= 0.9) & (F.col("seen") >= 3)).alias("always"))
    got = near.join(known, ["mid", "right"]).filter(F.col("alone") | (F.col("m") >= F.col("n") * SIGN_RATIO))
    # A sign that is hardly ever right is wrong in a context of its own too; it goes without neighbours.
    lone = known.filter("always").groupBy("mid").agg(F.max("right").alias("right")).select(F.shiftleft("mid", 21).alias("sign"), "right")
    return got.groupBy("sign").agg(F.max_by("right", F.struct("m", "right")).alias("right")).unionByName(lone)


def kept_hyphens(stats: DataFrame) -> DataFrame:
    """(first, second) of broken words whose mark is the word's own: the hyphenated word is known better than the joined one, or the parts are words of a shared ending."""
    h = stats.filter("kind = 'h'").select(F.split("word", "\t")[0].alias("first"), F.split("word", "\t")[1].alias("second"))
    w = stats.filter("kind = 'w'").select("word", "n")
    count = lambda name: w.select(F.col("word").alias(f"_{name}"), F.col("n").alias(f"n_{name}"))
    h = h.withColumn("_joined", F.concat("first", "second")).withColumn("_own", F.concat_ws("-", "first", "second")).withColumn("_second", F.col("second")).withColumn("_first", F.col("first"))
    for name in ("joined", "own", "first", "second"):
        h = h.join(count(name), f"_{name}", "left").fillna(0, [f"n_{name}"])
    own = (F.col("n_own") > F.col("n_joined")) | ((F.col("n_joined") == 0) & F.col("second").isin("and", "or", "to", "und", "oder", "et", "ou", "bis"))
    both = (F.col("n_joined") == 0) & (F.col("n_first") >= 20) & (F.col("n_second") >= 20)
    return h.filter(own | both).select("first", "second").distinct()


def corrections(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(what the texts are joined with: kind, form, right; ideographs that are wrong wherever they stand: sign, right). Kinds: 'w' a word, 's' an ideograph with its neighbours, 'h' a break whose mark is the word's own."""
    words = checkpoint(known_words(stats))
    w = word_corrections(words, confusions(words)).select(F.lit("w").alias("kind"), F.col("wrong").alias("form"), "right")
    signs = checkpoint(sign_corrections(stats))
    s = signs.filter(F.col("sign") >= 1 << 42).select(F.lit("s").alias("kind"), F.col("sign").cast("string").alias("form"), F.col("right").cast("string").alias("right"))
    h = kept_hyphens(stats).select(F.lit("h").alias("kind"), F.concat_ws("\t", "first", "second").alias("form"), F.lit("").alias("right"))
    return checkpoint(w.unionByName(s).unionByName(h)), signs.filter(F.col("sign") < 1 << 42)


def _slots(forms: list[str], size: int) -> np.ndarray:
    return (pd.util.hash_array(np.array(forms, dtype=object)) & np.uint64(size - 1)).astype(np.int64)


def _sign_slots(signs: np.ndarray, size: int) -> np.ndarray:
    return ((signs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) & (size - 1)


def _table_slots(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sign = (b["kind"] == "s").to_numpy()
            slot = np.zeros(len(b), dtype=np.int64)
            if sign.any():
                slot[sign] = _sign_slots(b["form"][sign].astype("int64").to_numpy(), size)
            if not sign.all():
                slot[~sign] = _slots(b["form"][~sign].tolist(), size)
            yield pd.DataFrame({"slot": slot + 1})  # buckets of bits are counted from 1

    return run


class Screen:
    """What goes to every text: the bits of all forms that have a correction, and the ideographs that are wrong anywhere (at most as many as there are ideographs)."""

    def __init__(self, bits: bytes, lone: dict[int, int]):
        self.bits = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), bitorder="little").view(bool)
        self.lone = lone
        self.alone = np.zeros(1 << 16, dtype=bool)
        self.alone[list(lone)] = True

    def words(self, forms: set[str]) -> set[str]:
        forms = list(forms)
        return {f for f, hit in zip(forms, self.bits[_slots(forms, len(self.bits))].tolist()) if hit} if forms else set()

    def signs(self, texts: list[str]) -> tuple[list[set], list[bool]]:
        """For each text its ideographs with neighbours that the bits let pass, and whether one is wrong anywhere."""
        out: list[set] = [set() for _ in texts]
        always = [False] * len(texts)
        if texts:
            code = _codes(texts)
            mid = code[1:-1]
            at = np.flatnonzero((mid >= _HAN_LOW) & (mid <= _HAN_HIGH))
            key = (code[at] << 42) | (code[at + 1] << 21) | code[at + 2]
            owner = np.cumsum(code == 0) // 2
            hit = np.flatnonzero(self.bits[_sign_slots(key, len(self.bits))])
            for o, k in zip(owner[at[hit]].tolist(), key[hit].tolist()):
                out[o].add(k)
            for o in np.unique(owner[at[self.alone[mid[at]]]]).tolist():
                always[o] = True
        return out, always


def _screen(table: DataFrame, lone: DataFrame, size: int) -> tuple[bytes, dict[int, int]]:
    """What a Screen is made of. The bits are put together in buckets of 4 KB by the cluster; size / 8 bytes at most come to the driver."""
    slots = table.select("kind", "form").mapInPandas(_table_slots(size), "slot bigint").distinct()
    buckets = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    bits = bytearray(size // 8)
    for r in buckets:
        bits[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = r["bits"]
    return bytes(bits), {int(r["sign"]) >> 21: int(r["right"]) for r in lone.collect()}


def fragments(text: str) -> list[tuple[int, int]]:
    """Stretches of a text that hold broken words, with all that a word around the breaks may reach over."""
    out: list[tuple[int, int]] = []
    if not _MAY_BREAK.search(text):
        return out
    for m in _BREAK.finditer(text):
        a, z = m.start(), m.end(2)
        while a and text[a - 1] in _BESIDE:
            a -= 1
        while z < len(text) and text[z] in _BESIDE:
            z += 1
        if out and a < out[-1][1]:
            a = out.pop()[0]
        out.append((a, z))
    return out


def _parted(fragment: str) -> tuple[set[str], set[str]]:
    """(words, breaks) of a fragment: every word that it may hold, whichever of its breaks are joined."""
    found, pieces, last = set(), [], 0
    pairs = set()
    for m in _BREAK.finditer(fragment):
        pieces.append(fragment[last : m.end(1)])
        pairs.add(f"{m[1].lower()}\t{m[2].lower()}")
        last = m.end()
    pieces.append(fragment[last:])
    for i in range(len(pieces)):
        joined = ""
        for p in pieces[i:]:
            joined += p
            found.update(_words(joined.lower()))
            if len(joined) - len(pieces[i]) > WORD_LENGTH:  # no word that long is corrected, and words beside it are found with the last part alone
                break
    return found, pairs


_FIRST = "k1 bigint, k2 bigint, rec string, rec_uid bigint, part string, kinds array<string>, breaks array<string>, forms array<struct<kind:string,form:string,broken:boolean>>"


def _find(shared, every: bool):
    """For each text that may have noise (`every`: for any that may have a correction): the kinds that need no correction, its fragments with breaks, and the forms that may have one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        screen = Screen(*shared.value)
        for b in batches:
            texts, kinds, pieces, words, broken, pairs = [], [], [], [], [], []
            for text, name, page, cover in zip(b["text"], b["name"], b["page"], b["cover"]):
                text, k = edge_lines(_light(text), name or "", page, cover)
                if _UNREADABLE.search(text):
                    k.add("misread")
                spans = fragments(text)
                inside: set[str] = set()
                two: set[str] = set()
                rest = text
                if spans:
                    for a, z in reversed(spans):
                        found, at = _parted(text[a:z])
                        inside |= found
                        two |= at
                        rest = f"{rest[:a]}\x00{rest[z:]}"
                texts.append(text)
                kinds.append(k)
                pieces.append([text[a:z] for a, z in spans])
                words.append(set(_words(rest.lower())))
                broken.append(inside)
                pairs.append(two)
            maybe = screen.words(set().union(*words, *broken, *pairs))
            signs, always = screen.signs(texts)
            rows = []
            for i, k in enumerate(kinds):
                if always[i]:
                    k.add("misread")
                forms = [("s", str(s), False) for s in signs[i]] + [("w", w, False) for w in words[i] & maybe] + [("w", w, True) for w in broken[i] & maybe] + [("h", p, True) for p in pairs[i] & maybe]
                if forms or not every and (k or pieces[i]):
                    rows.append((b["k1"].iloc[i], b["k2"].iloc[i], b["rec"].iloc[i], b["rec_uid"].iloc[i], b["part"].iloc[i], sorted(k), pieces[i], [dict(zip(("kind", "form", "broken"), f)) for f in forms]))
            yield pd.DataFrame(rows, columns=["k1", "k2", "rec", "rec_uid", "part", "kinds", "breaks", "forms"])

    return run


def _join_breaks(text: str, own: set[str]) -> tuple[str, bool]:
    """The text with its broken words joined unless the mark is the word's own, and whether there were any."""
    joined = False

    def one(m: re.Match) -> str:
        nonlocal joined
        if f"{m[1].lower()}\t{m[2].lower()}" in own:
            return m[0]
        joined = True
        return m[1]

    return (_BREAK.sub(one, text), joined) if _MAY_BREAK.search(text) else (text, False)


NOISE = "rec string, rec_uid bigint, part string, kinds array<string>"


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Kinds of each text from what was found in it and which forms do have a correction."""
    for b in batches:
        out = []
        for kinds, pieces, known in zip(b["kinds"], b["breaks"], b["known"]):
            k = set(kinds)
            own = {x["form"] for x in known if x["kind"] == "h"}
            inside = {x["form"] for x in known if x["kind"] == "w" and x["broken"]}
            if any(x["kind"] == "s" or x["kind"] == "w" and not x["broken"] for x in known):
                k.add("misread")
            for p in pieces:
                text, joined = _join_breaks(p, own)
                if joined:
                    k.add("hyphen")
                if inside and inside.intersection(_words(text.lower())):
                    k.add("misread")
            out.append(sorted(k))
        b["kinds"] = out
        yield b.loc[[bool(k) for k in out], ["rec", "rec_uid", "part", "kinds"]]


def _repaired(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, lone = shared.value
        for b in batches:
            texts, all_kinds = [], []
            for text, name, page, cover, known in zip(b["text"], b["name"], b["page"], b["cover"], b["known"]):
                text, k = edge_lines(_light(text), name or "", page, cover)
                if _UNREADABLE.search(text):
                    k.add("misread")
                known = [] if known is None else known
                text, joined = _join_breaks(text, {x["form"] for x in known if x["kind"] == "h"})
                if joined:
                    k.add("hyphen")
                signs = {int(x["form"]): int(x["right"]) for x in known if x["kind"] == "s"}
                if signs or lone:
                    turned = _repair_signs(text, signs, lone)
                    if turned != text:
                        k.add("misread")
                        text = turned
                words = {x["form"]: x["right"] for x in known if x["kind"] == "w"}
                if words:
                    turned = _LATIN_ANY_CASE.sub(lambda m: _in_case(words[m[0].lower()], m[0]) if m[0].lower() in words else m[0], text)
                    if turned != text:
                        k.add("misread")
                        text = turned
                texts.append(paragraphs(text))
                all_kinds.append(sorted(k))
            b["text"], b["kinds"] = texts, all_kinds
            yield b[["rec", "rec_uid", "part", "kinds", "text"]]

    return run


def _in_case(word: str, like: str) -> str:
    return word.upper() if len(like) > 1 and like.isupper() else word.capitalize() if like[:1].isupper() else word


def _repair_signs(text: str, wrong: dict[int, int], lone: dict[int, int]) -> str:
    """All wrong ideographs of the text replaced at once: a neighbour that is itself wrong counts as it was read."""
    if not wrong and not any(ord(c) in lone for c in text):
        return text
    out = list(text)
    signs = f"\x00{text}\x00"
    flat = lambda c: 48 if "0" <= c <= "9" else 97 if c.isascii() and c.isalpha() else ord(c)
    for i, (a, b, c) in enumerate(zip(signs, signs[1:], signs[2:])):
        if "一" <= b <= "鿿":
            right = wrong.get((flat(a) << 42) | (ord(b) << 21) | flat(c), lone.get(ord(b)))
            if right is not None:
                out[i] = chr(right)
    return "".join(out)


def paragraphs(text: str) -> str:
    """Hard line ends taken out: a line goes on in the next one unless it ends a sentence, is a list or table line, or a short line like a heading."""
    out = ""
    for line in text.split("\n"):
        line = line.strip()
        if not line:
            continue
        if not out:
            out = line
            continue
        last = out.rsplit("\n", 1)[-1]
        ends = last[-1] in "。！？!?；;：:”）)" or (last[-1] == "." and not last[-2:-1].isdigit())
        starts = re.match(r"[\s]*(?:[-*+•·|#>]|\d+[)）.]|[（(]\d|\[\d|图\s*\d|表\s*\d|Fig\.|Table|Abstract|摘要|关键词)", line)
        full = len(last) >= 20 or last[-1] in "，,、"
        if ends or starts or not full or re.fullmatch(r"[^。，,]*(?:\s\d[\d.]*){2,}", last):
            out += "\n" + line
        elif last[-1].isascii() and last[-1].isalnum() and line[0].isascii() and line[0].isalnum():
            out += " " + line
        else:
            out += line
    return out


def _prepared(records: DataFrame) -> DataFrame:
    rows = records.filter("text <> ''").select("rec", F.col("rec_uid").cast("bigint").alias("rec_uid"), "part", "text", "name", F.col("page").cast("int").alias("page"), F.coalesce("cover", F.lit(False)).alias("cover"))
    every = ["rec", "rec_uid", "part", "text", "name", "page", "cover"]
    return rows.withColumn("k1", F.xxhash64(*every)).withColumn("k2", F.xxhash64(F.lit(1), *reversed(every)))


def _known(rows: DataFrame, every: bool, bits: int) -> tuple[DataFrame, object]:
    """(found rows of `_find` with the corrections that their forms have, what was broadcast). Equal texts of one record come once."""
    table, lone = corrections(statistics(rows))
    shared = rows.sparkSession.sparkContext.broadcast(_screen(table, lone, bits))
    first = rows.mapInPandas(_find(shared, every), _FIRST)
    each = first.select("*", F.explode_outer("forms").alias("x")).select("k1", "k2", "rec", "rec_uid", "part", "kinds", "breaks", "x.*")
    j = each.join(table.withColumnRenamed("right", "_right"), ["kind", "form"], "left")
    known = F.collect_set(F.when(F.col("_right").isNotNull(), F.struct("kind", "form", "broken", F.col("_right").alias("right")))).alias("known")
    return j.groupBy("k1", "k2", "rec", "rec_uid", "part").agg(F.first("kinds").alias("kinds"), F.first("breaks").alias("breaks"), known), shared


def noise(records: DataFrame, bits: int = BITS) -> DataFrame:
    """(rec, rec_uid, part, kinds): what noise each record has; records without any give no row, equal rows come once. Input and NULLs as in `repair`."""
    found, _ = _known(_prepared(records), False, bits)
    return found.select("rec", "rec_uid", "part", "kinds", "breaks", "known").mapInPandas(_judge, NOISE)


def repair(records: DataFrame, bits: int = BITS) -> DataFrame:
    """(rec, rec_uid, part, kinds, text): what noise each record has, and its text as continuous paragraphs.

    `records`: rec, rec_uid, part, text, name (journal), page (number), cover (whether it is a cover, whose title is no header).
    NULL and empty texts give no row; a NULL name or page means that no header or page number can be told; repeated rows come again.
    `bits` (a power of two, 2^15 at least) is the size of the bit table; it changes the work, never the rows.
    """
    rows = _prepared(records)
    found, shared = _known(rows, True, bits)
    fixes = found.select("k1", "k2", "known").filter(F.size("known") > 0)
    return rows.join(fixes, ["k1", "k2"], "left").drop("k1", "k2").mapInPandas(_repaired(shared), "rec string, rec_uid bigint, part string, kinds array<string>, text string")


MAX_JOURNALS = 200_000


def records(pages: DataFrame, blocks: DataFrame, journals: DataFrame) -> DataFrame:
    """The records of `repair` from the page, block and journal tables. Repeated deliveries of a key come again: results are told apart by key, and a text more in a hundred changes no statistic.

    Blocks take their journal's name and covers by journal_id; that side has one short row per journal and is broadcast while its count is checked to be small.
    """
    name = F.regexp_replace(F.lower("journal_name"), r"[^\p{L}\p{N}]+", "")
    both = F.explode(F.array(F.struct(F.lit("full_text").alias("part"), F.col("full_text").alias("text")), F.struct(F.lit("visible_text").alias("part"), F.col("visible_text").alias("text"))))
    of_pages = pages.select(F.lit("page").alias("rec"), F.col("page_uid").alias("rec_uid"), both.alias("x"), name.alias("name"), F.col("page_index").alias("page"), (F.col("page_type") == "cover").alias("cover")).select("rec", "rec_uid", "x.part", "x.text", "name", "page", "cover")
    covers = pages.filter("page_type = 'cover'").groupBy("journal_id").agg(F.collect_set("page_index").alias("covers"))
    meta = journals.groupBy("journal_id").agg(F.min("journal_name").alias("journal_name")).select(F.col("journal_id"), name.alias("name")).join(covers, "journal_id", "left")
    small = journals.select("journal_id").count() <= MAX_JOURNALS
    body = blocks.filter(~F.coalesce(F.col("block_type"), F.lit("")).isin("header", "footer", "page_number"))
    of_blocks = body.join(F.broadcast(meta) if small else meta, "journal_id", "left").select(F.lit("block").alias("rec"), F.col("block_uid").alias("rec_uid"), F.lit("text").alias("part"), "text", "name", F.col("page_index").alias("page"), (F.array_contains("covers", F.col("page_index")) | (F.col("block_type") == "title")).alias("cover"))
    return of_pages.unionByName(of_blocks)
