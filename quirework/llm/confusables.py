"""Text that looks usual but holds other characters, brought to one form.

The scripts of a token's letters are intersected (Han, kana and Hangul share the sets of the writing systems that mix
them; common and inherited signs fit any). An empty intersection is a mixed token: it takes the spelling of the one script
into which all letters of the others can be turned by the confusables table. A token wholly in one script whose every letter
has a Latin double is a whole-script confusable if the Latin spelling is a word of the same table while the text has no
further letter of the token's script. Other forms are plain: full-width letters and digits, separate combining marks, characters
without width, blanks, presentation forms and radicals.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.session import checkpoint

# Letters of other scripts that look like Latin ones.
CYRILLIC_LATIN = dict(zip("асеԁһіјӏкорԛѕтухуѵԝзАВСЕНІЈКМОРЅТУХҮ", "acedhijlkopqstuxyvwзABCEHIJKMOPSTYXY"))
CYRILLIC_LATIN = {a: b for a, b in CYRILLIC_LATIN.items() if b.isascii()}
CYRILLIC_LATIN["у"] = "y"
GREEK_LATIN = dict(zip("ονικραυγχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ovikpauyxABEZHIKMNOPTYX"))
ARMENIAN_LATIN = dict(zip("օսոհցքՕՍԼ", "ounhgqOUL"))
OTHER_LATIN = {"ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʋ": "v", "ⅼ": "l"}
CHEROKEE_LATIN = dict(zip("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᏀᏃᏏᏒᏔᏚᏙᏞᏟᏢᏦᏴ", "DRTiAJEWMHGZbRWSVLCPKB"))
COPTIC_LATIN = dict(zip("ⲞⲟⲢⲣⲤⲥⲎⲒⲔⲘⲚⲦⲬ", "OoPpCcHIKMNTX"))
LISU_LATIN = dict(zip("ꓐꓑꓒꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPdDTGKJCZFMNLSRVHWXYAEIOU"))
# Kana and signs that look like ideographs.
KANA_HAN = dict(zip("ロエカニトタハミオチリヒーノ", "口工力二卜夕八三才千刂匕一丿"))
SYMBOLS = frozenset("μµΩΔαβγδθλπσφωηρτε")

_WIDTH = re.compile(r"[０-９Ａ-Ｚａ-ｚ]")
_INVISIBLE = re.compile(r"[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e0fff]")
_SPACE = re.compile(r"[\t\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000]")
_WORD = re.compile(r"[^\W\d_]+(?:[^\W\d_]|[\u0300-\u036f])*")
#: Rows without any of these need no look: everything else is usual here.
UNUSUAL = r"[^\x00-\x08\x0a-\x7f\u4e00-\u9fff，。：；、（）《》？！“”‘’·℃…—μΩ●□■�]|\t"

CASES = "rec string, rec_uid bigint, field_name string, text string, disguises array<string>, doubtful array<string>"


@lru_cache(maxsize=65536)
def script(ch: str) -> str:
    """Script of a letter, by its Unicode name; 'COMMON' for anything else."""
    if not (ch.isalpha() or unicodedata.category(ch)[0] == "M"):
        return "COMMON"
    first = unicodedata.name(ch, "COMMON").split()[0].split("-")[0]
    return {"COMBINING": "COMMON", "KANGXI": "CJK", "MICRO": "COMMON", "OHM": "COMMON", "IDEOGRAPHIC": "CJK", "MODIFIER": "COMMON", "MASCULINE": "LATIN", "FEMININE": "LATIN"}.get(first, first)


@lru_cache(maxsize=65536)
def resolved(ch: str) -> frozenset | None:
    """Writing systems that use `ch`; None for all."""
    s = script(ch)
    if s == "COMMON" or ch in SYMBOLS:
        return None
    return {"CJK": frozenset({"CJK", "JAPANESE", "KOREAN"}), "HIRAGANA": frozenset({"JAPANESE"}), "KATAKANA": frozenset({"JAPANESE"}), "HANGUL": frozenset({"KOREAN"})}.get(s, frozenset({s}))


def _latin(ch: str) -> str | None:
    """The Latin spelling of a letter; None if it has none."""
    if script(ch) == "LATIN" and ch not in OTHER_LATIN:
        return ch
    for t in (CYRILLIC_LATIN, GREEK_LATIN, ARMENIAN_LATIN, CHEROKEE_LATIN, COPTIC_LATIN, LISU_LATIN, OTHER_LATIN):
        if ch in t:
            return t[ch]
    return None


_FROM_LATIN = {s: {v: k for k, v in t.items()} for s, t in (("CYRILLIC", CYRILLIC_LATIN), ("GREEK", GREEK_LATIN))}


def consistent(token: str) -> str | None:
    """The spelling of a mixed token in one script; None if the token isn't mixed or can't be resolved."""
    common: frozenset | None = None
    for ch in token:
        r = resolved(ch)
        if r is not None:
            common = r if common is None else common & r
    if common is None or common:
        return None
    letters = [c for c in token if resolved(c) is not None]
    if len({script(c) for c in letters}) < 2:
        return None
    latin = [c if resolved(c) is None else _latin(c) for c in token]
    if all(latin) and any(script(c) == "LATIN" for c in letters):
        return "".join(latin)
    for s, table in _FROM_LATIN.items():
        if any(script(c) == s for c in letters):
            other = [c if resolved(c) is None or script(c) == s else table.get(c) for c in token]
            if all(other):
                return "".join(other)
    return None


def skeleton(token: str) -> str | None:
    """The Latin double of a token wholly in one other script, of two letters and more; None if there is none."""
    letters = [c for c in token if c.isalpha()]
    if len(letters) < 2 or any(c in SYMBOLS for c in letters) or len(s := {script(c) for c in letters}) != 1 or s & {"LATIN", "CJK", "HIRAGANA", "KATAKANA", "HANGUL"}:
        return None
    latin = [_latin(c) for c in letters]
    return "".join(latin) if all(latin) else None


def _forms(text: str) -> tuple[str, bool]:
    """Presentation forms, radicals and other compatibility letters replaced; whether there were any. Signs, digits, units and circled numbers stay."""
    out, any_ = [], False
    for ch in text:
        if ord(ch) > 0x7F and not ("\uff00" <= ch <= "\uffef") and not "\u4e00" <= ch <= "\u9fff":
            flat = unicodedata.normalize("NFKC", ch)
            if flat != ch and flat.isalpha() and (ch.isalpha() or "\u2e80" <= ch <= "\u2fdf") and script(flat[0]) in ("LATIN", "CJK") and not unicodedata.decomposition(ch).startswith(("<super>", "<sub>", "<square>")):
                if unicodedata.normalize("NFD", ch) == ch or script(flat[0]) == "CJK" or unicodedata.normalize("NFC", ch) != ch:
                    out.append(flat)
                    any_ = True
                    continue
        out.append(ch)
    return "".join(out), any_


def _doubted(text: str) -> list[str]:
    """The whole-script tokens of `text` that have a Latin double, of scripts without any other letter in it."""
    if not re.search(r"[\u0370-\u058f\u13a0-\u13ff\u2c80-\u2cff\ua4d0-\ua4ff]", text):
        return []
    words = [t for w in _WORD.findall(text) for t in re.findall(r"[^\u2e80-\u9fff\uf900-\ufaff]+", w)]
    firm = {script(c) for w in words if skeleton(w) is None for c in w if script(c) in ("CYRILLIC", "GREEK", "ARMENIAN", "CHEROKEE", "COPTIC", "LISU") and c not in SYMBOLS}
    return [w for w in words if skeleton(w) and script(w[0]) not in firm]


def respell(text: str, words: set[str]) -> str:
    """`text` (in one form) with each doubtful token whose Latin double is one of `words` in its Latin spelling; marks on its letters stay."""
    text = unicodedata.normalize("NFD", text)
    doubted = {w for w in _doubted(text) if skeleton(w) in words}
    latin = lambda m: "".join(_latin(c) if c.isalpha() else c for c in m[0]) if m[0] in doubted else m[0]
    text = _WORD.sub(lambda m: re.sub(r"[^\u2e80-\u9fff\uf900-\ufaff]+", latin, m[0]), text)
    return unicodedata.normalize("NFC", text)


def normalize(text: str) -> tuple[str, list[str], list[str]]:
    """(text in one form, kinds of disguise in it, its whole-script skeletons that the vocabulary has to decide)."""
    kinds = []
    if _WIDTH.search(text):
        kinds.append("width")
        text = _WIDTH.sub(lambda m: chr(ord(m[0]) - 0xFEE0), text)
    if _INVISIBLE.search(text):
        kinds.append("invisible")
        text = _INVISIBLE.sub("", text)
    if _SPACE.search(text):
        kinds.append("space")
        text = _SPACE.sub(" ", text)
    if any("\u0300" <= c <= "\u036f" or unicodedata.combining(c) for c in text):
        if any(unicodedata.category(b) == "Mn" and a.isalpha() for a, b in zip(text, text[1:])):
            kinds.append("accent")
    alike = False
    text, alike = _forms(text)

    def spell(m: re.Match) -> str:
        nonlocal alike
        s = consistent(m[0])
        if s is not None and s != m[0]:
            alike = True
            return s
        return m[0]

    def runs(m: re.Match) -> str:
        # Chinese has no blanks: a token ends where ideographs meet letters of an alphabet.
        return re.sub(r"[^\u2e80-\u9fff\uf900-\ufaff]+", spell, m[0])

    text = _WORD.sub(runs, text)
    lone = re.compile(r"(?<![\u3040-\u30ff])[" + "".join(KANA_HAN) + r"](?![\u3040-\u30ff])")
    if lone.search(text) and not re.search(r"[\u3041-\u3096]", text):
        turned = lone.sub(lambda m: KANA_HAN[m[0]] if m.start() and "\u4e00" <= text[m.start() - 1] <= "\u9fff" and "\u4e00" <= text[m.end() : m.end() + 1] <= "\u9fff" else m[0], text)
        alike |= turned != text
        text = turned
    doubtful = [skeleton(w) for w in _doubted(text)]
    if alike:
        kinds.append("lookalike")
    return unicodedata.normalize("NFC", text), kinds, doubtful


def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        got = [normalize(t) for t in b["text"]]
        b["text"], b["disguises"], b["doubtful"] = [g[0] for g in got], [g[1] for g in got], [g[2] for g in got]
        yield b


def examine(records: DataFrame) -> DataFrame:
    """`records` (rec, rec_uid, field_name, text) in one form; columns as in CASES.

    NULL texts give no row, empty ones stay empty; repeated rows come again. Rows of usual characters only don't leave the JVM.
    Doubtful whole-script tokens are settled with the words of all records: a skeleton that is a word elsewhere makes its record a 'lookalike'.
    """
    rows = records.select("rec", F.col("rec_uid").cast("bigint").alias("rec_uid"), "field_name", "text").filter("text IS NOT NULL")
    odd = F.col("text").rlike(UNUSUAL)
    none = F.array().cast("array<string>")
    plain = rows.filter(~odd).withColumn("disguises", none).withColumn("doubtful", none)
    seen = checkpoint(rows.filter(odd).mapInPandas(_run, CASES))  # a small part of the rows, read several times
    return plain.unionByName(seen)


def _words(examined: DataFrame) -> DataFrame:
    return examined.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{2,}"), F.lit(0))).alias("word")).distinct()


def _respelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b["text"] = [respell(t, set(w)) for t, w in zip(b["text"], b["words"])]
        yield b.drop(columns="words")


def unify(examined: DataFrame) -> DataFrame:
    """`examined` without `doubtful`: whole-script tokens whose Latin double is a word of the records are spelled so, and their records are a 'lookalike' besides what they were.

    Only records with such tokens take part in the join; of them, equal ones come once.
    """
    cols = ["rec", "rec_uid", "field_name", "text", "disguises"]
    doubt = examined.filter(F.size("doubtful") > 0).select(*cols, F.explode("doubtful").alias("word"))
    known = doubt.join(_words(examined).withColumn("_known", F.lit(True)), "word", "left")
    rows = known.groupBy(*cols).agg(F.collect_set(F.when(F.col("_known"), F.col("word"))).alias("words"))
    turned = rows.filter(F.size("words") > 0).withColumn("disguises", F.array_union("disguises", F.array(F.lit("lookalike")))).mapInPandas(_respelled, CASES.rsplit(",", 1)[0])
    return examined.filter(F.size("doubtful") == 0).select(*cols).unionByName(rows.filter(F.size("words") == 0).select(*cols)).unionByName(turned)


def settle(examined: DataFrame) -> DataFrame:
    """(rec, rec_uid, field_name, disguise): one row per kind, whole-script tokens included."""
    key = ["rec", "rec_uid", "field_name"]
    doubt = examined.filter(F.size("doubtful") > 0).select(*key, F.explode("doubtful").alias("word"))
    whole = doubt.join(_words(examined), "word", "left_semi").select(*key, F.lit("lookalike").alias("disguise"))
    return examined.filter(F.size("disguises") > 0).select(*key, F.explode("disguises").alias("disguise")).unionByName(whole).distinct()
