"""Markup in text: found, turned into clean text, and repeated runs removed.

`scan` finds the kinds of marks, `convert` turns a text into clean text with typed segments. `repeated_runs` works on the token
streams of all pages of a host: suffixes of the concatenated streams are brought together by their first MIN_TOKENS tokens,
the part of a suffix array that long repeats need; a run that starts on two distinct pages is repeated, and what such runs cover is
boilerplate. The sort of suffixes is the cluster's shuffle, keyed by host and run, so no host is gathered in one task.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML, MathML and wiki tags; LaTeX commands need no list but where nothing tells them from a file path.
_TAGS = "a|abbr|address|audio|button|canvas|dfn|dialog|fieldset|gallery|legend|map|math|meter|m(?:i|n|o|row|sub|sup|frac|sqrt|text|table|tr|td)|noscript|nowiki|object|optgroup|output|picture|progress|ref|references|rp|rt|ruby|source|template|track|article|aside|b|big|blockquote|body|br|caption|center|cite|code|col|colgroup|dd|del|details|div|dl|dt|em|figcaption|figure|font|footer|form|h[1-6]|head|header|hr|html|i|iframe|img|input|ins|kbd|label|li|link|main|mark|meta|nav|ol|option|p|pre|q|s|samp|script|section|select|small|span|strike|strong|style|sub|summary|sup|svg|table|tbody|td|textarea|tfoot|th|thead|title|tr|tt|u|ul|var|video|wbr"
_ATTRIBUTE = r"\s+[A-Za-z][\w:-]*\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s\"'<>=]+)"
TAG = rf"</(?:{_TAGS})\s*>|<(?:{_TAGS})(?:{_ATTRIBUTE})*\s*/?>|<!--"
ENTITY = r"&(?:[A-Za-z]{2,8}[0-9]{0,2}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"
# Commands that count whatever follows them.
_SYMBOLS = "alpha|beta|gamma|delta|epsilon|eta|theta|lambda|mu|nu|pi|rho|sigma|tau|phi|omega|Delta|Omega|Sigma|pm|times|cdot|leq|geq|approx|infty|partial|sum|int|sqrt|frac|ldots|quad|item|maketitle|noindent|centering|hline|newline"
COMMAND = rf"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{{|(?<![A-Za-z]:|[\w\\])\\(?:{_SYMBOLS})(?![A-Za-z])|(?<![\w\\:/.~])\\[A-Za-z]{{2,}}(?![A-Za-z\\:./])|\\\(|\\\)|\\\[|\\\]"
DOLLARS = r"\$\$|(?<![A-Za-z0-9$])\$[^$\n]*[\\^_{=][^$\n]*\$|(?<![\w$\\])\$(?=[^\s$])(?=[^$\n]*[A-Za-z])(?=[^$\n]*[-+*/<>])[^$\n]*[^\s$]\$(?![\w$])"
FENCE = r"(?s)```.*?(?:```|\z)"
MARKDOWN = r"```|`[^`\n]+`|\*\*[^*\s](?:[^*]*[^*\s])?\*\*|(?<![\w*])\*[^*\s\d](?:[^*\n]*[^*\s])?\*(?![\w*])|!\[[^\]]*\]\([^)]*\)|(?<!\[)\[[^\[\]]+\]\([^()\s]+(?:\s\"[^\"]*\")?\)|~~[^~\n]+~~|(?<!\w)__[^_\s][^_\n]*__(?!\w)|(?<![\w\\_])_[^_\s](?:[^_\n]*[^_\s])?_(?![\w_])|<https?://[^\s<>]+>"
MARKDOWN_LINES = r"(?m)^[ ]{0,3}#{1,6}[ \t]+\S|^[ ]{0,3}>[ \t]?(?![ \t]*[0-9.]+[ \t]*[。.,，;；]?[ \t]*\r?$)\S|^[ ]{0,6}[-*+][ \t]+(?![0-9 ]+[-*+]?[ \t]*\r?$)\S|^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*\r?$|^[^\n|]*\w[^\n|]*\n(?:={3,}|-{3,})[ \t]*\r?$"
WIKI = r"\[\[[^\[\]]+\]\]|(?<![\\{}_^])(?<!\\[A-Za-z]{1,20})\{\{[^{}]+\}\}|(?<!')'{2,5}(?!')[^'\n]+'{2,5}"
WIKI_LINES = r"(?m)^[ \t]*(={2,6})[ \t]*[^=\n]+?[ \t]*\1[ \t]*\r?$|^[ \t]*\{\|.*$|^[ \t]*\|\}[ \t]*\r?$"
#: Characters without width would break a mark apart.
_INVISIBLE = r"[\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]"


#: Every mark has one of these; most texts have none and are passed over with one look.
ANY = r"(?m)[<&`*\[~#>|{'=\\$]|(?<!\w)_|---|^[ ]{0,6}[-+][ \t]"


def scan(text: F.Column) -> F.Column:
    """Array of the kinds of marks in a text, in the JVM: html, markdown, wiki, latex. NULL and empty texts have none."""
    return F.when(text.rlike(ANY), _scan(text)).otherwise(F.array().cast("array<string>"))


def _scan(text: F.Column) -> F.Column:
    t = F.regexp_replace(F.coalesce(text, F.lit("")), _INVISIBLE, "")
    t = F.translate(t, "".join(map(chr, [*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)])), "".join(map(chr, [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)])))
    bare = F.regexp_replace(t, FENCE, " ")  # what stands in a code block is code
    some = lambda c, *patterns: F.lit(False) if not patterns else c.rlike(patterns[0]) | some(c, *patterns[1:])
    return F.array_compact(F.array(
        F.when(some(bare, f"(?i)(?:{TAG})", ENTITY), F.lit("html")),
        F.when(some(t, MARKDOWN) | some(bare, MARKDOWN_LINES), F.lit("markdown")),
        F.when(some(bare, WIKI, WIKI_LINES), F.lit("wiki")),
        F.when(some(bare, COMMAND, DOLLARS), F.lit("latex")),
    ))


def marks(df: DataFrame, uid: str, fields: list[str]) -> DataFrame:
    """(uid, field_name, markup): one row per field and kind; repeated rows once; other columns are ignored."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), scan(F.col(f)).alias("kinds")) for f in fields)))
    return df.select(F.col(uid).alias("uid"), each.alias("x")).select("uid", "x.field_name", F.explode("x.kinds").alias("markup")).distinct()


# Conversion

Segment = tuple[str, str]
_INLINE = [
    (re.compile(r"!\[([^\]]*)\]\([^)]*\)"), r"\1"),
    (re.compile(r"(?<!\[)\[([^\[\]]+)\]\([^()\s]+(?:\s\"[^\"]*\")?\)"), r"\1"),
    (re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]+)\]\]"), r"\1"),
    (re.compile(r"(\\[A-Za-z]+)?(?<![\\{}_^])\{\{[^{}]+\}\}"), lambda m: m[0] if m[1] else ""),
    (re.compile(r"\*\*([^*\s](?:[^*]*[^*\s])?)\*\*"), r"\1"),
    (re.compile(r"(?<![\w*])\*([^*\s\d](?:[^*\n]*[^*\s])?)\*(?![\w*])"), r"\1"),
    (re.compile(r"(?<!')'{2,5}(?!')([^'\n]+)'{2,5}"), r"\1"),
    (re.compile(r"~~([^~\n]+)~~"), r"\1"),
    (re.compile(r"(?<!\w)__([^_\s][^_\n]*)__(?!\w)"), r"\1"),
    (re.compile(r"(?<![\w\\_])_([^_\s](?:[^_\n]*[^_\s])?)_(?![\w_])"), r"\1"),
    (re.compile(r"`([^`\n]+)`"), r"\1"),
    (re.compile(r"\\(?:cite|ref|label|eqref|footnote)\*?(?:\[[^\]\n]*\])?\{[^{}]*\}"), ""),
    (re.compile(r"\\(?:textbf|textit|emph|underline|texttt|text|mathrm|mbox)\{([^{}]*)\}"), r"\1"),
]
_CELL = re.compile(r"(?is)<t[dh](?:\s[^<>]*)?>(.*?)(?=</?t[dhr]\b|</table|\Z)")
_TAG = re.compile(f"(?i){TAG}")
_SUB = re.compile(r"(?i)<su([bp])>([^<]*)</su\1>")
_NOTE = re.compile(r"(?is)<ref(?:\s[^<>]*)?(?:/>|>.*?</ref\s*>)")
_LINK = re.compile(r"<(https?://[^\s<>]+)>")
_UNDERLINED = re.compile(r"(?m)^([^\n|]*\w[^\n|]*)\n(?:={3,}|-{3,})[ \t]*\r?$")
_FORMULA = re.compile(r"(?s)\$\$(.+?)\$\$|\\\[(.+?)\\\]|\\begin\{(equation|align|gather|displaymath)\*?\}(.+?)\\end\{\3\*?\}")
_SHORT_FORMULA = re.compile(r"(?<![A-Za-z0-9$])\$([^$\n]*[\\^_{=][^$\n]*|(?=[^\s$])(?=[^$\n]*[A-Za-z])(?=[^$\n]*[-+*/<>])[^$\n]*[^\s$])\$(?!\d)|\\\((.+?)\\\)")


def _inline(s: str) -> str:
    s = _SHORT_FORMULA.sub(lambda m: (m[1] or m[2]).strip(), s)
    s = _LINK.sub(r"\1", s)
    s = _SUB.sub(lambda m: ("_" if m[1].lower() == "b" else "^") + m[2], s)
    s = _TAG.sub("", s)
    for pattern, to in _INLINE:
        s = pattern.sub(to, s)
    return re.sub(r"[ \t\u00a0]+", " ", html.unescape(s)).strip()


def convert(text: str) -> list[Segment]:
    """Typed segments of clean text: paragraph, heading, item, quote, row (cells parted by tabs), code, formula."""
    out: list[Segment] = []
    held: list[Segment] = []

    def hold(kind: str, body: str) -> str:
        held.append((kind, body))
        return f"\n\x00{len(held) - 1}\x00\n"

    s = text.replace("\r\n", "\n").replace("\x00", "")
    s = re.sub(r"(?s)```[^\n`]*\n?(.*?)(?:```|\Z)", lambda m: hold("code", m[1].strip("\n")), s)
    s = re.sub(r"(?is)<pre(?:\s[^<>]*)?>(.*?)</pre\s*>", lambda m: hold("code", html.unescape(_TAG.sub("", m[1])).strip("\n")), s)
    s = _FORMULA.sub(lambda m: hold("formula", " ".join((m[1] or m[2] or m[4]).split())), s)
    s = _NOTE.sub("", s)
    s = _UNDERLINED.sub(lambda m: hold("heading", _inline(m[1])), s)
    s = re.sub(r"(?is)<(script|style)(?:\s[^<>]*)?>.*?</\1\s*>|<!--.*?(?:-->|\Z)", "", s)
    s = re.sub(r"(?is)<h([1-6])(?:\s[^<>]*)?>(.*?)</h\1\s*>", lambda m: hold("heading", _inline(m[2])), s)
    s = re.sub(r"(?is)<tr(?:\s[^<>]*)?>(.*?)(?:</tr\s*>|(?=<tr\b)|(?=</table)|\Z)", lambda m: hold("row", "\t".join(_inline(c) for c in _CELL.findall(m[1]))), s)
    s = re.sub(r"(?is)<li(?:\s[^<>]*)?>(.*?)(?:</li\s*>|(?=<li\b)|(?=</[uo]l)|\Z)", lambda m: hold("item", _inline(m[1])), s)
    s = re.sub(r"\\(?:part|chapter|(?:sub)*section|paragraph)\*?\{([^{}]*)\}", lambda m: hold("heading", _inline(m[1])), s)
    s = re.sub(r"(?i)<br\s*/?>", "", s)
    s = re.sub(r"(?i)</?(?:p|div|table|tbody|thead|ul|ol|blockquote|section)(?:\s[^<>]*)?>", "\n", s)
    s = re.sub(r"\\(?:begin|end)\{[^{}]*\}", "\n", s)
    table = False
    para: list[str] = []

    def flush() -> None:
        if para:
            body = _inline("\n".join(para).strip())
            if body:
                out.append(("paragraph", body))
            para.clear()

    for line in s.split("\n"):
        line = line.strip(" \t\r")
        if m := re.fullmatch(r"\x00(\d+)\x00", line):
            flush()
            if held[int(m[1])][1]:
                out.append(held[int(m[1])])
        elif re.match(r"\{\|", line):
            flush()
            table = True
        elif table and line.startswith("|}"):
            table = False
        elif table:
            if line[:1] in "|!" and not line.startswith("|-"):
                cells = [_inline(c) for c in re.split(r"\|\||!!", line[1:])]
                out.append(("row", "\t".join(cells)))
        elif re.fullmatch(r"\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?", line):
            flush()
        elif len(line) > 2 and line[0] == "|" and line[-1] == "|":
            flush()
            out.append(("row", "\t".join(_inline(c) for c in line[1:-1].split("|"))))
        elif m := re.fullmatch(r"#{1,6}[ \t]+(.+?)[ \t#]*|(={2,6})[ \t]*([^=]+?)[ \t]*\2", line):
            flush()
            out.append(("heading", _inline(m[1] or m[3])))
        elif m := re.fullmatch(r">[ \t]?(.*)", line):
            if re.fullmatch(r"[ \t]*[0-9.]+[ \t]*[。.,，;；]?", m[1]):
                para.append(line)
            else:
                flush()
                if m[1]:
                    out.append(("quote", _inline(m[1])))
        elif m := re.fullmatch(r"(?:[-*+]|\\item)[ \t]+(.+)", line):
            if re.fullmatch(r"[0-9 ]+[-*+]?", m[1]):
                para.append(line)
            else:
                flush()
                out.append(("item", _inline(m[1])))
        elif not line:
            flush()
        else:
            para.append(line)
    flush()
    return [(k, b) for k, b in out if b]


_SHOWN = {"heading": "\n{}\n", "item": "• {}", "code": "\n{}\n", "quote": "{}", "row": "{}", "formula": "{}", "paragraph": "{}"}


def plain(segments: list[Segment]) -> str:
    """Clean text of segments: headings stand alone, items begin with a dot, cells are parted by tabs, code is indented."""
    shown = [_SHOWN[k].format("\n".join("    " + x for x in b.split("\n")) if k == "code" else b) for k, b in segments]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(shown)).strip("\n")


CLEANED = "uid bigint, field_name string, clean string, segments array<struct<kind:string,text:string>>"


def clean(df: DataFrame, uid: str, fields: list[str]) -> DataFrame:
    """(uid, field_name, clean, segments) of every non-NULL field that has marks; others stay as they are and give no row."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields)))
    src = df.select(F.col(uid).cast("bigint").alias("uid"), each.alias("x")).select("uid", "x.*").filter(F.size(scan(F.col("text"))) > 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [convert(t) for t in b["text"]]
            b["clean"] = [plain(g) for g in got]
            b["segments"] = [[{"kind": k, "text": t} for k, t in g] for g in got]
            yield b[["uid", "field_name", "clean", "segments"]]

    return src.mapInPandas(run, CLEANED)


# Repeated runs

MIN_TOKENS = 12
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\W\d_]|[^\s\w]|_")
RUNS = "host string, page bigint, n_tokens int, covered int, kept string, repeated array<string>"


def _tokens(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    found = list(_TOKEN.finditer(text))
    return [m[0] for m in found], np.array([m.start() for m in found], dtype=np.int64), np.array([m.end() for m in found], dtype=np.int64)


def run_keys(text: str, n: int) -> np.ndarray:
    """Hashes of all runs of n tokens of a text."""
    words, _, _ = _tokens(text)
    if len(words) < n:
        return np.zeros(0, dtype=np.int64)
    h = pd.util.hash_array(np.array(words, dtype=object))
    acc = np.zeros(len(words) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            acc = (acc * np.uint64(0x9E3779B97F4A7C15)) ^ h[k : k + len(acc)]
            acc ^= acc >> np.uint64(29)
    return acc.view(np.int64)


def repeated_runs(pages: DataFrame, host: str, page: str, text: str, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """For each page: what of its token stream runs of `min_tokens` tokens cover that start on another page of its host too, and the text without them; columns as in RUNS.

    NULL and empty texts have no tokens and give no row; repeated rows of a page count once and are no repeat of each other; a NULL host is a host of its own.
    """
    src = pages.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col(page).cast("bigint").alias("page"), F.col(text).alias("text")).filter("page IS NOT NULL AND text <> ''").dropDuplicates(["host", "page"])

    def starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for h, p, t in zip(b["host"], b["page"], b["text"]):
                keys = np.unique(run_keys(t, min_tokens))
                if len(keys):
                    yield pd.DataFrame({"host": h, "page": p, "run": keys})

    each = src.mapInPandas(starts, "host string, page bigint, run bigint")
    # One row per page and run, so a count above one is a repeat on distinct pages; counted map-side first.
    shared = each.groupBy("host", "run").agg(F.count("*").alias("n")).filter("n > 1").select("host", "run")
    hit = each.join(shared, ["host", "run"]).groupBy("host", "page").agg(F.collect_set("run").alias("runs"))

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for h, p, t, runs in zip(b["host"], b["page"], b["text"], b["runs"]):
                words, s, e = _tokens(t)
                mask = np.zeros(len(words) + 1, dtype=np.int64)
                if runs is not None and len(runs):
                    at = np.flatnonzero(np.isin(run_keys(t, min_tokens), np.asarray(runs, dtype=np.int64)))
                    np.add.at(mask, at, 1)
                    np.add.at(mask, at + min_tokens, -1)
                inside = np.cumsum(mask)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
                kept, gone, last = [], [], 0
                for a, z in zip(edge[::2], edge[1::2]):
                    kept.append(t[last : s[a]])
                    gone.append(t[s[a] : e[z - 1]])
                    last = e[z - 1]
                kept.append(t[last:])
                rows.append((h, p, len(words), int(inside.sum()), "".join(kept), gone))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RUNS.split(", ")])

    return src.join(hit, ["host", "page"], "left").mapInPandas(cover, RUNS)
