"""Languages of documents and of their segments.

Multinomial naive Bayes over hashed character n-grams (one to three characters). The model is fitted on a bounded
sample of labelled documents and refined on its own sentence decisions, since labels are sometimes wrong and
texts mixed; its log-probability matrix (2^BITS x languages floats) is broadcast. Sentences are scored in batches; a
Viterbi pass with a price for each change of language settles the sentences of mixed documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LANGUAGES = ("zh", "en", "de", "fr", "ja", "ru")
BITS = 15
#: Labelled documents at most that the model is fitted on, taken evenly by language in the order of a hash of the id.
SAMPLE = 1500
#: Sentences of them at most that the matrix is fitted on, and characters of a sentence that is taken whole.
SENTENCES, LONGEST = 60_000, 2000
ROUNDS = 2
SMOOTHING = 0.3
#: Price (nats) of a change of language between neighbouring sentences.
CHANGE = 6.0
#: A language other than the main one counts from a stretch of so many characters.
LEAST = {"zh": 40, "ja": 40}
LEAST_OTHER = 80
MISSING = ("", "und", "unknown")

SEGMENTS = "doc_id bigint, segment int, lang string, confidence double, char_start int, char_end int, n_chars int, main_lang string, main_confidence double"
_COLUMNS = [c.split()[0] for c in SEGMENTS.split(", ")]
_SENTENCE = re.compile(r"[^。！？!?.\n]*(?:[。！？]+|[!?.]+(?=\s|\Z)|[!?.]|\n|\Z)[”’\"'」』）)]*\s*")
_ASIDE = re.compile(r"\s*[（(\[【][^（(\[【）)\]】]*[）)\]】]\s*")
_LETTER = np.zeros(1 << 16, dtype=bool)
_LETTER[[i for i in range(1 << 16) if chr(i).isalpha()]] = True


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences of `text`; ends are sentence signs followed by white space (Chinese and Japanese signs need none) and line feeds."""
    out, at = [], 0
    for m in _SENTENCE.finditer(text):
        if m.end() == m.start():
            continue
        tail = text[m.start() : m.end()]
        if tail.rstrip()[-1:] in ".!?" and tail[-1:] not in " \n\t　" and m.end() < len(text):
            continue  # a point inside a number or an abbreviation
        out.append((at, m.end()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, owner, letters): hashed n-grams of all texts and whose they are, and the letters of each text.

    Only n-grams that hold letters count: figures and signs say nothing of the language. Letters are lower-cased, anything else is one sign.
    """
    joined = "\x00".join(texts).lower()
    if len(joined) != sum(map(len, texts)) + max(0, len(texts) - 1):  # lower-casing changed a length
        texts = [t.lower() for t in texts]
        joined = "\x00".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[: len(code)]
    letter = _LETTER[np.minimum(code, 0xFFFF)] | (code > 0x1FFFF)
    c = np.where(letter, code, 32).astype(np.uint32)
    found, whose = [], []
    for order in (1, 2, 3):
        if len(c) < order:
            break
        acc = np.full(len(c) - order + 1, order * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
        some = np.zeros(len(acc), dtype=bool)
        for k in range(order):
            acc = (acc ^ c[k : k + len(acc)]) * np.uint32(0x85EBCA6B)
            acc ^= acc >> np.uint32(15)
            some |= letter[k : k + len(acc)]
        some &= owner[: len(acc)] == owner[order - 1 :]
        found.append((acc >> np.uint32(32 - BITS))[some])
        whose.append(owner[: len(acc)][some])
    letters = np.bincount(owner[letter], minlength=len(texts)) if len(code) else np.zeros(len(texts), int)
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, int), letters
    return np.concatenate(found), np.concatenate(whose), letters


def scores(texts: list[str], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of each text in each language, and its letters."""
    bucket, owner, letters = buckets(texts)
    out = np.empty((len(texts), matrix.shape[1]))
    for k in range(matrix.shape[1]):
        out[:, k] = np.bincount(owner, weights=matrix[:, k][bucket], minlength=len(texts))
    return out / 3, letters  # the three orders overlap: one third, so that a character counts once


def label_column(lang: str) -> F.Column:
    """The language that a label names: lower case, without region; NULL where it is missing."""
    base = F.regexp_extract(F.lower(F.trim(lang)), r"^([a-z]+)", 1)
    return F.when(F.col(lang).isNull() | F.lower(F.trim(lang)).isin(*MISSING) | (base == ""), None).otherwise(base)


def _matrix(counts: np.ndarray) -> np.ndarray:
    smooth = counts + SMOOTHING
    return np.log(smooth / smooth.sum(axis=0)).astype(np.float32)


def _short(text: str) -> list[tuple[int, int]]:
    """Sentences of a text; longer ones in parts of LONGEST characters."""
    return [(k, min(k + LONGEST, z)) for a, z in sentences(text) for k in range(a, z, LONGEST)]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> np.ndarray:
    """The log-probability matrix, from at most `sample` labelled documents, and of their sentences (cut where longer than LONGEST) at most SENTENCES, in the order of a hash: what comes to the driver is bounded."""
    key = F.col(doc_id).cast("string")
    known = docs.select(key.alias("_k"), F.xxhash64(key).alias("_h"), label_column(lang).alias("_l")).filter(F.col("_l").isin(*LANGUAGES) & F.col(text).isNotNull())
    # The rank is limited within each task before the shuffle, and reads no text; the chosen ids are at most `sample`.
    chosen = known.withColumn("_r", F.row_number().over(W.partitionBy("_l").orderBy("_h", "_k"))).filter(F.col("_r") <= sample // len(LANGUAGES)).select("_k", "_l")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, lang, n, t[a:z]) for k, lang, t in zip(b["_k"], b["_l"], b["_t"]) for n, (a, z) in enumerate(_short(t))]
            yield pd.DataFrame(rows, columns=["_k", "_l", "_n", "_s"])

    every = docs.select(key.alias("_k"), F.col(text).alias("_t")).filter("_t IS NOT NULL").join(F.broadcast(chosen), "_k").mapInPandas(cut, "_k string, _l string, _n int, _s string")
    rows = sorted(every.orderBy(F.xxhash64("_k", "_n"), "_k", "_n").limit(SENTENCES).collect(), key=lambda r: (r["_l"], r["_k"], r["_n"]))
    texts, labels = [r["_s"] for r in rows], [LANGUAGES.index(r["_l"]) for r in rows]
    bucket, owner, letters = buckets(texts)
    label = np.array(labels, dtype=np.int64)
    for _ in range(ROUNDS + 1):
        counts = np.zeros((1 << BITS, len(LANGUAGES)))
        ok = label[owner] >= 0
        np.add.at(counts, (bucket[ok], label[owner][ok]), 1.0)
        matrix = _matrix(counts)
        got, _ = scores(texts, matrix)
        label = np.where(letters >= 12, got.argmax(axis=1), -1)
    return matrix


def _settle(score: np.ndarray) -> np.ndarray:
    """Viterbi over sentences with a price for changes."""
    n, k = score.shape
    best, back = score[0].copy(), np.zeros((n, k), dtype=np.int64)
    for i in range(1, n):
        j = int(best.argmax())
        stay = best >= best[j] - CHANGE
        back[i] = np.where(stay, np.arange(k), j)
        best = np.where(stay, best, best[j] - CHANGE) + score[i]
    path = np.zeros(n, dtype=np.int64)
    path[-1] = int(best.argmax())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i][path[i]]
    return path


def segments(docs: DataFrame, matrix: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per stretch of sentences in one language; columns as in SEGMENTS.

    The main language is the one with most characters. Confidence is the model's probability of the stretch's language, each character
    weighing a tenth of a nat at most, so that long stretches don't all come out at 1. NULL and blank texts and texts without letters
    give no row; repeated rows come again; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(matrix)

    def confidence(score: np.ndarray, lang: int, letters: int) -> float:
        z = (score - score.max()) / max(1.0, letters / 40)
        p = np.exp(z)
        return float(p[lang] / p.sum())

    def one(doc: int, text: str, spans: list, score: np.ndarray, letters: np.ndarray, rows: list) -> None:
        if not letters.sum():
            return
        aside = np.array([bool(_ASIDE.fullmatch(text, s, e)) for s, e in spans])
        if aside.any() and letters[~aside].sum():  # a title or term in brackets takes the language around it
            score, letters = np.where(aside[:, None], 0.0, score), np.where(aside, 0, letters)
        plain = score.argmax(axis=1)[letters > 0]
        path = np.full(len(spans), plain[0]) if (plain == plain[0]).all() else _settle(score)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(path)) + 1, [len(path)]))
        total = {}
        parts = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            lang = int(path[a])
            s, e = spans[a][0], spans[b - 1][1]
            n = len(text[s:e].strip())
            total[lang] = total.get(lang, 0) + n
            parts.append((LANGUAGES[lang], confidence(score[a:b].sum(axis=0), lang, int(letters[a:b].sum())), s, e, n))
        main = max(total, key=total.get)
        mine = path == main
        sure = confidence(score[mine].sum(axis=0), main, int(letters[mine].sum()))
        rows += [(doc, i, *p, LANGUAGES[main], sure) for i, p in enumerate(parts)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at : at + 500]
                spans = [sentences(t) for t in part["_t"]]
                texts = [t[s:e] for t, sp in zip(part["_t"], spans) for s, e in sp]
                rows: list = []
                if texts:
                    score, letters = scores(texts, m)
                    i = 0
                    for doc, t, sp in zip(part["_id"], part["_t"], spans):
                        if sp:
                            one(doc, t, sp, score[i : i + len(sp)], letters[i : i + len(sp)], rows)
                        i += len(sp)
                yield pd.DataFrame(rows, columns=_COLUMNS)

    src = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).alias("_t")).filter("_id IS NOT NULL AND _t IS NOT NULL")
    return src.mapInPandas(run, SEGMENTS)


def languages(parts: DataFrame) -> DataFrame:
    """(doc_id, lang, main_lang): the main language, and others with a long enough stretch."""
    least = F.when(F.col("lang").isin(*LEAST), min(LEAST.values())).otherwise(LEAST_OTHER)
    return parts.filter((F.col("lang") == F.col("main_lang")) | (F.col("n_chars") >= least)).select("doc_id", "lang", "main_lang").distinct()


def found(docs: DataFrame, matrix: np.ndarray, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, found_lang) of documents with a missing or wrong label or more than one language."""
    got = languages(segments(docs, matrix, doc_id, text)).groupBy("doc_id").agg(F.collect_set("lang").alias("_langs"), F.first("main_lang").alias("_main"))
    labels = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), label_column(lang).alias("_label")).distinct()
    bad = F.col("_label").isNull() | (F.col("_label") != F.col("_main")) | (F.size("_langs") > 1)
    return got.join(labels, "doc_id").filter(bad).select("doc_id", F.explode("_langs").alias("found_lang")).distinct()
