"""Broken instruction and answer pairs.

An answer is cut into clauses; a linear-chain conditional random field tags each as answer, refusal, echo (of the
instruction), foreign (another language than asked for) or unfinished. What share of the answer each tag covers decides the
pair's defect. The field is fitted on a bounded sample of the table's own pairs and on pairs broken on purpose (cut, swapped,
echoed, refused); its weights, a few hundred numbers, are broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
#: Pairs at most that the field is fitted on.
SAMPLE = 600
STEPS, RATE, L2 = 120, 0.25, 1e-3
#: Fitting cuts a longer chain of clauses into stretches of so many, so that its memory grows with the clauses and not with the longest answer; all clauses take part, only the transition at a cut is not counted.
STRETCH = 16
DEFECTS = "id string, defect string, answer_share double, refusal_share double, echo_share double, foreign_share double, unfinished_share double"

# Words that stand for no answer.
PLACEHOLDERS = frozenset("null none nil nan n/a na tbd todo undefined empty answer answer: 无 暂无 略 空 待补充 待定 未知 无内容 答 答： 答: 回答： 答案： a:".split())
# How a refusal is worded. Apologies and names of the machine alone are no refusal.
_APOLOGY = re.compile(r"抱歉|对不起|恕|遗憾|\b(?:sorry|apologi[sz]e|apologies|regret|afraid)\b", re.I)
_MACHINE = re.compile(r"语言模型|人工智能|AI助手|作为(?:一个|一名)?(?:AI|助手)|\b(?:as an AI|AI (?:model|assistant)|language model)\b", re.I)
_UNABLE = re.compile(
    r"我(?:暂时|目前|并)?(?:无法|不能|不便|没有能力|没有办法|没办法|看不到|难以|不会|不可以|回答不了|不了解)|(?:恕|暂时)(?:我)?(?:无法|不能|不便)|(?:没有办法|无法|不能)(?:作答|回答|协助|完成该|提供[^，。]{0,12}(?:分析|答案|帮助))|我回答不了|超出(?:了)?我的(?:能力|知识)|"
    r"\bI(?:'m| am)?(?: \w+){0,2} (?:cannot|can't|can not|unable|not able|decline|won't|don't have|do not have|couldn't)\b|\bI (?:must|have to) decline\b|\b(?:unable|not able) to (?:answer|assist|help|comment|complete|view|provide|respond)\b|beyond (?:my (?:ability|abilities|knowledge)|what I can)\b",
    re.I,
)
_REFERRAL = re.compile(r"请咨询|建议(?:您)?(?:咨询|查阅|参考|联系|直接)|内容(?:限制|政策)|欢迎继续提问|感谢理解|如有其他问题|\b(?:consult|let me know|feel free|ask (?:me )?another|content policy)\b", re.I)
# Frequent words that tell the languages of the Latin alphabet apart.
_FUNCTION = {
    "en": frozenset("the of and to in is was with for that by at on it as from were which this are be its when what how not after".split()),
    "de": frozenset("der die das und den dem des ein eine einer im ist mit für von zu bei auf nicht nach sich wurde war auch als über wie".split()),
    "fr": frozenset("le la les des du de et un une est dans pour que qui au aux sur avec par ce cette sont en à plus".split()),
    "es": frozenset("el los las del y un una es en para que con por su al se como más".split()),
}
# How an instruction names the language it asks for.
_ASKED = (("en", r"英[文语]|\bEnglish\b"), ("zh", r"中[文]|汉语|\bChinese\b"), ("de", r"德[文语]|\bGerman\b"), ("fr", r"法[文语]|\bFrench\b"), ("ja", r"日[文语]|\bJapanese\b"), ("ru", r"俄[文语]|\bRussian\b"))
_ASKS = re.compile(r"译|用.{0,4}[文语](?:写|回答|作答|给出|表述)|\b(?:translate|translation|wording|version|in|into)\b", re.I)

_CUE = re.compile("|".join(f"(?:{x.pattern})" for x in (_UNABLE, _APOLOGY, _MACHINE, _REFERRAL)), re.I)
_POINT = re.compile(r"\d\.\s*\Z")
_CLAUSE = re.compile(r"[^。！？!?\n.]*(?:[。！？!?]+[”’」』）)\"]*(?:[（(][^（）()\n]{1,20}[）)])*|\n|\.(?=\s|\Z)|\.|\Z)\s*")
_LIST = re.compile(r"\s*(?:[（(]?\d{1,3}[)）.、．]|[-•*·]\s|关键词|[Kk]eywords|第?[一二三四五六七八九十]+[、是])")
# A short remark in brackets may follow the end of a sentence.
_TERMINAL = re.compile(r"[。！？!?…；;.][”’」』）)\"]*\s*(?:[（(][^（）()\n]{1,20}[）)]\s*){0,3}\Z")
_FIGURE = re.compile(r"\d[\d.]*\s*[^\s\d，,。]{0,8}\s*\Z")
_DANGLING = re.compile(r"(?:[，,、：:（(\-–—]|（见|\(see|但是|以及|其中|并且|因此|而且|或者|和|与|的|e\.g\.,?|i\.e\.,?|\b(?:the|a|an|of|and|or|with|to|by|for|in|which|that|but|as|from))\s*\Z")
_LETTERS = re.compile(r"[^\W\d_]")
_JOIN = re.compile(r"[\W_]+")
_LATIN_WORD = re.compile(r"[^\W\d_]+")
FEATURES = ("bias", "length_short", "echo_most", "echo_half", "echo_little", "apology", "machine", "unable", "unable_with", "referral", "after_refusal_words", "foreign", "native", "no_language", "last", "last_terminal", "last_dangling", "last_list", "last_list_odd", "last_open", "last_figure_point")
_INDEX = {f: i for i, f in enumerate(FEATURES)}


def placeholder(answer: str | None) -> bool:
    """NULL, blank, or nothing but a stand-in word or signs."""
    if answer is None:
        return True
    s = answer.strip().lower()
    return s in PLACEHOLDERS or not any(c.isalnum() for c in s) or s.strip("()[]{}<>（）【】\"'“”.。 ") in PLACEHOLDERS


_CLASS = np.zeros(1 << 16, dtype=np.uint8)  # 1 Han, 2 kana, 3 Cyrillic, 4 Latin
_CLASS[0x4E00:0xA000], _CLASS[0x3040:0x3100], _CLASS[0x0400:0x0500] = 1, 2, 3
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0xC0:0x250] = 4, 4, 4


def languages(texts: list[str]) -> list[str | None]:
    """Languages by script, and by frequent words for the Latin alphabet; None where nothing tells."""
    if not texts:
        return []
    size = np.array([len(t) for t in texts])
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = _CLASS[np.minimum(code, 0xFFFF)]
    edge = np.concatenate(([0], np.cumsum(size)))
    han, kana, cyrillic, latin = (np.diff(np.concatenate(([0], np.cumsum(kind == k)))[edge]) for k in (1, 2, 3, 4))
    out: list[str | None] = []
    for i, (h, k, c, a) in enumerate(zip(han.tolist(), kana.tolist(), cyrillic.tolist(), latin.tolist())):
        if k > 2 and k > 0.1 * (k + h):
            out.append("ja")
        elif h and h * 4 >= a and h * 2 >= c:
            out.append("zh")
        elif c > a:
            out.append("ru")
        elif a < 8:
            out.append(None)
        else:
            words = [w.lower() for w in _LATIN_WORD.findall(texts[i])]
            score = {n: sum(w in s for w in words) for n, s in _FUNCTION.items()}
            best = max(score, key=score.get)
            out.append(best if score[best] else None)
    return out


def language(text: str) -> str | None:
    return languages([text])[0]


def wanted(instruction: str, own: str | None) -> str | None:
    """The language an answer should have: the one asked for, else the instruction's own."""
    if _ASKS.search(instruction):
        for lang, name in _ASKED:
            if re.search(name, instruction):
                return lang
    return own


def clauses(text: str) -> list[str]:
    """Sentences and list lines of an answer; blank ones are left out."""
    out, held = [], ""
    for m in _CLAUSE.finditer(text):
        piece = held + m[0]
        if m[0].endswith(".") and m.end() < len(text):  # a point inside a number or an abbreviation
            held = piece
            continue
        held = ""
        if piece.strip():
            out.append(piece)
    if held.strip():
        out.append(held)
    return out


def _grams(s: str) -> set[str]:
    s = _JOIN.sub("", s.lower())
    return {s[i : i + 3] for i in range(len(s) - 2)} or ({s} if s else set())


def features(instructions: list[str], answers: list[str]) -> list[tuple[np.ndarray, list[str]]]:
    """For each pair the feature rows of the answer's clauses, and the clauses."""
    cut = [clauses(a) for a in answers]
    langs = iter(languages([p for parts in cut for p in parts]))
    own = languages(instructions)
    return [_features(q, a, parts, wanted(q, o), [next(langs) for _ in parts]) for q, a, parts, o in zip(instructions, answers, cut, own)]


def _features(instruction: str, answer: str, parts: list[str], want: str | None, langs: list[str | None]) -> tuple[np.ndarray, list[str]]:
    rows = []
    asked = _grams(instruction)
    cue = bool(_CUE.search(answer))
    refused = False
    figures = 0
    for i, (p, lang) in enumerate(zip(parts, langs)):
        r = [0.0] * len(FEATURES)
        rows.append(r)
        r[0] = 1
        g = _grams(p)
        share = len(g & asked) / len(g) if g else 0.0
        r[_INDEX["echo_most" if share >= 0.75 else "echo_half" if share >= 0.45 else "echo_little"]] = 1
        r[_INDEX["length_short"]] = len(p) <= 12
        if cue:
            a, m, u, f = bool(_APOLOGY.search(p)), bool(_MACHINE.search(p)), bool(_UNABLE.search(p)), bool(_REFERRAL.search(p))
            r[_INDEX["apology"]], r[_INDEX["machine"]], r[_INDEX["unable"]], r[_INDEX["referral"]] = a, m, u, f
            r[_INDEX["unable_with"]] = u and (a or m or f)
            r[_INDEX["after_refusal_words"]] = refused
            refused = refused or u
        r[_INDEX["no_language" if lang is None or want is None else "native" if lang == want else "foreign"]] = 1
        listed = bool(_LIST.match(p))
        figure = listed and bool(_FIGURE.search(p))
        if i == len(parts) - 1:
            end = bool(_TERMINAL.search(p))
            point = lang == "zh" and bool(_POINT.search(p))
            dangling = bool(_DANGLING.search(p))
            r[_INDEX["last"]] = 1
            r[_INDEX["last_figure_point"]] = point
            r[_INDEX["last_dangling"]] = dangling
            r[_INDEX["last_terminal"]] = end and not point and not dangling
            # A list line needs no full stop; one without the figure that the lines before it have is odd.
            r[_INDEX["last_list"]] = listed and not dangling and (figure or not figures)
            r[_INDEX["last_list_odd"]] = listed and not figure and figures > 0
            r[_INDEX["last_open"]] = not end and not listed
        figures += figure
    return np.array(rows, dtype=np.float32).reshape(len(parts), len(FEATURES)), parts


class Field:
    """Linear-chain conditional random field: clause weights, tag transitions and starts."""

    def __init__(self, w: np.ndarray, t: np.ndarray, s: np.ndarray):
        self.w, self.t, self.s = w, t, s

    @staticmethod
    def _pad(xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([len(x) for x in xs])
        out = np.zeros((len(xs), n.max(), xs[0].shape[1]), dtype=np.float32)
        for i, x in enumerate(xs):
            out[i, : len(x)] = x
        return out, n

    def tag(self, xs: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi over many sequences at once, shortest first so that padding stays small."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(xs)
        order = sorted((i for i in range(len(xs)) if len(xs[i])), key=lambda i: len(xs[i]))
        for at in range(0, len(order), 512):
            ids = order[at : at + 512]
            x, n = self._pad([xs[i] for i in ids])
            e = x @ self.w
            best, back = e[:, 0] + self.s, np.zeros(e.shape, dtype=np.int8)
            for k in range(1, e.shape[1]):
                total = best[:, :, None] + self.t
                live = (k < n)[:, None]
                back[:, k] = total.argmax(axis=1)
                best = np.where(live, total.max(axis=1) + e[:, k], best)
            last = best.argmax(axis=1)
            for j, i in enumerate(ids):
                path = np.zeros(n[j], dtype=int)
                path[-1] = last[j]
                for k in range(n[j] - 1, 0, -1):
                    path[k - 1] = back[j, k, path[k]]
                out[i] = path
        return out

    @classmethod
    def fit(cls, xs: list[np.ndarray], ys: list[np.ndarray], steps: int = STEPS, rate: float = RATE) -> Field:
        """The field that explains the tags `ys` of the feature rows `xs` best (gradient ascent with an L2 penalty)."""
        cuts = [(i, a) for i, v in enumerate(ys) for a in range(0, len(v), STRETCH)]
        first = np.array([a == 0 for _, a in cuts], dtype=float)[:, None]
        x, n = cls._pad([xs[i][a : a + STRETCH] for i, a in cuts])
        m, top, f = x.shape
        k = len(TAGS)
        y = np.zeros((m, top), dtype=int)
        for row, (i, a) in enumerate(cuts):
            y[row, : n[row]] = ys[i][a : a + STRETCH]
        live = np.arange(top)[None, :] < n[:, None]
        hot = np.eye(k)[y] * live[:, :, None]
        seen_w = np.einsum("mtf,mtk->fk", x, hot)
        seen_t = np.einsum("mtj,mtk->jk", hot[:, :-1], hot[:, 1:])
        seen_s = (hot[:, 0] * first).sum(axis=0)
        p = np.zeros(f * k + k * k + k)
        mom, var = np.zeros_like(p), np.zeros_like(p)
        lse = lambda a, axis: (b := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - b).sum(axis=axis))
        for step in range(1, steps + 1):
            w, t, s = p[: f * k].reshape(f, k), p[f * k : f * k + k * k].reshape(k, k), p[-k:]
            e = x @ w
            fwd, bwd = np.zeros((m, top, k)), np.zeros((m, top, k))
            fwd[:, 0] = e[:, 0] + s * first
            for i in range(1, top):
                fwd[:, i] = np.where(live[:, i, None], lse(fwd[:, i - 1][:, :, None] + t, 1) + e[:, i], fwd[:, i - 1])
            for i in range(top - 2, -1, -1):
                bwd[:, i] = np.where(live[:, i + 1, None], lse(t[None] + (e[:, i + 1] + bwd[:, i + 1])[:, None, :], 2), 0.0)
            z = lse(fwd[:, -1], 1)
            node = np.exp(fwd + bwd - z[:, None, None]) * live[:, :, None]
            edge = np.exp(fwd[:, :-1, :, None] + t + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None]) * live[:, 1:, None, None]
            grad = np.concatenate([(seen_w - np.einsum("mtf,mtk->fk", x, node)).ravel(), (seen_t - edge.sum(axis=(0, 1))).ravel(), seen_s - (node[:, 0] * first).sum(axis=0)]) / len(xs) - L2 * p
            mom, var = 0.9 * mom + 0.1 * grad, 0.99 * var + 0.01 * grad**2
            p = p + rate * (mom / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-8)
        return cls(p[: f * k].reshape(f, k), p[f * k : f * k + k * k].reshape(k, k), p[-k:])


# Refusals that the field learns the wording's features from.
_REFUSALS = {
    "zh": ("抱歉，我不能回答这个问题。", "很遗憾，我无法提供相关内容。如有其他问题欢迎继续提问。", "作为人工智能，我没有能力完成这个请求。", "我不便发表意见，请咨询专业人士。", "对不起，这超出了我的能力范围。", "由于内容政策，恕我无法协助。"),
    "en": ("I'm sorry, but I cannot answer this question.", "As an AI model, I am unable to view the file.", "I must decline to comment on this. Please consult an expert.", "Sorry, I can't help with that request.", "I do not have access to the page."),
}


def broken_examples(rows: list[tuple[str, str]], seed: int = 7) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Feature sequences and tags: whole pairs, and pairs broken on purpose."""
    rng = np.random.default_rng(seed)
    whole = lambda a: _TERMINAL.search(a) or _LIST.match(clauses(a)[-1])
    good = [(q, a) for q, a in rows if not placeholder(a) and len(a) > 40 and whole(a) and not _DANGLING.search(a) and not _UNABLE.search(a)]
    good = [(q, a) for q, a in good if len(_grams(a) & _grams(q)) < 0.5 * len(_grams(a))]
    by: dict[str, list[str]] = {}
    for q, a in good:
        by.setdefault(language(a) or "", []).append(a)
    # The foreign examples: other languages of the sample, and invented sentences where it has one language only.
    by.setdefault("de", []).append("Der Versuch wurde nach einer Stunde beendet. Die Werte lagen im Bereich der Rechnung und wurden nicht verändert.")
    by.setdefault("fr", []).append("Les essais ont été faits dans la salle. La valeur est dans la limite et les résultats sont stables.")
    by.setdefault("ru", []).append("Измерения были проведены на пяти образцах. Результаты не изменились после нагрева.")
    by.setdefault("ja", []).append("この結果は設計の値とほぼ同じであった。今後も観察を続ける必要がある。")
    by.setdefault("en", []).append("The test was stopped after an hour. The values were in the range of the model.")
    by.setdefault("zh", []).append("试验在一小时后结束。结果与计算值基本一致，没有出现变化。")
    xs, ys = [], []

    def add(q: str, a: str, tag: str, only_last: bool = False) -> None:
        x, parts = features([q], [a])[0]
        if len(parts):
            y = np.full(len(parts), TAGS.index("answer" if only_last else tag))
            if only_last:
                y[-1] = TAGS.index(tag)
            xs.append(x)
            ys.append(y)

    for q, a in good:
        lang = wanted(q, language(q))
        kind = int(rng.integers(0, 8))
        if kind <= 2:
            add(q, a, "answer")
        elif kind == 3:
            parts = clauses(a)
            tail = parts[-1].rstrip()
            if len(tail) > 8 and not _LIST.match(tail):
                add(q, "".join(parts[:-1]) + tail[: int(rng.integers(3, len(tail) - 3))], "unfinished", only_last=True)
        elif kind == 4:
            add(q, ("{}", "问题：{}", "“{}”", "{}{}", "Question: {}")[int(rng.integers(0, 5))].replace("{}", q), "echo")
        elif kind == 5:
            others = [k for k in by if k and k != lang]
            k = others[int(rng.integers(0, len(others)))]
            if lang:
                add(q, by[k][int(rng.integers(0, len(by[k])))], "foreign")
        elif kind == 6:
            said = _REFUSALS.get(lang or "", _REFUSALS["en"])
            add(q, said[int(rng.integers(0, len(said)))], "refusal")
        else:
            # the instruction again, and then an answer
            x, parts = features([q], [q + "\n" + a])[0]
            y = np.array([TAGS.index("echo" if r[_INDEX["echo_most"]] else "answer") for r in x])
            xs.append(x)
            ys.append(y)
    return xs, ys


def fit(pairs: DataFrame, id_col: str = "id", instruction: str = "instruction", answer: str = "answer", sample: int = SAMPLE) -> Field:
    """The field, from at most `sample` pairs in the order of a hash of their ids."""
    key = F.col(id_col).cast("string")
    chosen = pairs.filter(F.col(instruction).isNotNull() & F.col(answer).isNotNull()).select(F.xxhash64(key).alias("_h"), key.alias("_k")).orderBy("_h", "_k").limit(sample).select("_k").distinct()
    rows = pairs.select(key.alias("_k"), F.col(instruction).alias("_q"), F.col(answer).alias("_a")).filter("_q IS NOT NULL AND _a IS NOT NULL").join(F.broadcast(chosen), "_k").select("_k", "_q", "_a").distinct().orderBy("_k", "_q", "_a").collect()
    return Field.fit(*broken_examples([(r["_q"], r["_a"]) for r in rows]))


def decide(parts: list[str], tags: np.ndarray) -> tuple[str | None, list[float]]:
    """The pair's defect from its clauses' coverage, and the shares of the tags."""
    size = np.array([len(_JOIN.sub("", p)) or 1 for p in parts])
    share = [float(size[tags == k].sum() / size.sum()) for k in range(len(TAGS))]
    answer, refusal, echo, foreign, unfinished = share
    if refusal > 0 and answer + foreign + unfinished < 0.2:
        defect = "refusal"
    elif echo > 0 and answer + foreign + unfinished + refusal < 0.1:
        defect = "copy"
    elif foreign >= 0.5:
        defect = "language"
    elif tags[-1] == TAGS.index("unfinished"):
        defect = "truncated"
    elif refusal >= 0.5:
        defect = "refusal"
    else:
        defect = None
    return defect, share


def defects(pairs: DataFrame, field: Field, id_col: str = "id", instruction: str = "instruction", answer: str = "answer") -> DataFrame:
    """One row per pair with an instruction: its defect (NULL for none) and the tags' shares; columns as in DEFECTS.

    Pairs with a NULL instruction give no row. A NULL, blank or stand-in answer is 'empty' with shares of 0. Repeated rows come
    again; other columns are ignored.
    """
    shared = pairs.sparkSession.sparkContext.broadcast((field.w, field.t, field.s))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = Field(*shared.value)
        for b in batches:
            rows: list = [None] * len(b)
            asked, said, which = [], [], []
            for i, (uid, q, a) in enumerate(zip(b["_id"], b["_q"], b["_a"])):
                if placeholder(a):
                    rows[i] = (uid, "empty", 0.0, 0.0, 0.0, 0.0, 0.0)
                    continue
                asked.append(q)
                said.append(a)
                which.append(i)
            got = features(asked, said)
            for i, (_, parts), tags in zip(which, got, f.tag([x for x, _ in got])):
                defect, share = decide(parts, tags)
                rows[i] = (b["_id"].iloc[i], defect, *share)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in DEFECTS.split(", ")])

    src = pairs.select(F.col(id_col).cast("string").alias("_id"), F.col(instruction).alias("_q"), F.col(answer).alias("_a")).filter("_id IS NOT NULL AND _q IS NOT NULL")
    return src.mapInPandas(run, DEFECTS)
