"""Repetition inside one text, seen through a public tokenizer.

For each text the operator measures what a public vocabulary says of it: characters per token (fertility), the
share of byte-fallback tokens, the entropy of its tokens and that of pairs of neighbouring tokens. In a text
that says nothing twice nearly every pair is new and the pair entropy reaches log2 of the number of pairs; the
gap to that bound (`pair_deficit`, bits) grows with what is said again. These figures weigh tokens, and a repeat in
few long tokens hardly moves them, so they decide nothing about repetition: the share of character runs that occurred
before is counted exactly for every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
#: Runs of this many characters, white space removed; texts with fewer runs are never cases.
RUN = 15
MIN_RUNS = 20
SHARE = 0.3
CHUNK = 1000
#: Rejection bands: fertility as a multiple of what the vocabulary gives for the script, byte-fallback share at most, token entropy as a part of the highest possible at least; all only from so many tokens on.
FERTILITY, BYTE_SHARE, ENTROPY, FEWEST_TOKENS = (0.4, 1.5), 0.5, 0.5, 20

PROFILE = "id string, field_name string, script string, n_chars int, n_tokens int, chars_per_token double, byte_share double, token_entropy double, token_deficit double, pair_deficit double, repeated_share double"
_COLUMNS = [c.split()[0] for c in PROFILE.split(", ")]
_SPACE = re.compile(r"\s+")
_SCRIPTS = (("kana", re.compile(r"[぀-ヿ]")), ("han", re.compile(r"[㐀-鿿]")), ("cyrillic", re.compile(r"[Ѐ-ӿ]")), ("latin", re.compile(r"[A-Za-z]")))
_models: dict[str, tuple] = {}


def model(directory: str) -> tuple:
    """The SentencePiece processor and its byte-fallback flags, loaded once per worker."""
    if directory not in _models:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=f"{directory}/{MODEL}")
        _models[directory] = sp, np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])
    return _models[directory]


def script_of(text: str) -> str:
    """The script of most letters; kana wins over han as soon as a twentieth is kana."""
    n = {name: len(found.findall(text)) for name, found in _SCRIPTS}
    if n["kana"] > 0.05 * (n["kana"] + n["han"]):
        n["kana"] += n["han"]
    best = max(n, key=n.get)
    return best if n[best] else "other"


def repeated_share(text: str, run: int = RUN, min_runs: int = MIN_RUNS) -> float:
    """1 - different runs / all runs of `run` characters, white space removed; 0 with fewer than `min_runs` runs."""
    s = _SPACE.sub("", text)
    n = len(s) - run + 1
    return 1 - len({s[i : i + run] for i in range(n)}) / n if n >= min_runs else 0.0


def _deficit(keys: np.ndarray, owner_shift: int, n: np.ndarray) -> np.ndarray:
    """log2(n) - entropy for each owner (the key's high bits) of n keys."""
    u, c = np.unique(keys, return_counts=True)
    owner = (u >> owner_shift).astype(np.int64)
    return np.bincount(owner, weights=c * np.log2(c), minlength=len(n)) / np.maximum(n, 1)


def measure(texts: list[str], directory: str) -> pd.DataFrame:
    sp, is_byte = model(directory)
    ids = sp.encode(texts, num_threads=1)
    n = np.array([len(x) for x in ids], dtype=np.int64)
    flat = np.fromiter((t for x in ids for t in x), dtype=np.int64, count=int(n.sum()))
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), n)
    token = _deficit((owner << 20) | flat, 20, n)
    same = owner[:-1] == owner[1:] if len(owner) else np.zeros(0, bool)
    pairs = ((owner[:-1] << 40) | (flat[:-1] << 20) | flat[1:])[same] if len(owner) else flat
    pair = _deficit(pairs, 40, np.maximum(n - 1, 0))
    byte = np.bincount(owner, weights=is_byte[flat], minlength=len(texts)) / np.maximum(n, 1)
    chars = np.array([len(t) for t in texts])
    return pd.DataFrame({"n_chars": chars, "n_tokens": n, "chars_per_token": chars / np.maximum(n, 1), "byte_share": byte, "token_entropy": np.log2(np.maximum(n, 1)) - token, "token_deficit": token, "pair_deficit": pair})


def profile(df: DataFrame, id_col: str, fields: list[str], tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """One row per row of `df` and non-empty field, columns as in PROFILE.

    repeated_share is counted for every text, 0 with fewer than MIN_RUNS runs. NULL and empty fields give no row;
    equal texts in two fields of a row are measured once; repeated rows come again; other columns are ignored.
    """
    cols = [f"_f{i}" for i in range(len(fields))]
    src = df.select(F.col(id_col).cast("string").alias("_id"), *(F.col(f).alias(c) for f, c in zip(fields, cols)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                b = batch.iloc[at : at + CHUNK]
                place: dict[str, int] = {}
                ids, names, which = [], [], []
                for row in zip(b["_id"], *(b[c] for c in cols)):
                    for name, text in zip(fields, row[1:]):
                        if text:
                            ids.append(row[0])
                            names.append(name)
                            which.append(place.setdefault(text, len(place)))
                if not place:
                    continue
                texts = list(place)
                m = measure(texts, tokenizer_dir)
                m["script"] = [script_of(t) for t in texts]
                m["repeated_share"] = [repeated_share(t) for t in texts]
                out = m.iloc[which].reset_index(drop=True)
                out["id"], out["field_name"] = ids, names
                yield out[_COLUMNS]

    return src.mapInPandas(run, PROFILE)


def bands(tokenizer_dir: str = TOKENIZER_DIR) -> dict[str, tuple[float, float]]:
    """script -> (least, most) characters per token, from the vocabulary alone.

    Pieces are numbered by how early they were merged, so 1 / rank stands for how often one is met; the mean length of a script's pieces so weighted is its typical fertility.
    Scripts without pieces of their own (and texts without letters) have that of all pieces.
    """
    sp, is_byte = model(tokenizer_dir)
    length: dict[str, float] = {}
    weight: dict[str, float] = {}
    for i in range(sp.get_piece_size()):
        if not (is_byte[i] or sp.is_control(i) or sp.is_unknown(i)):
            piece = sp.id_to_piece(i).replace("\u2581", " ")
            for s in (script_of(piece), "other"):
                length[s] = length.get(s, 0.0) + len(piece) / (i + 1)
                weight[s] = weight.get(s, 0.0) + 1 / (i + 1)
    typical = {s: length[s] / weight[s] for s in length}
    return {s: (typical.get(s, typical["other"]) * FERTILITY[0], typical.get(s, typical["other"]) * FERTILITY[1]) for s in (*(name for name, _ in _SCRIPTS), "other")}


def rejected(profiles: DataFrame, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """`profiles` with a column `reasons` (empty if none): fertility outside the band of its script, byte-fallback share or token entropy outside the common band, or repeated_share of SHARE and more.

    The bands come from the vocabulary and from fixed parameters, so a text is judged alike in every table. Texts of fewer than FEWEST_TOKENS tokens can only be repeated.
    """
    table = bands(tokenizer_dir)
    low, high = (F.create_map(*[F.lit(x) for s, b in table.items() for x in (s, b[k])])[F.col("script")] for k in (0, 1))
    told = F.col("n_tokens") >= FEWEST_TOKENS
    return profiles.withColumn("reasons", F.array_compact(F.array(
        F.when(told & ~F.col("chars_per_token").between(low, high), F.lit("fertility")),
        F.when(told & (F.col("byte_share") > BYTE_SHARE), F.lit("byte_fallback")),
        F.when(told & (F.col("token_entropy") < F.log2("n_tokens") * ENTROPY), F.lit("entropy")),
        F.when(F.col("repeated_share") >= SHARE, F.lit("repeated")),
    )))
