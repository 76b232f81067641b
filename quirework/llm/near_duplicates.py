"""Near-duplicate texts by overlap of their character n-grams.

The similarity is that of two sets of n-grams (common / in either). Exact copies are folded into one
representative first. The sparse document x n-gram incidence matrix is multiplied with its transpose in blocks
only: a block holds representatives that agree in one band of ROWS min-hash values, over BANDS bands; a large block is
multiplied in cells. Within the blocks a pair is dropped by its sizes alone (the smaller must have at least `threshold` of the larger)
before any text is fetched, and for the rest overlap counts are accumulated and pairs below threshold / (1 + threshold) * (sizes) dropped.
With 256 hash values, 64 bands of 8 of them (drawn once) a pair of similarity 0.8 shares no block with a probability of
1.8e-4, one of 0.82 of 3.1e-5, one of 0.85 of 1.1e-6 (binomial in the equal hash values); pairs of 0.3 share one with 4e-3.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.operators.components import least_labels
from quirework.session import checkpoint

N = 3
THRESHOLD = 0.8
HASHES, ROWS, BANDS = 256, 8, 64
#: A block of more members is multiplied in cells of about so many by so many.
CELL = 1000
_DROP = re.compile(r"\W+")
_RNG = np.random.default_rng(20240607)
_A = (_RNG.integers(1, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_BAND = np.array([_RNG.permutation(HASHES)[:ROWS] for _ in range(BANDS)])
_MIX = _RNG.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def clean(text: str | None) -> str:
    """Lower case, letters, digits and underscore only; '' for NULL."""
    return _DROP.sub("", text.lower()) if text else ""


def grams(text: str) -> np.ndarray:
    """Distinct n-grams of `text` as sorted exact codes (21 bits a character); a text shorter than N has none."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(c) < N:
        return np.zeros(0, dtype=np.uint64)
    return np.unique((c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:])


def band_keys(gram: np.ndarray) -> np.ndarray:
    """BANDS block keys of a text."""
    with np.errstate(over="ignore"):
        h = gram * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h32 = (h >> np.uint64(32)).astype(np.uint32)
        low = (_A[:, None] * h32[None, :] + _B[:, None]).min(axis=1).astype(np.uint64)
        key = (low[_BAND] * _MIX).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
        key *= np.uint64(0x2545F4914F6CDD1D)
    return key.view(np.int64)


def _prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        body = [clean(x) for x in b["_body"]]
        yield pd.DataFrame({"id": b["_id"], "clean": [clean(h) + t for h, t in zip(b["_head"], body)], "n_body": [len(t) for t in body]})


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), 2000):
            part = b.iloc[at : at + 2000]
            rows = [g for g in map(grams, part["clean"]) if len(g)]
            reps = [r for r, t in zip(part["rep"], part["clean"]) if len(t) >= N]
            if rows:
                size = np.array([len(g) for g in rows], dtype=np.int32)
                yield pd.DataFrame({"rep": np.repeat(np.array(reps, dtype=np.int64), BANDS), "size": np.repeat(size, BANDS), "block": np.concatenate([band_keys(g) for g in rows])})


def _overlap(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            place: dict[str, int] = {}
            ia = np.array([place.setdefault(t, len(place)) for t in b["clean_a"]])
            ib = np.array([place.setdefault(t, len(place)) for t in b["clean_b"]])
            rows = [grams(t) for t in place]
            size = np.array([len(r) for r in rows])
            common = np.zeros(len(b), dtype=np.int64)
            fits = np.minimum(size[ia], size[ib]) >= threshold * np.maximum(size[ia], size[ib])
            for k in np.flatnonzero(fits):
                common[k] = len(np.intersect1d(rows[ia[k]], rows[ib[k]], assume_unique=True))
            total = size[ia] + size[ib]
            keep = fits & (common * (1 + threshold) >= threshold * total - 1e-9)
            yield pd.DataFrame({"rep_a": b["rep_a"][keep], "rep_b": b["rep_b"][keep], "similarity": common[keep] / (total - common)[keep]})

    return run


def _parts(df: DataFrame, id_col: str, head: str, body: str, min_chars: int) -> DataFrame:
    src = df.select(F.col(id_col).cast("string").alias("_id"), F.col(head).alias("_head"), F.col(body).alias("_body")).filter("_id IS NOT NULL AND _body IS NOT NULL")
    src = src.filter(F.length("_body") >= min_chars)
    return src.mapInPandas(_prepare, "id string, clean string, n_body int").filter(F.col("n_body") >= min_chars).withColumn("rep", F.xxhash64("clean"))


def meet(rows: DataFrame, key: str, item: str, fits: Column | None = None, cell: int = CELL) -> DataFrame:
    """Each two different items of a key once, (x, y) with x.item < y.item, as structs of the columns of `rows` without the key; `fits` may name columns as x.c and y.c.

    Keys of one item are dropped where they are counted. A key of many items is cut into parts of about `cell`, and each two of its parts meet in a key of their own: no task has a whole hot
    key, and none has more than cell x cell pairs of it on average. Items should come once in a key.
    """
    other = [c for c in rows.columns if c != key]
    counted = rows.withColumn("_n", F.count("*").over(W.partitionBy(key))).filter("_n > 1")
    parts = F.ceil(F.col("_n") / cell).cast("int")
    of = counted.select(key, F.struct(*other).alias("r"), F.pmod(F.xxhash64(item), parts).cast("int").alias("own"), F.sequence(F.lit(0), parts - 1).alias("parts"))
    x = of.select(key, F.col("r").alias("x"), F.col("own").alias("i"), F.explode("parts").alias("j"))
    y = of.select(key, F.col("r").alias("y"), F.explode("parts").alias("i"), F.col("own").alias("j"))
    two = x.join(y, [key, "i", "j"]).filter(F.col(f"x.{item}") < F.col(f"y.{item}"))
    return (two if fits is None else two.filter(fits)).select("x", "y")


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), 500):
            part = b.iloc[at : at + 500]
            rows = [grams(t) for t in part["clean"]]
            size = np.array([len(g) for g in rows], dtype=np.int32)
            yield pd.DataFrame({"rep": np.repeat(part["rep"].to_numpy(), size), "size": np.repeat(size, size), "gram": np.concatenate([np.zeros(0, dtype=np.uint64), *rows]).astype(np.int64)})


def exact_candidates(reps: DataFrame, threshold: float) -> DataFrame:
    """(rep_a, rep_b): a superset of all pairs of `threshold`, without chance. `reps`: rep, clean.

    A text's n-grams are ordered from rare to frequent; two texts of that similarity share one among the first n - ceil(threshold * n) + 1 of each. Hot n-grams meet in cells. Its work grows with the square of the texts
    once new texts bring no new n-grams, so it is for tables where that can be paid.
    """
    every = reps.select("rep", "clean").mapInPandas(_counted, "rep bigint, size int, gram bigint")
    seen = every.groupBy("gram").agg(F.count("*").alias("df"))
    rank = F.row_number().over(W.partitionBy("rep").orderBy("df", "gram"))
    head = every.join(seen, "gram").withColumn("r", rank).filter(F.col("r") <= F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1)
    near = F.least("x.size", "y.size") >= F.lit(threshold) * F.greatest("x.size", "y.size")
    return meet(head.select("gram", "rep", "size"), "gram", "rep", near).select(F.col("x.rep").alias("rep_a"), F.col("y.rep").alias("rep_b")).distinct()


def links(df: DataFrame, id_col: str, head: str, body: str, min_chars: int = 200, threshold: float = THRESHOLD, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, links): members has one row (id, rep) per different id and text, links the pairs rep_a < rep_b of different texts whose similarity is at least `threshold`.

    The compared text is head directly followed by body, cleaned; texts whose cleaned body has fewer than `min_chars`
    characters take no part, nor do NULL ids and bodies; a NULL head is empty. Repeated rows count once. Other columns are ignored.
    With `exact` no pair is missed, at a higher cost (`exact_candidates`).
    """
    parts = _parts(df, id_col, head, body, min_chars)
    members = checkpoint(parts.select("id", "rep").distinct())  # two numbers a text, read several times; the texts are cleaned once less
    reps = parts.groupBy("rep").agg(F.first("clean").alias("clean"))
    blocks = reps.mapInPandas(_sign, "rep bigint, size int, block bigint")
    near = F.least("x.size", "y.size") >= F.lit(threshold) * F.greatest("x.size", "y.size")
    pairs = exact_candidates(reps, threshold) if exact else meet(blocks, "block", "rep", near).select(F.col("x.rep").alias("rep_a"), F.col("y.rep").alias("rep_b")).distinct()
    both = pairs.join(reps.select(F.col("rep").alias("rep_a"), F.col("clean").alias("clean_a")), "rep_a").join(reps.select(F.col("rep").alias("rep_b"), F.col("clean").alias("clean_b")), "rep_b")
    return members, both.mapInPandas(_overlap(threshold), "rep_a bigint, rep_b bigint, similarity double")


def pairs(members: DataFrame, linked: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all ids of linked texts, and ids of one text."""
    m = lambda s: members.select(F.col("id").alias(f"_id_{s}"), F.col("rep").alias(f"rep_{s}"))
    far = linked.join(m("a"), "rep_a").join(m("b"), "rep_b").select("_id_a", "_id_b")
    near = meet(members, "rep", "id").select(F.col("x.id").alias("_id_a"), F.col("y.id").alias("_id_b"))
    return far.filter("_id_a <> _id_b").unionByName(near).select(F.least("_id_a", "_id_b").alias("id_a"), F.greatest("_id_a", "_id_b").alias("id_b")).distinct()


def classes(members: DataFrame, linked: DataFrame) -> DataFrame:
    """One row per id and text: text_id (the least id with that text), class_id (the least id of all texts that links lead to) and n_links (links of its text to other texts). Copies are counted by their common text, never in pairs."""
    label = least_labels(linked.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))).withColumnRenamed("u", "rep")
    ends = linked.select(F.explode(F.array("rep_a", "rep_b")).alias("rep"))
    degree = ends.groupBy("rep").agg(F.count("*").alias("n_links"))
    texts = members.groupBy("rep").agg(F.min("id").alias("text_id")).join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    named = texts.groupBy("label").agg(F.min("text_id").alias("class_id"))
    whole = texts.join(named, "label").join(degree, "rep", "left").select("rep", "text_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return members.join(whole, "rep").select("id", "text_id", "class_id", "n_links")
