"""Held-out test items inside corpus documents, found with spaced seeds.

Tokens are comparable characters: letters and digits after NFKC and lower-casing. A mask fixes which of
the tokens under a window enter its hash; the others may differ, so a hit survives a substitution there.
Every window of every test item is indexed, and documents are probed at every window. The two masks are
chosen so that none of the overlaps asked for is missed: f(n), the fewest substitutions among n tokens that
leave no window of either mask whole, is more than n / 10 for n = 40..79 (counted over all placements, see
the tests), and f(a + b) >= f(a) + f(b) carries that on to all longer ones. Around each hit the two texts
are compared along the hit's diagonal: the longest equal run, and the longest overlap in which at most a
given share of tokens is substituted.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.sources.tables import bit_table, screened

#: A mask keeps four blocks of three tokens: three that both masks share, and one of LAST each; its window ends with that.
BLOCK, SHARED, LAST = 3, (0, 3, 7), (11, 14)
SPANS = tuple(x + BLOCK for x in LAST)
#: Hits of one document that are looked up at a time.
HITS_AT_ONCE = 256
MIN_RUN = 40
#: Substituted share at most, within a tolerant overlap, and its least length.
TOLERANCE = 0.1
MIN_TOLERANT = 40
#: Items whose comparable text together is longer than this (characters) take the join instead of the broadcast; the rows are the same.
MAX_BROADCAST_CHARS = 4_000_000
#: In the join, bits of the table that tells which seeds some item has (16 MB, whatever the items), and parts that every seed is split into, as stock wording may be in a third of all rows.
SCREEN_BITS, PARTS = 1 << 27, 16

_SKIP = re.compile(r"[\W_]+")
OVERLAPS = "doc_id bigint, item_id bigint, exact_run int, tolerant_run int, substitutions int, doc_start int, item_start int"
HITS = "doc_id bigint, doc_pos int, seed bigint"


def comparable(text: str | None) -> str:
    """Letters and digits of `text` after compatibility folding and lower-casing; '' for NULL."""
    if not text:
        return ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return _SKIP.sub("", text.lower())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _mixed(acc: np.ndarray, block: np.ndarray) -> np.ndarray:
    acc = (acc ^ block) * np.uint64(0x9E3779B97F4A7C15)
    return acc ^ (acc >> np.uint64(29))


def seeds(code: np.ndarray) -> list[np.ndarray]:
    """Seed hashes of all windows, one array per mask; the window at place i has index i, and each mask has as many as fit."""
    n = len(code) - min(SPANS) + 1
    if n <= 0:
        return [np.zeros(0, np.int64) for _ in LAST]
    c = code.astype(np.uint64)
    block = c[:-2] | (c[1:-1] << np.uint64(21)) | (c[2:] << np.uint64(42))  # a code has 21 bits
    acc = np.full(n, 0xC2B2AE3D27D4EB4F, dtype=np.uint64)
    for at in SHARED:
        acc = _mixed(acc, block[at : at + n])
    out = []
    for m, (at, span) in enumerate(zip(LAST, SPANS)):
        k = max(0, len(code) - span + 1)
        out.append(_mixed(acc[:k] + np.uint64(m), block[at : at + k]).view(np.int64))
    return out


class SeedIndex:
    """Windows of all test items, sorted by seed; a bit table answers most misses."""

    BITS = 22

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = np.array(ids, dtype=np.int64)
        self.code = [codes(t) for t in texts]
        found, owner, place = [], [], []
        for k, c in enumerate(self.code):
            for row in seeds(c):
                found.append(row)
                owner.append(np.full(len(row), k, dtype=np.int32))
                place.append(np.arange(len(row), dtype=np.int32))
        seed = np.concatenate(found) if found else np.zeros(0, np.int64)
        order = np.argsort(seed, kind="stable")
        self.seed = seed[order]
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, np.int32)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, np.int32)
        self.bits = np.zeros(1 << self.BITS, dtype=bool)
        self.bits[self._slot(self.seed)] = True

    def _slot(self, seed: np.ndarray) -> np.ndarray:
        return (seed.view(np.uint64) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def hits(self, seed: np.ndarray) -> np.ndarray:
        """Indexes of the seeds that some item has."""
        maybe = np.flatnonzero(self.bits[self._slot(seed)])
        if not len(maybe) or not len(self.seed):
            return maybe[:0]
        at = np.minimum(np.searchsorted(self.seed, seed[maybe]), len(self.seed) - 1)
        return maybe[self.seed[at] == seed[maybe]]

    def partners(self, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each seed all (index of the seed, item, place) with that seed."""
        lo, hi = np.searchsorted(self.seed, seed, "left"), np.searchsorted(self.seed, seed, "right")
        n = hi - lo
        which = np.repeat(np.arange(len(seed)), n)
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return which, self.owner[at], self.place[at]


_indexed: list = [None, None]


def index_of(items: tuple) -> SeedIndex:
    """The index of broadcast items, built once by each Python worker and not by each task: the value of a broadcast is one object there."""
    if _indexed[0] is not items:
        _indexed[:] = [items, SeedIndex(*items)]
    return _indexed[1]


def compare(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int, int, int]:
    """Along the diagonal doc position = item position + shift: (longest equal run, longest tolerant overlap, its substitutions, its start in the document, in the item)."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    if hi <= lo:
        return 0, 0, 0, 0, 0
    equal = doc[lo + shift : hi + shift] == item[lo:hi]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return 0, 0, 0, 0, 0
    exact = int((ends - starts).max())
    # A tolerant overlap begins and ends with an equal token; score equal +TOLERANCE, substituted -(1 - TOLERANCE), so that a sum of 0 or more means at most TOLERANCE substituted.
    total = np.concatenate(([0.0], np.cumsum(np.where(equal, TOLERANCE, TOLERANCE - 1))))
    best = (0, 0, 0)
    high = np.maximum.accumulate(total[::-1])[::-1]
    for s in starts:
        # the farthest end whose running sum isn't below the start's
        e = int(np.searchsorted(-high, -(total[s] - 1e-9), "right")) - 1
        if e - s > best[0]:
            best = (e - int(s), int(s), e)
    length, s, e = best
    return exact, length, int((~equal[s:e]).sum()), lo + shift + s, lo + s


def overlaps(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "item_text") -> DataFrame:
    """One row for each document and item with an exact run of MIN_RUN or a tolerant overlap of MIN_TOLERANT comparable characters, in any of its alignments; the best of each measure.

    NULL and empty texts hold nothing; repeated rows of a document count once; other columns of either input are ignored.
    Small item sets (checked size) are broadcast and the documents read once; larger ones are joined on the seeds.
    """
    it = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("item_text")).filter("item_id IS NOT NULL AND item_text IS NOT NULL")
    dc = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    chars = it.agg(F.sum(F.length("item_text"))).first()[0] or 0
    out = _overlaps_broadcast(dc, it) if chars <= MAX_BROADCAST_CHARS else _overlaps_joined(dc, it)
    return out.groupBy("doc_id", "item_id").agg(F.max("exact_run").alias("exact_run"), F.max_by(F.struct("tolerant_run", "substitutions", "doc_start", "item_start"), F.struct("tolerant_run", -F.col("doc_start"))).alias("best")).select("doc_id", "item_id", "exact_run", "best.*")


def _keep(exact: int, tolerant: int) -> bool:
    return exact >= MIN_RUN or tolerant >= MIN_TOLERANT


def _overlaps_broadcast(docs: DataFrame, items: DataFrame) -> DataFrame:
    rows = items.collect()
    shared = docs.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [comparable(r[1]) for r in rows]))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = index_of(shared.value)
        for batch in batches:
            found = []
            for doc, text in zip(batch["doc_id"].to_numpy(), batch["text"]):
                code = codes(comparable(text))
                best: dict[int, list[tuple]] = {}
                seen = set()
                for row in seeds(code):
                    all_hits = index.hits(row)
                    for at in range(0, len(all_hits), HITS_AT_ONCE):
                        hit = all_hits[at : at + HITS_AT_ONCE]
                        which, owner, place = index.partners(row[hit])
                        for k, shift in set(zip(owner.tolist(), (hit[which] - place).tolist())) - seen:
                            seen.add((k, shift))
                            r = compare(code, index.code[k], shift)
                            if _keep(r[0], r[1]):
                                best.setdefault(k, []).append(r)
                found += [(doc, index.ids[k], *r) for k, rs in best.items() for r in rs]
            yield pd.DataFrame(found, columns=[c.split()[0] for c in OVERLAPS.split(", ")])

    return docs.mapInPandas(probe, OVERLAPS)


def _item_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for item, text in zip(batch["item_id"], batch["item_text"]):
            code = codes(comparable(text))
            for row in seeds(code):
                yield pd.DataFrame({"item_id": item, "item_pos": np.arange(len(row)), "seed": row})


def _doc_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for doc, text in zip(batch["doc_id"], batch["text"]):
            code = codes(comparable(text))
            for row in seeds(code):
                yield pd.DataFrame({"doc_id": doc, "doc_pos": np.arange(len(row)), "seed": row})


def _overlaps_joined(docs: DataFrame, items: DataFrame, bits: int = SCREEN_BITS, parts: int = PARTS) -> DataFrame:
    """The same rows by a shuffle join on the seeds, for item sets of any size.

    Only seeds whose bit is set are shuffled. A seed's documents are spread over `parts` keys and its items copied to each, so that no seed is one task's. Then each document's text meets each of its items once, with all alignments to compare.
    """
    item_seeds = items.mapInPandas(_item_seeds, "item_id bigint, item_pos int, seed bigint")
    doc_seeds = screened(docs.mapInPandas(_doc_seeds, HITS), F.col("seed"), bit_table(item_seeds, "seed", bits), bits).filter("_maybe")
    spread = doc_seeds.select("doc_id", "doc_pos", "seed", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part"))
    copied = item_seeds.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
    hits = spread.join(copied, ["seed", "part"]).groupBy("doc_id", "item_id").agg(F.collect_set(F.col("doc_pos") - F.col("item_pos")).alias("shifts"))
    both = hits.join(docs.dropDuplicates(["doc_id"]), "doc_id").join(items, "item_id")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = []
            for doc, item, shifts, text, item_text in zip(b["doc_id"], b["item_id"], b["shifts"], b["text"], b["item_text"]):
                one, two = codes(comparable(text)), codes(comparable(item_text))
                for shift in shifts:
                    r = compare(one, two, int(shift))
                    if _keep(r[0], r[1]):
                        found.append((doc, item, *r))
            yield pd.DataFrame(found, columns=[c.split()[0] for c in OVERLAPS.split(", ")])

    return both.mapInPandas(verify, OVERLAPS)
