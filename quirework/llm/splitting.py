"""Oversized texts cut into pieces, content-defined.

A rolling hash over the last WINDOW characters marks landmarks; a landmark depends on nothing but those
characters, so an edit moves only the cuts beside it. Each cut is the natural boundary nearest to a landmark
within the piece's allowed sizes; without a landmark the last natural boundary that fits; without a boundary
the limit itself. Every piece after the first begins with the last `overlap` characters of the piece before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters under the rolling hash; one place in MASK + 1 is a landmark, so pieces of a 1,000-character limit see several.
WINDOW = 16
MASK = 127
_MULTIPLIER = 0x5851F42D4C957F2D
#: A boundary lies after one of these signs, and after a full stop that white space or the end follows.
BOUNDARY = re.compile(r"[。！？；!?;\n]|\.(?=\s|\Z)")
PIECES = "id bigint, piece int, n_pieces int, char_start int, char_end int, new_start int, cut string, longest_stretch int, n_chars int, text string"
_COLUMNS = [c.split()[0] for c in PIECES.split(", ")]


def boundaries(text: str) -> np.ndarray:
    """Ends of the stretches of `text`, its end included."""
    found = [m.end() for m in BOUNDARY.finditer(text)]
    if not found or found[-1] != len(text):
        found.append(len(text))
    return np.array(found)


def landmarks(text: str) -> np.ndarray:
    """Places after which the rolling hash of the last WINDOW characters is 0 under MASK."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(code) < WINDOW:
        return np.zeros(0, dtype=np.int64)
    acc = np.zeros(len(code) - WINDOW + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            acc = acc * np.uint64(_MULTIPLIER) + code[k : k + len(acc)]
        acc ^= acc >> np.uint64(33)
        acc *= np.uint64(0xFF51AFD7ED558CCD)
        acc ^= acc >> np.uint64(33)
    return np.flatnonzero((acc & np.uint64(MASK)) == 0) + WINDOW


def pieces(text: str, max_size: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start with overlap, end, start of what is new) of the pieces of `text`."""
    n = len(text)
    if n <= max_size:
        return [(0, n, 0)]
    ends, marks = boundaries(text), landmarks(text)
    out: list[tuple[int, int, int]] = []
    at = 0
    while at < n:
        start = at - overlap if out else 0
        last = start + max_size
        if last >= n:
            out.append((start, n, at))
            break
        least = at + max(1, (max_size - overlap) // 4)
        lo, hi = np.searchsorted(ends, at, "right"), np.searchsorted(ends, last, "right")
        fit = ends[lo:hi]
        if len(fit):
            good = fit[fit >= least]
            near = marks[np.searchsorted(marks, least, "left") : np.searchsorted(marks, last, "right")]
            if len(good) and len(near):
                to = int(good[np.argmin(np.abs(good - near[0]))])
            else:
                to = int(fit[-1])
        else:
            to = last
        out.append((start, to, at))
        at = to
    return out


def split(df: DataFrame, id_col: str, text_col: str, max_size: int, overlap: int) -> DataFrame:
    """The pieces of each text in order; columns as in PIECES.

    `cut` is 'whole' for a text within max_size, 'forced' where a stretch between boundaries is itself longer than
    max_size, else 'natural'. new_start is where a piece goes beyond its predecessor, so text[new_start:char_end] of all
    pieces is the text again. NULL and empty texts give no piece; repeated rows come again; extra columns are ignored.
    """
    if not 0 <= overlap < max_size:
        raise ValueError("overlap must be at least 0 and below max_size")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for uid, text in zip(b["_id"], b["_t"]):
                got = pieces(text, max_size, overlap)
                stretch = int(np.diff(boundaries(text), prepend=0).max())
                kind = "whole" if len(text) <= max_size else "forced" if stretch > max_size else "natural"
                rows += [(uid, i, len(got), s, e, a, kind, stretch, len(text), text[s:e]) for i, (s, e, a) in enumerate(got)]
            yield pd.DataFrame(rows, columns=_COLUMNS)

    src = df.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_t")).filter("_id IS NOT NULL AND _t <> ''")
    return src.mapInPandas(run, PIECES)
