"""Documents into containers of fixed token capacity.

Sizes are tokens of the public ByT5 tokenizer: one per UTF-8 byte and one end-of-sequence token per item. Documents
larger than a container are cut at code points into pieces that fill containers; everything else stays whole.
Packing is best-two-fit: a container is filled greedily with the largest remaining item that fits, then its
smallest item is put back if two remaining items fill the widened gap more tightly.
Only identifiers and sizes are shuffled, into shards of about SHARD items; each shard is packed by itself and
leaves at most its last containers underfilled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items per shard. A shard's working set is a few bytes an item, and its loss a few containers.
SHARD = 50_000
PACKED = "doc_id bigint, piece int, n_pieces int, char_start bigint, n_chars bigint, tokens int, container bigint"


def best_two_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """The container of each item (sizes of 1 to capacity), and the number of containers."""
    order = np.argsort(-sizes, kind="stable")
    count = np.bincount(sizes, minlength=capacity + 1)
    first = np.zeros(capacity + 2, dtype=np.int64)  # items of one size are consecutive in order
    first[:-1] = len(sizes) - np.cumsum(count)
    taken = np.zeros(capacity + 1, dtype=np.int64)
    home = np.full(len(sizes), -1, dtype=np.int64)
    present = np.flatnonzero(count)
    left, bins = len(sizes), 0

    def take(size: int) -> int:
        item = order[first[size] + taken[size]]
        taken[size] += 1
        count[size] -= 1
        return int(item)

    while left:
        present = present[count[present] > 0]
        gap, inside = capacity, []
        hi = len(present)
        while True:
            hi = int(np.searchsorted(present[:hi], gap, "right"))
            while hi and count[present[hi - 1]] == 0:
                hi -= 1
            if not hi:
                break
            size = int(present[hi - 1])
            inside.append((size, take(size)))
            gap -= size
        if gap and len(inside) > 1:
            small, item = inside[-1]
            wide = gap + small
            live = present[(count[present] > 0) & (present < wide)]
            if len(live):
                # For each first size the largest second size that still fits; a size can be its own partner only if it is there twice.
                at = np.searchsorted(live, wide - live, "right") - 1
                ok = at >= 0
                lone = ok & (at == np.arange(len(live))) & (count[live] < 2)
                at[lone] -= 1
                ok &= at >= 0
                total = np.where(ok, live + live[np.maximum(at, 0)], 0)
                k = int(np.argmax(total))
                if total[k] > small:
                    inside.pop()
                    taken[small] -= 1
                    count[small] += 1
                    # the returned item takes the place of the last one that was taken of its size
                    spot = first[small] + taken[small]
                    assert order[spot] == item
                    for size in (int(live[k]), int(live[at[k]])):
                        inside.append((size, take(size)))
        for _, item in inside:
            home[item] = bins
        left -= len(inside)
        bins += 1
    return home, bins


def _pieces(raw: F.Column, room: int) -> F.Column:
    """Array of (bytes before, bytes) of the pieces of a UTF-8 text of at most `room` bytes each, in the JVM. A piece never ends inside a code point, which has three further bytes at most."""
    total = F.length(raw)

    def inside(at: F.Column) -> F.Column:
        return F.hex(F.substring(raw, at + 1, F.lit(1))).between("80", "BF")

    def step(acc: F.Column, _: F.Column) -> F.Column:
        start = F.when(F.size(acc) > 0, F.element_at(acc, -1)["at"] + F.element_at(acc, -1)["n"]).otherwise(F.lit(0))
        full = F.least(total, start + room)
        end = F.when((full == total) | ~inside(full), full).when(~inside(full - 1), full - 1).when(~inside(full - 2), full - 2).otherwise(full - 3)
        return F.when(start >= total, acc).otherwise(F.concat(acc, F.array(F.struct(start.alias("at"), (end - start).alias("n")))))

    most = F.ceil(total / F.lit(room - 3)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), F.array().cast("array<struct<at:int,n:int>>"), step)


def pack(docs: DataFrame, capacity: int, doc_id: str = "doc_id", text: str = "text", shard: int = SHARD) -> DataFrame:
    """The container of each document, or of each piece of a document larger than `capacity` tokens; columns as in PACKED.

    NULL texts and NULL ids are left out; an empty text is one token; repeated ids are packed as often as they come;
    containers are numbered within shards (shard * 2^32 + number), so numbers have gaps. An empty table gives no rows.
    The texts are read once and stay in the JVM; the number of shards comes from the table's row count, which Parquet tells without reading a column.
    """
    if capacity < 5:
        raise ValueError("a container must hold one code point and the end token")
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("_t")).filter("doc_id IS NOT NULL AND _t IS NOT NULL")
    bytes_, room = F.octet_length("_t"), capacity - 1
    raw = F.encode("_t", "UTF-8")
    cut = F.when(bytes_ > room, _pieces(raw, room)).otherwise(F.array(F.struct(F.lit(0).alias("at"), bytes_.alias("n"))))
    # the characters of each piece, and of those before it
    sized = F.transform(cut, lambda x: F.struct(x["n"].alias("n"), F.when(bytes_ > room, F.length(F.decode(F.substring(raw, x["at"] + 1, x["n"]), "UTF-8"))).otherwise(F.length("_t")).cast("bigint").alias("chars")))
    each = src.select("doc_id", sized.alias("p")).select("doc_id", F.size("p").alias("n_pieces"), "p", F.posexplode("p").alias("piece", "x"))
    before = F.aggregate(F.slice("p", 1, F.col("piece")), F.lit(0).cast("bigint"), lambda a, x: a + x["chars"])
    items = each.select("doc_id", "piece", "n_pieces", before.alias("char_start"), F.col("x.chars").alias("n_chars"), (F.col("x.n") + 1).cast("int").alias("tokens"))
    shards = max(1, -(-docs.count() // shard))

    def fill(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["doc_id", "piece"], kind="stable", ignore_index=True)
        home, _ = best_two_fit(b["tokens"].to_numpy(dtype=np.int64), capacity)
        b["container"] = home + (int(key[0]) << 32)
        return b[[c.split()[0] for c in PACKED.split(", ")]]

    return items.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards))).groupBy("_shard").applyInPandas(fill, PACKED)
