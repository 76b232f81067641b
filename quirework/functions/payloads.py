"""Prompt payloads as rows: repeated parts replaced by pointers, size kept under a budget.

A payload is a JSON text. Its parts are listed as rows (place, path, size, hash); which of them repeat and which fields must go are windows
over those rows, and the payload is written again once, with what the windows decided.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Parts of so many characters and more are worth a pointer.
LEAST = 200
# What stands for a repeated part and for a field left out.
POINTER, LEFT_OUT = "<同 {}，内容不再重复>", "<超出 prompt 预算 {} 字符，本字段已省略>"
TEMPLATE = "template_input"


def _listed(value: Any) -> list[tuple[str, str]]:
    """(path, form) of all lists and strings of LEAST characters, depth first; objects have no form of their own."""
    found: list[tuple[str, str]] = []
    waiting: list[tuple[str, Any]] = [("", value)]
    while waiting:
        path, v = waiting.pop()
        form = v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, sort_keys=True) if isinstance(v, list) else ""
        if len(form) >= LEAST:
            found.append((path, form))
        inner = [(f"{path}.{k}" if path else k, x) for k, x in v.items()] if isinstance(v, dict) else [(f"{path}[{i}]", x) for i, x in enumerate(v)] if isinstance(v, list) else []
        waiting.extend(reversed(inner))
    return found


def _written(value: Any, at: dict[str, str], path: str = "") -> Any:
    """`value` with the parts at the paths of `at` replaced."""
    if path in at:
        return at[path]
    if isinstance(value, dict):
        return {k: _written(v, at, f"{path}.{k}" if path else k) for k, v in value.items()}
    return [_written(v, at, f"{path}[{i}]") for i, v in enumerate(value)] if isinstance(value, list) else value


def _rewritten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for payload, at in zip(b["payload"], b["at"]):
            marks = {} if at is None else {x["path"]: x["mark"] for x in at}
            out.append(json.dumps(_written(json.loads(payload), marks), ensure_ascii=False) if marks else payload)
        b["payload"] = out
        yield b[["id", "payload"]]


def _rewrite(payloads: DataFrame, marks: DataFrame) -> DataFrame:
    at = marks.groupBy("id").agg(F.collect_list(F.struct("path", "mark")).alias("at"))
    return payloads.join(at, "id", "left").mapInPandas(_rewritten, "id string, payload string")


def _source(df: DataFrame, id_col: str, payload: str) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("id"), F.col(payload).alias("payload")).filter("id IS NOT NULL AND payload IS NOT NULL")


def fold_repeats(df: DataFrame, id_col: str, payload: str) -> DataFrame:
    """(id, payload): lists and strings of LEAST characters that came before in the same payload are replaced by a pointer to their first place.

    What lies inside a replaced part goes with it, and it was met at the first place too, so the first place of every form is never inside a replaced part. Ids should be unique; NULL payloads give no row.
    """
    src = _source(df, id_col, payload)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, n, path, form) for i, p in zip(b["id"], b["payload"]) for n, (path, form) in enumerate(_listed(json.loads(p)))]
            yield pd.DataFrame(rows, columns=["id", "place", "path", "form"])

    parts = src.mapInPandas(run, "id string, place int, path string, form string").select("id", "place", "path", F.sha2("form", 256).alias("form"))
    w = W.partitionBy("id", "form").orderBy("place")
    first = parts.withColumn("first", F.first("path").over(w)).filter(F.col("first") != F.col("path"))
    # A repeated part within another repeated part is written with that one.
    above = W.partitionBy("id").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    outer = first.withColumn("_over", F.coalesce(F.exists(F.collect_list("path").over(above), lambda p: F.startswith(F.col("path"), F.concat(p, F.lit("."))) | F.startswith(F.col("path"), F.concat(p, F.lit("[")))), F.lit(False)))
    marks = outer.filter("NOT _over").select("id", "path", F.concat(F.lit(POINTER.split("{}")[0]), "first", F.lit(POINTER.split("{}")[1])).alias("mark"))
    return _rewrite(src, marks)


def fit_budget(df: DataFrame, id_col: str, payload: str, most: int) -> DataFrame:
    """(id, payload): the largest fields of `context` left out, with a note, until the indented JSON has at most `most` characters; 0 is no limit.

    template_input and pointers stay, so the result may be larger. The size without the k largest fields is the whole size less a running sum of what they save, so one window tells which go.
    """
    src = _source(df, id_col, payload)
    if most <= 0:
        return src
    note = LEFT_OUT.format(most)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, p in zip(b["id"], b["payload"]):
                whole = json.loads(p)
                context = whole.get("context") if isinstance(whole, dict) else None
                if isinstance(context, dict):
                    total = len(json.dumps(whole, ensure_ascii=False, indent=2))
                    for n, (k, v) in enumerate(context.items()):
                        if k != TEMPLATE and not str(v).startswith(POINTER.split("{}")[0]):
                            shown = json.dumps(v, ensure_ascii=False, indent=2)
                            # two levels further in, each further line has four blanks more
                            rows.append((i, n, f"context.{k}", total, len(json.dumps(v, ensure_ascii=False)), len(shown) + 4 * shown.count("\n") - len(json.dumps(note, ensure_ascii=False))))
            yield pd.DataFrame(rows, columns=["id", "place", "path", "total", "size", "saves"])

    fields = src.mapInPandas(run, "id string, place int, path string, total bigint, size bigint, saves bigint")
    w = W.partitionBy("id").orderBy(F.desc("size"), "place")
    left = F.col("total") - F.coalesce(F.sum("saves").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return _rewrite(src, fields.withColumn("_left", left).filter(F.col("_left") > most).select("id", "path", F.lit(note).alias("mark")))
