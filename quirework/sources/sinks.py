"""Sinks. Spark's commit protocol makes each write whole or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """JSON lines, non-ASCII as it is, NULL fields left out; existing partitions that get no rows stay."""
    w = df.write.mode(mode).option("ignoreNullFields", "true").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*partition_by) if partition_by else w).json(path)


def write_exports(samples: DataFrame, path: str, pages: DataFrame | None = None) -> None:
    """All samples as lines of text, one folder for each format and task; with `pages` the corpus has the records of figure samples too."""
    from quirework.operators import samples as S

    lines = None
    for name, build in (("sharegpt", S.to_sharegpt), ("alpaca", S.to_alpaca), ("pt", S.to_pt)):
        d = build(samples)
        body = [c for c in d.columns if c != "ordinal"]
        if name == "pt" and pages is not None:
            more = S.figures_to_pt(samples, pages).select(F.lit(name).alias("format"), F.lit(S.CORPUS).alias("task_type"), F.to_json(F.struct("text")).alias("value"))
            lines = lines.unionByName(more)
        part = d.join(samples.select("ordinal", "task_type"), "ordinal").select(F.lit(name).alias("format"), "task_type", F.to_json(F.struct(*body)).alias("value"))
        lines = part if lines is None else lines.unionByName(part)
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("format", "task_type").text(path)


def append_skips(skipped: DataFrame, path: str) -> None:
    """Journals that were passed over (journal_id, source_pdf, reason) as lines at the end of a log."""
    write_jsonl(skipped.select("journal_id", "source_pdf", F.lit(True).alias("skipped"), "reason"), path, mode="append")


def write_manifests(journals: DataFrame, pages: DataFrame, articles: DataFrame, path: str) -> None:
    """A journal's row, the index of its pages and its articles as lines, one folder for each journal."""
    for name, df in (("journals", journals), ("pages", pages.select("journal_id", "page_index", "page_label", "page_type", "page_image")), ("articles", articles)):
        write_jsonl(df, f"{path}/{name}", partition_by=["journal_id"])
