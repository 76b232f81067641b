"""Runs that go on where an earlier one ended: keys of jobs and samples, what is done and what is open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def job_key(task: Column, journal: Column, article: Column, page: Column, block: Column) -> Column:
    """task|journal|article|page|block; a job of a whole page has the block `page`."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat_ws("|", text(task), text(journal), text(article), F.coalesce(page, F.lit(0)).cast("string"), F.coalesce(F.nullif(text(block), F.lit("")), F.lit("page")))


def sample_key() -> Column:
    m = F.col("metadata")
    return job_key(F.coalesce(F.nullif("task_type", F.lit("")), m["task_type"]), m["journal_id"], m["article_id"], m["page_index"], m["block_id"])


def raw_samples(samples: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """(ordinal, key, n): each sample's key and its number among those of the key, in order; with `jobs` (key) only samples of a job that is still there. Rows whose key is in many samples are numbered by a window on the key."""
    s = samples.select("ordinal", sample_key().alias("key"))
    s = s.join(jobs.select("key").distinct(), "key", "left_semi") if jobs is not None else s
    return s.select("ordinal", "key", F.row_number().over(W.partitionBy("key").orderBy("ordinal")).alias("n"))


def open_jobs(jobs: DataFrame, state: DataFrame, raw: DataFrame) -> DataFrame:
    """Jobs (key) that must run: those without an entry in `state` (key, n_samples) and without samples, and those of whose samples fewer are there than the state says."""
    have = raw.groupBy("key").agg(F.count("*").alias("n"))
    j = jobs.join(state.groupBy("key").agg(F.max("n_samples").alias("n_samples")), "key", "left").join(have, "key", "left")
    n = F.coalesce("n", F.lit(0))
    done = F.when(F.col("n_samples").isNull(), n > 0).otherwise((F.col("n_samples") == 0) | (n >= F.col("n_samples")))
    return j.filter(~done).select(*jobs.columns)


def completion(jobs: DataFrame, samples: DataFrame) -> DataFrame:
    """(journal_id, task_type, n_jobs, n_samples, complete): a task of a journal is complete without jobs, or with a sample. Both inputs: journal_id, task_type; either side may lack a task."""
    a = jobs.groupBy("journal_id", "task_type").agg(F.count("*").alias("n_jobs"))
    b = samples.groupBy("journal_id", "task_type").agg(F.count("*").alias("n_samples"))
    j = a.join(b, ["journal_id", "task_type"], "full").fillna(0, ["n_jobs", "n_samples"])
    return j.withColumn("complete", (F.col("n_jobs") == 0) | (F.col("n_samples") > 0))


def pending_tasks(done: DataFrame, tasks: list[str]) -> DataFrame:
    """(journal_id, tasks): of the selected tasks, in their order, those that `completion` doesn't call complete; journals without any pending task give no row."""
    selected = F.array(*map(F.lit, tasks))
    g = done.groupBy("journal_id").agg(F.collect_set(F.when(F.col("complete"), F.col("task_type"))).alias("c"))
    return g.select("journal_id", F.array_except(selected, F.col("c")).alias("tasks")).filter(F.size("tasks") > 0)


def merged(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Samples of an earlier run and of this one; of a key that both have, the earlier stays."""
    return existing.unionByName(new.join(existing.select(key).distinct(), key, "left_anti"))


def repeated_forms(forms: DataFrame, pages: DataFrame, share: float = 0.6) -> DataFrame:
    """(journal_id, form, n_pages): forms (journal_id, page_index, form) that stand on `share` of a journal's pages (half to even, one at least), as a watermark does. `pages`: journal_id, page_index."""
    total = pages.groupBy("journal_id").agg(F.count_distinct("page_index").alias("of"))
    n = forms.groupBy("journal_id", "form").agg(F.count_distinct("page_index").alias("n_pages"))
    need = F.greatest(F.lit(1), F.bround(F.col("of") * share, 0).cast("int"))
    return n.join(total, "journal_id").filter(F.col("n_pages") >= need).select("journal_id", "form", "n_pages")
