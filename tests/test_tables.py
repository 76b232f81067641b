"""Table helpers."""

from pyspark.sql import functions as F

from quirework.sources import tables


def test_once_keeps_one_row_of_each_key(spark):
    data = [(i % 700, "a" if i % 3 else None, f"text {i % 700}", i) for i in range(900)] + [(None, None, "n", 1), (None, None, "n", 2)]
    df = spark.createDataFrame(data, "k long, kind string, text string, at int")
    want = {(r.k, r.kind) for r in df.collect()}
    for bits in (1 << 15, 1 << 20):
        got = tables.once(df, ["k", "kind"], bits).collect()
        assert {(r.k, r.kind) for r in got} == want and len(got) == len(want)
        assert all(r.text == (f"text {r.k}" if r.k is not None else "n") for r in got)
    assert tables.once(df.limit(0), ["k"]).count() == 0
    assert tables.once(df, ["k"]).columns == df.columns


def test_screen_lets_all_that_was_put_in_pass(spark):
    put = spark.range(0, 50_000, 7).withColumnRenamed("id", "x")
    table = tables.bit_table(put, "x", 1 << 22)
    got = tables.screened(spark.range(0, 60_000), F.col("id"), table, 1 << 22)
    passed = {r.id for r in got.filter("_maybe").collect()}
    wanted = set(range(0, 50_000, 7))
    assert wanted <= passed and len(passed) < len(wanted) + 400
