"""Sizes of the buckets of hot shingles, without a task that meets all their postings."""

from pyspark.sql import functions as F

from tollgate.llm import jaccard_join


def test_sizes_of_hot_tokens(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 50)
    monkeypatch.setattr(jaccard_join, "HOT_PART", 16)
    rows = [(7, i) for i in range(1000)] + [(8, i) for i in range(900)] + [(100 + i // 3, i) for i in range(600)] + [(-i, i) for i in range(1, 50)]
    posted = spark.createDataFrame(rows, "token long, doc long").withColumns({"n": F.lit(5).cast("long"), "pos": F.lit(0)})
    assert {r["token"]: r["size"] for r in jaccard_join.hot_sizes(posted).collect()} == {7: 1000, 8: 900}
    got = jaccard_join.with_sizes(posted)
    assert got.columns == ["token", "doc", "n", "pos", "size"] and got.count() == 2500
    sizes = {r["token"]: (r["size"], r["count"]) for r in got.groupBy("token", "size").count().collect()}
    assert sizes == {7: (1000, 1000), 8: (900, 900), **{100 + i: (3, 3) for i in range(200)}}
    assert jaccard_join.with_sizes(posted.limit(0)).count() == 0
