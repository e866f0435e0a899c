"""Benchmark items shorter than the edit search allows."""

from tollgate.llm import decontaminate


def test_short_items_match_at_word_borders(spark):
    item = "What is 6 x 7?"
    docs = spark.createDataFrame([(0, f"Q: what  is 6 X 7? 42"), (1, item), (2, "somewhat is 6 x 7?"), (3, "What is 6 x 8?"), (4, None), (5, "is a"),
                                  (6, "this at"), (7, "thisa is a")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "is a"), (3, " "), (4, None), (5, "")], "item_id long, text string")
    got = [tuple(r) for r in decontaminate.contamination(docs, bench).collect()]
    assert sorted(got) == [(0, 1, 0, 0, 17), (1, 1, 0, 0, 14), (5, 2, 0, 0, 4), (7, 2, 0, 0, 10)]
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()} == {2, 3, 4, 6}
