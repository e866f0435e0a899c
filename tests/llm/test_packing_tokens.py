"""Token ids of many texts at once: the same as one by one, whatever the sizes of slices and of the table of runs."""

import numpy as np
import pyarrow as pa

from tollgate.llm import packing

TEXTS = ["The cat, the Cat; (the cat)... don't", None, "", "ΣΑΣ σας İstanbul été été", "one1two 22 -- ##x## l'été", "naïve word\x0bend", "日本語 текст!"]


def plain(tokens, text):
    return [*tokens.tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_ids_with_a_table_that_overflows(monkeypatch):
    monkeypatch.setattr(packing.Tokens, "RUNS", 3)
    tokens = packing.Tokens(None)
    for _ in range(3):
        for texts in (TEXTS, TEXTS[:2], TEXTS[3:], TEXTS[1:3], []):
            ids, at = tokens.ids(pa.array(texts, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain(tokens, t) for t in texts]


def test_runs_set_aside_are_not_coded_again(monkeypatch):
    monkeypatch.setattr(packing.Tokens, "RUNS", 1)
    tokens = packing.Tokens(None)
    tokens.learn(["quartz", "vortex"])
    tokens.learn([])
    assert not tokens.runs
    tokens.merges = None
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.learn(["vortex"])] == [plain(tokens, "vortex")[:-1]]


def test_tasks_of_a_worker_share_the_tokenizer():
    first, second = packing.Tokens(None), packing.Tokens(None)
    assert first.tokenizer is second.tokenizer and first.runs is second.runs


def test_slices_cut_and_join_batches(spark, monkeypatch):
    tokens = packing.Tokens(None)
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for size in (1, 150, 8_000_000):
        monkeypatch.setattr(packing, "_SLICE", size)
        got = {r.doc_id: (r.length, r.task, r.rank) for r in packing.tokenize_pieces(docs).collect()}
        assert {k: v[0] for k, v in got.items()} == {k: len(plain(tokens, t)) for k, t in rows}
        assert len({(v[0], v[1], v[2]) for v in got.values()}) == len(rows)
