"""Ranked search against all pairs scored one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tollgate.llm import dual_tree

#: Fixed: a term of a text whose A-Z are lowered.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, item_id long, score string, rank string, term int"


def plain(docs, items, top=10):
    counted = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    df, big_n, big_l = Counter(t for _, c in counted for t in c), sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    out = []
    for item, text in sorted(set((i, t or "") for i, t in items), key=repr):
        asked = set(TERM.findall(text.translate(LOWER)))
        found = []
        for d, c in counted:
            if n := sum(c.values()):
                m = 10 + (90 * n * big_n) // big_l
                score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if t in c)
                if score > 0:
                    found.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(3)
    topics = [["".join(rng.choice("abcdeéß字9") for _ in range(rng.randint(1, 5))) for _ in range(40)] for _ in range(6)]
    say = lambda n: " ".join(rng.choice(rng.choice([topics[n % 6], topics[n % 6], topics[0]])) for _ in range(n)) + "!"
    docs = [(i, say(rng.randint(1, 60))) for i in range(400)]
    docs += [(1000 - i, docs[7][1]) for i in range(60)] + [(5, docs[9][1]), (None, docs[7][1]), (None, None), (2000, ""), (2001, " -- \x7f"), (2002, say(40_000)),
             (2003, "ÀB cÉ AB" * 3), (2004, docs[9][1].upper())]
    items = [(i, say(rng.randint(1, 25))) for i in range(30)] + [(1, "other text of item one " + docs[9][1]), (2, ""), (3, None), (40, "zzzz qqqq"), (41, docs[7][1]), (41, docs[7][1])]
    return docs, items


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block, slice_, group", [(8_000_000, 1 << 20, 8192), (300, 50, 70)])
def test_search(spark, monkeypatch, block, slice_, group):
    for name, value in (("BLOCK_CHARS", block), ("SLICE", slice_), ("GROUP", group), ("LEAF", 8), ("FAN", 3)):
        monkeypatch.setattr(dual_tree, name, value)
    docs, items = corpus()
    table = spark.createDataFrame([(d, t, 3, "x", "y", 1) for d, t in docs], DOCS).repartition(5)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    if block == 8_000_000:
        assert rows(dual_tree.ranked_search(table, asked)) == plain(docs, items)
        assert dual_tree.ranked_search(table.limit(0), asked).count() == dual_tree.ranked_search(table, asked.limit(0)).count() == 0
    else:
        asked = asked.limit(12)
        some = [(r["item_id"], r["text"]) for r in asked.collect()]
        assert rows(dual_tree.ranked_search(table, asked, top=3)) == plain(docs, some, 3)


def test_whole_batches_are_pruned():
    rng = random.Random(1)
    width, items, docs = 400, [], []
    for i in range(64):
        items.append((np.sort(rng.sample(range(i % 8 * 50, i % 8 * 50 + 50), 6)), np.array([float(rng.randint(1, 9000)) for _ in range(6)])))
    for i in range(6400):
        docs.append((np.sort(rng.sample(range(i % 8 * 50, i % 8 * 50 + 50), 10)), np.array([float(rng.randint(1, 10 ** 6)) for _ in range(10)])))
    found = dual_tree.Search(items, width, 5)
    for at in range(0, 6400, 1600):
        found.add(docs[at:at + 1600], list(range(at, at + 1600)))
    dense = np.zeros((len(docs), width))
    for d, (t, v) in enumerate(docs):
        dense[d, t] = v
    want = []
    for i, (t, w) in enumerate(items):
        score = dense[:, t] @ w
        want += [(i, int(score[d]), int(d)) for d in np.lexsort((np.arange(len(docs)), -score))[:5]]
    assert sorted(found.best()) == sorted(want)
    assert found.scored < 64 * 6400 // 6  # an item meets its own topic's documents (an eighth) and few others


def test_items_too_long_for_doubles():
    many = 400_000
    found = dual_tree.Search([(np.arange(many), np.full(many, 30_000.0))], many, 2)
    assert found.kind is np.int64
    found.add([(np.arange(many), np.full(many, 999_999.0)), (np.arange(many - 1), np.full(many - 1, 999_999.0))], [4, 3])
    assert list(found.best()) == [(0, 30_000 * 999_999 * many, 4), (0, 30_000 * 999_999 * (many - 1), 3)]
