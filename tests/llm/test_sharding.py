"""Shards against a plain ranking of the same seeded hashes."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tollgate.llm import sharding

SCHEMA = "doc_id long, text string, source string, shard string, slot string, h int, rank int, row string"


def table(spark, n=503):
    # A hot source, a null one, small ones, repeated and null rows, empty and long texts.
    texts = [None, "", "é字" * 5, "x" * 5000, "one two"]
    rows = [(i, texts[i % 5], None if i % 7 == 0 else "hot" if i % 2 else f"s{i % 11}", "clash", "clash", 1, 2, "c") for i in range(n)]
    rows += [rows[1]] * 40 + [(None, "a", "hot", None, None, None, None, None)] * 3
    return spark.createDataFrame(rows, SCHEMA).repartition(4), rows


@pytest.mark.parametrize("shards", [1, 7, 40, 1000])
def test_interleave(spark, shards):
    df, rows = table(spark)
    keyed = df.select("doc_id", "text", "source", sharding.row_hash(df, 5).alias("a"), sharding.row_hash(df, 6).alias("b")).collect()
    by_source = defaultdict(list)
    for r in keyed:
        by_source[r["source"]].append(r)
    line = []
    for source, held in by_source.items():
        held.sort(key=lambda r: (r["a"], r["b"]))
        line += [((2 * i + 1) / (2 * len(held)), source is not None, source or "", r["a"], r["b"], r) for i, r in enumerate(held)]
    line.sort(key=lambda x: x[:5])
    n, want, seen = len(line), [], Counter()
    for p, (*_, r) in enumerate(line):
        shard = p * shards // n
        want.append((r["doc_id"], r["source"], shard, seen[shard]))
        seen[shard] += 1
    out = sharding.interleave(df, "source", shards, 5)
    assert out.columns == [*df.columns, "_shard", "_slot"]
    got = [(r["doc_id"], r["source"], r["_shard"], r["_slot"]) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    sizes = Counter(r[2] for r in got)
    assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1
    if shards <= 40:
        for source, held in by_source.items():  # every shard holds every source in proportion
            in_shard = Counter(r[2] for r in got if r[1] == source)
            assert all(abs(in_shard[s] - len(held) / shards) < 2 for s in range(shards))


def test_plan(spark):
    df, rows = table(spark)
    got = sharding.shard_plan(df).collect()
    digest = lambda d, t: (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == sorted((digest(r[0], r[1]) for r in rows), key=repr)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(40)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    again = sharding.shard_plan(df.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert sharding.shard_plan(df.limit(0)).count() == 0


def test_written_shards(spark, tmp_path):
    df, rows = table(spark, 100)
    sharding.write_shards(df.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))), str(tmp_path / "out"), shards=6)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and {r["_shard"] for r in back.select("_shard").distinct().collect()} == set(range(6))
    assert sorted((r["text"] or "") for r in back.collect()) == sorted((r[1] or "") for r in rows)
