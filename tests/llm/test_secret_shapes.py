"""Candidate shapes against plain patterns, hostile texts in linear time, verdicts by owners and repositories, clashing columns."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tollgate.llm import jaccard_join, secrets

URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]+:([^\s/:@]+)@")


def test_urls_like_the_plain_pattern():
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice(["://", "a", "9", "+", ":", "@", " ", "/", "ab.c", "é"]) for _ in range(rng.randint(0, 25)))
        assert secrets.url_spans(text) == [(m.start(), m.end(), m[1]) for m in URL.finditer(text)], text


@pytest.mark.parametrize("text", ["://" + "a" * 1_000_000, "a" * 1_000_000 + "://", "eyJ" * 300_000, "://a:" * 200_000, "token " * 150_000, "-----BEGIN " + "A " * 500_000,
                                  "xoxa-" * 200_000, "ghp_" * 200_000, "AKIA" * 250_000, "a1" * 500_000, "password=abcd1234 " * 50_000, "token=" + " " * 1_000_000,
                                  " ".join(f"http://u{i}:p4sSw0rd{i}@h token=abcdefgh{i}" for i in range(20_000))])
def test_long_texts_are_linear(text):
    began = time.process_time()
    found = secrets.find_spans(text.encode())
    assert time.process_time() - began < 3
    ends = 0
    for s, k, e, _ in found:
        if k >= secrets.BASE:
            assert s >= ends
            ends = e


def test_verdicts_count_owners_and_repositories(spark):
    key = {k: f"qwrtzplkjhgfdsxcvb{k}mn7" for k in "abcd"}
    rows = [(i, "plain", f"o{i % 10}", f"o{i % 10}/r{i % 20}") for i in range(40)]
    rows += [(100 + i, f"see {key['a']} here", "o1", f"o1/r{i}") for i in range(5)]  # one owner, many repositories
    rows += [(200 + i, f"see {key['b']} here", f"o{i}", f"o{i}/x") for i in range(4)]  # many owners
    rows += [(300 + i, f"see {key['c']} here", f"o{i % 2}", f"o{i % 2}/c{i}") for i in range(12)]  # two owners, many repositories
    rows += [(400, f"see {key['d']} here", None, None)]
    rows += [(500, "id aaaaaaaaaaaaaaaaaabbbbbb1", "o3", "o3/r1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, repo string")
    got = {r["doc_id"]: (r["n_live"], r["n_copied"]) for r in secrets.secret_report(df, F.col("source"), F.col("repo")).collect()}
    assert [got[i] for i in (0, 100, 104, 200, 300, 400, 500)] == [(0, 0), (1, 0), (1, 0), (0, 1), (0, 1), (1, 0), (0, 0)]
    # Letters only: too plain for a value seen in one repository, enough for one that an owner keeps in several.
    letters = "qwrtzplkjhgfdsxcvbmnyaeuio"
    one = [(1, "x=" + letters + "=1", "o1", "o1/r1"), (2, "plain", "o2", "o2/r1")]
    spans = spark.createDataFrame([("h", "o1", "r1", False, True), ("g", "o1", "r1", False, True), ("g", "o1", "r2", False, True)], "hash string, owner string, repo string, random boolean, likely boolean")
    assert {(r["hash"], r["live"], r["copied"]) for r in secrets.judged(spans, 5, 9).collect()} == {("h", False, False), ("g", True, False)}
    assert secrets.redact(spark.createDataFrame(one, df.schema), F.col("source"), F.col("repo")).count() == 2


def test_columns_named_like_the_operators_own(spark):
    names = ["_owner", "_repo", "_row", "_spans", "_live", "_gone", "key", "live", "gone", "hash", "row", "owner", "repo"]
    rows = [(1, 'password = "k9F3hG72lQw8Zx"', "s1", "en", *[f"{n}1" for n in names]), (2, "one two three four five six", "s2", "en", *[f"{n}2" for n in names]),
            (3, "one two three four five six", "s2", "en", *[f"{n}3" for n in names]), (4, None, None, None, *[None] * len(names))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, " + ", ".join(f"`{n}` string" for n in names))
    out = secrets.redact(df, F.col("source"), F.concat_ws("/", "source", "lang"))
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["text"] == "[SECRET]" or got[1]["text"].endswith("[SECRET]\"") or "[SECRET]" in got[1]["text"]
    assert all(got[i][n] == f"{n}{i}" for i in (1, 2, 3) for n in names) and got[2]["text"] == rows[1][1] and got[4]["text"] is None
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns and {r["doc_id"]: r["_gone"] for r in kept.collect()} == {1: "_gone1", 2: "_gone2", 4: None}
    assert secrets.redact(df.limit(0), F.col("source"), F.col("lang")).count() == 0
