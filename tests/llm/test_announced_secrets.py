"""Short and one-class values behind a key name, and keys in few of many sources."""

from pyspark.sql import functions as F

from tollgate.llm import secrets


def test_announced_values_need_less():
    assert secrets.looks_random("Summer22", True) and secrets.looks_random("qwmzhtrpkdvx", True)
    assert not secrets.looks_random("Summer22") and not secrets.looks_random("qwmzhtrpkdvx")
    for value in ("", "aaaaaaaa", "abababab", "changeme", "11111111"):
        assert not secrets.looks_random(value, True)


def test_examples_are_a_share_of_owners(spark):
    text = "password = {} here"
    data = [(i, "plain", "en", f"s{i}") for i in range(20)] + [(20, text.format("Summer22"), "en", "s0")]
    data += [(30 + i, text.format("R4tYp9Xw2Qm8Kd53"), "en", f"s{i}") for i in range(3)]
    data += [(40 + i, text.format("q8Zk3LmT91xVbN47"), "en", f"s{i}") for i in range(4)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: (r["n_live"], r["n_copied"]) for r in secrets.secret_report(df, F.col("source"), F.col("lang")).collect()}
    assert [got[i] for i in (0, 20, 30, 40)] == [(0, 0), (1, 0), (1, 0), (0, 1)]
    masked = {r["doc_id"]: r["text"] for r in secrets.redact(df, F.col("source"), F.col("lang")).collect()}
    assert masked[20] == masked[31] == "[SECRET] here" and masked[41] == text.format("q8Zk3LmT91xVbN47")
