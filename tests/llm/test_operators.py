"""Each operator against a plain version on a small table with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import (chat, components, decontaminate, jaccard_join, lattice_lm, line_quality, packing, phrase_dedup, rff_quality,
                          secrets, tag_paths)
from tollgate.llm.common import doc_hash_remainder, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words string, bits string"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)) + "."
    passage, base = say(40), [say(12) for _ in range(8)]
    out = [None, "", "  \n\t ", "one", "one two three", "a a a a a a a a a a a a a a a a a a", passage, passage.upper()]
    for _ in range(12):
        near = list(base)
        near[rng.randrange(8)] = say(rng.choice([1, 12]))
        out.append("\n".join(near))
    out += [say(30) + "\n" + passage + " " + say(20) for _ in range(5)] + [say(200) for _ in range(8)] + [say(9000), say(60) * 30]
    out += [out[-3], out[-3], "x" * 5000 + " " + passage, 'token = "abcd1234EFGH5678" ' + say(20), "PASSWD:x api_key='k9F3hG72lQw8' AKIAABCDEFGHIJKL12",
            "0123456789abcdef0123456789abcdef éé 0123456789abcdef0123456789abcdef", "Ünï cödé   wörds\x0bhere | | | |"]
    return out


@pytest.fixture(scope="module")
def rows():
    return [(i * 3, t, "en", f"src{i % 4}", len(t or ""), 0.5, "clash", "clash") for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_decontamination(spark, docs, empty, rows):
    item = texts()[6]
    edited = item[:30] + "ZZ" + item[33:]
    bench = spark.createDataFrame([(1, item), (2, edited), (3, None), (4, "short"), (5, "nothing of this kind occurs in any of the texts at all")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.contamination(docs, bench).collect()}

    def distance(p, t):
        last = list(range(len(p) + 1))
        best = last[-1]
        for c in t:
            now = [0]
            for i, x in enumerate(p):
                now.append(min(last[i] + (x != c), last[i + 1] + 1, now[i] + 1))
            last = now
            best = min(best, last[-1])
        return best

    want = {}
    for r in rows:
        t = decontaminate.normalize(r[1])
        for key, text in ((1, item), (2, edited), (5, "nothing of this kind occurs in any of the texts at all")):
            p = decontaminate.normalize(text)
            if t and len(t) < 9000 and (d := distance(p, t)) <= int(len(p) * decontaminate.ERROR_RATE):
                want[r[0], key] = d
    assert {k: v for k, v in got.items() if len(decontaminate.normalize(dict((r[0], r[1]) for r in rows)[k[0]])) < 9000} == want and want
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {k for k, _ in got}
    assert decontaminate.contamination(empty, bench).count() == 0 and decontaminate.contamination(docs, bench.limit(0)).count() == 0


def test_secrets(spark, docs, empty, rows):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    got = by_id(secrets.secret_report(docs, F.col("source"), F.concat_ws("/", "source", "lang")))
    for r in rows:
        t = r[1] or ""
        spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        base = [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]
        assert got[r[0]]["base_sha256"] == sha(",".join(base))
        assert set(base) <= set(got[r[0]]["spans"].split(",")) or not base
    assert secrets.secret_report(empty, F.col("source"), F.col("lang")).count() == 0


def test_ownership_separates_copied_from_live(spark):
    value = "token = 'q8Zk3LmT91xVbN47'"
    data = [(i, f"see {value} here", "en", f"s{i}") for i in range(4)] + [(9, "token = 'R4tYp9Xw2Qm8Kd53'", "en", "s9"), (10, "token = 'R4tYp9Xw2Qm8Kd53'", "en", None),
                                                                      (11, None, None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    got = by_id(secrets.secret_report(df, F.col("source"), F.col("lang")))
    assert [got[i]["n_copied"] for i in (0, 9)] == [1, 0] and [got[i]["n_live"] for i in (0, 9, 10, 11)] == [0, 1, 1, 0]
    masked = by_id(secrets.redact(df, F.col("source"), F.col("lang")))
    assert masked[9]["text"] == "[SECRET]'" and masked[0]["text"] == f"see {value} here" and masked[11]["text"] is None and len(masked) == 7


def test_lattice_matches_all_segmentations(docs, empty, rows):
    rng = np.random.default_rng(0)
    sp = lattice_lm._processor(None)
    counts = rng.integers(0, 50, sp.get_piece_size()).astype(float)
    total = counts.sum() + lattice_lm.PIECE_PRIOR * len(counts)
    p = {sp.id_to_piece(i): (counts[i] + lattice_lm.PIECE_PRIOR) / total for i in range(len(counts)) if not (sp.is_unknown(i) or sp.is_control(i))}

    def spelled(word):
        out = 0.0
        for cuts in itertools.product([0, 1], repeat=len(word)):
            parts, now = [], ""
            for c, cut in zip(word, cuts):
                if cut:
                    parts.append(now)
                    now = ""
                now += c
            parts.append(now)
            share = p.get("▁" + parts[0], 0.0)
            for x in parts[1:]:
                share *= p.get(x, 0.0) if x in p or len(x) > 1 else math.prod(p[f"<0x{b:02X}>"] for b in x.encode())
            out += share
        return math.log(out)

    words = ["the", "thing", "漢x", "a", "zzq", "nation"]
    assert np.allclose(lattice_lm.Lattice(counts).marginals(words), [spelled(w) for w in words])
    got = by_id(lattice_lm.score_documents(docs, doc_hash_remainder(F.col("doc_id"), 7) == 2))
    split = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for r in rows if not held(r[0]) for w in split(r[1]))
    n = sum(c.values())
    for r in rows:
        ws, g = split(r[1]), got[r[0]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"], g["held_out"]) == (len(ws), sum(c[w] > 0 for w in ws), n, held(r[0]))
        assert math.isclose(g["base_score"], sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in ws), rel_tol=1e-9)
        assert g["score"] < 0
    assert lattice_lm.score_documents(empty, F.lit(False)).count() == 0


def test_line_quality(docs, empty, rows):
    got = by_id(line_quality.clean_lines(docs))
    for r in rows:
        t, seen, dups, covered = r[1] or "", set(), 0, set()
        ws = WORD.findall(t)
        windows = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
        for i in range(len(ws) - 4):
            if windows[tuple(ws[i:i + 5])] > 1:
                covered.update(range(i, i + 5))
        for line in t.split("\n"):
            if WORD.search(line):
                dups += line in seen
                seen.add(line)
        g, bad = got[r[0]], len(ws) < 10 or 100 * len(covered) > 20 * len(ws)
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) == (
            len(ws), sum(map(len, ws)), sum(x in "#*$%&|<>" for x in t), dups, len(covered), bad)
        assert not (g["kept"] and bad)
    assert line_quality.clean_lines(empty).count() == 0


def test_line_rules(spark):
    good = "This is an ordinary line of prose with enough words in it, and a full stop."
    bad = ["Home | News | About | Contact | Login", "BUY NOW!! CHEAP!! CLICK!! HERE!! TODAY!!", "ab%%% cd### ef$$$ gh*** ij&&&", "See our privacy policy for more."]
    df = spark.createDataFrame([(0, "\n".join([good, *bad, good]))], "doc_id long, text string")
    assert line_quality.clean_lines(df).first()["cleaned_text"] == f"{good}\n{good}"


def test_quality_classifier(spark, docs, empty):
    rng = random.Random(2)
    data = [(i, " ".join(rng.choice(["alpha", "beta,", "gamma."]) + ("%%%" if i % 2 else "") for _ in range(rng.randint(5, 60)))) for i in range(400)]
    df = spark.createDataFrame([*data, (1000, None), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in data] + [(None, 1), (5000, 0), (3, None)], "doc_id long, quality int")
    held = doc_hash_remainder(F.col("doc_id"), 5) == 0
    model, stats = rff_quality.train(df, labels, ~held)
    got = by_id(rff_quality.score(stats, model))
    assert all(got[i]["predicted"] == 1 - i % 2 for i, _ in data) and len(got) == 402 and got[1000]["score"] == got[1001]["score"]
    assert rff_quality.keep_good(df.limit(400), model).count() > 150
    none, stats = rff_quality.train(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in rff_quality.score(stats, none).collect()} == {0.5}
    assert rff_quality.score(rff_quality.document_statistics(empty), model).count() == 0
    assert list(rff_quality.isotonic(np.array([1.0, 3, 2, 2, 5]), np.ones(5))) == pytest.approx([1, 7 / 3, 7 / 3, 7 / 3, 5])


def test_packing(docs, empty, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = packing.pack(docs).collect()
    got = {(r["doc_id"], r["piece"]): r for r in out}
    for r in rows:
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for p, s in enumerate(range(0, len(ids), 4096)):
            x = np.array(ids[s:s + 4096], "<u4")
            assert (got[r[0], p]["start"], got[r[0], p]["length"], got[r[0], p]["ids_crc32"]) == (s, len(x), zlib.crc32(x.tobytes()))
    for _, places in itertools.groupby(sorted((r["sequence_id"], r["offset"], r["length"]) for r in out), lambda x: x[0]):
        at = 0
        for _, offset, length in places:
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(empty).count() == 0


def test_plan_fills_exactly():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 25, 15, 35]] = 3, 1, 2, 2, 1
    slots = packing.plan(counts, 100)
    assert max(s[3] for s in slots) == 3 and sum(s[2] - s[1] for s in slots) == 9


def test_jaccard_components(docs, empty, rows):
    got = by_id(jaccard_join.jaccard_components(docs))
    sets = {}
    for r in rows:
        ws = (r[1] or "").encode().lower().split()
        sets[r[0]] = frozenset(tuple(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))) if ws else frozenset()
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) > 0:
                root[a] = root[b] = min(root[a], root[b])
    assert {i: (got[i]["n_shingles"], got[i]["component_id"]) for i in sets} == {i: (len(s), root[i]) for i, s in sets.items()}
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert jaccard_join.keep_one(docs, size=4, percent=85).count() == len({*root.values()})


def test_large_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rng = random.Random(3)
    base, data = [f"w{i}" for i in range(60)], []
    for i in range(60):
        ws = list(base)
        for _ in range(rng.randint(0, 3)):
            ws[rng.randrange(60)] = f"x{rng.randrange(9)}"
        data.append((i, " ".join(ws)))
    test_jaccard_components(spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string"),
                            data)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, 40), (40, 50), (60, 60)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 40: 30, 50: 30, 60: 60}


def test_tag_paths(spark):
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a>Menu</a></li></ul></nav>"
            "<div class='ad'>Buy, now.</div><script>var x='</p>';</script><article><h1>Head &amp; line</h1><p><b>First  part,\n of it.<br>More<p>Second &lt;one&gt;, a longer "
            "sentence, with marks.</p><p>Short.</p><div class='comments'><p>I agree, really, with all.</p></div></article><footer>&copy; me</footer></body></html>")
    df = spark.createDataFrame([(0, "u", page), (1, "v", None), (2, None, ""), (3, "w", "<nav>x</nav>"), (None, "p", "plain, text.")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in tag_paths.extract(df).collect()}
    assert got[0]["text"] == "Head & line\n\nFirst part, of it. More\n\nSecond <one>, a longer sentence, with marks.\n\nShort."
    assert [got[i]["text"] for i in (1, 2, 3, None)] == ["", "", "", "plain, text."] and got[0]["n_chars"] == len(got[0]["text"])


def test_chat(spark):
    rng = random.Random(1)
    data = [(-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"), (None, 0, "user", "x"),
            (5, 0, None, None), (5, 0, "assistant", "tie <\\| <\\\\| %25 \n<"), (5, 1, "as\n%0A<|k", "|im_end|>"), (6, 0, "system", "s" * 9000), (6, 1, "assistant", "")]
    for i in range(10, 30):
        data += [(i, 0, "system", "be good")] * (i % 2) + [(i, k, rng.choice(["user", "assistant"]), "wörd " * rng.randint(0, 900)) for k in range(1, rng.randint(2, 14))]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    parts = chat.windows(df)
    got = {r["conv_id"]: r for r in chat.read_back(parts).collect()}
    talks = {}
    for c, t, r, x in data:
        talks.setdefault(c, []).append((t, r or "", x or ""))
    for c, turns in talks.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha(loss))
    # Windows of several new turns hold the budget; later ones begin with the system turn.
    for r in parts.where("conv_id >= 10").collect():
        n = r["formatted"].count("<|im_end|>") - r["n_repeated"]
        assert n == 1 or len(r["formatted"]) / chat.CHARS_PER_TOKEN <= chat.BUDGET
        assert r["window"] == 0 or r["conv_id"] % 2 == 0 or r["formatted"].startswith("<|im_start|>system\nbe good<|im_end|>")
    assert chat.read_back(chat.windows(df.limit(0))).count() == 0


def test_phrase_dedup(docs, empty, rows):
    words = {r[0]: (r[1] or "").encode().split() for r in rows}
    owner = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            owner.setdefault(tuple(words[i][k:k + 13]), i)
    got = by_id(phrase_dedup.remove_repeats(docs, keep_text=True))
    for i, ws in words.items():
        gone = set()
        for k in range(len(ws) - 12):
            if owner[tuple(ws[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = b" ".join(w for k, w in enumerate(ws) if k not in gone)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"], got[i]["kept"]) == (len(ws), len(gone), sha(kept), kept.decode())
    assert any(r["n_removed"] for r in got.values()) and phrase_dedup.remove_repeats(empty).count() == 0


def test_word_hashes_follow_words():
    seen = {}
    for t in texts():
        ws = (t or "").encode().split()
        h = word_hashes((t or "").encode()).tolist()
        assert len(h) == len(ws) and all(seen.setdefault(w, x) == x for w, x in zip(ws, h))
    assert len({*seen.values()}) == len(seen)


def test_pipeline_stages(spark, tmp_path, docs, rows):
    import corpus_pipeline

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, texts()[6])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == docs.columns, name
    left = {r["doc_id"]: r["text"] for r in frame.collect()}
    item = decontaminate.normalize(texts()[6])
    assert left and not any(item in decontaminate.normalize(t) for t in left.values())
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {*left}
