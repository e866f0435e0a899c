"""Menus, notices and tabs in line-first cleaning, against plain rules."""

import random

from tollgate.llm import line_quality as lq

PROSE = "This is an ordinary line of prose with enough words in it, and a full stop."
MORE = "Another sentence follows here, which shares no five words with that one at all."


def plain_menu(lines):
    short = [len(x) <= lq.MENU_CHARS and x.strip(lq.BLANK).count(" ") + x.strip(lq.BLANK).count("\t") < lq.MENU_WORDS
             and x.rstrip(" ")[-1] not in lq.ENDINGS for x in lines]
    out = [False] * len(lines)
    for i in range(len(lines)):
        if short[i:i + lq.MENU_RUN] == [True] * lq.MENU_RUN:
            out[i:i + lq.MENU_RUN] = [True] * lq.MENU_RUN
    return out


def cleaned(spark, texts):
    rows = lq.clean_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r["cleaned_text"] for r in sorted(rows, key=lambda r: r["doc_id"])], {r["doc_id"]: r["kept"] for r in rows}


def test_menus_and_notices(spark):
    menu = ["Home", "About us", "Login", "Read more", "Über uns", "Site map"]
    texts = ["\n".join(menu * 2), "\n".join([PROSE, *menu, MORE]), "\n".join([PROSE, *menu[:4], MORE]),
             "\n".join(f"{x}." for x in menu), "© 2020 Alle Rechte vorbehalten\n" + PROSE, "Impressum\n" + PROSE, None, "", "\n \n"]
    got, kept = cleaned(spark, texts)
    assert got == ["", f"{PROSE}\n{MORE}", texts[2], texts[3], PROSE, PROSE, "", "", ""]
    assert not kept[0] and kept[1] and kept[2]


def test_words_are_counted_across_tabs(spark):
    line = "one\ttwo\tthree\tfour » five\tsix\tseven »"
    assert cleaned(spark, [f"{line}\n{PROSE}"])[0] == [f"{line}\n{PROSE}"]


def test_menu_runs_like_plain_rule(spark):
    rng = random.Random(9)
    pool = ["Home", "About us", "Ends here.", "one two three four", "one two three four five", "x" * 41, "a\tb\tc\td\te", " padded  ", "Ok »", "Zwei Wörter"]
    docs = [[rng.choice(pool[:2] + pool) for _ in range(rng.randint(1, 30))] for _ in range(80)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, lines array<string>")
    got = {r[0]: r[1] for r in df.select("i", lq.menu_lines(df["lines"])).collect()}
    assert got == {i: plain_menu(d) for i, d in enumerate(docs)}
    assert any(any(v) for v in got.values()) and not all(all(v) for v in got.values())
