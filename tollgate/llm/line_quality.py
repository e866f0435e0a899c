"""Line-first cleaning (DataFrame functions only).

Each line is judged on punctuation, navigation and boilerplate; failing lines
are removed, and a document is rejected when the removed lines hold too large
a part of its characters, or when it fails the base rules.  Navigation is a
line with separators between its words, or a run of short lines that none of
them ends as a sentence does (a menu, one entry a line).

Defined results: a null text has no lines and no words and fails the base
rules; lines without a word are neither judged nor counted; repeated documents
get the same verdict each; extra columns don't matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
#: Largest share of characters that failing lines may hold.
MAX_LOST = 0.5
#: Marks per word, and separators per word, beyond which a line fails.
MAX_SYMBOLS = 0.3
MAX_SEPARATORS = 0.25
#: A menu: so many neighbouring lines of at most so many words and characters, none ending in a mark.
MENU_RUN = 5
MENU_WORDS = 4
MENU_CHARS = 40
ENDINGS = ".!?:;,…。！？؟\"'»”’)"
#: Phrases of page furniture, compared in lower case.
BOILERPLATE = ("all rights reserved", "cookie policy", "enable javascript", "lorem ipsum", "privacy policy",
               "terms of service", "terms of use", "subscribe to our newsletter", "skip to content",
               "alle rechte vorbehalten", "datenschutzerklärung", "impressum", "nutzungsbedingungen",
               "tous droits réservés", "politique de confidentialité", "mentions légales", "conditions d'utilisation",
               "todos los derechos reservados", "política de privacidad", "aviso legal", "términos de uso")
BOILERPLATE_WORDS = 40


def bound(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), fn)[0]


def words(text: Column) -> Column:
    """Runs of characters other than the six ASCII blanks."""
    return F.when(F.btrim(text, F.lit(BLANK)) == "", F.array().cast("array<string>")).otherwise(
        F.split(F.btrim(text, F.lit(BLANK)), r"[\x20\x09-\x0D]+"))


def occurrences(text: Column, characters: str) -> Column:
    """How many of ``characters`` a text holds."""
    kept = text
    for c in characters:
        kept = F.replace(kept, F.lit(c), F.lit(""))
    return F.length(text) - F.length(kept)


def _pairs(left: Column, right: Column) -> Column:
    """A hash of each pair of numbers of two arrays of one length."""
    return F.zip_with(left, right, lambda x, y: F.xxhash64(x, y))


def _from(values: Column, start: int) -> Column:
    return F.slice(values, start + 1, F.greatest(F.size(values) - start, F.lit(0)))


def _first(values: Column, fewer: int) -> Column:
    return F.slice(values, 1, F.greatest(F.size(values) - fewer, F.lit(0)))


def with_window_hashes(rows: DataFrame, ws: str, out: str) -> DataFrame:
    """Column ``out``: a hash of each run of five words, put together from runs of one, two and four."""
    one, two, four = F.col("_one"), F.col("_two"), F.col("_four")
    return (rows.withColumn("_one", F.transform(ws, lambda w: F.xxhash64(w)))
            .withColumn("_two", _pairs(_first(one, 1), _from(one, 1)))
            .withColumn("_four", _pairs(_first(two, 2), _from(two, 2)))
            .withColumn(out, _pairs(_first(four, 1), _from(one, 4))).drop("_one", "_two", "_four"))


def repeated_words(h: Column, size: int = WINDOW) -> Column:
    """Words covered by windows that a text holds twice or more, from its window hashes.

    Only texts with a repeated window sort their windows; then a window counts
    if a neighbour in hash order is equal, and covered words are summed from the
    distances between counted windows."""
    def in_order(s):
        hits = F.filter(s, lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)))
        return bound(F.sort_array(F.transform(hits, lambda e: e["i"])), lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - x, F.lit(size)))),
            F.lit(0).cast("long"), lambda a, x: a + x))

    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
        bound(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), in_order))


def line_fails(line: Column) -> Column:
    """Whether a line with words fails a rule; its words are counted by its spaces and tabs."""
    def judge(v):
        n, marks = v["n"], v["marks"]
        separators = occurrences(line, "|»›•")
        marked = (marks > 0) & ((marks > MAX_SYMBOLS * n) | bound(separators, lambda s: (s >= 2) & (s > MAX_SEPARATORS * n)))
        shouted = ~line.rlike(r"\p{Ll}") & (F.length(line) >= 20) & line.rlike(r"\p{Lu}")
        boilerplate = (n <= BOILERPLATE_WORDS) & F.lower(line).rlike("|".join(BOILERPLATE))
        doubled = (n >= 10) & (n <= 30) & (F.size(F.array_distinct(F.split(line, "[ \t]"))) < 0.6 * n)
        return marked | shouted | boilerplate | doubled

    marks = F.length(line) - F.length(F.translate(line, "#*$%&<>~^{}!?|»›•", ""))
    return bound(F.struct((occurrences(line, " \t") + 1).alias("n"), marks.alias("marks")), judge)


def menu_lines(lines: Column) -> Column:
    """Per line, whether it belongs to a run of at least MENU_RUN short lines without an ending."""
    def short(x):
        ended = F.instr(F.lit(ENDINGS), F.right(F.rtrim(x), F.lit(1))) > 0
        return (F.length(x) <= MENU_CHARS) & (occurrences(F.btrim(x, F.lit(BLANK)), " \t") < MENU_WORDS) & ~ended

    def reach(flags):
        """Lines that end a whole run, then all lines up to MENU_RUN - 1 before one of them."""
        full = F.transform(flags, lambda x, i: reduce(Column.__and__, [F.coalesce(F.get(flags, i - j), F.lit(False)) for j in range(MENU_RUN)]))
        return bound(full, lambda ends: F.transform(ends, lambda x, i: reduce(
            Column.__or__, [F.coalesce(F.get(ends, i + j), F.lit(False)) for j in range(MENU_RUN)])))

    return F.when(F.size(lines) < MENU_RUN, F.transform(lines, lambda x: F.lit(False))).otherwise(bound(F.transform(lines, short), reach))


def clean_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Per document: counts of the base rules, cleaned_text, lost_share, base_failed, kept."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), words(whole).alias("words"),
                       F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "").alias("lines"))
    rows = with_window_hashes(rows.withColumn("menu", menu_lines(F.col("lines"))), "words", "windows")
    rows = rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("windows")).cast("long").alias("n_repeat_words"),
        F.zip_with("lines", "menu", lambda x, m: F.struct(x.alias("line"), (m | line_fails(x)).alias("fails"))).alias("judged"))
    chars = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + F.length(x["line"]))
    rows = rows.withColumn("lost", chars(F.filter("judged", lambda x: x["fails"]))).withColumn("all", chars(F.col("judged")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    lost = F.when(F.col("all") > 0, F.col("lost") / F.col("all")).otherwise(F.lit(0.0))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & (lost <= max_lost)).alias("kept"), lost.alias("lost_share"),
                       F.array_join(F.transform(F.filter("judged", lambda x: ~x["fails"]), lambda x: x["line"]), "\n").alias("cleaned_text"))
