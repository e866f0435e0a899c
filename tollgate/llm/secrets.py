"""Secret scans: corpus-wide ownership frequency of candidate values.

Every text is scanned for credential shapes.  The hash of each value found is
counted over the whole corpus by distinct owners and repositories: a value that a
large share of all owners, or several owners and a large share of all
repositories, carry is a copied example; one that few hold and that looks random
is treated as live, with less asked of a value that a single owner keeps in
several repositories.  Base shapes are always reported; wider
shapes are reported only where the ownership count says they are live.

Defined results: a null text is an empty text (no span); repeated rows are
scanned row by row; a null owner or repository counts as one of its own; long
runs of one character class cost linear time; an empty table gives no rows;
extra columns are kept untouched and never clash with the operator's.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import string
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import bounded_batches, fresh, materialize, release_memory

#: Kinds in the order in which spans with one start are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "pem", "url", "github", "slack", "jwt", "generic")
BASE = 3
#: An example is a value that at least so many owners carry, and at least this share of all owners.
WIDE_OWNERS = 3
WIDE_SHARE = 0.2
#: Bits per character below which a value doesn't look random.
MIN_ENTROPY = 3.0
#: The same as a share of the most that a value of its length can have; for short values that a key name or fixed prefix announces.
MIN_SHARE = 0.75
#: Kinds found behind a key name, a fixed prefix or a user name.
ANNOUNCED = frozenset(("assign", "access", "pem", "url", "github", "slack", "jwt"))

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ASSIGN_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_WIDE = {
    "pem": (b"-----BEGIN", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*(?:-----END [A-Z ]*PRIVATE KEY-----)?")),
    "github": (b"gh", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    "slack": (b"xox", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    "jwt": (b"eyJ", re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*")),
}
_LOGIN, _SCHEME = re.compile(r"[^\s/:@]+:([^\s/:@]+)@"), string.ascii_letters + string.digits + "+.-"
_GENERIC = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}")
_PLACEHOLDER = re.compile(r"example|sample|changeme|placeholder|your[_-]?|dummy|xxxx|\*\*\*|<|1234567", re.IGNORECASE)

_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()),
                      T.StructField("end", T.LongType()), T.StructField("hash", T.StringType()),
                      T.StructField("random", T.BooleanType()), T.StructField("likely", T.BooleanType())])
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
                             ("hash", pa.string()), ("random", pa.bool_()), ("likely", pa.bool_())]))


def looks_random(value: str, announced: bool = False) -> bool:
    """Enough entropy, no placeholder word; unless announced, at least two character classes.

    Announced values of few characters need no more than a share of what their length allows."""
    classes = sum(bool(re.search(p, value)) for p in ("[0-9]", "[a-z]", "[A-Z]"))
    if not value or classes < 2 and not announced or _PLACEHOLDER.search(value):
        return False
    n = len(value)
    least = min(MIN_ENTROPY, max(1.0, MIN_SHARE * math.log2(n))) if announced else MIN_ENTROPY
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= least


def url_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, password) of each scheme://user:password@, leftmost and non-overlapping.

    Found from each "://" outwards, so a text without one costs one search and long runs are read once."""
    out, done, at = [], 0, text.find("://")
    while at >= 0:
        head = text[done:at]
        scheme = head[len(head.rstrip(_SCHEME)):]
        first = next((i for i, c in enumerate(scheme) if c in string.ascii_letters), None)
        m = _LOGIN.match(text, at + 3) if first is not None else None
        done = at + 3
        if m:
            out.append((at - len(scheme) + first, m.end(), m[1]))
            done = m.end()
        at = text.find("://", done)
    return out


def find_spans(raw: bytes) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of a whole text, by start then kind; code points, end exclusive.

    Wide spans that touch a base span or an earlier wide span are left out.  Linear in the text."""
    low = raw.lower()
    want_assign = any(h in low for h in _ASSIGN_HINTS)
    text = raw.decode("utf-8", "replace")
    out = []
    if want_assign:
        out += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    wide = []
    for kind, (hint, pattern) in _WIDE.items():
        if hint in raw:
            wide += [(m.start(), KINDS.index(kind), m.end(), m[m.lastindex or 0]) for m in pattern.finditer(text)]
    if b"://" in raw:
        wide += [(start, KINDS.index("url"), end, value) for start, end, value in url_spans(text)]
    if any(len(w) >= 20 for w in raw.split()):
        wide += [(m.start(), KINDS.index("generic"), m.end(), m[0]) for m in _GENERIC.finditer(text)]
    if wide:
        base: list[list[int]] = []  # merged, so both their starts and their ends rise
        for s, e in sorted((s, e) for s, _, e, _ in out):
            if base and s < base[-1][1]:
                base[-1][1] = max(base[-1][1], e)
            else:
                base.append([s, e])
        starts, last = [s for s, _ in base], 0
        for span in sorted(wide):
            before = bisect.bisect_left(starts, span[2]) - 1
            if span[0] >= last and (before < 0 or base[before][1] <= span[0]):
                last = span[2]
                out.append(span)
    return sorted(out)


@F.arrow_udf(T.ArrayType(_SPAN))
def candidate_spans(texts: pa.Array) -> pa.Array:
    """The spans of each text; only the texts go through Python, not the rows."""
    found = pa.array([[{"start": s, "kind": k, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest()[:32],
                       "random": looks_random(v, KINDS[k] in ANNOUNCED), "likely": looks_random(v, True)}
                      for s, k, e, v in (find_spans(raw) if raw else ())] for raw in texts.cast(pa.binary()).to_pylist()], _ARROW)
    release_memory()
    return found


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos) from rows (hash, owner, repo).

    Distinct (hash, owner, repo) rows are combined before each shuffle, so a
    value in a third of all documents costs a few rows per task."""
    return (spans.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
            .groupBy("hash", "owner").agg(F.count("*").alias("repos"))
            .groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos")))


def judged(spans: DataFrame, owners: int, repos: int, wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """``spans`` (with hash, owner, repo, random, likely) and two verdicts, ``live`` and ``copied``.

    ``owners`` and ``repos`` are those of the whole corpus.  A value is a copied example if at
    least ``wide_owners`` owners and a share ``WIDE_SHARE`` of all of them carry it, or several
    owners and that share of all repositories.  Other values are live if they look random; a value
    that one owner alone keeps in several repositories needs no more than an announced one."""
    share = lambda n: max(wide_owners, math.ceil(WIDE_SHARE * n))
    copied = (F.col("n_owners") >= share(owners)) | (F.col("n_owners") > 1) & (F.col("n_repos") >= share(repos))
    own = (F.col("n_owners") == 1) & (F.col("n_repos") > 1)
    return (spans.join(ownership(spans), "hash")
            .withColumns({"live": ~copied & (F.col("random") | own & F.col("likely")), "copied": copied}).drop("n_owners", "n_repos"))


def _span_text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _owners_and_repos(rows: DataFrame) -> tuple[int, int]:
    """Numbers of distinct owners and of (owner, repo) in rows (owner, repo); null counts as one of its own."""
    pairs = rows.groupBy("owner", "repo").agg(F.lit(1).alias("one")).groupBy("owner").agg(F.count("*").alias("n"))
    r = pairs.agg(F.count("*").alias("owners"), F.sum("n").alias("repos")).first()
    return r["owners"], r["repos"] or 0


def secret_report(docs: DataFrame, owner: Column, repo: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base counts and digest, all spans kept by the method, live and copied counts."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), owner.alias("owner"), repo.alias("repo"))
    scanned = materialize(slim.select("doc_id", "owner", "repo", candidate_spans("text").alias("spans"))
                          .withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    one = scanned.where(F.size("spans") > 0).select("row", "owner", "repo", F.inline("spans"))
    verdicts = judged(one, *_owners_and_repos(scanned)).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live", "copied"))).alias("judged"))
    base = F.filter("spans", lambda s: s["kind"] < BASE)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    all_judged = F.coalesce("judged", F.array().cast(verdicts.schema["judged"].dataType))
    kept = F.filter(all_judged, lambda s: (s["kind"] < BASE) | s["live"])
    return (scanned.join(verdicts, "row", "left")
            .select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                    F.sha2(_span_text(base).cast("binary"), 256).alias("base_sha256"),
                    _span_text(kept).alias("spans"),
                    F.size(F.filter(all_judged, lambda s: s["live"])).cast("long").alias("n_live"),
                    F.size(F.filter(all_judged, lambda s: s["copied"])).cast("long").alias("n_copied")))


def masker(mask: str):
    @F.arrow_udf(T.StringType())
    def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for value, live in zip(texts.to_pylist(), spans.to_pylist()):
            if value and live:
                parts, at = [], 0
                for s in live:
                    start, end = s.values()
                    if end <= at:
                        continue
                    if start >= at:
                        parts += [value[at:start], mask]
                    at = max(at, end)
                value = "".join([*parts, value[at:]])
            out.append(value)
        return pa.array(out, pa.string())

    return masked


def redact(docs: DataFrame, owner: Column, repo: Column, text: str = "text", mask: str = "[SECRET]",
           wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """``docs`` with every live span of ``text`` replaced by ``mask``; rows and columns stay.

    Overlapping live spans are masked as one.  Copied examples and values that
    don't look random stay as they are.  The scan sends texts to Python and gets
    spans back; the rows wait in a work table under a row number, by which those
    with candidates meet the verdicts.  Only texts with live spans go to Python again."""
    bounded_batches(docs.sparkSession)
    row, held, live = fresh(docs, "row"), fresh(docs, "spans"), fresh(docs, "live")
    scanned = materialize(docs.withColumns({held: candidate_spans(F.col(text)), row: F.monotonically_increasing_id()}), "secret-redact")
    hit = scanned.where(F.size(held) > 0)
    one = hit.select(F.col(row).alias("row"), owner.alias("owner"), repo.alias("repo"), F.inline(held))
    spans = (judged(one, *_owners_and_repos(docs.select(owner.alias("owner"), repo.alias("repo"))), wide_owners)
             .where("live").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(live)).withColumnRenamed("row", row))
    cut = F.when(F.col(live).isNotNull(), F.col(text))
    masked = hit.join(spans, row, "left").withColumn(text, F.when(F.col(live).isNotNull(), masker(mask)(cut, F.col(live))).otherwise(F.col(text)))
    return scanned.where(F.size(held) == 0).select(*docs.columns).unionByName(masked.select(*docs.columns))
