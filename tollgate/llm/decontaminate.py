"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may be found with up to k = floor(rate * m) edits.  It
is split into k + 1 pieces: any occurrence within k edits holds at least one
piece unchanged.  One automaton per block of items finds exact piece hits in
every whole text; the hits fix a window of the text, which Myers' bit-parallel
algorithm verifies.  Text and items are compared lower-cased with white space
runs as one space.

Items are the query set and are handled in blocks of bounded size.

Defined results: null and empty texts match nothing; items with fewer than
``min_chars`` normalized characters match without edits only, and not where they
begin or end inside a word; repeated items and repeated documents each get their own rows; ties
in distance take the leftmost end.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import map_arrow

ERROR_RATE = 0.07
MIN_CHARS = 32
#: Characters of item text that one automaton holds.
BLOCK_CHARS = 4_000_000


def normalize(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, rate: float = ERROR_RATE) -> list[tuple[str, int]]:
    """The item's k + 1 pieces with their offsets, as equal in length as possible."""
    m = len(item)
    parts = int(m * rate) + 1
    cuts = [m * i // parts for i in range(parts + 1)]
    return [(item[a:b], a) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end) of the best occurrence of ``pattern`` in ``text``; the leftmost end on ties."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    best, end = m, 0
    get = peq.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = vn | (full & ~(d0 | vp))
        hn = vp & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = hp << 1 & full
        hn = hn << 1 & full
        vp = hn | (full & ~(d0 | hp))
        vn = hp & d0
        if score < best:
            best, end = score, j
    return best, end


def at_borders(text: str, start: int, stop: int) -> bool:
    """Whether ``text[start:stop]`` neither begins nor ends inside a word."""
    word = lambda c: c.isalnum() or c == "_"
    return not (start and word(text[start]) and word(text[start - 1])
                or stop < len(text) and word(text[stop - 1]) and word(text[stop]))


class Matcher:
    """Items of one block, compiled once per task."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE, min_chars: int = MIN_CHARS):
        self.items = [(key, norm) for key, text in items if (norm := normalize(text))]
        self.short = [len(norm) < min_chars for _, norm in self.items]
        self.budgets = [0 if short else int(len(norm) * rate) for short, (_, norm) in zip(self.short, self.items)]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, norm) in enumerate(self.items):
            for piece, at in [(norm, 0)] if self.short[i] else pieces(norm, rate):
                places.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item key, distance, budget, end in the normalized text): each item's best occurrence."""
        if self.empty or not text:
            return []
        text = normalize(text)
        starts: dict[int, list[int]] = {}
        whole: dict[int, int] = {}
        for end, (length, where) in self.automaton.iter(text):
            for i, at in where:
                if self.short[i]:
                    if i not in whole and at_borders(text, end + 1 - length, end + 1):
                        whole[i] = end + 1
                    continue
                starts.setdefault(i, []).append(end + 1 - length - at)
        out = [(self.items[i][0], 0, 0, stop) for i, stop in whole.items()]
        for i, at in starts.items():
            key, item = self.items[i]
            k, best, stop = self.budgets[i], self.budgets[i] + 1, 0
            exact = text.find(item, max(0, min(at)))
            if exact >= 0:
                best, stop = 0, exact + len(item)
            else:
                # Hits whose windows overlap are verified together.
                at.sort()
                lo = hi = None
                for s in [*at, None]:
                    if lo is not None and (s is None or s - k > hi):
                        low = max(0, lo)
                        distance, end = myers(item, text[low:hi])
                        if distance < best:
                            best, stop = distance, low + end
                        lo = None
                    if s is None:
                        break
                    lo = s - k if lo is None else lo
                    hi = s + len(item) + k
            if best <= k:
                out.append((key, best, k, stop))
        return sorted(out, key=lambda x: (x[0] is None, x[0], x[3]))


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int = BLOCK_CHARS):
    """The query set in blocks of about ``block_chars`` characters each."""
    slim = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text"))
    total = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(total // block_chars) + 1
    for b in range(n):
        block = slim if n == 1 else slim.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b)
        yield [(r["id"], r["text"]) for r in block.collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE,
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per (document, item) that match: doc_id, item_id, distance, budget, end_char."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([slim.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in ("item_id", "distance", "budget", "end_char"))])
    out = None
    for items in item_blocks(benchmark, item_id, item_text):

        def task(batches, items=items):
            matcher = Matcher(items, rate, min_chars)
            for batch in batches:
                rows, found = [], [[] for _ in range(4)]
                for i, value in enumerate(batch.column("text").to_pylist()):
                    for match in matcher.matches(value):
                        rows.append(i)
                        for column, v in zip(found, match):
                            column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in found)],
                    names=["doc_id", "item_id", "distance", "budget", "end_char"])

        part = map_arrow(slim, task, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text", rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the rows that match any item; all columns stay as they are."""
    for items in item_blocks(benchmark, item_id, item_text):

        def task(batches, items=items):
            matcher = Matcher(items, rate, min_chars)
            for batch in batches:
                keep = [not matcher.matches(v) for v in batch.column(text).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = map_arrow(docs, task, docs.schema)
    return docs
