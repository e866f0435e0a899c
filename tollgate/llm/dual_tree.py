"""Ranked lexical search by dual trees.

Terms are runs of ASCII letters and digits and of all other code points from
U+0080, with only A-Z lowered.  A term's impact in a document is
(10**9 * tf) div (1000 * tf + 8 * m), with m = 10 + (90 * n * N) div L; a
document's score for an item is the sum of weight * impact over the item's terms.

One pass counts documents, terms and the document frequencies of the items'
terms.  A second pass searches: each task builds, for bounded groups of its
documents, a hierarchy whose nodes hold the largest impact of every term below
them; the items have a hierarchy too, whose nodes hold the largest weights.  The
dot product of two nodes bounds every score between them.  A pair of nodes is
left out only if that bound is below the weakest kth score that any item below
it has so far in the task, so the result is exact.  Tasks return k rows per item
at most, which a ranking per item merges.

Items are the query set: blocks of bounded text (``BLOCK_CHARS``), each of which
reads the documents twice.  Sums are exact in doubles as long as weight * impact
summed over an item stays below 2**53; items of more terms than that allows
(about 300,000 distinct ones) are scored with 64-bit integers.

Defined results: null and empty texts hold no terms and count in no statistic;
items without terms, or none of whose terms occur, get no rows, and an empty
table gives none.  Repeated document rows are documents each; equal scores go by
ascending doc_id, null ids last; rows of one doc_id with equal scores are told
apart by nothing and each take a rank.  Repeated (item_id, text) rows are one
item; other items that share an id are ranked one by one.  Very long texts are
read in slices cut between terms.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import map_arrow, text_bytes

TOP = 10
#: Characters of item text that one block (and so one vocabulary in a task) holds.
BLOCK_CHARS = 8_000_000
#: Documents of a leaf, children of a node, documents and postings of one group.
LEAF, FAN, GROUP, POSTINGS = 32, 8, 8192, 2_000_000
#: Bytes of text whose terms are listed at once.
SLICE = 1 << 20
#: Fixed: one letter or digit of a term, in UTF-8 with A-Z lowered.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: A missing place in a ranking, and the id that stands for null.
NO_ID = 2 ** 63 - 1
EXACT = 2 ** 53


def terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists of bounded size."""
    raw, at = raw.lower(), 0  # bytes.lower() changes A-Z alone
    while len(raw) - at > SLICE:
        gap = re.compile(rb"[^0-9a-z\x80-\xff]").search(raw, at + SLICE)
        if not gap:
            break
        yield TERM.findall(raw, at, gap.start())
        at = gap.start()
    yield TERM.findall(raw, at)


def held_terms(raw: bytes, vocabulary: dict[bytes, int]) -> tuple[int, Counter]:
    """Number of all terms, and the counts of those of the vocabulary."""
    n, tf = 0, Counter()
    for found in terms(raw):
        n += len(found)
        tf.update(x for x in map(vocabulary.get, found) if x is not None)
    return n, tf


class Rows:
    """Rows of sparse vectors, one after the other: row r has ``term`` and ``value`` from ``start[r]`` to ``start[r + 1]``."""

    def __init__(self, start: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.start, self.term, self.value = start, term, value

    def __len__(self) -> int:
        return len(self.start) - 1

    def span(self, row: int) -> slice:
        return slice(self.start[row], self.start[row + 1])

    def picked(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of ``rows``, and where each row's begin among them."""
        size = self.start[rows + 1] - self.start[rows]
        first = np.cumsum(size) - size
        return np.repeat(self.start[rows] - first, size) + np.arange(size.sum()), first

    def maxima(self, fan: int, width: int) -> Rows:
        """One row for each ``fan`` rows: the largest value of every term."""
        row = np.repeat(np.arange(len(self)) // fan, np.diff(self.start))
        key = row * width + self.term
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        value = np.maximum.reduceat(self.value[order], first)
        row = key[first] // width
        return Rows(np.searchsorted(row, np.arange(-(-len(self) // fan) + 1)), key[first] % width, value)


def sorted_rows(rows: list[tuple[np.ndarray, np.ndarray]], order: np.ndarray) -> Rows:
    sizes = [0, *(len(rows[i][0]) for i in order)]
    return Rows(np.cumsum(sizes), np.concatenate([rows[i][0] for i in order]), np.concatenate([rows[i][1] for i in order]))


def hierarchy(leaves: Rows, fan: int, width: int) -> list[Rows]:
    """Levels from ``leaves`` to a single root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].maxima(fan, width))
    return levels


class Search:
    """The items' hierarchy and their best documents so far.

    ``items`` has one (term numbers, weights) for each; all have at least one term."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], width: int, top: int):
        self.width, self.top = width, top
        self.weight = np.zeros(width)
        for t, w in items:
            self.weight[t] = w
        light = [int(t[np.argmin(w)]) for t, w in items]  # items that share their commonest term lie together
        self.order = np.lexsort((np.arange(len(items)), light))
        self.levels = hierarchy(sorted_rows(items, self.order), FAN, width)
        self.cover = [np.minimum(np.arange(len(x) + 1) * FAN ** k, len(items)) for k, x in enumerate(self.levels)]
        largest = 10 ** 6 * max((float(w.sum()) for _, w in items), default=0.0)
        self.kind = np.float64 if largest < EXACT else np.int64
        self.scores = np.zeros((len(items), top), self.kind)
        self.ids = np.full((len(items), top), NO_ID)
        self.dense, self.place = np.zeros(width), np.full(width, -1)
        #: Pairs of a document and an item that were scored.
        self.scored = 0

    def weakest(self) -> np.ndarray:
        return self.scores[:, -1]

    def surviving(self, node: Rows, row: int, live: np.ndarray) -> np.ndarray:
        """The items among ``live`` (a mask) that a document below the node may still serve."""
        here = node.span(row)
        self.dense[node.term[here]] = node.value[here]
        limit = np.where(live, self.weakest(), np.inf)
        nodes = np.arange(len(self.levels[-1]))
        for k in range(len(self.levels) - 1, -1, -1):
            level, cover = self.levels[k], self.cover[k]
            places, first = level.picked(nodes)
            # The largest sums may round in doubles: never prune by less than that.
            bound = np.add.reduceat(level.value[places] * self.dense[level.term[places]], first) * (1 + 1e-9)
            least = np.minimum.reduceat(limit, cover[:-1])[nodes]
            nodes = nodes[(bound > 0) & (bound >= least)]
            if not len(nodes):
                break
            if k:
                nodes = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
                nodes = nodes[nodes < len(self.levels[k - 1])]
        self.dense[node.term[here]] = 0
        return nodes

    def visit(self, levels: list[Rows], k: int, row: int, live: np.ndarray, docs: Rows, ids: np.ndarray) -> None:
        """``levels[k]``'s node ``row`` against the items of ``live``."""
        items = self.surviving(levels[k], row, live)
        if not len(items):
            return
        if k == 0:
            self.score(levels[0], row, items, docs, ids)
            return
        below = np.zeros_like(live)
        below[items] = True
        children = range(row * FAN, min(row * FAN + FAN, len(levels[k - 1])))
        child = levels[k - 1]
        best = {c: float(child.value[child.span(c)] @ self.weight[child.term[child.span(c)]]) for c in children}
        for c in sorted(children, key=lambda c: -best[c]):
            self.visit(levels, k - 1, c, below, docs, ids)

    def score(self, leaves: Rows, row: int, items: np.ndarray, docs: Rows, ids: np.ndarray) -> None:
        """All documents of a leaf against ``items``, exactly."""
        here, level = leaves.term[leaves.span(row)], self.levels[0]
        self.place[here] = np.arange(len(here))
        first, last = row * LEAF, min(row * LEAF + LEAF, len(docs))
        span = slice(docs.start[first], docs.start[last])
        impact = np.zeros((last - first, len(here)), self.kind)
        impact[np.repeat(np.arange(last - first), np.diff(docs.start[first:last + 1])), self.place[docs.term[span]]] = docs.value[span]
        places, begin = level.picked(items)
        column = self.place[level.term[places]]
        item = np.repeat(np.arange(len(items)), np.diff(np.append(begin, len(places))))
        weight = np.zeros((len(here), len(items)), self.kind)
        weight[column[column >= 0], item[column >= 0]] = level.value[places][column >= 0]
        self.place[here] = -1
        scores = (impact @ weight).T
        self.scored += scores.size
        better = scores.max(axis=1) >= np.maximum(self.weakest()[items], 1)
        if better.any():
            items, scores = items[better], scores[better]
            scores = np.concatenate([self.scores[items], scores], axis=1)
            found = np.concatenate([self.ids[items], np.broadcast_to(ids[first:last], (len(items), last - first))], axis=1)
            order = np.lexsort((found, -scores), axis=-1)[:, :self.top]
            self.scores[items], self.ids[items] = np.take_along_axis(scores, order, 1), np.take_along_axis(found, order, 1)

    def add(self, rows: list[tuple[np.ndarray, np.ndarray]], ids: list[int]) -> None:
        """A group of documents, each with its (term numbers, impacts) of at least one term."""
        head = [(int(t[i]), -float(v[i])) for t, v in rows for i in [int(np.argmax(v * self.weight[t]))]]
        order = np.lexsort(([h[1] for h in head], [h[0] for h in head]))  # documents with the same strongest term lie together
        docs = sorted_rows(rows, order)
        levels = hierarchy(docs.maxima(LEAF, self.width), FAN, self.width)
        self.visit(levels, len(levels) - 1, 0, np.ones(len(self.order), bool), docs, np.array(ids, np.int64)[order])

    def best(self) -> Iterator[tuple[int, int, int]]:
        """(item, score, doc id) of every place taken."""
        for place, item in enumerate(self.order):
            for score, doc in zip(self.scores[place], self.ids[place]):
                if score > 0:
                    yield int(item), int(score), int(doc)


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[object, str]]]:
    """(id, text) of the distinct items, in blocks of bounded text."""
    block, size = [], 0
    for r in items.select(F.col(item_id).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t")).distinct().toLocalIterator():
        if block and size + len(r["t"]) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += len(r["t"])
    if block:
        yield block


def corpus_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all terms, and the document frequency of each of the vocabulary."""
    def counts(batches):
        n_docs = n_terms = 0
        df: Counter = Counter()
        for b in batches:
            for raw in text_bytes(b.column(0)):
                n, tf = held_terms(raw, vocabulary)
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                df.update(tf.keys())
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *df.keys()], pa.int64()), pa.array([n_docs, n_terms, *df.values()], pa.int64())], ["term", "n"])

    found = {r["term"]: r["n"] for r in map_arrow(docs.select("text"), counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return found.pop(-2, 0), found.pop(-1, 0), found


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: Counter, n: int, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    m = 10 + (90 * n * n_docs) // n_terms
    term, count = np.array(list(tf.keys()), np.int64), np.array(list(tf.values()), np.int64)
    return term, ((1_000_000_000 * count) // (1000 * count + 8 * m)).astype(np.float64)


def _block_search(docs: DataFrame, block: list[tuple[object, str]], id_type: T.DataType, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    held = [sorted({t for part in terms(text.encode()) for t in part}) for _, text in block]
    vocabulary = {t: i for i, t in enumerate(sorted({t for x in held for t in x}))}
    n_docs, n_terms, df = corpus_counts(docs, vocabulary)
    weight = {i: term_weight(n_docs, df[i]) for i in df}
    known = [np.array([i for i in map(vocabulary.get, x) if weight.get(i)], np.int64) for x in held]
    numbers = [k for k, x in enumerate(known) if len(x)]
    if not numbers:
        return None
    vectors = [(known[k], np.array([weight[i] for i in known[k].tolist()], np.float64)) for k in numbers]
    vocabulary = {t: i for t, i in vocabulary.items() if weight.get(i)}
    width = max(vocabulary.values()) + 1

    def search(batches):
        found, group, ids, postings = Search(vectors, width, top), [], [], 0
        for b in batches:
            for raw, doc in zip(text_bytes(b.column(1)), b.column(0).to_pylist()):
                n, tf = held_terms(raw, vocabulary)
                if tf:
                    group.append(impacts(tf, n, n_docs, n_terms))
                    ids.append(NO_ID if doc is None else doc)
                    postings += len(tf)
                if len(group) >= GROUP or postings >= POSTINGS:
                    found.add(group, ids)
                    group, ids, postings = [], [], 0
        if group:
            found.add(group, ids)
        best = list(found.best())
        for at in range(0, len(best), 50_000):
            item, score, doc = zip(*best[at:at + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(score, pa.int64()),
                                              pa.array([None if d == NO_ID else d for d in doc], pa.int64())], ["item", "score", "doc_id"])

    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = (map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), search, "item int, score long, doc_id long")
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    names = spark.createDataFrame([(i, block[k][0]) for i, k in enumerate(numbers)],
                                  T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_type)]))
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, item_id: str = "item_id", item_text: str = "text",
                  doc_id: str = "doc_id", doc_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``top`` best documents."""
    id_type = items.schema[item_id].dataType
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text"))
    found = None
    for block in item_blocks(items, item_id, item_text):
        part = _block_search(narrow, block, id_type, top)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        schema = T.StructType([T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType()),
                               T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
        return docs.sparkSession.createDataFrame([], schema)
    return found
