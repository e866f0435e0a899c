"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Documents with the same words form one class, whose smallest document stands
for it.  Shingles are ordered rare first by counts over all documents, kept in
a table of fixed size (hashed counters), ties by hash.  A document's prefix is
its first ``n - ceil(t n) + 1`` shingles in that order; similar sets share one.
Documents meet in the buckets of prefix shingles that at least two classes
hold, and pass three filters: length, position (shingles left after the match),
and suffix (a lower bound of the symmetric difference from parity bits of the
sets).  Postings are bare; the bits are as long as the set and go to a pair's two
documents once, or to the few postings of large buckets.  Pairs that pass are
verified on whole texts, once each.

Groups: a small bucket is joined with itself and hands on all pairs that pass
length and position, for the suffix filter; a large one applies all three and
hands on only a forest that spans the pairs that pass, which is verified and
merged into components.  Afterwards large buckets are looked through again for pairs that pass and lie in
different components, and these are verified too, so no link between
components is lost and no group is written out as all its pairs.  Buckets are
split into blocks of bounded size, second time as pairs of blocks.

Defined results: null, empty and blank texts have no set and link with
nothing; fewer words than a shingle make one shingle; rows that share an id are
one document; rows without an id link with nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import fresh, map_arrow, materialize, mix, text_bytes, values, window_hashes, word_hashes
from tollgate.llm.components import components

SHINGLE = 4
PERCENT = 85
#: Hashed counters that order the shingles: one for so many bytes of text, a power of two within these bounds; those of one shuffled row.
SLOT_BYTES, MIN_SLOTS, MAX_SLOTS, SLOT_BLOCK = 200, 1 << 16, 1 << 23, 1 << 12
#: Bucket rows up to which all pairs that pass are handed on, and rows of a block.
SMALL, BLOCK = 12, 2048
#: Parity slots for each element: with more of them fewer differences cancel out, and pairs just under the threshold fail the suffix filter.
SLOTS_EACH = 4
#: A shingle is hot with a part of all postings over one in so many (and more than a block); groups in which hot ones are looked for.
HOT_PART, HOT_GROUPS = 1024, 1 << 16


def shingle_set(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = word_hashes(raw.lower())
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(size, len(words))))


def class_key(raw: bytes) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(raw.lower().split()))


def least_overlap(nx, ny, percent: int = PERCENT):
    """Smallest intersection with which sets of these sizes link."""
    return -((-percent * (nx + ny)) // (100 + percent))


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """Parity of the set's elements per slot; at least ``SLOTS_EACH`` slots for each element."""
    bits = 64
    while bits < SLOTS_EACH * len(shingles):
        bits *= 2
    at = (mix(shingles) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little")


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Parity bits of the same set in ``size`` bytes."""
    while len(bits) > size:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def slots_of(shingles: np.ndarray, slots: int) -> np.ndarray:
    return (shingles >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def slot_counts(docs: DataFrame, size: int) -> np.ndarray:
    """How often shingles of each slot occur, over all documents; at most MAX_SLOTS numbers reach the driver."""
    text_size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = min(MAX_SLOTS, max(MIN_SLOTS, 1 << round(math.log2(max(1, text_size / SLOT_BYTES)))))

    def count_task(batches):
        total, held, n = np.zeros(slots, np.int64), [], 0
        for batch in batches:
            for raw in text_bytes(batch.column("text")):
                words = word_hashes(raw.lower())
                held.append(window_hashes(words, min(size, max(1, len(words)))))
                n += len(held[-1])
                if n > 1_000_000:
                    total += np.bincount(slots_of(np.concatenate(held), slots), minlength=slots)
                    held, n = [], 0
        if held:
            total += np.bincount(slots_of(np.concatenate(held), slots), minlength=slots)
        press = zstandard.ZstdCompressor(level=1)
        parts = total.astype(np.uint32).reshape(-1, SLOT_BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([press.compress(p.tobytes()) for p in parts], pa.binary())],
                                         names=["block", "counts"])

    def sum_task(batches):
        sums: dict[int, np.ndarray] = {}
        expand, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for block, raw in zip(values(batch.column(0)), values(batch.column(1))):
                sums[block] = sums.get(block, 0) + np.frombuffer(expand.decompress(raw), np.uint32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([press.compress(np.minimum(v, 2 ** 32 - 1).astype(np.uint32).tobytes()) for v in sums.values()], pa.binary())],
                                         names=["block", "counts"])

    schema = "block int, counts binary"
    summed = map_arrow(map_arrow(docs.select("text"), count_task, schema).repartition("block"), sum_task, schema)
    out, expand = np.zeros(slots, np.uint32), zstandard.ZstdDecompressor()
    for block, raw in summed.collect():
        out[block * SLOT_BLOCK:(block + 1) * SLOT_BLOCK] = np.frombuffer(expand.decompress(raw), np.uint32)
    return out


def prefixes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, class, n, prefix (rare first), bits of every row."""
    counts = docs.sparkSession.sparkContext.broadcast(slot_counts(docs, size))

    def task(batches):
        order_of = counts.value
        for batch in batches:
            out = [[] for _ in range(4)]
            for raw in text_bytes(batch.column("text")):
                s = shingle_set(raw, size)
                n = len(s)
                keep = n - -(-percent * n // 100) + 1 if n else 0
                rare = s[np.argsort(order_of[slots_of(s, len(order_of))], kind="stable")[:keep]]
                for column, v in zip(out, (class_key(raw) if n else None, n, rare.view(np.int64), parity_bits(s).tobytes() if n else None)):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary())],
                                             names=["doc_id", "class", "n", "prefix", "bits"])

    return map_arrow(docs, task, "doc_id long, class binary, n long, prefix array<long>, bits binary")


def apart(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the symmetric difference of two sets, from their parity bits."""
    size = min(len(x), len(y))
    return int(np.bitwise_count(fold(x, size) ^ fold(y, size)).sum(dtype=np.int64))


def passing(n: np.ndarray, pos: np.ndarray, bits: list[np.ndarray], i: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``others`` that pass the length, position and suffix filters with row ``i``."""
    m = n[others]
    ok = 100 * np.minimum(m, n[i]) >= percent * np.maximum(m, n[i])
    need = least_overlap(m, n[i], percent)
    ok &= 1 + np.minimum(m - pos[others], n[i] - pos[i]) - 1 >= need
    at = np.flatnonzero(ok)
    if not len(at):
        return others[:0]
    width = len(bits[i])
    size = min(width, *(len(bits[j]) for j in others[at])) if len(at) else width
    mine = fold(bits[i], size)
    theirs = np.stack([fold(bits[j], size) for j in others[at]])
    differ = np.bitwise_count(theirs ^ mine).sum(1, dtype=np.int64)
    return others[at[differ <= m[at] + n[i] - 2 * need[at]]]


def bucket_pairs(rows: list[tuple], percent: int, forest: bool) -> list[tuple[int, int]]:
    """Pairs that pass in a bucket of rows (doc, n, pos, bits, block, group): all, or a spanning forest of them.

    Rows of one group never pair; rows are compared across the two blocks only, if there are two."""
    rows.sort(key=lambda r: (r[1], r[0]))
    ids = [r[0] for r in rows]
    n, pos = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
    bits = [np.frombuffer(r[3], np.uint8) for r in rows]
    side = np.array([r[4] for r in rows], np.int64)
    group = np.array([r[5] for r in rows], np.int64)
    root = np.arange(len(rows))
    split, out, low = len(set(side.tolist())) > 1, [], 0
    for i in range(1, len(rows)):
        while 100 * n[low] < percent * n[i]:
            low += 1
        others = np.arange(low, i)
        if split:
            others = others[side[others] != side[i]]
        others = others[(group[others] != group[i]) | (group[i] < 0)]
        if forest:
            others = others[root[others] != root[i]]
        if not len(others):
            continue
        for j in passing(n, pos, bits, i, others, percent):
            if forest:
                if root[j] == root[i]:
                    continue
                root[root == root[j]] = root[i]
            out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return out


def candidate_pairs(buckets: DataFrame, percent: int, spare: bool) -> DataFrame:
    """Distinct (a, b) from rows (token, part, doc, n, pos, bits, side, grp)."""
    def task(batches):
        now, rows = None, []

        def done():
            pairs = bucket_pairs(rows, percent, spare and len(rows) > SMALL) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

        for batch in batches:
            for token, part, *row in zip(*(values(c) for c in batch.columns)):
                if (token, part) != now:
                    if len(rows) > 1:
                        yield done()
                    now, rows = (token, part), []
                rows.append(row)
        if len(rows) > 1:
            yield done()

    dealt = buckets.repartition("token", "part").sortWithinPartitions("token", "part")
    return map_arrow(dealt, task, "a long, b long").distinct()


def small_bucket_pairs(posted: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) that pass the length and position filters in buckets of at most SMALL rows (token, doc, n, pos)."""
    pairs = posted.toDF("token", "a", "na", "pa").join(posted.toDF("token", "b", "nb", "pb"), "token")
    need = F.ceil(percent * (F.col("na") + F.col("nb")) / F.lit(100 + percent))
    return pairs.where((F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
                       & (F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= need)).select("a", "b").distinct()


def suffix_passing(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the suffix filter; ``bits`` has doc, n, bits (an id with several texts several times)."""
    def task(batches):
        for batch in batches:
            keep = []
            for nx, x, ny, y in zip(*(values(batch.column(c)) for c in ("nx", "x", "ny", "y"))):
                keep.append(apart(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) <= nx + ny - 2 * least_overlap(nx, ny, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = (pairs.join(bits.toDF("a", "nx", "x"), "a").join(bits.toDF("b", "ny", "y"), "b").select("a", "b", "nx", "x", "ny", "y"))
    return map_arrow(rows, task, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link, with ``links``."""
    involved = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()

    def set_task(batches):
        for batch in batches:
            sets = [shingle_set(raw, size).tobytes() for raw in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])

    sets = materialize(map_arrow(docs.join(involved, "doc_id").select("doc_id", "text"), set_task, "doc_id long, shingles binary"), "jaccard-sets")

    def link_task(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y"))
    return map_arrow(rows, link_task, "a long, b long")


def hot_sizes(posted: DataFrame) -> DataFrame:
    """(token, size) of the hot tokens, at most HOT_PART rows.

    Counts are combined before each shuffle: first of HOT_GROUPS groups of tokens, then of the tokens in heavy groups."""
    group = F.pmod(F.xxhash64("token"), F.lit(HOT_GROUPS))
    groups = posted.groupBy(group.alias("g")).agg(F.count("*").alias("size")).collect()
    least = max(BLOCK, sum(r["size"] for r in groups) // HOT_PART)
    heavy = [r["g"] for r in groups if r["size"] > least]
    if not heavy:
        return posted.sparkSession.createDataFrame([], "token long, size long")
    return materialize(posted.where(group.isin(heavy)).groupBy("token").agg(F.count("*").alias("size")).where(F.col("size") > least), "jaccard-hot")


def with_sizes(posted: DataFrame) -> DataFrame:
    """Postings (token, doc, n, pos) of tokens that at least two rows hold, with ``size``, the rows of the token.

    Hot tokens get theirs from a small table, so no task meets all postings of one."""
    hot = F.broadcast(hot_sizes(posted))
    cold = posted.join(hot, "token", "left_anti").withColumn("size", F.count("*").over(Window.partitionBy("token")))
    return cold.where("size > 1").unionByName(posted.join(hot, "token"))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(prefixes(slim, size, percent), "jaccard-prefixes")
    usable = rows.where(F.col("class").isNotNull() & F.col("doc_id").isNotNull())
    reps = materialize(usable.groupBy("class").agg(F.min("doc_id").alias("rep"),
                                                   F.min_by(F.struct("n", "prefix", "bits"), "doc_id").alias("s"))
                       .select("class", "rep", "s.*"), "jaccard-classes")
    posted = reps.select(F.posexplode("prefix").alias("pos", "token"), F.col("rep").alias("doc"), "n")
    posted = with_sizes(posted).select("token", "doc", "n", "pos", "size", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    posted = posted.withColumn("block", F.pmod(F.xxhash64("doc", "token"), F.col("blocks")).cast("int"))
    posted = materialize(posted, "jaccard-buckets")
    bits = reps.select(F.col("rep").alias("doc"), "n", "bits")
    bucket = ["token", F.col("block").alias("part"), "doc", "n", "pos", "bits", F.lit(0).alias("side"), F.lit(-1).cast("long").alias("grp")]
    bare = posted.where(F.col("size") <= SMALL).select("token", "doc", "n", "pos")
    large = materialize(posted.where(F.col("size") > SMALL).join(bits, ["doc", "n"]), "jaccard-large")
    near = suffix_passing(small_bucket_pairs(bare, percent), bits, percent)
    first = materialize(near.unionByName(candidate_pairs(large.select(*bucket), percent, True)).distinct(), "jaccard-pairs")
    links = materialize(verified(first, slim, size, percent), "jaccard-links")
    roots = components(links)
    # Second look at large buckets: pairs that pass between different components.
    large = (large
             .join(roots.withColumnsRenamed({"node": "doc", "root": "grp"}), "doc", "left")
             .withColumn("grp", F.coalesce("grp", "doc")))
    mixed = large.groupBy("token").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo < hi").select("token")
    large = large.join(mixed, "token")
    paired = large.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    again = candidate_pairs(paired.select("token", (low * F.col("blocks") + high).cast("int").alias("part"), "doc", "n", "pos", "bits",
                                          F.col("block").alias("side"), "grp"), percent, False)
    more = materialize(again.join(first, ["a", "b"], "left_anti"), "jaccard-pairs")
    if more.limit(1).count():
        roots = components(links.unionByName(verified(more, slim, size, percent)))
    found = (reps.select("class", "rep").join(roots, F.col("rep") == F.col("node"), "left")
             .select("class", F.coalesce("root", "rep").alias("root")))
    return (rows.select("doc_id", "class", "n").join(found, "class", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that link to a smaller one; columns stay."""
    name = fresh(docs, "gone")
    gone = (jaccard_components(docs, doc_id, text, size, percent).where("component_id <> doc_id")
            .select(F.col("doc_id").alias(name)).distinct())
    return docs.join(gone, F.col(doc_id).cast("long") == F.col(name), "left_anti")
