"""Substring dedup by repeated-phrase automata.

1. Confirm recurring passages.  Every window of 13 words is hashed.  Windows
   that several documents of one batch share are settled there: the smallest
   document of the batch owns them and the others are marked; only one
   occurrence per batch goes on, so a passage in a third of all documents costs
   one row per batch.  A shuffle by hash range then finds the smallest document
   of each window overall.  Runs of an owner's windows are its passages.
2. Compile sharded automata.  Marked documents are spread over shards; a shard
   gets the passages of the owners its documents were marked for and compiles
   their seven-word blocks (every window holds one) into an Aho-Corasick
   automaton over words.
3. Stream the shard's documents.  Each block hit names the windows that may
   match; they are confirmed word by word against the owner's passages, and
   covered words are removed.

Defined results: null and empty texts have no words; documents are told apart
by id, so rows that repeat an id never remove each other's words; rows without
an id own nothing and lose nothing; windows are judged on the input only.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import map_arrow, materialize, mix, text_bytes, values, window_hashes, word_hashes

WINDOW = 13
#: Words of a block; a window of 13 words holds a whole block that starts at a multiple of 7.
BLOCK = (WINDOW + 1) // 2
#: Windows that a task sorts at once, and windows of one hash range.
BATCH_WINDOWS = 2_000_000
RANGE_WINDOWS = 1_000_000
#: Marked documents of one shard.
SHARD_DOCS = 400


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted uint64 values as differences, byte plane by byte plane (the upper planes compress away)."""
    gaps = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_ids(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_ids(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def owners_and_marks(h: np.ndarray, ids: np.ndarray):
    """For hashes in ascending order: index of each run's first, its smallest id, and (marked id, owner id) pairs.

    Also the (owner id, hash) pairs of runs that mark a document."""
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    if not len(first):
        none = np.zeros(0, np.int64)
        return first, none, (none, none), (none, np.zeros(0, np.uint64))
    least = np.minimum.reduceat(ids, first)
    owner = np.repeat(least, np.diff(np.append(first, len(h))))
    marked = ids > owner
    runs = np.logical_or.reduceat(marked, first)
    return first, least, (ids[marked], owner[marked]), (least[runs], h[first][runs])


def link_parts(marks, owned, buckets: int):
    """Marks and owned windows of one batch, packed by bucket of the document or owner: (kind, bucket, x, y)."""
    pairs = np.unique(np.stack(marks, 1), axis=0) if len(marks[0]) else np.zeros((0, 2), np.int64)
    for kind, key, other in ((MARKS, pairs[:, 0], pairs[:, 1]), (OWNED, owned[0], owned[1].view(np.int64))):
        bucket = (mix(np.ascontiguousarray(key).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for part in np.split(order, cuts[1:]) if len(order) else ():
            yield kind, int(bucket[part[0]]), pack_ids(key[part]), pack_ids(other[part])


#: Kinds of packed rows: windows (hashes, smallest ids), marks (documents, owners), owned windows (owners, hashes).
WINDOWS, MARKS, OWNED = 0, 1, 2


def recurring(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, owner, null) for marked documents and (null, owner, hashes) once for each owner of recurring windows."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, int(size // 6 // RANGE_WINDOWS))
    slim = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "part int, kind int, x binary, y binary"
    edges = np.array([(r << 64) // ranges for r in range(ranges)], np.uint64)

    def rows(parts) -> pa.RecordBatch:
        kinds, places, xs, ys = zip(*parts) if parts else ((),) * 4
        return pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(kinds, pa.int32()), pa.array(xs, pa.binary()), pa.array(ys, pa.binary())],
                                          names=["part", "kind", "x", "y"])

    def settle(held: list[tuple[int, np.ndarray]]):
        held.sort(key=lambda x: x[0])
        h = np.concatenate([x for _, x in held])
        ids = np.repeat(np.array([i for i, _ in held], np.int64), [len(x) for _, x in held])
        order = np.argsort(h, kind="stable")
        first, least, marks, owned = owners_and_marks(h[order], ids[order])
        h = h[order][first]
        cuts = np.append(np.searchsorted(h, edges), len(h))
        yield rows([(WINDOWS, r, pack_sorted(h[a:b]), pack_ids(least[a:b])) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a])
        yield rows(list(link_parts(marks, owned, ranges)))

    def hash_task(batches):
        held, total = [], 0
        for batch in batches:
            for key, raw in zip(values(batch.column("doc_id")), text_bytes(batch.column("text"))):
                h = window_hashes(word_hashes(raw), window)
                if len(h):
                    held.append((key, h))
                    total += len(h)
                if total >= BATCH_WINDOWS:
                    yield from settle(held)
                    held, total = [], 0
        if held:
            yield from settle(held)

    def range_task(batches):
        held, now = [], None

        def done():
            h = np.concatenate([x for x, _ in held])
            ids = np.concatenate([x for _, x in held])
            order = np.argsort(h, kind="stable")
            return rows(list(link_parts(*owners_and_marks(h[order], ids[order])[2:], ranges)))

        for batch in batches:
            passed = []
            for part, kind, x, y in zip(*(values(c) for c in batch.columns)):
                if kind != WINDOWS:
                    passed.append((kind, part, x, y))
                    continue
                if part != now and held:
                    yield done()
                    held.clear()
                now = part
                held.append((unpack_sorted(x), unpack_ids(y)))
            yield rows(passed)
        if held:
            yield done()

    def gather_task(batches):
        marks, owned, now = [], [], None

        def done():
            pairs = np.unique(np.concatenate([np.stack([unpack_ids(x), unpack_ids(y)], 1) for x, y in marks]), axis=0) if marks else np.zeros((0, 2), np.int64)
            owner = np.concatenate([unpack_ids(x) for x, _ in owned] or [np.zeros(0, np.int64)])
            h = np.concatenate([unpack_ids(y) for _, y in owned] or [np.zeros(0, np.int64)]).view(np.uint64)
            order = np.lexsort((h, owner))
            owner, h = owner[order], h[order]
            cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
            packed = [pack_sorted(np.unique(x)) for x in np.split(h, cuts[1:])] if len(cuts) else []
            return pa.RecordBatch.from_arrays(
                [pa.array([*pairs[:, 0].tolist(), *([None] * len(packed))], pa.int64()),
                 pa.array([*pairs[:, 1].tolist(), *owner[cuts].tolist()], pa.int64()),
                 pa.array([*([None] * len(pairs)), *packed], pa.binary())], names=["doc", "owner", "hashes"])

        for batch in batches:
            for part, kind, x, y in zip(*(values(c) for c in batch.columns)):
                if part != now and (marks or owned):
                    yield done()
                    marks.clear()
                    owned.clear()
                now = part
                (marks if kind == MARKS else owned).append((x, y))
        if marks or owned:
            yield done()

    dealt = lambda df: df.repartition("part").sortWithinPartitions("part")
    links = map_arrow(dealt(map_arrow(slim, hash_task, schema)), range_task, schema)
    return map_arrow(dealt(links), gather_task, "doc long, owner long, hashes binary")


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


class Automaton:
    """Passages of a shard: blocks in an Aho-Corasick automaton, windows with their smallest owner."""

    def __init__(self, passages: list[tuple[int, bytes]], window: int = WINDOW):
        self.window, self.block = window, (window + 1) // 2
        self.ids: dict[bytes, int] = {}
        self.owner: dict[bytes, int] = {}
        blocks = set()
        for owner, passage in passages:
            ids = [self.ids.setdefault(w, len(self.ids) + 1) for w in passage.split(b" ")]
            blocks.update(tuple(ids[i:i + self.block]) for i in range(0, len(ids) - self.block + 1, self.block))
            flat = np.array(ids, np.uint32).tobytes()
            for i in range(0, 4 * (len(ids) - window + 1), 4):
                key = flat[i:i + 4 * window]
                if self.owner.get(key, owner) >= owner:
                    self.owner[key] = owner
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
        for b in blocks:
            self.automaton.add_word(b)
        self.empty = not blocks
        if blocks:
            self.automaton.make_automaton()

    def covered(self, doc_id: int, words: list[bytes]) -> np.ndarray:
        """Which words lie in a window that a smaller document of the passages holds."""
        n, size = len(words), self.window
        out = np.zeros(n, bool)
        if self.empty or n < size:
            return out
        get = self.ids.get
        ids = tuple(get(w, 0) for w in words)
        flat = np.array(ids, np.uint32).tobytes()
        nxt = 0
        for end, _ in self.automaton.iter(ids):
            for s in range(max(nxt, end - size + 1), min(end - self.block + 1, n - size) + 1):
                if self.owner.get(flat[4 * s:4 * (s + size)], doc_id) < doc_id:
                    out[s:s + size] = True
            nxt = max(nxt, end - self.block + 2)
        return out


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   keep_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (and kept, if ``keep_text``)."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    links = materialize(recurring(slim, window), "phrase-links")
    marks = links.where(F.col("doc").isNotNull()).select("doc", "owner").distinct()
    roles = (links.select(F.coalesce("doc", "owner").alias("doc_id"), F.col("doc").isNotNull().alias("marked"), "hashes")
             .groupBy("doc_id").agg(F.max("marked").alias("marked"), F.collect_list("hashes").alias("hashes")))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, marked boolean, kept binary, passages array<binary>"
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                       ("marked", pa.bool_()), ("kept", pa.binary()), ("passages", pa.list_(pa.binary()))])

    def press_task(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([press.compress(x) for x in text_bytes(batch.column("text"))], pa.binary())],
                                             names=["doc_id", "text"])

    def role_task(batches):
        press, expand = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            marked = [bool(m) for m in batch.column("marked").to_pylist()]
            for pressed, m, packed in zip(values(batch.column("text")), marked, batch.column("hashes").to_pylist()):
                raw = expand.decompress(pressed)
                words = raw.split()
                passages = None
                if packed:
                    wanted = np.unique(np.concatenate([unpack_sorted(p) for p in packed]))
                    at = np.flatnonzero(np.isin(window_hashes(word_hashes(raw), window), wanted))
                    runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []
                    passages = [press.compress(x) for x in {b" ".join(words[r[0]:r[-1] + window]) for r in runs}]
                rows.append((len(words), 0, None if m else digest(words), pressed if m else b" ".join(words) if keep_text else None, passages))
            n_words, zeros, shas, kept, passages = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, arrow.field(i).type) for i, c in
                                           ((1, n_words), (2, zeros), (3, shas), (4, marked), (5, kept), (6, passages)))], schema=arrow)

    parts = materialize(map_arrow(map_arrow(slim, press_task, "doc_id long, text binary").join(roles, "doc_id", "left"), role_task, schema), "phrase-roles")
    marked = parts.where("marked")
    shards = int(marked.count() // SHARD_DOCS) + 1
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")
    needed = marks.select(shard(F.col("doc")).alias("shard"), F.col("owner").alias("doc_id")).distinct()
    sources = needed.join(parts.where(F.col("passages").isNotNull()).select("doc_id", F.explode("passages").alias("body")), "doc_id")
    rows = (sources.select("shard", F.lit(0).alias("step"), "doc_id", "body")
            .unionByName(marked.select(shard(F.col("doc_id")).alias("shard"), F.lit(1).alias("step"), "doc_id", F.col("kept").alias("body")))
            .repartition("shard").sortWithinPartitions("shard", "step"))

    def shard_task(batches):
        now, passages, automaton, expand = None, [], None, zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for shard_id, step, key, body in zip(*(values(c) for c in batch.columns)):
                body = expand.decompress(body)
                if shard_id != now:
                    now, passages, automaton = shard_id, [], None
                if step == 0:
                    passages.append((key, body))
                    continue
                if automaton is None:
                    automaton = Automaton(passages, window)
                    passages = []
                words = body.split()
                gone = automaton.covered(key, words)
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
                out.append((key, len(words), len(words) - len(kept), digest(kept), b" ".join(kept) if keep_text else None))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                                                 names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    changed = map_arrow(rows, shard_task, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if keep_text else [])]
    out = parts.where(~F.col("marked")).select(*names).unionByName(changed.select(*names))
    return out.withColumn("kept", F.col("kept").cast("string")) if keep_text else out
