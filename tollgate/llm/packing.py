"""Best-fit packing by exact complements.

Documents become token ids; only those longer than a sequence are cut.  The
plan is made on the histogram of piece lengths, whose size is bounded by the
sequence length: for the longest length left, sums of one, two and three
lengths that fill the gap exactly are looked up under the counts left, and
taken as often as the counts allow; where none exists the largest length that
fits is added (best fit) and the lookup repeats for the smaller gap.  Pieces
are then numbered within their length and take the plan's slots by number, so
neither the pieces nor a hot length ever meet in one task or the driver.

Defined results: a null text is an empty text; every row is packed, repeated
rows and rows without an id included; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import map_arrow, materialize, values, worker_state

CAPACITY = 4096
END_ID = 1

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"


#: ASCII marks that the tokenizer splits off a run of letters as one token run; the apostrophe is not among them.
_MARKS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
#: Bytes of text that a task tokenizes at once.
_SLICE = 8_000_000


class Tokens:
    """Token ids of many texts at once.

    The tokenizer never merges across white space, nor across the border of a
    run of letters and a run of marks.  So texts are cut at blanks, and each
    distinct chunk is coded once: a run of letters, with marks behind it or
    not, by its parts, anything else as it is.  Letter runs need none of the
    tokenizer's normalizing and splitting and go to its merges many at once.
    The table of coded runs is of bounded size and kept by the worker."""

    RUNS = 300_000

    def __init__(self, path: str | None):
        import os

        import public_tokenizers
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = path or public_tokenizers.path("word_bpe_49k.json")
        state = worker_state()
        if ("word runs", path) not in state:
            whole, merges = Tokenizer.from_file(path), Tokenizer.from_file(path)
            merges.normalizer = normalizers.Sequence([])
            merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            # Whether each id is the last one of a run: those carry the suffix of a word's end, if the vocabulary has one.
            vocabulary, suffix = merges.get_vocab(), merges.model.end_of_word_suffix
            last = np.zeros(max(vocabulary.values()) + 1, bool)
            last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
            state["word runs", path] = whole, merges, last, {}, {}
        self.tokenizer, self.merges, self.last, self.runs, self.older = state["word runs", path]
        # Byte-level vocabularies write each byte as a visible character.
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.visible = {b: b for b in visible} | {b: 256 + i for i, b in enumerate(hidden)} | {10: 32}

    def encode(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, runs: list[str]) -> list[bytes]:
        """Ids of distinct lower-case letter runs; a full table is set aside, and what is used of it again moves to the new one."""
        if len(self.runs) > self.RUNS:
            self.older.clear()
            self.older.update(self.runs)
            self.runs.clear()
        known, out = self.runs, list(map(self.runs.get, runs))
        lacking = [i for i, code in enumerate(out) if code is None]
        for i, code in zip(lacking, map(self.older.get, [runs[i] for i in lacking])):
            if code is not None:
                known[runs[i]] = out[i] = code
        lacking = [i for i in lacking if out[i] is None]
        new = [runs[i] for i in lacking]
        for i in range(0, len(new), 4000):
            part = new[i:i + 4000]
            shown = "\n".join(part).encode().decode("latin-1").translate(self.visible)
            if self.last.any():
                ids = np.array(self.merges.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
                ends = self.last[ids]
            else:
                coded = self.merges.encode(shown, add_special_tokens=False)
                ids, ends = np.array(coded.ids, "<u4"), np.diff(np.array(coded.word_ids, np.int64), append=-1) != 0
            raw, cuts = ids.tobytes(), [0, *(4 * (np.flatnonzero(ends) + 1)).tolist()]
            known.update(zip(part, [raw[a:b] for a, b in zip(cuts, cuts[1:])], strict=True))
        for i, run in zip(lacking, new):
            out[i] = known[run]
        return out

    def code(self, chunks: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of each of the distinct ``chunks``, as little-endian uint32 bytes."""
        run = pc.utf8_rtrim(chunks, characters=_MARKS)
        simple = pc.and_(pc.utf8_is_alpha(run), pc.invert(pc.match_substring_regex(run, "\u03a3|\u0130")))
        low = pc.utf8_lower(run).filter(simple).dictionary_encode()
        plain, names = values(pc.string_is_ascii(low.dictionary)), values(low.dictionary)
        composed = np.array([p or is_normalized("NFC", x) for p, x in zip(plain, names)], bool)
        simple = simple.to_numpy(zero_copy_only=False).copy()
        at = low.indices.to_numpy()
        simple[simple] = composed[at]
        at = at[composed[at]]
        # A chunk is one of the first table, then one of the second, whose first entry is empty.
        front = [*self.learn([x for x, ok in zip(names, composed.tolist()) if ok]), *map(self.encode, values(chunks.filter(pa.array(~simple))))]
        first, second = np.empty(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        first[simple] = (np.cumsum(composed) - 1)[at]
        first[~simple] = np.arange(composed.sum(), len(front))
        size = pc.utf8_length(run).to_numpy()
        tailed = simple & (pc.utf8_length(chunks).to_numpy() > size)
        tails = pa.array([x[n:] for x, n in zip(values(chunks.filter(pa.array(tailed))), size[tailed].tolist())], pa.string()).dictionary_encode()
        second[tailed] = 1 + tails.indices.to_numpy()
        back = [b"", *map(self.encode, values(tails.dictionary))]
        parts = [pa.array(table, pa.large_binary()).take(pa.array(x)) for table, x in ((front, first), (back, second))]
        return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.large_binary()))

    def ids(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, each text followed by the end id, and where each text begins (and the last ends)."""
        flat = texts.fill_null("")
        for blank in "\n\t\r":
            flat = pc.replace_substring(flat, blank, " ")
        parts = pc.split_pattern(flat, " ")
        coded = parts.flatten().dictionary_encode()
        table = pa.concat_arrays([self.code(coded.dictionary), pa.array([np.array([END_ID], "<u4").tobytes()], pa.large_binary())])
        stops = np.cumsum(pc.list_value_length(parts).to_numpy())
        chunk = np.insert(coded.indices.to_numpy().astype(np.int64), stops, len(table) - 1)
        past = np.concatenate([np.zeros(1, np.int64), np.cumsum(pc.binary_length(table).to_numpy()[chunk] // 4)])
        known = table.take(pa.array(chunk)).buffers()[2]
        at = past[np.concatenate([np.zeros(1, np.int64), stops + np.arange(1, len(stops) + 1)])]
        return np.frombuffer(known, "<u4", at[-1]) if at[-1] else np.zeros(0, "<u4"), at


def tokenize_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                    tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece with its length, checksum and number among its task's pieces of that length."""
    def slices(batches):
        """The rows in runs of about ``_SLICE`` bytes of text: batches are cut, and small ones joined."""
        held, size = [], 0
        for whole in batches:
            # 64 more a row, so that many short texts make a slice too.
            sizes = np.cumsum(pc.binary_length(whole.column("text")).fill_null(0).to_numpy(zero_copy_only=False) + 64, dtype=np.int64)
            low = 0
            while low < whole.num_rows:
                done = int(sizes[low - 1]) if low else 0
                high = max(low + 1, int(np.searchsorted(sizes, done + _SLICE - size)))
                held.append(whole.slice(low, high - low))
                size += int(sizes[min(high, whole.num_rows) - 1]) - done
                low = high
                if size >= _SLICE or low < whole.num_rows:
                    yield pa.concat_batches(held)
                    held, size = [], 0
        if held:
            yield pa.concat_batches(held)

    def task(batches):
        tokens, ranks, number = Tokens(tokenizer_path), {}, TaskContext.get().partitionId()
        for batch in slices(batches):
            ids, at = tokens.ids(batch.column("text"))
            rows = [[] for _ in range(6)]
            for key, a, b in zip(batch.column("doc_id").to_pylist(), at.tolist(), at[1:].tolist()):
                for piece, start in enumerate(range(0, b - a, capacity)):
                    length = min(capacity, b - a - start)
                    ranks[length] = rank = ranks.get(length, -1) + 1
                    for column, v in zip(rows, (key, piece, start, length, zlib.crc32(ids[a + start:a + start + length].tobytes()), rank)):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:5]),
                 pa.array([number] * len(rows[0]), pa.int32()), pa.array(rows[5], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(slim, task, _PIECES)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots for ``counts[length]`` pieces: (length, first number, past number, first sequence, offset, per sequence).

    Piece number r of a length lies in sequence ``first + (r - lo) // per`` at
    ``offset + ((r - lo) % per) * length``."""
    left = counts.astype(np.int64).copy()
    used = np.zeros_like(left)
    slots, sequence = [], 0

    def single(gap):
        return [gap] if left[gap] > 0 else None

    def pair(gap, floor=1):
        """Two lengths summing to ``gap``, the larger as large as possible."""
        a = np.arange((gap + 1) // 2, gap)
        if not len(a):
            return None
        b = gap - a
        ok = (left[a] > 0) & (left[b] > 0) & ((a != b) | (left[a] > 1))
        hit = np.flatnonzero(ok)
        return [int(a[hit[-1]]), int(b[hit[-1]])] if len(hit) else None

    def triple(gap):
        for c in np.flatnonzero(left[:gap - 1])[::-1]:
            c = int(c)
            if 3 * c < gap:
                return None
            left[c] -= 1
            two = pair(gap - c)
            left[c] += 1
            if two:
                return [c, *two]
        return None

    while True:
        have = np.flatnonzero(left)
        if not len(have):
            return slots
        longest = int(have[-1])
        chosen = [longest]
        left[longest] -= 1
        gap = capacity - longest
        while gap > 0:
            found = single(gap) or pair(gap) or (triple(gap) if gap >= 3 else None)
            if not found:
                fits = np.flatnonzero(left[:gap + 1])
                if not len(fits):
                    break
                found = [int(fits[-1])]
            for x in found:
                left[x] -= 1
            chosen += found
            gap -= sum(found)
        for x in chosen:
            left[x] += 1
        need: dict[int, int] = {}
        for x in chosen:
            need[x] = need.get(x, 0) + 1
        times = min(int(left[x]) // n for x, n in need.items())
        offset = 0
        for x, n in need.items():
            slots.append((x, int(used[x]), int(used[x]) + n * times, sequence, offset, n))
            used[x] += n * times
            left[x] -= n * times
            offset += n * x
        sequence += times


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         tokenizer_path: str | None = None) -> DataFrame:
    """Place every piece of every document; see the module text.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialize(tokenize_pieces(docs, doc_id, text, capacity, tokenizer_path), "pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    # At most ``capacity`` rows.
    for length, n in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[length] = n
    before = per_task.select("task", "length", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    slots = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 6)
    at = {int(x): slots[slots[:, 0] == x] for x in np.unique(slots[:, 0])}

    def task(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                rows = np.flatnonzero(length == x)
                mine = at[int(x)]
                slot = mine[np.searchsorted(mine[:, 1], number[rows], side="right") - 1]
                inside = number[rows] - slot[:, 1]
                sequence[rows] = slot[:, 3] + inside // slot[:, 5]
                offset[rows] = slot[:, 4] + inside % slot[:, 5] * x
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return map_arrow(pieces.join(before, ["task", "length"]), task,
                     "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
