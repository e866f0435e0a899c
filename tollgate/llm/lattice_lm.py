"""Language-model scoring by a subword lattice.

The pieces of an existing subword vocabulary get unigram scores from the
training documents.  A word is spelled by pieces, the first of which starts a
word; a forward recursion in log space sums over all segmentations.  The
lattice has one more edge per word seen in training, spanning the whole word
with its own relative frequency; the mass of words seen once (Good-Turing) is
what the two kinds of edges share.  No piece crosses a word, so a text's
marginal is the sum of its words' marginals and its end.

Work at scale: words are counted per task and summed in a shuffle; scores are
made once per distinct word.  Documents look up frequent words in a table of
at most ``HEAD_WORDS`` words, and the rest in a join on the word.

Defined results: a null text is an empty text (its end only); repeated rows are
counted and scored each; a null id counts as the empty id; without training
rows pieces are equally likely and the lattice alone scores.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import map_arrow, materialize, text_bytes, values, worker_state

#: Words that the lookup table of frequent words holds at most.
HEAD_WORDS = 300_000
#: Distinct words that a task counts before it passes them on.
TASK_WORDS = 200_000
#: Words, and bytes of them, whose lattices a task looks at together.
GROUP_WORDS, GROUP_BYTES = 60_000, 4_000_000
#: Rounds of expectation that fit the pieces' counts.
ROUNDS = 1
#: Added to each piece's count.
PIECE_PRIOR = 0.5
_START = "▁"


def _worker_processor(path: str | None):
    state = worker_state()
    if ("pieces", path) not in state:
        state["pieces", path] = _processor(path)
    return state["pieces", path]


class _Places(dict):
    """word -> row of the table of frequent words; ``other`` for all other words."""

    def __missing__(self, word: bytes) -> int:
        return self.other


def tokens(raw: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words; the six ASCII blanks separate."""
    return raw.lower().split()


def _processor(path: str | None):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
#: Probabilities of words below this are summed as logarithms.
_TINY = 1e-250


def _hashes(strings) -> np.ndarray:
    out = []
    for string in strings:
        h = 0
        for c in string:
            h = (h * int(_STEP) + ord(c) + 1) % 2 ** 64
        out.append(h)
    return np.array(out, np.uint64)


class _Pieces:
    """Scores of character strings, looked up for many strings at once by a rolling hash."""

    def __init__(self, scores: dict[str, float], numbers: dict[str, int]):
        keys = _hashes(scores)
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], np.array(list(scores.values()), float)[order]
        self.odds = np.exp(self.scores)
        self.numbers = np.array([numbers[piece] for piece in scores], np.int64)[order]
        self.own = frozenset(self.numbers.tolist())
        # By slot of the hash: 1 where a piece may go on, 2 where one may end.
        self.seen = np.zeros(1 << 20, np.uint8)
        self.seen[self._slot(_hashes({piece[:i] for piece in scores for i in range(1, len(piece))}))] = 1
        self.seen[self._slot(self.keys)] |= 2

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h * _SPREAD) >> np.uint64(44)).astype(np.int64)

    def walk(self, codes: np.ndarray, i: int, span: int):
        """(end, rows, places of the pieces) of all pieces that the words hold from ``i`` on.

        A word is followed only as long as some piece may begin with what was read."""
        rows, h = np.arange(codes.shape[1]), np.zeros(codes.shape[1], np.uint64)
        for j in range(i, min(len(codes), i + span)):
            h = h * _STEP + codes[j, rows]
            state = self.seen[self._slot(h)]
            ends = np.flatnonzero(state & 2)
            if len(ends):
                found = h[ends]
                at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
                real = self.keys[at] == found
                if real.any():
                    yield j + 1, rows[ends[real]], at[real]
            more = np.flatnonzero(state & 1)
            if not len(more):
                return
            rows, h = rows[more], h[more]


class Lattice:
    """Unigram scores (natural logs) over the vocabulary; marginals of words."""

    def __init__(self, counts: np.ndarray, tokenizer_path: str | None = None):
        sp = _processor(tokenizer_path)
        total = PIECE_PRIOR * sp.get_piece_size() + counts.sum()
        first, inner, numbers = {}, {}, ({}, {})
        self.size = sp.get_piece_size()
        self.bytes = np.full(256, math.log(PIECE_PRIOR / total))
        for i in range(sp.get_piece_size()):
            if sp.is_unknown(i) or sp.is_control(i):
                continue
            p, piece = math.log((counts[i] + PIECE_PRIOR) / total), sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = p
            elif piece.startswith(_START):
                if _START not in piece[1:]:
                    first[piece[1:]] = p
                    numbers[0][piece[1:]] = i
            elif _START not in piece:
                inner[piece] = p
                numbers[1][piece] = i
        self.span = max(map(len, [*first, *inner]))
        self.letter = np.zeros(0x110000, bool)
        self.letter[[ord(x) for x in inner if len(x) == 1]] = True
        # A word that no other piece starts begins with the bare start mark.
        self.bare, self.bare_number = first.pop("", math.log(PIECE_PRIOR / total)), numbers[0].get("", 0)
        self.first, self.inner = _Pieces(first, numbers[0]), _Pieces(inner, numbers[1])

    def fallback(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the characters that no piece spells, and their scores as bytes."""
        rows = np.flatnonzero(~self.letter[codes])
        kinds, at = np.unique(codes[rows], return_inverse=True)
        return rows, np.array([float(self.bytes[list(chr(c).encode("utf-8", "replace"))].sum()) for c in kinds.tolist()])[at]

    def edges(self, codes: np.ndarray, log: bool):
        """Edges of the lattices of words of one length (rows of character codes), by where they begin:
        (begin, end, rows, scores or probabilities, piece numbers or None for a character's bytes)."""
        columns = np.ascontiguousarray(codes.T)
        stepped = columns.astype(np.uint64) + np.uint64(1)
        for i in range(len(columns)):
            rows, p = self.fallback(columns[i])
            if len(rows):
                yield i, i + 1, rows, p if log else np.exp(p), None
            if i == 0:
                # In place of the bare start mark, which every lattice's first score holds.
                for j, rows, at in self.first.walk(stepped, 0, self.span):
                    p = self.first.scores[at] - self.bare
                    yield 0, j, rows, p if log else np.exp(p), self.first.numbers[at]
            for j, rows, at in self.inner.walk(stepped, i, self.span):
                yield i, j, rows, (self.inner.scores if log else self.inner.odds)[at], self.inner.numbers[at]

    def same_length(self, codes: np.ndarray) -> np.ndarray:
        """Forward recursion over all segmentations.

        On probabilities; words whose sum comes near the smallest doubles once more on logarithms."""
        m, n = codes.shape
        alpha = np.zeros((n + 1, m))
        alpha[0] = math.exp(self.bare)
        for i, j, rows, p, _ in self.edges(codes, False):
            alpha[j, rows] += alpha[i, rows] * p
        out, tiny = np.empty(m), alpha[n] < _TINY
        out[~tiny] = np.log(alpha[n, ~tiny])
        if tiny.any():
            out[tiny] = self._in_logs(codes[tiny])
        return out

    def _in_logs(self, codes: np.ndarray) -> np.ndarray:
        m, n = codes.shape
        alpha = np.full((n + 1, m), -math.inf)
        alpha[0] = self.bare
        for i, j, rows, p, _ in self.edges(codes, True):
            alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + p)
        return alpha[n]

    def expected(self, codes: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words' segmentations (forward and backward recursion)."""
        m, n = codes.shape
        alpha, beta = np.zeros((n + 1, m)), np.zeros((n + 1, m))
        alpha[0], beta[n] = math.exp(self.bare), 1
        edges = list(self.edges(codes, False))
        for i, j, rows, p, _ in edges:
            alpha[j, rows] += alpha[i, rows] * p
        tiny = alpha[n] < _TINY
        if tiny.any():
            rest = self.expected(codes[~tiny]) if not tiny.all() else 0
            return rest + self._expected_in_logs(codes[tiny])
        out, total = np.zeros(self.size), alpha[n]
        started = np.zeros(m)
        for i, j, rows, p, number in reversed(edges):
            part = p * beta[j, rows]
            beta[i, rows] += part
            if number is not None:
                self._share(out, started, alpha[i, rows] * part / total[rows], i, rows, number)
        out[self.bare_number] += (1 - started).sum()
        return out

    def _expected_in_logs(self, codes: np.ndarray) -> np.ndarray:
        m, n = codes.shape
        alpha, beta = np.full((n + 1, m), -math.inf), np.full((n + 1, m), -math.inf)
        alpha[0], beta[n] = self.bare, 0
        edges = list(self.edges(codes, True))
        for i, j, rows, p, _ in edges:
            alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + p)
        out, total = np.zeros(self.size), alpha[n]
        started = np.zeros(m)
        for i, j, rows, p, number in reversed(edges):
            part = p + beta[j, rows]
            beta[i, rows] = np.logaddexp(beta[i, rows], part)
            if number is not None:
                self._share(out, started, np.exp(alpha[i, rows] + part - total[rows]), i, rows, number)
        out[self.bare_number] += (1 - started).sum()
        return out

    def _share(self, out: np.ndarray, started: np.ndarray, share: np.ndarray, i: int, rows: np.ndarray, number: np.ndarray) -> None:
        """Adds the shares of edges from ``i`` on to the pieces, and to the words' starts."""
        np.add.at(out, number, share)
        if i == 0 and number[0] in self.first.own:
            started[rows] += share

    def blocks(self, words: list[str]):
        """(rows, character codes) of words of one length, in blocks of bounded size however long the words."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == n)
            step = max(1, 400_000 // max(n, 1))
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                codes = "".join([words[r] for r in part]).encode("utf-32-le", "surrogatepass")
                yield part, np.frombuffer(codes, np.uint32).reshape(len(part), n)

    def marginals(self, words: list[str]) -> np.ndarray:
        """Natural logs of the probabilities that pieces spell each word, over all segmentations."""
        out = np.zeros(len(words))
        for rows, codes in self.blocks(words):
            out[rows] = self.same_length(codes)
        return out


def _grouped(batches):
    """The batches' rows in fewer, larger batches of bounded size: each recursion then runs over many words."""
    held, n, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        n, size = n + batch.num_rows, size + batch.nbytes
        if n >= GROUP_WORDS or size >= GROUP_BYTES:
            yield pa.concat_batches(held)
            held, n, size = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, trained, seen) from rows (text, held_out): counts per task, then summed.

    The end of a text is the null word."""
    def task(batches):
        counts: dict[bool, Counter] = {False: Counter(), True: Counter()}
        ends = {False: 0, True: 0}

        def flush():
            for held, words in counts.items():
                if words:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(words), pa.binary()), pa.array([0 if held else c for c in words.values()], pa.int64()),
                         pa.array(list(words.values()), pa.int64())], names=["word", "trained", "seen"])
                    words.clear()

        for batch in batches:
            held = batch.column("held_out").to_pylist()
            for raw, h in zip(text_bytes(batch.column("text")), held):
                counts[h].update(tokens(raw))
                ends[h] += 1
                if len(counts[h]) > TASK_WORDS:
                    yield from flush()
        yield from flush()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([ends[False]], pa.int64()),
                                          pa.array([ends[False] + ends[True]], pa.int64())], names=["word", "trained", "seen"])

    rows = map_arrow(docs.select("text", "held_out"), task, "word binary, trained long, seen long")
    return rows.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("seen").alias("seen"))


def piece_counts(words: DataFrame, tokenizer_path: str | None = None, rounds: int = ROUNDS) -> np.ndarray:
    """How often each piece of the vocabulary spells the distinct training words.

    First by the vocabulary's own segmentation, then by ``rounds`` of expectation
    over all segmentations.  Each word counts once, as what the pieces must spell
    are words not seen yet; as many rows as the vocabulary has pieces reach the
    driver."""
    known = words.where(F.col("word").isNotNull() & (F.col("trained") > 0)).select("word")

    def gathered(count) -> np.ndarray:
        def task(batches):
            total = 0
            for batch in _grouped(batches):
                total = total + count([w.decode("utf-8", "replace") for w in values(batch.column("word"))])
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(np.asarray(total, float).reshape(-1)[hit])], names=["piece", "n"])

        out = np.zeros(size)
        for piece, n in map_arrow(known, task, "piece int, n double").groupBy("piece").agg(F.sum("n")).collect():
            out[piece] = n
        return out

    size = _processor(tokenizer_path).get_piece_size()

    def own(ws):
        spelled = _worker_processor(tokenizer_path).encode(ws, num_threads=1)
        return np.bincount(np.fromiter((i for s in spelled for i in s), np.int64), minlength=size)

    counts = gathered(own)
    for _ in range(rounds):
        scores = counts

        def expect(ws):
            lattice = worker_state().get("lattice")
            if lattice is None or not np.array_equal(lattice[0], scores):
                lattice = worker_state()["lattice"] = scores, Lattice(scores, tokenizer_path)
            return sum((lattice[1].expected(codes) for _, codes in lattice[1].blocks(ws)), np.zeros(size))

        counts = gathered(expect)
    return counts


def word_scores(words: DataFrame, totals: dict, counts: np.ndarray, tokenizer_path: str | None = None) -> DataFrame:
    """(word, seen, known, base, score): log10 scores of every distinct word of the corpus."""
    n, v, singles = totals["n"], totals["v"], totals["singles"]
    fresh = max(singles, 1) / (n + 1)

    def task(batches):
        lattice = Lattice(counts, tokenizer_path)
        for batch in _grouped(batches):
            trained = batch.column("trained").to_numpy().astype(float)
            base = np.log10((trained + 1) / (n + v + 1))
            spelled = lattice.marginals([w.decode("utf-8", "replace") for w in values(batch.column("word"))])
            if n:
                whole = np.log(np.maximum(trained, 1e-300) / n) + math.log1p(-min(fresh, 0.999))
                spelled = np.where(trained > 0, np.logaddexp(whole, spelled + math.log(fresh)), spelled + math.log(fresh))
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("seen"), pa.array(trained > 0), pa.array(base), pa.array(spelled / math.log(10))],
                names=["word", "seen", "known", "base", "score"])

    return map_arrow(words.where(F.col("word").isNotNull()).select("word", "trained", "seen"), task,
                     "word binary, seen long, known boolean, base double, score double")


def head_threshold(words: DataFrame, limit: int = HEAD_WORDS) -> int:
    """Smallest power of two that at most ``limit`` words reach in count."""
    sizes = {int(k): n for k, n in words.where(F.col("word").isNotNull())
             .groupBy(F.floor(F.log2("seen")).alias("k")).agg(F.count("*")).collect()}
    total, level = 0, max(sizes, default=0)
    while level >= 0 and total + sizes.get(level, 0) <= limit:
        total += sizes.get(level, 0)
        level -= 1
    return 2 ** (level + 1)


def score_documents(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
                    tokenizer_path: str | None = None) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    words = materialize(count_words(slim), "lm-words")
    total = words.agg(F.coalesce(F.sum("trained"), F.lit(0)).alias("n"), F.count_if(F.col("trained") > 0).alias("v"),
                      F.count_if(F.col("trained") == 1).alias("singles"),
                      F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("trained"))), F.lit(0)).alias("ends")).first().asDict()
    scored = materialize(word_scores(words, total, piece_counts(words, tokenizer_path), tokenizer_path), "lm-scores")
    head = scored.where(F.col("seen") >= head_threshold(words)).select("word", "known", "base", "score").toArrow()
    table = docs.sparkSession.sparkContext.broadcast(
        (values(head["word"].combine_chunks()), head["known"].to_numpy(), head["base"].to_numpy(), head["score"].to_numpy()))
    n, ends = total["n"], total["ends"]
    end_base = math.log10((ends + 1) / (n + total["v"] + 1))
    fresh = max(total["singles"], 1) / (n + 1)
    end_score = math.log10(ends / n * (1 - min(fresh, 0.999))) if n else math.log10(0.5)

    def task(batches):
        names, known, base, score = table.value
        last = len(names)
        place = _Places(zip(names, range(last)))
        place.other = last
        known, base, score = (np.append(x, 0) for x in (known, base, score))
        for batch in batches:
            out = [[] for _ in range(4)]
            rest = []
            for raw in text_bytes(batch.column("text")):
                ws = tokens(raw)
                at = np.fromiter(map(place.__getitem__, ws), np.int64, len(ws))
                for column, x in zip(out, (len(ws) + 1, int(known[at].sum()) + (ends > 0), float(base[at].sum()) + end_base,
                                           float(score[at].sum()) + end_score)):
                    column.append(x)
                rest.append([{"word": w, "n": c} for w, c in Counter(ws[i] for i in np.flatnonzero(at == last)).items()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.float64()), pa.array(out[3], pa.float64()),
                 pa.array(rest, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rest"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    parts = materialize(map_arrow(slim, task, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, "
                                              "score double, rest array<struct<word:binary,n:long>>")
                        .withColumn("row", F.monotonically_increasing_id()), "lm-documents")
    rare = (parts.select("row", F.inline("rest")).join(scored.select("word", "known", "base", "score"), "word")
            .groupBy("row").agg(F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("k"),
                                F.sum(F.col("n") * F.col("base")).alias("b"), F.sum(F.col("n") * F.col("score")).alias("s")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return parts.drop("rest").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("k")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base_score") + zero("b")).alias("base_score"),
        (F.col("score") + zero("s")).alias("score"))
