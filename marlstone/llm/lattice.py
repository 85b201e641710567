"""Language-model scores from a subword lattice.

The pieces of an existing unigram vocabulary span a lattice over every word; the probability of a word is the sum over
all of its segmentations of the product of the pieces' probabilities, computed by a forward recursion in logarithms.
A text is its words in turn, then an end; no piece reaches over white space, so the probability of the text is the
product of its words' and the end's. Bytes are pieces too, so every word has a segmentation.

The vocabulary's own scores weigh the pieces: they are ranks, so a piece's weight is one over its rank. That model is
`vocabulary_score`. For `score` the same weights are the prior, which ROUNDS passes of expectation-maximisation over
all training words turn into how often the lattice expects each piece. Nothing about a held-out text is learned.

Each task keeps the distinct words of a run of documents once, and the documents as numbers of those words; words are
counted and scored once over all documents and their scores return to the runs. Whole vocabularies of words never
leave the executors; only the expected counts of the pieces, as many as the vocabulary has, reach the driver.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm._common import lower_words, stored

FOLDS, HELD_OUT = 7, 2
#: Passes over the training words, and what each piece gets on top of its expected count.
ROUNDS = 5
PRIOR_COUNT = 0.1
#: Bytes of text, each document counting as 256 at least, after which a task starts a new run.
RUN_BYTES = 16 << 20
#: Bytes of words that are scored at a time.
CHUNK = 1 << 19
#: Bytes from which on a word is walked by itself, a stretch of starts at a time.
LONG, STRETCH = 4096, 1 << 15
#: Words that are sorted by length together, about.
GATHER = 100_000
#: Runs of a task, runs whose words are a task's, and the most partitions of a shuffle.
RUNS, WORD_RUNS, MOST_PARTS = 4, 2, 1 << 16
_OUT = float("-inf")


class Pieces:
    """A vocabulary as a trie in arrays; a word is spelt with a leading space, which stands for the word's start."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found: dict[bytes, float] = {}
        for k in range(model.get_piece_size()):
            if not (model.is_unknown(k) or model.is_control(k) or model.is_unused(k)):
                raw = bytes([int(model.id_to_piece(k)[3:-1], 16)]) if model.is_byte(k) else model.id_to_piece(k).replace("▁", " ").encode()
                if b" " not in raw[1:] and not any(65 <= b <= 90 for b in raw):  # the texts have neither
                    found[raw] = max(found.get(raw, _OUT), model.get_score(k))
        for b in range(256):
            found.setdefault(bytes([b]), _OUT)
        self.pieces = sorted(found)
        rank = {p: k for k, p in enumerate(sorted(self.pieces, key=lambda p: (-found[p], p)))}
        #: the vocabulary's log-probabilities, of the pieces and of the end, which comes before the first rank
        start = np.array([1 / (rank[p] + 3) for p in self.pieces])
        self.start, self.end = np.log(start / (start.sum() + 1 / 2)), math.log(1 / 2 / (start.sum() + 1 / 2))
        self.longest = max(map(len, self.pieces))
        edges: list[dict[int, int]] = [{}, {}]  # node 0 is where nothing matches, 1 the root
        self.piece_of = [-1, -1]
        for k, p in enumerate(self.pieces):
            at = 1
            for b in p:
                if b not in edges[at]:
                    edges[at][b] = len(edges)
                    edges.append({})
                    self.piece_of.append(-1)
                at = edges[at][b]
            self.piece_of[at] = k
        self.piece_of = np.array(self.piece_of)
        # where a node's byte leads, at 256 times the node and the byte; itself 256 times a node
        self.next = np.zeros(len(edges) << 8, np.int64)
        for k, e in enumerate(edges):
            for b, to in e.items():
                self.next[(k << 8) + b] = to << 8

    def lattice(self, batch: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """Of words of one length, a row of bytes each: by start, (end, rows, piece) of every piece that matches there."""
        at_place = np.ascontiguousarray(batch.T)
        every, out = np.arange(len(batch)), []
        for i in range(len(at_place)):
            rows, node, arcs = every, np.int64(1 << 8), []
            for j in range(i, len(at_place)):
                node = self.next[node + (at_place[j] if rows is every else at_place[j][rows])]
                on = np.flatnonzero(node)
                if len(on) < len(rows):
                    rows, node = rows[on], node[on]
                    if not len(rows):
                        break
                piece = self.piece_of[node >> 8]
                hit = np.flatnonzero(piece >= 0)
                if len(hit):
                    arcs.append((j + 1, rows[hit], piece[hit]) if len(hit) < len(rows) else (j + 1, rows, piece))
            out.append(arcs)
        return out

    @staticmethod
    def forward(arcs: list, n: int, weights: np.ndarray) -> np.ndarray:
        """alpha[place, word]: log-probability of all ways to spell the word up to the place."""
        alpha = np.full((len(arcs) + 1, n), _OUT)
        alpha[0] = 0.0
        for i, starts in enumerate(arcs):
            for j, rows, piece in starts:
                alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + weights[piece])
        return alpha

    def log_probabilities(self, ws: list[bytes], *weights: np.ndarray) -> np.ndarray:
        """Of each word, under each of the weights; the lattice is made once. One weight gives one dimension."""
        out = np.empty((len(weights), len(ws)))
        for at, batch in batches_of(ws):
            arcs = self.lattice(batch)
            for k, w in enumerate(weights):
                out[k, at] = self.forward(arcs, len(batch), w)[-1]
        for at, raw in long_words(ws):
            for k, w in enumerate(weights):
                out[k, at] = self.marks(raw, w.tolist())[-1][0]
        return out if len(weights) > 1 else out[0]

    def expected(self, ws: list[bytes], counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """How often each piece is expected in these words, each taken as often as counted."""
        total = np.zeros(len(self.pieces))
        with np.errstate(invalid="ignore"):
            for at, batch in batches_of(ws):
                arcs = self.lattice(batch)
                alpha = self.forward(arcs, len(batch), weights)
                beta = np.full_like(alpha, _OUT)
                beta[-1] = 0.0
                whole, c, seen, times = alpha[-1], counts[at], [], []
                for i in range(len(arcs) - 1, -1, -1):
                    for j, rows, piece in arcs[i]:
                        rest = weights[piece] + beta[j, rows]
                        beta[i, rows] = np.logaddexp(beta[i, rows], rest)
                        seen.append(piece)
                        times.append(np.exp(alpha[i, rows] + rest - whole[rows]) * c[rows])
                total += np.bincount(np.concatenate(seen), np.concatenate(times), len(total))
        for at, raw in long_words(ws):
            total += counts[at] * self.expected_of_long(raw, weights.tolist())
        return total

    def matches(self, raw: np.ndarray, at: int) -> list[list[tuple[int, int]]]:
        """Of a stretch of one word's starts, from `at` on: (length, piece) of every piece that matches there."""
        rows = np.arange(at, min(at + STRETCH, len(raw)))
        node, out = np.full(len(rows), 1 << 8), [[] for _ in rows]
        for j in range(self.longest):
            inside = rows < len(raw) - j
            rows = rows[inside]
            node = self.next[node[inside] + raw[rows + j]]
            on = np.flatnonzero(node)
            rows, node = rows[on], node[on]
            if not len(rows):
                break
            piece = self.piece_of[node >> 8]
            hit = np.flatnonzero(piece >= 0)
            for i, p in zip((rows[hit] - at).tolist(), piece[hit].tolist(), strict=True):
                out[i].append((j + 1, p))
        return out

    def onward(self, arcs: list[list[tuple[int, int]]], mark: list[float], weights: list[float]) -> list[float]:
        """alpha at a stretch's places and as far behind it as a piece reaches, from what the stretch before has of these."""
        alpha = mark + [_OUT] * len(arcs)
        for i, found in enumerate(arcs):
            a = alpha[i]
            for n, p in found:
                alpha[i + n] = _either(alpha[i + n], a + weights[p])
        return alpha

    def marks(self, raw: np.ndarray, weights: list[float]) -> list[list[float]]:
        """alpha where each stretch of a word begins and as far behind as a piece reaches; last, where the word ends."""
        out = [[0.0] + [_OUT] * self.longest]
        for at in range(0, len(raw), STRETCH):
            out.append(self.onward(self.matches(raw, at), out[-1], weights)[-self.longest - 1 :])
        return out

    def expected_of_long(self, raw: np.ndarray, weights: list[float]) -> np.ndarray:
        """How often each piece is expected in one word: what a stretch needs is made anew on the way back."""
        *marks, last = self.marks(raw, weights)
        total, beta = [0.0] * len(self.pieces), [0.0] + [_OUT] * self.longest
        for k in range(len(marks) - 1, -1, -1):
            arcs = self.matches(raw, k * STRETCH)
            alpha = self.onward(arcs, marks[k], weights)
            beta = [_OUT] * len(arcs) + beta[: self.longest + 1]
            for i in range(len(arcs) - 1, -1, -1):
                so_far = alpha[i] - last[0]
                for n, p in arcs[i]:
                    rest = weights[p] + beta[i + n]
                    beta[i] = _either(beta[i], rest)
                    total[p] += math.exp(so_far + rest)
        return np.array(total)


def _either(x: float, y: float) -> float:
    """The logarithm of the sum of two probabilities, from theirs; y is none of zero."""
    return y + math.log1p(math.exp(x - y)) if x < y else x + math.log1p(math.exp(y - x))


def long_words(ws: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(place, bytes with a leading space) of words longer than LONG."""
    return ((k, np.frombuffer(b" " + w, np.uint8)) for k, w in enumerate(ws) if len(w) > LONG)


def batches_of(ws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, bytes) of words of one length, at most LONG, each with a leading space, CHUNK bytes or one word at a time."""
    by_length: dict[int, list[int]] = defaultdict(list)
    for k, w in enumerate(ws):
        if len(w) <= LONG:
            by_length[len(w)].append(k)
    for length, places in by_length.items():
        step = max(1, CHUNK // (length + 1) // 8)
        for at in range(0, len(places), step):
            part = places[at : at + step]
            raw = b" " + b" ".join(ws[k] for k in part)
            yield np.array(part), np.frombuffer(raw, np.uint8).reshape(len(part), length + 1)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches, put together up to GATHER words or eight times CHUNK bytes: few words of a length cost as many calls as many."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= GATHER or size >= 8 * CHUNK:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held)


@lru_cache(1)
def pieces(vocabulary: str) -> Pieces:
    """The vocabulary, on whichever machine asks: a file of the public tokenizers, or a path."""
    if "/" in vocabulary:
        return Pieces(vocabulary)
    import public_tokenizers

    return Pieces(public_tokenizers.path(vocabulary))


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def _planes(x: np.ndarray) -> bytes:
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def tabulate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents by runs, written once: rows of a run's distinct words (run, word, local, n) with the count n in
    training documents, and rows of its documents (run, doc_id, held_out, n_tokens, bag), words by local number."""
    schema = "run long, word binary, local int, n long, doc_id long, held_out boolean, n_tokens long, bag binary"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]

    def table(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        local: dict[bytes, int] = {}
        counts = np.zeros(1024, np.int64)
        held = 0

        def words_of_run() -> Iterator[pa.RecordBatch]:
            ws = list(local)
            for at in range(0, len(ws), 20_000):
                part = ws[at : at + 20_000]
                yield table(run=[number] * len(part), word=part, local=np.arange(at, at + len(part), dtype=np.int32), n=counts[at : at + len(part)])

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out: list[tuple] = []
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if held > RUN_BYTES:
                        if out:
                            yield table(**dict(zip(("run", "doc_id", "held_out", "n_tokens", "bag"), zip(*out, strict=True), strict=True)))
                        yield from words_of_run()
                        out, local, held, number = [], {}, 0, number + 1
                        counts = np.zeros(1024, np.int64)
                    ws = lower_words(t)
                    held += max(256, len(t or ""))
                    for w in dict.fromkeys(ws):
                        if w not in local:
                            local[w] = len(local)
                    ids, times = np.unique(np.fromiter(map(local.__getitem__, ws), np.int64, len(ws)), return_counts=True)
                    if len(local) > len(counts):
                        counts = np.concatenate([counts, np.zeros(max(len(counts), len(local) - len(counts)), np.int64)])
                    aside = held_out(i)
                    if not aside:
                        counts[ids] += times
                    out.append((number, i, aside, len(ws) + 1, _planes(np.diff(ids, prepend=0)) + _planes(times)))
                if out:
                    yield table(**dict(zip(("run", "doc_id", "held_out", "n_tokens", "bag"), zip(*out, strict=True), strict=True)))
        yield from words_of_run()

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stored(given.mapInArrow(run, schema), "runs")


def fit(counted: DataFrame, n_ends: int, vocabulary: str, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log-probabilities of the pieces, and of the end, from (word, n) of all training words."""
    p = pieces(vocabulary)
    weights, end, context = p.start, p.end, counted.sparkSession.sparkContext
    for _ in range(rounds):
        sent = context.broadcast(weights)  # one number for each piece

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            p, total = pieces(vocabulary), 0.0
            for part in gathered(batches):
                total = total + p.expected(part.column(0).to_pylist(), part.column(1).to_numpy().astype(float), sent.value)
            if not isinstance(total, float):
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "n"])

        # sums are rounded so that their order doesn't show
        found = counted.filter("n > 0").select("word", "n").mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum(F.round("n", 6).cast("decimal(28,6)")).cast("double").alias("n"))
        counts = np.full(len(p.pieces), PRIOR_COUNT)
        for r in found.toLocalIterator():
            counts[r["piece"]] += r["n"]
        weights = np.log(counts / (counts.sum() + n_ends + PRIOR_COUNT))
        end = math.log((n_ends + PRIOR_COUNT) / (counts.sum() + n_ends + PRIOR_COUNT))
    return weights, end


def score(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, vocabulary_score) for each row of docs.

    Null and empty texts are an end alone. Null ids count as the empty string for the folds, and train. Repeated rows
    count as often as they occur. With no training document at all, the pieces keep their prior.
    """
    runs = tabulate(docs, doc_id, text)
    in_runs = runs.filter("word is not null").select("run", "word", "local", "n")
    bags = runs.filter("bag is not null").select("run", "doc_id", "held_out", "n_tokens", "bag")
    ends, n_runs = bags.agg(F.count_if(~F.col("held_out")), F.count_distinct("run")).first()
    # partitions by the data: a task has a few runs, or the words of as many
    run_parts, word_parts = (min(MOST_PARTS, -(-n_runs // k) or 1) for k in (RUNS, WORD_RUNS))
    in_runs = in_runs.repartition(word_parts, "word")
    counted = stored(in_runs.groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    n_train, distinct = total[0] + ends, total[1] + (ends > 0)
    weights, end = fit(counted, ends, vocabulary, rounds)
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches):
            p = pieces(vocabulary)
            own, given = p.log_probabilities(part.column(0).to_pylist(), sent.value, p.start)
            yield from part.append_column("lp", pa.array(own)).append_column("given", pa.array(given)).to_batches()

    spelt = counted.mapInArrow(spell, "word binary, n long, lp double, given double").repartition(word_parts, "word")
    back = in_runs.select(F.col("run").alias("of_run"), "word", "local").join(spelt, "word").select("of_run", "local", "n", "lp", "given")
    given_end = pieces(vocabulary).end
    scale = math.log10(n_train + distinct + 1)

    def add(table: pa.Table, dictionary: pa.Table) -> pa.Table:
        local = dictionary.column("local").to_numpy()
        n, lp, given = np.zeros(len(local), np.int64), np.zeros(len(local)), np.zeros(len(local))
        n[local], lp[local], given[local] = (dictionary.column(c).to_numpy() for c in ("n", "lp", "given"))
        base = np.log10(n + 1.0) - scale
        rows = []
        for raw in table.column("bag").to_pylist():
            half = len(raw) // 2
            ids, times = np.cumsum(_numbers(raw[:half]).astype(np.int64)), _numbers(raw[half:]).astype(np.int64)
            rows.append((int(times[n[ids] > 0].sum()) + (ends > 0), float((base[ids] * times).sum()) + math.log10(ends + 1) - scale, (float((lp[ids] * times).sum()) + end) / math.log(10), (float((given[ids] * times).sum()) + given_end) / math.log(10)))
        known, base_score, own, by_vocabulary = zip(*rows, strict=True)
        return pa.table({c: table.column(c) for c in ("doc_id", "held_out", "n_tokens")} | {"n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([n_train] * len(rows), pa.int64()), "base_score": pa.array(base_score), "score": pa.array(own), "vocabulary_score": pa.array(by_vocabulary)})

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, vocabulary_score double"
    return bags.repartition(run_parts, "run").groupBy("run").cogroup(back.repartition(run_parts, "of_run").groupBy("of_run")).applyInArrow(add, schema)
