"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its distinct words, hashed, together of length WORDS_LENGTH; one bin of each structure
statistic of STATISTICS; one bin of each metadata column. Its score is the logistic of

    bias + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2),

the last term being all pairwise interactions through rank-RANK factors, in time linear in the vector. Documents are
scored where they are, whole, without a shuffle. The weights (BUCKETS and a few rows of RANK + 1 numbers, 2.4 MB) are of
one size whatever the corpus; they are fitted on a bounded sample of labelled rows (SAMPLE of each quality, CELLS).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm._common import fresh, stored, utf8
from marlstone.llm.quality import SYMBOLS, repeated_words

#: Rows of the words' part of the model, and factors of each row.
BUCKETS, RANK = 1 << 16, 8
#: The Euclidean length of a document's words' part; every statistic's bin counts 1.
WORDS_LENGTH = 2.0
#: Labelled documents of each quality that the fit uses at most, and entries of their vectors for each quality.
SAMPLE, CELLS = 6000, 4_000_000
#: Rows whose number (crc32 of the id as text) leaves 0 by FOLDS are never learned from.
FOLDS = 5
#: Documents of a step of the fit, passes over the sample and steps at the least, steps' length, pull to zero of weights and factors.
BATCH, PASSES, STEPS, RATE, RIDGE, RIDGE_FACTORS = 256, 12, 400, 0.02, 2e-5, 2e-4
#: The least score of good documents.
THRESHOLD = 0.3
#: Words whose buckets a task remembers.
MEMO = 1 << 19
SLICE = 256

#: Upper ends of the bins: of shares, and of numbers, which double.
_SHARES = np.array([0.0, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8, 0.95])
_DOUBLES = np.array([0.0, *(float(1 << k) for k in range(24))])
#: Statistic and the ends of its bins.
STATISTICS: tuple[tuple[str, np.ndarray], ...] = (
    ("words", _DOUBLES), ("letters_a_word", np.array([1.0, 2.0, 3.0, 3.5, 4.0, 4.5, 5.0, 5.5, 6.0, 7.0, 8.0, 10.0, 15.0])), ("words_a_line", _DOUBLES), ("symbols", _SHARES), ("capitals", _SHARES), ("digits", _SHARES),
    ("exclamations", _SHARES), ("repeated_lines", _SHARES), ("repeated_words", _SHARES), ("distinct_words", _SHARES), ("ended_lines", _SHARES), ("shouted_words", _SHARES), ("marked_words", _SHARES),
)
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTER = _UPPER + _UPPER.lower()


def statistics(raw: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """The values of STATISTICS; all zero for a text without words."""
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    without = lambda chars: size - len(raw.translate(None, chars))
    lines = [x for x in raw.split(b"\n") if not x.isspace() and x]
    letters = max(1, without(_LETTER))
    ended = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    shouted = sum(k for w, k in counts.items() if len(w) > 1 and w.isupper())
    marked = sum(k for w, k in counts.items() if w.translate(None, SYMBOLS) != w)
    return [
        float(n), sum(map(len, words)) / n, n / len(lines), without(SYMBOLS) / size, without(_UPPER) / letters, without(b"0123456789") / size,
        min(1.0, raw.count(b"!") / n), 1 - len(set(lines)) / len(lines), repeated_words(words) / n, len(counts) / n, ended / len(lines), shouted / n, marked / n,
    ]


def _starts(metadata: int) -> list[int]:
    """The first row of each statistic's and each metadata column's bins, and the number of all rows."""
    at = [BUCKETS]
    for _, ends in STATISTICS:
        at.append(at[-1] + len(ends) + 1)
    for _ in range(metadata):
        at.append(at[-1] + len(_DOUBLES) + 2)
    return at


class Describer:
    """Texts as sparse vectors; it remembers the buckets of words it has met."""

    def __init__(self, metadata: int):
        self.starts, self.buckets = _starts(metadata), {}

    def __call__(self, text: str | None, metadata: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Rows and values. Metadata are numbers; null, NaN and negative ones share a bin."""
        raw = utf8(text)
        words = raw.split()
        counts = Counter(words)
        if len(self.buckets) > MEMO:
            self.buckets.clear()
        known, rows = self.buckets, []
        for w in counts:
            if (b := known.get(w)) is None:
                b = known[w] = zlib.crc32(w) % BUCKETS
            rows.append(b)
        x = 1 + np.log(np.fromiter(counts.values(), np.float32, len(counts)))
        if len(x):
            x *= WORDS_LENGTH / np.sqrt(float(x @ x))
        bins = [at + int(np.searchsorted(ends, v)) for at, (_, ends), v in zip(self.starts, STATISTICS, statistics(raw, words, counts), strict=False)]
        for at, v in zip(self.starts[len(STATISTICS) :], metadata, strict=False):
            bins.append(at + (int(np.searchsorted(_DOUBLES, v)) if v is not None and v >= 0 else len(_DOUBLES) + 1))
        return np.array(rows + bins, np.int32), np.concatenate([x, np.ones(len(bins), np.float32)])


@dataclass
class Machine:
    """A factorisation machine; without a fit all scores are one half."""

    metadata: tuple[str, ...] = ()
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, RANK), np.float32))

    def score(self, rows: np.ndarray, x: np.ndarray) -> float:
        if not len(self.weights):
            return 0.5
        v = self.factors[rows]
        met = x @ v
        y = self.bias + float(x @ self.weights[rows]) + 0.5 * float(met @ met - (x * x) @ (v * v).sum(1))
        return float(1 / (1 + np.exp(-min(max(y, -500.0), 500.0))))


def _numbers(docs: DataFrame, metadata: tuple[str, ...]) -> list[Column]:
    return [F.col(c).cast("double").alias(f"m{k}") for k, c in enumerate(metadata)]


def learnable(doc_id: Column) -> Column:
    """Whether a row may be learned from, by its id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS != 0


def fit(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("n_chars",), doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, cells: int = CELLS) -> Machine:
    """Fit a Machine on labelled rows that learnable() lets pass: at most `sample` of each quality, the lowest by a hash of the id.

    Their texts are described where they are, whole. In the order of the hash, each quality is taken until `cells`
    entries (8 bytes each) are full, its first document in any case, so what reaches the driver is bounded and long documents are
    no rarer in it than elsewhere. An id with several labels is of the lower quality; of rows that share an id one
    is taken. Both qualities weigh as much in the fit as all of their learnable labels. Without documents of both: a
    Machine that scores one half.
    """
    each = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & learnable(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("q"))
    each = stored(each, "labels")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = each.filter("q = 0").orderBy(*order).limit(sample).unionByName(each.filter("q = 1").orderBy(*order).limit(sample))
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *_numbers(docs, metadata)).join(F.broadcast(ids), "doc_id")
    n_meta = len(metadata)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describer = Describer(n_meta)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                out = []
                for i, t, *meta, q in zip(*(c.to_pylist() for c in whole.slice(at, SLICE).columns), strict=True):
                    rows, x = describer(t, tuple(meta))
                    out.append((q, i, len(rows), rows.tobytes(), x.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["q", "doc_id", "n", "rows", "x"])

    described = given.mapInArrow(describe, "q int, doc_id long, n long, rows binary, x binary")
    # written, for it is read twice; one row for each id from then on
    one = stored(described.groupBy("doc_id").agg(F.min_by(F.struct("q", "n", "rows", "x"), F.struct("n", "rows", "x")).alias("r")).select("doc_id", "r.*"), "described")
    taken, used = [], {0: 0, 1: 0}
    for r in one.select("doc_id", "q", "n").orderBy(*order).collect():  # 2 * sample rows at most
        if not used[r.q] or used[r.q] + r.n <= cells:
            taken.append((r.doc_id,))
            used[r.q] += r.n
        else:
            used[r.q] = cells + 1  # full: what comes later is left out whatever its length
    if not all(used.values()):
        return Machine(tuple(metadata))
    shares = dict(each.groupBy("q").agg(F.count(F.lit(1))).collect())
    wanted = docs.sparkSession.createDataFrame(taken, "doc_id long")
    found = sorted((r.doc_id, r.q, bytes(r.rows), bytes(r.x)) for r in one.join(F.broadcast(wanted), "doc_id").collect())
    vectors = [(np.frombuffer(rows, np.int32), np.frombuffer(x, np.float32)) for _, _, rows, x in found]
    return learn(vectors, np.array([q for _, q, *_ in found], np.float32), (shares[0], shares[1]), tuple(metadata))


def learn(vectors: list[tuple[np.ndarray, np.ndarray]], quality: np.ndarray, shares: tuple[int, int], metadata: tuple[str, ...], passes: int = PASSES) -> Machine:
    """Lower the mean logistic loss by steps over batches (Adam), each touching only the rows of its documents; the
    same input gives the same machine."""
    size = _starts(len(metadata))[-1]
    draw = np.random.default_rng(7)
    m = Machine(metadata, float(np.log(shares[1] / shares[0])), np.zeros(size, np.float32), draw.normal(0, 0.05, (size, RANK)).astype(np.float32))
    have = np.array([(quality == q).sum() for q in (0, 1)])
    weight = (np.array(shares) / sum(shares) / (have / have.sum()))[quality.astype(int)].astype(np.float32)
    order = draw.permutation(len(vectors))
    batches = [_Batch([vectors[k] for k in order[at : at + BATCH]], quality[order[at : at + BATCH]], weight[order[at : at + BATCH]]) for at in range(0, len(order), BATCH)]
    state = [np.zeros((2, *a.shape), np.float32) for a in (m.weights, m.factors)]
    bias = np.zeros(2)
    step = 0
    for _ in range(max(passes, -(-STEPS // len(batches)))):
        for k in draw.permutation(len(batches)):
            step += 1
            b = batches[k]
            rows, gw, gv, g0 = b.gradients(m)
            fix = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            for have_, s, g, ridge in ((m.weights, state[0], gw, RIDGE), (m.factors, state[1], gv, RIDGE_FACTORS)):
                g = g + ridge * have_[rows]
                s[0][rows] = 0.9 * s[0][rows] + 0.1 * g
                s[1][rows] = 0.99 * s[1][rows] + 0.01 * g * g
                have_[rows] -= RATE * fix * s[0][rows] / (np.sqrt(s[1][rows]) + 1e-6)
            bias = np.array([0.9 * bias[0] + 0.1 * g0, 0.99 * bias[1] + 0.01 * g0 * g0])
            m.bias -= RATE * fix * bias[0] / (np.sqrt(bias[1]) + 1e-6)
    if not (np.isfinite(m.weights).all() and np.isfinite(m.factors).all() and np.isfinite(m.bias)):
        return Machine(metadata)
    return m


class _Batch:
    """Vectors of some documents one after another, with their entries' order by row."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], quality: np.ndarray, weight: np.ndarray):
        self.x = np.concatenate([x for _, x in vectors])
        rows = np.concatenate([r for r, _ in vectors])
        n = np.array([len(r) for r, _ in vectors])
        self.starts, self.doc = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
        self.rows, self.place = np.unique(rows, return_inverse=True)
        self.by_row = np.argsort(self.place, kind="stable")
        self.row_starts = np.searchsorted(self.place[self.by_row], np.arange(len(self.rows)))
        self.quality, self.weight = quality, weight

    def gradients(self, m: Machine) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """The rows touched, and the loss's slope by their weights, their factors and the bias."""
        x, v = self.x, m.factors[self.rows][self.place]
        xv = x[:, None] * v
        met = np.add.reduceat(xv, self.starts)
        y = m.bias + np.add.reduceat(x * m.weights[self.rows][self.place], self.starts) + 0.5 * ((met * met).sum(1) - np.add.reduceat((xv * xv).sum(1), self.starts))
        g = self.weight * (1 / (1 + np.exp(-np.clip(y, -50, 50))) - self.quality) / len(y)
        gx = g[self.doc] * x
        gv = gx[:, None] * (met[self.doc] - xv)
        total = lambda a: np.add.reduceat(a[self.by_row], self.row_starts)
        return self.rows, total(gx).astype(np.float32), total(gv).astype(np.float32), float(g.sum())


def score(docs: DataFrame, machine: Machine, text: str = "text", carry: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The carried columns of docs (default: all) with score, the chance of good quality, and predicted, 1 from the threshold on.

    Null texts are empty ones and scored like any; null metadata have a bin of their own; repeated rows score the same. New
    columns whose names clash with carried ones get leading underscores. An empty table gives an empty table.
    """
    carry = docs.columns if carry is None else carry
    made = fresh("score", carry), fresh("predicted", carry)
    inner: list[str] = []
    for c in ("text__", *machine.metadata):
        inner.append(fresh(c, [*carry, *inner]))
    given = docs.select(*carry, F.col(text).alias(inner[0]), *(c.alias(n) for c, n in zip(_numbers(docs, machine.metadata), inner[1:], strict=True)))
    schema = T.StructType([*given.schema.fields[: len(carry)], T.StructField(made[0], T.DoubleType()), T.StructField(made[1], T.IntegerType())])
    n_meta, n_carry = len(machine.metadata), len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describer = Describer(n_meta)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = [machine.score(*describer(t, tuple(meta))) for t, *meta in zip(*(c.to_pylist() for c in batch.columns[n_carry:]), strict=True)]
                new = [pa.array(found, pa.float64()), pa.array([int(s >= threshold) for s in found], pa.int32())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n_carry], *new], names=schema.names)

    return given.mapInArrow(run, schema)
