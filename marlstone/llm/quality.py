"""Quality rules by line labelling: a linear-chain conditional random field tells content from boilerplate.

Each line with a word is described by a few numbers; Viterbi decoding gives the best sequence of two labels for all
lines of a document; the share of its words that stand in content lines decides whether the document stays. A few
plain counts fail a document before that. Everything about a document is computed where the document is: no shuffle.

The field is fitted on a bounded sample of labelled documents (SAMPLE of each quality, SAMPLE_LINES). Their lines first take the
document's label; after each fit, lines of poor documents that decode as content lose theirs, and it is fitted anew.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm._common import fresh, stored, utf8

# Characters that count as symbols, and the rules' limits.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20

#: Documents of each quality that the fit uses at most, and lines of all of them together; at least one of each quality.
SAMPLE = 1500
SAMPLE_LINES = 1_000_000
#: Lines of a chain in the fit: longer documents are fitted as several chains, so that all of their lines count.
CHAIN = 256
#: A document stays if at least this share of its words stands in content lines.
CONTENT_SHARE = 0.5
#: Rows of a batch that are unpacked at a time.
SLICE = 256

_SPACE, _UPPER, _DIGIT, _STOP = b" \t\n\x0b\x0c\r", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".!?;:,"
_LETTER = _UPPER + _UPPER.lower()

FEATURES = ("one", "symbols", "any_symbol", "upper", "mostly_upper", "marks", "digits", "seen", "repeats", "few_words", "long_words", "ends")
#: Used where no labelled document of either quality is at hand: symbols, capitals, marks and repetition count as boilerplate.
PRIOR = (2.5, -8.0, -1.0, -1.0, -3.0, -6.0, -2.0, -2.0, -4.0, -0.3, -0.5, 0.3)


@dataclass
class Field:
    """A chain field over two labels, 1 being content: weight of each feature for content, and of each step."""

    weights: np.ndarray = field(default_factory=lambda: np.array(PRIOR))
    steps: np.ndarray = field(default_factory=lambda: np.array([[0.5, -0.5], [-0.5, 0.5]]))

    def decode(self, x: np.ndarray) -> list[int]:
        """The most likely labels of a sequence of lines (Viterbi); of equally likely ones, content."""
        scores = (x @ self.weights).tolist()
        (s00, s01), (s10, s11) = self.steps.tolist()
        a0, a1, back = 0.0, scores[0], []
        for s in scores[1:]:
            u0, v0, u1, v1 = a0 + s00, a1 + s10, a0 + s01, a1 + s11
            back.append((v0 >= u0, v1 >= u1))
            a0, a1 = max(u0, v0), max(u1, v1) + s
        label = int(a1 >= a0)
        out = [label]
        for b in reversed(back):
            label = int(b[label])
            out.append(label)
        return out[::-1]


def line_features(lines: list[bytes]) -> np.ndarray:
    """A row of FEATURES for each line; every value is between 0 and 1."""
    seen: set[bytes] = set()
    out = []
    for line in lines:
        ws = line.split()
        n = max(1, len(line))
        letters = len(line) - len(line.translate(None, _LETTER))
        upper = (len(line) - len(line.translate(None, _UPPER))) / max(1, letters)
        symbols = len(line) - len(line.translate(None, SYMBOLS))
        digits = len(line) - len(line.translate(None, _DIGIT))
        repeats = 1 - len(set(ws)) / len(ws)
        out.append((
            1.0, min(1.0, 4 * symbols / n), float(symbols > 0), upper, float(upper > 0.6), min(1.0, 2 * line.count(b"!") / len(ws)), digits / n,
            float(line in seen), min(1.0, 2 * max(0.0, repeats - 0.35)), 1 / len(ws), min(1.0, n / len(ws) / 40), float(line.rstrip()[-1:] in _STOP),
        ))
        seen.add(line)
    return np.array(out, np.float64).reshape(len(out), len(FEATURES))


def repeated_words(ws: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows whose word sequence the list holds twice or more, the first ones included."""
    n = len(ws)
    if n <= window:
        return 0
    ids = dict.fromkeys(ws)
    if len(ids) == n:
        return 0
    for k, w in enumerate(ids):
        ids[w] = k
    x = np.fromiter(map(ids.__getitem__, ws), np.int64, n)
    base, key, span = len(ids), x, len(ids)
    for k in range(1, window):
        if span > (1 << 62) // base:  # name what there is so far by its rank, so that the next product fits
            names, key = np.unique(key, return_inverse=True)
            span = len(names)
        key = key[: n - k] * base + x[k:]
        span *= base
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    at = np.searchsorted(twice, key)
    hit = twice[np.minimum(at, len(twice) - 1)] == key
    edge = np.zeros(n + 1, np.int64)
    where = np.flatnonzero(hit)
    np.add.at(edge, where, 1)
    np.add.at(edge, where + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def judge(text: str | None, crf: Field) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, content_share."""
    raw = utf8(text)
    ws = raw.split()
    n = len(ws)
    chars = len(text or "") - (len(raw) - len(raw.translate(None, _SPACE)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()]
    repeat = repeated_words(ws)
    failed = n < MIN_WORDS or 100 * repeat > REPEAT_PERCENT * n
    share = 0.0
    if lines:
        labels = crf.decode(line_features(lines))
        share = sum(len(x.split()) for x, label in zip(lines, labels, strict=True) if label) / n
    return n, chars, symbols, len(lines) - len(set(lines)), repeat, failed, not failed and share >= CONTENT_SHARE, len(lines), share


JUDGED = (
    ("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()), ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()),
    ("base_failed", T.BooleanType()), ("kept", T.BooleanType()), ("n_lines", T.LongType()), ("content_share", T.DoubleType()),
)
_ARROW = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.DoubleType(): pa.float64()}


def quality_rules(docs: DataFrame, crf: Field, text: str = "text", only_kept: bool = False, carry: list[str] | None = None) -> DataFrame:
    """The carried columns of docs (default: all) with the columns of JUDGED; or, with only_kept, the rows that stay, without them.

    Null and empty texts have no word and fail. Repeated rows and null ids are judged like any. New columns whose
    names clash with carried ones get leading underscores.
    """
    carry = docs.columns if carry is None else carry
    extra = [] if only_kept else [T.StructField(fresh(n, carry), t) for n, t in JUDGED]
    inner = fresh("text__", carry)
    given = docs.select(*carry, F.col(text).alias(inner))
    schema = T.StructType([f for f in given.schema.fields[:-1]] + extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = [judge(t, crf) for t in batch.column(batch.num_columns - 1).to_pylist()]
                columns, names = batch.columns[:-1], batch.schema.names[:-1]
                if only_kept:
                    yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array([f[6] for f in found], pa.bool_()))
                else:
                    new = [pa.array(v, _ARROW[t]) for v, (_, t) in zip(zip(*found, strict=True), JUDGED, strict=True)]
                    yield pa.RecordBatch.from_arrays([*columns, *new], names=[*names, *(f.name for f in extra)])

    return given.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, rounds: int = 3, lines: int = SAMPLE_LINES) -> Field:
    """Fit a Field on at most `sample` labelled documents of each quality (1 good, 0 poor), the lowest by a hash of the id.

    The ids are chosen from the labels alone; of rows that share one, a single text is taken. Their whole texts are
    described where they are; in the order of the hash, documents are fitted as long as each quality has no more than half
    of `lines`, its first one in any case, so what reaches the driver is bounded by lines (48 bytes each) and that one document.
    Without documents of both qualities: the prior.
    """
    each = labels.filter(F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    order = F.xxhash64("doc_id")
    ids = None
    for q in (0, 1):
        some = each.filter(F.col("quality") == q).distinct().orderBy(order, "doc_id").limit(sample)
        ids = some if ids is None else ids.unionByName(some)
    ids = ids.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(ids), "doc_id")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, 16) for at in range(0, whole.num_rows, 16)):
                rows = []
                for i, t, q in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "quality")), strict=True):
                    if found := [x for x in utf8(t).split(b"\n") if x.split()]:
                        rows.append((q, i, len(found), line_features(found).astype(np.float32).tobytes()))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["quality", "doc_id", "n", "x"])

    # written, for it is read twice; one row for each id from then on
    described = stored(picked.mapInArrow(describe, "quality int, doc_id long, n long, x binary"), "described")
    one = described.groupBy("doc_id").agg(F.min_by(F.struct("quality", "n"), F.struct("n", F.xxhash64("x"))).alias("r"))
    taken, used = [], {0: 0, 1: 0}
    for r in one.select("doc_id", "r.quality", "r.n").orderBy(order, "doc_id").collect():  # 2 * sample rows at most
        if not used[r["quality"]] or used[r["quality"]] + r["n"] <= lines // 2:
            used[r["quality"]] += r["n"]
            taken.append((r["doc_id"],))
    if not all(used.values()):
        return Field()
    wanted = docs.sparkSession.createDataFrame(taken, "doc_id long")
    found = described.join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min_by(F.struct("quality", "x"), F.struct("n", F.xxhash64("x"))).alias("r"))
    found = sorted((r["doc_id"], r["r"]["quality"], bytes(r["r"]["x"])) for r in found.collect())
    whole = [(q, np.frombuffer(x, np.float32).reshape(-1, len(FEATURES)).astype(np.float64)) for _, q, x in found]
    truth = [np.full(len(x), q) for q, x in whole]
    crf = Field()
    for k in range(rounds):
        crf = learn(*_chains([x for _, x in whole], truth), crf)
        if k < rounds - 1:
            truth = [np.ones(len(x), int) if q else np.array(crf.decode(x)) for q, x in whole]
            truth = [y if q or not y.all() else np.zeros(len(y), int) for (q, _), y in zip(whole, truth, strict=True)]
    return crf


def _chains(xs: list[np.ndarray], ys: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The documents' lines and labels in chains of CHAIN lines at most."""
    cut = [(x[at : at + CHAIN], y[at : at + CHAIN]) for x, y in zip(xs, ys, strict=True) for at in range(0, len(x), CHAIN)]
    return [x for x, _ in cut], [y for _, y in cut]


def learn(xs: list[np.ndarray], ys: list[np.ndarray], crf: Field, passes: int = 60, rate: float = 0.25, ridge: float = 1e-3) -> Field:
    """Raise the mean conditional log-likelihood of the labels by gradient steps (Adam) from the given field."""
    order = sorted(range(len(xs)), key=lambda k: -len(xs[k]))
    xs, ys = [xs[k] for k in order], [ys[k] for k in order]
    most, total = len(xs[0]), sum(map(len, xs))
    live = [0] * most  # chains that have a line at each place; the longer come first
    for x in xs:
        live[len(x) - 1] += 1
    for t in range(most - 2, -1, -1):
        live[t] += live[t + 1]
    at = [np.stack([x[t] for x in xs[: live[t]]]) for t in range(most)]
    label = [np.array([y[t] for y in ys[: live[t]]]) for t in range(most)]
    features = np.concatenate(at)
    told = np.concatenate(label) @ features
    pairs = np.zeros((2, 2))
    for t in range(1, most):
        np.add.at(pairs, (label[t - 1][: live[t]], label[t]), 1)
    w, s = crf.weights.copy(), crf.steps.copy()
    m = [np.zeros_like(w), np.zeros_like(s)]
    v = [np.zeros_like(w), np.zeros_like(s)]
    for k in range(1, passes + 1):
        e = [x @ w for x in at]
        a = [np.stack([np.zeros(live[0]), e[0]], 1)]
        for t in range(1, most):
            p = a[t - 1][: live[t]]
            a.append(np.stack([np.logaddexp(p[:, 0] + s[0, 0], p[:, 1] + s[1, 0]), np.logaddexp(p[:, 0] + s[0, 1], p[:, 1] + s[1, 1]) + e[t]], 1))
        b = [np.zeros((n, 2)) for n in live]
        for t in range(most - 2, -1, -1):
            n, nxt = live[t + 1], b[t + 1].copy()
            nxt[:, 1] += e[t + 1]
            b[t][:n] = np.stack([np.logaddexp(s[0, 0] + nxt[:, 0], s[0, 1] + nxt[:, 1]), np.logaddexp(s[1, 0] + nxt[:, 0], s[1, 1] + nxt[:, 1])], 1)
        z = np.logaddexp(a[0][:, 0] + b[0][:, 0], a[0][:, 1] + b[0][:, 1])
        content = np.concatenate([np.exp(np.minimum(0, a[t][:, 1] + b[t][:, 1] - z[: live[t]])) for t in range(most)])
        moved = np.zeros((2, 2))
        for t in range(1, most):
            n = live[t]
            for i in (0, 1):
                for j in (0, 1):
                    moved[i, j] += np.exp(np.minimum(0, a[t - 1][:n, i] + s[i, j] + (e[t] if j else 0) + b[t][:, j] - z[:n])).sum()
        for n, (have, up) in enumerate(((w, (told - content @ features) / total), (s, (pairs - moved) / total))):
            up = up - ridge * have
            m[n] = 0.9 * m[n] + 0.1 * up
            v[n] = 0.99 * v[n] + 0.01 * up * up
            have += rate * (m[n] / (1 - 0.9**k)) / (np.sqrt(v[n] / (1 - 0.99**k)) + 1e-8)
    if not (np.isfinite(w).all() and np.isfinite(s).all() and math.isfinite(float(w.sum()))):
        return crf
    return Field(w, s)
