"""Scores and names against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import lattice, substrings
from test_llm import _LOW, AWKWARD, corpus, table, ws_of


@pytest.mark.parametrize("rounds", [0, 2])
def test_scores_are_sums_over_all_segmentations(spark, rounds):
    p = lattice.pieces("piece_bpe_32k.model")
    place = {x: k for k, x in enumerate(p.pieces)}
    rows = [(i, t) for i, t, *_ in corpus(6, 25)] + [(100, None), (101, "é日🙂 Abc"), (None, "of the x")]
    d = spark.createDataFrame(rows, "doc_id long, text string")

    def ways(word, weights):
        x = b" " + word.translate(_LOW).encode()
        a = [1.0] + [0.0] * len(x)
        for j in range(1, len(x) + 1):
            a[j] = sum(a[i] * math.exp(weights[place[x[i:j]]]) for i in range(j) if x[i:j] in place)
        return math.log(a[-1])

    got = {r.doc_id: r for r in lattice.score(d, rounds=rounds).collect()}
    words = {w for _, t in rows for w in ws_of(t)}
    given = {w: ways(w, p.start) for w in words}
    assert math.isclose(np.exp(p.start).sum() + math.exp(p.end), 1.0, abs_tol=1e-9)
    for i, t in rows:
        assert got[i].vocabulary_score == pytest.approx((sum(given[w] for w in ws_of(t)) + p.end) / math.log(10))
    train = [(i, t) for i, t in rows if not lattice.held_out(i)]
    counted = {}
    for _, t in train:
        for w in ws_of(t):
            counted[w.translate(_LOW).encode()] = counted.get(w.translate(_LOW).encode(), 0) + 1
    df = spark.createDataFrame([(bytearray(w), n) for w, n in counted.items()], "word binary, n long")
    if rounds:
        weights, end = lattice.fit(df, len(train), "piece_bpe_32k.model", rounds)
        assert math.isclose(np.exp(weights).sum() + math.exp(end), 1.0, abs_tol=1e-9)
        own = {w: ways(w, weights) for w in words}
        for i, t in rows:
            assert got[i].score == pytest.approx((sum(own[w] for w in ws_of(t)) + end) / math.log(10))


def test_partitions_follow_the_runs(spark, monkeypatch):
    monkeypatch.setattr(lattice, "RUN_BYTES", 2_000)
    d = table(spark, corpus(7, 60))
    whole = {r.doc_id: r.score for r in lattice.score(d).collect()}
    monkeypatch.setattr(lattice, "RUN_BYTES", 1 << 24)
    assert {r.doc_id: r.score for r in lattice.score(d).collect()} == pytest.approx(whole, rel=1e-7)  # counts are rounded to a millionth


def test_one_long_word(spark):
    r = random.Random(3)
    d = spark.createDataFrame([(0, "".join(r.choice("abcdefgh") for _ in range(20_000))), (1, "x " * 5)], "doc_id long, text string")
    assert all(math.isfinite(x.score) for x in lattice.score(d, rounds=1).collect())


def test_long_words_by_stretches_are_like_short_ones(monkeypatch):
    """Words walked by themselves, over stretches shorter than a piece and longer than the word, give what batches give."""
    p, r = lattice.pieces("piece_bpe_32k.model"), random.Random(4)
    ws = [b"the", bytes(r.choice(b"abcdeinorst") for _ in range(700)), "é日🙂".encode() * 20, b"internationalisation" * 9]
    counts, other = np.array([1.0, 2.0, 3.0, 0.5]), p.start * 1.1
    want, pieces = p.log_probabilities(ws, p.start, other), p.expected(ws, counts, p.start)
    monkeypatch.setattr(lattice, "LONG", 2)
    for stretch in (7, 64, 1 << 15):
        monkeypatch.setattr(lattice, "STRETCH", stretch)
        assert p.log_probabilities(ws, p.start, other) == pytest.approx(want)
        assert p.expected(ws, counts, p.start) == pytest.approx(pieces, abs=1e-8)


def test_rows_of_a_hot_id_are_dealt_to_many_groups(spark, monkeypatch):
    """Rows that share an id, or have none, needn't be together: they never remove each other's words."""
    rows = [(i if i % 3 else (None if i % 2 else 5), t) for i, t, *_ in corpus(9, 60)]
    rows += [(None, rows[1][1]), (5, rows[1][1]), (900, rows[3][1])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    shown = lambda: sorted((str(r.doc_id), r.kept_sha256) for r in substrings.remove_repeats(d).collect())
    want = shown()
    monkeypatch.setattr(substrings, "GROUP_BYTES", 2_000)
    assert shown() == want
    own = d.filter("doc_id is null")
    assert substrings.remove_repeats(own).agg(F.sum("n_removed")).first()[0] == 0


def test_names_with_equal_halves_are_told_apart():
    name, side = np.array([5, 5, 5, 9, 7], np.uint64), np.array([1, 2, 3, 1, 7], np.uint32)
    known, sides = np.array([5, 5, 9, 5], np.uint64), np.array([3, 1, 2, 8], np.uint32)
    assert substrings._known(name, side, known, sides).tolist() == [True, False, True, False, False]
    assert substrings._known(name[:0], side[:0], known, sides).tolist() == [] and not substrings._known(name, side, known[:0], sides[:0]).any()
    sent = [substrings._named(name[:2], side[:2].astype(np.uint64)), substrings._named(name[2:], side[2:].astype(np.uint64))]
    sizes, names, ends = substrings._names(substrings.pa.array(sent))
    assert sizes == [2, 3] and names.tolist() == name.tolist() and ends.tolist() == side.tolist()


def test_pairs_are_ordered():
    rng = np.random.default_rng(1)
    for most in (3, 1 << 62):
        a, b = (rng.integers(0, most, 500).astype(np.uint64) for _ in range(2))
        order = substrings._pair_order(a, b)
        assert list(zip(a[order], b[order], strict=True)) == sorted(zip(a, b, strict=True))


def test_groups_of_any_size_remove_the_same(spark, monkeypatch):
    """Groups of any size give the same result."""
    rows = [(i, t) for i, t, *_ in corpus(8, 30)] + [(i, t) for i, t, *_ in AWKWARD if i is not None and i > 20]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((r.doc_id, r.kept_sha256) for r in substrings.remove_repeats(d).collect())
    monkeypatch.setattr(substrings, "GROUP_BYTES", 3_000)
    assert sorted((r.doc_id, r.kept_sha256) for r in substrings.remove_repeats(d).collect()) == want
    assert substrings.remove_repeats(d).agg(F.sum("n_removed")).first()[0] > 0
