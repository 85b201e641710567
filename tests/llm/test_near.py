"""Near copies against all pairs of texts."""

import random

import numpy as np
import pytest

import corpus_pipeline
from marlstone.llm import near, simhash


def grams(text):
    ws = (text or "").lower().split()
    return {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set()


def edited(r, text, edits):
    ws = text.split()
    for _ in range(edits):
        ws[r.randrange(len(ws))] = f"new{r.randrange(10**6)}"
    return " ".join(ws)


def copies(seed=1, groups=30):
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        base = " ".join(f"w{r.randrange(3000)}" for _ in range(r.randint(60, 150)))
        out += [base, *(edited(r, base, r.randint(1, 4)) for _ in range(r.randint(1, 3)))]
    hot = " ".join(f"w{r.randrange(3000)}" for _ in range(100))
    out += [edited(r, hot, r.randint(1, 4)) for _ in range(60)]
    out += [None, "", " \n", "one two", "ONE  two", "a b c d e", "a b c d f"]
    order = list(range(len(out)))
    r.shuffle(order)
    ids = [None if k % 9 == 4 else k // 2 if k % 7 == 3 else k for k in order]
    return [(i, t) for i, t in zip(ids, out, strict=True)]


def components(rows):
    sets, root = [grams(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if 5 * shared >= 4 * (len(sets[a]) + len(sets[b]) - shared):
                root = [root[b] if x == root[a] else x for x in root]
    out = {}
    for k, x in enumerate(root):
        out.setdefault(x, []).append(rows[k])
    return list(out.values())


@pytest.mark.parametrize("block", [1000, 7])
def test_one_of_each_component_at_four_fifths_stays(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    rows = copies()
    want = components(rows)
    assert sum(len(c) > 1 for c in want) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert len(kept) == len(want)
    for c in want:
        mine = [x for x in kept if x in c]
        ids = [i for i, _ in c if i is not None]
        assert [i for i, _ in mine] == [min(ids) if ids else None]


def test_no_documents(spark):
    assert near.drop_near_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("dense", [8, 10_000])
def test_nodes_join_all_candidates(monkeypatch, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    rng = np.random.default_rng(7)
    one = np.uint64(1)
    base = rng.integers(0, 2**63, (14, simhash.PRINTS), dtype=np.uint64) * np.uint64(2)
    words = [base]
    for times, most in ((60, 9), (20, 30)):
        for k in (0, 1, 2):
            x = np.repeat(base[k : k + 1], times, 0)
            for _ in range(most):
                x[np.arange(times), rng.integers(0, simhash.PRINTS, times)] ^= one << rng.integers(0, 64, times).astype(np.uint64)
            words.append(x)
    words = np.concatenate(words)
    codes, own = words[:, 1], rng.random(len(words)) < 0.6
    far = np.bitwise_count(words[:, None] ^ words[None]).sum(2)
    top = np.bitwise_count((codes[:, None] ^ codes[None]) >> np.uint64(64 - simhash.SECTION))
    linked = (far <= simhash.FAR) & (top <= simhash.SLACK) & (np.bitwise_count(codes[:, None] ^ codes[None]) <= simhash.REACH) & (own[:, None] | own[None])
    root = simhash.node_roots(codes, words, own)
    assert all(root[a] == root[b] for a, b in zip(*np.nonzero(linked), strict=True))
    reach = far <= simhash.FAR  # nothing is joined but what such distances reach
    for _ in range(8):
        reach = (reach.astype(np.int64) @ reach) > 0
    assert all(reach[a, root[a]] for a in range(len(words)))


def test_recall_of_candidates_at_the_limit():
    r = random.Random(2)
    found = n = 0
    for _ in range(60):
        words = [f"w{r.randrange(5000)}" for _ in range(300)]
        other = list(words)
        for k in range(0, 300, 50):
            other[k + 10] = f"x{r.randrange(10**9)}"
        a, b = (near.shingle_set(" ".join(x)) for x in (words, other))
        assert near.alike(a, b)
        x = simhash.set_prints(a) ^ simhash.set_prints(b)
        parts = [int(np.bitwise_count(x[s] >> np.uint64(at) & np.uint64(0xFFFF))) for s in range(simhash.PRINTS) for at in range(0, 64, 16)]
        found += min(parts) <= simhash.SLACK and int(np.bitwise_count(x).sum()) <= simhash.FAR
        n += 1
    assert found >= 0.97 * n
