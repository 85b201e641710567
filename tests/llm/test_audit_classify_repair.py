"""Source divergence, the factorisation machine and conversation repair against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import divergence, factorisation, queries, repair

WS = " \t\n\x0b\x0c\r"


# ---- source divergence


def plain_audit(rows, min_docs, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
        groups.add((lang, source))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(of):
            n = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 5) // (n + 5 * v) for t in kept}

        p = shares(counts[lang, source])
        q = shares(sum((counts[g] for g in groups if g[0] == lang), Counter()))
        pairs = [(-sum(abs(p[t] - o[t]) for t in kept), other) for x, other in groups if x == lang and other != source for o in [shares(counts[lang, other])]]
        terms = [(q[t] - p[t], t) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, ranked, most in (("pair", pairs, None), ("term", terms, top)):
            for k, (value, item) in enumerate(sorted(ranked, key=lambda r: (r[0], r[1].encode()))[:most], 1):
                out.add((lang, source, part, item, -value, k))
    return out


@pytest.mark.parametrize("seed, min_docs", [(0, 3), (1, 1), (2, 1000)])
def test_audit_against_a_plain_version(spark, seed, min_docs):
    r = random.Random(seed)
    vocabulary = ["Alpha", "beta", "Été", "straße", "x1y", "ÀB", "日本", "o'clock", "İ", "zz_zz", " q"]
    rows = [(r.choice([None, "", " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 30)))]), r.choice(["en", "de", None, ""]), r.choice(["s1", "s2", "é", "z", None])) for _ in range(150)]
    rows += [("alone here", "xx", "only"), (None, "empty", "a"), ("", "empty", "b")] + [("Common words", "en", "s1")] * 40
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    df = df.select("*", F.lit(1).alias("g"), F.lit(2).alias("term"), F.lit(3).alias("rank"), F.lit(4).alias("n"))  # names of its own tables
    got = {tuple(x) for x in divergence.audit(df, min_docs=min_docs, top=4).collect()}
    assert got == plain_audit(rows, min_docs, 4)


def test_audit_flushes_and_joins_by_shuffle(spark, monkeypatch):
    rows = [(f"w{k % 7} common w{k % 11}", "en", f"s{k % 3}") for k in range(100)]
    rows = [(t.translate({ord(str(d)): "abcdefghij"[d] for d in range(10)}), a, b) for t, a, b in rows]
    df = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    want = plain_audit(rows, 5, 50)
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(divergence, "SLICE", 7)
    assert {tuple(x) for x in divergence.audit(df, min_docs=5).collect()} == want


def test_shares_are_exact(spark):
    n, total = 9_007_199_254_740_993_001, 9_100_000_000_000_000_123
    df = spark.createDataFrame([(n, total, 7), (0, 0, 0)], "n long, total long, v long")
    assert [r[0] for r in df.select(divergence.share(F.col("n"), F.col("total"), F.col("v"))).collect()] == [1 + 10**9 * (n + 5) // (total + 35), None]


def test_audit_of_nothing(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(df).count() == 0


# ---- factorisation machine


def good(r):
    return "\n".join(" ".join(r.choice(["the", "of", "and", "house", "river", "green", "walk", "stone"]) for _ in range(9)) + "." for _ in range(r.randint(1, 6)))


def poor(r):
    return "\n".join(r.choice(["### $$$ BUY NOW", "*** CLICK *** CLICK ***", "WIN WIN WIN !!!"]) for _ in range(r.randint(2, 12)))


def labelled(spark, n, seed=0):
    r = random.Random(seed)
    rows = [(k, good(r) if k % 3 else poor(r), None if k % 10 == 0 else 5) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int").repartition(3)
    return docs, spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(n)], "doc_id long, quality int")


def test_score_is_the_sum_over_pairs():
    r = np.random.default_rng(3)
    size = factorisation._starts(1)[-1]
    m = factorisation.Machine(("n_chars",), 0.3, r.normal(0, 0.1, size).astype(np.float32), r.normal(0, 0.1, (size, factorisation.RANK)).astype(np.float32))
    rows, x = factorisation.Describer(1)("some words and some more ### 1!\n\nSHOUT", (40,))
    y = m.bias + sum(m.weights[i] * v for i, v in zip(rows, x, strict=True))
    y += sum(float(m.factors[a] @ m.factors[b]) * u * v for (a, u), (b, v) in itertools.combinations(zip(rows, x, strict=True), 2))
    assert m.score(rows, x) == pytest.approx(1 / (1 + np.exp(-y)), rel=1e-4)


def test_steps_follow_the_slope():
    """Slopes of the loss equal differences of it."""
    r = np.random.default_rng(1)
    d = factorisation.Describer(0)
    vectors = [d(t, ()) for t in ("a b c", "c d ### d", "")]
    q, w = np.array([1, 0, 1], np.float32), np.array([1, 2, 0.5], np.float32)
    size = factorisation._starts(0)[-1]
    m = factorisation.Machine((), 0.1, r.normal(0, 0.3, size), r.normal(0, 0.3, (size, factorisation.RANK)))

    def loss():
        p = np.array([m.score(*v) for v in vectors])
        return float((w * -(q * np.log(p) + (1 - q) * np.log(1 - p))).mean())

    rows, gw, gv, g0 = factorisation._Batch(vectors, q, w).gradients(m)
    for k in range(0, len(rows), 3):
        for array, slope, at in ((m.weights, gw[k], (rows[k],)), (m.factors, gv[k, 2], (rows[k], 2))):
            array[at] += 1e-4
            up = loss()
            array[at] -= 2e-4
            down = loss()
            array[at] += 1e-4
            assert (up - down) / 2e-4 == pytest.approx(slope, abs=2e-3)
    m.bias += 1e-4
    up = loss()
    m.bias -= 2e-4
    assert (up - loss()) / 2e-4 == pytest.approx(g0, abs=2e-3)


def test_classifier_tells_held_out_documents_apart(spark):
    docs, labels = labelled(spark, 400)
    m = factorisation.fit(docs, labels)
    got = {r.doc_id: r for r in factorisation.score(docs, m).collect()}
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 40 and all(got[k].predicted == int(k % 3 > 0) for k in held)
    flipped = labels.withColumn("quality", F.when(factorisation.learnable(F.col("doc_id")), F.col("quality")).otherwise(1 - F.col("quality")))
    again = factorisation.fit(docs, flipped.union(flipped))  # neither labels that are held out nor repeated ones count
    assert np.array_equal(again.weights, m.weights) and again.bias == m.bias
    other = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", "n_chars", F.lit("x").alias("source"))
    assert {r.doc_id - 7: r.score for r in factorisation.score(other, m).collect()} == {k: r.score for k, r in got.items()}


def test_classifier_on_awkward_rows(spark):
    docs, labels = labelled(spark, 60)
    m = factorisation.fit(docs, labels, sample=3, cells=1)  # the first of each quality, whatever its length
    assert len(m.weights)
    rows = [(1, None, None), (1, "", 0), (None, " \n\t", -5), (2, "word " * 200_000, 10**6), (2, "é" * 300_000, None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, n_chars int").select("*", *(F.lit("c").alias(n) for n in ("score", "_score", "Predicted", "text__")))
    out = factorisation.score(odd, m)
    assert out.columns[: len(odd.columns)] == odd.columns and out.columns[len(odd.columns) :] == ["__score", "_predicted"]
    assert all(0 <= r["__score"] <= 1 and r["_predicted"] == int(r["__score"] >= 0.3) for r in out.collect()) and out.count() == 5
    none = factorisation.fit(docs, labels.filter("quality = 1"))
    assert {r.score for r in factorisation.score(docs, none).collect()} == {0.5}
    assert factorisation.score(docs.limit(0), m).count() == 0


# ---- conversation repair


def plain_repair(rows):
    """Each conversation's least (cost, audit), by a search from its end over four states, without charts."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, given in by.items():
        left = []
        for turn, role, text in given:
            code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            left += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
        out[conv] = plain_one(sorted(left, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{r[1]}\0{r[2]}".encode()).hexdigest())))
    return out


def plain_one(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(WS)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, *_ in rows if t is not None]
    go = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    given = [(q, name, to) for (q, x), to in go.items() for name in ("user", "assistant") if x == name[0]]
    best = [(0, "", ()) if q in (0, 3) else (10**9, "", ()) for q in range(4)]
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            (_, role, text), fault = rows[i], faults[i]
            ways = [[(best[q][0] + 3, "D" + best[q][1], best[q][2])] for q in range(4)]
            if fault in ("", "truncated"):
                more = int(fault != "")
                for (q, x), to in go.items():
                    if x == role[:1]:
                        ways[q].append((best[to][0] + more, "K" + best[to][1], (f"{role}:{text}", *best[to][2])))
                for q, name, to in given:
                    ways[q].append((best[to][0] + 2 + more, "R" + best[to][1], (f"{name}:{text}", *best[to][2])))
            best = [min(w) for w in ways]
        for _ in range(6):
            for q, name, to in given:
                best[q] = min(best[q], (best[to][0] + 2, "I" + best[to][1], (f"{name}:", *best[to][2])))
    n = Counter(faults)
    cost, audit, lines = best[0]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": n["blank"], "duplicate": n["duplicate"], "truncated": n["truncated"],
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def some_rows(r, n):
    return [(k, r.choice(["user", "assistant", "system", "tool", "user", "assistant"]), r.choice(["a.", "b.", "c", "d?", " ", "e!", "f", f"g{k}."])) for k in range(n)]


def test_parses_against_a_plain_version():
    r = random.Random(11)
    for _ in range(3000):
        rows = some_rows(r, r.randint(0, 9))
        s, seen = repair.Stretch(), set()
        for turn, role, text in rows:
            s.add(turn, role, text, (role, text) in seen)
            seen.add((role, text))
        want = plain_one(rows)
        assert repair._repaired(s) == want, rows
        cuts = sorted({0, len(rows), *(r.randint(0, len(rows)) for _ in range(3))})
        parts, column, hows = [s.rows[a:b] for a, b in itertools.pairwise(cuts)], repair.OPEN, []
        for part in parts:
            column, how = repair.linked(column, repair.matrix(part))
            hows.append(how)
        at, leaves, audit, cost = repair.ended(column)[0], [None], "", 0
        for how in reversed(hows):
            at = how[at]
            leaves.append(at)
        for part, a, b, enters, leave in zip(parts, cuts[:-1], cuts[1:], leaves[:0:-1], leaves[-2::-1], strict=True):
            c, said, _ = repair.applied(part, s.roles[a:b], s.texts[a:b], *repair.edits(part, repair.begun(enters), leave))
            audit, cost = audit + said, cost + c
        assert (audit, cost) == (want["audit"], want["cost"]), (rows, cuts)


@pytest.fixture
def many_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    spark.conf.set(name, "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def told(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    df = df.select("*", *(F.lit(1).alias(n) for n in ("code", "key", "row", "copy", "data", "place")))
    return {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in repair.repair(repair.damaged(df)).collect()}


def test_repair_against_a_plain_version(spark, many_partitions):
    """Conversations of all sizes, one of a third of all rows and more than a task's, nulls in every column, equal and shared turns."""
    r = random.Random(5)
    rows = []
    for conv, n in [(1, 3000), (None, 700), (2, 1), *((k, r.randint(1, 12)) for k in range(3, 500))]:
        for k, role, text in some_rows(r, n):
            rows.append((conv, r.choice([k] * 30 + [None, k // 2]), r.choice([role] * 20 + [None]), r.choice([text] * 20 + [None, ""])))
    rows += rows[:50] + [(900, k, "user", "same.") for k in range(400)]
    got = told(spark, rows)
    want = plain_repair(rows)
    assert set(got) == set(want) and [c for c in want if got[c] != want[c]] == []


def test_repair_of_little(spark):
    gone = next(k for k in range(100) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = told(spark, [(gone, 0, "user", "Hello.")])[gone]
    assert got == {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(repair.damaged(df)).count() == 0
    long = "word " * 400_000
    rows = [(7, k, "user" if k % 2 == 0 else "assistant", long + f"{k}.") for k in range(6)]
    assert told(spark, rows) == plain_repair(rows)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_of_repair(spark, sf):
    d = f"/root/testdata/sf{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in queries.op13_conversation_repair(spark, d).collect()}
    assert got == plain_repair(rows)
