"""The operators against plain versions of themselves, on ordinary and on awkward tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from marlstone.llm import bpe, components, lattice, mixing, naming, packing, quality, secrets, shards, simhash, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_no string, KEPT string, mix_size string, copy string, text__ string, n_words string, arrival string"
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(seed: int, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared passages, secrets and junk."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgé日") for _ in range(r.randint(1, 7))) for _ in range(150)]
    passage = " ".join(r.choice(vocabulary) for _ in range(40))
    out = []
    for i in range(n):
        ws = [r.choice(vocabulary) for _ in range(r.randint(0, 120))]
        text = "".join(w + r.choice([" ", " ", " ", "\n", "\t\v"]) for w in ws)
        if i % 7 == 1:
            text = f"{text} {passage} {text[:50]}"
        if i % 11 == 2:
            text += " api_key = 'AbCd1234+/xy' é AKIA" + "ABCDEFGH12345678 " + "0123456789abcdef" * 3 + " password:short token=secret: longvalue1"
        if i % 5 == 3 and out:
            text = out[r.randrange(len(out))][1]
        if i % 5 == 4 and out:
            text = (out[r.randrange(len(out))][1] or "") + " x"
        out.append((i, text, "en", r.choice(["a", "a", "b", "ç", None]), len(text or "")))
    return out


AWKWARD = [
    (1, None, "en", "a", 0), (2, "", None, None, None), (3, " \n\t ", "en", "a", 4), (None, "one two three", "en", "b", 13), (None, None, None, None, None),
    (5, "same text here " * 5, "en", "a", 1), (5, "same text here " * 5, "en", "a", 1), (6, "same text here " * 5, "en", "b", 1), (7, "x" * 30_000, "en", "a", 1),
    (8, "word " * 20_000, "en", "a", 1), (9, "é日🙂 " * 3_000 + "end", "en", "c", 1), (10, "<|endoftext|> a<|endoftext|>", "en", "c", 1), (11, "a b c", "en", "c", 1), (12, "A B C", "en", "c", 1),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", "k", "m", "c", "t", "n", "a") for r in rows], SCHEMA)


TABLES = {"corpus": corpus(1), "awkward": AWKWARD, "empty": []}


@pytest.fixture(params=list(TABLES))
def rows(request):
    return TABLES[request.param]


def ws_of(text):
    return WORD.findall(text or "")


def by_row(df, *keys):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_scores(spark, rows):
    got = lattice.score(table(spark, rows)).collect()
    low = [(i, [w.translate(_LOW) for w in ws_of(t)]) for i, t, *_ in rows]
    train = [w for i, w in low if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2]
    c = collections.Counter(x for w in train for x in [*w, None])
    n, v = sum(c.values()), len(c)
    want = []
    for i, w in low:
        ts = [*w, None]
        want.append((repr(i), zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2, len(ts), sum(c[t] > 0 for t in ts), n, round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), 5)))
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == sorted(want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_lattice_sums_all_segmentations():
    p = lattice.pieces("piece_bpe_32k.model")
    place = {x: k for k, x in enumerate(p.pieces)}
    rng = np.random.default_rng(0)
    w = np.log(rng.dirichlet(np.ones(len(p.pieces))))

    def brute(x, count=None):
        ways = {0: 1.0}
        for j in range(1, len(x) + 1):
            ways[j] = sum(ways[i] * math.exp(w[place[x[i:j]]]) for i in range(j) if x[i:j] in place)
        return math.log(ways[len(x)])

    words = [b"the", b"thinking", "çé".encode(), b"a", "🙂z".encode(), b"the", b"\xff\x00"]
    assert np.allclose(p.log_probabilities(words, w), [brute(b" " + x) for x in words])
    # expected counts are the derivative of the log-probability by the weights
    counts, eps = p.expected(words, np.ones(len(words)), w), 1e-5
    for k in rng.choice(np.flatnonzero(counts), 5):
        up = w.copy()
        up[k] += eps
        assert abs((p.log_probabilities(words, up).sum() - p.log_probabilities(words, w).sum()) / eps - counts[k]) < 1e-3


def test_held_out_texts_get_better_with_training(spark):
    d = table(spark, corpus(3, 120))
    first, last = (lattice.score(d, rounds=k).filter("held_out").agg(F.sum("score")).first()[0] for k in (1, 5))
    assert last > first


PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}


def secret_spans(text):
    out = [(m.start(), k, m.end(), name) for k, (name, (p, g, least)) in enumerate(PATTERNS.items()) for m in p.finditer(text or "") if len(m.group(g)) >= least]
    return ",".join(f"{name}:{s}:{e}" for s, _, e, name in sorted(out))


def test_secrets(spark, rows):
    d = table(spark, rows)
    ledger = secrets.Ledger(spark)
    ledger.scan(d)
    got = ledger.findings(d).select("doc_id", secrets.spans_text(F.col("spans")).alias("s")).collect()
    assert sorted((repr(r.doc_id), r.s) for r in got) == sorted((repr(i), secret_spans(t)) for i, t, *_ in rows)
    assert len(got) == len(rows)


def test_ledger_scans_only_what_is_new(spark):
    a, b = table(spark, corpus(1, 20)), table(spark, corpus(1, 30))
    ledger = secrets.Ledger(spark)
    n = ledger.scan(a)
    assert n == 3 * len({t or "" for _, t, *_ in corpus(1, 20)}) and ledger.scan(a) == 0
    assert ledger.scan(b) == 3 * len({t or "" for _, t, *_ in corpus(1, 30)}) - n
    newer = (*secrets.RULES[:2], secrets.Rule("hex", r"[0-9a-f]+", 0, 40, version=2))
    assert ledger.scan(b, newer) == len({t or "" for _, t, *_ in corpus(1, 30)})
    assert {s.kind for r in ledger.findings(b, newer).collect() for s in r.spans} == {"assign", "access", "hex"}


def test_packing(spark, rows):
    cap = 50
    got = packing.pack(table(spark, rows), capacity=cap, shard=25).collect()
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.bin].append(r)
    texts = {repr(i): t for i, t, *_ in rows}
    for members in bins.values():
        members.sort(key=lambda r: (r["at"], r.n_words))
        assert all(a["at"] + a.n_words == b["at"] for a, b in zip(members, members[1:], strict=False)) and members[-1]["at"] + members[-1].n_words <= cap
        if len(members) > 1:
            assert len({r.source for r in members}) == len(members)
            assert len({texts[repr(r.doc_id)] or "" for r in members if r.doc_id is not None}) == sum(r.doc_id is not None for r in members)
    assert sum(r.n_words for r in got) == sum(len(ws_of(t)) for _, t, *_ in rows)
    assert collections.Counter(repr(r.doc_id) for r in got if r.piece == 0) == collections.Counter(repr(i) for i, *_ in rows)


def test_best_fit_takes_the_tightest_compatible_bin():
    r = random.Random(5)
    bins, plain = packing.Bins(100), []
    for _ in range(600):
        size, s, c = r.randint(0, 99), 1 << r.randint(0, 5), 1 << r.randint(0, 30) if r.random() < 0.5 else 0
        fits = [(100 - b[0], k) for k, b in enumerate(plain) if size <= 100 - b[0] and 100 - b[0] > 0 and not b[1] & s and not b[2] & c]
        if fits:
            k = min(fits)[1]
            want = (k, plain[k][0])
            plain[k] = (plain[k][0] + size, plain[k][1] | s, plain[k][2] | c)
        else:
            want = (len(plain), 0)
            plain.append((size, s, c))
        assert bins.put(size, s, c) == want


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= cap * sizes[s]}
        if not over:
            target |= share
            break
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return target


def test_mixing(spark, rows):
    d = table(spark, rows)
    plan = mixing.mix_plan(d)
    assert "mix_size" in plan.columns and "_mix_size" in plan.columns
    sizes = collections.Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(ws_of(t))
    target = plain_targets(sizes)
    got = plan.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r._mix_size == len(ws_of(r.text)) and r.mix_source_size == sizes[r.source] and abs(r.mix_target - target[r.source]) < 1e-6 * max(1, target[r.source])
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert math.floor(rate + 1e-9) <= r.mix_copies + 1e-9 and r.mix_copies <= min(3, math.ceil(rate + 1e-9))
    assert by_row(mixing.mix_plan(d)) == by_row(plan)
    mixed = mixing.mix(d)
    assert mixed.columns == d.columns and mixed.count() == sum(r.mix_copies for r in got)


def test_mixing_comes_near_its_targets(spark):
    rows = [(i, "w " * (i % 13 + 1), "en", f"s{min(9, i % 23)}", 0) for i in range(3000)]
    got = mixing.mix_plan(table(spark, rows)).groupBy("source").agg(F.sum(F.col("_mix_size") * F.col("mix_copies")).alias("n"), F.first("mix_target").alias("t")).collect()
    assert all(abs(r.n - r.t) < 0.1 * r.t for r in got)


def test_exact_duplicates(spark, rows):
    d = table(spark, rows)
    out, names = naming.exact_duplicates(d, block=16)
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        t = r["text"] or ""
        g = groups[t]
        assert r[names["keep_id"]] == max((x for x in g if x is not None), default=None) and r[names["group_size"]] == len(g) and r[names["sha256"]] == hashlib.sha256(t.encode()).hexdigest()
    kept = [r for r in got if r[names["kept"]]]
    assert collections.Counter(r["text"] or "" for r in kept) == collections.Counter(groups.keys())
    assert all(r["doc_id"] == r[names["keep_id"]] for r in kept)
    left = naming.drop_exact_duplicates(d)
    assert left.columns == d.columns and left.count() == len(groups)


def test_substrings(spark, rows, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP_BYTES", 4_000)
    monkeypatch.setattr(substrings, "BUCKET_PROBES", 500)
    got = substrings.remove_repeats(table(spark, rows), with_text=True).collect()
    first = {}
    key = lambda i: -1 if i is None else i
    docs = [(key(i), ws_of(t)) for i, t, *_ in rows]
    for i, w in docs:
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            first[g] = min(i, first.get(g, i))
    want = []
    for i, w in docs:
        gone = bytearray(len(w))
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = b"\1" * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    assert sorted((key(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == sorted(want)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


def test_token_counts(spark, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, text, *_ in rows:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        want.append((repr(i), len((text or "").encode()), n, n > 1024))
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in bpe.token_counts(table(spark, rows)).collect()) == sorted(want)


def test_shards_round_trip(spark, rows):
    d = table(spark, rows)
    store = shards.ShardStore(spark, target_bytes=20_000)
    store.append_all(d, F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)).cast("int"), 3)
    store.append(d.limit(0), 9)
    before = store.manifest()[0]
    store.compact()
    assert by_row(store.read()) == by_row(d) == by_row(store.read(before))
    with pytest.raises(shards.Conflict):
        store._commit(before, [], d.schema.json())
    store.vacuum()
    assert store.versions() == [store.manifest()[0]] and store.read().count() == len(rows)


def test_compaction_merges_similar_shards(spark):
    d = table(spark, corpus(2, 70))
    store = shards.ShardStore(spark, target_bytes=60_000)
    for k in range(7):
        store.append(d.filter(F.col("doc_id") % 7 == k).repartition(2), k)
    n = len(store.manifest()[1])
    store.compact()
    sizes = [s.bytes for s in store.manifest()[1]]
    assert len(sizes) < n and max(sizes) <= 1.5 * 60_000 and store.read().count() == 70


def plain_print(text):
    ws = [w.translate(_LOW) for w in ws_of(text)]
    sh = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) > 3 else [" ".join(ws)] if ws else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(spark, rows):
    got = simhash.near_duplicates(table(spark, rows), node=4).collect()
    prints = [(i, plain_print(t)) for i, t, *_ in rows]
    reach = {f: {f} for _, f in prints}
    for f in reach:
        for g in reach:
            if (f ^ g).bit_count() <= 2 and reach[f] is not reach[g]:
                both = reach[f] | reach[g]
                for x in both:
                    reach[x] = both
    least = lambda f: min((i for i, g in prints if i is not None and g in reach[f]), default=None)
    assert sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in got) == sorted((repr(i), f"{f:016x}", repr(least(f))) for i, f in prints)


@pytest.mark.parametrize(("bits", "node"), [(2, 32), (3, 200), (5, 64)])
def test_gray_index_loses_no_link(spark, bits, node):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    prints = [base, np.array([0, 1, 2**63, 2**64 - 1], np.uint64)]
    for k in range(1, 9):
        x = base.copy()
        for _ in range(k % 7 + 1):
            x ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        prints.append(x)
    hot = np.repeat(base[:1], 600)
    for _ in range(bits):
        hot = hot ^ (np.uint64(1) << rng.integers(0, 64, len(hot)).astype(np.uint64))
    u = np.unique(np.concatenate([*prints, hot]))
    root = list(range(len(u)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i] ^ u[i + 1 :]) <= bits) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame([(k, int(v)) for k, v in enumerate(u.view(np.int64))], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.near_components(df, bits, node).collect()}
    assert got == {int(v): find(k) for k, v in enumerate(u.view(np.int64))}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 90)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (2000, 1999)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(91)}, **{1000 + i: 1000 for i in range(50)}, 1999: 1999, 2000: 1999}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_base(text):
    text = text or ""
    ws = ws_of(text)
    grams = collections.Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    hit = set()
    for i in range(len(ws) - 4):
        if grams[tuple(ws[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if ws_of(x)]
    failed = len(ws) < 10 or 100 * len(hit) > 20 * len(ws)
    return len(ws), sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed


def test_quality_counts(spark, rows):
    d = table(spark, rows)
    got = quality.quality_rules(d, quality.Field()).collect()
    want = sorted((repr(i), *plain_base(t)) for i, t, *_ in rows)
    assert sorted((repr(r.doc_id), r._n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r._kept and r.base_failed for r in got)
    left = quality.quality_rules(d, quality.Field(), only_kept=True)
    assert left.columns == d.columns and left.count() == sum(r._kept for r in got)


def test_repeated_words_with_large_vocabularies():
    r = random.Random(1)
    ws = [str(r.randrange(60_000)).encode() for _ in range(50_000)]
    ws += ws[100:120] + ws[300:306]
    assert quality.repeated_words(ws) == plain_base(" ".join(w.decode() for w in ws))[4]


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(3)
    for n in range(1, 8):
        f = quality.Field(rng.normal(size=len(quality.FEATURES)), rng.normal(size=(2, 2)))
        x = rng.random((n, len(quality.FEATURES)))

        def value(y, f=f, x=x):
            return sum((x[t] @ f.weights) * y[t] for t in range(len(y))) + sum(f.steps[a, b] for a, b in zip(y, y[1:], strict=False))

        best = max(([*map(int, f"{k:0{n}b}")] for k in range(1 << n)), key=value)
        assert value(f.decode(x)) == pytest.approx(value(best))


def test_field_learns_junk_lines(spark):
    r = random.Random(9)
    good = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(12)) + "."
    junk = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) + r.choice(["***", "$$$", "&&&"]) for _ in range(12))
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        rows.append((i, "\n".join(good() if not bad or r.random() < 0.2 else junk() for _ in range(r.randint(2, 9))), "en", "a", 0))
        labels.append((i, int(not bad), 0))
    d, lab = table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    crf = quality.fit(d.filter("doc_id < 200"), lab)
    got = {x.doc_id: x._kept for x in quality.quality_rules(d.filter("doc_id >= 200"), crf).collect()}
    assert sum(got[i] == (i % 4 != 0) for i in got) >= 0.95 * len(got)
    assert quality.fit(d, lab.limit(0)).weights.tolist() == list(quality.PRIOR)


@pytest.mark.parametrize("name", ["awkward", "empty", "corpus"])
def test_pipeline_stages(spark, tmp_path, name):
    rows = TABLES[name]
    docs = table(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 1, 0) for r in rows if r[0] is not None], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "source_mix", "best_fit_packing"]
    at, seen = docs, len(rows)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns
        at.write.parquet(str(tmp_path / f"s{k}"))
        at = spark.read.parquet(str(tmp_path / f"s{k}"))
        n = at.count()
        assert n <= seen or k == 3
        seen = n
    want = sorted(repr(r.doc_id) for r in at.collect())
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(repr(r.doc_id) for r in packed.filter("piece = 0").collect()) == want
