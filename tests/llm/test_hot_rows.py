"""Texts of many matches, ids and rows that repeat, clusters of many blocks."""

import collections
import random
import time

import pytest
from pyspark.sql import functions as F

from marlstone.llm import near, packing, secrets
from test_llm import secret_spans


def test_many_matches_in_one_text(spark):
    r = random.Random(3)
    text = " ".join(r.choice(["token=abcdefgh%d" % k, "secret: short", "AKIA" + "B" * 14, "f" * 33, "é"]) for k in range(3000))
    many = "password=abcdefgh1 x " * 100_000
    d = spark.createDataFrame([(1, text), (2, many), (3, "")], "doc_id long, text string")
    ledger = secrets.Ledger(spark)
    began = time.perf_counter()
    ledger.scan(d)
    got = {x.doc_id: x.spans for x in ledger.findings(d).collect()}
    assert time.perf_counter() - began < 60
    assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in got[1]) == secret_spans(text) and got[3] == []
    assert len(got[2]) == 100_000 and [tuple(s) for s in got[2][-1:]] == [("assign", 21 * 99_999, 21 * 99_999 + 18)]


@pytest.mark.parametrize("kind", ["one id", "one row", "no id"])
def test_repeated_ids_are_dealt_over_shards(spark, kind):
    n = 3000
    id_ = F.lit(None if kind == "no id" else 7).cast("long")
    text = F.lit("a b c") if kind != "one id" else F.concat(F.lit("w "), F.col("id").cast("string"))
    docs = spark.range(0, n, 1, 5).select(id_.alias("doc_id"), F.lit("a").alias("source"), text.alias("text"))
    out = packing.pack(docs, shard=600).collect()
    shards = collections.Counter(r.bin >> 32 for r in out)
    assert len(out) == n and len({r.bin for r in out}) == n and len(shards) == 5 and max(shards.values()) <= 3 * packing.CHUNK
    again = packing.pack(docs.repartition(3), shard=600)
    assert sorted(r.bin for r in again.collect()) == sorted(r.bin for r in out)


def near_copies(spark, n, words):
    """Copies with a word changed: of 150 words all are alike, of 60 only those changed at the same place or the next one."""
    r = random.Random(9)
    rows = []
    for k in range(n):
        ws = [f"w{x}" for x in range(words)]
        ws[r.randrange(5, words - 5)] = f"x{r.randrange(10**9)}"
        rows.append((k, " ".join(ws)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("n, words, times", [(400, 150, 0), (1600, 150, 0), (400, 60, 10)])
def test_large_clusters_are_sent_in_proportion(spark, monkeypatch, n, words, times):
    """Rows sent to be compared in pairs of blocks grow with the cluster, not with its square; what a representative is alike with isn't sent."""
    monkeypatch.setattr(near, "BLOCK", 50)
    sent = []
    dealt = near._dealt
    monkeypatch.setattr(near, "_dealt", lambda *a: sent.append(dealt(*a)) or sent[-1])
    assert near.drop_near_texts(near_copies(spark, n, words)).count() == 1
    assert sum(df.count() for df in sent) <= times * n
