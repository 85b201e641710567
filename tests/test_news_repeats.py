"""News repeats are left out by every way in."""

import os

import pytest
from pyspark.sql import functions as F

from marlstone.__main__ import main
from marlstone.plans import pipelines
from marlstone.sources import files
from marlstone.streaming import sinks
from test_messages import message


def lines(*titles, **more):
    return "\n".join(message("news", title=t, **more).decode() for t in titles) + "\n"


def test_stream_leaves_repeats_out_over_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k, text in enumerate([lines("a", "b", "a"), lines("a", "c") + "oops\noops\n", lines("b", "c", "d")]):
        (tmp_path / "in" / f"{k}.txt").write_text(text)
    stream = files.messages(spark, str(tmp_path / "in"), stream=True, files_per_batch=1)
    q = sinks.run_pipeline(stream, "news", str(tmp_path / "main"), str(tmp_path / "ck"), str(tmp_path / "dead"))
    assert q.awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "main"))
    assert sorted(r.title for r in rows.collect()) == ["a", "b", "c", "d"]
    assert rows.first().topics[0].topic == "Earnings"
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 2


def test_stream_by_a_time_column(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k, at in enumerate(["20260315T000000", "20260315T110000", "20260315T130000"]):
        (tmp_path / "in" / f"{k}.txt").write_text(lines("a", time_published=at))
        os.utime(tmp_path / "in" / f"{k}.txt", (1_700_000_000 + k,) * 2)
    stream = files.messages(spark, str(tmp_path / "in"), stream=True, files_per_batch=1)
    assert sinks.run_pipeline(stream, "news", str(tmp_path / "main"), str(tmp_path / "ck"), None, dedup_by="time_published").awaitTermination(60)
    assert sorted(r.time_published.hour for r in spark.read.parquet(str(tmp_path / "main")).collect()) == [0, 13]


@pytest.mark.parametrize("streaming", [False, True])
@pytest.mark.parametrize("by, n", [(None, 2), ("none", 3), ("time_published", 2)])
def test_command_line(spark, tmp_path, streaming, by, n):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.txt").write_text(lines("a", "b", "a"))
    more = ["--suppress-by", by] if by else []
    more += ["--stream", "--checkpoint", str(tmp_path / "ck")] if streaming else []
    main(["news", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), *more], spark)
    assert spark.read.parquet(str(tmp_path / "out")).count() == n


def test_suppress_by_is_refused_elsewhere(spark, tmp_path):
    with pytest.raises(SystemExit):
        main(["trades", "--input", "x", "--output", "y", "--suppress-by", "ingest"], spark)


def test_batch_by_ingest_time(spark):
    df = spark.createDataFrame([(bytearray(message("news")),)] * 2, "value binary")
    assert pipelines.build(df, "news", dedup_by=pipelines.INGEST)[0].columns == pipelines.build(df, "news")[0].columns
    assert pipelines.build(df, "news", now=F.timestamp_seconds(F.lit(0)), dedup_by=pipelines.INGEST)[0].count() == 1
