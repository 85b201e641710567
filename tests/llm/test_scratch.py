"""Working tables go when what needs them is written."""

from marlstone.llm import _common


def there(spark, path):
    fs, p = _common.hadoop(spark, path)
    return fs.exists(p)


def test_released(spark):
    out = _common.scratch(spark, "out")
    with _common.released(spark):
        inner = _common.scratch(spark, "inner")
        spark.range(3).write.parquet(inner)
        kept = _common.stored(spark.read.parquet(inner), "out", out)
    assert not there(spark, inner) and there(spark, out) and kept.count() == 3
    _common.release(spark, out)
    assert not there(spark, out)


def test_pipeline_leaves_its_last_tables_alone(spark, tmp_path):
    import corpus_pipeline

    rows = [(k, f"document {k} says something of its own in about ten words or so.", "en", "a", 60) for k in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    before = set(_common._live)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.filter("piece = 0").count() > 0
    assert len([p for p in set(_common._live) - before if there(spark, p)]) <= 5  # those of the last stage, which is not written here, and its input
