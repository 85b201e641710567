"""Every row of an appended table is in the store, whatever its arrival."""

import pytest
from pyspark.sql import functions as F

from marlstone.llm import queries, shards


@pytest.mark.parametrize("kind", ["int", "string"])
def test_arrivals_out_of_range_are_kept(spark, kind):
    rows = spark.createDataFrame([(k, a) for k, a in enumerate([0, 1, 2, -1, None, 7, 0])], "doc_id long, a int")
    store = shards.ShardStore(spark)
    version = store.append_all(rows.select("doc_id"), F.pmod("doc_id", F.lit(2)).cast(kind), 2)
    assert version == 2
    assert store.append_all(rows.join(rows.select("doc_id"), "doc_id").select("doc_id"), F.when(F.col("doc_id") > 3, F.col("doc_id")).cast(kind), 2) == 3
    assert sorted(r.doc_id for r in store.read().collect()) == sorted([*range(7)] * 2)


def test_an_empty_table_is_a_version(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    store = shards.ShardStore(spark)
    assert store.append_all(spark.createDataFrame([], "doc_id long"), F.lit(0), 1) == 1
    assert store.read().columns == ["doc_id"] and store.read().count() == 0
    assert queries.op8_compacted_shards(spark, str(tmp_path)).collect() == []
