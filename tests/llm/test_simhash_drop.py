"""One row of each component of fingerprints stays, whatever its id."""

from marlstone.llm import simhash


def test_rows_without_an_id_and_with_one_that_repeats(spark):
    same, other = "one two three four five", "quite another text of seven words"
    rows = [(None, same), (3, same), (None, same), (5, same), (3, other), (2, other), (None, "alone here"), (None, "alone here"), (7, "x y z"), (7, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.drop_near_duplicates(docs, bits=0)
    assert got.columns == docs.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [(3, same), (2, other), (None, "alone here"), (7, "x y z")]))
