"""Reconciliation: whether every message that came in is accounted for once, in a table, among dead letters or as a duplicate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def books(came: DataFrame, lanes: dict[str, DataFrame], key: str = "raw") -> DataFrame:
    """For each distinct message, by digest: how often it came in (came), how often each lane has it, and the balance.

    Messages are counted as a multiset: equal ones as often as they are there. Counts are combined in the tasks, so a message
    that is most of the input costs no more than others, and only digests and counts are shuffled, once. Null messages are one message.
    """
    names = ["came", *lanes]
    sides = [df.select(F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"), 256).alias("digest"), F.col(key).isNull().alias("none"), F.lit(n).alias("lane")) for n, df in zip(names, [came, *lanes.values()], strict=True)]
    rows = sides[0]
    for side in sides[1:]:
        rows = rows.unionByName(side)
    out = rows.groupBy("digest", "none").agg(*(F.count_if(F.col("lane") == n).alias(n) for n in names))
    found = F.lit(0)
    for n in lanes:
        found = found + F.col(n)
    return out.withColumn("balance", F.col("came") - found)


def totals(book: DataFrame) -> DataFrame:
    """lane and n: what came, what each lane has, and how many messages are lost or too many."""
    names = [c for c in book.columns if c not in ("digest", "none", "balance")]
    sums = book.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names), F.coalesce(F.sum(F.greatest("balance", F.lit(0))), F.lit(0)).alias("lost"), F.coalesce(F.sum(F.greatest(-F.col("balance"), F.lit(0))), F.lit(0)).alias("surplus"))
    each = F.array(*(F.struct(F.lit(n).alias("lane"), F.col(n).cast("long").alias("n")) for n in (*names, "lost", "surplus")))
    return sums.select(F.explode(each).alias("x")).select("x.*")


def misfits(book: DataFrame) -> DataFrame:
    """The messages that are lost (balance above zero) or too many."""
    return book.filter("balance <> 0")
