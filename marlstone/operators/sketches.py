"""Mergeable sketches by hour: how many distinct values, and quantiles, kept small and rolled up to any longer stretch.

A sketch is a few kilobytes whatever it has seen, and two of them merge into the sketch of both, so days, weeks and groups of streams come
from stored hours without the rows. Distinct counts are HyperLogLog sketches (relative standard error 1.04 / sqrt(2^k)), quantiles KLL
sketches (rank error of about 2.3 / k^0.9); both are built in the JVM, by partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes: 2^12 registers (error 1.6 %), 200 items a level (rank error 1.3 %).
HLL_K, KLL_K = 12, 200


def hourly(rows: DataFrame, by: list[str], ts: str, distinct: str | None = None, values: str | None = None) -> DataFrame:
    """by and hour with n, the sketch of `distinct` (hll) and that of the numbers in `values` (kll); null values are in neither.

    An hour without values has null sketches, which merge into nothing.
    """
    out = [F.count(F.lit(1)).alias("n")]
    if distinct:
        out.append(F.hll_sketch_agg(F.col(distinct).cast("string"), F.lit(HLL_K)).alias("hll"))
    if values:
        out.append(F.kll_sketch_agg_double(F.col(values).cast("double"), F.lit(KLL_K)).alias("kll"))
    return rows.groupBy(*by, F.date_trunc("hour", ts).alias("hour")).agg(*out)


def rolled(hours: DataFrame, by: list[str], unit: str | None = "day", kll_out: str = "kll") -> DataFrame:
    """Hours' sketches merged by the columns of `by` and a longer unit (None: all time)."""
    keys = [*by, *([F.date_trunc(unit, "hour").alias(unit)] if unit else [])]
    out = [F.sum("n").alias("n")]
    if "hll" in hours.columns:
        out.append(F.hll_union_agg("hll").alias("hll"))
    if "kll" in hours.columns:
        out.append(F.kll_merge_agg_double("kll").alias(kll_out))
    return hours.groupBy(*keys).agg(*out)


def distinct_count(sketch: str = "hll") -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0).cast("long"))


def quantile(share: float, sketch: str = "kll") -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(share))
