"""Bytes to variants, flattening, routing and the dead-letter lane's form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.cast import apart, field, kind, once, strict_string


def parse_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """value (bytes or text) to v, a variant, and raw, its text; codes has why it could not be parsed.

    Other columns stay. The variant is made in a projection of its own, so what follows reads it parsed once.
    """
    rest = [c for c in df.columns if c != value]
    s = F.col("__text")
    out = df.select(*rest, apart(F.col(value).cast("string")).alias("__text"))
    out = out.select(*rest, s, apart(F.try_parse_json(F.try_validate_utf8(s))).alias("v"))
    why = F.when(F.col("v").isNull(), F.array(F.when(F.is_valid_utf8(s), F.lit("parse:json")).otherwise(F.lit("parse:utf8")))).otherwise(F.array().cast("array<string>"))
    # a text that was parsed is valid
    raw = F.when(F.col("v").isNull(), F.make_valid_utf8(s)).otherwise(s)
    return out.select(*rest, raw.alias("raw"), "v", why.alias("codes"))


def explode_batches(df: DataFrame, place: str | None = None) -> DataFrame:
    """One row for each element of an array message, one for any other message, none for an empty array.

    place: a new column for an element's place in its message, from 0.
    """
    items = F.when(kind(F.col("v")).startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>")).otherwise(F.array("v"))
    rest = [c for c in df.columns if c != "v"]
    spread = F.posexplode(items).alias(place, "v") if place else F.explode(items).alias("v")
    out = df.select(*rest, spread)
    out = out.select(*rest, *([place] if place else []), once(F.col("v")).alias("v"))
    return out.withColumn("raw", F.when(F.size("codes") == 0, F.to_json("v")).otherwise(F.col("raw")))


def route(df: DataFrame, key: str, *values: str) -> DataFrame:
    """The rows whose string field `key` is one of the values; all others vanish."""
    return df.filter(F.coalesce(strict_string(field(F.col("v"), key)).isin(*values), F.lit(False)))


def only_symbols(df: DataFrame, column: str, wanted: list[str]) -> DataFrame:
    return df.filter(F.col(column).isin(*wanted))


def dead_letters(df: DataFrame, stage: str) -> DataFrame:
    """Rows with codes as dead letters; the error is the codes, joined."""
    return df.filter(F.size("codes") > 0).select(F.lit(stage).alias("stage"), F.concat_ws("; ", "codes").alias("error"), "codes", "raw")


def union_dead_letters(*lanes: DataFrame) -> DataFrame:
    out = lanes[0]
    for lane in lanes[1:]:
        out = out.unionByName(lane)
    return out


def dead_letter_bytes(df: DataFrame) -> DataFrame:
    """A dead letter as the bytes of {"error", "raw"}."""
    return df.select(F.to_json(F.struct("error", "raw"), {"ignoreNullFields": "false"}).cast("binary").alias("value"))


def message_bytes(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Each row as one JSON object; names renames its columns, nulls stay."""
    columns: list[Column] = [F.col(c).alias((names or {}).get(c, c)) for c in df.columns]
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary").alias("value"))


def batch_message(df: DataFrame, run: str) -> DataFrame:
    """All rows of a run as one JSON array; runs without rows give nothing.

    A message holds its whole run by definition, so a run must be of a size that a message can have.
    """
    rest = [c for c in df.columns if c != run]
    body = F.to_json(F.array_sort(F.collect_list(F.struct(*rest))), {"ignoreNullFields": "false"})
    return df.groupBy(run).agg(body.cast("binary").alias("value"))


def batch_events(df: DataFrame, run: str, order: list[str], event: str = "event") -> DataFrame:
    """The events (JSON text) of a run as one JSON array in their order; runs without any give nothing.

    A message holds its whole run by definition, so a run must be of a size that a message can have.
    """
    items = F.transform(F.array_sort(F.collect_list(F.when(F.col(event).isNotNull(), F.struct(*order, F.col(event).alias("__event"))))), lambda x: x["__event"])
    out = df.groupBy(run).agg(items.alias("__items"))
    return out.filter(F.size("__items") > 0).select(run, F.concat(F.lit("["), F.array_join("__items", ","), F.lit("]")).cast("binary").alias("value"))
