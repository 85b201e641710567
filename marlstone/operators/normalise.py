"""Typed rows from parsed messages; what can't be typed gets codes for the dead-letter lane."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.cast import Read, Steps, apart, codes_of, compact_timestamp, field, is_double, is_long, is_null, is_scalar, iso_timestamp, kind, loose_string, strict_string, to_double, to_long
from marlstone.operators import derive, schemas
from marlstone.operators.contracts import ask_size


class _Reader:
    """A message's columns in three steps: its fields, typed values of them, and the conditions under which each fails."""

    def __init__(self, v: Column):
        self.steps, self.columns, self.marks, self.errors, self.nulls = Steps("__f", v), {}, {}, [], {}

    def field(self, key: str, f: Column | None = None) -> Read:
        return Read(self.steps, self.steps.key(key) if f is None else f)

    def mark(self, condition: Column) -> Column:
        """A condition on fields, kept beside the typed values."""
        name = f"__m{len(self.marks)}"
        self.marks[name] = F.coalesce(condition, F.lit(False))
        return F.col(name)

    def fails(self, code: str, when: Column) -> None:
        self.errors.append((code, when))

    def typed(self, name: str, key: str, cast: Callable[[Read], Column], what: str, f: Column | None = None) -> None:
        """A required field: the key must be there and its value must be of the type."""
        f = self.field(key, f)
        self.columns[name] = cast(f)
        missing = self.mark(f.isNull())
        self.fails(f"missing:{key}", missing)
        ok = {to_double: is_double, to_long: is_long}.get(cast)  # told without the value, which then isn't read unless it is wanted
        self.fails(f"cast:{key}:{what}", ~missing & (F.col(name).isNull() if ok is None else ~self.mark(ok(f))))

    def given(self, name: str, key: str) -> None:
        """The key must be there; its value may be null here."""
        f = self.field(key)
        self.columns[name] = loose_string(f)
        self.fails(f"missing:{key}", self.mark(f.isNull()))
        self.nulls[name] = self.mark(~is_scalar(kind(f)))

    def maybe(self, name: str, key: str, cast: Callable[[Read], Column] = loose_string) -> None:
        self.columns[name] = cast(self.field(key))

    def nullable_double(self, name: str, key: str, empty_is_null: bool = False) -> None:
        """Null stays null; any other value must be a number. empty_is_null: 0, "" and false are null too."""
        f = self.field(key)
        none = is_null(f)
        value = to_double(f)
        if empty_is_null:
            none = none | F.coalesce(strict_string(f) == "", F.lit(False))
            value = F.when((value != 0) | (kind(f) == "STRING"), value)
            none = none | F.coalesce((kind(f) != "STRING") & (to_double(f) == 0), F.lit(False))
        self.columns[name] = F.when(~none, value)
        empty = is_null(f) | (F.coalesce(strict_string(f) == "", F.lit(False)) if empty_is_null else F.lit(False))
        self.fails(f"cast:{key}:double", self.mark(~empty & ~is_double(f)))

    def tags(self, name: str, key: str) -> None:
        """A list of strings; missing, null and empty values are the empty list."""
        self.columns[name] = F.coalesce(F.try_variant_get(self.field(key).v, "$", "array<string>"), F.array().cast("array<string>"))


def _iso(f: Read) -> Column:
    return iso_timestamp(strict_string(f))


def _compact(f: Read) -> Column:
    return compact_timestamp(strict_string(f))


def _trades(r: _Reader) -> None:
    r.given("msg_type", "T")
    r.given("symbol", "S")
    r.typed("trade_id", "i", to_long, "long")
    r.given("exchange", "x")
    r.typed("price", "p", to_double, "double")
    r.typed("size", "s", to_long, "long")
    r.tags("conditions", "c")
    r.maybe("tape", "z")
    r.typed("exchange_ts", "t", _iso, "timestamp")
    r.nullable_double("ingest_timestamp", "ingest_timestamp", empty_is_null=True)
    r.maybe("freshness_seconds", "freshness_seconds", to_double)


def _quotes(r: _Reader) -> None:
    r.given("msg_type", "T")
    r.given("symbol", "S")
    r.given("bid_exchange", "bx")
    r.typed("bid_price", "bp", to_double, "double")
    r.typed("bid_size", "bs", to_long, "long")
    r.given("ask_exchange", "ax")
    r.typed("ask_price", "ap", to_double, "double")
    r.typed("ask_size", "as", to_long, "long", ask_size(r.steps))
    r.tags("conditions", "c")
    r.maybe("tape", "z")
    r.typed("exchange_ts", "t", _iso, "timestamp")
    r.nullable_double("ingest_timestamp", "ingest_timestamp", empty_is_null=True)
    r.maybe("freshness_seconds", "freshness_seconds", to_double)


def _crypto(r: _Reader) -> None:
    r.given("type", "type")
    r.typed("trade_id", "trade_id", to_long, "long")
    r.typed("sequence", "sequence", to_long, "long")
    r.given("product_id", "product_id")
    r.typed("price", "price", to_double, "double")
    r.typed("size", "size", to_double, "double")
    r.given("side", "side")
    r.typed("time", "time", _iso, "timestamp")
    r.maybe("maker_order_id", "maker_order_id")
    r.maybe("taker_order_id", "taker_order_id")
    r.typed("ingest_timestamp", "ingest_timestamp", to_double, "double")
    r.maybe("freshness_seconds", "freshness_seconds", to_double)


def _news(r: _Reader) -> None:
    for name in ("title", "url", "summary", "source", "category_within_source", "overall_sentiment_label"):
        r.maybe(name, name)
    r.typed("time_published", "time_published", _compact, "timestamp")
    r.nullable_double("overall_sentiment_score", "overall_sentiment_score")
    f = r.field("topics")
    items = F.coalesce(F.when(kind(f).startswith("ARRAY"), F.try_variant_get(f.v, "$", "array<variant>")), F.array().cast("array<variant>"))
    score = lambda x: F.when(field(x, "relevance_score").isNull(), 0.0).otherwise(to_double(field(x, "relevance_score")))
    name = lambda x: F.when(field(x, "topic").isNull(), "").otherwise(loose_string(field(x, "topic")))
    # an element that is no object becomes a null element, which the conditions tell from a null score
    r.columns["topics"] = F.transform(items, lambda x: F.when(kind(x).startswith("OBJECT"), F.struct(name(x).alias("topic"), score(x).alias("relevance_score"))))
    empty = is_null(f) | F.coalesce(strict_string(f) == "", F.lit(False)) | F.coalesce((kind(f) != "STRING") & (to_double(f) == 0), F.lit(False))
    r.fails("cast:topics:array", r.mark(~empty & ~kind(f).startswith("ARRAY") & (kind(f) != "OBJECT<>")))
    r.fails("cast:topics:object", F.exists("topics", lambda x: x.isNull()))
    r.fails("cast:topics:double", F.exists("topics", lambda x: x.isNotNull() & x["relevance_score"].isNull()))


READERS = {"trades": _trades, "quotes": _quotes, "crypto": _crypto, "news": _news}


def _derived(stream: str, df: DataFrame, now: Column) -> DataFrame:
    c = F.col
    if stream in ("trades", "crypto"):
        df = df.withColumn("trade_value", derive.trade_value(c("price"), c("size")))
        df = df.withColumn("is_large_trade", derive.is_large_trade(c("trade_value")))
        df = df.withColumn("latency_ms", derive.latency_ms(c("ingest_timestamp"), c("exchange_ts" if stream == "trades" else "time"), stream == "trades"))
    if stream == "quotes":
        df = df.withColumn("spread", derive.spread(c("ask_price"), c("bid_price")))
    return df if stream == "news" else df.withColumn("pipeline_ingest_time", now)


def normalise(df: DataFrame, stream: str, now: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """Parsed messages (v, raw, codes) to the columns of the stream's table, besides raw, codes and the carried ones.

    Codes: missing:<key>, cast:<key>:<type>, type:object, and null:<column> for what the table requires. Rows without
    codes are the main lane. `now` is the pipeline's ingest time, one for each micro-batch by default.
    """
    reader = _Reader(F.col("v"))
    READERS[stream](reader)
    table = schemas.TABLES[stream]
    carry = carry or []
    out = reader.steps.applied(df.select(*carry, "raw", "codes", "v"), "__object")
    out = out.select(*carry, "raw", "codes", apart(F.col("__object")).alias("__object"), *(x.alias(n) for n, x in (reader.marks | reader.columns).items()))
    found = codes_of(*reader.errors)
    codes = F.when(F.size("codes") > 0, F.col("codes")).when(~F.col("__object"), F.array(F.lit("type:object"))).otherwise(found)
    # a required field that is there and of its type can only be null where any scalar will do, and what is derived of them isn't null
    nulls = F.concat_ws(";", *(F.when(reader.nulls[f.name], F.lit(f"null:{f.name}")) for f in table.fields if not f.nullable and f.name in reader.nulls))
    out = out.select(*carry, "raw", codes.alias("codes"), nulls.alias("__nulls"), *reader.columns)
    out = _derived(stream, out, F.current_timestamp() if now is None else now)
    if any(not f.nullable for f in table.fields):
        out = out.withColumn("codes", F.when((F.size("codes") > 0) | (F.length("__nulls") == 0), F.col("codes")).otherwise(F.split("__nulls", ";")))
    return out.select(*carry, *(F.col(f.name).cast(f.dataType).alias(f.name) for f in table.fields), "raw", "codes")


def main_lane(df: DataFrame) -> DataFrame:
    return df.filter(F.size("codes") == 0).drop("raw", "codes")
