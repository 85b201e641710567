"""Data contracts as lists of (code, column that is true for valid values)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.cast import Read, Steps, apart, codes_of, compact_timestamp, contract_double, contract_long, cut_nanoseconds, is_null, iso_timestamp, kind, moment, once, strict_string

# Patterns and labels of the contracts.
SYMBOL = r"^[.-]*\p{L}[\p{L}.-]*$"
PRODUCT = r"^[A-Z]+-[A-Z]+$"
MATCH_TYPES = ("match", "last_match")
SIDES = ("buy", "sell")
SENTIMENTS = ("Bearish", "Somewhat-Bearish", "Neutral", "Somewhat_Bullish", "Bullish")

Rule = tuple[str, Column]


class Fields:
    """The fields of a message that rules look into; they are read in projections before the rules'."""

    def __init__(self, v: Column):
        self.read, self.steps = {}, Steps("__c", v)

    def __getitem__(self, key: str) -> Read:
        if key not in self.read:
            self.read[key] = Read(self.steps, ask_size(self.steps) if key == "as" else self.steps.key(key))
        return self.read[key]


def _text(f: Read) -> Column:
    return kind(f) == "STRING"


def _optional(f: Read, good: Column) -> Column:
    return is_null(f) | good


def _tags(f: Read) -> Column:
    items = F.try_variant_get(f.v, "$", "array<variant>")
    return _optional(f, kind(f).startswith("ARRAY") & F.forall(items, lambda x: F.coalesce(kind(x) == "STRING", F.lit(False))))


def _positive(x: Column) -> Column:
    return (x > 0) & ~F.isnan(x)


def _at_least_zero(x: Column) -> Column:
    return (x >= 0) & ~F.isnan(x)


def _equity(f: Fields, letter: str, compat: bool) -> list[Rule]:
    symbol, at = strict_string(f["S"]), iso_timestamp(cut_nanoseconds(strict_string(f["t"]), compat)) if compat else moment(f["t"])
    return [
        ("T", strict_string(f["T"]) == letter),
        ("S", symbol.rlike(SYMBOL)),
        ("t", at.isNotNull()),
        ("c", _tags(f["c"])),
        ("z", _optional(f["z"], _text(f["z"]))),
        ("ingest_timestamp", _optional(f["ingest_timestamp"], contract_double(f["ingest_timestamp"]).isNotNull())),
        ("freshness_seconds", _optional(f["freshness_seconds"], contract_double(f["freshness_seconds"]).isNotNull())),
    ]


def trade_rules(f: Fields, compat: bool = False) -> list[Rule]:
    return _equity(f, "t", compat) + [("i", contract_long(f["i"]) >= 0), ("x", _text(f["x"])), ("p", _positive(contract_double(f["p"]))), ("s", contract_long(f["s"]) > 0)]


def ask_size(steps: Steps) -> Column:
    """The ask size; its key is a reserved word in many languages, so a second spelling is taken too."""
    return F.coalesce(steps.key("as"), steps.key("as_"))


def quote_rules(f: Fields, compat: bool = False) -> list[Rule]:
    return _equity(f, "q", compat) + [
        ("bx", _text(f["bx"])), ("ax", _text(f["ax"])),
        ("bp", _at_least_zero(contract_double(f["bp"]))), ("ap", _at_least_zero(contract_double(f["ap"]))),
        ("bs", contract_long(f["bs"]) >= 0), ("as", contract_long(f["as"]) >= 0),
        ("spread", _optional(f["spread"], contract_double(f["spread"]).isNotNull())),
    ]


def crypto_rules(f: Fields, compat: bool = False) -> list[Rule]:

    def amount(key: str) -> Column:
        d = contract_double(f[key])
        return _text(f[key]) & d.isNotNull() & ~(F.coalesce(d <= 0, F.lit(False)))  # NaN passes

    return [
        ("type", strict_string(f["type"]).isin(*MATCH_TYPES)),
        ("trade_id", contract_long(f["trade_id"]) > 0),
        ("sequence", contract_long(f["sequence"]) >= 0),
        ("product_id", strict_string(f["product_id"]).rlike(PRODUCT)),
        ("price", amount("price")),
        ("size", amount("size")),
        ("side", strict_string(f["side"]).isin(*SIDES)),
        ("time", iso_timestamp(strict_string(f["time"])).isNotNull()),
        ("maker_order_id", _optional(f["maker_order_id"], _text(f["maker_order_id"]))),
        ("taker_order_id", _optional(f["taker_order_id"], _text(f["taker_order_id"]))),
        ("ingest_timestamp", _optional(f["ingest_timestamp"], contract_double(f["ingest_timestamp"]).isNotNull())),
        ("freshness_seconds", _optional(f["freshness_seconds"], contract_double(f["freshness_seconds"]).isNotNull())),
    ]


def news_rules(f: Fields, compat: bool = False) -> list[Rule]:
    some = lambda key: F.length(strict_string(f[key])) >= 1
    label = strict_string(f["overall_sentiment_label"])
    return [
        ("title", some("title")),
        ("url", strict_string(f["url"]).startswith("http")),
        ("time_published", compact_timestamp(strict_string(f["time_published"])).isNotNull()),
        ("summary", some("summary")),
        ("source", some("source")),
        ("category_within_source", _optional(f["category_within_source"], _text(f["category_within_source"]))),
        ("overall_sentiment_score", _optional(f["overall_sentiment_score"], contract_double(f["overall_sentiment_score"]).isNotNull())),
        ("overall_sentiment_label", _optional(f["overall_sentiment_label"], label.isin(*SENTIMENTS))),
    ]


RULES: dict[str, Callable[..., list[Rule]]] = {"trades": trade_rules, "quotes": quote_rules, "crypto": crypto_rules, "news": news_rules}


def violations(rules: list[Rule]) -> Column:
    """The codes of all rules that a message breaks; a rule that can't be decided is broken."""
    return codes_of(*((f"contract:{code}", ~F.coalesce(ok, F.lit(False))) for code, ok in rules))


def check(df: DataFrame, stream: str, compat: bool = False, also: Callable[[Fields], dict[str, Column]] | None = None) -> DataFrame:
    """Parsed messages with codes and status: invalid, valid, or, for crypto messages of other types, ignored.

    Messages that are no object are invalid, with the code contract:object. also: columns to add, made of the fields as they were read for
    the rules.
    """
    f = Fields(F.col("v"))
    rules, what = RULES[stream](f, compat), f["type"] if stream == "crypto" else None
    more = also(f) if also else {}
    wide = f.steps.applied(df, "__object")
    none = F.array().cast("array<string>")
    other = F.lit(False) if what is None else F.col("__object") & ~F.coalesce(strict_string(what).isin(*MATCH_TYPES), F.lit(False))
    broken = F.when(F.size("codes") > 0, F.col("codes")).when(~F.col("__object"), F.array(F.lit("contract:object"))).otherwise(violations(rules))
    wide = wide.select(*df.columns, *(c.alias(n) for n, c in more.items()), apart(broken).alias("__broken"), other.alias("__other"))
    codes = F.when(F.col("__other"), none).otherwise(F.col("__broken"))
    status = F.when(F.col("__other"), "ignored").when(F.size("__broken") > 0, "invalid").otherwise("valid")
    rest = [c for c in df.columns if c != "codes"]
    return wide.select(*rest, codes.alias("codes"), once(status).alias("status"), *more)


def sentiment_of(score: Column) -> Column:
    """The label of a score on the feed's documented scale (an addition: the feed sends its own labels)."""
    return F.when(score <= -0.35, "Bearish").when(score <= -0.15, "Somewhat-Bearish").when(score < 0.15, "Neutral").when(score < 0.35, "Somewhat_Bullish").when(score >= 0.35, "Bullish")
