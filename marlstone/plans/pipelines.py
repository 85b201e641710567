"""The four pipelines and the collectors' stage, for batch and streaming DataFrames alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.cast import Read, compact_timestamp, contract_double, contract_long, epoch_seconds, moment, once, strict_string
from marlstone.operators import contracts, dedup, derive, normalise, parse

STREAMS = ("trades", "quotes", "crypto", "news")
#: In place of a time column: repeats are told by the time at which rows are ingested.
INGEST = "ingest"


def typed(messages: DataFrame, stream: str, now: Column | None = None, carry: list[str] | None = None, value: str = "value") -> DataFrame:
    """Messages to the stream's table columns with raw and codes; both lanes in one DataFrame."""
    parsed = parse.parse_messages(messages, value)
    if stream == "news":
        parsed = parse.explode_batches(parsed)
    out = normalise.normalise(parsed, stream, now, carry)
    return out.withColumn("dedup_key", derive.dedup_key(F.col("url"), F.col("title"))) if stream == "news" else out


def build(messages: DataFrame, stream: str, now: Column | None = None, dedup_by: str | None = None, mode: str = "horizon", seconds: int = derive.NEWS_HORIZON_SECONDS) -> tuple[DataFrame, DataFrame]:
    """(main lane, dead letters) of a batch of messages.

    dedup_by: for news, a time column of the table by which repeats within `seconds` are suppressed, or INGEST, by
    which the whole batch comes in at once; mode "session" lets repeats prolong the suppression. Streams have that step
    in sinks.run_pipeline instead.
    """
    rows = typed(messages, stream, now)
    main, dlq = normalise.main_lane(rows), parse.dead_letters(rows, "normalise")
    if stream == "news":
        if dedup_by:
            accept = {"horizon": dedup.accept_by_horizon, "session": dedup.accept_by_session}[mode]
            if dedup_by == INGEST:
                main, dedup_by = main.withColumn("__at", F.current_timestamp() if now is None else now), "__at"
            main = accept(main, ["dedup_key"], dedup_by, seconds, ["title", "summary", "source"]).filter("accepted").drop("accepted", "__at")
        main = main.drop("dedup_key")
    return main, dlq


def _time(f: contracts.Fields, stream: str) -> Column:
    return compact_timestamp(strict_string(f["time_published"])) if stream == "news" else moment(f["time" if stream == "crypto" else "t"])


def _tags(f: Read) -> Column:
    return F.try_variant_get(f.v, "$", "array<string>")


def _upper(f: Read) -> Column:
    return F.upper(strict_string(f))


#: A validated event's fields in their order, with what makes a value of each; the collector adds the last three itself.
_TEXT, _LONG, _DOUBLE = strict_string, contract_long, contract_double
EVENTS: dict[str, dict[str, Callable[[Read], Column]]] = {
    "trades": {"T": _TEXT, "S": _upper, "i": _LONG, "x": _TEXT, "p": _DOUBLE, "s": _LONG, "t": _TEXT, "c": _tags, "z": _TEXT},
    "quotes": {"T": _TEXT, "S": _upper, "bx": _TEXT, "bp": _DOUBLE, "bs": _LONG, "ax": _TEXT, "ap": _DOUBLE, "as": _LONG, "t": _TEXT, "c": _tags, "z": _TEXT},
    "crypto": {"type": _TEXT, "trade_id": _LONG, "sequence": _LONG, "product_id": _TEXT, "price": _TEXT, "size": _TEXT, "side": _TEXT, "time": _TEXT, "maker_order_id": _TEXT, "taker_order_id": _TEXT},
    "news": {"title": _TEXT, "url": _TEXT, "time_published": _TEXT, "summary": _TEXT, "source": _TEXT, "category_within_source": _TEXT, "overall_sentiment_score": _DOUBLE, "overall_sentiment_label": _TEXT},
}
#: Fields of an event by which a collector knows it again: all together, but crypto's each by itself.
IDENTITIES = {"trades": ["i"], "quotes": ["S", "t"], "crypto": ["trade_id", "sequence"], "news": []}
#: What received() adds to the messages' own columns.
RECEIVED = ("item", "raw", "codes", "status", "event_ts", "symbol", "id", "id2", "spread", "freshness_seconds", "event")


def received(messages: DataFrame, stream: str, arrival: str, value: str = "value") -> DataFrame:
    """Raw messages as a collector receives them, checked, before it asks for duplicates; for batches and streams.

    Arrays are taken apart, item being an element's place; equity messages of another type, and what isn't JSON, vanish
    there. status is ignored, invalid or valid. Valid rows have the time, the identities, the freshness against the
    arrival column and, as JSON text, the event that goes on: its fields as checked, its symbol in upper case, quotes
    with their spread.
    """
    rest = [c for c in messages.columns if c != value]
    parsed = parse.parse_messages(messages, value)
    if stream == "crypto":
        parsed = parsed.withColumn("item", F.lit(0))
    else:
        parsed = parse.explode_batches(parsed, "item")
    if stream in ("trades", "quotes"):
        parsed = parse.route(parsed, "T", stream[0])
    inner = {key: f"__e{k}" for k, key in enumerate(EVENTS[stream])}
    # the fields are read once, for the rules and for what goes on
    checked = contracts.check(parsed, stream, also=lambda f: {"__ts": _time(f, stream), **{inner[key]: cast(f[key]) for key, cast in EVENTS[stream].items()}})
    valid = F.col("status") == "valid"
    kept = [*rest, "item", "raw", "codes", "status"]
    wide = checked.select(*kept, once(F.when(valid, F.col("__ts"))).alias("event_ts"), *inner.values())
    wide = wide.select(*kept, "event_ts", *(F.when(valid & F.col("event_ts").isNotNull(), F.col(c)).alias(c) for c in inner.values()))
    e = {key: F.col(name) for key, name in inner.items()}
    ids = [e[key] for key in IDENTITIES[stream]]
    text = F.lit(None).cast("string")
    first = ids[0].cast("string") if stream in ("trades", "crypto") else F.concat_ws("|", *ids) if ids else text
    spread = derive.spread(e["ap"], e["bp"]) if stream == "quotes" else F.lit(None).cast("double")
    lag = F.when(valid, derive.freshness_seconds(epoch_seconds(F.col(arrival)), F.col("event_ts")))
    symbol = e["product_id"] if stream == "crypto" else e["S"] if "S" in e else text
    wide = wide.select(
        *kept, "event_ts", *inner.values(), symbol.alias("symbol"), F.when(valid, first).alias("id"), (ids[1].cast("string") if stream == "crypto" else text).alias("id2"),
        once(spread).alias("spread"), once(lag).alias("freshness_seconds"),
    )
    body = [c.alias(key) for key, c in e.items()] + [epoch_seconds(F.col(arrival)).alias("ingest_timestamp"), F.col("freshness_seconds")] + ([F.col("spread")] if stream == "quotes" else [])
    event = F.when(valid, F.to_json(F.struct(*body), {"ignoreNullFields": "false"}))
    return wide.select(*rest, *(event.alias(n) if n == "event" else F.col(n) for n in RECEIVED))


def settled(rows: DataFrame, stream: str, repeat: Column) -> DataFrame:
    """Received rows of which valid ones are duplicates where `repeat` says so; those have neither event nor metrics."""
    out = rows.withColumn("status", F.when((F.col("status") == "valid") & repeat, "duplicate").otherwise(F.col("status")))
    mine = F.col("status") == "valid"
    return out.withColumns({c: F.when(mine, F.col(c)) for c in ("freshness_seconds", "spread", "event")}).withColumn("stream", F.lit(stream))


def collect(messages: DataFrame, stream: str, order: list[str], arrival: str, value: str = "value", exact: bool = False, scope: list[str] | None = None, capacity: int = dedup.CAPACITY) -> DataFrame:
    """What a collector makes of raw messages: each received one with status ignored, invalid, duplicate or valid.

    order tells the arrival order of messages; arrival is the column of their ingest time. The messages are parsed and
    checked once, and no row is left behind: invalid rows travel with the valid ones. Duplicates: by default any
    earlier valid message of the same identity; exact takes a memory of the last `capacity` accepted ones, over all
    messages, in parallel, or in one sequence for each scope. Crypto has two identities, so it is always exact, by product unless a
    scope is given; scope=[] takes all products together. News articles have none.
    """
    rows, order, valid = received(messages, stream, arrival, value), [*order, "item"], F.col("status") == "valid"
    if stream == "news":
        return settled(rows, stream, F.lit(False))
    if stream == "crypto" or exact:
        scope = ["symbol"] if scope is None and stream == "crypto" else scope
        ids = ["id", "id2"] if stream == "crypto" else ["id"]
        if scope:
            rows = dedup.accept_by_memory(rows, ids, order, scope, capacity, "__accepted", valid)
        else:
            rows, _ = dedup.bounded_memory(rows, ids, order, capacity, "__accepted", valid)
        return settled(rows, stream, ~F.col("__accepted")).drop("__accepted")
    rows = dedup.mark_repeats(rows, ["id"], order, "__again", where=valid)
    return settled(rows, stream, F.col("__again")).drop("__again")


def valid_events(collected: DataFrame) -> DataFrame:
    """The messages that a collector publishes: one for each valid event."""
    return collected.filter("status = 'valid'").select(F.col("event").cast("binary").alias("value"))


def status_rows(collected: DataFrame, arrival_seq: Column, arrival: str, kind: str = "long") -> DataFrame:
    """Collected rows as the status table that the metrics are computed from; kind: the type of the arrivals' numbers."""
    detection = F.col("detection_ms") if "detection_ms" in collected.columns else F.lit(None).cast("double")
    return collected.select("stream", arrival_seq.cast(kind).alias("arrival_seq"), F.col(arrival).alias("arrival_ts"), "status", "freshness_seconds", "spread", detection.alias("detection_ms"))


def log_lines(collected: DataFrame, key: str | None = None) -> DataFrame:
    """A line of text for people for each collected row: its stream and status, then what is known of it."""
    c = F.col
    known = lambda name, col: F.when(col.isNotNull(), F.concat(F.lit(f"{name}="), col.cast("string")))
    what = [known("symbol", c("symbol")), known("id", c("id")), known("spread", F.format_number("spread", 4)), known("freshness", F.format_number("freshness_seconds", 3)), F.when(F.size("codes") > 0, F.concat(F.lit("errors="), F.concat_ws(",", F.array_sort("codes"))))]
    line = F.concat_ws(" ", F.upper("stream"), F.upper("status"), *what).alias("line")
    return collected.select(*([key] if key else []), "item", line)
