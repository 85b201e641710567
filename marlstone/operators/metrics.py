"""Quality metrics over a status table, one row for each message received (schemas.STATUS)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.config import SETTINGS

# Lengths of the windows in seconds, and samples that a mean takes.
THROUGHPUT_SECONDS = SETTINGS.throughput_seconds
RESET_SECONDS = SETTINGS.reset_seconds
SAMPLES = 1000
DEAD_LETTERS_SHOWN = 500


def received(status: DataFrame) -> DataFrame:
    """Equity messages that the router ignores are not received; crypto ones are."""
    return status.filter((F.col("stream") == "crypto") | (F.col("status") != "ignored"))


def _n(what: str) -> Column:
    return F.count_if(F.col("status") == what)


def _rate(part: Column, none: float) -> Column:
    return F.coalesce(F.round(part / F.nullif(F.count(F.lit(1)), F.lit(0)), 6), F.lit(none))


def counters(prefix: str = "window") -> list[Column]:
    return [F.count(F.lit(1)).alias(f"{prefix}_received"), _n("valid").alias(f"{prefix}_valid"), _n("invalid").alias(f"{prefix}_invalid"), _n("duplicate").alias(f"{prefix}_duplicates"), _n("invalid").alias(f"{prefix}_dlq")]


def rates() -> list[Column]:
    return [_rate(_n("valid"), 1.0).alias("schema_compliance_rate"), _rate(_n("duplicate"), 0.0).alias("duplicate_rate"), _rate(_n("invalid"), 0.0).alias("dlq_rate")]


def hour(start_seconds: int = 0) -> Column:
    """The tumbling window of a row, counted from `start_seconds` past the hour, where the collector started."""
    return F.window("arrival_ts", f"{RESET_SECONDS} seconds", startTime=f"{start_seconds} seconds")["start"]


def hourly_quality(status: DataFrame, start_seconds: int = 0) -> DataFrame:
    """Counters and rates of each stream and window. Partial sums are combined in the tasks."""
    return received(status).groupBy("stream", hour(start_seconds).alias("window_start")).agg(*counters(), *rates())


def last_samples_mean(status: DataFrame, column: str, which: str, digits: int, samples: int = SAMPLES, start_seconds: int = 0, out: str | None = None) -> DataFrame:
    """The mean of the last `samples` values of a window, of rows of one status, latest arrivals last.

    Spark limits each window's rows in the tasks before the shuffle, for only ranks up to `samples` are asked for.
    """
    some = status.filter((F.col("status") == which) & F.col(column).isNotNull()).withColumn("window_start", hour(start_seconds))
    rank = F.row_number().over(Window.partitionBy("stream", "window_start").orderBy(F.col("arrival_seq").desc()))
    return some.withColumn("__rank", rank).filter(F.col("__rank") <= samples).groupBy("stream", "window_start").agg(F.round(F.avg(column), digits).alias(out or f"{column}_mean"), F.count(F.lit(1)).alias("samples"))


def freshness_mean(status: DataFrame, **options) -> DataFrame:
    return last_samples_mean(status, "freshness_seconds", "valid", 4, out="freshness_at_ingestion_seconds_mean", **options)


def detection_mean(status: DataFrame, **options) -> DataFrame:
    return last_samples_mean(status, "detection_ms", "invalid", 4, out="contract_violation_detection_time_ms", **options)


def spread_mean(status: DataFrame, **options) -> DataFrame:
    return last_samples_mean(status, "spread", "valid", 6, out="mean_bid_ask_spread", **options)


def lifetime_totals(status: DataFrame, start_seconds: int = 0) -> DataFrame:
    """Counters from the start to the end of each window; the running sums see one row for each window."""
    per = received(status).groupBy("stream", hour(start_seconds).alias("window_start")).agg(*counters("n"))
    so_far = Window.partitionBy("stream").orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    names = ("received", "valid", "invalid", "duplicates", "dlq")
    return per.select("stream", "window_start", *(F.sum(f"n_{n}").over(so_far).alias(f"total_{n}") for n in names))


def throughput_now(status: DataFrame, now: Column, seconds: int = THROUGHPUT_SECONDS) -> DataFrame:
    """Valid messages a second in the `seconds` up to now, for each stream that ever received one."""
    at, end = F.unix_micros("arrival_ts"), F.unix_micros(now)
    recent = (F.col("status") == "valid") & (at >= end - seconds * 1_000_000) & (at <= end)
    return received(status).groupBy("stream").agg(F.round(F.count_if(recent) / seconds, 4).alias("throughput_msgs_per_sec"))


def rolling_throughput(df: DataFrame, ts: str, by: list[str], seconds: int = THROUGHPUT_SECONDS, out: str = "throughput_msgs_per_sec") -> DataFrame:
    """At each row, rows a second in the `seconds` up to and with it.

    Time is cut into slices of that length. Each row is counted in its slice and lent to the next, so every frame
    lies in one slice, slices are worked on apart, and no stream meets in one task.
    """
    us, span = F.unix_micros(F.col(ts).cast("timestamp")), seconds * 1_000_000
    wide = df.withColumn("__us", us).withColumn("__own", F.floor(F.col("__us") / span))
    wide = wide.withColumn("__slice", F.explode(F.array(F.col("__own"), F.col("__own") + 1)))
    frame = Window.partitionBy(*by, "__slice").orderBy("__us").rangeBetween(-span, 0)
    counted = wide.withColumn(out, F.round(F.count(F.lit(1)).over(frame) / seconds, 4))
    return counted.filter(F.col("__slice") == F.col("__own")).drop("__us", "__own", "__slice")


def sliding_throughput(events: DataFrame, ts: str = "arrival_ts", seconds: int = THROUGHPUT_SECONDS, every: str = "1 second") -> DataFrame:
    """The same over sliding windows, for streams; give events a watermark first."""
    return events.groupBy("stream", F.window(ts, f"{seconds} seconds", every).alias("window")).agg(F.round(F.count(F.lit(1)) / seconds, 4).alias("throughput_msgs_per_sec"))


def sessions(df: DataFrame, ts: str, by: list[str], seconds: int) -> DataFrame:
    """Sessions that end after `seconds` without a row: their start, end and rows."""
    w = F.session_window(F.col(ts).cast("timestamp"), f"{seconds} seconds")
    return df.groupBy(*by, w.alias("session")).agg(F.count(F.lit(1)).alias("n")).select(*by, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), "n")


def recent_dead_letters(dlq: DataFrame, order: str, count: int = DEAD_LETTERS_SHOWN) -> DataFrame:
    return dlq.orderBy(F.col(order).desc()).limit(count)


def snapshot(status: DataFrame, now: Column, start_seconds: int = 0, seconds: int = THROUGHPUT_SECONDS) -> DataFrame:
    """One row for each stream: rates and counters of the window that `now` lies in, means and lifetime totals.

    Counters, rates and throughput come from one aggregation; the samples of the three means are ranked in one pass.
    """
    current = F.window("__now", f"{RESET_SECONDS} seconds", startTime=f"{start_seconds} seconds")["start"]
    came = received(status).withColumn("__now", now).withColumn("__start", current).withColumn("__own", hour(start_seconds)).withColumn("__here", F.col("__own") == F.col("__start"))
    here, state, at = F.col("__here"), F.col("status"), F.unix_micros("arrival_ts")
    recent = (state == "valid") & (at >= F.unix_micros("__now") - seconds * 1_000_000) & (at <= F.unix_micros("__now"))
    kinds = {"valid": "valid", "invalid": "invalid", "duplicates": "duplicate", "dlq": "invalid"}
    n = F.col("window_received")
    out = came.groupBy("stream").agg(
        *counters("total"), F.round(F.count_if(recent) / seconds, 4).alias("throughput_msgs_per_sec"),
        F.count_if(here).alias("window_received"), *(F.count_if(here & (state == k)).alias(f"window_{name}") for name, k in kinds.items()),
    )
    rate = lambda part, none: F.coalesce(F.round(F.col(part) / F.nullif(n, F.lit(0)), 6), F.lit(none))
    out = out.withColumns({"schema_compliance_rate": rate("window_valid", 1.0), "duplicate_rate": rate("window_duplicates", 0.0), "dlq_rate": rate("window_dlq", 0.0)})
    means = (("freshness_at_ingestion_seconds_mean", "freshness_seconds", "valid", 4), ("contract_violation_detection_time_ms", "detection_ms", "invalid", 4), ("mean_bid_ask_spread", "spread", "valid", 6))
    samples = F.array(*(F.struct(F.lit(name).alias("mean"), F.when(state == which, F.col(column)).alias("x")) for name, column, which, _ in means))
    each = came.filter(here).select("stream", "arrival_seq", F.explode(F.filter(samples, lambda s: s["x"].isNotNull())).alias("s")).select("stream", "arrival_seq", "s.mean", "s.x")
    rank = F.row_number().over(Window.partitionBy("stream", "mean").orderBy(F.col("arrival_seq").desc()))
    last = each.withColumn("__rank", rank).filter(F.col("__rank") <= SAMPLES)
    found = last.groupBy("stream").agg(*(F.round(F.avg(F.when(F.col("mean") == name, F.col("x"))), digits).alias(name) for name, _, _, digits in means))
    return out.join(found, "stream", "left").fillna({name: 0.0 for name, *_ in means})


#: What a run without articles comes to.
NO_ARTICLES = {n: 0 for n in ("articles_fetched", "articles_valid", "articles_invalid", "articles_published", "articles_dlq")}
NO_ARTICLES |= {"schema_compliance_rate": 1.0, "dlq_rate": 0.0, "freshness_seconds_mean": 0.0, "violation_detection_ms_mean": 0.0}


def run_metrics(articles: DataFrame, run: str = "run_id") -> DataFrame:
    """Metrics of each news run, from its articles with status, freshness_seconds and detection_ms.

    articles_published counts messages: one for a run with a valid article, none otherwise.
    """
    valid, n = F.col("status") == "valid", F.count(F.lit(1))
    return articles.groupBy(run).agg(
        n.alias("articles_fetched"), _n("valid").alias("articles_valid"), _n("invalid").alias("articles_invalid"),
        F.when(_n("valid") > 0, 1).otherwise(0).cast("long").alias("articles_published"), _n("invalid").alias("articles_dlq"),
        _rate(_n("valid"), 1.0).alias("schema_compliance_rate"), _rate(_n("invalid"), 0.0).alias("dlq_rate"),
        F.coalesce(F.round(F.avg(F.when(valid, F.col("freshness_seconds"))), 4), F.lit(0.0)).alias("freshness_seconds_mean"),
        F.coalesce(F.round(F.avg(F.when(F.col("status") == "invalid", F.col("detection_ms"))), 4), F.lit(0.0)).alias("violation_detection_ms_mean"),
    )


def sentiment_distribution(articles: DataFrame, label: str = "overall_sentiment_label", by: list[str] | None = None) -> DataFrame:
    """How many valid articles bear each label that isn't empty."""
    some = articles.filter((F.col("status") == "valid") & (F.length(label) > 0)) if "status" in articles.columns else articles.filter(F.length(label) > 0)
    return some.groupBy(*(by or []), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
