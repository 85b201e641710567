"""Sinks: tables that grow by whole micro-batches, with their dead letters beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from marlstone.operators import derive, normalise, parse, schemas
from marlstone.plans import pipelines
from marlstone.streaming import stateful
from marlstone.streaming.tables import BatchTable, query_id

_EMPTY = "spark.sql.streaming.noDataMicroBatches.enabled"
_COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def append(df: DataFrame, path: str, columns: dict[str, str] | None = None) -> None:
    """Append rows to a table of files, made if it isn't there; columns renames them (feed names need caseSensitive)."""
    out = df.withColumnsRenamed(columns) if columns else df
    out.write.mode("append").parquet(path)


def write_lanes(rows: DataFrame, query: str, batch: int, main: str, dlq: str | None, finish: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Split typed rows (codes, raw) into a table and its dead letters; each takes a query's batch once, however often it is
    written, and keeps those of all other queries."""
    spark = rows.sparkSession
    lanes = [(BatchTable(spark, main), lambda: finish(normalise.main_lane(rows)))]
    if dlq:
        lanes.append((BatchTable(spark, dlq), lambda: parse.dead_letters(rows, "normalise")))
    open_ = [(table, lane) for table, lane in lanes if not table.committed(query, batch)]
    if len(open_) > 1:
        rows.persist()
    try:
        for table, lane in open_:
            table.commit(lane(), query, batch)
    finally:
        rows.unpersist()


def run_pipeline(messages: DataFrame, stream: str, main: str, checkpoint: str, dlq: str | None, trigger: dict | None = None, value: str = "value", dedup_by: str | None = pipelines.INGEST, seconds: int = derive.NEWS_HORIZON_SECONDS) -> StreamingQuery:
    """Start a pipeline over a streaming DataFrame of messages; dead letters are on unless dlq is None.

    The trigger is availableNow by default: what is there is worked off in bounded batches, then the query ends.
    News repeats within `seconds` of the last accepted one are suppressed, by ingest time or a time column of the table;
    dedup_by=None lets all of them pass. Tables grow by whole batches (tables.BatchTable), whatever queries write into them.
    """
    table = schemas.TABLES[stream]
    typed = pipelines.typed(messages, stream, value=value)
    if stream == "news" and dedup_by:
        typed = _first_news(typed, dedup_by, seconds)

    def both(df: DataFrame, batch: int) -> None:
        write_lanes(df, query_id(df.sparkSession, checkpoint), batch, main, dlq, lambda rows: rows.select(*(F.col(f.name) for f in table.fields)))

    return started(typed.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})), typed.sparkSession)


def started(writer: DataStreamWriter, spark: SparkSession, empty_batches: bool = False, count_state: bool = True) -> StreamingQuery:
    """Start a query with the settings that stateful ones need. A query copies its session's settings as it starts, so the
    session's own are as before afterwards. empty_batches: let it run batches without rows, in which event-time timers
    come due; a state that expires by the clock would ask for them without end. count_state=False: progress reports don't tell
    how many rows the state holds, and writing or removing one doesn't look it up first."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": stateful.ROCKSDB, _EMPTY: str(empty_batches).lower()} | ({} if count_state else {_COUNTED: "false"})
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _first_news(typed: DataFrame, dedup_by: str, seconds: int) -> DataFrame:
    """Typed news without the repeats of their main lane; dead letters pass by.

    By ingest time the state of a key goes when its horizon is over.
    """
    main = normalise.main_lane(typed).withColumns({"__at": F.current_timestamp() if dedup_by == pipelines.INGEST else F.col(dedup_by), "__order": F.concat_ws("|", "title", "summary", "source")})
    main = stateful.accept_by_horizon(main, "dedup_key", "__at", seconds, "__order", seconds if dedup_by == pipelines.INGEST else None).drop("__at", "__order")
    lanes = {n: typed.schema[n].dataType for n in ("raw", "codes")}
    main = main.withColumns({"raw": F.lit(None).cast(lanes["raw"]), "codes": F.array().cast(lanes["codes"])})
    return main.unionByName(typed.filter(F.size("codes") > 0))


def publish(messages: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery | None:
    """Messages (value) as text lines, from a batch or a stream; each is published at least once."""
    lines = messages.select(F.col("value").cast("string").alias("value"))
    if not messages.isStreaming:
        lines.write.mode("append").text(path)
        return None
    return lines.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
