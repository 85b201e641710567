"""A topic as a sink, for batches and streams: rows are sent by the executors, each at least once.

The option transport names a function `module:name` that gets the options and gives an object with send(list of bytes), which
returns when the broker has taken them and raises otherwise, and close(). Each task sends its rows in lots and tries a lot
again, waiting longer each time; what a task has sent goes to the driver as its commit message. A lot that was taken though its
answer was lost, or a task that runs again, sends messages twice, never not at all.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from marlstone.sources.feeds import _transport

FORMAT = "marlstone_topic"
#: Messages of a lot, attempts for each, seconds before the second one.
LOT, ATTEMPTS, WAIT = 100, 5, 0.5


@dataclass
class Sent(WriterCommitMessage):
    partition: int
    messages: int
    again: int


class _Writer:
    def __init__(self, options: dict):
        self.options = dict(options)

    def write(self, rows: Iterator) -> Sent:
        o = self.options
        lot, attempts, wait = int(o.get("lot", LOT)), int(o.get("attempts", ATTEMPTS)), float(o.get("wait", WAIT))
        connection = _transport(o, "")(o)
        n = again = 0
        try:
            held: list[bytes] = []
            for row in rows:
                held.append(bytes(row[0]) if row[0] is not None else b"")
                if len(held) == lot:
                    again += self._send(connection, held, attempts, wait)
                    n, held = n + len(held), []
            if held:
                again += self._send(connection, held, attempts, wait)
                n += len(held)
        finally:
            connection.close()
        return Sent(TaskContext.get().partitionId(), n, again)

    @staticmethod
    def _send(connection, lot: list[bytes], attempts: int, wait: float) -> int:
        """How many attempts failed before the lot was taken."""
        for k in range(attempts):
            try:
                connection.send(lot)
                return k
            except Exception:
                if k == attempts - 1:
                    raise
                time.sleep(wait * 2**k)
        return attempts


class _BatchWriter(_Writer, DataSourceWriter):
    def commit(self, messages: list) -> None:
        pass

    def abort(self, messages: list) -> None:
        pass


class _StreamWriter(_Writer, DataSourceStreamWriter):
    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
        pass

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        pass


class Topic(DataSource):
    """Format FORMAT, a sink of messages in the first column, value. Options: transport, lot, attempts, wait, and the transport's own."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _BatchWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:  # noqa: N802
        return _StreamWriter(self.options)


def publish(messages: DataFrame, transport: str, checkpoint: str | None = None, trigger: dict | None = None, **options: str) -> StreamingQuery | None:
    """Send messages (value: bytes) to a topic, from a batch or a stream."""
    spark: SparkSession = messages.sparkSession
    spark.dataSource.register(Topic)
    value = messages.select("value")
    if not messages.isStreaming:
        value.write.format(FORMAT).options(transport=transport, **options).mode("append").save()
        return None
    return value.writeStream.format(FORMAT).options(transport=transport, **options).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
