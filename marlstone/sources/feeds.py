"""Feeds over web sockets and HTTP as Spark data sources.

How bytes are fetched is a transport, named as module:function in the option "transport", so feeds can be played from
anywhere. Keys and secrets come only from options; nothing has a default.
"""

from __future__ import annotations

import base64
import importlib
import json
import queue
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from marlstone.config import SETTINGS

# What the feeds offer and how they are asked; fixed values but for the settings.
SYMBOLS = ["AAPL", "MSFT", "NVDA", "AMZN", "GOOGL", "META", "TSLA", "BRK.B", "AVGO", "JPM", "LLY", "UNH", "V", "XOM", "MA"]
PRODUCTS = ["BTC-USD", "ETH-USD", "SOL-USD", "ADA-USD", "XRP-USD", "DOGE-USD", "AVAX-USD", "LINK-USD", "DOT-USD", "LTC-USD"]
LOOKBACK_MINUTES = SETTINGS.lookback_minutes
HTTP_TIMEOUT_SECONDS = 30
PING_SECONDS, PONG_SECONDS = 20, 10
RECONNECT_SECONDS = SETTINGS.reconnect_seconds


def equity_greetings(key: str, secret: str, symbols: list[str]) -> list[dict]:
    """What is sent after the welcome: who we are, then what we want."""
    return [{"action": "auth", "key": key, "secret": secret}, {"action": "subscribe", "trades": symbols, "quotes": symbols}]


def crypto_greetings(products: list[str]) -> list[dict]:
    return [{"type": "subscribe", "product_ids": products, "channels": ["matches"]}]


def news_url(base: str, key: str, now: datetime, minutes: int = LOOKBACK_MINUTES) -> str:
    since = (now.astimezone(timezone.utc) - timedelta(minutes=minutes)).strftime("%Y%m%dT%H%M")
    return f"{base}?{urllib.parse.urlencode({'function': 'NEWS_SENTIMENT', 'time_from': since, 'apikey': key})}"


def articles(body: bytes) -> list[dict]:
    """The articles of a reply; none if it isn't JSON or has no feed."""
    try:
        said = json.loads(body)
    except ValueError:
        return []
    feed = said.get("feed") if isinstance(said, dict) else None
    return feed if isinstance(feed, list) else []


def http_get(options: dict) -> Iterator[bytes]:
    """The transport of news polls: one reply, or none on any error."""
    url = news_url(options["url"], options["key"], datetime.now(timezone.utc), int(options.get("minutes", LOOKBACK_MINUTES)))
    try:
        with urllib.request.urlopen(url, timeout=HTTP_TIMEOUT_SECONDS) as reply:
            yield reply.read()
    except (urllib.error.URLError, OSError):
        return


def web_socket(options: dict) -> Iterator[bytes]:
    """The transport of web sockets: yields frames as long as it is asked for more, over one connection while that lasts.

    `welcome` frames are awaited first; then each greeting is sent and its reply awaited. A lost connection is opened
    anew after a pause; it needs the websockets package.
    """
    try:
        from websockets.exceptions import WebSocketException
        from websockets.sync.client import connect
    except ImportError as e:
        raise RuntimeError("web sockets need the websockets package on the driver") from e
    while True:
        try:
            with connect(options["url"], ping_interval=PING_SECONDS, ping_timeout=PONG_SECONDS) as socket:
                greet(socket, json.loads(options["greetings"]), int(options.get("welcome", 0)))
                for frame in socket:
                    yield frame if isinstance(frame, bytes) else frame.encode()
        except (WebSocketException, OSError):
            pass
        time.sleep(RECONNECT_SECONDS)


def greet(socket, greetings: list[dict], welcome: int) -> None:
    """What is said before the frames: each greeting waits for what came before it."""
    for _ in range(welcome):
        socket.recv()
    for g in greetings:
        socket.send(json.dumps(g))
        socket.recv()


def _transport(options: dict, default: str):
    module, _, name = options.get("transport", default).partition(":")
    return getattr(importlib.import_module(module), name)


#: Seconds between polls of the news.
POLL_SECONDS = 300


class FrameLog:
    """Frames that were read, in files of a folder that outlives the reader: one file for each micro-batch's range.

    The folder is a path or a URI of any file system that pyarrow knows, so that a restarted driver finds it again.
    """

    def __init__(self, path: str):
        self.fs, self.path = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)

    def files(self) -> list[tuple[int, int, str]]:
        found = [(f.base_name.removesuffix(".json").split("-"), f.path) for f in self.fs.get_file_info(pafs.FileSelector(self.path, allow_not_found=True)) if f.base_name.endswith(".json")]
        return sorted((int(a), int(b), p) for (a, b), p in found)

    def write(self, start: int, rows: list[tuple]) -> None:
        self.fs.create_dir(self.path, recursive=True)
        place = f"{self.path}/{start:020d}-{start + len(rows):020d}"
        with self.fs.open_output_stream(place + ".part") as out:
            out.write(json.dumps([[base64.b64encode(bytes(m)).decode(), at] for m, at in rows]).encode())
        self.fs.move(place + ".part", place + ".json")

    def read(self, start: int, end: int) -> list[tuple]:
        out = []
        for a, b, path in self.files():
            if a < end and b > start:
                with self.fs.open_input_stream(path) as f:
                    rows = json.loads(f.read())
                out += [(bytearray(base64.b64decode(m)), at) for m, at in rows[max(0, start - a) : end - a]]
        return out

    def forget(self, end: int) -> None:
        for _, b, path in self.files():
            if b <= end:
                self.fs.delete_file(path)


class _FeedReader(SimpleDataSourceStreamReader):
    """Each micro-batch is what the transport has yielded since the last one.

    The transport runs in a thread of its own and keeps its connection from batch to batch; a transport that ends, like
    a poll, is started again with the first batch that begins `every` seconds (option; news: POLL_SECONDS, frames: 0) after it last was. With the option "log", frames are written there before they are
    handed on, and a batch that was planned but not committed when a query died is read from there when it starts again.
    Without it such a batch comes back empty: its frames are lost, and the query goes on.
    """

    def __init__(self, options: dict, default: str, flatten, every: float = 0):
        self.options, self.default, self.flatten, self.every = dict(options), default, flatten, every
        self._open()

    def _open(self) -> None:
        self.log = FrameLog(self.options["log"]) if "log" in self.options else None
        self.frames: queue.Queue = queue.Queue()
        self.thread: threading.Thread | None = None
        self.again = 0.0  # when a transport that has ended may be started anew
        self.failed: BaseException | None = None

    def __getstate__(self) -> tuple:
        """Executors get the reader too, to read what was planned; the connection stays behind."""
        return self.options, self.default, self.flatten, self.every

    def __setstate__(self, state: tuple) -> None:
        self.options, self.default, self.flatten, self.every = state
        self._open()

    def initialOffset(self) -> dict:
        return {"n": 0}

    def _run(self) -> None:
        try:
            for frame in _transport(self.options, self.default)(self.options):
                self.frames.put((frame, time.time()))
        except BaseException as e:  # noqa: BLE001  raised again where the batch is read
            self.failed = e

    def _drain(self) -> Iterator[tuple[bytes, float]]:
        """What has come; waits `seconds` (1) for frames while the transport lives."""
        due = time.monotonic() >= self.again
        if due and (self.thread is None or not self.thread.is_alive()):
            self.again = time.monotonic() + float(self.options.get("every", self.every))
            self.thread = threading.Thread(target=self._run, daemon=True)
            self.thread.start()
        until = time.monotonic() + float(self.options.get("seconds", 1))
        if self.thread is not None:
            self.thread.join(max(0.0, until - time.monotonic()))
        while not self.frames.empty():
            yield self.frames.get()
        if self.failed is not None:
            e, self.failed = self.failed, None
            raise e

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        # planned but never handed to a batch, so in no offset that Spark knows
        rows = self.log.read(start["n"], 1 << 62) if self.log else []
        new = [(m, at) for frame, at in self._drain() for m in self.flatten(frame)]
        if new and self.log:
            self.log.write(start["n"] + len(rows), new)
        rows += new
        return iter(rows), {"n": start["n"] + len(rows)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        rows = self.log.read(start["n"], end["n"]) if self.log else []
        if self.log and len(rows) != end["n"] - start["n"]:
            raise FileNotFoundError(f"of the frames {start['n']} to {end['n']} the log {self.log.path} has {len(rows)}: it must be a folder that driver and executors share, and nobody else may clear it")
        return iter(rows)

    def commit(self, end: dict) -> None:
        if self.log:
            self.log.forget(end["n"])


class FrameFeed(DataSource):
    """Format "marlstone_frames": a row for each frame of a web socket. Options: url, greetings (JSON), welcome, seconds, every, log, transport."""

    @classmethod
    def name(cls) -> str:
        return "marlstone_frames"

    def schema(self) -> str:
        return "value binary, ingest_timestamp double"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _FeedReader(self.options, "marlstone.sources.feeds:web_socket", lambda frame: [bytearray(frame)])


class NewsFeed(DataSource):
    """Format "marlstone_news": a row for each poll that found articles, a JSON array. Options: url, key, minutes, every, log, transport."""

    @classmethod
    def name(cls) -> str:
        return "marlstone_news"

    def schema(self) -> str:
        return "value binary, ingest_timestamp double"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _FeedReader(self.options, "marlstone.sources.feeds:http_get", lambda body: [bytearray(json.dumps(found).encode())] if (found := articles(body)) else [], POLL_SECONDS)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FrameFeed)
    spark.dataSource.register(NewsFeed)
