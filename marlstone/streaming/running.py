"""A collector's metrics, kept from batch to batch.

What the metrics need of the past is little: lifetime counters, the counters and last samples of the window that is open, and
the accepted messages of the last seconds. Each batch adds its own to what the batch before has left, in a file that a
rename puts in place, so a replayed batch counts once, and the endpoint reads one small file, however long the history is.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.operators import metrics
from marlstone.streaming.scratch import hadoop
from marlstone.streaming.tables import rename

FOLDER = "metrics"
#: Counter and the status it counts.
KINDS = {"valid": "valid", "invalid": "invalid", "duplicates": "duplicate", "dlq": "invalid"}
#: Mean, its column, the rows' status, digits.
MEANS = (("freshness_at_ingestion_seconds_mean", "freshness_seconds", "valid", 4), ("contract_violation_detection_time_ms", "detection_ms", "invalid", 4), ("mean_bid_ask_spread", "spread", "valid", 6))
#: Files that are kept for each query, for readers that have just begun.
KEPT = 3


@dataclass
class Running:
    """The metrics below a collector's output; rows are its status table's."""

    spark: SparkSession
    out: str
    start_seconds: int = 0
    seconds: int = metrics.THROUGHPUT_SECONDS

    def _files(self, query: str | None = None) -> dict[str, list[tuple[int, str]]]:
        """(batch, path) by query, in order."""
        fs, p = hadoop(self.spark, f"{self.out}/{FOLDER}")
        found: dict[str, list[tuple[int, str]]] = {}
        for s in fs.listStatus(p) if fs.exists(p) else []:
            name = s.getPath().getName()
            if name.endswith(".json") and not name.startswith((".", "_")):
                of, _, batch = name[:-5].rpartition(".")
                if query in (None, of):
                    found.setdefault(of, []).append((int(batch), s.getPath().toString()))
        return {of: sorted(files) for of, files in found.items()}

    def _load(self, path: str) -> dict:
        fs, p = hadoop(self.spark, path)
        stream = fs.open(p)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _save(self, state: dict, query: str, batch: int) -> None:
        fs, p = hadoop(self.spark, f"{self.out}/{FOLDER}/_{uuid.uuid4().hex}")
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        if not rename(self.spark, p.toString(), f"{self.out}/{FOLDER}/{query}.{batch}.json"):
            fs.delete(p, False)
        for _, old in self._files(query).get(query, [])[:-KEPT]:
            fs.delete(hadoop(self.spark, old)[1], False)

    def update(self, status: DataFrame, query: str, batch: int) -> None:
        """Add a batch's rows, unless that has been done."""
        files = [f for f in self._files(query).get(query, []) if f[0] <= batch]
        if files and files[-1][0] == batch:
            return
        state = self._load(files[-1][1]) if files else {}
        for stream, new in self._batch(status).items():
            state[stream] = self._added(state.get(stream), new)
        self._save(state, query, batch)

    def _batch(self, status: DataFrame) -> dict[str, dict]:
        """By stream: counters by window, and the last window's samples and seconds. What comes to the driver is a row for
        each stream, status and window, and metrics.SAMPLES samples of each mean of each stream's last window at most."""
        came = metrics.received(status).withColumn("start", F.unix_micros(metrics.hour(self.start_seconds)))
        out: dict[str, dict] = {}
        for r in came.groupBy("stream", "start", "status").agg(F.count(F.lit(1)).alias("n")).collect():
            out.setdefault(r.stream, {"windows": {}, "samples": {}, "seconds": {}})["windows"].setdefault(r.start, {})[r.status] = r.n
        if not out:
            return out
        last = {stream: max(of["windows"]) for stream, of in out.items()}
        mine = F.lit(False)
        for stream, start in last.items():
            mine = mine | ((F.col("stream") == stream) & (F.col("start") == start))
        samples = F.array(*(F.struct(F.lit(name).alias("mean"), F.when(F.col("status") == which, F.col(column)).alias("x")) for name, column, which, _ in MEANS))
        each = came.filter(mine).select("stream", "arrival_seq", F.explode(F.filter(samples, lambda s: s["x"].isNotNull())).alias("s")).select("stream", "arrival_seq", "s.*")
        rank = F.row_number().over(Window.partitionBy("stream", "mean").orderBy(F.col("arrival_seq").desc()))
        for r in each.withColumn("k", rank).filter(F.col("k") <= metrics.SAMPLES).orderBy(F.col("k").desc()).collect():
            out[r.stream]["samples"].setdefault(r["mean"], []).append(r.x)
        at = F.floor(F.unix_micros("arrival_ts") / 1_000_000)
        valid = came.filter("status = 'valid'").select("stream", at.alias("at"))
        recent = valid.join(F.broadcast(valid.groupBy("stream").agg((F.max("at") - self.seconds).alias("from"))), "stream").filter(F.col("at") >= F.col("from"))
        for r in recent.groupBy("stream", "at").agg(F.count(F.lit(1)).alias("n")).collect():  # seconds + 1 rows for each stream
            out[r.stream]["seconds"][str(r["at"])] = r.n
        return out

    def _added(self, old: dict | None, new: dict) -> dict:
        """The state with a batch's counts. Rows of windows before the open one are late: they count for the lifetime, and apart."""
        old = old or {"start": None, "total": {}, "window": {}, "samples": {}, "seconds": {}, "late": 0}
        start = max([*new["windows"], *([old["start"]] if old["start"] is not None else [])])
        plus = lambda a, b: {k: a.get(k, 0) + b.get(k, 0) for k in {*a, *b}}
        same, total, late = start == old["start"], old["total"], old["late"]
        for at, n in new["windows"].items():
            total = plus(total, n)
            late += sum(n.values()) if old["start"] is not None and at < old["start"] else 0
        samples = {k: list(v) for k, v in old["samples"].items()} if same else {}
        if start in new["windows"]:
            for k, v in new["samples"].items():
                samples[k] = (samples.get(k, []) + v)[-metrics.SAMPLES :]
        seconds = plus(old["seconds"], new["seconds"])
        newest = max(map(int, seconds), default=0)
        return {
            "start": start, "total": total, "window": plus(old["window"] if same else {}, new["windows"].get(start, {})), "samples": samples,
            "seconds": {k: n for k, n in seconds.items() if int(k) >= newest - self.seconds}, "late": late,
        }

    def snapshot(self, now: float | None = None) -> dict[str, dict]:
        """By stream, what metrics.snapshot gives, and rows that came late; throughput in whole seconds. Of several queries that
        write here the counters are added up, the open window is the latest."""
        now = time.time() if now is None else now
        out: dict[str, dict] = {}
        for files in self._files().values():
            for stream, s in self._load(files[-1][1]).items():
                out[stream] = self._row(stream, s, now, out.get(stream))
        return out

    def _row(self, stream: str, s: dict, now: float, other: dict | None) -> dict:
        span = metrics.RESET_SECONDS * 1_000_000
        open_ = s["start"] <= now * 1_000_000 < s["start"] + span
        window, samples = (s["window"], s["samples"]) if open_ else ({}, {})
        row: dict = {"stream": stream, "late": s["late"]}
        for prefix, of in (("total", s["total"]), ("window", window)):
            row |= {f"{prefix}_received": sum(of.values())} | {f"{prefix}_{name}": of.get(kind, 0) for name, kind in KINDS.items()}
        recent = sum(n for k, n in s["seconds"].items() if now - self.seconds <= int(k) <= now)
        row["throughput_msgs_per_sec"] = round(recent / self.seconds, 4)
        means = {name: samples.get(name, []) for name, *_ in MEANS}
        if other:
            for k in [k for k in row if k.startswith(("total_", "window_", "late", "throughput"))]:
                row[k] += other[k]
            means = {name: v or [other[name]] * bool(other[name]) for name, v in means.items()}
        n = row["window_received"]
        row |= {name: round(row[f"window_{part}"] / n, 6) if n else none for name, part, none in (("schema_compliance_rate", "valid", 1.0), ("duplicate_rate", "duplicates", 0.0), ("dlq_rate", "dlq", 0.0))}
        return row | {name: round(sum(v) / len(v), digits) if (v := means[name]) else 0.0 for name, _, _, digits in MEANS}
