"""Immutable shards under a versioned manifest, compacted by size tiers.

Arrivals are written as small shards that never change. Shards of one size tier are merged, once there are enough of
them, into files of about the target size. Each append or compaction ends with one new manifest, which a rename that
fails on an existing name puts in place: readers see the shards of one version, whole, and of two writers one wins and
the other takes its turn on top. Files of old versions stay until vacuum(), so readers of those are not disturbed.

A merge reads its shards one after the other in one task, without a shuffle, and all merges of a round are one job.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlstone.llm._common import fresh, hadoop, scratch

#: Size of a full shard, how much larger each tier is than the one before, and shards of a tier that are merged at least.
TARGET_BYTES = 128 << 20
TIER_RATIO = 4
LEAST_RUNS = 4
#: Merges of one job; more are done in further rounds.
MERGES = 200
SMALLEST = 64 << 10
#: Object stores, whose renames are copies.
NO_RENAME = ("s3", "s3a", "s3n", "gs", "oss", "wasb", "wasbs")
_ZIPPED = "spark.sql.unionOutputPartitioning"


@dataclass(frozen=True, order=True)
class Shard:
    path: str
    bytes: int
    arrival: int

    def tier(self) -> int:
        t, top = 0, SMALLEST
        while self.bytes > top:
            t, top = t + 1, top * TIER_RATIO
        return t


class Conflict(RuntimeError):
    """Another writer has committed this version."""


class ShardStore:
    def __init__(self, spark: SparkSession, path: str | None = None, target_bytes: int = TARGET_BYTES):
        self.spark, self.target = spark, target_bytes
        self.path = path or scratch(spark, "shards")
        if self.path.partition(":")[0] in NO_RENAME:
            raise ValueError(f"{self.path}: a manifest needs a file system whose rename fails if the name is taken")

    def _fs(self, path: str):
        return hadoop(self.spark, path)

    def versions(self) -> list[int]:
        fs, p = self._fs(f"{self.path}/manifest")
        if not fs.exists(p):
            return []
        return sorted(int(n[1:-5]) for s in fs.listStatus(p) if (n := s.getPath().getName()).startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> tuple[int, list[Shard], str | None]:
        """(version, shards, the rows' schema); version 0 is the empty store."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return 0, [], None
        fs, p = self._fs(f"{self.path}/manifest/v{version:012d}.json")
        stream = fs.open(p)
        try:
            said = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return version, [Shard(**s) for s in said["shards"]], said["schema"]

    def _commit(self, version: int, shards: list[Shard], schema: str) -> int:
        """Put the manifest of `version` in place, or raise Conflict."""
        jvm = self.spark._jvm
        temporary = f"{self.path}/manifest/.{uuid.uuid4().hex}"
        fs, src = self._fs(temporary)
        out = fs.create(src, False)
        out.write(bytearray(json.dumps({"version": version, "schema": schema, "shards": [asdict(s) for s in sorted(shards)]}).encode()))
        out.close()
        kind = jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(src, fs.makeQualified(self._fs(f"{self.path}/manifest/v{version:012d}.json")[1]), how)
        except Py4JJavaError as e:
            fs.delete(src, False)
            if "AlreadyExists" in str(e.java_exception.getClass().getName()):
                raise Conflict(version) from e
            raise
        return version

    def _written(self, folder: str, arrival: int) -> list[Shard]:
        fs, p = self._fs(folder)
        return sorted(Shard(s.getPath().toString(), s.getLen(), arrival) for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))

    def _add(self, shards: list[Shard], schema: StructType) -> int:
        while True:
            version, have, known = self.manifest()
            if known is not None and StructType.fromJson(json.loads(known)) != schema:
                raise ValueError(f"the store holds rows of {known}")
            try:
                return self._commit(version + 1, [*have, *shards], schema.json())
            except Conflict:
                continue

    def append(self, rows: DataFrame, arrival: int = 0) -> int:
        """Write rows as new shards, one for each of their partitions that has any; returns the new version."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(folder)
        return self._add(self._written(folder, arrival), _nullable(rows.schema))

    def append_all(self, rows: DataFrame, arrival: Column, count: int) -> int:
        """Append `count` arrivals that one table holds, told apart by a number from 0 on: one job, a commit for each.

        Rows of any other number, or of none, are committed after these, together; a table without rows, as no shards.
        """
        name = fresh("arrival", rows.columns)
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.withColumn(name, arrival).write.option("compression", "zstd").partitionBy(name).parquet(folder)
        fs, p = self._fs(folder)
        found = {n.partition("=")[2]: s.getPath().toString() for s in fs.listStatus(p) if (n := s.getPath().getName()).startswith(f"{name}=")}
        runs = [self._written(found.pop(str(k)), k) for k in range(count) if str(k) in found]
        rest = [s for path in found.values() for s in self._written(path, -1)]
        for run in [*runs, *([rest] if rest else [])] or [[]]:
            version = self._add(run, _nullable(rows.schema))
        return version

    def plan(self, shards: list[Shard]) -> list[list[Shard]]:
        """Groups to merge: shards below half the target, tier by tier from the smallest, taken together up to the
        target; a tier's last group waits for more if it has fewer than LEAST_RUNS and is under half the target."""
        tiers: dict[int, list[Shard]] = {}
        for s in sorted(shards):
            if 2 * s.bytes < self.target:
                tiers.setdefault(s.tier(), []).append(s)
        groups = []
        for tier in sorted(tiers):
            group, size = [], 0
            for s in tiers[tier]:
                if group and size + s.bytes > self.target:
                    groups.append(group)
                    group, size = [], 0
                group.append(s)
                size += s.bytes
            if len(group) >= LEAST_RUNS or 2 * size >= self.target:
                groups.append(group)
        return [g for g in groups if len(g) > 1]

    def compact(self) -> int:
        """Merge until no tier has enough shards; each round is one job and one commit. Returns the version."""
        while True:
            version, have, schema = self.manifest()
            groups = self.plan(have)[:MERGES]
            if not groups:
                return version
            kind = StructType.fromJson(json.loads(schema))
            folder = f"{self.path}/data/{uuid.uuid4().hex}"
            own = self.spark.newSession()  # its settings are nobody else's
            own.conf.set(_ZIPPED, "false")  # else a union of single partitions is one partition
            parts = [own.read.schema(kind).parquet(*(s.path for s in g)).coalesce(1) for g in groups]
            reduce(DataFrame.unionAll, parts).write.option("compression", "zstd").parquet(folder)
            merged = self._written(folder, -1)
            old = {s for g in groups for s in g}
            while True:
                version, have, _ = self.manifest()
                if not old <= set(have):  # another compaction took some of them: its result stands
                    fs, p = self._fs(folder)
                    fs.delete(p, True)
                    break
                try:
                    self._commit(version + 1, [*(s for s in have if s not in old), *merged], schema)
                    break
                except Conflict:
                    continue

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        _, shards, schema = self.manifest(version)
        if schema is None:
            raise ValueError(f"nothing was appended to {self.path}")
        kind = StructType.fromJson(json.loads(schema))
        if not shards:
            none = f"{self.path}/none"  # an empty folder, whose rows have _metadata as well
            fs, p = self._fs(none)
            fs.mkdirs(p)
            return self.spark.read.schema(kind).parquet(none)
        return self.spark.read.schema(kind).parquet(*(s.path for s in shards))

    def vacuum(self, keep: int = 1, orphan_seconds: float = 86_400) -> int:
        """Delete manifests but the newest `keep`, and shards that none of these names; returns how many shards went.

        Folders of writers that ended before their commit go too, once they are `orphan_seconds` old: no writer takes longer.
        """
        every = self.versions()
        kept = {s.path for v in every[-keep:] for s in self.manifest(v)[1]}
        gone = {s.path for v in every[:-keep] for s in self.manifest(v)[1]} - kept
        for v in every[:-keep]:
            fs, p = self._fs(f"{self.path}/manifest/v{v:012d}.json")
            fs.delete(p, False)
        for path in gone:
            fs, p = self._fs(path)
            fs.delete(p, False)
        fs, p = self._fs(f"{self.path}/data")
        if fs.exists(p):
            latest = time.time() * 1000 - orphan_seconds * 1000
            for s in fs.listStatus(p):
                folder = s.getPath().toString()
                if s.getModificationTime() < latest and not any(path.startswith(folder + "/") for path in kept):
                    fs.delete(s.getPath(), True)
        return len(gone)


def _nullable(schema: StructType) -> StructType:
    out = json.loads(schema.json())
    for f in out["fields"]:
        f["nullable"], f["metadata"] = True, {}
    return StructType.fromJson(out)
