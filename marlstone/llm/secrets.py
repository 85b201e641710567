"""Incremental secret scanning over a content-addressed ledger, in DataFrame operations only.

Every version of every file is named by the SHA-256 of its text. The ledger holds one row for each blob and rule
version that was ever scanned, with the spans found. A scan evaluates only the rules a blob has not yet met, appends
those rows to the ledger and joins the findings of the whole ledger back to every path that carries the blob.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm._common import fresh, hadoop, scratch, stored, whole_text

SPAN = "struct<kind:string,start:long,end:long>"
LEDGER = f"blob string, rule string, spans array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost non-overlapping matches count if `group` has at least `least` characters.

    search: a pattern with those matches alone, where there is one; what fails is then never made into an array.
    """

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1
    search: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: Column) -> Column:
        """array<struct<kind,start,end>>, in code points, end exclusive.

        What lies between the matches comes from split(), the matches from regexp_extract_all(); both search from
        left to right without overlap, so running lengths of the two, in turn, are the matches' places.
        """
        pattern = self.search or self.pattern
        whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(self.group)) if self.group else whole
        parts = F.split(text, pattern, -1)
        none = F.array().cast(f"array<{SPAN}>")
        zipped = F.filter(F.arrays_zip(parts.alias("before"), whole.alias("match"), checked.alias("checked")), lambda x: x["match"].isNotNull())
        sizes = F.transform(zipped, lambda x: F.struct(F.char_length(x["before"]).alias("gap"), F.char_length(x["match"]).alias("size"), (F.char_length(x["checked"]) >= self.least).alias("fine")))
        def step(state: Column, one: Column) -> Column:
            begin = state["at"] + one["gap"]
            span = F.struct(F.lit(self.kind).alias("kind"), begin.alias("start"), (begin + one["size"]).alias("end"))
            return F.struct((begin + one["size"]).alias("at"), F.when(one["fine"], F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

        def through(state: Column, some: Column) -> Column:
            return F.aggregate(some, F.struct(state["at"].alias("at"), none.alias("out")), step, lambda s: F.struct(s["at"].alias("at"), F.concat(state["outs"], F.array(s["out"])).alias("outs")))

        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("outs"))
        # appending copies what is there, so matches are worked on in about as many blocks as a block has matches
        block = lambda all_: F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(all_)))).cast("int")
        blocks = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x["all"]) - 1) / x["block"]).cast("int")), lambda k: F.slice(x["all"], k * x["block"] + 1, x["block"]))
        found = _let(sizes, lambda all_: _let(F.struct(all_.alias("all"), block(all_).alias("block")), lambda x: F.aggregate(blocks(x), start, through, lambda s: F.flatten(s["outs"]))))
        return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is made once."""
    return F.element_at(F.transform(F.array(value), body), 1)


# The three base patterns. The second and third ask for their length in the search already: a run of letters
# or digits that is too short has no longer one in it.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, search=r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]+", 0, 32, search=r"[0-9a-f]{32,}"),
)


#: Names of unseen blobs that are broadcast, to find their texts before anything moves; 40 bytes each, about.
BROADCAST_NAMES = 500_000


class Ledger:
    """Blobs that were scanned, by rule version, in storage that all executors share: a folder of Parquet for each scan.

    A scan's folder appears by one rename, whole, so scanners don't disturb each other. Two that scan the same blob at
    the same time both add its row; reading takes it once.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch(spark, "ledger")

    def rows(self) -> DataFrame:
        """(blob, rule, spans), once for each blob and rule."""
        fs, p = hadoop(self.spark, self.path)
        scans = [s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("scan-")] if fs.exists(p) else []
        if not scans:
            return self.spark.createDataFrame([], LEDGER)
        found = self.spark.read.schema(LEDGER).parquet(*scans)
        return found if len(scans) == 1 else found.dropDuplicates(["blob", "rule"])

    def unseen(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
        """(blob, todo): the blobs of versions and the rules they have not met. Names move, texts don't."""
        every = F.array(*(F.lit(r.name) for r in rules))
        blobs = versions.select(blob_name(text).alias("blob")).distinct()
        seen = self.rows().groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        left = blobs.join(seen, "blob", "left").select("blob", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
        return left.filter(F.size("todo") > 0)

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> int:
        """Scan what is new in versions (any table with a text column); null texts are empty blobs, no rows are none.

        The ledger is asked by blob names first. Only texts of unseen blobs are moved, one for each distinct blob, kept in
        each task and then over all, so copies cost one scan. Returns the number of ledger rows added.
        """
        texts = versions.select(blob_name(text).alias("blob"), whole_text(text).alias("text"))
        fs, p = hadoop(self.spark, self.path)
        if fs.exists(p):
            unseen = stored(self.unseen(versions, rules, text), "unseen")
            n = unseen.count()
            if not n:
                return 0
            names = unseen.select("blob", "todo")
            blobs = texts.join(F.broadcast(names) if n <= BROADCAST_NAMES else names, "blob").dropDuplicates(["blob"])
        else:
            blobs = texts.dropDuplicates(["blob"]).withColumn("todo", F.array(*(F.lit(r.name) for r in rules)))
        results = F.array(*(F.when(F.array_contains("todo", r.name), F.struct(F.lit(r.name).alias("rule"), r.spans(F.col("text")).alias("spans"))) for r in rules))
        added = blobs.select("blob", F.explode(F.filter(results, lambda x: x.isNotNull())).alias("r")).select("blob", "r.rule", "r.spans")
        name = uuid.uuid4().hex
        written, final = f"{self.path}/_{name}", f"{self.path}/scan-{name}"
        added.write.option("compression", "zstd").parquet(written)
        count = self.spark.read.schema(LEDGER).parquet(written).count()
        if not fs.rename(hadoop(self.spark, written)[1], hadoop(self.spark, final)[1]):
            raise RuntimeError(f"{written} could not be renamed")
        return count

    def findings(self, paths: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
        """Every row of paths, without its text, with `blob` and `spans` by start, then by the rules' order.

        These two are the last columns; they get leading underscores where paths has columns of their names.
        """
        order = {r.kind: k for k, r in enumerate(rules)}
        rank = F.create_map(*(x for k, v in order.items() for x in (F.lit(k), F.lit(v))))
        rest = [c for c in paths.columns if c != text]
        blob, spans = fresh("blob", rest), fresh("spans", rest)
        found = self.rows().filter(F.col("rule").isin([r.name for r in rules]) & (F.size("spans") > 0))
        found = found.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        keyed = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), rank[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
        ordered = F.transform(F.array_sort(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
        found = found.select(F.col("blob").alias(blob), ordered.alias(spans))
        named = paths.select(*rest, blob_name(text).alias(blob)).join(found, blob, "left")
        return named.select(*rest, blob, F.coalesce(spans, F.array().cast(f"array<{SPAN}>")).alias(spans))


def blob_name(text: str = "text") -> Column:
    return F.sha2(whole_text(text).cast("binary"), 256)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
