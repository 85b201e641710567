"""Source divergence audit: how far each source's use of words lies from every other source's of its language.

A task counts terms by language and source in a bounded table and sends partial counts; one shuffle by (language, term)
adds them up, counts the documents that hold a term, and leaves the terms of enough documents. For each pair of sources
the terms are tallied by their two counts: a joint histogram. Cells in which both counts are above zero come from a join
of the counts on the term; those with a zero follow from each source's own histogram less what the join has tallied.
The distance is evaluated once for each cell and multiplied by the cell's terms. All arithmetic is in integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.llm._common import stored

#: A term is kept if at least so many documents of its language hold it.
MIN_DOCS = 30
#: What each count is raised by, and the whole that probabilities are parts of.
PRIOR, WHOLE = 5, 1_000_000_000
#: Terms shown for each source.
TOP = 50
#: Partial counts that a task holds before it sends them on.
ENTRIES = 300_000
#: Tables of sources up to this many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_GROUPS = 50_000
#: Documents unpacked at a time.
SLICE = 256

#: ASCII letters in lower case, all other ASCII as spaces; bytes of longer sequences as they are.
_TERMS = bytes(c if c >= 0x80 else ord(chr(c).lower()) if chr(c).isalpha() else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The runs of letters and of characters beyond ASCII, A-Z in lower case."""
    return text.translate(_TERMS).split()


def partial_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term with occurrences n and documents d, several rows for a term: one from each full table of a task."""
    empty = F.lit("")
    given = docs.select(F.coalesce(F.col(lang), empty).alias("lang"), F.coalesce(F.col(source), empty).alias("source"), F.coalesce(F.col(text), empty).cast("binary").alias("text"))
    names = ("lang", "source", "term", "n", "d")

    def sent(held: dict) -> Iterator[pa.RecordBatch]:
        for (of, src), (n, d) in held.items():
            if n:
                fill = lambda v, k=len(n): pa.array([v], pa.string()).take(pa.array([0] * k, pa.int32()))
                yield pa.RecordBatch.from_arrays([fill(of), fill(src), pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([d[t] for t in n], pa.int64())], names=list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                for *group, body in zip(*(c.to_pylist() for c in whole.slice(at, SLICE).columns), strict=True):
                    n, d = held.setdefault(tuple(group), (Counter(), Counter()))
                    before, found = len(n), terms(body)
                    n.update(found)
                    d.update(set(found))
                    size += len(n) - before
                    if size >= ENTRIES:
                        yield from sent(held)
                        held, size = {}, 0
        yield from sent(held)

    return given.mapInArrow(run, "lang string, source string, term string, n long, d long")


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS, **columns: str) -> DataFrame:
    """lang, source, term, n for terms that min_docs documents of the language hold, with the language's count `total`;
    `first` marks one row of each (lang, term)."""
    parts = partial_counts(docs, **columns).repartition("lang", "term")
    each = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    term = Window.partitionBy("lang", "term")
    wide = each.withColumns({"docs": F.sum("d").over(term), "total": F.sum("n").over(term), "first": F.row_number().over(term.orderBy("source")) == 1})
    return wide.filter(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "total", "first")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE * (n + PRIOR) / (total + PRIOR * terms)), exact for any counts; null without terms."""
    big = lambda c: c.cast("decimal(20,0)")
    over = F.lit(WHOLE).cast("decimal(10,0)") * (big(n) + F.lit(PRIOR).cast("decimal(1,0)"))
    under = big(total + F.lit(PRIOR) * terms)
    return F.lit(1).cast("long") + F.call_function("div", over, F.nullif(under, F.lit(0).cast("decimal(20,0)")))


def groups_of(docs: DataFrame, kept: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Every (lang, source) that occurs, with a number g, its sum of counts, its terms, and the language's sum and terms."""
    empty = F.lit("")
    every = docs.select(F.coalesce(F.col(lang), empty).alias("lang"), F.coalesce(F.col(source), empty).alias("source")).distinct()
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum(F.when(F.col("first"), F.col("total"))).alias("lang_n"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count(F.lit(1)).alias("group_terms"))
    wide = every.join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["group_n", "group_terms", "v", "lang_n"])
    return wide.withColumn("g", F.monotonically_increasing_id())


def histograms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """For each pair of sources of a language, a before b by number: cells (a_n, b_n) with their terms m, zero cells included."""
    side = lambda x: kept.select("lang", "term", F.col("g").alias(x), F.col("n").alias(f"{x}_n"))
    met = side("a").join(side("b"), ["lang", "term"]).filter("a < b").groupBy("a", "b", "a_n", "b_n").agg(F.count(F.lit(1)).alias("m"))
    zero = F.lit(0).cast("long")
    cell = lambda a, b, m: F.struct(a.alias("a_n"), b.alias("b_n"), m.alias("m"))
    a_n, b_n, m = F.col("a_n"), F.col("b_n"), F.col("m")
    joint = met.select("a", "b", F.explode(F.array(cell(a_n, b_n, m), cell(a_n, zero, -m), cell(zero, b_n, -m), cell(zero, zero, m))).alias("c")).select("a", "b", "c.*")
    marginal = kept.groupBy("g", "n").agg(F.count(F.lit(1)).alias("m"))
    one = groups.select("lang", F.col("g").alias("a"), F.col("group_terms").alias("a_terms"), "v")
    pairs = one.join(groups.select("lang", F.col("g").alias("b"), F.col("group_terms").alias("b_terms")), "lang").filter("a < b")
    alone = [
        pairs.select("a", "b", zero.alias("a_n"), zero.alias("b_n"), (F.col("v") - F.col("a_terms") - F.col("b_terms")).alias("m")),
        pairs.join(marginal.withColumnRenamed("g", "a"), "a").select("a", "b", F.col("n").alias("a_n"), zero.alias("b_n"), "m"),
        pairs.join(marginal.withColumnRenamed("g", "b"), "b").select("a", "b", zero.alias("a_n"), F.col("n").alias("b_n"), "m"),
    ]
    cells = joint
    for more in alone:
        cells = cells.unionByName(more)
    return cells.groupBy("a", "b", "a_n", "b_n").agg(F.sum("m").alias("m"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: each source's distance to every other source of its language (part "pair"),
    and the terms that it uses above its language's share (part "term", `top` of them).

    Null texts, languages and sources are empty ones. Repeated rows count as often as they come, whatever their id; other
    columns are not read. A language without kept terms has distances of zero and no terms; empty tables give no rows.
    Equal values are ranked by item, in the order of UTF-8.
    """
    kept = stored(kept_counts(docs, min_docs, lang=lang, source=source, text=text), "kept")
    groups = stored(groups_of(docs, kept, lang, source), "groups")
    few = groups.count() <= BROADCAST_GROUPS
    small = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    kept = kept.join(small(groups), ["lang", "source"])

    above = share(F.col("n"), F.col("group_n"), F.col("v")) - share(F.col("total"), F.col("lang_n"), F.col("v"))
    terms = kept.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), above.alias("value")).filter("value > 0")

    named = lambda x: small(groups.select(F.col("g").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("source", "group_n"))))
    cells = histograms(kept, groups).filter("m > 0").join(named("a"), "a").join(named("b"), "b").join(small(groups.select(F.col("g").alias("a"), "lang", "v")), "a")
    p = lambda x: share(F.col(f"{x}_n"), F.col(f"{x}_group_n"), F.col("v"))
    far = cells.groupBy("lang", "a_source", "b_source").agg(F.sum(F.abs(p("a") - p("b")) * F.col("m")).alias("value"))
    # pairs of a language without kept terms have no cell
    one = groups.filter("v = 0").select("lang", F.col("source").alias("a_source"), F.col("g").alias("__a"))
    far = far.unionByName(one.join(groups.select("lang", F.col("source").alias("b_source"), F.col("g").alias("__b")), "lang").filter("__a < __b").select("lang", "a_source", "b_source", F.lit(0).cast("long").alias("value")))
    both = F.explode(F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")), F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item"))))
    pairs = far.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    return pairs.select(*columns, rank).unionByName(terms.select(*columns, rank).filter(F.col("rank") <= top))
