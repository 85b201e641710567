"""Conversation structure repair: error-correcting Earley parsing of roles under a weighted grammar.

GRAMMAR says which sequences of role initials are sound. Error productions let a row be kept, given another role or
deleted, and let an empty row be inserted, each at its cost. A chart's column holds, for each dotted production, the cheapest
(cost, audit) that leads there; an audit is the edits' initials in order, ties going to the least in ASCII. The cheapest completed item
yields the repair. Each production has its nonterminal, if any, first, so all items begin where the chart does, and a column is
a vector over ITEMS. It depends on the column before and on a row's kind (initial, fault) alone; columns recur, so each step is
computed once for each pair of these and then looked up.

Audits of one column never begin with one another (an insertion belongs to the row before which it stands), so their ranks
are all that comparisons need. Hence a stretch of a conversation is a matrix from items to items of (cost, rank), and
matrices of stretches follow one another: a conversation may be dealt to any number of tasks. Rows are dealt by ranges of
(conversation, turn); what a task sees whole is repaired there, and stretches of conversations that cross tasks
or are long are linked by one pass over their matrices. Only the hash of a repaired text has to read it in one place; it is streamed.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm._common import stored

# The role grammar: an optional system row, then pairs of a user's and an assistant's row, or nothing at all.
GRAMMAR = (("C", ""), ("C", "P"), ("P", "Hua"), ("P", "Pua"), ("H", ""), ("H", "s"))
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: A stretch ends when it has so many rows, or characters of text.
STRETCH_ROWS, STRETCH_CHARS = 20_000, 4_000_000
#: Rows unpacked at a time.
SLICE = 256

Item = tuple[int, int]


def _after(item: Item) -> list[Item]:
    """An item and all that completion makes of it."""
    found = [item]
    for p, dot in found:
        head, body = GRAMMAR[p]
        if dot == len(body):
            found += [(q, 1) for q, (_, other) in enumerate(GRAMMAR) if other[:1] == head and (q, 1) not in found]
    return found


def _awaits(item: Item) -> str:
    """The terminal after an item's dot; none if a nonterminal or the end comes there."""
    p, dot = item
    symbol = GRAMMAR[p][1][dot : dot + 1]
    return symbol if symbol.islower() else ""


#: Items that a column holds: those that await a terminal, and the completed start symbol's.
_BEGIN = [i for p in range(len(GRAMMAR)) for i in _after((p, 0))]
ITEMS: list[Item] = sorted({(p, dot) for p, (head, body) in enumerate(GRAMMAR) for dot in range(len(body) + 1) if _awaits((p, dot)) or head == "C" and dot == len(body)})
AWAITS = [_awaits(i) for i in ITEMS]
START = [k for k, i in enumerate(ITEMS) if i in _BEGIN]
FINAL = [k for k, (p, dot) in enumerate(ITEMS) if GRAMMAR[p][0] == "C" and dot == len(GRAMMAR[p][1])]
#: Items after an item's terminal has been read.
NEXT = [[ITEMS.index(i) for i in _after((p, dot + 1)) if i in ITEMS] if AWAITS[k] else [] for k, (p, dot) in enumerate(ITEMS)]


def _inserted(item: int) -> dict[int, str]:
    """What can be reached from an item by insertions alone, with the fewest terminals that do it."""
    found = {item: ""}
    for x in (queue := [item]):
        for y in NEXT[x] if AWAITS[x] in ROLES else []:
            if y not in found:
                found[y] = found[x] + AWAITS[x]
                queue.append(y)
    return found


INSERTED = [_inserted(k) for k in range(len(ITEMS))]

#: A column: (cost less the least one, rank of the audit) for each item, or none.
Column = tuple[tuple[int, int] | None, ...]
#: How an item was reached: item before, letters of the audit, terminals inserted, terminal that the row was given ("" keeps its role, None goes).
Edge = tuple[int, str, str, str | None]
KEEP, RISK, DROP = 0, 1, 2


def kind(role: str, fault: int) -> int:
    """A row for the chart: its role's initial and what holds for it: KEEP freely, RISK (truncated), DROP (has to go)."""
    return "sua".find(role[:1] or "-") + 1 + 4 * fault


_steps: dict = {}


def step(column: Column, row: int) -> tuple[Column, int, tuple[Edge | None, ...]]:
    """The next column, what the least cost rises by, and how each item was reached."""
    if (known := _steps.get((column, row))) is None:
        reached = _reached(column, row)
        (after,), (least,) = _ranked([reached])
        known = _steps[column, row] = after, least, tuple(r and r[2] for r in reached)
    return known


def _ranked(many: list[list]) -> tuple[tuple[Column, ...], tuple[int, ...]]:
    """Columns of what was reached, their audits ranked among all of them, and what each one's least cost rises by."""
    least = tuple(min((r[0] for r in reached if r), default=0) for reached in many)
    ranks = {key: k for k, key in enumerate(sorted({r[1] for reached in many for r in reached if r}))}
    return tuple(tuple(r and (r[0] - low, ranks[r[1]]) for r in reached) for reached, low in zip(many, least, strict=True)), least


def _reached(column: Column, row: int) -> list[tuple[int, tuple[int, str], Edge] | None]:
    """For each item the cheapest way to it: cost, what its audit ranks by, edge."""
    initial, fault = "-sua"[row % 4], row // 4
    best: list[tuple[int, tuple[int, str], Edge] | None] = [None] * len(ITEMS)

    def offer(to: int, cost: int, rank: int, edge: Edge) -> None:
        if best[to] is None or (cost, (rank, edge[1])) < best[to][:2]:
            best[to] = cost, (rank, edge[1]), edge

    for e, have in enumerate(column):
        if have is None:
            continue
        cost, rank = have
        for x, put in INSERTED[e].items():
            spent, said, awaits = cost + INSERT * len(put), "I" * len(put), AWAITS[x]
            offer(x, spent + DELETE, rank, (e, f"{said}D", put, None))
            if fault == DROP:
                continue
            for to in NEXT[x]:
                if awaits == initial:
                    offer(to, spent + TRUNCATED * fault, rank, (e, f"{said}K", put, ""))
                elif awaits in ROLES:
                    offer(to, spent + REROLE + TRUNCATED * fault, rank, (e, f"{said}R", put, awaits))
    return best


def ended(column: Column) -> tuple[int, str, int]:
    """The item from which the cheapest repair ends, the terminals inserted there, and the cost over the column's least."""
    ways = ((have[0] + INSERT * len(put), have[1], len(put), e, put) for e, have in enumerate(column) if have for x, put in INSERTED[e].items() if x in FINAL)
    cost, _, _, e, put = min(ways)
    return e, put, cost


def begun(*items: int) -> Column:
    return tuple((0, 0) if k in items else None for k in range(len(ITEMS)))


#: Where a whole conversation's chart begins.
OPEN = begun(*START)


def matrix(rows: bytes) -> list[int]:
    """From each item to each: cost and rank of the cheapest audit of a stretch, -1 where there is none; one after another.

    Audits are ranked among those from all items, for several items may be reached by one audit.
    """
    columns, totals = tuple(begun(e) for e in range(len(ITEMS))), [0] * len(ITEMS)
    for row in rows:
        if (known := _steps.get((columns, row))) is None:
            known = _steps[columns, row] = _ranked([_reached(c, row) for c in columns])
        columns, more = known
        totals = [t + m for t, m in zip(totals, more, strict=True)]
    return [x for column, total in zip(columns, totals, strict=True) for have in column for x in ((-1, -1) if have is None else (have[0] + total, have[1]))]


def linked(column: Column, stretch: list[int]) -> tuple[Column, tuple[int, ...]]:
    """The column after a stretch, given by its matrix, and the item before from which each item was reached; costs are less the least one."""
    n = len(ITEMS)
    best: list[tuple[int, int, int, int] | None] = [None] * n
    for e, have in enumerate(column):
        for to in range(n if have else 0):
            cost, rank = stretch[2 * (e * n + to) : 2 * (e * n + to) + 2]
            if cost >= 0 and (best[to] is None or (have[0] + cost, have[1], rank) < best[to][:3]):
                best[to] = have[0] + cost, have[1], rank, e
    least = min(b[0] for b in best if b)
    ranks = {key: k for k, key in enumerate(sorted({b[1:3] for b in best if b}))}
    return tuple(b and (b[0] - least, ranks[b[1:3]]) for b in best), tuple(-1 if b is None else b[3] for b in best)


def edits(rows: bytes, column: Column, end: int | None) -> tuple[list[Edge], str]:
    """The edges of the cheapest repair of a stretch, row by row, and what is inserted after it; end: the item it leads to, none for
    a conversation's end."""
    edges = []
    for row in rows:
        column, _, how = step(column, row)
        edges.append(how)
    put = ""
    if end is None:
        end, put, _ = ended(column)
    out: list[Edge] = []
    for how in reversed(edges):
        out.append(how[end])
        end = how[end][0]
    return out[::-1], put


def applied(rows: bytes, roles: list[str], texts: list[str], path: list[Edge], put: str) -> tuple[int, str, list[str]]:
    """(cost, audit, role:text of each row that the repair leaves)."""
    cost, lines = 0, []
    for row, role, text, (_, said, before, given) in zip(rows, roles, texts, path, strict=True):
        lines += [f"{ROLES[x]}:" for x in before]
        cost += INSERT * len(before)
        if given is None:
            cost += DELETE
        else:
            cost += TRUNCATED * (row // 4) + (REROLE if given else 0)
            lines.append(f"{ROLES[given] if given else role}:{text}")
    lines += [f"{ROLES[x]}:" for x in put]
    return cost + INSERT * len(put), "".join(said for _, said, *_ in path) + "I" * len(put), lines


@dataclass
class Stretch:
    """Rows of one conversation that follow one another."""

    rows: bytearray = field(default_factory=bytearray)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    chars: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = DROP if not end or again else KEEP if end in ".!?" else RISK
        self.blank += not end
        self.duplicate += bool(end) and again
        self.truncated += fault == RISK
        if self.roles:
            self.illegal += self.roles[-1][:1] + role[:1] not in ("su", "ua", "au")
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.rows.append(kind(role, fault))
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


#: What comes back for a conversation, besides its id.
REPAIRED = (("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"), ("cost", "long"), ("audit", "string"), ("repaired_sha256", "string"))
#: What a stretch hands on, besides its conversation's id: its place in order, then counts, ends, matrix and rows.
_PIECE = (
    ("place", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"), ("turns", "long"), ("low", "long"), ("high", "long"), ("first", "string"), ("last", "string"),
    ("matrix", "array<int>"), ("rows", "binary"), ("roles", "array<string>"), ("texts", "array<string>"),
)
_ARROW = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
_SPARK = {"long": T.LongType(), "string": T.StringType(), "array<int>": T.ArrayType(T.IntegerType()), "binary": T.BinaryType(), "array<string>": T.ArrayType(T.StringType())}
_ALL = {**dict(REPAIRED), **dict(_PIECE)}




def _schema(id_type: T.DataType, columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField("conv_id", id_type), *(T.StructField(n, _SPARK[k]) for n, k in columns.items())])


def _batch(schema: list[tuple[str, str]], ids: list, id_type: pa.DataType, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *(pa.array([r.get(n) for r in rows], _ARROW[k]) for n, k in schema)], names=["conv_id", *(n for n, _ in schema)])


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            yield from zip(*(whole.column(n).slice(at, SLICE).to_pylist() for n in names), strict=True)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to repaired conversations, and to stretches of those that this task may not hold whole: its first and
    its last one, and long ones."""
    batches = iter(batches)
    if (head := next(batches, None)) is None:
        return
    id_type, base, seq = head.schema.field("conv_id").type, TaskContext.get().partitionId() << 33, itertools.count()
    schema = list(_ALL.items())
    ids: list = []
    out: list[dict] = []
    size = 0

    def close(cut: bool) -> None:
        nonlocal size
        ids.append(conv)
        out.append(_piece(s, base + next(seq)) if cut else _repaired(s))
        size += s.chars if cut else 500

    conv, s, cut, again, any_row = None, Stretch(), True, False, False
    for c, turn, role, text, gone, data in _rows(itertools.chain([head], batches), "conv_id", "turn", "role", "text", "gone", "data"):
        if any_row and c != conv:
            close(cut)
            s, cut = Stretch(), False
        elif len(s.roles) >= STRETCH_ROWS or s.chars >= STRETCH_CHARS:
            close(True)
            s, cut = Stretch(), True
        conv, any_row = c, True
        if not data:
            again = True
        elif not gone:
            s.add(turn, role, text, again)
            again = False
        if size > STRETCH_CHARS:
            yield _batch(schema, ids, id_type, out)
            ids, out, size = [], [], 0
    if any_row:
        close(True)
    yield _batch(schema, ids, id_type, out)


def _repaired(s: Stretch) -> dict:
    cost, audit, lines = applied(s.rows, s.roles, s.texts, *edits(s.rows, OPEN, None))
    return {"gaps": s.gaps(), "blank": s.blank, "duplicate": s.duplicate, "truncated": s.truncated, "illegal": s.illegal, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()}


def _piece(s: Stretch, place: int) -> dict:
    first, last = (s.roles[0][:1], s.roles[-1][:1]) if s.roles else (None, None)
    return {n: getattr(s, n) for n in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "roles", "texts")} | {"place": place, "first": first, "last": last, "matrix": matrix(s.rows), "rows": bytes(s.rows)}


def _routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The items by which the cheapest repair of a conversation enters and leaves each of its stretches; it leaves the last one by
    none (-1). What is held of a stretch is a byte for each item."""

    def told(places: list[int], hows: list[bytes], column: Column) -> pa.RecordBatch:
        leaves, at = [-1], ended(column)[0]
        enters = []
        for how in reversed(hows):
            at = how[at]
            enters.append(at)
            leaves.append(at)
        return pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(enters[::-1], pa.int32()), pa.array(leaves[:-1][::-1], pa.int32())], names=["place", "entry", "leaves"])

    conv, column, places, hows = None, OPEN, [], []
    for c, place, stretch in _rows(batches, "conv_id", "place", "matrix"):
        if places and c != conv:
            yield told(places, hows, column)
            column, places, hows = OPEN, [], []
        conv = c
        column, how = linked(column, stretch)
        places.append(place)
        hows.append(bytes(max(0, x) for x in how))
    if places:
        yield told(places, hows, column)


def _mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches with the items that they are entered and left by to their part of the repair."""
    ends = ("place", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")
    for whole in batches:
        id_type = whole.schema.field("conv_id").type
        for at in range(whole.num_rows):
            r = whole.slice(at, 1).to_pylist()[0]
            leaves = None if r["leaves"] < 0 else r["leaves"]
            cost, audit, lines = applied(r["rows"], r["roles"], r["texts"], *edits(r["rows"], begun(r["entry"]), leaves))
            part = {n: r[n] for n in ends} | {"cost": cost, "audit": audit, "body": "\n".join(lines) if lines else None}
            yield _batch([(n, _ALL[n]) for n in (*ends, "cost", "audit")] + [("body", "string")], [r["conv_id"]], id_type, [part])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted parts of repairs to their conversations' rows; texts are hashed as they pass by."""
    batches = iter(batches)
    if (head := next(batches, None)) is None:
        return
    id_type = head.schema.field("conv_id").type
    ids: list = []
    out: list[dict] = []
    audits: list[str] = []
    names = ("conv_id", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last", "cost", "audit", "body")
    for batch in itertools.chain([head], batches):
        for at in range(batch.num_rows):  # a body may be of some megabytes
            r = {n: batch.column(n)[at].as_py() for n in names}
            if not out or r["conv_id"] != ids[-1]:
                if out:
                    _close(out[-1], audits)
                ids.append(r["conv_id"])
                out.append({n: 0 for n, k in REPAIRED if k == "long"} | {"low": None, "high": None, "turns": 0, "last": None, "hash": hashlib.sha256(), "lines": False})
                audits = []
            o = out[-1]
            for n in ("blank", "duplicate", "truncated", "illegal", "cost"):
                o[n] += r[n]
            if r["low"] is not None:
                o["turns"] += r["turns"] - (r["low"] == o["high"])
                o["low"], o["high"] = r["low"] if o["low"] is None else o["low"], r["high"]
            if r["first"] is not None:
                o["illegal"] += o["last"] is not None and o["last"] + r["first"] not in ("su", "ua", "au")
                o["last"] = r["last"]
            if r["body"] is not None:
                o["hash"].update(("\n" if o["lines"] else "").encode() + r["body"].encode("utf-8", "surrogatepass"))
                o["lines"] = True
            audits.append(r["audit"])
    if out:
        _close(out[-1], audits)
    yield _batch(list(REPAIRED), ids, id_type, out)


def _close(o: dict, audits: list[str]) -> None:
    o["gaps"] = 0 if o["low"] is None else o["high"] - o["low"] + 1 - o["turns"]
    o["audit"], o["repaired_sha256"] = "".join(audits), o.pop("hash").hexdigest()


def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text after damage by crc32("conv_id:turn") % 20: 0 drops a row, 1 empties its text, 2 takes `.!?` out, 3
    repeats it (copy is 1 for the second), 4 makes it a user's. Dropped rows stay as empty ones that are `gone`, for their
    conversation's sake. Nulls count as one space, but for the id and turn that come back."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    given = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), one(role).alias("role"), one(text).alias("text"), (F.crc32(F.concat(one(conv_id), F.lit(":"), one(turn)).cast("binary")) % 20).alias("code"))
    code = F.col("code")
    body = F.when(code.isin(0, 1), "").when(code == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return given.select("conv_id", "turn", F.when(code == 0, "").when(code == 4, "user").otherwise(F.col("role")).alias("role"), body.alias("text"), (code == 0).alias("gone"), copies.alias("copy"))


def repair(rows: DataFrame) -> DataFrame:
    """conv_id with REPAIRED for each conversation of rows (conv_id, turn, role, text without nulls, gone, copy).

    Rows are taken by turn, nulls first; rows of one turn by role, then by a hash of the text, copies together. A row's first fault counts: blank, duplicate
    of an earlier row's role and text, truncated. A conversation without rows, all of them gone, has zeros, an empty audit
    and the hash of an empty text. Rows without an id are one conversation. An empty table gives an empty table.
    """
    spark = rows.sparkSession
    key = F.md5(F.concat("role", F.lit("\0"), "text").cast("binary"))
    rows = stored(rows.withColumn("key", key).withColumn("row", F.monotonically_increasing_id()), "rows")
    order = ["turn", "row", "copy"]
    narrow = rows.filter(~F.col("gone") & F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("conv_id", "key", "role", *order)
    first = narrow.groupBy("conv_id", "key").agg(F.min(F.struct(*order)).alias("at"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "at")
    again = narrow.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k"))).filter((F.col("row") != F.col("at.row")) | (F.col("copy") != F.col("at.copy")))
    marks = again.select("conv_id", "turn", "role", F.lit("").alias("text"), F.lit(False).alias("gone"), "copy", "key", "row", F.lit(0).alias("data"))
    by = ["conv_id", "turn", "role", "key", "row", "copy"]
    dealt = rows.withColumn("data", F.lit(1)).unionByName(marks).repartitionByRange(*by).sortWithinPartitions(*by, "data")
    id_type = rows.schema["conv_id"].dataType
    told = stored(dealt.select("conv_id", "turn", "role", "text", "gone", "data").mapInArrow(_parsed, _schema(id_type, _ALL)), "stretches")
    pieces = told.filter(F.col("place").isNotNull())
    routes = pieces.select("conv_id", "place", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_routed, "place long, entry int, leaves int")
    routed = pieces.drop("matrix", *(n for n, _ in REPAIRED if n not in dict(_PIECE))).join(routes, "place")
    ends = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")
    mended = routed.select("conv_id", "place", *ends, "rows", "roles", "texts", "entry", "leaves").mapInArrow(_mended, _schema(id_type, {n: _ALL[n] for n in ("place", *ends, "cost", "audit")} | {"body": "string"}))
    whole = mended.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_joined, _schema(id_type, dict(REPAIRED)))
    return told.filter(F.col("place").isNull()).select("conv_id", *dict(REPAIRED)).unionByName(whole)
