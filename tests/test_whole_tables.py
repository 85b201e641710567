"""Queries take all rows of their tables: results against plain loops over the table itself."""

import os
from datetime import timedelta

import pytest

import __spark_entry__ as entry
from marlstone.plans import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't there")


def pairs(spark, meets):
    """Trades and quotes of one symbol, by their events' ids, whose times (trade's, quote's) meet."""
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "event_type").collect()
    trades = [(e.event_id, e.ts, "A1" if e.event_id % 11 == 6 else e.event_type) for e in events if e.event_id % 11 not in (1, 2, 4, 7, 8)]
    return [(n, q.event_id) for n, at, symbol in trades for q in events if q.event_type == symbol and meets(at, q.ts)]


def test_quotes_around_trades_counts_every_quote(spark):
    want = {}
    for n, _ in pairs(spark, lambda at, quoted: at - timedelta(minutes=5) <= quoted < at):
        want[n] = want.get(n, 0) + 1
    assert {r.event_id: r.n_quotes for r in entry.queries()["quotes_around_trades"](spark, SF).collect()} == want


def test_stream_trade_quotes_joins_every_quote(spark):
    got = [(r.event_id, r.quote_id) for r in entry.queries()["stream_trade_quotes"](spark, SF).collect()]
    assert sorted(got) == sorted(pairs(spark, lambda at, quoted: at - timedelta(minutes=1) <= quoted <= at))


def test_streamed_messages_are_parsed_before_they_are_put_in_order(spark, monkeypatch):
    given, in_order = [], queries._in_order
    monkeypatch.setattr(queries, "_in_order", lambda s, rows, *more: given.append(rows._jdf.queryExecution().optimizedPlan().toString()) or in_order(s, rows, *more))
    assert entry.queries()["stream_trade_quotes"](spark, SF).count() > 0
    assert len(given) == 2 and all(plan.startswith("Relation") for plan in given)  # a range partitioning runs its rows twice
