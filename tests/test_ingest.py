"""Loads into an archive and their reports, unions of intervals, floors, plans by months, tables of trades, corrected streams."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from barloom.operators import quality, runs, screens
from barloom.sources import bars as B

WEEK, DAY = 604_800, 86_400
SCHEMA = "symbol string, timeframe string, time long, open double, high double, low double, close double, volume double, turnover double"


def bar(symbol, time, close=10.0, timeframe="1d", high=None):
    return (symbol, timeframe, time, close, high or close, close, close, 1.0, close)


def moment(*date):
    return int(datetime(*date, tzinfo=timezone.utc).timestamp())


def stored(spark, path):
    return {(r.symbol, r.time): r.close for r in B.read_bars(spark, path).collect()}


def report(df):
    return {r.symbol: r for r in df.collect()}


def test_a_load_writes_what_is_new_and_says_so(spark, tmp_path):
    path, y0, y1 = f"{tmp_path}/archive", moment(2020, 3, 1), moment(2021, 3, 1)
    first = spark.createDataFrame([bar("A", y0 + k * DAY) for k in range(5)] + [bar("A", y1)], SCHEMA).withColumn("seq", F.col("time"))
    dry = report(B.ingest(spark, path, first, "seq", dry_run=True))
    assert (dry["A"].fetched, dry["A"].added, dry["A"].files_changed) == (6, 6, 0) and not (tmp_path / "archive").exists()
    made = report(B.ingest(spark, path, first, "seq"))
    assert (made["A"].added, made["A"].net, made["A"].files_changed, made["A"].files_unchanged, made[None].added) == (6, 6, 2, 0, 6)
    before = stored(spark, path)
    again = report(B.ingest(spark, path, first, "seq"))
    assert (again["A"].added, again["A"].refreshed, again["A"].files_changed, again["A"].files_unchanged) == (0, 0, 0, 2) and stored(spark, path) == before
    # a changed bar, a repeat of which the first counts, an invalid one that is kept, one that is rejected, a new series
    rows = [(*bar("A", y0, 11.0), 0, True), (*bar("A", y0, 12.0), 1, True), (*bar("A", y0 + 9 * DAY, 10.0, high=9.0), 2, True), (*bar("A", y1 + DAY), 3, False), (*bar("B", y0, 5.0), 4, True)]
    fresh = spark.createDataFrame(rows, SCHEMA + ", seq int, ok boolean")
    dry = report(B.ingest(spark, path, fresh, "seq", dry_run=True))
    assert (dry["A"].fetched, dry["A"].rejected, dry["A"].added, dry["A"].refreshed, dry["B"].added) == (4, 1, 0, 0, 1) and stored(spark, path) == before
    got = report(B.ingest(spark, path, fresh, "seq"))
    assert (got["A"].rejected, got["A"].invalid, got["A"].added, got["A"].refreshed, got["A"].files_changed, got["A"].files_unchanged) == (1, 1, 1, 1, 1, 0)
    assert (got[None].fetched, got[None].added, got[None].files_changed, got["A"].last_time) == (5, 2, 2, y1)
    assert stored(spark, path) == before | {("A", y0): 11.0, ("A", y0 + 9 * DAY): 10.0, ("B", y0): 5.0}
    none = report(B.ingest(spark, path, fresh.where("false"), "seq"))
    assert set(none) == {None} and stored(spark, path)[("B", y0)] == 5.0


def test_intervals_that_overlap_touch_or_nest_are_one(spark):
    rows = [("A", 0, 100), ("A", 10, 20), ("A", 90, 150), ("A", 151, 160), ("A", 162, 170), ("B", 5, 5), ("B", 5, 5), ("B", 7, 8)]
    table = spark.createDataFrame([(s, "1d", a, z) for s, a, z in rows], "symbol string, timeframe string, first_time long, last_time long")
    union = lambda touch: sorted((r.symbol, r.first_time, r.last_time, r.parts) for r in quality.merged_intervals(table, touch).collect())
    assert union(1) == [("A", 0, 160, 4), ("A", 162, 170, 1), ("B", 5, 5, 2), ("B", 7, 8, 1)]
    assert union(0) == [("A", 0, 150, 3), ("A", 151, 160, 1), ("A", 162, 170, 1), ("B", 5, 5, 2), ("B", 7, 8, 1)]
    assert union(2) == [("A", 0, 170, 5), ("B", 5, 8, 3)]


def test_floors_and_month_plans(spark):
    bars = spark.createDataFrame([bar(s, 1000) for s in "ABCDEF"], SCHEMA)
    meta = [("A", 500, None, False), ("B", 1500, None, False), ("C", 500, 700, False), ("D", None, 700, False), ("E", 500, None, True)]
    found = quality.history_floor(spark.createDataFrame([(s, "1d", *r) for s, *r in meta], "symbol string, timeframe string, floor long, start long, full boolean"), bars)
    assert {r.symbol: r.floor for r in found.collect()} == {"A": 500, "B": 1000, "C": 500, "D": 700, "E": 1000, "F": 1000}
    months = spark.createDataFrame([bar("A", moment(2020, 3, 1), timeframe="1mon"), bar("A", moment(2020, 6, 1), timeframe="1mon")], SCHEMA)
    plan = sorted((r.side, r.from_time, r.to_time) for r in quality.fetch_plan(months, "1mon", moment(2019, 11, 15), moment(2020, 12, 9), 3).collect())
    assert plan == [("head", moment(2019, 11, 1), moment(2020, 2, 1)), ("head", moment(2020, 2, 1), moment(2020, 3, 1)), ("tail", moment(2020, 7, 1), moment(2020, 10, 1)), ("tail", moment(2020, 10, 1), moment(2020, 12, 1))]


def test_tables_of_trades_are_held_against_the_runs(spark):
    line = {"side": "long", "entry_time_utc": "a", "exit_time_utc": "b", "bars_held": "3", "open_at_end": None, "entry_price": "1.00000000", "exit_price": "2.00000000", "gross_return": "1.000000", "net_return": "0.990000"}
    names = list(line)
    table = lambda rows: spark.createDataFrame([(f, n, *({**line, **c}[k] for k in names)) for f, n, c in rows], "trades_file string, n int, " + ", ".join(f"{k} string" for k in names))
    actual = [(r, n, "long", "a", "b", 3, "", 1.0, 2.0, 1.0, 0.99) for r in "pqrs" for n in range(2)]
    actual = spark.createDataFrame(actual, "run_id string, n int, side string, entry_time_utc string, exit_time_utc string, bars_held long, open_at_end string, entry_price double, exit_price double, gross_return double, net_return double")
    named = spark.createDataFrame([("p", "P"), ("q", "Q"), ("r", "R"), ("s", None), ("t", "T")], "run_id string, trades_file string")
    recorded = table([("P", 0, {}), ("P", 1, {"exit_price": "2.00000001"}), ("Q", 0, {"exit_price": "2.0000001", "side": "short"}), ("Q", 1, {"net_return": "x"}), ("R", 0, {}), ("T", 0, {})])
    got = sorted((r.run_id, r.field, r.recorded, r.actual) for r in runs.trade_tables_compared(named, recorded, actual).collect())
    assert got == [("q", "trades[0].exit_price", "2.0000001", "2.0"), ("q", "trades[0].side", "short", "long"), ("q", "trades[1].net_return", "x", "0.99"), ("r", "trades.rows", "1", "2"), ("t", "trades.rows", "1", "0")]
    gone = runs.trade_tables_compared(named.where("run_id = 'p'"), recorded.where("false"), actual)
    assert [(r.field, r.actual) for r in gone.collect()] == [("trades_file", "missing")]


@pytest.mark.parametrize("lookback", [30 * DAY, 400 * DAY])
def test_screens_count_bars_in_calendar_time(spark, lookback):
    rows = [bar("A", k * DAY, 100.0 + k % 7 + k * 0.1) for k in range(120)] + [bar("B", k * WEEK, 100.0 + k % 5, "1w") for k in range(60)] + [bar("C", k * DAY, 5.0) for k in range(30)]
    got = {r.timeframe: r.n for r in screens.archive_screen(spark.createDataFrame(rows, SCHEMA), lookback, 7 * DAY).collect()}
    # C is too short for a lookback of 30 days and 20 bars more; over 400 days a week's series of 60 bars is as well
    assert got == ({"1d": 1, "1w": 1} if lookback == 30 * DAY else {})
