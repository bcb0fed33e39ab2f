"""Archives as they lie, which part of them is asked for, records of runs, and the tables that are given out."""

import hashlib
import json
import math
import random
import re
import struct

import pytest
from pyspark.sql import functions as F

from barloom.functions import timegrid
from barloom.operators import curve as C
from barloom.operators import quality as Q
from barloom.operators import reports, runs, screens
from barloom.operators import selection as S
from barloom.operators.search import candidates, expand_grid
from barloom.operators.signals import signal
from barloom.sources import bars as B

DAY = 86_400


def walk(spark, symbol, n, seed, start=0):
    rng, last, rows = random.Random(seed), 100.0, []
    for i in range(n):
        close = last * math.exp(rng.gauss(0, 0.03))
        rows.append((symbol, "1d", start + i * DAY, last, max(last, close), min(last, close), close, 1.0 + i, close))
        last = close
    return spark.createDataFrame(rows, B.BARS)


def test_plain_archives_are_read_by_their_paths(spark, tmp_path):
    a, b = walk(spark, "AAA-USDT", 400, 1), walk(spark, "B B-USDT", 30, 2)
    base = f"{tmp_path}/data"
    a.where(f"time < {365 * DAY}").drop("symbol", "timeframe").coalesce(1).write.parquet(f"{base}/AAA-USDT/1d/1970.parquet")
    later = a.where(f"time >= {360 * DAY}").withColumn("close", F.col("close") + F.when(F.col("time") < 365 * DAY, 1).otherwise(0))
    later.drop("symbol", "timeframe").coalesce(1).write.parquet(f"{base}/AAA-USDT/1d/1971.parquet")
    b.drop("symbol", "timeframe").write.parquet(f"{base}/B B-USDT/1h/deeper/all.parquet")
    every = B.read_bars(spark, base)
    assert every.columns == B.BARS.names and every.count() == 400 + 5 + 30
    assert {tuple(r) for r in every.select("symbol", "timeframe").distinct().collect()} == {("AAA-USDT", "1d"), ("B B-USDT", "1h")}
    assert B.read_bars(spark, base, symbols=["AAA-USDT"], since=390 * DAY, until=392 * DAY).count() == 3
    assert B.read_bars(spark, base, symbols=["B B-USDT", "NONE"], timeframes=["1h", "1d"]).count() == 30 and B.read_bars(spark, base, symbols=["NONE"]).count() == 0
    merged = B.read_archive(spark, base).where("symbol = 'AAA-USDT'")
    old = {r.time: r.close for r in a.collect()}
    assert {r.time: r.close for r in merged.collect()} == {t: c + (1 if 360 * DAY <= t < 365 * DAY else 0) for t, c in old.items()}
    B.write_bars(a, f"{tmp_path}/parts")
    assert B.read_bars(spark, f"{tmp_path}/parts", timeframes=["1d"], since=10 * DAY).count() == 390
    shown = Q.inventory(Q.stored_files(spark.read.schema(B.BARS).parquet(f"{tmp_path}/parts")), "1d", spark.createDataFrame([("AAA-USDT", "1d", -5)], "symbol string, timeframe string, floor long"))
    row = shown.where("symbol is not null").first()
    assert (row.bars, row.files, row.next_time, row.floor) == (400, 2, 400 * DAY, -5) and row.bytes > 1000
    assert shown.where("timeframe is null").first().bytes == row.bytes


def test_payload_is_parallel_arrays_in_order(spark):
    bars = walk(spark, "A", 20, 3)
    (row,) = B.payload(bars.repartition(5)).collect()
    want = bars.orderBy("time").collect()
    assert row.t == [r.time for r in want] and row.c == [r.close for r in want] and len({len(row[k]) for k in "tohlcv"}) == 1


def test_selection(spark):
    assert S.parse_quotes(" usdt, btc ") == {"USDT", "BTC"} and S.parse_quotes("any") is None and S.parse_quotes("") is None
    with pytest.raises(ValueError):
        S.parse_quotes(" , ")
    bars = walk(spark, "AAA-USDT", 10, 1).unionByName(walk(spark, "BB-A-BTC", 500, 2))
    assert {r.symbol for r in S.quoted(bars, ("BTC",)).select("symbol").distinct().collect()} == {"BB-A-BTC"}
    assert S.quoted(bars, None).count() == 510
    found = lambda text: {r.symbol for r in bars.where(S.matching(F.col("symbol"), text)).select("symbol").distinct().collect()}
    assert found("/usdt") == {"AAA-USDT"} and found("bb/a") == {"BB-A-BTC"} and found("a") == {"AAA-USDT", "BB-A-BTC"} and found("x") == set()
    got = {(r.symbol, r.bars) for r in S.selected(bars, ["AAA-USDT", "NO", "NO"]).collect()}
    assert got == {("AAA-USDT", 10), ("NO", 0)}
    assert {r.bars for r in S.selected(bars, None, ["BB-A-BTC"]).collect()} == {500} and S.selected(bars).count() == 2
    assert S.selected(bars, timeframes=["1h"]).count() == 0
    counts = lambda df: {r.symbol: r["count"] for r in df.groupBy("symbol").count().collect()}
    assert counts(S.reporting_window(bars, last="30D")) == {"AAA-USDT": 10, "BB-A-BTC": 31}
    assert counts(S.reporting_window(bars, first="1970-01-09", until="1970-02-01")) == {"BB-A-BTC": 24}
    with pytest.raises(ValueError):
        S.reporting_window(bars, last="1y", first="1970-01-01")
    assert timegrid.parse_duration("1Y") == 365 * DAY and timegrid.parse_duration("2M") == 60 * DAY and timegrid.parse_duration("2m") == 120
    assert timegrid.parse_scale("10, 40%,25") == (0.1, 0.4, 0.25) and timegrid.parse_scale("off") is None
    for bad in ("1,2", "40,10,20", "a,b,c"):
        with pytest.raises(ValueError):
            timegrid.parse_scale(bad)
    assert timegrid.bars_in(5 * DAY // 2, "1d") == 2 and timegrid.bars_in(0, "1d", allow_zero=True) == 0


def test_fingerprints_are_the_hash_of_packed_bars(spark):
    bars = walk(spark, "A", 50, 4)
    rows = bars.orderBy("time").collect()
    packed = struct.pack("<q", len(rows)) + b"".join(struct.pack("<qddddd", r.time, r.open, r.high, r.low, r.close, r.volume) for r in rows)
    assert runs.fingerprints(bars.repartition(7)).first().digest == hashlib.sha256(packed).hexdigest()
    one, two = (runs.quick_fingerprints(x).first().mark for x in (bars, bars.withColumn("volume", F.col("volume") + (F.col("time") == 0).cast("int"))))
    assert one == runs.quick_fingerprints(bars.repartition(7)).first().mark != two


def test_runs_are_recorded_and_found_again(spark, tmp_path):
    bars = walk(spark, "A", 120, 5).unionByName(walk(spark, "B", 120, 6))
    path = f"{tmp_path}/runs"
    runs.append_runs(runs.record_runs(bars, "sma", {"window": 20}, "1d", "2026-01-01T00:00:00Z", note="first"), path)
    runs.append_runs(runs.record_runs(bars.where("symbol = 'A'"), "tsmom", {"lookback": 30, "rebalance": 7, "threshold": 0.0}, "1d", "2026-01-02T00:00:00Z", 0.002), path)
    runs.append_runs(runs.record_basket(bars, "sma", {"window": 20}, "1d", "2026-01-03T00:00:00Z"), path)
    stored = runs.read_runs(spark, path).where("_bad is null")
    more = bars.unionByName(walk(spark, "A", 5, 9, 120 * DAY))
    status = lambda archive: {r.run_id.split("-", 1)[1]: r.status for r in runs.verify_runs(stored, archive, "2026-02-01T00:00:00Z").collect()}
    assert status(more) == {"sma-A-1d": "verified", "sma-B-1d": "verified", "tsmom-A-1d": "verified", "basket-1d-2legs": "verified"}
    # volumes of A in its first bar, which no figure reads; the last close of B; and then no A at all
    changed = more.withColumn("volume", F.col("volume") + ((F.col("symbol") == "A") & (F.col("time") == 0)).cast("int"))
    changed = changed.withColumn("close", F.col("close") * (1 + 0.1 * ((F.col("symbol") == "B") & (F.col("time") == 119 * DAY)).cast("int")))
    assert status(changed) == {"sma-A-1d": "data-changed", "sma-B-1d": "mismatch", "tsmom-A-1d": "data-changed", "basket-1d-2legs": "mismatch"}
    stored = stored.where("strategy = 'sma'")
    assert status(more.where("symbol = 'B'")) == {"sma-A-1d": "error", "sma-B-1d": "verified", "basket-1d-2legs": "error"}
    shown = runs.run_table(stored, stored.where("kind = 'basket'").select("run_id", F.lit("verified").alias("status"))).collect()
    assert [r.run_id[:8] for r in shown] == ["20260103", "20260101", "20260101"] and shown[0].legs == 2 and shown[0].status == "verified" and shown[1].status == "-"
    assert shown[0].cagr is not None and shown[2].trades is not None
    assert runs.rebuilt("sma", {"window": "x"}) is None and runs.rebuilt("nothing", {}) is None and runs.rebuilt("sma", {"no": "1"}) is None
    with open(f"{path}/zz.json", "w") as f:
        f.write('{"run_id": "ok"}\n\n{broken\n{"label": "no id"}\n')
    assert sorted((r.line, r.text) for r in runs.bad_lines(spark, path).collect()) == [(3, "{broken"), (4, '{"label": "no id"}')]


def test_many_sets_and_baskets_are_verified_in_one_plan(spark, tmp_path):
    bars = walk(spark, "A", 150, 5).unionByName(walk(spark, "B", 150, 6))
    sets = [("sma", {"window": n}) for n in range(3, 23)] + [("macd", {"fast": 4, "slow": 9}), ("stops-sma", {"window": 9, "stop_loss": 0.03}), ("breakout", {"entry": 6, "exit_window": 3, "min_hold": 2})]
    alone = {r.run_id: r.metrics for r in runs.record_runs(bars, "stops-sma", {"window": 9, "stop_loss": 0.03}, "1d", "2026-01-01T00:00:00Z").collect()}
    recorded = runs.record_sets(bars, sets, "1d", "2026-01-01T00:00:00Z")
    got = {r.run_id: r for r in recorded.collect()}
    assert len(got) == 46 and got["20260101000000-sma-A-1d"].params == {"window": "3"} and got["20260101000000-sma-B-1d-20"].params == {"window": "22"}
    for name, metrics in alone.items():
        assert got[name].metrics == pytest.approx(metrics)
    path, at = f"{tmp_path}/runs", "2026-02-01T00:00:00Z"
    runs.append_runs(recorded, path)
    for label, name, some, fee in (("2026-01-02T00:00:00Z", "tsmom", bars, 0.002), ("2026-01-03T00:00:00Z", "sma", bars.where("time < 100 * 86400"), 0.001)):
        runs.append_runs(runs.record_basket(some, name, {}, "1d", label, fee), path)
    stored = runs.read_runs(spark, path)
    # one figure of one run and one of one basket; all others are verified
    changed = {"20260101000000-sma-B-1d-7": "fees_paid", "20260103000000-basket-1d-2legs": "legs.A.exposure"}
    off = F.transform_values("metrics", lambda k, v: F.when(F.element_at(F.create_map(*[F.lit(x) for p in changed.items() for x in p]), F.col("run_id")) == k, v + 0.01).otherwise(v))
    off = stored.withColumn("metrics", F.when(F.col("run_id").isin(*changed), off).otherwise(F.col("metrics")))
    found = runs.verify_runs(off, bars, at).collect()
    assert len(found) == 48 and {r.run_id: [m.field for m in r.mismatches] for r in found if r.status != "verified"} == {k: [v] for k, v in changed.items()}
    # sets of one rule are columns of one branch
    rows = runs.kept(bars.withColumn("__set", F.when(F.col("symbol") == "A", 0).otherwise(1)), "windows")
    plan = lambda n: runs.run_targets(rows, sets[:n])._jdf.queryExecution().executedPlan().toString()
    assert plan(2).count("Exchange ") == plan(16).count("Exchange ") and plan(16).count("Scan ") == 1 and plan(20).count("Scan ") == 2
    none = runs.verify_runs(stored.where("false"), bars, at)
    assert none.count() == 0


def test_the_index_of_newest_periods_reads_no_others(spark, tmp_path):
    bars = walk(spark, "LIVE", 1200, 1).unionByName(walk(spark, "ENDED", 500, 2)).unionByName(walk(spark, "NEW", 40, 3, 1110 * DAY))
    path = f"{tmp_path}/bars"
    B.write_bars(bars, path)
    got = {r.symbol: r for r in screens.stored_index(spark, path, "1d").collect()}
    whole = {r.symbol: r for r in screens.index(bars, "1d").collect()}
    assert set(got) == set(whole)
    for name, row in got.items():
        for c in ("time", "close", "change_1", "change_24h", "change_7d", "change_30d", "change_1y"):
            assert getattr(row, c) == (pytest.approx(getattr(whole[name], c)) if getattr(whole[name], c) is not None else None)
    # of LIVE the newest year and, for the change over a year, the one before; ENDED's last year is the second
    ends = {r.symbol: r.n for r in bars.where(F.year(F.timestamp_seconds("time")) >= 1972).groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got["LIVE"].bars == ends["LIVE"] and got["NEW"].bars == 40 and got["ENDED"].bars == 500
    plan = screens.stored_index(spark, path, "1d")._jdf.queryExecution().executedPlan().toString()
    # one scan of the newest two years, one of the two around ENDED's last; nothing is read without naming its periods
    read = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert {tuple(re.findall(r"\b19\d\d\b", f)) for f in read if f} == {("1972", "1973"), ("1970", "1971")}
    assert screens.stored_index(spark, path, "1h").count() == 0


def test_all_candidates_come_from_one_pass(spark):
    bars = walk(spark, "A", 150, 7).unionByName(walk(spark, "B", 90, 8))
    for name, grid in (("sma", expand_grid({"window": [5, 20], "rebalance": [1, 3]})), ("macd", expand_grid({"fast": [4, 6], "slow": [13]})), ("stops-sma", expand_grid({"window": [10], "stop_loss": [0.02, 0.05]}))):
        got = candidates(bars, name, grid, 0.001)
        for i, params in enumerate(grid):
            alone = {(r.symbol, r.time): r.equity for r in C.equity_curve(signal(bars, name, **params), 0.001).collect()}
            assert {(r.symbol, r.time): r.equity for r in got.where(f"candidate = {i}").collect()} == pytest.approx(alone)
    count = lambda n: candidates(bars, "sma", expand_grid({"window": list(range(2, 2 + n))}))._jdf.queryExecution().executedPlan().toString().count("Scan ")
    assert count(2) == count(20)


def test_documents_are_nested_json(spark):
    figures = spark.createDataFrame([("A", "1d", "exposure", 0.5), ("A", "1d", "strategy.cagr", 0.1), ("A", "1d", "strategy.x", None), ("A", "1d", "legs.B.fees", 2.0)], "symbol string, timeframe string, field string, value double")
    audits = spark.createDataFrame([("A", "1d", 7)], "symbol string, timeframe string, gaps long")
    (row,) = reports.summary_documents(figures, audits).collect()
    assert json.loads(row.document) == {"symbol": "A", "timeframe": "1d", "exposure": 0.5, "strategy": {"cagr": 0.1}, "legs": {"B.fees": 2.0}, "quality": {"gaps": 7}}
    trades = spark.createDataFrame([("A", "1d", 1, 0, 1.5, DAY, 2.0, 3, 0.1, 0.09, 1.0, 1.09, False)], "symbol string, timeframe string, side int, entry_time long, entry_price double, exit_time long, exit_price double, bars_held long, gross_return double, net_return double, equity_at_entry double, equity_at_exit double, open_at_end boolean")
    (line,) = reports.trade_table(trades).collect()
    assert (line.side, line.entry_time_utc, line.entry_price, line.net_return, line.open_at_end) == ("long", "1970-01-01 00:00", "1.50000000", "0.090000", "")
