"""Operators against small literal frames and against loops that walk bar by bar."""

import math
import random

import pytest
from pyspark.sql import functions as F

from barloom.functions import scalars, timegrid
from barloom.operators import curve as C
from barloom.operators import indicators as I
from barloom.operators import quality as Q
from barloom.operators.folds import ema_of, rsi_of
from barloom.operators.performance import performance
from barloom.operators.search import chosen, expand_grid, scores, series_splits, split_bounds, stitched
from barloom.operators.signals import SIGNALS, describe, register_signal, signal
from barloom.sources import bars as B

START, HOUR = 1_507_161_600, 3600


def make(spark, closes, symbol="TOY-USDT", highs=None, lows=None, opens=None):
    rows, last = [], closes[0]
    for i, c in enumerate(closes):
        o = opens[i] if opens else last
        rows.append((symbol, "1h", START + i * HOUR, float(o), float(highs[i] if highs else max(o, c)), float(lows[i] if lows else min(o, c)), float(c), 1.0, float(c)))
        last = c
    return spark.createDataFrame(rows, B.BARS)


def walk(n, seed=1):
    rng, x, out = random.Random(seed), 100.0, []
    for _ in range(n):
        x *= math.exp(rng.gauss(0, 0.03))
        out.append(x)
    return out


def listed(df, *cols):
    rows = df.orderBy("time").select(*cols).collect()
    return [r[0] for r in rows] if len(cols) == 1 else [tuple(r) for r in rows]


def test_grid(spark):
    df = spark.createDataFrame([(1_600_000_123,), (0,), (-1,)], "time long")
    got = df.select(*[timegrid.align(F.col("time"), tf) for tf in ("1h", "1w", "1mon")]).collect()
    assert tuple(got[0]) == (1_599_998_400, 1_599_696_000, 1_598_918_400)
    assert tuple(got[2]) == (-3600, -604_800, -2_678_400)
    month_end = spark.createDataFrame([(1_580_428_800,)], "time long")  # 2020-01-31
    assert month_end.select(timegrid.shift(F.col("time"), 1, "1mon")).first()[0] == 1_582_934_400  # 2020-02-29
    assert timegrid.parse_duration("2w") == 1_209_600 and timegrid.bars_per_year("1mon") == 12
    assert timegrid.parse_duration("3M") == timegrid.parse_duration("3mon") == 90 * 86_400 and timegrid.parse_fraction("-3%") == -0.03
    for bad in ("", "5", "5q"):
        with pytest.raises(ValueError):
            timegrid.parse_duration(bad)


def test_quality_counts_by_hand(spark):
    bars = make(spark, [1.0] * 20).where(f"time <> {START + 3 * HOUR} and time not between {START + 6 * HOUR} and {START + 8 * HOUR}")
    q = Q.quality(bars, "1h").first()
    assert (q.bars, q.gaps, q.missing, q.largest_gap_slots, q.bad_ohlc, q.non_positive) == (16, 2, 4, 4, 0, 0)
    v = Q.verify(bars, "1h").first()
    assert (v.missing, v.expected, v.duplicates, len(v.gaps), v.gaps[0].missing, v.clean) == (4, 20, 0, 1, 3, False)
    assert Q.verify(make(spark, [1.0] * 5), "1h").first().clean
    assert Q.quality(bars.limit(0), "1h").count() == 0
    assert Q.islands(bars, "1h").count() == 3


def test_merge_fresh_wins_and_first_of_fresh(spark):
    old = make(spark, [1, 2, 3])
    fresh = make(spark, [1, 5, 3, 9]).withColumn("seq", F.lit(0)).unionByName(make(spark, [1, 7, 3, 9]).withColumn("seq", F.lit(1)))
    merged = B.merge_bars(old, fresh, seq="seq")
    assert listed(merged, "close", "origin") == [(1, "same"), (5, "refreshed"), (3, "refreshed"), (9, "added")]
    again = B.merge_bars(merged.drop("origin"), fresh, seq="seq")
    assert {r.origin for r in again.collect()} == {"same"}


def test_write_and_read_by_partition(spark, tmp_path):
    path = f"file://{tmp_path}/bars"
    B.write_bars(make(spark, walk(50)), path)
    B.write_bars(make(spark, walk(50, 2), "B-USDT"), path)
    assert B.read_bars(spark, path, symbols=["B-USDT"]).count() in (0, 50)
    assert B.read_bars(spark, path, since=START + 10 * HOUR).columns == B.BARS.names


def test_raw_rows(spark):
    raw = [("S", "1h", '["1507161600","1","2","3","0.5","10","20"]'), ("S", "1h", "[1507165200000,1,2,3,0.5,10]"), ("S", "1h", '["x"]'), ("S", "1h", "nonsense"), ("S", "1h", None)]
    got = B.parse_raw_rows(spark.createDataFrame(raw, "symbol string, timeframe string, payload string")).collect()
    assert [r.ok for r in got] == [True, True, False, False, False]
    assert (got[0].open, got[0].close, got[0].high, got[0].low, got[0].turnover) == (1, 2, 3, 0.5, 20) and got[1].time == 1_507_165_200


def test_indicators_by_hand(spark):
    assert ema_of([1, 2, 3, None, 5], 2) == [None, 1.5, 2.5, 2.5, pytest.approx(4.1666667)]
    assert rsi_of([1, 2, 3, 2, 2], 2)[:3] == [None, None, 100.0] and rsi_of([5] * 4, 2)[3] == 50
    bars = make(spark, [1, 2, 3, 4, 2])
    assert listed(bars.withColumn("m", I.sma(3)), "m") == [None, None, 2, 3, 3]
    assert listed(bars.withColumn("h", I.channel_high(2)), "h") == [None, None, 2, 3, 4]
    assert listed(bars.withColumn("d", I.drawdown()), "d")[-1] == -0.5


def test_decisions_catch_up_after_a_gap(spark):
    bars = make(spark, [1.0] * 30).where(f"time < {START + 7 * HOUR} or time > {START + 19 * HOUR}")
    got = listed(I.decisions(I.step_of(bars), 3), "time", "decide")
    grid = -(-START // (3 * HOUR)) * 3 * HOUR
    want = []
    for t, _ in got:
        want.append(t >= grid)
        grid += 3 * HOUR * (t >= grid)
    assert [d for _, d in got] == want


def run_loop(opens, closes, targets, exits, rate):
    equity, pos, out = 1.0, 0.0, [1.0]
    for i in range(1, len(opens)):
        mark = exits[i - 1] if exits[i - 1] is not None and pos else opens[i]
        equity *= 1 + pos * (mark / opens[i - 1] - 1)
        want = targets[i - 1] if equity > 0 else 0.0
        equity *= (1 - rate) ** abs(want - pos) if equity > 0 else 0
        equity, pos = max(equity, 0.0), want
        out.append(equity)
    return out


def test_curve_matches_a_walk_and_trades_multiply_up(spark):
    rng = random.Random(7)
    for seed in range(3):
        closes = walk(120, seed)
        bars = make(spark, closes)
        targets = [rng.choice([0.0, 0.5, 1.0, -1.0]) for _ in closes]
        exits = [None if rng.random() < 0.8 else c * 1.01 for c in closes]
        extra = spark.createDataFrame([(START + i * HOUR, t, e) for i, (t, e) in enumerate(zip(targets, exits, strict=True))], "time long, target double, exit_price double")
        curve = C.equity_curve(bars.join(extra, "time"), 0.001)
        opens = [closes[0], *closes[:-1]]
        assert listed(curve, "equity") == pytest.approx(run_loop(opens, closes, targets, exits, 0.001), rel=1e-12)
        check = C.book_check(C.trades(curve), C.summary(curve)).first()
        assert check.ok, check


def test_ruin_stays_at_nothing(spark):
    closes = [100, 100, 100, 250, 240, 230]
    bars = make(spark, closes).withColumn("target", F.lit(-1.0))
    curve = C.equity_curve(bars, 0.0)
    equity = listed(curve, "equity")
    assert equity[-1] == 0 and C.summary(curve).first().ruined
    assert C.trades(curve).first().net_return == -1


def test_performance_of_a_flat_and_a_falling_curve(spark):
    flat = make(spark, [1.0] * 10).withColumn("equity", F.lit(1.0))
    p = performance(flat, 8760.0).first()
    assert (p.total_return, p.ann_vol, p.sharpe, p.max_drawdown, p.dd_start) == (0, 0, 0, 0, None)
    falling = make(spark, [4, 5, 2, 3]).withColumn("equity", F.col("close"))
    p = performance(falling, 8760.0).first()
    assert p.max_drawdown == pytest.approx(-0.6) and (p.dd_start, p.dd_end) == (START + HOUR, START + 2 * HOUR)


SMALL = {
    "sma": {"window": 5}, "sma-ls": {"window": 5}, "sma-rev": {"window": 5}, "sma-rev-ls": {"window": 5}, "macd": {"fast": 3, "slow": 6, "signal": 3},
    "macd-ls": {"fast": 3, "slow": 6, "signal": 3}, "breakout": {"entry": 6, "exit_window": 3, "min_hold": 2}, "breakout-ls": {"entry": 6, "exit_window": 3},
    "tsmom": {"lookback": 6, "rebalance": 3}, "tsmom-ls": {"lookback": 6, "rebalance": 3}, "tsmom-blend": {"base": 2, "horizons": 2, "rebalance": 3},
    "voltarget-sma": {"window": 5}, "voltarget-sma-ls": {"window": 5}, "voltarget-tsmom": {"lookback": 6, "rebalance": 3}, "volfilter-sma": {"window": 5},
    "volfilter-tsmom": {"lookback": 6, "rebalance": 3}, "voltarget-volfilter-sma": {"window": 5}, "stops-sma": {"window": 5, "stop_loss": 0.02, "trail": 0.03},
    "stops-breakout": {"entry": 6, "exit_window": 3, "take_profit": 0.05}, "voltarget-stops-sma": {"window": 5, "stop_loss": 0.02},
}


@pytest.mark.parametrize("name", sorted(SIGNALS))
def test_signals_look_back_only_and_warm_up_flat(spark, name):
    closes = walk(70, 3)
    changed = [*closes[:50], *[c * (2 if i % 2 else 0.5) for i, c in enumerate(closes[50:])]]
    both = make(spark, closes, "A").unionByName(make(spark, changed, "B"))
    rows = signal(both, name, **SMALL.get(name, {})).orderBy("symbol", "time").collect()
    a, b = ([r.target for r in rows if r.symbol == s] for s in "AB")
    assert a[:50] == b[:50]
    assert a[0] == 0 and all(-1 <= t <= 1 for t in a)
    if not name.endswith("-ls"):
        assert min(a) >= 0
    if "rebalance" not in SIGNALS[name].defaults:
        assert any(a), "the rule never does anything here"


def test_registry_refuses_what_it_does_not_know(spark):
    bars = make(spark, [1.0, 2.0])
    with pytest.raises(ValueError, match="unknown signal"):
        signal(bars, "nope")
    with pytest.raises(ValueError, match="takes"):
        signal(bars, "sma", colour=1)
    with pytest.raises(ValueError, match="already"):
        register_signal("sma", lambda b: b, "x")
    assert len(describe()) == 22


def test_stops_fill_at_the_level_or_worse(spark):
    closes = [10, 11, 12, 13, 14, 14, 14, 14]
    lows = [10, 10, 11, 12, 13, 9, 14, 14]
    bars = make(spark, closes, lows=lows, highs=[15] * 8)
    rows = signal(bars, "stops-sma", window=2, stop_loss=0.1, cooldown=1).orderBy("time").collect()
    assert [r.target for r in rows] == [0, 1, 1, 1, 1, 0, 0, 0]
    assert rows[5].exit_price == pytest.approx(11 * 0.9)


def test_splits_and_grids(spark):
    assert [tuple(r) for r in split_bounds(spark, 10, 4, 3).collect()] == [(0, 0, 4, 7), (1, 3, 7, 10)]
    assert split_bounds(spark, 6, 4, 3).count() == 0
    assert expand_grid({"b": [1, 2], "a": [3]}) == [{"a": 3, "b": 1}, {"a": 3, "b": 2}]
    with pytest.raises(ValueError):
        expand_grid({"a": list(range(401))})


def test_splits_of_each_series_reach_its_last_whole_test(spark):
    rows, want = [], []
    for name, n in (("A", 10), ("B", 12), ("C", 13), ("D", 6)):
        rows += [(name, "1d", c, i, i * 86400, 1.0 + i, 1.0 + i, 1.0 + i * (c + 1)) for c in range(2) for i in range(n)]
        want += [(name, "1d", s, 3 * s, 3 * s + 4, 3 * s + 7) for s in range(9) if 3 * s + 7 <= n]
    curves = spark.createDataFrame(rows, "symbol string, timeframe string, candidate int, i int, time long, open double, close double, equity double")
    splits = series_splits(curves.where("candidate = 0"), 4, 3)
    assert sorted(map(tuple, splits.collect())) == want
    scored = scores(curves, splits, 365.0)
    assert sorted((r.symbol, r.split, r.candidate) for r in scored.collect()) == sorted((w[0], w[2], c) for w in want for c in range(2))
    got = sorted((r.symbol, r.split, r.i) for r in stitched(curves, splits, chosen(scored)).collect())
    assert got == sorted((w[0], w[2], i) for w in want for i in range(w[4], w[5]))
    alike = split_bounds(spark, 10, 4, 3)
    assert {(r.symbol, r.split) for r in scores(curves.where("symbol = 'A'"), alike, 365.0).collect()} == {("A", 0), ("A", 1)}


def test_targets_out_of_range_fail(spark):
    bars = make(spark, [1.0, 2.0]).withColumn("target", F.lit(-0.5))
    assert C.check_targets(bars).count() == 2
    with pytest.raises(Exception, match="target out of range"):
        C.check_targets(bars, spot_only=True).collect()


def test_scalars(spark):
    df = spark.createDataFrame([(1536.0, 0.5, -2.0)], "b double, x double, y double")
    got = df.select(scalars.human_bytes(F.col("b")), scalars.pct(F.col("x")), scalars.cagr(F.col("y"), F.lit(1.0)), scalars.impact_fraction(F.lit(1.0), F.lit(0.0), F.lit(1.0))).first()
    assert tuple(got) == ("1.5 KiB", "50.00%", 0.0, None)
