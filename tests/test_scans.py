"""Smoothings as scans against plain recurrences, walks carried over slices, many parameter sets in one pass."""

import math
import random

import pytest
from pyspark.sql import functions as F

from barloom.operators import curve as C
from barloom.operators import indicators as I
from barloom.operators import scans
from barloom.operators.folds import ema_of, rsi_of, sliced
from barloom.operators.search import candidates, expand_grid
from barloom.operators.signals import SIGNALS, register_signal, signal, targets

DAY = 86_400
SCHEMA = "symbol string, timeframe string, time long, open double, high double, low double, close double, volume double, turnover double"


def bars_of(spark, series, timeframe="1d", step=DAY):
    """Bars from symbol -> closes; a close of "hole" leaves its time out, None is a bar without a close."""
    rows = []
    for symbol, closes in series.items():
        last = 100.0
        for k, c in enumerate(closes):
            if c == "hole":
                continue
            o = last if c is None else (last + c) / 2
            spread = 1.01 + 0.02 * ((k * 7919) % 5)
            rows.append((symbol, timeframe, 3 * step + k * step, o, (c or o) * spread, (c or o) / spread, c, 1.0, 5.0))
            last = c or last
    return spark.createDataFrame(rows, SCHEMA)


def walk(n, seed, missing=0.0, holes=0.0):
    rng, price, out = random.Random(seed), 100.0, []
    for _ in range(n):
        price *= 1 + rng.gauss(0, 0.05)
        out.append("hole" if rng.random() < holes else None if rng.random() < missing else price)
    return out


def by_symbol(df, *columns):
    out = {}
    for r in df.orderBy("symbol", "time").collect():
        out.setdefault(r["symbol"], []).append(tuple(r[c] for c in columns))
    return out


def near(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert (x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)), (x, y)


SERIES = {
    "A": walk(400, 1, missing=0.1, holes=0.2), "B": [None] * 60 + walk(150, 2), "C": walk(3, 3), "D": [None] * 20, "E": [50.0] * 120,
    "F": walk(10, 4) + ["hole"] * 500 + walk(40, 5), "G": walk(1, 6),
}


@pytest.mark.parametrize("slice_bars", [1, 7, 50, 4096])
def test_smoothings_equal_the_recurrence(spark, slice_bars):
    bars = bars_of(spark, SERIES)
    got = by_symbol(scans.with_emas(bars, [1, 2, 20, 90], slice_bars=slice_bars), "close", "ema1", "ema2", "ema20", "ema90")
    assert set(got) == set(SERIES)
    for rows in got.values():
        closes = [r[0] for r in rows]
        for k, n in enumerate((1, 2, 20, 90)):
            near([r[k + 1] for r in rows], ema_of(closes, n))
    full = {k: [c for c in v if c is not None] for k, v in SERIES.items()}
    for rows in by_symbol(scans.with_rsis(bars_of(spark, full), [1, 2, 14], slice_bars), "close", "rsi1", "rsi2", "rsi14").values():
        for k, n in enumerate((1, 2, 14)):
            near([r[k + 1] for r in rows], rsi_of([r[0] for r in rows], n))


def test_macd_of_a_grid_equals_the_recurrence(spark):
    grid = [(3, 8, 4), (3, 8, 6), (5, 9, 4)]
    got = by_symbol(scans.with_macds(bars_of(spark, SERIES), grid, slice_bars=16), "close", *[f"{c}{k}" for k in range(3) for c in ("line", "trigger")])
    for rows in got.values():
        closes = [r[0] for r in rows]
        for k, (fast, slow, n) in enumerate(grid):
            line = [None if a is None or b is None else a - b for a, b in zip(ema_of(closes, fast), ema_of(closes, slow), strict=True)]
            near([r[1 + 2 * k] for r in rows], line)
            near([r[2 + 2 * k] for r in rows], ema_of(line, n))
    flat = by_symbol(signal(bars_of(spark, {"E": [100.1] * 90}), "macd-ls", fast=3, slow=8, signal=4), "target")
    assert {r[0] for r in flat["E"]} == {0.0}
    with pytest.raises(ValueError):
        scans.with_macds(bars_of(spark, SERIES), [(8, 3, 4)])


def test_no_series_is_a_task_of_its_own(spark):
    plan = I.with_ema(bars_of(spark, SERIES), 20)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
    # windows over bars are by slice; those by series alone run over a row a slice
    for line in plan.splitlines():
        if "Window [" in line and "close" in line:
            assert "__slice" in line.split("], [")[1], line


WALKED = [
    ("breakout", {"entry": 6, "exit_window": 3, "min_hold": 4}), ("breakout-ls", {"entry": 6, "exit_window": 3, "min_hold": 2}), ("rsi-rev", {"window": 2, "max_hold": 3}),
    ("rsi-rev-ls", {"window": 3}), ("stops-sma", {"window": 5, "stop_loss": 0.05, "trail": 0.06, "take_profit": 0.2, "cooldown": 3}), ("voltarget-stops-sma", {"window": 5, "stop_loss": 0.05, "vol_window": 30}),
]


def test_walks_in_slices_give_the_same_targets(spark):
    series = {"A": walk(120, 11, holes=0.1), "B": ["hole"] * 70 + walk(50, 12), "C": walk(20, 13), "D": walk(15, 14) + ["hole"] * 80 + walk(20, 15)}
    bars = bars_of(spark, series)
    for name, params in WALKED[:1] + WALKED[2:3] + WALKED[4:5]:
        columns = ["target"] + (["exit_price"] if "stops" in name else [])
        whole = by_symbol(signal(bars, name, **params), "time", *columns)
        assert len({r[1] for rows in whole.values() for r in rows}) > 1
        for cuts in ([60 * DAY], [DAY * k for k in range(5, 125, 24)]):
            with sliced(cuts):
                assert by_symbol(signal(bars, name, **params), "time", *columns) == whole, (name, cuts)
    held = signal(bars, "sma", window=5)
    whole = by_symbol(C.overlay(held, 0.05, 0.3, 0.2), "time", "scaled", "scaled_equity")
    with sliced([DAY * k for k in (50, 51)]):
        assert by_symbol(C.overlay(held, 0.05, 0.3, 0.2), "time", "scaled", "scaled_equity") == whole
    with pytest.raises(ValueError), sliced([5, 3]):
        signal(bars, "rsi-rev")


def test_every_rule_gives_the_same_alone_and_among_many(spark):
    bars = bars_of(spark, {"A": walk(90, 21), "B": walk(60, 22)})
    for name, params in WALKED + [("macd", {"fast": 3, "slow": 7, "signal": 3}), ("breakout", {"entry": 5, "exit_window": 4}), ("voltarget-sma", {"window": 6, "vol_window": 25}), ("volfilter-sma", {"window": 6})]:
        key = SIGNALS[name].sweep
        grid = [params, {**params, key: SIGNALS[name].filled(params)[key] * 2 or 0.1}]
        if name == "breakout":
            grid.append({**params, "min_hold": 0 if params.get("min_hold") else 3})
        many = by_symbol(targets(bars, name, grid), "time", *[f"__target{i}" for i in range(len(grid))])
        for i, given in enumerate(grid):
            alone = by_symbol(signal(bars, name, **given), "time", "target")
            assert {s: [(r[0], r[1 + i]) for r in rows] for s, rows in many.items()} == alone, (name, given)


def test_plans_of_walked_rules_do_not_grow_with_candidates(spark):
    bars = bars_of(spark, {"A": walk(30, 31)})

    def shape(name, grid):
        plan = candidates(bars, name, grid)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange"), plan.count("InPandas") + plan.count("InArrow") + plan.count("EvalPython")

    for name, axes in (("rsi-rev", {"window": [2, 3], "max_hold": [3, 5, 8, 9]}), ("macd", {"fast": [3, 4], "slow": [8, 9, 10, 11]}), ("breakout", {"entry": [4, 5, 6, 7], "min_hold": [2, 3]}), ("stops-sma", {"window": [3, 4], "stop_loss": [0.1, 0.2, 0.3, 0.4]})):
        grid = expand_grid(axes)
        few, many = shape(name, grid[:2]), shape(name, grid)
        assert few == many and few[1] == (0 if name == "macd" else 1), (name, few, many)


def test_own_rules_can_be_swept(spark):
    if "after-up" not in SIGNALS:
        register_signal("after-up", lambda bars, n=1: bars.withColumn("target", F.coalesce((I.change(n) > 0).cast("double"), F.lit(0.0))), "n")
    got = targets(bars_of(spark, {"A": walk(10, 41)}), "after-up", [{"n": 1}, {"n": 3}])
    assert {"__target0", "__target1"} <= set(got.columns)
    with pytest.raises(ValueError):
        targets(got, "after-up", [{"x": 1}])
