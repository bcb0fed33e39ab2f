"""Books against loops that walk from date to date."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from barloom.operators import basket, crosssection, joins, riskbook, runs
from barloom.operators import curve as C
from barloom.sources.bars import BARS

DAY = 86_400


def bars_of(spark, closes):
    rows = [(s, "1d", t * DAY, p, p, p, p, 1.0, p) for s, line in closes.items() for t, p in enumerate(map(lambda x: None if x is None else float(x), line)) if p is not None]
    return spark.createDataFrame(rows, BARS)


def test_asof_and_its_age(spark):
    bars = bars_of(spark, {"A": [1.0, None, None, 4.0], "B": [None, 2.0, None, None]})
    dates = spark.createDataFrame([(0, 0), (1, 2 * DAY), (2, 5 * DAY)], "k long, date long")
    got = {(r.symbol, r.k): (r.print_close, r.close) for r in joins.asof(bars, dates, ["close"], DAY).collect()}
    assert got == {("A", 0): (1, 1), ("A", 1): (1, None), ("A", 2): (4, None), ("B", 0): (None, None), ("B", 1): (2, 2), ("B", 2): (2, None)}


def test_book_matches_a_loop(spark):
    rng = random.Random(3)
    symbols, n = ["A", "B", "C", "D"], 30
    close = {s: [100.0] for s in symbols}
    for s in symbols:
        for _ in range(n):
            close[s].append(close[s][-1] * (1 + rng.uniform(-0.1, 0.1)))
    momentum = {(s, k): rng.uniform(-1, 1) for s in symbols for k in range(n)}
    readings = spark.createDataFrame([(s, k, k * DAY, close[s][k], close[s][k], momentum[s, k]) for s in symbols for k in range(n)], "symbol string, k long, date long, close double, print_close double, momentum double")
    for long_short in (False, True):
        held = crosssection.weights(crosssection.ranked(readings, 2 if not long_short else 1, long_short))
        rows = {r.k: r for r in crosssection.book(readings, held, 0.002).collect()}
        weight = {(r.symbol, r.k): r.weight for r in held.collect()}
        equity, drifted = 1.0, dict.fromkeys(symbols, 0.0)
        for k in range(n):
            new = {s: weight.get((s, k), 0.0) for s in symbols}
            turn = sum(abs(new[s] - drifted[s]) for s in symbols)
            assert rows[k].turnover == pytest.approx(turn) and rows[k].equity == pytest.approx(equity)
            ratio = {s: close[s][k + 1] / close[s][k] if k + 1 < n else 1.0 for s in symbols}
            growth = 1 + sum(new[s] * (ratio[s] - 1) for s in symbols)
            equity *= max(1 - turn * 0.002, 0) * growth
            drifted = {s: new[s] * ratio[s] / growth for s in symbols}


def test_gates_of_a_window_match_a_loop(spark):
    from barloom.operators.crosssection import window_gates

    day, rng, rows = 86_400, random.Random(4), []
    for symbol, n in (("A", 60), ("B", 60), ("C", 4), ("D", 3)):
        for i in range(n):
            if symbol == "B" and i % 5 == 2:
                continue
            close = 0.0 if symbol == "B" and i == 33 else 50 * math.exp(rng.gauss(0, 0.1))
            rows.append((symbol, "1d", i * day, close, close, close, close, 1.0, None if rng.random() < 0.2 else float(rng.randint(1, 9))))
    dates = [(k, t * day + rng.choice((0, 5))) for k, t in enumerate((0, 1, 2, 3, 12, 35, 59))]
    gate = 9 * day
    got = {(r.symbol, r.k): (r.turnover, r.volatility) for r in window_gates(spark.createDataFrame(rows, BARS), spark.createDataFrame(dates, "k long, date long"), gate).collect()}
    want = {}
    for symbol in "ABCD":
        for k, date in dates:
            seen = [r for r in rows if r[0] == symbol and date - gate < r[2] <= date]
            turns = sorted(r[8] or 0.0 for r in seen)
            moves = [math.log(b[6] / a[6]) for a, b in zip(seen, seen[1:]) if a[6] > 0 and b[6] > 0]
            if seen:
                want[symbol, k] = (turns[len(turns) // 2] if len(seen) >= 3 else None, statistics.pstdev(moves) * 365**0.5 if len(moves) > 2 else None)
    assert got.keys() == want.keys()
    for key, (turnover, volatility) in want.items():
        assert got[key][0] == turnover and (got[key][1] is None if volatility is None else got[key][1] == pytest.approx(volatility)), key


def test_gates_that_miss_a_reading_fail(spark):
    rows = spark.createDataFrame([(0.1, -0.1), (None, -0.1), (0.1, -0.9), (-0.1, -0.1)], "trend double, below_peak double")
    assert [r.ok for r in rows.withColumn("ok", crosssection.gate_ok(trend=0.0, below_peak=0.5)).collect()] == [True, False, False, False]


def test_one_leg_basket_is_the_leg(spark):
    bars = bars_of(spark, {"A": [10.0, 11, 12, 11, 13, 14]}).withColumn("target", F.lit(1.0))
    curve = C.equity_curve(bars, 0.001)
    legs = basket.legs(curve, basket.timeline(curve))
    last = basket.combined(legs).orderBy(F.col("time").desc()).first().basket
    assert last == pytest.approx(C.summary(curve).first().final_equity)


def test_alignment_goes_stale(spark):
    bars = bars_of(spark, {"A": [1.0, None, None, None, None, None, 2.0]})
    calendar = spark.createDataFrame([(i, i * DAY) for i in range(7)], "idx long, time long")
    got = [r.price for r in joins.aligned(bars, calendar).orderBy("idx").collect()]
    assert got == [1, 1, 1, 1, None, None, 2]


def test_caps_leave_the_rest_in_cash(spark):
    rows = spark.createDataFrame([("A", 0, 0.7), ("B", 0, 0.2), ("C", 0, 0.1)], "symbol string, idx long, weight double")
    got = {r.symbol: r.weight for r in riskbook.capped(rows, 0.4).collect()}
    assert got["A"] == 0.4 and sum(got.values()) == pytest.approx(1) and max(got.values()) <= 0.4
    short = riskbook.capped(rows, 0.25).agg(F.sum("weight")).first()[0]
    assert short == pytest.approx(0.75)


def test_unit_book_matches_a_loop(spark):
    rng = random.Random(5)
    n, every, rate = 25, 5, 0.002
    price = {s: [100.0] for s in "AB"}
    for s in "AB":
        for _ in range(n):
            price[s].append(price[s][-1] * (1 + rng.uniform(-0.05, 0.05)))
    rows = spark.createDataFrame([(s, i, price[s][i]) for s in "AB" for i in range(n)], "symbol string, idx long, price double")
    target = {5: {"A": 1.0, "B": 0.0}, 10: {"A": 0.3, "B": 0.7}, 15: {"A": 0.0, "B": 0.5}, 20: {"A": 0.5, "B": 0.5}}
    weights = spark.createDataFrame([(s, d, w) for d, t in target.items() for s, w in t.items() if w], "symbol string, idx long, weight double")
    got = {r.idx: r.equity for r in riskbook.unit_book(riskbook.positions(rows, weights, every), rate).collect()}
    held, equity = {"A": 0.0, "B": 0.0}, 1.0
    for i in range(6, n):
        if i > 6:
            growth = 1 + sum(held[s] * (price[s][i] / price[s][i - 1] - 1) for s in "AB")
            held = {s: held[s] * price[s][i] / price[s][i - 1] / growth for s in "AB"}
            equity *= growth
        if i - 1 in target:
            equity *= 1 - rate * sum(abs(target[i - 1][s] - held[s]) for s in "AB")
            held = dict(target[i - 1])
        assert got[i] == pytest.approx(equity), i


def walk(price, up, targets, every, rate, gate, budget=None, window=6, per_year=50.0):
    """One bar after another: mark, sell what lost its trend, fill what was decided, decide anew."""
    symbols, n = sorted(price), len(next(iter(price.values())))
    held, equity, leaving, decided, out = {}, [1.0], [], None, {}
    for i in range(1, n):
        value = {}
        for s, share in held.items():
            a, b = price[s][i - 1], price[s][i]
            value[s] = share if a is None or b is None else share * b / a
        total = 1 - sum(held.values()) + sum(value.values())
        equity.append(equity[-1] * total)
        held = {s: v / total for s, v in value.items()}
        turnover = 0.0
        if leaving:
            turnover = sum(held.pop(s) for s in leaving)
            equity[-1] *= 1 - rate * turnover
            leaving = []
        scale = None
        if decided is not None:
            new, scale = decided
            moved = sum(abs(new.get(s, 0) - held.get(s, 0)) for s in symbols)
            equity[-1] *= 1 - rate * moved
            held, turnover, decided = dict(new), turnover + moved, None
        out[i] = (equity[-1], turnover, sum(held.values()), scale)
        if i % every:
            leaving = [s for s in held if not up[s][i]] if gate else []
        elif targets.get(i):
            scale = 1.0
            if budget is not None and len(equity) > window:
                recent = [equity[k] / equity[k - 1] - 1 for k in range(len(equity) - window, len(equity))]
                real = statistics.pstdev(recent) * per_year**0.5
                scale = min(1.0, budget / real) if real > 0 else 1.0
            decided = {s: w * scale for s, w in targets[i].items()}, scale
    return out


@pytest.mark.parametrize("seed", range(4))
def test_gated_and_budgeted_books_match_a_walk(spark, seed):
    rng = random.Random(seed)
    symbols, n, every, rate = "ABCD", 60, 4, 0.002
    price = {s: [100.0] for s in symbols}
    for s in symbols:
        for _ in range(n - 1):
            price[s].append(price[s][-1] * (1 + rng.uniform(-0.08, 0.08)))
        for k in range(n):
            if rng.random() < 0.06:
                price[s] = [None if i == k else p for i, p in enumerate(price[s])]
    up = {s: [i >= 3 and price[s][i] is not None and price[s][i - 3] is not None and price[s][i] > price[s][i - 3] for i in range(n)] for s in symbols}
    rows = spark.createDataFrame([(s, i, price[s][i]) for s in symbols for i in range(n)], "symbol string, idx long, price double")
    rows = riskbook.trend_ok(rows, 3)
    for gate in (False, True):
        targets = {}
        for d in range(every, n, every):
            names = [s for s in symbols if (up[s][d] or not gate) and price[s][d] is not None and rng.random() < 0.6 and d not in (20, 24)]
            targets[d] = {s: 0.9 / len(names) for s in names}
        weights = spark.createDataFrame([(s, d, w) for d, t in targets.items() for s, w in t.items()], "symbol string, idx long, weight double")
        held = riskbook.positions(rows, weights, every, gate)
        want = walk(price, up, targets, every, rate, gate)
        first = min(d for d, t in targets.items() if t) + 1
        got = {r.idx: r for r in riskbook.unit_book(held, rate).collect()}
        assert sorted(got) == list(range(first, n))
        for i, r in got.items():
            assert (r.equity, r.turnover, r.invested) == pytest.approx(want[i][:3], abs=1e-9), (gate, i)
        want = walk(price, up, targets, every, rate, gate, budget=0.2)
        scaled = {r.idx: r for r in riskbook.budget_scaled(riskbook.book_bars(held).withColumn("book_id", F.lit(1)), 0.2, 6, 50.0, rate).collect()}
        for i, r in scaled.items():
            assert (r.equity, r.turnover, r.invested) == pytest.approx(want[i][:3], abs=1e-9), (gate, i)
            assert want[i][3] is None or r.scale == pytest.approx(want[i][3])
        assert len(scaled) == len(got) and (gate or min(r.scale for r in scaled.values()) < 1)


def test_a_name_whose_trend_fails_is_not_bought(spark):
    rows = spark.createDataFrame([(s, i, 100.0 - i if s == "DOWN" else 100.0 + i) for s in ("DOWN", "UP") for i in range(20)], "symbol string, idx long, price double")
    rows = riskbook.trend_ok(rows.withColumn("turnover", F.lit(1.0)).withColumn("first_idx", F.lit(0)), 2)
    chosen = riskbook.universe(rows, 2, 2, 5, carry=("up",))
    weights = riskbook.weighted(chosen.where("up")).select("symbol", "idx", "weight")
    held = riskbook.positions(rows, weights, 5, gate=True)
    assert {r.symbol for r in held.collect()} == {"UP"}
    assert riskbook.unit_book(held, 0.0).agg(F.min("growth")).first()[0] >= 1


def test_a_restricted_book_restates_its_costs_and_buys_the_hold_anew(spark):
    book = spark.createDataFrame([(i, 2.0 + i, 0.1, 1.0, 0.5) for i in range(6)], "idx long, equity double, cost double, invested double, turnover double")
    hold = spark.createDataFrame([(i, 10.0 * (i + 1)) for i in range(6)], "idx long, hold double")
    got = riskbook.restricted(book, 2, None, hold, 0.01).orderBy("idx").collect()
    assert [r.idx for r in got] == [0, 1, 2, 3] and got[0].equity == 1 and got[1].cost == pytest.approx(0.025)
    assert [r.hold for r in got] == pytest.approx([0.99, 0.99 * 4 / 3, 0.99 * 5 / 3, 1.98])
    assert riskbook.restricted(book, 4).count() == 0


def test_run_records_and_tampering(spark, tmp_path):
    bars = bars_of(spark, {"A": [1.0, 2, 3], "B": [2.0, 2, 2]})
    marks = {r.symbol: (r.bars, r.digest) for r in runs.fingerprints(bars.repartition(3)).collect()}
    assert marks == {r.symbol: (r.bars, r.digest) for r in runs.fingerprints(bars).collect()} and marks["A"] != marks["B"]
    changed = bars.withColumn("close", F.when((F.col("symbol") == "A") & (F.col("time") == DAY), 2.5).otherwise(F.col("close")))
    again = {r.symbol: (r.bars, r.digest) for r in runs.fingerprints(changed).collect()}
    assert again["A"] != marks["A"] and again["B"] == marks["B"]
    path = f"{tmp_path}/runs"
    runs.append_runs(spark.createDataFrame([("r1", "sma")], "run_id string, strategy string"), path)
    with open(f"{path}/bad.json", "w") as f:
        f.write("{not json\n")
    back = runs.read_runs(spark, path).collect()
    assert sorted(str(r.run_id) for r in back) == ["None", "r1"] and any(r._bad for r in back)


def test_permutation_lends_every_reading_once(spark):
    rows = spark.createDataFrame([(s, 0, float(i)) for i, s in enumerate("ABCDE")], "symbol string, k long, momentum double")
    got = crosssection.permuted(rows, ["momentum"], 3).collect()
    assert sorted(r.momentum for r in got) == [0, 1, 2, 3, 4] and len({r.symbol for r in got}) == 5
