"""Queries of joins in time, costs, baskets and ranked books."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from barloom.operators import basket as K
from barloom.operators import costs
from barloom.operators import crosssection as X
from barloom.operators import curve as C

from barloom.operators import joins as J
from barloom.operators.quality import coverage, merged_intervals
from barloom.operators.signals import masked, signal
from barloom.plans.base import FIXTURES, W, on_bars, on_tables, r6, rounded
from barloom.plans.rules_plans import CURVE, RULES, SMA20, TRADES
from barloom.sources.bars import KEY
from barloom.sources.derived import table

WEEK = 604_800
LOOK, AGE, EVERY, TOP, RATE = 13 * WEEK, 5 * WEEK, 4, 5, 0.001
CALENDAR = "Brand#11"



def dates_sql(every):
    return f"""cal AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS j, min(time) OVER () AS t0 FROM bars WHERE symbol = '{CALENDAR}'),
cst AS (SELECT CAST(floor(median(gap)) AS BIGINT) * {every} AS span FROM (SELECT time - lag(time) OVER (ORDER BY time) AS gap FROM cal)),
due AS (SELECT time, j, greatest(0, CASE WHEN time >= (t0 + span - 1) // span * span THEN (time - (t0 + span - 1) // span * span) // span + 1 ELSE 0 END) - j AS d FROM cal, cst),
taken AS (SELECT time, j + least(1, min(d) OVER (ORDER BY time)) AS p FROM due),
dates AS (SELECT row_number() OVER (ORDER BY time) - 1 AS k, time AS date FROM (SELECT *, lag(p) OVER (ORDER BY time) AS p1 FROM taken) WHERE p > coalesce(p1, 0))"""


DATES = dates_sql(EVERY)
on_bars("xs1_rebalance_dates", "brands", lambda b: X.rebalance_dates(b, CALENDAR, EVERY), f"{DATES} SELECT k, date FROM dates")


def read(bars):
    return X.panel(bars, X.rebalance_dates(bars, CALENDAR, EVERY), LOOK, AGE, 10)



def panel_sql(every=EVERY, look=LOOK, age=AGE):
    return f"""{dates_sql(every)}, marked AS (SELECT *, max(close) OVER w AS peak, CASE WHEN row_number() OVER w >= 10 THEN avg(close) OVER (PARTITION BY symbol, timeframe ORDER BY time ROWS 9 PRECEDING) END AS mean FROM bars {W}),
probes AS (SELECT symbol, k, date, date - {look} AS past FROM dates, (SELECT DISTINCT symbol FROM bars)),
now AS (SELECT p.symbol, k, date, past, m.time AS print_time, m.close AS print_close, CASE WHEN date - m.time <= {age} THEN m.close END AS close, CASE WHEN date - m.time <= {age} THEN peak END AS peak, CASE WHEN date - m.time <= {age} THEN mean END AS mean
        FROM probes p ASOF LEFT JOIN marked m ON p.symbol = m.symbol AND p.date >= m.time),
both_ AS (SELECT n.*, CASE WHEN n.past - b.time <= {age} THEN b.close END AS past_close FROM now n ASOF LEFT JOIN bars b ON n.symbol = b.symbol AND n.past >= b.time),
read AS (SELECT symbol, k, date, close, print_close, CASE WHEN past_close <> 0 THEN close / past_close - 1 END AS momentum, close / peak - 1 AS below_peak, close / mean - 1 AS trend FROM both_),
panel AS (SELECT * FROM read WHERE symbol IN (SELECT symbol FROM read WHERE momentum IS NOT NULL))"""


PANEL = panel_sql()
on_bars(
    "jn1_asof", "daily", lambda b: J.asof(b, b.where("symbol = 'Brand#11'").select(F.floor(F.col("time") / 864_000).alias("k"), (F.col("time") + 43_200).alias("date")).groupBy("k").agg(F.max("date").alias("date")), ["close"], 5 * 86_400).select("symbol", "k", "date", "print_time", "print_close", "close"),
    """d AS (SELECT time // 864000 AS k, max(time) + 43200 AS date FROM bars WHERE symbol = 'Brand#11' GROUP BY 1), p AS (SELECT symbol, k, date FROM d, (SELECT DISTINCT symbol FROM bars))
    SELECT p.symbol, k, date, b.time AS print_time, b.close AS print_close, CASE WHEN date - b.time <= 432000 THEN b.close END AS close FROM p ASOF LEFT JOIN bars b ON p.symbol = b.symbol AND p.date >= b.time""",
)
on_bars("xs2_panel", "brands", lambda b: rounded(read(b)), f"{PANEL} SELECT symbol, k, date, {', '.join(f'round({c}, 6) AS {c}' for c in ('close', 'print_close', 'momentum', 'below_peak', 'trend'))} FROM panel")
on_bars("jn2_momentum", "brands", lambda b: read(b).where("momentum is not null").select("symbol", "k", r6("momentum", "momentum")), f"{PANEL} SELECT symbol, k, round(momentum, 6) AS momentum FROM panel WHERE momentum IS NOT NULL")
CALENDAR_SQL = "ix AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS idx FROM bars WHERE symbol = 'Brand#11')"


def calendar(bars):
    from pyspark.sql import Window

    return bars.where(F.col("symbol") == CALENDAR).select("time", (F.row_number().over(Window.orderBy("time")) - 1).cast("long").alias("idx"))


ALIGNED = f"""{CALENDAR_SQL}, grid AS (SELECT symbol, time, idx FROM ix, (SELECT DISTINCT symbol FROM bars)),
g2 AS (SELECT g.symbol, g.idx, g.time, b.close, b.turnover FROM grid g LEFT JOIN bars b ON g.symbol = b.symbol AND g.time = b.time),
g3 AS (SELECT *, last_value(CASE WHEN close IS NOT NULL THEN time END IGNORE NULLS) OVER v AS lt, last_value(close IGNORE NULLS) OVER v AS lc, min(CASE WHEN close IS NOT NULL THEN idx END) OVER (PARTITION BY symbol) AS first_idx
       FROM g2 WINDOW v AS (PARTITION BY symbol ORDER BY idx)),
aligned AS (SELECT symbol, idx, time, CASE WHEN time - lt <= AGED THEN lc END AS price, coalesce(turnover, 0) AS turnover, first_idx FROM g3)"""
on_bars(
    "jn3_aligned", "daily", lambda b: J.aligned(b, calendar(b)).withColumn("turnover", r6("turnover")),
    ALIGNED.replace("AGED", "259200") + " SELECT symbol, idx, time, price, round(turnover, 6) AS turnover, first_idx FROM aligned",
)
GATE = 8 * WEEK
on_bars(
    "jn4_window_bars", "brands", lambda b: J.window_bars(b, X.rebalance_dates(b, CALENDAR, EVERY), GATE).groupBy("symbol", "k").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("first_time")),
    f"{DATES} SELECT symbol, k, count(*) AS n, min(time) AS first_time FROM bars JOIN dates ON time > date - {GATE} AND time <= date GROUP BY ALL",
)
GATES = f"""gs AS (SELECT symbol, CAST(floor(median(gap)) AS BIGINT) AS step FROM (SELECT symbol, time - lag(time) OVER (PARTITION BY symbol ORDER BY time) AS gap FROM bars) GROUP BY symbol),
gb AS (SELECT symbol, k, turnover, ln(close / lag(close) OVER (PARTITION BY symbol, k ORDER BY time)) AS r FROM bars JOIN dates ON time > date - {GATE} AND time <= date),
gates AS (SELECT gb.symbol, k, CASE WHEN count(*) >= 3 THEN list_sort(list(turnover))[count(*) // 2 + 1] END AS turnover, CASE WHEN count(r) > 2 THEN stddev_pop(r) * sqrt(31536000.0 / max(step)) END AS volatility FROM gb JOIN gs ON gb.symbol = gs.symbol GROUP BY gb.symbol, k)"""
on_bars(
    "xs3_gates", "brands", lambda b: rounded(X.window_gates(b, X.rebalance_dates(b, CALENDAR, EVERY), GATE)),
    f"{DATES}, {GATES} SELECT symbol, k, round(turnover, 6) AS turnover, round(volatility, 6) AS volatility FROM gates",
)


def gated(bars):
    gates = X.window_gates(bars, X.rebalance_dates(bars, CALENDAR, EVERY), GATE)
    return read(bars).join(gates, ["symbol", "k"], "left").withColumn("ok", X.gate_ok(trend=0.0, below_peak=0.8, turnover=1000.0, volatility=0.05))


GATED = f"{PANEL}, {GATES}, gated AS (SELECT p.*, coalesce(trend >= 0 AND below_peak >= -0.8 AND turnover >= 1000 AND volatility >= 0.05, false) AS ok FROM panel p LEFT JOIN gates g ON p.symbol = g.symbol AND p.k = g.k)"
on_bars("xs4_gate_ok", "brands", lambda b: gated(b).select("symbol", "k", "ok"), f"{GATED} SELECT symbol, k, ok FROM gated")


def picks(top, long_short, where="momentum IS NOT NULL AND close IS NOT NULL", source="panel"):
    n = f"greatest(1, CAST(round_even(count(*) OVER (PARTITION BY k) * {top}, 0) AS INT))" if top < 1 else str(top)
    short = f"WHEN worst <= n THEN -1" if long_short else ""
    return f"""rk AS (SELECT *, {n} AS n, row_number() OVER (PARTITION BY k ORDER BY momentum DESC, symbol) AS best, row_number() OVER (PARTITION BY k ORDER BY momentum, symbol) AS worst FROM {source} WHERE {where}),
    chosen AS (SELECT *, CASE WHEN best <= n THEN 1 {short} END AS side FROM rk WHERE best <= n {"OR worst <= n" if long_short else ""}),
    held AS (SELECT *, side * CASE WHEN min(side) OVER (PARTITION BY k) < 0 THEN 0.5::DOUBLE ELSE 1.0 END / count(*) OVER (PARTITION BY k, side) AS weight FROM chosen)"""


for _name, _top, _ls in (("xs5_rank", TOP, False), ("xs5_rank_ls", TOP, True), ("wn12_rank_share", 0.22, False)):
    on_bars(_name, "brands", lambda b, top=_top, ls=_ls: X.ranked(read(b), top, ls).select("symbol", "k", F.col("side").cast("int").alias("side")), f"{PANEL}, {picks(_top, _ls)} SELECT symbol, k, side FROM chosen")
SIGNED = "chosen AS (SELECT *, CASE WHEN momentum > 0.1 THEN 1 WHEN momentum < -0.1 THEN -1 END AS side FROM panel WHERE close IS NOT NULL AND (momentum > 0.1 OR momentum < -0.1))"
on_bars("xs6_sign", "brands", lambda b: X.signed(read(b), 0.1, True).select("symbol", "k", F.col("side").cast("int").alias("side")), f"{PANEL}, {SIGNED} SELECT symbol, k, side FROM chosen")
on_bars("xs7_weights", "brands", lambda b: X.weights(X.ranked(read(b), TOP, True)).select("symbol", "k", r6("weight", "weight")), f"{PANEL}, {picks(TOP, True)} SELECT symbol, k, round(weight, 6) AS weight FROM held")

BOOK = f"""ahead AS (SELECT *, lead(close) OVER s AS nc, lead(print_close) OVER s AS np FROM panel WINDOW s AS (PARTITION BY symbol ORDER BY k)),
wr AS (SELECT a.symbol, a.k, a.date, a.nc, a.np, coalesce(h.weight, 0) AS weight, CASE WHEN coalesce(h.weight, 0) <> 0 THEN coalesce(coalesce(a.nc, a.np) / a.close, 1) ELSE 1 END AS ratio FROM ahead a LEFT JOIN held h ON a.symbol = h.symbol AND a.k = h.k),
gr AS (SELECT *, 1 + sum(weight * (ratio - 1)) OVER (PARTITION BY k) AS growth FROM wr),
dr AS (SELECT *, coalesce(lag(weight * ratio / growth) OVER (PARTITION BY symbol ORDER BY k), 0) AS drifted FROM gr),
per AS (SELECT k, max(date) AS date, CAST(sum(CASE WHEN weight <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS holdings, sum(abs(weight - drifted)) AS turnover, max(growth) AS growth,
        CAST(sum(CASE WHEN weight <> 0 AND nc IS NULL AND np IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS delisted FROM dr GROUP BY k),
fa AS (SELECT *, greatest(1 - turnover * {RATE}, 0) * growth AS f FROM per),
book AS (SELECT k, date, holdings, turnover, growth, delisted, CASE WHEN coalesce(min(f) OVER b, 1) <= 0 THEN 0.0 ELSE coalesce(product(f) OVER b, 1.0) END AS equity FROM fa WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
SHOW = "round(turnover, 6) AS turnover, round(growth, 6) AS growth, delisted, round(equity, 6) AS equity"
for _name, _top, _ls in (("xs10_book_rank", TOP, False), ("xs10_book_rank_ls", TOP, True)):
    on_bars(
        _name, "brands", lambda b, top=_top, ls=_ls: rounded(X.book(X.weighted_readings(read(b), top, ls), rate=RATE)),
        f"{PANEL}, {picks(_top, _ls)}, {BOOK} SELECT k, date, holdings, {SHOW} FROM book",
    )


def gated_book(b):
    return X.book(X.weighted_readings(gated(b), TOP, ok=F.col("ok")), rate=RATE)


on_bars(
    "xs10_book_gated", "brands", lambda b: rounded(gated_book(b)),
    f"{GATED}, {picks(TOP, False, 'ok AND momentum IS NOT NULL AND close IS NOT NULL', 'gated')}, {BOOK.replace('growth AS growth, ', '')} SELECT k, date, holdings, {SHOW} FROM book",
)
on_bars(
    "xs8_vol_scale", "brands", lambda b: rounded(X.vol_scale(X.book(X.weighted_readings(read(b), TOP), rate=RATE), 12, 13.0, 0.4, 0.1, 1.0).select("k", "scale")),
    f"""{PANEL}, {picks(TOP, False)}, {BOOK}, sc AS (SELECT k, count(*) OVER v AS n, stddev_pop(growth - 1) OVER v * sqrt(13.0) AS s FROM book WINDOW v AS (ORDER BY k ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))
    SELECT k, round(CASE WHEN n < 5 THEN 1.0 WHEN s <= 0 THEN 1.0 ELSE greatest(0.1, least(1.0, 0.4 / s)) END, 6) AS scale FROM sc""",
)
FULL = re.sub(r"\b(ahead|wr|gr|dr|per|fa|book)\b", r"\1_full", BOOK)
SIZED = f"""sc AS (SELECT k, CASE WHEN n < 5 THEN 1.0 WHEN s <= 0 THEN 1.0 ELSE greatest(0.1, least(1.0, 0.4 / s)) END AS scale FROM (SELECT k, count(*) OVER v AS n, stddev_pop(growth - 1) OVER v * sqrt(13.0) AS s FROM book_full WINDOW v AS (ORDER BY k ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))),
sized AS (SELECT h.symbol, h.k, h.weight * scale AS weight FROM held h JOIN sc ON h.k = sc.k)"""
on_bars(
    "xs8_targeted_book", "brands", lambda b: rounded(X.vol_targeted(X.weighted_readings(read(b), TOP), 12, 13.0, 0.4, 0.1, 1.0, RATE).drop("delisted")),
    f"{PANEL}, {picks(TOP, False)}, {FULL}, {SIZED}, {BOOK.replace('LEFT JOIN held h', 'LEFT JOIN sized h')} SELECT book.k, date, holdings, round(turnover, 6) AS turnover, round(growth, 6) AS growth, round(equity, 6) AS equity, round(scale, 6) AS scale FROM book JOIN sc ON book.k = sc.k",
)
on_bars(
    "xs9_turnover_diff", "brands",
    lambda b: (lambda h: rounded(J.diff(h.select("symbol", (F.col("k") + 1).alias("k"), "weight"), h.select("symbol", "k", "weight"), ["symbol", "k"], "weight").groupBy("k").agg(F.sum("moved").alias("turnover"))))(X.weights(X.ranked(read(b), TOP))),
    f"""{PANEL}, {picks(TOP, False)}, o AS (SELECT symbol, k + 1 AS k, weight FROM held)
    SELECT coalesce(o.k, h.k) AS k, round(sum(abs(coalesce(h.weight, 0) - coalesce(o.weight, 0))), 6) AS turnover FROM o FULL JOIN held h ON o.symbol = h.symbol AND o.k = h.k GROUP BY 1""",
)
on_bars(
    "xs11_equal_weight", "brands", lambda b: rounded(X.equal_weight(read(b), RATE)),
    f"""{PANEL}, v AS (SELECT k, first_value(close IGNORE NULLS) OVER s AS f, last_value(close IGNORE NULLS) OVER s AS l FROM panel WINDOW s AS (PARTITION BY symbol ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT k, round(avg(CASE WHEN f IS NULL THEN 1.0 ELSE l / f * pow(1 - {RATE}, 2) END), 6) AS equal_weight FROM v GROUP BY k""",
)
LOG = """sd AS (SELECT p.symbol, p.k, p.close, coalesce(c.side, 0) AS side FROM panel p LEFT JOIN chosen c ON p.symbol = c.symbol AND p.k = c.k),
ch AS (SELECT *, coalesce(lag(side) OVER (PARTITION BY symbol ORDER BY k), 0) AS was FROM sd),
log AS (SELECT symbol, k, CASE WHEN was > 0 THEN 'sell' ELSE 'cover' END AS event, close FROM ch WHERE side <> was AND was <> 0 UNION ALL SELECT symbol, k, CASE WHEN side > 0 THEN 'buy' ELSE 'short' END, close FROM ch WHERE side <> was AND side <> 0)"""
on_bars("xs12_trade_log", "brands", lambda b: rounded(X.trade_log(read(b), X.ranked(read(b), TOP, True))), f"{PANEL}, {picks(TOP, True)}, {LOG} SELECT symbol, k, event, round(close, 6) AS close FROM log")
CENSUS_SQL = f"""{PANEL}, {picks(1, True)}, {LOG}, e AS (SELECT symbol, count(*) FILTER (event = 'buy') AS buy, count(*) FILTER (event = 'sell') AS sell, count(*) FILTER (event = 'short') AS short, count(*) FILTER (event = 'cover') AS cover FROM log GROUP BY symbol),
    s AS (SELECT symbol, count(*) AS held, min(k) AS first_k, max(k) AS last_k FROM chosen GROUP BY symbol)
    SELECT u.symbol, coalesce(held, 0) AS held, coalesce(buy, 0) AS buy, coalesce(sell, 0) AS sell, coalesce(short, 0) AS short, coalesce(cover, 0) AS cover, first_k, last_k
    FROM (SELECT DISTINCT symbol FROM panel) u LEFT JOIN s ON u.symbol = s.symbol LEFT JOIN e ON u.symbol = e.symbol"""
on_bars("ag14_census", "brands", lambda b: X.census(read(b), X.ranked(read(b), 1, True)), CENSUS_SQL)
on_bars("jn13_never_held", "brands", lambda b: read(b).select("symbol").distinct().join(X.ranked(read(b), 1), "symbol", "left_anti"), f"{PANEL}, {picks(1, False)} SELECT DISTINCT symbol FROM panel WHERE symbol NOT IN (SELECT symbol FROM chosen)")
on_bars("jn13_held", "brands", lambda b: read(b).select("symbol").distinct().join(X.ranked(read(b), 1), "symbol", "left_semi"), f"{PANEL}, {picks(1, False)} SELECT DISTINCT symbol FROM panel WHERE symbol IN (SELECT symbol FROM chosen)")
on_bars(
    "xs13_exposure_markers", "brands",
    lambda b: X.exposure_markers(gated_book(b).select("k", F.when(F.col("holdings") > 0, 1.0).otherwise(0.0).alias("exposure"))),
    f"""{GATED}, {picks(TOP, False, 'ok AND momentum IS NOT NULL AND close IS NOT NULL', 'gated')}, {BOOK}, x AS (SELECT k, CASE WHEN holdings > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS exposure FROM book), y AS (SELECT *, lag(exposure) OVER (ORDER BY k) AS was FROM x)
    SELECT k, exposure FROM y WHERE was IS NULL OR was <> exposure""",
)
on_bars(
    "xs14_delisted", "daily", lambda b: (lambda p: X.book(X.weighted_readings(p, TOP), rate=RATE).agg(F.sum("delisted").alias("delisted"), F.sum("holdings").alias("holdings")))(X.panel(b, X.rebalance_dates(b, CALENDAR, 30), 40 * 86_400, 86_400)),
    f"{panel_sql(30, 40 * 86_400, 86_400)}, {picks(TOP, False)}, {BOOK} SELECT CAST(sum(delisted) AS BIGINT) AS delisted, CAST(sum(holdings) AS BIGINT) AS holdings FROM book",
)
on_bars(
    "xs15_placebo", "brands", lambda b: rounded(X.book(X.weighted_readings(X.permuted(read(b), ["momentum"], 7), TOP), rate=RATE)),
    f"""{PANEL.replace("panel AS (SELECT", "panel0 AS (SELECT")}, nm AS (SELECT DISTINCT symbol FROM panel0), a AS (SELECT symbol, row_number() OVER (ORDER BY symbol) AS n FROM nm), b AS (SELECT symbol AS lender, row_number() OVER (ORDER BY md5('7:' || symbol), symbol) AS n FROM nm),
    lent AS (SELECT p.symbol, p.k, p.date, p.close, p.print_close, q.momentum FROM panel0 p JOIN a ON p.symbol = a.symbol JOIN b ON a.n = b.n LEFT JOIN panel0 q ON q.symbol = b.lender AND q.k = p.k),
    {picks(TOP, False, source="lent")}, panel AS (SELECT * FROM panel0), {BOOK} SELECT k, date, holdings, {SHOW} FROM book""",
)
on_bars(
    "ag15_book_totals", "brands", lambda b: rounded(gated_book(b).agg(F.min("holdings").alias("least"), F.max("holdings").alias("most"), F.element_at(F.sort_array(F.collect_list("holdings")), F.floor(F.count(F.lit(1)) / 2).cast("int") + 1).alias("middle"), F.avg((F.col("holdings") == 0).cast("double")).alias("cash_share"), F.avg("turnover").alias("turnover"))),
    f"""{GATED}, {picks(TOP, False, 'ok AND momentum IS NOT NULL AND close IS NOT NULL', 'gated')}, {BOOK} SELECT min(holdings) AS least, max(holdings) AS most, list_sort(list(holdings))[count(*) // 2 + 1] AS middle,
    round(avg(CASE WHEN holdings = 0 THEN 1.0 ELSE 0.0 END), 6) AS cash_share, round(avg(turnover), 6) AS turnover FROM book""",
)

CS = """cs AS (SELECT *, lag(high) OVER w AS h1, lag(low) OVER w AS l1 FROM bars WINDOW w AS (PARTITION BY symbol, timeframe ORDER BY time)),
ab AS (SELECT *, pow(ln(h1 / l1), 2) + pow(ln(high / low), 2) AS beta, pow(ln(greatest(h1, high) / least(l1, low)), 2) AS gamma FROM cs),
al AS (SELECT *, (sqrt(2 * beta) - sqrt(beta)) / (3 - 2 * sqrt(2.0)) - sqrt(gamma / (3 - 2 * sqrt(2.0))) AS alpha FROM ab),
spread AS (SELECT symbol, timeframe, CASE WHEN count(*) >= 3 THEN median(CASE WHEN h1 IS NOT NULL THEN greatest(2 * (exp(alpha) - 1) / (1 + exp(alpha)), 0) END) END AS spread FROM al GROUP BY symbol, timeframe)"""
on_bars("ag12_spreads", "closes", lambda b: rounded(costs.spreads(b)), f"{CS} SELECT symbol, timeframe, round(spread, 6) AS spread FROM spread")
STATS = """st AS (SELECT symbol, timeframe, median(turnover) AS turnover, stddev_samp(r) AS sigma FROM (SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol, timeframe ORDER BY time)) AS r FROM bars WHERE close > 0 AND turnover > 0) GROUP BY ALL HAVING count(*) >= 30)"""
on_bars("ag13_market_stats", "types", lambda b: rounded(costs.market_stats(b)), f"{STATS} SELECT symbol, timeframe, round(turnover, 6) AS turnover, round(sigma, 6) AS sigma FROM st")
LEG = f"{STATS}, {CS}, lc AS (SELECT st.symbol, 0.001 + coalesce(spread / 2, 0) + coalesce(CASE WHEN turnover > 0 THEN CASE WHEN sigma <= 0 THEN 0.0 ELSE sigma * sqrt(100.0 / turnover) END END, 0) AS rate FROM st LEFT JOIN spread s ON st.symbol = s.symbol)"
on_bars("bk9_leg_costs", "types", lambda b: rounded(costs.leg_costs(costs.market_stats(b), costs.spreads(b), 0.001, 100.0)), f"{LEG} SELECT symbol, round(rate, 6) AS rate FROM lc")
on_bars(
    "jn11_cost_override", "types", lambda b: costs.with_costs(b, costs.leg_costs(costs.market_stats(b), costs.spreads(b), 0.001, 100.0).where("symbol <> 'PROMO'"), 0.002).select("symbol", r6("rate", "rate")).distinct(),
    f"{LEG} SELECT DISTINCT b.symbol, round(coalesce(rate, 0.002), 6) AS rate FROM bars b LEFT JOIN (SELECT * FROM lc WHERE symbol <> 'PROMO') l ON b.symbol = l.symbol",
)


def hourly_priced(spark, sf):
    daily, weekly = FIXTURES["daily"][0](spark, sf), FIXTURES["brands"][0](spark, sf)
    return rounded(weekly.select("symbol").distinct().join(costs.spreads(daily.where("symbol <> 'Brand#12'")), "symbol", "left").select("symbol", (0.001 + F.coalesce(F.col("spread") / 2, F.lit(0.0))).alias("rate")))


on_tables(
    "jn14_finer_spread", hourly_priced,
    f"WITH {FIXTURES['daily'][1]}, {CS.replace('FROM bars', '''FROM (SELECT * FROM bars WHERE symbol <> 'Brand#12')''')} SELECT b.symbol, round(0.001 + coalesce(spread / 2, 0), 6) AS rate FROM (SELECT DISTINCT symbol FROM bars) b LEFT JOIN spread s ON b.symbol = s.symbol",
)
on_bars(
    "jn12_masked", "types",
    lambda b: masked(signal(b, "sma", window=20), b.where("time div 604800 % 3 = 0").select("symbol", "timeframe", "time", (F.col("turnover") > 1500).alias("liquid"))).select("symbol", "time", "target"),
    f"m AS (SELECT *, time // 604800 % 3 = 0 AND NOT turnover > 1500 AS out_ FROM bars), sig AS (SELECT symbol, time, CASE WHEN out_ THEN 0.0 ELSE {SMA20} END::DOUBLE AS target FROM m {W}) SELECT symbol, time, target FROM sig",
)

SPARSE = "FROM (SELECT * FROM bars WHERE time // 604800 % (7 + length(symbol)) <> 0)"
sparse = lambda b: b.where("time div 604800 % (7 + length(symbol)) <> 0")
LINE = f"""sp AS (SELECT * {SPARSE}), win AS (SELECT max(lo) AS a, min(hi) AS z FROM (SELECT symbol, min(time) AS lo, max(time) AS hi FROM sp GROUP BY symbol)),
line AS (SELECT time FROM sp, win WHERE time BETWEEN a AND z GROUP BY time HAVING count(DISTINCT symbol) = (SELECT count(DISTINCT symbol) FROM sp))"""
on_bars("bk1_common_window", "types", lambda b: K.common_window(sparse(b)), f"{LINE} SELECT a AS first_time, z AS last_time FROM win")
on_bars("bk2_timeline", "types", lambda b: K.timeline(sparse(b)), f"{LINE} SELECT time FROM line")


def basket(b):
    rows = sparse(b)
    return K.legs(C.equity_curve(signal(rows, "sma", window=20), RATE), K.timeline(rows))


LEGS = f"""{LINE}, {RULES['sg1_sma'][2].replace('FROM bars', 'FROM sp')}, {CURVE},
lg AS (SELECT c.*, first_value(equity) OVER w AS e0, lead(c.time) OVER w IS NULL AS ends FROM curve c JOIN line l ON c.time = l.time WINDOW w AS (PARTITION BY symbol, timeframe ORDER BY c.time)),
legs AS (SELECT *, equity / e0 * CASE WHEN ends THEN 1 + position * (close / open - 1) ELSE 1 END AS leg FROM lg)"""
on_bars("bk3_legs", "types", lambda b: rounded(basket(b).select("symbol", "time", "leg")), f"{LEGS} SELECT symbol, time, round(leg, 6) AS leg FROM legs")
on_bars("bk4_basket", "types", lambda b: rounded(K.combined(basket(b))), f"{LEGS} SELECT time, round(1 + avg(leg - 1), 6) AS basket, round(avg(abs(position)), 6) AS invested, count(*) AS n_legs FROM legs GROUP BY time")
on_bars(
    "bk5_benchmark", "types", lambda b: rounded(C.buy_and_hold(sparse(b).join(K.timeline(sparse(b)), "time", "left_semi"), RATE).groupBy("time").agg(F.avg("hold_net").alias("hold_net"))),
    f"""{LINE}, bl AS (SELECT s.* FROM sp s JOIN line l ON s.time = l.time), hd AS (SELECT time, CASE WHEN row_number() OVER w = 1 THEN 1.0 ELSE close / nth_value(open, 2) OVER (PARTITION BY symbol, timeframe ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS hold FROM bl {W})
    SELECT time, round(avg(hold * pow(1 - {RATE}, 2)), 6) AS hold_net FROM hd GROUP BY time""",
)
on_bars(
    "bk6_contributions", "types", lambda b: rounded(K.contributions(basket(b))),
    f"""{LEGS}, f AS (SELECT symbol, arg_max(leg, time) AS fin, avg(abs(position)) AS exposure FROM legs GROUP BY symbol)
    SELECT symbol, round(fin - 1, 6) AS total, round((fin - 1) / count(*) OVER (), 6) AS contribution, round(fin / sum(fin) OVER (), 6) AS share, round(exposure, 6) AS exposure FROM f""",
)
on_bars(
    "bk7_select", "brands", lambda b: rounded(K.select_by_turnover(b, 860_000_000, 40 * WEEK, 6, 5)),
    f"SELECT symbol, round(median(turnover), 6) AS turnover FROM bars WHERE time >= 860000000 - {40 * WEEK} AND time < 860000000 AND turnover > 0 GROUP BY symbol HAVING count(*) >= 5 ORDER BY median(turnover) DESC, symbol LIMIT 6",
)
on_bars(
    "bk8_swaps", "types", lambda b: rounded(K.swaps(basket(b))),
    f"{LEGS}, mv AS (SELECT time, symbol, position - coalesce(lag(position) OVER w, 0) AS mv FROM legs {W}) SELECT time, round(sum(mv), 6) AS changed, string_agg(symbol, ',' ORDER BY symbol) AS names FROM mv WHERE abs(mv) >= 1e-12 GROUP BY time",
)
on_bars("se1_shared_times", "flags", lambda b: J.shared_times(b), "SELECT time FROM bars GROUP BY time HAVING count(DISTINCT symbol) = (SELECT count(DISTINCT symbol) FROM bars)")
def covered(b):
    """What two archives hold of each series: one by years with years left out, one by spans of other lengths."""
    by_year = coverage(b.where("year(timestamp_seconds(time)) % 3 <> 0"), F.year(F.timestamp_seconds("time")), "part")
    by_span = coverage(b.where("time div 40000000 % 3 = 0"), F.expr("time div 40000000"), "part")
    return merged_intervals(by_year.select(*KEY, "first_time", "last_time").unionByName(by_span.select(*KEY, "first_time", "last_time")), WEEK)


on_bars(
    "se2_union", "types", covered,
    """iv AS (SELECT symbol, timeframe, min(time) AS a, max(time) AS z FROM bars WHERE year(to_timestamp(time)) % 3 <> 0 GROUP BY symbol, timeframe, year(to_timestamp(time))
           UNION ALL SELECT symbol, timeframe, min(time), max(time) FROM bars WHERE time // 40000000 % 3 = 0 GROUP BY symbol, timeframe, time // 40000000),
    k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY a, z) AS n FROM iv), r AS (SELECT symbol, timeframe, n, a, z, 0 AS island FROM k WHERE n = 1
          UNION ALL SELECT k.symbol, k.timeframe, k.n, k.a, greatest(k.z, CASE WHEN k.a <= r.z + 604800 THEN r.z ELSE k.z END), CASE WHEN k.a <= r.z + 604800 THEN island ELSE island + 1 END FROM r JOIN k ON k.symbol = r.symbol AND k.n = r.n + 1)
    SELECT symbol, timeframe, min(a) AS first_time, max(z) AS last_time, count(*) AS parts FROM r GROUP BY symbol, timeframe, island""",
)
on_bars("se3_difference", "types", lambda b: b.select("symbol", "time").exceptAll(b.where("time > 810000000").select("symbol", "time")), "SELECT symbol, time FROM bars EXCEPT ALL SELECT symbol, time FROM bars WHERE time > 810000000")
on_bars("se4_dedup", "daily", lambda b: b.select("symbol", F.expr("time div 2592000").alias("month")).dropDuplicates(), "SELECT DISTINCT symbol, time // 2592000 AS month FROM bars")
on_bars("sl1_sorted", "brands", lambda b: b.groupBy("symbol").agg(F.median("turnover").alias("turnover")).orderBy(F.col("turnover").desc(), "symbol").select("symbol", r6("turnover", "turnover")), "SELECT symbol, round(median(turnover), 6) AS turnover FROM bars GROUP BY symbol")
on_bars("sl2_top_per_week", "brands", lambda b: b.withColumn("place", F.expr("row_number() over (partition by time order by turnover desc, symbol)")).where("place <= 3").select("time", "symbol", "place"), "SELECT time, symbol, CAST(place AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY time ORDER BY turnover DESC, symbol) AS place FROM bars) WHERE place <= 3")
on_bars(
    "sl4_last_trades", "types",
    lambda b: rounded(C.trades(C.equity_curve(signal(b, "sma", window=20), 0.001)).where("not open_at_end").orderBy(F.col("exit_time").desc(), "symbol").limit(10).select("symbol", "side", "entry_time", "exit_time", "net_return")),
    f"{RULES['sg1_sma'][2]}, {CURVE}{TRADES} SELECT symbol, side, entry_time, exit_time, round(net_return, 6) AS net_return FROM trades WHERE NOT open_at_end ORDER BY exit_time DESC, symbol LIMIT 10",
)


def borrow(spark, sf):
    rows = table(spark, sf, "supplier").select(F.col("s_name").alias("currency"), (F.pmod("s_suppkey", F.lit(97)) / 100_000).alias("daily"))
    return rounded(costs.ranked_rates(rows, 5.0))


on_tables("sl5_rates", borrow, "SELECT s_name AS currency, round((s_suppkey % 97) / 100000.0, 6) AS daily, round((s_suppkey % 97) / 100000.0 * 365 * 100, 6) AS annual FROM supplier WHERE (s_suppkey % 97) / 100000.0::DOUBLE * 365 * 100 >= 5")

