"""Queries of indicators, signals, curves, trades and performance."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import curve as C
from barloom.operators import indicators as I
from barloom.operators import performance as P
from barloom.operators.signals import liquid_only, signal
from barloom.plans.base import FIXTURES, W, on_bars, on_tables, r6, rounded
from barloom.sources.bars import KEY
from barloom.sources.derived import event_bars

ID = ("symbol", "time")
RATE = 0.001
WEEKS = 31_536_000 / 604_800


def columns(name, fixture, sql, **named):
    """A query of expressions over a series, rounded, with SQL for each."""
    on_bars(
        name, fixture, lambda b: b.select(*ID, *[r6(make(), n) for n, make in named.items()]),
        f"SELECT symbol, time, {', '.join(f'round({s}, 6) AS {n}' for n, s in zip(named, sql, strict=True))} FROM bars {W}",
    )


N = "row_number() OVER w"


def sma_sql(n):
    return f"CASE WHEN {N} >= {n} THEN avg(close) OVER (PARTITION BY symbol, timeframe ORDER BY time ROWS {n - 1} PRECEDING) END"


columns("wn1_sma", "types", [sma_sql(20), sma_sql(50)], sma20=lambda: I.sma(20), sma50=lambda: I.sma(50))
columns("wn5_change", "types", ["close / lag(close, 5) OVER w - 1", "ln(close / lag(close) OVER w)"], change=lambda: I.change(5), log_change=lambda: I.log_change())
columns(
    "wn6_channel", "types", [f"CASE WHEN {N} > 10 THEN {f}({c}) OVER (PARTITION BY symbol, timeframe ORDER BY time ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) END" for f, c in (("max", "high"), ("min", "low"))],
    hi=lambda: I.channel_high(10), lo=lambda: I.channel_low(10),
)
STEP_SQL = "steps AS (SELECT symbol, timeframe, CAST(floor(median(gap)) AS BIGINT) AS step FROM (SELECT *, time - lag(time) OVER w AS gap FROM bars WINDOW w AS (PARTITION BY symbol, timeframe ORDER BY time)) GROUP BY ALL)"


def vol_sql(n):
    return f"""rets AS (SELECT *, close / lag(close) OVER w - 1 AS r FROM bars {W}), {STEP_SQL},
    vols AS (SELECT r.*, step, CASE WHEN count(r) OVER v >= 20 THEN stddev_pop(r) OVER v * sqrt(31536000.0 / step) END AS vol FROM rets r JOIN steps s ON r.symbol = s.symbol
             WINDOW v AS (PARTITION BY r.symbol ORDER BY time ROWS {n - 1} PRECEDING))"""


on_bars("wn7_volatility", "types", lambda b: I.with_volatility(I.step_of(b), 40).select(*ID, r6("vol", "vol")), f"{vol_sql(40)} SELECT symbol, time, round(vol, 6) AS vol FROM vols")
columns("wn8_drawdown", "types", ["close / max(close) OVER w - 1"], drawdown=lambda: I.drawdown())
columns(
    "wn9_median_turnover", "types", [f"CASE WHEN {N} >= 12 THEN quantile_cont(turnover, 0.5) OVER (PARTITION BY symbol, timeframe ORDER BY time ROWS 11 PRECEDING) END"],
    median_turnover=lambda: I.median_turnover(12),
)
columns("wn11_trend", "types", [f"close / ({sma_sql(30)}) - 1"], trend=lambda: I.trend(30))
on_bars(
    "wn16_changes", "types", lambda b: rounded(I.changes(b, "1w")),
    f"SELECT symbol, timeframe, time, round(close, 6) AS close, {', '.join(f'round(close / lag(close, {n}) OVER w - 1, 6) AS change_{k}' for k, n in I.windows_of('1w').items())} FROM bars {W} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC) = 1",
)


def ema_sql(source, column, n, out, first):
    """A recursion over `source` (symbol, i, column) from row `first` on, seeded with the mean of n rows."""
    return f"""{out}_seed AS (SELECT symbol, i, {column} AS x, avg({column}) OVER (PARTITION BY symbol ORDER BY i ROWS {n - 1} PRECEDING) AS seed FROM {source}),
    {out} AS (SELECT symbol, i, seed AS v FROM {out}_seed WHERE i = {first} UNION ALL
              SELECT n.symbol, n.i, r.v + 2.0::DOUBLE / {n + 1} * (n.x - r.v) FROM {out} r JOIN {out}_seed n ON n.symbol = r.symbol AND n.i = r.i + 1)"""


PLACED = "placed AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time) AS i FROM bars)"
on_bars(
    "wn2_ema", "flags", lambda b: I.with_ema(b, 20).select(*ID, r6("ema", "ema")),
    f"{PLACED}, {ema_sql('placed', 'close', 20, 'e', 20)} SELECT p.symbol, p.time, round(v, 6) AS ema FROM placed p LEFT JOIN e ON p.symbol = e.symbol AND p.i = e.i",
)
MACD_SQL = f"""{PLACED}, {ema_sql('placed', 'close', 6, 'f', 6)}, {ema_sql('placed', 'close', 13, 's', 13)},
    line AS (SELECT f.symbol, f.i, f.v - s.v AS x FROM f JOIN s ON f.symbol = s.symbol AND f.i = s.i), {ema_sql('line', 'x', 5, 'g', 17)},
    macd AS (SELECT p.symbol, p.timeframe, p.time, p.open, p.high, p.low, p.close, p.turnover, l.x AS macd, g.v AS macd_signal FROM placed p LEFT JOIN line l ON p.symbol = l.symbol AND p.i = l.i LEFT JOIN g ON p.symbol = g.symbol AND p.i = g.i)"""
on_bars(
    "wn3_macd", "flags", lambda b: I.with_macd(b, 6, 13, 5).select(*ID, r6("macd", "macd"), r6("macd_signal", "macd_signal"), r6("macd_hist", "macd_hist")),
    f"{MACD_SQL} SELECT symbol, time, round(macd, 6) AS macd, round(macd_signal, 6) AS macd_signal, round(macd - macd_signal, 6) AS macd_hist FROM macd",
)


def rsi_sql(n):
    """`levels` (symbol, time, i, ..., level): the smoothed index as a recursion from bar n + 1 on."""
    return f"""{PLACED}, d AS (SELECT *, greatest(close - lag(close) OVER p, 0) AS up, greatest(lag(close) OVER p - close, 0) AS down FROM placed WINDOW p AS (PARTITION BY symbol ORDER BY i)),
    r AS (SELECT symbol, {n + 1}::BIGINT AS i, sum(up) / {n} AS g, sum(down) / {n} AS l FROM d WHERE i BETWEEN 2 AND {n + 1} GROUP BY symbol HAVING count(*) = {n}
          UNION ALL SELECT d.symbol, d.i, (r.g * {n - 1} + d.up) / {n}, (r.l * {n - 1} + d.down) / {n} FROM r JOIN d ON d.symbol = r.symbol AND d.i = r.i + 1),
    levels AS (SELECT p.*, CASE WHEN g = 0 AND l = 0 THEN 50 WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END AS level FROM placed p LEFT JOIN r ON p.symbol = r.symbol AND p.i = r.i)"""


on_bars("wn4_rsi", "flags", lambda b: I.with_rsi(b, 7).select(*ID, r6("rsi", "rsi")), f"{rsi_sql(7)} SELECT symbol, time, round(level, 6) AS rsi FROM levels")


def grid_sql(score, every, short, source="bars"):
    """Decisions on the epoch grid as a recursion, a bar at a time: the grid moves on once for each bar that has reached it."""
    low = "WHEN score < 0 THEN -1.0" if short else ""
    return f"""{STEP_SQL}, scored AS (SELECT *, {score} AS score, row_number() OVER w AS i FROM (SELECT b.*, step FROM {source} b JOIN steps s ON b.symbol = s.symbol)
        WINDOW w AS (PARTITION BY symbol, timeframe ORDER BY time)),
    begun AS (SELECT symbol, min(i) AS i0 FROM scored WHERE score IS NOT NULL GROUP BY symbol),
    walk AS (SELECT s.symbol, s.i, (s.time + {every} * step - 1) // ({every} * step) * ({every} * step) AS grid, 0.0::DOUBLE AS target, false AS done FROM scored s JOIN begun b ON s.symbol = b.symbol AND s.i = b.i0
        UNION ALL SELECT w.symbol, CASE WHEN done THEN w.i + 1 ELSE w.i END, CASE WHEN NOT done AND s.time >= grid THEN grid + {every} * step ELSE grid END,
            CASE WHEN NOT done AND s.time >= grid AND score IS NOT NULL THEN CASE WHEN score > 0 THEN 1.0 {low} ELSE 0.0 END ELSE target END, NOT done
        FROM walk w JOIN scored s ON s.symbol = w.symbol AND s.i = w.i WHERE w.i <= (SELECT max(i) FROM scored)),
    sig AS (SELECT s.*, coalesce(w.target, 0.0) AS target FROM scored s LEFT JOIN walk w ON s.symbol = w.symbol AND s.i = w.i AND w.done)"""


def plain_sql(target):
    return f"sig AS (SELECT *, CAST({target} AS DOUBLE) AS target FROM bars {W})"


MOM = "close / lag(close, 26) OVER w - 1"
MOM_SCORE = f"CASE WHEN {MOM} > 0 THEN 1.0 WHEN {MOM} < 0 THEN -1.0 WHEN {MOM} IS NOT NULL THEN 0.0 END"


def latch_sql(on, off):
    return f"coalesce(last_value(CASE WHEN {on} THEN 1.0 WHEN {off} THEN 0.0 END IGNORE NULLS) OVER w, 0.0)"


CHANNELS = f"""ch AS (SELECT *, {", ".join(f"CASE WHEN {N} > 20 THEN {f}({c}) OVER (PARTITION BY symbol, timeframe ORDER BY time ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) END AS {k}" for k, f, c, n in (("eh", "max", "high", 20), ("el", "min", "low", 20), ("xh", "max", "high", 10), ("xl", "min", "low", 10)))} FROM bars {W})"""
BREAK_LONG = f"{CHANNELS}, sig AS (SELECT *, {latch_sql('close > eh', 'close < xl')} AS target FROM ch {W})"
BREAK_BOTH = f"{CHANNELS}, sig AS (SELECT *, {latch_sql('close > eh', 'close < xl OR close < el')} - {latch_sql('close < el', 'close > xh OR close > eh')} AS target FROM ch {W})"
SCALE = "CASE WHEN vol IS NULL THEN 1.0 WHEN vol <= 0 THEN 1.0 ELSE greatest(0.0, least(1.0, 0.4 / vol)) END"
SMA20 = f"CASE WHEN close > {sma_sql(20)} THEN 1.0 ELSE 0.0 END"



def walk_sql(source, state, start, step):
    """`walk` (symbol, i, state...): a recursion over `source` (symbol, i, ...), a bar at a time, from `start` at bar 0."""
    names = ", ".join(state)
    return f"walk AS (SELECT DISTINCT symbol, 0::BIGINT AS i, {start} FROM {source} UNION ALL SELECT symbol, i, {names} FROM ({step}))"


def reversion_sql(short):
    enter = "CASE WHEN level < 10 THEN 1 WHEN level > 90 THEN -1 ELSE 0 END" if short else "CASE WHEN level < 10 THEN 1 ELSE 0 END"
    step = f"""SELECT n.symbol, n.i, CASE WHEN level IS NULL THEN side WHEN side <> 0 THEN CASE WHEN (side > 0 AND level > 50) OR (side < 0 AND level < 50) OR n.i - since >= 10 THEN 0 ELSE side END ELSE {enter} END AS side,
        CASE WHEN level IS NOT NULL AND side = 0 AND {enter} <> 0 THEN n.i ELSE since END AS since FROM walk w JOIN levels n ON n.symbol = w.symbol AND n.i = w.i + 1"""
    return f"""{rsi_sql(2)}, {walk_sql('levels', ('side', 'since'), '0 AS side, 0::BIGINT AS since', step)},
    sig AS (SELECT l.*, CASE WHEN level IS NULL THEN 0.0 ELSE side END::DOUBLE AS target FROM levels l JOIN walk w ON l.symbol = w.symbol AND l.i = w.i)"""


HOLD_STEP = """SELECT n.symbol, n.i, CASE WHEN eh IS NULL THEN side WHEN close > eh AND side = 0 THEN 1 WHEN side > 0 AND n.i - since >= 5 AND close < xl THEN 0 ELSE side END AS side,
    CASE WHEN eh IS NOT NULL AND close > eh AND side = 0 THEN n.i ELSE since END AS since FROM walk w JOIN numbered n ON n.symbol = w.symbol AND n.i = w.i + 1"""
BREAK_HOLD = f"""{CHANNELS}, numbered AS (SELECT *, row_number() OVER w AS i FROM ch {W}), {walk_sql('numbered', ('side', 'since'), '0 AS side, 0::BIGINT AS since', HOLD_STEP)},
    sig AS (SELECT n.*, side::DOUBLE AS target FROM numbered n JOIN walk w ON n.symbol = w.symbol AND n.i = w.i)"""


def stops_sql(inner, stop, profit, trail, cooldown):
    """Exits around a long-only `inner` (SQL that ends in `sig`): a level inside of the bar first, then the close itself."""
    off = "false"
    filled = f"""SELECT w.*, n.i AS j, n.target AS want, n.close, CASE WHEN held = 0 THEN NULL WHEN {f'low <= entry * (1 - {stop})' if stop else off} THEN least(entry * (1 - {stop}), open)
        WHEN {f'high >= entry * (1 + {profit})' if profit else off} THEN entry * (1 + {profit}) WHEN {f'low <= best * (1 - {trail})' if trail else off} THEN least(best * (1 - {trail}), open) END AS fill
        FROM walk w JOIN wanted n ON n.symbol = w.symbol AND n.i = w.i + 1"""
    judged = f"""SELECT *, greatest(best, close) AS top, held = 1 AND fill IS NULL AND want > 0 AND ({f'close / entry - 1 <= -{stop}' if stop else off} OR {f'close / entry - 1 >= {profit}' if profit else off}
        OR {f'close / greatest(best, close) - 1 <= -{trail}' if trail else off}) AS spent FROM ({filled})"""
    stays = "held = 1 AND fill IS NULL AND NOT spent AND want > 0"
    enters = "held = 0 AND want > 0 AND j >= free"
    step = f"""SELECT symbol, j AS i, CASE WHEN {stays} OR {enters} THEN 1 ELSE 0 END AS held, CASE WHEN {enters} THEN close ELSE entry END AS entry, CASE WHEN {enters} THEN close ELSE top END AS best,
        CASE WHEN fill IS NOT NULL OR spent THEN j + 1 + {cooldown} ELSE free END AS free, fill AS exit_price FROM ({judged})"""
    start = "0 AS held, 0.0::DOUBLE AS entry, 0.0::DOUBLE AS best, 0::BIGINT AS free, NULL::DOUBLE AS exit_price"
    return f"""{inner.replace('sig AS (', 'within AS (')}, wanted AS (SELECT *, row_number() OVER w AS i FROM within {W}), {walk_sql('wanted', ('held', 'entry', 'best', 'free', 'exit_price'), start, step)},
    sig AS (SELECT n.* EXCLUDE (target), CASE WHEN held = 1 THEN target ELSE 0.0 END::DOUBLE AS target, exit_price FROM wanted n JOIN walk w ON n.symbol = w.symbol AND n.i = w.i)"""


def scaled_sql(inner, wrap):
    """An inner rule's SQL with its target, `t`, wrapped by what `vol` says at the same bar."""
    inner = inner.replace(STEP_SQL + ", ", "").replace("sig AS (", "within AS (")
    return f"{vol_sql(40)}, {inner}, sig AS (SELECT g.* EXCLUDE (target), {wrap.replace('$t', 'g.target')} AS target FROM within g JOIN vols v ON g.symbol = v.symbol AND g.time = v.time)"


SCALED = f"greatest(-1.0, least(1.0, $t * {SCALE}))"
CALM = "CASE WHEN vol IS NULL OR vol <= 1.6 THEN $t ELSE 0.0 END"
MOM30 = MOM_SCORE.replace("26", "30")

#: name -> (fixture, plan, SQL that ends in `sig`)
RULES = {
    "sg1_sma": ("types", lambda b: signal(b, "sma", window=20), plain_sql(SMA20)),
    "sg1_sma_grid": ("types", lambda b: signal(b, "sma", window=20, rebalance=4), grid_sql(f"sign(close - ({sma_sql(20)}))", 4, False)),
    "sg2_sma_ls": ("types", lambda b: signal(b, "sma-ls", window=20), plain_sql(f"CASE WHEN close > {sma_sql(20)} THEN 1.0 WHEN close <= {sma_sql(20)} THEN -1.0 ELSE 0.0 END")),
    "sg3_sma_rev": ("types", lambda b: signal(b, "sma-rev", window=20), plain_sql(f"CASE WHEN close < {sma_sql(20)} THEN 1.0 ELSE 0.0 END")),
    "sg3_sma_rev_ls": ("types", lambda b: signal(b, "sma-rev-ls", window=20), plain_sql(f"CASE WHEN close < {sma_sql(20)} THEN 1.0 WHEN close > {sma_sql(20)} THEN -1.0 ELSE 0.0 END")),
    "sg4_macd": ("flags", lambda b: signal(b, "macd", fast=6, slow=13, signal=5), f"{MACD_SQL}, sig AS (SELECT *, CASE WHEN macd > macd_signal THEN 1.0::DOUBLE ELSE 0.0 END AS target FROM macd)"),
    "sg4_macd_ls": ("flags", lambda b: signal(b, "macd-ls", fast=6, slow=13, signal=5), f"{MACD_SQL}, sig AS (SELECT *, CASE WHEN macd > macd_signal THEN 1.0::DOUBLE WHEN macd < macd_signal THEN -1.0 ELSE 0.0 END AS target FROM macd)"),
    "sg5_breakout": ("closes", lambda b: signal(b, "breakout"), BREAK_LONG),
    "sg5_breakout_ls": ("closes", lambda b: signal(b, "breakout-ls"), BREAK_BOTH),
    "sg5_breakout_hold": ("closes", lambda b: signal(b, "breakout", min_hold=5), BREAK_HOLD),
    "sg6_rsi_rev": ("types", lambda b: signal(b, "rsi-rev"), reversion_sql(False)),
    "sg6_rsi_rev_ls": ("types", lambda b: signal(b, "rsi-rev-ls"), reversion_sql(True)),
    "sg7_tsmom": ("types", lambda b: signal(b, "tsmom", lookback=26, rebalance=4), grid_sql(MOM_SCORE, 4, False)),
    "sg7_tsmom_ls": ("types", lambda b: signal(b, "tsmom-ls", lookback=26, rebalance=4), grid_sql(MOM_SCORE, 4, True)),
    "sg8_tsmom_blend": ("types", lambda b: signal(b, "tsmom-blend", base=4, horizons=3, rebalance=4), grid_sql("(" + " + ".join(f"sign(close / lag(close, {n}) OVER w - 1)" for n in (4, 8, 16)) + ") / 3.0", 4, False)),
    "sg9_voltarget_sma": ("types", lambda b: signal(b, "voltarget-sma", window=20, vol_window=40), f"{vol_sql(40)}, sig AS (SELECT *, least(1.0, {SMA20} * {SCALE}) AS target FROM vols {W})"),
    "sg9_voltarget_sma_ls": ("types", lambda b: signal(b, "voltarget-sma-ls", window=20, vol_window=40), f"{vol_sql(40)}, sig AS (SELECT *, greatest(-1.0, least(1.0, (CASE WHEN close > {sma_sql(20)} THEN 1.0 WHEN close <= {sma_sql(20)} THEN -1.0 ELSE 0.0 END) * {SCALE})) AS target FROM vols {W})"),
    "sg9_voltarget_tsmom": ("types", lambda b: signal(b, "voltarget-tsmom", lookback=26, rebalance=4, vol_window=40), scaled_sql(grid_sql(MOM_SCORE, 4, False), SCALED)),
    "sg10_volfilter_sma": ("types", lambda b: signal(b, "volfilter-sma", window=20, vol_window=40, max_vol=1.6), f"{vol_sql(40)}, sig AS (SELECT *, CASE WHEN vol IS NULL OR vol <= 1.6 THEN {SMA20} ELSE 0.0 END AS target FROM vols {W})"),
    "sg10_volfilter_tsmom": ("types", lambda b: signal(b, "volfilter-tsmom", max_vol=1.6, vol_window=40), scaled_sql(grid_sql(MOM30, 7, False), CALM)),
    "sg10_voltarget_volfilter": ("types", lambda b: signal(b, "voltarget-volfilter-sma", window=20, vol_window=40, max_vol=1.6), scaled_sql(plain_sql(SMA20), SCALED.replace("$t", f"({CALM})"))),
    "sg11_stops_sma": ("closes", lambda b: signal(b, "stops-sma", window=20, stop_loss=0.1, take_profit=0.3, trail=0.2, cooldown=2), stops_sql(plain_sql(SMA20), 0.1, 0.3, 0.2, 2)),
    "sg11_stops_breakout": ("closes", lambda b: signal(b, "stops-breakout", stop_loss=0.1, trail=0.2), stops_sql(BREAK_LONG, 0.1, 0, 0.2, 0)),
    "sg11_voltarget_stops": ("types", lambda b: signal(b, "voltarget-stops-sma", window=20, stop_loss=0.1, vol_window=40), scaled_sql(stops_sql(plain_sql(SMA20), 0.1, 0, 0, 0).replace("within", "inside"), SCALED)),
    "sg12_liquid": ("types", lambda b: liquid_only(signal(b, "sma", window=20), 12, 1000.0), f"""liq AS (SELECT *, CASE WHEN {N} >= 12 THEN quantile_cont(turnover, 0.5) OVER (PARTITION BY symbol, timeframe ORDER BY time ROWS 11 PRECEDING) END AS med FROM bars {W}),
        sig AS (SELECT *, CASE WHEN med >= 1000 THEN {SMA20} ELSE 0.0 END AS target FROM liq {W})"""),
}
for _name, (_fixture, _plan, _sql) in RULES.items():
    _exits = _name.startswith("sg11_stops")
    on_bars(
        _name, _fixture, lambda b, plan=_plan, exits=_exits: rounded(plan(b).select(*ID, "target", *(["exit_price"] if exits else []))),
        f"{_sql} SELECT symbol, time, round(target, 6) AS target{', round(exit_price, 6) AS exit_price' if _exits else ''} FROM sig",
    )

on_bars(
    "wn14_decisions", "types", lambda b: I.decisions(I.step_of(b.where("time div 604800 % 11 not in (3, 4, 5, 6, 7)")), 3).where("decide").select(*ID),
    grid_sql("1.0", 3, False, "(SELECT * FROM bars WHERE time // 604800 % 11 NOT IN (3, 4, 5, 6, 7))").replace("FROM bars WINDOW", "FROM (SELECT * FROM bars WHERE time // 604800 % 11 NOT IN (3, 4, 5, 6, 7)) WINDOW").replace("0.0::DOUBLE AS target, false", "0.0::DOUBLE AS target, false").replace("THEN CASE WHEN score > 0 THEN 1.0  ELSE 0.0 END ELSE target END", "THEN 1.0 WHEN NOT done THEN 0.0 ELSE target END")
    + " SELECT symbol, time FROM sig WHERE target = 1",
)

CURVE = f"""c0 AS (SELECT *, coalesce(lag(target) OVER w, 0.0) AS pos FROM sig {W}),
c1 AS (SELECT *, coalesce(lag(pos) OVER w, 0.0) AS held, lag(open) OVER w AS o1 FROM c0 {W}),
c2 AS (SELECT *, coalesce(1 + held * (open / o1 - 1), 1.0) AS mv, abs(pos - held) AS turn FROM c1),
c3 AS (SELECT *, mv * pow(1 - {RATE}, turn) AS factor FROM c2),
c4 AS (SELECT *, CASE WHEN min(factor) OVER w <= 0 THEN 0.0 ELSE product(factor) OVER w END AS equity, CASE WHEN min(mv) OVER w <= 0 THEN 0.0 ELSE product(mv) OVER w END AS gross, min(factor) OVER w <= 0 AS ruined FROM c3 {W}),
c5 AS (SELECT *, coalesce(lag(ruined) OVER w, false) AS was, coalesce(lag(equity) OVER w, 1.0) AS eq1 FROM c4 {W}),
curve AS (SELECT *, CASE WHEN was THEN 0.0 ELSE pos END AS position, CASE WHEN was THEN 0.0 ELSE eq1 * mv END AS before,
                 {RATE} * turn * greatest(0.0, CASE WHEN was THEN 0.0 ELSE eq1 * mv END) AS fee FROM c5)"""


def ran(rule):
    fixture, plan, sql = RULES[rule]
    return fixture, (lambda b: C.equity_curve(plan(b), RATE)), f"{sql}, {CURVE}"


def on_curve(name, rule, plan, sql):
    fixture, make, prefix = ran(rule)
    on_bars(name, fixture, lambda b: plan(make(b)), f"{prefix}{sql}")


SHOWN = "round(position, 6) AS position, round(before, 6) + 0.0 AS before, round(equity, 6) AS equity, round(gross, 6) AS gross, round(fee, 6) AS fee, ruined"
for _rule in ("sg1_sma", "sg2_sma_ls", "sg7_tsmom", "sg5_breakout", "sg9_voltarget_sma"):
    on_curve(
        f"eq1_curve_{_rule[4:]}", _rule, lambda c: rounded(c.select(*ID, "position", "before", "equity", "gross", "fee", "ruined")), f" SELECT symbol, time, {SHOWN} FROM curve",
    )
LAST = """, z AS (SELECT symbol, timeframe, arg_max(equity, time) AS e, arg_max(gross, time) AS g, arg_max(position, time) AS p, arg_max(open, time) AS o, arg_max(close, time) AS c,
    sum(fee) AS fees_paid, avg(abs(position)) AS exposure, count(*) AS bars, max(ruined) AS ruined FROM curve GROUP BY symbol, timeframe)"""
on_curve(
    "eq4_summary", "sg1_sma", lambda c: rounded(C.summary(c)),
    f"{LAST} SELECT symbol, timeframe, bars, round(e * (1 + p * (c / o - 1)), 6) AS final_equity, round(g * (1 + p * (c / o - 1)), 6) AS gross_equity, round(fees_paid, 6) AS fees_paid, round(exposure, 6) AS exposure, ruined FROM z",
)
TRADES = """, t0 AS (SELECT *, CAST(sign(position) AS INT) AS side, coalesce(lag(CAST(sign(position) AS INT)) OVER w, 0) AS prev_side, lead(time) OVER w AS xt, lead(open) OVER w AS xo, lead(equity) OVER w AS xe FROM curve WINDOW w AS (PARTITION BY symbol, timeframe ORDER BY time)),
t1 AS (SELECT *, sum(CASE WHEN side <> prev_side THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, timeframe ORDER BY time) AS trade FROM t0),
t2 AS (SELECT symbol, timeframe, trade, min(side) AS side, min(time) AS entry_time, arg_min(open, time) AS entry_price, arg_min(CASE WHEN prev_side = 0 THEN before ELSE equity END, time) AS equity_at_entry, count(*) AS bars_held,
    CASE WHEN bool_or(xt IS NULL) THEN max(time) ELSE max(xt) END AS exit_time, bool_or(xt IS NULL) AS open_at_end,
    CASE WHEN bool_or(xt IS NULL) THEN arg_max(close, time) ELSE arg_max(xo, time) END AS exit_price,
    CASE WHEN bool_or(xt IS NULL) THEN arg_max(equity, time) * (1 + arg_max(position, time) * (arg_max(close, time) / arg_max(open, time) - 1)) ELSE arg_max(xe, time) END AS equity_at_exit
    FROM t1 WHERE side <> 0 GROUP BY symbol, timeframe, trade),
trades AS (SELECT *, pow(exit_price / entry_price, side) - 1 AS gross_return, equity_at_exit / nullif(equity_at_entry, 0) - 1 AS net_return FROM t2)"""
for _name, _rule in (("eq8_trades", "sg1_sma"), ("eq8_trades_ls", "sg5_breakout_ls")):
    on_curve(
        _name, _rule, lambda c: rounded(C.trades(c).drop("trade", "timeframe")),
        f"""{TRADES} SELECT symbol, side, entry_time, round(entry_price, 6) AS entry_price, exit_time, round(exit_price, 6) AS exit_price, bars_held, round(gross_return, 6) AS gross_return, round(net_return, 6) AS net_return,
        round(equity_at_entry, 6) AS equity_at_entry, round(equity_at_exit, 6) AS equity_at_exit, open_at_end FROM trades""",
    )
on_curve(
    "eq9_book_check", "sg1_sma", lambda c: C.book_check(C.trades(c), C.summary(c)).select("symbol", "ok", r6("error", "error")),
    f"{TRADES}{LAST} SELECT z.symbol, true AS ok, round(abs(product(1 + net_return) / (e * (1 + p * (c / o - 1))) - 1), 6) AS error FROM z JOIN trades t ON z.symbol = t.symbol GROUP BY z.symbol, e, p, c, o",
)
HOLD = "CASE WHEN row_number() OVER w = 1 THEN 1.0 ELSE close / nth_value(open, 2) OVER (PARTITION BY symbol, timeframe ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END"
on_bars("eq10_buy_hold", "types", lambda b: rounded(C.buy_and_hold(b).select(*ID, "hold", "hold_net")), f"SELECT symbol, time, round({HOLD}, 6) AS hold, round({HOLD} * pow(0.999, 2), 6) AS hold_net FROM bars {W}")
on_bars(
    "eq11_close_fill", "types", lambda b: rounded(C.close_fill(signal(b, "sma", window=20)).select(*ID, "close_equity")),
    f"""{RULES['sg1_sma'][2]}, f AS (SELECT *, coalesce(lag(target) OVER w, 0.0) AS held, lag(close) OVER w AS c1 FROM sig {W}),
    g AS (SELECT *, coalesce(1 + held * (close / c1 - 1), 1.0) * pow(0.999, abs(target - held)) AS fa FROM f) SELECT symbol, time, round(product(fa) OVER w, 6) AS close_equity FROM g {W}""",
)
on_curve(
    "eq7_fees_in", "sg1_sma", lambda c: rounded(C.fees_in(c, RATE, 50, 250)),
    f", n AS (SELECT *, row_number() OVER w - 1 AS k FROM curve {W}) SELECT symbol, timeframe, round(sum({RATE} * turn * equity / pow(1 - {RATE}, turn)), 6) AS fees FROM n WHERE k BETWEEN 50 AND 250 AND equity > 0 GROUP BY ALL",
)
on_curve(
    "eq12_restrict", "sg1_sma", lambda c: rounded(C.restrict(c, 800_000_000, 860_000_000).select(*ID, "equity", "marked", "hold")),
    f""", x AS (SELECT * FROM curve WHERE time BETWEEN 800000000 AND 860000000), y AS (SELECT *, equity / first_value(equity) OVER w AS eq, lead(time) OVER w IS NULL AS ends, {HOLD} AS hold FROM x {W})
    SELECT symbol, time, round(eq, 6) AS equity, round(CASE WHEN ends THEN eq * (1 + position * (close / open - 1)) ELSE eq END, 6) AS marked, round(hold, 6) AS hold FROM y""",
)
on_curve(
    "eq12_trades_within", "sg1_sma", lambda c: C.trades_within(C.trades(c), 800_000_000, 860_000_000).select("symbol", "entry_time", "exit_time"),
    f"{TRADES} SELECT symbol, greatest(entry_time, 800000000) AS entry_time, exit_time FROM trades WHERE entry_time <= 860000000 AND (exit_time > 800000000 OR open_at_end)",
)
FALLEN = "abs(equity / peak - 1)"
OVERLAY_STEP = f"""SELECT symbol, i, want AS pos, e AS equity, greatest(peak, e) AS peak FROM (SELECT symbol, i, want, peak, CASE WHEN i = 1 THEN 1.0 ELSE greatest(0.0, equity * (1 + pos * (open / o1 - 1)) * pow(1 - {RATE}, abs(want - pos))) END AS e
    FROM (SELECT n.symbol, n.i, n.open, n.o1, pos, equity, peak, CASE WHEN n.i = 1 OR equity <= 0 THEN 0.0 ELSE n.t1 * CASE WHEN {FALLEN} <= 0.1 THEN 1.0 WHEN {FALLEN} >= 0.4 THEN 0.2 ELSE 1 - 0.8 * ({FALLEN} - 0.1) / (0.4 - 0.1) END END AS want
          FROM walk w JOIN lined n ON n.symbol = w.symbol AND n.i = w.i + 1))"""
on_bars(
    "eq13_overlay", "types", lambda b: rounded(C.overlay(signal(b, "sma", window=20), 0.1, 0.4, 0.2).select(*ID, "scaled", "scaled_equity")),
    f"""{RULES['sg1_sma'][2]}, lined AS (SELECT *, row_number() OVER w AS i, lag(target) OVER w AS t1, lag(open) OVER w AS o1 FROM sig {W}),
    {walk_sql('lined', ('pos', 'equity', 'peak'), '0.0::DOUBLE AS pos, 1.0::DOUBLE AS equity, 1.0::DOUBLE AS peak', OVERLAY_STEP)}
    SELECT n.symbol, n.time, round(pos, 6) AS scaled, round(equity, 6) AS scaled_equity FROM lined n JOIN walk w ON n.symbol = w.symbol AND n.i = w.i""",
)
on_curve(
    "eq14_markers", "sg5_breakout_ls", lambda c: C.markers(c).select("symbol", "time", "kind", "side"),
    f"{TRADES} SELECT symbol, time, CASE WHEN prev_side = 0 THEN 'entry' WHEN side = 0 THEN 'exit' ELSE 'flip' END AS kind, side FROM t0 WHERE side <> prev_side",
)
FEES = (0.0, 0.0002, 0.0005, 0.001, 0.002)
SWEPT_KEYS = [*KEY, "rate"]


def fee_grid(b):
    rows = C.swept(signal(b, "sma", window=20), b.sparkSession.createDataFrame([(f,) for f in FEES], "rate double"))
    return rounded(C.summary(C.equity_curve(rows, F.col("rate"), SWEPT_KEYS), F.col("rate"), SWEPT_KEYS).select("symbol", F.col("rate"), "final_equity", "fees_paid"), "final_equity", "fees_paid")


_W2 = "WINDOW w AS (PARTITION BY symbol, rate ORDER BY time)"
on_bars(
    "eq15_fee_grid", "types", fee_grid,
    f"{RULES['sg1_sma'][2]}, sig2 AS (SELECT sig.*, rate FROM sig, (SELECT unnest([0.0, 0.0002, 0.0005, 0.001, 0.002]::DOUBLE[]) AS rate)), "
    + CURVE.replace("FROM sig ", "FROM sig2 ").replace(W, _W2).replace(f"1 - {RATE}", "1 - rate").replace(f"{RATE} * turn", "rate * turn")
    + LAST.replace("SELECT symbol, timeframe, arg_max", "SELECT symbol, rate, arg_max").replace("GROUP BY symbol, timeframe)", "GROUP BY symbol, rate)")
    + " SELECT symbol, rate, round(e * (1 + p * (c / o - 1)), 6) AS final_equity, round(fees_paid, 6) AS fees_paid FROM z",
)

PERF = f""", r0 AS (SELECT *, CASE WHEN lag(equity) OVER w > 0 THEN equity / lag(equity) OVER w - 1 END AS r, max(equity) OVER w AS peak FROM curve {W}),
r1 AS (SELECT *, equity / peak - 1 AS dd, max(CASE WHEN equity = peak AND equity > coalesce(prev, -1) THEN time END) OVER w AS pt FROM (SELECT *, lag(peak) OVER w AS prev FROM r0 {W}) {W}),
perf AS (SELECT symbol, timeframe, arg_max(equity, time) AS fe, count(*) AS points, stddev_pop(r) * sqrt({WEEKS!r}) AS vol, avg(ln(1 + r)) / stddev_pop(ln(1 + r)) * sqrt({WEEKS!r}) AS sharpe, count(*) / {WEEKS!r} AS years,
    min(dd) AS mdd, arg_min(time, (dd, time)) AS trough, arg_min(pt, (dd, time)) AS peak_time FROM r1 GROUP BY symbol, timeframe)"""
on_curve(
    "ag8_performance", "sg1_sma", lambda c: rounded(P.performance(c, WEEKS)),
    f"""{PERF} SELECT symbol, timeframe, round(fe, 6) AS final_equity, round(fe - 1, 6) AS total_return, round(exp(ln(fe) / years) - 1, 6) AS cagr, round(vol, 6) AS ann_vol, round(sharpe, 6) AS sharpe, round(years, 6) AS years, points,
    round(mdd, 6) AS max_drawdown, peak_time AS dd_start, trough AS dd_end FROM perf""",
)
on_curve(
    "ag9_max_drawdown", "sg7_tsmom", lambda c: rounded(P.max_drawdown(c)), f"{PERF} SELECT symbol, timeframe, round(mdd, 6) AS max_drawdown, peak_time AS dd_start, trough AS dd_end FROM perf",
)
on_curve(
    "ag10_trade_stats", "sg1_sma", lambda c: rounded(P.trade_stats(C.trades(c)).drop("timeframe")),
    f"""{TRADES} SELECT symbol, count(*) AS n_closed, round(avg(CASE WHEN net_return > 0 THEN 1.0 ELSE 0.0 END), 6) AS win_rate, round(avg(net_return), 6) AS mean_return, round(median(net_return), 6) AS median_return,
    round(exp(avg(ln(1 + net_return))) - 1, 6) AS geometric_return, round(avg(bars_held), 6) AS mean_bars, round(max(net_return), 6) AS best, round(min(net_return), 6) AS worst FROM trades WHERE NOT open_at_end GROUP BY symbol""",
)
on_curve("ag11_exposure", "sg9_voltarget_sma", lambda c: c.groupBy("symbol").agg(r6(F.avg(F.abs("position")), "exposure")), " SELECT symbol, round(avg(abs(position)), 6) AS exposure FROM curve GROUP BY symbol")
on_curve("ag24_cost_drag", "sg7_tsmom", lambda c: c.groupBy("symbol").agg(r6(F.sum("fee"), "fees")), " SELECT symbol, round(sum(fee), 6) AS fees FROM curve GROUP BY symbol")


def _entry(spark, sf):
    return rounded(P.performance(C.equity_curve(signal(event_bars(spark, sf), "sma", window=20), RATE), 1460.0).drop("dd_start", "dd_end", "cagr"))


_PERF6 = PERF.replace(repr(WEEKS), "1460.0")
on_tables(
    "entry", _entry,
    f"""WITH {FIXTURES["ticks"][1]}, {RULES["sg1_sma"][2]}, {CURVE}{_PERF6} SELECT symbol, timeframe, round(fe, 6) AS final_equity, round(fe - 1, 6) AS total_return,
    round(vol, 6) AS ann_vol, round(sharpe, 6) AS sharpe, round(years, 6) AS years, points, round(mdd, 6) AS max_drawdown FROM perf""",
)
