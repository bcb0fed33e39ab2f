"""Queries of risk books, parameter search, run registries, screens, scalars and streams."""

from __future__ import annotations

import re

from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from barloom.functions import scalars
from barloom.functions.timegrid import DAY
from barloom.operators import crosssection as X
from barloom.operators import curve as C
from barloom.operators import indicators as I
from barloom.operators import joins as J
from barloom.operators import riskbook as R
from barloom.operators import runs as G
from barloom.operators import screens as S
from barloom.operators import search as H
from barloom.operators.performance import performance
from barloom.operators.signals import signal
from barloom.plans.base import FIXTURES, W, on_bars, on_tables, r6, rounded
from barloom.plans.books_plans import ALIGNED, BOOK, CS, LEGS, PANEL, WEEK, calendar, picks, read, sparse
from barloom.plans.rules_plans import CURVE, LAST, PERF, RULES, TRADES, WEEKS, grid_sql, plain_sql, sma_sql
from barloom.sources import bars as B
from barloom.sources.derived import EVENT_SQL, table, ticks, trade_bars, trade_sql
from barloom.sources.workspace import kept, new_folder
from barloom.streaming import streams as ST

RATE, TOP, LOOK, EVERY, OLD, VOL = 0.001, 5, 8, 4, 10, 20
PER_YEAR = 365 / 7


def rows_of(b):
    return J.aligned(b, calendar(b), 5 * WEEK)


AL = ALIGNED.replace("AGED", str(5 * WEEK))
on_bars("rp1_aligned", "brands", lambda b: rounded(rows_of(b), "turnover"), f"{AL} SELECT symbol, idx, time, price, round(turnover, 6) AS turnover, first_idx FROM aligned")
UNI = f"""{AL}, tr AS (SELECT *, sum(turnover) OVER (PARTITION BY symbol ORDER BY idx ROWS {LOOK - 1} PRECEDING) AS traded FROM aligned),
uni AS (SELECT symbol, idx, traded, place FROM (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY traded DESC, symbol) AS place FROM tr WHERE idx >= 1 AND idx % {EVERY} = 0 AND price IS NOT NULL AND idx - first_idx >= {OLD}) WHERE place <= {TOP})"""


def uni(b):
    return R.universe(rows_of(b), TOP, LOOK, EVERY, OLD)


ranks = lambda chosen: chosen.select("symbol", "idx", r6("traded", "traded"), F.col("place").cast("int").alias("place"))
SHOWN_RANKS = "SELECT symbol, idx, round(traded, 6) AS traded, CAST(place AS INT) AS place FROM uni"
on_bars("rp2_universe", "brands", lambda b: ranks(uni(b)), f"{UNI} {SHOWN_RANKS}")
on_bars("wn13_turnover_rank", "brands", lambda b: ranks(R.universe(rows_of(b), 1_000_000, 3 * LOOK, 1)), f"{UNI.replace(f'ROWS {LOOK - 1}', f'ROWS {3 * LOOK - 1}').replace(f'idx % {EVERY} = 0', 'true').replace(f'>= {OLD}', '>= 0').replace(f'<= {TOP}', '<= 1000000')} {SHOWN_RANKS}")
VOLS = f"""rt AS (SELECT *, CASE WHEN lag(price) OVER x > 0 THEN price / lag(price) OVER x - 1 END AS r FROM aligned WINDOW x AS (PARTITION BY symbol ORDER BY idx)),
vol AS (SELECT symbol, idx, CASE WHEN count(r) OVER x >= 3 THEN stddev_pop(r) OVER x * sqrt({PER_YEAR!r}) END AS vol FROM rt WINDOW x AS (PARTITION BY symbol ORDER BY idx ROWS {VOL - 1} PRECEDING))"""
on_bars("wn19_trailing_vol", "brands", lambda b: R.trailing_vol(rows_of(b), VOL, PER_YEAR).select("symbol", "idx", r6("vol", "vol")), f"{AL}, {VOLS} SELECT symbol, idx, round(vol, 6) AS vol FROM vol")


def weights_of(b, scheme, gate=False):
    return weights_on(R.trend_ok(rows_of(b), 8) if gate else rows_of(b), scheme, gate)


def weights_on(rows, scheme, gate=False):
    """Weights among the universe of aligned rows, or among those of it whose price is above that of 8 bars before."""
    rows = rows if scheme == "equal" else R.trailing_vol(rows, VOL, PER_YEAR)
    chosen = R.universe(rows, TOP, LOOK, EVERY, OLD, tuple(c for c in ("vol", "up") if c in rows.columns))
    return R.weighted(chosen.where("up") if gate else chosen, scheme)


INVERSE = f"{UNI}, {VOLS}, iw AS (SELECT u.symbol, u.idx, 1 / vol AS i FROM uni u JOIN vol v ON u.symbol = v.symbol AND u.idx = v.idx WHERE vol >= 0.1), wt AS (SELECT symbol, idx, i / sum(i) OVER (PARTITION BY idx) AS weight FROM iw)"
on_bars("rp3_inverse_vol", "brands", lambda b: rounded(weights_of(b, "inverse").select("symbol", "idx", "weight")), f"{INVERSE} SELECT symbol, idx, round(weight, 6) AS weight FROM wt")
CAP = 0.22


def cap_sql(source, passes):
    out, last = [], source
    for n in range(passes):
        out.append(
            f"q{n} AS (SELECT *, sum(greatest(weight - {CAP}, 0)) OVER e AS cut, CASE WHEN weight < {CAP} THEN weight ELSE 0 END AS room, sum(CASE WHEN weight < {CAP} THEN weight ELSE 0 END) OVER e AS rooms FROM {last} WINDOW e AS (PARTITION BY idx)), "
            f"p{n} AS (SELECT symbol, idx, least(weight, {CAP}) + CASE WHEN rooms > 0 THEN cut * room / rooms ELSE 0 END AS weight FROM q{n})"
        )
        last = f"p{n}"
    return ", ".join(out) + f", capped AS (SELECT symbol, idx, least(weight, {CAP}) AS weight FROM {last})"


on_bars("rp4_capped", "brands", lambda b: rounded(R.capped(weights_of(b, "inverse"), CAP).select("symbol", "idx", "weight")), f"{INVERSE}, {cap_sql('wt', R.PASSES)} SELECT symbol, idx, round(weight, 6) AS weight FROM capped")
on_bars("rp5_trend_ok", "brands", lambda b: R.trend_ok(rows_of(b), 8).select("symbol", "idx", "up"), f"{AL} SELECT symbol, idx, coalesce(price > lag(price, 8) OVER (PARTITION BY symbol ORDER BY idx), false) AS up FROM aligned")


def held_of(b, scheme="equal", gate=False):
    """Positions, worked out once: the aligned rows and the positions are each read by several branches of what follows."""
    rows = kept(R.trend_ok(rows_of(b), 8) if gate else rows_of(b), "aligned")
    return kept(R.positions(rows, weights_on(rows, scheme, gate).select("symbol", "idx", "weight"), EVERY, gate), "positions")


def unit(b, scheme="equal", gate=False):
    return R.unit_book(held_of(b, scheme, gate), RATE)


UNIT = f"""eq AS (SELECT u.symbol, u.idx, 1.0::DOUBLE / count(*) OVER (PARTITION BY u.idx) AS weight FROM uni u),
sp AS (SELECT e.symbol, e.idx + 1 AS fill, weight, unnest(range(e.idx + 1, e.idx + {EVERY} + 2)) AS idx FROM eq e),
ps AS (SELECT s.*, last_value(a.price IGNORE NULLS) OVER (PARTITION BY s.symbol, s.fill ORDER BY s.idx) AS p FROM sp s JOIN aligned a ON s.symbol = a.symbol AND s.idx = a.idx),
ra AS (SELECT *, coalesce(p / first_value(p) OVER (PARTITION BY symbol, fill ORDER BY idx), 1) AS ratio FROM ps),
un AS (SELECT *, 1 + sum(weight * (ratio - 1)) OVER (PARTITION BY fill, idx) AS unit FROM ra),
gr AS (SELECT idx, growth FROM (SELECT DISTINCT fill, idx, unit, unit / lag(unit) OVER (PARTITION BY fill ORDER BY idx) AS growth FROM (SELECT DISTINCT fill, idx, unit FROM un)) WHERE idx > fill),
sw AS (SELECT coalesce(o.idx, n.idx) AS idx, sum(abs(coalesce(n.weight, 0) - coalesce(o.share, 0))) AS turnover
       FROM (SELECT symbol, idx, weight * ratio / unit AS share FROM un WHERE idx > fill AND idx IN (SELECT fill FROM sp)) o FULL JOIN (SELECT symbol, idx, weight FROM un WHERE idx = fill) n ON o.symbol = n.symbol AND o.idx = n.idx GROUP BY 1),
bk AS (SELECT b.idx, b.fill, coalesce(growth, 1) AS growth, coalesce(turnover, 0) AS turnover, invested FROM (SELECT idx, max(fill) AS fill, arg_max(inv, fill) AS invested FROM (SELECT idx, fill, sum(weight * ratio / unit) AS inv FROM un GROUP BY ALL) GROUP BY idx) b
       LEFT JOIN gr ON b.idx = gr.idx LEFT JOIN sw ON b.idx = sw.idx),
book AS (SELECT *, product(growth * greatest(1 - turnover * {RATE}, 0)) OVER (ORDER BY idx) AS equity FROM bk)"""
on_bars("rp9_passive_book", "brands", lambda b: rounded(unit(b).drop("cost").withColumn("equity", F.ln("equity"))), f"{UNI}, {UNIT} SELECT idx, fill, round(growth, 6) AS growth, round(turnover, 6) AS turnover, round(invested, 6) AS invested, round(ln(equity), 6) AS equity FROM book")
on_bars("rp8_book", "brands", lambda b: rounded(unit(b, "inverse").drop("cost").withColumn("equity", F.ln("equity"))), f"{INVERSE}, {UNIT.replace('eq AS (SELECT u.symbol, u.idx, 1.0::DOUBLE / count(*) OVER (PARTITION BY u.idx) AS weight FROM uni u)', 'eq AS (SELECT * FROM wt)')} SELECT idx, fill, round(growth, 6) AS growth, round(turnover, 6) AS turnover, round(invested, 6) AS invested, round(ln(equity), 6) AS equity FROM book")
GATED = f"""eq AS (SELECT u.symbol, u.idx, 1.0::DOUBLE / count(*) OVER (PARTITION BY u.idx) AS weight FROM uni u JOIN st USING (symbol, idx) WHERE up),
fl AS (SELECT fill, coalesce(lead(fill) OVER (ORDER BY fill), z) AS until FROM (SELECT DISTINCT idx + 1 AS fill FROM eq), (SELECT max(idx) AS z FROM aligned) WHERE fill <= z),
sp AS (SELECT symbol, fill, until, weight, unnest(range(fill, until + 1)) AS idx FROM eq JOIN fl ON fill = eq.idx + 1),
w0 AS (SELECT sp.*, step, CASE WHEN NOT up AND sp.idx % {EVERY} <> 0 THEN 1 ELSE 0 END AS fail FROM sp JOIN st USING (symbol, idx)),
w1 AS (SELECT *, coalesce(max(fail) OVER (PARTITION BY symbol, fill ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone,
              coalesce(max(fail) OVER (PARTITION BY symbol, fill ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING), 0) AS over_ FROM w0),
w2 AS (SELECT *, product(CASE WHEN idx = fill OR over_ = 1 THEN 1.0 ELSE step END) OVER (PARTITION BY symbol, fill ORDER BY idx) AS ratio FROM w1),
un AS (SELECT fill, idx, 1 + sum(weight * (ratio - 1)) AS unit, sum(CASE WHEN gone = 1 AND over_ = 0 THEN weight * ratio ELSE 0 END) AS exits, sum(CASE WHEN gone = 0 THEN weight * ratio ELSE 0 END) AS alive FROM w2 GROUP BY fill, idx),
inc AS (SELECT * FROM (SELECT *, unit / lag(unit) OVER (PARTITION BY fill ORDER BY idx) AS growth FROM un) WHERE idx > fill),
nm AS (SELECT symbol, idx, sum(CASE WHEN idx = fill THEN weight ELSE 0 END) AS new, sum(CASE WHEN idx > fill AND gone = 0 THEN weight * ratio ELSE 0 END) AS old FROM w2 WHERE idx IN (SELECT fill FROM fl) GROUP BY symbol, idx),
sw AS (SELECT nm.idx, sum(abs(new - old / coalesce(unit, 1))) AS moved, sum(new) AS bought FROM nm LEFT JOIN inc ON nm.idx = inc.idx GROUP BY nm.idx),
bk AS (SELECT coalesce(inc.idx, sw.idx) AS idx, CASE WHEN sw.idx IS NULL THEN fill ELSE sw.idx END AS fill, coalesce(growth, 1) AS growth, coalesce(exits / unit, 0) AS sold, coalesce(moved, 0) AS moved, coalesce(bought, alive / unit) AS invested
       FROM inc FULL JOIN sw ON inc.idx = sw.idx),
book AS (SELECT *, sold + moved AS turnover, product(growth * (1 - sold * {RATE}) * (1 - moved * {RATE})) OVER (ORDER BY idx) AS equity FROM bk)"""
STEPS = "st AS (SELECT symbol, idx, coalesce(price / lag(price) OVER (PARTITION BY symbol ORDER BY idx), 1) AS step, coalesce(price > lag(price, 8) OVER (PARTITION BY symbol ORDER BY idx), false) AS up FROM aligned)"
on_bars("rp6_gated_book", "brands", lambda b: rounded(unit(b, "equal", True).drop("cost").withColumn("equity", F.ln("equity"))), f"{UNI}, {STEPS}, {GATED} SELECT idx, fill, round(growth, 6) AS growth, round(turnover, 6) AS turnover, round(invested, 6) AS invested, round(ln(equity), 6) AS equity FROM book")
on_bars("rp7_budget_scaled", "brands", lambda b: rounded(R.budget_scaled(R.book_bars(held_of(b, "inverse")).withColumn("book_id", F.lit(0)), 0.3, 12, PER_YEAR, RATE).drop("book_id")))
on_bars("rp10_single_hold", "brands", lambda b: rounded(R.single_hold(rows_of(b), "Brand#23", RATE)), f"{AL} SELECT idx, round(coalesce(last_value(price IGNORE NULLS) OVER x / first_value(price IGNORE NULLS) OVER x * (1 - {RATE}), 1), 6) AS hold FROM aligned WHERE symbol = 'Brand#23' WINDOW x AS (ORDER BY idx)")
on_bars("rp11_shares", "brands", lambda b: rounded(R.shares(unit(b))), f"{UNI}, {UNIT} SELECT round(avg(invested), 6) AS invested, round(avg(CASE WHEN invested <= 0 THEN 1.0 ELSE 0.0 END), 6) AS flat, round(avg(turnover), 6) AS turnover, round(avg(1 - greatest(1 - turnover * {RATE}, 0)), 6) AS cost FROM book")
on_bars(
    "rp12_restricted", "brands", lambda b: rounded(R.restricted(unit(b), 100, 200, R.single_hold(rows_of(b), "Brand#23", RATE), RATE)),
    f"""{UNI}, {UNIT}, hd AS (SELECT idx, price / first_value(price IGNORE NULLS) OVER (ORDER BY idx) AS hold FROM aligned WHERE symbol = 'Brand#23'), co AS (SELECT *, coalesce(lag(equity) OVER (ORDER BY idx), 1) * growth - equity AS cost FROM book)
    SELECT co.idx - 100 AS idx, round(equity / first_value(equity) OVER o, 6) AS equity, round(cost / first_value(equity) OVER o, 6) AS cost, round(invested, 6) AS invested, round(turnover, 6) AS turnover,
    round(hold / first_value(hold) OVER o * (1 - {RATE}), 6) AS hold FROM co JOIN hd ON co.idx = hd.idx WHERE co.idx BETWEEN 100 AND 200 WINDOW o AS (ORDER BY co.idx)""",
)

GRID = H.expand_grid({"window": [5, 10, 20, 40]})
TRAIN, TEST = 100, 40


def renamed(sql, n):
    return re.sub(r"\b(sig|c[0-5]|curve)\b", rf"\1_{n}", sql)


CANDS = ", ".join(renamed(f"{plain_sql(f'CASE WHEN close > {sma_sql(g['window'])} THEN 1.0 ELSE 0.0 END')}, {CURVE}", n) for n, g in enumerate(GRID)) + ", cand AS (" + " UNION ALL ".join(
    f"SELECT symbol, timeframe, {n} AS candidate, row_number() OVER (PARTITION BY symbol ORDER BY time) - 1 AS i, time, open, close, equity FROM curve_{n}" for n in range(len(GRID))
) + ")"
SPLITS = f"""splits AS (SELECT symbol, timeframe, s AS split, s * {TEST} AS train_start, s * {TEST} + {TRAIN} AS train_end, s * {TEST} + {TRAIN + TEST} AS test_end
    FROM (SELECT symbol, timeframe, unnest(range((count(*) - {TRAIN + TEST}) // {TEST} + 1)) AS s FROM bars GROUP BY symbol, timeframe HAVING count(*) >= {TRAIN + TEST}))"""
SCORES = f"""tr AS (SELECT c.*, split, ln(equity / lag(equity) OVER (PARTITION BY c.symbol, split, candidate ORDER BY i)) AS l FROM cand c JOIN splits s ON c.symbol = s.symbol AND i >= train_start AND i < train_end),
scores AS (SELECT symbol, timeframe, split, candidate, arg_max(equity, i) / arg_min(equity, i) AS total, count(*) AS n, CASE WHEN stddev_pop(l) > 0 THEN avg(l) / stddev_pop(l) * sqrt({WEEKS!r}) ELSE 0 END AS sharpe FROM tr GROUP BY ALL)"""
PICKS = "picks AS (SELECT symbol, timeframe, split, candidate, score FROM (SELECT *, round(sharpe, 12) AS score, row_number() OVER (PARTITION BY symbol, split ORDER BY round(sharpe, 12) DESC, candidate) AS p FROM scores) WHERE p = 1)"


def searched(b):
    curves = H.candidates(b, "sma", GRID, RATE)
    splits = H.series_splits(b, TRAIN, TEST)
    return curves, splits, H.scores(curves, splits, WEEKS)


on_bars("wf1_splits", "types", lambda b: H.series_splits(b, TRAIN, TEST), f"{SPLITS} SELECT symbol, timeframe, split, train_start, train_end, test_end FROM splits")
on_bars("wf3_scores", "types", lambda b: rounded(searched(b)[2]), f"{CANDS}, {SPLITS}, {SCORES} SELECT symbol, timeframe, split, candidate, round(total - 1, 6) AS total_return, round(exp(ln(total) / (n / {WEEKS!r})) - 1, 6) AS cagr, round(sharpe, 6) AS sharpe FROM scores")
on_bars("wf4_chosen", "types", lambda b: rounded(H.chosen(searched(b)[2])), f"{CANDS}, {SPLITS}, {SCORES}, {PICKS} SELECT symbol, timeframe, split, candidate, round(score, 6) AS score FROM picks")
on_bars("wf7_stability", "types", lambda b: rounded(H.stability(H.chosen(searched(b)[2]))), f"{CANDS}, {SPLITS}, {SCORES}, {PICKS} SELECT symbol, timeframe, candidate, count(*) AS wins, round(count(*) / sum(count(*)) OVER (PARTITION BY symbol), 6) AS share FROM picks GROUP BY symbol, timeframe, candidate")


def stitch(b):
    curves, splits, scored = searched(b)
    return rounded(H.stitched(curves, splits, H.chosen(scored), RATE).select("symbol", "split", "i", "equity", "benchmark"))


on_bars(
    "jn10_splits_by_candidates", "types", lambda b: (lambda c, s, _: c.join(s, list(B.KEY)).where("i >= train_start and i < test_end").groupBy("symbol", "split", "candidate").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time")))(*searched(b)),
    f"{CANDS}, {SPLITS} SELECT c.symbol, split, candidate, count(*) AS n, min(time) AS first_time, max(time) AS last_time FROM cand c JOIN splits s ON c.symbol = s.symbol AND i >= train_start AND i < test_end GROUP BY ALL",
)
for _name in ("wf5_stitched",):
    on_bars(
        _name, "types", stitch,
        f"""{CANDS}, {SPLITS}, {SCORES}, {PICKS}, ts AS (SELECT c.symbol, p.split, c.i, c.equity / first_value(c.equity) OVER (PARTITION BY c.symbol, p.split ORDER BY c.i) AS part, c.close / e.close * pow(1 - {RATE}, 2) AS hold
          FROM cand c JOIN picks p ON c.symbol = p.symbol AND c.candidate = p.candidate JOIN splits s ON p.symbol = s.symbol AND p.split = s.split AND c.i >= s.train_end AND c.i < s.test_end JOIN cand e ON e.symbol = c.symbol AND e.candidate = 0 AND e.i = s.train_end - 1),
        en AS (SELECT symbol, split, product(arg_max(part, i)) OVER z AS lv, product(arg_max(hold, i)) OVER z AS hl FROM ts GROUP BY symbol, split WINDOW z AS (PARTITION BY symbol ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT t.symbol, t.split, t.i, round(part * coalesce(lv, 1), 6) AS equity, round(hold * coalesce(hl, 1), 6) AS benchmark FROM ts t JOIN en e ON t.symbol = e.symbol AND t.split = e.split""",
    )

on_bars("rg1_fingerprints", "types", G.fingerprints)
on_bars(
    "rg1_quick_fingerprints", "types", lambda b: G.quick_fingerprints(b).select("symbol", "bars", F.col("mark").cast("string").alias("mark")),
    f"""SELECT symbol, count(*) AS bars, CAST(CAST(sum(CAST('0x' || substr(md5(concat_ws('|', time, {', '.join(f'CAST(round({c} * 1000000) AS BIGINT)' for c in ('open', 'high', 'low', 'close', 'volume'))})), 1, 12) AS BIGINT)) AS HUGEINT) AS VARCHAR) AS mark
    FROM bars GROUP BY symbol""",
)


def metric_rows(b, bump):
    s = C.summary(C.equity_curve(signal(b, "sma", window=20), RATE))
    value = F.when(F.lit(bump) & (F.length("symbol") % 2 == 0), F.col("final_equity") * 1.001).otherwise(F.col("final_equity"))
    return s.select(F.col("symbol").alias("run_id"), F.explode(F.array(F.struct(F.lit("final").alias("field"), value.alias("value")), F.struct(F.lit("fees").alias("field"), F.col("fees_paid").alias("value")))).alias("x")).select("run_id", "x.*")


SUMS = f"{RULES['sg1_sma'][2]}, {CURVE}{LAST}, fin AS (SELECT symbol, e * (1 + p * (c / o - 1)) AS v, fees_paid FROM z)"
BUMPED = lambda b: metric_rows(b, True).where("field <> 'fees' or run_id <> 'PROMO'")
GONE = "SELECT symbol AS run_id, 'fees' AS field, round(fees_paid, 6) AS recorded, NULL::DOUBLE AS actual FROM fin WHERE symbol = 'PROMO'"
on_bars(
    "rg4_compared", "types", lambda b: rounded(G.compared(metric_rows(b, False), BUMPED(b))),
    f"{SUMS} SELECT symbol AS run_id, 'final' AS field, round(v, 6) AS recorded, round(v * 1.001, 6) AS actual FROM fin WHERE length(symbol) % 2 = 0 UNION ALL {GONE}",
)
# What differs by less than the tolerance is no difference; what is missing is one at any.
on_bars("jn8_metric_diff", "types", lambda b: rounded(G.compared(metric_rows(b, False), BUMPED(b), 0.01)), f"{SUMS} {GONE}")
CHECKS = "SELECT event_type AS run_id, event_id AS seq, event_id // 50 AS verified_at, CASE event_id % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'mismatch' ELSE 'data-changed' END AS status FROM events"


def checks(spark, sf):
    return table(spark, sf, "events").selectExpr("event_type as run_id", "event_id as seq", "event_id div 50 as verified_at", "case event_id % 3 when 0 then 'verified' when 1 then 'mismatch' else 'data-changed' end as status")


on_tables("rg6_latest_status", lambda spark, sf: G.latest_status(checks(spark, sf)), f"WITH c AS ({CHECKS}) SELECT run_id, arg_max(status, (verified_at, seq)) AS status, max(verified_at) AS verified_at FROM c GROUP BY run_id")
RUN_SQL = "r AS (SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS strategy, CAST(event_id % 4 AS VARCHAR) AS params, event_id AS recorded_at, value AS total FROM events)"


def run_rows(spark, sf):
    return table(spark, sf, "events").selectExpr("cast(event_id as string) as run_id", "event_type as strategy", "cast(event_id % 4 as string) as params", "event_id as recorded_at", "value as total")


on_tables(
    "ag19_run_rollup", lambda spark, sf: rounded(G.rolled_up(run_rows(spark, sf), checks(spark, sf).select(F.col("seq").cast("string").alias("run_id"), "status"))),
    f"WITH {RUN_SQL} SELECT strategy, params, count(*) AS runs, round(arg_max(total, recorded_at), 6) AS latest, round(max(total), 6) AS best, round(min(total), 6) AS worst, CAST(sum(CASE WHEN recorded_at % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS verified FROM r GROUP BY strategy, params",
)
on_tables(
    "sc12_unique_ids", lambda spark, sf: G.named(run_rows(spark, sf), "params", ["recorded_at"]).select("run_id", "recorded_at"),
    f"WITH {RUN_SQL} SELECT CASE WHEN n = 1 THEN params ELSE params || '-' || CAST(n AS VARCHAR) END AS run_id, recorded_at FROM (SELECT *, row_number() OVER (PARTITION BY params ORDER BY recorded_at) AS n FROM r)",
)
MOMENTS = ("2026-01-02T03:04:05Z", "2026-02-03T04:05:06Z")
COSTS = {"fee": 0.0008, "slippage": 0.0002}


def recorded(b, moment=MOMENTS[0], strategy="sma", **params):
    return G.record_runs(b, strategy, params or {"window": 20}, "1w", moment, **COSTS)


def stored_runs(spark, *records):
    """Records appended to a registry and read again."""
    path = new_folder(spark, "runs")
    for rows in records:
        G.append_runs(rows, path)
    return G.read_runs(spark, path)


def run_table(b):
    runs = stored_runs(b.sparkSession, *[recorded(b, m) for m in MOMENTS])
    even = runs.where("length(data.symbol) % 2 = 0 and recorded_at < '2026-02'").select("run_id", F.lit("verified").alias("status"))
    return rounded(G.run_table(runs, even))


on_bars(
    "rg8_run_table", "types", run_table,
    f"""{RULES['sg1_sma'][2]}, {CURVE}{TRADES}{PERF}, n AS (SELECT symbol, count(*) AS trades FROM trades WHERE NOT open_at_end GROUP BY symbol)
    SELECT replace(replace(replace(replace(m, '-', ''), ':', ''), 'T', ''), 'Z', '') || '-sma-' || p.symbol || '-1w' AS run_id, m AS recorded_at, 'sma' AS strategy, round(fe - 1, 6) AS total_return, round(exp(ln(fe) / years) - 1, 6) AS cagr, round(mdd, 6) AS max_dd,
    round(sharpe, 6) AS sharpe, coalesce(trades, 0) AS trades, 0 AS legs, CASE WHEN length(p.symbol) % 2 = 0 AND m = '{MOMENTS[0]}' THEN 'verified' ELSE '-' END AS status FROM perf p LEFT JOIN n ON p.symbol = n.symbol, (SELECT unnest({list(MOMENTS)}) AS m)""",
)
AUDIT = """q AS (SELECT symbol, count(*) AS bars, min(time) AS first_time, max(time) AS last_time, CAST(sum(CASE WHEN time <> expected THEN 1 ELSE 0 END) AS BIGINT) AS gaps,
    CAST(sum(CASE WHEN time > expected THEN (time - expected + 604799) // 604800 ELSE 0 END) AS BIGINT) AS missing_bars FROM (SELECT *, lag(time) OVER w + 604800 AS expected FROM bars """ + W + """) GROUP BY symbol)"""
RECORD_SQL = f"""{RULES['sg1_sma'][2]}, {CURVE}{PERF}{LAST}, {AUDIT} SELECT '20260102030405-sma-' || q.symbol || '-1w' AS run_id, 'sma' AS strategy, '20' AS window, 0.0008::DOUBLE AS fee, bars, first_time, last_time, gaps, missing_bars, 64 AS digits,
    round(fe - 1, 6) AS total_return, round(fees_paid, 6) AS fees_paid, round(exposure, 6) AS exposure FROM q JOIN perf p ON q.symbol = p.symbol JOIN (SELECT symbol, fees_paid, exposure FROM z) z ON q.symbol = z.symbol"""


def shown_runs(runs):
    m = F.col("metrics")
    return rounded(runs.select(
        "run_id", "strategy", F.col("params")["window"].alias("window"), F.col("costs.fee_per_side").alias("fee"), "data.bars", F.col("data.first").alias("first_time"), F.col("data.last").alias("last_time"), "data.gaps", "data.missing_bars",
        F.length("data.digest").alias("digits"), m["strategy.total_return"].alias("total_return"), m["fees_paid"].alias("fees_paid"), m["exposure"].alias("exposure"),
    ))


on_bars("rg2_recorded", "types", lambda b: shown_runs(stored_runs(b.sparkSession, recorded(b))), RECORD_SQL)
on_bars("js1_json", "types", lambda b: shown_runs(recorded(b).select(F.to_json(F.struct("*")).alias("line")).select(F.from_json("line", G.RUNS).alias("r")).select("r.*")), RECORD_SQL)


def run_checks(b):
    """Records of all bars but the last, checked against an archive that has gone on and in which some series have changed."""
    known = b.withColumn("__end", F.max("time").over(Win.partitionBy("symbol"))).where("time < __end").drop("__end")
    runs = stored_runs(b.sparkSession, recorded(known), G.record_basket(known.where("symbol in ('ECONOMY', 'PROMO')"), "sma", {"window": 20}, "1w", MOMENTS[0], **COSTS))
    runs = runs.withColumn("strategy", F.when(F.col("data.symbol") == "PROMO", "gone").otherwise(F.col("strategy")))
    ends = b.where("symbol <> 'LARGE'").withColumn("__end", F.max("time").over(Win.partitionBy("symbol"))).withColumn("__first", F.min("time").over(Win.partitionBy("symbol")))
    even = (F.length("symbol") % 2 == 0) & (F.col("time") == F.col("__end") - WEEK)
    archive = ends.withColumn("close", F.when(even, F.col("close") * 1.1).otherwise(F.col("close"))).withColumn("volume", F.when((F.col("symbol") == "SMALL") & (F.col("time") == F.col("__first")), F.col("volume") + 1).otherwise(F.col("volume")))
    found = G.verify_runs(runs, archive.drop("__end", "__first"), "2026-03-04T05:06:07Z")
    return found.select("run_id", "status", "bars", (F.col("digest_recorded") == F.col("digest_actual")).alias("same_bars"), (F.size(F.coalesce("mismatches", F.array())) > 0).alias("differs"))


on_bars(
    "rg3_verified_runs", "types", run_checks,
    """n AS (SELECT symbol, count(*) - 1 AS bars FROM bars GROUP BY symbol), s AS (SELECT symbol, bars, CASE WHEN symbol = 'LARGE' THEN 'error' WHEN symbol = 'PROMO' THEN 'unknown-strategy' WHEN length(symbol) % 2 = 0 THEN 'mismatch' WHEN symbol = 'SMALL' THEN 'data-changed' ELSE 'verified' END AS status FROM n)
    SELECT '20260102030405-sma-' || symbol || '-1w' AS run_id, status, CASE WHEN status = 'error' THEN 0 ELSE bars END AS bars, status IN ('verified', 'unknown-strategy') AS same_bars, status = 'mismatch' AS differs FROM s
    UNION ALL SELECT '20260102030405-basket-1w-2legs', 'verified', CAST(sum(bars) AS BIGINT), true, false FROM n WHERE symbol IN ('ECONOMY', 'PROMO')""",
)
SETS = [("sma", {"window": n}) for n in range(5, 25)] + [
    ("macd", {"fast": 4, "slow": 9}), ("stops-sma", {"window": 20, "stop_loss": 0.1}), ("rsi-rev", {"window": 3}), ("tsmom", {"lookback": 8, "rebalance": 4}), ("breakout", {"entry": 6, "exit_window": 3, "min_hold": 2}),
]


def sets_checked(b):
    """Records of many sets of parameters of several rules, of which two of a rule have another total than they gave, checked against the same bars."""
    runs = stored_runs(b.sparkSession, G.record_sets(b, SETS, "1w", MOMENTS[0], **COSTS))
    wrong = F.col("run_id").like("%-5") | F.col("run_id").like("%-10")
    totals = F.transform_values("metrics", lambda k, v: F.when((k == "strategy.total_return") & wrong, v + 0.001).otherwise(v))
    found = G.verify_runs(runs.withColumn("metrics", totals), b, "2026-03-04T05:06:07Z")
    return found.select("run_id", "status", "bars", F.coalesce(F.array_join(F.col("mismatches.field"), ","), F.lit("")).alias("fields"))


on_bars(
    "rg3_many_sets", "types", sets_checked,
    f"""n AS (SELECT symbol, count(*) AS bars FROM bars GROUP BY symbol), r AS (SELECT unnest({[s for s, _ in SETS]}) AS rule, unnest({[sum(1 for x, _ in SETS[: i + 1] if x == s) for i, (s, _) in enumerate(SETS)]}) AS n)
    SELECT '20260102030405-' || rule || '-' || symbol || '-1w' || CASE WHEN r.n > 1 THEN '-' || CAST(r.n AS VARCHAR) ELSE '' END AS run_id, CASE WHEN r.n IN (5, 10) THEN 'mismatch' ELSE 'verified' END AS status, bars, CASE WHEN r.n IN (5, 10) THEN 'strategy.total_return' ELSE '' END AS fields FROM n, r""",
)
on_bars(
    "jn15_run_windows", "types", lambda b: G.run_window(b, b.groupBy(*B.KEY).agg((F.min("time") + 50 * WEEK).alias("first"), (F.max("time") - 50 * WEEK).alias("last")).withColumn("run_id", F.col("symbol"))).groupBy("run_id").agg(F.count(F.lit(1)).alias("n")),
    f"SELECT symbol AS run_id, count(*) AS n FROM (SELECT *, min(time) OVER (PARTITION BY symbol) + {50 * WEEK} AS a, max(time) OVER (PARTITION BY symbol) - {50 * WEEK} AS z FROM bars) WHERE time BETWEEN a AND z GROUP BY symbol",
)


def trades_checked(b):
    """Runs with tables of trades, one of which has been changed in a line, one has lost a line, and one is gone."""
    runs = stored_runs(b.sparkSession, G.record_runs(b, "sma", {"window": 20}, "1w", MOMENTS[0], trades_file="{run_id}.csv", **COSTS))
    path = new_folder(b.sparkSession, "tables")
    B.write_table(G.recorded_trades(runs, b, "sma", {"window": 20}, sum(COSTS.values())), path)
    tables = b.sparkSession.read.option("header", True).csv(path)
    last = Win.partitionBy("trades_file")
    tables = tables.withColumn("most", F.max(F.col("n").cast("int")).over(last))
    tables = tables.where("trades_file not like '%LARGE%' and not (trades_file like '%MEDIUM%' and n = most)")
    tables = tables.withColumn("exit_price", F.when(F.col("trades_file").contains("SMALL") & (F.col("n") == 1), F.col("exit_price") * 1.001).otherwise(F.col("exit_price").cast("double")))
    found = G.verify_runs(runs, b, "2026-03-04T05:06:07Z", tables=tables)
    return found.select(F.col("run_id"), "status", "trades_checked", F.coalesce(F.array_join(F.col("mismatches.field"), ","), F.lit("")).alias("fields"))


on_bars(
    "rg5_trade_tables", "types", trades_checked,
    """s AS (SELECT DISTINCT symbol FROM bars) SELECT '20260102030405-sma-' || symbol || '-1w' AS run_id, CASE WHEN symbol IN ('LARGE', 'MEDIUM', 'SMALL') THEN 'mismatch' ELSE 'verified' END AS status, true AS trades_checked,
    CASE symbol WHEN 'LARGE' THEN 'trades_file' WHEN 'MEDIUM' THEN 'trades.rows' WHEN 'SMALL' THEN 'trades[1].exit_price' ELSE '' END AS fields FROM s""",
)


def claims(b):
    measured = b.groupBy(F.col("symbol").alias("claim")).agg(F.count(F.lit(1)).cast("double").alias("measured"))
    said = b.select(F.col("symbol").alias("claim")).distinct().select("claim", F.lit(356.0).alias("value"), F.lit(0.005).alias("tolerance"), (F.length("claim") % 2 == 0).alias("relative"), F.col("claim").isin("SMALL", "LARGE").alias("known"))
    return G.claims_checked(said, measured)


on_bars(
    "rg7_claims", "types", claims,
    """c AS (SELECT symbol AS claim, 356.0::DOUBLE AS value, count(*)::DOUBLE AS measured, abs(count(*) - 356.0) <= CASE WHEN length(symbol) % 2 = 0 THEN 356 * 0.005 ELSE 0.005 END AS ok FROM bars GROUP BY symbol)
    SELECT *, NOT ok AND claim IN ('SMALL', 'LARGE') AS known FROM c""",
)
on_bars(
    "rg9_nested", "types", lambda b: rounded(G.basket_metrics(sparse(b), "sma", {"window": 20}, RATE, "1w").where("field like 'legs.%' and field not like '%.sharpe' or field in ('fees_paid', 'return.final_equity')")),
    f"""{LEGS}, f AS (SELECT symbol, arg_max(leg, time) AS fin, avg(abs(position)) AS exposure, sum(fee) AS fees FROM legs GROUP BY symbol), c AS (SELECT *, (fin - 1) / count(*) OVER () AS contribution FROM f)
    SELECT 'legs.' || symbol || '.' || name AS field, round(CASE name WHEN 'total_return' THEN fin - 1 WHEN 'exposure' THEN exposure WHEN 'fees' THEN fees ELSE contribution END, 6) AS value FROM c, (SELECT unnest(['total_return', 'exposure', 'fees', 'contribution']) AS name)
    UNION ALL SELECT 'fees_paid', round(sum(fees), 6) FROM f UNION ALL SELECT 'return.final_equity', round(1 + avg(fin - 1), 6) FROM f""",
)
on_bars(
    "rg5_trades_compared", "types",
    lambda b: (lambda t: G.trades_compared(t, t.withColumn("net", F.when(F.col("n") % 5 == 0, F.col("net") + 0.001).otherwise(F.col("net")))))(C.trades(C.equity_curve(signal(b, "sma", window=20), RATE)).select(F.col("symbol").alias("run_id"), F.col("trade").alias("n"), F.col("side").cast("string").alias("side"), F.col("entry_price").alias("price"), F.col("net_return").alias("net"))),
    f"{RULES['sg1_sma'][2]}, {CURVE}, s AS (SELECT symbol, sum(CASE WHEN position <> 0 AND pv = 0 THEN 1 WHEN position = 0 AND pv <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY time) AS n, position FROM (SELECT *, coalesce(lag(position) OVER w, 0) AS pv FROM curve WINDOW w AS (PARTITION BY symbol ORDER BY time))) SELECT DISTINCT symbol AS run_id, CAST(n AS BIGINT) AS n FROM s WHERE position <> 0 AND n % 5 = 0",
)


def results(b):
    curve = C.equity_curve(signal(b, "tsmom", lookback=26, rebalance=4), RATE)
    hold = C.buy_and_hold(b).groupBy("symbol").agg((F.max_by("hold", "time") - 1).alias("hold_return"))
    return C.summary(curve).select("symbol", "timeframe", (F.col("final_equity") - 1).alias("total_return")).join(hold, "symbol")


RES = f"{RULES['sg7_tsmom'][2]}, {CURVE}{LAST}, hd AS (SELECT symbol, arg_max(close, time) / max(o2) - 1 AS hold_return FROM (SELECT *, nth_value(open, 2) OVER (PARTITION BY symbol ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS o2 FROM bars) GROUP BY symbol), res AS (SELECT z.symbol, z.timeframe, e * (1 + p * (c / o - 1)) - 1 AS total_return, hold_return FROM z JOIN hd ON z.symbol = hd.symbol)"
def all_timeframes(spark, sf):
    """6-hour bars of ticks, daily bars of one column and weekly bars of another."""
    return FIXTURES["ticks"][0](spark, sf).unionByName(trade_bars(spark, sf, "l_returnflag", "1d")).unionByName(FIXTURES["brands"][0](spark, sf))


def screen_sql(bars_sql, n, every):
    """(timeframe, total_return, hold_return) of the momentum rule over n bars, decided each `every` bars."""
    move = f"close / lag(close, {n}) OVER w - 1"
    score = f"CASE WHEN {move} > 0 THEN 1.0 WHEN {move} <= 0 THEN 0.0 END"
    tail = RES[RES.index(", hd AS"):]
    return f"SELECT timeframe, total_return, hold_return FROM (WITH RECURSIVE {bars_sql.replace('bars AS (', 'every_bar AS (', 1)}, bars AS (SELECT * FROM every_bar QUALIFY count(*) OVER (PARTITION BY symbol) >= {n + 20}), {grid_sql(score, every, False)}, {CURVE}{LAST}{tail} SELECT * FROM res)"


on_tables(
    "ag20_screen", lambda spark, sf: rounded(S.archive_screen(all_timeframes(spark, sf), 10 * DAY, 2 * DAY, RATE)),
    f"""WITH res AS ({screen_sql(EVENT_SQL, 40, 8)} UNION ALL {screen_sql(trade_sql('l_returnflag', '1d'), 10, 2)} UNION ALL {screen_sql(FIXTURES['brands'][1], 1, 1)})
    SELECT timeframe, count(*) AS n, round(median(total_return), 6) AS median_total, round(median(hold_return), 6) AS median_hold, round(avg(CASE WHEN total_return > 0 THEN 1.0 ELSE 0.0 END), 6) AS profitable, round(avg(CASE WHEN total_return > hold_return THEN 1.0 ELSE 0.0 END), 6) AS beat_hold FROM res GROUP BY timeframe""",
)
on_bars(
    "ag20_screened", "brands", lambda b: rounded(S.screened(results(b))),
    f"{RES} SELECT timeframe, count(*) AS n, round(median(total_return), 6) AS median_total, round(median(hold_return), 6) AS median_hold, round(avg(CASE WHEN total_return > 0 THEN 1.0 ELSE 0.0 END), 6) AS profitable, round(avg(CASE WHEN total_return > hold_return THEN 1.0 ELSE 0.0 END), 6) AS beat_hold FROM res GROUP BY timeframe",
)
on_bars(
    "ag21_trimmed", "brands", lambda b: rounded(S.trimmed(results(b), "total_return"), "mean", "median"),
    f"{RES}, k AS (SELECT total_return AS v, percent_rank() OVER (ORDER BY total_return DESC) AS r FROM res) SELECT cut, count(*) AS n, round(avg(v), 6) AS mean, round(median(v), 6) AS median FROM k JOIN (SELECT unnest([0.0, 0.001, 0.01, 0.05, 0.1]::DOUBLE[]) AS cut) ON r >= cut GROUP BY cut",
)
on_bars(
    "ag21_concentration", "brands", lambda b: rounded(S.concentration(results(b), "total_return", 0.1)),
    f"{RES}, k AS (SELECT greatest(total_return, 0) AS v, percent_rank() OVER (ORDER BY total_return DESC) AS r FROM res) SELECT round(sum(CASE WHEN r <= 0.1 THEN v END) / nullif(sum(v), 0), 6) AS share FROM k",
)
on_bars(
    "ag22_cohorts", "daily", lambda b: rounded(S.cohorts(b.withColumn("dd", I.drawdown()).groupBy("symbol").agg(F.max_by("dd", "time").alias("below_peak"), (F.count(F.lit(1)) / 365).alias("years"), (F.max_by("close", "time") / F.min_by("close", "time") - 1).alias("total_return")))),
    f"""d AS (SELECT *, close / max(close) OVER w - 1 AS dd FROM bars {W}), s AS (SELECT symbol, arg_max(dd, time) AS below_peak, count(*) / 365 AS years, arg_max(close, time) / arg_min(close, time) - 1 AS total_return FROM d GROUP BY symbol)
    SELECT CAST(floor(years) AS BIGINT) AS history, count(*) AS n, round(median(below_peak), 6) AS below_peak, round(median(total_return), 6) AS total, round(avg(CASE WHEN below_peak < -0.9 THEN 1.0 ELSE 0.0 END), 6) AS ruined FROM s GROUP BY 1""",
)
on_bars("ag23_turnover_share", "brands", lambda b: rounded(S.turnover_share(b, 10)), "s AS (SELECT symbol, sum(turnover) AS v FROM bars GROUP BY symbol), k AS (SELECT v, row_number() OVER (ORDER BY v DESC, symbol) AS r FROM s) SELECT round(sum(CASE WHEN r <= 10 THEN v END) / sum(v), 6) AS share FROM k")
on_bars(
    "ag17_index", "types", lambda b: rounded(S.index(b, "1w")),
    f"""n AS (SELECT symbol, timeframe, time, round(close, 6) AS close, {', '.join(f'round(close / lag(close, {n}) OVER w - 1, 6) AS change_{k}' for k, n in I.windows_of('1w').items())} FROM bars {W} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC) = 1),
    s AS (SELECT symbol, round(median(CASE WHEN turnover > 0 THEN turnover END), 6) AS turnover, count(*) AS bars FROM bars GROUP BY symbol) SELECT n.*, s.turnover, s.bars FROM n JOIN s ON n.symbol = s.symbol""",
)


def newest_periods(b):
    """The index of an archive in files of years, in which a series has ended years before the others."""
    path = new_folder(b.sparkSession, "archive")
    B.write_bars(b.where(f"symbol <> 'PROMO' or time < {PROMO_END}"), path, {"1w": "year"})
    return rounded(S.stored_index(b.sparkSession, path, "1w"))


PROMO_END = 788_918_400
on_bars(
    "ag17_newest_periods", "types", newest_periods,
    f"""y AS (SELECT *, CAST(date_part('year', make_timestamp(time * 1000000)) AS BIGINT) AS y FROM bars WHERE symbol <> 'PROMO' OR time < {PROMO_END}), l AS (SELECT *, max(y) OVER (PARTITION BY symbol) AS last FROM y), c AS (SELECT *, sum(CASE WHEN y = last THEN 1 ELSE 0 END) OVER (PARTITION BY symbol) AS own FROM l),
    seen AS (SELECT * FROM c WHERE y = last OR (y = last - 1 AND own < 53)), n AS (SELECT symbol, timeframe, time, round(close, 6) AS close, {', '.join(f'round(close / lag(close, {n}) OVER w - 1, 6) AS change_{k}' for k, n in I.windows_of('1w').items())} FROM seen {W} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC) = 1),
    s AS (SELECT symbol, round(median(CASE WHEN y = last AND turnover > 0 THEN turnover END), 6) AS turnover, count(*) AS bars FROM seen GROUP BY symbol) SELECT n.*, s.turnover, s.bars FROM n JOIN s ON n.symbol = s.symbol""",
)


def halves(b):
    """A finer series for some symbols, with ranges of its own."""
    return b.where("length(symbol) = 5").withColumns({"timeframe": F.lit("1d"), "high": F.col("close") * 1.02, "low": F.col("close") / 1.01})


on_bars(
    "ag18_stats", "closes", lambda b: rounded(S.stats(b.unionByName(halves(b)), "1w", 1_000_000_000, 50, 200, fine="1d")),
    f"""fine AS (SELECT symbol, '1d' AS timeframe, time, close * 1.02 AS high, close / 1.01 AS low FROM bars WHERE length(symbol) = 5), both_ AS (SELECT symbol, timeframe, time, high, low FROM fine UNION ALL SELECT symbol, timeframe, time, high, low FROM bars WHERE length(symbol) <> 5),
    tail AS (SELECT * FROM both_ QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC) <= 200), {CS.replace('FROM bars', 'FROM tail')},
    m AS (SELECT symbol, median(mv) AS median_move FROM (SELECT symbol, abs(close / lag(close) OVER w - 1) AS mv, row_number() OVER (PARTITION BY symbol ORDER BY time DESC) AS n FROM bars {W}) WHERE n <= 50 GROUP BY symbol),
    a AS (SELECT symbol, timeframe, count(*) AS bars, min(time) AS first_time, max(time) AS last_time FROM bars GROUP BY ALL)
    SELECT a.symbol, a.timeframe, bars, first_time, last_time, round(bars / {WEEKS!r}, 6) AS years, round((1000000000 - last_time) / 86400, 6) AS stale_days, round(median_move, 6) AS median_move, round(spread, 6) AS spread, CASE WHEN length(a.symbol) = 5 THEN '1d' ELSE '1w' END AS spread_source FROM a JOIN m ON a.symbol = m.symbol LEFT JOIN spread s ON a.symbol = s.symbol""",
)
LIMITS = [0.3, 0.6, 0.9, None]


def gated_years(option, limit):
    """(option, k, date, f): the periods of a book whose symbols are at most `limit` below their peak, and what each made of it after costs."""
    ok = "true" if limit is None else f"coalesce(below_peak >= -{limit}, false)"
    return f"SELECT {option} AS option, k, date, f FROM (WITH RECURSIVE {FIXTURES['brands'][1]}, {PANEL}, gated AS (SELECT p.*, {ok} AS ok FROM panel p), {picks(5, False, 'ok AND momentum IS NOT NULL AND close IS NOT NULL', 'gated')}, {BOOK} SELECT k, date, f FROM fa)"


on_bars(
    "xs16_rolling_choice", "brands", lambda b: rounded(S.rolling_choice(X.yearly(X.gate_books(read(b), LIMITS, 5, RATE), RATE))),
    f"""x AS ({' UNION ALL '.join(gated_years(i, x) for i, x in enumerate(LIMITS))}), o AS (SELECT option, CAST(year(to_timestamp(date)) AS INT) AS year, product(f) AS growth FROM x GROUP BY 1, 2),
    p AS (SELECT *, product(growth) OVER x AS pr, count(*) OVER x AS n FROM o WINDOW x AS (PARTITION BY option ORDER BY year ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)),
    b AS (SELECT year, option, growth, row_number() OVER (PARTITION BY year ORDER BY round(pr, 12) DESC, option) AS k FROM p WHERE n = 2) SELECT year, CAST(option AS INT) AS option, round(growth - 1, 6) AS total FROM b WHERE k = 1""",
)
on_bars(
    "ma_scalars", "types",
    lambda b: rounded(b.select("symbol", "time", scalars.iso(F.col("time")).alias("iso"), scalars.day(F.col("time")).alias("day"), scalars.cagr(F.col("close") / 1000, F.lit(2.5)).alias("cagr"), scalars.participation(F.lit(100.0), F.col("turnover")).alias("part"),
                               scalars.impact_fraction(F.lit(100.0), F.col("turnover"), F.lit(0.05)).alias("impact"), scalars.drawdown_factor(F.col("close") / 4000 - 1, 0.1, 0.6, 0.2).alias("factor"), scalars.annual_rate(F.col("close") / 1e6).alias("annual"))),
    """SELECT symbol, time, strftime(to_timestamp(time), '%Y-%m-%d %H:%M') AS iso, strftime(to_timestamp(time), '%Y-%m-%d') AS day, round(exp(ln(close / 1000) / 2.5) - 1, 6) AS cagr, round(100 / turnover, 6) AS part, round(0.05 * sqrt(100 / turnover), 6) AS impact,
    round(CASE WHEN abs(close / 4000 - 1) <= 0.1 THEN 1.0 WHEN abs(close / 4000 - 1) >= 0.6 THEN 0.2 ELSE 1 - 0.8 * (abs(close / 4000 - 1) - 0.1) / 0.5 END, 6) AS factor, round(close / 1e6 * 365 * 100, 6) AS annual FROM bars""",
)
on_bars(
    "ar1_arrays", "types", lambda b: B.payload(b).select("symbol", F.explode(F.arrays_zip(*"tohlcv")).alias("x")).select("symbol", *[F.col(f"x.{c}").alias(c) for c in "tohlcv"]),
    "SELECT symbol, time AS t, open AS o, high AS h, low AS l, close AS c, volume AS v FROM bars",
)
on_bars("pf12_checked_targets", "types", lambda b: C.check_targets(signal(b, "sma", window=20), spot_only=True).groupBy("symbol").agg(F.sum("target").cast("long").alias("bars_in")), f"{RULES['sg1_sma'][2]} SELECT symbol, CAST(sum(target) AS BIGINT) AS bars_in FROM sig GROUP BY symbol")
on_bars(
    "jn5_next_close", "brands", lambda b: b.select("symbol", "time", r6(F.coalesce(F.lead("close").over(B.in_order()), F.col("close")), "next_close")),
    f"SELECT symbol, time, round(coalesce(lead(close) OVER w, close), 6) AS next_close FROM bars {W}",
)
on_bars(
    "eq_sweep_performance", "types",
    lambda b: rounded(performance(H.candidates(b, "sma", GRID, RATE), WEEKS, "equity", [*B.KEY, "candidate"]).select("symbol", "candidate", "final_equity", "sharpe", "max_drawdown")),
    f"{CANDS}, " + PERF.lstrip(", ").replace("FROM curve", "FROM cand").replace("WINDOW w AS (PARTITION BY symbol, timeframe ORDER BY time)", "WINDOW w AS (PARTITION BY symbol, candidate ORDER BY time)").replace("SELECT symbol, timeframe, arg_max", "SELECT symbol, candidate, arg_max").replace("GROUP BY symbol, timeframe)", "GROUP BY symbol, candidate)")
    + " SELECT symbol, candidate, round(fe, 6) AS final_equity, round(sharpe, 6) AS sharpe, round(mdd, 6) AS max_drawdown FROM perf",
)


def written(spark, sf):
    """Bars written by partition, half of them twice, and read back with a filter."""
    bars = FIXTURES["daily"][0](spark, sf)
    path = new_folder(spark, "bars")
    B.write_bars(bars, path)
    B.write_bars(bars.where("time < 820000000"), path)
    return B.read_bars(spark, path, timeframes=["1d"], since=820_454_400).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.max("time").alias("last_time"))


on_tables("sc7_write_read", written, f"WITH {trade_sql('p_brand', '1d')} SELECT symbol, count(*) AS n, max(time) AS last_time FROM bars WHERE time >= 820454400 GROUP BY symbol")


def tick_stream(spark, sf):
    rows = table(spark, sf, "events")
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{sf}/[e]vents.parquet")  # a pattern: a single file can be a source only as one
    return source.where("value > 0").select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("value").alias("price"))


def drained(spark, stream, label):
    """Everything that a stream gives by the end of what is there, as a table."""
    path = new_folder(spark, label)
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


on_tables(
    "st1_stream_bars", lambda spark, sf: rounded(drained(spark, ST.stream_bars(tick_stream(spark, sf), "6h", "1 hour", order=("ts", "event_id")), "bars")),
    f"WITH {EVENT_SQL}, z AS (SELECT epoch(max(ts)) - 3600 AS z FROM ticks) SELECT symbol, timeframe, time, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, round(volume, 6) AS volume, round(turnover, 6) AS turnover FROM bars, z WHERE time + 21600 <= z",
)
on_tables(
    "st2_sliding", lambda spark, sf: rounded(drained(spark, ST.sliding(tick_stream(spark, sf), "12 hours", "6 hours", "1 hour"), "sliding")),
    f"""WITH {EVENT_SQL}, e AS (SELECT *, time // 21600 * 21600 + s AS stop FROM ticks, (SELECT unnest([21600, 43200]) AS s)), z AS (SELECT epoch(max(ts)) - 3600 AS z FROM ticks)
    SELECT symbol, stop AS time, round(max(price), 6) AS high, round(min(price), 6) AS low, round(sum(price), 6) AS turnover FROM e, z WHERE stop <= z GROUP BY symbol, stop""",
)
on_tables(
    "st3_sessions", lambda spark, sf: drained(spark, ST.sessions(tick_stream(spark, sf), "30 minutes", "1 hour"), "sessions").groupBy("symbol").agg(F.count(F.lit(1)).alias("sessions"), F.sum("ticks").alias("ticks")),
    f"""WITH {EVENT_SQL}, g AS (SELECT *, CASE WHEN epoch(ts) - epoch(lag(ts) OVER x) < 1800 THEN 0 ELSE 1 END AS new FROM ticks WINDOW x AS (PARTITION BY symbol ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY symbol ORDER BY ts) AS n FROM g),
    t AS (SELECT symbol, n, max(epoch(ts)) + 1800 AS stop, count(*) AS ticks FROM s GROUP BY ALL), z AS (SELECT epoch(max(ts)) - 3600 AS z FROM ticks) SELECT symbol, count(*) AS sessions, CAST(sum(ticks) AS BIGINT) AS ticks FROM t, z WHERE stop <= z GROUP BY symbol""",
)


def upserted(spark, sf):
    """Bars of ticks by batch, merged into a stored table by a sink that may be replayed."""
    path = new_folder(spark, "upsert")
    sink = ST.upsert(f"{path}/out")

    def batch(rows, n):
        sink(B.resample(rows.withColumn("time", F.col("ts").cast("long")), "6h", order=("ts", "event_id")), n)

    tick_stream(spark, sf).writeStream.foreachBatch(batch).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return rounded(ST.stored(spark, f"{path}/out").select("symbol", "time", "open", "high", "low", "close"))


on_tables("st4_upsert", upserted, f"WITH {EVENT_SQL} SELECT symbol, time, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close FROM bars")
on_tables("st5_once", lambda spark, sf: drained(spark, ST.once(tick_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))), ["event_id"], "1 hour"), "once").groupBy("symbol").agg(F.count(F.lit(1)).alias("n")), f"WITH {EVENT_SQL} SELECT symbol, count(*) AS n FROM ticks GROUP BY symbol")


def batches(spark, stream, sink, label, mode="append"):
    """Runs a stream into a foreachBatch sink, made of a path, until nothing is left; returns the path."""
    path = new_folder(spark, label)
    stream.writeStream.foreachBatch(sink(f"{path}/out")).outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return f"{path}/out"


on_tables(
    "st7_live_index", lambda spark, sf: rounded(ST.latest(spark, batches(spark, ST.live_index(tick_stream(spark, sf)), lambda out: ST.index_sink(out, ["symbol"]), "index", "update"))),
    f"WITH {EVENT_SQL} SELECT symbol, round(arg_max(price, ts), 6) AS last, round(arg_max(price, ts) / arg_min(price, ts) - 1, 6) AS change, round(sum(price), 6) AS turnover FROM ticks GROUP BY symbol",
)


def monitored(spark, sf):
    """Bars with repeats and holes as a stream; each batch's counts, added up by symbol."""
    bars, path = FIXTURES["ticks"][0](spark, sf), new_folder(spark, "monitor")
    bars.unionByName(bars.where("time div 21600 % 5 = 0")).where("time div 21600 % 7 <> 3").write.parquet(f"{path}/bars")
    stream = spark.readStream.schema(bars.schema).parquet(f"{path}/bars")
    found = spark.read.parquet(batches(spark, stream, lambda out: ST.quality_monitor(out, "6h"), "quality"))
    return found.groupBy("symbol").agg(*[F.sum(c).alias(c) for c in ("rows", "invalid", "misaligned", "duplicates", "gaps", "missing")])


on_tables(
    "st8_batch_quality", monitored,
    f"""WITH {EVENT_SQL}, k AS (SELECT *, time // 21600 % 5 = 0 AS twice FROM bars WHERE time // 21600 % 7 <> 3), g AS (SELECT *, (time - lag(time) OVER (PARTITION BY symbol ORDER BY time)) // 21600 - 1 AS hole FROM k)
    SELECT symbol, CAST(count(*) + count(*) FILTER (twice) AS BIGINT) AS rows, 0::BIGINT AS invalid, 0::BIGINT AS misaligned, count(*) FILTER (twice) AS duplicates, count(*) FILTER (hole > 0) AS gaps, CAST(coalesce(sum(hole) FILTER (hole > 0), 0) AS BIGINT) AS missing FROM g GROUP BY symbol""",
)
