"""Queries of scans, grids, merges and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import scalars, timegrid
from barloom.operators import quality
from barloom.operators import selection as SEL
from barloom.plans.base import W, on_bars, on_tables, r6
from barloom.sources import bars as B
from barloom.sources.derived import DIRTY_SQL, EVENT_SQL, dirty, ticks
from barloom.sources.workspace import new_folder

COLS = "symbol, timeframe, time, open, high, low, close, volume, round(turnover, 6) AS turnover"

on_bars("ag1_resample", "ticks", lambda b: b.withColumn("turnover", r6("turnover")), f"SELECT {COLS} FROM bars")
on_bars(
    "ag1_coarser", "ticks", lambda b: B.coarser(b, "1w").withColumn("turnover", r6("turnover")),
    """SELECT symbol, '1w' AS timeframe, bars.time // 604800 * 604800 AS time, arg_min(open, bars.time) AS open, max(high) AS high, min(low) AS low, arg_max(close, bars.time) AS close,
       sum(volume) AS volume, round(sum(turnover), 6) AS turnover FROM bars GROUP BY symbol, bars.time // 604800 * 604800""",
)
on_bars(
    "sc1_scan_window", "types", lambda b: b.where(F.col("symbol").isin("PROMO", "ECONOMY") & F.col("time").between(800_000_000, 860_000_000)).select("symbol", "timeframe", "time", "close"),
    "SELECT symbol, timeframe, time, close FROM bars WHERE symbol IN ('PROMO', 'ECONOMY') AND time BETWEEN 800000000 AND 860000000",
)
on_bars(
    "sc2_dedupe", "types", lambda b: B.dedupe_bars(dirty(b), F.col("seq")).select("symbol", "timeframe", "time", "close", "seq"),
    f"{DIRTY_SQL} SELECT symbol, timeframe, time, close, seq FROM (SELECT *, row_number() OVER (PARTITION BY symbol, timeframe, time ORDER BY seq DESC) AS k FROM dirty) WHERE k = 1",
)
on_bars(
    "sc3_traded", "types", lambda b: B.traded(b.withColumn("turnover", F.when(F.expr("time div 604800 % 5 = 0"), F.lit(0.0)).otherwise(F.col("turnover")))).withColumn("turnover", r6("turnover")),
    "SELECT symbol, timeframe, time, close, round(CASE WHEN time // 604800 % 5 = 0 OR turnover = 0 THEN close * volume ELSE turnover END, 6) AS turnover FROM bars",
)
on_bars("sc4_list_series", "brands", B.list_series, "SELECT DISTINCT symbol, timeframe FROM bars")
for _name, _newest, _order in (("sc5_head", False, "time"), ("sc5_tail", True, "time DESC")):
    on_bars(
        _name, "types", lambda b, newest=_newest: B.ends(b, 5, newest).select("symbol", "time", "close"),
        f"SELECT symbol, time, close FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {_order}) AS n FROM bars) WHERE n <= 5",
    )
on_bars(
    "sc6_page", "types", lambda b: B.page(b, 20, 850_000_000).select("symbol", "time", "close", "more", "n_bars"),
    """SELECT symbol, time, close, min(time) OVER (PARTITION BY symbol) > first_time AS more, n_bars FROM (
         SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time DESC) AS n FROM (
           SELECT *, min(time) OVER (PARTITION BY symbol) AS first_time, count(*) OVER (PARTITION BY symbol) AS n_bars FROM bars) WHERE time <= 850000000) WHERE n <= 20""",
)


def _merged(b):
    old = b.where("time div 604800 % 7 <> 0")
    fresh = b.where("time div 604800 % 3 <> 0").withColumn("close", F.when(F.expr("time div 604800 % 5 = 0"), F.col("close") + 1).otherwise(F.col("close")))
    return B.merge_bars(old, fresh, seq="time")


MERGE_SQL = """old AS (SELECT * FROM bars WHERE time // 604800 % 7 <> 0),
fresh AS (SELECT symbol, timeframe, time, open, high, low, CASE WHEN time // 604800 % 5 = 0 THEN close + 1 ELSE close END AS close, volume, turnover FROM bars WHERE time // 604800 % 3 <> 0),
merged AS (SELECT coalesce(f.symbol, o.symbol) AS symbol, coalesce(f.timeframe, o.timeframe) AS timeframe, coalesce(f.time, o.time) AS time, coalesce(f.close, o.close) AS close,
                  CASE WHEN f.symbol IS NULL THEN 'kept' WHEN o.symbol IS NULL THEN 'added' WHEN f.close = o.close THEN 'same' ELSE 'refreshed' END AS origin
           FROM old o FULL JOIN fresh f ON o.symbol = f.symbol AND o.timeframe = f.timeframe AND o.time = f.time)"""
on_bars("sc8_merge", "types", lambda b: _merged(b).select("symbol", "timeframe", "time", "close", "origin"), f"{MERGE_SQL} SELECT symbol, timeframe, time, close, origin FROM merged")
on_bars(
    "ag25_merge_stats", "types", lambda b: B.merge_stats(_merged(b)),
    f"""{MERGE_SQL} SELECT symbol, timeframe, CAST(sum(CASE WHEN origin <> 'added' THEN 1 ELSE 0 END) AS BIGINT) AS before, count(*) AS after,
    CAST(sum(CASE WHEN origin = 'added' THEN 1 ELSE 0 END) AS BIGINT) AS added, CAST(sum(CASE WHEN origin = 'refreshed' THEN 1 ELSE 0 END) AS BIGINT) AS refreshed,
    max(origin IN ('added', 'refreshed')) AS changed, min(time) AS first_time, max(time) AS last_time FROM merged GROUP BY ALL""",
)


def _ingested(b, dry_run):
    """An archive by years with holes, into which a load puts new bars, changed ones, equal ones and rows that are none."""
    path = new_folder(b.sparkSession, "archive")
    B.write_bars(b.where("time div 604800 % 7 <> 0 and time between 740000000 and 860000000"), path, {"1w": "year"})
    week = F.expr("time div 604800")
    fresh = b.where((week % 3 != 0) & ((F.col("time") > 800_000_000) | (F.col("time") < 720_000_000)))
    fresh = fresh.withColumn("close", F.when(week % 5 == 0, F.col("close") + 1).otherwise(F.col("close"))).withColumns({"ok": week % 11 != 4, "seq": week})
    return B.ingest(b.sparkSession, path, fresh, "seq", dry_run, {"1w": "year"}).withColumnRenamed("symbol", "series").drop("timeframe")


LOAD_SQL = """old AS (SELECT * FROM bars WHERE time // 604800 % 7 <> 0 AND time BETWEEN 740000000 AND 860000000),
raw AS (SELECT * EXCLUDE (close), CASE WHEN time // 604800 % 5 = 0 THEN close + 1 ELSE close END AS close, time // 604800 % 11 <> 4 AS ok FROM bars WHERE time // 604800 % 3 <> 0 AND (time > 800000000 OR time < 720000000)),
cnt AS (SELECT symbol, count(*) AS fetched, count(*) FILTER (NOT ok) AS rejected, count(*) FILTER (ok AND (high < greatest(open, close, low) OR low > least(open, close, high))) AS invalid FROM raw GROUP BY symbol),
fresh AS (SELECT * FROM raw WHERE ok)"""
TOTAL_SQL = """SELECT symbol AS series, fetched, rejected, invalid, added, refreshed, net, files_changed, files_unchanged, first_time, last_time FROM rep UNION ALL
SELECT NULL, CAST(sum(fetched) AS BIGINT), CAST(sum(rejected) AS BIGINT), CAST(sum(invalid) AS BIGINT), CAST(sum(added) AS BIGINT), CAST(sum(refreshed) AS BIGINT), CAST(sum(net) AS BIGINT), CAST(sum(files_changed) AS BIGINT), CAST(sum(files_unchanged) AS BIGINT), min(first_time), max(last_time) FROM rep"""
on_bars(
    "ag25_ingest_report", "types", lambda b: _ingested(b, False),
    f"""{LOAD_SQL}, m AS (SELECT coalesce(f.symbol, o.symbol) AS symbol, coalesce(f.time, o.time) AS time, strftime(to_timestamp(coalesce(f.time, o.time)), '%Y') AS year, f.symbol IS NOT NULL AS came,
        f.symbol IS NOT NULL AND o.symbol IS NULL AS added, f.symbol IS NOT NULL AND o.symbol IS NOT NULL AND f.close <> o.close AS refreshed FROM old o FULL JOIN fresh f ON o.symbol = f.symbol AND o.time = f.time),
    per AS (SELECT symbol, year, bool_or(came) AS came, count(*) FILTER (added) AS added, count(*) FILTER (refreshed) AS refreshed, min(time) AS lo, max(time) AS hi FROM m GROUP BY symbol, year),
    rep AS (SELECT p.symbol, any_value(fetched) AS fetched, any_value(rejected) AS rejected, any_value(invalid) AS invalid, CAST(sum(added) AS BIGINT) AS added, CAST(sum(refreshed) AS BIGINT) AS refreshed, CAST(sum(added) AS BIGINT) AS net,
        count(*) FILTER (came AND added + refreshed > 0) AS files_changed, count(*) FILTER (came AND added + refreshed = 0) AS files_unchanged, min(lo) AS first_time, max(hi) AS last_time FROM per p JOIN cnt c ON p.symbol = c.symbol GROUP BY p.symbol) {TOTAL_SQL}""",
)
on_bars(
    "ag25_dry_run", "types", lambda b: _ingested(b, True),
    f"""{LOAD_SQL}, e AS (SELECT symbol, min(time) AS lo, max(time) AS hi FROM old GROUP BY symbol),
    rep AS (SELECT f.symbol, any_value(fetched) AS fetched, any_value(rejected) AS rejected, any_value(invalid) AS invalid, count(DISTINCT time) FILTER (time < lo OR time > hi) AS added, 0::BIGINT AS refreshed,
        count(DISTINCT time) FILTER (time < lo OR time > hi) AS net, 0::BIGINT AS files_changed, 0::BIGINT AS files_unchanged, min(lo) AS first_time, max(hi) AS last_time FROM fresh f JOIN e ON f.symbol = e.symbol JOIN cnt c ON f.symbol = c.symbol GROUP BY f.symbol) {TOTAL_SQL}""",
)
on_bars(
    "sc8_changed_periods", "types", lambda b: B.changed_periods(_merged(b.where("time < 850000000 or time div 604800 % 7 = 1")), "year").groupBy("period").agg(F.count(F.lit(1)).alias("n")),
    """b2 AS (SELECT * FROM bars WHERE time < 850000000 OR time // 604800 % 7 = 1), """ + MERGE_SQL.replace("FROM bars", "FROM b2") + """,
    p AS (SELECT *, strftime(to_timestamp(time), '%Y') AS period FROM merged)
    SELECT period, count(*) AS n FROM p WHERE period IN (SELECT period FROM p WHERE origin IN ('added', 'refreshed')) GROUP BY period""",
)


def _raw(spark, sf):
    e = ticks(spark, sf)
    cells = F.array(
        F.when(F.col("event_id") % 2 == 0, F.col("time") * 1000).otherwise(F.col("time")).cast("string"), F.col("price").cast("string"),
        F.when(F.col("event_id") % 11 == 0, F.lit("x")).otherwise(F.col("price").cast("string")), F.lit("3"), F.lit("1.5"), F.lit("10"),
    )
    cells = F.when(F.col("event_id") % 13 == 0, F.slice(cells, 1, 4)).otherwise(cells)
    return B.parse_raw_rows(e.select("symbol", F.lit("6h").alias("timeframe"), F.to_json(cells).alias("payload")))


on_tables(
    "sc9_parse_raw", lambda spark, sf: _raw(spark, sf).groupBy("symbol", "ok").agg(F.count(F.lit(1)).alias("n"), F.max("time").alias("last_time"), F.max("high").alias("high"), F.min("turnover").alias("turnover")),
    f"""WITH {EVENT_SQL}, x AS (SELECT *, event_id % 13 = 0 AS short, event_id % 11 = 0 AS bad FROM ticks)
    SELECT symbol, NOT (short OR bad) AS ok, count(*) AS n, max(time) AS last_time, max(3.0::DOUBLE) AS high, min(0.0::DOUBLE) AS turnover FROM x GROUP BY ALL""",
)
on_bars(
    "sc13_synthetic", "types", lambda b: B.synthetic_bars(b.select("symbol", "timeframe", "time", "close")).select("symbol", "time", "open", "high", "low", "close"),
    f"SELECT symbol, time, coalesce(lag(close) OVER w, close) AS open, greatest(coalesce(lag(close) OVER w, close), close) AS high, least(coalesce(lag(close) OVER w, close), close) AS low, close FROM bars {W}",
)



def t():
    return F.col("time")


on_bars(
    "pf1_grid", "ticks",
    lambda b: b.select("symbol", "time", timegrid.align(t() + 5, "1w").alias("week"), timegrid.align(t(), "1mon").alias("month"), timegrid.shift(timegrid.align(t(), "1mon"), 2, "1mon").alias("two_months"),
                       timegrid.shift(t(), -3, "6h").alias("three_back"), timegrid.slots_between(t(), F.lit(1_760_000_000), "6h").alias("slots"), timegrid.slots_between(timegrid.align(t(), "1mon"), F.lit(1_767_225_600), "1mon").alias("months")),
    """SELECT symbol, time, (time + 5) // 604800 * 604800 AS week, CAST(epoch(date_trunc('month', to_timestamp(time))) AS BIGINT) AS month,
       CAST(epoch(date_trunc('month', to_timestamp(time)) + INTERVAL 2 MONTH) AS BIGINT) AS two_months, time - 64800 AS three_back, greatest(0, (1760000000 - time) // 21600) AS slots,
       CAST(greatest(0, (2026 - year(to_timestamp(time))) * 12 + 1 - month(to_timestamp(time))) AS BIGINT) AS months FROM bars""",
)
on_bars(
    "pf2_periods", "ticks",
    lambda b: b.select("symbol", "time", timegrid.period(t(), "month").alias("month"), timegrid.period(t(), "year").alias("year"), timegrid.period(t(), "single").alias("single"),
                       timegrid.period_start(t(), "month").alias("start"), timegrid.period_end(t(), "month").alias("stop"), timegrid.period_end(t(), "year").alias("year_stop")),
    """SELECT symbol, time, strftime(to_timestamp(time), '%Y-%m') AS month, strftime(to_timestamp(time), '%Y') AS year, 'all' AS single, CAST(epoch(date_trunc('month', to_timestamp(time))) AS BIGINT) AS start,
       CAST(epoch(date_trunc('month', to_timestamp(time)) + INTERVAL 1 MONTH) AS BIGINT) AS stop, CAST(epoch(date_trunc('year', to_timestamp(time)) + INTERVAL 1 YEAR) AS BIGINT) AS year_stop FROM bars""",
)
on_bars("pf3_window", "types", lambda b: b.where(F.col("time").between(800_000_000, 820_000_000)).select("symbol", "time", "close"), "SELECT symbol, time, close FROM bars WHERE time BETWEEN 800000000 AND 820000000")
on_bars(
    "pf4_finished", "types", lambda b: b.where(F.col("time") < timegrid.align(F.lit(850_000_000), "1w")).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.max("time").alias("last_time")),
    "SELECT symbol, count(*) AS n, max(time) AS last_time FROM bars WHERE time < 850000000 // 604800 * 604800 GROUP BY symbol",
)
STRICT = "(high < greatest(open, close) OR low > least(open, close) OR high < low)"
TOLERANT = "(high + tol < greatest(open, close) OR low - tol > least(open, close) OR high + tol < low OR volume < 0 OR turnover < 0)"
on_bars(
    "pf5_invalid", "types", lambda b: dirty(b).select("symbol", "seq", quality.ohlc_invalid().alias("strict"), quality.ohlc_invalid_tolerant().alias("tolerant"), quality.misaligned("1w").alias("misaligned")),
    f"{DIRTY_SQL}, q AS (SELECT *, greatest(abs(high), 1) * 1e-9 AS tol FROM dirty) SELECT symbol, seq, {STRICT} AS strict, {TOLERANT} AS tolerant, time % 604800 <> 0 AS misaligned FROM q",
)
PAIR = "CASE WHEN length(symbol) % 2 = 0 THEN symbol || '-A-usdt' ELSE symbol || '-btc' END"


def pair():
    return F.when(F.length("symbol") % 2 == 0, F.concat("symbol", F.lit("-A-usdt"))).otherwise(F.concat("symbol", F.lit("-btc")))


on_bars(
    "pf8_quote_filter", "types", lambda b: SEL.quoted(b.select(pair().alias("symbol"), "time"), SEL.parse_quotes("usdt, eur")).groupBy("symbol").agg(F.count(F.lit(1)).alias("n")),
    f"SELECT {PAIR} AS symbol, count(*) AS n FROM bars WHERE upper(split_part({PAIR}, '-', -1)) IN ('USDT', 'EUR') GROUP BY 1",
)
on_bars(
    "pf9_search", "types", lambda b: b.select(pair().alias("symbol")).distinct().where(SEL.matching(F.col("symbol"), "/usdt a")),
    f"SELECT DISTINCT {PAIR} AS symbol FROM bars WHERE lower({PAIR}) LIKE '%-usdt' AND contains(lower({PAIR}), 'a')",
)
LISTED = ["PROMO", "STANDARD", "NOWHERE"]
on_bars("pf10_listed_split", "types", lambda b: SEL.listed(B.list_series(b), LISTED).select("symbol", "listed"), "SELECT DISTINCT symbol, symbol IN ('PROMO', 'STANDARD', 'NOWHERE') AS listed FROM bars")
on_bars(
    "pf11_min_turnover", "brands", lambda b: b.groupBy("symbol").agg(F.median("turnover").alias("turnover")).where("turnover > 1000").select("symbol", r6("turnover", "turnover")),
    "SELECT symbol, round(median(turnover), 6) AS turnover FROM bars GROUP BY symbol HAVING median(turnover) > 1000",
)
counted = lambda rows: rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))
on_bars(
    "pf13_last_year", "types", lambda b: counted(SEL.reporting_window(b, last="1y")),
    "SELECT symbol, count(*) AS n, min(time) AS first_time, max(time) AS last_time FROM (SELECT *, max(time) OVER (PARTITION BY symbol) - 31536000 AS since FROM bars) WHERE time >= since GROUP BY symbol",
)
on_bars(
    "pf13_days", "daily", lambda b: counted(SEL.reporting_window(b.where("symbol <> 'Brand#11' or time > 886000000"), first="1998-01-31", until="1998-02-03")),
    "b2 AS (SELECT * FROM bars WHERE symbol <> 'Brand#11' OR time > 886000000) SELECT symbol, count(*) AS n, min(time) AS first_time, max(time) AS last_time FROM b2 WHERE time BETWEEN epoch(TIMESTAMP '1998-01-31') AND epoch(TIMESTAMP '1998-02-03') GROUP BY symbol HAVING count(*) >= 3",
)
on_bars(
    "pf14_selection", "types", lambda b: SEL.selected(b, LISTED, timeframes=["1w"]).select("symbol", "bars"),
    "SELECT s.symbol, coalesce(n, 0) AS bars FROM (SELECT unnest(['PROMO', 'STANDARD', 'NOWHERE']) AS symbol) s LEFT JOIN (SELECT symbol, count(*) AS n FROM bars GROUP BY symbol) b ON s.symbol = b.symbol",
)

GAPPED = "b3 AS (SELECT * FROM bars WHERE time // 604800 % 11 <> 3 AND time // 604800 % 17 NOT IN (5, 6, 7))"
gapped = lambda b: b.where("floor(time / 604800) % 11 <> 3 and floor(time / 604800) % 17 not in (5, 6, 7)")
on_bars(
    "ag2_quality", "types", lambda b: quality.quality(gapped(b), "1w"),
    f"""{GAPPED}, g AS (SELECT *, lag(time) OVER w + 604800 AS expected FROM b3 {W}),
    s AS (SELECT *, CASE WHEN time > expected THEN (time - expected + 604799) // 604800 ELSE 0 END AS slots FROM g)
    SELECT symbol, timeframe, count(*) AS bars, min(time) AS first_time, max(time) AS last_time, CAST(sum(CASE WHEN time <> expected THEN 1 ELSE 0 END) AS BIGINT) AS gaps,
    CAST(sum(slots) AS BIGINT) AS missing, max(slots) + 1 AS largest_gap_slots, CAST(sum(CASE WHEN {STRICT} THEN 1 ELSE 0 END) AS BIGINT) AS bad_ohlc,
    CAST(sum(CASE WHEN least(open, high, low, close) <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS non_positive FROM s GROUP BY symbol, timeframe""",
)
on_bars(
    "ag3_verify", "types", lambda b: quality.verify(dirty(gapped(b)), "1w", order="seq").select("symbol", "rows", "first_time", "last_time", "missing", "duplicates", "out_of_order", "invalid", "misaligned", "expected", r6("coverage_pct", "coverage_pct"), "clean", F.size("gaps").cast("long").alias("n_gaps"), F.col("gaps")[0].missing.alias("widest")),
    f"""{GAPPED}, {DIRTY_SQL.replace("FROM bars", "FROM b3")}, d AS (SELECT *, lag(time) OVER (PARTITION BY symbol ORDER BY seq) AS before, greatest(abs(high), 1) * 1e-9 AS tol FROM dirty),
    m AS (SELECT *, CASE WHEN time > before AND time <> before + 604800 THEN greatest(0, (time - before) // 604800 - 1) ELSE 0 END AS missing FROM d)
    SELECT symbol, count(*) AS rows, min(time) AS first_time, max(time) AS last_time, CAST(sum(missing) AS BIGINT) AS missing, CAST(sum(CASE WHEN time = before THEN 1 ELSE 0 END) AS BIGINT) AS duplicates,
    CAST(sum(CASE WHEN time < before THEN 1 ELSE 0 END) AS BIGINT) AS out_of_order, CAST(sum(CASE WHEN {TOLERANT} THEN 1 ELSE 0 END) AS BIGINT) AS invalid, CAST(sum(CASE WHEN time % 604800 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS misaligned,
    (max(time) - min(time)) // 604800 + 1 AS expected, round(least(100, count(*) * 100.0 / ((max(time) - min(time)) // 604800 + 1)), 6) AS coverage_pct,
    sum(CASE WHEN missing >= 2 OR time = before OR {TOLERANT} OR time % 604800 <> 0 THEN 1 ELSE 0 END) = 0 AS clean, least(20, sum(CASE WHEN missing >= 2 THEN 1 ELSE 0 END))::BIGINT AS n_gaps,
    max(CASE WHEN missing >= 2 THEN missing END) AS widest FROM m GROUP BY symbol""",
)
on_bars(
    "ag5_inventory", "brands", lambda b: quality.inventory(b, "1w"),
    """SELECT symbol, timeframe, count(DISTINCT symbol) AS n_symbols, CAST(count(*) AS BIGINT) AS bars, min(time) AS first_time, max(time) AS last_time, CASE WHEN symbol IS NOT NULL THEN max(time) + 604800 END AS next_time
       FROM bars GROUP BY ROLLUP (timeframe, symbol)""",
)
on_bars(
    "ag6_coverage", "daily", lambda b: quality.coverage(b, timegrid.period(F.col("time"), "year"), "period"),
    "SELECT symbol, timeframe, strftime(to_timestamp(time), '%Y') AS period, min(time) AS first_time, max(time) AS last_time, count(*) AS rows FROM bars GROUP BY ALL",
)
on_bars(
    "ag7_fetch_plan", "types", lambda b: quality.fetch_plan(b, "1w", 600_000_000, 1_000_000_000, 50),
    """e AS (SELECT symbol, timeframe, min(time) AS lo, max(time) AS hi FROM bars GROUP BY ALL),
    x AS (SELECT symbol, timeframe, 'head' AS side, 600000000 // 604800 * 604800 AS a, lo AS b FROM e UNION ALL SELECT symbol, timeframe, 'tail', hi + 604800, 1000000000 // 604800 * 604800 FROM e),
    y AS (SELECT *, unnest(range(CAST(a AS BIGINT), CAST(b AS BIGINT), 30240000)) AS from_time FROM x WHERE a < b)
    SELECT symbol, timeframe, side, from_time, least(from_time + 30240000, b) AS to_time FROM y""",
)
on_bars(
    "ag7_fetch_months", "daily", lambda b: quality.fetch_plan(B.coarser(b, "1mon"), "1mon", 600_000_000, 1_000_000_000, 7),
    """e AS (SELECT symbol, min(date_trunc('month', to_timestamp(time))) AS lo, max(date_trunc('month', to_timestamp(time))) AS hi FROM bars GROUP BY symbol),
    s AS (SELECT symbol, 'head' AS side, date_trunc('month', to_timestamp(600000000)) AS a, lo AS b FROM e UNION ALL SELECT symbol, 'tail', hi + INTERVAL 1 MONTH, date_trunc('month', to_timestamp(1000000000)) FROM e),
    w AS (SELECT symbol, side, b, unnest(generate_series(a, b - INTERVAL 1 MONTH, INTERVAL 7 MONTH)) AS f FROM s WHERE a < b)
    SELECT symbol, '1mon' AS timeframe, side, CAST(epoch(f) AS BIGINT) AS from_time, CAST(epoch(least(f + INTERVAL 7 MONTH, b)) AS BIGINT) AS to_time FROM w""",
)


def floors(b):
    """What is on record of each series: a floor, older or younger than its bars, the start of a bounded load, and whether one went all the way."""
    first = b.groupBy("symbol", "timeframe").agg(F.min("time").alias("f")).where("symbol <> 'PROMO'")
    start = F.when(F.col("symbol") == "LARGE", F.col("f") - 500).when(F.col("symbol") == "MEDIUM", F.col("f") - 5000).when(F.col("symbol") == "SMALL", F.col("f") + 700)
    record = F.col("f") + F.when(F.length("symbol") % 2 == 0, -1000).otherwise(1000)
    return first.select("symbol", "timeframe", record.alias("floor"), start.alias("start"), (F.col("symbol") == "ECONOMY").alias("full"))


on_bars(
    "ag26_history_floor", "types",
    lambda b: quality.history_floor(floors(b), b),
    """m AS (SELECT symbol, timeframe, min(time) AS f FROM bars GROUP BY ALL), r AS (SELECT *, f + CASE WHEN length(symbol) % 2 = 0 THEN -1000 ELSE 1000 END AS record, CASE symbol WHEN 'LARGE' THEN f - 500 WHEN 'MEDIUM' THEN f - 5000 WHEN 'SMALL' THEN f + 700 END AS start, symbol = 'ECONOMY' AS "full" FROM m)
    SELECT symbol, timeframe, CASE WHEN symbol = 'PROMO' OR "full" THEN f ELSE coalesce(least(CASE WHEN record <= f THEN record END, CASE WHEN start <= f THEN start END), f) END AS floor FROM r""",
)
on_bars(
    "wn17_gaps", "daily", lambda b: quality.gaps(b, "1d"),
    f"g AS (SELECT *, lag(time) OVER w AS after FROM bars {W}) SELECT symbol, timeframe, after, time AS before, after + 86400 AS expected, (time - after - 86400 + 86399) // 86400 AS missing FROM g WHERE after IS NOT NULL AND time <> after + 86400",
)
on_bars(
    "wn18_islands", "daily", lambda b: quality.islands(b, "1d").drop("island"),
    f"""g AS (SELECT *, CASE WHEN time = lag(time) OVER w + 86400 THEN 0 ELSE 1 END AS start FROM bars {W}), i AS (SELECT *, sum(start) OVER w AS island FROM g {W})
    SELECT symbol, timeframe, min(time) AS first_time, max(time) AS last_time, count(*) AS bars FROM i GROUP BY symbol, timeframe, island""",
)
on_bars("wn20_resume", "types", lambda b: b.groupBy("symbol").agg(timegrid.shift(F.max("time"), 1, "1w").alias("next_time")), "SELECT symbol, max(time) + 604800 AS next_time FROM bars GROUP BY symbol")
