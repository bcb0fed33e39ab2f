"""Queries of what the other plans use only in passing: outputs, small joins, parts of curves, carried state."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import scalars
from barloom.operators import basket as K
from barloom.operators import crosssection as X
from barloom.operators import curve as C
from barloom.operators import indicators as I
from barloom.operators import joins as J
from barloom.operators import quality
from barloom.operators import reports as REP
from barloom.operators import runs as G
from barloom.operators import search as H
from barloom.operators.signals import signal
from barloom.plans.base import FIXTURES, W, on_bars, on_tables, r6, rounded
from barloom.plans.books_plans import CENSUS_SQL, LEGS, LINE, PANEL, TOP, basket, calendar, picks, read, sparse
from barloom.plans.rules_plans import CURVE, HOLD, LAST, PERF, PLACED, RATE, RULES, TRADES, ema_sql, on_curve, reversion_sql
from barloom.plans.studies_plans import AUDIT, CANDS, GRID, PICKS, SCORES, SPLITS, UNI, UNIT, drained, searched, unit
from barloom.sources import bars as B
from barloom.sources.derived import EVENT_SQL, dirty, table, ticks
from barloom.sources.workspace import new_folder
from barloom.streaming import streams as ST


def through_files(rows, kind):
    """A table as it is given out, written and read again."""
    path = new_folder(rows.sparkSession, kind)
    B.write_table(rows, path, kind)
    reader = rows.sparkSession.read.schema(rows.schema)
    return reader.option("header", True).option("emptyValue", "").csv(path) if kind == "csv" else reader.json(path)


def curve_of(b):
    return C.equity_curve(C.buy_and_hold(signal(b, "sma", window=20), RATE), RATE)


UTC = "strftime(to_timestamp($), '%Y-%m-%d %H:%M')"
utc = lambda column: UTC.replace("$", column)
# With six digits more, numbers of the text are rounded once.
numbers = lambda rows, *names: rows.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names})
on_bars(
    "sc10_csv", "types", lambda b: numbers(through_files(REP.trade_table(C.trades(curve_of(b)), 6).drop("timeframe"), "csv"), "entry_price", "exit_price", "gross_return", "net_return", "equity_at_entry", "equity_at_exit").fillna(""),
    f"""{RULES['sg1_sma'][2]}, {CURVE}{TRADES} SELECT symbol, CASE WHEN side > 0 THEN 'long' ELSE 'short' END AS side, {utc('entry_time')} AS entry_time_utc, round(entry_price, 6) AS entry_price, {utc('exit_time')} AS exit_time_utc, round(exit_price, 6) AS exit_price,
    bars_held, round(gross_return, 6) AS gross_return, round(net_return, 6) AS net_return, round(equity_at_entry, 6) AS equity_at_entry, round(equity_at_exit, 6) AS equity_at_exit, CASE WHEN open_at_end THEN 'yes' ELSE '' END AS open_at_end FROM trades""",
)
on_bars(
    "sc10_equity_csv", "types", lambda b: numbers(through_files(REP.equity_table(curve_of(b), 6).drop("timeframe"), "csv"), "close", "equity", "buy_hold"),
    f"""{RULES['sg1_sma'][2]}, {CURVE}, hd AS (SELECT symbol, time, {HOLD} AS hold FROM bars {W}) SELECT c.symbol, {utc('c.time')} AS time_utc, round(close, 6) AS close, round(equity, 6) AS equity, round(hold, 6) AS buy_hold, position
    FROM curve c JOIN hd ON c.symbol = hd.symbol AND c.time = hd.time""",
)
on_bars(
    "sc10_basket_csv", "types", lambda b: numbers(through_files(REP.basket_table(K.combined(basket(b)), 6), "csv"), "basket", "invested"),
    f"{LEGS} SELECT {utc('time')} AS time_utc, round(1 + avg(leg - 1), 6) AS basket, round(avg(abs(position)), 6) AS invested, count(*) AS n_legs FROM legs GROUP BY time",
)
on_bars(
    "sc10_book_csv", "brands", lambda b: numbers(through_files(REP.book_table(unit(b), calendar(b), 6), "csv").withColumn("equity", F.ln(F.col("equity").cast("double"))), "equity", "invested", "turnover"),
    f"{UNI}, {UNIT} SELECT {utc('time')} AS time_utc, round(ln(equity), 6) AS equity, round(invested, 6) AS invested, round(turnover, 6) AS turnover FROM book JOIN ix ON book.idx = ix.idx",
)
on_bars("sc10_census_csv", "brands", lambda b: through_files(X.census(read(b), X.ranked(read(b), 1, True)), "csv"), CENSUS_SQL)


def documents(b):
    """One nested JSON text a series, written and read again, and what it says."""
    figures = G.run_metrics(b, "sma", {"window": 20}, RATE, "1w").select(*B.KEY, F.explode("metrics").alias("field", "value"))
    texts = through_files(REP.summary_documents(figures, quality.quality(b, "1w")), "json")
    kind = "symbol string, exposure double, strategy struct<total_return:double, max_dd:double>, trades struct<n_closed:double>, quality struct<bars:long, gaps:long, missing:long>"
    said = texts.select(F.from_json("document", kind).alias("d")).select("d.*")
    return said.select("symbol", r6("exposure", "exposure"), r6("strategy.total_return", "total_return"), r6("strategy.max_dd", "max_dd"), F.col("trades.n_closed").cast("long").alias("trades"), "quality.bars", "quality.gaps", "quality.missing")


on_bars(
    "sc11_json", "types", documents,
    f"""{RULES['sg1_sma'][2]}, {CURVE}{TRADES}{PERF}{LAST}, {AUDIT}, n AS (SELECT symbol, count(*) AS trades FROM trades WHERE NOT open_at_end GROUP BY symbol)
    SELECT q.symbol, round(exposure, 6) AS exposure, round(fe - 1, 6) AS total_return, round(mdd, 6) AS max_dd, coalesce(trades, 0) AS trades, bars, gaps, missing_bars AS missing
    FROM q JOIN perf p ON q.symbol = p.symbol JOIN (SELECT symbol, exposure FROM z) z ON q.symbol = z.symbol LEFT JOIN n ON q.symbol = n.symbol""",
)
on_bars("ag4_clean", "types", lambda b: quality.verify(b.where("symbol <> 'PROMO'").unionByName(dirty(b.where("symbol = 'PROMO'")).drop("seq")), "1w").select("symbol", "clean"), "SELECT DISTINCT symbol, symbol <> 'PROMO' AS clean FROM bars")
on_bars("sl3_widest_gaps", "daily", lambda b: quality.verify(b, "1d", max_gaps=2).select("symbol", F.explode("gaps").alias("g")).select("symbol", "g.after", "g.missing"),
    "g AS (SELECT symbol, lag(time) OVER w AS after, (time - lag(time) OVER w) // 86400 - 1 AS missing FROM bars WINDOW w AS (PARTITION BY symbol, timeframe ORDER BY time)) SELECT symbol, after, missing FROM g WHERE missing >= 2 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY missing DESC, after) <= 2")
on_bars("wn10_below_peak", "brands", lambda b: b.select("symbol", "time", r6(I.drawdown(), "below_peak")), f"SELECT symbol, time, round(close / max(close) OVER w - 1, 6) AS below_peak FROM bars {W}")
on_bars(
    "wn15_held", "types", lambda b: b.select("symbol", "time", r6(I.held(F.col("close"), F.expr("time div 604800 % 5 = 0")), "held")),
    f"SELECT symbol, time, round(last_value(CASE WHEN time // 604800 % 5 = 0 THEN close END IGNORE NULLS) OVER w, 6) AS held FROM bars {W}",
)
on_bars("jn6_timeline", "types", lambda b: sparse(b).join(K.timeline(sparse(b)), "time", "left_semi").groupBy("symbol").agg(F.count(F.lit(1)).alias("n")), f"{LINE} SELECT symbol, count(*) AS n FROM sp WHERE time IN (SELECT time FROM line) GROUP BY symbol")
on_bars(
    "jn7_weight_diff", "brands", lambda b: (lambda h: rounded(J.diff(h.where("k = 40").select("symbol", "weight"), h.where("k = 41").select("symbol", "weight"), ["symbol"], "weight")))(X.weights(X.ranked(read(b), TOP))),
    f"""{PANEL}, {picks(TOP, False)} SELECT coalesce(o.symbol, n.symbol) AS symbol, round(coalesce(o.weight, 0), 6) AS old, round(coalesce(n.weight, 0), 6) AS new, round(abs(coalesce(n.weight, 0) - coalesce(o.weight, 0)), 6) AS moved
    FROM (SELECT * FROM held WHERE k = 40) o FULL JOIN (SELECT * FROM held WHERE k = 41) n ON o.symbol = n.symbol""",
)
on_bars(
    "jn9_params_by_series", "types", lambda b: C.swept(b, b.sparkSession.createDataFrame([(5,), (10,)], "p int")).groupBy("symbol", "p").agg(F.count(F.lit(1)).alias("n"), F.max("time").alias("last_time")),
    "SELECT symbol, p, count(*) AS n, max(time) AS last_time FROM bars, (SELECT unnest([5, 10]) AS p) GROUP BY ALL",
)
EXITS = "CASE WHEN time // 604800 % 6 = 0 THEN close * 0.97 END"
on_bars(
    "eq2_intrabar", "types", lambda b: rounded(C.equity_curve(signal(b, "sma", window=20).withColumn("exit_price", F.when(F.expr("time div 604800 % 6 = 0"), F.col("close") * 0.97)), RATE).select("symbol", "time", "equity")),
    f"{RULES['sg1_sma'][2].replace('sig AS', 'sig0 AS')}, sig AS (SELECT *, {EXITS} AS xp FROM sig0), "
    + CURVE.replace("lag(open) OVER w AS o1", "lag(open) OVER w AS o1, lag(xp) OVER w AS x1, coalesce(lag(pos) OVER w, 0.0) AS p1").replace("held * (open / o1 - 1)", "held * (CASE WHEN held <> 0 AND x1 IS NOT NULL THEN x1 ELSE open END / o1 - 1)")
    + " SELECT symbol, time, round(equity, 6) AS equity FROM curve",
)
on_curve("eq3_ruin", "sg2_sma_ls", lambda c: c.groupBy("symbol").agg(F.max("ruined").alias("ruined"), F.min(F.when(F.col("ruined"), F.col("time"))).alias("since")), " SELECT symbol, max(ruined) AS ruined, min(CASE WHEN ruined THEN time END) AS since FROM curve GROUP BY symbol")
on_curve("eq5_gross", "sg7_tsmom", lambda c: rounded(C.summary(c).select("symbol", "gross_equity")), f"{LAST} SELECT symbol, round(g * (1 + p * (c / o - 1)), 6) AS gross_equity FROM z")
on_curve("eq6_fees", "sg5_breakout", lambda c: rounded(C.summary(c).select("symbol", "fees_paid")), f"{LAST} SELECT symbol, round(fees_paid, 6) AS fees_paid FROM z")
on_bars("wf2_grid", "types", lambda b: b.select("symbol").distinct().crossJoin(F.broadcast(b.sparkSession.createDataFrame([(i, g["window"]) for i, g in enumerate(GRID)], "candidate int, window int"))), "SELECT DISTINCT symbol, c AS candidate, [5, 10, 20, 40][c + 1] AS window FROM bars, (SELECT unnest([0, 1, 2, 3]) AS c)")


def benchmark(b):
    curves, splits, scored = searched(b)
    return rounded(H.stitched(curves, splits, H.chosen(scored), RATE).groupBy("symbol").agg(F.max_by("benchmark", "i").alias("benchmark")))


on_bars(
    "wf6_benchmark", "types", benchmark,
    f"""{CANDS}, {SPLITS}, {SCORES}, {PICKS}, h AS (SELECT c.symbol, s.split, c.close / e.close * pow(1 - {RATE}, 2) AS hold FROM cand c JOIN splits s ON c.symbol = s.symbol AND c.i = s.test_end - 1 JOIN cand e ON e.symbol = c.symbol AND e.candidate = 0 AND e.i = s.train_end - 1 WHERE c.candidate = 0)
    SELECT symbol, round(product(hold), 6) AS benchmark FROM h GROUP BY symbol""",
)


on_bars(
    "mp1_maps", "brands", lambda b: X.weights(X.ranked(read(b), TOP)).groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("symbol", "weight"))).alias("m")).select("k", F.size("m").alias("n"), F.array_join(F.array_sort(F.map_keys("m")), ",").alias("names"), r6(F.aggregate(F.map_values("m"), F.lit(0.0), lambda a, x: a + x), "invested"), r6(F.col("m")[F.array_min(F.map_keys("m"))], "weight")),
    f"{PANEL}, {picks(TOP, False)} SELECT k, CAST(count(*) AS INT) AS n, string_agg(symbol, ',' ORDER BY symbol) AS names, round(sum(weight), 6) AS invested, round(arg_min(weight, symbol), 6) AS weight FROM held GROUP BY k",
)
on_tables(
    "sta_strings", lambda spark, sf: table(spark, sf, "supplier").select(F.trim(F.upper("s_name")).alias("name"), scalars.quote_of(F.concat("s_name", F.lit("-usdt"))).alias("quote")),
    "SELECT trim(upper(s_name)) AS name, 'USDT' AS quote FROM supplier",
)


def carried(spark, sf, operator, columns):
    """A stream of finished bars, file by file in order of time, with the state of each series carried from batch to batch in RocksDB."""
    path, key = new_folder(spark, "trend"), "spark.sql.streaming.stateStore.providerClass"
    bars = FIXTURES["ticks"][0](spark, sf)
    # Files are taken in order of their times of writing, so each stretch of time is written after the one before.
    edges = bars.select(F.expr("percentile(time, array(0.34, 0.67))").alias("x")).first().x
    for low, high in zip((float("-inf"), *edges), (*edges, float("inf"))):
        part = bars.where((F.col("time") > low) & (F.col("time") <= high))
        part.repartition("symbol").write.mode("append").parquet(f"{path}/bars")
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = drained(spark, operator(spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 8).parquet(f"{path}/bars")), "trend")
    finally:
        spark.conf.set(key, before)
    return rounded(out.select("symbol", "time", *columns))


on_tables(
    "st6_stream_trend", lambda spark, sf: carried(spark, sf, lambda bars: ST.stream_trend(bars, 20), ("ema", "target")),
    f"""WITH RECURSIVE {FIXTURES['ticks'][1]}, {PLACED}, {ema_sql('placed', 'close', 20, 'e', 20)} SELECT p.symbol, p.time, round(v, 6) AS ema, CASE WHEN close > v THEN 1.0 ELSE 0.0 END::DOUBLE AS target
    FROM placed p LEFT JOIN e ON p.symbol = e.symbol AND p.i = e.i""",
)
on_tables(
    "st6_stream_reversion", lambda spark, sf: carried(spark, sf, ST.stream_reversion, ("rsi", "target")),
    f"WITH RECURSIVE {FIXTURES['ticks'][1]}, {reversion_sql(False)} SELECT symbol, time, round(level, 6) AS rsi, target FROM sig",
)


#: The middle of a slot in the middle of all ticks, and what the streams below do around it.
MIDDLE_SQL = "mid AS (SELECT (min(time) + max(time)) // 2 // 21600 * 21600 + 10800 AS mid, max(epoch(ts)) AS most FROM ticks)"


def _middle(rows):
    low, high = rows.agg(F.min("time"), F.max("time")).first()
    return (low + high) // 2 // 21_600 * 21_600 + 10_800


def corrections(spark, sf):
    """Ticks in four files: up to a day before the middle of a slot, up to that middle, corrections of ticks of that slot and of much older ones, and the rest."""
    path, rows = new_folder(spark, "corrections"), ticks(spark, sf).select("symbol", F.col("ts").cast("timestamp").alias("ts"), F.col("ts").cast("long").alias("time"), "event_id", "price").withColumn("version", F.lit(1))
    middle = _middle(rows)
    early, late = rows.where(F.col("time") < middle), rows.where(F.col("time") >= middle)
    changed = early.where((F.col("time") >= middle - 10_800) | (F.col("time") < middle - 2 * 86_400) & (F.col("event_id") % 50 == 0))
    day_before = F.col("time") < middle - 86_400
    for part in (early.where(day_before), early.where(~day_before), changed.withColumns({"price": F.col("price") * 2, "version": F.lit(2)}), late):
        part.coalesce(1).write.mode("append").parquet(f"{path}/ticks")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/ticks")
    bars = ST.corrected_bars(stream, ["symbol", "event_id"], "version", "6h", "1 hour", order=("ts", "event_id"))
    query = bars.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    found = spark.read.schema(bars.schema).parquet(f"{path}/out").drop("timeframe")
    return rounded(found.withColumn("late", F.lit(ST.late_rows(query)).cast("long")))


on_tables(
    "st5_corrected", corrections,
    f"""WITH {EVENT_SQL}, {MIDDLE_SQL}, c AS (SELECT symbol, ts, time, event_id, price * CASE WHEN time < mid AND time >= mid - 10800 THEN 2 ELSE 1 END AS price FROM ticks, mid),
    late AS (SELECT count(*) AS late FROM ticks, mid WHERE time < mid - 172800 AND event_id % 50 = 0),
    r AS (SELECT symbol, time // 21600 * 21600 AS time, arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume, sum(price) AS turnover FROM c GROUP BY symbol, time // 21600 * 21600)
    SELECT symbol, time, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, volume, round(turnover, 6) AS turnover, late FROM r, mid, late WHERE time + 21600 <= most - 3600""",
)


def watched(spark, sf):
    """Bars in two files that overlap by two slots, with holes, one of them where the files meet; one symbol falls silent."""
    path, bars, key = new_folder(spark, "watch"), FIXTURES["ticks"][0](spark, sf), "spark.sql.streaming.stateStore.providerClass"
    middle = _middle(bars) - 10_800
    least = bars.agg(F.min("symbol")).first()[0]
    bars = bars.where(F.expr("time div 21600 % 7 <> 3") & ((F.col("symbol") != least) | (F.col("time") < middle + 86_400)))
    holes = (F.col("time") >= middle) & (F.col("time") < middle + 3 * 21_600)
    for part in (bars.where(F.col("time") < middle), bars.where((F.col("time") >= middle - 2 * 21_600) & ~holes)):
        part.coalesce(1).write.mode("append").parquet(f"{path}/bars")
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        found = drained(spark, ST.stream_quality(spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/bars"), "6h", "1 day", 3 * 86_400), "watch")
    finally:
        spark.conf.set(key, before)
    return found.groupBy("symbol").agg(F.max("last_time").alias("last_time"), *[F.sum(c).alias(c) for c in ("rows", "invalid", "misaligned", "repeats", "gaps", "missing", "silent")])


on_tables(
    "st8_watch", watched,
    f"""WITH {EVENT_SQL}, mid AS (SELECT ((min(time) + max(time)) // 2 // 21600 * 21600 + 10800) - 10800 AS mid FROM bars),
    k AS (SELECT b.*, mid, time < mid AND time >= mid - 43200 AS twice FROM bars b, mid WHERE time // 21600 % 7 <> 3 AND (symbol <> (SELECT min(symbol) FROM bars) OR time < mid + 86400) AND NOT (time >= mid AND time < mid + 64800)),
    g AS (SELECT *, (time - lag(time) OVER (PARTITION BY symbol ORDER BY time)) // 21600 - 1 AS hole FROM k)
    SELECT symbol, max(time) AS last_time, CAST(count(*) + count(*) FILTER (twice) AS BIGINT) AS rows, 0::BIGINT AS invalid, 0::BIGINT AS misaligned, count(*) FILTER (twice) AS repeats, count(*) FILTER (hole > 0) AS gaps,
    CAST(coalesce(sum(hole) FILTER (hole > 0), 0) AS BIGINT) AS missing, CASE WHEN symbol = (SELECT min(symbol) FROM bars) THEN 1 ELSE 0 END::BIGINT AS silent FROM g GROUP BY symbol""",
)
