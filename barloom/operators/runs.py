"""A registry of runs that can be checked again: fingerprints of their data, their metrics, and what differs."""

from __future__ import annotations

import hashlib
import json
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.scalars import iso
from barloom.functions.timegrid import TIMEFRAMES, bars_per_year
from barloom.operators import basket as K
from barloom.operators.curve import buy_and_hold, equity_curve, summary, trades
from barloom.operators.performance import performance, trade_stats
from barloom.operators.quality import quality
from barloom.operators.reports import trade_table
from barloom.operators.signals import SIGNALS, signal, targets
from barloom.sources.bars import KEY
from barloom.sources.workspace import kept

#: Sets of parameters of one rule whose targets a verification works out side by side, as columns.
SETS_ASIDE = 16
_WINDOW = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("timeframe", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("bars", "first", "last")]
    + [T.StructField("digest", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("gaps", "missing_bars", "bars_violating_ohlc")]
)
RUNS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("run_id", "recorded_at", "label", "strategy", "kind", "note", "trades_file", "_bad")]
    + [
        T.StructField("params", T.MapType(T.StringType(), T.StringType())), T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("costs", T.StructType([T.StructField("fee_per_side", T.DoubleType()), T.StructField("slippage_per_side", T.DoubleType())])),
        T.StructField("data", _WINDOW), T.StructField("legs", T.MapType(T.StringType(), _WINDOW)), T.StructField("journal_format", T.IntegerType()),
    ]
)


def fingerprints(bars: DataFrame) -> DataFrame:
    """(series, bars, digest): SHA-256 over the number of bars and each bar's time and prices, little-endian, in order of time.

    It doesn't depend on how files are laid out. One series is one group.
    """

    def digest(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("time", kind="stable")
        packed = np.zeros(len(rows), np.dtype([("time", "<i8")] + [(c, "<f8") for c in ("open", "high", "low", "close", "volume")]))
        for c in packed.dtype.names:
            packed[c] = rows[c].to_numpy()
        made = hashlib.sha256(np.int64(len(rows)).astype("<i8").tobytes() + packed.tobytes()).hexdigest()
        return pd.DataFrame([{"symbol": rows["symbol"].iloc[0], "timeframe": rows["timeframe"].iloc[0], "bars": len(rows), "digest": made}])

    return bars.groupBy(*KEY).applyInPandas(digest, "symbol string, timeframe string, bars long, digest string")


def quick_fingerprints(bars: DataFrame) -> DataFrame:
    """(series, bars, mark): a sum of row hashes over times and values in millionths, for a cheap look at whether anything changed; order-free and pre-aggregated."""
    cells = [F.col("time").cast("string"), *[F.round(F.col(c) * 1_000_000).cast("long").cast("string") for c in ("open", "high", "low", "close", "volume")]]
    row = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 12), 16, 10).cast("long")
    return bars.groupBy(*KEY).agg(F.count(F.lit(1)).alias("bars"), F.sum(row.cast("decimal(28,0)")).alias("mark"))


def _figures(curve: DataFrame, per_year: Column | float, value: str, prefix: str, keys=KEY) -> DataFrame:
    """(keys, figures): the comparable numbers of each curve, by name."""
    names = {"total_return": "total_return", "cagr": "cagr", "ann_vol": "ann_vol", "sharpe": "sharpe", "max_dd": "max_drawdown", "years": "years", "final_equity": "final_equity"}
    pairs = [x for name, column in names.items() for x in (F.lit(f"{prefix}.{name}"), F.col(column).cast("double"))]
    return performance(curve, per_year, value, keys).select(*keys, F.create_map(*pairs).alias(prefix))


def _yearly() -> Column:
    """Bars a year of each row's own timeframe."""
    return F.try_element_at(F.create_map(*[F.lit(x) for t in TIMEFRAMES for x in (t, bars_per_year(t))]), F.col("timeframe"))


def run_curve(bars: DataFrame, strategy: str, params: dict, rate: float) -> DataFrame:
    return equity_curve(buy_and_hold(signal(bars, strategy, **params), rate), rate)


def run_metrics(bars: DataFrame, strategy: str, params: dict, rate: float, timeframe: str) -> DataFrame:
    """(series, metrics) of one strategy on every series: figures of the curve and of holding, costs, exposure and trades as one flat map without nulls."""
    return _metrics_of(run_curve(bars, strategy, params, rate), bars_per_year(timeframe))


def _metrics_of(curve: DataFrame, per_year: Column | float) -> DataFrame:
    own, hold = _figures(curve, per_year, "equity", "strategy"), _figures(curve, per_year, "hold_net", "buy_hold")
    closed = trade_stats(trades(curve)).select(*KEY, F.create_map(F.lit("trades.n_closed"), F.col("n_closed").cast("double"), F.lit("trades.win_rate"), F.col("win_rate"), F.lit("trades.mean_return"), F.col("mean_return")).alias("trades"))
    money = summary(curve).select(*KEY, F.create_map(*[x for c in ("final_equity", "gross_equity", "fees_paid", "exposure") for x in (F.lit(c), F.col(c))]).alias("money"))
    rows = own.join(hold, list(KEY)).join(money, list(KEY)).join(closed, list(KEY), "left")
    every = F.map_concat("strategy", "buy_hold", "money", F.coalesce("trades", F.create_map(F.lit("trades.n_closed"), F.lit(0.0))))
    return rows.select(*KEY, F.map_filter(every, lambda _, v: v.isNotNull()).alias("metrics"))


def basket_metrics(bars: DataFrame, strategy: str, params: dict, rate: float, timeframe: str) -> DataFrame:
    """(field, value) of an equal basket of all series: return.*, benchmark.*, fees_paid and legs.<symbol>.* on the times that all share."""
    return _basket_of(run_curve(bars, strategy, params, rate), K.timeline(bars), bars_per_year(timeframe))


def _basket_of(curve: DataFrame, times: DataFrame, per_year: Column | float, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, field, value) of each basket, told apart by the columns `by`, all in one plan."""
    legs = kept(K.legs(curve, times, by), "legs")
    keys = (*by, *KEY)
    whole = legs.groupBy(*by, "time").agg((1 + F.avg(F.col("leg") - 1)).alias("basket"), F.avg("hold_net").alias("hold"), F.max("timeframe").alias("timeframe"))
    whole = whole.withColumn("symbol", F.lit(""))
    fields = lambda df, column: df.select(*by, F.explode(column).alias("field", "value"))
    sums = [fields(_figures(whole, per_year, "basket", "return", keys), "return"), fields(_figures(whole, per_year, "hold", "benchmark", keys), "benchmark")]
    sums.append(legs.groupBy(*by).agg(F.sum("fee").alias("value")).select(*by, F.lit("fees_paid").alias("field"), "value"))
    leg = [*by, "symbol"]
    parts = _figures(legs, per_year, "leg", "leg", keys).select(*leg, F.col("leg")["leg.sharpe"].alias("sharpe"))
    parts = parts.join(K.contributions(legs, by), leg).join(legs.groupBy(*leg).agg(F.sum("fee").alias("fees")), leg)
    named = F.create_map(*[x for n, c in (("total_return", "total"), ("sharpe", "sharpe"), ("exposure", "exposure"), ("fees", "fees"), ("contribution", "contribution")) for x in (F.lit(n), F.col(c))])
    sums.append(parts.select(*leg, F.explode(named).alias("name", "value")).select(*by, F.concat_ws(".", F.lit("legs"), "symbol", "name").alias("field"), "value"))
    return reduce(DataFrame.unionByName, sums).where("value is not null")


def windows_of(bars: DataFrame, timeframe: str) -> DataFrame:
    """(series, data): what bars a run has seen, their digest, and their audit."""
    seen = quality(bars, timeframe).join(fingerprints(bars).select(*KEY, "digest"), list(KEY))
    data = F.struct("symbol", "timeframe", "bars", F.col("first_time").alias("first"), F.col("last_time").alias("last"), "digest", "gaps", F.col("missing").alias("missing_bars"), F.col("bad_ohlc").alias("bars_violating_ohlc"))
    return seen.select(*KEY, data.cast(_WINDOW).alias("data"))


def record_runs(
    bars: DataFrame, strategy: str, params: dict, timeframe: str, recorded_at: str, fee: float = 0.001, slippage: float = 0.0, note: str = "", trades_file: str | None = None
) -> DataFrame:
    """A record for each series, of the columns of RUNS: parameters, costs, window with digest and audit, metrics. recorded_at is an ISO moment.

    trades_file names the run's table of trades, see recorded_trades(); `{run_id}` in it stands for the run's own id.
    """
    stamp = "".join(c for c in recorded_at if c.isdigit())
    rows = windows_of(bars, timeframe).join(run_metrics(bars, strategy, params, fee + slippage, timeframe), list(KEY))
    label = F.concat_ws("-", F.lit(strategy), "symbol", "timeframe")
    run_id = F.concat_ws("-", F.lit(stamp), label)
    file = F.replace(F.lit(trades_file).cast("string"), F.lit("{run_id}"), run_id)
    return rows.select(
        run_id.alias("run_id"), F.lit(recorded_at).alias("recorded_at"), label.alias("label"), F.lit(strategy).alias("strategy"), F.lit("backtest").alias("kind"),
        F.lit(note).alias("note"), file.alias("trades_file"), *_given(params, fee, slippage), "metrics", "data", F.lit(1).alias("journal_format"),
    )


def record_sets(bars: DataFrame, sets: list[tuple[str, dict]], timeframe: str, recorded_at: str, fee: float = 0.001, slippage: float = 0.0, note: str = "") -> DataFrame:
    """record_runs() of each series with each of the sets of (strategy, parameters), all in one plan; runs of one name are numbered in order of the sets, see named().

    The bars of a series are stored once for each set, as its curves are.
    """
    stamp, rate = "".join(c for c in recorded_at if c.isdigit()), float(fee + slippage)
    every = F.explode(F.sequence(F.lit(0), F.lit(len(sets) - 1))).alias("__set")
    number, own = F.split("symbol", "\0")[0].cast("int"), F.split("symbol", "\0")[1]
    rows = kept(bars.select("*", every).withColumn("symbol", F.concat(F.col("__set").cast("string"), F.lit("\0"), "symbol")), "windows")
    curves = kept(equity_curve(buy_and_hold(run_targets(rows, sets), rate), rate), "curves")
    metrics = _metrics_of(curves, _yearly()).select(number.alias("__set"), own.alias("symbol"), "timeframe", "metrics")
    given = [_given(params, fee, slippage) for _, params in sets]
    of = lambda values: F.array(*values)[F.col("__set")]
    rows = windows_of(bars, timeframe).join(metrics, list(KEY)).withColumns({"strategy": of([F.lit(s) for s, _ in sets]), "params": of([p for p, _ in given])})
    rows = rows.withColumn("label", F.concat_ws("-", "strategy", "symbol", "timeframe"))
    rows = named(rows.withColumn("__name", F.concat_ws("-", F.lit(stamp), "label")), "__name", ["__set"])
    return rows.select(
        "run_id", F.lit(recorded_at).alias("recorded_at"), "label", "strategy", F.lit("backtest").alias("kind"), F.lit(note).alias("note"), "params", given[0][1], "metrics", "data",
        F.lit(1).alias("journal_format"),
    )


def recorded_trades(runs: DataFrame, bars: DataFrame, strategy: str, params: dict, rate: float) -> DataFrame:
    """The table of trades of each of the runs (all of one strategy): (trades_file, n, ...) with the lines of reports.trade_table(), n from 0 in order of time."""
    found = _numbered(trades(run_curve(bars, strategy, params, rate)))
    named = runs.where("trades_file is not null").select("trades_file", F.col("data.symbol").alias("symbol"), F.col("data.timeframe").alias("timeframe"))
    return named.join(trade_table(found, keep=("n",)), list(KEY)).drop(*KEY)


def _numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n", F.row_number().over(W.partitionBy(*KEY).orderBy("trade")) - 1)


#: Fields of a table of trades: text as it is, prices to 1e-8 of themselves, returns to 1e-6.
_TEXTS, _PRICES, _RETURNS = ("side", "entry_time_utc", "exit_time_utc", "bars_held", "open_at_end"), ("entry_price", "exit_price"), ("gross_return", "net_return")


def trade_tables_compared(runs: DataFrame, recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """(run_id, field, recorded, actual), as text, where a run's table of trades isn't what the run gives.

    runs (run_id, trades_file) name their tables; recorded has the tables' lines by trades_file and n, as text or numbers, actual the trades by run_id
    and n, typed. A table that isn't there and one of another length differ as a whole, others line by line; what is no number differs.
    """
    named = runs.where("trades_file is not null").select("run_id", "trades_file")
    lengths = recorded.groupBy("trades_file").agg(F.count(F.lit(1)).alias("lines"))
    sizes = actual.groupBy("run_id").agg(F.count(F.lit(1)).alias("trades"))
    named = named.join(lengths, "trades_file", "left").join(sizes, "run_id", "left").withColumn("trades", F.coalesce("trades", F.lit(0)))
    whole = named.where("lines is null or lines <> trades").select(
        "run_id", F.when(F.col("lines").isNull(), "trades_file").otherwise("trades.rows").alias("field"),
        F.when(F.col("lines").isNull(), F.col("trades_file")).otherwise(F.col("lines").cast("string")).alias("recorded"),
        F.when(F.col("lines").isNull(), "missing").otherwise(F.col("trades").cast("string")).alias("actual"),
    )
    both = named.where("lines = trades").join(recorded.alias("r"), "trades_file").join(actual.alias("a"), ["run_id", "n"])
    fields = []
    for name in (*_TEXTS, *_PRICES, *_RETURNS):
        was, now = F.col(f"r.{name}").cast("string"), F.col(f"a.{name}")
        if name in _TEXTS:
            wrong = F.coalesce(was, F.lit("")) != F.coalesce(now.cast("string"), F.lit(""))
        else:
            room = F.abs(now) * 1e-8 if name in _PRICES else F.lit(1e-6)
            wrong = F.coalesce(F.abs(was.try_cast("double") - now) > room, F.lit(True))
        fields.append(F.when(wrong, F.struct(F.concat(F.lit("trades["), F.col("n"), F.lit(f"].{name}")).alias("field"), was.alias("recorded"), now.cast("string").alias("actual"))))
    lines = both.select("run_id", F.explode(F.array_compact(F.array(*fields))).alias("x")).select("run_id", "x.*")
    return whole.unionByName(lines)


def record_basket(bars: DataFrame, strategy: str, params: dict, timeframe: str, recorded_at: str, fee: float = 0.001, slippage: float = 0.0, note: str = "") -> DataFrame:
    """One record for the basket of all series, with the window of each leg."""
    stamp = "".join(c for c in recorded_at if c.isdigit())
    legs = windows_of(bars, timeframe).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("symbol", "data")))).alias("legs"))
    metrics = basket_metrics(bars, strategy, params, fee + slippage, timeframe).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value")))).alias("metrics"))
    label = F.concat_ws("-", F.lit("basket"), F.lit(timeframe), F.concat(F.size("legs").cast("string"), F.lit("legs")))
    return legs.crossJoin(metrics).select(
        F.concat_ws("-", F.lit(stamp), label).alias("run_id"), F.lit(recorded_at).alias("recorded_at"), label.alias("label"), F.lit(strategy).alias("strategy"), F.lit("basket").alias("kind"),
        F.lit(note).alias("note"), *_given(params, fee, slippage), "metrics", "legs", F.lit(1).alias("journal_format"),
    )


def _given(params: dict, fee: float, slippage: float) -> list[Column]:
    pairs = [x for k in sorted(params) for x in (F.lit(k), F.lit(str(params[k])))]
    held = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return [held.alias("params"), F.struct(F.lit(float(fee)).alias("fee_per_side"), F.lit(float(slippage)).alias("slippage_per_side")).alias("costs")]


def rebuilt(strategy: str, params: dict) -> dict | None:
    """Parameters of a record as the strategy takes them, or None if there is no such strategy or it doesn't take them."""
    if strategy not in SIGNALS or set(params) - set(SIGNALS[strategy].defaults):
        return None
    try:
        kinds = {k: type(v) for k, v in SIGNALS[strategy].defaults.items()}
        return {k: v == "True" if kinds[k] is bool else kinds[k](float(v)) if kinds[k] in (int, float) else v for k, v in params.items()}
    except ValueError:
        return None


def run_targets(bars: DataFrame, sets: list[tuple[str, dict]]) -> DataFrame:
    """bars with `target` and `exit_price` by the rule of their own `__set`, an index into sets of (strategy, parameters).

    The sets of a rule are columns of one branch over the series that ask for them, SETS_ASIDE at a time, and each series takes its own. So the plan
    grows with rules, and beyond SETS_ASIDE with their sets, never with series. bars are read by each branch and should be stored.
    """
    rules: dict[str, list[int]] = {}
    for i, (strategy, _) in enumerate(sets):
        rules.setdefault(strategy, []).append(i)
    parts = []
    for strategy, every in rules.items():
        for at in range(0, len(every), SETS_ASIDE):
            some = every[at : at + SETS_ASIDE]
            rows = targets(bars.where(F.col("__set").isin(some)), strategy, [sets[i][1] for i in some])
            own = {c: F.coalesce(*[F.when(F.col("__set") == i, F.col(f"__{c}{j}")) for j, i in enumerate(some)]) for c in ("target", "exit") if f"__{c}0" in rows.columns}
            parts.append(rows.select(*bars.columns, own["target"].alias("target"), own.get("exit", F.lit(None).cast("double")).alias("exit_price")))
    none = bars.where("false").select("*", F.lit(None).cast("double").alias("target"), F.lit(None).cast("double").alias("exit_price"))
    return reduce(DataFrame.unionByName, parts) if parts else none


def verify_runs(runs: DataFrame, bars: DataFrame, verified_at: str, tol: float = 1e-9, tables: DataFrame | None = None) -> DataFrame:
    """(run_id, verified_at, status, bars, digest_recorded, digest_actual, mismatches, trades_checked) of every record, worked out anew from the bars of its own window.

    tables are the recorded tables of trades, as recorded_trades() gives them or as they are read from CSV. With them a run that names one is
    held against it line by line, and a line that was changed, or a table that is missing, is a mismatch like a figure that differs.

    error: the bars aren't there any more; unknown-strategy: it can't be rebuilt; mismatch: a figure differs; data-changed: the figures
    are the same, the bars aren't; else verified. All runs and baskets are one plan: their windows are stored once, their rules give targets
    (run_targets()), costs and bars a year are columns, and one chain makes all curves, which are stored too. The driver holds a line for each distinct set of a strategy and its parameters.
    """
    spark = runs.sparkSession
    runs = runs.select([f.name for f in RUNS.fields if f.name in runs.columns])
    single = runs.where("kind <> 'basket'").select("run_id", F.array("data").alias("seen")) if "data" in runs.columns else None
    legs = runs.where("kind = 'basket'").select("run_id", F.map_values("legs").alias("seen")) if "legs" in runs.columns else None
    seen = reduce(DataFrame.unionByName, [x for x in (single, legs) if x is not None]).select("run_id", F.explode("seen").alias("w")).select("run_id", "w.symbol", "w.timeframe", "w.first", "w.last", F.col("w.digest").alias("recorded"))
    keyed = runs.select("run_id", "kind", "strategy", F.coalesce(F.to_json("params"), F.lit("{}")).alias("given"), (F.col("costs.fee_per_side") + F.col("costs.slippage_per_side")).alias("__rate"))
    sets, numbers = [], []
    for x in keyed.select("strategy", "given").distinct().collect():
        params = rebuilt(x.strategy, json.loads(x.given))
        numbers.append((x.strategy, x.given, None if params is None else len(sets)))
        if params is not None:
            sets.append((x.strategy, params))
    known = spark.createDataFrame(numbers, "__strategy string, __given string, __set int")
    keyed = keyed.join(known, F.col("strategy").eqNullSafe(F.col("__strategy")) & (F.col("given") == F.col("__given")))
    sliced = run_window(bars, seen.select("run_id", *KEY, "first", "last")).drop("first", "last")
    # Each run's window of a series is a series of its own; a zero byte is in no symbol.
    owner, leg = F.split("symbol", "\0")[0], F.split("symbol", "\0")[1]
    own = sliced.join(keyed.select("run_id", "kind", "__set", "__rate"), "run_id").withColumn("symbol", F.concat("run_id", F.lit("\0"), "symbol"))
    own = kept(own.drop("run_id"), "windows")
    marks = fingerprints(own.drop("kind", "__set", "__rate")).select(owner.alias("run_id"), leg.alias("symbol"), "bars", "digest")
    joined = lambda c: F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "symbol", c))), "|")
    data = seen.join(marks, ["run_id", "symbol"], "left").groupBy("run_id").agg(
        F.sum("bars").alias("bars"), F.bool_and(F.col("digest").isNotNull()).alias("there"), F.bool_and(F.col("digest") == F.col("recorded")).alias("same"),
        joined("recorded").alias("digest_recorded"), joined("digest").alias("digest_actual"),
    )
    curves = run_targets(own.where("__set is not null"), sets)
    curves = kept(equity_curve(buy_and_hold(curves, F.col("__rate")), F.col("__rate")), "curves").withColumn("run_id", owner)
    alone, together = curves.where("kind <> 'basket'"), curves.where("kind = 'basket'").withColumn("symbol", leg)
    actual = _metrics_of(alone, _yearly()).select(owner.alias("run_id"), F.explode("metrics").alias("field", "value"))
    if legs is not None:
        actual = actual.unionByName(_basket_of(together, K.timeline(together, ("run_id",)), _yearly(), ("run_id",)))
    odd = keyed.where("__set is null").select("run_id", F.lit(True).alias("unknown"))
    wrong = compared(flattened(runs), actual, tol).select("run_id", "field", *[F.col(c).cast("string").alias(c) for c in ("recorded", "actual")])
    checked = F.lit(False)
    if tables is not None and "trades_file" in runs.columns:
        # only runs that could be worked out: those of bars that are gone or of an unknown strategy are errors of their own
        able = runs.where("kind <> 'basket'").join(odd, "run_id", "left_anti").join(data.where("there").select("run_id"), "run_id", "left_semi")
        found = _numbered(trades(alone)).withColumn("run_id", owner)
        sides, moments = F.when(F.col("side") > 0, "long").otherwise("short"), {f"{c}_utc": iso(F.col(c)) for c in ("entry_time", "exit_time")}
        found = found.withColumns({"side": sides, "open_at_end": F.when(F.col("open_at_end"), "yes").otherwise(""), **moments}).select("run_id", "n", *_TEXTS, *_PRICES, *_RETURNS)
        wrong = wrong.unionByName(trade_tables_compared(able, tables, found))
        rows_with = runs.where("trades_file is not null and kind <> 'basket'").select("run_id", F.lit(True).alias("named"))
        data, checked = data.join(rows_with, "run_id", "left"), F.coalesce("named", F.lit(False))
    wrong = wrong.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct("field", "recorded", "actual"))).alias("mismatches"))
    rows = data.join(odd, "run_id", "left").join(wrong, "run_id", "left")
    status = (
        F.when(~F.col("there"), "error").when(F.coalesce("unknown", F.lit(False)), "unknown-strategy").when(F.size(F.coalesce("mismatches", F.array())) > 0, "mismatch")
        .when(~F.col("same"), "data-changed").otherwise("verified")
    )
    return rows.select("run_id", F.lit(verified_at).alias("verified_at"), status.alias("status"), F.coalesce("bars", F.lit(0)).alias("bars"), "digest_recorded", "digest_actual", F.when(status == "mismatch", F.col("mismatches")).alias("mismatches"), (checked & status.isin("verified", "mismatch", "data-changed")).alias("trades_checked"))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs of JSON lines; a line that is none has its text in `_bad`."""
    return spark.read.schema(RUNS).option("columnNameOfCorruptRecord", "_bad").json(path)


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) of each line that is no record: numbered from 1 within its file, which is read whole for that by one task."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\n")).alias("at", "text"))
    parsed = F.from_json("text", "run_id string, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    bad = (F.trim("text") != "") & (parsed["_bad"].isNotNull() | parsed["run_id"].isNull())
    return text.where(bad).select("file", (F.col("at") + 1).alias("line"), "text")


def named(rows: DataFrame, base: str, order: list[str]) -> DataFrame:
    """rows with unique run_id: the column base, then -2, -3, ... for those that share one."""
    n = F.row_number().over(W.partitionBy(base).orderBy(*order))
    return rows.withColumn("run_id", F.when(n == 1, F.col(base)).otherwise(F.concat(base, F.lit("-"), n.cast("string"))))


def append_runs(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def flattened(runs: DataFrame) -> DataFrame:
    """(run_id, field, value) of each metric."""
    return runs.select("run_id", F.explode("metrics").alias("field", "value"))


def differs(a: Column, b: Column, tol: float = 1e-9) -> Column:
    """Beyond tol, relative to the larger; a side that is missing differs."""
    scale = F.greatest(F.abs(a), F.abs(b), F.lit(1e-12))
    return a.isNull() | b.isNull() | (F.abs(a - b) > tol * scale)


def compared(recorded: DataFrame, actual: DataFrame, tol: float = 1e-9) -> DataFrame:
    """(run_id, field, recorded, actual) where the metrics of two tables (run_id, field, value) differ."""
    a, b = recorded.withColumnRenamed("value", "recorded"), actual.withColumnRenamed("value", "actual")
    return a.join(b, ["run_id", "field"], "full_outer").where(differs(F.col("recorded"), F.col("actual"), tol))


def run_window(bars: DataFrame, windows: DataFrame) -> DataFrame:
    """bars of each run's recorded window (run_id, series, first, last): a join on the series with a range of times."""
    return bars.join(windows, list(KEY)).where("time between first and last")


def latest_status(checks: DataFrame) -> DataFrame:
    return checks.groupBy("run_id").agg(F.max_by("status", F.struct("verified_at", "seq")).alias("status"), F.max("verified_at").alias("verified_at"))


def rolled_up(runs: DataFrame, status: DataFrame) -> DataFrame:
    """For each strategy and parameters: runs, the latest total, the best and worst, and how many are verified."""
    rows = runs.join(status, "run_id", "left")
    return rows.groupBy("strategy", "params").agg(
        F.count(F.lit(1)).alias("runs"), F.max_by("total", "recorded_at").alias("latest"), F.max("total").alias("best"), F.min("total").alias("worst"),
        F.sum((F.col("status") == "verified").cast("long")).alias("verified"),
    )


def run_table(runs: DataFrame, status: DataFrame) -> DataFrame:
    """Newest first: headline figures of `strategy.*`, or of `return.*` for baskets, trades, number of legs, and the last check's mark."""
    figure = lambda name: F.coalesce(F.col("metrics")[f"strategy.{name}"], F.col("metrics")[f"return.{name}"]).alias(name)
    out = runs.join(status.select("run_id", "status"), "run_id", "left")
    legs = F.greatest(F.size("legs"), F.lit(0)) if "legs" in runs.columns else F.lit(0)
    return out.select(
        "run_id", "recorded_at", "strategy", figure("total_return"), figure("cagr"), figure("max_dd"), figure("sharpe"), F.col("metrics")["trades.n_closed"].cast("long").alias("trades"), legs.alias("legs"),
        F.coalesce("status", F.lit("-")).alias("status"),
    ).orderBy(F.col("recorded_at").desc(), "run_id")


def trades_compared(recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """(run_id, n) of trades (run_id, n, side, price, net) that differ: sides as text, prices to 1e-8 of themselves, returns to 1e-6."""
    both = recorded.alias("r").join(actual.alias("a"), ["run_id", "n"], "full_outer")
    same = F.col("r.side").eqNullSafe(F.col("a.side")) & ~differs(F.col("r.price"), F.col("a.price"), 1e-8) & (F.abs(F.col("r.net") - F.col("a.net")) <= 1e-6)
    return both.where(~F.coalesce(same, F.lit(False))).select("run_id", "n")


def claims_checked(claims: DataFrame, measured: DataFrame) -> DataFrame:
    """(claim, value, measured, ok, known): claims (claim, value, tolerance, relative) against measured figures.

    A claim whose own `known` is true is a discrepancy that is on record: where it isn't ok, `known` says so, and nobody has to look.
    """
    rows = claims.join(measured, "claim", "left")
    room = F.when(F.col("relative"), F.abs("value") * F.col("tolerance")).otherwise(F.col("tolerance"))
    ok = F.coalesce(F.abs(F.col("measured") - F.col("value")) <= room, F.lit(False))
    known = F.coalesce("known", F.lit(False)) if "known" in claims.columns else F.lit(False)
    return rows.select("claim", "value", "measured", ok.alias("ok"), (known & ~ok).alias("known"))


def nested(metrics: DataFrame) -> DataFrame:
    """(run_id, metrics): one map a run of (run_id, field, value)."""
    return metrics.groupBy("run_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value")))).alias("metrics"))
