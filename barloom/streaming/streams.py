"""Bars and what hangs on them, kept up to date with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from barloom.functions.timegrid import seconds_of
from barloom.operators.quality import gaps, misaligned, ohlc_invalid_tolerant
from barloom.sources.bars import BARS, KEY, PRICES, merge_bars, with_period


def stream_bars(ticks: DataFrame, timeframe: str, lateness: str, price: str = "price", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Each bar once, when its time is over and ticks may come no more; ticks later than `lateness` are dropped and counted by Spark."""
    size = f"{seconds_of(timeframe)} seconds"
    place = F.struct(*order)
    bars = ticks.withWatermark("ts", lateness).groupBy("symbol", F.window("ts", size)).agg(
        F.min_by(price, place).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, place).alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"), F.sum(price).alias("turnover"),
    )
    return bars.select("symbol", F.lit(timeframe).alias("timeframe"), F.unix_timestamp("window.start").alias("time"), *PRICES, "turnover")


def sliding(ticks: DataFrame, size: str, slide: str, lateness: str) -> DataFrame:
    """Rolling high, low and turnover."""
    rows = ticks.withWatermark("ts", lateness).groupBy("symbol", F.window("ts", size, slide))
    return rows.agg(F.max("price").alias("high"), F.min("price").alias("low"), F.sum("price").alias("turnover")).select("symbol", F.unix_timestamp("window.end").alias("time"), "high", "low", "turnover")


def sessions(ticks: DataFrame, gap: str, lateness: str) -> DataFrame:
    """Runs of trading without a pause of `gap`."""
    rows = ticks.withWatermark("ts", lateness).groupBy("symbol", F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("ticks"))
    return rows.select("symbol", F.unix_timestamp("session_window.start").alias("start_time"), F.unix_timestamp("session_window.end").alias("end_time"), "ticks")


def once(ticks: DataFrame, keys: list[str], lateness: str) -> DataFrame:
    """Ticks without those that came before within `lateness`; the first of a key wins, so only where repeats are equal."""
    return ticks.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)


def corrected(ticks: DataFrame, keys: list[str], version: str, lateness: str, grain: str) -> DataFrame:
    """Ticks of which the newest version of each key within the lateness counts, once its span of `grain` is over.

    A correction may come as long as the span of its tick is open; what is older is dropped, and counted, see LateRows. In a stream of several
    stateful steps Spark drops by the watermark of the batch before, so a row that is just too late may still pass. The result has `ts`
    within the span as its event time, so bars of that grain can be made of it, by corrected_bars().
    """
    rows = ticks.withWatermark("ts", lateness).groupBy(*keys, F.window("ts", grain))
    return rows.agg(F.max_by(F.struct(*[c for c in ticks.columns if c not in keys]), version).alias("__tick"))


def corrected_bars(ticks: DataFrame, keys: list[str], version: str, timeframe: str, lateness: str, price: str = "price", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Bars of the newest versions: a corrected tick changes its bar as long as that is open. Two stateful steps in one stream, append mode.

    The second step closes a window when the first can't add to it any more, which is a batch later.
    """
    size = f"{seconds_of(timeframe)} seconds"
    newest = corrected(ticks, keys, version, lateness, size).select(*keys, "window", "__tick.*")
    place = F.struct(*order)
    bars = newest.groupBy("symbol", F.window(F.window_time("window"), size).alias("bar")).agg(
        F.min_by(price, place).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, place).alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"), F.sum(price).alias("turnover"),
    )
    return bars.select("symbol", F.lit(timeframe).alias("timeframe"), F.unix_timestamp("bar.start").alias("time"), *PRICES, "turnover")


class LateRows(StreamingQueryListener):
    """Counts the rows that streams dropped as too late, by query: add it to spark.streams before they start."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass


def late_rows(query) -> int:
    """Rows that a finished query dropped as too late, from the progress that Spark keeps of its last batches; longer streams take LateRows."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def upsert(path: str, rules: dict[str, str] | None = None, keep: int = 8) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: bars of a batch take the place of those stored. A batch that is replayed changes nothing.

    A batch reads and writes the periods that its bars are in, and no others: its folder holds them whole, under timeframe and period,
    and readers take each period from the newest batch that has it. A folder counts once its write is done, so nobody sees half of one.
    What a later batch has replaced is deleted `keep` batches after that, so reads that began by then are served; what is listed stays near what is stored.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bars = with_period(batch.select(*BARS.names), rules)
        # One row a period of the batch.
        touched = {(r.timeframe, r.period) for r in bars.select("timeframe", "period").distinct().collect()}
        old = stored(spark, path, before=batch_id, periods=touched)
        merged = with_period(merge_bars(old, bars, seq="time").drop("origin"), rules)
        merged.write.mode("overwrite").partitionBy("timeframe", "period").parquet(f"{path}/batch={batch_id}")
        _drop_replaced(spark, path, batch_id - keep)

    return write


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a function that makes its paths."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _batches(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the batches whose write is done, in order."""
    fs, place = _files(spark, path)
    folders = [done.getPath().getParent() for done in fs.globStatus(place(f"{path}/batch=*/_SUCCESS")) or []]
    return sorted((int(f.getName().split("=")[1]), str(f)) for f in folders)


def _periods(spark: SparkSession, path: str) -> list[tuple[int, str, tuple[str, str], str]]:
    """(batch, its folder, (timeframe, period), the period's folder) of all that is stored, in order of batches."""
    fs, place = _files(spark, path)
    out = []
    for number, folder in _batches(spark, path):
        for part in fs.globStatus(place(f"{folder}/timeframe=*/period=*")) or []:
            at = part.getPath()
            out.append((number, folder, (at.getParent().getName().split("=")[1], at.getName().split("=")[1]), str(at)))
    return out


def _drop_replaced(spark: SparkSession, path: str, upto: int) -> None:
    """Deletes the periods that a later batch, of number `upto` at most, has too, and batches that have none left."""
    fs, place = _files(spark, path)
    parts = [x for x in _periods(spark, path) if x[0] <= upto]
    newest = {key: number for number, _, key, _ in parts}
    for number, _, key, at in parts:
        if number < newest[key]:
            fs.delete(place(at), True)
    full = set(newest.values())
    for number, folder in _batches(spark, path):
        if number <= upto and number not in full:
            fs.delete(place(folder), True)


def stored(spark: SparkSession, path: str, before: int | None = None, periods: set[tuple[str, str]] | None = None) -> DataFrame:
    """The bars below `path`, each period from the newest batch that has it, or from those before one; only some periods if they are named. Empty if there are none."""
    newest = {key: at for number, _, key, at in _periods(spark, path) if (before is None or number < before) and (periods is None or key in periods)}
    if not newest:
        return spark.createDataFrame([], BARS)
    return spark.read.schema(BARS).option("basePath", path).parquet(*newest.values()).select(*BARS.names)


class _Trend(StatefulProcessor):
    """Carries, for each series, an exponential mean and the position that it asks for."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "seen long, total double, level double, time long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        seen, total, level, last = self.state.get() if self.state.exists() else (0, 0.0, 0.0, -(2**62))
        out = []
        for bar in pd.concat(list(rows)).sort_values("time").itertuples():
            if bar.time <= last:
                continue
            seen, last = seen + 1, bar.time
            if seen <= self.n:
                total += bar.close
                level = total / seen
            else:
                level += 2 / (self.n + 1) * (bar.close - level)
            ready = seen >= self.n
            out.append((*key, bar.time, level if ready else None, float(ready and bar.close > level)))
        self.state.update((seen, total, level, last))
        yield pd.DataFrame(out, columns=["symbol", "timeframe", "time", "ema", "target"])

    def close(self) -> None:
        pass


def stream_trend(bars: DataFrame, n: int) -> DataFrame:
    """(series, time, ema, target) of a stream of finished bars: each series' state is kept from batch to batch. Needs the RocksDB state store."""
    schema = "symbol string, timeframe string, time long, ema double, target double"
    return bars.groupBy(*KEY).transformWithStateInPandas(_Trend(n), schema, "Append", "None")


class _Reversion(StatefulProcessor):
    """Carries, for each series, smoothed gains and losses, the open position, its age and its stop."""

    def __init__(self, window: int, oversold: float, exit_level: float, max_hold: int, stop_loss: float):
        self.given = (window, oversold, exit_level, max_hold, stop_loss)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "seen long, close double, gain double, loss double, side int, since long, entry double, time long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        window, oversold, exit_level, max_hold, stop_loss = self.given
        seen, close, gain, loss, side, since, entry, last = self.state.get() if self.state.exists() else (0, 0.0, 0.0, 0.0, 0, 0, 0.0, -(2**62))
        out = []
        for bar in pd.concat(list(rows)).sort_values("time").itertuples():
            if bar.time <= last:
                continue
            up, down = (max(bar.close - close, 0.0), max(close - bar.close, 0.0)) if seen else (0.0, 0.0)
            if 0 < seen <= window:
                gain, loss = gain + up / window, loss + down / window
            elif seen > window:
                gain, loss = (gain * (window - 1) + up) / window, (loss * (window - 1) + down) / window
            level = None
            if seen >= window:
                level = 50.0 if gain == loss == 0 else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss)
                if side:
                    stopped = stop_loss > 0 and bar.close <= entry * (1 - stop_loss)
                    side = 0 if level > exit_level or seen - since >= max_hold or stopped else side
                elif level < oversold:
                    side, since, entry = 1, seen, bar.close
            seen, close, last = seen + 1, bar.close, bar.time
            out.append((*key, bar.time, level, float(side)))
        self.state.update((seen, close, gain, loss, side, since, entry, last))
        yield pd.DataFrame(out, columns=["symbol", "timeframe", "time", "rsi", "target"])

    def close(self) -> None:
        pass


def stream_reversion(bars: DataFrame, window: int = 2, oversold: float = 10, exit_level: float = 50, max_hold: int = 10, stop_loss: float = 0.0) -> DataFrame:
    """(series, time, rsi, target) of a stream of finished bars, as the rule rsi-rev gives them for stored ones; out too where a close is stop_loss below the entry's."""
    schema = "symbol string, timeframe string, time long, rsi double, target double"
    return bars.groupBy(*KEY).transformWithStateInPandas(_Reversion(window, oversold, exit_level, max_hold, stop_loss), schema, "Append", "None")


def live_index(ticks: DataFrame) -> DataFrame:
    """Last price, change since the first and turnover of each symbol; of a stream in update mode, see index_sink()."""
    rows = ticks.groupBy("symbol").agg(F.max_by("price", "ts").alias("last"), F.min_by("price", "ts").alias("first"), F.sum("price").alias("turnover"))
    return rows.select("symbol", "last", (F.col("last") / F.col("first") - 1).alias("change"), "turnover")


def numbered_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink of the rows of each batch as they are, in a folder by its number; a replayed batch replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def index_sink(path: str, keys: list[str], keep: int = 8) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink of an update stream: each batch's folder holds the whole table as of then, a row a key, its own rows in place of those before.

    A batch reads the folder before its own alone, and the folders of more than `keep` batches ago are deleted; a replayed batch replaces its own.
    For tables that grow with keys, not with time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [folder for number, folder in _batches(spark, path) if number < batch_id]
        rows = batch
        if earlier:
            old = spark.read.schema(batch.schema).parquet(earlier[-1])
            rows = batch.unionByName(old.join(batch.select(*keys), keys, "left_anti"))
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        fs, place = _files(spark, path)
        for number, folder in _batches(spark, path):
            if number < batch_id - keep:
                fs.delete(place(folder), True)

    return write


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The table of an index_sink() as of its newest batch."""
    return spark.read.parquet(_batches(spark, path)[-1][1])


def quality_monitor(path: str, timeframe: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink of bars: batch_quality() of each batch, with its number."""
    sink = numbered_sink(path)
    return lambda batch, batch_id: sink(batch_quality(batch, timeframe), batch_id)


class _Watch(StatefulProcessor):
    """Carries, for each series, the last time seen; an event-time timer tells of a series that has fallen silent."""

    def __init__(self, step: int, silence: int):
        self.step, self.silence = step, silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "time long, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        last, timer = self.state.get() if self.state.exists() else (None, None)
        counts = dict.fromkeys(("rows", "invalid", "misaligned", "repeats", "gaps", "missing"), 0)
        for bar in pd.concat(list(rows)).sort_values("time", kind="stable").itertuples():
            counts["rows"] += 1
            counts["invalid"] += int(bar.odd)
            if bar.time % self.step:
                counts["misaligned"] += 1
                continue
            if last is not None and bar.time <= last:
                counts["repeats"] += 1
                continue
            if last is not None and bar.time > last + self.step:
                counts["gaps"] += 1
                counts["missing"] += (bar.time - last) // self.step - 1
            last = int(bar.time)
        if last is not None:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = (last + self.silence) * 1000
            self.handle.registerTimer(timer)
            self.state.update((last, timer))
        yield self._row(key, last, silent=0, **counts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, _ = self.state.get()
        self.state.update((last, None))
        yield self._row(key, last, rows=0, invalid=0, misaligned=0, repeats=0, gaps=0, missing=0, silent=1)

    def _row(self, key, last, **counts) -> pd.DataFrame:
        names = ("rows", "invalid", "misaligned", "repeats", "gaps", "missing", "silent")
        return pd.DataFrame([(*key, last, *(counts[c] for c in names))], columns=["symbol", "timeframe", "last_time", *names])

    def close(self) -> None:
        pass


def stream_quality(bars: DataFrame, timeframe: str, lateness: str, silence: int) -> DataFrame:
    """A row for each series and batch: rows, invalid and misaligned ones, repeats (of no later time than one before), gaps and missing bars.

    What a series has seen is kept from batch to batch, so a hole between two batches counts once, and so does a bar that comes again in
    the next. A series of which `silence` seconds of event time bring nothing gets a row of its own, `silent` 1. Needs the RocksDB state store.
    """
    step = seconds_of(timeframe)
    if step is None:
        raise ValueError("a watch needs a fixed grid")
    schema = "symbol string, timeframe string, last_time long, rows long, invalid long, misaligned long, repeats long, gaps long, missing long, silent long"
    rows = bars.select(*KEY, "time", F.coalesce(ohlc_invalid_tolerant(), F.lit(True)).alias("odd"), F.timestamp_seconds("time").alias("ts")).withWatermark("ts", lateness)
    return rows.groupBy(*KEY).transformWithStateInPandas(_Watch(step, silence), schema, "Append", "EventTime")


def batch_quality(batch: DataFrame, timeframe: str) -> DataFrame:
    """(symbol, rows, invalid, misaligned, duplicates, gaps, missing) of one batch of bars; gaps are those between its own bars."""
    flag = lambda c: F.sum(c.cast("long"))
    counts = batch.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), flag(ohlc_invalid_tolerant()).alias("invalid"), flag(misaligned(timeframe)).alias("misaligned"),
        (F.count(F.lit(1)) - F.countDistinct("time")).alias("duplicates"),
    )
    holes = gaps(batch.dropDuplicates([*KEY, "time"]), timeframe).where("missing > 0").groupBy("symbol").agg(F.count(F.lit(1)).alias("gaps"), F.sum("missing").alias("missing"))
    return counts.join(holes, "symbol", "left").fillna(0, ["gaps", "missing"])
