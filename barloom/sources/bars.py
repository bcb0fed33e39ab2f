"""Bars: their schema, reading, writing, merging, and the ways that they come about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.timegrid import TIMEFRAMES, align, default_rule, period
from barloom.sources.workspace import new_folder

KEY = ("symbol", "timeframe")
PRICES = ("open", "high", "low", "close", "volume")
BARS = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("timeframe", T.StringType()), T.StructField("time", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in (*PRICES, "turnover")]
)


def in_order() -> W:
    return W.partitionBy(*KEY).orderBy("time")


def read_bars(spark: SparkSession, path: str, symbols=None, timeframes=None, since: int | None = None, until: int | None = None) -> DataFrame:
    """All bars under a folder, or of some series and times: filters reach the scan.

    Folders are those that write_bars makes, timeframe=.../period=..., or plain ones, <symbol>/<timeframe>/..., however deep; in plain ones the
    files may hold time and prices alone, and the series is that of the path. Of bars that several files of a plain archive hold, see read_archive().
    """
    if _is_partitioned(spark, path):
        schema = T.StructType([*BARS.fields, T.StructField("period", T.StringType())])
        bars = spark.read.schema(schema).parquet(path)
    else:
        bars = _plain(spark, path, symbols, timeframes)
    for column, wanted in (("symbol", symbols), ("timeframe", timeframes)):
        if wanted is not None:
            bars = bars.where(F.col(column).isin(list(wanted)))
    if since is not None:
        bars = bars.where(F.col("time") >= since)
    if until is not None:
        bars = bars.where(F.col("time") <= until)
    return bars.select(*BARS.names)


def _is_partitioned(spark: SparkSession, path: str) -> bool:
    """Whether the folder's own folders are named key=value."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
    return any("=" in f.getPath().getName() for f in found)


def stored_periods(spark: SparkSession, path: str, timeframe: str) -> list[str]:
    """The periods that an archive of write_bars() has of a timeframe, in order, from the names of its folders."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/timeframe={timeframe}/period=*")
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return sorted(f.getPath().getName().split("=", 1)[1] for f in found or [])


def _plain(spark: SparkSession, path: str, symbols=None, timeframes=None) -> DataFrame:
    """Bars of <symbol>/<timeframe>/... with `file`, what the file's path is below the folder; folders of other series aren't listed."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    wanted = [f"{path.rstrip('/')}/{s}/{t}" for s in symbols or ("*",) for t in timeframes or ("*",)]
    found = [p for p in wanted if fs.globStatus(place(p))]
    if not found:
        return spark.createDataFrame([], T.StructType([*BARS.fields, T.StructField("file", T.StringType())]))
    bars = spark.read.schema(BARS).option("recursiveFileLookup", "true").parquet(*found)
    root = path.rstrip("/").rsplit("/", 1)[-1]
    file = F.substring_index(F.col("_metadata.file_path"), f"/{root}/", -1)
    parts = F.split(file, "/")
    series = {"symbol": F.url_decode(parts[0]), "timeframe": F.get(parts, F.lit(1))}
    return bars.select(*[F.coalesce(c, series[c]).alias(c) if c in series else F.col(c) for c in BARS.names], file.alias("file"))


def read_archive(spark: SparkSession, path: str, symbols=None, timeframes=None) -> DataFrame:
    """Bars of a plain archive <symbol>/<timeframe>/<period>.parquet; of bars that several files hold that of the file that sorts last, so newer periods win."""
    return dedupe_bars(_plain(spark, path, symbols, timeframes), F.col("file")).drop("file")


def payload(bars: DataFrame) -> DataFrame:
    """(series, t, o, h, l, c, v): each series as parallel arrays in order of time, as charts take them. A series is one row."""
    ordered = F.sort_array(F.collect_list(F.struct("time", "open", "high", "low", "close", "volume")))
    rows = bars.groupBy(*KEY).agg(ordered.alias("x"))
    return rows.select(*KEY, *[F.col(f"x.{c}").alias(a) for a, c in zip("tohlcv", ("time", "open", "high", "low", "close", "volume"), strict=True)])


def dedupe_bars(bars: DataFrame, order: Column) -> DataFrame:
    """One row for each series and time: the last in `order`, a file's name or a sequence number."""
    last = W.partitionBy(*KEY, "time").orderBy(order.desc())
    return bars.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def traded(bars: DataFrame) -> DataFrame:
    """time, close and turnover alone; turnover that is null or 0 becomes close * volume."""
    value = F.coalesce(F.nullif(F.col("turnover"), F.lit(0.0)), F.col("close") * F.coalesce("volume", F.lit(0.0)))
    return bars.select(*KEY, "time", "close", value.alias("turnover"))


def list_series(bars: DataFrame) -> DataFrame:
    return bars.select(*KEY).distinct()


def ends(bars: DataFrame, n: int, newest: bool) -> DataFrame:
    """The first or the last n bars of each series."""
    order = W.partitionBy(*KEY).orderBy(F.col("time").desc() if newest else F.col("time"))
    return bars.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= n).drop("__n")


def page(bars: DataFrame, n: int, end: int | None = None) -> DataFrame:
    """The newest n bars up to `end` of each series, whether older ones exist, and the series' length."""
    every = W.partitionBy(*KEY)
    marked = bars.withColumn("first_time", F.min("time").over(every)).withColumn("n_bars", F.count(F.lit(1)).over(every))
    shown = ends(marked if end is None else marked.where(F.col("time") <= end), n, newest=True)
    return shown.withColumn("more", F.min("time").over(every) > F.col("first_time")).drop("first_time")


def with_period(bars: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """bars with the `period` that each is stored under, by its timeframe's rule."""
    rules, when = rules or {}, F
    for timeframe in TIMEFRAMES:
        when = when.when(F.col("timeframe") == timeframe, period(F.col("time"), rules.get(timeframe, default_rule(timeframe))))
    return bars.withColumn("period", when.otherwise(F.lit("all")))


def write_bars(bars: DataFrame, path: str, rules: dict[str, str] | None = None) -> None:
    """Parquet in Zstandard by timeframe and period; only the partitions that the rows touch are replaced.

    rules names another period for a timeframe: month, year or single.
    """
    rows = with_period(bars, rules)
    rows = rows.repartition("timeframe", "period", "symbol").sortWithinPartitions("timeframe", "period", "symbol", "time")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("timeframe", "period").parquet(path)


def merge_bars(existing: DataFrame, fresh: DataFrame, seq: str) -> DataFrame:
    """existing and fresh as one, with `origin`: kept, added, refreshed or same. A fresh bar wins; of fresh repeats the first.

    seq names the column of `fresh` that orders its rows, so that a task that runs again chooses the same; rows of one seq go by their values.
    """
    values = [*PRICES, "turnover"]
    order = W.partitionBy(*KEY, "time").orderBy(seq, *[v for v in values if v != seq])
    new = fresh.withColumn("__n", F.row_number().over(order)).where("__n = 1")
    new = new.select(*KEY, "time", F.struct(*values).alias("new"))
    old = existing.select(*KEY, "time", F.struct(*values).alias("old"))
    both = old.join(new, [*KEY, "time"], "full_outer")
    chosen = F.coalesce("new", "old")
    origin = (
        F.when(F.col("new").isNull(), "kept").when(F.col("old").isNull(), "added").when(F.col("new").eqNullSafe(F.col("old")), "same").otherwise("refreshed")
    )
    return both.select(*KEY, "time", *[chosen[v].alias(v) for v in values], origin.alias("origin"))


def merge_stats(merged: DataFrame) -> DataFrame:
    """Counts of a merge by series: before, after, added, refreshed, changed."""
    of = lambda *kinds: F.sum(F.col("origin").isin(*kinds).cast("long"))
    return merged.groupBy(*KEY).agg(
        of("kept", "same", "refreshed").alias("before"), F.count(F.lit(1)).alias("after"), of("added").alias("added"),
        of("refreshed").alias("refreshed"), (of("added", "refreshed") > 0).alias("changed"), F.min("time").alias("first_time"), F.max("time").alias("last_time"),
    )


def changed_periods(merged: DataFrame, rule: str) -> DataFrame:
    """Rows of the partitions that a merge changed; only these need writing."""
    rows = merged.withColumn("period", period(F.col("time"), rule))
    touched = rows.where(F.col("origin").isin("added", "refreshed")).select("timeframe", "period").distinct()
    return rows.join(touched, ["timeframe", "period"], "left_semi")


def ingest(spark: SparkSession, path: str, fresh: DataFrame, seq: str, dry_run: bool = False, rules: dict[str, str] | None = None) -> DataFrame:
    """Merges fresh bars into the partitioned archive at `path` and reports on it: a row a series, and one of null symbol for the run.

    fresh may have `ok`, as parse_raw_rows() gives it: rows that are none are rejected. Columns: fetched, rejected, invalid (kept though high, low, open and close
    don't fit), added, refreshed, net, files_changed and files_unchanged (periods of a series that rows came for), first_time and last_time
    as stored afterwards.

    Only the periods that rows came for are read. The merge is written once to the shared folder, with its totals observed on the way; the periods that it
    changed are then put in place of those stored, and none if there is nothing new. A dry run writes nothing, and reads the ends of
    each series alone: what lies outside of them counts as added, nothing as refreshed.
    """
    ok = F.coalesce("ok", F.lit(False)) if "ok" in fresh.columns else F.lit(True)
    rows = with_period(fresh.withColumn("__ok", ok), rules)
    odd = (F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close", "high"))
    flag = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    counts = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("fetched"), flag(~F.col("__ok")).alias("rejected"), flag(F.col("__ok") & odd).alias("invalid"))
    good = rows.where("__ok")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    old = read_bars(spark, path) if there else spark.createDataFrame([], BARS)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    totals = ("fetched", "rejected", "invalid", "added", "refreshed", "net", "files_changed", "files_unchanged")
    if dry_run:
        ends_ = old.groupBy(*KEY).agg(F.min("time").alias("lo"), F.max("time").alias("hi"))
        new = good.select(*KEY, "time").distinct().join(ends_, list(KEY), "left")
        outside = F.col("lo").isNull() | (F.col("time") < F.col("lo")) | (F.col("time") > F.col("hi"))
        found = new.groupBy(*KEY).agg(flag(outside).alias("added"), F.min(F.coalesce("lo", "time")).alias("first_time"), F.max(F.coalesce("hi", "time")).alias("last_time"))
        report = counts.join(found, list(KEY), "left").select(*KEY, *[zero(c) if c in ("fetched", "rejected", "invalid", "added") else F.lit(0).cast("long").alias(c) for c in totals if c != "net"], zero("added").alias("net"), "first_time", "last_time")
    else:
        # One row a period.
        touched = {(r.timeframe, r.period) for r in good.select("timeframe", "period").distinct().collect()}
        part = F.lit(False)
        for timeframe in {t for t, _ in touched}:
            part = part | (F.col("timeframe") == timeframe) & F.col("period").isin(*[p for t, p in touched if t == timeframe])
        schema = T.StructType([*BARS.fields, T.StructField("period", T.StringType())])
        stored = spark.read.schema(schema).parquet(path).where(part) if there else old
        seen = Observation("merge")
        merged = with_period(merge_bars(stored.select(*BARS.names), good, seq), rules)
        merged = merged.observe(seen, flag(F.col("origin").isin("added", "refreshed")).alias("changed"))
        scratch = new_folder(spark, "merge")
        merged.write.parquet(scratch)
        merged = spark.read.schema(merged.schema).parquet(scratch)
        if seen.get["changed"]:
            new = merged.where(F.col("origin").isin("added", "refreshed")).select("timeframe", "period").distinct()
            write_bars(merged.join(F.broadcast(new), ["timeframe", "period"], "left_semi").select(*BARS.names), path, rules)
        came = good.select(*KEY, "period").distinct().withColumn("came", F.lit(True))
        each = merged.groupBy(*KEY, "period").agg(flag(F.col("origin") == "added").alias("added"), flag(F.col("origin") == "refreshed").alias("refreshed"))
        each = each.join(came, [*KEY, "period"]).groupBy(*KEY).agg(
            F.sum("added").alias("added"), F.sum("refreshed").alias("refreshed"), flag(F.col("added") + F.col("refreshed") > 0).alias("files_changed"), flag(F.col("added") + F.col("refreshed") == 0).alias("files_unchanged")
        )
        now = read_bars(spark, path).groupBy(*KEY).agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"))
        report = counts.join(each, list(KEY), "left").join(now, list(KEY), "left").select(*KEY, *[zero("added").alias(c) if c == "net" else zero(c) for c in totals], "first_time", "last_time")
    whole = report.agg(*[F.sum(c).alias(c) for c in totals], F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))
    none = [F.lit(None).cast("string").alias(c) for c in KEY]
    return report.unionByName(whole.select(*none, *totals, "first_time", "last_time"))


def parse_raw_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Bars of JSON arrays [time, open, close, high, low, volume, turnover?] in text or numbers, in `payload` with symbol and timeframe.

    Milliseconds become seconds; `ok` is false for rows of fewer than six fields or with something that is no number.
    """
    cells = F.from_json(F.col(payload), T.ArrayType(T.StringType()))
    rows = raw.withColumn("__c", cells)
    number = [F.get(F.col("__c"), F.lit(i)).try_cast("double") for i in range(7)]
    time = F.get(F.col("__c"), F.lit(0)).try_cast("long")
    ok = (F.coalesce(F.size("__c"), F.lit(0)) >= 6) & time.isNotNull()
    for i in range(1, 6):
        ok = ok & number[i].isNotNull()
    return rows.select(
        *KEY, F.when(time > 100_000_000_000, F.expr("try_cast(get(__c, 0) AS bigint) div 1000")).otherwise(time).alias("time"),
        number[1].alias("open"), number[3].alias("high"), number[4].alias("low"), number[2].alias("close"), number[5].alias("volume"),
        F.coalesce(number[6], F.lit(0.0)).alias("turnover"), F.coalesce(ok, F.lit(False)).alias("ok"),
    )


def resample(ticks: DataFrame, timeframe: str, price: str = "price", amount: str | None = None, order: tuple[str, ...] = ("time",)) -> DataFrame:
    """Bars of ticks (symbol, time, price): volume counts amount or ticks, turnover sums price * amount; ties in time go by `order`.

    One shuffle by symbol and bar, with the extremes pre-aggregated on the map side.
    """
    size = F.col(amount) if amount else F.lit(1.0)
    place = F.struct(*order)
    return ticks.groupBy("symbol", align(F.col("time"), timeframe).alias("time")).agg(
        F.min_by(price, place).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, place).alias("close"),
        F.sum(size).alias("volume"), F.sum(F.col(price) * size).alias("turnover"),
    ).select("symbol", F.lit(timeframe).alias("timeframe"), "time", *PRICES, "turnover")


def coarser(bars: DataFrame, timeframe: str) -> DataFrame:
    """Bars of a coarser grid: first open, highest high, lowest low, last close, summed volume and turnover."""
    return bars.groupBy("symbol", align(F.col("time"), timeframe).alias("bar")).agg(
        F.min_by("open", "time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "time").alias("close"),
        F.sum("volume").alias("volume"), F.sum("turnover").alias("turnover"),
    ).select("symbol", F.lit(timeframe).alias("timeframe"), F.col("bar").alias("time"), *PRICES, "turnover")


def synthetic_bars(closes: DataFrame) -> DataFrame:
    """Bars of (symbol, timeframe, time, close): each opens at the close before, the first at its own."""
    before = F.coalesce(F.lag("close").over(in_order()), F.col("close"))
    return closes.select(
        *KEY, "time", before.alias("open"), F.greatest(before, "close").alias("high"), F.least(before, "close").alias("low"), "close",
        F.lit(1.0).alias("volume"), F.col("close").alias("turnover"),
    )


def write_table(rows: DataFrame, path: str, kind: str = "csv") -> None:
    """A result as CSV with a header or as JSON lines."""
    writer = rows.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)
