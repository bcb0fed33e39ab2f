"""Bars derived from the star-schema tables: a line item is a trade of its part, an event a tick of its type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.timegrid import align
from barloom.sources.bars import in_order, resample

GRIDS = {"1d": 86_400, "1w": 604_800, "6h": 21_600}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, time, ts, event_id, price) of events of a positive value."""
    rows = table(spark, sf_dir, "events").where("value > 0")
    ts = F.col("ts").cast("timestamp")
    return rows.select(F.col("event_type").alias("symbol"), ts.cast("long").alias("time"), ts.alias("ts"), "event_id", F.col("value").alias("price"))


def event_bars(spark: SparkSession, sf_dir: str, timeframe: str = "6h") -> DataFrame:
    return resample(ticks(spark, sf_dir), timeframe, order=("ts", "event_id"))


EVENT_SQL = """
ticks AS (SELECT event_type AS symbol, ts, CAST(floor(epoch(ts)) AS BIGINT) AS time, event_id, value AS price FROM events WHERE value > 0),
bars AS (SELECT symbol, '6h' AS timeframe, time // 21600 * 21600 AS time, arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low,
                arg_max(price, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume, sum(price) AS turnover
         FROM ticks GROUP BY symbol, time // 21600 * 21600)"""


def trade_bars(spark: SparkSession, sf_dir: str, key: str = "p_type", timeframe: str = "1w") -> DataFrame:
    """Bars of line items by a column: the close is the volume-weighted price, the open the close before.

    Amounts are summed as whole cents and units, so a close doesn't depend on the order of the rows.
    """
    items = table(spark, sf_dir, "lineitem")
    if key.startswith("p_"):
        items = items.join(table(spark, sf_dir, "part").select("p_partkey", key), F.col("l_partkey") == F.col("p_partkey"))
    time = align(F.col("l_shipdate").cast("timestamp").cast("long"), timeframe)
    price = F.col("l_extendedprice") / F.col("l_quantity")
    sums = items.groupBy(F.col(key).cast("string").alias("symbol"), time.alias("time")).agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"), F.sum(F.col("l_quantity").cast("long")).alias("units"),
        F.max(price).alias("hi"), F.min(price).alias("lo"),
    )
    rows = sums.select("symbol", F.lit(timeframe).alias("timeframe"), "time", "hi", "lo", (F.col("cents") / (F.col("units") * 100)).alias("close"), "units", "cents")
    rows = rows.withColumn("open", F.coalesce(F.lag("close").over(in_order()), F.col("close")))
    return rows.select(
        "symbol", "timeframe", "time", "open", F.greatest("hi", "open", "close").alias("high"), F.least("lo", "open", "close").alias("low"), "close",
        F.col("units").cast("double").alias("volume"), (F.col("cents") / 100).alias("turnover"),
    )


def trade_sql(key: str = "p_type", timeframe: str = "1w") -> str:
    """The same bars as a list of common table expressions, the last one named bars."""
    step = GRIDS[timeframe]
    join = "JOIN part ON l_partkey = p_partkey" if key.startswith("p_") else ""
    return f"""
sums AS (SELECT {key} AS symbol, CAST(floor(epoch(l_shipdate)) AS BIGINT) // {step} * {step} AS time, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
                CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units, max(l_extendedprice / l_quantity) AS hi, min(l_extendedprice / l_quantity) AS lo
         FROM lineitem {join} GROUP BY 1, 2),
closes AS (SELECT symbol, time, hi, lo, CAST(cents AS DOUBLE) / CAST(units * 100 AS DOUBLE) AS close, units, cents FROM sums),
opens AS (SELECT *, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY time), close) AS open FROM closes),
bars AS (SELECT symbol, '{timeframe}' AS timeframe, time, open, greatest(hi, open, close) AS high, least(lo, open, close) AS low, close,
                CAST(units AS DOUBLE) AS volume, CAST(cents AS DOUBLE) / 100 AS turnover FROM opens)"""


def dirty(bars: DataFrame) -> DataFrame:
    """bars with faults by rule, in an order `seq`: each 97th has high and low swapped, each 101st comes twice, each 103rd is a second late."""
    place = F.row_number().over(in_order())
    rows = bars.withColumn("n", place)
    swap = F.col("n") % 97 == 0
    rows = rows.withColumn("__h", F.col("high")).withColumn("high", F.when(swap, F.col("low")).otherwise(F.col("high")))
    rows = rows.withColumn("low", F.when(swap, F.col("__h")).otherwise(F.col("low"))).drop("__h")
    rows = rows.withColumn("time", F.col("time") + (F.col("n") % 103 == 0).cast("long"))
    rows = rows.withColumn("copy", F.explode(F.when(F.col("n") % 101 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.withColumn("seq", F.col("n") * 2 + F.col("copy")).drop("n", "copy")


DIRTY_SQL = """
numbered AS (SELECT *, row_number() OVER (PARTITION BY symbol, timeframe ORDER BY time) AS n FROM bars),
dirty AS (SELECT symbol, timeframe, time + CASE WHEN n % 103 = 0 THEN 1 ELSE 0 END AS time, open, CASE WHEN n % 97 = 0 THEN low ELSE high END AS high,
                 CASE WHEN n % 97 = 0 THEN high ELSE low END AS low, close, volume, turnover, n * 2 + copy AS seq
          FROM numbered, (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR n % 101 = 0)"""
