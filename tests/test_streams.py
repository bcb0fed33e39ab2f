"""Streams read in pieces give what a batch gives."""

from pyspark.sql import functions as F

from barloom.operators.folds import ema_of
from barloom.sources.bars import BARS
from barloom.streaming.streams import index_sink, latest, stored, stream_bars, upsert

TICK = "symbol string, ts timestamp, event_id long, price double"


def test_bars_come_once_and_replays_change_nothing(spark, tmp_path):
    rows = [("A", 1_700_000_000 + 600 * i, i, 1.0 + i % 7) for i in range(200)]
    ticks = spark.createDataFrame(rows, "symbol string, t long, event_id long, price double").select("symbol", F.timestamp_seconds("t").alias("ts"), "event_id", "price")
    for part, (lo, hi) in enumerate(((0, 80), (60, 140), (140, 200))):
        ticks.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        del part
    stream = spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").dropDuplicates(["event_id"])
    out = stream_bars(stream, "1h", "10 days", order=("ts", "event_id"))
    out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    assert spark.read.schema(out.schema).parquet(f"{tmp_path}/out").count() == 0  # nothing is final within ten days
    sink = upsert(f"{tmp_path}/bars")
    one = spark.createDataFrame([("A", "1h", 0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], BARS)
    two = one.withColumn("close", F.lit(2.0)).unionByName(one.withColumn("time", F.lit(3600).cast("long")))
    for batch, n in ((one, 0), (two, 1), (two, 1)):
        sink(batch, n)
    assert sorted((r.time, r.close) for r in stored(spark, f"{tmp_path}/bars").collect()) == [(0, 2.0), (3600, 1.0)]


def test_an_upsert_writes_the_periods_that_it_touches_and_no_others(spark, tmp_path):
    from barloom.streaming.streams import stored

    year = 366 * 86_400
    row = lambda t, c, s="A": (s, "1d", t, c, c, c, c, 1.0, c)
    sink = upsert(f"{tmp_path}/bars")
    sink(spark.createDataFrame([row(0, 1.0), row(year, 2.0), row(0, 9.0, "B")], BARS), 0)
    sink(spark.createDataFrame([row(year, 3.0), row(year + 86_400, 4.0)], BARS), 1)
    assert sorted(p.name for p in (tmp_path / "bars" / "batch=1" / "timeframe=1d").iterdir()) == ["period=1971"]
    sink(spark.createDataFrame([row(0, 5.0)], BARS), 2)
    for _ in range(2):  # the second time a batch is replayed
        got = sorted((r.symbol, r.time, r.close) for r in stored(spark, f"{tmp_path}/bars").collect())
        assert got == [("A", 0, 5.0), ("A", year, 3.0), ("A", year + 86_400, 4.0), ("B", 0, 9.0)]
        sink(spark.createDataFrame([row(0, 5.0)], BARS), 2)
    half = tmp_path / "bars" / "batch=3"
    half.mkdir()
    assert stored(spark, f"{tmp_path}/bars").count() == 4 and stored(spark, f"{tmp_path}/none").count() == 0


def test_what_was_replaced_is_deleted_after_a_while(spark, tmp_path):
    year = 366 * 86_400
    row = lambda t, c, s="A": (s, "1d", t, c, c, c, c, 1.0, c)
    sink = upsert(f"{tmp_path}/bars", keep=2)
    for n in range(6):
        sink(spark.createDataFrame([row(0, float(n))] + ([row(year, 7.0)] if n == 1 else []), BARS), n)
    left = sorted(p.relative_to(tmp_path / "bars").as_posix() for p in (tmp_path / "bars").glob("batch=*/timeframe=*/period=*"))
    # the first year of batch 3 was replaced by 4, which is later than two batches ago; the second year has no other copy
    assert left == ["batch=1/timeframe=1d/period=1971"] + [f"batch={n}/timeframe=1d/period=1970" for n in (3, 4, 5)]
    assert sorted(p.name for p in (tmp_path / "bars").iterdir()) == ["batch=1", "batch=3", "batch=4", "batch=5"]
    for _ in range(2):
        assert sorted((r.time, r.close) for r in stored(spark, f"{tmp_path}/bars").collect()) == [(0, 5.0), (year, 7.0)]
        sink(spark.createDataFrame([row(0, 5.0)], BARS), 5)


def test_an_index_table_holds_each_keys_newest_row(spark, tmp_path):
    sink = index_sink(f"{tmp_path}/index", ["symbol"], keep=1)
    some = lambda *rows: spark.createDataFrame(rows, "symbol string, last double")
    for n, rows in enumerate(([("A", 1.0), ("B", 1.0)], [("B", 2.0)], [("C", 3.0)], [("A", 4.0)], [("A", 4.0)])):
        sink(some(*rows), min(n, 3))
    assert sorted(map(tuple, latest(spark, f"{tmp_path}/index").collect())) == [("A", 4.0), ("B", 2.0), ("C", 3.0)]
    assert sorted(p.name for p in (tmp_path / "index").iterdir()) == ["batch=2", "batch=3"]


def test_reversion_state_matches_the_rule(spark):
    import random

    import pandas as pd

    from barloom.operators.signals import signal
    from barloom.streaming.streams import _Reversion

    rng = random.Random(2)
    closes = [100.0]
    for _ in range(120):
        closes.append(closes[-1] * (1 + rng.uniform(-0.04, 0.04)))
    bars = spark.createDataFrame([("A", "1d", i, c, c, c, c, 1.0, c) for i, c in enumerate(closes)], BARS)
    want = [r.target for r in signal(bars, "rsi-rev").orderBy("time").collect()]

    def run(stop):
        model, got = _Reversion(2, 10, 50, 10, stop), []
        model.state = Held()
        for lo, hi in ((0, 1), (1, 40), (30, 90), (90, 121)):
            got += pd.concat(list(model.handleInputRows(("A", "1d"), iter([pd.DataFrame({"time": range(lo, hi), "close": closes[lo:hi]})]), None)))["target"].tolist()
        return got

    assert run(0.0) == want and sum(want) > 5
    assert sum(run(0.001)) < sum(want)


class Held:
    """A state that is kept in place."""

    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_trend_state_matches_the_batch_recurrence():
    import pandas as pd

    from barloom.streaming.streams import _Trend

    walk = [1.0, 3.0, 2.0, 5.0, 4.0, 6.0, 2.0]
    model = _Trend(3)
    model.state = Held()
    got = []
    for lo, hi in ((0, 2), (1, 5), (5, 7)):  # the second batch repeats a bar
        frame = pd.DataFrame({"time": range(lo, hi), "close": walk[lo:hi]})
        got += pd.concat(list(model.handleInputRows(("A", "1h"), iter([frame]), None)))["ema"].tolist()
    assert [None if x != x else x for x in got] == ema_of(walk, 3)
