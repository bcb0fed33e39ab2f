"""Every registered query runs; those with SQL agree with it."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
HEAVY = ("op", "pipeline")


def con():
    db = duckdb.connect()
    for f in os.listdir(SF):
        db.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return db


def test_every_oracle_names_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 150


#: One of each kind, and those whose SQL is a walk; all of them are compared by the driver.
SAMPLE = [
    "ag1_resample", "ag2_quality", "ag5_inventory", "sc8_merge", "sc10_csv", "sc11_json", "pf13_days", "wn7_volatility", "wn14_decisions", "sg5_breakout_hold", "sg6_rsi_rev_ls", "sg7_tsmom_ls",
    "sg9_voltarget_tsmom", "sg10_volfilter_tsmom", "sg11_stops_sma", "sg11_voltarget_stops", "eq1_curve_sma", "eq8_trades", "eq13_overlay", "ag8_performance", "xs8_targeted_book", "xs10_book_gated", "rp6_gated_book",
    "wf1_splits", "wf5_stitched", "rg2_recorded", "rg5_trade_tables", "rg9_nested", "se2_union", "ag25_ingest_report", "ag20_screen", "wn3_macd", "wn4_rsi", "st1_stream_bars", "st4_upsert", "st5_corrected", "st8_watch", "entry",
]


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_agrees_with_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = con().execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(r[names.index(c)] for c in sorted(names)) for r in cursor.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
