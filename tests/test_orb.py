"""The study against a tick-by-tick loop, on the driver data and on
hand-written days that each pin one rule."""

import datetime as dt
from collections import defaultdict
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from scalar_study import day_result
from tickline.operators.clean import clean_ticks
from tickline.operators.orb import OrbParams, Study, prices
from tickline.plans.oracle_study import DRIVER_PARAMS
from tickline.sources.fixture import tick_view

ET = ZoneInfo("America/New_York")
FIELDS = ["direction", "or_high", "or_low", "or_width", "daily_high", "daily_low", "mfe", "mae",
          "s1_vol_pnl", "s1_vol_trig", "s2_short_pnl", "s2_short_trig", "s3_fade_pnl", "s3_fade_trig",
          "s4_time_pnl", "s4_time_trig", "s5_master_pnl", "s5_master_trig", "s0_base_pnl"]


def scalar_trades(ticks_df, p):
    px = prices(ticks_df, p).select("contract", "session_date", "et", "record_no", "price").collect()
    days = defaultdict(list)
    for r in px:
        days[(r.contract, r.session_date)].append((r.et, r.record_no, r.price))
    out = {}
    for key, rows in days.items():
        res = day_result(rows, p)
        if res is not None and res["direction"] is not None:
            out[key] = res
    return out


def spark_trades(ticks_df, p):
    rows = Study(ticks_df, p).trades_all().collect()
    return {(r.contract, r.date): r.asDict() for r in rows}


def assert_same(spark_rows, scalar_rows):
    assert set(spark_rows) == set(scalar_rows)
    for k, want in scalar_rows.items():
        got = spark_rows[k]
        for f in FIELDS:
            assert got[f] == want[f], (k, f, got[f], want[f])


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_driver_data_matches_loop(spark, sf):
    ticks = clean_ticks(tick_view(spark, sf)).withColumn("contract", F.lit("ES"))
    assert_same(spark_trades(ticks, DRIVER_PARAMS), scalar_trades(ticks, DRIVER_PARAMS))


def test_driver_data_other_or_lengths(spark):
    ticks = clean_ticks(tick_view(spark, "/root/testdata/sf0.001")).withColumn("contract", F.lit("ES"))
    for minutes in (5, 45):
        p = OrbParams(or_seconds=minutes * 60)
        assert_same(spark_trades(ticks, p), scalar_trades(ticks, p))


# --------------------------------------------------------------------------
# hand-written days, true 30-second opening range
# --------------------------------------------------------------------------
def _ticks(spark, days):
    rows, rec = [], 0
    for name, date, seq in days:
        for wall, price in seq:
            h, m, s = wall.split(":")
            sec = float(s)
            local = dt.datetime(date.year, date.month, date.day, int(h), int(m), int(sec),
                                int(round((sec - int(sec)) * 1e6)), tzinfo=ET)
            utc = local.astimezone(dt.timezone.utc).replace(tzinfo=None)
            rows.append((name, utc, rec, float(price)))
            rec += 1
    df = spark.createDataFrame(rows, "contract string, datetime timestamp_ntz, record_no long, price double")
    return df.withColumn("datetime", F.col("datetime").cast("timestamp"))


D = dt.date(2024, 3, 5)
CASES = [
    ("up", D, [("09:30:00", 100), ("09:30:10", 102), ("09:30:30", 99), ("09:31:00", 102.25), ("09:40:00", 117.5)]),
    ("down", D, [("09:30:00", 100), ("09:30:20", 101), ("09:35:00", 99.75), ("09:36:00", 84.5)]),
    ("tie", D, [("09:30:00", 100), ("09:30:05", 101), ("09:32:00", 101.5), ("09:32:00", 99.5), ("15:00:00", 100)]),
    ("inside", D, [("09:30:00", 100), ("09:30:05", 101), ("10:00:00", 100.5), ("15:59:59", 100)]),
    ("no_or", D, [("09:29:59", 100), ("09:31:00", 101), ("10:00:00", 103)]),
    ("single", D, [("09:30:00", 100)]),
    ("edges", D, [("09:30:30", 100), ("09:30:00", 101), ("09:45:00", 101.5), ("16:00:00", 104), ("16:00:01", 200)]),
    ("t_then_s", D, [("09:30:00", 100), ("09:31:00", 100.25), ("09:40:00", 116), ("09:50:00", 84)]),
    ("s_then_t", D, [("09:30:00", 100), ("09:31:00", 100.25), ("09:40:00", 84), ("09:50:00", 116)]),
    ("neither", D, [("09:30:00", 100), ("09:31:00", 101), ("12:00:00", 108)]),
    ("stop_and_time", D, [("09:30:00", 100), ("09:31:00", 100.25), ("11:30:00", 74.5)]),
    ("late_time_stop", D, [("09:30:00", 100), ("09:31:00", 100.25), ("11:00:00", 110), ("13:45:00", 103)]),
    ("short_no_buffer", D, [("09:30:00", 100), ("09:30:02", 101), ("09:33:00", 99.5), ("12:00:00", 98.5)]),
    ("fade_stopped", D, [("09:30:00", 100), ("09:30:01", 101), ("09:31:00", 101.5), ("10:05:00", 110),
                         ("10:10:00", 104.5), ("10:20:00", 112.5)]),
    ("fade_target", D, [("09:30:00", 100), ("09:30:01", 101), ("09:31:00", 101.5), ("10:05:00", 120),
                        ("10:10:00", 114), ("10:30:00", 98)]),
    ("fade_early", D, [("09:30:00", 100), ("09:30:01", 101), ("09:31:00", 101.5), ("09:40:00", 110),
                       ("09:50:00", 104.5), ("15:00:00", 106)]),
    ("dst_before", dt.date(2024, 3, 8), [("09:30:00", 100), ("09:30:20", 101), ("09:45:00", 101.5), ("11:45:00", 102)]),
    ("dst_after", dt.date(2024, 3, 11), [("09:30:00", 100), ("09:30:20", 101), ("09:45:00", 99.5), ("11:45:00", 99)]),
]


@pytest.fixture(scope="module")
def hand(spark):
    df = _ticks(spark, CASES)
    p = OrbParams()
    return spark_trades(df, p), scalar_trades(df, p), Study(df, p).summary().collect()


def test_hand_days_match_loop(hand):
    got, want, _ = hand
    assert_same(got, want)


def test_hand_day_rules(hand):
    got, _, summary = hand
    by = {k[0]: v for k, v in got.items()}
    labels = {r.contract: r.direction for r in summary}
    assert by["up"]["direction"] == "Long" and by["down"]["direction"] == "Short"
    assert by["tie"]["direction"] == "Short"                      # same timestamp -> Short
    assert labels["inside"] == "Inside" and "inside" not in by    # listed, not traded
    assert "no_or" not in labels and "single" not in labels       # skipped days
    assert by["edges"]["or_high"] == 101 and by["edges"]["or_low"] == 100  # 09:30:30 in the OR
    assert by["edges"]["daily_high"] == 104                       # 16:00:00 included, 16:00:01 not
    assert by["t_then_s"]["s1_vol_pnl"] == 15.0 and by["s_then_t"]["s1_vol_pnl"] == -15.0
    assert by["neither"]["s1_vol_pnl"] == 108 - 100                # last price, entry = OR high 100
    assert by["stop_and_time"]["s4_time_pnl"] == -25.0           # stop wins over the time stop
    assert by["late_time_stop"]["s4_time_pnl"] == 103 - 100       # first tick after 11:30 under +5
    assert by["short_no_buffer"]["s2_short_trig"] is False
    assert by["fade_stopped"]["s3_fade_trig"] and by["fade_stopped"]["s3_fade_pnl"] == 104.5 - 112.0
    assert by["fade_target"]["s3_fade_pnl"] == 15.0
    assert by["fade_early"]["s3_fade_trig"] is False               # before 10:00
    assert by["dst_before"]["direction"] == "Long" and by["dst_after"]["direction"] == "Short"
