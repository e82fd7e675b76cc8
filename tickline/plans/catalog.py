"""Registered queries and their DuckDB oracles.

Every query reads the driver's tables through the tick view over ``events``
(``tickline.sources.fixture``), runs over the whole table, and returns a
DataFrame.  ``ORACLES`` holds the same computation written independently in
ANSI SQL for DuckDB (window functions / row numbers instead of the Spark
plans' set formulation), over the same parquet views.

Column conventions shared by both sides: timestamps leave as
``timestamp_ntz`` (UTC wall clock) to match DuckDB's ``TIMESTAMP``; integer
sums are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.context import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return wall_clock(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def wall_clock(df: DataFrame) -> DataFrame:
    """UTC instants -> ``timestamp_ntz`` holding the UTC wall clock."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


# ---------------------------------------------------------------------------
# The tick view in DuckDB SQL (same definition as sources/fixture.py).
# ---------------------------------------------------------------------------
TICKS_SQL = """
ticks AS (
  SELECT
    ts AS datetime,
    epoch_us(ts) + 2209161600000000 AS raw_time,
    CASE WHEN event_id % 10 = 3 THEN CAST('-19990009513251226345509817234554355712.0' AS DOUBLE)
         WHEN event_id % 10 = 7 THEN CAST('-19990019654456028171345029208179998720.0' AS DOUBLE)
         ELSE CAST(0.0 AS DOUBLE) END AS open,
    px + CAST(0.25 AS DOUBLE) AS high,
    px - CAST(0.25 AS DOUBLE) AS low,
    px AS close,
    CAST(1 AS BIGINT) AS num_trades,
    CAST(1 + event_id % 5 AS BIGINT) AS volume,
    CAST(CASE WHEN event_id % 2 = 0 THEN 1 + event_id % 5 ELSE 0 END AS BIGINT) AS bid_volume,
    CAST(CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 + event_id % 5 END AS BIGINT) AS ask_volume,
    CASE WHEN user_id % 2 = 0 THEN 'ESH24' ELSE 'ESM24' END AS contract,
    CAST(event_id AS BIGINT) AS record_no
  FROM (
    SELECT *,
      CAST(5000.0 AS DOUBLE)
        + CAST(0.25 AS DOUBLE) * CAST(abs((epoch_us(ts) // 60000000) % 400 - 200) AS DOUBLE)
        + CAST(0.25 AS DOUBLE) * floor(CAST(value AS DOUBLE) / CAST(50.0 AS DOUBLE)) AS px
    FROM events
  ) e
)"""


def with_ticks(body: str, *ctes: str) -> str:
    parts = [TICKS_SQL] + [c for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _ticks(spark, sf_dir):
    from tickline.sources.fixture import tick_view
    return tick_view(spark, sf_dir)


# ---------------------------------------------------------------------------
# 2.4 bars
# ---------------------------------------------------------------------------
@register("bars_1min_all", with_ticks("""
SELECT date_trunc('minute', datetime) AS candle_time,
       arg_min(close, raw_time) AS open,
       max(high) AS high,
       min(low) AS low,
       arg_max(close, raw_time) AS close,
       CAST(sum(volume) AS BIGINT) AS volume,
       CAST(sum(num_trades) AS BIGINT) AS trades
FROM ticks GROUP BY 1"""))
def q_bars_1min_all(spark, sf_dir):
    """1-minute bars over every tick (the SQL view's semantics)."""
    from tickline.operators.bars import bars_all
    return bars_all(_ticks(spark, sf_dir))


# ---------------------------------------------------------------------------
# 2.5 the opening-range study
# ---------------------------------------------------------------------------
from tickline.plans.oracle_study import DRIVER_PARAMS, study_ctes  # noqa: E402

STUDY_KEYS = "contract, date"


def study_sql(body: str) -> str:
    return with_ticks(body, *study_ctes(DRIVER_PARAMS))


def _study(spark, sf_dir):
    from tickline.operators.clean import clean_ticks
    from tickline.operators.orb import Study
    ticks = clean_ticks(_ticks(spark, sf_dir)).withColumn("contract", F.lit("ES"))
    return Study(ticks, DRIVER_PARAMS)


TRADE_SELECT = ("contract, date, direction, or_high, or_low, or_width, daily_high, daily_low, mfe, mae, "
                "s1_vol_pnl, s1_vol_trig, s2_short_pnl, s2_short_trig, s3_fade_pnl, s3_fade_trig, "
                "s4_time_pnl, s4_time_trig, s5_master_pnl, s5_master_trig")


@register("trade_results", study_sql(f"SELECT {TRADE_SELECT} FROM final"))
def q_trade_results(spark, sf_dir):
    """Full trade table: one row per day with a breakout."""
    return _study(spark, sf_dir).trades()


@register("session_levels", study_sql("""
SELECT d.contract, d.session_date AS date, c.n_day, c.n_or, d.or_high, d.or_low,
       d.or_high - d.or_low AS or_width, d.daily_high, d.daily_low
FROM days d JOIN (
  SELECT contract, session_date, count(*) AS n_day,
         count(*) FILTER (WHERE tod >= {S} AND tod <= {ORE}) AS n_or
  FROM px2 GROUP BY ALL) c USING (contract, session_date)""".format(
    S=DRIVER_PARAMS.t_start, ORE=DRIVER_PARAMS.t_or_end)))
def q_session_levels(spark, sf_dir):
    lv = _study(spark, sf_dir).levels.df
    return lv.select("contract", F.col("session_date").alias("date"), "n_day", "n_or",
                     "or_high", "or_low", "or_width", "daily_high", "daily_low")


@register("session_slices", study_sql("""
SELECT x.contract, x.session_date AS date, x.et, x.record_no, x.price,
       (x.tod >= {S} AND x.tod <= {ORE}) AS in_or,
       (x.tod >= {S} AND x.tod <= {E}) AS in_rth,
       (x.tod > {ORE} AND x.tod <= {E}) AS post_or
FROM px2 x SEMI JOIN days d ON x.contract = d.contract AND x.session_date = d.session_date""".format(
    S=DRIVER_PARAMS.t_start, ORE=DRIVER_PARAMS.t_or_end, E=DRIVER_PARAMS.t_end)))
def q_session_slices(spark, sf_dir):
    s = _study(spark, sf_dir).slices()
    return s.select("contract", F.col("session_date").alias("date"), "et", "record_no", "price",
                    "in_or", "in_rth", "post_or")


@register("first_breakout", study_sql("""
SELECT contract, session_date AS date, direction,
       CASE WHEN direction = 'Long' THEN t_up WHEN direction = 'Short' THEN t_down END AS entry_time,
       CASE WHEN direction = 'Long' THEN or_high WHEN direction = 'Short' THEN or_low END AS entry_price
FROM dirs"""))
def q_first_breakout(spark, sf_dir):
    b = _study(spark, sf_dir).breakout.df
    return b.select("contract", F.col("session_date").alias("date"), "direction", "entry_time", "entry_price")


@register("trade_path", study_sql("""
SELECT contract, session_date AS date, et, record_no, price, direction FROM path"""))
def q_trade_path(spark, sf_dir):
    s = _study(spark, sf_dir)
    return s.path.select("contract", F.col("session_date").alias("date"), "et", "record_no", "price", "direction")


@register("mfe_mae", study_sql("SELECT contract, date, direction, mfe, mae FROM final"))
def q_mfe_mae(spark, sf_dir):
    return _study(spark, sf_dir).trades_of("contract", "date", "direction", "mfe", "mae")


@register("strategy_s0", study_sql("SELECT contract, date, s0_base_pnl, TRUE AS s0_base_trig FROM results"))
def q_strategy_s0(spark, sf_dir):
    """Documented-only baseline: unfiltered 30/25 first touch, no time stop."""
    return _study(spark, sf_dir).trades_of("contract", "date", "s0_base_pnl", "s0_base_trig")


def _strategy_query(prefix):
    def q(spark, sf_dir):
        return _study(spark, sf_dir).trades_of("contract", "date", f"{prefix}_pnl", f"{prefix}_trig")
    return q


for _n, _prefix in [("strategy_s1", "s1_vol"), ("strategy_s2", "s2_short"), ("strategy_s3", "s3_fade"),
                    ("strategy_s4", "s4_time"), ("strategy_s5", "s5_master")]:
    register(_n, study_sql(f"SELECT contract, date, {_prefix}_pnl, {_prefix}_trig FROM final"))(
        _strategy_query(_prefix))


@register("session_summary", study_sql("""
SELECT contract, session_date AS date, coalesce(direction, 'Inside') AS direction,
       or_high, or_low, or_width, daily_high, daily_low,
       printf('%7.2f / %-7.2f', or_high, or_low) AS or_levels,
       printf('%7.2f / %-7.2f', daily_high, daily_low) AS day_levels
FROM dirs"""))
def q_session_summary(spark, sf_dir):
    return _study(spark, sf_dir).summary()


RISK_SQL = """
SELECT direction, target, count(*) AS trades,
       count(*) FILTER (WHERE mfe >= target) AS winners,
       (CAST(count(*) FILTER (WHERE mfe >= target) AS DOUBLE) / count(*)) * 100.0 AS win_rate,
       avg(mae) FILTER (WHERE mfe >= target) AS avg_mae,
       quantile_cont(mae, 0.9) FILTER (WHERE mfe >= target) AS p90_mae
FROM final, (SELECT unnest([4.0, 7.5, 10.0, 15.0, 20.0]) AS target) t
GROUP BY direction, target"""


@register("risk_by_target", study_sql(RISK_SQL))
def q_risk_by_target(spark, sf_dir):
    from tickline.operators.reports import risk_by_target
    return risk_by_target(_study(spark, sf_dir).trades_of("direction", "mfe", "mae"), DRIVER_PARAMS.targets)


COMPARE_SQL = """
SELECT strategy,
  CASE WHEN count(*) FILTER (WHERE trig) > 0
       THEN (CAST(count(*) FILTER (WHERE trig AND pnl > 0) AS DOUBLE) / count(*) FILTER (WHERE trig)) * 100.0 END AS win_rate,
  CASE WHEN count(*) FILTER (WHERE trig) > 0 THEN sum(pnl) FILTER (WHERE trig) END AS total_pts,
  CASE WHEN count(*) FILTER (WHERE trig) > 0
       THEN sum(pnl) FILTER (WHERE trig) / count(*) FILTER (WHERE trig) END AS avg_trade,
  count(*) FILTER (WHERE trig) AS n
FROM (
  SELECT 'S1: Vol Filter (<5pt)' AS strategy, s1_vol_pnl AS pnl, s1_vol_trig AS trig FROM final
  UNION ALL SELECT 'S2: Short Bias (30/20)', s2_short_pnl, s2_short_trig FROM final
  UNION ALL SELECT 'S3: Peak Fade (15/15)', s3_fade_pnl, s3_fade_trig FROM final
  UNION ALL SELECT 'S4: Time Exit (11:30)', s4_time_pnl, s4_time_trig FROM final
  UNION ALL SELECT 'S5: Master (S1 + S4)', s5_master_pnl, s5_master_trig FROM final) u
GROUP BY strategy"""


@register("strategy_comparison", study_sql(COMPARE_SQL))
def q_strategy_comparison(spark, sf_dir):
    from tickline.operators.reports import strategy_comparison
    return strategy_comparison(_study(spark, sf_dir).trades())


# ---------------------------------------------------------------------------
# 2.2 projections, filters and scalar expressions
# ---------------------------------------------------------------------------
from tickline.functions import expr as X  # noqa: E402

EPOCH = 2209161600000000
EASTERN_SQL = "((datetime AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"


@register("raw_to_timestamp", with_ticks(
    f"SELECT raw_time, make_timestamp(raw_time - {EPOCH}) AS time_from_raw FROM ticks"))
def q_raw_to_timestamp(spark, sf_dir):
    return _ticks(spark, sf_dir).select("raw_time", X.raw_to_timestamp("raw_time").alias("time_from_raw"))


@register("timestamp_to_raw", with_ticks(
    f"SELECT datetime, epoch_us(datetime) + {EPOCH} AS raw_from_time FROM ticks"))
def q_timestamp_to_raw(spark, sf_dir):
    return _ticks(spark, sf_dir).select("datetime", X.timestamp_to_raw("datetime").alias("raw_from_time"))


CONTRACT_FILES_SQL = """
files AS (
  SELECT DISTINCT 'C:\\Ticks\\Data\\' || contract || '_FUT_CME.scid' AS file FROM ticks
  UNION SELECT DISTINCT '/data/ticks/' || upper(e.event_type) || '_' || CAST(e.user_id AS VARCHAR) || '.scid'
        FROM events e)"""


@register("contract_from_file", with_ticks("""
SELECT file,
  CASE WHEN regexp_extract(stem, '^([A-Z]{2,3}[A-Z]\\d{2})', 1) <> ''
       THEN regexp_extract(stem, '^([A-Z]{2,3}[A-Z]\\d{2})', 1)
       ELSE split_part(stem, '_', 1) END AS contract_code
FROM (SELECT file, regexp_replace(regexp_extract(file, '([^/\\\\]*)$', 1), '(.)\\.[^.]*$', '\\1') AS stem FROM files)""",
    CONTRACT_FILES_SQL))
def q_contract_from_file(spark, sf_dir):
    from tickline.sources.fixture import events
    t = _ticks(spark, sf_dir)
    a = t.select(F.concat(F.lit("C:\\Ticks\\Data\\"), "contract", F.lit("_FUT_CME.scid")).alias("file"))
    ev = events(spark, sf_dir)
    b = ev.select(F.concat(F.lit("/data/ticks/"), F.upper("event_type"), F.lit("_"),
                           F.col("user_id").cast("string"), F.lit(".scid")).alias("file"))
    files = a.union(b).distinct()
    return files.select("file", X.contract_from_file("file").alias("contract_code"))


@register("classify_trade", with_ticks("""
SELECT raw_time, open,
  abs(open - CAST('-19990009513251226345509817234554355712.0' AS DOUBLE)) < 1e10 AS is_first_bundle,
  abs(open - CAST('-19990019654456028171345029208179998720.0' AS DOUBLE)) < 1e10 AS is_last_bundle,
  abs(open) < 1e10 AS is_regular_trade
FROM ticks"""))
def q_classify_trade(spark, sf_dir):
    from tickline.operators.clean import classify_trade
    return classify_trade(_ticks(spark, sf_dir)).select(
        "raw_time", "open", "is_first_bundle", "is_last_bundle", "is_regular_trade")


TICK_SELECT = ("datetime, raw_time, open, high, low, close, num_trades, volume, bid_volume, "
               "ask_volume, contract, record_no")


@register("drop_bundle_markers", with_ticks(f"SELECT {TICK_SELECT} FROM ticks WHERE abs(open) < 1e10"))
def q_drop_bundle_markers(spark, sf_dir):
    from tickline.operators.clean import drop_bundle_markers
    return drop_bundle_markers(_ticks(spark, sf_dir))


@register("scale_prices", with_ticks("""
SELECT raw_time, open * 0.01 AS open, high * 0.01 AS high, low * 0.01 AS low, close * 0.01 AS close
FROM ticks"""))
def q_scale_prices(spark, sf_dir):
    from tickline.operators.clean import scale_prices
    return scale_prices(_ticks(spark, sf_dir), 0.01).select("raw_time", "open", "high", "low", "close")


@register("repair_open", with_ticks("""
SELECT raw_time, CASE WHEN open = 0.0 THEN close ELSE open END AS open, close
FROM ticks WHERE abs(open) < 1e10"""))
def q_repair_open(spark, sf_dir):
    from tickline.operators.clean import drop_bundle_markers, repair_open
    return repair_open(drop_bundle_markers(_ticks(spark, sf_dir))).select("raw_time", "open", "close")


@register("minute_bucket", with_ticks(f"""
SELECT raw_time, raw_time // 60000000 AS minute_index,
       make_timestamp((raw_time // 60000000) * 60000000 - {EPOCH}) AS minute_start
FROM ticks"""))
def q_minute_bucket(spark, sf_dir):
    t = _ticks(spark, sf_dir).select("raw_time", X.minute_bucket("raw_time").alias("minute_index"))
    return t.withColumn("minute_start", X.bucket_to_timestamp("minute_index"))


@register("start_of_minute", with_ticks(
    "SELECT datetime, date_trunc('minute', datetime) AS candle_time FROM ticks"))
def q_start_of_minute(spark, sf_dir):
    return _ticks(spark, sf_dir).select("datetime", X.start_of_minute("datetime").alias("candle_time"))


@register("month_key", with_ticks("SELECT datetime, strftime(datetime, '%Y%m') AS month FROM ticks"))
def q_month_key(spark, sf_dir):
    return _ticks(spark, sf_dir).select("datetime", X.month_key("datetime").alias("month"))


@register("to_eastern", with_ticks(f"SELECT datetime, {EASTERN_SQL} AS et FROM ticks"))
def q_to_eastern(spark, sf_dir):
    return _ticks(spark, sf_dir).select("datetime", X.to_eastern("datetime").alias("et"))


@register("session_date", with_ticks(
    f"SELECT datetime, CAST({EASTERN_SQL} AS DATE) AS session_date FROM ticks"))
def q_session_date(spark, sf_dir):
    return _ticks(spark, sf_dir).select("datetime", X.session_date(X.to_eastern("datetime")).alias("session_date"))


@register("parse_config_date", with_ticks("""
SELECT d AS date_text, strptime(d, '%Y-%m-%d') AS parsed
FROM (SELECT DISTINCT strftime(datetime, '%Y-%m-%d') AS d FROM ticks
      UNION ALL SELECT CAST(NULL AS VARCHAR))"""))
def q_parse_config_date(spark, sf_dir):
    d = _ticks(spark, sf_dir).select(F.date_format("datetime", "yyyy-MM-dd").alias("date_text")).distinct()
    d = d.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("date_text")))
    return d.select("date_text", X.parse_config_date("date_text").alias("parsed"))


@register("standardize_ticks", with_ticks("SELECT datetime, close AS price, record_no FROM ticks"))
def q_standardize_ticks(spark, sf_dir):
    """An exported dataset named the other way (Timestamp / Close) read back
    into the study's columns."""
    from tickline.operators.clean import standardize_ticks
    exported = _ticks(spark, sf_dir).select(F.col("datetime").alias("Timestamp"),
                                             F.col("close").alias("Close"), "record_no")
    return standardize_ticks(exported).select("datetime", "price", "record_no")


@register("direction_label", study_sql(
    "SELECT contract, session_date AS date, coalesce(direction, 'Inside') AS label FROM dirs"))
def q_direction_label(spark, sf_dir):
    b = _study(spark, sf_dir).breakout.df
    return b.select("contract", F.col("session_date").alias("date"), X.direction_label("direction").alias("label"))


@register("format_levels", with_ticks("""
SELECT CAST(datetime AS DATE) AS day, printf('%7.2f / %-7.2f', max(high), min(low)) AS levels
FROM ticks WHERE abs(open) < 1e10 GROUP BY 1"""))
def q_format_levels(spark, sf_dir):
    from tickline.operators.clean import drop_bundle_markers
    t = drop_bundle_markers(_ticks(spark, sf_dir))
    g = t.groupBy(F.to_date("datetime").alias("day")).agg(F.max("high").alias("h"), F.min("low").alias("l"))
    return g.select("day", X.format_levels("h", "l").alias("levels"))


def readable_size_sql(col: str) -> str:
    units = X.SIZE_UNITS
    expr = f"printf('%.2f %s', floor(CAST({col} AS DOUBLE) * 100 + 0.5) / 100, '{units[0]}')"
    for k in range(1, len(units)):
        scale = float(1024 ** k)
        expr = (f"CASE WHEN CAST({col} AS DOUBLE) >= {scale} THEN printf('%.2f %s', "
                f"floor(CAST({col} AS DOUBLE) / {scale} * 100 + 0.5) / 100, '{units[k]}') ELSE {expr} END")
    return expr


@register("readable_size", with_ticks(f"""
SELECT contract, strftime(datetime, '%Y%m') AS month, CAST(count(*) * 40 AS BIGINT) AS raw_bytes,
       {readable_size_sql('count(*) * 40')} AS raw_size
FROM ticks GROUP BY 1, 2"""))
def q_readable_size(spark, sf_dir):
    """Raw on-disk size (40-byte records) per contract and month, as text."""
    g = (_ticks(spark, sf_dir).groupBy("contract", X.month_key("datetime").alias("month"))
         .agg((F.count(F.lit(1)) * 40).cast("long").alias("raw_bytes")))
    return g.withColumn("raw_size", X.readable_size("raw_bytes"))


# ---------------------------------------------------------------------------
# 2.4 aggregates, sorts and limits
# ---------------------------------------------------------------------------
CLEAN_BARS_SQL = f"""
SELECT make_timestamp((raw_time // 60000000) * 60000000 - {EPOCH}) AS datetime,
       arg_min(CASE WHEN open = 0.0 THEN close ELSE open END, raw_time) AS open,
       max(high) AS high, min(low) AS low, arg_max(close, raw_time) AS close,
       CAST(sum(num_trades) AS BIGINT) AS trades, CAST(sum(volume) AS BIGINT) AS volume,
       CAST(sum(bid_volume) AS BIGINT) AS bid_volume, CAST(sum(ask_volume) AS BIGINT) AS ask_volume
FROM ticks WHERE abs(open) < 1e10 GROUP BY raw_time // 60000000"""


@register("bars_1min_clean", with_ticks(CLEAN_BARS_SQL))
def q_bars_1min_clean(spark, sf_dir):
    from tickline.operators.bars import bars_clean
    return bars_clean(_ticks(spark, sf_dir))


BARS_SQL = """
bars AS (
  SELECT date_trunc('minute', datetime) AS candle_time,
         arg_min(close, raw_time) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, raw_time) AS close,
         CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(num_trades) AS BIGINT) AS trades
  FROM ticks GROUP BY 1)"""


@register("bars_range_query", with_ticks("""
SELECT * FROM bars WHERE candle_time >= TIMESTAMP '2024-01-05' AND candle_time < TIMESTAMP '2024-01-12'""",
    BARS_SQL))
def q_bars_range_query(spark, sf_dir):
    from tickline.context import workspace
    from tickline.operators.bars import bars_backfill, bars_range
    return bars_range(bars_backfill(_ticks(spark, sf_dir), workspace(spark, "bars")), "2024-01-05", "2024-01-12")


@register("bars_backfill", with_ticks(
    "SELECT *, strftime(candle_time, '%Y%m') AS month FROM bars", BARS_SQL))
def q_bars_backfill(spark, sf_dir):
    from tickline.context import workspace
    from tickline.operators.bars import bars_backfill
    path = workspace(spark, "bars")
    t = _ticks(spark, sf_dir)
    bars_backfill(t, path)
    # Again for a part of the month: same rows, the others stay.
    return bars_backfill(t.where(F.col("datetime") >= F.to_timestamp(F.lit("2024-01-20"))), path)


@register("head_tail", with_ticks("""
(SELECT *, 'head' AS part FROM bars ORDER BY candle_time LIMIT 10)
UNION ALL
(SELECT *, 'tail' AS part FROM bars ORDER BY candle_time DESC LIMIT 10)""", BARS_SQL))
def q_head_tail(spark, sf_dir):
    from tickline.operators.bars import bars_all, head_tail
    return head_tail(bars_all(_ticks(spark, sf_dir)))


@register("latest_ticks", with_ticks(
    f"SELECT {TICK_SELECT} FROM ticks ORDER BY datetime DESC, raw_time DESC, record_no DESC LIMIT 5"))
def q_latest_ticks(spark, sf_dir):
    from tickline.operators.bars import latest_ticks
    return latest_ticks(_ticks(spark, sf_dir))


@register("record_count", with_ticks("SELECT count(*) AS record_count FROM ticks"))
def q_record_count(spark, sf_dir):
    from tickline.operators.quality import record_count
    return record_count(_ticks(spark, sf_dir))


@register("date_range", with_ticks("SELECT min(datetime) AS first_time, max(datetime) AS last_time FROM ticks"))
def q_date_range(spark, sf_dir):
    from tickline.operators.quality import date_range
    return date_range(_ticks(spark, sf_dir))


@register("last_raw_time", with_ticks("SELECT max(raw_time) AS last_raw_time FROM ticks"))
def q_last_raw_time(spark, sf_dir):
    from tickline.operators.quality import last_raw_time
    return last_raw_time(_ticks(spark, sf_dir))


@register("distinct_contracts", with_ticks(
    "SELECT DISTINCT contract FROM ticks WHERE contract IS NOT NULL AND contract <> '' ORDER BY contract"))
def q_distinct_contracts(spark, sf_dir):
    from tickline.operators.quality import distinct_contracts
    return distinct_contracts(_ticks(spark, sf_dir))


@register("count_by_contract", with_ticks(
    "SELECT contract, count(*) AS record_count FROM ticks GROUP BY contract ORDER BY contract"))
def q_count_by_contract(spark, sf_dir):
    from tickline.operators.quality import count_by_contract
    return count_by_contract(_ticks(spark, sf_dir))


REDELIVERED_SQL = """
loaded AS (
  SELECT *, 1 AS load_order FROM ticks
  UNION ALL
  SELECT datetime, raw_time, open, high, low, close, num_trades, volume + 1, bid_volume, ask_volume,
         contract, record_no, 2 AS load_order
  FROM ticks WHERE datetime >= TIMESTAMP '2024-01-10')"""


def _loaded(spark, sf_dir):
    from tickline.sources.fixture import redelivered
    t = _ticks(spark, sf_dir)
    return t.withColumn("load_order", F.lit(1)).unionByName(redelivered(t).withColumn("load_order", F.lit(2)))


@register("duplicate_times", with_ticks("""
SELECT datetime, count(*) AS cnt FROM loaded GROUP BY datetime HAVING count(*) > 1
ORDER BY datetime LIMIT 10""", REDELIVERED_SQL))
def q_duplicate_times(spark, sf_dir):
    from tickline.operators.quality import duplicate_times
    return duplicate_times(_loaded(spark, sf_dir))


# ---------------------------------------------------------------------------
# 2.1 binary tick files: scan, time range, limit
# ---------------------------------------------------------------------------
def _tick_files(spark, sf_dir) -> str:
    """Write the tick view as binary files (one per contract and week, chronological)
    into a fresh folder under the shared checkpoint folder."""
    from tickline.context import workspace
    from tickline.sources.scid import write_ticks
    path = workspace(spark, "scid")
    t = _ticks(spark, sf_dir).withColumn("part", F.expr("string(unix_micros(datetime) div 604800000000)"))
    write_ticks(t.repartition("contract", "part").sortWithinPartitions("contract", "part", "raw_time", "record_no"), path)
    return path


FILE_TICKS_SQL = """
fticks AS (
  SELECT datetime, raw_time, open, high, low, close, num_trades, volume, bid_volume, ask_volume, contract, part,
         row_number() OVER (PARTITION BY contract, part ORDER BY raw_time, record_no) - 1 AS record_no
  FROM (SELECT *, CAST(epoch_us(datetime) // 604800000000 AS VARCHAR) AS part FROM ticks))"""


def _file_name():
    """Contract and week of a tick file, from its name."""
    return X.contract_from_file("file").alias("contract"), F.regexp_extract("file", r"\.(\d+)\.[0-9a-f-]+\.scid$", 1).alias("part")


@register("scan_ticks", with_ticks(f"SELECT {TICK_SELECT} FROM fticks", FILE_TICKS_SQL))
def q_scan_ticks(spark, sf_dir):
    from tickline.sources.scid import scan_ticks
    return scan_ticks(spark, _tick_files(spark, sf_dir), split_records=25_000).drop("file")


@register("scan_time_range", with_ticks(f"""
SELECT {TICK_SELECT} FROM fticks
WHERE datetime >= TIMESTAMP '2024-01-08' AND datetime < TIMESTAMP '2024-01-22 12:30:00'""", FILE_TICKS_SQL))
def q_scan_time_range(spark, sf_dir):
    from tickline.operators.clean import scan_time_range
    from tickline.sources.scid import scan_ticks
    df = scan_ticks(spark, _tick_files(spark, sf_dir), split_records=25_000, chronological=True)
    return scan_time_range(df, "2024-01-08", "2024-01-22 12:30:00").drop("file")


@register("scan_limit", with_ticks(f"SELECT {TICK_SELECT} FROM fticks WHERE record_no < 1000", FILE_TICKS_SQL))
def q_scan_limit(spark, sf_dir):
    """First 1000 records of each file (the limit is the operator itself)."""
    from tickline.operators.clean import scan_limit
    from tickline.sources.scid import scan_ticks
    return scan_limit(scan_ticks(spark, _tick_files(spark, sf_dir)), 1000).drop("file")


# ---------------------------------------------------------------------------
# 2.1 calendar, rollover, continuous series, ingestion
# ---------------------------------------------------------------------------
# Rollover calendar of the tick view (FIXTURES.md section 7).
FIXTURE_WINDOWS = [("ESH24", "2024-01-01", "2024-01-15"), ("ESM24", "2024-01-15", None)]

WINDOW_SQL = """
cal AS (SELECT * FROM (VALUES ('ESH24', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-15'),
                              ('ESM24', TIMESTAMP '2024-01-15', CAST(NULL AS TIMESTAMP))) v(contract, ws, we))"""


def _calendar_file(spark, files_dir: str | None, windows=FIXTURE_WINDOWS, nq: bool = False) -> str:
    """Write a calendar config naming the contract files of ``files_dir``.
    ``nq`` adds a second symbol: the ESM24 files again, from 2024-01-08 on, so
    that both symbols share times, and a file that is not there."""
    import json
    from tickline.context import workspace
    from tickline.sources.scid import contract_of, list_files
    by_contract = {}
    for f in list_files(files_dir) if files_dir else []:
        by_contract.setdefault(contract_of(f), []).append(f)
    contracts = [{"file": f, "start_date": s, "end_date": e}
                 for c, s, e in windows for f in by_contract.get(c, [f"/missing/{c}_FUT_CME.scid"])]
    cfg = {"symbols": {"ES": {"table_name": "ES", "price_multiplier": 1.0, "contracts": contracts}}}
    if nq:
        cfg["symbols"]["NQ"] = {"table_name": "NQ_ticks", "contracts": [
            *({"file": f, "start_date": "2024-01-08"} for f in by_contract["ESM24"]), {"file": f"{files_dir}/NQZ99_FUT_CME.scid"}]}
    folder = workspace(spark, "config")
    spark.range(1, numPartitions=1).select(F.lit(json.dumps(cfg)).alias("value")).write.text(folder)
    return folder


@register("contract_calendar", with_ticks("""
SELECT v.*, (SELECT count(*) FROM ticks t WHERE t.contract = v.contract AND t.datetime >= CAST(v.start_date AS TIMESTAMP)
             AND (v.end_date IS NULL OR t.datetime < CAST(v.end_date AS TIMESTAMP))) AS ticks
FROM (VALUES ('ES', 'ES', 1.0, 'ESH24', '2024-01-01', '2024-01-15'),
             ('ES', 'ES', 1.0, 'ESM24', '2024-01-15', CAST(NULL AS VARCHAR)))
  v(symbol, table_name, price_multiplier, contract, start_date, end_date)"""))
def q_contract_calendar(spark, sf_dir):
    """Contracts of the calendar for the files written from the tick view, with
    the ticks that each one's window takes from its files."""
    from tickline.sources.calendar import continuous_series, contract_calendar
    cal = contract_calendar(spark, _calendar_file(spark, _tick_files(spark, sf_dir)))
    taken = continuous_series(spark, cal, ordered=False).groupBy("contract").agg(F.count(F.lit(1)).alias("ticks"))
    return (cal.withColumn("contract", X.contract_from_file("file")).drop("file").distinct().join(taken, "contract", "left")
               .select("symbol", "table_name", "price_multiplier", "contract", "start_date", "end_date",
                       F.coalesce("ticks", F.lit(0)).alias("ticks")))


@register("rollover_filter", with_ticks(f"""
SELECT {', '.join('t.' + c.strip() for c in TICK_SELECT.split(','))}
FROM ticks t JOIN cal c ON t.contract = c.contract
WHERE t.datetime >= c.ws AND (c.we IS NULL OR t.datetime < c.we)""", WINDOW_SQL))
def q_rollover_filter(spark, sf_dir):
    from tickline.sources.calendar import contract_calendar, rollover_filter
    cal = contract_calendar(spark, _calendar_file(spark, None))
    return rollover_filter(_ticks(spark, sf_dir), cal)


CONTINUOUS_SQL = f"""
SELECT {', '.join('t.' + c.strip() for c in TICK_SELECT.split(','))}
FROM fticks t JOIN cal c ON t.contract = c.contract
WHERE t.datetime >= c.ws AND (c.we IS NULL OR t.datetime < c.we)"""


@register("continuous_series", with_ticks(CONTINUOUS_SQL, FILE_TICKS_SQL, WINDOW_SQL))
def q_continuous_series(spark, sf_dir):
    from tickline.sources.calendar import contract_calendar, continuous_series
    cal = contract_calendar(spark, _calendar_file(spark, _tick_files(spark, sf_dir)))
    return continuous_series(spark, cal, chronological=True).drop("file")


DEFAULT_WINDOW_SQL = """
chosen AS (
  SELECT t.* FROM fticks t LEFT JOIN (SELECT * FROM cal WHERE contract = 'ESH24') c ON t.contract = c.contract
  WHERE (c.ws IS NULL OR t.datetime >= c.ws) AND (c.we IS NULL OR t.datetime < c.we))"""


def _chosen_files(spark, sf_dir):
    """Tick files, and a calendar that names those of the first contract only."""
    from tickline.sources.calendar import contract_calendar
    from tickline.sources.scid import scan_ticks
    files = _tick_files(spark, sf_dir)
    return scan_ticks(spark, files), contract_calendar(spark, _calendar_file(spark, files, FIXTURE_WINDOWS[:1]))


@register("bars_clean_range", with_ticks(CLEAN_BARS_SQL.replace("SELECT make", "SELECT contract, make").replace("FROM ticks", "FROM chosen")
                                         .replace("GROUP BY ", "GROUP BY contract, "), FILE_TICKS_SQL, WINDOW_SQL, DEFAULT_WINDOW_SQL))
def q_bars_clean_range(spark, sf_dir):
    """Bars of tick files without dates: the calendar's window where it names
    the file, else the whole file."""
    from tickline.operators.bars import bars_clean_range
    ticks, cal = _chosen_files(spark, sf_dir)
    return bars_clean_range(ticks, calendar=cal, by=["contract"])


@register("export_window", with_ticks("""
SELECT datetime, CASE WHEN open = 0.0 THEN close ELSE open END AS open, high, low, close,
       num_trades, volume, bid_volume, ask_volume, contract, record_no
FROM chosen WHERE abs(open) < 1e10""", FILE_TICKS_SQL, WINDOW_SQL, DEFAULT_WINDOW_SQL))
def q_export_window(spark, sf_dir):
    """The same for the export."""
    from tickline.context import workspace
    from tickline.sources.files import export_ticks
    ticks, cal = _chosen_files(spark, sf_dir)
    return spark.read.parquet(export_ticks(ticks, workspace(spark, "export"), calendar=cal))


@register("contract_window_lookup", with_ticks("""
SELECT v.*, t.ticks FROM (VALUES ('ESH24', 'ES', '2024-01-01', '2024-01-15'),
                      ('ESM24', 'ES', '2024-01-15', CAST(NULL AS VARCHAR)))
  v(contract, symbol, start_date, end_date) JOIN (SELECT contract, count(*) AS ticks FROM ticks GROUP BY contract) t USING (contract)"""))
def q_contract_window_lookup(spark, sf_dir):
    """Window of every tick file found on disk (upper-cased names still match)."""
    from tickline.sources.calendar import contract_calendar, contract_window_lookup
    from tickline.sources.scid import scan_ticks
    files_dir = _tick_files(spark, sf_dir)
    cal = contract_calendar(spark, _calendar_file(spark, files_dir))
    files = scan_ticks(spark, files_dir).groupBy(F.upper("file").alias("file")).agg(F.count(F.lit(1)).alias("ticks"))
    out = contract_window_lookup(files, cal)
    return (out.groupBy(X.contract_from_file(F.col("file")).alias("contract"), "symbol", "start_date", "end_date")
               .agg(F.sum("ticks").alias("ticks")))


SYNCED_SQL = f"""
synced AS (
  SELECT 'ES' AS symbol, {TICK_SELECT} FROM ({CONTINUOUS_SQL.strip()}) s
  UNION ALL SELECT 'NQ' AS symbol, {TICK_SELECT} FROM fticks WHERE contract = 'ESM24' AND datetime >= TIMESTAMP '2024-01-08')"""

CALENDAR_FILES_SQL = """
files AS (
  SELECT 'ES' AS symbol, contract, part, ws, we FROM (SELECT DISTINCT contract, part FROM fticks) JOIN cal USING (contract)
  UNION ALL SELECT DISTINCT 'NQ', contract, part, TIMESTAMP '2024-01-08', CAST(NULL AS TIMESTAMP) FROM fticks WHERE contract = 'ESM24'
  UNION ALL SELECT 'NQ', 'NQZ99', '', NULL, NULL),
file_rows AS (
  SELECT f.symbol, f.contract, f.part, f.ws, f.we, count(t.contract) AS n
  FROM files f LEFT JOIN fticks t ON t.contract = f.contract AND t.part = f.part AND t.datetime >= f.ws AND (f.we IS NULL OR t.datetime < f.we)
  GROUP BY ALL)"""


def _synced(spark, sf_dir, partial_first: bool = False):
    from tickline.context import workspace
    from tickline.plans.ingest import sync_symbols
    from tickline.sources.calendar import contract_calendar
    cal = contract_calendar(spark, _calendar_file(spark, _tick_files(spark, sf_dir), nq=True))
    table, ledger = workspace(spark, "table"), workspace(spark, "ledger")
    if partial_first:
        sync_symbols(spark, cal.where(X.contract_from_file("file") == "ESH24"), table, ledger)
    sync_symbols(spark, cal, table, ledger)
    sync_symbols(spark, cal, table, ledger)      # only the missing file is pending: no rows
    return cal, table, ledger


@register("sync_symbols", with_ticks(f"SELECT symbol, {TICK_SELECT}, strftime(datetime, '%Y%m') AS month FROM synced",
                                     FILE_TICKS_SQL, WINDOW_SQL, SYNCED_SQL))
def q_sync_symbols(spark, sf_dir):
    """Two-step load (one contract, then the rest of both symbols) plus a
    re-run; each symbol's table holds every windowed tick exactly once."""
    from tickline.plans.ingest import read_table, table_for
    _, root, _ = _synced(spark, sf_dir, partial_first=True)
    return (read_table(spark, table_for(root, "ES")).withColumn("symbol", F.lit("ES"))
            .unionByName(read_table(spark, table_for(root, "NQ_ticks")).withColumn("symbol", F.lit("NQ"))))


@register("ingest_stats", with_ticks("""
SELECT symbol, count(*) AS files, CAST(sum(n) AS BIGINT) AS rows_processed, CAST(sum(n) AS BIGINT) AS rows_inserted,
       TRUE AS timed, TRUE AS rated FROM file_rows GROUP BY symbol""", FILE_TICKS_SQL, WINDOW_SQL, CALENDAR_FILES_SQL))
def q_ingest_stats(spark, sf_dir):
    from tickline.plans.ingest import ingest_stats, read_ledger
    """Load totals by symbol; elapsed time and rate vary, so what shows is that
    they are there and agree with each other."""
    _, _, ledger = _synced(spark, sf_dir)
    rate = F.col("rows_processed") / F.col("elapsed_seconds")
    return ingest_stats(read_ledger(spark, ledger)).select(
        "symbol", "files", "rows_processed", "rows_inserted", F.coalesce(F.col("elapsed_seconds").between(0, 86_400), F.lit(False)).alias("timed"),
        F.coalesce(F.abs(F.col("rows_per_second") - rate) <= rate / 1e9, F.lit(False)).alias("rated"))


@register("pending_files", with_ticks("""
SELECT symbol, contract, part, strftime(ws, '%Y-%m-%d') AS start_date, strftime(we, '%Y-%m-%d') AS end_date
FROM file_rows WHERE NOT (symbol = 'ES' AND contract = 'ESH24' AND n > 0)""", FILE_TICKS_SQL, WINDOW_SQL, CALENDAR_FILES_SQL))
def q_pending_files(spark, sf_dir):
    """After loading only the first contract, its files beyond its window, the
    second one's and the other symbol's (the same paths once more, and one that
    is missing) are pending."""
    from tickline.context import workspace
    from tickline.plans.ingest import pending_files, read_ledger, sync_symbols
    from tickline.sources.calendar import contract_calendar
    cal = contract_calendar(spark, _calendar_file(spark, _tick_files(spark, sf_dir), nq=True))
    table, ledger = workspace(spark, "table"), workspace(spark, "ledger")
    sync_symbols(spark, cal.where(X.contract_from_file("file") == "ESH24"), table, ledger)
    out = pending_files(cal, read_ledger(spark, ledger))
    return out.select("symbol", *_file_name(), "start_date", "end_date")




LOADED_KEEP_SQL = """
SELECT datetime, raw_time, open, high, low, close, num_trades, volume, bid_volume, ask_volume, contract,
       record_no, strftime(datetime, '%Y%m') AS month
FROM (SELECT *, row_number() OVER (PARTITION BY datetime, raw_time ORDER BY load_order {dir}) AS k FROM loaded)
WHERE k = 1"""


@register("insert_ignore", with_ticks(LOADED_KEEP_SQL.format(dir="ASC"), REDELIVERED_SQL))
def q_insert_ignore(spark, sf_dir):
    """Load, then a re-delivered overlapping batch: the first copy stays."""
    from tickline.context import workspace
    from tickline.plans.ingest import insert_ignore, read_table
    from tickline.sources.fixture import redelivered
    path = workspace(spark, "table")
    t = _ticks(spark, sf_dir)
    insert_ignore(t, path)
    insert_ignore(redelivered(t), path)
    return read_table(spark, path)


@register("upsert_replace", with_ticks(LOADED_KEEP_SQL.format(dir="DESC"), REDELIVERED_SQL))
def q_upsert_replace(spark, sf_dir):
    """Load, then a re-delivered overlapping batch: the last copy wins."""
    from tickline.context import workspace
    from tickline.plans.ingest import read_table, upsert_replace
    from tickline.sources.fixture import redelivered
    path = workspace(spark, "table")
    t = _ticks(spark, sf_dir)
    upsert_replace(t, path)
    upsert_replace(redelivered(t), path)
    return read_table(spark, path)


# ---------------------------------------------------------------------------
# 2.1 exports and CSV sinks
# ---------------------------------------------------------------------------
EXPORT_SQL = with_ticks("""
SELECT datetime, CASE WHEN open = 0.0 THEN close ELSE open END AS open, high, low, close,
       num_trades, volume, bid_volume, ask_volume, contract, record_no
FROM ticks WHERE abs(open) < 1e10""")


def _exported(spark, sf_dir) -> str:
    from tickline.context import workspace
    from tickline.sources.files import export_ticks
    return export_ticks(_ticks(spark, sf_dir), workspace(spark, "export"))


@register("export_ticks", EXPORT_SQL)
def q_export_ticks(spark, sf_dir):
    return spark.read.parquet(_exported(spark, sf_dir))


@register("read_export", EXPORT_SQL)
def q_read_export(spark, sf_dir):
    from tickline.sources.files import read_export
    return read_export(spark, _exported(spark, sf_dir), kind="ticks")


@register("export_to_csv", EXPORT_SQL)
def q_export_to_csv(spark, sf_dir):
    from tickline.context import workspace
    from tickline.sources.files import export_to_csv, read_csv
    src = _exported(spark, sf_dir)
    out = export_to_csv(spark, src, workspace(spark, "export") + ".csv")
    return read_csv(spark, out, spark.read.parquet(src).schema)


@register("write_bars", with_ticks(CLEAN_BARS_SQL))
def q_write_bars(spark, sf_dir):
    """Clean 1-minute bars saved as CSV (format from the extension), read back."""
    from tickline.context import workspace
    from tickline.operators.bars import bars_clean
    from tickline.sources.files import read_csv, write_bars
    bars = bars_clean(_ticks(spark, sf_dir))
    out = workspace(spark, "bars") + ".csv"
    write_bars(bars, out)
    return read_csv(spark, out, bars.schema)


@register("results_csv", study_sql(f"SELECT {TRADE_SELECT} FROM final"))
def q_results_csv(spark, sf_dir):
    from tickline.context import workspace
    from tickline.sources.files import read_csv, results_csv
    trades = _study(spark, sf_dir).trades()
    out = results_csv(trades, workspace(spark, "results") + ".csv")
    return read_csv(spark, out, trades.schema)


@register("sample_to_csv", with_ticks(
    f"SELECT {TICK_SELECT} FROM ticks ORDER BY datetime, raw_time, record_no LIMIT 1000"))
def q_sample_to_csv(spark, sf_dir):
    """First 1000 ticks by time to CSV (the limit is the operator itself)."""
    from tickline.context import workspace
    from tickline.sources.files import read_csv, sample_to_csv
    t = _ticks(spark, sf_dir)
    out = sample_to_csv(t, workspace(spark, "sample") + ".csv", 1000)
    return read_csv(spark, out, t.schema)


# ---------------------------------------------------------------------------
# 2.7 table maintenance and 2.4 inventories
# ---------------------------------------------------------------------------
SPREAD_SQL = """
months AS (
  SELECT * REPLACE (datetime + to_days(CAST(40 * (record_no % 3) AS INTEGER)) AS datetime, raw_time + 40 * (record_no % 3) * 86400000000 AS raw_time) FROM ticks)"""


def _spread(spark, sf_dir):
    """The ticks over several months: a third of them 40 days later, a third 80."""
    late = F.pmod(F.col("record_no"), F.lit(3)) * F.lit(40 * 86_400_000_000)
    return (_ticks(spark, sf_dir).withColumn("raw_time", F.col("raw_time") + late)
            .withColumn("datetime", F.timestamp_micros(F.unix_micros("datetime") + late)))


def _table(spark, sf_dir) -> str:
    from tickline.context import workspace
    from tickline.plans.ingest import write_monthly
    return write_monthly(_spread(spark, sf_dir), workspace(spark, "table"))


MONTHS_SELECT = f"SELECT {TICK_SELECT}, strftime(datetime, '%Y%m') AS month FROM months"
TABLE_SQL = with_ticks(MONTHS_SELECT, SPREAD_SQL)


@register("monthly_table", TABLE_SQL)
def q_monthly_table(spark, sf_dir):
    from tickline.plans.ingest import read_table
    return read_table(spark, _table(spark, sf_dir))


@register("migrate_layout", with_ticks(LOADED_KEEP_SQL.format(dir="ASC"), REDELIVERED_SQL))
def q_migrate_layout(spark, sf_dir):
    """An unpartitioned dataset holding a re-delivered batch, rewritten as
    month partitions with one row per key (first load wins)."""
    from tickline.context import workspace
    from tickline.plans.ingest import read_table
    from tickline.plans.maintain import migrate_layout
    src = workspace(spark, "flat")
    _loaded(spark, sf_dir).write.parquet(src)
    dst = migrate_layout(spark, src, workspace(spark, "table"), order=("load_order", "record_no"))
    return read_table(spark, dst)


@register("compact_old", TABLE_SQL)
def q_compact_old(spark, sf_dir):
    """Compaction rewrites old months (zstd, clustered) without changing rows;
    a second run is a no-op."""
    from tickline.context import workspace
    from tickline.plans.ingest import read_table
    from tickline.plans.maintain import compact_old
    path, ledger = _table(spark, sf_dir), workspace(spark, "compactions")
    compact_old(spark, path, ledger, "2024-03-01")
    compact_old(spark, path, ledger, "2024-03-01")
    return read_table(spark, path)


@register("compacted_counts", with_ticks("""
SELECT 'ES' AS "table", count(DISTINCT m) FILTER (WHERE old) AS compacted, count(DISTINCT m) FILTER (WHERE NOT old) AS not_compacted,
       count(DISTINCT m) AS total
FROM (SELECT date_trunc('month', datetime) AS m, date_trunc('month', datetime) + INTERVAL 1 MONTH <= TIMESTAMP '2024-02-23' AS old FROM months)""", SPREAD_SQL))
def q_compacted_counts(spark, sf_dir):
    from tickline.context import workspace
    from tickline.plans.maintain import compact_old, compacted_counts
    path, ledger = _table(spark, sf_dir), workspace(spark, "compactions")
    compact_old(spark, path, ledger, "2024-03-01")
    return compacted_counts(spark, {"ES": path}, ledger)


@register("compaction_report", with_ticks("""
SELECT DISTINCT 'ES' AS "table", strftime(datetime, '%Y%m') AS month, TRUE AS has_before, TRUE AS has_after
FROM months WHERE date_trunc('month', datetime) + INTERVAL 1 MONTH <= TIMESTAMP '2024-02-23'""", SPREAD_SQL))
def q_compaction_report(spark, sf_dir):
    """Compacted months of the report (its sizes vary, so they show as present)."""
    from tickline.context import workspace
    from tickline.plans.maintain import compact_old, compaction_report
    path, ledger = _table(spark, sf_dir), workspace(spark, "compactions")
    compact_old(spark, path, ledger, "2024-03-01")
    present = [(F.length(f"{k}_compression") > 0).alias(f"has_{k}") for k in ("before", "after")]
    return compaction_report(spark, ledger).select("table", "month", *present)


@register("partition_inventory", with_ticks(
    "SELECT strftime(datetime, '%Y%m') AS month, count(*) AS rows, TRUE AS has_files, TRUE AS has_bytes FROM months GROUP BY 1", SPREAD_SQL))
def q_partition_inventory(spark, sf_dir):
    """Rows per month, with files and bytes (which vary) as present."""
    from tickline.plans.maintain import partition_inventory
    inv = partition_inventory(spark, _table(spark, sf_dir))
    return inv.select("month", "rows", (F.col("files") > 0).alias("has_files"), ((F.col("bytes") > 0) & (F.length("size") > 0)).alias("has_bytes"))


@register("table_sizes", with_ticks("""
SELECT 'ES' AS "table", count(*) AS rows, TRUE AS has_bytes FROM months
UNION ALL SELECT 'ES_flat', count(*), TRUE FROM ticks""", SPREAD_SQL))
def q_table_sizes(spark, sf_dir):
    """Rows of two tables, with their bytes (which vary) as present."""
    from tickline.context import workspace
    from tickline.plans.ingest import write_monthly
    from tickline.plans.maintain import table_sizes
    flat = write_monthly(_ticks(spark, sf_dir), workspace(spark, "table"))
    sizes = table_sizes(spark, {"ES": _table(spark, sf_dir), "ES_flat": flat})
    return sizes.select("table", "rows", ((F.col("bytes") > 0) & (F.length("size") > 0)).alias("has_bytes"))


@register("table_summary", with_ticks("""
SELECT count(*) AS record_count, min(datetime) AS first_time, max(datetime) AS last_time, max(raw_time) AS last_raw_time FROM months""", SPREAD_SQL))
def q_table_summary(spark, sf_dir):
    """Count, time range and high-water mark of a stored table, from its footers."""
    from tickline.plans.maintain import table_summary
    return table_summary(spark, _table(spark, sf_dir))


@register("partition_rows", with_ticks(
    "SELECT strftime(datetime, '%Y%m') AS month, count(*) AS rows FROM months GROUP BY 1", SPREAD_SQL))
def q_partition_rows(spark, sf_dir):
    """The deterministic part of the inventory: rows per month partition."""
    from tickline.plans.maintain import partition_inventory
    return partition_inventory(spark, _table(spark, sf_dir)).select("month", "rows")


@register("drop_month", with_ticks(f"{MONTHS_SELECT} WHERE strftime(datetime, '%Y%m') <> '202402'", SPREAD_SQL))
def q_drop_month(spark, sf_dir):
    from tickline.plans.ingest import read_table
    from tickline.plans.maintain import drop_month
    path = _table(spark, sf_dir)
    drop_month(spark, path, "202402")
    return read_table(spark, path)


@register("detach_month", with_ticks(f"SELECT m.*, month = '202402' AS archived FROM ({MONTHS_SELECT}) m", SPREAD_SQL))
def q_detach_month(spark, sf_dir):
    """The archive holds the detached month, the table the others; a second
    run changes nothing."""
    from tickline.context import workspace
    from tickline.plans.ingest import read_table
    from tickline.plans.maintain import detach_month
    path = _table(spark, sf_dir)
    archive = detach_month(spark, path, "202402", workspace(spark, "archive"))
    detach_month(spark, path, "202402", archive)
    return (read_table(spark, archive).withColumn("archived", F.lit(True))
            .unionByName(read_table(spark, path).withColumn("archived", F.lit(False))))


# ---------------------------------------------------------------------------
# 2.6 streaming (availableNow into a sink under the shared folder, read back)
# ---------------------------------------------------------------------------
STREAM_FILES = 2


def _arriving(spark, parts) -> str:
    """A folder that ``parts`` are appended to, one after the other."""
    from tickline.context import workspace
    src = workspace(spark, "stream-src")
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(src)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    seen, stamp = set(), 1_700_000_000_000
    for df in parts:
        # Arrival order = modification time: stamp each append's files later
        # than the previous ones (file-system clocks may be coarse).
        if not df.take(1):
            continue
        df.repartitionByRange(STREAM_FILES, "datetime").write.mode("append").parquet(src)
        stamp += 60_000
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name.endswith(".parquet") and name not in seen:
                seen.add(name)
                fs.setTimes(st.getPath(), stamp, stamp)
    return src


def _stream_source(spark, sf_dir, redeliver: bool) -> str:
    """Ticks arrive week by week (one append per week, so file times follow
    event time); with ``redeliver`` each week is followed by a re-delivery of
    its ticks from 2024-01-10 on (same key, volume + 1)."""
    from tickline.sources.fixture import redelivered
    t = _ticks(spark, sf_dir)

    def weeks():
        first, last = t.agg(F.min(F.to_date("datetime")), F.max(F.to_date("datetime"))).first()
        for k in range(((last - first).days // 7 + 1) if first else 0):
            lo = F.date_add(F.lit(first), 7 * k)
            week = t.where((F.to_date("datetime") >= lo) & (F.to_date("datetime") < F.date_add(lo, 7)))
            yield week
            if redeliver:
                yield redelivered(week)

    return _arriving(spark, weeks())


@register("stream_dedup", with_ticks(f"SELECT {TICK_SELECT} FROM ticks"))
def q_stream_dedup(spark, sf_dir):
    from tickline.context import workspace
    from tickline.streaming.ticks import run_available, stream_dedup, tick_stream
    src = _stream_source(spark, sf_dir, redeliver=True)
    sink, ck = workspace(spark, "stream-sink"), workspace(spark, "stream-ck")
    run_available(stream_dedup(tick_stream(spark, src, STREAM_FILES), "8 days"), sink, ck)
    return spark.read.schema(TICK_SCHEMA_DDL).parquet(sink)


TICK_SCHEMA_DDL = ("datetime timestamp, raw_time bigint, open double, high double, low double, close double, "
                   "num_trades bigint, volume bigint, bid_volume bigint, ask_volume bigint, contract string, "
                   "record_no bigint")


@register("stream_bars_1min", with_ticks("""
SELECT * FROM bars
WHERE candle_time + INTERVAL 1 MINUTE <= (SELECT max(datetime) FROM ticks) - INTERVAL 1 HOUR""", BARS_SQL))
def q_stream_bars(spark, sf_dir):
    """Bars kept by a stream; the windows still open at the end (within the
    watermark delay of the newest tick) are not emitted yet."""
    from tickline.context import workspace
    from tickline.streaming.ticks import run_available, stream_bars, tick_stream
    src = _stream_source(spark, sf_dir, redeliver=False)
    sink, ck = workspace(spark, "stream-sink"), workspace(spark, "stream-ck")
    run_available(stream_bars(tick_stream(spark, src, STREAM_FILES), "1 hour"), sink, ck)
    return spark.read.parquet(sink)


@register("stream_bars_late", with_ticks("SELECT * FROM bars", BARS_SQL))
def q_stream_bars_late(spark, sf_dir):
    """Bars kept by a stream whose ticks come in any order: three passes over the
    month, each with a third of the ticks, so most are weeks later than any
    watermark; run twice (restart)."""
    from tickline.context import workspace
    from tickline.plans.bar_table import read_bars
    from tickline.streaming.ticks import stream_bars_merged, tick_stream
    t = _ticks(spark, sf_dir)
    src = _arriving(spark, (t.where(F.pmod("record_no", F.lit(3)) == k) for k in (2, 0, 1)))
    bars, ck = workspace(spark, "bars"), workspace(spark, "stream-ck")
    for _ in range(2):
        stream_bars_merged(tick_stream(spark, src, STREAM_FILES), bars, ck)
    return read_bars(spark, bars)


def _followed(spark, sf_dir) -> tuple[str, str]:
    """Tick files that grow while they are followed into tables and bars: half
    of each file's records (and a part of the next one), a stop between two
    commits of a batch, the whole files, and a restart."""
    from pyspark.errors import StreamingQueryException
    from tickline.context import workspace
    from tickline.sources.calendar import contract_calendar
    from tickline.sources.fixture import grow_files
    from tickline.streaming.follow import follow_into
    src, growing = _tick_files(spark, sf_dir), workspace(spark, "growing")
    share = max(1, _ticks(spark, sf_dir).count() // 3)
    grow_files(spark, src, growing, 0.5)
    cal = contract_calendar(spark, _calendar_file(spark, growing, nq=True))
    root, bars, ledger, ck = (workspace(spark, n) for n in ("table", "bars", "ledger", "stream-ck"))
    commits = []

    def stop(step):
        commits.append(step)
        if len(commits) == 3:
            raise InterruptedError("stopped in mid-batch")

    try:
        follow_into(spark, cal, root, ledger, ck, bars, share, probe=stop)
    except StreamingQueryException as e:
        if "stopped in mid-batch" not in str(e):
            raise
    grow_files(spark, src, growing, 1.0)
    follow_into(spark, cal, root, ledger, ck, bars, share)
    return root, bars


@register("follow_ticks", with_ticks(f"SELECT symbol, {TICK_SELECT}, strftime(datetime, '%Y%m') AS month FROM synced",
                                     FILE_TICKS_SQL, WINDOW_SQL, SYNCED_SQL))
def q_follow_ticks(spark, sf_dir):
    """Growing tick files followed into both symbols' tables: every windowed
    tick once."""
    from tickline.plans.ingest import read_table, table_for
    root, _ = _followed(spark, sf_dir)
    return (read_table(spark, table_for(root, "ES")).withColumn("symbol", F.lit("ES"))
            .unionByName(read_table(spark, table_for(root, "NQ_ticks")).withColumn("symbol", F.lit("NQ"))))


@register("follow_bars", with_ticks("""
SELECT symbol, date_trunc('minute', datetime) AS candle_time, arg_min(close, raw_time) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, raw_time) AS close, CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(num_trades) AS BIGINT) AS trades
FROM synced GROUP BY ALL""", FILE_TICKS_SQL, WINDOW_SQL, SYNCED_SQL))
def q_follow_bars(spark, sf_dir):
    """The bars that were kept along the way."""
    from tickline.plans.bar_table import read_bars
    from tickline.plans.ingest import table_for
    _, bars = _followed(spark, sf_dir)
    return (read_bars(spark, table_for(bars, "ES")).withColumn("symbol", F.lit("ES"))
            .unionByName(read_bars(spark, table_for(bars, "NQ_ticks")).withColumn("symbol", F.lit("NQ"))))


@register("stream_ingest", with_ticks(f"SELECT {TICK_SELECT}, strftime(datetime, '%Y%m') AS month FROM ticks"))
def q_stream_ingest(spark, sf_dir):
    """Ticks plus re-deliveries streamed into the table, in batches of any size;
    run twice (restart): every tick once, in its first copy."""
    from tickline.context import workspace
    from tickline.plans.ingest import read_table
    from tickline.streaming.ticks import stream_ingest
    src = _stream_source(spark, sf_dir, redeliver=True)
    table, ck = workspace(spark, "table"), workspace(spark, "stream-ck")
    stream_ingest(spark, src, table, ck)
    stream_ingest(spark, src, table, ck)
    return read_table(spark, table)


@register("run_study", study_sql(COMPARE_SQL))
def q_run_study(spark, sf_dir):
    """The full study job over the exported ticks (Parquet), ending in the
    strategy comparison; the trade table is written to CSV on the way."""
    from tickline.context import workspace
    from tickline.plans.study import run_study
    exported = spark.read.parquet(_exported(spark, sf_dir)).withColumn("contract", F.lit("ES"))
    res = run_study(exported, DRIVER_PARAMS, workspace(spark, "results") + ".csv")
    return res["comparison"]


@register("ledger_update", with_ticks("""
SELECT symbol, contract, part, n > 0 AS completed, n AS rows_processed, n AS rows_inserted FROM file_rows""",
                                     FILE_TICKS_SQL, WINDOW_SQL, CALENDAR_FILES_SQL))
def q_ledger_update(spark, sf_dir):
    """Latest ledger entry per contract file after a load and a re-run; the
    missing file and those beyond their window are not completed."""
    from tickline.plans.ingest import ledger_state, read_ledger
    _, _, ledger = _synced(spark, sf_dir)
    st = ledger_state(read_ledger(spark, ledger))
    return st.select("symbol", *_file_name(), "completed", "rows_processed", "rows_inserted")
