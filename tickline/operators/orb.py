"""Opening-range breakout (ORB) study as DataFrame passes.

One row per (contract, session_date).  The per-tick loops of a scalar
implementation ("walk the path until target or stop") are rewritten as
comparisons of conditional minima over an ordering key k = (et, record_no):

    T = min(k where favourable move >= target)
    S = min(k where adverse move  >= stop)
    T < S -> +target ; S exists -> -stop ; neither -> profit at the last tick

All of those are ordinary aggregates with mergeable buffers, so every pass is
"join the ticks with a small per-day table, then a partial + final hash
aggregate"; a busy day is combined on the map side and never shuffled whole.
The only true ordered scan -- the running extreme of the S3 fade -- goes
through ``operators.scan.first_drawdown`` (range-chunked, bounded tasks).

Prices are handled as ``q = side * price`` so long and short share one
formula; IEEE negation is exact, so every comparison equals the
direction-specific comparison in price space.

Per-day tables are staged as Parquet between passes: they are small, they are
reused by several passes, and the size check that decides whether they are
broadcast needs their real row count.  ``path_stats`` aggregates structs
(et, record_no): microseconds of a day and a record number need more than the
63 bits of one long, so it is a sort aggregate; what it sorts is one day's path
columns within a task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.functions.expr import format_levels, session_date, time_of_day_us, to_eastern
from tickline.operators.joins import Measured, attach, materialize
from tickline.operators.scan import first_drawdown
from tickline.schema import SESSION_TZ

KEYS = ["contract", "session_date"]


def _tod(text: str) -> int:
    h, m, *s = text.split(":")
    sec = float(s[0]) if s else 0.0
    return int(round((int(h) * 3600 + int(m) * 60 + sec) * 1_000_000))


@dataclass(frozen=True)
class OrbParams:
    """Session times (exchange wall clock), filters, targets and stops.
    Defaults are the study's own values."""
    tz: str = SESSION_TZ
    session_start: str = "09:30:00"
    or_seconds: float = 30.0
    session_end: str = "16:00:00"
    fade_start: str = "10:00:00"
    time_stop: str = "11:30:00"
    min_day_ticks: int = 2
    width_limit: float = 5.0
    s0_target: float = 30.0
    s0_stop: float = 25.0
    s1_target: float = 15.0
    s1_stop: float = 15.0
    s2_buffer: float = 2.0
    s2_target: float = 30.0
    s2_stop: float = 15.0
    s3_stretch: float = 3.0
    s3_min_reversal: float = 5.0
    s3_target: float = 15.0
    s3_stop_beyond: float = 2.0
    s4_target: float = 30.0
    s4_stop: float = 25.0
    s4_min_profit: float = 5.0
    targets: tuple = (4, 7.5, 10, 15, 20)

    @property
    def t_start(self) -> int:
        return _tod(self.session_start)

    @property
    def t_or_end(self) -> int:
        return self.t_start + int(round(self.or_seconds * 1_000_000))

    @property
    def t_end(self) -> int:
        return _tod(self.session_end)

    @property
    def t_fade(self) -> int:
        return _tod(self.fade_start)

    @property
    def t_stop(self) -> int:
        return _tod(self.time_stop)


def _lit(x):
    return F.lit(float(x))


def _k():
    return F.struct(F.col("et"), F.col("record_no"))


def _before(a: str, b: str):
    """Key ``a`` exists and comes strictly before ``b`` (or ``b`` is absent)."""
    return F.col(a).isNotNull() & (F.col(b).isNull() | (F.col(a) < F.col(b)))


# ---------------------------------------------------------------------------
# pass 0: prices on the exchange clock
# ---------------------------------------------------------------------------
def prices(ticks: DataFrame, p: OrbParams = OrbParams()) -> DataFrame:
    """(contract, datetime, record_no, price|close) -> tick prices with the
    Eastern wall time ``et``, its date and its time of day in µs."""
    price = F.col("price") if "price" in ticks.columns else F.col("close")
    rec = F.col("record_no") if "record_no" in ticks.columns else F.lit(0).cast("long")
    contract = F.col("contract") if "contract" in ticks.columns else F.lit("")
    et = to_eastern("datetime", p.tz)
    return (ticks.select(contract.alias("contract"), rec.alias("record_no"),
                         price.cast("double").alias("price"), et.alias("et"))
                 .withColumn("session_date", session_date("et"))
                 .withColumn("tod", time_of_day_us("et")))


def _in_or(p):
    return (F.col("tod") >= p.t_start) & (F.col("tod") <= p.t_or_end)


def _in_rth(p):
    return (F.col("tod") >= p.t_start) & (F.col("tod") <= p.t_end)


def _post_or(p):
    return (F.col("tod") > p.t_or_end) & (F.col("tod") <= p.t_end)


def session_slices(px: DataFrame, levels: Measured, p: OrbParams = OrbParams()) -> DataFrame:
    """Ticks of valid days tagged as opening range / regular hours / post-OR."""
    return (attach(px, Measured(levels.df.select(*KEYS), levels.rows), KEYS, "left_semi")
            .withColumns({"in_or": _in_or(p), "in_rth": _in_rth(p), "post_or": _post_or(p)}))


# ---------------------------------------------------------------------------
# pass 1: levels per day
# ---------------------------------------------------------------------------
def session_levels(px: DataFrame, p: OrbParams = OrbParams()) -> DataFrame:
    """OR high/low/width and regular-hours high/low for every valid day
    (>= ``min_day_ticks`` ticks on the Eastern date and >= 1 tick in the OR)."""
    agg = px.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_day"),
        F.count_if(_in_or(p)).alias("n_or"),
        F.max(F.when(_in_or(p), F.col("price"))).alias("or_high"),
        F.min(F.when(_in_or(p), F.col("price"))).alias("or_low"),
        F.max(F.when(_in_rth(p), F.col("price"))).alias("daily_high"),
        F.min(F.when(_in_rth(p), F.col("price"))).alias("daily_low"),
    )
    return (agg.where((F.col("n_day") >= p.min_day_ticks) & (F.col("n_or") > 0))
               .withColumn("or_width", F.col("or_high") - F.col("or_low")))


# ---------------------------------------------------------------------------
# pass 2: first breakout
# ---------------------------------------------------------------------------
def first_breakout(px: DataFrame, levels: Measured, p: OrbParams = OrbParams()) -> DataFrame:
    """Earliest post-OR time above the OR high / below the OR low; the earlier
    side wins and a tie goes Short.  Entry price is the level itself."""
    lv = levels.df.select(*KEYS, "or_high", "or_low")
    times = (attach(px.where(_post_or(p)), Measured(lv, levels.rows), KEYS)
             .groupBy(*KEYS)
             .agg(F.min(F.when(F.col("price") > F.col("or_high"), F.col("et"))).alias("t_up"),
                  F.min(F.when(F.col("price") < F.col("or_low"), F.col("et"))).alias("t_down")))
    out = levels.df.join(times, KEYS, "left")
    long_ = _before("t_up", "t_down")
    direction = F.when(long_, F.lit("Long")).when(F.col("t_down").isNotNull(), F.lit("Short"))
    out = out.withColumn("direction", direction)
    is_long = F.col("direction") == "Long"
    return out.withColumns({
        "entry_time": F.when(is_long, F.col("t_up")).otherwise(F.col("t_down")),
        "entry_price": F.when(is_long, F.col("or_high")).when(F.col("direction").isNotNull(), F.col("or_low")),
        "side": F.when(is_long, F.lit(1.0)).when(F.col("direction").isNotNull(), F.lit(-1.0)),
    })


def trade_path(px: DataFrame, brk: Measured, p: OrbParams = OrbParams()) -> DataFrame:
    """Post-OR ticks at or after the entry time (every tick sharing the entry
    timestamp included), with ``q = side * price`` and ``qe = side * entry``."""
    cols = [c for c in brk.df.columns if c not in KEYS]
    trades = Measured(brk.df.where(F.col("direction").isNotNull()).select(*KEYS, *cols), brk.rows)
    return (attach(px.where(_post_or(p)), trades, KEYS)
            .where(F.col("et") >= F.col("entry_time"))
            .withColumn("q", F.col("side") * F.col("price"))
            .withColumn("qe", F.col("side") * F.col("entry_price")))


# ---------------------------------------------------------------------------
# pass 3: path aggregates (MFE/MAE, S0, S1, S4, S2 entry, S3 start)
# ---------------------------------------------------------------------------
def path_stats(path: DataFrame, p: OrbParams = OrbParams()) -> DataFrame:
    q, qe, w = F.col("q"), F.col("qe"), F.col("or_width")
    k = _k()
    carry = ["direction", "entry_time", "entry_price", "side", "or_high", "or_low",
             "or_width", "daily_high", "daily_low"]
    agg = path.groupBy(*KEYS, *carry).agg(
        F.max("q").alias("q_max"),
        F.min("q").alias("q_min"),
        F.max(F.struct(F.col("et"), F.col("record_no"), q.alias("q"))).getField("q").alias("q_last"),
        F.min(F.when(q >= qe + _lit(p.s0_target), k)).alias("s0_t"),
        F.min(F.when(q <= qe - _lit(p.s0_stop), k)).alias("s0_s"),
        F.min(F.when(q >= qe + _lit(p.s1_target), k)).alias("s1_t"),
        F.min(F.when(q <= qe - _lit(p.s1_stop), k)).alias("s1_s"),
        F.min(F.when(q >= qe + _lit(p.s4_target), k)).alias("s4_t"),
        F.min(F.when(q <= qe - _lit(p.s4_stop), k)).alias("s4_s"),
        F.min(F.when((F.col("tod") >= p.t_stop) & (q - qe < _lit(p.s4_min_profit)),
                     F.struct(F.col("et"), F.col("record_no"), q.alias("q")))).alias("s4_x"),
        F.min(F.when(F.col("price") <= F.col("or_low") - _lit(p.s2_buffer), F.col("et"))).alias("s2_time"),
        F.min(F.when(q >= qe + w * _lit(p.s3_stretch), k)).alias("s3_reach"),
        F.min(F.when(F.col("tod") >= p.t_fade, k)).alias("s3_after"),
    )
    return agg.withColumn(
        "s3_from", F.when(F.col("s3_reach").isNotNull() & F.col("s3_after").isNotNull(),
                          F.greatest("s3_reach", "s3_after")))


# ---------------------------------------------------------------------------
# pass 4: S2 walk and the S3 running extreme up to its first eligible tick
# ---------------------------------------------------------------------------
def second_pass(path: DataFrame, stats: Measured, p: OrbParams = OrbParams()) -> DataFrame:
    st = stats.df.select(*KEYS, "s2_time", "s3_from")
    e2 = F.col("or_low") - _lit(p.s2_buffer)
    after2 = F.col("et") >= F.col("s2_time")
    k = _k()
    return (attach(path, Measured(st, stats.rows), KEYS)
            .groupBy(*KEYS)
            .agg(F.max(F.when(k < F.col("s3_from"), F.col("q"))).alias("s3_seed"),
                 F.count_if(k >= F.col("s3_from")).alias("s3_rows"),
                 F.min(F.when(after2 & (F.col("price") <= e2 - _lit(p.s2_target)), k)).alias("s2_t"),
                 F.min(F.when(after2 & (F.col("price") >= e2 + _lit(p.s2_stop)), k)).alias("s2_s")))


# ---------------------------------------------------------------------------
# pass 5: S3 trigger (ordered scan) and pass 6: S3 exit
# ---------------------------------------------------------------------------
def fade_trigger(path: DataFrame, stats: Measured, seeds: Measured,
                 p: OrbParams = OrbParams(), chunk_rows: int = 2_000_000) -> DataFrame:
    st = (stats.df.where(F.col("s3_from").isNotNull())
              .select(*KEYS, "s3_from").join(seeds.df.select(*KEYS, "s3_seed"), KEYS))
    start = Measured(st, stats.rows)
    rows = (attach(path, start, KEYS)
            .where(_k() >= F.col("s3_from"))
            .withColumn("_depth", F.greatest(_lit(p.s3_min_reversal), F.col("or_width"))))
    total = seeds.df.agg(F.sum("s3_rows")).first()[0] or 0
    spark = path.sparkSession
    if total == 0:      # no day reaches the fade's eligibility: skip the scan
        return spark.createDataFrame([], "contract string, session_date date, s3_time timestamp_ntz, "
                                         "s3_rec bigint, s3_q double, s3_ext double")
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(parallel, int(math.ceil(total / float(chunk_rows))))
    hit = first_drawdown(rows.select(*KEYS, "et", "record_no", "q", "s3_seed", "_depth"),
                         KEYS, ["et", "record_no"], "q", "s3_seed", "_depth", chunks)
    return hit.select(*KEYS, F.col("hit.et").alias("s3_time"), F.col("hit.record_no").alias("s3_rec"),
                      F.col("hit.q").alias("s3_q"), F.col("hit.ext").alias("s3_ext"))


def fade_exit(path: DataFrame, trig: Measured, p: OrbParams = OrbParams()) -> DataFrame:
    t = Measured(trig.df.select(*KEYS, "s3_time", "s3_q", "s3_ext"), trig.rows)
    q = F.col("q")
    k = _k()
    return (attach(path, t, KEYS)
            .where(F.col("et") >= F.col("s3_time"))
            .groupBy(*KEYS)
            .agg(F.min(F.when(q <= F.col("s3_q") - _lit(p.s3_target), k)).alias("s3_t"),
                 F.min(F.when(q >= F.col("s3_ext") + _lit(p.s3_stop_beyond), k)).alias("s3_s")))


# ---------------------------------------------------------------------------
# assembly
# ---------------------------------------------------------------------------
def _first_touch(t: str, s: str, target: float, stop: float, otherwise):
    return (F.when(_before(t, s), _lit(target))
             .when(F.col(s).isNotNull(), _lit(-stop))
             .otherwise(otherwise))


def assemble(stats: DataFrame, second: DataFrame | None = None, trig: DataFrame | None = None,
             exit_: DataFrame | None = None, p: OrbParams = OrbParams()) -> DataFrame:
    """Trade rows.  Without ``second`` the S2 and S3 columns are left out,
    without ``trig`` and ``exit_`` those of S3."""
    d = stats
    for part in (second, trig, exit_):
        d = d if part is None else d.join(part, KEYS, "left")
    qe = F.col("qe_")
    d = d.withColumn("qe_", F.col("side") * F.col("entry_price"))
    last_profit = F.col("q_last") - qe
    narrow = F.col("or_width") < _lit(p.width_limit)
    short = F.col("direction") == "Short"

    s0 = _first_touch("s0_t", "s0_s", p.s0_target, p.s0_stop, last_profit)
    s1 = _first_touch("s1_t", "s1_s", p.s1_target, p.s1_stop, last_profit)

    e2 = F.col("or_low") - _lit(p.s2_buffer)
    q_last_price = F.col("side") * F.col("q_last")
    s2_on = short & narrow & F.col("s2_time").isNotNull()

    x_key = F.struct(F.col("s4_x.et").alias("et"), F.col("s4_x.record_no").alias("record_no"))
    x_null = F.col("s4_x").isNull()
    t_first = F.col("s4_t").isNotNull() & (F.col("s4_s").isNull() | (F.col("s4_t") < F.col("s4_s"))) \
        & (x_null | (F.col("s4_t") < x_key))
    s_first = F.col("s4_s").isNotNull() & (F.col("s4_t").isNull() | (F.col("s4_s") < F.col("s4_t"))) \
        & (x_null | (F.col("s4_s") <= x_key))
    s4 = (F.when(t_first, _lit(p.s4_target))
           .when(s_first, _lit(-p.s4_stop))
           .when(~x_null, F.col("s4_x.q") - qe)
           .otherwise(last_profit))

    zero = _lit(0.0)
    s2_columns, s3_columns = [], []
    if second is not None:
        s2 = _first_touch("s2_t", "s2_s", p.s2_target, p.s2_stop, e2 - q_last_price)
        s2_columns = [F.when(s2_on, s2).otherwise(zero).alias("s2_short_pnl"),
                      F.coalesce(s2_on, F.lit(False)).alias("s2_short_trig")]
    if trig is not None:
        s3_on = F.col("s3_time").isNotNull()
        stop_gap = F.col("s3_q") - (F.col("s3_ext") + _lit(p.s3_stop_beyond))
        s3 = (F.when(_before("s3_t", "s3_s"), _lit(p.s3_target))
               .when(F.col("s3_s").isNotNull(), stop_gap)
               .otherwise(F.col("s3_q") - F.col("q_last")))
        s3_columns = [F.when(s3_on, s3).otherwise(zero).alias("s3_fade_pnl"), s3_on.alias("s3_fade_trig")]

    return d.select(
        "contract", F.col("session_date").alias("date"), "direction",
        "or_high", "or_low", "or_width", "daily_high", "daily_low",
        (F.greatest(zero, F.col("q_max") - qe) + zero).alias("mfe"),
        (F.greatest(zero, qe - F.col("q_min")) + zero).alias("mae"),
        F.when(narrow, s1).otherwise(zero).alias("s1_vol_pnl"), narrow.alias("s1_vol_trig"),
        *s2_columns, *s3_columns,
        s4.alias("s4_time_pnl"), F.lit(True).alias("s4_time_trig"),
        F.when(narrow, s4).otherwise(zero).alias("s5_master_pnl"), narrow.alias("s5_master_trig"),
        s0.alias("s0_base_pnl"), F.lit(True).alias("s0_base_trig"),
    )


TRADE_COLUMNS = [
    "contract", "date", "direction", "or_high", "or_low", "or_width", "daily_high", "daily_low",
    "mfe", "mae", "s1_vol_pnl", "s1_vol_trig", "s2_short_pnl", "s2_short_trig",
    "s3_fade_pnl", "s3_fade_trig", "s4_time_pnl", "s4_time_trig", "s5_master_pnl", "s5_master_trig",
]


class Study:
    """All passes of the study over one tick DataFrame; per-day tables are
    materialised once and shared by every output."""

    def __init__(self, ticks: DataFrame, params: OrbParams = OrbParams()):
        self.p = params
        self._ticks = ticks
        self._cache = {}

    @property
    def px(self) -> DataFrame:
        """The narrow price rows, staged once: every pass reads those files,
        and the source and its time-zone work are gone through once."""
        return self._get("px", lambda: materialize(prices(self._ticks, self.p))).df

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def levels(self) -> Measured:
        return self._get("levels", lambda: materialize(session_levels(self.px, self.p)))

    @property
    def breakout(self) -> Measured:
        return self._get("breakout", lambda: materialize(first_breakout(self.px, self.levels, self.p)))

    @property
    def path(self) -> DataFrame:
        return trade_path(self.px, self.breakout, self.p)

    @property
    def stats(self) -> Measured:
        return self._get("stats", lambda: materialize(path_stats(self.path, self.p)))

    @property
    def second(self) -> Measured:
        return self._get("second", lambda: materialize(second_pass(self.path, self.stats, self.p)))

    @property
    def trigger(self) -> Measured:
        return self._get("trigger", lambda: materialize(
            fade_trigger(self.path, self.stats, self.second, self.p)))

    @property
    def fade_exit(self) -> Measured:
        return self._get("exit", lambda: materialize(fade_exit(self.path, self.trigger, self.p)))

    def trades_of(self, *columns: str) -> DataFrame:
        """Trade rows with the given columns.  Only the passes that these need
        are run: the fade scan for S3, the second pass for S2 and S3."""
        s3 = any(c.startswith("s3_") for c in columns)
        s2 = s3 or any(c.startswith("s2_") for c in columns)
        return assemble(self.stats.df, self.second.df if s2 else None, self.trigger.df if s3 else None,
                        self.fade_exit.df if s3 else None, self.p).select(*columns)

    def trades_all(self) -> DataFrame:
        """Trade rows plus the documented-only S0 columns."""
        return self.trades_of(*TRADE_COLUMNS, "s0_base_pnl", "s0_base_trig")

    def trades(self) -> DataFrame:
        return self.trades_all().select(*TRADE_COLUMNS)

    def slices(self) -> DataFrame:
        return session_slices(self.px, self.levels, self.p)

    def summary(self) -> DataFrame:
        """Every valid day: levels, label ('Inside' when no breakout), the two
        fixed-width level texts of the day list."""
        b = self.breakout.df
        return b.select(
            "contract", F.col("session_date").alias("date"),
            F.coalesce(F.col("direction"), F.lit("Inside")).alias("direction"),
            "or_high", "or_low", "or_width", "daily_high", "daily_low",
            format_levels("or_high", "or_low").alias("or_levels"),
            format_levels("daily_high", "daily_low").alias("day_levels"))
