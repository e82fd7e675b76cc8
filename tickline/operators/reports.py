"""Study reports over the trade table (one row per traded day)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Strategy labels of the comparison table, in report order,
# with their pnl / trigger columns.
STRATEGIES = [
    ("S1: Vol Filter (<5pt)", "s1_vol_pnl", "s1_vol_trig"),
    ("S2: Short Bias (30/20)", "s2_short_pnl", "s2_short_trig"),
    ("S3: Peak Fade (15/15)", "s3_fade_pnl", "s3_fade_trig"),
    ("S4: Time Exit (11:30)", "s4_time_pnl", "s4_time_trig"),
    ("S5: Master (S1 + S4)", "s5_master_pnl", "s5_master_trig"),
]


def risk_by_target(trades: DataFrame, targets=(4, 7.5, 10, 15, 20)) -> DataFrame:
    """Per direction and MFE target: trades, winners (MFE >= target), win rate %,
    mean and 90th percentile (linear interpolation) of winners' MAE.
    The exact percentile keeps the different MAE values of a (direction, target)
    with their counts in one buffer: at most one for each traded contract and day.
    A direction with no trades has no rows; a target with no winners has a
    0.0 win rate and null MAE figures."""
    arr = F.array(*[F.lit(float(t)) for t in targets])
    win = F.col("mfe") >= F.col("target")
    g = (trades.where(F.col("direction").isNotNull())
               .select("direction", "mfe", "mae", F.explode(arr).alias("target"))
               .groupBy("direction", "target")
               .agg(F.count(F.lit(1)).alias("trades"),
                    F.count_if(win).alias("winners"),
                    F.avg(F.when(win, F.col("mae"))).alias("avg_mae"),
                    F.percentile(F.when(win, F.col("mae")), F.lit(0.9)).alias("p90_mae")))
    return g.select("direction", "target", "trades", "winners",
                    ((F.col("winners") / F.col("trades")) * F.lit(100.0)).alias("win_rate"),
                    "avg_mae", "p90_mae")


def strategy_comparison(trades: DataFrame, strategies=STRATEGIES) -> DataFrame:
    """Per strategy over its triggered trades: win % (pnl > 0), total points,
    average trade, N; nulls when nothing triggered."""
    n = len(strategies)
    args = ", ".join(f"'{label}', {pnl}, {trig}" for label, pnl, trig in strategies)
    long_ = trades.selectExpr(f"stack({n}, {args}) as (strategy, pnl, trig)")
    g = (long_.groupBy("strategy")
              .agg(F.count_if(F.col("trig")).alias("n"),
                   F.count_if(F.col("trig") & (F.col("pnl") > 0)).alias("wins"),
                   F.sum(F.when(F.col("trig"), F.col("pnl"))).alias("total_pts")))
    has = F.col("n") > 0
    return g.select(
        "strategy",
        F.when(has, (F.col("wins") / F.col("n")) * F.lit(100.0)).alias("win_rate"),
        F.when(has, F.col("total_pts")).alias("total_pts"),
        F.when(has, F.col("total_pts") / F.col("n")).alias("avg_trade"),
        "n")
