"""The whole study as one job: ticks -> trade table -> the three reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickline.operators.clean import standardize_ticks
from tickline.operators.orb import OrbParams, Study
from tickline.operators.reports import risk_by_target, strategy_comparison


def run_study(ticks: DataFrame, params: OrbParams = OrbParams(), results_path: str | None = None) -> dict:
    """All contracts at once (the per-file loop disappears: days are keyed by
    contract).  Returns the trade table, the day list and the reports;
    optionally writes the trade table as CSV."""
    study = Study(standardize_ticks(ticks), params)
    trades = study.trades()
    out = {
        "trades": trades,
        "summary": study.summary(),
        "risk_long": risk_by_target(trades.where("direction = 'Long'"), params.targets),
        "risk_short": risk_by_target(trades.where("direction = 'Short'"), params.targets),
        "comparison": strategy_comparison(trades),
    }
    if results_path:
        from tickline.sources.files import results_csv
        results_csv(trades, results_path)
    return out
