"""E2: aggregates -> both models -> roll-outs -> history + forecast export."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerflow.operators import aggregate as G
from ledgerflow.operators import forecast as FC


@dataclass
class ForecastResult:
    aggregates: dict
    linear_metrics: DataFrame
    linear_coefficients: DataFrame
    linear_6: DataFrame
    linear_12: DataFrame
    export: DataFrame
    separation: DataFrame
    gbt_metrics: DataFrame | None = None
    gbt_importance: DataFrame | None = None
    gbt_6: DataFrame | None = None
    comparison: DataFrame | None = None


def run_forecast(olap: DataFrame, series_keys: Sequence[str] = (), with_gbt: bool = True) -> ForecastResult:
    aggs = G.aggregate_all(olap, as_double=False)
    monthly = aggs["mensile"]
    pred, coef = FC.linear_cv(monthly, series_keys)
    lr6 = FC.rollout_linear(monthly, coef, 6, series_keys)
    lr12 = FC.rollout_linear(monthly, coef, 12, series_keys)
    res = ForecastResult(aggregates=aggs, linear_metrics=FC.fold_metrics(pred, series_keys),
                         linear_coefficients=coef, linear_6=lr6, linear_12=lr12,
                         export=FC.history_plus_forecast(monthly, lr6, series_keys),
                         separation=FC.separation_date(monthly, series_keys))
    if with_gbt:
        gpred, models = FC.gbt_cv(monthly, series_keys)
        res.gbt_metrics = FC.fold_metrics(gpred, series_keys, model="GBT")
        res.gbt_importance = FC.gbt_importance(models, series_keys)
        res.gbt_6 = FC.rollout_gbt(monthly, models, 6, series_keys)
        res.comparison = FC.compare_models(monthly, {"LINEAR": lr6, "GBT": res.gbt_6}, series_keys)
    return res
