"""Forecast to purchases, component requirements and final stock."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidestock.operators.forecast import (
    baseline_prediction,
    forecast_detail,
    forecast_features,
    forecast_monthly,
)
from tidestock.operators.replenish import (
    bom_explode,
    component_requirements,
    fg_requirements,
    final_stock,
    purchases,
)
from tidestock.session import staged
from tidestock.sources.masterdata import require_unique_items


def baseline_detail(daily: DataFrame, months: int = 12) -> DataFrame:
    """Forecast detail of the seasonal-mean predictor."""
    return forecast_detail(baseline_prediction(forecast_features(daily, months)))


def run_planning(
    detail: DataFrame,
    bom: DataFrame,
    stock_fg: DataFrame,
    stock_comp: DataFrame,
    stage: bool = False,
) -> dict[str, DataFrame]:
    """The ten planning tables as lazy frames.

    ``stage`` writes the forecast detail and the finished-goods plan once, for callers that
    consume many of the tables; a caller of one table leaves it off.
    """
    if stage:
        detail = staged(detail, "forecast-detail")
    requirements = fg_requirements(detail)
    fg_plan = purchases(requirements, require_unique_items(stock_fg))
    if stage:
        fg_plan = staged(fg_plan, "fg-plan")
    comp_need = component_requirements(bom_explode(bom, fg_plan))
    comp_plan = purchases(comp_need, require_unique_items(stock_comp))
    return {
        "bom": bom,
        "stock_fg": stock_fg,
        "stock_comp": stock_comp,
        "requirements_fg": requirements,
        "purchases_fg": fg_plan,
        "requirements_comp": comp_need,
        "purchases_comp": comp_plan,
        "final_stock_fg": final_stock(fg_plan),
        "final_stock_comp": final_stock(comp_plan),
        "monthly_revenue": forecast_monthly(detail),
    }
