"""Classification of cost curves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Forecast types and the curve they stand for.
ACTUAL_TYPES = ("ACTUALS", "ACTUAL")
FORECAST_TYPES = ("FC", "FORECAST")
CURVES = ("ACTUAL", "BUDGET", "FORECAST")


def curve_type(forecast_type: Column, source_curve: Column) -> Column:
    """The forecast type decides; otherwise the source value in upper case; otherwise missing."""
    kind = F.upper(forecast_type)
    return (
        F.when(kind.isin(*ACTUAL_TYPES), F.lit("ACTUAL"))
        .when(kind.isin(*FORECAST_TYPES), F.lit("FORECAST"))
        .otherwise(F.upper(source_curve))
    )
