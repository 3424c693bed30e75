"""Breakpoint tables for PM2.5 concentrations and the expressions built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound (inclusive) and name of each PM2.5 band.
PM25_BANDS = (
    (9.0, "Good"),
    (35.4, "Moderate"),
    (55.4, "Unhealthy for Sensitive"),
    (125.4, "Unhealthy"),
    (225.4, "Very Unhealthy"),
)
PM25_ABOVE = "Hazardous"
PM25_MISSING = "Unknown"

# Concentration low, concentration high, index low, index high.
AQI_SEGMENTS = (
    (0.0, 9.0, 0.0, 50.0),
    (9.1, 35.4, 51.0, 100.0),
    (35.5, 55.4, 101.0, 150.0),
    (55.5, 125.4, 151.0, 200.0),
    (125.5, 225.4, 201.0, 300.0),
    (225.5, 500.0, 301.0, 500.0),
)
AQI_CAP = 500


def band_of(
    value: Column,
    bands: Sequence[tuple[float, str]] = PM25_BANDS,
    above: str = PM25_ABOVE,
    missing: str = PM25_MISSING,
) -> Column:
    """Name of the first band whose upper bound is not exceeded. NaN is above every bound."""
    chain = F.when(value.isNull(), missing)
    for upper, name in bands:
        chain = chain.when(value <= upper, name)
    return chain.otherwise(above)


def piecewise_index(
    value: Column,
    segments: Sequence[tuple[float, float, float, float]] = AQI_SEGMENTS,
    cap: int = AQI_CAP,
) -> Column:
    """Piecewise-linear index, rounded to an integer; NULL stays NULL, beyond the last is `cap`."""
    chain = F.when(value.isNull(), F.lit(None).cast("int"))
    for c_lo, c_hi, i_lo, i_hi in segments:
        slope = (i_hi - i_lo) / (c_hi - c_lo)
        chain = chain.when(value <= c_hi, F.round((value - c_lo) * slope + i_lo).cast("int"))
    return chain.otherwise(F.lit(cap))
