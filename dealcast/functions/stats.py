"""Null-safe statistics expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_corr(x, y) -> Column:
    """Pearson r as covar_pop / (sd_x * sd_y); null when either variance is zero.

    Spark's built-in ``corr`` raises DIVIDE_BY_ZERO under ANSI mode on a constant
    column; a constant feature is normal here (e.g. a lag that is all zeros).
    """
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    y = (F.col(y) if isinstance(y, str) else y).cast("double")
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def sql_safe_corr(x: str, y: str) -> str:
    return (f"CASE WHEN stddev_pop({x}) * stddev_pop({y}) = 0 THEN NULL "
            f"ELSE covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END")
