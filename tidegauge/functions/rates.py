"""Guarded ratios. ANSI mode raises on x/0, so every division sits behind a ``when``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def conversion_rate(purchases: Column, clicks: Column) -> Column:
    """Purchases per hundred clicks at two decimals; 0 without clicks, may pass 100."""
    return (F.when(clicks > 0, F.round(purchases / clicks * 100, 2))
            .otherwise(F.lit(0.0)))


def overall_rate(purchases: Column, clicks: Column) -> Column:
    """As :func:`conversion_rate`, unrounded."""
    return F.when(clicks > 0, purchases / clicks * 100).otherwise(F.lit(0.0))


def funnel_rate(purchases: Column, clicks: Column) -> Column:
    """Purchases per hundred clicks where no clicks count as one."""
    return purchases / F.when(clicks == 0, F.lit(1)).otherwise(clicks) * 100


def mean_of(total: Column, n: Column) -> Column:
    """``total / n`` at two decimals, null without rows.

    The sum is cut to six decimals first: a distributed double sum depends on the
    order of its terms, and two-decimal prices often average to an exact half cent.
    """
    return F.when(n > 0, F.round(F.rint(total * 1e6) / 1e6 / n, 2))


def mean_or_zero(total: Column, n: Column) -> Column:
    return F.coalesce(mean_of(total, n), F.lit(0.0))
