"""Severity of a reading against its device's threshold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Margin above the threshold, and the three levels.
CRITICAL_MARGIN = 5
CRITICAL, WARNING, NORMAL = "CRITICAL", "WARNING", "NORMAL"


def severity(value: Column, threshold: Column) -> Column:
    """Both comparisons are strict; an unknown value or threshold is NORMAL.

    The unit plays no part: a humidity reading is compared like a temperature.
    """
    return (
        F.when(value > threshold + CRITICAL_MARGIN, CRITICAL)
        .when(value > threshold, WARNING)
        .otherwise(NORMAL)
    )
