"""Rounding used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, places: int) -> Column:
    """Half-even rounding on the scaled double, the way numpy rounds."""
    scale = float(10**places)
    return F.rint(value.cast("double") * F.lit(scale)) / F.lit(scale)
