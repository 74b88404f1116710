"""Numbers with gaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(value: Column) -> Column:
    """The number, or NULL where it is NaN: sums, means and counts pass over both."""
    return F.when(~F.isnan(F.coalesce(value.try_cast("double"), F.lit(0.0))), value)
