"""A fence for costly expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def once(column: Column) -> Column:
    """``column`` as the output of a one-row explode, for use in a ``select``.

    The optimizer puts a projected expression into every filter it pushes below the projection, and each copy is
    evaluated; it does not see into a generator. Filters on other columns still move past it to the scan.
    """
    return F.explode(F.array(column))
