"""Numeric helpers shared by operators and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(col, digits: int) -> Column:
    """Half-to-even rounding of the scaled binary value (numpy ``around``).

    Written as ``rint(x * 10^d) / 10^d`` so Spark and the SQL oracle
    (``round_even(x * 10^d, 0) / 10^d``) perform the same IEEE operations.
    """
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def rnd_sql(expr: str, digits: int) -> str:
    scale = f"{10 ** digits}e0"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"
