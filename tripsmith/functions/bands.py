"""Numeric -> label banding (verdicts) as a single CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(col, cuts: Sequence[float], labels: Sequence[str], closed: bool = False) -> Column:
    """Label by the first cut the value is below; the last label is the rest.

    ``band(x, [15, 30], ["a", "b", "c"])`` -> a if x < 15, b if x < 30, else c.  With ``closed``
    a cut itself belongs to the label before it (x <= 15).  Give the unrounded value: a rounded
    one may cross a cut.  NULL input gives NULL.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("labels must be one longer than cuts")
    c = F.col(col) if isinstance(col, str) else col
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        limit = F.lit(float(cut))
        expr = expr.when(c <= limit if closed else c < limit, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))
