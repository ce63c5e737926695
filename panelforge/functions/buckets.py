"""Position of a value among sorted break points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_index(value: Column, breaks: Column, n: int) -> Column:
    """Bucket 1..n of ``value`` among the ``n + 1`` sorted ``breaks``.

    Bucket k holds ``breaks[k-1] <= value < breaks[k]`` with the outer buckets open to both infinities, so
    repeated breaks leave the lower of the equal buckets empty.  Missing values or breaks give NULL.
    """
    passed = F.size(F.filter(breaks, lambda b: b <= value))
    inside = F.greatest(F.lit(1), F.least(F.lit(n), passed))
    return F.when(value.isNotNull() & breaks.isNotNull(), inside)


def even_probabilities(n: int) -> list[float]:
    return [k / n for k in range(n + 1)]
