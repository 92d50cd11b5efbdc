"""Error-metric aggregate expressions (AG7-AG9, FLT9).

Each is a declarative aggregate, so Spark computes it with a partial
(map-side) and a final phase: no rows are gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mape(actual: Column | str, pred: Column | str) -> Column:
    """AG7 + FLT9: 100 * mean(|a - p| / a) over a > 0; 0.0 when no a > 0."""
    a, p = _c(actual), _c(pred)
    ape = F.when(a > 0, F.abs(a - p) / a)
    return F.coalesce(F.avg(ape) * F.lit(100.0), F.lit(0.0))


def rmse(actual: Column | str, pred: Column | str) -> Column:
    """AG8: no mask."""
    return F.sqrt(F.avg(F.pow(_c(actual) - _c(pred), 2)))


def mae(actual: Column | str, pred: Column | str) -> Column:
    """AG9: no mask."""
    return F.avg(F.abs(_c(actual) - _c(pred)))
