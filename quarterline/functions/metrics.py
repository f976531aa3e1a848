"""Metric expressions usable inside any ``agg`` (X4): no UDAF needed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def smape_term(y, p, eps: float = 1e-6) -> Column:
    """2*|y-p| / (|y|+|p|+eps) for one element."""
    y, p = _col(y), _col(p)
    return F.lit(2.0) * F.abs(y - p) / (F.abs(y) + F.abs(p) + F.lit(eps))


def masked_smape(y, p, mask, eps: float = 1e-6) -> Column:
    """A13 aggregate: sum(mask * term) / sum(mask); 0 when the mask sums to 0."""
    m = _col(mask).cast("double")
    num = F.sum(m * smape_term(y, p, eps))
    den = F.sum(m)
    return F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(num, den))


def nonzero_mask(y) -> Column:
    """Q8 documented alternative: score only where the truth is non-zero."""
    return (_col(y) != 0).cast("double")
