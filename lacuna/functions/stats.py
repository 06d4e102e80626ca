"""Aggregate expressions for the error metrics (D14–D17) and guarded statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinel results of the normalised errors
NRMSE_FLAT_MAX = -10000000000.0
MASK_VALUE = -999.0


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def nmae(real, pred) -> Column:
    """mean(|r − p|) / max(r); 0 when max(r) = 0."""
    r, p = _c(real), _c(pred)
    mx = F.max(r)
    return F.when(mx == 0, F.lit(0.0)).otherwise(F.avg(F.abs(r - p)) / mx)


def nrmse(real, pred) -> Column:
    """|sqrt(mean((r − p)²)) / max(r)|; −1e10 when max(r) = 0."""
    r, p = _c(real), _c(pred)
    mx = F.max(r)
    return F.when(mx == 0, F.lit(NRMSE_FLAT_MAX)).otherwise(F.abs(F.sqrt(F.avg((r - p) * (r - p))) / mx))


def strict(metric: Column, real, pred) -> Column:
    """NaN-propagating variant: null as soon as one truth or prediction in the group is null."""
    r, p = _c(real), _c(pred)
    n = F.count(F.lit(1))
    return F.when((F.count(r) < n) | (F.count(p) < n), F.lit(None)).otherwise(metric)


def nse_parts(real, pred, mean_real) -> tuple[Column, Column]:
    r, p, m = _c(real), _c(pred), _c(mean_real)
    return F.sum((r - p) * (r - p)), F.sum((r - m) * (r - m))


def masked_mse(real, pred, mask_value: float = MASK_VALUE) -> Column:
    r, p = _c(real), _c(pred)
    return F.avg(F.when(r != mask_value, (r - p) * (r - p)))


def guarded_corr(a, b) -> Column:
    """Pearson correlation, null when either side is constant (ANSI corr would divide by zero)."""
    x, y = _c(a), _c(b)
    sx, sy = F.stddev_pop(x), F.stddev_pop(y)
    return F.when((sx == 0) | (sy == 0) | sx.isNull() | sy.isNull(), F.lit(None)).otherwise(F.covar_pop(x, y) / (sx * sy))
