"""Exact rates, shares and the banded score.

Rounding is half away from zero on the exact quotient.  For non-negative
integers it is done in bigint arithmetic, which no floating-point error can
tip over: round(scale * a / b, d) = ((2 * scale * 10^d * a + b) div 2b) / 10^d.
Bigint holds numerators up to 4.6e18 / (scale * 10^d), i.e. 4.6e12 for the
largest factor used (per mille, three digits); beyond that ANSI mode raises
rather than returning a wrong figure.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from occrisk.functions import labels as L


def scaled_quotient(num: Column, den: Column, factor: int) -> Column:
    """``round(num * factor / den)`` as bigint; NULL where ``den`` is 0 or NULL."""
    n, d = num.cast("bigint"), den.cast("bigint")
    return F.when(d > 0, F.call_function("div", n * (2 * factor) + d, d * 2))


def _rounded(num: Column, den: Column, scale: int, digits: int) -> Column:
    unit = 10**digits
    return scaled_quotient(num, den, scale * unit).cast("double") / F.lit(float(unit))


def rate_per_mille(num: Column, exposure: Column, digits: int) -> Column:
    return _rounded(num, exposure, 1000, digits)


def share_pct(part: Column, whole: Column, digits: int) -> Column:
    return _rounded(part, whole, 100, digits)


def ppm(num: Column, den: Column) -> Column:
    """Quotient in parts per million, i.e. the quotient rounded to 6 digits."""
    return scaled_quotient(num, den, 1_000_000)


def from_ppm(value: Column) -> Column:
    return value.cast("double") / F.lit(1e6)


def base_score(rate_ppm: Column) -> Column:
    out = F.when(rate_ppm.isNull(), F.lit(None).cast("int"))
    for score, limit in enumerate(L.SCORE_LIMITS_PPM, start=1):
        out = out.when(rate_ppm < limit, score)
    return out.otherwise(L.TOP_SCORE)


def fatality_aggravator(fatality_ppm: Column) -> Column:
    return F.when(fatality_ppm > L.FATALITY_LIMIT_PPM, 1).otherwise(0)


def risk_score(rate_ppm: Column, fatality_ppm: Column) -> Column:
    base = base_score(rate_ppm)
    raised = F.least(base + fatality_aggravator(fatality_ppm), F.lit(L.TOP_SCORE))
    return F.when(base.isNotNull(), raised)
