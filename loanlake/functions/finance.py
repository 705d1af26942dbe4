"""Lending arithmetic and classifications as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlake import schema


def round_cents(value: Column) -> Column:
    """Two places, ties to even."""
    return F.rint(value * 100) / 100


def exact_sum(amount: Column) -> Column:
    """Sum of amounts in cents, the same in whatever order they are added.

    Amounts are added as decimals of six places. Only where one does not fit those
    (or is infinite) the sum is that of doubles.
    """
    exact = amount.try_cast("decimal(28,6)")
    unfit = F.count_if(exact.isNull() & amount.isNotNull())
    total = F.when(unfit == 0, F.sum(exact)).cast("double")
    return round_cents(F.when(unfit == 0, total).otherwise(F.sum(amount)))


def monthly_payment(principal: Column, annual_rate_pct: Column, term_months: Column) -> Column:
    """Annuity payment; without a positive rate the principal in equal parts.

    A missing term counts as 60 months. A zero term has no payment: NULL, as has
    one so long that its growth factor overflows.
    """
    rate = annual_rate_pct / 100 / 12
    term = F.coalesce(term_months, F.lit(schema.DEFAULT_TERM_MONTHS).cast("double"))
    growth = F.pow(1 + rate, term)
    annuity = principal * F.try_divide(rate * growth, growth - 1)
    payment = F.when(rate > 0, annuity).otherwise(F.try_divide(principal, term))
    return round_cents(F.nullif(payment, F.lit(float("nan"))))


def _first_above(value: Column, limits: dict[int, str], otherwise: str) -> Column:
    result = F
    for limit, label in limits.items():
        result = result.when(value > limit, label)
    return result.otherwise(otherwise)


def loan_segment(amount: Column) -> Column:
    """Four sizes; an unknown amount falls into the smallest."""
    return _first_above(amount, schema.LOAN_SEGMENT_ABOVE, schema.SMALLEST_SEGMENT)


def value_tier(amount: Column) -> Column:
    """Three sizes of the slim mart; an unknown amount falls into the lowest."""
    return _first_above(amount, schema.VALUE_TIER_ABOVE, schema.LOWEST_TIER)


def credit_band(score: Column) -> Column:
    """Band of the cleaned bureau table: open below, closed above, NULL outside."""
    band = F
    for label, above, up_to in schema.CREDIT_BAND_LIMITS:
        band = band.when((score > above) & (score <= up_to), label)
    return band


def report_band(score: Column) -> Column:
    """Band of the default report, on other limits: whatever fits none is the best."""
    *bands, (best, _, _) = schema.REPORT_BANDS
    band = F
    for label, lowest, highest in bands:
        fits = score < highest if lowest is None else score.between(lowest, highest)
        band = band.when(fits, label)
    return band.otherwise(best)


def is_delinquent(days_overdue: Column) -> Column:
    return F.coalesce(days_overdue, F.lit(0)) > schema.DELINQUENT_AFTER_DAYS


def is_future(date: Column, as_of: Column) -> Column:
    return F.coalesce(date > as_of, F.lit(False))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def is_high_risk(delinquent_payments: Column, band: Column) -> Column:
    """Three-valued: NULL when nothing is overdue and the band is unknown."""
    return (or_zero(delinquent_payments) > 0) | band.isin(*schema.HIGH_RISK_BANDS)
