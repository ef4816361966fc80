"""Billing rules as column expressions: aging, reconciliation, age and allocation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# Labels and limits of the aging and reconciliation rules.
BUCKETS = [(30, "0-30"), (60, "31-60"), (90, "61-90")]
LAST_BUCKET = "90+"
PAID_MARK = "y"
UNPAID, PAID_FULL, PAID_LESS, PAID_MORE = "nao_pago", "pago_integral", "pago_a_menor", "pago_a_maior"
TOLERANCE = 0.01


def days_overdue(due: Column, reference: date | Column) -> Column:
    """Days past the due day, never below zero; null for a null due day."""
    return F.when(due.isNotNull(), F.greatest(F.datediff(F.lit(reference), due), F.lit(0))).cast("bigint")


def aging_bucket(days: Column) -> Column:
    """Name of the aging range; null for null days."""
    label = F.when(days.isNull(), F.lit(None).cast("string"))
    for limit, name in BUCKETS:
        label = label.when(days <= limit, name)
    return label.otherwise(LAST_BUCKET)


def same_amount(left: Column, right: Column) -> Column:
    """Two doubles closer than the tolerance."""
    return F.abs(left - right) < TOLERANCE


def payment_status(paid_flag: Column, billed: Column, paid: Column) -> Column:
    """Unpaid, paid in full, paid less or paid more.

    A null flag is unpaid. Flagged paid with an unknown amount counts as paid
    more, since no comparison with null holds.
    """
    return (
        F.when(~paid_flag.eqNullSafe(PAID_MARK), UNPAID)
        .when(same_amount(paid, billed), PAID_FULL)
        .when(paid < billed, PAID_LESS)
        .otherwise(PAID_MORE)
    )


def payment_difference(billed: Column, paid: Column) -> Column:
    """Paid minus billed, negative when too little was paid."""
    return paid - billed


def age_years(birth: Column, reference: date | Column) -> Column:
    """Completed years on a day. A 29 February birthday is completed on 1 March."""
    day = F.lit(reference)
    before_birthday = F.struct(F.month(day), F.dayofmonth(day)) < F.struct(F.month(birth), F.dayofmonth(birth))
    return (F.year(day) - F.year(birth) - F.when(before_birthday, 1).otherwise(0)).cast("bigint")


def share(value: Column, parts: Column) -> Column:
    """Value split evenly; null where there is nothing to split over."""
    return F.try_divide(value, parts)
