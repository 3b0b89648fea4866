"""Date and month-key expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# Spelled out because date_format('MMM') follows the JVM's locale.
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def month_key(day: Column) -> Column:
    """Integer yyyymm; NULL for NULL."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def month_name(day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_NAMES)), F.month(day))


def quarter_name(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"))


def date_lit(day: date) -> Column:
    return F.lit(day).cast("date")


def first_trailing_month(as_of: date, months: int) -> int:
    """yyyymm of the first month of a trailing window that ends with ``as_of``'s month."""
    index = as_of.year * 12 + as_of.month - months
    return index // 12 * 100 + index % 12 + 1


def tenure_days(hired: Column, left: Column, as_of: date) -> Column:
    """Days from hire to leaving, or to the snapshot for those still here."""
    return F.datediff(F.coalesce(left, date_lit(as_of)), hired)


def hashed_departure(
    employee_number: Column, hired: Column, as_of: date, spread_days: int, minimum_service: int
) -> Column:
    """A reproducible leaving date before the snapshot, at least ``minimum_service`` days after hire.

    The hash is the first eight hexadecimal digits of the number's MD5, which any engine can
    repeat. ``greatest`` would skip a missing hire date, hence the guard.
    """
    digits = F.substring(F.md5(employee_number.cast("string").cast("binary")), 1, 8)
    offset = (F.conv(digits, 16, 10).cast("bigint") % F.lit(spread_days)).cast("int")
    drawn = F.date_sub(date_lit(as_of), offset)
    return F.when(hired.isNotNull(), F.greatest(drawn, F.date_add(hired, minimum_service)))
