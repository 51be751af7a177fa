"""Derived report measures (all built-in column expressions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_income_protection


def annual_multiplier(benefit_name: Column) -> Column:
    """12 for monthly Income Protection cover, else 1."""
    return F.when(is_income_protection(benefit_name), 12).otherwise(1)


def annual_sum_insured(cover: Column, benefit_name: Column) -> Column:
    return cover * annual_multiplier(benefit_name)


def source_of_claim(description: Column, duration_factor: Column, code: Column) -> Column:
    return F.coalesce(description, duration_factor, code)


def waiting_period_total(period: Column, extension: Column) -> Column:
    """Null when either part is null."""
    return period + extension


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def sc_cover_for_income_protection(benefit_sc: Column, benefit_name: Column) -> Column:
    """Super-contribution cover counts only on Income Protection rows: 0 otherwise,
    and a missing cover stays missing."""
    return benefit_sc * is_income_protection(benefit_name).cast("int")


def sum_insured_combined(cover: Column, add: Column, sc: Column, sc_add: Column,
                         benefit_name: Column) -> Column:
    """``(cover + add + sc + sc_add) x (12 or 1)``; supplements count 0 when
    missing, a missing own cover makes the total missing."""
    total = cover + zero_if_null(add) + zero_if_null(sc) + zero_if_null(sc_add)
    return total * annual_multiplier(benefit_name)


def total_payg(total_paid: Column, total_paid_sc: Column) -> Column:
    """Own payments plus super-contribution payments (other supplements are not
    added); a missing own total stays missing."""
    return total_paid + zero_if_null(total_paid_sc)


def income_protection_only(value: Column, benefit_name: Column) -> Column:
    """``value`` on Income Protection rows, else null."""
    return F.when(is_income_protection(benefit_name), value)


def days_on_claim(first: Column, last: Column, benefit_name: Column) -> Column:
    """Whole days from first to last payment (may be negative), Income Protection only."""
    return income_protection_only(F.datediff(last, first).cast("double"), benefit_name)
