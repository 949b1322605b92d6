"""Sums that do not depend on row order, and the safe mean."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Sums go through a decimal, so that they give the same bits whichever task or retry adds
# the rows up: 13 digits before the point per value, 15 behind it, 10 more for the sum.
VALUE_DECIMAL = "decimal(28,15)"
SUM_PRECISION, SUM_SCALE = 38, 15
LARGEST, SMALLEST = 1e13, 1e-15


def holdable(value: Column) -> Column:
    """Whether sums can hold a value: below ``LARGEST``, and 0 or not below ``SMALLEST``."""
    size = F.abs(value)
    return (size < LARGEST) & ((size == 0) | (size >= SMALLEST))


def exact(value: Column) -> Column:
    return value.cast(VALUE_DECIMAL)


def exact_sum(value: Column) -> Column:
    return F.sum(exact(value)).cast("double")


def safe_mean(total: Column, count: Column) -> Column:
    """total / count, and 0 where nothing was counted."""
    return F.when(count == 0, F.lit(0.0)).otherwise(total / F.nullif(count, F.lit(0)).cast("double"))
