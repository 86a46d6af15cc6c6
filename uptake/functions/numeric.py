"""Arithmetic that gives the same digits on any partitioning of the data.

Double sums depend on the order of the rows, so quantities with a fixed number
of decimals are summed as decimals and leave as doubles.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
#: Up to 1e21 units; beyond that the cast fails, and what lies below 1e-9 of a unit is rounded.
UNITS = "decimal(30,9)"
SCORE = "decimal(5,1)"
SIGNAL = "decimal(6,3)"


def rnd(value: Column, places: int) -> Column:
    """Round half up, for the non-negative values of this package.

    ``round`` on doubles breaks ties differently from engine to engine; this
    form does not.
    """
    scale = F.lit(10.0**places)
    return F.floor(value * scale + F.lit(0.5)) / scale


def rnd_signed(value: Column, places: int) -> Column:
    """``rnd`` for differences: half away from zero, and never minus zero."""
    size = rnd(F.abs(value), places)
    return F.when((value < F.lit(0.0)) & (size > F.lit(0.0)), -size).otherwise(size)


def exact_mean(value: Column) -> Column:
    """Mean of the known values, each taken to nine decimals."""
    return ratio(exact_sum(value, UNITS), F.count(value))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def exact_sum(value: Column, kind: str = MONEY) -> Column:
    return F.sum(value.cast(kind))


def total(value: Column) -> Column:
    """Sum of a money column as double, 0 when there is nothing to sum."""
    return F.coalesce(exact_sum(value).cast("double"), F.lit(0.0))


def total_where(test: Column, value: Column) -> Column:
    return total(F.when(test, value))


def weighted_mean(value: Column, weight: Column, kind: str = SCORE) -> Column:
    """Sum(value x weight) / sum(weight); NULL when the weights sum to 0.

    Rows with a NULL value keep their weight in the denominator.
    """
    return ratio(F.sum(value.cast(kind) * weight.cast(MONEY)), exact_sum(weight))


def weighted_mean_known(value: Column, weight: Column, kind: str = SIGNAL) -> Column:
    """As ``weighted_mean``, but rows with a NULL value carry no weight either."""
    known = F.when(value.isNotNull(), weight)
    return ratio(F.sum(value.cast(kind) * weight.cast(MONEY)), exact_sum(known))


def headline_score(value: Column, weight: Column) -> Column:
    """Revenue-weighted score with one decimal; 0 when there is no revenue."""
    return F.coalesce(rnd(weighted_mean(value, weight), 1), F.lit(0.0))


def signal(value: Column, weight: Column) -> Column:
    """Revenue-weighted component with two decimals; NULL when never known."""
    return rnd(weighted_mean_known(value, weight), 2)
