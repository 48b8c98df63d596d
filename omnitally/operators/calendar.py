"""Date dimension and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sunday_week(d: Column) -> Column:
    """Week of year with Sunday-start weeks, week 1 = the week holding 1 January.

    The Saturday closing d's week decides the year; its day-of-year gives the week.
    (Spark's ``weekofyear`` is ISO and differs.)
    """
    saturday = F.date_add(d, (F.lit(7) - F.dayofweek(d)).cast("int"))
    return F.ceil(F.dayofyear(saturday) / 7).cast("int")


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day from Jan 1 of (year-3) to Dec 31 of (year+1).

    ``bounds`` is a one-row DataFrame with column ``year`` (derived from the data).
    """
    return date_attributes(days_of_years(bounds.select((F.col("year") - 3).alias("first"), (F.col("year") + 1).alias("last"))))


def days_of_years(bounds: DataFrame) -> DataFrame:
    """One row per day from 1 January of ``first`` to 31 December of ``last``."""
    return bounds.select(F.explode(F.sequence(F.make_date(F.col("first"), F.lit(1), F.lit(1)),
                                              F.make_date(F.col("last"), F.lit(12), F.lit(31)))).alias("date"))


def date_attributes(days: DataFrame) -> DataFrame:
    """The calendar columns of the date dimension for a table of days."""
    dow0 = (F.dayofweek("date") - 1).cast("int")
    return days.select(
        "date",
        F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        dow0.alias("day"), sunday_week(F.col("date")).alias("week"),
        dow0.isin(0, 6).alias("is_weekend"), F.dayofmonth("date").alias("day_of_month"))
