"""Calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.functions.casts import date_key


def build(
    spark: SparkSession,
    start: str | dt.date = "2024-01-01",
    end: str | dt.date = "2027-12-31",
    holidays: DataFrame | None = None,
) -> DataFrame:
    """One row per day from start to end; ``holidays`` is an optional frame with a ``full_date`` column."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias("full_date")
    )
    day = F.col("full_date")
    calendar = days.select(
        date_key(day).alias("date_key"),
        day,
        (F.weekday(day) + 1).cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.day(day).cast("smallint").alias("day_of_month"),
        F.dayofyear(day).cast("smallint").alias("day_of_year"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        F.month(day).cast("smallint").alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("smallint").alias("quarter_number"),
        F.year(day).cast("smallint").alias("year_number"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )
    if holidays is None:
        return calendar.withColumn("is_public_holiday", F.lit(False))
    marked = holidays.select("full_date").distinct().withColumn("is_public_holiday", F.lit(True))
    return calendar.join(marked, "full_date", "left").select(
        *calendar.columns, F.coalesce("is_public_holiday", F.lit(False)).alias("is_public_holiday")
    )
