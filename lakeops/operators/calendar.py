"""The calendar dimension and date spreading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import (
    FISCAL_START_MONTH, fiscal_month, fiscal_quarter, fiscal_year, month_distance, month_week, week_of_year)


def days_between(bounds: DataFrame, start: str, end: str, name: str = "date_dt") -> DataFrame:
    """One row per day for a one-row frame of bounds, both ends included."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias(name))


def days_of(df: DataFrame, date: str, name: str = "date_dt", whole_fiscal_years: bool = False) -> DataFrame:
    """Every day from the first to the last date of a column, or of its fiscal years."""
    d = F.col(date).cast("date")
    first, last = F.min(d), F.max(d)
    if whole_fiscal_years:
        first = F.make_date(fiscal_year(F.min(d)), F.lit(FISCAL_START_MONTH), F.lit(1))
        last = F.date_sub(F.make_date(fiscal_year(F.max(d)) + 1, F.lit(FISCAL_START_MONTH), F.lit(1)), 1)
    return days_between(df.agg(first.alias("__a"), last.alias("__b")), "__a", "__b", name)


def fixed_days(spark: SparkSession, start: str, end: str, name: str = "date_dt") -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("__a"), F.lit(end).cast("date").alias("__b"))
    return days_between(bounds, "__a", "__b", name)


def calendar(days: DataFrame, name: str = "date_dt") -> DataFrame:
    """Calendar and fiscal attributes of each day.

    ``wk_sort`` numbers the month weeks on from 1; a calendar that starts inside a month
    starts at 2, as the counter steps when the week name leaves W1.
    """
    d = F.col(name)
    num = lambda *parts: F.concat(*parts).cast("int")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    text = lambda c: c.cast("string")
    fy = fiscal_year(d)
    fy_start = F.make_date(fy, F.lit(FISCAL_START_MONTH), F.lit(1))
    # Fixed value: January to March weeks follow the 40 weeks of April to December.
    fy_week = F.when(F.month(d) >= FISCAL_START_MONTH, week_of_year(d) - (week_of_year(fy_start) - 1)).otherwise(
        week_of_year(d) + 40)
    start = days.agg(F.min(name).alias("s"))
    s = start.select(F.struct(
        F.trunc("s", "MM").alias("month"), month_week("s").alias("week")).alias("v")).scalar()
    base = days.withColumn("__s", s)
    steps = month_distance(d, F.col("__s.month")) * 4 + month_week(d)
    sort = steps - F.when(F.col("__s.week") == 1, 0).otherwise(F.col("__s.week") - 2)
    month_name, day = F.date_format(d, "MMMM"), F.dayofmonth(d)
    half = F.when(fiscal_month(d) <= 6, F.lit("H1")).otherwise(F.lit("H2"))
    quarter = F.concat(F.lit("Q"), text(fiscal_quarter(d)))
    week = F.concat(F.lit("W"), text(month_week(d)))
    return base.select(
        d.alias("date_dt"),
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        F.dayofyear(d).alias("day_of_yr_num"),
        (F.year(d) * 1000 + F.dayofyear(d)).alias("day_id"),
        F.date_format(d, "EEEE").alias("day_name"),
        day.alias("day_of_month_num"),
        week_of_year(d).alias("week_of_yr_num"),
        num(text(F.year(d)), two(week_of_year(d))).alias("week_id"),
        F.month(d).alias("month_of_yr_num"),
        month_name.alias("month_of_yr_name"),
        (F.year(d) * 100 + F.month(d)).alias("month_id"),
        F.quarter(d).alias("qtr_id"),
        (F.year(d) * 10 + F.quarter(d)).alias("qtr_of_yr_num"),
        F.year(d).alias("yr_name"),
        fy.alias("fy_name"),
        fiscal_month(d).cast("int").alias("fy_month_of_yr_num"),
        fy_week.cast("int").alias("fy_week_of_yr_num"),
        num(text(fy), two(fy_week)).alias("fy_week_id"),
        (fy * 100 + fiscal_month(d)).cast("int").alias("fy_month_id"),
        fiscal_quarter(d).alias("fy_qtr_id"),
        quarter.alias("fy_qtr_name"),
        (fy * 10 + fiscal_quarter(d)).cast("int").alias("fy_qtr_of_yr_num"),
        half.alias("fy_hy_name"),
        F.concat_ws(" ", half, text(fy + 1)).alias("fy_hf_yr_of_yr"),
        F.concat_ws(" ", quarter, text(fy + 1)).alias("fy_qtr_of_yr"),
        F.concat_ws(" ", month_name, text(F.year(d))).alias("fy_month_of_yr"),
        F.concat_ws(" ", text(day), month_name).alias("fy_day_of_month"),
        week.alias("wk_name"),
        F.concat_ws(" ", week, month_name).alias("fy_wk_of_month_name"),
        sort.cast("int").alias("wk_sort"),
    )


def date_dimension(df: DataFrame, date: str) -> DataFrame:
    """Distinct dates of a fact with key, year, month and day."""
    d = F.col(date).cast("date")
    return df.select(d.alias("date")).distinct().select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"), "date",
        F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"))


def repeat_daily(monthly: DataFrame, month: str, days: DataFrame, day: str = "date_dt") -> DataFrame:
    """Each monthly row once per calendar day of its month, values repeated, not divided."""
    right = days.select(F.col(day), F.trunc(day, "MM").alias("__month"))
    left = monthly.withColumn("__key", F.trunc(F.col(month), "MM"))
    return left.join(right, F.col("__key") == F.col("__month")).drop("__key", "__month")
