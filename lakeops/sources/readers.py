"""Landing files and tables as DataFrames."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import anti

# Fixed value: file names carry local time this far ahead of UTC.
NAME_CLOCK_AHEAD = timedelta(seconds=19_800)


def read_delimited(spark: SparkSession, paths: str | list[str], delimiter: str = ",") -> DataFrame:
    """Header file(s) with the caller's delimiter, every column text."""
    return spark.read.option("header", True).option("sep", delimiter).csv(paths)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_parquet_set(spark: SparkSession, paths: list[str], merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def read_lake_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    df = spark.table(name)
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df


def name_date(name: Column, pattern: str = r"(\d{8,14})") -> Column:
    """Timestamp from the digits of a file name, right-padded to yyyyMMddHHmmss."""
    digits = F.rpad(F.regexp_extract(name, pattern, 1), 14, "0")
    return F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss"))


def with_file_provenance(df: DataFrame, pattern: str = r"(\d{8,14})") -> DataFrame:
    """Add FILE_NAME (last path segment) and FILE_DATE (from the digits in it)."""
    return df.withColumn("FILE_NAME", F.col("_metadata.file_name")).withColumn("FILE_DATE", name_date(F.col("FILE_NAME"), pattern))


def files_in_window(
    df: DataFrame, start_utc: datetime, end_utc: datetime, pattern: str = r"(\d{8,14})",
    clock_ahead: timedelta = NAME_CLOCK_AHEAD,
) -> DataFrame:
    """Rows of files whose name-date lies in ``(start, end]``.

    The filter is on file metadata, so Spark skips the other files without opening them.
    """
    stamp = name_date(F.col("_metadata.file_name"), pattern)
    text = lambda t: F.lit((t + clock_ahead).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    return df.where((stamp > text(start_utc)) & (stamp <= text(end_utc)))


def only_new_files(incoming: DataFrame, target: DataFrame, name: str = "FILE_NAME") -> DataFrame:
    """Rows from files of which the target holds nothing yet."""
    return anti(incoming, target.select(name).distinct(), [name])
