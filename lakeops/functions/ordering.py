"""Several order columns as one number, so that first and last values are found by a hash aggregate.

Spark aggregates by hash only what it can update in place; a struct of order columns is not, and a
minimum of structs sorts all rows by their key. Columns of fixed width become the digits of one
decimal that orders like the columns do, nulls first.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

MOST_DIGITS = 38
# 0001-01-01 in days from 1970-01-01, and what lifts each type's least value to 0.
FIRST_DAY = -719_162
MICROS = 86_400_000_000
BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _digits(kind: T.DataType, c: Column) -> tuple[int, Column] | None:
    """(digits, a number from 1 up that orders like the column), none for a type without a fixed width."""
    if isinstance(kind, T.BooleanType):
        return 1, c.cast("int") + 1
    if type(kind) in BITS:
        bits = BITS[type(kind)]
        return len(str(2 ** bits)), c.cast("decimal(20,0)") + F.lit(Decimal(2 ** (bits - 1) + 1)).cast("decimal(20,0)")
    if isinstance(kind, T.DateType):
        return 7, F.unix_date(c) - FIRST_DAY + 1
    if isinstance(kind, T.TimestampNTZType):
        days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
        seconds = (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
        return 18, (days - FIRST_DAY) * MICROS + seconds + 1
    if isinstance(kind, T.TimestampType):
        return 18, F.unix_micros(c) - FIRST_DAY * MICROS + 1
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        shifted = (c * F.lit(10 ** kind.scale)).cast(f"decimal({kind.precision},0)").cast("decimal(20,0)")
        return kind.precision + 1, shifted + F.lit(Decimal(10 ** kind.precision)).cast("decimal(20,0)")
    return None


def packed(df: DataFrame, columns: list[str]) -> Column | None:
    """The columns as one decimal in their order, nulls first; none if a type has no fixed width or they are too long."""
    parts = [_digits(df.schema[c].dataType, F.col(c)) for c in columns]
    if any(p is None for p in parts) or sum(digits for digits, _ in parts) > MOST_DIGITS:
        return None
    whole, after = None, sum(digits for digits, _ in parts)
    for digits, number in parts:
        after -= digits
        part = (F.coalesce(number, F.lit(0)).cast("decimal(20,0)") * F.lit(Decimal(10 ** after)).cast(f"decimal({after + 1},0)")).cast(f"decimal({MOST_DIGITS},0)")
        whole = part if whole is None else (whole + part).cast(f"decimal({MOST_DIGITS},0)")
    return whole


def rank(df: DataFrame, columns: list[str]) -> Column:
    """What minima and maxima over several columns go by: one decimal where it can be, else a struct."""
    number = packed(df, columns)
    return F.struct(*columns) if number is None else number
