"""From landing text to typed, clean columns, driven by column metadata."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..functions.columns import DEFAULT_MEMBER, blank_to_null as blank_column, default_member
from ..functions.dates import clock_time, parse_date, serial_date
from .windows import pick_row

# Date text formats of the delivering systems.
DATE_FORMATS = {"file": "dd-MM-yyyy", "erp": "yyyyMMdd"}


@dataclass(frozen=True)
class ColumnMeta:
    source: str
    dest: str
    data_type: str = "string"
    processed: str | None = None


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty text becomes null in every text column, in one projection."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[blank_column(c).alias(c) if c in text else F.col(c) for c in df.columns])


def rename_project(df: DataFrame, meta: list[ColumnMeta]) -> DataFrame:
    """Exactly the mapped columns, renamed, in metadata order."""
    return df.select(*[F.col(m.source).alias(m.dest) for m in meta])


def processed_project(df: DataFrame, meta: list[ColumnMeta]) -> DataFrame:
    """Curated to processed names; a column without a processed name is dropped."""
    return df.select(*[F.col(m.dest).alias(m.processed) for m in meta if m.processed])


def cast_column(c: str, data_type: str, date_format: str, serial: bool = False) -> Column:
    kind = data_type.lower()
    if kind == "date":
        return serial_date(c) if serial else parse_date(c, date_format)
    if kind == "time":
        return clock_time(c)
    if kind in ("string", "text"):
        return F.col(c)
    return F.col(c).try_cast(kind)


def cast_by_meta(df: DataFrame, meta: list[ColumnMeta], date_format: str = DATE_FORMATS["erp"],
                 serial_dates: bool = False) -> DataFrame:
    """Cast text columns to the declared types; text that does not fit becomes null."""
    types = {m.dest: m.data_type for m in meta}
    return df.select(*[
        cast_column(c, types.get(c, "string"), date_format, serial_dates).alias(c) for c in df.columns])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def integral_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Whole numbers that a spreadsheet wrote as '12.0' become '12'; all other text stays as it is."""
    return df.withColumns({c: F.regexp_replace(c, r"^(-?[0-9]+)\.0$", "$1") for c in columns})


def evolve_schema(target: DataFrame, incoming: DataFrame, new_type: str = "decimal(13,2)") -> DataFrame:
    """Target and incoming rows under the union of their columns.

    A landing column the target does not know yet is added with ``new_type``.
    """
    known = set(target.columns)
    typed = incoming.select(*[
        F.col(c) if c in known else F.col(c).try_cast(new_type).alias(c) for c in incoming.columns])
    return target.unionByName(typed, allowMissingColumns=True)


def new_columns(target: DataFrame, incoming: DataFrame) -> list[str]:
    return [c for c in incoming.columns if c not in set(target.columns)]


def default_key_part(df: DataFrame, column: str, default: str = DEFAULT_MEMBER) -> DataFrame:
    return df.withColumn(column, default_member(column, default))


def require_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def drop_null_rows(df: DataFrame, how: str = "any", columns: list[str] | None = None) -> DataFrame:
    return df.dropna(how=how, subset=columns)


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.fillna(defaults)


def dedupe(df: DataFrame, keys: list[str] | None = None, order: list[Column] | None = None) -> DataFrame:
    """Distinct rows, or one row per key: the first by ``order``, then by all columns."""
    return df.distinct() if keys is None else pick_row(df, keys, order or [])


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def stamp_load(df: DataFrame, run_time: str, name: str = "LAST_UPDATED_DT_TS") -> DataFrame:
    return df.withColumn(name, F.lit(run_time).cast("timestamp_ntz"))


def since_watermark(df: DataFrame, column: str, watermark: str | Column | None, inclusive: bool = False) -> DataFrame:
    """Rows newer than the last load; everything when there was none.

    A column (such as a scalar subquery) may give the mark; where it is null, there was no load.
    """
    if isinstance(watermark, Column):
        mark = watermark.cast(df.schema[column].dataType)
        return df.where(mark.isNull() | (F.col(column) >= mark if inclusive else F.col(column) > mark))
    if watermark is None or not str(watermark).strip():
        return df
    mark = F.lit(watermark).cast(df.schema[column].dataType)
    return df.where(F.col(column) >= mark if inclusive else F.col(column) > mark)


def max_watermark(df: DataFrame, column: str, keys: list[str] | None = None, name: str = "watermark") -> DataFrame:
    return df.groupBy(*(keys or [])).agg(F.max(column).alias(name))


def load_counts(df: DataFrame, table: str, day: str | Column) -> DataFrame:
    """Incoming rows per day, to append to the load audit."""
    day = F.col(day) if isinstance(day, str) else day
    return df.groupBy(day.alias("load_date")).agg(F.count(F.lit(1)).alias("incoming_rows")).select(
        F.lit(table).alias("table_name"), "load_date", "incoming_rows")


def audited_load(df: DataFrame, table: str, write: Callable[[DataFrame], object], accept: Column | None = None,
                 watermark: str | None = None) -> DataFrame:
    """Write a load and return its audit row: table_name, incoming, rejected and written rows, next watermark.

    The counts are taken while ``write`` runs its one action over the rows, by observations in its
    plan; nothing is read again for them. Rows for which ``accept`` is not true are rejected; of
    the others ``watermark`` has the highest value, as text, null without any.
    """
    came, went = Observation(), Observation()
    rows = df.observe(came, F.count(F.lit(1)).alias("n"))
    if accept is not None:
        rows = rows.where(accept)
    highest = F.max(F.col(watermark) if watermark else F.lit(None)).cast("string")
    write(rows.observe(went, F.count(F.lit(1)).alias("n"), highest.alias("mark")))
    incoming, written = came.get["n"], went.get
    return df.sparkSession.createDataFrame(
        [(table, incoming, incoming - written["n"], written["n"], written["mark"])],
        "table_name string, incoming_rows bigint, rejected_rows bigint, written_rows bigint, next_watermark string")


def only_language(df: DataFrame, column: str, language: str) -> DataFrame:
    return df.where(F.col(column) == language)
