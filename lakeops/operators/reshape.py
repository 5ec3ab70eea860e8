"""Pivots, unpivots and other changes of shape."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import as_col
from ..functions.dates import FISCAL_MONTHS, sheet_date, sheet_month_number


def unpivot(df: DataFrame, ids: list[str], columns: list[str] | None = None, name: str = "name",
            value: str = "value", cast: str | None = None, drop_null: bool = False) -> DataFrame:
    """Columns to rows; without ``columns`` every column that is not an id."""
    columns = columns or [c for c in df.columns if c not in ids]
    if cast:
        df = df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in columns])
    out = df.unpivot(ids, columns, name, value)
    return out.where(F.col(value).isNotNull()) if drop_null else out


def unpivot_groups(df: DataFrame, ids: list[str], groups: dict[str, list[str]], name: str,
                   values: list[str]) -> DataFrame:
    """Several value columns per row: ``groups`` maps the row's name to its source columns.

    Replaces unpivoting each column set by itself and gluing the results by position.
    """
    rows = F.array(*[
        F.struct(F.lit(label).alias(name), *[F.col(c).alias(v) for c, v in zip(cols, values)])
        for label, cols in groups.items()])
    return df.select(*ids, F.inline(rows))


def pivot_sums(df: DataFrame, keys: list[str], column: str, labels: list[str], measures: dict[str, Column],
               fill: int | None = 0) -> DataFrame:
    """Pivot over declared labels: no job to find them, and the schema never changes.

    One measure gives columns named by label, several give ``label_measure``.
    """
    out = df.groupBy(*keys).pivot(column, labels).agg(*[m.alias(n) for n, m in measures.items()])
    return out if fill is None else out.fillna(fill)


#: Bits of the low half of a sum: halves of 2 to the 31 rows fit a long.
HALF = 32


def sum_when(condition: Column, amount: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0))


def conditional_sums(df: DataFrame, keys: list[str], measures: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Many sums in one pass: ``measures`` maps the name to (condition, amount); no match gives 0.

    Rows that miss a condition give null, which a sum skips without touching its buffer. Decimals of
    up to 18 digits are summed as two longs each, the high and the low half of their smallest units:
    they are exact, and a long takes a fraction of what a decimal's sum takes in a shuffle.
    """
    kinds = df.select(*[amount.alias(n) for n, (_, amount) in measures.items()]).schema
    short = {n for n in measures if isinstance(k := kinds[n].dataType, T.DecimalType) and k.precision <= 18 and k.scale <= 4}
    sums, results = [], []
    for i, (n, (condition, amount)) in enumerate(measures.items()):
        if n not in short:
            sums.append(sum_when(condition, amount).alias(f"__s{i}"))
            results.append(F.col(f"__s{i}").alias(n))
            continue
        kind = kinds[n].dataType
        units = F.when(condition, (amount * 10 ** kind.scale).cast("bigint"))
        sums += [F.sum(F.shiftright(units, HALF)).alias(f"__h{i}"), F.sum(units.bitwiseAND(F.lit((1 << HALF) - 1))).alias(f"__l{i}")]
        whole = F.col(f"__h{i}").cast("decimal(20,0)") * F.lit(Decimal(1 << HALF)) + F.col(f"__l{i}").cast("decimal(20,0)")
        total = (whole * F.lit(Decimal(1).scaleb(-kind.scale))).cast(f"decimal({kind.precision + 10},{kind.scale})")
        results.append(F.coalesce(total, F.lit(0)).alias(n))
    return df.groupBy(*keys).agg(*sums).select(*keys, *results)


def attributes_to_columns(df: DataFrame, keys: list[str], attribute: str, value: str,
                          mapping: dict[str, str], order: list[str | Column]) -> DataFrame:
    """Attribute rows to columns; of a repeated attribute the first by ``order`` counts.

    Values of variable width, such as texts, are aggregated by sorting whatever they are ordered by.
    """
    rank = F.struct(*[as_col(o) for o in order])
    return df.where(F.col(attribute).isin(*mapping)).groupBy(*keys).agg(*[
        F.min_by(F.when(F.col(attribute) == code, F.col(value)),
                 F.when(F.col(attribute) == code, rank)).alias(column)
        for code, column in mapping.items()])


def until_last_filled(long: DataFrame, number: str, value: str) -> DataFrame:
    """Cut the periods after the last one in which any row has a value.

    A sheet in which no row has a value has no such period and is left empty.
    """
    last = long.where(F.col(value).isNotNull()).agg(F.max(number).alias("last")).scalar()
    return long.where(F.col(number) <= last)


def fiscal_sheet(df: DataFrame, ids: list[str], year: str, value: str = "value", year_is: str = "end",
                 cut_empty: bool = True) -> DataFrame:
    """A sheet with columns APRIL..MARCH to one row per month with its first day.

    Months after the last filled one of the whole sheet are cut, by month number.
    """
    long = unpivot(df, [*ids, year], FISCAL_MONTHS, "month_name", value)
    long = long.withColumn("month_no", sheet_month_number("month_name"))
    long = long.withColumn("fiscal_month_no", F.pmod(F.col("month_no") - 4, F.lit(12)) + 1)
    if cut_empty:
        long = until_last_filled(long, "fiscal_month_no", value)
    return long.withColumn("month", sheet_date(year, F.col("month_no"), year_is)).select(
        *ids, year, "month", "month_no", value)


def day_sheet(df: DataFrame, ids: list[str], year: str, month: str, value: str = "value",
              days: list[str] | None = None) -> DataFrame:
    """A sheet with columns 1..31 to one row per filled day; days a month lacks are dropped."""
    days = days or [str(d) for d in range(1, 32)]
    long = unpivot(df, [*ids, year, month], days, "day", value, drop_null=True)
    date = F.expr(f"try_make_timestamp({year}, {month}, cast(day AS int), 0, 0, 0)").cast("date")
    return long.withColumn("date", date).where(F.col("date").isNotNull()).select(*ids, "date", value)


def quarter_budgets(df: DataFrame, ids: list[str], year: str, quarters: dict[str, int] | None = None,
                    value: str = "budget") -> DataFrame:
    """Quarter columns Q1..Q4 to rows dated on the quarter's first month.

    The sheet's year is the one in which the fiscal year ends, so Q1-Q3 belong to the year before.
    """
    quarters = quarters or {"Q1": 4, "Q2": 7, "Q3": 10, "Q4": 1}
    long = unpivot(df, [*ids, year], list(quarters), "quarter", value)
    month = F.element_at(F.create_map(*[F.lit(v) for kv in quarters.items() for v in kv]), F.col("quarter"))
    return long.withColumn("month", sheet_date(year, month, "end"))


def paired_unpivot(df: DataFrame, ids: list[str], parameters: list[str], suffixes: list[str],
                   name: str = "parameter") -> DataFrame:
    """``X_RATING``/``X_VALUE`` style column pairs to rows (parameter, rating, value)."""
    groups = {p: [f"{p}_{s}" for s in suffixes] for p in parameters}
    return unpivot_groups(df, ids, groups, name, [s.lower() for s in suffixes])


def split_rows(df: DataFrame, column: str, separator: str, name: str, keep: list[str]) -> DataFrame:
    """A separated list to one row per trimmed, non-empty entry."""
    return df.select(*keep, F.explode(F.split(F.col(column), separator)).alias(name)).select(
        *keep, F.trim(name).alias(name)).where(F.col(name) != "")


def concat_rows(df: DataFrame, keys: list[str], order: str, text: Column, separator: str, name: str,
                part: Column | None = None) -> DataFrame:
    """Texts of a group in order, joined into one text per group.

    A group's texts meet in one task, as its one text must. A caller with groups beyond a
    task's memory may ask for several texts instead: ``part`` numbers slices of the order.
    """
    slices = {} if part is None else {"part_no": part}
    row = F.struct(F.col(order).alias("o"), text.alias("t")).alias("__r")
    rows = df.select(*keys, *[p.alias(n) for n, p in slices.items()], row)
    texts = F.transform(F.sort_array(F.collect_list("__r")), lambda r: r["t"])
    return rows.groupBy(*keys, *slices).agg(F.array_join(texts, separator).alias(name))


def flag_pairs(df: DataFrame, ids: list[str], flag: str, flags: list[str], columns: list[str],
               name: str = "particulars") -> DataFrame:
    """Measure columns to rows with one column per flag value (such as ACTUAL and BUDGET).

    Only keys present under every flag stay, as an inner join of the two sides would keep.
    """
    at = lambda f: F.col(flag) == f
    wide = df.groupBy(*ids).agg(
        *[F.count(F.when(at(f), 1)).alias(f"__n{i}") for i, f in enumerate(flags)],
        *[F.sum(F.when(at(f), F.col(c))).alias(f"__{i}_{c}") for i, f in enumerate(flags) for c in columns])
    for i in range(len(flags)):
        wide = wide.where(F.col(f"__n{i}") > 0)
    groups = {c: [f"__{i}_{c}" for i in range(len(flags))] for c in columns}
    return unpivot_groups(wide, ids, groups, name, [f.lower() for f in flags])
