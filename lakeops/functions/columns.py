"""Column helpers shared by the operators."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

# The sentinels every fact and dimension agrees on.
KEY_MISSING = -2
KEY_UNKNOWN = -1
DEFAULT_MEMBER = "<DEFAULT>"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column) -> Column:
    """Null, empty or only spaces."""
    c = as_col(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def blank_to_null(c: str | Column) -> Column:
    """The empty text becomes null; other text, spaces included, is kept."""
    return F.nullif(as_col(c), F.lit(""))


def default_member(c: str | Column, default: str = DEFAULT_MEMBER) -> Column:
    c = as_col(c)
    return F.when(is_blank(c), F.lit(default)).otherwise(c)


def pad_id(c: str | Column, width: int) -> Column:
    return F.lpad(as_col(c).cast("string"), width, "0")


def strip_zeros(c: str | Column) -> Column:
    return F.regexp_replace(as_col(c).cast("string"), "^0*", "")


def money(c: str | Column, precision: int = 18, scale: int = 2) -> Column:
    return as_col(c).cast(f"decimal({precision},{scale})")


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """Quotient as double; null when the divisor is zero or null."""
    return F.try_divide(as_col(top).cast("double"), as_col(bottom).cast("double"))


def signed(amount: str | Column, flag: str | Column, *negative: str) -> Column:
    """Flip the sign where the debit/credit (or movement) code is in ``negative``."""
    amount = as_col(amount)
    return F.when(as_col(flag).isin(*negative), -amount).otherwise(amount)


def by_code(code: str | Column, plus: tuple = (), minus: tuple = ()) -> Column:
    """+1, -1 or null by movement code; multiply a quantity with it."""
    code = as_col(code)
    out = F.lit(None).cast("int")
    if minus:
        out = F.when(code.isin(*minus), F.lit(-1))
        return out.when(code.isin(*plus), F.lit(1)) if plus else out
    return F.when(code.isin(*plus), F.lit(1)) if plus else out


def first_match(rules: list[tuple[Column, object]], default=None) -> Column:
    """CASE over (condition, value) pairs, the first true one wins."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = None
    for condition, value in rules:
        out = F.when(condition, lit(value)) if out is None else out.when(condition, lit(value))
    if out is None:
        return lit(default)
    return out if default is None else out.otherwise(lit(default))


def null_safe(left: list[Column], right: list[Column]) -> Column:
    return reduce(and_, [a.eqNullSafe(b) for a, b in zip(left, right)])


# How KPI labels become column labels.
LABEL_KEEP = r"[^A-Z a-z 0-9 % _]"
UNIT_KEEP = r"[^A-Z a-z 0-9 / % _]"
LABEL_PERCENT = "PERCEN"


def clean_label(c: str | Column, drop: str = LABEL_KEEP) -> Column:
    """A free-text label as a column label: special characters go, blanks become underscores."""
    c = F.upper(F.regexp_replace(as_col(c), drop, ""))
    c = F.replace(F.replace(c, F.lit(" "), F.lit("_")), F.lit("%"), F.lit(LABEL_PERCENT))
    return F.replace(c, F.lit("__"), F.lit("_"))
