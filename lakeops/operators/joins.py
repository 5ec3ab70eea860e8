"""Join shapes on top of Spark's equi joins.

No join here carries a broadcast hint: Catalyst broadcasts a side whose estimated or
measured size is under the session's threshold and shuffles otherwise, and the adaptive
skew join splits a hot key of the larger side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_col, null_safe as equal_or_both_null
from .intervals import covering

Pairs = Sequence[str | tuple[str, str]]

SPREAD = "__spread"


def _pairs(on: Pairs) -> list[tuple[str, str]]:
    return [(p, p) if isinstance(p, str) else p for p in on]


def _on(left: DataFrame, right: DataFrame, pairs, null_safe: bool) -> tuple[DataFrame, Column | list[Column]]:
    """The right side with private key names and the condition that uses them."""
    private = {r: f"__on_{i}" for i, (_, r) in enumerate(pairs)}
    right = right.withColumnsRenamed(private)
    ours, theirs = [left[l] for l, _ in pairs], [right[private[r]] for _, r in pairs]
    if null_safe:
        return right, equal_or_both_null(ours, theirs)
    return right, [a == b for a, b in zip(ours, theirs)]


def lookup(left: DataFrame, right: DataFrame, on: Pairs, take: Pairs, null_safe: bool = False,
           how: str = "left", spread: str | None = None) -> DataFrame:
    """All left columns plus the named right columns (``(column, new_name)`` renames).

    Left rows with a null key meet no one, yet a shuffle brings them to one task; ``spread`` names a
    column of many values by which they are dealt out, where a key is often null.
    """
    pairs, taken = _pairs(on), _pairs(take)
    kept_columns = left.columns
    if spread is not None:
        whole = lambda columns: reduce(and_, [F.col(c).isNotNull() for c in columns])
        left = left.withColumn(SPREAD, F.when(whole([l for l, _ in pairs]), F.lit(0).cast("bigint")).otherwise(F.xxhash64(spread)))
        right = right.withColumn(SPREAD, F.when(whole([r for _, r in pairs]), F.lit(0).cast("bigint")))
        pairs = [*pairs, (SPREAD, SPREAD)]
    keys = list(dict.fromkeys(r for _, r in pairs))
    columns = [F.col(k).alias(f"__r_{k}") for k in keys] + [F.col(c).alias(f"__t_{n}") for c, n in taken]
    right = right.select(*columns)
    ours, theirs = [left[l] for l, _ in pairs], [right[f"__r_{r}"] for _, r in pairs]
    condition = equal_or_both_null(ours, theirs) if null_safe else [a == b for a, b in zip(ours, theirs)]
    replaced = {n for _, n in taken}
    kept = [left[c] for c in kept_columns if c not in replaced]
    return left.join(right, condition, how).select(*kept, *[right[f"__t_{n}"].alias(n) for _, n in taken])


def anti(left: DataFrame, right: DataFrame, on: Pairs, null_safe: bool = False) -> DataFrame:
    """Left rows without a partner; a null in the list does not empty the result, as NOT IN would."""
    pairs = _pairs(on)
    right, condition = _on(left, right.select(*[r for _, r in pairs]), pairs, null_safe)
    return left.join(right, condition, "left_anti")


def semi(left: DataFrame, right: DataFrame, on: Pairs, null_safe: bool = False) -> DataFrame:
    pairs = _pairs(on)
    right, condition = _on(left, right.select(*[r for _, r in pairs]), pairs, null_safe)
    return left.join(right, condition, "left_semi")


def full_merge(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join with one coalesced copy of the key."""
    return left.join(right, on, "full")


def effective_dated(
    items: DataFrame, rates: DataFrame, on: Pairs, date: str, valid_from: str, valid_to: str, take: Pairs,
    keep_unmatched: bool = True,
) -> DataFrame:
    """Attach the version whose validity covers the item's date, found by ``intervals.covering``.

    A version with open ends on both sides is valid for every date. With
    ``keep_unmatched=False`` an item disappears when its key has versions and none covers
    the date, while an item whose key has no version at all still stays.
    """
    return covering(items, rates, _pairs(on), date, valid_from, valid_to, _pairs(take), keep_unmatched)


def role_columns(partners: DataFrame, keys: list[str], role: str, roles: dict[str, str],
                 values: list[str]) -> DataFrame:
    """One row per document with a column per (role, value), in one pass.

    ``roles`` maps the role code to the column prefix. A role given twice keeps its
    largest value, so the result never multiplies the document's lines.
    """
    wanted = partners.where(F.col(role).isin(*roles))
    return wanted.groupBy(*keys).agg(*[
        F.max(F.when(F.col(role) == code, F.col(v))).alias(f"{prefix}_{v}")
        for code, prefix in roles.items() for v in values
    ])


def with_reversed(documents: DataFrame, all_documents: DataFrame, key: list[str], reversal: list[str],
                  kind: str | None = None, not_chased: tuple[str, ...] = ()) -> DataFrame:
    """Documents plus the documents that reverse them, each once.

    ``reversal`` columns of a document hold the key of its partner. Documents whose ``kind`` is
    in ``not_chased`` stay, their partners are not fetched.
    """
    if kind is not None and not_chased:
        chased = documents.where(~F.trim(F.col(kind)).isin(*not_chased) | F.col(kind).isNull())
    else:
        chased = documents
    chased = chased.where(F.col(reversal[0]).isNotNull() & (F.trim(F.col(reversal[0]).cast("string")) != ""))
    partners = semi(all_documents, chased.select(*[F.col(r).alias(k) for r, k in zip(reversal, key)]), key)
    extra = anti(partners, documents, key)
    return documents.unionByName(extra.select(*documents.columns))


def climb(members: DataFrame, links: DataFrame, levels: list[str], level_type: str = "unit_type",
          unit: str = "unit", parent: str = "parent", scope: list[str] | None = None) -> DataFrame:
    """Flatten a fixed-depth parent/child table to one column per level.

    ``members`` holds ``scope`` and the lowest level's column; each further level is one
    left join to the links of the level below it.
    """
    scope = scope or []
    out = members
    for below, above in zip(levels, levels[1:]):
        step = links.where(F.upper(F.col(level_type)) == below.upper()).select(
            *scope, F.col(unit).alias("__unit"), F.col(parent).alias("__parent"))
        out = lookup(out, step, [*scope, (below, "__unit")], [("__parent", above)])
    return out


def period_key(date: str | Column) -> Column:
    """Join key for 'same month': the month's first day."""
    return F.trunc(as_col(date), "MM")
