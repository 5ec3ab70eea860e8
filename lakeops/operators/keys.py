"""Surrogate keys: assigning them in dimensions and looking them up for facts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import KEY_MISSING, KEY_UNKNOWN, is_blank, null_safe
from .joins import anti, lookup

# Keys are numbered inside hash buckets: 16 ** 3 = 4096 of them.
BUCKET_DIGITS = 3


@dataclass(frozen=True)
class KeyMapping:
    """How one surrogate of a fact is found: natural key column(s) to dimension column(s)."""

    fact_columns: tuple[str, ...]
    dim_columns: tuple[str, ...]
    fact_key: str
    dim_key: str
    dim_table: str

    @classmethod
    def parse(cls, fact_column: str, dim_column: str, fact_key: str, dim_key: str, dim_table: str) -> "KeyMapping":
        """From metadata text in which several columns are joined by a pipe."""
        return cls(tuple(fact_column.split("|")), tuple(dim_column.split("|")), fact_key, dim_key, dim_table)


def _bucket(keys: list[str]) -> Column:
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.substring(F.md5(text), 1, BUCKET_DIGITS)


def number_members(members: DataFrame, keys: list[str], name: str, base: Column | None = None) -> DataFrame:
    """Dense, repeatable numbers base+1.. for distinct members.

    Members fall into 4096 buckets by a hash of their key. Only the bucket sizes (at most
    4096 rows) are summed up in one place; the numbering itself runs inside each bucket.
    """
    bucketed = members.withColumn("__bucket", _bucket(keys))
    sizes = bucketed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("__bucket").alias("__b"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__bucket").orderBy(*keys)
    number = F.col("__start") + F.row_number().over(inside)
    if base is not None:
        number = number + base
    return (
        bucketed.join(F.broadcast(starts), F.col("__bucket") == F.col("__b"))
        .withColumn(name, number.cast("long"))
        .drop("__bucket", "__b", "__start")
    )


def assign_keys(dim: DataFrame, incoming: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Incoming rows with their surrogate: the dimension's old one, or the next free number."""
    known = dim.select(*keys, name)
    new = anti(incoming.select(*keys).distinct(), known, keys, null_safe=True)
    top = dim.agg(F.coalesce(F.max(name), F.lit(0)).cast("long").alias("top")).scalar()
    numbered = number_members(new, keys, name, base=top)
    every = known.select(*keys, F.col(name).cast("long").alias(name)).unionByName(numbered.select(*keys, name))
    return lookup(incoming, every, keys, [name], null_safe=True)


def append_members(dim: DataFrame, facts: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """The dimension plus members seen in facts only; other columns of those are null."""
    keys = keys or columns
    extra = anti(facts.select(*columns).distinct(), dim, keys, null_safe=True)
    return dim.unionByName(extra, allowMissingColumns=True)


def one_per_key(dim: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Key to surrogate, each key once, so a lookup can never multiply fact rows.

    Of a key under several surrogates the least counts; ``repeated_members`` names such keys.
    """
    return dim.groupBy(*keys).agg(F.min(value).alias(value))


def repeated_members(dim: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys that a dimension holds under several surrogates: how many, and the least, which lookups take."""
    return dim.groupBy(*keys).agg(F.countDistinct(value).alias("n_members"), F.min(value).alias(value)).where("n_members > 1")


def lookup_key(fact: DataFrame, dim: DataFrame, mapping: KeyMapping, sentinels: bool = True) -> DataFrame:
    """Add one surrogate; -2 when a key part is null or blank, -1 when the dimension lacks it."""
    pairs = list(zip(mapping.fact_columns, mapping.dim_columns))
    members = one_per_key(dim, list(mapping.dim_columns), mapping.dim_key)
    out = lookup(fact, members, pairs, [(mapping.dim_key, mapping.fact_key)])
    if not sentinels:
        return out
    missing = reduce(or_, [is_blank(c) for c in mapping.fact_columns])
    found = F.coalesce(F.col(mapping.fact_key), F.lit(KEY_UNKNOWN))
    return out.withColumn(mapping.fact_key, F.when(missing, F.lit(KEY_MISSING)).otherwise(found).cast("long"))


def lookup_keys(fact: DataFrame, dims: dict[str, DataFrame], mappings: list[KeyMapping],
                keep_natural: bool = False) -> DataFrame:
    """All surrogates of a fact. Row count is unchanged; natural keys go unless kept."""
    out = fact
    for mapping in mappings:
        out = lookup_key(out, dims[mapping.dim_table], mapping)
    if keep_natural:
        return out
    natural = {c for m in mappings for c in m.fact_columns} - {m.fact_key for m in mappings}
    return out.drop(*natural)


def lookup_nullsafe(fact: DataFrame, dim: DataFrame, mapping: KeyMapping) -> DataFrame:
    """Many-column match in which null equals null; -2 if any part is blank, -1 if unknown."""
    pairs = list(zip(mapping.fact_columns, mapping.dim_columns))
    members = one_per_key(dim, list(mapping.dim_columns), mapping.dim_key)
    out = lookup(fact, members, pairs, [(mapping.dim_key, mapping.fact_key)], null_safe=True)
    missing = reduce(or_, [is_blank(c) for c in mapping.fact_columns])
    found = F.coalesce(F.col(mapping.fact_key), F.lit(KEY_UNKNOWN))
    return out.withColumn(mapping.fact_key, F.when(missing, F.lit(KEY_MISSING)).otherwise(found).cast("long"))


def junk_dimension(facts: DataFrame, flags: list[str], name: str) -> DataFrame:
    """One keyed row per combination of flags."""
    return number_members(facts.select(*flags).distinct(), flags, name)


def lookup_junk(fact: DataFrame, dim: DataFrame, flags: list[str], name: str) -> DataFrame:
    return lookup(fact, dim, flags, [name], null_safe=True)


def scd1_dimension(df: DataFrame, columns: list[str], key: str, order: list[Column]) -> DataFrame:
    """Projection with one row per key, the first by ``order``."""
    from .windows import pick_row

    return pick_row(df.select(*columns), [key], order)
