"""Comparing two copies of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import null_safe

#: Parts whose checksums are compared first; the broadcast list of parts that differ is no longer than this.
BUCKETS = 4096


def control_totals(left: DataFrame, right: DataFrame, totals: dict[str, Column],
                   where: Column | None = None) -> DataFrame:
    """One row per side with its row count and totals."""
    def side(name: str, df: DataFrame) -> DataFrame:
        df = df.where(where) if where is not None else df
        return df.agg(F.count(F.lit(1)).alias("n_rows"), *[t.alias(n) for n, t in totals.items()]).select(
            F.lit(name).alias("side"), "n_rows", *totals)

    return side("left", left).unionByName(side("right", right))


def _hashed(df: DataFrame, keys: list[str], values: list[str], buckets: int) -> DataFrame:
    row = F.xxhash64(*[c for k in [*keys, *values] for c in (F.col(k), F.col(k).isNull())])
    place = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit("place")), F.lit(buckets))
    return df.select(*keys, row.alias("__row"), place.alias("__bucket"))


def checksums(df: DataFrame, keys: list[str], values: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n_rows, total): rows and the sum of row hashes of each part of a table, by a hash of the key."""
    return _hashed(df, keys, values, buckets).groupBy(F.col("__bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("__row").cast("decimal(20,0)")).alias("total"))


def differing_buckets(left: DataFrame, right: DataFrame, keys: list[str], values: list[str],
                      buckets: int = BUCKETS) -> DataFrame:
    """The parts in which the two sides do not have the same rows equally often."""
    a, b = checksums(left, keys, values, buckets), checksums(right, keys, values, buckets)
    b = b.withColumnsRenamed({"n_rows": "__n", "total": "__t"})
    return a.join(b, "bucket", "full").where(
        ~null_safe([F.col("n_rows"), F.col("total")], [F.col("__n"), F.col("__t")])).select("bucket")


def differences(left: DataFrame, right: DataFrame, keys: list[str], values: list[str] | None = None,
                buckets: int = BUCKETS) -> DataFrame:
    """(keys, difference, left_rows, right_rows) of each key that the sides do not hold alike.

    ``difference`` is ``missing_in_left``, ``missing_in_right`` or ``different``: other values, or the
    same ones another number of times. ``values`` are the columns compared, all but the keys if
    not given. Checksums of the parts are compared first; then only rows of parts that differ are
    shuffled, so that equal tables send one row per part and task. Null keys and values are
    compared like others.
    """
    values = [c for c in left.columns if c not in keys] if values is None else values
    parts = F.broadcast(differing_buckets(left, right, keys, values, buckets))

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = _hashed(df, keys, values, buckets).join(parts, F.col("__bucket") == F.col("bucket"), "left_semi")
        return rows.select(*keys, "__row", *[F.lit(int(name == n)).alias(n) for n in ("__left", "__right")])

    rows = side(left, "__left").unionByName(side(right, "__right"))
    per_row = rows.groupBy(*keys, "__row").agg(F.sum("__left").alias("__left"), F.sum("__right").alias("__right"))
    per_key = per_row.groupBy(*keys).agg(
        F.sum("__left").alias("left_rows"), F.sum("__right").alias("right_rows"),
        F.max((F.col("__left") != F.col("__right")).cast("int")).alias("__differs")).where("__differs = 1")
    kind = F.when(F.col("left_rows") == 0, "missing_in_left").when(F.col("right_rows") == 0, "missing_in_right").otherwise("different")
    return per_key.select(*keys, kind.alias("difference"), "left_rows", "right_rows")


def missing_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys present on one side only, tagged with the side that lacks them; how often a side has a key does not count."""
    found = differences(left, right, keys, [])
    return found.where("difference <> 'different'").select(
        *keys, F.replace("difference", F.lit("missing_in_"), F.lit("")).alias("missing_in"))
