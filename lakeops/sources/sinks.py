"""Writing tables, snapshots and exports."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import KEY_UNKNOWN
from ..session import use_checkpoints


def write_snapshot(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_lake(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
               partition_by: list[str] | None = None) -> None:
    writer = df.write.format(fmt).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def materialize(df: DataFrame, path: str | None = None, checkpoints: str | None = None) -> DataFrame:
    """Cut the lineage of an intermediate result that several steps read.

    Written to the given shared path, or checkpointed in the session's checkpoint folder
    (``checkpoints`` where it names none). Both survive a lost executor, which cached blocks do not.
    """
    if path is None:
        use_checkpoints(df.sparkSession, checkpoints)
        return df.checkpoint()
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None,
                   sort: list[str] | None = None) -> DataFrame:
    """Save as a catalog table whose rows lie in ``buckets`` files by a hash of ``keys``; the table.

    Tables bucketed alike are joined and aggregated on the keys without an exchange, and aggregated
    so on more columns that include them; joined on more columns only in a session that sets
    ``spark.sql.requireAllClusterKeysForCoPartition`` to false. ``tune`` does not, as then a hot key that
    is to be spread by a further column would stay where it is. Rows are dealt by the same hash first, so each task writes one file.
    Choose keys of which none has a large share of the rows, such as a document number.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys)
    writer = writer.sortBy(*sort) if sort else writer
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions present in ``df``.

    The rebalance hint groups rows of a partition into few files and splits a
    partition that is much larger than the others.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def insert_partitions(df: DataFrame, table: str) -> None:
    """Replace only the touched partitions of a catalog table."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)


def jdbc_writer(df: DataFrame, truncate: bool = True, properties: dict[str, str] | None = None):
    """Writer that keeps the staging table's definition when it is emptied first."""
    writer = df.write.mode("overwrite").option("truncate", str(truncate).lower())
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    return writer


def export_jdbc(df: DataFrame, url: str, table: str, truncate: bool = True,
                properties: dict[str, str] | None = None) -> None:
    jdbc_writer(df, truncate, properties).jdbc(url, table)


def export_full(df: DataFrame) -> DataFrame:
    return df


def export_incremental(df: DataFrame, since, stamp: str = "LAST_EXECUTED_TIME") -> DataFrame:
    return df.where(F.col(stamp) > F.lit(since))


def export_touched_snapshots(df: DataFrame, since, snapshot: str, stamp: str = "LAST_EXECUTED_TIME") -> DataFrame:
    """Every row of any snapshot that has a row changed after ``since``.

    In a table partitioned by the snapshot the dates found prune the partitions that are read.
    """
    touched = export_incremental(df, since, stamp).select(snapshot).distinct()
    return df.join(touched, snapshot, "left_semi")


def export_aggregated(df: DataFrame, keys: list[str], measures: list[str], since=None, snapshot: str | None = None,
                      stamp: str = "LAST_EXECUTED_TIME") -> DataFrame:
    """Measures summed by key, over the touched snapshots or the whole table."""
    if since is not None:
        df = export_touched_snapshots(df, since, snapshot, stamp)
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def export_latest_snapshots(df: DataFrame, snapshot: str, n: int = 3) -> DataFrame:
    """All rows of the newest ``n`` snapshot dates.

    The ``n`` dates are looked up first, so that a table partitioned by them is read there alone.
    """
    newest = df.select(snapshot).where(F.col(snapshot).isNotNull()).distinct().orderBy(F.col(snapshot).desc()).limit(n).collect()
    return df.where(F.col(snapshot).isin(*[r[0] for r in newest]) if newest else F.lit(False))


def unmapped_rows(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with at least one supplied but unknown key."""
    return fact.where(reduce(or_, [F.col(k) == KEY_UNKNOWN for k in keys]))


def quarantine_unmapped(fact: DataFrame, keys: list[str], path: str) -> None:
    unmapped_rows(fact, keys).write.mode("overwrite").parquet(path)
