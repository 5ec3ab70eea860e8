"""Merging batches into tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.sinks import materialize, overwrite_partitions
from .joins import anti
from .windows import pick_row, with_group_size

#: Partitions of a merged table and the column that names them.
BUCKETS = 256
BUCKET = "key_bucket"


def upsert(target: DataFrame, source: DataFrame, keys: list[str], nullable: bool = False,
           order: list[Column] | None = None) -> DataFrame:
    """Source rows replace target rows of the same key, the rest of both is kept.

    With ``nullable`` a null key part matches a null; otherwise such rows never match.
    Columns only the source has are added to the target as nulls. A key that the source holds
    twice fails the query, unless ``order`` says which row is the last one.
    """
    source = mergeable(source, keys, nullable, order)
    kept = anti(target, source, keys, null_safe=nullable)
    return kept.unionByName(source, allowMissingColumns=True)


def mergeable(source: DataFrame, keys: list[str], nullable: bool = False, order: list[Column] | None = None) -> DataFrame:
    """The batch with each key once: the last row by ``order``, or else a failure where a key repeats."""
    if order is not None:
        return latest_of_batch(source, keys, order)
    sized = with_group_size(source, keys, "__rows")
    alone = F.col("__rows") == 1
    if not nullable:
        for k in keys:
            alone = alone | F.col(k).isNull()
    repeated = F.raise_error(F.lit("a batch delivers a key more than once")).cast("boolean")
    return sized.where(F.when(alone, F.lit(True)).otherwise(repeated)).drop("__rows")


def duplicate_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys a batch delivers more than once."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def latest_of_batch(source: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last delivered row per key, to make a batch mergeable."""
    return pick_row(source, keys, order, latest=True)


def replace_snapshots(history: DataFrame, today: DataFrame, snapshot: str) -> DataFrame:
    """History without the snapshots delivered today, plus today's rows."""
    return anti(history, today.select(snapshot).distinct(), [snapshot]).unionByName(
        today, allowMissingColumns=True)


def create_or_upsert(spark: SparkSession, path: str, source: DataFrame, keys: list[str], nullable: bool = False,
                     order: list[Column] | None = None, buckets: int = BUCKETS, checkpoints: str | None = None) -> None:
    """First load writes, later loads merge into the Parquet table at ``path``.

    The table is partitioned by a hash of its key. A load reads the partitions its keys fall in,
    merges, and replaces those alone by dynamic partition overwrite, which Spark commits at the end
    of the job; the merged rows are kept in the checkpoint folder before, as a partition cannot be
    read while it is replaced. ``buckets`` must be the same in every load. Loads of one table run
    one after the other; a format with transactions is for those that do not. A key that the batch
    holds twice fails the load unless ``order`` says which row is the last.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    batch = mergeable(source, keys, nullable, order).withColumn(BUCKET, place)
    old = read_merged(spark, path, with_bucket=True)
    if old is not None:
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
        kept = anti(old.where(F.col(BUCKET).isin(*touched)), batch, keys, null_safe=nullable)
        batch = materialize(kept.unionByName(batch, allowMissingColumns=True), checkpoints=checkpoints)
    overwrite_partitions(batch, path, [BUCKET])


def read_merged(spark: SparkSession, path: str, with_bucket: bool = False) -> DataFrame | None:
    """The table that ``create_or_upsert`` keeps, with the columns of all loads; None before the first."""
    try:
        df = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return df if with_bucket else df.drop(BUCKET)
