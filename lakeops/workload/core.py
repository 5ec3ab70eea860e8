"""Registry of runnable queries, each with the SQL that must give the same rows."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import money
from ..session import CHECKPOINT_SETTING, bound_tasks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The source tables of one directory, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    @cached_property
    def checkpoints(self) -> str:
        """A folder for a session that names none, as in tests; ``use_checkpoints`` prefers the session's own."""
        return self.spark.conf.get(CHECKPOINT_SETTING, None) or tempfile.mkdtemp(prefix="lakeops-checkpoints-")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(self.path(name))
        setattr(self, name, df)
        return df

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with typed money and dates."""
        return self.lineitem.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
            money("l_quantity").alias("quantity"), money("l_extendedprice").alias("price"),
            money("l_discount").alias("discount"), money("l_tax").alias("tax"),
            F.col("l_shipdate").cast("date").alias("ship_date"))

    @cached_property
    def sales_orders(self) -> DataFrame:
        return self.orders.select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
            money("o_totalprice").alias("total"), F.col("o_orderdate").cast("date").alias("order_date"))

    @cached_property
    def items(self) -> DataFrame:
        """One row per (order, line): the pair repeats in the raw table."""
        return items_of(self.lines)


def items_of(lines: DataFrame) -> DataFrame:
    """``Tables.items`` of the columns that the lines have."""
    columns = {"partkey": (F.min, "l_partkey"), "suppkey": (F.min, "l_suppkey"), "quantity": (F.sum, "quantity"), "price": (F.sum, "price"),
               "ship_date": (F.min, "ship_date"), "flag": (F.max, "l_returnflag"), "status": (F.max, "l_linestatus")}
    return lines.groupBy("l_orderkey", "l_linenumber").agg(*[f(c).alias(n) for n, (f, c) in columns.items() if c in lines.columns])


def laid_by(df: DataFrame, key: str) -> DataFrame:
    """Rows that have the key, by the key, in one exchange for all that is made of them.

    Below an exchange Catalyst leaves each reader its own columns and filters, so the exchanges of
    several readers differ and each is written to disk. The filter above it drops no row: it reads
    all columns and is not deterministic, which keeps both above and has one exchange read again.
    """
    all_columns = (F.spark_partition_id() >= 0) | (F.xxhash64(*df.columns) == 0)
    return df.where(F.col(key).isNotNull()).repartition(key).where(all_columns)


LINES = """lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
         l_quantity::DECIMAL(18,2) AS quantity, l_extendedprice::DECIMAL(18,2) AS price,
         l_discount::DECIMAL(18,2) AS discount, l_tax::DECIMAL(18,2) AS tax, l_shipdate::DATE AS ship_date
  FROM lineitem)"""
SALES_ORDERS = """sales_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         o_totalprice::DECIMAL(18,2) AS total, o_orderdate::DATE AS order_date
  FROM orders)"""
ITEMS = LINES + """, items AS (
  SELECT l_orderkey, l_linenumber, min(l_partkey) AS partkey, min(l_suppkey) AS suppkey,
         sum(quantity) AS quantity, sum(price) AS price, min(ship_date) AS ship_date,
         max(l_returnflag) AS flag, max(l_linestatus) AS status
  FROM lines GROUP BY ALL)"""


def rounded(df: DataFrame, columns: list[str], scale: int = 4) -> DataFrame:
    """Computed doubles rounded the way ``near`` does it in SQL: engines differ on halves."""
    unit = float(10 ** scale)
    return df.withColumns({c: F.floor(F.col(c).cast("double") * unit + 0.5) / unit for c in columns})


def near(expression: str, scale: int = 4) -> str:
    """SQL for a double rounded as ``rounded`` does."""
    unit = f"1e{scale}"
    return f"(floor(({expression})::DOUBLE * {unit} + 0.5) / {unit})"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines print a value the same way."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields])


def query(sql: str | None = None, conf: dict[str, str] | None = None):
    """Register ``fn(tables) -> DataFrame`` under its own name; ``conf`` is for ``bound_tasks``."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, folder: plain(fn(Tables(bound_tasks(spark, conf), folder)))
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register
