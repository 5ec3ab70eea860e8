"""Upserts, snapshot history and surrogate keys on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import keys, upsert, windows
from ..operators.ingest import since_watermark
from ..operators.joins import lookup
from ..operators.keys import KeyMapping
from ..plans.finance import stack_sheets
from ..sources.sinks import unmapped_rows
from .core import LINES, SALES_ORDERS, Tables, query

# Target: orders up to a day. Source: later orders, plus older finished ones with a new total.
MERGE_INPUT = f"""WITH {SALES_ORDERS},
target AS (SELECT o_orderkey, o_custkey, o_orderstatus, total FROM sales_orders WHERE order_date < DATE '2001-01-01'),
source AS (SELECT o_orderkey, o_custkey, o_orderstatus, total + 1 AS total FROM sales_orders
           WHERE order_date >= DATE '2000-07-01' OR o_orderstatus = 'P')"""


def merge_input(t: Tables) -> tuple[DataFrame, DataFrame]:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "total"]
    target = t.sales_orders.where("order_date < DATE '2001-01-01'").select(*cols)
    source = t.sales_orders.where("order_date >= DATE '2000-07-01' OR o_orderstatus = 'P'").withColumn(
        "total", (F.col("total") + 1).cast("decimal(18,2)")).select(*cols)
    return target, source


@query(f"""{MERGE_INPUT} SELECT o_orderkey, o_custkey, o_orderstatus, total::DOUBLE AS total FROM (
SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source) UNION ALL SELECT * FROM source)""")
def upsert_by_key(t: Tables) -> DataFrame:
    return upsert.upsert(*merge_input(t), ["o_orderkey"])


NULLABLE = f"""WITH {LINES}, base AS (
  SELECT l_suppkey, nullif(l_returnflag, 'N') AS flag, sum(quantity) AS quantity FROM lines GROUP BY 1, 2),
target AS (SELECT * FROM base WHERE l_suppkey % 3 <> 0), source AS (
  SELECT l_suppkey, flag, quantity + 1 AS quantity FROM base WHERE l_suppkey % 2 = 0)"""


def nullable_input(t: Tables) -> tuple[DataFrame, DataFrame]:
    base = t.lines.groupBy("l_suppkey", F.nullif("l_returnflag", F.lit("N")).alias("flag")).agg(
        F.sum("quantity").alias("quantity"))
    return base.where("l_suppkey % 3 <> 0"), base.where("l_suppkey % 2 = 0").withColumn(
        "quantity", F.col("quantity") + 1)


@query(f"""{NULLABLE} SELECT l_suppkey, flag, quantity::DOUBLE AS quantity FROM (
SELECT t.* FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.l_suppkey = t.l_suppkey
  AND s.flag IS NOT DISTINCT FROM t.flag) UNION ALL SELECT * FROM source)""")
def upsert_nullable_key(t: Tables) -> DataFrame:
    return upsert.upsert(*nullable_input(t), ["l_suppkey", "flag"], nullable=True)


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_batch_keys(t: Tables) -> DataFrame:
    return upsert.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(f"""WITH {LINES}, h AS (
  SELECT date_trunc('month', ship_date)::DATE AS snapshot, l_suppkey, sum(quantity) AS quantity FROM lines GROUP BY 1, 2),
today AS (SELECT snapshot, l_suppkey, quantity * 2 AS quantity FROM h WHERE snapshot >= DATE '2001-06-01')
SELECT snapshot, l_suppkey, quantity::DOUBLE AS quantity FROM (
  SELECT * FROM h WHERE snapshot NOT IN (SELECT snapshot FROM today) UNION ALL SELECT * FROM today)""")
def replace_snapshots(t: Tables) -> DataFrame:
    history = t.lines.groupBy(F.trunc("ship_date", "MM").alias("snapshot"), "l_suppkey").agg(
        F.sum("quantity").alias("quantity"))
    today = history.where("snapshot >= DATE '2001-06-01'").withColumn("quantity", F.col("quantity") * 2)
    return upsert.replace_snapshots(history, today, "snapshot")


VERSIONS = f"""WITH {SALES_ORDERS}, targets AS (
  SELECT o_custkey, date_trunc('month', order_date)::DATE AS month, o_orderkey % 2 AS version, sum(total) AS target
  FROM sales_orders GROUP BY 1, 2, 3)"""


@query(f"""{VERSIONS} SELECT o_custkey, month, version, target::DOUBLE AS target FROM targets t
WHERE version = (SELECT max(version) FROM targets u WHERE u.o_custkey = t.o_custkey AND u.month = t.month)""")
def latest_version_wins(t: Tables) -> DataFrame:
    targets = t.sales_orders.groupBy(
        "o_custkey", F.trunc("order_date", "MM").alias("month"), (F.col("o_orderkey") % 2).alias("version")
    ).agg(F.sum("total").alias("target"))
    return windows.all_latest(targets, ["o_custkey", "month"], "version")


@query(f"""WITH {SALES_ORDERS} SELECT o_custkey, order_date, o_orderkey, total::DOUBLE AS total FROM sales_orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) = 1""")
def latest_row_per_key(t: Tables) -> DataFrame:
    df = t.sales_orders.select("o_custkey", "order_date", "o_orderkey", "total")
    return windows.pick_row(df, ["o_custkey"], [F.col("order_date")], latest=True)


@query(f"""WITH {LINES} SELECT l_partkey, l_suppkey, price::DOUBLE AS price, ship_date FROM lines
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY ship_date, l_suppkey, price) = 1""")
def scd1_dimension(t: Tables) -> DataFrame:
    return keys.scd1_dimension(t.lines, ["l_partkey", "l_suppkey", "price", "ship_date"], "l_partkey",
                               [F.col("ship_date")])


# The dimension knows customers of the first ten nations under odd numbers.
DIM = """known AS (SELECT c_custkey, c_name, c_custkey * 2 + 1 AS customer_key FROM customer WHERE c_nationkey < 10)"""


def known_customers(t: Tables) -> DataFrame:
    return t.customer.where("c_nationkey < 10").select(
        "c_custkey", "c_name", (F.col("c_custkey") * 2 + 1).alias("customer_key"))


@query(f"""WITH {DIM}, fresh AS (SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM known)),
numbered AS (SELECT c_custkey, (SELECT max(customer_key) FROM known) + row_number() OVER (
  ORDER BY substr(md5(c_custkey::VARCHAR), 1, 3), c_custkey) AS customer_key FROM fresh)
SELECT c.c_custkey, c.c_mktsegment, coalesce(k.customer_key, n.customer_key)::BIGINT AS customer_key
FROM customer c LEFT JOIN known k USING (c_custkey) LEFT JOIN numbered n USING (c_custkey)""")
def assign_surrogate_keys(t: Tables) -> DataFrame:
    incoming = t.customer.select("c_custkey", "c_mktsegment")
    return keys.assign_keys(known_customers(t), incoming, ["c_custkey"], "customer_key")


@query(f"""WITH {DIM} SELECT c_custkey, c_name, customer_key::BIGINT AS customer_key FROM known
UNION ALL SELECT DISTINCT o_custkey, NULL, NULL FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM known)""")
def append_new_members(t: Tables) -> DataFrame:
    seen = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return keys.append_members(known_customers(t), seen, ["c_custkey"])


SEGMENT_DIM = """segments AS (SELECT c_mktsegment AS segment, row_number() OVER (ORDER BY substr(md5(c_mktsegment), 1, 3),
  c_mktsegment) AS segment_key FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'))"""
SALES_FACT = f"""WITH {SALES_ORDERS}, {DIM}, {SEGMENT_DIM}, fact AS (
  SELECT o.o_orderkey, o.o_custkey AS customer, nullif(c.c_mktsegment, 'BUILDING') AS segment, o.total
  FROM sales_orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey), keyed AS (
  SELECT o_orderkey, total, coalesce(k.customer_key, -1)::BIGINT AS customer_key,
    CASE WHEN f.segment IS NULL THEN -2 ELSE coalesce(s.segment_key, -1) END::BIGINT AS segment_key
  FROM fact f LEFT JOIN known k ON k.c_custkey = f.customer LEFT JOIN segments s ON s.segment = f.segment)"""


def keyed_sales(t: Tables) -> DataFrame:
    """Orders with a segment that is blank for some and unknown for others."""
    fact = lookup(t.sales_orders, t.customer, [("o_custkey", "c_custkey")], [("c_mktsegment", "segment")])
    fact = fact.select("o_orderkey", F.col("o_custkey").alias("customer"),
                       F.nullif("segment", F.lit("BUILDING")).alias("segment"), "total")
    segments = t.customer.where("c_mktsegment <> 'MACHINERY'").select(F.col("c_mktsegment").alias("segment")).distinct()
    dims = {"dim_customer": known_customers(t), "dim_segment": keys.number_members(segments, ["segment"], "segment_key")}
    return keys.lookup_keys(fact, dims, [
        KeyMapping.parse("customer", "c_custkey", "customer_key", "customer_key", "dim_customer"),
        KeyMapping.parse("segment", "segment", "segment_key", "segment_key", "dim_segment"),
    ])


@query(f"{SALES_FACT} SELECT o_orderkey, total::DOUBLE AS total, customer_key, segment_key FROM keyed")
def lookup_surrogate_keys(t: Tables) -> DataFrame:
    return keyed_sales(t)


@query(f"""{SALES_FACT} SELECT o_orderkey, total::DOUBLE AS total, customer_key, segment_key FROM keyed
WHERE customer_key = -1 OR segment_key = -1""")
def unmapped_quarantine(t: Tables) -> DataFrame:
    return unmapped_rows(keyed_sales(t), ["customer_key", "segment_key"])


@query("""WITH dim AS (SELECT l_partkey, l_suppkey, (l_partkey * 1000 + l_suppkey) AS source_key FROM lineitem
  WHERE l_linestatus = 'O' GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, d.source_key, count(*) AS n FROM lineitem l
LEFT JOIN dim d ON d.l_partkey = l.l_partkey AND d.l_suppkey = l.l_suppkey GROUP BY 1, 2, 3""")
def lookup_composite_key(t: Tables) -> DataFrame:
    dim = t.lineitem.where("l_linestatus = 'O'").select(
        "l_partkey", "l_suppkey", (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("source_key"))
    mapping = KeyMapping.parse("l_partkey|l_suppkey", "l_partkey|l_suppkey", "source_key", "source_key", "dim")
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = keys.lookup_key(fact, dim, mapping, sentinels=False)
    return out.groupBy("l_orderkey", "l_linenumber", "source_key").agg(F.count(F.lit(1)).alias("n"))


GEO = """geo AS (SELECT n.n_name AS state, nullif(r.r_name, 'ASIA') AS zone, c.c_mktsegment AS line,
  min(c.c_custkey) AS geo_key FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey WHERE c.c_acctbal > 0 GROUP BY 1, 2, 3)"""


@query(f"""WITH {GEO} SELECT c.c_custkey, CASE WHEN n.n_name IS NULL OR r.r_name = 'ASIA' OR r.r_name IS NULL OR c.c_mktsegment IS NULL
  THEN -2 ELSE coalesce(g.geo_key, -1) END::BIGINT AS geo_key
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN geo g ON g.state IS NOT DISTINCT FROM n.n_name AND g.zone IS NOT DISTINCT FROM nullif(r.r_name, 'ASIA')
  AND g.line IS NOT DISTINCT FROM c.c_mktsegment""")
def lookup_nullsafe_geography(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("state"), F.nullif("r_name", F.lit("ASIA")).alias("zone"))
    fact = lookup(t.customer, places, [("c_nationkey", "n_nationkey")], ["state", "zone"], how="inner")
    fact = fact.withColumnRenamed("c_mktsegment", "line")
    geo = fact.where("c_acctbal > 0").groupBy("state", "zone", "line").agg(F.min("c_custkey").alias("geo_key"))
    mapping = KeyMapping.parse("state|zone|line", "state|zone|line", "geo_key", "geo_key", "geo")
    return keys.lookup_nullsafe(fact, geo, mapping).select("c_custkey", "geo_key")


@query("""WITH junk AS (SELECT l_returnflag, l_linestatus, row_number() OVER (
  ORDER BY substr(md5(l_returnflag || '|' || l_linestatus), 1, 3), l_returnflag, l_linestatus) AS flag_key
  FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem))
SELECT flag_key, l_linenumber, count(*) AS n FROM lineitem JOIN junk USING (l_returnflag, l_linestatus) GROUP BY 1, 2""")
def junk_dimension(t: Tables) -> DataFrame:
    flags = ["l_returnflag", "l_linestatus"]
    junk = keys.junk_dimension(t.lineitem, flags, "flag_key")
    return keys.lookup_junk(t.lineitem, junk, flags, "flag_key").groupBy("flag_key", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"))


@query("""SELECT user_id, count(*) AS n FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 2 DAY FROM events) GROUP BY 1""")
def increment_from_watermark(t: Tables) -> DataFrame:
    """Everything from the stored mark on; the mark is read by the same query."""
    mark = t.events.agg((F.max("ts") - F.expr("INTERVAL 2 DAYS")).alias("m")).scalar()
    new = since_watermark(t.events, "ts", mark, inclusive=True)
    return new.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {DIM}, {SEGMENT_DIM} SELECT sheet, id, segment, amount::DOUBLE AS amount, coalesce(k.customer_key, -1)::BIGINT AS customer_key,
CASE WHEN segment IS NULL THEN -2 ELSE coalesce(s.segment_key, -1) END::BIGINT AS segment_key FROM (
  SELECT 'capacity' AS sheet, c_custkey AS id, c_mktsegment AS segment, c_acctbal::DECIMAL(18,2) AS amount FROM customer
  UNION ALL SELECT 'savings', o_custkey, NULL, o_totalprice::DECIMAL(18,2) FROM orders) x
LEFT JOIN known k ON k.c_custkey = x.id LEFT JOIN segments s USING (segment)""")
def sheets_with_keys(t: Tables) -> DataFrame:
    """Sheets taken over as they are: stacked, tagged and keyed."""
    sheets = stack_sheets({
        "capacity": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
                                      F.col("c_acctbal").cast("decimal(18,2)").alias("amount")),
        "savings": t.sales_orders.select(F.col("o_custkey").alias("id"), F.col("total").alias("amount")),
    }, "sheet")
    segments = t.customer.where("c_mktsegment <> 'MACHINERY'").select(F.col("c_mktsegment").alias("segment")).distinct()
    dims = {"dim_customer": known_customers(t), "dim_segment": keys.number_members(segments, ["segment"], "segment_key")}
    return keys.lookup_keys(sheets, dims, [
        KeyMapping.parse("id", "c_custkey", "customer_key", "customer_key", "dim_customer"),
        KeyMapping.parse("segment", "segment", "segment_key", "segment_key", "dim_segment"),
    ], keep_natural=True)


@query("""SELECT c_nationkey, c_mktsegment, count(DISTINCT c_custkey) AS n_members, min(c_custkey) AS c_custkey FROM customer
GROUP BY 1, 2 HAVING count(DISTINCT c_custkey) > 1""")
def repeated_members(t: Tables) -> DataFrame:
    return keys.repeated_members(t.customer, ["c_nationkey", "c_mktsegment"], "c_custkey")
