"""Sources, sinks, ingest and cleaning on the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import first_match, pad_id, strip_zeros
from ..operators import ingest, joins, reconcile
from ..operators.ingest import ColumnMeta
from ..operators.reshape import day_sheet, pivot_sums
from ..plans.finance import stack_sheets
from ..sources import readers, sinks
from .core import LINES, SALES_ORDERS, Tables, query

SNAPSHOTS = f"""WITH {LINES}, snapshots AS (
  SELECT date_trunc('month', ship_date)::DATE AS snapshot_date, l_suppkey AS plant, l_partkey AS material,
         quantity, price, ship_date AS changed FROM lines)"""


def snapshots(t: Tables) -> DataFrame:
    return t.lines.select(
        F.trunc("ship_date", "MM").alias("snapshot_date"), F.col("l_suppkey").alias("plant"),
        F.col("l_partkey").alias("material"), "quantity", "price", F.col("ship_date").alias("changed"))


@query("SELECT o_orderstatus, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders GROUP BY 1")
def parquet_set_scan(t: Tables) -> DataFrame:
    df = readers.read_parquet_set(t.spark, [t.path("orders")])
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0")
def catalog_table_projection(t: Tables) -> DataFrame:
    t.customer.createOrReplaceTempView("customer_source")
    return readers.read_table(t.spark, "customer_source", ["c_custkey", "c_name"],
                              "c_mktsegment = 'BUILDING' AND c_acctbal > 0")


@query(f"""WITH {LINES}, named AS (SELECT *, strftime(ship_date, 'ship_%Y%m.csv') AS file_name FROM lines)
SELECT file_name, count(*) AS n, sum(quantity)::DOUBLE AS quantity FROM named
WHERE file_name NOT IN (SELECT file_name FROM named WHERE ship_date < DATE '2000-06-15') GROUP BY 1""")
def only_new_files(t: Tables) -> DataFrame:
    named = t.lines.withColumn("file_name", F.date_format("ship_date", "'ship_'yyyyMM'.csv'"))
    loaded = named.where("ship_date < DATE '2000-06-15'")
    fresh = readers.only_new_files(named, loaded, "file_name")
    return fresh.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


@query("SELECT 'customer.parquet' AS file_name, NULL::TIMESTAMP AS file_date, c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey")
def file_provenance(t: Tables) -> DataFrame:
    """The table's own file: its name holds no date."""
    named = readers.with_file_provenance(readers.read_lake_table(t.spark, t.path("customer")))
    # A table of several files has part files; all carry the table's rows.
    name = F.when(F.col("FILE_NAME").startswith("part-"), "customer.parquet").otherwise(F.col("FILE_NAME"))
    return named.groupBy(name.alias("file_name"), F.col("FILE_DATE").alias("file_date"), "c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1")
def files_by_name_window(t: Tables) -> DataFrame:
    """Files without a date in their name lie in no window, so the anti window keeps them all."""
    supplier = readers.read_lake_table(t.spark, t.path("supplier"))
    dated = readers.files_in_window(supplier, datetime(1970, 1, 2), datetime(2100, 1, 1))
    return joins.anti(supplier, dated, ["s_suppkey"]).groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{SNAPSHOTS} SELECT snapshot_date, plant, count(*) AS n, sum(price)::DOUBLE AS price
FROM snapshots WHERE changed > DATE '2001-06-01' GROUP BY 1, 2""")
def export_incremental(t: Tables) -> DataFrame:
    new = sinks.export_incremental(snapshots(t), "2001-06-01", "changed")
    return new.groupBy("snapshot_date", "plant").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))


@query(f"""{SNAPSHOTS} SELECT snapshot_date, plant, material, quantity::DOUBLE AS quantity, price::DOUBLE AS price
FROM snapshots WHERE snapshot_date IN (SELECT snapshot_date FROM snapshots WHERE changed > DATE '2001-08-20')""")
def export_touched_snapshots(t: Tables) -> DataFrame:
    return sinks.export_touched_snapshots(snapshots(t), "2001-08-20", "snapshot_date", "changed").drop("changed")


@query(f"""{SNAPSHOTS} SELECT snapshot_date, plant, sum(quantity)::DOUBLE AS quantity, sum(price)::DOUBLE AS price
FROM snapshots WHERE snapshot_date IN (SELECT snapshot_date FROM snapshots WHERE changed > DATE '2001-06-20')
GROUP BY 1, 2""")
def export_aggregated(t: Tables) -> DataFrame:
    return sinks.export_aggregated(snapshots(t), ["snapshot_date", "plant"], ["quantity", "price"],
                                   "2001-06-20", "snapshot_date", "changed")


@query(f"""{SNAPSHOTS} SELECT snapshot_date, plant, sum(quantity)::DOUBLE AS quantity, sum(price)::DOUBLE AS price
FROM snapshots GROUP BY 1, 2""")
def export_aggregated_full(t: Tables) -> DataFrame:
    return sinks.export_aggregated(sinks.export_full(snapshots(t)), ["snapshot_date", "plant"], ["quantity", "price"])


@query(f"""{SNAPSHOTS} SELECT snapshot_date, plant, material, quantity::DOUBLE AS quantity, price::DOUBLE AS price
FROM snapshots WHERE snapshot_date IN (SELECT DISTINCT snapshot_date FROM snapshots ORDER BY 1 DESC LIMIT 3)""")
def export_latest_snapshots(t: Tables) -> DataFrame:
    return sinks.export_latest_snapshots(snapshots(t), "snapshot_date", 3).drop("changed")


BLANKS = """CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN ' ' ELSE c_mktsegment END"""


def with_blanks(t: Tables) -> DataFrame:
    seg = F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", "c_name",
        F.when(seg == "BUILDING", "").when(seg == "MACHINERY", " ").otherwise(seg).alias("segment"))


@query(f"SELECT c_custkey, nullif(c_name, '') AS c_name, nullif({BLANKS}, '') AS segment FROM customer")
def blank_to_null(t: Tables) -> DataFrame:
    return ingest.blank_to_null(with_blanks(t))


@query(f"""SELECT c_custkey, c_name,
CASE WHEN trim({BLANKS}) = '' THEN '<DEFAULT>' ELSE {BLANKS} END AS segment FROM customer""")
def default_key_part(t: Tables) -> DataFrame:
    return ingest.default_key_part(with_blanks(t), "segment")


LANDING_META = [
    ColumnMeta("VBELN", "doc", "bigint", "document"),
    ColumnMeta("FKDAT", "billing_date", "date", "billing_date"),
    ColumnMeta("NETWR", "net", "decimal(13,2)", "net_value"),
    ColumnMeta("KUNAG", "sold_to", "string", "sold_to_id"),
    ColumnMeta("LOEKZ", "deleted", "string", ""),
]


def landing(t: Tables) -> DataFrame:
    """Orders as text columns; priority 1 orders carry a date that does not parse."""
    date = F.date_format("o_orderdate", "yyyyMMdd")
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("VBELN"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("n/a")).otherwise(date).alias("FKDAT"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("NETWR"),
        pad_id("o_custkey", 10).alias("KUNAG"), F.col("o_orderstatus").alias("LOEKZ"),
        F.lit("x").alias("EXTRA"))


@query("""SELECT o_orderkey::VARCHAR AS doc,
CASE WHEN o_orderpriority = '1-URGENT' THEN 'n/a' ELSE strftime(o_orderdate, '%Y%m%d') END AS billing_date,
(o_totalprice::DECIMAL(18,2))::VARCHAR AS net, lpad(o_custkey::VARCHAR, 10, '0') AS sold_to, o_orderstatus AS deleted
FROM orders""")
def rename_project(t: Tables) -> DataFrame:
    return ingest.rename_project(landing(t), LANDING_META)


@query("""SELECT o_orderkey AS document,
CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate::DATE END AS billing_date,
o_totalprice::DECIMAL(13,2)::DOUBLE AS net_value, lpad(o_custkey::VARCHAR, 10, '0') AS sold_to_id FROM orders""")
def cast_by_metadata(t: Tables) -> DataFrame:
    typed = ingest.cast_by_meta(ingest.rename_project(landing(t), LANDING_META), LANDING_META)
    return ingest.processed_project(typed, LANDING_META)


@query("""SELECT o_orderkey, o_orderdate::DATE AS posted, o_orderdate::DATE AS typed FROM orders""")
def date_texts(t: Tables) -> DataFrame:
    """Day-first text and spreadsheet day numbers back to dates."""
    texts = t.orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date")).cast("string").alias("posted"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("typed"))
    meta = [ColumnMeta("o_orderkey", "o_orderkey", "bigint"), ColumnMeta("posted", "posted", "date")]
    serial = ingest.cast_by_meta(texts, meta, serial_dates=True)
    return ingest.cast_by_meta(serial, [ColumnMeta("typed", "typed", "date")], ingest.DATE_FORMATS["file"])


@query("""SELECT event_id, strftime(ts, '%H:%M:%S') AS clock FROM events""")
def clock_texts(t: Tables) -> DataFrame:
    texts = t.events.select("event_id", F.date_format("ts", "HHmmss").alias("clock"))
    typed = ingest.cast_by_meta(texts, [ColumnMeta("clock", "clock", "time")])
    return typed.withColumn("clock", F.date_format("clock", "HH:mm:ss"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'lot ' || l_partkey || '.0' WHEN 2 THEN lpad(l_partkey::VARCHAR, 9, '0')
WHEN 3 THEN '12345678901234567890' WHEN 4 THEN l_quantity::BIGINT || '.5' WHEN 5 THEN NULL WHEN 6 THEN '-' || l_quantity::BIGINT
ELSE l_quantity::BIGINT::VARCHAR END AS quantity, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL""")
def float_looking_text(t: Tables) -> DataFrame:
    """Numbers, ids with leading zeros or too long for a number, fractions, words and nulls in one column."""
    line, whole = F.col("l_linenumber"), F.col("l_quantity").cast("long").cast("string")
    part = F.col("l_partkey").cast("string")
    texts = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", first_match([
        (line == 1, F.concat(F.lit("lot "), part, F.lit(".0"))), (line == 2, F.lpad(part, 9, "0")),
        (line == 3, "12345678901234567890"), (line == 4, F.concat(whole, F.lit(".5"))), (line == 5, F.lit(None).cast("string")),
        (line == 6, F.concat(F.lit("-"), whole, F.lit(".0")))], F.concat(whole, F.lit(".0"))).alias("quantity"))
    whole = ingest.integral_text(texts, ["quantity", "l_returnflag"])
    return whole.groupBy(*whole.columns).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'old' AS side, count(*) AS n, count(bonus) AS n_bonus, sum(bonus)::DOUBLE AS bonus FROM
  (SELECT NULL::DECIMAL(13,2) AS bonus FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT 'new', count(*), count(*), sum(c_acctbal::DECIMAL(13,2))::DOUBLE FROM customer WHERE c_acctbal < 0""")
def evolve_schema(t: Tables) -> DataFrame:
    base = t.customer.select("c_custkey", "c_name", "c_acctbal")
    old = base.where("c_acctbal >= 0").select("c_custkey", "c_name", F.lit("old").alias("side"))
    new = base.where("c_acctbal < 0").select(
        "c_custkey", "c_name", F.lit("new").alias("side"), F.col("c_acctbal").cast("string").alias("bonus"))
    return ingest.evolve_schema(old, new).groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.count("bonus").alias("n_bonus"), F.sum("bonus").alias("bonus"))


GAPS = """SELECT doc_id, nullif(lang, 'en') AS lang, nullif(source, (SELECT min(source) FROM documents)) AS source
FROM documents"""


def with_gaps(t: Tables) -> DataFrame:
    least = t.documents.agg(F.min("source")).scalar()
    return t.documents.select("doc_id", F.nullif("lang", F.lit("en")).alias("lang"),
                              F.nullif(F.col("source"), least).alias("source"))


@query(f"SELECT * FROM ({GAPS}) WHERE lang IS NOT NULL")
def require_not_null(t: Tables) -> DataFrame:
    return ingest.require_not_null(with_gaps(t), ["lang"])


@query(f"""SELECT 'any' AS how, doc_id FROM ({GAPS}) WHERE lang IS NOT NULL AND source IS NOT NULL
UNION ALL SELECT 'all', doc_id FROM ({GAPS}) WHERE lang IS NOT NULL OR source IS NOT NULL""")
def drop_null_rows(t: Tables) -> DataFrame:
    kept = {how: ingest.drop_null_rows(with_gaps(t), how, ["lang", "source"]).select("doc_id") for how in ("any", "all")}
    return stack_sheets(kept, "how")


@query(f"SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, '<DEFAULT>') AS source FROM ({GAPS})")
def fill_defaults(t: Tables) -> DataFrame:
    return ingest.fill_defaults(with_gaps(t), {"lang": "none", "source": "<DEFAULT>"})


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def dedupe_rows(t: Tables) -> DataFrame:
    return ingest.dedupe(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"))


@query(f"""WITH {LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, quantity::DOUBLE AS quantity,
price::DOUBLE AS price, ship_date FROM lines QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
ORDER BY ship_date, l_partkey, l_suppkey, quantity, price) = 1""")
def dedupe_by_key(t: Tables) -> DataFrame:
    df = t.lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quantity", "price", "ship_date")
    return ingest.dedupe(df, ["l_orderkey", "l_linenumber"], [F.col("ship_date")])


@query("""SELECT c_custkey AS "C_CUSTKEY", c_name AS "C_NAME", '2024-01-31 06:00:00' AS "LAST_UPDATED_DT_TS"
FROM customer""")
def upper_and_stamp(t: Tables) -> DataFrame:
    stamped = ingest.stamp_load(ingest.upper_columns(t.customer.select("c_custkey", "c_name")), "2024-01-31 06:00:00")
    return stamped.withColumn("LAST_UPDATED_DT_TS", F.date_format("LAST_UPDATED_DT_TS", "yyyy-MM-dd HH:mm:ss"))


@query("""SELECT event_id, user_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'""")
def since_watermark(t: Tables) -> DataFrame:
    return ingest.since_watermark(t.events, "ts", "2024-01-20 00:00:00").select("event_id", "user_id", "event_type")


@query("""SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS watermark FROM events GROUP BY 1""")
def next_watermark(t: Tables) -> DataFrame:
    marks = ingest.max_watermark(t.events, "ts", ["event_type"])
    return marks.withColumn("watermark", F.date_format("watermark", "yyyy-MM-dd HH:mm:ss"))


@query("""SELECT 'events' AS table_name, ts::DATE AS load_date, count(*) AS incoming_rows FROM events GROUP BY 2""")
def load_counts(t: Tables) -> DataFrame:
    return ingest.load_counts(t.events, "events", F.col("ts").cast("date"))


@query("""SELECT 'events' AS table_name, count(*) AS incoming_rows, count(*) FILTER (NOT coalesce(value > 20, false)) AS rejected_rows,
count(*) FILTER (value > 20) AS written_rows, max(event_id) FILTER (value > 20)::VARCHAR AS next_watermark FROM events""")
def audited_load(t: Tables) -> DataFrame:
    """The counts come from the write itself, here to nowhere."""
    write = lambda df: df.write.format("noop").mode("overwrite").save()
    return ingest.audited_load(t.events, "events", write, F.col("value") > 20, "event_id")


@query("""SELECT event_id, value::INTEGER AS value, CAST(ts AS DATE) AS ts FROM
(SELECT event_id, trunc(value) AS value, ts FROM events)""")
def cast_columns(t: Tables) -> DataFrame:
    return ingest.cast_columns(t.events.select("event_id", "value", "ts"), {"value": "int", "ts": "date"})


@query("""SELECT doc_id, lpad(doc_id::VARCHAR, 18, '0') AS padded, regexp_replace(lpad(doc_id::VARCHAR, 18, '0'), '^0*', '')
AS stripped FROM documents""")
def identifier_padding(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", pad_id("doc_id", 18).alias("padded"),
                              strip_zeros(pad_id("doc_id", 18)).alias("stripped"))


@query("SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en'")
def only_language(t: Tables) -> DataFrame:
    return ingest.only_language(t.documents, "lang", "en").select("doc_id", "source", "n_chars")


DAYS = [str(d) for d in range(1, 32)]


def order_day_sheet(t: Tables) -> DataFrame:
    """Order value per customer group and month with a column per day of the month."""
    df = t.sales_orders.select(
        "o_orderpriority", F.year("order_date").alias("year"), F.month("order_date").alias("month"),
        F.dayofmonth("order_date").cast("string").alias("day"), "total")
    return pivot_sums(df, ["o_orderpriority", "year", "month"], "day", DAYS, {"total": F.sum("total")}, fill=None)


@query(f"""WITH {SALES_ORDERS} SELECT o_orderpriority, order_date AS date, sum(total)::DOUBLE AS value
FROM sales_orders GROUP BY 1, 2""")
def unpivot_daily_sheet(t: Tables) -> DataFrame:
    return day_sheet(order_day_sheet(t), ["o_orderpriority"], "year", "month")


@query(f"""WITH {LINES} SELECT l_suppkey, day(ship_date) AS day_no,
sum(quantity) FILTER (l_linestatus = 'O' AND day(last_day(ship_date)) = 30)::DOUBLE AS plant_30,
sum(quantity) FILTER (l_linestatus = 'O' AND day(last_day(ship_date)) = 31)::DOUBLE AS plant_31,
sum(quantity) FILTER (l_linestatus = 'F' AND day(last_day(ship_date)) = 30)::DOUBLE AS depot_30,
sum(quantity) FILTER (l_linestatus = 'F' AND day(last_day(ship_date)) = 31)::DOUBLE AS depot_31
FROM lines WHERE day(last_day(ship_date)) >= 30 GROUP BY 1, 2""")
def daywise_split(t: Tables) -> DataFrame:
    """Plant and depot split of 30- and 31-day months as four columns in one pivot."""
    kind = F.when(F.col("l_linestatus") == "O", "plant").otherwise("depot")
    length = F.dayofmonth(F.last_day("ship_date"))
    df = t.lines.where(length >= 30).select(
        "l_suppkey", F.dayofmonth("ship_date").alias("day_no"), "quantity",
        F.concat_ws("_", kind, length.cast("string")).alias("slice"))
    return pivot_sums(df, ["l_suppkey", "day_no"], "slice", ["plant_30", "plant_31", "depot_30", "depot_31"],
                      {"quantity": F.sum("quantity")}, fill=None)


@query("""WITH l AS (SELECT * FROM orders WHERE o_orderdate < DATE '2001-01-01'),
r AS (SELECT * FROM orders WHERE o_orderdate >= DATE '1996-01-01')
SELECT 'left' AS side, count(*) AS n_rows, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM l WHERE o_orderstatus = 'F'
UNION ALL SELECT 'right', count(*), sum(o_totalprice::DECIMAL(18,2))::DOUBLE FROM r WHERE o_orderstatus = 'F'""")
def control_totals(t: Tables) -> DataFrame:
    o = t.sales_orders
    return reconcile.control_totals(
        o.where("order_date < DATE '2001-01-01'"), o.where("order_date >= DATE '1996-01-01'"),
        {"total": F.sum("total")}, F.col("o_orderstatus") == "F")


@query("""SELECT o_orderkey, CASE WHEN o_orderdate < DATE '1996-01-01' THEN 'right' ELSE 'left' END AS missing_in
FROM orders WHERE o_orderdate < DATE '1996-01-01' OR o_orderdate >= DATE '2001-01-01'""")
def missing_keys(t: Tables) -> DataFrame:
    o = t.sales_orders
    return reconcile.missing_keys(o.where("order_date < DATE '2001-01-01'"), o.where("order_date >= DATE '1996-01-01'"),
                                  ["o_orderkey"])


@query("""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 7 THEN 'Z' ELSE o_orderstatus END AS status FROM orders WHERE o_orderdate >= DATE '1996-01-01'
UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 90 = 5 AND o_orderdate >= DATE '1996-01-01'),
a AS (SELECT o_orderkey, o_orderstatus AS status, 1 AS l, 0 AS r FROM orders UNION ALL SELECT o_orderkey, status, 0, 1 FROM r),
g AS (SELECT o_orderkey, status, sum(l) AS l, sum(r) AS r FROM a GROUP BY 1, 2)
SELECT o_orderkey, CASE WHEN sum(l) = 0 THEN 'missing_in_left' WHEN sum(r) = 0 THEN 'missing_in_right' ELSE 'different' END AS difference,
sum(l)::BIGINT AS left_rows, sum(r)::BIGINT AS right_rows FROM g GROUP BY 1 HAVING bool_or(l <> r)""")
def table_differences(t: Tables) -> DataFrame:
    """A copy that lacks the oldest orders, has other states in some and some orders twice."""
    o = t.sales_orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), "order_date")
    copy = o.where("order_date >= DATE '1996-01-01'")
    changed = copy.withColumn("status", F.when(F.col("o_orderkey") % 50 == 7, "Z").otherwise(F.col("status")))
    right = changed.unionByName(copy.where("o_orderkey % 90 = 5"))
    return reconcile.differences(o.drop("order_date"), right.drop("order_date"), ["o_orderkey"])
