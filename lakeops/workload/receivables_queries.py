"""Receivables on orders: an order is a debit, negative account balances are claims."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import previous_month_end
from ..operators.joins import anti, lookup
from ..plans import receivables as r
from .core import SALES_ORDERS, Tables, query

AS_OF = "2000-06-30"

# Every order is a debit item; every 50th order also has the item that cancels it, every
# 7th is a credit. Finished orders count as cleared 90 days after posting. Some items have
# no customer, some no document date and so, aged by it, no age.
ITEMS_SQL = f"""{SALES_ORDERS}, all_items AS (
  SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS customer, o_orderkey AS doc, i.item, order_date AS post_date,
    CASE WHEN o_orderkey % 11 <> 0 THEN order_date - (o_orderkey % 7)::INTEGER END AS doc_date, total AS amount,
    CASE WHEN (i.item = 2) <> (o_orderkey % 7 = 0) THEN 'H' ELSE 'S' END AS dc,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'UE' ELSE 'RV' END AS doc_type,
    nullif(o_orderpriority, '5-LOW') AS line,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'A' ELSE 'Z' END AS ledger,
    CASE WHEN o_orderstatus = 'F' THEN order_date + 90 END AS clear_date
  FROM sales_orders, (VALUES (1), (2)) i(item) WHERE i.item = 1 OR o_orderkey % 50 = 1),
open_items AS (SELECT * FROM all_items WHERE post_date <= DATE '{AS_OF}' AND (clear_date IS NULL OR clear_date > DATE '{AS_OF}')),
signed AS (SELECT customer, doc, item, line, CASE WHEN dc = 'H' THEN -amount ELSE amount END AS amount,
  CASE WHEN doc_type = 'UE' THEN date_diff('day', doc_date, DATE '{AS_OF}')
       ELSE date_diff('day', post_date, DATE '{AS_OF}') + 1 END AS age
  FROM open_items WHERE customer IS NULL OR customer NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 0)),
kept AS (SELECT * FROM signed WHERE doc NOT IN (SELECT doc FROM signed GROUP BY customer, doc HAVING sum(amount) = 0)),
credits AS (SELECT customer, sum(amount) AS credit_sum FROM (
  SELECT customer, amount FROM kept WHERE amount < 0 UNION ALL
  SELECT c_custkey, (-c_acctbal::DECIMAL(18,2)) * -1000 FROM customer WHERE c_acctbal < 0) GROUP BY 1),
running AS (SELECT k.*, coalesce(c.credit_sum, 0) AS credit_sum,
  sum(k.amount) OVER (PARTITION BY k.customer ORDER BY age DESC, doc, item ROWS UNBOUNDED PRECEDING) + coalesce(c.credit_sum, 0) AS paid
  FROM kept k LEFT JOIN credits c ON c.customer IS NOT DISTINCT FROM k.customer WHERE k.amount > 0),
flagged AS (SELECT *, lag(paid) OVER (PARTITION BY customer ORDER BY age DESC, doc, item) AS previous FROM running),
settled AS (SELECT *, CASE WHEN credit_sum = 0 THEN amount WHEN paid <= 0 THEN 0
  WHEN previous IS NULL OR previous <= 0 THEN paid ELSE amount END AS balance FROM flagged)"""


def all_items(t: Tables) -> DataFrame:
    c = F.col
    copies = F.when(c("o_orderkey") % 50 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = t.sales_orders.withColumn("item", F.explode(copies))
    credit = (c("item") == 2) != (c("o_orderkey") % 7 == 0)
    return rows.select(
        F.when(c("o_orderkey") % 97 != 0, c("o_custkey")).alias("customer"), c("o_orderkey").alias("doc"), "item",
        c("order_date").alias("post_date"),
        F.when(c("o_orderkey") % 11 != 0, F.date_sub("order_date", (c("o_orderkey") % 7).cast("int"))).alias("doc_date"),
        c("total").alias("amount"),
        F.when(credit, "H").otherwise("S").alias("dc"),
        F.when(c("o_orderpriority") == "1-URGENT", "UE").otherwise("RV").alias("doc_type"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("line"),
        F.when(c("o_orderpriority") == "2-HIGH", "A").otherwise("Z").alias("ledger"),
        F.when(c("o_orderstatus") == "F", F.date_add("order_date", 90)).alias("clear_date"))


def balances(t: Tables, as_of: str = AS_OF) -> DataFrame:
    plants = t.customer.where("c_nationkey = 0").select(F.col("c_custkey").alias("customer"))
    items = anti(r.signed_items(r.open_at(all_items(t), as_of), as_of), plants, ["customer"])
    items = r.drop_zero_documents(items, ["customer", "doc"])
    claims = t.customer.where("c_acctbal < 0").select(
        F.col("c_custkey").alias("customer"), (-F.col("c_acctbal").cast("decimal(18,2)")).alias("amount"))
    return r.settle_fifo(items, ["doc", "item"], r.claim_totals(claims, scale=-1000))


@query(f"""WITH {ITEMS_SQL} SELECT customer, doc, item, age::INTEGER AS age, amount::DOUBLE AS amount,
credit_sum::DOUBLE AS credit_sum, balance::DOUBLE AS balance FROM settled""")
def fifo_settlement(t: Tables) -> DataFrame:
    return balances(t).select("customer", "doc", "item", "age", "amount", "credit_sum", "balance")


@query(f"""WITH {ITEMS_SQL.replace(AS_OF, '2000-05-31')} SELECT customer, sum(amount)::DOUBLE AS amount, sum(balance)::DOUBLE AS balance
FROM settled GROUP BY 1""")
def restated_settlement(t: Tables) -> DataFrame:
    """The same settlement as of the end of the month before."""
    settled = balances(t, previous_month_end(AS_OF))
    return settled.groupBy("customer").agg(F.sum("amount").alias("amount"), F.sum("balance").alias("balance"))


_BOUNDS = [(0 if i == 0 else 15 * i + 1, 15 * (i + 1)) for i in range(24)] + [
    (360 + 30 * i + 1, 360 + 30 * (i + 1)) for i in range(12)]
_SUMS = ", ".join(
    f"""coalesce(sum(balance) FILTER (age BETWEEN {a} AND {b}), 0)::DOUBLE AS "{a}_to_{b}_days" """ for a, b in _BOUNDS)


@query(f"""WITH {ITEMS_SQL} SELECT customer, coalesce(line, 'OTHERS') AS line, {_SUMS},
coalesce(sum(balance) FILTER (age < 0 OR age > 720), 0)::DOUBLE AS grtr_than_720_days, DATE '{AS_OF}' AS snapshot_date
FROM settled WHERE balance > 0 GROUP BY 1, 2""")
def ageing_snapshot(t: Tables) -> DataFrame:
    return r.ageing_snapshot(balances(t), ["customer", "line"], AS_OF, defaults={"line": "OTHERS"})


@query(f"""SELECT o_orderkey, CASE WHEN age < 0 THEN 'not_due' WHEN age <= 15 THEN '0_to_15_days'
WHEN age <= 360 THEN ((ceil(age / 15.0)::INTEGER - 1) * 15 + 1) || '_to_' || (ceil(age / 15.0)::INTEGER * 15) || '_days'
WHEN age <= 720 THEN (360 + (ceil((age - 360) / 30.0)::INTEGER - 1) * 30 + 1) || '_to_' || (360 + ceil((age - 360) / 30.0)::INTEGER * 30) || '_days'
ELSE 'grtr_than_720_days' END AS bucket
FROM (SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '{AS_OF}') AS age FROM orders)""")
def age_buckets(t: Tables) -> DataFrame:
    age = F.datediff(F.lit(AS_OF).cast("date"), F.col("order_date"))
    return t.sales_orders.select("o_orderkey", r.age_bucket(age, not_due=True).alias("bucket"))


CRITERIA = """criteria AS (SELECT DISTINCT c_mktsegment AS segment, length(c_mktsegment) * 30 AS start_days FROM customer
WHERE c_mktsegment <> 'FURNITURE')"""


@query(f"""WITH {ITEMS_SQL}, {CRITERIA} SELECT s.customer, c.c_mktsegment AS segment,
sum(CASE WHEN s.age >= coalesce(k.start_days, 0) THEN s.balance ELSE 0 END)::DOUBLE AS overdue_amount, DATE '{AS_OF}' AS snapshot_date
FROM settled s LEFT JOIN customer c ON c.c_custkey = s.customer LEFT JOIN criteria k ON k.segment = c.c_mktsegment GROUP BY 1, 2""")
def overdue_amounts(t: Tables) -> DataFrame:
    classed = lookup(balances(t), t.customer, [("customer", "c_custkey")], [("c_mktsegment", "segment")])
    criteria = t.customer.where("c_mktsegment <> 'FURNITURE'").select(
        F.col("c_mktsegment").alias("segment"), (F.length("c_mktsegment") * 30).alias("start_days")).distinct()
    return r.overdue_amounts(classed, criteria, ["segment"], ["customer", "segment"], AS_OF)


@query(f"""WITH {ITEMS_SQL} SELECT customer, sum(amount)::DOUBLE AS deposit, DATE '{AS_OF}' AS snapshot_date FROM open_items
WHERE ledger = 'A' AND dc = 'H' AND (customer IS NULL OR customer NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) GROUP BY 1""")
def security_deposits(t: Tables) -> DataFrame:
    excluded = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("customer"))
    return r.security_deposits(all_items(t), AS_OF, ("A",), excluded)


@query(f"""WITH {SALES_ORDERS}, docs AS (SELECT o_orderkey AS doc, order_date AS post_date, o_orderstatus, o_orderpriority,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey + 3 END AS reversed_by FROM sales_orders),
payments AS (SELECT * FROM docs WHERE o_orderstatus = 'F'),
headers AS (SELECT doc, post_date FROM payments UNION SELECT d.doc, d.post_date FROM docs d JOIN payments p ON p.reversed_by = d.doc AND p.o_orderpriority <> '3-MEDIUM'),
line AS (SELECT l_orderkey AS doc, l_linenumber AS item, l_linestatus AS dc, o_custkey AS customer,
  sum(CASE WHEN l_linestatus = 'O' THEN -l_extendedprice::DECIMAL(18,2) ELSE l_extendedprice::DECIMAL(18,2) END) AS amount
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3, 4),
offices AS (SELECT o_custkey AS customer, min(o_orderpriority) AS office FROM orders WHERE o_custkey % 10 <> 0 GROUP BY 1),
typed AS (SELECT h.doc, h.post_date, l.item, l.dc, l.customer, l.amount, 'C' || c_custkey AS postcode, c_mktsegment AS line,
  CASE WHEN office LIKE '%URGENT%' THEN 'EXPORTS' WHEN office LIKE '%HIGH%' THEN 'PROJECT' ELSE '<DEFAULT>' END AS sale_type
  FROM headers h LEFT JOIN line l ON l.doc = h.doc LEFT JOIN customer ON c_custkey = l.customer LEFT JOIN offices f ON f.customer = l.customer)
SELECT doc, post_date, item, dc, customer, line, sale_type, amount::DOUBLE AS amount,
CASE WHEN sale_type = 'EXPORTS' THEN n_name ELSE '<DEFAULT>' END AS state, CASE WHEN sale_type = 'EXPORTS' THEN r_name ELSE '<DEFAULT>' END AS zone
FROM typed LEFT JOIN customer ON c_custkey = customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""".replace(
    "WHEN sale_type = 'EXPORTS' THEN", "WHEN sale_type = 'EXPORTS' AND customer IS NOT NULL THEN"))
def collections(t: Tables) -> DataFrame:
    docs = t.sales_orders.select(
        F.col("o_orderkey").alias("doc"), F.col("order_date").alias("post_date"), "o_orderstatus", "o_orderpriority",
        F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderkey") + 3).alias("reversed_by"))
    lines = lookup(t.lines, t.orders, [("l_orderkey", "o_orderkey")], [("o_custkey", "customer")], how="inner").groupBy(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("item"),
        F.when(F.col("l_linestatus") == "O", "H").otherwise(F.col("l_linestatus")).alias("dc"), "customer").agg(F.sum("price").alias("amount"))
    places = lookup(t.nation, t.region, [("n_regionkey", "r_regionkey")], [("r_name", "zone")], how="inner")
    homes = lookup(t.customer, places, [("c_nationkey", "n_nationkey")], [("n_name", "state"), "zone"], how="inner")
    code = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    # Every tenth customer has no sales area; only exports have a territory.
    territory = homes.select(F.col("c_mktsegment").alias("product_line"), F.lit("EXPORTS").alias("sale_type"), code.alias("pincode"), "state", "zone")
    customers = t.customer.select(F.col("c_custkey").alias("customer"), code.alias("postcode"), F.col("c_mktsegment").alias("product_line"))
    areas = t.orders.where("o_custkey % 10 <> 0").select(F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("office"))
    out = r.collections(docs.where("o_orderstatus = 'F'"), docs, lines, ["doc"], ["reversed_by"], customers, areas,
                        [("%URGENT%", "EXPORTS"), ("%HIGH%", "PROJECT")], territory, "o_orderpriority", ("3-MEDIUM",))
    return out.select("doc", "post_date", "item", F.when(F.col("dc") == "H", "O").otherwise(F.col("dc")).alias("dc"), "customer",
                      F.col("product_line").alias("line"), "sale_type", "amount", "state", "zone")
