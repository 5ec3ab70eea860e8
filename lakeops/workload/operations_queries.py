"""Procurement, production and quality on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import first_match
from ..functions.dates import fiscal_year
from ..operators import reshape
from ..operators.joins import lookup
from ..plans import procurement as p, production as pr, quality as q
from .core import ITEMS, LINES, SALES_ORDERS, Tables, near, query, rounded
from .finance_queries import quarter_sheet
from .stock_queries import FACTORS, factors

CODES = {"AF": "101", "AO": "102", "NF": "123", "NO": "122", "RF": "261", "RO": "262"}
CODE_SQL = """CASE l_returnflag || l_linestatus WHEN 'AF' THEN '101' WHEN 'AO' THEN '102' WHEN 'NF' THEN '123' WHEN 'NO' THEN '122'
  WHEN 'RF' THEN '261' ELSE '262' END"""


def moved(t: Tables) -> DataFrame:
    """Line items with a movement code, sold quantities as movements."""
    pair = F.concat("l_returnflag", "l_linestatus")
    return t.lines.withColumn("move_type", first_match([(pair == a, b) for a, b in CODES.items()]))


# --- procurement --------------------------------------------------------------------------

PO = f"""{ITEMS}, moved AS (SELECT *, {CODE_SQL} AS code FROM lines),
h AS (SELECT l_orderkey, l_linenumber, sum(CASE WHEN code IN ('101', '123') THEN quantity WHEN code IN ('102', '122') THEN -quantity ELSE 0 END) AS dq,
  sum(CASE WHEN code IN ('101', '123') THEN price WHEN code IN ('102', '122') THEN -price ELSE 0 END) AS dv, max(ship_date) FILTER (code = '101') AS delivered_on,
  sum(CASE WHEN code = '261' THEN quantity WHEN code = '262' THEN -quantity ELSE 0 END) AS iq, sum(CASE WHEN code = '261' THEN price WHEN code = '262' THEN -price ELSE 0 END) AS iv
  FROM moved GROUP BY 1, 2),
po AS (SELECT i.*, l_linenumber * 2 AS under_pct, (o_orderstatus = 'F') AS done, dq, dv, iq, iv, delivered_on,
  dq < i.quantity - (l_linenumber * 2) * i.quantity / 100 AS short FROM items i JOIN orders ON o_orderkey = l_orderkey JOIN h USING (l_orderkey, l_linenumber))"""


def order_history(t: Tables) -> tuple[DataFrame, DataFrame]:
    keys = [F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("item")]
    history = moved(t).select(
        *keys, F.when(F.col("move_type").isin("261", "262"), "invoice").otherwise("receipt").alias("kind"), "move_type",
        F.when(F.col("move_type") == "261", "S").otherwise("H").alias("dc"), "quantity", F.col("price").alias("amount"),
        F.col("ship_date").alias("date"))
    orders = t.items.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey", "inner").select(
        *keys, F.col("quantity").cast("decimal(18,2)").alias("quantity"), F.col("price").cast("decimal(18,2)").alias("value"),
        (F.col("l_linenumber") * 2).alias("under_pct"), F.col("l_linenumber").alias("over_pct"),
        F.when(F.col("o_orderstatus") == "F", "X").alias("complete"))
    return orders, history


@query(f"""WITH {PO} SELECT l_orderkey AS doc, l_linenumber AS item, dq::DOUBLE AS delivered_quantity, dv::DOUBLE AS delivered_value, iq::DOUBLE AS invoiced_quantity,
delivered_on AS delivery_date, (CASE WHEN done AND short THEN 0 ELSE quantity - dq END)::DOUBLE AS to_deliver_quantity, (CASE WHEN done AND short THEN 0 ELSE price - dv END)::DOUBLE
AS to_deliver_value, (dv - iv)::DOUBLE AS to_invoice_value, CASE WHEN NOT done AND short THEN 'OPEN' WHEN done AND short THEN 'SHORT_CLOSED' ELSE 'CLOSED' END AS status FROM po""")
def open_purchase_orders(t: Tables) -> DataFrame:
    orders, history = order_history(t)
    return p.open_purchase_orders(orders, history, ["doc", "item"]).select(
        "doc", "item", "delivered_quantity", "delivered_value", "invoiced_quantity", "delivery_date", "to_deliver_quantity",
        "to_deliver_value", "to_invoice_value", "status")


@query("""WITH s AS (SELECT l_orderkey AS doc, l_linenumber AS item, l_partkey AS req, l_suppkey % 10 AS req_item FROM lineitem),
q AS (SELECT p_partkey AS req, n AS req_item, DATE '2000-01-01' + ((p_size * 7 + n) % 300)::INTEGER AS released,
  CASE WHEN p_partkey % 6 = 0 THEN 'L' END AS deleted FROM part, (SELECT unnest(range(0, 8)) AS n))
SELECT doc, item, max(released) AS release_date FROM s LEFT JOIN (SELECT * FROM q WHERE deleted IS NULL OR deleted <> 'L') r USING (req, req_item) GROUP BY 1, 2""")
def order_release_dates(t: Tables) -> DataFrame:
    """Schedule lines of two requisition items out of ten have no requisition; every sixth requisition is deleted."""
    schedule = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("item"), F.col("l_partkey").alias("requisition"),
                                 (F.col("l_suppkey") % 10).cast("int").alias("requisition_item"))
    requisitions = t.part.select(F.col("p_partkey").alias("requisition"), "p_size", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("requisition_item"))
    requisitions = requisitions.select(
        "requisition", "requisition_item", F.when(F.col("requisition") % 6 == 0, "L").alias("deleted"),
        F.date_add(F.lit("2000-01-01").cast("date"), ((F.col("p_size") * 7 + F.col("requisition_item")) % 300).cast("int")).alias("release_date"))
    return p.release_dates(schedule, requisitions, ["doc", "item"])


@query(f"""WITH {PO}, packs AS (SELECT l_orderkey * 10 + l_linenumber AS package, -(l_orderkey * 10 + l_linenumber) AS sub, 0.0 AS quantity, 0.0 AS value FROM items),
svc AS (SELECT l_orderkey, l_linenumber, quantity AS sq, price AS sv FROM items WHERE l_linenumber <= 3),
s AS (SELECT po.*, CASE WHEN l_linenumber = 1 THEN 'CAPITAL' WHEN l_linenumber <= 3 THEN 'PLANNED' ELSE 'GOODS' END AS kind, sq, sv, quantity * under_pct / 100 AS tol FROM po LEFT JOIN svc USING (l_orderkey, l_linenumber))
SELECT l_orderkey AS doc, l_linenumber AS item, sq::DOUBLE AS service_quantity, sv::DOUBLE AS service_value, CASE
WHEN kind = 'CAPITAL' AND (sq <= dq OR sv <= dv) THEN 'CLOSED' WHEN kind = 'CAPITAL' AND l_orderkey % 6 = 0 THEN 'SHORT_CLOSED' WHEN kind = 'CAPITAL' AND NOT done AND (dq < sq - tol OR dv < sv - tol) THEN 'OPEN'
WHEN kind = 'PLANNED' AND ((sq <= dq AND dv - iv = 0) OR sv <= dv) THEN 'CLOSED' WHEN kind = 'PLANNED' AND l_orderkey % 6 = 0 THEN 'SHORT_CLOSED' WHEN kind = 'PLANNED' AND NOT done AND (dq < sq - tol OR dv < sv - tol OR dv - iv <> 0) THEN 'OPEN'
WHEN NOT done AND short THEN 'OPEN' WHEN done AND short THEN 'SHORT_CLOSED' ELSE 'CLOSED' END AS status FROM s""")
def service_purchase_orders(t: Tables) -> DataFrame:
    orders, history = order_history(t)
    key = F.col("doc") * 10 + F.col("item")
    kind = F.when(F.col("item") == 1, "CAPITAL").when(F.col("item") <= 3, "PLANNED").otherwise("GOODS")
    orders = orders.withColumns({"package": key, "po_type": kind, "deleted": F.when(F.col("doc") % 6 == 0, "S ").otherwise(" ")})
    zero = F.lit(0).cast("decimal(18,2)")
    heads = orders.select("package", (-F.col("package")).alias("sub_package"), zero.alias("quantity"), zero.alias("value"))
    leaves = orders.select((-F.col("package")).alias("package"), F.lit(None).cast("long").alias("sub_package"), "quantity", "value")
    out = p.open_purchase_orders(orders, history, ["doc", "item"], heads.unionByName(leaves), ("CAPITAL",), ("PLANNED",))
    return out.select("doc", "item", "service_quantity", "service_value", "status")


@query(f"""WITH {LINES}, {SALES_ORDERS} SELECT l_orderkey AS doc, {near("avg(date_diff('day', order_date, order_date + 60) - date_diff('day', order_date, ship_date))")} AS days_early
FROM lines JOIN sales_orders ON o_orderkey = l_orderkey GROUP BY 1""")
def vendor_performance(t: Tables) -> DataFrame:
    o = t.lines.join(t.sales_orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("doc"), "order_date", F.date_add("order_date", 60).alias("expected"), "ship_date")
    return rounded(p.vendor_performance(o, ["doc"], "order_date", "expected", "ship_date"), ["days_early"])


@query(f"""WITH {ITEMS} SELECT l_orderkey, l_linenumber, quantity::DOUBLE AS requested, o.ordered::DOUBLE AS ordered FROM items
LEFT JOIN (SELECT l_orderkey, l_linenumber, sum(quantity) AS ordered FROM lines WHERE l_returnflag <> 'R' GROUP BY 1, 2) o USING (l_orderkey, l_linenumber)
WHERE quantity > coalesce(o.ordered, 0)""")
def open_requisitions(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    ordered = t.lines.where("l_returnflag <> 'R'").groupBy(*keys).agg(F.sum("quantity").alias("ordered"))
    return p.open_requisitions(lookup(t.items.select(*keys, F.col("quantity").alias("requested")), ordered, keys, ["ordered"]))


CHANGES = """SELECT event_id, user_id, ts::DATE AS date, CASE event_type WHEN 'error' THEN 'MSTAE' WHEN 'signup' THEN 'LVORM' ELSE 'MAKTX' END AS field,
  CASE WHEN event_id % 2 = 0 THEN CASE event_type WHEN 'error' THEN '01' ELSE 'X' END ELSE '' END AS old,
  CASE WHEN event_id % 3 = 0 THEN CASE event_type WHEN 'error' THEN '01' ELSE 'X' END END AS new FROM events"""


@query(f"""WITH c AS ({CHANGES}) SELECT date, sum((field = 'MAKTX')::INTEGER)::BIGINT AS changes,
sum((field = 'MSTAE' AND old = '' AND new = '01')::INTEGER)::BIGINT AS blocked, sum((field = 'MSTAE' AND old = '01' AND new IS NULL)::INTEGER)::BIGINT AS unblocked,
sum((field = 'LVORM' AND old = '' AND new = 'X')::INTEGER)::BIGINT AS deactivated, sum((field = 'LVORM' AND old = 'X' AND new IS NULL)::INTEGER)::BIGINT AS activated
FROM (SELECT date, field, old, coalesce(new, '~') AS x, new FROM c) GROUP BY 1""".replace("new IS NULL", "x = '~'"))
def change_log_counts(t: Tables) -> DataFrame:
    e = F.col("event_type")
    key = lambda c, pad: F.concat(F.lit(pad), F.col(c).cast("string"))
    mark = F.when(e == "error", "01").otherwise("X")
    items = t.events.select(
        F.lit("MATERIAL ").alias("class"), key("user_id", " ").alias("object"), key("event_id", "").alias("change_no"), F.lit("MARA").alias("table"),
        F.when(e == "error", "MSTAE").when(e == "signup", "LVORM").otherwise("MAKTX").alias("field"),
        F.when(F.col("event_id") % 2 == 0, mark).otherwise("").alias("old"), F.when(F.col("event_id") % 3 == 0, mark).alias("new"))
    headers = t.events.select(F.lit("MATERIAL").alias("class"), key("user_id", "").alias("object"), key("event_id", " ").alias("change_no"),
                              F.col("ts").cast("date").alias("date"))
    return p.change_counts(headers, items, "MARA", "MSTAE", "LVORM")


@query("""SELECT substr(lpad(user_id::VARCHAR, 10, '0') || lpad(event_id::VARCHAR, 6, '0'), 1, 10) AS document, ts::DATE AS date,
count(*) FILTER (event_type = 'purchase') AS price_changes, count(*) FILTER (event_type IN ('view', 'click')) AS quantity_changes FROM events GROUP BY 1, 2""")
def document_field_changes(t: Tables) -> DataFrame:
    key = F.concat(F.lpad(F.col("user_id").cast("string"), 10, "0"), F.lpad(F.col("event_id").cast("string"), 6, "0"))
    changes = t.events.select(key.alias("key"), F.col("ts").cast("date").alias("date"), F.col("event_type").alias("field"))
    return p.field_changes(changes, "key", 1, 10, {"price_changes": ("purchase",), "quantity_changes": ("view", "click")})


@query("""WITH m AS (SELECT user_id, min(ts::DATE) AS created FROM events GROUP BY 1), c AS (SELECT DISTINCT user_id, ts::DATE AS changed FROM events)
SELECT user_id, changed FROM c WHERE (user_id, changed) NOT IN (SELECT (user_id, created) FROM m)""")
def changed_members(t: Tables) -> DataFrame:
    day = F.col("ts").cast("date")
    members = t.events.groupBy("user_id").agg(F.min(day).alias("created"))
    return p.changed_members(members, t.events.select("user_id", day.alias("changed")).distinct(), "user_id", "created", "changed")


@query(f"""WITH {ITEMS}, d AS (SELECT l_orderkey, l_linenumber, arg_min(ship_date, (ship_date, l_partkey)) FILTER (l_returnflag = 'A') AS invoice_date,
  arg_min(l_partkey, (ship_date, l_partkey)) FILTER (l_returnflag = 'N') AS entry_no, arg_min(ship_date, (ship_date, l_partkey)) FILTER (l_returnflag = 'R') AS delivery_date FROM lines GROUP BY 1, 2),
c AS (SELECT l_orderkey, l_linenumber, sum(price) FILTER (l_suppkey % 3 = 0) AS duty, sum(price) FILTER (l_suppkey % 3 = 1) AS freight FROM lines GROUP BY 1, 2)
SELECT l_orderkey AS doc, lpad(l_linenumber::VARCHAR, 5, '0') AS line, CASE WHEN flag = 'N' THEN 'MT' ELSE 'EA' END AS unit,
CASE WHEN flag = 'N' THEN {near('quantity::DOUBLE / 1000')} ELSE quantity::DOUBLE END AS quantity, invoice_date, entry_no, delivery_date, duty::DOUBLE AS duty, freight::DOUBLE AS freight
FROM items JOIN d USING (l_orderkey, l_linenumber) JOIN c USING (l_orderkey, l_linenumber)""")
def import_tracker(t: Tables) -> DataFrame:
    line = F.lpad(F.col("l_linenumber").cast("string"), 5, "0")
    lines = t.items.select(F.col("l_orderkey").alias("doc"), line.alias("line"), F.col("quantity").cast("double").alias("quantity"),
                           F.when(F.col("flag") == "N", " KG").otherwise("EA").alias("unit"))
    documents = t.lines.select(F.col("l_orderkey").alias("doc"), line.alias("line"), F.col("l_returnflag").alias("kind"),
                               F.col("ship_date").alias("date"), F.col("l_partkey").alias("reference"))
    code = F.element_at(F.array(F.lit("DUTY"), F.lit("FREIGHT"), F.lit("OTHER")), (F.col("l_suppkey") % 3).cast("int") + 1)
    conditions = t.lines.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").cast("string").alias("line"), code.alias("code"), F.col("price").alias("value"))
    firsts = {"invoice_date": ("A", "date"), "entry_no": ("N", "reference"), "delivery_date": ("R", "date")}
    return rounded(p.import_tracker(lines, documents, firsts, conditions, ["DUTY", "FREIGHT"], ["doc", "line"]), ["quantity"])


@query(f"""WITH {LINES}, a AS (SELECT l_suppkey AS plant, date_trunc('month', ship_date)::DATE AS month, sum(quantity) AS v FROM lines WHERE l_linestatus = 'F' GROUP BY 1, 2),
b AS (SELECT l_suppkey AS plant, date_trunc('quarter', ship_date)::DATE AS month, sum(quantity) AS v FROM lines GROUP BY 1, 2)
SELECT coalesce(a.plant, b.plant) AS plant, coalesce(a.month, b.month) AS month, coalesce(a.v, 0)::DOUBLE AS received, coalesce(b.v, 0)::DOUBLE AS budget
FROM a FULL JOIN b ON a.plant = b.plant AND a.month = b.month WHERE coalesce(a.v, b.v) IS NOT NULL""")
def procurement_vs_budget(t: Tables) -> DataFrame:
    receipts = t.lines.where("l_linestatus = 'F'").select(F.col("l_suppkey").alias("plant"), F.col("ship_date").alias("date"), F.col("quantity").alias("tonnes"))
    out = p.procurement_vs_budget(receipts, quarter_sheet(t), ["plant"])
    return out.where("received <> 0 OR budget <> 0")


@query("""SELECT c_nationkey AS plant, count(*) FILTER (c_acctbal >= 0) AS active, count(*) FILTER (c_acctbal < 0) AS inactive FROM customer GROUP BY 1""")
def activity_counts(t: Tables) -> DataFrame:
    members = t.customer.select(F.col("c_nationkey").alias("plant"), F.when(F.col("c_acctbal") < 0, "X").alias("deleted"))
    return p.activity_counts(members, ["plant"], "deleted")


@query("SELECT c_mktsegment AS terms, count(DISTINCT c_custkey) AS members FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def members_per_term(t: Tables) -> DataFrame:
    sold = lookup(t.orders, t.customer, [("o_custkey", "c_custkey")], [("c_mktsegment", "terms")], how="inner")
    return p.distinct_members(sold, ["terms"], "o_custkey", "members")


# --- production ---------------------------------------------------------------------------

CONF = f"""{LINES}, moved AS (SELECT *, {CODE_SQL} AS code, CASE WHEN l_linenumber % 3 = 0 THEN 'MT' ELSE 'KG' END AS unit FROM lines),
kg AS (SELECT *, CASE unit WHEN 'MT' THEN quantity * 1000 ELSE quantity END AS k FROM moved),
net AS (SELECT *, CASE WHEN code = '261' THEN k WHEN code = '262' THEN -k END AS w FROM kg),
conf AS (SELECT l_orderkey, l_linenumber, min(ship_date) AS date, sum(quantity) AS made FROM lines GROUP BY 1, 2),
ord AS (SELECT l_orderkey, count(*) AS n, sum(made) AS order_made FROM conf GROUP BY 1 HAVING sum(made) <> 0),
planned AS (SELECT l_orderkey, sum(w) AS planned_weight FROM net GROUP BY 1),
actual AS (SELECT l_orderkey, l_linenumber, sum(w) AS actual_weight, sum(CASE WHEN l_suppkey % 4 = 0 THEN -w ELSE 0 END) AS scrap FROM net GROUP BY 1, 2),
centre AS (SELECT l_orderkey, arg_max(l_suppkey, (l_linenumber * 1000000 + l_suppkey)) AS work_centre FROM lines GROUP BY 1)"""


@query(f"""WITH {CONF} SELECT l_orderkey AS "order", l_linenumber AS confirmation, date, order_made::DOUBLE AS order_made, planned_weight::DOUBLE AS planned_weight,
actual_weight::DOUBLE AS actual_weight, scrap::DOUBLE AS scrap, CASE WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Open' END AS status, work_centre,
{near('o_totalprice * 1000 / n', 3)} AS planned_quantity_split FROM conf JOIN ord USING (l_orderkey) JOIN orders ON o_orderkey = l_orderkey LEFT JOIN planned USING (l_orderkey)
LEFT JOIN actual USING (l_orderkey, l_linenumber) LEFT JOIN centre USING (l_orderkey)""")
def production_confirmations(t: Tables) -> DataFrame:
    c = F.col
    order, conf = c("l_orderkey").alias("order"), c("l_linenumber").alias("confirmation")
    unit = F.when(c("l_linenumber") % 3 == 0, "MT").otherwise("KG").alias("unit")
    orders = t.orders.select(c("o_orderkey").alias("order"), (c("o_totalprice") * 1000).alias("planned_quantity"))
    confirmations = t.lines.groupBy(order, conf).agg(F.min("ship_date").alias("date"), F.sum("quantity").alias("made"))
    operations = t.lines.select(order, (c("l_linenumber") * 1000000 + c("l_suppkey")).alias("step"), c("l_suppkey").alias("centre"))
    movements = moved(t).select(order, conf, unit, "move_type", (c("l_suppkey") % 4).alias("group"), "quantity")
    states = t.orders.select(c("o_orderkey").alias("order"), F.when(c("o_orderstatus") == "F", "I0045").otherwise("I0001").alias("state"))
    out = pr.production_confirmations(orders, confirmations, operations, movements, movements, states, {"scrap": (0,)})
    return out.select(
        "order", "confirmation", "date", "order_made", "planned_weight", "actual_weight", "scrap", "status", "work_centre", "planned_quantity_split")


@query(f"""WITH {LINES}, {FACTORS}, moved AS (SELECT *, {CODE_SQL} AS code FROM lines) SELECT l_suppkey AS plant, l_partkey AS material,
sum(CASE WHEN code = '102' THEN -quantity ELSE quantity END)::DOUBLE AS quantity,
{near("sum((CASE WHEN code = '102' THEN -quantity ELSE quantity END)::DOUBLE * CASE WHEN f.numerator IS NOT NULL THEN f.numerator::DOUBLE / 10 WHEN l_partkey % 8 = 0 THEN p_size * 0.5::DOUBLE ELSE 1 END)")} AS kilograms
FROM moved JOIN part ON p_partkey = l_partkey LEFT JOIN factors f ON f.material = l_partkey WHERE code IN ('101', '102') GROUP BY 1, 2""")
def production_receipts(t: Tables) -> DataFrame:
    receipts = moved(t).where("move_type IN ('101', '102')").select(
        F.col("l_suppkey").alias("plant"), F.col("l_partkey").alias("material"), "move_type", "quantity", F.col("ship_date").alias("date"), F.lit("KG").alias("unit"))
    # Half of the parts without a factor have a weight in every plant, the others count as kilograms.
    places = t.lineitem.where("l_partkey % 8 = 0").select(F.col("l_partkey").alias("material"), F.col("l_suppkey").alias("plant")).distinct()
    weights = lookup(places, t.part, [("material", "p_partkey")], ["p_size"]).select(
        "material", "plant", F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        (F.col("p_size") * F.lit(0.5)).alias("weight"))
    return rounded(pr.production_receipts(receipts, factors(t), weights, ["plant", "material"], ("102",)), ["kilograms"])


@query(f"""WITH {LINES}, moved AS (SELECT *, {CODE_SQL} AS code FROM lines) SELECT l_suppkey AS plant, date_trunc('month', ship_date)::DATE AS month,
sum(CASE WHEN code = '261' THEN quantity ELSE -quantity END)::DOUBLE AS quantity, sum(CASE WHEN code = '261' THEN price ELSE -price END)::DOUBLE AS value
FROM moved WHERE code IN ('261', '262') GROUP BY 1, 2""")
def material_usage(t: Tables) -> DataFrame:
    rows = moved(t).withColumns({"plant": F.col("l_suppkey"), "month": F.trunc("ship_date", "MM"), "value": F.col("price")})
    return pr.material_usage(rows, ["plant", "month"], ("261",), ("262",))


@query(f"""WITH {ITEMS}, moved AS (SELECT *, {CODE_SQL} AS code FROM lines), ex AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lines WHERE l_returnflag = 'A'),
r AS (SELECT l_orderkey, l_linenumber, sum(CASE WHEN l_suppkey % 2 = 0 THEN tax / 10 ELSE 0 END) AS igst, sum(CASE WHEN l_suppkey % 2 = 1 THEN tax / 10 ELSE 0 END) AS cgst,
  sum(CASE WHEN code = '102' THEN -quantity ELSE quantity END) AS got FROM moved GROUP BY 1, 2)
SELECT l_orderkey AS doc, l_linenumber AS item, CASE WHEN e.l_orderkey IS NOT NULL THEN 'excise' ELSE 'direct' END AS path,
CASE WHEN e.l_orderkey IS NOT NULL THEN 'E' || i.l_orderkey END AS document, CASE WHEN e.l_orderkey IS NOT NULL THEN ship_date + 1 ELSE ship_date END AS document_date,
{near('igst')} AS igst, {near('cgst')} AS cgst, got::DOUBLE AS received_quantity FROM items i LEFT JOIN ex e USING (l_orderkey, l_linenumber) LEFT JOIN r USING (l_orderkey, l_linenumber)""")
def stock_transfers(t: Tables) -> DataFrame:
    keys = [F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("item")]
    lines = t.items.select(*keys, F.col("ship_date").alias("date"))
    flagged = t.lines.where("l_returnflag = 'A'").select("l_orderkey", "l_linenumber").distinct()
    excise = t.items.join(flagged, ["l_orderkey", "l_linenumber"], "inner").select(
        *keys, F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("document"), F.date_add("ship_date", 1).alias("document_date"))
    rates = t.lines.select(*keys, F.when(F.col("l_suppkey") % 2 == 0, "JOIG").otherwise("JOCG").alias("code"), F.col("tax").cast("double").alias("rate"))
    receipts = moved(t).select(*keys, "move_type", "quantity")
    out = pr.stock_transfers(lines, excise, rates, receipts, {"igst": "JOIG", "cgst": "JOCG"}, ["doc", "item"])
    return rounded(out, ["igst", "cgst"]).drop("date")


# --- quality ------------------------------------------------------------------------------

SHIFT = "CASE WHEN hour(ts) < 8 THEN 'A' WHEN hour(ts) < 16 THEN 'B' ELSE 'C' END"


@query(f"""WITH e AS (SELECT event_type AS defect, user_id AS plant, {SHIFT} AS shift, value::DECIMAL(18,2) AS ea FROM events)
SELECT defect, plant, {', '.join(f"coalesce(sum(ea) FILTER (shift = '{x}'), 0)::DOUBLE AS {x}_ea, coalesce(sum(ea * 2) FILTER (shift = '{x}'), 0)::DOUBLE AS {x}_mt, coalesce(sum(ea + 1) FILTER (shift = '{x}'), 0)::DOUBLE AS {x}_made" for x in 'ABC')}
FROM e GROUP BY 1, 2""")
def rejection_by_shift(t: Tables) -> DataFrame:
    hour = F.hour("ts")
    rows = t.events.select(
        "event_id", F.col("event_type").alias("defect"), F.col("user_id").alias("plant"), F.when(hour < 8, "A").when(hour < 16, "B").otherwise("C").alias("shift"),
        F.col("value").cast("decimal(18,2)").alias("ea")).withColumns({"mt": F.col("ea") * 2, "made": F.col("ea") + 1})
    paths = [rows.where("event_id % 2 = 0"), rows.where("event_id % 3 = 0"), rows.where("event_id % 2 <> 0")]
    return q.rejection_by_shift(paths, ["defect", "plant"], "shift", ["A", "B", "C"], ["ea", "mt", "made"])


@query("""WITH r AS (SELECT user_id AS plant, ts::DATE AS date, count(*) FILTER (event_type = 'click') AS c, count(*) FILTER (event_type = 'view') AS v,
  max(value) FILTER (event_type = 'click') AS cv, max(value) FILTER (event_type = 'view') AS vv FROM events GROUP BY 1, 2), x AS (
SELECT plant, date, 'CLICK' AS parameter, c AS rating, cv AS value FROM r UNION ALL SELECT plant, date, 'VIEW', v, vv FROM r)
SELECT x.*, g.target FROM x LEFT JOIN (SELECT user_id AS plant, upper(event_type) AS parameter, count(*) AS target FROM events GROUP BY 1, 2) g USING (plant, parameter)""")
def plant_ratings(t: Tables) -> DataFrame:
    e = F.col("event_type")
    sheet = t.events.groupBy(F.col("user_id").alias("plant"), F.col("ts").cast("date").alias("date")).agg(
        F.count(F.when(e == "click", 1)).alias("CLICK_RATING"), F.max(F.when(e == "click", F.col("value"))).alias("CLICK_VALUE"),
        F.count(F.when(e == "view", 1)).alias("VIEW_RATING"), F.max(F.when(e == "view", F.col("value"))).alias("VIEW_VALUE"))
    targets = t.events.groupBy(F.col("user_id").alias("plant"), F.upper("event_type").alias("parameter")).agg(F.count(F.lit(1)).alias("target"))
    return q.ratings(sheet, ["plant", "date"], ["CLICK", "VIEW"], targets, ["plant", "parameter"])


@query("""WITH s AS (SELECT 'suppliers' AS sheet, s_suppkey AS id, a.parameter, a.value FROM supplier, LATERAL (VALUES ('balance', s_acctbal), ('nation', s_nationkey::DOUBLE)) a(parameter, value)
UNION ALL SELECT 'customers', c_custkey, a.parameter, a.value FROM customer, LATERAL (VALUES ('balance', c_acctbal), ('place', c_nationkey::DOUBLE)) a(parameter, value))
SELECT s.*, CASE parameter WHEN 'balance' THEN 'money' WHEN 'nation' THEN 'geography' END AS parameter_group FROM s""")
def survey_rows(t: Tables) -> DataFrame:
    sheets = {"suppliers": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")),
              "customers": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("place"))}
    groups = t.spark.createDataFrame([("balance", "money"), ("nation", "geography")], "parameter string, parameter_group string")
    return q.survey_rows(sheets, ["id"], "sheet", groups)


@query("SELECT doc_id, trim(w) AS word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) WHERE trim(w) <> ''")
def list_column_to_rows(t: Tables) -> DataFrame:
    return reshape.split_rows(t.documents, "text", " ", "word", ["doc_id"])


@query("""WITH s AS (SELECT conv_id, min(text) FILTER (turn = 0 AND role = 'user') AS title FROM conversations GROUP BY 1),
x AS (SELECT conv_id, turn, role || ' - ' || length(text) || ' , ' || CASE WHEN role = 'user' THEN 'In Progress' ELSE 'done' END AS line FROM conversations)
SELECT s.conv_id, s.title, string_agg(line, ' : ' ORDER BY turn, line) AS test_results FROM s JOIN x USING (conv_id) GROUP BY 1, 2""")
def sample_tracker(t: Tables) -> DataFrame:
    c = t.conversations
    samples = c.groupBy("conv_id").agg(F.min(F.when((F.col("turn") == 0) & (F.col("role") == "user"), F.col("text"))).alias("title"))
    tests = c.select("conv_id", "turn", F.col("role").alias("param"), F.length("text").cast("string").alias("value"),
                     F.when(F.col("role") == "user", "").otherwise("done").alias("result"))
    return q.sample_results(samples, tests, "conv_id", "turn")


@query("""WITH f AS (SELECT user_id AS id, event_type, arg_min(props, (ts, event_id)) AS remark, min(ts)::DATE AS date, arg_min(event_id, (ts, event_id)) AS plant,
  arg_min(value, (ts, event_id)) AS quantity FROM events GROUP BY 1, 2), g AS (SELECT * FROM f WHERE event_type = 'signup'),
i AS (SELECT * FROM f WHERE event_type = 'view' AND id % 3 <> 0), c AS (SELECT * FROM f WHERE event_type = 'purchase' AND id % 2 = 0)
SELECT g.id, g.date AS complaint_date, i.date AS inv_date, c.date AS cmp_date, CASE WHEN c.id IS NOT NULL THEN 'Compensated' WHEN i.id IS NOT NULL THEN 'Investigated' ELSE 'Registered' END AS stage,
CASE WHEN c.id IS NOT NULL THEN c.remark WHEN i.id IS NOT NULL THEN i.remark ELSE g.remark END AS remark, coalesce(c.plant, i.plant, g.plant) AS plant,
coalesce(c.quantity, i.quantity) AS quantity, abs(date_diff('day', g.date, i.date)) AS days_to_attend, abs(date_diff('day', i.date, c.date)) AS days_to_compensate
FROM g LEFT JOIN i USING (id) LEFT JOIN c USING (id)""")
def complaint_life_cycle(t: Tables) -> DataFrame:
    order = F.struct("ts", "event_id")
    first = t.events.groupBy(F.col("user_id").alias("id"), "event_type").agg(
        F.min_by("props", order).alias("remark"), F.min("ts").cast("date").alias("date"), F.min_by("event_id", order).alias("plant"),
        F.min_by("value", order).alias("quantity"))
    kind = lambda k: first.where(F.col("event_type") == k)
    return q.complaint_life_cycle(kind("signup").drop("quantity"), kind("view").where("id % 3 <> 0"), kind("purchase").where("id % 2 = 0"))


STATUSES = [*q.AT_COMPLAINT, *q.AT_INVESTIGATION, *q.AT_COMPENSATION]
_STATUS_SQL = "CASE o_orderkey % 11 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STATUSES)) + " END"
_SUMS = lambda p: ", ".join(f"sum({c}) AS {p}_{c}" for c in q.SUPPLIED)


@query(f"""WITH {ITEMS}, {SALES_ORDERS},
co AS (SELECT o_orderkey AS id, 'SBU' || (o_orderkey % 3 + 1) AS unit, o_custkey % 4 AS category, order_date AS date, o_orderpriority AS cancel_remark,
  'c' || o_custkey AS customer, {_STATUS_SQL} AS final_status FROM sales_orders),
inv0 AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS complaint, CASE WHEN flag = 'R' THEN 'DRAFT' ELSE 'DONE' END AS status, ship_date AS date,
  'i' || suppkey AS remark, 'j' || partkey AS customer FROM items WHERE l_linenumber <= 2),
il AS (SELECT l_orderkey * 10 + CASE WHEN l_suppkey % 2 = 0 THEN 2 ELSE 1 END AS id, l_suppkey AS plant, quantity AS supplied, price AS broken, discount AS loss
  FROM lines WHERE l_linenumber IN (2, 3)),
cl AS (SELECT l_orderkey * 10 + 5 AS id, l_suppkey AS plant, quantity AS supplied, price AS broken, discount AS loss, l_returnflag AS code, l_partkey AS invoice,
  'SBU' || (l_orderkey % 3 + 1) AS unit FROM lines WHERE l_linenumber = 5 AND l_orderkey % 7 <> 0),
inv AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY complaint) AS n FROM inv0) WHERE (n = 1 OR id IN (SELECT id FROM il)) AND status <> 'DRAFT'),
cmp AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS complaint, ship_date AS date, 'k' || suppkey AS remark, 'm' || partkey AS customer
  FROM items WHERE l_linenumber = 5 AND status <> 'F'),
reg AS (SELECT DISTINCT l_orderkey AS complaint, l_suppkey % 5 AS plant FROM lines WHERE l_linenumber > 3),
base AS (SELECT co.*, inv.id AS inv_id, inv.date AS inv_date, inv.remark AS inv_remark, inv.customer AS inv_customer, cmp.id AS cmp_id, cmp.date AS cmp_date,
  cmp.remark AS cmp_remark, cmp.customer AS cmp_customer FROM co LEFT JOIN inv ON inv.complaint = co.id LEFT JOIN cmp ON cmp.complaint = co.id),
cp AS (SELECT id, plant, {_SUMS('c')} FROM cl GROUP BY 1, 2), ip AS (SELECT id, plant, {_SUMS('i')} FROM il GROUP BY 1, 2),
ct AS (SELECT id, {_SUMS('c')} FROM cl GROUP BY 1), it AS (SELECT id, {_SUMS('i')} FROM il GROUP BY 1),
listed AS (SELECT b.id, b.inv_id, b.cmp_id, p.plant FROM base b JOIN cp p ON p.id = b.cmp_id WHERE unit = 'SBU1'
  UNION ALL SELECT b.id, b.inv_id, b.cmp_id, p.plant FROM base b JOIN ip p ON p.id = b.inv_id WHERE unit = 'SBU1' AND coalesce(b.cmp_id NOT IN (SELECT id FROM cp), true)),
rows AS (SELECT b.*, l.plant, {', '.join(f'coalesce(c_{c}, i_{c}) AS {c}' for c in q.SUPPLIED)} FROM base b
    LEFT JOIN listed l ON l.id = b.id AND l.inv_id IS NOT DISTINCT FROM b.inv_id AND l.cmp_id IS NOT DISTINCT FROM b.cmp_id
    LEFT JOIN cp ON cp.id = b.cmp_id AND cp.plant = l.plant LEFT JOIN ip ON ip.id = b.inv_id AND ip.plant = l.plant WHERE unit = 'SBU1'
  UNION ALL SELECT b.*, reg.plant, {', '.join(f'coalesce(c_{c}, i_{c}) AS {c}' for c in q.SUPPLIED)} FROM base b
    LEFT JOIN reg ON reg.complaint = b.id LEFT JOIN ct ON ct.id = b.cmp_id LEFT JOIN it ON it.id = b.inv_id WHERE unit <> 'SBU1'),
d AS (SELECT unit, id, arg_min(code, (invoice, code)) AS defect, min(invoice) AS invoice FROM cl GROUP BY 1, 2),
n AS (SELECT DISTINCT 'SBU' || (l_orderkey % 3 + 1) AS unit, l_suppkey % 4 AS category, l_returnflag AS code FROM lineitem WHERE l_suppkey % 4 > 0)
SELECT r.id, r.unit, r.category, inv_id, cmp_id, final_status, CASE final_status WHEN 'Complaint Rejected' THEN cancel_remark WHEN 'Investigation Rejected' THEN inv_remark
  WHEN 'Compensation Rejected' THEN cmp_remark END AS remark, CASE WHEN final_status IN ('{"', '".join(q.AT_INVESTIGATION)}') THEN inv_customer
  WHEN final_status IN ('{"', '".join(q.AT_COMPENSATION)}') THEN cmp_customer ELSE customer END AS customer, plant, supplied::DOUBLE AS supplied, broken::DOUBLE AS broken,
  loss::DOUBLE AS loss, defect, invoice, n.code || n.category AS defect_name, CASE WHEN contains(final_status, 'Rejected') THEN date END AS rejected_on,
  abs(date_diff('day', date, inv_date)) AS days_to_attend, abs(date_diff('day', inv_date, cmp_date)) AS days_to_compensate
FROM rows r LEFT JOIN d ON d.unit = r.unit AND d.id = r.cmp_id LEFT JOIN n ON n.unit = r.unit AND n.category = r.category AND n.code = d.defect""")
def complaint_tracker(t: Tables) -> DataFrame:
    c = F.col
    text = lambda mark, column: F.concat(F.lit(mark), c(column).cast("string"))
    unit = lambda column: F.concat(F.lit("SBU"), (c(column) % 3 + 1).cast("string")).alias("unit")
    place = first_match([(c("o_orderkey") % 11 == i, s) for i, s in enumerate(STATUSES)])
    complaints = t.sales_orders.select(
        c("o_orderkey").alias("id"), unit("o_orderkey"), (c("o_custkey") % 4).alias("category"), c("order_date").alias("date"),
        c("o_orderpriority").alias("cancel_remark"), text("c", "o_custkey").alias("customer"))
    statuses = t.sales_orders.select(c("o_orderkey").alias("complaint"), place.alias("final_status"))
    document = lambda df, remark, customer, draft: df.select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("id"), c("l_orderkey").alias("complaint"), F.when(draft, q.DRAFT).otherwise("DONE").alias("status"),
        c("ship_date").alias("date"), text(remark, "suppkey").alias("cancel_remark"), text(customer, "partkey").alias("customer"))
    investigations = document(t.items.where("l_linenumber <= 2"), "i", "j", c("flag") == "R")
    compensations = document(t.items.where("l_linenumber = 5"), "k", "m", c("status") == "F")
    supply = lambda df, id_, *more: df.select(
        id_.alias("id"), c("l_suppkey").alias("plant"), c("quantity").alias("supplied"), c("price").alias("broken"), c("discount").alias("loss"), *more)
    lines = t.lines
    inv_lines = supply(lines.where("l_linenumber IN (2, 3)"), c("l_orderkey") * 10 + F.when(c("l_suppkey") % 2 == 0, 2).otherwise(1))
    paid = supply(lines.where("l_linenumber = 5 AND l_orderkey % 7 <> 0"), c("l_orderkey") * 10 + 5, c("l_returnflag").alias("code"),
                  c("l_partkey").alias("invoice"), unit("l_orderkey"))
    plants = lines.where("l_linenumber > 3").select(c("l_orderkey").alias("complaint"), (c("l_suppkey") % 5).alias("plant"))
    names = lines.where("l_suppkey % 4 > 0").select(unit("l_orderkey"), (c("l_suppkey") % 4).alias("category"), c("l_returnflag").alias("code")).distinct()
    names = names.withColumn("name", F.concat("code", c("category").cast("string")))
    return q.complaint_tracker(complaints, statuses, investigations, compensations, plants, inv_lines, paid.drop("code", "invoice", "unit"),
                               paid.select("unit", "id", "code", "invoice"), names)


@query("""SELECT coalesce(nullif(c_name, 'Customer#000000003'), 'user ' || user_id) AS customer, year(ts) - 1 AS fiscal_year, count(DISTINCT ts::DATE) AS visits
FROM events LEFT JOIN customer ON c_custkey = user_id GROUP BY 1, 2""")
def visit_frequency(t: Tables) -> DataFrame:
    visits = lookup(t.events, t.customer, [("user_id", "c_custkey")], ["c_name"])
    name = F.coalesce(F.nullif("c_name", F.lit("Customer#000000003")), F.concat(F.lit("user "), F.col("user_id").cast("string")))
    day = F.col("ts").cast("date")
    return q.visit_frequency(visits, name, fiscal_year(day), day)


@query("""WITH lots AS (SELECT o_orderkey AS lot, o_orderstatus FROM orders), ch AS (SELECT DISTINCT l_orderkey AS lot, l_returnflag AS characteristic FROM lineitem),
res AS (SELECT l_orderkey AS lot, l_returnflag AS characteristic, max(l_quantity) AS result FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2)
SELECT lot, o_orderstatus, characteristic, result FROM lots JOIN ch USING (lot) LEFT JOIN res USING (lot, characteristic)""")
def inspection_results(t: Tables) -> DataFrame:
    lot, ch = F.col("l_orderkey").alias("lot"), F.col("l_returnflag").alias("characteristic")
    results = t.lineitem.where("l_linestatus = 'F'").groupBy(lot, ch).agg(F.max("l_quantity").alias("result"))
    return q.inspection_results(t.orders.select(F.col("o_orderkey").alias("lot"), "o_orderstatus"), t.lineitem.select(lot, ch).distinct(), results)


@query(f"""WITH {LINES}, moved AS (SELECT *, {CODE_SQL} AS code FROM lines) SELECT l_suppkey AS plant, sum(CASE WHEN code IN ('102', '122') THEN -quantity ELSE quantity END)::DOUBLE AS quantity,
{near("sum(CASE WHEN code IN ('102', '122') THEN -quantity ELSE quantity END * CASE WHEN l_partkey % 4 <> 0 THEN p_size END)::DOUBLE / 10 / 1000")} AS tonnes
FROM moved JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def signed_rejections(t: Tables) -> DataFrame:
    rows = moved(t).withColumns({"plant": F.col("l_suppkey"), "material": F.col("l_partkey")})
    return rounded(q.signed_rejections(rows, factors(t), ["plant"], ("102", "122")), ["tonnes"])


@query("""WITH r AS (SELECT l_orderkey AS lot, l_linenumber AS ch, min(l_quantity) AS mean FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) = 1),
x AS (SELECT l_orderkey AS lot, l_linenumber AS ch, max(l_linestatus) AS text FROM lineitem WHERE l_orderkey % 10 <> 0 GROUP BY 1, 2)
SELECT o_orderkey AS lot, o_custkey AS vendor, o_totalprice AS score, x.text AS remark, r.mean AS mean_value FROM orders
LEFT JOIN r ON r.lot = o_orderkey LEFT JOIN x ON x.lot = r.lot AND x.ch = r.ch WHERE o_orderstatus <> 'P'""")
def vendor_rating(t: Tables) -> DataFrame:
    lot, ch = F.col("l_orderkey").alias("lot"), F.col("l_linenumber").alias("characteristic")
    lots = t.orders.select(F.col("o_orderkey").alias("lot"), F.col("o_custkey").alias("vendor"))
    decisions = t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("lot"), F.col("o_totalprice").alias("score"))
    results = t.lineitem.where("l_returnflag = 'R'").select(lot, ch, F.col("l_quantity").alias("mean"))
    # Every tenth lot has no texts, so that an unmatched characteristic is met.
    texts = t.lineitem.where("l_orderkey % 10 <> 0").groupBy(lot, ch).agg(F.max("l_linestatus").alias("text"))
    return q.vendor_rating(lots, decisions, results, texts)


@query("""WITH d AS (SELECT l_orderkey AS notice, l_returnflag AS grp, l_linestatus AS code, sum(l_quantity)::BIGINT AS pieces FROM lineitem GROUP BY 1, 2, 3)
SELECT o_orderkey AS lot, o_custkey % 50 AS plant, o_orderkey % 200 AS material, n.o AS notice, grp AS "group", code, pieces,
CASE WHEN o_custkey % 50 < 10 THEN pieces * (p_retailprice / 8) / 1000 ELSE pieces * p_size::DOUBLE / 1000 END AS breakage
FROM orders LEFT JOIN (SELECT o_orderkey AS o FROM orders WHERE o_orderkey % 3 <> 0) n ON n.o = o_orderkey LEFT JOIN d ON d.notice = n.o
LEFT JOIN part ON p_partkey = o_orderkey % 200""")
def loading_breakages(t: Tables) -> DataFrame:
    c = F.col
    lots = t.orders.select(c("o_orderkey").alias("lot"), (c("o_custkey") % 50).alias("plant"), (c("o_orderkey") % 200).alias("material"))
    notices = t.orders.where("o_orderkey % 3 <> 0").select(c("o_orderkey").alias("lot"), c("o_orderkey").alias("notice"))
    defects = t.lineitem.groupBy(c("l_orderkey").alias("notice"), c("l_returnflag").alias("group"), c("l_linestatus").alias("code")).agg(
        F.sum("l_quantity").cast("long").alias("pieces"))
    materials = t.part.select(c("p_partkey").alias("material"), c("p_size").cast("double").alias("gross_kg"), (c("p_retailprice") / 8).alias("litres"))
    volume = t.customer.select((c("c_custkey") % 50).alias("plant")).where("plant < 10")
    return q.loading_breakages(lots, notices, defects, materials, volume)


@query(f"""WITH {LINES}, m AS (SELECT *, {CODE_SQL} AS code FROM lines WHERE l_linenumber IN (1, 2))
SELECT l_suppkey AS plant, sum(CASE WHEN l_linenumber = 1 THEN CASE code WHEN '102' THEN -quantity ELSE quantity END END)::DOUBLE AS usable,
sum(CASE WHEN l_linenumber = 2 THEN CASE code WHEN '102' THEN -quantity ELSE quantity END END)::DOUBLE AS unusable
FROM m WHERE code IN ('101', '102') GROUP BY 1""")
def plant_rejections(t: Tables) -> DataFrame:
    rows = moved(t).select(F.col("l_suppkey").alias("plant"), "move_type", F.col("l_linenumber").cast("string").alias("location"),
                           F.col("quantity").alias("tonnes"))
    out = q.plant_rejections(rows, {"usable": "1", "unusable": "2"}, "101", "102")
    return out.groupBy("plant").agg(F.sum("usable").alias("usable"), F.sum("unusable").alias("unusable"))


@query("""SELECT user_id, arg_min(event_type, (ts, event_id)) AS event_type, arg_min(props, (ts, event_id)) AS props,
sum(value::DECIMAL(18,2))::DOUBLE AS value FROM events GROUP BY 1""")
def visit_tracker(t: Tables) -> DataFrame:
    typed = t.events.withColumn("value", F.col("value").cast("decimal(18,2)"))
    return q.visit_tracker(typed, "user_id", ["ts", "event_id"], ["event_type", "props"], ["value"])


@query("""SELECT ts::DATE AS date, count(DISTINCT user_id) AS changes FROM events WHERE event_type <> 'view'
AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1""")
def member_changes(t: Tables) -> DataFrame:
    parts = [F.lit("DEBI").alias("class"), F.col("user_id").alias("object"), F.col("event_id").alias("change_no")]
    headers = t.events.select(*parts, F.col("ts").cast("date").alias("date"))
    members = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("object"))
    return p.member_changes(headers, t.events.where("event_type <> 'view'").select(*parts), members)
