"""Sales queries: line items carry the pricing conditions, orders are the invoices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import first_match
from ..operators.calendar import date_dimension
from ..operators.joins import lookup
from ..operators.windows import pick_row
from ..plans import sales as s
from ..session import SHARED_KEYS_CONF
from .core import ITEMS, LINES, SALES_ORDERS, Tables, items_of, laid_by, near, query, rounded
from .relational import RATES, weight_versions

# One pricing condition per raw line: the code comes from its two flags and line number.
CODES = ["ZASS", "JEXP", "ZVAT", "ZEXP", "ZFRF", "ZCNF", "ZBP4", "ZAD1", "ZBP1", "ZBPB", "ZF01", "JOCG",
         "ZD01", "ZMUL", "ZDFR", "JCST", "ZF02", "ZF00", "ZIFR", "ZRDF", "ZF05"]
_LIST = ", ".join(f"'{c}'" for c in CODES)
CONDITIONS = f"""{LINES}, conditions AS (
  SELECT l_orderkey AS doc, l_linenumber AS line, list_extract([{_LIST}], (l_partkey % 21)::INTEGER + 1) AS code,
    (price * discount)::DECIMAL(18,2) AS value, (tax * 100)::DECIMAL(18,2) AS rate, price AS base,
    (1 + discount)::DECIMAL(9,2) AS fx, quantity, CASE WHEN l_suppkey % 3 = 0 THEN '17' ELSE '-' END AS customer_group,
    CASE WHEN l_suppkey % 5 = 0 THEN 'FOR' ELSE 'EXW' END AS terms,
    CASE WHEN l_suppkey % 2 = 0 THEN '2000' ELSE '1000' END AS org, CASE WHEN l_suppkey % 2 = 0 THEN '23' ELSE '11' END AS division,
    CASE WHEN l_returnflag = 'N' THEN 'ZFOC' ELSE 'F2' END AS billing_type,
    CASE WHEN l_partkey % 21 IN (6, 8) THEN 'PRICE' WHEN l_partkey % 21 = 7 THEN 'ADD' END AS condition_class
  FROM lines)"""


def conditions(lines: DataFrame) -> DataFrame:
    c = F.col
    pick = F.element_at(F.array(*[F.lit(x) for x in CODES]), (c("l_partkey") % 21).cast("int") + 1)
    even = c("l_suppkey") % 2 == 0
    kind = c("l_partkey") % 21
    return lines.select(
        c("l_orderkey").alias("doc"), c("l_linenumber").alias("line"), pick.alias("code"),
        (c("price") * c("discount")).cast("decimal(18,2)").alias("value"),
        (c("tax") * 100).cast("decimal(18,2)").alias("rate"), c("price").alias("base"),
        (c("discount") + 1).cast("decimal(18,2)").alias("fx"), "quantity",
        F.when(c("l_suppkey") % 3 == 0, "17").otherwise("-").alias("customer_group"),
        F.when(c("l_suppkey") % 5 == 0, "FOR").otherwise("EXW").alias("terms"),
        F.when(even, "2000").otherwise("1000").alias("org"), F.when(even, "23").otherwise("11").alias("division"),
        F.when(c("l_returnflag") == "N", "ZFOC").otherwise("F2").alias("billing_type"),
        F.when(kind.isin(6, 8), "PRICE").when(kind == 7, "ADD").alias("condition_class"))


_V = lambda code, column="value", also="true": f"max(CASE WHEN code = '{code}' AND {also} THEN {column} END)"
_HAS = lambda code, also="true": f"bool_or(code = '{code}' AND {also})"
_DIRECT = "customer_group = '17'"
_KEY = "doc, line"


@query(f"""WITH {CONDITIONS} SELECT {_KEY}, coalesce(CASE
WHEN {_HAS('ZASS', _DIRECT)} THEN {_V('ZASS', also=_DIRECT)}
WHEN {_HAS('JEXP')} THEN {_V('JEXP', 'base')} WHEN {_HAS('ZVAT')} THEN {_V('ZVAT', 'base')} * 0.875
WHEN {_HAS('JCST')} THEN {_V('JCST', 'base')} * 0.875 WHEN {_HAS('ZEXP')} THEN {_V('ZEXP')} * {_V('ZEXP', 'fx')}
WHEN {_HAS('ZASS')} THEN {_V('ZASS')} END, 0)::DECIMAL(25,2)::DOUBLE AS assessable_value FROM conditions GROUP BY 1, 2""")
def assessable_value(t: Tables) -> DataFrame:
    return s.assessable_value(conditions(t.lines), ["doc", "line"])


@query(f"""WITH {CONDITIONS} SELECT {_KEY}, coalesce(CASE WHEN NOT bool_or(terms = 'FOR') AND {_HAS('ZCNF')} THEN
coalesce({_V('ZFRF', 'rate')}, {_V('ZDFR', 'rate')}, 0) * {_V('ZCNF')} END, 0)::DECIMAL(25,2)::DOUBLE AS secondary_freight
FROM conditions GROUP BY 1, 2""")
def secondary_freight(t: Tables) -> DataFrame:
    return s.secondary_freight(conditions(t.lines), ["doc", "line"])


_AT = lambda code, org, div: (
    f"""WHEN {_HAS(code)} THEN coalesce({_V(code, also=f"org = '{org}' AND division IN ({div})")}, 0)""")


@query(f"""WITH {CONDITIONS} SELECT {_KEY}, coalesce(CASE WHEN {_HAS('ZBP4')} THEN {_V('ZBP4')} + CASE {_AT('ZAD1', '2000', "'23'")} ELSE 0 END
ELSE CASE {_AT('ZBP1', '1000', "'11'")} {_AT('ZBPB', '2000', "'21', '22', '23', '24', '25'")} {_AT('ZAD1', '2000', "'23'")} ELSE 0 END
END, 0)::DOUBLE AS base_price FROM conditions GROUP BY 1, 2""")
def base_price(t: Tables) -> DataFrame:
    return s.base_price(conditions(t.lines), ["doc", "line"])


_S = lambda cond, amount="value", rest="0": f"sum(CASE WHEN {cond} THEN {amount} ELSE {rest} END)::DOUBLE"
MEASURE_SQL = {
    "freight": _S("code <> 'ZF05'"), "trade_dis": _S("code <> 'ZTRD'"), "jkfc_dis": _S("code <> 'JKFC'"),
    "jkfc_rate": _S("code <> 'JKFC'", "rate * 0.1"),
    **{f"p_{c.lower()}": _S(f"billing_type <> 'ZFOC' AND code = '{c}'", "rate * 0.1") for c in
       ("JEXP", "ZETX", "JCST", "ZVAT", "ZGTA", "ZTCS", "ZETO", "ZSSC", "ZB01")},
    "zrdf": _S("billing_type <> 'ZFOC' AND code = 'ZRDF'", "rate * 0.1", "rate"),
    **{c.lower(): _S(f"code = '{c}'", "value * fx") for c in ("ZIFR", "ZPAK", "ZFOB", "ZCMP")},
    **{f"{n}_{k}": _S(f"code = '{c}'", a) for n, c in (("cgst", "JOCG"), ("sgst", "JOSG"), ("igst", "JOIG"), ("ugst", "JOUG"))
       for k, a in (("rate", "rate * 0.1"), ("amnt", "value"))},
    "zf00": _S("code = 'ZF00'"), "frgt_zf02": _S("code = 'ZF02'"), "frgt_zf01": _S("code = 'ZF01'"),
    "ztaxturn": _S("condition_class IS NOT NULL"), "zbasfin": _S("condition_class = 'PRICE'"),
    "zmul": _S("code = 'ZMUL'"), "zins": _S("code = 'ZINS'"), "zmrp": _S("code = 'ZMRP'"),
    **{c.lower(): _S(f"code = '{c}'", "-value") for c in ("ZD01", "ZD02", "ZD03")},
    **{c.lower(): _S(f"code = '{c}'") for c in ("ZD04", "ZD05", "ZOD1", "ZOD2", "ZOD4", "ZOD5", "ZOD6", "ZRPB", "ZRPC")},
}


@query(f"""WITH {CONDITIONS} SELECT doc, line, {', '.join(f'{v} AS {k}' for k, v in MEASURE_SQL.items())},
{near("sum(CASE WHEN code IN ('ZBPB', 'ZTBM') THEN value::DOUBLE / quantity::DOUBLE ELSE 0 END)")} AS zbpb_pu
FROM conditions GROUP BY 1, 2""")
def pricing_condition_measures(t: Tables) -> DataFrame:
    typed = conditions(t.lines)
    return rounded(s.condition_measures(typed, ["doc", "line"], s.INVOICE_MEASURES), ["zbpb_pu"])


PLANTS = """plants AS (SELECT s_suppkey AS plant, s_nationkey % 2 AS is_plant, s_suppkey % 10 AS report_plant FROM supplier)"""


def plants(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("plant"), (F.col("s_nationkey") % 2).alias("is_plant"),
                             (F.col("s_suppkey") % 10).alias("report_plant"))


ROLES = {"1": "payer", "2": "ship_to", "3": "agent", "4": "agent_part", "5": "transporter", "6": "employee", "7": "sold_to"}
FACT_MEASURES = [s.Measure("header_freight", ("ZF00",)), s.Measure("part_freight", ("ZF01", "ZF02")),
                 s.Measure("rebate", ("ZD01",), negate=True), *s.INVOICE_MEASURES]


# Lines moved by plant write some 27 bytes each; a plant takes 32 in a broadcast, so more than 300,000 plants fit.
FACT_BROADCAST = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "16m"}


def invoice_lines(t: Tables) -> DataFrame:
    # Both tables lie by document, moved once each.
    lines = laid_by(t.lines.drop("l_linestatus"), "l_orderkey")
    orders = laid_by(t.sales_orders.drop("o_orderpriority", "total"), "o_orderkey")
    by_line = items_of(lines)
    items = by_line.select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("line"), F.col("partkey").alias("material"),
        F.col("suppkey").alias("plant"), F.col("quantity").cast("decimal(18,2)").alias("quantity"),
        F.col("price").cast("decimal(18,2)").alias("net"), (F.col("price") * F.lit("0.18").cast("decimal(3,2)")).cast("decimal(18,2)").alias("tax"))
    headers = orders.select(
        F.col("o_orderkey").alias("doc"), F.col("order_date").alias("date"), F.col("o_custkey").alias("sold_to"),
        F.when(F.col("o_orderkey") % 4 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("payer"),
        F.when(F.col("o_custkey") % 2 == 0, "2000").otherwise("1000").alias("org"),
        F.when(F.col("o_orderstatus") == "P", "X").alias("cancelled"))
    partners = lines.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").cast("string").alias("role"),
                            F.col("l_suppkey").alias("party"))
    # Every ninth invoice is not posted, the rest are posted twice; returns have no excise document.
    doc = F.col("o_orderkey")
    accounting = orders.where("o_orderkey % 9 <> 0").select(
        doc.alias("doc"), F.when(doc % 2 == 0, "1000").otherwise("2000").alias("company"),
        F.explode(F.array(doc * 10, doc * 10 + 1)).alias("document"), F.year("order_date").alias("year"))
    ledger = t.sales_orders.where("o_orderkey % 5 <> 0").select(
        F.when(doc % 2 == 0, "1000").otherwise("2000").alias("company"), (doc * 10).alias("document"),
        F.year("order_date").alias("year"), F.explode(F.array(F.lit(1), F.lit(2))).alias("item"), (F.col("o_custkey") % 7).alias("place"))
    excise = lines.where("l_returnflag <> 'R'").select(
        F.col("l_orderkey").alias("ref_doc"), F.col("l_linenumber").alias("ref_line"), F.col("l_partkey").alias("number"),
        F.col("ship_date").alias("date"))
    order_lines = by_line.join(orders, F.col("l_orderkey") == doc).where("l_linenumber < 6").select(
        F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("order_line"),
        F.concat(F.lit("R"), F.col("suppkey").cast("string")).alias("route"), "order_date")
    return s.invoice_fact(items, headers, partners, ROLES, conditions(lines), FACT_MEASURES, weight_versions(t), plants(t),
                          weight_keys=("material",), documents=(accounting, ledger, excise, order_lines))


@query(f"""WITH {ITEMS}, {SALES_ORDERS}, {RATES}, {PLANTS}, {CONDITIONS.replace(LINES + ', ', '')},
sums AS (SELECT doc, line, sum(value) FILTER (code = 'ZF00') AS h, sum(value) FILTER (code IN ('ZF01', 'ZF02')) AS p,
  sum(-value) FILTER (code = 'ZD01') AS r, {', '.join(f'{v} AS {k}' for k, v in MEASURE_SQL.items())},
  sum(CASE WHEN code IN ('ZBPB', 'ZTBM') THEN value::DOUBLE / quantity::DOUBLE ELSE 0 END) AS zbpb_pu FROM conditions GROUP BY 1, 2),
parties AS (SELECT l_orderkey AS doc, {', '.join(f"max(l_suppkey) FILTER (l_linenumber = {n}) AS {p}_party" for n, p in ROLES.items())}
  FROM lines GROUP BY 1),
posted AS (SELECT o_orderkey AS doc, CASE WHEN o_orderkey % 2 = 0 THEN '1000' ELSE '2000' END AS company, o_orderkey * 10 AS document,
  year(order_date) AS year, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 7 END AS place FROM sales_orders WHERE o_orderkey % 9 <> 0),
excise AS (SELECT l_orderkey, l_linenumber, min((l_partkey, ship_date)) AS e FROM lines WHERE l_returnflag <> 'R' GROUP BY 1, 2),
heads AS (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey + 1 ELSE o_custkey END AS payer,
  CASE WHEN o_custkey % 2 = 0 THEN '2000' ELSE '1000' END AS org FROM sales_orders)
SELECT i.l_orderkey AS doc, i.l_linenumber AS line, i.partkey AS material, i.suppkey AS plant, o.order_date AS date,
  o.o_custkey AS sold_to, o.payer, o.org, i.quantity::DOUBLE AS quantity, i.price::DOUBLE AS net,
  (i.price * 0.18)::DECIMAL(18,2)::DOUBLE AS tax, (i.price + (i.price * 0.18)::DECIMAL(18,2))::DOUBLE AS total,
  {', '.join(f'y.{p}_party' for p in ROLES.values())}, {', '.join(f'coalesce(m.{k}, 0)::DOUBLE AS {k}' for k in MEASURE_SQL)},
  {near('coalesce(m.zbpb_pu, 0)')} AS zbpb_pu, a.document AS account_document, a.company, a.year, a.place AS business_place,
  e.e[1] AS excise_number, e.e[2] AS excise_date, CASE WHEN i.l_linenumber < 6 THEN 'R' || i.suppkey END AS route,
  CASE WHEN i.l_linenumber < 6 THEN o.order_date END AS order_date, {near("(i.quantity * w.weight)::DOUBLE / 1000")} AS weight_mt,
  coalesce(m.h, 0)::DOUBLE AS header_freight, coalesce(m.p, 0)::DOUBLE AS part_freight, coalesce(m.r, 0)::DOUBLE AS rebate,
  CASE WHEN o.o_orderstatus = 'P' THEN 'CANCELLED' ELSE 'BILLED' END AS status,
  CASE WHEN o.payer <> o.o_custkey THEN 'Sub Dealer' ELSE 'Direct' END AS customer_type,
  CASE WHEN o.org IN ('2000', '3000') AND i.suppkey <> p.report_plant THEN 'PLANT TO CUSTOMER'
       WHEN p.is_plant = 1 THEN 'PLANT TO CUSTOMER' WHEN p.is_plant = 0 THEN 'DEPOT TO CUSTOMER' END AS transport,
  CASE o.org WHEN '1000' THEN coalesce(m.h, 0) - 0 ELSE coalesce(m.p, 0) END::DOUBLE AS total_freight
FROM items i JOIN heads o ON o.o_orderkey = i.l_orderkey LEFT JOIN plants p ON p.plant = i.suppkey
LEFT JOIN rates w ON w.material = i.partkey AND o.order_date BETWEEN w.valid_from AND w.valid_to
LEFT JOIN parties y ON y.doc = i.l_orderkey LEFT JOIN sums m ON m.doc = i.l_orderkey AND m.line = i.l_linenumber
LEFT JOIN posted a ON a.doc = i.l_orderkey LEFT JOIN excise e ON e.l_orderkey = i.l_orderkey AND e.l_linenumber = i.l_linenumber""", SHARED_KEYS_CONF | FACT_BROADCAST)
def invoice_fact(t: Tables) -> DataFrame:
    out = invoice_lines(t)
    c = F.col
    out = out.withColumns({
        "transport": s.transport_type(c("is_plant"), c("org"), c("plant"), c("report_plant"), ("2000", "3000")),
        "total_freight": s.total_freight(c("org"), c("header_freight"), F.lit(0), [c("part_freight")], ("1000",),
                                         ("2000", "3000")),
    })
    return rounded(out, ["weight_mt", "zbpb_pu"]).drop("is_plant", "report_plant", "weight", "cancelled")


@query("""SELECT l.l_orderkey, l.l_linenumber, sum(CASE WHEN p.p_type IN ('ECONOMY', 'SMALL') THEN l.l_extendedprice::DECIMAL(18,2)
WHEN p.p_type = 'PROMO' THEN (l.l_extendedprice::DECIMAL(18,2) * (1 - l.l_discount::DECIMAL(18,2)))
WHEN p.p_type IN ('LARGE', 'MEDIUM') THEN l.l_quantity::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS sales_value
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2""")
def sales_value_by_product(t: Tables) -> DataFrame:
    lines = lookup(t.lines, t.part, [("l_partkey", "p_partkey")], ["p_type"], how="inner")
    rules = [(("ECONOMY", "SMALL"), F.col("price")), (("PROMO",), F.col("price") * (1 - F.col("discount"))),
             (("LARGE", "MEDIUM"), F.col("quantity"))]
    value = s.sales_value(F.col("p_type"), rules)
    return lines.withColumn("v", value).groupBy("l_orderkey", "l_linenumber").agg(F.sum("v").alias("sales_value"))


TYPE_INPUT = """base AS (SELECT o.o_orderkey, o.o_custkey AS sold_to,
  CASE WHEN o.o_orderkey % 3 = 0 THEN o.o_custkey + 1 ELSE o.o_custkey END AS payer,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Y1' WHEN 'BUILDING' THEN 'Y2' WHEN 'FURNITURE' THEN 'Y6' WHEN 'HOUSEHOLD' THEN '26'
    ELSE 'Y7' END AS grp,
  CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN '10' WHEN '2' THEN '20' WHEN '3' THEN '50' WHEN '4' THEN '60' ELSE '90' END AS channel,
  CASE o.o_orderstatus WHEN 'F' THEN 'PIPES & FITTINGS' WHEN 'O' THEN 'AC SHEETS' ELSE 'WALL PUTTY' END AS line
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)"""


@query(f"""WITH {TYPE_INPUT} SELECT o_orderkey, CASE
WHEN grp IN ('Y1', 'Y2') AND channel = '10' AND line = 'PIPES & FITTINGS' THEN 'PROJECT'
WHEN (channel = '50' AND grp = 'Y1') OR (channel = '60' AND grp = 'Y2') THEN 'RETAIL'
WHEN channel = '90' AND grp = 'Y6' AND line = 'PIPES & FITTINGS' THEN 'EXPORTS'
WHEN channel = '10' AND grp = 'Y7' AND line = 'PIPES & FITTINGS' THEN 'P&F_OTHERS'
WHEN channel = '50' AND grp = '26' AND line = 'WALL PUTTY' THEN 'RETAIL'
WHEN channel = '10' AND line = 'AC SHEETS' THEN 'DIRECT/PROJECT'
WHEN channel = '20' AND line = 'AC SHEETS' AND sold_to <> payer THEN 'RETAILER'
WHEN channel = '20' AND line = 'AC SHEETS' THEN 'STOCKIST' ELSE 'OTHER' END AS sales_type FROM base""")
def sales_type_classes(t: Tables) -> DataFrame:
    o = lookup(t.orders, t.customer, [("o_custkey", "c_custkey")], ["c_mktsegment"], how="inner")
    of = lambda column, pairs, default: first_match([(column == a, b) for a, b in pairs], default)
    group = of(F.col("c_mktsegment"), [("AUTOMOBILE", "Y1"), ("BUILDING", "Y2"), ("FURNITURE", "Y6"), ("HOUSEHOLD", "26")], "Y7")
    channel = of(F.substring("o_orderpriority", 1, 1), [("1", "10"), ("2", "20"), ("3", "50"), ("4", "60")], "90")
    line = of(F.col("o_orderstatus"), [("F", "PIPES & FITTINGS"), ("O", "AC SHEETS")], "WALL PUTTY")
    payer = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    return o.select("o_orderkey", s.sales_type(group, channel, line, F.col("o_custkey"), payer).alias("sales_type"))


FIRST_INPUT = f"""{ITEMS}, {SALES_ORDERS}, sold AS (SELECT o.o_custkey AS customer, p.p_brand AS line, o.order_date AS date,
  i.l_orderkey AS doc, i.l_linenumber AS item FROM items i JOIN sales_orders o ON o.o_orderkey = i.l_orderkey
  JOIN part p ON p.p_partkey = i.partkey),
batch AS (SELECT * FROM sold WHERE date >= DATE '1996-01-01'), history AS (SELECT * FROM sold WHERE date < DATE '1996-01-01')"""
_FIRST = lambda keys: f"rank() OVER (PARTITION BY {keys} ORDER BY date, doc, item) = 1"


def sold_lines(t: Tables) -> DataFrame:
    out = t.items.join(t.sales_orders, F.col("l_orderkey") == F.col("o_orderkey"))
    out = lookup(out, t.part, [("partkey", "p_partkey")], [("p_brand", "line")], how="inner")
    return out.select(F.col("o_custkey").alias("customer"), "line", F.col("order_date").alias("date"),
                      F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("item"))


@query(f"""WITH {FIRST_INPUT} SELECT doc, item,
CASE WHEN {_FIRST('customer')} AND customer NOT IN (SELECT customer FROM history) THEN 1 ELSE 0 END AS first_customer,
CASE WHEN {_FIRST('line')} AND line NOT IN (SELECT line FROM history) THEN 1 ELSE 0 END AS first_line,
CASE WHEN {_FIRST('customer, line')} AND (customer, line) NOT IN (SELECT (customer, line) FROM history) THEN 1 ELSE 0 END AS first_pair
FROM batch""")
def first_sale_flags(t: Tables) -> DataFrame:
    sold = sold_lines(t)
    flags = {"first_customer": ["customer"], "first_line": ["line"], "first_pair": ["customer", "line"]}
    out = s.first_sale_flags(sold.where("date >= DATE '1996-01-01'"), flags, ["date", "doc", "item"],
                             sold.where("date < DATE '1996-01-01'"))
    return out.select("doc", "item", *flags)


@query(f"""WITH {FIRST_INPUT} SELECT doc, item, CASE WHEN rank() OVER (PARTITION BY customer ORDER BY date) = 1 THEN 1 ELSE 0 END AS new_customer,
CASE WHEN rank() OVER (PARTITION BY customer, line ORDER BY date) = 1 THEN 1 ELSE 0 END AS new_pair FROM sold""")
def first_day_flags(t: Tables) -> DataFrame:
    flags = {"new_customer": ["customer"], "new_pair": ["customer", "line"]}
    return s.first_day_flags(sold_lines(t), flags, "date").select("doc", "item", *flags)


@query(f"""WITH {ITEMS}, {SALES_ORDERS}, o AS (SELECT i.l_orderkey AS doc, i.l_linenumber AS item, s.order_date AS date, i.quantity,
  i.price AS value, CASE s.o_orderstatus WHEN 'F' THEN 'C' WHEN 'O' THEN 'A' END AS credit_status
  FROM items i JOIN sales_orders s ON s.o_orderkey = i.l_orderkey WHERE s.order_date BETWEEN DATE '2001-05-01' AND DATE '2001-08-01'),
d AS (SELECT l_orderkey AS doc, l_linenumber AS item, sum(quantity) AS delivered FROM lines WHERE l_returnflag <> 'R' GROUP BY 1, 2),
b AS (SELECT o.*, coalesce(d.delivered, 0) AS delivered, o.quantity - coalesce(d.delivered, 0) AS bq FROM o LEFT JOIN d USING (doc, item)),
v AS (SELECT *, {near("(value * bq)::DOUBLE / quantity::DOUBLE", 2)} AS bv FROM b WHERE bq <> 0)
SELECT doc, item, bq::DOUBLE AS balance_quantity, bv AS balance_value,
CASE WHEN credit_status = 'C' THEN 'pending' ELSE 'released' END AS status,
CASE WHEN credit_status = 'C' THEN bq ELSE 0 END::DOUBLE AS pending_quantity,
CASE WHEN credit_status = 'C' THEN 0 ELSE bq END::DOUBLE AS released_quantity FROM v""")
def open_sales_orders(t: Tables) -> DataFrame:
    lines = t.items.join(t.sales_orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("item"), F.col("order_date").alias("date"),
        F.col("quantity").cast("decimal(18,2)").alias("quantity"), F.col("price").cast("decimal(18,2)").alias("value"),
        first_match([(F.col("o_orderstatus") == "F", "C"), (F.col("o_orderstatus") == "O", "A")]).alias("credit_status"))
    shipped = t.lines.where("l_returnflag <> 'R'").select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("item"), F.col("quantity").alias("delivered"))
    out = s.open_orders(lines, shipped, "2001-05-01", "2001-08-01", ["doc", "item"])
    return rounded(out, ["balance_value"], 2).select("doc", "item", "balance_quantity", "balance_value", "status",
                                                     "pending_quantity", "released_quantity")


@query(f"""WITH {LINES}, {SALES_ORDERS} SELECT l.l_suppkey AS plant, p.p_brand AS brand, o.order_date AS date,
{near("sum(l.quantity * p.p_size)::DOUBLE / 10.0")} AS order_quantity FROM lines l JOIN sales_orders o ON o.o_orderkey = l.l_orderkey
JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2, 3""")
def order_intake(t: Tables) -> DataFrame:
    lines = t.lines.join(t.sales_orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").alias("plant"), F.col("l_partkey").alias("material"), F.col("order_date").alias("date"),
        "quantity")
    lines = lookup(lines, t.part, [("material", "p_partkey")], [("p_brand", "brand")], how="inner")
    factors = t.part.select(F.col("p_partkey").alias("material"), F.col("p_size").alias("numerator"),
                            F.lit(10).alias("denominator"))
    return rounded(s.order_intake(lines, factors, ["plant", "brand", "date"]), ["order_quantity"])


@query(f"""WITH {ITEMS}, {SALES_ORDERS} SELECT i.l_orderkey, i.l_linenumber, o.o_custkey AS customer_id, c.c_mktsegment,
i.partkey AS product_id, p.p_brand, strftime(o.order_date, '%Y%m%d')::INTEGER AS date_key,
(i.quantity * p.p_retailprice::DECIMAL(18,2))::DECIMAL(18,2)::DOUBLE AS sales_amount
FROM items i JOIN sales_orders o ON o.o_orderkey = i.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
JOIN part p ON p.p_partkey = i.partkey""")
def star_schema_fact(t: Tables) -> DataFrame:
    sales = t.items.join(t.sales_orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", F.col("o_custkey").alias("customer_id"), F.col("partkey").alias("product_id"),
        "order_date", F.col("quantity").cast("decimal(18,2)").alias("quantity"))
    customers = pick_row(t.customer.select(F.col("c_custkey").alias("customer_id"), "c_mktsegment"), ["customer_id"], [])
    products = pick_row(t.part.select(F.col("p_partkey").alias("product_id"), "p_brand",
                                      F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price")), ["product_id"], [])
    return s.star_fact(sales, customers, products).drop("order_date", "quantity", "unit_price")


@query("""SELECT DISTINCT strftime(o_orderdate, '%Y%m%d')::INTEGER AS date_key, o_orderdate::DATE AS date, year(o_orderdate) AS year,
month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders""")
def date_dimension_from_fact(t: Tables) -> DataFrame:
    return date_dimension(t.orders, "o_orderdate")
