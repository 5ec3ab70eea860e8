"""Targets, budget sheets, variances and the calendar on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import UNIT_KEEP, clean_label
from ..functions.dates import FISCAL_MONTHS, fiscal_year
from ..operators import reshape
from ..operators.calendar import calendar, days_of, repeat_daily
from ..operators.joins import lookup, period_key
from ..operators.keys import assign_keys
from ..plans import finance as f, targets as tg
from .core import ITEMS, LINES, SALES_ORDERS, Tables, near, query, rounded

FY = lambda d: f"(year({d}) - CASE WHEN month({d}) < 4 THEN 1 ELSE 0 END)"
FM = lambda d: f"((month({d}) + 8) % 12 + 1)"
DAYS = """bounds AS (SELECT make_date(year(min(d)) - CASE WHEN month(min(d)) < 4 THEN 1 ELSE 0 END, 4, 1) AS a,
  make_date(year(max(d)) - CASE WHEN month(max(d)) < 4 THEN 1 ELSE 0 END + 1, 4, 1) - 1 AS b FROM (SELECT o_orderdate::DATE AS d FROM orders)),
days AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS d FROM bounds)"""


@query(f"""WITH {DAYS} SELECT d AS date_dt, strftime(d, '%Y%m%d')::INTEGER AS date_id, dayofyear(d) AS day_of_yr_num,
(year(d) * 1000 + dayofyear(d)) AS day_id, strftime(d, '%A') AS day_name, day(d) AS day_of_month_num, strftime(d, '%U')::INTEGER AS week_of_yr_num,
(year(d) || strftime(d, '%U'))::INTEGER AS week_id, month(d) AS month_of_yr_num, strftime(d, '%B') AS month_of_yr_name,
year(d) * 100 + month(d) AS month_id, quarter(d) AS qtr_id, year(d) * 10 + quarter(d) AS qtr_of_yr_num, year(d) AS yr_name,
{FY('d')} AS fy_name, {FM('d')} AS fy_month_of_yr_num, w AS fy_week_of_yr_num, ({FY('d')} || lpad(w::VARCHAR, 2, '0'))::INTEGER AS fy_week_id,
{FY('d')} * 100 + {FM('d')} AS fy_month_id, q AS fy_qtr_id, 'Q' || q AS fy_qtr_name, {FY('d')} * 10 + q AS fy_qtr_of_yr_num,
h AS fy_hy_name, h || ' ' || ({FY('d')} + 1) AS fy_hf_yr_of_yr, 'Q' || q || ' ' || ({FY('d')} + 1) AS fy_qtr_of_yr,
strftime(d, '%B %Y') AS fy_month_of_yr, day(d) || ' ' || strftime(d, '%B') AS fy_day_of_month, 'W' || k AS wk_name,
'W' || k || ' ' || strftime(d, '%B') AS fy_wk_of_month_name, sum(step) OVER (ORDER BY d)::INTEGER AS wk_sort
FROM (SELECT *, CASE WHEN lag(k) OVER (ORDER BY d) IS DISTINCT FROM k THEN 1 ELSE 0 END AS step FROM (
  SELECT d, least((day(d) + 6) // 7, 4) AS k, ({FM('d')} + 2) // 3 AS q, CASE WHEN {FM('d')} <= 6 THEN 'H1' ELSE 'H2' END AS h,
  CASE WHEN month(d) >= 4 THEN strftime(d, '%U')::INTEGER - (strftime(make_date({FY('d')}, 4, 1), '%U')::INTEGER - 1)
    ELSE strftime(d, '%U')::INTEGER + 40 END AS w FROM days))""")
def calendar_dimension(t: Tables) -> DataFrame:
    return calendar(days_of(t.orders, "o_orderdate", whole_fiscal_years=True))


GRAINS = ["DAILY", "WEEKLY", "MONTHLY", "QUARTERLY", "HALFYEARLY", "YEARLY"]
_PERIOD = f"""CASE grain WHEN 'DAILY' THEN strftime(d, '%Y%m%d') WHEN 'WEEKLY' THEN strftime(d, '%Y%m') || 'W' || least((day(d) + 6) // 7, 4)
  WHEN 'MONTHLY' THEN strftime(d, '%Y%m') WHEN 'QUARTERLY' THEN {FY('d')} || 'Q' || ({FM('d')} + 2) // 3
  WHEN 'HALFYEARLY' THEN {FY('d')} || 'H' || ({FM('d')} + 5) // 6 ELSE {FY('d')}::VARCHAR END"""


def target_rows(t: Tables) -> DataFrame:
    """Targets per segment and day on which large orders fall; the grain follows the order key."""
    o = lookup(t.sales_orders, t.customer, [("o_custkey", "c_custkey")],
               [("c_mktsegment", "segment")], how="inner")
    grain = F.element_at(F.array(*[F.lit(g) for g in GRAINS]), (F.col("o_orderkey") % 6).cast("int") + 1)
    return o.groupBy("segment", grain.alias("target_type"), F.col("order_date").alias("target_date")).agg(
        F.sum(F.floor("total")).cast("double").alias("sales"), F.count(F.lit(1)).cast("double").alias("quantity"))


@query(f"""WITH {SALES_ORDERS}, {DAYS}, grains AS (SELECT unnest({GRAINS}) AS grain), periods AS (SELECT d, grain, {_PERIOD} AS p FROM days, grains),
sizes AS (SELECT grain, p, count(*) AS n FROM periods GROUP BY 1, 2),
targets AS (SELECT c_mktsegment AS segment, list_extract({GRAINS}, (o_orderkey % 6)::INTEGER + 1) AS grain, order_date AS d, sum(floor(total))::DOUBLE AS sales,
  count(*)::DOUBLE AS quantity FROM sales_orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3),
dated AS (SELECT *, {_PERIOD} AS p FROM targets)
SELECT t.segment, t.grain AS target_type, d.d AS target_date, count(*) AS n, {near('sum(t.sales / s.n)', 3)} AS sales, {near('sum(t.quantity / s.n)', 3)} AS quantity
FROM dated t JOIN sizes s USING (grain, p) JOIN periods d USING (grain, p) GROUP BY 1, 2, 3""")
def targets_spread_to_days(t: Tables) -> DataFrame:
    days = calendar(days_of(t.orders, "o_orderdate", whole_fiscal_years=True))
    daily = tg.spread_to_days(target_rows(t), days, ["sales", "quantity"])
    out = daily.groupBy("segment", "target_type", "target_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sales").alias("sales"), F.sum("quantity").alias("quantity"))
    return rounded(out, ["sales", "quantity"], 3)


@query(f"""WITH {SALES_ORDERS}, v AS (SELECT o_custkey, order_date, o_orderkey % 3 AS file_date, sum(total) AS target FROM sales_orders GROUP BY 1, 2, 3)
SELECT o_custkey, order_date, file_date, target::DOUBLE AS target FROM v WHERE (o_custkey, order_date, file_date) IN (
SELECT (o_custkey, order_date, max(file_date)) FROM v GROUP BY o_custkey, order_date)""")
def newest_target_files(t: Tables) -> DataFrame:
    v = t.sales_orders.groupBy("o_custkey", "order_date", (F.col("o_orderkey") % 3).alias("file_date")).agg(F.sum("total").alias("target"))
    return tg.newest_targets(v, ["o_custkey", "order_date"])


TERR = """terr AS (SELECT c_mktsegment AS line, 'C' || c_custkey AS pincode, n_name AS state, r_name AS zone, 'WORLD' AS country
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


def territory(t: Tables) -> DataFrame:
    places = lookup(t.nation, t.region, [("n_regionkey", "r_regionkey")], ["r_name"], how="inner")
    out = lookup(t.customer, places, [("c_nationkey", "n_nationkey")], [("n_name", "state"), ("r_name", "zone")], how="inner")
    return out.select(F.col("c_mktsegment").alias("line"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("pincode"),
                      "state", "zone", F.lit("WORLD").alias("country"))


@query(f"""WITH {TERR}, {SALES_ORDERS}, base AS (SELECT o_orderkey, t.line, t.pincode, t.state, t.zone, t.country, total,
  list_extract(['PINCODE', 'STATE', 'Zone', 'COUNTRY'], (o_orderkey % 4)::INTEGER + 1) AS lvl FROM sales_orders JOIN terr t ON t.pincode = 'C' || o_custkey)
SELECT o_orderkey, line, total::DOUBLE AS total, CASE WHEN upper(lvl) = 'PINCODE' THEN pincode ELSE '<DEFAULT>' END AS pincode,
CASE WHEN upper(lvl) IN ('PINCODE', 'STATE') THEN state ELSE '<DEFAULT>' END AS state,
CASE WHEN upper(lvl) = 'COUNTRY' THEN '<DEFAULT>' ELSE zone END AS zone, country FROM base""")
def targets_lifted_to_levels(t: Tables) -> DataFrame:
    ter = territory(t)
    o = t.sales_orders.select("o_orderkey", "total", F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("pin"))
    o = lookup(o, ter, [("pin", "pincode")], ["line", "state", "zone", "country"], how="inner")
    level = F.element_at(F.array(*[F.lit(x) for x in ("PINCODE", "STATE", "Zone", "COUNTRY")]), (F.col("o_orderkey") % 4).cast("int") + 1)
    unit = F.element_at(F.array("pin", "state", "zone", "country"), (F.col("o_orderkey") % 4).cast("int") + 1)
    rows = o.select("o_orderkey", "line", "total", level.alias("geo_unit_type"), unit.alias("geo_unit"))
    out = tg.lift_to_levels(rows, ter, ["line"], ["PINCODE", "STATE", "ZONE", "COUNTRY"])
    return out.drop("geo_unit_type", "geo_unit")


@query(f"""WITH {TERR}, rates AS (SELECT c_mktsegment AS line, lower(r_name) AS zone, count(*) AS percent FROM customer JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey WHERE c_acctbal > 0 GROUP BY 1, 2),
spread AS (SELECT DISTINCT r.line, r.zone, r.percent, coalesce(t.state, '<DEFAULT>') AS state, coalesce(t.country, '<DEFAULT>') AS country FROM rates r
  LEFT JOIN (SELECT DISTINCT line, lower(zone) AS z, state, country FROM terr) t ON t.line = r.line AND t.z = r.zone),
numbered AS (SELECT line, zone, state, row_number() OVER (ORDER BY substr(md5(line || '|' || zone || '|' || state), 1, 3), line, zone, state) AS geo_key
  FROM (SELECT DISTINCT line, zone, state FROM spread))
SELECT line, zone, percent, state, country, '<DEFAULT>' AS pincode, geo_key FROM spread JOIN numbered USING (line, zone, state)""")
def rates_spread_over_geography(t: Tables) -> DataFrame:
    places = lookup(t.nation, t.region, [("n_regionkey", "r_regionkey")], ["r_name"], how="inner")
    rates = lookup(t.customer.where("c_acctbal > 0"), places, [("c_nationkey", "n_nationkey")], ["r_name"], how="inner").groupBy(
        F.col("c_mktsegment").alias("line"), F.lower("r_name").alias("zone")).agg(F.count(F.lit(1)).alias("percent"))
    spread = tg.spread_over_geography(rates, territory(t), ["line"], finer=("pincode",))
    known = spread.where("false").select("line", "zone", "state", F.lit(0).cast("long").alias("geo_key"))
    return assign_keys(known, spread, ["line", "zone", "state"], "geo_key")


SHEET = f"""{SALES_ORDERS}, m AS (SELECT o_custkey % 50 AS plant, {FY('order_date')} + 1 AS fy, date_trunc('month', order_date)::DATE AS month, sum(total) AS v
  FROM sales_orders GROUP BY 1, 2, 3)"""


def fiscal_sheet_input(t: Tables) -> DataFrame:
    """Monthly order sums per customer group as a sheet with the columns APRIL..MARCH."""
    o = t.sales_orders.select(
        (F.col("o_custkey") % 50).alias("plant"), (fiscal_year("order_date") + 1).alias("fy"),
        F.upper(F.date_format("order_date", "MMMM")).alias("m"), "total")
    return reshape.pivot_sums(o, ["plant", "fy"], "m", FISCAL_MONTHS, {"v": F.sum("total")}, fill=None)


@query(f"""WITH {SHEET} SELECT plant, fy, month, month(month) AS month_no, v::DOUBLE AS value FROM m""")
def fiscal_sheet_rows(t: Tables) -> DataFrame:
    """Pivot followed by unpivot gives the monthly rows back; the empty cells go."""
    return reshape.fiscal_sheet(fiscal_sheet_input(t), ["plant"], "fy").where("value IS NOT NULL")


@query(f"""WITH {LINES}, b AS (SELECT l_suppkey AS plant, {FY('ship_date')} + 1 AS fy, quarter(ship_date) AS q, sum(quantity) AS v FROM lines GROUP BY 1, 2, 3)
SELECT plant, fy, 'Q' || ((q + 2) % 4 + 1) AS quarter, make_date(fy - CASE WHEN q = 1 THEN 0 ELSE 1 END, q * 3 - 2, 1) AS month, v::DOUBLE AS budget FROM b""")
def quarter_budget_dates(t: Tables) -> DataFrame:
    return reshape.quarter_budgets(quarter_sheet(t), ["plant"], "fy").where("budget IS NOT NULL")


def quarter_sheet(t: Tables, key: str = "l_suppkey") -> DataFrame:
    label = F.concat(F.lit("Q"), (F.pmod(F.quarter("ship_date") + 2, F.lit(4)) + 1).cast("string"))
    b = t.lines.select(F.col(key).alias("plant"), (fiscal_year("ship_date") + 1).alias("fy"), label.alias("q"), "quantity")
    return reshape.pivot_sums(b, ["plant", "fy"], "q", ["Q1", "Q2", "Q3", "Q4"], {"v": F.sum("quantity")}, fill=None)


@query(f"""WITH {SALES_ORDERS}, m AS (SELECT o_orderpriority AS line, date_trunc('month', order_date)::DATE AS month, sum(total) AS revenue FROM sales_orders GROUP BY 1, 2)
SELECT line, month, revenue::DOUBLE AS revenue, sum(revenue) OVER (PARTITION BY line ORDER BY month)::DOUBLE AS revenue_ytd FROM m""")
def revenue_to_date(t: Tables) -> DataFrame:
    monthly = t.sales_orders.groupBy(F.col("o_orderpriority").alias("line"), period_key("order_date").alias("month")).agg(
        F.sum("total").alias("revenue"))
    return f.revenue_to_date(monthly, ["line"], "month", "revenue")


@query(f"""WITH {LINES}, d AS (SELECT l_suppkey AS plant, l_returnflag AS gl, ship_date AS date, sum(price) FILTER (l_linestatus = 'O') AS p,
  sum(price) FILTER (l_linestatus = 'F') AS q FROM lines GROUP BY 1, 2, 3)
SELECT plant, gl, date, p::DOUBLE AS plant_value, q::DOUBLE AS depot_value FROM d""")
def cost_tracker(t: Tables) -> DataFrame:
    kind = F.when(F.col("l_linestatus") == "O", "PLANT").otherwise("DEPOT")
    cells = t.lines.select(F.col("l_suppkey").alias("plant"), F.col("l_returnflag").alias("gl"), period_key("ship_date").alias("month"),
                           F.concat_ws("_", kind, F.dayofmonth("ship_date").cast("string")).alias("cell"), "price")
    names = [[f"{k}_{d}" for d in range(1, 32)] for k in ("PLANT", "DEPOT")]
    sheet = reshape.pivot_sums(cells, ["plant", "gl", "month"], "cell", names[0] + names[1], {"v": F.sum("price")}, fill=None)
    out = f.cost_tracker(sheet, ["plant", "gl"], names[0], names[1], "month")
    return out.where("plant_value IS NOT NULL OR depot_value IS NOT NULL")


VAR = f"""{ITEMS}, produced AS (SELECT l_orderkey AS "order", min(suppkey) AS plant, min(ship_date) AS date, sum(quantity) AS fg_kg FROM items WHERE l_linenumber <= 2 GROUP BY 1),
consumed AS (SELECT l_orderkey AS "order", partkey AS material, sum(quantity) AS rm_kg, sum(price) AS rm_amount FROM items WHERE l_linenumber > 2 GROUP BY 1, 2),
standard AS (SELECT DISTINCT "order", material, (p_size / 10)::DECIMAL(9,3) AS std FROM consumed JOIN part ON p_partkey = material WHERE p_size % 3 <> 0),
prices AS (SELECT DISTINCT c.material, p.plant, date_trunc('month', p.date)::DATE AS month, p_retailprice::DECIMAL(18,2) AS price FROM consumed c JOIN produced p USING ("order")
  JOIN part ON p_partkey = c.material WHERE p_size % 5 <> 0)"""


@query(f"""WITH {VAR} SELECT p."order", p.plant, p.date, c.material, fg_kg::DOUBLE AS fg_kg, rm_kg::DOUBLE AS rm_kg, coalesce(r.price, 0)::DOUBLE AS target_price,
{near("rm_amount::DOUBLE / rm_kg::DOUBLE")} AS rate_per_kg, {near("std * fg_kg")} AS std_required_kg,
{near("CASE WHEN std IS NULL THEN rm_kg::DOUBLE * coalesce(r.price, 0)::DOUBLE ELSE (std * fg_kg - rm_kg)::DOUBLE * coalesce(r.price, 0)::DOUBLE END", 2)} AS quantity_variance,
{near("rm_kg::DOUBLE * (coalesce(r.price, 0)::DOUBLE - rm_amount::DOUBLE / rm_kg::DOUBLE)", 2)} AS rate_variance
FROM produced p JOIN consumed c USING ("order") LEFT JOIN standard s ON s."order" = p."order" AND s.material = c.material
LEFT JOIN prices r ON r.material = c.material AND r.plant = p.plant AND r.month = date_trunc('month', p.date)""")
def material_variance(t: Tables) -> DataFrame:
    dec = lambda c: F.sum(c).cast("decimal(18,2)")
    produced = t.items.where("l_linenumber <= 2").groupBy(F.col("l_orderkey").alias("order")).agg(
        F.min("suppkey").alias("plant"), F.min("ship_date").alias("date"), dec("quantity").alias("fg_kg"))
    consumed = t.items.where("l_linenumber > 2").groupBy(F.col("l_orderkey").alias("order"), F.col("partkey").alias("material")).agg(
        dec("quantity").alias("rm_kg"), dec("price").alias("rm_amount"))
    parts = t.part.select(F.col("p_partkey").alias("material"), "p_size", F.col("p_retailprice").cast("decimal(18,2)").alias("target_price"))
    with_part = consumed.select("order", "material").join(parts, "material", "inner")
    standard = with_part.where("p_size % 3 <> 0").select(
        "order", "material", (F.col("p_size") * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(9,3)").alias("std_per_kg"))
    prices = with_part.where("p_size % 5 <> 0").join(produced, "order", "inner").select(
        "material", "plant", period_key("date").alias("month"), "target_price").distinct()
    out = f.material_variance(produced, consumed, standard, prices).drop("month", "std_per_kg", "rm_amount")
    return rounded(rounded(out, ["rate_per_kg", "std_required_kg"]), ["quantity_variance", "rate_variance"], 2)


@query("""WITH l AS (SELECT o_custkey % 200 AS plant, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Labour  Cost (INR/MT)' WHEN '2' THEN 'Power & Fuel %'
  ELSE 'sales, MT' END AS label, o_totalprice FROM orders)
SELECT plant, max(CASE WHEN label LIKE 'Labour%' THEN o_totalprice END) AS "LABOUR_COST_INRMT_KG", max(CASE WHEN label LIKE 'Power%' THEN o_totalprice END) AS "POWER_FUEL_PERCEN_KG",
max(CASE WHEN label LIKE 'sales%' THEN o_totalprice END) AS "SALES_MT_KG" FROM l GROUP BY 1""")
def kpi_labels_to_columns(t: Tables) -> DataFrame:
    p = F.substring("o_orderpriority", 1, 1)
    label = F.when(p == "1", "Labour  Cost (INR/MT)").when(p == "2", "Power & Fuel %").otherwise("sales, MT")
    name = F.concat_ws("_", clean_label(label), clean_label(F.lit("k(g)"), UNIT_KEEP))
    df = t.orders.select((F.col("o_custkey") % 200).alias("plant"), name.alias("label"), "o_totalprice")
    return reshape.pivot_sums(df, ["plant"], "label", ["LABOUR_COST_INRMT_KG", "POWER_FUEL_PERCEN_KG", "SALES_MT_KG"],
                              {"v": F.max("o_totalprice")}, fill=None)


@query(f"""WITH {LINES}, r AS (SELECT l_suppkey AS plant, l_partkey AS material, 'RATE' AS label, max(price) AS v FROM lines GROUP BY 1, 2
  UNION ALL SELECT l_suppkey, l_partkey, 'QUANTITY', sum(quantity) FROM lines WHERE l_returnflag <> 'N' GROUP BY 1, 2)
SELECT plant, material, coalesce(sum(v) FILTER (label = 'RATE'), 0)::DOUBLE AS "RATE", coalesce(sum(v) FILTER (label = 'QUANTITY'), 0)::DOUBLE AS "QUANTITY" FROM r GROUP BY 1, 2""")
def budget_label_pivot(t: Tables) -> DataFrame:
    keys = [F.col("l_suppkey").alias("plant"), F.col("l_partkey").alias("material")]
    rate = t.lines.groupBy(*keys).agg(F.max("price").cast("decimal(28,2)").alias("v")).withColumn("label", F.lit("RATE"))
    qty = t.lines.where("l_returnflag <> 'N'").groupBy(*keys).agg(F.sum("quantity").cast("decimal(28,2)").alias("v")).withColumn("label", F.lit("QUANTITY"))
    return f.budget_labels(rate.unionByName(qty), ["plant", "material"], "label", ["RATE", "QUANTITY"], "v")


@query(f"""WITH {LINES}, {SALES_ORDERS} SELECT l_orderkey AS document, l_linenumber AS line, l_returnflag AS account, order_date AS post_date,
order_date + (CASE WHEN l_linenumber > 4 THEN l_linenumber * 10 WHEN l_linenumber > 2 THEN l_linenumber ELSE 0 END) AS due_date, count(*) AS n,
sum(CASE WHEN l_linestatus = 'O' THEN -price ELSE price END)::DOUBLE AS amount FROM lines JOIN sales_orders ON o_orderkey = l_orderkey
WHERE l_returnflag IN ('A', 'R') AND l_suppkey % 4 IN (1, 2) GROUP BY ALL""")
def ledger_lines(t: Tables) -> DataFrame:
    c = F.col
    company = (c("l_suppkey") % 4).alias("company")
    lines = t.lines.select(
        company, c("l_orderkey").alias("document"), F.lit(1).alias("year"), c("l_linenumber").alias("line"), c("l_returnflag").alias("account"),
        F.when(c("l_linestatus") == "O", "H").otherwise("S").alias("dc"), c("price").alias("amount"),
        F.lit(None).cast("date").alias("base_date"), F.lit(0).alias("days1"),
        F.when(c("l_linenumber") > 2, c("l_linenumber")).alias("days2"), F.when(c("l_linenumber") > 4, c("l_linenumber") * 10).alias("days3"))
    documents = t.sales_orders.select(c("o_orderkey").alias("document"), F.lit(1).alias("year"), c("order_date").alias("doc_date"),
                                      c("order_date").alias("post_date"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("company"))
    documents = documents.withColumn("company", c("company").cast("long"))
    accounts = t.lineitem.select(company, c("l_returnflag").alias("account")).distinct()
    companies = t.supplier.select((c("s_suppkey") % 4).alias("company")).distinct().where("company IN (1, 2)")
    codes = t.lineitem.where("l_returnflag <> 'N'").select(c("l_returnflag").alias("account")).distinct()
    out = f.ledger_lines(lines, documents, accounts, companies, codes)
    return out.groupBy("document", "line", "account", "post_date", "due_date").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


@query("""SELECT 'customers' AS sheet, c_custkey AS id, c_acctbal AS value FROM customer
UNION ALL SELECT 'suppliers', s_suppkey, s_acctbal FROM supplier UNION ALL SELECT 'parts', p_partkey, p_retailprice FROM part""")
def tagged_sheets(t: Tables) -> DataFrame:
    pick = lambda df, k, v: df.select(F.col(k).alias("id"), F.col(v).alias("value"))
    return f.stack_sheets({"customers": pick(t.customer, "c_custkey", "c_acctbal"), "suppliers": pick(t.supplier, "s_suppkey", "s_acctbal"),
                           "parts": pick(t.part, "p_partkey", "p_retailprice")}, "sheet")


@query(f"""WITH {LINES}, sheets AS (SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'EA' WHEN l_suppkey % 3 = 1 THEN 'MT' ELSE 'M3' END AS unit, l_suppkey AS plant,
  {FY('ship_date')} + 1 AS fy, date_trunc('month', ship_date)::DATE AS month, sum(price) AS v FROM lines GROUP BY 1, 2, 3, 4)
SELECT unit, plant, fy, month, month(month) AS month_no, v::DOUBLE AS value FROM sheets""")
def unit_sheets_by_month(t: Tables) -> DataFrame:
    """Three unit sheets to monthly rows, then stacked."""
    sheets = {}
    for rest, unit in enumerate(("EA", "MT", "M3")):
        rows = t.lines.where(F.col("l_suppkey") % 3 == rest).select(
            F.col("l_suppkey").alias("plant"), (fiscal_year("ship_date") + 1).alias("fy"),
            F.upper(F.date_format("ship_date", "MMMM")).alias("m"), "price")
        wide = reshape.pivot_sums(rows, ["plant", "fy"], "m", FISCAL_MONTHS, {"v": F.sum("price")}, fill=None)
        sheets[unit] = reshape.fiscal_sheet(wide, ["plant"], "fy").where("value IS NOT NULL")
    return f.stack_sheets(sheets, "unit")


@query(f"""WITH {SALES_ORDERS}, m AS (SELECT o_orderpriority AS line, date_trunc('month', order_date)::DATE AS month, sum(total) AS total FROM sales_orders GROUP BY 1, 2),
{DAYS} SELECT line, month, d AS date_dt, total::DOUBLE AS total FROM m LEFT JOIN days ON date_trunc('month', d) = month""")
def monthly_rows_to_days(t: Tables) -> DataFrame:
    monthly = t.sales_orders.groupBy(F.col("o_orderpriority").alias("line"), period_key("order_date").alias("month")).agg(F.sum("total").alias("total"))
    return repeat_daily(monthly, "month", days_of(t.orders, "o_orderdate", whole_fiscal_years=True))


@query(f"""WITH {LINES}, share AS (SELECT l_partkey, l_suppkey, sum(quantity) AS q FROM lines WHERE l_linestatus = 'F' GROUP BY 1, 2),
grp AS (SELECT l_partkey, sum(q) AS total FROM share GROUP BY 1), booked AS (SELECT l_partkey, sum(price) AS amount FROM lines WHERE l_linestatus = 'O' GROUP BY 1)
SELECT b.l_partkey, s.l_suppkey, s.q::DOUBLE AS q, s.q::DOUBLE / g.total::DOUBLE AS share, {near('b.amount::DOUBLE * (s.q::DOUBLE / g.total::DOUBLE)')} AS amount
FROM booked b JOIN share s USING (l_partkey) JOIN grp g USING (l_partkey)""")
def proportional_allocation(t: Tables) -> DataFrame:
    members = t.lines.where("l_linestatus = 'F'").groupBy("l_partkey", "l_suppkey").agg(F.sum("quantity").alias("q"))
    booked = t.lines.where("l_linestatus = 'O'").groupBy("l_partkey").agg(F.sum("price").alias("amount"))
    return rounded(f.allocate_by_share(booked, members, ["l_partkey"], "q", ["amount"]), ["amount"])


@query(f"""WITH {ITEMS} SELECT l_orderkey, l_linenumber, {near('o_totalprice / n', 3)} AS total_split FROM (
SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS n FROM items) i JOIN orders ON o_orderkey = l_orderkey""")
def equal_split(t: Tables) -> DataFrame:
    """Order totals over the order's lines; the split keeps more digits than are compared."""
    rows = t.items.select("l_orderkey", "l_linenumber").join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("total")), "l_orderkey", "inner")
    return rounded(f.equal_split(rows, ["l_orderkey"], {"total": 12}), ["total_split"], 3).select("l_orderkey", "l_linenumber", "total_split")


@query(f"""WITH {LINES}, s AS (SELECT l_suppkey AS plant, date_trunc('month', ship_date)::DATE AS date, l_linestatus, sum(quantity) AS q, sum(price) AS p FROM lines GROUP BY 1, 2, 3),
w AS (SELECT plant, date, max(q) FILTER (l_linestatus = 'F') AS qa, max(q) FILTER (l_linestatus = 'O') AS qb, max(p) FILTER (l_linestatus = 'F') AS pa,
  max(p) FILTER (l_linestatus = 'O') AS pb FROM s GROUP BY 1, 2 HAVING count(*) = 2)
SELECT plant, date, x.particulars, x.actual::DOUBLE AS actual, x.budget::DOUBLE AS budget, x.sort FROM w, LATERAL (VALUES ('STOCK QTY', qa, qb, 2), ('STOCK VALUE', pa, pb, 1),
('TOTAL ASSETS', qa + pa, qb + pb, 3)) x(particulars, actual, budget, sort)""")
def actual_vs_budget(t: Tables) -> DataFrame:
    sheet = t.lines.groupBy(F.col("l_suppkey").alias("plant"), period_key("ship_date").alias("date"),
                            F.when(F.col("l_linestatus") == "F", "ACTUAL").otherwise("BUDGET").alias("actual_or_budget")).agg(
        F.sum("quantity").alias("STOCK_QTY"), F.sum("price").alias("STOCK_VALUE"))
    return f.actual_vs_budget(sheet, ["plant", "date"], {"TOTAL_ASSETS": F.col("STOCK_QTY") + F.col("STOCK_VALUE")},
                              ["STOCK_QTY", "STOCK_VALUE", "TOTAL_ASSETS"], {"STOCK VALUE": 1, "STOCK QTY": 2, "TOTAL ASSETS": 3})


@query(f"""WITH {LINES}, {SALES_ORDERS} SELECT date_trunc('month', CASE WHEN l_returnflag = 'N' THEN ship_date ELSE order_date END)::DATE AS month, l_suppkey,
sum(quantity)::DOUBLE AS quantity FROM lines JOIN sales_orders ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def adjusted_posting_date(t: Tables) -> DataFrame:
    lines = t.lines.withColumn("order", F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")))
    orders = t.sales_orders.select(F.col("o_orderkey").alias("order"), "order_date")
    out = f.adjusted_posting_date(lines, orders, "order", "ship_date", "order_date")
    return out.groupBy(period_key("adjusted_date").alias("month"), "l_suppkey").agg(F.sum("quantity").alias("quantity"))


