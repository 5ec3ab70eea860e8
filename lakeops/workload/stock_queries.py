"""Stock queries: supplier = plant, part = material, line items = stock and movements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import first_match
from ..operators.joins import lookup, period_key
from ..operators.reshape import pivot_sums
from ..plans import quality, stock as s
from ..session import SHARED_KEYS_CONF
from .core import ITEMS, LINES, Tables, near, query, rounded
from .relational import RATES, weight_versions

FACTORS = "factors AS (SELECT p_partkey AS material, p_size AS numerator, 10 AS denominator FROM part WHERE p_partkey % 4 <> 0)"
PLANTS = "plants AS (SELECT s_suppkey AS plant, s_nationkey % 2 AS is_plant FROM supplier)"
LOCATION = "l_returnflag || l_linestatus || l_linenumber"


def factors(t: Tables, every: bool = False) -> DataFrame:
    parts = t.part if every else t.part.where("p_partkey % 4 <> 0")
    return parts.select(F.col("p_partkey").alias("material"), F.col("p_size").alias("numerator"),
                        F.lit(10).alias("denominator"))


def plant_marks(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("plant"), (F.col("s_nationkey") % 2).alias("is_plant"))


def location() -> F.Column:
    return F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))


STOCK = f"""{LINES}, {PLANTS}, cells AS (SELECT l_partkey AS material, l_suppkey AS plant, {LOCATION} AS location,
  sum(quantity) AS free, sum(quantity) FILTER (l_linestatus = 'O') AS q, sum(quantity) FILTER (l_returnflag = 'R') AS b
  FROM lines WHERE l_linenumber <= 5 GROUP BY 1, 2, 3),
stock AS (SELECT c.material, c.plant, location, is_plant, free, coalesce(q, 0) AS quality, coalesce(b, 0) AS blocked, p_size AS n
  FROM cells c JOIN plants USING (plant) JOIN part ON p_partkey = c.material),
transit AS (SELECT l_partkey AS material, l_suppkey AS plant, is_plant, sum(quantity) AS quantity, p_size AS n FROM lines
  JOIN plants ON plants.plant = l_suppkey JOIN part ON p_partkey = l_partkey WHERE l_linenumber > 5 GROUP BY ALL),
mt AS (SELECT material, plant, location, is_plant, (free + quality + blocked)::DOUBLE * (n::DOUBLE / 10) / 1000 AS total,
  free::DOUBLE * (n::DOUBLE / 10) / 1000 AS f, quality::DOUBLE * (n::DOUBLE / 10) / 1000 AS q, 0.0 AS transit FROM stock
  UNION ALL SELECT material, plant, NULL, is_plant, 0.0, 0.0, 0.0, quantity::DOUBLE * (n::DOUBLE / 10) / 1000 FROM transit),
split AS (SELECT *, CASE WHEN location IN ('AF1', 'AO1') THEN total ELSE 0 END AS reclaim,
  CASE WHEN location IN ('NF1', 'NF2', 'NO1') AND is_plant = 0 THEN f WHEN location = 'NO2' AND is_plant = 1 THEN f ELSE 0 END AS good,
  CASE WHEN location IN ('NO2') THEN q ELSE 0 END AS curing FROM mt)"""


@query(f"""WITH {STOCK} SELECT material, plant, location, {near('total')} AS total_mt, {near('transit')} AS in_transit_mt,
{near('reclaim')} AS reclaimable_mt, {near('good')} AS good_mt, {near('curing')} AS curing_mt,
{near("CASE WHEN location IN ('RF1', 'RO1') AND is_plant = 0 THEN total - (good + reclaim + curing) WHEN is_plant = 1 THEN total - (good + reclaim + curing) ELSE 0 END")}
AS destroyable_mt FROM split WHERE total <> 0 OR transit <> 0""")
def stock_categories(t: Tables) -> DataFrame:
    lines = t.lines.withColumns({"location": location(), "plant": F.col("l_suppkey"), "material": F.col("l_partkey")})
    held = lambda flag: F.coalesce(F.sum(F.when(flag, F.col("quantity"))), F.lit(0))
    cells = lines.where("l_linenumber <= 5").groupBy("material", "plant", "location").agg(
        F.sum("quantity").alias("free"), held(F.col("l_linestatus") == "O").alias("quality"),
        held(F.col("l_returnflag") == "R").alias("blocked"))
    moving = lines.where("l_linenumber > 5").groupBy("material", "plant").agg(F.sum("quantity").alias("quantity"))
    full = lambda df: lookup(lookup(df, plant_marks(t), ["plant"], ["is_plant"], how="inner"),
                             factors(t, every=True), ["material"], ["numerator", "denominator"], how="inner")
    out = s.stock_categories(full(cells), full(moving), ("AF1", "AO1"), ("NF1", "NF2", "NO1"), ("NO2",), ("NO2",), ("RF1", "RO1"))
    return rounded(out, [c for c in out.columns if c.endswith("_mt")])


VALUATION = f"""{LINES}, val AS (SELECT DISTINCT l_suppkey AS plant, l_partkey AS material, nullif(l_returnflag, 'N') AS val_type
  FROM lines), sized AS (SELECT *, count(*) OVER (PARTITION BY plant, material) AS n FROM val),
prices AS (SELECT v.plant, v.material, CASE p_size % 3 WHEN 0 THEN p_retailprice WHEN 1 THEN p_retailprice * 2 END::DECIMAL(18,2) AS price
  FROM sized v JOIN part ON p_partkey = v.material WHERE n = 1 OR val_type IS NULL),
held AS (SELECT l_suppkey AS plant, l_partkey AS material, sum(quantity) AS free,
  coalesce(sum(quantity) FILTER (l_linestatus = 'O'), 0) AS quality FROM lines GROUP BY 1, 2)"""


@query(f"""WITH {VALUATION} SELECT plant, material, price::DOUBLE AS price, (free * price)::DOUBLE AS free_value,
(quality * price)::DOUBLE AS quality_value FROM held LEFT JOIN prices USING (plant, material)""")
def stock_valuation(t: Tables) -> DataFrame:
    """Parts of every third size use the standard price, the next the average, the others none."""
    keyed = t.lines.withColumns({"plant": F.col("l_suppkey"), "material": F.col("l_partkey")})
    val = keyed.select("plant", "material", F.nullif("l_returnflag", F.lit("N")).alias("val_type")).distinct()
    price = F.col("p_retailprice").cast("decimal(18,2)")
    parts = t.part.select(
        F.col("p_partkey").alias("material"), price.alias("standard_price"), (price * 2).cast("decimal(18,2)").alias("average_price"),
        first_match([(F.col("p_size") % 3 == 0, "S"), (F.col("p_size") % 3 == 1, "V")], "X").alias("control"))
    val = lookup(val, parts, ["material"], ["standard_price", "average_price", "control"], how="inner")
    held = keyed.groupBy("plant", "material").agg(
        F.sum("quantity").alias("free"),
        F.coalesce(F.sum(F.when(F.col("l_linestatus") == "O", F.col("quantity"))), F.lit(0)).alias("quality"))
    out = s.valuate(held, val, {"free_value": "free", "quality_value": "quality"})
    return out.select("plant", "material", "price", "free_value", "quality_value")


MOVES = f"""{LINES}, {PLANTS}, moves AS (SELECT l_orderkey AS doc, l_linenumber AS item, l_partkey AS material, l_suppkey AS plant,
  CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Z61' WHEN 'AO' THEN 'Z62' WHEN 'NF' THEN 'Z63' WHEN 'NO' THEN '261'
    WHEN 'RF' THEN '531' ELSE '655' END AS code, CASE WHEN l_linenumber < 4 THEN '0081' ELSE '0070' END AS location, quantity AS w
  FROM lines)"""


def moves(t: Tables) -> DataFrame:
    pair = F.concat("l_returnflag", "l_linestatus")
    code = first_match([(pair == a, b) for a, b in (("AF", "Z61"), ("AO", "Z62"), ("NF", "Z63"), ("NO", "261"), ("RF", "531"))], "655")
    return t.lines.select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("item"), F.col("l_partkey").alias("material"),
        F.col("l_suppkey").alias("plant"), code.alias("code"),
        F.when(F.col("l_linenumber") < 4, "0081").otherwise("0070").alias("location"), F.col("quantity").alias("weight_mt"))


@query(f"""WITH {MOVES} SELECT plant, material, sum(CASE WHEN code IN ('Z61', 'Z64') THEN w WHEN code IN ('Z62', 'Z63') THEN -w END)::DOUBLE AS depot_loss,
sum(CASE WHEN material % 9 = 0 THEN 0 WHEN location = '0081' AND code IN ('262', '531') THEN CASE WHEN plant % 5 = 0 THEN w ELSE -w END
  WHEN location = '0081' AND code IN ('261', '532') THEN CASE WHEN plant % 5 = 0 THEN -w ELSE w END END)::DOUBLE AS plant_loss,
sum(CASE WHEN is_plant = 0 AND code = 'Z61' THEN w WHEN is_plant = 0 AND code = 'Z62' THEN -w
  WHEN is_plant = 1 AND plant % 5 <> 0 AND code = '261' THEN w END)::DOUBLE AS sent,
sum(CASE WHEN is_plant = 0 AND code = 'Z63' THEN w WHEN is_plant = 1 AND code = '531' THEN w END)::DOUBLE AS received,
sum(CASE WHEN code = '655' THEN w END)::DOUBLE AS market_loss,
max(CASE WHEN is_plant = 0 AND location = '0081' THEN '2001' WHEN is_plant = 0 AND location = '0070' THEN '2003' END) AS supplying FROM moves JOIN plants USING (plant) GROUP BY 1, 2""")
def movement_net_loss(t: Tables) -> DataFrame:
    c = F.col
    volume = c("plant") % 5 == 0
    here = c("location") == "0081"
    depot, plant = c("is_plant") == 0, c("is_plant") == 1
    code = lambda *x: c("code").isin(*x)
    rules = {
        "depot_loss": [(code("Z61", "Z64"), 1), (code("Z62", "Z63"), -1)],
        "plant_loss": [(here & volume & code("262", "531"), 1), (here & volume & code("261", "532"), -1),
                       (here & code("262", "531"), -1), (here & code("261", "532"), 1)],
        "sent": [(depot & code("Z61"), 1), (depot & code("Z62"), -1), (plant & ~volume & code("261"), 1),
                 (plant & ~volume & code("262"), -1)],
        "received": [(depot & code("Z63"), 1), (depot & code("Z64"), -1), (plant & code("531"), 1), (plant & code("532"), -1)],
        "market_loss": [(code("655"), 1), (code("656"), -1)],
    }
    out = s.movement_loss(lookup(moves(t), plant_marks(t), ["plant"], ["is_plant"], how="inner"), rules,
                          zero_where={"plant_loss": c("material") % 9 == 0})
    supplying = s.supplying_plant(c("is_plant"), c("location"), {"2001": ("0081",), "2003": ("0070",)})
    return out.withColumn("supplying", supplying).groupBy("plant", "material").agg(
        *[F.sum(m).alias(m) for m in rules], F.max("supplying").alias("supplying"))


@query(f"""WITH {ITEMS}, {FACTORS}, {RATES}
SELECT l_orderkey, l_linenumber, {near("CASE WHEN f.numerator IS NOT NULL THEN i.quantity::DOUBLE * (f.numerator::DOUBLE / 10) WHEN r.weight IS NOT NULL THEN (i.quantity * r.weight)::DOUBLE WHEN i.flag = 'N' THEN i.quantity::DOUBLE END")} AS kilograms
FROM items i LEFT JOIN factors f ON f.material = i.partkey
LEFT JOIN rates r ON r.material = i.partkey AND i.ship_date BETWEEN r.valid_from AND r.valid_to""")
def unit_conversion(t: Tables) -> DataFrame:
    rows = t.items.select("l_orderkey", "l_linenumber", F.col("partkey").alias("material"), F.col("suppkey").alias("plant"),
                          F.col("quantity").cast("decimal(18,2)").alias("quantity"), F.col("ship_date").alias("date"),
                          F.when(F.col("flag") == "N", "KG").otherwise("EA").alias("unit"))
    out = s.to_unit(rows, factors(t), "quantity", "kilograms", fallback=weight_versions(t), unit="unit",
                    weight_keys=("material",))
    return rounded(out, ["kilograms"]).select("l_orderkey", "l_linenumber", "kilograms")


@query(f"""WITH {LINES} SELECT l_suppkey AS plant, l_partkey AS material, sum(CASE WHEN s_nationkey < 5 THEN quantity * 2 ELSE quantity * 3 END)::DOUBLE AS reported
FROM lines JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2""")
def plant_reporting_unit(t: Tables) -> DataFrame:
    rows = t.lines.select(F.col("l_suppkey").alias("plant"), F.col("l_partkey").alias("material"),
                          (F.col("quantity") * 2).alias("cubic"), (F.col("quantity") * 3).alias("tonnes"))
    volume = t.supplier.where("s_nationkey < 5").select(F.col("s_suppkey").alias("plant"))
    out = s.by_plant_unit(rows, volume, "tonnes", "cubic", "reported")
    return out.groupBy("plant", "material").agg(F.sum("reported").alias("reported"))


MONTH_NAMES = ["JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER"]


@query(f"""WITH {LINES}, plan AS (SELECT l_suppkey AS plant, l_linestatus AS line, date_trunc('month', ship_date)::DATE AS month, sum(quantity) AS target
  FROM lines GROUP BY 1, 2, 3),
daily AS (SELECT *, {near("target::DOUBLE / day(last_day(month))", 2)} AS planned_day FROM plan),
need AS (SELECT l_suppkey AS plant, l_linestatus AS line, l_returnflag AS rm_group, date_trunc('month', ship_date)::DATE AS month,
  count(*) AS per_unit FROM lines GROUP BY 1, 2, 3, 4),
stock AS (SELECT l_suppkey AS plant, l_returnflag AS rm_group, sum(quantity) AS stock_quantity FROM lines GROUP BY 1, 2),
start AS (SELECT plant, line, rm_group, stock_quantity FROM (SELECT DISTINCT plant, line, rm_group FROM need WHERE year(month) = 2000)
  JOIN stock USING (plant, rm_group)),
future AS (SELECT s.*, d::DATE AS stock_date FROM start s, (SELECT unnest(generate_series(DATE '2000-05-21', DATE '2000-06-19', INTERVAL 1 DAY)) AS d)),
req AS (SELECT f.*, y.planned_day * n.per_unit AS required FROM future f LEFT JOIN need n ON n.plant = f.plant AND n.line = f.line
  AND n.rm_group = f.rm_group AND n.month = date_trunc('month', f.stock_date) LEFT JOIN daily y ON y.plant = f.plant AND y.line = f.line AND y.month = n.month)
SELECT plant, line, rm_group, stock_date, {near("stock_quantity::DOUBLE - sum(required) OVER (PARTITION BY plant, line, rm_group ORDER BY stock_date)", 2)} AS end_of_day_stock FROM req""")
def material_deficit(t: Tables) -> DataFrame:
    sheets = t.lines.select(
        F.col("l_suppkey").alias("plant"), F.col("l_linestatus").alias("line"), F.col("l_returnflag").alias("rm_group"),
        F.upper(F.date_format("ship_date", "MMMM")).alias("m"), F.year("ship_date").alias("fy"), "quantity")
    plan = pivot_sums(sheets, ["plant", "line", "fy"], "m", MONTH_NAMES, {"q": F.sum(F.col("quantity")).cast("double")}, fill=None)
    need = pivot_sums(sheets, ["plant", "line", "rm_group", "fy"], "m", MONTH_NAMES, {"q": F.count(F.lit(1))}, fill=None)
    groups = t.part.select(F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R"))).alias("rm_group"),
                           F.col("p_partkey").cast("string").alias("m"))
    groups = groups.select("rm_group", F.concat_ws("-", "rm_group", "m").alias("material"))
    held = t.lines.groupBy(F.concat_ws("-", "l_returnflag", F.col("l_partkey").cast("string")).alias("material"),
                           F.col("l_suppkey").alias("plant")).agg(F.sum("quantity").alias("quantity"))
    out = s.material_deficit(plan, need, groups, held, "2000-05-20")
    return rounded(out, ["end_of_day_stock"], 2).select("plant", "line", "rm_group", "stock_date", "end_of_day_stock")


SEASON = f"""{LINES}, seen AS (SELECT l_suppkey AS plant, p_brand AS material, lines.* FROM lines JOIN part ON p_partkey = l_partkey),
days AS (SELECT d::DATE AS date FROM (SELECT unnest(generate_series(DATE '2000-02-10', DATE '2000-03-31', INTERVAL 1 DAY)) AS d)),
pairs AS (SELECT DISTINCT plant, material FROM seen WHERE l_returnflag = 'A'),
opening AS (SELECT plant, material, sum(quantity)::DOUBLE AS good, sum(quantity + 5)::DOUBLE AS opening, count(*) AS depot_opening FROM seen WHERE ship_date < DATE '2000-02-10' GROUP BY 1, 2),
mp AS (SELECT plant, material, date_trunc('month', ship_date)::DATE AS month, sum(quantity)::DOUBLE AS sales_plan, sum(quantity) FILTER (l_returnflag = 'R') AS sales,
  count(*) AS transfer_plan, sum(l_linenumber) AS depot_plan FROM seen GROUP BY 1, 2, 3),
split AS (SELECT s_suppkey AS plant, n AS day_no, (s_nationkey + n) % 7 AS plant_percent, (s_nationkey + n) % 5 AS depot_percent FROM supplier, (SELECT unnest(range(1, 32)) AS n)),
prod AS (SELECT plant, material, ship_date AS date, sum(quantity)::DOUBLE AS q FROM seen WHERE l_linestatus = 'O' GROUP BY 1, 2, 3),
done AS (SELECT plant, material, ship_date AS date, sum(quantity)::DOUBLE AS q FROM seen WHERE l_linestatus = 'F' GROUP BY 1, 2, 3),
cured AS (SELECT plant, material, date + 15 AS date, sum(q) AS q FROM (SELECT * FROM prod UNION ALL SELECT * FROM done) GROUP BY 1, 2, 3),
g AS (SELECT p.plant, p.material, d.date, coalesce(o.good, 0) AS good, coalesce(o.opening, 0) AS opening, coalesce(o.depot_opening, 0) AS dopen,
  (coalesce(m.sales_plan, 0) - coalesce(m.sales, 0)::DOUBLE) * s.plant_percent / 100 AS psd, coalesce(m.depot_plan, 0)::DOUBLE * s.depot_percent / 100 AS dsd,
  CASE WHEN day(d.date) < day(last_day(d.date)) - 3 THEN coalesce(m.transfer_plan, 0)::DOUBLE / (day(last_day(d.date)) - 3) ELSE 0 END AS tr,
  coalesce(r.q, 0) AS made, coalesce(c.q, 0) AS cured
  FROM pairs p CROSS JOIN days d LEFT JOIN opening o USING (plant, material) LEFT JOIN mp m ON m.plant = p.plant AND m.material = p.material AND m.month = date_trunc('month', d.date)
  LEFT JOIN split s ON s.plant = p.plant AND s.day_no = day(d.date) LEFT JOIN prod r ON r.plant = p.plant AND r.material = p.material AND r.date = d.date
  LEFT JOIN cured c ON c.plant = p.plant AND c.material = p.material AND c.date = d.date)"""
_RUN = lambda x: f"sum({x}) OVER (PARTITION BY plant, material ORDER BY date)"


@query(f"""WITH {SEASON} SELECT plant, material, date, made AS production, {near('psd')} AS plant_sales_day, {near('tr')} AS transfer_day,
{near('opening + ' + _RUN('made - psd - tr'), 3)} AS closing_stock, {near('dopen + ' + _RUN('tr - dsd'), 3)} AS depot_closing_stock,
{near('good + ' + _RUN('cured - psd - tr'), 3)} AS dispatchable_stock FROM g""", conf=SHARED_KEYS_CONF)
def daily_seasonal_plan(t: Tables) -> DataFrame:
    k = ["plant", "material"]
    seen = lookup(t.lines, t.part, [("l_partkey", "p_partkey")], [("p_brand", "material")], how="inner").withColumn(
        "plant", F.col("l_suppkey"))
    qty = F.sum(F.col("quantity")).cast("double")
    bounds = F.sequence(F.lit("2000-02-10").cast("date"), F.lit("2000-03-31").cast("date"))
    grid = seen.where("l_returnflag = 'A'").select(*k).distinct().withColumn("date", F.explode(bounds))
    opening = seen.where("ship_date < DATE '2000-02-10'").groupBy(*k).agg(
        qty.alias("good"), F.sum(F.col("quantity") + 5).cast("double").alias("opening"), F.count(F.lit(1)).alias("depot_opening"))
    month_plan = seen.groupBy(*k, period_key("ship_date").alias("month")).agg(
        qty.alias("sales_plan"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("quantity"))).cast("double").alias("sales"),
        F.count(F.lit(1)).cast("double").alias("transfer_plan"), F.lit(0.0).alias("transferred"),
        F.sum("l_linenumber").cast("double").alias("depot_plan"), F.lit(0.0).alias("depot_sales"))
    n = F.col("day_no")
    split = t.supplier.select(F.col("s_suppkey").alias("plant"), "s_nationkey", F.explode(F.sequence(F.lit(1), F.lit(31))).alias("day_no"))
    split = split.select("plant", "day_no", ((F.col("s_nationkey") + n) % 7).alias("plant_percent"),
                         ((F.col("s_nationkey") + n) % 5).alias("depot_percent"))
    made = lambda status: seen.where(F.col("l_linestatus") == status).groupBy(*k, F.col("ship_date").alias("date")).agg(qty.alias("quantity"))
    out = s.daily_plan(grid, opening, month_plan, split, made("O"), made("F"))
    out = rounded(out, ["plant_sales_day", "transfer_day"])
    return rounded(out, ["closing_stock", "depot_closing_stock", "dispatchable_stock"], 3)


@query(f"""WITH {LINES}, s AS (SELECT l_suppkey AS plant, l_partkey AS material, * FROM lines)
SELECT plant, material, sum(quantity)::DOUBLE AS quantity, sum(price)::DOUBLE / sum(quantity)::DOUBLE AS price,
max(ship_date) FILTER (l_linestatus = 'F') AS last_receipt, max(ship_date) FILTER (l_linestatus = 'O') AS last_issue,
{near('sum(quantity)::DOUBLE * (sum(price)::DOUBLE / sum(quantity)::DOUBLE)', 2)} AS stock_value FROM s GROUP BY 1, 2""")
def non_moving_stock(t: Tables) -> DataFrame:
    k = ["plant", "material"]
    lines = t.lines.withColumns({"plant": F.col("l_suppkey"), "material": F.col("l_partkey"), "date": F.col("ship_date"),
                                 "sign": F.when(F.col("l_linestatus") == "F", 1).otherwise(-1), "value": F.col("price")})
    return rounded(s.non_moving(lines, lines, lines, k), ["stock_value"], 2)


@query("""SELECT l_suppkey AS plant, sum(CASE WHEN substr(p_brand, 7, 1) IN ('2', '4') THEN l_quantity ELSE 0 END) AS good_stock,
sum(CASE WHEN substr(p_brand, 7, 1) IN ('2', '4') THEN 0 ELSE l_quantity END) AS defective_stock,
sum(CASE WHEN substr(p_brand, 7, 1) IN ('2', '4') THEN 0 ELSE l_quantity END) / sum(l_quantity) AS rejection_share,
sum(CASE WHEN substr(p_brand, 7, 1) IN ('2', '4') THEN 0 ELSE l_quantity END) / sum(l_quantity) * 100 AS rejection_percent
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def location_prefix_rejection(t: Tables) -> DataFrame:
    stock = lookup(t.lines, t.part, [("l_partkey", "p_partkey")], ["p_brand"], how="inner")
    stock = stock.select(F.col("l_suppkey").alias("plant"), F.substring("p_brand", 7, 2).alias("place"), "quantity")
    return quality.rejection_share(stock, ["plant"], "place", "quantity")


@query(f"""WITH {LINES}, h AS (SELECT date_trunc('month', ship_date)::DATE AS snapshot, lpad(l_partkey::VARCHAR, 18, '0') AS material, sum(quantity) AS quantity
  FROM lines GROUP BY 1, 2) SELECT snapshot, material, (CASE WHEN snapshot >= DATE '2001-07-01' THEN quantity + 1 ELSE quantity END)::DOUBLE AS quantity FROM h""")
def history_backload(t: Tables) -> DataFrame:
    """Text rows of the newest months replace those months in the history."""
    month = F.trunc("ship_date", "MM")
    history = t.lines.groupBy(month.alias("snapshot"), F.lpad(F.col("l_partkey").cast("string"), 18, "0").alias("material")).agg(
        F.sum("quantity").cast("decimal(13,3)").alias("quantity"))
    texts = t.lines.groupBy(month.alias("snapshot"), F.col("l_partkey").alias("material")).agg(
        (F.sum("quantity") + 1).alias("quantity")).where("snapshot >= DATE '2001-07-01'")
    texts = texts.select(*[F.col(c).cast("string").alias(c) for c in texts.columns])
    return s.backload(texts, history, {"material": 18}, ["quantity"], "snapshot")


