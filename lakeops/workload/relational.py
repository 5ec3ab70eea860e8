"""Predicates, joins, aggregations, windows and set operations on the test tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F

from ..functions.columns import by_code, first_match, is_blank, ratio
from ..functions.dates import fiscal_year
from ..functions.ordering import rank
from ..operators import hierarchies, joins, reshape, windows
from ..operators.calendar import days_of
from ..plans.finance import weighted_price
from .core import ITEMS, LINES, SALES_ORDERS, Tables, query

# --- projections and predicates -----------------------------------------------------------


@query("""SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, c.c_name AS customer_name
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""")
def prefixed_projection(t: Tables) -> DataFrame:
    o, c = t.orders.alias("o"), t.customer.alias("c")
    kept = [F.col(f"o.{x}") for x in ("o_orderkey", "o_custkey", "o_orderstatus")]
    return o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey")).select(*kept, F.col("c.c_name").alias("customer_name"))


@query(f"""WITH {LINES} SELECT l_orderkey, l_linenumber, (price * (1 - discount))::DOUBLE AS net,
(price * (1 - discount) * (1 + tax))::DOUBLE AS gross, 'MT' AS unit FROM lines""")
def computed_columns(t: Tables) -> DataFrame:
    return t.lines.selectExpr("l_orderkey", "l_linenumber", "price * (1 - discount) AS net",
                              "price * (1 - discount) * (1 + tax) AS gross", "'MT' AS unit")


@query("""SELECT p_partkey AS part_id, p_size * 2 AS double_size, p_brand, 'all' AS tag FROM part""")
def added_renamed_dropped_columns(t: Tables) -> DataFrame:
    return t.part.withColumns({"double_size": F.col("p_size") * 2, "tag": F.lit("all")}).withColumnsRenamed(
        {"p_partkey": "part_id"}).drop("p_name", "p_type", "p_size", "p_retailprice")


SEGMENT_CLASS = [("BUILDING", "PROJECT"), ("AUTOMOBILE", "INDUSTRY"), ("MACHINERY", "INDUSTRY")]


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'PROJECT' WHEN c_mktsegment IN
('AUTOMOBILE', 'MACHINERY') THEN 'INDUSTRY' ELSE 'RETAIL' END AS class FROM customer""")
def case_chain(t: Tables) -> DataFrame:
    rules = [(F.col("c_mktsegment") == s, c) for s, c in SEGMENT_CLASS]
    return t.customer.select("c_custkey", first_match(rules, "RETAIL").alias("class"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_linenumber NOT IN (2, 3) AND l_quantity > 10 GROUP BY 1, 2""")
def list_predicates(t: Tables) -> DataFrame:
    hit = F.col("l_returnflag").isin("A", "R") & ~F.col("l_linenumber").isin(2, 3)
    return t.lineitem.where(hit).where("l_quantity > 10").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, o_orderdate::DATE AS order_date FROM orders
WHERE o_orderdate::DATE BETWEEN DATE '1997-04-01' AND DATE '1998-03-31'""")
def between_dates(t: Tables) -> DataFrame:
    low, high = (F.lit(x).cast("timestamp_ntz") for x in ("1997-04-01", "1998-04-01"))
    return t.orders.where((F.col("o_orderdate") >= low) & (F.col("o_orderdate") < high)).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))


@query("""SELECT p_partkey, p_name, p_brand FROM part
WHERE p_name LIKE '%ring%' OR contains(p_type, 'ECO') OR substr(p_brand, 7, 1) = '2'""")
def text_predicates(t: Tables) -> DataFrame:
    c = F.col
    return t.part.where(c("p_name").like("%ring%") | c("p_type").contains("ECO") | (
        F.substring("p_brand", 7, 1) == "2")).select("p_partkey", "p_name", "p_brand")


@query("""WITH d AS (SELECT doc_id, nullif(lang, 'en') AS lang, CASE source WHEN (SELECT min(source) FROM documents)
  THEN ' ' ELSE source END AS source FROM documents)
SELECT doc_id, lang IS NULL AS no_lang, (source IS NULL OR trim(source) = '') AS no_source FROM d""")
def null_and_blank_tests(t: Tables) -> DataFrame:
    least = t.documents.agg(F.min("source")).scalar()
    d = t.documents.select("doc_id", F.nullif("lang", F.lit("en")).alias("lang"),
                           F.when(F.col("source") == least, " ").otherwise(F.col("source")).alias("source"))
    return d.select("doc_id", F.col("lang").isNull().alias("no_lang"), is_blank("source").alias("no_source"))


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN
(SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-01-01')""")
def not_in_list(t: Tables) -> DataFrame:
    recent = t.orders.where("o_orderdate >= TIMESTAMP_NTZ '2001-01-01'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti(t.customer, recent, ["c_custkey"]).select("c_custkey", "c_mktsegment")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
(SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def in_subquery(t: Tables) -> DataFrame:
    owing = t.customer.where("c_acctbal < 0")
    return joins.semi(t.orders, owing, [("o_custkey", "c_custkey")]).select("o_orderkey", "o_custkey")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_partkey IN
(SELECT p_partkey FROM part WHERE p_type = 'ECONOMY' AND p_size > 25) GROUP BY 1, 2""")
def in_value_list(t: Tables) -> DataFrame:
    """The list stays a frame; nothing is pulled to the driver."""
    wanted = t.part.where("p_type = 'ECONOMY' AND p_size > 25")
    hit = joins.semi(t.lineitem, wanted, [("l_partkey", "p_partkey")])
    return hit.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT DISTINCT l_partkey, l_suppkey FROM lineitem a WHERE l_returnflag = 'A' AND NOT EXISTS
(SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'R' AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey)""")
def not_exists_two_columns(t: Tables) -> DataFrame:
    pairs = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag")
    a = pairs.where("l_returnflag = 'A'").drop("l_returnflag").distinct()
    return joins.anti(a, pairs.where("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"])


# --- joins --------------------------------------------------------------------------------


@query(f"""WITH {LINES}, {SALES_ORDERS} SELECT c.c_nationkey, o.o_orderstatus, count(*) AS n, sum(l.price)::DOUBLE AS price
FROM lines l JOIN sales_orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2""")
def inner_joins(t: Tables) -> DataFrame:
    out = t.lines.join(t.sales_orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return out.groupBy("c_nationkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))


@query("""SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def left_join(t: Tables) -> DataFrame:
    return joins.lookup(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"], ["quality", "toxic"])


@query("""SELECT d.doc_id, d.lang, l.quality FROM labels l RIGHT JOIN documents d ON d.doc_id = l.doc_id AND l.toxic = 0""")
def right_join(t: Tables) -> DataFrame:
    clean = t.labels.where("toxic = 0").select("doc_id", "quality")
    return clean.join(t.documents.select("doc_id", "lang"), "doc_id", "right").select("doc_id", "lang", "quality")


@query(f"""WITH {LINES}, bought AS (SELECT l_partkey, l_suppkey, sum(quantity) AS bought FROM lines WHERE l_returnflag = 'A' GROUP BY 1, 2),
sold AS (SELECT l_partkey, l_suppkey, sum(quantity) AS sold FROM lines WHERE l_returnflag = 'R' GROUP BY 1, 2)
SELECT l_partkey, l_suppkey, bought::DOUBLE AS bought, sold::DOUBLE AS sold FROM bought FULL JOIN sold USING (l_partkey, l_suppkey)""")
def full_outer_merge(t: Tables) -> DataFrame:
    keys = ["l_partkey", "l_suppkey"]
    side = lambda flag, name: t.lines.where(F.col("l_returnflag") == flag).groupBy(*keys).agg(
        F.sum("quantity").alias(name))
    return joins.full_merge(side("A", "bought"), side("R", "sold"), keys)


@query("SELECT doc_id, lang FROM documents WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)")
def semi_join(t: Tables) -> DataFrame:
    return joins.semi(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])


@query("SELECT doc_id, lang FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)")
def anti_join(t: Tables) -> DataFrame:
    return joins.anti(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])


@query("""WITH months AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month FROM orders),
regions AS (SELECT DISTINCT r_name FROM region) SELECT r_name, month FROM regions, months""")
def plant_month_grid(t: Tables) -> DataFrame:
    """Every region with every month: the months ride along as one bounded list, no cross join."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    months = days_of(t.orders, "o_orderdate").select(F.trunc("date_dt", "MM").alias("m")).distinct()
    seen = joins.semi(months, t.orders.select(month.alias("m")), ["m"])
    listed = seen.agg(F.collect_set("m")).scalar()
    return t.region.select("r_name").distinct().select("r_name", F.explode(listed).alias("month"))


@query("""WITH t AS (SELECT c_custkey, ' ' || lpad(c_custkey::VARCHAR, 10, '0') || ' ' AS code FROM customer)
SELECT o.o_orderkey, t.c_custkey FROM orders o JOIN t ON trim(t.code) = lpad(o.o_custkey::VARCHAR, 10, '0')""")
def normalised_key_join(t: Tables) -> DataFrame:
    padded = F.lpad(F.col("c_custkey").cast("string"), 10, "0")
    codes = t.customer.select("c_custkey", F.concat(F.lit(" "), padded, F.lit(" ")).alias("code"))
    codes = codes.withColumn("code", F.trim("code"))
    orders = t.orders.select("o_orderkey", F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("code"))
    return orders.join(codes, "code").select("o_orderkey", "c_custkey")


@query(f"""WITH {LINES}, {SALES_ORDERS}, shipped AS (SELECT strftime(ship_date, '%m-%Y') AS m, sum(price) AS shipped
  FROM lines GROUP BY 1), ordered AS (SELECT strftime(order_date, '%m-%Y') AS m, sum(total) AS ordered
  FROM sales_orders GROUP BY 1)
SELECT strptime('01-' || m, '%d-%m-%Y')::DATE AS month, shipped::DOUBLE AS shipped, ordered::DOUBLE AS ordered
FROM shipped JOIN ordered USING (m)""")
def period_join(t: Tables) -> DataFrame:
    shipped = t.lines.groupBy(joins.period_key("ship_date").alias("month")).agg(F.sum("price").alias("shipped"))
    ordered = t.sales_orders.groupBy(joins.period_key("order_date").alias("month")).agg(F.sum("total").alias("ordered"))
    return shipped.join(ordered, "month")


# Parts have up to three weight versions with a gap; every tenth part has none at all.
RATES = """rates AS (
  SELECT p_partkey AS material, v.valid_from, v.valid_to, (p_size * v.f)::DECIMAL(13,3) AS weight FROM part,
  (VALUES (DATE '1990-01-01', DATE '1996-12-31', 1.0), (DATE '1997-01-01', DATE '1998-12-31', 1.5),
          (DATE '2000-01-01', DATE '2999-12-31', 2.0)) v(valid_from, valid_to, f) WHERE p_partkey % 10 <> 0)"""


def weight_versions(t: Tables) -> DataFrame:
    versions = F.array(*[
        F.struct(F.lit(a).cast("date").alias("valid_from"), F.lit(b).cast("date").alias("valid_to"),
                 F.lit(f).cast("decimal(13,3)").alias("f"))
        for a, b, f in (("1990-01-01", "1996-12-31", "1.0"), ("1997-01-01", "1998-12-31", "1.5"),
                        ("2000-01-01", "2999-12-31", "2.0"))])
    parts = t.part.where("p_partkey % 10 <> 0").select(F.col("p_partkey").alias("material"), "p_size",
                                                       F.inline(versions))
    return parts.select("material", "valid_from", "valid_to", (F.col("p_size") * F.col("f")).cast("decimal(13,3)").alias("weight"))


@query(f"""WITH {ITEMS}, {RATES} SELECT i.l_orderkey, i.l_linenumber, i.ship_date, r.weight::DOUBLE AS weight
FROM items i LEFT JOIN rates r ON r.material = i.partkey AND i.ship_date BETWEEN r.valid_from AND r.valid_to""")
def effective_dated_join(t: Tables) -> DataFrame:
    out = joins.effective_dated(t.items, weight_versions(t), [("partkey", "material")], "ship_date", "valid_from",
                                "valid_to", ["weight"])
    return out.select("l_orderkey", "l_linenumber", "ship_date", "weight")


@query(f"""WITH {ITEMS}, {RATES} SELECT i.l_orderkey, i.l_linenumber, i.ship_date, r.weight::DOUBLE AS weight
FROM items i LEFT JOIN rates r ON r.material = i.partkey
WHERE i.ship_date BETWEEN r.valid_from AND r.valid_to OR (r.valid_from IS NULL AND r.valid_to IS NULL)""")
def effective_dated_filter(t: Tables) -> DataFrame:
    out = joins.effective_dated(t.items, weight_versions(t), [("partkey", "material")], "ship_date", "valid_from",
                                "valid_to", ["weight"], keep_unmatched=False)
    return out.select("l_orderkey", "l_linenumber", "ship_date", "weight")


@query(f"""WITH {LINES}, a AS (SELECT l_suppkey, nullif(l_returnflag, 'N') AS f, sum(quantity) AS q FROM lines GROUP BY 1, 2),
b AS (SELECT l_suppkey, nullif(l_returnflag, 'N') AS f, sum(price) AS p FROM lines WHERE l_linestatus = 'O' GROUP BY 1, 2)
SELECT a.l_suppkey, a.f, q::DOUBLE AS q, p::DOUBLE AS p FROM a LEFT JOIN b
ON b.l_suppkey = a.l_suppkey AND (b.f = a.f OR (b.f IS NULL AND a.f IS NULL))""")
def null_safe_join(t: Tables) -> DataFrame:
    flagged = t.lines.withColumn("f", F.nullif("l_returnflag", F.lit("N")))
    a = flagged.groupBy("l_suppkey", "f").agg(F.sum("quantity").alias("q"))
    b = flagged.where("l_linestatus = 'O'").groupBy("l_suppkey", "f").agg(F.sum("price").alias("p"))
    return joins.lookup(a, b, ["l_suppkey", "f"], ["p"], null_safe=True)


@query("""SELECT l_orderkey AS doc, max(CASE WHEN l_linenumber = 1 THEN l_suppkey END) AS payer_party,
max(CASE WHEN l_linenumber = 2 THEN l_suppkey END) AS ship_to_party,
max(CASE WHEN l_linenumber = 3 THEN l_suppkey END) AS agent_party
FROM lineitem WHERE l_linenumber IN (1, 2, 3) GROUP BY 1""")
def role_columns(t: Tables) -> DataFrame:
    partners = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").cast("string").alias("role"),
                                 F.col("l_suppkey").alias("party"))
    return joins.role_columns(partners, ["doc"], "role", {"1": "payer", "2": "ship_to", "3": "agent"}, ["party"])


@query(f"""WITH {SALES_ORDERS}, best AS (SELECT o_custkey, max(total) AS total FROM sales_orders GROUP BY 1)
SELECT o.o_custkey, o.o_orderkey, o.total::DOUBLE AS total FROM sales_orders o JOIN best b
ON b.o_custkey = o.o_custkey AND b.total = o.total""")
def self_join_on_aggregate(t: Tables) -> DataFrame:
    return windows.all_latest(t.sales_orders, ["o_custkey"], "total").select("o_custkey", "o_orderkey", "total")


@query("""WITH docs AS (SELECT o_orderkey AS doc, CASE WHEN o_orderstatus = 'P' THEN o_orderkey + 1 END AS reversed_by,
  o_orderstatus FROM orders), payments AS (SELECT * FROM docs WHERE o_orderstatus IN ('P', 'F'))
SELECT doc, o_orderstatus FROM payments
UNION SELECT d.doc, d.o_orderstatus FROM docs d JOIN payments p ON p.reversed_by = d.doc""")
def reversal_chase(t: Tables) -> DataFrame:
    docs = t.orders.select(
        F.col("o_orderkey").alias("doc"), "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") + 1).alias("reversed_by"))
    payments = docs.where(F.col("o_orderstatus").isin("P", "F"))
    return joins.with_reversed(payments, docs, ["doc"], ["reversed_by"]).select("doc", "o_orderstatus")


@query("""SELECT c.c_custkey, coalesce(CASE WHEN c.c_acctbal > 5000 THEN c.c_name END, n.n_name, 'none') AS shown
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON n.n_nationkey = c.c_nationkey""")
def fallback_chain(t: Tables) -> DataFrame:
    out = joins.lookup(t.customer, t.nation.where("n_regionkey < 3"), [("c_nationkey", "n_nationkey")], ["n_name"])
    own = F.when(F.col("c_acctbal") > 5000, F.col("c_name"))
    return out.select("c_custkey", F.coalesce(own, "n_name", F.lit("none")).alias("shown"))


@query("""SELECT 'C' || c.c_custkey AS pincode, n.n_name AS state, r.r_name AS zone FROM customer c
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey AND r.r_name <> 'ASIA'""")
def hierarchy_climb(t: Tables) -> DataFrame:
    pin = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    link = lambda kind, df, unit, parent: df.select(F.lit(kind).alias("unit_type"), unit.alias("unit"), parent.alias("parent"))
    states = joins.lookup(t.customer, t.nation, [("c_nationkey", "n_nationkey")], ["n_name"])
    zones = joins.lookup(t.nation, t.region.where("r_name <> 'ASIA'"), [("n_regionkey", "r_regionkey")], ["r_name"])
    links = link("pincode", states, pin, F.col("n_name")).unionByName(
        link("STATE", zones, F.col("n_name"), F.col("r_name")))
    members = t.customer.select(pin.alias("pincode"))
    return joins.climb(members, links, ["pincode", "state", "zone"])


# Every customer hangs under the one a third its number up to 0, some 7 levels deep at the smallest size and
# deeper at each larger one; the parent of a rotation has loops of its own.
PARENTS = "parents AS (SELECT c_custkey AS unit, c_custkey // 3 AS parent FROM customer WHERE c_custkey > 0)"
LOOPS = """loops AS (SELECT c_custkey AS unit, (c_custkey * c_custkey + 7) % (SELECT max(c_custkey) + 1 FROM customer) AS parent FROM customer)"""


@query(f"""WITH RECURSIVE {PARENTS}, up AS (SELECT unit, parent, 1 AS step FROM parents
  UNION ALL SELECT up.unit, p.parent, step + 1 FROM up JOIN parents p ON p.unit = up.parent)
SELECT unit, string_agg(parent::VARCHAR, '<' ORDER BY step) AS path, max(step) AS depth, arg_max(parent, step) AS top, false AS cyclic
FROM up GROUP BY 1""")
def hierarchy_paths(t: Tables) -> DataFrame:
    links = t.customer.where("c_custkey > 0").select(F.col("c_custkey").alias("unit"), F.expr("c_custkey div 3").alias("parent"))
    found = hierarchies.paths(links, checkpoints=t.checkpoints)
    return found.withColumn("path", F.array_join(F.transform("path", lambda p: p.cast("string")), "<"))


@query(f"""WITH RECURSIVE {LOOPS}, reach AS (SELECT unit, parent AS here FROM loops
  UNION SELECT r.unit, p.parent FROM reach r JOIN loops p ON p.unit = r.here)
SELECT unit FROM reach WHERE unit = here""")
def hierarchy_cycles(t: Tables) -> DataFrame:
    most = t.customer.agg((F.max("c_custkey") + 1).alias("n")).scalar()
    links = t.customer.select(F.col("c_custkey").alias("unit"), ((F.col("c_custkey") * F.col("c_custkey") + 7) % most).alias("parent"))
    return hierarchies.on_cycles(links, checkpoints=t.checkpoints)


# --- aggregations -------------------------------------------------------------------------


@query(f"""WITH {LINES} SELECT l_returnflag, l_linestatus, sum(quantity)::DOUBLE AS sum_qty, min(price)::DOUBLE AS min_price,
max(price)::DOUBLE AS max_price, count(*) AS n, round(avg(quantity::DOUBLE), 4) AS avg_qty FROM lines GROUP BY 1, 2""")
def grouped_aggregates(t: Tables) -> DataFrame:
    wide = t.lines.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("quantity", "price")})
    return wide.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("quantity").alias("sum_qty"), F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("quantity").cast("double")), 4).alias("avg_qty"))


@query("""SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1""")
def first_and_last_value(t: Tables) -> DataFrame:
    order = rank(t.orders, ["o_orderdate", "o_orderkey"])
    return t.orders.groupBy("o_custkey").agg(F.min_by("o_orderkey", order).alias("first_order"),
                                             F.max_by("o_orderkey", order).alias("last_order"))


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1")
def count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"),
                                               F.countDistinct("l_orderkey").alias("orders"))


CODES = [(f, s) for f in "ANR" for s in "FO"]
SUMS = ", ".join(
    f"sum(CASE WHEN l_returnflag = '{f}' AND l_linestatus = '{s}' THEN {c} ELSE 0 END)::DOUBLE AS {n}_{f.lower()}{s.lower()}"
    for f, s in CODES for c, n in (("price", "value"), ("quantity", "qty"), ("price * tax", "tax")))


@query(f"WITH {LINES} SELECT l_orderkey, l_linenumber, {SUMS} FROM lines GROUP BY 1, 2")
def wide_conditional_sums(t: Tables) -> DataFrame:
    measures = {
        f"{n}_{f.lower()}{s.lower()}": ((F.col("l_returnflag") == f) & (F.col("l_linestatus") == s), c)
        for f, s in CODES
        for c, n in ((F.col("price"), "value"), (F.col("quantity"), "qty"), (F.col("price") * F.col("tax"), "tax"))}
    return reshape.conditional_sums(t.lines, ["l_orderkey", "l_linenumber"], measures)


@query(f"""WITH {LINES} SELECT l_partkey, sum(quantity)::DOUBLE AS quantity FROM lines GROUP BY 1
HAVING sum(quantity) > 800""")
def having_filter(t: Tables) -> DataFrame:
    return t.lines.groupBy("l_partkey").agg(F.sum("quantity").alias("quantity")).where("quantity > 800")


@query(f"""WITH {LINES} SELECT l_partkey, l_suppkey, sum(price)::DOUBLE / nullif(sum(quantity), 0)::DOUBLE AS price
FROM lines GROUP BY 1, 2""")
def weighted_average_price(t: Tables) -> DataFrame:
    return weighted_price(t.lines, ["l_partkey", "l_suppkey"], "price", "quantity", "price")


@query(f"""WITH {LINES} SELECT l_orderkey, max(ship_date) FILTER (l_returnflag = 'A') AS last_a,
max(ship_date) FILTER (l_returnflag = 'R') AS last_r FROM lines GROUP BY 1""")
def conditional_max_date(t: Tables) -> DataFrame:
    last = lambda f: F.max(F.when(F.col("l_returnflag") == f, F.col("ship_date")))
    return t.lines.groupBy("l_orderkey").agg(last("A").alias("last_a"), last("R").alias("last_r"))


@query("""SELECT l_orderkey, bool_or(l_returnflag = 'A') AS has_a, max(CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS r_part
FROM lineitem GROUP BY 1""")
def code_list_flags(t: Tables) -> DataFrame:
    """What a rule over a collected list of codes needs, without collecting it."""
    flag = F.col("l_returnflag")
    return t.lineitem.groupBy("l_orderkey").agg(
        F.max(flag == "A").alias("has_a"), F.max(F.when(flag == "R", F.col("l_partkey"))).alias("r_part"))


@query("""SELECT conv_id, string_agg(role || ': ' || text, ' | ' ORDER BY turn, role || ': ' || text) AS dialogue
FROM conversations GROUP BY 1""")
def ordered_concatenation(t: Tables) -> DataFrame:
    return reshape.concat_rows(t.conversations, ["conv_id"], "turn", F.concat("role", F.lit(": "), "text"), " | ",
                               "dialogue")


@query(f"""WITH {SALES_ORDERS} SELECT o_custkey, {', '.join(
    f"sum(CASE WHEN o_orderpriority LIKE '{p}-%' THEN total ELSE 0 END)::DOUBLE AS p{p}" for p in range(1, 6))},
0::DOUBLE AS p6 FROM sales_orders GROUP BY 1""")
def pivot_declared_values(t: Tables) -> DataFrame:
    """A label no row carries still gets its column."""
    df = t.sales_orders.withColumn("p", F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1)))
    return reshape.pivot_sums(df, ["o_custkey"], "p", [f"p{i}" for i in range(1, 7)], {"total": F.sum("total")})


@query(f"""WITH {LINES} SELECT l_suppkey, {', '.join(
    f"coalesce(sum({c}) FILTER (l_returnflag = '{f}'), 0)::DOUBLE AS {f}_{n}"
    for f in 'ANR' for c, n in (('quantity', 'qty'), ('price', 'value'), ('price * discount', 'rebate')))}
FROM lines GROUP BY 1""")
def pivot_several_measures(t: Tables) -> DataFrame:
    return reshape.pivot_sums(t.lines, ["l_suppkey"], "l_returnflag", list("ANR"), {
        "qty": F.sum("quantity"), "value": F.sum("price"), "rebate": F.sum(F.col("price") * F.col("discount"))})


@query("""SELECT p_partkey, a.name, a.value FROM part, LATERAL (VALUES ('p_size', p_size::DOUBLE),
('p_retailprice', p_retailprice), ('brand_no', substr(p_brand, 7)::DOUBLE)) a(name, value)""")
def unpivot_columns(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", "p_size", "p_retailprice", F.substring("p_brand", 7, 9).alias("brand_no"))
    return reshape.unpivot(df, ["p_partkey"], cast="double")


@query("""WITH e AS (SELECT user_id, event_type, props, ts, event_id FROM events)
SELECT user_id, arg_min(props, (ts, event_id)) FILTER (event_type = 'signup') AS signup_props,
arg_min(props, (ts, event_id)) FILTER (event_type = 'purchase') AS purchase_props FROM e
WHERE event_type IN ('signup', 'purchase') GROUP BY 1""")
def attributes_to_columns(t: Tables) -> DataFrame:
    return reshape.attributes_to_columns(t.events, ["user_id"], "event_type", "props",
                                         {"signup": "signup_props", "purchase": "purchase_props"}, ["ts", "event_id"])


@query("""WITH m AS (SELECT o_orderpriority, year(o_orderdate) AS year, month(o_orderdate) AS month,
  sum(o_totalprice::DECIMAL(18,2)) AS total FROM orders GROUP BY 1, 2, 3),
g AS (SELECT p.o_orderpriority, p.year, n.month, p.year * 12 + n.month AS month_no, m.total FROM (SELECT DISTINCT o_orderpriority, year FROM m) p
  CROSS JOIN (SELECT unnest(range(1, 13)) AS month) n LEFT JOIN m ON m.o_orderpriority = p.o_orderpriority AND m.year = p.year AND m.month = n.month)
SELECT o_orderpriority, month_no, total::DOUBLE AS total FROM g WHERE month_no <= (SELECT max(month_no) FROM g WHERE total IS NOT NULL)""")
def cut_after_last_filled(t: Tables) -> DataFrame:
    """Sheets of whole years: the last year's months without any order go, empty ones before them stay."""
    dated = t.sales_orders.withColumns({"m": F.month("order_date").cast("string"), "year": F.year("order_date")})
    months, ids = [str(m) for m in range(1, 13)], ["o_orderpriority", "year"]
    wide = reshape.pivot_sums(dated, ids, "m", months, {"total": F.sum("total")}, fill=None)
    long = reshape.unpivot(wide, ids, months, "month", "total")
    long = long.select("o_orderpriority", (F.col("year") * 12 + F.col("month").cast("int")).alias("month_no"), "total")
    return reshape.until_last_filled(long, "month_no", "total")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, n FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
FROM lineitem) WHERE n > 1 AND l_returnflag <> 'N'""")
def repeated_groups(t: Tables) -> DataFrame:
    sized = windows.with_group_size(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"), ["l_orderkey", "l_linenumber"], "n")
    return sized.where("n > 1 AND l_returnflag <> 'N'").drop("l_returnflag")


@query("SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2")
def keys_only_grouping(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


# --- windows ------------------------------------------------------------------------------


@query(f"""WITH {SALES_ORDERS} SELECT o_orderkey, CASE WHEN rank() OVER (PARTITION BY o_custkey ORDER BY order_date, o_orderkey) = 1
THEN 1 ELSE 0 END AS first_order FROM sales_orders""")
def first_event_flag(t: Tables) -> DataFrame:
    return windows.first_event_flag(t.sales_orders, ["o_custkey"], ["order_date", "o_orderkey"], "first_order").select(
        "o_orderkey", "first_order")


@query(f"""WITH {SALES_ORDERS} SELECT o_orderkey, sum(total) OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey
ROWS UNBOUNDED PRECEDING)::DOUBLE AS running FROM sales_orders""")
def running_total(t: Tables) -> DataFrame:
    out = windows.running_sum(t.sales_orders, ["o_custkey"], ["-order_date", "o_orderkey"], {"running": "total"})
    return out.select("o_orderkey", "running")


@query(f"""WITH {SALES_ORDERS} SELECT o_orderkey, sum(total) OVER (PARTITION BY o_orderstatus ORDER BY order_date DESC, o_orderkey
ROWS UNBOUNDED PRECEDING)::DOUBLE AS running FROM sales_orders""")
def running_total_of_hot_keys(t: Tables) -> DataFrame:
    """Three keys hold all rows: totals are carried from block to block, only a block's rows are ordered together."""
    out = windows.running_sum(t.sales_orders, ["o_orderstatus"], ["-order_date", "o_orderkey"], {"running": "total"})
    return out.select("o_orderkey", "running")


@query(f"""WITH {SALES_ORDERS} SELECT o_orderkey, lag(total) OVER (PARTITION BY o_custkey ORDER BY order_date, o_orderkey)::DOUBLE
AS previous_total FROM sales_orders""")
def previous_value(t: Tables) -> DataFrame:
    return windows.previous(t.sales_orders, ["o_custkey"], ["order_date", "o_orderkey"], "total", "previous_total").select(
        "o_orderkey", "previous_total")


@query("""SELECT c_custkey, s.copy FROM customer, (SELECT unnest(range(1, 31)) AS copy) s""")
def numbered_copies(t: Tables) -> DataFrame:
    return windows.repeat_rows(t.customer.select("c_custkey"), 30, "copy")


@query(f"""WITH {SALES_ORDERS} SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM sales_orders""")
def count_over_partition(t: Tables) -> DataFrame:
    return windows.with_group_size(t.sales_orders.select("o_orderkey", "o_custkey"), ["o_custkey"], "n").drop("o_custkey")


@query(f"""WITH {SALES_ORDERS}, m AS (SELECT o_orderpriority, date_trunc('month', order_date)::DATE AS month, sum(total) AS total
  FROM sales_orders GROUP BY 1, 2), f AS (SELECT *, year(month) - (CASE WHEN month(month) < 4 THEN 1 ELSE 0 END) AS fy FROM m)
SELECT o_orderpriority, month, sum(total) OVER (PARTITION BY o_orderpriority ORDER BY month)::DOUBLE AS running,
sum(total) OVER (PARTITION BY o_orderpriority, fy ORDER BY month)::DOUBLE AS fiscal FROM f""")
def year_to_date(t: Tables) -> DataFrame:
    monthly = t.sales_orders.groupBy("o_orderpriority", F.trunc("order_date", "MM").alias("month")).agg(
        F.sum("total").alias("total"))
    out = windows.year_to_date(monthly, ["o_orderpriority"], "month", {"running": "total"})
    out = windows.year_to_date(out, ["o_orderpriority"], "month", {"fiscal": "total"}, fiscal_year("month"))
    return out.select("o_orderpriority", "month", "running", "fiscal")


@query("""SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rank() OVER (PARTITION BY l_orderkey, l_linenumber
ORDER BY l_partkey, l_suppkey) AS r FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem))
WHERE r = 1""".replace("SELECT * FROM", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM", 1))
def ranked_dedupe(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return windows.pick_row(df, ["l_orderkey", "l_linenumber"], [])


# --- sorts and set operations -------------------------------------------------------------


@query("SELECT c_custkey, c_nationkey, c_acctbal FROM customer ORDER BY c_nationkey, c_acctbal DESC, c_custkey")
def multi_key_sort(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_nationkey", "c_acctbal").orderBy(
        "c_nationkey", F.col("c_acctbal").desc(), "c_custkey")


@query("SELECT DISTINCT o_orderdate::DATE AS order_date FROM orders ORDER BY 1 DESC LIMIT 3")
def top_distinct(t: Tables) -> DataFrame:
    return windows.top_distinct(t.sales_orders, "order_date", 3)


@query("SELECT max(o_orderkey) AS top_key, arg_max(o_custkey, (o_totalprice, o_orderkey)) AS top_customer FROM orders")
def top_one(t: Tables) -> DataFrame:
    return t.orders.agg(F.max("o_orderkey").alias("top_key"),
                        F.max_by("o_custkey", F.struct("o_totalprice", "o_orderkey")).alias("top_customer"))


@query("""SELECT 'customer' AS party, c_custkey AS id, c_nationkey AS nation FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier""")
def union_by_name(t: Tables) -> DataFrame:
    c = t.customer.select(F.lit("customer").alias("party"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    s = t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("party"), F.col("s_suppkey").alias("id"))
    return c.unionByName(s)


PAIRS = "SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = "


@query(f"{PAIRS}'A' EXCEPT {PAIRS}'R'")
def subtract_distinct(t: Tables) -> DataFrame:
    side = lambda f: t.lineitem.where(F.col("l_returnflag") == f).select("l_partkey", "l_suppkey")
    return side("A").subtract(side("R"))


@query("""SELECT l_partkey, count(*) AS n FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'
EXCEPT ALL SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1""")
def subtract_all(t: Tables) -> DataFrame:
    side = lambda f: t.lineitem.where(F.col("l_returnflag") == f).select("l_partkey")
    return side("A").exceptAll(side("R")).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_rows(t: Tables) -> DataFrame:
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


# --- scalar functions ---------------------------------------------------------------------


@query("""SELECT p_partkey, trim(upper(p_name)) AS up, lower(p_type) AS low, p_brand || '-' || p_type AS joined,
concat_ws('/', p_brand, p_type, p_name) AS path, lpad(p_size::VARCHAR, 4, '0') AS l, rpad(p_size::VARCHAR, 4, '*') AS r,
reverse(p_brand) AS rev, split_part(p_name, ' ', 1) AS head, split_part(p_name, ' ', -1) AS tail,
regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits, length(p_name) AS len FROM part""")
def string_functions(t: Tables) -> DataFrame:
    c = F.col
    size = c("p_size").cast("string")
    return t.part.select(
        "p_partkey", F.trim(F.upper("p_name")).alias("up"), F.lower("p_type").alias("low"),
        F.concat("p_brand", F.lit("-"), "p_type").alias("joined"), F.concat_ws("/", "p_brand", "p_type", "p_name").alias("path"),
        F.lpad(size, 4, "0").alias("l"), F.rpad(size, 4, "*").alias("r"), F.reverse("p_brand").alias("rev"),
        F.split("p_name", " ").getItem(0).alias("head"), F.substring_index("p_name", " ", -1).alias("tail"),
        F.regexp_replace("p_brand", "[^0-9]", "").alias("digits"), F.length("p_name").alias("len"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS shown, (o_orderdate::DATE + 30)::DATE AS due,
(o_orderdate - INTERVAL 3 MONTH)::DATE AS back, last_day(o_orderdate)::DATE AS month_end,
date_diff('day', o_orderdate::DATE, DATE '2002-01-01') AS age, epoch(o_orderdate)::BIGINT AS seconds,
month(o_orderdate) AS m FROM orders""")
def date_functions(t: Tables) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy").alias("shown"), F.date_add(d, 30).alias("due"),
        F.add_months(d, -3).alias("back"), F.last_day(d).alias("month_end"),
        F.datediff(F.lit("2002-01-01").cast("date"), d).cast("long").alias("age"),
        (F.unix_date(d).cast("long") * 86400).alias("seconds"), F.month(d).cast("long").alias("m"))


@query("""SELECT c_custkey, abs(c_acctbal) AS size, round(c_acctbal::DECIMAL(18,2), 1)::DOUBLE AS rounded,
CASE WHEN c_acctbal < 0 THEN -1 WHEN c_custkey % 2 = 0 THEN 1 END AS sign, 100.0::DOUBLE / nullif(c_nationkey, 0)::DOUBLE AS share,
coalesce(nullif(c_nationkey, 0), 99) AS filled FROM customer""")
def math_and_null_functions(t: Tables) -> DataFrame:
    c = F.col
    return t.customer.select(
        "c_custkey", F.abs("c_acctbal").alias("size"),
        F.round(c("c_acctbal").cast("decimal(18,2)"), 1).alias("rounded"),
        by_code(F.when(c("c_acctbal") < 0, "debit").when(c("c_custkey") % 2 == 0, "credit"), ("credit",), ("debit",)).alias("sign"),
        ratio(F.lit(100), "c_nationkey").alias("share"),
        F.nvl(F.nullif("c_nationkey", F.lit(0)), F.lit(99)).alias("filled"))


@query("""SELECT p_partkey, w.word, w.pos FROM part, LATERAL (SELECT unnest(string_split(p_name, ' ')) AS word,
unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS pos) w""")
def array_functions(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "word")).withColumn(
        "pos", F.col("pos") + 1)


