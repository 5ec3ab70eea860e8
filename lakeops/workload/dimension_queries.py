"""Dimension builders and row-level security on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import first_match, pad_id
from ..operators.ingest import ColumnMeta
from ..operators.joins import lookup
from ..plans import dims as d, security as sec
from ..plans.stock import plant_kind
from .core import LINES, SALES_ORDERS, Tables, query

NUM = lambda key: f"substr(md5({key}), 1, 3)"


@query(f"""WITH src AS (SELECT DISTINCT source FROM documents WHERE lang = 'en'), keyed AS (SELECT source, row_number() OVER (ORDER BY {NUM('source')}, source) AS source_key FROM src)
SELECT doc_id AS document_id, source AS document_source, source_key FROM documents JOIN keyed USING (source) WHERE lang = 'en'""")
def text_dimension(t: Tables) -> DataFrame:
    meta = [ColumnMeta("doc_id", "DOC", "bigint", "document_id"), ColumnMeta("source", "SRC", "string", "document_source"),
            ColumnMeta("n_chars", "LEN", "bigint", "")]
    empty = t.documents.where("false").select(F.col("source").alias("document_source"), F.lit(0).cast("long").alias("source_key"))
    return d.text_dimension(t.documents, "en", meta, empty, ["document_source"], "source_key")


@query("""WITH p AS (SELECT s_suppkey AS plant, s_name AS name, s_nationkey AS region, (s_suppkey * 7)::VARCHAR AS postcode FROM supplier)
SELECT p.plant, p.name, p.region, CASE WHEN p.plant % 10 = 0 THEN 'P' || p.plant ELSE p.postcode END AS postcode, CASE WHEN p.plant % 3 = 0 THEN p.plant // 3 ELSE p.plant END AS report_plant,
r.name AS report_plant_name, n_name AS region_name, CASE WHEN p.plant = 44 THEN 1 WHEN substr(p.plant::VARCHAR, 1, 1) = '2' AND p.region > 5 THEN 1
WHEN substr(p.plant::VARCHAR, 1, 1) IN ('3', '4', '5', '6', '7', '9') THEN 0 ELSE 3 END AS is_plant
FROM p LEFT JOIN p r ON r.plant = CASE WHEN p.plant % 3 = 0 THEN p.plant // 3 ELSE p.plant END LEFT JOIN nation ON n_nationkey = p.region""")
def plant_dimension(t: Tables) -> DataFrame:
    c = F.col
    plants = t.supplier.select(c("s_suppkey").alias("plant"), c("s_name").alias("name"), c("s_nationkey").alias("region"),
                               (c("s_suppkey") * 7).cast("string").alias("postcode"))
    reporting = t.supplier.where("s_suppkey % 3 = 0").select(c("s_suppkey").alias("depot"), (c("s_suppkey") / 3).cast("long").alias("report_plant"))
    regions = t.nation.select(c("n_nationkey").alias("region"), c("n_name").alias("region_name"))
    postcodes = t.supplier.where("s_suppkey % 10 = 0").select(c("s_suppkey").alias("plant"), F.concat(F.lit("P"), c("s_suppkey").cast("string")).alias("postcode"))
    kind = plant_kind(c("plant"), ("2",), ("3", "4", "5", "6", "7", "9"), c("region") > 5, ("44",))
    return d.plant_dimension(plants, reporting, regions, kind, postcodes)


@query(f"""WITH {SALES_ORDERS}, a AS (SELECT o_custkey AS customer, min(o_orderstatus) AS division, min(o_orderpriority) AS office FROM sales_orders WHERE o_custkey % 10 <> 0 GROUP BY 1)
SELECT c_custkey AS customer, c_name AS name, coalesce(a.division, '-1') AS division, a.office, CASE WHEN a.office <> '5-LOW' THEN 'Office ' || a.office END AS office_name,
CASE WHEN c_custkey % 4 = 0 THEN c_custkey // 4 ELSE c_custkey END AS "group", CASE WHEN a.office = '1-URGENT' THEN 'EXPORTS' WHEN a.office LIKE '%HIGH%' THEN 'PROJECT'
WHEN a.office LIKE '%MEDIUM%' THEN 'RETAIL' ELSE '<DEFAULT>' END AS sales_type FROM customer LEFT JOIN a ON a.customer = c_custkey""")
def customer_dimension(t: Tables) -> DataFrame:
    c = F.col
    customers = t.customer.select(c("c_custkey").alias("customer"), c("c_name").alias("name"))
    # Every tenth customer has no sales area, so that the default division is met.
    areas = t.orders.where("o_custkey % 10 <> 0").select(c("o_custkey").alias("customer"), c("o_orderstatus").alias("division"), c("o_orderpriority").alias("office"))
    offices = t.orders.where("o_orderpriority <> '5-LOW'").select(c("o_orderpriority").alias("office"), F.concat(F.lit("Office "), "o_orderpriority").alias("office_name")).distinct()
    groups = t.customer.where("c_custkey % 4 = 0").select(c("c_custkey").alias("customer"), (c("c_custkey") / 4).cast("long").alias("group"))
    return d.customer_dimension(customers, areas, offices, groups, [("%URGENT%", "EXPORTS"), ("%HIGH%", "PROJECT"), ("%MEDIUM%", "RETAIL")])


@query("""WITH a AS (SELECT p_partkey AS product, p_brand AS brand, split_part(p_name, ' ', 1) AS colour, split_part(p_name, ' ', 2) AS form FROM part),
b AS (SELECT p_brand AS brand, count(*) AS brand_parts FROM part GROUP BY 1), f AS (SELECT split_part(p_name, ' ', 2) AS form, max(p_size) AS form_size FROM part GROUP BY 1)
SELECT p.p_partkey AS product, p.p_type AS type, a.brand, a.colour, a.form, b.brand_parts, f.form_size,
CASE WHEN p.p_type = 'PROMO' THEN 'TRADED' WHEN a.colour = 'small' THEN 'SMALL GOODS' ELSE 'MANUFACTURED' END AS classification
FROM part p JOIN a ON a.product = p.p_partkey JOIN b USING (brand) JOIN f USING (form)""")
def product_dimension(t: Tables) -> DataFrame:
    c = F.col
    words = F.split("p_name", " ")
    pairs = F.array(*[F.struct(F.lit(n).alias("attribute"), v.alias("value"), F.lit(i).alias("position")) for i, (n, v) in enumerate((
        ("BRAND", c("p_brand")), ("COLOUR", words.getItem(0)), ("FORM", words.getItem(1)), ("BRAND", F.lit("later")), ("UNUSED", F.lit("x"))))])
    attributes = t.part.select(c("p_partkey").alias("product"), F.inline(pairs))
    brands = t.part.groupBy(c("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("brand_parts"))
    forms = t.part.groupBy(F.split("p_name", " ").getItem(1).alias("form")).agg(F.max("p_size").alias("form_size"))
    kind = first_match([(c("type") == "PROMO", "TRADED"), (c("colour") == "small", "SMALL GOODS")], "MANUFACTURED")
    return d.product_dimension(t.part.select(c("p_partkey").alias("product"), c("p_type").alias("type")), attributes,
                               {"BRAND": "brand", "COLOUR": "colour", "FORM": "form"}, ["position"],
                               [(brands, "brand", ["brand_parts"]), (forms, "form", ["form_size"])], kind)


TERR = """t AS (SELECT c_mktsegment AS product_line, 'RETAIL' AS sale_type, 'C' || c_custkey AS pincode, n_name AS state, nullif(r_name, 'ASIA') AS zone FROM customer
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


def territory(t: Tables) -> DataFrame:
    c = F.col
    scope = [c("c_mktsegment").alias("product_line"), F.lit("RETAIL").alias("sale_type")]
    link = lambda kind, unit, parent: [*scope, F.lit(kind).alias("unit_type"), unit.alias("unit"), parent.alias("parent")]
    places = lookup(t.nation, t.region, [("n_regionkey", "r_regionkey")], ["r_name"], how="inner")
    full = lookup(t.customer, places, [("c_nationkey", "n_nationkey")], ["n_name", "r_name"], how="inner")
    pins = full.select(*link("Pincode", F.concat(F.lit("C"), c("c_custkey").cast("string")), c("n_name")))
    states = full.where("r_name <> 'ASIA'").select(*link("STATE", c("n_name"), c("r_name"))).distinct()
    return d.territory_dimension(pins.unionByName(states), ["product_line", "sale_type"], ["pincode", "state", "zone"])


@query(f"""WITH {TERR} SELECT product_line, sale_type, pincode, state, coalesce(zone, '<DEFAULT>') AS zone, pincode AS pincode_txt, state AS state_txt, zone AS zone_txt,
product_line || '_' || state || '_' || sale_type AS access FROM t""")
def territory_dimension(t: Tables) -> DataFrame:
    return territory(t)


@query("""SELECT user_id, event_id, event_type, ts::DATE AS day FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_person(t: Tables) -> DataFrame:
    return d.latest_person(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", "ts").select(
        "user_id", "event_id", "event_type", F.col("ts").cast("date").alias("day"))


@query("""SELECT doc_id, source, upper(source) AS group_name FROM documents WHERE lang = 'en'""")
def vendor_dimension(t: Tables) -> DataFrame:
    vendors = t.documents.select("doc_id", "lang", "source", F.col("source").alias("account_group"))
    groups = t.documents.select(F.col("source").alias("account_group"), "lang", F.upper("source").alias("group_name")).distinct()
    return d.vendor_dimension(vendors, groups, "en").select("doc_id", "source", "group_name")


@query(f"""WITH {LINES} SELECT l_orderkey, sum(quantity)::DOUBLE AS quantity, min(ship_date) AS ship_date FROM lines GROUP BY 1""")
def order_dimension(t: Tables) -> DataFrame:
    return d.order_dimension(t.lines, "l_orderkey", "quantity", "ship_date")


@query("""WITH grants AS (SELECT DISTINCT 'G' || n_regionkey AS grp, n_name AS geo FROM nation WHERE n_regionkey < 4)
SELECT c.c_custkey AS "user", 'G' || (c.c_custkey % 5) AS "group", g.geo FROM customer c LEFT JOIN grants g ON g.grp = 'G' || (c.c_custkey % 5)""")
def user_grants(t: Tables) -> DataFrame:
    group = lambda c: F.concat(F.lit("G"), c.cast("string")).alias("group")
    members = t.customer.select(F.col("c_custkey").alias("user"), group(F.col("c_custkey") % 5))
    grants = t.nation.where("n_regionkey < 4").select(group(F.col("n_regionkey")), F.col("n_name").alias("geo")).distinct()
    return sec.user_grants(members, grants)


GRANTS = """g AS (SELECT c_custkey AS usr, CASE c_custkey % 4 WHEN 0 THEN 'STATE' WHEN 1 THEN 'ZONE' WHEN 2 THEN 'GLOBAL' ELSE 'STATE' END AS lvl,
  CASE c_custkey % 4 WHEN 1 THEN r_name ELSE n_name END AS unit, CASE c_custkey % 4 WHEN 3 THEN 'OTHERS' ELSE c_mktsegment END AS line
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


@query(f"""WITH {TERR}, {GRANTS}, p AS (SELECT DISTINCT product_line, state, coalesce(zone, '<DEFAULT>') AS zone FROM t)
SELECT DISTINCT usr AS "user", g.line AS product_line, 'RETAIL' AS sale_type, p.product_line || '_' || p.state || '_RETAIL' AS access FROM g JOIN p ON p.product_line = g.line
  AND (lvl = 'GLOBAL' OR (lvl = 'STATE' AND p.state = unit) OR (lvl = 'ZONE' AND p.zone = unit))
UNION ALL SELECT usr, 'OTHERS', 'RETAIL', NULL FROM g WHERE line = 'OTHERS'""")
def sales_access_map(t: Tables) -> DataFrame:
    places = lookup(t.nation, t.region, [("n_regionkey", "r_regionkey")], ["r_name"], how="inner")
    full = lookup(t.customer, places, [("c_nationkey", "n_nationkey")], ["n_name", "r_name"], how="inner")
    rest = F.col("c_custkey") % 4
    grants = full.select(
        F.col("c_custkey").alias("user"), F.when(rest == 1, F.lower("r_name")).otherwise(F.col("n_name")).alias("geo_unit"),
        F.when(rest == 1, "zone").when(rest == 2, "Global").otherwise("State").alias("geo_unit_type"),
        F.when(rest == 3, "Others").otherwise(F.col("c_mktsegment")).alias("product_line"), F.lit("retail").alias("sale_type"))
    return sec.expand_sales_grants(grants, territory(t))


@query("""SELECT s.s_suppkey AS service, s.s_name AS description, n.n_name AS material_group, CASE WHEN s.s_nationkey % 2 = 0 THEN r.r_name END AS valuation_class
FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def service_dimension(t: Tables) -> DataFrame:
    """Services with two texts: only even groups have a valuation class."""
    c = F.col
    members = lookup(t.supplier, t.nation, [("s_nationkey", "n_nationkey")], ["n_regionkey"]).select(
        c("s_suppkey").alias("service"), c("s_name").alias("description"), c("s_nationkey").alias("group"),
        F.when(c("s_nationkey") % 2 == 0, c("n_regionkey")).alias("class"))
    groups = t.nation.select(c("n_nationkey").alias("group"), c("n_name").alias("text"))
    classes = t.region.select(c("r_regionkey").alias("class"), c("r_name").alias("text"))
    known = members.where("service % 2 = 0").select("service", c("service").alias("service_key"))
    out = d.keyed_with_texts(members, [(groups, "group", "text", "material_group"), (classes, "class", "text", "valuation_class")],
                             ["service"], known, "service_key")
    return out.select("service", "description", "material_group", "valuation_class")


@query("""SELECT l_partkey AS chapter, changed_on, n, min(changed_on) OVER (PARTITION BY l_partkey) AS created_date
FROM (SELECT l_partkey, l_shipdate::DATE AS changed_on, count(*) AS n FROM lineitem GROUP BY 1, 2)""")
def chapter_dimension(t: Tables) -> DataFrame:
    versions = t.lineitem.groupBy(F.col("l_partkey").alias("chapter"), F.col("l_shipdate").cast("date").alias("changed_on")).agg(
        F.count(F.lit(1)).alias("n"))
    return d.with_created_date(versions, "chapter", "changed_on")


@query("""SELECT lpad(c_custkey::VARCHAR, 10, '0') AS gl_code, c_name AS name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment || ' text' END AS group_text
FROM customer""")
def ledger_account_dimension(t: Tables) -> DataFrame:
    """Ledger accounts: padded codes, a text per group in one language; one group has none."""
    c = F.col
    members = t.customer.select(pad_id("c_custkey", 10).alias("gl_code"), c("c_name").alias("name"), c("c_mktsegment").alias("group"))
    texts = t.customer.select(c("c_mktsegment").alias("group"), F.concat("c_mktsegment", F.lit(" text")).alias("text"),
                              F.when(c("c_mktsegment") == "BUILDING", "D").otherwise("E").alias("lang"))
    none = members.limit(0).select("gl_code", F.lit(0).alias("gl_key"))
    out = d.keyed_with_texts(members, [(texts, "group", "text", "group_text")], ["gl_code"], none, "gl_key", "E")
    return out.select("gl_code", "name", "group_text")


_TEXTS = {"storage_location": "A", "defect": "N", "characteristic": "R"}


@query("""SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 'storage_location' WHEN 'N' THEN 'defect' ELSE 'characteristic' END AS kind,
l_suppkey || '-' || l_linenumber AS code, 'text ' || l_linenumber AS name FROM lineitem WHERE l_linestatus = 'F'""")
def code_text_dimensions(t: Tables) -> DataFrame:
    """Storage locations, defects and inspection characteristics: codes with their text in one language, each keyed."""
    c = F.col
    out = []
    for kind, flag in _TEXTS.items():
        texts = t.lineitem.where(c("l_returnflag") == flag).select(
            F.concat(c("l_suppkey").cast("string"), F.lit("-"), c("l_linenumber").cast("string")).alias("CODE"),
            F.concat(F.lit("text "), c("l_linenumber").cast("string")).alias("TXT"), c("l_linestatus").alias("lang")).distinct()
        meta = [ColumnMeta("CODE", "code", processed="code"), ColumnMeta("TXT", "name", processed="name")]
        none = texts.limit(0).select(c("CODE").alias("code"), F.lit(0).alias("key"))
        keyed = d.text_dimension(texts, "F", meta, none, ["code"], "key")
        out.append(keyed.select(F.lit(kind).alias("kind"), "code", "name"))
    return out[0].unionByName(out[1]).unionByName(out[2])
