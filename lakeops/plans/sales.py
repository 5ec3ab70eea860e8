"""Sales: pricing conditions, the invoice fact, sales types, first-time sales, open orders."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import first_match, is_blank, null_safe, ratio
from ..operators.joins import effective_dated, lookup, role_columns, semi
from ..operators.reshape import sum_when

# Fixed values of the pricing rules -----------------------------------------------------
FREIGHT_PAID_TERMS = ("ZFR", "FOR", "CIP")
FREIGHT_RATE_CODES = ("ZFRF", "ZDFR")
FREIGHT_BASE_CODE = "ZCNF"
DIRECT_GROUP = "17"
NET_OF_DUTY = "0.875"
LIST_PRICE = "ZBP4"
# Surcharges on the list price and where they apply: (code, sales org, divisions).
SURCHARGES = [
    ("ZAD1", "2000", ("23",)),
    ("ZADD", "2000", ("23",)),
    ("ZHED", "2000", ("23",)),
]
# Base price codes in order of preference; a code counts only in its org and divisions.
BASE_PRICES = [
    ("ZBP1", "1000", ("11",)),
    ("ZBCC", "1000", ("14",)),
    ("ZBRD", "1000", ("88",)),
    ("ZBPB", "2000", ("21", "22", "23", "24", "25")),
    ("ZAD1", "2000", ("23",)),
    ("ZADD", "2000", ("23",)),
    ("ZHED", "2000", ("23",)),
    ("ZTBM", "2000", ("88",)),
    ("ZBSP", "3000", ("31", "32", "33", "34", "35", "88")),
    ("ZBPS", None, ("99",)),
    ("ZEDP", "4000", ("41",)),
    ("ZSDP", "4000", ("42",)),
]


class Codes:
    """Pricing conditions of one group, read by code inside an aggregation.

    Where a code repeats in a group its largest value counts.
    """

    def __init__(self, code: str = "code"):
        self.code = F.col(code)

    def has(self, code: str, where: Column | None = None) -> Column:
        return F.coalesce(F.max(self._at(code, where)), F.lit(False))

    def value(self, code: str, column: str = "value", where: Column | None = None) -> Column:
        return F.max(F.when(self._at(code, where), F.col(column)))

    def _at(self, code: str, where: Column | None) -> Column:
        return self.code == code if where is None else (self.code == code) & where


def assessable_value(conditions: DataFrame, keys: list[str]) -> DataFrame:
    """The taxable value by priority over condition codes.

    Reads code, value, base, fx, customer_group; a code whose amount is null gives 0.
    """
    c = Codes()
    net = F.lit(NET_OF_DUTY).cast("decimal(4,3)")
    direct = F.col("customer_group") == DIRECT_GROUP
    rules = [
        (c.has("ZASS", direct), c.value("ZASS", where=direct)),
        (c.has("JEXP"), c.value("JEXP", "base")),
        (c.has("ZVAT"), c.value("ZVAT", "base") * net),
        (c.has("JCST"), c.value("JCST", "base") * net),
        (c.has("ZEXP"), c.value("ZEXP") * c.value("ZEXP", "fx")),
        (c.has("ZASS"), c.value("ZASS")),
    ]
    value = F.coalesce(first_match(rules).cast("decimal(25,2)"), F.lit(0).cast("decimal(25,2)"))
    return conditions.groupBy(*keys).agg(value.alias("assessable_value"))


def secondary_freight(conditions: DataFrame, keys: list[str]) -> DataFrame:
    """Freight rate times freight base, none where the terms say freight is paid.

    Reads code, value, rate, terms.
    """
    c = Codes()
    paid = F.coalesce(F.max(F.col("terms").isin(*FREIGHT_PAID_TERMS)), F.lit(False))
    rate = F.coalesce(*[c.value(code, "rate") for code in FREIGHT_RATE_CODES], F.lit(0))
    freight = F.when(~paid & c.has(FREIGHT_BASE_CODE), rate * c.value(FREIGHT_BASE_CODE))
    zero = F.lit(0).cast("decimal(25,2)")
    return conditions.groupBy(*keys).agg(
        F.coalesce(freight.cast("decimal(25,2)"), zero).alias("secondary_freight"))


def base_price(conditions: DataFrame, keys: list[str]) -> DataFrame:
    """List price plus its first surcharge, else the first base price code present.

    Reads code, value, org, division. The first code present decides, even where its org or
    division does not fit and its amount is therefore 0.
    """
    c = Codes()

    def amount(code, org, divisions):
        fits = F.col("division").isin(*divisions)
        if org is not None:
            fits = fits & (F.col("org") == org)
        return F.coalesce(c.value(code, where=fits), F.lit(0))

    surcharge = first_match([(c.has(code), amount(code, org, div)) for code, org, div in SURCHARGES], 0)
    other = first_match([(c.has(code), amount(code, org, div)) for code, org, div in BASE_PRICES], 0)
    price = F.when(c.has(LIST_PRICE), c.value(LIST_PRICE) + surcharge).otherwise(other)
    return conditions.groupBy(*keys).agg(
        F.coalesce(price.cast("decimal(25,2)"), F.lit(0).cast("decimal(25,2)")).alias("base_price"))


UNITS = "__units_of_"


@dataclass(frozen=True)
class Measure:
    """One conditional sum over the condition lines of an invoice line."""

    name: str
    codes: tuple[str, ...]
    column: str = "value"
    percent: bool = False
    negate: bool = False
    other_than: bool = False
    by: str = "code"
    times: str | None = None
    per: str | None = None
    not_billing: tuple[str, ...] = ()
    any_code: bool = False
    otherwise: str | None = None

    def hit(self) -> Column:
        by = F.col(self.by)
        hit = by.isNotNull() if self.any_code else by.isin(*self.codes)
        if self.other_than:
            hit = ~by.isin(*self.codes)
        if self.not_billing:
            hit = hit & ~F.col("billing_type").isin(*self.not_billing)
        return hit

    def in_units(self) -> Column:
        """The same sum over the column's smallest units, kept as a long (``UNITS`` + column)."""
        units = F.col(UNITS + self.column)
        if self.negate:
            units = -units
        if self.otherwise:
            total = F.sum(F.when(self.hit(), units).otherwise(F.col(UNITS + self.otherwise) * (10 if self.percent else 1)))
        else:
            total = sum_when(self.hit(), units)
        return total.alias(self.name)

    def from_units(self, scale: int) -> Column:
        """The decimal that a sum of ``in_units`` stands for; a sum of nothing, as most are, is no work."""
        scale += self.percent
        total = F.col(self.name)
        nothing = F.lit(0).cast(f"decimal({21 + max(scale, 1)},{scale})")
        return F.when(total == 0, nothing).otherwise(total.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale)))

    def expression(self) -> Column:
        hit = self.hit()
        amount = F.col(self.column)
        if self.percent:
            amount = amount * F.lit("0.1").cast("decimal(2,1)")
        if self.negate:
            amount = -amount
        if self.times:
            amount = amount * F.col(self.times)
        if self.per:
            amount = ratio(amount, self.per)
        if self.otherwise:
            return F.sum(F.when(hit, amount).otherwise(F.col(self.otherwise))).alias(self.name)
        return sum_when(hit, amount).alias(self.name)


def _rate(name: str, code: str, **kw) -> Measure:
    """Rates are recorded in tenths of a per cent."""
    return Measure(name, (code,), "rate", percent=True, **kw)


# The measures of an invoice line, as (name, codes and what is summed).
# "other_than" keeps the published sums that take every code but the named one.
INVOICE_MEASURES = [
    Measure("freight", ("ZF05",), other_than=True),
    Measure("trade_dis", ("ZTRD",), other_than=True),
    Measure("jkfc_dis", ("JKFC",), other_than=True),
    _rate("jkfc_rate", "JKFC", other_than=True),
    *[_rate(f"p_{code.lower()}", code, not_billing=("ZFOC",)) for code in
      ("JEXP", "ZETX", "JCST", "ZVAT", "ZGTA", "ZTCS", "ZETO", "ZSSC", "ZB01")],
    _rate("zrdf", "ZRDF", not_billing=("ZFOC",), otherwise="rate"),
    *[Measure(code.lower(), (code,), times="fx") for code in ("ZIFR", "ZPAK", "ZFOB", "ZCMP")],
    _rate("cgst_rate", "JOCG"), Measure("cgst_amnt", ("JOCG",)),
    _rate("sgst_rate", "JOSG"), Measure("sgst_amnt", ("JOSG",)),
    _rate("igst_rate", "JOIG"), Measure("igst_amnt", ("JOIG",)),
    _rate("ugst_rate", "JOUG"), Measure("ugst_amnt", ("JOUG",)),
    Measure("zf00", ("ZF00",)), Measure("frgt_zf02", ("ZF02",)), Measure("frgt_zf01", ("ZF01",)),
    Measure("zbpb_pu", ("ZBPB", "ZTBM"), per="quantity"),
    Measure("ztaxturn", (), by="condition_class", any_code=True),
    Measure("zbasfin", ("PRICE",), by="condition_class"),
    Measure("zmul", ("ZMUL",)), Measure("zins", ("ZINS",)), Measure("zmrp", ("ZMRP",)),
    *[Measure(code.lower(), (code,), negate=True) for code in ("ZD01", "ZD02", "ZD03")],
    *[Measure(code.lower(), (code,)) for code in
      ("ZD04", "ZD05", "ZOD1", "ZOD2", "ZOD4", "ZOD5", "ZOD6", "ZRPB", "ZRPC")],
]


def condition_measures(conditions: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """All conditional sums of a (document, line) in one aggregation."""
    sums, values = condition_sums(conditions, keys, measures)
    return sums.select(*keys, *[values[m.name].alias(m.name) for m in measures])


def condition_sums(conditions: DataFrame, keys: list[str], measures: list[Measure]) -> tuple[DataFrame, dict[str, Column]]:
    """The sums of ``condition_measures`` as they are best moved, and what makes each the value it stands for.

    A decimal of up to 18 digits is summed in its smallest units, which a long holds whatever the
    value: dozens of sums then need no decimal objects. A sum beyond a long fails the query.
    """
    scales = {f.name: f.dataType.scale for f in conditions.schema.fields
              if isinstance(f.dataType, T.DecimalType) and f.dataType.precision <= 18}
    plain = lambda m: not m.times and not m.per and m.column in scales and (
        not m.otherwise or scales.get(m.otherwise) == scales[m.column])
    used = {c for m in measures if plain(m) for c in (m.column, m.otherwise) if c}
    units = {UNITS + c: (F.col(c) * 10 ** scales[c]).cast("bigint") for c in sorted(used)}
    sums = conditions.withColumns(units).groupBy(*keys).agg(*[
        m.in_units() if plain(m) else m.expression() for m in measures])
    return sums, {m.name: m.from_units(scales[m.column]) if plain(m) else F.col(m.name) for m in measures}


# Fixed values: (customer groups, channel, product line) to sales type, first match wins.
# "same"/"other" tells whether the payer must be the sold-to party or must differ from it.
SALES_TYPES = [
    (("Y1", "Y2", "Y3", "Y4", "Y5"), "10", "PIPES & FITTINGS", None, "PROJECT"),
    (("Y1",), "50", None, None, "RETAIL"),
    (("Y2",), "60", None, None, "RETAIL"),
    (("Y3",), "70", None, None, "RETAIL"),
    (("Y6",), "90", "PIPES & FITTINGS", None, "EXPORTS"),
    (("Y7",), "10", "PIPES & FITTINGS", None, "P&F_OTHERS"),
    (("26",), "50", "WALL PUTTY", None, "RETAIL"),
    (("23",), "10", "WALL PUTTY", None, "PROJECT"),
    (None, "10", "AC SHEETS", None, "DIRECT/PROJECT"),
    (None, "20", "AC SHEETS", "other", "RETAILER"),
    (None, "20", "AC SHEETS", "same", "STOCKIST"),
    (None, "10", "NON AC SHEETS", None, "INSTITUTIONAL"),
    (None, "20", "NON AC SHEETS", None, "RETAIL"),
]


def sales_type(group: Column, channel: Column, product_line: Column, sold_to: Column, payer: Column,
               rules=SALES_TYPES, default: str = "OTHER") -> Column:
    out = []
    for groups, ch, line, party, label in rules:
        hit = channel == ch
        if groups:
            hit = hit & group.isin(*groups)
        if line:
            hit = hit & (product_line == line)
        if party:
            hit = hit & ((sold_to == payer) if party == "same" else (sold_to != payer))
        out.append((hit, label))
    return first_match(out, default)


def sales_value(product_line: Column, rules: list[tuple[tuple[str, ...], Column]], default=0) -> Column:
    """Which measure counts as sales, by product line: (lines, measure) rules, first match wins."""
    return first_match([(product_line.isin(*lines), measure) for lines, measure in rules], default)


def total_freight(org: Column, header: Column, secondary: Column, parts: list[Column], net_orgs: tuple[str, ...],
                  sum_orgs: tuple[str, ...]) -> Column:
    """Header freight less secondary freight, or the sum of parts, by sales organisation."""
    added = parts[0]
    for p in parts[1:]:
        added = added + p
    return first_match([(org.isin(*net_orgs), header - secondary), (org.isin(*sum_orgs), added)], 0)


def invoice_status(cancelled: str | Column) -> Column:
    return F.when(is_blank(cancelled), F.lit("BILLED")).otherwise(F.lit("CANCELLED"))


def transport_type(is_plant: Column, org: Column, plant: Column, report_plant: Column,
                   direct_orgs: tuple[str, ...]) -> Column:
    """A plant of a direct organisation that reports to another one still ships as a plant."""
    return first_match([
        (org.isin(*direct_orgs) & (plant != report_plant), "PLANT TO CUSTOMER"),
        (is_plant == 1, "PLANT TO CUSTOMER"),
        (is_plant == 0, "DEPOT TO CUSTOMER"),
    ])


def first_sale_flags(lines: DataFrame, flags: dict[str, list[str]], order: list[str],
                     history: DataFrame | None = None) -> DataFrame:
    """First line per customer, product line, pair ...; 0 where history already has the key.

    ``order`` must end in the columns that identify a line. One pass over lines and history
    with a grouping set per flag finds the first line of every key; the few lines found are
    then matched back on their whole identity, which spreads them evenly.
    """
    keys = list(dict.fromkeys(k for cols in flags.values() for k in cols))
    columns = [*order, *[k for k in keys if k not in order]]
    marked = lines.select(*columns, F.lit(False).alias("__old"))
    if history is not None:
        marked = marked.unionByName(history.select(*columns, F.lit(True).alias("__old")))
    line = F.struct(*[F.col(c).alias(f"__{c}") for c in columns])
    marked = marked.select(*keys, "__old", F.when(~F.col("__old"), line).alias("__line"))
    ids = {flag: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in cols)
           for flag, cols in flags.items()}
    firsts = marked.groupingSets([[F.col(k) for k in cols] for cols in flags.values()], *keys).agg(
        F.min("__line").alias("__line"), F.max("__old").alias("__seen"), F.grouping_id(*keys).alias("__set"))
    firsts = firsts.where(~F.col("__seen") & F.col("__line").isNotNull()).select("__line.*", "__set")
    marks = firsts.groupBy(*[f"__{c}" for c in columns]).agg(
        *[F.max(F.when(F.col("__set") == id_, 1).otherwise(0)).alias(flag) for flag, id_ in ids.items()])
    out = lookup(lines, marks, [(c, f"__{c}") for c in columns], list(flags), null_safe=True)
    return out.fillna(0, subset=list(flags))


def first_day_flags(lines: DataFrame, flags: dict[str, list[str]], date: str) -> DataFrame:
    """Every line on the key's first date is flagged; lines without a date are so where their key has no date.

    One pass over the lines with a grouping set per flag finds the first dates of all keys.
    """
    keys = list(dict.fromkeys(k for cols in flags.values() for k in cols))
    ids = {flag: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in cols) for flag, cols in flags.items()}
    sets = {ids[flag]: cols for flag, cols in flags.items()}
    firsts = lines.groupingSets([[F.col(k) for k in cols] for cols in sets.values()], *keys).agg(
        F.min(date).alias("__first"), F.grouping_id(*keys).alias("__set"))
    for flag, cols in flags.items():
        own = firsts.where(F.col("__set") == ids[flag]).select(*cols, "__first", F.lit(1).alias("__hit"))
        lines = lookup(lines.drop(flag), own, [*cols, (date, "__first")], [("__hit", flag)], null_safe=True)
        lines = lines.withColumn(flag, F.coalesce(flag, F.lit(0)))
    return lines


def invoice_fact(items: DataFrame, headers: DataFrame, partners: DataFrame, roles: dict[str, str],
                 conditions: DataFrame, measures: list[Measure], weights: DataFrame,
                 plants: DataFrame, weight_keys: tuple[str, ...] = ("material", "plant"),
                 documents: tuple[DataFrame, DataFrame, DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row per invoice line.

    items: doc, line, material, plant, quantity, net, tax; headers: doc, date, sold_to, payer,
    org, cancelled; partners: doc, role, party; conditions: doc, line, code ...;
    weights: weight_keys, valid_from, valid_to, weight; plants: plant, is_plant, report_plant;
    documents: accounting, ledger, excise and order_lines of ``with_postings`` and ``with_line_documents``.

    What is moved is written to disk, so lines lie by their document and stay there. Only what plants
    and weights are looked up by leaves it, once for all lines of a document that have it in common,
    and comes back with what was found. Inputs that lie by document, in tables of
    ``sinks.write_bucketed`` or after one exchange, are aggregated and joined where they lie; the
    postings have another key. What has one row per document meets the headers before the lines.
    """
    wanted = list(dict.fromkeys([*weight_keys, "plant", "date"]))
    dates = headers.select("doc", "date").distinct()
    found = items.join(dates, "doc", "inner").select("doc", *wanted).distinct()
    found = effective_dated(found, weights, list(weight_keys), "date", "valid_from", "valid_to", ["weight"])
    found = lookup(found, plants, ["plant"], ["is_plant", "report_plant"])
    parties = role_columns(partners, ["doc"], "role", roles, ["party"])
    heads = lookup(headers, parties, ["doc"], [f"{p}_party" for p in roles.values()])
    if documents is not None:
        heads = with_postings(heads, *documents[:2])
    out = items.join(heads, "doc", "inner")
    found = found.withColumnsRenamed({c: f"__w_{c}" for c in wanted})
    met = out.join(found, [out["doc"] == found["doc"], null_safe([out[c] for c in wanted], [found[f"__w_{c}"] for c in wanted])], "left")
    out = met.select(*[out[c] for c in out.columns], "is_plant", "report_plant", "weight")
    if documents is not None:
        out = with_line_documents(out, *documents[2:])
    sums, values = condition_sums(conditions, ["doc", "line"], measures)
    out = lookup(out, sums, ["doc", "line"], [m.name for m in measures])
    return out.withColumns({
        **{m.name: F.coalesce(values[m.name], F.lit(0)) for m in measures},
        "total": F.col("net") + F.col("tax"),
        "weight_mt": F.col("quantity") * F.col("weight") / 1000,
        "status": invoice_status("cancelled"),
        "customer_type": first_match(
            [(F.col("sold_to") != F.col("payer"), "Sub Dealer")], "Direct"),
    })


def with_postings(lines: DataFrame, accounting: DataFrame, ledger: DataFrame) -> DataFrame:
    """Invoice lines with the accounting document of their invoice and its business place.

    accounting: doc, company, document, year (of the types that post invoices), of which the least
    document counts; ledger: company, document, year, item, place, of which item 1 counts.
    """
    posted = accounting.groupBy("doc").agg(F.min(F.struct("document", "company", "year")).alias("__p")).select("doc", "__p.*")
    # The ledger does not know the invoice, so the postings meet it by its own key first.
    places = ledger.where("item = 1").groupBy("company", "document", "year").agg(F.min("place").alias("place"))
    posted = lookup(posted, places, ["company", "document", "year"], [("place", "business_place")])
    return lookup(lines, posted, ["doc"], [("document", "account_document"), "company", "year", "business_place"])


def with_line_documents(lines: DataFrame, excise: DataFrame, order_lines: DataFrame) -> DataFrame:
    """Invoice lines with their excise document and sales order line.

    lines: doc, line, and order, order_line, without which the line is its own order line; excise:
    ref_doc, ref_line, number, date, of which the first number counts; order_lines: order,
    order_line, route, order_date. Excise documents are brought to one row per line first, so
    they do not multiply lines.
    """
    by_order = ["order", "order_line"] if "order" in lines.columns else ["doc", "line"]
    first = excise.groupBy("ref_doc", "ref_line").agg(F.min(F.struct("number", "date")).alias("__e")).select(
        "ref_doc", "ref_line", F.col("__e.number").alias("excise_number"), F.col("__e.date").alias("excise_date"))
    out = lookup(lines, first, [("doc", "ref_doc"), ("line", "ref_line")], ["excise_number", "excise_date"])
    return lookup(out, order_lines, list(zip(by_order, ["order", "order_line"])), ["route", "order_date"])


def open_orders(lines: DataFrame, deliveries: DataFrame, from_date: str, to_date: str, keys: list[str]) -> DataFrame:
    """What is still to deliver on recent order lines, split by credit status.

    lines: keys, date, quantity, value, credit_status, rejection; deliveries: keys, delivered.
    Status C is pending; A or none is released.
    """
    recent = lines.where(F.col("date").between(F.lit(from_date).cast("date"), F.lit(to_date).cast("date")))
    shipped = semi(deliveries, recent, keys).groupBy(*keys).agg(F.sum("delivered").alias("delivered"))
    out = lookup(recent, shipped, keys, ["delivered"])
    delivered = F.coalesce(F.col("delivered"), F.lit(0))
    balance = F.col("quantity") - delivered
    out = out.withColumns({"delivered": delivered, "balance_quantity": balance})
    out = out.withColumn("balance_value", ratio(F.col("value") * F.col("balance_quantity"), "quantity"))
    pending = F.col("credit_status") == "C"
    released = F.col("credit_status").isNull() | (F.col("credit_status") == "A")
    take = lambda cond, c: F.when(cond, F.col(c)).otherwise(F.lit(0))
    return out.where("balance_quantity <> 0").withColumns({
        "status": F.when(pending, F.lit("pending")).when(released, F.lit("released")),
        "pending_quantity": take(pending, "balance_quantity"),
        "released_quantity": take(released, "balance_quantity"),
        "pending_value": take(pending, "balance_value"),
        "released_value": take(released, "balance_value"),
    })


def star_fact(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Sales joined to its dimensions with a date key and the sales amount."""
    out = sales.join(customers, "customer_id", "inner").join(products, "product_id", "inner")
    return out.withColumns({
        "date_key": F.date_format("order_date", "yyyyMMdd").cast("int"),
        "sales_amount": (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)"),
    })


def order_intake(orders: DataFrame, factors: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered quantity in the reporting unit per key."""
    out = lookup(orders, factors, ["material"], ["numerator", "denominator"])
    converted = ratio(F.col("quantity") * F.col("numerator"), "denominator")
    return out.withColumn("converted", converted).groupBy(*keys).agg(F.sum("converted").alias("order_quantity"))


