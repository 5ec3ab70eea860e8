"""Procurement: order status, requisitions, vendors, change logs, imports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_col, first_match, is_blank, strip_zeros
from ..functions.ordering import rank
from ..operators.joins import anti, lookup, period_key, semi
from ..operators.reshape import conditional_sums, quarter_budgets

# Movement codes of goods receipts and their reversals, status flags.
RECEIPTS = ("101", "123")
RECEIPT_REVERSALS = ("102", "122")
ACTUAL_RECEIPT = ("101",)
COMPLETE = "X"
SHORT_CLOSE = "S"


def received(history: DataFrame, keys: list[str]) -> DataFrame:
    """Delivered and invoiced quantity and value, and the last receipt date, in one pass.

    history: keys, kind ('receipt', 'invoice', 'down_payment'), move_type, dc, quantity, amount, date.
    """
    receipt, invoice = F.col("kind") == "receipt", F.col("kind") == "invoice"
    sign = first_match([
        (receipt & F.col("move_type").isin(*RECEIPTS), 1),
        (receipt & F.col("move_type").isin(*RECEIPT_REVERSALS), -1),
        (invoice & (F.col("dc") == "S"), 1), (invoice & (F.col("dc") == "H"), -1)], 0)
    part = lambda cond, c: F.sum(F.when(cond, F.col(c) * sign).otherwise(F.lit(0)))
    return history.groupBy(*keys).agg(
        part(receipt, "quantity").alias("delivered_quantity"), part(receipt, "amount").alias("delivered_value"),
        part(invoice, "quantity").alias("invoiced_quantity"), part(invoice, "amount").alias("invoiced_value"),
        F.sum(F.when(F.col("kind") == "down_payment", F.col("amount")).otherwise(F.lit(0))).alias("down_payment"),
        F.max(F.when(receipt & F.col("move_type").isin(*ACTUAL_RECEIPT), F.col("date"))).alias("delivery_date"))


def release_dates(schedule: DataFrame, requisitions: DataFrame, keys: list[str]) -> DataFrame:
    """Latest release date of the requisitions behind each order line's schedule lines.

    schedule: keys, requisition, requisition_item; requisitions: requisition,
    requisition_item, release_date, deleted; deleted ones do not count.
    """
    open_ones = requisitions.where(F.col("deleted").isNull() | (F.col("deleted") != "L"))
    # Nearly every row has a key of its own: moved first, no task holds all keys of its part of the input.
    open_ones = open_ones.select("requisition", "requisition_item", "release_date").repartition("requisition", "requisition_item")
    latest = open_ones.groupBy("requisition", "requisition_item").agg(F.max("release_date").alias("release_date"))
    out = lookup(schedule, latest, ["requisition", "requisition_item"], ["release_date"])
    return out.groupBy(*keys).agg(F.max("release_date").alias("release_date"))


def service_totals(orders: DataFrame, packages: DataFrame, keys: list[str]) -> DataFrame:
    """Quantity and value of service orders, found two package hops down.

    packages: package, sub_package, quantity, value.
    """
    first = lookup(orders.select(*keys, "package"), packages, ["package"], [("sub_package", "__sub")])
    second = lookup(first, packages, [("__sub", "package")], ["quantity", "value"])
    return second.groupBy(*keys).agg(
        F.sum("quantity").alias("service_quantity"), F.sum("value").alias("service_value"))


def open_purchase_orders(orders: DataFrame, history: DataFrame, keys: list[str],
                         packages: DataFrame | None = None, unplanned: tuple[str, ...] = (),
                         planned: tuple[str, ...] = ()) -> DataFrame:
    """Order lines with what is still to deliver and to invoice and their status.

    orders: keys, quantity, value, under_pct, over_pct, complete, and for service orders
    po_type, package, deleted. OPEN below tolerance, SHORT_CLOSED when completed below
    tolerance, CLOSED otherwise; service orders are judged by their package totals.
    """
    sums = ["delivered_quantity", "delivered_value", "invoiced_quantity", "invoiced_value", "down_payment"]
    out = lookup(orders, received(history, keys), keys, [*sums, "delivery_date"])
    out = out.fillna(0, subset=sums)
    out = out.withColumns({
        "under_tolerance": F.col("under_pct") * F.col("quantity") / 100,
        "over_tolerance": F.col("over_pct") * F.col("quantity") / 100,
        "to_deliver_quantity": F.col("quantity") - F.col("delivered_quantity"),
        "to_deliver_value": F.col("value") - F.col("delivered_value"),
        "to_invoice_quantity": F.col("delivered_quantity") - F.col("invoiced_quantity"),
        "to_invoice_value": F.col("delivered_value") - F.col("invoiced_value"),
    })
    done = F.coalesce(F.col("complete") == COMPLETE, F.lit(False))
    short = F.col("delivered_quantity") < F.col("quantity") - F.col("under_tolerance")
    rules = [(~done & short, "OPEN"), (done & short, "SHORT_CLOSED")]
    if packages is not None:
        kinds = (*unplanned, *planned)
        services = orders.where(F.col("po_type").isin(*kinds))
        out = lookup(out, service_totals(services, packages, keys), keys, ["service_quantity", "service_value"])
        service = F.col("po_type").isin(*kinds)
        out = out.withColumns({
            "to_deliver_quantity": F.when(service, F.col("service_quantity") - F.col("delivered_quantity"))
            .otherwise(F.col("to_deliver_quantity")),
            "to_deliver_value": F.when(service, F.col("service_value") - F.col("delivered_value"))
            .otherwise(F.col("to_deliver_value")),
        })
        rules = _service_rules(done, unplanned, planned) + rules
    closed_short = done & short
    return out.withColumns({
        "to_deliver_quantity": F.when(closed_short, F.lit(0)).otherwise(F.col("to_deliver_quantity")),
        "to_deliver_value": F.when(closed_short, F.lit(0)).otherwise(F.col("to_deliver_value")),
        "status": first_match(rules, "CLOSED"),
    })


def _service_rules(done: Column, unplanned: tuple[str, ...], planned: tuple[str, ...]) -> list[tuple[Column, str]]:
    quantity_met = F.col("service_quantity") <= F.col("delivered_quantity")
    value_met = F.col("service_value") <= F.col("delivered_value")
    deleted = F.trim(F.col("deleted")) == SHORT_CLOSE
    to_invoice = F.col("to_invoice_value") != 0
    below = (F.col("delivered_quantity") < F.col("service_quantity") - F.col("under_tolerance")) | (
        F.col("delivered_value") < F.col("service_value") - F.col("under_tolerance"))
    out = []
    for kinds, met, still in (
        (unplanned, quantity_met | value_met, below),
        (planned, (quantity_met & ~to_invoice) | value_met, below | to_invoice),
    ):
        if kinds:
            kind = F.col("po_type").isin(*kinds)
            out += [(kind & met, "CLOSED"), (kind & deleted, "SHORT_CLOSED"), (kind & ~done & still, "OPEN")]
    return out


def vendor_performance(orders: DataFrame, key: list[str], ordered: str, expected: str, actual: str) -> DataFrame:
    """Mean days a document's deliveries came early (positive) or late (negative)."""
    gap = F.datediff(F.col(expected), F.col(ordered)) - F.datediff(F.col(actual), F.col(ordered))
    return orders.where(F.col(actual).isNotNull()).groupBy(*key).agg(F.avg(gap).alias("days_early"))


def open_requisitions(requisitions: DataFrame, requested: str = "requested", ordered: str = "ordered") -> DataFrame:
    return requisitions.where(F.col(requested) > F.coalesce(F.col(ordered), F.lit(0)))


def change_counts(headers: DataFrame, items: DataFrame, table: str, block_field: str, active_field: str,
                  blocked: str = "01", inactive: str = "X") -> DataFrame:
    """Changes per day: normal, block, unblock, activate and deactivate.

    headers: class, object, change_no, date; items: class, object, change_no, table, field,
    old, new. Keys are compared trimmed, equal items counted once. Days without a normal
    change are kept.
    """
    keys = ["class", "object", "change_no"]
    trimmed = lambda df: df.withColumns({k: F.trim(k) for k in keys})
    joined = trimmed(items).where(F.col("table") == table).join(
        trimmed(headers).select(*keys, "date"), keys, "inner").distinct()
    old, new = F.trim("old"), F.trim("new")
    turned = lambda field, on, value: (F.col("field") == field) & (
        (is_blank("old") & (new == value)) if on else ((old == value) & is_blank("new")))
    one = F.lit(1)
    return conditional_sums(joined, ["date"], {
        "changes": (~F.col("field").isin(block_field, active_field), one),
        "blocked": (turned(block_field, True, blocked), one),
        "unblocked": (turned(block_field, False, blocked), one),
        "deactivated": (turned(active_field, True, inactive), one),
        "activated": (turned(active_field, False, inactive), one),
    })


def member_changes(headers: DataFrame, items: DataFrame, members: DataFrame) -> DataFrame:
    """Members changed per day: distinct (object, day) of known members."""
    keys = ["class", "object", "change_no"]
    changed = semi(headers.select(*keys, "date"), items, keys).select("object", "date").distinct()
    return semi(changed, members, ["object"]).groupBy("date").agg(F.count(F.lit(1)).alias("changes"))


def field_changes(changes: DataFrame, key: str, start: int, length: int, fields: dict[str, tuple[str, ...]]) -> DataFrame:
    """Counts of field changes per document (a slice of the change key) and day."""
    out = changes.withColumn("document", F.substring(as_col(key), start, length))
    return conditional_sums(out, ["document", "date"], {
        name: (F.col("field").isin(*codes), F.lit(1)) for name, codes in fields.items()})


def changed_members(members: DataFrame, changes: DataFrame, id_: str, created: str, changed: str) -> DataFrame:
    """Change rows other than the member's creation."""
    return anti(changes, members, [id_, (changed, created)])


def import_tracker(lines: DataFrame, documents: DataFrame, firsts: dict[str, tuple[str, str]],
                   conditions: DataFrame, codes: list[str], keys: list[str], weight_unit: str = "KG") -> DataFrame:
    """Document facts and condition amounts per order line, weight in tonnes.

    documents: keys, kind, date, reference; ``firsts`` maps an output column to (kind, column)
    of the earliest such document. conditions: doc, line, code, value. Two aggregations replace
    a join per document type and per condition code.
    """
    earliest = lambda kind, c: F.min_by(
        F.when(F.col("kind") == kind, F.col(c)),
        F.when(F.col("kind") == kind, rank(documents, ["date", "reference"])))
    facts = documents.groupBy(*keys).agg(*[earliest(kind, c).alias(name) for name, (kind, c) in firsts.items()])
    sums = conditions.withColumn("line", strip_zeros("line")).groupBy("doc", "line").agg(*[
        F.sum(F.when(F.col("code") == c, F.col("value"))).alias(c.lower()) for c in codes])
    out = lookup(lines, facts, keys, list(firsts))
    out = out.withColumn("__line", strip_zeros("line"))
    out = lookup(out, sums, ["doc", ("__line", "line")], [c.lower() for c in codes]).drop("__line")
    kg = F.trim("unit") == weight_unit
    return out.withColumns({
        "quantity": F.when(kg, F.col("quantity") / 1000).otherwise(F.col("quantity")),
        "unit": F.when(kg, F.lit("MT")).otherwise(F.col("unit")),
    })


def procurement_vs_budget(receipts: DataFrame, budgets: DataFrame, keys: list[str]) -> DataFrame:
    """Received tonnes per month against the quarter budget dated on that month."""
    actual = receipts.withColumn("month", period_key("date")).groupBy(*keys, "month").agg(
        F.sum("tonnes").alias("received"))
    budget = quarter_budgets(budgets, keys, "fy").groupBy(*keys, "month").agg(F.sum("budget").alias("budget"))
    return actual.join(budget, [*keys, "month"], "full").fillna(0, subset=["received", "budget"])


def activity_counts(df: DataFrame, keys: list[str], flag: str, names: tuple[str, str] = ("active", "inactive")) -> DataFrame:
    """Members per key without and with the deletion flag."""
    return conditional_sums(df, keys, {
        names[0]: (is_blank(flag), F.lit(1)), names[1]: (~is_blank(flag), F.lit(1))})


def distinct_members(df: DataFrame, keys: list[str], member: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(member).alias(name))


