"""Production: confirmations, receipts, usage and stock transfers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import first_match, signed
from ..operators.joins import lookup
from ..operators.reshape import conditional_sums
from .finance import equal_split
from .stock import to_unit

# Movement codes whose consumption counts positive and negative, the codes
# that return scrap, tonne units, the status codes of a closed order.
CONSUMED = ("261", "532")
RETURNED = ("262", "531")
TONNE_UNITS = ("TO", "MT")
WEIGHT_UNITS = ("TO", "MT", "KG")
CLOSED_STATES = ("I0045", "I0046", "IF047")


def kilograms(quantity: str, unit: str) -> Column:
    return F.when(F.col(unit).isin(*TONNE_UNITS), F.col(quantity) * 1000).otherwise(F.col(quantity))


def net_consumption(quantity: Column, code: str) -> Column:
    return first_match([(F.col(code).isin(*CONSUMED), quantity), (F.col(code).isin(*RETURNED), -quantity)])


def order_status(states: DataFrame, keys: list[str], state: str, closed: tuple[str, ...] = CLOSED_STATES) -> DataFrame:
    """Closed when any of the order's states closes it."""
    hit = F.max(F.col(state).isin(*closed))
    return states.groupBy(*keys).agg(F.when(hit, F.lit("Closed")).otherwise(F.lit("Open")).alias("status"))


def production_confirmations(orders: DataFrame, confirmations: DataFrame, operations: DataFrame,
                             components: DataFrame, movements: DataFrame, states: DataFrame,
                             waste: dict[str, tuple[str, ...]]) -> DataFrame:
    """Planned and actual weight, waste by class, status and last work centre per confirmation.

    orders: order, plant, material, planned_quantity; confirmations: order, confirmation, date,
    made; operations: order, step, centre; components: order, unit, move_type, quantity;
    movements: order, confirmation, unit, move_type, group, quantity. Order-level amounts are
    split evenly over the order's confirmations; orders that made nothing are left out.
    """
    weighed = lambda df: df.where(F.col("unit").isin(*WEIGHT_UNITS)).withColumn(
        "__kg", net_consumption(kilograms("quantity", "unit"), "move_type"))
    planned = weighed(components).groupBy("order").agg(F.sum("__kg").alias("planned_weight"))
    used = weighed(movements)
    waste_kg = -F.col("__kg")
    actual = used.groupBy("order", "confirmation").agg(
        F.sum("__kg").alias("actual_weight"),
        *[F.sum(F.when(F.col("group").isin(*groups), waste_kg).otherwise(F.lit(0))).alias(name)
          for name, groups in waste.items()])
    # Of two centres on the last step the greater counts.
    centre = operations.groupBy("order").agg(F.max(F.struct("step", "centre"))["centre"].alias("work_centre"))
    made = confirmations.groupBy("order").agg(F.sum("made").alias("order_made")).where("order_made <> 0")
    out = confirmations.join(orders, "order", "inner")
    out = lookup(out, made, ["order"], ["order_made"], how="inner")
    out = lookup(out, planned, ["order"], ["planned_weight"])
    out = lookup(out, actual, ["order", "confirmation"], ["actual_weight", *waste])
    out = lookup(out, order_status(states, ["order"], "state"), ["order"], ["status"])
    out = lookup(out, centre, ["order"], ["work_centre"])
    return equal_split(out, ["order"], {"planned_quantity": 3, "order_made": 3, "planned_weight": 4})


def production_receipts(receipts: DataFrame, factors: DataFrame, weights: DataFrame, keys: list[str],
                        negative: tuple[str, ...]) -> DataFrame:
    """Received quantity per key in kilograms, reversals negative."""
    net = receipts.withColumn("quantity", signed("quantity", "move_type", *negative))
    out = to_unit(net, factors, "quantity", "kilograms", fallback=weights, unit="unit")
    return out.groupBy(*keys).agg(F.sum("quantity").alias("quantity"), F.sum("kilograms").alias("kilograms"))


def material_usage(movements: DataFrame, keys: list[str], issue: tuple[str, ...], cancel: tuple[str, ...]) -> DataFrame:
    """Consumption quantity and value: issues positive, their cancellations negative."""
    code = F.col("move_type")
    sign = first_match([(code.isin(*issue), 1), (code.isin(*cancel), -1)])
    used = movements.where(code.isin(*issue, *cancel))
    return used.groupBy(*keys).agg(
        F.sum(F.col("quantity") * sign).alias("quantity"), F.sum(F.col("value") * sign).alias("value"))


def stock_transfers(lines: DataFrame, excise: DataFrame, rates: DataFrame, receipts: DataFrame,
                    rate_codes: dict[str, str], keys: list[str]) -> DataFrame:
    """Transfer lines on two document paths with tax rates and netted receipts.

    Lines with an excise document take its number and date, the others keep their own; one left
    join tells them apart. rates: keys, code, rate; receipts: keys, move_type, quantity.
    """
    marked = excise.withColumn("__found", F.lit(True))
    out = lookup(lines, marked, keys, ["document", ("document_date", "__date"), "__found"])
    out = out.withColumns({
        "document_date": F.when(F.col("__found"), F.col("__date")).otherwise(F.col("date")),
        "path": F.when(F.col("__found"), F.lit("excise")).otherwise(F.lit("direct"))}).drop("__date", "__found")
    tax = conditional_sums(rates, keys, {
        name: (F.col("code") == code, F.col("rate") / 10) for name, code in rate_codes.items()})
    got = receipts.groupBy(*keys).agg(
        F.sum(signed("quantity", "move_type", "102")).alias("received_quantity"))
    out = lookup(out, tax, keys, list(rate_codes))
    return lookup(out, got, keys, ["received_quantity"])
