"""Stock: categories, valuation, movements, unit conversion, projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import first_match, pad_id, ratio, signed
from ..functions.dates import days_in_month
from ..operators.joins import effective_dated, lookup, period_key
from ..operators.reshape import fiscal_sheet
from ..operators.upsert import replace_snapshots
from ..operators.windows import running_sum, with_group_size

# Quantities are weighed in kilograms and reported in tonnes; a product may be
# dispatched this many days after its production (curing); stock is projected this far.
KG_PER_TONNE = 1000
CURING_DAYS = 15
HORIZON_DAYS = 30


def to_unit(df: DataFrame, factors: DataFrame, quantity: str, name: str, on=("material",),
            fallback: DataFrame | None = None, date: str = "date", unit: str | None = None,
            base_unit: str = "KG", weight_keys: tuple[str, ...] = ("material", "plant")) -> DataFrame:
    """Quantity in the target unit: by numerator/denominator, else by the weight valid on the
    date, else unchanged where the row is already in the base unit, else null."""
    out = lookup(df, factors, list(on), [("numerator", "__num"), ("denominator", "__den")])
    rules = [(F.col("__num").isNotNull(), F.col(quantity) * ratio("__num", "__den"))]
    if fallback is not None:
        out = effective_dated(out, fallback, list(weight_keys), date, "valid_from", "valid_to",
                              [("weight", "__weight")])
        rules.append((F.col("__weight").isNotNull(), F.col(quantity) * F.col("__weight")))
    if unit is not None:
        rules.append((F.col(unit) == base_unit, F.col(quantity)))
    rules = [(c, v.cast("double")) for c, v in rules]
    return out.withColumn(name, first_match(rules)).drop("__num", "__den", "__weight")


def by_plant_unit(df: DataFrame, volume_plants: DataFrame, weight: str, volume: str, name: str) -> DataFrame:
    """Per-plant choice of the reporting unit: cubic metres in some plants, tonnes in the others."""
    marks = volume_plants.select("plant").distinct().withColumn("__by_volume", F.lit(True))
    out = lookup(df, marks, ["plant"], ["__by_volume"])
    return out.withColumn(name, F.when(F.col("__by_volume"), F.col(volume)).otherwise(F.col(weight))).drop("__by_volume")


def plant_kind(plant: Column, plant_prefix: tuple[str, ...], depot_prefix: tuple[str, ...], organised: Column,
               always: tuple[str, ...] = ()) -> Column:
    """1 plant, 0 depot, 3 neither; by the id's first character."""
    head = F.substring(plant.cast("string"), 1, 1)
    return first_match([
        (plant.cast("string").isin(*always) if always else F.lit(False), 1),
        (head.isin(*plant_prefix) & organised, 1),
        (head.isin(*depot_prefix), 0),
    ], 3)


def stock_categories(stock: DataFrame, transit: DataFrame, reclaim: tuple[str, ...], good_depot: tuple[str, ...],
                     good_plant: tuple[str, ...], curing: tuple[str, ...], scrap_depot: tuple[str, ...]) -> DataFrame:
    """Stock per location split into reclaimable, good, curing and destroyable tonnes.

    stock: material, plant, location, is_plant, free, quality, blocked, numerator, denominator;
    transit: material, plant, is_plant, quantity, numerator, denominator, taken at plant level
    and carried in rows without a location. Rows without stock and transit are left out.
    """
    mt = lambda q: (F.col(q) * ratio("numerator", "denominator") / KG_PER_TONNE)
    at = lambda places: F.coalesce(F.col("location").isin(*places), F.lit(False))
    depot, plant = F.col("is_plant") == 0, F.col("is_plant") == 1
    zero = F.lit(0.0)
    located = stock.select(
        "material", "plant", "location", "is_plant",
        ((F.col("free") + F.col("quality") + F.col("blocked")) * ratio("numerator", "denominator")
         / KG_PER_TONNE).alias("total_mt"),
        mt("free").alias("free_mt"), mt("quality").alias("quality_mt"), zero.alias("in_transit_mt"))
    moving = transit.select(
        "material", "plant", F.lit(None).cast("string").alias("location"), "is_plant",
        zero.alias("total_mt"), zero.alias("free_mt"), zero.alias("quality_mt"), mt("quantity").alias("in_transit_mt"))
    out = located.unionByName(moving)
    out = out.withColumns({
        "reclaimable_mt": F.when(at(reclaim), F.col("total_mt")).otherwise(zero),
        "good_mt": first_match([(at(good_depot) & depot, F.col("free_mt")),
                                (at(good_plant) & plant, F.col("free_mt"))], 0.0),
        "curing_mt": F.when(at(curing), F.col("quality_mt")).otherwise(zero),
    })
    rest = F.col("total_mt") - (F.col("good_mt") + F.col("reclaimable_mt") + F.col("curing_mt"))
    out = out.withColumn("destroyable_mt", first_match([(at(scrap_depot) & depot, rest), (plant, rest)], 0.0))
    return out.where("total_mt <> 0 OR in_transit_mt <> 0").drop("is_plant", "free_mt", "quality_mt")


def valuate(stock: DataFrame, valuations: DataFrame, quantities: dict[str, str]) -> DataFrame:
    """Price stock by its control: standard (S) or moving average (V).

    Of a (plant, material) with several valuation rows the split-valuated ones are left out.
    """
    sized = with_group_size(valuations, ["plant", "material"], "__n")
    single = sized.where((F.col("__n") == 1) | F.col("val_type").isNull())
    price = first_match([(F.col("control") == "S", F.col("standard_price")),
                         (F.col("control") == "V", F.col("average_price"))])
    prices = single.select("plant", "material", price.alias("price"))
    out = stock.join(prices, ["plant", "material"], "left")
    return out.withColumns({name: F.col(q) * F.col("price") for name, q in quantities.items()})


def movement_loss(movements: DataFrame, rules: dict[str, list[tuple[Column, int]]],
                  quantity: str = "weight_mt", zero_where: dict[str, Column] | None = None) -> DataFrame:
    """Signed measures by movement rule: ``rules`` maps a measure to (condition, sign) pairs.

    ``zero_where`` sets a measure to 0 for rows it must not count, such as scrap material.
    """
    zero_where = zero_where or {}
    out = {}
    for name, pairs in rules.items():
        first = [(zero_where[name], F.lit(0).cast(movements.schema[quantity].dataType))] if name in zero_where else []
        out[name] = first_match(first + [(cond, F.col(quantity) * sign) for cond, sign in pairs])
    return movements.withColumns(out)


def supplying_plant(is_plant: Column, location: Column, plants: dict[str, tuple[str, ...]]) -> Column:
    """The plant a depot's location belongs to; null for plants and other locations."""
    return first_match([((is_plant == 0) & location.isin(*places), plant) for plant, places in plants.items()])


def material_deficit(plan_sheet: DataFrame, need_sheet: DataFrame, groups: DataFrame, stock: DataFrame,
                     as_of: str, horizon: int = HORIZON_DAYS, year_is: str = "calendar") -> DataFrame:
    """Raw material stock at the end of each of the coming days.

    plan_sheet: plant, line, fy, APRIL..MARCH (planned production); need_sheet: plant, line,
    rm_group, fy, APRIL..MARCH (requirement per unit); groups: rm_group, material;
    stock: material, plant, quantity. The month's plan is spread evenly over its days.
    """
    plan = fiscal_sheet(plan_sheet, ["plant", "line"], "fy", "target", year_is)
    plan = plan.withColumn("planned_day", F.round(F.col("target") / days_in_month("month"), 2))
    need = fiscal_sheet(need_sheet, ["plant", "line", "rm_group"], "fy", "per_unit", year_is)
    need = lookup(need, plan, ["plant", "line", "month"], ["planned_day"])
    day = F.lit(as_of).cast("date")
    on_hand = lookup(groups, stock, ["material"], ["plant", "quantity"], how="inner")
    on_hand = on_hand.groupBy("rm_group", "plant").agg(F.sum("quantity").alias("stock_quantity"))
    now = need.where(F.col("month") == period_key(day)).select("plant", "line", "rm_group").distinct()
    start = now.join(on_hand, ["rm_group", "plant"], "inner")
    future = start.withColumn("stock_date", F.explode(F.sequence(
        F.date_add(day, 1), F.date_add(day, horizon))))
    future = future.withColumn("month", period_key("stock_date"))
    out = lookup(future, need, ["plant", "line", "rm_group", "month"], ["per_unit", "planned_day"])
    out = out.withColumn("required", F.col("planned_day") * F.col("per_unit"))
    out = running_sum(out, ["rm_group", "line", "plant"], ["stock_date"], {"required_so_far": "required"}, bounded=True)
    return out.withColumn("end_of_day_stock", F.col("stock_quantity") - F.col("required_so_far")).drop("month")


def daily_plan(grid: DataFrame, opening: DataFrame, month_plan: DataFrame, split: DataFrame,
               production: DataFrame, done_production: DataFrame, curing_days: int = CURING_DAYS,
               idle_days: int = 3) -> DataFrame:
    """Closing and dispatchable stock per plant, material and day.

    grid: plant, material, date; opening: plant, material, good, opening, depot_opening;
    month_plan: plant, material, month, sales_plan, sales, transfer_plan, transferred,
    depot_plan, depot_sales; split: plant, day_no, plant_percent, depot_percent;
    production: plant, material, date, quantity (plan); done_production: same, actuals.
    Remaining transfers run evenly until ``idle_days`` before the month's end.
    """
    k = ["plant", "material"]
    out = grid.withColumns({"month": period_key("date"), "day_no": F.dayofmonth("date")})
    # The split knows no material: it comes first, the rest goes by plant and material as the running sums do.
    out = lookup(out, split, ["plant", "day_no"], ["plant_percent", "depot_percent"])
    out = lookup(out, opening, k, ["good", "opening", "depot_opening"])
    out = lookup(out, month_plan, [*k, "month"], [
        "sales_plan", "sales", "transfer_plan", "transferred", "depot_plan", "depot_sales"])
    # What is made and what is cured on a day come in one sum per plant, material and day: the days are matched once.
    none = F.lit(None).cast(production.schema["quantity"].dataType)
    cured = production.unionByName(done_production).select(*k, F.date_add("date", curing_days).alias("date"), none.alias("made"), "quantity")
    moved = production.select(*k, "date", F.col("quantity").alias("made"), none.alias("quantity")).unionByName(cured)
    moved = moved.groupBy(*k, "date").agg(F.sum("made").alias("production"), F.sum("quantity").alias("cured"))
    out = lookup(out, moved, [*k, "date"], ["production", "cured"])
    out = out.fillna(0, subset=["good", "opening", "depot_opening", "sales_plan", "sales", "transfer_plan",
                                "transferred", "depot_plan", "depot_sales", "production", "cured"])
    working = days_in_month("date") - idle_days
    left = F.col("transfer_plan") - F.col("transferred")
    out = out.withColumns({
        "plant_sales_day": (F.col("sales_plan") - F.col("sales")) * F.col("plant_percent") / 100,
        "depot_sales_day": (F.col("depot_plan") - F.col("depot_sales")) * F.col("depot_percent") / 100,
        "transfer_day": F.when(F.col("day_no") < working, left / working).otherwise(F.lit(0)),
    })
    out = out.withColumns({
        "net": F.col("production") - F.col("plant_sales_day") - F.col("transfer_day"),
        "depot_net": F.col("transfer_day") - F.col("depot_sales_day"),
        "dispatch_net": F.col("cured") - F.col("plant_sales_day") - F.col("transfer_day"),
    })
    out = running_sum(out, k, ["date"], {"net_sum": "net", "depot_sum": "depot_net", "dispatch_sum": "dispatch_net"},
                      bounded=True)
    return out.select(
        *k, "date", "production", "plant_sales_day", "transfer_day",
        (F.col("opening") + F.col("net_sum")).alias("closing_stock"),
        (F.col("depot_opening") + F.col("depot_sum")).alias("depot_closing_stock"),
        (F.col("good") + F.col("dispatch_sum")).alias("dispatchable_stock"))


def non_moving(stock: DataFrame, prices: DataFrame, movements: DataFrame, keys: list[str]) -> DataFrame:
    """Stock value per key with the last movement dates in and out.

    prices: keys, value, quantity (the price is the ratio of sums); movements: keys, date, sign.
    """
    price = prices.groupBy(*keys).agg(ratio(F.sum("value"), F.sum("quantity")).alias("price"))
    last = movements.groupBy(*keys).agg(
        F.max(F.when(F.col("sign") > 0, F.col("date"))).alias("last_receipt"),
        F.max(F.when(F.col("sign") < 0, F.col("date"))).alias("last_issue"))
    total = stock.groupBy(*keys).agg(F.sum("quantity").alias("quantity"))
    out = total.join(price, keys, "left").join(last, keys, "left")
    return out.withColumn("stock_value", F.col("quantity").cast("double") * F.col("price"))


def backload(csv: DataFrame, history: DataFrame, ids: dict[str, int], amounts: list[str], snapshot: str) -> DataFrame:
    """History from a text file: ids padded, amounts typed and null-filled, snapshots replaced."""
    typed = csv.select(*[
        pad_id(c, ids[c]).alias(c) if c in ids
        else F.coalesce(F.col(c).try_cast("decimal(13,3)"), F.lit(0).cast("decimal(13,3)")).alias(c) if c in amounts
        else F.to_date(c).alias(c) if c == snapshot else F.col(c)
        for c in csv.columns])
    return replace_snapshots(history, typed, snapshot)
