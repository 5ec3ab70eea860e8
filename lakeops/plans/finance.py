"""Finance: variances, allocation, ledger lines, budget sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_col, is_blank, ratio, signed
from ..operators.joins import lookup, period_key, semi
from ..operators.reshape import flag_pairs, pivot_sums, unpivot_groups
from ..operators.windows import with_group_size, with_group_values, year_to_date


def revenue_to_date(monthly: DataFrame, keys: list[str], month: str, value: str, reset: Column | None = None) -> DataFrame:
    return year_to_date(monthly, keys, month, {f"{value}_ytd": value}, reset)


def cost_tracker(sheet: DataFrame, ids: list[str], plant: list[str], depot: list[str], month: str) -> DataFrame:
    """Plant and depot day columns paired by day of the given month."""
    groups = {str(i + 1): [p, d] for i, (p, d) in enumerate(zip(plant, depot))}
    long = unpivot_groups(sheet, [*ids, month], groups, "day", ["plant_value", "depot_value"])
    date = F.date_add(F.col(month), F.col("day").cast("int") - 1)
    return long.withColumn("date", date).where(period_key("date") == F.col(month)).select(
        *ids, "date", "plant_value", "depot_value")


def budget_labels(df: DataFrame, keys: list[str], label: str, labels: list[str], value: str) -> DataFrame:
    return pivot_sums(df, keys, label, labels, {value: F.sum(value)})


def material_variance(produced: DataFrame, consumed: DataFrame, standard: DataFrame, prices: DataFrame) -> DataFrame:
    """Quantity and rate variance per production order and raw material.

    produced: order, plant, date, fg_kg; consumed: order, material, rm_kg, rm_amount;
    standard: order, material, std_per_kg; prices: material, plant, month, target_price.
    Without a standard the whole consumption at target price is the quantity variance.
    """
    out = produced.withColumn("month", period_key("date")).join(consumed, "order", "inner")
    out = lookup(out, standard, ["order", "material"], ["std_per_kg"])
    out = lookup(out, prices, ["material", "plant", "month"], ["target_price"])
    price = F.coalesce(F.col("target_price"), F.lit(0))
    out = out.withColumns({
        "target_price": price,
        "rate_per_kg": ratio("rm_amount", "rm_kg"),
        "std_required_kg": F.col("std_per_kg") * F.col("fg_kg"),
    })
    used = F.col("rm_kg").cast("double")
    quantity = (F.col("std_required_kg") - F.col("rm_kg")).cast("double") * F.col("target_price").cast("double")
    return out.withColumns({
        "quantity_variance": F.when(F.col("std_per_kg").isNull(), used * F.col("target_price").cast("double"))
        .otherwise(quantity),
        "rate_variance": used * (F.col("target_price").cast("double") - F.col("rate_per_kg")),
    })


def allocate_by_share(amounts: DataFrame, members: DataFrame, group: list[str], weight: str,
                      measures: list[str]) -> DataFrame:
    """Amounts booked on a group shared out by each member's part of the group's weight."""
    shares = with_group_values(members, group, {"__total": F.sum(weight)})
    shares = shares.withColumn("share", ratio(weight, "__total")).drop("__total")
    out = amounts.join(shares, group, "inner")
    return out.withColumns({m: F.col(m).cast("double") * F.col("share") for m in measures})


def equal_split(df: DataFrame, keys: list[str], values: dict[str, int]) -> DataFrame:
    """Order-level values divided by the order's row count, rounded per column."""
    sized = with_group_size(df, keys, "__n")
    return sized.withColumns({
        f"{c}_split": F.round(F.col(c) / F.col("__n"), scale) for c, scale in values.items()}).drop("__n")


def actual_vs_budget(sheet: DataFrame, ids: list[str], derived: dict[str, Column], columns: list[str],
                     order: dict[str, int] | None = None) -> DataFrame:
    """Sheet with ACTUAL and BUDGET rows to one row per particular with both values."""
    out = flag_pairs(sheet.withColumns(derived), ids, "actual_or_budget", ["ACTUAL", "BUDGET"], columns)
    out = out.withColumn("particulars", F.replace("particulars", F.lit("_"), F.lit(" ")))
    if order:
        pairs = [x for k, v in order.items() for x in (F.lit(k), F.lit(v))]
        out = out.withColumn("sort", F.create_map(*pairs)[F.col("particulars")])
    return out


def ledger_lines(lines: DataFrame, documents: DataFrame, accounts: DataFrame, company: DataFrame,
                 codes: DataFrame) -> DataFrame:
    """Signed lines of the wanted accounts with posting and due date.

    lines: company, document, year, account, dc, amount, base_date, days1, days2, days3;
    documents: company, document, year, doc_date, post_date. The account list is narrowed by
    two semi joins on frames, nothing is collected.
    """
    wanted = semi(semi(accounts, codes, ["account"]), company, ["company"])
    out = semi(lines, wanted, ["company", "account"])
    out = out.join(documents, ["company", "document", "year"], "left")
    days = F.coalesce("days3", "days2", "days1", F.lit(0))
    base = F.coalesce(F.col("base_date"), F.col("doc_date"))
    return out.withColumns({
        "amount": signed("amount", "dc", "H"),
        "due_date": F.date_add(base, days.cast("int")),
    })


def adjusted_posting_date(lines: DataFrame, orders: DataFrame, order: str, posted: str, order_date: str) -> DataFrame:
    """Order-related postings take the order's date, the others keep their own.

    Postings without an order stay out of the join, which would bring them all to one task.
    """
    related = lookup(lines.where(~is_blank(order)), orders, [order], [(order_date, "__order_date")])
    related = related.withColumn("adjusted_date", F.coalesce(F.col("__order_date"), F.col(posted))).drop("__order_date")
    return related.unionByName(lines.where(is_blank(order)).withColumn("adjusted_date", F.col(posted)))


def stack_sheets(sheets: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union of equally named sheets, each tagged."""
    out = None
    for label, df in sheets.items():
        df = df.withColumn(tag, F.lit(label))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def weighted_price(df: DataFrame, keys: list[str], value: str | Column, quantity: str | Column, name: str) -> DataFrame:
    """Ratio of sums; null where the quantities add up to nothing."""
    return df.groupBy(*keys).agg(ratio(F.sum(as_col(value)), F.sum(as_col(quantity))).alias(name))
