"""Sales targets: spreading over days and lifting to geography levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import DEFAULT_MEMBER
from ..operators.joins import lookup
from ..operators.windows import all_latest

# The calendar column that tells the days of one target period apart, per grain.
GRAIN_PERIOD = {
    "DAILY": "date_id",
    "WEEKLY": "month_week_id",
    "MONTHLY": "fy_month_id",
    "QUARTERLY": "fy_qtr_of_yr_num",
    "HALFYEARLY": "half_id",
    "YEARLY": "fy_name",
}
# Geography levels from the finest to the coarsest.
GEO_LEVELS = ["PINCODE", "DISTRICT", "SALES GROUP", "STATE", "ZONE", "COUNTRY"]


def period_of(calendar: DataFrame) -> DataFrame:
    """Calendar days with one period label per grain, and the number of days in the period."""
    labelled = calendar.withColumns({
        "month_week_id": F.concat_ws("-", "fy_month_id", "wk_name"),
        "half_id": F.concat_ws("-", "fy_name", "fy_hy_name"),
    })
    rows = F.array(*[
        F.struct(F.lit(grain).alias("grain"), F.col(c).cast("string").alias("period"))
        for grain, c in GRAIN_PERIOD.items()])
    return labelled.select("date_dt", F.inline(rows))


def spread_to_days(targets: DataFrame, calendar: DataFrame, measures: list[str], date: str = "target_date",
                   grain: str = "target_type") -> DataFrame:
    """Daily rows of targets given per day, week of month, month, quarter, half or fiscal year.

    Every measure is divided by the days of the period the target date falls in, so the days
    of one target add up to it whatever other targets share its date.
    """
    periods = period_of(calendar)
    sizes = periods.groupBy("grain", "period").agg(F.count(F.lit(1)).alias("__days"))
    dated = lookup(targets, periods, [(date, "date_dt"), (grain, "grain")], [("period", "__period")], how="inner")
    sized = lookup(dated, sizes, [(grain, "grain"), ("__period", "period")], ["__days"], how="inner")
    days = periods.select(F.col("grain").alias("__grain"), F.col("period").alias("__p"), F.col("date_dt").alias("__day"))
    out = sized.join(days, [sized[grain] == days["__grain"], sized["__period"] == days["__p"]], "inner")
    share = {m: F.col(m) / F.col("__days") for m in measures}
    return out.withColumns({**share, date: F.col("__day")}).drop("__grain", "__p", "__day", "__period", "__days")


def newest_targets(targets: DataFrame, keys: list[str], version: str = "file_date") -> DataFrame:
    """The latest delivered file wins per key; rows of equal version all stay."""
    return all_latest(targets, keys, version)


def lift_to_levels(targets: DataFrame, territory: DataFrame, scope: list[str], levels: list[str] = GEO_LEVELS,
                   level: str = "geo_unit_type", unit: str = "geo_unit") -> DataFrame:
    """Give targets set at any geography level all level columns.

    Levels below the target's own become the default member, its own holds the unit, the
    ones above come from the territory. One join serves all levels: the territory is
    unfolded to (level, unit) rows first.
    """
    column = {l: l.lower().replace(" ", "_") for l in levels}
    none = F.lit(None).cast("string")
    rows = F.array(*[
        F.struct(F.lit(l).alias("__level"), F.col(column[l]).cast("string").alias("__unit"),
                 *[(F.col(column[u]) if i > at else none).alias(f"__{column[u]}") for i, u in enumerate(levels)])
        for at, l in enumerate(levels)])
    unfolded = territory.select(*scope, F.inline(rows)).distinct()
    own = F.upper(F.col(level))
    out = lookup(targets.withColumn("__lvl", own), unfolded, [*scope, ("__lvl", "__level"), (unit, "__unit")],
                 [(f"__{column[l]}", f"__t_{column[l]}") for l in levels])
    for l in levels:
        at = levels.index(l)
        below = F.array_position(F.array(*[F.lit(x) for x in levels]), F.col("__lvl")) - 1 > at
        value = F.when(F.col("__lvl") == l, F.col(unit)).when(below, F.lit(DEFAULT_MEMBER)).otherwise(
            F.col(f"__t_{column[l]}"))
        out = out.withColumn(column[l], F.coalesce(value, F.lit(DEFAULT_MEMBER)))
    return out.drop("__lvl", *[f"__t_{column[l]}" for l in levels])


def spread_over_geography(rates: DataFrame, territory: DataFrame, scope: list[str], zone: str = "zone",
                          finer: tuple[str, ...] = ("pincode", "district", "sales_group")) -> DataFrame:
    """Zone-level rates given to every state of the zone; finer levels are the default member."""
    places = territory.select(*scope, F.lower(zone).alias("__zone"), "state", "country").distinct()
    out = lookup(rates.withColumn("__z", F.lower(zone)), places, [*scope, ("__z", "__zone")], ["state", "country"])
    out = out.drop("__z").distinct()
    out = out.withColumns({c: F.lit(DEFAULT_MEMBER) for c in finer})
    return out.fillna(DEFAULT_MEMBER, subset=["state", "country", zone])
