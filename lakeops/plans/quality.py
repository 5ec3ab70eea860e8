"""Quality: rejections by shift, ratings, samples, complaints, visits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import first_match, is_blank, ratio, signed
from ..operators.joins import lookup
from ..operators.reshape import concat_rows, paired_unpivot, pivot_sums, unpivot
from ..operators.windows import pick_row, with_group_size
from .stock import by_plant_unit, to_unit

# Texts shown for tests without a result or a value; the first letters of
# locations that hold good stock.
NO_RESULT = "In Progress"
NO_VALUE = "NA"
GOOD_LOCATIONS = ("2", "4")


def rejection_by_shift(sources: list[DataFrame], keys: list[str], shift: str, shifts: list[str],
                       measures: list[str]) -> DataFrame:
    """Measures by shift as columns, over the distinct rows of several movement paths."""
    rows = reduce(DataFrame.unionByName, sources).distinct()
    return pivot_sums(rows, keys, shift, shifts, {m: F.sum(m) for m in measures})


def ratings(sheet: DataFrame, ids: list[str], parameters: list[str], targets: DataFrame, on: list[str]) -> DataFrame:
    """Rating and value columns to rows, with the target of the parameter."""
    rows = paired_unpivot(sheet, ids, parameters, ["RATING", "VALUE"])
    return lookup(rows, targets, on, ["target"])


def survey_rows(sheets: dict[str, DataFrame], ids: list[str], tag: str, lookup_table: DataFrame | None = None,
                value_type: str = "double") -> DataFrame:
    """Every non-id column of each sheet to rows, tagged by sheet."""
    parts = [unpivot(df, ids, None, "parameter", "value", cast=value_type).withColumn(tag, F.lit(label))
             for label, df in sheets.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out if lookup_table is None else lookup(out, lookup_table, ["parameter"], ["parameter_group"])


def sample_results(samples: DataFrame, tests: DataFrame, key: str, order: str) -> DataFrame:
    """One text per sample listing its tests: 'param - value , result' joined by ' : '.

    A test without result is in progress, one without value or name is not available.
    """
    out = lookup(samples, tests, [key], ["param", "value", "result", order])
    shown = lambda c, text: F.when(is_blank(c), F.lit(text)).otherwise(F.col(c))
    text = F.concat(F.coalesce(F.col("param"), F.lit(NO_VALUE)), F.lit(" - "),
                    F.coalesce(F.col("value"), F.lit(NO_VALUE)), F.lit(" , "), shown("result", NO_RESULT))
    return concat_rows(out, samples.columns, order, text, " : ", "test_results")


def complaint_life_cycle(complaints: DataFrame, investigations: DataFrame, compensations: DataFrame,
                         tie: tuple[str, ...] = ()) -> DataFrame:
    """Complaints with the plant, quantities and remark of the latest stage and the days between stages.

    complaints: id, date, remark, plant; investigations: id, date, remark, plant, quantity;
    compensations: same. Drafts are to be left out by the caller; of several documents the
    earliest counts as a whole, of those of one day the least by ``tie`` and then by their other
    columns. Quantities fall back row by row.
    """
    stage = ("date", "remark", "plant", "quantity")
    first = lambda df, p: pick_row(
        df.select("id", *stage, *[c for c in tie if c not in stage]), ["id"],
        [F.col("date").isNull(), F.col("date"), *[F.col(c) for c in tie]]).select(
        "id", *[F.col(c).alias(f"{p}_{c}") for c in stage])
    out = lookup(complaints, first(investigations, "inv"), ["id"],
                 ["inv_date", "inv_remark", "inv_plant", "inv_quantity"])
    out = lookup(out, first(compensations, "cmp"), ["id"],
                 ["cmp_date", "cmp_remark", "cmp_plant", "cmp_quantity"])
    compensated, investigated = F.col("cmp_date").isNotNull(), F.col("inv_date").isNotNull()
    return out.select(
        "id", F.col("date").alias("complaint_date"), "inv_date", "cmp_date",
        first_match([(compensated, "Compensated"), (investigated, "Investigated")], "Registered").alias("stage"),
        first_match([(compensated, F.col("cmp_remark")), (investigated, F.col("inv_remark"))],
                    F.col("remark")).alias("remark"),
        F.coalesce("cmp_plant", "inv_plant", "plant").alias("plant"),
        F.coalesce("cmp_quantity", "inv_quantity").alias("quantity"),
        F.abs(F.datediff("inv_date", "date")).alias("days_to_attend"),
        F.abs(F.datediff("cmp_date", "inv_date")).alias("days_to_compensate"))


# Final statuses of a complaint, by the document that was decided on last.
AT_COMPLAINT = ("Complaint Rejected", "Complaint Assigned", "Complaint Registered", "Complaint Approved")
AT_INVESTIGATION = ("Investigation Rejected", "Investigated and under review", "Investigation Approved. Compensation under review")
AT_COMPENSATION = ("Compensation Rejected", "Compensation Under Review", "Compensation Approved and sent")
REJECTED = ("Complaint Rejected", "Investigation Rejected", "Compensation Rejected")
DRAFT = "DRAFT"
#: The unit whose plants are those of its supplies; the others name them when they complain.
SUPPLY_UNIT = "SBU1"

SUPPLIED = ("supplied", "broken", "loss")


def main_investigations(investigations: DataFrame, lines: DataFrame) -> DataFrame:
    """The only investigation of a complaint; of several those that have lines in a unit's plant list."""
    sized = with_group_size(investigations, ["complaint"], "__n")
    listed = lines.select("id").distinct().withColumn("__listed", F.lit(True))
    marked = lookup(sized, listed, ["id"], ["__listed"])
    return marked.where((F.col("__n") == 1) | F.col("__listed")).drop("__n", "__listed")


def complaint_tracker(complaints: DataFrame, statuses: DataFrame, investigations: DataFrame, compensations: DataFrame,
                      complaint_plants: DataFrame, investigation_lines: DataFrame, compensation_lines: DataFrame,
                      defects: DataFrame, defect_names: DataFrame) -> DataFrame:
    """Complaints of all units with what their final status, their stages and their unit say.

    complaints: id, unit, category, date, cancel_remark, customer; statuses: complaint, final_status;
    investigations, compensations: id, complaint, status, date, cancel_remark, customer;
    complaint_plants: complaint, plant; investigation_lines, compensation_lines: id, plant, supplied,
    broken, loss, of the plant lists of all units; defects: unit, id (of the compensation), code,
    invoice; defect_names: unit, category, code, name.

    Drafts do not count. The cancel remark is that of the document the final status rejects, the
    customer that of the document it was decided on. Plants and quantities of ``SUPPLY_UNIT`` come from
    the compensation's lines, or else the investigation's, a row for each plant; other units have
    the complaint's plants and the quantities of the whole document. Of several defects the one
    with the least invoice counts.
    """
    taken = [("id", "id"), ("date", "date"), ("cancel_remark", "remark"), ("customer", "customer")]
    done = lambda df: df.where(F.col("status") != DRAFT)
    out = lookup(complaints.withColumnRenamed("customer", "own_customer"), done(main_investigations(investigations, investigation_lines)),
                 [("id", "complaint")], [(c, f"inv_{n}") for c, n in taken])
    out = lookup(out, done(compensations), [("id", "complaint")], [(c, f"cmp_{n}") for c, n in taken])
    out = lookup(out, statuses, [("id", "complaint")], ["final_status"])
    status = F.col("final_status")
    out = out.withColumns({
        "remark": first_match(list(zip([status == r for r in REJECTED], [F.col("cancel_remark"), F.col("inv_remark"), F.col("cmp_remark")]))),
        "customer": first_match([(status.isin(*AT_INVESTIGATION), F.col("inv_customer")), (status.isin(*AT_COMPENSATION), F.col("cmp_customer"))],
                                F.col("own_customer")),
        "rejected_on": F.when(status.isin(*REJECTED), F.col("date")),
        "days_to_attend": F.abs(F.datediff("inv_date", "date")),
        "days_to_compensate": F.abs(F.datediff("cmp_date", "inv_date"))})

    totals = lambda df, by, name: df.groupBy(*by).agg(*[F.sum(c).alias(f"{name}_{c}") for c in SUPPLIED])
    quantities = lambda: {c: F.coalesce(f"c_{c}", f"i_{c}") for c in SUPPLIED}
    names = lambda p: [f"{p}_{c}" for c in SUPPLIED]
    first = F.col("unit") == SUPPLY_UNIT
    # Plants of the supplies: the compensation's, or the investigation's where it lists none.
    by_plant, by_plant_inv = totals(compensation_lines, ["id", "plant"], "c"), totals(investigation_lines, ["id", "plant"], "i")
    mine = lookup(out.where(first), by_plant.select("id").distinct().withColumn("__paid", F.lit(True)), [("cmp_id", "id")], ["__paid"], spread="id")
    lists = by_plant.select(F.lit("c").alias("__kind"), "id", "plant").unionByName(by_plant_inv.select(F.lit("i").alias("__kind"), "id", "plant"))
    mine = mine.withColumns({"__kind": F.when(F.col("__paid"), "c").otherwise("i"),
                             "__list": F.when(F.col("__paid"), F.col("cmp_id")).otherwise(F.col("inv_id"))})
    mine = lookup(mine, lists, ["__kind", ("__list", "id")], ["plant"], spread="id").drop("__paid", "__kind", "__list")
    mine = lookup(mine, by_plant, [("cmp_id", "id"), "plant"], names("c"), spread="id")
    mine = lookup(mine, by_plant_inv, [("inv_id", "id"), "plant"], names("i"), spread="id")
    others = lookup(out.where(~first), complaint_plants.distinct(), [("id", "complaint")], ["plant"])
    others = lookup(others, totals(compensation_lines, ["id"], "c"), [("cmp_id", "id")], names("c"), spread="id")
    others = lookup(others, totals(investigation_lines, ["id"], "i"), [("inv_id", "id")], names("i"), spread="id")
    out = mine.unionByName(others).withColumns(quantities())

    one = pick_row(defects.select("unit", "id", "code", "invoice"), ["unit", "id"], [F.col("invoice"), F.col("code")])
    out = lookup(out, one, ["unit", ("cmp_id", "id")], [("code", "defect"), "invoice"], spread="id")
    out = lookup(out, defect_names, ["unit", "category", ("defect", "code")], [("name", "defect_name")], spread="id")
    return out.select(
        "id", "unit", "category", "inv_id", "cmp_id", "final_status", "remark", "customer", "plant", *SUPPLIED, "defect", "invoice",
        "defect_name", "rejected_on", "days_to_attend", "days_to_compensate")


def visit_frequency(visits: DataFrame, customer: Column, year: Column, date: Column) -> DataFrame:
    """Distinct visit dates per customer and fiscal year."""
    return visits.groupBy(customer.alias("customer"), year.alias("fiscal_year")).agg(
        F.countDistinct(date).alias("visits"))


def inspection_results(lots: DataFrame, characteristics: DataFrame, results: DataFrame) -> DataFrame:
    """Lots with their characteristics and the result of each, if there is one."""
    out = lots.join(characteristics, "lot", "inner")
    return lookup(out, results, ["lot", "characteristic"], ["result"])


def signed_rejections(movements: DataFrame, factors: DataFrame, keys: list[str], negative: tuple[str, ...]) -> DataFrame:
    """Rejected quantity in units and tonnes per key, reversals negative."""
    net = movements.withColumn("quantity", signed("quantity", "move_type", *negative))
    out = to_unit(net, factors, "quantity", "kilograms")
    return out.groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"), (F.sum("kilograms") / 1000).alias("tonnes"))


def rejection_share(stock: DataFrame, keys: list[str], location: str, quantity: str,
                    good: tuple[str, ...] = GOOD_LOCATIONS) -> DataFrame:
    """Good and defective stock by the location's first letter, and the defective share."""
    is_good = F.substring(F.col(location), 1, 1).isin(*good)
    out = stock.groupBy(*keys).agg(
        F.sum(F.when(is_good, F.col(quantity)).otherwise(F.lit(0))).alias("good_stock"),
        F.sum(F.when(is_good, F.lit(0)).otherwise(F.col(quantity))).alias("defective_stock"))
    share = ratio("defective_stock", F.col("good_stock") + F.col("defective_stock"))
    return out.withColumn("rejection_share", share).withColumn("rejection_percent", share * 100)


def vendor_rating(lots: DataFrame, decisions: DataFrame, results: DataFrame, characteristics: DataFrame) -> DataFrame:
    """Decided lots with their score and the first rejected characteristic's text and mean.

    lots: lot, vendor ...; decisions: lot, score; results: lot, characteristic, mean (rejected
    ones only); characteristics: lot, characteristic, text.
    """
    first = results.groupBy("lot").agg(F.min(F.struct("characteristic", "mean")).alias("__r")).select(
        "lot", "__r.characteristic", F.col("__r.mean").alias("mean_value"))
    remarks = lookup(first, characteristics, ["lot", "characteristic"], [("text", "remark")])
    return lookup(lots.join(decisions, "lot", "inner"), remarks, ["lot"], ["remark", "mean_value"])


def loading_breakages(lots: DataFrame, notices: DataFrame, defects: DataFrame, materials: DataFrame,
                      volume_plants: DataFrame) -> DataFrame:
    """Breakages per lot and defect, in pieces and in tonnes or, for some plants, cubic metres.

    lots: lot, plant, material ...; notices: lot, notice; defects: notice, group, code, pieces;
    materials: material, gross_kg, litres. A lot without notice or defect is kept.
    """
    out = lookup(lots, notices, ["lot"], ["notice"])
    out = lookup(out, defects, ["notice"], ["group", "code", "pieces"])
    out = lookup(out, materials, ["material"], ["gross_kg", "litres"])
    out = out.withColumns({
        "__t": F.col("pieces") * F.col("gross_kg") / 1000, "__m3": F.col("pieces") * F.col("litres") / 1000})
    return by_plant_unit(out, volume_plants, "__t", "__m3", "breakage").drop("__t", "__m3", "gross_kg", "litres")


def plant_rejections(movements: DataFrame, locations: dict[str, str], plus: str = "531", minus: str = "532",
                     weight: str = "tonnes") -> DataFrame:
    """Rejected weight by kind: ``locations`` maps the measure to its storage location.

    Only movements at these locations stay; the reversal counts negative.
    """
    at = F.col("location")
    signed_weight = signed(weight, "move_type", minus)
    rows = movements.where(at.isin(*locations.values()) & F.col("move_type").isin(plus, minus))
    return rows.withColumns({name: F.when(at == place, signed_weight) for name, place in locations.items()})


def visit_tracker(complaints: DataFrame, key: str, order: list[str], firsts: list[str], sums: list[str]) -> DataFrame:
    """One row per complaint: first values by a declared order, summed quantities."""
    rank = F.struct(*order)
    return complaints.groupBy(key).agg(
        *[F.min_by(c, rank).alias(c) for c in firsts], *[F.sum(c).alias(c) for c in sums])
