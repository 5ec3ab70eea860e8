"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import DEFAULT_MEMBER, first_match
from ..operators.ingest import ColumnMeta, only_language, processed_project, rename_project
from ..operators.joins import climb, lookup
from ..operators.keys import assign_keys
from ..operators.reshape import attributes_to_columns
from ..operators.windows import pick_row
from .security import access_string

TERRITORY_LEVELS = ["pincode", "district", "sales_group", "state", "zone", "country"]


def text_dimension(texts: DataFrame, language: str, meta: list[ColumnMeta], dim: DataFrame, keys: list[str],
                   name: str, language_column: str = "lang") -> DataFrame:
    """Texts in one language, renamed and keyed."""
    rows = rename_project(only_language(texts, language_column, language), meta)
    return assign_keys(dim, processed_project(rows, meta), keys, name)


def plant_dimension(plants: DataFrame, reporting: DataFrame, regions: DataFrame, kind: Column,
                    postcodes: DataFrame | None = None) -> DataFrame:
    """Plants and depots with their reporting plant, region text and plant flag.

    plants: plant, name, region, postcode; reporting: depot, report_plant; regions: region, region_name.
    A plant without a reporting plant reports to itself.
    """
    out = lookup(plants, reporting, [("plant", "depot")], ["report_plant"])
    out = out.withColumn("report_plant", F.coalesce("report_plant", "plant"))
    out = lookup(out, plants, [("report_plant", "plant")], [("name", "report_plant_name")])
    out = lookup(out, regions, ["region"], ["region_name"])
    if postcodes is not None:
        out = lookup(out, postcodes, ["plant"], [("postcode", "__postcode")])
        out = out.withColumn("postcode", F.coalesce("__postcode", "postcode")).drop("__postcode")
    return out.withColumn("is_plant", kind)


def customer_dimension(customers: DataFrame, areas: DataFrame, offices: DataFrame, groups: DataFrame,
                       kinds: list[tuple[str, str]]) -> DataFrame:
    """Customers with their smallest sales area, office text, group and sales type.

    areas: customer, division, office; offices: office, office_name; groups: customer, group;
    ``kinds`` maps a LIKE pattern of the office text to the sales type.
    """
    least = areas.groupBy("customer").agg(F.min("division").alias("division"), F.min("office").alias("office"))
    out = lookup(customers, least, ["customer"], ["division", "office"])
    out = lookup(out, offices, ["office"], ["office_name"])
    out = lookup(out, groups, ["customer"], ["group"])
    kind = first_match([(F.col("office_name").like(p), k) for p, k in kinds], DEFAULT_MEMBER)
    return out.withColumns({
        "group": F.coalesce("group", "customer"),
        "division": F.coalesce(F.col("division").cast("string"), F.lit("-1")),
        "sales_type": kind,
    })


def product_dimension(products: DataFrame, attributes: DataFrame, mapping: dict[str, str], order: list,
                      lookups: list[tuple[DataFrame, str, list[str]]], classification: Column) -> DataFrame:
    """Products with attribute columns, looked-up texts and a class.

    attributes: product, attribute, value; each lookup is (frame, key column, taken columns).
    """
    wide = attributes_to_columns(attributes, ["product"], "attribute", "value", mapping, order)
    out = lookup(products, wide, ["product"], list(mapping.values()))
    for frame, key, taken in lookups:
        out = lookup(out, frame, [key], taken)
    return out.withColumn("classification", classification)


def territory_dimension(links: DataFrame, scope: list[str], levels: list[str] = TERRITORY_LEVELS) -> DataFrame:
    """Parent/child geography to one row per lowest unit with all levels.

    links: scope columns, unit_type, unit, parent. Missing levels become the default member,
    the plain text is kept beside it, and the access string names line, state and sale type.
    """
    typed = links.withColumn("unit_type", F.replace(F.upper("unit_type"), F.lit(" "), F.lit("_")))
    low = levels[0]
    members = typed.where(F.col("unit_type") == low.upper()).select(*scope, F.col("unit").alias(low)).distinct()
    out = climb(members, typed, levels, scope=scope)
    out = out.withColumns({f"{l}_txt": F.col(l) for l in levels})
    out = out.fillna(DEFAULT_MEMBER, subset=levels)
    return out.withColumn("access", access_string()) if {"product_line", "sale_type"} <= set(out.columns) else out


def latest_person(persons: DataFrame, key: str, begin: str) -> DataFrame:
    """The row of each person's latest begin date."""
    return pick_row(persons, [key], [F.col(begin)], latest=True)


def vendor_dimension(vendors: DataFrame, groups: DataFrame, language: str) -> DataFrame:
    rows = only_language(vendors, "lang", language)
    return lookup(rows, only_language(groups, "lang", language), ["account_group"], ["group_name"])


def keyed_with_texts(members: DataFrame, texts: list[tuple[DataFrame, str, str, str]], keys: list[str], dim: DataFrame,
                     name: str, language: str | None = None) -> DataFrame:
    """Members with looked-up texts and a surrogate: services, chapters, storage locations, ledger accounts and the like.

    Each text is (frame, key column, text column, new name); with ``language`` only texts of that
    language count.
    """
    out = members
    for frame, key, text, new in texts:
        frame = only_language(frame, "lang", language) if language else frame
        out = lookup(out, frame.groupBy(key).agg(F.min(text).alias(text)), [key], [(text, new)])
    return assign_keys(dim, out, keys, name)


def with_created_date(versions: DataFrame, key: str, changed: str, created: str = "created_date") -> DataFrame:
    """Every version of a member with the date the member was first changed on."""
    first = versions.groupBy(key).agg(F.min(changed).alias(created))
    return lookup(versions, first, [key], [created])


def order_dimension(orders: DataFrame, key: str, quantity: str, date: str) -> DataFrame:
    """Production orders with their total quantity and first date."""
    return orders.groupBy(key).agg(F.sum(quantity).alias(quantity), F.min(date).alias(date))
