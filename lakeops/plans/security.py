"""Row-level-security maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import DEFAULT_MEMBER
from ..operators.joins import lookup

# Product lines without geography that any grant on them covers.
OTHER_LINES = ("OTHERS", "SBU1_OTHERS", "SBU2_OTHERS", "SBU3_OTHERS")


def access_string(line: str = "product_line", state: str = "state", sale_type: str = "sale_type"):
    return F.concat_ws("_", line, state, sale_type)


def user_grants(members: DataFrame, grants: DataFrame, group: str = "group", take: list[str] | None = None) -> DataFrame:
    """Grants of each user's groups; a group without grants keeps its users with nulls."""
    take = take or [c for c in grants.columns if c != group]
    return lookup(members, grants, [group], take)


def expand_sales_grants(grants: DataFrame, territory: DataFrame, others: tuple[str, ...] = OTHER_LINES) -> DataFrame:
    """State, zone and global grants to the access strings they open.

    grants: user, geo_unit, geo_unit_type, product_line, sale_type; territory: state, zone,
    product_line, sale_type. The territory is unfolded once to (level, unit) rows; a grant on
    an 'others' line has no access string.
    """
    texts = ["geo_unit", "geo_unit_type", "product_line", "sale_type"]
    wanted = grants.withColumns({c: F.upper(c) for c in texts}).fillna({"sale_type": DEFAULT_MEMBER})
    wanted = wanted.withColumn("__unit", F.when(F.col("geo_unit_type") == "GLOBAL", F.lit("*")).otherwise(
        F.col("geo_unit")))
    row = lambda level, unit: F.struct(F.lit(level).alias("__level"), unit.alias("__u"))
    places = territory.select(
        "product_line", "sale_type", access_string().alias("access"),
        F.inline(F.array(row("STATE", F.upper("state")), row("ZONE", F.upper("zone")),
                         row("GLOBAL", F.lit("*"))))).distinct()
    opened = lookup(wanted, places, ["product_line", "sale_type", ("geo_unit_type", "__level"), ("__unit", "__u")],
                    ["access"], how="inner")
    columns = ["user", "product_line", "sale_type", "access"]
    rest = wanted.where(F.col("product_line").isin(*others)).withColumn("access", F.lit(None).cast("string"))
    return opened.select("user", *texts, "access").distinct().select(*columns).unionByName(rest.select(*columns))
