"""Ordered computations that stay spread out when one key holds much of the data."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import as_col, null_safe
from ..functions.ordering import rank


def first_event_flag(df: DataFrame, keys: list[str], order: list[str], flag: str) -> DataFrame:
    """1 on the earliest row(s) of each key, else 0; rows equal in every order column tie.

    The earliest row is found by a partially aggregated minimum and matched back on key and
    order columns together, so a hot key is neither sorted nor collected in one task.
    """
    place = F.col(order[0]) if len(order) == 1 else rank(df, order)
    placed = df.withColumn("__place", place)
    firsts = placed.groupBy(*keys).agg(F.min("__place").alias("__first"))
    right = firsts.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__first", F.lit(1).alias("__hit"))
    condition = null_safe([placed[k] for k in keys] + [placed["__place"]], [right[f"__k_{k}"] for k in keys] + [right["__first"]])
    return placed.join(right, condition, "left").select(
        *[placed[c] for c in df.columns if c != flag], F.coalesce(right["__hit"], F.lit(0)).alias(flag))


def first_date_flag(df: DataFrame, keys: list[str], date: str, flag: str) -> DataFrame:
    """Flag every row on the key's first date."""
    return first_event_flag(df, keys, [date], flag)


def pick_row(df: DataFrame, keys: list[str], order: list[Column], latest: bool = False) -> DataFrame:
    """One whole row per key: the least (or greatest) by ``order``, then by all columns.

    The row number's limit is applied before the shuffle as well, so each map task sends one row
    per key at most; both sides sort. Measured against a minimum of structs, which sorts too, this
    is a third faster where keys are nearly unique.
    """
    rest = [*order, *[F.col(c) for c in df.columns if c not in keys]]
    by = [c.desc_nulls_last() if latest else c.asc_nulls_first() for c in rest]
    if not by:
        return df.distinct()
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("__number", number).where("__number = 1").drop("__number")


def all_latest(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Every row carrying its key's highest version; equal versions are all kept."""
    newest = df.groupBy(*keys).agg(F.max(version).alias("__version"))
    right = newest.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__version")
    condition = null_safe([df[k] for k in keys] + [df[version]],
                          [right[f"__k_{k}"] for k in keys] + [right["__version"]])
    return df.join(right, condition, "left_semi")


#: Blocks that ordered rows are cut into, and rows sampled for each to find where.
BLOCKS = 256
SAMPLED = 64


def _order(order: list[str | Column]) -> list[Column]:
    """Sort columns: a name rises, nulls first; a name after ``-`` falls, nulls last; a column is taken as it is."""
    return [o if not isinstance(o, str) else F.col(o[1:]).desc_nulls_last() if o.startswith("-") else F.col(o).asc_nulls_first()
            for o in order]


def order_blocks(df: DataFrame, keys: list[str], order: list[str | Column], blocks: int = BLOCKS) -> tuple[Column, bool]:
    """(block, falling): a number that cuts the ordered rows into about ``blocks`` even parts.

    It never turns back along the order within a key, so what a part adds up to can be carried to
    the parts behind it, and rows of a hot key lie in as many parts as their share of all rows
    asks for. The bounds are (key, order) values of a sample of ``SAMPLED`` rows a block, found
    before the plan runs: the input's keys and order columns are read once for it, next to a count.
    Every row finds its part by binary search in that constant list. Only the leading columns of
    ``order`` that run the same way count; rows that are equal in them cannot be parted.
    """
    if not isinstance(order[0], str):
        raise ValueError("name the leading order column, or give a block")
    falling = order[0].startswith("-")
    lead = []
    for o in order:
        if not isinstance(o, str) or o.startswith("-") != falling:
            break
        lead.append(o.lstrip("-"))
    place = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate([*keys, *lead])])
    places = df.select(place.alias("place"))
    share = min(1.0, blocks * SAMPLED / max(1, places.count()))
    sample = places.sample(share, seed=blocks) if share < 1 else places
    found = sample.agg(F.to_json(F.sort_array(F.collect_list("place"))).alias("places")).first()["places"]
    sampled = json.loads(found)
    bounds = [sampled[i * len(sampled) // blocks] for i in range(1, blocks)] if sampled else []
    kind = f"array<{places.schema['place'].dataType.simpleString()}>"
    listed = F.sort_array(F.from_json(F.lit(json.dumps(bounds)), kind))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(blocks.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(listed, at + step - 1) <= place, at + step).otherwise(at)), falling


# How a value over earlier blocks and one inside the block make one; nulls are left out of all.
_TOGETHER = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)), "count": (F.count, lambda a, b: F.coalesce(a, F.lit(0)) + b),
    "max": (F.max, F.greatest), "min": (F.min, F.least)}


def running(df: DataFrame, keys: list[str], order: list[str | Column], measures: dict[str, tuple[str, str]],
            block: str | Column | None = None, block_descending: bool = False, before: bool = False,
            bounded: bool = False) -> DataFrame:
    """Running ``sum``, ``count``, ``max`` or ``min`` per key over the rows up to and including the current one.

    ``measures`` maps the new column to (function, column); with ``before`` the current row does
    not count. What each block of a key comes to is aggregated first (map-side combined, one row
    per key and block) and carried forward over the few blocks of the key; only rows of one block
    are ordered together. A block is what ``order_blocks`` cuts, so a key that holds all rows is
    spread like any other input; a ``block`` given instead must only move one way along the order,
    such as the date that leads it, and spares the sample. ``bounded`` says that no key has more
    rows than a calendar or a horizon gives it: then it is one window, without blocks.
    """
    frame = (Window.unboundedPreceding, -1 if before else Window.currentRow)
    if bounded:
        w = Window.partitionBy(*keys).orderBy(*_order(order)).rowsBetween(*frame)
        return df.withColumns({out: _TOGETHER[fn][0](c).over(w) for out, (fn, c) in measures.items()})
    if block is None:
        block, block_descending = order_blocks(df, keys, order)
    blocked = df.withColumn("__block", as_col(block))
    totals = blocked.groupBy(*keys, "__block").agg(*[_TOGETHER[fn][0](c).alias(f"__s_{out}") for out, (fn, c) in measures.items()])
    step = F.col("__block").desc() if block_descending else F.col("__block").asc()
    ahead = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    again = lambda fn: F.sum if fn == "count" else _TOGETHER[fn][0]
    carried = totals.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__block").alias("__k_block"),
        *[again(fn)(f"__s_{out}").over(ahead).alias(f"__c_{out}") for out, (fn, _) in measures.items()])
    condition = null_safe([blocked[k] for k in keys] + [blocked["__block"]],
                          [carried[f"__k_{k}"] for k in keys] + [carried["__k_block"]])
    joined = blocked.join(carried, condition, "inner")
    w = Window.partitionBy(*keys, "__block").orderBy(*_order(order)).rowsBetween(*frame)
    kinds = df.select(*[_TOGETHER[fn][0](c).alias(out) for out, (fn, c) in measures.items()]).schema
    return joined.select(*[blocked[c] for c in df.columns], *[
        _TOGETHER[fn][1](F.col(f"__c_{out}"), _TOGETHER[fn][0](c).over(w)).cast(kinds[out].dataType).alias(out)
        for out, (fn, c) in measures.items()])


def running_sum(df: DataFrame, keys: list[str], order: list[str | Column], measures: dict[str, str],
                block: str | Column | None = None, block_descending: bool = False, bounded: bool = False) -> DataFrame:
    """Running totals (rows up to and including the current one) per key, as ``running`` spreads them.

    ``measures`` maps the new column to the summed one.
    """
    return running(df, keys, order, {out: ("sum", c) for out, c in measures.items()}, block, block_descending, bounded=bounded)


def year_to_date(df: DataFrame, keys: list[str], date: str, measures: dict[str, str],
                 reset: Column | None = None, block: str | Column | None = None, bounded: bool = False) -> DataFrame:
    """Running total over periods; ``reset`` (such as the fiscal year) starts it anew."""
    if reset is None:
        return running_sum(df, keys, [date], measures, block, bounded=bounded)
    reset_by = df.withColumn("__reset", reset)
    return running_sum(reset_by, [*keys, "__reset"], [date], measures, block, bounded=bounded).drop("__reset")


def previous(df: DataFrame, keys: list[str], order: list[str | Column], column: str, name: str,
             block: str | Column | None = None, block_descending: bool = False) -> DataFrame:
    """The value of the row before, null on the first.

    Only rows of one block are ordered together, as in ``running``; a block's first row takes the
    value of the last row of the block before, of which each map task sends one.
    """
    if block is None:
        block, block_descending = order_blocks(df, keys, order)
    blocked = df.withColumn("__block", as_col(block))
    w = Window.partitionBy(*keys, "__block").orderBy(*_order(order))
    backwards = Window.partitionBy(*keys, "__block").orderBy(*[_reversed(i, o) for i, o in enumerate(order)])
    lasts = blocked.select(*keys, "__block", *_names(order), F.col(column).alias("__last")).withColumn(
        "__number", F.row_number().over(backwards)).where("__number = 1")
    step = F.col("__block").desc() if block_descending else F.col("__block").asc()
    carried = lasts.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__block").alias("__k_block"),
        F.lag("__last").over(Window.partitionBy(*keys).orderBy(step)).alias("__carried"))
    condition = null_safe([blocked[k] for k in keys] + [blocked["__block"]],
                          [carried[f"__k_{k}"] for k in keys] + [carried["__k_block"]])
    value = F.when(F.row_number().over(w) == 1, F.col("__carried")).otherwise(F.lag(column).over(w))
    return blocked.join(carried, condition, "inner").select(*[blocked[c] for c in df.columns], value.alias(name))


def _names(order: list[str | Column]) -> list[Column]:
    """The order's columns, under names that clash with no key."""
    return [F.col(o.lstrip("-")).alias(f"__o_{i}") for i, o in enumerate(order)]


def _reversed(i: int, o: str) -> Column:
    return F.col(f"__o_{i}").asc_nulls_first() if o.startswith("-") else F.col(f"__o_{i}").desc_nulls_last()


#: A group that holds more than this share of the rows is hot; there are at most so many of them.
HOT_GROUPS = 4096


def with_group_size(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows per key on every row, by a map-side combined count and a join that hot groups do not load.

    Sizes of groups with more than 1/``HOT_GROUPS`` of all rows, which are no more than that many,
    are broadcast; for the join with the other sizes rows of hot groups are dealt by their own hash,
    so that no task holds a hot group whether or not AQE splits it.
    """
    return with_group_values(df, keys, {name: F.count(F.lit(1))})


def with_group_values(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """What ``values`` aggregate to per key on every row of the key, spread as ``with_group_size`` says."""
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__all_rows"), *[v.alias(n) for n, v in values.items()])
    totals = totals.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__all_rows", *[F.col(n).alias(f"__v_{n}") for n in values])
    total = totals.agg(F.sum("__all_rows").alias("all")).scalar()
    is_hot = F.col("__all_rows") * HOT_GROUPS > total
    hot = totals.where(is_hot).select(*[F.col(f"__k_{k}").alias(f"__h_{k}") for k in keys],
                                      *[F.col(f"__v_{n}").alias(f"__hot_{n}") for n in values], F.lit(True).alias("__hot"))
    marked = df.join(F.broadcast(hot), null_safe([df[k] for k in keys], [hot[f"__h_{k}"] for k in keys]), "left")
    dealt = F.when(F.col("__hot"), F.xxhash64(*[df[c] for c in df.columns], F.spark_partition_id())).otherwise(F.lit(0))
    marked = marked.withColumn("__deal", dealt)
    # A zero that the optimizer does not see through: the join must keep it as a key.
    rest = totals.where(~is_hot).withColumn("__none", F.pmod("__all_rows", F.lit(1)))
    same = null_safe([F.col(k) for k in keys], [F.col(f"__k_{k}") for k in keys]) & (F.col("__deal") == F.col("__none"))
    return marked.join(rest, same, "left").select(
        *[F.col(c) for c in df.columns if c not in values], *[F.coalesce(f"__hot_{n}", f"__v_{n}").alias(n) for n in values])


def repeat_rows(df: DataFrame, n: int, name: str) -> DataFrame:
    """Each row n times with its copy number 1..n."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(n))))


def top_distinct(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.select(column).distinct().orderBy(F.col(column).desc()).limit(n)
