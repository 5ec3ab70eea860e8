"""Rows that fall into validity intervals, found by search instead of comparing with every interval.

The versions of a key are laid out like the pages of a sorted index. A page holds those that begin
in one stretch of days and those that have begun before and still hold when it starts; a root per
key lists the stretches that have a page. A row finds its page by binary search in the root of its
key: the last page that starts no later than its date has all versions that may cover it. That makes
two equi joins, each of which takes a row to one row however many versions its key has. Catalyst
broadcasts the index where it is small, AQE splits a hot key, and pages of a key are spread anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Days of a page. Versions that do not overlap begin on different days, so a page has few.
STRETCH_DAYS = 64
#: Stretches from the first day to the last one, rounded up to a power of two.
MOST_STRETCHES = 1 << 16

# The first and last date there is, for versions that are open at both ends.
FIRST_DAY = "0001-01-01"
LAST_DAY = "9999-12-31"


def _stretch(day: Column) -> Column:
    return F.floor(F.unix_date(day) / STRETCH_DAYS)


def _how_many(root: Column, stretch: Column) -> Column:
    """How many of a root's stretches are not after the given one, by binary search in as many steps as its size has bits."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(MOST_STRETCHES.bit_length()))])
    bits = F.length(F.bin(F.size(root)))
    return F.aggregate(F.slice(steps, -bits, bits), F.lit(0), lambda at, step: F.when(
        F.get(root, at + step - 1) <= stretch, at + step).otherwise(at))


def roots(versions: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, __root): for each key with versions the sorted stretches in which usable ones begin."""
    begins = F.when(F.col(start) <= F.col(end), _stretch(F.col(start)))
    return versions.groupBy(*keys).agg(F.sort_array(F.collect_set(begins)).alias("__root"))


def pages(versions: DataFrame, root: DataFrame, keys: list[str], start: str, end: str, members: list[str]) -> DataFrame:
    """(keys, __stretch, __page): the versions that begin in a stretch or reach into it.

    Versions that do not overlap reach into one page besides their own at most; one that others
    begin under stands in the page of each such stretch, as rows there have it in their result.
    """
    usable = versions.where(F.col(start) <= F.col(end)).join(root, keys)
    first = _how_many(F.col("__root"), _stretch(F.col(start)))
    count = _how_many(F.col("__root"), _stretch(F.col(end))) - first + 1
    each = usable.select(*keys, F.struct(*members).alias("__m"), F.explode(F.slice("__root", first, count)).alias("__stretch"))
    return each.groupBy(*keys, "__stretch").agg(F.collect_list("__m").alias("__page"))


def covering(items: DataFrame, versions: DataFrame, keys: list[tuple[str, str]], date: str, valid_from: str,
             valid_to: str, take: list[tuple[str, str]], keep_unmatched: bool = True) -> DataFrame:
    """Each item once for every version of its key that covers its date.

    ``keys`` pairs item and version columns, ``take`` maps version columns to new names. A version
    with both ends null covers every date, even a null one; one with a single null end, or with
    its ends reversed, covers none. An item that no version covers stays, with nulls; with
    ``keep_unmatched=False`` it stays only if its key has no version at all. Null keys have none.
    Dates are compared as dates.
    """
    k = [f"__k{i}" for i in range(len(keys))]
    names = [f"__t{i}" for i in range(len(take))]
    open_ends = F.col(valid_from).isNull() & F.col(valid_to).isNull()
    own = versions.select(
        *[F.col(r).alias(n) for n, (_, r) in zip(k, keys)],
        F.when(open_ends, F.lit(FIRST_DAY)).otherwise(F.col(valid_from)).cast("date").alias("__from"),
        F.when(open_ends, F.lit(LAST_DAY)).otherwise(F.col(valid_to)).cast("date").alias("__to"),
        open_ends.alias("__open"), *[F.col(c).alias(n) for n, (c, _) in zip(names, take)]).dropna(subset=k)
    root = roots(own, k, "__from", "__to")
    page = pages(own, root, k, "__from", "__to", ["__from", "__to", "__open", *names])

    day = F.col(date).cast("date")
    rooted = items.join(root, [items[l] == root[n] for n, (l, _) in zip(k, keys)], "left").drop(*k)
    at = _stretch(F.coalesce(day, F.lit(FIRST_DAY).cast("date")))
    rooted = rooted.withColumn("__at", F.get("__root", _how_many(F.col("__root"), at) - 1))
    met = rooted.join(page, [*[rooted[l] == page[n] for n, (l, _) in zip(k, keys)], rooted["__at"] == page["__stretch"]], "left")
    hits = F.filter("__page", lambda m: day.between(m["__from"], m["__to"]) | m["__open"])
    out = met.select(*[F.col(c) for c in items.columns], F.col("__root").isNotNull().alias("__has"), F.explode_outer(hits).alias("__m"))
    if not keep_unmatched:
        out = out.where("__m is not null or not __has")
    return out.select(*[F.col(c) for c in items.columns], *[F.col(f"__m.{n}").alias(new) for n, (_, new) in zip(names, take)])
