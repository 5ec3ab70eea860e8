"""Validity intervals against a comparison of every item with every version."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.operators import intervals, joins

VERSIONS = "k string, a date, b date, w int"
ITEMS = "id int, k string, d date"


def day(n):
    return dt.date(2019, 12, 1) + dt.timedelta(n)


def brute(items, versions, keep_unmatched=True):
    out = []
    for i, k, d in items:
        own = [v for v in versions if v[0] == k and k is not None]
        hits = [w for _, a, b, w in own if (a is None and b is None) or (
            d is not None and a is not None and b is not None and a <= d <= b)]
        if hits:
            out += [(i, w) for w in hits]
        elif keep_unmatched or not own:
            out.append((i, None))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def drawn(seed, length, keys=6):
    """Versions with gaps, overlaps, open and half-open and reversed ends, repeats; keys without any; null keys and dates."""
    rng = random.Random(seed)
    versions = []
    for w in range(120):
        k = rng.choice([None, *[f"k{i}" for i in range(keys)]])
        a = rng.randint(0, 900)
        b = a + rng.randint(-3, length)
        versions.append((k, day(a), day(b), w))
    versions += [("half", None, day(5), 900), ("half", day(5), None, 901), ("open", None, None, 902), ("far", day(3), dt.date(9999, 12, 31), 903),
                 ("far", dt.date(1, 1, 1), day(1), 904), versions[0], ("k0", None, None, 905) if seed % 2 else ("k9", None, None, 905)]
    items = [(i, rng.choice([None, "none", "half", "open", "far", *[f"k{j}" for j in range(keys)]]),
              None if rng.random() < 0.03 else day(rng.randint(-100, 1100))) for i in range(400)]
    return items, versions


@pytest.mark.parametrize("seed,length", [(1, 5), (2, 60), (3, 400), (4, 2000)])
@pytest.mark.parametrize("keep", [True, False])
def test_all_covering_versions_are_found(spark, seed, length, keep):
    items, versions = drawn(seed, length)
    got = joins.effective_dated(spark.createDataFrame(items, ITEMS), spark.createDataFrame(versions, VERSIONS),
                                ["k"], "d", "a", "b", ["w"], keep_unmatched=keep)
    assert rows(got.select("id", "w")) == brute(items, versions, keep)


@pytest.mark.parametrize("keep", [True, False])
def test_more_overlapping_versions_than_a_page_holds(spark, keep):
    versions = [("k", day(i % 50), day(i % 50 + 30 + i % 7), i) for i in range(150)] + [("k", day(200 + i), day(200 + i), 1000 + i) for i in range(100)]
    items = [(i, "k", day(i - 5)) for i in range(400)] + [(900, "none", day(0)), (901, "k", None)]
    got = joins.effective_dated(spark.createDataFrame(items, ITEMS), spark.createDataFrame(versions, VERSIONS),
                                ["k"], "d", "a", "b", [("w", "value")], keep_unmatched=keep)
    assert rows(got.select("id", "value")) == brute(items, versions, keep)


def test_pages_hold_what_begins_in_them_or_reaches_into_them(spark):
    """Stretches are 64 days, counted from 1970; one version alone is not repeated through the years it holds."""
    start = dt.date(1970, 1, 1)
    at = lambda n: start + dt.timedelta(n)
    v = spark.createDataFrame([("k", at(0), at(5), 1), ("k", at(6), at(70), 2), ("k", at(71), at(10_000), 3), ("k", at(20_000), at(20_001), 4)], VERSIONS)
    root = intervals.roots(v, ["k"], "a", "b")
    assert root.first()["__root"] == [0, 1, 312]
    got = intervals.pages(v, root, ["k"], "a", "b", ["w"]).collect()
    assert {r["__stretch"]: sorted(m["w"] for m in r["__page"]) for r in got} == {0: [1, 2], 1: [2, 3], 312: [4]}


def test_empty_sides(spark):
    items, versions = drawn(1, 60)
    none = spark.createDataFrame([], VERSIONS)
    got = joins.effective_dated(spark.createDataFrame(items, ITEMS), none, ["k"], "d", "a", "b", ["w"], keep_unmatched=False)
    assert got.count() == len(items) and got.where("w is not null").count() == 0
    assert joins.effective_dated(spark.createDataFrame([], ITEMS), spark.createDataFrame(versions, VERSIONS), ["k"], "d", "a", "b", ["w"]).count() == 0


@pytest.fixture
def shuffled(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def join_rows(df):
    """Rows out of each join of the executed plan."""
    df.write.format("noop").mode("overwrite").save()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    df.collect()
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        if "Join" in name:
            found.append(int(node.metrics().get("numOutputRows").get().value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_no_row_is_multiplied_by_a_key_with_100_000_versions(shuffled):
    """One key has 100,000 versions, each of one day, and most of the items: every join has one row an item."""
    versions = shuffled.range(100_000).select(F.lit("hot").alias("k"), F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")).alias("a"),
                                              F.col("id").cast("int").alias("w")).withColumn("b", F.col("a"))
    items = shuffled.range(3000).select("id", F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("k"),
                                        F.date_add(F.lit("1800-01-01").cast("date"), (F.col("id") * 37 % 110_000).cast("int")).alias("d"))
    got = joins.effective_dated(items, versions, ["k"], "d", "a", "b", ["w"])
    counts = join_rows(got)
    assert counts and all(c <= 100_000 for c in counts) and counts.count(3000) == 2
    wrong = got.where("k = 'hot' and not (w <=> if(id * 37 % 110000 < 100000, id * 37 % 110000, null))").count()
    assert wrong == 0 and got.count() == 3000
    # The index takes a version to two rows at most, and its pages are grouped by key and stretch.
    own = versions.withColumnsRenamed({"a": "start", "b": "end"})
    root = intervals.roots(own, ["k"], "start", "end")
    page = intervals.pages(own, root, ["k"], "start", "end", ["w"])
    assert page.agg(F.sum(F.size("__page"))).first()[0] <= 200_000
    assert page.count() > 1500 and page.agg(F.max(F.size("__page"))).first()[0] <= 65
