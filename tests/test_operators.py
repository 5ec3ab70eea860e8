import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from lakeops.functions import columns as c, dates as d, ordering
from lakeops.operators import calendar, ingest, joins, keys, reconcile, reshape, upsert, windows
from lakeops.operators.ingest import ColumnMeta
from lakeops.operators.keys import KeyMapping


def day(text):
    return dt.date.fromisoformat(text)


# --- ingest -------------------------------------------------------------------------------


def test_cast_by_metadata_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame(
        [("1", "20210401", "101530", "12.50", "44287"), ("x", "01-04-2021", "", "abc", "n"), (None, "20211301", "250000", "1", None)],
        "id string, d string, t string, amount string, serial string")
    meta = [ColumnMeta("", "id", "int"), ColumnMeta("", "d", "date"), ColumnMeta("", "t", "time"), ColumnMeta("", "amount", "decimal(13,2)")]
    got = ingest.cast_by_meta(df, meta).select("id", "d", F.date_format("t", "HH:mm:ss"), "amount", d.serial_date("serial")).collect()
    assert [tuple(r) for r in got] == [
        (1, day("2021-04-01"), "10:15:30", Decimal("12.50"), day("2021-04-01")), (None, None, None, None, None),
        (None, None, None, Decimal("1.00"), None)]


def test_blank_helpers(spark):
    df = spark.createDataFrame([("",), (" ",), ("a",), (None,)], "v string")
    got = df.select("v", c.blank_to_null("v"), c.is_blank("v"), c.default_member("v")).collect()
    assert [tuple(r) for r in got] == [("", None, True, "<DEFAULT>"), (" ", " ", True, "<DEFAULT>"),
                                       ("a", "a", False, "a"), (None, None, True, "<DEFAULT>")]


def test_only_whole_numbers_lose_their_fraction(spark):
    texts = ["12.0", "-3.0", "3", "abc", "lot 7.0", "000123", "12345678901234567890", "12345678901234567890.0", "7.5", "1.00", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, a string")
    got = [r["a"] for r in ingest.integral_text(df, ["a"]).orderBy("i").collect()]
    assert got == ["12", "-3", *texts[2:7], "12345678901234567890", *texts[8:]]


def test_schema_grows(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(2, "b", "1.5")], "id int, v string, extra string")
    assert ingest.new_columns(old, new) == ["extra"]
    assert rows(ingest.evolve_schema(old, new)) == [(1, "a", None), (2, "b", Decimal("1.50"))]
    assert rows(ingest.evolve_schema(ingest.evolve_schema(old, new), old)) [0] == (1, "a", None)


@pytest.mark.parametrize("mark,inclusive,expected", [("", False, 3), (None, False, 3), ("2", False, 1), ("2", True, 2)])
def test_watermark(spark, mark, inclusive, expected):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert ingest.since_watermark(df, "v", mark, inclusive).count() == expected


# --- keys ---------------------------------------------------------------------------------


def test_keys_are_dense_unique_and_stable(spark):
    empty = spark.createDataFrame([], "code string, region string, k long")
    first = spark.range(5000).select(F.concat(F.lit("c"), (F.col("id") % 3000).cast("string")).alias("code"),
                                     F.when(F.col("id") % 2 == 0, "x").alias("region"))
    one = keys.assign_keys(empty, first, ["code", "region"], "k")
    assert one.count() == 5000
    dim = one.distinct().cache()
    numbers = sorted(r["k"] for r in dim.collect())
    assert numbers == list(range(1, dim.count() + 1))
    more = first.unionByName(spark.createDataFrame([("new", None), (None, None), ("new", None)], "code string, region string"))
    two = keys.assign_keys(dim, more, ["code", "region"], "k").distinct()
    kept = two.join(dim, ["k"], "inner").count()
    assert kept == dim.count()
    assert sorted(r["k"] for r in two.collect()) == list(range(1, dim.count() + 3))


def test_lookup_sentinels_and_row_count(spark):
    fact = spark.createDataFrame([(1, "a", "x"), (2, "", "x"), (3, " ", None), (4, None, "y"), (5, "zz", "x")], "id int, code string, other string")
    dim = spark.createDataFrame([("a", 10), ("a", 11), ("b", 12)], "code string, code_key long")
    other = spark.createDataFrame([("x", 1)], "other string, other_key long")
    got = keys.lookup_keys(fact, {"d": dim, "o": other}, [
        KeyMapping.parse("code", "code", "code_key", "code_key", "d"), KeyMapping.parse("other", "other", "other_key", "other_key", "o")])
    assert rows(got) == [(1, 10, 1), (2, -2, 1), (3, -2, -2), (4, -2, -1), (5, -1, 1)]


def test_keys_under_several_surrogates_are_named(spark):
    dim = spark.createDataFrame([("a", "x", 10), ("a", "x", 11), ("a", "x", 11), ("b", None, 12), ("b", None, 7), ("c", "x", 1), ("c", "x", 1)], "p string, q string, k long")
    assert rows(keys.repeated_members(dim, ["p", "q"], "k")) == [("a", "x", 2, 10), ("b", None, 2, 7)]


def test_composite_and_nullsafe_lookup(spark):
    fact = spark.createDataFrame([(1, "a", None), (2, "a", "b"), (3, "q", "b")], "id int, x string, y string")
    dim = spark.createDataFrame([("a", None, 7), ("a", "b", 8)], "x string, y string, k long")
    mapping = KeyMapping.parse("x|y", "x|y", "k", "k", "d")
    assert rows(keys.lookup_key(fact, dim, mapping, sentinels=False).select("id", "k")) == [(1, None), (2, 8), (3, None)]
    assert rows(keys.lookup_nullsafe(fact, dim, mapping).select("id", "k")) == [(1, -2), (2, 8), (3, -1)]
    junk = keys.junk_dimension(fact, ["x", "y"], "j")
    assert keys.lookup_junk(fact, junk, ["x", "y"], "j").where("j IS NULL").count() == 0


# --- upsert -------------------------------------------------------------------------------


def test_null_keys_merge_only_when_told(spark):
    target = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k1 string, k2 string, v int")
    source = spark.createDataFrame([("a", None, 9), ("c", "y", 3)], "k1 string, k2 string, v int")
    assert upsert.upsert(target, source, ["k1", "k2"]).count() == 4
    merged = upsert.upsert(target, source, ["k1", "k2"], nullable=True)
    assert rows(merged) == [("a", None, 9), ("b", "x", 2), ("c", "y", 3)]
    assert rows(upsert.upsert(merged, source, ["k1", "k2"], nullable=True)) == rows(merged)


def test_batch_duplicates(spark):
    batch = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "only")], "k int, seq int, v string")
    assert rows(upsert.duplicate_keys(batch, ["k"])) == [(1, 2)]
    assert rows(upsert.latest_of_batch(batch, ["k"], [F.col("seq")])) == [(1, 2, "new"), (2, 1, "only")]


# --- joins --------------------------------------------------------------------------------


def test_effective_dates(spark):
    items = spark.createDataFrame([(1, "m", day("2020-01-01")), (2, "m", day("2020-01-31")), (3, "m", day("2020-02-15")),
                                   (4, "none", day("2020-01-01")), (5, "open", day("1999-01-01"))], "id int, mat string, date date")
    rates = spark.createDataFrame([("m", day("2020-01-01"), day("2020-01-31"), 1), ("m", day("2020-03-01"), day("2020-12-31"), 2),
                                   ("open", None, None, 3)], "mat string, a date, b date, w int")
    keep = joins.effective_dated(items, rates, ["mat"], "date", "a", "b", ["w"]).select("id", "w")
    assert rows(keep) == [(1, 1), (2, 1), (3, None), (4, None), (5, 3)]
    lose = joins.effective_dated(items, rates, ["mat"], "date", "a", "b", ["w"], keep_unmatched=False).select("id", "w")
    assert rows(lose) == [(1, 1), (2, 1), (4, None), (5, 3)]


def test_anti_join_ignores_nulls_in_the_list(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(joins.anti(left, right, ["k"])) == [(None,), (2,)]
    assert rows(joins.anti(left, right, ["k"], null_safe=True)) == [(2,)]
    assert rows(joins.semi(left, right, ["k"], null_safe=True)) == [(None,), (1,)]


def test_repeated_role_does_not_multiply(spark):
    partners = spark.createDataFrame([("d", "AG", "1"), ("d", "AG", "2"), ("d", "WE", "3"), ("e", "ZZ", "4")], "doc string, role string, party string")
    got = joins.role_columns(partners, ["doc"], "role", {"AG": "sold", "WE": "ship"}, ["party"])
    assert rows(got) == [("d", "2", "3")]


def test_reversed_documents_come_once(spark):
    docs = spark.createDataFrame([(1, 2), (2, 1), (3, None), (4, 3)], "doc int, rev int")
    got = joins.with_reversed(docs.where("doc IN (1, 4)"), docs, ["doc"], ["rev"])
    assert rows(got.select("doc")) == [(1,), (2,), (3,), (4,)]


def test_climb_keeps_missing_levels(spark):
    links = spark.createDataFrame([("pin", "p1", "d1"), ("PIN", "p2", "d2"), ("district", "d1", "s1")], "unit_type string, unit string, parent string")
    members = spark.createDataFrame([("p1",), ("p2",)], "pin string")
    assert rows(joins.climb(members, links, ["pin", "district", "state"])) == [("p1", "d1", "s1"), ("p2", "d2", None)]


# --- windows ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belong to key 0, and days repeat."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"), (F.col("id") % 17).cast("int").alias("day"),
        F.col("id"), (F.col("id") % 11).cast("decimal(8,2)").alias("v")).cache()


@pytest.mark.parametrize("descending", [False, True])
def test_blocked_running_sum_equals_the_plain_one(skewed, descending):
    order = F.col("day").desc() if descending else F.col("day")
    got = windows.running_sum(skewed, ["k"], [order, "id"], {"s": "v"}, block="day", block_descending=descending)
    w = Window.partitionBy("k").orderBy(order, "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("s", F.sum("v").over(w))
    assert rows(got.select("id", "s")) == rows(want.select("id", "s"))


@pytest.mark.parametrize("order", [["day", "id"], ["-day", "id"], ["-day", "-id"], ["id"]])
@pytest.mark.parametrize("before", [False, True])
def test_blocks_found_by_sampling_change_nothing(skewed, order, before):
    gaps = skewed.withColumns({"v": F.when(F.col("id") % 5 != 0, F.col("v")), "k": F.when(F.col("k") != 3, F.col("k"))})
    measures = {"s": ("sum", "v"), "n": ("count", "v"), "high": ("max", "v"), "low": ("min", "v")}
    columns = ["id", *measures]
    got = windows.running(gaps, ["k"], order, measures, before=before)
    want = windows.running(gaps, ["k"], order, measures, before=before, bounded=True)
    assert got.schema == want.schema and rows(got.select(columns)) == rows(want.select(columns))
    w = Window.partitionBy("k").orderBy(*[F.col(o.lstrip("-")).desc() if o.startswith("-") else F.col(o) for o in order])
    lag = gaps.withColumn("p", F.lag("v").over(w)).select("id", "p")
    assert rows(windows.previous(gaps, ["k"], order, "v", "p").select("id", "p")) == rows(lag)


def test_running_over_nulls_empty_tables_and_all_types(spark):
    df = spark.createDataFrame(
        [(i, None if i % 7 == 0 else f"k{i % 2}", None if i % 5 == 0 else day("2020-01-01") + dt.timedelta(i % 9),
          dt.datetime(2020, 1, 1, 0, 0, 0, i), None if i % 4 == 0 else float(i), Decimal(i)) for i in range(120)],
        "id int, k string, d date, ts timestamp, x double, m decimal(20,3)")
    for order in (["d", "id"], ["-d", "id"], ["ts"], ["x", "id"], ["m"]):
        got = windows.running(df, ["k"], order, {"n": ("count", "id"), "t": ("sum", "id")})
        want = windows.running(df, ["k"], order, {"n": ("count", "id"), "t": ("sum", "id")}, bounded=True)
        assert rows(got.select("id", "n", "t")) == rows(want.select("id", "n", "t"))
    assert windows.running(df.limit(0), ["k"], ["d"], {"n": ("count", "id")}).count() == 0
    with pytest.raises(ValueError):
        windows.running(df, ["k"], [F.col("d").desc()], {"n": ("count", "id")})


def test_running_sum_without_keys(skewed):
    got = windows.running_sum(skewed, [], ["day", "id"], {"s": "v"}, block="day")
    assert got.agg(F.max("s")).first()[0] == skewed.agg(F.sum("v")).first()[0]


def test_blocked_lag_equals_the_plain_one(skewed):
    with_gap = skewed.withColumn("v", F.when(F.col("id") % 5 != 0, F.col("v")))
    got = windows.previous(with_gap, ["k"], ["day", "id"], "v", "p", block="day")
    want = windows.previous(with_gap, ["k"], ["day", "id"], "v", "p")
    assert rows(got.select("id", "p")) == rows(want.select("id", "p"))


def test_first_event_ties_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "a", 2), (4, None, 5), (5, None, 6)], "id int, k string, o int")
    got = windows.first_event_flag(df, ["k"], ["o"], "f")
    assert rows(got.select("id", "f")) == [(1, 1), (2, 1), (3, 0), (4, 1), (5, 0)]


def test_pick_row_and_latest(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 1), (2, None, 3), (2, "z", 2)], "k int, v string, o int")
    assert rows(windows.pick_row(df, ["k"], [F.col("o")])) == [(1, "a", 1), (2, "z", 2)]
    assert rows(windows.all_latest(df, ["k"], "o").select("k", "v")) == [(1, "a"), (1, "b"), (2, None)]
    assert rows(windows.with_group_size(df, ["k"], "n").select("n").distinct()) == [(2,)]


def test_year_to_date_resets(spark):
    df = spark.createDataFrame([("a", day("2020-02-01"), 1), ("a", day("2020-03-01"), 2), ("a", day("2020-04-01"), 4)], "k string, m date, v int")
    assert [r["s"] for r in windows.year_to_date(df, ["k"], "m", {"s": "v"}).orderBy("m").collect()] == [1, 3, 7]
    assert [r["s"] for r in windows.year_to_date(df, ["k"], "m", {"s": "v"}, d.fiscal_year("m")).orderBy("m").collect()] == [1, 3, 4]


# --- reshape ------------------------------------------------------------------------------


def sheet(spark):
    months = ", ".join(f"{m} decimal(13,2)" for m in d.FISCAL_MONTHS)
    values = [Decimal(i) for i in range(1, 13)]
    full = ("p1", 2021, *values)
    holes = ("p2", 2021, values[0], None, values[2], *[None] * 9)
    return spark.createDataFrame([full, holes], f"plant string, fy int, {months}")


@pytest.mark.parametrize("year_is,april,march", [("end", "2020-04-01", "2021-03-01"), ("start", "2021-04-01", "2022-03-01"),
                                                 ("calendar", "2021-04-01", "2021-03-01")])
def test_fiscal_sheet_years(spark, year_is, april, march):
    got = reshape.fiscal_sheet(sheet(spark), ["plant"], "fy", year_is=year_is).where("plant = 'p1'")
    by_no = {r["month_no"]: r["month"] for r in got.collect()}
    assert by_no[4] == day(april) and by_no[3] == day(march) and len(by_no) == 12


def test_months_after_the_last_filled_one_are_cut(spark):
    got = reshape.fiscal_sheet(sheet(spark).where("plant = 'p2'"), ["plant"], "fy")
    assert [(r["month_no"], r["value"]) for r in got.orderBy("month").collect()] == [(4, Decimal("1.00")), (5, None), (6, Decimal("3.00"))]
    with pytest.raises(ValueError):
        reshape.fiscal_sheet(sheet(spark), ["plant"], "fy", year_is="other")


def test_pivot_then_unpivot_is_identity(spark):
    long = spark.createDataFrame([("p", "A", 1), ("p", "B", 2), ("q", "B", 3)], "plant string, label string, v int")
    wide = reshape.pivot_sums(long, ["plant"], "label", ["A", "B", "C"], {"v": F.sum("v")}, fill=None)
    assert wide.columns == ["plant", "A", "B", "C"]
    assert rows(reshape.unpivot(wide, ["plant"], name="label", value="v", drop_null=True)) == rows(long)


def test_day_sheet_drops_days_the_month_lacks(spark):
    df = spark.createDataFrame([("p", 2021, 4, 5, 7), ("p", 2021, 5, None, 8)], "plant string, year int, month int, `30` int, `31` int")
    got = reshape.day_sheet(df, ["plant"], "year", "month", days=["30", "31"])
    assert rows(got) == [("p", day("2021-04-30"), 5), ("p", day("2021-05-31"), 8)]


def test_quarters_and_pairs(spark):
    q = spark.createDataFrame([("p", 2021, 1, 2, 3, 4)], "plant string, fy int, Q1 int, Q2 int, Q3 int, Q4 int")
    got = reshape.quarter_budgets(q, ["plant"], "fy").select("quarter", "month", "budget")
    assert rows(got) == [("Q1", day("2020-04-01"), 1), ("Q2", day("2020-07-01"), 2), ("Q3", day("2020-10-01"), 3), ("Q4", day("2021-01-01"), 4)]
    r = spark.createDataFrame([("p", 1, 2.0, 3, 4.0)], "plant string, X_RATING int, X_VALUE double, Y_RATING int, Y_VALUE double")
    assert rows(reshape.paired_unpivot(r, ["plant"], ["X", "Y"], ["RATING", "VALUE"])) == [("p", "X", 1, 2.0), ("p", "Y", 3, 4.0)]


def test_attributes_take_the_first_and_skip_unmapped(spark):
    df = spark.createDataFrame([("o", "A", "x", 2), ("o", "A", "w", 1), ("o", "Z", "q", 1), ("n", "B", "b", 1)], "obj string, attr string, val string, seq int")
    got = reshape.attributes_to_columns(df, ["obj"], "attr", "val", {"A": "a", "B": "b"}, ["seq"])
    assert rows(got) == [("n", None, "b"), ("o", "w", None)]


def test_group_is_one_text_unless_parts_are_asked_for(spark):
    df = spark.range(2500).select(F.lit("hot").alias("k"), "id").unionByName(spark.createDataFrame([("cold", 0)], "k string, id long"))
    whole = {r["k"]: r["t"] for r in reshape.concat_rows(df, ["k"], "id", F.col("id").cast("string"), ",", "t").collect()}
    assert whole == {"cold": "0", "hot": ",".join(map(str, range(2500)))}
    got = reshape.concat_rows(df, ["k"], "id", F.col("id").cast("string"), ",", "t", F.floor(F.col("id") / 1000))
    parts = {(r["k"], r["part_no"]): r["t"] for r in got.collect()}
    assert parts[("cold", 0)] == "0" and len(parts) == 4
    assert ",".join(parts[("hot", i)] for i in range(3)) == ",".join(map(str, range(2500)))


def test_flag_pairs_need_both_sides(spark):
    df = spark.createDataFrame([("p", "ACTUAL", 1, 10), ("p", "BUDGET", 2, 20), ("q", "ACTUAL", 3, 30)], "plant string, f string, a int, b int")
    got = reshape.flag_pairs(df, ["plant"], "f", ["ACTUAL", "BUDGET"], ["a", "b"])
    assert rows(got) == [("p", "a", 1, 2), ("p", "b", 10, 20)]


def test_split_rows_trims_and_drops_empty(spark):
    df = spark.createDataFrame([(1, "a, b,,c "), (2, None)], "id int, plants string")
    assert rows(reshape.split_rows(df, "plants", ",", "plant", ["id"])) == [(1, "a"), (1, "b"), (1, "c")]


def test_labels(spark):
    df = spark.createDataFrame([("Pre-Packing  cost",), ("Yield %",)], "l string")
    assert [r[0] for r in df.select(c.clean_label("l")).collect()] == ["PREPACKING_COST", "YIELD_PERCEN"]


# --- calendar -----------------------------------------------------------------------------


def test_calendar_against_strftime(spark):
    got = {r["date_dt"]: r for r in calendar.calendar(calendar.fixed_days(spark, "2019-04-01", "2021-06-30")).collect()}
    assert min(got) == day("2019-04-01") and max(got) == day("2021-06-30") and len(got) == 822
    for date, r in got.items():
        assert r["week_of_yr_num"] == int(date.strftime("%U"))
        assert r["day_name"] == date.strftime("%A") and r["day_of_yr_num"] == int(date.strftime("%j"))
        assert r["fy_name"] == (date.year if date.month >= 4 else date.year - 1)
    counter, name, number = 1, 1, {}
    for date in sorted(got):
        week = min((date.day + 6) // 7, 4)
        if week != name:
            counter, name = counter + 1, week
        number[date] = counter
    assert all(got[x]["wk_sort"] == number[x] for x in got)


def test_calendar_started_inside_a_month(spark):
    got = calendar.calendar(calendar.fixed_days(spark, "2020-01-16", "2020-02-02")).orderBy("date_dt").collect()
    assert [got[0]["wk_sort"], got[6]["wk_sort"], got[-1]["wk_sort"]] == [2, 3, 4]


def test_monthly_values_repeat_per_day(spark):
    monthly = spark.createDataFrame([("a", day("2020-02-01"), 7)], "k string, m date, v int")
    got = calendar.repeat_daily(monthly, "m", calendar.fixed_days(spark, "2020-01-15", "2020-03-15"))
    assert got.count() == 29 and got.agg(F.sum("v")).first()[0] == 7 * 29


@pytest.mark.parametrize("today,closing", [("2024-03-15", "2024-02-29"), ("2024-01-01", "2023-12-31")])
def test_closing_day(today, closing):
    assert d.previous_month_end(today) == closing


def test_a_sheet_without_values_keeps_no_period(spark):
    df = spark.createDataFrame([("p", 1, None), ("p", 2, None)], "k string, n int, v int")
    assert reshape.until_last_filled(df, "n", "v").collect() == []


# --- order columns as one number ----------------------------------------------------------


def test_packed_numbers_order_like_their_columns(spark):
    stamp = dt.datetime
    rows_ = [(i, a, b, c_, e, f, g) for i, (a, b, c_, e, f, g) in enumerate([
        (None, None, None, None, None, None), (True, -2**63, day("0001-01-01"), stamp(1, 1, 2), Decimal("-99.99"), -1),
        (False, 2**63 - 1, day("9999-12-31"), stamp(9999, 12, 30, 23, 59, 59, 999999), Decimal("99.99"), 127),
        (True, 0, day("1970-01-01"), stamp(1970, 1, 1, 0, 0, 0, 1), Decimal("0.00"), 0), (True, 0, day("1969-12-31"), stamp(1969, 12, 31, 23, 59, 59, 999999), Decimal("-0.01"), -128),
        (False, 0, None, stamp(2020, 2, 29, 12, 30, 15, 5), Decimal("0.01"), 5), (None, 5, day("2020-01-01"), stamp(2020, 2, 29, 12, 30, 15, 4), None, None)])]
    df = spark.createDataFrame(rows_, "i int, a boolean, b bigint, c date, e timestamp_ntz, f decimal(4,2), g tinyint")
    df = df.withColumn("h", F.col("e").cast("timestamp"))
    for columns in (["a", "b"], ["b"], ["c", "b"], ["e", "b"], ["h", "b"], ["f", "g", "c"], ["g", "f"], ["e"], ["a", "c", "f", "g"], ["c", "e"]):
        number = ordering.packed(df, columns)
        order = [r["i"] for r in df.orderBy(number, "i").collect()]
        assert order == [r["i"] for r in df.orderBy(*columns, "i").collect()], columns
        assert df.select(number.alias("n")).distinct().count() == df.select(*columns).distinct().count()
    assert ordering.packed(df, ["b", "e", "g"]) is None and ordering.packed(df.withColumn("t", F.lit("x")), ["t"]) is None
    assert "Struct" not in str(ordering.rank(df, ["c", "b"])) and df.agg(F.min(ordering.rank(df, ["b", "e", "g"]))).count() == 1


# --- reconcile and audit ------------------------------------------------------------------


@pytest.mark.parametrize("buckets", [1, 4096])
def test_differences_by_key(spark, buckets):
    columns = "k int, g string, v string"
    left = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, None, None), (4, "a", "x"), (5, "d", "x"), (5, "d", "x"), (None, "n", "1")], columns)
    right = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, None), (5, "d", "x"), (6, "a", "x"), (None, "n", "2"), (3, "", None)], columns)
    got = reconcile.differences(left, right, ["k", "g"], buckets=buckets)
    assert rows(got) == sorted([(2, "a", "different", 1, 1), (4, "a", "missing_in_right", 1, 0), (5, "d", "different", 2, 1), (None, "n", "different", 1, 1),
                                (6, "a", "missing_in_left", 0, 1), (3, "", "missing_in_left", 0, 1)], key=lambda r: [(v is not None, str(v)) for v in r])
    assert reconcile.differences(left, left.repartition(5), ["k", "g"], buckets=buckets).collect() == []
    assert rows(reconcile.missing_keys(left, right, ["k"])) == [(4, "right"), (6, "left")]
    assert reconcile.differences(left.limit(0), left.limit(0), ["k"]).collect() == []


def test_audit_counts_are_taken_during_the_write(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else f"v{i}", i * 10) for i in range(20)], "k int, v string, at int")
    written = []
    got = ingest.audited_load(df, "t", lambda d: written.append(d) or d.write.parquet(str(tmp_path / "t")), F.col("v").isNotNull(), "at")
    assert [tuple(r) for r in got.collect()] == [("t", 20, 5, 15, "190")] and len(written) == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 15
    none = ingest.audited_load(df.limit(0), "t", lambda d: d.write.parquet(str(tmp_path / "u")), None, "at")
    assert [tuple(r) for r in none.collect()] == [("t", 0, 0, 0, None)]
    plain = ingest.audited_load(df, "t", lambda d: d.write.parquet(str(tmp_path / "w")))
    assert [tuple(r) for r in plain.collect()] == [("t", 20, 0, 20, None)]
