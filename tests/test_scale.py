"""Behaviour that matters when one key holds a third of the rows."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeops.operators import joins, keys, reconcile, reshape, windows
from lakeops.plans import finance, procurement, sales, stock
from lakeops.session import SHARED_KEYS_CONF, TASK_CONF, bound_tasks, tune
from lakeops.workload.core import items_of, laid_by


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_join_key_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    tune(spark)
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), F.col("id").alias("v"))
        dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("name"))
        out = joins.lookup(fact, dim, ["k"], ["name"])
        assert "skew=true" in executed(out)
        assert out.where("name IS NULL").count() == 0 and out.count() == 200_000
    finally:
        for key in settings:
            spark.conf.unset(key)
        tune(spark)


@pytest.mark.parametrize("block", ["day", None])
def test_no_window_sorts_a_whole_hot_key(spark, block):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).cast("int").alias("day"), "id")
    for out in (windows.running_sum(df, ["k"], ["day", "id"], {"s": "id"}, block),
                windows.previous(df, ["k"], ["day", "id"], "id", "p", block)):
        text = out._jdf.queryExecution().optimizedPlan().toString()
        parts = [line.split("], [")[1] for line in text.splitlines() if line.strip(" +-:").startswith("Window ")]
        # Item rows are ordered per (key, block); only what blocks come to is ordered per key alone.
        assert len(parts) >= 2 and sum("__block" not in p for p in parts) == 1


def test_one_key_with_all_rows_is_cut_into_even_blocks(spark):
    df = spark.range(100_000).select(F.lit("k").alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), F.expr("cast(sqrt(id) as int)")).alias("d"), "id")
    for order in (["d", "id"], ["-d", "-id"]):
        block, falling = windows.order_blocks(df, ["k"], order)
        sizes = df.groupBy(block.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).orderBy("b").collect()
        assert falling == order[0].startswith("-") and len(sizes) > 250 and max(r["n"] for r in sizes) < 5 * 100_000 / 256
        assert all(a["high"] < b["low"] for a, b in zip(sizes, sizes[1:]))
    # The leading columns that run the same way; what is equal in them stays together.
    block, falling = windows.order_blocks(df, ["k"], ["-d", "id"])
    sizes = df.groupBy(block.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert falling and len(sizes) > 150 and max(r["n"] for r in sizes) < 8 * 100_000 / 256


def test_many_keys_add_few_blocks(spark):
    """Blocks follow key and order together: a key that is small has one or two, not one for each bound."""
    df = spark.range(20_000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("o"))
    block, _ = windows.order_blocks(df, ["k"], ["o"])
    assert df.select("k", block.alias("b")).distinct().count() <= 2000 + 256


def test_numbering_orders_only_buckets(spark):
    members = spark.range(20_000).select(F.col("id").cast("string").alias("code"))
    out = keys.number_members(members, ["code"], "k")
    assert out.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first() == (1, 20_000, 20_000)
    assert out.groupBy(F.substring(F.md5("code"), 1, 3)).count().agg(F.max("count")).first()[0] < 30



@pytest.fixture
def no_help(spark):
    """Neither broadcasts by estimate nor AQE's skew join."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    tune(spark)


def test_sizes_of_a_group_with_half_of_all_rows_load_no_task(no_help):
    df = no_help.range(0, 100_000, 1, 8).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id").union(
        no_help.range(5000).select(F.lit(None).cast("bigint"), "id"))
    out = windows.with_group_size(df, ["k"], "n")
    got = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert got < 2 * 105_000 / 32
    sizes = {r["k"]: (r["n"], r["rows"]) for r in out.groupBy("k", "n").agg(F.count(F.lit(1)).alias("rows")).where("n > 1").collect()}
    assert sizes == {7: (50_001, 50_001), None: (5000, 5000)} and out.count() == 105_000


def test_equal_tables_shuffle_checksums_only(no_help):
    df = no_help.range(0, 200_000, 1, 4).select((F.col("id") % 150_000).alias("k"), F.col("id").cast("string").alias("v"))
    spark_plan = reconcile.differences(df, df.repartition(3), ["k"])
    rows_of, todo = [], [spark_plan._jdf.queryExecution().executedPlan()]
    assert spark_plan.collect() == []
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.toString():
            rows_of.append(int(node.metrics().get("shuffleRecordsWritten").get().value()))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    # One row for each part and map task; no row of the tables themselves.
    assert rows_of and max(rows_of) <= reconcile.BUCKETS * 8


def test_rows_with_a_null_key_are_dealt_out(no_help):
    """Without a spread all of them would meet in one task of the join."""
    left = no_help.range(0, 40_000, 1, 4).select("id", F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"), F.lit("u").alias("unit"))
    right = no_help.range(0, 40_000, 8).select(F.col("id").alias("rk"), F.lit("u").alias("unit"), (F.col("id") * 2).alias("v"))
    right = right.union(no_help.range(1).select(F.lit(None).cast("bigint"), F.lit("u"), F.lit(1).cast("bigint")))
    plain = joins.lookup(left, right, ["unit", ("k", "rk")], ["v"])
    out = joins.lookup(left, right, ["unit", ("k", "rk")], ["v"], spread="id")
    assert out.columns == plain.columns and out.exceptAll(plain).count() == plain.exceptAll(out).count() == 0
    load = lambda df: df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert load(plain) >= 30_000 and load(out) < 2 * 40_000 / 32


def test_postings_without_order_stay_out_of_the_join(no_help):
    lines = no_help.range(0, 20_000, 1, 4).select("id", F.when(F.col("id") % 4 == 0, F.col("id")).alias("order"),
                                                  F.lit("2020-01-02").cast("date").alias("posted"))
    lines = lines.union(no_help.sql("SELECT -1, null, date'2020-01-03'"))
    orders = no_help.range(0, 20_000, 8).select(F.col("id").alias("order"), F.lit("2019-05-05").cast("date").alias("day"))
    out = finance.adjusted_posting_date(lines, orders, "order", "posted", "day")
    assert out.columns == [*lines.columns, "adjusted_date"]
    assert out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0] < 5000
    got = {str(r[0]): r[1] for r in out.groupBy("adjusted_date").count().collect()}
    assert got == {"2019-05-05": 2500, "2020-01-02": 17_500, "2020-01-03": 1}


def test_estimates_do_not_broadcast_what_grows(spark):
    """A file's size says little about its rows, still less behind an explode."""
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        bound_tasks(spark)
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == str(256 * 1024)
        assert all(spark.conf.get(k) == v for k, v in TASK_CONF.items())
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        bound_tasks(spark)
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "-1"
    finally:
        for key in [*TASK_CONF, "spark.sql.autoBroadcastJoinThreshold"]:
            spark.conf.unset(key)


def test_conditional_sums_move_longs(spark):
    """Sums are exact beyond a long, for negative values and where nothing hits."""
    d = spark.sql("""SELECT * FROM VALUES (1, 'a', cast(9999999999999999.99 AS decimal(18,2))), (1, 'a', cast(-0.01 AS decimal(18,2))),
        (1, 'b', cast(-5.55 AS decimal(18,2))), (1, 'b', null), (2, null, cast(7 AS decimal(18,2))), (null, 'a', cast(1.5 AS decimal(18,2))) t(k, c, v)""")
    many = d.unionAll(spark.range(2000).select(F.lit(3), F.lit("a"), F.lit("9999999999999999.99").cast("decimal(18,2)")))
    out = reshape.conditional_sums(many, ["k"], {"a": (F.col("c") == "a", F.col("v")), "b": (F.col("c") == "b", F.col("v")), "p": (F.col("c") == "a", F.col("v") * F.col("v"))})
    old = many.groupBy("k").agg(*[reshape.sum_when(F.col("c") == x, v).alias(n) for n, x, v in (("a", "a", F.col("v")), ("b", "b", F.col("v")), ("p", "a", F.col("v") * F.col("v")))])
    assert out.schema.simpleString() == old.schema.simpleString()
    assert {tuple(r) for r in out.where("k < 3 OR k IS NULL").collect()} == {tuple(r) for r in old.where("k < 3 OR k IS NULL").collect()}
    big = reshape.conditional_sums(many, ["k"], {"a": (F.col("c") == "a", F.col("v"))}).where("k = 3").first()["a"]
    assert big == 2000 * Decimal("9999999999999999.99")
    text = reshape.conditional_sums(d, ["k"], {"a": (F.col("c") == "a", F.col("v"))})._jdf.queryExecution().optimizedPlan().toString()
    assert "& 4294967295" in text


def test_requisitions_are_moved_before_they_are_grouped(no_help):
    """Their keys hardly repeat: grouped where they are read, a task would hold all keys of its part."""
    schedule = no_help.sql("SELECT * FROM VALUES (1, 1, 7, 0), (1, 1, 7, 1), (2, 1, 8, 0), (3, 1, null, 0) t(doc, item, requisition, requisition_item)")
    requisitions = no_help.sql("""SELECT requisition, requisition_item, cast(day AS date) AS release_date, deleted FROM VALUES (7, 0, '2020-01-01', null),
        (7, 0, '2020-03-01', null), (7, 1, '2020-02-01', ' '), (8, 0, '2020-01-05', 'L'), (null, 0, '2020-01-09', null) t(requisition, requisition_item, day, deleted)""")
    out = procurement.release_dates(schedule, requisitions, ["doc", "item"])
    assert sorted((r["doc"], str(r["release_date"])) for r in out.collect()) == [(1, "2020-03-01"), (2, "None"), (3, "None")]
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    moved = next(i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line)
    assert not [line for line in lines[moved:] if "Aggregate" in line]


def test_measures_are_sorted_and_joined_as_longs(spark):
    """Decimals are made of the sums after the last join; no condition, no hit and negative sums count as before."""
    item = "1L AS material, 1L AS plant, cast(2 AS decimal(18,2)) AS quantity, cast(10 AS decimal(18,2)) AS net, cast(1 AS decimal(18,2)) AS tax"
    items = spark.sql(f"SELECT doc, line, {item} FROM VALUES (1L, 1), (1L, 2), (2L, 1) t(doc, line)")
    headers = spark.sql("SELECT doc, date'2020-01-05' AS date, 1L AS sold_to, 1L AS payer, '1000' AS org, '' AS cancelled FROM VALUES (1L), (2L) t(doc)")
    partners = spark.sql("SELECT 1L AS doc, '1' AS role, 9L AS party")
    money = lambda x: f"cast({x} AS decimal(18,2))"
    conditions = spark.sql(f"""SELECT doc, line, code, billing_type, {money('value')} AS value, {money('rate')} AS rate FROM VALUES
        (1L, 1, 'ZF00', 'F2', 90071992547409.93, 1.25), (1L, 1, 'ZF00', 'F2', -0.01, null), (1L, 1, 'ZD01', 'ZFOC', 5.5, 2.5),
        (1L, 2, 'ZF05', 'F2', null, null), (null, 1, 'ZF00', 'F2', 3, 3) t(doc, line, code, billing_type, value, rate)""")
    weights = spark.createDataFrame([(1, None, None, 1.5)], "material long, valid_from date, valid_to date, weight double")
    plants = spark.createDataFrame([(1, 1, 2)], "plant long, is_plant int, report_plant int")
    measures = [m for m in sales.INVOICE_MEASURES if m.name in ("freight", "zf00", "zd01", "jkfc_rate", "p_jexp", "zrdf")]
    out = sales.invoice_fact(items, headers, partners, {"1": "payer"}, conditions, measures, weights, plants, ("material",))
    d = Decimal
    names = [m.name for m in measures]
    assert names == ["freight", "jkfc_rate", "p_jexp", "zrdf", "zf00", "zd01"]
    kinds = [f"decimal({p},{s})" for p, s in ((23, 2), (24, 3), (24, 3), (24, 3), (23, 2), (23, 2))]
    assert [out.schema[n].dataType.simpleString() for n in names] == kinds
    assert [tuple(r[n] for n in names) for r in out.orderBy("doc", "line").collect()] == [
        (d("90071992547415.42"), d("0.375"), d("0"), d("3.750"), d("90071992547409.92"), d("-5.50")), (d("0"),) * 6, (d("0"),) * 6]
    alone = sales.condition_measures(conditions, ["doc", "line"], measures)
    assert [alone.schema[n].dataType.simpleString() for n in names] == kinds
    nothing = alone.where("doc = 1 AND line = 2").first()
    assert (nothing["zf00"], nothing["freight"], nothing["zrdf"]) == (0, 0, None)
    text = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    sums = next(line for line in text if "Aggregate" in line and "zd01" in line)
    assert "decimal(20,0)" not in sums


def test_no_interpreted_methods(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        bound_tasks(spark)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        for key in TASK_CONF:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_days_of_the_plan_stay_with_their_plant_and_material(no_help):
    """Joined by month and by date, then summed up day by day, without moving; made and cured are matched at once."""
    q = no_help.sql
    grid = q("SELECT plant, material, explode(sequence(date'2020-01-30', date'2020-02-02')) AS date FROM (SELECT DISTINCT * FROM VALUES (1L, 'a'), (1L, 'b') t(plant, material))")
    opening = q("SELECT 1L AS plant, material, 10.0D AS good, 20.0D AS opening, 3L AS depot_opening FROM VALUES ('a'), ('z') t(material)")
    month_plan = q("""SELECT 1L AS plant, material, date'2020-02-01' AS month, 5.0D AS sales_plan, 1.0D AS sales, 52.0D AS transfer_plan,
        0.0D AS transferred, 2.0D AS depot_plan, 0.0D AS depot_sales FROM VALUES ('a'), ('z') t(material)""")
    split = q("SELECT 1L AS plant, day_no, 50 AS plant_percent, 100 AS depot_percent FROM VALUES (1), (2), (30), (31) t(day_no)")
    made = q("SELECT 1L AS plant, 'a' AS material, date'2020-01-31' AS date, quantity FROM VALUES (4.0D), (2.0D), (null) t(quantity)")
    done = q("SELECT 1L AS plant, material, date'2020-01-16' AS date, 7.0D AS quantity FROM VALUES ('a'), (null) t(material)")
    try:
        bound_tasks(no_help, SHARED_KEYS_CONF)
        out = stock.daily_plan(grid, opening, month_plan, split, made, done)
        rows = [tuple(r)[3:] for r in out.where("material = 'a'").orderBy("date").collect()]
        assert rows == [(0, 0, 0, 20, 3, 10), (6, 0, 0, 26, 3, 17), (0, 2, 2, 22, 3, 13), (0, 2, 2, 18, 3, 9)]
        assert {tuple(r)[3:] for r in out.where("material = 'b'").collect()} == {(0, 0, 0, 0, 0, 0)} and out.count() == 8
        lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
        at = lambda text: next(i for i, line in enumerate(lines) if text in line)
        assert at("Window") < at("SortMergeJoin") < at("Exchange")
        assert len([line for line in lines if "SortMergeJoin" in line]) == 4
        bound_tasks(no_help)
        assert no_help.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    finally:
        for key in TASK_CONF:
            no_help.conf.unset(key)


def exchanges(node) -> list[tuple[str, set[str]]]:
    """(partitioning, names of the columns moved) of each exchange that is written; one that is read again counts once."""
    found = [exchanges(node.children().apply(i)) for i in range(node.children().size())]
    own = [(node.outputPartitioning().toString(), {node.output().apply(i).name() for i in range(node.output().size())})]
    return own * (node.nodeName() == "Exchange") + [e for part in found for e in part]


def test_rows_laid_by_a_key_are_moved_once_for_all_readers(no_help):
    rows = "(1L, 1, 5L, 7L, 1.5, 'N'), (1L, 1, 4L, 9L, 2.5, 'R'), (2L, 1, 6L, 8L, null, null), (null, 1, 6L, 8L, 4.0, 'N')"
    lines = no_help.sql(f"SELECT * FROM VALUES {rows} t(l_orderkey, l_linenumber, l_partkey, l_suppkey, price, l_returnflag)")
    no_help.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        laid = laid_by(lines, "l_orderkey")
        items = items_of(laid).select("l_orderkey", "partkey", "price")
        flags = laid.where("l_returnflag <> 'R'").groupBy("l_orderkey").agg(F.max("l_suppkey").alias("top"))
        out = joins.lookup(items, flags, ["l_orderkey"], ["top"])
        assert sorted(tuple(r) for r in out.collect()) == [(1, 4, Decimal("4.0"), 7), (2, 6, None, None)]
        assert len(exchanges(out._jdf.queryExecution().executedPlan())) == 1
    finally:
        no_help.conf.set("spark.sql.adaptive.enabled", "true")


def test_invoice_lines_stay_with_their_document(no_help):
    """Only what plants and weights are looked up by is moved, once per document; repeated headers, plants and versions multiply lines as joins do."""
    q = no_help.sql
    money = lambda x: f"cast({x} AS decimal(18,2))"
    items = q(f"""SELECT doc, line, material, plant, {money(2)} AS quantity, {money('net')} AS net, {money(1)} AS tax FROM VALUES (1L, 1, 1L, 1L, 10),
        (1L, 2, 1L, 1L, 11), (1L, 2, 1L, 1L, 11), (1L, 3, null, 2L, 12), (2L, 1, 2L, null, 13), (2L, null, 1L, 3L, 14), (3L, 1, 1L, 1L, 15) t(doc, line, material, plant, net)""")
    headers = q("""SELECT doc, cast(day AS date) AS date, 1L AS sold_to, 1L AS payer, org, '' AS cancelled FROM VALUES (1L, '2020-01-05', 'a'), (1L, '2020-01-05', 'b'),
        (1L, '2021-01-05', 'a'), (2L, null, 'a') t(doc, day, org)""")
    partners = q("SELECT 1L AS doc, '1' AS role, 9L AS party")
    conditions = q(f"SELECT 1L AS doc, 2 AS line, 'ZF00' AS code, {money(3)} AS value")
    weights = q("""SELECT material, cast(a AS date) AS valid_from, cast(b AS date) AS valid_to, weight FROM VALUES (1L, '2020-01-01', '2020-12-31', 1.5),
        (1L, '2020-01-05', '2020-01-05', 2.5), (2L, null, null, 3.5) t(material, a, b, weight)""")
    plants = q("SELECT * FROM VALUES (1L, 1, 2L), (2L, 0, 2L), (2L, 0, 2L) t(plant, is_plant, report_plant)")
    measures = [sales.Measure("zf00", ("ZF00",))]
    no_help.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        bound_tasks(no_help, SHARED_KEYS_CONF)
        by_doc = [df.repartition("doc") for df in (items, headers, partners, conditions)]
        out = sales.invoice_fact(*by_doc[:3], {"1": "payer"}, by_doc[3], measures, weights, plants, ("material",))
        assert out.columns == ["doc", "line", "material", "plant", "quantity", "net", "tax", "date", "sold_to", "payer", "org", "cancelled", "payer_party",
                               "is_plant", "report_plant", "weight", "zf00", "total", "weight_mt", "status", "customer_type"]
        plain = lambda v: str(v) if isinstance(v, datetime.date) else float(v) if isinstance(v, Decimal) else v
        got = sorted(repr(tuple(plain(r[c]) for c in ("doc", "line", "net", "date", "org", "is_plant", "weight", "zf00", "payer_party"))) for r in out.collect())
        old, new = [("2020-01-05", "a"), ("2020-01-05", "b")], [("2021-01-05", "a")]
        want = [(1, line, net, *h, 1, w, zf00, 9) for line, net, zf00 in ((1, 10.0, 0.0), (2, 11.0, 3.0), (2, 11.0, 3.0))
                for hs, ws in ((old, (1.5, 2.5)), (new, (None,))) for h in hs for w in ws]
        want += [(1, 3, 12.0, *h, 0, None, 0.0, 9) for h in old + new for _ in range(2)]
        want += [(2, 1, 13.0, None, "a", None, 3.5, 0.0, None), (2, None, 14.0, None, "a", None, None, 0.0, None)]
        assert got == sorted(map(repr, want))
        moved = exchanges(out._jdf.queryExecution().executedPlan())
        assert len([1 for _, columns in moved if "net" in columns]) == 1
        asked = [columns for by, columns in moved if columns & {"material", "__w_material"} and "date" in columns or "__w_date" in columns]
        assert sorted(map(len, asked)) == [4, 5, 7]  # document, material, plant and date: by material, by plant and back
    finally:
        no_help.conf.set("spark.sql.adaptive.enabled", "true")
        for key in TASK_CONF:
            no_help.conf.unset(key)
