import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.operators import calendar
from lakeops.plans import finance, procurement, production, quality, receivables, sales, security, stock, targets


def day(text):
    return dt.date.fromisoformat(text)


D = Decimal

# --- receivables --------------------------------------------------------------------------


def settle_by_hand(items, claims):
    """Oldest debits first, one row at a time."""
    out = {}
    credit = defaultdict(Decimal)
    for customer, _, _, amount in items:
        if amount < 0:
            credit[customer] += amount
    for customer, amount in claims:
        credit[customer] += amount
    for customer in {i[0] for i in items}:
        left = -credit[customer]
        for _, doc, _, amount in sorted((i for i in items if i[0] == customer and i[3] > 0), key=lambda i: (-i[2], i[1])):
            paid = min(left, amount)
            left -= paid
            out[customer, doc] = amount - paid
    return out


def test_fifo_against_row_by_row_settlement(spark):
    rng = random.Random(7)
    items = [(0 if i % 3 == 0 else rng.randrange(1, 20), i, rng.randrange(-5, 30), D(rng.randrange(-300, 500))) for i in range(1500)]
    claims = [(3, D(-2000)), (4, D(-10)), (99, D(-5))]
    df = spark.createDataFrame(items, "customer int, doc int, age int, amount decimal(13,2)")
    extra = spark.createDataFrame(claims, "customer int, claims decimal(13,2)")
    got = receivables.settle_fifo(df, ["doc"], extra).collect()
    want = settle_by_hand(items, claims)
    assert {(r["customer"], r["doc"]): r["balance"] for r in got} == want
    # Per customer the open balance is what credits do not cover.
    for customer in {i[0] for i in items}:
        debit = sum(i[3] for i in items if i[0] == customer and i[3] > 0)
        credit = sum(i[3] for i in items if i[0] == customer and i[3] < 0) + sum(a for c, a in claims if c == customer)
        assert sum(r["balance"] for r in got if r["customer"] == customer) == max(debit + credit, 0)


def test_signs_ages_and_zero_documents(spark):
    df = spark.createDataFrame(
        [(1, "a", "UE", day("2020-01-01"), day("2020-01-05"), "S", D(10)), (1, "b", "RV", day("2020-01-09"), day("2020-01-01"), "H", D(4)),
         (2, "c", "RV", day("2020-01-01"), day("2020-01-01"), "S", D(3)), (2, "c", "RV", day("2020-01-01"), day("2020-01-01"), "H", D(3)),
         (3, "d", "UE", day("2020-01-01"), day("2020-01-20"), "S", D(1))],
        "customer int, doc string, doc_type string, post_date date, doc_date date, dc string, amount decimal(13,2)")
    out = receivables.drop_zero_documents(receivables.signed_items(df, "2020-01-10"), ["customer", "doc"])
    assert rows(out.select("doc", "age", "amount")) == [("a", 5, D(10)), ("b", 2, D(-4)), ("d", -10, D(1))]


@pytest.mark.parametrize("age,label", [(0, "0_to_15_days"), (15, "0_to_15_days"), (16, "16_to_30_days"), (360, "346_to_360_days"),
                                       (361, "361_to_390_days"), (720, "691_to_720_days"), (721, "grtr_than_720_days"), (-1, "grtr_than_720_days")])
def test_age_bucket_bounds(spark, age, label):
    assert spark.range(1).select(receivables.age_bucket(F.lit(age))).first()[0] == label
    if age < 0:
        assert spark.range(1).select(receivables.age_bucket(F.lit(age), not_due=True)).first()[0] == "not_due"


def test_ageing_has_all_buckets(spark):
    assert len(receivables.age_bounds()) == 36
    df = spark.createDataFrame([(1, None, 5, D(7)), (1, "x", -3, D(2)), (1, "x", 400, D(0))], "customer int, line string, age int, balance decimal(13,2)")
    got = receivables.ageing_snapshot(df, ["customer", "line"], "2020-01-01", defaults={"line": "OTHERS"})
    assert len(got.columns) == 2 + 37 + 1
    assert rows(got.select("line", "0_to_15_days", "grtr_than_720_days")) == [("OTHERS", D(7), D(0)), ("x", D(0), D(2))]


def test_unknown_class_is_overdue_at_once(spark):
    balances = spark.createDataFrame([(1, "a", 5, D(7)), (1, "a", 40, D(3)), (2, "z", 0, D(4))], "customer int, line string, age int, balance decimal(13,2)")
    criteria = spark.createDataFrame([("a", 30)], "line string, start_days int")
    got = receivables.overdue_amounts(balances, criteria, ["line"], ["customer"], "2020-01-01")
    assert rows(got.select("customer", "overdue_amount")) == [(1, D(3)), (2, D(4))]


# --- pricing ------------------------------------------------------------------------------


def condition_frame(spark, data):
    return spark.createDataFrame(
        [(doc, code, D(v) if v is not None else None, D(r), D(b), D(fx), grp, terms, org, div) for doc, code, v, r, b, fx, grp, terms, org, div in data],
        "doc string, code string, value decimal(13,2), rate decimal(13,2), base decimal(13,2), fx decimal(9,2), customer_group string, "
        "terms string, org string, division string")


def test_assessable_value_priority(spark):
    row = lambda doc, code, v="10", b="100", fx="2", grp="-": (doc, code, v, "1", b, fx, grp, "EXW", "1000", "11")
    data = [row("direct", "ZASS", "7", grp="17"), row("direct", "JEXP"), row("jexp", "ZASS", "7"), row("jexp", "JEXP"), row("vat", "ZVAT"), row("vat", "JCST", b="50"),
            row("cst", "JCST", b="50"), row("exp", "ZEXP"), row("last", "ZASS", "7"), row("none", "OTHER"), row("null", "ZASS", None)]
    got = {r["doc"]: r["assessable_value"] for r in sales.assessable_value(condition_frame(spark, data), ["doc"]).collect()}
    assert got == {"direct": D(7), "jexp": D(100), "vat": D("87.50"), "cst": D("43.75"), "exp": D(20), "last": D(7), "none": D(0), "null": D(0)}


def test_secondary_freight(spark):
    row = lambda doc, code, v="10", r="3", terms="EXW": (doc, code, v, r, "0", "1", "-", terms, "1000", "11")
    data = [row("both", "ZFRF"), row("both", "ZDFR", r="5"), row("both", "ZCNF", "4"), row("fallback", "ZDFR", r="5"), row("fallback", "ZCNF", "4"),
            row("no base", "ZFRF"), row("paid", "ZFRF", terms="FOR"), row("paid", "ZCNF", "4"), row("no rate", "ZCNF", "4")]
    got = {r["doc"]: r["secondary_freight"] for r in sales.secondary_freight(condition_frame(spark, data), ["doc"]).collect()}
    assert got == {"both": D(12), "fallback": D(20), "no base": D(0), "paid": D(0), "no rate": D(0)}


def test_base_price(spark):
    row = lambda doc, code, v, org="2000", div="23": (doc, code, v, "0", "0", "1", "-", "EXW", org, div)
    data = [row("list", "ZBP4", "50"), row("list", "ZAD1", "5"), row("list elsewhere", "ZBP4", "50", "1000"), row("list elsewhere", "ZAD1", "5", "1000"),
            row("first decides", "ZBP1", "9"), row("first decides", "ZBPB", "8"), row("other", "ZBPB", "8", div="21"), row("any org", "ZBPS", "6", "7777", "99"),
            row("nothing", "XXXX", "1")]
    got = {r["doc"]: r["base_price"] for r in sales.base_price(condition_frame(spark, data), ["doc"]).collect()}
    assert got == {"list": D(55), "list elsewhere": D(50), "first decides": D(0), "other": D(8), "any org": D(6), "nothing": D(0)}


def test_invoice_measures_are_named_once():
    names = [m.name for m in sales.INVOICE_MEASURES]
    assert len(names) == len(set(names)) == 47


def test_first_sale_flags_against_history(spark):
    cols = "customer string, line string, date int, doc int, item int"
    lines = spark.createDataFrame([("a", "x", 1, 10, 1), ("a", "x", 1, 10, 2), ("a", "y", 2, 11, 1), ("b", "x", 3, 12, 1), (None, "x", 4, 13, 1)], cols)
    history = spark.createDataFrame([("b", "z", 0, 1, 1)], cols)
    flags = {"c": ["customer"], "l": ["line"], "p": ["customer", "line"]}
    got = sales.first_sale_flags(lines, flags, ["date", "doc", "item"], history).select("doc", "item", "c", "l", "p")
    assert rows(got) == [(10, 1, 1, 1, 1), (10, 2, 0, 0, 0), (11, 1, 0, 1, 1), (12, 1, 0, 0, 1), (13, 1, 1, 0, 1)]
    assert rows(sales.first_sale_flags(lines, flags, ["date", "doc", "item"]).select("doc", "item", "c"))[3] == (12, 1, 1)


def test_open_orders(spark):
    lines = spark.createDataFrame([(1, 1, day("2020-05-01"), D(10), D(100), "C"), (2, 1, day("2020-05-01"), D(10), D(100), None),
                                   (3, 1, day("2020-05-01"), D(4), D(8), "A"), (4, 1, day("2019-01-01"), D(4), D(8), "A")],
                                  "doc int, item int, date date, quantity decimal(13,2), value decimal(13,2), credit_status string")
    done = spark.createDataFrame([(1, 1, D(3)), (1, 1, D(1)), (3, 1, D(4))], "doc int, item int, delivered decimal(13,2)")
    got = sales.open_orders(lines, done, "2020-03-01", "2020-06-01", ["doc", "item"])
    assert rows(got.select("doc", "balance_quantity", "balance_value", "status", "pending_quantity", "released_value")) == [
        (1, D(6), 60.0, "pending", D(6), 0.0), (2, D(10), 100.0, "released", D(0), 100.0)]


# --- targets ------------------------------------------------------------------------------


def test_spread_targets_add_up(spark):
    days = calendar.calendar(calendar.fixed_days(spark, "2020-04-01", "2021-03-31"))
    grains = ["DAILY", "WEEKLY", "MONTHLY", "QUARTERLY", "HALFYEARLY", "YEARLY"]
    data = [(f"{g}{n}", g, day("2020-05-10"), 100.0 * (n + 1)) for g in grains for n in range(2)]
    df = spark.createDataFrame(data, "id string, target_type string, target_date date, sales double")
    got = targets.spread_to_days(df, days, ["sales"]).groupBy("id").agg(F.sum("sales").alias("s"), F.count("*").alias("n")).collect()
    assert {r["id"]: round(r["s"], 6) for r in got} == {i: s for i, _, _, s in data}
    assert {r["n"] for r in got} == {1, 7, 31, 91, 183, 365}


def test_lift_targets(spark):
    ter = spark.createDataFrame([("l", "p1", "d1", "s1", "n"), ("l", "p2", None, "s1", "n")], "line string, pincode string, district string, state string, zone string")
    df = spark.createDataFrame([(1, "l", "pincode", "p1"), (2, "l", "State", "s1"), (3, "l", "ZONE", "n"), (4, "l", "PINCODE", "p2"), (5, "l", "STATE", "new")],
                               "id int, line string, geo_unit_type string, geo_unit string")
    got = targets.lift_to_levels(df, ter, ["line"], ["PINCODE", "DISTRICT", "STATE", "ZONE"]).select("id", "pincode", "district", "state", "zone")
    x = "<DEFAULT>"
    assert rows(got) == [(1, "p1", "d1", "s1", "n"), (2, x, x, "s1", "n"), (3, x, x, x, "n"), (4, "p2", x, "s1", "n"), (5, x, x, "new", x)]


# --- stock and production -----------------------------------------------------------------


def test_unit_fallbacks(spark):
    df = spark.createDataFrame([("a", "p", 2.0, "EA", day("2020-01-05")), ("b", "p", 2.0, "EA", day("2020-01-05")), ("c", "p", 2.0, "KG", day("2020-01-05")),
                                ("c", "p", 2.0, "EA", day("2020-01-05"))], "material string, plant string, q double, unit string, date date")
    factors = spark.createDataFrame([("a", 3, 2)], "material string, numerator int, denominator int")
    weights = spark.createDataFrame([("b", "p", day("2020-01-01"), day("2020-01-31"), 4.0), ("a", "p", None, None, 9.0)],
                                    "material string, plant string, valid_from date, valid_to date, weight double")
    got = stock.to_unit(df, factors, "q", "kg", fallback=weights, unit="unit").select("material", "unit", "kg")
    assert rows(got) == [("a", "EA", 3.0), ("b", "EA", 8.0), ("c", "EA", None), ("c", "KG", 2.0)]


def test_split_valuated_duplicates_are_left_out(spark):
    held = spark.createDataFrame([("m", "p", 2), ("n", "p", 3), ("o", "p", 4)], "material string, plant string, free int")
    val = spark.createDataFrame([("m", "p", "S", 5, 7, None), ("m", "p", "V", 5, 7, "T"), ("n", "p", "V", 5, 7, "T"), ("o", "p", "X", 5, 7, None)],
                                "material string, plant string, control string, standard_price int, average_price int, val_type string")
    assert rows(stock.valuate(held, val, {"v": "free"}).select("material", "price", "v")) == [("m", 5, 10), ("n", 7, 21), ("o", None, None)]


def test_equal_split_adds_up(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 10.0), (1, 10.0), (2, 4.0)], "order int, q double")
    assert rows(finance.equal_split(df, ["order"], {"q": 3}).select("order", "q_split")) == [(1, 3.333)] * 3 + [(2, 4.0)]


def test_allocation_shares(spark):
    members = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 3.0), ("z", "c", 0.0)], "grp string, member string, w double")
    amounts = spark.createDataFrame([("g", 100.0), ("z", 5.0), ("none", 7.0)], "grp string, amount double")
    got = finance.allocate_by_share(amounts, members, ["grp"], "w", ["amount"]).select("member", "amount")
    assert rows(got) == [("a", 25.0), ("b", 75.0), ("c", None)]


def test_order_status(spark):
    states = spark.createDataFrame([(1, "I0001"), (1, "I0045"), (2, "I0001")], "order int, state string")
    assert rows(production.order_status(states, ["order"], "state")) == [(1, "Closed"), (2, "Open")]


# --- procurement and quality --------------------------------------------------------------


def test_purchase_order_status(spark):
    orders = spark.createDataFrame([(1, D(10), D(100), 10, 0, None), (2, D(10), D(100), 10, 0, "X"), (3, D(10), D(100), 10, 0, None), (4, D(10), D(100), 0, 0, None)],
                                   "po int, quantity decimal(13,2), value decimal(13,2), under_pct int, over_pct int, complete string")
    move = lambda po, kind, code, dc, q: (po, kind, code, dc, D(q), D(q * 10), day("2020-01-01"))
    history = spark.createDataFrame(
        [move(1, "receipt", "101", "S", 8), move(2, "receipt", "101", "S", 8), move(3, "receipt", "101", "S", 12), move(3, "receipt", "102", "H", 3),
         move(3, "invoice", "", "S", 9), move(3, "invoice", "", "H", 1)],
        "po int, kind string, move_type string, dc string, quantity decimal(13,2), amount decimal(13,2), date date")
    got = procurement.open_purchase_orders(orders, history, ["po"]).select("po", "status", "to_deliver_quantity", "to_invoice_quantity")
    assert rows(got) == [(1, "OPEN", D(2), D(8)), (2, "SHORT_CLOSED", D(0), D(8)), (3, "CLOSED", D(1), D(1)), (4, "OPEN", D(10), D(0))]


def test_change_counts(spark):
    headers = spark.createDataFrame([("M ", "1", "c1", day("2020-01-01")), ("M", "1", "c2", day("2020-01-01"))], "class string, object string, change_no string, date date")
    items = spark.createDataFrame([("M", " 1", "c1", "MARA", "MSTAE", "", "01"), ("M", " 1", "c1", "MARA", "MSTAE", "", "01"), ("M", "1", "c2", "MARA", "LVORM", "X", None),
                                   ("M", "1", "c2", "MARA", "MAKTX", "a", "a"), ("M", "1", "c2", "OTHER", "MAKTX", "a", "b")],
                                  "class string, object string, change_no string, table string, field string, old string, new string")
    assert rows(procurement.change_counts(headers, items, "MARA", "MSTAE", "LVORM")) == [(day("2020-01-01"), 1, 1, 0, 0, 1)]


def test_sample_without_results(spark):
    samples = spark.createDataFrame([("s1",), ("s2",)], "control_no string")
    tests = spark.createDataFrame([("s1", 2, "ph", "7", "ok"), ("s1", 1, None, None, "")], "control_no string, seq int, param string, value string, result string")
    got = quality.sample_results(samples, tests, "control_no", "seq").select("control_no", "test_results")
    assert rows(got) == [("s1", "NA - NA , In Progress : ph - 7 , ok"), ("s2", "NA - NA , In Progress")]


def test_complaint_falls_back_row_by_row(spark):
    cols = "id int, date date, remark string, plant string, quantity int"
    complaints = spark.createDataFrame([(1, day("2020-01-01"), "c", "p"), (2, day("2020-01-05"), "c", "p"), (3, day("2020-01-05"), "c", "p")], "id int, date date, remark string, plant string")
    inv = spark.createDataFrame([(1, day("2020-01-04"), "i", None, 5), (2, day("2020-01-03"), "i", "q", 6)], cols)
    cmp = spark.createDataFrame([(1, day("2020-01-10"), "m", None, None)], cols)
    got = quality.complaint_life_cycle(complaints, inv, cmp).select("id", "stage", "remark", "plant", "quantity", "days_to_attend", "days_to_compensate")
    assert rows(got) == [(1, "Compensated", "m", "p", 5, 3, 6), (2, "Investigated", "i", "q", 6, 2, None), (3, "Registered", "c", "p", None, None, None)]


def test_complaint_takes_one_document_whatever_the_order(spark):
    cols = "id int, date date, remark string, plant string, quantity int, document int"
    complaints = spark.createDataFrame([(1, day("2020-01-01"), "c", "p")], "id int, date date, remark string, plant string")
    docs = [(1, day("2020-01-04"), "a", "P1", None, 8), (1, day("2020-01-04"), "b", "P2", 5, 7), (1, None, "0", "P0", 1, 1)]
    none = spark.createDataFrame([], cols)
    for rows_in in (docs, docs[::-1], docs[1:] + docs[:1]):
        inv = spark.createDataFrame(rows_in, cols)
        got = quality.complaint_life_cycle(complaints, inv, none, ("document",)).select("remark", "plant", "quantity")
        assert rows(got) == [("b", "P2", 5)]
        assert rows(quality.complaint_life_cycle(complaints, inv, none).select("remark", "plant", "quantity")) == [("a", "P1", None)]


def test_last_work_centre_whatever_the_order(spark):
    frame = spark.createDataFrame
    one = lambda schema, *r: frame(list(r), schema)
    for steps in ([("o", 1, "x"), ("o", 2, "a"), ("o", 2, "b")], [("o", 2, "b"), ("o", 2, "a"), ("o", 1, "x")]):
        got = production.production_confirmations(
            one("order string, planned_quantity double", ("o", 9.0)), one("order string, confirmation int, date date, made int", ("o", 1, day("2020-01-01"), 3)),
            one("order string, step int, centre string", *steps), one("order string, unit string, move_type string, quantity int", ("o", "KG", "261", 5)),
            one("order string, confirmation int, unit string, move_type string, group string, quantity int", ("o", 1, "KG", "261", "g", 5)),
            one("order string, state string", ("o", "x")), {"scrap": ("g",)})
        assert got.first()["work_centre"] == "b"


def test_no_debit_is_lost(spark):
    items = spark.createDataFrame(
        [("a", 1, 1, 100, "S", "RV", day("2020-01-01"), day("2020-01-01")), ("a", 2, 1, 50, "S", "UE", day("2020-01-01"), None),
         (None, 3, 1, 70, "S", "RV", day("2020-01-01"), day("2020-01-01")), (None, 4, 1, 30, "H", "RV", day("2020-01-02"), day("2020-01-01")),
         (None, 5, 1, 8, "S", "RV", day("2020-01-02"), None), (None, 5, 2, 8, "H", "RV", day("2020-01-02"), None)],
        "customer string, doc int, item int, amount int, dc string, doc_type string, post_date date, doc_date date")
    signed = receivables.drop_zero_documents(receivables.signed_items(items, "2020-01-10"), ["customer", "doc"])
    got = receivables.settle_fifo(signed, ["doc", "item"]).select("customer", "doc", "age", F.col("balance").cast("int"))
    assert rows(got) == [(None, 3, 10, 40), ("a", 1, 10, 100), ("a", 2, None, 50)]


def test_rejection_share_without_stock(spark):
    df = spark.createDataFrame([("p", "2001", 3), ("p", "CX01", 1), ("q", "2001", 0)], "plant string, loc string, q int")
    assert rows(quality.rejection_share(df, ["plant"], "loc", "q")) == [("p", 3, 1, 0.25, 25.0), ("q", 0, 0, None, None)]


def test_grants(spark):
    ter = spark.createDataFrame([("l", "<DEFAULT>", "s1", "n"), ("l", "<DEFAULT>", "s2", "n"), ("k", "<DEFAULT>", "s1", "n")], "product_line string, sale_type string, state string, zone string")
    ter = ter.withColumn("product_line", F.upper("product_line"))
    grants = spark.createDataFrame([("u", "s1", "State", "l", None), ("v", "n", "ZONE", "l", None), ("w", "x", "global", "k", None), ("x", "s1", "STATE", "OTHERS", None)],
                                   "user string, geo_unit string, geo_unit_type string, product_line string, sale_type string")
    got = security.expand_sales_grants(grants, ter).select("user", "access")
    assert rows(got) == [("u", "L_s1_<DEFAULT>"), ("v", "L_s1_<DEFAULT>"), ("v", "L_s2_<DEFAULT>"), ("w", "K_s1_<DEFAULT>"), ("x", None)]


def test_ledger_due_dates(spark):
    lines = spark.createDataFrame([("c", 1, 2020, "a", "H", 5, None, 10, None, None), ("c", 1, 2020, "a", "S", 7, day("2020-02-01"), 10, 20, 30), ("c", 1, 2020, "z", "S", 7, None, 0, None, None)],
                                  "company string, document int, year int, account string, dc string, amount int, base_date date, days1 int, days2 int, days3 int")
    docs = spark.createDataFrame([("c", 1, 2020, day("2020-01-01"), day("2020-01-02"))], "company string, document int, year int, doc_date date, post_date date")
    accounts = spark.createDataFrame([("c", "a"), ("d", "a"), ("c", "z")], "company string, account string")
    company = spark.createDataFrame([("c",)], "company string")
    codes = spark.createDataFrame([("a",)], "account string")
    got = finance.ledger_lines(lines, docs, accounts, company, codes).select("amount", "due_date")
    assert rows(got) == [(-5, day("2020-01-11")), (7, day("2020-03-02"))]


def test_first_days_of_several_keys_in_one_pass(spark):
    lines = spark.createDataFrame(
        [(1, "a", "x", dt.date(2020, 1, 2)), (2, "a", "x", dt.date(2020, 1, 2)), (3, "a", "y", dt.date(2020, 1, 3)), (4, None, "x", dt.date(2020, 1, 1)),
         (5, None, "x", None), (6, "b", "z", None), (7, "c", "x", dt.date(2020, 1, 1))], "id int, customer string, line string, date date")
    got = sales.first_day_flags(lines, {"new": ["customer"], "pair": ["customer", "line"], "again": ["customer"], "product": ["line"]}, "date")
    assert got.columns == ["id", "customer", "line", "date", "new", "pair", "again", "product"]
    assert rows(got.select("id", "new", "pair", "again", "product")) == [
        (1, 1, 1, 1, 0), (2, 1, 1, 1, 0), (3, 0, 1, 0, 1), (4, 1, 1, 1, 1), (5, 0, 0, 0, 0), (6, 1, 1, 1, 1), (7, 1, 1, 1, 1)]


def test_invoice_fact_leaves_bucketed_documents_where_they_lie(spark, tmp_path):
    """Seven tables by document are joined and aggregated; only the lines move, after plants and weights, and the postings."""
    import uuid

    from lakeops.plans import sales
    from lakeops.sources import sinks

    docs = spark.range(300).select(F.col("id").alias("doc"))
    lines = docs.select("doc", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("line"))
    day = F.lit("2020-01-05").cast("date")
    d = lambda c: F.lit(c).cast("decimal(18,2)")
    sources = {
        "items": lines.select("*", (F.col("doc") % 5).alias("material"), (F.col("doc") % 3).alias("plant"), d("2").alias("quantity"), d("10").alias("net"), d("1").alias("tax")),
        "headers": docs.select("*", day.alias("date"), F.lit(1).alias("sold_to"), F.lit(1).alias("payer"), F.lit("1000").alias("org"), F.lit("").alias("cancelled")),
        "partners": lines.select("doc", F.col("line").cast("string").alias("role"), F.lit(9).alias("party")),
        "conditions": lines.select("*", F.lit("ZF00").alias("code"), d("3").alias("value")),
        "accounting": docs.select("*", F.lit("c").alias("company"), F.col("doc").alias("document"), F.lit(2020).alias("year")),
        "excise": lines.select(F.col("doc").alias("ref_doc"), F.col("line").alias("ref_line"), F.lit(4).alias("number"), day.alias("date")),
        "orders": lines.select(F.col("doc").alias("order"), F.col("line").alias("order_line"), F.lit("r").alias("route"), day.alias("order_date"))}
    keys = {"excise": "ref_doc", "orders": "order"}
    names = {n: f"b_{uuid.uuid4().hex}" for n in sources}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        b = {n: sinks.write_bucketed(df, names[n], [keys.get(n, "doc")], 4, str(tmp_path / n)) for n, df in sources.items()}
        ledger = docs.select(F.lit("c").alias("company"), F.col("doc").alias("document"), F.lit(2020).alias("year"), F.lit(1).alias("item"), F.lit(7).alias("place"))
        weights = spark.createDataFrame([(0, None, None, 1.5)], "material long, valid_from date, valid_to date, weight double")
        plants = spark.createDataFrame([(0, 1, 2)], "plant long, is_plant int, report_plant int")
        out = sales.invoice_fact(b["items"], b["headers"], b["partners"], {"1": "payer"}, b["conditions"], [sales.Measure("freight", ("ZF00",))],
                                 weights, plants, ("material",), (b["accounting"], ledger, b["excise"], b["orders"]))
        assert out.count() == 900 and out.where("freight = 3 and payer_party = 9 and business_place = 7 and excise_number = 4 and route = 'r'").count() == 900
        text = out._jdf.queryExecution().executedPlan().toString()
        moved = [line.split("hashpartitioning(")[1] for line in text.splitlines() if "Exchange hashpartitioning(" in line]
        by_document = [m for m in moved if m.startswith(("doc#", "__r_doc#", "ref_doc", "order#", "__r_ref_doc", "__r_order#"))]
        assert sorted(m.split("#")[0] for m in by_document) == ["__r_doc", "doc"]
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for n in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {n}")
