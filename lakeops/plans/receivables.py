"""Customer receivables: settlement, ageing, overdue amounts, deposits, collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import DEFAULT_MEMBER, as_col, first_match, signed
from ..operators.joins import anti, lookup, with_reversed
from ..operators.reshape import sum_when

# The credit side's code, the document type aged by its own date, the claim
# scale (claims are recorded in units of 100,000), the steps of the ageing buckets.
CREDIT = "H"
AGED_BY_DOCUMENT_DATE = ("UE",)
CLAIM_SCALE = -100_000
AGE_STEPS = [(15, 360), (30, 720)]
OLDEST_BUCKET = "grtr_than_720_days"
NOT_DUE_BUCKET = "not_due"


def open_at(items: DataFrame, as_of: str, post_date: str = "post_date", clear_date: str = "clear_date") -> DataFrame:
    """Items posted up to a day and not cleared by it.

    Reads open items (no clearing date) and cleared ones in one frame; a caller with two
    tables unions them first.
    """
    day = F.lit(as_of).cast("date")
    return items.where((F.col(post_date) <= day) & (F.col(clear_date).isNull() | (F.col(clear_date) > day)))


def signed_items(items: DataFrame, as_of: str) -> DataFrame:
    """Credits turned negative and the age in days on ``as_of``.

    Reads customer, doc_type, post_date, doc_date, dc, amount. The posting day itself counts,
    except for the types aged by document date.
    """
    day = F.lit(as_of).cast("date")
    by_document = F.datediff(day, F.col("doc_date"))
    age = F.when(F.col("doc_type").isin(*AGED_BY_DOCUMENT_DATE), by_document).otherwise(
        F.datediff(day, F.col("post_date")) + 1)
    return items.withColumns({"amount": signed("amount", "dc", CREDIT), "age": age})


def drop_zero_documents(items: DataFrame, keys: list[str], amount: str = "amount") -> DataFrame:
    """Without documents whose items cancel out."""
    zero = items.groupBy(*keys).agg(F.sum(amount).alias("__total")).where("__total = 0")
    return anti(items, zero, keys, null_safe=True)


def claim_totals(claims: DataFrame, scale: int = CLAIM_SCALE) -> DataFrame:
    """Disputes and legal cases per customer, scaled to credits."""
    scaled = F.coalesce(F.col("amount"), F.lit(0)) * scale
    return claims.groupBy("customer").agg(F.sum(scaled).alias("claims"))


def settle_fifo(items: DataFrame, tie: list[str], claims: DataFrame | None = None) -> DataFrame:
    """Apply each customer's credits to the oldest debits first; gives debits with ``balance``.

    Debits and credits are summed per (customer, age) first, map-side combined. Those few rows
    carry the running debit from age to age and the customer's whole credit, so the items
    themselves are shuffled once, by customer and age, and a customer with very many items
    is spread over its ages. A debit stays whole without credits, is 0 while the credits
    last, partial on the row that exhausts them and whole after it. A null customer is one
    customer, a null age comes after all others; no debit is lost.
    """
    amount = F.col("amount")
    ages = items.groupBy("customer", "age").agg(
        sum_when(amount > 0, amount).alias("__debit"), sum_when(amount < 0, amount).alias("__credit"))
    customer = Window.partitionBy("customer")
    older = customer.orderBy(F.col("age").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ages = ages.select(
        "customer", "age", F.coalesce(F.sum("__debit").over(older), F.lit(0)).alias("__carried"),
        F.sum("__credit").over(customer).alias("credit_sum"))
    if claims is not None:
        ages = lookup(ages, claims, ["customer"], ["claims"], null_safe=True)
        ages = ages.withColumn("credit_sum", F.col("credit_sum") + F.coalesce("claims", F.lit(0))).drop("claims")
    out = lookup(items.where(amount > 0), ages, ["customer", "age"], ["__carried", "credit_sum"], null_safe=True, how="inner")
    within = Window.partitionBy("customer", "age").orderBy(*tie).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("total_due", F.col("__carried") + F.sum("amount").over(within)).drop("__carried")
    out = out.withColumn("paid_amount", F.col("total_due") + F.col("credit_sum"))
    before = F.col("paid_amount") - amount
    first = F.col("total_due") == amount
    balance = (
        F.when(F.col("credit_sum") == 0, amount)
        .when(F.col("paid_amount") <= 0, F.lit(0))
        .when(first | (before <= 0), F.col("paid_amount"))
        .otherwise(amount))
    return out.withColumn("balance", balance.cast("decimal(18,2)"))


def age_bounds(steps: list[tuple[int, int]] = AGE_STEPS) -> list[tuple[int, int, str]]:
    """(first day, last day, label) of every bounded bucket."""
    out, low = [], 0
    for width, until in steps:
        while (out[-1][1] if out else 0) < until:
            high = (out[-1][1] if out else 0) + width
            out.append((low, high, f"{low}_to_{high}_days"))
            low = high + 1
    return out


def age_bucket(age: str | Column, not_due: bool = False, steps=AGE_STEPS) -> Column:
    """Bucket label; a negative age falls in the oldest bucket unless ``not_due`` is set."""
    age = as_col(age)
    out = F.when(age < 0, F.lit(NOT_DUE_BUCKET if not_due else OLDEST_BUCKET))
    for _, high, label in age_bounds(steps):
        out = out.when(age <= high, F.lit(label))
    return out.otherwise(F.lit(OLDEST_BUCKET))


def ageing_snapshot(balances: DataFrame, keys: list[str], as_of: str, not_due: bool = False,
                    defaults: dict[str, str] | None = None) -> DataFrame:
    """Open balances as one column per age bucket, in a single aggregation."""
    due = balances.where("balance > 0")
    if defaults:
        due = due.fillna(defaults)
    age = F.col("age")
    bounds = age_bounds()
    ranges = {label: age.between(low, high) for low, high, label in bounds}
    beyond = age > bounds[-1][1]
    if not_due:
        ranges = {NOT_DUE_BUCKET: age < 0, **ranges, OLDEST_BUCKET: beyond}
    else:
        ranges[OLDEST_BUCKET] = beyond | (age < 0)
    sums = [sum_when(hit, F.col("balance")).alias(label) for label, hit in ranges.items()]
    return due.groupBy(*keys).agg(*sums).withColumn("snapshot_date", F.lit(as_of).cast("date"))


def overdue_amounts(balances: DataFrame, criteria: DataFrame, on: list[str], keys: list[str], as_of: str,
                    start: str = "start_days") -> DataFrame:
    """Balances old enough to be overdue, summed per customer and class.

    ``criteria`` gives the age from which a class is overdue; a class it lacks is overdue at once.
    """
    out = lookup(balances, criteria, on, [start])
    old = F.col("age") >= F.coalesce(F.col(start), F.lit(0))
    return out.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(old, F.col("balance")).otherwise(F.lit(0))), F.lit(0)).alias("overdue_amount")
    ).withColumn("snapshot_date", F.lit(as_of).cast("date"))


def security_deposits(items: DataFrame, as_of: str, ledger: tuple[str, ...],
                      excluded: DataFrame | None = None) -> DataFrame:
    """Deposits held per customer: special-ledger credits not cleared by the day."""
    items = open_at(items, as_of)
    items = items.where(F.col("ledger").isin(*ledger) & (F.col("dc") == CREDIT))
    if excluded is not None:
        items = anti(items, excluded, ["customer"])
    return items.groupBy("customer").agg(F.sum("amount").alias("deposit")).withColumn(
        "snapshot_date", F.lit(as_of).cast("date"))


def collections(payments: DataFrame, all_documents: DataFrame, lines: DataFrame, key: list[str], reversal: list[str],
                customers: DataFrame, areas: DataFrame, kinds: list[tuple[str, str]], territory: DataFrame,
                kind: str = "doc_type", not_chased: tuple[str, ...] = ()) -> DataFrame:
    """Signed payment lines, those of reversed originals included, with sales type and geography.

    Headers count once per key. customers: customer, postcode, product_line; areas: customer, office
    name, of which the smallest counts; ``kinds`` maps a LIKE pattern of it to the sales type;
    territory: product_line, sale_type, pincode and the levels above it.
    """
    headers = with_reversed(payments, all_documents, key, reversal, kind, not_chased)
    headers = headers.groupBy(*key).agg(F.min("post_date").alias("post_date"))
    out = headers.join(lines, key, "left").withColumn("amount", signed("amount", "dc", CREDIT))
    out = lookup(out, customers, ["customer"], ["postcode", "product_line"])
    office = areas.groupBy("customer").agg(F.min("office").alias("office"))
    out = lookup(out, office, ["customer"], ["office"])
    out = out.withColumn("sale_type", first_match([(F.col("office").like(p), k) for p, k in kinds], DEFAULT_MEMBER))
    levels = [c for c in territory.columns if c not in ("product_line", "sale_type", "pincode")]
    out = lookup(out, territory, ["product_line", "sale_type", ("postcode", "pincode")], levels)
    return out.fillna(DEFAULT_MEMBER, subset=levels).drop("office")
