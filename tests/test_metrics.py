"""Metrics on small hand-made tables, one test per easily missed rule."""

import datetime as dt
import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from billweave.operators import customers, products, purchases, sales, segments
from billweave.operators.dedupe import distinct_items
from billweave.operators.rollups import customer_totals, hourly_totals

A = dt.date(2024, 3, 31)
BILL = "billId string, storeId string, mobileNumber string, name string, billAmount double, createdAt timestamp_ntz"
ITEM = "billId string, storeId string, createdAt timestamp_ntz, itemName string, itemPrice string, load_time timestamp_ntz"
M1, M2 = "9000000001", "9000000002"


def ago(days, hour=12, minute=0, second=0):
    return dt.datetime.combine(A - dt.timedelta(days), dt.time(hour, minute, second))


@pytest.fixture()
def bills(spark):
    def make(*rows):
        """Rows of store, mobile, name, amount, time; numbered as bills."""
        return spark.createDataFrame([(str(i), *row) for i, row in enumerate(rows)], BILL)

    return make


@pytest.fixture()
def items(spark):
    def make(*rows):
        """Rows of bill, store, time, item, price."""
        return spark.createDataFrame([(*row, ago(0)) for row in rows], ITEM)

    return make


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def only(df):
    (row,) = df.collect()
    return row


WINDOW_DAYS = {
    "today": {0},
    "yesterday": {1},
    "last_2_days": set(range(-5, 2)),
    "prev_2_days": {2, 3},
    "last_7_days": set(range(-5, 7)),
    "prev_7_days": set(range(7, 14)),
    "last_1_month": set(range(-5, 31)),
    "prev_1_month": set(range(31, 61)),
    "last_90_days": set(range(-5, 91)),
    "prev_90_days": set(range(91, 181)),
    "lifetime": set(range(-5, 200)),
}
EDGES = [-2, 0, 1, 2, 3, 4, 6, 7, 13, 14, 30, 31, 60, 61, 90, 91, 180, 181]


def test_day_window_edges(bills):
    df = bills(*[("S1", f"90000{d + 10000:05d}", "n", 1.0, ago(d, 23, 59, 59)) for d in EDGES])
    for result, prefix in (
        (sales.bill_count_windows(df, A), "bills"),
        (sales.sales_windows(df, A), "sales"),
        (customers.customer_visit_windows_dev(df, A), "customers"),
        (sales.bill_count_windows(hourly_totals(df), A), "bills"),
    ):
        row = only(result).asDict()
        for suffix, days in WINDOW_DAYS.items():
            assert row[f"{prefix}_{suffix}"] == len(days & set(EDGES)), (prefix, suffix)


def test_windows_skip_unknown_stores_and_null_sums_are_zero(bills):
    df = bills(("S1", M1, "n", None, ago(0)), (None, M1, "n", 5.0, ago(0)))
    row = only(sales.sales_windows(df, A))
    assert row["storeId"] == "S1" and row["sales_today"] == 0.0 and row["sales_lifetime"] == 0.0


def test_visit_windows_count_a_customer_once_per_window(bills):
    df = bills(("S1", M1, "a", 1.0, ago(0)), ("S1", M1, "b", 1.0, ago(0)), ("S1", M1, "a", 1.0, ago(1)), ("S1", "12345", "x", 1.0, ago(0)))
    row = only(customers.customer_visit_windows_dev(df, A))
    assert (row["customers_today"], row["customers_last_2_days"], row["customers_lifetime"]) == (1, 1, 1)


def test_visits_count_numbers_of_any_length(bills):
    df = bills(("S1", M1, "a", 1.0, ago(0)), ("S1", "12345", "b", 1.0, ago(0)), ("S1", None, "c", 1.0, ago(0)), ("S1", None, "c", 1.0, ago(7)))
    assert rows(customers.daily_customer_visits(df), "customer_visits") == [(0,), (2,)]
    # 2024-03-31 and the day a week before are Sundays; a day of unknown numbers counts 0.
    assert rows(customers.avg_week(df), "weekday", "avg_visits") == [("Sunday", 1.0)]
    assert only(customers.visitor_trend_date_hour(df.where("mobileNumber is not null")))["visitor_count"] == 1


def test_null_amounts(bills):
    df = bills(("S1", M1, "a", None, ago(0)), ("S2", M1, "a", None, ago(0)), ("S2", M1, "a", 4.0, ago(0)))
    assert rows(sales.daily_sales_trend(df), "storeId", "total_sales") == [("S1", None), ("S2", 4.0)]
    assert rows(sales.avg_bill_value_daily(df), "storeId", "avg_bill_value") == [("S1", None), ("S2", 4.0)]
    assert rows(sales.average_monthly_bill_value(df), "month", "avg_sales") == [("2024-03", 4.0), ("2024-03", None)]
    assert rows(sales.daily_bill_count(df), "storeId", "bill_count") == [("S1", 1), ("S2", 2)]


def test_monthly_bills_are_distinct(bills):
    df = bills(("S1", M1, "a", 1.0, ago(0)), ("S1", M1, "a", 1.0, ago(1)))
    assert only(sales.monthly_bills(df.withColumn("billId", F.lit("7"))))["no_of_bills"] == 1


def test_calendar_columns(bills):
    df = bills(("S1", M1, "a", 2.5, dt.datetime(2021, 1, 3, 23, 59, 59)))
    row = only(sales.sales_trend_date_hour(df))
    assert row.asDict() == {
        "storeId": "S1", "sale_date": dt.date(2021, 1, 3), "sale_hour": 23, "year": 2021, "quarter": 1,
        "month": 1, "year_month": "2021-01", "week": 53, "total_sales": 2.5, "bill_count": 1,
    }


def test_hourly_average_uses_hours_with_bills(bills):
    df = bills(("S1", M1, "a", 1.0, ago(0, 9)), ("S1", M1, "a", 1.0, ago(0, 9, 30)), ("S1", M1, "a", 1.0, ago(5, 9)), ("S1", M1, "a", 1.0, ago(5, 8)))
    assert rows(sales.avg_hourly_billing_trend(df), "hour_of_day", "avg_bill_count") == [(8, 1.0), (9, 1.5)]


def test_cltv(bills):
    df = bills(("S1", M1, "a", 10.0, ago(4, 23)), ("S1", M1, "b", 20.0, ago(0, 1)), ("S1", M2, "c", 7.0, ago(0)))
    (first, second) = customers.cltv(df).orderBy("mobileNumber").collect()
    assert (first["lifetime_days"], first["purchase_frequency"], first["cltv_value"]) == (4, 0.5, 15.0)
    assert (second["lifetime_days"], second["purchase_frequency"], second["cltv_value"]) == (1, 1.0, 7.0)
    rich = bills(("S1", M1, "a", 1e15, ago(0)))
    assert only(customers.cltv(rich))["cltv_value"] == 1e12


def test_churn_boundary_and_null_store(bills):
    df = bills(
        ("S1", M1, "a", 1.0, ago(60, 0)), ("S1", M2, "a", 1.0, ago(61, 23, 59, 59)),
        (None, M1, "a", 1.0, ago(400)), ("S1", "123", "a", 1.0, ago(400)),
    )
    found = rows(customers.churn_60day(df, A), "storeId", "total_customers", "churned_customers", "churn_rate_percent")
    assert found == [("S1", 2, 1, 50.0), (None, 1, 1, 100.0)]


def test_active_share_uses_each_stores_latest_month(bills):
    df = bills(
        ("S1", M1, "a", 1.0, ago(0)), ("S1", M2, "a", 1.0, ago(40)), ("S1", M2, "b", 1.0, ago(0)),
        ("S2", M1, "a", 1.0, ago(90)), ("S2", M1, "a", 1.0, ago(120)), (None, M1, "a", 1.0, ago(0)),
    )
    columns = ("storeId", "total_customers", "active_customers", "active_customer_percentage", "repeat_customers", "repeat_customer_percentage")
    assert rows(customers.active_cust_pct(df), *columns) == [("S1", 3, 2, 66.67, 0, 0.0), ("S2", 1, 1, 100.0, 1, 100.0)]
    by_mobile = customers.active_cust_pct(df, customers.STORE_CUSTOMER)
    assert rows(by_mobile, *columns) == [("S1", 2, 2, 100.0, 1, 50.0), ("S2", 1, 1, 100.0, 1, 100.0)]


def test_inactive_keys(bills):
    df = bills(("S1", M1, "old", 1.0, ago(100)), ("S1", M1, "new", 1.0, ago(1)), ("S2", M2, "x", 1.0, ago(60)), ("S2", M2, "x", 1.0, ago(61)))
    columns = ("storeId", "name", "mobileNumber", "last_visit_date")
    assert rows(customers.inactive_customers(df, A, 60), *columns) == [("S1", "old", M1, A - dt.timedelta(100))]
    assert rows(customers.inactive_customers(df, A, 60, ("mobileNumber",)), *columns) == []
    assert rows(customers.inactive_customers(df, A, 59, ("mobileNumber",)), *columns) == [("S2", "x", M2, A - dt.timedelta(60))]


def test_active_customers_across_stores(bills):
    df = bills(
        ("S1", M1, "a", 1.0, ago(30, 0)), ("S2", M1, "b", 1.0, ago(2)), ("S1", M2, "c", 1.0, ago(31, 23)),
        (None, M2, "d", 1.0, ago(0)),
    )
    expected = [("S2", "b", M1, A - dt.timedelta(2))]
    for source in (df, customer_totals(df)):
        assert rows(customers.active_customers(source, A), "storeId", "name", "mobileNumber", "last_visit_date") == expected


def test_repeat_customers_take_the_latest_name(bills):
    df = bills(("S1", M1, "old", 1.0, ago(9)), ("S1", M1, "new", 1.0, ago(1)), ("S1", M1, "old", 1.0, ago(5)), ("S2", M1, "x", 1.0, ago(0)), ("S3", M2, "y", 1.0, ago(1)), ("S3", M2, None, 1.0, ago(0)))
    expected = [("S1", "new", M1, 3), ("S3", None, M2, 2)]
    assert rows(customers.repeat_customers_name_and_number(df), "storeId", "name", "mobileNumber", "visit_count") == expected


def percent_rank_scores(values, descending):
    """Brute force: NULL last, share of strictly better rows."""
    def better(x, y):
        if y is None:
            return x is not None
        return x is not None and (x > y if descending else x < y)

    n, scores = len(values), []
    for value in values:
        rank = sum(better(other, value) for other in values) / (n - 1) if n > 1 else 0.0
        scores.append(next((5 - i for i, limit in enumerate((0.10, 0.30, 0.60, 0.80)) if rank <= limit), 1))
    return scores


@pytest.mark.parametrize("seed, size", [(1, 1), (2, 2), (3, 11), (4, 101), (5, 240)])
def test_segments_equal_percent_ranks(bills, seed, size):
    rng = random.Random(seed)
    amounts = [None, -5.0, 0.0, 0.004, 7.0, 7.0, 7.01, 1e9, 1e9 + 0.01, float("inf")]
    data = []
    for number in range(size):
        for _ in range(rng.choice([1, 1, 1, 2, 3])):
            amount = rng.choice(amounts) if rng.random() < 0.5 else round(rng.uniform(1, 400), 2)
            data.append((rng.choice(["S1", "S1", "S2"]), f"9{number:09d}", rng.choice(["n", "N"]), amount, ago(rng.randrange(300))))
    found = segments.rfm_segments(bills(*data), A).collect()
    by_store = defaultdict(list)
    for row in found:
        by_store[row["storeId"]].append(row)
    expected_keys = {(s, m, n) for s, m, n, _, _ in data}
    assert {(r["storeId"], r["mobileNumber"], r["name"]) for r in found} == expected_keys and len(found) == len(expected_keys)
    for members in by_store.values():
        for score, value, descending in (("r_score", "recency_days", False), ("f_score", "frequency", True), ("m_score", "monetary", True)):
            assert [r[score] for r in members] == percent_rank_scores([r[value] for r in members], descending), score
    for row in found:
        assert row["rfm_segment"] == f"{row['r_score']}{row['f_score']}{row['m_score']}"
        assert row["rfm_score"] == row["r_score"] + row["f_score"] + row["m_score"]


def test_one_customer_store_scores_best(bills):
    row = only(segments.rfm_segments(bills(("S1", M1, "a", None, ago(0))), A))
    assert (row["rfm_segment"], row["rfm_score"], row["customer_segment"]) == ("555", 15, "Star Customers")


def test_segment_totals_count_numbers_not_names(spark):
    table = spark.createDataFrame(
        [("S1", M1, "a", 1.0, "Others"), ("S1", M1, "b", 2.0, "Others"), ("S1", M2, "a", None, "At Risk")],
        "storeId string, mobileNumber string, name string, monetary double, customer_segment string",
    )
    assert rows(segments.cust_segment_count(table)) == [("S1", "At Risk", 1), ("S1", "Others", 1)]
    assert rows(segments.cust_segment_spend(table)) == [("S1", "At Risk", None), ("S1", "Others", 3.0)]


def test_item_name_filters(items):
    df = items(*[("1", "S1", ago(0), name, "1") for name in ("", "None", None, "tea")])
    assert rows(products.top_prods_by_qt(df), "itemName") == [("",), ("None",), ("tea",)]
    assert rows(products.top_prods_by_sales(df), "itemName") == [("None",), ("tea",)]
    assert rows(products.product_quantity_this_month(df), "itemName") == [("tea",)]


@pytest.mark.parametrize(
    "price, counts",
    [("5", True), ("5.25", True), ("5.25\n", False), (".5", False), ("5.", False), ("-5", False), ("1e3", False), ("1,000", False), ("5d", False), ("", False), (None, False), (" 5", False)],
)
def test_price_pattern(items, price, counts):
    assert products.top_prods_by_sales(items(("1", "S1", ago(0), "tea", price))).count() == counts


def test_equal_lines_count_once(items):
    df = items(
        ("1", "S1", ago(0), "tea", "2.5"), ("1", "S1", ago(0), "tea", "2.5"), ("1", "S1", ago(0), "tea", "3"),
        ("2", "S1", ago(0), "tea", "2.5"),
    )
    assert only(products.top_prods_by_sales(df))["product_sale"] == 8.0
    assert only(products.top_prods_by_qt(df))["no_times_sold"] == 2
    assert only(products.product_quantity_this_quarter(df))["times_sold"] == 2


def test_month_of_data_and_month_of_day_differ(items):
    df = items(
        ("1", "S1", ago(0), "tea", "1"), ("2", "S2", ago(-40), "", "1"), ("3", "S1", ago(35), "jam", "1"),
        ("4", "S1", ago(100), "rum", "1"), ("5", "S1", ago(200), "ale", "1"),
    )
    # The latest month, May, has only an unnamed item; it still decides.
    assert rows(products.product_quantity_this_month(df), "itemName") == []
    assert rows(products.product_sales_this_month(df, A), "itemName") == [("tea",)]
    # Months found are May, March, February; April is empty and does not count.
    assert rows(products.product_quantity_this_quarter(df), "itemName") == [("jam",), ("tea",)]
    assert rows(products.product_sales_last_3_month(df), "itemName") == [("jam",), ("tea",)]


def test_month_bounds(items):
    first, last = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 31, 23, 59, 59, 999999)
    df = items(("1", "S1", first, "a", "1"), ("2", "S1", last, "b", "1"), ("3", "S1", first - dt.timedelta(microseconds=1), "c", "1"), ("4", "S1", last + dt.timedelta(microseconds=1), "d", "1"))
    assert rows(products.product_sales_this_month(df, A), "itemName") == [("a",), ("b",)]


def test_baskets(items):
    df = items(
        ("1", "S1", ago(0), "tea", "1"), ("1", "S1", ago(0), "jam", "1"), ("1", "S1", ago(0), "tea", "2"),
        ("2", "S1", ago(0), "jam", "1"), ("2", "S1", ago(0), "tea", "1"), ("3", "S1", ago(0), "tea", "1"),
        ("4", None, ago(0), "jam", "1"), ("4", None, ago(0), "tea", "1"),
        (None, "S1", ago(0), "jam", "1"), (None, "S1", ago(0), "tea", "1"),
    )
    found = rows(products.product_basket(df), "storeId", "item_combination", "item_count", "combination_count")
    assert found == [("S1", ["jam", "tea"], 2, 3)]
    # A bill without an id is a basket but pairs with nothing, not even itself.
    assert rows(products.product_pairs(df)) == [("S1", "jam", "tea", 2)]


def brute_pairs(lines):
    baskets = defaultdict(set)
    for bill, store, time, item, _ in lines:
        baskets[store, bill, time].add(item)
    counts = Counter()
    for (store, _, _), names in baskets.items():
        counts.update((store, a, b) for a, b in itertools.combinations(sorted(names), 2))
    return counts


@pytest.mark.parametrize("block", [1, 2, 3, 7, 256])
def test_pairs_equal_brute_force(items, block):
    rng = random.Random(7)
    lines = []
    for bill in range(40):
        for _ in range(rng.choice([1, 2, 3, 8, 30])):
            lines.append((str(bill), f"S{bill % 3}", ago(bill), f"item {rng.randrange(25)}", "1"))
    lines += [("hot", "S0", ago(0), f"item {n}", "1") for n in range(60)] * 3
    found = {tuple(r)[:3]: r["pair_count"] for r in products.product_pairs(items(*lines), block).collect()}
    assert found == dict(brute_pairs(lines))


def test_purchases_ignore_the_items_store_and_copies(bills, items):
    b = bills(("S1", M1, "a", 1.0, ago(0)), ("S1", M1, "a", 1.0, ago(40)), (None, M1, "a", 1.0, ago(0)), ("S1", "12", "a", 1.0, ago(0)))
    b = b.union(b)  # every bill twice
    i = items(*[(bill, "other", ago(300), name, "1") for bill in "0123" for name in ("tea", "tea", "", None, "None")])
    columns = ("storeId", "mobileNumber", "name", "itemName", "times_purchased")
    frequency = purchases.customer_item_purchase_frequency
    assert rows(frequency(b, i), *columns) == [("S1", M1, "a", "None", 2), ("S1", M1, "a", "tea", 2)]
    assert rows(frequency(b, i, A, 1), *columns) == [("S1", M1, "a", "None", 1), ("S1", M1, "a", "tea", 1)]
    assert {r["times_purchased"] for r in frequency(b, i, A, 3).collect()} == {2}


def test_purchase_totals_serve_every_period(bills, items):
    b = bills(*[("S1", M1, "a", 1.0, ago(d)) for d in (-3, 0, 0, 20, 40, 95, 200)])
    # A copy of bill 1 with another time, and one of bill 5 without any.
    other = b.where("billId = '1'").withColumn("createdAt", F.lit(ago(45)))
    timeless = b.where("billId = '5'").withColumn("createdAt", F.lit(None).cast("timestamp_ntz"))
    b = b.union(other).union(timeless)
    i = items(*[(str(bill), "S1", ago(0), "tea", "1") for bill in range(7)])
    totals, frequency = purchases.purchase_totals(b, i, A), purchases.customer_item_purchase_frequency
    for months, expected in ((None, 7), (1, 3), (2, 4), (3, 4), (6, 5)):
        assert only(frequency(b, i, A, months))["times_purchased"] == expected
        assert only(frequency(totals, None, A, months))["times_purchased"] == expected


def test_distinct_items_survivor(spark):
    lines = [("1", "S1", ago(0), "tea", price, load) for price, load in (("1", ago(3)), ("2", ago(1)), ("3", ago(1)), ("9", None))]
    lines += [(None, "S1", None, None, "1", ago(3))] * 2
    found = distinct_items(spark.createDataFrame(lines, ITEM))
    assert rows(found, "itemName", "itemPrice") == [("tea", "3"), (None, "1")]


def test_default_day_is_today(spark):
    now = dt.datetime.now()
    df = spark.createDataFrame([("1", "S1", M1, "a", 1.0, now)], BILL)
    assert only(sales.bill_count_windows(df))["bills_last_2_days"] == 1
