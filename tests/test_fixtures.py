"""Small literal inputs with hand-derived results."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidetable import schemas
from tidetable.functions import timewin
from tidetable.functions.text import tokens
from tidetable.operators import changelog, joins, rows, running, topk, windowed
from tidetable.sources import catalog, kafka, lines


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def text_lines(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, seq bigint")


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


VISITS = (
    "111 one  1577259310000",
    "111 two  1577259313000",
    "111 one  1577259312000",
    "222 two  1577259314000",
    "one 111 1577259320000",
    "two 222 1577259323000",
    "one 111 1577259322000",
    "two 111 1577259323000",
)
BILLS = (
    "bill 10  1577259310000",
    "alice 20 1577259313000",
    "bill 20  1577259312000",
    "tom 50   1577259314000",
    "bill 80  1577259320000",
)


@pytest.fixture(scope="module")
def visits(spark):
    parsed = lines.parse_fields(text_lines(spark, *VISITS), schemas.VISIT, keep=("seq",))
    return parsed.withColumn("arrival", F.lit("2019-12-25 07:35:00").cast("timestamp"))


@pytest.fixture(scope="module")
def bills(spark):
    parsed = lines.parse_fields(text_lines(spark, *BILLS, "tom 50 1577259321000"), schemas.BILL, keep=("seq",))
    return timewin.with_event_time(parsed, "timestamp", "ms")


def test_page_views_and_visitors(visits):
    result = windowed.window_pv_uv(visits, "arrival", ["date"], "eventId", "10 seconds")
    assert sorted(values(result, "date", "pv", "uv")) == [("111", 3, 2), ("222", 1, 1), ("one", 2, 1), ("two", 2, 2)]


def test_page_view_panes(visits):
    panes = running.pv_uv_panes(visits, "arrival", ["date"], "eventId", "seq", "10 seconds")
    assert values(panes.orderBy("seq"), "date", "pv", "uv") == [
        ("111", 1, 1), ("111", 2, 2), ("111", 3, 2), ("222", 1, 1),
        ("one", 1, 1), ("two", 1, 1), ("one", 2, 1), ("two", 2, 2),
    ]


def test_window_average(bills):
    result = windowed.window_aggregate(bills.where("seq < 5"), "ts", ["userId"], {"avg": ("avg", "price")}, "10 seconds")
    assert sorted(values(result, "userId", "w_start", "avg")) == [
        ("alice", at("2019-12-25 07:35:10"), 20.0),
        ("bill", at("2019-12-25 07:35:10"), 15.0),
        ("bill", at("2019-12-25 07:35:20"), 80.0),
        ("tom", at("2019-12-25 07:35:10"), 50.0),
    ]


def test_window_average_panes(bills):
    panes = running.average_panes(bills.where("seq < 5"), "ts", ["userId"], "price", "seq", "10 seconds")
    assert values(panes.orderBy("seq"), "userId", "avg") == [
        ("bill", 10.0), ("alice", 20.0), ("bill", 15.0), ("tom", 50.0), ("bill", 80.0),
    ]


def test_equal_average_is_suppressed(bills):
    changed = running.changed_window_averages(bills, "ts", ["userId"], "price", "10 seconds")
    assert sorted(values(changed, "userId", "avg")) == [("alice", 20.0), ("bill", 15.0), ("bill", 80.0), ("tom", 50.0)]
    panes = running.average_panes(bills, "ts", ["userId"], "price", "seq", "10 seconds")
    kept = running.emit_on_change(panes, ["userId"], "seq", "avg")
    assert [r[0] for r in values(kept.orderBy("seq"), "seq")] == [0, 1, 2, 3, 4]


@pytest.fixture(scope="module")
def timed_users(spark):
    body = '{"id":%d,"name":"bill","opTime":"2019-12-25T15:35:%dZ"}'
    data = [(10001, 11), (10002, 12), (10001, 13), (10001, 21), (10003, 17)]
    messages = spark.createDataFrame([(bytearray(body % d, "utf8"),) for d in data], "value binary")
    return kafka.json_rows(messages, schemas.TIMED_USER)


def second(n: int) -> datetime:
    return datetime(2019, 12, 25, 15, 35, n)


def windows_of(df):
    return sorted((r["id"], r["w_start"].second, r["w_end"].second, r["n"]) for r in df.collect())


def test_json_rows_take_numbers_and_iso_times(timed_users):
    assert timed_users.dtypes == [("id", "string"), ("name", "string"), ("opTime", "timestamp")]
    assert values(timed_users.limit(1), "id", "name", "opTime") == [("10001", "bill", second(11))]


def test_tumbling_windows(timed_users):
    counted = windowed.window_aggregate(
        timed_users.where("id < 10003"), "opTime", ["id"], {"n": ("count", "id")}, "10 seconds"
    )
    assert windows_of(counted) == [("10001", 10, 20, 2), ("10001", 20, 30, 1), ("10002", 10, 20, 1)]
    times = {r["t"] for r in counted.select(timewin.last_milli(F.col("w_end")).alias("t")).collect()}
    assert times == {datetime(2019, 12, 25, 15, 35, 19, 999000), datetime(2019, 12, 25, 15, 35, 29, 999000)}


def test_gapped_hop_skips_rows_between_windows(timed_users):
    counted = windowed.window_aggregate(
        timed_users, "opTime", ["id"], {"n": ("count", "id")}, size="5 seconds", slide="10 seconds"
    )
    assert windows_of(counted) == [("10001", 10, 15, 2), ("10001", 20, 25, 1), ("10002", 10, 15, 1)]


@pytest.mark.parametrize("preaggregate", [True, False])
def test_overlapping_hop(timed_users, preaggregate):
    counted = windowed.window_aggregate(
        timed_users.where("id < 10003"), "opTime", ["id"], {"n": ("count", "id")}, "10 seconds", "5 seconds", preaggregate
    )
    assert windows_of(counted) == [
        ("10001", 5, 15, 2), ("10001", 10, 20, 2), ("10001", 15, 25, 1), ("10001", 20, 30, 1),
        ("10002", 5, 15, 1), ("10002", 10, 20, 1),
    ]


def test_uneven_hop_expands_rows(spark):
    df = spark.createDataFrame([("a", at("2020-01-01 00:00:04"))], "k string, ts timestamp")
    counted = windowed.window_aggregate(df, "ts", ["k"], {"n": ("count", "*")}, "5 seconds", "2 seconds")
    assert sorted(r["w_start"].second for r in counted.collect()) == [0, 2, 4]


PAYMENT_ROWS = [
    ("001", "alipay", 1545803501000), ("002", "card", 1545803602000),
    ("003", "card", 1545803610000), ("004", "alipay", 1545803611000),
    ("005", "card", 1545800000000), ("005", "cash", 1545803600000), ("005", "late", 1545803600001),
]
ORDER_ROWS = [
    ("001", "iphone", 1545800002000), ("002", "mac", 1545800003000),
    ("003", "book", 1545800004000), ("004", "cup", 1545800018000), ("005", "edge", 1545800000000),
]


@pytest.mark.parametrize("bucketed", [True, False])
def test_interval_join(spark, bucketed):
    orders = spark.createDataFrame(ORDER_ROWS, schemas.PRODUCT_ORDER)
    orders = timewin.with_event_time(orders, "orderTime", "ms", "ordered").drop("orderTime")
    payments = spark.createDataFrame(PAYMENT_ROWS, schemas.PAYMENT)
    payments = timewin.with_event_time(payments, "payTime", "ms", "paid").drop("payTime")
    matched = joins.interval_join(orders, payments, "orderId", "ordered", "paid", "1 hour", bucketed)
    assert matched.columns == ["orderId", "product", "ordered", "payType", "paid"]
    assert sorted(values(matched, "orderId", "payType")) == [
        ("001", "alipay"), ("002", "card"), ("004", "alipay"), ("005", "card"), ("005", "cash"),
    ]


def test_unions(spark):
    a = spark.createDataFrame([(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 2)], schemas.PURCHASE)
    b = spark.createDataFrame([(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)], schemas.PURCHASE)
    catalog.register(b, "orders_b")
    text = "SELECT * FROM {a} WHERE amount > 2 UNION ALL SELECT * FROM orders_b WHERE amount < 2"
    assert sorted(values(catalog.sql(spark, text, a=a), "*")) == [(1, "beer", 3), (1, "diaper", 4), (4, "beer", 1)]
    both = rows.union_all(a, catalog.scan(spark, "orders_b")).select("user", "product", "amount").where("amount > 2")
    assert sorted(values(both, "*")) == [(1, "beer", 3), (1, "diaper", 4), (2, "pen", 3), (2, "rubber", 3)]


def test_sum_changelog(spark):
    amounts = [(1, 4, 0), (2, 1, 1), (1, 1, 2), (2, 1, 3), (3, 2, 4), (3, 0, 5)]
    df = spark.createDataFrame(amounts, schemas.PRODUCT_AMOUNT + ", seq bigint")
    log = changelog.aggregate_changelog(df, ["productId"], "seq", {"total": ("sum", "amount")})
    assert values(log.orderBy("seq", "op"), "op", "productId", "total") == [
        (True, 1, 4), (True, 2, 1), (False, 1, 4), (True, 1, 5), (False, 2, 1), (True, 2, 2), (True, 3, 2),
    ]
    table = changelog.apply_changelog(log, ["productId"], "seq")
    assert sorted(values(table, "productId", "total")) == [(1, 5), (2, 2), (3, 2)]
    retained = changelog.aggregate_changelog(df, ["productId"], "seq", {"total": ("sum", "amount")}, emit_unchanged=True)
    assert values(retained.where("seq = 5").orderBy("op"), "op", "total") == [(False, 2), (True, 2)]


def test_changelog_sum_of_nulls_is_null_and_inexact_sums_are_refused(spark):
    df = spark.createDataFrame([(1, None, 0), (1, 5, 1), (1, None, 2)], schemas.PRODUCT_AMOUNT + ", seq bigint")
    log = changelog.aggregate_changelog(df, ["productId"], "seq", {"total": ("sum", "amount"), "n": ("count", "amount")})
    assert values(log.orderBy("seq", "op"), "op", "total", "n") == [(True, None, 0), (False, None, 0), (True, 5, 1)]
    with pytest.raises(ValueError):
        changelog.aggregate_changelog(df.withColumn("amount", F.col("amount").cast("double")), ["productId"], "seq",
                                      {"total": ("sum", "amount")})


def test_last_retraction_removes_the_key(spark):
    log = spark.createDataFrame(
        [(True, 1, 0, 4), (False, 1, 1, 4), (True, 2, 0, 7)], "op boolean, k int, seq bigint, v int"
    )
    assert values(changelog.apply_changelog(log, ["k"], "seq"), "k", "v") == [(2, 7)]


def test_region_page_views(spark):
    log = [
        (1510365660000, "ShangHai", "U0010"), (1510365660000, "BeiJing", "U1001"), (1510366200000, "BeiJing", "U2032"),
        (1510366260000, "BeiJing", "U1100"), (1510373400000, "ShangHai", "U0011"),
    ]
    df = timewin.with_event_time(spark.createDataFrame(log, schemas.ACCESS_LOG), "accessTime", "ms", "accessTime")
    counted = windowed.window_aggregate(df, "accessTime", ["region"], {"pv": ("count", "region")}, "2 minutes")
    assert sorted((r[0], f"{r[1]:%H:%M}", f"{r[2]:%H:%M}", r[3]) for r in counted.collect()) == [
        ("BeiJing", "02:00", "02:02", 1), ("BeiJing", "02:10", "02:12", 2),
        ("ShangHai", "02:00", "02:02", 1), ("ShangHai", "04:10", "04:12", 1),
    ]


@pytest.fixture(scope="module")
def word_events(spark):
    payload = spark.createDataFrame([(bytearray(v, "utf8"),) for v in ("a,1,1000", "a,2,2000", "b,5,2500", "a,4,4000")],
                                    "value binary")
    parsed = lines.parse_csv_payload(payload, schemas.WORD_EVENT)
    return timewin.with_event_time(parsed, "timestamp", "ms")


def test_running_and_carried_word_totals(word_events):
    totals = running.running_total(word_events, ["word"], "frequency", "timestamp")
    assert values(totals.orderBy("timestamp"), "word", "total") == [("a", 1), ("a", 3), ("b", 5), ("a", 7)]
    carried = running.carried_total(word_events, "ts", ["word"], "frequency", "3 seconds")
    assert sorted((r["word"], r["w_start"].second, r["total"]) for r in carried.collect()) == [
        ("a", 0, 3), ("a", 3, 7), ("b", 0, 5),
    ]
    assert sorted(r[0] for r in kafka.pair_messages(carried, "word", "total").collect()) == ["(a,3)", "(a,7)", "(b,5)"]


def join_sides(spark):
    users = spark.createDataFrame([("u1", "bill", 0), ("u2", "tom", 2)], "userId string, username string, seq bigint")
    orders = spark.createDataFrame([("u1", "o1", 5, 1)], "userId string, orderId string, orderTs bigint, seq bigint")
    arrival = F.lit("2020-01-01 00:00:00").cast("timestamp")
    return users.withColumn("user_at", arrival), orders.withColumn("order_at", arrival)


def test_window_joins(spark):
    users, orders = join_sides(spark)
    orders = orders.drop("seq")
    inner = joins.window_join(users, orders, "userId", "user_at", "order_at", "10 seconds")
    assert values(inner, "username", "orderId", "orderTs") == [("bill", "o1", 5)]
    left = joins.window_join(users, orders, "userId", "user_at", "order_at", "10 seconds", "left", ["orderTs"])
    assert sorted(values(left, "username", "orderId", "orderTs")) == [("bill", "o1", 5), ("tom", None, 0)]


def test_window_join_panes(spark):
    users, orders = join_sides(spark)
    panes = joins.window_join_panes(
        users, orders, "userId", "user_at", "order_at", "seq", "10 seconds", "left", ["orderTs"]
    )
    emitted = joins.expand_panes(panes).orderBy("userId", "pane")
    assert values(emitted, "username", "orderId", "orderTs") == [("bill", None, 0), ("bill", "o1", 5), ("tom", None, 0)]


def test_dimension_joins(spark):
    orders = lines.parse_fields(text_lines(spark, " o1 1 10 ", "o2 9 11"), schemas.DIMENSION_ORDER)
    users = rows.renamed(spark.createDataFrame([(1, "bill")], "user_id int, name string"), "id, username")
    joined = joins.dimension_join(orders, users, F.expr("userId = id")).select("orderId", "id", "username", "opTime")
    assert values(joined, "*") == [("o1", 1, "bill", 10)]
    crossed = joins.cross_where(orders, users, "userId = id")
    assert values(rows.typed(crossed, schemas.DIMENSION_DETAIL), "*") == [("o1", 1, "bill", 10)]
    plan = crossed._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_tokens(spark):
    df = spark.createDataFrame([("a  b  ",), ("",), ("  ",), (" a\t\n",), ("x\u000by",)], "value string")
    assert [r[0] for r in df.select(tokens("value")).collect()] == [["a", "", "b"], [""], [], ["", "a"], ["x", "y"]]


def test_word_count(spark):
    df = text_lines(spark, "to be  or", "to ").withColumn("ts", F.timestamp_seconds(F.col("seq")))
    counted = windowed.word_count(df, "value", "ts", "5 seconds", "1 second")
    first = counted.where("w_start = timestamp'1970-01-01 00:00:00'")
    assert sorted(values(first, "word", "n")) == [("", 1), ("be", 1), ("or", 1), ("to", 2)]


def test_top_k_ties_few_items_and_report(spark):
    counts = [("w1", i, n) for i, n in enumerate([9, 7, 7, 5, 4, 4, 1])] + [("w2", 3, 1)]
    df = spark.createDataFrame(counts, "w string, item bigint, n bigint")
    ranked = topk.top_k(df, ["w"], "n", "item")
    assert sorted(values(ranked, "w", "rank", "item")) == [
        ("w1", 1, 0), ("w1", 2, 1), ("w1", 3, 2), ("w1", 4, 3), ("w1", 5, 4), ("w2", 1, 3),
    ]
    text = topk.report(ranked, ["w"], "n", "item").where("w = 'w2'").first()["report"]
    rule = "-" * 38
    assert text == f"{rule}\nNo1:  商品ID=3  浏览量=1\n{rule}\n\n"


def test_bad_numbers_fail_unless_lenient(spark):
    bad = text_lines(spark, "bill ten 1577259310000", "bill")
    with pytest.raises(Exception):
        lines.parse_fields(bad, schemas.BILL).collect()
    assert values(lines.parse_fields(bad, schemas.BILL, lenient=True), "*") == [
        ("bill", None, 1577259310000), ("bill", None, None),
    ]


def test_time_columns(spark):
    df = timewin.with_event_time(spark.createDataFrame([(1577259310,)], "t bigint"), "t", "s")
    assert values(df, "ts", timewin.hour_label("ts"), timewin.at_zone("ts")) == [
        (at("2019-12-25 07:35:10"), "2019-12-25 07:00", at("2019-12-25 15:35:10"))
    ]
    assert timewin.with_arrival_time(df).columns == ["t", "ts", "procTime"]


def test_over_range_shares_ties(spark):
    data = [("a", 1, 1), ("a", 1, 2), ("a", 2, 4), ("b", 1, 9), (None, 1, 3)]
    df = spark.createDataFrame(data, "k string, s bigint, v bigint").withColumn("ts", F.timestamp_seconds("s"))
    result = running.over_range(df, "ts", ["k"], "v")
    assert sorted(values(result, "k", "s", "v", "total"), key=str) == sorted(
        [("a", 1, 1, 3), ("a", 1, 2, 3), ("a", 2, 4, 7), ("b", 1, 9, 9), (None, 1, 3, 3)], key=str
    )
