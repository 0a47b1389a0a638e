"""Registered queries over bounded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidetable import schemas
from tidetable.functions import timewin
from tidetable.operators import changelog, custom, joins, rows, running, topk, windowed
from tidetable.plans.tables import (
    arriving_documents,
    cents,
    clicks,
    events,
    of_type,
    purchases,
    region_orders,
    table,
    utc_instant,
    utc_wall,
    value_class,
)
from tidetable.session import shared_folder
from tidetable.sources import catalog, files, kafka, lines

WINDOW = ["w_start", "w_end"]


# ---- top-k per window ----


def hot_items_of(views: DataFrame) -> DataFrame:
    """Every hour, the five most-viewed items of the last day."""
    counts = windowed.window_aggregate(views, "ts", ["item_id"], {"views": ("count", "*")}, "1 day", "1 hour")
    return topk.top_k(counts, WINDOW, "views", "item_id", 5)


def hot_items_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top five viewed items (users of the events table) per day-long window sliding by an hour."""
    views = of_type(table(spark, sf_dir, "events"), "view").select("ts", F.col("user_id").alias("item_id"))
    return hot_items_of(views)


def hot_items_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hot items of each window as the ranked text block."""
    return topk.report(hot_items_topk(spark, sf_dir), WINDOW, "views", "item_id")


def hot_items_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same top five from a typed CSV scan with event times in epoch seconds."""
    folder = shared_folder(spark)
    source = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("userId"),
        F.col("user_id").alias("itemId"),
        F.length("event_type").cast("long").alias("categoryId"),
        F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type")).alias("behavior"),
        F.unix_seconds(utc_instant("ts")).alias("timestamp"),
    )
    source.write.csv(folder)
    scan = timewin.with_event_time(files.read_csv(spark, folder, schemas.USER_BEHAVIOR_CSV), "timestamp", "s")
    views = scan.where("behavior = 'pv'").select(utc_wall("ts").alias("ts"), F.col("itemId").alias("item_id"))
    return hot_items_of(views)


# ---- time windows ----


def tumble_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and hour."""
    return windowed.window_aggregate(
        table(spark, sf_dir, "events"), "ts", ["event_type"], {"n": ("count", "event_type")}, "1 hour"
    )


def tumble_bounds_rowtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window bounds and row time in SQL text."""
    return catalog.sql(
        spark,
        """
        SELECT user_id, window.start AS w_start, window.end AS w_end,
               window.end - INTERVAL '0.001' SECOND AS row_time, count(user_id) AS n
        FROM {events} GROUP BY window(ts, '6 hours'), user_id
        """,
        events=table(spark, sf_dir, "events"),
    )


def arrival_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per source in windows of arrival time instead of event time."""
    arrived = timewin.with_arrival_time(
        arriving_documents(spark, sf_dir).drop("text"), arrival=F.col("arrival")
    )
    return windowed.window_aggregate(arrived, "procTime", ["source"], {"n": ("count", "doc_id")}, "1 minute")


def hop_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their mean value per type, an hour sliding by five minutes."""
    measures = {"n": ("count", "*"), "avg_cents": ("avg", "cents"), "top_cents": ("max", "cents")}
    return windowed.window_aggregate(events(spark, sf_dir), "ts", ["event_type"], measures, "60 minutes", "5 minutes")


def hop_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hop of two hours with windows of one: half of the time lies in no window."""
    counted = windowed.window_aggregate(
        table(spark, sf_dir, "events"), "ts", ["event_type"], {"n": ("count", "event_type")}, "1 hour", "2 hours"
    )
    return counted.withColumn("row_time", timewin.last_milli(F.col("w_end")))


def region_pv_of(log: DataFrame) -> DataFrame:
    """Accesses per region and 30-day window as ``region, winStart, winEnd, pv``."""
    counted = windowed.window_aggregate(log, "accessTime", ["region"], {"pv": ("count", "region")}, "30 days")
    return counted.withColumnsRenamed({"w_start": "winStart", "w_end": "winEnd"})


def region_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer region and 30 days."""
    return region_pv_of(region_orders(spark, sf_dir))


def region_pv_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regional counts through a CSV sink with declared names and types."""
    folder = shared_folder(spark)
    region_pv(spark, sf_dir).write.csv(folder)
    return files.read_csv(spark, folder, schemas.REGION_PV.replace("timestamp", "timestamp_ntz"))


# ---- sets, filters, projections ----


def union_all_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNION ALL of two filtered selects in SQL text."""
    orders = table(spark, sf_dir, "orders")
    return catalog.sql(
        spark,
        """
        SELECT * FROM {finished} WHERE o_totalprice > 200000
        UNION ALL SELECT * FROM {opened} WHERE o_totalprice < 100000
        """,
        finished=orders.where("o_orderstatus = 'F'"),
        opened=orders.where("o_orderstatus = 'O'"),
    )


def union_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of two tables, then projection and filter, which the optimizer moves below the union."""
    orders = table(spark, sf_dir, "orders")
    both = rows.union_all(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'O'"))
    return both.select("o_custkey", "o_orderpriority", "o_totalprice").where("o_totalprice > 200000")


def append_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-only projection of a table interpolated into SQL."""
    return catalog.sql(
        spark, "SELECT o_orderkey AS product_id, o_totalprice AS amount FROM {t}", t=table(spark, sf_dir, "orders")
    )


def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns renamed by position, then converted to a declared row type."""
    named = rows.renamed(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "id, username")
    return rows.typed(named, schemas.DIMENSION_USER)


# ---- page views and unique visitors ----


def pvuv_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly page views and unique visitors by hour label, in SQL text."""
    return catalog.sql(
        spark,
        """
        WITH visits AS (SELECT user_id, date_format(ts, 'yyyy-MM-dd HH:00') AS dt FROM {events})
        SELECT dt, count(1) AS pv, count(DISTINCT user_id) AS uv FROM visits GROUP BY dt
        """,
        events=table(spark, sf_dir, "events"),
    )


def arrival_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per source in windows of arrival time instead of event time."""
    arrived = timewin.with_arrival_time(
        arriving_documents(spark, sf_dir).drop("text"), arrival=F.col("arrival")
    )
    return windowed.window_aggregate(arrived, "procTime", ["source"], {"n": ("count", "doc_id")}, "1 minute")


def hop_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their mean value per type, an hour sliding by five minutes."""
    measures = {"n": ("count", "*"), "avg_cents": ("avg", "cents"), "top_cents": ("max", "cents")}
    return windowed.window_aggregate(events(spark, sf_dir), "ts", ["event_type"], measures, "60 minutes", "5 minutes")


def hop_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hop of two hours with windows of one: half of the time lies in no window."""
    counted = windowed.window_aggregate(
        table(spark, sf_dir, "events"), "ts", ["event_type"], {"n": ("count", "event_type")}, "1 hour", "2 hours"
    )
    return counted.withColumn("row_time", timewin.last_milli(F.col("w_end")))


def region_pv_of(log: DataFrame) -> DataFrame:
    """Accesses per region and 30-day window as ``region, winStart, winEnd, pv``."""
    counted = windowed.window_aggregate(log, "accessTime", ["region"], {"pv": ("count", "region")}, "30 days")
    return counted.withColumnsRenamed({"w_start": "winStart", "w_end": "winEnd"})


def region_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer region and 30 days."""
    return region_pv_of(region_orders(spark, sf_dir))


def region_pv_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regional counts through a CSV sink with declared names and types."""
    folder = shared_folder(spark)
    region_pv(spark, sf_dir).write.csv(folder)
    return files.read_csv(spark, folder, schemas.REGION_PV.replace("timestamp", "timestamp_ntz"))


# ---- sets, filters, projections ----


def union_all_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNION ALL of two filtered selects in SQL text."""
    orders = table(spark, sf_dir, "orders")
    return catalog.sql(
        spark,
        """
        SELECT * FROM {finished} WHERE o_totalprice > 200000
        UNION ALL SELECT * FROM {opened} WHERE o_totalprice < 100000
        """,
        finished=orders.where("o_orderstatus = 'F'"),
        opened=orders.where("o_orderstatus = 'O'"),
    )


def union_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of two tables, then projection and filter, which the optimizer moves below the union."""
    orders = table(spark, sf_dir, "orders")
    both = rows.union_all(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'O'"))
    return both.select("o_custkey", "o_orderpriority", "o_totalprice").where("o_totalprice > 200000")


def append_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-only projection of a table interpolated into SQL."""
    return catalog.sql(
        spark, "SELECT o_orderkey AS product_id, o_totalprice AS amount FROM {t}", t=table(spark, sf_dir, "orders")
    )


def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns renamed by position, then converted to a declared row type."""
    named = rows.renamed(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "id, username")
    return rows.typed(named, schemas.DIMENSION_USER)


# ---- page views and unique visitors ----


def pvuv_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly page views and unique visitors by hour label, in SQL text."""
    return catalog.sql(
        spark,
        """
        SELECT DATE_FORMAT(ts, 'yyyy-MM-dd HH:00') AS dt, COUNT(*) AS pv, COUNT(DISTINCT user_id) AS uv
        FROM {events} GROUP BY DATE_FORMAT(ts, 'yyyy-MM-dd HH:00')
        """,
        events=table(spark, sf_dir, "events"),
    )


def pvuv_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views and unique visitors per event type and day."""
    return windowed.window_pv_uv(table(spark, sf_dir, "events"), "ts", ["event_type"], "user_id", "1 day")


def pvuv_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views and unique visitors of the event's type and day after every single event."""
    source = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    panes = running.pv_uv_panes(source, "ts", ["event_type"], "user_id", "event_id", "1 day")
    return panes.select("event_id", "event_type", *WINDOW, "pv", "uv")


# ---- averages and running values ----


def window_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average value per user and day."""
    measures = {"avg_cents": ("avg", "cents")}
    return windowed.window_aggregate(events(spark, sf_dir), "ts", ["user_id"], measures, "1 day")


def user_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same average from a user-supplied accumulator of sum and count."""

    def accumulate(pdf):
        grouped = pdf.groupby(["user_id", "w_start"], as_index=False, dropna=False)["cents"]
        return grouped.agg(amount="sum", deals="count")

    def merge(accumulators):
        return accumulators.groupby(["user_id", "w_start"], as_index=False, dropna=False)[["amount", "deals"]].sum()

    placed = events(spark, sf_dir).select("user_id", timewin.starts("ts", "1 day"), "cents")
    merged = custom.user_aggregate(
        placed, ["user_id", "w_start"], accumulate, merge, "user_id bigint, w_start timestamp_ntz, amount bigint, deals bigint"
    )
    return merged.select(
        "user_id", "w_start", (F.col("w_start") + timewin.interval("1 day")).alias("w_end"),
        F.try_divide("amount", "deals").alias("avg_cents"),
    )


def window_avg_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average of the user's day after every single event."""
    source = events(spark, sf_dir).select("event_id", "ts", "user_id", "cents")
    panes = running.average_panes(source, "ts", ["user_id"], "cents", "event_id", "1 day", "avg_cents")
    return panes.select("event_id", "user_id", *WINDOW, "avg_cents")


def avg_emit_on_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average value class (whole hundreds) per user and day, kept where it differs from the user's last one."""
    steps = events(spark, sf_dir).select("ts", "user_id", value_class())
    return running.changed_window_averages(steps, "ts", ["user_id"], "step", "1 day").withColumnRenamed("avg", "avg_step")


def panes_emit_on_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same averages after every event, kept where they differ from the user's previous emission."""
    steps = events(spark, sf_dir).select("event_id", "ts", "user_id", value_class())
    panes = running.average_panes(steps, "ts", ["user_id"], "step", "event_id", "1 day", "avg_step")
    changed = running.emit_on_change(panes, ["user_id"], "event_id", "avg_step")
    return changed.select("event_id", "user_id", *WINDOW, "avg_step")


def local_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the wall-clock time eight hours ahead of theirs, and its hour label."""
    local = timewin.at_zone(utc_instant("ts"), "Asia/Shanghai")
    timed = table(spark, sf_dir, "events").select("event_id", utc_wall(local).alias("local_ts"))
    return timed.withColumn("local_hour", timewin.hour_label("local_ts"))


def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the total of its type so far."""
    source = events(spark, sf_dir).select("event_id", "event_type", "cents")
    return running.running_total(source, ["event_type"], "cents", "event_id")


def carried_window_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows per type with the total carried over from all earlier windows."""
    return running.carried_total(events(spark, sf_dir), "ts", ["event_type"], "cents", "1 hour")


def over_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the total of their priority up to their date; orders of one date share it."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", cents("o_totalprice").alias("cents")
    )
    return running.over_range(orders, "o_orderdate", ["o_orderpriority"], "cents")


# ---- words ----


def word_count_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of arriving documents, five minutes sliding by one."""
    return windowed.word_count(arriving_documents(spark, sf_dir), "text", "arrival", "5 minutes", "1 minute")


# ---- joins ----


def window_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and purchases of one user within one day."""
    source = events(spark, sf_dir)
    bought = purchases(source).withColumnRenamed("event_id", "purchase_id")
    return joins.window_join(clicks(source), bought, "user_id", "click_ts", "purchase_ts", "1 day")


def window_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with the purchases of the same user and day; without one the amount reads 0."""
    source = events(spark, sf_dir)
    bought = purchases(source).withColumnRenamed("event_id", "purchase_id")
    return joins.window_join(clicks(source), bought, "user_id", "click_ts", "purchase_ts", "1 day", "left", ["cents"])


def window_join_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window join fired at every arrival: first pane and number of emissions of each pair."""
    source = events(spark, sf_dir)
    return joins.window_join_panes(
        clicks(source), purchases(source), "user_id", "click_ts", "purchase_ts", "event_id", "1 day"
    )


def window_left_join_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The left form, which also shows clicks until their first purchase arrives."""
    source = events(spark, sf_dir)
    return joins.window_join_panes(
        clicks(source), purchases(source), "user_id", "click_ts", "purchase_ts", "event_id", "1 day", "left", ["cents"]
    )


def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases within one hour after a click of the same user."""
    source = events(spark, sf_dir)
    bought = purchases(source).withColumnRenamed("event_id", "purchase_id")
    return joins.interval_join(clicks(source), bought, "user_id", "click_ts", "purchase_ts", "1 hour")


def dimension_join_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders enriched from the customer dimension in SQL text."""
    return catalog.sql(
        spark,
        """
        WITH people AS (SELECT c_custkey AS id, c_name AS username FROM {customers})
        SELECT o_orderkey, id, username, o_orderdate FROM people JOIN {orders} ON id = o_custkey
        """,
        orders=table(spark, sf_dir, "orders"),
        customers=table(spark, sf_dir, "customer"),
    )


def dimension_join_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same enrichment as a product filtered by its condition."""
    dimension = rows.renamed(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "id, username")
    joined = joins.cross_where(table(spark, sf_dir, "orders"), dimension, "o_custkey = id")
    return joined.select("o_orderkey", "o_custkey", "username", "o_orderdate")


# ---- change-logs ----


def _sum_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(spark, sf_dir).select("event_id", "event_type", "cents")
    return changelog.aggregate_changelog(source, ["event_type"], "event_id", {"total": ("sum", "cents")})


def sum_retract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every update of the sum per type as retraction and addition."""
    return _sum_changelog(spark, sf_dir)


def pvuv_retract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every update of the hourly page views and unique visitors."""
    source = table(spark, sf_dir, "events").select("event_id", "user_id", timewin.hour_label("ts").alias("dt"))
    measures = {"pv": ("count", "*"), "uv": ("count_distinct", "user_id")}
    return changelog.aggregate_changelog(source, ["dt"], "event_id", measures)


def apply_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that the change-log of sums describes."""
    return changelog.apply_changelog(_sum_changelog(spark, sf_dir), ["event_type"], "event_id")


# ---- message payloads ----


def payload_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated payloads (bytes) decoded to word, frequency and epoch milliseconds."""
    messages = table(spark, sf_dir, "events").select(
        F.encode(
            F.concat_ws(",", "event_type", F.col("user_id").cast("string"), (F.col("event_id") * 1000).cast("string")),
            "UTF-8",
        ).alias("value")
    )
    return lines.parse_csv_payload(messages, schemas.WORD_EVENT)


def line_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitespace-separated lines decoded to user, price and epoch milliseconds."""
    text = table(spark, sf_dir, "events").select(
        F.format_string("  %s \t%s   %d ", F.col("user_id").cast("string"), F.col("value").cast("string"),
                        F.col("event_id") * 1000).alias("value")
    )
    return lines.parse_fields(text, schemas.BILL)


def payload_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carried window totals encoded as outgoing ``(word,total)`` messages."""
    return kafka.pair_messages(carried_window_total(spark, sf_dir), "event_type", "total")


def json_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages decoded by a declared schema, then counted per id and window."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name"), iso.alias("opTime"))
    messages = table(spark, sf_dir, "events").select(F.encode(F.to_json(body), "UTF-8").alias("value"))
    users = kafka.json_rows(messages, schemas.TIMED_USER).withColumn("opTime", utc_wall("opTime"))
    return windowed.window_aggregate(users, "opTime", ["id"], {"n": ("count", "id")}, "1 day")


QUERIES = {
    q.__name__: q
    for q in (
        hot_items_topk,
        hot_items_report,
        hot_items_csv,
        tumble_count,
        tumble_bounds_rowtime,
        arrival_tumble,
        hop_count,
        hop_gapped,
        region_pv,
        region_pv_csv,
        union_all_filtered,
        union_then_filter,
        append_projection,
        typed_rows,
        pvuv_hourly,
        pvuv_tumble,
        pvuv_panes,
        window_avg,
        user_avg,
        window_avg_panes,
        avg_emit_on_change,
        panes_emit_on_change,
        local_times,
        running_total,
        carried_window_total,
        over_range,
        word_count_sliding,
        window_inner_join,
        window_left_join,
        window_join_panes,
        window_left_join_panes,
        interval_join,
        dimension_join_sql,
        dimension_join_where,
        sum_retract,
        pvuv_retract,
        apply_changelog,
        payload_words,
        line_fields,
        payload_totals,
        json_tumble,
    )
}
