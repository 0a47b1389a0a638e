"""The given tables in the shapes the registered queries use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def epoch() -> Column:
    """The epoch as zoneless wall-clock time."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: str) -> Column:
    """An amount of two decimals as an exact number of cents."""
    return F.round(F.col(amount) * 100).cast("long")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their value in cents; ``event_id`` is the arrival number."""
    return table(spark, sf_dir, "events").withColumn("cents", cents("value"))


def value_class() -> Column:
    """Whole hundreds of an event's value, a coarse number that often repeats."""
    return F.floor(F.col("cents") / 10000).alias("step")


def of_type(events_df: DataFrame, kind: str) -> DataFrame:
    """Events of one type."""
    return events_df.where(F.col("event_type") == kind)


def clicks(events_df: DataFrame) -> DataFrame:
    """Clicks as the left side of a join."""
    return of_type(events_df, "click").select("user_id", "event_id", F.col("ts").alias("click_ts"))


def purchases(events_df: DataFrame) -> DataFrame:
    """Purchases as the right side of a join, with their epoch milliseconds."""
    return of_type(events_df, "purchase").select(
        "user_id", "event_id", F.col("ts").alias("purchase_ts"), "cents"
    )


def utc_wall(ts: str | Column) -> Column:
    """An instant as zoneless UTC wall-clock time, whatever the session's zone: counted from the epoch, not by the clock."""
    column = F.col(ts) if isinstance(ts, str) else ts
    micros = F.unix_micros(column.cast("timestamp"))
    return epoch() + F.make_dt_interval(secs=(micros / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))


def utc_instant(wall: str) -> Column:
    """The instant a zoneless UTC wall-clock time names, whatever the session's zone."""
    column = F.col(wall)
    seconds = (F.hour(column) * 60 + F.minute(column)) * 60 + F.extract(F.lit("SECOND"), column)
    micros = F.unix_date(column.cast("date")).cast("long") * 86_400_000_000 + (seconds * 1_000_000).cast("long")
    return F.timestamp_micros(micros)


def arriving_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arriving one per second from the epoch on."""
    arrival = epoch() + F.make_dt_interval(secs=F.col("doc_id"))
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text", arrival.alias("arrival"))


def region_orders(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Orders (of the table or a stream) with the region of their customer: an access log by region."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("o_orderdate").alias("accessTime"), F.col("r_name").alias("region"))
    )
