"""Connectors whose jars are not on the test classpath: payload work runs, connecting names what is missing."""

from __future__ import annotations

import pytest

from tidetable import schemas
from tidetable.sources import catalog, jdbc, kafka
from tidetable.streaming import run, sinks
from tidetable.operators.changelog import latest_by_key


def test_declared_json_table_in_sql(spark):
    body = '{"user_id":"u%d","item_id":"i","category_id":"c","behavior":"pv","ts":"2019-12-25T15:%02d:00Z"}'
    messages = spark.createDataFrame([(bytearray(body % (i % 2, i), "utf8"),) for i in range(3)], "value binary")
    kafka.json_table(messages, schemas.USER_BEHAVIOR_JSON, "user_behavior")
    hourly = catalog.sql(
        spark,
        """
        WITH visits AS (SELECT user_id, date_format(ts, 'yyyy-MM-dd HH:00') AS dt FROM user_behavior)
        SELECT dt, count(1) AS pv, count(DISTINCT user_id) AS uv FROM visits GROUP BY dt
        """,
    )
    assert [tuple(r) for r in hourly.collect()] == [("2019-12-25 15:00", 3, 2)]


def test_topics_need_the_kafka_connector(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.topic_stream(spark, "broker:9092", "words", max_offsets=1000)
    rate = spark.readStream.format("rate").load().selectExpr("CAST(value AS STRING) AS value")
    with pytest.raises(Exception, match="(?i)kafka"):
        run.continuous(rate, sinks.kafka_sink("broker:9092", "totals"), str(tmp_path))


def test_databases_need_their_driver(spark):
    url = "jdbc:nosuch:dimension"
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc.query_scan(spark, url, "SELECT * FROM users")
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc.partitioned_scan(spark, url, "users", "id", 0, 1000, 4)
    write = []

    class Writer:
        def foreachBatch(self, fn):
            write.append(fn)

    sinks.jdbc_upserts(url, "pvuv")(Writer())
    with pytest.raises(Exception, match="(?i)driver"):
        write[0](spark.createDataFrame([("2019-12-25 15:00", 1, 1)], schemas.PV_UV), 0)


def test_newest_version_wins_and_repeats_change_nothing(spark):
    rows = [("h1", 1, 1, 0), ("h1", 3, 2, 1), ("h2", 1, 1, 1), ("h1", 3, 2, 1)]
    versions = spark.createDataFrame(rows, schemas.PV_UV + ", batch bigint")
    assert sorted(tuple(r) for r in latest_by_key(versions, ["dt"], "batch").collect()) == [("h1", 3, 2), ("h2", 1, 1)]
