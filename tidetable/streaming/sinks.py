"""Where results of streams and tables go."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidetable.operators.changelog import apply_changelog, latest_by_key

BATCH = "batch"


def file_sink(path: str, fmt: str = "parquet"):
    """Append rows as files with Spark's own commit log, each row exactly once."""
    return lambda writer: writer.format(fmt).option("path", path)


def csv_sink(path: str):
    """Append rows as CSV without a header, columns in declared order."""
    return file_sink(path, "csv")


def console_sink(label: str | None = None):
    """Print every row of each micro-batch, optionally under a query name, one partition at a time."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"---- {label or 'batch'} {batch_id}: {', '.join(batch.columns)}")
        for row in batch.toLocalIterator():
            print(*row, sep=" | ")

    return lambda writer: (writer.queryName(label) if label else writer).foreachBatch(show)


def kafka_sink(servers: str, topic: str, **options: str):
    """Send the ``value`` column to a topic (at least once; needs Spark's Kafka connector)."""
    return lambda writer: (
        writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).options(**options)
    )


def batch_folders(path: str, transform: Callable[[DataFrame], DataFrame] | None = None):
    """Write each micro-batch, optionally transformed as a bounded table, to ``path/batch=<id>``.

    A batch that is tried again replaces its own folder, so results stay exact after a failure.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = transform(batch) if transform else batch
        table.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return lambda writer: writer.foreachBatch(write)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of `batch_folders`, with the micro-batch number as column ``batch``."""
    return spark.read.parquet(path)


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of an update-mode stream written by `batch_folders`."""
    return latest_by_key(read_batches(spark, path), keys, BATCH)


def jdbc_upserts(url: str, table: str, rows_per_flush: int = 1000, **options: str):
    """Append each micro-batch to a database table together with its number.

    Readers take the newest version per key (`latest_by_key`, or the same in SQL as a view), so a key is replaced without
    rewriting the table, and a repeated batch changes nothing: its rows carry the same number and values.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
        writer = numbered.write.format("jdbc").mode("append")
        writer.options(url=url, dbtable=table, batchsize=str(rows_per_flush), **options).save()

    return lambda writer: writer.foreachBatch(write)


def changelog_view(log: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The keyed table behind a stored change-log; ``seq`` orders the changes of a key."""
    return apply_changelog(log, keys, seq)
