"""Registered queries that run as streams over the given tables.

Each drains the table through a streaming query, closes its windows with a far-future row, and returns what the sink
holds. The table is first written, in one pass, as slices of equal numbers of rows in the order of their times, one micro-batch each; with some
disorder rows come a slice late, but never behind the watermark's delay. State and results go to the shared folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, NumericType, StructField, StructType, TimestampType

from tidetable import schemas
from tidetable.functions import timewin
from tidetable.operators import changelog, joins, rows, windowed
from tidetable.plans.tables import cents, of_type, region_orders, table, utc_wall, value_class
from tidetable.session import shared_folder, streaming_session
from tidetable.sources import catalog, files, kafka, lines, user
from tidetable.streaming import carry, jobs, panes, run, sinks, state_table, stateful

WINDOW = ["w_start", "w_end"]
SLICES = 4
FILE_BYTES = 128 << 20
SLOT, PIECE = "__slot", "__piece"
DISORDER = "6 hours"


@dataclass
class Replay:
    """One table replayed as a stream, with a side folder for the row that ends it."""

    spark: SparkSession
    caller: SparkSession
    folder: str
    path: str
    ts: str
    schema: StructType
    pieces: int

    @classmethod
    def of(
        cls, caller: SparkSession, sf_dir: str, name: str, ts: str, disorder: str = "0 seconds", by: str | Column | None = None
    ) -> Replay:
        """Slices go by ``by``, or else by ``ts`` with a tenth of the rows ``disorder`` later than their time says."""
        spark, folder = streaming_session(caller), shared_folder(caller)
        given = table(spark, sf_dir, name)
        size = int(given._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        replay = cls(spark, caller, folder, f"{folder}/slices", ts, given.schema, size // (SLICES * FILE_BYTES) + 1)
        time = F.col(by or ts) if by is None or isinstance(by, str) else by
        time = time if isinstance(given.select(time).schema[0].dataType, NumericType) else time.cast("timestamp")
        delayed = F.when(F.pmod(F.xxhash64(*given.columns), F.lit(10)) == 0, timewin.micros_of(disorder) / 1_000_000)
        arrival = given.withColumn("__at", time.cast("double") + F.coalesce(delayed, F.lit(0.0)))
        cuts = [n / SLICES for n in range(1, SLICES)]
        cuts = arrival.agg(F.percentile_approx("__at", cuts)).first()[0] or []
        slot = sum((F.coalesce((F.col("__at") > cut).cast("int"), F.lit(0)) for cut in cuts), F.lit(0))
        piece = F.pmod(F.xxhash64(*given.columns), F.lit(replay.pieces)).cast("int")
        dealt = arrival.withColumn(SLOT, slot).withColumn(PIECE, piece).drop("__at")
        dealt.repartition(SLICES * replay.pieces, SLOT, PIECE).write.partitionBy(SLOT, PIECE).parquet(replay.path)
        replay._in_order()
        spark.createDataFrame([], replay.schema).write.parquet(replay.flush_path)
        return replay

    def _in_order(self) -> None:
        """Give the files of later slices later times: a stream reads files by age."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = system.listFiles(root, True)
        while found.hasNext():
            file = found.next().getPath()
            slot = file.toString().partition(f"{SLOT}=")[2].partition("/")[0]
            if slot:
                system.setTimes(file, 1_600_000_000_000 + int(slot) * 10_000, -1)

    @property
    def flush_path(self) -> str:
        return f"{self.folder}/flush"

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint"

    @property
    def out(self) -> str:
        return f"{self.folder}/out"

    def rows(self) -> DataFrame:
        """The table's rows as they are."""
        schema = StructType([*self.schema.fields, StructField(SLOT, IntegerType()), StructField(PIECE, IntegerType())])
        data = files.stream_table(self.spark, self.path, schema, files_per_batch=self.pieces)
        return data.drop(SLOT, PIECE)

    def stream(self) -> DataFrame:
        """The table's rows, then the flush row, with the time column as an instant."""
        flush = files.stream_table(self.spark, self.flush_path, self.schema)
        return self.rows().unionByName(flush).withColumn(self.ts, F.col(self.ts).cast("timestamp"))

    def flush(self, **values: list) -> None:
        """Write rows 1000 days after the table's last one: one per combination of the given column values."""
        last = self.spark.read.schema(self.schema).parquet(self.path).agg((F.max(self.ts) + timewin.interval("1000 days")).alias(self.ts))
        for name, options in values.items():
            last = last.withColumn(name, F.explode(F.array(*[F.lit(o) for o in options])))
        missing = [f for f in self.schema if f.name not in last.columns]
        full = last.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
        rows.typed(full, self.schema).write.mode("append").parquet(self.flush_path)

    def closed(self, result: DataFrame, sink=None, **values: list) -> DataFrame:
        """Drain, flush, drain again, and read the result back with wall-clock times."""
        run.drain_and_flush(
            result, sink or sinks.file_sink(self.out), self.checkpoint, lambda: self.flush(**values)
        )
        return self.read(None if sink else result.columns)

    def read(self, columns: list[str] | None = None) -> DataFrame:
        """What the sink holds."""
        held = self.caller.read.parquet(self.out)
        held = held.select(*columns) if columns else held.drop(sinks.BATCH)
        instants = [f.name for f in held.schema if isinstance(f.dataType, TimestampType)]
        return held.withColumns({name: utc_wall(name) for name in instants})


def _events(spark: SparkSession, sf_dir: str) -> tuple[Replay, DataFrame]:
    replay = Replay.of(spark, sf_dir, "events", "ts", DISORDER)
    stream = replay.stream().withColumn("cents", cents("value"))
    return replay, stream.withWatermark("ts", DISORDER)


def stream_hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top five viewed items per sliding window, ranked as the windows close."""
    replay, stream = _events(spark, sf_dir)
    views = of_type(stream, "view").withColumnRenamed("user_id", "item_id")
    counts = windowed.window_aggregate(views, "ts", ["item_id"], {"views": ("count", "*")}, "1 day", "1 hour")
    sink = jobs.top_k_sink(replay.out, WINDOW, "views", "item_id", 5)
    replay.closed(counts, sink, event_type=["view"])
    return replay.read()


def stream_hot_items_timer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranking from a timer per window end over bounded state."""
    replay, stream = _events(spark, sf_dir)
    views = of_type(stream, "view").withColumnRenamed("user_id", "item_id")
    counts = windowed.window_aggregate(views, "ts", ["item_id"], {"n": ("count", "*")}, "1 day", "1 hour")
    best = stateful.window_top_k(counts.select("w_end", F.col("item_id").alias("item"), "n"), "w_end", 5)
    replay.closed(best, jobs.top_k_sink(replay.out, ["w_end"], "n", "item", 5), event_type=["view"])
    return replay.read()


def stream_tumble_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and hour, emitted once when the hour closes."""
    replay, stream = _events(spark, sf_dir)
    counted = windowed.window_aggregate(stream, "ts", ["event_type"], {"n": ("count", "event_type")}, "1 hour")
    return replay.closed(counted)


def stream_tumble_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts with early and late results: update mode, newest result per window."""
    replay = Replay.of(spark, sf_dir, "events", "ts")
    late = run.with_lateness(replay.stream(), "ts", "30 seconds", "2 seconds")
    counted = windowed.window_aggregate(late, "ts", ["event_type"], {"n": ("count", "event_type")}, "1 hour")
    run.drain(counted, sinks.batch_folders(replay.out), replay.checkpoint, "update")
    keys = ["event_type", *WINDOW]
    newest = sinks.read_upserts(replay.caller, replay.out, keys)
    return newest.withColumns({name: utc_wall(name) for name in WINDOW})


def stream_hop_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hop of two hours with windows of one, on a stream."""
    replay, stream = _events(spark, sf_dir)
    counted = windowed.window_aggregate(
        stream, "ts", ["event_type"], {"n": ("count", "event_type")}, "1 hour", "2 hours"
    )
    return replay.closed(counted.withColumn("row_time", timewin.last_milli(F.col("w_end"))))


def stream_json_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages decoded by a declared schema, watermarked and counted per id and day."""
    replay = Replay.of(spark, sf_dir, "events", "ts")
    body = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name"), F.col("ts").alias("opTime"))
    messages = replay.stream().select(F.encode(F.to_json(body), "UTF-8").alias("value"))
    users = timewin.with_event_time(kafka.json_rows(messages, schemas.TIMED_USER), "opTime", "ts", "rowTime", "0 seconds")
    return replay.closed(windowed.window_aggregate(users, "rowTime", ["id"], {"n": ("count", "id")}, "1 day"))


def stream_region_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stream with static customer regions, counted per 30 days into a CSV sink."""
    replay = Replay.of(spark, sf_dir, "orders", "o_orderdate")
    regions = region_orders(replay.spark, sf_dir, replay.stream()).withWatermark("accessTime", "0 seconds")
    counted = windowed.window_aggregate(regions, "accessTime", ["region"], {"pv": ("count", "region")}, "30 days")
    named = counted.withColumnsRenamed({"w_start": "winStart", "w_end": "winEnd"})
    customer = table(replay.spark, sf_dir, "customer").agg(F.min("c_custkey")).first()[0]
    run.drain_and_flush(
        named, sinks.csv_sink(replay.out), replay.checkpoint, lambda: replay.flush(o_custkey=[customer])
    )
    held = files.read_csv(replay.spark, replay.out, schemas.REGION_PV)
    return held.withColumns({"winStart": utc_wall("winStart"), "winEnd": utc_wall("winEnd")})


def stream_pvuv_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact page views and unique visitors of closed days."""
    replay, stream = _events(spark, sf_dir)
    return replay.closed(jobs.window_pv_uv(stream, "ts", ["event_type"], "user_id", "1 day"))


def stream_pvuv_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views and unique visitors per hour label as results that keep updating; newest value per hour."""
    replay = Replay.of(spark, sf_dir, "events", "ts")
    labelled = replay.stream().select("ts", "user_id", timewin.hour_label("ts").alias("dt"))
    retention = carry.Retention("ts", "1 hour", "1 day")
    sink = carry.visitors_sink(replay.out, f"{replay.folder}/state", ["dt"], "user_id", retention)
    run.drain(labelled, sink, replay.checkpoint)
    return sinks.read_upserts(replay.caller, replay.out, ["dt"])


def stream_window_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average value per user and closed day."""
    replay, stream = _events(spark, sf_dir)
    return replay.closed(windowed.window_aggregate(stream, "ts", ["user_id"], {"avg_cents": ("avg", "cents")}, "1 day"))


def stream_avg_emit_on_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily average value class per user, emitted only when it changed."""
    replay, stream = _events(spark, sf_dir)
    steps = stream.select("ts", "user_id", value_class())
    averages = windowed.window_aggregate(steps, "ts", ["user_id"], {"avg_step": ("avg", "step")}, "1 day")
    replay.closed(averages, carry.emit_on_change_sink(replay.out, f"{replay.folder}/last", ["user_id"], "avg_step"))
    return replay.read(averages.columns)


def stream_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the total of its type so far, continued across micro-batches."""
    replay = Replay.of(spark, sf_dir, "events", "ts", by="event_id")
    stream = replay.stream().withColumn("cents", cents("value")).select("event_id", "event_type", "cents")
    totals = f"{replay.folder}/totals"
    sink = carry.running_total_sink(replay.out, totals, ["event_type"], "cents", "event_id")
    run.drain(stream, sink, replay.checkpoint)
    return replay.read()


def stream_carried_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed hours per type with the total carried over in state."""
    replay, stream = _events(spark, sf_dir)
    sums = windowed.window_aggregate(stream, "ts", ["event_type"], {"total": ("sum", "cents")}, "1 hour")
    replay.closed(sums, carry.carried_total_sink(replay.out, f"{replay.folder}/totals", ["event_type"], "total"))
    return replay.read(sums.columns)


def stream_payload_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated payloads decoded, summed per closed hour, carried over and encoded as ``(word,total)``."""
    replay = Replay.of(spark, sf_dir, "events", "ts")
    fields = [F.col("event_type"), cents("value"), F.unix_millis("ts")]
    payload = F.concat_ws(",", *[f.cast("string") for f in fields])
    messages = replay.stream().select(F.encode(payload, "UTF-8").alias("value"))
    parsed = lines.parse_csv_payload(messages, schemas.WORD_EVENT)
    stamped = timewin.with_event_time(parsed, "timestamp", "ms", delay="1 second")
    sums = windowed.window_aggregate(stamped, "ts", ["word"], {"total": ("sum", "frequency")}, "1 hour")
    encoded = lambda totals: kafka.pair_messages(totals, "word", "total")
    sink = carry.carried_total_sink(replay.out, f"{replay.folder}/totals", ["word"], "total", shown=encoded)
    replay.closed(sums, sink, event_type=["flush"], value=[0.0])
    return replay.read(["value"])


def stream_text_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text that appear in a folder, parsed to bills and averaged per user and closed day."""
    session, folder = streaming_session(spark), shared_folder(spark)
    source = table(session, sf_dir, "events").select("user_id", cents("value"), F.unix_millis(F.col("ts").cast("timestamp")))
    source.select(F.concat_ws(" \t", *[F.col(c).cast("string") for c in source.columns])).write.text(f"{folder}/lines")
    bills = lines.parse_fields(lines.stream_lines(session, f"{folder}/lines"), schemas.BILL)
    stamped = timewin.with_event_time(bills, "timestamp", "ms", delay="0 seconds")
    averages = windowed.window_aggregate(stamped, "ts", ["userId"], {"avg_cents": ("avg", "price")}, "1 day")
    named = averages.select(F.col("userId").cast("bigint").alias("user_id"), *WINDOW, "avg_cents")

    def flush() -> None:
        last = source.agg(F.max(source.columns[-1]) + timewin.micros_of("1000 days") // 1000)
        last.select(F.concat(F.lit("0 0 "), F.col(last.columns[0]).cast("string"))).write.mode("append").text(f"{folder}/lines")

    run.drain_and_flush(named, sinks.file_sink(f"{folder}/out"), f"{folder}/checkpoint", flush)
    held = spark.read.parquet(f"{folder}/out")
    return held.withColumns({name: utc_wall(name) for name in WINDOW})


def stream_sum_retract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every update of the sum per type as retraction and addition, continued across micro-batches."""
    replay = Replay.of(spark, sf_dir, "events", "ts", by="event_id")
    stream = replay.stream().withColumn("cents", cents("value")).select("event_id", "event_type", "cents")
    measures = {"total": ("sum", "cents")}
    sink = carry.changelog_sink(replay.out, f"{replay.folder}/state", ["event_type"], "event_id", measures)
    run.drain(stream, sink, replay.checkpoint)
    return replay.read()


def stream_apply_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that the streamed change-log of sums describes."""
    return changelog.apply_changelog(stream_sum_retract(spark, sf_dir), ["event_type"], "event_id")


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of arriving documents per five-minute window.

    Each micro-batch counts its own words as a bounded table, and the counts of a word and window add up over the
    batches: a sum needs no state store that holds every word of the open windows.
    """
    arrival = F.timestamp_seconds("doc_id")
    replay = Replay.of(spark, sf_dir, "documents", "doc_id")
    arrived = replay.rows().select(arrival.alias("arrival"), "text")
    counted = sinks.batch_folders(replay.out, lambda batch: windowed.word_count(batch, "text", "arrival", "5 minutes"))
    run.drain(arrived, counted, replay.checkpoint)
    batches = sinks.read_batches(replay.caller, replay.out)
    totals = batches.groupBy("word", *WINDOW).agg(F.sum("n").alias("n"))
    return totals.withColumns({name: utc_wall(name) for name in WINDOW})


def _sides(spark: SparkSession, sf_dir: str) -> tuple[Replay, DataFrame, DataFrame]:
    replay = Replay.of(spark, sf_dir, "events", "ts", DISORDER)
    clicked = of_type(replay.stream(), "click").select("user_id", "event_id", F.col("ts").alias("click_ts"))
    bought = of_type(replay.stream().withColumn("cents", cents("value")), "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"), "cents"
    )
    return replay, clicked.withWatermark("click_ts", DISORDER), bought.withWatermark("purchase_ts", DISORDER)


def stream_window_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and purchases of one user within one day, joined as streams."""
    replay, clicked, bought = _sides(spark, sf_dir)
    joined = joins.window_join(clicked, bought, "user_id", "click_ts", "purchase_ts", "1 day")
    run.drain(joined, sinks.file_sink(replay.out), replay.checkpoint)
    return replay.read(joined.columns)


def stream_window_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The left form: unmatched clicks come out when their day closes."""
    replay, clicked, bought = _sides(spark, sf_dir)
    joined = joins.window_join(clicked, bought, "user_id", "click_ts", "purchase_ts", "1 day", "left", ["cents"])
    # the rows that end the input need a key, or the join drops them before they move the watermark; they have no number
    ended = replay.closed(joined, event_type=["click", "purchase"], user_id=[-1])
    return ended.where(F.col("event_id").isNotNull())


def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases within an hour after a click, joined as streams with bounded state."""
    replay, clicked, bought = _sides(spark, sf_dir)
    joined = joins.interval_join(clicked, bought, "user_id", "click_ts", "purchase_ts", "1 hour")
    run.drain(joined, sinks.file_sink(replay.out), replay.checkpoint)
    return replay.read(joined.columns)


def stream_dimension_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order stream enriched from the customer table."""
    replay = Replay.of(spark, sf_dir, "orders", "o_orderdate")
    dimension = rows.renamed(table(replay.spark, sf_dir, "customer").select("c_custkey", "c_name"), "id, username")
    joined = joins.dimension_join(replay.stream(), dimension, F.expr("o_custkey = id"))
    joined = joined.select("o_orderkey", "id", "username", "o_orderdate")
    run.drain(joined, sinks.file_sink(replay.out), replay.checkpoint)
    return replay.read(joined.columns)


def _view(frame: DataFrame, name: str) -> str:
    """Register a stream under a name of its own, so that queries in one session don't meet."""
    unique = f"{name}_{uuid.uuid4().hex[:8]}"
    catalog.register(frame, unique)
    return unique


def stream_tumble_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling counts in SQL text over a registered stream."""
    replay, stream = _events(spark, sf_dir)
    name = _view(stream.select("ts", "event_type"), "clicks")
    counted = replay.spark.sql(f"""
        SELECT event_type, window.start AS w_start, window.end AS w_end, count(event_type) AS n
        FROM {name} GROUP BY event_type, window(ts, '1 hour')
    """)
    return replay.closed(counted)


def stream_hop_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views per item and sliding day in SQL text over a declared table of JSON messages."""
    replay = Replay.of(spark, sf_dir, "events", "ts", DISORDER)
    body = F.struct("user_id", "event_type", "ts")
    messages = replay.stream().select(F.encode(F.to_json(body), "UTF-8").alias("value"))
    name = f"messages_{uuid.uuid4().hex[:8]}"
    kafka.json_table(messages, "user_id bigint, event_type string, ts timestamp", name)
    timed = _view(catalog.scan(replay.spark, name).withWatermark("ts", DISORDER), "timed")
    counted = replay.spark.sql(f"""
        SELECT user_id, window.start AS w_start, window.end AS w_end, count(1) AS n
        FROM {timed} WHERE event_type = 'view' GROUP BY user_id, window(ts, '1 day', '6 hours')
    """)
    return replay.closed(counted, event_type=["view"])


def stream_dimension_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order stream enriched from the customer table in SQL text."""
    replay = Replay.of(spark, sf_dir, "orders", "o_orderdate")
    placed = _view(replay.stream(), "placed")
    catalog.register(table(replay.spark, sf_dir, "customer").select("c_custkey", "c_name"), "people", "id, username")
    joined = catalog.sql(
        replay.spark, f"SELECT o_orderkey, id, username, o_orderdate FROM people JOIN {placed} ON id = o_custkey"
    )
    run.drain(joined, sinks.file_sink(replay.out), replay.checkpoint)
    return replay.read(joined.columns)


def stream_pvuv_retract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every update of hourly page views and unique visitors as retraction and addition, from one query."""
    replay = Replay.of(spark, sf_dir, "events", "ts", by="event_id")
    labelled = replay.stream().select("ts", "event_id", "user_id", timewin.hour_label("ts").alias("dt"))
    retention = carry.Retention("ts", "1 hour", "1 day")
    sink = carry.visitors_changelog_sink(replay.out, f"{replay.folder}/state", ["dt"], "event_id", "user_id", retention=retention)
    run.drain(labelled, sink, replay.checkpoint)
    return replay.read()


def stream_keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that a stream of changes describes, kept by key: read without reading the changes."""
    replay = Replay.of(spark, sf_dir, "events", "ts", by="event_id")
    stream = replay.stream().withColumn("cents", cents("value")).select("event_id", "event_type", "cents")
    log = f"{replay.folder}/log"
    measures = {"total": ("sum", "cents")}
    run.drain(stream, carry.changelog_sink(log, f"{replay.folder}/state", ["event_type"], "event_id", measures), replay.checkpoint)
    schema = spark.read.parquet(f"{log}/{sinks.BATCH}=0").schema
    changes = files.stream_table(replay.spark, f"{log}/{sinks.BATCH}=*", schema)
    sink = state_table.keyed_table_sink(replay.out, ["event_type"], "event_id")
    run.drain(changes, sink, f"{replay.checkpoint}-table")
    return state_table.read_keyed_table(spark, replay.out, ["event_type"], "event_id")


def stream_window_avg_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The average of its user and day after every event, continued across micro-batches."""
    replay = Replay.of(spark, sf_dir, "events", "ts", by="event_id")
    stream = replay.stream().withColumn("cents", cents("value")).select("event_id", "user_id", "ts", "cents")
    sink = panes.average_panes_sink(replay.out, f"{replay.folder}/state", "ts", ["user_id"], "cents", "event_id", "1 day", into="avg_cents")
    run.drain(stream, sink, replay.checkpoint)
    return replay.read(["event_id", "user_id", *WINDOW, "avg_cents"])


def stream_pvuv_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views and unique visitors of its type and day after every event, continued across micro-batches."""
    replay = Replay.of(spark, sf_dir, "events", "ts", by="event_id")
    stream = replay.stream().select("event_id", "event_type", "user_id", "ts")
    sink = panes.pv_uv_panes_sink(replay.out, f"{replay.folder}/state", "ts", ["event_type"], "user_id", "event_id", "1 day")
    run.drain(stream, sink, replay.checkpoint)
    return replay.read(["event_id", "event_type", *WINDOW, "pv", "uv"])


def _join_panes(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    replay = Replay.of(spark, sf_dir, "events", "ts", by="event_id")
    stream = replay.stream().withColumn("cents", cents("value"))
    clicked = of_type(stream, "click").select("user_id", "event_id", F.col("ts").alias("click_ts"))
    bought = of_type(stream, "purchase").select("user_id", "event_id", F.col("ts").alias("purchase_ts"), "cents")
    both = panes.tagged(clicked, bought, "user_id", "click_ts", "purchase_ts", "event_id")
    sink = panes.join_panes_sink(
        replay.out, f"{replay.folder}/state", "user_id", ["event_id", "click_ts"], ["right_event_id", "purchase_ts", "cents"],
        "event_id", "1 day", how, ["cents"],
    )
    run.drain(both, sink, replay.checkpoint)
    return panes.emitted_panes(replay.read())


def stream_window_join_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and purchases of one user and day, all pairs emitted again at every arrival, over micro-batches."""
    return _join_panes(spark, sf_dir, "inner")


def stream_window_left_join_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The left form, in which clicks show alone until a purchase arrives."""
    return _join_panes(spark, sf_dir, "left")


def stream_tumble_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and day as versions: every six hours and at the end of the day, then every three hours for late events.

    Every tenth event arrives six hours late.
    """
    arrival = F.col("ts") + F.when(F.col("event_id") % 10 == 0, timewin.interval("6 hours")).otherwise(timewin.interval("0 hours"))
    replay = Replay.of(spark, sf_dir, "events", "ts", by=arrival)
    stream = replay.stream().withColumn("arrival", F.coalesce(arrival, F.col("ts")))
    sink = panes.firing_sink(
        replay.out, f"{replay.folder}/state", "ts", "arrival", ["event_type"], "1 day", "6 hours", "3 hours", "1 day"
    )
    fired = replay.closed(stream, sink)
    return fired.where(F.col("event_type").isNotNull())


def stream_union_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two order streams united, projected and filtered, insert-only."""
    replay = Replay.of(spark, sf_dir, "orders", "o_orderdate")
    finished, opened = [replay.stream().where(F.col("o_orderstatus") == s) for s in ("F", "O")]
    both = rows.union_all(finished, opened).select("o_custkey", "o_orderpriority", "o_totalprice")
    kept = both.where("o_totalprice > 200000")
    run.drain(kept, sinks.file_sink(replay.out), replay.checkpoint)
    return replay.read(kept.columns)


def stream_user_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts per type from a user's own source into a user's own sink.

    The source's first places hold the events, a tenth of them later than their time says; a place that appears after a restart ends
    the hours.
    """
    session, folder = streaming_session(spark), shared_folder(spark)
    given = table(session, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "event_id")
    came = F.col("ts") + F.when(F.col("event_id") % 10 == 0, timewin.interval(DISORDER)).otherwise(timewin.interval("0 hours"))
    given.repartitionByRange(SLICES, came).select("ts", "event_type").write.parquet(f"{folder}/script")
    name = f"script_{uuid.uuid4().hex[:8]}"
    user.register_source(session, name, given.select("ts", "event_type").schema, user.FolderScript(f"{folder}/script"))
    stream = session.readStream.format(name).load().withWatermark("ts", DISORDER)
    counted = windowed.window_aggregate(stream, "ts", ["event_type"], {"n": ("count", "event_type")}, "1 hour")

    def appear(number: int) -> None:
        last = given.agg((F.max("ts") + timewin.interval("1000 days")).alias("ts")).withColumn("event_type", F.lit("end"))
        last.write.parquet(f"{folder}/end-{number}")
        user.publish(f"{folder}/end-{number}", f"{folder}/script", f"zzz-{number}")  # names behind all others

    sink = user.committed_files_sink(session, f"{folder}/out")
    run.drain_and_flush(counted, sink, f"{folder}/checkpoint", lambda: appear(0))
    appear(1)  # Spark drains such a source in one batch; what the place before has closed comes out with this one
    run.drain(counted, sink, f"{folder}/checkpoint")
    held = user.read_committed(spark, f"{folder}/out", counted.schema)
    return held.withColumns({name: utc_wall(name) for name in WINDOW})


QUERIES = {
    q.__name__: q
    for q in (
        stream_hot_items,
        stream_hot_items_timer,
        stream_tumble_count,
        stream_tumble_refined,
        stream_hop_gapped,
        stream_json_tumble,
        stream_region_pv,
        stream_pvuv_tumble,
        stream_pvuv_hourly,
        stream_window_avg,
        stream_avg_emit_on_change,
        stream_running_total,
        stream_carried_total,
        stream_payload_totals,
        stream_text_avg,
        stream_sum_retract,
        stream_apply_changelog,
        stream_word_count,
        stream_window_inner_join,
        stream_window_left_join,
        stream_interval_join,
        stream_dimension_join,
        stream_union_filter,
        stream_tumble_sql,
        stream_hop_sql,
        stream_dimension_sql,
        stream_pvuv_retract,
        stream_keyed_table,
        stream_window_avg_panes,
        stream_pvuv_panes,
        stream_window_join_panes,
        stream_window_left_join_panes,
        stream_tumble_versions,
        stream_user_source,
    )
}
