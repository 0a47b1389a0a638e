"""Tables of state between micro-batches: what a batch does not touch is neither read nor written.

The rows of a table are dealt to buckets by a hash of their keys, and to periods of event time if it has them. A batch
appends its changed rows as one delta per bucket that it touches; reading merges the deltas of a bucket, the newest row of a
key winning. A bucket with more than ``most_deltas`` deltas is written anew as one, again only that bucket. Which files make
up version n (the state after batch n) is said by a manifest of its own, put in place by a rename, so a batch that is tried
again finds its starting state unchanged and its own version either whole or absent. Periods behind the watermark
leave as a whole, by leaving the manifest. Files that the newest ``KEPT`` manifests do not name are deleted.

All files lie in the folder given, which the driver and all executors must share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

BUCKETS = 16
MOST_DELTAS = 8
KEPT = 3

VERSION, PERIOD, BUCKET = "__version", "__period", "__bucket"
#: A row with this column true removes its key.
GONE = "__gone"

Entry = tuple[int, int]


@dataclass
class Manifest:
    """One version: its schema, the highest event time seen (microseconds), and the folders of each (period, bucket)."""

    number: int
    schema: StructType
    buckets: int
    high: int | None = None
    entries: dict[Entry, list[str]] = field(default_factory=dict)

    def text(self) -> str:
        entries = [[*entry, folders] for entry, folders in sorted(self.entries.items())]
        held = {"number": self.number, "schema": self.schema.json(), "buckets": self.buckets, "high": self.high}
        return json.dumps({**held, "entries": entries})

    @classmethod
    def of(cls, text: str) -> Manifest:
        held = json.loads(text)
        entries = {(period, bucket): folders for period, bucket, folders in held["entries"]}
        schema = StructType.fromJson(json.loads(held["schema"]))
        return cls(held["number"], schema, held["buckets"], held["high"], entries)


class _Files:
    """The few file operations that a manifest needs, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return [status.getPath().getName() for status in self.fs.listStatus(self.path(folder))]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a file that is there as a whole or not at all."""
        draft = self.path(f"{name}.{uuid.uuid4().hex}.draft")
        stream = self.fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(draft, self.path(name)):
            raise OSError(f"{name} could not be put in place")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class StateTable:
    """A table of one row per key (``keys``), or of plain rows that are dealt by ``keys`` and only ever added (``plain``).

    ``period`` is a column expression of a long that rises with event time and is fixed by a row's keys; without it all
    rows have one period. ``order`` names the column by which the newest row of a key is found, else batches decide.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        period: Column | None = None,
        plain: bool = False,
        order: str | None = None,
        buckets: int = BUCKETS,
        most_deltas: int = MOST_DELTAS,
    ):
        self.spark, self.path, self.keys, self.plain, self.order = spark, path.rstrip("/"), list(keys), plain, order
        self.period = F.lit(0).cast("long") if period is None else period.cast("long")
        self.most_deltas = most_deltas
        self.files = _Files(spark, self.path)
        newest = self.version()
        self.buckets = newest.buckets if newest else buckets

    # --- versions

    def numbers(self) -> list[int]:
        return sorted(int(name.split(".")[0]) for name in self.files.names("manifests") if name.endswith(".json"))

    def has(self, number: int) -> bool:
        """Whether this version is whole."""
        return number in self.numbers()

    def version(self, below: int | None = None) -> Manifest | None:
        """The newest version, or the newest one below a number."""
        numbers = [n for n in self.numbers() if below is None or n < below]
        return Manifest.of(self.files.read(f"manifests/{numbers[-1]:019d}.json")) if numbers else None

    # --- reading

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> set[Entry]:
        """The (period, bucket) pairs in which the keys of ``rows`` lie."""
        pairs = rows.select(self.period.alias(PERIOD), self._bucket().alias(BUCKET)).distinct().collect()
        return {(r[PERIOD] or 0, r[BUCKET]) for r in pairs}

    def read(self, version: Manifest | None = None, entries: Iterable[Entry] | None = None) -> DataFrame | None:
        """The rows of a version (the newest without one), of some of its entries if given; None where it has none."""
        version = version or self.version()
        if version is None:
            return None
        merged = self._merged(version, version.entries if entries is None else entries)
        return None if merged is None else merged.drop(VERSION)

    def _merged(self, version: Manifest, entries: Iterable[Entry], live: bool = True) -> DataFrame | None:
        folders = [f for entry in entries for f in version.entries.get(entry, ())]
        if not folders:
            return None
        schema = StructType([*version.schema.fields, StructField(VERSION, LongType())])
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in folders])
        if self.plain:
            return rows
        values = [F.col(c) for c in rows.columns if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), F.col(self.order or VERSION)).alias("__row"))
        whole = newest.select(*[F.col(c) if c in self.keys else F.col("__row")[c].alias(c) for c in rows.columns])
        return whole.where(~F.coalesce(GONE, F.lit(False))) if live and GONE in version.schema.names else whole

    def opening(self, rows: DataFrame, below: int, exact: bool = True) -> DataFrame | None:
        """The rows, in the version before ``below``, of the keys that occur in ``rows``; None where there are none.

        Without ``exact`` also other rows of the same buckets and periods.
        """
        version = self.version(below)
        if version is None:
            return None
        held = self.read(version, sorted(self.touched(rows) & version.entries.keys()))
        if held is None or not exact:
            return held
        asked = rows.select(*[F.col(c).alias(f"__{c}") for c in self.keys]).distinct()
        return held.join(asked, same_keys(self.keys), "left_semi")

    # --- writing

    def commit(self, number: int, changes: DataFrame, high: int | None = None, drop_below: int | None = None) -> None:
        """Make version ``number``: the one before with ``changes`` and without periods below ``drop_below``.

        A version that is there already stays as it is.
        """
        if self.has(number):
            return
        before = self.version(number)
        schema = before.schema if before else changes.schema
        entries = {e: list(f) for e, f in before.entries.items()} if before else {}
        placed = changes.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        added = self._write(placed.withColumn(VERSION, F.lit(number).cast("long")), number)
        for entry, folder in added.items():
            entries.setdefault(entry, []).append(folder)
        version = Manifest(number, schema, self.buckets, high, entries)
        if drop_below is not None:
            version.entries = {e: f for e, f in entries.items() if e[0] >= drop_below}
        crowded = [e for e in added if len(version.entries.get(e, ())) > self.most_deltas]
        if crowded:
            # removals stay, as an older addition of their key may still come
            fresh = self._write(self._merged(version, crowded, live=False), number)
            for entry in crowded:
                version.entries[entry] = [fresh[entry]] if entry in fresh else []
        self.files.put(f"manifests/{number:019d}.json", version.text())
        self._sweep(number)

    def _write(self, rows: DataFrame, number: int) -> dict[Entry, str]:
        folder = f"{number}-{uuid.uuid4().hex[:12]}"
        placed = rows.withColumn(PERIOD, F.coalesce(self.period, F.lit(0).cast("long"))).withColumn(BUCKET, self._bucket())
        placed.repartition(PERIOD, BUCKET).write.partitionBy(PERIOD, BUCKET).parquet(f"{self.path}/data/{folder}")
        found = {}
        for period in self.files.names(f"data/{folder}"):
            if period.startswith(f"{PERIOD}="):
                for bucket in self.files.names(f"data/{folder}/{period}"):
                    found[int(period.split("=")[1]), int(bucket.split("=")[1])] = f"{folder}/{period}/{bucket}"
        return found

    def _sweep(self, number: int) -> None:
        """Delete old manifests and the folders that no manifest left names."""
        numbers = self.numbers()
        for old in numbers[:-KEPT]:
            self.files.delete(f"manifests/{old:019d}.json")
        named: set[str] = set()
        for n in numbers[-KEPT:]:
            held = Manifest.of(self.files.read(f"manifests/{n:019d}.json"))
            named.update(f.split("/")[0] for folders in held.entries.values() for f in folders)
        for folder in self.files.names("data"):
            if folder not in named and int(folder.split("-")[0]) < number:
                self.files.delete(f"data/{folder}")


def same_keys(keys: Sequence[str], prefix: str = "__") -> Column:
    """Null-safe equality of the key columns with their prefixed counterparts."""
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return same


def keyed_table_sink(
    path: str, keys: Sequence[str], seq: str, op: str = "op", buckets: int = BUCKETS, most_deltas: int = MOST_DELTAS
):
    """Keep the table that a stream of change-log rows describes: `read_keyed_table` gives one row per key.

    Of the changes of a key the one with the largest ``seq`` wins, an addition before a retraction of the same number,
    whichever batch brings it; a retraction that wins removes the key. The log itself is not kept.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, path, keys, order="__at", buckets=buckets, most_deltas=most_deltas)
        if table.has(batch_id):
            return
        at = F.struct(F.col(seq), F.col(op))
        values = [c for c in batch.columns if c not in (*keys, op)]
        last = batch.groupBy(*keys).agg(F.max_by(F.struct(*values, at.alias("__at"), (~F.col(op)).alias(GONE)), at).alias("__row"))
        table.commit(batch_id, last.select(*keys, "__row.*"))

    return lambda writer: writer.foreachBatch(write)


def read_keyed_table(spark: SparkSession, path: str, keys: Sequence[str], seq: str) -> DataFrame | None:
    """One row per key of a table that `keyed_table_sink` keeps, without the change number."""
    held = StateTable(spark, path, keys, order="__at").read()
    return None if held is None else held.drop("__at", GONE, seq)
