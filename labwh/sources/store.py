"""Report tables that change in one step: files are written aside, one manifest names those that count.

A :class:`Store` is a folder with a subfolder per table and numbered manifests. A manifest lists each table's files, its
schema, and marks such as "read up to". Writers add files, which nobody reads yet, and then create the next
manifest; creating it fails if another writer was faster. Readers take the newest complete manifest. A
writer that stops in between leaves the old state as it was and files that ``clean`` removes; running it again gives the
result it would have given.

The file system must refuse to create a file that exists (HDFS and local disks do).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwh.operators.common import require
from labwh.operators.merge import check_unique, upsert_rows
from labwh.sources.staging import staged

#: Folder level that tells the files of one write apart; it reads as a partition column and is dropped.
WRITE = "_write"


@dataclass(frozen=True)
class Table:
    """Files of a table, by path under its folder, and its schema as JSON."""

    files: tuple[str, ...]
    schema: str
    partition_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: Mapping[str, Table] = field(default_factory=dict)
    marks: Mapping[str, str] = field(default_factory=dict)


class Conflict(RuntimeError):
    """Another writer has published since the version that this one built on."""


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _manifests(self) -> list[str]:
        folder = self._path(f"{self.root}/_manifests")
        if not self._fs.exists(folder):
            return []
        return sorted((s.getPath().toString() for s in self._fs.listStatus(folder)), reverse=True)

    def latest(self) -> Version:
        """The newest complete version; number 0 without any."""
        for path in self._manifests():
            stream = self._fs.open(self._path(path))
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                found = json.loads(text)
            except ValueError:
                continue  # its writer stopped, or is not done
            tables = {
                n: Table(tuple(t["files"]), t["schema"], tuple(t["partition_by"])) for n, t in found["tables"].items()
            }
            return Version(found["number"], tables, found["marks"])
        return Version()

    def publish(self, base: Version, tables: Mapping[str, Table], marks: Mapping[str, str] | None = None) -> Version:
        """The next version: ``base`` with the given tables and marks in place of its own."""
        number = max([base.number, *self._numbers()]) + 1 if base.number == self.latest().number else None
        if number is None:
            raise Conflict(f"version {base.number} is not the newest one")
        made = Version(number, {**base.tables, **tables}, {**base.marks, **(marks or {})})
        text = json.dumps({
            "number": number, "marks": dict(made.marks),
            "tables": {n: {"files": t.files, "schema": t.schema, "partition_by": t.partition_by} for n, t in made.tables.items()},
        })
        path = self._path(f"{self.root}/_manifests/{number:012d}.json")
        try:
            stream = self._fs.create(path, False)
        except Exception as error:
            raise Conflict(f"version {number} was published by another writer") from error
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        return made

    def _numbers(self) -> list[int]:
        """Numbers in use, those of incomplete manifests too."""
        return [int(p.rsplit("/", 1)[1].split(".")[0]) for p in self._manifests()]

    def _files(self, folder: str) -> list[str]:
        found, listing = [], self._fs.listFiles(self._path(folder), True)
        while listing.hasNext():
            path = listing.next().getPath()
            if not path.getName().startswith(("_", ".")):
                found.append(path.toString())
        return found

    def write(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> Table:
        """New files of a table, not yet part of any version."""
        require(df, partition_by)
        name = f"{WRITE}={uuid.uuid4().hex}"
        base = f"{self.root}/{table}"
        rows = df.hint("rebalance", *partition_by) if partition_by else df
        rows.write.partitionBy(*partition_by).parquet(f"{base}/{name}")
        mark = f"/{table}/{name}/"
        files = [f"{name}/{p.split(mark, 1)[1]}" for p in self._files(f"{base}/{name}")]
        return Table(tuple(sorted(files)), df.schema.json(), tuple(partition_by))

    def read(
        self, table: str, version: Version | None = None, files: Sequence[str] | None = None, file_column: str | None = None
    ) -> DataFrame:
        """A table of a version (the latest), or some of its files. ``file_column`` adds the file's path
        under the table's folder."""
        found = (version or self.latest()).tables[table]
        schema = T.StructType.fromJson(json.loads(found.schema))
        files = found.files if files is None else files
        if not files:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(file_column, F.lit(None).cast("string")) if file_column else empty
        base = f"{self.root}/{table}"
        full = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType())])
        reader = self.spark.read.schema(full).option("basePath", base)
        df = reader.parquet(*[f"{base}/{f}" for f in files])
        columns = [F.col(n) for n in schema.names]
        if file_column:
            path = F.regexp_extract(F.col("_metadata.file_path"), f"({WRITE}=[^/]+/.*)$", 1)
            columns.append(path.alias(file_column))
        return df.select(*columns)

    def clean(self) -> int:
        """Removes files that the newest version does not name; only while nobody writes or reads older versions."""
        version, gone = self.latest(), 0
        for status in self._fs.listStatus(self._path(self.root)):
            table = status.getPath().getName()
            if not status.isDirectory() or table == "_manifests":
                continue
            named = set(version.tables[table].files) if table in version.tables else set()
            for path in self._files(f"{self.root}/{table}"):
                if path.split(f"/{table}/", 1)[1] not in named:
                    self._fs.delete(self._path(path), False)
                    gone += 1
        return gone


def _folder(file: str) -> str:
    """Partition folder of a file, without the level of its write."""
    return "/".join(file.split("/")[1:-1])


def with_partitions_replaced(old: Table | None, new: Table) -> Table:
    """``old`` with the partitions that ``new`` has rows of taken from ``new``."""
    if old is None:
        return new
    touched = {_folder(f) for f in new.files}
    return Table((*[f for f in old.files if _folder(f) not in touched], *new.files), new.schema, new.partition_by)


def publish_together(
    store: Store, df: DataFrame, history: str, cols: Sequence[str], current: str, drop: Sequence[str] = ()
) -> Version:
    """One result into a partitioned history, whose other partitions stay, and a current table, in one step. The
    result is computed once and copied from the shared folder."""
    base = store.latest()
    rows = staged(df, "publish")
    kept = store.write(rows, history, cols)
    now = store.write(rows.drop(*drop), current)
    return store.publish(base, {history: with_partitions_replaced(base.tables.get(history), kept), current: now})


@dataclass(frozen=True)
class Upserted:
    version: Version
    touched: tuple[str, ...]
    kept: tuple[str, ...]


def upsert_files(store: Store, table: str, source: DataFrame, keys: Sequence[str]) -> Upserted:
    """Inserts new keys and fully replaces existing ones; only files that hold a key of the source are rewritten.

    The source is computed once. Its range of each key is a literal on the target's column, so the
    statistics in the files' footers rule out row groups without a read; the key columns of the rest meet the source's
    keys in a semi join, for which Spark builds a Bloom filter of the smaller side when that pays. The names of
    the files it hits come to the driver. Other files stay as they are and keep their names. NULL keys are equal.
    """
    base = store.latest()
    rows = staged(source, "upsert")
    check_unique(rows, keys)
    if table not in base.tables:
        made = store.write(rows, table)
        return Upserted(store.publish(base, {table: made}), (), ())
    old = base.tables[table]
    file = "_file"
    target = store.read(table, base, file_column=file)
    spans = rows.agg(*[f(k).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))],
                     *[F.count_if(F.col(k).isNull()).alias(f"none_{i}") for i, k in enumerate(keys)]).first()
    possible = F.lit(True)
    for i, k in enumerate(keys):
        inside = F.lit(False) if spans[f"lo_{i}"] is None else F.col(k).between(F.lit(spans[f"lo_{i}"]), F.lit(spans[f"hi_{i}"]))
        possible = possible & ((inside | F.col(k).isNull()) if spans[f"none_{i}"] else inside)
    named = rows.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    hit = target.where(possible).select(*keys, file).join(named, same, "left_semi").select(file).distinct()
    touched = sorted(r[0] for r in hit.collect())
    merged = upsert_rows(store.read(table, base, touched), rows, keys)
    new = store.write(merged, table, old.partition_by)
    kept = tuple(f for f in old.files if f not in set(touched))
    made = Table((*kept, *new.files), old.schema, old.partition_by)
    return Upserted(store.publish(base, {table: made}), tuple(touched), kept)


def take_new_rows(
    store: Store, table: str, source: DataFrame, ts: str, keys: Sequence[str], overlap: str = "0 days"
) -> Version:
    """Incremental scan with a kept high-water mark: adds to ``table`` the rows of ``source`` that it has not got.

    The mark is the greatest time taken so far and part of the manifest, so it moves together with the
    rows or not at all. Each run reads from ``overlap`` before the mark, for rows that came late; rows whose key is
    there already are left out, and of rows with one key the first by time is taken. Rows without a time are never
    taken, nor are rows later than the overlap. The bound is a literal on the raw column, and the table is
    read back over the overlap only.
    """
    require(source, [ts, *keys])
    base = store.latest()
    name = f"{table}.{ts}"
    kind = source.schema[ts].dataType
    rows = source.where(F.col(ts).isNotNull())
    if name in base.marks:
        bound = F.expr(f"CAST('{base.marks[name]}' AS {kind.simpleString()}) - INTERVAL {overlap}").cast(kind)
        rows = rows.where(F.col(ts) >= bound)
        known = store.read(table, base).where(F.col(ts) >= bound).select(*[F.col(k).alias(f"_had_{k}") for k in keys])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_had_{k}")) for k in keys])
        rows = rows.join(known, same, "left_anti")
    columns = source.columns
    first = F.min(F.struct(F.col(ts).alias("at"), F.struct(*columns).alias("row")))
    rows = staged(rows.groupBy(*keys).agg(first.alias("f")).select("f.row.*"), "new-rows")
    mark = rows.agg(F.max(F.col(ts)).cast("string")).first()[0]
    if mark is None:
        return base
    new = store.write(rows, table)
    old = base.tables.get(table)
    files = (*(old.files if old else ()), *new.files)
    mark = max(mark, base.marks.get(name, mark))
    return store.publish(base, {table: Table(files, new.schema)}, {name: mark})


def add_states(
    store: Store, make: Mapping[str, Callable[[DataFrame], DataFrame]], facts: DataFrame, day: str, until: object, name: str
) -> Version:
    """Incremental report states: adds to each state table what ``make`` reduces the days from the kept mark up to
    ``until`` (exclusive) to. The condition is on ``day`` itself, so other partitions of the facts are not read.

    Partial states of several runs lie side by side; a report merges them with the functions it would use on one
    (sums of sums, earliest of earliest). All states and the mark move in one step.
    """
    base = store.latest()
    kind = facts.schema[day].dataType.simpleString()
    rows = facts.where(F.col(day) < F.lit(str(until)).cast(kind))
    if name in base.marks:
        if base.marks[name] > str(until):
            raise ValueError(f"{name} was already taken up to {base.marks[name]}")
        rows = rows.where(F.col(day) >= F.lit(base.marks[name]).cast(kind))
    tables = {}
    for state, reduce_rows in make.items():
        new = store.write(reduce_rows(rows), state)
        old = base.tables.get(state)
        tables[state] = Table((*(old.files if old else ()), *new.files), new.schema)
    return store.publish(base, tables, {name: str(until)})
