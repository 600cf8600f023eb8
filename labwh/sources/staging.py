"""Intermediate tables in the folder that driver and executors share.

A :class:`Run` names them, writes each once and removes its own ones at the end; ``staged`` is the
same for a single table whose reader outlives the call.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which an execution's shuffle files go when it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: With it off, rows that are dealt by one key stay where they are for a join on this key and others.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. In local mode, where there is one machine, the warehouse serves
    as well; a cluster without the setting is refused, as its default warehouse lies beside the driver."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, stem: str) -> str:
    return f"{shared_dir(spark)}/{stem}-{uuid.uuid4().hex}"


def staged(df: DataFrame, stem: str) -> DataFrame:
    """Writes an expensive intermediate result to the shared folder and reads it back. Lost
    executors then cost a re-read, not a recomputation."""
    path = fresh_path(df.sparkSession, stem)
    paths = _scratch.get()
    if paths is not None:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold inside and are as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """For a step whose result is written before the end: tables staged inside are removed at the end, and the shuffle
    files of each execution inside go when it ends. They would otherwise stay until the driver happens to
    collect its garbage, so that a run needed disk for the shuffles of all its steps at once."""
    paths: list[str] = []
    outer = _scratch.set(paths)
    try:
        with settings(spark, {FREED: "true"}):
            yield
    finally:
        _scratch.reset(outer)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of this run's own through the file system that Spark itself uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Run:
    """Details that several reports of one run share.

    ``detail(key, make)`` computes a detail at its first use, writes it to the shared folder, and
    hands out the stored table from then on, so a detail costs one pass over the facts however many reports
    read it. A key names the detail and everything it depends on, such as the ``as_of`` date. ``make`` may ask for
    other details, which are stored before; tables staged by ``make`` go as soon as the detail is stored. ``drop``
    removes the tables of details that nothing reads any more. Use it as a context manager: at the end the run's
    folder is removed, so results must have been written by then.
    """

    def __init__(self, spark: SparkSession, name: str = "run") -> None:
        self.spark = spark
        self.path = fresh_path(spark, name)
        self._details: dict[Hashable, DataFrame] = {}
        self._paths: dict[Hashable, str] = {}
        self._open: list[Hashable] = []

    def detail(self, key: Hashable, make: Callable[[], DataFrame], dealt: bool = False) -> DataFrame:
        """``dealt``: the detail deals its rows by hand, so joins must leave them there."""
        if key not in self._details:
            if key in self._open:
                raise ValueError(f"detail {key!r} depends on itself")
            self._open.append(key)
            try:
                with passing(self.spark):
                    df = make()
                    path = f"{self.path}/detail-{len(self._details)}-{len(self._open)}"
                    with settings(self.spark, {ALL_KEYS: "false"} if dealt else {}):
                        df.write.option("compression", "zstd").parquet(path)
                self._details[key] = self.spark.read.schema(df.schema).parquet(path)
                self._paths[key] = path
            finally:
                self._open.remove(key)
        return self._details[key]

    def keys(self) -> tuple[Hashable, ...]:
        return tuple(self._details)

    def drop(self, keys: Iterable[Hashable]) -> None:
        """Removes the tables of details that were stored; they count, but can't be read any more."""
        for key in keys:
            if key in self._paths:
                remove(self.spark, self._paths.pop(key))

    def __len__(self) -> int:
        return len(self._details)

    def close(self) -> None:
        self._details.clear()
        remove(self.spark, self.path)

    def __enter__(self) -> Run:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()
