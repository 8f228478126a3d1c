"""Date-partitioned and snapshot tables on shared storage (Parquet).

A day of a date-partitioned table counts as loaded once its manifest, the list of its files, is
written after the job's commit. A snapshot is a folder of versions; a version is visible once its
mark is written after the commit, and the former version stays for readers that still use it. A table
in parts is a snapshot whose mark names, for every part, the version that holds it: a new version
writes the parts that change and shares the others.
"""

from __future__ import annotations

import hashlib
import json
import logging
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmart.operators.layout import along_curve
from opsmart.session import settings

_LOG = logging.getLogger(__name__)
INGESTION_DATE = "ingestion_date"
_DATE = r"\d{4}-\d{2}-\d{2}"
_MANIFESTS = "_loaded"
_VERSIONS = "_versions"
_MARK = "_COMMITTED"
#: How files are stored: about half the bytes of Spark's defaults (Snappy, whole values, 96-bit timestamps).
_FILES = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
_STAMPS = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


def _located(spark: SparkSession, name: str):
    """The Hadoop file system of a path, and the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _write_text(spark: SparkSession, name: str, text: str) -> None:
    fs, path = _located(spark, name)
    out = fs.create(path, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def _read_text(spark: SparkSession, name: str) -> str | None:
    """The text of a small file; None if there is none."""
    fs, path = _located(spark, name)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def store(spark: SparkSession, writer: DataFrameWriter, path: str) -> None:
    """Write a table's files: Zstandard, values as differences, timestamps of 64 bits."""
    with settings(spark, _STAMPS):
        writer.options(**_FILES).parquet(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing reads any more."""
    fs, path = _located(spark, folder)
    fs.delete(path, True)


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder; none if it is missing."""
    fs, path = _located(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def partition_dates(spark: SparkSession, root: str, column: str = INGESTION_DATE) -> list[str]:
    """Sorted dates of the ``column=YYYY-MM-DD`` folders directly under ``root``.

    One directory listing through the Hadoop file system of ``root`` - no data file is opened,
    and the answer has one entry per day. Other folder names are ignored; a missing root has no
    dates.
    """
    pattern = re.compile(f"{re.escape(column)}=({_DATE})")
    return sorted({m.group(1) for m in map(pattern.fullmatch, _names(spark, root)) if m})


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    return sorted(n for n in _names(spark, folder) if not n.startswith(("_", ".")))


def has_files(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds at least one non-hidden file; one that cannot be listed is reported
    and holds none."""
    fs, path = _located(spark, folder)
    try:
        listing = fs.listStatus(path)
    except Py4JJavaError as error:
        _LOG.warning("skipped %s: %s", folder, error.java_exception)
        return False
    return any(s.isFile() and not s.getPath().getName().startswith(("_", ".")) for s in listing)


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Path and size of every file of a folder that is not hidden, by path."""
    fs, path = _located(spark, folder)
    listing = [(s.getPath(), s.getLen()) for s in fs.listStatus(path) if s.isFile()]
    return sorted((p.toString(), size) for p, size in listing if not p.getName().startswith(("_", ".")))


def delete_files(spark: SparkSession, folder: str, prefix: str) -> None:
    """Delete the files of a folder whose names begin with ``prefix``."""
    fs, path = _located(spark, folder)
    for status in fs.listStatus(path):
        if status.getPath().getName().startswith(prefix):
            fs.delete(status.getPath(), False)


def move(spark: SparkSession, file: str, folder: str, name: str) -> None:
    """Move a file into a folder, which is made if need be, under a new name."""
    fs, path = _located(spark, folder)
    fs.mkdirs(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path, name)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(file), target):
        raise OSError(f"{file} was not moved to {folder}/{name}")


def read_head(spark: SparkSession, name: str, length: int) -> str:
    """The first bytes of a file as text."""
    fs, path = _located(spark, name)
    stream = fs.open(path)
    try:
        io = spark._jvm.org.apache.commons.io
        return io.IOUtils.toString(io.input.BoundedInputStream(stream, length), "UTF-8")
    finally:
        stream.close()


class Manifests:
    """Which days of a date-partitioned table are loaded: by day the number of its files and a digest of
    their names.

    A run writes one manifest that holds all days, its own among them, and then deletes those it has
    read; where two runs overlap both manifests stay and hold together. Opening it is one listing and
    mostly one file, however many days there are.
    """

    def __init__(self, spark: SparkSession, root: str, column: str = INGESTION_DATE):
        self.spark, self.root, self.column = spark, root, column
        self.folder = f"{root}/{_MANIFESTS}"
        self.names = sorted(n for n in _names(spark, self.folder) if n.startswith(f"{column}-"))
        self.days: dict[str, list] = {}
        for name in self.names:
            self.days |= json.loads(_read_text(spark, f"{self.folder}/{name}") or "{}")

    def describe(self, day: str) -> list:
        """What a manifest says of the day as it is now."""
        files = _data_files(self.spark, f"{self.root}/{self.column}={day}")
        return [len(files), hashlib.sha256("\n".join(files).encode()).hexdigest()]

    def loaded(self, verify: bool = False) -> set[str]:
        """Days that are recorded and whose folder is there; with ``verify`` also all their files."""
        there = self.days.keys() & set(partition_dates(self.spark, self.root, self.column))
        return {d for d in there if self.describe(d) == self.days[d]} if verify else there

    def write(self, without: Iterable[str] = (), also: Iterable[str] = ()) -> None:
        """Record days as they are now, and forget others."""
        gone = set(without)
        days = {d: v for d, v in self.days.items() if d not in gone} | {d: self.describe(d) for d in also}
        number = 1 + max((int(n.split("-")[-2]) for n in self.names), default=0)
        name = f"{self.column}-{number:010d}-{uuid.uuid4().hex[:8]}"
        _write_text(self.spark, f"{self.folder}/{name}", json.dumps(days))
        for old in self.names:
            fs, path = _located(self.spark, f"{self.folder}/{old}")
            fs.delete(path, False)
        self.names, self.days = [name], days


def missing_dates(
    spark: SparkSession,
    landing: str,
    bronze: str,
    landing_column: str = INGESTION_DATE,
    bronze_column: str = INGESTION_DATE,
    verify: bool = False,
) -> list[str]:
    """Landing dates that bronze does not have yet, oldest first.

    An empty or half-written bronze folder is not a loaded day: the manifest decides. The folders of
    recorded days are listed only to ``verify`` that no file of theirs was lost.
    """
    loaded = Manifests(spark, bronze, bronze_column).loaded(verify)
    return [d for d in partition_dates(spark, landing, landing_column) if d not in loaded]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; of a snapshot its newest committed version."""
    version = current_version(spark, path)
    if version is None:
        return spark.read.parquet(path)
    mark = read_mark(spark, version)
    if "parts" in mark:
        return read_parts(spark, path, mark)
    # The stored schema keeps the types of partition columns, whose folder names hold only text.
    schema = T.StructType.fromJson(mark)
    return spark.read.schema(schema).parquet(version).select(*[f"`{n}`" for n in schema.names])


def read_mark(spark: SparkSession, version: str) -> dict:
    """What a committed version says of itself: its schema, or of a table in parts its ``schema``,
    the ``parts`` (label -> name of the version that holds it), their ``column`` and a ``note``."""
    return json.loads(_read_text(spark, f"{version}/{_MARK}"))


def read_parts(
    spark: SparkSession, path: str, mark: Mapping, labels: Iterable[str] | None = None, extra: str = ""
) -> DataFrame:
    """The rows of some parts (all without ``labels``) as a mark names them. No other folder is listed.
    ``extra`` are stored columns beyond the schema, as DDL."""
    schema = T.StructType.fromJson(mark["schema"])
    if extra:
        schema = T.StructType([*schema.fields, *T.StructType.fromDDL(extra).fields])
    wanted = sorted(mark["parts"] if labels is None else set(labels) & set(mark["parts"]))
    folders = [f"{path}/{_VERSIONS}/{mark['parts'][label]}/{mark['column']}={label}" for label in wanted]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def latest_folder(spark: SparkSession, root: str, column: str = INGESTION_DATE) -> str:
    """Folder of the newest date partition; no partition at all is an error."""
    dates = partition_dates(spark, root, column)
    if not dates:
        raise ValueError(f"no {column} partition under {root}")
    return f"{root}/{column}={dates[-1]}"


def read_latest(spark: SparkSession, root: str, column: str = INGESTION_DATE) -> DataFrame:
    """The newest date partition. Only that folder is listed and scanned."""
    return spark.read.option("basePath", root).parquet(latest_folder(spark, root, column))


def latest_partition(df: DataFrame, column: str = INGESTION_DATE) -> DataFrame:
    """The rows of the greatest ``column`` value of any frame; no value at all is an error.

    Only the one maximum comes to the driver. As a literal it prunes partitions while the second
    read is planned; on a partitioned table the first read opens no data column either.
    """
    newest = df.agg(F.max(column)).first()[0]
    if newest is None:
        raise ValueError(f"no {column} found")
    return df.where(F.col(column) == F.lit(newest))


def replace_partitions(
    df: DataFrame, root: str, column: str = INGESTION_DATE, days: Sequence[str] | None = None
) -> None:
    """Write a frame so that only the dates it contains are replaced, then record those days.

    ``days`` names the days the frame was read from; by default the days found in it are recorded.
    Named days that are recorded are forgotten before the write, so a write that fails midway leaves
    them to be loaded again.
    """
    spark, seen, manifests = df.sparkSession, Observation(), Manifests(df.sparkSession, root, column)
    if manifests.days.keys() & set(days or ()):
        manifests.write(without=days)
    out = df.observe(seen, F.collect_set(F.col(column).cast("string")).alias("days"))
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column)
    store(spark, writer, root)
    Manifests(spark, root, column).write(also={*(days or ()), *seen.get["days"]})


def _committed(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed versions of a snapshot, oldest first."""
    folder = f"{path}/{_VERSIONS}"
    found = sorted(n for n in _names(spark, folder) if n.startswith("v-"))
    return [n for n in found if _MARK in _names(spark, f"{folder}/{n}")]


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest committed version; None for a table that is no snapshot."""
    folder = f"{path}/{_VERSIONS}"
    fs, root = _located(spark, folder)
    if not fs.exists(root):
        return None
    versions = _committed(spark, path)
    if not versions:
        raise ValueError(f"no committed version of {path}")
    return f"{folder}/{versions[-1]}"


def _next_version(names: Sequence[str]) -> str:
    """The name of a version after all those in a folder."""
    number = 1 + max((version_number(n) for n in names if n.startswith("v-")), default=0)
    return f"v-{number:010d}-{uuid.uuid4().hex[:8]}"


def version_number(name: str) -> int:
    """The number in a version's name or folder."""
    return int(name.rsplit("/", 1)[-1].split("-")[1])


def last_versions(spark: SparkSession, path: str, count: int = 2) -> list[str]:
    """Folders of the newest committed versions of a snapshot, newest first; none if there is none."""
    return [f"{path}/{_VERSIONS}/{n}" for n in reversed(_committed(spark, path)[-count:])]


def replace_parts(
    df: DataFrame,
    path: str,
    column: str,
    touched: Iterable[str],
    schema: T.StructType,
    note: Mapping[str, object],
    version: str | None = None,
) -> None:
    """A new version of a table in parts: the ``touched`` parts hold the rows of ``df``, whose
    ``column`` is the label, all others stay the files they are.

    ``df`` may read the table itself. A part without rows is gone. Readers see the former version until
    the mark of the new one is written; a failed write changes nothing. ``schema`` is what readers of
    the table get. Parts that neither this version nor the one before names are deleted.
    """
    spark, folder = df.sparkSession, f"{path}/{_VERSIONS}"
    before = _names(spark, folder)
    former = last_versions(spark, path, 1)
    old = read_mark(spark, former[0])["parts"] if former else {}
    name = version or _next_version(before)
    out = df.hint("rebalance", column).sortWithinPartitions(column)
    store(spark, out.write.partitionBy(column), f"{folder}/{name}")
    written = [n.split("=", 1)[1] for n in _names(spark, f"{folder}/{name}") if n.startswith(f"{column}=")]
    gone = set(touched)
    parts = {k: v for k, v in old.items() if k not in gone} | dict.fromkeys(written, name)
    mark = {"schema": json.loads(schema.json()), "parts": parts, "column": column, "note": dict(note)}
    _write_text(spark, f"{folder}/{name}/{_MARK}", json.dumps(mark))
    named = {(v, k) for m in (old, parts) for k, v in m.items()}
    for other in before:
        used = {k for v, k in named if v == other}
        if not used and not (former and former[0].endswith(other)):
            fs, unused = _located(spark, f"{folder}/{other}")
            fs.delete(unused, True)
            continue
        for entry in _names(spark, f"{folder}/{other}"):
            if entry.startswith(f"{column}=") and entry.split("=", 1)[1] not in used:
                fs, unused = _located(spark, f"{folder}/{other}/{entry}")
                fs.delete(unused, True)


def new_version(spark: SparkSession, path: str) -> str:
    """The name that the next version of a snapshot gets."""
    return _next_version(_names(spark, f"{path}/{_VERSIONS}"))


def replace_snapshot(
    df: DataFrame,
    path: str,
    rows_per_file: int = 0,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    curve_by: Sequence[str] = (),
) -> None:
    """Replace a whole table, schema included, by a new version.

    Readers see the former version until the new one is committed; a failed write changes nothing.
    ``df`` may read the table itself. Two versions are kept, older and failed ones are deleted.

    ``rows_per_file`` bounds the files a task writes (0 = no bound). ``partition_by`` stores a folder
    per value of one column: rows are rebalanced on it, so that AQE splits a value with very many
    rows, and sorted by ``cluster_by`` inside. ``cluster_by`` alone stores ranges of those columns;
    ``curve_by`` stores ranges along a curve over several columns, and ``cluster_by`` settles ties.
    Either way the statistics of files and row groups let filters on them skip data.
    """
    out = df
    if partition_by is not None:
        out = df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *cluster_by)
    elif curve_by:
        order = ["_curve", *cluster_by]
        out = along_curve(df, curve_by).repartitionByRange(*order).sortWithinPartitions(*order).drop("_curve")
    elif cluster_by:
        out = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    replace_by_slices([out], path, rows_per_file, partition_by)


def replace_by_slices(
    slices: Iterable[DataFrame], path: str, rows_per_file: int = 0, partition_by: str | None = None
) -> None:
    """``replace_snapshot`` by rows that come in slices (at least one, of one schema), written one after
    the other into one version; an iterator may prepare each when it is asked for."""
    version = None
    for out in slices:
        if version is None:
            spark, folder, schema = out.sparkSession, f"{path}/{_VERSIONS}", out.schema
            before = _names(spark, folder)
            kept = _committed(spark, path)[-1:]
            version = f"{folder}/{_next_version(before)}"
        writer = out.write.mode("append").option("maxRecordsPerFile", rows_per_file)
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        store(spark, writer, version)
    _write_text(spark, f"{version}/{_MARK}", schema.json())
    for name in before:
        if name not in kept:
            delete_folder(spark, f"{folder}/{name}")


def register_catalogue(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Open every table of a name -> path registry and expose each as a temporary view."""
    tables = {name: read_table(spark, path) for name, path in paths.items()}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows."""
    return df.limit(n)
