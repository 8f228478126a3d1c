"""Landing exports (JSON lines, CSV) into bronze."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmart.functions import times as when_
from opsmart.operators.audit import observed
from opsmart.session import byte_size
from opsmart.sources import csv_splits, lake

# Source systems, partition columns, reader options and header rules of the exports.
JSON_SYSTEM = "glpi"
CSV_SYSTEM = "drive_csv"
CSV_PARTITION = "_ingestion_date"
CORRUPT = "_corrupt_record"
EXTRA = "_extra_fields"
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
}
#: Bytes of a file that are read for its header, and files read at a time.
HEAD_BYTES, HEADS_AT_A_TIME = 64 << 10, 16
WORD_BREAKS = r"[ \-/]+"
NOT_IN_NAMES = r"[^a-z0-9_]"
NAMELESS = "col"


def clean_name(name: str) -> str:
    """Header text as an ASCII column name: no accents, words joined by underscores."""
    letters = filter(lambda ch: not unicodedata.combining(ch), unicodedata.normalize("NFKD", name))
    words = re.split(WORD_BREAKS, "".join(letters).lower().strip())
    return re.sub(NOT_IN_NAMES, "", "_".join(words)) or NAMELESS


def clean_names(names: Sequence[str]) -> list[str]:
    """Clean names, made unique with ``_1``, ``_2``, ... in order of appearance."""
    out: list[str] = []
    for base in map(clean_name, names):
        candidate, n = base, 0
        while candidate in out:
            n += 1
            candidate = f"{base}_{n}"
        out.append(candidate)
    return out


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON lines (column ``value``) as declared text fields, with nothing lost.

    Every record is parsed once, into a map, and the declared fields are taken from it. Fields beyond
    ``schema`` are kept in the map ``_extra_fields`` (NULL if there are none), a line that is no JSON
    object in ``_corrupt_record``. A line that holds a list gives one row for each of its elements.
    The fields are fixed, so there is no inference pass and bronze does not drift from day to day.
    """
    others = [c for c in lines.columns if c != "value"]
    listed = F.when(F.ltrim("value").startswith("["), F.from_json("value", "array<string>"))
    records = lines.where(F.col("value").rlike(r"\S")).select(
        *others, F.explode(F.coalesce(listed, F.array("value"))).alias("_record")
    )
    known = [F.lit(name) for name in schema.names]
    parsed = records.select(*others, "_record", F.from_json("_record", "map<string,string>").alias("_fields"))
    extra = F.map_filter("_fields", lambda name, _: ~name.isin(known))
    return parsed.select(
        *[F.try_element_at("_fields", F.lit(name)).alias(name) for name in schema.names],
        F.when(F.col("_fields").isNull(), F.col("_record")).alias(CORRUPT),
        F.when(F.size(extra) > 0, extra).alias(EXTRA),
        *others,
    )


def read_json_day(
    spark: SparkSession, folders: Sequence[str], schema: T.StructType | None, base: str
) -> DataFrame:
    """JSON-lines scan of day folders; the day is the partition column.

    With a schema every line goes through ``parse_lines``; without one Spark infers the fields.
    """
    reader = spark.read.option("basePath", base)
    if schema is None:
        return reader.option("multiLine", "false").json(list(folders))
    lines = reader.text(list(folders)).withColumn("_source_file", F.col("_metadata.file_path"))
    return parse_lines(lines, schema)


def _first_record(text: str) -> str | None:
    """The first record of a CSV text that is not blank, None if the text ends inside it."""
    held: list[str] = []
    for line in text.removeprefix("\ufeff").split("\n")[:-1]:
        held.append(line)
        if "\n".join(held).count('"') % 2 == 0:
            record = "\n".join(held).removesuffix("\r")
            if record.strip():
                return record
            held = []
    return None


def _header(spark: SparkSession, path: str, size: int) -> tuple[str, bool]:
    """The header record of a file, empty if it has none, and whether its lines end with carriage
    returns. Reads the first block only, longer ones for a header that does not fit."""
    length = HEAD_BYTES
    while True:
        text = lake.read_head(spark, path, length)
        record = _first_record(text if length < size else text + "\n")
        if record is not None or length >= size:
            return record or "", text.partition("\n")[0].endswith("\r")
        length *= 8


def _files_by_header(spark: SparkSession, folders: Sequence[str]) -> dict[tuple[str, bool, bool], list[str]]:
    """The CSV files of ``folders`` by header record, by whether they are larger than a split, and if so
    by their line ends.

    The driver, which lists the files anyway, reads the head of each, some at a time.
    """
    files = [f for folder in folders for f in lake.data_files(spark, folder)]
    most = byte_size(spark, "spark.sql.files.maxPartitionBytes")
    with ThreadPoolExecutor(HEADS_AT_A_TIME) as pool:
        headers = list(pool.map(lambda f: _header(spark, *f), files))
    groups: dict[tuple[str, bool, bool], list[str]] = {}
    for (path, size), (header, returns) in zip(files, headers):
        if header:
            groups.setdefault((header, size > most, size > most and returns), []).append(path)
    return groups


def csv_scans(spark: SparkSession, folders: Sequence[str]) -> list[DataFrame]:
    """One scan for each distinct header among the files of ``folders``: every value as text,
    cleaned header names, and the file each row comes from.

    Files larger than a split are read by several tasks (``csv_splits``); of the others ``multiLine``
    keeps each in one task.
    """
    scans = []
    for (header, large, returns), files in sorted(_files_by_header(spark, folders).items()):
        if large:
            raw = csv_splits.parsed(spark, files, header, CSV_OPTIONS, returns)
        else:
            raw = spark.read.options(**CSV_OPTIONS).csv(files).withColumn("_source_file", F.col("_metadata.file_path"))
        # The position stands for the name until the names are clean.
        cells = raw.columns[:-1]
        numbered = raw.toDF(*[f"_c{i}" for i in range(len(cells))], "_source_file")
        named = [F.col(f"_c{i}").alias(n) for i, n in enumerate(clean_names(cells))]
        scans.append(numbered.select(*named, "_source_file"))
    return scans


def _united(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv(spark: SparkSession, *folders: str) -> DataFrame:
    """The CSV files of the folders, united by column name; a column a file lacks is NULL there."""
    return _united(csv_scans(spark, folders)).drop("_source_file")


def with_lineage(df: DataFrame, system: str, run_ts: Column, stamp: str) -> DataFrame:
    """Source file, source system and ingest time of each row. Call it right on a scan, unless the
    frame already has its source files."""
    file = "_source_file" if "_source_file" in df.columns else "_metadata.file_path"
    return df.withColumns(
        {"_source_file": F.col(file), "_source_system": F.lit(system), stamp: run_ts}
    )


def ingest_json(
    spark: SparkSession,
    landing: str,
    bronze: str,
    schema: T.StructType | None = None,
    run_ts: Column | None = None,
    verify: bool = False,
) -> dict[str, object]:
    """Load every landing day that bronze lacks, all of them in one job; with ``verify`` also those
    that have lost a file.

    The scan is split by file blocks and written without a shuffle; one heavy day is simply more
    splits. Running it again loads nothing; deleting a bronze day and running restores that day.
    """
    dates = lake.missing_dates(spark, landing, bronze, verify=verify)
    folders = [f"{landing}/{lake.INGESTION_DATE}={d}" for d in dates]
    folders = [f for f in folders if lake.has_files(spark, f)]
    if not folders:
        return {"dates": [], "rows": 0}
    days = read_json_day(spark, folders, schema, landing)
    stamped = with_lineage(days, JSON_SYSTEM, when_.run_stamp(run_ts), "_ingest_bronze_ts")
    out, audit = observed(stamped, "ingest_json")
    loaded = [f.rsplit("=", 1)[1] for f in folders]
    lake.replace_partitions(out, bronze, days=loaded)
    return {"dates": loaded, "rows": audit.get["rows"]}


def ingest_csv(
    spark: SparkSession,
    landing: str,
    bronze: str,
    entity: str,
    run_ts: Column | None = None,
    verify: bool = False,
) -> dict[str, object]:
    """The same for CSV exports, whose columns come from each file's own header.

    Files of all days are grouped by header and each group is one scan, so the plan grows with the
    number of distinct headers, not with the number of days. Groups are united by column name: a
    reordered header does not shift values, and a column a file lacks is NULL there.
    """
    dates = lake.missing_dates(spark, landing, bronze, bronze_column=CSV_PARTITION, verify=verify)
    folders = {d: f"{landing}/{lake.INGESTION_DATE}={d}" for d in dates}
    folders = {d: f for d, f in folders.items() if lake.has_files(spark, f)}
    scans = csv_scans(spark, list(folders.values())) if folders else []
    if not scans:
        return {"dates": [], "rows": 0}
    day = F.regexp_extract("_source_file", rf"/{lake.INGESTION_DATE}=([0-9-]+)/[^/]*$", 1)
    stamped = with_lineage(_united(scans), CSV_SYSTEM, when_.run_stamp(run_ts), "_ingest_ts")
    stamped = stamped.withColumns({"_entity": F.lit(entity), CSV_PARTITION: day.cast("date")})
    out, audit = observed(stamped, "ingest_csv")
    lake.replace_partitions(out, bronze, CSV_PARTITION, list(folders))
    return {"dates": list(folders), "rows": audit.get["rows"]}
