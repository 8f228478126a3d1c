"""What the operators of this package share."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder it was loaded from.

    On a cluster where the package is installed, or shipped with ``--py-files``, this changes
    nothing; it helps sessions whose working folder is not the repository.
    """
    paths = spark.sparkContext.environment
    known = paths.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        paths["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])


def map_rows(
    df: DataFrame, schema: str, rows: Callable[..., Iterator[tuple]], *args, batch: int = 256
) -> DataFrame:
    """``rows(iterator of input tuples, *args)`` over every partition, as a streamed Arrow map.

    Inputs reach the function in the order of the columns of ``df``; outputs leave in batches of
    ``batch`` rows, so a task holds a few batches at any time, whatever the size of its partition.
    """
    importable(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def inputs() -> Iterator[tuple]:
            for b in batches:
                for at in range(0, b.num_rows, batch):
                    part = b.slice(at, batch)
                    yield from zip(*(part.column(i).to_pylist() for i in range(part.num_columns)))

        held: list[tuple] = []
        for row in rows(inputs(), *args):
            held.append(row)
            if len(held) >= batch:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    # Inputs are told apart by their place; a name with a dot would not be resolved.
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))]).mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
    )


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def text_or_empty(name: str = "text"):
    """The column with null read as the empty text."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for an intermediate table under ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own machine; a
    cluster must name one that all executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: its lineage ends there, and it
    survives the loss of executors."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession, rows: int, each: int) -> int:
    """Groups for ``rows`` at ``each`` rows a group, at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))
