"""Session settings every job relies on."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

# Settings that change results: every job needs exactly these.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only change speed; values the session already has win.
# - AQE coalesces small shuffle partitions, splits skewed join partitions and turns a
#   sort-merge join into a broadcast join once the measured side is small enough.
# - advisoryPartitionSizeInBytes keeps a reduce task well inside executor memory.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app: str = "opsmart", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the engine's settings; ``conf`` overrides the tuning ones."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**conf, **RESULT_CONF}.items():
        builder = builder.config(key, value)
    spark = pin(builder.getOrCreate())
    given = spark.sparkContext.getConf()
    for key, value in TUNING_CONF.items():
        if key not in conf and not given.contains(key):
            spark.conf.set(key, value)
    return spark


def pin(spark: SparkSession) -> SparkSession:
    """Set the result-relevant options on a session somebody else created."""
    for key, value in RESULT_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, visible to every executor.

    Lives under the folder the cluster names in ``spark.checkpoint.dir``. Only a local-mode
    session without that setting falls back to a temporary folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="opsmart-")
    return f"{root.rstrip('/')}/opsmart/{label}-{uuid.uuid4().hex}"


def byte_size(spark: SparkSession, key: str) -> int:
    """A setting of the session that is a size."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


def stored_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Size of stored files, from the file system's own bookkeeping; a missing path counts 0."""
    total = 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def input_paths(df: DataFrame) -> list[str]:
    """What a frame reads, for ``stored_bytes``: its files, or their folder where it reads many of one."""
    files = [unquote(f) for f in df.inputFiles()]
    together = Counter(f.rsplit("/", 1)[0] for f in files)
    return sorted({folder if together[folder := f.rsplit("/", 1)[0]] > 16 else f for f in files})


def shuffle_partitions(size: int, least: int, most: int, target: int = 128 << 20) -> int:
    """Partitions of ``target`` bytes for ``size`` bytes, between ``least`` and ``most``."""
    return max(least, min(most, math.ceil(size / target)))


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for a while; the former ones return afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def slice_depth(size: int, target: int = 512 << 20, most: int = 4) -> int:
    """How often a table of ``size`` stored bytes is halved, so that what a job shuffles at a time follows
    ``target`` bytes; every slice reads the table once more, so ``most`` bounds it (16 slices)."""
    return min(most, max(0, math.ceil(math.log2(max(1, size) / target))))


@contextmanager
def shuffles_for(
    spark: SparkSession,
    paths: list[str],
    target: int = 32 << 20,
    expansion: int = 4,
    per_core: int = 32,
    split: int = 32 << 20,
) -> Iterator[int]:
    """Enough shuffle partitions, and small enough input splits, for jobs over ``paths``; the former
    settings return afterwards.

    One partition per ``target`` bytes of input, decompressed by ``expansion``, never fewer than the
    session has and at most ``per_core`` for each of its cores: the driver tracks one output per map
    task and partition, so their number must not follow the input without bound. Beyond that bound
    partitions grow, and spill. A map task that sorts its rows before the shuffle holds one split of
    ``split`` bytes, which become ten times as much in memory; the same bound holds for their number.
    """
    key, split_key = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    before, split_before = int(spark.conf.get(key)), spark.conf.get(split_key)
    size, most = stored_bytes(spark, paths), per_core * spark.sparkContext.defaultParallelism
    wanted = shuffle_partitions(size * expansion, before, most, target)
    spark.conf.set(key, str(wanted))
    if (bounded := max(split, math.ceil(size / most))) < byte_size(spark, split_key):
        spark.conf.set(split_key, str(bounded))
    try:
        yield wanted
    finally:
        spark.conf.set(key, str(before))
        spark.conf.set(split_key, split_before)
