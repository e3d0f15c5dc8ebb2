"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Where local sessions keep working files if they name no folder.
LOCAL_FOLDER = f"{tempfile.gettempdir()}/footfall-local"

#: Settings the operators are designed for.  Partition counts are left to AQE:
#: it coalesces small shuffle partitions and splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("footfall")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", LOCAL_FOLDER)
        # small inputs that grow inside a stage (sliding windows) keep all cores busy
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_zone(spark: SparkSession) -> None:
    """Window bounds are epoch-aligned, so text and NTZ columns are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session, where all are one process, may leave that unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = LOCAL_FOLDER
    return f"{root.rstrip('/')}/footfall/{label}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and ``path`` in its terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def drop_folder(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    files, at = _files(spark, source)
    files.mkdirs(_files(spark, target.rsplit("/", 1)[0])[1])
    if not files.rename(at, _files(spark, target)[1]):
        raise OSError(f"could not move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is none."""
    files, at = _files(spark, path)
    if not files.exists(at):
        return None
    return "\n".join(r.value for r in spark.read.text(path).collect())


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Puts a small file in the place of the one before, in one step."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files, at = _files(spark, path)
    beside = hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    out = files.create(beside)
    out.write(bytearray(text.encode()))
    out.close()
    modes = spark._jvm.java.lang.reflect.Array.newInstance(hadoop.Options.Rename.OVERWRITE.getClass(), 1)
    modes[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, at, modes)


@contextmanager
def state_partitions(spark: SparkSession, per_core: int = 1) -> Iterator[None]:
    """Streams started inside get state partitions by the number of cores, where nobody has chosen one.

    Stateful stages are not coalesced at run time, and the number of a stream's
    partitions is fixed by its first start.  A number that the caller has set stays;
    Spark's default does not suit a local session.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    chosen = before != "200" or not spark.sparkContext.master.startswith("local")
    if not chosen:
        spark.conf.set(name, str(max(spark.sparkContext.defaultParallelism * per_core, 1)))
    try:
        yield
    finally:
        if not chosen:
            spark.conf.set(name, before)
