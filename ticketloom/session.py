"""Session helpers shared by all operators: settings, shared storage, bounded id filters."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()

#: A Python worker gets at most this many rows and bytes of text at a time, so that very long
#: documents do not add up in its memory.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def build_session(cores: int | str = 8, app: str = "ticketloom", **conf: str) -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give executors this package, once for each application; needs no --py-files."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-ship-"), "ticketloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def bounded_batches(spark: SparkSession) -> None:
    """Make Python workers ready: the package is there, and Arrow batches are bounded unless the
    session already asks for less."""
    ship(spark)
    for key, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        now = spark.conf.get(key, None)
        number = int(now) if now is not None and now.lstrip("-").isdigit() else -1
        if number <= 0 or number > value:
            spark.conf.set(key, str(value))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a new
    temporary folder in local mode (tests, one machine), else an error."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="spark-ticketloom-", dir="/tmp")
    return _OWN_FOLDERS[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark removes a query's shuffle files when the query ends, not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back. Cuts the lineage, survives lost
    executors, and computes what several branches need once. The shuffle files of the write go with it;
    ``release`` removes the table itself."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned, once nothing reads them any more."""
    for df in tables:
        path = getattr(df, "_written_path", None)
        if isinstance(path, str):
            jvm = df.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class IdFilter:
    """A bitmap of hashed ids of at most ``max_bits`` bits: never misses an id, may let others pass.

    Built by Spark as an OR of bits for each word of 32, so the driver gets at most max_bits / 32 rows of
    two numbers however many ids there are (64 MiB at the default) and tasks 16 MiB. Beyond some 10^8 ids it
    fills up and lets more rows pass; it never changes a result. A null id has a slot of its own.
    """

    def __init__(self, bits: np.ndarray, hashed: bool = False):
        self.bits, self.hashed = bits, hashed

    @classmethod
    def of(cls, ids: DataFrame, column: str, count: int, max_bits: int = 1 << 27, hashed: bool = False) -> IdFilter:
        """hashed: the column is a hash already, its low bits are the slot."""
        size = 1 << 16
        while size < min(16 * count, max_bits):
            size *= 2
        slot = F.pmod(F.col(column) if hashed else F.xxhash64(F.col(column)), F.lit(size))
        words = (
            ids.select(F.shiftright(slot, 5).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(31).cast("int")).alias("bit"))
            .groupBy("word")
            .agg(F.bit_or("bit").alias("bit"))
            .toArrow()
        )
        bits = np.zeros(size // 32, np.uint32)
        bits[words["word"].to_numpy()] = words["bit"].to_numpy().astype(np.uint32)
        return cls(bits, hashed)

    def slot(self, column: str) -> Column:
        """The slot of a row; compute it in Spark and test it with ``has``."""
        return F.pmod(F.col(column) if self.hashed else F.xxhash64(F.col(column)), F.lit(len(self.bits) * 32))

    def has_hash(self, hashes: np.ndarray) -> np.ndarray:
        return self.has(hashes & np.int64(len(self.bits) * 32 - 1))

    def has(self, slots: np.ndarray) -> np.ndarray:
        return (self.bits[slots >> 5] >> (slots & 31).astype(np.uint32)) & 1 == 1
