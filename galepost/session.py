"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on. Broadcasts are left to the adaptive
# planner, which looks at the real size of a side, and a skewed join partition is
# split even where that costs one more exchange after the join.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("galepost")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_OWN_FOLDERS: dict[str, str] = {}
_SCOPES: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as the session names it.

    Where a local session names none, it gets a folder of its own that goes with the process;
    there the driver is the only executor. Any other session must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _OWN_FOLDERS:
        own = tempfile.mkdtemp(prefix="galepost-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _OWN_FOLDERS[context.applicationId] = own
    return _OWN_FOLDERS[context.applicationId]


def _stages(spark: SparkSession) -> str:
    return "/".join([shared_folder(spark), "galepost", spark.sparkContext.applicationId, *_SCOPES])


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Copies that ``stage`` writes inside are deleted at the end, when their readers are done."""
    _SCOPES.append(uuid.uuid4().hex)
    folder = _stages(spark)
    try:
        yield
    finally:
        _SCOPES.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    For a result that several branches of a plan read: the branches share one
    computation, each reads only its columns, and a lost executor costs a re-read
    instead of the whole lineage.
    """
    spark = df.sparkSession
    path = f"{_stages(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
