"""Session settings the library expects, for clusters and for local tests."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that hold at any size. AQE sizes shuffle partitions and splits skewed
# join partitions; it may add a shuffle to do so, which is cheaper than one straggling task.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "tillstar", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` adds or overrides entries."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an execution go when it ends.

    Else they stay until the driver happens to collect its garbage, so a row of large writes holds those of all of them.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-master session without that setting (tests) gets a folder of its own; on a
    cluster a missing setting is an error, since a machine-local folder would not be shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tillstar-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read back, for frames that are read several times.

    A lost executor costs a task, not the table, and what reads it keeps columnar scans and sizes. The folder is
    removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)
