"""Session helpers: a tuned SparkSession, the shared checkpoint folder, written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app_name: str = "custseg",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with AQE, skew-join handling and Arrow on.

    ``master`` is only applied when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, str(v))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the context from the session.

    The folder named by ``spark.checkpoint.dir`` is used as is. Where it is unset (tests,
    laptops) a folder inside ``spark.sql.warehouse.dir`` is used: the warehouse is shared by
    driver and executors wherever tables can be written at all, a local temp folder is not.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()


#: Scratch tables by application and scope, and the scopes that are open now.
_SCRATCH: dict[tuple[str, str], list[str]] = {}
_OPEN: list[str] = []


@contextmanager
def scratch_scope(name: str) -> Iterator[None]:
    """Tables that ``materialise`` writes inside belong to the scope ``name`` (of the innermost one) and live
    until ``release_scratch(spark, name)``; tables written outside every scope are never deleted here."""
    _OPEN.append(name)
    try:
        yield
    finally:
        _OPEN.pop()


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder below the shared checkpoint folder and read
    it back. Unlike ``checkpoint()`` later readers still prune columns and push filters. ``compression`` names
    a codec other than the session's."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    if _OPEN:
        _SCRATCH.setdefault((spark.sparkContext.applicationId, _OPEN[-1]), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession, scope: str) -> None:
    """Delete the tables that ``materialise`` has written in ``scope``. Call it where nothing lazy
    reads them any more: between jobs whose results have been written."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in _SCRATCH.pop((spark.sparkContext.applicationId, scope), []):
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder (reliable, survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
