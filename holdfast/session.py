"""Session helpers: building a session and finding the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "holdfast", cpus: str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.appName(app_name)
        .master(f"local[{cpus}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, named by ``spark.checkpoint.dir``.

    A local session may leave it unset and gets a folder in its warehouse. A cluster session must name one,
    because a machine-local folder is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not context.getCheckpointDir():
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return context.getCheckpointDir().rstrip("/")


_SCRATCH: list[str] = []


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder, or below the innermost ``scratch`` folder; nothing is created there yet."""
    return f"{_SCRATCH[-1] if _SCRATCH else shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Everything staged inside is removed at the end, so results must be written or collected before.

    Queries return plans over tables they have staged; whoever runs one decides when those can go.
    """
    folder = fresh_path(spark, "scratch")
    _SCRATCH.append(folder)
    try:
        yield
    finally:
        _SCRATCH.remove(folder)
        drop_path(spark, folder)


def cut_lineage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint so a lost executor cannot lose it."""
    shared_root(spark)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, path: str) -> None:
    """``df`` as Parquet at ``path``. The shuffle files of its plan go when it is written and not when the driver next collects garbage."""
    name, conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", df.sparkSession.conf
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(name, before)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    The reader knows the real size of the table, so the planner broadcasts it when it is small
    enough and shuffles it when it is not.
    """
    path = fresh_path(df.sparkSession, purpose)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
