"""Turning rows into a stream of files, and running a stream to its end."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.session import drop_path, fresh_path

SLICE_ROWS = 5_000_000


def instant(naive: str) -> Column:
    """A zone-less time as a timestamp, read as UTC whatever the session zone is."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {naive})"))


def naive(moment: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({moment}), TIMESTAMP_NTZ'1970-01-01 00:00:00')")


def write_feed(rows: DataFrame, seq: str, path: str, slices: int = 3) -> None:
    """Rows as files in arrival order: one file for each slice of arrival numbers, all written by one job.

    Files are read in order of their modification times, which are set after the job; however files are
    grouped into batches, a batch then never holds rows older than those of the batch before it. A slice
    spans at most ``SLICE_ROWS`` arrival numbers, which bounds its file and the task that writes it.

    The rows are computed once into a staging table, which is removed when the files are written.
    """
    spark = rows.sparkSession
    held = f"{path}-staged"
    rows.write.parquet(held)
    rows = spark.read.schema(rows.schema).parquet(held)
    low, high = rows.agg(F.min(seq), F.max(seq)).first()
    if low is None:
        low, high = 0, 0
    slices = max(slices, -(-(high - low + 1) // SLICE_ROWS))
    step = (high - low) // slices + 1
    number = F.floor((F.col(seq) - low) / step).cast("int")
    rows.repartitionById(slices, number).write.mode("append").parquet(path)
    drop_path(spark, held)
    _arrive_in_turn(spark, path)


def _arrive_in_turn(spark: SparkSession, path: str) -> None:
    """Modification times one second apart, in order of the files' names, the last one now; only names pass the driver."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda f: f.getName())
    now = int(time.time()) * 1000
    for back, file in enumerate(reversed(files)):
        store.setTimes(file, now - 1000 * back, -1)
    times = [store.getFileStatus(file).getModificationTime() for file in files]
    if any(a >= b for a, b in zip(times, times[1:], strict=False)):
        raise ValueError(f"the store of {path} does not keep modification times, so files cannot be put in order")


def open_feed(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_to_end(stream: DataFrame, name: str, updates: bool = False) -> DataFrame:
    """Process everything available into a file sink and return what was written.

    The file sink commits each batch exactly once, so a restart after a lost executor neither
    repeats nor loses rows. ``updates`` is for streams that send changed rows again: each batch has a
    folder of its own, which a repeated batch replaces.
    """
    spark = stream.sparkSession
    out = fresh_path(spark, f"{name}-out")
    if updates:
        running = (
            stream.writeStream.outputMode("update")
            .foreachBatch(lambda rows, batch: rows.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
            .option("checkpointLocation", fresh_path(spark, f"{name}-state"))
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out).select(stream.columns)
    running = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", fresh_path(spark, f"{name}-state"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def split_late(stream: DataFrame, moment: str, delay: str, path: str) -> None:
    """Divide a stream into ``{path}/on-time`` and ``{path}/late`` as it arrives; every row goes to one of them.

    A row is late if its ``moment`` lies more than ``delay`` before the latest one of all earlier batches, the
    rule by which a watermark of that delay would let it go. Both sides have a folder for each batch. A batch
    is written aside and moved when it is whole, so one that is repeated neither adds nor loses rows. The
    progress is kept below ``path`` too: called again, it goes on with what is new.
    """
    spark = stream.sparkSession

    def take(rows: DataFrame, batch: int) -> None:
        earlier = [_latest(spark, f"{path}/marks/batch={batch - 1}")] if batch else [None]
        behind = F.lit(earlier[0]).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.coalesce(F.col(moment) < behind, F.lit(False))
        aside = fresh_path(spark, "split")
        rows.withColumn("_late", late).write.partitionBy("_late").parquet(aside)
        written = spark.read.schema(stream.schema).parquet(aside)
        known = F.greatest(F.max(moment), F.lit(earlier[0]).cast("timestamp"))
        written.agg(known.alias("latest")).write.mode("overwrite").parquet(f"{path}/marks/batch={batch}")
        for side, name in (("false", "on-time"), ("true", "late")):
            _move(spark, f"{aside}/_late={side}", f"{path}/{name}/batch={batch}")
        drop_path(spark, aside)

    running = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    running.awaitTermination()


def _latest(spark: SparkSession, path: str):
    return spark.read.schema("latest timestamp").parquet(path).first()[0]


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished folder in place of what an earlier try has left there; nothing happens if there is no such folder."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = make(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.delete(make(target), True)
    if store.exists(make(source)):
        store.mkdirs(make(target).getParent())
        store.rename(make(source), make(target))


def read_side(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows that one side of ``split_late`` has so far; none if it never got any."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(make(path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
