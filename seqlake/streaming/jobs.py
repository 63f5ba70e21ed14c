"""Job events as a stream."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.scalars import percent

# States in which a job has ended (succeeded, failed, killed).
ENDED = (2, 3, 5)
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = "username string, running_state int, map_progress double, event_id long, micros long"


def read_events(spark: SparkSession, path: str, files_a_batch: int | None = None) -> DataFrame:
    """Events as a stream of Parquet files; ts becomes a TIMESTAMP, which watermarks need."""
    schema = "event_id BIGINT, job_id STRING, username STRING, running_state INT, map_progress DOUBLE, ts TIMESTAMP_NTZ"
    reader = spark.readStream.schema(schema)
    if files_a_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def job_status_stream(events: DataFrame, lateness: str = "60 days") -> DataFrame:
    """Latest state of each job, as :func:`latest_job_status` gives it.

    The watermark bounds the memory of event ids, by which replayed events are
    dropped; it must be wider than the disorder of the events. One state a job
    is kept for as long as the query runs.
    """
    once = events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])
    last = F.max_by(F.struct("username", "running_state", "map_progress", "event_id"), F.struct("ts", "event_id")).alias("e")
    return once.groupBy("job_id").agg(last).select(
        "job_id", "e.username", "e.running_state", percent(F.col("e.map_progress")).alias("progress"), (F.col("e.running_state") == 2).alias("complete"), "e.event_id"
    )


class LastEvent(StatefulProcessor):
    """The last event of a job by (ts, event_id); the state of an ended job goes when its time is over."""

    def __init__(self, keep_days: float):
        self.keep = int(keep_days * 86_400_000)  # milliseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", EVENT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get() if self.last.exists() else None
        last = tuple(last) if last is not None else None
        before = last
        for r in rows:
            event = (r["username"], r["running_state"], r["map_progress"], r["event_id"], r["micros"])
            if last is None or (event[4], event[3]) > (last[4], last[3]):
                last = event
        if last == before:  # repeated or older events only
            return
        self.last.update(last)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if last[1] in ENDED:
            self.handle.registerTimer(last[4] // 1000 + self.keep)
        yield Row(job_id=key[0], username=last[0], running_state=last[1], map_progress=last[2], event_id=last[3], micros=last[4])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def ending_status_stream(events: DataFrame, lateness: str = "60 days", keep_days: float = 1.0) -> DataFrame:
    """:func:`job_status_stream` whose state ends: a row (with ts) whenever a job's last event changes.

    The state of an ended job is dropped once the watermark is ``keep_days``
    beyond its last event. Whatever of the job comes later is newer than that
    event, since older events are behind the watermark and dropped, so
    :func:`read_status` stays right. Events without a job, ts or event_id are left out.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    whole = events.where("job_id is not null and ts is not null and event_id is not null").withColumn("map_progress", F.coalesce("map_progress", F.lit(0.0)))
    rows = whole.withWatermark("ts", lateness).select("job_id", "username", "running_state", "map_progress", "event_id", "ts", F.unix_micros("ts").alias("micros"))
    last = rows.groupBy("job_id").transformWithState(LastEvent(keep_days), f"job_id string, {EVENT}", "Update", "EventTime")
    return last.select("job_id", "username", "running_state", percent(F.col("map_progress")).alias("progress"), (F.col("running_state") == 2).alias("complete"), "event_id", F.timestamp_micros("micros").alias("ts"))


def compact(spark: SparkSession, path: str) -> None:
    """Put the batches below ``path`` together into one, with a negative number; those that it replaces are removed.

    Run it while no batch is written. If it is cut short, or a batch is run again, rows are there twice, which readers do not mind.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("batch=")]
    numbers = [int(p.getName().split("=")[1]) for p in old]
    if len(old) < 2:
        return
    _last(spark.read.parquet(path)).write.parquet(f"{path}/batch={min(0, *numbers) - 1}")
    for p in old:
        fs.delete(p, True)


def run_to_table(status: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there; each batch adds the jobs that changed, in a folder of its own.

    A batch that is run again replaces its own folder and no other, so readers
    never meet a table that is half replaced.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return status.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()


def _last(rows: DataFrame) -> DataFrame:
    """The row of each job with the last event, or of the last batch where rows have no ts."""
    columns = [c for c in rows.columns if c not in ("job_id", "batch")]
    order = F.struct("ts", "event_id") if "ts" in columns else F.col("batch")
    return rows.groupBy("job_id").agg(F.max_by(F.struct(*columns), order).alias("s")).select("job_id", "s.*")


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of each job over all batches."""
    return _last(spark.read.parquet(path)).drop("ts")
