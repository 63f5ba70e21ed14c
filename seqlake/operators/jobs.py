"""Jobs, genomes, inputs and ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import percent, to_display_id
from ..sources.scratch import written

SUFFIX = "_samtools.tar.gz"


def list_genomes(files: DataFrame, kb: bool = False, every: bool = False) -> DataFrame:
    """(genome): names of files with the suffix; kb_ ones only with kb, hidden without kb and every."""
    names = files.where(F.col("name").contains(SUFFIX)).select(F.substring_index("name", SUFFIX, 1).alias("g"))
    if kb:
        names = names.where(F.col("g").startswith("kb_"))
    elif not every:
        names = names.where(~F.col("g").startswith("kb_"))
    return names.select(to_display_id(F.col("g")).alias("genome"))


def latest_job_status(events: DataFrame) -> DataFrame:
    """(job_id, username, running_state, progress, complete, event_id): the last event of each job."""
    last = F.max_by(F.struct("username", "running_state", "map_progress", "event_id"), F.struct("ts", "event_id")).alias("e")
    return events.groupBy("job_id").agg(last).select(
        "job_id", "e.username", "e.running_state", percent(F.col("e.map_progress")).alias("progress"), (F.col("e.running_state") == 2).alias("complete"), "e.event_id"
    )


def list_jobs(events: DataFrame, username: str) -> DataFrame:
    """Latest status of the jobs of one user."""
    return latest_job_status(events.where(F.col("username") == username))


def validate_inputs(requested: DataFrame, inventory: DataFrame, genomes: DataFrame) -> DataFrame:
    """(name, problem): requested names that no file has, and genomes (column genome) that are not supported."""
    missing = requested.select("name").join(inventory.select("name"), "name", "left_anti").select("name", F.lit("missing").alias("problem"))
    if "genome" not in requested.columns:
        return missing
    unknown = requested.select("genome").distinct().join(genomes.select("genome"), "genome", "left_anti")
    return missing.unionByName(unknown.select(F.col("genome").alias("name"), F.lit("unsupported genome").alias("problem")))


def register_ids(keys: DataFrame, registry: DataFrame, prefix: str) -> DataFrame:
    """(key, id): known keys keep theirs, new ones get prefix.N in key order, N going on from the largest. One writer at a time.

    New keys are numbered without one task for all: by ranges, whose sizes are
    summed up. The numbered ranges are a written table, since both the sizes and
    the rows must come from the same ranges.
    """
    known = registry.join(keys.select("key").distinct(), "key", "left_semi").select("key", "id")
    new = keys.select("key").where("key is not null").distinct().join(registry.select("key"), "key", "left_anti")
    new = new.repartitionByRange("key").sortWithinPartitions("key")
    top = registry.agg(F.coalesce(F.max(F.substring_index("id", ".", -1).cast("bigint")), F.lit(0)).alias("top"))
    part = F.spark_partition_id()
    numbered = new.withColumn("p", part).withColumn("i", F.row_number().over(Window.partitionBy("p").orderBy("key")))
    numbered = written(numbered, "numbered")
    sizes = numbered.groupBy("p").agg(F.max("i").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("p", before.alias("before"))  # a row for each partition
    fresh = numbered.join(F.broadcast(offsets), "p").join(F.broadcast(top))
    return known.unionByName(fresh.select("key", F.concat(F.lit(prefix + "."), (F.col("top") + F.col("before") + F.col("i")).cast("string")).alias("id")))
