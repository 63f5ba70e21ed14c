"""What the corpus operators share: shared work folders, lineage cuts, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import removed, store

#: Rows of a table whose doc_id gives a crc32 remainder of 0 are held out of every fit.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    Where the session names none, a temporary folder of this machine is set for
    the session if all of Spark runs on it; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="seqlake-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    store(df, path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Cuts whose folders can be removed together, once nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame, label: str = "cut") -> DataFrame:
        path = shared_dir(self.spark, label)
        self.paths.append(path)
        store(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            removed(self.spark, path)
        self.paths.clear()


HOT_DEGREE = 100_000  # neighbours of a node, beyond which its edges are dealt to several tasks
HOT_NODES = 1000  # at most so many are: a node counts as hot only with a thousandth of all edges, too
SALTS = 64


def _with_lowest(both: DataFrame, n: int) -> DataFrame:
    """(a, b, m) of the edges upwards: m is the least of a and its neighbours. No hub's edges meet in one task."""
    low = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree")).select("a", F.least("a", "m").alias("m"), "degree")
    up = both.where("b > a")
    hot = low.where(F.col("degree") > max(HOT_DEGREE, n // HOT_NODES)).select("a").limit(2 * HOT_NODES + 1)  # 2n ends of edges: the limit cuts nothing
    if n <= HOT_DEGREE or hot.isEmpty():
        return up.join(low.drop("degree"), "a")
    hot = F.broadcast(hot.withColumn("hot", F.lit(True)))
    up = up.join(hot, "a", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("b"), F.lit(SALTS))).otherwise(F.lit(0)))
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<long>")
    low = low.join(hot, "a", "left").select("a", "m", F.explode(salts).alias("salt"))
    return up.drop("hot").join(low, ["a", "salt"]).drop("salt")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(a, b)`` as ``(node, root)``.

    ``root`` is the smallest node of the component. Alternating large-star and
    small-star contraction: each round is two aggregations over edges and joins
    that deal a hub's edges to many tasks, so no component is ever gathered in
    one, and the number of rounds grows with the logarithm of the diameter. Every
    round is cut to the shared folder. Self-loops and nulls are dropped; a node
    without an edge does not appear.
    """
    scratch = Scratch(edges.sparkSession)
    pairs = scratch.cut(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen, n = None, pairs.count()
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above a node go to its smallest neighbour
        large = _with_lowest(both, n).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its lower neighbours go to the lowest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(low.select("a", F.col("m").alias("b")))
        ).distinct()
        before, scratch = scratch, Scratch(edges.sparkSession)
        pairs = scratch.cut(small, "edges")
        before.clear()
        state = pairs.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        ).first()
        if seen == state:
            break
        seen, n = state, state["n"]
    else:
        raise RuntimeError("components did not converge")
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots)


def join_small(left: DataFrame, right: DataFrame, on, how: str, rows: int, limit: int = 200_000) -> DataFrame:
    """Join with a broadcast only where ``right`` is known to have at most ``limit`` rows."""
    return left.join(F.broadcast(right) if rows <= limit else right, on, how)
