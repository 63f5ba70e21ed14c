"""User functions over genome bins and read batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .variants import in_load_bins, load_bins


def apply_per_bin(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, size: int = 1_000_000, pad: int = 0) -> DataFrame:
    """``fn`` on the rows (contig, pos, ...) of each genome bin, with those within ``pad`` of its edges.

    What ``fn`` returns has pos among its columns and is cut to the bin's own range.
    """
    low, high = (F.floor((F.col("pos") - 1 + d) / size).cast("bigint") for d in (-pad, pad))
    spread = df.withColumn("bin", F.explode(F.sequence(F.greatest(low, F.lit(0)), high)))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = fn(rows.drop(columns="bin"))
        return out[(out["pos"] - 1) // size == key[1]]

    return spread.groupBy("contig", "bin").applyInPandas(run, schema)


def apply_per_load(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, rows_per_bin: int, pad: int = 0) -> DataFrame:
    """:func:`apply_per_bin` over bins of about equal load (:func:`seqlake.operators.variants.load_bins`).

    So no task has much more than ``rows_per_bin`` rows and those within ``pad``
    of its edges, unless one position alone has. ``df`` is read twice; bins are a written table.
    """
    columns = df.columns
    spread = in_load_bins(df, written(load_bins(df, rows_per_bin), "bins"), pad)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = rows["_low"].iloc[0], rows["_high"].iloc[0]
        out = fn(rows[columns])
        return out[(out["pos"] >= low) & (out["pos"] <= high)]

    return spread.groupBy("contig", "_bin").applyInPandas(run, schema)


def apply_per_read_batch(reads: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` on batches of reads, without a shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return reads.mapInPandas(run, schema)
