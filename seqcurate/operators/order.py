"""Places and running sums in an order, without a window over all rows."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset a new one on this machine, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def kept(df: DataFrame) -> DataFrame:
    """The same rows, computed once and written to the shared folder, so that partitions stay what they are when executors are lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def with_totals(df: DataFrame, totals: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """df with aggregates over all its rows, or over those of equal `by` (nulls are equal), joined to each row: what a window without an order gives, in no one task."""
    by = list(by)
    sums = df.groupBy(*(F.col(c).alias(f"_by_{c}") for c in by)).agg(*(v.alias(k) for k, v in totals.items()))
    if not by:
        return df.crossJoin(F.broadcast(sums))
    test = F.lit(True)
    for c in by:
        test &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return df.join(sums, test).drop(*(f"_by_{c}" for c in by))


def running(df: DataFrame, order: Sequence[Column], values: Mapping[str, Column], by: Sequence[str] = (), largest: bool = False, before: bool = False, rest: Mapping[str, Column] = {}) -> DataFrame:  # noqa: B006
    """df with a column for each of `values`: its sum (or, with `largest`, its maximum) over the rows up to this one (with `before`, only those before it, null if there are none)
    in the order, within the columns `by`; and for each of `rest`: its sum over this row and those after it.

    Rows are sorted over range partitions; each partition has windows of its own, and what all partitions before (or after) it hold is joined by
    broadcast, a row for each partition (and value of `by` in it). The order should end with a unique key."""
    by, names, ends = list(by), list(values), list(rest)
    total = F.max if largest else F.sum
    add = (lambda a, b: F.greatest(a, b)) if largest else (lambda a, b: F.coalesce(a + b, a, b))
    parts = kept(df.withColumns({f"_{n}": v for n, v in [*values.items(), *rest.items()]}).repartitionByRange(*(F.col(c) for c in by), *order).withColumn("_part", F.spark_partition_id()))
    sums = parts.groupBy(*by, "_part").agg(*(total(f"_{n}").alias(f"_{n}") for n in names), *(F.sum(f"_{n}").alias(f"_{n}") for n in ends))
    every = Window.partitionBy(*(by or [F.lit(0)]))
    earlier, later = (every.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("_part"), F.desc("_part")))
    outside = [*(total(f"_{n}").over(earlier).alias(f"_before_{n}") for n in names), *(F.sum(f"_{n}").over(later).alias(f"_before_{n}") for n in ends)]
    past = sums.select(*(F.col(c).alias(f"_by_{c}") for c in by), F.col("_part").alias("_of"), *outside)
    own = Window.partitionBy(*by, "_part")
    here = own.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    inner = parts.withColumns({f"_{n}": total(f"_{n}").over(here) for n in names})
    if ends:
        inner = inner.withColumn("_nth", F.row_number().over(own.orderBy(*order)))
        onward = own.orderBy(F.desc("_nth")).rowsBetween(Window.unboundedPreceding, 0)
        inner = inner.withColumns({f"_{n}": F.sum(f"_{n}").over(onward) for n in ends})
    test = F.col("_part") == F.col("_of")
    for c in by:
        test &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    found = [*(add(F.col(f"_before_{n}"), F.col(f"_{n}")).alias(n) for n in names), *((F.col(f"_{n}") + F.coalesce(f"_before_{n}", F.lit(0))).alias(n) for n in ends)]
    return inner.join(F.broadcast(past), test).select(*df.columns, *found)


def placed(df: DataFrame, order: Sequence[Column], name: str, by: Sequence[str] = (), most: int | None = None) -> DataFrame:
    """df with each row's place in the order, from 1; with `most` only the first so many of each group."""
    out = running(df, order, {name: F.lit(1).cast("long")}, by)
    return out if most is None else out.where(F.col(name) <= most)
