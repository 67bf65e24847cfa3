"""Gaps-and-islands inside groups, without a window over a whole group.

A run is a maximal stretch of consecutive rows (in time order) of one group
with equal ``same``. The usual ``lag`` over ``Window.partitionBy(day)`` would
put a whole day into one task. Here time is cut into buckets by literal bounds
(quantiles of the time, found once), the previous row is looked up inside
(group, bucket), and a small table with one row per (group, bucket) carries
the last value and the number of runs across buckets. The rows are shuffled
once; the bounds are constants, so nothing has to be frozen by a checkpoint.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_qs_bucket"


def seconds(date: Column) -> Column:
    """Whole seconds of a TIMESTAMP_NTZ on the calendar (monotone in it, no time zone)."""
    second = F.floor(F.date_part(F.lit("SECOND"), date)).cast("bigint")
    return F.unix_date(date.cast("date")).cast("bigint") * 86400 + F.hour(date) * 3600 + F.minute(date) * 60 + second


def with_time_bucket(df: DataFrame, date: str, buckets: int) -> DataFrame:
    """Adds ``BUCKET``: the time range of each row, about equally many rows each."""
    timed = df.withColumn("_qs_t", seconds(F.col(date)).cast("double"))
    bounds = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        bounds = timed.agg(F.percentile_approx("_qs_t", shares, max(10_000, 20 * buckets)).alias("q")).first()["q"] or []
    if not bounds:                                   # no rows, or one range asked for
        return timed.withColumn(BUCKET, F.lit(0)).drop("_qs_t")
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_qs_t", outputCol=BUCKET, handleInvalid="keep")
    return cut.transform(timed).withColumn(BUCKET, F.col(BUCKET).cast("int")).drop("_qs_t")


def assign_runs(df: DataFrame, group: list[str], date: str, tie: str, same: str, buckets: int) -> DataFrame:
    """Add ``run_idx``: the 0-based number of each row's run in its group, in
    (``date``, ``tie``) order, which must be total inside a group."""
    where = [*group, BUCKET]
    cut = with_time_bucket(df, date, buckets)
    w = Window.partitionBy(*where).orderBy(date, tie)
    changed = F.when(F.row_number().over(w) == 1, 0).otherwise((~F.lag(same).over(w).eqNullSafe(F.col(same))).cast("int"))
    local = (cut.withColumn("_qs_changed", changed)
             .withColumn("_qs_run", F.sum("_qs_changed").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    place = F.struct(date, tie)
    edges = local.groupBy(*where).agg(F.min_by(same, place).alias("_qs_first"), F.max_by(same, place).alias("_qs_last"),
                                      F.max("_qs_run").alias("_qs_more"))
    # One row per bucket of a group.
    along = Window.partitionBy(*group).orderBy(BUCKET)
    goes_on = F.when(F.row_number().over(along) == 1, 0).otherwise(F.lag("_qs_last").over(along).eqNullSafe(F.col("_qs_first")).cast("int"))
    edges = edges.withColumn("_qs_goes_on", goes_on)
    started = F.coalesce(F.sum(F.col("_qs_more") + 1 - F.col("_qs_goes_on")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = edges.select(*[F.col(c).alias(f"_qs_g{i}") for i, c in enumerate(where)], (started - F.col("_qs_goes_on")).alias("_qs_offset"))
    on = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_qs_g{i}")) for i, c in enumerate(where)])
    out = local.join(offsets, on)
    return out.withColumn("run_idx", (F.col("_qs_offset") + F.col("_qs_run")).cast("bigint")).select(*df.columns, "run_idx")
