"""Global row index without a single-task window.

``row_number()`` over an un-partitioned window moves every row into one
task. Instead we range-partition on the order key, sort inside partitions,
freeze that layout with a reliable checkpoint (range bounds are sampled and
could differ between two evaluations), count rows per partition (one small
row per partition reaches the driver) and add the prefix offsets.

The same per-partition summaries give running sums / carried values across
partition boundaries, so gaps-and-islands runs and position joins scale with
the data instead of with the largest group.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, shared_path

PID = "_qs_pid"
LOCAL = "_qs_local"
_LOW33 = (1 << 33) - 1


def _width(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder, computing ``df`` once: persisted for
    the counting job so the checkpoint write reads those blocks instead of
    recomputing the lineage; later stages read the checkpoint files."""
    checkpoint_dir(df.sparkSession)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    frozen = kept.checkpoint(eager=True)
    kept.unpersist()
    return frozen


def frozen_range_layout(df: DataFrame, order: list, num_partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted on ``order``, tagged with partition id
    and position inside the partition, checkpointed to the shared folder.

    The input is persisted while the layout is built: range partitioning
    samples it in a job of its own before shuffling it, and a derived input
    (e.g. split documents) would otherwise be computed twice. Both
    checkpoint jobs share one RDD, hence one set of range bounds."""
    checkpoint_dir(df.sparkSession)
    n = _width(df, num_partitions)
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    laid = (src.repartitionByRange(n, *order)
               .sortWithinPartitions(*order)
               .withColumn(PID, F.spark_partition_id())
               .withColumn(LOCAL, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))
    frozen = reliable_checkpoint(laid)
    src.unpersist()
    return frozen


def partition_offsets(laid: DataFrame, weight: Column | None = None) -> list[int]:
    """Exclusive prefix sums of per-partition row counts (or of ``weight``).

    Collects one row per partition: bounded by the partition count.
    """
    agg = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rows = laid.groupBy(PID).agg(agg.alias("n")).collect()
    sizes = {r[PID]: (r["n"] or 0) for r in rows}
    nparts = laid.rdd.getNumPartitions()
    offs, acc = [], 0
    for p in range(max(nparts, (max(sizes) + 1) if sizes else 0)):
        offs.append(acc)
        acc += sizes.get(p, 0)
    return offs


def offset_of(offsets: list[int], pid: Column | None = None) -> Column:
    """Look up the offset of a row's partition (literal array, one entry per
    partition)."""
    pid = F.col(PID) if pid is None else pid
    arr = F.array(*[F.lit(int(o)).cast("long") for o in offsets]) if offsets else F.array().cast("array<bigint>")
    return F.element_at(arr, pid + 1)


def with_global_index(df: DataFrame, order: list, name: str = "gidx",
                      num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based dense position in ``order`` (keys must make it total).

    The result keeps the internal partition id / local position columns so
    callers can run partition-local windows (``Window.partitionBy(PID)``)
    that never exceed one range partition.
    """
    laid = frozen_range_layout(df, order, num_partitions)
    offs = partition_offsets(laid)
    return laid.withColumn(name, offset_of(offs) + F.col(LOCAL))


def key_index(df: DataFrame, keys: list[str], name: str = "gidx") -> DataFrame:
    """``keys`` and their 0-based dense position: only the keys are laid out
    and written, whatever else ``df`` holds. ``keys`` must be unique."""
    return drop_internal(with_global_index(df.select(*keys), keys, name))


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh folder of the shared checkpoint folder
    and read from there."""
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


HASH_DIGITS = 4                # hex digits of a hash bucket: at most 65,536 buckets


def hash_order_index(keyed: DataFrame, key: str, ties: list[str], name: str) -> DataFrame:
    """Add the 0-based dense position in ``(key, *ties)`` order, ``key`` being
    a hex hash. Hash prefixes are even range buckets without sampling: their
    sizes give the offsets, rows are numbered inside their bucket. ``keyed``
    is read twice, so it should be a narrow stored table."""
    bucket = F.substring(key, 1, HASH_DIGITS).alias("_qs_bucket")
    # One row per bucket: the window over all of them is bounded.
    sizes = keyed.groupBy(bucket).agg(F.count(F.lit(1)).alias("_qs_n"))
    before = F.coalesce(F.sum("_qs_n").over(Window.orderBy("_qs_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_qs_bucket", before.alias("_qs_before"))
    own = Window.partitionBy("_qs_bucket").orderBy(key, *ties)
    numbered = keyed.withColumn("_qs_bucket", bucket).withColumn("_qs_local", F.row_number().over(own) - 1)
    out = numbered.join(F.broadcast(offsets), "_qs_bucket")
    return out.withColumn(name, (F.col("_qs_before") + F.col("_qs_local")).cast("bigint")).drop("_qs_bucket", "_qs_local", "_qs_before")


def local_window() -> Window:
    return Window.partitionBy(PID).orderBy(LOCAL)


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(PID, LOCAL)
