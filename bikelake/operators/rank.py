"""Global ranking (W3) without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into one
task.  The distributed form:

1. ``orderBy`` range-partitions on the ordering keys (sampled bounds) and sorts
   within each partition — every partition is a contiguous slice of the order;
2. ``monotonically_increasing_id`` records (partition index, position) and the
   result is ``checkpoint()``-ed to the shared checkpoint folder, so positions
   cannot change between counting and ranking and lost executors recompute
   from the checkpoint, not from a re-sampled sort;
3. per-partition row counts (one row per partition: the bound on what is
   broadcast) are turned into offsets with a running sum;
4. rank = offset of the partition + position + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikelake.session import ensure_checkpoint_dir

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def range_sorted(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``.

    A unique last sort key lets the range partitioner split a hot value (a third
    of all rows with equal keys) over several partitions; it only orders rows
    that tie on every requested key, whose relative order row_number leaves open.
    """
    tie = F.monotonically_increasing_id().alias("_tie")
    return df.select("*", tie).orderBy(*order, F.col("_tie")).drop("_tie")


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank",
                distributed: bool = True) -> DataFrame:
    """Append ``name`` = 1..n following ``order`` (a total order gives a unique rank)."""
    order = list(order)
    if not distributed:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    ensure_checkpoint_dir(df.sparkSession)
    tagged = range_sorted(df, order).withColumn("_rid", F.monotonically_increasing_id())
    tagged = tagged.checkpoint(eager=True)
    part = F.shiftright(F.col("_rid"), _POS_BITS)
    counts = tagged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ranked = tagged.join(F.broadcast(offsets), part == F.col("_p"))
    rank = F.col("_off") + F.col("_rid").bitwiseAND(F.lit(_POS_MASK)) + F.lit(1)
    return ranked.select(*[F.col(c) for c in df.columns], rank.cast("long").alias(name))
