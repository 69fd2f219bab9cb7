"""Join helpers: lookups, current-state join, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a fact side to a dimension; Catalyst and AQE choose broadcast or shuffle by bytes."""
    return fact.join(dim, on, how)


def assert_unique(df: DataFrame, keys: list[str], what: str = "key") -> None:
    """Raise if a non-NULL key occurs more than once (a lookup would fan out)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    dup = df.filter(cond).groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"duplicate {what} {[dup[0][k] for k in keys]}")


def current_state(info: DataFrame, status: DataFrame, key: str = "station_id") -> DataFrame:
    """Latest information LEFT JOIN latest status on the key.

    Keys only present in ``status`` are dropped; keys without status keep NULL
    measures.  Both inputs are already one row per key, so the join shuffles on
    the key that the latest-per-key aggregates were partitioned by.
    """
    return info.join(status, key, "left")


def join_coverage(left: DataFrame, right: DataFrame, key: str | list[str],
                  probe_col: str) -> DataFrame:
    """Coverage of a left join (J5): rows on each side, joined rows, rows whose
    ``probe_col`` (a right-side column) is NULL after the join.

    The join rows are counted without materialising the join: per-key counts of
    both sides are aggregated first (partial aggregation), so a hot key costs one
    row per task, then joined and multiplied.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lcount = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l"))
    rcount = right.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_r"),
        F.count_if(F.col(probe_col).isNull()).alias("_rnull"))
    # Full outer join of the per-key counts: one row per key, whichever side has it.
    j = lcount.join(rcount, keys, "full")
    has_l = F.col("_l").isNotNull()
    no_r = F.col("_r").isNull()
    # per key: joined rows = l * max(r, 1); unmatched probe = l if no match, else l * rnull
    joined = F.when(has_l, F.col("_l") * F.coalesce(F.col("_r"), F.lit(1)))
    probe_null = F.when(has_l & no_r, F.col("_l")).when(has_l, F.col("_l") * F.col("_rnull"))
    unmatched = F.when(has_l & no_r, F.col("_l"))
    stats = j.agg(
        F.sum("_l").alias("left_rows"),
        F.sum("_r").alias("right_rows"),
        F.sum(joined).alias("joined_rows"),
        F.sum(probe_null).alias("missing_after_join"),
        F.sum(unmatched).alias("unmatched_left_rows"),
    )
    return stats.select(*[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in
                          ["left_rows", "right_rows", "joined_rows", "missing_after_join",
                           "unmatched_left_rows"]])
