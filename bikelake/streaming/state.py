"""Incremental current-state maintenance (ST5).

The batch Silver build recomputes the latest record per key over the whole
history every run.  The incremental form consumes only new files:
``foreachBatch`` reduces each micro-batch to its latest row per key (a window with a
partial group limit before its shuffle) and merges it into the bucketed target with the
ordering keys as guard, so

* a replayed batch (after a failure between write and commit) cannot make an
  older row win, and its batch id is skipped when already applied;
* only the buckets that hold the batch's keys are read and written;
* a NULL key is one key: it has one row, the latest.

``row_number`` is rejected on streaming DataFrames, which is why the ranking
runs inside ``foreachBatch`` on the static micro-batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from bikelake.operators.latest import latest_per_key
from bikelake.sinks.tables import BATCH_PROP, BUCKETS, table_props, upsert
from bikelake.streaming.ingest import run


def incremental_state(stream: DataFrame, table: str, root: str, keys: Sequence[str],
                      order_desc: Sequence[str], checkpoint: str,
                      prepare=None, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep ``table`` = latest row per ``keys`` of everything ``stream`` delivered.

    ``prepare`` (optional) is a DataFrame -> DataFrame transform applied to each
    micro-batch before the reduction (e.g. cleaning).
    """
    keys, order_desc = list(keys), list(order_desc)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = table_props(spark, table)
        if int(before.get(BATCH_PROP, -1)) >= batch_id:
            return  # already applied before a restart
        rows = prepare(batch) if prepare else batch
        upsert(table, latest_per_key(rows, keys, order_desc), keys, root, order_desc=order_desc,
               batch_id=batch_id, null_keys="match", source_unique=True, buckets=buckets, before=before)

    q = (stream.writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return run(q)
