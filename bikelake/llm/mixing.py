"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Documents of a source form blocks of ``block_docs``.  Sources get integer weights that sum to
``period`` slots.  In a period a source with quota q of L slots has its j-th block released
at slot floor(j * L / q) with the deadline ceil((j + 1) * L / q); the earliest deadline among
the released blocks is scheduled next.  That keeps every source less than one block from its
share at every slot, and each period ends with all shares exact.

A source with N blocks and weight c fills c slots in each of its floor(N / c) whole periods, the
rest in one more, and then is used up; the others go on, so the mix holds every document
once.  Quotas therefore change at most twice per source, and the slots of a period are worked
out once per distinct set of quotas: a table whose size depends on the sources and the period,
not on the documents.

Where a source's target lies below one slot, the period grows until the smallest target is a
slot, so that no source is paid for with the share of the others.  The period's slots are then
worked out once, with every source's full quota; the slots of blocks that a source no longer has are
left out, and the blocks that remain are numbered in that order by a range sort.  The others thus
keep their shares of each other also while sources run out within a long period.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bikelake.llm.common import written

BLOCK_DOCS = 4
PERIOD = 100
SMOOTHING = 0.7  # without given weights, a source's share is its number of documents to this power


def _targets(sizes: DataFrame, given: dict[str, float] | None, spark: SparkSession, smoothing: float) -> DataFrame:
    """``(sk, n_docs, w, total)``: target weights, 0 for sources without one, and their sum."""
    if given is None:
        w = sizes.withColumn("w", F.pow(F.col("n_docs").cast("double"), F.lit(smoothing)))
    else:
        rows = spark.createDataFrame([(k, float(v)) for k, v in given.items()], "source string, w double")
        w = sizes.join(rows.select(_source_key("source").alias("sk"), "w"), "sk", "left").select(
            "sk", "n_docs", F.coalesce(F.when(F.col("w") > 0, F.col("w")), F.lit(0.0)).alias("w"))
    # One row per source: these windows run over the source table, not over documents.
    w = w.withColumn("total", F.sum("w").over(Window.partitionBy()))
    return w.withColumn("w", F.when(F.col("total") > 0, F.col("w")).otherwise(F.lit(1.0))).withColumn(
        "total", F.sum("w").over(Window.partitionBy()))


def _weights(targets: DataFrame, period: int, unweighted: int = 0) -> DataFrame:
    """``(sk, n_docs, c)``: integer weights by largest remainder; ``unweighted`` sources without
    a target get one slot each, and the others share what is left of the period."""
    every = Window.partitionBy()
    w = (targets.withColumn("exact", F.col("w") / F.col("total") * (period - unweighted))
         .withColumn("base", F.greatest(F.lit(1).cast("long"), F.floor("exact").cast("long")))
         .withColumn("rest", F.lit(period) - F.sum("base").over(every))
         .withColumn("n", F.row_number().over(every.orderBy(F.desc(F.col("exact") - F.floor("exact")), "sk"))))
    return w.select("sk", "n_docs", (F.col("base") + F.when(F.col("n") <= F.col("rest"), 1).otherwise(0)).alias("c"))


def _source_key(c: str):
    """Sources as a key without nulls; a null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit("n"))


#: One period by earliest deadline first.  q holds the quotas by source number; the state is how
#: many blocks of each source are scheduled and the source of each slot so far.  Every step copies
#: its state, so the period is cut into stretches of about its square root: the slots of a stretch
#: are gathered on their own, and only the counts go on into the next one.
EDF = """
flatten(aggregate(
  sequence(0L, len - 1, cast(ceil(sqrt(len)) AS bigint)),
  named_struct('done', transform(q, x -> 0L), 'stretches', cast(array() as array<array<int>>)),
  (all, from) -> element_at(transform(
    array(aggregate(
      sequence(from, least(from + cast(ceil(sqrt(len)) AS bigint), len) - 1),
      named_struct('done', all.done, 'slots', cast(array() as array<int>)),
      (s, t) -> element_at(transform(
        array(array_min(transform(q, (x, i) -> if(s.done[i] < x AND (s.done[i] * len) div x <= t,
          named_struct('deadline', ((s.done[i] + 1) * len + x - 1) div x, 'i', i), null)))),
        pick -> named_struct('done', transform(s.done, (d, i) -> if(i = pick.i, d + 1, d)),
                             'slots', concat(s.slots, array(pick.i)))), 1))),
    one -> named_struct('done', one.done, 'stretches', concat(all.stretches, array(one.slots)))), 1),
  all -> all.stretches))
"""


def schedule(spark: SparkSession, docs: DataFrame, *, weights: dict[str, float] | None = None,
             source_col: str = "source", id_col: str = "doc_id", block_docs: int = BLOCK_DOCS,
             period: int = PERIOD, smoothing: float = SMOOTHING) -> DataFrame:
    """``(doc_id, source, sk, block, slot, position)`` for every distinct (id, source): its
    block within the source, the block's slot in the mix, and its place in the mix,
    ``slot * block_docs`` plus the place in the block (a source's last block may be short).

    A source's documents are taken in order of the MD5 of the id (then the id).  A null source
    is a source of its own; sources without a given weight, or with none above 0, get one slot
    per period, which the others make room for; a null id is an id of its own; rows that repeat id and source share one place.
    An empty table gives no row.
    """
    d = (docs.select(F.col(id_col).alias("doc_id"), _source_key(source_col).alias("sk")).distinct()
         .withColumn("k", F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 16)))
    # Number the documents of each source without gathering a source in one task: a range sort
    # splits it over partitions, each is numbered on its own, and what lies before is added.
    d = written(spark, d.repartitionByRange("sk", "k", "doc_id").withColumn("part", F.spark_partition_id()), "mix-docs")
    parts = written(spark, d.groupBy("sk", "part").agg(F.count("*").alias("n")), "mix-parts")
    before = parts.select("sk", "part", (F.sum("n").over(Window.partitionBy("sk").orderBy("part"))
                                         - F.col("n")).alias("before"))
    sizes = parts.groupBy("sk").agg(F.sum("n").alias("n_docs"))
    targets = written(spark, _targets(sizes, weights, spark, smoothing), "mix-targets")
    least, unweighted = targets.agg(F.min(F.when(F.col("w") > 0, F.col("w") / F.col("total"))),
                                    F.count(F.when(F.col("w") == 0, 1))).first()
    grown = bool(unweighted) or least is not None and least * period < 1
    if grown:
        period *= math.ceil(1 / (least * period)) + unweighted
    plan = written(spark, _weights(targets, period, unweighted)
                   .withColumn("blocks", F.expr(f"(n_docs + {block_docs - 1}) div {block_docs}"))
                   .withColumn("full", F.expr("blocks div c"))
                   .withColumn("i", F.row_number().over(Window.partitionBy().orderBy("sk")) - 1), "mix-plan")

    numbered = (d.withColumn("r", F.row_number().over(Window.partitionBy("part", "sk").orderBy("k", "doc_id")) - 1)
                .join(before, ["part", "sk"]).withColumn("n", F.col("before") + F.col("r"))
                .withColumn("block", F.expr(f"n div {block_docs}")))
    if grown:
        placed = _placed_by_range(spark, numbered.filter(f"n % {block_docs} = 0").select("sk", "block"), plan, period)
        return _positions(numbered.join(placed, ["sk", "block"]), block_docs)

    # Quotas change only after a source's last whole period and after the one that follows.
    segments = (plan.agg(F.array_sort(F.collect_list(F.struct("i", "c", "full", "blocks"))).alias("every"))
                .withColumn("segment", F.explode(F.expr(
                    "array_distinct(flatten(transform(every, s -> array(0L, s.full, s.full + 1))))")))
                .withColumn("q", F.expr("transform(every, s -> CASE WHEN segment < s.full THEN s.c "
                                        "WHEN segment = s.full THEN s.blocks - s.full * s.c ELSE 0L END)"))
                .withColumn("len", F.expr("aggregate(q, 0L, (a, x) -> a + x)"))
                .filter("len > 0")
                .withColumn("start", F.expr("aggregate(every, 0L, (a, s) -> a + least(s.blocks, s.c * segment))"))
                .select("segment", "q", "len", "start").repartition("segment"))
    slots = (segments.select("segment", "len", "start", F.posexplode(F.expr(EDF)).alias("t", "i"))
             .withColumn("j", F.row_number().over(Window.partitionBy("segment", "i").orderBy("t")) - 1))
    slots = written(spark, slots, "mix-slots")
    changes = slots.groupBy("i").agg(F.array_sort(F.collect_set("segment")).alias("segments"))
    plan = written(spark, plan.join(changes, "i").select("sk", "i", "c", "segments"), "mix-sources")

    # Period of the block, the segment of equal quotas that holds it, its number in the period.
    return _positions(numbered.join(plan, "sk")
                      .withColumn("period", F.expr("block div c")).withColumn("j", F.expr("cast(block % c as int)"))
                      .withColumn("segment", F.expr("element_at(filter(segments, x -> x <= period), -1)"))
                      .join(slots, ["segment", "i", "j"])
                      .withColumn("slot", F.expr("start + (period - segment) * len + t")), block_docs)


def _positions(numbered: DataFrame, block_docs: int) -> DataFrame:
    return numbered.select("doc_id", F.when(F.col("sk") != "n", F.expr("substring(sk, 2)")).alias("source"), "sk", "block",
                           "slot", F.expr(f"slot * {block_docs} + n % {block_docs}").alias("position"))


def _placed_by_range(spark: SparkSession, blocks: DataFrame, plan: DataFrame, period: int) -> DataFrame:
    """``(sk, block, slot)``: blocks in the order of one period of full quotas, repeated."""
    slots = (plan.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "c"))), lambda s: s.c).alias("q"))
             .withColumn("len", F.lit(period).cast("long"))
             .select(F.posexplode(F.expr(EDF)).alias("t", "i"))
             .withColumn("j", F.row_number().over(Window.partitionBy("i").orderBy("t")) - 1))
    slots = written(spark, slots, "mix-slots")
    at = (blocks.join(plan.select("sk", "i", "c"), "sk").withColumn("j", F.expr("cast(block % c as int)"))
          .join(slots, ["i", "j"]).select("sk", "block", F.expr(f"(block div c) * {period}L + t").alias("at")))
    at = written(spark, at.repartitionByRange("at").withColumn("part", F.spark_partition_id()), "mix-at")
    # One row per partition.
    parts = at.groupBy("part").agg(F.count("*").alias("size")).withColumn(
        "first", F.sum("size").over(Window.orderBy("part")) - F.col("size"))
    return (at.withColumn("r", F.row_number().over(Window.partitionBy("part").orderBy("at")) - 1)
            .join(parts, "part").select("sk", "block", (F.col("first") + F.col("r")).alias("slot")))


def mix(spark: SparkSession, docs: DataFrame, *, source_col: str = "source", id_col: str = "doc_id",
        **how) -> DataFrame:
    """All rows and columns of ``docs``, in the order of the schedule over the partitions and
    within them (one shuffle by the place, which is even by construction)."""
    s = written(spark, schedule(spark, docs, source_col=source_col, id_col=id_col, **how)
                .select(F.col("doc_id").alias("__id"), F.col("sk").alias("__sk"), F.col("position").alias("__at")), "mix")
    last = s.agg(F.max("__at")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.join(s, F.col(id_col).eqNullSafe(F.col("__id")) & (_source_key(source_col) == F.col("__sk")))
    return (rows.repartitionById(parts, F.expr(f"cast(__at * {parts} div {last + 1} as int)"))
            .sortWithinPartitions("__at").select(*docs.columns))
