"""Best-fit packing of tokenised documents into sequences, improved by local search.

A document longer than a sequence is cut into whole sequences and one shorter first piece;
whole sequences stand alone.  The other pieces are dealt by a hash into groups of about
``GROUP_PIECES`` and each group is packed in its own task: best fit in descending length
first, then swaps between underfull bins.  A swap (one piece for one, two for one, or a move)
is taken when it raises the sum of squared fills, so full bins get fuller and small ones run
empty and vanish.  A group leaves at most a few underfull sequences, so with a group size
that does not depend on the input their share stays the same at every scale.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bikelake.llm.common import batch_of, written
from bikelake.llm.tokens import default_vocabulary, encoder

SEQUENCE_TOKENS = 1024
GROUP_PIECES = 4096


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit in descending length: each piece to the fullest bin that still holds it."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0  # bit g is set while some bin has a gap of g
    bins: list[list[int]] = []
    for i in order:
        n = lengths[i]
        fitting = gaps >> n
        if fitting:
            gap = n + (fitting & -fitting).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
        else:
            gap, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if gap > n:
            by_gap[gap - n].append(b)
            gaps |= 1 << (gap - n)
    return bins


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Swaps between underfull bins until none raises the sum of squared fills.

    For a bin with gap g, a donor with less fill than the bin may give a piece (move), trade
    a longer piece for one of the bin's, or trade one longer piece for two of the bin's.  Any
    of these shifts weight from a less full to a fuller bin, so the sum of squares rises by
    every step and the search ends.  The longest shift that fits is taken each time.
    """
    full = [b for b in bins if sum(lengths[i] for i in b) == capacity]
    work = [list(b) for b in bins if sum(lengths[i] for i in b) < capacity]
    fill = [sum(lengths[i] for i in b) for b in work]
    changed = True
    while changed:
        changed = False
        order = sorted((k for k in range(len(work)) if work[k]), key=lambda k: -fill[k])
        # pieces by length over the donors, i.e. the bins after the current one
        has: list[dict[int, int]] = [{} for _ in range(capacity + 1)]
        mask = 0
        for k in order:
            for i in work[k]:
                has[lengths[i]][i] = k
                mask |= 1 << lengths[i]

        def take(i, k):
            nonlocal mask
            n = lengths[i]
            has[n].pop(i, None)
            if not has[n]:
                mask &= ~(1 << n)

        def give(i, k):
            nonlocal mask
            has[lengths[i]][i] = k
            mask |= 1 << lengths[i]

        for k in order:
            for i in work[k]:
                take(i, k)  # the bin itself, and fuller ones before it, are no donors
            while fill[k] < capacity and mask:
                gap = capacity - fill[k]
                mine: dict[int, list[int]] = {}
                for i in work[k]:
                    mine.setdefault(lengths[i], []).append(i)
                # pieces of one length are alike, so pairs are indexed by their lengths: a bin has
                # few different ones (44 at most in 1024 tokens), however many pieces it holds
                outs = {0: ()}
                kinds = sorted(mine.items())
                for x, (n, some) in enumerate(kinds):
                    if len(some) > 1:
                        outs.setdefault(2 * n, (some[0], some[1]))
                    for m, others in kinds[x + 1:]:
                        outs.setdefault(n + m, (some[0], others[0]))
                for n, some in kinds:
                    outs[n] = (some[0],)
                best = None
                for n, out in outs.items():
                    if n >= capacity:
                        continue
                    window = (mask >> (n + 1)) & ((1 << gap) - 1)  # lengths n+1 .. n+gap
                    if window:
                        shift = window.bit_length()
                        donor_piece, donor = next(iter(has[n + shift].items()))
                        # sum of squares rises: the receiver gains what a less full bin loses
                        if fill[k] + shift > fill[donor] and (best is None or shift > best[0]):
                            best = (shift, out, donor_piece, donor)
                            if shift == gap:
                                break
                if best is None:
                    break
                shift, out, piece, donor = best
                take(piece, donor)
                work[donor].remove(piece)
                work[k].append(piece)
                for i in out:
                    work[k].remove(i)
                    work[donor].append(i)
                    give(i, donor)
                fill[k] += shift
                fill[donor] -= shift
                changed = True
    return full + [b for b in work if b]


def pack_lengths(lengths: list[int], capacity: int = SEQUENCE_TOKENS) -> list[list[int]]:
    """Bins (lists of positions in ``lengths``) that together hold every piece once."""
    return improve(best_fit(lengths, capacity), lengths, capacity)


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
           capacity: int = SEQUENCE_TOKENS, vocabulary: str | None = None, row=None) -> DataFrame:
    """Cut the ids of every whole text (null: empty) plus ``end_id`` into pieces:
    ``(doc_id, row, piece, start, length, ids_crc32)``; ``row`` tells apart rows that repeat a
    doc_id.  No shuffle: the texts are encoded where they are read."""
    vocabulary = vocabulary or default_vocabulary()
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()),
                        ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            out = ([], [], [], [], [], [])
            for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.append(enc.encode(text.as_py() or ""), enc.dtype.type(end_id)).astype("<u4")
                start = 0
                for k in range(-(-len(ids) // capacity)):
                    end = (len(ids) - 1) % capacity + 1 if k == 0 else start + capacity
                    crc = zlib.crc32(ids[start:end].tobytes())
                    for c, v in zip(out, (doc, row, k, start, end - start, crc)):
                        c.append(v)
                    start = end
            yield batch_of(schema, out)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.monotonically_increasing_id() if row is None else row).alias("row"),
                       F.col(text_col).alias("text")).mapInArrow(
        cut, "doc_id long, row long, piece int, start long, length long, ids_crc32 long")


def _written_rows(docs: DataFrame, group_rows: int) -> DataFrame:
    """``docs`` with ``__row``: the place of a row in the order in which the files of ``docs`` were
    written (by file name, then row of the file), as group number << 12 | place in its group of
    ``group_rows`` (4096 at most) rows of one file.  A scan itself reads files by size."""
    place = docs.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    files = place.groupBy("__file").agg(F.expr(f"max(__at) div {group_rows} + 1").alias("n"))
    # one row per file
    files = files.select("__file", (F.sum("n").over(Window.orderBy("__file")) - F.col("n")).alias("__first"))
    row = F.expr(f"shiftleft(__first + __at div {group_rows}, 12) | (__at % {group_rows})")
    return place.join(files, "__file").withColumn("__row", row)


def pack(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         end_id: int = 2, capacity: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES,
         vocabulary: str | None = None, in_order: bool = False) -> DataFrame:
    """Pack every document: ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``.

    A null text is empty and gives the end id alone; repeated rows are packed one by one; a
    null doc_id stays null; an empty table gives no row.  The texts are encoded once and only
    the pieces' lengths are shuffled.  With ``in_order`` the groups
    are runs of rows in the order in which the files were written: a sequence holds documents
    that stand near each other, and sequence ids ascend with the groups.
    """
    if in_order:
        try:
            docs.select("_metadata.file_name")
        except AnalysisException:             # rows that lie in no files yet get their order by lying in some
            docs = written(spark, docs.select(id_col, text_col), "in-order")
        docs = _written_rows(docs.select(id_col, text_col), min(group_pieces, 4096))
    cut = written(spark, pieces(docs, id_col=id_col, text_col=text_col, end_id=end_id, capacity=capacity,
                                vocabulary=vocabulary, row=F.col("__row") if in_order else None), "pieces")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    short = cut.filter(F.col("length") < capacity)
    groups = 1 if in_order else max(1, -(-short.count() // group_pieces))
    # Whole sequences get even ids, packed ones odd ids from the group; in order, both ascend
    # with the group: its number, then 32 bits for the row and piece or the bin, then the kind.
    alone = F.monotonically_increasing_id() if not in_order else F.shiftleft("row", 20) + F.col("piece")
    bits = 32 if in_order else 24
    whole = cut.filter(F.col("length") >= capacity).select(
        *cols, (alone * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

    def place(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("row", "ascending"), ("piece", "ascending")])
        lengths = rows.column("length").to_pylist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for b, members in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i] = ((key[0].as_py() << bits) + b) * 2 + 1, at
                at += lengths[i]
        return rows.select(cols).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    if in_order:
        group = F.shiftright("row", 12)
    else:
        group = F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).cast("long")
    packed = (short.withColumn("g", group)
              .groupBy("g").applyInArrow(place, out))
    return whole.union(packed)
