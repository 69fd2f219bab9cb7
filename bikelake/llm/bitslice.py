"""Exact top-k by inner product over a bit-sliced index.

Every attribute of a block of rows is quantised (its low bits are dropped) and stored as bit
slices: bitmap s of an attribute has bit r set when the quantised value of row r has bit s.
The approximate scores of all rows are added up from the slices by bitmap arithmetic: a
product with a query value is a sum of shifted slices, and carry-save adders turn three
slices of one weight into one of that weight and one of the next.  The result is the score in
bit slices.  A scan from the most significant slice downward selects the rows with the
largest approximate scores; the dropped bits bound how far a score can be off, and the rows
within that bound of the k-th are resolved by exact inner products.

Blocks of rows meet blocks of queries by a join on block numbers; every block keeps its top k
and the tops are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bikelake.llm.common import batch_of, written

ROW_BLOCK = 2048      # rows that are gathered into one record
INDEX_BLOCKS = 8      # records that share one index
QUERY_BLOCK = 512     # queries that visit an index block together
KEPT_BITS = 5         # bits of an attribute that are kept in slices
WIDE = 1 << 61        # integers from here on leave the index's 64 bits
MOST = (1 << 63) - 1
_FOUND = [("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64()), ("beyond", pa.string())]
_FOUND_DDL = "query_id long, id long, score long, beyond string"


class BitSlicedIndex:
    """Index of one block: ``values`` (rows x attributes, 64-bit integers), ``ids`` ascending."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, kept_bits: int = KEPT_BITS):
        self.ids, self.values = ids, values
        self.n, self.width = values.shape
        self.low = values.min(axis=0) if self.n else np.zeros(self.width, np.int64)
        span = (values - self.low)
        top = int(span.max()) if span.size else 0
        self.drop = max(0, top.bit_length() - kept_bits)
        quantised = span >> self.drop
        self.words = -(-self.n // 64)
        self.slices: list[list[np.ndarray | None]] = []
        for d in range(self.width):
            own = []
            for s in range(int(quantised[:, d].max()).bit_length() if self.n else 0):
                bits = np.zeros(self.words * 64, np.uint8)
                bits[:self.n] = (quantised[:, d] >> s) & 1
                own.append(np.packbits(bits, bitorder="little").view("<u8"))
            self.slices.append(own)
        bits = np.zeros(self.words * 64, np.uint8)
        bits[:self.n] = 1
        self.all = np.packbits(bits, bitorder="little").view("<u8")

    def _sum(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of sum_d |q_d| * a_d, where a_d is the quantised attribute for q_d > 0 and its
        complement to the largest quantised value for q_d < 0."""
        columns: list[list[np.ndarray]] = []
        for d, q in enumerate(query.tolist()):
            own, m = self.slices[d], abs(q)
            while m:
                bit = (m & -m).bit_length() - 1
                m &= m - 1
                for s, bitmap in enumerate(own):
                    while len(columns) <= bit + s:
                        columns.append([])
                    columns[bit + s].append(bitmap if q > 0 else bitmap ^ self.all)
        out, k = [], 0
        while k < len(columns):
            held = columns[k]
            carry: list[np.ndarray] = []
            while len(held) > 2:                     # full adder: three slices to sum and carry
                a, b, c = held.pop(), held.pop(), held.pop()
                x = a ^ b
                held.insert(0, x ^ c)
                carry.append((a & b) | (x & c))
            if len(held) == 2:                       # half adder
                a, b = held
                held = [a ^ b]
                carry.append(a & b)
            out.append(held[0] if held else np.zeros(self.words, "<u8"))
            if carry:
                if k + 1 == len(columns):
                    columns.append([])
                columns[k + 1] += carry
            k += 1
        return out

    def _at_least(self, slices: list[np.ndarray], bound: int) -> np.ndarray:
        """Bitmap of the rows whose sum is at least ``bound``."""
        if bound <= 0:
            return self.all
        if bound.bit_length() > len(slices):
            return np.zeros_like(self.all)
        above, equal = np.zeros_like(self.all), self.all.copy()
        for s in range(len(slices) - 1, -1, -1):
            if bound >> s & 1:
                equal &= slices[s]
            else:
                above |= equal & slices[s]
                equal &= ~slices[s]
        return above | equal

    def _kth(self, slices: list[np.ndarray], among: np.ndarray, k: int) -> int:
        """The k-th largest sum among the rows of a bitmap, from the top slice downward."""
        equal, bound = among.copy(), 0
        for s in range(len(slices) - 1, -1, -1):
            hit = equal & slices[s]
            n = int(np.bitwise_count(hit).sum())
            if n >= k:
                equal, bound = hit, bound | 1 << s
            else:
                equal &= ~slices[s]
                k -= n
        return bound

    def top(self, query: np.ndarray, k: int, but: int | None = None) -> tuple[np.ndarray, list[int]]:
        """Ids and exact scores of the k best rows other than ``but``, ties to smaller ids."""
        among = self.all
        if but is not None:
            skip = np.flatnonzero(self.ids == but)
            if len(skip):
                among = among.copy()
                for r in skip.tolist():
                    among[r // 64] &= ~np.uint64(1 << (r % 64))
        left = int(np.bitwise_count(among).sum())
        if not left or not k:
            return self.ids[:0], []
        if left > k:
            slices = self._sum(query)
            # A row's true score lies in (approximate, approximate + error) * 2^drop, shifted alike
            # for all rows; a complement's dropped bits err the other way, within the same bound.
            error = sum(map(abs, query.tolist()))
            bound = self._kth(slices, among, k) - error
            among = among & self._at_least(slices, bound)
        rows = np.flatnonzero(np.unpackbits(among.view(np.uint8), bitorder="little")[:self.n])
        score = _products(self.values[rows], query)
        order = np.lexsort((self.ids[rows], [-s for s in score] if score.dtype == object else -score))[:k] \
            if score.dtype != object else np.array(sorted(range(len(rows)), key=lambda i: (-score[i], self.ids[rows[i]]))[:k])
        return self.ids[rows[order]], [int(s) for s in score[order]]


def _products(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products; Python integers where 64 bits could overflow."""
    if not values.size:
        return np.zeros(len(values), np.int64)
    if float(np.abs(values).max()) * float(np.abs(query).max()) * len(query) < 2.0 ** 62:
        return values @ query
    return values.astype(object) @ query.astype(object)


def quantise(vectors: DataFrame, *, id_col: str, vector_col: str, scale: int = 256) -> tuple[DataFrame, DataFrame]:
    """Two tables: ``(id, width, x)``, floor(scale * component) as longs, and ``(id, width, v)``, the
    vectors of which a component's floor is 2^61 or more, as they are.  Vectors that are null,
    empty, or hold null or non-finite components are left out, as are null ids."""
    x = F.transform(F.col("v"), lambda c: F.floor(c * F.lit(float(scale))))
    infinite, most = float("inf"), float(WIDE) / scale
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .filter(F.forall("v", lambda c: F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < infinite), F.lit(False))))
            .withColumn("wide", F.exists("v", lambda c: F.abs(c) >= most)))
    return (rows.filter("NOT wide").select("id", F.size("v").alias("width"), x.alias("x")),
            rows.filter("wide").select("id", F.size("v").alias("width"), "v"))


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v) of doubles as Python integers; ``scale`` is a power of two."""
    return np.array([int(v) * scale if abs(v) >= 2.0 ** 53 else math.floor(v * scale) for v in values.ravel().tolist()],
                    dtype=object).reshape(values.shape)


def _shown(score: int) -> tuple[int, str]:
    """A score as a long, and what orders scores that a long cannot hold among each other."""
    if -MOST <= score <= MOST:
        return score, "" if score >= 0 else "~"
    digits = str(abs(score))
    key = f"{len(digits):06d}{digits}"
    return (MOST, key) if score > 0 else (-MOST, key.translate(str.maketrans("0123456789", "9876543210")))


def _wide_search(rows: DataFrame, asked: DataFrame, k: int, scale: int) -> DataFrame:
    """Top k of every query among ``rows`` where at least one side is wide: ``(id, width, v)`` as
    doubles, scored by exact integers, a batch of joined pairs at a time."""
    schema = pa.schema(_FOUND)

    def score(batches):
        for batch in batches:
            best: dict[int, list] = {}
            a, b = (_integers(np.stack([np.asarray(v, float) for v in batch.column(f).to_pylist()]), scale) for f in ("v", "qv")) \
                if batch.num_rows else (None, None)
            for j, (q, i) in enumerate(zip(batch.column("query_id").to_pylist(), batch.column("id").to_pylist())):
                best.setdefault(q, []).append((-int(sum(x * y for x, y in zip(a[j], b[j]))), i))
            out = [(q, i, *_shown(-s)) for q, found in best.items() for s, i in sorted(found)[:k]]
            if out:
                yield batch_of(schema, list(zip(*out)))

    q = asked.select("width", F.col("id").alias("query_id"), F.col("v").alias("qv"))
    return rows.join(q, "width").filter("id <> query_id").select("query_id", "id", "v", "qv").mapInArrow(score, _FOUND_DDL)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def _blocks(rows: DataFrame, size: int, name: str, spark: SparkSession) -> tuple[DataFrame, int]:
    """``(width, block, n, ids, values)``: rows packed into blocks of about ``size`` by a hash."""
    n = max(1, -(-rows.count() // size))
    schema = pa.schema([("width", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("vals", pa.binary())])

    def gather(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        ids = t.column("id").to_numpy()
        values = _matrix(t.column("x").combine_chunks())
        order = np.argsort(ids, kind="stable")
        return pa.Table.from_batches([batch_of(schema, [
            [key[0].as_py()], [key[1].as_py()], [ids[order].astype("<i8").tobytes()], [values[order].astype("<i8").tobytes()]])])

    packed = (rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)))
              .groupBy("width", "block").applyInArrow(gather, "width int, block long, ids binary, vals binary"))
    return written(spark, packed, name), n


def top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 5, *, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 256, row_block: int = ROW_BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, id, score)``: for each query its k rows with the largest integer inner
    products, other rows than its own id; ties to the smaller id; fewer where there are fewer.

    Rows of another length than the query's are no candidates.  Repeated ids are candidates
    one by one, and a query id that repeats is ranked once over what its rows find.  A score
    beyond a long is shown as the largest or smallest one; ranks follow the exact score.  Vectors
    whose integers leave 64 bits are scored apart, by Python integers.  Empty tables give no row.
    """
    narrow, wide = quantise(vectors, id_col=id_col, vector_col=vector_col, scale=scale)
    narrow_q, wide_q = quantise(queries, id_col=id_col, vector_col=vector_col, scale=scale)
    rows, _ = _blocks(narrow, row_block, "bsi-rows", spark)
    asked, _ = _blocks(narrow_q, query_block, "bsi-queries", spark)
    wide, wide_q = written(spark, wide, "bsi-wide"), written(spark, wide_q, "bsi-wide-queries")
    schema = pa.schema(_FOUND)

    def answer(index, q_ids, q_vals, width):
        found = ([], [], [], [])
        for q, x in zip(q_ids.tolist(), q_vals.reshape(len(q_ids), width)):
            ids, scores = index.top(x, k, but=q)
            found[0].extend([q] * len(ids))
            found[1].extend(ids.tolist())
            shown = [_shown(s) for s in scores]
            found[2].extend(s for s, _ in shown)
            found[3].extend(b for _, b in shown)
        return batch_of(schema, found)

    def search(batches):
        # Rows arrive ordered by index, query block, record: an index is built once and used
        # for all query blocks that come to it.
        at, ids, vals, index, asking = None, [], [], None, None
        for batch in batches:
            c = {f: batch.column(f).to_pylist() for f in batch.schema.names}
            for j in range(batch.num_rows):
                here, query = (c["width"][j], c["index"][j]), c["q_block"][j]
                if asking is not None and (here, query) != asking[0]:
                    index = index or _index(ids, vals)
                    yield answer(index, *asking[1], asking[0][0][0])
                if here != at:
                    at, ids, vals, index = here, [], [], None
                if index is None:
                    ids.append(np.frombuffer(c["ids"][j], "<i8"))
                    vals.append(np.frombuffer(c["vals"][j], "<i8").reshape(-1, c["width"][j]))
                asking = ((here, query), (np.frombuffer(c["q_ids"][j], "<i8"), np.frombuffer(c["q_vals"][j], "<i8")))
        if asking is not None:
            yield answer(index or _index(ids, vals), *asking[1], asking[0][0][0])

    def _index(ids, vals):
        ids, vals = np.concatenate(ids), np.concatenate(vals)
        order = np.argsort(ids, kind="stable")
        return BitSlicedIndex(ids[order], vals[order])

    q = asked.select("width", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals"))
    rows = rows.withColumn("index", F.expr(f"block div {INDEX_BLOCKS}"))
    pairs = (rows.join(q, "width").select("width", "index", "q_block", "block", "ids", "vals", "q_ids", "q_vals")
             .repartition("width", "index").sortWithinPartitions("width", "index", "q_block", "block"))
    found = pairs.mapInArrow(search, _FOUND_DDL)
    if not (wide.isEmpty() and wide_q.isEmpty()):
        def plain(x):
            return x.select("id", "width", F.transform("x", lambda c: c / F.lit(float(scale))).alias("v"))

        found = (found.union(_wide_search(wide, plain(narrow_q).union(wide_q), k, scale))
                 .union(_wide_search(plain(narrow), wide_q, k, scale)))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
