"""Similarity join of documents on word n-grams: prefix-tree join, exact Jaccard.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.  Two documents link
when their sets' Jaccard similarity reaches the threshold.  The steps:

1. Sets are hashed where the texts are read.  Equal sets are one *node* from here on (a 64-bit
   hash of the set), however many documents share it.  A count sketch of fixed size is summed
   over all nodes' shingles; it only serves to order shingles, rare ones first.
2. Prefix filter.  In any common order, linked sets share a shingle among the first
   n - ceil(0.8 n) + 1 of each; with prefixes longer by d(n) they share at least 1 + d of the
   smaller set.  Prefix entries are dealt by shingle, packed in arrays.  A shingle of few
   nodes yields its pairs, which are counted; a shingle of many nodes yields no pairs: it
   counts for each of its nodes, and nodes with enough such shingles to reach 1 + d are
   chained, by way of a few groups, to the shingle's smallest node.  No link between
   different sets is lost.
3. Candidate edges form clusters, clusters are cut into blocks of bounded size, and the whole
   sets of a block go into a trie in one global order, frequent shingles first.  Every set
   traverses the trie: overlap along a shared path is counted once for all sets below, and
   a subtree is pruned when the remaining lengths cannot reach the overlap that the threshold
   needs.  Sets already known to be connected are not compared again: the result is the
   components, and the links of one component's members among themselves add nothing to it.
4. A cluster of several blocks shares some sets among all of its blocks, which connects what
   is alike.  Sets outside the cluster's largest component then traverse the tries of all its
   other blocks, so that every link between components is found.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.llm.common import batch_of, components, texts_of, written

WORDS = 5
PERCENT = 80               # links: 100 * intersection >= PERCENT * union
SKETCH_BITS = 20           # size of the count sketch, fixed
FILTER_BITS = (16, 29)     # size of the filter of ids whose sets are shipped: about 16 bits an id between these
CHAIN_SALTS = 16           # groups in which a frequent shingle is chained
FEW_NODES = 24             # a shingle of at most so many nodes yields pairs
PART_ENTRIES = 200_000     # prefix entries of a part, about
BLOCK_SETS = 400           # sets of a trie, about
BLOCK_SHINGLES = 1_000_000
ANCHORS = 12               # sets that all blocks of a large cluster share, about
SIZE_STEPS = 200.0         # resolution of stored set sizes: floor(SIZE_STEPS * ln n)

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a UTF-8 text's shingles: A-Z lower-cased, words cut at ASCII
    white space; with fewer words, the whole sequence is one shingle; without, none."""
    import xxhash
    w = text.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    size = min(words, len(w))
    s = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        s = (s ^ h[k:len(w) - size + 1 + k]) * _ODD[k % len(_ODD)]
        s ^= s >> np.uint64(32)
    return np.unique(_mix(s))


def set_hash(s: np.ndarray) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def slack(n):
    """Prefix entries beyond those that the filter needs; grows with n."""
    return np.where(n < 6, 0, np.maximum(1, n // 25))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return min(n, n - -(-percent * n // 100) + 1 + int(slack(n)))


# ------------------------------------------------------------------- pass 1: sets and sketch

def _documents_and_sketch(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()),
                        ("block", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        total, held, waiting, seen = None, [], 0, set()
        for batch in batches:
            n, node = [], []
            for text in texts_of(batch.column(1)):
                s = shingle_set(text, words)
                h = set_hash(s)
                n.append(len(s))
                node.append(h)
                if len(s) and h not in seen:
                    seen.add(h)
                    held.append(s >> np.uint64(64 - SKETCH_BITS))
                    waiting += len(s)
                    if waiting > 2_000_000:
                        total = _count(held, total)
                        held, waiting = [], 0
            none = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
            yield batch_of(schema, [batch.column(0), n, node, *none])
        if held:
            total = _count(held, total)
        if total is not None:
            yield from _sketch_rows(schema, total)

    return run


def _count(held, total):
    c = np.bincount(np.concatenate(held).astype(np.int64), minlength=1 << SKETCH_BITS)
    return c if total is None else total + c


def _sketch_rows(schema, total):
    for k, part in enumerate(np.split(total, 16)):
        yield batch_of(schema, [[None], [None], [None], [k],
                                [zlib.compress(np.minimum(part, 0xFFFFFFFF).astype("<u4").tobytes(), 1)]])


def _sum_sketches(batches):
    """Sum the sketch blocks of a partition as they stream by."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()),
                        ("block", pa.int32()), ("counts", pa.binary())])
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, c in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            c = np.frombuffer(zlib.decompress(c), "<u4").astype(np.int64)
            sums[k] = sums[k] + c if k in sums else c
    for k, part in sums.items():
        yield batch_of(schema, [[None], [None], [None], [k],
                                [zlib.compress(np.minimum(part, 0xFFFFFFFF).astype("<u4").tobytes(), 1)]])


def _filter_bits(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    h = _mix(h.view(np.uint64))
    at = np.concatenate([h & np.uint64((1 << size) - 1), h >> np.uint64(64 - size)]).astype(np.int64)
    return at >> 3, (1 << (at & 7)).astype(np.uint8)


def _filter_blocks(bits: np.ndarray):
    schema = pa.schema([("block", pa.int32()), ("bits", pa.binary())])
    for k, part in enumerate(np.split(bits, 16)):
        yield batch_of(schema, [[k], [zlib.compress(part.tobytes(), 1)]])


def _make_filter(size: int):
    def run(batches):
        bits = np.zeros(1 << size - 3, np.uint8)
        for batch in batches:
            np.bitwise_or.at(bits, *_filter_bits(batch.column(0).to_numpy(), size))
        if bits.any():
            yield from _filter_blocks(bits)

    return run


def _join_filters(batches):
    schema = pa.schema([("block", pa.int32()), ("bits", pa.binary())])
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            c = np.frombuffer(zlib.decompress(c), np.uint8)
            sums[k] = sums[k] | c if k in sums else c
    for k, part in sums.items():
        yield batch_of(schema, [[k], [zlib.compress(part.tobytes(), 1)]])


def filter_size(ids: int) -> int:
    return min(max((16 * ids).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])


def id_filter(ids: DataFrame) -> tuple[np.ndarray, int]:
    """Bit filter that passes every id of the one column and some two in a hundred others, and the
    logarithm of its size.  It takes at most 64 MB, enough for about 30 million ids; of
    more ids it passes more others, which costs work but no result."""
    size = filter_size(ids.count())
    bits = np.zeros(1 << size - 3, np.uint8)
    made = (ids.mapInArrow(_make_filter(size), "block int, bits binary").repartition("block")
            .mapInArrow(_join_filters, "block int, bits binary"))
    for r in made.collect():  # 16 rows of at most 4 MB
        width = len(bits) // 16
        bits[r[0] * width:(r[0] + 1) * width] = np.frombuffer(zlib.decompress(r[1]), np.uint8)
    return bits, size


# ------------------------------------------------------------------- pass 2: prefix entries

def _prefixes(sketch, parts: int, words: int, percent: int):
    schema = pa.schema([("part", pa.int64()), ("shingles", pa.binary()), ("nodes", pa.binary()), ("sizes", pa.binary())])

    def flush(held):
        h = np.concatenate([x[0] for x in held])
        node = np.repeat(np.array([x[1] for x in held], np.int64), [len(x[0]) for x in held])
        size = np.repeat(np.array([x[2] for x in held], np.uint16), [len(x[0]) for x in held])
        part = (h % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, short, node, size = part[order], (h[order] >> np.uint64(32)).astype("<u4"), node[order], size[order]
        at = np.searchsorted(part, np.arange(parts + 1))
        rows = [(p, short[a:b].tobytes(), node[a:b].astype("<i8").tobytes(), size[a:b].astype("<u2").tobytes())
                for p, (a, b) in enumerate(zip(at[:-1], at[1:])) if b > a]
        return batch_of(schema, list(zip(*rows)))

    def run(batches):
        counts = sketch.value
        held, waiting, seen = [], 0, set()
        for batch in batches:
            for text in texts_of(batch.column(0)):
                s = shingle_set(text, words)
                h = set_hash(s)
                if not len(s) or h in seen:
                    continue
                seen.add(h)
                size = prefix_length(len(s), percent)
                c = counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                if size < len(s):  # s is ascending, so equal counts stay ordered by hash
                    s = s[np.argsort(c, kind="stable")[:size]]
                held.append((s, h, int(SIZE_STEPS * np.log(len(c)))))
                waiting += len(s)
                if waiting >= 2_000_000:
                    yield flush(held)
                    held, waiting = [], 0
        if held:
            yield flush(held)

    return run


def _candidates(percent: int):
    """Of one part: counted pairs of shingles with few nodes, and the nodes of the others."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int32()), ("size", pa.int32())])
    apart = int(np.ceil(SIZE_STEPS * np.log(100.0 / percent))) + 1

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        t = np.concatenate([np.frombuffer(x, "<u4") for x in rows.column("shingles").to_pylist()])
        v = np.concatenate([np.frombuffer(x, "<i8") for x in rows.column("nodes").to_pylist()])
        s = np.concatenate([np.frombuffer(x, "<u2") for x in rows.column("sizes").to_pylist()]).astype(np.int32)
        order = np.lexsort((v, t))
        t, v, s = t[order], v[order], s[order]
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1])
        t, v, s = t[fresh], v[fresh], s[fresh]
        start = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        size = np.diff(np.r_[start, len(t)])
        of = np.repeat(size, size)
        few = (of > 1) & (of <= FEW_NODES)
        ft, fv, fs = t[few], v[few], s[few]
        a, b, z = [], [], []
        for d in range(1, FEW_NODES):
            same = np.flatnonzero((ft[d:] == ft[:-d]) & (np.abs(fs[d:] - fs[:-d]) <= apart))
            a.append(fv[same])
            b.append(fv[same + d])
            z.append(np.minimum(fs[same], fs[same + d]))
        a, b, z = np.concatenate(a), np.concatenate(b), np.concatenate(z)
        order = np.lexsort((b, a))
        a, b, z = a[order], b[order], z[order]
        first = np.flatnonzero(np.r_[np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        shared = np.diff(np.r_[first, len(a)])
        many = of > FEW_NODES
        # shared = -1: node a holds the frequent shingle b (named by part and short hash)
        name = (t[many].astype(np.int64) << 31) ^ int(key[0].as_py())
        return pa.Table.from_batches([
            batch_of(schema, [a[first], b[first], shared.astype(np.int32), z[first]]),
            batch_of(schema, [v[many], name, np.full(int(many.sum()), -1, np.int32), s[many]])])

    return run


# ------------------------------------------------------------------- the trie

class Trie:
    """Path-compressed prefix tree of sets given as ascending rank arrays, sorted by the array.

    Nodes are numbered level by level, so the children of a node are a range of numbers.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.length = length = np.array([len(s) for s in sets])
        common = np.zeros(max(0, len(sets) - 1), np.int64)
        for k, (x, y) in enumerate(zip(sets, sets[1:])):
            m = min(len(x), len(y))
            differ = np.flatnonzero(x[:m] != y[:m])
            common[k] = differ[0] if len(differ) else m
        lo, hi, depth, edges, child = [], [], [], [], []
        level = [(0, len(sets), 0)]
        while level:
            below, number = [], len(lo) + len(level)
            for a, b, d in level:
                to = int(length[a]) if b - a == 1 else int(common[a:b - 1].min())
                lo.append(a)
                hi.append(b)
                depth.append(to)
                edges.append(sets[a][d:to])
                kids = []
                if b - a > 1:
                    cuts = [a, *(a + 1 + np.flatnonzero(common[a:b - 1] == to)).tolist(), b]
                    kids = [(x, y, to) for x, y in zip(cuts, cuts[1:])]
                child.append((number + len(below), number + len(below) + len(kids)))
                below += kids
            level = below
        self.lo, self.hi, self.depth = np.array(lo), np.array(hi), np.array(depth)
        self.child = np.array(child)
        self.shortest = np.array([length[a:b].min() for a, b in zip(lo, hi)])
        self.longest = np.array([length[a:b].max() for a, b in zip(lo, hi)])
        size = np.array([len(e) for e in edges])
        self.end = np.cumsum(size)
        self.begin = self.end - size
        self.flat = np.concatenate(edges)
        # rank of the last shingle of the path to a node; children without an edge share it
        self.last = np.array([int(sets[a][d - 1]) if d else -1 for a, d in zip(lo, depth)])


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated ranges and the bounds of each in the result."""
    size = end - begin
    upto = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(begin - upto[:-1], size) + np.arange(upto[-1]), upto


def trie_links(sets: list[np.ndarray], probe: np.ndarray, component: np.ndarray,
               percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between the sets (arrays of distinct hashes), as index pairs that, with the known
    components, connect whatever links connect; with probes, links of a probe and a set that
    is none."""
    flat = np.concatenate(sets)
    names, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(names), np.int64)
    rank[np.lexsort((names, -count))] = np.arange(len(names))
    ranked, at = [], 0
    for s in sets:
        ranked.append(np.sort(rank[inverse[at:at + len(s)]]))
        at += len(s)
    order = np.array(sorted(range(len(sets)), key=lambda i: ranked[i].astype(">i8").tobytes()))
    ranked = [ranked[i] for i in order]
    is_probe = probe[order]
    label = np.unique(component[order], return_inverse=True)[1]
    mixed = bool(probe.any())
    targets = np.flatnonzero(~is_probe) if mixed else np.arange(len(order))
    trie = Trie([ranked[i] for i in targets])
    links = []
    member = np.zeros(len(names), bool)
    share = 100 + percent
    for q in (np.flatnonzero(is_probe) if mixed else range(len(order))):
        own = ranked[q]
        n = len(own)
        member[own] = True
        nodes, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)   # the root
        while len(nodes):
            high, low = trie.longest[nodes], trie.shortest[nodes]
            leaf = trie.hi[nodes] - trie.lo[nodes] == 1
            open_ = (100 * high >= percent * n) & (percent * low <= 100 * n)
            if not mixed:
                open_ &= trie.hi[nodes] > q + 1                 # pairs are met from the smaller index
            open_ &= ~leaf | (label[targets[trie.lo[nodes]]] != label[q])
            nodes, overlap, low, high, leaf = (x[open_] for x in (nodes, overlap, low, high, leaf))
            at, upto = _ranges(trie.begin[nodes], trie.end[nodes])
            hits = np.concatenate([[0], np.cumsum(member[trie.flat[at]])])
            overlap = overlap + hits[upto[1:]] - hits[upto[:-1]]
            left = n - np.searchsorted(own, trie.last[nodes], "right")
            need = -(-percent * (n + np.maximum(low, -(-percent * n // 100))) // share)
            alive = overlap + np.minimum(left, high - trie.depth[nodes]) >= need
            done = alive & leaf & (100 * overlap >= percent * (n + low - overlap))
            for t in targets[trie.lo[nodes[done]]].tolist():
                if label[t] != label[q]:
                    label[label == label[t]] = label[q]
                    links.append((int(order[q]), int(order[t])))
            down = alive & ~leaf
            kids = trie.child[nodes[down]]
            overlap = np.repeat(overlap[down], kids[:, 1] - kids[:, 0])
            nodes = _ranges(kids[:, 0], kids[:, 1])[0]
        member[own] = False
    return links


def _block_links(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        node = rows.column("node").to_numpy()
        probe = rows.column("probe").to_numpy()
        # a set of the block that also comes as its probe counts once, as the block's
        order = np.lexsort((probe, node))
        keep = order[np.r_[True, node[order][1:] != node[order][:-1]]]
        if len(keep) < 2 or probe[keep].all():
            return pa.Table.from_batches([], schema=schema)
        raw = rows.column("shingles").take(pa.array(keep)).to_pylist()
        links = trie_links([np.frombuffer(x, "<u8") for x in raw], probe[keep],
                           rows.column("component").to_numpy()[keep], percent)
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table([node[keep][a], node[keep][b]], schema=schema)

    return run


# ------------------------------------------------------------------- the join

def similarity_components(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id",
                          text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``: the size of its set and
    the smallest doc_id it can reach by links, itself included.

    Texts that are null, empty or without words have no shingles, link with nothing and are
    components of their own, as is a row with a null id that no other row with an id equals
    or resembles (its component is then null).  Rows that repeat an id are one document for
    the component's number, but each is compared with its own text.  An empty table gives no
    row.
    """
    return _components_by_row(spark, docs, id_col, text_col, words, percent).drop("node")


def _components_by_row(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``similarity_components`` with the hash of each row's set, ``node``."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    first = written(spark, src.mapInArrow(_documents_and_sketch(words),
                                          "doc_id long, n long, node long, block int, counts binary"), "join-sets")
    found = first.filter("block IS NULL").select("doc_id", "n", "node")
    part = "doc_id long, n long, node long, block int, counts binary"
    sums = (first.filter("block IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("counts"), F.lit(64)))
            .repartition("block", "salt").drop("salt").mapInArrow(_sum_sketches, part)
            .repartition("block").mapInArrow(_sum_sketches, part))
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in sums.select("block", "counts").collect():  # 16 rows of a fixed size
        width = len(sketch) // 16
        sketch[r[0] * width:(r[0] + 1) * width] = np.frombuffer(zlib.decompress(r[1]), "<u4")

    nodes = written(spark, found.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")),
                    "join-nodes")
    entries = nodes.agg(F.sum(F.col("n") * 0.25)).first()[0] or 0
    parts = int(entries // PART_ENTRIES) + 1
    shared = spark.sparkContext.broadcast(sketch)
    prefixes = src.select("text").filter("text IS NOT NULL").mapInArrow(
        _prefixes(shared, parts, words, percent), "part long, shingles binary, nodes binary, sizes binary")
    met = written(spark, prefixes.groupBy("part").applyInArrow(_candidates(percent), "a long, b long, shared int, size int"),
                  "join-met")

    # Sets share at least 1 + slack(smaller set) prefix entries; sizes are rounded down.
    least = F.expr(f"""CASE WHEN floor(exp(size / {SIZE_STEPS})) < 6 THEN 1
                       ELSE 1 + greatest(1, cast(floor(exp(size / {SIZE_STEPS})) AS long) div 25) END""")
    frequent = met.filter("shared < 0").select(F.col("a").alias("node"), F.col("b").alias("shingle"), "size")
    held = written(spark, frequent.groupBy("node").agg(F.count("*").alias("h"), F.min("size").alias("size")), "join-held")
    pairs = met.filter("shared > 0").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("size").alias("size"))
    h = held.select("node", "h")
    pairs = (pairs.join(h.select(F.col("node").alias("a"), F.col("h").alias("ha")), "a", "left")
             .join(h.select(F.col("node").alias("b"), F.col("h").alias("hb")), "b", "left")
             .filter(F.col("shared") + F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0))) >= least)
             .select("a", "b"))
    # The smallest partner a set can link to bounds the entries it must share.
    smaller = F.expr(f"size - {int(np.ceil(SIZE_STEPS * np.log(100.0 / percent))) + 1}")
    enough = held.withColumn("size", smaller).filter(F.col("h") >= least).select("node")
    # One shingle may be that of a third of all nodes: its nodes are chained to the smallest of
    # their group by a hash, and the smallest nodes of its few groups to the smallest of these.
    chained = (frequent.join(enough, "node", "left_semi")
               .select("node", "shingle", F.pmod(F.xxhash64("node"), F.lit(CHAIN_SALTS)).alias("salt")))
    near = chained.groupBy("shingle", "salt").agg(F.min("node").alias("b"))
    far = near.groupBy("shingle").agg(F.min("b").alias("centre"))
    chains = (chained.join(near, ["shingle", "salt"]).select(F.col("node").alias("a"), "b")
              .union(near.join(far, "shingle").select(F.col("b").alias("a"), F.col("centre").alias("b")))
              .filter("a <> b").distinct())
    cluster = components(spark, pairs.union(chains), "join-clusters").select("node", F.col("root").alias("cluster"))

    # Blocks of bounded size, by a hash; some sets of a large cluster stand in all its blocks.
    c = cluster.join(nodes, "node")
    sizes = c.groupBy("cluster").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("sets") / BLOCK_SETS),
                                                  F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("long"))
    c = written(spark, c.join(sizes, "cluster")
                .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
                .withColumn("anchor", (F.col("blocks") > 1) & (F.pmod(F.xxhash64("node", F.lit(1)), F.col("sets")) < ANCHORS))
                .select("node", "doc_id", "cluster", "blocks", "own", "anchor"), "join-blocks")

    def links(assigned: DataFrame, name: str) -> DataFrame:
        """Ship the sets of ``(node, doc_id, cluster, block, probe, component)`` to their blocks; join there."""
        wanted = written(spark, assigned, f"{name}-to")
        named, nameless = wanted.filter("doc_id IS NOT NULL"), wanted.filter("doc_id IS NULL").drop("doc_id")

        def sets_of(ids: DataFrame, by_node: bool):
            bits, size = id_filter(ids)
            passes = spark.sparkContext.broadcast(bits)
            schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("shingles", pa.binary())])

            def passed(ids):
                byte, bit = _filter_bits(ids, size)
                return ((passes.value[byte] & bit) > 0).reshape(2, -1).all(axis=0)

            def sets(batches):
                for batch in batches:
                    ids, text = batch.column(0), batch.column(1)
                    if not by_node:
                        hit = pa.array(passed(ids.to_numpy()))
                        ids, text = ids.filter(hit), text.filter(hit)
                    found = [shingle_set(t, words) for t in texts_of(text)]
                    node = np.array([set_hash(x) for x in found], np.int64)
                    hit = np.flatnonzero(passed(node)) if by_node else range(len(found))
                    yield batch_of(schema, [ids.take(pa.array(hit, pa.int64())), node[hit],
                                            [found[k].astype("<u8").tobytes() for k in hit]])

            return sets

        # Only texts that pass the filter are hashed and shuffled; the join is exact.  A
        # repeated id may stand for several texts: the node tells which one is meant.
        cols = ["node", "shingles", "cluster", "block", "probe", "component"]
        made = "doc_id long, node long, shingles binary"
        shipped = (src.filter("doc_id IS NOT NULL").mapInArrow(sets_of(named.select("doc_id"), False), made)
                   .join(named, ["doc_id", "node"]).select(cols))
        if nameless.take(1):
            # Texts that only rows with a null id hold: found by their node, one row for each.
            shipped = shipped.union(
                src.filter("doc_id IS NULL").mapInArrow(sets_of(nameless.select("node"), True), made)
                .groupBy("node").agg(F.first("shingles").alias("shingles")).join(nameless, "node").select(cols))
        return written(spark, shipped.groupBy("cluster", "block").applyInArrow(_block_links(percent), "a long, b long"), name)

    where = F.when(F.col("anchor"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("own"))
    edges = links(c.select("node", "doc_id", "cluster", F.explode(where).alias("block"), F.lit(False).alias("probe"),
                           F.col("node").alias("component")), "join-links")
    linked = components(spark, edges, "join-linked")

    # Large clusters: what is outside the largest component visits all other blocks.
    large = c.filter("blocks > 1").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = large.groupBy("cluster", "root").agg(F.count("*").alias("m"))
    main = by_root.groupBy("cluster").agg(F.max(F.struct("m", "root")).alias("x")).select("cluster", F.col("x.root").alias("main"))
    large = large.join(main, "cluster")
    outside = written(spark, large.filter("root <> main"), "join-outside")
    if outside.take(1):
        cols = ["node", "doc_id", "cluster", "block", "probe", F.col("root").alias("component")]
        visit = (outside.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
                 .filter("block <> own").withColumn("probe", F.lit(True)).select(*cols))
        home = (large.join(outside.select("cluster").distinct(), "cluster", "left_semi")
                .withColumn("block", F.col("own")).withColumn("probe", F.lit(False)).select(*cols))
        edges = edges.union(links(visit.union(home), "join-visits"))
        linked = components(spark, edges, "join-linked")

    of_node = (nodes.select("node", "doc_id").join(linked, "node", "left")
               .withColumn("root", F.coalesce("root", "node")))
    least_id = of_node.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_node = of_node.join(least_id, "root").select("node", "component_id")
    return (found.join(of_node, "node", "left")
            .select("doc_id", "node", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the smallest id.  Rows with a
    null id, which cannot be told apart, stay; of rows that repeat the kept id, all in its component
    stay.  Where rows of one id hold several texts, each goes or stays by its own text."""
    rows = written(spark, _components_by_row(spark, docs, id_col, text_col, words, percent)
                   .select("doc_id", "node", (F.col("component_id") != F.col("doc_id")).alias("goes")), "join-rows")
    ids = written(spark, rows.groupBy("doc_id").agg(F.bool_and("goes").alias("whole"), F.bool_or("goes").alias("some"))
                  .filter("some").select(F.col("doc_id").alias("__gone"), "whole"), "join-dropped")
    by_id = F.col(id_col) == F.col("__gone")
    kept = docs.join(ids.filter("whole"), by_id, "left_anti")
    parted = ids.filter("NOT whole")
    if not parted.take(1):
        return kept
    # Ids with several texts of which some go: the texts of these rows alone are hashed again.
    node = F.pandas_udf(lambda texts: texts.map(lambda t: set_hash(shingle_set(t or b"", words))), "long")
    gone = (rows.filter("goes").join(parted, F.col("doc_id") == F.col("__gone"), "left_semi")
            .select(F.col("doc_id").alias("__gone"), F.col("node").alias("__node")).distinct())
    several = kept.join(parted, by_id, "left_semi")
    return kept.join(parted, by_id, "left_anti").unionByName(
        several.join(gone, by_id & (node(F.col(text_col).cast("binary")) == F.col("__node")), "left_anti"))
