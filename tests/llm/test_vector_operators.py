"""Operators over vectors against brute force, with edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bikelake.llm import bitslice, hnsw
from bikelake.llm.common import ship_package

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [(9001, None, 1), (9002, [0.0] * 8, 1), (9003, [float("nan")] * 8, 1), (9004, [None] + [1.0] * 7, 1),
       (9005, [float("inf")] + [0.0] * 7, 1), (9006, [1.0, 2.0], 1), (9007, [], 1), (9008, [1.0] * 8, None)]


@pytest.fixture(autouse=True)
def _code(spark):
    ship_package(spark)


def vectors(seed=0, n=400, dim=8):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, dim)).astype(np.float32)
    x[n // 2:] = x[rnd.integers(0, n // 8, n - n // 2)] + 0.05 * rnd.normal(size=(n - n // 2, dim)).astype(np.float32)
    x[-3:] = x[0]
    return [(int(k), [float(c) for c in v], int(k % 3)) for k, v in enumerate(x)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit("clash")).withColumn("n", F.lit("clash"))


def test_bit_slices_add_up_to_exact_top():
    rnd = np.random.default_rng(1)
    for _ in range(60):
        n, d = int(rnd.integers(1, 300)), int(rnd.integers(1, 12))
        v = rnd.integers(-300, 300, (n, d)) * int(rnd.choice([1, 1, 1 << 40]))
        if rnd.random() < 0.3:
            v[:] = v[0]
        index = bitslice.BitSlicedIndex(np.arange(n) * 3, v)
        q, k = rnd.integers(-300, 300, d) * int(rnd.choice([1, 1 << 30])), int(rnd.integers(1, 8))
        but = int(rnd.integers(0, 3 * n))
        score = v.astype(object) @ q.astype(object)
        want = sorted(((-s, i) for s, i in zip(score, index.ids.tolist()) if i != but))[:k]
        ids, got = index.top(q, k, but)
        assert [(-s, i) for s, i in zip(got, ids.tolist())] == want


def test_top_k_equals_brute_force(spark):
    rows = vectors() + ODD
    df = frame(spark, rows)
    got = {(r.query_id, r["rank"]): (r.id, r.score) for r in bitslice.top_k(
        spark, df, df.filter("vec_id % 50 = 0"), 5, row_block=64, query_block=3).collect()}
    x = {i: np.floor(256.0 * np.array(v, np.float32).astype(float)).astype(int) for i, v, _ in rows
         if v and None not in v and np.isfinite(v).all()}
    want = {}
    for q in x:
        if q % 50 == 0:
            s = sorted((-int(x[q] @ x[i]), i) for i in x if i != q and len(x[i]) == len(x[q]))[:5]
            want.update({(q, r + 1): (i, -a) for r, (a, i) in enumerate(s)})
    assert got == want
    assert bitslice.top_k(spark, df.limit(0), df.limit(0), 5).count() == 0


def brute_links(rows, threshold=0.93):
    ok = [(i, np.array(v, np.float32).astype(float), c) for i, v, c in rows
          if v and None not in v and np.isfinite(v).all() and np.any(v) and c is not None]
    near = {i: set() for i, _, _ in rows}
    for a, (i, x, c) in enumerate(ok):
        for j, y, e in ok[a + 1:]:
            if c == e and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                near[i].add(j)
                near[j].add(i)
    least = {}
    for i in sorted(near):
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in least:
                least[k] = i
                todo += near[k]
    return near, least


@pytest.mark.parametrize("shard", [16384, 60])
def test_embedding_dedup_recall_and_precision(spark, shard):
    rows = vectors(seed=2, n=700) + ODD
    got = {r.id: r for r in hnsw.near_duplicates(spark, frame(spark, rows), shard_size=shard).collect()}
    near, least = brute_links(rows)
    assert set(got) == set(near)
    found, true = sum(r.n_links for r in got.values()), sum(map(len, near.values()))
    assert 0.99 * true <= found <= true and all(r.n_links <= len(near[i]) for i, r in got.items())
    assert np.mean([got[i].component_id == least[i] for i in near]) > 0.99
    assert all(r.kept == (r.id == r.component_id) for r in got.values())
    assert all(got[i].n_links == 0 and got[i].kept for i, *_ in ODD[:5])
    assert hnsw.near_duplicates(spark, frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("noise", [0.01, 0.0])
def test_no_member_of_a_large_copy_group_is_lost(noise):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(1500, 32))
    x[900:] = x[7] + noise * rnd.normal(size=(600, 32))
    unit = hnsw._unit(x)
    graph = hnsw.Graph(unit, np.arange(1500).astype(np.uint64))
    linked = np.unique(graph.out[0])
    assert set(range(1500)) - {graph.start} <= set(linked.tolist())
    q = unit.astype(np.float32)
    got = graph.near(q, np.float32(0.93), hnsw.SEARCH_BEAM)
    true = [np.flatnonzero(graph.x @ v >= np.float32(0.93)) for v in q]
    found = sum(len(np.intersect1d(a, b)) for a, b in zip(got, true))
    assert found >= hnsw.AUDIT_RECALL * sum(map(len, true))
    assert all(len(a) == len(set(a.tolist())) for a in got)


def test_audit_takes_queries_with_links_each_alike():
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(3000, 32))
    x[1000:2000] = x[7]                                        # a group of copies
    x[2000:2100] = x[2100:2200] + 0.05 * rnd.normal(size=(100, 32))   # rare pairs
    ids, unit = np.arange(3000), hnsw._unit(x)
    graph = hnsw.Graph(unit, ids.view(np.uint64))
    asked, seen = [], graph.near

    def near(q, least, beam):
        asked.append((len(q), beam))
        found = seen(q, least, beam)
        # a search that loses rare links until its beam is wide: links of copies hide nothing
        return found if beam >= 4 * hnsw.SEARCH_BEAM else [h if len(h) > 100 else h[:1] for h in found]

    graph.near = near
    beam = hnsw.audited_beam(graph, ids, ids, unit.astype(np.float32), np.float32(0.93))
    assert beam == 4 * hnsw.SEARCH_BEAM and all(n >= hnsw.AUDIT for n, _ in asked)
    lone = hnsw._unit(rnd.normal(size=(50, 32)))
    graph = hnsw.Graph(lone, np.arange(50).astype(np.uint64))
    assert hnsw.audited_beam(graph, np.arange(50), np.arange(50), lone.astype(np.float32), np.float32(0.93)) == hnsw.SEARCH_BEAM


def test_a_link_counts_for_both_sides():
    import zlib

    import pyarrow as pa
    rnd = np.random.default_rng(3)

    def row(forward, rows, cols, grid):
        return {"forward": forward, "rows": rows.astype("<i8").tobytes(), "cols": cols.astype("<i8").tobytes(),
                "bits": zlib.compress(np.packbits(grid, axis=1).tobytes(), 1)}

    def counts(low, high, rows):
        got = hnsw.count_links(tuple(map(pa.scalar, ("x", 4, low, high))), pa.Table.from_pylist(rows))
        return dict(zip(*(c.to_pylist() for c in got.columns)))

    a, b = np.arange(1300) * 2, np.arange(77) * 2 + 1
    ab, ba, aa = rnd.random((1300, 77)) < 0.01, rnd.random((77, 1300)) < 0.01, rnd.random((1300, 1300)) < 0.002
    np.fill_diagonal(aa, False)
    for one, two in ((ab, ba), (ab, None), (None, ba)):
        both = (one if one is not None else False) | (two.T if two is not None else False)
        rows = ([row(True, a, b, one)] if one is not None else []) + ([row(False, b, a, two)] if two is not None else [])
        want = {**dict(zip(a.tolist(), both.sum(axis=1).tolist())), **dict(zip(b.tolist(), both.sum(axis=0).tolist()))}
        assert counts(0, 1, rows) == {k: n for k, n in want.items() if n}
    want = dict(zip(a.tolist(), (aa | aa.T).sum(axis=1).tolist()))
    assert counts(5, 5, [row(True, a, a, aa)]) == {k: n for k, n in want.items() if n}


def test_rows_that_repeat_an_id_count_as_one_vector(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.01], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, 1.0], 1)]
    got = {r.id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(spark, frame(spark, rows), shard_size=1).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
