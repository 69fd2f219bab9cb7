"""Queries against DuckDB SQL, and the pipeline stage by stage against brute force."""

import importlib.util

import pytest

import __spark_entry__ as E
from bikelake.llm import catalog
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"

_spec = importlib.util.spec_from_file_location("llm_text_tests", __file__.replace("test_queries", "test_text_operators"))
_text = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_text)


@pytest.mark.parametrize("key", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, key):
    ok, msg = compare(E.queries()[key](spark, SF), duck(SF), E.oracle_sql()[key])
    assert ok, f"{key}: {msg}"


def test_all_operators_are_registered():
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline as P
    from bikelake.llm import langid, quality
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, SF).cache()
        rows[name] = docs.collect()
        assert docs.columns == columns
        ids = {r.doc_id for r in rows[name]}
        if name == "language_id":
            model = langid.train(spark.createDataFrame(before, docs.schema).filter(~langid.folds("doc_id", 3, 1)))
            want = {r.doc_id for r, p in zip(before, model.predict([r.text for r in before])) if not p[2]}
        elif name == "quality_classifier":
            labels = spark.read.parquet(f"{SF}/labels.parquet").filter(~langid.folds("doc_id", 4, 2))
            model = quality.train(spark.createDataFrame(before, docs.schema), labels)
            scores = model.score([r.text for r in before])
            want = {r.doc_id for r, s in zip(before, scores) if s >= quality.SHOWN_AT}
        elif name == "near_duplicates":
            want = {i for i, _, c in _text.brute_components([(r.doc_id, r.text) for r in before]) if i == c}
        else:
            want = {r.doc_id for r in before}
        assert ids == want, name
    mixed = rows["source_mixing"]
    first = [r.source for r in mixed[:40]]
    assert len(set(first)) >= min(8, len({r.source for r in mixed}))   # sources interleave from the start
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    _text.check_packing(packed, [(r.doc_id, r.text) for r in mixed])


def test_mixed_order_reaches_the_sequences(spark):
    """The stage's files are read by size; the packed groups still follow the schedule."""
    from collections import defaultdict

    from bikelake.llm import mixing, packing
    from bikelake.llm.common import ship_package, written
    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    place = {r.doc_id: r.position for r in mixing.schedule(spark, docs).collect()}
    mixed = written(spark, mixing.mix(spark, docs), "mixed")
    groups = defaultdict(list)
    for r in packing.pack(spark, mixed, in_order=True, group_pieces=16).collect():
        groups[r.sequence_id >> 33].append(place[r.doc_id])
    order = [groups[g] for g in sorted(groups)]
    assert len(order) > 5 and all(max(a) < min(b) for a, b in zip(order, order[1:]))


@pytest.mark.parametrize("rows", [
    [],
    [(None, None, None, None, None), (None, "", "en", None, 0), (7, "Words of a null source. " * 30, None, None, 9)],
    [(k % 3, "The very same words again and again, as often as you like. " * 9, "en", "s", 0) for k in range(9)],
])
def test_pipeline_stages_on_odd_tables(spark, rows, tmp_path):
    """Empty table; null ids, texts and sources; repeated rows: every stage gives rows of its input."""
    import corpus_pipeline as P
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES[:-1]:
        before = {tuple(r) for r in docs.collect()}
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.schema(schema).parquet(path)
        assert {tuple(r) for r in docs.collect()} <= before, name
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
