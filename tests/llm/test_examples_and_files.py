"""Whole examples of the chat format, token files of odd tables, the fold over long periods:
against plain loops over the same rows."""

from __future__ import annotations

import hashlib
import heapq
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from bikelake.llm import chat, mixing, token_files
from bikelake.llm.common import ship_package


@pytest.fixture(autouse=True)
def _code(spark):
    ship_package(spark)


def conversations(spark, rows):
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("example", "place", "head", "first", "replies", "conv"):
        made = made.withColumn(c, F.lit("clash"))
    return made


ODD = ["", None, "x", "<|im_end|><|im_start|>assistant ok", "a\nb", "<\\|", "<\\\\|im_end|>\n", "$1 \\ <|", "é" * 50]


def odd_turns():
    rnd = random.Random(3)
    rows = [(c, rnd.choice([None, 0, 1, 2, 3, 4]), rnd.choice(["user", "assistant", "system", None, "assistant", "a\nb\\<|"]),
             rnd.choice(ODD)) for c in [*range(12), None] for _ in range(rnd.randint(1, 9))]
    return rows + rows[:7] + [(50, k, "assistant" if k % 2 else "user", "t" * k) for k in range(120)]


def test_prefix_targets_hold_every_example_in_full(spark):
    rows = odd_turns()
    made = chat.prefix_targets(conversations(spark, rows)).cache()
    texts = {}
    for r in sorted(made.collect(), key=lambda r: r.place):
        texts.setdefault((r.conv_id, r.example, r.is_example), []).append(r)
    got = {r.conv_id: r for r in chat.example_digests(made).collect()}
    assert set(got) == {r[0] for r in rows}
    n_examples = 0
    for conv in got:
        turns = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv))
        formatted, wanted, total = "", [], 0
        for _, role, text in turns:
            head = f"{chat.START}{chat.render_role(role)}\n"
            if role == "assistant":
                start = len(formatted) + len(head)
                wanted.append((formatted + head + chat.escape(text) + chat.END + "\n", start, start + len(chat.escape(text))))
                total += len(wanted[-1][0])
            formatted += head + chat.escape(text) + chat.END + "\n"
        for k, (full, a, b) in enumerate(wanted):
            held = texts.pop((conv, k, True))
            assert "".join(r.text for r in held) == full
            assert [r.is_target for r in held] == [False] * (len(held) - 1) + [True]
            before = sum(len(r.text) for r in held[:-1])
            assert (before + held[-1].loss_start, before + held[-1].loss_end) == (a, b)
            assert all(r.loss_start == r.loss_end for r in held[:-1])
        loss = "".join(x for _, r, x in turns if r == "assistant")
        g = got[conv]
        assert (g.n_turns, g.loss_chars, g.formatted_chars, g.n_examples) == (len(turns), len(loss), total, len(wanted))
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        n_examples += len(wanted)
    assert n_examples > 60 and not any(is_example for _, _, is_example in texts)


def test_prefix_targets_read_as_the_segments_do(spark):
    turns = conversations(spark, odd_turns())
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]
    a = chat.example_digests(chat.prefix_targets(turns)).select(cols)
    b = chat.conversation_digests(chat.format_examples(turns)).select(cols)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_prefix_targets_of_an_empty_table(spark):
    made = chat.prefix_targets(conversations(spark, []))
    assert made.count() == 0 and chat.example_digests(made).count() == 0


def test_token_files_of_null_ids_and_a_folder_without_scheme(spark):
    rows = [(None, "b"), (None, "a b"), (4, None), (-3, "x y z"), (4, "x"), (0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    for folder in (tempfile.mkdtemp(prefix="tokens-"), "file:" + tempfile.mkdtemp(prefix="tokens-")):
        at, index = token_files.write_token_files(spark, docs, folder)
        assert at.startswith("file:")
        got = sorted(token_files.token_digests(at, index).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == [None, None, -3, 0, 4, 4]
        assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(6)]
        assert sorted((r.doc_id is None, r.n_tokens) for r in index.collect()) \
            == sorted((r.doc_id is None, r.n_tokens) for r in got)
        whole = token_files.read_token_files(at, index).collect()
        assert sorted(len(r.ids) for r in whole if r.doc_id is None) == [2, 3]
        some = token_files.read_token_files(at, index, spark.createDataFrame([(0,), (None,)], "d long")).collect()
        assert [r.doc_id for r in some] == [0]


def test_token_files_are_read_by_more_than_one_task(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    _, index = token_files.write_token_files(spark, docs.repartition(8))
    tasks = token_files._dealt(token_files._shards(index)).rdd.getNumPartitions()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def earliest_deadline_first(quotas):
    """One period, with a heap of the released blocks."""
    length = sum(quotas)
    release = {}
    for i, q in enumerate(quotas):
        if q:
            release.setdefault(0, []).append((i, 0))
    ready, order = [], []
    for t in range(length):
        for i, j in release.pop(t, []):
            heapq.heappush(ready, (-(-(j + 1) * length // quotas[i]), i, j))
        _, i, j = heapq.heappop(ready)
        order.append(i)
        if j + 1 < quotas[i]:
            release.setdefault(max(t + 1, (j + 1) * length // quotas[i]), []).append((i, j + 1))
    return order


@pytest.mark.parametrize("quotas", [[1], [0, 1], [3, 2, 0, 1], [50, 30, 20], [1, 7, 1, 91, 11], [5000, 1, 2499, 1, 1000]])
def test_fold_equals_a_plain_scheduler(spark, quotas):
    q = f"array({', '.join(f'{x}L' for x in quotas)})"
    got = spark.sql(f"SELECT {q} AS q, {sum(quotas)}L AS len").selectExpr(f"{mixing.EDF} AS slots").first()[0]
    assert got == earliest_deadline_first(quotas)
