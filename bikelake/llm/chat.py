"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one training example: all turns before it are its context, and
only its reply carries loss.  ``prefix_targets`` writes every example out, one row per turn
that it holds, so that no text of a long conversation is ever put together in a task.

The formatted example of a turn is a prefix of the formatted conversation.  Where the
examples themselves are not needed, ``format_examples`` keeps the same in less space, as
*segments*: the text an example adds to the one before it, the span of its reply, and the
characters of context in front; ``expand`` puts the examples together from them.

Template: ``<|im_start|>`` role line feed text ``<|im_end|>`` line feed.  Inside roles and
texts every ``<|`` is escaped by a backslash between the two characters (one more where there
are already some), so control strings cannot be forged and unescaping is exact.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikelake.llm.common import batch_of

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)
SEGMENT_CHARS = 1 << 20  # context without a reply is written out in pieces of about this size
ROLE_BREAK = "\\n"


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def render_role(role: str) -> str:
    """Roles are one line in the template: backslashes and line feeds are escaped too."""
    return escape(role.replace("\\", "\\\\").replace("\n", ROLE_BREAK))


def read_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _sorted_turns(turns: DataFrame) -> DataFrame:
    return (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))


def _escaped(c: Column) -> Column:
    """``escape`` as an expression."""
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def prefix_targets(turns: DataFrame) -> DataFrame:
    """Every assistant turn as an example of its own, in full: ``conv_id, example, is_example,
    is_last, place, is_target, text, loss_start, loss_end``.

    One row per example and turn in it: ``place`` counts the conversation's turns from 0, and
    an example's text is that of its rows by ``place``.  Its last row is the target, the only one
    with a loss span (relative to ``text``).  ``is_last`` marks the example with the longest
    context.  Turns that no reply follows belong to no example; they have rows of their own
    (``is_example`` false, ``is_last`` true).

    Nulls: a null role or text counts as empty, a null turn sorts first, turns of a null
    conv_id form one conversation of their own.  Repeated rows stay, tied turns are ordered
    by role and text; columns of other names are ignored.  An empty table gives no row.
    Turns are numbered by one shuffle (the window's rows can spill) and multiplied row by row,
    so memory is bounded by a turn; the rows grow with the square of a conversation's replies,
    as the examples do.  Copies of a turn lie next to each other and compress well.
    """
    head = F.concat(F.lit(START), _escaped(F.replace(F.replace("role", F.lit("\\"), F.lit("\\\\")),
                                                     F.lit("\n"), F.lit(ROLE_BREAK))), F.lit("\n"))
    whole = Window.partitionBy("conv_id")
    by_turn = whole.orderBy("turn", "role", "text")
    reply = (F.col("role") == "assistant").cast("long")
    t = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                      F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
         .withColumn("place", F.row_number().over(by_turn).cast("long") - 1)
         .withColumn("first", F.sum(reply).over(by_turn.rowsBetween(Window.unboundedPreceding, 0)) - reply)
         .withColumn("replies", F.sum(reply).over(whole))
         .select("conv_id", "place", "first", "replies", (reply == 1).alias("reply"), head.alias("head"),
                 _escaped(F.col("text")).alias("body")))
    held = F.when(F.col("first") < F.col("replies"), F.sequence("first", F.col("replies") - 1)).otherwise(F.array("replies"))
    target = F.col("reply") & (F.col("example") == F.col("first"))
    start = F.when(target, F.length("head")).otherwise(0).cast("long")
    return (t.withColumn("example", F.explode(held))
            .select("conv_id", "example", (F.col("example") < F.col("replies")).alias("is_example"),
                    (F.col("example") >= F.col("replies") - 1).alias("is_last"), "place", target.alias("is_target"),
                    F.concat("head", "body", F.lit(END + "\n")).alias("text"), start.alias("loss_start"),
                    (start + F.when(target, F.length("body")).otherwise(0)).alias("loss_end")))


def example_digests(examples: DataFrame) -> DataFrame:
    """Read written examples back: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_examples``.

    Turns are parsed from the template and unescaped: those of the example with the longest
    context, and those that no reply follows.  The loss text is what the spans of all examples
    mark.  ``formatted_chars`` is the total length of all examples.  A digest of one
    conversation is sequential by nature; it runs over the rows as they arrive.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string())])

    def run(batches):
        none = object()
        conv, turns, n, loss, chars = none, None, 0, None, 0
        for batch in batches:
            rows = []
            for c, last, text, a, b in zip(*(batch.column(k).to_pylist() for k in (
                    "conv_id", "is_last", "text", "loss_start", "loss_end"))):
                if c != conv or conv is none:
                    if conv is not none:
                        rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest()))
                    conv, turns, n, loss, chars = c, hashlib.sha256(), 0, hashlib.sha256(), 0
                if last:
                    m = _TURN.fullmatch(text)
                    if m is None:
                        raise ValueError(f"conversation {c}: not one turn in the template")
                    turns.update(f"{read_role(m[1])}\n{unescape(m[2])}\n".encode())
                    n += 1
                reply = unescape(text[a:b])
                loss.update(reply.encode())
                chars += len(reply)
            if rows:
                yield batch_of(schema, list(zip(*rows)))
        if conv is not none:
            yield batch_of(schema, [[conv], [n], [turns.hexdigest()], [chars], [loss.hexdigest()]])

    read = (examples.filter("is_last OR is_target").select("conv_id", "place", "is_last", "text", "loss_start", "loss_end")
            .repartition("conv_id").sortWithinPartitions("conv_id", "place")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string"))
    sizes = examples.groupBy(F.col("conv_id").alias("conv")).agg(
        F.sum(F.when(F.col("is_example"), F.length("text")).otherwise(0)).alias("formatted_chars"),
        F.count_if("is_target").alias("n_examples"))
    return read.join(sizes, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")


def format_examples(turns: DataFrame) -> DataFrame:
    """Segments of all conversations: ``conv_id, example, is_example, context_chars, text,
    loss_start, loss_end``.

    ``example`` counts a conversation's segments from 0; ``text`` is what the segment adds;
    the loss span is relative to ``text`` and empty for context that no reply follows
    (``is_example`` false).  Example k in full is the concatenation of the segments up to k.

    Nulls: a null role or text counts as empty, a null turn sorts first, turns of a null
    conv_id form one conversation of their own.  Repeated rows stay, tied turns are ordered
    by role and text.  An empty table gives no segment.  Turns stream through the task in
    order: no task holds more than one segment of a conversation.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("is_example", pa.bool_()),
                        ("context_chars", pa.int64()), ("text", pa.large_string()),
                        ("loss_start", pa.int64()), ("loss_end", pa.int64())])

    def run(batches):
        none = object()
        conv, example, before, held, size = none, 0, 0, [], 0
        out, n = ([], [], [], [], [], [], []), 0

        def put(loss_start, loss_end, is_example):
            nonlocal example, before, held, size, n
            text = "".join(held)
            for c, v in zip(out, (conv, example, is_example, before, text, loss_start, loss_end)):
                c.append(v)
            example, before, held, n = example + 1, before + size, [], n + size
            size = 0

        for batch in batches:
            for c, role, text in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(),
                                     batch.column("text").to_pylist()):
                if c != conv or conv is none:
                    if held:
                        put(size, size, False)
                    conv, example, before = c, 0, 0
                head, body = f"{START}{render_role(role)}\n", escape(text)
                held += [head, body, END, "\n"]
                start = size + len(head)
                size = start + len(body) + len(END) + 1
                if role == "assistant":
                    put(start, start + len(body), True)
                elif size >= SEGMENT_CHARS:
                    put(size, size, False)
                if n >= 4 << 20:
                    yield batch_of(schema, out)
                    out, n = ([], [], [], [], [], [], []), 0
        if held:
            put(size, size, False)
        if out[0]:
            yield batch_of(schema, out)

    return _sorted_turns(turns).mapInArrow(
        run, "conv_id long, example long, is_example boolean, context_chars long, text string, "
             "loss_start long, loss_end long")


def expand(segments: DataFrame) -> DataFrame:
    """Every example in full: ``conv_id, example, text, loss_start, loss_end``; the text is
    the whole context and the reply, the span is that of the reply in it."""
    w = Window.partitionBy("conv_id").orderBy("example")
    return (segments.withColumn("full", F.array_join(F.collect_list("text").over(w), ""))
            .filter("is_example")
            .select("conv_id", "example", F.col("full").alias("text"),
                    (F.col("context_chars") + F.col("loss_start")).alias("loss_start"),
                    (F.col("context_chars") + F.col("loss_end")).alias("loss_end")))


def conversation_digests(segments: DataFrame) -> DataFrame:
    """Read the written segments back: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_examples``.

    Turns are parsed from the template and unescaped; the loss text is what the spans mark.
    ``formatted_chars`` is the total length of the examples in full.  A digest of one
    conversation is sequential by nature; it runs over the segments as they arrive.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                        ("formatted_chars", pa.int64()), ("n_examples", pa.int64())])

    def run(batches):
        none = object()
        conv, state = none, None

        def row():
            turns, n, loss, chars, formatted, examples = state
            return [conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, examples]

        for batch in batches:
            rows = []
            for c, is_example, before, text, a, b in zip(*(batch.column(k).to_pylist() for k in (
                    "conv_id", "is_example", "context_chars", "text", "loss_start", "loss_end"))):
                if c != conv or conv is none:
                    if conv is not none:
                        rows.append(row())
                    conv, state = c, [hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                at = 0
                for m in _TURN.finditer(text):
                    if m.start() != at:
                        raise ValueError(f"conversation {c}: text between turns")
                    at = m.end()
                    state[0].update(f"{read_role(m[1])}\n{unescape(m[2])}\n".encode())
                    state[1] += 1
                if at != len(text):
                    raise ValueError(f"conversation {c}: text after the last turn")
                if is_example:
                    loss = unescape(text[a:b])
                    state[2].update(loss.encode())
                    state[3] += len(loss)
                    state[4] += before + len(text)
                    state[5] += 1
            if rows:
                yield batch_of(schema, list(zip(*rows)))
        if conv is not none:
            yield batch_of(schema, list(zip(*[row()])))

    return (segments.repartition("conv_id").sortWithinPartitions("conv_id", "example").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, n_examples long"))
