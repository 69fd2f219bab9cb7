"""Conversation structure repair over a suffix-shared automaton.

Every conversation becomes a signature: one symbol per row, the class of its role and its
fault.  What a repair still costs after a row depends on the rows that follow and on the
state of the role grammar alone.  So signatures are sorted by their reversal: equal suffixes
become one path of the automaton, whose nodes are made from the end, each once, with the
cost-to-go and the first edit of the best audit in every grammar state.  Sorted order means
that a node off the current path never comes back, so a task holds one path.

Grammar of role initials: ``(s?(ua)+)?``.  Edits and costs: Keep 0, Rerole to user or
assistant 1, Delete 2 (the only one for blank and repeated rows), Insert an empty user or
assistant row 5; a truncated row that stays adds 5.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.llm.common import batch_of, lookup_spread, written

SPACES = " \t\n\x0b\x0c\r"
TIE_CHARS = 64

# Edits by the order of their initials; grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a.
DELETE, INSERT, KEEP, REROLE = range(4)
INITIALS = "DIKR"
_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})   # state after a kept role of that class
_MADE = (2, 2, 3, 2)                                        # state after an inserted or new role
_ROLES = {2: "user", 3: "assistant"}
_AT_END = (0, 10, 5, 0), (KEEP, INSERT, INSERT, KEEP)       # costs and first edits after the last row


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` with the benchmark's damage, chosen by
    crc32(``conv_id:turn``) mod 20: dropped rows stay, marked by ``copies`` = 0."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    space = F.lit(" ")
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    h = F.crc32(F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"),
                         F.coalesce(turn.cast("string"), space)).cast("binary")) % 20
    return turns.select(
        conv.alias("conv_id"), turn.alias("turn"), F.when(h == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies"))


def as_rows(turns: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` as they are, in the shape of ``damaged``."""
    space = F.lit(" ")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), space).alias("role"),
                        F.coalesce(F.col("text").cast("string"), space).alias("text"), F.lit(1).alias("copies"))


def _same(conv: str = "conv_id") -> Column:
    """Digest of a row's conversation, role and text."""
    return F.md5(F.concat(F.coalesce(F.col(conv).cast("string"), F.lit("n")), F.lit(":"),
                          F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))


_ORDER = ["turn", "role", "start", "same"]


def _slim(rows: DataFrame) -> DataFrame:
    """Rows without their texts: what orders them and what their symbols need."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    last = F.substring(trimmed, -1, 1)
    return rows.select("conv_id", "turn", "role", F.substring("text", 1, TIE_CHARS).alias("start"), _same().alias("same"),
                       (trimmed == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"), "copies")


_SIGNED = pa.schema([("conv_id", pa.int64()), ("signature", pa.string()), *((k, pa.int64()) for k in (
    "gaps", "blank", "duplicate", "truncated", "illegal"))])
_LEGAL = {"su", "ua", "au"}


class _Signer:
    """One conversation's signature and counts, from its rows in order."""

    def __init__(self, conv):
        self.conv, self.symbols = conv, []
        self.low = self.high = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turn, self.seen = "", set()

    def row(self, turn, role: str, same: str, blank: bool, truncated: bool, later: bool) -> None:
        if turn != self.turn:
            if turn is not None:
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
            self.turn, self.seen = turn, set()
        initial = role[:1]
        if self.before is not None and self.before + initial not in _LEGAL:
            self.illegal += 1
        self.before = initial
        symbol = initial if initial and initial in "sua" else "x"
        if blank:
            self.blank, symbol = self.blank + 1, "d"
        elif later or same in self.seen:
            self.duplicate, symbol = self.duplicate + 1, "d"
        elif truncated:
            self.truncated, symbol = self.truncated + 1, symbol.upper()
        self.seen = {same} if same not in self.seen else self.seen  # equal rows of a turn are neighbours
        self.symbols.append(symbol)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv, "".join(self.symbols), gaps, self.blank, self.duplicate, self.truncated, self.illegal


def signatures(rows: DataFrame) -> DataFrame:
    """``conv_id, signature, gaps, blank, duplicate, truncated, illegal`` of every conversation
    of rows from ``damaged`` or ``as_rows``; one whose rows are all dropped has the empty signature.

    A row repeats an earlier one where its digest's first turn, a combinable minimum, is
    before its own, or where an equal row of the same turn precedes it.  Then rows stream
    through a task in order, without texts, one symbol kept for each.
    """
    slim = _slim(rows)
    first = slim.filter("copies > 0").groupBy("same").agg(F.min(F.struct("turn")).alias("first"))
    slim = lookup_spread(slim, first, ["same"], ["turn", "conv_id"])
    later = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False)).alias("later")

    def run(batches):
        none = object()
        conv, signer = none, None
        for batch in batches:
            out = []
            for c, turn, role, same, blank, truncated, copies, later in zip(*(batch.column(k).to_pylist() for k in range(8))):
                if conv is none or c != conv:
                    if signer:
                        out.append(signer.result())
                    conv, signer = c, _Signer(c)
                for _ in range(copies):
                    signer.row(turn, role, same, blank, truncated, later)
            if out:
                yield batch_of(_SIGNED, list(zip(*out)))
        if signer:
            yield batch_of(_SIGNED, list(zip(*[signer.result()])))

    return (slim.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
            .select("conv_id", "turn", "role", "same", "blank", "truncated", "copies", later)
            .mapInArrow(run, "conv_id long, signature string, gaps long, blank long, duplicate long, truncated long, illegal long"))


class SuffixAutomaton:
    """The path of one suffix: node k stands for the last k symbols; 33 bytes a node."""

    def __init__(self):
        self.symbols = ""                       # reversed: symbol of node k at k - 1
        self.costs = tuple(array("q", [c]) for c in _AT_END[0])
        self.first = bytearray([self._pack(_AT_END[1])])
        self.made = 0                           # nodes ever made

    @staticmethod
    def _pack(edits) -> int:
        return edits[0] | edits[1] << 2 | edits[2] << 4 | edits[3] << 6

    def _push(self, symbol: str) -> None:
        """Cost and first edit in each grammar state of the node (symbol, node before)."""
        last = [c[-1] for c in self.costs]
        best = [(last[q] + 2, DELETE) for q in range(4)]
        if symbol != "d":
            kind, extra = symbol.lower(), 5 * symbol.isupper()
            for q in range(4):
                best[q] = min(best[q], (last[_MADE[q]] + 1 + extra, REROLE))
                if kind in _KEPT[q]:
                    best[q] = min(best[q], (last[_KEPT[q][kind]] + extra, KEEP))
        for q in (2, 3, 2, 0, 1):               # insertions lead to states 2 and 3 of the same node
            best[q] = min(best[q], (best[_MADE[q]][0] + 5, INSERT))
        for c, (cost, _) in zip(self.costs, best):
            c.append(cost)
        self.first.append(self._pack([e for _, e in best]))
        self.made += 1

    def repair(self, signature: str) -> tuple[int, str]:
        """Cost and audit; signatures must come in the order of their reversals."""
        back = signature[::-1]
        same, most = 0, min(len(back), len(self.symbols))
        if back[:most] == self.symbols[:most]:
            same = most
        else:
            while back[same] == self.symbols[same]:
                same += 1
        for c in self.costs:
            del c[same + 1:]
        del self.first[same + 1:]
        for symbol in back[same:]:
            self._push(symbol)
        self.symbols = back
        audit, state, node = [], 0, len(back)
        while node or state in (1, 2):
            edit = self.first[node] >> 2 * state & 3
            audit.append(INITIALS[edit])
            if edit == KEEP:
                state = _KEPT[state][back[node - 1].lower()]
            elif edit != DELETE:
                state = _MADE[state]
            node -= edit != INSERT
        return self.costs[0][-1], "".join(audit)


def cheapest_repairs(signatures: DataFrame) -> DataFrame:
    """``signature, cost, audit`` of every distinct signature (one column, not null)."""
    schema = pa.schema([("signature", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])

    def run(batches):
        automaton = SuffixAutomaton()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            if texts:
                costs, audits = zip(*map(automaton.repair, texts))
                yield batch_of(schema, [texts, costs, audits])

    back = F.reverse(signatures.columns[0])
    return (signatures.distinct().repartitionByRange(back).sortWithinPartitions(back)
            .mapInArrow(run, "signature string, cost long, audit string"))


class _Repairer:
    """SHA-256 of one conversation's repaired rows, from its audit and its rows in order."""

    def __init__(self, plan: tuple):
        self.plan, self.audit = plan, plan[-1]
        self.at = self.state = 0
        self.sha, self.any = hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + f"{role}:{text}").encode())
        self.any = True

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state, self.at = _MADE[self.state], self.at + 1
            self._put(_ROLES[self.state], "")

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _KEPT[self.state][role[:1]]
            self._put(role, text)
        elif edit == "R":
            self.state = _MADE[self.state]
            self._put(_ROLES[self.state], text)

    def result(self) -> tuple:
        self.inserts()
        if self.at != len(self.audit):
            raise ValueError(f"conversation {self.plan[0]}: the audit has more edits than rows")
        return (*self.plan, self.sha.hexdigest())


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Repair of every conversation of rows from ``damaged`` or ``as_rows``: ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    A conversation's rows are ordered by turn (nulls first), role, the first 64 code points of
    the text and the digest of role and text; repeated rows stay and count as duplicates.
    Rows of a null conv_id form one conversation.  One without rows gets zeros, the empty
    audit and the hash of nothing.  Other columns are not read; an empty table gives no row.
    Signature and audit are one byte per row of a conversation, the only things held of it.
    """
    signed = written(spark, signatures(rows), "turn-signatures")
    repairs = written(spark, cheapest_repairs(signed.select("signature")), "turn-repairs")
    key = F.md5(F.col("signature").cast("binary")).alias("key")
    plans = lookup_spread(signed.select("*", key), repairs.select(key, "cost", "audit"), ["key"], ["conv_id"])
    plans = plans.select("conv_id", *COUNTS, "audit")
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def run(batches):
        repairer = None
        for batch in batches:
            out = []
            *plan, copies, role, text = (batch.column(k).to_pylist() for k in range(batch.num_columns))
            for p, n, r, t in zip(zip(*plan), copies, role, text):
                if n is None:                   # a plan comes before the rows of its conversation
                    if repairer:
                        out.append(repairer.result())
                    repairer = _Repairer(p)
                else:
                    for _ in range(n):
                        repairer.row(r, t)
            if out:
                yield batch_of(schema, list(zip(*out)))
        if repairer:
            yield batch_of(schema, list(zip(*[repairer.result()])))

    texts = rows.filter("copies > 0").select("conv_id", "turn", "role", F.substring("text", 1, TIE_CHARS).alias("start"),
                                             _same().alias("same"), "copies", "text")
    both = plans.unionByName(texts, allowMissingColumns=True)
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("copies").isNotNull(), *_ORDER)
            .select("conv_id", *COUNTS, "audit", "copies", "role", "text")
            .mapInArrow(run, "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"))
