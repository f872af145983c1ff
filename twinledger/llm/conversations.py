"""Conversation structure repair by weighted CYK interval parsing.

A repaired conversation has role initials ``(s?(ua)+)?``. The automaton of that
language has four states: 0 nothing yet, 1 behind system, 2 behind user, 3 behind
assistant. The repair grammar is in Chomsky normal form with a nonterminal
``N[p, q]`` for each pair of states, which derives the edited rows that lead from p to q:

* ``N[p, q] -> N[p, r] N[r, q]`` for every r;
* ``N[p, q] -> row`` by Keep, Rerole or Delete, with insertions on both sides
  folded in (the insertion closure);
* the start symbol is ``N[0, 0]`` or ``N[0, 3]``.

A cell holds the least (cost, audit) of a span and nonterminal. Cells are combined
bottom-up by span length. Every split of a span gives the same cell, since an edited
span passes some state at every place; so one split a span is enough, spans double
in length, and the work grows in proportion to the rows. Of two audits of equal cost
none is a prefix of the other (they differ in their edits of rows), so the ASCII-least parts make the ASCII-least whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import staged

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: White space of the contract; a row without another character is blank.
BLANKS = " \t\n\x0b\x0c\r"

Cells = dict[tuple[int, int], tuple[int, str]]


def join(left: Cells, right: Cells) -> Cells:
    """The cells of two neighbouring spans together."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            other = right.get((r, q))
            if other is not None:
                cell = (cost + other[0], audit + other[1])
                if (p, q) not in out or cell < out[p, q]:
                    out[p, q] = cell
    return out


@cache
def insertions() -> Cells:
    """The cells of an empty span: the closure of inserted rows."""
    one: Cells = {(p, p): (0, "") for p in range(4)}
    one |= {(p, q): (INSERT, "I") for (p, letter), q in STEP.items() if letter in ROLES}
    closed = one
    while (more := join(closed, one)) != closed:
        closed = more
    return closed


@cache
def terminal(symbol: str) -> Cells:
    """The cells of one row: x must go; s, u, a, o are role initials (o: another), in upper case with a truncated text."""
    options = [((p, p), (DELETE, "D")) for p in range(4)]
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        for (p, letter), q in STEP.items():
            if letter == symbol.lower():
                options.append(((p, q), (extra, "K")))
            if letter in ROLES:
                options.append(((p, q), (REROLE + extra, "R")))
    row: Cells = {}
    for at, cell in options:
        row[at] = min(cell, row.get(at, cell))
    return join(join(insertions(), row), insertions())


@cache
def pair(a: str, b: str) -> Cells:
    """The cells of two rows."""
    return join(terminal(a), terminal(b))


class Spans:
    """Cells of rows that arrive in order; spans of equal length are joined, as the digits of a binary counter."""

    def __init__(self) -> None:
        self._stack: list[tuple[int, Cells]] = []
        self._odd: str | None = None

    def add(self, symbol: str) -> None:
        if self._odd is None:
            self._odd = symbol
            return
        length, cells = 2, pair(self._odd, symbol)
        self._odd = None
        while self._stack and self._stack[-1][0] == length:
            cells = join(self._stack.pop()[1], cells)
            length *= 2
        self._stack.append((length, cells))

    def cells(self) -> Cells:
        """The cells of all rows so far."""
        whole = terminal(self._odd) if self._odd is not None else insertions()
        for _, cells in reversed(self._stack):
            whole = join(cells, whole)
        return whole


def best(cells: Cells) -> tuple[int, str]:
    return min(cells[0, q] for q in FINAL if (0, q) in cells)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage that crc32(conv_id:turn) % 20 names.

    A null in role or text is one space, and so is a null id or turn inside the CRC. A dropped row stays with 0 copies, so
    that its conversation is not forgotten; a repeated one has 2.
    """
    ident, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    name = F.concat_ws(":", F.coalesce(ident.cast("string"), F.lit(" ")), F.coalesce(turn.cast("string"), F.lit(" ")))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    kind = F.crc32(name.cast("binary")) % 20
    return conversations.select(
        ident.alias("conv_id"), turn.alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _order() -> list[Column]:
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


def _facts(rows: DataFrame) -> DataFrame:
    """One row for equal rows: conv_id, turn, role, digest, copies, blank, truncated, first (no earlier row has its role and text).

    Texts are not moved, and the rows of a large conversation or of a repeated text are spread by their digests.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    one = rows.select(
        "conv_id", "turn", "role", "copies", _digest(F.col("text")).alias("digest"), (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    facts = one.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    facts = staged(facts, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("told"), F.col("turn").alias("turn"))
    begins = facts.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("begin"))
    begins = begins.toDF("b_conv", "b_role", "b_digest", "begin")
    same = F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("role") == F.col("b_role")) & (F.col("digest") == F.col("b_digest"))
    return facts.join(begins, same, "left").select(*facts.columns, F.col("begin.turn").eqNullSafe(F.col("turn")).alias("first"))


RUN = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("head", pa.string()), ("tail", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("cells", pa.list_(pa.struct([("p", pa.int8()), ("q", pa.int8()), ("cost", pa.int64()), ("audit", pa.large_string())]))),
])
RUN_DDL = (
    "conv_id long, part int, blank long, duplicate long, truncated long, illegal long, head string, tail string, low long, high long, turns long, "
    "cells array<struct<p: tinyint, q: tinyint, cost: long, audit: string>>"
)


class _Run:
    """What one task sees of one conversation, in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.spans = conv_id, Spans()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.head = self.tail = self.low = self.high = None
        self.turns = 0

    def add(self, turn, initial: str, copies: int, blank: bool, truncated: bool, first: bool) -> None:
        if not copies:
            return
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        for copy in range(copies):
            fault = "blank" if blank else "duplicate" if copy or not first else "truncated" if truncated else None
            if fault:
                self.counts[fault] += 1
            known = initial if initial in ("s", "u", "a") else "o"
            self.spans.add("x" if fault in ("blank", "duplicate") else known.upper() if fault else known)
            if self.tail is not None:
                self.counts["illegal"] += self.tail + initial not in LEGAL
            else:
                self.head = initial
            self.tail = initial

    def row(self, part: int) -> dict:
        cells = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in self.spans.cells().items()]
        return {"conv_id": self.conv_id, "part": part, **self.counts, "head": self.head, "tail": self.tail, "low": self.low, "high": self.high, "turns": self.turns, "cells": cells}


#: Rows and characters of a batch on the way back to Spark.
BATCH_ROWS, BATCH_CHARS = 4096, 1 << 22


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, run, out, size = TaskContext.get().partitionId(), None, [], 0

    def end() -> None:
        nonlocal size
        row = run.row(part)
        out.append(row)
        size += sum(len(c["audit"]) for c in row["cells"])

    for batch in batches:
        for conv, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if run is None or conv != run.conv_id:
                if run is not None:
                    end()
                run = _Run(conv)
                if len(out) >= BATCH_ROWS or size >= BATCH_CHARS:
                    yield pa.RecordBatch.from_pylist(out, RUN)
                    out, size = [], 0
            run.add(*row)
    if run is not None:
        end()
        yield pa.RecordBatch.from_pylist(out, RUN)


SUMMARY = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.large_string())])
SUMMARY_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of a conversation, one for each task that saw it, to its summary."""
    for batch in batches:
        out = []
        for conv, runs in zip(*(column.to_pylist() for column in batch.columns)):
            whole = {"conv_id": conv, "gaps": 0, **{c: sum(r[c] for r in runs) for c in ("blank", "duplicate", "truncated", "illegal")}}
            low = high = tail = None
            turns, cells = 0, insertions()
            for r in runs:
                cells = join(cells, {(c["p"], c["q"]): (c["cost"], c["audit"]) for c in r["cells"]})
                if r["low"] is not None:
                    turns += r["turns"] - (r["low"] == high)
                    low, high = r["low"] if low is None else low, r["high"]
                if r["head"] is not None:
                    whole["illegal"] += tail is not None and tail + r["head"] not in LEGAL
                    tail = r["tail"]
            if low is not None:
                whole["gaps"] = min(high - low + 1 - turns, 2**63 - 1)
            whole["cost"], whole["audit"] = best(cells)
            out.append(whole)
        yield pa.RecordBatch.from_pylist(out, SUMMARY)


def audits(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text, copies): its faults and cheapest repair.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. The rows of a
    conversation are taken by turn (nulls first), rows of one turn by role and SHA-256 of the text. They are
    dealt to tasks by ranges of that order: a conversation of any size passes as many tasks
    as it needs, each of which returns the cells of its run. A conversation
    without a copy of any row has zeros and an empty audit; null ids are one conversation.
    """
    facts = staged(_facts(rows), "faults")
    dealt = facts.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    seen = dealt.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "copies", "blank", "truncated", "first")
    runs = seen.mapInArrow(_runs, RUN_DDL)
    own = F.struct("part", *[c for c in RUN.names if c not in ("conv_id", "part")])
    return runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(own)).alias("runs")).mapInArrow(_merged, SUMMARY_DDL)


REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.large_string())])
REPAIRED_DDL = "conv_id long, place long, edit string, role string, text string"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each conversation behind its audit, edited as the audit says."""
    out, size = [], 0
    conv, audit, at, state, place = None, "", 0, 0, 0

    def put(edit: str, letter: str, role: str, text: str) -> None:
        nonlocal size, state, place
        out.append({"conv_id": conv, "place": place, "edit": edit, "role": role, "text": text})
        size += len(text)
        state, place = STEP[state, letter], place + 1

    def inserted() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            letter = "a" if state == 2 else "u"
            put("I", letter, ROLES[letter], "")
            at += 1

    for batch in batches:
        for ident, told, role, text, copies in zip(*(column.to_pylist() for column in batch.columns)):
            if told is not None:
                inserted()
                conv, audit, at, state, place = ident, told, 0, 0, 0
                inserted()
            for _ in range(copies):
                inserted()
                edit, at = audit[at], at + 1
                if edit != "D":
                    letter = role[:1] if edit == "K" else "a" if state == 2 else "u"
                    put(edit, letter, role if edit == "K" else ROLES[letter], text)
            if len(out) >= BATCH_ROWS or size >= BATCH_CHARS:
                yield pa.RecordBatch.from_pylist(out, REPAIRED)
                out, size = [], 0
    inserted()
    if out:
        yield pa.RecordBatch.from_pylist(out, REPAIRED)


def repaired(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, edit (K, R or I), role, text; deleted rows are gone.

    The rows of one conversation follow each other in order in one partition, read as a stream: no
    conversation is held in memory, however large it is.
    """
    told = rows.filter("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", _digest(F.col("text")).alias("digest"), F.lit(None).cast("string").alias("audit"), "text", "copies")
    heads = summary.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("digest"), "audit", F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"))
    order = [F.asc_nulls_first("conv_id"), F.asc("kind"), *_order()[1:]]
    dealt = told.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", "audit", "role", "text", "copies").mapInArrow(_edited, REPAIRED_DDL)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    digest, conv = None, None
    for batch in batches:
        done = []
        for ident, place, role, text in zip(*(column.to_pylist() for column in batch.columns)):
            if place == 0:
                if digest is not None:
                    done.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                digest, conv = hashlib.sha256(), ident
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if digest is not None:
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": digest.hexdigest()}], schema)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 after damage and repair.

    The hash is of ``role:text`` of the repaired rows, joined by newlines. A null id is a conversation of
    its own; nulls in role and text are one space; an empty table gives no rows; other columns are not read.
    The hash reads a conversation's texts in order, so in one task; everything before it spreads over tasks.
    """
    rows = damaged(conversations)
    summary = staged(audits(rows), "audits")
    hashes = repaired(rows, summary).select("conv_id", "place", "role", "text").mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    hashes = hashes.toDF("h_conv", "hash")
    empty = F.sha2(F.lit(b""), 256)
    whole = summary.join(hashes, F.col("conv_id").eqNullSafe(F.col("h_conv")), "left")
    return whole.select(*summary.columns, F.coalesce("hash", empty).alias("repaired_sha256"))
