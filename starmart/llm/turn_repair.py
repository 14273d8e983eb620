"""Cheapest repair of the turns of conversations, by block tables of normalised cost vectors.

Conversations are to read ``(s?(ua)+)?`` in the initials of their roles (a system turn at most, then
user and assistant by turns).  A row is kept (0), given the role that is due (2) or deleted (3, the only
choice for blank and repeated rows); rows of the due role with an empty text can be inserted
anywhere (2); a truncated row that stays costs 1 more.

The state is what was kept last.  The costs of what is still to do, by state, are a vector; its
differences are bounded, so less its minimum it is one of a few dozen.  ``BlockTables`` holds for each of
them and every block of ``BLOCK`` symbols the vector before the block and what the minimum grows by.
A conversation is read from its end, a lookup for a block.  Then it is read from its start: each
block is expanded backward from the vector behind it, and the walk takes at every step the first
edit, in ASCII order, that is on a cheapest way.  As the costs are those of the rest, that is the
least of all cheapest edit strings.

Rows of a conversation meet once, sorted on disk; both readings are streams that hold one block.  The
digest of the repaired conversation is one hash over its whole text, so one task has to
read a conversation, however long; its memory does not grow with it but for the edit string itself.

Results: a null role or text is one blank.  Rows are taken by turn (nulls first), then role, then text.
A null ``conv_id`` is a conversation like others.  A conversation without rows after the damage has zeros, no
edits and the digest of nothing.  An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import arrow_schema, bounded_batches

BLOCK = 4
SPACE = r"\x20\x09-\x0D"

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# States: nothing kept, a system turn, a user turn, an assistant turn.  What may follow, and what is due.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
DUE = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
AT_END = (0, 2 * INSERT, INSERT, 0)

# Symbols: a kind of role, with 4 added if truncated; 8 must go.
KINDS = "sua?"
MUST_GO = 8
SYMBOLS = 9


def symbol(initial: str, truncated: bool) -> int:
    return max(KINDS.find(initial or "?"), 3 if initial not in tuple("sua") else 0) + 4 * truncated


def before(costs: tuple[int, ...], sign: int) -> tuple[int, ...]:
    """The costs of the rest before a row, by state, from those behind it."""
    if sign == MUST_GO:
        taken = [DELETE + c for c in costs]
    else:
        kind, cut = KINDS[sign % 4], TRUNCATED * (sign // 4)
        taken = [min(DELETE + costs[q], REROLE + cut + costs[DUE[q]]) for q in range(4)]
        for (q, role), after in FOLLOWS.items():
            if role == kind:
                taken[q] = min(taken[q], KEEP + cut + costs[after])
    # at most three insertions in a row can help: from nothing to a user turn, an assistant turn, a user turn
    for _ in range(3):
        taken = [min(taken[q], INSERT + taken[DUE[q]]) for q in range(4)]
    return tuple(taken)


class BlockTables:
    """Transitions of normalised cost vectors over single symbols and over every block of them.

    Vectors are numbered; a block's number has its first symbol as the highest digit to base 9.
    """

    def __init__(self, length: int = BLOCK) -> None:
        self.length = length
        self.vectors, number, single = [AT_END], {AT_END: 0}, []
        for vector in self.vectors:  # grows while it is read: the vectors that can be met
            for sign in range(SYMBOLS):
                made = before(vector, sign)
                least = min(made)
                normal = tuple(c - least for c in made)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                single.append((number[normal], least))
        one = np.array(single, dtype=np.int32).reshape(-1, SYMBOLS, 2)
        self.next_one, self.grown_one = one[..., 0], one[..., 1]
        self.next, self.grown = self.next_one, self.grown_one
        for _ in range(length - 1):  # the block's last symbol comes first, as blocks are read from their end
            further, more = self.next_one[self.next], self.grown_one[self.next] + self.grown[..., None]
            shape = (len(self.vectors), -1)
            self.next, self.grown = further.transpose(0, 2, 1).reshape(shape), more.transpose(0, 2, 1).reshape(shape)

    def expanded(self, behind: int, signs: list[int]) -> list[tuple[int, ...]]:
        """True differences of costs at each place of a block, before its first symbol to behind its last."""
        places, vector, grown = [self.vectors[behind]], behind, 0
        for sign in reversed(signs):
            grown += int(self.grown_one[vector, sign])
            vector = int(self.next_one[vector, sign])
            places.append(tuple(c + grown for c in self.vectors[vector]))
        return places[::-1]


@cache
def tables() -> BlockTables:
    return BlockTables()


def walk(state: int, signs: list[int], places: list[tuple[int, ...]]) -> Iterator[tuple[int, str, int, int]]:
    """Edits of a block as (row in it, initial, state after, cost), the first in ASCII order at each step."""
    for row, sign in enumerate(signs):
        while True:
            here, behind = places[row], places[row + 1]
            kind, cut = KINDS[sign % 4], TRUNCATED * (sign // 4)
            if here[state] == DELETE + behind[state]:
                yield row, "D", state, DELETE
                break
            if here[state] == INSERT + here[DUE[state]]:
                state = DUE[state]
                yield row, "I", state, INSERT
                continue
            if sign != MUST_GO and (state, kind) in FOLLOWS and here[state] == KEEP + cut + behind[FOLLOWS[state, kind]]:
                state = FOLLOWS[state, kind]
                yield row, "K", state, KEEP + cut
            else:
                state = DUE[state]
                yield row, "R", state, REROLE + cut
            break


def closing(state: int) -> Iterator[tuple[str, int, int]]:
    """Insertions behind the last row."""
    while AT_END[state]:
        state = DUE[state]
        yield "I", state, INSERT


# Damage and faults ------------------------------------------------------


def or_blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows after the planned damage.

    A dropped row stays as one with ``gone``, so that its conversation is not lost.
    """
    code = F.crc32(F.concat(or_blank("conv_id"), F.lit(":"), or_blank("turn")).cast("binary")) % 20
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    coded = rows.select("conv_id", "turn", or_blank("role").alias("role"), or_blank("text").alias("text"), code.alias("code"))
    return coded.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("code") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (as ``damaged`` gives them) dealt by conversation, with ``fault``: blank, duplicate, truncated or null."""
    spread = rows.repartition("conv_id").withColumn("digest", F.sha2("text", 256))
    turn = F.row_number().over(Window.partitionBy("conv_id", "role", "digest", "gone").orderBy(F.col("turn").asc_nulls_first()))
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    cut = ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    fault = F.when(blank, "blank").when(F.col("seen") > 1, "duplicate").when(cut, "truncated")
    return spread.withColumn("seen", turn).withColumn("fault", F.when(~F.col("gone"), fault)).drop("seen", "digest")


# The two readings -------------------------------------------------------


def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """(whether a conversation starts, row) of sorted batches, row by row."""
    last, first = None, True
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            yield first or row[0] != last, row
            last, first = row[0], False


def repaired(rows: DataFrame) -> DataFrame:
    """The audit of every conversation of ``rows`` (as ``faults`` gives them)."""
    spark = rows.sparkSession
    bounded_batches(spark)
    kind = rows.schema["conv_id"].dataType.simpleString()
    turn_kind = rows.schema["turn"].dataType.simpleString()
    later = F.coalesce(F.col("fault") == "duplicate", F.lit(False))  # of rows that are alike
    spot = [F.col("conv_id"), F.col("gone"), F.col("turn"), F.col("role"), F.col("text"), later]
    backward = rows.sortWithinPartitions(*[c.desc_nulls_last() for c in spot])
    middle = f"conv_id {kind}, turn {turn_kind}, role string, text string, gone boolean, fault string, block long, behind int"
    fields = arrow_schema(spark, middle)

    def number_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, vector, at, code, behind, conv, first = tables(), 0, 0, 0, 0, None, True
        for batch in batches:
            columns = [batch.column(n) for n in ("conv_id", "role", "gone", "fault")]
            blocks, vectors = [], []
            for conv_id, role, gone, fault in zip(*(c.to_pylist() for c in columns), strict=True):
                if first or conv_id != conv:
                    conv, first, vector, at, code = conv_id, False, 0, 0, 0
                if gone:
                    blocks.append(-1)
                    vectors.append(0)
                    continue
                if at % made.length == 0:
                    vector, code = (int(made.next[vector, code]), 0) if at else (0, 0)
                # rows come last to first: a block's last symbol is its lowest digit
                sign = MUST_GO if fault in ("blank", "duplicate") else symbol(role[:1], fault == "truncated")
                code += sign * SYMBOLS ** (at % made.length)
                blocks.append(at // made.length)
                vectors.append(vector)
                at += 1
            arrays = [batch.column(n) for n in ("conv_id", "turn", "role", "text", "gone", "fault")]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(blocks, pa.int64()), pa.array(vectors, pa.int32())], schema=fields)

    numbered = backward.mapInArrow(number_blocks, middle)
    forward = numbered.sortWithinPartitions(*[c.asc_nulls_first() for c in spot])
    names = ["conv_id", "turn", "role", "text", "gone", "fault", "block", "behind"]
    result = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    out_fields = arrow_schema(spark, result)

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, done, size = None, [], 0

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(done, schema=out_fields)

        for starts, row in runs(batches, names):
            if starts:
                if conversation is not None:
                    done.append(conversation.finished())
                    size += len(done[-1]["audit"])
                    if len(done) >= 1000 or size > 1 << 20:
                        yield flushed()
                        done, size = [], 0
                conversation = Conversation(row[0])
            if not row[4]:
                conversation.add(*row)
        if conversation is not None:
            done.append(conversation.finished())
        if done:
            yield flushed()

    return forward.mapInArrow(audit, result)


class Conversation:
    """What is known of a conversation while its rows are read from its start: one block, counts, a running hash."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.state, self.cost, self.edits, self.block = conv_id, NOTHING, 0, [], []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.least = self.most = self.initial = None
        self.turns, self.hash, self.any = 0, hashlib.sha256(), False

    def add(self, _id: object, turn: int | None, role: str, text: str, _gone: bool, fault: str | None, block: int, behind: int) -> None:
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = role[:1]
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most, self.turns = turn, self.turns + 1
        if self.block and self.block[0][0] != block:
            self.expand()
        self.block.append((block, behind, role, text, fault))

    def expand(self) -> None:
        signs = [MUST_GO if r[4] in ("blank", "duplicate") else symbol(r[2][:1], r[4] == "truncated") for r in self.block]
        for row, edit, self.state, cost in walk(self.state, signs, tables().expanded(self.block[0][1], signs)):
            self.edits.append(edit)
            self.cost += cost
            _, _, role, text, _ = self.block[row]
            if edit != "D":
                self.put(role if edit == "K" else ROLES[self.state], "" if edit == "I" else text)
        self.block = []

    def put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + f"{role}:{text}").encode())
        self.any = True

    def finished(self) -> dict:
        if self.block:
            self.expand()
        for edit, self.state, cost in closing(self.state):
            self.edits.append(edit)
            self.cost += cost
            self.put(ROLES[self.state], "")
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": self.cost, "audit": "".join(self.edits), "repaired_sha256": self.hash.hexdigest()}


def repair(conversations: DataFrame) -> DataFrame:
    """Damage, faults and cheapest repair of every conversation."""
    return repaired(faults(damaged(conversations)))
