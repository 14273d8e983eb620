"""Packing of documents into sequences of a fixed length, best fit first.

A document's ids, closed by the end id, are cut into full windows; what is left at its end
is packed with others.  Pieces are taken from the longest to the shortest, and each goes
to the open sequence with the least room that still holds it.  The room of the open
sequences is kept in a segment tree indexed by remaining capacity, so a place is found in
log2(capacity) steps.

Pieces are dealt by a hash into groups of about ``GROUP_PIECES``, from a bound on the number of
pieces that the tables give; a group is packed by one task.  At most one sequence of a
group stays much open.

Results: a null text counts as empty and is the end id alone; repeated rows are packed as
often as they stand there; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import per_row, text_or_empty
from starmart.llm.token_counts import byte_symbols

CAPACITY = 1024
END_ID = 0
GROUP_PIECES = 65_536

IDS = np.dtype("<u4")


def ranked(made: dict) -> Callable[[str], np.ndarray] | None:
    """``tiktoken`` with the ranks of a vocabulary that ``tokenizers`` wrote.

    It finds the same ids several times faster if the vocabulary is byte-level, has no
    normalizer and its ids rise with the ranks of its merges.  None for any other.
    """
    import public_tokenizers
    import tiktoken

    model, split, added = made["model"], made["pre_tokenizer"] or {}, made["added_tokens"]
    if model["type"] != "BPE" or made["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
        return None
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        return None
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"].get(a + b, -1) for a, b in merges]
    if any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
        return None
    byte = {c: b for b, c in enumerate(byte_symbols())}
    special = {t["content"]: t["id"] for t in added}
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    encoding = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids of a text as the ``tokenizers`` library gives them for a vocabulary file, without
    begin or end; one for each file and Python worker."""
    with open(path, encoding="utf-8") as f:
        found = ranked(json.load(f))
    if found is None:
        return library(path)

    def ids(text: str) -> np.ndarray:
        try:
            return found(text)
        except ValueError:
            # its expression gives up on very long runs of white space
            return library(path)(text)

    return ids


@lru_cache(maxsize=2)
def library(path: str) -> Callable[[str], np.ndarray]:
    """``encoder`` by the ``tokenizers`` library itself."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids)


def windows(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document: ``doc_id, start, length, doc_tokens, ids``.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit numbers.
    """
    kept = docs.select("doc_id", text_or_empty().alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], dtype=IDS).tobytes()
    width = capacity * IDS.itemsize

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        doc_ids = batch.column("doc_id")
        texts = batch.column("text").to_pylist()
        row: list[int] = []
        start: list[int] = []
        total: list[int] = []
        ids: list[bytes] = []
        held = 0

        def made() -> dict:
            return {"doc_id": doc_ids.take(pa.array(row, type=pa.int64())), "start": start, "length": [len(x) // IDS.itemsize for x in ids], "doc_tokens": total, "ids": ids}

        for i, text in enumerate(texts):
            got = encoder(path)(text).astype(IDS).tobytes() + end
            for at in range(0, len(got), width):
                row.append(i)
                start.append(at // IDS.itemsize)
                total.append(len(got) // IDS.itemsize)
                ids.append(got[at : at + width])
            held += len(got)
            if held > 4_000_000:
                yield made()
                row, start, total, ids, held = [], [], [], [], 0
        if row:
            yield made()

    return per_row(kept, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary", rows)


class Rooms:
    """Open sequences by remaining capacity, under a segment tree of maxima."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)  # sequences below a node that are open
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = self.size + room
        while node:
            self.tree[node] += 1
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out the open sequence of least room that holds ``need``: (room, sequence)."""
        tree, node = self.tree, self.size + need
        if not tree[node]:
            # up to the first right neighbour with an open sequence, then down its left edge
            while True:
                if node == 1:
                    return None
                if not node & 1 and tree[node + 1]:
                    node += 1
                    break
                node >>= 1
            while node < self.size:
                node <<= 1
                if not tree[node]:
                    node += 1
        room = node - self.size
        sequence = self.open[room].pop()
        while node:
            tree[node] -= 1
            node >>= 1
        return room, sequence


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; equal lengths keep their order."""
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    rooms, used = Rooms(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = rooms.tightest(need) if need < capacity else None
        room, at = found or (capacity, used)
        used += found is None
        sequence[i], offset[i] = at, capacity - room
        if room > need:
            rooms.add(room - need, at)
    return sequence, offset


def pack(pieces: DataFrame, most: int, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have ``doc_id, start, length``.

    ``most`` is a number that the pieces do not exceed; it gives the number of groups.  More
    columns of ``pieces`` are carried along, so heavy ones are better left out.
    """
    groups = max(1, math.ceil(most / group_pieces))
    # by the row's place, not by its content: rows that repeat an id, or everything, are dealt like others
    key = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def packed(key_values: tuple, group: pa.Table) -> pa.Table:
        # the order of arrival must not matter: a task that runs again packs the same way; what is alike in these is alike to packing
        group = group.sort_by([(c, "ascending") for c in ("doc_id", "start", "length")])
        sequence, offset = best_fit_decreasing(group.column("length").to_numpy(), capacity)
        ids = sequence * groups + key_values[0].as_py()
        return group.drop_columns("_group").append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("_group", key).groupBy("_group")
    return dealt.applyInArrow(packed, f"{schema}, sequence_id long, offset long")


def most_pieces(docs: DataFrame, capacity: int = CAPACITY) -> int:
    """A bound on the pieces of ``docs``: no text has more ids than bytes."""
    n, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    return n + (size or 0) // capacity + 1


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences of packed pieces that still have ``ids``: ``sequence_id, ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
