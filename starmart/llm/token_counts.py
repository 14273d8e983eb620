"""Token counts by byte-pair merging, without making any token.

A text is split as the vocabulary file says (its own pre-tokenizer, its special strings
taken out first).  In each piece the adjacent pair of lowest rank is merged again and again:
the pairs wait in a heap, the symbols stand in a linked list.  The count is the number of
symbols at the start minus the number of merges.

Results: a null or empty text has 0 tokens; a special string inside a text counts one;
repeated rows and null ids are kept as they are; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import Remembered, per_row, text_or_empty

# Pieces that a worker remembers, twice over.
REMEMBERED = 500_000

# Texts of these characters, whose classes no edition of Unicode changes, are split by the
# pattern below just as the library splits them; other texts are split by the library.
LETTERS, NUMBERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
SETTLED = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f]*")
PIECE = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")
PLACE = (1 << 32) - 1


def merge_count(symbols: str | list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many tokens are left of ``symbols`` when no ranked pair is adjacent any more.

    Of equal ranks the leftmost pair goes first.
    """
    piece: list[str | None] = list(symbols)
    n = len(piece)
    if n < 2:
        return n
    rank_of = ranks.get
    # an entry is a rank and, in its low bits, the place of the pair's left symbol
    heap = [r << 32 | i for i, pair in enumerate(zip(piece, piece[1:], strict=False)) if (r := rank_of(pair)) is not None]
    if not heap:
        return n
    heapq.heapify(heap)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    push, pop = heapq.heappush, heapq.heappop
    merges = 0
    while heap:
        entry = pop(heap)
        i = entry & PLACE
        left, j = piece[i], after[i]
        if left is None or j >= n or rank_of((left, piece[j])) != entry >> 32:
            continue  # one of the two has been merged since
        piece[i] = joined = left + piece[j]
        piece[j] = None
        merges += 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := rank_of((joined, piece[k]))) is not None:
                push(heap, r << 32 | i)
        if (h := before[i]) >= 0 and (r := rank_of((piece[h], joined))) is not None:
            push(heap, r << 32 | h)
    return n - merges


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable ASCII and Latin-1 stand for themselves, the others are moved above them in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(moved)) for b in range(256)]


class Counter:
    """Counts tokens as the ``tokenizers`` library would for one vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        if made["model"]["type"] != "BPE" or made["normalizer"] is not None or made["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("only byte-level byte-pair vocabularies without a normalizer can be counted by merging")
        merges = (m if isinstance(m, list) else m.split(" ") for m in made["model"]["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(merges)}
        specials = [t["content"] for t in made["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.symbols = dict(enumerate(byte_symbols()))
        self.pieces = Remembered(self._piece, REMEMBERED)
        self.others = Remembered(lambda symbols: merge_count(symbols, self.ranks), REMEMBERED // 4)

    def _piece(self, piece: str) -> int:
        return merge_count(piece.encode("utf-8").decode("latin-1").translate(self.symbols), self.ranks)

    def part(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if SETTLED.fullmatch(text):
            return sum(map(self.pieces.__getitem__, PIECE.findall(text)))
        return sum(self.others[symbols] for symbols, _ in self.split(text))

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.part(text) if text else 0
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.part(part) for part in parts if part)


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """One for each file and Python worker."""
    return Counter(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row's whole text.

    ``path`` is the vocabulary file, which every machine has.
    """
    kept = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = kept.schema["id"].dataType.simpleString()

    def rows(batch: pa.RecordBatch) -> dict:
        count = counter(path).count
        return {"id": batch.column("id"), "n_bytes": [len(t.as_buffer() or b"") if t.is_valid else 0 for t in batch.column("text")], "n_tokens": [count(t) for t in batch.column("text").to_pylist()]}

    return per_row(kept, f"id {kind}, n_bytes long, n_tokens long", rows).withColumnRenamed("id", id_col)
