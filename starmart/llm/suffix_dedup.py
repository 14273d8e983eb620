"""Removal of repeated passages by a hash-compared suffix sort.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier: in a row of
smaller id, or further left in its own row.

Equal strings have to meet, and no group may be unbounded, so windows (the strings of
``LENGTH`` bytes) are dealt by content.  A window's key is the least hash of the grams in it,
which depends on its bytes alone; windows in a row that share a key are a run, about 35
windows long, and only runs travel:

1. Runs whose key stands alone are done.  Of runs with equal content all but the first are
   repeats as a whole, found by grouped minima.
2. What is left, first runs whose key has other contents too, fetches its bytes and is sorted:
   suffixes go into buckets of equal first word, each bucket is merge-sorted, and two suffixes are
   compared by their common extension, found by binary search over prefix polynomial
   hashes, of which the lengths that the search asks for are made once for every place.
   Suffixes that a merge finds equal go through later merges as one.  Neighbours that agree
   over ``LENGTH`` bytes are verified byte by byte, and so is the order; a bucket that a
   collision misled is sorted anew by its bytes.
3. A key with many different contents would make a large group.  Its windows are dealt singly, by
   a 128-bit digest of their bytes, and again all but the first of equal ones are repeats.

A run's content is known by its 64-bit key and a 64-bit hash of another kind, which must
both agree.

Results: a null text counts as empty and, like any text under ``LENGTH`` bytes, loses nothing.  A
row that repeats an earlier row's id counts as later: rows with one id stand in the order of
their texts' hashes, rows alike in both in any order, since their results are the same multiset.
Rows with a null id come last.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import freeing_shuffles, per_row, text_or_empty
from starmart.operators.keys import dense_ids
from starmart.sources.scratch import stored

LENGTH = 100
GRAM = 32
RUN_WINDOWS = 2048
KEY_CONTENTS = 1000
SHARD_BYTES = 2 << 20
PLACES_AT_ONCE = 1 << 16

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
CODEC = "zstd"


_known: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """At least ``n`` powers of the base and of its inverse, modulo 2**64, kept by the worker."""
    if not _known or len(_known[0]) < n:
        _known.clear()
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(1 << max(16, n.bit_length()), base, dtype=np.uint64)
            p[0] = 1
            _known.append(np.cumprod(p, dtype=np.uint64))
    return _known


class Hashed:
    """Prefix polynomial hashes of a byte string."""

    def __init__(self, raw: bytes) -> None:
        self.bytes = np.frombuffer(raw, dtype=np.uint8)
        n = len(self.bytes)
        powers, self.inverse = _powers(n + 1)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        terms = self.bytes.astype(np.uint64)
        terms += np.uint64(1)
        terms *= powers[:n]
        np.cumsum(terms, out=self.prefix[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]

    def grams(self, k: int) -> np.ndarray:
        """Of every k bytes, mixed so that their order is like chance."""
        x = (self.prefix[k:] - self.prefix[:-k]) * self.inverse[: len(self.bytes) - k + 1]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        return x


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    to_left = np.minimum.accumulate(blocks, axis=1).ravel()
    to_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(to_right[:count], to_left[width - 1 : width - 1 + count])


def runs_of(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``key, content, first, last, again`` of the runs of a text, by window starts.

    ``again``: the key's gram stands more than once in the text, so the run may repeat itself.
    """
    if len(raw) < length:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none.astype(bool)
    hashes = Hashed(raw).grams(gram)
    keys = window_minima(hashes, length - gram + 1)
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    first, last = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)])) - 1
    if int((last - first).max()) >= RUN_WINDOWS:
        parts = [np.arange(a, b + 1, RUN_WINDOWS) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        first = np.concatenate(parts)
        last = np.concatenate((first[1:], [len(keys)])) - 1
    key = keys[first]
    ordered = np.sort(hashes)
    again = np.searchsorted(ordered, key, "right") - np.searchsorted(ordered, key, "left") > 1
    digest = xxhash.xxh3_64_intdigest
    content = np.array([digest(raw[a:b]) for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)], dtype=np.uint64)
    return key.view(np.int64), content.view(np.int64), first, last, again


def runs(docs: DataFrame) -> DataFrame:
    """``key, content, doc, first, last, again`` of every run of every text (``doc, text``)."""

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column("doc")
        held: list[tuple] = []
        count = 0
        for i, text in enumerate(batch.column("text").to_pylist()):
            got = runs_of(text.encode("utf-8"))
            held.append((i, *got))
            count += len(got[0])
            if count > 200_000:
                yield made(ids, held)
                held, count = [], 0
        if held:
            yield made(ids, held)

    def made(ids: pa.Array, held: list[tuple]) -> dict:
        row = np.repeat([h[0] for h in held], [len(h[1]) for h in held])
        key, content, first, last, again = (np.concatenate([h[k] for h in held]) for k in range(1, 6))
        return {"key": pa.array(key, type=pa.int64()), "content": pa.array(content, type=pa.int64()), "doc": ids.take(pa.array(row, type=pa.int64())), "first": pa.array(first, type=pa.int64()), "last": pa.array(last, type=pa.int64()), "again": pa.array(again)}

    return per_row(docs.select("doc", "text"), "key long, content long, doc long, first long, last long, again boolean", rows)


class SuffixSort:
    """Suffixes of a byte string by their first ``length`` bytes, inside given groups."""

    def __init__(self, raw: bytes, length: int = LENGTH) -> None:
        words = -(-length // 8)
        steps = [8 << k for k in reversed(range((words - 1).bit_length()))]
        beyond = 8 + sum(steps)  # how far a comparison may look past a suffix's start
        hashed, self.length = Hashed(raw + bytes(beyond + 8)), length
        self.bytes, size = hashed.bytes, len(raw) + beyond
        self.word = np.empty(size, dtype=np.uint64)
        # the hashes that the binary search asks for, of every place; a word stands for itself
        self.steps = [(s, self.word if s == 8 else np.empty(size - s + 1, dtype=np.uint64)) for s in steps]
        for at in range(0, size, PLACES_AT_ONCE):
            places = np.arange(at, min(at + PLACES_AT_ONCE, size))
            self.word[places] = sum(self.bytes[places + t].astype(np.uint64) << np.uint64(56 - 8 * t) for t in range(8))
            for s, hashes in self.steps:
                if s > 8:
                    within = places[: max(0, len(hashes) - at)]
                    hashes[within] = hashed.of(within, s)
        counted = np.clip(length - 8 * np.arange(beyond // 8 + 1), 0, 8)
        self.counted = np.array([(1 << 64) - (1 << 8 * (8 - c)) for c in counted.tolist()], dtype=np.uint64)

    def differing(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of suffixes with equal first words, the words at the end of their common extension, found
        by binary search on hashes.  Words are equal if the suffixes agree over ``length`` bytes."""
        common = np.full(len(x), 8, dtype=np.int64)
        for step, hashes in self.steps:
            common += step * (hashes[x + common] == hashes[y + common])
        counted = self.counted[common >> 3]
        return self.word[x + common] & counted, self.word[y + common] & counted

    def classes(self, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted positions in ``starts``, and for each but the first whether it equals the one before.

        Positions are sorted by group and suffix; equal suffixes of a group stay in the given order.
        """
        order = np.lexsort((self.word[starts], group))
        word, own = self.word[starts[order]], group[order]
        split = np.flatnonzero((word[1:] != word[:-1]) | (own[1:] != own[:-1])) + 1
        begin = np.concatenate(([0], split))
        size = np.diff(np.concatenate((begin, [len(order)])))
        shared = np.repeat(size > 1, size)
        order = order[shared]
        size = size[size > 1]
        begin = np.cumsum(size) - size
        if not len(order):
            return order, np.zeros(0, dtype=bool)
        return self._verified(starts, self._merged(starts, order, begin, size), order, begin, size)

    def _merged(self, starts: np.ndarray, order: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Mergesort of all buckets at once, from the runs in which they already stand.

        A suffix of a right half moves behind those of the left half that are not greater; the
        left half fills the places between.  Suffixes found equal move on as one.
        """
        at = starts[order]
        bucket = np.repeat(np.arange(len(size)), size)
        word, following = self.differing(at[:-1], at[1:])
        apart = bucket[1:] != bucket[:-1]
        new = np.concatenate(([True], apart | (word != following)))
        item = np.cumsum(new) - 1
        at, falls = at[new], np.concatenate(([True], apart | (word > following)))[new]
        heir, rank = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
        who, low = np.arange(len(at)), np.flatnonzero(falls)  # items in their order, and where runs begin
        own = bucket[new][low]  # a run's bucket
        while len(low):
            high = np.concatenate((low[1:], [len(who)]))
            first = np.concatenate(([True], own[1:] != own[:-1]))
            # buckets of one run are done
            done = first & np.concatenate((first[1:], [True]))
            ended = np.repeat(done, high - low)
            place = np.arange(len(who)) - np.repeat(low, high - low)
            rank[who[ended]] = (begin[np.repeat(own, high - low)] + place)[ended]
            who, length, own, first = who[~ended], (high - low)[~done], own[~done], first[~done]
            if not len(who):
                break
            low = np.cumsum(length) - length
            # of a bucket's runs every second one goes into the one before it
            number = np.arange(len(low))
            right = np.flatnonzero((number - np.maximum.accumulate(np.where(first, number, 0))) & 1)
            moves = length[right]
            inner = np.arange(moves.sum()) - np.repeat(np.cumsum(moves) - moves, moves)
            moving = np.repeat(low[right], moves) + inner
            suffix, found = at[who], np.repeat(low[right - 1], moves)
            end, mine = np.repeat(low[right], moves), suffix[moving]
            same = np.zeros(len(moving), dtype=bool)
            while (open_ := np.flatnonzero(found < end)).size:
                middle = (found[open_] + end[open_]) >> 1
                theirs, word = self.differing(suffix[middle], mine[open_])
                before = theirs <= word
                found[open_] = np.where(before, middle + 1, found[open_])
                end[open_] = np.where(before, end[open_], middle)
                same[open_] = np.where(before, theirs == word, same[open_])
            heir[who[moving[same]]] = who[found[same] - 1]
            # hashes that contradict each other could give two suffixes one place
            to = np.maximum.accumulate(found) + inner
            stays, free = np.ones(len(who), dtype=bool), np.ones(len(who), dtype=bool)
            stays[moving], free[to] = False, False
            merged = np.empty_like(who)
            merged[to], merged[free] = who[moving], who[stays]
            joined = np.zeros(len(who) + 1, dtype=np.int64)
            joined[to[same] + 1] = 1
            who = merged[joined[1:] == 0]
            left = np.ones(len(low), dtype=bool)
            left[right] = False
            low, own = (low - np.cumsum(joined)[low])[left], own[left]
        while not np.array_equal(heir, heir[heir]):
            heir = heir[heir]
        return order[np.argsort(rank[heir][item], kind="stable")]

    def _verified(self, starts: np.ndarray, order: np.ndarray, members: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Compares neighbours by their bytes, eight at once; a bucket in disorder is sorted by bytes.

        ``members`` has the same buckets before the merges.
        """
        pair = np.ones(len(order), dtype=bool)
        pair[begin] = False
        equal = np.zeros(len(order), dtype=bool)
        wrong = np.bincount(order, minlength=len(starts))[members] != 1
        span = np.append(np.arange(0, self.length - 8, 8), self.length - 8)
        for at in range(0, len(order), 50_000):
            rows = np.arange(max(at, 1), min(at + 50_000, len(order)))
            rows = rows[pair[rows]]
            if not len(rows):
                continue
            a = self.word[starts[order[rows - 1]][:, None] + span]
            b = self.word[starts[order[rows]][:, None] + span]
            differ = a != b
            equal[rows] = ~differ.any(axis=1)
            place = differ.argmax(axis=1)[:, None]
            above = (np.take_along_axis(a, place, 1) > np.take_along_axis(b, place, 1))[:, 0]
            wrong[rows] |= np.where(equal[rows], order[rows - 1] > order[rows], above)
        if wrong.any():
            raw = self.bytes.tobytes()
            bucket = np.repeat(np.arange(len(size)), size)
            for k in np.unique(bucket[wrong]).tolist():
                a, b = int(begin[k]), int(begin[k] + size[k])
                own = sorted(members[a:b].tolist(), key=lambda i: (raw[starts[i] : starts[i] + self.length], i))
                order[a:b] = own
                text = [raw[starts[i] : starts[i] + self.length] for i in own]
                equal[a:b] = [False, *(x == y for x, y in zip(text, text[1:], strict=False))]
        return order, equal


def repeated(records: list[tuple[int, int, int, bytes]], length: int = LENGTH) -> list[tuple[int, int, int]]:
    """Byte spans (doc, start, end) that repeat earlier ones of the same group.

    A record is (group, doc, start of its bytes in the doc, bytes).
    """
    records = sorted(records, key=lambda r: (r[1], r[2]))
    if not records:
        return []
    sizes = np.array([len(r[3]) for r in records])
    windows = sizes - length + 1
    offset = np.cumsum(sizes) - sizes
    record = np.repeat(np.arange(len(records)), windows)
    inner = np.arange(len(record)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = offset[record] + inner
    group = np.unique(np.array([r[0] for r in records]), return_inverse=True)[1][record]
    order, equal = SuffixSort(b"".join(r[3] for r in records), length).classes(starts, group)
    again = np.sort(order[equal])
    if not len(again):
        return []
    own, at = record[again], np.array([r[2] for r in records])[record[again]] + inner[again]
    new = np.concatenate(([True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    return [(records[o][1], a, b + length) for o, a, b in zip(own[first].tolist(), at[first].tolist(), at[last].tolist(), strict=True)]


def _shrunk(docs: DataFrame) -> DataFrame:
    """``doc, size, packed``: UTF-8 texts compressed, so that they are cheaper to move."""

    def rows(batch: pa.RecordBatch) -> dict:
        raw = [t.encode("utf-8") for t in batch.column("text").to_pylist()]
        return {"doc": batch.column("doc"), "size": [len(r) for r in raw], "packed": [pa.compress(r, codec=CODEC, asbytes=True) if r else b"" for r in raw]}

    return per_row(docs.select("doc", "text"), "doc long, size long, packed binary", rows)


def _opened(packed: bytes, size: int) -> bytes:
    return pa.decompress(packed, decompressed_size=size, codec=CODEC, asbytes=True) if size else b""


def _pieces(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, doc, first, bytes, digest`` of wanted runs (``key, doc, first, last, hot``).

    Runs of a hot key are cut into single windows, which have a digest instead of bytes.
    """
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("key", "first", "last", "hot")).alias("wanted"))
    held = _shrunk(docs).join(lists, "doc")

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        names = ("key", "doc", "first", "bytes", "digest")
        out: list[tuple] = []
        size = 0
        for doc, n, packed, asked in zip(*(batch.column(c).to_pylist() for c in ("doc", "size", "packed", "wanted")), strict=True):
            raw = _opened(packed, n)
            for w in asked:
                key, a, b = w["key"], w["first"], w["last"]
                if w["hot"]:
                    out += [(key, doc, p, None, xxhash.xxh3_128_digest(raw[p : p + LENGTH])) for p in range(a, b + 1)]
                else:
                    out.append((key, doc, a, raw[a : b + LENGTH], None))
                size += b - a + LENGTH
            if size > 8_000_000:
                yield dict(zip(names, zip(*out, strict=True), strict=True))
                out, size = [], 0
        if out:
            yield dict(zip(names, zip(*out, strict=True), strict=True))

    return per_row(held, "key long, doc long, first long, bytes binary, digest binary", rows)


def _repeated_windows(pieces: DataFrame) -> DataFrame:
    """``doc, a, b``: spans that a suffix sort finds repeated; a shard of keys is one task's group."""
    size = pieces.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))

    def sort(group: pa.Table) -> pa.Table:
        found = repeated(list(zip(*(group.column(c).to_pylist() for c in ("key", "doc", "first", "bytes")), strict=True)))
        doc, a, b = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"doc": pa.array(doc, type=pa.int64()), "a": pa.array(a, type=pa.int64()), "b": pa.array(b, type=pa.int64())})

    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return dealt.groupBy("_shard").applyInArrow(sort, "doc long, a long, b long")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc, a, b``: byte spans to remove, possibly overlapping, from unique ``doc, text``."""
    spark = docs.sparkSession
    with freeing_shuffles(spark):
        every = stored(runs(docs), "runs")
        # "again" alone, and two contents of one key, ask for a sort.  Grouped results are written
        # before they are joined: a join of two plain tables is one that a hot key does not hold up.
        keys = every.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"), F.min("content").alias("low"), F.max("content").alias("high"))
        met = stored(keys.where("n > 1 or again").select("key", (F.col("again") | (F.col("low") != F.col("high"))).alias("sorted")), "shared-keys")
        shared = stored(every.select("key", "content", "doc", "first", "last").join(met, "key"), "shared-runs")
        firsts = stored(_earliest(shared, "key", "content"), "first-runs")
        marked = stored(shared.join(firsts, ["key", "content"]).withColumn("is_first", _is_first()).drop("content", "earliest"), "marked-runs")
        left = marked.where(F.col("is_first") & F.col("sorted")).select("key", "doc", "first", "last")
        hot = stored(left.groupBy("key").count().where(F.col("count") > KEY_CONTENTS).select("key", F.lit(True).alias("hot")), "hot-keys")
        wanted = left.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
        pieces = stored(_pieces(docs, wanted), "pieces")
        inner = stored(_repeated_windows(pieces.where("bytes is not null")), "repeated-windows")
        single = pieces.where("digest is not null").select("digest", "doc", "first")
        late = stored(single.join(stored(_earliest(single, "digest"), "first-windows"), "digest").where(~_is_first()), "late-windows")
    whole = marked.where(~F.col("is_first")).select("doc", F.col("first").alias("a"), (F.col("last") + LENGTH).alias("b"))
    return whole.unionByName(inner).unionByName(late.select("doc", F.col("first").alias("a"), (F.col("first") + LENGTH).alias("b")))


def _is_first() -> Column:
    return F.struct("doc", "first") == F.col("earliest")


def _earliest(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.min(F.struct("doc", "first")).alias("earliest"))


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: maximal removed byte spans, remaining bytes."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType
    numbered = _numbered(rows)
    plain = numbered.select("doc", "text")
    spans = repeated_spans(plain).groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("cut"))
    held = _shrunk(plain).join(spans, "doc", "left")

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        doc, size, out, kept, held_bytes = [], [], [], [], 0
        for d, n, packed, found in zip(*(batch.column(c).to_pylist() for c in ("doc", "size", "packed", "cut")), strict=True):
            raw = _opened(packed, n)
            gone = united([(s["a"], s["b"]) for s in found or ()])
            edges = [0, *(x for span in gone for x in span), n]
            doc.append(d)
            size.append(n)
            out.append([{"start": a, "end": b} for a, b in gone])
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            held_bytes += n
            if held_bytes > 32_000_000:
                yield {"doc": doc, "n_bytes": size, "spans": out, "kept": kept}
                doc, size, out, kept, held_bytes = [], [], [], [], 0
        if doc:
            yield {"doc": doc, "n_bytes": size, "spans": out, "kept": kept}

    made = per_row(held, "doc long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary", cut)
    if "doc_id" not in numbered.columns:
        return made.select(F.col("doc").cast(kind).alias("doc_id"), "n_bytes", "spans", "kept")
    return made.join(numbered.select("doc", "doc_id"), "doc").select("doc_id", "n_bytes", "spans", "kept")


def _numbered(rows: DataFrame) -> DataFrame:
    """``doc, text``: unique longs in the order of the ids.

    Unique integer ids serve as they are.  Others are numbered by id (nulls last) and text hash,
    and the result has them as ``doc_id``.
    """
    if rows.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        n, different = rows.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
        if n == different:
            return rows.select(F.col("doc_id").cast("long").alias("doc"), "text")
    keyed = rows.select("doc_id", "text", F.col("doc_id").isNull().alias("_null"), F.xxhash64("text").alias("_hash"))
    return stored(dense_ids(keyed, "doc", ["_null", "doc_id", "_hash"]).select("doc", "doc_id", "text"), "numbered")
