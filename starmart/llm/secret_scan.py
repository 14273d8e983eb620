"""Secret scans that unwrap nested encodings.

A text is scanned, then everything in it that can be decoded (percent escapes, Unicode
escapes, base64 runs, and compressed data inside of those) becomes a layer that is
scanned and unwrapped in turn, until no new layer comes up.  A layer that was met before
at the same place is not taken again, so data that decodes to itself ends.  Every
character of a layer knows the span of the original text that it came from, and
findings are reported as such spans.  Decoded bytes are read one by one (and by twos where
they look like UTF-16), so bytes that are no text do not hide a secret beside them.

Results: a null text counts as empty and has no spans.  Repeated rows are scanned each;
null ids are kept; an empty table gives an empty table.  A compressed layer of more than
``LAYER_BYTES`` is read in pieces that overlap by ``OVERLAP_BYTES``, so its secrets are found; it
is counted in ``unread``, as something encoded in it that is longer than the overlap may be cut.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches, per_row, text_or_empty

# The patterns of the base scan, in the order of their kinds, and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

# A run of 24 and more; what it leaves out would be dropped by its length in any case.
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2})|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\x[0-9a-fA-F]{2}|&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# A run wrapped over lines, which may be indented.
LINES = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
STANDARD = str.maketrans("-_", "+/")

LAYER_BYTES = 64 << 20
OVERLAP_BYTES = 64 << 10

Span = tuple[int, int, int]  # kind's number, start, end


def base_spans(text: str) -> list[Span]:
    """What the three patterns find in ``text`` itself."""
    found = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(2, m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    return found


@dataclass
class Layer:
    """Decoded text; character i stems from ``[start[i], end[i])`` of the original.

    ``tail`` is where what holds the text ends, with its padding.
    """

    text: str
    start: np.ndarray
    end: np.ndarray
    decoded: bool = False
    tail: int | None = None

    @classmethod
    def original(cls, text: str) -> Layer:
        at = np.arange(len(text), dtype=np.int64)
        return cls(text, at, at + 1)

    def origin(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a:b].min()), int(self.end[a:b].max())


def unescaped(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match of ``pattern`` decoded in its place.

    ``decode`` gives characters with their spans inside the match, or None to leave it.
    """
    text: list[str] = []
    start: list[np.ndarray] = []
    end: list[np.ndarray] = []
    at = 0
    for m in pattern.finditer(layer.text):
        if (made := decode(m[0])) is None:
            continue
        text.append(layer.text[at : m.start()])
        start.append(layer.start[at : m.start()])
        end.append(layer.end[at : m.start()])
        for char, a, b in made:
            lo, hi = layer.origin(m.start() + a, m.start() + b)
            text.append(char)
            start.append(np.array([lo]))
            end.append(np.array([hi]))
        at = m.end()
    if not at:
        return None
    return Layer("".join([*text, layer.text[at:]]), np.concatenate([*start, layer.start[at:]]), np.concatenate([*end, layer.end[at:]]), True)


def percent_units(match: str) -> list[tuple[str, int, int]]:
    return [(chr(b), 3 * i, 3 * i + 3) for i, b in enumerate(binascii.unhexlify(match.replace("%", "")))]


def escape_units(match: str) -> list[tuple[str, int, int]] | None:
    if match.startswith("&#"):
        number = int(match[3:-1], 16) if match[2] in "xX" else int(match[2:-1])
    elif len(match) == 12:
        number = 0x10000 + ((int(match[2:6], 16) - 0xD800) << 10) + int(match[8:], 16) - 0xDC00
    else:
        number = int(match[2:], 16)
    if number > 0x10FFFF or 0xD800 <= number < 0xE000:
        return None
    return [(chr(number), 0, len(match))]


LITERAL = re.compile(ESCAPE.pattern + r"""|\\[abfnrtv0\\'"]""")
SHORT = dict(zip("abfnrtv0\\'\"", "\a\b\f\n\r\t\v\0\\'\"", strict=True))


# A sign that was escaped over and over: each layer only takes one escape off, so all but one go at once.
DEEP = re.compile(r"%(?:25){2,}|\\(?:x5[cC]|u005[cC]){2,}|&(?:#0*38;|#[xX]0*26;){2,}")
ONCE = {"%": "%25", "\\": "\\x5c", "&": "&#38;"}


def deep_units(match: str) -> list[tuple[str, int, int]]:
    return [(c, 0, len(match)) for c in ONCE[match[0]]]


def literal_units(match: str) -> list[tuple[str, int, int]] | None:
    return [(SHORT[match[1]], 0, 2)] if len(match) == 2 else escape_units(match)


def byte_layers(raw: bytes, spans: Callable[[], tuple[np.ndarray, np.ndarray]], tail: int | None = None) -> Iterator[Layer]:
    """The texts that ``raw`` is: a character a byte, and one for two bytes where it looks like UTF-16.

    What is looked for is ASCII, so other characters need not come out right.  ``spans`` gives
    the origins of the bytes, and is asked only for texts in which something is found.
    """
    text = raw.decode("latin-1")
    if MAGIC.search(raw) or of_use(text):
        yield Layer(text, *spans(), True, tail)
    if WIDE.search(raw):
        for odd in (0, 1):
            units = np.frombuffer(raw, dtype="<u2", offset=odd, count=(len(raw) - odd) // 2)
            for wide in (units, units.byteswap()):
                text = np.where(wide < 128, wide, 255).astype(np.uint8).tobytes().decode("latin-1")
                if of_use(text):
                    start, end = spans()
                    yield Layer(text, start[odd : odd + 2 * len(text) : 2], end[odd + 1 : odd + 2 * len(text) : 2], True)


WIDE = re.compile(rb"(?:[\t\n\r -~]\0){6}|(?:\0[\t\n\r -~]){6}")


def of_use(text: str) -> bool:
    """Whether decoded bytes hold a secret or more to decode; most that are no text do not."""
    return bool(BASE64.search(text) or PERCENT.search(text) or ESCAPE.search(text) or base_spans(text))


def unbase64(body: str) -> bytes:
    """What a run without its padding holds; a single last character holds no byte."""
    body = body[:-1] if len(body) % 4 == 1 else body
    return base64.b64decode((body + "=" * (-len(body) % 4)).translate(STANDARD))


MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\0|\x28\xb5\x2f\xfd")
BROKEN = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError)
# Bytes given to a decompressor one by one at first, then at once, so that noise ends soon.
SLOW_BYTES, STEP_BYTES = 256, 512
# Noise that looks compressed gives a few bytes at most; inside of what gives more no other start is tried.
LEAST_SKIPPED = 1024


def opened(first: bytes):
    """A decompressor for data that begins like this, None if it is none."""
    if not MAGIC.match(first):
        return None
    if first[:1] in b"\x1fx":
        return zlib.decompressobj(47)
    if first[:1] == b"B":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if first[:1] == b"\xfd" else zstandard.ZstdDecompressor().decompressobj()


def inflated(raw: bytes, at: int) -> Iterator[tuple[bytes, int]]:
    """What the compressed data from ``at`` on hold, and where the bytes for it end.

    All members or frames that follow each other are read.  Data that break off or are broken
    give what they have up to there.
    """
    slow = at + SLOW_BYTES
    while (stream := opened(raw[at : at + 6])) is not None:
        while not stream.eof and at < len(raw):
            part = raw[at : at + (1 if at < slow else STEP_BYTES)]
            before = stream.copy() if len(part) > 1 and hasattr(stream, "copy") else None
            try:
                out = stream.decompress(part)
            except BROKEN:
                if before is None:
                    return
                stream, slow = before, at + STEP_BYTES
                continue
            at += len(part) - (len(stream.unused_data) if stream.eof else 0)
            yield out, at
        if not stream.eof:
            return


def in_pieces(stream: Iterator[tuple[bytes, int]]) -> Iterator[bytes]:
    """The stream's bytes in pieces of at most ``LAYER_BYTES``, each with the end of the one before."""
    held = bytearray()
    for out, _ in stream:
        held += out
        while len(held) > LAYER_BYTES:
            yield bytes(held[:LAYER_BYTES])
            del held[: LAYER_BYTES - min(OVERLAP_BYTES, LAYER_BYTES // 2)]
    if held:
        yield bytes(held)


def compressed_layers(layer: Layer) -> Iterator[Layer | None]:
    """The layers of compressed data anywhere in decoded bytes; None for data in more than one piece."""
    raw = layer.text.encode("latin-1", "replace")
    done = 0
    for m in MAGIC.finditer(raw):
        if m.start() < done:
            continue
        size, end = 0, m.start()
        for out, end in inflated(raw, m.start()):
            size += len(out)
        if not size:
            continue
        if size >= LEAST_SKIPPED:
            done = end
        lo, hi = layer.origin(m.start(), end)
        if end == len(raw) and layer.tail is not None:
            hi = max(hi, layer.tail)
        for piece in in_pieces(inflated(raw, m.start())):
            n = len(piece)
            yield from byte_layers(piece, lambda n=n: (np.broadcast_to(np.int64(lo), n), np.broadcast_to(np.int64(hi), n)))
        if size > LAYER_BYTES:
            yield None


def unwrapped(layer: Layer) -> Iterator[Layer | None]:
    """The layers directly inside ``layer``; None for one that is read in more than one piece."""
    if layer.decoded:
        yield from compressed_layers(layer)
    flat = layer
    if ("%" in layer.text or "\\" in layer.text or "&#" in layer.text) and (inner := unescaped(layer, DEEP, deep_units)):
        flat = inner
    if "%" in flat.text and (inner := unescaped(flat, PERCENT, percent_units)):
        yield inner
    if ("\\" in flat.text or "&#" in flat.text) and (inner := unescaped(flat, ESCAPE, escape_units)):
        yield inner
        if "\\" in layer.text and MAGIC.search(inner.text.encode("latin-1", "replace")):
            # as bytes are written in programs: the short escapes belong to the data as well
            yield unescaped(flat, LITERAL, literal_units)
    for m in BASE64.finditer(layer.text):
        yield from base64_layers(layer, m.start(), m[0], None, m.end())
    if "\n" in layer.text:
        for m in LINES.finditer(layer.text):
            at = m.start() + np.flatnonzero(np.frombuffer(m[0].encode(), dtype=np.uint8) > 32)
            yield from base64_layers(layer, m.start(), "".join(m[0].split()), at, m.end())


def base64_layers(layer: Layer, begin: int, run: str, at: np.ndarray | None, stop: int) -> Iterator[Layer]:
    """The layers of a base64 run, from each of its first four characters on.

    So data that stand behind a path or a prefix are decoded as well, wherever they begin.
    ``at`` has the places of the run's characters if they are not next to each other.
    """
    body = run.rstrip("=")
    for skip in range(4):
        if not (raw := unbase64(body[skip:])):
            continue

        def spans(skip: int = skip, n: int = len(raw)) -> tuple[np.ndarray, np.ndarray]:
            # byte j of the data needs characters 4 * (j // 3) + j % 3 and the next one
            first = np.arange(n)
            first = skip + 4 * (first // 3) + first % 3
            first, last = (begin + first, begin + first + 1) if at is None else (at[first], at[first + 1])
            return layer.start[first], layer.end[last]

        yield from byte_layers(raw, spans, layer.origin(begin, stop)[1])


def scan(text: str) -> tuple[list[Span], list[Span], int]:
    """The base spans, all spans, and how many layers were read in pieces.

    Spans are sorted by start, then kind, then end; ``all`` has each span once.
    """
    base = sorted(base_spans(text), key=lambda s: (s[1], s[0], s[2]))
    if not ("%" in text or "\\" in text or "&#" in text) and not BASE64.search(text):
        return base, base, 0
    spans, unread, met = set(base), 0, set()
    # depth first, so that one piece of large data is held at a time
    work = [unwrapped(Layer.original(text))]
    while work:
        inner = next(work[-1], work)
        if inner is work:
            work.pop()
        elif inner is None:
            unread += 1
        elif inner.text:
            mark = (xxhash.xxh3_128_digest(inner.text.encode("utf-8", "surrogatepass")), *inner.origin(0, len(inner.text)))
            if mark not in met:
                met.add(mark)
                spans.update((kind, *inner.origin(a, b)) for kind, a, b in base_spans(inner.text))
                work.append(unwrapped(inner))
    return base, sorted(spans, key=lambda s: (s[1], s[0], s[2])), unread


def _listed(spans: list[Span]) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans, unread``: arrays of (kind, start, end) in code points."""
    kept = docs.select("doc_id", text_or_empty().alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<kind: string, start: long, end: long>>"

    def rows(batch: pa.RecordBatch) -> dict:
        found = [scan(t) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "base": [_listed(f[0]) for f in found], "spans": [_listed(f[1]) for f in found], "unread": [f[2] for f in found]}

    return per_row(kept, f"doc_id {kind}, base {spans}, spans {spans}, unread long", rows)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def mask(text: str) -> str:
    """``text`` with what was found replaced by the name of its kind in brackets."""
    spans = scan(text)[1]
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, a, b = spans[i]
        while i < len(spans) and spans[i][1] < b:  # what overlaps goes as one
            b = max(b, spans[i][2])
            i += 1
        out += [text[at:a], f"[{KINDS[kind]}]"]
        at = b
    return "".join([*out, text[at:]])


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked and ``n_chars``, if there, counted anew."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def without(texts: pd.Series) -> pd.Series:
        return pd.Series([mask(t) if isinstance(t, str) else None for t in texts], dtype=object)

    out = docs.withColumn("text", without("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out
