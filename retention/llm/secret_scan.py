"""Secret scans that also look behind encodings.

A text is the first layer of a worklist. Every layer is scanned; then each decoder (percent-encoding,
backslash escapes of characters, base64) writes the layer anew with all its decodable stretches
decoded in place, and base64 that holds compressed data gives the unpacked data as a further layer.
New layers go to the worklist until none comes up that the document didn't have before: the digests
of all layers met so far break cycles. Every layer knows which stretch of the layer before it each
of its characters comes from, so a hit at any depth is mapped back to a span of the document.

Three kinds of secrets are looked for in every layer, leftmost and not overlapping within a kind:
values assigned to a name such as ``token``, access key ids, and long runs of hex digits. What the
text itself holds has depth 0; a hit that decoding brought up has the depth of its first layer. A
span that several layers give is reported once, with the least depth.

Unpacked data is read in windows, so that a small text which unpacks to a very large one is read
whole in bounded memory; a window starts with the line that the one before cut, or, if that line
is longer than ``OVERLAP`` bytes, with so much of its end. Damaged data is read as far as it unpacks.

A null or empty text has no spans. Repeated rows and ties of ids are scanned row by row; an empty
table gives an empty table; columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import bz2
import gzip
import lzma
import re
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator
from hashlib import blake2b
from io import RawIOBase
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retention.llm.text import blocks, out_schema, two_columns

KINDS = ("assign", "access", "hex")
LEAST = {"assign": 12, "access": 18, "hex": 16}
NAMES = ("passw", "secret", "token", "api")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\})+")
ESCAPE = re.compile(r"\\(?:u\{([0-9A-Fa-f]+)\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))")
#: The shortest secret has 16 characters, which is 22 in base64.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{22,}={0,2}")
HEX_RUN, BASE64_RUN = b"h" * 16, b"b" * 22
HEX_BYTES = bytes(0x68 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))
BASE64_BYTES = bytes(0x62 if b < 128 and (chr(b).isalnum() or chr(b) in "+/_-") else 0x20 for b in range(256))
URL_SAFE = str.maketrans("-_", "+/")
WINDOW, OVERLAP = 4_000_000, 100_000


class Piece(NamedTuple):
    """Characters from ``at`` on come from ``start`` to ``end`` of the layer before.

    ``places`` tells for every character where its own stretch starts, with the end of the last one behind;
    without it the characters are copies, one for one, or, if ``whole``, all come from the stretch as a whole.
    """

    at: int
    start: int
    end: int
    places: list[int] | None = None
    whole: bool = False


class Layer:
    def __init__(self, text: str, parent: Layer | None = None, pieces: list[Piece] | None = None, how: str = ""):
        self.text, self.parent, self.pieces = text, parent, pieces or []
        self.path: tuple[str, ...] = (*parent.path, how) if parent else ()
        self.starts = [p.at for p in self.pieces]

    def origin(self, start: int, end: int) -> tuple[int, int]:
        """The span of the document that the characters from ``start`` to ``end`` come from."""
        layer = self
        while layer.parent:
            first = layer.pieces[bisect_right(layer.starts, start) - 1]
            last = layer.pieces[bisect_right(layer.starts, end - 1) - 1]
            if not first.whole:
                start = first.places[start - first.at] if first.places else first.start + start - first.at
            else:
                start = first.start
            if not last.whole:
                end = last.places[end - last.at] if last.places else last.start + end - last.at
            else:
                end = last.end
            layer = layer.parent
        return start, end


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of all secrets that stand in the text as it is."""
    lower = text.lower()
    if any(name in lower for name in NAMES):
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= LEAST["assign"]:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST["access"]:
                yield "access", m.start(), m.end()
    if HEX_RUN in text.encode().translate(HEX_BYTES):
        for m in HEX.finditer(text):
            yield "hex", m.start(), m.end()


def percent(stretch: str) -> tuple[str, list[int]] | None:
    """The text behind a run of %XX, and where each of its characters starts."""
    raw = bytes.fromhex(stretch.replace("%", ""))
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    return text, _byte_places(text, lambda byte: 3 * byte)


def escapes(stretch: str) -> tuple[str, list[int]] | None:
    """The text behind a run of backslash escapes; two surrogates make one character."""
    chars, places, half = [], [], None
    for m in ESCAPE.finditer(stretch):
        point = int(next(g for g in m.groups() if g), 16)
        if half is not None and 0xDC00 <= point < 0xE000:
            chars[-1] = chr(0x10000 + ((half - 0xD800) << 10) + point - 0xDC00)
            half = None
            continue
        half = point if 0xD800 <= point < 0xDC00 else None
        chars.append("�" if 0xD800 <= point < 0xE000 or point > 0x10FFFF else chr(point))
        places.append(m.start())
    return "".join(chars), [*places, len(stretch)]


def _byte_places(text: str, place: Callable[[int], int]) -> list[int]:
    places, byte = [0], 0
    for c in text:
        byte += len(c.encode())
        places.append(place(byte))
    return places


def raw_base64(stretch: str) -> bytes:
    body = stretch.rstrip("=").translate(URL_SAFE)
    if len(body) % 4 == 1:
        body = body[:-1]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def base64_text(stretch: str) -> tuple[str, list[int]] | None:
    """The text behind a run of base64, if it is text; a character starts in the letter that holds its first bit."""
    try:
        text = raw_base64(stretch).decode()
    except UnicodeDecodeError:
        return None
    if not text or not all(c.isprintable() or c in "\t\n\r" for c in text):
        return None
    places = _byte_places(text, lambda byte: min(byte * 8 // 6, len(stretch)))
    places[-1] = len(stretch)
    return text, places


#: (name of the layer, first run the text must hold, pattern of the stretches, decoder of one stretch)
DECODERS = (
    ("url", "%", PERCENT, percent),
    ("unicode", "\\", ESCAPES, escapes),
    ("base64", "", BASE64, base64_text),
)


def decoded(layer: Layer, how: str, pattern: re.Pattern, decode: Callable) -> Layer | None:
    """The layer with all stretches of one encoding decoded in place."""
    out, pieces, at, done = [], [], 0, 0
    for m in pattern.finditer(layer.text):
        found = decode(m.group())
        if found is None:
            continue
        text, places = found
        if m.start() > done:
            pieces.append(Piece(at, done, m.start()))
            out.append(layer.text[done : m.start()])
            at += m.start() - done
        pieces.append(Piece(at, m.start(), m.end(), [m.start() + p for p in places]))
        out.append(text)
        at, done = at + len(text), m.end()
    if not done:
        return None
    if done < len(layer.text):
        pieces.append(Piece(at, done, len(layer.text)))
        out.append(layer.text[done:])
    return Layer("".join(out), layer, pieces, how)


class Stream(RawIOBase):
    """Chunks of bytes as a file that the readers of compressed data take."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.left = chunks, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.left:
            chunk = next(self.chunks, None)
            if chunk is None:
                return 0
            self.left = chunk
        n = min(len(buffer), len(self.left))
        buffer[:n], self.left = self.left[:n], self.left[n:]
        return n


def _zlib(stream: Stream) -> Iterator[bytes]:
    unpack = zlib.decompressobj()
    while not unpack.eof and (packed := stream.read(WINDOW)):
        while packed:
            yield unpack.decompress(packed, WINDOW)
            packed = unpack.unconsumed_tail


def _reader(opened: Callable) -> Callable[[Stream], Iterator[bytes]]:
    def run(stream: Stream) -> Iterator[bytes]:
        with opened(stream) as reader:
            while part := reader.read(WINDOW):
                yield part

    return run


#: First bytes of compressed data, its name, and what unpacks it.
FORMATS = (
    (b"\x1f\x8b", "gzip", _reader(gzip.open)),
    (b"\x78\x01", "zlib", _zlib), (b"\x78\x5e", "zlib", _zlib), (b"\x78\x9c", "zlib", _zlib), (b"\x78\xda", "zlib", _zlib),
    (b"BZh", "bzip2", _reader(bz2.open)),
    (b"\xfd7zXZ\x00", "xz", _reader(lzma.open)),
    (b"\x28\xb5\x2f\xfd", "zstd", _reader(lambda s: zstandard.ZstdDecompressor().stream_reader(s, read_across_frames=True))),
)
DAMAGED = (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError)


def _whole_until_damage(unpack: Callable, stream: Stream) -> Iterator[bytes]:
    try:
        yield from filter(None, unpack(stream))
    except DAMAGED:
        pass


def windows(raw: bytes) -> Iterator[tuple[str, bytes]]:
    """(formats, data) for every window of what is packed in ``raw``, unpacked until it is packed no more."""
    chunks, names, met = iter([raw]), [], set()
    while True:
        first = next(chunks, b"")
        found = next(((name, unpack) for magic, name, unpack in FORMATS if first.startswith(magic)), None)
        key = blake2b(first, digest_size=16).digest()
        if found is None or key in met:
            break
        met.add(key)
        names.append(found[0])
        chunks = _whole_until_damage(found[1], Stream(chain([first], chunks)))
    if names and found is None:
        path = ">".join(["base64", *names])
        yield from ((path, part) for part in chain([first], chunks))


def unpacked(layer: Layer) -> Iterator[Layer]:
    """A layer for every window of the data packed behind the layer's base64 stretches."""
    for m in BASE64.finditer(layer.text):
        tail = b""
        for path, part in windows(raw_base64(m.group())):
            data = tail + part
            yield Layer(data.decode(errors="replace"), layer, [Piece(0, m.start(), m.end(), whole=True)], path)
            line = data.rfind(b"\n") + 1
            tail = data[max(line, len(data) - OVERLAP) :]


def find(text: str) -> list[tuple[str, int, int, int, str]]:
    """(kind, start, end, depth, layers) of every secret, by start and kind."""
    best: dict[tuple[int, int, int], tuple[int, str]] = {}
    todo = deque([Layer(text)])
    met = {blake2b(text.encode(), digest_size=16).digest()}

    def add(layer: Layer | None) -> None:
        if layer is not None:
            key = blake2b(layer.text.encode(errors="replace"), digest_size=16).digest()
            if key not in met:
                met.add(key)
                todo.append(layer)

    while todo:
        layer = todo.popleft()
        for kind, *span in scan(layer.text):
            start, end = layer.origin(*span)
            best.setdefault((start, KINDS.index(kind), end), (len(layer.path), "/".join(layer.path)))
        for how, sign, pattern, decode in DECODERS:
            if sign in layer.text and (how != "base64" or BASE64_RUN in layer.text.encode(errors="replace").translate(BASE64_BYTES)):
                add(decoded(layer, how, pattern, decode))
                if how == "base64":
                    for found in unpacked(layer):
                        add(found)
    return [(KINDS[kind], start, end, *found) for (start, kind, end), found in sorted(best.items())]


SPAN = {"kind": pa.string(), "start": pa.int64(), "end": pa.int64(), "depth": pa.int32(), "layers": pa.string()}


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every whole text; a span is (kind, start, end, depth, layers), in code points, end exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct(SPAN.items()))
        for keys, texts in blocks(batches):
            spans = [[dict(zip(SPAN, span)) for span in find(text)] for text in texts]
            yield pa.RecordBatch.from_arrays([keys, pa.array(spans, kind)], ["id", "spans"])

    source = two_columns(docs, id_col, text_col)
    kind = "array<struct<kind: string, start: long, end: long, depth: int, layers: string>>"
    return source.mapInArrow(run, out_schema(source, spans=kind)).withColumnRenamed("id", id_col)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_decoded): counts and digest of what the text itself holds, all spans."""
    found = find_secrets(docs, id_col, text_col)
    base = F.filter("spans", lambda s: s["depth"] == 0)
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        id_col, *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["depth"] > 0)).cast("long").alias("n_decoded"),
    )
