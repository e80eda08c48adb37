"""Secrets in texts and in what texts hold in encoded form.

The text is scanned first. Then a worklist unwraps what looks encoded: lines with URL or Unicode
escapes, base64 runs, and gzip or zlib data inside base64. Every decoded layer is scanned and unwrapped in its
turn until nothing new appears; a layer whose content was seen at the same place before is not taken
again. Each character of a layer knows the characters of the text it came from, so that spans always refer to the text.

A chain of escapes (``%252525..41``, several backslashes before ``u0041``) is one layer, so
the work stays in proportion to the text. Base64 runs that only line breaks separate are opened as one. Compressed data is
inflated member by member and scanned in pieces of MAX_LAYER characters that overlap by OVERLAP; ``cut`` tells that
something encoded is longer than the overlap where two pieces meet, so that it was opened in parts only.

Defined results: a null text counts as empty and has no spans; repeated rows get equal rows; an empty
table gives an empty result; other columns are ignored; no text is cut.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex")
MAX_LAYER = 16 << 20
OVERLAP = 1 << 20

# The base patterns. Only ASCII letters fold.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
MIN_VALUE, MIN_ACCESS = 8, 16

# Access keys, long hex numbers and base64 all lie in such runs.
RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Lines of base64, as far as only line breaks (also written as escapes) separate them.
LINES = re.compile(r"[A-Za-z0-9+/_-]{16,}+(?:(?:[\r\n]|\\++[rn])++[A-Za-z0-9+/_-]++)*+={0,2}")
LINE = re.compile(r"(?:[\r\n]|\\++[rn])*+([A-Za-z0-9+/_-]++={0,2})")
UNBROKEN = re.compile(r"[A-Za-z0-9+/_=%\\{}\r\n-]*")
ESCAPE = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+|\\+(?:u\{[0-9A-Fa-f]{1,6}\}|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|x[0-9A-Fa-f]{2})")
PERCENT = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
LINE_WITH_ESCAPE = re.compile(r"%[0-9A-Fa-f]{2}|\\[uUx]")

Span = tuple[int, int, int]


def scan_text(text: str) -> list[Span]:
    """``(start, kind, end)`` of the base patterns, leftmost and not overlapping within a kind."""
    found: list[Span] = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    for run in RUN.finditer(text):
        if run.end() - run.start() >= 32:
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, run.start(), run.end())]
    return sorted(found)


class Layer:
    """A decoded text; character i came from the characters ``low[i]`` to ``high[i]`` of the document."""

    __slots__ = ("text", "low", "high")

    def __init__(self, text: str, low: list[int], high: list[int]):
        self.text, self.low, self.high = text, low, high


def _plain(data: bytes) -> str | None:
    """Bytes as text, if they are one: UTF-8 without control characters other than blanks."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and all(c.isprintable() or c in "\t\n\r" for c in text) else None


def _characters(text: str, places: list[tuple[int, int]]) -> Layer:
    """A layer from decoded text and the source range of each of its UTF-8 bytes."""
    low, high, at = [], [], 0
    for c in text:
        size = len(c.encode())
        low.append(places[at][0])
        high.append(places[at + size - 1][1])
        at += size
    return Layer(text, low, high)


def _unescaped(line: Layer) -> Layer | None:
    """The line with its URL and Unicode escapes decoded; None if nothing changed."""
    out, low, high, at, changed = [], [], [], 0, False
    for m in ESCAPE.finditer(line.text):
        out.append(line.text[at:m.start()])
        low += line.low[at:m.start()]
        high += line.high[at:m.start()]
        at = m.end()
        if m[0][0] == "%":
            parts = list(PERCENT.finditer(m[0]))
            data = bytes(int(p[1], 16) for p in parts)
            places = [(line.low[m.start() + p.start()], line.high[m.start() + p.end() - 1]) for p in parts]
            try:
                piece = _characters(data.decode("utf-8"), places)
            except UnicodeDecodeError:
                piece = Layer(data.decode("latin-1"), [a for a, _ in places], [b for _, b in places])
        else:
            code = int(m[0].lstrip("\\")[1:].strip("{}"), 16)
            if code > 0x10FFFF or 0xD800 <= code < 0xE000:
                piece = Layer(m[0], line.low[m.start():m.end()], line.high[m.start():m.end()])
            else:
                piece = Layer(chr(code), [line.low[m.start()]], [line.high[m.end() - 1]])
        changed |= piece.text != m[0]
        out.append(piece.text)
        low += piece.low
        high += piece.high
    if not changed:
        return None
    return Layer("".join(out) + line.text[at:], low + list(line.low[at:]), high + list(line.high[at:]))


def _is_packed(data: bytes) -> bool:
    return data[:2] == b"\x1f\x8b" or (data[:1] == b"\x78" and data[1:2] in (b"\x01", b"\x5e", b"\x9c", b"\xda"))


def _inflated(data: bytes, left: list[int]) -> Iterator[bytes]:
    """Decompressed gzip or zlib data, all members, in chunks; ``left[0]`` becomes the number of bytes not used."""
    while _is_packed(data):
        engine, rest = zlib.decompressobj(47), data
        try:
            while not engine.eof:
                out = engine.decompress(rest, 1 << 20)
                rest = engine.unconsumed_tail
                if out:
                    yield out
                elif not rest:
                    break
        except zlib.error:
            break
        data = engine.unused_data.lstrip(b"\0")
        left[0] = len(data)


def _pieces(chunks: Iterator[bytes], cut: list[bool]) -> Iterator[str]:
    """The text of chunks in pieces of MAX_LAYER characters that overlap."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    held: list[str] = []
    size = 0
    for chunk in chunks:
        held.append(decoder.decode(chunk))
        size += len(held[-1])
        if size >= MAX_LAYER:
            piece = "".join(held)
            yield piece
            held = [piece[-OVERLAP:]]
            size = len(held[0])
            cut[0] |= UNBROKEN.fullmatch(held[0]) is not None
    held.append(decoder.decode(b"", True))
    if size or held[-1]:
        yield "".join(held)


def _from_base64(layer: Layer, cut: list[bool]) -> Generator[Layer, None, int]:
    """The text in base64, whichever of its first four characters begins it; also through compression.

    Gives the number of characters that were opened.
    """
    run = layer.text.rstrip("=").replace("-", "+").replace("_", "/")
    for skip in range(4):
        body = run[skip:]
        body = body[:len(body) - (len(body) % 4 == 1)]
        if len(body) < 8:
            break
        try:
            data = base64.b64decode(body + "=" * (-len(body) % 4))
        except (ValueError, binascii.Error):
            continue
        text = _plain(data)
        if text is not None:
            places = [(layer.low[skip + j * 4 // 3], layer.high[skip + (j * 8 + 7) // 6]) for j in range(len(data))]
            yield _characters(text, places)
            return len(layer.text)
        left, some = [0], False
        for inner in _pieces(_inflated(data, left), cut):
            some = True
            yield Layer(inner, [layer.low[0]] * len(inner), [layer.high[-1]] * len(inner))
        if some:
            return skip + -(-(len(data) - left[0]) * 4 // 3) if left[0] else len(layer.text)
    return 0


def _joins(lines: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Which neighbouring lines may be one piece of base64: all, all but the outer ones, lines of one width, and each line."""
    count = len(lines)
    if count > 1:
        yield from dict.fromkeys((a, b) for a, b in ((0, count), (1, count), (0, count - 1), (1, count - 1)) if b - a > 1)
        width = [b - a for a, b in lines]
        first = 0
        while first < count:
            last = first + 1
            while last < count and width[last] == width[first]:
                last += 1
            if last < count and width[last] < width[first]:
                yield first, last + 1
            elif last - first > 1:
                yield first, last
            first = last
    yield from ((i, i + 1) for i in range(count))


def _opened(layer: Layer, cut: list[bool]) -> Iterator[Layer]:
    """What a layer holds in encoded form: lines with escapes, and base64."""
    text, at = layer.text, 0
    while m := LINE_WITH_ESCAPE.search(text, at):
        start = text.rfind("\n", 0, m.start()) + 1
        stop = text.find("\n", m.end())
        at = len(text) if stop < 0 else stop
        inner = _unescaped(Layer(text[start:at], layer.low[start:at], layer.high[start:at]))
        if inner is not None:
            yield inner
    for m in LINES.finditer(text):
        lines = [line.span(1) for line in LINE.finditer(text, m.start(), m.end())]
        done = m.start()
        for first, last in _joins(lines):
            part = lines[first:last]
            # A line that was opened together with others is not opened again by itself.
            if part[0][0] < done or (len(part) == 1 and part[0][1] - part[0][0] < 16):
                continue
            low, high = [], []
            for a, b in part:
                low += layer.low[a:b]
                high += layer.high[a:b]
            used = yield from _from_base64(Layer("".join(text[a:b] for a, b in part), low, high), cut)
            for a, b in part if len(part) > 1 else ():
                if used > 0:
                    done = max(done, min(b, a + used))
                    used -= b - a


def find_secrets(text: str) -> tuple[list[Span], set[Span], bool]:
    """Base spans of a text, all spans with those of the layers, and whether a layer was cut."""
    base = scan_text(text)
    spans, cut = set(base), [False]
    seen: set[bytes] = set()
    # A worklist of what is still to be opened; each entry gives one layer at a time.
    work = [_opened(Layer(text, range(len(text)), range(1, len(text) + 1)), cut)]
    while work:
        inner = next(work[-1], None)
        if inner is None:
            work.pop()
            continue
        if not inner.text:
            continue
        place = f"{inner.low[0]}:{inner.high[-1]}:".encode()
        mark = hashlib.blake2b(place + inner.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if mark in seen:
            continue
        seen.add(mark)
        spans |= {(min(inner.low[a:b]), kind, max(inner.high[a:b])) for a, kind, b in scan_text(inner.text)}
        work.append(_opened(inner, cut))
    return base, spans, cut[0]


def span_text(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, layers beyond the text, ``cut``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long, cut boolean"
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns: list[list] = [[] for _ in range(7)]
                for text in part.column(1).to_pylist():
                    base, spans, was_cut = find_secrets(text or "")
                    kinds = [k for _, k, _ in base]
                    row = (
                        kinds.count(0), kinds.count(1), kinds.count(2),
                        hashlib.sha256(span_text(base).encode()).hexdigest(), span_text(spans), len(spans), was_cut,
                    )
                    for column, value in zip(columns, row):
                        column.append(value)
                types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans", "cut"],
                )

    return docs.select("doc_id", "text").mapInArrow(find, schema)
