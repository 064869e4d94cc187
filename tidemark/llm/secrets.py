"""Secret scans through nested encodings.

Each text is the first layer of a worklist. A layer is scanned, then everything encoded in it (URL
escapes, Unicode escapes, base64, compressed data) is unwrapped into further layers, until no layer
gives a new one. Layers seen before are not opened again, so cycles end. Each layer knows which span
of the original text each of its characters comes from.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.common import column, whole_text

# The kinds of secrets in the order they are listed in, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
# A failing match of these two kinds has no passing one inside, so their least lengths may be
# written into the patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6

_ESCAPED_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPED_POINTS = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Base64 over several lines; a line break may itself be escaped.
_BREAK = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*")
_WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{{4,}}+{_BREAK.pattern})+[A-Za-z0-9+/_-]+={{0,2}}")
#: Starts of gzip, zlib, bzip2, xz and Zstandard data.
_PACKED = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: What any secret or further layer has; bytes without it can add nothing.
_WORTH = re.compile(rb"[A-Za-z0-9+/_-]{16}|[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6}|%[0-9A-Fa-f]{2}|\\|&#|[A-Za-z0-9+/_-]{4}[ \t]*\r?\n")
_DAMAGED = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError)
_NAMED = r"\\[\\'\"abfnrtv0]|[ -\[\]-~]"
_NAMES = {"\\" + c: v for c, v in zip("abfnrtv0", (7, 8, 12, 10, 13, 9, 11, 0))}
#: Runs in which compressed data may be written: mark, run, one byte of it.
_BYTE_RUNS = (
    ("%", re.compile(r"(?:%[0-9A-Fa-f]{2}|[!-$&-~])+"), re.compile(r"%([0-9A-Fa-f]{2})|[!-$&-~]")),
    ("\\x", re.compile(rf"(?:\\x[0-9A-Fa-f]{{2}}|{_NAMED})+"), re.compile(rf"\\x([0-9A-Fa-f]{{2}})|{_NAMED}")),
    ("\\u00", re.compile(rf"(?:\\u00[0-9A-Fa-f]{{2}}|{_NAMED})+"), re.compile(rf"\\u00([0-9A-Fa-f]{{2}})|{_NAMED}")),
)
#: A layer that unpacks to more than this is read in overlapping chunks and counted in ``n_unopened``.
MAX_LAYER_BYTES = 64 << 20

Found = set[tuple[str, int, int]]


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """Base matches of one layer: kind, start, end in code points."""
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= LEAST_ASSIGNED:
            yield "assign", m.start(), m.end()
    for m in ACCESS.finditer(text):
        yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


class Layer:
    """Text with the original span of its characters. ``cuts`` lists, for a layer decoded in place,
    ``(start here, start there, end there or None)``: from each start on, characters come one by one
    (end None) or all from the span given. A layer from one encoded segment has a single cut."""

    __slots__ = ("text", "path", "cuts", "starts")

    def __init__(self, text: str, path: str, cuts: list[tuple[int, int, int | None]]):
        self.text, self.path, self.cuts = text, path, cuts
        self.starts = [c[0] for c in cuts]

    def origin(self, start: int, end: int) -> tuple[int, int]:
        """The span of the original text that characters ``start..end`` come from."""
        here, there, until = self.cuts[bisect_right(self.starts, start) - 1]
        first = there if until is not None else there + start - here
        here, there, until = self.cuts[bisect_right(self.starts, end - 1) - 1]
        return first, until if until is not None else there + end - here

    def inside(self, decoder: str) -> str:
        return f"{self.path}{decoder}/"


def _replaced(layer: Layer, pattern: re.Pattern, decode, name: str) -> Layer | None:
    """The layer with all matches of ``pattern`` decoded in place; None if nothing changes."""
    out, cuts, size, at = [], [], 0, 0

    def plain(upto: int) -> None:
        nonlocal size
        # Cuts of the parent that begin inside the copied part go over with it.
        for k, (here, there, until) in enumerate(layer.cuts):
            stop = layer.cuts[k + 1][0] if k + 1 < len(layer.cuts) else len(layer.text)
            low, high = max(here, at), min(stop, upto)
            if low < high:
                cuts.append((size + low - at, there if until is not None else there + low - here, until))
        out.append(layer.text[at:upto])
        size += upto - at

    for m in pattern.finditer(layer.text):
        text = decode(m[0])
        if not text:
            continue
        if m.start() > at:
            plain(m.start())
        first, last = layer.origin(m.start(), m.end())
        cuts.append((size, first, last))
        out.append(text)
        size += len(text)
        at = m.end()
    if not out:
        return None
    if at < len(layer.text):
        plain(len(layer.text))
    return Layer("".join(out), layer.inside(name), cuts)


def _bytes_text(raw: bytes) -> str:
    """Bytes that are not UTF-8 are read one by one: all patterns are ASCII."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _escaped_bytes(run: str) -> str:
    return _bytes_text(bytes.fromhex(run.replace("%", "")))


def _escaped_points(run: str) -> str | None:
    if run.startswith("&#"):
        point = int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])
    elif run.startswith("\\x"):
        return _bytes_text(bytes.fromhex(run.replace("\\x", "")))
    elif run.startswith("\\u{"):
        point = int(run[3:-1], 16)
    elif run.startswith("\\U"):
        point = int(run[2:], 16)
    else:  # UTF-16 units, pairs of surrogates included
        return bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", "replace")
    return chr(point) if point < 0x110000 and not 0xD800 <= point < 0xE000 else None


class Unpacked(bytes):
    """Content of compressed data; ``end`` is where that ended, None if it broke off."""

    end: int | None = None


def _decompressor(head: bytes):
    """Makes the decompressor of the data that begins so; None for other data."""
    if head[:2] == b"\x1f\x8b":
        return _GZIP
    if head[:1] == b"x" and len(head) > 2 and int.from_bytes(head[:2]) % 31 == 0:
        return zlib.decompressobj
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor
    return _ZSTD if head[:4] == b"\x28\xb5\x2f\xfd" else None


def _GZIP():
    return zlib.decompressobj(zlib.MAX_WBITS | 16)


def _ZSTD():
    return zstandard.ZstdDecompressor().decompressobj()


def _member(raw, at: int, new, step: int) -> Iterator[bytes]:
    """Content of one member or frame in pieces; returns its end, None if the data ends before."""
    packed, piece = new(), min(1 << 20, MAX_LAYER_BYTES + 1)
    while at < len(raw):
        data = raw[at : at + step]
        at += len(data)
        while True:
            out = packed.decompress(data) if new is _ZSTD else packed.decompress(data, piece)
            if out:
                yield out
            if packed.eof:
                return at - len(packed.unused_data)
            data = getattr(packed, "unconsumed_tail", b"")
            if new is _ZSTD or len(out) < piece and not data:
                break
    return None


def _stream(raw) -> Iterator[bytes]:
    """Content of all members or frames at the start of ``raw`` in pieces, of a damaged one as far
    as it goes; returns the end of the last, None if it breaks off."""
    at, end = 0, None
    new = _decompressor(bytes(raw[:6]))
    while new is not None and _decompressor(bytes(raw[at : at + 6])) is new:
        given = 0
        try:
            member = _member(raw, at, new, 64 if new is _ZSTD else 4096)
            while True:
                try:
                    out = next(member)
                except StopIteration as stop:
                    end = stop.value
                    break
                given += len(out)
                yield out
        except _DAMAGED:
            try:  # byte by byte, for what came before the damage
                for out in _member(raw, at, new, 1):
                    if len(out) > given:
                        yield out[given:]
                    given = max(0, given - len(out))
            except _DAMAGED:
                pass
            return None
        if end is None:
            return None
        at = end
        while at < len(raw) and raw[at] == 0:  # padding between members
            at += 1
    return end


def _unpack(raw) -> Unpacked | None:
    """Content of the gzip, zlib, bzip2, xz or Zstandard data at the start of ``raw``, all members;
    None for other data. It stops in the piece that passes ``MAX_LAYER_BYTES``."""
    out, end, stream = bytearray(), None, _stream(raw)
    while len(out) <= MAX_LAYER_BYTES:
        try:
            out += next(stream)
        except StopIteration as stop:
            end = stop.value
            break
    if not out:
        return None
    content = Unpacked(out)
    content.end = end
    return content


def _chunks(raw) -> Iterator[bytes]:
    """The content of ``_stream`` in chunks that overlap."""
    held, lap = bytearray(), min(1 << 16, MAX_LAYER_BYTES // 4)
    for piece in _stream(raw):
        held += piece
        if len(held) > MAX_LAYER_BYTES:
            yield bytes(held)
            del held[:-lap]
    yield bytes(held)


def _opened(raw, path: str, span: tuple[int, int], own: bool) -> Iterator[tuple[Layer | Iterator | None, bool]]:
    """The layers of decoded bytes: their text, and the content of all compressed data in them,
    wherever it starts. A layer above ``MAX_LAYER_BYTES`` is an iterator of the layers of its chunks.
    With ``own`` false, a text that can add nothing is left out. True marks what is counted."""
    todo = deque([(raw, path)])
    while todo:
        raw, path = todo.popleft()
        if path.count("packed/") > 64:  # data that unpacks to new data again and again
            yield None, True
            continue
        at, whole, view = 0, False, memoryview(raw)
        starts = _PACKED.finditer(raw)
        while at is not None and at < len(raw):
            inner = _unpack(view[at:] if at else raw)
            end = None
            if inner is not None and inner != raw:
                end = getattr(inner, "end", len(raw))
                whole = whole or (at == 0 and end == len(raw))
                if len(inner) > MAX_LAYER_BYTES:
                    yield _large(view[at:], f"{path}packed/", span), True
                else:
                    todo.append((bytes(inner), f"{path}packed/"))
            # Data that breaks off may be none at all, and hide the start of other data.
            least = at + 1 if end is None else at + max(1, end)
            at = next((m.start() for m in starts if m.start() >= least), None)
        if not whole and (own or path.endswith("packed/") or _WORTH.search(raw)):
            yield Layer(_bytes_text(raw), path, [(0, *span)]), False


def _large(raw, path: str, span: tuple[int, int]) -> Iterator[tuple[Layer | Iterator | None, bool]]:
    for chunk in _chunks(raw):
        yield from _opened(chunk, path, span, True)


def _codes(layer: Layer) -> Iterator[tuple[int, int, str]]:
    """Base64 segments, in one line and over line breaks: start, end, characters."""
    for m in _BASE64.finditer(layer.text):
        yield m.start(), m.end(), m[0]
    for m in _WRAPPED.finditer(layer.text):
        code = _BREAK.sub("", m[0])
        if len(code) >= 16:
            yield m.start(), m.end(), code


def _byte_runs(text: str) -> Iterator[tuple[list[int], bytes]]:
    """Runs of escaped and plain bytes that hold compressed data: where each byte starts in the
    text, then the end of the last; and the bytes."""
    for mark, run, one in _BYTE_RUNS:
        if mark not in text:
            continue
        for m in run.finditer(text):
            if mark not in m[0]:
                continue
            parts = list(one.finditer(text, m.start(), m.end()))
            raw = bytes(int(p[1], 16) if p[1] else _NAMES.get(p[0], ord(p[0][-1])) for p in parts)
            if _PACKED.search(raw):
                yield [*(p.start() for p in parts), m.end()], raw


def _segments(layer: Layer) -> Iterator[tuple[Layer | Iterator | None, bool]]:
    """Layers from the base64 segments of a layer, read from each of the first four characters as
    other text may precede, and from runs of escaped bytes, compressed content unpacked; and
    whether a layer is counted as too large."""
    for start, end, code in _codes(layer):
        code = code.rstrip("=").replace("-", "+").replace("_", "/")
        span = layer.origin(start, end)
        for skip in range(4):
            part = code[skip:]
            part = part[:-1] if len(part) % 4 == 1 else part
            raw = base64.b64decode(part + "=" * (-len(part) % 4))
            if raw:
                yield from _opened(raw, layer.inside("base64"), span, not skip)
    for starts, raw in _byte_runs(layer.text):
        first = _PACKED.search(raw).start()
        span = layer.origin(starts[first], starts[-1])
        for found, large in _opened(raw[first:], layer.inside("bytes"), span, False):
            # The text of the run itself is decoded in place.
            if not isinstance(found, Layer) or found.path.endswith("packed/"):
                yield found, large


def unwrap(text: str) -> tuple[list[tuple[str, int, int]], Found, int, int]:
    """Base matches of ``text``; matches that decoded layers add; number of layers; layers too large
    to be held whole or nested too deep."""
    base = list(scan(text))
    known = {(k, a, b) for k, a, b in base}
    added: Found = set()
    refused, layers = 0, 1
    seen = {hashlib.blake2b(text.encode(), digest_size=16).digest()}

    def new(child: Layer) -> bool:
        nonlocal layers
        first = child.cuts[0][1:] if len(child.cuts) == 1 else ("whole",)
        mark = hashlib.blake2b(f"{first}:{child.text}".encode(), digest_size=16).digest()
        if mark in seen:
            return False
        seen.add(mark)
        layers += 1
        for kind, start, end in scan(child.text):
            span = child.origin(start, end)
            if (kind, *span) not in known:
                known.add((kind, *span))
                added.add((child.path + kind, *span))
        return True

    def drain(work: deque) -> None:
        nonlocal refused
        while work:
            layer = work.popleft()
            if not isinstance(layer, Layer):  # chunks, each with all it holds before the next
                for child, large in layer:
                    refused += large
                    if child is not None and (not isinstance(child, Layer) or new(child)):
                        drain(deque([child]))
                continue
            children = [
                _replaced(layer, _ESCAPED_BYTES, _escaped_bytes, "url") if "%" in layer.text else None,
                _replaced(layer, _ESCAPED_POINTS, _escaped_points, "unicode") if "\\" in layer.text or "&#" in layer.text else None,
            ]
            for child, large in _segments(layer):
                refused += large
                children.append(child)
            for child in children:
                if child is not None and (not isinstance(child, Layer) or new(child)):
                    work.append(child)

    drain(deque([Layer(text, "", [(0, 0, None)])]))
    return base, added, layers, refused


def _order(found: tuple[str, int, int]) -> tuple:
    kind, start, end = found
    return start, KINDS.index(kind) if kind in KINDS else len(KINDS), kind, end


def _join(found) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=_order))


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64())]
    + [("base_sha256", pa.string()), ("spans", pa.string())]
    + [("n_added", pa.int64()), ("n_layers", pa.int64()), ("n_unopened", pa.int64())]
)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts and spans of secrets in the whole text.

    ``spans`` lists base matches as ``kind:start:end`` and matches found in decoded layers as
    ``path/kind:start:end``, where path names the decoders and the span is that of the encoded
    characters in the original text; a decoded match of the same kind and span as another is not
    repeated. A null text counts as empty; ids may be null or repeat; other columns are not read.
    No shuffle; a task holds one Arrow batch and the layers of one text.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                base, added, layers, refused = unwrap(text.as_py())
                row = {"doc_id": doc_id} | {f"n_{k}": sum(b[0] == k for b in base) for k in KINDS}
                row["base_sha256"] = hashlib.sha256(_join(base).encode()).hexdigest()
                row["spans"] = _join([*base, *added])
                out.append(row | {"n_added": len(added), "n_layers": layers, "n_unopened": refused})
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    rows = docs.select(
        column(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")
    )
    return rows.mapInArrow(
        work,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
        "n_added long, n_layers long, n_unopened long",
    )
