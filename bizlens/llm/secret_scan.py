"""Operator 4: secret scans with a recursive decoding worklist.

A text is the first layer. Each layer is scanned for the base patterns;
each line in it with percent-encoding or Unicode escapes, and each run that is
base64 (both alphabets) or hexadecimal text, is decoded to a new layer, until no
new layer appears. What stands before a run may belong to its alphabet (a path's
``/``, the ``d`` of ``id``), so a run is read at each of its four (two)
alignments, and a gzip, zlib, bzip2 or xz stream is found wherever in the bytes
it begins. A layer whose content was met before at the same place of the text is
not opened again (cycle detection), so the worklist ends: every new layer is met
once a place, and all but the compressed ones are no longer than their source.
Equal layers at two places are opened at both. A compressed layer, all members
of it, is read in overlapping blocks of about ``MAX_LAYER`` bytes; as all of its
characters come from the same place, a block equal to an earlier one adds
nothing and is read no further. Base64 is also joined over line breaks, and of
bytes that are no text the printable runs (also of UTF-16) are layers.

A layer's characters carry the span of the source characters that they come
from, so each finding is reported where its encoded form stands in the text; one
in a compressed stream from the stream's first character to the end of its run.

Defined results: null text counts as empty; an empty text has no spans; a
finding that maps to the same kind and span twice is one span; repeated rows
are scanned one by one; empty tables give empty results.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bizlens.llm.common import documents, py_texts, slices

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a whole run of 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

PERCENT = re.compile(r"%[0-9A-Fa-f]{2}")
#: Percent-encoding and escapes are undone by lines, as what they hide may hold spaces.
LINE = re.compile(r"[^\n]+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}={0,2}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]{20,}")
RUN = re.compile("[A-Za-z0-9+/_-]+")
#: A run that ends its line, and the lines of base64 alone that follow it.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}+(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+(?=[ \t=]*\r?(?:\n|\Z)))+")
#: What a layer of other bytes is searched for; all that is looked for is ASCII, of 12 characters at least.
PRINTABLE = re.compile(rb"[\t\r\n\x20-\x7e]{12,}")
UTF16_LE, UTF16_BE = re.compile(rb"(?:[\t\r\n\x20-\x7e]\0){12,}"), re.compile(rb"(?:\0[\t\r\n\x20-\x7e]){12,}")
IN_BASE64 = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"))
STREAM = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
MAX_LAYER, OVERLAP, READ = 8 << 20, 1 << 20, 256 << 10


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    out = []
    low = text.lower() if not text.isascii() else text.casefold()
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


@dataclass
class Layer:
    """Text, and for each character the span of the document it comes from
    (None: the document itself)."""

    text: str
    start: np.ndarray | None = None
    end: np.ndarray | None = None
    depth: int = 0

    def span(self, lo: int, hi: int) -> tuple[int, int]:
        if self.start is None:
            return lo, hi
        return int(self.start[lo:hi].min()), int(self.end[lo:hi].max())


def _decoder(data: bytes):
    if data[:2] == b"\x1f\x8b" or len(data) > 2 and data[0] == 0x78 and data[1] in (0x01, 0x5E, 0x9C, 0xDA):
        return zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if data[:6] == b"\xfd7zXZ\x00" else None


def _inflate(data: bytes, at: int, size: int) -> Generator[bytes, None, int]:
    """The content of the compressed streams that follow each other from ``at`` on, in
    pieces of at most ``size`` bytes, as far as they can be read; returns where the
    last whole one ends."""
    whole = at
    while (d := _decoder(data[at : at + 6])) is not None:
        tail = b""
        try:
            while not d.eof:
                if not tail and getattr(d, "needs_input", True):
                    tail = data[at : at + READ]
                    at += len(tail)
                out = d.decompress(tail, size)
                if out:
                    yield out
                elif not tail:
                    return whole  # the stream is cut short
                tail = getattr(d, "unconsumed_tail", b"")
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            return whole
        at -= len(d.unused_data)
        whole = at
        while data[at : at + 1] == b"\0":
            at += 1
    return whole


def _blocks(data: bytes, at: int) -> Generator[bytes, None, int]:
    """Inflated content in different blocks; each begins with the last ``OVERLAP`` bytes
    of its predecessor, at a whole group of four of a run of base64."""
    held, new, met = b"", 0, set()
    pieces = _inflate(data, at, MAX_LAYER // 2)
    while True:
        try:
            piece = next(pieces)
        except StopIteration as stop:
            end = stop.value
            break
        held, new = held + piece, new + len(piece)
        if len(held) >= MAX_LAYER:
            if (key := hashlib.blake2b(held, digest_size=16).digest()) not in met:
                met.add(key)
                yield held
            cut = len(held) - OVERLAP
            other = np.flatnonzero(~IN_BASE64[np.frombuffer(held, np.uint8, cut)])
            cut -= (cut - (int(other[-1]) + 1 if len(other) else 0)) % 4
            held, new = held[cut:], 0
    if new:
        yield held
    return end


def _as_text(data: bytes) -> str | None:
    """Bytes that are printable UTF-8 text."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    head = text[:4096]
    odd = len(head) - sum(map(str.isprintable, head)) - sum(map(head.count, "\t\r\n"))
    return text if text and odd * 20 <= len(head) else None


def _texts(data: bytes) -> Iterator[tuple[str, int, int]]:
    """(text, first byte, bytes a character or 0 for UTF-8) of the text in some
    bytes: all of it, or its printable runs, and its runs of UTF-16."""
    text = _as_text(data)
    if text is not None:
        yield text, 0, 0
    else:
        for m in PRINTABLE.finditer(data):
            yield m.group().decode("ascii"), m.start(), 1
    if b"\0" in data:
        for pattern, first in ((UTF16_LE, 0), (UTF16_BE, 1)):
            for m in pattern.finditer(data):
                yield m.group()[first::2].decode("ascii"), m.start(), 2


def _inflated(layer: Layer, data: bytes, at: np.ndarray, num: int, den: int) -> Generator[Layer, None, None]:
    """The texts of all compressed streams in some bytes."""
    last = int(at[-1]) + 1

    def opened(first: int) -> Generator[Layer, None, int]:
        a, b = layer.span(int(at[first * num // den]), last)
        blocks = _blocks(data, first)
        while True:
            try:
                block = next(blocks)
            except StopIteration as stop:
                return stop.value
            for text, _, _ in _texts(block):  # a compressed character depends on the whole stream
                yield Layer(text, np.broadcast_to(np.int64(a), len(text)), np.broadcast_to(np.int64(b), len(text)), layer.depth + 1)

    m = STREAM.search(data)
    while m:
        end = yield from opened(m.start())
        m = STREAM.search(data, max(m.start() + 1, end))


def _byte_layers(layer: Layer, data: bytes, at: np.ndarray, num: int, den: int) -> Iterator[Layer | Iterator[Layer]]:
    """The layers of bytes whose byte i was written by characters from at[i * num / den] on."""
    if STREAM.search(data) and _as_text(data) is None:
        yield _inflated(layer, data, at, num, den)
    for text, first, wide in _texts(data):
        if wide:
            width = np.full(len(text), wide, np.int64)
        else:
            width = np.array([len(c.encode()) for c in text]) if not text.isascii() else np.ones(len(text), np.int64)
        stop = first + np.cumsum(width)
        a = at[(stop - width) * num // den]
        b = at[np.minimum(-(-stop * num // den), len(at)) - 1] + 1
        if layer.start is not None:
            a, b = layer.start[a], layer.end[b - 1]
        yield Layer(text, a, b, layer.depth + 1)


def _base64(layer: Layer, run: str, at: np.ndarray) -> Iterator[Layer | Iterator[Layer]]:
    """The layers of a run of base64 at each of the four places where a group of four may begin."""
    run = run.replace("-", "+").replace("_", "/")
    for first in range(4):
        stop = len(run) - ((len(run) - first) % 4 == 1)
        if stop - first >= 8:
            data = binascii.a2b_base64(run[first:stop] + "=" * (-(stop - first) % 4))
            yield from _byte_layers(layer, data, at[first:stop], 4, 3)


def _wrapped(text: str) -> Iterator[tuple[str, np.ndarray]]:
    """Runs of base64 over several lines, and the places of their characters: all
    of each, and its parts of lines of one length with a last line no longer."""
    for m in WRAPPED.finditer(text):
        lines = [(k.start(), k.end()) for k in RUN.finditer(text, m.start(), m.end())]
        groups, first = [(0, len(lines))], 0
        for k in range(1, len(lines) + 1):
            size = lines[first][1] - lines[first][0]
            if k == len(lines) or lines[k - 1][1] - lines[k - 1][0] != size or lines[k][1] - lines[k][0] > size:
                if k - first > 1:
                    groups.append((first, k))
                first = k
        for lo, hi in dict.fromkeys(groups):
            run, at = "".join(text[a:b] for a, b in lines[lo:hi]), np.concatenate([np.arange(a, b) for a, b in lines[lo:hi]])
            yield run, at


def _unescaped(layer: Layer, lo: int, hi: int) -> Layer:
    """A line with each escape replaced by its character."""
    chars, starts, ends, at = [], [], [], lo
    for m in ESCAPE.finditer(layer.text, lo, hi):
        chars += [layer.text[at : m.start()], _escaped(m)]
        starts += [*range(at, m.start()), m.start()]
        ends += [*range(at + 1, m.start() + 1), m.end()]
        at = m.end()
    chars.append(layer.text[at:hi])
    a, b = np.array([*starts, *range(at, hi)], np.int64), np.array([*ends, *range(at + 1, hi + 1)], np.int64)
    if layer.start is not None:
        a, b = layer.start[a], layer.end[b - 1]
    return Layer("".join(chars), a, b, layer.depth + 1)


def _percent(layer: Layer, lo: int, hi: int) -> Layer:
    """A line with its percent-encoded bytes decoded; several may make one character."""
    raw, starts, ends, at = bytearray(), [], [], lo

    def plain(stop: int) -> None:
        for k in range(at, stop):
            c = layer.text[k].encode("utf-8", "surrogatepass")
            raw.extend(c)
            starts.extend([k] * len(c))
            ends.extend([k + 1] * len(c))

    for m in PERCENT.finditer(layer.text, lo, hi):
        plain(m.start())
        raw.append(int(m.group()[1:], 16))
        starts.append(m.start())
        ends.append(m.end())
        at = m.end()
    plain(hi)
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        text = raw.decode("latin-1")
        first = np.arange(len(raw))
        last = first
    else:
        width = np.array([len(c.encode()) for c in text], np.int64)
        stop = np.cumsum(width)
        first, last = stop - width, stop - 1
    a, b = np.array(starts)[first], np.array(ends)[last]
    if layer.start is not None:
        a, b = layer.start[a], layer.end[b - 1]
    return Layer(text, a, b, layer.depth + 1)


def _escaped(m: re.Match) -> str:
    code = int(next(g for g in m.groups() if g), 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"


def _opened(layer: Layer) -> Iterator[Layer | Iterator[Layer]]:
    text = layer.text
    for mark, pattern, undo in (("%", PERCENT, _percent), ("\\", ESCAPE, _unescaped)):
        if mark in text:
            for m in LINE.finditer(text):
                if pattern.search(text, m.start(), m.end()):
                    yield undo(layer, m.start(), m.end())
    for m in BASE64.finditer(text):
        run = m.group().rstrip("=")
        if not (run.isalpha() and (run.islower() or run[1:].islower())):  # a plain word
            yield from _base64(layer, run, np.arange(m.start(), m.start() + len(run)))
    for run, at in _wrapped(text):
        yield from _base64(layer, run, at)
    for m in HEX_RUN.finditer(text):
        for first in (m.start(), m.start() + 1):
            stop = m.end() - (m.end() - first) % 2
            yield from _byte_layers(layer, bytes.fromhex(text[first:stop]), np.arange(first, stop), 2, 1)


def _place(layer: Layer) -> bytes:
    """A layer's content and the place of each of its characters, as a key."""
    h = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16)
    for x in (layer.start, layer.end):
        h.update((x if any(x.strides) else x[:1]).astype(np.int64).tobytes())  # one place of all characters: once
    return h.digest()


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Base spans, all spans (start, kind, end) and the number of layers opened."""
    base = base_spans(text)
    found, seen, work, layers = set(base), set(), [Layer(text)], 0
    while work:
        layer = work.pop()
        if isinstance(layer, Layer):
            opened = _opened(layer)
        else:  # an inflated stream: its next block, and then the rest
            opened = [*itertools.islice(layer, 1)]
            if opened:
                work.append(layer)
        for inner in opened:
            if not isinstance(inner, Layer):
                work.append(inner)
                continue
            if (key := _place(inner)) in seen:
                continue
            seen.add(key)
            layers += 1
            for lo, kind, hi in base_spans(inner.text):
                a, b = inner.span(lo, hi)
                found.add((a, kind, b))
            work.append(inner)
    return base, sorted(found), layers


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_assign``, ``n_access``, ``n_hex`` and
    ``base_spans`` (of the plain text), ``spans`` (with those of decoded layers)
    and ``layers`` (how many were opened)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(1)):
                made = [scan(t) for t in py_texts(b.column(1).slice(lo, hi - lo))]
                counts = [pa.array([sum(s[1] == k for s in m[0]) for m in made], pa.int64()) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), *counts, pa.array([written(m[0]) for m in made], pa.string()),
                     pa.array([written(m[1]) for m in made], pa.string()), pa.array([m[2] for m in made], pa.int64())],
                    ["id", "n_assign", "n_access", "n_hex", "base_spans", "spans", "layers"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, base_spans string, spans string, layers long"
                           ).withColumnRenamed("id", id_col)


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "layers")
