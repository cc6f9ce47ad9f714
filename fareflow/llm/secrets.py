"""Secrets in texts, also under nested URL, Unicode, base64 and compressed layers.

Every text is a root layer. A worklist takes layers one by one: it scans the layer,
maps what it finds back to code points of the root, and adds the layers that decoding
yields. URL and Unicode escapes are decoded in place, so their findings keep exact
places; base64 and compressed regions become layers whose findings take the region's
place. Decoding an escape or base64 shrinks a text, so only decompression could go on
for ever; a layer that was seen at the same place is not taken again. A base64 region that
cannot be read whole is cut at its lines, at what begins compressed data, and at all four
offsets, where every stretch of ASCII is a layer.
"""

import base64
import binascii
import bz2
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from urllib.parse import unquote_to_bytes

import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.common import table

# The kinds of secrets in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "oversize")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH = 6

# A layer that unpacks to more is reported, as kind `oversize`, and scanned in windows of
# that size that overlap.
MAX_LAYER_BYTES = 64 << 20
OVERLAP = 1 << 16

FINDINGS = T.ArrayType(
    T.StructType().add("kind", "string").add("start", "long").add("end", "long").add("depth", "integer").add("via", "string")
)

# The shortest secret has 12 bytes, so 16 characters of base64.
BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/])(?:(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]{1,76}|[A-Za-z0-9+/]{16,})={0,2}"
)
BASE64_URL = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9]*[_-])[A-Za-z0-9_-]{16,}={0,2}")
# How compressed data begins in base64: gzip, zlib, zstandard, bzip2, xz.
PACKED = re.compile(r"H4sI|eAE|eF4|eJ[w-z]|eN[o-r]|KLUv|Qlpo|/Td6")
# The shortest secret's bytes; what else a region holds need not be text.
STRETCH = re.compile(rb"[\t\n\r\x20-\x7e]{12,}")
PERCENT = re.compile(r"%[0-7][0-9A-Fa-f]|(?:%[89A-Fa-f][0-9A-Fa-f])+")
UNICODE = re.compile(
    r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}"
    r"|\\U[0-9A-Fa-f]{8}|\\x[0-7][0-9A-Fa-f]|(?:\\x[89A-Fa-f][0-9A-Fa-f])+|%u[0-9A-Fa-f]{4}"
    r"|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"
)
PACKED_PERCENT = re.compile(
    r"(?:%1[fF]%8[bB]|(?:x|%78)(?:%01|%5[eE]|\^|%9[cC]|%[dD][aA])|(?:%28|\()%[bB]5(?:%2[fF]|/)%[fF][dD])"
    r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9\-._~/()])*"
)
PACKED_HEX = re.compile(r"(?:\\x[0-9A-Fa-f]{2}){8,}")


class Oversize(Exception):
    """With the compressed bytes, and the way to them."""


class Layer:
    """A text and how its code points lie in the layer it came from."""

    def __init__(self, text: str, parent: "Layer | None" = None, pieces: list | None = None, via: str = ""):
        self.text, self.parent = text, parent
        self.pieces = pieces or []  # (start here, start and end in the parent, whether character by character)
        self.starts = [p[0] for p in self.pieces]
        self.depth = parent.depth + 1 if parent else 0
        self.via = f"{parent.via}>{via}" if parent and parent.via else via

    def in_root(self, start: int, end: int) -> tuple[int, int]:
        if self.parent is None:
            return start, end
        first = self.pieces[bisect_right(self.starts, start) - 1]
        last = self.pieces[bisect_right(self.starts, end - 1) - 1]
        begin = first[1] + (start - first[0]) * first[3]
        stop = last[1] + end - last[0] if last[3] else last[2]
        return self.parent.in_root(begin, stop)


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
                yield "assign", m.start(), m.end()
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def _inflate(data: bytes) -> bytes | None:
    """`data` decompressed once, or None; a truncated stream gives what it holds."""
    limit = MAX_LAYER_BYTES + 1
    try:
        if data[:2] == b"\x1f\x8b":
            out = zlib.decompressobj(31).decompress(data, limit)
        elif data[:1] == b"\x78" and len(data) > 2 and (data[0] * 256 + data[1]) % 31 == 0:
            out = zlib.decompressobj(15).decompress(data, limit)
        elif data[:4] == b"\x28\xb5\x2f\xfd":
            with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as reader:
                out = reader.read(limit)
        elif data[:3] == b"BZh":
            out = bz2.BZ2Decompressor().decompress(data, limit)
        elif data[:6] == b"\xfd7zXZ\x00":
            out = lzma.LZMADecompressor().decompress(data, limit)
        else:
            return None
    except (zlib.error, zstandard.ZstdError, OSError, EOFError, lzma.LZMAError, ValueError):
        return None
    if len(out) >= limit:
        raise Oversize
    return out


def _windows(data: bytes) -> Iterator[str]:
    """What `data` unpacks to, in windows; as far as it can be unpacked."""
    step = max(1, MAX_LAYER_BYTES - OVERLAP)
    if data[:4] == b"\x28\xb5\x2f\xfd":
        read = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read
    elif data[:3] == b"BZh" or data[:1] == b"\xfd":
        inner = bz2.BZ2Decompressor() if data[:3] == b"BZh" else lzma.LZMADecompressor()
        rest = iter((data,))
        read = lambda size: b"" if inner.eof else inner.decompress(next(rest, b""), size)
    else:
        stream, left = zlib.decompressobj(31 if data[:1] == b"\x1f" else 15), [data]

        def read(size: int) -> bytes:
            made = stream.decompress(left[0], size)
            left[0] = stream.unconsumed_tail
            return made

    held = b""
    try:
        while made := read(step):
            held = held[-OVERLAP:] + made
            yield held.decode("utf-8", "replace")
    except (zlib.error, zstandard.ZstdError, OSError, EOFError, lzma.LZMAError, ValueError):
        return


def _readable(data: bytes) -> tuple[str, str] | None:
    """(text, way) of bytes that are text or, after any number of decompressions, become it but for bytes that are none."""
    way, seen = "", set()
    try:
        while (inner := _inflate(data)) is not None and inner not in seen:
            seen.add(inner)
            data, way = inner, f"{way}>compressed"
    except Oversize:
        raise Oversize(data, f"{way}>compressed") from None
    try:
        return data.decode("utf-8", "replace" if way else "strict"), way
    except UnicodeDecodeError:
        return None


def _percent(run: str) -> str | None:
    try:
        return bytes.fromhex(run.replace("%", "")).decode("utf-8")
    except UnicodeDecodeError:
        return None


def _escape(run: str) -> str | None:
    try:
        if run.startswith("\\x"):
            return bytes.fromhex(run.replace("\\x", "")).decode("utf-8")
        if len(run) == 12:
            return bytes.fromhex(run[2:6] + run[8:]).decode("utf-16-be")
        if run.startswith("&#"):
            digits = run[2:-1]
            code = int(digits[1:], 16) if digits[0] in "xX" else int(digits)
        else:
            code = int(run[2:].strip("{}"), 16)
        return None if 0xD800 <= code < 0xE000 else chr(code)
    except (ValueError, OverflowError):
        return None


def _in_place(layer: Layer, pattern: re.Pattern, decode: Callable[[str], str | None], via: str) -> Layer | None:
    out, pieces, here, done = [], [], 0, 0
    for m in pattern.finditer(layer.text):
        if (plain := decode(m.group())) is None:
            continue
        if m.start() > done:
            pieces.append((here, done, m.start(), True))
            out.append(layer.text[done : m.start()])
            here += m.start() - done
        if plain:
            pieces.append((here, m.start(), m.end(), False))
            out.append(plain)
            here += len(plain)
        done = m.end()
    if not done:
        return None
    pieces.append((here, done, len(layer.text), True))
    out.append(layer.text[done:])
    return Layer("".join(out), layer, pieces, via)


def _base64(run: str) -> bytes | None:
    joined = re.sub(r"[\r\n=]", "", run).replace("-", "+").replace("_", "/")
    if len(joined) % 4 == 1:
        return None
    try:
        return base64.b64decode(joined + "=" * (-len(joined) % 4))
    except (binascii.Error, ValueError):
        return None


def _read(data: bytes | None) -> tuple[str, str] | Oversize | None:
    try:
        return _readable(data) if data else None
    except Oversize as large:
        return large


Found = tuple[int, int, tuple[str, str] | Oversize]


def _cut(start: int, run: str) -> Iterator[Found]:
    """(start, end, what is read there) of a base64 match: it is read whole, else by its lines, else wherever text is in it."""
    if (plain := _read(_base64(run))) is not None:
        yield start, start + len(run), plain
        return
    cut = run.rfind("\n")
    if cut >= 0:
        body = run[:cut].rstrip("\r")
        if (plain := _read(_base64(body))) is not None:
            yield start, start + len(body), plain
            if len(run) - cut > 16:
                yield from _cut(start + cut + 1, run[cut + 1 :])
            return
    # Where each character of the joined lines stands.
    at = [k for k, c in enumerate(run) if c not in "\r\n="]
    joined = "".join(run[k] for k in at)
    alphabet = joined.replace("-", "+").replace("_", "/")
    for m in PACKED.finditer(alphabet):
        rest = alphabet[m.start() :]
        plain = _read(_base64(rest[:-1] if len(rest) % 4 == 1 else rest))
        if isinstance(plain, Oversize) or plain and plain[1]:
            yield start + at[m.start()], start + len(run), plain
    for offset in range(4):
        rest = alphabet[offset:]
        data = _base64(rest[:-1] if len(rest) % 4 == 1 else rest) or b""
        for m in STRETCH.finditer(data):
            low = offset + m.start() // 3 * 4 + (0, 2, 3)[m.start() % 3]
            first = m.start()
            # A region that follows a word or path begins after a sign, with a whole group.
            for k in range(offset + -(-m.start() // 3) * 4, offset + (m.end() - 12) // 3 * 4 + 1, 4):
                if k and not joined[k - 1].isalnum():
                    low, first = k, (k - offset) // 4 * 3
                    break
            high = offset + (m.end() * 4 + 2) // 3
            end = start + at[min(high, len(at)) - 1] + 1
            if high >= len(at):
                end = start + len(run)
            yield start + at[low], end, (data[first : m.end()].decode(), "")


def _regions(layer: Layer) -> Iterator[tuple[int, int, tuple[str, str] | Oversize, str]]:
    text = layer.text
    for pattern in (BASE64, BASE64_URL):
        for m in pattern.finditer(text):
            for start, end, plain in _cut(m.start(), m.group()):
                yield start, end, plain, "base64"
    packed = []
    if "%" in text:
        packed += [(m, unquote_to_bytes(m.group()), "url") for m in PACKED_PERCENT.finditer(text)]
    if "\\x" in text:
        packed += [(m, bytes.fromhex(m.group().replace("\\x", "")), "unicode") for m in PACKED_HEX.finditer(text)]
    for m, data, via in packed:
        if (plain := _read(data)) is not None:
            yield m.start(), m.end(), plain, via


def _decoded(layer: Layer) -> Iterator[Layer]:
    """The layers one step below; raises nothing: an oversize region comes as a layer without text, then in windows."""
    text = layer.text
    if "%" in text and (child := _in_place(layer, PERCENT, _percent, "url")):
        yield child
    if ("\\" in text or "&#" in text or "%u" in text) and (child := _in_place(layer, UNICODE, _escape, "unicode")):
        yield child
    for start, end, plain, via in _regions(layer):
        pieces = [(0, start, end, False)]
        if isinstance(plain, Oversize):
            data, way = plain.args
            yield Layer("", layer, pieces, "oversize")
            for window in _windows(data):
                yield Layer(window, layer, pieces, via + way)
        elif plain[0]:
            yield Layer(plain[0], layer, pieces, via + plain[1])


def find_secrets(text: str | None) -> list[dict]:
    """Findings by start, kind and end; `depth` 0 and no `via` are those of the text as it stands."""
    if not text:
        return []
    found: dict[tuple[int, int, int], tuple[int, str]] = {}
    seen = set()
    # Iterators over the layers below one another, so that of an oversize layer one window is held.
    work: list[Iterator[Layer]] = [iter((Layer(text),))]
    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
            continue
        place = layer.in_root(0, max(1, len(layer.text)))
        if not layer.text:
            found.setdefault((place[0], KINDS.index("oversize"), place[1]), (layer.depth, layer.via))
            continue
        mark = (xxhash.xxh3_128_digest(layer.text.encode("utf-8", "surrogatepass")), *place)
        if mark in seen:
            continue
        seen.add(mark)
        for kind, start, end in scan(layer.text):
            begin, stop = layer.in_root(start, end)
            key = (begin, KINDS.index(kind), stop)
            if key not in found or found[key][0] > layer.depth:
                found[key] = (layer.depth, layer.via)
        work.append(_decoded(layer))
    return [
        {"kind": KINDS[kind], "start": start, "end": end, "depth": depth, "via": via}
        for (start, kind, end), (depth, via) in sorted(found.items())
    ]


@F.pandas_udf(FINDINGS)
def _findings(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: find_secrets(text if isinstance(text, str) else None))


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, findings): one row for each row of `docs`, map-only.

    A null or empty text has no findings; null and repeated keys pass through; other
    columns of `docs`, whatever their names, play no part. An empty table gives none.
    """
    return docs.select(F.col(key), _findings(F.col(text).cast("string")).alias("findings"))


def spelled(findings: Column) -> Column:
    """`kind:start:end`, comma-joined, in the findings' order."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f.kind, f.start, f.end)), ",")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("findings", lambda f: f.depth == 0)
    scanned = scanned.select("doc_id", "findings", base.alias("base"))
    kinds = F.transform("base", lambda f: f.kind)
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return scanned.select(
        "doc_id",
        *counts,
        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
        spelled(F.col("findings")).alias("spans"),
    )


QUERIES = {"op1_secrets": op1_secrets}
ORACLES: dict[str, str] = {}
