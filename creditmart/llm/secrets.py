"""Secret scans: patterns over a text and over every layer that can be decoded out of it."""

from __future__ import annotations

import binascii
import bz2
import html
import lzma
import re
import zlib
from collections import deque
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.rows import extend, packed

KINDS = ("assign", "access", "hex")
# The patterns of the base scan, and how many characters a match needs.
PATTERNS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
MASK = "[secret]"
# No match is shorter, nor what a match was encoded to.
SHORTEST = 12
# What one encoded stretch may decode to in all: so many bytes, or so many times its
# length. Layers beyond that are left out, and the text is marked incomplete.
DECODED_BYTES = 64 << 20
EXPANSION = 16
UNPACKED_AT_ONCE = 1 << 14

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|(?:\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2})+|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
_CODE = re.compile(r"\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}+={0,2}")
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}"
)
_STANDARD = str.maketrans("-_", "+/")
# The two first bytes of zlib data of any window: a multiple of 31, without a preset dictionary.
_ZLIB = [
    bytes([method, flags])
    for method in range(0x08, 0x80, 0x10) for flags in range(256)
    if (256 * method + flags) % 31 == 0 and not flags & 0x20
]
_MAGIC = re.compile(
    rb"(\x1f\x8b\x08)|(" + b"|".join(map(re.escape, _ZLIB)) + rb")|(BZh[1-9](?:1AY&SY|\x17rE8P\x90))|(\xfd7zXZ\x00)",
    re.S,
)
_UNPACKERS = (
    ("gzip", lambda: zlib.decompressobj(31)), ("zlib", zlib.decompressobj),
    ("bzip2", bz2.BZ2Decompressor), ("xz", lzma.LZMADecompressor),
)
# Text in bytes decoded with surrogates for what is not UTF-8: no odd control characters.
_STRETCH = re.compile(r"[^\x00-\x08\x0E-\x1F\x7F\uD800-\uDFFF]{%d,}" % SHORTEST)
# ASCII text of two bytes a character, in either order.
_WIDE = re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){%d,}|(?:\x00[\t\n\r\x20-\x7e]){%d,}" % (SHORTEST, SHORTEST))


def _packed_pattern(code: str, plain: str) -> re.Pattern:
    """Bytes from the first ones of packed data on, each as it is or escaped by ``code``."""

    def spelled(data: bytes) -> str:
        return "".join(f"(?:{re.escape(chr(b))}|{code}(?i:{b:02x}))" if 0x20 < b < 0x7F else f"{code}(?i:{b:02x})" for b in data)

    heads = [spelled(b"\x1f\x8b\x08"), f"(?:{code}[0-7]8|x){code}[0-9A-Fa-f]{{2}}", spelled(b"BZh") + f"(?:[1-9]|{code}3[1-9])", spelled(b"\xfd7zXZ\0")]
    return re.compile(f"(?:{'|'.join(heads)})(?:{code}[0-9A-Fa-f]{{2}}|{plain})*+")


# Escaped bytes that begin like packed data: what they stand in, and one byte or character of them.
_ESCAPED = (
    ("url", "%", _packed_pattern("%", r"[^\s%]"), re.compile(r"%([0-9A-Fa-f]{2})|([^%])")),
    (
        "unicode", "\\x", _packed_pattern(r"\\x", r"\\[nrtabfv0\\'\"]|[^\r\n\\]"),
        re.compile(r"""\\x([0-9A-Fa-f]{2})|(\\[nrtabfv0\\'"]|[^\\])"""),
    ),
)
_SHORT = dict(zip("nrtabfv0", "\n\r\t\a\b\f\v\0", strict=True))
# What neither a match nor a run of base64 can cross, whatever escapes beside it stand for:
# other characters, blank lines, spaces away from the sign of an assignment, and line
# ends without base64 on both sides.
_BREAK = re.compile(
    r"""[^A-Za-z0-9+/_.=:"'%\\&#;{}\s-]|\n[ \t]*+\r?\n"""
    r"""|(?<![\s:=;}0-9A-Fa-f])[ \t]++(?![\s:=%\\&])"""
    r"""|(?<![\sA-Za-z0-9+/_:=;}-])\s++(?![\s:=%\\&])|(?<![\s:=;}0-9A-Fa-f])\s++(?![\sA-Za-z0-9+/_:=%\\&-])""",
    re.A,
)


@dataclass(frozen=True)
class Layer:
    """A decoded text; ``starts`` and ``ends`` give the original range of each of its
    characters, or, with one entry, that of the whole."""

    text: str
    path: tuple[str, ...]
    starts: list[int] | range
    ends: list[int] | range

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The range of the original text behind a range of this one."""
        if len(self.starts) == 1:
            return self.starts[0], self.ends[0]
        return self.starts[start], self.ends[end - 1]


def matches(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each base match, by start and kind."""
    found = [
        (m.start(), i, m.end())
        for i, kind in enumerate(KINDS)
        for m in PATTERNS[kind].finditer(text)
        if len(m[2] if kind == "assign" else m[0]) >= LEAST[kind]
    ]
    return [(KINDS[i], start, end) for start, i, end in sorted(found)]


def scan(text: str, budget: int | None = None) -> tuple[list, list, list]:
    """Base matches, all (kind, start, end, path) with those of decoded layers, and what was not scanned.

    The last are (start, end) of the encoded stretches that decode to more than their allowance.

    The worklist holds layers still to be unwrapped. A text that came from the
    same place before is not entered again, so the list ends at a fixpoint even
    where decoding runs in a circle. Each encoded stretch of the text has an
    allowance of its own for all layers below it.
    """
    budget = DECODED_BYTES if budget is None else budget
    base = matches(text)
    found = {span: () for span in base}
    seen, skipped = set(), set()
    work = deque([(Layer(text, (), range(len(text)), range(1, len(text) + 1)), None)])
    while work:
        layer, left = work.popleft()
        for inner, left_below in _unwrapped(layer, left, budget):
            if isinstance(inner, range):
                skipped.add(layer.span(inner.start, inner.stop))
                continue
            place = (inner.text, inner.starts[0], inner.ends[-1])
            if place in seen:
                continue
            if left_below[0] < len(inner.text):
                skipped.add((inner.starts[0], inner.ends[-1]))
                continue
            left_below[0] -= len(inner.text)
            seen.add(place)
            for kind, start, end in matches(inner.text):
                found.setdefault((kind, *inner.span(start, end)), inner.path)
            work.append((inner, left_below))
    spans = sorted((start, KINDS.index(kind), end, kind, path) for (kind, start, end), path in found.items())
    return base, [(kind, start, end, path) for start, _, end, kind, path in spans], sorted(skipped)


def _unwrapped(layer: Layer, left: list[int] | None, budget: int):
    """Layers one step below, and what is left of their allowance.

    A range of this layer's text stands for one that is too large.
    """
    text = layer.text

    def allowance(size: int) -> list[int]:
        return [max(budget, EXPANSION * size)] if left is None else left

    kinds = []
    if "%" in text:
        kinds.append(("url", _URL, _from_url))
    if "\\" in text or "&#" in text:
        kinds.append(("unicode", _UNICODE, _from_unicode))
    for kind in kinds:
        for inner in _replaced(layer, *kind):
            yield inner, allowance(len(inner.text))
    for name, sign, pattern, unit in _ESCAPED:
        if sign in text:
            for m in pattern.finditer(text):
                below = allowance(len(m[0]))
                for inner in _from_escaped(layer, name, m, unit, below):
                    yield inner, below
    for m in _BASE64.finditer(text):
        below = allowance(len(m[0]))
        for inner in _from_base64(layer, m[0], range(m.start(), m.end()), below):
            yield inner, below
    if "\n" in text:
        for m in _WRAPPED.finditer(text):
            places = [i for i in range(m.start(), m.end()) if text[i] not in " \t\r\n"]
            if len(places) >= SHORTEST:
                below = allowance(len(places))
                for inner in _from_base64(layer, "".join(text[i] for i in places), places, below):
                    yield inner, below


def _replaced(layer: Layer, name: str, pattern: re.Pattern, decode):
    """Stretches of the text with each match decoded in place; what cannot be decoded stays.

    A stretch goes from break to break and has something decoded in it.
    """
    text = layer.text
    escapes = ((m, decoded) for m in pattern.finditer(text) if (decoded := decode(m[0])) is not None)
    escape = next(escapes, None)
    if escape is None:
        return
    low = 0
    for high, after in chain((m.span() for m in _BREAK.finditer(text)), [(len(text), len(text))]):
        parts, starts, ends, last = [], [], [], low

        def keep(first: int, end: int, parts=parts, starts=starts, ends=ends) -> None:
            parts.append(text[first:end])
            if len(layer.starts) > 1:
                starts.extend(layer.starts[first:end])
                ends.extend(layer.ends[first:end])

        while escape is not None and escape[0].start() < high:
            m, decoded = escape
            keep(last, m.start())
            last = m.end()
            for char, first, end in decoded:
                parts.append(char)
                if len(layer.starts) > 1:
                    start, end = layer.span(m.start() + first, m.start() + end)
                    starts.append(start)
                    ends.append(end)
            escape = next(escapes, None)
        if parts:
            keep(last, high)
            decoded_text = "".join(parts)
            if len(decoded_text) >= SHORTEST:
                if len(layer.starts) == 1:
                    starts, ends = layer.starts, layer.ends
                yield Layer(decoded_text, (*layer.path, name), starts, ends)
        if escape is None:
            return
        low = after


def _kept(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """Characters that stand for themselves."""
    return [(text[i], i, i + 1) for i in range(start, end)]


def _from_url(match: str) -> list[tuple[str, int, int]] | None:
    """(character, start, end) of each; bytes that are not UTF-8 stay as they are."""
    result, at, found = [], 0, False
    for char in bytes.fromhex(match.replace("%", "")).decode(errors="surrogateescape"):
        width = 3 * len(char.encode(errors="surrogateescape"))
        if "\uD800" <= char <= "\uDFFF":
            result += _kept(match, at, at + width)
        else:
            result.append((char, at, at + width))
            found = True
        at += width
    return result if found else None


def _from_unicode(match: str) -> list[tuple[str, int, int]] | None:
    """(character, start, end) of each; codes that are no characters stay as they are."""
    if match[0] == "&":
        char = html.unescape(match)
        return [(char, 0, len(match))] if len(char) == 1 else None
    result, found = [], False
    if match[1] == "u" and match[2] != "{":
        codes, at = [], 0
        for char in bytes.fromhex(match.replace("\\u", "")).decode("utf-16-be", "surrogatepass"):
            width = 12 if ord(char) > 0xFFFF else 6
            codes.append((ord(char), at, at + width))
            at += width
    else:
        codes = [(int(m[1] or m[2] or m[3], 16), *m.span()) for m in _CODE.finditer(match)]
    for code, start, end in codes:
        if code > 0x10FFFF or 0xD800 <= code <= 0xDFFF:
            result += _kept(match, start, end)
        else:
            result.append((chr(code), start, end))
            found = True
    return result if found else None


def _from_escaped(layer: Layer, name: str, match: re.Match, unit: re.Pattern, left: list[int]):
    """Layers out of packed data whose bytes are escaped one by one; a range for one that is too large."""
    raw, starts, ends = bytearray(), [], []
    for m in unit.finditer(match[0]):
        if m[1]:
            data = bytes([int(m[1], 16)])
        else:
            data = (_SHORT.get(m[2][1], m[2][1]) if len(m[2]) == 2 else m[2]).encode(errors="surrogatepass")
        raw += data
        starts += [match.start() + m.start()] * len(data)
        ends += [match.start() + m.end()] * len(data)
    for low, high, path, text in _texts(bytes(raw), left):
        if text is None:
            yield range(starts[low], ends[high - 1])
        elif path and path[0] != "utf16":
            first, last = layer.span(starts[low], ends[high - 1])
            yield Layer(text, (*layer.path, name, *path), [first], [last])


def _from_base64(layer: Layer, run: str, places: range | list[int], left: list[int]):
    """Layers out of a run of base64 whose characters lie at ``places``; a range for one that is too large.

    The run is decoded from each of its first four characters, so that whatever
    stands before the encoded part, some try is aligned with it.
    """
    body = run.rstrip("=").translate(_STANDARD)
    wrapped = isinstance(places, list)
    for skipped in range(4):
        size = len(body) - skipped
        size -= size % 4 == 1
        if size < SHORTEST:
            break
        raw = binascii.a2b_base64(body[skipped : skipped + size] + "=" * (-size % 4))
        for low, high, path, text in _texts(raw, left, bare=True):
            low, high = skipped + low // 3 * 4, min(len(run), skipped + -(-high // 3) * 4)
            # What lies in one line is found in that line's own run.
            if wrapped and places[high - 1] - places[low] == high - 1 - low:
                continue
            if text is None:
                yield range(places[low], places[high - 1] + 1)
                continue
            first, last = layer.span(places[low], places[high - 1] + 1)
            yield Layer(text, (*layer.path, "base64", *path), [first], [last])


def _texts(raw: bytes, left: list[int], bare: bool = False):
    """(start, end, path, text) of each stretch of text in the bytes, also in what they unpack to.

    A text of None stands for data that unpacks to more than is left. With ``bare``, the bytes as
    a whole may also be deflated data without a header.
    """
    work, seen = [(raw, None, ())], {raw}

    def enter(plain: bytes, outer: tuple[int, int], path: tuple[str, ...]) -> None:
        left[0] -= len(plain)
        if plain and plain not in seen:
            seen.add(plain)
            work.append((plain, outer, path))

    if bare and raw[0] & 6 in (2, 4):
        plain, whole = _inflated(raw, left[0])
        if not whole:
            yield 0, len(raw), (), None
        enter(plain, (0, len(raw)), ("deflate",))
    while work:
        data, outer, path = work.pop()
        text, at, last = data.decode(errors="surrogateescape"), 0, 0
        for m in _STRETCH.finditer(text):
            low = at + len(text[last : m.start()].encode(errors="surrogateescape"))
            at, last = low + len(m[0].encode()), m.end()
            yield *(outer or (low, at)), path, m[0]
        for m in _WIDE.finditer(data):
            yield *(outer or m.span()), (*path, "utf16"), m[0].replace(b"\0", b"").decode()
        start = 0
        while m := _MAGIC.search(data, start):
            name, plain, end, whole = _unpacked(data, m, left[0])
            # The two bytes of zlib may be there by chance: what follows is looked at all the same.
            start = m.start() + 1 if name == "zlib" else max(end, m.start() + 1)
            if not whole:
                yield *(outer or (m.start(), end)), path, None
            enter(plain, outer or (m.start(), max(end, m.end())), (*path, name))


def _inflated(data: bytes, limit: int) -> tuple[bytes, bool]:
    """The content of deflated data that ends with the bytes, else nothing; and whether the limit held."""
    unpacker = zlib.decompressobj(-15)
    try:
        plain = unpacker.decompress(data, max(0, limit) + 1)
    except zlib.error:
        return b"", True
    if len(plain) > limit:
        # Bytes taken for such data by chance do not grow: there is nothing to report.
        return b"", len(plain) <= EXPANSION * len(data)
    return (plain, True) if unpacker.eof and len(unpacker.unused_data) <= 2 else (b"", True)


def _unpacked(data: bytes, magic: re.Match, limit: int) -> tuple[str, bytes, int, bool]:
    """Name and content of the members that begin at ``magic``, their end, and whether the limit held.

    Broken data gives what came before the break, and ends where it begins.
    """
    which = magic.lastindex
    name, make = _UNPACKERS[which - 1]
    parts, size, start, done = [], 0, magic.start(), magic.start()
    while True:
        unpacker = make()
        try:
            while start < len(data) and not unpacker.eof:
                given = data[start : start + UNPACKED_AT_ONCE]
                parts.append(unpacker.decompress(given, max(0, limit - size) + 1))
                size += len(parts[-1])
                start += len(given)
                if size > limit:
                    return name, b"".join(parts)[: max(0, limit)], len(data), False
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            return name, b"".join(parts), done, True
        if not unpacker.eof:
            return name, b"".join(parts), len(data), True
        done = start - len(unpacker.unused_data)
        start = done
        while data[start : start + 1] == b"\0":
            start += 1
        following = _MAGIC.match(data, start)
        if following is None or following.lastindex != which:
            return name, b"".join(parts), done, True


def masked(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with overlapping spans joined and each replaced by the mask."""
    parts, last = [], 0
    for start, end in sorted(spans):
        if start >= last:
            parts += [text[last:start], MASK]
        last = max(last, end)
    return "".join([*parts, text[last:]]) if parts else text


FOUND = (
    "base array<struct<kind: string, start: int, end: int>>, "
    "secrets array<struct<kind: string, start: int, end: int, path: string>>, "
    "complete boolean, masked string"
)


def find_secrets(documents: DataFrame, text: str = "text") -> DataFrame:
    """``row`` with ``base`` matches, all ``secrets``, ``complete`` and the ``masked`` text.

    Positions count code points of the original text, ends exclusive. ``path``
    names the layers a secret was found under, empty for the text itself. A null
    text is empty and stays null when masked. A text with an encoded stretch that
    decodes to more than ``DECODED_BYTES`` and ``EXPANSION`` times its length is not
    complete; what is within, and all other stretches, are scanned all the same, and the
    mask covers that stretch, whatever it may hold.
    Texts are scanned one by one, whole, without any shuffle; repeated rows each.
    """

    def make():
        kinds = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        paths = pa.struct([*kinds, ("path", pa.string())])

        def apply(texts: pa.StringArray) -> list[pa.Array]:
            bases, alls, complete, clean = [], [], [], []
            for value in texts.to_pylist():
                base, found, skipped = scan(value or "")
                bases.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in base])
                alls.append([{"kind": k, "start": a, "end": b, "path": "/".join(p)} for k, a, b, p in found])
                complete.append(not skipped)
                clean.append(None if value is None else masked(value, [*((a, b) for _, a, b, _ in found), *skipped]))
            return [pa.array(bases, pa.list_(kinds)), pa.array(alls, pa.list_(paths)), pa.array(complete), pa.array(clean, pa.string())]

        return apply

    return extend(packed(documents), text, make, FOUND)


def joined(spans: str) -> Column:
    """``kind:start:end`` of each span, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """``row`` with the counts and digests of what :func:`find_secrets` found."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("row", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("secrets").alias("spans"), "complete")
