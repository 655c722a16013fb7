"""Secret scan with a recursive decoding worklist.

The base patterns run over the text itself.  Then the text goes on a worklist
of layers.  Of a layer come new ones: the layer with its URL escapes undone,
the layer with its Unicode and character escapes undone, and each base64 run's
bytes.  A run is decoded from each of its first four characters, as a path or a
key before it may shift the alignment, and where a compressed stream begins
behind a separator.  A run that is wrapped into lines is also decoded as one,
without its line breaks.  Bytes that begin as gzip, zlib, bzip2 or xz streams (of
any number of members) are decompressed until they no longer do; all bytes are
then read as text: UTF-8 with any character, else UTF-16 or, byte by byte, Latin-1.
Each new layer is scanned and goes on the list; a layer whose content at the
same place was seen before is dropped (cycles), and the list ends at the
fixpoint.  Every layer knows by segments where its characters came from, so what
is found maps back to a span of the text; such spans have the kind ``decoded_``
plus the pattern's.

What streams unpack to is read in pieces of ``PIECE`` bytes that share ``OVERLAP``
bytes, so memory stays bounded however large it is; equal pieces are read once.
A secret of up to ``OVERLAP`` bytes is whole in some piece.  A base64 run inside an
unpacked layer that is longer than that and meets a piece's edge is read in
parts.  A stream that breaks off gives what it held until there.  Edge cases:
null and empty texts have no spans; every input row gives one row, repeated rows
too; texts are read whole.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts

PIECE, OVERLAP, STEP = 4 << 20, 64 << 10, 1 << 20
KINDS = ("assign", "access", "hex")
MIN_GROUP, MIN_ACCESS, MIN_HEX = 12, 18, 16

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
NAMES = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)+={0,2}")
LINE = re.compile(r"[^\x20\t\r\n]+")
#: Base64 of the first bytes of streams: gzip, zlib, bzip2 behind a separator; xz begins with one.
PACKED = re.compile(r"(?<![A-Za-z0-9])(?:H4sI|eAE|eF4|eJ[w-z]|eN[o-r]|QlpoO|QlpoN|QlpoM)|/Td6WFoA")
BYTES = re.compile(r"[\x00-\x7f]+|[^\x00-\x7f]")
STANDARD = str.maketrans("-_", "+/")
SHORTEST = 22  # base64 characters of the shortest secret


def base_spans(s: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping within a kind, in code points."""
    out = []
    low = s.lower()
    if any(x in low for x in NAMES):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(s) if m.end(2) - m.start(2) >= MIN_GROUP]
    if "AKIA" in s:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(s) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(s)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[1])))


def char_of(escape: str) -> str:
    if escape[0] == "&":
        n = int(escape[3:-1], 16) if escape[2] in "xX" else int(escape[2:-1])
    else:
        n = int(escape[2:], 16)
    return chr(n) if n < 0x110000 and not 0xD800 <= n < 0xE000 else "�"


class Places:
    """Where a layer's characters come from: segments, each spread evenly over a stretch of the layer above."""

    def __init__(self, above: Places | None, whole: tuple[int, int] | None = None):
        self.above, self.whole, self.n = above, whole, 0
        self.at, self.start, self.size = array("q"), array("q"), array("q")

    def add(self, n: int, start: int, size: int) -> None:
        """The next ``n`` characters come from the ``size`` characters at ``start``."""
        if n:
            self.at.append(self.n)
            self.start.append(start)
            self.size.append(size)
            self.n += n

    def reach(self) -> int:
        """Where the last segment ends in the layer above."""
        return self.start[-1] + self.size[-1] if self.at else 0

    def _length(self, i: int) -> int:
        return (self.at[i + 1] if i + 1 < len(self.at) else self.n) - self.at[i]

    def span(self, a: int, b: int) -> tuple[int, int]:
        """The stretch of the text behind the layer's characters from ``a`` to before ``b``."""
        if self.whole:
            a, b = self.whole
        else:
            i, j = bisect_right(self.at, a) - 1, bisect_right(self.at, b - 1) - 1
            a = self.start[i] + (a - self.at[i]) * self.size[i] // self._length(i)
            b = self.start[j] - (self.at[j] - b) * self.size[j] // self._length(j)
        return self.above.span(a, b) if self.above else (a, b)


def replaced(s: str, pattern: re.Pattern, decode, above: Places | None) -> Iterator[tuple[str, Places]]:
    """``s`` with the pattern's matches decoded, if there are any."""
    parts, places, at = [], Places(above), 0
    for m in pattern.finditer(s):
        parts += [s[at:m.start()], made := decode(m[0])]
        places.add(m.start() - at, at, m.start() - at)
        places.add(len(made), m.start(), m.end() - m.start())
        at = m.end()
    if parts:
        places.add(len(s) - at, at, len(s) - at)
        yield "".join([*parts, s[at:]]), places


def stream(data: bytes):
    """A decompressor if ``data`` begins as a known stream."""
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and len(data) > 1 and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if data[:6] == b"\xfd7zXZ\x00" else None


def opened(feed: Iterator[bytes]) -> tuple[bytes, Iterator[bytes]]:
    """The first bytes of ``feed``, six at least if there are so many, and the feed behind them."""
    head = b""
    for part in feed:
        head += part
        if len(head) >= 6:
            break
    return head, feed


def members(feed: Iterator[bytes]) -> Iterator[bytes]:
    """What the streams at the begin of ``feed`` hold, in parts of ``STEP`` bytes at most; then what follows them, as it is."""
    rest, feed = opened(feed)
    while d := stream(rest):
        made = b""
        while not d.eof:
            if not rest and len(made) < STEP and getattr(d, "needs_input", True):
                if not (rest := next(feed, b"")):
                    return
            try:
                made = d.decompress(rest, STEP)
            except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
                yield from chain([rest], feed)
                return
            rest = getattr(d, "unconsumed_tail", b"")
            if made:
                yield made
        rest, feed = opened(chain([d.unused_data.lstrip(b"\0")], feed))  # xz and gzip files may be padded
    yield from chain([rest], feed)


def windows(feed: Iterator[bytes]) -> Iterator[bytes]:
    """``feed`` in pieces that overlap."""
    held = bytearray()
    for part in feed:
        held += part
        while len(held) > PIECE:
            yield bytes(held[:PIECE])
            del held[:PIECE - OVERLAP]
    if held:
        yield bytes(held)


def unpacked(data: bytes) -> Iterator[bytes]:
    """Pieces of ``data``, decompressed as long as it begins as a known stream; one that comes again ends that."""
    seen = set()
    while stream(data) and (mark := hashlib.sha256(data).digest()) not in seen:
        seen.add(mark)
        feed, parts = members(iter([data])), []
        while sum(map(len, parts)) <= PIECE and (part := next(feed, b"")):
            parts.append(part)
        if sum(map(len, parts)) > PIECE:  # from here on it is not held whole
            head, feed = opened(chain(parts, feed))
            while stream(head) and (mark := hashlib.sha256(head).digest()) not in seen:
                seen.add(mark)
                head, feed = opened(members(chain([head], feed)))
            yield from windows(chain([head], feed))
            return
        data = b"".join(parts)
    yield from windows(iter([data]))


def readings(data: bytes) -> Iterator[tuple[str, str]]:
    """The texts that ``data`` may be, each with its code."""
    try:
        yield data.decode(), "utf-8"
    except UnicodeDecodeError:
        yield data.decode("latin-1"), "latin-1"
    for code, pair in (("utf-16-le", slice(1, None, 2)), ("utf-16-be", slice(0, None, 2))):
        if data[:2] in (b"\xff\xfe", b"\xfe\xff") or 4 * data[pair].count(0) > len(data):  # of most ASCII text half is zero
            yield data.decode(code, "replace"), code


def characters(text: str, code: str, size: int, above: Places) -> Places:
    """The places of a text's characters, read by ``code`` from ``size`` bytes that stand at ``above``."""
    if len(text) == size:
        return above
    places = Places(above)
    if code == "utf-8":
        for m in BYTES.finditer(text):
            places.add(len(m[0]), places.reach(), len(m[0].encode()))
    else:  # a pair that is one character, or none, shifts the rest a little
        places.add(len(text), 0, size)
    return places


def layers(s: str, above: Places | None) -> Iterator[tuple[str, Places]]:
    """The layers directly below ``s``, whose own characters stand at ``above`` (None: it is the text)."""
    if "%" in s:
        yield from replaced(s, URL, lambda m: bytes.fromhex(m.replace("%", "")).decode("utf-8", "replace"), above)
    if "\\" in s or "&#" in s:
        yield from replaced(s, ESCAPE, char_of, above)
    for m in BASE64.finditer(s):
        places = Places(above)
        places.add(m.end() - m.start(), m.start(), m.end() - m.start())
        yield from decoded(m[0], places)
    if "\n" in s:
        for m in WRAPPED.finditer(s):
            places, lines = Places(above), list(LINE.finditer(s, m.start(), m.end()))
            for x in lines:
                places.add(x.end() - x.start(), x.start(), x.end() - x.start())
            yield from decoded("".join(x[0] for x in lines), places)


def bytes_of(body: str) -> bytes:
    """The bytes of a base64 run without padding; a last character that can't end one is left out."""
    body = body[:len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def decoded(run: str, above: Places) -> Iterator[tuple[str, Places]]:
    """The layers of a base64 run, whose characters stand at ``above``."""
    body = run.rstrip("=").translate(STANDARD)
    for k in range(4 if len(body) >= SHORTEST else 0):
        raw = bytes_of(body[k:])
        places, quads = Places(above), len(raw) // 3  # four characters hold three bytes
        places.add(3 * quads, k, 4 * quads)
        places.add(len(raw) % 3, k + 4 * quads, len(raw) % 3 + 1)
        for text, code in readings(raw):
            yield text, characters(text, code, len(raw), places)
    for m in PACKED.finditer(body):
        raw = bytes_of(body[m.start():m.start() + 400])
        if next(members(iter([raw])), b"") == raw:  # no stream after all
            continue
        for piece in unpacked(bytes_of(body[m.start():])):
            for text, _ in readings(piece):
                yield text, Places(above, (m.start(), len(run)))


def decoded_spans(s: str) -> set[tuple[int, str, int]]:
    """Spans of ``s`` whose decoded layers hold a base pattern that isn't in ``s`` as it stands."""
    out: set[tuple[int, str, int]] = set()
    own = set(base_spans(s))
    seen = {(hashlib.sha256(s.encode("utf-8", "surrogatepass")).digest(), 0)}
    work = [layers(s, None)]
    while work:  # layers are made one by one, so one of each depth is held
        if (got := next(work[-1], None)) is None:
            work.pop()
            continue
        text, places = got
        if not text or (mark := (hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), places.span(0, 1)[0])) in seen:
            continue
        seen.add(mark)
        for a, kind, b in base_spans(text):
            start, end = places.span(a, b)
            if (start, kind, end) not in own:
                out.add((start, f"decoded_{kind}", end))
        work.append(layers(text, places))
    return out


def joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def scan(texts: list[bytes]) -> list[list]:
    out: list[list] = [[] for _ in range(5)]
    for raw in texts:
        s = raw.decode("utf-8", "replace")
        base = base_spans(s)
        more = sorted(decoded_spans(s))
        every = sorted([*base, *more], key=lambda x: (x[0], KINDS.index(x[1].removeprefix("decoded_")), x[1], x[2]))
        row = (*(sum(k == kind for _, k, _ in base) for kind in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(),
               joined(every))
        for column, value in zip(out, row):
            column.append(value)
    return out


FIELDS = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]


def scan_secrets(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) of ``docs`` and the scan's ``FIELDS``; spans by start, then kind."""

    def fn(texts: list[bytes], _: pa.RecordBatch):
        return scan(texts)

    return map_texts(docs, fn, FIELDS, text_col, keep)
