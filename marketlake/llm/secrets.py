"""Secret scans with a recursive decoding worklist.

Every text is scanned as it stands; then URL, Unicode, base64 and compressed
layers inside it are unwrapped, each new layer is scanned and put on the
worklist, until no layer gives a new one.  A layer that was seen before with
the same text at the same place is not taken again, and a compressed stream
that unpacks to bytes it came from is left, which ends cycles.  Every layer
carries, per character, the place in the original text it came from, so a
secret found at any depth is reported as a span of the original.

A document is one row's work and nothing is shuffled.  Layers are unpacked one
at a time and dropped when done, so memory holds one chain of nested layers,
each bounded by the longest text or by ``MAX_LAYER``, and a digest per layer.
What unpacks to more than ``MAX_LAYER`` is scanned whole, as a stream in
windows of about that size: what is open at a window's edge moves on to the
next, and a run longer than half a window is unpacked as a stream of its own.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import lzma
import re
import zlib
from array import array
from collections import deque
from functools import partial
from hashlib import blake2b
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import read, text_or_empty

# The three base patterns and the least lengths of a match (assign: of its value).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")                   # runs are maximal, so shorter ones never match otherwise
KINDS = ("assign", "access", "hex")
LEAST_VALUE, LEAST_ACCESS = 8, 16

MAX_LAYER = 16 << 20                                 # what unpacks beyond this is scanned as a stream, in windows
OVERLAP = 4096                                       # characters that windows share at least
STEP = 1 << 18                                       # bytes unpacked at once
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|%u[0-9A-Fa-f]{4}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
# a string literal: an escaped backslash stands for itself and takes part in no other escape of its layer
LITERAL = re.compile(r"""\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\[\\"'/bfnrt]""")
SURROGATES = re.compile(r"\\u([dD][89abAB][0-9A-Fa-f]{2})\\u([dD][c-fC-F][0-9A-Fa-f]{2})")
# a wrapped run is one run, also if each line is quoted or commented out, or ends in a backslash
BREAK = r"[ \t]{0,32}\\?(?:\r\n?|\n)[ \t]{0,32}(?:[>#*;|][ \t]{0,8}){0,8}"
BASE64 = re.compile(rf"[A-Za-z0-9+/_-]{{16,}}(?:{BREAK}[A-Za-z0-9+/_-]+)*(?:(?:{BREAK})?=){{0,2}}")
# lines too short to be a run of their own
NARROW = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{1,15}}(?:{BREAK}[A-Za-z0-9+/_-]{{1,15}}(?![A-Za-z0-9+/_-]))+(?:(?:{BREAK})?=){{0,2}}")
LINE = re.compile(r"[A-Za-z0-9+/_=-]+")
PART = re.compile(r"[A-Za-z0-9]+|[+/_-]")
RUN = re.compile(r"[A-Za-z0-9+/_\s>#*;|\\-]*={0,2}")
TO_STANDARD = str.maketrans("-_", "+/")
JOINED = str.maketrans("", "", ">#*;|\\ \t\r\n\v\f")     # what may stand between the lines of a run
# what may go on beyond the end of a text, read backwards: a base64 run, one with escapes, all without white space
KREAB = r"(?:[ \t]{0,8}[>#*;|]){0,8}[ \t]{0,32}(?:\n\r?|\r)\\?[ \t]{0,32}"
OPEN = [re.compile(x) for x in (rf"\s{{0,66}}={{0,2}}[A-Za-z0-9+/_-]*(?:{KREAB}[A-Za-z0-9+/_-]+)*",
                                rf"\s{{0,66}}[A-Za-z0-9+/_=%\\&#;-]*(?:{KREAB}[A-Za-z0-9+/_=%\\&#;-]+)*", r"\S*")]
# bytes as quote() and repr() write them: what stands for itself and what is escaped
QUOTED = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~+/!'()*-])+")
REPR = re.compile(r"""(?:\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|\\[abfnrtv0\\'"]|[\x20-\x5b\x5d-\x7e])+""")
BYTE = {"%": re.compile(r"%..|."), "\\": re.compile(r"\\x..|\\u00..|\\.|.")}
MARK = r"(?:%|\\x|\\u00)"
ESCAPED_MAGIC = re.compile(rf"{MARK}1f{MARK}8b|(?:x|{MARK}78)(?:\^|{MARK}(?:01|5e|9c|da))|(?:B|{MARK}42)(?:Z|{MARK}5a)(?:h|{MARK}68)"
                           rf"|{MARK}fd|{MARK}b5", re.IGNORECASE)
SHORT = {f"\\{c}": ord(x) for c, x in zip("abfnrtv0", "\a\b\f\n\r\t\v\0")}
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
SPACES = re.compile(r"\x20{65,}")
CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f\ufffd]")
NO_TEXT = re.compile(r"[\x01-\x08\x0e-\x1f\x7f\ufffd]")
# UTF-16 and UTF-32 read as UTF-8: characters with one or three NULs between them
WIDE = re.compile(r"(?:[^\x00]\x00){8,}[^\x00]?|(?:[^\x00]\x00{3}){8,}[^\x00]?")
SPANS_DDL = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,depth:int>>, refused int"


def scan(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of all secrets in one text, in code points, end exclusive."""
    found = []
    if ":" in text or "=" in text:
        found += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    return found + [(2, *m.span()) for m in HEX.finditer(text)]


class Layer:
    """A text and the original span of each of its characters.

    ``starts`` and ``ends`` are None for the original itself, and two numbers
    in a layer that came out of one run, where all spans are that run.
    """

    __slots__ = ("text", "starts", "ends", "depth")

    def __init__(self, text, starts=None, ends=None, depth=0):
        self.text, self.starts, self.ends, self.depth = text, starts, ends, depth

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return (self.starts, self.ends) if self.packed() else (self.starts[start], self.ends[end - 1])

    def packed(self) -> bool:
        return isinstance(self.starts, int)

    def replaced(self, pattern: re.Pattern, decode) -> Layer | None:
        """This layer with every match decoded; ``decode`` gives [(character, source length)] or None."""
        text, starts, ends, at, changed = [], array("q"), array("q"), 0, False

        def keep(a: int, b: int) -> None:
            text.append(self.text[a:b])
            if not self.packed():
                starts.extend(range(a, b) if self.starts is None else self.starts[a:b])
                ends.extend(range(a + 1, b + 1) if self.ends is None else self.ends[a:b])

        for m in pattern.finditer(self.text):
            got = decode(m[0])
            if got is None:
                continue
            keep(at, m.start())
            pos = m.start()
            for char, width in got:
                text.append(char)
                if not self.packed():
                    a, b = self.span(pos, pos + width)
                    starts.append(a)
                    ends.append(b)
                pos += width
            at, changed = m.end(), True
        if not changed:
            return None
        keep(at, len(self.text))
        if self.packed():
            starts, ends = self.starts, self.ends
        return Layer("".join(text), starts, ends, self.depth + 1)

    def inside(self, start: int, end: int, text: str) -> Layer:
        """A layer unpacked from the characters start..end of this one."""
        return Layer(text, *self.span(start, end), self.depth + 1)

    def key(self) -> tuple[bytes, int, int]:
        return blake2b(self.text.encode(), digest_size=16).digest(), *self.span(0, len(self.text))


def _percent(run: str):
    text = bytes.fromhex(run.replace("%", "")).decode(errors="surrogateescape")
    return [("\ufffd", 3) if "\ud800" <= c <= "\udfff" else (c, 3 * len(c.encode())) for c in text]


def _wide(run: str):
    width = 4 if run[2] == "\0" else 2
    return [(c, min(width, len(run) - i * width)) for i, c in enumerate(run[::width])]


def _pair(pair: str):
    high, low = int(pair[2:6], 16), int(pair[8:12], 16)
    return [(chr(0x10000 + ((high - 0xD800) << 10) + low - 0xDC00), len(pair))]


def _escape(code: str):
    n = int(code[3:-1], 16) if code[:3] in ("&#x", "&#X") else int(code[2:-1]) if code[0] == "&" else int(code[2:], 16)
    return None if n > 0x10FFFF or 0xD800 <= n <= 0xDFFF else [(chr(n), len(code))]


def _literal(code: str):
    return _escape(code) if len(code) > 2 else [(chr(SHORT.get(code, ord(code[1]))), 2)]


class TooLarge(Exception):
    pass


class _Zlib:
    """zlib's decompressor (gzip and zlib) with the methods of bz2's."""

    def __init__(self):
        self.d = zlib.decompressobj(47)
        self.eof, self.needs_input, self.unused_data = False, True, b""

    def decompress(self, data: bytes, most: int) -> bytes:
        out = self.d.decompress(self.d.unconsumed_tail + data, most)
        self.eof, self.unused_data = self.d.eof, self.d.unused_data
        self.needs_input = not self.d.unconsumed_tail and len(out) < most
        return out


class _Zstd:
    """zstandard's decompressor with the methods of bz2's; a few bytes at a time, as it has no bound for the output."""

    def __init__(self):
        import zstandard
        self.d = zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj()     # the format's own limit
        self.held, self.eof, self.needs_input, self.unused_data = b"", False, True, b""

    def decompress(self, data: bytes, most: int) -> bytes:
        self.held += data
        out, size, at = [], 0, 0
        while at < len(self.held) and size < most and not self.eof:
            out.append(self.d.decompress(self.held[at:at + 256]))
            size += len(out[-1])
            at += 256
            self.eof = self.d.eof
        self.held = self.held[at:]
        self.needs_input = not self.held
        if self.eof:
            self.unused_data = self.d.unused_data + self.held
        return b"".join(out)


def _decompressor(head: bytes):
    """A decompressor for what starts with ``head`` (see ``MAGIC``)."""
    if head[:1] in b"\x1f\x78":
        return _Zlib()
    if head[:1] == b"B":
        return bz2.BZ2Decompressor()
    return _Zstd() if head[:1] == b"\x28" else lzma.LZMADecompressor()


class _Feed:
    """The bytes of an iterator; what follows ``mark`` can be taken again."""

    def __init__(self, pieces):
        self.pieces, self.held, self.at, self.mark = iter(pieces), b"", 0, 0

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        if self.at - self.mark > MAX_LAYER:
            self.mark = self.at
        self.held = self.held[self.mark:] + piece
        self.at, self.mark = self.at - self.mark, 0
        return True

    def seek(self) -> bytes | None:
        """Marks the next place that looks compressed, and gives what is passed on the way; None if there is no more."""
        passed = b""
        while (m := MAGIC.search(self.held, self.at)) is None:
            end = max(self.at, len(self.held) - 5)   # a signature may go on in the next piece
            passed = (passed + self.held[self.at:end]).strip(b"\0")[:1]
            self.at = self.mark = end
            if not self.more():
                return None
        passed += self.held[self.at:m.start()].strip(b"\0")[:1]
        self.at = self.mark = m.start()
        return passed

    def take(self, most: int) -> bytes:
        while self.at == len(self.held) and self.more():
            pass
        got = self.held[self.at:self.at + most]
        self.at += len(got)
        return got


def _member(feed: _Feed):
    """What the stream at the front of ``feed`` unpacks to, in pieces; one cut short still gives what it holds.

    Leaves ``feed`` behind the stream, or, if it does not come to its end, behind the first byte.
    """
    try:
        d, most = _decompressor(feed.held[feed.at:feed.at + 1]), 1024
        while data := feed.take(most):
            most = min(2 * most, STEP)               # there may be many small members
            while True:
                out = d.decompress(data, STEP)
                data = b""
                if out:
                    yield out
                if d.eof:
                    feed.at -= len(d.unused_data)
                    return
                if d.needs_input:
                    break
    except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError):
        pass
    except Exception as error:                       # zstandard's own error type, without importing it above
        if type(error).__name__ != "ZstdError":
            raise
    feed.at = feed.mark + 1


def _streams(pieces):
    """What all compressed streams in ``pieces`` unpack to, in pieces; nothing if there is none.

    Members that follow each other are joined; between others stands a line break.
    """
    feed, given = _Feed(pieces), False
    while (passed := feed.seek()) is not None:
        for out in _member(feed):
            if passed and given:
                yield b"\n"
            passed, given = b"", True
            yield out


def _unpacked(raw: bytes) -> bytes | None:
    """The compressed streams in ``raw`` (gzip, zlib, bzip2, xz, zstd), unpacked once and joined; None without any."""
    out, size = [], 0
    for piece in _streams([raw]):
        out.append(piece)
        size += len(piece)
        if size > MAX_LAYER:
            raise TooLarge
    return b"".join(out) or None


def _decoded(run):
    """The bytes of a base64 run that comes in pieces."""
    rest = ""
    for piece in run:
        rest += piece.rstrip("=").translate(JOINED).translate(TO_STANDARD)
        whole = len(rest) // 4 * 4
        yield base64.b64decode(rest[:whole])
        rest = rest[whole:]
    if len(rest) > 1:
        yield base64.b64decode(rest + "=" * (4 - len(rest)))


def _from(run, start: int):
    for piece in run:
        piece = piece.translate(JOINED)
        yield piece[start:]
        start = max(0, start - len(piece))


def _characters(pieces):
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for piece in pieces:
        yield decoder.decode(piece)
    yield decoder.decode(b"", True)


def _run_at(characters, start: int):
    """The base64 run that begins at ``start``, in pieces."""
    for piece in characters:
        if start < len(piece):
            run = RUN.match(piece, start)[0]
            yield run
            if len(run) < len(piece) - start:
                return
        start = max(0, start - len(piece))


def _windows(characters):
    """(text, None) for each window, and (None, start) for each base64 run too long for one.

    In a packed layer all spans are the same, so a match may be in two windows.
    """
    most, shared = MAX_LAYER, min(OVERLAP, MAX_LAYER // 4)
    parts, length = [], 0
    at, inside = 0, False                            # at: where the end of the window is, less its length
    for piece in characters:
        for i in range(0, len(piece), most // 4):
            parts.append(piece[i:i + most // 4])
            length += len(parts[-1])
            if length < most:
                continue
            held = SPACES.sub(" " * 64, "".join(parts))          # for the patterns one space is as good as many
            at += length - len(held)
            parts, length = [held], len(held)
            if length < most:
                continue
            yield held, None
            back = held[::-1]
            open_runs = [len(x.match(back)[0]) for x in OPEN]
            if open_runs[0] < most // 2:
                keep, inside = max(n for n in open_runs if n < most // 2), False
            else:
                keep = 0
                if not inside or open_runs[0] < len(held):
                    yield None, at + len(held) - open_runs[0]
                inside = True
            cut = len(held) - max(shared, min(keep + shared, most * 3 // 4))
            at += cut
            parts, length = [held[cut:]], len(held) - cut
    if length:
        yield "".join(parts), None


def _scanned_as_stream(source, refused: list[int]):
    """The texts of all that ``source()``, bytes in pieces, unpacks to, layer below layer.

    A layer is unpacked again for the one below it, so none is held whole.
    """
    seen = set()

    def hashed(pieces, digest):
        for piece in pieces:
            digest.update(piece)
            yield piece

    while True:
        inner = partial(lambda outer: _streams(outer()), source)
        if next(inner(), None) is None:
            return
        digest = blake2b(digest_size=16)
        for text, start in _windows(_characters(hashed(inner(), digest))):
            if start is None:
                yield text
                continue
            refused[0] += 1
            for k in range(4):                       # it need not begin where the run does
                yield from _scanned_as_stream(
                    lambda s=start, i=inner, k=k: _decoded(_from(_run_at(_characters(i()), s), k)), refused)
        if digest.digest() in seen:                  # a stream that holds itself
            return
        seen.add(digest.digest())
        source = inner


def _below(raw: bytes, refused: list[int]):
    """The texts of all that ``raw`` unpacks to, layer below layer."""
    seen = set()
    while (digest := blake2b(raw, digest_size=16).digest()) not in seen:         # else a stream that holds itself
        seen.add(digest)
        try:
            raw = _unpacked(raw)
        except TooLarge:
            refused[0] += 1
            yield from _scanned_as_stream(partial(iter, [raw]), refused)
            return
        if raw is None:
            return
        yield raw.decode(errors="replace")


def _base64(body: str) -> bytes:
    if len(body) % 4 == 1:
        body = body[:-1]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _run(layer: Layer, lines: list[tuple[int, int]], refused: list[int]):
    """The layers in the base64 run of these lines; returns if it is one from its first character on.

    If it is not, perhaps a path or a name stands before it: then it is
    decoded from all four places in a group of characters, and what is found
    is mapped to the parts between + / - _ that hold it.  Likewise, texts in a
    wrapped run are mapped to its lines.
    """
    body = "".join(layer.text[a:b] for a, b in lines).rstrip("=").translate(TO_STANDARD)
    first, last = lines[0][0], lines[-1][1]
    raw = _base64(body)
    text = raw.decode(errors="replace")
    clean = CONTROL.search(text) is None
    whole = clean or bool(MAGIC.match(raw)) and next(_streams([raw]), None) is not None
    mostly = 4 * len(NO_TEXT.findall(text)) < len(text)          # a text that is not all UTF-8
    parts = lines if whole or mostly else [(a + p.start(), a + p.end()) for a, b in lines for p in PART.finditer(layer.text[a:b])]
    single = layer.packed() or len(parts) == 1
    if not single:
        at = np.cumsum([0] + [b - a for a, b in parts])[:-1]
        spans = np.array([layer.span(a, b) for a, b in parts])
        spans[-1, 1] = layer.span(first, last)[1]    # with the padding
    for k in range(1 if whole else 4):
        if k:
            raw = _base64(body[k:])
            text = raw.decode(errors="replace")
        if single:
            yield layer.inside(first, last, text)
        else:
            code = np.frombuffer(raw.decode(errors="surrogateescape").encode("utf-32-le", "surrogatepass"), "<u4").copy()
            stray = (code >= 0xD800) & (code <= 0xDFFF)          # a byte that is not UTF-8
            width = np.where(stray, 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
            code[stray] = 0xFFFD
            text = code.tobytes().decode("utf-32-le")
            end = np.cumsum(width)
            a, b = (k + (end - width) * 8 // 6, k + (end * 8 - 1) // 6)
            where = [spans[np.searchsorted(at, x, "right") - 1, i] for i, x in enumerate((a, b))]
            yield Layer(text, *(array("q", x.astype(np.int64).tobytes()) for x in where), layer.depth + 1)
        start = first
        if not (whole or single) and (m := MAGIC.search(raw)):
            start = parts[int(np.searchsorted(at, k + m.start() * 8 // 6, "right")) - 1][0]
        for inner in _below(raw, refused):
            yield layer.inside(start, last, inner)
    return whole


def _wrapped(lines: list[tuple[int, int]]):
    """``lines`` grouped: all but the first and the last line of a wrapped run are equally long."""
    width, at = [b - a for a, b in lines], 0
    while at < len(lines):
        end = at + 1
        if end < len(lines):
            full = width[end] if width[end:end + 2] == [width[end]] * 2 else max(width[at:end + 1])
            end += 1
            while end < len(lines) and width[end - 1] == full >= width[end]:
                end += 1
        yield lines[at:end]
        at = end


def _runs_of_their_own(text: str, lines: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The lines that may as well be runs by themselves: each is a text, or more than one starts a stream."""
    if len(lines) == 1:
        return []
    raw = [_base64(text[a:b].rstrip("=").translate(TO_STANDARD)) if b - a >= 16 else b"" for a, b in lines]
    streams = [bool(MAGIC.match(r)) for r in raw]
    return [line for line, r, packed in zip(lines, raw, streams) if r and (
        packed and sum(streams) > 1 or not packed and CONTROL.search(r.decode(errors="replace")) is None)]


def _escaped(layer: Layer, pattern: re.Pattern, mark: str, refused: list[int]):
    """The layers in compressed bytes that are written with escapes."""
    for m in pattern.finditer(layer.text):
        if mark not in m[0]:
            continue
        tokens = BYTE[mark].findall(m[0])
        raw = bytes(int(t[-2:], 16) if len(t) > 2 else SHORT.get(t, ord(t[-1])) for t in tokens)
        if mark == "%":
            raw = raw if "+" not in m[0] else bytes(0x20 if t == "+" else c for t, c in zip(tokens, raw))
        found = MAGIC.search(raw)
        if found is None:
            continue
        at = list(accumulate(map(len, tokens), initial=m.start()))
        while found is not None:
            i, j = found.start(), len(tokens)
            before = layer.text[at[i] - 1:at[i]]
            if before in ("'", '"'):                 # a literal: it ends with the quote
                j = next((n for n in range(i, j) if tokens[n] == before), j)
            end = j
            if before not in ("'", '"') and all(len(t) > 1 for t in tokens[i:i + 32]):   # no byte stands for itself
                end = next((n for n in range(i, j) if len(tokens[n]) == 1), j)
            for text in _below(raw[i:j], refused):
                yield layer.inside(at[i], at[end], text)
            found = MAGIC.search(raw, j)


def _rewritten(layer: Layer):
    """The layer with its wide characters, URL escapes, surrogate pairs or Unicode escapes decoded."""
    text = layer.text
    steps = []
    if "\0" in text:
        steps.append((WIDE, _wide))
    if "%" in text:
        steps.append((PERCENT, _percent))
    if "\\u" in text:
        steps.append((SURROGATES, _pair))
    if "\\" in text or "&#" in text or "%u" in text:
        steps.append((ESCAPE, _escape))
    if "\\" in text:
        steps.append((LITERAL, _literal))
    for pattern, decode in steps:
        new = layer.replaced(pattern, decode)
        if new is not None:
            yield new


def _inner(layer: Layer, refused: list[int]):
    """The layers packed into base64 runs and escaped bytes of ``layer``."""
    text = layer.text
    for m in BASE64.finditer(text):
        lines = [(m.start() + p.start(), m.start() + p.end()) for p in LINE.finditer(m[0])]
        groups, whole = list(_wrapped(lines)), True
        for group in groups:
            whole = (yield from _run(layer, group, refused)) and whole
            for line in _runs_of_their_own(text, group):
                yield from _run(layer, [line], refused)
        if not whole and len(groups) > 1:
            yield from _run(layer, lines, refused)
    for m in NARROW.finditer(text) if "\n" in text or "\r" in text else ():
        lines = [(m.start() + p.start(), m.start() + p.end()) for p in LINE.finditer(m[0])]
        for group in _wrapped(lines):
            if len(group) > 1 and sum(b - a for a, b in group) >= 16:
                yield from _run(layer, group, refused)
    if ("%" in text or "\\" in text) and ESCAPED_MAGIC.search(text):
        yield from _escaped(layer, QUOTED, "%", refused)
        yield from _escaped(layer, REPR, "\\", refused)


def find_secrets(text: str) -> tuple[list[tuple[str, int, int, int]], int]:
    """Spans (kind, start, end, depth) by start, kind and end; and how many layers were scanned as streams.

    A span found at several depths is listed once, with the least seen; the
    text itself is scanned first, so its own spans have depth 0.
    """
    depth_of: dict[tuple[int, int, int], int] = {}
    refused, seen = [0], set()

    def unseen(layer: Layer) -> bool:
        key = layer.key() if layer.text else None
        if key is None or key in seen:
            return False
        seen.add(key)
        return True

    first = Layer(text)
    # one entry per nested run being worked on: its rewritten forms to do, and what the last one holds
    stack = [(deque([first] if unseen(first) else []), iter(()))]
    while stack:
        todo, held = stack[-1]
        inner = next(held, None)
        if inner is not None:
            if unseen(inner):
                stack.append((deque([inner]), iter(())))
        elif todo:
            layer = todo.popleft()
            for kind, a, b in scan(layer.text):
                start, end = layer.span(a, b)
                depth_of[start, kind, end] = min(layer.depth, depth_of.get((start, kind, end), layer.depth))
            todo.extend(filter(unseen, _rewritten(layer)))
            stack[-1] = todo, _inner(layer, refused)
        else:
            stack.pop()
    return [(KINDS[k], a, b, d) for (a, k, b), d in sorted(depth_of.items())], refused[0]


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, spans, refused.

    ``spans`` is sorted by start, then kind (assign, access, hex), then end;
    depth 0 are the base spans.  ``refused`` counts layers refused as
    one text, as they unpack to more than ``MAX_LAYER``: they are scanned as
    streams, and their spans are listed.  Bytes that are not UTF-8 count as
    U+FFFD; the rest of their layer is scanned.  A null or empty text has no spans; a null id
    stays null; an empty table gives no rows; other columns are not read.
    """
    import zstandard                                 # noqa: F401  fail here, not in a task
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32())]))

    def run(batches):
        for b in batches:
            spans, refused = [], []
            for t in b.column(1).to_pylist():
                found, n = find_secrets(t)
                spans.append([dict(zip(("kind", "start", "end", "depth"), s)) for s in found])
                refused.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind), pa.array(refused, pa.int32())],
                                             names=["doc_id", "spans", "refused"])

    source = docs.select(F.col(doc_id).cast("bigint").alias("d"), text_or_empty(text).alias("t"))
    return source.mapInArrow(run, SPANS_DDL)


def op3_secret_scan(spark, sf_dir) -> DataFrame:
    found = secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["depth"] == 0)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    def number_of(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(number_of, KINDS), F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), "refused")
