"""Secret scans over nested encodings.

Every text is a worklist's first layer. A layer is scanned, then unwrapped: runs of URL escapes and
Unicode escapes give layers in which they are decoded, with the stretch around them up to characters
that no secret and no run can cross (``CUT``); each base64 run, or block of base64 lines, that holds text
(or bytes in gzip, zlib, bz2, xz or zstd form that hold text) gives a layer of its own, whatever else its
bytes are: bytes that are no UTF-8 become U+FFFD, and of a run that is mostly no text (as one that joins a
path) the stretches that are long enough for a secret, and the archives in it, are layers. Archives are read as streams: content
over ``HELD`` bytes comes as several layers, which meet at such characters, so none of it is left out and
memory is bounded by that size and the longest stretch without them. New layers join the worklist until
none is left. A layer that was seen at the same place, or that equals or contains one that it came from,
ends its branch; so does one that has grown ``GROWN`` times on the way, and an archive within ``GROWN``
others that are each over ``HELD``: only archives that reproduce or grow themselves do that. There is no
limit on decoded bytes, unless a caller sets ``MAX_BYTES``: archives with more content are no layers then.
Each piece of a layer knows where it came from, so every find maps to a span of the whole text.

Rows: a null text counts as empty and has no spans. Repeated rows get equal results, ties (spans
with equal start) are ordered by kind, then end. Other columns are ignored or, by ``redact``, kept.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

# fixed values: the kinds in the order in which they are reported, their patterns and least lengths
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs of 24 or more are whole runs, as a run's start comes first
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX, LEAST_BASE64 = 6, 20, 24, 16

MAX_BYTES = None
HELD, PIECE, GROWN = 64 << 20, 1 << 20, 64  # bytes held and read at a time, growing layers in a row
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# no match of a pattern holds such a character, or a space between two letters or digits (line breaks may stand in base64)
CUT = re.compile(r"""[^A-Za-z0-9+/_.=\-"':\x20%\\\r\n]|(?<=[A-Za-z0-9])\x20(?=[A-Za-z0-9])""")
# base64 lines with one line break between them
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[A-Za-z0-9+/_-]++)++={0,2}")
# in decoded bytes: what may hold a secret (the shortest has 12 characters), and the starts of archives
STRETCH = re.compile(rb"""[A-Za-z0-9+/_.=\-"':\x20%\\\r\n]{12,}""")
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
CONTROL = bytes(c for c in range(128) if not chr(c).isprintable() and not chr(c).isspace())
SPANS = "array<struct<kind:string,start:int,end:int,depth:int>>"
MARK = "[SECRET]"

_SAFE = bytes.maketrans(b"-_", b"+/")


def _marked(chars: bytes) -> bytes:
    return bytes(1 if c in chars else 0 for c in range(256))


_HEX_BYTES = _marked(b"0123456789abcdef")
_BASE64_BYTES = _marked(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the secrets that stand in the text as it is."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if b"\1" * LEAST_HEX in text.encode("utf-8", "replace").translate(_HEX_BYTES):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class _Zstd:
    """One zstd frame, by the methods of the other decompressors."""

    def __init__(self):
        self.d, self.rest = zstandard.ZstdDecompressor().decompressobj(), b""

    eof = property(lambda self: self.d.eof)
    unused_data = property(lambda self: self.d.unused_data + self.rest)
    needs_input = property(lambda self: not self.rest)

    def decompress(self, data: bytes, size: int) -> bytes:
        data, self.rest = self.rest + data, b""
        data, self.rest = data[:256], data[256:]  # a block of four bytes may stand for 128 KB
        return self.d.decompress(data)


def _decoder(head: bytes):
    """What makes a reader of the archive that starts so, None if it is none."""
    if head[:2] == b"\x1f\x8b":
        return lambda: zlib.decompressobj(31)
    if len(head) > 1 and head[0] == 0x78 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if head[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor
    return _Zstd if head[:4] == b"\x28\xb5\x2f\xfd" else None


def _inflate(make, pieces, ends: list):
    """The content of an archive and its further members, piece by piece, as far as it can be read, then the
    bytes that follow; ``ends`` gets an item if it could be read to the end."""
    try:
        pieces, d = iter(pieces), make()
        for data in pieces:
            while True:
                out = d.decompress(data, PIECE)
                if out:
                    yield out
                if d.eof:
                    rest = d.unused_data.lstrip(b"\0")
                    while len(rest) < 6 and (more := next(pieces, b"")):
                        rest = (rest + more).lstrip(b"\0")
                    if not (make := _decoder(rest[:6])):
                        ends.append(True)
                        if rest:
                            yield b"\xff" + rest
                        yield from pieces
                        return
                    data, d = rest, make()
                    continue
                data = getattr(d, "unconsumed_tail", b"")
                if not data and len(out) < PIECE and getattr(d, "needs_input", True):
                    break
    except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
        return


def _content(data: bytes):
    """The bytes inside any number of archives, in pieces; HELD bytes of each archive are held at most. What is
    no whole archive comes as it stands too, after the part that could be read."""
    seen, source, large, broken = set(), [data], 0, ()
    while make := _decoder(data[:6]):
        digest = hashlib.blake2b(data).digest()
        if digest in seen or large > GROWN:
            return
        seen.add(digest)
        ends, parts, n, last = [], [], 0, None
        inner = _inflate(make, source, ends)
        while n <= HELD and (last := next(inner, None)):
            parts.append(last)
            n += len(last)
        whole = [data] if isinstance(source, list) else chain([data], source)  # of an iterator only data was taken when it fails
        if not n:
            yield from chain(whole, broken)
            return
        if last is None and not ends:
            broken = chain([b"\xff"], whole, broken)
        data, held = b"".join(parts), last is None
        large += not held
        source = [data] if held else chain([data], inner)
    yield from chain(source, broken)


def _within(pieces, limit: int):
    """The pieces, none if they are more than ``limit`` bytes."""
    held, n = [], 0
    for piece in pieces:
        held.append(piece)
        n += len(piece)
        if n > limit:
            return []
    return held


def texts(data: bytes, limit: int | None = None):
    """The text that the bytes hold, inside any number of archives; in parts of about HELD, which end at a CUT."""
    decode, text, least = codecs.getincrementaldecoder("utf-8")("replace").decode, "", HELD
    pieces = _content(data)
    for piece in pieces if limit is None else _within(pieces, limit):
        text += decode(piece)
        if len(text) > least:
            if at := _last_cut(text):
                yield text[:at]
                text = text[at:]
            least = max(HELD, 2 * len(text))  # where no cut is near
    text += decode(b"", True)
    if text:
        yield text


def _last_cut(text: str, end: int | None = None) -> int:
    """The end of the last cut before ``end``, 0 if there is none."""
    end, size = len(text) if end is None else end, 4096
    while True:
        lo = max(0, end - size)
        ends = [m.end() for m in CUT.finditer(text[lo:end])]
        if ends or not lo:
            return lo + ends[-1] if ends else 0
        size *= 16


def _next_cut(text: str, start: int) -> int:
    """The start of the first cut from ``start``, the text's end if there is none."""
    size = 4096
    while True:
        if cut := CUT.search(text[start:start + size]):
            return start + cut.start()
        if start + size >= len(text):
            return len(text)
        size *= 16


def as_text(data: bytes, limit: int | None = None) -> str | None:
    return "".join(texts(data, limit)) or None


def _base64(run: str) -> bytes:
    raw = run.rstrip("=").encode("ascii").translate(_SAFE)
    if len(raw) % 4 == 1:
        raw = raw[:-1]
    try:
        return base64.b64decode(raw + b"=" * (-len(raw) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _unicode(run: str) -> str:
    points = [int(x, 16) for x in re.findall(r"\\[ux]([0-9A-Fa-f]+)", run)]
    return b"".join(p.to_bytes(2, "little") for p in points).decode("utf-16-le", "replace")


class _Layer:
    """A layer's text; ``pieces`` are (start here, start there, end there, literal) in the layer above, kept as in the root."""

    def __init__(self, text, above=None, pieces=()):
        self.text, self.above = text, above
        self.pieces = [p for piece in pieces for p in above.in_root(*piece)] if above else []
        self.starts = [p[0] for p in self.pieces]
        self.depth = above.depth + 1 if above else 0
        self.grown = above.grown + (len(text) > len(above.text)) if above else 0

    def in_root(self, here: int, start: int, end: int, literal: bool):
        """The pieces of the root that a piece of this layer comes from."""
        if not self.above:
            return [(here, start, end, literal)]
        if not literal:
            return [(here, *self.root_span(start, end), False)]
        out = []
        for i in range(bisect_right(self.starts, start) - 1, len(self.pieces)):
            at, there, there_end, plain = self.pieces[i]
            if at >= end:
                break
            lo, hi = max(at, start), min(self.starts[i + 1] if i + 1 < len(self.starts) else len(self.text), end)
            out.append((here + lo - start, there + lo - at, there + hi - at, True) if plain else (here + lo - start, there, there_end, False))
        return out

    def known(self, text: str) -> bool:
        layer = self
        while layer:
            if layer.text == text:
                return True
            layer = layer.above
        return False

    def grows(self, inner: _Layer) -> bool:
        """Whether the inner layer holds the whole of a layer that it came from, or has grown too often."""
        layer = self
        while layer:
            if len(inner.text) > len(layer.text) and layer.text in inner.text:
                return True
            layer = layer.above
        return inner.grown > GROWN

    def key(self) -> bytes:
        """Stands for the text and where each part of it comes from."""
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass") + repr(self.pieces).encode()).digest()

    def root_span(self, start: int, end: int) -> tuple[int, int]:
        if not self.above:
            return start, end
        here, there, _, literal = self.pieces[bisect_right(self.starts, start) - 1]
        first = there + (start - here if literal else 0)
        here, there, there_end, literal = self.pieces[bisect_right(self.starts, end - 1) - 1]
        return first, there + end - here if literal else there_end


def _rewritten(layer: _Layer, pattern, decode):
    """Layers with every run that decodes put in its place, each with the text around it up to a cut."""
    text, out, pieces, at, here = layer.text, [], [], None, 0
    for m in pattern.finditer(text):
        new = decode(m[0])
        if not new:
            continue
        if at is None:
            at = _last_cut(text, m.start())
        elif cut := CUT.search(gap := text[at:m.start()]):
            pieces.append((here, at, at + cut.start(), True))
            yield _Layer("".join([*out, gap[:cut.start()]]), layer, [p for p in pieces if p[1] < p[2]])
            out, pieces, here, at = [], [], 0, at + _last_cut(gap)
        if m.start() > at:
            pieces.append((here, at, m.start(), True))
            out.append(text[at:m.start()])
            here += m.start() - at
        pieces.append((here, m.start(), m.end(), False))
        out.append(new)
        here, at = here + len(new), m.end()
    if pieces:
        end = _next_cut(text, at)
        if end > at:
            pieces.append((here, at, end, True))
            out.append(text[at:end])
        yield _Layer("".join(out), layer, pieces)


def unwrap(layer: _Layer, limit: int | None = None):
    """The layers inside this one."""
    text = layer.text
    if "%" in text:
        yield from _rewritten(layer, URL, lambda run: as_text(bytes.fromhex(run.replace("%", "")), limit))
    if "\\u" in text or "\\x" in text:
        yield from _rewritten(layer, UNICODE, _unicode)
    if b"\1" * LEAST_BASE64 in text.encode("utf-8", "replace").translate(_BASE64_BYTES):
        for m in BASE64.finditer(text):
            yield from _decoded(layer, [(m.start(), m[0])], limit)
        for m in WRAPPED.finditer(text):
            yield from _decoded(layer, [(m.start() + x.start(), x[0]) for x in re.finditer(r"[^\r\n]+", m[0])], limit)


def _decoded(layer: _Layer, lines: list[tuple[int, str]], limit: int | None):
    """The layers in a base64 run that stands in one or more lines (start, characters)."""
    run, first = "".join(x for _, x in lines), [0]
    for _, x in lines:
        first.append(first[-1] + len(x))
    end = lines[-1][0] + len(lines[-1][1])

    def place(i: int) -> int:
        line = bisect_right(first, i, 0, len(lines)) - 1
        return lines[line][0] + i - first[line]

    rough = []
    for skip in range(4):  # a prefix of the same characters may shift the blocks
        data = _base64(run[skip:])
        if _decoder(data[:6]):
            for new in texts(data, limit):
                yield _Layer(new, layer, [(0, place(skip), end, False)])
            continue
        text = data.decode("utf-8", "replace")
        bad = text.count("\ufffd") + len(data) - len(data.translate(None, CONTROL))
        if text and bad <= len(text) // 10:
            yield _Layer(text, layer, _by_line(data, lines, first) if skip == 0 else [(0, place(skip), end, False)])
            if not bad:
                return
        else:
            rough.append((skip, data))
    for skip, data in rough:
        for m in STRETCH.finditer(data):
            last = skip + (m.end() - 1) // 3 * 4 + (m.end() - 1) % 3 + 1
            yield _Layer(m[0].decode("ascii"), layer, [(0, place(skip + m.start() // 3 * 4 + m.start() % 3), end if m.end() == len(data) else place(last) + 1, False)])
        for m in MAGIC.finditer(data):
            if next(_inflate(_decoder(m[0][:6]), [data[m.start():m.start() + (1 << 20)]], []), None):
                for new in texts(data[m.start():], limit):
                    yield _Layer(new, layer, [(0, place(skip + m.start() // 3 * 4 + m.start() % 3), end, False)])


def _by_line(data: bytes, lines: list[tuple[int, str]], first: list[int]):
    """The pieces of a decoded block, one for each line if no byte stands in two lines."""
    if len(lines) == 1 or any(x % 4 for x in first[:-1]):
        return [(0, lines[0][0], lines[-1][0] + len(lines[-1][1]), False)]
    decode, here, out = codecs.getincrementaldecoder("utf-8")("replace").decode, 0, []
    for k, (start, x) in enumerate(lines):
        new = len(decode(data[first[k] // 4 * 3:first[k + 1] // 4 * 3 if k + 1 < len(lines) else None], k + 1 == len(lines)))
        if new:
            out.append((here, start, start + len(x), False))
            here += new
    return out


def scan(text: str | None) -> list[tuple[int, int, int, int]]:
    """(start, kind's number, end, depth) of every secret of the whole text, each span once, ordered."""
    found, seen = {}, {}
    work = [iter([_Layer(text or "")])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if layer.above:
            if layer.above.known(layer.text):
                continue
            key = layer.key()
            if seen.get(key, layer.depth + 1) <= layer.depth:
                continue
            seen[key] = layer.depth
        for start, kind, end in find(layer.text):
            a, b = layer.root_span(start, end)
            found.setdefault((a, kind, b), layer.depth)
            found[a, kind, b] = min(found[a, kind, b], layer.depth)
        if not layer.above or not layer.above.grows(layer):
            work.append(iter(unwrap(layer, MAX_BYTES)))
    return [(*k, depth) for k, depth in sorted(found.items())]


def _spans(texts) -> pa.Array:
    rows = [[{"kind": KINDS[k], "start": a, "end": b, "depth": d} for a, k, b, d in scan(t.as_py())] for t in texts]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("depth", pa.int32())])
    return pa.array(rows, pa.list_(kind))


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id and its spans (kind, start, end, depth; code points, depth 0: not encoded)."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _spans(b.column(1))], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, spans {SPANS}")


def digest(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))


def _masked(text: str | None) -> str | None:
    if text is None:
        return None
    out, at = [], 0
    for start, _, end, _ in scan(text):
        if start >= at:
            out += [text[at:start], MARK]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span, or run of overlapping spans, of ``text`` replaced by MARK; n_chars follows if it is there."""
    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("text")
            yield b.set_column(at, b.schema.field(at), pa.array([_masked(t.as_py()) for t in b.column(at)], b.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return out
