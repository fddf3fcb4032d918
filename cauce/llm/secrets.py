"""Secret scan through nested encodings: a worklist of layers, each rescanned, spans mapped back.

A layer is a text with a map to the document's code points. Scanning a layer finds secrets;
unwrapping it gives further layers: the whole text with its percent escapes or its Unicode escapes
replaced (beyond three such levels all that are left at once), and the content of each base64 run, inflated where it is compressed. Layers are taken
from the worklist until none is left; one whose content and place were seen before is not taken
again, so a content that unwraps to itself ends.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Generator, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.llm.registry import query, table
from cauce.llm.words import slices

#: The kinds of the contract in their order, and the shortest that counts.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("password", "passwd", "secret", "token", "api")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2})+")
_ONE_UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\[ux]([0-9A-Fa-f]+)")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: The next line of a wrapped run.
_LINE = re.compile(r"[ \t]*\r?\n[ \t]*([A-Za-z0-9+/_-]+={0,2})")
#: A layer that inflates to more bytes than this is scanned in pieces of this size, each half over the one before, and
#: counted as ``oversized``: only a run longer than half a piece can be broken there, so a redaction takes it out whole.
LAYER_BYTES = 32 << 20
#: Escapes nested deeper than this are taken off all at once, so that the work stays in proportion to the text.
DEEP = 3


class Span(NamedTuple):
    start: int
    kind: int
    end: int


class Layer(NamedTuple):
    """``text`` and its segments: from ``at[i]`` on it comes from ``begin[i]``, one for one if
    ``width[i]`` is 0, else all of the segment from ``width[i]`` code points."""

    text: str
    at: list[int]
    begin: list[int]
    width: list[int]
    path: str

    def origin(self, start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        first = self.begin[i] + (0 if self.width[i] else start - self.at[i])
        last = self.begin[j] + (self.width[j] or end - self.at[j])
        return first, last


def find(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of each secret that stands in the text as it is."""
    out = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(x in low for x in _NAMES):
            out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return out


def _replaced(layer: Layer, runs: list[tuple[int, list[tuple[str, int]]]], path: str) -> Layer | None:
    """The layer with each run replaced; a run is its place and its characters with their source lengths."""
    if not runs:
        return None
    text, at, begin, width, done, size = [], [], [], [], 0, 0

    def keep(until: int) -> None:
        nonlocal done, size
        i = bisect_right(layer.at, done) - 1
        while done < until:
            stop = min(until, layer.at[i + 1] if i + 1 < len(layer.at) else until)
            at.append(size)
            begin.append(layer.begin[i] + (0 if layer.width[i] else done - layer.at[i]))
            width.append(layer.width[i])
            text.append(layer.text[done:stop])
            size += stop - done
            done, i = stop, i + 1

    for place, characters in runs:
        keep(place)
        for c, n in characters:
            first, last = layer.origin(done, done + n)
            at.append(size)
            begin.append(first)
            width.append(last - first)
            text.append(c)
            done, size = done + n, size + len(c)
    keep(len(layer.text))
    return Layer("".join(text), at, begin, width, path)


def _percent(layer: Layer) -> Layer | None:
    if "%" not in layer.text:
        return None
    runs = []
    for m in _PERCENT.finditer(layer.text):
        characters = []
        for c in bytes.fromhex(m[0].replace("%", "")).decode(errors="surrogateescape"):
            if 0xDC80 <= ord(c) < 0xDD00:  # no UTF-8: stays escaped
                characters += [(x, 1) for x in f"%{ord(c) - 0xDC00:02X}"]
            else:
                characters.append((c, 3 * len(c.encode())))
        runs.append((m.start(), characters))
    return _replaced(layer, runs, layer.path + ">url")


def _unicode(layer: Layer) -> Layer | None:
    if "\\" not in layer.text:
        return None
    runs = []
    for m in _UNICODE.finditer(layer.text):
        units = [(int(x[1] or x[2], 16), x.end() - x.start()) for x in _ONE_UNICODE.finditer(m[0])]
        characters, i = [], 0
        while i < len(units):
            code, n = units[i]
            if 0xD800 <= code < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1][0] < 0xE000:
                code, n, i = 0x10000 + ((code - 0xD800) << 10) + units[i + 1][0] - 0xDC00, n + units[i + 1][1], i + 1
            characters.append((chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd", n))
            i += 1
        runs.append((m.start(), characters))
    return _replaced(layer, runs, layer.path + ">unicode")


_HEXITS = frozenset("0123456789abcdefABCDEF")
_BRACED = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}")


def _unwrapped(layer: Layer) -> Layer | None:
    """All nested percent and Unicode escapes taken off in one pass.

    Characters go on a stack; when its top spells an escape, that becomes one character, which may
    end a further one. No two escapes overlap, so this ends where level after level would.
    """
    text = layer.text
    if "%" not in text and "\\" not in text:
        return None
    held: list[str] = []
    start: list[int] = []
    changed = False

    def close(n: int, char: str) -> str:
        """The last ``n`` characters become ``char``."""
        nonlocal changed
        changed = True
        del held[-n:]
        del start[len(held) + 1:]
        held.append(char)
        return char

    for at, c in enumerate(text):
        held.append(c)
        start.append(at)
        while True:
            if c in _HEXITS:
                if len(held) > 2 and held[-3] == "%" and held[-2] in _HEXITS:
                    v = int(held[-2] + c, 16)
                    c = close(3, chr(v if v < 128 else 0xDC00 + v))  # bytes of a longer character wait as in surrogateescape
                    continue
                if len(held) > 3 and held[-4] == "\\" and held[-3] == "x" and held[-2] in _HEXITS:
                    c = close(4, chr(int(held[-2] + c, 16)))
                    continue
                if len(held) > 5 and held[-6] == "\\" and held[-5] == "u" and _HEXITS.issuperset(held[-4:]):
                    code = int("".join(held[-4:]), 16)
                    if 0xDC00 <= code < 0xE000:
                        high = held[-7] if len(held) > 6 else ""
                        if "\ud800" <= high < "\udc00":
                            c = close(7, chr(0x10000 + ((ord(high) - 0xD800) << 10) + code - 0xDC00))
                        else:
                            c = close(6, "\ufffd")
                    else:
                        c = close(6, chr(code))
                    continue
            elif c == "}" and (m := _BRACED.fullmatch("".join(held[-10:]), max(0, min(len(held), 10) - _braced_length(held)))):
                code = int(m[1], 16)
                c = close(len(m[0]), chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd")
                continue
            break
    if not changed:
        return None
    start.append(len(text))
    runs, i = [], 0
    while i < len(held):
        j = i
        while j < len(held) and 0xDC80 <= ord(held[j]) < 0xDD00:
            j += 1
        if j > i:
            for c in bytes(ord(x) - 0xDC00 for x in held[i:j]).decode(errors="surrogateescape"):
                n = 1 if 0xDC80 <= ord(c) < 0xDD00 else len(c.encode())
                length = start[i + n] - start[i]
                if n == 1:  # no UTF-8: stays escaped
                    mark = f"%{ord(c) - 0xDC00:02X}"
                    runs.append((start[i], [(mark[0], length - 2), (mark[1], 1), (mark[2], 1)]))
                else:
                    runs.append((start[i], [(c, length)]))
                i += n
            continue
        if start[i + 1] - start[i] > 1:
            runs.append((start[i], [("\ufffd" if "\ud800" <= held[i] < "\ue000" else held[i], start[i + 1] - start[i])]))
        i += 1
    return _replaced(layer, runs, layer.path + (">url" if "%" in text else ">unicode"))


def _braced_length(held: list[str]) -> int:
    """Length of the last piece of the stack from a backslash on, at most ten characters."""
    for n in range(4, min(10, len(held)) + 1):
        if held[-n] == "\\":
            return n
    return 0


def _form(data: bytes) -> tuple[Callable, str] | None:
    """Decompressor and name of gzip, zlib, bzip2 or xz bytes; None if they are none of them."""
    if data[:2] == b"\x1f\x8b":
        return lambda: zlib.decompressobj(31), "gzip"
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor, "bzip2"
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor, "xz"
    if len(data) > 2 and data[0] & 15 == 8 and not (data[0] << 8 | data[1]) % 31:
        return zlib.decompressobj, "zlib"
    return None


class _Inflated:
    """Content of a stream in parts, its further members of the same form included; then ``rest`` is what follows it."""

    def __init__(self, parts: Iterator[bytes], make: Callable, name: str):
        self.parts, self.make, self.name, self.rest, self.ended = parts, make, name, b"", False

    def __iter__(self) -> Iterator[bytes]:
        d, feed, fed = self.make(), next(self.parts, b""), b""
        while True:
            fed = feed or fed
            try:
                part = d.decompress(feed, LAYER_BYTES)
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                self.rest, self.ended = fed, False
                return
            if part:
                yield part
            if d.eof:
                self.ended = True
                feed = d.unused_data
                while len(feed) < 6 and (more := next(self.parts, b"")):
                    feed += more
                if (form := _form(feed)) is None or form[1] != self.name:
                    self.rest = feed
                    return
                d = self.make()
                continue
            feed = getattr(d, "unconsumed_tail", b"")
            if not part and not feed and not (feed := next(self.parts, b"")):
                return


def _opened(data: bytes, path: str) -> Iterator[tuple[bytes, str, bool, bool]]:
    """Bytes inside ``data`` that are not compressed, with their path, whether all of their forms ended well, and
    whether they are the first piece of more than ``LAYER_BYTES``."""
    work = [(iter([data]), path, frozenset(), True)]
    while work:
        parts, path, known, well = work.pop()
        piece = next(parts, b"")
        mark, form = hashlib.blake2b(piece).digest(), _form(piece)
        if form is not None and mark not in known:
            inner = _Inflated(itertools.chain([piece], parts), *form)
            known |= {mark}

            def after(inner=inner, parts=parts):
                if inner.rest:
                    yield inner.rest
                    yield from parts

            content = iter(inner)
            first = list(itertools.islice(content, 2))
            work.append((after(), path, known, False))
            if first:
                if len(first) == 1:
                    content = iter(())
                work.append((itertools.chain(first, content), f"{path}>{form[1]}", known, well and (len(first) > 1 or inner.ended)))
            continue
        large = False
        for part in parts:
            piece += part
            while len(piece) > LAYER_BYTES:
                yield piece[:LAYER_BYTES], path, well, not large
                piece, large = piece[LAYER_BYTES // 2:], True
        if piece:
            yield piece, path, well, False


def _readable(data: bytes) -> str | None:
    """The text if it is one; bytes that are none are scanned too, but other readings of their run are tried as well."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    odd = sum(1 for c in text if not (c.isprintable() or c in "\t\n\r"))
    return text if text and odd * 20 <= len(text) else None


def _unbase64(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _texts(data: bytes) -> list[tuple[str, str]]:
    """What the bytes may say, with the step of the path: UTF-8, else one character a byte; with NULs also UTF-16."""
    try:
        out = [(data.decode(), "")]
    except UnicodeDecodeError:
        out = [(data.decode("latin-1"), "")]
    if b"\0" in data:
        out += [(data[k:].decode(form, "replace"), ">utf16") for form in ("utf-16-le", "utf-16-be") for k in (0, 1)]
    return out


def _lines(text: str, first: re.Match) -> list[tuple[int, int]]:
    """Places of the lines over which a run goes on: each but the last is as wide as the widest."""
    lines = [first.span()]
    inside = first.start() > 0 and text[first.start() - 1] not in "\n\t "
    width = len(first[0])
    while text[lines[-1][1] - 1] != "=" and (m := _LINE.match(text, lines[-1][1])):
        n = m.end(1) - m.start(1)
        if n > width and (len(lines) > 1 or not inside):
            break
        lines.append(m.span(1))
        if n < width:
            break
        width = n
    return lines


def _base64(layer: Layer, oversized: list[tuple[int, int]]) -> Iterator[Layer]:
    """Layers of the base64 runs, made as they are asked for; places of the large ones are noted."""
    done = 0

    def take(start: int, end: int, run: str) -> Generator[Layer, None, bool]:
        """The layers of a run; whether it is meant as one run."""
        data, meant = _unbase64(run), False
        first, last = layer.origin(start, end)
        for piece, path, well, large in _opened(data, ">base64") if data else ():
            meant |= well and (path != ">base64" or _readable(piece) is not None)
            if large:
                oversized.append((first, last))
            for text, step in _texts(piece):
                yield Layer(text, [0], [first], [last - first], layer.path + path + step)
        return meant

    for m in _BASE64.finditer(layer.text):
        if m.start() < done:
            continue
        lines = _lines(layer.text, m)
        joined = False
        for n in range(len(lines), max(1, len(lines) - 2), -1):  # a word may follow on the next line
            joined = joined or (yield from take(lines[0][0], lines[n - 1][1], "".join(layer.text[a:b] for a, b in lines[:n])))
        if joined and len(lines) > 2:
            done = lines[-2][1]
            continue
        for start, end in lines[:-1] or lines:
            run = layer.text[start:end]
            if not (yield from take(start, end, run)):
                for k in (1, 2, 3):  # glued to a letter or digit before it
                    if len(run) - k >= 16 and (data := _unbase64(run[k:])) and (_form(data) or _readable(data) is not None):
                        yield from take(start + k, end, run[k:])
                for x in re.finditer(r"[A-Za-z0-9]{16,}={0,2}", run):
                    if x[0] != run:
                        yield from take(start + x.start(), start + x.end(), x[0])
        done = (lines[:-1] or lines)[-1][1]


def _mark(layer: Layer) -> tuple:
    """What tells layers apart: content and place."""
    text = layer.text
    if len(text) > 1 << 12:
        text = hashlib.blake2b(text.encode(errors="surrogatepass")).digest()
    return (text, *layer.origin(0, len(layer.text)))


def scan(text: str) -> tuple[list[Span], list[tuple[Span, str]], int]:
    """Spans of the text itself, further spans found in layers with the path to each, and how many layers were too large."""
    base, more, large = scan_layers(text)
    return base, more, len(large)


def scan_layers(text: str) -> tuple[list[Span], list[tuple[Span, str]], list[tuple[int, int]]]:
    """As ``scan``, with the places of the layers that were too large to be scanned in one piece."""
    base = sorted(Span(*x) for x in find(text))
    seen_spans, more, oversized = set(base), {}, []
    seen: set[tuple] = set()
    work = [iter([Layer(text, [0], [0], [0], "")])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not layer.text or (mark := _mark(layer)) in seen:
            continue
        seen.add(mark)
        if layer.path:
            for start, kind, end in find(layer.text):
                first, last = layer.origin(start, end)
                span = Span(first, kind, last)
                if span not in seen_spans:
                    seen_spans.add(span)
                    more[span] = layer.path[1:], layer.text[start:end]
        deep = layer.path.count(">url") + layer.path.count(">unicode") >= DEEP
        whole = [x for x in ((_unwrapped(layer),) if deep else (_percent(layer), _unicode(layer))) if x is not None]
        work.append(itertools.chain(whole, _base64(layer, oversized)))
    return base, _narrowest(more), oversized


def _narrowest(found: dict[Span, tuple[str, str]]) -> list[tuple[Span, str]]:
    """Without the spans of joined lines in which a part alone gives the same secret."""
    same: dict[tuple[int, str], list[Span]] = {}
    for span, (_, secret) in found.items():
        same.setdefault((span.kind, secret), []).append(span)
    kept = []
    for spans in same.values():
        least = None  # the end of the narrowest of those that start at or after
        for span in sorted(spans, key=lambda x: (-x.start, x.end)):
            if least is None or span.end < least:
                kept.append((span, found[span][0]))
                least = span.end
    return sorted(kept)


_SPAN = "array<struct<kind: string, start: long, end: long, layer: string>>"


def scan_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """Add ``out``: ``array<struct<kind, start, end, layer>>`` ordered by start, kind and end, and ``out``_oversized.

    Spans are of code points of the whole text, end exclusive. ``layer`` is empty for a secret that
    stands there as it is, else the encodings to take off (``url>base64``), and the span is then the
    encoded stretch. All other columns stay as they are; those named as the new ones are replaced. NULL
    and empty texts have no span. Repeated rows are scanned alike; an empty table stays empty. Each text
    is scanned whole; ``out``_oversized counts its layers of more than ``LAYER_BYTES``, which are
    scanned in pieces.
    """
    large = f"{out}_oversized"
    kept = [c for c in docs.columns if c not in (out, large)]
    schema = docs.select(*kept).withColumn(out, F.lit(None).cast(_SPAN)).withColumn(large, F.lit(None).cast("long")).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("layer", pa.string())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            found, counts = [], []
            for value in part.column(text).to_pylist():
                base, more, oversized = scan(value or "")
                counts.append(oversized)
                rows = sorted([*((s, "") for s in base), *more])
                found.append([{"kind": KINDS[s.kind], "start": s.start, "end": s.end, "layer": path} for s, path in rows])
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(found, kind), pa.array(counts, pa.int64())],
                                             [*kept, out, large])

    return docs.select(*kept).mapInArrow(run, schema)


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with each stretch of ``text`` that a span covers replaced by ``mark``; NULL stays NULL.

    A stretch with a layer that is too large to be scanned in one piece is replaced as a whole, since a
    secret may be broken in it. Each text is redacted whole and by itself, repeated rows alike; an empty
    table stays empty; other columns stay.
    """
    schema, names = docs.schema, docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            texts = []
            for value in part.column(text).to_pylist():
                if value:
                    base, more, large = scan_layers(value)
                    pieces, done = [], 0
                    for start, end in sorted([*((s.start, s.end) for s in [*base, *(s for s, _ in more)]), *large]):
                        if start >= done:
                            pieces += [value[done:start], mark]
                        done = max(done, end)
                    value = "".join([*pieces, value[done:]]) if pieces else value
                texts.append(value)
            at = names.index(text)
            columns = [pa.array(texts, part.column(text).type) if i == at else c for i, c in enumerate(part.columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("secrets", lambda x: x["layer"] == "")

    def count(kind: str):
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("secrets")).alias("spans"), F.col("secrets_oversized").alias("n_oversized"))
