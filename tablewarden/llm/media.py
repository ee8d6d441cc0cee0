"""Media columns: what stored bytes really are, found by signature and confirmed by structure.

An Aho-Corasick automaton finds all magic bytes in one pass, a validator for each format walks its chunks or
segments and gives the exact length, or rejects. The type found at offset 0 corrects the declared one; valid
media further in are carved. A payload becomes a column by wrapping it as 8-bit mono PCM in a RIFF container.

Nulls: null bytes are empty bytes, of type application/octet-stream and without media; a null declared type is
never right. Very long payloads: a place that validators walk through is looked at once a payload, however many formats seem to
begin before it (chains of chunks, blocks and segments, ends of scans and archives), and check sums of overlapping chunks come from
sums over the payload. Ties: of media
that start together the longest comes first, then by type. Empty tables give empty tables, repeated rows are sniffed
each for itself. doc_id is an integer; sniff_column takes a key of any type.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_rows

UNKNOWN = "application/octet-stream"
#: Payloads are padded with spaces to a multiple of this many bytes; samples a second of the stored sound.
UNIT, RATE = 192, 8000

# Magic bytes of the formats.
MAGIC = {
    b"RIFF": "audio/wav",
    b"\x89PNG\r\n\x1a\n": "image/png",
    b"GIF87a": "image/gif",
    b"GIF89a": "image/gif",
    b"\xff\xd8\xff": "image/jpeg",
    b"BM": "image/bmp",
    b"%PDF-": "application/pdf",
    b"PK\x03\x04": "application/zip",
    b"fLaC": "audio/flac",
}


#: Bytes between the sums that a payload keeps.
SUMMED = 1 << 14
#: The polynomial of CRC-32, lowest power first.
_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials of CRC-32."""
    out = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            out ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return out


@lru_cache(64)
def _zeros(k: int) -> int:
    """What 2**k zero bytes behind a text multiply its CRC-32 by."""
    if not k:
        return 1 << 23
    half = _zeros(k - 1)
    return _times(half, half)


def _shifted(crc: int, size: int) -> int:
    k = 0
    while size:
        if size & 1:
            crc = _times(crc, _zeros(k))
        size, k = size >> 1, k + 1
    return crc


class Buffer(bytes):
    """Bytes, with what the validators have found in them: each part is looked for once, however often a format seems to begin."""

    def __init__(self, _data: bytes = b""):
        self._places: dict[bytes, list[int]] = {}
        self.jpeg: dict[int, tuple[int, bool]] = {}
        self.gif: dict[int, tuple[int, bool]] = {}
        self.blocks: dict[int, int] = {}
        self.png: dict[int, int] = {}
        self.flac: dict[int, bool] = {}
        #: Of chunks of a RIFF: the next one's place, a place further on, what stands up to either, and how far the last one is.
        self.riff: dict[int, tuple[int, int, int, int, int]] = {}

    def places(self, what: bytes) -> list[int]:
        if what not in self._places:
            self._places[what] = [m.start() for m in re.finditer(re.escape(what), self)]
        return self._places[what]

    @cached_property
    def markers(self) -> list[int]:
        """Places that end a scan of a JPEG: 0xFF before neither a stuffed zero nor a restart."""
        return [m.start() for m in re.finditer(rb"\xff(?![\x00\xd0-\xd7])", self)]

    @cached_property
    def _sums(self) -> list[int]:
        """CRC-32 of the first 0, SUMMED, 2 SUMMED ... bytes."""
        out = [0]
        for at in range(0, len(self), SUMMED):
            out.append(zlib.crc32(self[at : at + SUMMED], out[-1]))
        return out

    def _sum_to(self, end: int) -> int:
        k = end // SUMMED
        return zlib.crc32(self[k * SUMMED : end], self._sums[k])

    def crc(self, start: int, end: int) -> int:
        """CRC-32 of a part, in a time that its length does not matter for."""
        if end - start <= 4 * SUMMED:
            return zlib.crc32(self[start:end])
        return self._sum_to(end) ^ _shifted(self._sum_to(start), end - start)

    @cached_property
    def archives(self) -> dict[int, int]:
        """Start -> end of the archives whose end record and directory are sound."""
        out: dict[int, int] = {}
        for pos in self.places(b"PK\x05\x06"):
            if pos + 22 <= len(self):
                size, start, note = struct.unpack_from("<IIH", self, pos + 12)
                at = pos - size - start
                if at >= 0 and (not size or self[at + start : at + start + 4] == b"PK\x01\x02") and pos + 22 + note <= len(self):
                    out.setdefault(at, pos + 22 + note)
        return out


def _chunk(b: Buffer, pos: int) -> tuple[int, int, int, int, int]:
    """Of the chunk at pos: the next place, a place further on, which of fmt (1) and data (2) stand before either, and its depth from the last."""
    path = []
    while pos not in b.riff:
        if pos + 8 > len(b):
            b.riff[pos] = pos, pos, 0, 0, 0
            break
        path.append(pos)
        size = struct.unpack_from("<I", b, pos + 4)[0]
        pos += 8 + size + (size & 1)
    for at in reversed(path):
        name = b[at : at + 4]
        own = 1 if name == b"fmt " else 2 if name == b"data" else 0
        _, far, _, mask, depth = b.riff[pos]
        _, further, _, more, deep = b.riff[far]
        if depth - deep == deep - b.riff[further][4]:
            b.riff[at] = pos, further, own, own | mask | more, depth + 1
        else:
            b.riff[at] = pos, pos, own, own, depth + 1
        pos = at
    return b.riff[pos]


def _wav(b: Buffer, at: int) -> int:
    if len(b) < at + 12 or b[at + 8 : at + 12] != b"WAVE":
        return 0
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    if end > len(b):
        return 0
    pos, seen = at + 12, 0
    while pos < end:
        nxt, far, own, all_, _ = _chunk(b, pos)
        if nxt == pos:
            return 0
        pos, seen = (far, seen | all_) if far <= end else (nxt, seen | own)
    return end - at if pos == end and seen == 3 else 0


def _png(b: Buffer, at: int) -> int:
    """Chunks with right sums up to the end chunk; the first is a header of 13 bytes."""
    if b[at + 8 : at + 16] != b"\0\0\0\rIHDR":
        return 0
    pos, path, end = at + 8, [], 0
    while pos not in b.png:
        stop = pos + 12 + struct.unpack_from(">I", b, pos)[0] if pos + 12 <= len(b) else 0
        if not pos < stop <= len(b):
            break
        path.append((pos, stop))
        if b[pos + 4 : pos + 8] == b"IEND":
            end = stop
            break
        pos = stop
    else:
        end = b.png[pos]
    # sums only once the chunks lead to an end
    for pos, stop in reversed(path):
        if end and b.crc(pos + 4, stop - 4) != struct.unpack_from(">I", b, stop - 4)[0]:
            end = 0
        b.png[pos] = end
    return end - at if end else 0


def _blocks(b: Buffer, pos: int) -> int:
    """Past a chain of GIF sub-blocks, or -1."""
    path = []
    while pos not in b.blocks:
        if pos >= len(b):
            b.blocks[pos] = -1
        elif not b[pos]:
            b.blocks[pos] = pos + 1
        else:
            path.append(pos)
            pos += 1 + b[pos]
    end = b.blocks[pos]
    b.blocks.update(dict.fromkeys(path, end))
    return end


def _gif(b: Buffer, at: int) -> int:
    if len(b) < at + 13:
        return 0
    flags = b[at + 10]
    pos = at + 13 + (3 << ((flags & 7) + 1) if flags & 128 else 0)
    path, end, images = [], 0, False
    while pos not in b.gif:
        nxt, image = -1, False
        if 0 <= pos < len(b):
            if b[pos] == 0x3B:
                end = pos + 1
            elif b[pos] == 0x21:
                nxt = _blocks(b, pos + 2)
            elif b[pos] == 0x2C and pos + 10 < len(b):
                local, image = b[pos + 9], True
                nxt = _blocks(b, pos + 11 + (3 << ((local & 7) + 1) if local & 128 else 0))
        path.append((pos, image))
        if nxt < 0:
            break
        pos = nxt
    else:
        end, images = b.gif[pos]
    for pos, image in reversed(path):
        images |= image
        b.gif[pos] = end, images
    return end - at if end and images else 0


def _jpeg(b: Buffer, at: int) -> int:
    """Segments and scans up to the end marker. Where two walks meet, the second takes over what the first has found."""
    pos, path, end, scanned = at + 2, [], 0, False
    while True:
        if pos in b.jpeg:
            end, scanned = b.jpeg[pos]
            break
        scan = False
        if pos + 2 > len(b) or b[pos] != 0xFF:
            break
        if b[pos + 1] == 0xD9:
            end = pos + 2
            break
        size = struct.unpack_from(">H", b, pos + 2)[0] if pos + 4 <= len(b) else 0
        if size < 2:
            break
        nxt = pos + 2 + size
        if b[pos + 1] == 0xDA:
            scan = True
            k = bisect_left(b.markers, nxt)
            nxt = b.markers[k] if k < len(b.markers) else -1
        path.append((pos, scan))
        if nxt < 0:
            break
        pos = nxt
    if pos not in b.jpeg:
        b.jpeg[pos] = end, scanned
    for pos, scan in reversed(path):
        scanned |= scan
        b.jpeg[pos] = end, scanned
    return end - at if scanned and end else 0


def _bmp(b: Buffer, at: int) -> int:
    if len(b) < at + 26:
        return 0
    size, _, start, head = struct.unpack_from("<IIII", b, at + 2)
    return size if head in (12, 40, 52, 56, 108, 124) and 14 + head <= start <= size <= len(b) - at else 0


def _pdf(b: Buffer, at: int) -> int:
    k = bisect_left(b.places(b"%%EOF"), at)
    end = b.places(b"%%EOF")[k] if k < len(b.places(b"%%EOF")) else -1
    j = bisect_left(b.places(b"startxref"), at)
    return end + 5 - at if j < len(b.places(b"startxref")) and b.places(b"startxref")[j] + 9 <= end else 0


def _zip(b: Buffer, at: int) -> int:
    """An archive starts where the first sound end record says; local headers of its other files start none."""
    return b.archives.get(at, at) - at


def _flac(b: Buffer, at: int) -> int:
    """FLAC frames have no length: metadata must be sound, and the stream is taken to the end."""
    if at + 8 > len(b) or b[at + 4] & 127 or b[at + 5 : at + 8] != b"\0\0\x22":
        return 0
    pos, path, sound = at + 4, [], False
    while pos not in b.flac:
        if pos + 4 > len(b):
            break
        path.append(pos)
        last, pos = b[pos] & 128, pos + 4 + int.from_bytes(b[pos + 1 : pos + 4], "big")
        if last:
            sound = pos + 2 <= len(b) and b[pos] == 0xFF and b[pos + 1] & 0xFC == 0xF8
            break
    else:
        sound = b.flac[pos]
    b.flac.update(dict.fromkeys(path, sound))
    return len(b) - at if sound else 0


VALID = {"audio/wav": _wav, "image/png": _png, "image/gif": _gif, "image/jpeg": _jpeg, "image/bmp": _bmp, "application/pdf": _pdf, "application/zip": _zip, "audio/flac": _flac}


@lru_cache(1)
def automaton():
    a = ahocorasick.Automaton()
    for magic, kind in MAGIC.items():
        a.add_word(magic.decode("latin-1"), (len(magic), kind))
    a.make_automaton()
    return a


def sniff(data: bytes) -> list[tuple[str, int, int]]:
    """(type, offset, length) of the sound media in data, outermost first; what lies within one of them is carved too."""
    found, data = [], Buffer(data)
    for end, (n, kind) in automaton().iter(data.decode("latin-1")):
        at = end - n + 1
        if size := VALID[kind](data, at):
            found.append((kind, at, size))
    return sorted(found, key=lambda x: (x[1], -x[2], x[0]))


FOUND = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))


def sniff_column(df: DataFrame, key: str, data: str, declared: str) -> DataFrame:
    """key, type (corrected), was_right, media: array<struct<type,start,length>> of all sound media, carved ones included."""
    from .bpe import _arrow_type

    schema = pa.schema([(key, _arrow_type(df, key)), ("type", pa.string()), ("was_right", pa.bool_()), ("media", FOUND)])

    def make():
        def step(c):
            found = [sniff(bytes(b or b"")) for b in c[data]]
            types = [next((k for k, at, _ in f if at == 0), UNKNOWN) for f in found]
            return {key: c[key], "type": types, "was_right": [a == b for a, b in zip(types, c[declared], strict=True)], "media": [[dict(zip(("type", "start", "length"), m, strict=True)) for m in f] for f in found]}

        return step

    return map_rows(df.select(key, data, declared), make, schema, rows=64)


def to_wav(payload: bytes) -> bytes:
    """8-bit mono PCM; an odd payload gets the pad byte that RIFF asks for."""
    pad = b"\0" * (len(payload) & 1)
    body = b"WAVE" + b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload + pad
    return b"RIFF" + struct.pack("<I", len(body)) + body


def samples(media: bytes, at: int, length: int) -> bytes:
    """The data chunks of the RIFF at `at`."""
    pos, out = at + 12, []
    while pos + 8 <= at + length:
        name, size = media[pos : pos + 4], struct.unpack_from("<I", media, pos + 4)[0]
        if name == b"data":
            out.append(media[pos + 8 : pos + 8 + size])
        pos += 8 + size + (size & 1)
    return b"".join(out)


def features(kind: str, data: bytes, inner: int) -> str:
    """Type, samples, mean level, loudness, crossings of the mean, carved media: of 8-bit samples."""
    x = np.frombuffer(data, np.uint8).astype(np.int64)
    n, total = len(x), int(x.sum())
    above = x * n > total
    power = int(((x - 128) ** 2).sum())
    return f"{kind};rate={RATE};samples={n};mean={total * 1000 // max(n, 1)};power={power // max(n, 1)};crossings={int((above[1:] != above[:-1]).sum())};carved={inner}"


def store_texts(df: DataFrame) -> DataFrame:
    """doc_id, media binary, declared string: every text's padded bytes in a RIFF container, under a wrong name on purpose."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary()), ("declared", pa.string())])

    def make():
        def step(c):
            raw = [(t or "").encode() for t in c["text"]]
            return {"doc_id": c["doc_id"], "n_bytes": list(map(len, raw)), "media": [to_wav(b + b" " * (max(1, -(-len(b) // UNIT)) * UNIT - len(b))) for b in raw], "declared": ["image/png"] * len(raw)}

        return step

    return map_rows(df.select("doc_id", "text"), make, schema, rows=256)


def read_media(df: DataFrame) -> DataFrame:
    """From doc_id, n_bytes, media, declared: sniff, carve the outermost sound, read it back and describe it."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("type", pa.string()), ("was_right", pa.bool_()), ("carved", pa.int64())])

    def make():
        def step(c):
            rows = []
            for key, n, media, declared in zip(c["doc_id"], c["n_bytes"], c["media"], c["declared"], strict=True):
                media = bytes(media or b"")
                found = sniff(media)
                kind, at, size = next((f for f in found if f[1] == 0), (UNKNOWN, 0, 0))
                data = samples(media, at, size) if kind == "audio/wav" else b""
                rows.append((key, n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(media), hashlib.sha256(media).hexdigest(), features(kind, data, len(found) - (size > 0)), kind, kind == declared, len(found) - (size > 0)))
            return dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True))

        return step

    return map_rows(df.select("doc_id", "n_bytes", "media", "declared"), make, schema, rows=256)
