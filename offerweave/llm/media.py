"""Media columns: what bytes are, whatever they were declared to be.

An Aho-Corasick automaton finds every magic number of a value in one pass.  A format
validator then confirms each hit by the format's own structure and lengths.  A confirmed
hit at the start corrects the declared type; confirmed hits further on are carved out as
embedded media.  Hits without structure are dropped.

Work is in proportion to the value: end markers are found once per value and say where their
start must be, and where one hit's walk over parts has failed, no later hit's walk goes on.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.common import bound_batches, small_batches, text_or_empty, worker_cache

RATE = 8000
UNKNOWN = "application/octet-stream"


def wav(payload: bytes, rate: int = RATE) -> bytes:
    """The payload as one channel of 8-bit PCM samples."""
    pad = b"\0" * (len(payload) % 2)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload) + len(pad), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload + pad


class Value:
    """A value's bytes and what its validators share."""

    def __init__(self, raw: bytes):
        self.raw, self.failed = raw, {}
        self._zero = (0, -1)
        self._marks: list[int] | None = None
        self._zip: dict[int, int] | None = None
        self._pdf: dict[int, int] | None = None

    def dead(self, kind: object) -> set[int]:
        """Places from which a walk over parts of this kind is known to fail."""
        return self.failed.setdefault(kind, set())

    def marker(self, pos: int) -> int:
        """The next 0xFF from ``pos`` that is neither stuffed nor a restart mark; -1 if there is none."""
        if self._marks is None:
            self._marks = [m.start() for m in re.finditer(rb"\xff(?![\x00\xd0-\xd7])(?!\Z)", self.raw, re.S)]
        at = bisect_left(self._marks, pos)
        return self._marks[at] if at < len(self._marks) else -1

    def zero(self, pos: int) -> int:
        """The next zero byte from ``pos``; -1 if there is none."""
        low, high = self._zero
        if not low <= pos <= high:
            high = self.raw.find(b"\0", pos)
            self._zero = (pos, high if high >= 0 else len(self.raw))
        return -1 if high < 0 or high >= len(self.raw) else high

    def zip_ends(self) -> dict[int, int]:
        """Start -> end of archives: an end record holds the distance to its start."""
        if self._zip is None:
            b, self._zip = self.raw, {}
            end = b.find(b"PK\x05\x06")
            while 0 <= end <= len(b) - 22:
                size, start = struct.unpack("<II", b[end + 12 : end + 20])
                at = end - size - start
                if at >= 0 and b[at + start : at + start + 4] in (b"PK\x01\x02", b"PK\x05\x06"):
                    self._zip.setdefault(at, end + 22 + int.from_bytes(b[end + 20 : end + 22], "little"))
                end = b.find(b"PK\x05\x06", end + 1)
        return self._zip

    def pdf_ends(self) -> dict[int, int]:
        """Start -> last end of documents whose trailer points at a cross-reference section.

        The section is the last table or object before the trailer, or lies where the trailer says
        as seen from the last start (a linearised file).
        """
        if self._pdf is None:
            b, self._pdf = self.raw, {}
            starts, sections, last = set(), [], -1
            for m in _PDF_MARKS.finditer(b):
                if m.lastgroup == "start":
                    last = m.start()
                    starts.add(last)
                elif m.lastgroup in ("table", "object"):
                    sections = [m.start(), *sections[:1]]
                else:
                    offset = int(m["offset"])
                    for at in (*(x - offset for x in sections), last):
                        if at in starts and _PDF_SECTION.match(b, at + offset):
                            self._pdf[at] = m.end()
                            break
        return self._pdf


_PDF_MARKS = re.compile(rb"(?P<start>%PDF-)|(?P<table>(?<!t)xref)|(?P<object>(?<![0-9])[0-9]{1,10} [0-9]{1,5} obj)|startxref[\r\n ]{1,4}(?P<offset>[0-9]{1,15})[\r\n ]{1,4}%%EOF")
_PDF_SECTION = re.compile(rb"xref|[0-9]{1,10} [0-9]{1,5} obj")


def _riff(v: Value, at: int) -> tuple[str, int] | None:
    b = v.raw
    kinds = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/x-msvideo"}
    if at + 12 > len(b) or (kind := kinds.get(b[at + 8 : at + 12])) is None:
        return None
    end = at + 8 + int.from_bytes(b[at + 4 : at + 8], "little")
    if end > len(b):
        return None
    pos, seen, dead = at + 12, [], v.dead(("riff", end))
    while pos + 8 <= end and pos not in dead:
        seen.append(pos)
        size = int.from_bytes(b[pos + 4 : pos + 8], "little")
        pos += 8 + size + size % 2
    if seen and pos == end:
        return kind, end - at
    dead.update(seen)
    return None


def _png(v: Value, at: int) -> tuple[str, int] | None:
    b, pos, seen, dead = v.raw, at + 8, [], v.dead("png")
    if b[pos + 4 : pos + 8] != b"IHDR":
        return None
    while pos + 12 <= len(b) and pos not in dead:
        seen.append(pos)
        size, name = int.from_bytes(b[pos : pos + 4], "big"), b[pos + 4 : pos + 8]
        end = pos + 12 + size
        if end > len(b) or zlib.crc32(memoryview(b)[pos + 4 : end - 4]) != int.from_bytes(b[end - 4 : end], "big"):
            break
        if name == b"IEND":
            return "image/png", end - at
        pos = end
    dead.update(seen)
    return None


def _gif(v: Value, at: int) -> tuple[str, int] | None:
    b = v.raw
    if at + 13 > len(b):
        return None
    pos, seen, dead = at + 13 + (3 << ((b[at + 10] & 7) + 1) if b[at + 10] & 128 else 0), [], v.dead("gif")
    inner = v.dead("gif blocks")
    while pos < len(b) and pos not in dead:
        seen.append(pos)
        if b[pos] == 0x3B:
            return "image/gif", pos + 1 - at
        if b[pos] == 0x21:
            pos += 2
        elif b[pos] == 0x2C and pos + 10 <= len(b):
            pos += 11 + (3 << ((b[pos + 9] & 7) + 1) if b[pos + 9] & 128 else 0)
        else:
            break
        blocks = []
        while pos < len(b) and b[pos] and pos not in inner:
            blocks.append(pos)
            pos += b[pos] + 1
        if pos >= len(b) or pos in inner:  # no end of the blocks
            inner.update(blocks)
            break
        pos += 1
    dead.update(seen)
    return None


def _jpeg(v: Value, at: int) -> tuple[str, int] | None:
    b, pos, scan, seen = v.raw, at + 2, False, []
    while pos + 2 <= len(b) and pos not in v.dead(("jpeg", scan)):
        seen.append((scan, pos))
        if b[pos] != 0xFF:
            break
        if b[pos + 1] == 0xD9:
            if scan:
                return "image/jpeg", pos + 2 - at
            break
        size = int.from_bytes(b[pos + 2 : pos + 4], "big")
        if size < 2 or b[pos + 1] in (0x00, 0xD8):
            break
        scan |= (start := b[pos + 1] == 0xDA)
        pos += 2 + size
        if start and (pos := v.marker(pos)) < 0:
            break
    for state, place in seen:
        v.dead(("jpeg", state)).add(place)
    return None


def _gzip(v: Value, at: int) -> tuple[str, int] | None:
    b, pos, dead = v.raw, at + 10, v.dead("deflate")
    if pos > len(b) or (flags := b[at + 3]) & 0xE0:
        return None
    if flags & 4:
        pos += 2 + int.from_bytes(b[pos : pos + 2], "little")
    for text in (flags & 8, flags & 16):
        if text:
            pos = v.zero(pos) + 1
            if not pos:
                return None
    pos += 2 if flags & 2 else 0
    if pos in dead:
        return None
    unpack, crc, size, begin, step = zlib.decompressobj(-15), 0, 0, pos, 256
    try:
        while pos < len(b) and not unpack.eof:
            out = unpack.decompress(b[pos : pos + step])
            crc, size, pos, step = zlib.crc32(out, crc), size + len(out), pos + step, min(2 * step, 1 << 16)
    except zlib.error:
        dead.add(begin)
        return None
    end = min(pos, len(b)) - len(unpack.unused_data)
    if unpack.eof and b[end : end + 8] == struct.pack("<II", crc, size % (1 << 32)):
        return "application/gzip", end + 8 - at
    dead.add(begin)
    return None


def _pdf(v: Value, at: int) -> tuple[str, int] | None:
    end = v.pdf_ends().get(at)
    return None if end is None else ("application/pdf", end - at)


def _zip(v: Value, at: int) -> tuple[str, int] | None:
    end = v.zip_ends().get(at)
    return None if end is None else ("application/zip", end - at)


def _ogg(v: Value, at: int) -> tuple[str, int] | None:
    b, pos, seen, dead = v.raw, at, [], v.dead("ogg")
    if at + 6 > len(b) or not b[at + 5] & 2:
        return None
    while b[pos : pos + 4] == b"OggS" and pos + 27 <= len(b) and b[pos + 4] == 0 and pos not in dead:
        seen.append(pos)
        table = b[pos + 27 : pos + 27 + b[pos + 26]]
        end = pos + 27 + b[pos + 26] + sum(table)
        if end > len(b):
            break
        if b[pos + 5] & 4:
            return "audio/ogg", end - at
        pos = end
    dead.update(seen)
    return None


def _bmp(v: Value, at: int) -> tuple[str, int] | None:
    b = v.raw
    if at + 26 > len(b):
        return None
    size, spare, start, head = struct.unpack("<IIII", b[at + 2 : at + 18])
    return ("image/bmp", size) if spare == 0 and head in (12, 40, 52, 56, 108, 124) and 14 + head <= start <= size <= len(b) - at else None


#: Magic numbers and validators; the numbers are those of the formats.
SIGNATURES = {
    b"RIFF": _riff, b"\x89PNG\r\n\x1a\n": _png, b"GIF87a": _gif, b"GIF89a": _gif, b"\xff\xd8\xff": _jpeg,
    b"\x1f\x8b\x08": _gzip, b"%PDF-": _pdf, b"PK\x03\x04": _zip, b"OggS": _ogg, b"BM": _bmp,
}


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for magic, check in SIGNATURES.items():
        found.add_word(magic.decode("latin-1"), (len(magic), check))
    found.make_automaton()
    return found


def sniff(value: bytes | None, declared: str | None = None) -> dict:
    """The true type and the embedded media of a value.

    Returns ``type`` (the confirmed type at the start, else application/octet-stream),
    ``corrected`` (whether that differs from the declared one) and ``carved``, a list of
    (offset, length, type) of confirmed media after the start, in order; within a carved
    span only its own start counts.  Null counts as empty bytes.
    """
    value = value or b""
    shared = Value(value)
    kind, carved, end = UNKNOWN, [], 1
    for last, (size, check) in worker_cache("media:magic", _automaton).iter(value.decode("latin-1")):
        at = last - size + 1
        if 0 < at < end or not (hit := check(shared, at)):
            continue
        if at == 0:
            kind = hit[0]
        else:
            carved.append((at, hit[1], hit[0]))
            end = at + hit[1]
    return {"type": kind, "corrected": kind != (declared or UNKNOWN), "carved": carved}


def samples_of(value: bytes) -> bytes:
    """The 8-bit samples that ``wav`` stored."""
    size = int.from_bytes(value[40:44], "little")
    if value[:4] != b"RIFF" or value[36:40] != b"data" or 44 + size > len(value):
        raise ValueError("not a stored payload")
    return value[44 : 44 + size]


def payload_of(text: str) -> tuple[int, bytes]:
    raw = text.encode("utf-8", "replace")
    return len(raw), raw + b"\0" * (64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)


def store_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, declared, media)``: each text as a media value of a wrongly declared type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            both = [payload_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([n for n, _ in both], pa.int64()), pa.array(["image/png"] * len(both)), pa.array([wav(p) for _, p in both], pa.binary())],
                names=["doc_id", "n_bytes", "declared", "media"],
            )

    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, n_bytes bigint, declared string, media binary")


def sniff_media(media: DataFrame) -> DataFrame:
    """``media(..., declared, media)`` -> the same columns without ``media`` and what the stored bytes hold.

    Adds media_type, corrected, carved (array of offset, length, type), media_bytes,
    media_sha256 and, for stored payloads, payload_bytes, payload_sha256, tail_crc32 and
    feature.  Null media count as empty bytes of unknown type; clashing extra columns are
    dropped; no rows give no rows.
    """
    kept = [c for c in media.columns if c in ("doc_id", "n_bytes", "declared")]
    fields = "media_type string, corrected boolean, carved array<struct<offset:bigint,length:bigint,type:string>>, media_bytes bigint, media_sha256 string, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, feature string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string())]))
        kinds = [pa.string(), pa.bool_(), spans, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        for batch in small_batches(batches, "media"):
            rows = []
            for value, declared in zip(batch.column("media").to_pylist(), batch.column("declared").to_pylist(), strict=True):
                value = value or b""
                got = sniff(value, declared)
                row = [got["type"], got["corrected"], [{"offset": o, "length": n, "type": t} for o, n, t in got["carved"]], len(value), hashlib.sha256(value).hexdigest()]
                if got["type"] == "audio/wav" and value[36:40] == b"data":
                    payload = samples_of(value)
                    codes = np.frombuffer(payload, np.uint8)
                    counts = np.bincount(codes, minlength=256)
                    feature = f"{got['type']};samples={len(codes)};carved={len(got['carved'])};sum={int(codes.sum(dtype=np.int64))};zeros={int(counts[0])};levels={int((counts > 0).sum())}"
                    row += [len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), feature]
                else:
                    row += [None, None, None, f"{got['type']};carved={len(got['carved'])}"]
                rows.append(row)
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = [x.split()[0] for x in fields.replace("struct<offset:bigint,length:bigint,type:string>", "s").split(", ")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=[*kept, *names])

    before = ", ".join(f"{c} {media.schema[c].dataType.simpleString()}" for c in kept)
    return media.select(*dict.fromkeys([*kept, "declared", "media"])).mapInArrow(run, f"{before}, {fields}")
