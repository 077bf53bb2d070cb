"""Very long and crafted values, and file formats nested in them."""

import gzip
import io
import struct
import time
import zipfile

import numpy as np
import pytest

from offerweave.llm import media, quality


@pytest.mark.parametrize(
    "part",
    [b"PK\3\4PK\5\6", b"PK\3\4", b"%PDF-", b"%PDF-1 startxref\n5\n%%EOF", b"1", b"GIF89a", b"GIF89a\0\0\0\0\0\0\0!\0\1a", b"\xff\xd8\xff", b"\xff\xd8\xff\xda\0\2", b"RIFF\x10\0\0\0WAVE",
     b"\x1f\x8b\x08", b"\x1f\x8b\x08\x08123456", b"\x1f\x8b\x08\0abcdef", b"OggS\0\2", b"BM"],
)
def test_crafted_values_take_seconds(part):
    began = time.time()
    media.sniff(part * (1_000_000 // len(part)))
    assert time.time() - began < 10


def pdf(body=b"%PDF-1.4\n1 0 obj\n<<>>\nendobj\n", shift=0):
    return body + b"xref\n0 1\ntrailer\n<<>>\nstartxref\n%d\n%%%%EOF" % (len(body) + shift)


def test_documents_end_where_their_last_trailer_ends():
    one = pdf()
    two = pdf(one + b"\n2 0 obj\n<<>>\nendobj\n")
    assert media.sniff(b"j" + two + b" tail " + one)["carved"] == [(1, len(two), "application/pdf"), (7 + len(two), len(one), "application/pdf")]
    assert media.sniff(pdf(shift=3))["type"] == media.UNKNOWN and media.sniff(one[:-1])["type"] == media.UNKNOWN
    stream = b"%PDF-1.5\n"
    stream += b"7 0 obj\n<</Type/XRef>>\nendobj\nstartxref\n%d\n%%%%EOF" % len(stream)
    assert media.sniff(stream)["type"] == "application/pdf"


def test_archives_and_their_trailers():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as f:
        f.writestr("a", "hello" * 100)
    pack, gz = raw.getvalue(), gzip.compress(b"hello" * 99_999 + bytes(range(256)) * 999)
    named = io.BytesIO()
    with gzip.GzipFile("name.txt", "wb", fileobj=named) as f:
        f.write(b"body")
    assert media.sniff(b"xx" + pack + gz + named.getvalue())["carved"] == [(2, len(pack), "application/zip"), (2 + len(pack), len(gz), "application/gzip"), (2 + len(pack) + len(gz), len(named.getvalue()), "application/gzip")]
    spoilt = gz[:-4] + struct.pack("<I", 1)
    assert media.sniff(spoilt)["type"] == media.UNKNOWN


def test_sums_of_long_texts_are_exact():
    lines = ["abc12 x|y", "", "Z" * 20]
    long = quality.line_features("a" * 17_000_000 + "\n" + "\n".join(lines))[0]
    short = quality.line_features("b\n" + "\n".join(lines))[0]
    assert np.array_equal(long[2:, :11], short[2:, :11])  # the second line's features do not depend on what came before


def naive_line(line):
    raw = line.encode()
    letters = sum(c >= 128 or chr(c).isalpha() for c in raw)
    return letters / max(1, len(raw)), sum(chr(c).isdigit() for c in raw if c < 128) / max(1, len(raw)), raw.count(b"|") / max(1, len(raw))


@pytest.mark.parametrize("text", ["", "\n", "a", "A1|é\n\n  two words\t!\n", "\n\n\n", "x\ny"])
def test_line_features_by_definition(text):
    got, lengths = quality.line_features(text)
    assert lengths.tolist() == [len(x.encode()) for x in text.split("\n")]
    assert np.allclose(got[:, [0, 2, 6]], [naive_line(x) for x in text.split("\n")])
