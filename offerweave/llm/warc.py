"""Web archives: records, revisits, and capture histories by an external index merge.

Pages are written as WARC records.  A task gathers its records into archives of about
``ARCHIVE_BYTES``; each archive is one binary value of a table in the shared scratch folder,
gzip member by gzip member.  Of equal payloads the largest page_id is the response and the
others are revisits without a body.  Reading goes through the archive bytes alone.

The index of an archive, sorted by URL key and timestamp, is one run.  Runs are cut into
blocks, and at range boundaries that a bounded sample of keys draws.  A range's blocks reach
its task in the order in which a merge needs them: first the first block of every run, then
each block by the last key of the block before it in its run, for that is when its run has
nothing left.  So a task holds one block of each run, reads its input once, and a loser tree
yields the globally ordered capture histories with one comparison per level and row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.common import bound_batches, join_hot, small_batches
from offerweave.plans.scratch import materialize

ARCHIVE_BYTES = 8 << 20
BROADCAST_ROWS = 200_000
#: Rows of a block, rows that a range aims at, and keys sampled for each boundary.
BLOCK_ROWS, RANGE_ROWS, SAMPLE = 256, 500_000, 100
FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=timezone.utc)


def url_key(url: str | None) -> str:
    """Host labels reversed and joined by commas, then the rest, lower-cased; no scheme, port 80/443, www or fragment."""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://", "", (url or "").strip().lower()).split("#", 1)[0]
    host, slash, path = rest.partition("/")
    host = re.sub(r"^www\d*\.|:(80|443)$", "", host.rsplit("@", 1)[-1])
    return f"{','.join(reversed(host.split('.')))}){slash}{path}"


def capture_time(page_id: int | None) -> str:
    """The table has no capture time: page n counts as captured n seconds after the first."""
    moment = FIRST_CAPTURE + timedelta(seconds=(page_id or 0) % 1_000_000_000)
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id: int | None, url: str | None, body: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; with ``refers_to`` a revisit, which keeps the HTTP head but no body."""
    kind = "response" if refers_to is None else "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body)
    head = [
        b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>".encode(),
        b"WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url or "").encode("utf-8", "replace"), f"WARC-Date: {capture_time(page_id)}".encode(),
        f"WARC-Payload-Digest: sha1:{digest}".encode(), b"Content-Type: application/http; msgtype=response",
    ]
    if refers_to is None:
        block += body
    else:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>".encode()]
    head.append(f"Content-Length: {len(block)}".encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    """Header lines after the first, by name."""
    lines = (x.decode("utf-8", "replace").partition(":") for x in head.split(b"\r\n")[1:])
    return {name: value.strip() for name, _, value in lines}


def records(archive: bytes) -> Iterator[tuple[int, int, dict[str, str], dict[str, str], bytes]]:
    """(offset, length, headers, HTTP headers, payload) of each gzip member of an archive."""
    at = 0
    while at < len(archive):
        unpack, parts, pos = zlib.decompressobj(31), [], at
        while not unpack.eof and pos < len(archive):  # in steps, so that what follows is not copied
            parts.append(unpack.decompress(archive[pos : pos + 16384]))
            pos = min(pos + 16384, len(archive))
        if not unpack.eof:
            raise ValueError("an archive ends within a record")
        raw, size = b"".join(parts), pos - at - len(unpack.unused_data)
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = _fields(head)
        n = int(fields["Content-Length"])
        if not raw.startswith(b"WARC/1.") or rest[n:] != b"\r\n\r\n":
            raise ValueError("a record's length does not fit")
        http, _, payload = rest[:n].partition(b"\r\n\r\n")
        yield at, size, fields, _fields(http), payload
        at += size


def write_archives(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``pages(page_id, url, html)`` -> the table ``(archive, content)`` that holds their records.

    Null html counts as empty.  Payloads shorter than ``min_bytes`` are never revisits.
    """
    bound_batches(pages.sparkSession)
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body"))
    base = base.withColumn("sha1", F.sha1("body"))
    several = base.filter(F.length("body") >= min_bytes).select("page_id", "sha1").groupBy("sha1").agg(F.max("page_id").alias("original"), F.count("*").alias("c")).filter("c > 1").select("sha1", "original")
    marked = join_hot(base, materialize(several, "equal-payloads"), ["sha1"], ["page_id", "url"], BROADCAST_ROWS, "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, first = [], 0, None

        def archive() -> pa.RecordBatch:
            content = b"".join(parts)
            name = f"{first}-{zlib.crc32(content):08x}-{len(content)}"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["archive", "content"])

        for batch in small_batches(batches, "body"):
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "body", "sha1", "refers_to"))
            for page_id, url, html, sha1, refers_to in zip(*columns, strict=True):
                raw = record(page_id, url, html, base64.b32encode(bytes.fromhex(sha1)).decode(), refers_to)
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = pack.compress(raw) + pack.flush()
                first = page_id if first is None else first
                parts.append(member)
                size += len(member)
                if size >= archive_bytes:
                    yield archive()
                    parts, size, first = [], 0, None
        if parts:
            yield archive()

    rows = marked.select("page_id", "url", "body", "sha1", refers.alias("refers_to"))
    return materialize(rows.mapInArrow(write, "archive string, content binary"), "archives")


_RUNS = "archive string, nth int, offset bigint, length bigint, url_key string, captured string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_runs(archives: DataFrame) -> DataFrame:
    """The archives' sorted index rows: one run per archive, ``nth`` is the place in the run.

    Payload digest and length of responses are computed from the body that was read back.
    """

    def number(field: str | None) -> int | None:
        found = re.search(r"page:(-?\d+)", field or "")
        return int(found[1]) if found else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows = []
                for at, size, head, http, payload in records(content):
                    revisit = head["WARC-Type"] == "revisit"
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    length = int(http["Content-Length"]) if revisit else len(payload)
                    rows.append((url_key(head["WARC-Target-URI"]), head["WARC-Date"], number(head["WARC-Record-ID"]), at, size, length, digest, head["WARC-Type"], number(head.get("WARC-Refers-To"))))
                rows.sort(key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, r[3]))
                key, when, page, at, size, length, digest, kind, refers = zip(*rows, strict=True) if rows else [()] * 9
                columns = ([name] * len(rows), range(len(rows)), at, size, key, when, page, length, digest, kind, refers)
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _RUNS.split(", ")])

    return archives.mapInArrow(read, _RUNS)


def loser_tree(runs: list[Iterator], key) -> Iterator:
    """Merge sorted iterators; inner nodes hold the losers, node 0 the winner."""
    k = len(runs)
    heads = [next(r, None) for r in runs]
    keys = [(1,) if h is None else (0, key(h), i) for i, h in enumerate(heads)]
    tree = [-1] * max(1, k)
    for i in range(k):
        winner, node = i, (i + k) // 2
        while node > 0 and tree[node] >= 0:
            if keys[tree[node]] < keys[winner]:
                tree[node], winner = winner, tree[node]
            node //= 2
        if node > 0:
            tree[node] = winner
        else:
            tree[0] = winner
    while k and heads[tree[0]] is not None:
        winner = tree[0]
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        keys[winner] = (1,) if heads[winner] is None else (0, key(heads[winner]), winner)
        node = (winner + k) // 2
        while node > 0:
            if keys[tree[node]] < keys[winner]:
                tree[node], winner = winner, tree[node]
            node //= 2
        tree[0] = winner


_ORDER = ["url_key", "captured", "has_page", "page", "archive", "nth"]
_ROWS = pa.schema([("archive", pa.string()), ("nth", pa.int32()), ("offset", pa.int64()), ("length", pa.int64()), ("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _key(row: tuple) -> tuple:
    """What index rows are ordered by; null page ids come first, and no two rows are equal."""
    return row[4], row[5], row[6] is not None, row[6] or 0, row[0], row[1]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in _ROWS.names), strict=True)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROWS, strict=True)], schema=_ROWS)


def _packed(rows: list[tuple]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _ROWS) as out:
        out.write_batch(_batch(rows))
    return sink.getvalue().to_pybytes()


def _unpacked(block: bytes) -> Iterator[tuple]:
    with pa.ipc.open_stream(block) as parts:
        for batch in parts:
            yield from _rows(batch)


_BLOCKS = "range int, run string, last boolean, url_key string, captured string, has_page boolean, page bigint, archive string, nth int, block binary"


def _cut(runs: DataFrame, bounds: list[tuple], block_rows: int) -> DataFrame:
    """Blocks of runs.  The key columns are those of the row before the block in its run and range; null if there is none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.int32(), pa.binary()]
        names = [x.split()[0] for x in _BLOCKS.split(", ")]
        run, place, before, rows = "", -1, (None,) * 6, []

        def block(last: bool) -> pa.RecordBatch:
            values = (place, run, last, *before, _packed(rows))
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            for row in _rows(batch):
                where = bisect_right(bounds, _key(row))
                if rows and (row[0] != rows[-1][0] or row[1] != rows[-1][1] + 1 or where != place):
                    yield block(True)
                    rows, before = [], (None,) * 6
                elif len(rows) >= block_rows:
                    yield block(False)
                    rows, before = [], _key(rows[-1])
                if not rows and before[0] is None:
                    # a run that a reader got in parts is as many runs
                    run, place = f"{row[0]}/{row[1]}", where
                rows.append(row)
        if rows:
            yield block(True)

    return runs.mapInArrow(cut, _BLOCKS)


def merge_blocks(blocks: Iterator[tuple[str, bool, bytes]]) -> Iterator[tuple]:
    """Rows in order from (run, last, block) in the order of need: one block of each run is held."""
    waiting = next(blocks, None)

    def rows(first: tuple[str, bool, bytes]) -> Iterator[tuple]:
        nonlocal waiting
        run, last, block = first
        while True:
            yield from _unpacked(block)
            if last:
                return
            if waiting is None or waiting[0] != run:
                raise ValueError("blocks are not in the order of need")
            (_, last, block), waiting = waiting, next(blocks, None)

    runs, seen = [], set()
    while waiting is not None and waiting[0] not in seen:
        seen.add(waiting[0])
        runs.append(rows(waiting))
        waiting = next(blocks, None)
    yield from loser_tree(runs, key=_key)


def _bounds(held: DataFrame, ranges: int) -> list[tuple]:
    """Boundaries of ``ranges`` ranges, from at most SAMPLE keys each, chosen by a hash; any choice gives the same order."""
    keys = held.select("url_key", "captured", F.col("page_id").isNotNull().alias("has_page"), F.coalesce("page_id", F.lit(0)).alias("page"), "archive", "nth")
    drawn = sorted(tuple(r) for r in keys.orderBy(F.xxhash64("archive", "nth"), "archive", "nth").limit(ranges * SAMPLE).collect())
    return sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []


def capture_histories(runs: DataFrame, ranges: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All runs merged into ranges that are ordered by (url_key, captured, page_id) within and between.

    Null page ids come first; equal rows follow archive and place.  ``ranges`` follow the number of
    rows, but are as many as shuffle partitions at least.
    """
    spark = runs.sparkSession
    held = materialize(runs, "runs")
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held.count() // RANGE_ROWS))
    bounds = _bounds(held, ranges)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        blocks = (x for b in batches for x in zip(*(b.column(c).to_pylist() for c in ("range", "run", "last", "block")), strict=True))
        place, first = None, next(blocks, None)
        while first is not None:  # a task may get several ranges
            place, rest = first[0], None

            def own(head=first, place=place):
                nonlocal rest
                yield head[1:]
                for x in blocks:
                    if x[0] != place:
                        rest = x
                        return
                    yield x[1:]

            for row in merge_blocks(own()):
                out.append(row)
                if len(out) == 4096:
                    yield _batch(out)
                    out = []
            first = rest
        if out:
            yield _batch(out)

    dealt = _cut(held, bounds, block_rows).repartitionByRange(len(bounds) + 1, "range")
    # a batch of blocks is small, so that what is read ahead is
    return dealt.sortWithinPartitions("range", *_ORDER).mapInArrow(merge, _RUNS)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives, read them back and merge their indexes; one row per page.

    Null and empty html are equal empty payloads.  Repeated rows with the largest page_id of
    their payload are all responses.  A null page_id stays null; such a page revisits
    the response with its payload, and is one itself if all pages of the payload lack an id.  Extra columns are ignored; no rows give no rows.
    """
    return capture_histories(read_runs(write_archives(pages, min_bytes)))
