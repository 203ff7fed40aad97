"""WARC archives with a two-level capture index.

Pages are written as gzipped WARC records, one member each, so that a record can be read
by its place alone. Captures are sorted by their URL with the host reversed and stored in
compressed blocks; at the end of each index file a sparse directory holds the first key
of every block. A lookup finds the file, then the block, then the line by binary search,
and fetches only that block and, from the archive, only the records it asked for.

Tasks write to the shared folder through pyarrow's file systems, each attempt under a new
name; only the files that the captures and the list of index files name count, so a repeated
task does no harm. The captures are the only table that Spark stores on the way.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import column_of, small_batches, stored
from tillstar.sinks import shared_path

BLOCK_LINES = 1000
FILE_BYTES = 64 << 20
# Ranges of one archive this near to each other are fetched together, up to so much.
_GAP, _MOST_FETCHED = 64 << 10, 4 << 20
# No table says when a page was fetched.
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder given as a path or URI, and the path in it."""
    local = re.match(r"(?:file:(?://)?)?(/.*)", root)
    return (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(root)


def sort_key(url: str = "url") -> Column:
    """``com,example,www)/path?query``; a url without host is its own key, a null one empty."""
    host = F.lower(F.regexp_extract(F.col(url), "://([^/?#]*)", 1))
    rest = F.regexp_extract(F.col(url), "://[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.coalesce(F.when(F.col(url).contains("://"), key).otherwise(F.col(url)), F.lit(""))


# --- records --------------------------------------------------------------------------


def _record_id(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


def _headers(lines: dict) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in lines.items() if v is not None).encode() + b"\r\n"


def warc_record(page_id, url: str | None, payload: bytes, digest: str, revisit: bool, first) -> bytes:
    """One gzip member. A revisit keeps the HTTP headers and refers to the first record."""
    http = b"HTTP/1.1 200 OK\r\n" + _headers(
        {"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)}
    )
    body = http if revisit else http + payload
    # Control characters and blanks would break the header line.
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    head = b"WARC/1.1\r\n" + _headers(
        {
            "WARC-Type": "revisit" if revisit else "response",
            "WARC-Record-ID": _record_id(page_id),
            "WARC-Date": _DATE,
            "WARC-Target-URI": target,
            "WARC-Payload-Digest": f"sha1:{digest}",
            "WARC-Refers-To": _record_id(first) if revisit else None,
            "WARC-Profile": _PROFILE if revisit else None,
            "Content-Type": "application/http; msgtype=response",
            "Content-Length": len(body),
        }
    )
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(head + body + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> dict:
    """What a record says; the digest of a response is taken from its payload again."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    named = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(named["Content-Length"])].partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    if named["WARC-Type"] == "response":
        digest, refers = base64.b32encode(hashlib.sha1(payload).digest()).decode(), None
        if f"sha1:{digest}" != named["WARC-Payload-Digest"] or size != len(payload):
            raise ValueError(f"damaged record {named['WARC-Record-ID']}")
    else:
        digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
        refers = _page_of(named["WARC-Refers-To"])
    return {
        "page_id": _page_of(named["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": named["WARC-Type"],
        "refers_to": refers,
        "payload": payload if named["WARC-Type"] == "response" else None,
    }


# --- writing --------------------------------------------------------------------------


def with_first(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html) as page_id, url, payload, its SHA-1, revisit and first.

    Of equal payloads of at least ``least_bytes`` bytes the one with the smallest page_id
    is a response, the others revisit it. Rows that share that page_id too are responses
    each; a null id is smallest only among its like. A null html is an empty payload.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    rows = rows.withColumn("size", F.octet_length("payload"))
    large = F.col("size") >= least_bytes
    first = rows.where(large).groupBy("sha")
    first = first.agg(F.min("size").alias("size"), F.min("page_id").alias("first"))
    # By sha alone the sums would stay where they were made, and Spark could not split the
    # rows of a payload with very many copies.
    rows = rows.join(first, ["sha", "size"], "left")
    revisit = large & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select("page_id", "url", "payload", "sha", revisit.alias("revisit"), "first")


def write_archives(pages: DataFrame, root: str, least_bytes: int = 0) -> DataFrame:
    """Write a record per row of (page_id, url, html), revisits as ``with_first`` has them;
    returns the stored captures: surt, page_id, file, offset, length.
    """
    names = ["surt", "page_id", "file", "offset", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = filesystem(root)
        out = name = None
        for batch in small_batches(batches, "payload"):
            places = []
            columns = ("page_id", "url", "payload", "sha", "revisit", "first")
            for row in zip(*(column_of(batch, c).to_pylist() for c in columns)):
                page_id, url, payload, sha, revisit, first = row
                digest = base64.b32encode(sha).decode()
                if out is None:
                    files.create_dir(base, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                member = warc_record(page_id, url, payload, digest, revisit, first)
                out.write(member)
                places.append((name, at, len(member)))
                at += len(member)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
            file, offset, length = zip(*places)
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "surt"),
                    column_of(batch, "page_id"),
                    pa.array(file),
                    pa.array(offset, pa.int64()),
                    pa.array(length, pa.int64()),
                ],
                names=names,
            )
        if out is not None:
            out.close()

    rows = with_first(pages, least_bytes).withColumn("surt", sort_key())
    return stored(
        rows.mapInArrow(run, "surt string, page_id long, file string, offset long, length long"),
        "captures",
    )


def _key(surt: str, page_id: int | None) -> tuple:
    """Spark's order: by the bytes of the text, null ids first."""
    return (surt.encode(), page_id is not None, page_id or 0)


def write_index(captures: DataFrame, root: str, block_lines: int = BLOCK_LINES) -> list[dict]:
    """Sort captures into index files below ``root``; returns a row per file, in order.

    A file is a sequence of compressed blocks, then its directory, compressed too. There
    are at most as many files as shuffle partitions, which bounds what the driver gets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = filesystem(root)
        lines, directory, at, out, name = [], [], 0, None, None

        def flush() -> int:
            block = zlib.compress("\n".join(map(json.dumps, lines)).encode(), 6)
            out.write(block)
            directory.append([lines[0][0], lines[0][1], at, len(block)])
            lines.clear()
            return len(block)

        for batch in batches:
            columns = ("surt", "page_id", "file", "offset", "length")
            for row in zip(*(column_of(batch, c).to_pylist() for c in columns)):
                if out is None:
                    files.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.idx"
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                lines.append(row)
                if len(lines) == block_lines:
                    at += flush()
        if out is None:
            return
        if lines:
            at += flush()
        footer = zlib.compress(json.dumps(directory).encode(), 6)
        out.write(footer)
        out.close()
        first = directory[0]
        yield pa.RecordBatch.from_pylist(
            [{"surt": first[0], "page_id": first[1], "file": name, "at": at, "size": len(footer)}],
            pa.schema(
                [
                    ("surt", pa.string()), ("page_id", pa.int64()), ("file", pa.string()),
                    ("at", pa.int64()), ("size", pa.int64()),
                ]
            ),
        )

    ordered = captures.repartitionByRange("surt", "page_id")
    ordered = ordered.sortWithinPartitions("surt", "page_id", "file", "offset")
    made = ordered.mapInArrow(run, "surt string, page_id long, file string, at long, size long")
    rows = [r.asDict() for r in made.collect()]
    return sorted(rows, key=lambda r: _key(r["surt"], r["page_id"]))


# --- reading --------------------------------------------------------------------------


class Index:
    """Lookups in the index files of a root."""

    def __init__(self, root: str, parts: list[dict]):
        self.files, self.base = filesystem(root)
        self.parts = parts
        self.firsts = [_key(p["surt"], p["page_id"]) for p in parts]
        self.directory: tuple = (None, [], [])
        self.block: tuple = (None, [], [])

    def _fetch(self, name: str, at: int, size: int) -> bytes:
        with self.files.open_input_file(f"{self.base}/{name}") as f:
            return zlib.decompress(f.read_at(size, at))

    def _directory(self, k: int) -> tuple:
        if self.directory[0] != k:
            part = self.parts[k]
            rows = json.loads(self._fetch(part["file"], part["at"], part["size"]))
            self.directory = (k, rows, [_key(r[0], r[1]) for r in rows])
        return self.directory

    def _lines(self, k: int, b: int) -> tuple:
        if self.block[0] != (k, b):
            _, rows, _ = self._directory(k)
            text = self._fetch(self.parts[k]["file"], rows[b][2], rows[b][3]).decode()
            lines = [json.loads(x) for x in text.split("\n")]
            self.block = ((k, b), lines, [_key(x[0], x[1]) for x in lines])
        return self.block

    def find(self, surt: str, page_id: int | None) -> Iterator[list]:
        """All lines of a key. They may run over blocks and files."""
        key = _key(surt, page_id)
        # The last part and block that begin before the key may end with it.
        k = max(bisect.bisect_left(self.firsts, key) - 1, 0)
        while k < len(self.parts) and self.firsts[k] <= key:
            _, rows, firsts = self._directory(k)
            b = max(bisect.bisect_left(firsts, key) - 1, 0)
            while b < len(rows) and firsts[b] <= key:
                _, lines, keys = self._lines(k, b)
                for at in range(bisect.bisect_left(keys, key), bisect.bisect_right(keys, key)):
                    yield lines[at]
                b += 1
            k += 1


def lookup(keys: DataFrame, root: str, parts: list[dict]) -> DataFrame:
    """(file, offset, length) of every capture of the keys (surt, page_id).

    Keys are sorted first, so that a task goes through neighbouring blocks once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(root, parts)
        for batch in batches:
            found = [
                line[2:]
                for key in zip(*(column_of(batch, c).to_pylist() for c in ("surt", "page_id")))
                for line in index.find(*key)
            ]
            if found:
                file, offset, length = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file), pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
                    names=["file", "offset", "length"],
                )

    keys = keys.select("surt", "page_id").distinct()
    keys = keys.repartitionByRange("surt", "page_id").sortWithinPartitions("surt", "page_id")
    return keys.mapInArrow(run, "file string, offset long, length long")


def read_records(places: DataFrame, root: str, with_payload: bool = False) -> DataFrame:
    """Read records by place: page_id, payload_bytes, payload_digest, record_type,
    refers_to, and the payload of responses if asked for.

    Places are brought together by archive, whose size is bounded, and neighbouring ones
    are fetched at once.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    types = [
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
    if with_payload:
        schema, types = schema + ", payload binary", [*types, ("payload", pa.binary())]

    def ranges(rows):
        """Neighbours in one file, with their places."""
        group: list = []
        for row in rows:
            if group and (
                row[0] != group[0][0]
                or row[1] - (group[-1][1] + group[-1][2]) > _GAP
                or row[1] + row[2] - group[0][1] > _MOST_FETCHED
            ):
                yield group
                group = []
            group.append(row)
        if group:
            yield group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = filesystem(root)
        name = archive = None
        for batch in batches:
            columns = (column_of(batch, c).to_pylist() for c in ("file", "offset", "length"))
            for group in ranges(zip(*columns)):
                if group[0][0] != name:
                    if archive is not None:
                        archive.close()
                    name = group[0][0]
                    archive = files.open_input_file(f"{base}/{name}")
                begin = group[0][1]
                data = archive.read_at(group[-1][1] + group[-1][2] - begin, begin)
                records = [parse_record(data[o - begin : o - begin + n]) for _, o, n in group]
                yield pa.RecordBatch.from_pylist(records, pa.schema(types))
        if archive is not None:
            archive.close()

    ordered = places.repartition("file").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, schema)


def write_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archive pages in the shared folder, index them, and read every page back by lookup."""
    root = shared_path(pages.sparkSession, "archives")
    captures = write_archives(pages, root, least_bytes)
    parts = write_index(captures, root)
    return read_records(lookup(captures, root, parts), root)
