"""WARC archives with a two-level capture index.

Writing: every page becomes a record in a ``.warc.gz`` file, one gzip member per record. Of records with equal payloads of at least
``min_payload`` bytes the one with the largest ``page_id`` is written as response, the others as revisits that refer to it.

Index: one line per record, sorted by its key: the URL with its host reversed (``com,example,www)/path``) and the capture's
``page_id``. Level one are sorted lines in gzip blocks of ``LINES_PER_BLOCK``, one file per range of keys; level two is a
sparse directory with the first key of every block. The first keys of the files (as many as partitions) are all that is shared with every task.

Reading: captures to look up are dealt to the files by binary search over those first keys; a task then searches a file's directory, reads the
block by its byte range, finds the line, and reads the record's byte range from its archive. Ranges that lie near each other are read at once.

Archives and index files go to the folder all executors share, through ``pyarrow.fs``, which opens local, HDFS, S3 and GCS paths. A file's name holds
the task attempt, and only the rows of the attempt that Spark accepted name it, so repeated and lost tasks leave at worst a file that nothing refers to.

Defined results: null html is an empty payload. A null or hostless URL has the key ``-``. A page without ``page_id`` is always a
response and nothing refers to it. Rows that repeat a ``page_id`` are
records of their own, each judged by its payload; of a payload's records all with the largest id are responses.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.llm.files import open_store, own_file
from docgraph.llm.text import slices, small_batches
from docgraph.llm.url_filter import url_host
from docgraph.plans.scratch import scratch_path, write_table

LINES_PER_BLOCK = 1000
# A gap up to which two byte ranges are read as one.
NEAR = 1 << 16
# Bytes of archive read at once.
READ_BYTES = 8 << 20
GZIP_LEVEL = 4
MIN_PAYLOAD = 0


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: Column) -> Column:
    """Reversed host and the rest of the URL: ``com,example,www)/path?query``; ``-`` without a host."""
    host = url_host(url)
    rest = F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*(?s:(.*))", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.when(F.coalesce(host, F.lit("")) == "", "-").otherwise(key)


def _header(kind: str, url: str, page_id: int | None, digest: str, refers_to: int | None, length: int) -> bytes:
    """The header of a record; a line break in a URL would end its field, so control characters are escaped."""
    url = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page_id if page_id is not None else 'none'}>",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines.append(f"Content-Type: text/html; charset=utf-8\r\nContent-Length: {length}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def write_record(kind: str, url: str, page_id: int | None, payload: bytes, digest: str, refers_to: int | None = None) -> bytes:
    """A record as one gzip member. A revisit has no block, as its payload is that of the record it refers to."""
    block = payload if kind == "response" else b""
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(_header(kind, url, page_id, digest, refers_to, len(block)) + block + b"\r\n\r\n") + packer.flush()


def read_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return fields, rest[:length]


def _number(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def _archive(folder: str):
    """Writes a task's records to an archive of its own; returns where each one stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, "", 0
        for batch in slices(batches, "html", READ_BYTES):
            if out is None:
                system, path, name = own_file(folder, ".warc.gz")
                out = system.open_output_stream(path, compression=None)
            places = []
            for page_id, url, payload, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                kind = "response" if refers_to is None else "revisit"
                member = write_record(kind, url or "", page_id, payload, payload_digest(payload), refers_to)
                out.write(member)
                places.append((at, len(member)))
                at += len(member)
            starts, lengths = (pa.array(x, pa.int64()) for x in zip(*places))
            files = pa.array([name] * len(places), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("capture"), files, starts, lengths], ["capture", "file", "at", "bytes"])
        if out is not None:
            out.close()

    return run


def _index(folder: str):
    """Writes a task's sorted lines in blocks to an index file, and the file's directory beside it; returns its first and last key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at, held = None, "", 0, []
        directory: list[str] = []
        first = last = ""

        def block() -> None:
            nonlocal at
            data = gzip.compress("".join(f"{c} {f} {a} {b}\n" for c, f, a, b in held).encode(), 6, mtime=0)
            out.write(data)
            directory.append(f"{held[0][0]} {at} {len(data)}\n")
            at += len(data)
            held.clear()

        for batch in batches:
            for line in zip(*(batch.column(c).to_pylist() for c in ("capture", "file", "at", "bytes"))):
                if out is None:
                    system, path, name = own_file(folder, ".cdx.gz")
                    out, first = system.open_output_stream(path, compression=None), line[0]
                held.append(line)
                last = line[0]
                if len(held) == LINES_PER_BLOCK:
                    block()
        if out is None:
            return
        if held:
            block()
        out.close()
        with system.open_output_stream(path + ".dir", compression=None) as beside:
            beside.write("".join(directory).encode())
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (first, last, name)], ["first", "last", "file"])

    return run


@dataclass
class CaptureIndex:
    """Folders of the archives and of the index, and the first and last key of each index file, sorted."""

    archives: str
    blocks: str
    files: list[tuple[str, str, str]]


def _digest(html: Column) -> Column:
    return F.unhex(F.sha1(html))


def revisits(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``page_id``, ``digest`` and ``refers_to`` of the pages whose payload (``html``, binary) a page with a larger id has as well."""
    marks = pages.filter(F.col("page_id").isNotNull() & (F.octet_length("html") >= min_payload))
    marks = write_table(marks.select("page_id", _digest(F.col("html")).alias("digest")), "marks")
    # Only digests that occur with several ids; the largest one counts.
    repeated = marks.groupBy("digest").agg(F.min("page_id").alias("low"), F.max("page_id").alias("refers_to")).filter("low < refers_to")
    found = marks.join(repeated.drop("low"), "digest").filter("page_id < refers_to")
    return write_table(found.select("page_id", "digest", "refers_to").distinct(), "revisits")


def captures(pages: DataFrame) -> Column:
    """The index key of a page: the URL's key, a space, and the ``page_id`` in 20 digits (``-`` if null)."""
    key = F.regexp_replace(url_key(F.col("url")), r"[\s\x00-\x20]", "%20")
    return F.concat(key, F.lit(" "), F.coalesce(F.format_string("%020d", F.col("page_id")), F.lit("-")))


def write_archives(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> CaptureIndex:
    """Write ``pages`` (``page_id``, ``url``, ``html``) as archives and index them."""
    spark = pages.sparkSession
    small_batches(spark)
    html = F.coalesce("html", F.lit("")).cast("binary").alias("html")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html)
    archives, blocks = scratch_path(spark, "warc"), scratch_path(spark, "cdx")
    earlier = revisits(pages, min_payload)
    pages = pages.withColumns({"capture": captures(pages), "digest": _digest(F.col("html"))}).join(earlier, ["page_id", "digest"], "left")
    pages = pages.select("capture", "page_id", "url", "html", "refers_to")
    placed = write_table(pages.mapInArrow(_archive(archives), "capture string, file string, at bigint, bytes bigint"), "placed")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, "capture", "file", "at").sortWithinPartitions("capture", "file", "at")
    files = write_table(ordered.mapInArrow(_index(blocks), "first string, last string, file string"), "files")
    # At most one file per partition.
    return CaptureIndex(archives, blocks, sorted((r["first"], r["last"], r["file"]) for r in files.collect()))


def _ranges(found: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Records (file, start, bytes) as ranges to read at once, with the records in each."""
    found = sorted(found)
    while found:
        file, start, size = found[0]
        end, count = start + size, 1
        while count < len(found) and found[count][0] == file and found[count][1] - end <= NEAR and end - start < READ_BYTES:
            end = max(end, found[count][1] + found[count][2])
            count += 1
        yield file, start, end - start, [(at - start, length) for _, at, length in found[:count]]
        found = found[count:]


class _Lookup:
    """One index file: its directory in memory, and the block read last."""

    def __init__(self, folder: str, name: str):
        system, root = open_store(folder)
        with system.open_input_stream(f"{root}/{name}.dir", compression=None) as beside:
            lines = [line.rsplit(" ", 2) for line in beside.read().decode().split("\n")[:-1]]
        self.first = [line[0] for line in lines]
        self.spans = [(int(line[1]), int(line[2])) for line in lines]
        self.file = system.open_input_file(f"{root}/{name}")
        self.blocks: dict[int, dict[str, list[tuple[str, int, int]]]] = {}

    def _block(self, k: int) -> dict[str, list[tuple[str, int, int]]]:
        if k not in self.blocks:
            lines: dict[str, list[tuple[str, int, int]]] = {}
            for line in gzip.decompress(self.file.read_at(self.spans[k][1], self.spans[k][0])).decode().split("\n")[:-1]:
                capture, file, at, size = line.rsplit(" ", 3)
                lines.setdefault(capture, []).append((file, int(at), int(size)))
            self.blocks = {k: lines, **{j: b for j, b in self.blocks.items() if j == k - 1}}
        return self.blocks[k]

    def find(self, capture: str) -> list[tuple[str, int, int]]:
        # Its lines may start at the end of the block before the first that starts with it.
        k = max(0, bisect.bisect_left(self.first, capture) - 1)
        found = []
        while k < len(self.first) and self.first[k] <= capture:
            found += self._block(k).get(capture, [])
            k += 1
        return found


_RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _read(index: CaptureIndex, with_payload: bool):
    """Records of the captures of a task (``n``: number of the index file, ``capture``), sorted by both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_store(index.archives)
        lookup, number = None, -1
        wanted: list[tuple[str, int, int]] = []
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        keep = len(names) - (not with_payload)

        def records() -> Iterator[pa.RecordBatch]:
            rows = []
            file, open_name = None, ""
            for name, start, size, parts in _ranges(wanted):
                if name != open_name:
                    file, open_name = system.open_input_file(f"{root}/{name}"), name
                data = file.read_at(size, start)
                for at, length in parts:
                    fields, block = read_record(data[at : at + length])
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    page_id = _number(fields["WARC-Record-ID"])
                    if kind == "response":
                        if payload_digest(block) != digest:
                            raise ValueError(f"the payload of record {page_id} is damaged")
                        row = (page_id, fields["WARC-Target-URI"], len(block), digest, kind, None, block)
                    else:
                        row = (page_id, fields["WARC-Target-URI"], None, digest, kind, _number(fields["WARC-Refers-To"]), None)
                    rows.append(row[:keep])
            wanted.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names[:keep])

        for batch in batches:
            for n, capture in zip(batch.column("n").to_pylist(), batch.column("capture").to_pylist()):
                if n != number:
                    lookup, number = _Lookup(index.blocks, index.files[n][2]), n
                wanted += lookup.find(capture)
            if sum(w[2] for w in wanted) > READ_BYTES:
                yield from records()
        yield from records()

    return run


def read_captures(index: CaptureIndex, wanted: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the captures ``wanted`` (``capture``): ``page_id``, ``url``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``, and ``payload`` if asked for. A capture that is not in the index has none; a revisit has the digest
    and size of the payload it refers to, but no payload.
    """
    spark = wanted.sparkSession
    first, last = [f[0] for f in index.files], [f[1] for f in index.files]

    @F.arrow_udf("array<int>")
    def files_of(captures: pa.Array) -> pa.Array:
        # A key that repeats may end one file and start the next.
        spans = [range(bisect.bisect_left(last, c), bisect.bisect_right(first, c)) for c in captures.to_pylist()]
        return pa.array([list(s) for s in spans], pa.list_(pa.int32()))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = wanted.select("capture").distinct().select(F.explode(files_of("capture")).alias("n"), "capture")
    dealt = dealt.repartition(parts, "n").sortWithinPartitions("n", "capture")
    records = write_table(dealt.mapInArrow(_read(index, with_payload), _RECORD + ", payload binary" * with_payload), "records")
    sizes = records.filter("record_type = 'response' and page_id is not null")
    sizes = sizes.select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("of")).distinct()
    again = records.filter("record_type = 'revisit'").join(sizes, ["refers_to", "payload_digest"], "left")
    again = again.withColumn("payload_bytes", F.col("of")).select(*records.columns)
    return records.filter("record_type = 'response'").union(again)
