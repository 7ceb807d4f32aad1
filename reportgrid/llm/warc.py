"""WARC archives: a writer that stores equal payloads once, and a reader that salvages damaged files.

Records are made by SQL expressions, packed as a gzip member each, and written by Spark's text sink, so archives
can lie in any store that Spark reaches. The sink's line separator is a zero byte, the last byte of every member of less than 16 MB; a larger
one is followed by an empty member. A file holds ``max_records`` records and ``max_bytes`` bytes at most, unless one record alone has
more. Of the records with equal payloads of ``MIN_SHARED_BYTES`` or more, that with the largest id is a
response and the others revisit it.

Reading takes files of records, plain or as gzip members of one or more records. Each record is checked: version line,
header, length, end marks, digests. After a failed check the reader looks for the next valid member or
version line, goes on from there, and reports the bytes in between as a gap. Of a broken member all that can be inflated before the
damage is kept, and its records that pass their checks and name a digest are given; the member is reported as a gap as well.

Defined results: a null payload is empty; a null id is written as an empty one and read as null, and such a record is
always a response; a null URL has no header field; repeated rows are records each, and rows that repeat the largest id of
their payload are all responses; an empty table gives archives without records. Control characters and
spaces in a URL are written as %20. Further columns are not written.
"""

from __future__ import annotations

import gzip
import hashlib
import logging
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportgrid.sources.staging import staged

LOG = logging.getLogger(__name__)
END = "\r\n"
#: Smaller payloads are stored each time.
MIN_SHARED_BYTES = 1000
#: Records and packed bytes in one file at most; a reader holds one file in memory.
MAX_RECORDS = 2000
MAX_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Packed bytes that the writer gives out at a time.
BATCH_BYTES = 8 << 20
VERSION = b"WARC/1."
GZIP = b"\x1f\x8b\x08"


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field whose value is null is left out."""
    return F.concat_ws(END, *[F.concat(F.lit(name), value) for name, value in fields])


def records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z"
) -> DataFrame:
    """One record per row as the text ``record``, without the two line ends that close it."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("bytes", F.octet_length("html"))
    narrow = rows.filter((F.col("bytes") >= MIN_SHARED_BYTES) & F.col("id").isNotNull()).select("id", "digest")
    keepers = narrow.groupBy("digest").agg(F.max("id").alias("keeper"), F.count("*").alias("n")).filter("n > 1")
    # ids and digests meet the keepers; the payloads themselves are dealt out by id, which no hot payload skews
    refers = narrow.join(keepers, "digest").filter("id <> keeper").select("id", "digest", "keeper").distinct()
    rows = rows.join(refers, ["id", "digest"], "left")
    revisit = F.col("keeper").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END + END),
    )
    rows = rows.withColumn("block", F.when(revisit, http).otherwise(F.concat(http, "html")))

    def urn(id_: Column) -> Column:
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.col("digest"), F.lit(">"))

    header = _lines(
        ("WARC/1.1", F.lit("")),
        ("WARC-Type: ", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID: ", urn(F.col("id"))),
        ("WARC-Date: ", F.lit(date)),
        ("WARC-Target-URI: ", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
        ("WARC-Profile: ", F.when(revisit, PROFILE)),
        ("WARC-Refers-To: ", F.when(revisit, urn(F.col("keeper")))),
        ("WARC-Payload-Digest: sha1:", F.col("digest")),
        ("WARC-Block-Digest: sha1:", F.sha1("block")),
        ("X-Payload-Length: ", F.col("bytes").cast("string")),
        ("Content-Type: ", F.lit("application/http;msgtype=response")),
        ("Content-Length: ", F.octet_length("block").cast("string")),
    )
    return rows.select(F.concat(header, F.lit(END + END), F.col("block")).alias("record"))


def pack(record: bytes) -> bytes:
    """The record as a gzip member, without the zero byte that ends it."""
    member = gzip.compress(record, 6, mtime=0)
    if member[-1]:  # 16 MB or more: an empty member ends in a zero
        member += gzip.compress(b"", mtime=0)
    return member[:-1]


def file_numbers(sizes: Iterator[int], max_records: int, max_bytes: int) -> Iterator[int]:
    """To which file of its task each member of so many bytes goes; files are filled in turn."""
    number = count = total = 0
    for size in sizes:
        if count == max_records or (count and total + size > max_bytes):
            number, count, total = number + 1, 0, 0
        count, total = count + 1, total + size
        yield number


def write_archives(
    pages: DataFrame, folder: str, max_records: int = MAX_RECORDS, max_bytes: int = MAX_BYTES, **columns: str
) -> None:
    """Writes the archives below ``folder``, in subfolders by the number of the file in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[bytes] = []

        def sizes() -> Iterator[int]:
            for batch in batches:
                for r in batch.column(0):
                    members.append(pack(r.as_buffer().to_pybytes() + b"\r\n\r\n"))
                    yield len(members[-1]) + 1

        numbers: list[int] = []
        held = 0
        for number in file_numbers(sizes(), max_records, max_bytes):
            numbers.append(number)
            held += len(members[-1])
            if held >= BATCH_BYTES:
                yield _batch(numbers, members)
                numbers, held = [], 0
                members.clear()
        if numbers:
            yield _batch(numbers, members)

    packed = records(pages, **columns).mapInArrow(run, "file int, member binary").select("file", F.col("member").cast("string"))
    packed.write.partitionBy("file").option("lineSep", "\0").option("compression", "none").text(folder)


def _batch(numbers: list[int], members: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(members, pa.large_binary())], names=["file", "member"])


# --- reading ---------------------------------------------------------------------------


def _header(raw: bytes) -> dict[str, str]:
    fields = (line.partition(":") for line in raw.decode("utf-8", "replace").split(END)[1:])
    return {name.strip().lower(): value.strip() for name, _, value in fields}


def _one(data: bytes, at: int) -> tuple[dict, int] | str:
    """The record that begins at ``at`` and where it ends, or which check failed."""
    if not data.startswith(VERSION, at):
        return "no version line"
    # a header ends before the next version line: one that is cut takes nothing of the record behind it
    behind = data.find(b"\n" + VERSION, at)
    stop = data.find(b"\r\n\r\n", at, behind + 1 if behind >= 0 else len(data))
    if stop < 0:
        return "header without end"
    fields = _header(data[at:stop])
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return "no length"
    start, end = stop + 4, stop + 4 + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        return "no end mark"
    block = data[start:end]
    named = fields.get("warc-block-digest", "")
    if named.startswith("sha1:") and hashlib.sha1(block).hexdigest() != named[5:].lower():
        return "block digest"
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    revisit = fields.get("warc-type") == "revisit"
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:").lower()
    if not revisit:
        found = hashlib.sha1(payload).hexdigest()
        if digest and digest != found:
            return "payload digest"
        digest = found
    size = fields.get("x-payload-length", "")

    def number(urn: str | None) -> int | None:
        parts = (urn or "").strip("<>").split(":")
        return int(parts[2]) if len(parts) > 2 and parts[2].lstrip("-").isdigit() else None

    return {
        "page_id": number(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "record_type": fields.get("warc-type"),
        "refers_to": number(fields.get("warc-refers-to")),
        "payload_bytes": (int(size) if size.isdigit() else None) if revisit else len(payload),
        "payload_digest": digest,
        "payload": payload,
    }, end + 4


def _named_digest(record: bytes) -> bool:
    """Whether the bytes of a record were held against a digest that it names."""
    fields = _header(record[: record.find(b"\r\n\r\n")])
    whole = fields.get("warc-type") != "revisit" and fields.get("warc-payload-digest", "")
    return fields.get("warc-block-digest", "").startswith("sha1:") or bool(whole)


def _next_version(data: bytes, at: int) -> int:
    """Where the next line with a version begins, or the end."""
    while (at := data.find(VERSION, at)) >= 0:
        if at == 0 or data[at - 1 : at] == b"\n":
            return at
        at += 1
    return len(data)


def _plain(data: bytes, at: int = 0, stop_at_member: bool = False) -> Iterator[tuple[str, int, int, object]]:
    """("record", start, end, fields) and ("gap", start, end, reason), in order."""
    while at < len(data):
        if stop_at_member and data.startswith(GZIP, at):
            return
        found = _one(data, at)
        if isinstance(found, tuple):
            yield "record", at, found[1], found[0]
            at = found[1]
            continue
        to = _next_version(data, at + 1)
        if stop_at_member and (member := _next_member(data, at + 1, to)) < to:
            to = member
        yield "gap", at, to, found
        at = to


def _member(data: bytes, at: int) -> tuple[bytes, int, bool]:
    """What the gzip member at ``at`` holds as far as it can be read, where it ends, and whether it is whole."""
    inflate, out, step = zlib.decompressobj(31), [], 1 << 16
    pos = at
    while pos < len(data):
        piece = data[pos : pos + step]
        before = inflate.copy()
        try:
            out.append(inflate.decompress(piece))
        except zlib.error:
            return b"".join([*out, *_until_error(before, piece)]), pos, False
        pos += len(piece)
        if inflate.eof:
            return b"".join(out), pos - len(inflate.unused_data), True
    return b"".join(out), len(data), False


def _until_error(inflate, piece: bytes) -> Iterator[bytes]:
    """What a piece gives before the place at which it cannot be inflated, in halves down to single bytes of input and output."""
    while len(piece) > 1:
        half = len(piece) // 2
        before = inflate.copy()
        try:
            yield inflate.decompress(piece[:half])
            piece = piece[half:]
        except zlib.error:
            inflate, piece = before, piece[:half]
    try:
        while got := inflate.decompress(piece, 1):
            yield got
            piece = inflate.unconsumed_tail
    except zlib.error:
        pass


def _next_member(data: bytes, at: int, stop: int) -> int:
    """Where the next member that can be opened begins, or ``stop``."""
    while 0 <= (at := data.find(GZIP, at, stop)):
        head = zlib.decompressobj(31)
        try:
            if head.decompress(data[at : at + 4096], 64).startswith(VERSION):
                return at
        except zlib.error:
            pass
        at += 1
    return stop


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object]]:
    """All records of a file and the gaps between them; places are bytes of the file.

    A record inside a gzip member carries the place of its member.
    """
    at = 0
    while at < len(data):
        if not data.startswith(GZIP, at):
            last = at
            for found in _plain(data, at, stop_at_member=True):
                yield found
                last = found[2]
            if last == at:
                raise AssertionError("no progress")
            at = last
            continue
        content, end, whole = _member(data, at)
        unsure = 0
        for kind, start, stop, what in _plain(content):
            if kind == "record" and (whole or _named_digest(content[start:stop])):
                yield kind, at, end, what
            elif not whole:
                unsure += stop - start
            else:
                yield kind, at, end, f"{what}, {stop - start} bytes at {start} of the member"
        if not whole:
            to = min(_next_member(data, at + 1, len(data)), _next_version(data, at + 1))
            yield "gap", at, to, f"broken member, {unsure} of {len(content)} bytes before the damage without a record"
            end = to
        at = end


FOUND = (
    "path string, kind string, place long, length long, reason string, page_id long, url string, record_type string, "
    "refers_to long, payload_bytes long, payload_digest string"
)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """A row per record and per gap (``kind``), from all files below a folder."""
    names = [x.split()[0] for x in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows = []
                for kind, start, end, what in salvage(content.as_py()):
                    row = {"path": path.as_py(), "kind": kind, "place": start, "length": end - start}
                    row |= what if kind == "record" else {"reason": what}
                    rows.append([row.get(name) for name in (*names, "payload")[: len(names) + with_payload]])
                columns = list(zip(*rows)) or [[]] * (len(names) + with_payload)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=[*names, "payload"][: len(columns)]
                )

    kinds = {"string": pa.string(), "long": pa.int64()}
    types = [kinds[x.split()[1]] for x in FOUND.split(", ")] + [pa.binary()]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "content")
    return files.mapInArrow(run, FOUND + ", payload binary" * with_payload)


def recovered(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The records without payloads, and the quarantined gaps; how many bytes are lost is logged."""
    found = staged(read_archives(spark, folder))
    gaps = found.filter("kind = 'gap'").select("path", "place", "length", "reason")
    lost = gaps.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    if lost["n"]:
        LOG.warning("%d gaps of %d bytes in all quarantined below %s", lost["n"], lost["bytes"], folder)
    return found.filter("kind = 'record'").drop("kind", "reason"), gaps
