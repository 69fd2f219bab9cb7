"""WARC archives with revisit resolution by payload digest.

``write_archives`` writes one gzip member per record.  ``resolve_revisits`` shuffles headers
only: the earliest record of every payload digest stays a response, the others revisit it.
``deduplicate`` copies the archives record by record: responses with their payload, revisits
without it, all with fresh headers.  Payloads never leave the task that reads their archive.

Archives get a name of the task's attempt; the returned index lists the ones that count.  A
task that runs again after a lost executor writes a file of its own, and what a failed
attempt left is in no index.  A task holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.llm.common import batch_of, lookup_spread, open_folder, shared_uri, written
from bikelake.session import scratch_path

# Fixed values of WARC 1.1.
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

ARCHIVE_BYTES = 1 << 30  # an archive is closed once it is this large
CAPTURED = "1970-01-01T00:00:00Z"
PAGE = "Page-Id"         # extension header: the page's id

INDEX = "archive string, offset long, length long, page_id long, url string, digest string, payload_bytes long"
RECORD = ("record_type string, record_id string, page_id long, url string, payload_digest string, "
          "payload_bytes long, refers_to_record string")


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str) -> str:
    """Header values are one line: control characters and '%' as percent escapes."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "%\x7f" else c for c in value)


def _any_line(value: str) -> str:
    out, *rest = value.split("%")
    return out + "".join(chr(int(x[:2], 16)) + x[2:] for x in rest)


def render(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, *,
           refers_to: dict | None = None, date: str = CAPTURED) -> bytes:
    """One record as a gzip member.  Its id follows from what it holds, so a task that runs
    again writes the same record; a revisit's block has the HTTP header alone (no payload)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + payload
    to = refers_to or {}
    name = f"{kind}\n{page_id}\n{url}\n{digest}\n{to.get('record')}\n{to.get('salt')}"
    head = [VERSION, f"WARC-Type: {kind}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{payload_digest(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if page_id is not None:
        head.append(f"{PAGE}: {page_id}")
    if kind == "revisit":
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {to['record']}", f"WARC-Refers-To-Date: {date}"]
        if to.get("url") is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_one_line(to['url'])}")
    head += [f"Content-Type: {HTTP_TYPE}", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def response_id(page_id: int | None, url: str | None, digest: str) -> str:
    """The record id that ``render`` gives a response."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(map(str, ('response', page_id, url, digest, None, None))))}>"


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of one unpacked record; checks both digests."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    block = rest[:int(fields["content-length"])]
    if rest[len(block):] != b"\r\n\r\n" or fields["warc-block-digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError(f"record {fields.get('warc-record-id')} is damaged")
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["warc-type"] == "response" and fields["warc-payload-digest"] != f"sha1:{payload_digest(payload)}":
        raise ValueError(f"payload of {fields.get('warc-record-id')} is damaged")
    return fields, payload


def _members(file, piece: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of an archive, unpacked one after the other."""
    data, held = file.read(piece), []
    unpack = zlib.decompressobj(31)
    while data:
        held.append(unpack.decompress(data))
        if unpack.eof:
            yield b"".join(held)
            data, held, unpack = unpack.unused_data or file.read(piece), [], zlib.decompressobj(31)
        else:
            data = file.read(piece)
    if held:
        raise ValueError("the archive ends within a record")


class _Archives:
    """Output of one task: archives of about ``limit`` bytes, of which one is open."""

    def __init__(self, folder: str, prefix: str, limit: int):
        self.fs, self.root = open_folder(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.limit, self.out = limit, None
        self.prefix = f"{prefix}-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        self.count = 0

    def add(self, record: bytes) -> tuple[str, int, int]:
        if self.out is None:
            self.name, self.place = f"{self.prefix}-{self.count:04d}.warc.gz", 0
            self.out = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.count += 1
        at = self.place
        self.out.write(record)
        self.place += len(record)
        where = (self.name, at, len(record))
        if self.place >= self.limit:
            self.close()
        return where

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


_INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                    ("url", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64())])


def write_archives(spark: SparkSession, pages: DataFrame, folder: str | None = None, *, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES,
                   ) -> tuple[str, DataFrame]:
    """One response record per page, payload the html in UTF-8; no shuffle.

    Returns the folder and the index (``INDEX``), one row per record.  A null html is an empty
    payload; null ids and urls leave their header out; repeated rows are records of their
    own; an empty table gives no archive.  Other columns are not read.
    """
    folder = shared_uri(spark, folder or scratch_path(spark, "warc"))

    def write(batches):
        archives = None
        for batch in batches:
            archives = archives or _Archives(folder, "pages", archive_bytes)
            rows = []
            for page, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                payload = html.as_py() or b""
                digest = payload_digest(payload)
                rows.append((*archives.add(render("response", page, url, payload, digest, len(payload))), page, url, digest, len(payload)))
            if rows:
                yield batch_of(_INDEX, list(zip(*rows)))
        if archives:
            archives.close()

    chosen = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                          F.col(html_col).cast("string").cast("binary").alias("html"))
    return folder, written(spark, chosen.mapInArrow(write, INDEX), "warc-index")


def resolve_revisits(index: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``index`` with ``kind`` and, for revisits, ``to_page, to_url``: the first record of a
    digest by page_id (nulls last), url, archive and offset is the response of its group.

    Payloads under ``min_bytes`` are all responses.  The first record of a group is found by
    combinable minima, so a digest of a third of all records costs one row per task; records
    look it up under a spread key.
    """
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "archive", "offset")).alias("first")
    large = index.filter(F.col("payload_bytes") >= min_bytes)
    found = lookup_spread(index, large.groupBy("digest").agg(first), ["digest"], ["archive", "offset"])
    is_first = (F.col("first.archive") == F.col("archive")) & (F.col("first.offset") == F.col("offset"))
    revisit = F.col("first").isNotNull() & ~is_first & (F.col("payload_bytes") >= min_bytes)
    return found.select(*index.columns, F.when(revisit, "revisit").otherwise("response").alias("kind"),
                        F.when(revisit, F.col("first.page_id")).alias("to_page"),
                        F.when(revisit, F.col("first.url")).alias("to_url"))


def deduplicate(spark: SparkSession, folder: str, index: DataFrame, out: str | None = None, *, min_bytes: int = 0,
                archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """The archives of ``index`` written again without repeated payloads, with fresh headers.

    Returns the folder and the index of the new archives.  Decisions travel to the archives
    (rows of a few bytes), not payloads to the decisions.
    """
    out = shared_uri(spark, out or scratch_path(spark, "warc-dedup"))

    def write(batches):
        archives, name, source = None, None, None
        for batch in batches:
            archives = archives or _Archives(out, "dedup", archive_bytes)
            fs, root = open_folder(folder)
            rows = []
            for r in batch.to_pylist():
                payload, to = b"", None
                if r["kind"] == "revisit":
                    to = {"record": response_id(r["to_page"], r["to_url"], r["digest"]), "url": r["to_url"],
                          "salt": f"{r['archive']}:{r['offset']}"}
                else:
                    if r["archive"] != name:
                        if source is not None:
                            source.close()
                        name, source = r["archive"], fs.open_input_file(f"{root}/{r['archive']}")
                    source.seek(r["offset"])
                    payload = parse(zlib.decompress(source.read(r["length"]), 31))[1]
                place = archives.add(render(r["kind"], r["page_id"], r["url"], payload, r["digest"],
                                            r["payload_bytes"], refers_to=to))
                rows.append((*place, r["page_id"], r["url"], r["digest"], r["payload_bytes"]))
            if rows:
                yield batch_of(_INDEX, list(zip(*rows)))
        if source is not None:
            source.close()
        if archives:
            archives.close()

    count = index.agg(F.countDistinct("archive")).first()[0]
    decided = (resolve_revisits(index, min_bytes).repartition(max(1, count), "archive")
               .sortWithinPartitions("archive", "offset"))
    return out, written(spark, decided.mapInArrow(write, INDEX), "warc-dedup-index")


def read_records(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Every record of the archives that ``index`` lists (``RECORD``), headers as written,
    digest and size of responses from the payload itself; revisits have no size here."""
    schema = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()),
                        ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                        ("refers_to_record", pa.string())])

    def read(batches):
        for batch in batches:
            fs, root = open_folder(folder)
            for name in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_file(f"{root}/{name}") as f:
                    for record in _members(f):
                        h, payload = parse(record)
                        kind, url, page = h["warc-type"], h.get("warc-target-uri"), h.get(PAGE.lower())
                        rows.append((kind, h["warc-record-id"], None if page is None else int(page),
                                     None if url is None else _any_line(url),
                                     payload_digest(payload) if kind == "response" else h["warc-payload-digest"][5:],
                                     len(payload) if kind == "response" else None, h.get("warc-refers-to")))
                        if len(rows) == 10_000:
                            yield batch_of(schema, list(zip(*rows)))
                            rows = []
                if rows:
                    yield batch_of(schema, list(zip(*rows)))

    archives = index.select("archive").distinct()
    count = archives.count()
    return archives.repartition(max(1, count), "archive").mapInArrow(read, RECORD)


def resolved_records(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record;
    a revisit gets size, digest and page of the response that it refers to."""
    original = (records.filter("record_type = 'response'")
                .groupBy(F.col("record_id").alias("refers_to_record"))
                .agg(F.first(F.struct("page_id", "payload_bytes", "payload_digest")).alias("to")))
    revisits = lookup_spread(records.filter("record_type = 'revisit'"), original, ["refers_to_record"], ["record_id"])
    return (records.filter("record_type = 'response'")
            .select("page_id", "url", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
            .unionByName(revisits.select("page_id", "url", F.col("to.payload_bytes").alias("payload_bytes"),
                                         F.col("to.payload_digest").alias("payload_digest"), "record_type",
                                         F.col("to.page_id").alias("refers_to"))))
