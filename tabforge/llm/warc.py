"""WARC archives: pages written as records, and a sequential reader.

Every record is a gzip member of its own, so an archive can be cut or joined
at any record. Repeated payloads become ``revisit`` records that name the
record holding the payload. The reader inflates an archive chunk by chunk,
takes each block by its Content-Length and verifies both digests.

Archives lie in the shared folder (``spark.checkpoint.dir``), opened by its URI. A
task writes files of names of its own and reports them in the rows it
returns; only reported files belong to the collection, so what a lost or
doubled task leaves behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import prepare
from tabforge.session import cut_lineage, scratch_path

# A new archive begins after so many compressed bytes.
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
# Payloads with more than this share of all pages are hot: at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001
# Revisit decisions (24 bytes each) up to this number are broadcast, more are joined by a shuffle.
SMALL_DECISIONS = 100_000

MANIFEST = "archive string, bytes long, n_records long"
RECORD = ("archive string, offset long, record_type string, record_id string, target_uri string, page_id long, "
          "refers_to_id string, refers_to long, payload_bytes long, payload_digest string, payload binary")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ------------------------------------------------------------------ records
def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, row_no: int) -> str:
    """The same name for the same row of the written table, in every attempt."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{row_no}')}>"


def _line(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build_record(row_no: int, page_id: int | None, url: str | None, payload: bytes, refers_row: int | None = None,
                 refers_to: int | None = None, date: str = DATE) -> bytes:
    """One uncompressed record; with ``refers_row`` a revisit, without payload.

    The page's id and the length of the full payload stay in either kind: the
    id in an extension field, the length in the stored HTTP header.
    """
    revisit = refers_row is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", record_id(page_id, row_no)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _line(url)))
    if page_id is not None:
        fields.append(("Page-Id", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, refers_row))]
        if refers_to is not None:
            fields.append(("Refers-To-Page-Id", str(refers_to)))
    fields += [("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
               ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def member(record: bytes, level: int = LEVEL) -> bytes:
    """A record as one gzip member (no time stamp: equal records, equal bytes)."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


# ------------------------------------------------------------------- reader
class BadArchive(ValueError):
    """An archive that breaks the framing or a digest, with its place."""


class _Member:
    """Bytes of one gzip member, inflated only as far as they are asked for."""

    def __init__(self, stream, first: bytes, where: str):
        self.stream, self.raw, self.where = stream, first, where
        self.z = zlib.decompressobj(31)
        self.out = b""
        self.taken = 0

    def _more(self) -> bool:
        while not self.z.eof:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    raise BadArchive(f"{self.where}: the archive ends within a record")
            try:
                got = self.z.decompress(self.raw, CHUNK)
            except zlib.error as e:
                raise BadArchive(f"{self.where}: {e}") from e
            self.taken += len(self.raw) - len(self.z.unconsumed_tail) - len(self.z.unused_data)
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if got:
                self.out += got
                return True
        return False

    def header(self, most: int = 1 << 20) -> list[str]:
        """Lines up to an empty one."""
        while (end := self.out.find(b"\r\n\r\n")) < 0:
            if len(self.out) > most or not self._more():
                raise BadArchive(f"{self.where}: a header without an end")
        head, self.out = self.out[:end], self.out[end + 4:]
        return head.decode("utf-8", "replace").split("\r\n")

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in parts of bounded size."""
        while n > 0:
            if not self.out and not self._more():
                raise BadArchive(f"{self.where}: a block shorter than its Content-Length")
            part, self.out = self.out[:n], self.out[n:]
            n -= len(part)
            yield part

    def end(self) -> bytes:
        """Checks that two line ends and the member's own end follow; what is left of the raw bytes."""
        while len(self.out) < 5 and self._more():
            pass
        if self.out != b"\r\n\r\n":
            raise BadArchive(f"{self.where}: a block longer than its Content-Length")
        return self.raw


def _fields(lines: list[str]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def _long(value: str | None, where: str) -> int | None:
    if value is None:
        return None
    if not re.fullmatch(r"-?[0-9]+", value):
        raise BadArchive(f"{where}: {value!r} is not a number")
    return int(value)


def read_archive(stream, archive: str, with_payload: bool = False) -> Iterator[dict]:
    """Records of one archive in order; memory is a chunk, and one payload if asked for.

    Raises ``BadArchive`` on a broken member, a block of another length than
    its Content-Length, a wrong block digest, or a wrong payload digest.
    """
    offset, raw = 0, b""
    while True:
        raw = raw or stream.read(CHUNK)
        if not raw:
            return
        where = f"{archive} at {offset}"
        m = _Member(stream, raw, where)
        lines = m.header()
        if not lines[0].startswith("WARC/1."):
            raise BadArchive(f"{where}: no WARC version line")
        f = _fields(lines[1:])
        left = _long(f.get("content-length"), where)
        if left is None or left < 0:
            raise BadArchive(f"{where}: no Content-Length")
        block, payload, kept, n_payload, http = hashlib.sha1(), hashlib.sha1(), [], 0, b""
        inside = not f.get("content-type", "").startswith("application/http")
        for part in m.take(left):
            block.update(part)
            if not inside:
                http += part
                if (end := http.find(b"\r\n\r\n")) < 0:
                    continue
                part, http, inside = http[end + 4:], http[:end], True
            payload.update(part)
            n_payload += len(part)
            if with_payload:
                kept.append(part)
        raw = m.end()
        said = f.get("warc-block-digest")
        if said and said != f"sha1:{base64.b32encode(block.digest()).decode()}":
            raise BadArchive(f"{where}: block digest differs")
        kind, digest = f.get("warc-type", ""), f.get("warc-payload-digest", "")
        if kind == "revisit":  # the payload is elsewhere: its length is in the kept HTTP header
            n_payload = _long(_fields(http.decode("latin-1").split("\r\n")).get("content-length"), where)
            kept = None
        elif digest and digest != f"sha1:{base64.b32encode(payload.digest()).decode()}":
            raise BadArchive(f"{where}: payload digest differs")
        yield {"archive": archive, "offset": offset, "record_type": kind, "record_id": f.get("warc-record-id"),
               "target_uri": f.get("warc-target-uri"), "page_id": _long(f.get("page-id"), where),
               "refers_to_id": f.get("warc-refers-to"), "refers_to": _long(f.get("refers-to-page-id"), where),
               "payload_bytes": n_payload, "payload_digest": digest.removeprefix("sha1:") or None,
               "payload": b"".join(kept) if with_payload and kept is not None else None}
        offset += m.taken


# -------------------------------------------------------------------- Spark
def _files(uri: str):
    """File system and path of a URI, on any executor."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def decide(pages: DataFrame, min_revisit_bytes: int = 0, hot_share: float = HOT_SHARE,
           small: int = SMALL_DECISIONS) -> DataFrame:
    """Pages with their payload and, for revisits, the row they refer to.

    Result: row_no, page_id, url, payload, refers_row, refers_to (both NULL
    for responses). Of the rows with equal payloads of at least
    ``min_revisit_bytes`` bytes the one with the largest page_id (NULL is
    smallest; among repeats of a page_id, the last row) is the response.

    Payloads are written once with row numbers and compared by SHA-256; only
    row numbers and digests are shuffled. Groups of more than ``hot_share``
    of all rows (so at most 1 / hot_share groups) are found by a
    pre-aggregated count and joined by broadcast, all others by digest.
    """
    payload = F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")
    rows = cut_lineage(pages.select(F.monotonically_increasing_id().alias("row_no"),
                                    pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                                    payload.alias("payload"), F.unhex(F.sha2(payload, 256)).alias("same")), "warc-pages")
    keys = rows.where(F.octet_length("payload") >= min_revisit_bytes).select("row_no", "page_id", "same")
    groups = cut_lineage(keys.groupBy("same").agg(F.count(F.lit(1)).alias("n"),
                                                  F.max(F.struct(F.col("page_id"), F.col("row_no"))).alias("top"))
                         .where("n > 1").select("same", "n", F.col("top.page_id").alias("refers_to"),
                                                F.col("top.row_no").alias("refers_row")), "warc-groups")
    total = rows.count()  # from the written files' footers
    is_hot = F.col("n") > F.lit(hot_share * total)
    hot = F.broadcast(groups.where(is_hot).drop("n"))  # at most 1 / hot_share rows
    keys = keys.select("row_no", "same")
    found = keys.join(hot, "same").unionByName(
        keys.join(hot.select("same"), "same", "left_anti").join(groups.where(~is_hot).drop("n"), "same"))
    found = cut_lineage(found.where("row_no <> refers_row").select("row_no", "refers_row", "refers_to"), "warc-revisits")
    if found.count() <= small:
        found = F.broadcast(found)  # measured: at most `small` rows of three numbers
    return rows.drop("same").join(found, "row_no", "left")


def write_archives(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write ``decide``'s rows as archives; the manifest of written files.

    Result: archive (URI), bytes, n_records. Each task writes its rows in
    order and begins a new archive after ``archive_bytes``.
    """
    folder = scratch_path(records.sparkSession, "warc")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, out, size, n = None, None, 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"archive": uri, "bytes": size, "n_records": n}], schema=pa.schema(
                [("archive", pa.string()), ("bytes", pa.int64()), ("n_records", pa.int64())]))

        for b in batches:
            cols = [b.column(c) for c in ("row_no", "page_id", "url", "payload", "refers_row", "refers_to")]
            for i in range(b.num_rows):
                if out is None:
                    uri, size, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    files, path = _files(uri)
                    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = files.open_output_stream(path, compression=None)
                m = member(build_record(*(c[i].as_py() for c in cols), date=date))
                out.write(m)
                size, n = size + len(m), n + 1
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    rows = records.select("row_no", "page_id", "url", "payload", "refers_row", "refers_to")
    return cut_lineage(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def read_warc(manifest: DataFrame, with_payload: bool = False, batch_rows: int = 1024) -> DataFrame:
    """Every record of the archives listed in ``manifest`` (column archive).

    Result: see ``RECORD``; ``payload`` is NULL for revisits and unless
    ``with_payload``. One task reads an archive from its start to its end; a
    broken archive fails the job with its name and the record's offset.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                            for n, t in (x.split() for x in RECORD.split(", "))])
        rows, held = [], 0
        for b in batches:
            for archive in b.column("archive").to_pylist():
                files, path = _files(archive)
                with files.open_input_stream(path, compression=None) as stream:
                    for r in read_archive(stream, archive, with_payload):
                        rows.append(r)
                        held += len(r["payload"] or b"")
                        if len(rows) >= batch_rows or held >= 32 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    archives = manifest.select("archive")
    return archives.repartition(max(1, archives.count())).mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page as a WARC record, read the archives back.

    Result per row of ``pages`` (page_id, url, html): page_id, payload_bytes,
    payload_digest (upper-case base32 SHA-1 of the full payload), record_type
    (response or revisit), refers_to (page_id of the response, for revisits),
    record_id, target_uri. NULL html is an empty payload; a NULL url or
    page_id leaves its field out and comes back as NULL; repeated rows are
    records of their own; control characters in a url come back
    percent-encoded; an empty table gives an empty result; further columns
    are ignored.
    """
    prepare(pages.sparkSession)
    manifest = write_archives(decide(pages, min_revisit_bytes), archive_bytes)
    return read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                      "record_id", "target_uri")
