"""WARC archives: a writer with segmented, chunked and revisit records, and a reader that reassembles them.

Writing: each row becomes an HTTP response record whose body is in chunked transfer framing.  A record block above
``segment_bytes`` is cut: segment 1 is the response record, the rest are continuation records with the origin
identifier and their number, the last one with the total length.  Of rows with equal payloads of at least ``revisit_from``
bytes, the one with the largest id is the response and the others are revisit records that refer to it.  The archives are
gzip files in which every record ends with two line ends, as the format asks (that is the line separator of Spark's text writer).

A record is at most ``segment_bytes`` and its headers long, so ``records_per_file`` bounds an archive's bytes, too (20,000 records of 16 KB).

Reading: every archive is unpacked as a stream.  Records are grouped by origin
identifier and ordered by segment number: one exchange that carries the bytes of segmented records only.  Each group is then read as
a stream: numbers must be consecutive, the total length must agree, and the chunked framing is decoded step by step into
length and SHA-1, so not even one payload has to fit a buffer.  Digests are compared with those in the headers, and revisits with the
response they refer to; a difference fails the job.

Hot payloads (a third of all pages) meet their group by a salted join.

Defined cases: a null payload is empty; equal payloads are found by SHA-1 and length; a null id takes part as the smallest
one, and a group of null ids only has no revisits; repeated rows with the largest id are all responses; a null url leaves its
header out, line ends in a url are escaped; an id with several payloads has a response record for each that no larger id shares, and a revisit is
matched by id, length and digest; an empty table writes archives without records and gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.llm.common import col, salted_left_join
from recspark.session import materialize, scratch_path

ship_by_value(__name__)

END = b"\r\n\r\n"
URN = "urn:recspark:page:"
PARTS = ("origin string, segment int, total long, page_id long, record_type string, refers_to long, declared string, "
         "payload_bytes long, payload_digest string, block binary")
PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def sha1_base32(data: Column) -> Column:
    """Base32 (RFC 4648) of SHA-1: 20 bits, five hexadecimal digits, are four characters."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(data), 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def assign_types(pages: DataFrame, revisit_from: int) -> DataFrame:
    """Adds digest, n_bytes and keep_id (the response's id for a revisit, else null); a revisit's payload is dropped."""
    base = pages.withColumn("digest", sha1_base32(F.col("payload"))).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    groups = (base.where(F.col("n_bytes") >= revisit_from).groupBy("digest", "n_bytes")
              .agg(F.max("page_id").alias("keep_id"), F.count(F.lit(1)).alias("rows")).where("rows > 1 AND keep_id IS NOT NULL").drop("rows"))
    typed = salted_left_join(base, groups, ["digest", "n_bytes"], F.struct("page_id", "url"))
    revisit = F.col("keep_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))
    return (typed.withColumn("keep_id", F.when(revisit, F.col("keep_id")))
            .withColumn("payload", F.when(revisit, F.lit(None)).otherwise(F.col("payload"))))


def _head(fields) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode("utf-8")


def chunked(body: bytes, size: int) -> bytes:
    out = [b"%x\r\n%s\r\n" % (len(part := body[k:k + size]), part) for k in range(0, len(body), size)]
    return b"".join(out) + b"0\r\n\r\n"


def records_of(page_id, url, payload, digest, n_bytes, keep_id, name: str, chunk_bytes: int, segment_bytes: int):
    """The records of one row, without the line ends that close them."""
    date = "2024-01-01T00:00:00Z"
    uri = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    common = [("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http; msgtype=response")]
    if keep_id is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes
        yield _head([("WARC-Type", "revisit"), *common, ("WARC-Refers-To", f"<{URN}{keep_id}>"),
                     ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Content-Length", len(block))]) + block
        return
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
             + chunked(payload.encode("utf-8"), chunk_bytes))
    parts = [block[k:k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    for k, part in enumerate(parts, 1):
        if len(parts) == 1:
            more = []
        else:
            more = [("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", len(block) if k == len(parts) else None)]
        if k == 1:
            yield _head([("WARC-Type", "response"), *common, *more, ("Content-Length", len(part))]) + part
        else:
            yield _head([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}/{k}>"), ("WARC-Date", date), ("WARC-Segment-Origin-ID", f"<{name}>"),
                         *more, ("Content-Length", len(part))]) + part


def _recorder(chunk_bytes: int, segment_bytes: int):
    def record(batches):
        from pyspark import TaskContext

        here, n = TaskContext.get().partitionId(), 0
        whole = lambda x: None if pd.isna(x) else int(x)
        for batch in batches:
            out, size = [], 0
            for r in batch.itertuples(index=False):
                # the fragment tells rows with one id apart; a reference without it means any of them
                page = whole(r.page_id)
                name, n = f"{URN}{'null' if page is None else page}#{here}-{n}", n + 1
                for rec in records_of(page, r.url, r.payload, r.digest, int(r.n_bytes), whole(r.keep_id), name, chunk_bytes, segment_bytes):
                    out.append(rec)
                    size += len(rec)
                if size > 4_000_000:
                    yield pd.DataFrame({"record": out})
                    out, size = [], 0
            yield pd.DataFrame({"record": out})

    return record


def write_archives(pages: DataFrame, path: str, revisit_from: int = 0, chunk_bytes: int = 4096, segment_bytes: int = 16384,
                   records_per_file: int = 20_000, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    rows = pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).cast("string").alias("url"),
                        F.coalesce(col(payload_col), F.lit("")).alias("payload"))
    typed = assign_types(rows, revisit_from).select("page_id", "url", "payload", "digest", "n_bytes", "keep_id")
    records = typed.mapInPandas(_recorder(chunk_bytes, segment_bytes), "record binary")
    (records.select(F.col("record").cast("string").alias("value"))  # the bytes as they are
     .write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


class Stream:
    """Bytes of a gzip archive, unpacked as far as they are asked for."""

    def __init__(self, packed: bytes):
        self.packed, self.at, self.zip, self.held = packed, 0, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        while self.at < len(self.packed):
            got = self.zip.decompress(self.packed[self.at:self.at + 262_144])
            self.at += 262_144
            self.held += got
            if got:
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (k := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held:
                    raise ValueError("archive ends inside a record")
                return None
        return self.take(k + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("archive ends inside a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def records_in(packed: bytes):
    """(header fields, block) of the records of an archive."""
    stream = Stream(packed)
    while (head := stream.until(END)) is not None:
        first, *lines = head[:-4].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/1."):
            raise ValueError(f"not a record: {first[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = stream.take(int(fields["Content-Length"]))
        if stream.take(4) != END:
            raise ValueError("a record does not end with two line ends")
        yield fields, block


class Dechunker:
    """Decodes an HTTP response in chunked framing, fed in any pieces, into length and SHA-1 of its body."""

    def __init__(self):
        self.held, self.state, self.left, self.length, self.sha = b"", "head", 0, 0, hashlib.sha1()

    def feed(self, data: bytes) -> None:
        self.held += data
        while True:
            if self.state == "data":
                part = self.held[:self.left]
                self.sha.update(part)
                self.length += len(part)
                self.left -= len(part)
                self.held = self.held[len(part):]
                if self.left:
                    return
                self.state = "after"
            mark = {"head": END, "size": b"\r\n", "after": b"\r\n", "trailer": b"\r\n"}.get(self.state)
            if mark is None or (k := self.held.find(mark)) < 0:
                return
            line, self.held = self.held[:k], self.held[k + len(mark):]
            if self.state == "head":
                if b"\r\ntransfer-encoding: chunked" not in line.lower():
                    raise ValueError("the response is not in chunked framing")
                self.state = "size"
            elif self.state == "after":
                if line:
                    raise ValueError("a chunk is longer than its size")
                self.state = "size"
            elif self.state == "size":
                self.left = int(line.split(b";")[0], 16)
                self.state = "data" if self.left else "trailer"
            elif not line:  # the empty line after the trailer
                self.state = "done"

    def result(self) -> tuple[int, str]:
        if self.state != "done" or self.held:
            raise ValueError("the chunked body is not complete")
        return self.length, base64.b32encode(self.sha.digest()).decode()


def _page_id(urn: str):
    got = urn.strip("<>").removeprefix(URN).split("#")[0]
    return None if got == "null" else int(got)


def part_of(fields: dict, block: bytes):
    """A row of PARTS: whole records are decoded at once, segments keep their bytes."""
    kind, name = fields["WARC-Type"], fields["WARC-Record-ID"]
    declared = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
    number, total = fields.get("WARC-Segment-Number"), fields.get("WARC-Segment-Total-Length")
    if kind == "revisit":
        length = next(int(x.split(b":")[1]) for x in block.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        return (name, 0, None, _page_id(name), kind, _page_id(fields["WARC-Refers-To"]), declared, length, declared, None)
    if number is None:
        whole = Dechunker()
        whole.feed(block)
        return (name, 0, None, _page_id(name), kind, None, declared, *whole.result(), None)
    origin = fields.get("WARC-Segment-Origin-ID", name)
    return (origin, int(number), None if total is None else int(total), _page_id(origin), "response", None, declared, None, None, block)


def _frame(rows, schema):
    out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
    for c in (x.split()[0] for x in schema.split(", ") if x.endswith((" long", " int"))):
        out[c] = out[c].astype("Int64")
    return out


def _reader(batches):
    for batch in batches:
        for packed in batch["content"]:
            rows, size = [], 0
            for fields, block in records_in(packed):
                rows.append(part_of(fields, block))
                size += len(rows[-1][-1] or b"")
                if size > 4_000_000 or len(rows) >= 10_000:
                    yield _frame(rows, PARTS)
                    rows, size = [], 0
            if rows:
                yield _frame(rows, PARTS)


class Reassembly:
    """Joins the segments of one origin, in order."""

    def __init__(self, origin: str):
        self.origin, self.next, self.length, self.total, self.body = origin, 1, 0, None, Dechunker()
        self.page_id = self.declared = None

    def add(self, r) -> None:
        if int(r.segment) != self.next or self.total is not None:
            raise ValueError(f"{self.origin}: segment {self.next} is missing or repeated")
        if self.next == 1:
            self.page_id, self.declared = (None if pd.isna(r.page_id) else int(r.page_id)), r.declared
        self.next += 1
        self.length += len(r.block)
        self.total = None if pd.isna(r.total) else int(r.total)
        self.body.feed(r.block)

    def row(self):
        if self.total != self.length:
            raise ValueError(f"{self.origin}: {self.length} bytes instead of {self.total}")
        length, digest = self.body.result()
        return _checked(self.page_id, length, digest, self.declared, "response", None)


def _checked(page_id, length, digest, declared, kind, refers_to):
    if declared is not None and declared != digest:
        raise ValueError(f"page {page_id}: the payload's digest is {digest}, its header says {declared}")
    return page_id, length, digest, kind, refers_to


def _reassemble(batches):
    """Rows sorted by origin and segment number; the bytes of a record pass through and are not kept."""
    now = None
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            if now is not None and (r.segment == 0 or r.origin != now.origin):
                rows.append(now.row())
                now = None
            if r.segment == 0:
                rows.append(_checked(None if pd.isna(r.page_id) else int(r.page_id), int(r.payload_bytes), r.payload_digest, r.declared,
                                     r.record_type, None if pd.isna(r.refers_to) else int(r.refers_to)))
                continue
            now = now or Reassembly(r.origin)
            now.add(r)
        yield _frame(rows, PAGES)
    if now is not None:
        yield _frame([now.row()], PAGES)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    files = spark.read.format("binaryFile").load(path).select("content")
    parts = files.mapInPandas(_reader, PARTS)
    pages = parts.repartition("origin").sortWithinPartitions("origin", "segment").mapInPandas(_reassemble, PAGES)
    found = materialize(pages, "warc-pages")
    # what a revisit says of its payload must be true of a response with the id that it refers to
    wanted = found.where("refers_to IS NOT NULL").select(F.col("refers_to").alias("page_id")).distinct()
    answers = (found.where("record_type = 'response'").join(wanted, "page_id", "left_semi")
               .select(F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest").distinct().withColumn("answered", F.lit(True)))
    joined = salted_left_join(found, answers, ["refers_to", "payload_bytes", "payload_digest"], F.struct("page_id"))
    wrong = F.col("refers_to").isNotNull() & F.col("answered").isNull()
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("a revisit does not match response "), F.col("refers_to").cast("string")))).otherwise(F.col("payload_bytes"))
    return joined.select("page_id", checked.cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return read_archives(pages.sparkSession, path)


SQL = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    d AS (SELECT *, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS keep FROM p)
    SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
           translate(""" + " || ".join(f"to_base(('0x' || h[{1 + 5 * k}:{5 + 5 * k}])::BIGINT, 32, 4)" for k in range(8)) + """,
                     '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
           CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> keep THEN keep END AS refers_to
    FROM d"""
