"""WARC archives: written from pages, read back, and put together capture by capture."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augury.session import freeze, fresh_folder

VERSION = "WARC/1.1"
#: An archive is closed when it holds this many bytes, before compression.
ARCHIVE_BYTES = 16 << 20
#: Smaller payloads are stored again rather than referred to.
LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_RECORD = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, block_head string, payload binary"
)


def record_name(uid: int, part: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{uid}/{part}')}>"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def safe_uri(url: str | None) -> str:
    """A URI that fits into a header line: white space and control characters escaped."""
    if not url:
        return "urn:missing"
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(headers: list[tuple[str, str]], block: str) -> str:
    """One record without the last of its two closing line ends' line feed, which the writer adds."""
    lines = [VERSION, *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block.encode())}"]
    return "\r\n".join(lines) + "\r\n\r\n" + block + "\r\n\r"


def capture_records(uid: int, page_id: int | None, url: str | None, html: str, first_uid: int, first_url: str | None) -> list[str]:
    """Request, response or revisit, and metadata of one page."""
    uri, payload = safe_uri(url), html.encode()
    digest = f"sha1:{base32_sha1(payload)}"
    own = record_name(uid, "response")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    request = record(
        [("WARC-Type", "request"), ("WARC-Record-ID", record_name(uid, "request")), *common,
         ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request")],
        f"GET {uri} HTTP/1.1\r\n\r\n",
    )
    kind = [("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")]
    if uid == first_uid:
        main = record([("WARC-Type", "response"), ("WARC-Record-ID", own), *common, *kind], head + html)
    else:
        refers = [("WARC-Refers-To", record_name(first_uid, "response")), ("WARC-Refers-To-Target-URI", safe_uri(first_url)), ("WARC-Profile", PROFILE)]
        main = record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, *refers, *kind], head)
    metadata = record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", record_name(uid, "metadata")), *common,
         ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")],
        f"page-id: {'' if page_id is None else page_id}\r\n",
    )
    return [request, main, metadata]


def _written_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 0
    for batch in batches:
        values, archives = [], []
        for row in zip(*(batch.column(c).to_pylist() for c in ("uid", "page_id", "url", "html", "first_uid", "first_url"))):
            for text in capture_records(*row):
                values.append(text)
                archives.append(size // ARCHIVE_BYTES)
                size += len(text)
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array(archives, pa.int32())], ["value", "archive"])


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write a request, a response or revisit, and a metadata record per page, gzip-compressed.

    Of equal payloads of ``least_bytes`` or more, the page with the smallest id holds the
    response; a missing id comes last, and of rows that repeat the smallest id the first. Null
    payloads are empty. Records go through Spark's own writer: a lost executor's half-written
    archives never count, and any store that Spark knows will do. ``pages`` (page_id, url,
    html) is a table whose rows come in the same order whenever it is read.

    Payloads are compared by SHA-1 and length; only the smallest row per task and payload is
    shuffled, and the join with the pages is one whose hot payloads Spark splits.
    """
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    ).withColumn("uid", F.monotonically_increasing_id())
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8"))).withColumn("bytes", F.octet_length("html"))
    order = F.struct(F.col("page_id").isNull().alias("missing"), "page_id", "uid", "url")
    firsts = freeze(
        rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.min(order).alias("first"))
    )
    told = rows.join(firsts, ["digest", "bytes"], "left").select(
        "uid", "page_id", "url", "html", F.coalesce("first.uid", "uid").alias("first_uid"),
        F.col("first.url").alias("first_url"),
    )
    records = told.mapInArrow(_written_records, "value string, archive int")
    records.write.partitionBy("archive").option("compression", "gzip").option("lineSep", "\n").text(path)


# --- reading ---------------------------------------------------------------------


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, with lower-case names, and block of each record."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + 4
        size = int(headers["content-length"])
        if start + size + 4 > len(data):
            raise ValueError(f"the record at byte {at} is cut off")
        yield headers, data[start : start + size]
        at = start + size + 4


def _read_records(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "record_type", "concurrent_to", "refers_to", "target_uri", "date", "payload_digest", "payload_bytes", "block_head", "payload"]
        kinds = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                out: list[tuple] = []
                size = 0
                for h, block in parse_archive(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    kind = h["warc-type"]
                    head, payload = block, None
                    digest, length = None, None
                    if kind in ("response", "revisit"):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        digest = h.get("warc-payload-digest", "").rpartition(":")[2]
                        if kind == "response":
                            if digest != base32_sha1(payload):
                                raise ValueError(f"{h['warc-record-id']}: the payload is not what its digest says")
                            length = len(payload)
                        else:
                            payload = None
                    out.append(
                        (h["warc-record-id"], kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"),
                         h.get("warc-date"), digest, length, head.decode("utf-8", "replace"), payload if with_payload else None)
                    )
                    size += len(block)
                    if size > ARCHIVE_BYTES // 4 or len(out) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives below ``path``; digests are checked."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(_read_records(with_payload), _RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: a response or revisit with what is concurrent to it.

    Columns: ``page_id``, ``target_uri``, the structs ``request``, ``response``, ``metadata``
    (null where the archive has none), ``record_type``, ``payload_bytes`` and
    ``payload_digest`` of the full payload, and ``refers_to``, the page a revisit refers to.
    Requests and metadata that belong to no response are left out. A revisit whose response is
    missing keeps its digest, without a length. Many revisits of one response are a hot key of
    a join that Spark splits.
    """
    main = records.filter(F.col("record_type").isin("response", "revisit"))
    part = lambda kind: records.filter(F.col("record_type") == kind).filter("concurrent_to is not null").select(
        F.col("concurrent_to").alias("record_id"),
        F.struct(F.col("record_id"), "target_uri", "date", F.col("block_head").alias("block")).alias(kind),
    )
    page = F.regexp_extract("metadata.block", r"(?m)^page-id: *(-?[0-9]+)", 1)
    captures = (
        main.join(part("request"), "record_id", "left").join(part("metadata"), "record_id", "left")
        .select(
            F.when(page != "", page).cast("long").alias("page_id"), "target_uri", "request",
            F.struct("record_id", "date", "block_head", "payload").alias("response"), "metadata",
            "record_type", "payload_bytes", "payload_digest", F.col("refers_to").alias("refers_record"),
        )
    )
    originals = captures.filter("record_type = 'response'").select(
        F.col("response.record_id").alias("refers_record"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("original_bytes"),
    )
    return captures.join(originals, "refers_record", "left").select(
        "page_id", "target_uri", "request", "response", "metadata", "record_type",
        F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"), "payload_digest", "refers_to",
    )


def round_trip(pages: DataFrame, with_payload: bool = True) -> DataFrame:
    """Write the pages to archives in the shared folder and assemble the captures read from them.

    Null payloads are empty, null urls are ``urn:missing``; a missing page id stays missing. An
    empty table gives no captures. Extra columns are not looked at.
    """
    spark = pages.sparkSession
    path = fresh_folder(spark, "archives")
    write_archives(pages, path)
    return assemble(read_archives(spark, path, with_payload))
