"""Content-addressed WARC archive.

An archive is two tables. ``payloads`` holds every distinct payload once, as a gzip member under
its SHA-256. ``headers`` holds for every record the exact bytes that stand before the payload.
``records`` joins them again to the original records and checks length and digest of each
payload that it reads. A record whose payload has at least LEAST bytes and equals that of a
record with a smaller page_id is a revisit, whose block ends with its headers.

Payloads are never gathered by key: copies fall together map-side into a set of one member per
digest (two members for one digest fail the job), so a payload that a third of all pages share
costs one row per task.

Defined cases: null html is an empty payload; a null url leaves the target out; null page_ids
are larger than any other, and without any other page_id there is no record to refer to, so all
are responses; rows with the same page_id and payload are all responses if that id is the
smallest; line ends in a url are written percent-encoded; an empty table makes an empty archive.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.llm.common import shared_folder, small_batches

#: Payloads below this size are always stored as responses.
LEAST = 100
#: The pages carry no time of capture.
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, sizes, members = [], [], []
        for html in batch.column(1).to_pylist():
            raw = (html or "").encode()
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            digests.append(hashlib.sha256(raw).hexdigest())
            sizes.append(len(raw))
            members.append(packer.compress(raw) + packer.flush())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.string()), pa.array(sizes, pa.int64()), pa.array(members, pa.binary())],
            names=["page_id", "digest", "bytes", "member"],
        )


def _urn(page_id, digest):
    """A record's identifier, from page_id and digest."""
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    part = lambda at, n: F.substring(h, at, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))


def _header(page_id, url, digest, size, first):
    """The bytes before the payload: WARC header and, in its block, the HTTP header."""
    revisit = (size >= LEAST) & first.isNotNull() & ~page_id.eqNullSafe(first)
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    target = F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(END)
    )
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(size)
    refers = F.concat(
        line("WARC-Profile", F.lit(PROFILE)),
        line("WARC-Refers-To", _urn(first, digest)),
        line("Refers-To-Page-Id", first.cast("string")),
    )
    return F.concat(
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _urn(page_id, digest)),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", target), F.lit("")),
        F.coalesce(line("Page-Id", page_id.cast("string")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(revisit, refers).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit(END),
        http,
    )


def write_archive(pages: DataFrame, path: str) -> None:
    """Writes ``payloads`` and ``headers`` below ``path``."""
    spark = pages.sparkSession
    small_batches(spark)
    captured = pages.select("page_id", "html").mapInArrow(
        _members, f"page_id {pages.schema['page_id'].dataType.simpleString()}, digest string, bytes long, member binary"
    )
    once = captured.groupBy("digest", "bytes").agg(F.min("page_id").alias("first_id"), F.collect_set("member").alias("members"))
    once.select(
        "digest",
        "bytes",
        "first_id",
        F.when(F.size("members") == 1, F.col("members")[0]).otherwise(F.raise_error(F.lit("two payloads share a digest"))).alias("member"),
    ).write.option("compression", "none").parquet(f"{path}/payloads")
    content = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    slim = pages.select("page_id", "url", F.sha2(content, 256).alias("digest"))
    firsts = spark.read.parquet(f"{path}/payloads").select("digest", "bytes", "first_id")
    slim.join(firsts, "digest").select(
        "digest", _header(F.col("page_id"), F.col("url"), F.col("digest"), F.col("bytes"), F.col("first_id")).alias("header")
    ).write.parquet(f"{path}/headers")


_field = re.compile(r"\r\n([A-Za-z-]+): ([^\r\n]*)")
_read_schema = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("record", pa.binary()),
    ]
)
_read_kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, record binary"


def _rebuilt(batches: Iterator[pa.RecordBatch], with_record: bool) -> Iterator[pa.RecordBatch]:
    """Records from header and member; what is returned is read from the record."""
    number = lambda x: int(x) if x else None
    for batch in batches:
        rows = []
        for header, member in zip(batch.column("header").to_pylist(), batch.column("member").to_pylist(), strict=True):
            payload = zlib.decompress(member, 31)
            head, _, http = header.partition(END)
            named = dict(_field.findall(head))
            digest = hashlib.sha256(payload).hexdigest()
            revisit = named["WARC-Type"] == "revisit"
            record = header.encode() + (b"" if revisit else payload)
            block = len(record) - len(head.encode()) - len(END)
            if named["WARC-Payload-Digest"] != f"sha256:{digest}" or int(named["Content-Length"]) != block:
                raise ValueError(f"record {named['WARC-Record-ID']} is damaged")
            if int(dict(_field.findall(http))["Content-Length"]) != len(payload):
                raise ValueError(f"the payload of record {named['WARC-Record-ID']} is damaged")
            rows.append(
                (
                    number(named.get("Page-Id")),
                    len(payload),
                    digest,
                    named["WARC-Type"],
                    number(named.get("Refers-To-Page-Id")),
                    named.get("WARC-Target-URI"),
                    record + END.encode() if with_record else None,
                )
            )
        columns = list(zip(*rows, strict=True)) or [[]] * len(_read_schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _read_schema, strict=True)], schema=_read_schema)


def read_archive(spark: SparkSession, path: str, with_record: bool = True) -> DataFrame:
    """A row for each record with what its bytes say, and the bytes if asked for."""
    small_batches(spark)
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    both = headers.join(payloads.select("digest", "member"), "digest").select("header", "member")
    return both.mapInArrow(lambda it: _rebuilt(it, with_record), _read_kinds)


def archived(pages: DataFrame) -> DataFrame:
    """Writes the pages to a new archive in the shared folder and reads it back."""
    path = f"{shared_folder(pages.sparkSession)}/llm/archive-{uuid.uuid4().hex}"
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path, with_record=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
