"""WARC archives with revisit resolution: equal payloads are stored once.

Headers are dealt out by payload digest to find each payload's first record; later ones become revisit
records without a payload that refer to it. Archives are written as text whose record end is WARC's own,
so Spark's writer commits them, and read back by the lengths that the headers state.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.session import pin

LEAST_BYTES = 100
"""Payloads of fewer bytes are always stored."""
ARCHIVE_BYTES = 32 << 20
"""Size of an archive before compression, about."""
BROADCAST_ROWS = 200_000
END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"
_CODED = (9, 10, 13, 127, 37)
"""Characters of a url that its header line writes as percent and two digits; percent itself last."""


def _rows(pages: DataFrame) -> DataFrame:
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    return rows.withColumn("payload_digest", F.sha2("payload", 256)).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long")
    )


def decide(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """What the records of each page and payload will be, from headers alone: ``page_id``,
    ``payload_digest``, ``record_type`` and ``refers_to``.

    A null html is an empty payload. Of records with equal payloads of ``least`` bytes, that with the
    smallest id is a response; rows that repeat that id are responses too. Null ids are larger than all
    others, and where all ids of a payload are null, all are responses.
    """
    heads = _rows(pages).groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    large = heads.where(F.col("payload_bytes") >= least)
    # Only payloads of several ids need a look; one in a third of the rows is counted where it lies.
    firsts = large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    found = heads.join(firsts.where("n > 1 AND first IS NOT NULL").drop("n"), "payload_digest", "left")
    later = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return found.select(
        "page_id", "payload_digest", F.when(later, "revisit").otherwise("response").alias("record_type"),
        F.when(later, F.col("first")).alias("refers_to"),
    )


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(decided: DataFrame, date: str) -> DataFrame:
    """One column ``value``: each record's headers and block, without the end that the writer adds."""
    text = lambda c: F.col(c).cast("string")
    safe = F.col("url")
    for code in reversed(_CODED):
        safe = F.replace(safe, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    revisit = F.col("record_type") == "revisit"
    size = F.lit(len(_HTTP)) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.concat(F.lit(f"<{_ID}"), F.coalesce(text("page_id"), F.lit("")), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", safe),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit(f"<{_ID}"), text("refers_to"), F.lit(">")))),
        _line("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", size.cast("string")),
        F.lit("\r\n" + _HTTP),
    )
    return decided.select(F.concat(head, F.col("payload")).alias("value"))


def write(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", least: int = LEAST_BYTES) -> None:
    """Write a record for each page below ``folder``, in archives of about ``ARCHIVE_BYTES``."""
    revisits = pin(decide(pages, least).where("record_type = 'revisit'").select(
        F.col("page_id").alias("id"), F.col("payload_digest").alias("digest"), "refers_to"
    ))
    found, held = pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first(), _rows(pages)
    # Of checked size, payloads stay where they are; beyond it the join moves them once, by page and
    # digest, which spreads the copies of one payload.
    revisits = F.broadcast(revisits) if revisits.count() <= BROADCAST_ROWS else revisits
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("payload_digest") == F.col("digest"))
    decided = held.join(revisits, same, "left").withColumn(
        "record_type", F.when(F.col("digest").isNull(), "response").otherwise("revisit")
    )
    each = max(1, (found[1] or 0) // max(1, found[0]))
    text = records(decided.withColumn(
        "payload", F.when(F.col("record_type") == "revisit", "").otherwise(F.col("payload"))
    ), date)
    text.write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", max(1, ARCHIVE_BYTES // each)
    ).text(folder)


def _parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Each record's headers, by lower-case name, and its block."""
    file = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(archive)), 1 << 20)
    while (first := file.readline()):
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record where one should begin: {first[:40]!r}")
        headers = {}
        while (line := file.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = file.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]) or file.read(len(END)) != END.encode():
            raise ValueError(f"a record ends too early: {headers.get('warc-record-id')}")
        yield headers, block


_FIELDS = (
    "page_id long, record_type string, url string, stated_digest string, refers_to long, "
    "payload_bytes long, payload_digest string"
)


def _number(uri: str | None) -> int | None:
    digits = (uri or "").removeprefix(f"<{_ID}").removesuffix(">")
    return int(digits) if digits else None


def read(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """A row per record of the archives below ``folder``, with the bytes and SHA-256 of the payload found.

    With ``payload`` the payload itself comes along; all three are null for revisits. An archive is
    read by one task, record by record, so only its compressed form is held whole.
    """
    fields = _FIELDS + ", payload binary" * payload

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for headers, block in _parse(content.as_py()):
                    rows.append(_record(headers, block)[:None if payload else -1])
                    size += len(block) if payload else 1 << 10
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(run, fields)


def _record(headers: dict[str, str], block: bytes) -> tuple:
    response = headers["warc-type"] == "response"
    found = block.partition(END.encode())[2] if response else None
    url = headers.get("warc-target-uri")
    for code in _CODED:
        url = url and url.replace(f"%{code:02X}", chr(code))
    return (
        _number(headers["warc-record-id"]), headers["warc-type"], url,
        headers["warc-payload-digest"].removeprefix("sha256:"), _number(headers.get("warc-refers-to")),
        len(found) if response else None, hashlib.sha256(found).hexdigest() if response else None, found,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [*(f.split()[0] for f in _FIELDS.split(", ")), "payload"][:len(rows[0])]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def resolve(found: DataFrame) -> DataFrame:
    """Records as read, each with ``payload_bytes`` and ``payload_digest`` of its full payload.

    A revisit takes both from the response that it refers to and whose digest its header states; one
    whose response is not there keeps nulls. Payloads take no part.
    """
    heads = found.select("page_id", "url", "record_type", "refers_to", "stated_digest", "payload_bytes", "payload_digest")
    revisit = F.col("record_type") == "revisit"
    originals = heads.where(~revisit).groupBy(
        F.col("page_id").alias("original"), F.col("payload_digest").alias("full_digest")
    ).agg(F.max("payload_bytes").alias("full_bytes"))
    others = heads.where(revisit).join(
        originals, (F.col("refers_to") == F.col("original")) & (F.col("stated_digest") == F.col("full_digest")), "left"
    )
    names = ["page_id", "url", "record_type", "refers_to"]
    return heads.where(~revisit).select(*names, "payload_bytes", "payload_digest").unionByName(others.select(
        *names, F.col("full_bytes").alias("payload_bytes"), F.col("full_digest").alias("payload_digest"),
    ))
