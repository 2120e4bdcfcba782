"""WARC archives: revisit records for repeated payloads, writing, reading, and resolving revisits.

Records are written as lines of text files whose line separator is the empty lines that end a WARC record, so Spark's own
writer, with its commit of whole tasks, makes valid archives in any file system it knows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an archive on average, before compression; an archive is parsed by one task.
ARCHIVE_BYTES = 16 * 1024 * 1024
# Fixed values of the format.
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HEADERS = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, "
    "refers_to_uri string, payload_bytes long, intact boolean, payload binary"
)


def sha1_base32(payload: Column) -> Column:
    """SHA-1 of a payload in upper-case base 32: every five hexadecimal digits are four of base 32."""
    hexes = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexes, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def deduplicate(records: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Add payload_digest, payload_bytes, record_type and refers_to (an id) to records (id, uri, payload).

    Of the records with equal payloads of ``min_bytes`` or more, that with the largest id is the response and the others
    revisit it; smaller payloads are all responses. Only ids and digests are shuffled to find this out, the payload moves
    once, to the archive that will hold it. A null payload counts as empty. A record with a null id is a response that
    nothing refers to; such records are spread by address and input partition, so they don't gather in one archive. Rows
    that repeat an id and its payload have the same fate and the same archive. Other columns are left out; an empty
    table has no records. A payload is held whole by one task, so it has to stay below the 2 GB of a value in Spark.
    """
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit(b""))
    full = records.select(
        "id",
        "uri",
        payload.alias("payload"),
        sha1_base32(payload).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    heads = full.select("id", "uri", "payload_digest", "payload_bytes").where("id is not null")
    heads = heads.where(F.col("payload_bytes") >= min_bytes)
    last = F.max(F.struct("id", "uri")).alias("last")
    originals = heads.groupBy("payload_digest").agg(last, F.count("*").alias("n")).where("n > 1")
    revisits = (
        heads.join(originals, "payload_digest")
        .where("id < last.id")
        .select("id", "payload_digest", F.col("last.id").alias("refers_to"), F.col("last.uri").alias("refers_to_uri"))
        .distinct()
    )
    kind = F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")
    size = full.agg(F.sum("payload_bytes").alias("n")).first()["n"] or 0
    # Dealt by the very columns of the join, which then moves no payload again.
    own = F.xxhash64("id", "payload_digest")
    spread = F.when(F.col("id").isNull(), F.xxhash64("uri", F.spark_partition_id())).otherwise(own)
    on = ["deal", "id", "payload_digest"]
    dealt = full.withColumn("deal", spread).repartition(max(1, -(-size // archive_bytes)), *on)
    return dealt.join(revisits.withColumn("deal", own), on, "left").drop("deal").withColumn("record_type", kind)


def header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line ends in a value can't start another header."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def record_name(key: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def write_archives(records: DataFrame, path: str, date: str | None = None) -> None:
    """Write records as ``deduplicate`` gives them to gzipped archives in the folder ``path``, with fresh headers.

    A response holds its payload behind an HTTP head; a revisit holds the head alone and refers to its response by id,
    address, date and digest.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    revisit = F.col("record_type") == "revisit"
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    length = F.octet_length(head) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", record_name(F.col("id"))),
        header("WARC-Target-URI", F.col("uri")),
        header("WARC-Date", F.lit(date)),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        header("WARC-Refers-To", F.when(revisit, record_name(F.col("refers_to")))),
        header("WARC-Refers-To-Target-URI", F.when(revisit, F.col("refers_to_uri"))),
        header("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        length.cast("string"),
        F.lit(END),
        head,
        F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string")),
    )
    records.select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record; what is no WARC record raises an error."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        name = ""
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and name:  # the value goes on
                headers[name] += " " + text.strip()
            else:
                name, _, value = text.partition(":")
                name = name.strip().lower()
                headers[name] = value.strip()
        block = stream.read(size := int(headers.get("content-length", 0)))
        if len(block) < size:
            raise ValueError("a WARC record is cut off")
        yield headers, block


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """A block without its HTTP head."""
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all archives in a folder, gzipped or plain, whole or by record.

    ``payload_digest`` and ``payload_bytes`` of a response are those of the payload as read, and ``intact`` says whether
    the digest agrees with the header; a revisit has the header's digest and no payload. ``payloads=False`` leaves the
    payloads out. Other types of record are passed over. An archive is read by one task as a whole.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                found = []
                stream = io.BytesIO(content)
                whole = gzip.GzipFile(fileobj=stream) if content[:2] == b"\x1f\x8b" else stream
                for headers, block in parse(whole):
                    kind = headers.get("warc-type")
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    said = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
                    payload = None if kind == "revisit" else payload_of(headers, block)
                    digest = said if payload is None else digest_of(payload)
                    found.append(
                        (
                            headers.get("warc-record-id"),
                            kind,
                            headers.get("warc-target-uri"),
                            headers.get("warc-date"),
                            digest,
                            headers.get("warc-refers-to"),
                            headers.get("warc-refers-to-target-uri"),
                            None if payload is None else len(payload),
                            said is None or said == digest,
                            payload if payloads else None,
                        )
                    )
                out = pd.DataFrame(found, columns=[x.split()[0] for x in HEADERS.split(", ")])
                yield out.astype({"payload_bytes": "Int64"})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, HEADERS)


def resolve(records: DataFrame) -> DataFrame:
    """Records with payload_bytes of revisits taken from the response they revisit, joined by payload digest.

    Responses with one digest are alike in payload_bytes. A revisit that names no record refers to the last of them by
    record_id. A revisit whose response isn't among the records keeps what its header says, with null payload_bytes.
    """
    plain = records.where("record_type <> 'revisit'")
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes")
    found = F.max(F.struct("record_id", "payload_bytes")).alias("found")
    originals = plain.groupBy("payload_digest").agg(found)
    resolved = (
        revisits.join(originals, "payload_digest", "left")
        .withColumn("payload_bytes", F.col("found.payload_bytes"))
        .withColumn("refers_to", F.coalesce("refers_to", F.col("found.record_id")))
    )
    return plain.unionByName(resolved.select(*plain.columns))
