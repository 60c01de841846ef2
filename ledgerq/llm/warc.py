"""WARC archives with revisit resolution.

A record is a response with its payload or, if an earlier one holds the same payload, a revisit without it.
Records are rows of Spark's text sink: the line separator it puts after each row is the one that ends a WARC record,
so tasks write archives to any store Spark writes to, gzipped. Files are bounded by payload bytes: records are written by
class of length, the longer ones with fewer to a file. Reading unzips a file record by record and follows the length
fields, so that a payload may hold anything, separators included.

Only headers (key, digest, length) are shuffled to find the repeated digests. A payload then stays in the task that reads
it: the repeated digests are broadcast if their counted rows fit in ``ROOM``. Beyond that, a bitmap of bounded size is
broadcast, and only payloads whose digest hits it are shuffled.

Payloads of less than ``LEAST`` bytes are always responses. Of equal longer payloads the one with the smallest
key is the response; a repeated smallest key (a repeated row) is a response each time. Null payloads count as empty.
A null key is written as an empty id and reads back as null; it is a revisit if any equal payload has a key. Empty tables
give archives without records. Very long payloads get files of their own. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerq.llm.common import cut, mapped

LEAST = 100
#: Bytes of the repeated digests that are broadcast whole, what a row of them takes, and bits of a bitmap of more of them.
ROOM, DIGEST_BYTES, BITS = 64 << 20, 200, 1 << 28
#: Records to a file, for payloads up to so many bytes; a file of longer ones holds a single record.
FILE_RECORDS = ((128 << 10, 2000), (4 << 20, 60))
#: Bytes of payloads that a reading task gathers before it hands them on.
BATCH_BYTES = 8 << 20
#: Fixed values of the format.
VERSION, END, SCHEME = "WARC/1.1", "\r\n\r\n", "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
)


def resolve(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", room: int = ROOM, bits: int = BITS
) -> DataFrame:
    """Records with their type. Writes the repeated digests, at most half as many rows as there are pages, as a table."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body, 256).alias("payload_digest"),
    )
    firsts = (
        rows.where(F.col("payload_bytes") >= LEAST)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("payload_digest", "_first")
    )
    firsts = cut(firsts, "repeated-digests")
    repeats = firsts.count()
    if repeats * DIGEST_BYTES <= room:
        return _typed(rows.join(F.broadcast(firsts), "payload_digest", "left"))
    hit = _flagged(rows, firsts, min(bits, 16 * repeats))
    found = _typed(hit.where("_hit").join(firsts, "payload_digest", "left"))
    return found.unionByName(_typed(hit.where("not _hit").withColumn("_first", F.lit(None).cast("long"))))


def _typed(rows: DataFrame) -> DataFrame:
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")) & (F.col("payload_bytes") >= LEAST)
    return rows.select(
        "page_id",
        "url",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_first")).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(again, "").otherwise(F.col("payload")).alias("payload"),
    )


def _flagged(rows: DataFrame, firsts: DataFrame, bits: int) -> DataFrame:
    """Rows with ``_hit``: whether the bit of their digest is set by any of ``firsts``. The bitmap has ``bits`` / 8 bytes."""
    place = F.pmod(F.xxhash64("payload_digest"), F.lit(bits)) + 1
    bitmap = firsts.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    met = rows.withColumn("_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bitmap), "_bucket", "left")
    return met.withColumn("_hit", F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))).drop("_bucket", "_bits")


def _line(name: str, value: Column) -> Column:
    # Header values are one line each; null values have no line.
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), F.translate(value, "\r\n", "  "), F.lit("\r\n"))).otherwise("")


def write(records: DataFrame, path: str) -> None:
    """Archives of ``resolve``'s records with fresh headers."""
    key = F.concat(F.lit(f"<{SCHEME}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    refers = F.concat(F.lit(f"<{SCHEME}"), F.col("refers_to").cast("string"), F.lit(">"))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", key),
        _line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("WARC-Refers-To", refers),
        _line("WARC-Profile", F.when(F.col("record_type") == "revisit", PROFILE)),
        _line("Content-Type", F.when(F.col("record_type") == "response", "text/html; charset=utf-8")),
        _line("Content-Length", F.octet_length("payload").cast("string")),
    )
    longest = [length for length, _ in FILE_RECORDS]
    size = sum(((F.col("payload_bytes") > length).cast("int") for length in longest), F.lit(0))
    # Few tables hold more than one class; each has a folder and a pass of its own. Without records there is one empty file.
    classes = [r[0] for r in records.select(size.alias("size")).distinct().collect()] or [0]
    for number in classes:
        of_size = records.where(size == number).select(F.concat(head, F.lit("\r\n"), F.col("payload")).alias("value"))
        count = FILE_RECORDS[number][1] if number < len(FILE_RECORDS) else 1
        of_size.write.option("lineSep", END).option("maxRecordsPerFile", count).option("compression", "gzip").text(
            f"{path}/size-{number}"
        )


def parse(archive):
    """(headers by lower-case name, payload) of each record of an archive, bytes or a binary file; one is held at a time."""
    file = io.BytesIO(archive) if isinstance(archive, bytes) else archive
    while line := file.readline():
        if line != f"{VERSION}\r\n".encode():
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = {}
        while (line := file.readline()) != b"\r\n":
            if not line.endswith(b"\n"):
                raise ValueError("the headers of the last record are cut off")
            name, _, value = line.removesuffix(b"\r\n").decode("utf-8", "surrogateescape").partition(": ")
            head[name.lower()] = value
        size = int(head["content-length"])
        body = file.read(size)
        if len(body) < size or file.read(len(END)) != END.encode():
            raise ValueError("the last record is cut off")
        yield head, body


def _id(value: str | None) -> int | None:
    inner = (value or "").removeprefix(f"<{SCHEME}").removesuffix(">")
    return int(inner) if inner else None


def _rows(content: bytes):
    file = io.BytesIO(content)
    for head, body in parse(gzip.GzipFile(fileobj=file) if content[:2] == b"\x1f\x8b" else file):
        response = head["warc-type"] == "response"
        digest = head["warc-payload-digest"].removeprefix("sha256:")
        if response and hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"payload and digest of {head['warc-record-id']} differ")
        url = head.get("warc-target-uri")
        yield (
            _id(head["warc-record-id"]),
            None if url is None else url.encode("utf-8", "surrogateescape").decode("utf-8", "replace"),
            head["warc-type"],
            _id(head.get("warc-refers-to")),
            digest,
            len(body) if response else None,
            body,
        )


def _records(batches):
    names = ("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload")
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())

    def batch_of(rows):
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], list(names))

    for batch in batches:
        for content in batch["content"]:
            rows, held = [], 0
            for row in _rows(content.as_py()):
                rows.append(row)
                held += len(row[-1])
                if held >= BATCH_BYTES or len(rows) == 2000:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder; revisits have no payload and no size of their own."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).select("content")
    return mapped(files, _records, _RECORD)


def sizes(records: DataFrame) -> DataFrame:
    """Records with the payload size of revisits taken from the response they refer to; archives are parsed once."""
    heads = cut(records.select("page_id", "record_type", "refers_to", "payload_digest", "payload_bytes"), "records")
    held = (
        heads.where("record_type = 'response'")
        .groupBy("payload_digest")
        .agg(F.max("payload_bytes").alias("_held"))
        .join(heads.where("record_type = 'revisit'").select("payload_digest").distinct(), "payload_digest", "left_semi")
    )
    return heads.join(held, "payload_digest", "left").select(
        "page_id", F.coalesce("payload_bytes", "_held").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
