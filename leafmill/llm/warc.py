"""WARC archives: writing captures, reading records back, assembling transactions.

A record is a header block, an empty line, its payload and two line ends. Records are written
with Spark's text writer, whose line separator is set to those two line ends, and compressed,
so that one task reads a file from its start. Reading splits at the same separator and puts
payloads that hold it together again by ``Content-Length``, record by record, so memory does
not grow with the file.

A capture is three records: request, response (or revisit, where an equal payload has been
archived before) and metadata; the first and the last name the capture they were made with by
``WARC-Concurrent-To``. ``assemble_captures`` joins them back into one nested row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafmill.llm.tables import Workspace
from leafmill.operators.shaping import once

SEPARATOR = b"\r\n\r\n"
VERSION = "WARC/1.1"
# A smaller payload is always archived in full.
LEAST_REVISIT = 100
FIXED_TIME = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "concurrent_to": "WARC-Concurrent-To",
    "refers_to": "WARC-Refers-To",
    "profile": "WARC-Profile",
    "payload_digest_stated": "WARC-Payload-Digest",
}
RECORD_FIELDS = tuple(name for name in HEADERS if name != "profile")
# Records are handed on when their payloads reach this size.
FLUSH_BYTES = 4 << 20


def _header(name: str, value: Column) -> Column:
    """One header line, or nothing for null; line ends in the value become blanks."""
    clean = F.regexp_replace(value, "[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _record(kind: str | Column, record_id: Column, payload: Column, **more: Column) -> Column:
    """The text of a record without the separator behind it."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit(f"{VERSION}\r\n")]
    lines += [_header("WARC-Type", kind), _header("WARC-Record-ID", record_id)]
    lines += [_header(HEADERS[name], value) for name, value in more.items()]
    length = F.octet_length(payload).cast("string")
    return F.concat(*lines, F.lit("Content-Length: "), length, F.lit("\r\n\r\n"), payload)


def write_warc(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = FIXED_TIME,
) -> str:
    """Write request, response or revisit, and metadata records of every row; returns ``path``.

    The payload is the text in UTF-8 (null: empty). Of rows with equal payloads of at least
    ``LEAST_REVISIT`` bytes, one with the smallest id (null last) is a response; the others
    are revisit records without payload that refer to it. Repeated rows are captures of
    their own. Empty input writes an archive without records.
    """
    payload = F.coalesce(payload_col, F.lit(""))
    page_id = F.col(id_col)
    rows = pages.select(
        F.sha2(payload, 256).alias("digest"),
        F.struct(page_id.isNull().alias("none"), page_id.alias("id")).alias("order"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
    )
    small = F.octet_length("payload") < LEAST_REVISIT
    large = rows.where(~small)
    work = Workspace(pages.sparkSession, "captures")
    copied = work.put(
        large.groupBy(F.col("digest").alias("copied"))
        .agg(F.min("order").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("copied", "first"),
        "copied",
    )
    same = F.col("digest") == F.col("copied")
    nothing = F.lit(None).cast(copied.schema["first"].dataType).alias("first")
    # Payloads of one kind never meet: rows that are no copy are written where they are or, if
    # large, tell so by a join that Spark can split, and originals are reduced before they move.
    alone = rows.where(small).unionByName(large.join(copied, same, "left_anti"))
    original = (
        large.join(copied, same & (F.col("order") == F.col("first")), "left_semi")
        .groupBy("digest")
        .agg(F.min_by(F.struct("order", "url", "payload"), F.struct(F.col("url").isNotNull(), "url")).alias("row"))
        .select("digest", "row.order", "row.url", "row.payload")
    )
    # Revisits have no payload. Of the rows alike in digest and id with an original all but one are.
    narrow = large.select("digest", "order", "url").join(copied, same).drop("copied")
    least = F.min(F.struct(F.col("url").isNotNull(), "url")).alias("least")
    repeated = narrow.where("order = first").groupBy("digest", "order", "first", "url").agg(F.count(F.lit(1)).alias("n"))
    least = repeated.groupBy(F.col("digest").alias("of")).agg(least)
    more = (
        repeated.join(least, F.col("digest") == F.col("of"))
        .withColumn("n", F.col("n") - F.col("url").eqNullSafe(F.col("least.url")).cast("int"))
        .where("n > 0")
        .select("digest", "order", "url", "first", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("k"))
        .drop("k")
    )
    revisits = narrow.where("order <> first").unionByName(more).withColumn("payload", F.lit(""))
    captures = (
        alone.select("*", nothing, F.lit(False).alias("revisit"), F.lit(False).alias("original"))
        .unionByName(original.select("*", nothing, F.lit(False).alias("revisit"), F.lit(True).alias("original")))
        .unionByName(revisits.select("*", F.lit(True).alias("revisit"), F.lit(False).alias("original")))
    )

    def named(order: str, last: Column) -> Column:
        number = F.coalesce(F.col(f"{order}.id").cast("string"), F.lit("none"))
        return F.concat_ws("-", number, F.substring("digest", 1, 16), last)

    # Only an original is named by others; all others are told apart by chance.
    captures = once(captures, name=named("order", F.when(F.col("original"), F.lit("0")).otherwise(F.expr("uuid()"))))
    name, revisit = F.col("name"), F.col("revisit")
    referred = named("first", F.lit("0"))
    url, own = F.col("url"), _urn("main", name)
    host = F.coalesce(F.regexp_extract(url, "^[a-z]+://([^/?#]+)", 1), F.lit(""))
    target = F.coalesce(F.regexp_replace(url, r"\s", "%20"), F.lit("/"))
    asked = F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1\r\nHost: "), host)
    told = F.concat(F.lit("pageId: "), F.coalesce(F.col("order.id").cast("string"), F.lit("")))
    common = {"target_uri": url, "date": F.lit(date)}
    records = F.array(
        _record("request", _urn("request", name), asked, concurrent_to=own, **common),
        _record(
            F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
            own,
            F.col("payload"),
            profile=F.when(revisit, F.lit(REVISIT_PROFILE)),
            refers_to=F.when(revisit, _urn("main", referred)),
            payload_digest_stated=F.concat(F.lit("sha256:"), "digest"),
            **common,
        ),
        _record("metadata", _urn("metadata", name), told, concurrent_to=own, **common),
    )
    captures.select(F.explode(records)).write.option("lineSep", SEPARATOR.decode()).option(
        "compression", "gzip"
    ).text(path)
    work.drop(copied)
    return path


def _urn(kind: str, name: Column) -> Column:
    return F.concat(F.lit(f"<urn:capture:{kind}:"), name, F.lit(">"))


def _header_fields(block: bytes) -> dict[str, str]:
    fields = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the pieces between separators, file by file in their order."""
    wanted = [HEADERS[name].lower() for name in RECORD_FIELDS]
    file, fields, parts, got, need = None, None, [], 0, 0
    done: list[tuple] = []

    def finish() -> bytes:
        """Hand the record on; returns what follows its payload in the pieces read."""
        nonlocal fields
        held = SEPARATOR.join(parts)
        done.append((*[fields.get(name) for name in wanted], held[:need]))
        fields = None
        return held[need:]

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        done.clear()
        kinds = [pa.string()] * len(wanted) + [pa.binary()]
        return pa.record_batch(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            names=[*RECORD_FIELDS, "payload"],
        )

    size = 0
    for batch in batches:
        for piece, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if source != file:
                if fields is not None and parts:
                    finish()
                file, fields = source, None
            if fields is not None:
                got += len(piece) + (len(SEPARATOR) if parts else 0)
                parts.append(piece)
                if got < need:
                    continue
                size += got
                # Line ends before the separator can make it match early, inside of which
                # the next record's header then begins.
                piece = finish()
            block = piece.lstrip(b"\r\n")
            if block[:5] == b"WARC/":
                fields, parts, got = _header_fields(block), [], 0
                need = int(fields.get("content-length") or 0)
            if size > FLUSH_BYTES:
                size = 0
                yield flush()
    if fields is not None and parts:
        finish()
    if done:
        yield flush()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``: headers and payload.

    Null for a header that a record lacks. ``payload_bytes`` and ``payload_digest`` (SHA-256)
    are of the payload as read. A record cut off at the end of a file comes as far as it
    goes; what is no record is skipped.
    """
    pieces = spark.read.option("lineSep", SEPARATOR.decode()).text(path).select(
        F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file")
    )
    kinds = ", ".join(f"{name} string" for name in RECORD_FIELDS)
    return pieces.mapInArrow(_parse, f"{kinds}, payload binary").withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("bigint"),
            "payload_digest": F.sha2("payload", 256),
        }
    )


def assemble_captures(records: DataFrame) -> DataFrame:
    """One nested row per capture, from records joined by their concurrent-to identifiers.

    ``record_id, record_type, target_uri, date, refers_to, payload_bytes, payload_digest,
    payload, requests, metadata, original``. A capture is a response, revisit or resource
    record; ``requests`` and ``metadata`` are the records made with it, sorted by id (empty
    where there are none). A record that repeats with the same id and content counts once.
    For a revisit size and digest are those of the response it refers to, which
    ``original`` holds with its metadata (null where the archives lack it, and then the
    digest is the stated one and the size null). Request and metadata records of captures
    that the archives lack give no rows.
    """
    is_main = F.col("record_type").isin("response", "revisit", "resource")
    side = F.struct("record_id", "date", "payload")
    beside = (
        records.where(F.col("record_type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())
        .groupBy(F.col("concurrent_to").alias("record_id"))
        .agg(
            F.array_sort(F.collect_set(F.when(F.col("record_type") == "request", side))).alias("requests"),
            F.array_sort(F.collect_set(F.when(F.col("record_type") == "metadata", side))).alias("metadata"),
        )
    )
    none = F.array().cast("array<struct<record_id:string,date:string,payload:binary>>")
    captures = (
        records.where(is_main)
        .select(
            "record_id", "record_type", "target_uri", "date", "refers_to", "payload_digest_stated",
            "payload_bytes", "payload_digest", "payload",
        )
        .join(beside, "record_id", "left")
        .withColumns({"requests": F.coalesce("requests", none), "metadata": F.coalesce("metadata", none)})
    )
    revisit = F.col("record_type") == "revisit"
    originals = captures.where(~revisit).select(
        F.col("record_id").alias("refers_to"),
        F.struct("record_id", "target_uri", "payload_bytes", "payload_digest", "metadata").alias("original"),
    )
    # Only revisits refer to others: the rest is not joined, where all would meet at NULL.
    stated = F.regexp_replace("payload_digest_stated", "^sha256:", "")
    again = captures.where(revisit).join(originals, "refers_to", "left").withColumns(
        {
            "payload_bytes": F.col("original.payload_bytes"),
            "payload_digest": F.coalesce("original.payload_digest", stated),
        }
    )
    none = F.lit(None).cast(originals.schema["original"].dataType)
    return captures.where(~revisit).withColumn("original", none).unionByName(again).drop("payload_digest_stated")
