"""Web archives: write pages as WARC transactions, and put captures together from their records.

An archive is a file of gzip members, one per record, as the format advises. A page becomes a request, a
response (or a revisit, if another record has its payload) and a metadata record. The request and the
metadata name another record of their transaction in ``WARC-Concurrent-To``.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plaza.llm.common import Scratch, pieces
from plaza.operators.skew import join_groups

# Fixed values of the format.
VERSION = "WARC/1.1"
END = b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 32 << 20  # an archive ends with the capture that reaches this
READ_BYTES = 8 << 20
CAPTURED = "1970-01-01T00:00:00Z"

RECORDS = "record_id string, type string, target_uri string, date string, concurrent_to string, refers_to string, content_type string, payload_digest string, payload_bytes long, fields map<string,string>"


def payload_digest(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base 32: eight digits for every 40 bits."""
    found = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(found, first, 10), 16, 32), 8, "0") for first in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def response_id(digest: str, size: int) -> str:
    """One payload has one response, so its id follows from the payload and revisits can name it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'payload:{digest}:{size}')}>"


def header_value(text: str) -> str:
    """A url as one header line: white space and controls are escaped as in urls."""
    return "".join(c if c.isprintable() and c != " " else quote(c) for c in text)


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {value}" for name, value in fields if value is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def transaction(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, date: str) -> Iterator[bytes]:
    """The records of one page; the request's id is new, so repeated rows stay captures of their own."""
    uri = None if url is None else header_value(url)
    first = response_id(digest, len(payload))
    own = f"<{uuid.uuid4().urn}>" if revisit else first
    asked, noted = f"<{uuid.uuid4().urn}>", f"<{uuid.uuid4().urn}>"

    def head(kind: str, name: str, content: str, *more: tuple[str, str | None]) -> list[tuple[str, str | None]]:
        return [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Target-URI", uri), ("Content-Type", content), *more]

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    told = ("WARC-Payload-Digest", f"sha1:{digest}")
    if revisit:
        yield record(head("revisit", own, "application/http; msgtype=response", told, ("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", first)), http)
    else:
        yield record(head("response", own, "application/http; msgtype=response", told), http + payload)
    after = (uri or "").partition("://")[2]
    host, slash, path = after.partition("/")
    yield record(head("request", asked, "application/http; msgtype=request", ("WARC-Concurrent-To", own)), f"GET {slash + path or '/'} HTTP/1.1\r\nHost: {host}".encode() + END)
    notes = "" if page_id is None else f"page-id: {page_id}\r\n"
    yield record(head("metadata", noted, "application/warc-fields", ("WARC-Concurrent-To", asked)), notes.encode())


def write_archives(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    archive_bytes: int = ARCHIVE_BYTES, level: int = 3, date: str = CAPTURED,
) -> None:
    """Write every page as a transaction into archives under ``path``, which Spark's writer commits.

    Of pages with equal payloads the one with the largest id is the response; the others revisit it. Only
    payloads that several ids have take part in the join that tells, so where there are few of them the
    planner broadcasts them by their real size and no page is shuffled; else AQE splits a hot payload.
    A NULL payload is an empty one. A NULL id is less than any other. Rows that repeat both the id and
    the payload of a response are written as that response again. A NULL url leaves its header out.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    payload = F.coalesce(F.encode(payload_col, "UTF-8"), F.lit(b""))
    given = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    given = given.select("*", payload_digest(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    ids = [F.max("page_id").alias("last"), F.min("page_id").alias("least"), F.count("page_id").alias("named"), F.count(F.lit(1)).alias("n")]
    several = given.groupBy("digest", "size").agg(*ids).filter("last > least or (named > 0 and named < n)").select("digest", "size", "last")
    several = scratch.write(several, "payloads")
    placed = join_groups(given, several, ["digest", "size"], "left")
    placed = placed.select("page_id", "url", "payload", "digest", F.coalesce(F.col("last") != F.col("page_id"), F.col("last").isNotNull()).alias("revisit"))

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in pieces(batches, "payload", READ_BYTES):
            for row in batch.to_pylist():
                for one in transaction(row["page_id"], row["url"], row["payload"], row["digest"], row["revisit"], date):
                    press = zlib.compressobj(level, zlib.DEFLATED, 31)
                    held.append(press.compress(one) + press.flush())
                    size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])

    # A row is an archive and a file. The writer must end a row with something: a zero byte, which
    # readers of gzip files skip as padding. The cast keeps the bytes as they are.
    packed = placed.mapInArrow(archives, "archive binary").select(F.col("archive").cast("string").alias("value"))
    packed.write.mode("overwrite").option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)
    scratch.drop("payloads")


def members(data: memoryview) -> Iterator[bytes]:
    """The contents of the gzip members of an archive in turn; one without compression is one member."""
    if bytes(data[:2]) != b"\x1f\x8b":
        yield bytes(data)
        return
    at = 0
    while at < len(data):
        if data[at] == 0:  # padding
            at += 1
            continue
        press, found, step = zlib.decompressobj(31), [], 1 << 20
        while not press.eof:
            if at >= len(data):
                raise ValueError("an archive ends within a record")
            found.append(press.decompress(data[at : at + step]))
            at += len(data[at : at + step]) - len(press.unused_data)
        yield b"".join(found)


def records_of(data: memoryview) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Header fields (names in lower case) and block of every record; blocks are taken by their length."""
    for member in members(data):
        at = 0
        while at < len(member):
            end = member.find(END, at)
            if end < 0 or not member.startswith(b"WARC/", at):
                raise ValueError("not a WARC record")
            fields: dict[str, list[str]] = {}
            for line in member[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
                name, _, value = line.partition(":")
                fields.setdefault(name.strip().lower(), []).append(value.strip())
            start = end + len(END)
            stop = start + int(fields["content-length"][0])
            if len(member) < stop:
                raise ValueError("a record's block is cut off")
            yield fields, member[start:stop]
            at = stop + len(END)


def read_archives(spark: SparkSession, path: str, *, with_blocks: bool = False) -> DataFrame:
    """One row per record and record that it is concurrent to, of all archives under ``path``.

    ``payload_digest`` and ``payload_bytes`` are those of a response's payload as it was read; a digest
    that its record states otherwise is an error, as is a damaged archive. A revisit has the digest that
    it states. ``fields`` are the lines of a metadata record. ``with_blocks`` adds the whole block.
    A task holds one archive at a time, which its writer bounds.
    """
    ddl = RECORDS + ", block binary" * with_blocks
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def batch_of() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for content in batch.column("content"):
                for fields, block in records_of(memoryview(content.as_buffer())):
                    one = {name: values[0] for name, values in fields.items()}
                    kind, digest, size, notes = one.get("warc-type"), one.get("warc-payload-digest"), None, {}
                    digest = digest and digest.removeprefix("sha1:")
                    if kind == "response":
                        payload = memoryview(block)[block.find(END) + len(END) :]
                        size, found = len(payload), b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest is not None and digest != found:
                            raise ValueError(f"record {one.get('warc-record-id')} has another payload than it states")
                        digest = found
                    elif kind == "metadata":
                        notes = {name.strip(): value.strip() for name, _, value in (line.partition(":") for line in block.decode("utf-8", "replace").splitlines()) if name}
                    for other in fields.get("warc-concurrent-to", [None]):
                        rows.append((one.get("warc-record-id"), kind, one.get("warc-target-uri"), one.get("warc-date"), other, one.get("warc-refers-to"), one.get("content-type"), digest, size, list(notes.items()), *([block] if with_blocks else [])))
                    held += len(block) if with_blocks else 1000
                    if held >= READ_BYTES:
                        yield batch_of()
                        rows, held = [], 0
        if rows:
            yield batch_of()

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, ddl)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: request, response (a response or revisit) and metadata.

    A request joins the response that it names as concurrent, or that names it; metadata join the request or
    the response they name. A record that occurs again under its id is one record, but every request is a
    capture, so pages that repeat a response are all there. A response without a request, and a request
    without a response, are captures with a NULL in its place; metadata that name neither are left out, as
    they belong to no capture. ``metadata`` is a list, of as many records as a transaction has.
    """
    names = [name for name in records.columns if name != "concurrent_to"]
    # Copies of a response are equal, so any one serves; first() keeps the shuffle to one row per task and id.
    whole = F.struct(*names)
    answers = records.filter(F.col("type").isin("response", "revisit"))
    responses = answers.groupBy(F.col("record_id").alias("_response")).agg(F.first(whole).alias("response"))
    requests = records.filter(F.col("type") == "request").groupBy(F.col("record_id").alias("_request")).agg(
        F.first(whole).alias("request"), F.max("concurrent_to").alias("_forward"))
    back = answers.filter(F.col("concurrent_to").isNotNull()).groupBy(F.col("concurrent_to").alias("_asked")).agg(F.max("record_id").alias("_back"))
    requests = requests.join(back, F.col("_request") == F.col("_asked"), "left").withColumn("_answer", F.coalesce("_forward", "_back"))
    with_request = join_groups(requests.withColumnRenamed("_answer", "_key"), responses.withColumnRenamed("_response", "_key"), ["_key"], "left")
    with_request = with_request.select("_request", F.when(F.col("response").isNotNull(), F.col("_key")).alias("_response"), "request", "response")
    asked = requests.select(F.col("_answer").alias("_named")).distinct()
    alone = responses.join(asked, F.col("_response") == F.col("_named"), "left_anti").select(F.lit(None).cast("string").alias("_request"), "_response", F.lit(None).cast(with_request.schema["request"].dataType).alias("request"), "response")
    found = with_request.unionByName(alone)
    notes = records.filter((F.col("type") == "metadata") & F.col("concurrent_to").isNotNull())
    notes = notes.groupBy(F.col("concurrent_to").alias("_of")).agg(F.collect_list(whole).alias("_notes"))
    found = found.join(notes, F.col("_request") == F.col("_of"), "left").withColumnRenamed("_notes", "_asked_notes").drop("_of")
    found = join_groups(found.withColumnRenamed("_response", "_of"), notes, ["_of"], "left").withColumnRenamed("_notes", "_answer_notes")
    none = F.array().cast(found.schema["_answer_notes"].dataType)
    metadata = F.concat(F.coalesce("_asked_notes", none), F.coalesce("_answer_notes", none))
    return found.select("request", "response", metadata.alias("metadata"))


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every capture under ``path``.

    Revisits get the bytes and the page of the response that they refer to by one join on its record id.
    """
    scratch = Scratch(spark)
    # The records without their payloads are written, as several joins read them.
    whole = captures(scratch.write(read_archives(spark, path), "records"))
    page = F.get(F.filter("metadata", lambda m: m["fields"]["page-id"].isNotNull()), F.lit(0))["fields"]["page-id"].cast("long")
    flat = scratch.write(whole.select(page.alias("page_id"), F.col("response.target_uri").alias("url"), F.col("response").alias("r")), "captures")
    scratch.drop("records")
    answers = flat.filter("r.type = 'response'")
    first = answers.groupBy(F.col("r.record_id").alias("_to")).agg(F.max("page_id").alias("_page"), F.max("r.payload_bytes").alias("_bytes"))
    revisits = join_groups(flat.filter("r.type = 'revisit'").withColumn("_to", F.col("r.refers_to")), first, ["_to"], "left")
    shown = ["page_id", "url", "payload_bytes", F.col("r.payload_digest").alias("payload_digest"), F.col("r.type").alias("record_type"), "refers_to"]
    responses = answers.withColumns({"payload_bytes": F.col("r.payload_bytes"), "refers_to": F.lit(None).cast("long")})
    return responses.select(*shown).union(revisits.withColumns({"payload_bytes": F.col("_bytes"), "refers_to": F.col("_page")}).select(*shown))


# DuckDB has no base 32: 32 groups of five bits are read from the hash's 40 hex digits, four at a time.
_DIGEST = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (('0x' || substr(h, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31, 1)), '')"""

ORACLE = f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS last FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, {_DIGEST.replace('1 + (', '1 + ((').replace('& 31,', '& 31)::INT,')} AS payload_digest,
  CASE WHEN last IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to
FROM firsts
"""
