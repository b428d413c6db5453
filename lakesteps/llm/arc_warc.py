"""Legacy web archives: write and parse ARC files, convert them to WARC, read WARC files.

Archives are written by Spark's own text writer, one record per row, so task commits, retries and
any file system Spark knows are covered; a row at the start of a file carries the file's version
block. They are read back as binary files and cut by the lengths that the headers declare.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakesteps.llm.common import free_name, text_or_empty
from lakesteps.session import run_dir

#: Records per archive file, so that a reader's task holds one file of bounded size.
FILE_RECORDS = 2000
#: Smaller payloads are always stored in full.
REVISIT_BYTES = 1000
#: Fixed field names of the two ARC versions, as their version blocks declare them.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location",
        "Offset", "Filename", "Archive-length"),
}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
ID_HEADER = "X-Page-Id"


def _one_word(c: Column) -> Column:
    """A header value without white space; '-' stands for nothing."""
    safe = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"[\s\x00-\x1f]", "%20")
    return F.when(safe == "", "-").otherwise(safe)


def _write(records: DataFrame, path: str, line_end: str) -> None:
    """One text column, as gzip archives; each record ends with ``line_end``."""
    (records.write.option("compression", "gzip").option("lineSep", line_end)
     .option("maxRecordsPerFile", FILE_RECORDS).option("zlib.compress.level", "BEST_SPEED").text(path))


def _first_of_file() -> Column:
    """True for each row that starts a file, as the writer cuts partitions every FILE_RECORDS rows."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) % FILE_RECORDS == 0


def write_arc(pages: DataFrame, path: str, version: int = 1, id: str = "page_id", url: str = "url",
              html: str = "html", date: str = "20240101000000") -> None:
    """Each page as one ARC record: an HTTP response whose body is the page in UTF-8.

    The id travels as an HTTP header; a null page is an empty body, a null url '-'.
    """
    body = text_or_empty(html)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{ID_HEADER}: "),
                    F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")), F.lit(CRLF * 2), body)
    head = [_one_word(F.col(f"`{url}`")), F.lit("0.0.0.0"), F.lit(date), F.lit("text/html")]
    if version == 2:
        head += [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("-")]
    record = F.concat(F.concat_ws(" ", *head, F.octet_length("__http").cast("string")),
                      F.lit("\n"), F.col("__http"))
    about = f"{version} 0 lakesteps\n{' '.join(ARC_FIELDS[version])}\n"
    if version == 1:
        start = f"filedesc://pages.arc 0.0.0.0 {date} text/plain {len(about)}\n{about}\n"
    else:
        start = f"filedesc://pages.arc 0.0.0.0 {date} text/plain 200 - - 0 pages.arc {len(about)}\n{about}\n"
    rows = pages.select(F.col(f"`{url}`"), http.alias("__http")).select(record.alias("value"))
    _write(rows.select(F.concat(F.when(_first_of_file(), start).otherwise(""), "value").alias("value")),
           path, "\n")


def _inflate(chunk: bytes) -> bytes:
    """All members of a gzip file, or the bytes themselves."""
    if chunk[:2] != b"\x1f\x8b":
        return chunk
    out = []
    while chunk:
        reader = zlib.decompressobj(31)
        out.append(reader.decompress(chunk))
        chunk = reader.unused_data.lstrip(b"\0")
    return b"".join(out)


def arc_records(data: bytes) -> Iterator[dict[str, bytes | str]]:
    """Records of one ARC file: the fields its version block declares, in lower case, and content.

    The fields of a header line are counted from its end, so a URL may hold spaces. A header that
    does not fit, or a length beyond the file, ends the file with an error.
    """
    at, names = 0, [n.lower() for n in ARC_FIELDS[1]]
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].rstrip(b"\r")
        if not line.strip():
            at = end + 1 if end >= 0 else len(data)
            continue
        text = line.decode("utf-8", "replace")
        if text.startswith("filedesc://"):
            length = int(text.rsplit(" ", 1)[1])
            about = data[end + 1:end + 1 + length].decode("utf-8", "replace").split("\n")
            version = int(about[0].split(" ")[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            names = [n.lower() for n in (about[1].split() if len(about) > 1 and about[1].strip()
                                         else ARC_FIELDS[version])]
        else:
            values = text.rsplit(" ", len(names) - 1)
            if end < 0 or len(values) != len(names) or not values[-1].isdigit():
                raise ValueError(f"no ARC header at byte {at}: {text[:80]!r}")
            length = int(values[-1])
            if end + 1 + length > len(data):
                raise ValueError(f"ARC record at byte {at} is cut off")
            yield {**dict(zip(names, values)), "content": data[end + 1:end + 1 + length]}
        at = end + 1 + length


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of a WARC file."""
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        if data[at:at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(CRLF)[1:]
        headers = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        length = int(headers["content-length"])
        if end + 4 + length > len(data):
            raise ValueError(f"WARC record at byte {at} is cut off")
        yield headers, data[end + 4:end + 4 + length]
        at = end + 4 + length


def _http(content: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = content.partition(b"\r\n\r\n")
    pairs = (x.split(":", 1) for x in head.decode("utf-8", "replace").split(CRLF)[1:] if ":" in x)
    return {k.lower(): v.strip() for k, v in pairs}, body


def _parsed(spark: SparkSession, path: str, rows_of, schema: str) -> DataFrame:
    """Rows that ``rows_of(data)`` yields for each archive file below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    out_schema = spark.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out_schema)
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for row in rows_of(_inflate(content.as_py())):
                    rows.append(row)
                    held += sum(len(v) for v in row if isinstance(v, (str, bytes)))
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)

    return files.mapInArrow(run, out_schema)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, ip, date, mime, payload) of every record: payload is the HTTP body."""
    def rows(data: bytes):
        for r in arc_records(data):
            http, body = _http(r["content"])
            number = http.get(ID_HEADER.lower(), "")
            yield (int(number) if number else None, r["url"], r["ip-address"], r["archive-date"],
                   r["content-type"], body.decode("utf-8", "replace"))

    return _parsed(spark, path, rows, "page_id long, url string, ip string, date string, mime string, payload string")


def arc_to_warc(records: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write ARC records (as ``read_arc`` gives them) as equivalent WARC records.

    Of equal payloads of at least ``revisit_bytes`` the one with the largest page_id is a response
    and the others revisit it; smaller ones, and rows with a null page_id, are responses. Record
    ids are name-based on page_id and digest, dates come from the ARC date, digests from the
    payload. Rows that repeat page_id and payload count as one record, so each is a response where
    it is the largest.
    """
    rows = records.withColumns({"digest": F.sha1(F.col("payload").cast("binary")),
                                "bytes": F.octet_length("payload")})
    stays = (rows.where(F.col("bytes") >= revisit_bytes).groupBy("digest")
             .agg(F.max("page_id").alias("first")))
    rows = rows.join(stays, "digest", "left").withColumn(
        "revisit", F.coalesce((F.col("bytes") >= revisit_bytes) & (F.col("page_id") < F.col("first")), F.lit(False)))
    name = lambda page: F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        F.md5(F.concat_ws("/", page.cast("string"), "digest")),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    stamp = F.regexp_replace("date", r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z")
    block = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: "), "mime", F.lit(f"{CRLF}{ID_HEADER}: "),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF * 2),
        F.when(F.col("revisit"), "").otherwise(F.col("payload")))
    line = lambda key, *value: F.concat(F.lit(f"{key}: "), *value, F.lit(CRLF))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("page_id"))), line("WARC-Date", stamp),
        line("WARC-Target-URI", F.col("url")), line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.lit("sha1:"), F.col("digest")),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(F.col("revisit"), F.concat(
            line("WARC-Profile", F.lit(IDENTICAL)), line("WARC-Refers-To", name(F.col("first"))),
            line("X-Refers-To-Page", F.col("first").cast("string")))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length("__block").cast("string")), F.lit(CRLF))
    # A WARC record ends with two line ends, which the writer puts after each row.
    _write(rows.withColumn("__block", block).select(F.concat(head, "__block").alias("value")),
           path, CRLF * 2)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; the digest of a response is recomputed from what was read."""
    import hashlib

    def rows(data: bytes):
        for headers, content in warc_records(data):
            http, body = _http(content)
            number, other = http.get(ID_HEADER.lower(), ""), headers.get("x-refers-to-page")
            revisit = headers["warc-type"] == "revisit"
            yield (int(number) if number else None, headers["warc-target-uri"],
                   int(headers["x-payload-length"]) if revisit else len(body),
                   headers["warc-payload-digest"].partition(":")[2] if revisit
                   else hashlib.sha1(body).hexdigest(),
                   headers["warc-type"], int(other) if other else None,
                   headers["warc-record-id"], headers["warc-date"])

    return _parsed(spark, path, rows, (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, record_id string, warc_date string"))


def archive_round_trip(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html",
                       version: int = 1) -> DataFrame:
    """Pages to ARC files, those to WARC files, and what the WARC files then hold, row by row.

    Null pages are empty payloads, null urls '-'; other columns are ignored. Repeated rows are
    records of their own; an empty table gives no rows. Files lie in the session's shared folder.
    """
    spark = pages.sparkSession
    base = f"{run_dir(spark)}/archives-{uuid.uuid4().hex}"
    rows = pages.select(*(F.col(f"`{c}`") for c in dict.fromkeys((id, url, html))))
    write_arc(rows, f"{base}/arc", version, id, url, html)
    arc_to_warc(read_arc(spark, f"{base}/arc"), f"{base}/warc")
    return read_warc(spark, f"{base}/warc").withColumnRenamed("page_id", id)
