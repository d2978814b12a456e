"""WARC archives: records written and read by Spark, transactions assembled.

``write_archives`` writes a request, a response (or revisit) and a metadata record a
page. Each task's records make up a gzip file of WARC/1.1 records; the text
writer puts them to any file system that Spark can reach, as a record ends with the line
separator CR LF CR LF. ``read_records`` reads such files (gzip, members in any number)
as lines that end with this separator, in order, and cuts them by
``Content-Length``, so a payload may hold anything, WARC records too. A gzip file is
never split, so a task sees whole files; its memory follows the longest record.

``assemble`` joins request, response and metadata records through
``WARC-Concurrent-To`` and emits one nested row a capture. Identifiers may point from
a request or metadata record to the response, from the response to them, or
through a request to its response. A capture of more than PART attached records goes on
in rows with ``part`` 1, 2, ... that hold attached records only. Nothing is
dropped: attached records whose capture is not in the archives have a row with a null
response.

``resolve_revisits`` gives a revisit the page and payload of the record it refers to.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lookup, read_table, scratch, written

#: A shorter payload is never replaced by a revisit.
LEAST = 100
#: Attached records in a nested row.
PART = 1000
END = b"\r\n\r\n"
#: Record types that are a capture, and the profile of a revisit.
CAPTURES = ("response", "revisit", "resource")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LAST = (1 << 63) - 1


def _record_id(run: str, uid: Column, kind: str) -> Column:
    h = F.sha2(F.concat_ws(":", F.lit(run), uid.cast("string"), F.lit(kind)), 256)
    part = lambda at, n: F.substring(h, at, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(13, 3), F.lit("-a"), part(16, 3),
                    F.lit("-"), part(19, 12), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """Header line; null (and left out) where the value is null."""
    return F.concat(F.lit(f"{name}: "), value)


def _record(kind: Column, *lines: Column, block: Column) -> Column:
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), _line("WARC-Type", kind), *lines, _line("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(head.cast("binary"), F.lit(END), block)


def spool(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The pages with a row number, payload bytes and digest, written once, so that
    rows that repeat as a whole can be told apart."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    return written(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
                   .select("*", F.monotonically_increasing_id().alias("uid"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                           F.sha2("payload", 256).alias("digest")), "pages")


def write_archives(spark: SparkSession, spooled: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least: int = LEAST) -> None:
    """Write three records a page to ``path``. Of pages with equal payloads of at least
    ``least`` bytes, that with the smallest page_id (null last; of rows that repeat it, one)
    is a response, the others are revisits that refer to it. White space and control
    characters of a url are written as %20; a null url has no header line."""
    run = uuid.uuid4().hex
    big = F.col("payload_bytes") >= least
    first = written(spooled.filter(big).groupBy("digest").agg(F.min_by("uid", F.coalesce("page_id", F.lit(_LAST))).alias("first"), F.count("*").alias("held"))
                    .filter("held > 1").withColumnRenamed("digest", "key"), "repeated_payloads")
    # short payloads are in no group; they get keys of their own, so that none is frequent
    rows = lookup(spooled.withColumn("key", F.when(big, F.col("digest")).otherwise(F.col("uid").cast("string"))), first, "key", "held")
    again = F.coalesce(F.col("first") != F.col("uid"), F.lit(False))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    own, about = _record_id(run, F.col("uid"), "capture"), [_line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", uri)]
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"),
                    F.lit("\r\n\r\n")).cast("binary")
    answer = _record(
        kind, _line("WARC-Record-ID", own), *about, _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, _line("WARC-Refers-To", _record_id(run, F.col("first"), "capture"))), F.when(again, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"), block=F.when(again, http).otherwise(F.concat(http, F.col("payload"))))
    ask = _record(
        F.lit("request"), _line("WARC-Record-ID", _record_id(run, F.col("uid"), "request")), *about, _line("WARC-Concurrent-To", own),
        F.lit("Content-Type: application/http; msgtype=request"),
        block=F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")).cast("binary"))
    note = _record(
        F.lit("metadata"), _line("WARC-Record-ID", _record_id(run, F.col("uid"), "metadata")), *about, _line("WARC-Concurrent-To", own),
        F.lit("Content-Type: application/warc-fields"),
        block=F.concat_ws("", _line("page_id", F.concat(F.col("page_id").cast("string"), F.lit("\r\n")))).cast("binary"))
    (rows.select(F.explode(F.array(ask, answer, note)).alias("record")).select(F.col("record").cast("string").alias("value"))
         .write.option("lineSep", END.decode()).option("compression", "gzip").text(path))


RECORD = ("record_id string, type string, target_uri string, date string, concurrent_to array<string>, refers_to string, "
          "status int, fields map<string,string>, payload_bytes long, payload_digest string, intact boolean")


def _headers(raw: bytes) -> dict[str, list[str]]:
    """Values by lower-case name; a line that begins with white space goes on with the one before."""
    out: dict[str, list[str]] = {}
    last = None
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            out[last][-1] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            out.setdefault(last, []).append(value.strip())
    return out


def _cells(head: bytes, block: bytes, keep: bool) -> tuple:
    h = _headers(head)
    one = lambda name: (h.get(name) or [None])[0]
    kind, content = one("warc-type"), (one("content-type") or "").lower()
    status, fields, payload = None, [], block
    if content.startswith("application/http"):
        at = block.find(END)
        top, payload = (block, b"") if at < 0 else (block[:at], block[at + 4:])
        word = top.split(b"\r\n", 1)[0].split(b" ")
        if kind != "request" and len(word) > 1 and word[1].isdigit():
            status = int(word[1])
    elif content.startswith("application/warc-fields"):
        fields = [(k, v[0]) for k, v in _headers(block).items()]
    declared = one("warc-payload-digest")
    if kind == "revisit":                      # its payload is with the record it refers to
        size, digest, intact = None, declared[7:] if (declared or "").startswith("sha256:") else None, None
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        intact = declared[7:].lower() == digest if (declared or "").startswith("sha256:") else None
    return (one("warc-record-id"), kind, one("warc-target-uri"), one("warc-date"), h.get("warc-concurrent-to", []), one("warc-refers-to"),
            status, fields, size, digest, intact) + ((payload if kind != "revisit" else None,) if keep else ())


class Cutter:
    """Cuts a stream of bytes into (header, block) by ``Content-Length``."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.size, self.need, self.head = 0, 0, None

    def feed(self, data: bytes):
        self.parts.append(data)
        self.size += len(data)
        if self.size < self.need:              # a long record is joined once, when it is whole
            return
        buf, at = b"".join(self.parts), 0
        while True:
            if self.head is None:
                while buf[at:at + 2] == b"\r\n":
                    at += 2
                end = buf.find(END, at)
                if end < 0:
                    self.need = 0
                    break
                if not buf.startswith(b"WARC/", at):
                    raise ValueError("not a WARC record: " + repr(buf[at:at + 40]))
                self.head, at = buf[at:end], end + 4
                self.length = int(_headers(self.head)["content-length"][0])
            self.need = self.length + 4
            if len(buf) - at < self.need:
                break
            yield self.head, buf[at:at + self.length]
            at += self.need
            self.head = None
        self.parts, self.size = [buf[at:]], len(buf) - at

    def close(self) -> None:
        if self.head is not None or b"".join(self.parts).strip(b"\r\n"):
            raise ValueError("an archive ends inside a record")
        self.__init__()


def read_records(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """Every record of the gzip archives at ``path`` (columns RECORD, with ``keep_payload`` also
    ``payload``). The payload of an HTTP record is what follows its HTTP header.
    ``intact``: the payload has the declared SHA-256 (null: none declared). An archive
    that is cut off, or holds anything but WARC records, is an error."""
    schema = RECORD + ", payload binary" * keep_payload
    arrow = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
                       ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("status", pa.int32()),
                       ("fields", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("intact", pa.bool_())] + [("payload", pa.binary())] * keep_payload)

    def run(batches):
        cutter, file, rows, held = Cutter(), None, [], 0

        def flush():
            nonlocal rows, held
            out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
            rows, held = [], 0
            return out

        for batch in batches:
            value, files = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(value):
                end = len(value) if files[-1] == files[at] else next(k for k in range(at, len(value)) if files[k] != files[at])
                if files[at] != file:
                    cutter.close()
                    file = files[at]
                for head, block in cutter.feed(END.join(value[at:end]) + END):
                    rows.append(_cells(head, block, keep_payload))
                    held += len(block) if keep_payload else 200
                    if held > 8 << 20:
                        yield flush()
                at = end
            if rows:
                yield flush()
        cutter.close()

    lines = spark.read.schema("value string").option("lineSep", END.decode()).text(path)
    return lines.select(F.col("value").cast("binary").alias("value"), F.xxhash64("_metadata.file_path").alias("file")).mapInArrow(run, schema)


def assemble(records: DataFrame, part: int = PART) -> DataFrame:
    """One nested row a capture: capture_id, part, response (struct), requests and metadata
    (arrays of structs, by record id). ``records`` should be written: it is read several
    times. Records of other types, and attached ones that name no other record, are rows of their own
    under their own id with a null response. Captures that repeat an id each get all that is
    attached to it. No records, no rows."""
    body = [c for c in records.columns if c not in ("concurrent_to",)]
    capture = records.filter(F.col("type").isin(*CAPTURES))
    other = records.filter(~F.coalesce(F.col("type").isin(*CAPTURES), F.lit(False)))
    links = (other.select("record_id", F.explode("concurrent_to").alias("target"))
             .unionByName(capture.select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("target"))))
    links = written(links.groupBy("record_id", "target").agg(F.lit(1).alias("one")).drop("one"), "links")
    # a target that is itself attached leads on to its own target
    held = links.groupBy("target").agg(F.count("*").alias("held"))
    onward = links.filter("record_id != target").groupBy(F.col("record_id").alias("target")).agg(F.min("target").alias("via"))
    hops = written(held.join(onward, "target").join(capture.select(F.col("record_id").alias("target")).distinct(), "target", "left_anti"), "hops")
    to = (lookup(links, hops, "target", "held").select("record_id", F.coalesce("via", "target").alias("capture_id"))
          .groupBy("record_id").agg(F.min("capture_id").alias("capture_id")))
    attached = written(other.join(to, "record_id", "left").select(F.coalesce("capture_id", "record_id", F.lit("")).alias("capture_id"), F.struct(*body).alias("record")), "attached")
    many = written(attached.groupBy("capture_id").agg(F.count("*").alias("held")).filter(F.col("held") > part), "many_attached")
    parts = F.ceil(F.coalesce("held", F.lit(1)) / part).cast("long")
    kind = F.col("record.type")
    order = lambda c: F.array_sort(c, lambda x, y: F.when(x.record_id < y.record_id, -1).when(x.record_id > y.record_id, 1).otherwise(0))
    nested = (lookup(attached, many, "capture_id", "held").withColumn("part", F.pmod(F.xxhash64("record.record_id"), parts).cast("int"))
              .groupBy("capture_id", "part").agg(order(F.collect_list(F.when(kind == "request", F.col("record")))).alias("requests"),
                                                 order(F.collect_list(F.when(F.coalesce(kind != "request", F.lit(True)), F.col("record")))).alias("metadata")))
    whole = capture.select(F.col("record_id").alias("capture_id"), F.lit(0).alias("part"), F.struct(*body).alias("response"))
    none = lambda c: F.coalesce(F.col(c), F.array().cast(nested.schema[c].dataType))
    return whole.join(nested, ["capture_id", "part"], "full").select("capture_id", "part", "response", none("requests").alias("requests"), none("metadata").alias("metadata"))


def resolve_revisits(captures: DataFrame, keep: dict[str, Column]) -> DataFrame:
    """Captures with a response, their payload_bytes and payload_digest, record_type and the
    columns ``keep``; a revisit has those of ``keep`` of the response that it refers to as ``<name>_referred``
    (null: not in the archives) and its payload's size. ``captures`` should be written."""
    rows = captures.filter("response is not null").select(
        "capture_id", *(c.alias(n) for n, c in keep.items()), F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("refers_to"),
        F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"))
    back = rows.filter("record_type = 'revisit' and refers_to is not null")
    held = back.groupBy(F.col("refers_to").alias("capture_id")).agg(F.count("*").alias("held"))
    named = {n: f"{n}_referred" for n in keep}
    found = written(rows.filter("record_type != 'revisit'").join(held, "capture_id").select(
        F.col("capture_id").alias("refers_to"), "held", *(F.col(n).alias(r) for n, r in named.items()),
        F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("digest")).dropDuplicates(["refers_to"]), "referred")
    out = lookup(back, found, "refers_to", "held").select(
        "capture_id", *keep, "record_type", *named.values(), F.coalesce("payload_bytes", "size").alias("payload_bytes"),
        F.coalesce("payload_digest", "digest").alias("payload_digest"))
    rest = rows.filter("not (record_type = 'revisit' and refers_to is not null)")
    empty = [F.lit(None).cast(found.schema[r].dataType).alias(r) for r in named.values()]
    return out.unionByName(rest.select("capture_id", *keep, "record_type", *empty, "payload_bytes", "payload_digest"))


def pages_of(spark: SparkSession, path: str) -> DataFrame:
    """One row a page from the archives of ``write_archives``: page_id (of the metadata record),
    payload_bytes, payload_digest, record_type, refers_to (page_id)."""
    captures = written(assemble(written(read_records(spark, path), "records")), "captures")
    page = F.get("metadata", F.lit(0))["fields"]["page_id"].cast("long")
    return resolve_revisits(captures, {"page_id": page}).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("page_id_referred").alias("refers_to"))


def op13_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages`` written as WARC archives and read back."""
    path = scratch(spark, "warc")
    write_archives(spark, spool(read_table(spark, sf_dir, "pages")), path)
    return pages_of(spark, path)


OP13_SQL = """
WITH page AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (
    SELECT payload_digest, min(page_id) AS first_id FROM page WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, page.payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM page LEFT JOIN first ON first.payload_digest = page.payload_digest
"""
