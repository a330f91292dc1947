"""WARC archives: writing captures and assembling transactions.

``write_archives`` turns every page into three WARC/1.0 records: a request, a
response (or, where an earlier page already has the same payload, a revisit
that refers to it) and a metadata record; request and metadata name the
response in ``WARC-Concurrent-To``. Files are written by Spark's own writer
(its commit protocol, any store): a record is one UTF-8 value, and the record
end ``\\r\\n\\r\\n`` is the line separator.

``read_records`` parses archives (plain or gzip) by Content-Length, a record
at a time, so a payload may hold anything. ``assemble`` joins the records of
each transaction through all their concurrent-to identifiers, in whichever
direction they are given and over any number of records in between (metadata to
request to response), and emits one nested row per capture.

Of payloads with equal bytes, ``REVISIT_BYTES`` at least, the smallest page_id
keeps the response. The payloads are only shuffled when the table of repeated
digests is too large to broadcast, and then with hot digests dealt out.

Defined cases: null html is an empty payload; null url leaves the target URI
out; a null page_id never becomes the response of others unless all are null;
rows repeated whole are one capture with that many copies; empty tables give
empty archives and results; other columns are not read. Records without a
partner give a capture of their own with the missing parts null or empty.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.shared import salted_join, stored

REVISIT_BYTES = 100
PAGES_PER_FILE = 1000
BROADCAST_DIGESTS = 100_000
CRAWLED = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
END = "\r\n"
FLUSH_BYTES = 1 << 22
ANCHOR = "type in ('response', 'revisit', 'resource', 'conversion')"


def _record_id(kind: str, capture: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), capture))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind, record_id: Column, headers: list[Column], block: Column) -> Column:
    """A whole record without its closing line ends; null headers are left out."""
    lines = [F.lit("WARC/1.0"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id),
             F.lit(f"WARC-Date: {CRAWLED}"), *headers,
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), block)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write the WARC records of every page as gzip files under ``path``."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"),
                        F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("bytes"))
    repeated = (rows.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest")
                .agg(F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", F.col("url").isNull().alias("m"), "url")).alias("first"),
                     F.count("*").alias("n")).where("n > 1")
                .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")))
    if repeated.count() <= BROADCAST_DIGESTS:
        marked = rows.join(F.broadcast(repeated), "digest", "left")
    else:
        marked = salted_join(rows, repeated, ["digest"], ["page_id", "url"], "left")
    revisit = F.coalesce(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False))

    def capture(page: str, url: str) -> Column:
        return F.concat_ws("|", F.coalesce(F.col(page).cast("string"), F.lit("-")), F.coalesce(F.col(url), F.lit("-")), "digest")

    own, url = capture("page_id", "url"), F.col("url")
    for bad, good in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20")):
        url = F.replace(url, F.lit(bad), F.lit(good))
    response_id, target = _record_id("response", own), _header("WARC-Target-URI", url)
    parts = F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]*)([^#]*)", 1), F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]*)([^#]*)", 2)
    asked = F.concat(F.lit("GET "), F.coalesce(F.when(parts[1] == "", F.lit("/")).otherwise(parts[1]), F.lit("/")),
                     F.lit(f" HTTP/1.1{END}Host: "), F.coalesce(parts[0], F.lit("")), F.lit(END + END))
    answered = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                        F.col("bytes").cast("string"), F.lit(END + END))
    records = F.array(
        _record(F.lit("request"), _record_id("request", own),
                [target, _header("WARC-Concurrent-To", response_id), F.lit("Content-Type: application/http; msgtype=request")], asked),
        _record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), response_id,
                [target, _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
                 F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
                 F.when(revisit, _header("WARC-Refers-To", _record_id("response", capture("first_id", "first_url")))),
                 F.lit("Content-Type: application/http; msgtype=response")],
                F.when(revisit, answered).otherwise(F.concat(answered, F.col("html")))),
        _record(F.lit("metadata"), _record_id("metadata", own),
                [target, _header("WARC-Concurrent-To", response_id), F.lit("Content-Type: application/warc-fields")],
                F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END))))
    (marked.select(F.explode(records).alias("value")).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("lineSep", END + END).option("maxRecordsPerFile", 3 * PAGES_PER_FILE).text(path))


RECORD = ("record_id string, type string, target_uri string, concurrent_to array<string>, refers_to string, "
          "payload_digest string, payload_bytes long, payload binary, fields array<struct<name: string, value: string>>")
_FIELDS = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
_TYPES = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64(), pa.binary(), _FIELDS]
_NAMES = ["record_id", "type", "target_uri", "concurrent_to", "refers_to", "payload_digest", "payload_bytes", "payload", "fields"]


def _headers(lines: Iterator[bytes]) -> list[tuple[str, str]]:
    out = []
    for line in lines:
        name, found, value = line.decode("utf-8", "replace").partition(":")
        if found:
            out.append((name.strip().lower(), value.strip()))
    return out


def parse_archive(content: bytes) -> Iterator[tuple]:
    """The records of one archive file, in order, as ``RECORD`` tuples."""
    raw = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = _headers(iter(lambda: stream.readline().rstrip(b"\r\n"), b""))
        one = dict(reversed(head))
        block = stream.read(int(one["content-length"]))
        if len(block) < int(one["content-length"]):
            raise ValueError("archive ends within a record")
        kind, digest, fields = one.get("warc-type"), one.get("warc-payload-digest"), []
        payload, size = None, None
        if one.get("content-type", "").startswith("application/warc-fields"):
            fields = [{"name": n, "value": v} for n, v in _headers(block.split(b"\r\n"))]
        elif one.get("content-type", "").startswith("application/http"):
            http, _, body = block.partition(b"\r\n\r\n")
            if kind == "revisit":
                size = dict(_headers(http.split(b"\r\n"))).get("content-length")
                size = int(size) if size else None
                digest = digest.partition(":")[2] if digest else None
            elif kind == "response":
                payload, size, digest = body, len(body), hashlib.sha256(body).hexdigest()
        else:
            payload, size, digest = block, len(block), hashlib.sha256(block).hexdigest()
        yield (one.get("warc-record-id"), kind, one.get("warc-target-uri"),
               [v for n, v in head if n == "warc-concurrent-to"], one.get("warc-refers-to"), digest, size, payload, fields)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives under ``path``. The digest of a response is
    computed from the bytes read; a revisit has the one it states. Without
    ``payloads`` the bytes themselves are dropped as they are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for record in parse_archive(content.as_buffer().to_pybytes()):
                    held.append(record if payloads else (*record[:7], None, record[8]))
                    size += 300 + len(record[7] or b"") * payloads
                    if size >= FLUSH_BYTES:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def _spread(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(record_id, key) of the records that edges (record_id, to) lead from to a
    seed, over as few as possible: a round settles those one edge further on,
    the smallest key counts."""
    settled, reached = [], seeds
    while True:
        step = (salted_join(edges, reached.withColumnRenamed("record_id", "to"), ["to"], ["record_id"])
                .groupBy("record_id").agg(F.min("key").alias("key")))
        for before in settled:
            step = step.join(before, "record_id", "left_anti")
        reached = stored(step, "warc-keys")
        settled.append(reached)
        if reached.isEmpty():
            return reduce(DataFrame.unionByName, settled)


def capture_keys(links: DataFrame) -> DataFrame:
    """From stored links (record_id, anchor, concurrent_to): (record_id, key), the capture of every record but responses. A record
    that names responses belongs to the first of them, else to one that names
    it. From these on, concurrent-to is followed in both directions until
    nothing new is reached; then from ids that no record has and from records
    that name none. Records that only name one another in a circle have no row."""
    named = links.select("record_id", "anchor", F.posexplode("concurrent_to").alias("place", "to")).where("record_id <> to")
    back = named.select(F.col("to").alias("record_id"), F.col("record_id").alias("to"), "anchor")
    others = links.where("not anchor").select("record_id")
    # A name that very many records share is split by the skew join.
    direct = (named.where("not anchor").select("record_id", "place", "to")
              .join(links.where("anchor").select(F.col("record_id").alias("to")).distinct(), "to")
              .unionByName(back.where("anchor").select("record_id", F.lit(1 << 30).alias("place"), "to")))
    first = stored(direct.groupBy("record_id").agg(F.min(F.struct("place", "to")).alias("best"))
                   .select("record_id", F.col("best.to").alias("key")), "warc-keys")
    rest = stored(others.join(first, "record_id", "left_anti").distinct(), "warc-rest")
    if rest.isEmpty():
        return first
    edges = stored(named.select("record_id", "to").unionByName(back.select("record_id", "to"))
                   .join(rest, "record_id", "left_semi").distinct(), "warc-edges")
    near = _spread(first, edges)
    left = stored(rest.join(near, "record_id", "left_anti"), "warc-rest")
    if left.isEmpty():
        return first.unionByName(near)
    between = edges.join(left, "record_id", "left_semi")
    gone = between.select(F.col("to").alias("record_id")).distinct().join(links, "record_id", "left_anti")
    silent = left.join(named, "record_id", "left_anti")
    seeds = stored(gone.unionByName(silent).select("record_id", F.col("record_id").alias("key")), "warc-keys")
    far = _spread(seeds, between.join(silent, "record_id", "left_anti"))
    return reduce(DataFrame.unionByName, [first, near, seeds, far])


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id, target_uri, response (or revisit),
    requests, metadata, copies (how often the response record was found). Of a
    record without an id the first name counts."""
    keyed = records.withColumn("anchor", F.expr(f"coalesce({ANCHOR}, false)")).withColumn("key", F.coalesce(
        F.when(~F.col("anchor"), F.get("concurrent_to", F.lit(0))), "record_id"))
    # Most keys are the first name: only the other ones are joined.
    links = stored(keyed.where("record_id is not null").select("record_id", "anchor", "concurrent_to"), "warc-links")
    firsts = links.where("not anchor").select("record_id", F.coalesce(F.get("concurrent_to", F.lit(0)), "record_id").alias("key"))
    moved = stored(capture_keys(links).join(firsts, ["record_id", "key"], "left_anti")
                   .select(F.col("record_id").alias("moved_id"), F.col("key").alias("moved_key")), "warc-moved")
    led = keyed.join(moved, ~keyed["anchor"] & (keyed["record_id"] == moved["moved_id"]), "left").withColumn(
        "key", F.coalesce("moved_key", "key"))
    whole = F.struct("record_id", "type", "refers_to", "payload_digest", "payload_bytes", "payload")
    other = F.struct("record_id", "target_uri", "fields")
    return led.groupBy("key").agg(
        F.max("target_uri").alias("target_uri"), F.max(F.when(F.col("anchor"), whole)).alias("response"),
        F.array_sort(F.collect_set(F.when(F.col("type") == "request", other))).alias("requests"),
        F.array_sort(F.collect_set(F.when(F.col("type") == "metadata", other))).alias("metadata"),
        F.count(F.when(F.col("anchor"), 1)).alias("copies")).withColumnRenamed("key", "capture_id")


def page_captures(captures: DataFrame) -> DataFrame:
    """One row per page written: page_id (from the metadata record),
    payload_bytes, payload_digest, record_type, refers_to (a page_id), url."""
    stated = F.filter(F.flatten(F.transform("metadata", lambda m: m["fields"])), lambda f: f["name"] == "page_id")
    page = F.get(stated, F.lit(0))["value"]
    rows = captures.where(F.col("response").isNotNull()).select(
        "capture_id", F.when(page != "", page).cast("long").alias("page_id"), F.col("target_uri").alias("url"),
        "copies", "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("referred"))
    wanted = rows.where(F.col("referred").isNotNull()).select(F.col("referred").alias("capture_id")).distinct()
    firsts = rows.join(wanted, "capture_id").select(F.col("capture_id").alias("referred"), F.col("page_id").alias("refers_to"))
    plain = rows.where(F.col("referred").isNull()).withColumn("refers_to", F.lit(None).cast("long"))
    back = salted_join(rows.where(F.col("referred").isNotNull()), firsts, ["referred"], ["capture_id"], "left")
    return (plain.unionByName(back).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"))
