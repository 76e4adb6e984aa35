"""op10: WARC archives, written by tasks and read back by boundary-chain verification.

Writing.  A row becomes one record; of rows with equal payloads only the one with the smallest
id is a ``response``, the others are ``revisit`` records that refer to it and hold no payload.
Spark's text writer joins records to files (one a task), on any file system Spark can write.

Reading.  Archives are cut into byte ranges, and a record may start anywhere, so a task that
looks for the record magic also finds it inside payloads.

1. Each range emits its candidates: offsets with the magic and a complete header, each with
   the offset where the chain of its successors leaves the range.  A chain can only enter a
   range where a chain leaves another one (or at the file's start), so one semi-join keeps the
   few candidates that matter to the next step.
2. From the start of each file, pointer jumping keeps the links that are reached: every round
   doubles the hops, so a file of R ranges takes log2(R) rounds of joins.  What starts inside a
   payload is never reached, even if its false chain runs into a true record.
3. Ranges are read again from their true first record; records are parsed, and payload length
   and digest are computed and compared with the header.

A file that ends in the middle of a record raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm.common import broadcast_below, materialize, shared_folder, ship, table

VERSION, DATE = "WARC/1.1", "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RANGE_BYTES, BLOCK_BYTES = 8 << 20, 1 << 20
MAGIC = f"{VERSION}\r\nWARC-Type: ".encode()
_HEX32, _BASE32 = "0123456789abcdefghijklmnopqrstuv", "abcdefghijklmnopqrstuvwxyz234567"


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's UTF-8 bytes, from 40-bit groups."""
    sha = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.lower(F.conv(F.substring(sha, 1 + 10 * i, 10), 16, 32)), 8, "0") for i in range(4)]
    return F.upper(F.translate(F.concat(*groups), _HEX32, _BASE32))


def _safe(value: Column) -> Column:
    """A header value: control characters and per cent signs escaped, so it stays on its line."""
    out = F.replace(F.coalesce(value, F.lit("")), F.lit("%"), F.lit("%25"))
    for c in range(0x20):
        out = F.replace(out, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return out


def with_revisits(df: DataFrame, id_col: str, payload: Column, least_bytes: int, names: tuple[str, str, str]) -> DataFrame:
    """``df`` with digest, payload bytes and the id that the record refers to (null: a response).

    Groups of one payload are found by map-side combined minima of (digest, length); only
    groups of several rows meet ``df`` again, by broadcast if their number allows it.
    """
    digest, size, refers = names
    rows = df.withColumn(digest, payload_digest(payload)).withColumn(size, F.octet_length(payload).cast("long"))
    groups = materialize(rows.where(F.col(size) >= least_bytes).groupBy(F.col(digest).alias("g_digest"), F.col(size).alias("g_size")).agg(
        F.min(id_col).alias("g_first"), F.count(F.lit(1)).alias("g_rows")).where("g_rows > 1 and g_first is not null"), "warc-groups")
    joined = rows.join(broadcast_below(groups), (F.col(digest) == F.col("g_digest")) & (F.col(size) == F.col("g_size")), "left")
    other = F.col("g_first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("g_first"))
    return joined.withColumn(refers, F.when(other, F.col("g_first"))).drop("g_digest", "g_size", "g_first", "g_rows")


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   least_bytes: int = 0) -> None:
    """One record a row into text files of ``folder``; see ``with_revisits`` for the types.

    A null payload is empty, a null url an empty header.  Rows of a null id are responses
    unless a row with an id has their payload.  Repeated rows of the smallest id are all responses.
    """
    source = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = with_revisits(source, "id", F.col("payload"), least_bytes, ("digest", "bytes", "refers"))
    revisit = F.col("refers").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    none = F.lit("")
    record = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), none), F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", _safe(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                 line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers").cast("string"), F.lit(">"))),
                                 line("X-Payload-Length", F.col("bytes").cast("string")))).otherwise(none),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, "0").otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"), F.when(revisit, none).otherwise(F.col("payload")), F.lit("\r\n"))
    # the writer ends each row with a line end: the second one after a record
    rows.select(record.alias("value")).write.option("lineSep", "\r\n").text(folder)


def _open(path: str):
    from pyarrow import fs
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


class _Window:
    """Bytes of a file from any offset, read in blocks."""

    def __init__(self, path: str, block: int = BLOCK_BYTES):
        self.file, self.block = _open(path), block
        self.size = self.file.size()
        self.at, self.data = 0, b""

    def fill(self, start: int, end: int) -> None:
        """Make [start, end) of the file, as far as it goes, part of the window."""
        end = min(end, self.size)
        if start < self.at or end > self.at + len(self.data):
            self.at, self.data = start, self.file.read_at(max(end - start, min(self.block, self.size - start)), start)

    def get(self, start: int, end: int) -> bytes:
        self.fill(start, end)
        return self.data[start - self.at:end - self.at]

    def find(self, what: bytes, start: int, end: int) -> int:
        """First offset in [start, end) at which ``what`` stands, or -1."""
        while start < end:
            self.fill(start, start + len(what))
            hit = self.data.find(what, start - self.at)
            if hit >= 0:
                return self.at + hit if self.at + hit < end else -1
            nearest = self.at + len(self.data) - len(what) + 1
            if self.at + len(self.data) >= self.size:
                return -1
            start = max(start + 1, nearest)
        return -1


def header_at(window: _Window, at: int, end_of_file: int) -> tuple[dict, int] | None:
    """Header fields and payload offset of the record at ``at``; None if there is none."""
    if window.get(at, at + len(MAGIC)) != MAGIC:
        return None
    stop = window.find(b"\r\n\r\n", at, end_of_file)
    if stop < 0:
        return None
    head = {}
    for line in window.get(at, stop).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        head[name.strip().lower()] = value.strip()
    if not head.get(b"content-length", b"").isdigit():
        return None
    return head, stop + 4


def successor(head: dict, payload_at: int) -> int:
    return payload_at + int(head[b"content-length"]) + 4


def range_links(path: str, start: int, end: int) -> list[tuple[int, int]]:
    """(candidate, offset where its chain leaves the range) for all candidates in [start, end)."""
    window = _Window(path)
    following: dict[int, int] = {}
    at = window.find(MAGIC, start, end)
    while at >= 0:
        found = header_at(window, at, window.size)
        if found and successor(*found) <= window.size:
            following[at] = successor(*found)
        at = window.find(MAGIC, at + 1, end)
    leaves: dict[int, int] = {}
    for at in sorted(following, reverse=True):
        leaves[at] = leaves.get(following[at], following[at])
    return list(leaves.items())


def read_records(path: str, start: int, end: int) -> Iterator[tuple]:
    """Records of the chain that enters [start, end) at ``start``, digests checked."""
    window = _Window(path)
    at = start
    while at < end:
        found = header_at(window, at, window.size)
        if not found:
            raise ValueError(f"no record at byte {at} of {path}")
        head, payload_at = found
        length = int(head[b"content-length"])
        sha = hashlib.sha1()
        for a in range(payload_at, payload_at + length, BLOCK_BYTES):
            sha.update(window.get(a, min(a + BLOCK_BYTES, payload_at + length)))
        digest = head.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:")
        kind = head[b"warc-type"].decode()
        if kind == "response" and base64.b32encode(sha.digest()).decode() != digest:
            raise ValueError(f"payload digest of the record at byte {at} of {path} is wrong")
        target = head.get(b"warc-refers-to", b"").decode().removeprefix("<urn:page:").removesuffix(">")
        record = head.get(b"warc-record-id", b"").decode().removeprefix("<urn:page:").removesuffix(">")
        size = int(head[b"x-payload-length"]) if kind == "revisit" else length
        yield record or None, head.get(b"warc-target-uri", b"").decode(), size, digest, kind, target or None, path, at, payload_at, length
        at = successor(head, payload_at)


RECORDS = ("record_id string, target_uri string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to string, path string, record_at long, payload_at long, content_length long")


def read_archives(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row for each record of the archives in ``folder`` that its file's chain reaches."""
    ship(spark)
    files = spark.read.format("binaryFile").load(folder).select("path", "length").where("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = materialize(ranges.withColumn("end", F.least("length", F.col("start") + range_bytes)), "warc-ranges")
    tasks = ranges.repartition("path", "start")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                links = range_links(r["path"], r["start"], r["end"])
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([r["path"]] * len(links), pa.string()), "start": pa.array([r["start"]] * len(links), pa.int64()),
                    "entry": pa.array([a for a, _ in links], pa.int64()), "leave": pa.array([b for _, b in links], pa.int64())})

    found = materialize(tasks.mapInArrow(scan, "path string, start long, entry long, leave long"), "warc-candidates")
    doors = found.select("path", F.col("leave").alias("entry")).unionByName(files.select("path", F.lit(0).cast("long").alias("entry")))
    links = materialize(found.join(doors.distinct(), ["path", "entry"], "left_semi"), "warc-links")
    jumps = links.select("path", "entry", "leave")
    reached = files.select("path", F.lit(0).cast("long").alias("entry"))
    reached = materialize(reached.join(jumps, ["path", "entry"], "left_semi"), "warc-reached")
    known = reached.count()
    while known:  # each round doubles the hops
        step = reached.join(jumps, ["path", "entry"]).select("path", F.col("leave").alias("entry"))
        step = step.join(links, ["path", "entry"], "left_semi")
        reached = materialize(reached.unionByName(step).distinct(), "warc-reached")
        if (now := reached.count()) == known:
            break
        known = now
        far = jumps.select("path", F.col("entry").alias("leave"), F.col("leave").alias("far"))
        jumps = materialize(jumps.join(far, ["path", "leave"]).select("path", "entry", F.col("far").alias("leave")), "warc-jumps")
    # a file whose chain does not end where it does is cut or damaged
    true = links.join(reached, ["path", "entry"], "left_semi")
    ends = files.join(true.groupBy("path").agg(F.max("leave").alias("leave")), "path", "left").where(
        ~F.col("leave").eqNullSafe(F.col("length"))).limit(1).collect()
    if ends:
        raise ValueError(f"the records of {ends[0].path} end at byte {ends[0].leave} of {ends[0].length}")
    entries = true.join(ranges.select("path", "start", "end"), ["path", "start"]).repartition("path", "start")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        kinds = [pa.int64() if f.endswith("long") else pa.string() for f in RECORDS.split(", ")]
        for batch in batches:
            for r in batch.to_pylist():
                held = []
                for record in read_records(r["path"], r["entry"], r["end"]):
                    held.append(record)
                    if len(held) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    return entries.select("path", "entry", "end").mapInArrow(parse, RECORDS)


def op10_warc_round_trip(spark, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC records and read back from the archives."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = f"{shared_folder(spark)}/riskmart-warc-{uuid.uuid4().hex}"
    write_archives(pages, folder)
    return read_archives(spark, folder).select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1) FOR i IN range(32)],
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM h
"""
