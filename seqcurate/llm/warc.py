"""WARC archives: a writer with one gzip member for each record, and a reader whose tasks own byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_folder

MAGIC = b"\x1f\x8b\x08"
#: Bytes that a reading task asks for at once.
READ = 1 << 20
#: A payload digest of more than 1 / OFTEN of the repeated rows is broadcast; there are OFTEN at most.
OFTEN = 50_000
#: Tasks that read at most.
MOST = 100_000
RECORDS = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long"


def qualified(spark: SparkSession, path: str) -> str:
    """A path as a URI with its scheme, so that every executor opens the same store."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(value: str | None) -> str:
    return " ".join((value or "").split())


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One gzip member. refers_to None: a response with the payload; else a revisit of that record, without it.
    The block of each is an HTTP response head, followed in a response by the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{_safe(page_id)}>", "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {_safe(url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Writes a record for each row and returns a row for each archive: path, n_bytes, n_records.

    Payload: the column in UTF-8, null as empty. Of rows with equal payloads of at least `least` bytes the one with the largest
    page_id is the response (all with that id, if it repeats), the others are revisits of it; a null id is the smallest.
    Equal payloads are found by digest, counted map-side first. Digests of more than 1 / OFTEN of all rows, at most OFTEN of them, come to
    their rows by broadcast, the others by a join, so a payload that a third of the rows share is one task's nowhere. Repeated rows are records
    each. Columns other than the three are left out. Each task writes a name of its own and then renames it, so a lost task leaves no half an archive.
    An empty table gives no archives or empty ones."""
    spark = pages.sparkSession
    raw = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"), raw.alias("payload")).withColumn("sha", F.sha1("payload"))
    first = rows.where(F.length("payload") >= least).groupBy("sha").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = cut(first)
    total = first.agg(F.sum("n")).first()[0] or 0
    often = first.where(F.col("n") * OFTEN > total).select(F.col("sha").alias("often"), F.col("top").alias("often_top"))
    rows = rows.join(F.broadcast(often), (F.col("sha") == F.col("often")) & (F.length("payload") >= least), "left")
    key = F.when(F.col("often").isNull() & (F.length("payload") >= least), F.col("sha")).otherwise(F.concat(F.lit("-"), F.xxhash64("id", "url").cast("string")))
    rest = first.where(F.col("n") * OFTEN <= total).select(F.col("sha").alias("key"), F.col("top").alias("rest_top"))
    rows = rows.withColumn("key", key).join(rest, "key", "left").withColumn("top", F.coalesce("often_top", "rest_top"))
    refers = F.when(F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top")), F.col("top").cast("string"))
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "payload", refers.alias("refers"))
    at = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, base = pafs.FileSystem.from_uri(at)
        fs.create_dir(base, recursive=True)
        name = f"part-{task.partitionId():06d}.warc.gz"
        temporary, final = f"{base}/_{name}.{task.taskAttemptId()}", f"{base}/{name}"
        n_bytes = n = 0
        with fs.open_output_stream(temporary) as out:
            for batch in batches:
                for i, u, p, r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    member = record(i, u, p, r)
                    out.write(member)
                    n_bytes, n = n_bytes + len(member), n + 1
        fs.move(temporary, final)
        if n:
            yield pa.RecordBatch.from_pydict({"path": [f"{at}/{name}"], "n_bytes": [n_bytes], "n_records": [n]})

    return cut(rows.mapInArrow(run, "path string, n_bytes long, n_records long"))


def _parse(member: bytes) -> dict | None:
    """Headers and payload of a record; None if it is none."""
    head, found, block = member.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        return None
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        fields[key.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = fields.get("content-length", "")
    block = block[: int(length)] if length.isdigit() else block
    http, is_http, payload = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    told = next((int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:") and x.split(b":", 1)[1].strip().isdigit()), None)
    kind = fields.get("warc-type", "")
    name = lambda key: fields.get(key, "").removeprefix("<urn:page:").removesuffix(">") or None
    if kind == "revisit":
        sha, size = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, told
    else:
        sha, size = digest(payload), len(payload)
    return {"record_id": name("warc-record-id"), "record_type": kind, "target_uri": fields.get("warc-target-uri"), "refers_to": name("warc-refers-to"), "payload_digest": sha, "payload_bytes": size, "payload": payload}


class _Window:
    """Bytes of a file from an offset on, read as they are asked for."""

    def __init__(self, file, size: int):
        self.file, self.size, self.begin, self.data = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        if not self.begin <= at <= at + n <= self.begin + len(self.data):
            self.file.seek(at)
            self.begin, self.data = at, self.file.read(max(n, READ))
        return self.data[at - self.begin : at - self.begin + n]


def members(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """The decoded members that start in [start, end) and hold a WARC record, however far they reach.

    From start on, each gzip magic is tried: it counts if the member's first bytes decode to a WARC version line. After a member the next is
    looked for from its end on, so bytes inside one are never tried, but for those of a member that began in the range before."""
    window, at = _Window(file, size), start
    while at < end:
        span = window.get(at, min(READ, end - at + len(MAGIC) - 1))
        hit = span.find(MAGIC)
        if hit < 0:
            at += max(1, len(span) - len(MAGIC) + 1)
            continue
        at += hit
        if at >= end:
            return
        unpacker, out, pos = zlib.decompressobj(31), [], at
        try:
            first = unpacker.decompress(window.get(at, min(4096, size - at)), 16)
            while len(first) < 5 and not unpacker.eof and unpacker.unconsumed_tail:
                first += unpacker.decompress(unpacker.unconsumed_tail, 16)
            if not first.startswith(b"WARC/"):
                raise zlib.error("no record")
            out.append(first + unpacker.decompress(unpacker.unconsumed_tail))
            pos = at + min(4096, size - at)
            while not unpacker.eof:
                if pos >= size:
                    raise zlib.error("cut off")
                chunk = window.get(pos, min(READ // 4, size - pos))
                out.append(unpacker.decompress(chunk))
                pos += len(chunk)
        except zlib.error:
            at += 1
            continue
        at = pos - len(unpacker.unused_data)
        yield b"".join(out)


def read_warc(archives: DataFrame, payload: bool = True, split: int = 128 << 20) -> DataFrame:
    """archives: path, n_bytes. Returns a row for each record: RECORDS, and the payload (binary, empty for revisits) if asked for.

    Every archive is cut into ranges of `split` bytes, and each range is dealt to a task (up to MOST tasks, that then have several). A record belongs to the range in which its
    member starts; digest and size of a response are those of the payload read, of a revisit those its headers tell. Members that are cut off or no records
    are passed over; empty archives give no rows."""
    ranges = archives.select("path", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(split).cast("long"))).alias("start")).where("n_bytes > 0")
    ranges = ranges.select("path", "n_bytes", "start", F.least(F.col("start") + split, F.col("n_bytes")).alias("end"))
    ranges = cut(ranges)
    # by number, as the few bytes of a range's row say nothing of the work, and would be put together in one task
    ranges = ranges.repartitionByRange(max(1, min(MOST, ranges.count())), "path", "start")
    schema = RECORDS + (", payload binary" if payload else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in names])
        for batch in batches:
            for path, size, start, end in zip(*(batch.column(n).to_pylist() for n in ("path", "n_bytes", "start", "end")), strict=True):
                fs, at = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_file(at) as file:
                    for member in members(file, size, start, end):
                        row = _parse(member)
                        if row is None:
                            continue
                        rows.append({n: row[n] for n in names})
                        held += len(row["payload"]) if payload else 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return ranges.mapInArrow(run, schema)


def round_trip(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Writes pages to archives (in a new folder of the shared one, if none is given) and reads them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    kind = dict(pages.dtypes)["page_id"]
    archives = write_warc(pages, folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}", least=least)
    back = read_warc(archives, payload=False)
    return back.select(F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
