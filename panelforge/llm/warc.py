"""Deterministic sharded WARC archives: writer, commit and reader.

Writing.  Records are cut into shards by ranges of the page id.  The cuts come
from exact byte sums over equal id blocks, not from sampling, so the same input
always gives the same files; a block of many shards' bytes is dealt over several.  Every shard is one partition, and so is its
reading.  Inside a shard records are sorted; a task streams
them into gzip members and rolls to a new file when the compressed size is
reached.  HTTP headers, WARC headers and digests are regenerated.

Commit.  Task attempts write under temporary names of their own and return
manifest rows.  Spark's own commit decides which attempt's rows count; only
files in the manifest are renamed, and renaming again after a lost executor
finds the file in place.  Leftovers of failed attempts stay under ``_temporary``
and are never read.

Of equal payloads of at least 100 bytes the one with the smallest page id is
written in full, the others as revisits.  The verdicts travel to the sorted
records as rows of their own, so the payloads are shuffled once and a payload
that a third of the pages share is aggregated before its shuffle.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.session import scratch_dir

from .common import Scratch, pick

MIN_REVISIT_BYTES = 100
ROLL_BYTES = 64 << 20        # compressed size at which a file is closed
SHARD_BYTES = 128 << 20      # payload bytes aimed at per shard
ID_BLOCKS = 1 << 17          # id ranges whose sizes the driver sees
LARGEST_BLOCK = 8            # shard sizes that one id block may fill before it is dealt out
RECORD_DATE = "2000-01-01T00:00:00Z"  # pages carry no fetch time
_CHUNK = 1 << 20
_LEVEL = 6

MANIFEST = "shard long, part long, temporary string, name string, records long, bytes long, sha256 string"
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, intact boolean, payload binary")


# Schemes that Hadoop knows, by the names of the file systems that write them here.
_SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs",
            "abfs": "abfs", "abfss": "abfss", "wasb": "abfs", "wasbs": "abfss"}


def archive_uri(path: str) -> str:
    """The path as the file-system library names it; raises for a scheme that it cannot write."""
    scheme, colon, rest = path.partition(":")
    if path.startswith("/") or not colon or "/" in scheme:
        return path
    if scheme.lower() not in _SCHEMES:
        raise ValueError(f"archives cannot be written to {scheme}: paths; known are {sorted(_SCHEMES)}")
    return f"{_SCHEMES[scheme.lower()]}:{rest}"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    uri = archive_uri(path)
    return (pafs.LocalFileSystem(), uri) if uri == path and ":" not in path.split("/")[0] else pafs.FileSystem.from_uri(uri)


def record_uri(page_id: int | None, digest: str, repeat: int) -> str:
    """Record ids are derived, so that they are the same in every run."""
    return f"urn:page:{'' if page_id is None else page_id}:{digest[:16]}:{repeat}"


def _page_of(uri: str) -> int | None:
    number = uri.strip("<>").split(":")[2]
    return int(number) if number else None


def make_record(page_id: int | None, url: str, payload: bytes | None, digest: str, size: int,
                repeat: int, refers_to: tuple[int, int] | None) -> bytes:
    """One WARC record: response with payload, or revisit (page id, repeat) without."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http + (payload or b"") if refers_to is None else http
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_uri(page_id, digest, repeat)}>"),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", " ".join(url.split())),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", f"<{record_uri(refers_to[0], digest, refers_to[1])}>")]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class _Roller:
    """Streams gzip members into files of bounded compressed size under temporary names."""

    def __init__(self, root: str, roll_bytes: int):
        self.fs, self.root = _filesystem(root)
        self.roll, self.attempt = roll_bytes, uuid.uuid4().hex
        self.shard, self.part, self.file, self.rows = None, 0, None, []

    def write(self, shard: int, record: bytes) -> None:
        if self.file is not None and (shard != self.shard or self.size >= self.roll):
            self.close()
        if self.file is None:
            self.part = self.part + 1 if shard == self.shard else 0
            self.shard, self.size, self.count = shard, 0, 0
            self.temporary = f"_temporary/{self.attempt}-{shard:08d}-{self.part:05d}.warc.gz"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.file = self.fs.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self.sha = hashlib.sha256()
        member = gzip.compress(record, _LEVEL, mtime=0)
        self.file.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.count += 1

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None
            self.rows.append({"shard": self.shard, "part": self.part, "temporary": self.temporary,
                              "name": f"pages-{self.shard:08d}-{self.part:05d}.warc.gz",
                              "records": self.count, "bytes": self.size, "sha256": self.sha.hexdigest()})


def _sharded(pages: DataFrame, shard_bytes: int) -> tuple[Column, int]:
    """The shard of a page, cut at exact sums of payload bytes, and the shard count.

    Shards are ranges of ids, whole id blocks each.  A block of more than
    ``LARGEST_BLOCK`` shards' bytes (a hot id, or ids crowded far from others) is
    dealt over several by the payloads' digests, so that records of one id and
    payload stay together; so are the pages without an id, from shard 0 on.
    """
    low, high = pages.agg(F.min("page_id"), F.max("page_id")).first()
    bits = 0  # an id block is 2 ** bits ids
    while low is not None and (high >> bits) - (low >> bits) >= ID_BLOCKS:
        bits += 1
    block = (F.shiftright("page_id", bits) - ((low or 0) >> bits)).cast("int")
    sizes = dict(pages.groupBy(block.alias("block")).agg(F.sum("payload_bytes")).collect())  # at most one row per block
    nameless = max(1, -(-sizes.pop(None, 0) // shard_bytes))
    starts, counts, shard, size = [], [], 0, 0  # by block number
    for number in range(max(sizes, default=-1) + 1):
        more = sizes.get(number, 0)
        if size and size + more > shard_bytes:
            shard, size = shard + 1, 0
        starts.append(shard)
        counts.append(-(-more // shard_bytes) if more > LARGEST_BLOCK * shard_bytes else 1)
        shard, size = shard + counts[-1] - 1, size + more

    def dealt(count: Column) -> Column:
        return F.pmod(F.xxhash64("digest"), count).cast("int")

    def of_block(values: list[int]) -> Column:
        return F.get(F.from_json(F.lit(str(values)), "array<int>"), block)  # a constant, so it is parsed once

    place = of_block(starts)
    if max(counts, default=1) > 1:
        place = place + F.when(of_block(counts) > 1, dealt(of_block(counts))).otherwise(0)
    return F.coalesce(place, dealt(F.lit(nameless)) if nameless > 1 else F.lit(0)), max(shard + 1, nameless)


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", shard_bytes: int = SHARD_BYTES,
                   roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write a WARC record per row of ``pages`` below ``root``; returns the committed manifest.

    A null payload is empty, a null url is written as an empty one.  Rows that
    repeat a page id get record ids that differ in a running number; of several
    with one payload of at least 100 bytes the first is written in full.  A
    null page id sorts first and counts as larger than every id when a payload's
    response is chosen.  Records of one id and payload lie in one shard, all
    others are spread.  Malformed UTF-8 is written as it is.  Other columns are
    ignored; an empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    archive_uri(root)  # raises before any work
    rows = pick(pages, page_id=id_col, url=url_col, payload=payload_col).select(
        F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("payload").cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "payload_bytes": F.length("payload").cast("long")})
    scratch = Scratch(spark, "warc")
    slim = scratch.table(rows.select("page_id", "digest", "payload_bytes"), "digests")
    shard, n_shards = _sharded(slim, shard_bytes)

    # The page that holds each repeated payload, and a verdict row for every other page.
    holders = (slim.filter(F.col("payload_bytes") >= MIN_REVISIT_BYTES).groupBy("digest")
               .agg(F.min("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    holders = scratch.table(holders.select("digest", "holder"), "holders")
    verdicts = (slim.join(holders, "digest").select("page_id", "digest", "holder").distinct()
                .select("page_id", F.lit("").alias("url"), F.lit(None).cast("binary").alias("payload"),
                        "digest", F.lit(0).cast("long").alias("payload_bytes"), "holder",
                        F.lit(0).alias("kind")))
    records = rows.withColumns({"holder": F.lit(None).cast("long"), "kind": F.lit(1)})
    both = verdicts.unionByName(records).withColumn("shard", shard)
    both = both.repartitionById(n_shards, "shard").sortWithinPartitions(
        "shard", "page_id", "digest", "kind", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Roller(root, roll_bytes)
        key, repeat, holder, shared = None, 0, None, False
        for batch in batches:
            for row in _rows(batch):
                if key != (row["shard"], row["page_id"], row["digest"]):
                    key, repeat, shared = (row["shard"], row["page_id"], row["digest"]), 0, False
                if row["kind"] == 0:
                    shared, holder = True, row["holder"]
                    continue
                # the holder's first record is the response; the others refer to it
                first = shared and row["page_id"] == holder and repeat == 0
                refers = (holder, 0) if shared and not first else None
                out.write(row["shard"], make_record(row["page_id"], row["url"], row["payload"], row["digest"],
                                                    row["payload_bytes"], repeat, refers))
                repeat += 1
        out.close()
        yield pa.RecordBatch.from_pylist(out.rows, schema=_MANIFEST_ARROW)

    manifest = both.select("shard", "page_id", "url", "digest", "payload_bytes", "kind", "holder", "payload") \
        .mapInArrow(write, MANIFEST)
    path = f"{root}/_manifest"
    manifest.write.parquet(path)
    committed = spark.read.schema(MANIFEST).parquet(path)
    _commit(committed, root)
    return committed


_MANIFEST_ARROW = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("temporary", pa.string()),
                             ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()),
                             ("sha256", pa.string())])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one: a batch of large payloads is not turned into Python objects at once."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        yield {n: c[i].as_py() for n, c in zip(names, batch.columns)}


def _commit(manifest: DataFrame, root: str) -> None:
    """Rename the manifest's files; a file that already has its final name stays."""
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(root)
        for batch in batches:
            for row in batch.to_pylist():
                final = fs.get_file_info(f"{base}/{row['name']}")
                if final.type == pafs.FileType.NotFound:
                    fs.move(f"{base}/{row['temporary']}", f"{base}/{row['name']}")
                elif final.size != row["bytes"]:
                    raise OSError(f"{row['name']} is not the file of the manifest")
                yield pa.RecordBatch.from_pylist([{"name": row["name"]}], pa.schema([("name", pa.string())]))

    manifest.mapInArrow(rename, "name string").write.format("noop").mode("overwrite").save()


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a gzip-per-record archive, read in pieces."""
    with gzip.GzipFile(fileobj=stream) as f:
        text = io.BufferedReader(f, _CHUNK)
        while line := text.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            headers = {}
            while (line := text.readline()).strip():
                name, _, value = line.decode().partition(":")
                headers[name.strip().lower()] = value.strip()
            yield headers, text.read(int(headers["content-length"]))


def read_archives(manifest: DataFrame, root: str, payloads: bool = False) -> DataFrame:
    """One row per record of the manifest's files.

    ``payload_digest`` is computed from the payload of a response and taken from
    the header of a revisit; ``payload_bytes`` is the full payload's length for
    both; ``intact`` tells whether digests and lengths agree with the headers.
    ``payload`` is null for revisits and unless ``payloads`` is set.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(root)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    rows, size = [], 0
                    for headers, block in parse_records(stream):
                        rows.append(_parsed(headers, block, payloads))
                        size += len(block) if payloads else 0
                        if len(rows) >= 1000 or size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _RECORDS_ARROW)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, _RECORDS_ARROW)

    n_shards = (manifest.agg(F.max("shard")).first()[0] or 0) + 1
    files = manifest.select("name", F.col("shard").cast("int").alias("shard"))
    return files.repartitionById(n_shards, "shard").select("name").mapInArrow(read, RECORDS)


_RECORDS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("intact", pa.bool_()), ("payload", pa.binary())])


def _parsed(headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in head.split(b"\r\n")
                  if line.lower().startswith(b"content-length:"))
    kind, stated = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else stated
    block_ok = headers["warc-block-digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}"
    return {"page_id": _page_of(headers["warc-record-id"]), "url": headers["warc-target-uri"],
            "payload_bytes": len(payload) if kind == "response" else length, "payload_digest": digest,
            "record_type": kind,
            "refers_to": _page_of(headers["warc-refers-to"]) if kind == "revisit" else None,
            "intact": block_ok and digest == stated and (kind == "revisit" or len(payload) == length),
            "payload": payload if payloads and kind == "response" else None}


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` below the shared checkpoint folder and read the archives back."""
    root = scratch_dir(spark, "archives")
    return read_archives(write_archives(pages, root), root).drop("payload")
