"""WARC archives: a deterministic sharded writer, and a reader.

Records are dealt into shards, stretches of page_id of about ``shard_bytes`` of payload, whose
bounds are exact sums over ranges of ids; a range with more than that, as of pages without id,
is cut by digest. A task writes each shard, sorted, into files of its own and starts a new file
where the compressed size would pass ``roll_bytes``. Headers, record ids and digests are made
from the record alone, and each record is a gzip member without a time, so the same pages give
the same files, however they are partitioned. A file is written under a temporary name that
holds the task attempt and renamed when it is complete; a task that runs again leaves a file
that is there. The manifest lists the complete files with size and digest. It is written last,
and the reader takes only what it lists, so an interrupted write leaves nothing that counts.

Of records with equal payloads of at least ``min_bytes``, that with the smallest page_id is a
response and the others are revisits that refer to it.

Defined results: null html is an empty payload, a null url leaves out the target. Of rows with
the same page_id and payload the first is the response and the rest revisit it. Rows without
page_id come first and revisit a page with id if its payload is equal; among themselves the
first is the response, without an id to refer to. Control characters and spaces in urls are percent-encoded.
Without pages there are no files. Other columns are not read. A very long page is one record.

Folders can be local, or of any kind that pyarrow.fs opens by address.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals_engine.llm.common import Scratch, partitions

MANIFEST = "file string, records long, bytes long, sha256 string"
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)
#: Fixed value: the profile that names revisits of an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}/{digest}/{copy}')}>"


def _encoded(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def page_record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, copy: int, revisit: bool
) -> bytes:
    """copy: how many records of this page_id and payload came before."""
    digest = base32_sha1(payload)
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, copy)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else _encoded(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest, 0) if revisit else None),
        ("X-Page-Id", page_id),
        ("X-Refers-To-Page-Id", refers_to if revisit else None),
        ("X-Payload-Length", len(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _record(headers, http if revisit else http + payload)


class _Files:
    """The files of one shard."""

    def __init__(self, folder: str, shard: int, attempt: int, roll_bytes: int):
        from pyarrow import fs

        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.shard, self.attempt, self.roll_bytes = shard, attempt, roll_bytes
        self.out, self.number = None, 0

    def add(self, record: bytes) -> Iterator[tuple]:
        """Yields the manifest row of a file that this record has no room in."""
        member = _member(record)
        if self.out and self.size + len(member) > self.roll_bytes:
            yield self.close()
        if not self.out:
            self.name = f"part-{self.shard:05d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary/{self.name}.{self.attempt}"
            self.fs.create_dir(f"{self.folder}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
            info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.name, 0))]
            self._write(_member(_record([*info, ("WARC-Date", DATE), ("WARC-Filename", self.name)], b"")))
        self._write(member)
        self.records += 1

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> tuple:
        from pyarrow import fs

        self.out.close()
        final = f"{self.folder}/{self.name}"
        if self.fs.get_file_info(final).type == fs.FileType.NotFound:
            self.fs.move(self.temporary, final)
        else:  # of an attempt before, with the same bytes
            self.fs.delete_file(self.temporary)
        self.out, self.number = None, self.number + 1
        return self.name, self.records, self.size, self.sha.hexdigest()


#: Ids are counted in ranges of so many; digests are cut into so many places.
RANGE, PLACES = 4096, 1 << 16
#: So many ranges are broadcast; with more, their shards are joined.
MOST_RANGES = 500_000


def _in_shards(rows: DataFrame, shard_bytes: int | None, roll_bytes: int, scratch: Scratch) -> DataFrame:
    """rows (page_id, sha1, payload) with the number of their shard. Without shard_bytes a shard
    has a 512th of all bytes, but at least 4 MB and at most four times roll_bytes."""
    of_range = F.floor(F.col("page_id") / RANGE)
    place = F.conv(F.substring("sha1", 1, 4), 16, 10).cast("long")
    sizes = scratch.put(
        rows.groupBy(of_range.alias("range")).agg(F.sum(F.octet_length("payload")).alias("size")),
        "sizes",
    )
    n, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    each = shard_bytes or max(4 << 20, min(4 * roll_bytes, total // 512))
    # One row per range of ids goes through the window.
    upto = F.sum("size").over(Window.orderBy(F.col("range").asc_nulls_first()))
    shards = sizes.select(
        "range",
        F.floor((upto - F.col("size")) / each).alias("first_shard"),
        F.greatest(F.lit(1), F.ceil(F.col("size") / each)).alias("cuts"),
    )
    keyed = rows.withColumns({"range": of_range, "place": place})
    shards = F.broadcast(shards) if n <= MOST_RANGES else shards
    cut = F.floor(F.col("place") * F.col("cuts") / PLACES)
    same = keyed["range"].eqNullSafe(shards["range"])
    return keyed.join(shards, same).select(
        *(keyed[c] for c in rows.columns), (F.col("first_shard") + cut).alias("shard")
    )


def write(
    pages: DataFrame,
    folder: str,
    *,
    min_bytes: int = 0,
    roll_bytes: int = 64 << 20,
    shard_bytes: int | None = None,
) -> DataFrame:
    """Writes the archives and their manifest into a new folder; returns the manifest."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    scratch = Scratch(spark, "warc")
    first = scratch.put(
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("sha1", "first_id", F.lit(True).alias("several")),
        "first",
    )
    ordered = (
        _in_shards(rows, shard_bytes, roll_bytes, scratch)
        .join(first, "sha1", "left")
        .repartition(partitions(spark), "shard")
        .sortWithinPartitions("shard", "page_id", "sha1", "url")
    )

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        attempt, files = TaskContext.get().taskAttemptId(), None
        before, copy, done = None, 0, []
        for batch in batches:
            for shard, page_id, url, payload, sha1, first_id, several in batch[
                ["shard", "page_id", "url", "payload", "sha1", "first_id", "several"]
            ].itertuples(index=False):
                if files is None or files.shard != shard:
                    if files:
                        done.append(files.close())
                    files = _Files(folder, int(shard), attempt, roll_bytes)
                page_id, first_id = (None if pd.isna(x) else int(x) for x in (page_id, first_id))
                copy = copy + 1 if before == (page_id, sha1) else 0
                before = (page_id, sha1)
                revisit = several is True and (copy > 0 or page_id != first_id)
                record = page_record(page_id, url, bytes(payload), first_id, copy, revisit)
                done.extend(files.add(record))
            yield pd.DataFrame(done, columns=["file", "records", "bytes", "sha256"])
            done = []
        if files:
            yield pd.DataFrame([files.close()], columns=["file", "records", "bytes", "sha256"])

    ids = ordered.withColumns({c: F.col(c).cast("string") for c in ("page_id", "first_id")})
    ids.mapInPandas(save, MANIFEST).write.parquet(f"{folder.rstrip('/')}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")


def _members(stream, block: int = 1 << 20) -> Iterator[bytes]:
    """The content of one gzip member after the other."""
    data, unpacker, parts = b"", None, []
    while True:
        data = data or stream.read(block)
        if not data:
            if unpacker:
                raise ValueError("the archive ends inside a record")
            return
        unpacker = unpacker or zlib.decompressobj(31)
        parts.append(unpacker.decompress(data))
        data = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts = None, []


def parsed(record: bytes) -> tuple | None:
    """The columns of ``RECORD``, or None for what is no page."""
    head, _, block = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    h = dict(line.split(": ", 1) for line in lines)
    if h["WARC-Type"] not in ("response", "revisit"):
        return None
    block = block[: int(h["Content-Length"])]
    if f"sha1:{base32_sha1(block)}" != h["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {h['WARC-Record-ID']}")
    number = lambda k: int(h[k]) if k in h else None
    digest, size, payload = h["WARC-Payload-Digest"].removeprefix("sha1:"), number("X-Payload-Length"), None
    if h["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        digest, size = base32_sha1(payload), len(payload)
    refers_to = number("X-Refers-To-Page-Id")
    return number("X-Page-Id"), h.get("WARC-Target-URI"), size, digest, h["WARC-Type"], refers_to, payload


def read(spark: SparkSession, folder: str, *, with_payload: bool = True, rows_at_once: int = 500) -> DataFrame:
    """The records of the files in the manifest, checked against their digests. Tasks get whole
    files, which roll_bytes bounds. Revisits have no payload of their own."""
    names = [c.split()[0] for c in RECORD.split(", ")]

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["file"]:
                rows = []
                with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for record in _members(stream):
                        if row := parsed(record):
                            rows.append(row if with_payload else (*row[:-1], None))
                        if len(rows) == rows_at_once:
                            yield _frame(rows, names)
                            rows = []
                yield _frame(rows, names)

    listed = manifest(spark, folder).select("file").repartition(partitions(spark), "file")
    return listed.mapInPandas(load, RECORD)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to")})
