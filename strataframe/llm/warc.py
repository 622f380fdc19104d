"""WARC archives: a deterministic sharded writer and a reader.

Records are sorted by page id into shards of whole id ranges, each shard rolls to the next file by compressed size,
and nothing counts until the manifest is in place: tasks write under temporary names that only their own attempt
knows, a second job renames what the surviving attempts reported, and the manifest's rename commits the lot.
Payloads cross the network once; which records revisit others is found on digests and joins the sorted stream as
note rows, so no join carries a payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.common import materialize, range_of, remove, small_batches

MANIFEST = "name string, temp string, shard int, seq int, records long, compressed_bytes long, sha256 string, first_page_id long, last_page_id long"
RECORDS = "archive string, page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record_id(page_id: int | None, url: str | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(repr((page_id, url, digest, copy)).encode()).digest()[:16], version=5)}>"


def _uri(url: str | None, page_id: int | None) -> str:
    shown = url if url else f"urn:page:{'' if page_id is None else page_id}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in shown)


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as a gzip member of its own; the same input gives the same bytes."""
    headers = [*headers, ("WARC-Block-Digest", f"sha1:{_base32(hashlib.sha1(block).digest())}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def _page_record(page_id: int | None, url: str | None, payload: bytes, copy: int, first: tuple | None) -> bytes:
    """first: page id and url of the response that this record revisits, or None for a response."""
    raw = hashlib.sha1(payload)
    digest = _base32(raw.digest())
    headers = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", _record_id(page_id, url, digest, copy)), ("WARC-Target-URI", _uri(url, page_id)), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if first is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(first[0], first[1], digest, 0)), ("WARC-Refers-To-Target-URI", _uri(first[1], first[0])), ("WARC-Refers-To-Date", DATE)]
        if first[0] is not None:
            headers.append(("X-Refers-To-Page-Id", str(first[0])))
    return _record(headers, _http(len(payload)) + (payload if first is None else b""))


class _Shard:
    """The open file of one shard."""

    def __init__(self, fs: pafs.FileSystem, root: str, roll_bytes: int, shard: int):
        self.fs, self.root, self.roll_bytes, self.shard, self.seq, self.out = fs, root, roll_bytes, shard, 0, None

    def add(self, page_id: int | None, data: bytes) -> dict | None:
        """Appends a record; the manifest row of the file that it closed, if any."""
        done = None
        if self.out is not None and self.size >= self.roll_bytes:
            done = self.close()
            self.seq += 1
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.seq:04d}.warc.gz"
            self.temp = f"_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(f"{self.root}/{self.temp}")
            self.sha, self.size, self.records, self.first = hashlib.sha256(), 0, 0, page_id
            info = f"format: WARC File Format 1.1\r\nshard: {self.shard}\r\nfile: {self.seq}\r\n".encode()
            self._write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None, self.name, "", 0)), ("WARC-Filename", self.name), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], info))
        self._write(data)
        self.records, self.last = self.records + 1, page_id
        return done

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> dict:
        self.out.close()
        self.out = None
        return {"name": self.name, "temp": self.temp, "shard": self.shard, "seq": self.seq, "records": self.records, "compressed_bytes": self.size, "sha256": self.sha.hexdigest(), "first_page_id": self.first, "last_page_id": self.last}


def _writer(out_dir: str, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(out_dir)
        fs.create_dir(f"{root}/_temporary", recursive=True)
        done: list[dict] = []
        at: _Shard | None = None
        key, copy, first = None, 0, None
        for batch in batches:
            cols = [batch.column(c) for c in ("shard", "page_id", "url", "digest", "payload", "first_id", "first_url", "note")]
            for i in range(batch.num_rows):
                shard, page_id, url, digest, payload, first_id, first_url, note = (c[i].as_py() for c in cols)
                if at is None or at.shard != shard:
                    if at is not None:
                        done.append(at.close())
                    at = _Shard(fs, root, roll_bytes, shard)
                here = (page_id, url, digest)
                if here != key:
                    key, copy, first = here, 0, None
                if note:
                    first = (first_id, first_url)
                    continue
                revisits = first is not None and (copy > 0 or first != (page_id, url))
                if closed := at.add(page_id, _page_record(page_id, url, payload, copy, first if revisits else None)):
                    done.append(closed)
                copy += 1
        if at is not None:
            done.append(at.close())
        yield pa.RecordBatch.from_pylist(done, schema=_MANIFEST_ARROW)

    return write


_MANIFEST_ARROW = pa.schema([("name", pa.string()), ("temp", pa.string()), ("shard", pa.int32()), ("seq", pa.int32()), ("records", pa.int64()), ("compressed_bytes", pa.int64()), ("sha256", pa.string()), ("first_page_id", pa.int64()), ("last_page_id", pa.int64())])


def _committer(out_dir: str):
    def commit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(out_dir)
        for frame in frames:
            for name, temp in zip(frame["name"], frame["temp"], strict=True):
                if fs.get_file_info(f"{root}/{temp}").type == pafs.FileType.File:
                    fs.move(f"{root}/{temp}", f"{root}/{name}")
                elif fs.get_file_info(f"{root}/{name}").type != pafs.FileType.File:  # an earlier attempt may have moved it
                    raise FileNotFoundError(f"{root}/{temp}")
            yield frame[["name"]]

    return commit


def shard_size(total: int, least: int = 32 << 20) -> int:
    """Payload bytes a shard: least, or from 100 GB on as the square root of the total, so that shards and their number grow alike."""
    return max(least, isqrt(total * 10_000))


def _shard_cuts(rows: DataFrame, shard_bytes: int | None, sample: int = 20_000) -> tuple[list[int], int]:
    """(largest page ids of all shards but the last, bytes a shard), from a sample by hash of about so many ids, or 20 a shard."""
    n, total = rows.agg(F.count("page_id"), F.sum("n")).first()
    size = shard_bytes or shard_size(total or 0)
    shards = -(-(total or 0) // size)
    if not n or shards < 2:
        return [], size
    draw = F.pmod(F.xxhash64("page_id"), F.lit(max(1, n // max(sample, 20 * shards)))) == 0
    drawn = rows.where(draw).where("page_id IS NOT NULL").groupBy("page_id").agg(F.sum(F.col("n") + 500).alias("w")).toArrow().sort_by("page_id")
    if not len(drawn):
        return [], size
    ids, weight = drawn["page_id"].to_numpy(), np.cumsum(drawn["w"].to_numpy())
    return np.unique(ids[np.searchsorted(weight, weight[-1] * np.arange(1, shards) / shards)]).tolist(), size


def write_archives(pages: DataFrame, out_dir: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", dedup_min_bytes: int = 0, roll_bytes: int | None = None, shard_bytes: int | None = None) -> DataFrame:
    """Writes one record a row into out_dir and returns the committed manifest, one row a file.

    The payload is the html in UTF-8, null as empty. Of rows with equal payloads of at least dedup_min_bytes bytes,
    that with the smallest page id (then url) is the response and the others are revisits of it; of repeated rows the
    first copy stands for all. Null ids sort last and null urls get a urn. Shards are ranges of ids of about
    shard_bytes payload bytes (shard_size() of all, if not given), so ids dealt in any way are balanced, and files roll
    beyond roll_bytes compressed bytes (a sixteenth of a shard's payload bytes). An empty table writes no file. Other
    columns are not read. The same rows give the same files, byte for byte.
    """
    spark = pages.sparkSession
    small_batches(spark)
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.sha1(payload).alias("digest"), F.length(payload).cast("long").alias("n"), payload.alias("payload"))
    cuts, size = _shard_cuts(rows.select("page_id", "n"), shard_bytes)
    roll_bytes = roll_bytes or size // 16

    order = lambda: F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url")
    keys = rows.where(F.col("n") >= dedup_min_bytes).groupBy("digest", "page_id", "url").agg(F.count("*").alias("copies"))
    first = keys.groupBy("digest").agg(F.min(order()).alias("first"), F.sum("copies").alias("total")).where("total > 1").select(F.col("digest").alias("of"), "first")
    notes = keys.join(first, F.col("digest") == F.col("of")).select("page_id", "url", "digest", F.lit(None).cast("binary").alias("payload"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), F.lit(True).alias("note"))
    both = rows.select("page_id", "url", "digest", "payload", F.lit(None).cast("long").alias("first_id"), F.lit(None).cast("string").alias("first_url"), F.lit(False).alias("note")).unionByName(notes)
    edges = [*cuts, 2**63 - 1]  # ids beyond all cuts, and null ones, are the last shard's
    shard = F.when(F.col("page_id").isNull(), F.lit(len(cuts))).otherwise(range_of(F.col("page_id"), edges))
    sorted_rows = both.withColumn("shard", shard).repartitionById(len(edges), "shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), F.col("url").asc_nulls_last(), "digest", F.col("note").desc())
    written = materialize(sorted_rows.mapInArrow(_writer(out_dir, roll_bytes), MANIFEST), "warc-manifest")
    written.repartition(_tasks(written)).mapInPandas(_committer(out_dir), "name string").agg(F.count("*")).first()
    return _commit_manifest(spark, written, out_dir)


def _commit_manifest(spark: SparkSession, written: DataFrame, out_dir: str) -> DataFrame:
    """The manifest appears in out_dir in one rename, after all its files."""
    written.write.parquet(f"{out_dir}/_manifest.tmp")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(out_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(hadoop.Path(f"{out_dir}/_manifest.tmp"), hadoop.Path(f"{out_dir}/_manifest")):
        raise OSError(f"cannot commit {out_dir}/_manifest")
    remove(spark, f"{out_dir}/_temporary")
    return read_manifest(spark, out_dir)


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/_manifest")


def _tasks(files: DataFrame) -> int:
    return max(1, min(10_000, files.count()))


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed WARC stream, one at a time; header names in lower case."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record is cut off")
        yield headers, block


def _reader(out_dir: str, payloads: bool):
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(out_dir)
        names = [c.split()[0] for c in RECORDS.split(", ")]
        for frame in frames:
            for name in frame["name"]:
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as plain:
                    for headers, block in parse_records(plain):
                        if f"sha1:{_base32(hashlib.sha1(block).digest())}" != headers["warc-block-digest"]:
                            raise ValueError(f"{name}: a block does not match its digest")
                        if headers["warc-type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
                        if headers["warc-type"] == "response" and (len(payload) != size or _base32(hashlib.sha1(payload).digest()) != digest):
                            raise ValueError(f"{name}: a payload does not match its digest")
                        page_id, refers_to = (int(x) if (x := headers.get(k)) else None for k in ("x-page-id", "x-refers-to-page-id"))
                        rows.append((name, page_id, headers["warc-target-uri"], size, digest, headers["warc-type"], refers_to, payload if payloads and headers["warc-type"] == "response" else None))
                        held += len(payload) * payloads
                        if len(rows) >= 10_000 or held > 16 << 20:
                            yield _frame(rows, names)
                            rows, held = [], 0
                if rows:
                    yield _frame(rows, names)

    return read


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, out_dir: str, payloads: bool = True) -> DataFrame:
    """The page records of all committed files; every block's and response's digest is checked, and a wrong one raises.

    Revisits have a null payload; payload_bytes and payload_digest are those of the full payload. One task reads a
    file record by record.
    """
    files = read_manifest(spark, out_dir)
    return files.repartition(_tasks(files)).mapInPandas(_reader(out_dir, payloads), RECORDS)
