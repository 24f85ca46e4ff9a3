"""Web archives: a deterministic sharded WARC writer, and the reader of its files.

Records are put in one order: page id, payload digest, digest of the address. Their exact sizes,
summed up along that order, cut it into shards of about the same size (a share of the total between
``LEAST_SHARD`` and ``MOST_SHARD``), so the cuts follow from the rows alone, however Spark deals
them. A task writes the shards it gets one after another, record by record, and rolls to another
file when the compressed size passes ``FILE_BYTES``. Headers, record ids and digests are made anew;
each record is a gzip member of its own without a time stamp, so equal rows give equal files.

Equal payloads of ``LEAST_REVISIT`` bytes or more are stored once: the record with the largest page
id is the response, the others revisit it.

A file is written under a temporary name of its attempt. The rows about the files that tasks return
are kept as a table, which names one attempt for each file; only those are moved to their names,
and the manifest, moved last, makes the archive valid. A lost executor leaves temporary files, which
no manifest names.

The rows are read twice: once for ids and digests, once to be packed; the packed records meet their
part (response or revisit) in the one shuffle of the data, by shard.

Defined results: null texts are empty payloads; null addresses become ``urn:page:`` and the id;
rows without an id come last, are responses only if no equal payload has an id, and what revisits
them refers to null; rows that are equal as a whole are records of their own, one of them the
response; texts of any length are one record, and the file that it fills is rolled behind it; an
empty table gives an archive with a manifest and no files. Only ``page_id``, ``url`` and ``html`` are
read. The folder is a URI that pyarrow and Spark both reach from every executor.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import struct
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm.common import keep, pieces, ship

LEAST_REVISIT = 1000
#: Bytes of the shards, before compression; shards there are of a total; bytes of a file, compressed.
LEAST_SHARD, MOST_SHARD, SHARDS, FILE_BYTES = 256 << 10, 512 << 20, 256, 256 << 20
#: What a record's headers take about, and the level of compression.
HEADERS, LEVEL = 700, 6
DATE = "2024-01-01T00:00:00Z"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "g"  # sorts behind the hexadecimal digits of an id


def key_of(page_id: int | None, digest: str, url: bytes | None) -> str:
    """What records are ordered by, as text."""
    order = NO_ID * 16 if page_id is None else f"{page_id + (1 << 63):016x}"
    return order + digest + ("" if url is None else hashlib.sha1(url).hexdigest())


def key_column() -> Column:
    """The same as ``key_of``, from ``page_id``, ``digest`` and ``url``."""
    sign = F.lit(-(1 << 63)).cast("bigint")
    order = F.lower(F.lpad(F.hex(F.col("page_id").bitwiseXOR(sign)), 16, "0"))
    return F.concat(
        F.coalesce(order, F.lit(NO_ID * 16)), "digest",
        F.coalesce(F.sha1(F.col("url").cast("binary")), F.lit("")))


# --- records --------------------------------------------------------------------------------------

def address(page_id: int | None, url: bytes | None) -> str:
    return f"urn:page:{page_id}" if url is None else urllib.parse.quote_from_bytes(url, safe="!#$%&'()*+,/:;=?@[]~")


def record_id(key: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{key}#{number}')}>"


def labelled(digest: str) -> str:
    """A hexadecimal digest as headers carry it."""
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def packed(block: bytes, headers: dict[str, str]) -> bytes:
    """A record as a gzip member, without time and name."""
    headers |= {
        "WARC-Block-Digest": labelled(hashlib.sha1(block).hexdigest()), "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"
    data = head.encode() + block + b"\r\n\r\n"
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(data) + deflate.flush()
    return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def http_head(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def headers_of(kind: str, page_id: int | None, url: bytes | None, digest: str, own: str) -> dict[str, str]:
    out = {
        "WARC-Type": kind, "WARC-Record-ID": own, "WARC-Date": DATE, "WARC-Target-URI": address(page_id, url),
        "Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": labelled(digest)}
    return out if page_id is None else out | {"X-Page-Id": str(page_id)}


def response(page_id: int | None, url: bytes | None, payload: bytes, digest: str, own: str) -> bytes:
    return packed(http_head(len(payload)) + payload, headers_of("response", page_id, url, digest, own))


def revisit(
    page_id: int | None, url: bytes | None, size: int, digest: str, own: str, first: str, first_page: int | None
) -> bytes:
    more = {"WARC-Profile": REVISIT, "WARC-Refers-To": first}
    if first_page is not None:
        more["X-Refers-To-Page-Id"] = str(first_page)
    return packed(http_head(size), headers_of("revisit", page_id, url, digest, own) | more)


def about(name: str) -> bytes:
    """The first record of a file."""
    block = f"software: cairn\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n".encode()
    return packed(block, {
        "WARC-Type": "warcinfo", "WARC-Record-ID": record_id(name, 0), "WARC-Date": DATE, "WARC-Filename": name,
        "Content-Type": "application/warc-fields"})


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file, unpacked one by one."""
    view = memoryview(data)
    while len(view):
        inflate = zlib.decompressobj(16 + zlib.MAX_WBITS)
        out = [inflate.decompress(view[:65536])]
        at = 65536
        while not inflate.eof and at < len(view):
            out.append(inflate.decompress(view[at:at + 65536]))
            at += 65536
        if not inflate.eof:
            raise ValueError("an archive ends within a record")
        yield b"".join(out)
        view = view[min(at, len(view)) - len(inflate.unused_data):]


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, which must have the length and digest that its headers say."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(headers["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    if labelled(hashlib.sha1(block).hexdigest()) != headers["WARC-Block-Digest"]:
        raise ValueError("a record's digest is wrong")
    return headers, block


def http_parts(block: bytes) -> tuple[int, bytes]:
    """The payload's length as its headers say it, and the payload (none in a revisit)."""
    head, _, payload = block.partition(b"\r\n\r\n")
    return int(re.search(rb"(?i)^content-length: *(\d+)", head, re.M)[1]), payload


# --- writing --------------------------------------------------------------------------------------

def entries(pages: DataFrame) -> DataFrame:
    """``key, page_id, digest, n_bytes, copies`` of the distinct records."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return (
        pages.select(
            F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
            F.sha1(payload).alias("digest"), F.octet_length(payload).cast("bigint").alias("n_bytes"))
        .select(key_column().alias("key"), "page_id", "digest", "n_bytes")
        .groupBy("key", "page_id", "digest", "n_bytes").agg(F.count("*").alias("copies"))
    )


def parts(found: DataFrame) -> DataFrame:
    """Of each distinct record, how many of its copies are responses, and what the others revisit."""
    leaders = keep(  # as a table, so that adaptive execution can split a hot digest in the join
        found.where(F.col("n_bytes") >= LEAST_REVISIT).groupBy("digest")
        .agg(F.max(F.struct("page_id", "key")).alias("lead"), F.sum("copies").alias("n"))
        .where("n > 1").select("digest", "lead"), "leaders")
    return found.join(leaders, "digest", "left").select(
        "key", F.col("lead.page_id").alias("lead_page"), F.col("lead.key").alias("lead_key"),
        F.when(F.col("lead").isNull(), F.col("copies"))
        .when(F.col("key") == F.col("lead.key"), 1).otherwise(0).cast("bigint").alias("responses"))


def cuts(found: DataFrame, shard_bytes: int | None) -> list[str]:
    """The keys at which a shard begins, but for the first: as many as the total has shards."""
    size = (F.col("n_bytes") + HEADERS) * F.col("copies")
    order = found.select("key", size.alias("size"))
    ranged = keep(
        order.repartitionByRange(
            max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1), "key")
        .withColumn("part", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("part").agg(F.sum("size").alias("size"))  # a row a range
    total = sums.agg(F.sum("size")).first()[0] or 0
    shard = shard_bytes or min(max(total // SHARDS, LEAST_SHARD), MOST_SHARD)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ranged.withColumn("inside", F.sum("size").over(inside)).join(starts, "part")
    begins = rows.groupBy(F.floor((F.col("start") + F.col("inside") - F.col("size")) / shard).alias("shard")).agg(
        F.min("key").alias("key"))
    return sorted(r.key for r in begins.collect())[1:]


def shard_of(bounds: list[str]):
    def find(keys):
        import pandas as pd

        return pd.Series([bisect.bisect_right(bounds, k) for k in keys], dtype="int32")

    return F.pandas_udf(find, "int")


PACKED = "key string, page_id bigint, url binary, digest string, n_bytes bigint, copies bigint, member binary"


def packed_pages(pages: DataFrame) -> DataFrame:
    """Every page as a response record, ready to be written; copies next to each other are one row."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").cast("binary").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 4 << 20):
                made: dict[str, list] = {}
                for page_id, url, html in zip(*(c.to_pylist() for c in part.columns)):
                    digest = hashlib.sha1(html).hexdigest()
                    key = key_of(page_id, digest, url)
                    if key in made:
                        made[key][5] += 1
                    else:
                        made[key] = [key, page_id, url, digest, len(html), 1,
                                     response(page_id, url, html, digest, record_id(key, 0))]
                columns = list(zip(*made.values()))
                kinds = (pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["key", "page_id", "url", "digest", "n_bytes", "copies", "member"])

    return rows.mapInArrow(run, PACKED)


FILES = "name string, temporary string, n_bytes bigint, n_records bigint, sha256 string, first_key string, last_key string"


class Roll:
    """The files of a shard, one after another."""

    def __init__(self, store: fs.FileSystem, folder: str, shard: int, most: int):
        self.store, self.folder, self.shard, self.most = store, folder, shard, most
        self.number, self.out, self.done = 0, None, []

    def add(self, member: bytes, key: str) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:07d}-{self.number:04d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(f"{self.folder}/{self.temporary}")
            self.size, self.records, self.first, self.sha = 0, 0, key, hashlib.sha256()
            self.put(about(self.name))
        self.put(member)
        self.records, self.last = self.records + 1, key
        if self.size >= self.most:
            self.close()

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((
                self.name, self.temporary, self.size, self.records, self.sha.hexdigest(), self.first, self.last))
            self.out, self.number = None, self.number + 1


def written(rows: DataFrame, folder: str, file_bytes: int) -> DataFrame:
    """Writes the sorted records of each shard; a row for every file of this attempt."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        roll, key, number = None, None, 0
        left, lead_page, lead_key = 0, None, None
        done: list[tuple] = []
        for batch in batches:
            for part in pieces(batch, 8 << 20):
                for row in part.to_pylist():
                    if roll is None or roll.shard != row["shard"]:
                        if roll is not None:
                            roll.close()
                            done += roll.done
                        roll = Roll(store, path, row["shard"], file_bytes)
                    if row["member"] is None:  # what the records of this key are, before them
                        key, number = row["key"], 0
                        left, lead_page, lead_key = row["responses"], row["lead_page"], row["lead_key"]
                        continue
                    if row["key"] != key:
                        raise ValueError("the pages changed while they were written")
                    for member in copies(row, number, left, lead_page, lead_key):
                        roll.add(member, key)
                    number += row["copies"]
        if roll is not None:
            roll.close()
            done += roll.done
        if done:
            names = [f.split()[0] for f in FILES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)

    return rows.mapInArrow(run, FILES)


def copies(row: dict, number: int, responses: int, lead_page: int | None, lead_key: str | None) -> Iterator[bytes]:
    """The records of a row's copies, of which ``number`` were written before."""
    payload = None
    for i in range(number, number + row["copies"]):
        same = (row["page_id"], row["url"])
        own = record_id(row["key"], i)
        if i >= responses:
            yield revisit(*same, row["n_bytes"], row["digest"], own, record_id(lead_key, 0), lead_page)
        elif i == 0:
            yield row["member"]
        else:
            payload = payload if payload is not None else http_parts(parsed(next(members(row["member"])))[1])[1]
            yield response(*same, payload, row["digest"], own)


def write(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, shard_bytes: int | None = None) -> DataFrame:
    """Writes the archive; its manifest, a row for each file."""
    spark = pages.sparkSession
    ship(spark)
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{path}/_temporary", recursive=True)
    found = keep(entries(pages), "entries")
    shard = shard_of(cuts(found, shard_bytes))(F.col("key")).alias("shard")
    records = packed_pages(pages).select(shard, "*")
    kinds = parts(found).select(shard, "*")
    rows = records.unionByName(kinds, allowMissingColumns=True)
    files = keep(
        written(rows.repartition("shard").sortWithinPartitions("shard", "key", F.col("member").isNotNull()),
                folder, file_bytes), "files")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, temporary, size in zip(*(batch.column(c).to_pylist() for c in ("name", "temporary", "n_bytes"))):
                there = store.get_file_info(f"{path}/{name}")
                if there.type == fs.FileType.NotFound or there.size != size:  # a rerun finds it moved
                    store.move(f"{path}/{temporary}", f"{path}/{name}")
            yield batch

    manifest = files.mapInArrow(move, FILES).drop("temporary")
    manifest.write.json(f"{folder}/_temporary/manifest")
    store.move(f"{path}/_temporary/manifest", f"{path}/manifest")
    store.delete_dir(f"{path}/_temporary")
    return manifest_of(spark, folder)


# --- reading --------------------------------------------------------------------------------------

def manifest_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(", ".join(f for f in FILES.split(", ") if "temporary" not in f)).json(f"{folder}/manifest")


READ = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, html binary, record_id string")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The pages' records of an archive with a manifest: ``page_id, url, record_type, payload_bytes,
    payload_digest, refers_to, html, record_id``. Lengths and digests of all records, of payloads and
    of files are compared; a file that is missing or not as the manifest says fails the job."""
    ship(spark)
    manifest = manifest_of(spark, folder)  # fails where there is none
    if manifest.isEmpty():
        return spark.createDataFrame([], READ)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    if not manifest.join(named.select("name"), "name", "left_anti").isEmpty():
        raise ValueError("the archive lacks files of its manifest")
    # A row a file: Spark broadcasts it if it measures small.
    both = named.join(manifest.select("name", "sha256", "n_records"), "name", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string())
        names = [f.split()[0] for f in READ.split(", ")]
        for batch in batches:
            for name, sha, many, content in zip(*(c.to_pylist() for c in batch.columns)):
                if sha is None or hashlib.sha256(content).hexdigest() != sha:
                    raise ValueError(f"{name} is not what the manifest says")
                rows, size, seen = [], 0, 0
                for member in members(content):
                    headers, block = parsed(member)
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    rows.append(row_of(headers, block))
                    size, seen = size + len(block), seen + 1
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
                if seen != many:
                    raise ValueError(f"{name} has {seen} records, not {many}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return both.select("name", "sha256", "n_records", "content").mapInArrow(run, READ)


def row_of(headers: dict[str, str], block: bytes) -> tuple:
    size, payload = http_parts(block)
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is not what its headers say")
    number = lambda name: int(headers[name]) if name in headers else None
    return (
        number("X-Page-Id"), headers["WARC-Target-URI"], kind, size, digest, number("X-Refers-To-Page-Id"),
        payload if kind == "response" else None, headers["WARC-Record-ID"])
