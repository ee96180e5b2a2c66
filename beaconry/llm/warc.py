"""Sharded WARC archives: written deterministically, committed by a manifest, and read back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beaconry.llm.common import quoted
from beaconry.session import materialize

# fixed values of the format
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
#: uncompressed bytes one task writes, and compressed bytes after which it begins another file
SHARD_BYTES = 64 << 20
FILE_BYTES = 32 << 20
MAX_SHARDS = 20_000
READ_BYTES = 1 << 20

MANIFEST = "shard long, file string, records long, bytes long, sha256 string"
RECORD = "key string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: str | None, url: str | None, sha1: str, nth: int) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, repr((key, url, sha1, nth))).urn


def _line(value: str) -> str:
    """A header value on one line: control characters, blanks at its ends and the escape sign itself percent-encoded."""
    inner = range(len(value) - len(value.lstrip(" ")), len(value.rstrip(" ")))
    return "".join(f"%{ord(c):02X}" if c < " " or c in "\x7f%" or c == " " and n not in inner else c for n, c in enumerate(value))


def _unline(value: str) -> str:
    parts = value.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def record(key: str | None, url: str | None, payload: bytes, date: str, own_id: str, original: tuple | None) -> bytes:
    """One record: headers rebuilt from the row, digests from the bytes. ``original`` is the id, key and URL of the
    response with the same payload, for a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if original else http + payload
    headers = [
        ("WARC-Type", "revisit" if original else "response"), ("WARC-Record-ID", f"<{own_id}>"), ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _line(url)), ("X-Row-Key", None if key is None else _line(key)),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"), ("X-Payload-Length", str(len(payload))),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"), ("Content-Type", HTTP_TYPE), ("Content-Length", str(len(block)))]
    if original:
        first, first_key, first_url = original
        headers += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{first}>"),
            ("WARC-Refers-To-Target-URI", None if first_url is None else _line(first_url)),
            ("X-Refers-To-Row-Key", None if first_key is None else _line(first_key))]
    lines = [VERSION] + [f"{n}: {v}".encode() for n, v in headers if v is not None]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


# ------------------------------------------------------------ writing


def _place(key, url: str | None, sha1: str) -> tuple:
    """Where a row stands in the archive: rows without a key last, those without a URL first."""
    return key is None, 0 if key is None else key, url is not None, url or "", sha1


def _shard_of(cuts: list[tuple]):
    """The number of a row's shard: how many shards begin at or before its place."""
    def shard(keys: pa.Array, urls: pa.Array, sha1: pa.Array) -> pa.Array:
        return pa.array([bisect_right(cuts, _place(*r)) for r in zip(keys.to_pylist(), urls.to_pylist(), sha1.to_pylist())],
                        pa.int64())

    return F.arrow_udf(shard, "long")


# schemes of Hadoop and what the same stores are called by the library that tasks read and write files with
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}


def located(spark: SparkSession, base: str) -> tuple[str, str]:
    """A folder as Spark names it in full, and as tasks open it; schemes that tasks cannot open are refused."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    uri = path.toUri()
    if not uri.getScheme():
        uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    if uri.getScheme() not in SCHEMES:
        raise ValueError(f"archives cannot be kept under {uri.getScheme()}:, only under {', '.join(SCHEMES)}")
    return uri.toString(), f"{SCHEMES[uri.getScheme()]}://{uri.getAuthority() or ''}{uri.getPath()}"


def planned(pages: DataFrame, key: str, url: str, payload: str, min_bytes: int, shard_bytes: int) -> tuple[DataFrame, int]:
    """Two kinds of rows by shard, in archive order: what each record is to be, then the payloads; and how many shards.

    The shard of a row follows from the sum of record sizes before it in order, divided by the shard size: it depends on
    the table alone, not on how Spark cuts it. Sizes are summed per range and a row per range is carried on. Where
    shards begin, ``MAX_SHARDS`` places at most, goes to the tasks; so payloads are shuffled once, and nothing but
    keys and digests is joined.
    """
    named = pages.select(
        quoted(key).alias("order_key"), quoted(key).cast("string").alias("key"), quoted(url).cast("string").alias("url"),
        F.coalesce(F.encode(quoted(payload).cast("string"), "UTF-8"), F.lit(b"")).alias("payload")).withColumn(
        "sha1", F.sha1("payload"))
    narrow = named.select("order_key", "key", "url", "sha1", F.octet_length("payload").cast("long").alias("size"))
    order = [F.col("order_key").asc_nulls_last(), "url", "sha1", "row"]
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, so that row numbers and ranges stay as they are
    narrow = materialize(narrow.withColumn("row", F.monotonically_increasing_id()), "warc-rows")
    ranged = materialize(narrow.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "warc-ranges")
    place = F.struct(F.col("order_key").isNull().alias("keyless"), "order_key", "url", "sha1", "row")
    equal = ranged.filter(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(
        F.min(F.struct(place.alias("place"), "key")).alias("first"), F.count(F.lit(1)).alias("rows"))
    # written, so that Spark can split the rows of a frequent payload
    shared = materialize(equal.filter("rows > 1").select(
        "sha1", "size", F.col("first.place.row").alias("first_row"), F.col("first.key").alias("first_key"),
        F.col("first.place.url").alias("first_url")), "warc-shared")

    sums = materialize(ranged.groupBy("part").agg(F.sum("size").alias("held")), "warc-sums")
    whole = sums.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    step = max(shard_bytes, -(-whole // MAX_SHARDS))
    carried = sums.select("part", F.coalesce(
        F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("carried"))
    before = F.sum("size").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    begins = (ranged.join(F.broadcast(carried), "part")
              .withColumn("shard", F.floor((F.col("carried") + before) / F.lit(step)))
              .groupBy("shard").agg(F.min(place).alias("place")).orderBy("shard").select("place.*").collect())
    shard = _shard_of([_place(r.order_key, r.url, r.sha1) for r in begins[1:]])(F.col("order_key"), F.col("url"), F.col("sha1"))

    again = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    told = ranged.join(shared, ["sha1", "size"], "left").select(
        shard.alias("shard"), "order_key", "key", "url", "sha1", "row", F.lit(None).cast("binary").alias("payload"),
        again.alias("again"), "first_key", "first_url")
    bodies = named.select(
        shard.alias("shard"), "order_key", "key", "url", "sha1", F.lit(None).cast("long").alias("row"), "payload",
        F.lit(None).cast("boolean").alias("again"), F.lit(None).cast("string").alias("first_key"),
        F.lit(None).cast("string").alias("first_url"))
    return told.unionByName(bodies), max(1, len(begins))


def _writing(base: str, date: str, file_bytes: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(base)
        attempt = f"{root}/_temporary/{uuid.uuid4().hex}"
        state = {"shard": None, "file": 0, "out": None}
        done: list[tuple] = []

        def close() -> None:
            if state["out"] is None:
                return
            state["out"].close()
            name = state["name"]
            target = store.get_file_info(f"{root}/{name}")
            # another attempt that was here first has written the same bytes
            if target.type == fs.FileType.NotFound:
                store.move(f"{attempt}/{name}", f"{root}/{name}")
            else:
                store.delete_file(f"{attempt}/{name}")
            done.append((state["shard"], name, state["records"], state["bytes"], state["sha"].hexdigest()))
            state["out"] = None

        def opened(shard: int):
            if state["shard"] != shard:
                close()
                state.update(shard=shard, file=0)
            elif state["out"] is not None and state["bytes"] >= file_bytes:
                close()
            if state["out"] is None:
                state["name"] = f"part-{shard:08d}-{state['file']:04d}.warc.gz"
                state.update(file=state["file"] + 1, records=0, bytes=0, sha=hashlib.sha256())
                store.create_dir(attempt, recursive=True)
                state["out"] = store.open_output_stream(f"{attempt}/{state['name']}", compression=None)
            return state["out"]

        # what the rows of the place at hand are to be: the first, and all after it
        here, kinds, same = None, [], 0
        for batch in batches:
            for shard, key, url, sha1, payload, *kind in zip(*(
                    batch.column(n).to_pylist() for n in
                    ("shard", "key", "url", "sha1", "payload", "again", "first_key", "first_url"))):
                if payload is None:
                    if here != (shard, key, url, sha1):
                        here, kinds, same = (shard, key, url, sha1), [], 0
                    if len(kinds) < 2:
                        kinds.append(kind)
                    continue
                if here != (shard, key, url, sha1):
                    raise ValueError("a payload came without its plan")
                again, first_key, first_url = kinds[min(same, len(kinds) - 1)]
                out = opened(shard)
                original = (record_id(first_key, first_url, sha1, 0), first_key, first_url) if again else None
                own = record_id(key, url, sha1, same)
                same += 1
                packed = gzip.compress(record(key, url, payload, date, own, original), 6, mtime=0)
                out.write(packed)
                state["sha"].update(packed)
                state["records"] += 1
                state["bytes"] += len(packed)
        close()
        if done:
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)],
                                             ["shard", "file", "records", "bytes", "sha256"])

    return of_batches


def write_warc(pages: DataFrame, base: str, key: str = "page_id", url: str = "url", payload: str = "html",
               min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", shard_bytes: int = SHARD_BYTES,
               file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one WARC record per row under ``base`` and return the manifest.

    Records are sorted by key, URL and payload and cut into shards of ``shard_bytes`` of payload; a shard's files
    ``part-<shard>-<file>.warc.gz`` roll when they reach ``file_bytes`` compressed. Rows of one key, URL and payload
    share a shard; beyond ``MAX_SHARDS`` shards they are larger instead. Each record is a gzip member of its
    own. Headers and digests are made anew. Of records with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest key is a response and the others revisit it; without a key counts as largest, then the URL decides.

    The same table gives the same bytes in the same files. Files are written under temporary names and renamed when
    they are full, so that a task that runs again meets whole files or none; what counts is the manifest, a table
    under ``base/_manifest`` that Spark commits last, and files it does not list are no part of the archive.

    A null payload is empty; a null key or URL is left out of the headers; equal rows are records each, all but one
    revisits; an empty table gives a manifest without files. Other columns are not read.
    """
    base, store = located(pages.sparkSession, base)
    rows, shards = planned(pages, key, url, payload, min_bytes, shard_bytes)
    # at each place the plan before the payloads, and in it the row that others may refer to
    order = ["shard", F.col("order_key").asc_nulls_last(), "url", "sha1", F.col("row").asc_nulls_last()]
    # a partition for each shard, which Spark does not put together however few there are
    written = rows.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions(*order).drop("order_key", "row").mapInArrow(
        _writing(store, date, file_bytes), MANIFEST)
    written.write.parquet(f"{base}/_manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{base}/_manifest")


# ------------------------------------------------------------ reading


class _Members:
    """The decompressed bytes of a file of gzip members, read piece by piece."""

    def __init__(self, stream):
        self.stream, self.held, self.inflate = stream, bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        data = self.inflate.unused_data if self.inflate.eof else b""
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(31)
        data = data or self.stream.read(READ_BYTES)
        if not data:
            return False
        self.held += self.inflate.decompress(data)
        return True

    def line(self) -> bytes | None:
        while (at := self.held.find(b"\r\n")) < 0:
            if not self._more():
                if self.held:
                    raise ValueError("the archive ends within a record")
                return None
        out = bytes(self.held[:at])
        del self.held[:at + 2]
        return out

    def exactly(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.held[:size])
        del self.held[:size]
        return out


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and blocks of all records of an archive file; digests are verified."""
    members = _Members(stream)
    while (line := members.line()) is not None:
        if line != VERSION:
            raise ValueError(f"no record begins with {line[:20]!r}")
        headers = {}
        while line := members.line():
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip(" ")
        block = members.exactly(int(headers["content-length"]))
        if members.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        if headers["warc-block-digest"] != f"sha1:{digest_of(block)}":
            raise ValueError(f"block of {headers['warc-record-id']} does not have its digest")
        yield headers, block


def _reading(base: str, with_payload: bool):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(base)
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.binary()] * with_payload
        names = [c.split()[0] for c in RECORD.split(", ")] + ["payload"] * with_payload

        def sent(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for headers, block in records_of(stream):
                        payload = None
                        length, digest = int(headers["x-payload-length"]), headers["warc-payload-digest"].partition(":")[2]
                        if headers["warc-type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            length, found = len(payload), digest_of(payload)
                            if found != digest:
                                raise ValueError(f"payload of {headers['warc-record-id']} does not have its digest")
                        texts = [headers.get(n) for n in ("x-row-key", "warc-target-uri", "x-refers-to-row-key")]
                        key, url, refers = (None if t is None else _unline(t) for t in texts)
                        row = (key, url, length, digest, headers["warc-type"], refers)
                        rows.append(row + (payload,) if with_payload else row)
                        held += len(block) if with_payload else 100
                        if held >= READ_BYTES:
                            yield sent(rows)
                            rows, held = [], 0
                if rows:
                    yield sent(rows)

    return of_batches


def read_warc(spark: SparkSession, base: str, payload: bool = True) -> DataFrame:
    """The records of the files that the manifest lists: ``key, url, payload_bytes, payload_digest, record_type,
    refers_to`` and, if asked for, ``payload`` (null for revisits).

    Digests of blocks and payloads are verified; a damaged file raises. Keys are strings, null where the record has
    none, as are URLs. Length and digest of a revisit's payload come from its headers. Files are streamed.
    """
    base, store = located(spark, base)
    manifest = spark.read.schema(MANIFEST).parquet(f"{base}/_manifest")
    # a partition for each file
    nth = F.row_number().over(Window.orderBy("file")) - 1
    files = manifest.select("file", nth.alias("nth")).repartitionById(max(1, manifest.count()), "nth")
    return files.select("file").mapInArrow(_reading(store, payload), RECORD + ", payload binary" * payload)
