"""A deterministic sharded WARC writer and its reader.

Writing: records are sorted by id and dealt to shards by ranges of ids, one task each. There are as many shards as SHARD_BYTES of
payload ask for, or the session's partitions for smaller tables. The ranges' bounds come from the ids and sizes of a sample that
hashing picks, so shards hold about as many bytes each, and the same rows give the same shards, whatever the number of tasks. A shard's records are gzip members, one each, with headers
and digests made anew; a file is closed when its compressed size passes `roll_bytes`. Each file is written under a temporary
name, one for each attempt, and renamed when it is whole. A task that runs again writes the same bytes under the same final name.
The files of a finished job are listed in a manifest (name, records, bytes, SHA-256), which is itself renamed into place last:
an archive without manifest is not finished, and readers read what the manifest lists and nothing else.

Equal payloads: the record with the smallest id holds the payload (response), the others refer to it (revisit), unless the
payload is shorter than `least_bytes`. Payload length and digest of a revisit are kept in its headers, as its HTTP block would.

A null payload counts as empty; a null or unprintable URL is left out or percent-encoded in WARC-Target-URI. Payloads are written
whole. Rows that repeat an id and a payload are written each; ties between them go by URL. Rows with a null id are rejected with
a ValueError. Other columns are ignored. An empty table gives a manifest without files and an empty result. Files live in a
folder that driver and executors share; any file system that pyarrow opens by URI will do.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import input_partitions, scratch, small_batches, text_or_empty

ROLL_BYTES = 64 << 20
#: Rows of the sample that sets the shards' bounds, at most twice this; shards are at most a quarter of it.
SAMPLE_ROWS = 100_000
#: Payload bytes of a shard, which one task sorts and writes.
SHARD_BYTES, LEAST_BYTES = 64 << 20, 1 << 20
DATE = "2000-01-01T00:00:00Z"  # of every record: the tables have no fetch time, and a clock would make the bytes differ
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def open_fs(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else "file://" + re.sub("^file:", "", uri))


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None) -> str | None:
    return None if url is None else re.sub(rb"[^\x21-\x7e]", lambda m: b"%%%02X" % m[0][0], url.encode()).decode()


def record_bytes(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    digest = sha1_base32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}"]
    if (target := _uri(url)) is not None:
        head.append(f"WARC-Target-URI: {target}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    # A gzip member by hand: its header has no time and no system, so that equal records have equal bytes.
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def read_members(source) -> Iterator[bytes]:
    """The records of a file, one gzip member at a time; only one member is in memory."""
    inflate, parts, held = zlib.decompressobj(31), [], b""
    while True:
        if not held:
            held = source.read(1 << 18)
            if not held:
                if parts or inflate.unconsumed_tail:
                    raise ValueError("a WARC file ends within a record")
                return
        parts.append(inflate.decompress(held))
        held = b""
        if inflate.eof:
            held = inflate.unused_data
            yield b"".join(parts)
            inflate, parts = zlib.decompressobj(31), []


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record; its length and block digest must hold."""
    end = raw.find(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if end < 0 or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
    block = raw[end + 4 : -4]
    if len(block) != int(head["content-length"]) or raw[-4:] != b"\r\n\r\n" or head.get("warc-block-digest") != "sha1:" + sha1_base32(block):
        raise ValueError("a record's length or digest doesn't hold")
    return head, block


def _page(reference: str) -> int:
    return int(reference.removeprefix("<urn:page:").removesuffix(">"))


def record_row(raw: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of one record; a response's payload is digested again."""
    head, block = parse_record(raw)
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError("a payload's length or digest doesn't hold")
    refers = _page(head["warc-refers-to"]) if head["warc-type"] == "revisit" else None
    return _page(head["warc-record-id"]), size, digest, head["warc-type"], refers, head.get("warc-target-uri")


def bounds_of(sample: list, shards: int) -> list[int]:
    """The ids that begin new shards, from (id, size) in order of id: each shard has about its share of the bytes and rows."""
    if not sample:
        return []
    weight = list(accumulate(size + 512 for _, size in sample))  # a record's headers count too
    cuts = (bisect.bisect_left(weight, weight[-1] * k / shards) for k in range(1, shards))
    return sorted({sample[min(c + 1, len(sample) - 1)][0] for c in cuts})


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, roll_bytes: int = ROLL_BYTES, shards: int | None = None) -> dict:
    """Write pages to the folder `path` (shared by driver and executors); returns the manifest."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_or_empty(payload_col).alias("payload"))
    rows = rows.withColumn("page_id", F.coalesce("page_id", F.raise_error(F.lit("a page without id can't be written")).cast("long")))
    keyed = rows.withColumn("sha", F.unhex(F.sha2(F.col("payload").cast("binary"), 256)))

    # Groups of equal payloads as narrow rows; adaptive execution splits a hot digest in the join.
    narrow = keyed.select("page_id", "sha", F.octet_length("payload").alias("size"))
    groups = narrow.where(F.col("size") >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "first")
    revisits = narrow.join(groups, "sha").where("page_id > first").select("page_id", "sha", F.col("first").alias("refers_to")).distinct()

    total, size = narrow.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = shards or min(max(-(-size // SHARD_BYTES), min(input_partitions(pages), 1 + size // LEAST_BYTES)), SAMPLE_ROWS // 4)
    share = max(1, total // SAMPLE_ROWS)
    picked = narrow.where(F.pmod(F.xxhash64("page_id"), F.lit(share)) == 0).select("page_id", "size")
    bounds = bounds_of(picked.orderBy("page_id", "size").limit(2 * SAMPLE_ROWS).collect(), shards)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("shard", pa.array([bisect.bisect_right(bounds, i) for i in b.column("page_id").to_pylist()], pa.int32()))

    # What a revisit refers to travels as a narrow row ahead of its page, so payloads are shuffled once, to their shards.
    links = revisits.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("payload"), "sha", "refers_to", F.lit(0).alias("kind"))
    bodies = rows.select("page_id", "url", "payload", F.lit(None).cast("binary").alias("sha"), F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("kind"))
    dealt = links.unionByName(bodies).mapInArrow(place, "page_id long, url string, payload string, sha binary, refers_to long, kind int, shard int")
    dealt = dealt.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "page_id", "kind", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_fs(path)
        attempt = uuid.uuid4().hex
        done: list[dict] = []
        at = out = None

        def close():
            nonlocal out
            if out is not None:
                out["stream"].close()
                name = f"part-{out['shard']:05d}-{out['number']:05d}.warc.gz"
                fs.move(out["temporary"], f"{folder}/{name}")
                done.append({"name": name, "records": out["records"], "bytes": out["bytes"], "sha256": out["hash"].hexdigest()})
                out = None

        number, of, known = 0, None, {}
        for b in small_batches(batches, ["payload"]):
            for page, url, payload, sha, refers, kind, shard in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if page != of:
                    of, known = page, {}
                if kind == 0:
                    known[sha] = refers
                    continue
                body = payload.encode()
                if shard != at:
                    close()
                    at, number = shard, 0
                if out is None:
                    temporary = f"{folder}/_temporary-{shard:05d}-{number:05d}-{attempt}"
                    out = {"stream": fs.open_output_stream(temporary, compression=None), "temporary": temporary, "shard": shard, "number": number, "records": 0, "bytes": 0, "hash": hashlib.sha256()}
                    number += 1
                member = record_bytes(page, url, body, known.get(hashlib.sha256(body).digest()) if known else None)
                out["stream"].write(member)
                out["hash"].update(member)
                out["records"] += 1
                out["bytes"] += len(member)
                if out["bytes"] >= roll_bytes:
                    close()
        close()
        names = ["name", "records", "bytes", "sha256"]
        yield pa.RecordBatch.from_arrays([pa.array([d[c] for d in done], k) for c, k in zip(names, [pa.string(), pa.int64(), pa.int64(), pa.string()], strict=True)], names=names)

    fs, folder = open_fs(path)
    fs.create_dir(folder, recursive=True)
    files = sorted((r.asDict() for r in dealt.mapInArrow(write, "name string, records long, bytes long, sha256 string").collect()), key=lambda f: f["name"])
    manifest = {"format": "WARC/1.1", "records": sum(f["records"] for f in files), "files": files}
    with fs.open_output_stream(f"{folder}/_temporary-manifest", compression=None) as f:
        f.write(json.dumps(manifest, indent=1).encode())
    for left in fs.get_file_info(pyarrow.fs.FileSelector(folder)):
        if left.base_name.startswith("_temporary-") and left.base_name != "_temporary-manifest":
            fs.delete_file(left.path)  # of attempts that failed
    fs.move(f"{folder}/_temporary-manifest", f"{folder}/manifest.json")
    return manifest


def read_manifest(path: str) -> dict:
    fs, folder = open_fs(path)
    with fs.open_input_stream(f"{folder}/manifest.json", compression=None) as f:
        return json.loads(f.read())


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """READ columns of every record of the archive that the manifest lists; a file that differs from the manifest fails the job."""
    files = read_manifest(path)["files"]
    if not files:
        return spark.createDataFrame([], READ)
    listed = spark.createDataFrame([(f["name"], f["records"], f["bytes"]) for f in files], "name string, records long, bytes long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_fs(path)
        names, kinds = [c.split()[0] for c in READ.split(", ")], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for b in batches:
            for name, records, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                seen, rows = 0, []
                with fs.open_input_file(f"{folder}/{name}") as f:
                    if f.size() != size:
                        raise ValueError(f"{name} has not the size that the manifest gives")
                    for raw in read_members(io.BufferedReader(f, 1 << 18)):
                        rows.append(record_row(raw))
                        if len(rows) == 5000:
                            yield batch(rows)
                            seen, rows = seen + len(rows), []
                if rows:
                    yield batch(rows)
                if seen + len(rows) != records:
                    raise ValueError(f"{name} has not the records that the manifest gives")

    tasks = min(len(files), input_partitions(listed))
    return listed.repartitionByRange(tasks, "name").mapInArrow(run, READ)


def warc_round_trip(pages: DataFrame, *, path: str | None = None, **options) -> DataFrame:
    """Write pages to an archive (in the shared folder unless a path is given) and read its records back."""
    path = path or scratch(pages.sparkSession, "warc")
    write_warc(pages, path, **options)
    return read_warc(pages.sparkSession, path)
