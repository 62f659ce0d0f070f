"""WARC archives with a two-level capture index (operator 7).

One pass sorts captures by reversed-host URL key over ranges, and each task writes, into the shared folder, an archive of its range (a gzip member per
record), the range's index lines in compressed blocks, and one directory row per block. A reader finds a block by binary search in the directory,
then reads the byte ranges that its lines name."""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from photospark.llm.common import new_path

DIRECTORY = "first_key string, last_key string, n long, index string, at long, size long"
#: Characters that URIs hold as they are, beside letters and digits.
SAFE = "%:/?#[]@!$&'()*+,;=-._~"
RECORD = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


_URL = r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^#]*)"


def url_key(url: Column) -> Column:
    """Host labels reversed and joined by commas, then ``)``, path and query; lower-case, without scheme, ``www.``, port 80 or 443, or fragment.
    A null URL has the key of an empty one."""
    u = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^\s+|\s+$", ""))
    host, port, rest = F.regexp_replace(F.regexp_extract(u, _URL, 1), r"^www\.", ""), F.regexp_extract(u, _URL, 2), F.regexp_extract(u, _URL, 3)
    return F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","), F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)), F.lit(")"), F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    )


def record_id(kind: str, page_id: int | None, n: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {page_id} {n}')}>"


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, n: int = 0) -> bytes:
    """One record. The target is the URL with what no URI may hold as %XX; X-Page has page_id, refers_to, URL and payload size as they are. A revisit has
    no payload but names the response that it repeats. n counts rows that repeat page_id, so that every record has an id of its own."""
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id('revisit' if revisit else 'response', page_id, n)}", "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {quote(url or '', safe=SAFE)}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page: {json.dumps([page_id, refers_to, url, len(payload)])}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id('response', refers_to)}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of RECORD from the bytes of one record; raises ValueError where lengths or the digest of a response disagree."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    field = dict(x.split(": ", 1) for x in lines[1:])
    n = int(field["Content-Length"])
    block, tail = rest[:n], rest[n:]
    if not lines[0].startswith("WARC/") or len(block) != n or tail != b"\r\n\r\n":
        raise ValueError("broken record")
    digest, (page_id, refers_to, url, size) = field["WARC-Payload-Digest"].removeprefix("sha1:"), json.loads(field["X-Page"])
    payload = None
    if field["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != size or sha1_base32(payload) != digest:
            raise ValueError("a payload doesn't fit its digest")
    return {"page_id": page_id, "url": url, "record_type": field["WARC-Type"], "payload": payload, "payload_bytes": size, "payload_digest": digest, "refers_to": refers_to}


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _open(path: str):
    """File system and path of a URI, by pyarrow (local, HDFS, S3, GCS)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _write(batches: Iterator[pa.RecordBatch], folder: str, block_lines: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, page_id, mark, url, html, sha, refers_to), sorted by the first three, to one archive and one index of this task; its directory rows. A
    mark (0) says that the page that follows is a revisit if its payload has this SHA-1. Each attempt has file names of its own, and only rows of
    attempts that succeed reach the directory."""
    name, out, index, lines, rows, at, index_at = uuid.uuid4().hex, None, None, [], [], 0, 0
    marked, marks, repeats = None, {}, 0
    files, place = _open(folder)

    def close_block() -> None:
        nonlocal index_at
        packed = gzip.compress("\n".join(json.dumps(x) for x in lines).encode(), 6)
        index.write(packed)
        rows.append((lines[0][0], lines[-1][0], len(lines), f"{folder}/{name}.cdx.gz", index_at, len(packed)))
        index_at += len(packed)
        lines.clear()

    for batch in batches:
        for i in range(batch.num_rows):
            key, page_id, mark, url, html, sha, refers_to = (c[i].as_py() for c in batch.columns)
            if marked != (key, page_id):
                marked, marks, repeats = (key, page_id), {}, 0
            if mark == 0:
                marks[sha] = refers_to
                continue
            if out is None:
                files.create_dir(place, recursive=True)
                out, index = (files.open_output_stream(f"{place}/{name}.{x}.gz", compression=None) for x in ("warc", "cdx"))
            payload = (html or "").encode()
            digest = hashlib.sha1(payload)
            refers_to = marks.get(digest.hexdigest())
            member = gzip.compress(_record(page_id, url, payload, base64.b32encode(digest.digest()).decode(), refers_to, refers_to is not None, repeats), 3)
            repeats += 1
            out.write(member)
            lines.append([key, page_id, f"{name}.warc.gz", at, len(member)])
            at += len(member)
            if len(lines) == block_lines:
                close_block()
    if lines:
        close_block()
    if out is not None:
        out.close()
        index.close()
    columns = [*zip(*rows, strict=True)] or [()] * 6
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], [x.split()[0] for x in DIRECTORY.split(", ")])


def _lines(row: dict) -> list[list]:
    """The index lines of a block."""
    files, place = _open(row["index"])
    with files.open_input_file(place) as f:
        f.seek(row["at"])
        return [json.loads(x) for x in zlib.decompress(f.read(row["size"]), 31).decode().split("\n")]


def _records(folder: str, lines: list[list], most: int = 8_000_000) -> Iterator[dict]:
    """The records that index lines name: neighbouring byte ranges of an archive are read together, up to ``most`` bytes at once."""
    lines = sorted(lines, key=lambda x: (x[2], x[3]))
    i = 0
    while i < len(lines):
        j = i + 1
        while j < len(lines) and lines[j][2] == lines[i][2] and lines[j][3] == lines[j - 1][3] + lines[j - 1][4] and lines[j][3] + lines[j][4] - lines[i][3] <= most:
            j += 1
        files, place = _open(f"{folder}/{lines[i][2]}")
        with files.open_input_file(place) as f:
            f.seek(lines[i][3])
            data = f.read(lines[j - 1][3] + lines[j - 1][4] - lines[i][3])
        for x in lines[i:j]:
            yield parse_record(zlib.decompress(data[x[3] - lines[i][3] : x[3] - lines[i][3] + x[4]], 31))
        i = j


def _to_arrow(records: list[dict]) -> pa.RecordBatch:
    types = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in records], t) for k, t in types.items()], [*types])


def _read(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            held = []
            for r in _records(folder, _lines(row)):
                held.append(r if payloads else r | {"payload": None})
                if len(held) == 256:
                    yield _to_arrow(held)
                    held = []
            yield _to_arrow(held)


def _find(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    """Rows (key, index, at, size, first_key), those of a block together: its lines for the keys, by binary search, and their records."""
    block, keys = None, []

    def records() -> Iterator[pa.RecordBatch]:
        if block is None:
            return
        lines = _lines(dict(zip(("index", "at", "size"), block, strict=True)))
        order = [x[0] for x in lines]
        named = [x for k in sorted({*keys}) for x in lines[bisect.bisect_left(order, k) : bisect.bisect_right(order, k)]]
        held = []
        for r in _records(folder, named):
            held.append(r if payloads else r | {"payload": None})
            if len(held) == 256:
                yield _to_arrow(held)
                held = []
        yield _to_arrow(held)

    for batch in batches:
        for row in batch.to_pylist():
            here = (row["index"], row["at"], row["size"])
            if here != block:
                yield from records()
                block, keys = here, []
            keys.append(row["key"])
    yield from records()


def _archives(batches: Iterator[pa.RecordBatch], ranges: list[tuple[str, str, str]]) -> Iterator[pa.RecordBatch]:
    """(index, key) for every archive whose key range holds the key; ranges are sorted, and overlap at their ends at most."""
    firsts = [a for a, _, _ in ranges]
    for batch in batches:
        out = []
        for key in batch.column(0).to_pylist():
            i = bisect.bisect_right(firsts, key) - 1
            while i >= 0 and ranges[i][1] >= key:
                out.append((ranges[i][2], key))
                i -= 1
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in (0, 1)], ["index", "key"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From directory rows (at is set) and keys, both in order, the blocks that may hold each key."""
    at_index, open_blocks = None, []
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["index"] != at_index:
                at_index, open_blocks = row["index"], []
            if row["at"] is not None:
                open_blocks.append(row)
            else:
                open_blocks = [b for b in open_blocks if b["last_key"] >= row["key"]]
                out += [(b["index"], b["at"], b["size"], row["key"]) for b in open_blocks]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], ["index", "at", "size", "key"])


@dataclass
class Captures:
    """Archives and index in ``folder``, with the sparse block directory (sorted rows, one per block) as a table beside them."""

    spark: SparkSession
    folder: str

    @property
    def directory(self) -> DataFrame:
        return self.spark.read.schema(DIRECTORY).parquet(f"{self.folder}/directory")

    def records(self, payloads: bool = True) -> DataFrame:
        """Every record, read back block by block through the index (RECORD; payload null for revisits, or for all if not asked for)."""
        blocks = self.directory
        n = max(1, min(10_000, blocks.count()))
        return blocks.repartition(n, "index", "at").mapInArrow(partial(_read, folder=self.folder, payloads=payloads), RECORD)

    def lookup(self, urls: DataFrame, url: str = "url", payloads: bool = True) -> DataFrame:
        """The records of the URLs in a column (distinct keys; a null URL asks for the empty one, URLs that nobody captured give none); payloads as records().

        A key finds its archives by binary search among their key ranges (a row per archive, held by every task: archives number far fewer than
        captures), meets their directory rows in one sorted pass per archive, and each block that may hold a key is read once."""
        keys = urls.select(url_key(F.col(url)).alias("key")).distinct()
        blocks = self.directory
        ranges = sorted((r["a"], r["b"], r["index"]) for r in blocks.groupBy("index").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b")).collect())
        asked = keys.mapInArrow(partial(_archives, ranges=ranges), "index string, key string").select("index", "key", F.lit(None).cast("string").alias("last_key"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("size"))
        merged = blocks.select("index", F.col("first_key").alias("key"), "last_key", "at", "size").union(asked)
        found = merged.repartition("index").sortWithinPartitions("index", "key", F.col("at").isNull(), "at").mapInArrow(_blocks, "index string, at long, size long, key string")
        return found.repartition("index", "at").sortWithinPartitions("index", "at").mapInArrow(partial(_find, folder=self.folder, payloads=payloads), RECORD)


def write_captures(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, block_lines: int = 300, archive_bytes: int = 1 << 30) -> Captures:
    """Write a record per row of ``pages``: of rows with equal payloads of at least ``least_bytes`` bytes, the one with the smallest id is a response
    and the others revisit it.

    A null html is an empty payload and a null url an empty key. Rows without an id revisit the smallest id there is, and are responses where
    none of their group has one; rows that repeat id and payload of a response are responses too. Other columns are not read.
    Equal payloads are known by SHA-1 and length; counts are combined before the shuffle. Payloads are shuffled once, into the order of their keys;
    revisits are marked by small rows that sort before their pages. An archive holds about ``archive_bytes`` of payload, or less."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    known = rows.select("page_id", "url", F.sha1(payload).alias("sha"), F.octet_length(payload).alias("size")).where(F.col("size") >= least_bytes)
    groups = known.groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    marks = known.join(groups, ["sha", "size"]).where(~F.col("page_id").eqNullSafe(F.col("first"))).select("page_id", F.lit(0).alias("mark"), "url", F.lit(None).cast("string").alias("html"), "sha", F.col("first").alias("refers_to"))
    both = marks.union(rows.select("page_id", F.lit(1), "url", "html", F.lit(None).cast("string"), F.lit(None).cast("long")))
    both = both.select(url_key(F.col("url")).alias("key"), *both.columns)
    total = rows.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), total // archive_bytes)
    both.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id", "mark").mapInArrow(partial(_write, folder=folder, block_lines=block_lines), DIRECTORY).write.parquet(f"{folder}/directory")
    return Captures(spark, folder)
