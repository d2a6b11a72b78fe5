"""WARC archives with a two-level capture index.

*Writing.*  Pages are spread by ranges of their capture key (reversed host and rest of the address, then the page id), and
each task writes one archive: a gzip member per record, in key order.  A payload of ``REPEATED`` bytes or more is kept once,
in the response of the smallest page id; other pages with it become revisit records without payload.

*Index.*  Beside every archive lie its index lines, ``BLOCK`` of them per compressed block, and a sparse directory with the
first key and the byte range of every block.  Both are as large as the share of the pages in the archive.

*Reading.*  Wanted keys are spread by ranges, so that neighbours share blocks.  A binary search over the last keys of the
archives finds the archive, one over its directory the block, one inside the block the line; then the bytes of the
record are read.

Files are written under a name of their own by every attempt of a task, and only those of attempts that succeeded are
named in the table of archives, which is written before anything is read.  Paths can be any that pyarrow's file
systems open.

Defined cases: null html is an empty payload; a null address has an empty key; a null page id is never the response of a
payload that another page holds, and of several records with the smallest id all are responses; repeated rows give
repeated records; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from siftline.llm.common import Scratch, text_batches
from siftline.session import fresh_path

REPEATED = 100  # bytes
BLOCK = 256  # index lines
BROADCAST_DIGESTS = 100_000  # a table of repeated payloads with at most so many rows is broadcast
_LEVEL = 4
_WRITTEN = "archive string, last string, records long"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def capture_key(url: str = "url", page_id: str = "page_id") -> Column:
    """Reversed host, rest of the address and page id.  White space and control characters are escaped, so the blank before
    the id sorts below everything else."""
    address = F.coalesce(F.col(url), F.lit(""))
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?(.*)$"
    host, rest = F.regexp_extract(address, "(?s)" + pattern, 1), F.regexp_extract(address, "(?s)" + pattern, 2)
    key = F.when(host != "", F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), F.lit(")"), rest)).otherwise(address)
    number = F.lpad((F.col(page_id).cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat(F.regexp_replace(key, r"[\x00-\x20]", "%20"), F.lit(" "), F.coalesce(number, F.lit("-")))


def typed(pages: DataFrame) -> DataFrame:
    """Pages with key, payload digest, and the page that a revisit refers to."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html")).withColumns({
        "key": capture_key(), "bytes": F.octet_length("html").cast("long"), "digest": F.sha2("html", 256)})
    many = (rows.filter(F.col("bytes") >= REPEATED).groupBy("digest").agg(F.count(F.lit(1)).alias("_n"), F.min("page_id").alias("_first"))
            .filter("_n > 1 and _first is not null").select("digest", "_first"))
    many = Scratch(pages.sparkSession).keep(many, "repeated")
    few = many.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
    rows = rows.join(F.broadcast(many) if few else many, "digest", "left")
    own = F.col("page_id").eqNullSafe(F.col("_first")) | F.col("_first").isNull()
    return rows.select("page_id", "url", "html", "key", "bytes", "digest", F.when(~own, F.col("_first")).alias("refers"))


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def record(page_id: int | None, url: str | None, html: str, digest: str, size: int, refers: int | None) -> bytes:
    """One gzip member."""
    kind = "response" if refers is None else "revisit"
    address = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + html.encode("utf-8") if refers is None else head
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}:{digest[:16]}>", f"WARC-Target-URI: {address}",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if refers is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}:{digest[:16]}>"]
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parsed(raw: bytes) -> dict:
    """Headers and payload of a record; the payload's digest is computed again."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page, refers = (x and x.removeprefix("<urn:page:").split(":")[0] for x in (fields["WARC-Record-ID"], fields.get("WARC-Refers-To")))
    return {"page_id": None if page == "None" else int(page), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": None if refers is None else int(refers)}


def _written(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, at, last, count = uuid.uuid4().hex, 0, None, 0
        system, path = _open(folder)
        archive = None
        lines, index, directory = [], [], []

        def close_block() -> None:
            if lines:
                packed = zlib.compress("\n".join(f"{k} {o} {n}" for k, o, n in lines).encode(), _LEVEL)
                directory.append((lines[0][0], sum(map(len, index)) if not directory else directory[-1][1] + directory[-1][2], len(packed)))
                index.append(packed)
                lines.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for row in batch.slice(start, 64).to_pylist():
                    if archive is None:
                        archive = system.open_output_stream(f"{path}/{name}.warc.gz", compression=None)
                        blocks = system.open_output_stream(f"{path}/{name}.idx", compression=None)
                    raw = record(row["page_id"], row["url"], row["html"], row["digest"], row["bytes"], row["refers"])
                    archive.write(raw)
                    lines.append((row["key"], at, len(raw)))
                    at, last, count = at + len(raw), row["key"], count + 1
                    if len(lines) == BLOCK:
                        close_block()
                        blocks.write(index[-1])
                        index[-1] = b""
        if archive is None:
            return
        close_block()
        blocks.write(index[-1])
        blocks.close()
        archive.close()
        with system.open_output_stream(f"{path}/{name}.dir", compression=None) as sparse:
            sparse.write("\n".join(f"{k} {o} {n}" for k, o, n in directory).encode())
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([last]), pa.array([count], pa.int64())], names=["archive", "last", "records"])

    return write


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes archives, index and directories below ``folder``; a row per archive with its last key."""
    _open(folder)[0].create_dir(_open(folder)[1], recursive=True)
    rows = typed(pages).select("page_id", "url", "html", "key", "bytes", "digest", "refers").repartitionByRange("key").sortWithinPartitions("key")
    return Scratch(pages.sparkSession).keep(rows.mapInArrow(_written(folder), _WRITTEN), "archives")


class Shard:
    """One archive with its index; the directory is read when the first key falls into it, blocks when they are needed."""

    def __init__(self, folder: str, name: str):
        self.system, path = _open(folder)
        self.base = f"{path}/{name}"
        with self.system.open_input_file(f"{self.base}.dir") as file:
            rows = [line.rsplit(" ", 2) for line in file.read().decode().split("\n")]
        self.firsts, self.ranges = [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]
        self.blocks, self.archive = self.system.open_input_file(f"{self.base}.idx"), self.system.open_input_file(f"{self.base}.warc.gz")
        self.held, self.lines = -1, []

    def block(self, number: int) -> list[list[str]]:
        if number != self.held:
            at, size = self.ranges[number]
            self.blocks.seek(at)
            self.held, self.lines = number, [line.rsplit(" ", 2) for line in zlib.decompress(self.blocks.read(size)).decode().split("\n")]
        return self.lines

    def find(self, key: str) -> Iterator[dict]:
        """All records of a key; repeated keys can go on in the next block."""
        number = max(0, bisect_left(self.firsts, key) - 1)
        while number < len(self.firsts) and self.firsts[number] <= key:
            lines = self.block(number)
            for i in range(bisect_left(lines, key, key=lambda x: x[0]), bisect_right(lines, key, key=lambda x: x[0])):
                self.archive.seek(int(lines[i][1]))
                yield parsed(self.archive.read(int(lines[i][2])))
            number += 1

    def close(self) -> None:
        self.blocks.close()
        self.archive.close()


def read_captures(keys: DataFrame, archives: DataFrame, folder: str) -> DataFrame:
    """The records of the distinct keys in ``keys`` (column ``key``)."""
    bounds = sorted((r["last"], r["archive"]) for r in archives.select("last", "archive").collect())  # a row per writing task
    lasts, names = [b[0] for b in bounds], [b[1] for b in bounds]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                found = []
                for key in batch.column("key").slice(start, 512).to_pylist():
                    at = bisect_left(lasts, key)
                    if at == len(names):
                        continue
                    if held != at:
                        if shard:
                            shard.close()
                        shard, held = Shard(folder, names[at]), at
                    found += shard.find(key)
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=pa.schema([
                        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]))
        if shard:
            shard.close()

    # keys are tiny, but each makes a record: as many tasks read as have written
    return keys.select("key").distinct().repartitionByRange(max(1, len(names)), "key").sortWithinPartitions("key").mapInArrow(look_up, _READ)


def archived(pages: DataFrame) -> DataFrame:
    """Writes all pages and reads all of them back through the index."""
    text_batches(pages.sparkSession)
    folder = fresh_path(pages.sparkSession, "warc")
    archives = write_archives(pages, folder)
    keys = pages.select(F.col("page_id").cast("long").alias("page_id"), "url").select(capture_key().alias("key"))
    return read_captures(keys, archives, folder)


SQL = """WITH p AS (SELECT page_id, coalesce(html,'') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS n, sha256(html) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest, CASE WHEN f.first IS NULL OR f.first = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to FROM d LEFT JOIN f USING (digest)"""
