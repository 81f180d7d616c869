"""WARC archives: a writer and a PySpark Python data source.

Writing: records go to uncompressed ``.warc`` files under one folder, each task
attempt to files of its own, and every few megabytes of records are one row of a
manifest (file, offset, length) that Spark commits; files of failed attempts are
in no manifest row and are never read.

Reading (``format("warc")``): one partition per manifest row.  Headers are parsed
first; predicates on ``record_type`` and on header columns are pushed down and
decided there, and the payload of a record that is not wanted (by a predicate or
because ``payload`` is ``false``) is skipped by its Content-Length, not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.dataset as pds
import pyarrow.fs as pfs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition,
                                    IsNotNull, IsNull, StringStartsWith)

from riskweave.llm.common import written

SEGMENT_BYTES = 8 << 20
FILE_BYTES = 256 << 20
MIN_REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Columns filled from headers, which predicates may be pushed to.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
           "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "full_length": "x-full-length"}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload binary"


def _file_system(path: str) -> tuple[pfs.FileSystem, str]:
    return pfs.FileSystem.from_uri(path)


# --- Writing -------------------------------------------------------------------

def _clean(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in value)


def record(kind: str, record_id: str, uri: str | None, digest: str, payload: bytes | None, refers_to: str | None,
           full_length: int, date: str = DATE) -> bytes:
    """One WARC 1.1 record; ``payload`` None writes a revisit without a body."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + (b"\r\n" if payload is None else b"Content-Length: %d\r\n\r\n%b" % (len(payload), payload))
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_clean(uri)}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Full-Length: {full_length}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(records: DataFrame, path: str) -> None:
    """Write ``records(record_type, record_id, url, digest, payload, refers_to,
    n_bytes)`` as archives under ``path``; rows without payload are revisits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(path)
        fs.create_dir(f"{root}/data", recursive=True)
        out, name, size, begun = None, "", 0, 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": [name], "start": pa.array([begun], pa.int64()),
                                               "length": pa.array([size - begun], pa.int64())})
        for batch in batches:
            cols = [batch.column(n) for n in ("record_type", "record_id", "url", "digest", "payload", "refers_to", "n_bytes")]
            for i in range(batch.num_rows):
                if out is None:
                    name, size, begun = f"data/{uuid.uuid4().hex}.warc", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}")
                raw = record(*[c[i].as_py() for c in cols])
                out.write(raw)
                size += len(raw)
                if size - begun >= SEGMENT_BYTES:
                    yield segment()
                    begun = size
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
            if size > begun:
                yield segment()

    records.mapInArrow(run, "file string, start long, length long").write.parquet(f"{path}/manifest")


# --- Reading -------------------------------------------------------------------

class _Segment(InputPartition):
    def __init__(self, file: str, start: int, length: int):
        self.file, self.start, self.length = file, start, length


class _Window:
    """Bytes of a file by position, fetched in pieces."""

    def __init__(self, file, end: int, piece: int):
        self.file, self.end, self.piece, self.at, self.data = file, end, piece, 0, b""
        self.fetched = 0

    def get(self, start: int, n: int) -> bytes:
        if start < self.at or start + n > self.at + len(self.data):
            self.file.seek(start)
            self.at, self.data = start, self.file.read(min(max(n, self.piece), self.end - start))
            self.fetched += len(self.data)
        return self.data[start - self.at:start - self.at + n]

    def until(self, start: int, mark: bytes) -> bytes:
        """Bytes from ``start`` up to ``mark``."""
        n = 1024
        while True:
            got = self.get(start, min(n, self.end - start))
            k = got.find(mark)
            if k >= 0:
                return got[:k]
            if start + n >= self.end:
                raise ValueError(f"truncated record at {start}")
            n *= 4


def parse_headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def scan_records(file, start: int, length: int, wanted, payload: bool, piece: int = 1 << 16) -> Iterator[tuple]:
    """Rows of a segment whose headers pass ``wanted``; other records' blocks,
    and all of them without ``payload``, are stepped over."""
    end = start + length
    window = _Window(file, end, max(piece, 1 << 20) if payload else piece)
    at = start
    while at < end:
        head = window.until(at, b"\r\n\r\n")
        fields = parse_headers(head)
        body = at + len(head) + 4
        size = int(fields["content-length"])
        row = tuple(fields.get(h) for h in HEADERS.values())
        if wanted(row):
            content = None
            if payload and fields.get("warc-type") != "revisit":
                content = window.get(body, size)
                if fields.get("content-type", "").startswith("application/http"):
                    content = content[content.index(b"\r\n\r\n") + 4:]
            yield (*row, content)
        at = body + size + 4


def _test(f: Filter):
    """A function of a row's header values, or None if the filter can't be used."""
    columns = list(HEADERS)
    name = getattr(f, "attribute", ("",))
    if len(name) != 1 or name[0] not in columns:
        return None
    k = columns.index(name[0])
    if isinstance(f, (EqualTo, EqualNullSafe)):
        return lambda row: row[k] == f.value
    if isinstance(f, In):
        return lambda row: row[k] in f.value
    if isinstance(f, IsNotNull):
        return lambda row: row[k] is not None
    if isinstance(f, IsNull):
        return lambda row: row[k] is None
    if isinstance(f, StringStartsWith):
        return lambda row: row[k] is not None and row[k].startswith(f.value)
    return None


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.filters = path, payload, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if _test(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[InputPartition]:
        fs, root = _file_system(self.path)
        rows = pds.dataset(f"{root}/manifest", filesystem=fs, format="parquet").to_table().to_pylist()
        return [_Segment(r["file"], r["start"], r["length"]) for r in sorted(rows, key=lambda r: (r["file"], r["start"]))]

    def read(self, partition: _Segment) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an archive without records has no partition
            return
        tests = [_test(f) for f in self.filters]
        fs, root = _file_system(self.path)
        kind = pa.schema([*((c, pa.string()) for c in HEADERS), ("payload", pa.binary())])

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kind.types)], schema=kind)

        with fs.open_input_file(f"{root}/{partition.file}") as file:
            rows, size = [], 0
            for row in scan_records(file, partition.start, partition.length, lambda r: all(t(r) for t in tests), self.payload):
                rows.append(row)
                size += 500 + len(row[-1] or b"")
                if size >= 4 << 20:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true")


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


# --- Pages ------------------------------------------------------------------------

def page_records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Records of pages: of equal payloads of ``least`` bytes or more, the page
    with the largest id is the response and the others revisit it."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "n_bytes": F.length("payload").cast("long")})
    shared = (rows.where(F.col("n_bytes") >= least).groupBy("digest", "n_bytes")
              .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 and keeper is not null")
              .drop("n"))
    rows = rows.join(written(shared, "warc-shared"), ["digest", "n_bytes"], "left")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    again = F.coalesce(~F.col("page_id").eqNullSafe(F.col("keeper")) & F.col("keeper").isNotNull(), F.lit(False))
    return rows.select(F.when(again, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"), "url",
                       "digest", F.when(~again, F.col("payload")).alias("payload"),
                       F.when(again, urn("keeper")).alias("refers_to"), "n_bytes")


def _page_number(c: str) -> Column:
    return F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def page_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page, read back from the archives: page_id,
    payload_bytes, payload_digest, record_type, refers_to.  Responses are
    measured on the payload that is read; revisits have their headers read only.

    Null html is an empty payload; a missing id stays null; repeated rows of the
    kept id are all responses; an empty table gives an empty archive.
    """
    responses = read(spark, path).where(F.col("record_type") == "response").select(
        _page_number("record_id").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = read(spark, path, payload=False).where(F.col("record_type") == "revisit").select(
        _page_number("record_id").alias("page_id"), F.col("full_length").cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
        _page_number("refers_to").alias("refers_to"))
    return responses.unionByName(revisits)


PAGES_SQL = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper FROM q)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM k"""
