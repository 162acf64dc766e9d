"""WARC archives: written by Spark's text writer, read by a PySpark Python data source.

Writing. Pages with equal payloads of at least ``LEAST_REVISIT`` bytes are told
by digest; the one with the smallest page_id is a ``response``, the others are
``revisit`` records that refer to it and carry headers only. A record is one
value of Spark's text writer whose line separator is the blank line that ends a
WARC record, so writing goes through Spark's own commit protocol to whatever
store the session knows; a repeated task leaves no second copy.

Reading (``format("warc")``). Partitions are planned over the files: files are
dealt, largest first, into parts of about ``partBytes``. A partition parses a
record's header block first. Predicates on record type and named headers are
taken from the filter (or from the options ``recordTypes`` and
``header.<Name>``), and a record that fails them, like the payload of a query
that doesn't ask for it, is passed over by its content length, never decoded.

Defined cases: null html is an empty payload; a null url leaves out its header;
rows without page_id are written and read back with a null id, they never serve
as the record others refer to; rows that repeat a page_id are records of their
own; an empty table gives empty archives. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from emberlog.session import scratch_path

LEAST_REVISIT = 100
# fixed values: names and profile of the WARC 1.1 format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"
DATE = "1970-01-01T00:00:00Z"

SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
          "block_length long, payload_length long, headers map<string,string>, payload binary")
HEADER_OF = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
             "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}


def with_record_types(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, bytes, digest, first``: ``first`` is the smallest page_id with the same large payload."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    shared = rows.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    return rows.join(shared.where("n > 1").drop("n"), "digest", "left")


def write_warc(pages: DataFrame, path: str, compression: str = "gzip", records_per_file: int = 50_000) -> None:
    """Archives of one record per page below ``path``, at most ``records_per_file`` in a file."""
    rows = with_record_types(pages)
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    urn = lambda c: F.concat(F.lit(f"<{PAGE_URN}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit("\r\n\r\n"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    payload = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    record = F.concat(
        F.lit(f"{VERSION}\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))), line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20]+", " ")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("first"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.octet_length(payload)).cast("string")), F.lit("\r\n"), http, payload)
    out = rows.select(record.alias("value")).write.mode("overwrite").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file)
    if compression:
        out = out.option("compression", compression)
    out.text(path)


class FilePart(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


def _store(path: str):
    """The file system of a path or URI, and the path inside it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Input:
    """Sequential bytes with a cheap skip: seeks in plain files, reads on in compressed ones."""

    def __init__(self, store, name: str):
        raw = store.open_input_file(name)
        self.seeks = not name.endswith(".gz")
        self.file = io.BufferedReader(raw, 1 << 20) if self.seeks else gzip.GzipFile(fileobj=raw)

    def line(self) -> bytes:
        return self.file.readline()

    def read(self, n: int) -> bytes:
        out = self.file.read(n)
        if len(out) < n:
            raise ValueError("a WARC record ends before its content length")
        return out

    def skip(self, n: int) -> None:
        if self.seeks:
            self.file.seek(n, io.SEEK_CUR)
            return
        while n > 0:
            got = len(self.file.read(min(n, 1 << 20)))
            if not got:
                raise ValueError("a WARC record ends before its content length")
            n -= got


def _block_of_headers(source: _Input) -> dict[str, str]:
    out = {}
    while (line := source.line().rstrip(b"\r\n")):
        name, _, value = line.partition(b":")
        out[name.decode("utf-8", "replace").strip()] = value.decode("utf-8", "replace").strip()
    return out


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns = [f.name for f in schema.fields]
        self.path = options["path"]
        self.part_bytes = int(options.get("partbytes", 64 << 20))
        self.equal = {"WARC-Type": set(t.strip() for t in options["recordtypes"].split(","))} if options.get("recordtypes") else {}
        for key, value in options.items():
            if key.lower().startswith("header."):
                self.equal.setdefault(key[7:].lower(), set()).add(value)
        self.equal = {k.lower(): v for k, v in self.equal.items()}

    def pushFilters(self, filters):
        """Equality on the columns that are headers is decided here, before a payload is touched."""
        for f in filters:
            known = isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADER_OF
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else set()
            if known and None not in values:
                name = HEADER_OF[f.attribute[0]].lower()
                self.equal[name] = self.equal[name] & values if name in self.equal else values
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        store, base = _store(self.path)
        found = store.get_file_info(fs.FileSelector(base, recursive=True))
        files = sorted((-f.size, f.path) for f in found if f.type == fs.FileType.File and f.size and not f.base_name.startswith((".", "_")))
        n = max(1, min(len(files), -(-sum(-s for s, _ in files) // self.part_bytes)))
        parts: list[list[str]] = [[] for _ in range(n)]
        loads = [0] * n
        for size, name in files:
            k = loads.index(min(loads))
            parts[k].append(name)
            loads[k] -= size
        return [FilePart(p) for p in parts]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        rows: list[list] = []
        held = 0
        for name in partition.files:
            for row in self.records(_Input(store, name)):
                rows.append(row)
                held += len(row[self.columns.index("payload")] or b"") if "payload" in self.columns else 0
                if len(rows) >= 4096 or held >= 8 << 20:
                    yield self.batch(rows)
                    rows, held = [], 0
        if rows:
            yield self.batch(rows)

    def records(self, source: _Input) -> Iterator[list]:
        while first := source.line():
            if not first.strip():
                continue
            if not first.startswith(b"WARC/"):
                raise ValueError("not a WARC record")
            headers = _block_of_headers(source)
            known = {k.lower(): v for k, v in headers.items()}
            length = int(known.get("content-length", 0))
            if any(known.get(k) not in v for k, v in self.equal.items()):
                source.skip(length)
                continue
            payload_length, payload = None, None
            left = length
            if "payload" in self.columns or "payload_length" in self.columns:
                if known.get("content-type", "").startswith("application/http"):
                    inner = 0
                    while inner < length:
                        line = source.line()
                        inner += len(line)
                        if line.lower().startswith(b"content-length:"):
                            payload_length = int(line.split(b":", 1)[1])
                        if not line.strip():
                            break
                    left = length - inner
                payload_length = left if payload_length is None else payload_length
                if "payload" in self.columns:
                    payload, left = source.read(left), 0
            source.skip(left)
            values = {"block_length": length, "payload_length": payload_length, "headers": headers, "payload": payload}
            yield [values[c] if c in values else known.get(HEADER_OF[c].lower()) for c in self.columns]

    def batch(self, rows: list[list]) -> pa.RecordBatch:
        kinds = {"block_length": pa.int64(), "payload_length": pa.int64(), "headers": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}
        columns = [pa.array([list(v.items()) if isinstance(v, dict) else v for v in c], kinds.get(n, pa.string())) for n, c in zip(self.columns, zip(*rows))]
        return pa.RecordBatch.from_arrays(columns, self.columns)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``; a schema of fewer columns reads less."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA, **options: str) -> DataFrame:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("warc").schema(columns)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(path)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives and read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Length and digest of a response come from the payload read back, those of a
    revisit from its headers.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    id_of = lambda c: F.regexp_extract(c, rf"^<{PAGE_URN}(-?[0-9]+)>$", 1).try_cast("long")
    whole = read_warc(spark, path, "record_type string, record_id string, payload binary").where("record_type = 'response'")
    whole = whole.select(id_of(F.col("record_id")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                         F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = read_warc(spark, path, "record_type string, record_id string, refers_to string, payload_digest string, payload_length long")
    again = again.where("record_type = 'revisit'").select(
        id_of(F.col("record_id")).alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), "record_type", id_of(F.col("refers_to")).alias("refers_to"))
    return whole.unionAll(again)
