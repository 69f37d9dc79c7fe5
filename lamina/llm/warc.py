"""WARC archives: a Python data source that reads and writes them, and the choice of revisit records.

``spark.read.format("warc")`` plans whole files into tasks of about equal size. Predicates on header columns are
pushed down and decided from a record's header block; a record that does not pass is skipped without
its content being read from a plain file, or kept from a compressed one. The payload is cut out of its HTTP message and
checked only for records that pass, and only if the option ``payload`` asks for it.

Predicates reach the reader in two ways. ``read_warc(where=...)`` hands them over as an option. With
``pushdown`` Spark also hands over those of ``filter``; but Spark 4.1.2 then keeps them with the relation, and
a later query on the same DataFrame without a filter gets the rows of the earlier one. So that is for DataFrames that
serve one query.

``df.write.format("warc")`` writes one record per row, each its own gzip member where ``compress`` is
set. A manifest written on commit names the files; files of failed attempts are not in it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from lamina.llm.common import small_batches, stash
from lamina.llm.files import listed, opened, written
from lamina.operators.joins import lookup_join

# Bytes of files that one task reads, and bytes after which a writer begins a new file.
TASK_BYTES = 64 << 20
FILE_BYTES = 256 << 20

# Version line, profile of a revisit, and the layout of an HTTP message's head.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest"

# Columns that are decided from the header block, by the header's name.
HEADERS = {
    "warc_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
}

SCHEMA = (
    "warc_type string, record_id string, target_uri string, warc_date string, refers_to string, payload_digest string, "
    "content_type string, payload_bytes long, payload binary"
)

# What a writer takes; the digest is the hexadecimal SHA-1 of the full payload.
WRITTEN = "warc_type string, record_id string, target_uri string, warc_date string, refers_to string, sha1 string, payload binary"


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Committed(WriterCommitMessage):
    names: list[str]


def _head(stream) -> list[bytes] | None:
    """Lines up to the next empty one; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    lines = []
    while line not in (b"\r\n", b"\n", b""):
        lines.append(line.rstrip(b"\r\n"))
        line = stream.readline()
    return lines


def _named(lines: list[bytes]) -> dict[str, str]:
    """Header fields by lower-cased name; a line that begins with a blank continues the one before."""
    found: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in (b" ", b"\t") and name:
            found[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        field, _, value = line.partition(b":")
        name = field.strip().lower().decode("utf-8", "replace")
        found[name] = value.strip().decode("utf-8", "replace")
    return found


def records(stream, passes, payload: bool, verify: bool) -> Iterator[tuple]:
    """Rows of the records of an open archive whose header fields pass."""
    import base64
    import hashlib

    while (lines := _head(stream)) is not None:
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
        fields = _named(lines[1:])
        left = int(fields.get("content-length", 0))
        if not passes(fields):
            stream.seek(left, 1)
            continue
        size, body = None, None
        if fields.get("content-type", "").startswith("application/http"):
            block = stream.read(left)
            head, _, rest = block.partition(b"\r\n\r\n")
            size = int(_named(head.split(b"\r\n")[1:]).get("content-length", len(rest)))
            left = 0
            if fields.get("warc-type") != "revisit":
                if verify:
                    digest = "sha1:" + base64.b32encode(hashlib.sha1(rest).digest()).decode()
                    if len(rest) != size or digest != fields.get("warc-payload-digest", digest):
                        raise ValueError(f"payload of {fields.get('warc-record-id')} is not what its header says")
                body = rest if payload else None
        elif payload:
            body, left = stream.read(left), 0
            size = len(body)
        if left:
            stream.seek(left, 1)
        yield (*(fields.get(h) for h in HEADERS.values()), size, body)


class WarcReader(DataSourceReader):
    """Rows of archives; header predicates are decided here, all others by Spark."""

    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "true").lower() == "true"
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))
        self.tests = [(HEADERS[c], kind, tuple(v) if kind == "in" else v) for c, kind, v in json.loads(options.get("where", "[]"))]

    def partitions(self):
        """Files, largest first, each to the task with the least so far."""
        import heapq

        files = listed(self.path, MANIFEST)
        if files:
            with opened(files[0][0]) as handle:
                names = handle.read().decode().splitlines()
            known = dict(listed(self.path, ".warc") + listed(self.path, ".warc.gz"))
            files = [(p, s) for p, s in known.items() if p.rsplit("/", 1)[-1] in set(names)]
            if len(files) < len(names):
                raise FileNotFoundError(f"files of the manifest are missing in {self.path}")
        else:
            files = listed(self.path, ".warc") + listed(self.path, ".warc.gz")
        many = max(1, min(len(files), -(-sum(s for _, s in files) // self.task_bytes)))
        tasks: list[tuple[int, int, list[str]]] = [(0, n, []) for n in range(many)]
        for path, size in sorted(files, key=lambda f: (-f[1], f[0])):
            load, n, paths = heapq.heappop(tasks)
            paths.append(path)
            heapq.heappush(tasks, (load + size, n, paths))
        return [Files(paths) for _, _, paths in sorted(tasks, key=lambda t: t[1]) if paths] or [Files([])]

    def _passes(self, fields: dict[str, str]) -> bool:
        for header, kind, wanted in self.tests:
            value = fields.get(header)
            if kind == "there":
                if (value is not None) != wanted:
                    return False
            elif value is None or (value not in wanted if kind == "in" else not value.startswith(wanted)):
                return False
        return True

    def read(self, partition):
        import gzip

        import pyarrow as pa

        kinds = [pa.string()] * len(HEADERS) + [pa.int64(), pa.binary()]
        names = [*HEADERS, "payload_bytes", "payload"]

        def batch(rows):
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for path in partition.paths:
            rows, size = [], 0
            with opened(path) as handle:
                stream = gzip.GzipFile(fileobj=handle) if path.endswith(".gz") else handle
                for row in records(stream, self._passes, self.payload, self.verify):
                    rows.append(row)
                    size += 512 + len(row[-1] or b"")
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
            if rows:
                yield batch(rows)


class PushdownReader(WarcReader):
    """Also takes the header predicates that Spark hands over; a reader that has this method must be given them."""

    def pushFilters(self, filters):  # noqa: N802
        for one in filters:
            test = self._test(one)
            if test is None:
                yield one
            else:
                self.tests.append(test)

    @staticmethod
    def _test(one) -> tuple | None:
        if len(getattr(one, "attribute", ())) != 1 or one.attribute[0] not in HEADERS:
            return None
        header = HEADERS[one.attribute[0]]
        if isinstance(one, EqualTo) or isinstance(one, EqualNullSafe) and one.value is not None:
            return header, "in", (one.value,)
        if isinstance(one, In):
            return header, "in", tuple(v for v in one.value if v is not None)
        if isinstance(one, StringStartsWith):
            return header, "starts", one.value
        if isinstance(one, IsNotNull):
            return header, "there", True
        if isinstance(one, IsNull):
            return header, "there", False
        return None


def _line(name: str, value: str | None) -> bytes:
    if value is None:
        return b""
    return f"{name}: {''.join(c if c.isprintable() else '%%%02X' % ord(c) for c in value)}\r\n".encode("utf-8", "replace")


def record(kind: str, name: str, uri: str | None, date: str, refers_to: str | None, sha1: str, payload: bytes | None, size: int) -> bytes:
    """One record: for a revisit only the HTTP head, which still gives the payload's size."""
    import base64

    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + (payload or b"") if kind == "response" else head
    lines = [
        VERSION + b"\r\n",
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", name),
        _line("WARC-Target-URI", uri),
        _line("WARC-Date", date),
        _line("WARC-Refers-To", refers_to),
        _line("WARC-Profile", SAME_PAYLOAD if kind == "revisit" else None),
        _line("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", str(len(block))),
        b"\r\n",
    ]
    return b"".join([*lines, block, b"\r\n\r\n"])


def info_record(name: str, date: str) -> bytes:
    """The record that describes an archive, at its beginning."""
    block = b"format: WARC File Format 1.1\r\n"
    lines = [
        VERSION + b"\r\n",
        _line("WARC-Type", "warcinfo"),
        _line("WARC-Record-ID", f"urn:uuid:{name}"),
        _line("WARC-Date", date),
        _line("Content-Type", "application/warc-fields"),
        _line("Content-Length", str(len(block))),
        b"\r\n",
    ]
    return b"".join([*lines, block, b"\r\n\r\n"])


class WarcWriter(DataSourceArrowWriter):
    """Archives of about ``filebytes``, one or more per task, and a manifest of them."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.compress = options.get("compress", "true").lower() == "true"
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator):
        import uuid
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        # A name of this attempt's own: only what is committed is ever read.
        stem = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        names: list[str] = []
        out, size = None, 0

        def packed(data: bytes) -> bytes:
            if not self.compress:
                return data
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            return packer.compress(data) + packer.flush()

        for batch in iterator:
            for kind, name, uri, date, refers, sha1, payload in zip(*[c.to_pylist() for c in batch.columns]):
                data = record(kind, name, uri, date, refers, sha1, payload, len(payload or b""))
                data = packed(data)
                if out is None or size > self.file_bytes:
                    if out is not None:
                        out.__exit__(None, None, None)
                    names.append(f"{stem}-{len(names)}.warc" + (".gz" if self.compress else ""))
                    out, size = written(f"{self.path}/{names[-1]}"), 0
                    handle = out.__enter__()
                    handle.write(packed(info_record(str(uuid.uuid4()), date)))
                handle.write(data)
                size += len(data)
        if out is not None:
            out.__exit__(None, None, None)
        return Committed(names)

    def commit(self, messages):
        with written(f"{self.path}/{MANIFEST}") as handle:
            handle.write("".join(f"{n}\n" for m in messages if m is not None for n in m.names).encode())

    def abort(self, messages):
        """Nothing to undo: without a manifest that names them the files are not read."""


class WarcSource(DataSource):
    """``format("warc")``; options ``path``, ``where``, ``pushdown``, ``payload``, ``verify``, ``taskBytes``; for writing ``compress``, ``fileBytes``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        options = {k.lower(): v for k, v in self.options.items()}
        return (PushdownReader if options.get("pushdown") == "true" else WarcReader)(options)

    def writer(self, schema, overwrite):
        return WarcWriter({k.lower(): v for k, v in self.options.items()})


def read_warc(
    spark: SparkSession,
    path: str,
    where: Mapping[str, str | Sequence[str]] | None = None,
    starts: Mapping[str, str] | None = None,
    payload: bool = True,
    pushdown: bool = False,
    **options: str,
) -> DataFrame:
    """Records of the archives in a folder whose headers pass, decided before their content is decoded.

    ``where`` names values of header columns, one or several of which must be met; ``starts`` names prefixes. A record
    without the header does not pass. Without ``payload`` that column is NULL and nothing is cut out. With ``pushdown``
    the predicates of the query's own filters are pushed down too; the result is for one query then.
    """
    tests: list[tuple] = [(c, "in", [v] if isinstance(v, str) else list(v)) for c, v in (where or {}).items()]
    tests += [(c, "starts", v) for c, v in (starts or {}).items()]
    unknown = [c for c, _, _ in tests if c not in HEADERS]
    if unknown:
        raise ValueError(f"not header columns: {unknown}")
    spark.dataSource.register(WarcSource)
    if pushdown:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    flags = {"payload": str(payload).lower(), "pushdown": str(pushdown).lower()}
    return spark.read.format("warc").options(where=json.dumps(tests), **flags, **options).load(path)


def write_warc(rows: DataFrame, path: str, **options: str) -> None:
    """Write rows with the columns of ``WRITTEN`` as archives into a new folder."""
    small_batches(rows.sparkSession)
    rows.sparkSession.dataSource.register(WarcSource)
    columns = [part.split()[0] for part in WRITTEN.split(", ")]
    rows.select(*columns).write.format("warc").mode("append").options(**options).save(path)


def as_records(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    body: str = "html",
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    prefix: str = "urn:record:",
) -> DataFrame:
    """One row of ``WRITTEN`` per page: of pages with equal payloads the one with the least id is the response.

    The others are revisits that refer to it; payloads of fewer than ``least_bytes`` bytes are all
    responses. A NULL body is empty, and a NULL id never is the least: pages whose payload only occurs without an
    id are responses. Rows that repeat the least id are responses too. Payloads are equal if their
    SHA-1 and their sizes are.

    Payloads are compared by digest: the least id of each is an aggregate of one small row per task and digest. Only
    digests that occur twice are kept, in a stored table of known size: where it is small, payloads are not shuffled to meet it, and else the
    join can be split where one payload is very common.
    """
    payload = F.encode(F.coalesce(F.col(body), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload")})
    many = rows.filter(F.col("size") >= least_bytes).groupBy("sha1", "size").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = stash(many.filter("n > 1").drop("n"), "repeated-payloads")
    joined = lookup_join(rows, first, ["sha1", "size"])
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit(prefix), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("warc_type"),
        name("id").alias("record_id"),
        "target_uri",
        F.lit(date).alias("warc_date"),
        F.when(again, name("first")).alias("refers_to"),
        "sha1",
        "payload",
    )
