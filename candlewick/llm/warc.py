"""Web captures as WARC archives, found again through a two-level capture index.

Every task writes its captures into archives of its own, one gzip member a record, and reports where each record lies. The
pointers are sorted by reversed-host URL key and page, cut into index files by range, and a file into compressed blocks of some thousand lines.
Beside each index file lies its sparse directory: first line, offset and length of every block. A lookup goes to the index files whose range it
meets (their bounds are the upper level), a binary search in the directory names the block, one range read brings it, a binary search in its lines gives the pointers;
range reads of the archives, neighbours together, give the records. Archives, index files and directories are plain objects below one folder
that pyarrow can open (local, HDFS, S3, GCS). A name holds the number of its task attempt, and only the rows of attempts that Spark commits name files, so lost executors
leave unused files at most.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import sized_join, store
from candlewick.session import checkpoint_folder

ARCHIVE = 1 << 30  # bytes after which a task starts another archive
LINES = 3000  # lines of an index block
PER_FILE = 300_000  # lines of an index file while there are fewer than MOST files
MOST = 4096  # index files at most: their bounds travel to every task
SPAN = 8 << 20  # bytes read from an archive at once
GAP = 1 << 16  # unwanted bytes read rather than reading twice
SMALL = 100  # payloads of fewer bytes are always written out
GZIP = 31  # window bits of a gzip member
SAFE = "/,)(:;=&?@!$'*+~#[]"  # written as they are in the key of a reference

POINTER = "key string, known int, page bigint, file string, offset bigint, length bigint"


def url_key(url: Column) -> Column:
    """``com,example,www)/path?query``: host in lower case and reversed, without scheme, user, default port and fragment; a null url is ``-``."""
    parts = lambda n: F.regexp_extract(url, r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://)?([^/?#]*)([^#]*)", n)
    host = F.regexp_replace(F.lower(F.regexp_replace(parts(2), r"(?s)^.*@", "")), r":(?:80|443)?$", "")
    path = F.when(F.startswith(parts(3), F.lit("/")), parts(3)).otherwise(F.concat(F.lit("/"), parts(3)))
    return F.when(url.isNull(), F.lit("-")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path))


def _header(fields: list[tuple[str, str | None]]) -> bytes:
    clean = lambda v: "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in v)
    told = (f"{name}: {v if name in ('WARC-Type', 'Content-Type', 'Content-Length') else clean(v)}" for name, v in fields if v is not None)
    return ("WARC/1.1\r\n" + "\r\n".join(told) + "\r\n\r\n").encode()


def record_id(page: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([page, url, digest]))}>"


def record(page: int | None, url: str | None, digest: str, payload: bytes | None, refers: tuple[int, str | None, str] | None, date: str) -> bytes:
    """One record; without a payload it is a revisit of the page that ``refers`` names by id, URL and key."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block += b"\r\n" if payload is None else b"Content-Length: %d\r\n\r\n%b" % (len(payload), payload)
    text = lambda v: None if v is None else str(v)
    fields = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", record_id(page, url, digest)), ("WARC-Date", date), ("WARC-Target-URI", url),
              ("Page-ID", text(page)), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(*refers[:2], digest)),
                   ("WARC-Refers-To-Target-URI", refers[1]), ("Refers-To-Page-ID", text(refers[0])), ("Refers-To-Key", quote(refers[2], safe=SAFE))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields) + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, payload) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def _member(raw: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, GZIP)
    return packer.compress(raw) + packer.flush()


class _Out:
    """An object of one task attempt below ``folder``; ``put`` returns where the bytes lie."""

    def __init__(self, folder: str, kind: str, number: int = 0):
        task = TaskContext.get()
        self.fs, root = FileSystem.from_uri(f"{folder}/{kind}")
        self.fs.create_dir(root, recursive=True)
        self.name = f"{kind}/{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}-{number}"
        self.stream, self.at = self.fs.open_output_stream(f"{root}/{self.name.rpartition('/')[2]}"), 0

    def put(self, data: bytes) -> tuple[int, int]:
        self.stream.write(data)
        self.at += len(data)
        return self.at - len(data), len(data)

    def close(self) -> None:
        self.stream.close()


def _opened(folder: str, name: str):
    fs, path = FileSystem.from_uri(f"{folder}/{name}")
    return fs.open_input_file(path)


@dataclass
class Captures:
    """Archives below ``folder``, the pointers to their records, and the bounds of the index files in order."""

    folder: str
    pointers: DataFrame
    files: list[tuple[tuple[str, int, int], tuple[str, int, int], str, str]]  # first line, last line, index file, directory


def _uri(folder: str) -> str:
    return folder if "://" in folder else "file:" + "//" + folder.removeprefix("file:")


def write_archives(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z", level: int = 6) -> tuple[str, DataFrame]:
    """Write a record per row; returns the folder and ``key, known, page, file, offset, length`` per record.

    The payload is ``html`` in UTF-8, empty for null. Of the rows with equal payloads of at least 100 bytes the one with the smallest page id is written as a response and the
    others as revisits of it. Rows that repeat that smallest id with the same payload are all responses; rows without an id are revisits too if a
    row with an id has the payload, else responses. Control characters, blanks and unprintable characters of a URL are written in percent form, a null URL has no header. Ids are whole numbers.
    """
    spark = df.sparkSession
    folder = f"{_uri(checkpoint_folder(spark)).rstrip('/')}/candlewick-{uuid.uuid4().hex}/captures"
    rows = df.select(F.col(page_id).cast("long").alias("page"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    named = F.when(F.col("page").isNotNull(), F.struct("page", "url"))
    firsts = rows.where(F.octet_length("payload") >= SMALL).groupBy("digest").agg(F.count("*").alias("n"), F.min(named).alias("first"))
    firsts = store(firsts.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "firsts")
    # beyond 300,000 payloads that occur twice the rows are shuffled by digest; a digest of very many rows is split by adaptive execution
    rows = sized_join(rows, firsts, "digest", "left", firsts.count(), 300_000)
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first.page")), F.lit(False))
    ready = rows.select(
        url_key(F.col("url")).alias("key"), "page", "url", "digest", F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("first.page")).alias("to_page"), F.when(revisit, F.col("first.url")).alias("to_url"), F.when(revisit, url_key(F.col("first.url"))).alias("to_key"),
    )

    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number = None, 0
        for batch in stream:
            files, places = [], []
            columns = [batch.column(c) for c in ("page", "url", "digest", "payload", "to_page", "to_url", "to_key")]
            for i in range(batch.num_rows):
                page, link, digest, payload, to_page, to_url, to_key = (c[i].as_py() for c in columns)
                if out is None or out.at >= ARCHIVE:
                    if out is not None:
                        out.close()
                    out, number = _Out(folder, "archives", number), number + 1
                    info = f"software: candlewick\r\nformat: WARC File Format 1.1\r\npart: {out.name}\r\n".encode()
                    head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, out.name)}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))]
                    out.put(_member(_header(head) + info + b"\r\n\r\n", level))
                refers = (to_page, to_url, to_key) if payload is None else None
                places.append(out.put(_member(record(page, link, digest, payload, refers, date), level)))
                files.append(out.name)
            page = batch.column("page")
            offset, length = (pa.array([p[j] for p in places], pa.int64()) for j in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("key"), page.is_valid().cast(pa.int32()), page.fill_null(0), pa.array(files, pa.string()), offset, length], names=["key", "known", "page", "file", "offset", "length"])
        if out is not None:
            out.close()

    return folder, store(ready.mapInArrow(write, POINTER), "pointers")


def build_index(folder: str, pointers: DataFrame, lines: int = LINES) -> Captures:
    """Sorted index files with their directories; the driver keeps two lines for each of at most 4,096 files."""
    count = min(MOST, max(1, -(-pointers.count() // PER_FILE)))
    order = ["key", "known", "page", "file", "offset"]
    ready = pointers.repartitionByRange(count, *order).sortWithinPartitions(*order)

    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, directory, last = None, [], [], None

        def close() -> None:
            directory.append((held[0][:3], *out.put(zlib.compress(json.dumps(held).encode()))))

        for batch in stream:
            for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = _Out(folder, "index")
                held.append(line)
                if len(held) == lines:
                    close()
                    held, last = [], line
        if held:
            close()
            last = held[-1]
        if out is not None:
            out.close()
            sparse = _Out(folder, "directory")
            sparse.put(zlib.compress(json.dumps(directory).encode()))
            sparse.close()
            cells = [*directory[0][0], *last[:3], out.name, sparse.name]
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], names=["k0", "n0", "p0", "k1", "n1", "p1", "file", "directory"])

    made = store(ready.mapInArrow(write, "k0 string, n0 bigint, p0 bigint, k1 string, n1 bigint, p1 bigint, file string, directory string"), "files")
    files = sorted(((r.k0, r.n0, r.p0), (r.k1, r.n1, r.p1), r.file, r.directory) for r in made.collect())
    return Captures(folder, pointers, files)


def lookups(df: DataFrame, key: Column, page: Column | None = None, prefix: bool = False) -> DataFrame:
    """Distinct questions for :func:`find`: the captures of a key and page, of a key, or of all keys that start with ``key``."""
    exact = page is not None
    return df.select(
        key.alias("key"), (page.isNotNull().cast("int") if exact else F.lit(0)).alias("known"), (F.coalesce(page.cast("long"), F.lit(0)) if exact else F.lit(0)).cast("long").alias("page"),
        F.lit("capture" if exact else "prefix" if prefix else "url").alias("kind"),
    ).distinct()


def _matches(kind: str, asked: tuple[str, int, int], line: tuple) -> bool:
    if kind == "capture":
        return tuple(line[:3]) == asked
    return line[0].startswith(asked[0]) if kind == "prefix" else line[0] == asked[0]


class _IndexFile:
    """One index file with its directory; keeps the block read last."""

    def __init__(self, folder: str, name: str, directory: str):
        with _opened(folder, directory) as f:
            self.blocks = [(tuple(first), offset, length) for first, offset, length in json.loads(zlib.decompress(f.read()))]
        self.firsts = [b[0] for b in self.blocks]
        self.file, self.held, self.lines = _opened(folder, name), -1, []

    def block(self, i: int) -> list[tuple]:
        if i != self.held:
            _, offset, length = self.blocks[i]
            self.lines = [tuple(x) for x in json.loads(zlib.decompress(self.file.read_at(length, offset)))]
            self.held = i
        return self.lines

    def find(self, kind: str, asked: tuple[str, int, int]) -> Iterator[tuple]:
        """Lines that answer the question, from the first one not before it."""
        start = (*asked, "", -1) if kind == "capture" else (asked[0], -1, 0, "", -1)
        at = max(0, bisect_right(self.firsts, start[:3]) - 1)
        # lines equal in key and page may begin in the block before
        while at and self.firsts[at] >= start[:3]:
            at -= 1
        for i in range(at, len(self.blocks)):
            lines = self.block(i)
            for line in lines[bisect_right(lines, start) if i == at else 0 :]:
                if not _matches(kind, asked, line):
                    return
                yield line


def find(captures: Captures, asked: DataFrame) -> DataFrame:
    """Pointers of the captures that the questions of :func:`lookups` ask for; a question without an answer has no row."""
    folder, files = captures.folder, captures.files
    if not files:
        return captures.pointers.limit(0)
    lows = [f[0] for f in files]

    def route(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out = []
            for key, known, page, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                low = (key, known, page) if kind == "capture" else (key, -1, 0)
                at = max(0, bisect_right(lows, low) - 1)
                while at and lows[at] >= low:
                    at -= 1
                for i in range(at, len(files)):
                    if lows[i] > low and not _matches(kind, (key, known, page), lows[i]):
                        break
                    if files[i][1] >= low:
                        out.append((i, key, known, page, kind))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("at", "key", "known", "page", "kind"), o, strict=True)) for o in out], pa.schema([("at", pa.int32()), ("key", pa.string()), ("known", pa.int32()), ("page", pa.int64()), ("kind", pa.string())]))

    def search(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index = -1, None
        schema = pa.schema([("key", pa.string()), ("known", pa.int32()), ("page", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
        out: list[tuple] = []
        told = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        for batch in stream:
            for i, key, known, page, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if i != at:
                    at, index = i, _IndexFile(folder, files[i][2], files[i][3])
                for line in index.find(kind, (key, known, page)):
                    out.append(line)
                    if len(out) == 10_000:
                        yield told()
                        out.clear()
        if out:
            yield told()

    order = ["at", "key", "known", "page"]
    routed = asked.mapInArrow(route, "at int, key string, known int, page bigint, kind string")
    found = routed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(search, POINTER)
    return found


RECORD = "page_id bigint, url string, record_type string, digest string, refers_to bigint, refers_key string, payload_bytes bigint, payload_digest string"


def fetch(captures: Captures, pointers: DataFrame, payload: bool = False) -> DataFrame:
    """Records at the pointers, read by range: header facts, and size and digest of the payload (null in revisits); with ``payload`` also its bytes.

    A payload that does not match the digest in its header raises an error.
    """
    folder = captures.folder
    near = F.floor(F.col("offset") / (8 * SPAN))
    ready = pointers.select("file", "offset", "length").repartition("file", near).sortWithinPartitions("file", "offset")

    def spans(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        name, held = None, []
        for batch in stream:
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (file != name or offset > sum(held[-1]) + GAP or offset + length > held[0][0] + SPAN):
                    yield name, held
                    held = []
                name = file
                held.append((offset, length))
        if held:
            yield name, held

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for own, places in spans(stream):
            if own != name:
                name, file = own, _opened(folder, own)
            base = places[0][0]
            data = memoryview(file.read_at(sum(places[-1]) - base, base))
            out = []
            for offset, length in places:
                fields, body = parse(zlib.decompress(data[offset - base : offset - base + length], GZIP))
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                whole = fields["WARC-Type"] == "response"
                seen = hashlib.sha256(body).hexdigest() if whole else None
                if whole and seen != digest:
                    raise ValueError(f"{name} at {offset}: the payload does not match its digest")
                number = lambda f: int(fields[f]) if f in fields else None  # noqa: B023, E731
                out.append((number("Page-ID"), fields.get("WARC-Target-URI"), fields["WARC-Type"], digest, number("Refers-To-Page-ID"), unquote(fields["Refers-To-Key"]) if not whole else None, len(body) if whole else None, seen, body if whole else None))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()][: 9 if payload else 8]
            names = [c.split()[0] for c in RECORD.split(", ")] + ["payload"] * payload
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds)], names=names)  # noqa: B905

    return ready.mapInArrow(read, RECORD + (", payload binary" if payload else ""))


def read_pages(captures: Captures, asked: DataFrame) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest`` of the captures asked for.

    Size and digest of a revisit are those of the payload it refers to, which is itself found through the index and read once however many
    revisits share it. ``url`` is the one in the record's header.
    """
    records = store(fetch(captures, find(captures, asked)), "records")
    revisits = records.where("record_type = 'revisit'")
    wanted = lookups(revisits, F.col("refers_key"), F.col("refers_to"))
    target = fetch(captures, find(captures, wanted)).where("record_type = 'response'")
    target = target.select(F.col("page_id").alias("refers_to"), "digest", F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_seen"))
    target = store(target.groupBy("digest", "refers_to").agg(F.max("_bytes").alias("_bytes"), F.max("_seen").alias("_seen")), "targets")
    shown = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    resolved = sized_join(revisits, target, ["digest", "refers_to"], "left", target.count(), 300_000)
    resolved = resolved.withColumns({"payload_bytes": F.col("_bytes"), "payload_digest": F.col("_seen")})
    return records.where("record_type = 'response'").select(*shown).unionByName(resolved.select(*shown))


def capture(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> Captures:
    """Archives and index of all rows; see :func:`write_archives` for nulls and repeats. An empty table gives no archive and an index without files."""
    return build_index(*write_archives(df, page_id, url, html))
