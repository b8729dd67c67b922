"""WARC archives: a writer with revisit records and a splittable reader.

Every record is a gzip member of its own. Spark's text sink writes the members, with an empty gzip
member as the end of each line: so archives get to every file system that Spark reaches, and only
files of committed tasks are ever seen. By the gzip format, members follow each other as they are.

The reader gets byte ranges, not files: a task scans its range for the gzip magic, takes a place for
a record if the bytes there decode to a whole member with a WARC header, goes on from member to
member, and owns the records that start inside its range, reading past its end for the last one.
Junk between members is passed over, so the records found do not depend on the ranges. (Only where
a payload is itself a WARC archive that gzip stored as it is may a range that begins inside of it
take its records for records of the file.)

Ranges are read through pyarrow's file systems from the tasks. Where those know no way to a file,
Spark's text source brings the ranges, from any file system that Spark reaches: with the gzip magic
as its line separator, a task gets what follows each magic that lies in its range, and the same
search runs over these bytes. A record that runs on past the last magic of its range is finished
in a second step, with the ranges that follow.
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactmill.session import bounded_batches, broadcast_if_small, discard, materialise

SPLIT_BYTES = 4 << 20
#: Ranges, at most; where there would be more, they get larger.
MOST_SPLITS = 100_000
#: Payloads of fewer bytes are never revisits.
SMALLEST_REVISIT = 100
LEVEL = 6
_MAGIC = b"\x1f\x8b\x08"
#: A gzip member without content.
EMPTY_MEMBER = _MAGIC + b"\0" * 5 + b"\0\x03\x03\0" + b"\0" * 8
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_STEP = 1 << 20
_FEED = 16 << 10
_NEAR = 64
_BATCH_BYTES = 8 << 20


def open_uri(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a uri; a single slash after file: is allowed."""
    path = re.sub(r"^file:/(?!/)", "file:///", re.sub(r"^s3[an]://", "s3://", path))
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path)


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes) of the files that a path or a pattern names, or that a folder holds."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(place) or []:
        found += system.listStatus(status.getPath()) if status.isDirectory() else [status]
    files = [(str(f.getPath()), f.getLen()) for f in found if f.isFile() and f.getPath().getName()[0] not in "_."]
    return spark.createDataFrame(sorted(files), "file string, bytes long")


# ------------------------------------------------------------------ write


def _record(kind: str, page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        # white space and control characters would break the header
        head.append(f"WARC-Target-URI: {quote(url, safe='%/:?#[]@!$&()*+,;=~')}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    lines = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = f"{lines}Content-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _members(batches):
    for batch in batches:
        held, weight = [], 0
        for r in batch.to_pylist():
            packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            raw = _record(r["kind"], r["id"], r["url"], (r["payload"] or "").encode(), r["digest"], r["refers_to"])
            held.append(packer.compress(raw) + packer.flush())
            weight += len(held[-1])
            if weight > _BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["member"])
                held, weight = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["member"])


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """Write a record per row to path and return (file, bytes), one row for each archive.

    Of the records with equal payloads of at least SMALLEST_REVISIT bytes, that with the least id is
    a response and the others revisit it. Smaller payloads are all responses. A null payload is
    empty, a null url has no target header, a null id has an empty record id; a null id is never
    the least one, and where a payload has null ids alone, all its records are responses. Rows that
    repeat the least id are all responses. Extra columns are ignored. An empty table writes nothing.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(payload_col, F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2(F.encode("payload", "UTF-8"), 256))
    firsts = (
        rows.where(F.octet_length("payload") >= SMALLEST_REVISIT)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    firsts, firsts_path = materialise(firsts, "firsts")
    rows = rows.join(broadcast_if_small(firsts, firsts.count(), 100), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = rows.select(
        "id",
        "url",
        "payload",
        "digest",
        F.when(again, "revisit").otherwise("response").alias("kind"),
        F.when(again, F.col("first")).alias("refers_to"),
    )
    members = rows.mapInArrow(_members, "member binary").select(F.col("member").cast("string").alias("value"))
    # the bytes are written as they are; the encoding is that of the line ends
    members.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    discard(spark, firsts_path)
    return list_archives(spark, path).where("bytes > 0")


# ------------------------------------------------------------------- read


class _Window:
    """Buffered reads at any place of a file."""

    def __init__(self, file, size: int):
        self.file, self.size, self.base, self.data = file, size, 0, b""

    def at(self, pos: int, n: int) -> memoryview:
        n = min(n, self.size - pos)
        if pos < self.base or pos + n > self.base + len(self.data):
            self.file.seek(pos)
            self.base, self.data = pos, self.file.read(max(n, _STEP))
        return memoryview(self.data)[pos - self.base : pos - self.base + n]


class _Part(_Window):
    """The window of a part of a file, where what comes behind the part is not at hand."""

    def at(self, pos: int, n: int) -> memoryview:
        if pos >= self.size:
            raise EOFError
        return super().at(pos, n)


_FIELD = re.compile(rb"[^\x00-\x20\x7f:]+:|[ \t]")


def _is_record(raw: bytes | bytearray) -> bool:
    """Whether a decoded member is a WARC record: a version, header fields, and a whole block."""
    end = raw.find(b"\r\n\r\n")
    version, *fields = bytes(raw[: max(end, 0)]).split(b"\r\n")
    if not re.fullmatch(rb"WARC/[0-9]+\.[0-9]+", version) or not all(map(_FIELD.match, fields)):
        return False
    length = next((f.partition(b":")[2].strip() for f in fields if f.lower().startswith(b"content-length:")), b"")
    return length.isdigit() and len(raw) - end - 4 >= int(length)


def _member(window: _Window, pos: int) -> tuple[bytes, int] | None:
    """(decoded member, where it ends), or None if the bytes at pos are no gzipped WARC record."""
    unpack, raw, at = zlib.decompressobj(31), bytearray(), pos
    try:
        while not unpack.eof:
            piece = window.at(at, _FEED)
            if not len(piece):
                return None
            raw += unpack.decompress(piece)
            at += len(piece)
            if not raw.startswith(b"WARC/"[: len(raw)]):
                return None
    except zlib.error:
        return None
    return (bytes(raw), at - len(unpack.unused_data)) if _is_record(raw) else None


def read_range(window: _Window, start: int, end: int) -> Iterator[tuple[int, bytes | None]]:
    """(place, decoded record) of the records that start in start..end-1.

    Where a part of a file ends within what may be a record, its place with None is the last.
    """
    pos, step = start, _NEAR
    while pos < min(end, window.size):
        piece = bytes(window.at(pos, min(step, end - pos + len(EMPTY_MEMBER))))
        if piece.startswith(EMPTY_MEMBER):
            pos += len(EMPTY_MEMBER)
            continue
        found = piece.find(_MAGIC)
        if found < 0:
            # the next one is near behind a record, and far within one
            pos, step = pos + max(1, len(piece) - len(_MAGIC) + 1), min(8 * step, _STEP)
            continue
        pos, step = pos + found, _NEAR
        if pos >= end:
            return
        try:
            got = _member(window, pos)
        except EOFError:
            yield pos, None
            return
        if got:
            yield pos, got[0]
        pos = got[1] if got else pos + 1


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with lower-case names, block) of a decoded record."""
    head, _, body = raw.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    return headers, body[: int(length)] if length.isdigit() else body


_COLUMNS = (
    "file string, offset long, kind string, record_id string, uri string, refers_to string, digest string, length long, "
    "payload binary"
)


def _parsed(file: str, pos: int, raw: bytes) -> tuple:
    """The row of a decoded record."""
    headers, block = parse(raw)
    payload = block.partition(b"\r\n\r\n")[2]
    kind = headers.get("warc-type")
    given = headers.get("x-payload-length", "")
    return (
        file, pos, kind, headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-refers-to"),
        headers.get("warc-payload-digest"), int(given) if given.isdigit() else len(payload),
        payload if kind == "response" else None,
    )


def _schema(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, columns.split(", "))])


def _batched(rows: Iterator[tuple], columns: str):
    """Batches of rows, by their bytes."""
    schema, held, weight = _schema(columns), [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], t) for k, t in enumerate(schema.types)], schema=schema)

    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, bytes)) + 200
        if weight > _BATCH_BYTES:
            yield flush()
            held, weight = [], 0
    if held:
        yield flush()


def _ranges(batches):
    """Rows (file, bytes, start, end) -> records, by reading the ranges."""

    def found():
        for batch in batches:
            for split in batch.to_pylist():
                system, path = open_uri(split["file"])
                with system.open_input_file(path) as file:
                    window = _Window(file, split["bytes"])
                    for pos, raw in read_range(window, split["start"], split["end"]):
                        yield _parsed(split["file"], pos, raw)

    return _batched(found(), _COLUMNS)


#: Rows of records; of ranges, with the bytes of their `chunk`; and of those places where a chunk ends within
#: what may be a record, with the bytes `rest` from there up to the range `upto`, `own` of them in the place's range.
_FOUND = f"{_COLUMNS}, begin long, total long, chunk long, own long, upto long, rest binary"


def _search(file: str, begin: int, total: int, data: bytes, at: int, own: int, upto: int, whole: bool):
    """Rows of what starts in the first `own` bytes of data, which are at `at` in their chunk."""
    window = (_Window if whole else _Part)(io.BytesIO(data), len(data))
    for pos, raw in read_range(window, 0, own):
        if raw is None:
            yield (file, at + pos, *[None] * 7, begin, total, None, own - pos, upto, data[pos:])
        else:
            yield (*_parsed(file, at + pos, raw), begin, total, *[None] * 4)


def _chunks(batches):
    """(file, begin, total, data) of the ranges: data goes from the range's first magic (in the first range, from
    the start of the file) to the first magic behind the range, so that the data of all ranges are the file."""

    def lines():
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    for (file, begin, total), found in groupby(lines(), lambda r: r[:3]):
        yield file, begin, total, (_MAGIC if begin else b"") + _MAGIC.join(r[3] for r in found)


def _search_chunks(split_bytes: int):
    def run(batches):
        def found():
            for file, begin, total, data in _chunks(batches):
                yield (file, *[None] * 8, begin, total, len(data), *[None] * 3)
                yield from _search(file, begin, total, data, 0, len(data), begin, begin + split_bytes >= total)

        return _batched(found(), _FOUND)

    return run


def _search_on(split_bytes: int, reach: int):
    """Search the rest of a chunk with the chunks of the next `reach` ranges behind it."""

    def run(table: pa.Table) -> pa.Table:
        rest, *behind = sorted(table.to_pylist(), key=lambda r: r["upto"])
        file, begin, total = rest["file"], rest["begin"], rest["total"]
        data = b"".join([rest["rest"], *(r["rest"] for r in behind)])
        upto = rest["upto"] + reach * split_bytes
        rows = _search(file, begin, total, data, rest["offset"], rest["own"], upto, upto + split_bytes >= total)
        return pa.Table.from_batches(_batched(rows, _FOUND), _schema(_FOUND))

    return run


@contextmanager
def _split_files(spark: SparkSession, split_bytes: int):
    """Files are read in ranges of exactly split_bytes, whatever the number of cores."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(key) for key in keys]
    try:
        for key in keys:
            spark.conf.set(key, str(split_bytes))
        yield
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)


def _lines(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """(file, begin, total, value): what follows each gzip magic (and what comes before the first one), by the range.

    Spark's text source would unpack files by the ends of their names. An extension that sorts between such an end
    and the names themselves keeps Hadoop from finding the codec.
    """
    jvm = spark.sparkContext._jvm
    packing, path = jvm.org.apache.hadoop.io.compress, jvm.org.apache.hadoop.fs.Path
    codecs = packing.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    groups: dict[str, list[str]] = {}
    for name in names.values():
        codec = codecs.getCodec(path(name))
        groups.setdefault(codec.getDefaultExtension() if codec else "", []).append(re.sub(r"([\\\[\]{}*?])", r"\\\1", name))
    lines = None
    for extension, files in groups.items():
        reader = spark.read.option("lineSep", _MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1")
        if extension:
            reader = reader.option("io.compression.codecs", "org.apache.hadoop.io.compress.PassthroughCodec")
            reader = reader.option(packing.PassthroughCodec.OPT_EXTENSION, f".\x01{extension}")
        some = reader.text(files).select(
            F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("file"),
            F.col("_metadata.file_block_start").alias("begin"),
            F.col("_metadata.file_size").alias("total"),
            F.col("value").cast("binary").alias("value"),
        )
        lines = some if lines is None else lines.unionAll(some)
    return lines


def _uri(spark: SparkSession, name: str) -> str:
    """A file's name as Spark's readers give it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    place = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place)
    return re.sub("^file:/+", "file:/", place.toUri().toString())


def _starts_with_mark(spark: SparkSession, name: str) -> bool:
    """Whether a file starts with the byte order mark of UTF-8, which Spark's text source leaves out."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
    try:
        return [stream.read() for _ in range(3)] == [0xEF, 0xBB, 0xBF]
    finally:
        stream.close()


def _read_by_spark(spark: SparkSession, places: DataFrame, split_bytes: int) -> DataFrame:
    """The records of files that only Spark reaches, in ranges of split_bytes.

    The records found are a table in the shared folder. Records that their range's bytes do not finish (where gzip
    magic lies in a record, behind its range) are finished with the next range, then two more, then four.
    """
    bounded_batches(spark)
    given = [r["file"] for r in places.select("file").collect()]  # as many as tasks wrote
    uris = [_uri(spark, name) for name in given]
    names = dict(zip(uris, given))
    with _split_files(spark, split_bytes):
        found, _ = materialise(_lines(spark, names).mapInArrow(_search_chunks(split_bytes), _FOUND), "records")
        parts, reach = [found], 1
        while files := parts[-1].where("rest is not null").select("file").distinct().collect():
            rest = parts[-1].where("rest is not null")
            last = F.least(F.col("upto") + reach * split_bytes, F.col("total") - 1)
            step = F.lit(split_bytes).cast("long")
            needed = rest.select("file", "begin", F.explode(F.sequence(F.col("upto") + step, last, step)).alias("upto"))
            wanted = needed.select("file", F.col("upto").alias("begin")).distinct()
            lines = _lines(spark, {r["file"]: names[r["file"]] for r in files})
            # no more rows than ranges; a shuffle would lose the order of the lines
            lines = lines.join(F.broadcast(wanted), ["file", "begin"], "left_semi")
            columns = "file string, begin long, total long, rest binary"
            chunks = lines.select("file", "begin", "total", "value").mapInArrow(
                lambda batches: _batched(_chunks(batches), columns), columns
            )
            chunks = needed.join(chunks.withColumnRenamed("begin", "upto"), ["file", "upto"])
            rows = rest.unionByName(chunks, allowMissingColumns=True).groupBy("file", "begin")
            parts.append(materialise(rows.applyInArrow(_search_on(split_bytes, reach), _FOUND), "records")[0])
            reach *= 2
    chunks = found.where("chunk is not null")
    lost = chunks.groupBy("file").agg((F.max("total") - F.sum("chunk")).alias("lost")).where("lost != 0").collect()
    marked = [r["file"] for r in lost if _starts_with_mark(spark, names[r["file"]])]
    for r in lost:
        # magic at the very end of a file separates it from nothing
        if r["lost"] - 3 * (r["file"] in marked) not in (0, len(_MAGIC)):
            raise OSError(f"{names[r['file']]}: {r['lost']} bytes were not read")
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        "file", "begin", (F.coalesce(F.sum("chunk").over(before), F.lit(0)) + F.col("file").isin(marked).cast("long") * 3).alias("at")
    )
    known = spark.createDataFrame(list(zip(uris, given)), "file string, name string")
    chunks = chunks.join(broadcast_if_small(known, len(given), 300), "file")
    records = parts[0]
    for part in parts[1:]:
        records = records.unionByName(part)
    records = records.where("chunk is null and rest is null")
    records = records.join(broadcast_if_small(chunks, chunks.count(), 450), ["file", "begin"])
    records = records.withColumns({"file": F.col("name"), "offset": F.col("at") + F.col("offset")})
    return records.select(*_schema(_COLUMNS).names)


def _reachable(file: str) -> bool:
    try:
        system, path = open_uri(file)
        return system.get_file_info(path).type == fs.FileType.File
    except (pa.ArrowException, OSError, ValueError, ImportError):
        return False


def read_archives(spark: SparkSession, archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of archives (file, bytes), one row each, read in ranges of split_bytes.

    Columns: file, offset, kind, record_id, uri, refers_to, digest, length, payload; a revisit has
    no payload. Bytes that are no record are passed over. Rows with a null file or without bytes
    have no records. Extra columns are ignored. Files that only Spark can reach are read in such
    ranges too, by Spark's text source, and their records are kept in the shared folder.
    """
    places = archives.where("file is not null and bytes > 0").select("file", "bytes")
    root = F.regexp_extract("file", "^([^/]*:(//[^/]*)?)?", 0)
    roots = places.groupBy(root.alias("root")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.min("file").alias("first"))
    roots = roots.collect()
    total, number = sum(r["bytes"] for r in roots), sum(r["n"] for r in roots)
    far = [r["root"] for r in roots if not _reachable(r["first"])]
    split_bytes = max(split_bytes, -(-total // MOST_SPLITS))
    if far and len(far) == len(roots):
        return _read_by_spark(spark, places, split_bytes)
    near = places.where(~root.isin(far)) if far else places
    begins = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    splits = near.select("file", "bytes", F.explode(begins).alias("start"))
    splits = splits.withColumn("end", F.least(F.col("start") + split_bytes, F.col("bytes")))
    tasks = max(1, number + total // split_bytes)
    records = splits.repartition(min(tasks, MOST_SPLITS), "file", "start").mapInArrow(_ranges, _COLUMNS)
    return records.unionAll(_read_by_spark(spark, places.where(root.isin(far)), split_bytes)) if far else records
