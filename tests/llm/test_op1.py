import gzip
import hashlib
import random
import zlib
from urllib.parse import unquote

import pytest
from pyarrow import fs

from contactmill.llm import queries, warc


def archive(tmp_path, rows, spark):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, kind string")
    return warc.write_archives(df, f"file://{tmp_path}/a")


def test_round_trip(spark, tmp_path):
    big = "<p>ä" * 60
    rows = [
        (5, "http://a/b c\nd", big, "x"), (3, None, big, "x"), (3, "http://a", big, "x"), (None, "u", big, "x"),
        (1, "u", None, "x"), (2, "u", "", "x"), (8, "u", "short", "x"), (7, "u", "short", "x"),
        (9, "u", "\x1f\x08WARC/1.1\r\n\r\n" * 20, "x"),
    ]
    written = archive(tmp_path, rows, spark)
    for split in (7, 150, 10**6):
        got = warc.read_archives(spark, written, split).collect()
        assert len(got) == len(rows)
        kinds = sorted((r["record_id"], r["kind"], r["refers_to"], r["length"]) for r in got)
        n = len(big.encode())
        assert kinds == sorted([
            ("<urn:page:5>", "revisit", "<urn:page:3>", n), ("<urn:page:3>", "response", None, n),
            ("<urn:page:3>", "response", None, n), ("<urn:page:>", "revisit", "<urn:page:3>", n),
            ("<urn:page:1>", "response", None, 0), ("<urn:page:2>", "response", None, 0),
            ("<urn:page:8>", "response", None, 5), ("<urn:page:7>", "response", None, 5),
            ("<urn:page:9>", "response", None, 280),
        ], key=lambda x: x)
        for r in got:
            assert r["kind"] == "revisit" or r["digest"] == "sha256:" + hashlib.sha256(r["payload"]).hexdigest()


def test_empty(spark, tmp_path):
    written = archive(tmp_path, [], spark)
    assert written.count() == 0 and warc.read_archives(spark, written).count() == 0


def member(text):
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(text) + c.flush()


@pytest.mark.parametrize("split", [1, 13, 100, 5000])
def test_every_record_is_owned_once(tmp_path, split):
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    file = tmp_path / "x.gz"
    junk = b"\x1f\x8b\x08\x00 no member \x1f\x8b"
    file.write_bytes(member(good) + junk + member(good * 50) + member(b"not a record") + member(good) + member(good))
    size = file.stat().st_size
    found = []
    for start in range(0, size, split):
        with fs.LocalFileSystem().open_input_file(str(file)) as f:
            found += [p for p, _ in warc.read_range(warc._Window(f, size), start, min(size, start + split))]
    first = len(member(good)) + len(junk)
    second = first + len(member(good * 50))
    last = second + len(member(b"not a record"))
    assert sorted(found) == [0, first, last, last + len(member(good))]


def test_archives_are_gzip_files(spark, tmp_path):
    """Any gzip reader finds the records one behind the other."""
    written = archive(tmp_path, [(i, "u", f"page {i}", "x") for i in range(5)], spark).collect()
    whole = b"".join(gzip.open(r["file"].removeprefix("file:")).read() for r in written)
    assert [whole.count(f"page {i}\r\n".encode()) for i in range(5)] == [1] * 5 and whole.count(b"WARC/1.1\r\n") == 5


def test_files_that_only_spark_reaches(spark, tmp_path, monkeypatch):
    written = archive(tmp_path, [(i, "u", f"page {i}" * 50, "x") for i in range(40)], spark)
    want = sorted((r["file"], r["offset"], r["payload"]) for r in warc.read_archives(spark, written, 100).collect())
    monkeypatch.setattr(warc, "_reachable", lambda file: False)
    got = sorted((r["file"], r["offset"], r["payload"]) for r in warc.read_archives(spark, written, 100).collect())
    assert len(got) == 40 and got == want


def test_what_is_no_record():
    for raw in (b"", b"WARC/1.0", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort", b"WARC/x\r\nContent-Length: 0\r\n\r\n",
                b"WARC/1.1\r\nno field\r\nContent-Length: 0\r\n\r\n", b"WARC/1.1\r\n\r\n"):
        assert not warc._is_record(raw)
    assert warc._is_record(b"WARC/1.0\r\nContent-Length: 2\r\nA: b\r\n c\r\n\r\nok\r\n\r\n")


def test_query(spark, tiny):
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    got = queries.op1_warc(spark, tiny).collect()
    assert {r["page_id"]: r["payload_digest"] for r in got} == {
        p: hashlib.sha256((h or "").encode()).hexdigest() for p, h in rows.items()
    }


def test_long_urls(spark, tmp_path):
    rng = random.Random(5)
    urls = {n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789ABCDEFäöüßéñж", k=n)) for n in (10, 70_000, 1_000_000)}
    written = archive(tmp_path, [(n, u, f"page {n}", "x") for n, u in urls.items()], spark)
    for split in (20_000, 10**6):
        got = {r["record_id"]: r for r in warc.read_archives(spark, written, split).collect()}
        assert sorted(got) == sorted(f"<urn:page:{n}>" for n in urls)
        for n, u in urls.items():
            assert unquote(got[f"<urn:page:{n}>"]["uri"]) == u and got[f"<urn:page:{n}>"]["payload"] == f"page {n}".encode()


def test_ranges_of_files_that_only_spark_reaches(spark, tmp_path):
    """No file is read whole (whole ones would be refused here), and the records are those that a search of the file finds."""
    rng = random.Random(3)

    def record(payload, level):
        c = zlib.compressobj(level, zlib.DEFLATED, 31)
        return c.compress(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(payload), payload)) + c.flush()

    data = b"\xef\xbb\xbf"
    for k in range(25):
        magic = warc._MAGIC * rng.choice([1, 40, 400])
        data += rng.choice([record(magic, 0), record(magic, 6), record(rng.randbytes(900), 6), magic, warc.EMPTY_MEMBER, member(magic)])
    data += record(warc._MAGIC * 300, 0)[:-9]
    (tmp_path / "a.warc.gz").write_bytes(data + warc._MAGIC)
    (tmp_path / "near.gz").write_bytes(record(b"near", 6))
    want = [p for p, _ in warc.read_range(warc._Window((tmp_path / "a.warc.gz").open("rb"), len(data)), 0, len(data))]
    assert len(want) > 5

    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.op1.link./in", f"file://{tmp_path}")
    files = [("viewfs://op1/in/a.warc.gz", len(data) + 3)]
    both = [*files, (f"file://{tmp_path}/near.gz", 99)]
    columns, limit = "file string, bytes long", "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "1000")
    try:
        got = warc.read_archives(spark, spark.createDataFrame(files, columns), 700).collect()
        assert sorted((r["file"], r["offset"]) for r in got) == [(files[0][0], p) for p in want]
        got = warc.read_archives(spark, spark.createDataFrame(both, columns), 5000).collect()
        assert sorted((r["file"], r["offset"]) for r in got) == [(both[1][0], 0), *((files[0][0], p) for p in want)]
    finally:
        spark.conf.unset(limit)
