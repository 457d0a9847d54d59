import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tierwise.llm import warc

HEAD = b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\nContent-Length: 3\r\n\r\n"


def archive(version, *records):
    return warc.arc_start("test.arc", version) + b"".join(warc.arc_record(version, *r) for r in records)


@pytest.mark.parametrize("version", [1, 2])
def test_declared_lengths_rule(version):
    tricky = b"\n\nhttp://fake/ 1.2.3.4 20200101000000 text/html 5\nabc\r\n\r\nWARC/1.1\r\n"
    content = archive(version, (b"http://a/ b", b"20200102030405", b"text/html", HEAD + b"abc"), (b"dns:x", b"2020", b"text/dns", tricky), (b"", b"20200101000000", b"a/b", b""))
    found = list(warc.parse_arc(content))
    assert [(f["url"], f["length"], body) for _, f, body in found] == [
        (b"http://a/%20b", b"%d" % (len(HEAD) + 3), HEAD + b"abc"), (b"dns:x", b"%d" % len(tricky), tricky), (b"-", b"0", b"")
    ]
    assert len(found[0][1]) == {1: 5, 2: 10}[version]
    first = warc.converted("p", *found[0])
    assert (first["record_type"], first["page_id"], first["payload"], first["warc_date"]) == ("response", 4, b"abc", "2020-01-02T03:04:05Z")
    assert warc.converted("p", *found[1])["payload"] == tricky
    assert warc.converted("p", *found[2])["record_type"] == "resource"
    assert len({warc.converted("p", *f)["record_id"] for f in found}) == 3


def test_version_two_names_may_not_be_read_as_version_one():
    content = archive(2, (b"http://a/", b"20200101000000", b"text/html", b"x"))
    assert b" 200 - - - - 1\n" in content


@pytest.mark.parametrize("cut", [-1, -3])
def test_broken_archives_are_errors(cut):
    content = archive(1, (b"http://a/", b"20200101000000", b"text/html", b"abc"))
    with pytest.raises(ValueError):
        list(warc.parse_arc(content[: cut - 1]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"no archive\n" + content))
    with pytest.raises(ValueError):
        list(warc.parse_arc(content + b"too few\n"))
    assert list(warc.parse_arc(b"")) == []


def test_files_to_files(spark, tmp_path):
    body = b"x" * 200
    records = [(b"http://h/%d" % i, b"20200101000000", b"text/html", HEAD.replace(b"4", b"%d" % (9 - i)) + body) for i in range(3)]
    records.append((b"http://h/other", b"20200101000000", b"text/plain", body))
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "one.arc").write_bytes(archive(1, *records[:2]))
    (tmp_path / "arc" / "two.arc.gz").write_bytes(b"".join(map(gzip.compress, [archive(2), *(warc.arc_record(2, *r) for r in records[2:])])))
    found = warc.convert(spark.read.format("binaryFile").load(str(tmp_path / "arc")))
    warc.write_warc(warc.with_revisits(found), str(tmp_path / "warc"))
    rows = {r.target_uri: r for r in warc.read_warc(spark, str(tmp_path / "warc")).collect()}
    assert [rows[f"http://h/{i}"].record_type for i in range(3)] == ["revisit", "revisit", "response"]
    assert [rows[f"http://h/{i}"].refers_to for i in range(3)] == [7, 7, None]
    assert rows["http://h/0"].refers_to_record == rows["http://h/2"].record_id
    assert rows["http://h/0"].payload_digest == hashlib.sha256(body).hexdigest()
    assert rows["http://h/other"].record_type == "resource" and rows["http://h/other"].payload_bytes == 200
    assert {r.payload_bytes for r in rows.values()} == {200}


def test_lengths_of_revisits_are_measured(spark, tmp_path):
    """Whatever the HTTP head says of its length, or does not."""
    heads = [b"Content-Length: 200\r\n", b"content-length: 200\r\n", b"", b"Content-Length: 17\r\n"]
    body = b"y" * 200
    records = [(b"http://h/%d" % i, b"20200101000000", b"text/html", b"HTTP/1.1 200 OK\r\n%s\r\n" % h + body) for i, h in enumerate(heads)]
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "one.arc").write_bytes(archive(2, *records))
    warc.write_warc(warc.with_revisits(warc.convert(spark.read.format("binaryFile").load(str(tmp_path / "arc")))), str(tmp_path / "warc"))
    rows = warc.read_warc(spark, str(tmp_path / "warc")).collect()
    assert sorted(r.record_type for r in rows) == ["response", "revisit", "revisit", "revisit"]
    assert [r.payload_bytes for r in rows] == [200] * 4


def test_files_are_cut_by_bytes_and_have_a_member_for_each_record(spark, tmp_path, monkeypatch):
    pages = spark.range(20).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("concat(id div 2, repeat('large page ', 300000))").alias("html")
    )
    archives = warc.pages_as_arc(pages.coalesce(1))
    sizes = [r.n for r in archives.select(F.length("content").alias("n")).collect()]
    assert max(sizes) < warc.ARC_BYTES + 4_000_000 and len(sizes) == 7
    records = warc.with_revisits(warc.convert(archives))
    monkeypatch.setattr(warc, "WARC_BYTES", 30_000)
    warc.write_warc(records.coalesce(1), str(tmp_path / "warc"))
    files = sorted((tmp_path / "warc").glob("part-*"))
    assert len(files) > 1
    found = []
    for file in files:
        content = file.read_bytes()
        assert len(list(warc.members(content))) == len(list(warc.parse_warc(gzip.decompress(content)))) + 1  # and the empty one
        found += [f["warc-type"] for f, _ in warc.parse_warc(gzip.decompress(content))]
    assert sorted(found) == ["response"] * 10 + ["revisit"] * 10
    assert warc.read_warc(spark, str(tmp_path / "warc")).filter("payload_bytes > 3000000").count() == 20


def test_members():
    given = [b"", b"a", bytes(range(256)) * 400, b"\x00" * 70_000, b"end"]
    zipped = [gzip.compress(g) for g in given]
    assert list(warc.members(b"".join(zipped))) == given
    assert list(warc.members(b"".join(zipped) + b"\x00\x00")) == given
    assert list(warc.members(b"plain\x00")) == [b"plain\x00"] and list(warc.members(b"")) == []
    with pytest.raises(ValueError, match="cut off"):
        list(warc.members(b"".join(zipped)[:-1]))


def test_damaged_warc_is_an_error():
    block = b"abc"
    record = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <u>\r\nWARC-Payload-Digest: sha256:00\r\nContent-Type: a/b\r\nWARC-Target-URI: u\r\nWARC-Date: d\r\nContent-Length: 3\r\n\r\n" + block
    ((fields, read),) = warc.parse_warc(record + b"\r\n\r\n")
    assert read == block
    with pytest.raises(ValueError):
        warc.read_record("p", fields, read)
    with pytest.raises(ValueError):
        list(warc.parse_warc(record + b"x\r\n\r\n"))


def through(spark, pages, tmp_path, name):
    path = str(tmp_path / name)
    warc.write_warc(warc.with_revisits(warc.convert(warc.pages_as_arc(pages))), path)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(map(tuple, warc.read_warc(spark, path).select(*columns).collect()), key=str)


def test_odd_pages(spark, tmp_path):
    long = "é\r\n\r\nWARC/1.1\r\n" * 20_000
    same = "s" * 100
    given = [(1, "http://a b/\n", long), (2, None, long), (3, "", None), (4, "u", ""), (5, "u", "s" * 99), (6, "u", "s" * 99),
             (9, "u", same), (8, "u", same), (8, "u", same), (None, "u", same), (None, None, None)]
    pages = spark.createDataFrame([(*g, "x", 1, "y") for g in given], "page_id long, url string, html string, path string, row int, record_id string")
    first = {long: 1, same: 8}
    expected, seen = [], set()
    for i, _, html in sorted(given, key=lambda g: (g[0] is None, g[0] or 0)):
        body = html or ""
        copy = body in first and body in seen
        seen.add(body)
        raw = body.encode()
        expected.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if copy else "response", first[body] if copy else None))
    assert through(spark, pages, tmp_path, "odd") == sorted(expected, key=str)
    assert through(spark, pages.limit(0), tmp_path, "none") == []
