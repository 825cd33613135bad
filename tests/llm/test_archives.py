import hashlib
import io
import zipfile

import pyarrow as pa
import pytest
from pyarrow.fs import LocalFileSystem

from skyload.llm import archives
from skyload.llm.archives import INDEX, WARC, archive_pages, member_start, plan_records, read_directory, read_record, read_records, write_packages

SCHEMA = "page_id bigint, url string, html string, digest string, page int"
LONG = "<p>é " + "x" * 200


def _pages():
    rows = [(1, "http://a/", LONG), (2, "http://b/?q=a b%20c\r\nX: 1", LONG), (3, None, LONG + "y"), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", "y" * 100), (9, "u", "y" * 99), (10, "u", "y" * 100), (11, "u", "y" * 99)]
    rows += [(None, "u", LONG), (None, "u", "only here " * 20), (1, "u", LONG), (12, "u", "z\x00\r\n\r\n😀" * 100000), (13, "u", "é" * 50)]
    return [(*r, "d", 1) for r in rows]


def _wanted(rows):
    first = {}
    for page, _, html, *_ in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        again = page is not None and len(body) >= 100 and first[html or ""] != page
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[html or ""] if again else None))
    return out


def test_written_and_read_back(spark):
    rows = _pages()
    got = archive_pages(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(_wanted(rows), key=str)
    assert sum(r[3] == "revisit" for r in _wanted(rows)) == 2
    assert archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_payloads_urls_and_ranges(spark, tmp_path):
    rows = _pages()
    packages = write_packages(plan_records(spark.createDataFrame(rows, SCHEMA)), f"file://{tmp_path}/out", package_bytes=300)
    listed = packages.collect()
    assert sum(r["records"] for r in listed) == len(rows) and len(listed) > 3
    records = read_records(packages).collect()
    payload = {r["page"]: bytes(r["payload"]).decode() for r in records if r["record_type"] == "response" and r["page"] not in (None, 1)}
    assert payload == {p: h or "" for p, _, h, *_ in rows if p in payload}
    assert {r["page"]: r["url"] for r in records}[2] == "http://b/?q=a%20b%2520c%0D%0AX:%201"
    found = [r for r in (read_record(r["path"], 12) for r in listed) if r]
    assert len(found) == 1 and found[0][1].decode() == "z\x00\r\n\r\n😀" * 100000
    assert read_record(listed[0]["path"], 999) is None


def _file(data, tmp_path):
    (tmp_path / "package").write_bytes(data)
    return LocalFileSystem().open_input_file(str(tmp_path / "package"))


@pytest.mark.parametrize("members, note", [(3, b""), (3, b"a note at the end"), (70000, b"")])
def test_directories(tmp_path, members, note):
    """Small packages, and one with more members than fit without ZIP64."""
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as package:
        for i in range(members):
            with package.open(f"dir/é{i}", "w", force_zip64=i % 2 == 0) as f:
                f.write(b"body %d" % i)
        package.comment = note
    with _file(sink.getvalue(), tmp_path) as file:
        found = read_directory(file)
        assert [m.name for m in found] == [f"dir/é{i}" for i in range(members)]
        for i in (0, 1, members - 1):
            assert file.read_at(found[i].size, member_start(file, found[i])) == b"body %d" % i


def test_zip64_extra_field():
    extra = b"\x09\x00\x02\x00ab" + b"\x01\x00\x18\x00" + b"".join(n.to_bytes(8, "little") for n in (5, 6, 1 << 40))
    assert archives._zip64(extra, 0xFFFFFFFF, 0xFFFFFFFF, 0xFFFFFFFF) == (6, 1 << 40)
    assert archives._zip64(b"", 5, 6, 7) == (6, 7)


def test_broken_packages(spark, tmp_path):
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr(WARC, b"x" * 1000)
        package.writestr(INDEX, b"")
    with _file(sink.getvalue(), tmp_path) as file, pytest.raises(ValueError, match="compressed"):
        member_start(file, read_directory(file)[0])
    for data in (b"", b"no package", sink.getvalue()[:100]):
        with _file(data, tmp_path) as file, pytest.raises(ValueError, match="ZIP"):
            read_directory(file)


def test_changed_payload_is_an_error(spark, tmp_path):
    record = archives._record(1, None, b"body", hashlib.sha256(b"other").hexdigest(), None, "response")
    with zipfile.ZipFile(tmp_path / "bad.wacz", "w") as package:
        package.writestr(WARC, record)
        package.writestr(INDEX, f'{{"page": 1, "offset": 0, "length": {len(record)}}}\n')
    table = spark.createDataFrame(pa.table({"path": [f"file://{tmp_path}/bad.wacz"]}))
    with pytest.raises(Exception, match="has digest"):
        read_records(table).collect()
