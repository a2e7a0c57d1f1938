import hashlib

import pytest

from tallyfold.llm import warc
from tallyfold.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, digest string, payload int"
BIG, UNICODE = "<p>" + "b" * 200 + "</p>", "ü" * 60


def archive(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    warc.write(frame, str(tmp_path / "archive"), DATE)
    return warc.read(spark, str(tmp_path / "archive"))


def brute(rows):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        first = min(same, default=None)
        revisit = len(payload) >= 100 and first is not None and page != first
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def result(frame):
    return sorted((tuple(r) for r in frame.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()),
        key=str)


ROWS = [(5, "http://a/5", BIG), (3, "http://a/3", BIG), (9, "u\r\nWARC-Type: x", BIG),
        (1, None, None), (2, "u", ""), (4, "u", "small"), (6, "u", "small"), (None, "u", BIG),
        (7, "u", UNICODE), (7, "u", UNICODE), (8, "u", "z" * 300_000), (10, "u", "ab\r\n\r\ncd" * 20),
        (None, "u", "n" * 150)]


def test_records_and_revisits(spark, tmp_path):
    got = archive(spark, tmp_path, ROWS)
    assert result(got) == brute(ROWS)
    assert spark.read.parquet(str(tmp_path / "archive/payloads")).count() == len(
        {h or "" for _, _, h in ROWS})
    record = got.where("page_id = 10").first()
    assert record.record == record.headers + "\r\n" + record.http_head + "ab\r\n\r\ncd" * 20
    assert record.headers.startswith("WARC/1.1\r\nWARC-Type: response\r\n")
    assert bytes(got.where("page_id = 9").first().payload) == BIG.encode()


def test_urls_are_given_back(spark, tmp_path):
    urls = [None, "", "http://a/%0D%0A?x=%20", "a\r\nb", "\\r\\n", "\\", "\\\r\\\\n", "\n", "ü\r"]
    got = archive(spark, tmp_path, [(i, url, "x") for i, url in enumerate(urls)])
    assert [r.url for r in got.orderBy("page_id").collect()] == urls
    assert all(r.headers.count("\r\n") == r.headers.count("\n") == r.headers.count("\r")
               for r in got.collect())


DATE = "2024-01-31T00:00:00Z"


def record_id(page, url, html):
    digest = hashlib.sha256(html.encode()).hexdigest()
    return f"<urn:page:{page}/{hashlib.md5(f'{url}\n{digest}'.encode()).hexdigest()}>"


def headers_of(page, url, html, first):
    """(WARC header block, HTTP head); first: None or (page, url) of the record that is revisited."""
    size = len(html.encode())
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
            f"Content-Length: {size}\r\n\r\n")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page, url, html)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {url}",
             f"WARC-Payload-Digest: sha256:{hashlib.sha256(html.encode()).hexdigest()}"]
    if first is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {record_id(*first, html)}"]
    return "".join(f"{x}\r\n" for x in [
        *lines, "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (size if first is None else 0)}"]), http


def test_originals_of_revisits(spark, tmp_path):
    got = {r.page_id: r for r in archive(spark, tmp_path, ROWS[:2] + [ROWS[7]]).collect()}
    assert got[5].record == got[5].headers + "\r\n" + got[5].http_head
    for page, url, html in ROWS[:2]:
        head, http = headers_of(page, url, html, ROWS[1][:2] if page == 5 else None)
        assert bytes(got[page].original).decode() == head + "\r\n" + http + html
    assert bytes(got[None].original).decode().endswith("\r\n\r\n" + BIG)


def test_query_rebuilds_the_records(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = {r.page_id: (r.url, r.html or "") for r in spark.read.parquet(
        f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op4_warc"](spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        url, html = rows[r.page_id]
        first = None if r.refers_to is None else (r.refers_to, rows[r.refers_to][0])
        head = "\r\n".join(headers_of(r.page_id, url, html, first))
        record = head + (html if r.record_type == "response" else "")
        assert r.record_sha256 == hashlib.sha256(record.encode()).hexdigest()
        assert r.original_sha256 == hashlib.sha256((head + html).encode()).hexdigest()


def test_no_pages(spark, tmp_path):
    assert archive(spark, tmp_path, []).count() == 0


def test_export_is_a_sequence_of_records(spark, tmp_path):
    got = archive(spark, tmp_path, ROWS[:4])
    warc.export(spark, str(tmp_path / "archive"), str(tmp_path / "out"))
    written = b"".join(p.read_bytes() for p in (tmp_path / "out").glob("part-*"))
    for row in got.collect():
        assert (row.record + "\r\n\r\n").encode() in written
    assert len(written) == sum(len(r.record.encode()) + 4 for r in got.collect())


def test_exported_files_are_read_back(spark, tmp_path):
    got = {r.headers: r for r in archive(spark, tmp_path, ROWS).collect()}
    warc.export(spark, str(tmp_path / "archive"), str(tmp_path / "out"))
    back = warc.import_files(spark, str(tmp_path / "out")).collect()
    assert len(back) == len(ROWS) and {r.headers for r in back} == set(got)
    for r in back:
        assert r.headers + "\r\n" + bytes(r.block).decode() == got[r.headers].record
        assert f"\r\nWARC-Date: {DATE}\r\n" in r.headers
    warc.export(spark, str(tmp_path / "archive"), str(tmp_path / "cut"))
    file = max((tmp_path / "cut").glob("part-*"), key=lambda p: p.stat().st_size)
    file.write_bytes(file.read_bytes()[:-6])
    for crc in (tmp_path / "cut").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="WARC record"):
        warc.import_files(spark, str(tmp_path / "cut")).collect()


def test_record_ids_of_one_page(spark, tmp_path):
    rows = [(1, "a", "x"), (1, "b", "x"), (1, "a", "y"), (None, None, "x"), (None, "a", "x")]
    ids = [r.headers.split("WARC-Record-ID: ")[1].split("\r")[0]
           for r in archive(spark, tmp_path, rows).collect()]
    assert len(set(ids)) == len(rows)


def test_damage_is_noticed(spark, tmp_path):
    archive(spark, tmp_path, ROWS[:2])
    stored = spark.read.parquet(str(tmp_path / "archive/payloads"))
    broken = tmp_path / "broken"
    stored.selectExpr("digest", "cast('other' AS binary) AS payload", "first",
                      "payload_bytes").write.parquet(str(broken / "payloads"))
    spark.read.parquet(str(tmp_path / "archive/headers")).write.parquet(str(broken / "headers"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read(spark, str(broken)).collect()


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", "html").collect()]
    assert result(QUERIES["op4_warc"](spark, sf_dir)) == brute(rows)
