import base64
import gzip
import hashlib
import os

import pytest

from kontor.llm import archives as A


@pytest.fixture()
def pages(spark):
    big, other = "<p>é</p>" * 300, "x" * 999
    rows = [(1, "http://a/", big), (2, "http://b/ c\n", big), (9, "http://a/", big), (3, "http://s/", other),
            (4, "http://s2/", other), (5, None, None), (6, "http://e/", ""), (7, "http://l/", "z\r\n\r\nWARC/1.1\r\n" * 9000),
            (8, "http://n/", "a\nb 1 2 3\n" * 200), (8, "http://n/", "a\nb 1 2 3\n" * 200), (None, "http://q/", big)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip_equals_the_rule(pages):
    rows = pages.collect()
    got = A.archive_round_trip(pages).collect()
    assert sorted(str(r["page_id"]) for r in got) == sorted(str(r["page_id"]) for r in rows)
    html = {r["page_id"]: (r["html"] or "").encode() for r in rows}
    for r in got:
        payload = html[r["page_id"]]
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == hashlib.sha1(payload).hexdigest()
        same = [p for p, h in html.items() if h == payload and p is not None]
        if len(payload) >= 1000 and (r["page_id"] is None or max(same) != r["page_id"]):
            assert (r["record_type"], r["refers_to"]) == ("revisit", max(same))
    eights = sorted((r["record_type"], r["refers_to"]) for r in got if r["page_id"] == 8)
    assert eights == [("response", None), ("revisit", 8)]  # of repeated rows one is the response


def test_archives_of_both_versions_are_read_by_declared_lengths(spark, tmp):
    for version in (1, 2):
        one = A._http(b"first 1 2 3\n\n", 1)
        data = A.arc_version_block(version, "x.arc") + b"\n"
        for i, block in enumerate((one, b"", b"plain\n")):
            data += A.arc_header(version, f"http://{i}/", "20010203040506", "text/html", len(block)) + block + b"\n"
        records = list(A.parse_arc(data))
        assert [r["block"] for r in records[1:]] == [one, b"", b"plain\n"]
        assert [A.record_type(r) for r in records] == ["warcinfo", "response", "resource", "resource"]
        assert records[1]["status"] == (None if version == 1 else "200")
        for cut in (data[:-3], data.replace(b"filedesc:", b"filedesk:")):
            with pytest.raises(ValueError):
                list(A.parse_arc(cut))
        os.makedirs(f"{tmp}/{version}")
        with gzip.open(f"{tmp}/{version}/x.arc.gz", "wb") as f:
            f.write(data)
        A.convert(spark, f"{tmp}/{version}", f"{tmp}/warc{version}")
        (name,) = [n for n in os.listdir(f"{tmp}/warc{version}") if n.startswith("part-") and n.endswith(".gz")]
        with gzip.open(f"{tmp}/warc{version}/{name}") as f:
            warc = list(A.parse_warc(f.read()))
        assert [h["warc-type"] for h, _ in warc] == ["warcinfo", "response", "resource", "resource"]
        assert warc[1][0]["warc-date"] == "2001-02-03T04:05:06Z" and warc[1][1] == one
        payload = base64.b32encode(hashlib.sha1(b"first 1 2 3\n\n").digest()).decode()
        assert warc[1][0]["warc-payload-digest"] == f"sha1:{payload}"
        assert len({h["warc-record-id"] for h, _ in warc}) == 4


def test_content_types_with_blanks_and_short_dates():
    data = A.arc_version_block(1, "x") + b"\nhttp://a/ 1.2.3.4 1996 text/html; charset=x 3\nabc\n"
    r = list(A.parse_arc(data))[1]
    assert r["content_type"] == "text/html; charset=x" and r["block"] == b"abc"
    assert A.iso_date(r["date"]) == "1996-01-01T00:00:00Z"


def test_a_changed_block_is_noticed():
    warc = A.warc_record("x.arc", {"url": "http://a/", "ip": "-", "date": A.DATE, "content_type": "text/plain",
                                   "offset": 0, "block": b"abc"}, None)
    assert list(A.parse_warc(warc + b"\r\n\r\n"))[0][1] == b"abc"
    with pytest.raises(ValueError):
        list(A.parse_warc(warc.replace(b"\r\n\r\nabc", b"\r\n\r\nabd")))


def test_binary_payloads_survive(spark, tmp):
    block = bytes(range(256)) * 5
    data = A.arc_version_block(1, "x") + b"\n" + A.arc_header(1, "http://a/", A.DATE, "x/y", len(block)) + block + b"\n"
    os.makedirs(f"{tmp}/arc")
    with open(f"{tmp}/arc/x.arc", "wb") as f:
        f.write(data)
    A.convert(spark, f"{tmp}/arc", f"{tmp}/warc")
    (name,) = [n for n in os.listdir(f"{tmp}/warc") if n.startswith("part-") and n.endswith(".gz")]
    with gzip.open(f"{tmp}/warc/{name}") as f:
        assert list(A.parse_warc(f.read()))[1][1] == block


def test_small_files_and_empty_tables(spark, pages, monkeypatch):
    assert A.archive_round_trip(pages.limit(0)).count() == 0
    monkeypatch.setattr(A, "RECORDS", 3)
    from pyspark.sql import functions as F

    assert A.archive_round_trip(pages.withColumn("content", F.lit(1))).count() == pages.count()


def test_large_pages_close_archives_by_bytes(spark, tmp):
    pages = spark.range(10, numPartitions=1).selectExpr("id page_id", "concat('http://l/', id) url",
                                                        "repeat(concat('page ', id), 800000) html")
    A.write_arc(pages, f"{tmp}/arc", archive_bytes=9 << 20)
    sizes = [len(gzip.open(f"{tmp}/arc/{n}").read()) for n in os.listdir(f"{tmp}/arc") if n.startswith("part-")]
    assert len(sizes) == 5 and max(sizes) < 10 << 20
    got = A.archive_round_trip(pages).collect()
    assert sorted((r["page_id"], r["payload_bytes"], r["record_type"]) for r in got) == [
        (i, 4800000, "response") for i in range(10)]


def test_only_revisits_are_joined(pages):
    plan = A.archive_round_trip(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("Join") == 1 and "record_type" in plan
