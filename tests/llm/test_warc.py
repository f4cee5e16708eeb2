"""WARC archives: round trips, revisits, pushed filters, planning and what lost tasks leave behind."""

import base64
import collections
import gzip
import hashlib
import os
import tempfile

import pytest

from trialmill.llm import warc as W

SCHEMA = "page_id long, url string, html string, payload string, k string, piece int, top long, n long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, 2, 3) for r in rows], SCHEMA).repartition(4)


def odd_rows():
    long = "word é 日本 " * 60_000
    rows = [(i, f"http://h{i}.example/{i}", f"<p>{i % 7}</p>") for i in range(40)]
    rows += [(100, None, None), (101, "http://a/\r\nX: y", ""), (102, "u", long), (103, "u", long), (104, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n")]
    rows += [(105, "u", "same id"), (105, "u", "same id"), (106, "u", "same id"), (None, "u", "only nulls"), (None, "u", "only nulls")]
    rows += [(None, "u", "<p>1</p>"), (107, "same", "x\r\n\r\n"), (107, "other", "y")]
    return rows


def brute(rows, least=0):
    top = collections.defaultdict(list)
    for page, _, html in rows:
        if page is not None:
            top[html or ""].append(page)
    out = collections.Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        most = max(top[html or ""], default=None)
        revisit = len(data) >= least and most is not None and page != most
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[page, len(data), digest, "revisit" if revisit else "response", most if revisit else None] += 1
    return out


def got(df):
    return collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


@pytest.fixture(scope="module")
def archive(spark):
    folder = tempfile.mkdtemp(prefix="warc-test-")
    W.write_warc(W.page_records(table(spark, odd_rows())), folder)
    return folder


def test_round_trip(spark):
    for least in (0, 8):
        assert got(W.archived_pages(table(spark, odd_rows()), least=least)) == brute(odd_rows(), least)
    assert W.archived_pages(table(spark, [])).collect() == []


def test_payloads_and_headers_come_back(spark, archive):
    rows = W.read_warc(spark, archive, record_type="response").collect()
    want = {(p, (h or "").encode()) for p, _, h in odd_rows()}
    for r in rows:
        page = r.headers.get("page-id")
        assert ((int(page) if page else None), bytes(r.payload)) in want and len(r.payload) == r.payload_bytes
    urls = {r.target_uri for r in W.read_warc(spark, archive, payload=False).collect()}
    assert "http://a/ X: y" in urls and None in urls
    revisit = W.read_warc(spark, archive, record_type="revisit").collect()
    ids = {r.record_id for r in rows}
    assert revisit and all(r.payload is None and r.refers_to in ids and r.payload_bytes is not None for r in revisit)


def test_any_gzip_reader_reads_the_files(archive):
    names = [n for n in os.listdir(archive) if n.endswith(".warc.gz")]
    data = b"".join(gzip.open(f"{archive}/{n}").read() for n in names)
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")


def test_filters_reach_the_reader(spark, archive):
    old = spark.conf.get(W.PUSHDOWN, "false")
    spark.conf.set(W.PUSHDOWN, "true")
    try:
        df = W.read_warc(spark, archive)
        for wanted in ("record_type = 'revisit'", "target_uri in ('u', 'same')", "refers_to is not null", "payload_bytes > 100", "record_type = 'x' or payload_bytes = 0"):
            pushed = df.where(wanted)
            spark.conf.set(W.PUSHDOWN, "false")
            plain = W.read_warc(spark, archive).where(wanted).select("record_id").collect()
            spark.conf.set(W.PUSHDOWN, "true")
            assert sorted(pushed.select("record_id").collect()) == sorted(plain)
        plan = df.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
        assert "Filter" not in plan.replace("PushedFilters", "").replace("PythonFilter", "") or "record_type" in plan
    finally:
        spark.conf.set(W.PUSHDOWN, old)


def test_options_name_headers(spark, archive):
    rows = W.read_warc(spark, archive, target_uri=["same", "other"]).collect()
    assert sorted(r.target_uri for r in rows) == ["other", "same"]
    with pytest.raises(ValueError, match="no header"):
        W.read_warc(spark, archive, payload_bytes="1")


def reader(folder, **options):
    from pyspark.sql.types import _parse_datatype_string

    return W.WarcReader(_parse_datatype_string(W.SCHEMA), {"path": folder} | options)


def test_unwanted_blocks_are_sought_over(spark):
    folder = tempfile.mkdtemp(prefix="warc-test-")
    big = [(i, "keep" if i == 3 else "skip", "z" * 3_000_000 + str(i)) for i in range(6)]
    W.write_warc(W.page_records(table(spark, big).coalesce(1)), folder, compression="none")
    name = next(n for n in os.listdir(folder) if n.endswith(".warc"))
    read = []

    class Counting:
        def __init__(self, f):
            self.f = f

        def read(self, n):
            out = self.f.read(n)
            read.append(len(out))
            return out

        def seek(self, *a):
            return self.f.seek(*a)

    with open(f"{folder}/{name}", "rb") as f:
        records, kept = W.Records(Counting(f), False), []
        r = reader(folder, target_uri="keep")
        while (headers := records.headers()) is not None:
            size = int(headers["content-length"])
            kept.append(r.row(records, headers, size)) if r.keeps(headers) else records.skip(size)
    assert [k[2] for k in kept] == ["keep"] and len(kept[0][8]) == 3_000_001
    assert sum(read) < 3_000_000 + 7 * 2 * W.CHUNK  # the other five are 15 MB


def test_files_are_planned_by_size_and_manifest(spark, archive):
    sizes = {f"{archive}/{n}": os.path.getsize(f"{archive}/{n}") for n in os.listdir(archive) if n.endswith(".gz")}
    parts = reader(archive, planBytes=str(max(sizes.values()))).partitions()
    assert sorted(f for p in parts for f in p.files) == sorted(sizes)
    assert all(len(p.files) == 1 or sum(sizes[f] for f in p.files) <= max(sizes.values()) for p in parts)
    # what an attempt without a commit left behind is not read
    before = W.read_warc(spark, archive).count()
    with open(f"{archive}/part-lost.warc.gz", "wb") as f:
        f.write(gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"))
    assert W.read_warc(spark, archive).count() == before
    W.write_warc(W.page_records(table(spark, [(7000, "more", "more")])), archive)
    assert W.read_warc(spark, archive).count() == before + 1


def test_foreign_files(spark):
    folder = tempfile.mkdtemp(prefix="warc-test-")
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <a>\r\nContent-Type: application/warc-fields\r\nContent-Length: 10\r\n\r\nsoftware:x\r\n\r\n"
    other = b"WARC/1.0\nwarc-type: resource\nWARC-Record-ID: <b>\nX-Long: one\n two\nContent-Length: 5\n\nab\ncd\n\n"
    with open(f"{folder}/a.warc", "wb") as f:
        f.write(info + other)
    with gzip.open(f"{folder}/b.warc.gz", "wb") as f:  # one member for all records
        f.write(info + other)
    rows = W.read_warc(spark, folder, record_type="resource").collect()
    assert [(bytes(r.payload), r.headers["x-long"], r.payload_bytes) for r in rows] == [(b"ab\ncd", "one two", 5)] * 2
    assert {r.record_type for r in W.read_warc(spark, folder).collect()} == {"warcinfo", "resource"}


def test_wrong_digest_raises(spark):
    folder = tempfile.mkdtemp(prefix="warc-test-")
    with open(f"{folder}/a.warc", "wb") as f:
        f.write(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    with pytest.raises(Exception, match="has not the digest"):
        W.read_warc(spark, folder).collect()
    assert W.read_warc(spark, folder, payload=False).count() == 1
