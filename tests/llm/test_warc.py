from __future__ import annotations

import base64
import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, Not, StringStartsWith

from skymeter.llm import queries, warc
from skymeter.llm.warc import WarcReader, archive_pages, archived_pages, read_records

SCHEMA = "page_id long, url string, html string, record_type string, sha1 string, payload string, copies int"
PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>two</p>"), (3, "http://a/3", "<p>one</p>"),
    (7, None, "<p>one</p>"), (4, "http://a/é 4\r\nX: y", ""), (5, "http://a/5", None), (6, "", "é\r\n\r\nWARC/1.1\r\n"),
    (8, "http://a/8", "<p>two</p>"), (8, "http://a/8", "<p>two</p>"), (None, "n", "only null"), (None, "n", "only null"),
    (None, "n", "<p>one</p>"), (-9, "x", "z" * 300_000), (10, "y", "z" * 300_000),
]


def table(spark, pages):
    return spark.createDataFrame([(*p, "a", "b", "c", 1) for p in pages], SCHEMA)


def plain(pages, least_bytes=0):
    largest, counts = {}, {}
    for i, _, html in pages:
        payload = (html or "").encode()
        counts[payload] = counts.get(payload, 0) + 1
        if i is not None:
            largest[payload] = max(i, largest.get(payload, i))
    for i, url, html in pages:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        keeper = largest.get(payload)
        revisit = counts[payload] > 1 and keeper is not None and i != keeper and len(payload) >= least_bytes
        yield i, len(payload), digest, "revisit" if revisit else "response", keeper if revisit else None


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def path(spark):
    return archive_pages(table(spark, PAGES))


def test_pages_come_back_as_plain_rules_say(spark, path):
    assert result(archived_pages(spark, path)) == sorted(plain(PAGES), key=str)
    small = archive_pages(table(spark, PAGES), least_bytes=11)
    assert result(archived_pages(spark, small)) == sorted(plain(PAGES, 11), key=str)


def test_query_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = result(queries.op10_warc(spark, "/root/testdata/sf0.001"))
    assert got == sorted(plain([(r.page_id, r.url, r.html) for r in pages]), key=str)


def test_payloads_and_headers_are_exact(spark, path):
    rows = read_records(spark, path).collect()
    kinds = [r.record_type for r in rows]
    assert kinds.count("warcinfo") >= 1 and kinds.count("response") + kinds.count("revisit") == len(PAGES)
    by_id = {r.record_id: r for r in rows}
    assert bytes(by_id["<urn:page:6>"].payload).decode() == "é\r\n\r\nWARC/1.1\r\n"
    assert by_id["<urn:page:4>"].target_uri == "http://a/é 4%0D%0AX: y"
    assert by_id["<urn:page:7>"].target_uri is None
    assert by_id["<urn:page:3>"].payload is None and by_id["<urn:page:3>"].refers_to == "<urn:page:7>"
    assert by_id["<urn:page:1>"].headers["content-length"] == "0"


def test_predicates_on_headers_reach_the_source(spark, path):
    revisits = read_records(spark, path, payload="skip").filter(F.col("record_type") == "revisit")
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan.split("BatchScan")[0].replace("FilterExec", "")
    assert revisits.count() == sum(k == "revisit" for *_, k, _ in plain(PAGES))
    some = read_records(spark, path).filter(F.col("target_uri").startswith("http://a/") & (F.col("payload_length") > 5))
    assert {r.record_id for r in some.collect()} == {f"<urn:page:{i}>" for i in (1, 2, 3, 8)}
    reader = WarcReader({"path": path})
    left = list(
        reader.pushFilters(
            [
                EqualTo(("record_type",), "response"), In(("record_id",), ("x", "y")), GreaterThan(("payload_length",), 3),
                StringStartsWith(("target_uri",), "h"), Not(EqualTo(("record_type",), "x")), EqualTo(("payload",), b""),
            ]
        )
    )
    assert len(left) == 3 and len(reader.filters) == 3


def test_unwanted_blocks_are_not_read():
    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            self.taken += len(out)
            return out

    records = b"".join(
        warc.record([("WARC-Type", kind), ("WARC-Record-ID", kind)], b"x" * 1000) for kind in ("response", "metadata") * 5
    )
    reader = WarcReader({"path": "", "payload": "bytes"})
    stream = Counting(records)
    list(reader.pushFilters([EqualTo(("record_type",), "metadata")]))
    rows = list(reader._records(stream, [warc.header_test(f) for f in reader.filters]))
    assert len(rows) == 5 and stream.taken == 5000
    stream = Counting(records)
    assert len(list(WarcReader({"path": "", "payload": "skip"})._records(stream, []))) == 10 and stream.taken == 0


def test_of_unwanted_compressed_records_only_the_headers_are_inflated(spark, tmp_path, monkeypatch):
    inflated = []

    class Counted(warc.Member):
        def __init__(self, file):
            super().__init__(file)
            inflated.append(self)

    rng = random.Random(3)
    pages = [(i, "u", f"{rng.random()}" * 250_000) for i in range(3)]
    path = archive_pages(table(spark, pages).coalesce(1), str(tmp_path / "w"))
    assert sum(len(p[2]) for p in pages) > 10_000_000
    monkeypatch.setattr(warc, "Member", Counted)

    def records(payload, kind):
        inflated.clear()
        reader = WarcReader({"path": path, "payload": payload})
        assert list(reader.pushFilters([EqualTo(("record_type",), kind)])) == []
        rows = [r for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist()]
        return len(rows), sum(m.inflated for m in inflated)

    assert records("bytes", "revisit") == (0, records("skip", "warcinfo")[1])
    assert records("bytes", "revisit")[1] <= 5 * warc.CHUNK
    count, taken = records("skip", "response")
    assert count == 3 and taken <= 5 * warc.CHUNK
    count, taken = records("verify", "response")
    assert count == 3 and taken > sum(len(p[2]) for p in pages)


def test_members_are_gzip_and_name_their_length(tmp_path):
    data = [b"", b"x" * 100_000, bytes(range(256)) * 300]
    written = [warc.member(d) for d in data]
    assert gzip.decompress(b"".join(written)) == b"".join(data)
    assert [warc.member_length(w[: warc.MEMBER.size]) for w in written] == [len(w) for w in written]
    assert warc.member_length(gzip.compress(b"x" * 100)[: warc.MEMBER.size]) is None and warc.member_length(b"") is None
    for w, d in zip(written, data):
        assert io.BufferedReader(warc.Member(io.BytesIO(w + b"rest"))).read() == d
    with pytest.raises(ValueError, match="truncated"):
        io.BufferedReader(warc.Member(io.BytesIO(written[1][:-9]))).read()


@pytest.mark.parametrize("kind", ["plain", "foreign", "own"])
def test_a_truncated_record_is_noticed_when_it_is_passed_over(spark, tmp_path, kind):
    data = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x:1>")], b"x" * 50_000)
    cut = {
        "plain": data[:-20_000],
        "foreign": gzip.compress(data[:-20_000]),
        "own": warc.member(data)[:-20],
    }[kind]
    (tmp_path / ("a.warc" if kind == "plain" else "a.warc.gz")).write_bytes(cut)
    with pytest.raises(Exception, match="truncated"):
        read_records(spark, str(tmp_path), payload="skip").collect()


def test_foreign_archives_plain_and_compressed(spark, tmp_path):
    """Records of other writers: folded headers, other kinds, no digest, bare line ends in the block."""
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n<html>\n\n</html>"
    folded = (
        b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:x:1>\r\nX-Long: a\r\n  b\r\n"
        b"Content-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(block)
    ) + block + b"\r\n\r\n"
    other = warc.record([("WARC-Type", "resource"), ("WARC-Record-ID", "<urn:x:2>")], b"plain")
    (tmp_path / "a.warc").write_bytes(folded + other)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(folded) + gzip.compress(other))
    (tmp_path / "ignored.txt").write_text("no archive")
    rows = read_records(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.payload) for r in rows) == sorted([b"<html>\n\n</html>", b"plain"] * 2)
    assert {r.headers.get("x-long") for r in rows} == {"a b", None}
    verified = read_records(spark, str(tmp_path), payload="verify").collect()
    assert sorted(r.payload_length for r in verified) == [5, 5, 15, 15]


def test_damaged_archives_are_an_error(spark, tmp_path):
    good = warc.record([("WARC-Type", "response"), ("WARC-Payload-Digest", "sha1:AAAA")], b"x")
    for name, data in (("digest", good), ("short", good[:-6]), ("start", b"garbage" + good)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.warc").write_bytes(data)
        with pytest.raises(Exception, match="digest|truncated|not a WARC"):
            read_records(spark, str(folder), payload="verify").collect()


def test_only_files_of_the_manifest_count(spark, path):
    system, folder = warc.open_path(path)
    before = read_records(spark, path).count()
    with system.open_output_stream(f"{folder}/part-of-a-lost-task.warc", compression=None) as file:
        file.write(b"garbage")
    assert read_records(spark, path).count() == before


def test_small_files_share_partitions_and_large_outputs_are_split(spark, monkeypatch):
    rng = random.Random(1)
    pages = [(i, "u", str(rng.random()) * 50) for i in range(60)]
    df = table(spark, pages).repartition(4)
    warc_path = warc.work_path(spark, "warc")
    spark.dataSource.register(warc.WarcDataSource)
    warc.page_records(df).write.format("warc").mode("append").option("path", warc_path).option("file_bytes", 5000).save()
    reader = WarcReader({"path": warc_path})
    assert len(reader.partitions()) == 1 and len(reader.partitions()[0].paths) > 8
    monkeypatch.setattr(warc, "PARTITION_BYTES", 2000)
    assert len(WarcReader({"path": warc_path}).partitions()) > 4
    assert result(archived_pages(spark, warc_path)) == sorted(plain(pages), key=str)


def test_empty_table(spark):
    assert archived_pages(spark, archive_pages(table(spark, []))).count() == 0
