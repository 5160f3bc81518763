import gzip
import os

import pytest
from pyspark.sql import functions as F

from vesseltrack.llm import warc as W

PAGES = [(1, "http://a/x", "<p>" + "same " * 50), (3, "http://b/", "<p>" + "same " * 50), (2, None, "<p>" + "same " * 50), (4, "http://a/y", None),
         (5, "http://a/y", ""), (6, "http://a/\r\nX-Evil: 1", "tiny"), (7, "http://a/z", "tiny"), (8, "http://é/", "é漢😀" * 4000),
         (9, "http://w", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 20), (1, "http://a/x", "<p>" + "same " * 50),
         (None, "http://n", "<p>" + "same " * 50), (None, "http://m", "null id " * 30)]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit("own")).repartition(3)


def digest(t):
    import hashlib
    return hashlib.sha256((t or "").encode()).hexdigest()


def test_round_trip(spark, pages, tmpdir_fresh):
    got = W.round_trip(pages, f"{tmpdir_fresh}/archive").collect()
    want = []
    for i, _, html in PAGES:
        n = len((html or "").encode())
        first = min((j for j, _, h in PAGES if h == html and j is not None), default=None) if n >= 100 else i
        again = first is not None and i != first
        want.append((i, n, digest(html), "revisit" if again else "response", first if again else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_predicates_and_columns_reach_the_reader(spark, pages, tmpdir_fresh, monkeypatch):
    path = f"{tmpdir_fresh}/archive"
    W.write_archive(pages, path)
    df = W.read_archive(spark, path, ["record_type", "target_uri"]).where("record_type = 'revisit' and target_uri like 'http://b%'")
    assert [r.target_uri for r in df.collect()] == ["http://b/"]
    reader = W.WarcReader(df.schema, {"path": path})
    left = list(reader.pushFilters([W.EqualTo(("record_type",), "revisit"), W.Not(W.EqualTo(("target_uri",), "x")), W.IsNull(("payload",))]))
    assert len(reader.filters) == 1 and len(left) == 2
    monkeypatch.setattr(W, "payload_of", lambda block: pytest.fail("an unwanted payload was decoded"))
    rows = [row for p in reader.partitions() for row in reader.records(p.path)]
    assert {r["record_type"] for r in rows} == {"revisit"} and len(rows) == 3


def test_payloads_of_gzipped_archives(spark, pages, tmpdir_fresh):
    path = f"{tmpdir_fresh}/archive"
    W.write_archive(pages, path)
    packed = f"{tmpdir_fresh}/packed"
    os.mkdir(packed)
    for i, f in enumerate(W.manifest(path)):
        with open(f"{path}/{f}", "rb") as src, gzip.open(f"{packed}/{i}.warc.gz", "wb") as out:
            out.write(src.read())
    one, two = ({(r.record_id, r.target_uri): r.payload and bytes(r.payload) for r in W.read_archive(spark, p).collect()} for p in (path, packed))
    assert one == two and any(v == ("é漢😀" * 4000).encode() for v in one.values())
    assert sorted(k[1] or "" for k in one if "Evil" in (k[1] or "")) == ["http://a/%0D%0AX-Evil: 1"]


def test_only_committed_files_are_read(spark, pages, tmpdir_fresh):
    path = f"{tmpdir_fresh}/archive"
    W.write_archive(pages, path)
    with open(f"{path}/part-left-by-a-lost-task.warc", "wb") as f:
        f.write(b"WARC/1.1\r\nbroken")
    assert W.read_archive(spark, path, ["record_type"]).count() == len(PAGES)


def test_files_roll(spark, tmpdir_fresh):
    pages = spark.createDataFrame([(i, None, f"{i} " * 400) for i in range(30)], "page_id long, url string, html string")
    W.register(spark)
    W.archive_rows(pages).coalesce(1).write.format("warc").option("rollBytes", 3000).mode("append").save(f"{tmpdir_fresh}/a")
    assert len(W.manifest(f"{tmpdir_fresh}/a")) > 3
    assert W.read_archive(spark, f"{tmpdir_fresh}/a").count() == 30


def test_empty_table(spark, tmpdir_fresh):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.round_trip(empty, f"{tmpdir_fresh}/archive").count() == 0


def cut_archive(folder, name, keep):
    """Two records of 300 bytes; the second one's file ends after ``keep`` of its bytes."""
    os.makedirs(folder, exist_ok=True)
    one, two = (W.record_bytes({"record_type": "response", "record_id": f"<urn:page:{i}>", "payload": os.urandom(300)}, "2020") for i in (1, 2))
    data = one + two[:keep if keep >= 0 else len(two) + keep]
    with (gzip.open if name.endswith(".gz") else open)(f"{folder}/{name}", "wb") as f:
        f.write(data)
    return len(two)


@pytest.mark.parametrize("name,keep", [("a.warc", 3), ("a.warc", 40), ("a.warc", 200), ("a.warc", -100), ("a.warc", -5), ("a.warc.gz", 40), ("a.warc.gz", -100)])
@pytest.mark.parametrize("columns", [None, ["record_type", "record_id"]])
def test_a_cut_record_is_an_error_or_marked(spark, tmpdir_fresh, name, keep, columns):
    cut_archive(tmpdir_fresh, name, keep)
    with pytest.raises(Exception, match="cut off|of a block's"):
        W.read_archive(spark, tmpdir_fresh, columns).collect()
    assert [r.record_id for r in W.read_archive(spark, tmpdir_fresh, columns, "skip").collect()] == ["<urn:page:1>"]
    marked = W.read_archive(spark, tmpdir_fresh, columns, "mark").collect()
    assert sorted(r.record_type for r in marked) == ["response", "truncated"]
    assert [r.target_uri.endswith(name) for r in W.truncated_records(spark, tmpdir_fresh).collect()] == [True]


def test_a_cut_compressed_file(spark, tmpdir_fresh):
    cut_archive(tmpdir_fresh, "whole.warc.gz", -1)
    with open(f"{tmpdir_fresh}/whole.warc.gz", "rb") as f:
        data = f.read()
    os.remove(f"{tmpdir_fresh}/whole.warc.gz")
    with open(f"{tmpdir_fresh}/cut.warc.gz", "wb") as f:
        f.write(data[:len(data) // 2])
    for columns in (None, ["record_type"]):
        with pytest.raises(Exception, match="ended before"):
            W.read_archive(spark, tmpdir_fresh, columns).collect()
        assert W.read_archive(spark, tmpdir_fresh, columns, "skip").count() <= 1
    assert W.truncated_records(spark, tmpdir_fresh).count() == 1


def test_whole_files_have_no_cut_records(spark, pages, tmpdir_fresh):
    W.write_archive(pages, f"{tmpdir_fresh}/a")
    assert W.truncated_records(spark, f"{tmpdir_fresh}/a").count() == 0
    cut_archive(f"{tmpdir_fresh}/b", "no-end.warc", -4)  # the empty lines behind the last block may be missing
    assert W.read_archive(spark, f"{tmpdir_fresh}/b").count() == 2


def test_bodies_in_chunks():
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n"
    body = b"4;x=y\r\nWiki\r\n6\r\npedia \r\nE\r\nin \r\n\r\nchunks.\r\n0\r\n\r\n"
    assert W.payload_of(head + b"\r\n" + body) == b"Wikipedia in \r\n\r\nchunks."
    packed = gzip.compress(b"text " * 50)
    assert W.payload_of(head + b"Content-Encoding: gzip\r\n\r\n" + b"%x\r\n" % len(packed) + packed + b"\r\n0\r\n\r\n") == b"text " * 50
    for cut in (body[:-5], body[:20]):
        with pytest.raises(ValueError, match="chunk"):
            W.payload_of(head + b"\r\n" + cut)
