import base64
import hashlib

from pyspark.sql import functions as F

from helpers import SF
from rillmark.llm import warc
from rillmark.session import work_path

PAGES = "page_id long, url string, html string, payload string, file string"


def check(spark, pages, least=0):
    index, folder = warc.archive(spark, pages, least)
    got = warc.read(index, folder).collect()
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    newest = {}
    for page_id, body in rows:
        if len(body) >= least and page_id is not None:
            newest[body] = max(newest.get(body, page_id), page_id)
    want = sorted(
        (str(p), len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if newest.get(b, p) == p else "revisit", None if newest.get(b, p) == p else newest[b])
        for p, b in rows
    )
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    bodies = {b for _, b in rows}
    assert {bytes(r["payload"]) for r in got if r["record_type"] == "response"} == bodies
    return index, folder, got


def test_given_pages(spark):
    check(spark, spark.read.parquet(f"{SF}/pages.parquet").repartition(3))


def test_copies_nulls_and_repeats(spark):
    rows = [(1, "u", "a", "p", "f"), (2, "u\r\nWARC-Type: x", "a", None, None), (3, None, None, None, None), (4, "", "", "", ""), (None, "n", "a", "", ""), (5, "ü", "é" * 50_000, "", ""), (6, "z", "b", "", ""), (6, "z", "b", "", ""), (None, "n", "only", "", "")]
    pages = spark.createDataFrame(rows, PAGES)
    index, folder, got = check(spark, pages)
    check(spark, pages, least=2)
    assert sum(r["record_type"] == "revisit" for r in got) == 3
    chosen = index.where("page_id in (1, 5)")
    assert {r["page_id"] for r in warc.read(chosen, folder, gap=0).collect()} == {1, 5}
    assert index.where(F.col("url").isNull()).count() == 1


def test_empty_table(spark):
    index, folder = warc.archive(spark, spark.createDataFrame([], PAGES))
    assert warc.read(index, folder).count() == 0


def test_members_are_plain_gzip(spark):
    import gzip

    folder = work_path(spark, "warc-test")
    warc.write(warc.decide(spark.createDataFrame([(1, "http://a/", "<p>", "", ""), (2, "http://b/", "<p>", "", "")], PAGES)).coalesce(1), folder).collect()
    fs, path = warc.store(folder)
    (file,) = fs.get_file_info(warc.arrow_fs.FileSelector(path))
    text = gzip.decompress(fs.open_input_file(file.path).readall())
    assert text.count(b"WARC/1.1\r\n") == 2 and text.count(b"WARC-Refers-To: <urn:x-page:2>") == 1


def test_near_reads_are_joined():
    places = [("a", 0, 10), ("a", 10, 10), ("a", 50, 5), ("b", 0, 5), ("b", 6, 100)]
    assert [len(r) for r in warc.runs(places, gap=8, most=100)] == [2, 1, 1, 1]
    assert [len(r) for r in warc.runs(places, gap=30, most=1000)] == [3, 2]
